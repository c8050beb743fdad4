"""Queries of publishing, reports and feed statistics.

Events stand for runs: the user is the feed, errors are failures, purchases and views successes.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from feedloom.functions import places, text
from feedloom.operators import mapping, ordinals, publish, reports, routing
from feedloom.plans.enriching import ROUTE_SQL
from feedloom.plans.registry import CLOSED_SQL, hashed_postings, light_postings, query, select_sql, table
from feedloom.plans.scalars import PLACES_SQL
from feedloom.session import materialise, materialise_observed, scratch_path
from feedloom.sources import sinks

REPORTS = """event_id AS id, CAST(user_id AS INT) AS feed_id, ts AS start_time,
    CASE event_type WHEN 'error' THEN 'FAILURE' WHEN 'purchase' THEN 'SUCCESS' WHEN 'view' THEN 'SUCCESS' ELSE 'RUNNING' END AS run_status,
    CASE WHEN event_type <> 'view' THEN value END AS duration_seconds,
    CASE WHEN event_type <> 'signup' THEN CAST(event_id * 1000 AS BIGINT) END AS feed_file_size_bytes,
    CASE WHEN event_type = 'error' THEN concat('problem ', event_id) END AS error_message,
    CAST(event_id AS INT) AS processed_successfully, CAST(event_id * 3 AS INT) AS jobs_auto_approved"""
REPORTS_SQL = f"WITH reports AS (SELECT {REPORTS} FROM events) "


def runs(spark, sf):
    return select_sql(table(spark, sf, "events"), REPORTS)


@query("ag4_feed_averages", REPORTS_SQL + """SELECT feed_id, round(avg(duration_seconds), 6) AS avg_processing_time, avg(feed_file_size_bytes) AS avg_feed_size
    FROM reports WHERE duration_seconds IS NOT NULL AND feed_file_size_bytes IS NOT NULL GROUP BY feed_id""")
def ag4(spark, sf):
    return reports.feed_averages(runs(spark, sf)).withColumn("avg_processing_time", F.round("avg_processing_time", 6))


@query("wn3_latest_report", REPORTS_SQL + "SELECT feed_id, arg_max(id, start_time) AS id, arg_max(run_status, start_time) AS run_status FROM reports GROUP BY feed_id")
def wn3(spark, sf):
    return reports.latest_reports(runs(spark, sf)).select("feed_id", "id", "run_status")


STREAK_SQL = REPORTS_SQL + """, o AS (SELECT feed_id, max(start_time) FILTER (WHERE run_status = 'SUCCESS') AS ok FROM reports GROUP BY feed_id),
    streaks AS (SELECT feed_id, count(*) FILTER (WHERE run_status = 'FAILURE' AND (ok IS NULL OR start_time > ok)) AS consecutive_failure_count,
    count(*) FILTER (WHERE run_status = 'FAILURE') AS error_count, arg_max(error_message, start_time) FILTER (WHERE run_status = 'FAILURE') AS last_error_message
    FROM reports JOIN o USING (feed_id) GROUP BY feed_id)"""


@query("wn5_consecutive_failures", STREAK_SQL + " SELECT * FROM streaks")
def wn5(spark, sf):
    return reports.failure_streaks(runs(spark, sf)).drop("last_succeeded_at")


@query(
    "sk11_update_feeds",
    STREAK_SQL + """, f AS (SELECT * FROM reports WHERE run_status IN ('SUCCESS', 'FAILURE')),
    l AS (SELECT feed_id, arg_max(run_status, start_time) AS last_run_status, arg_max(processed_successfully, start_time) AS unique_jobs_processed FROM f GROUP BY feed_id)
    SELECT CAST(c_custkey AS INT) AS id, c_name AS name, last_run_status, unique_jobs_processed, CAST(s.error_count AS INT) AS error_count,
    CAST(s.consecutive_failure_count AS INT) AS consecutive_failure_count
    FROM customer LEFT JOIN l ON l.feed_id = c_custkey LEFT JOIN streaks s ON s.feed_id = l.feed_id""",
)
def sk11(spark, sf):
    nothing = F.lit(None)
    feeds = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"), nothing.cast("string").alias("last_run_status"),
        nothing.cast("int").alias("unique_jobs_processed"), nothing.cast("int").alias("error_count"),
        nothing.cast("int").alias("consecutive_failure_count"), nothing.cast("timestamp").alias("updated_at"),
    )
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return reports.update_feeds(feeds, runs(spark, sf), now).drop("updated_at")


@query(
    "sk10_update_reports",
    REPORTS_SQL + """SELECT id, CASE WHEN run_status = 'RUNNING' THEN 'SUCCESS' ELSE run_status END AS run_status,
    CASE WHEN run_status = 'RUNNING' THEN concat('["', 'late ', id, '"]') END AS error_summary FROM reports""",
)
def sk10(spark, sf):
    stored = runs(spark, sf).select("id", "run_status", F.lit(None).cast("string").alias("error_summary"))
    changes = stored.filter("run_status = 'RUNNING'").select(
        "id", F.lit("SUCCESS").alias("run_status"), F.array(F.concat(F.lit("late "), "id")).alias("error_summary")
    )
    return reports.update_reports(stored, changes)


@query(
    "ag5_run_counters",
    f"""+ o AS (SELECT feed_id, CASE WHEN {CLOSED_SQL} THEN 'closed_in_feed' WHEN is_remote = 'false' THEN 'failed' ELSE {ROUTE_SQL} END AS k FROM postings)
    SELECT feed_id, count(*) AS total_in_feed, count(*) FILTER (WHERE k = 'closed_in_feed') AS skipped_closed, count(*) FILTER (WHERE k = 'failed') AS records_failed,
    count(*) FILTER (WHERE k = 'ACTIVE') AS jobs_auto_approved, count(*) FILTER (WHERE k = 'MANUAL_REVIEW') AS jobs_manual_review,
    count(*) FILTER (WHERE k = 'REJECTED') AS jobs_rejected, 0 AS jobs_closed,
    count(*) FILTER (WHERE k IN ('ACTIVE', 'MANUAL_REVIEW', 'REJECTED')) AS processed_successfully FROM o GROUP BY feed_id""",
    view=True,
)
def ag5(spark, sf):
    rows = light_postings(spark, sf).select("feed_id", "status", "is_remote", "ai_confidence_score")
    closed = text.posting_status(F.col("status")) == "CLOSED"
    names = F.create_map(*[F.lit(x) for x in ("ACTIVE", "approved", "MANUAL_REVIEW", "review", "REJECTED", "rejected")])
    failed = F.col("is_remote").eqNullSafe("false")
    outcome = (
        F.when(closed, "closed_in_feed").when(failed, "failed").otherwise(F.element_at(names, routing.route(F.col("ai_confidence_score"))))
    )
    return reports.run_counters(rows.withColumn("outcome", outcome), ["feed_id"])


@query(
    "ag6_usage",
    """SELECT l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AS late, CAST(sum(l_quantity) AS BIGINT) AS input_tokens, sum(l_linenumber)::BIGINT AS output_tokens,
    CAST(sum(l_quantity) AS BIGINT) + sum(l_linenumber)::BIGINT AS total_tokens, count(*) FILTER (WHERE l_returnflag = 'R') AS model_calls,
    count(*) FILTER (WHERE l_returnflag = 'A') AS custom_calls, count(*) FILTER (WHERE l_returnflag = 'N') AS cache_hits FROM lineitem GROUP BY ALL""",
)
def ag6(spark, sf):
    calls = select_sql(
        table(spark, sf, "lineitem"),
        """l_shipdate >= TIMESTAMP_NTZ '1998-01-01 00:00:00' AS late, CASE l_returnflag WHEN 'R' THEN 'model' WHEN 'A' THEN 'custom' ELSE 'cache' END AS kind,
        CAST(l_quantity AS BIGINT) AS input_tokens, CAST(l_linenumber AS BIGINT) AS output_tokens""",
    )
    return reports.usage(calls, ["late"])


@query(
    "ag15_last_errors",
    REPORTS_SQL + """SELECT feed_id, string_agg(error_message, ';' ORDER BY start_time) AS errors FROM (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY start_time DESC) AS rn
    FROM reports WHERE error_message IS NOT NULL) WHERE rn <= 10 GROUP BY feed_id""",
)
def ag15(spark, sf):
    errors = runs(spark, sf).filter("error_message IS NOT NULL").select("feed_id", "start_time", "error_message")
    out = reports.last_errors(errors, ["feed_id"], "start_time")
    return out.select("feed_id", F.array_join("error_summary", ";").alias("errors"))


@query("ag16_outcomes", REPORTS_SQL + "SELECT feed_id, run_status, count(*) AS n FROM reports GROUP BY ALL")
def ag16(spark, sf):
    return reports.outcome_counts(runs(spark, sf), ["feed_id"], "run_status")


@query(
    "fn33_report_lines",
    """SELECT CAST(o_orderkey AS INT) AS feed_id, 'SUCCESS' AS status, concat(format('{:.2f}', o_totalprice), 's') AS duration,
    format('{:,}', o_orderkey) AS total_in_feed, format('{:,}', o_orderkey * 1000) AS processed_successfully,
    format('{:.2f}', o_orderkey * 12345 / (1024 * 1024.0)::DOUBLE) AS feed_size_mb, concat('first; ', o_orderpriority) AS error_summary FROM orders""",
)
def fn33(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("int").alias("feed_id"), F.lit("SUCCESS").alias("run_status"),
        F.col("o_totalprice").alias("duration_seconds"), F.col("o_orderkey").alias("total_in_feed"),
        (F.col("o_orderkey") * 1000).alias("processed_successfully"), (F.col("o_orderkey") * 12345).alias("feed_file_size_bytes"),
        F.array(F.lit("first"), "o_orderpriority").alias("error_summary"),
    )
    return reports.report_lines(rows)


def mirror(spark, sf):
    """Published records of all postings that are not closed."""
    rows = mapping.drop_closed(hashed_postings(spark, sf).withColumn("status", text.posting_status(F.col("status"))))
    ready = rows.withColumns(
        {
            "locations": places.locations_from_text(F.col("locations")),
            "employment_type": text.employment_type(F.col("employment_type")),
            "is_remote": F.coalesce(text.truth(F.col("is_remote")), F.lit(False)),
            "ai_description": F.col("description"),
            "searchable_text": F.lower("description"),
        }
    )
    eid = F.when(F.col("feed_id") != 5, F.concat(F.lit("e"), F.col("seq")))
    return publish.published(ready, eid)


@query(
    "pf7_published_record",
    f"""SELECT external_job_id, job_hash, CASE WHEN lang_full THEN 'Full-time' ELSE 'Part-time' END AS employment_type, company_name AS company,
    coalesce(TRY_CAST(salary_min AS DOUBLE), 0.0) AS salary_min, 0 AS salary_max_zero, coalesce(CAST(trunc(ai_confidence_score) AS INT), 0) AS ai_confidence_score,
    feed_id, 0 AS execution_id, CAST(0 AS BIGINT) AS posted_at, 43 AS n_fields FROM (SELECT *, company_name = 'en' AS lang_full FROM hashed) WHERE NOT {CLOSED_SQL}""",
    view=True,
)
def pf7(spark, sf):
    records = mirror(spark, sf)
    return records.select(
        "external_job_id", "job_hash", "employment_type", "company", "salary_min", F.col("salary_max").cast("int").alias("salary_max_zero"),
        "ai_confidence_score", "feed_id", "execution_id", "posted_at", F.lit(len(records.columns)).alias("n_fields"),
    )


EXCERPT_SQL = "substr(trim(regexp_replace(regexp_replace(description, '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')), 1, 400)"


@query(
    "pf8_search_document",
    PLACES_SQL + f""" SELECT concat('e', seq) AS id, substr(lower(description), 1, 2500) AS searchable, {EXCERPT_SQL} AS description,
    concat_ws(' ', city, state, country) AS location, feed_id FROM placed WHERE feed_id <> 5 AND NOT {CLOSED_SQL}""",
    view=True,
)
def pf8(spark, sf):
    return publish.search_documents(mirror(spark, sf)).select(
        "id", F.col("content.searchableText").alias("searchable"), "content.description", "content.location", "metadata.feed_id"
    )


@query(
    "sk16_reindex",
    f"""SELECT feed_id, count(*) AS documents FROM postings WHERE feed_id <> 5 AND NOT {CLOSED_SQL}
    AND feed_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) GROUP BY feed_id""",
    view=True,
)
def sk16(spark, sf):
    """Search documents of the active feeds, counted per feed."""
    active = table(spark, sf, "supplier").filter("s_acctbal >= 0").select(F.col("s_suppkey").cast("int").alias("feed_id"))
    records = mirror(spark, sf).join(active, "feed_id", "left_semi")
    documents = publish.search_documents(records)
    return documents.groupBy("metadata.feed_id").agg(F.count(F.lit(1)).alias("documents"))


PAYLOAD_SQL = """WITH n AS (SELECT o_orderpriority, o_orderkey, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) // 250 + 1 AS batch_no FROM orders),
    p AS (SELECT o_orderpriority, CAST(batch_no AS BIGINT) AS batch_no, count(*) AS batch_rows, concat('[', string_agg(o_orderkey, ',' ORDER BY o_orderkey), ']') AS payload FROM n GROUP BY ALL)"""


def order_payloads(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    return publish.payloads(rows, "o_orderkey", publish.MIRROR_ROWS, F.col("o_orderkey"), ("o_orderpriority",))


@query("sk6_payload_batches", PAYLOAD_SQL + " SELECT * FROM p")
def sk6(spark, sf):
    return order_payloads(spark, sf)


def by_length(payload: str) -> int:
    """A writer whose answer depends on the payload: done, refused or unavailable."""
    return (200, 200, 404, 503)[len(payload) % 4]


@query(
    "sk7_send_outcome",
    PAYLOAD_SQL + """ SELECT o_orderpriority, batch_no, batch_rows, length(payload) % 4 < 2 AS ok, CASE WHEN length(payload) % 4 = 3 THEN 3 ELSE 1 END AS attempts,
    CASE length(payload) % 4 WHEN 2 THEN 'HTTP 404' WHEN 3 THEN 'Failed after 3 retries.' END AS error FROM p""",
)
def sk7(spark, sf):
    return publish.send_payloads(order_payloads(spark, sf), by_length, delay=0.0)


@query(
    "ag16_batch_totals",
    """SELECT o_orderpriority, count(*) AS total_rows, CAST(ceil(count(*) / 250.0) AS BIGINT) AS total_batches FROM orders GROUP BY ALL""",
)
def ag16_batches(spark, sf):
    return ordinals.batch_totals(order_payloads(spark, sf), ["o_orderpriority"])


def sent_orders(spark, sf):
    """The mirror's calls for all orders, sent through the sink to a folder; ``(calls, journal, folder)``."""
    rows = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    calls = materialise(publish.action_batches(rows, "mirror_add", "run-1", "o_orderkey", keys=("o_orderpriority",)), "calls")
    journal, folder = scratch_path(spark, "journal"), scratch_path(spark, "drop")
    sinks.send_batches(calls, sinks.FolderDrop(folder), journal)
    return calls, journal, folder


@query(
    "sk6_sent_payloads",
    PAYLOAD_SQL + """ SELECT o_orderpriority, batch_no, batch_rows, concat('{"job_postings":', payload, '}') AS payload FROM p""",
)
def sk6_sent(spark, sf):
    """What the receiver has got, put beside the batch it came from."""
    calls, _, folder = sent_orders(spark, sf)
    got = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(folder)
    got = got.select(F.regexp_extract(F.input_file_name(), r"([0-9a-f]{64})\.json", 1).alias("batch_key"), F.col("value").alias("payload"))
    return calls.drop("payload").join(got, "batch_key", "full_outer").select("o_orderpriority", "batch_no", "batch_rows", "payload")


@query(
    "ag16_sent_totals",
    """SELECT o_orderpriority, count(*) AS total_rows, CAST(ceil(count(*) / 250.0) AS BIGINT) AS total_batches FROM orders GROUP BY ALL""",
)
def ag16_sent(spark, sf):
    """Rows and batches by priority from the journal of what was accepted."""
    calls, journal, _ = sent_orders(spark, sf)
    accepted = sinks.outcomes(spark, journal).filter("ok").select("batch_key", "batch_rows")
    return ordinals.batch_totals(calls.select("batch_key", "o_orderpriority").join(accepted, "batch_key"), ["o_orderpriority"])


@query(
    "sk6_sync",
    """WITH c AS (SELECT 'mirror_add' AS action, count(*) AS rows, 250.0 AS size FROM orders UNION ALL SELECT 'mirror_delete', count(DISTINCT o_custkey), 250.0 FROM orders
    UNION ALL SELECT 'search_upsert', count(*), 100.0 FROM part UNION ALL SELECT 'search_delete', count(DISTINCT l_suppkey), 100.0 FROM lineitem)
    SELECT action, CAST(ceil(rows / size) AS BIGINT) AS batches, 0 AS refused, rows, 0 AS refused_rows FROM c""",
)
def sk6_sync(spark, sf):
    """A whole sync, both deletions before the additions: accepted batches and rows of each action."""
    records = table(spark, sf, "orders").select(F.sha2(F.col("o_orderkey").cast("string"), 256).alias("job_hash"), "o_orderstatus")
    gone = table(spark, sf, "orders").select(F.sha2(F.col("o_custkey").cast("string"), 256).alias("job_hash"))
    documents = table(spark, sf, "part").select(F.sha2(F.col("p_partkey").cast("string"), 256).alias("id"), F.struct("p_name", "p_brand").alias("content"))
    gone_ids = table(spark, sf, "lineitem").select(F.sha2(F.col("l_suppkey").cast("string"), 256).alias("id"))
    calls = publish.sync_batches("run-1", records, gone, documents, gone_ids)
    return sinks.totals(publish.sync(calls, sinks.FolderDrop(scratch_path(spark, "drop")), scratch_path(spark, "journal")))


@query(
    "sk10_observed_report",
    f"""+ o AS (SELECT CASE WHEN {CLOSED_SQL} THEN 'closed_in_feed' WHEN is_remote = 'false' THEN 'failed' ELSE {ROUTE_SQL} END AS k FROM postings)
    SELECT 'SUCCESS' AS run_status, 90.0::DOUBLE AS duration_seconds, count(*) AS total_in_feed, count(*) FILTER (WHERE k = 'closed_in_feed') AS skipped_closed,
    count(*) FILTER (WHERE k = 'failed') AS records_failed, count(*) FILTER (WHERE k = 'ACTIVE') AS jobs_auto_approved,
    count(*) FILTER (WHERE k = 'MANUAL_REVIEW') AS jobs_manual_review, count(*) FILTER (WHERE k = 'REJECTED') AS jobs_rejected FROM o""",
    view=True,
)
def sk10_observed(spark, sf):
    """A run's report, opened, and closed with the counters observed while the postings' outcomes were written."""
    rows = light_postings(spark, sf).select("seq", "status", "is_remote", "ai_confidence_score")
    closed = text.posting_status(F.col("status")) == "CLOSED"
    failed = F.col("is_remote").eqNullSafe("false")
    outcome = F.when(closed, "closed_in_feed").when(failed, "failed").otherwise(routing.route(F.col("ai_confidence_score")))
    names = {
        "closed_in_feed": "skipped_closed", "failed": "records_failed", "ACTIVE": "jobs_auto_approved",
        "MANUAL_REVIEW": "jobs_manual_review", "REJECTED": "jobs_rejected",
    }
    measures = {name: F.count_if(F.col("outcome") == k) for k, name in names.items()}
    _, counted = materialise_observed(rows.select("seq", outcome.alias("outcome")), "outcomes", total_in_feed=F.count(F.lit(1)), **measures)
    begun = reports.initial_report(7, "all postings", datetime(2024, 2, 1, 12, 0, 0), spark)
    closing = reports.final_report(begun, datetime(2024, 2, 1, 12, 1, 30), counted)
    report = reports.update_reports(reports.report_row(begun), closing)
    return report.select("run_status", "duration_seconds", "total_in_feed", *names.values())
