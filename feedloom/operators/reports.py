"""Run reports and feed statistics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.ordinals import last_per_key, top_per_key
from feedloom.operators.tables import upsert

# The outcomes a posting can have in a run and the counters they feed.
OUTCOMES = {
    "closed_in_feed": "skipped_closed",
    "failed": "records_failed",
    "approved": "jobs_auto_approved",
    "review": "jobs_manual_review",
    "rejected": "jobs_rejected",
    "archived": "jobs_closed",
}
LAST_ERRORS = 10


# The columns of a run's report.
REPORT = {
    "id": "bigint", "feed_id": "int", "feed_name": "string", "run_status": "string", "start_time": "timestamp", "end_time": "timestamp",
    "duration_seconds": "double", "total_in_feed": "bigint", "processed_successfully": "bigint", "skipped_closed": "bigint",
    "skipped_duplicate": "bigint", "skipped_duplicate_initial_aggregation": "bigint", "skipped_duplicate_ai_aggregation": "bigint",
    "records_failed": "bigint", "jobs_closed": "bigint", "jobs_auto_approved": "bigint", "jobs_manual_review": "bigint",
    "jobs_rejected": "bigint", "model_calls": "bigint", "custom_calls": "bigint", "cache_hits": "bigint", "input_tokens": "bigint",
    "output_tokens": "bigint", "total_tokens": "bigint", "feed_file_size_bytes": "bigint", "mirror_added": "bigint",
    "mirror_deleted": "bigint", "error_summary": "string", "error_message": "string",
}
REPORT_DDL = ", ".join(f"{name} {kind}" for name, kind in REPORT.items())
RUNNING, SUCCESS, FAILURE = "RUNNING", "SUCCESS", "FAILURE"


def initial_report(feed_id: int, feed_name: str, run_time: datetime, spark) -> DataFrame:
    """The report row of a run that has just begun; its id depends only on feed and time."""
    row = spark.range(1).select(
        F.lit(feed_id).alias("feed_id"), F.lit(feed_name).alias("feed_name"),
        F.lit(run_time).cast("timestamp").alias("start_time"), F.lit(RUNNING).alias("run_status"),
    )
    return row.withColumn("id", F.xxhash64("feed_id", "start_time"))


def report_row(row: DataFrame) -> DataFrame:
    """A row with every column of a report; what is not known yet is null."""
    return row.select(*[
        (F.col(name) if name in row.columns else F.lit(None)).cast(kind).alias(name) for name, kind in REPORT.items()
    ])


def final_report(begun: DataFrame, ended: datetime, counted: dict[str, int], errors: Sequence[str] = ()) -> DataFrame:
    """What a run's report becomes when it has ended: counters, duration, the last errors; any error is a failure.

    ``begun`` is the row of :func:`initial_report`; names of ``counted`` that a report lacks are left out.
    """
    last = list(errors)[-LAST_ERRORS:]
    end = F.lit(ended).cast("timestamp")
    known = {name: F.lit(n).cast("long") for name, n in counted.items() if name in REPORT}
    return begun.select("id", "start_time").withColumns({
        **known,
        "run_status": F.lit(FAILURE if last else SUCCESS),
        "end_time": end,
        "duration_seconds": F.unix_micros(end) / 1e6 - F.unix_micros("start_time") / 1e6,
        "error_summary": F.array(*[F.lit(e) for e in last]) if last else F.lit(None).cast("array<string>"),
        "error_message": F.lit(last[0] if last else None).cast("string"),
    })


def update_reports(reports: DataFrame, changes: DataFrame) -> DataFrame:
    """The reports with the changed columns of finished runs; error lists become JSON text."""
    for field in changes.schema.fields:
        if field.dataType.typeName() == "array":
            changes = changes.withColumn(field.name, F.to_json(field.name))
    return upsert(reports, changes, "id", protected=())


def run_counters(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """All counters of a run from one row per posting with ``outcome``; archived rows are not in the feed."""
    counters = [F.count_if(F.col("outcome") == o).alias(name) for o, name in OUTCOMES.items()]
    counted = outcomes.groupBy(*keys).agg(
        F.count_if(F.col("outcome") != "archived").alias("total_in_feed"), *counters
    )
    done = F.col("jobs_auto_approved") + F.col("jobs_manual_review") + F.col("jobs_rejected")
    return counted.withColumn("processed_successfully", done)


def usage(calls: DataFrame, keys: list[str]) -> DataFrame:
    """Token sums, calls by kind and cache hits; ``calls`` has ``kind``, ``input_tokens``, ``output_tokens``."""
    total_in, total_out = F.sum("input_tokens"), F.sum("output_tokens")
    return calls.groupBy(*keys).agg(
        total_in.alias("input_tokens"),
        total_out.alias("output_tokens"),
        (total_in + total_out).alias("total_tokens"),
        F.count_if(F.col("kind") == "model").alias("model_calls"),
        F.count_if(F.col("kind") == "custom").alias("custom_calls"),
        F.count_if(F.col("kind") == "cache").alias("cache_hits"),
    )


def feed_averages(reports: DataFrame) -> DataFrame:
    """Average duration and file size per feed over the runs that have both."""
    both = reports.filter(F.col("duration_seconds").isNotNull() & F.col("feed_file_size_bytes").isNotNull())
    return both.groupBy("feed_id").agg(
        F.avg("duration_seconds").alias("avg_processing_time"), F.avg("feed_file_size_bytes").alias("avg_feed_size")
    )


def latest_reports(reports: DataFrame, order: str | Column = "start_time") -> DataFrame:
    return last_per_key(reports, "feed_id", order)


def failure_streaks(reports: DataFrame) -> DataFrame:
    """Per feed: failures since the last success, all failures, the last success and the last error.

    Two aggregates and a join on the feed instead of a running window, so a feed with very many runs
    is never sorted in one task.
    """
    ok = F.col("run_status") == "SUCCESS"
    failed = F.col("run_status") == "FAILURE"
    totals = reports.groupBy("feed_id").agg(
        F.max(F.when(ok, F.col("start_time"))).alias("last_succeeded_at"),
        F.count_if(failed).alias("error_count"),
        F.max_by(F.when(failed, F.col("error_message")), F.when(failed, F.col("start_time"))).alias(
            "last_error_message"
        ),
    )
    since = reports.filter(failed).select("feed_id", "start_time").join(
        totals.select("feed_id", F.col("last_succeeded_at").alias("since")), "feed_id"
    )
    streak = (
        since.filter(F.col("since").isNull() | (F.col("start_time") > F.col("since")))
        .groupBy("feed_id")
        .agg(F.count(F.lit(1)).alias("consecutive_failure_count"))
    )
    joined = totals.join(streak, "feed_id", "left")
    return joined.withColumn("consecutive_failure_count", F.coalesce("consecutive_failure_count", F.lit(0)))


def update_feeds(feeds: DataFrame, reports: DataFrame, run_time: Column) -> DataFrame:
    """The feeds table with the statistics of its finished runs; feeds without a run stay as they are.

    Counts are added to the stored ones. Where the table has ``last_checked_at``, only runs that began
    after it count, so the same reports may be given again. The stored streak goes on while no run
    succeeded; the last success and the last error stay where no newer one is known.
    """
    finished = reports.filter(F.col("run_status").isin("SUCCESS", "FAILURE"))
    averages = feed_averages(finished)
    if "last_checked_at" in feeds.columns:
        seen = feeds.select(F.col("id").alias("feed_id"), F.col("last_checked_at").alias("_seen"))
        fresh = finished.join(seen, "feed_id").filter(F.col("_seen").isNull() | (F.col("start_time") > F.col("_seen")))
        finished = fresh.drop("_seen")
    last = latest_reports(finished).select(
        "feed_id", F.col("run_status").alias("last_run_status"),
        F.col("processed_successfully").alias("unique_jobs_processed"),
        F.col("jobs_auto_approved").alias("cw_auto_approved_jobs"),
    )
    stats = last.join(averages, "feed_id", "left").join(failure_streaks(finished), "feed_id", "left")
    stored = {
        c: F.col(f"_{c}") if c in feeds.columns else F.lit(None)
        for c in ("error_count", "consecutive_failure_count", "last_succeeded_at", "last_error_message")
    }
    stats = stats.join(
        feeds.select(F.col("id").alias("feed_id"), *[F.col(c).alias(f"_{c}") for c in stored if c in feeds.columns]), "feed_id"
    )
    streak = F.when(
        F.col("last_succeeded_at").isNull(), F.coalesce(stored["consecutive_failure_count"], F.lit(0)) + F.col("consecutive_failure_count")
    ).otherwise(F.col("consecutive_failure_count"))
    stats = stats.withColumns({
        "error_count": F.coalesce(stored["error_count"], F.lit(0)) + F.col("error_count"),
        "consecutive_failure_count": streak,
        "last_error_message": F.coalesce("last_error_message", stored["last_error_message"]),
    }).withColumn("last_succeeded_at", F.coalesce("last_succeeded_at", stored["last_succeeded_at"]))
    stats = stats.withColumnRenamed("feed_id", "id").withColumns({"last_checked_at": run_time, "updated_at": run_time})
    kept = [c for c in stats.columns if c in feeds.columns]
    return upsert(feeds, stats.select(*kept), "id", protected=())


def last_errors(errors: DataFrame, keys: list[str], order: str, limit: int = LAST_ERRORS) -> DataFrame:
    """The last errors of each run as one list, oldest first."""
    last = top_per_key(errors, keys, [F.col(order).desc()], limit)
    pairs = F.array_sort(F.collect_list(F.struct(order, "error_message")))
    return last.groupBy(*keys).agg(pairs.alias("pairs")).select(
        *keys, F.transform("pairs", lambda p: p["error_message"]).alias("error_summary")
    )


def hash_sample(rows: DataFrame, keys: list[str], key: str = "job_hash", size: int = 5) -> DataFrame:
    """Distinct hashes and the first ``size`` of them; distinct before collecting, limited before the shuffle."""
    distinct = rows.select(*keys, key).distinct()
    counts = distinct.groupBy(*keys).agg(F.count(key).alias("unique_hashes"))
    first = top_per_key(distinct.filter(F.col(key).isNotNull()), keys, [F.col(key)], size)
    sample = first.groupBy(*keys).agg(F.array_sort(F.collect_list(key)).alias("sample"))
    return counts.join(sample, keys, "left")


def outcome_counts(rows: DataFrame, keys: list[str], status: str = "status") -> DataFrame:
    return rows.groupBy(*keys, status).agg(F.count(F.lit(1)).alias("n"))


def grouped(col: Column) -> Column:
    """A whole number with thousands separators."""
    return F.format_number(col, 0)


def fixed2(col: Column) -> Column:
    """Two decimals without separators."""
    return F.regexp_replace(F.format_number(col, 2), ",", "")


def report_lines(reports: DataFrame) -> DataFrame:
    """The report of a run as text fields, for whatever channel sends it."""
    errors = F.substring(F.array_join("error_summary", "; "), 1, 1000)
    return reports.select(
        "feed_id",
        F.coalesce("run_status", F.lit("UNKNOWN")).alias("status"),
        F.concat(fixed2(F.col("duration_seconds")), F.lit("s")).alias("duration"),
        grouped(F.col("total_in_feed")).alias("total_in_feed"),
        grouped(F.col("processed_successfully")).alias("processed_successfully"),
        fixed2(F.col("feed_file_size_bytes") / (1024 * 1024)).alias("feed_size_mb"),
        F.coalesce(errors, F.lit("")).alias("error_summary"),
    )
