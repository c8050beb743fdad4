"""One run of a feed: from mapped fields to updated tables, payloads and a report.

Everything between two ``materialise`` calls is one lazy plan. Rows are written where a later step
reads them more than once or where a user function may not answer the same way twice. A written table
goes as soon as the tables behind it are written, so few copies of the texts lie on disk at a time; what the
outcome still reads of an earlier step is written by itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.hashing import canonical_hash
from feedloom.functions.places import location_string
from feedloom.operators import enrich, linkage, mapping, ordinals, publish, reports, routing, tables, taxonomy
from feedloom.session import discard, materialise, materialise_observed, noted
from feedloom.sources.feeds import numbered, read_feed


@dataclass(frozen=True)
class Feed:
    feed_id: int
    name: str
    company_name: str = ""
    bypass_filters: bool = False


@dataclass(frozen=True)
class Services:
    """What the run asks for: one function per enrichment step, a caller decides what they do."""

    attributes: enrich.BatchFunction
    job_function: enrich.BatchFunction
    searchable: enrich.BatchFunction
    batch_rows: int = enrich.BATCH_ROWS
    retries: int = 3
    delay: float = 2.0


@dataclass
class Stored:
    """The tables before a run, or after it. Caches hold ``job_hash`` and ``result``."""

    open: DataFrame
    review: DataFrame
    rejected: DataFrame
    archive: DataFrame
    mirror: DataFrame
    warehouse: DataFrame
    attribute_cache: DataFrame
    function_cache: DataFrame
    search_cache: DataFrame


@dataclass
class Outcome:
    stored: Stored
    outcomes: DataFrame
    counters: DataFrame
    mirror_changes: DataFrame
    payloads: DataFrame
    search_documents: DataFrame
    counted: dict[str, int] = field(default_factory=dict)
    calls: dict[str, DataFrame] = field(default_factory=dict)


def empty_tables(spark) -> Stored:
    """The tables before the first run."""
    posting = ", ".join(f"`{n}` {t}" for n, t in mapping.POSTING.items())

    def none(ddl: str) -> DataFrame:
        return spark.createDataFrame([], ddl)

    def cache(ddl: str) -> DataFrame:
        return none(f"job_hash string, result {enrich.struct_type(ddl).simpleString()}")

    layout = none(posting)
    return Stored(
        layout, layout, layout, layout, publish.published(layout), layout,
        cache(enrich.ATTRIBUTES), cache(enrich.SELECTION), cache(enrich.SEARCHABLE),
    )


def _merge(rows: DataFrame, feed: Feed, limits: linkage.Thresholds, other_title: str | None = None) -> DataFrame:
    if feed.bypass_filters:
        return rows.withColumn("is_multi_location", F.size("locations") > 1)
    return linkage.merge_postings(rows, "seq", limits, other_title).drop("merged_rows")


def _rows() -> Column:
    return F.count(F.lit(1))


def _failed() -> Column:
    return F.count_if(F.col("ai_enrichment_status").eqNullSafe(enrich.FAILED))


def _cached() -> Column:
    return F.count_if("from_cache")


def run_feed(
    mapped: DataFrame,
    feed: Feed,
    stored: Stored,
    functions: DataFrame,
    gazetteer: DataFrame,
    run_time: datetime,
    services: Services,
    limits: linkage.Thresholds = linkage.thresholds(),
    execution_id: int = 0,
    protect_failed: bool = True,
) -> Outcome:
    """Run a feed. ``mapped`` has the mapped texts and a unique integer ``seq`` in feed order.

    ``protect_failed`` keeps stored postings whose enrichment failed in this run from being archived. All
    counters are observed while the tables of the run are written; ``outcomes`` says the same row by row.
    """
    spent: dict[str, int] = {}
    options = {"batch_rows": services.batch_rows, "retries": services.retries, "delay": services.delay, "spent": spent}

    spark = mapped.sparkSession

    standard = mapping.standardise(mapped)
    with noted() as behind:
        hashed, n_hashed = materialise_observed(
            standard.withColumn("is_closed", F.col("status").eqNullSafe("CLOSED")).withColumn("job_hash", canonical_hash()),
            "hashed", rows=_rows(), closed=F.count_if("is_closed"),
        )
        active = hashed.filter(~F.col("is_closed")).drop("is_closed")
        merged = _merge(active, feed, limits)
    closed_in_feed = materialise(hashed.filter("is_closed").select("job_hash"), "closed_in_feed")
    with noted() as merging:
        first, n_first = materialise_observed(merged, "merged", rows=_rows())
    discard(spark, behind)

    with noted() as behind:
        attributed, new_attributes = enrich.enrich(
            first, stored.attribute_cache, services.attributes, enrich.ATTRIBUTES, "seq",
            ["title", "company_name", "description"], behind=merging, **options,
        )
    with noted() as enriching:
        attributed, n_attributed = materialise_observed(attributed, "attributed", rows=_rows(), failed=_failed(), cached=_cached())
        discard(spark, behind, new_attributes)
        attributed = attributed.drop("from_cache", "calls")
        answered, failed_first = enrich.split_failed(attributed)
        merged = _merge(answered, feed, limits, "ai_title")
    failed_first = materialise(failed_first.select("job_hash"), "failed")
    with noted() as merging:
        second, n_second = materialise_observed(merged, "merged", rows=_rows())
    discard(spark, enriching)

    listed = enrich.classifiable(taxonomy.attach_functions(second, functions))
    ready, no_industry = enrich.split_failed(listed)
    no_industry = materialise(no_industry.select("job_hash"), "failed")
    ready = ready.withColumn("function_ids", F.transform("job_functions", lambda f: f["id"]))
    with noted() as behind:
        selected, new_functions = enrich.enrich(
            ready, stored.function_cache, services.job_function, enrich.SELECTION, "seq",
            ["title", "description", "function_ids"], ["industry_id"], behind=merging, **options,
        )
    with noted() as enriching:
        selected, n_selected = materialise_observed(
            selected.drop("function_ids", "job_functions"), "selected", rows=_rows(), failed=_failed(), cached=_cached()
        )
    discard(spark, behind, new_functions)
    selected = selected.drop("from_cache", "calls")
    classified, failed_second = enrich.split_failed(selected)
    failed_second = materialise(failed_second.select("job_hash"), "failed")

    final = mapping.finalise(
        classified, F.lit(feed.feed_id), F.lit(feed.name), mapping.partner_id(F.lit(feed.company_name)), run_time
    )
    final = taxonomy.attach_names(final, taxonomy.function_names(functions))
    final = taxonomy.attach_coordinates(final, gazetteer).drop("geo_key")
    final = final.withColumn("location_string", location_string(F.col("locations")))
    with noted() as behind:
        routed, n_routed = materialise_observed(
            routing.with_route(ordinals.last_per_key(final, "job_hash", "seq"), feed.bypass_filters), "routed", rows=_rows(),
            **{state: F.count_if(F.col("status") == state) for state in (tables.OPEN, tables.REVIEW, tables.REJECTED)},
        )
    discard(spark, enriching)
    approved, review, rejected = routing.by_state(routed)
    current = materialise(routed.select("job_hash"), "current")
    review, rejected = materialise(review, "review"), materialise(rejected, "rejected")
    with noted() as enriching:
        approved, new_searchable = enrich.enrich(
            approved, stored.search_cache, services.searchable, enrich.SEARCHABLE, "seq",
            ["ai_top_tags", "ai_search_terms", "ai_skills", "description"], behind=behind, **options,
        )
    approved, n_approved = materialise_observed(approved, "approved", rows=_rows(), cached=_cached())
    discard(spark, enriching, new_searchable)
    approved = approved.drop("from_cache", "calls")

    mine = stored.open.filter(F.col("feed_id") == feed.feed_id)
    failed = [failed_first, no_industry, failed_second]
    if protect_failed:
        for part in failed:
            current = current.unionByName(part)
    closed = materialise(tables.closed_keys(mine, current), "closed")
    kept_open, archived, moved = tables.archive(stored.open, stored.archive, closed)
    moved, n_moved = materialise_observed(moved, "moved", rows=_rows())
    check = tables.archive_check(stored.open.select("job_hash"), kept_open.select("job_hash"), moved).first()
    if not check["counts_match"]:
        raise RuntimeError(f"{check['deleted']} postings left the open table, {check['copied']} reached the archive")

    run_id = F.lit(execution_id)
    all_rows = [mapping.conform(part.withColumn("execution_id", run_id)) for part in (approved, review, rejected)]
    left_over = moved.withColumn("status", F.lit(tables.ARCHIVED)).select(*mapping.POSTING)
    in_warehouse = all_rows[0].unionByName(all_rows[1]).unionByName(all_rows[2]).unionByName(left_over)
    with_ids = tables.with_ids(in_warehouse, stored.warehouse)
    warehouse = tables.warehouse_merge(stored.warehouse, with_ids)
    ids = with_ids.select("job_hash", "bigquery_id")

    def identified(rows: DataFrame) -> DataFrame:
        return rows.drop("bigquery_id").join(ids, "job_hash", "left").select(*mapping.POSTING)

    to_open = materialise(identified(all_rows[0]), "to_open")
    now_open = materialise(tables.upsert(kept_open, to_open), "open")
    now_mine = now_open.filter(F.col("feed_id") == feed.feed_id)
    my_mirror = stored.mirror.filter(F.col("feed_id") == feed.feed_id)
    changes, n_changes = materialise_observed(
        tables.diff(now_mine, my_mirror), "changes", add=F.count_if(F.col("action") == "add"), delete=F.count_if(F.col("action") == "delete")
    )
    added = tables.rows_of(to_open, changes.filter("action = 'add'"))
    records = publish.published(added)
    mirror = materialise(
        tables.delete_keys(stored.mirror, changes.filter("action = 'delete'")).unionByName(records), "mirror"
    )
    payloads = publish.payloads(
        records.withColumn("prefix", F.substring("job_hash", 1, 2)), "job_hash", publish.MIRROR_ROWS,
        F.struct(*records.columns), range_of=F.col("prefix"),
    )
    documents = publish.search_documents(mirror.filter(F.col("feed_id") == feed.feed_id))

    def marked(rows: DataFrame, outcome: str) -> DataFrame:
        return rows.select(F.lit(feed.feed_id).alias("feed_id"), "job_hash", F.lit(outcome).alias("outcome"))

    outcomes = marked(closed_in_feed, "closed_in_feed")
    for rows, outcome in [(approved, "approved"), (review, "review"), (rejected, "rejected"), (moved, "archived")]:
        outcomes = outcomes.unionByName(marked(rows, outcome))
    for part in failed:
        outcomes = outcomes.unionByName(marked(part, "failed"))
    no_industry_rows = n_second["rows"] - n_selected["rows"]
    counted = {
        "total_in_feed": n_hashed["rows"],
        "mirror_added": n_changes["add"],
        "mirror_deleted": n_changes["delete"],
        "skipped_duplicate_initial_aggregation": n_hashed["rows"] - n_hashed["closed"] - n_first["rows"],
        "skipped_duplicate_ai_aggregation": n_attributed["rows"] - n_attributed["failed"] - n_second["rows"],
        "skipped_duplicate": n_selected["rows"] - n_selected["failed"] - n_routed["rows"],
        "skipped_closed": n_hashed["closed"],
        "records_failed": n_attributed["failed"] + no_industry_rows + n_selected["failed"],
        "jobs_auto_approved": n_approved["rows"],
        "jobs_manual_review": n_routed[tables.REVIEW],
        "jobs_rejected": n_routed[tables.REJECTED],
        "jobs_closed": n_moved["rows"],
        "processed_successfully": n_approved["rows"] + n_routed[tables.REVIEW] + n_routed[tables.REJECTED],
        "cache_hits": n_attributed["cached"] + n_selected["cached"] + n_approved["cached"],
        "model_calls": spent["calls"],
        "input_tokens": spent["input_tokens"],
        "output_tokens": spent["output_tokens"],
        "total_tokens": spent["input_tokens"] + spent["output_tokens"],
    }
    counters = spark.range(1).select(
        *[F.lit(n).cast("long").alias(name) for name, n in counted.items()], F.lit(feed.feed_id).alias("feed_id")
    )
    gone = my_mirror.join(changes.filter("action = 'delete'").select("job_hash"), "job_hash", "left_semi")
    calls = publish.sync_batches(
        f"{feed.feed_id}-{run_time.isoformat()}", records, changes.filter("action = 'delete'"), documents,
        gone.select(F.col("eid").alias("id")),
    )

    return Outcome(
        stored=Stored(
            open=now_open,
            review=tables.upsert(stored.review, identified(all_rows[1])),
            rejected=tables.upsert(stored.rejected, identified(all_rows[2])),
            archive=archived,
            mirror=mirror,
            warehouse=warehouse,
            attribute_cache=enrich.save_cache(stored.attribute_cache, new_attributes),
            function_cache=enrich.save_cache(stored.function_cache, new_functions),
            search_cache=enrich.save_cache(stored.search_cache, new_searchable),
        ),
        outcomes=outcomes,
        counters=counters,
        mirror_changes=changes,
        payloads=payloads,
        search_documents=documents,
        counted=counted,
        calls=calls,
    )


def reported_run(
    feed: Feed,
    run: Callable[[], Outcome],
    report_rows: DataFrame,
    feeds: DataFrame,
    clock: Callable[[], datetime],
    feed_file_size_bytes: int | None = None,
) -> tuple[Outcome | None, DataFrame, DataFrame]:
    """``(outcome, reports, feeds)`` of a run with its report opened before it and closed behind it.

    A run that fails has no outcome; its report is a failure with the error, and the feed's streak goes on. Both
    tables are written: the report of a run that never comes back stays RUNNING. ``report_rows`` has the columns
    of ``reports.REPORT``.
    """
    spark = report_rows.sparkSession
    begun = materialise(reports.initial_report(feed.feed_id, feed.name, clock(), spark), "report")
    opened = materialise(report_rows.unionByName(reports.report_row(begun)), "reports")
    out, errors = None, []
    try:
        out = run()
    except Exception as problem:  # noqa: BLE001 - whatever ends a run belongs in its report
        errors.append(f"Run failed: {problem}")
    counted = dict(out.counted) if out is not None else {}
    if feed_file_size_bytes is not None:
        counted["feed_file_size_bytes"] = feed_file_size_bytes
    ended = clock()
    closed = materialise(reports.update_reports(opened, reports.final_report(begun, ended, counted, errors)), "reports")
    mine = closed.filter(F.col("feed_id") == feed.feed_id)
    now = F.lit(ended).cast("timestamp")
    return out, closed, materialise(reports.update_feeds(feeds, mine, now), "feeds")


def run_feed_files(spark, path, mappings: dict[str, str], feed: Feed, stored: Stored, report_rows: DataFrame, feeds: DataFrame,
                   clock: Callable[[], datetime], attributes: bool = False, **given) -> tuple[Outcome | None, DataFrame, DataFrame]:
    """A reported run from the feed files below ``path``: scan, number, run, close the report.

    ``given`` are the further arguments of :func:`run_feed` (``functions``, ``gazetteer``, ``services``, ...). A
    feed that cannot be read is a failed run.
    """

    def run() -> Outcome:
        rows = materialise(read_feed(spark, path, mappings, attributes), "scanned")
        sizes = rows.select("file_path", "file_size").distinct().agg(F.sum("file_size")).first()[0]
        mapped = numbered(rows).drop("position", "file_path", "file_size")
        out = run_feed(mapped, feed, stored, run_time=clock(), **given)
        out.counted["feed_file_size_bytes"] = int(sizes or 0)
        return out

    return reported_run(feed, run, report_rows, feeds, clock)
