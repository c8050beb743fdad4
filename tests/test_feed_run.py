import os
import sys
from datetime import datetime

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from feedloom.operators import reports, tables
from feedloom.operators.mapping import POSTING
from feedloom.operators.taxonomy import JOB_FUNCTION
from feedloom.plans.feed_run import Feed, Services, empty_tables, reported_run, run_feed, run_feed_files
from feedloom.plans.stand_ins import first_function, joined_terms
from feedloom.session import materialise, noted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAPPED = "seq long, title string, company_name string, employment_type string, description string, status string, locations string"
TEXT = "care for patients on the night ward and keep the records of every shift in good order"


def attributes(rows):
    if any(r["title"] == "Fails" for r in rows):
        raise ValueError("down")
    scores = {"Nurse": 95.0, "Trainer": 60.0, "Cook": 10.0, "Driver": None}
    return [
        {"ai_title": r["title"], "confidence_score": scores.get(r["title"], 90.0), "industry_id": 1, "ai_skills": ["a"], "ai_top_tags": ["b"]}
        for r in rows
    ]


@pytest.fixture(scope="module")
def context(spark):
    one = (5, "Nursing", (((9, "Care", (8, "Health", (7, "Services"))),),))
    functions = spark.createDataFrame([(1, [one])], f"industry_id int, job_functions array<{JOB_FUNCTION}>")
    gazetteer = spark.createDataFrame([("MA, US", 42.0, -71.0)], "query string, lat double, lng double")
    return functions, gazetteer


def run(spark, context, rows, stored, when, **feed):
    out = run_feed(
        spark.createDataFrame(rows, MAPPED), Feed(7, "feed", "Appcast", **feed), stored, *context, when,
        Services(attributes, first_function, joined_terms, delay=0.0, batch_rows=1),
    )
    for name in ("open", "review", "rejected", "archive", "mirror", "warehouse", "attribute_cache", "function_cache", "search_cache"):
        setattr(out.stored, name, materialise(getattr(out.stored, name), name))
    return out


def test_two_runs(spark, context):
    kind = "Full-Time"
    first = [
        (1, "Nurse", "Clinic", kind, TEXT, "open", "Boston, MA"),
        (2, "Nurse", "Clinic", kind, TEXT + " always", "open", "Salem, MA"),
        (3, "Trainer", "Clinic", kind, "teach new staff the rules of the house", "open", None),
        (4, "Cook", "Clinic", kind, "cook meals", None, None),
        (5, "Driver", "Clinic", kind, "drive", "open", None),
        (6, "Fails", "Clinic", kind, "no answer for this", "open", None),
        (7, "Old", "Clinic", kind, "gone", "Position filled", None),
        (8, "Leaver", "Clinic", kind, "will leave with the next run", "open", None),
    ]
    one = run(spark, context, first, empty_tables(spark), datetime(2024, 1, 1))
    c = one.counters.first()
    assert c["total_in_feed"] == 8 and c["skipped_closed"] == 1 and c["records_failed"] == 1
    assert (c["jobs_auto_approved"], c["jobs_manual_review"], c["jobs_rejected"]) == (2, 2, 1)
    merged = c["skipped_duplicate_initial_aggregation"] + c["skipped_duplicate_ai_aggregation"] + c["skipped_duplicate"]
    assert merged == 1
    # everything that came in went somewhere
    assert c["total_in_feed"] == c["skipped_closed"] + merged + c["records_failed"] + c["processed_successfully"]
    assert (c["mirror_added"], c["mirror_deleted"], c["jobs_closed"]) == (2, 0, 0)

    stored = one.stored
    nurse = stored.open.filter("title = 'Nurse'").first()
    assert nurse["is_multi_location"] and nurse["location_string"] == "Boston MA US, Salem MA US"
    assert nurse["_geo"]["lat"] == 42.0 and nurse["sector"] == "Services" and nurse["partner_id"] == 6
    assert nurse["searchable_text"] == "b, a" and nurse["status"] == "ACTIVE" and nurse["job_function_id"] == 5
    assert stored.open.columns == list(POSTING)
    assert stored.warehouse.count() == 5
    assert one.payloads.agg(F.sum("batch_rows")).first()[0] == 2
    assert one.search_documents.count() == 2

    second = [r for r in first if r[1] != "Leaver"]
    two = run(spark, context, second, stored, datetime(2024, 1, 2))
    c = two.counters.first()
    assert c["jobs_closed"] == 1 and c["mirror_deleted"] == 1 and c["mirror_added"] == 0
    assert two.stored.open.count() == 1 and two.stored.archive.first()["title"] == "Leaver"
    assert two.stored.warehouse.filter("status = 'ARCHIVED'").count() == 1
    again = two.stored.open.first()
    assert again["created_at"] == datetime(2024, 1, 1) and again["updated_at"] == datetime(2024, 1, 2)
    assert again["bigquery_id"] == nurse["bigquery_id"]
    # the mirror and the open table of the feed hold the same keys
    assert tables.diff(two.stored.open, two.stored.mirror).count() == 0


def test_bypass_skips_merging_and_routing(spark, context):
    rows = [(i, "Cook", "Clinic", "x", "cook meals", "open", None) for i in (1, 2)] + [(3, "Nurse", "Clinic", "x", TEXT, "open", None)]
    out = run(spark, context, rows, empty_tables(spark), datetime(2024, 1, 1), bypass_filters=True)
    c = out.counters.first()
    assert c["skipped_duplicate_initial_aggregation"] == 0 and c["skipped_duplicate"] == 1
    assert c["jobs_auto_approved"] == 2 and c["jobs_rejected"] == 0


def test_failed_postings_stay_stored(spark, context):
    rows = [(1, "Later", "Clinic", "x", "first it works", "open", None)]
    one = run(spark, context, rows, empty_tables(spark), datetime(2024, 1, 1))
    assert one.stored.open.count() == 1
    stored = one.stored
    stored.attribute_cache = stored.attribute_cache.limit(0)

    def down(rows):
        raise ValueError("down")

    out = run_feed(
        spark.createDataFrame(rows, MAPPED), Feed(7, "feed"), stored, *context, datetime(2024, 1, 2), Services(down, first_function, joined_terms, delay=0.0)
    )
    assert out.counters.first()["records_failed"] == 1
    assert out.stored.open.count() == 1


def test_tables_of_earlier_steps_go(spark, context):
    rows = [(i, ("Nurse", "Trainer", "Cook", "Fails", "Old")[i % 5], f"Clinic {i % 3}", "x", f"{TEXT} number {i}", "closed" if i % 5 == 4 else "open", None) for i in range(10)]
    with noted() as written:
        out = run_feed(
            spark.createDataFrame(rows, MAPPED), Feed(7, "feed"), empty_tables(spark), *context, datetime(2024, 1, 1),
            Services(attributes, first_function, joined_terms, delay=0.0, batch_rows=1),
        )
    left = sorted({os.path.basename(path).rsplit("-", 1)[0] for path in written if os.path.isdir(path)})
    wide = {"hashed", "prepared", "texts", "merged", "marked", "asked", "attributed", "selected", "routed"}
    assert not wide & set(left) and {"approved", "review", "rejected", "to_open", "open", "mirror", "answers"} <= set(left)
    # everything the outcome holds can still be read
    states = {r["outcome"]: r["count"] for r in out.outcomes.groupBy("outcome").count().collect()}
    assert states["closed_in_feed"] == 2 and states["failed"] == out.counted["records_failed"]
    assert {name: getattr(out.stored, name).count() for name in ("open", "review", "rejected", "archive", "mirror", "warehouse")} == {
        "open": states["approved"], "review": states["review"], "rejected": states["rejected"], "archive": 0,
        "mirror": states["approved"], "warehouse": out.counted["processed_successfully"],
    }
    assert out.stored.attribute_cache.count() > 0 and out.stored.function_cache.count() > 0 and out.stored.search_cache.count() > 0
    assert out.payloads.agg(F.sum("batch_rows")).first()[0] == states["approved"] == out.search_documents.count()


def with_tokens(rows):
    return attributes(rows), (10 * len(rows), 3)


def feeds_table(spark):
    ddl = (
        "id int, name string, last_run_status string, unique_jobs_processed long, cw_auto_approved_jobs long, avg_processing_time double, avg_feed_size double, "
        "error_count long, consecutive_failure_count long, last_succeeded_at timestamp, last_error_message string, last_checked_at timestamp, updated_at timestamp"
    )
    none = (None,) * 10
    return spark.createDataFrame([(7, "feed", *none, None), (8, "other", *none, None)], ddl)


def ticking(*times):
    left = list(times)
    return lambda: left.pop(0) if len(left) > 1 else left[0]


def test_counters_are_those_of_the_outcomes(spark, context):
    kind = "Full-Time"
    rows = [(i, ("Nurse", "Trainer", "Cook", "Fails", "Old")[i % 5], f"Clinic {i % 11}", kind, f"{TEXT} number {i}", "closed" if i % 5 == 4 else "open", "Boston, MA") for i in range(20)]
    out = run_feed(
        spark.createDataFrame(rows, MAPPED), Feed(7, "feed"), empty_tables(spark), *context, datetime(2024, 1, 1),
        Services(with_tokens, first_function, joined_terms, delay=0.0, batch_rows=1),
    )
    counted = reports.run_counters(out.outcomes, ["feed_id"]).drop("feed_id", "total_in_feed").first().asDict()
    assert counted == {name: out.counted[name] for name in counted}
    c = out.counters.first().asDict()
    assert {k: c[k] for k in out.counted} == out.counted
    # calls that fail are tried three times and bring no tokens
    answered = out.stored.attribute_cache.count()
    assert c["input_tokens"] == 10 * answered and c["output_tokens"] == 3 * answered
    assert c["total_tokens"] == 13 * answered and c["model_calls"] > answered and c["cache_hits"] == 0
    again = run_feed(
        spark.createDataFrame(rows, MAPPED), Feed(7, "feed"), out.stored, *context, datetime(2024, 1, 2),
        Services(attributes, first_function, joined_terms, delay=0.0, batch_rows=1),
    )
    assert again.counted["cache_hits"] > 0 and again.counted["input_tokens"] == 0 and again.counted["mirror_added"] == 0


def test_reported_run(spark, context):
    rows = [(1, "Nurse", "Clinic", "x", TEXT, "open", None), (2, "Cook", "Clinic", "x", "cook meals", "open", None)]
    none = spark.createDataFrame([], reports.REPORT_DDL)

    def go():
        return run_feed(
            spark.createDataFrame(rows, MAPPED), Feed(7, "feed"), empty_tables(spark), *context, datetime(2024, 1, 1),
            Services(attributes, first_function, joined_terms, delay=0.0),
        )

    begun, ended = datetime(2024, 1, 1, 12, 0, 0), datetime(2024, 1, 1, 12, 1, 30)
    out, kept, feeds = reported_run(Feed(7, "feed"), go, none, feeds_table(spark), ticking(begun, ended), 4096)
    row = kept.first()
    assert (row.run_status, row.duration_seconds, row.feed_file_size_bytes, row.error_summary) == ("SUCCESS", 90.0, 4096, None)
    assert (row.total_in_feed, row.jobs_auto_approved, row.jobs_rejected, row.processed_successfully) == (2, 1, 1, 2)
    mine = feeds.filter("id = 7").first()
    assert (mine.last_run_status, mine.unique_jobs_processed, mine.cw_auto_approved_jobs, mine.last_succeeded_at) == ("SUCCESS", 2, 1, begun)
    assert (mine.avg_processing_time, mine.avg_feed_size) == (90.0, 4096.0)
    assert feeds.filter("id = 8").first().last_run_status is None

    def breaks():
        raise ValueError("no such feed")

    later = datetime(2024, 1, 2)
    failed, kept, feeds = reported_run(Feed(7, "feed"), breaks, kept, feeds, ticking(later))
    assert failed is None
    row = kept.filter("run_status = 'FAILURE'").first()
    assert row.error_summary == '["Run failed: no such feed"]' and row.total_in_feed is None and kept.count() == 2
    mine = feeds.filter("id = 7").first()
    assert (mine.last_run_status, mine.consecutive_failure_count, mine.error_count, mine.last_error_message) == ("FAILURE", 1, 1, "Run failed: no such feed")
    assert mine.last_succeeded_at == begun


def test_run_from_feed_files(spark, context, tmp_path):
    jobs = "".join(
        f"<job><title>Nurse</title><company>Clinic {i}</company><kind>Full-Time</kind><text>{TEXT} {i}</text><where>Boston, MA</where></job>\n" for i in range(12)
    )
    (tmp_path / "feed.xml").write_text(f"<source>{jobs}<job><title>cut", encoding="utf-8")
    mappings = {"title": "title", "company": "company_name", "kind": "employment_type", "text": "description", "where": "locations", "status": "status"}
    given = {"functions": context[0], "gazetteer": context[1], "services": Services(attributes, first_function, joined_terms, delay=0.0)}
    none = spark.createDataFrame([], reports.REPORT_DDL)
    out, kept, _ = run_feed_files(
        spark, str(tmp_path / "feed.xml"), mappings, Feed(7, "feed", "Appcast"), empty_tables(spark), none, feeds_table(spark),
        ticking(datetime(2024, 1, 1)), **given,
    )
    row = kept.first()
    assert (row.run_status, row.total_in_feed, row.jobs_auto_approved) == ("SUCCESS", 12, 12)
    assert row.feed_file_size_bytes == (tmp_path / "feed.xml").stat().st_size
    sizes = {a: calls.agg(F.sum("batch_rows")).first()[0] for a, calls in out.calls.items()}
    assert sizes == {"mirror_delete": None, "search_delete": None, "mirror_add": 12, "search_upsert": 12}
    lost, kept, _ = run_feed_files(
        spark, str(tmp_path / "none.xml"), mappings, Feed(7, "feed"), empty_tables(spark), kept, feeds_table(spark), ticking(datetime(2024, 1, 2)), **given
    )
    assert lost is None and kept.filter("run_status = 'FAILURE'").count() == 1
