from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom.operators import audit, enrich, ordinals, publish, reports, routing, tables, taxonomy
from feedloom.session import scratch_path
from feedloom.streaming import runs

ROW = "job_hash string, status string, created_at int, id int"


def as_dict(df, key="job_hash"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_upsert(spark):
    target = spark.createDataFrame([("a", "old", 1, 10), ("b", "old", 1, 11)], ROW)
    source = spark.createDataFrame([("b", "new", 2, 99), ("c", "new", 2, 98)], ROW)
    out = as_dict(tables.upsert(target, source))
    assert out["a"]["status"] == "old"
    assert out["b"] == {"job_hash": "b", "status": "new", "created_at": 1, "id": 11}
    assert out["c"]["created_at"] == 2
    again = as_dict(tables.upsert(tables.upsert(target, source), source))
    assert again == out


def test_upsert_keeps_columns_the_source_lacks(spark):
    target = spark.createDataFrame([("a", "old", 1, 10)], ROW)
    source = spark.createDataFrame([("a", "x"), ("n", "y")], "job_hash string, other string")
    out = as_dict(tables.upsert(target, source))
    assert out["a"]["status"] == "old" and out["n"]["status"] is None


def test_last_source_row_counts(spark):
    target = spark.createDataFrame([], ROW)
    source = spark.createDataFrame([("a", "1", 1), ("a", "2", 2)], "job_hash string, status string, seq int")
    assert as_dict(tables.upsert(target, source, order="seq"))["a"]["status"] == "2"


def test_diff_then_apply_makes_tables_equal(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "job_hash string")
    right = spark.createDataFrame([("b",), ("c",), ("c",)], "job_hash string")
    changes = tables.diff(left, right)
    assert {(r[0], r[1]) for r in changes.collect()} == {("a", "add"), ("c", "delete")}
    kept = tables.delete_keys(right, changes.filter("action = 'delete'"))
    after = kept.unionByName(changes.filter("action = 'add'").select("job_hash"))
    assert tables.diff(left, after).count() == 0


def test_closed(spark):
    stored = spark.createDataFrame([("engineer", "ACTIVE"), ("analyst", "ACTIVE"), ("gone", "CLOSED")], "job_hash string, status string")
    feed = spark.createDataFrame([("engineer",)], "job_hash string")
    assert [r[0] for r in tables.closed_keys(stored, feed).collect()] == ["analyst"]


def test_archive_moves_every_row_once(spark):
    now = spark.createDataFrame([("a", "x", 1, 1), ("b", "x", 1, 2)], ROW)
    old = spark.createDataFrame([("b", "before", 0, 7)], ROW)
    keys = spark.createDataFrame([("b",), ("zzz",)], "job_hash string")
    left, archived, moved = tables.archive(now, old, keys)
    assert [r["job_hash"] for r in left.collect()] == ["a"]
    assert as_dict(archived)["b"] == {"job_hash": "b", "status": "x", "created_at": 0, "id": 7}
    check = tables.archive_check(now, left, moved).first()
    assert check["counts_match"] and check["copied"] == 1


def test_replace_needs_a_feed(spark):
    with pytest.raises(ValueError):
        tables.replace_feed(spark.range(1), spark.range(1))


def test_new_rows(spark):
    feed = spark.createDataFrame([("dup", 1), ("new", 2), ("new", 3)], "job_hash string, seq int")
    stored = spark.createDataFrame([("dup",)], "job_hash string")
    assert [tuple(r) for r in tables.new_rows(feed, stored, "seq").collect()] == [("new", 2)]


def test_store_versions(spark):
    store = tables.TableStore(spark, scratch_path(spark, "store"), ROW)
    assert store.read().count() == 0
    store.write(spark.createDataFrame([("a", "old", 1, 1)], ROW))
    store.upsert(spark.createDataFrame([("a", "new", 9, 9), ("b", "new", 9, 9)], ROW))
    assert as_dict(store.read())["a"] == {"job_hash": "a", "status": "new", "created_at": 1, "id": 1}
    store.append(spark.createDataFrame([("c", "x", 1, 1)], ROW))
    assert store.read().count() == 3


def test_bucketed_table_touches_only_its_buckets(spark):
    table = tables.BucketedTable(spark, scratch_path(spark, "buckets"), ROW, buckets=16)
    assert table.read().count() == 0
    table.upsert(spark.createDataFrame([(f"k{i}", "old", 1, i) for i in range(100)], ROW))
    files = set(table.read().inputFiles())
    change = spark.createDataFrame([("k7", "new", 9, 9), ("zz", "new", 9, 9)], ROW)
    for _ in range(2):
        table.upsert(change)
    got = as_dict(table.read())
    assert len(got) == 101 and got["k7"] == {"job_hash": "k7", "status": "new", "created_at": 1, "id": 7}
    assert got["zz"]["created_at"] == 9
    assert len(files & set(table.read().inputFiles())) >= len(files) - 2


def test_parquet_tables_refuse_merge(spark):
    from pyspark.errors import PySparkException

    spark.createDataFrame([("a", "old", 1, 1)], ROW).write.mode("overwrite").saveAsTable("plain_table")
    try:
        with pytest.raises(PySparkException):
            tables.merge_into(spark, "plain_table", spark.createDataFrame([("a", "new", 2, 2)], ROW))
    finally:
        spark.sql("DROP TABLE plain_table")


def test_overwrite_feeds(spark):
    path = scratch_path(spark, "feeds")
    spark.createDataFrame([(1, "a"), (2, "b")], "feed_id int, k string").write.partitionBy("feed_id").parquet(path)
    tables.overwrite_feeds(spark.createDataFrame([(2, "c")], "feed_id int, k string"), path)
    assert {(r["feed_id"], r["k"]) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "c")}


@pytest.mark.parametrize("width", [1, 3, 100])
def test_ordinals_do_not_depend_on_ranges(spark, width):
    df = spark.createDataFrame([(i, "a" if i % 3 else None) for i in range(0, 50, 2)], "seq long, k string")
    got = ordinals.with_ordinal(df, ["k"], "seq", width=width).collect()
    for key in ("a", None):
        mine = sorted((r["seq"], r["ordinal"]) for r in got if r["k"] == key)
        assert [o for _, o in mine] == list(range(1, len(mine) + 1))


def test_ordinals_without_key_and_by_text(spark):
    df = spark.createDataFrame([(f"{i:03d}",) for i in range(40)], "h string")
    got = ordinals.with_ordinal(df, [], "h", range_of=F.substring("h", 1, 2)).collect()
    assert sorted((r["h"], r["ordinal"]) for r in got) == [(f"{i:03d}", i + 1) for i in range(40)]


def test_batches(spark):
    df = spark.createDataFrame([(i, "k") for i in range(23)], "seq long, k string")
    out = ordinals.batches(df, ["k"], "seq", 10, F.col("seq"))
    got = {r["batch_no"]: list(r["items"]) for r in out.collect()}
    assert got == {1: list(range(10)), 2: list(range(10, 20)), 3: [20, 21, 22]}
    assert tuple(ordinals.batch_totals(out, ["k"]).first()) == ("k", 23, 3)


@pytest.mark.parametrize(
    ("score", "state"),
    [(49.9, "REJECTED"), (50.0, "MANUAL_REVIEW"), (85.9, "MANUAL_REVIEW"), (86.0, "ACTIVE"), (None, "MANUAL_REVIEW")],
)
def test_route(one, score, state):
    assert one(routing.route, "x double", score) == state


def test_route_forms(one):
    assert one(lambda x: routing.route(x, F.lit(True)), "x double", 1.0) == "ACTIVE"
    assert [one(routing.approve_or_review, "x double", s) for s in (0.95, 0.78, None)] == ["approve", "review", "review"]


def answers(spark, n, fn, **options):
    df = spark.createDataFrame([(str(i), i) for i in range(n)], "job_hash string, seq long")
    batched = ordinals.batches(df, [], "seq", 10, F.struct("job_hash", "seq"))
    out = enrich.run_batches(batched, fn, "searchable_text string", delay=0.0, **options)
    return {r["job_hash"]: r for r in out.collect()}


def test_batch_function_sees_whole_batches(spark):
    got = answers(spark, 25, lambda rows: [{"searchable_text": f"{r['seq']}/{len(rows)}"} for r in rows])
    assert got["3"]["result"]["searchable_text"] == "3/10" and got["24"]["result"]["searchable_text"] == "24/5"
    assert sum(r["calls"] for r in got.values()) == 3


def test_too_large_batches_are_halved(spark):
    def fn(rows):
        if len(rows) > 3:
            raise enrich.TooLarge
        if rows[0]["seq"] == 0:
            raise enrich.TooLarge
        return [{"searchable_text": "ok"} for _ in rows]

    got = answers(spark, 10, fn)
    assert got["0"]["ai_enrichment_error"] == enrich.TOO_LARGE
    assert all(got[str(i)]["ai_enrichment_status"] == "success" for i in range(1, 10))


def test_failures_become_rows(spark):
    def fn(rows):
        raise ValueError("x" * 200)

    got = answers(spark, 4, fn)
    assert got["0"]["ai_enrichment_error"] == enrich.BATCH_FAILED + "x" * 100
    assert sum(r["calls"] for r in got.values()) == 3
    short = answers(spark, 4, lambda rows: [{"searchable_text": "a"}])
    assert {r["ai_enrichment_error"] for r in short.values()} == {enrich.MISMATCH}


def test_enrich_uses_the_cache(spark):
    rows = spark.createDataFrame([("a", 1, 5.0), ("b", 2, 6.0), ("b", 3, 7.0)], "job_hash string, seq long, salary_min double")
    cache = spark.createDataFrame([("a", (None, 1))], "job_hash string, result struct<salary_min:double,sector_id:int>")
    out, entries = enrich.enrich(
        rows, cache, lambda batch: [{"salary_min": 1.0, "sector_id": len(batch)} for _ in batch],
        "salary_min double, sector_id int", "seq", [], delay=0.0,
    )
    got = {r["seq"]: r for r in out.collect()}
    assert got[1]["from_cache"] and got[1]["salary_min"] == 5.0 and got[1]["sector_id"] == 1
    assert got[2]["salary_min"] == got[3]["salary_min"] == 1.0
    assert got[2]["sector_id"] == got[3]["sector_id"] == 1
    assert [r["job_hash"] for r in entries.collect()] == ["b"]
    assert enrich.save_cache(cache, entries).count() == 2


def test_enrich_computes_its_rows_once(spark):
    computed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def hashed(seq):
        computed.add(1)
        return "abc"[seq % 3]

    rows = spark.range(12).select(F.col("id").alias("seq"), hashed("id").alias("job_hash"))
    cache = spark.createDataFrame([("a", ("x",))], "job_hash string, result struct<searchable_text:string>")
    out, _ = enrich.enrich(rows, cache, lambda batch: [{"searchable_text": "y"} for _ in batch], enrich.SEARCHABLE, "seq", [], delay=0.0)
    got = {r["seq"]: (r["searchable_text"], r["from_cache"]) for r in out.collect()}
    assert got == {i: ("x", True) if i % 3 == 0 else ("y", False) for i in range(12)}
    assert computed.value == 12


def test_parse_response(one):
    text = '{"selections": [{"job_function_id": 3, "reasoning": "x"}, "no", 5, {"job_function_id": 4}]}'
    got = one(lambda x: enrich.parse_response(x, enrich.SELECTION, "selections"), "x string", text)
    assert [tuple(r) for r in got] == [(3, "x"), (4, None)]


def test_fresh(one):
    week = 7 * 24 * 3600
    assert one(lambda x: enrich.is_fresh(x, F.lit(float(week))), "x double", 1.0) is True
    assert one(lambda x: enrich.is_fresh(x, F.lit(float(week))), "x double", 0.0) is False
    assert one(lambda x: enrich.is_fresh(x, F.lit(1.0)), "x double", None) is False


def test_zip(spark):
    ddl = "b int, items array<string>, results array<int>"
    df = spark.createDataFrame([(1, ["x", "y"], [5, 6]), (2, ["z"], [7, 8])], ddl)
    got = {r["item"]: (r["result"], r["ai_enrichment_status"]) for r in enrich.zip_results(df).collect()}
    assert got == {"x": (5, "success"), "y": (6, "success"), "z": (None, "failed")}


def nested(spark):
    ddl = f"industry_id int, job_functions array<{taxonomy.JOB_FUNCTION}>"
    one = (5, "Nursing", (((9, "Care", (8, "Health", (7, "Services"))),),))
    return spark.createDataFrame([(1, [one])], ddl)


def test_taxonomy(spark):
    functions = nested(spark)
    rows = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "industry_id int, job_function_id int")
    got = taxonomy.attach_names(rows, taxonomy.function_names(functions)).collect()
    assert {(r["job_function_id"], r["sector"], r["industry_group"], r["industry"]) for r in got} == {
        (5, "Services", "Health", "Care"), (6, "", "", ""), (None, "", "", ""),
    }
    listed = {r["industry_id"]: len(r["job_functions"]) for r in taxonomy.attach_functions(rows, functions).collect()}
    assert listed == {1: 1, 2: 0, 3: 0}


def test_send_payloads(spark):
    rows = spark.createDataFrame([(i, str(i)) for i in range(4)], "batch_no long, payload string")

    def send(payload):
        if payload == "3":
            raise TimeoutError
        return {"0": 200, "1": 404, "2": 503}[payload]

    got = {r["batch_no"]: (r["ok"], r["attempts"], r["error"]) for r in publish.send_payloads(rows, send, delay=0.0).collect()}
    assert got == {0: (True, 1, None), 1: (False, 1, "HTTP 404"), 2: (False, 3, "Failed after 3 retries."), 3: (False, 3, "Failed after 3 retries.")}


def test_published_defaults(spark):
    row = publish.published(spark.createDataFrame([("h", "FULL_TIME", 85.9)], "job_hash string, employment_type string, ai_confidence_score double")).first()
    assert len(row) == 43 + 0 and row["employment_type"] == "Full-time" and row["ai_confidence_score"] == 85
    assert row["status"] == "ACTIVE" and row["title"] == "" and row["salary_min"] == 0.0 and row["location"] == []


def test_streaks(spark):
    seq = ["SUCCESS", "FAILURE", "FAILURE", "SUCCESS", "FAILURE"]
    rows = [(1, datetime(2024, 1, i + 1), s, f"e{i}" if s == "FAILURE" else None) for i, s in enumerate(seq)]
    for upto, want in enumerate([0, 1, 2, 0, 1], start=1):
        df = spark.createDataFrame(rows[:upto], "feed_id int, start_time timestamp, run_status string, error_message string")
        out = reports.failure_streaks(df).first()
        assert out["consecutive_failure_count"] == want
    assert out["error_count"] == 3 and out["last_error_message"] == "e4" and out["last_succeeded_at"] == datetime(2024, 1, 4)


def test_last_errors(spark):
    rows = [(1, i, f"e{i}") for i in range(15)]
    out = reports.last_errors(spark.createDataFrame(rows, "feed_id int, at int, error_message string"), ["feed_id"], "at")
    assert out.first()["error_summary"] == [f"e{i}" for i in range(5, 15)]


def test_reports(spark):
    begun = reports.initial_report(3, "f", datetime(2024, 1, 1), spark)
    assert begun.first()["run_status"] == "RUNNING"
    stored = begun.select("id", "feed_id", "run_status", F.lit(None).cast("string").alias("error_summary"))
    done = begun.select("id", F.lit("FAILURE").alias("run_status"), F.array(F.lit("a"), F.lit("b")).alias("error_summary"))
    row = reports.update_reports(stored, done).first()
    assert row["run_status"] == "FAILURE" and row["error_summary"] == '["a","b"]' and row["feed_id"] == 3


def test_verify_copy(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    assert audit.verify_copy(a, a.repartition(3)).first()["rows_match"]
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "i int, s string")
    row = audit.verify_copy(a, b).first()
    assert row["counts_match"] and not row["rows_match"]
    other = audit.verify_copy(a, a.select("i")).first()
    assert not other["schema_match"] and other["source_count"] == 3


def test_stream_upsert_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    schema = "job_hash string, seq long, status string"
    rows = [(f"h{i % 7}", i, f"s{i}") for i in range(40)]
    for part in range(4):
        spark.createDataFrame(rows[part * 10:(part + 1) * 10], schema).coalesce(1).write.mode("append").parquet(str(folder))
    store = tables.BucketedTable(spark, scratch_path(spark, "store"), schema, buckets=4)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    runs.run_into(stream, scratch_path(spark, "progress"), runs.upsert_into(store, "seq")).awaitTermination()
    assert {r["job_hash"] for r in store.read().collect()} == {f"h{i}" for i in range(7)}
    assert {r["job_hash"]: r["seq"] for r in store.read().collect()} == {f"h{i % 7}": i for i in range(40)}
    fresh = tables.TableStore(spark, scratch_path(spark, "store"), schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    runs.run_into(stream, scratch_path(spark, "progress"), runs.append_new_into(fresh, "seq")).awaitTermination()
    assert fresh.read().count() == 7


def test_find_hash_source(spark):
    from feedloom.functions.hashing import base64_sha256

    rows = spark.createDataFrame([(1, "T", "C", "<b>Long</b> text"), (2, "U", "C", "other")], "seq long, title string, company_name string, description string")
    targets = rows.filter("seq = 1").select(base64_sha256(F.lit("T|C|FULL_TIME|long text")).alias("job_hash"))
    got = {(r["id"], r["recipe"]) for r in audit.find_hash_source(rows, targets).collect()}
    assert (1, "title, company, FULL_TIME, clean") in got and {i for i, _ in got} == {1}


def test_upsert_of_repeated_and_missing_keys(spark):
    target = spark.createDataFrame([("a", "old", 1, 1)], ROW)
    source = spark.createDataFrame([("b", "new", 2, 2), ("b", "new", 2, 2), (None, "lost", 3, 3)], ROW)
    got = tables.upsert(target, source)
    assert sorted(r["job_hash"] for r in got.collect()) == ["a", "b"]


def test_a_table_keeps_its_number_of_buckets(spark):
    path = scratch_path(spark, "buckets")
    tables.BucketedTable(spark, path, ROW, buckets=8).upsert(spark.createDataFrame([("a", "old", 1, 1)], ROW))
    with pytest.raises(ValueError):
        tables.BucketedTable(spark, path, ROW, buckets=16).read()


def test_feed_statistics_add_to_the_stored_ones(spark):
    feeds = spark.createDataFrame(
        [(1, 7, 2, "2023-01-01", "old", "2023-06-01"), (2, 3, 1, None, "kept", None)],
        "id int, error_count int, consecutive_failure_count int, last_succeeded_at string, last_error_message string, last_checked_at string",
    )
    feeds = feeds.withColumns({c: F.col(c).cast("timestamp") for c in ("last_succeeded_at", "last_checked_at")})
    runs = spark.createDataFrame(
        [
            (1, "FAILURE", "2023-05-01", "seen before"), (1, "FAILURE", "2023-07-01", "fresh"),
            (2, "FAILURE", "2023-07-01", "e"), (2, "SUCCESS", "2023-07-02", None), (2, "FAILURE", "2023-07-03", "last"),
        ],
        "feed_id int, run_status string, start_time string, error_message string",
    )
    runs = runs.withColumn("start_time", F.col("start_time").cast("timestamp"))
    for c in ("processed_successfully", "jobs_auto_approved", "duration_seconds", "feed_file_size_bytes"):
        runs = runs.withColumn(c, F.lit(1))
    got = {r["id"]: r for r in reports.update_feeds(feeds, runs, F.lit("2024-01-01").cast("timestamp")).collect()}
    assert (got[1]["error_count"], got[1]["consecutive_failure_count"], got[1]["last_error_message"]) == (8, 3, "fresh")
    assert str(got[1]["last_succeeded_at"]) == "2023-01-01 00:00:00"
    assert (got[2]["error_count"], got[2]["consecutive_failure_count"], got[2]["last_error_message"]) == (5, 1, "last")
    again = reports.update_feeds(reports.update_feeds(feeds, runs, F.lit("2024-01-01").cast("timestamp")), runs, F.lit("2024-01-02").cast("timestamp"))
    assert {r["id"]: r["error_count"] for r in again.collect()} == {1: 8, 2: 5}
