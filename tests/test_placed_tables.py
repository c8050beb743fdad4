"""Bucketed tables that stay in place, and key filters in front of shuffles."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from feedloom.operators import bucketed, keytests, tables
from feedloom.session import materialise

LAYOUT = "job_hash string, status string, n long, id long, created_at string"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def table(spark, rows):
    return spark.createDataFrame(rows, LAYOUT)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def store(spark, rows, buckets=4):
    versions = bucketed.Versions(spark, f"t_{uuid.uuid4().hex}", buckets=buckets)
    versions.write(table(spark, rows))
    return versions


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning"), plan


def test_upsert_equals_the_plain_one(spark, no_broadcast):
    draw = random.Random(2)
    stored = [(f"k{i}", "ACTIVE", i, i, "old") for i in range(200)] + [(None, "ACTIVE", 1, 1, "no key")]
    fed = [(f"k{draw.randint(0, 300)}", "CLOSED", i, None, "new") for i in range(150)] + [(None, "x", 1, 1, "new")]
    versions = store(spark, stored)
    source = table(spark, fed)
    wanted = rows_of(tables.upsert(table(spark, stored), source, order="n"))
    out = bucketed.merged(versions.read(), source, order="n")
    assert rows_of(out) == wanted
    n, plan = exchanges(out)
    assert n == 1, plan  # the source's own; the table is met where it lies
    assert versions.upsert(source, order="n") == 2 and rows_of(versions.read()) == wanted
    versions.upsert(source, order="n")  # once more changes nothing
    assert versions.current() == 3 and rows_of(versions.read()) == wanted


def test_repeated_keys_without_order_are_refused(spark):
    versions = store(spark, [("a", "ACTIVE", 1, 1, "old")])
    with pytest.raises(Exception, match="more than one row of b"):
        bucketed.merged(versions.read(), table(spark, [("b", "x", 1, 1, ""), ("b", "y", 2, 2, "")])).collect()
    fewer = spark.createDataFrame([("a", 7)], "job_hash string, n long")
    assert rows_of(bucketed.merged(versions.read(), fewer)) == [("a", "ACTIVE", 7, 1, "old")]


def test_a_version_is_read_while_the_next_is_written(spark):
    versions = store(spark, [("a", "ACTIVE", 1, 1, "")])
    before = versions.read()
    versions.write(table(spark, [("b", "ACTIVE", 2, 2, "")]))
    assert rows_of(before) == [("a", "ACTIVE", 1, 1, "")] and rows_of(versions.read()) == [("b", "ACTIVE", 2, 2, "")]
    versions.write(table(spark, []))
    assert rows_of(versions.read()) == []
    with pytest.raises(ValueError):
        bucketed.Versions(spark, "a; DROP TABLE b")


def test_closed_keys_in_place(spark, no_broadcast):
    stored = [(f"k{i}", "ACTIVE" if i % 3 else "CLOSED", i, i, "") for i in range(100)]
    current = table(spark, [(f"k{i}", "x", i, i, "") for i in range(0, 100, 2)])
    out = bucketed.closed_keys(store(spark, stored).read(), current)
    assert rows_of(out) == rows_of(tables.closed_keys(table(spark, stored), current))
    n, plan = exchanges(out)
    assert n == 1, plan


def test_filter_loses_nothing_and_lets_little_else_through(spark, no_broadcast):
    store_rows = materialise(spark.range(200_000).select(F.concat(F.lit("k"), "id").alias("job_hash"), F.col("id").alias("n")), "store")
    keys = spark.range(0, 400_000, 20).select(F.concat(F.lit("k"), "id").alias("job_hash"))
    hits = store_rows.join(keys, "job_hash", "left_semi").count()
    passed = keytests.possible(store_rows, keytests.key_filter(keys)).count()
    assert hits == 10_000 and hits <= passed <= hits + 0.02 * 200_000
    assert keytests.rows_of(store_rows, keys).count() == hits
    assert "BroadcastHashJoin" in keytests.possible(store_rows, keytests.key_filter(keys))._jdf.queryExecution().executedPlan().toString()
    small = keytests.possible(store_rows, keytests.key_filter(keys, most_words=4)).count()
    assert hits <= small <= 200_000  # a full filter lets all through, and the join behind it stays exact


@pytest.mark.parametrize("n", [0, 1, 3, 500])
def test_key_tests_equal_the_plain_ones(spark, n):
    draw = random.Random(n)
    rows = [(f"k{draw.randint(0, 900)}", "ACTIVE", i, i, "") for i in range(n)] + [(None, "ACTIVE", -1, 1, "")] * 2
    stored = [(f"k{draw.randint(0, 900)}", "ACTIVE", i, i, "") for i in range(300)] + [(None, "ACTIVE", -1, 1, "")]
    a, b, c = table(spark, rows), table(spark, stored), table(spark, stored[:40])
    assert rows_of(keytests.rows_of(b, a)) == rows_of(tables.rows_of(b, a))
    assert rows_of(keytests.existing_keys(a, [b, c])) == rows_of(tables.existing_keys(a, [b, c]))
    assert rows_of(keytests.new_rows(a, b, "n")) == rows_of(tables.new_rows(a, b, "n"))
    assert rows_of(keytests.closed_keys(b, a)) == rows_of(tables.closed_keys(b, a))
