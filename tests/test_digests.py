"""The digest tree: equal to plain differences, and reading no more than the changes need."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import digests, tables


def stored(spark, rows, path, depth=1, columns=None):
    return digests.store(spark.createDataFrame(rows, "job_hash string, n long, note string"), str(path), "job_hash", depth, columns)


def plain(left, right):
    def by_key(rows):
        out = {}
        for r in rows:
            if r[0] is not None:
                out.setdefault(r[0], []).append(tuple(map(str, r)))
        return {k: sorted(v) for k, v in out.items()}

    a, b = by_key(left), by_key(right)
    return {(k, "add" if k not in b else "delete" if k not in a else "change") for k in {*a, *b} if a.get(k) != b.get(k)}


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_equals_a_plain_difference(spark, tmp_path, depth):
    draw = random.Random(depth)
    left = [(f"k{i}", i, None if i % 7 else "x") for i in range(400)] + [("k1", 1, "x")] * 2 + [(None, 5, "no key")]
    right = [r for r in left if draw.random() > 0.02] + [(f"new{i}", i, "") for i in range(5)]
    right = [(k, n + 1 if n == 50 else n, "x" if n == 60 else note) for k, n, note in right]
    draw.shuffle(right)
    got = digests.diff_stored(*stored(spark, left, tmp_path / "a", depth), *stored(spark, right, tmp_path / "b", depth), "job_hash", depth)
    assert {tuple(r) for r in got.collect()} == plain(left, right)


def test_only_differing_leaves_are_read(spark, tmp_path):
    left = [(f"k{i}", i, "x") for i in range(5000)]
    right = [r for r in left if r[0] != "k77"] + [("other", 1, "x")]
    a, a_digests = stored(spark, left, tmp_path / "a", 2)
    b, b_digests = stored(spark, right, tmp_path / "b", 2)
    leaves = digests.differing_leaves(a_digests, b_digests)
    assert 1 <= len(leaves) <= 2
    assert digests.leaf_rows(a, leaves).count() < 100
    plan = digests.leaf_rows(a, leaves)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_leaf" in plan.split("PartitionFilters")[1].split("]")[0]
    got = digests.diff_stored(a, a_digests, b, b_digests, "job_hash")
    assert {tuple(r) for r in got.collect()} == {("k77", "add"), ("other", "delete")}
    keys = tables.diff(a, b)
    assert {tuple(r) for r in keys.collect()} == {tuple(r) for r in got.collect()}


def test_order_and_partitions_do_not_matter_but_copies_do(spark, tmp_path):
    rows = [(f"k{i % 50}", i, None) for i in range(500)]
    _, one = stored(spark, rows, tmp_path / "a")
    frame = spark.createDataFrame(rows[::-1], "job_hash string, n long, note string").repartition(7)
    _, two = digests.store(frame, str(tmp_path / "b"), "job_hash", 1)
    assert digests.differing_leaves(one, two, 1) == []
    check = digests.verify_copy(one, two, 1).first()
    assert tuple(check) == (500, 500, True, True, 0)
    _, three = stored(spark, rows + rows[:1] * 2, tmp_path / "c")
    assert tuple(digests.verify_copy(one, three, 1).first()) == (500, 502, False, False, 1)


def test_nulls_are_values_of_their_own(spark):
    rows = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", None, None), ("a", "", "b")], "k string, x string, y string")
    assert rows.select(digests.row_hash(["x", "y"])).distinct().count() == 4


def test_chosen_columns(spark, tmp_path):
    left, right = [("a", 1, "x"), ("b", 2, "y")], [("a", 1, "other"), ("b", 2, "y")]
    a, b = stored(spark, left, tmp_path / "a", columns=["job_hash", "n"]), stored(spark, right, tmp_path / "b", columns=["job_hash", "n"])
    assert digests.diff_stored(*a, *b, "job_hash", 1, ["job_hash", "n"]).collect() == []


def test_empty_tables(spark, tmp_path):
    none, some = stored(spark, [], tmp_path / "a"), stored(spark, [("a", 1, "x")], tmp_path / "b")
    assert digests.diff_stored(*none, *none, "job_hash", 1).collect() == []
    assert [tuple(r) for r in digests.diff_stored(*none, *some, "job_hash", 1).collect()] == [("a", "delete")]
    assert tuple(digests.verify_copy(none[1], none[1], 1).first()) == (0, 0, True, True, 0)


def test_leaves_fill_evenly(spark):
    counts = spark.range(20_000).groupBy(digests.leaf_of("id").alias("leaf")).count()
    assert counts.count() == 256 and counts.agg(F.max("count")).first()[0] < 140
