"""Comparing large tables by a tree of order-free digests over ranges of hashed keys.

A key's hash names its leaf, a digit of base 16 per level. A leaf's digest is the number of its rows and sums of
their hashes, so it depends on neither order nor partitioning, and the digest of a node is that of its leaves
together. Two tables that are kept with their digests are compared from the root: only below nodes that differ are
the digests of the next level read, and only leaves that differ are read as rows. Stored tables are partitioned by
leaf, so the others are never opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.session import materialise

#: Levels of the tree below its root; a table has 16 ** DEPTH leaves.
DEPTH = 2
LEAF = "_leaf"
_SUMS = ("n", "mixed", "high", "low")


def leaf_of(key: str | Column, depth: int = DEPTH) -> Column:
    """The leaf of a key: the first ``depth`` hexadecimal digits of its hash."""
    col = F.col(key) if isinstance(key, str) else key
    return F.shiftrightunsigned(F.xxhash64(col), 64 - 4 * depth).cast("int")


def with_leaf(rows: DataFrame, key: str, depth: int = DEPTH) -> DataFrame:
    """The rows with their leaf, by which they are stored; rows without a key are in no leaf and left out."""
    return rows.filter(F.col(key).isNotNull()).withColumn(LEAF, leaf_of(key, depth))


def row_hash(columns: Sequence[str]) -> Column:
    """64 bits of a row's content; a null is told apart from every value and from its neighbours."""
    return F.xxhash64(*[part for c in columns for part in (F.col(c).isNull(), F.col(c))])


def digests(leaved: DataFrame, depth: int = DEPTH, columns: Sequence[str] | None = None) -> DataFrame:
    """``(level, node, n, mixed, high, low)`` of all nodes that hold rows, from rows with their leaf.

    ``columns`` are those that count, by default all, in the order of their names. One aggregate over the rows
    gives the leaves, and a few thousand leaves give the rest. Sums of the hashes' halves cannot overflow, and
    with them copies of a row count too, which cancel out in an exclusive or.
    """
    names = sorted(c for c in (columns or leaved.columns) if c != LEAF)
    hashed = leaved.select(LEAF, row_hash(names).alias("h"))
    low = F.col("h").bitwiseAND(F.lit((1 << 32) - 1))
    leaves = hashed.groupBy(F.col(LEAF).alias("node")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("mixed"),
        F.sum(F.shiftrightunsigned("h", 32)).alias("high"), F.sum(low).alias("low"),
    )
    leaves = materialise(leaves, "digests")
    out = leaves.select(F.lit(depth).alias("level"), "node", *_SUMS)
    for level in range(depth - 1, -1, -1):
        node = F.shiftright("node", 4 * (depth - level)).alias("node")
        above = leaves.groupBy(node).agg(
            F.sum("n").alias("n"), F.bit_xor("mixed").alias("mixed"), F.sum("high").alias("high"), F.sum("low").alias("low")
        )
        out = out.unionByName(above.select(F.lit(level).alias("level"), "node", *_SUMS))
    return out


def unequal(left: DataFrame, right: DataFrame) -> DataFrame:
    """The nodes of one level whose digests differ, or which one side lacks."""
    a = left.select("node", F.struct(*_SUMS).alias("a"))
    b = right.select("node", F.struct(*_SUMS).alias("b"))
    return a.join(b, "node", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b"))).select("node")


def differing_leaves(left: DataFrame, right: DataFrame, depth: int = DEPTH) -> list[int]:
    """The leaves that differ, found level by level below the nodes that differ; at most ``16 ** depth`` of them.

    ``left`` and ``right`` are stored digests.
    """
    nodes: list[int] = [0]
    for level in range(depth + 1):
        sides = [side.filter(F.col("level") == level) for side in (left, right)]
        if level:
            wanted = [16 * node + digit for node in nodes for digit in range(16)]
            sides = [side.filter(F.col("node").isin(wanted)) for side in sides]
        nodes = sorted(r["node"] for r in unequal(*sides).collect())
        if not nodes:
            return []
    return nodes


def leaf_rows(leaved: DataFrame, leaves: Sequence[int]) -> DataFrame:
    """The rows of some leaves; of a table that is partitioned by leaf nothing else is read."""
    return leaved.filter(F.col(LEAF).isin(list(leaves)))


def diff_rows(left: DataFrame, right: DataFrame, leaves: Sequence[int], key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``(key, action)`` within some leaves: ``add`` and ``delete`` as ``tables.diff``, ``change`` for other content.

    A key that stands more than once changes where its rows differ as a whole, whatever their order.
    """
    names = sorted(c for c in (columns or left.columns) if c != LEAF)

    def side(rows: DataFrame, name: str) -> DataFrame:
        hashed = leaf_rows(rows, leaves).select(key, row_hash(names).alias("h"))
        low = F.col("h").bitwiseAND(F.lit((1 << 32) - 1))
        return hashed.groupBy(key).agg(F.struct(F.count(F.lit(1)), F.bit_xor("h"), F.sum(F.shiftrightunsigned("h", 32)), F.sum(low)).alias(name))

    both = side(left, "_left").join(side(right, "_right"), key, "full_outer")
    action = (
        F.when(F.col("_right").isNull(), "add").when(F.col("_left").isNull(), "delete")
        .when(F.col("_left") != F.col("_right"), "change")
    )
    return both.select(key, action.alias("action")).filter("action IS NOT NULL")


def diff_stored(
    left: DataFrame, left_digests: DataFrame, right: DataFrame, right_digests: DataFrame, key: str, depth: int = DEPTH,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The difference of two stored tables with stored digests; what is read grows with the changes."""
    return diff_rows(left, right, differing_leaves(left_digests, right_digests, depth), key, columns)


def store(rows: DataFrame, path: str, key: str, depth: int = DEPTH, columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, digests)`` as written below ``path``: rows in a folder per leaf, digests in one per level."""
    leaved = with_leaf(rows, key, depth)
    leaved.hint("rebalance", F.col(LEAF)).write.partitionBy(LEAF).parquet(f"{path}/rows")
    written = rows.sparkSession.read.schema(leaved.schema).parquet(f"{path}/rows")
    tree = digests(written, depth, columns)
    tree.coalesce(1).write.partitionBy("level").parquet(f"{path}/digests")
    return written, rows.sparkSession.read.schema(tree.schema).parquet(f"{path}/digests")


def verify_copy(left_digests: DataFrame, right_digests: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(left_rows, right_rows, counts_match, content_match, differing_leaves)`` of two tables, from their digests."""
    spark = left_digests.sparkSession
    leaves = differing_leaves(left_digests, right_digests, depth)

    def rows(side: DataFrame) -> int:
        return side.filter("level = 0").agg(F.sum("n")).first()[0] or 0

    a, b = rows(left_digests), rows(right_digests)
    out = [(a, b, a == b, not leaves, len(leaves))]
    return spark.createDataFrame(out, "left_rows long, right_rows long, counts_match boolean, content_match boolean, differing_leaves int")
