"""Row numbers, batches and per-key choices that stay spread when one key holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_RANGE = 100_000


def with_ordinal(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    name: str = "ordinal",
    width: int = ROWS_PER_RANGE,
    range_of: Column | None = None,
    total: str | None = None,
) -> DataFrame:
    """Number the rows of each key from 1 in the order of a unique column.

    A plain window would put a whole key into one task. Instead each key is cut into ranges of the
    order column; rows are numbered inside a range, and the counts of the earlier ranges are added.
    The default range is ``order div width`` for an integer column, so a range holds at most
    ``width`` rows. For a text column pass a prefix as ``range_of``: it must not disturb the order.
    ``total`` names a further column for the row count of the key. ``df`` is read twice.
    """
    rng = range_of if range_of is not None else F.expr(f"`{order}` div {width}")
    ranged = df.withColumn("_range", rng)
    parts = [*keys, "_range"]
    sizes = ranged.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *parts,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
    )
    inside = F.row_number().over(Window.partitionBy(*parts).orderBy(order))
    numbered = ranged.withColumn("_inside", inside)
    same = [numbered[c].eqNullSafe(offsets[c]) for c in parts]
    joined = numbered.join(offsets, same, "left")
    counts = [F.col("_total").alias(total)] if total else []
    return joined.select(
        *[numbered[c] for c in df.columns], (F.col("_before") + F.col("_inside")).alias(name), *counts
    )


def with_batch(df: DataFrame, keys: Sequence[str], order: str, size: int, **how) -> DataFrame:
    """Add ``ordinal``, ``batch_no`` counted from 1 inside each key, and the key's ``total_batches``."""
    numbered = with_ordinal(df, keys, order, total="total_batches", **how)
    return numbered.withColumns(
        {
            "batch_no": F.expr(f"CAST((ordinal - 1) div {size} + 1 AS BIGINT)"),
            "total_batches": F.expr(f"CAST((total_batches - 1) div {size} + 1 AS BIGINT)"),
        }
    )


def batches(df: DataFrame, keys: Sequence[str], order: str, size: int, item: Column, **how) -> DataFrame:
    """One row per batch: its number, its row count and its items in order (at most ``size`` of them)."""
    numbered = with_batch(df, keys, order, size, **how)
    pairs = F.array_sort(F.collect_list(F.struct("ordinal", item.alias("item"))))
    return (
        numbered.groupBy(*keys, "batch_no")
        .agg(F.count(F.lit(1)).alias("batch_rows"), pairs.alias("pairs"))
        .withColumn("items", F.transform("pairs", lambda p: p["item"]))
        .drop("pairs")
    )


def batch_totals(batched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and batches per key."""
    return batched.groupBy(*keys).agg(
        F.sum("batch_rows").alias("total_rows"), F.count(F.lit(1)).alias("total_batches")
    )


def region(batch_no: str | Column, regions: Sequence[str]) -> Column:
    """The region that serves a batch: the list is cycled through."""
    col = F.col(batch_no) if isinstance(batch_no, str) else batch_no
    return F.element_at(F.array(*[F.lit(r) for r in regions]), (F.pmod(col - 1, F.lit(len(regions))) + 1).cast("int"))


def last_per_key(df: DataFrame, key: str | Sequence[str], order: str | Column) -> DataFrame:
    """The row with the highest order value of each key.

    ``max_by`` keeps one row per key and task before the shuffle, so many copies of a key cost no
    more than one each.
    """
    return _pick(df, key, order, F.max_by)


def first_per_key(df: DataFrame, key: str | Sequence[str], order: str | Column) -> DataFrame:
    """The row with the lowest order value of each key."""
    return _pick(df, key, order, F.min_by)


def _pick(df: DataFrame, key, order, by) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of each key; Spark keeps only ``limit`` rows per key before the shuffle."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= limit)


def sample_per_key(df: DataFrame, keys: Sequence[str], unique: str, rate: float, minimum: int = 5) -> DataFrame:
    """A repeatable sample of each key: ``rate`` of its rows, at least ``minimum``, in the order of a digest.

    An option for looking at large groups; no operator here depends on it.
    """
    drawn = df.withColumn("_draw", F.sha2(F.col(unique).cast("string"), 256))
    numbered = with_ordinal(
        drawn, keys, "_draw", "_place", range_of=F.substring("_draw", 1, 4), total="_of"
    )
    size = F.greatest(F.floor(F.col("_of") * rate), F.lit(minimum))
    return numbered.filter(F.col("_place") <= size).select(*df.columns)
