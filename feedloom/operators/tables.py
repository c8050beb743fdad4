"""Keeping stored tables in step with a feed: upsert, replace, archive, delete, diff and lookups.

All functions return the new content; ``TableStore`` writes it as a new version. A change is usually
far smaller than the table, so nothing here shuffles the table in full when the keys of the change
are small: anti- and semi-joins let Spark broadcast the measured small side, a full outer join
would not.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from feedloom.operators.ordinals import first_per_key, last_per_key
from feedloom.session import materialise

KEY = "job_hash"

# Columns an update leaves alone, in the stores and in the warehouse.
STORE_PROTECTED = ["created_at", "id"]
WAREHOUSE_PROTECTED = ["bigquery_id", "created_at"]

# The states of a posting.
OPEN, REVIEW, REJECTED, ARCHIVED = "ACTIVE", "MANUAL_REVIEW", "REJECTED", "ARCHIVED"


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str = KEY,
    protected: Sequence[str] = STORE_PROTECTED,
    order: str | None = None,
) -> DataFrame:
    """The target after updating matched rows and inserting new ones.

    Columns the source lacks keep their stored value, unknown source columns are ignored, protected
    ones keep the stored value on an update. With ``order`` the last source row of a key counts,
    without it any one of them. Source rows without a key match nothing and are left out.
    """
    source = source.filter(F.col(key).isNotNull())
    source = source.dropDuplicates([key]) if order is None else last_per_key(source, key, order)
    given = [c for c in target.columns if c in source.columns]
    kept = target.join(source.select(key), key, "left_anti").select(*target.columns)
    from_store = [c for c in target.columns if c != key and (c in protected or c not in given)]
    stored = target.select(key, F.lit(True).alias("_stored"), *[F.col(c).alias(f"_old_{c}") for c in from_store])
    joined = source.select(*given).join(stored, key, "left")

    def value(field: T.StructField) -> Column:
        name = field.name
        if name not in from_store:
            out = F.col(name)
        elif name in given:
            out = F.when(F.col("_stored"), F.col(f"_old_{name}")).otherwise(F.col(name))
        else:
            out = F.col(f"_old_{name}")
        return out.cast(field.dataType).alias(name)

    return kept.unionByName(joined.select(*[value(f) for f in target.schema.fields]))


def warehouse_merge(target: DataFrame, source: DataFrame, key: str = KEY) -> DataFrame:
    """Upsert with the protected columns of the warehouse."""
    return upsert(target, source, key, WAREHOUSE_PROTECTED)


def replace_feed(target: DataFrame, source: DataFrame, feed: str = "feed_id") -> DataFrame:
    """All rows of the feeds in ``source`` replaced. Rows without a feed are refused by the caller's schema."""
    if feed not in source.columns:
        raise ValueError(f"cannot replace without {feed}")
    feeds = source.select(feed).filter(F.col(feed).isNotNull()).distinct()
    kept = target.join(feeds, feed, "left_anti").select(*target.columns)
    return kept.unionByName(source.filter(F.col(feed).isNotNull()).select(*target.columns))


def delete_keys(target: DataFrame, keys: DataFrame, key: str = KEY) -> DataFrame:
    return target.join(keys.select(key), key, "left_anti").select(*target.columns)


def rows_of(target: DataFrame, keys: DataFrame, key: str = KEY) -> DataFrame:
    return target.join(keys.select(key), key, "left_semi").select(*target.columns)


def archive(
    open_rows: DataFrame, archived: DataFrame, keys: DataFrame, key: str = KEY
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(open, archive, moved)`` after moving the rows of ``keys``; read all three before writing."""
    moved = rows_of(open_rows, keys, key)
    return delete_keys(open_rows, keys, key), upsert(archived, moved, key), moved


def archive_check(before: DataFrame, after: DataFrame, moved: DataFrame) -> DataFrame:
    """Counts of a move and whether as many rows left the open table as reached the archive."""

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")

    counts = count(before, "before").unionByName(count(after, "after")).unionByName(count(moved, "copied"))

    def of(name: str) -> Column:
        return F.max(F.when(F.col("what") == name, F.col("n")))

    return counts.agg((of("before") - of("after")).alias("deleted"), of("copied").alias("copied")).withColumn(
        "counts_match", F.col("deleted") == F.col("copied")
    )


def approve(
    review: DataFrame, open_rows: DataFrame, keys: DataFrame, run_time: Column, key: str = KEY
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(review, open, approved)`` after moving reviewed postings to the open table as ACTIVE."""
    approved = rows_of(review, keys, key).withColumn("status", F.lit(OPEN)).withColumn("updated_at", run_time)
    return delete_keys(review, keys, key), upsert(open_rows, approved.drop("id"), key), approved


def closed_keys(stored: DataFrame, current: DataFrame, key: str = KEY) -> DataFrame:
    """Stored active keys the feed no longer has."""
    active = stored.filter((F.col("status") == OPEN) & F.col(key).isNotNull()).select(key).distinct()
    return active.join(current.select(key), key, "left_anti")


def diff(left: DataFrame, right: DataFrame, key: str = KEY) -> DataFrame:
    """``(key, action)``: ``add`` for keys only in ``left``, ``delete`` for keys only in ``right``."""
    a = left.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_left", F.lit(True))
    b = right.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_right", F.lit(True))
    both = a.join(b, key, "full_outer")
    action = F.when(F.col("_right").isNull(), "add").when(F.col("_left").isNull(), "delete")
    return both.select(key, action.alias("action")).filter("action IS NOT NULL")


def existing_keys(keys: DataFrame, tables: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    """The distinct given keys that any of the tables holds; each table is reduced before the union."""
    found = None
    for table in tables:
        part = table.select(key).join(keys.select(key), key, "left_semi")
        found = part if found is None else found.unionByName(part)
    return found.distinct()


def stable_id(*parts: str | Column) -> Column:
    """An id in UUID form that depends only on its parts, so a repeated task gives the same id."""
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def with_ids(rows: DataFrame, stored: DataFrame, key: str = KEY, name: str = "bigquery_id") -> DataFrame:
    """The stored id of each row, or a new one that depends only on the key."""
    known = stored.filter(F.col(name).isNotNull()).groupBy(key).agg(F.max(name).alias("_known"))
    joined = rows.drop(name).join(known, key, "left")
    return joined.withColumn(name, F.coalesce("_known", stable_id(key))).drop("_known")


def with_random_ids(rows: DataFrame, name: str) -> DataFrame:
    """Random ids. They are written at once: a second evaluation would give others."""
    return materialise(rows.withColumn(name, F.uuid()), "ids")


def new_rows(rows: DataFrame, stored: DataFrame, order: str, key: str = KEY) -> DataFrame:
    """The first row of each key that is not stored yet."""
    return first_per_key(rows.join(stored.select(key), key, "left_anti").select(*rows.columns), key, order)


def all_states(**states: DataFrame) -> DataFrame:
    """All state tables as one, with a ``state`` column; columns missing somewhere become null."""
    out = None
    for name, rows in states.items():
        part = rows.withColumn("state", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def hash_to_id(mirror: DataFrame, order: str, key: str = KEY, name: str = "eid") -> DataFrame:
    """The last mirrored id per hash; rows without either are left out."""
    both = mirror.filter(F.col(key).isNotNull() & F.col(name).isNotNull())
    return both.groupBy(key).agg(F.max_by(name, order).alias(name))


def purge(stores: dict[str, DataFrame], keys: DataFrame, key: str = KEY) -> tuple[dict[str, DataFrame], DataFrame]:
    """The stores without the keys, and ``(store, deleted)``."""
    remaining, report = {}, None
    for name, table in stores.items():
        remaining[name] = delete_keys(table, keys, key)
        row = rows_of(table, keys, key).agg(F.count(F.lit(1)).alias("deleted")).select(F.lit(name).alias("store"), "deleted")
        report = row if report is None else report.unionByName(row)
    return remaining, report


def merge_into(
    spark: SparkSession, name: str, source: DataFrame, key: str = KEY, protected: Sequence[str] = STORE_PROTECTED
) -> None:
    """The same upsert as MERGE, for catalogs whose tables take row-level changes.

    Only the files that hold matched rows are rewritten, which no full copy can match. Built-in
    Parquet tables refuse MERGE; use ``upsert`` with a ``TableStore`` there.
    """
    columns = [c for c in spark.table(name).columns if c in source.columns]
    changes = {c: F.col(f"s.{c}") for c in columns if c != key and c not in protected}
    merge = source.alias("s").mergeInto(name, F.col(f"{name}.{key}") == F.col(f"s.{key}"))
    merge.whenMatched().update(changes).whenNotMatched().insert({c: F.col(f"s.{c}") for c in columns}).merge()


class TableStore:
    """Versions of one Parquet table below a folder; the highest committed version is the table.

    A version is written in full before its commit marker appears, so readers never see half of it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.schema, self.partition_by = spark, path, schema, list(partition_by)

    def _committed(self) -> int:
        try:
            found = self.spark.read.schema("version int").parquet(os.path.join(self.path, "commits"))
            return found.agg(F.max("version")).first()[0] or 0
        except AnalysisException:
            return 0

    def _version(self, version: int) -> str:
        return os.path.join(self.path, f"v{version}")

    def read(self) -> DataFrame:
        version = self._committed()
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._version(version))

    def _save(self, rows: DataFrame, version: int, mode: str) -> None:
        writer = rows.write.mode(mode)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(self._version(version))

    def write(self, rows: DataFrame) -> int:
        version = self._committed() + 1
        self._save(rows, version, "overwrite")
        marker = self.spark.range(1).select(F.lit(version).cast("int").alias("version"))
        marker.coalesce(1).write.mode("append").parquet(os.path.join(self.path, "commits"))
        return version

    def append(self, rows: DataFrame) -> int:
        """Add rows to the current version without rewriting it."""
        version = self._committed()
        if version == 0:
            return self.write(rows)
        self._save(rows, version, "append")
        return version

    def upsert(self, source: DataFrame, key: str = KEY, protected: Sequence[str] = STORE_PROTECTED) -> int:
        return self.write(upsert(self.read(), source, key, protected))


class BucketedTable:
    """One Parquet table cut into buckets by its key; a small change rewrites only the buckets it meets.

    ``buckets`` bounds the number of folders and the list of touched buckets that steers the read; it is
    part of the stored paths, and a table is refused that was cut into another number. A
    touched bucket is replaced by a partition overwrite after its new content has been written apart.
    Repeating an upsert gives the same table, so a repeated micro-batch does no harm.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: str = KEY, buckets: int = 256):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _with_bucket(self, rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        return rows.withColumn("_buckets", F.lit(self.buckets)).withColumn("_bucket", bucket)

    def _read(self) -> DataFrame:
        extra = [T.StructField(c, T.IntegerType()) for c in ("_buckets", "_bucket")]
        with_bucket = T.StructType([*self.schema.fields, *extra])
        try:
            rows = self.spark.read.schema(with_bucket).parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], with_bucket)
        if not rows.filter(F.col("_buckets") != self.buckets).isEmpty():
            raise ValueError(f"{self.path} is not cut into {self.buckets} buckets")
        return rows

    def read(self) -> DataFrame:
        return self._read().drop("_buckets", "_bucket")

    def upsert(self, source: DataFrame, protected: Sequence[str] = STORE_PROTECTED) -> None:
        rows = materialise(self._with_bucket(source), "change")
        touched = [r["_bucket"] for r in rows.select("_bucket").distinct().collect()]
        if not touched:
            return
        stored = self._read().filter(F.col("_bucket").isin(touched))
        fresh = materialise(upsert(stored, rows, self.key, protected), "buckets")
        # rebalanced, not only repartitioned: a large bucket is split among tasks
        dealt = fresh.hint("rebalance", F.col("_bucket")).write.mode("overwrite")
        dealt.option("partitionOverwriteMode", "dynamic").partitionBy("_buckets", "_bucket").parquet(self.path)


def overwrite_feeds(rows: DataFrame, path: str, feed: str = "feed_id") -> None:
    """Replace the partitions of the feeds in ``rows`` and leave the others untouched."""
    if feed not in rows.columns:
        raise ValueError(f"cannot replace without {feed}")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(feed).parquet(path)
