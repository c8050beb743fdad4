"""Catalog tables bucketed and sorted by their key, so that the large side of an upsert or a test never moves.

A bucketed table is read as it is dealt: a join or an aggregate on the key shuffles the other, smaller side into as
many buckets and meets the table bucket by bucket. The result of an upsert is dealt alike and is written to the
next version without a shuffle. The table's name is a view on its current version, replaced in one catalog step,
so a reader sees one version or the other.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.ordinals import last_per_key
from feedloom.operators.tables import KEY, OPEN, STORE_PROTECTED
from feedloom.session import scratch_path


def save(rows: DataFrame, name: str, key: str = KEY, buckets: int = 200, path: str | None = None, dealt: bool = False) -> None:
    """Write ``rows`` as a new table of one sorted file per bucket; ``dealt`` rows are dealt by the key already."""
    rows = rows if dealt else rows.repartition(buckets, key)
    writer = rows.write.bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def merged(target: DataFrame, source: DataFrame, key: str = KEY, protected: Sequence[str] = STORE_PROTECTED, order: str | None = None) -> DataFrame:
    """The content of ``tables.upsert`` by one full outer join, which reads a bucketed target once and in place.

    Without ``order`` keys of the source must be unique; a repeated one is refused, as which row counts would be
    chance. Rows of the target without a key stay, those of the source are left out.
    """
    source = source.filter(F.col(key).isNotNull())
    if order is not None:
        source = last_per_key(source, key, order)
    else:
        times = source.groupBy(key).agg(F.count(F.lit(1)).alias("_times"), F.first(F.struct(*source.columns)).alias("_row"))
        once = F.when(F.col("_times") == 1, F.col("_row")).otherwise(F.raise_error(F.concat(F.lit("more than one row of "), F.col(key).cast("string"))))
        source = times.select(once.alias("_row")).select("_row.*")
    given = [c for c in target.columns if c in source.columns]
    changes = source.select(F.col(key).alias("_key"), F.struct(*[c for c in given]).alias("_new"))
    stored = target.withColumn("_stored", F.lit(True))
    joined = stored.join(changes, stored[key] == changes["_key"], "full_outer")

    def value(name: str) -> Column:
        if name == key:
            return F.coalesce(F.col(key), F.col("_key"))
        if name not in given:
            return F.col(name)
        if name in protected:
            return F.when(F.col("_stored"), F.col(name)).otherwise(F.col(f"_new.{name}"))
        return F.when(F.col("_key").isNull(), F.col(name)).otherwise(F.col(f"_new.{name}"))

    return joined.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])


def closed_keys(stored: DataFrame, current: DataFrame, key: str = KEY) -> DataFrame:
    """As ``tables.closed_keys``, with the stored side first distinct and then met in place."""
    active = stored.filter((F.col("status") == OPEN) & F.col(key).isNotNull()).select(key).distinct()
    return active.hint("merge").join(current.select(key).hint("merge"), key, "left_anti")


class Versions:
    """Versions of a bucketed table behind a view of the table's name."""

    def __init__(self, spark: SparkSession, name: str, key: str = KEY, buckets: int = 200, folder: str | None = None):
        if not re.fullmatch(r"\w+(\.\w+)*", name):
            raise ValueError(f"no table name: {name}")
        self.spark, self.name, self.key, self.buckets = spark, name, key, buckets
        self.folder = folder or scratch_path(spark, "bucketed")

    def current(self) -> int:
        """The number of the version behind the view, 0 without one."""
        if not self.spark.catalog.tableExists(self.name):
            return 0
        text = self.spark.sql(f"SHOW CREATE TABLE {self.name}").first()[0]
        return int(re.search(r"_version_(\d+)", text)[1])

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def write(self, rows: DataFrame, dealt: bool = False) -> int:
        """Make ``rows`` the next version; the one before it stays for readers, older ones are dropped."""
        last = self.current()
        version = f"{self.name}_version_{last + 1}"
        self.spark.sql(f"DROP TABLE IF EXISTS {version}")  # of a write that did not end
        save(rows, version, self.key, self.buckets, f"{self.folder}/{last + 1}", dealt)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM {version}")
        if last > 1:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_version_{last - 1}")
        return last + 1

    def upsert(self, source: DataFrame, protected: Sequence[str] = STORE_PROTECTED, order: str | None = None) -> int:
        """Upsert into the table; only the source is shuffled."""
        return self.write(merged(self.read(), source, self.key, protected, order), dealt=True)
