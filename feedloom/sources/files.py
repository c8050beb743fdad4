"""Other inputs: CSV and JSON files, the mapping configuration, keyed caches and deletion lists."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

# Extension to reader. An unknown extension has none.
READERS = {".csv": "csv", ".json": "json", ".xml": "xml", ".txt": "text", ".parquet": "parquet"}
ARCHIVES = [".zip", ".tar", ".tar.gz", ".tgz", ".gz"]


def extension(path: Column) -> Column:
    """Lower-case extension with its dot, ``.tar.gz`` as a whole, '' when there is none."""
    name = F.lower(F.regexp_extract(path, r"([^/\\]*)$", 1))
    return F.when(name.endswith(".tar.gz"), F.lit(".tar.gz")).otherwise(
        F.regexp_extract(name, r"[^.](\.[^.]*)$", 1)
    )


def reader_of(ext: Column) -> Column:
    """The reader for an extension: a file format, ``archive`` or ``unsupported``."""
    pairs = [F.lit(x) for pair in READERS.items() for x in pair]
    return F.coalesce(
        F.element_at(F.create_map(*pairs), ext),
        F.when(ext.isin(ARCHIVES), F.lit("archive")),
        F.lit("unsupported"),
    )


def read_records(
    spark: SparkSession, path: str, kind: str, schema: T.StructType | str | None = None, row_tag: str = "job"
) -> DataFrame:
    """Records of a CSV file with header, a JSON document or JSON lines, or an XML document."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind == "csv":
        return reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if kind == "json":
        return reader.option("multiLine", True).json(path)
    if kind == "jsonl":
        return reader.json(path)
    if kind == "xml":
        return reader.option("rowTag", row_tag).xml(path)
    raise ValueError(f"unsupported file type: {kind}")


def load_mapping(spark: SparkSession, path: str) -> dict:
    """The mapping configuration ``{mappings, target_schema, target_mapping_options}``.

    A small configuration document, never row data. A missing or damaged one gives empty mappings.
    """
    empty = {"mappings": {}, "target_schema": {}, "target_mapping_options": []}
    try:
        rows = spark.read.option("wholetext", True).text(path).limit(1).collect()
        return {**empty, **json.loads(rows[0]["value"])} if rows else empty
    except (AnalysisException, ValueError):
        return empty


def read_cache(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A keyed cache table, or an empty one when it has not been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def read_deletion_list(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``{hash, eids[]}`` of JSON lines or of one JSON array."""
    return spark.read.schema("hash string, eids array<string>").json(path)


def deletion_keys(deletions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct hashes and the distinct ids of a deletion list."""
    hashes = deletions.select(F.col("hash").alias("job_hash")).filter("job_hash IS NOT NULL").distinct()
    ids = deletions.select(F.explode("eids").alias("eid")).filter("eid IS NOT NULL").distinct()
    return hashes, ids
