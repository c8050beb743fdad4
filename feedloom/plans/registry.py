"""The registered queries: a Spark form over the driver tables and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.sources.tables import read_table, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The posting view over ``documents``; this text runs in Spark SQL and in the oracle alike.
POSTING_COLUMNS = """
    doc_id AS seq,
    concat('ext-', CAST(doc_id AS STRING)) AS external_job_id,
    CAST(1 + doc_id % 5 AS INT) AS feed_id,
    regexp_extract(lower(text), '^[^ ]+ [^ ]+', 0) AS title,
    lang AS company_name,
    CASE WHEN lang = 'en' THEN 'Full-Time' ELSE 'part time' END AS employment_type,
    text AS description,
    CASE doc_id % 7 WHEN 0 THEN 'Position filled' WHEN 1 THEN 'open' WHEN 2 THEN 'EXPIRED'
         WHEN 3 THEN CAST(NULL AS STRING) ELSE 'active' END AS status,
    CASE doc_id % 6 WHEN 0 THEN 'Boston, MA, USA' WHEN 1 THEN 'Seattle, WA' WHEN 2 THEN 'Remote'
         WHEN 3 THEN CAST(NULL AS STRING) WHEN 4 THEN 'Paris, IDF, France' ELSE 'a, b, c, d' END AS locations,
    CASE doc_id % 3 WHEN 0 THEN CAST(40000 + (doc_id % 50) * 1000 AS STRING) WHEN 1 THEN 'n/a'
         ELSE CAST(NULL AS STRING) END AS salary_min,
    CASE doc_id % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN '1' WHEN 2 THEN 'false'
         ELSE CAST(NULL AS STRING) END AS is_remote,
    CASE WHEN doc_id % 11 = 0 THEN CAST(NULL AS DOUBLE)
         ELSE CAST((doc_id * 37) % 101 AS DOUBLE) END AS ai_confidence_score,
    CAST(1 + doc_id % 8 AS INT) AS industry_id
"""

# The canonical hash of the view, written for the oracle.
CLEAN_SQL = (
    "lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '<[^>]+>', ' ', 'g'), "
    "'https?://\\S+', ' ', 'g'), '[^a-zA-Z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')))"
)
HASH_SQL = (
    "to_base64(unhex(sha256(concat_ws('|', trim(title), trim(company_name), CASE WHEN contains("
    "upper(employment_type), 'FULL') THEN 'FULL_TIME' ELSE 'PART_TIME' END, " + CLEAN_SQL.format("description") + "))))"
)
CLOSED_SQL = "coalesce(regexp_matches(lower(status), 'closed|expired|filled|inactive|not available'), false)"

POSTINGS_SQL = f"""postings AS (SELECT {POSTING_COLUMNS} FROM documents),
hashed AS (SELECT *, {HASH_SQL} AS job_hash FROM postings)"""


def query(name: str, sql: str | None = None, view: bool = False):
    """Register a query; ``view=True`` puts the posting view before the oracle text."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = f"WITH {POSTINGS_SQL}{',' if sql.lstrip().startswith('+') else ''} {sql.lstrip().lstrip('+')}" if view else sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"), "doc_id")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "pages"), "page_id")


def select_sql(df: DataFrame, columns: str) -> DataFrame:
    """Select a list of SQL expressions."""
    return df.sparkSession.sql(f"SELECT {columns} FROM {{source}}", source=df)


def postings(spark: SparkSession, sf: str) -> DataFrame:
    """The posting view, spread for costly text work."""
    return select_sql(documents(spark, sf), POSTING_COLUMNS)


def light_postings(spark: SparkSession, sf: str) -> DataFrame:
    """The posting view straight from the scan, for work that does not touch the long texts."""
    return select_sql(table(spark, sf, "documents"), POSTING_COLUMNS)


def hashed_postings(spark: SparkSession, sf: str) -> DataFrame:
    from feedloom.functions.hashing import canonical_hash

    return postings(spark, sf).withColumn("job_hash", canonical_hash())
