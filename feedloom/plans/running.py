"""Queries of streams and of a whole run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from feedloom.plans import feed_run, stand_ins
from feedloom.plans.enriching import functions_of_industries, gazetteer
from feedloom.plans.registry import postings, query
from feedloom.plans.scans import MAPPINGS, TRIMMED, land_feed
from feedloom.operators.tables import BucketedTable, TableStore
from feedloom.session import scratch_path
from feedloom.streaming import runs


@query(
    "st1_stream_feed",
    f"SELECT external_job_id, replace({TRIMMED}, '&', '&amp;') AS description, status FROM postings",
    view=True,
)
def st1(spark, sf):
    """The XML feed read as a stream until all files are worked off."""
    stream = runs.stream_feed(spark, land_feed(spark, sf), MAPPINGS).select("external_job_id", "description", "status")
    path = scratch_path(spark, "streamed")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "progress"))
    writer.trigger(availableNow=True).start(path).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


EVENT_DDL = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event_stream(spark, sf):
    stream = spark.readStream.schema(EVENT_DDL).parquet(f"{sf}/events.parquet*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "st2_stream_upsert",
    "SELECT CAST(user_id AS VARCHAR) AS job_hash, max(event_id) AS event_id, arg_max(event_type, event_id) AS status FROM events GROUP BY user_id",
)
def st2(spark, sf):
    """The last event of every user, upserted micro-batch by micro-batch."""
    rows = event_stream(spark, sf).select(
        F.col("user_id").cast("string").alias("job_hash"), "event_id", F.col("event_type").alias("status")
    )
    store = BucketedTable(spark, scratch_path(spark, "table"), "job_hash string, event_id long, status string", buckets=8)
    runs.run_into(rows, scratch_path(spark, "progress"), runs.upsert_into(store, "event_id")).awaitTermination()
    return store.read()


@query(
    "st3_stream_new_only",
    "SELECT CAST(user_id AS VARCHAR) AS job_hash, min(event_id) AS event_id FROM events GROUP BY user_id",
)
def st3(spark, sf):
    """The first event of every user; later ones are skipped against the table."""
    rows = event_stream(spark, sf).select(F.col("user_id").cast("string").alias("job_hash"), "event_id")
    store = TableStore(spark, scratch_path(spark, "table"), "job_hash string, event_id long")
    runs.run_into(rows, scratch_path(spark, "progress"), runs.append_new_into(store, "event_id")).awaitTermination()
    return store.read()


@query(
    "st3_stream_distinct",
    "SELECT DISTINCT user_id, event_type FROM events",
)
def st3_distinct(spark, sf):
    """Each pair once, as long as its copies arrive within the delay of the watermark."""
    keyed = event_stream(spark, sf).withColumn("job_hash", F.concat_ws("|", "user_id", "event_type"))
    stream = runs.distinct_postings(keyed, "ts", "60 days").select("user_id", "event_type")
    path = scratch_path(spark, "streamed")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "progress"))
    writer.trigger(availableNow=True).start(path).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def no_wait() -> feed_run.Services:
    return feed_run.Services(stand_ins.keyword_rules, stand_ins.first_function, stand_ins.joined_terms, delay=0.0)


@query("e1_feed_run")
def e1(spark, sf):
    """All postings as one feed: scan to tables, mirror and report; the counters of the run."""
    mapped = postings(spark, sf).drop("feed_id", "ai_confidence_score", "industry_id")
    feed = feed_run.Feed(7, "all postings", "Appcast")
    out = feed_run.run_feed(
        mapped, feed, feed_run.empty_tables(spark), functions_of_industries(spark, sf), gazetteer(spark),
        datetime(2024, 2, 1), no_wait(),
    )
    return out.counters


