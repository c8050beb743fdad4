"""Feeds as streams: scan new files, upsert each micro-batch, skip what is already known."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feedloom.operators.ordinals import first_per_key, last_per_key
from feedloom.operators.tables import KEY, BucketedTable, TableStore
from feedloom.sources.feeds import mapped_postings, parse_fragments, stream_fragments


def stream_feed(spark: SparkSession, path: str, mappings: Mapping[str, str]) -> DataFrame:
    """Postings of every new feed file below ``path``; the same stateless steps as the batch scan."""
    return mapped_postings(parse_fragments(stream_fragments(spark, path), list(mappings)), mappings)


def distinct_postings(stream: DataFrame, event_time: str, delay: str, key: str = KEY) -> DataFrame:
    """Each key once as long as its copies arrive within ``delay``; older keys leave the state."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def run_into(
    stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], once: bool = True
) -> StreamingQuery:
    """Hand every micro-batch to ``each``. ``once`` works off what is there and stops."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def upsert_into(table: BucketedTable, order: str) -> Callable[[DataFrame, int], None]:
    """Upsert micro-batches; each rewrites only the buckets it meets, and may safely be repeated."""

    def each(batch: DataFrame, _: int) -> None:
        table.upsert(last_per_key(batch, table.key, order))

    return each


def append_new_into(store: TableStore, order: str, key: str = KEY) -> Callable[[DataFrame, int], None]:
    """Append the first row of every key the table does not hold yet."""

    def each(batch: DataFrame, _: int) -> None:
        stored = store.read()
        fresh = first_per_key(batch.join(stored.select(key), key, "left_anti"), key, order)
        store.append(fresh.select(*stored.columns))

    return each
