"""A Spark sink for services that take batches: one call per row, a key per batch, a journal of outcomes.

``df.write.format(...)`` runs the calls in tasks. Before a batch is sent, the task looks for its key in the
journal, a folder that all executors reach; a batch that was accepted before is not sent again, whether the task,
the stage or the whole write is repeated. The outcome is noted after each call. A task that is lost between the
two sends the batch again under the same key, so the service can tell.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from feedloom.sources.batches import slices

#: ``send(action, batch_key, payload)`` returns a status code; timeouts are raised as ``TimeoutError``.
Send = Callable[[str, str, str], int]

BATCH = "action string, batch_key string, batch_no long, batch_rows long, payload string"
OUTCOME = "action string, batch_key string, batch_no long, batch_rows long, ok boolean, attempts int, error string, partition int"


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the place in it of a URI or a plain path."""
    return fs.FileSystem.from_uri(path)


def send_outcome(call: Callable[[], int], retries: int, delay: float) -> tuple[bool, int, str | None]:
    """``(ok, attempts, error)``: 200 is done, 4xx ends at once, 5xx and timeouts are tried again, later each time."""
    for attempt in range(1, retries + 1):
        try:
            code = call()
        except TimeoutError:
            code = 504
        except Exception as problem:  # noqa: BLE001 - any failure of the user function is an outcome
            return False, attempt, str(problem)
        if code == 200:
            return True, attempt, None
        if 400 <= code < 500:
            return False, attempt, f"HTTP {code}"
        if attempt < retries:
            time.sleep(delay * 2 ** (attempt - 1))
    return False, retries, f"Failed after {retries} retries."


class Journal:
    """Outcomes as one small file per batch, below two characters of its key."""

    def __init__(self, path: str):
        self.store, self.place = store_of(path)
        self.made: set[str] = set()

    def _file(self, key: str) -> str:
        return f"{self.place}/{key[:2]}/{key}.json"

    def accepted(self, key: str) -> bool:
        name = self._file(key)
        if self.store.get_file_info(name).type != fs.FileType.File:
            return False
        with self.store.open_input_file(name) as file:
            try:
                return json.loads(file.read())["ok"]
            except ValueError:  # a task was lost while it wrote this
                return False

    def note(self, key: str, outcome: dict) -> None:
        if key[:2] not in self.made:
            self.store.create_dir(f"{self.place}/{key[:2]}", recursive=True)
            self.made.add(key[:2])
        with self.store.open_output_stream(self._file(key)) as file:
            file.write(json.dumps(outcome).encode())


@dataclass
class Sent(WriterCommitMessage):
    batches: int
    rows: int
    repeated: int
    refused: int


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, send: Send, journal: str, retries: int, delay: float, strict: bool):
        self.send, self.journal, self.retries, self.delay, self.strict = send, journal, retries, delay, strict

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        journal, done = Journal(self.journal), Sent(0, 0, 0, 0)
        place = TaskContext.get().partitionId()
        names = ["action", "batch_key", "batch_no", "batch_rows", "payload"]
        for batch in (piece for whole in iterator for piece in slices(whole.select(names), "payload")):
            for row in batch.to_pylist():
                key, payload = row["batch_key"], row.pop("payload")
                if journal.accepted(key):
                    done.repeated += 1
                    continue
                ok, attempts, error = send_outcome(lambda: self.send(row["action"], key, payload), self.retries, self.delay)
                journal.note(key, {**row, "ok": ok, "attempts": attempts, "error": error, "partition": place})
                done.batches += ok
                done.rows += row["batch_rows"] if ok else 0
                done.refused += not ok
                if not ok and self.strict:
                    raise RuntimeError(f"batch {key} was not accepted: {error}")
        return done

    def commit(self, messages: list[Sent | None]) -> None:
        """Nothing is left to do: a batch counts when the service has taken it."""

    def abort(self, messages: list[Sent | None]) -> None:
        """Accepted batches stay accepted; the journal keeps them out of the next try."""


def batch_sink(name: str, send: Send) -> type[DataSource]:
    """A data source that sends rows of ``BATCH``; register it with ``spark.dataSource.register``.

    Options: ``journal`` (folder), ``retries`` (3), ``delay`` in seconds (5), ``strict`` (a refused batch fails
    the write; otherwise it is an outcome).
    """

    class BatchSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return BATCH

        def writer(self, schema, overwrite: bool) -> BatchWriter:
            missing = {c.split()[0] for c in BATCH.split(", ")} - set(schema.fieldNames())
            if missing or overwrite:
                raise ValueError(f"append rows with {BATCH}" + f"; missing: {sorted(missing)}" * bool(missing))
            get = self.options.get
            return BatchWriter(send, self.options["journal"], int(get("retries", "3")), float(get("delay", "5")), get("strict", "false") == "true")

    return BatchSink


def send_batches(
    batches: DataFrame, send: Send, journal: str, retries: int = 3, delay: float = 5.0, strict: bool = False, at_once: int | None = None
) -> None:
    """Send every row of ``batches``. ``at_once`` bounds the tasks, and so the calls at a time.

    Give a written table: a repeated task must find the same payload under a key.
    """
    spark = batches.sparkSession
    spark.dataSource.register(batch_sink("feedloom_batches", send))
    rows = batches.selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]})" for c in BATCH.split(", ")])
    if at_once is not None:
        rows = rows.coalesce(at_once)
    writer = rows.write.format("feedloom_batches").mode("append").option("journal", journal)
    writer.option("retries", retries).option("delay", delay).option("strict", str(strict).lower()).save()


def outcomes(spark: SparkSession, journal: str) -> DataFrame:
    """The journal as a table, one row per batch with its latest outcome; half-written notes are left out."""
    found = spark.read.schema(OUTCOME).option("recursiveFileLookup", "true").option("mode", "DROPMALFORMED").json(journal)
    return found.filter("batch_key IS NOT NULL AND ok IS NOT NULL")


def totals(sent: DataFrame) -> DataFrame:
    """Batches and rows per action, accepted and not."""
    return sent.groupBy("action").agg(
        F.count_if("ok").alias("batches"), F.count_if(~F.col("ok")).alias("refused"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("batch_rows"))), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~F.col("ok"), F.col("batch_rows"))), F.lit(0)).alias("refused_rows"),
    )


class FolderDrop:
    """A receiver that takes a batch by a file of its own, named by action and key; sent again, it is the same file."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, action: str, key: str, payload: str) -> int:
        store, place = store_of(self.path)
        store.create_dir(f"{place}/{action}", recursive=True)
        with store.open_output_stream(f"{place}/{action}/{key}.json") as file:
            file.write(payload.encode("utf-8"))
        return 200
