"""The batch sink: keys, repeats, refusals, and a whole sync in order."""

import json
import sys
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from feedloom.operators import publish
from feedloom.session import materialise
from feedloom.sources import batches, sinks

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Notes:
    """A receiver that notes every call in a file of its own, and may fail on the first ones."""

    def __init__(self, path, codes=(200,)):
        self.path, self.codes = str(path), codes

    def __call__(self, action, key, payload):
        import os
        import uuid

        os.makedirs(self.path, exist_ok=True)
        before = sum(name.startswith(key) for name in os.listdir(self.path))
        with open(f"{self.path}/{key}-{uuid.uuid4().hex}", "w") as file:
            file.write(json.dumps([action, payload]))
        code = self.codes[min(before, len(self.codes) - 1)]
        if code == 0:
            raise TimeoutError
        if code < 0:
            raise KeyError("no such place")
        return code

    def calls(self):
        return [(p.name[:64], *json.loads(p.read_text())) for p in Path(self.path).iterdir()] if Path(self.path).exists() else []


def calls_of(spark, n=1000, run="r1"):
    rows = spark.range(n).select(F.col("id"), (F.col("id") % 3).alias("k"))
    return materialise(publish.action_batches(rows, "search_upsert", run, "id", keys=("k",)), "calls")


def test_batches_hold_every_row_once(spark):
    calls = calls_of(spark, 1000).collect()
    assert Counter(r.batch_rows for r in calls) == {100: 9, 34: 1, 33: 2}
    assert len({r.batch_key for r in calls}) == 12
    found = [json.loads(r.payload)["documents"] for r in calls]
    assert sorted(x for part in found for x in part) == list(range(1000))
    assert all(part == sorted(part) and {x % 3 for x in part} == {r.k} for part, r in zip(found, calls))


def test_a_repeated_write_sends_nothing_twice(spark, tmp_path):
    calls, receiver, journal = calls_of(spark), Notes(tmp_path / "got"), str(tmp_path / "journal")
    for _ in range(2):
        sinks.send_batches(calls.repartition(5), receiver, journal)
    got = receiver.calls()
    assert sorted(k for k, *_ in got) == sorted(r.batch_key for r in calls.collect())
    assert {a for _, a, _ in got} == {"search_upsert"}
    assert sinks.totals(sinks.outcomes(spark, journal)).collect()[0][1:] == (12, 0, 1000, 0)
    sinks.send_batches(calls_of(spark, run="r2"), receiver, journal)  # another run is another call
    assert len(receiver.calls()) == 24


def test_a_task_that_fails_goes_on_where_it_was(spark, tmp_path):
    """The write fails in the middle; the next try sends the rest alone."""
    calls, journal = calls_of(spark).orderBy("batch_no", "k").coalesce(1), str(tmp_path / "journal")

    class Breaks(Notes):
        def __call__(self, action, key, payload):
            return 404 if len(self.calls()) == 5 else super().__call__(action, key, payload)

    first = Breaks(tmp_path / "got")
    with pytest.raises(Exception, match="was not accepted"):
        sinks.send_batches(calls, first, journal, strict=True)
    assert len(first.calls()) == 5
    sinks.send_batches(calls, Notes(tmp_path / "got"), journal)
    assert Counter(Counter(k for k, *_ in first.calls()).values()) == {1: 12}
    assert sinks.outcomes(spark, journal).filter("NOT ok").count() == 0


@pytest.mark.parametrize(
    "codes, ok, attempts, error, calls",
    [
        ((200,), True, 1, None, 1), ((503, 0, 200), True, 3, None, 3), ((404,), False, 1, "HTTP 404", 1),
        ((503,), False, 3, "Failed after 3 retries.", 3), ((-1,), False, 1, "'no such place'", 1),
    ],
)
def test_outcomes(spark, tmp_path, codes, ok, attempts, error, calls):
    receiver, journal = Notes(tmp_path / "got", codes), str(tmp_path / "journal")
    sinks.send_batches(calls_of(spark, 30).filter("k = 0"), receiver, journal, delay=0.0)
    row = sinks.outcomes(spark, journal).first()
    assert (row.ok, row.attempts, row.error) == (ok, attempts, error)
    assert len(receiver.calls()) == calls
    if not ok:  # a refused batch is tried again by the next write
        sinks.send_batches(calls_of(spark, 30).filter("k = 0"), Notes(tmp_path / "got"), journal, delay=0.0)
        assert sinks.outcomes(spark, journal).first().ok


def test_a_half_written_note_does_not_count(spark, tmp_path):
    calls, receiver, journal = calls_of(spark, 3), Notes(tmp_path / "got"), tmp_path / "journal"
    key = calls.first().batch_key
    (journal / key[:2]).mkdir(parents=True)
    (journal / key[:2] / f"{key}.json").write_text('{"action": "search_up')
    assert sinks.outcomes(spark, str(journal)).count() == 0
    sinks.send_batches(calls, receiver, str(journal))
    assert len(receiver.calls()) == 3 and sinks.outcomes(spark, str(journal)).filter("ok").count() == 3


def test_whole_sync(spark, tmp_path):
    hashed = spark.range(260).select(F.sha2(F.col("id").cast("string"), 256).alias("job_hash"), F.col("id").alias("n"))
    documents = hashed.select(F.col("job_hash").alias("id"), F.struct("n").alias("content"))
    gone = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "job_hash string")
    calls = publish.sync_batches("r", hashed, gone, documents, gone.select(F.col("job_hash").alias("id")))
    assert list(calls) == ["mirror_delete", "search_delete", "mirror_add", "search_upsert"]
    receiver = Notes(tmp_path / "got")
    sent = {r.action: tuple(r)[1:] for r in sinks.totals(publish.sync(calls, receiver, str(tmp_path / "journal"), at_once=1)).collect()}
    assert sent == {"mirror_delete": (1, 0, 2, 0), "search_delete": (1, 0, 2, 0), "mirror_add": (2, 0, 260, 0), "search_upsert": (3, 0, 260, 0)}
    payloads = {a: json.loads(p) for _, a, p in receiver.calls() if a.endswith("delete")}
    assert payloads == {"mirror_delete": {"job_hashes": ["a", "b"]}, "search_delete": {"ids": ["a", "b"]}}
    added = [x for _, a, p in receiver.calls() if a == "mirror_add" for x in json.loads(p)["job_postings"]]
    assert sorted(x["n"] for x in added) == list(range(260))


def test_nothing_to_send(spark, tmp_path):
    sinks.send_batches(calls_of(spark, 0), Notes(tmp_path / "got"), str(tmp_path / "journal"))
    assert Notes(tmp_path / "got").calls() == []


def test_rows_of_another_shape_are_refused(spark, tmp_path):
    spark.dataSource.register(sinks.batch_sink("shape_test", Notes(tmp_path)))
    with pytest.raises(Exception, match="missing"):
        spark.range(3).write.format("shape_test").mode("append").option("journal", str(tmp_path)).save()


def test_payloads_are_python_values_piece_by_piece(tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": staticmethod(lambda: 0)}))}))
    sizes, sent = [], []

    def noted(whole, column, *size):
        for piece in batches.slices(whole, column, *size):
            sizes.append(sum(len(x) for x in piece.column("payload").to_pylist()))
            yield piece

    monkeypatch.setattr(sinks, "slices", noted)
    columns = {"action": ["add"] * 50, "batch_key": [f"{i:064x}" for i in range(50)], "batch_no": list(range(50)), "batch_rows": [1] * 50, "payload": ["p" * 90_000] * 50}
    writer = sinks.BatchWriter(lambda action, key, payload: sent.append(key) or 200, str(tmp_path), 1, 0.0, True)
    done = writer.write(iter([pa.RecordBatch.from_pydict(columns)]))
    assert sent == columns["batch_key"] and done.batches == 50
    assert len(sizes) > 1 and max(sizes) <= batches.SLICE_BYTES
