"""Session helpers: settings, the shared scratch folder and written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_local_scratch: dict[str, str] = {}
#: By thread; a plain dictionary, as this module is pickled by value.
_noting: dict[int, list[list[str]]] = {}

#: Has Spark drop the shuffle files of a query at its end; without it they stay until the driver collects garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str = "local[*]", name: str = "feedloom", **conf: str) -> SparkSession:
    """A session with the settings every operator here relies on (UTC and adaptive execution)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="feedloom-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), "feedloom", f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, keeps column pruning and gives the next plan real
    sizes. Use it after costly or non-deterministic steps and inside loops. The shuffle files behind the
    table go once it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    for paths in _noting.get(threading.get_ident(), ()):
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths that ``materialise`` writes in this block, for ``discard`` once nothing reads them any more."""
    paths: list[str] = []
    mine = _noting.setdefault(threading.get_ident(), [])
    mine.append(paths)
    try:
        yield paths
    finally:
        mine.pop()


def discard(spark: SparkSession, paths: Iterable[str], *kept: DataFrame) -> None:
    """Remove written tables of :func:`noted`, all but those that a table of ``kept`` still reads."""
    read = {os.path.basename(os.path.dirname(file)) for df in kept for file in df.inputFiles()}
    for path in paths:
        if os.path.basename(path) not in read:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def materialise_observed(df: DataFrame, label: str, **measures: Column) -> tuple[DataFrame, dict[str, int]]:
    """``materialise`` with aggregates of the rows, taken while they are written and not by another scan.

    The measures are observed in the tasks that write, so a task that is run again counts once. A measure of no
    rows is 0.
    """
    seen = Observation(label)
    observed = df.observe(seen, *[measure.alias(name) for name, measure in measures.items()])
    written = materialise(observed, label)
    found = seen.get
    return written, {name: found[name] or 0 for name in measures}
