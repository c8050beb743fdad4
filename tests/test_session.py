import os
import time

from pyspark import cloudpickle
from pyspark.sql import functions as F

from feedloom.session import discard, materialise, noted


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_written_table(spark):
    before = shuffle_files(spark)
    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    written = materialise(rows.groupBy("text").agg(F.max("id").alias("id")).repartition(3), "kept")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert written.count() == 20_000 and written.agg(F.sum("id")).first()[0] == 19_999 * 10_000


def test_discarded_tables_go_unless_something_reads_them(spark):
    with noted() as outer:
        first = materialise(spark.range(10), "first")
        with noted() as inner:
            second = materialise(first.filter("id > 3"), "second")
    unnoted = materialise(spark.range(3), "unnoted")
    assert len(outer) == 2 and inner == outer[1:]
    lazy = second.groupBy((F.col("id") % 2).alias("k")).count()
    discard(spark, outer, lazy)
    assert [os.path.isdir(path) for path in outer] == [False, True]
    assert {r["k"]: r["count"] for r in lazy.collect()} == {0: 3, 1: 3} and unnoted.count() == 3
    discard(spark, inner)
    assert not os.path.isdir(inner[0])


def test_helpers_reach_workers_that_lack_the_package():
    """The package is pickled by value, with every module variable a function names."""
    with noted():
        assert cloudpickle.dumps(materialise) and cloudpickle.dumps(noted) and cloudpickle.dumps(discard)
