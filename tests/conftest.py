import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from feedloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        "feedloom-tests",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate column expressions over a single row of named values."""
    from pyspark.sql import functions as F

    def run(build, ddl="x string", *values):
        row = spark.createDataFrame([values], ddl)
        return row.select(build(*[F.col(f.name) for f in row.schema.fields]).alias("out")).first()["out"]

    return run
