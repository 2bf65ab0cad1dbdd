from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quorumlake.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session(
        "tests", master="local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    made.sparkContext.setLogLevel("OFF")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL


def one(spark, expression, **values):
    """The value of a column expression over one row of literals."""
    from pyspark.sql import functions as F

    frame = spark.range(1)
    for name, value in values.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame.select(expression.alias("v")).first()["v"]
