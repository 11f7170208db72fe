"""Bounds on what a task or a broadcast holds at once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from locusflow.operators.joins import broadcast_if_small

#: Rows of text handed to Python at once.
TEXT_ROWS = 1024
#: Measured size up to which these operators broadcast a table; they hold little else on the driver.
BROADCAST_BYTES = 16 << 20
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside hand at most ``rows`` rows at once to Python."""
    before = spark.conf.get(_SETTING)
    spark.conf.set(_SETTING, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_SETTING, before)


def broadcast_if_few(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint when its measured size is at most ``BROADCAST_BYTES``, else unchanged."""
    return broadcast_if_small(df, BROADCAST_BYTES)
