"""Reading inputs, shared scratch tables and batch bounds for the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import Scratch, shared_dir  # noqa: F401

#: Bytes of one Arrow batch on its way to a Python worker, so that long texts do not pile up.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by bytes too, unless the session has set its own bound.

    The setting stays: results are lazy, and their batches are made when they are read.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, "2147483647")) > 1 << 28:
        spark.conf.set(key, str(BATCH_BYTES))
