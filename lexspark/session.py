"""A session with the settings that the engine expects. Any session with UTC time will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "lexspark", shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution and Arrow on; batches bounded by bytes; RocksDB for stateful streams."""
    b = SparkSession.builder.appName(app)
    base = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        base["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()
