"""Ingestion as a stream: a landing folder, request checks, sinks for each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landing(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Files that arrive in a folder: path, content, length, modificationTime."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").load(path)


def checked(files: DataFrame) -> DataFrame:
    """Adds error to uploads: not a PDF by name, or empty; null if sound. And sha256_source of the bytes.

    Spark's file sources skip files of no length; rows of other sources can be empty.
    """
    error = F.when(~F.lower("path").endswith(".pdf"), "not_pdf").when(F.col("length") == 0, "empty")
    return files.withColumn("error", error).withColumn("sha256_source", F.sha2("content", 256))


def run(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None):
    """Start a query that gives each batch to ``sink(frame, batch_id)``; a batch may come again after a failure, so sinks upsert."""
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def once(files: DataFrame, within: str = "7 days") -> DataFrame:
    """Checked files of which each content passes once, whatever its name, for as long as the watermark remembers it."""
    return files.withWatermark("modificationTime", within).dropDuplicatesWithinWatermark(["sha256_source"])


def exactly_once(folder: str, keys: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A sink of sound files to ``folder``/accepted and of refused ones to ``folder``/refused, each batch in a folder of its own.

    A batch that comes again after a failure overwrites its own folder, so readers of the table see
    each row once. ``keys`` is applied to the rows before they are written.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = (keys or (lambda x: x))(batch).persist()
        for name, own in (("accepted", rows.where("error is null")), ("refused", rows.where("error is not null"))):
            own.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")
        rows.unpersist()

    return sink


def landed(spark: SparkSession, folder: str, name: str = "accepted") -> DataFrame:
    """What the sink wrote, with the batch of each row."""
    return spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}/batch=*")
