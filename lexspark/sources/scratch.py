"""Tables in the shared folder that cut lineage, so that a plan with many branches is computed once."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. A local session without one (tests) gets a local folder of its own; on a cluster that is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _OWN:
            _OWN.append("file://" + tempfile.mkdtemp(prefix="lexspark-"))
        at = _OWN[0]
    return at.rstrip("/")


class Scratch:
    """Tables written to the shared folder to cut lineage; each survives the loss of executors.

    ``keep`` writes and rereads a frame. ``drop`` removes tables that nothing needs any more;
    the rest goes when the driver ends, since a lazy result may still read them.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.made, self.last = 0, ""
        atexit.register(self._end)

    def keep(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        self.made += 1
        path = self.last = f"{self.root}/{self.made}"
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
                if path.split(":", 1)[-1].lstrip("/").startswith(self.root.split(":", 1)[-1].lstrip("/")):
                    fs, p = self._path(path)
                    fs.delete(p, True)

    def _end(self) -> None:
        try:
            fs, p = self._path(self.root)
            fs.delete(p, True)
        except Exception:  # the JVM may be gone already
            pass
