"""Progress of streaming runs and of tasks, kept as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Events of tasks: what is null stays as it was.
TASK = "task_id string, document_id string, status string, progress double, at timestamp, error_message string, result string"


def task_id(document_id, size, at):
    """Sixteen hex digits from a document's id, its size and the time it came."""
    return F.left(F.sha2(F.concat_ws("-", document_id, size.cast("string"), at.cast("string")), 256), F.lit(16))


def note_tasks(events: DataFrame, path: str) -> None:
    """Append events of tasks to their table; each write adds files, so writers need no lock."""
    events.write.mode("append").parquet(path)


def finished(results: DataFrame) -> DataFrame:
    """Closing events of tasks (task_id, document_id, at, errors array<string>, result): completed without errors, else failed with all messages."""
    failed = F.size("errors") > 0
    return results.select("task_id", "document_id", F.when(failed, "failed").otherwise("completed").alias("status"), F.lit(1.0).alias("progress"), "at", F.when(failed, F.array_join("errors", "; ")).alias("error_message"), "result")


def tasks(spark: SparkSession, path: str) -> DataFrame:
    """Each task as it is now: of every field the last value that is not null, combined before the shuffle."""
    e = spark.read.schema(TASK).parquet(path)
    last = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct("at", "status"))).alias(c) for c in ("document_id", "status", "progress", "error_message", "result")]
    return e.groupBy("task_id").agg(*last, F.min("at").alias("started_at"), F.max(F.when(F.col("status").isin("completed", "failed"), F.col("at"))).alias("completed_at"))


class RunLog(StreamingQueryListener):
    """Remembers the last ``keep`` events of each query: (run_id, batch, rows, seconds) and how it ended."""

    def __init__(self, keep: int = 1000):
        self.keep, self.batches, self.ended = keep, [], {}

    def onQueryStarted(self, event) -> None:
        self.ended[str(event.runId)] = None

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches = [*self.batches[-self.keep + 1 :], (str(p.runId), p.batchId, p.numInputRows, p.batchDuration / 1000)]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)] = event.exception or "done"
