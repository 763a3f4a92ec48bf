"""Remote services by injected clients: retries, batches that are scattered and gathered, delivery of artifacts."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tries of a call and seconds between them; tries of a delivery after the first, and the factor of their growing pauses.
TRIES, PAUSE = 3, 1.0
REDELIVERIES, BACKOFF = 3, 0.5


class Refused(Exception):
    """A service's answer that is no success; ``status`` is its HTTP code, None if there was no answer."""

    def __init__(self, status: int | None, message: str = ""):
        super().__init__(f"HTTP {status}: {message[:500]}" if status else message)
        self.status = status


def retried(call: Callable, tries: int = TRIES, pause: float = PAUSE, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """A call that is tried again when refused; the last refusal is raised."""

    def run(*args, **kwargs):
        for left in range(tries - 1, -1, -1):
            try:
                return call(*args, **kwargs)
            except Refused:
                if not left:
                    raise
                sleep(pause)

    return run


def scatter(items: DataFrame, make_client: Callable[[], Callable[[list], list]], column: str, result: str, most: int = 16, out: str = "result") -> DataFrame:
    """Adds what a remote service says of each item, and the error of its batch (null if there is none).

    Items go in batches of at most ``most``, one call each, and results are dealt back in order. A batch that the client
    refuses, or answers with another number of results, has the error on all of its items; the others go on. The client
    is made once a task and may be ``retried``.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for b in batches:
            for at in range(0, len(b), most):
                part = b.iloc[at : at + most].copy()
                got, error = [None] * len(part), None
                try:
                    answer = client(part[column].tolist())
                    if len(answer) == len(part):
                        got = answer
                    else:
                        error = f"{len(answer)} results for {len(part)} items"
                except Exception as e:  # the batch's items carry the error
                    error = str(e) or type(e).__name__
                yield part.assign(**{out: pd.Series(got, index=part.index, dtype=object), "error": error})

    return items.mapInPandas(run, f"{kinds}, `{out}` {result}, error string")


def deliver(artifacts: DataFrame, make_sender: Callable[[], Callable[[dict], dict]], more: int = REDELIVERIES, backoff: float = BACKOFF, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Send each document's artifacts; result: document_id, success, retries, storage_paths (JSON), error.

    The sender posts a row's fields and returns the service's answer, or raises ``Refused``. A refused delivery is tried
    ``more`` times again, after pauses that double, but not after a client's error (4xx but 429). A failure is a row, not
    an exception; a task that is run again delivers again, so the service must take the same artifact twice.
    """
    import json

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = make_sender()
        for b in batches:
            rows = []
            for row in b.to_dict("records"):
                done, retries, error, paths = False, 0, None, None
                for k in range(more + 1):
                    try:
                        answer = send(row)
                        done, paths = True, json.dumps(answer.get("storage_paths"))
                        break
                    except Refused as e:
                        error, retries = str(e), retries + 1
                        if e.status is not None and 400 <= e.status < 500 and e.status != 429:
                            break
                        if k < more:
                            sleep(backoff * 2**k)
                rows.append((row["document_id"], done, retries, paths, None if done else error))
            yield pd.DataFrame(rows, columns=["document_id", "success", "retries", "storage_paths", "error"])

    return artifacts.mapInPandas(run, "document_id string, success boolean, retries int, storage_paths string, error string")


def payloads(artifacts: DataFrame, metadata: DataFrame) -> DataFrame:
    """What is delivered of each document: artifacts with the offsets file (document, hash, offsets, pipeline version) and the metadata's fields."""
    a = artifacts.join(metadata.drop("canonical_hash"), "document_id")
    offsets = F.from_json("offsets_json", "map<string,struct<start:int,end:int>>")
    return a.withColumn("offsets_file", F.to_json(F.struct("document_id", "canonical_hash", offsets.alias("offsets"), "pipeline_version")))
