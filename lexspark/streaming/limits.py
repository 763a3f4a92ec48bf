"""Sliding-window admission and micro-batches: exact stateful forms, their batch twins, and windowed views."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

#: Requests a key may make within a window, and its seconds.
REQUESTS, SECONDS = 100, 60
#: Micro-batches: most items, and milliseconds after the first.
EMBED_BATCH, RERANK_BATCH = (16, 50), (8, 30)


def admit(times: Iterator[float], limit: int = REQUESTS, seconds: float = SECONDS, kept: deque | None = None) -> Iterator[tuple[bool, int]]:
    """(admitted, requests left) of a key's requests in order. Only admitted requests count; one exactly a window old no longer does."""
    kept = deque() if kept is None else kept
    for t in times:
        while kept and kept[0] <= t - seconds:
            kept.popleft()
        ok = len(kept) < limit
        if ok:
            kept.append(t)
        yield ok, max(0, limit - len(kept))


def admit_batch(requests: DataFrame, limit: int = REQUESTS, seconds: float = SECONDS) -> DataFrame:
    """Requests (key, ts, id) with admitted and remaining. A streamed fold over each key; state is at most ``limit`` times.

    A rejected request is not recorded, so no window function gives this.
    """

    def start():
        kept: deque = deque()
        return lambda t: next(admit([t], limit, seconds, kept))

    return _fold(requests, start, "admitted boolean, remaining int")


def _fold(rows: DataFrame, start, result: str) -> DataFrame:
    """Rows (key, ts, id) with what a fold over each key's rows in order says of each.

    Rows are sorted within partitions and streamed: a worker holds the state of one key, never its rows, so a key
    of any length needs no memory. ``start`` gives the fold of a new key: a function of the time.
    """
    slim = rows.select("key", "id", F.col("ts").cast("timestamp").cast("double").alias("t"))
    kinds = dict(slim.dtypes)
    names = [x.split()[0] for x in result.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, step = object(), None
        for b in batches:
            keys = b["key"].astype(object).where(b["key"].notna(), None).tolist()
            out = []
            for k, t in zip(keys, b["t"].tolist(), strict=True):
                if k != last:
                    last, step = k, start()
                out.append(step(t))
            got = pd.DataFrame(out, columns=names, index=b.index)
            yield pd.concat([b[["key", "id"]], got], axis=1)

    ordered = slim.repartition("key").sortWithinPartitions("key", "t", "id")
    return ordered.mapInPandas(run, f"key {kinds['key']}, id {kinds['id']}, {result}")


def offered(requests: DataFrame, seconds: int = SECONDS) -> DataFrame:
    """Requests of the same key in the window up to each one, admitted or not."""
    at = F.col("ts").cast("timestamp").cast("long")
    w = Window.partitionBy("key").orderBy(at).rangeBetween(-(seconds - 1), 0)
    return requests.withColumn("offered", F.count(F.lit(1)).over(w))


class Admission(StatefulProcessor):
    """The limiter on a stream: a list of admitted times a key, dropped when idle for two windows."""

    def __init__(self, limit: int = REQUESTS, seconds: float = SECONDS):
        self.limit, self.seconds = limit, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.times = handle.getListState("times", "t double", ttlDurationMs=int(2000 * self.seconds))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = deque(sorted(t for (t,) in self.times.get()))
        pdf = pd.concat(list(rows)).sort_values(["t", "id"], kind="stable")
        got = list(admit(pdf["t"], self.limit, self.seconds, kept))
        if kept:
            self.times.put([(t,) for t in kept])
        else:
            self.times.clear()
        yield pdf.assign(admitted=[a for a, _ in got], remaining=[r for _, r in got])[["key", "id", "admitted", "remaining"]]

    def close(self) -> None:
        pass


def admit_stream(requests: DataFrame, limit: int = REQUESTS, seconds: float = SECONDS) -> DataFrame:
    """Streaming requests (key, ts, id) with admitted and remaining. Needs the RocksDB state store."""
    slim = requests.select("key", "id", F.col("ts").cast("timestamp").cast("double").alias("t"))
    kinds = dict(slim.dtypes)
    return slim.groupBy("key").transformWithStateInPandas(
        statefulProcessor=Admission(limit, seconds), outputStructType=f"key {kinds['key']}, id {kinds['id']}, admitted boolean, remaining int", outputMode="Update", timeMode="ProcessingTime"
    )


def group_batches(items: DataFrame, most: int = EMBED_BATCH[0], wait_ms: float = EMBED_BATCH[1]) -> DataFrame:
    """Items (key, ts, id) with the micro-batch that each falls into, by a streamed fold over each key (a collector)."""

    def start():
        batch, n, opened = -1, 0, 0.0

        def step(t: float) -> tuple[int, int]:
            nonlocal batch, n, opened
            if batch < 0 or n >= most or (t - opened) * 1000 > wait_ms:
                batch, n, opened = batch + 1, 0, t
            n += 1
            return batch, n - 1

        return step

    return _fold(items, start, "batch long, place int")


def batch_stats(grouped: DataFrame) -> DataFrame:
    """Items, batches and mean batch size of each collector."""
    sizes = grouped.groupBy("key", "batch").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("key").agg(F.sum("n").alias("items"), F.count(F.lit(1)).alias("batches"), F.avg("n").alias("mean_size"))


def limiter_stats(requests: DataFrame, window: str = "60 seconds", slide: str = "10 seconds") -> DataFrame:
    """Requests and keys in each sliding window; on a stream, with late rows cut off by a watermark of one window."""
    r = requests.withColumn("ts", F.col("ts").cast("timestamp"))
    r = r.withWatermark("ts", window) if requests.isStreaming else r
    keys = F.approx_count_distinct("key") if requests.isStreaming else F.countDistinct("key")
    return r.groupBy(F.window("ts", window, slide).alias("w")).agg(F.count(F.lit(1)).alias("requests"), keys.alias("keys")).select(F.col("w.start").alias("window_start"), "requests", "keys")


def tumbling(events: DataFrame, width: str, keys: list[str]) -> DataFrame:
    """Additional: counts and sums of value in tumbling windows."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withWatermark("ts", width) if events.isStreaming else e
    return e.groupBy(F.window("ts", width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def sessions(events: DataFrame, gap: str, keys: list[str]) -> DataFrame:
    """Additional: sessions of a key's events, ended by a gap."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withWatermark("ts", gap) if events.isStreaming else e
    return e.groupBy(F.session_window("ts", gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(*keys, F.col("w.start").alias("session_start"), "n")
