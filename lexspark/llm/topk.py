"""Exact top-k inner products by a three-phase uniform threshold.

A score is the sum of as many lists as there are groups of components.

1. Each task takes, from the list in which a query is strongest, its k highest entries and resolves
   them. The k-th highest of all resolved scores is a safe cutoff for the query.
2. A total at or above the cutoff has at least its equal share of it in some list. Each task collects
   the entries of every list that reach the share. A list's postings stand in the order of their
   norms, and those whose norm cannot reach the share are not scored.
3. What is left is resolved exactly, unless the entry that is known and the norms of the other lists
   already rule it out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, bound_batches

#: Fixed-point scale of components; score lists (groups of components) that a total is the sum of.
SCALE, LISTS = 1024, 4
#: Queries handled in one pass, and rows and queries scored at once: all bound memory, not the work done.
QUERY_BLOCK, ROW_BLOCK, TILE = 4096, 2048, 128
#: Components are clipped nowhere: beyond this size scores could leave 64 bits, so such input is refused.
MOST = 1 << 25


def vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows that take part: a vector without null or non-finite components, and an id."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return table.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad).select(F.col(id_col).cast("long").alias("i"), v.cast("array<double>").alias("v"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, fixed-point vectors) of a batch, for each length of vector and block of rows."""
    ids = batch.column("i").to_numpy(zero_copy_only=False)
    col = batch.column("v")
    flat, ends = col.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False))])
    lens = np.diff(ends)
    for n in np.unique(lens).tolist():
        own = np.flatnonzero(lens == n)
        for at in range(0, len(own), ROW_BLOCK):
            rows = own[at : at + ROW_BLOCK]
            x = np.floor(SCALE * flat[ends[rows][:, None] + np.arange(n)])
            if x.size and np.abs(x).max() > MOST:
                raise ValueError(f"components must be below {MOST // SCALE} in size")
            yield ids[rows], x


class _Queries:
    """The queries of a block with vectors of one length, cut into lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.q = ids, np.floor(SCALE * vectors)
        n = self.q.shape[1]
        self.lists = [slice(c[0], c[-1] + 1) for c in np.array_split(np.arange(n), min(LISTS, n))]
        self.norms = self.norms_of(self.q)
        self.best = self.norms.argmax(1)  # the list in which each query is strongest
        self.most = max(1.0, float(np.abs(self.q).max()))

    def norms_of(self, x: np.ndarray) -> np.ndarray:
        """Norms over each list, a little above the true ones: (rows, lists)."""
        return np.stack([np.sqrt(np.square(x[:, c]).sum(1)) for c in self.lists], 1) * (1 + 1e-9)

    def exact(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries and rows in a type that holds every sum."""
        if x.shape[1] * self.most * max(1.0, float(np.abs(x).max())) < 2**53:
            return self.q, x
        return self.q.astype(np.int64), x.astype(np.int64)


def _by_length(queries: list[tuple[int, list[float]]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of each length: plain arrays, which a broadcast takes to executors that know nothing of this module."""
    by: dict[int, list] = {}
    for i, v in queries:
        by.setdefault(len(v), []).append((i, v))
    return {n: (np.array([i for i, _ in qs], np.int64), np.array([v for _, v in qs], float)) for n, qs in by.items()}


def _totals(q: np.ndarray, x: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whole scores of the pairs (query r, row c)."""
    out = [(q[r[at : at + 8192]] * x[c[at : at + 8192]]).sum(1) for at in range(0, len(r), 8192)]
    return np.concatenate([*out, np.zeros(0, np.int64)]).astype(np.int64)


def _best(k: int, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k highest scores of each query, ties to the smaller id."""
    order = np.lexsort((ids, -scores, query))
    query = query[order]
    first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])[: len(query)])
    place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    order = order[place < k]
    return query[place < k], ids[order], scores[order]


class _Held:
    """Entries (query, id, score) of a task, cut down to the k best of each query whenever they are many."""

    def __init__(self, k: int):
        self.k, self.parts, self.size = k, [], 0

    def add(self, *part: np.ndarray) -> None:
        self.parts.append(part)
        self.size += len(part[0])
        if self.size > 1 << 20:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = _best(self.k, *(np.concatenate([*(p[c] for p in self.parts), np.zeros(0, np.int64)]) for c in range(3)))
        self.parts, self.size = [out], 0  # what is kept is at most k a query
        return out


_ENTRIES = "query_id long, vec_id long, score long"


def _out(held: _Held) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in held.cut()], ["query_id", "vec_id", "score"])


def _local_lists(queries, k: int, counts):
    """Phase 1: the k highest entries of each query's strongest list, resolved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = _Held(k), {n: _Queries(*x) for n, x in queries.value.items()}
        for b in batches:
            for ids, x in _matrices(b):
                own = block.get(x.shape[1])
                if own is None:
                    continue
                q, x = own.exact(x)
                for g, c in enumerate(own.lists):
                    of = np.flatnonzero(own.best == g)
                    for at in range(0, len(of), TILE):
                        r = of[at : at + TILE]
                        s = (q[r, c] @ x[:, c].T).astype(float)
                        s[own.ids[r][:, None] == ids[None, :]] = -np.inf
                        top = np.argpartition(-s, min(k, len(ids)) - 1, axis=1)[:, :k]
                        row, col = np.repeat(np.arange(len(r)), top.shape[1]), top.reshape(-1)
                        ok = own.ids[r[row]] != ids[col]
                        row, col = r[row[ok]], col[ok]
                        held.add(own.ids[row], ids[col], _totals(q, x, row, col))
                        counts["first"].add(len(r) * len(ids) * (c.stop - c.start))
                        counts["resolved"].add(len(row))
        yield _out(held)

    return run


def _entries(queries, cutoffs, k: int, counts):
    """Phases 2 and 3: entries that reach their share of the cutoff in some list, resolved; the k best of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = _Held(k), {n: _Queries(*x) for n, x in queries.value.items()}
        for b in batches:
            for ids, x in _matrices(b):
                own = block.get(x.shape[1])
                if own is None:
                    continue
                cut = np.array([cutoffs.value.get(i, -np.inf) for i in own.ids.tolist()])
                share, norms = cut / len(own.lists), own.norms_of(x)
                q, x = own.exact(x)
                pairs = []
                for g, c in enumerate(own.lists):
                    order = np.argsort(-norms[:, g])  # postings by norm
                    low = np.where(share > 0, share / np.maximum(own.norms[:, g], 1e-9), 0.0)  # the least norm that can reach the share
                    asked = np.argsort(low)
                    rest = np.delete(own.norms, g, 1), np.delete(norms, g, 1)
                    for at in range(0, len(asked), TILE):
                        r = asked[at : at + TILE]
                        rows = order[: np.searchsorted(-norms[order, g], -low[r[0]], "right")]
                        if not len(rows):
                            break  # those after it need still larger norms
                        s = q[r, c] @ x[rows][:, c].T
                        counts["second"].add(len(r) * len(rows) * (c.stop - c.start))
                        row, col = np.nonzero(s >= share[r][:, None])
                        bound = s[row, col] + (rest[0][r[row]] * rest[1][rows[col]]).sum(1)
                        ok = (bound * (1 + 1e-9 * np.sign(bound)) + 1 >= cut[r[row]]) & (own.ids[r[row]] != ids[rows[col]])
                        pairs.append(r[row[ok]].astype(np.int64) * len(ids) + rows[col[ok]])
                found = np.unique(np.concatenate([*pairs, np.zeros(0, np.int64)]))
                r, c = found // len(ids), found % len(ids)
                counts["resolved"].add(len(found))
                total = _totals(q, x, r, c)
                ok = total >= cut[r]
                held.add(own.ids[r[ok]], ids[c[ok]], total[ok])
        yield _out(held)

    return run


def top_k(table: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vec_col: str = "embedding", work: dict | None = None) -> DataFrame:
    """The k highest integer inner products of each query row, over all rows but its own.

    Queries are rows whose id is divisible by ``every``. Result: query_id, rank (from 1), vec_id,
    score; ties go to the smaller vec_id. Vectors that are null, empty or hold null or non-finite
    components take no part, nor do null ids; vectors of different lengths do not meet. Of rows
    that share a query's id the smallest vector asks, and none answers; other repeated ids answer
    once a row. Very long vectors are read in smaller batches. An empty table, or one without queries,
    gives no rows; other columns are ignored.

    Queries go in blocks of a fixed size, each broadcast with its cutoffs, and the driver holds one
    block at a time; rows are scanned, never shuffled; a task returns at most k entries a query, and a
    block's result is written before the next begins. ``work`` takes counts: products of components in
    phase one (``first``) and two (``second``), scores resolved (``resolved``) and products without the method (``all``).
    """
    spark = table.sparkSession
    bound_batches(spark)
    scratch, sc = Scratch(spark, "topk"), spark.sparkContext
    rows = scratch.keep(vectors(table, id_col, vec_col))
    asked = scratch.keep(rows.where(F.col("i") % every == 0).groupBy("i").agg(F.min("v").alias("v")))
    # blocks of queries: equal ranges of the ids, found from the ids alone
    n = asked.count()
    cuts = [c / -(-n // QUERY_BLOCK) for c in range(1, -(-n // QUERY_BLOCK))] if n else []
    bounds = (asked.agg(F.percentile_approx("i", cuts, 100_000)).first()[0] or []) if cuts else []
    edges = [None, *bounds, None]
    counts = {c: sc.accumulator(0) for c in ("first", "second", "resolved")}
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    paths = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        block = asked.where((F.lit(True) if lo is None else F.col("i") > lo) & (F.lit(True) if hi is None else F.col("i") <= hi))
        queries = sc.broadcast(_by_length([(r["i"], r["v"]) for r in block.collect()]))
        if not queries.value:
            continue
        # the safe cutoff: the k-th highest of scores that k different rows have
        cut = ranked(rows.mapInArrow(_local_lists(queries, k, counts), _ENTRIES)).where(F.col("rank") == k)
        cutoffs = sc.broadcast({r["query_id"]: r["score"] for r in cut.collect()})
        found = scratch.keep(ranked(rows.mapInArrow(_entries(queries, cutoffs, k, counts), _ENTRIES)))
        paths.append(scratch.last)
        queries.destroy()
        cutoffs.destroy()
    if work is not None:
        size = {r["n"]: (r["q"], r["r"]) for r in rows.groupBy(F.size("v").alias("n")).agg(F.count(F.when(F.col("i") % every == 0, 1)).alias("q"), F.count(F.lit(1)).alias("r")).collect()}
        work.update({c: int(a.value) for c, a in counts.items()}, all=sum(m * q * r for m, (q, r) in size.items()))
    if not paths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return spark.read.schema(found.schema).parquet(*paths)
