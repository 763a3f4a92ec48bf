"""Embedding, similarity, reranking and request checks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DIM, MAX_LENGTH = 1024, 8192
#: Limits of a request: texts, their length, top_k.
MOST_TEXTS, MOST_CHARS, MOST_K = 100, 10_000, 100


def choose_text(retrieval: Column, text: Column) -> Column:
    """What to embed: the retrieval text, or the text where that is empty."""
    return F.coalesce(F.nullif(retrieval, F.lit("")), text)


def hashing_model(dim: int = DIM) -> Callable[[list[str]], tuple[list[np.ndarray], list[dict[int, float]]]]:
    """A deterministic stand-in for an embedding model: signed hashed words, unit length; sparse weights are word shares."""

    def encode(texts: list[str]):
        dense, sparse = [], []
        for t in texts:
            v, weights = np.zeros(dim, np.float32), {}
            words = re.findall(r"\w+", t.lower())
            for w in words:
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                v[h % dim] += 1 if h >> 63 else -1
                weights[h >> 1] = weights.get(h >> 1, 0.0) + 1 / len(words)  # 63 bits: two words of a text never share a key, as they did with 30
            dense.append(v / (np.linalg.norm(v) or 1))
            sparse.append(weights)
        return dense, sparse

    return encode


def embed(texts: DataFrame, make_model: Callable = hashing_model, text_col: str = "text") -> DataFrame:
    """Adds dense_vector, sparse_vector, text_length and truncated. The model is made once a task and gets Arrow batches."""
    schema = "dense array<float>, sparse map<bigint,float>"

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for b in batches:
            dense, sparse = model([t or "" for t in b])
            if not len(dense) == len(sparse) == len(b):
                raise ValueError(f"the model gave {len(dense)} and {len(sparse)} vectors for {len(b)} texts")
            yield pd.DataFrame({"dense": [d.tolist() for d in dense], "sparse": sparse})

    out = texts.withColumn("__e", run(F.col(text_col)))
    return out.select("*", F.col("__e.dense").alias("dense_vector"), F.col("__e.sparse").alias("sparse_vector"), F.length(text_col).alias("text_length"), (F.length(text_col) > MAX_LENGTH).alias("truncated")).drop("__e")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 if one has no length."""
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(n > 0, dot(a, b) / n).otherwise(0.0)


#: Vectors of a block.
BLOCK = 1024


def nearest(queries: DataFrame, docs: DataFrame, group: str, k: int, digits: int = 6) -> DataFrame:
    """Of each query (query_id, query_vector, group) the documents (pos, vector, group) of its group that can be among its k nearest: query_id, pos, cosine.

    Documents are dealt into blocks of about a thousand, and queries go to each block, so that a group
    of any size is shared by all tasks. A block gives the k first by cosine rounded to ``digits``, ties
    to the smaller pos; the exact order of all is left to ``rerank``. A document is not near itself.
    As ``cosine`` has it, vectors that are null or hold nulls have the cosine 0, those of other lengths none, and come last.
    """
    docs = docs.where(F.col(group).isNotNull() & F.col("pos").isNotNull())
    n = max(1, -(-docs.count() // BLOCK))
    own = docs.select(group, "pos", "vector", F.pmod(F.hash("pos"), F.lit(n)).alias("block"))
    asked = queries.where(F.col(group).isNotNull()).select(group, "query_id", "query_vector", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"))
    kinds = dict(docs.dtypes) | dict(queries.dtypes)
    none = -2.0  # below any cosine

    def matrices(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Sound vectors by length: their places, and a matrix of them."""
        by: dict[int, list[int]] = {}
        rows = column.to_pylist()
        for i, x in enumerate(rows):
            if x and None not in x:
                by.setdefault(len(x), []).append(i)
        return {size: (np.array(at), np.array([rows[i] for i in at], np.float64)) for size, at in by.items()}

    def top(asked: pa.Table, own: pa.Table) -> pa.Table:
        scores = np.zeros((asked.num_rows, own.num_rows))
        right = matrices(own.column("vector"))
        with np.errstate(all="ignore"):
            for size, (qa, q) in matrices(asked.column("query_vector")).items():
                for other, (va, v) in right.items():
                    norm = np.outer(np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1)))
                    scores[np.ix_(qa, va)] = np.where(norm == 0, 0.0, q @ v.T / norm if size == other else none)
        pos = np.array(own.column("pos").to_pylist())
        ids, where, said = [], [], []
        for i, s in zip(asked.column("query_id").to_pylist(), scores, strict=True):
            s = np.where(np.isnan(s), np.inf, s)  # as Spark sorts
            s[pos == i] = -np.inf
            least = np.partition(s, -k)[-k] if len(s) > k else -np.inf
            near = np.flatnonzero((s >= least - 2 * 10.0**-digits) & (s > -np.inf))
            values, back = np.unique(s[near], return_inverse=True)
            rounded = np.array([float(Decimal(repr(float(x))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) if np.isfinite(x) else x for x in values])
            near = near[np.lexsort((pos[near], -rounded[back]))[:k]] if len(near) else near
            ids += [i] * len(near)
            where += pos[near].tolist()
            said += [float("nan") if x == np.inf else None if x == none else float(x) for x in s[near]]
        return pa.table({"query_id": pa.array(ids, asked.schema.field("query_id").type), "pos": pa.array(where, own.schema.field("pos").type), "cosine": pa.array(said, pa.float64())})

    both = asked.groupBy(group, "block").cogroup(own.groupBy(group, "block"))
    return both.applyInArrow(top, f"query_id {kinds['query_id']}, pos {kinds['pos']}, cosine double")


def rerank(scored: DataFrame, top_k: int | None = None) -> DataFrame:
    """Rankings of each query's documents (query_id, pos, score): by score, ties in input order, cut to top_k.

    A limit on the rank is pushed into the window as a group limit before the shuffle.
    """
    out = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "pos")))
    return out if top_k is None else out.where(F.col("rank") <= top_k)


def reorder(docs: DataFrame, rankings: DataFrame) -> DataFrame:
    """Documents (query_id, pos, ..) in ranked order with their scores; those of an unranked query keep the input order, scores null."""
    r = rankings.select("query_id", "pos", "score", "rank")
    j = docs.join(r, ["query_id", "pos"], "left")
    any_ = F.max(F.col("rank")).over(Window.partitionBy("query_id"))
    return j.withColumn("place", F.when(any_.isNull(), F.col("pos") + 1).otherwise(F.col("rank"))).where("place is not null").drop("rank")


def score_pairs(pairs: DataFrame, score: Callable[[Column, Column], Column]) -> DataFrame:
    """Each pair (query, document) scored with its own query."""
    return pairs.withColumn("score", score(F.col("query"), F.col("document")))


def check_requests(requests: DataFrame) -> DataFrame:
    """Adds error to requests (texts array<string>, top_k): the first limit that one breaks, null if none."""
    t = F.col("texts")
    error = (
        F.when(F.coalesce(F.size(t), F.lit(0)) < 1, "no_texts").when(F.size(t) > MOST_TEXTS, "too_many_texts")
        .when(F.exists(t, lambda x: F.length(x) > MOST_CHARS), "text_too_long").when(F.col("top_k").isNotNull() & ~F.col("top_k").between(1, MOST_K), "bad_top_k")
    )
    return requests.withColumn("error", error)
