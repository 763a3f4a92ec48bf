"""Audit of how filters interact, by products of mask histograms with incidence matrices.

Each document has a mask of the filters that it fails. What every order of the filters keeps and
removes depends on the mask alone, so per part three histograms of masks (all documents, those of
good quality, toxic ones) are stacked as rows and multiplied by integer matrices of 32 masks by
600 pairs of order and step.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The filters, in the order of their bits.
FILTERS = "ABCDE"
#: Limits of the filters: words; distinct words and capitals in a hundred. Fixed values.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
#: Word separators, and the characters of filter D. Fixed values.
BLANK, SYMBOLS = "[\\x20\\x09-\\x0D]+", "[#$%&*|]"
#: Parts multiplied at a time.
BLOCK = 256


def orders(filters: str = FILTERS) -> list[str]:
    return ["".join(p) for p in permutations(filters)]


def matrices(filters: str = FILTERS) -> dict[str, np.ndarray]:
    """What becomes of a document of each mask (row) at each step of each order (column, orders one after another)."""
    masks = np.arange(1 << len(filters))
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("kept", "removed", "redundant", "unique_fails")}
    for order in orders(filters):
        earlier = 0  # bits of the filters before this step
        for f in order:
            bit = 1 << filters.index(f)
            fails, gone = masks & bit > 0, masks & earlier > 0
            earlier |= bit
            out["kept"].append(masks & earlier == 0)
            out["removed"].append(fails & ~gone)
            out["redundant"].append(fails & gone)
            out["unique_fails"].append(masks == bit)
    return {k: np.stack(v, axis=1).astype(np.int64) for k, v in out.items()}


def audit(hist: np.ndarray, filters: str = FILTERS) -> dict[str, np.ndarray]:
    """Counts at each order and step (columns) for histograms of shape (parts, 3, masks): all, good, toxic."""
    m, (parts, kinds, masks), n = matrices(filters), hist.shape, len(filters)
    removed = (hist.reshape(parts * kinds, masks) @ m["removed"]).reshape(parts, kinds, -1)
    every = hist[:, 0]
    out = {k: every @ m[k] for k in ("kept", "redundant", "unique_fails")}
    out |= {"removed": removed[:, 0], "good_lost": removed[:, 1], "toxic_lost": removed[:, 2]}
    # a filter's share: what it removes, summed over the columns where it stands
    stands = np.array([[f == g for g in filters] for order in orders(filters) for f in order], np.int64)
    out["shapley"] = (out["removed"] @ stands) @ stands.T
    assert all(v.shape == (parts, n * len(orders(filters))) for v in out.values())
    return out


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D, which need no other row."""
    words = F.filter(F.split(text, BLANK, -1), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [
        n < LEAST_WORDS,
        F.lit(100) * distinct.cast("long") < F.lit(LEAST_DISTINCT) * n.cast("long"),
        F.lit(100) * capitals.cast("long") > F.lit(MOST_CAPITALS) * F.length(text).cast("long"),
        text.rlike(SYMBOLS),
    ]
    bits = [f.cast("int") * (1 << k) for k, f in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Masks of documents with their numbers: doc_id, part, mask, n.

    Filter E fails where a smaller id has the same text (by its SHA-256). Equal rows are counted
    before each shuffle; the smallest id of each text is joined on text and id together, so the many
    copies of one text meet in no task.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text_mask(text).alias("mask"))
    rows = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = rows.join(first, ["digest", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return marked.select("doc_id", "part", (F.col("mask") + copy.cast("int") * 16).alias("mask"), "n")


def interactions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row for each part, order of the filters and step: part, filter_order, step and the counts.

    kept, removed, redundant (failing the step's filter but removed before), unique_fails (failing
    that filter alone), good_lost and toxic_lost (removed here and labelled quality 1, toxic 1), and
    shapley (what the filter removes, summed over all orders). Null texts are empty ones and a null
    part is the empty string. Rows without id are never copies and make no other row one, and have
    no labels; equal rows count each; rows of one id and text are no copies of each other. Of
    several labels of an id, one that says 1 is enough; null labels and ids of labels are left out.
    An empty table gives no rows; other columns are ignored. Very long texts count whole.
    """
    hits = lambda c: F.max((F.col(c) == 1).cast("int"))
    flags = labels.where(F.col(id_col).isNotNull() & (F.coalesce(F.col("quality") == 1, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))))
    flags = flags.groupBy(F.col(id_col).alias("doc_id")).agg(F.coalesce(hits("quality"), F.lit(0)).alias("good"), F.coalesce(hits("toxic"), F.lit(0)).alias("toxic"))
    # rows of one id are counted by part and mask before they meet the labels
    each = masks(docs, id_col, text_col, part_col).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    each = each.join(flags, "doc_id", "left")
    sums = [F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")]
    hist = each.groupBy("part", "mask").agg(*sums)
    rows = hist.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("h"))  # 32 masks at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = orders()
        order, step = np.repeat(names, len(FILTERS)), np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(names))
        for b in batches:
            for at in range(0, len(b), BLOCK):
                some = b.iloc[at : at + BLOCK]
                block = np.zeros((len(some), 3, 1 << len(FILTERS)), np.int64)
                for k, h in enumerate(some["h"]):
                    for x in h:
                        block[k, :, x["mask"]] = x["n"], x["good"], x["toxic"]
                got = audit(block)
                yield pd.DataFrame({"part": np.repeat(some["part"].to_numpy(), len(order)), "filter_order": np.tile(order, len(some)), "step": np.tile(step, len(some))} | {k: got[k].ravel() for k in COUNTS})

    return rows.mapInPandas(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


#: Columns of counts.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
