"""Parent-document chunks: an article's text with its children's, split between children where too long."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import legal

LEAST_CHILDREN, LIMIT, OVERLAP = 2, 2000, 1


def split(caput: int, lens: list[int], limit: int = LIMIT) -> list[tuple[int, int]]:
    """Ranges of children (first, after last) of each part: every part repeats the caput, and begins with the last child of the part before."""
    if caput + sum(n + 1 for n in lens) <= limit:
        return [(0, len(lens))]
    out, first, size = [], 0, caput
    for i, n in enumerate(lens):
        if size + 1 + n > limit and i > first:
            out.append((first, i))
            first = max(0, i - OVERLAP)
            size = caput + sum(x + 1 for x in lens[first:i])
        size += 1 + n
    out.append((first, len(lens)))
    return out


def parts(caput: Column, lens: Column) -> Column:
    """Parts of an article (array of first, last child) by the lengths of its caput and children, evaluated once."""

    def run(caput: pd.Series, lens: pd.Series) -> pd.Series:
        return pd.Series([[{"first": a, "last": b} for a, b in split(c, list(x))] for c, x in zip(caput, lens, strict=True)])

    return F.pandas_udf(run, "array<struct<first:int,last:int>>").asNondeterministic()(caput, lens)


def consolidate(chunks: DataFrame, least: int = LEAST_CHILDREN) -> DataFrame:
    """New rows '@FULL' or '@FULL-Pn' for articles with at least two direct children; the chunks themselves stay as they are.

    ``chunks`` has node_id, parent_node_id, span_id, device_type, document_id, text and any others.
    Children are ordered by structure; child_offsets are prefix sums within the part's text. Parts
    carry the article's other columns, but no offsets of their own.
    """
    kids = chunks.where("parent_node_id <> ''").groupBy("parent_node_id").agg(
        F.sort_array(F.collect_list(F.struct(legal.child_order(F.col("span_id")).alias("o"), F.col("node_id").alias("id"), F.coalesce("text", F.lit("")).alias("t")))).alias("k")
    ).where(F.size("k") >= least)
    articles = chunks.where("device_type = 'article'").withColumnRenamed("parent_node_id", "__above")
    a = articles.join(kids, articles["node_id"] == kids["parent_node_id"]).drop("parent_node_id")
    kept = F.filter("k", lambda x: x["t"] != "")
    a = a.withColumn("k", kept).withColumn("parts", parts(F.length("text"), F.transform("k", lambda x: F.length(x["t"]))))
    a = a.select("*", F.size("parts").alias("part_total"), F.posexplode("parts").alias("n", "part"))
    mine = F.slice("k", F.col("part.first") + 1, F.col("part.last") - F.col("part.first"))
    a = a.withColumn("mine", mine)
    joined = F.concat_ws("\n", F.array(F.col("text")), F.col("mine.t"))
    spans = F.aggregate(
        "mine", F.struct((F.length("text") + 1).alias("at"), F.array().cast("array<struct<node_id:string,start:int,end:int>>").alias("o")),
        lambda s, x: F.struct((s["at"] + F.length(x["t"]) + 1).alias("at"), F.concat(s["o"], F.array(F.struct(x["id"].alias("node_id"), s["at"].alias("start"), (s["at"] + F.length(x["t"])).alias("end")))).alias("o")),
        lambda s: s["o"],
    )
    suffix = F.when(F.col("part_total") == 1, "@FULL").otherwise(F.concat(F.lit("@FULL-P"), (F.col("n") + 1).cast("string")))
    own = {
        "node_id": F.concat("node_id", suffix), "device_type": F.lit("article_consolidated"), "chunk_level": F.lit("article"), "canonical_start": F.lit(-1), "canonical_end": F.lit(-1), "canonical_hash": F.lit(""),
        "chunk_id": F.concat(F.col("document_id"), F.lit("#"), F.col("span_id"), suffix), "retrieval_text": joined, "text": joined,
    }
    keep = [c for c in chunks.columns if c != "parent_node_id"]
    keep += [c for c in own if c not in keep]
    a = a.withColumns({"part_index": F.col("n") + 1, "child_node_ids": F.col("mine.id"), "child_offsets": spans})
    out = a.select(*[own[c].alias(c) if c in own else F.col(c) for c in keep], F.lit("").alias("parent_node_id"), "part_index", "part_total", F.lit(True).alias("is_consolidated"), "child_node_ids", "child_offsets")
    return out
