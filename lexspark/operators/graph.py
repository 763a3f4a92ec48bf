"""Citation graph: node and edge tables, expansion, audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import legal
from ..sources.scratch import Scratch
from . import ranges
from .registry import last_wins

PREVIEW, CITATION = 200, 500
TIERS = {"HIGH": 3, "MEDIUM": 2, "LOW": 1}


def nodes(chunks: DataFrame, at: str = "ingested_at") -> DataFrame:
    """One node for each node_id, the newest, with a preview of its text and its device type in short form."""
    n = chunks.withColumn("text_preview", F.left("text", F.lit(PREVIEW))).withColumn("device_type", legal.device_type(F.col("device_type")))
    return last_wins(n.select("node_id", "document_id", "span_id", "device_type", "text_preview", at), ["node_id"], [at])


def edges(citations: DataFrame) -> DataFrame:
    """One edge for each (source, target): no self-loops, the surest of several, the citation cut to 500 characters."""
    e = citations.where(F.col("source_node_id") != F.col("target_node_id"))
    e = e.withColumn("confidence_tier", legal.confidence_tier(F.col("confidence"))).withColumn("extraction_method", legal.extraction_method(F.col("extraction_method"))).withColumn("citation_text", F.left("citation_text", F.lit(CITATION)))
    keys = ["source_node_id", "target_node_id"]
    return last_wins(ranges.dealt(e, *keys, n=ranges.parts(citations)), keys, ["confidence", "citation_text"])  # one sort, and no more rows in a task however large the input


def stubs(edge_table: DataFrame, node_table: DataFrame) -> DataFrame:
    """Nodes for endpoints that the node table lacks, with what their ids tell."""
    ends = edge_table.select(F.explode(F.array("source_node_id", "target_node_id")).alias("node_id")).distinct()
    lost = ends.join(node_table.select("node_id"), "node_id", "left_anti")
    body = F.substring_index("node_id", ":", -1)
    return lost.select("node_id", F.substring_index(body, "#", 1).alias("document_id"), F.when(F.instr(body, "#") > 0, F.substring_index(body, "#", -1)).otherwise("").alias("span_id"), F.lit(True).alias("is_stub"))


def followed(edge_table: DataFrame, least_tier: str = "LOW", rel_types: list[str] | None = None, floors: dict[str, float] | float | None = None) -> DataFrame:
    """Edges that an expansion may follow: of a tier, of allowed relations, and at or above their relation's floor.

    ``floors`` is a number for all relations, or a number for each; other relations have none. The
    confidence of the relation counts where the table has it, else that of the edge.
    """
    e = edge_table.where(F.coalesce(F.try_element_at(legal._map(TIERS), F.col("confidence_tier")), F.lit(0)) >= TIERS[least_tier])
    if rel_types is not None:
        e = e.where(F.col("rel_type").isin(*rel_types))
    sure = F.coalesce("rel_type_confidence" if "rel_type_confidence" in edge_table.columns else "confidence", F.lit(0.0))
    if isinstance(floors, dict) and floors:
        return e.where(sure >= F.coalesce(F.try_element_at(legal._map(floors), F.col("rel_type")), F.lit(float("-inf"))))
    return e if floors is None or isinstance(floors, dict) else e.where(sure >= floors)


def expand(edge_table: DataFrame, seeds: DataFrame, hops: int | None = 2, least_tier: str = "LOW", rel_types: list[str] | None = None, floors: dict[str, float] | float | None = None, top_k: int | None = None) -> DataFrame:
    """Nodes within ``hops`` of the seeds (node_id), or all that can be reached, over edges that pass ``followed``.

    Result: node_id, hop (the least), frequency (edges that led there at that hop), rel_types (of
    those edges, sorted). Circles end where a node was reached before. Each round reads the edges once
    against the nodes that the round before reached first, and writes those; the rows of a recursive
    query could not be made distinct between rounds, and paths through hubs would multiply.
    """
    scratch = Scratch(edge_table.sparkSession, "expand")
    e = followed(edge_table, least_tier, rel_types, floors).select(F.col("source_node_id").alias("node_id"), F.col("target_node_id").alias("to"), "rel_type")
    if hops is None or hops > 1:
        e = scratch.keep(e)
    frontier = scratch.keep(seeds.select("node_id").where("node_id is not null").distinct())
    rounds = [frontier.select("node_id", F.lit(0).alias("hop"), F.lit(0).cast("long").alias("frequency"), F.array().cast("array<string>").alias("rel_types"))]
    hop = 0
    while hops is None or hop < hops:
        hop += 1
        step = frontier.join(e, "node_id").groupBy(F.col("to").alias("node_id")).agg(F.lit(hop).alias("hop"), F.count(F.lit(1)).alias("frequency"), F.array_sort(F.collect_set("rel_type")).alias("rel_types"))
        seen = reduce(DataFrame.unionByName, rounds).select("node_id")
        step = scratch.keep(step.join(seen, "node_id", "left_anti"))
        if step.isEmpty():
            break
        frontier = step.select("node_id")
        rounds = [*rounds, step] if len(rounds) < 8 else [scratch.keep(reduce(DataFrame.unionByName, rounds)), step]
    found = reduce(DataFrame.unionByName, rounds).where("hop > 0")
    return found if top_k is None else found.orderBy("hop", F.desc("frequency"), "node_id").limit(top_k)


def audit(edge_table: DataFrame, node_table: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row of counts: nodes, edges, self-loops, edges with an unknown end, edges whose source chunk is unknown. The edges, read several times, are written once."""
    n = ranges.parts(edge_table)
    ends = Scratch(edge_table.sparkSession, "audit").keep(edge_table.select("source_node_id", "target_node_id", "source_chunk_id"))
    known = ranges.dealt(node_table.select("node_id"), "node_id", n=n).distinct()
    met = lambda df, c: df.join(known.select(F.col("node_id").alias(c), F.lit(True).alias(f"{c}_known")), c, "left")
    lost = met(met(ends.drop("source_chunk_id"), "source_node_id"), "target_node_id").where("source_node_id_known is null or target_node_id_known is null").select("source_node_id", "target_node_id")
    lost = ranges.dealt(lost, "source_node_id", "target_node_id", n=n).distinct()
    orphan = ends.join(ranges.dealt(chunks.select(F.col("chunk_id").alias("source_chunk_id")), "source_chunk_id", n=n).distinct(), "source_chunk_id", "left_anti")
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    out = one(node_table, "nodes").crossJoin(ends.agg(F.count(F.lit(1)).alias("edges"), F.count_if(F.col("source_node_id") == F.col("target_node_id")).alias("self_loops")))  # single rows
    return out.crossJoin(one(lost, "dangling_edges")).crossJoin(one(orphan, "edges_without_chunk"))
