"""End-to-end flows: statutes and rulings from blocks or pages to contract-checked chunks and their manifests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import citations, consolidation, origin, quality, rulings, statutes, vectors
from ..sources.scratch import Scratch


@dataclass
class Ingested:
    """What a flow gives: chunks of sound documents, chunks of documents that broke the contract, citations, manifests."""

    chunks: DataFrame
    quarantine: DataFrame
    citations: DataFrame
    manifest: DataFrame


def canonical_gate(canonical: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents in canonical form, the others): only the former have offsets that hold. Each text is judged once, and both are read from what that wrote."""
    judged = Scratch(canonical.sparkSession, "gate").keep(canonical.withColumn("__ok", tx.is_canonical(F.col("canonical_text"))))
    return judged.where("__ok").drop("__ok"), judged.where("not __ok").drop("__ok")


def ingest_statutes(blocks: DataFrame, canonical: DataFrame, requests: DataFrame, compat: bool = False, embed: bool = False) -> Ingested:
    """Statutes: devices, chunks, citations, provenance, consolidated articles, contract and manifest.

    Tables that several branches read are written to the shared folder. The contract is checked before any sink, and a document passes whole or not at all.
    """
    scratch = Scratch(blocks.sparkSession, "statutes")
    good = scratch.keep(canonical_gate(canonical)[0])
    devices = scratch.keep(statutes.devices(blocks.join(good.select("document_id"), "document_id", "left_semi"), compat))
    chunks = scratch.keep(statutes.to_chunks(devices, requests, good))
    refs = scratch.keep(citations.normalise(citations.extract(chunks, compat=compat), chunks, compat))
    chunks = origin.prefix_external(origin.classify(chunks, good, compat))
    chunks = chunks.join(citations.as_array(refs), "node_id", "left")
    chunks = scratch.keep(chunks)
    chunks = chunks.unionByName(consolidation.consolidate(chunks.drop("citations")), allowMissingColumns=True)
    chunks = chunks.withColumn("is_consolidated", F.coalesce("is_consolidated", F.lit(False)))
    if embed:
        chunks = vectors.embed(chunks.withColumn("__t", vectors.choose_text(F.col("retrieval_text"), F.col("text"))), text_col="__t").drop("__t")
    sound, bad = quality.split_by_contract(scratch.keep(chunks))
    return Ingested(sound, bad, refs, quality.manifest(sound, good))


def ingest_pages(pages: DataFrame, requests: DataFrame, compat: bool = False) -> Ingested:
    """Statutes from transcribed pages (document_id, page_number, text)."""
    return ingest_statutes(statutes.split_pages(pages), statutes.canonical_of_pages(pages), requests, compat)


def ingest_rulings(docs: DataFrame, requests: DataFrame | None = None, pages: DataFrame | None = None, compat: bool = False) -> Ingested:
    """Rulings: header, device tree, overlapping section chunks, contract and manifest. Rulings carry no citations."""
    scratch = Scratch(docs.sparkSession, "rulings")
    canonical = docs.select("document_id", F.col("text").alias("canonical_text"))
    good = scratch.keep(canonical_gate(canonical)[0])
    docs = docs.join(good.select("document_id"), "document_id", "left_semi")
    heads = scratch.keep(rulings.header(docs, requests))
    devices = scratch.keep(rulings.devices(docs, pages, compat))
    chunks = rulings.to_chunks(rulings.chunk(rulings.parsed_sections(devices, docs, heads), heads), docs, heads)
    chunks = scratch.keep(chunks.withColumns({"is_cross_page": F.lit(False), "n_bbox_spans": F.lit(0)}))
    sound, bad = quality.split_by_contract(chunks)
    none = chunks.select("node_id", F.lit(None).cast("string").alias("target_node_id")).where(F.lit(False))
    return Ingested(sound, bad, none, quality.manifest(sound, good))
