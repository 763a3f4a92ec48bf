"""Token counts by a separator scan over flat, unindexed token files."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, bound_batches
from .tokens import TextEncoder, worker_wide

#: Ids in a block of a flat file; blocks cut documents anywhere.
BLOCK_IDS = 1 << 18
#: The id that no text encodes to, which ends each document.
END_ID = 50256


def write_flat(docs: DataFrame, scratch: Scratch, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Flat files: the ids of documents, each followed by ``end_id``, cut into blocks of equal size.

    A file is what one task reads, so nothing is shuffled. Columns: file, block, ids (unsigned
    16-bit), doc_ids (labels of the documents that end in the block; the scan does not use them to
    find a boundary). The table is written once, and file numbers stay what they were then.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, tail = worker_wide(f"text {path}", lambda: TextEncoder(path)), np.array([end_id], "<u2").tobytes()
        if enc.kind != "<u2":
            raise ValueError("flat files hold 16-bit ids: the vocabulary is too large")
        held, size, block, file, ends = [], 0, 0, 0, deque()  # ends: (place of the end id in the file, doc_id)

        def cut(every: bool) -> Iterator[pd.DataFrame]:
            """The full blocks of what is held, joined once; with ``every``, the rest of it too."""
            nonlocal held, size, block
            raw, at = memoryview(b"".join(held)), 0
            while size >= block_ids or every and size:
                n, done = min(size, block_ids), []
                while ends and ends[0][0] < block * block_ids + n:
                    done.append(ends.popleft()[1])
                yield pd.DataFrame({"file": [file], "block": [block], "ids": [bytes(raw[at : at + 2 * n])], "doc_ids": [done]})
                at, size, block = at + 2 * n, size - n, block + 1
            held = [bytes(raw[at:])]

        for b in batches:
            file = int(b["f"].iloc[0]) if len(b) else file
            for i, null, raw in zip(b["i"].tolist(), b["n"].tolist(), enc.encode(b["t"].tolist()), strict=True):
                held += [raw, tail]
                size += len(raw) // 2 + 1
                ends.append((block * block_ids + size - 1, None if null else i))
                if size >= block_ids:
                    yield from cut(False)
        if size:
            yield from cut(True)

    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("i"), F.col(id_col).isNull().alias("n"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), F.spark_partition_id().alias("f"))
    return scratch.keep(src.mapInPandas(run, "file int, block long, ids binary, doc_ids array<long>"))


def scan_blocks(files: DataFrame, end_id: int = END_ID) -> DataFrame:
    """Search each block for the end id: its number of ids and the places of the end ids in it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = [np.frombuffer(x, "<u2") for x in b["ids"].tolist()]
            yield pd.DataFrame({"file": b["file"], "block": b["block"], "n_ids": [len(x) for x in ids], "ends": [np.flatnonzero(x == end_id) for x in ids], "doc_ids": b["doc_ids"]})

    return files.mapInPandas(run, "file int, block long, n_ids long, ends array<long>, doc_ids array<long>")


def stitch(blocks: DataFrame) -> DataFrame:
    """A row for each document, from block summaries alone.

    A prefix scan over the blocks of a file gives each block its first place, the documents ended
    before it and the place of the last end id before it; the first document of a block begins
    right after that. A file is one task's input, so its scan is small.
    """
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n_ids").over(w), F.lit(0))
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    b = blocks.withColumn("first", first).withColumn("last", F.col("first") + last)
    b = b.withColumn("before", F.coalesce(F.max("last").over(w), F.lit(-1))).withColumn("docs", F.coalesce(F.sum(F.size("ends").cast("long")).over(w), F.lit(0)))
    each = b.select("file", "first", "before", "docs", "ends", F.posexplode(F.arrays_zip(F.col("ends").alias("e"), F.col("doc_ids").alias("d"))).alias("k", "x"))
    began = F.when(F.col("k") == 0, F.col("before")).otherwise(F.col("first") + F.element_at("ends", F.greatest(F.col("k"), F.lit(1)))) + 1
    end = F.col("first") + F.col("x.e")
    return each.select(F.col("x.d").alias("doc_id"), "file", (F.col("docs") + F.col("k")).alias("ordinal"), began.alias("start"), (end - began).alias("n_tokens"))


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write flat token files and count each document's ids between separators.

    Result: doc_id, file, ordinal (place in the file), start (in ids of the file), n_tokens
    (without the separator). A null or empty text has 0 tokens; a very long one runs through as many
    blocks as it needs; null ids and repeated rows stay; an empty table gives no rows; other columns
    are ignored.
    """
    scratch = Scratch(docs.sparkSession, "flat")
    return stitch(scan_blocks(write_flat(docs, scratch, path or public_tokenizers.path("byte_bpe_50k.json"), id_col, text_col, block_ids=block_ids)))
