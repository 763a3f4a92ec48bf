"""Token-id files of patched frame-of-reference blocks, with an index of block starts."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bound_batches
from .tokens import TextEncoder, crc32, worker_wide

#: Ids in a block: four lanes of 32, so a block of width w is w words of each lane.
BLOCK = 128
#: Share of a block's values that its width must hold; the others are exceptions.
PERCENTILE = 0.9
#: Ids after which a segment is closed.
SEGMENT_IDS = 1 << 21
#: Documents of a file (a range of doc_id), and the most files that the driver plans.
FILE_DOCS, MAX_FILES = 2048, 32768
MAGIC, VERSION = b"PFOR", 1
_HEAD = "<4sHHQQQQ"  # magic, version, block, documents, ids, exceptions, payload words


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(m, 128) values below 2**width to (m, 4 * width) 32-bit words, four lanes side by side."""
    lanes = np.ascontiguousarray(values.reshape(-1, 32, 4).transpose(1, 0, 2))
    out = np.zeros((width, len(values), 4), np.uint32)
    for j in range(32 if width else 0):
        word, off = divmod(j * width, 32)
        out[word] |= lanes[j] << np.uint32(off)
        if off + width > 32:
            out[word + 1] |= lanes[j] >> np.uint32(32 - off)
    return out.transpose(1, 0, 2).reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = words.reshape(-1, width, 4)
    out = np.zeros((len(words), 32, 4), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for j in range(32 if width else 0):
        word, off = divmod(j * width, 32)
        x = lanes[:, word] >> np.uint32(off)
        if off + width > 32:
            x = x | lanes[:, word + 1] << np.uint32(32 - off)
        out[:, j] = x & mask
    return out.reshape(len(words), BLOCK)


def encode_segment(ids: np.ndarray, doc_ids: np.ndarray, doc_lens: np.ndarray) -> bytes:
    """A segment file: header, document index, block index (minimum, width, exceptions, start), payload, exception lists.

    ``doc_ids`` may hold the lowest 64-bit number for a null id.
    """
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint32)
    padded[:n] = ids
    if n:
        padded[n:] = ids[-1]
    x = padded.reshape(blocks, BLOCK)
    low = x.min(1) if blocks else np.zeros(0, np.uint32)
    d = x - low[:, None]
    at = int(np.ceil(PERCENTILE * BLOCK)) - 1
    kept = np.partition(d, at, axis=1)[:, at] if blocks else np.zeros(0, np.uint32)
    width = np.searchsorted(np.uint64(1) << np.arange(33, dtype=np.uint64), kept.astype(np.uint64), "right").astype(np.uint8)
    # a width of 32 holds every value
    over = (d >= (np.uint64(1) << np.minimum(width, 31).astype(np.uint64)).astype(np.uint32)[:, None]) & (width < 32)[:, None]
    at = np.flatnonzero(over)
    row, pos = at // BLOCK, (at % BLOCK).astype(np.uint8)
    flat = d.reshape(-1)
    patch = flat[at]
    flat[at] = 0
    start = np.concatenate([[0], np.cumsum(4 * width.astype(np.int64))])
    payload = np.zeros(int(start[-1]), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        payload[start[own][:, None] + np.arange(4 * w)] = _pack(d[own], w)
    starts = np.concatenate([[0], np.cumsum(doc_lens)])[:-1] if len(doc_lens) else np.zeros(0)
    return b"".join([
        struct.pack(_HEAD, MAGIC, VERSION, BLOCK, len(doc_ids), n, len(patch), len(payload)),
        doc_ids.astype("<i8").tobytes(), starts.astype("<u8").tobytes(),
        low.astype("<u4").tobytes(), width.tobytes(), np.bincount(row, minlength=blocks).astype(np.uint8).tobytes(), start[:-1].astype("<u8").tobytes(),
        payload.astype("<u4").tobytes(), pos.tobytes(), patch.astype("<u4").tobytes(),
    ])


class Segment:
    """Reads a segment: its document index, and any range of ids by way of the block index."""

    def __init__(self, raw: bytes):
        magic, version, block, docs, self.n, patches, words = struct.unpack_from(_HEAD, raw)
        if (magic, version, block) != (MAGIC, VERSION, BLOCK):
            raise ValueError("not a segment of this format and version")
        at, blocks = struct.calcsize(_HEAD), -(-self.n // BLOCK)

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        self.doc_ids, self.doc_starts = take("<i8", docs), take("<u8", docs).astype(np.int64)
        self.low, self.width, self.patched, self.start = take("<u4", blocks), take("u1", blocks), take("u1", blocks), take("<u8", blocks).astype(np.int64)
        self.payload, self.pos, self.patch = take("<u4", words), take("u1", patches), take("<u4", patches)
        self.first_patch = np.concatenate([[0], np.cumsum(self.patched.astype(np.int64))])

    def ids(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Ids begin..end, decoding only the blocks that hold them."""
        end = self.n if end is None else min(end, self.n)
        if begin >= end:
            return np.zeros(0, np.uint32)
        b0, b1 = begin // BLOCK, -(-end // BLOCK)
        width, out = self.width[b0:b1], np.zeros((b1 - b0, BLOCK), np.uint32)
        for w in np.unique(width[width > 0]).tolist():
            own = np.flatnonzero(width == w)
            out[own] = _unpack(self.payload[self.start[own + b0][:, None] + np.arange(4 * w)], w)
        p0, p1 = self.first_patch[b0], self.first_patch[b1]
        out[np.repeat(np.arange(b1 - b0), self.patched[b0:b1]), self.pos[p0:p1]] = self.patch[p0:p1]
        out += self.low[b0:b1][:, None]
        return out.reshape(-1)[begin - b0 * BLOCK : end - b0 * BLOCK]

    def doc(self, k: int) -> np.ndarray:
        end = self.doc_starts[k + 1] if k + 1 < len(self.doc_starts) else self.n
        return self.ids(int(self.doc_starts[k]), int(end))


_NULL = -(1 << 63)


def file_bounds(docs: DataFrame, id_col: str) -> tuple[int, list[int]]:
    """Files of rows without id, which come first, and upper bounds of all other files but the last: quantiles of the ids, from a scan of that column alone."""
    rows, known = docs.agg(F.count(F.lit(1)), F.count(id_col)).first()
    files = min(MAX_FILES, max(1, -(-rows // FILE_DOCS)))
    unknown = -(-files * (rows - known) // max(rows, 1))
    files = max(1, files - unknown)
    if files == 1:
        return unknown, []
    cuts = [k / files for k in range(1, files)]
    return unknown, list(docs.agg(F.percentile_approx(F.col(id_col), cuts, 20 * files)).first()[0] or [])


def write_ids(docs: DataFrame, scratch: Scratch, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, destination: str | None = None) -> DataFrame:
    """Encode every text, append ``end_id``, and write segments in ascending order of the ids.

    With ``destination`` the files are written to that folder and stay there; else they are scratch.

    The files are rows of a Spark table (file, part, first_id, n_ids, n_docs, segment), so that
    Spark's commit protocol guards them on any store: a lost executor's attempt leaves nothing.
    ``segment`` is the file image of ``encode_segment``. Only packed ids are shuffled, not texts.
    A document stays in one segment. Null ids come first.
    """
    bound_batches(docs.sparkSession)
    unknown, bounds = file_bounds(docs, id_col)
    bounds = np.array(bounds, np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = worker_wide(f"text {path}", lambda: TextEncoder(path))
        tail = np.array([end_id], enc.kind).tobytes()
        for b in batches:
            null = b["n"].to_numpy()
            ids = b["i"].to_numpy(np.int64)
            # an id that repeats over several bounds is spread over their files: it is equal in all
            lo, hi = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
            out = []
            for raw in enc.encode(b["t"].tolist()):
                # two bytes an id, or four behind an odd byte
                out.append(raw + tail if enc.kind == "<u2" else b"\0" + raw + tail)
            # rows of one id, and those without, take turns, be their texts alike or not
            turn = b["h"].to_numpy(np.int64) + np.arange(len(b))
            file = np.where(null, turn % max(unknown, 1), unknown + lo + turn % (hi - lo + 1))
            yield pd.DataFrame({"file": file, "i": np.where(null, _NULL, ids), "x": out})

    src = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("i"), F.col(id_col).isNull().alias("n"),
        F.coalesce(F.col(text_col), F.lit("")).alias("t"), F.pmod(F.hash(F.col(text_col)).cast("long"), F.lit(1 << 20)).alias("h"),
    )
    coded = src.mapInPandas(run, "file int, i long, x binary")
    ordered = coded.repartitionById(unknown + len(bounds) + 1, F.col("file")).sortWithinPartitions("file", "i")  # a task for each file

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, part, first, held, ids = None, 0, 0, 0, []

        def close() -> pd.DataFrame:
            nonlocal part, first, held
            narrow = len(ids[0][1]) % 2 == 0  # one vocabulary, so all are of one kind
            lens = np.array([len(x) // 2 if narrow else len(x) // 4 for _, x in ids], np.int64)
            joined = np.frombuffer(b"".join([x if narrow else x[1:] for _, x in ids]), "<u2" if narrow else "<u4")
            raw = encode_segment(joined, np.array([i for i, _ in ids], np.int64), lens)
            out = pd.DataFrame({"file": [file], "part": [part], "first_id": [first], "n_ids": [int(lens.sum())], "n_docs": [len(ids)], "segment": [raw]})
            part, first, held = part + 1, first + int(lens.sum()), 0
            ids.clear()
            return out

        for b in batches:
            for f, i, x in zip(b["file"].tolist(), b["i"].tolist(), b["x"].tolist(), strict=True):
                if f != file or held >= 2 * SEGMENT_IDS:
                    if ids:
                        yield close()
                    if f != file:
                        file, part, first = f, 0, 0
                ids.append((i, x))
                held += len(x)  # bytes: two an id as a rule
        if ids:
            yield close()

    out = ordered.mapInPandas(segments, "file int, part int, first_id long, n_ids long, n_docs long, segment binary")
    if destination is None:
        return scratch.keep(out, "uncompressed")
    out.write.option("compression", "uncompressed").parquet(destination)
    return open_files(docs.sparkSession, destination)


def open_files(spark, destination: str) -> DataFrame:
    """Token files written earlier, for ``read_index``."""
    return spark.read.parquet(destination)


def file_starts(files: DataFrame) -> DataFrame:
    """Ids before each file. One row a file, of which there are at most MAX_FILES."""
    totals = sorted((r["file"], r["n"]) for r in files.groupBy("file").agg(F.sum("n_ids").alias("n")).collect())
    out, before = [], 0
    for f, n in totals:
        out.append((f, before))
        before += n
    return files.sparkSession.createDataFrame(out, "file int, before long")


def read_index(files: DataFrame) -> DataFrame:
    """Read segments back: a row for each document with its start among all ids, number of ids and their crc32."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for before, raw, file in zip(b["at"].tolist(), b["segment"].tolist(), b["file"].tolist(), strict=True):
                seg = Segment(raw)
                ids = seg.ids().astype("<u4")
                ends = np.append(seg.doc_starts[1:], seg.n)
                yield pd.DataFrame({
                    "doc_id": pd.array(seg.doc_ids, "Int64"), "start": before + seg.doc_starts, "n_tokens": ends - seg.doc_starts,
                    "ids_crc32": [crc32(ids[a:z].data) for a, z in zip(seg.doc_starts.tolist(), ends.tolist(), strict=True)], "file": file,
                })

    at = files.join(F.broadcast(file_starts(files)), "file").select((F.col("before") + F.col("first_id")).alias("at"), "segment", "file")
    out = at.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long, file int")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != _NULL, F.col("doc_id")))


def token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = 2, destination: str | None = None) -> DataFrame:
    """Write the token files of a table and return what reading them back gives.

    The files last in the folder ``destination``, which must not exist; without one they are scratch and
    go with the driver. A null text counts as empty and has the end id alone. A very long text is one
    document of one segment, which then holds more than SEGMENT_IDS ids and takes memory in proportion to
    the text. Repeated rows and ids stay, in any order among equal ids; null ids come first; an empty
    table gives no rows; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "pfor")
    return read_index(write_ids(docs, scratch, path or public_tokenizers.path("byte_bpe_50k.json"), id_col, text_col, end_id, destination))
