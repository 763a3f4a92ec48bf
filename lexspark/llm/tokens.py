"""Byte-level BPE: a sentencepiece model serialised from a rank file, and a token encoder on the tokenizers library."""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

#: Pre-tokens longer than this are encoded but not remembered.
CACHED_CHARS = 64
#: Entries of each of the two generations of a worker's cache: pre-tokens, chunks of the text encoder.
PRE_TOKENS, CHUNKS = 120_000, 500_000
#: A byte b is written as the character U+0100 + b: no white space, no control character.
_TO_CHARS = {b: 0x100 + b for b in range(256)}


def load_ranks(path: str) -> list[bytes]:
    """Tokens by rank of a rank file (base64 token, rank a line)."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: length-delimited, varint or 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def piece(token: bytes) -> str:
    return token.decode("latin-1").translate(_TO_CHARS)


def unpiece(p: str) -> bytes:
    """The bytes of a piece: the inverse of ``piece``."""
    return bytes(ord(c) - 0x100 for c in p)


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model: byte-mapped pieces scored by negative rank, identity normalisation.

    sentencepiece merges the neighbours whose joint piece scores highest, the leftmost first: the
    same order as lowest rank first. Piece ids are ranks; the unknown piece comes after the last.
    """
    out = [_field(1, _field(1, piece(t).encode()) + _field(2, -float(r)) + _field(3, 1)) for r, t in enumerate(tokens)]
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + b"".join(_field(n, -1) for n in (41, 42, 43))
    plain = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(out) + _field(2, trainer) + _field(3, plain)


class Cache:
    """Ids of text pieces in two generations: what is used again moves to the new one, the old one goes when that is full."""

    def __init__(self, limit: int):
        self.limit = limit
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, parts: list[list[str]], learn) -> Iterator[bytes]:
        """Joined ids of each list of pieces, by one look-up a piece; ``learn`` gives the ids of unknown ones."""
        if len(self.new) > self.limit:
            self.new, self.old = {}, self.new
        flat = list(chain.from_iterable(parts))
        got = list(map(self.new.get, flat))
        gaps = [k for k, x in enumerate(got) if x is None]
        again = map(self.old.get, [flat[k] for k in gaps])
        rest, new, need = [], self.new, set()
        for k, x in zip(gaps, again, strict=True):
            if x is None:
                rest.append(k)
                need.add(flat[k])
            else:
                got[k] = new[flat[k]] = x
        if need:
            new.update(learn(list(need)))
        for k in rest:
            got[k] = new[flat[k]]
        for p in need:  # pieces too long to be worth their memory
            if len(p) > CACHED_CHARS:
                del self.new[p]
        at = 0
        for ps in parts:
            yield b"".join(got[at : at + len(ps)])
            at += len(ps)


class ByteBpe:
    """Encode and decode by a rank file: pre-tokens by ``pattern``, each by the serialised model."""

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        tokens = load_ranks(path)
        self.whole = {t: r for r, t in enumerate(tokens)}
        self.find = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(tokens))
        #: Bytes of each id by the inverse mapping of the model's pieces, for decoding.
        self.bytes_of = list(map(unpiece, self.model.id_to_piece(list(range(len(tokens))))))
        self.cache = Cache(PRE_TOKENS)

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens, as little-endian 32-bit numbers. A pre-token that is a token stays whole."""
        raw = [t.encode() for t in new]
        ids = [self.whole.get(t) for t in raw]
        rest = [i for i, x in enumerate(ids) if x is None]
        coded = self.model.encode([piece(raw[i]) for i in rest], out_type=int, num_threads=1) if rest else []
        out = {t: struct.pack("<I", x) for t, x in zip(new, ids, strict=True) if x is not None}
        out.update((new[i], np.array(x, "<u4").tobytes()) for i, x in zip(rest, coded, strict=True))
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit numbers."""
        for at in range(0, len(texts), 64):
            yield from self.cache.ids([self.find(t) for t in texts[at : at + 64]], self._learn)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def worker_wide(key: str, make):
    """An object that a Python worker keeps from task to task."""
    kept = sys.modules.setdefault("_lexspark_worker", types.ModuleType("_lexspark_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN, with_ids: bool = False) -> DataFrame:
    """Encode every whole text, decode the ids, and return a digest of both for each row.

    Result: id, n_tokens, ids_sha256, decoded_sha256, n_bytes (of the decoded text) and, with
    ``with_ids``, ids (binary, little-endian unsigned 32-bit). A null text counts as empty; empty
    texts have no tokens; a very long text is encoded whole, in memory in proportion to it; repeated rows stay repeated; a null id stays null; other columns of
    ``docs`` are ignored, whatever their names. A narrow scan: no shuffle.
    """
    bound_batches(docs.sparkSession)
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = worker_wide(f"bpe {path} {pattern}", lambda: ByteBpe(path, pattern))
        for b in batches:
            rows = []
            for ids in bpe.encode(b["t"].tolist()):
                back = bpe.decode(np.frombuffer(ids, "<u4"))
                row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest(), len(back))
                rows.append((*row, ids) if with_ids else row)
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", *["ids"] * with_ids])
            out.insert(0, "i", b["i"].to_numpy())
            yield out

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    out = src.mapInPandas(run, f"i {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long" + ", ids binary" * with_ids)
    return out.withColumnRenamed("i", id_col)


def _printable() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable Latin-1 bytes as themselves, the others from U+0100 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + n) for n, b in enumerate(rest)}


#: White space that does not stand alone, other white space than space and line end, and the mark of whole texts.
_NOT_ALONE = ("  ", "\n ", " \n", "\n\n", "\0", *(chr(c) for c in (9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


class TextEncoder:
    """Whole texts to ids by the tokenizers library.

    A text whose white space stands alone (one space or line end between words) falls into chunks
    at which the pre-tokenizer always cuts, so equal chunks are encoded once; any other text goes
    through the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.cache = Cache(CHUNKS)
        #: Ids of a vocabulary below 2**16 take two bytes, others four.
        self.kind = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        self.tail = {c: np.array(self.tok.encode(c, add_special_tokens=False).ids, self.kind).tobytes() for c in ".,"}
        back = {c: b for b, c in _printable().items()}
        self.size = np.zeros(self.tok.get_vocab_size(), np.int64)  # bytes of each token
        for t, i in self.tok.get_vocab(with_added_tokens=False).items():
            self.size[i] = sum(c in back for c in t)

    def _joined(self, chunks: list[str], out: dict[str, bytes]) -> None:
        """Ids of chunks that begin with their only white space, which always starts a token: joined into lines, then cut by bytes."""
        lines = [chunks[at : at + 1024] for at in range(0, len(chunks), 1024)]
        for line, e in zip(lines, self.tok.encode_batch_fast(["".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.kind)
            ends = np.cumsum([len(c.encode()) for c in line])
            cuts = np.searchsorted(np.cumsum(self.size[ids]), ends) * ids.itemsize + ids.itemsize
            raw, before = ids.tobytes(), 0
            for c, cut in zip(line, cuts.tolist(), strict=True):
                out[c], before = raw[before:cut], cut

    def _learn(self, need: list[str]) -> dict[str, bytes]:
        """Ids of pieces: those that begin with \0 are whole texts, those with white space chunks, the others the first words of texts.

        A word with a point or comma behind it is always cut before that, so the bare word serves.
        """
        chunks = [c for c in need if c[:1] in (" ", "\n")]
        ended = [c for c in chunks if c[-1] in ".," and c[-2].isalpha()]
        new, old = self.cache.new, self.cache.old
        stems = {c[:-1] for c in ended}
        fresh = stems.difference(new).difference(old).union(chunks).difference(ended)
        out: dict[str, bytes] = {}
        self._joined(list(fresh), out)
        for c in ended:
            stem = c[:-1]
            out[c] = (out.get(stem) or new.get(stem) or old[stem]) + self.tail[c[-1]]
        rest = [c for c in need if c[:1] not in (" ", "\n")]
        coded = self.tok.encode_batch_fast([c[1:] if c[:1] == "\0" else c for c in rest], add_special_tokens=False)
        out.update((c, np.array(e.ids, self.kind).tobytes()) for c, e in zip(rest, coded, strict=True))
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, as little-endian unsigned numbers of the encoder's kind."""
        for at in range(0, len(texts), 256):
            yield from self.cache.ids([self._pieces(t) for t in texts[at : at + 256]], self._learn)

    @staticmethod
    def _pieces(t: str) -> list[str]:
        """Chunks that each begin with their white space, if it all stands alone; else the whole text, marked."""
        if not t or t[0] in " \n" or t[-1] in " \n" or any(x in t for x in _NOT_ALONE):
            return ["\0" + t]
        return t.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
