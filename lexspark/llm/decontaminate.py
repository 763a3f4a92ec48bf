"""Benchmark decontamination by templates: numbers, names and units become typed placeholders."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bound_batches

#: Template tokens of a window; the literal ones that it needs to match with other values; the run of tokens
#: that makes a hit (or the whole item, if shorter); the fewest tokens of an item that is found with other values.
WINDOW, LITERAL, RUN, FEWEST = 8, 5, 13, 5
#: Windows of the benchmark whose hashes (8 bytes each) are broadcast to look windows of documents up at once; beyond,
#: all windows are joined by a shuffle. Bytes of a table that is broadcast for a join, here and in ``clean``.
BROADCAST_WINDOWS, BROADCAST_BYTES = 4_000_000, 64 << 20
NUMBER, NAME, UNIT = 1, 2, 3
#: Words that count as units after a number.
UNITS = frozenset(
    "% $ € £ ° mm cm m km mi in ft yd g kg mg t lb oz l ml s sec min h hr ms hz khz mhz ghz w kw mw v a j kj cal kcal pa bar k c f mol usd eur gbp"
    " meter meters metre metres kilometer kilometers kilometre kilometres mile miles inch inches foot feet gram grams kilogram kilograms pound pounds"
    " liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year years dollar dollars euro euros cent cents"
    " percent degree degrees watt watts volt volts".split()
)
_NUMERIC = re.compile(r"[+-]?[\d][\d.,:/]*")
_GLUED = re.compile(r"(\d)(?=[^\W\d_]|[%°€$£])|([€$£])(?=\d)")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_CACHE = 300_000
#: Tokens that are hashed at once.
_CHUNK = 1 << 16
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Templates:
    """Turns texts into template tokens: 64-bit ids, small ones for placeholders.

    A token is what stands between white space, without punctuation at its edges, in lower case.
    A capitalised word (not one all in capitals) is a name; one that begins a sentence has two
    readings, as a plain word and as a name. A unit is one only after a number; a number with a unit
    glued on counts as two tokens.
    """

    def __init__(self):
        self.at: dict[str, int] = {}
        self.table = np.zeros((1 << 12, 4), np.uint64)  # id, id within a sentence, ends a sentence, id of the word itself

    def _learn(self, raw: str) -> tuple[int, int, bool, int]:
        bare = raw[-1].isalnum()  # most words: nothing at their edges to look at
        ends = not bare and raw.rstrip("\"')]»”").endswith((".", "!", "?", ":", ";"))
        if bare and raw[0].isalnum() or raw in UNITS:
            core = raw
        else:
            core = raw[:-1] if not bare and raw[:-1].isalnum() else _EDGES.sub("", raw)
        if not core:
            return 0, 0, ends, 0
        low = core.lower()
        plain = xxhash.xxh3_64_intdigest(low.encode()) | 1 << 63
        if (core[0].isdecimal() or core[0] in "+-") and _NUMERIC.fullmatch(core):
            return NUMBER, NUMBER, ends, plain
        if low in UNITS:
            plain = plain & ~0xFF | UNIT  # the last byte marks words that can be units
        elif plain & 0xFF == UNIT:
            plain ^= 0x80
        named = core[0].isupper() and core[1:] == core[1:].lower() and len(core) > 1
        return plain, NAME if named else plain, ends, plain

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]:
        """(template ids, ids of the words themselves, where a word may be a name too, raw words, place of each id's raw word)."""
        if any(c in text for c in "0123456789"):
            text = _GLUED.sub(lambda m: m[0] + " ", text)
        words = text.split()
        new = list(set(words).difference(self.at))
        if new:
            if len(self.at) + len(new) > _CACHE:
                self.at, new = {}, list(set(words))
            n = len(self.at)
            if n + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((n + len(new), 4), np.uint64)])
            self.table[n : n + len(new)] = np.array([self._learn(w) for w in new], np.uint64)
            self.at.update(zip(new, range(n, n + len(new)), strict=True))
        got = self.table[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))]
        first = np.concatenate([[True], got[:-1, 2] > 0])[: len(got)]
        ids = np.where(first, got[:, 0], got[:, 1])
        keep = np.flatnonzero(ids)
        ids = ids[keep]
        unit = (ids & np.uint64(0xFF) == UNIT) & (ids > 3)
        after = np.concatenate([[False], ids[:-1] == NUMBER])[: len(ids)]
        ids = np.where(unit & after, np.uint64(UNIT), ids)
        return ids, got[keep, 3], (first & (got[:, 0] != got[:, 1]))[keep], words, keep


def windows(ids: np.ndarray, n: int, verbatim: bool = False) -> np.ndarray:
    """Hashes of the windows of n tokens; of templates, 0 for one with too few literal tokens to say anything.

    Ids of the words themselves (``verbatim``) have hashes of their own, whatever stands in the window.
    """
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    m = len(ids) - n + 1
    h = np.full(m, n + WINDOW * verbatim, np.uint64)
    for j in range(n):
        h = (h ^ ids[j : m + j]) * _SPREAD
        h ^= h >> np.uint64(29)
    if verbatim:
        return h | np.uint64(1)
    literal = np.concatenate([[0], np.cumsum(ids > 3)])
    return np.where((literal[n:] - literal[:-n] >= min(LITERAL, n)) & (n >= FEWEST), h | np.uint64(1), np.uint64(0))


def _readings(ids: np.ndarray, either: np.ndarray, n: int) -> Iterator[tuple[np.ndarray | None, int, np.ndarray]]:
    """Windows under each reading: (places, or None for all; which of the window's open words are names, as bits; hashes).

    ``either`` marks the open words: those that may be names too.
    """
    yield None, 0, windows(ids, n)
    if len(ids) < n or n < FEWEST or not either.any():
        return
    before = np.concatenate([[0], np.cumsum(either)])
    count = before[n:] - before[:-n]
    spare = n - min(LITERAL, n)  # more names leave too few literal tokens
    some = np.flatnonzero(count)
    for bits in range(1, 1 << int(count.max())) if spare else ():
        if bits.bit_count() > spare:
            continue
        at = some = some[count[some] >= bits.bit_length()]
        place = at[:, None] + np.arange(n)
        names = either[place] & (np.int64(bits) >> (before[place] - before[at][:, None]) & 1 > 0)
        read = np.where(names, np.uint64(NAME), ids[place])
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = (h ^ read[:, j]) * _SPREAD
            h ^= h >> np.uint64(29)
        yield at, bits, np.where((read > 3).sum(axis=1) >= min(LITERAL, n), h | np.uint64(1), np.uint64(0))


def _slots(ids: np.ndarray, either: np.ndarray, words: list[str], keep: np.ndarray, at: int, n: int, bits: int) -> list[str]:
    """What stands in the placeholders of a window, in order: after '~' for open words that are read as names, else after '='."""
    out = []
    for k in range(at, at + n):
        if either[k]:
            if bits & 1:
                out.append("~" + _value(words[keep[k]]))
            bits >>= 1
        elif ids[k] <= 3:
            out.append("=" + _value(words[keep[k]]))
    return out


def _value(word: str) -> str:
    return _EDGES.sub("", word).lower() or word


def _rows(lens: list[int], hashes: Broadcast | None, key: str):
    """Windows of each text, as templates and verbatim; with ``hashes``, only those whose hash is among the benchmark's."""

    def search(part: list[tuple], template: Templates, wanted: np.ndarray | None, seen: np.ndarray | None) -> list[tuple]:
        if not part:
            return []
        ids, raw, either = (np.concatenate([p[k] for p in part]) for k in (2, 3, 4))
        size = np.array([len(p[2]) for p in part])
        start, owner = np.cumsum(size) - size, np.repeat(np.arange(len(part)), size)
        made: dict[int, tuple] = {}
        out = []
        for n in lens:
            if len(ids) < n:
                continue
            of = owner[: len(owner) - n + 1]
            whole = of == owner[n - 1 :]
            if key == "item":
                whole &= np.minimum(size, WINDOW)[of] == n
            found = [(False, *x) for x in _readings(ids, either, n)] + [(True, None, 0, windows(raw, n, True))]
            for verbatim, places, bits, h in found:
                good = (whole if places is None else whole[places]) & (h > 0)
                hit = np.flatnonzero(good if seen is None else seen[h >> np.uint64(42)] & good)
                if seen is not None and len(hit):
                    k = np.minimum(np.searchsorted(wanted, h[hit]), len(wanted) - 1)
                    hit = hit[wanted[k] == h[hit]]
                if verbatim and n < WINDOW and len(hit) > 1:  # a whole item: its first place in a text says all
                    hit = np.sort(hit[np.unique(np.stack([of[hit].astype(np.uint64), h[hit]]), axis=1, return_index=True)[1]])
                for x in hit.tolist():
                    a = x if places is None else int(places[x])
                    o = int(of[a])
                    if o not in made:
                        made[o] = template(part[o][1])
                    own, _, opens, words, keep = made[o]
                    at = a - int(start[o])
                    out.append((*part[o][0], int(h[x].view(np.int64)), at, n, len(own), verbatim, _slots(own, opens, words, keep, at, n, bits)))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        template, wanted, seen = Templates(), None, None
        if hashes is not None:
            wanted, seen = hashes.value, np.zeros(1 << 22, bool)
            seen[wanted >> np.uint64(42)] = True
        for b in batches:
            out, part, held = [], [], 0
            for i, th, t in zip(b["i"].tolist(), b["th"].tolist(), b["t"].tolist(), strict=True):
                part.append(((i, th), t, *template(t)[:3]))
                held += len(part[-1][2])
                if held >= _CHUNK:
                    out += search(part, template, wanted, seen)
                    part, held = [], 0
            out += search(part, template, wanted, seen)
            yield pd.DataFrame(out, columns=["i", "th", "h", "at", "n", "size", "verbatim", "slots"])

    return run


_SCHEMA = "i long, th long, h long, at int, n int, size int, verbatim boolean, slots array<string>"


def best_run(met: list[tuple[int, int, int, list[tuple[str, str, bool]]]], need: int) -> tuple[int, int, int] | None:
    """The run of matched windows that covers most of an item, if it covers ``need`` tokens: (windows, tokens covered, values changed).

    ``met``: (place in the item, tokens, least reading, pairs of (item's value, document's, open)) of the windows
    that match at one shift. In a run each value of the item stands for one value of the document, and the reverse.
    Where a pair contradicts an earlier one, a run ends and the next begins behind that earlier window. Windows
    are taken without verbatim ones (reading 0), with them (1), and with those where another name begins a
    sentence (2); only in the last is a word that begins a sentence a value. The first of the best is taken.
    """
    best = None
    for reading in range(3):
        own = [(at, n, {(b, d) for b, d, opens in pairs if reading == 2 or not opens}) for at, n, least, pairs in met if least <= reading]
        own = sorted((w for w in own if len({b for b, _ in w[2]}) == len({d for _, d in w[2]}) == len(w[2])), key=lambda w: (w[0], w[1], sorted(w[2])))
        there, back, low = {}, {}, 0  # value of one side: [value of the other, windows of the run that say so]
        ranges = []
        for k, (_, _, pairs) in enumerate(own):
            clash = lambda p: any(b in there and there[b][0] != d or d in back and back[d][0] != b for b, d in p)
            if clash(pairs):
                ranges.append((low, k))
                while clash(pairs):
                    for b, d in own[low][2]:
                        for side, x in ((there, b), (back, d)):
                            side[x][1] -= 1
                            if not side[x][1]:
                                del side[x]
                    low += 1
            for b, d in pairs:
                there.setdefault(b, [d, 0])[1] += 1
                back.setdefault(d, [b, 0])[1] += 1
        for a, z in [*ranges, (low, len(own))]:
            covered, end = 0, -1
            for at, n, _ in own[a:z]:
                covered += max(0, at + n - max(at, end))
                end = max(end, at + n)
            if covered >= need and (best is None or covered > best[1]):
                best = (len({w[0] for w in own[a:z]}), covered, len({p for w in own[a:z] for p in w[2] if p[0] != p[1]}))
    return best


def _best_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["i", "th", "item", "item_tokens", "shift", "n_windows", "n_covered", "n_changed"]
    for b in batches:
        out = []
        for at in range(0, b.num_rows, 32):  # few rows at a time: as Python objects they take many times their size
            for r in b.slice(at, 32).to_pylist():
                got = best_run([(w["at"], w["n"], w["least"], [(p["b"], p["d"], p["open"]) for p in w["pairs"]]) for w in r["w"]], min(RUN, r["item_tokens"]))
                if got:
                    out.append((*(r[c] for c in names[:5]), *got))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(len(names))], names)


def _leaks(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame:
    """Leaks by row: i (the id, a number of its own for null), th (hash of the text), item and the figures of ``find_leaks``."""
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "leaks")
    text = lambda df, i, t: df.where(F.col(t).isNotNull()).select(*_key(F.col(i), F.col(t)), F.col(t).alias("t"))
    items = scratch.keep(text(benchmark, item_col, item_text).mapInPandas(_rows(list(range(1, WINDOW + 1)), None, "item"), _SCHEMA))
    lens = sorted(r["n"] for r in items.select("n").distinct().collect())  # at most WINDOW values
    rows, held = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(F.array_join("slots", "----")) + 80), F.lit(0))).first()
    hashes = None
    if rows <= BROADCAST_WINDOWS:
        hashes = spark.sparkContext.broadcast(np.unique(np.array([r["h"] for r in items.select("h").distinct().collect()], np.int64).view(np.uint64)))
    found = text(docs, id_col, text_col).mapInPandas(_rows(lens, hashes, "doc"), _SCHEMA)
    b = items.select(F.col("i").alias("item"), F.col("th").alias("item_th"), "h", "n", F.col("at").alias("b_at"), F.col("size").alias("item_tokens"), "verbatim", F.col("slots").alias("b_slots"))
    met = found.drop("size", "verbatim").join(F.broadcast(b) if held <= BROADCAST_BYTES else b, ["h", "n"])
    # equal hashes have their placeholders at the same places, so values pair up in order; verbatim ones are the item's own
    value = lambda x: F.substr(x, F.lit(2))
    pair = lambda x, y: F.struct(value(x).alias("b"), value(y).alias("d"), (F.left(x, F.lit(1)).eqNullSafe("~") | F.left(y, F.lit(1)).eqNullSafe("~")).alias("open"))
    pairs = F.when(F.col("verbatim"), F.transform("b_slots", lambda x: pair(x, x))).otherwise(F.zip_with("b_slots", "slots", pair))
    met = met.select("i", "th", "item", "item_th", "item_tokens", (F.col("at") - F.col("b_at")).alias("shift"), "b_at", "n", "verbatim", pairs.alias("pairs"))
    least = F.when(F.exists("pairs", lambda p: p["open"] & (p["b"] != p["d"])), 2).when(F.col("verbatim"), 1).otherwise(0)
    # a row holds the windows of one item at one shift: no more than the item has, under each reading; repeated rows fall together
    got = met.groupBy("i", "th", "item", "item_th", "item_tokens", "shift").agg(F.collect_set(F.struct(F.col("b_at").alias("at"), "n", least.alias("least"), "pairs")).alias("w"))
    reach = F.size(F.array_distinct(F.flatten(F.transform("w", lambda w: F.sequence(w["at"], w["at"] + w["n"] - 1)))))
    got = got.where(reach >= F.least(F.lit(RUN), F.col("item_tokens"))).select("i", "th", "item", "item_tokens", "shift", "w")
    got = got.mapInArrow(_best_runs, "i long, th long, item long, item_tokens long, shift long, n_windows long, n_covered long, n_changed long")
    best = F.max_by(F.struct("n_windows", "n_covered", "item_tokens", "n_changed"), F.struct("n_covered", -F.col("n_changed"), "n_windows", -F.col("shift"), "item_tokens"))
    return got.groupBy("i", "th", "item").agg(best.alias("x")).select("i", "th", "item", "x.*")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and benchmark item that it holds, also with other numbers, names or units.

    Result: doc_id, item_id, n_windows, n_covered (template tokens of the item that match at one
    shift), item_tokens, coverage, n_changed (placeholders whose value differs: re-parameterised).
    A hit covers RUN tokens at one shift, or the whole item if it is shorter, by a run of windows whose
    placeholders are consistent: one value of the item stands for one value of the document, and the
    reverse. A capitalised word that begins a sentence, on either side, may be a plain word or a name.
    Windows with under LITERAL literal tokens, and items of under FEWEST tokens, match verbatim only
    (but for case and punctuation at the edges of tokens). Null and empty texts hold nothing; a very long
    text is read whole, in memory in proportion to it. Rows that repeat in id and text count once; rows
    with one id (or none) and different texts are searched apart, and each that holds an item has a row.
    An empty table on either side gives no rows; other columns are ignored.
    """
    best = _leaks(docs, benchmark, id_col, text_col, item_col, item_text)
    own = lambda c: F.when(F.col(c) != _NONE, F.col(c))
    return best.select(own("i").alias("doc_id"), own("item").alias("item_id"), "n_windows", "n_covered", "item_tokens", (F.col("n_covered") / F.col("item_tokens")).alias("coverage"), "n_changed")


_NONE = -(1 << 63)


def _key(i, t) -> tuple:
    """What names a row: its id, or a number that stands for none, and a hash of its text."""
    return F.coalesce(i.cast("long"), F.lit(_NONE)).alias("i"), F.xxhash64(t).alias("th")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without a leak, all columns kept. Rows go by id and text, so a leaky row goes whatever its id."""
    leaks = Scratch(docs.sparkSession, "leaky").keep(_leaks(docs, benchmark, id_col, text_col, "item_id", "text").select(F.col("i").alias("__i"), F.col("th").alias("__th")).distinct())
    small = 32 * leaks.count() <= BROADCAST_BYTES  # then the texts need no shuffle
    i, th = _key(docs[id_col], docs[text_col])
    return docs.join(F.broadcast(leaks) if small else leaks, (i == F.col("__i")) & (th == F.col("__th")), "left_anti")
