"""Fill-in-middle transformation by an Aho-Corasick event scan.

Units are runs of ASCII letters and single other code points. One automaton reads a text once and
reports the places where the class of characters changes, and sentinels. Between two such events
lie either one unit (letters) or as many as there are code points, so counts and the place of any
unit follow by arithmetic from the events alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, product

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred documents, as many stay plain, and of the others as many put the suffix first.
PLAIN, SPM = 10, 20
#: Code points that the automaton reads at a time.
BLOCK = 1 << 18
_CHANGE, _SENTINEL = 1, 2


class Units:
    """Finds the units of texts. The automaton's alphabet: the characters of the sentinels, other letters ``a``, all others ``.``."""

    def __init__(self, sentinels: tuple[str, ...] = (PREFIX, SUFFIX, MIDDLE)):
        own = sorted({c for s in sentinels for c in s})
        if any(not c.isascii() for c in own):
            raise ValueError("sentinels are ASCII")
        letter = lambda c: c.isascii() and c.isalpha()
        self.table = bytes(ord(c) if (c := chr(k)) in own else ord("a" if letter(c) else ".") for k in range(256))
        letters, rest = [*filter(letter, own), "a"], [c for c in (*own, ".") if not letter(c)]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for x, y in chain(product(letters, rest), product(rest, letters)):
            self.automaton.add_word(x + y, _CHANGE)
        for s in sentinels:
            self.automaton.add_word(s, _SENTINEL)
        self.automaton.make_automaton()

    def __call__(self, text: str) -> Found:
        # one byte for each code point: those beyond ASCII become "?", which is no letter
        plain, found = text.encode("ascii", "replace").translate(self.table).decode("ascii"), []
        it = self.automaton.iter("")
        for at in range(0, len(plain), BLOCK):
            it.set(plain[at : at + BLOCK])  # goes on from the state and place of the block before
            found.append(np.fromiter(chain.from_iterable(it), np.int64).reshape(-1, 2))
        events = np.concatenate([*found, np.zeros((0, 2), np.int64)])
        return Found(len(plain), plain[:1].isalpha(), events[events[:, 1] == _CHANGE, 0], bool((events[:, 1] == _SENTINEL).any()))


class Found:
    """The gaps between events: each starts at an event, holds one class, and knows how many units lie before it."""

    def __init__(self, size: int, first_is_letter: bool, changes: np.ndarray, sentinel: bool):
        self.size, self.sentinel = size, sentinel
        self.starts = np.concatenate([np.zeros(min(size, 1), np.int64), changes])
        self.letters = (np.arange(len(self.starts)) % 2 == 0) == first_is_letter
        units = np.where(self.letters, 1, np.diff(self.starts, append=size))
        self.before = np.concatenate([np.zeros(1, np.int64), np.cumsum(units)])
        self.n = int(self.before[-1])

    def end(self, k: int) -> int:
        """Where the first ``k`` units end."""
        if k >= self.n:
            return self.size
        gap = int(np.searchsorted(self.before, k, "right")) - 1  # holds unit k, counted from 0, which starts where k units end
        return int(self.starts[gap]) + (0 if self.letters[gap] else k - int(self.before[gap]))


def draws(id_col: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit draws from the seed and an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain: int = PLAIN, spm: int = SPM) -> DataFrame:
    """Each whole text cut into prefix, middle and suffix: doc_id, n, form, prefix_chars, middle_chars, output.

    ``n`` counts units. Prefix and middle end after the smaller and the larger of two draws from 0
    to n units. ``form`` is ``psm``, ``spm`` or ``plain``, whose output is the text; empty and null
    texts, those that hold a sentinel and ``plain`` of a hundred others are plain and have null
    lengths. Lengths are code points. The seed and the id decide all draws, so repeated ids draw
    alike, and rows without id as an empty one would; repeated rows each keep a row; an empty table
    gives no rows; other columns are ignored. A very long text costs its own size a few times over,
    in one task. One narrow scan.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Units()
        for b in batches:
            made = [_cut(find, t or "", *map(int, h), plain, spm) for t, *h in zip(b["t"], b["h1"], b["h2"], b["h3"], b["h4"], strict=True)]
            out = pd.DataFrame(made, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            out["prefix_chars"], out["middle_chars"] = out["prefix_chars"].astype("Int64"), out["middle_chars"].astype("Int64")
            yield pd.concat([b[["doc_id"]], out], axis=1)

    h = [d.alias(f"h{k}") for k, d in enumerate(draws(F.col(id_col), seed), 1)]
    kind = docs.schema[id_col].dataType.simpleString()
    # whole-number ids with nulls would be floats in pandas
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("t"), *h)
    made = rows.mapInPandas(run, "doc_id string, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumn("doc_id", F.col("doc_id").cast(kind))


def _cut(find: Units, text: str, h1: int, h2: int, h3: int, h4: int, plain: int, spm: int) -> tuple:
    found = find(text)
    if not text or found.sentinel or h3 % 100 >= 100 - plain:
        return found.n, "plain", None, None, text
    low, high = sorted((h1 % (found.n + 1), h2 % (found.n + 1)))
    a, b = found.end(low), found.end(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return found.n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return found.n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restored(output: Column, form: Column) -> Column:
    """The text of an output: its parts hold no sentinel and none can arise at their edges, so the three marks cut it uniquely."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    at = lambda *ks: F.concat(*[F.get(part, F.lit(k)) for k in ks])
    return F.when(form == "plain", output).when(form == "psm", at(1, 3, 2)).otherwise(at(2, 3, 1))
