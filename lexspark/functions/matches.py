"""Where patterns match in a text: the one thing that Spark's regular-expression functions cannot tell."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MATCHES = "array<struct<k:int,start:int,end:int,g:array<string>>>"


def find_all(text: Column, *patterns: str) -> Column:
    """All matches of Python patterns: (k: number of the pattern, start, end, g: groups from 0), offsets in code points.

    Arrow-batched. Patterns compile once a worker, and '' or null texts have no matches. The function counts
    as non-deterministic, so that Spark evaluates it once, whatever is built on it.
    """
    compiled: list[re.Pattern] = []

    @F.pandas_udf(MATCHES)
    def found(texts: pd.Series) -> pd.Series:
        if not compiled:
            compiled.extend(map(re.compile, patterns))
        one = lambda t: [{"k": k, "start": m.start(), "end": m.end(), "g": [m[0], *m.groups()]} for k, p in enumerate(compiled) for m in p.finditer(t)]
        return texts.map(lambda t: one(t) if t else [])

    return found.asNondeterministic()(text)


def leading(pattern: str) -> str:
    """The letters that every match of a pattern begins with, in lower case: those before the first sign, alternatives that share them included."""
    m = re.match(r"(?:\\b)?(?:\(\?:)?([A-Za-z]+)([?*{]?)", pattern)
    found = m[1][:-1] if m and m[2] else m and m[1]
    if not found:
        raise ValueError(f"no leading letters: {pattern}")
    return found.lower()


class Anchored:
    """Many patterns of any case over one text: an automaton of their leading letters says which can match where, and only there they are tried.

    The matches are those of ``finditer`` for each pattern by itself.
    """

    def __init__(self, patterns: list[str]):
        self.patterns = [re.compile(p, re.IGNORECASE) for p in patterns]
        by: dict[str, list[int]] = {}
        for k, p in enumerate(patterns):
            by.setdefault(leading(p), []).append(k)
        self.automaton = ahocorasick.Automaton()
        for word, ks in by.items():
            self.automaton.add_word(word, (len(word) - 1, ks))
        self.automaton.make_automaton()

    @staticmethod
    def _low(text: str) -> str:
        """Lower case of the same length; letters that ignoring case takes for others are those."""
        low = text.lower()
        if len(low) != len(text):
            low = "".join(c.lower() if len(c.lower()) == 1 else "i" if c == "İ" else c for c in text)
        return low.replace("ı", "i").replace("ſ", "s")

    def __call__(self, text: str) -> Iterator[tuple[int, re.Match]]:
        """(pattern, match), pattern by pattern, in order of places."""
        at: dict[int, list[int]] = {}
        for end, (back, ks) in self.automaton.iter(self._low(text)):
            for k in ks:
                at.setdefault(k, []).append(end - back)
        for k in sorted(at):
            last, match = 0, self.patterns[k].match
            for place in at[k]:
                if place >= last and (m := match(text, place)):
                    last = m.end()
                    yield k, m
