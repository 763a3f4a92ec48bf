"""Offsets of children within their parents' text."""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import matching_form
from . import ranges, recursion


def _quoted(text: Column) -> Column:
    """A text as a literal of a Java pattern."""
    return F.concat(F.lit("\\Q"), F.replace(text, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def resolve(rows: DataFrame) -> DataFrame:
    """Adds start, end and reason for each (canonical_text, parent_start, parent_end, chunk_text).

    A child is resolved if it stands exactly once in its parent's range with no letter or digit
    right before it; otherwise the reason says why not. Offsets are code points.
    """
    blank = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")
    r = rows.withColumn("__q", blank(F.coalesce("chunk_text", F.lit(""))))
    valid = (F.col("parent_start") >= 0) & (F.col("parent_end") > F.col("parent_start"))
    r = r.withColumn("__p", F.when(valid, F.substring(F.col("canonical_text"), F.col("parent_start") + 1, F.col("parent_end") - F.col("parent_start"))).otherwise(""))
    edge = F.lit(r"(?<![\p{L}\p{N}])")
    q = _quoted(F.col("__q"))
    # a look-ahead counts overlapping places too
    n = F.when(F.instr(F.col("__p"), F.col("__q")) > 0, F.size(F.regexp_extract_all(F.col("__p"), F.concat(edge, F.lit("(?="), q, F.lit(")")), F.lit(0)))).otherwise(0)
    at = F.length(F.expr(r"regexp_extract(__p, concat('(?s)^(.*?)(?<![\\p{L}\\p{N}])\\Q', replace(__q, '\\E', '\\E\\\\E\\Q'), '\\E'), 1)"))
    flat = lambda c: F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    why = (
        F.when(F.col("__q") == "", "EMPTY_TEXT")
        .when(~F.coalesce(valid, F.lit(False)), "INVALID_PARENT_RANGE")
        .when((n == 0) & (F.instr(flat(F.col("__p")), flat(F.col("__q"))) > 0), "NOT_FOUND_WHITESPACE_MISMATCH")
        .when(n == 0, "NOT_FOUND")
        .when(n > 1, "AMBIGUOUS_MULTIPLE_MATCHES")
    )
    r = r.withColumn("reason", why)
    start = F.when(F.col("reason").isNull(), F.col("parent_start") + at)
    return r.withColumn("start", start).withColumn("end", F.col("start") + F.length("__q")).drop("__q", "__p")


def resolve_tree(devices: DataFrame, canonical: DataFrame) -> DataFrame:
    """Offsets down the tree: (document_id, span_id, parent_span_id, text) with extents of the roots as char_start, char_end. One row for each device.

    A resolved parent's range is its own text, so each child is first placed within its parent's
    text, all at once; keys and numbers then pass document by document, which adds the parents' starts,
    at any depth. A device below an unresolved, missing or circular parent has INVALID_PARENT_RANGE.
    """
    n = ranges.parts(devices)
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)^\s+|\s+\z", "")
    top, under = devices.where("parent_span_id = ''"), devices.where("parent_span_id <> ''")
    size = F.col("char_end") - F.col("char_start")
    whole = top.join(canonical.select("document_id", "canonical_text"), "document_id", "left")
    whole = whole.select("document_id", F.col("span_id").alias("parent_span_id"), F.when((F.col("char_start") >= 0) & (size > 0), F.substring(F.col("canonical_text"), F.col("char_start") + 1, size)).alias("canonical_text"))
    above = whole.unionByName(under.select("document_id", F.col("span_id").alias("parent_span_id"), text.alias("canonical_text")))
    kids = under.select("document_id", "span_id", "parent_span_id", F.col("text").alias("chunk_text")).join(ranges.dealt(above, "document_id", "parent_span_id", n=n), ["document_id", "parent_span_id"], "left")
    kids = kids.withColumn("canonical_text", F.coalesce("canonical_text", F.lit(""))).withColumn("parent_start", F.lit(0)).withColumn("parent_end", F.length("canonical_text"))
    columns = ["document_id", "span_id", "parent_span_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "reason"]
    placed = resolve(kids).select(*columns)
    roots = top.withColumns({"start": F.col("char_start"), "end": F.col("char_end"), "reason": F.lit(None).cast("string")}).select(*columns)
    new = {"__start": T.LongType(), "__end": T.LongType(), "__why": T.StringType()}
    found = recursion.by_document(roots.unionByName(placed), ["span_id"], ["span_id", "parent_span_id", "start", "end", "reason"], recursion.placed_below, new)
    return found.select("document_id", "span_id", F.col("__start").alias("start"), F.col("__end").alias("end"), F.col("__why").alias("reason"))


#: Length of the grams that anchor a fuzzy search, edits that a stretch between anchors may take beyond its length, and the least similarity of a hit.
GRAM, SLACK, SIMILAR = 12, 24, 0.80
_NEXT_DEVICE = r"\n\s*(?:Art\.|§|Parágrafo|[IVXLCDM]+\s*[-–—]|[a-z]\))"


def anchors(parent: str, child: str, gram: int = GRAM) -> list[tuple[int, int]]:
    """Places (in the child, in the parent) of grams that stand once in both, the longest chain that grows in both. Sorted in n log n."""
    def single(t: str) -> dict[str, int]:
        at: dict[str, int] = {}
        for k in range(len(t) - gram + 1):
            g = t[k : k + gram]
            at[g] = -1 if g in at else k
        return at

    inside = single(parent)
    pairs = [(k, inside[g]) for g, k in single(child).items() if k >= 0 and inside.get(g, -1) >= 0]
    pairs.sort()
    ends, back, tops = [], [], []  # the smallest end of a chain of each length, and whence each pair came
    for n, (_, at) in enumerate(pairs):
        k = bisect.bisect_left(ends, at)
        back.append(tops[k - 1] if k else -1)
        if k == len(ends):
            ends.append(at), tops.append(n)
        else:
            ends[k], tops[k] = at, n
    chain, n = [], tops[-1] if tops else -1
    while n >= 0:
        chain.append(pairs[n])
        n = back[n]
    return chain[::-1]


def banded(a: str, b: str, most: int) -> int:
    """Edit distance of two texts within a band, ``most`` + 1 if it is more: (len + most) * most steps at the worst."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    last = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        row = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            best = last.get(j, most + 1) + 1
            if j:
                best = min(best, row.get(j - 1, most + 1) + 1, last.get(j - 1, most + 1) + (x != b[j - 1]))
            else:
                best = i
            row[j] = best
        if min(row.values()) > most:
            return most + 1
        last = row
    return min(last.get(len(b), most + 1), most + 1)


def place(parent: str, child: str) -> tuple[int, int, float] | None:
    """(start, end, similarity) of a child in its parent, both in matching form: anchors tell the shift, edits at the ends where it begins and ends.

    Similarity is one less the edits to the child's length; stretches between anchors that differ by
    more than SLACK edits count as wholly different.
    """
    chain = anchors(parent, child)
    if not chain:
        return None
    gram, edits = GRAM, 0
    (c0, p0), (c1, p1) = chain[0], chain[-1]
    for (ca, pa), (cb, pb) in zip(chain, chain[1:]):
        if cb - ca == pb - pa and child[ca:cb] == parent[pa:pb]:
            continue
        x, y = child[ca + gram : cb], parent[pa + gram : pb]
        if cb < ca + gram or pb < pa + gram:  # grams overlap: what one side has more
            edits += abs((cb - ca) - (pb - pa))
        else:
            edits += min(banded(x, y, SLACK), max(len(x), len(y)))

    def edge(own: str, other: str) -> tuple[int, int]:
        """Edits and length of the part of ``other`` that begins it and is most like ``own``."""
        most = min(SLACK, max(3, len(own) // 2))
        lengths = range(max(0, len(own) - 4), min(len(other), len(own) + 4) + 1)
        return min(((banded(own, other[:n], most), abs(n - len(own)), n) for n in lengths), default=(len(own), 0, 0))[::2]

    left, before = edge(child[:c0][::-1], parent[:p0][::-1][: c0 + 4])
    right, behind = edge(child[c1 + gram :], parent[p1 + gram :][: len(child) - c1 - gram + 4])
    edits += min(left, c0) + min(right, len(child) - c1 - gram)
    like = 1 - edits / max(len(child), 1)
    return p0 - before, p1 + gram + behind, like


@F.pandas_udf(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("similarity", T.DoubleType())]))
def fuzzy(parent: pd.Series, child: pd.Series) -> pd.DataFrame:
    """Place of a child in its parent when the two were read differently, misread beginnings included; the next device ends it.

    Grams that stand once in both anchor it, in the longest chain that grows in both; the stretches
    between and at the ends are compared by edits within a band. A child shorter than a gram, or whose grams all repeat, must stand
    in its parent once as it is. Null offsets if there is no anchor, or the texts are less than 0.8 similar.
    """
    import re

    end = re.compile(_NEXT_DEVICE)

    def one(p: str | None, c: str | None) -> tuple:
        if not p or not c or not c.strip():
            return None, None, None
        (np_, where), (nc, _) = matching_form(p), matching_form(c)
        got = place(np_, nc)
        if got is None:
            at = np_.find(nc)
            got = (at, at + len(nc), 1.0) if nc and at >= 0 and np_.find(nc, at + 1) < 0 else None
        if got is None:
            return None, None, None
        start = where[got[0]] if got[0] < len(where) else len(p)
        m = end.search(p, start + 1)
        stop = m.start() if m else len(p)
        return (start, stop, got[2]) if got[2] >= SIMILAR else (None, None, max(got[2], 0.0))

    out = pd.DataFrame([one(p, c) for p, c in zip(parent, child, strict=True)], columns=["start", "end", "similarity"])
    return out.astype({"start": "Int32", "end": "Int32"})
