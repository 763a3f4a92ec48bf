"""Citations of norms and devices in text, with typed relations.

Patterns are matched once, where an automaton of their leading letters says that they can, in an Arrow function that returns offsets and the text near each match;
everything after that (years, ids, devices before and after, confidence, relation type,
de-duplication) is column expressions on that, so texts are neither repeated nor shuffled.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import legal, rules
from ..functions.matches import Anchored

def full_year(digits: Column) -> Column:
    """Four digits of a year of two (below 50: 2000s); other lengths stay."""
    return F.when(F.length(digits) == 2, F.when(digits.try_cast("int") < 50, F.concat(F.lit("20"), digits)).otherwise(F.concat(F.lit("19"), digits))).otherwise(digits)


def valid_year(kind: Column, number: Column, year: Column) -> Column:
    """The year on record for a norm, else the one found if it is possible for the kind, else null."""
    known = F.try_element_at(legal._map({f"{k}|{n}": y for (k, n), y in rules.NORM_YEARS.items()}), F.concat_ws("|", kind, number))
    bounds = lambda j: F.coalesce(F.try_element_at(legal._map({k: v[j] for k, v in rules.YEAR_BOUNDS.items()}), kind), F.lit(rules.YEAR_BOUNDS_ELSE[j]))
    y = year.try_cast("int")
    return F.coalesce(known, F.when(y.between(bounds(0), bounds(1)), y))


def norm_id(kind: Column, number: Column, year: Column, compat: bool = False) -> Column:
    """Document id of a cited norm: rulings as AC-number-year, others checked against the years on record.

    The constitution has no number and is CF-1988; ``compat`` leaves it without an id.
    """
    n = F.regexp_replace(F.regexp_replace(number, r"\.", ""), r"^0+(?=\d)", "")
    two = F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n)
    out = F.when(kind == "ACORDAO", F.concat_ws("-", F.lit("AC"), n, F.nullif(year, F.lit(""))))
    out = out.otherwise(legal.document_id(F.concat_ws("-", kind, two, valid_year(kind, n, year).cast("string"))))
    none = F.lit(None).cast("string") if compat else F.lit("CF-1988")
    return F.when(kind == "CF", none).when(F.coalesce(number, F.lit("")) != "", out)


_MATCH = "array<struct<k:int,start:int,end:int,g:array<string>,before:string,after:string,led:array<string>,followed:array<string>>>"


def _matches(texts: pd.Series) -> pd.Series:
    """Norms (k by precedence) and devices (k after the last norm) of each text, with the text around them.

    ``led`` has the groups of the device that directly precedes a norm: article, further numbers,
    paragraph, inciso, alínea. ``followed`` has article, paragraph, inciso and alínea of the first device
    within 100 characters after it, looked for in turn.
    """
    if not _compiled:
        flags = re.IGNORECASE
        _compiled.update(cited=Anchored([*(p for _, p in rules.NORMS), rules.DEVICE_CITED]), before=re.compile(rules.DEVICE_BEFORE, flags), parts=[re.compile(p, flags) for p in rules.DEVICE_PARTS])
    last, near = len(rules.NORMS), rules.REL_WINDOW

    def followed(rest: str) -> list[str | None]:
        out = []
        for p, reach in zip(_compiled["parts"], (100, 50, 50, 30), strict=True):
            m = p.search(rest[:reach])
            out.append(m and m[1])
            if m:
                rest = rest[m.end() :]
            elif len(out) == 1:
                break
        return out + [None] * (4 - len(out))

    def one(t: str) -> list[dict]:
        out = []
        for k, m in _compiled["cited"](t):
            a, z = m.span()
            row = {"k": k, "start": a, "end": z, "g": [m[0], *m.groups()], "before": t[max(a - near, 0) : a], "after": t[z : z + near], "led": None, "followed": None}
            if k < last:
                d = _compiled["before"].search(t[max(a - 100, 0) : a])
                row |= {"led": d and list(d.groups()), "followed": followed(t[z : z + 100])}
            out.append(row)
        return out

    return texts.map(lambda t: one(t) if t else [])


_compiled: dict = {}


def _once(text: Column) -> Column:
    """The matches of a text. The function counts as non-deterministic, so that Spark evaluates it once, whatever is built on it."""
    return F.pandas_udf(_matches, _MATCH).asNondeterministic()(text)


def further_articles(first: Column, listed: Column) -> Column:
    """Article numbers that a list adds to its first: every number of an enumeration, or a range of at most 20."""
    stop = F.regexp_extract(listed, r"(?U)\s+a\s+(\d+)", 1).try_cast("int")
    one = first.try_cast("int")
    span = F.when((stop - one).between(1, 20), F.transform(F.sequence(one + 1, stop), lambda n: n.cast("string"))).otherwise(F.array().cast("array<string>"))
    listing = F.regexp_extract_all(listed, F.lit(r"(\d+)"), 1)
    return F.when(F.coalesce(listed, F.lit("")) == "", F.array().cast("array<string>")).when(stop.isNotNull(), span).otherwise(listing)


def extract(chunks: DataFrame, key: str = "node_id", compat: bool = False) -> DataFrame:
    """References of each chunk (``key``, text, document_id) in order: norms by precedence, then devices of the chunk's own document.

    Result: key, ordinal, raw, type, doc_id, span_ref, target_node_id, method, confidence, is_ambiguous,
    rel_type, rel_type_confidence. A norm and device are listed once a chunk. ``compat`` also drops a
    second mention of the same wording though it cites another device, and takes the first two to
    four digits after a norm for its year, be they the day of its date.
    """
    norms = rules.NORMS
    src = chunks.select(F.col(key).alias("key"), F.coalesce("document_id", F.lit("")).alias("own"), _once(F.col("text")).alias("m"))
    # one row a match, norm or device, with the text around it; where the norms stand goes along for the devices
    places = F.transform(F.filter("m", lambda x: x["k"] < len(norms)), lambda x: F.struct(x["start"], x["end"]))
    each = src.select("key", "own", places.alias("norms"), F.explode("m").alias("x")).select("key", "own", "norms", "x.*")
    norm = F.col("k") < len(norms)
    g = [F.try_element_at("g", F.lit(j + 1)) for j in range(6)]
    after = F.lower(F.left("after", F.lit(50)))
    outside = reduce(lambda a, b: a | b, [after.contains(h) for h in rules.EXTERNAL_HINTS]) & ~F.left(after, F.lit(30)).contains("desta")
    near = F.exists("norms", lambda x: x["start"].between(F.col("start"), F.col("end") + 60) | ((F.col("start") >= x["start"] - 120) & (F.col("end") <= x["start"])))
    each = each.withColumn("outside", ~norm & outside).where(norm | (F.length(g[0]) >= 4) & ~(F.col("outside") & near)).drop("norms")

    rest = F.left("after", F.lit(20))
    short = F.regexp_extract(rest, rules.YEAR_AFTER, 1)
    long = F.regexp_extract(rest, r"[/\s](\d{4})(?!\d)", 1)
    dated = F.regexp_extract(F.left("after", F.lit(45)), r"(?U)^\s*,?\s*de\s+\d{1,2}[º°]?\s+de\s+\p{L}+\s+de\s+(\d{4})", 1)
    undated = F.regexp_extract(rest, r"(?U)[/\s](\d{2,4})(?!\d|[º°]?\s+de\s)", 1)
    year = short if compat else F.coalesce(*[F.nullif(y, F.lit("")) for y in (dated, long, undated)])
    own_year = F.when(g[2].rlike(r"^\d+$"), g[2])
    n = each.withColumns({
        "type": F.when(norm, F.element_at(F.array(*[F.lit(k) for k, _ in rules.NORMS]), F.col("k") + 1)).otherwise("INTERNO"),
        "number": F.when(norm, F.regexp_replace(g[1], r"\.", "")), "year": F.when(norm, full_year(F.coalesce(own_year, F.nullif(year, F.lit(""))))),
        "found": F.concat(g[0], F.when(norm, F.regexp_extract(rest, rf"(?s)^.*?{rules.YEAR_AFTER}", 0)).otherwise("")),
    })
    if compat:
        first = Window.partitionBy("key", F.when(norm, F.lower(g[0])).otherwise(F.col("start").cast("string"))).orderBy("k", "start")
        n = n.withColumn("r", F.row_number().over(first)).where("r = 1").drop("r")
    cited = norm_id(F.col("type"), F.col("number"), F.col("year"), compat)
    n = n.withColumn("doc_id", F.when(norm, cited).otherwise(F.nullif("own", F.lit(""))))

    none = F.lit(None).cast("string")
    empty = F.array().cast("array<string>")
    plain = F.coalesce(*g[2:6]).isNull()
    tail = F.regexp_extract(F.left("after", F.lit(60)), r"(?U)^(\s+a\s+\d+|(?:\s*,\s*\d+[ºo°]?)*(?:\s+e\s+\d+)?)", 1)
    led, followed = ([F.nullif(F.try_element_at(c, F.lit(j + 1)), F.lit("")) for j in range(5)] for c in ("led", "followed"))
    before = F.when(led[0].isNotNull(), legal.span_ref(led[0], led[2], led[3], led[4]))
    behind = F.when(followed[0].isNotNull(), legal.span_ref(*followed[:4]))
    article, listed = led[0], F.when(led[2].isNull() & led[3].isNull() & led[4].isNull(), led[1])
    n = n.withColumns({
        "span": F.when(norm, F.coalesce(before, behind)).otherwise(legal.span_ref(g[1], g[2], g[3], g[4], compat)),
        "more": F.when(norm, further_articles(article, listed)).otherwise(F.when(plain, further_articles(g[1], tail)).otherwise(empty)),
    })
    more = F.when(~norm | F.col("span").isNotNull() & F.col("doc_id").isNotNull(), F.col("more"))
    spans = F.concat(
        F.array(F.struct(F.trim("found").alias("raw"), "span")),
        F.transform(F.coalesce(more, empty), lambda a: F.struct(F.when(norm, F.trim("found")).otherwise(F.concat(F.lit("art. "), a)).alias("raw"), legal.span_ref(a, none, none, none).alias("span"))),
    )
    n = n.withColumn("context", F.concat("before", g[0], "after")).select("key", "own", "k", "start", "type", "number", "year", "doc_id", "outside", "context", F.posexplode(spans).alias("j", "x"))
    # a norm and device count once a chunk, a device of the chunk's own document once in each wording
    same = [F.when(norm, F.coalesce("doc_id", F.lit("None"))), F.when(norm, F.coalesce("x.span", F.lit(""))).otherwise(F.lower("x.raw"))]
    once = Window.partitionBy("key", *same).orderBy("k", "start", "j")
    n = n.withColumn("r", F.row_number().over(once)).where("r = 1")
    # what only the references that stay need
    known = F.col("own") != ""
    sure = legal.citation_confidence(F.col("number"), F.col("year"), F.col("doc_id"))
    if not compat:
        sure = F.when(F.col("type") == "CF", F.struct(F.lit(0.95).alias("confidence"), F.lit(False).alias("is_ambiguous"))).otherwise(sure)
    sure = F.when(norm, sure).otherwise(F.struct(F.when(F.col("outside"), 0.6).when(known, 0.9).otherwise(0.5).alias("confidence"), (~known).alias("is_ambiguous")))
    prefix = F.when(F.col("type") == "ACORDAO", "acordaos:").otherwise("leis:")
    target = F.when(F.col("doc_id").isNotNull(), F.concat(prefix, F.concat_ws("#", "doc_id", "x.span")))
    ordinal = F.row_number().over(Window.partitionBy("key").orderBy("k", "start", "j"))
    out = n.select("key", ordinal.alias("ordinal"), "x.raw", "type", "doc_id", F.col("x.span").alias("span_ref"), target.alias("target_node_id"), sure.alias("sure"), legal.rel_type(F.col("context")).alias("rel"))
    return out.select(F.col("key").alias(key), "ordinal", "raw", "type", "doc_id", "span_ref", "target_node_id", F.lit("regex").alias("method"), "sure.*", "rel.*")


def normalise(citations: DataFrame, chunks: DataFrame, compat: bool = False) -> DataFrame:
    """Citations without blanks, loops to the chunk or its parent, and repeats; the first of equal targets stays.

    ``citations`` has node_id, ordinal, target_node_id and any other columns; ``chunks`` node_id,
    parent_node_id. ``compat`` keeps loops to the parent, as when its id is prefixed twice.
    """
    c = citations.withColumn("target_node_id", F.trim("target_node_id")).where("target_node_id <> ''")
    c = c.join(chunks.select("node_id", "parent_node_id"), "node_id")
    c = c.where(F.col("target_node_id") != F.col("node_id"))
    if not compat:
        c = c.where(F.coalesce("parent_node_id", F.lit("")) != F.col("target_node_id"))
    w = Window.partitionBy("node_id", "target_node_id").orderBy("ordinal")
    return c.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "parent_node_id")


def as_array(citations: DataFrame) -> DataFrame:
    """(node_id, citations): the payload of a chunk, in order."""
    payload = F.struct("ordinal", F.struct("target_node_id", "rel_type", "rel_type_confidence").alias("c"))
    return citations.groupBy("node_id").agg(F.sort_array(F.collect_list(payload))["c"].alias("citations"))


def to_json(citations: DataFrame) -> DataFrame:
    return as_array(citations).select("node_id", F.to_json("citations").alias("citations"))
