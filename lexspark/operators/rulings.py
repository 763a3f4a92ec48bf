"""Rulings: header fields, sections, subsections, numbered paragraphs, items, and overlapping chunks.

Input is (document_id, text) with canonical texts. Marker positions come from an Arrow matcher;
extents, ids and hierarchy are column expressions and windows within a document.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rules
from ..functions import text as tx
from ..functions.matches import find_all
from ..sources.scratch import Scratch
from . import ranges

#: Chunk limits in characters.
CHUNK, OVERLAP, OVERLAP_LEAST, OVERLAP_MOST, RUNT = 4000, 0.20, 200, 1200, 0.20
#: Characters of an average page, for chunks without page extents.
PAGE = 3500

def header(docs: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Header fields of each ruling; with ``requests`` (document_id and fields), what the header lacks comes from there."""
    t = F.col("text")
    # each pattern goes over a text once: what it finds stands in a projection that the rest reads
    found = {"__number": F.regexp_extract(t, rules.RULING_NUMBER, 0), "__body": F.lower(F.regexp_extract(t, rules.RULING_BODY, 1)), "__outcome": F.lower(F.trim(F.regexp_extract(t, rules.RULING_OUTCOME, 1))), **{f"__{k}": F.trim(F.regexp_extract(t, p, 1)) for k, p in rules.RULING_HEADER.items()}}
    docs = docs.withColumns(found)
    body, outcome = F.col("__body"), F.col("__outcome")
    body = F.when(body.contains("plen"), "Plenario").when(body.rlike("1|primeira"), "1a_Camara").when(body.rlike("2|segunda"), "2a_Camara").otherwise("")
    fields = {k: F.col(f"__{k}") for k in rules.RULING_HEADER}
    fields["processo"] = F.when(fields["processo"] != "", F.concat(F.lit("TC "), fields["processo"])).otherwise("")
    summary = F.trim(F.regexp_replace(F.regexp_extract(t, rules.RULING_SUMMARY, 1), r"(?U)\s+", " "))
    outcome = F.concat(F.upper(F.left(outcome, F.lit(1))), F.substring(outcome, F.lit(2), F.length(outcome)))
    number = lambda g: F.regexp_extract("__number", rules.RULING_NUMBER, g)
    out = docs.select("document_id", number(1).alias("numero"), number(2).alias("ano"), body.alias("colegiado"), *[c.alias(k) for k, c in fields.items()], summary.alias("sumario"), outcome.alias("resultado"))
    if requests is None:
        return out
    shared = [c for c in out.columns if c in requests.columns and c != "document_id"]
    both = out.alias("h").join(requests.alias("r"), "document_id", "left")
    return both.select("document_id", *[F.coalesce(F.nullif(F.col(f"h.{c}"), F.lit("")), F.col(f"r.{c}").cast("string"), F.lit("")).alias(c) if c in shared else F.col(f"h.{c}") for c in out.columns if c != "document_id"])


def _part(t: Column, a: Column, z: Column) -> Column:
    return F.substring(t, a + 1, z - a)


def sections(docs: DataFrame) -> DataFrame:
    """Primary sections: the first RELATÓRIO and VOTO, the last ACÓRDÃO; each ends where the next begins."""
    m = docs.select("document_id", "text", find_all(F.col("text"), *rules.RULING_MARKERS.values()).alias("m"))
    of = lambda k: F.filter("m", lambda x: x["k"] == k)
    at = [F.try_element_at(of(0), F.lit(1)), F.try_element_at(of(1), F.lit(1)), F.try_element_at(of(2), F.lit(-1))]
    kinds = [F.when(x.isNotNull(), F.struct(x["start"].alias("start"), F.lit(k).alias("section_type"))) for x, k in zip(at, rules.RULING_MARKERS, strict=True)]
    found = m.withColumn("s", F.array_sort(F.array_compact(F.array(*kinds))))
    each = found.select("document_id", "text", F.posexplode("s").alias("seq", "x"), "s")
    end = F.coalesce(F.try_element_at("s", F.col("seq") + 2)["start"], F.length("text"))
    return each.select("document_id", "seq", F.col("x.section_type").alias("section_type"), F.col("x.start").alias("start"), end.alias("end"), _part(F.col("text"), F.col("x.start"), end).alias("raw"))


def subsections(report: DataFrame) -> DataFrame:
    """Headings within a report: decimal Roman before Roman before capitals; a heading of a lower rank goes where one of a higher stands (within 5 characters for capitals)."""
    m = report.withColumn("m", find_all(F.col("raw"), rules.HEADING_DECIMAL, rules.HEADING_ROMAN, rules.HEADING_UPPER))
    one = F.filter("m", lambda x: x["k"] == 0)
    two = F.filter("m", lambda x: (x["k"] == 1) & ~F.exists(one, lambda y: y["start"] == x["start"]))
    name = lambda x: F.trim(F.regexp_replace(x["g"][1], r"(?U)^\s+|\s+\z", ""))
    m = m.withColumn("ranked", F.concat(one, two))
    upper = F.filter("m", lambda x: (x["k"] == 2) & (F.length(name(x)) >= 4) & ~name(x).rlike(r"(?iuU)^(RELAT[OÓ]RIO|VOTO|AC[OÓ]RD[AÃ]O)\s*$") & ~F.exists(F.col("ranked"), lambda y: F.abs(y["start"] - x["start"]) < 5))
    m = m.withColumn("all", F.array_sort(F.transform(F.concat("ranked", upper), lambda x: F.struct(x["start"], x["k"], x["g"]))))
    each = m.select("document_id", "start", "end", "raw", "all", F.posexplode("all").alias("n", "x"))
    stop = F.coalesce(F.try_element_at("all", F.col("n") + 2)["start"], F.length("raw"))
    numbering = F.when(F.col("x.k") < 2, F.element_at("x.g", 2))
    heading = F.when(F.col("x.k") < 2, F.concat(numbering, F.lit(". "), F.trim(F.element_at("x.g", 3)))).otherwise(name(F.col("x")))
    depth = F.when(F.col("x.k") == 0, F.size(F.split(numbering, r"\."))).otherwise(1)
    own = F.concat(F.lit("SEC-RELATORIO-"), F.coalesce(numbering, tx.slug(heading)))
    out = each.select("document_id", "n", heading.alias("heading"), depth.alias("depth"), own.alias("id"), (F.col("start") + F.col("x.start")).alias("start"), (F.col("start") + stop).alias("end"), _part(F.col("raw"), F.col("x.start"), stop).alias("raw"))
    r = F.row_number().over(Window.partitionBy("document_id", "id").orderBy("start"))
    return out.withColumn("id", F.when(r > 1, F.concat_ws("-", "id", r.cast("string"))).otherwise(F.col("id")))


def _numbered(parts: DataFrame, pattern: str, compat: bool) -> DataFrame:
    """Numbered pieces of each part (.., start, raw): number, start and end in the document, text between markers."""
    m = parts.withColumn("m", find_all(F.col("raw"), pattern))
    if compat:  # a paragraph after a line that ends in a digit and a point is taken for a decimal item
        ends = lambda x: F.regexp_replace(F.substring(F.col("raw"), F.lit(1), x["start"]), r"(?U)\s+\z", "").rlike(r"\d\.\z")
        m = m.withColumn("m", F.filter("m", lambda x: ~ends(x)))
    # pieces are cut before they are rows of their own, so that no row carries the whole part or all its markers
    stop = lambda i: F.coalesce(F.try_element_at("m", i + 2)["start"], F.length("raw"))
    cut = F.transform("m", lambda x, i: F.struct(F.element_at(x["g"], 2).alias("num"), x["start"].alias("at"), _part(F.col("raw"), x["start"], stop(i)).alias("own")))
    kept = [c for c in parts.columns if c not in ("raw", "start", "end")]
    each = m.select(*kept, "start", F.inline(cut))
    each = each.withColumn("core", F.regexp_replace("own", r"(?U)^\s+|\s+\z", "")).where("core <> ''")
    first = F.col("start") + F.col("at") + F.instr("own", F.col("core")) - 1
    return each.select(*kept, "num", F.struct(F.col("core").alias("text"), first.alias("start"), (first + F.length("core")).alias("end")).alias("p"))


def devices(docs: DataFrame, pages: DataFrame | None = None, compat: bool = False) -> DataFrame:
    """The device table of rulings: sections, subsections, paragraphs and items, with ids, parents and children.

    Each kind of marker is matched once; sections, subsections and the devices before they are numbered are
    written, since several branches build on each.

    ``pages`` (document_id, page_number, start, end) places devices on pages; beyond the last one
    counts the last. ``compat`` skips paragraphs after a line that ends in a digit and a point.
    """
    scratch = Scratch(docs.sparkSession, "rulings")
    sec = scratch.keep(sections(docs))
    name, authority = (F.try_element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), F.col("section_type")) for m in (rules.SECTION_NAMES, rules.AUTHORITY))
    slug = F.create_map(*[F.lit(x) for kv in {"relatorio": "RELATORIO", "voto": "VOTO", "acordao": "ACORDAO"}.items() for x in kv])
    upper = F.element_at(slug, F.col("section_type"))
    sec = sec.withColumn("name", name).withColumn("id", F.concat(F.lit("SEC-"), upper))
    none = F.lit(0)
    cols = ["document_id", "order", "device_type", "base_id", "parent_span_id", "p", "identifier", "section_type", "section_path", "hierarchy_depth"]
    row = lambda df, order, kind, ident, parent, p, label, path, depth: df.select("document_id", order.alias("order"), F.lit(kind).alias("device_type"), ident.alias("base_id"), parent.alias("parent_span_id"), p.alias("p"), label.alias("identifier"), "section_type", path.alias("section_path"), depth.alias("hierarchy_depth"))
    rank = lambda seq, sub, own, at: F.struct(seq.cast("int").alias("seq"), sub.cast("int").alias("sub"), own.cast("int").alias("own"), at.cast("int").alias("at"))
    out = row(sec, rank(F.col("seq"), F.lit(-1), none, F.col("start")), "section", F.col("id"), F.lit(""), tx.strip_offsets(F.col("raw"), F.col("start")), F.col("name"), F.col("name"), none)

    report = sec.where("section_type = 'relatorio'")
    sub = scratch.keep(subsections(report)).join(report.select("document_id", "seq", "section_type", "name"), "document_id")
    path = F.concat_ws(" > ", "name", "heading")
    out = out.unionByName(row(sub, rank(F.col("seq"), F.col("n"), none, F.col("start")), "section", F.col("id"), F.lit("SEC-RELATORIO"), tx.strip_offsets(F.col("raw"), F.col("start")), F.col("heading"), path, F.col("depth")))

    # paragraphs lie in subsections where a report has any, else directly in their section
    direct = ranges.dealt(sec.where("section_type <> 'acordao'"), "document_id", "section_type").join(sub.select("document_id", F.lit("relatorio").alias("section_type")).distinct(), ["document_id", "section_type"], "left_anti")
    homes = direct.select("document_id", "seq", F.lit(-1).alias("sub"), "section_type", "id", F.col("name").alias("path"), "start", "raw").unionByName(
        sub.select("document_id", "seq", F.col("n").alias("sub"), "section_type", "id", path.alias("path"), "start", "raw")
    )
    par = _numbered(homes, rules.NUMBERED, compat)
    prefix = F.when(F.col("section_type") == "relatorio", "PAR-RELATORIO").otherwise("PAR-VOTO")
    out = out.unionByName(row(par, rank(F.col("seq"), F.col("sub"), F.lit(1), F.col("p.start")), "paragraph", F.concat_ws("-", prefix, "num"), F.col("id"), F.col("p"), F.col("num"), F.concat_ws(" > § ", "path", "num"), F.lit(2)))

    items = _numbered(sec.where("section_type = 'acordao'").select("document_id", "seq", "section_type", "name", "start", "raw"), rules.ITEM, False)
    depth = F.size(F.split("num", r"\.")) - 1
    parent = F.when(depth > 1, F.concat(F.lit("ITEM-"), F.regexp_replace("num", r"\.\d+$", ""))).otherwise("SEC-ACORDAO")
    out = out.unionByName(row(items, rank(F.col("seq"), F.lit(-1), F.lit(1), F.col("p.start")), "item_dispositivo", F.concat(F.lit("ITEM-"), F.col("num")), parent, F.col("p"), F.col("num"), F.concat_ws(" > ", "name", "num"), depth))

    r = F.row_number().over(Window.partitionBy("document_id", "base_id").orderBy("order"))
    out = scratch.keep(out.select(*cols)).withColumn("span_id", F.when(r > 1, F.concat_ws("-", "base_id", r.cast("string"))).otherwise(F.col("base_id")))
    kids = out.where("parent_span_id <> ''").groupBy("document_id", F.col("parent_span_id").alias("span_id")).agg(F.array_distinct(F.sort_array(F.collect_list(F.struct("order", F.col("span_id").alias("s"))))["s"]).alias("children_span_ids"))
    out = out.join(kids, ["document_id", "span_id"], "left")
    out = out.select(
        "document_id", "span_id", "parent_span_id", F.coalesce("children_span_ids", F.array().cast("array<string>")).alias("children_span_ids"), "device_type", "identifier", "section_type", authority.alias("authority_level"),
        "section_path", "hierarchy_depth", F.col("p.text").alias("text"), F.left(F.col("p.text"), F.lit(120)).alias("text_preview"), F.col("p.start").alias("char_start"), F.col("p.end").alias("char_end"), "order",
    )
    return on_pages(out, pages) if pages is not None else out.withColumn("page_number", F.lit(1))


#: Code points of a bin of offsets, and tasks over which the last page of a document is given.
BIN, LAST = 2048, 16


def on_pages(rows: DataFrame, pages: DataFrame, at: str = "char_start") -> DataFrame:
    """Adds the page whose extent holds an offset; the last page for offsets beyond or null, 1 for documents without pages.

    A range join by bins on the distinct offsets; of overlapping pages the first counts. The last
    page of a document stands in ``LAST`` bins of its own, so that a document of very many offsets is dealt too.
    """
    p = pages.select("document_id", "page_number", F.col("start").cast("long").alias("__low"), F.col("end").cast("long").alias("__high"))
    where = rows.select("document_id", F.col(at).cast("long").alias("__at")).distinct()
    hit = ranges.points_in(where, p, ["document_id"], "__at", "__low", "__high", BIN).groupBy("document_id", "__at").agg(F.min("page_number").alias("__hit"))
    last = p.groupBy("document_id").agg(F.max("page_number").alias("__last")).withColumn("__deal", F.explode(F.sequence(F.lit(0), F.lit(LAST - 1))))
    deal = lambda d, c: d.withColumn("__deal", F.pmod(F.hash(c), F.lit(LAST)))
    found = deal(where, "__at").join(last, ["document_id", "__deal"]).drop("__deal")
    found = found.join(hit, (found["document_id"] == hit["document_id"]) & found["__at"].eqNullSafe(hit["__at"]), "left").select(found["document_id"], found["__at"], F.coalesce("__hit", "__last").alias("__page"))
    # null offsets are equal to each other here
    mark = F.coalesce(F.col(at).cast("long"), F.lit(-(1 << 62)))
    found = found.select("document_id", F.coalesce("__at", F.lit(-(1 << 62))).alias("__at"), "__page")
    out = rows.drop("page_number").withColumn("__at", mark).join(found, ["document_id", "__at"], "left")
    return out.withColumn("page_number", F.coalesce("__page", F.lit(1))).drop("__page", "__at").select(*[c for c in rows.columns if c != "page_number"], "page_number")


def parsed_sections(device_table: DataFrame, docs: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """Sections with their paragraphs, and the ementa before the first of them (by its label, else by the header's summary)."""
    para = device_table.where("device_type <> 'section'").groupBy("document_id", "section_type").agg(F.sort_array(F.collect_list(F.struct(F.col("char_start").alias("start"), F.col("char_end").alias("end")))).alias("paragraphs"))
    tops = device_table.where("device_type = 'section' and hierarchy_depth = 0 and text <> ''").select("document_id", "section_type", "text", F.col("char_start").alias("start"), F.col("char_end").alias("end"))
    main = ranges.dealt(tops, "document_id", "section_type").join(para, ["document_id", "section_type"], "left")
    first = tops.groupBy("document_id").agg(F.min("start").alias("first"))
    d = docs.join(first, "document_id", "left").withColumn("area", F.left("text", F.coalesce("first", F.length("text"))))
    summary = F.lit("")
    if heads is not None:
        d = d.join(heads.select("document_id", "sumario"), "document_id", "left")
        summary = F.coalesce("sumario", F.lit(""))
    label = F.regexp_extract("area", rules.EMENTA, 0)
    label_at = F.length(F.regexp_extract("area", r"(?s)^(.*?)" + rules.EMENTA, 1))
    fall_at = F.instr(F.col("text"), F.left(summary, F.lit(60))) - 1
    fall = (summary != "") & (fall_at >= 0)
    e = d.select("document_id", F.lit("ementa").alias("section_type"), F.when(label != "", F.regexp_replace(label, r"(?U)\s+\z", "")).when(fall, F.substring(F.col("text"), fall_at + 1, F.length(summary))).alias("t"), F.when(label != "", label_at).otherwise(fall_at).alias("start"))
    e = e.where("t is not null").select("document_id", "section_type", F.col("t").alias("text"), "start", (F.col("start") + F.length("t")).alias("end"), F.lit(None).cast(para.schema["paragraphs"].dataType).alias("paragraphs"))
    return main.unionByName(e).withColumn("paragraphs", F.coalesce("paragraphs", F.array().cast(para.schema["paragraphs"].dataType)))


def pack(lens: list[int], head: int, tail: int, limit: int = CHUNK) -> list[tuple[int, int]]:
    """Ranges of paragraphs (first, after last) that fill chunks of ``limit`` characters with overlap.

    A chunk takes whole paragraphs, one at least. The next begins so many paragraphs back as cover a
    fifth of the chunk's text, but never at the chunk's own first, and with fewer where the paragraph
    after would not fit: every chunk reaches further than the one before, so packing ends.
    """
    out, i, n = [], 0, len(lens)
    while i < n:
        j, size = i, 0
        while j < n and (j == i or size + lens[j] <= limit):
            size, j = size + lens[j], j + 1
        out.append((i, j))
        if j >= n:
            break
        want = max(OVERLAP_LEAST, min(OVERLAP_MOST, int((size + (head if i == 0 else 0)) * OVERLAP)))
        k, back = j, 0
        while k > i + 1 and back < want:
            k -= 1
            back += lens[k]
        i = max(k, i + 1)
        while i < j and sum(lens[i:j]) + lens[j] > limit:  # overlap gives way to the next paragraph
            i += 1
    return out


def _packed(lens: Column, head: Column) -> Column:
    def run(lens: pd.Series, head: pd.Series) -> pd.Series:
        return pd.Series([[{"first": a, "last": b} for a, b in pack(list(x), h, 0)] for x, h in zip(lens, head, strict=True)])

    return F.pandas_udf(run, "array<struct<first:int,last:int>>").asNondeterministic()(lens, head)  # evaluated once


def chunk(parsed: DataFrame, heads: DataFrame) -> DataFrame:
    """Overlapping chunks of sections, by paragraphs, else by blank lines; a last chunk under a fifth of the limit joins the one before."""
    t = F.col("text")
    # blank-line pieces where a long section has no paragraphs
    pieces = F.filter(F.transform(F.split(t, "\n\n"), lambda x, i: F.struct(i.alias("i"), F.length(x).alias("n"), (F.trim(x) != "").alias("full"))), lambda x: x["n"] >= 0)
    starts = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,full:boolean>>").alias("o")),
                         lambda a, x: F.struct((a["at"] + x["n"] + 2).alias("at"), F.concat(a["o"], F.array(F.struct(a["at"].alias("start"), (a["at"] + x["n"]).alias("end"), x["full"].alias("full")))).alias("o")), lambda a: a["o"])
    natural = F.transform(F.filter(starts, lambda x: x["full"]), lambda x: F.struct((x["start"] + F.col("start")).cast("int").alias("start"), (x["end"] + F.col("start")).cast("int").alias("end")))
    long = F.length(t) > CHUNK
    p = parsed.withColumn("paragraphs", F.transform("paragraphs", lambda x: F.struct(x["start"].cast("int").alias("start"), x["end"].cast("int").alias("end"))))
    p = p.withColumn("paras", F.when(~long, F.array().cast("array<struct<start:int,end:int>>")).when(F.size("paragraphs") > 0, F.col("paragraphs")).when(F.size(F.split(t, "\n\n")) > 1, natural).otherwise(F.array().cast("array<struct<start:int,end:int>>")))
    packed = _packed(F.transform("paras", lambda x: x["end"] - x["start"]), F.when(F.size("paras") > 0, F.try_element_at("paras", F.lit(1))["start"] - F.col("start")).otherwise(F.lit(0)).cast("int"))
    p = p.withColumn("packed", packed)
    span = lambda x, i: F.struct(
        F.when(i == 0, F.col("start")).otherwise(F.element_at("paras", x["first"] + 1)["start"]).cast("int").alias("a"),
        F.when(x["last"] >= F.size("paras"), F.col("end")).otherwise(F.element_at("paras", x["last"])["end"]).cast("int").alias("z"),
    )
    p = p.withColumn("spans", F.when(F.size("packed") == 0, F.array(F.struct(F.col("start").cast("int").alias("a"), F.col("end").cast("int").alias("z")))).otherwise(F.transform("packed", span)))
    final = F.element_at("spans", -1)
    runt = (F.size("spans") > 1) & (final["z"] - final["a"] < int(CHUNK * RUNT))
    before = F.element_at("spans", F.size("spans") - 1)
    joined = F.concat(F.slice("spans", 1, F.greatest(F.size("spans") - 2, F.lit(0))), F.array(F.struct(before["a"].alias("a"), final["z"].alias("z"))))
    p = p.withColumn("spans", F.when(runt, joined).otherwise(F.col("spans")))
    each = p.select("document_id", "section_type", "text", "start", F.size("spans").alias("total_parts"), F.posexplode("spans").alias("k", "s")).join(heads, "document_id", "left")
    piece = F.substring(t, F.col("s.a") - F.col("start").cast("int") + 1, F.col("s.z") - F.col("s.a"))
    part = (F.col("k") + 1).alias("part_number")
    head_map, name_map, auth_map = (F.create_map(*[F.lit(x) for kv in m.items() for x in kv]) for m in ({"ementa": "SEC-EMENTA", "relatorio": "SEC-RELATORIO", "voto": "SEC-VOTO", "acordao": "SEC-ACORDAO"}, rules.SECTION_NAMES, rules.AUTHORITY))
    own = F.element_at(head_map, F.col("section_type"))
    own = F.when(F.col("total_parts") == 1, own).otherwise(F.concat(own, F.format_string("-P%02d", F.col("k") + 1)))
    return each.select(
        "document_id", own.alias("span_id"), "section_type", F.element_at(auth_map, F.col("section_type")).alias("authority_level"), F.element_at(name_map, F.col("section_type")).alias("section_path"),
        piece.alias("text"), F.concat_ws("\n", context(part), piece).alias("retrieval_text"), F.col("s.a").alias("canonical_start"), F.col("s.z").alias("canonical_end"),
        F.greatest(F.floor(F.col("s.a") / PAGE) + 1, F.lit(1)).cast("int").alias("page_number"), part, "total_parts",
    )


def context(part: Column) -> Column:
    """The line in front of a chunk's retrieval text: which ruling, which section, which part."""
    n, kind = F.coalesce("numero", F.lit("")), F.col("section_type")
    ref = F.when(n != "", F.concat(F.lit("Acórdão "), n, F.lit("/"), F.col("ano"), F.lit("-"), F.col("colegiado"))).otherwise("Acórdão")
    parts = F.when(F.col("total_parts") > 1, F.concat(F.lit(" | parte "), (F.col("k") + 1).cast("string"), F.lit(" de "), F.col("total_parts").cast("string"))).otherwise("")
    judge = F.when(F.coalesce("relator", F.lit("")) != "", F.concat(F.lit(" do Min. "), F.col("relator"))).otherwise("")
    what = F.when(kind == "ementa", "Ementa").when(kind == "relatorio", F.concat(F.lit("Relatório"), parts)).when(kind == "voto", F.concat(F.lit("Voto"), judge, parts)).when(kind == "acordao", "Dispositivo (decisão vinculante)").otherwise(kind)
    return F.concat(F.lit("[CONTEXTO: "), ref, F.lit(" | "), what, F.lit("]"))


def to_chunks(chunks: DataFrame, docs: DataFrame, heads: DataFrame) -> DataFrame:
    """Section chunks with ids, hash and header fields; rulings carry no citations of their own."""
    own = docs.select("document_id", tx.sha256(F.col("text")).alias("canonical_hash"))
    out = chunks.join(own, "document_id").join(heads.select("document_id", "colegiado", "processo", "relator", "data_sessao", "unidade_tecnica"), "document_id", "left")
    cid = F.concat_ws("#", "document_id", "span_id")
    return out.select(F.concat(F.lit("acordaos:"), cid).alias("node_id"), cid.alias("chunk_id"), F.lit("").alias("parent_node_id"), F.lit("section").alias("device_type"), F.lit("section").alias("chunk_level"), *out.columns)

