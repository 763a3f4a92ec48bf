"""Statutes: text blocks to a tree of devices (article, paragraph, inciso, alínea).

Blocks come as (document_id, page_number, block_index, text, char_start, char_end) with optional
bbox, has_strikethrough and first_flags (font flags of the first span). Every step is partitioned by
document_id, so one shuffle serves them all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import legal, rules, text
from . import ranges, recursion

DEVICES = ("article", "paragraph", "inciso", "alinea")


def with_defaults(blocks: DataFrame) -> DataFrame:
    """Blocks with the optional columns added."""
    extra = {"bbox": F.array().cast("array<double>"), "has_strikethrough": F.lit(False), "first_flags": F.lit(0)}
    return blocks.withColumns({c: v for c, v in extra.items() if c not in blocks.columns})


def split_pages(pages: DataFrame) -> DataFrame:
    """Blocks of transcribed pages (document_id, page_number, text), cut at device starts and blank lines.

    Pages are normalised, empty ones dropped, and joined by a line feed; offsets are those of the
    joined text, so text[char_start:char_end] is the block. Adds canonical_text's page extents.
    """
    clean = F.regexp_replace(F.regexp_replace(text.nfc(F.coalesce("text", F.lit(""))), r"(?U)[\s&&[^\n]]+(?=\n|\z)", ""), r"(?U)^\s+|\s+\z", "")
    kept = pages.select("document_id", "page_number", clean.alias("page")).where("page <> ''")
    before = Window.partitionBy("document_id").orderBy("page_number").rowsBetween(Window.unboundedPreceding, -1)
    kept = kept.withColumn("page_start", F.coalesce(F.sum(F.length("page") + 1).over(before), F.lit(0)))
    # a line of a page begins a block if it starts a device or follows a blank line; pages end with a line feed
    line = kept.select("document_id", "page_number", "page_start", F.posexplode(F.split("page", "\n")).alias("k", "line"))
    w = Window.partitionBy("document_id").orderBy("page_start", "k")
    line = line.withColumn("start", F.coalesce(F.sum(F.length("line") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    device = F.col("line").rlike(r"(?U)^\s*(?:Art\.\s*\d+|§\s*\d+|Parágrafo\s+[uú]nico|[IVXLCDM]+\s*[-–—]\s|[a-z]\)\s)")
    first = device | (F.coalesce(F.lag("line").over(w), F.lit("")) == "")
    line = line.withColumn("block", F.sum(first.cast("int")).over(w)).where("line <> ''")
    out = line.groupBy("document_id", "block").agg(
        F.min(F.struct("start", "page_number")).alias("at"),
        F.sort_array(F.collect_list(F.struct("start", "line"))).alias("lines"),
    )
    out = out.select("document_id", "block", F.col("at.page_number").alias("page_number"), F.array_join(F.col("lines.line"), "\n").alias("text"), F.col("at.start").alias("char_start"))
    number = (F.row_number().over(Window.partitionBy("document_id").orderBy("char_start")) - 1).alias("block_index")
    return out.select("document_id", "page_number", number, "text", F.col("char_start").cast("int").alias("char_start"), (F.col("char_start") + F.length("text")).cast("int").alias("char_end"))


def canonical_of_pages(pages: DataFrame) -> DataFrame:
    """(document_id, canonical_text) of transcribed pages, as ``split_pages`` joins them."""
    clean = F.regexp_replace(F.regexp_replace(text.nfc(F.coalesce("text", F.lit(""))), r"(?U)[\s&&[^\n]]+(?=\n|\z)", ""), r"(?U)^\s+|\s+\z", "")
    kept = pages.select("document_id", "page_number", clean.alias("page")).where("page <> ''")
    joined = F.array_join(F.sort_array(F.collect_list(F.struct("page_number", "page")))["page"], "\n")
    return kept.groupBy("document_id").agg(F.concat(joined, F.lit("\n")).alias("canonical_text"))


#: Points of a bin of heights on a page.
BAND = 64.0


def struck(blocks: DataFrame, strokes: DataFrame) -> DataFrame:
    """Blocks that a horizontal stroke crosses: longer than 20 points, flat, and over 0.3 of the block's width.

    Strokes are (document_id, page_number, x0, y0, x1, y1); a rectangle under 3 points high counts
    as one. A range join within a page by bands of heights. Blocks without a box are not struck.
    """
    keys = ["document_id", "page_number"]
    flat = strokes.where((F.col("x1") - F.col("x0") > 20) & (F.abs(F.col("y1") - F.col("y0")) < 3))
    mid = flat.select(*keys, "x0", "x1", ((F.col("y0") + F.col("y1")) / 2).alias("y"))
    boxes = blocks.select(*keys, "block_index", *[F.col("bbox")[k].alias(f"b{k}") for k in range(4)])
    over = (F.least("b2", "x1") - F.greatest("b0", "x0")) / F.nullif(F.col("b2") - F.col("b0"), F.lit(0.0))
    hit = ranges.points_in(mid, boxes, keys, "y", "b1", "b3", BAND, closed=True).where(over > 0.3)
    hit = hit.select(*keys, "block_index").distinct().withColumn("has_strikethrough", F.lit(True))
    out = blocks.drop("has_strikethrough").join(hit, [*keys, "block_index"], "left")
    return out.withColumn("has_strikethrough", F.coalesce("has_strikethrough", F.lit(False)))


def split_headers(blocks: DataFrame, compat: bool = False) -> DataFrame:
    """Cut a browser's page header off the text behind it, when more than 20 characters follow.

    The second block starts after the header and the blanks behind it; ``compat`` leaves those
    blanks out of its offset.
    """
    b = with_defaults(blocks)
    head = F.regexp_extract("text", rules.BROWSER_HEADER, 1)
    rest = F.expr("substring(text, length(__h) + 1)")
    core = F.regexp_replace(rest, r"(?U)^\s+|\s+\z", "")
    lead = F.lit(0) if compat else F.length(rest) - F.length(F.regexp_replace(rest, r"(?U)^\s+", ""))
    b = b.withColumn("__h", head)
    cut = (F.col("__h") != "") & (F.length(core) > rules.SPLIT_REST)
    part = lambda t, i, s, e: F.struct(t.alias("text"), i.alias("block_index"), s.alias("char_start"), e.alias("char_end"))
    whole = part(F.col("text"), F.col("block_index").cast("int"), F.col("char_start").cast("int"), F.col("char_end").cast("int"))
    at = (F.col("char_start") + F.length("__h")).cast("int")
    two = F.array(part(F.trim(F.regexp_replace("__h", r"(?U)\s+\z", "")), F.col("block_index").cast("int"), F.col("char_start").cast("int"), at), part(core, (F.col("block_index") + 10000).cast("int"), (at + lead).cast("int"), F.col("char_end").cast("int")))
    rows = b.withColumn("__p", F.explode(F.when(cut, two).otherwise(F.array(whole))))
    return rows.drop("text", "block_index", "char_start", "char_end", "__h").select("*", "__p.*").drop("__p")


def classify(blocks: DataFrame, compat: bool = False) -> DataFrame:
    """Kind, identifier and reason of each block, by a first-match cascade that compiles to one CASE."""
    b = with_defaults(blocks)
    t = F.regexp_replace("text", r"(?U)^\s+|\s+\z", "")
    has = lambda p: t.rlike(p)
    listed = has(rules.SUMMARY_LINE)
    caps = has(rules.ALL_CAPS) & (F.length(t) < 120)
    words = F.size(F.split(t, r"(?U)\s+"))
    count = lambda c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
    short = (F.length(t) < 60) & (count(".") <= 1) & (count(",") <= 1) & F.left(t, F.lit(1)).rlike(r"^\p{Lu}") & (words <= 10)
    bold = (F.length(t) < 80) & (F.col("first_flags").bitwiseAND(F.lit(16)) > 0)
    title = has(rules.CHAPTER) | caps | (~has(rules.LEGAL_MARKER_COMPAT if compat else rules.LEGAL_MARKER) & (bold | short))
    keyword = F.lit(False)
    for k in rules.METADATA_WORDS:
        keyword = keyword | t.contains(k)
    number = F.regexp_replace(F.regexp_extract(t, rules.ARTICLE, 1), r"\.", "").cast("long").cast("string")
    suffix = F.regexp_extract(t, rules.ARTICLE, 2)
    par = F.regexp_extract(t, rules.PARAGRAPH, 2)
    rom, ali = F.regexp_extract(t, rules.INCISO, 1), F.regexp_extract(t, rules.ALINEA, 1)
    art_id = F.concat(F.lit("Art. "), number, F.when(suffix != "", suffix).otherwise("º"))
    par_id = F.when(par != "", F.concat(F.lit("§ "), par.cast("int").cast("string"), F.lit("º"))).otherwise("Parágrafo único")
    row = lambda kind, ident, why: F.struct(F.lit(kind).alias("kind"), (F.lit(None).cast("string") if ident is None else ident).alias("identifier"), (F.lit(why) if isinstance(why, str) else why).alias("reason"))
    toc = row("metadata", None, "Linha de sumário/índice")
    preamble = F.lit(False)
    for p in rules.PREAMBLE:
        preamble = preamble | has(p)
    case = F.when(t == "", row("metadata", None, "Bloco vazio"))
    for pattern, kind, ident, why in ((rules.ARTICLE, "article", art_id, art_id), (rules.PARAGRAPH, "paragraph", par_id, par_id), (rules.INCISO, "inciso", rom, F.concat(F.lit("Inciso "), rom)), (rules.ALINEA, "alinea", ali, F.concat(F.lit("Alínea "), ali))):
        case = case.when(has(pattern) & listed, toc).when(has(pattern), row(kind, ident, why))
    case = (
        case.when(keyword | has(rules.METADATA_STAMP), row("metadata", None, "Keyword estática"))
        .when(has(rules.PAGINATION), row("metadata", None, "Paginação solta"))
        .when(has(rules.ISSUER), row("metadata", None, "Órgão emissor"))
        .when(has(rules.NORM_NAME), row("cabecalho", None, "Nome da norma"))
        .when(preamble, row("preambulo", None, "Preâmbulo"))
        .when(has(rules.SUMMARY_VERB), row("preambulo", None, "Ementa"))
        .when(title, row("cabecalho", None, "Texto título/cabeçalho"))
        .otherwise(row("nao_classificado", None, "Sem match"))
    )
    revoked = F.col("has_strikethrough") | F.lower(F.regexp_replace(t, r"(?U)\s+", " ")).contains(rules.EXPIRED)
    return b.withColumn("__c", case).withColumn("is_revoked", revoked).select("*", "__c.kind", "__c.identifier", "__c.reason").drop("__c")


def hierarchy(classified: DataFrame) -> DataFrame:
    """Carry article, paragraph and inciso forward in reading order; adds span_id, parent_span_id, depth and accepted.

    The paragraph in force is the last one behind the last article, the inciso the last one behind the
    last paragraph and article: one window over a document's blocks, numbered, and one sort. Devices
    below no article are not accepted. Documents are dealt over partitions of an even share of the input.
    """
    doc = Window.partitionBy("document_id").orderBy("char_start", "block_index")
    kind = lambda k: F.col("kind") == k
    last = lambda when, *v: F.last(F.when(when, F.struct(F.col("__at").alias("at"), *[x.alias(f"v{i}") for i, x in enumerate(v)])), ignorenulls=True).over(doc)
    number = F.regexp_extract("identifier", r"(\d+)", 1).cast("int")
    suffix = F.regexp_extract("identifier", r"\d(?:[º°o])?(-[A-Za-z]+)?", 1)
    single = F.lower("identifier").rlike("(?iu)[uú]nico")
    par_number, inc_name = F.when(single, 0).otherwise(number), F.upper("identifier")
    b = ranges.dealt(classified, "document_id", n=ranges.parts(classified)).withColumn("__at", F.row_number().over(doc))
    b = b.withColumns({
        "art": last(kind("article"), number, suffix), "__p": last(kind("paragraph")), "par": last(kind("paragraph") & par_number.isNotNull(), par_number), "inc": last(kind("inciso") & inc_name.isNotNull(), inc_name),
    })
    since = lambda x, y: F.coalesce(F.col(x)["at"] > F.col(y)["at"], F.col(x).isNotNull())
    in_force = lambda x, *y: F.when(reduce(lambda p, q: p & q, [since(x, z) for z in y]), F.col(x)["v0"])
    k, n, s, par, inc = F.col("kind"), F.col("art.v0"), F.col("art.v1"), in_force("par", "art"), in_force("inc", "art", "__p")
    none, nothing = F.lit(None).cast("int"), F.lit(None).cast("string")
    own = lambda kind, ident, p, i: legal.span_id(F.lit(kind), ident, n, s, p, i)
    of_art, of_par, of_inc = own("article", nothing, none, nothing), own("paragraph", nothing, par, nothing), own("inciso", inc, par, nothing)
    is_device, below = k.isin(*DEVICES), F.col("art").isNotNull()
    accepted = is_device & (below | (k == "article"))
    span = F.when(k == "article", of_art).when(k == "paragraph", of_par).when(k == "inciso", own("inciso", F.col("identifier"), par, nothing)).when(k == "alinea", own("alinea", F.col("identifier"), par, inc))
    parent = (
        F.when(k == "paragraph", of_art)
        .when(k == "inciso", F.when(par.isNotNull(), of_par).otherwise(of_art))
        .when(k == "alinea", F.when(inc.isNotNull(), of_inc).when(par.isNotNull(), of_par).otherwise(of_art))
    )
    depth = F.when(k == "paragraph", 1).when(k == "inciso", F.when(par.isNotNull(), 2).otherwise(1)).when(k == "alinea", F.when(inc.isNotNull() & par.isNotNull(), 3).when(inc.isNotNull() | par.isNotNull(), 2).otherwise(1)).otherwise(0)
    keep = lambda c: F.when(accepted, c)
    b = b.select("*", accepted.alias("accepted"), keep(span).alias("span_id"), keep(parent).alias("parent_span_id"), keep(depth).alias("hierarchy_depth"))
    return b.drop("__at", "__p", "art", "par", "inc")


def merge_orphans(tree: DataFrame) -> DataFrame:
    """Append unclassified blocks to the device before them.

    An as-of step gives each orphan its device (the last one that starts earlier), and a window over a
    device and its orphans, within the document's partition, lists them; a fold over them in order appends one if it starts at most 1500 characters after the device's
    own end, or if the text so far ends in a comma or a function word. Offsets stay the device's.
    Result: the devices, with full_text and n_merged.
    """
    w = Window.partitionBy("document_id").orderBy("char_start").rangeBetween(Window.unboundedPreceding, -1)
    rows = tree.where(F.col("accepted") | (F.col("kind") == "nao_classificado") | F.col("kind").isin(*DEVICES))
    earlier = F.when(F.col("accepted"), F.struct("char_start", "block_index", "page_number"))
    rows = rows.withColumn("at", F.last(earlier, ignorenulls=True).over(w))
    core = F.regexp_replace("text", r"(?U)^\s+|\s+\z", "")
    rows = rows.withColumn("at", F.coalesce(earlier, F.when(core != "", F.col("at")))).where("at is not null")
    own = Window.partitionBy("document_id", "at")
    devices = rows.withColumn("o", F.sort_array(F.collect_list(F.when(~F.col("accepted"), F.struct("char_start", "block_index", core.alias("core")))).over(own))).where("accepted").drop("at")

    def step(a: Column, x: Column) -> Column:
        near = x["char_start"] - F.col("char_end") <= rules.MERGE_GAP
        take = near | F.regexp_replace(a["t"], r"(?U)^\s+|\s+\z", "").rlike(rules.OPEN_ENDED)
        return F.struct(F.when(take, F.concat(a["t"], F.lit("\n"), x["core"])).otherwise(a["t"]).alias("t"), (a["n"] + take.cast("int")).alias("n"))

    start = F.struct(F.col("text").alias("t"), F.lit(0).alias("n"))
    devices = devices.withColumn("m", F.when(F.size("o") == 0, start).otherwise(F.aggregate("o", start, step)))
    return devices.withColumn("full_text", F.col("m.t")).withColumn("n_merged", F.col("m.n")).drop("m", "o")


def dedup_versions(devices: DataFrame) -> DataFrame:
    """One device for each span id: the last that is not revoked, else the last."""
    w = Window.partitionBy("document_id", "span_id").orderBy(F.col("is_revoked").asc(), F.col("char_start").desc(), F.col("block_index").desc())
    return devices.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def link_children(devices: DataFrame) -> DataFrame:
    """Adds children_span_ids in structural order (kind, number with Roman numerals by value, then position)."""
    kids = devices.where("parent_span_id is not null").groupBy("document_id", F.col("parent_span_id").alias("span_id")).agg(
        F.sort_array(F.collect_list(F.struct(legal.child_order(F.col("span_id")).alias("o"), "char_start", F.col("span_id").alias("s"))))["s"].alias("children_span_ids")
    )
    kids = ranges.dealt(kids, "document_id", "span_id", n=ranges.parts(devices))  # the devices follow to as many partitions
    out = devices.join(kids, ["document_id", "span_id"], "left")
    return out.withColumn("children_span_ids", F.coalesce("children_span_ids", F.array().cast("array<string>")))


def devices(blocks: DataFrame, compat: bool = False) -> DataFrame:
    """The device table of blocks: header split, cascade, hierarchy, orphans, versions, children."""
    tree = merge_orphans(hierarchy(classify(split_headers(blocks, compat), compat)))
    out = link_children(dedup_versions(tree))
    return out.select(
        "document_id", "span_id", F.coalesce("parent_span_id", F.lit("")).alias("parent_span_id"), "children_span_ids", F.col("kind").alias("device_type"), F.coalesce("identifier", F.lit("")).alias("identifier"),
        F.regexp_extract("span_id", r"^[A-Z]+-(\d+)", 1).cast("int").alias("article_number"), "hierarchy_depth", F.col("full_text").alias("text"), F.left("text", F.lit(120)).alias("text_preview"),
        "char_start", "char_end", "page_number", "bbox", "is_revoked", "n_merged",
    )


def stats(device_table: DataFrame) -> DataFrame:
    """Counts of each document: devices, by type, and the greatest depth."""
    kinds = device_table.groupBy("document_id", "device_type").agg(F.count(F.lit(1)).alias("n"), F.max("hierarchy_depth").alias("d"), F.sum("n_merged").alias("m"))
    return kinds.groupBy("document_id").agg(
        F.sum("n").alias("devices"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("device_type", "n")))).alias("by_device_type"), F.max("d").alias("max_hierarchy_depth"), F.sum("m").alias("orphans_merged")
    )


def ocr_quality(device_table: DataFrame, canonical: DataFrame, pages: DataFrame) -> DataFrame:
    """Warnings of each document (document_id, warnings): no article, under 100 characters a page, under a device a page beyond two pages."""
    n = device_table.groupBy("document_id").agg(F.count_if(F.col("device_type") == "article").alias("articles"), F.count(F.lit(1)).alias("devices"))
    p = pages.groupBy("document_id").agg(F.count(F.lit(1)).alias("pages"))
    c = canonical.select("document_id", F.length("canonical_text").alias("chars"))
    d = p.join(c, "document_id", "left").join(n, "document_id", "left").na.fill(0, ["chars", "articles", "devices"])
    checks = F.array(
        F.when(F.col("articles") == 0, "QG1"), F.when(F.col("chars") / F.col("pages") < 100, "QG2"), F.when((F.col("pages") > 2) & (F.col("devices") / F.col("pages") < 1), "QG3")
    )
    return d.select("document_id", F.array_compact(checks).alias("warnings"))


def subtree_text(device_table: DataFrame) -> DataFrame:
    """retrieval_text of each device: its text and its subtree's, depth first in structural order, however deep.

    A document's devices pass once, siblings in order; a span that leads back to itself ends there.
    """
    order = legal.child_order(F.col("span_id"))
    return recursion.by_document(device_table, [order["kind"], order["number"], F.col("char_start").cast("long"), "span_id", "text"], ["span_id", "parent_span_id", "text"], recursion.subtrees, {"retrieval_text": T.StringType()})


def to_chunks(device_table: DataFrame, requests: DataFrame, canonical: DataFrame) -> DataFrame:
    """Chunks of devices. ``requests`` has document_id, tipo_documento, numero, ano; ``canonical`` the text of each document."""
    near = lambda df: ranges.dealt(df, "document_id", n=ranges.parts(device_table))  # noqa: E731  # the devices follow to as many partitions
    hashes = near(canonical.select("document_id", text.sha256(F.col("canonical_text")).alias("canonical_hash")))
    t = subtree_text(device_table).join(near(requests), "document_id").join(hashes, "document_id", "left")
    chunk = F.concat_ws("#", "document_id", "span_id")
    return t.select(
        F.concat(F.lit("leis:"), chunk).alias("node_id"), chunk.alias("chunk_id"),
        F.when(F.col("parent_span_id") != "", F.concat(F.lit("leis:"), F.concat_ws("#", "document_id", "parent_span_id"))).otherwise("").alias("parent_node_id"),
        "span_id", "device_type", F.when(F.col("device_type") == "article", "article").otherwise("device").alias("chunk_level"), "text",
        F.when(F.col("device_type") == "article", F.col("retrieval_text")).otherwise(F.col("text")).alias("retrieval_text"),
        "document_id", "tipo_documento", "numero", "ano", F.when(F.col("article_number") > 0, F.col("article_number").cast("string")).otherwise("").alias("article_number"),
        F.col("char_start").alias("canonical_start"), F.col("char_end").alias("canonical_end"), F.coalesce("canonical_hash", F.lit("")).alias("canonical_hash"),
        "page_number", "bbox", F.lit(1.0).alias("confidence"), F.lit(False).alias("is_cross_page"), F.lit(0).alias("n_bbox_spans"),
    )
