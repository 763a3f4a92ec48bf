"""Queries on statutes: cascade, hierarchy, orphans, versions, trees, consolidation, contracts, manifests."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import legal, rules
from ..operators import consolidation, offsets, origin, quality, ranges, registry, statutes, vectors
from ..sources import stores
from .base import SQL_CANONICAL, query, re2, t

_LINES = (
    "Art. {k}º Texto do artigo.", "§ {k}º Texto do parágrafo.", "Parágrafo único. Texto.", "IV - texto do inciso;", "b) texto da alínea;", "Publicado em: {k}", "{k} / 12", "Órgão: Ministério",
    "DECRETO Nº {k}", "O PRESIDENTE DA REPÚBLICA", "Dispõe sobre {k}", "CAPÍTULO I", "DAS DISPOSIÇÕES GERAIS", "Art. {k}-A Texto com sufixo.", "texto solto que continua a frase anterior, sem marca alguma, com mais de uma vírgula, e segue.",
    "Art. {k} ..................... 12", "Do Objeto", "",
)
#: A line by the remainder of the order's key, in both dialects.
_LINE = "CASE o_orderkey % 18 " + " ".join(f"WHEN {i} THEN concat('{x.split('{k}')[0]}'" + (f", cast(o_orderkey % 90 + 1 as string), '{x.split('{k}')[1]}')" if "{k}" in x else ", '')") for i, x in enumerate(_LINES)) + " END"


def _m(p: str, text: str = "x") -> str:
    return f"regexp_matches({text}, '{re2(p)}')"


_PREAMBLE = " OR ".join(_m(p) for p in rules.PREAMBLE)
_CASCADE = f"""CASE WHEN x = '' THEN 'metadata' WHEN {_m(rules.ARTICLE)} THEN CASE WHEN {_m(rules.SUMMARY_LINE)} THEN 'metadata' ELSE 'article' END
 WHEN {_m(rules.PARAGRAPH)} THEN 'paragraph' WHEN {_m(rules.INCISO)} THEN 'inciso' WHEN {_m(rules.ALINEA)} THEN 'alinea'
 WHEN contains(x, 'Publicado em:') OR {_m(rules.PAGINATION)} OR {_m(rules.ISSUER)} THEN 'metadata' WHEN {_m(rules.NORM_NAME)} THEN 'cabecalho' WHEN {_PREAMBLE} OR {_m(rules.SUMMARY_VERB)} THEN 'preambulo'
 WHEN {_m(rules.CHAPTER)} OR {_m(rules.ALL_CAPS)} OR (length(x) < 60 AND regexp_matches(x, '^[A-Z]') AND NOT {_m(rules.LEGAL_MARKER)}) THEN 'cabecalho' ELSE 'nao_classificado' END"""
_IDENT = """CASE kind WHEN 'article' THEN concat('Art. ', regexp_extract(x, 'Art\\. (\\d+)', 1), CASE WHEN contains(x, '-A') THEN '-A' ELSE 'º' END) WHEN 'paragraph' THEN CASE WHEN starts_with(x, '§') THEN concat('§ ', regexp_extract(x, '(\\d+)', 1), 'º') ELSE 'Parágrafo único' END
 WHEN 'inciso' THEN 'IV' WHEN 'alinea' THEN 'b' END"""


def _blocks(spark, d):
    """Blocks of made-up statutes: 60 orders a document, a line each."""
    o = t(spark, d, "orders")
    return o.select(F.floor(F.col("o_orderkey") / 60).cast("string").alias("document_id"), F.lit(1).alias("page_number"), F.col("o_orderkey").cast("int").alias("block_index"), F.expr(_LINE).alias("text"),
                    ((F.col("o_orderkey") % 60) * 200).cast("int").alias("char_start"), ((F.col("o_orderkey") % 60) * 200 + F.length(F.expr(_LINE))).cast("int").alias("char_end"))


@query(f"SELECT k AS o_orderkey, kind, {_IDENT} AS identifier FROM (SELECT k, x, {_CASCADE} AS kind FROM (SELECT o_orderkey AS k, {_LINE} AS x FROM orders))")
def line_classify(spark, d):
    return statutes.classify(_blocks(spark, d)).select(F.col("block_index").cast("long").alias("o_orderkey"), "kind", "identifier")


@query(f"SELECT kind, count(*) AS n FROM (SELECT {_CASCADE} AS kind FROM (SELECT {_LINE} AS x FROM orders)) GROUP BY kind")
def classification_stats(spark, d):
    return statutes.classify(_blocks(spark, d)).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


# An order is an article, its lines are paragraphs (line 1 and 4), incisos and alíneas in turn.
_KIND = "CASE WHEN l_linenumber % 3 = 1 THEN 'paragraph' WHEN l_linenumber % 3 = 2 THEN 'inciso' ELSE 'alinea' END"
_TREE = f"""WITH b AS (SELECT o_orderkey AS k, 0 AS n, 'article' AS kind FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT l_orderkey, min(l_linenumber), {_KIND} FROM lineitem GROUP BY l_orderkey, l_linenumber, 3),
 s AS (SELECT *, last_value(CASE WHEN kind = 'article' THEN k END IGNORE NULLS) OVER d AS art, count(*) FILTER (kind = 'article') OVER d AS a_seq FROM b WINDOW d AS (PARTITION BY k // 20 ORDER BY k, n ROWS UNBOUNDED PRECEDING)),
 p AS (SELECT *, last_value(CASE WHEN kind = 'paragraph' THEN n END IGNORE NULLS) OVER w AS par, count(*) FILTER (kind = 'paragraph') OVER w AS p_seq FROM s WINDOW w AS (PARTITION BY k // 20, a_seq ORDER BY k, n ROWS UNBOUNDED PRECEDING)),
 i AS (SELECT *, last_value(CASE WHEN kind = 'inciso' THEN n END IGNORE NULLS) OVER (PARTITION BY k // 20, a_seq, p_seq ORDER BY k, n ROWS UNBOUNDED PRECEDING) AS inc FROM p)"""
_ROMAN = "CASE {0} " + " ".join(f"WHEN {n} THEN '{rules.roman(n)}'" for n in range(1, 8)) + " END"


def _tree_blocks(spark, d):
    o = t(spark, d, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.lit(0).alias("n"), F.lit("article").alias("kind"))
    li = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.expr(_KIND).alias("kind"))
    li = ranges.dealt(li, "k", n=ranges.parts(li)).distinct()
    ident = F.when(F.col("kind") == "article", F.concat(F.lit("Art. "), F.col("k").cast("string"), F.lit("º"))).when(F.col("kind") == "paragraph", F.concat(F.lit("§ "), F.col("n").cast("string"), F.lit("º"))).when(F.col("kind") == "inciso", F.expr(_ROMAN.format("n"))).otherwise(F.expr("chr(96 + n)"))
    b = o.unionByName(li)
    return b.select(F.floor(F.col("k") / 20).cast("string").alias("document_id"), F.lit(1).alias("page_number"), F.col("n").alias("block_index"), F.concat_ws(" ", ident, F.lit("texto")).alias("text"), (F.col("k") * 10 + F.col("n")).cast("int").alias("char_start"),
                    (F.col("k") * 10 + F.col("n") + 1).cast("int").alias("char_end"), "kind", ident.alias("identifier"), F.array().cast("array<double>").alias("bbox"), F.lit(False).alias("is_revoked"), F.lit(0).alias("first_flags"), "k", "n")


_SPAN = f"""CASE kind WHEN 'article' THEN printf('ART-%03d', art) WHEN 'paragraph' THEN printf('PAR-%03d-%d', art, n) WHEN 'inciso' THEN concat_ws('-', printf('INC-%03d', art), CAST(par AS VARCHAR), {_ROMAN.format('n')})
 ELSE concat_ws('-', printf('ALI-%03d', art), CAST(par AS VARCHAR), {_ROMAN.format('inc')}, chr(CAST(96 + n AS INTEGER))) END"""
_PARENT = f"""CASE kind WHEN 'article' THEN NULL WHEN 'paragraph' THEN printf('ART-%03d', art) WHEN 'inciso' THEN CASE WHEN par IS NULL THEN printf('ART-%03d', art) ELSE printf('PAR-%03d-%d', art, par) END
 ELSE CASE WHEN inc IS NOT NULL THEN concat_ws('-', printf('INC-%03d', art), CAST(par AS VARCHAR), {_ROMAN.format('inc')}) WHEN par IS NOT NULL THEN printf('PAR-%03d-%d', art, par) ELSE printf('ART-%03d', art) END END"""


@query(f"{_TREE} SELECT k AS o_orderkey, CAST(n AS INTEGER) AS line, {_SPAN} AS span_id, {_PARENT} AS parent_span_id FROM i WHERE art IS NOT NULL")
def hierarchy_state(spark, d):
    h = statutes.hierarchy(_tree_blocks(spark, d)).where("accepted")
    return h.select(F.col("k").alias("o_orderkey"), F.col("n").alias("line"), "span_id", "parent_span_id")


@query(f"{_TREE}, x AS (SELECT k // 20 AS doc, {_SPAN} AS s, {_PARENT} AS p FROM i WHERE art IS NOT NULL), u AS (SELECT DISTINCT * FROM x) SELECT CAST(doc AS VARCHAR) AS document_id, p AS span_id, count(*) AS children FROM u WHERE p IS NOT NULL GROUP BY doc, p")
def children_linked(spark, d):
    devices = statutes.dedup_versions(statutes.hierarchy(_tree_blocks(spark, d)).where("accepted"))
    linked = statutes.link_children(devices)
    return linked.where(F.size("children_span_ids") > 0).select("document_id", "span_id", F.size("children_span_ids").cast("long").alias("children"))


@query(f"""SELECT o_orderkey, concat('Art. ', o_orderkey) || coalesce(chr(10) || string_agg(x, chr(10) ORDER BY n), '') AS retrieval_text FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n, concat({_ROMAN.format('l_linenumber')}, ' - texto ', l_linenumber) AS x FROM lineitem) ON k = o_orderkey GROUP BY o_orderkey""")
def subtree_text(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("document_id"), F.lit("ART-001").alias("span_id"), F.lit("").alias("parent_span_id"), F.concat(F.lit("Art. "), F.col("o_orderkey").cast("string")).alias("text"), F.lit(0).alias("hierarchy_depth"), F.lit(0).alias("char_start"))
    li = t(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("document_id"), F.concat(F.lit("INC-001-"), F.expr(_ROMAN.format("l_linenumber"))).alias("span_id"), F.lit("ART-001").alias("parent_span_id"), F.concat(F.expr(_ROMAN.format("l_linenumber")), F.lit(" - texto "), F.col("l_linenumber").cast("string")).alias("text"), F.lit(1).alias("hierarchy_depth"), F.col("l_linenumber").alias("char_start")).distinct()
    out = statutes.subtree_text(o.unionByName(li)).where("hierarchy_depth = 0")
    return out.select(F.col("document_id").cast("long").alias("o_orderkey"), "retrieval_text")


_PARTS = f"(SELECT DISTINCT l_orderkey AS k, l_linenumber AS n, concat({_ROMAN.format('l_linenumber')}, ' - item ', l_linenumber) AS x FROM lineitem)"


@query(f"""SELECT concat('leis:', o_orderkey, '#ART-001@FULL') AS node_id, concat('Art. ', o_orderkey, chr(10), string_agg(x, chr(10) ORDER BY n)) AS text, count(*) AS children, CAST(max(length(concat('Art. ', o_orderkey))) + sum(length(x) + 1) AS BIGINT) AS last_end
 FROM orders JOIN {_PARTS} ON k = o_orderkey GROUP BY o_orderkey HAVING count(*) >= 2""")
def consolidated_articles(spark, d):
    o = t(spark, d, "orders").select(F.concat(F.lit("leis:"), F.col("o_orderkey").cast("string"), F.lit("#ART-001")).alias("node_id"), F.lit("").alias("parent_node_id"), F.lit("ART-001").alias("span_id"), F.lit("article").alias("device_type"), F.col("o_orderkey").cast("string").alias("document_id"), F.concat(F.lit("Art. "), F.col("o_orderkey").cast("string")).alias("text"))
    key = F.col("l_orderkey").cast("string")
    li = t(spark, d, "lineitem").select(F.concat(F.lit("leis:"), key, F.lit("#INC-001-"), F.expr(_ROMAN.format("l_linenumber"))).alias("node_id"), F.concat(F.lit("leis:"), key, F.lit("#ART-001")).alias("parent_node_id"), F.concat(F.lit("INC-001-"), F.expr(_ROMAN.format("l_linenumber"))).alias("span_id"), F.lit("inciso").alias("device_type"), key.alias("document_id"), F.concat(F.expr(_ROMAN.format("l_linenumber")), F.lit(" - item "), F.col("l_linenumber").cast("string")).alias("text")).distinct()
    c = consolidation.consolidate(o.unionByName(li))
    return c.select("node_id", "text", F.size("child_node_ids").cast("long").alias("children"), F.element_at("child_offsets", -1)["end"].cast("long").alias("last_end"))


_EV = "event_id, user_id, event_type, CAST(floor(epoch(ts)) - 1704067200 AS BIGINT) AS sec"


@query(f"""WITH e AS (SELECT {_EV} FROM events), o AS (SELECT o.user_id, o.event_id, o.sec, p.event_id AS dev FROM (SELECT * FROM e WHERE event_type = 'error') o ASOF JOIN (SELECT user_id, sec, max(event_id) AS event_id FROM e WHERE event_type <> 'error' GROUP BY ALL) p ON o.user_id = p.user_id AND o.sec > p.sec),
 d AS (SELECT * FROM e WHERE event_type <> 'error')
 SELECT d.event_id, CAST(count(o.event_id) FILTER (o.sec - d.sec <= 1510) AS INTEGER) AS merged FROM d LEFT JOIN o ON o.dev = d.event_id GROUP BY d.event_id""")
def asof_orphan_merge(spark, d):
    e = t(spark, d, "events").select("event_id", F.col("user_id").cast("string").alias("document_id"), "event_type", (F.col("ts").cast("timestamp").cast("double").cast("long") - 1704067200).cast("int").alias("char_start"))
    dev = F.col("event_type") != "error"
    rows = e.select("document_id", F.col("event_id").cast("int").alias("block_index"), F.lit(1).alias("page_number"), "char_start", (F.col("char_start") + 10).alias("char_end"), F.concat("event_type", F.lit(" x1")).alias("text"), dev.alias("accepted"), F.when(dev, "article").otherwise("nao_classificado").alias("kind"), F.col("event_id"))
    return statutes.merge_orphans(rows).select("event_id", F.col("n_merged").alias("merged"))


@query("SELECT o_custkey, o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderpriority = '1-URGENT', o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def version_dedup(spark, d):
    o = t(spark, d, "orders").select(F.col("o_custkey").alias("document_id"), F.col("o_orderstatus").alias("span_id"), (F.col("o_orderpriority") == "1-URGENT").alias("is_revoked"), F.col("o_orderkey").alias("char_start"), F.lit(0).alias("block_index"))
    return statutes.dedup_versions(o).select(F.col("document_id").alias("o_custkey"), F.col("span_id").alias("o_orderstatus"), F.col("char_start").alias("o_orderkey"))


@query("SELECT p_partkey, v AS value FROM (SELECT p_partkey, CASE WHEN p_size > 50 THEN 9999 ELSE p_size END AS v FROM part)")
def roman_values(spark, d):
    signs = "CASE p_size " + " ".join(f"WHEN {n} THEN '{rules.roman(n)}'" for n in range(1, 51)) + " ELSE 'x?' END"
    return t(spark, d, "part").select("p_partkey", legal.roman_to_int(F.expr(signs)).alias("value"))


_BOX = "array[{0}, {1}, {0} + 10 + {2}, {1} + 5 + {2}]"


@query("""SELECT l_orderkey, l_linenumber, round(CASE WHEN u > 0 THEN i / u ELSE 0 END, 6) AS iou FROM (SELECT *, greatest(least(ax + 20, bx + 30) - greatest(ax, bx), 0) * greatest(least(ay + 20, y2 + 10) - greatest(ay, y2), 0) AS i, 400 + 300 - greatest(least(ax + 20, bx + 30) - greatest(ax, bx), 0) * greatest(least(ay + 20, y2 + 10) - greatest(ay, y2), 0) AS u
 FROM (SELECT l_orderkey, l_linenumber, l_quantity AS ax, l_discount * 100 AS ay, l_tax * 100 AS bx, l_quantity / 2 AS y2 FROM lineitem))""")
def bbox_iou(spark, d):
    q, disc, tax = F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100
    a = F.array(q, disc, q + 20, disc + 20)
    b = F.array(tax, q / 2, tax + 30, q / 2 + 10)
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(legal.bbox_iou(a, b), 6).alias("iou"))


@query("SELECT l_orderkey, l_linenumber, (l_quantity * 10 < l_quantity * 10 + 50) AND l_quantity * 10 + 50 <= 501 AS valid, round(l_discount * 600, 2) AS x0 FROM lineitem")
def bbox_valid(spark, d):
    x = F.col("l_quantity") * 10
    box = F.array(x, F.lit(0.0), x + 50, F.lit(20.0))
    scaled = legal.scale_bbox(F.array("l_discount", "l_tax", "l_discount", "l_tax"), F.lit(600.0), F.lit(800.0))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", legal.valid_bbox(box, F.lit(500.0), F.lit(800.0)).alias("valid"), scaled[0].alias("x0"))


@query("""SELECT p_partkey, p_size % 3 = 0 AND s.n > 0 AS has_strikethrough FROM part, (SELECT count(*) AS n FROM part) s""")
def strikethrough_join(spark, d):
    p = t(spark, d, "part")
    blocks = p.select(F.lit("d").alias("document_id"), F.col("p_partkey").alias("page_number"), F.lit(0).alias("block_index"), F.array(F.lit(0.0), F.lit(0.0), F.lit(100.0), F.lit(20.0)).alias("bbox"))
    s = F.col("p_size") % 3
    strokes = p.select(F.lit("d").alias("document_id"), F.col("p_partkey").alias("page_number"), F.lit(10.0).alias("x0"), F.when(s == 1, 30.0).otherwise(10.0).alias("y0"), F.when(s == 2, 25.0).otherwise(60.0).alias("x1"), F.when(s == 1, 31.0).otherwise(11.0).alias("y1"))
    return statutes.struck(blocks, strokes).select(F.col("page_number").alias("p_partkey"), "has_strikethrough")


def _chunks(spark, d):
    """Chunks of made-up documents, some of which break the contract."""
    o = t(spark, d, "orders")
    k = F.col("o_orderkey")
    ruling = k % 5 == 0
    span = F.concat(F.lit("ART-"), F.lpad((k % 40).cast("string"), 3, "0"))
    doc = F.concat(F.lit("DOC-"), F.floor(k / 40).cast("string"))
    sentinel = k % 97 == 0
    return o.select(
        doc.alias("document_id"), F.concat(F.when(k % 89 == 0, "x:").when(ruling, "acordaos:").otherwise("leis:"), doc, F.lit("#"), span, F.when(k % 83 == 0, "@P01").otherwise("")).alias("node_id"), F.concat(doc, F.lit("#"), span).alias("chunk_id"), span.alias("span_id"),
        F.when(k % 3 == 0, "article").otherwise("paragraph").alias("device_type"), F.when(k % 3 == 0, "").when(k % 61 == 0, "").otherwise(F.concat(F.when(ruling, "acordaos:").otherwise("leis:"), doc)).alias("parent_node_id"),
        F.when(sentinel, -1).otherwise((k % 40) * 30).cast("int").alias("canonical_start"), F.when(sentinel, -1).otherwise((k % 40) * 30 + k % 50).cast("int").alias("canonical_end"), F.when(sentinel, "").otherwise("h").alias("canonical_hash"),
        (k % 71 == 0).alias("is_cross_page"), F.lit(0).alias("n_bbox_spans"), F.when(k % 3 == 0, "article").otherwise("device").alias("chunk_level"), F.when(k % 7 == 0, "external").otherwise("self").alias("origin_type"), F.when(k % 7 == 0, F.concat(F.lit("LEI-"), (k % 3).cast("string"))).otherwise("").alias("origin_reference"), "o_orderkey",
    )


_CH = """(SELECT k, d, s, CASE WHEN k % 89 = 0 THEN 'x:' WHEN r THEN 'acordaos:' ELSE 'leis:' END || d || '#' || s || CASE WHEN k % 83 = 0 THEN '@P01' ELSE '' END AS node_id, r, CASE WHEN k % 3 = 0 THEN 'article' ELSE 'paragraph' END AS kind, CASE WHEN k % 3 = 0 OR k % 61 = 0 THEN '' ELSE CASE WHEN r THEN 'acordaos:' ELSE 'leis:' END || d END AS parent,
 k % 97 = 0 AS sen, CASE WHEN k % 97 = 0 THEN -1 ELSE k % 40 * 30 END AS a, CASE WHEN k % 97 = 0 THEN -1 ELSE k % 40 * 30 + k % 50 END AS z FROM (SELECT o_orderkey AS k, 'DOC-' || (o_orderkey // 40) AS d, 'ART-' || lpad(CAST(o_orderkey % 40 AS VARCHAR), 3, '0') AS s, o_orderkey % 5 = 0 AS r FROM orders))"""
_RULES = (
    ("k % 89 = 0", "bad_prefix"), ("k % 89 <> 0 AND contains(node_id, '@P')", "node_id_part"), ("k % 89 <> 0 AND kind = 'paragraph' AND parent = ''", "child_without_parent"), ("k % 89 <> 0 AND NOT sen AND z <= a", "offsets_incoherent"),
    ("k % 89 <> 0 AND k % 71 = 0", "cross_page_without_spans"), ("k % 89 <> 0 AND sen AND (kind = 'paragraph' OR NOT r)", "evidence_without_offsets"),
)


@query(" UNION ALL ".join(f"SELECT d AS document_id, node_id, '{n}' AS rule FROM {_CH} WHERE {c}" for c, n in _RULES))
def contract_violations(spark, d):
    return quality.violations(_chunks(spark, d)).select("document_id", "node_id", "rule")


@query(f"SELECT d AS document_id, count(*) AS chunks FROM {_CH} WHERE d NOT IN (" + " UNION ALL ".join(f"SELECT d FROM {_CH} WHERE {c}" for c, _ in _RULES) + ") GROUP BY d")
def contract_sound_documents(spark, d):
    good, _ = quality.split_by_contract(_chunks(spark, d))
    return good.groupBy("document_id").agg(F.count(F.lit(1)).alias("chunks"))


@query("""SELECT l_orderkey, CAST(sum(z - a) AS DOUBLE) AS covered, count(*) AS islands FROM (SELECT l_orderkey, i, min(a) AS a, max(z) AS z FROM (SELECT *, sum(n) OVER (PARTITION BY l_orderkey ORDER BY a, z RANGE UNBOUNDED PRECEDING) AS i FROM (
 SELECT *, CASE WHEN a > max(z) OVER (PARTITION BY l_orderkey ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) OR row_number() OVER (PARTITION BY l_orderkey ORDER BY a, z) = 1 THEN 1 ELSE 0 END AS n FROM (SELECT l_orderkey, l_quantity AS a, l_quantity + l_linenumber * 2 AS z FROM lineitem))) GROUP BY ALL) GROUP BY l_orderkey""")
def offset_coverage(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", F.col("l_quantity").alias("start"), (F.col("l_quantity") + F.col("l_linenumber") * 2).alias("end"))
    return quality.covered(li, ["l_orderkey"])


@query(f"""SELECT d AS document_id, count(*) AS chunks, count(DISTINCT s) AS distinct_spans, count(*) FILTER (kind = 'article') AS articles, count(*) FILTER (k % 7 = 0) AS external, count(DISTINCT CASE WHEN k % 7 = 0 THEN k % 3 END) AS targets FROM {_CH} GROUP BY d""")
def manifest(spark, d):
    c = _chunks(spark, d)
    m = quality.manifest(c, c.select("document_id").distinct().withColumn("canonical_text", F.repeat(F.lit("x"), F.lit(1300))))
    return m.select("document_id", "chunks", "distinct_spans", F.coalesce(F.try_element_at("spans_by_type", F.lit("article")), F.lit(0)).alias("articles"), F.size("external_spans").cast("long").alias("external"), F.size("target_documents").cast("long").alias("targets"))


@query("""SELECT lang AS document_id, count(*) FILTER (l AND q) AS matched, count(*) FILTER (l) AS expected, count(*) FILTER (q) AS found, round(count(*) FILTER (l AND q) / nullif(count(*) FILTER (q), 0), 6) AS "precision", round(count(*) FILTER (l AND q) / nullif(count(*) FILTER (l), 0), 6) AS recall
 FROM (SELECT lang, d.doc_id, l.doc_id IS NOT NULL AS l, length(text) > 1000 AS q FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) l USING (doc_id)) WHERE l OR q GROUP BY lang""")
def golden_metrics(spark, d):
    docs = t(spark, d, "documents")
    lab = t(spark, d, "labels").where("quality = 1").select("doc_id").distinct()
    exp = docs.join(lab, "doc_id").select(F.col("lang").alias("document_id"), F.col("doc_id").cast("string").alias("span_id"), F.left("text", F.lit(10)).alias("text_prefix"))
    got = docs.where(F.length("text") > 1000).select(F.col("lang").alias("document_id"), F.col("doc_id").cast("string").alias("span_id"), "text", F.lit(0).alias("canonical_start"))
    g = quality.golden(exp, got)
    return g.select("document_id", "matched", "expected", "found", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("SELECT l_orderkey, list_sort(list_filter(range(1, m + 1), lambda x: NOT list_contains(s, x))) AS missing FROM (SELECT l_orderkey, max(l_suppkey % 9 + 1) AS m, list(DISTINCT l_suppkey % 9 + 1) AS s FROM lineitem GROUP BY l_orderkey)")
def sequence_gaps(spark, d):
    return quality.sequence_gaps(t(spark, d, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 9 + 1).alias("number")), ["l_orderkey"])


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 2 DESC, o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def registry_upsert(spark, d):
    o = t(spark, d, "orders").withColumn("updated_at", F.struct("o_orderdate", "o_orderkey")).select("o_custkey", "o_orderkey", "o_orderstatus", "updated_at")
    return registry.upsert(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), ["o_custkey"]).drop("updated_at")


@query("SELECT o_orderkey AS document_id, o_orderdate AS updated_at FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 100")
def list_by_status(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("document_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("updated_at"))
    return registry.by_status(o, "F").drop("status")


@query("""SELECT c_custkey, coalesce(o, c_mktsegment) AS status FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderstatus) AS o FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""")
def registry_status(spark, d):
    c = t(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("updated_at"))
    u = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderstatus").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(1).alias("updated_at"))
    return registry.set_status(c, u, ["c_custkey"]).select("c_custkey", "status")


@query("SELECT s AS document_id, count(*) AS n FROM (SELECT c_mktsegment AS s FROM customer UNION ALL SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority NOT IN (SELECT c_mktsegment FROM customer)) GROUP BY s")
def registry_create(spark, d):
    have = t(spark, d, "customer").select(F.col("c_mktsegment").alias("document_id"))
    want = t(spark, d, "orders").select(F.col("o_orderpriority").alias("document_id"))
    return registry.create_or_get(have, want, ["document_id"]).groupBy("document_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT user_id, count(*) AS alive FROM events WHERE ts > TIMESTAMP '2024-01-20' - INTERVAL 2 HOUR AND ts <= TIMESTAMP '2024-01-20' GROUP BY user_id")
def ttl_expiry(spark, d):
    e = t(spark, d, "events").where("ts <= timestamp_ntz'2024-01-20 00:00:00'")
    now = F.to_timestamp(F.lit("2024-01-20 00:00:00"))
    return registry.alive(e, now, at="ts").groupBy("user_id").agg(F.count(F.lit(1)).alias("alive"))


@query("SELECT user_id AS task_id, stage, saved_at FROM (SELECT user_id, CASE WHEN event_type = 'purchase' THEN 'vlm' ELSE 'regex' END AS stage, event_id AS saved_at, row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'purchase' DESC, event_id DESC) AS r FROM events) WHERE r = 1 AND user_id % 2 = 0")
def recent_inspections(spark, d):
    a = t(spark, d, "events").select(F.col("user_id").alias("task_id"), F.when(F.col("event_type") == "purchase", "vlm").otherwise("regex").alias("stage"), F.col("event_id").alias("saved_at"))
    return registry.recent_inspections(a, a.where("task_id % 2 = 0").select("task_id").distinct())


@query("""SELECT o_orderkey AS run_id, round(CAST(o_orderkey % 500 AS DOUBLE), 3) AS duration_seconds, CASE WHEN o_orderkey % 11 = 0 THEN 'failed' ELSE 'success' END AS outcome FROM orders""")
def run_manifest(spark, d):
    k = F.col("o_orderkey")
    r = t(spark, d, "orders").select(k.alias("run_id"), F.col("o_orderdate").cast("timestamp").alias("started_at"), F.timestamp_seconds(F.col("o_orderdate").cast("timestamp").cast("long") + k % 500).alias("ended_at"), F.when(k % 11 == 0, "e").alias("error"))
    return quality.run_manifest(r).select("run_id", "duration_seconds", "outcome")


@query("""SELECT lang AS document_id, count(*) FILTER (l.doc_id IS NULL) AS index_less, bool_and(true) AS ok FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY lang""")
def custody_audit(spark, d):
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("document_id"), "lang", F.lit("h").alias("canonical_hash"))
    rows = t(spark, d, "labels").select(F.col("doc_id").alias("document_id"))
    a = quality.custody(docs.drop("lang"), docs.select("document_id", "canonical_hash"), rows, docs.select("document_id"))
    j = a.join(docs.select("document_id", "lang"), "document_id")
    return j.groupBy(F.col("lang").alias("document_id")).agg(F.count_if(F.col("index_rows") == 0).alias("index_less"), F.bool_and(F.col("hash_matches")).alias("ok"))


@query(f"""SELECT doc_id, true AS idempotent, CAST(2 AS BIGINT) AS sliced, CAST(doc_id % 4 = 0 AND n > 0 AS BIGINT) AS mismatched, doc_id % 6 <> 1 AS hashes_hold FROM (SELECT doc_id, length({SQL_CANONICAL.format("text")}) AS n FROM documents)""")
def integrity_checks(spark, d):
    """Both halves of every whole text as chunks; of some documents the second differs, of some the hash."""
    from ..functions import text as tx

    docs = t(spark, d, "documents").select(F.col("doc_id").alias("document_id"), tx.canonical(F.col("text")).alias("canonical_text"))
    n, k = F.length("canonical_text"), F.col("document_id")
    half = (n / 2).cast("int")
    of = lambda lo, hi, text: F.struct(lo.alias("canonical_start"), hi.alias("canonical_end"), text.alias("text"))
    second = F.when(k % 4 == 0, F.lit("\x01")).otherwise(F.substring(F.col("canonical_text"), half + 1, n))
    halves = F.inline(F.array(of(F.lit(0), half, F.substring(F.col("canonical_text"), F.lit(1), half)), of(half, n, second)))
    ch = docs.withColumn("canonical_hash", F.when(k % 6 == 1, "x").otherwise(F.sha2("canonical_text", 256))).select("document_id", "canonical_hash", halves)
    i = quality.integrity(ch, docs)
    return i.select(F.col("document_id").alias("doc_id"), "idempotent", "sliced", "mismatched", "hashes_hold")


@query(f"SELECT d AS document_id, CAST(count(DISTINCT s) AS BIGINT) AS spans FROM {_CH} WHERE a >= 0 AND z > a GROUP BY d")
def offsets_map(spark, d):
    return stores.offsets_map(_chunks(spark, d)).select("document_id", F.size("offsets").cast("long").alias("spans"))


@query(f"SELECT node_id || '@P00' AS node_id, CASE WHEN kind = 'article' THEN 'ART' ELSE 'PAR' END AS device_type, CAST(a AS INTEGER) AS canonical_start, '[]' AS citations, false AS has_citations FROM {_CH}")
def index_rows(spark, d):
    c = _chunks(spark, d).withColumns({"bbox": F.array().cast("array<double>"), "text": F.lit("t"), "retrieval_text": F.lit(None).cast("string"), "article_number": F.lit("10-A"), "page_number": F.lit(1)})
    return stores.index_rows(c).select("node_id", "device_type", "canonical_start", "citations", "has_citations")


_PAGE = "concat('Art. ', cast({0} as string), '. Caput.', chr(10), 'I - um;', chr(10), chr(10), 'solto ', cast({0} as string))"


@query("""SELECT CAST(o_custkey AS VARCHAR) AS document_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, n) - 1 AS INTEGER) AS block_index, concat(CASE n WHEN 1 THEN concat('Art. ', o_orderkey, '. Caput.') WHEN 2 THEN 'I - um;' ELSE concat('solto ', o_orderkey) END) AS text FROM orders, range(1, 4) r(n)""")
def page_blocks(spark, d):
    p = t(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("document_id"), F.col("o_orderkey").alias("page_number"), F.expr(_PAGE.format("o_orderkey")).alias("text"))
    b = statutes.split_pages(p)
    return b.select("document_id", F.col("block_index").cast("int").alias("block_index"), "text")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS document_id, list_filter([CASE WHEN count(*) FILTER (o_orderkey % 3 > 0 AND o_orderkey % 2 = 1 AND o_custkey % 5 > 0) = 0 THEN 'QG1' END, CASE WHEN o_custkey % 200 < 100 THEN 'QG2' END, CASE WHEN count(*) > 2 AND count(*) FILTER (o_orderkey % 3 > 0) < count(*) THEN 'QG3' END], lambda w: w IS NOT NULL) AS warnings FROM orders GROUP BY o_custkey""")
def ocr_quality_gate(spark, d):
    """A page for each order; devices, articles and characters a page follow from the keys, so that every warning occurs."""
    o = t(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("document_id"), F.col("o_orderkey").alias("page_number"), "o_custkey")
    k = F.col("page_number")
    dev = o.where(k % 3 > 0).select("document_id", F.when((k % 2 == 1) & (F.col("o_custkey") % 5 > 0), "article").otherwise("paragraph").alias("device_type"))
    canon = o.groupBy("document_id", "o_custkey").agg(F.count(F.lit(1)).alias("n")).select("document_id", F.repeat(F.lit("x"), (F.col("n") * (F.col("o_custkey") % 200)).cast("int")).alias("canonical_text"))
    return statutes.ocr_quality(dev, canon, o)


def _trees(spark, d):
    """A tree in JSON for each customer: a chapter for each status of its orders and an empty one, an article for each order, items and sub-items by its key."""
    o = t(spark, d, "orders")
    sub = F.expr("CASE WHEN o_orderkey % 2 = 1 THEN array(named_struct('identifier', 'a', 'content', CASE WHEN o_orderkey % 5 = 0 THEN 'c' ELSE 'd' END)) END")
    item = lambda i: F.struct(F.when((i == 1) & (F.col("o_orderkey") % 4 == 0), "§ 1º").otherwise(F.repeat(F.lit("I"), i)).alias("identifier"), F.lit("c").alias("content"), sub.alias("sub_items"))
    n = (F.col("o_orderkey") % 3).cast("int")
    items = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), item))
    article = F.struct(F.col("o_orderkey").alias("k"), F.struct(F.concat(F.lit("Art. "), F.col("o_orderkey").cast("string")).alias("number"), items.alias("items")).alias("a"))
    chapters = o.groupBy("o_custkey", "o_orderstatus").agg(F.sort_array(F.collect_list(article))["a"].alias("articles"))
    whole = chapters.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct(F.col("o_orderstatus").alias("title"), F.to_json("articles").alias("articles")))).alias("c"))
    text = F.concat(F.lit('{"chapters":['), F.array_join(F.transform("c", lambda c: F.concat(F.lit('{"title":"'), c["title"], F.lit('","articles":'), c["articles"], F.lit("},"))), ""), F.lit('{"title":"vazio","articles":[]}]}'))
    return whole.select(F.col("o_custkey").alias("document_id"), quality.parse_statute(text).alias("s")).select("document_id", "s.chapters")


@query("""SELECT o_custkey AS document_id, CAST(count(DISTINCT o_orderstatus) + 1 AS INTEGER) AS chapters, CAST(count(*) AS INTEGER) AS articles, 0 AS paragraphs, CAST(sum(o_orderkey % 3) AS INTEGER) AS items, CAST(sum(o_orderkey % 3 * (o_orderkey % 2)) AS INTEGER) AS sub_items, list(CAST(o_orderkey AS INTEGER) ORDER BY o_orderkey) AS article_numbers FROM orders GROUP BY o_custkey""")
def statute_tree_counts(spark, d):
    return quality.statute_counts(_trees(spark, d))


@query("""SELECT o_custkey AS document_id, CAST(count(DISTINCT o_orderstatus) AS INTEGER) AS chapters, CAST(count(*) AS INTEGER) AS articles, CAST(count(*) FILTER (o_orderkey % 4 = 0 AND o_orderkey % 3 > 0) AS INTEGER) AS paragraphs,
 CAST(sum(o_orderkey % 3) - count(*) FILTER (o_orderkey % 4 = 0 AND o_orderkey % 3 > 0) AS INTEGER) AS items, CAST(sum(CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 3 * (o_orderkey % 2) END) AS INTEGER) AS sub_items FROM orders GROUP BY o_custkey""")
def statute_tree_fixed(spark, d):
    return quality.statute_counts(quality.fix_statute(_trees(spark, d))).drop("article_numbers")


@query("""SELECT CAST(k // 30 AS BIGINT) AS document_id, kind, count(*) AS n FROM (SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'article' WHEN 1 THEN 'paragraph' WHEN 2 THEN 'item' WHEN 3 THEN 'sub_item' ELSE 'chapter' END AS kind FROM orders) GROUP BY ALL""")
def markdown_elements(spark, d):
    k = F.col("o_orderkey")
    line = F.when(k % 5 == 0, F.concat(F.lit("### Art. "), k.cast("string"))).when(k % 5 == 1, "**§ 2º** x").when(k % 5 == 2, "- IV - x").when(k % 5 == 3, "b) x").otherwise("# CAPÍTULO I")
    docs = t(spark, d, "orders").select(F.floor(k / 30).alias("document_id"), k, line.alias("line")).groupBy("document_id").agg(F.array_join(F.sort_array(F.collect_list(F.struct("o_orderkey", "line")))["line"], "\n").alias("text"))
    return quality.markdown_elements(docs).groupBy("document_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_custkey AS document_id, count(*) FILTER (o_orderkey % 2 = 1) AS outside, count(*) FILTER (o_orderkey % 3 = 0) AS wrong FROM orders GROUP BY o_custkey""")
def element_order(spark, d):
    o, k = t(spark, d, "orders"), F.col("o_orderkey")
    kids = o.select(F.col("o_custkey").alias("document_id"), k.alias("element_id"), F.lit(-1).cast("long").alias("parent_id"), F.when(k % 3 == 0, 2).otherwise(1).alias("depth"), F.lit(1).alias("page"), k.alias("pos"), F.lit(1.0).alias("x0"), F.lit(1.0).alias("y0"), F.when(k % 2 == 1, 20.0).otherwise(5.0).alias("x1"), F.lit(5.0).alias("y1"))
    roots = o.select(F.col("o_custkey").alias("document_id")).distinct().select("document_id", F.lit(-1).cast("long").alias("element_id"), F.lit(None).cast("long").alias("parent_id"), F.lit(0).alias("depth"), F.lit(1).alias("page"), F.lit(0).cast("long").alias("pos"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(10.0).alias("x1"), F.lit(10.0).alias("y1"))
    e = quality.element_checks(kids.unionByName(roots))
    return e.groupBy("document_id").agg(F.count_if("outside_parent").alias("outside"), F.count_if("depth_wrong").alias("wrong"))


@query("""SELECT concat('leis:C', c_custkey, '#ART-00', n) AS node_id, CASE WHEN n >= 2 THEN 'external' ELSE 'self' END AS origin_type, CASE WHEN n >= 2 THEN 'LEI-8987-1995' ELSE '' END AS origin_reference, CASE WHEN n >= 2 THEN 'high' ELSE 'high' END AS origin_confidence FROM customer, range(1, 5) r(n)""")
def origin_zones(spark, d):
    said = ["Art. 1º Esta lei trata de concessões.\n", "Art. 2º A ementa da Lei nº 8.987, de 13 de fevereiro de 1995, passa a vigorar com a seguinte redação: “Art. 3º A concessão\n", "será outorgada.” (NR)\n", "Art. 4º Esta lei entra em vigor.\n"]
    ends = [sum(map(len, said[: k + 1])) for k in range(4)]
    c = t(spark, d, "customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("document_id"))
    rows = F.array(*[F.struct(F.lit(k + 1).alias("n"), F.lit(x.strip()).alias("text"), F.lit(e - len(x)).alias("canonical_start"), F.lit(e - 1).alias("canonical_end")) for k, (x, e) in enumerate(zip(said, ends, strict=True))])
    ch = c.select("document_id", F.inline(rows)).withColumn("node_id", F.concat(F.lit("leis:"), "document_id", F.lit("#ART-00"), F.col("n").cast("string")))
    canon = c.select("document_id", F.lit("".join(said)).alias("canonical_text"))
    return origin.classify(ch, canon).select("node_id", "origin_type", "origin_reference", "origin_confidence")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS document_id, s AS span_id, CAST(a AS BIGINT) AS start_at, r AS reason FROM (SELECT o_orderkey, unnest([{'s': 'ART-001', 'a': 0, 'r': NULL}, {'s': 'INC-001-I', 'a': 8, 'r': NULL}, {'s': 'ALI-001-I-a', 'a': 15, 'r': NULL}, {'s': 'INC-001-II', 'a': NULL, 'r': 'NOT_FOUND'}, {'s': 'ALI-001-II-a', 'a': NULL, 'r': 'INVALID_PARENT_RANGE'}], recursive := true) FROM orders)""")
def offsets_down_the_tree(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("document_id"))
    text = "Art. 1. I - um a) dois"
    rows = [("ART-001", "", text, 0, len(text)), ("INC-001-I", "ART-001", "I - um a) dois", None, None), ("ALI-001-I-a", "INC-001-I", "a) dois", None, None), ("INC-001-II", "ART-001", "II - nada", None, None), ("ALI-001-II-a", "INC-001-II", "a) dois", None, None)]
    dev = o.select("document_id", F.inline(F.array(*[F.struct(F.lit(s).alias("span_id"), F.lit(p).alias("parent_span_id"), F.lit(x).alias("text"), F.lit(a).cast("int").alias("char_start"), F.lit(z).cast("int").alias("char_end")) for s, p, x, a, z in rows])))
    r = offsets.resolve_tree(dev, o.withColumn("canonical_text", F.lit(text)))
    return r.select("document_id", "span_id", F.col("start").cast("long").alias("start_at"), "reason")


@query("SELECT p_partkey, length(p_name) > 0 AS present, left(CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_type END, 40) AS chosen FROM part")
def embedding_text(spark, d):
    p = t(spark, d, "part")
    chosen = vectors.choose_text(F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(""), F.col("p_type"))
    return p.select("p_partkey", (F.length("p_name") > 0).alias("present"), F.left(chosen, F.lit(40)).alias("chosen"))


#: A tree for each customer: its orders, each below the one before or below that of half its place; depths to dozens.
_DEEP = "SELECT o_custkey, o_orderkey, k, CASE WHEN k = 1 THEN 0 WHEN o_custkey % 2 = 0 THEN k - 1 ELSE {0} END AS p, concat('N', o_orderkey % 100, ' ', k) AS x FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders)"


@query(f"""WITH RECURSIVE n AS ({_DEEP.format("k // 2")}),
 r AS (SELECT o_custkey, o_orderkey AS root, k, [k] AS path, x FROM n UNION ALL SELECT n.o_custkey, r.root, n.k, list_append(r.path, n.k), n.x FROM r JOIN n ON n.o_custkey = r.o_custkey AND n.p = r.k)
 SELECT root AS o_orderkey, string_agg(x, chr(10) ORDER BY path) AS retrieval_text FROM r GROUP BY root""")
def deep_subtree_text(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey")
    ranges.dealt(o, "o_custkey", n=ranges.parts(o)).createOrReplaceTempView("__deep_orders")
    n = spark.sql(_DEEP.format("k div 2").replace("FROM orders", "FROM __deep_orders"))
    span = lambda c: F.concat(F.lit("N-"), F.col(c).cast("string"))
    tree = n.select("o_orderkey", F.col("o_custkey").cast("string").alias("document_id"), span("k").alias("span_id"), F.when(F.col("p") > 0, span("p")).otherwise("").alias("parent_span_id"), F.col("x").alias("text"), F.col("k").alias("char_start"))
    return statutes.subtree_text(tree).select("o_orderkey", "retrieval_text")


_NEST = "SELECT o_custkey, o_orderkey, CAST(k AS {0}) AS k, CASE WHEN o_orderkey % 23 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN 'absent' ELSE {1} END AS x, {1} AS whole FROM (SELECT o_custkey, o_orderkey, row_number() OVER w AS k, {2} OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))"


@query(f"""WITH RECURSIVE n AS ({_NEST.format("INTEGER", "concat('Art. ', array_to_string(own, ' Art. '))", "list(o_orderkey % 97)")}),
 c AS (SELECT c.o_custkey, c.o_orderkey, c.k, c.x, CASE WHEN p.k = 1 THEN p.whole ELSE p.x END AS above FROM n c JOIN n p ON p.o_custkey = c.o_custkey AND p.k = c.k - 1),
 q AS (SELECT *, instr(above, x) - 1 AS at, CASE WHEN x = '' THEN 'EMPTY_TEXT' WHEN above = '' THEN 'INVALID_PARENT_RANGE' WHEN instr(above, x) = 0 THEN 'NOT_FOUND' WHEN instr(substr(above, instr(above, x) + 1), x) > 0 THEN 'AMBIGUOUS_MULTIPLE_MATCHES' END AS why FROM c),
 r AS (SELECT o_custkey, o_orderkey, k, CAST(0 AS BIGINT) AS a, CAST(length(whole) AS BIGINT) AS z, CAST(NULL AS VARCHAR) AS reason FROM n WHERE k = 1
  UNION ALL SELECT q.o_custkey, q.o_orderkey, q.k, CASE WHEN q.why IS NULL THEN r.a + q.at END, CASE WHEN q.why IS NULL THEN r.a + q.at + length(q.x) END, CASE WHEN q.why = 'EMPTY_TEXT' OR r.a IS NOT NULL THEN q.why ELSE 'INVALID_PARENT_RANGE' END FROM r JOIN q ON q.o_custkey = r.o_custkey AND q.k = r.k + 1)
 SELECT o_orderkey, a AS start_at, z AS end_at, reason FROM r""")
def deep_offsets(spark, d):
    """Texts nested as deep as a customer has orders; some are empty, absent or stand twice, and what lies below them is unresolved."""
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey")
    parts = ranges.parts(o)
    ranges.dealt(o, "o_custkey", n=parts).createOrReplaceTempView("__nest_orders")
    whole = "concat('Art. ', array_join(own, ' Art. '))"
    n = spark.sql(_NEST.format("INT", whole, "collect_list(o_orderkey % 97)").replace("FROM orders", "FROM __nest_orders"))
    doc, top = F.col("o_custkey").cast("string").alias("document_id"), F.col("k") == 1
    dev = n.select(doc, F.concat(F.lit("N-"), F.col("o_orderkey").cast("string")).alias("key"), F.col("k"), F.when(top, F.col("whole")).otherwise(F.col("x")).alias("text"), F.when(top, 0).alias("char_start"), F.when(top, F.length("whole")).alias("char_end"), "o_orderkey")
    span = lambda k: F.concat(F.lit("N-"), k.cast("string"))
    dev = dev.withColumn("span_id", span(F.col("k"))).withColumn("parent_span_id", F.when(F.col("k") > 1, span(F.col("k") - 1)).otherwise(""))
    got = offsets.resolve_tree(dev, n.where("k = 1").select(doc, F.col("whole").alias("canonical_text")))
    return got.join(ranges.dealt(dev.select("document_id", "span_id", "o_orderkey"), "document_id", "span_id", n=parts), ["document_id", "span_id"]).select("o_orderkey", F.col("start").alias("start_at"), F.col("end").alias("end_at"), "reason")


#: Chunks of a document for each customer, one for each order, with a head and a tail by the order's key and 820 characters between,
#: so that no window of 800 reaches another head. Kinds: own article, amendment, end of new wording, annex, chapter quoted from a decree,
#: article out of sequence that refers to a law, end of a quotation, quoted chapter.
_HEADS = (
    "Art. 5º Texto próprio", "Art. 6º O art. 2º da Lei nº 8.987, de 13 de fevereiro de 1995, passa a vigorar com a seguinte redação: “Art. 2º Nova", "continua", "ANEXO II",
    "“CAPÍTULO V do Decreto nº 10.024", "Art. 312 Nos termos da Lei nº 9.784, de 29 de janeiro de 1999,", "segue", "“CAPÍTULO I",
)
_TAILS = ("", "", ".” (NR)", "", "", "", ".”", "")
_OF_KIND = lambda xs: "element_at(array(" + ", ".join(f"'{x}'" for x in xs) + "), kind + 1)"


@query("""WITH RECURSIVE c AS (SELECT o_custkey, o_orderkey, o_orderkey * 7 // 3 % 8 AS kind, row_number() OVER w AS k, lead(o_orderkey * 7 // 3 % 8) OVER w AS following FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
 e AS (SELECT *, CASE kind WHEN 0 THEN 5 WHEN 1 THEN 6 WHEN 5 THEN 312 END AS number, CASE kind WHEN 1 THEN 'LEI-8987-1995' WHEN 4 THEN 'DEC-10024' WHEN 5 THEN 'LEI-9784-1999' ELSE '' END AS ref, CASE kind WHEN 1 THEN 'Lei de Concessões' WHEN 5 THEN 'Lei do Processo Administrativo' ELSE '' END AS name,
  coalesce(following = 1 OR following IN (0, 5) AND kind IN (2, 6), false) AS leaves FROM c),
 z AS (SELECT o_custkey, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS o_orderkey, false AS inside, false AS ends, '' AS id, '' AS name, 0.0 AS base, 0 AS highest FROM (SELECT DISTINCT o_custkey FROM orders)
  UNION ALL SELECT o_custkey, k, o_orderkey, was OR enters, was AND leaves, CASE WHEN was AND z_id <> '' THEN z_id WHEN was OR enters THEN ref ELSE '' END, CASE WHEN was AND z_id <> '' THEN z_name WHEN was OR enters THEN name ELSE '' END, CASE WHEN was THEN z_base ELSE sure END, CASE WHEN was OR enters OR number IS NULL THEN highest ELSE greatest(highest, number) END FROM (
   SELECT *, kind IN (1, 4, 7) OR odd AS enters, CASE WHEN kind = 1 THEN 0.4 WHEN kind = 4 THEN 0.4 WHEN odd THEN 0.3 ELSE 0.1 END AS sure FROM (
    SELECT e.*, z.inside AND NOT z.ends AS was, z.id AS z_id, z.name AS z_name, z.base AS z_base, z.highest, kind = 5 AND z.highest > 0 AND 312 > z.highest + 1 AND 312 >= z.highest + 100 AS odd FROM z JOIN e ON e.o_custkey = z.o_custkey AND e.k = z.k + 1)))
 SELECT o_orderkey, CASE WHEN inside THEN 'external' ELSE 'self' END AS origin_type, CASE WHEN inside THEN id ELSE '' END AS origin_reference, CASE WHEN inside THEN name ELSE '' END AS origin_reference_name,
  CASE WHEN NOT inside THEN 'high' ELSE CASE WHEN base + 0.4 * (id <> '')::INT + 0.2 * (name <> '')::INT >= 0.7 - 1e-9 THEN 'high' WHEN base + 0.4 * (id <> '')::INT + 0.2 * (name <> '')::INT >= 0.4 - 1e-9 THEN 'medium' ELSE 'low' END END AS origin_confidence FROM z WHERE k > 0""")
def origin_of_orders(spark, d):
    """Zones of documents whose amendments, annexes and quotations follow from the orders' keys."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", F.expr("cast(o_orderkey * 7 div 3 % 8 as int)").alias("kind"))
    c = o.select("o_orderkey", F.col("o_custkey").cast("string").alias("document_id"), F.concat(F.expr(_OF_KIND(_HEADS)), F.lit(" "), F.repeat(F.lit("y"), F.lit(820)), F.expr(_OF_KIND(_TAILS))).alias("text"), F.sum(F.length(F.concat(F.expr(_OF_KIND(_HEADS)), F.expr(_OF_KIND(_TAILS)))) + 822).over(w).cast("int").alias("next"))
    c = c.select("o_orderkey", "document_id", F.col("o_orderkey").cast("string").alias("node_id"), "text", (F.col("next") - F.length("text") - 1).alias("canonical_start"), (F.col("next") - 1).alias("canonical_end"))
    whole = c.groupBy("document_id").agg(F.array_join(F.sort_array(F.collect_list(F.struct("canonical_start", "text")))["text"], "\n").alias("canonical_text"))
    return origin.classify(c, whole).select("o_orderkey", "origin_type", "origin_reference", "origin_reference_name", "origin_confidence")


@query(f"""SELECT d AS document_id, kind AS device_type, CASE WHEN kind IS NULL AND level_ IS NULL AND d IS NULL THEN NULL ELSE level_ END AS chunk_level, concat_ws(',', CASE WHEN grouping(d) = 0 THEN 'document_id' END, CASE WHEN grouping(kind) = 0 THEN 'device_type' END, CASE WHEN grouping(level_) = 0 THEN 'chunk_level' END) AS of,
 count(*) AS chunks, count(*) FILTER (k % 7 = 0) AS external, CAST(sum(greatest(z - a, 0)) AS BIGINT) AS chars FROM (SELECT *, CASE WHEN k % 3 = 0 THEN 'article' ELSE 'device' END AS level_ FROM {_CH}) GROUP BY GROUPING SETS ((d), (d, kind), (d, level_), (kind), ())""")
def manifest_levels(spark, d):
    return quality.manifest_levels(_chunks(spark, d))


@query("SELECT source, count(DISTINCT text) AS distinct_texts, true AS halves_agree, true AS close FROM documents WHERE text IS NOT NULL GROUP BY source")
def distinct_sketches(spark, d):
    """Sketches of two runs, stored and merged, against one of all rows and the exact count."""
    docs = t(spark, d, "documents").where("text is not null").select("source", "text", (F.col("doc_id") % 2).alias("run"))
    halves = registry.merged(registry.sketches(docs, ["source", "run"], "text"), ["source"])
    whole = registry.merged(registry.sketches(docs, ["source"], "text"), ["source"]).withColumnRenamed("distinct_values", "whole")
    exact = docs.groupBy("source").agg(F.countDistinct("text").alias("distinct_texts"))
    close = F.abs(F.col("distinct_values") - F.col("distinct_texts")) <= F.greatest(F.lit(1), 0.04 * F.col("distinct_texts"))
    return exact.join(halves, "source").join(whole, "source").select("source", "distinct_texts", (F.abs(F.col("distinct_values") - F.col("whole")) <= F.greatest(F.lit(1), 0.02 * F.col("whole"))).alias("halves_agree"), close.alias("close"))


_DEVICE = "CASE o_orderkey % 5 WHEN 0 THEN '{0}' WHEN 1 THEN '{1}' WHEN 2 THEN '{2}' WHEN 3 THEN '{3}' ELSE '{4}' END"
_DEVICE_KINDS = _DEVICE.format("article", "paragraph", "paragraph", "inciso", "alinea")
_DEVICE_SPANS = _DEVICE.format("ART-007", "PAR-007-2", "PAR-007-UNICO", "INC-007-IV", "ALI-007-IV-b")


@query(f"""SELECT o_orderkey, concat_ws(chr(10), concat('LEI-', o_custkey, ' | Art. 7 | ', {_DEVICE.format(legal.DEVICE_LABELS["article"], legal.DEVICE_LABELS["paragraph"] + " 2º", legal.DEVICE_LABELS["paragraph"] + " único", legal.DEVICE_LABELS["inciso"] + " IV", legal.DEVICE_LABELS["alinea"] + " b)")}), concat('texto ', o_orderkey),
 CASE WHEN o_orderkey % 5 > 0 AND n > 0 THEN concat('[CONTEXTO] ', CASE WHEN 5 * n <= {legal.CAPUT_HEAD + legal.CAPUT_TAIL} THEN repeat('caput', n) ELSE concat(left(repeat('caput', n), {legal.CAPUT_HEAD}), ' ... ', right(repeat('caput', n), {legal.CAPUT_TAIL})) END) END) AS embedded
 FROM (SELECT *, CAST(o_orderkey % 300 AS INTEGER) AS n FROM orders)""")
def device_embedding_text(spark, d):
    """Texts for embedding of devices of every kind, with caputs from none to longer than their share."""
    o = t(spark, d, "orders")
    made = legal.embedding_text(F.concat(F.lit("LEI-"), F.col("o_custkey").cast("string")), F.lit("7"), F.expr(_DEVICE_KINDS), F.concat(F.lit("texto "), F.col("o_orderkey").cast("string")), F.repeat(F.lit("caput"), (F.col("o_orderkey") % 300).cast("int")), F.expr(_DEVICE_SPANS))
    return o.select("o_orderkey", made.alias("embedded"))


@query("SELECT lang, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS bytes FROM documents GROUP BY lang")
def object_inventory(spark, d):
    """Documents written as objects, a folder for each language, and what a listing of them holds."""
    from ..sources.scratch import Scratch

    root = f"{Scratch(spark, 'objects').root}/texts"
    stores.write(t(spark, d, "documents").select(F.coalesce("text", F.lit("")).alias("value"), "lang"), root, "text", by=["lang"])
    found = stores.files(spark, root, content=False)
    return found.groupBy(F.regexp_extract("path", "lang=([^/]+)/", 1).alias("lang")).agg(F.sum("length").alias("bytes"))
