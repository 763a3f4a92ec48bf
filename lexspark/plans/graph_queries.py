"""Queries on citations, rulings, the graph and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import legal, rules
from ..functions import text as tx
from ..operators import citations, graph, ranges, rulings
from ..streaming import limits
from .base import query, re2, t

_ART = "cast(o_orderkey % 40 + 1 as string)"
_CITES = f"""CASE o_orderkey % 6
 WHEN 0 THEN concat('Fica revogado o art. ', {_ART}, ' da Lei nº 14.133/2021.')
 WHEN 1 THEN concat('nos termos do art. ', {_ART}, ', inciso IV, da Lei Complementar nº 123, de 2006')
 WHEN 2 THEN concat('conforme arts. ', {_ART}, ' e 77 do Decreto nº 10.024/2019')
 WHEN 3 THEN concat('Acórdão ', cast(o_orderkey % 900 + 1 as string), '/2021 do Plenário')
 WHEN 4 THEN concat('observado o art. ', {_ART}, ' desta norma')
 ELSE 'sem citação alguma' END"""
_A3 = "lpad(cast(o_orderkey % 40 + 1 as string), 3, '0')"


@query(f"""SELECT o_orderkey, t AS target_node_id, r AS rel_type, c AS rel_type_confidence FROM (
 SELECT o_orderkey, concat('leis:LEI-14.133-2021#ART-', {_A3}) AS t, 'REVOGA_EXPRESSAMENTE' AS r, CAST(0.95 AS DOUBLE) AS c FROM orders WHERE o_orderkey % 6 = 0
 UNION ALL SELECT o_orderkey, concat('leis:LC-123-2006#INC-', {_A3}, '-IV'), 'DEPENDE_DE', 0.85 FROM orders WHERE o_orderkey % 6 = 1
 UNION ALL SELECT o_orderkey, concat('leis:DECRETO-10.024-2019#ART-', {_A3}), 'REFERENCIA', 0.75 FROM orders WHERE o_orderkey % 6 = 2
 UNION ALL SELECT o_orderkey, 'leis:DECRETO-10.024-2019#ART-077', 'REFERENCIA', 0.75 FROM orders WHERE o_orderkey % 6 = 2
 UNION ALL SELECT o_orderkey, concat('acordaos:AC-', o_orderkey % 900 + 1, '-2021'), 'CITA', 0.5 FROM orders WHERE o_orderkey % 6 = 3
 UNION ALL SELECT o_orderkey, concat('leis:DOC#ART-', {_A3}), 'DEPENDE_DE', 0.82 FROM orders WHERE o_orderkey % 6 = 4)""")
def citation_extract(spark, d):
    c = ranges.dealt(t(spark, d, "orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", F.expr(_CITES).alias("text"), F.lit("DOC").alias("document_id"))
    return citations.extract(c, "o_orderkey").select("o_orderkey", "target_node_id", "rel_type", "rel_type_confidence")


_KINDS = ("LEI", "LC", "DECRETO", "DL", "IN", "MP", "EC")
_KIND_AT = "CASE o_orderkey % 7 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS)) + " END"
_NUMBER = "CASE WHEN o_orderkey % 3 = 0 THEN CASE o_orderkey % 7 WHEN 0 THEN '14133' WHEN 1 THEN '123' WHEN 2 THEN '10024' WHEN 4 THEN '65' ELSE '77' END ELSE cast(o_orderkey % 3000 + 1 as string) END"
_YEARS = "CASE kind || '|' || num " + " ".join(f"WHEN '{k}|{n}' THEN {y}" for (k, n), y in rules.NORM_YEARS.items()) + " END"
_LOW, _HIGH = ("CASE kind " + " ".join(f"WHEN '{k}' THEN {v[j]}" for k, v in rules.YEAR_BOUNDS.items()) + f" ELSE {rules.YEAR_BOUNDS_ELSE[j]} END" for j in (0, 1))


@query(f"SELECT o_orderkey, CAST(coalesce({_YEARS}, CASE WHEN y BETWEEN {_LOW} AND {_HIGH} THEN y END) AS INTEGER) AS year FROM (SELECT o_orderkey, {_KIND_AT} AS kind, {_NUMBER} AS num, 1800 + o_orderkey % 260 AS y FROM orders)")
def citation_years(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.expr(_KIND_AT).alias("kind"), F.expr(_NUMBER).alias("num"), (1800 + F.col("o_orderkey") % 260).cast("string").alias("y"))
    return o.select("o_orderkey", citations.valid_year(F.col("kind"), F.col("num"), F.col("y")).alias("year"))


@query("""SELECT o_orderkey, CAST(n AS VARCHAR) AS article FROM (SELECT o_orderkey, unnest(CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 25 BETWEEN 1 AND 20 THEN range(o_orderkey % 40 + 2, o_orderkey % 40 + o_orderkey % 25 + 2) ELSE [] END ELSE [77, 80] END) AS n FROM orders)""")
def multi_ref_expand(spark, d):
    first = F.expr(_ART)
    listed = F.expr("CASE WHEN o_orderkey % 2 = 0 THEN concat(' a ', cast(o_orderkey % 40 + 1 + o_orderkey % 25 as string)) ELSE ', 77 e 80' END")
    return t(spark, d, "orders").select("o_orderkey", F.explode(citations.further_articles(first, listed)).alias("article"))


@query("""SELECT o_orderkey, concat('LEI-', CASE WHEN o_orderkey >= 1000 THEN replace(format('{:,}', o_orderkey), ',', '.') ELSE CAST(o_orderkey AS VARCHAR) END, '-', 1990 + o_orderkey % 30) AS doc_id, concat('leis:LEI-14.133-2021#ART-', o_orderkey) AS node_id FROM orders""")
def normalize_doc_id(spark, d):
    k = F.col("o_orderkey").cast("string")
    year = (1990 + F.col("o_orderkey") % 30).cast("string")
    return t(spark, d, "orders").select("o_orderkey", legal.document_id(F.concat(F.lit("lei nº "), k, F.lit("/"), year)).alias("doc_id"), legal.node_id(F.concat(F.lit("LEIS:lei 14133/2021#art-"), k)).alias("node_id"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'LEI-14.133-2021' WHEN 1 THEN 'IN-65-2021' WHEN 2 THEN 'DECRETO-10.947-2022' WHEN 3 THEN 'PORTARIA-938' END AS doc_id FROM orders""")
def doc_id_in_text(spark, d):
    x = F.expr("CASE o_orderkey % 5 WHEN 0 THEN 'conforme a Lei 14.133/2021' WHEN 1 THEN 'vide IN 65/2021, item 3' WHEN 2 THEN 'o Decreto 10.947/2022 e a IN' WHEN 3 THEN 'a Portaria 938' ELSE 'nada' END")
    return t(spark, d, "orders").select("o_orderkey", legal.document_id_in(x).alias("doc_id"))


_PHRASES = ("fica revogado o artigo", "revoga o inciso II", "passa a vigorar com a seguinte redação", "altera o caput", "dá nova redação ao texto", "regulamenta a lei", "este decreto regulamenta tudo", "salvo o disposto em contrário", "exceto quando houver", "excepcionalmente", "nos termos da lei", "na forma do regulamento", "observado o § 2º", "em consonância com isso", "conforme disposto", "mencionado no art. 3", "a que se refere o art. 9", "texto comum", "")
_PHRASE = f"CASE o_orderkey % {len(_PHRASES)} " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(_PHRASES)) + " END"
_REL = "CASE WHEN x = '' THEN {0} " + " ".join(f"WHEN regexp_matches(x, '(?i){re2(p)}') THEN {{{i + 1}}}" for i, (p, *_) in enumerate(rules.REL_TYPES)) + " ELSE {9999} END"


def _rel(values: list[str]) -> str:
    out = _REL
    for i, v in enumerate(values[:-1]):
        out = out.replace("{%d}" % i, v)
    return out.replace("{9999}", values[-1])


@query(f"""SELECT o_orderkey, {_rel(["'CITA'", *[f"'{r}'" for _, r, _ in rules.REL_TYPES], "'CITA'"])} AS rel_type, CAST({_rel(["0.0", *[str(c) for *_, c in rules.REL_TYPES], "0.5"])} AS DOUBLE) AS rel_type_confidence FROM (SELECT o_orderkey, {_PHRASE} AS x FROM orders)""")
def rel_type(spark, d):
    return t(spark, d, "orders").select("o_orderkey", legal.rel_type(F.expr(_PHRASE)).alias("r")).select("o_orderkey", "r.*")


_DESCRIBED = "CASE rel_type " + " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in rules.REL_DESCRIPTIONS.items()) + " ELSE concat('Tipo desconhecido: ', rel_type) END"


@query(f"""SELECT rel_type, {_DESCRIBED} AS description, count(*) AS uses FROM (SELECT {_rel(["'CITA'", *[f"'{r}'" for _, r, _ in rules.REL_TYPES], "'CITA'"])} AS rel_type FROM (SELECT {_PHRASE} AS x FROM orders) UNION ALL SELECT o_orderpriority FROM orders) GROUP BY ALL""")
def rel_type_catalogue(spark, d):
    """Relations of the orders' phrases with their descriptions, and names that are no relation."""
    o = t(spark, d, "orders")
    rel = o.select(legal.rel_type(F.expr(_PHRASE))["rel_type"].alias("rel_type")).unionByName(o.select(F.col("o_orderpriority").alias("rel_type")))
    return rel.groupBy("rel_type", legal.rel_type_description(F.col("rel_type")).alias("description")).agg(F.count(F.lit(1)).alias("uses"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount * 10 >= 0.8 THEN 'HIGH' WHEN l_discount * 10 >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS tier, CASE WHEN l_returnflag = 'R' THEN 'REGEX' ELSE 'UNKNOWN' END AS method, CASE l_linestatus WHEN 'O' THEN 'ART' ELSE 'UNKNOWN' END AS device, CAST(l_linenumber AS INTEGER) AS number FROM lineitem")
def confidence_tier(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", legal.confidence_tier(F.col("l_discount") * 10).alias("tier"), legal.extraction_method(F.when(F.col("l_returnflag") == "R", " regex ").otherwise(F.col("l_returnflag"))).alias("method"), legal.device_type(F.when(F.col("l_linestatus") == "O", "Artigo").otherwise("x")).alias("device"), legal.article_number_int(F.concat(F.col("l_linenumber").cast("string"), F.lit("-A"))).alias("number"))


_EDGE = "concat('leis:P', cast(l_partkey as string)) AS s, concat('leis:P', cast(l_suppkey * 7 % 500 as string)) AS g"


@query("""SELECT node_id, target_node_id FROM (SELECT DISTINCT concat('leis:O', l_orderkey) AS node_id, concat('leis:', CASE WHEN l_suppkey % 5 = 0 THEN concat('O', l_orderkey) WHEN l_suppkey % 7 = 0 THEN concat('C', l_orderkey % 10) ELSE concat('S', l_suppkey) END) AS target_node_id, l_orderkey AS k FROM lineitem) WHERE node_id <> target_node_id AND target_node_id <> concat('leis:C', k % 10)""")
def citation_normalize(spark, d):
    li, k = t(spark, d, "lineitem"), F.col("l_orderkey").cast("string")
    target = F.when(F.col("l_suppkey") % 5 == 0, F.concat(F.lit("leis:O"), k)).when(F.col("l_suppkey") % 7 == 0, F.concat(F.lit("leis:C"), (F.col("l_orderkey") % 10).cast("string"))).otherwise(F.concat(F.lit(" leis:S"), F.col("l_suppkey").cast("string")))
    c = li.select(F.concat(F.lit("leis:O"), k).alias("node_id"), F.col("l_linenumber").alias("ordinal"), target.alias("target_node_id"))
    ch = t(spark, d, "orders").select(F.concat(F.lit("leis:O"), F.col("o_orderkey").cast("string")).alias("node_id"), F.concat(F.lit("leis:C"), (F.col("o_orderkey") % 10).cast("string")).alias("parent_node_id"))
    return citations.normalise(c, ch).select("node_id", "target_node_id")


@query("SELECT concat('leis:O', l_orderkey) AS node_id, count(*) AS n FROM lineitem GROUP BY l_orderkey")
def citation_payload(spark, d):
    c = t(spark, d, "lineitem").select(F.concat(F.lit("leis:O"), F.col("l_orderkey").cast("string")).alias("node_id"), F.col("l_linenumber").alias("ordinal"), F.lit("t").alias("target_node_id"), F.lit("CITA").alias("rel_type"), F.lit(0.5).alias("rel_type_confidence"))
    j = citations.to_json(c)
    return j.select("node_id", F.json_array_length("citations").cast("long").alias("n"))


def _edges(spark, d):
    e = t(spark, d, "lineitem").selectExpr(_EDGE.split(" AS s, ")[0] + " AS source_node_id", _EDGE.split(" AS s, ")[1].replace(" AS g", " AS target_node_id"), "l_discount * 10 AS confidence", "l_shipdate", "l_orderkey")
    return e.select("source_node_id", "target_node_id", "confidence", F.lit("regex").alias("extraction_method"), F.col("l_orderkey").cast("string").alias("citation_text"), F.lit("CITA").alias("rel_type"), F.concat(F.lit("K"), (F.col("l_orderkey") % 1000).cast("string")).alias("source_chunk_id"))


@query(f"SELECT s AS source_node_id, g AS target_node_id, max(l_discount * 10) AS confidence, CASE WHEN max(l_discount * 10) >= 0.8 THEN 'HIGH' WHEN max(l_discount * 10) >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS confidence_tier FROM (SELECT {_EDGE.replace(' as string', ' as varchar')}, l_discount FROM lineitem) WHERE s <> g GROUP BY s, g")
def edges_dedup(spark, d):
    return graph.edges(_edges(spark, d)).select("source_node_id", "target_node_id", "confidence", "confidence_tier")


@query(f"SELECT DISTINCT n AS node_id, substr(n, 6) AS document_id FROM (SELECT unnest([s, g]) AS n FROM (SELECT {_EDGE} FROM lineitem) WHERE s <> g) WHERE CAST(substr(n, 7) AS INTEGER) % 3 <> 0")
def stub_nodes(spark, d):
    have = t(spark, d, "part").where("p_partkey % 3 = 0").select(F.concat(F.lit("leis:P"), F.col("p_partkey").cast("string")).alias("node_id"))
    more = spark.range(3000).where("id % 3 = 0").select(F.concat(F.lit("leis:P"), F.col("id").cast("string")).alias("node_id"))
    return graph.stubs(graph.edges(_edges(spark, d)), have.unionByName(more)).select("node_id", "document_id")


@query("SELECT concat('leis:', o_custkey) AS node_id, 'ART' AS device_type, CAST(max(o_orderkey) AS VARCHAR) AS text_preview FROM orders GROUP BY o_custkey")
def nodes_upsert(spark, d):
    o = t(spark, d, "orders").select(F.concat(F.lit("leis:"), F.col("o_custkey").cast("string")).alias("node_id"), F.col("o_custkey").cast("string").alias("document_id"), F.lit("").alias("span_id"), F.lit("article").alias("device_type"), F.col("o_orderkey").cast("string").alias("text"), F.col("o_orderkey").alias("ingested_at"))
    return graph.nodes(o).select("node_id", "device_type", "text_preview")


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT s, g FROM (SELECT {_EDGE}, l_discount FROM lineitem) WHERE s <> g AND l_discount * 10 >= 0.5),
 r AS (SELECT 'leis:P' || (x * 70) AS n, 0 AS hop FROM range(1, 8) t(x) UNION SELECT e.g, r.hop + 1 FROM r JOIN e ON e.s = r.n WHERE r.hop < 2)
 SELECT n AS node_id, CAST(min(hop) AS INTEGER) AS hop FROM r GROUP BY n HAVING min(hop) > 0""")
def khop_reach(spark, d):
    seeds = spark.range(1, 8).select(F.concat(F.lit("leis:P"), (F.col("id") * 70).cast("string")).alias("node_id"))
    return graph.expand(graph.edges(_edges(spark, d)), seeds, hops=2, least_tier="MEDIUM", rel_types=["CITA"]).select("node_id", "hop")


_RELS = "element_at(array('CITA', 'REFERENCIA', 'REGULAMENTA', 'DEPENDE_DE', 'EXCEPCIONA'), cast(l_linenumber % 5 as int) + 1)"


@query(f"""WITH RECURSIVE e AS (SELECT s, g, rel, max(c) AS c, CASE WHEN max(l_tax) >= 0.06 THEN 'HIGH' WHEN max(l_tax) >= 0.03 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM (SELECT {_EDGE}, ['CITA', 'REFERENCIA', 'REGULAMENTA', 'DEPENDE_DE', 'EXCEPCIONA'][l_linenumber % 5 + 1] AS rel, l_discount * 10 AS c, l_tax FROM lineitem) GROUP BY s, g, rel),
 f AS (SELECT * FROM e WHERE tier <> 'LOW' AND rel <> 'EXCEPCIONA' AND c >= CASE WHEN rel IN ('CITA', 'REFERENCIA') THEN 0 ELSE 0.8 END),
 r AS (SELECT 'leis:P' || (x * 70) AS n, 0 AS hop FROM range(1, 8) t(x) UNION SELECT f.g, r.hop + 1 FROM r JOIN f ON f.s = r.n WHERE r.hop < 4),
 m AS (SELECT n, min(hop) AS hop FROM r GROUP BY n)
 SELECT z.n AS node_id, CAST(z.hop AS INTEGER) AS hop, count(*) AS frequency, array_to_string(list_sort(list_distinct(list(f.rel))), ',') AS rel_types FROM m z JOIN f ON f.g = z.n JOIN m a ON a.n = f.s AND z.hop = a.hop + 1 GROUP BY z.n, z.hop ORDER BY hop, frequency DESC, node_id LIMIT 200""")
def graph_expansion(spark, d):
    """Four hops over edges of tier, allowed relations and each relation's own floor, circles included; the first 200."""
    e = t(spark, d, "lineitem").selectExpr(*_EDGE.replace(" AS s, ", " AS source_node_id;").replace(" AS g", " AS target_node_id").split(";"), f"{_RELS} AS rel_type", "l_discount * 10 AS c", "l_tax")
    e = e.groupBy("source_node_id", "target_node_id", "rel_type").agg(F.max("c").alias("rel_type_confidence"), F.max("l_tax").alias("x")).withColumn("confidence_tier", F.when(F.col("x") >= 0.06, "HIGH").when(F.col("x") >= 0.03, "MEDIUM").otherwise("LOW"))
    seeds = spark.range(1, 8).select(F.concat(F.lit("leis:P"), (F.col("id") * 70).cast("string")).alias("node_id"))
    out = graph.expand(e, seeds, hops=4, least_tier="MEDIUM", rel_types=[r for r in rules.REL_BROAD if r != "EXCEPCIONA"], floors=rules.REL_FLOORS, top_k=200)
    return out.withColumn("rel_types", F.array_join("rel_types", ","))


@query("SELECT concat('O', o_orderkey) AS node_id, CAST(r - 1 AS INTEGER) AS hop, CAST(1 AS BIGINT) AS frequency FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r > 1")
def chain_reach(spark, d):
    """All that the first order of each customer leads to, along chains as long as its orders, which close to circles."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = t(spark, d, "orders").select("o_orderkey", F.lead("o_orderkey").over(w).alias("next"), F.min("o_orderkey").over(w).alias("first"))
    name = lambda c: F.concat(F.lit("O"), F.col(c).cast("string"))
    e = o.select(name("o_orderkey").alias("source_node_id"), F.coalesce(name("next"), name("first")).alias("target_node_id"), F.lit("CITA").alias("rel_type"), F.lit(0.5).alias("confidence"), F.lit("LOW").alias("confidence_tier"))
    return graph.expand(e, o.where("o_orderkey = first").select(name("first").alias("node_id")), hops=None).select("node_id", "hop", "frequency")


@query(f"""WITH e AS (SELECT DISTINCT s, g FROM (SELECT {_EDGE} FROM lineitem) WHERE s <> g) SELECT (SELECT count(*) FROM part WHERE p_partkey % 3 = 0) AS nodes, count(*) AS edges, CAST(0 AS BIGINT) AS self_loops,
 count(*) FILTER (s NOT IN (SELECT concat('leis:P', p_partkey) FROM part WHERE p_partkey % 3 = 0) OR g NOT IN (SELECT concat('leis:P', p_partkey) FROM part WHERE p_partkey % 3 = 0)) AS dangling_edges FROM e""")
def graph_audit(spark, d):
    have = t(spark, d, "part").where("p_partkey % 3 = 0").select(F.concat(F.lit("leis:P"), F.col("p_partkey").cast("string")).alias("node_id"))
    chunks = spark.range(1000).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("chunk_id"))
    return graph.audit(graph.edges(_edges(spark, d)), have, chunks).select("nodes", "edges", "self_loops", "dangling_edges")


# --- rulings --------------------------------------------------------------------------------
#: Rulings whose fields and numbers of paragraphs and items follow from the customer's key; one text for Spark, and what must come of it for SQL.
_BODIES = (("Plenário", "Plenario"), ("Primeira Câmara", "1a_Camara"), ("2ª Câmara", "2a_Camara"))
_OUTCOMES = (("parcialmente procedente", "Parcialmente procedente"), ("improcedente", "Improcedente"), ("procedente", "Procedente"))
_PARS = lambda lo, n, what: f"array_join(transform(sequence(1, {n}), i -> concat(cast(i + {lo} as string), '. {what} ', cast(i + {lo} as string), ' do caso {{k}}.')), chr(10))"
_RULING = f"""replace(concat(
 'ACÓRDÃO Nº ', '{{k}}', '/', 2000 + c_custkey % 24, ' – ', element_at(array({", ".join(f"'{x}'" for x, _ in _BODIES)}), cast(c_custkey % 3 as int) + 1), chr(10),
 'TC ', lpad(cast(c_custkey % 999 as string), 3, '0'), '.345/2020-', c_custkey % 9, chr(10), 'Natureza: Representação', chr(10), 'Relator: Ministro ', c_mktsegment, chr(10), 'Unidade Técnica: Selog', chr(10), 'Data da Sessão: ', c_custkey % 28 + 1, '/2/2021', chr(10),
 CASE WHEN c_custkey % 2 = 0 THEN concat('SUMÁRIO: REPRESENTAÇÃO. CASO {{k}}.', chr(10), chr(10)) ELSE chr(10) END,
 'RELATÓRIO', chr(10), chr(10), 'I. INTRODUÇÃO GERAL', chr(10), {_PARS(0, "cast(c_custkey % 3 + 1 as int)", "Ponto")}, chr(10), 'II.1. Exame técnico', chr(10), {_PARS("c_custkey % 3 + 1", "cast(c_custkey % 4 + 1 as int)", "Ponto")}, chr(10),
 'VOTO', chr(10), chr(10), {_PARS(0, "cast(c_custkey % 5 + 1 as int)", "Voto")}, chr(10), CASE WHEN c_custkey % 3 = 0 THEN concat('1. Citado.', chr(10)) ELSE '' END, 'Voto por considerar a representação ', element_at(array({", ".join(f"'{x}'" for x, _ in _OUTCOMES)}), cast(c_custkey % 3 as int) + 1), '.', chr(10),
 'ACÓRDÃO Nº {{k}}/', 2000 + c_custkey % 24, ' – Plenário', chr(10), chr(10), array_join(transform(sequence(1, cast(c_custkey % 4 + 1 as int)), i -> concat('9.', i, '. item ', i, ';', CASE WHEN i = 2 AND c_custkey % 3 > 0 THEN concat(chr(10), array_join(transform(sequence(1, cast(c_custkey % 3 as int)), j -> concat('9.2.', j, '. prazo ', j, ';')), chr(10))) ELSE '' END)), chr(10)), chr(10)), '{{k}}', cast(c_custkey as string))"""


def _rulings(spark, d):
    return ranges.dealt(t(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey").select(F.concat(F.lit("AC-"), F.col("c_custkey").cast("string")).alias("document_id"), F.expr(_RULING).alias("text"))


@query("""WITH c AS (SELECT c_custkey AS k, c_custkey % 3 + 1 AS p1, c_custkey % 4 + 1 AS p2, c_custkey % 5 + 1 AS v, c_custkey % 4 + 1 AS m, c_custkey % 3 AS s FROM customer)
SELECT concat('AC-', k) AS document_id, span_id, parent_span_id, CAST(d AS INTEGER) AS hierarchy_depth, text FROM (
 SELECT k, unnest(['SEC-RELATORIO', 'SEC-RELATORIO-I', 'SEC-RELATORIO-II.1', 'SEC-VOTO', 'SEC-ACORDAO']) AS span_id, unnest(['', 'SEC-RELATORIO', 'SEC-RELATORIO', '', '']) AS parent_span_id, unnest([0, 1, 2, 0, 0]) AS d, NULL AS text FROM c
 UNION ALL SELECT k, concat('PAR-RELATORIO-', i), CASE WHEN i <= p1 THEN 'SEC-RELATORIO-I' ELSE 'SEC-RELATORIO-II.1' END, 2, concat(i, '. Ponto ', i, ' do caso ', k, '.') FROM (SELECT *, unnest(range(1, p1 + p2 + 1)) AS i FROM c)
 UNION ALL SELECT k, concat('PAR-VOTO-', i), 'SEC-VOTO', 2, concat(i, '. Voto ', i, ' do caso ', k, '.', CASE WHEN i = v AND s > 0 THEN concat(chr(10), 'Voto por considerar a representação ', ['parcialmente procedente', 'improcedente', 'procedente'][s + 1], '.') ELSE '' END) FROM (SELECT *, unnest(range(1, v + 1)) AS i FROM c)
 UNION ALL SELECT k, 'PAR-VOTO-1-2', 'SEC-VOTO', 2, concat('1. Citado.', chr(10), 'Voto por considerar a representação parcialmente procedente.') FROM c WHERE s = 0
 UNION ALL SELECT k, concat('ITEM-9.', i), 'SEC-ACORDAO', 1, concat('9.', i, '. item ', i, ';') FROM (SELECT *, unnest(range(1, m + 1)) AS i FROM c)
 UNION ALL SELECT k, concat('ITEM-9.2.', j), 'ITEM-9.2', 2, concat('9.2.', j, '. prazo ', j, ';') FROM (SELECT *, unnest(range(1, s + 1)) AS j FROM c WHERE m >= 2))""")
def ruling_devices(spark, d):
    out = rulings.devices(_rulings(spark, d))
    return out.select("document_id", "span_id", "parent_span_id", "hierarchy_depth", F.when(F.col("device_type") != "section", F.col("text")).alias("text"))


@query(f"""SELECT concat('AC-', c_custkey) AS document_id, CAST(c_custkey AS VARCHAR) AS numero, CAST(2000 + c_custkey % 24 AS VARCHAR) AS ano, [{", ".join(f"'{x}'" for _, x in _BODIES)}][c_custkey % 3 + 1] AS colegiado, concat('TC ', lpad(CAST(c_custkey % 999 AS VARCHAR), 3, '0'), '.345/2020-', c_custkey % 9) AS processo,
 trim(c_mktsegment) AS relator, concat(c_custkey % 28 + 1, '/2/2021') AS data_sessao, CASE WHEN c_custkey % 2 = 0 THEN concat('REPRESENTAÇÃO. CASO ', c_custkey, '.') ELSE '' END AS sumario, [{", ".join(f"'{x}'" for _, x in _OUTCOMES)}][c_custkey % 3 + 1] AS resultado FROM customer""")
def ruling_header(spark, d):
    return rulings.header(_rulings(spark, d)).select("document_id", "numero", "ano", "colegiado", "processo", "relator", "data_sessao", "sumario", "resultado")


@query("""SELECT concat('AC-', c_custkey) AS document_id, s AS span_id, CAST(1 AS INTEGER) AS total_parts, true AS sliced, concat('[CONTEXTO: Acórdão ', c_custkey, '/', 2000 + c_custkey % 24, '-', ['Plenario', '1a_Camara', '2a_Camara'][c_custkey % 3 + 1], ' | ', CASE s WHEN 'SEC-EMENTA' THEN 'Ementa' WHEN 'SEC-RELATORIO' THEN 'Relatório' WHEN 'SEC-VOTO' THEN concat('Voto do Min. ', trim(c_mktsegment)) ELSE 'Dispositivo (decisão vinculante)' END, ']') AS context
 FROM customer, (VALUES ('SEC-EMENTA'), ('SEC-RELATORIO'), ('SEC-VOTO'), ('SEC-ACORDAO')) v(s) WHERE s <> 'SEC-EMENTA' OR c_custkey % 2 = 0""")
def ruling_chunks(spark, d):
    docs = _rulings(spark, d)
    dev, heads = rulings.devices(docs), rulings.header(docs)
    ch = rulings.chunk(rulings.parsed_sections(dev, docs, heads), heads)
    whole = ch.join(docs.select("document_id", F.col("text").alias("whole")), "document_id")
    same = F.substring(F.col("whole"), F.col("canonical_start") + 1, F.col("canonical_end") - F.col("canonical_start")) == F.col("text")
    return whole.select("document_id", "span_id", "total_parts", same.alias("sliced"), F.substring_index("retrieval_text", "\n", 1).alias("context"))


@query("""SELECT concat('acordaos:AC-', c_custkey, '#', s) AS node_id, concat('AC-', c_custkey, '#', s) AS chunk_id, 'section' AS device_type, concat('TC ', lpad(CAST(c_custkey % 999 AS VARCHAR), 3, '0'), '.345/2020-', c_custkey % 9) AS processo, true AS hashed
 FROM customer, (VALUES ('SEC-EMENTA'), ('SEC-RELATORIO'), ('SEC-VOTO'), ('SEC-ACORDAO')) v(s) WHERE s <> 'SEC-EMENTA' OR c_custkey % 2 = 0""")
def ruling_rows(spark, d):
    docs = _rulings(spark, d)
    dev, heads = rulings.devices(docs), rulings.header(docs)
    out = rulings.to_chunks(rulings.chunk(rulings.parsed_sections(dev, docs, heads), heads), docs, heads).join(docs.select("document_id", F.col("text").alias("whole")), "document_id")
    return out.select("node_id", "chunk_id", "device_type", "processo", (F.col("canonical_hash") == tx.sha256(F.col("whole"))).alias("hashed"))


#: Votes of 5 to 64 paragraphs of 63 to 800 characters, as arrays of paragraphs.
_VOTE = "transform(sequence(1, cast(5 + c_custkey % 60 as int)), i -> concat(cast(i as string), '. ', repeat('x', cast(60 + (i * 37 + c_custkey * 13) % 700 as int))))"


@query(f"""WITH RECURSIVE c AS (SELECT concat('AC-', c_custkey) AS document_id, list_transform(range(1, 6 + c_custkey % 60), lambda i: concat(i, '. ', repeat('x', 60 + (i * 37 + c_custkey * 13) % 700))) AS ps FROM customer),
 b AS (SELECT document_id, ps, len(ps) AS n, concat('VOTO', chr(10), array_to_string(ps, chr(10))) AS text, list_transform(range(0, len(ps) + 1), lambda i: CAST(coalesce(list_sum(list_transform(ps[1:i], lambda p: length(p))), 0) AS BIGINT)) AS pre FROM c),
 w AS (SELECT document_id, n, text, pre, 1 AS part, CAST(0 AS BIGINT) AS i, greatest(1, len(list_filter(pre, lambda x: x <= {rulings.CHUNK})) - 1) AS j FROM b WHERE length(text) > {rulings.CHUNK}
  UNION ALL SELECT document_id, n, text, pre, part + 1, i2, greatest(i2 + 1, len(list_filter(pre, lambda x: x - pre[i2 + 1] <= {rulings.CHUNK})) - 1) FROM (
   SELECT *, least(j, greatest(k, len(list_filter(pre, lambda x: x < pre[j + 2] - {rulings.CHUNK})))) AS i2 FROM (
    SELECT *, greatest(i + 1, len(list_filter(pre, lambda x: x <= pre[j + 1] - greatest({rulings.OVERLAP_LEAST}, least({rulings.OVERLAP_MOST}, CAST(floor((pre[j + 1] - pre[i + 1] + CASE WHEN i = 0 THEN 5 ELSE 0 END) * {rulings.OVERLAP}) AS BIGINT))))) - 1) AS k FROM w WHERE j < n))),
 s AS (SELECT document_id, text, part, CASE WHEN i = 0 THEN 0 ELSE 5 + pre[i + 1] + i END AS a, CASE WHEN j >= n THEN length(text) ELSE 4 + pre[j + 1] + j END AS z, max(part) OVER (PARTITION BY document_id) AS parts FROM w UNION ALL SELECT document_id, text, 1, 0, length(text), 1 FROM b WHERE length(text) <= {rulings.CHUNK}),
 f AS (SELECT *, coalesce(max(CASE WHEN part = parts AND parts > 1 AND z - a < {int(rulings.CHUNK * rulings.RUNT)} THEN z END) OVER (PARTITION BY document_id), 0) AS runt FROM s)
 SELECT document_id, CAST(a AS INTEGER) AS canonical_start, CAST(CASE WHEN runt > 0 AND part = parts - 1 THEN runt ELSE z END AS INTEGER) AS canonical_end, CAST(part AS INTEGER) AS part_number, CAST(CASE WHEN runt > 0 THEN parts - 1 ELSE parts END AS INTEGER) AS total_parts,
  sha256(substr(text, CAST(a AS BIGINT) + 1, CAST(CASE WHEN runt > 0 AND part = parts - 1 THEN runt ELSE z END - a AS BIGINT))) AS text_sha256 FROM f WHERE NOT (runt > 0 AND part = parts)""")
def overlap_chunks(spark, d):
    docs = ranges.dealt(t(spark, d, "customer").select("c_custkey"), "c_custkey").select(F.concat(F.lit("AC-"), F.col("c_custkey").cast("string")).alias("document_id"), F.concat(F.lit("VOTO\n"), F.expr(f"array_join({_VOTE}, chr(10))")).alias("text"))
    dev, heads = rulings.devices(docs), rulings.header(docs)
    return rulings.chunk(rulings.parsed_sections(dev, docs, heads), heads).select("document_id", "canonical_start", "canonical_end", "part_number", "total_parts", tx.sha256(F.col("text")).alias("text_sha256"))


@query("""WITH p AS (SELECT source, doc_id, coalesce(sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS z FROM documents WHERE text IS NOT NULL),
 o AS (SELECT source, doc_id, CAST(doc_id * 997 % 200000 AS BIGINT) AS x FROM documents) SELECT o.doc_id, coalesce(p.doc_id, m.l) AS page_number FROM o LEFT JOIN p ON p.source = o.source AND o.x >= p.a AND o.x < p.z JOIN (SELECT source, max(doc_id) AS l FROM p GROUP BY source) m ON m.source = o.source""")
def page_for_offset(spark, d):
    from pyspark.sql.window import Window

    docs = t(spark, d, "documents")
    w = Window.partitionBy("source").orderBy("doc_id")
    n = F.sum(F.length("text"))
    pages = docs.where("text is not null").select(F.col("source").alias("document_id"), F.col("doc_id").alias("page_number"), F.coalesce(n.over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"), n.over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("end"))
    rows = docs.select("doc_id", F.col("source").alias("document_id"), (F.col("doc_id") * 997 % 200000).alias("char_start"))
    return rulings.on_pages(rows, pages).select("doc_id", "page_number")


# --- streams --------------------------------------------------------------------------------
@query("SELECT event_id, CAST(count(*) OVER (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts)) AS BIGINT) RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW) AS BIGINT) AS offered FROM events")
def rate_limit_offered(spark, d):
    e = t(spark, d, "events").select(F.col("user_id").alias("key"), "ts", "event_id")
    return limits.offered(e, 3600).select("event_id", "offered")


@query("""WITH RECURSIVE s AS (SELECT user_id, event_id, epoch(ts) AS x, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
 b AS (SELECT user_id, event_id, r, x, x AS a1, CAST(NULL AS DOUBLE) AS a2, CAST(NULL AS DOUBLE) AS a3, true AS admitted FROM s WHERE r = 1 UNION ALL
 SELECT s.user_id, s.event_id, s.r, s.x, CASE WHEN ok THEN s.x ELSE a1 END, CASE WHEN ok THEN a1 ELSE a2 END, CASE WHEN ok THEN a2 ELSE a3 END, ok FROM (SELECT b.user_id AS u, b.r AS br, a1, a2, a3, coalesce(a3 <= s0.x - 21600, true) AS ok FROM b JOIN s AS s0 ON s0.user_id = b.user_id AND s0.r = b.r + 1) q JOIN s ON s.user_id = q.u AND s.r = q.br + 1)
 SELECT user_id AS key, event_id AS id, admitted, CAST(3 - coalesce(a1 > x - 21600, false)::INT - coalesce(a2 > x - 21600, false)::INT - coalesce(a3 > x - 21600, false)::INT AS INTEGER) AS remaining FROM b""")
def rate_limit_admit(spark, d):
    """Three requests in six hours a user: rejected ones are not recorded, so it takes a stateful fold."""
    e = t(spark, d, "events").select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("id"))
    return limits.admit_batch(e, 3, 6 * 3600)


@query("""WITH RECURSIVE s AS (SELECT user_id, event_id, epoch(ts) AS x, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
 b AS (SELECT user_id, event_id, r, x AS opened, CAST(0 AS BIGINT) AS batch, 0 AS place FROM s WHERE r = 1 UNION ALL
 SELECT s.user_id, s.event_id, s.r, CASE WHEN b.place + 1 >= 4 OR s.x - b.opened > 36000 THEN s.x ELSE b.opened END, CASE WHEN b.place + 1 >= 4 OR s.x - b.opened > 36000 THEN b.batch + 1 ELSE b.batch END, CASE WHEN b.place + 1 >= 4 OR s.x - b.opened > 36000 THEN 0 ELSE b.place + 1 END FROM b JOIN s ON s.user_id = b.user_id AND s.r = b.r + 1)
 SELECT event_id, batch, CAST(place AS INTEGER) AS place FROM b""")
def microbatch_groups(spark, d):
    e = t(spark, d, "events").select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("id"))
    return limits.group_batches(e, 4, 36_000_000).select(F.col("id").alias("event_id"), "batch", "place")


@query("""SELECT w AS window_start, count(*) AS requests, count(DISTINCT user_id) AS keys FROM (SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) - to_hours(CAST(6 * i AS BIGINT)) AS w FROM events, range(0, 4) r(i)) GROUP BY w""")
def limiter_stats(spark, d):
    e = t(spark, d, "events").select(F.col("user_id").alias("key"), "ts")
    return limits.limiter_stats(e, "24 hours", "6 hours")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_windows(spark, d):
    return limits.tumbling(t(spark, d, "events"), "1 hour", ["event_type"]).withColumn("total", F.round("total", 4))


@query("""SELECT user_id, min(ts) AS session_start, count(*) AS n FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT user_id, event_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS b FROM events)) GROUP BY user_id, s""")
def session_windows(spark, d):
    return limits.sessions(t(spark, d, "events"), "2 hours", ["user_id"])


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def revenue_rollup(spark, d):
    return t(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT key, CAST(sum(n) AS BIGINT) AS items, count(*) AS batches FROM (SELECT event_type AS key, epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS b, count(*) AS n FROM events GROUP BY ALL) GROUP BY key")
def collector_stats(spark, d):
    e = t(spark, d, "events").select(F.col("event_type").alias("key"), F.floor(F.col("ts").cast("timestamp").cast("double") / 3600).alias("batch"))
    return limits.batch_stats(e).select("key", "items", "batches")


@query("SELECT event_type, abs(count(DISTINCT user_id) - count(DISTINCT user_id)) = 0 AS close FROM events GROUP BY event_type")
def approx_distinct_users(spark, d):
    users = t(spark, d, "events").select("event_type", "user_id").distinct()  # beside an exact count a sketch would be kept for each user
    e = users.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("a"), F.count("user_id").alias("x"))
    return e.select("event_type", (F.abs(F.col("a") - F.col("x")) <= 0.1 * F.col("x")).alias("close"))
