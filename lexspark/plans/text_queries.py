"""Queries on text: canonical form, hashes, matching form, model output, requests, pairs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import legal
from ..functions import text as tx
from ..operators import offsets, quality, registry, vectors
from ..sources import stores
from .base import SQL_CANONICAL, query, t

CANON = SQL_CANONICAL.format("text")


@query(f"SELECT doc_id, sha256({CANON}) AS canonical_sha256, CAST(length({CANON}) AS BIGINT) AS n FROM documents")
def canonicalize_hash(spark, d):
    c = tx.canonical(F.col("text"))
    return t(spark, d, "documents").select("doc_id", c.alias("c")).select("doc_id", tx.sha256(F.col("c")).alias("canonical_sha256"), F.length("c").cast("long").alias("n"))


@query(f"SELECT h AS canonical_sha256, count(*) AS copies, min(doc_id) AS first_doc FROM (SELECT doc_id, sha256({CANON}) AS h FROM documents) GROUP BY h HAVING count(*) > 1")
def duplicate_documents(spark, d):
    h = tx.sha256(tx.canonical(F.col("text"))).alias("canonical_sha256")
    return t(spark, d, "documents").select("doc_id", h).groupBy("canonical_sha256").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc")).where("copies > 1")


@query(f"SELECT lang, count(*) AS documents, count(DISTINCT sha256({CANON})) AS distinct_texts, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars FROM documents GROUP BY lang")
def corpus_profile(spark, d):
    h = tx.sha256(tx.canonical(F.col("text")))
    return t(spark, d, "documents").select("lang", "text", h.alias("h")).groupBy("lang").agg(F.count(F.lit(1)).alias("documents"), F.countDistinct("h").alias("distinct_texts"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))


_RUNS = "doc_id, source AS pdf_hash, lang AS pipeline_version, CASE WHEN doc_id % 4 = 0 THEN sha256(text) ELSE source END AS canonical_hash"


@query(f"""SELECT doc_id, p AS previous_hash, CASE WHEN p IS NULL THEN 'first_run' WHEN p = canonical_hash THEN 'deterministic' ELSE 'drifted' END AS state FROM (
  SELECT *, CASE WHEN run_ts - lag(run_ts) OVER w <= INTERVAL 30 DAY THEN lag(canonical_hash) OVER w END AS p
  FROM (SELECT {_RUNS}, TIMESTAMP '2024-01-01' + to_minutes(doc_id * 700) AS run_ts FROM documents) WINDOW w AS (PARTITION BY pdf_hash, pipeline_version ORDER BY run_ts, doc_id))""")
def drift_check(spark, d):
    runs = t(spark, d, "documents").selectExpr(*[x.strip() for x in ["doc_id", "source AS pdf_hash", "lang AS pipeline_version", "CASE WHEN doc_id % 4 = 0 THEN sha2(text, 256) ELSE source END AS canonical_hash", "timestampadd(MINUTE, doc_id * 700, timestamp '2024-01-01') AS run_ts", "doc_id AS document_id"]])
    return registry.drift(runs).select("doc_id", "previous_hash", "state")


@query(f"SELECT doc_id, coalesce(h <> '' AND h = sha256({CANON}), false) AS valid FROM (SELECT doc_id, text, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN sha256({CANON}) ELSE sha256(text) END AS h FROM documents)")
def offsets_hash_valid(spark, d):
    docs = t(spark, d, "documents")
    h = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, tx.sha256(tx.canonical(F.col("text")))).otherwise(tx.sha256(F.col("text")))
    return docs.select("doc_id", "text", h.alias("h")).select("doc_id", F.coalesce(tx.offsets_valid(F.col("h"), F.col("text")), F.lit(False)).alias("valid"))


@query("""SELECT doc_id, CASE WHEN ok THEN substring(text, s + 1, e - s) ELSE '' END AS snippet, ok AS used FROM (
  SELECT *, coalesce(s >= 0 AND e > s AND e <= length(text) AND doc_id % 7 <> 0, false) AS ok FROM (SELECT doc_id, text, doc_id % 50 - 2 AS s, doc_id % 50 + 18 + doc_id % 30 AS e FROM documents))""")
def snippet_slice(spark, d):
    docs = t(spark, d, "documents").selectExpr("doc_id", "text", "cast(doc_id % 50 - 2 as int) AS s", "cast(doc_id % 50 + 18 + doc_id % 30 as int) AS e", "CASE WHEN doc_id % 7 = 0 THEN 'x' ELSE sha2(text, 256) END AS h")
    return docs.select("doc_id", tx.snippet(F.col("text"), F.col("s"), F.col("e"), F.col("h")).alias("x")).select("doc_id", "x.*")


_MARKED = "concat('«Ação» – nº 5, 1ª … “ok” ‘y’ 3° que-', chr(10), '  bra  ', text)"


@query(f"""SELECT doc_id, sha256(m) AS matching_sha256, CAST(length(m) AS BIGINT) AS n FROM (SELECT doc_id, trim(regexp_replace(regexp_replace(replace(translate({_MARKED}, '–—“”‘’«»ºª°', '--""''''""oao'), '…', '...'), '-\\s*\\n\\s*', '', 'g'), '\\s+', ' ', 'g')) AS m FROM documents WHERE text IS NOT NULL)""")
def matching_normalize(spark, d):
    m = tx.matching(F.expr(_MARKED))
    return t(spark, d, "documents").where("text is not null").select("doc_id", m.alias("m")).select("doc_id", tx.sha256(F.col("m")).alias("matching_sha256"), F.length("m").cast("long").alias("n"))


_FOLD = """trim(regexp_replace(regexp_replace(replace(translate({0}, '–—“”‘’«»ºª°', '--""''''""oao'), '…', '...'), '-\\s*\\n\\s*', '', 'g'), '\\s+', ' ', 'g'))"""


@query(f"SELECT doc_id, CAST(length({_FOLD.format(_MARKED)}) AS BIGINT) AS n_norm, true AS maps_back FROM documents WHERE text IS NOT NULL")
def matching_offset_map(spark, d):
    docs = t(spark, d, "documents").where("text is not null").select("doc_id", F.expr(_MARKED).alias("s"))
    m = docs.select("doc_id", F.split("s", "").alias("s"), tx.matching_with_offsets(F.col("s")).alias("m"))
    # a letter or digit of the matching form stands in the source at its offset, and offsets ascend
    pairs = F.zip_with(F.split("m.norm", ""), "m.source", lambda c, k: ~c.rlike("[A-Za-z0-9]") | F.try_element_at("s", k + 1).isin("º", "ª", "°") | (F.try_element_at("s", k + 1) == c))
    up = F.forall(F.zip_with(F.slice("m.source", 1, F.size("m.source") - 1), F.slice("m.source", 2, F.size("m.source")), lambda a, b: a <= b), lambda x: x)
    return m.select("doc_id", F.length("m.norm").cast("long").alias("n_norm"), (F.forall(pairs, lambda x: x) & up).alias("maps_back"))


_THOUGHT = "CASE WHEN turn % 3 = 0 THEN concat(text, '<think>', role) WHEN turn % 3 = 1 THEN concat('<think>', role, ' hm</think> ', text) ELSE text END"


@query(f"""SELECT conv_id, turn, sha256(trim(regexp_replace(regexp_replace(x, '(?s)<think>.*?</think>\\s*', '', 'g'), '(?s)<think>.*$', ''))) AS clean_sha256,
  CAST(floor(length(regexp_extract(x, '(?s)<think>(.*?)(?:</think>|$)', 1)) / 4) AS BIGINT) AS thinking_tokens FROM (SELECT conv_id, turn, {_THOUGHT} AS x FROM conversations)""")
def think_strip(spark, d):
    c = t(spark, d, "conversations").select("conv_id", "turn", F.expr(_THOUGHT).alias("x"))
    return c.select("conv_id", "turn", tx.sha256(tx.strip_thinking(F.col("x"))).alias("clean_sha256"), tx.thinking_tokens(F.col("x")).cast("long").alias("thinking_tokens"))


@query("""SELECT conv_id, turn, sha256(CASE WHEN role = 'user' AND turn = last THEN concat(text, ' /no_think') ELSE text END) AS prompt_sha256 FROM (
  SELECT *, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id) AS last FROM conversations)""")
def chat_prep(spark, d):
    last = F.max(F.when(F.col("role") == "user", F.col("turn"))).over(Window.partitionBy("conv_id"))
    c = t(spark, d, "conversations").withColumn("last", last)
    return c.select("conv_id", "turn", tx.sha256(tx.no_think(F.col("role"), F.col("text"), F.coalesce(F.col("turn") == F.col("last"), F.lit(False)))).alias("prompt_sha256"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props_extract(spark, d):
    said = F.concat(F.lit("<think>x</think>Here: ```json\n"), "props", F.lit("\n```"))
    fenced = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).otherwise(said)
    return t(spark, d, "events").select("event_id", F.get_json_object(tx.salvage_json(fenced), "$.k").cast("long").alias("k"))


@query("SELECT doc_id, sha256(CASE WHEN length(text) <= 200 THEN text ELSE concat(left(text, 96), ' [...] ', right(text, 96)) END) AS cut_sha256 FROM documents")
def head_tail_cut(spark, d):
    return t(spark, d, "documents").select("doc_id", tx.sha256(tx.head_tail(F.col("text"), 200)).alias("cut_sha256"))


@query("SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN 'no_texts' WHEN length(text) > 10000 THEN 'text_too_long' WHEN doc_id % 120 NOT BETWEEN 1 AND 100 THEN 'bad_top_k' END AS error FROM documents")
def request_validation(spark, d):
    r = t(spark, d, "documents").select("doc_id", F.when(F.coalesce("text", F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array("text")).alias("texts"), (F.col("doc_id") % 120).alias("top_k"))
    return vectors.check_requests(r).select("doc_id", "error")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN concat('key:', left(concat(source, '-secret-token'), 12)) WHEN doc_id % 3 = 0 THEN concat('ip:10.0.0.', lang) ELSE concat('ip:', source) END AS client FROM documents")
def client_keys(spark, d):
    docs = t(spark, d, "documents")
    key = F.when(F.col("doc_id") % 2 == 0, F.concat("source", F.lit("-secret-token")))
    fwd = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("10.0.0."), "lang", F.lit(", 1.1.1.1")))
    return docs.select("doc_id", legal.client_key(key, fwd, F.col("source")).alias("client"))


_WS = "[\\s\\x0B\\x{85}\\p{Z}]+"


@query(f"""SELECT doc_id, CASE WHEN n = 1 THEN pos END AS start_at, CASE WHEN n = 1 THEN pos + length(q) END AS end_at, CASE WHEN q = '' THEN 'EMPTY_TEXT' WHEN text = '' THEN 'INVALID_PARENT_RANGE' WHEN n = 0 THEN 'NOT_FOUND' WHEN n > 1 THEN 'AMBIGUOUS_MULTIPLE_MATCHES' END AS reason FROM (
  SELECT doc_id, text, q, len(own) AS n, CAST(list_sum(list_transform(ps[1:own[1]], lambda x: length(x))) + (own[1] - 1) * length(q) AS BIGINT) AS pos FROM (
   SELECT *, list_filter(range(1, len(ps)), lambda i: ps[i] = '' OR NOT regexp_matches(right(ps[i], 1), '[\\p{{L}}\\p{{N}}]')) AS own FROM (
    SELECT *, CASE WHEN q = '' THEN [] ELSE string_split(text, q) END AS ps FROM (
     SELECT doc_id, text, coalesce(regexp_replace(regexp_replace(CASE WHEN doc_id % 5 = 0 THEN '@@none@@' ELSE split_part(text, '.', 1) || '.' END, '^{_WS}', ''), '{_WS}$', ''), '') AS q FROM documents))))""")
def child_offset_status(spark, d):
    """The first sentence of every document, sought in the whole of it."""
    first = F.when(F.col("doc_id") % 5 == 0, "@@none@@").otherwise(F.concat(F.substring_index("text", ".", 1), F.lit(".")))
    rows = t(spark, d, "documents").select("doc_id", F.col("text").alias("canonical_text"), F.lit(0).alias("parent_start"), F.length("text").alias("parent_end"), first.alias("chunk_text"))
    r = offsets.resolve(rows)
    return r.select("doc_id", F.col("start").cast("long").alias("start_at"), F.col("end").cast("long").alias("end_at"), "reason")


@query("""SELECT a.doc_id AS a_id, b.doc_id AS b_id, round(len(list_intersect(a.w, b.w)) / greatest(len(list_distinct(list_concat(a.w, b.w))), 1), 6) AS jaccard FROM v a JOIN v b ON b.doc_id = a.doc_id + 1""".replace("FROM v a JOIN v b", "FROM (SELECT doc_id, list_distinct(list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '')) AS w FROM documents) a JOIN (SELECT doc_id, list_distinct(list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '')) AS w FROM documents) b"))
def jaccard_pairs(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "text")
    b = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("doc_id").alias("b_id"), F.col("text").alias("other"))
    return docs.join(b, "doc_id").select(F.col("doc_id").alias("a_id"), "b_id", F.round(legal.word_jaccard(F.col("text"), F.col("other")), 6).alias("jaccard"))


_TAGS = "|".join(stores.HTML_BLOCKS)
_CHARS = "x"
for _name, _code in (*stores.HTML_NAMED.items(), ("amp", 38)):
    _CHARS = f"replace({_CHARS}, '&{_name};', chr({_code}))"


@query(f"""SELECT document_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY n) - 1 AS BIGINT) AS place, sha256(x) AS text_sha256 FROM (
  SELECT document_id, n, trim(regexp_replace({_CHARS}, '\\s+', ' ', 'g')) AS x FROM (
   SELECT document_id, n, regexp_replace(regexp_replace(substr(piece, instr(piece, chr(2)) + 1), '(?i)<br[^>]*>', ' ', 'g'), '</?[A-Za-z][^>]*>', '', 'g') AS x FROM (
    SELECT page_id AS document_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS n FROM (
     SELECT page_id, string_split(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', '', 'g'), '(?i)<(/?(?:{_TAGS}))(?:\\s[^>]*)?/?>', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS pieces FROM pages))
   WHERE regexp_matches(piece, '^(?i)(p|h[1-6])\\x02'))) WHERE x <> ''""")
def html_block_scan(spark, d):
    b = stores.html_blocks(t(spark, d, "pages"))
    place = F.row_number().over(Window.partitionBy("document_id").orderBy("block_index")) - 1
    return b.select("document_id", place.cast("long").alias("place"), tx.sha256(F.col("text")).alias("text_sha256"))


@query("""SELECT source AS document_id, count(*) AS pairs, count(*) FILTER (j < 0.5) AS differing, round(count(*) FILTER (j < 0.5) / count(*), 6) AS share FROM (
  SELECT source, len(list_intersect(a, b)) / greatest(len(list_distinct(list_concat(a, b))), 1) AS j FROM (
    SELECT source, list_distinct(list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '')) AS a,
           list_distinct(list_filter(string_split_regex(lower(left(text, CAST(length(text) * (doc_id % 10) / 10 AS INTEGER))), '\\s+'), lambda x: x <> '')) AS b FROM documents WHERE text IS NOT NULL)) GROUP BY source""")
def reading_agreement(spark, d):
    docs = t(spark, d, "documents").where("text is not null")
    cut = F.bround(F.length("text") * (F.col("doc_id") % 10) / 10).cast("int")  # halves to even, as SQL casts
    m = docs.select(F.col("source").alias("document_id"), F.lit(1).alias("page"), F.col("text").alias("text_a"), F.left("text", cut).alias("text_b"))
    return quality.reading_checks(m).select("document_id", "pairs", "differing", F.round("share", 6).alias("share"))


@query("SELECT doc_id, CAST(len(list_filter(string_split_regex(lower(text), '\\W+'), lambda x: x <> '')) > 0 AS BOOLEAN) AS has_vector, CAST(length(text) > 8192 AS BOOLEAN) AS truncated, CAST(len(list_distinct(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+'), lambda x: x <> ''))) AS BIGINT) AS n_words FROM documents WHERE text IS NOT NULL")
def embed_documents(spark, d):
    e = vectors.embed(t(spark, d, "documents").where("text is not null").select("doc_id", "text"))
    return e.select("doc_id", (F.round(vectors.dot(F.col("dense_vector"), F.col("dense_vector")), 3) == 1.0).alias("has_vector"), "truncated", F.size("sparse_vector").cast("long").alias("n_words"))


@query("""SELECT a.vec_id AS query_id, CAST(r AS INTEGER) AS rank, b AS vec_id, s AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, b) AS r FROM (
    SELECT q.vec_id, c.vec_id AS b, round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS s FROM embeddings q JOIN embeddings c ON q.label = c.label AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)) a WHERE r <= 5""")
def rerank_topk(spark, d):
    e = t(spark, d, "embeddings").select("vec_id", "embedding", "label")
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"), "label")
    p = vectors.nearest(q, e.select(F.col("vec_id").alias("pos"), F.col("embedding").alias("vector"), "label"), "label", 5)
    s = p.select("query_id", "pos", F.round("cosine", 6).alias("score"))
    return vectors.rerank(s, 5).select("query_id", F.col("rank"), F.col("pos").alias("vec_id"), "score")


@query("""SELECT query_id, pos, CAST(place AS INTEGER) AS place, score FROM (SELECT label AS query_id, vec_id AS pos, CASE WHEN label = 0 THEN row_number() OVER (PARTITION BY label ORDER BY vec_id) ELSE row_number() OVER (PARTITION BY label ORDER BY vec_id % 17 DESC, vec_id) END AS place,
  CASE WHEN label <> 0 THEN CAST(vec_id % 17 AS DOUBLE) END AS score FROM embeddings)""")
def reorder_by_ranking(spark, d):
    docs = t(spark, d, "embeddings").select(F.col("label").alias("query_id"), "vec_id")
    w = Window.partitionBy("query_id").orderBy("vec_id")
    docs = docs.withColumn("pos", F.row_number().over(w) - 1)
    scored = docs.where("query_id <> 0").select("query_id", "pos", (F.col("vec_id") % 17).cast("double").alias("score"))
    out = vectors.reorder(docs, vectors.rerank(scored))
    return out.select("query_id", F.col("vec_id").alias("pos"), F.col("place").cast("int").alias("place"), "score")
