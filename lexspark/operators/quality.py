"""Contracts, manifests, audits and evaluation of chunk and device tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as tx

#: Columns that a vector table must have.
REQUIRED_COLUMNS = ("canonical_start", "canonical_end", "canonical_hash")


def violations(chunks: DataFrame) -> DataFrame:
    """A row (document_id, node_id, span_id, rule) for each broken rule of the chunk contract.

    bad_prefix alone stops further checks of a chunk, as its kind is unknown.
    """
    nid, parent, kind = F.coalesce("node_id", F.lit("")), F.coalesce("parent_node_id", F.lit("")), F.coalesce("device_type", F.lit(""))
    ruling, law = nid.startswith("acordaos:"), nid.startswith("leis:")
    prefix = F.when(ruling, "acordaos:").otherwise("leis:")
    child = F.when(ruling, kind.isin("paragraph", "item_dispositivo")).otherwise(kind.isin("paragraph", "inciso", "alinea"))
    evidence = F.when(ruling, kind.isin("section", "paragraph", "item_dispositivo")).otherwise(kind.isin("article", "paragraph", "inciso", "alinea"))
    s, e, h = F.col("canonical_start"), F.col("canonical_end"), F.col("canonical_hash")
    present = s.isNotNull() & e.isNotNull() & h.isNotNull()
    sentinel = (s == -1) & (e == -1) & (h == "")
    valid = (s >= 0) & (e > s) & (h != "")
    rules = [
        (nid.contains("@P"), "node_id_part"), ((parent != "") & ~parent.startswith(prefix), "parent_prefix"), (parent.contains("@P"), "parent_part"),
        (child & (parent == ""), "child_without_parent"), (s.isNull(), "start_missing"), (e.isNull(), "end_missing"), (h.isNull(), "hash_missing"),
        (present & ~sentinel & ~valid, "offsets_incoherent"), (present & F.col("is_cross_page") & (F.coalesce("n_bbox_spans", F.lit(0)) == 0), "cross_page_without_spans"),
        (present & evidence & sentinel, "evidence_without_offsets"),
    ]
    broken = F.when(~(ruling | law), F.array(F.lit("bad_prefix"))).otherwise(F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in rules])))
    return chunks.select("document_id", "node_id", "span_id", F.explode(broken).alias("rule"))


def split_by_contract(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunks of sound documents, chunks of documents with any violation): a document passes whole or not at all."""
    bad = violations(chunks).select("document_id").distinct()
    return chunks.join(bad, "document_id", "left_anti"), chunks.join(bad, "document_id", "left_semi")


def assert_contract(chunks: DataFrame) -> DataFrame:
    """The chunks, raising at execution if one breaks the contract."""
    bad = violations(chunks).groupBy("document_id").agg(F.count(F.lit(1)).alias("n"))
    checked = chunks.join(bad, "document_id", "left")
    ok = F.when(F.col("n").isNull(), True).otherwise(F.raise_error(F.concat(F.lit("contract broken in document "), F.col("document_id"))).cast("boolean"))
    return checked.where(ok).drop("n")


def covered(intervals: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Length of the union of intervals for each key: overlapping or touching ones merge into islands."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = intervals.where((F.col(start) >= 0) & (F.col(end) > F.col(start)))
    rows = rows.withColumn("__new", (reach.isNull() | (F.col(start) > reach)).cast("int")).withColumn("__i", F.sum("__new").over(w))
    islands = rows.groupBy(*keys, "__i").agg((F.max(end) - F.min(start)).alias("__n"))
    return islands.groupBy(*keys).agg(F.sum("__n").alias("covered"), F.count(F.lit(1)).alias("islands"))


def manifest(chunks: DataFrame, canonical: DataFrame) -> DataFrame:
    """One row a document: counts by type and level, articles, external spans, targets and coverage of the canonical text."""
    number = F.regexp_replace(F.regexp_replace("span_id", "^ART-", ""), r"^0+(?=\d)", "")
    has = lambda c: c in chunks.columns
    external = F.col("origin_type") == "external" if has("origin_type") else F.lit(False)
    target = F.nullif(F.col("origin_reference"), F.lit("")) if has("origin_reference") else F.lit(None).cast("string")
    base = chunks.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.countDistinct("span_id").alias("distinct_spans"),
        F.array_sort(F.collect_set(F.when(F.col("device_type") == "article", number))).alias("article_numbers"),
        F.array_sort(F.collect_list(F.when(external, F.col("span_id")))).alias("external_spans"), F.array_sort(F.collect_set(target)).alias("target_documents"),
    )
    count = lambda c, name: chunks.groupBy("document_id", c).agg(F.count(F.lit(1)).alias("n")).groupBy("document_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(c, "n")))).alias(name))
    cov = covered(chunks.select("document_id", F.col("canonical_start").alias("start"), F.col("canonical_end").alias("end")), ["document_id"])
    out = base.join(count("device_type", "spans_by_type"), "document_id").join(count("chunk_level", "chunks_by_level"), "document_id")
    out = out.join(cov, "document_id", "left").join(canonical.select("document_id", F.length("canonical_text").alias("total_chars")), "document_id", "left")
    share = F.when(F.col("total_chars") > 0, F.round(100 * F.coalesce("covered", F.lit(0)) / F.col("total_chars"), 2)).otherwise(0.0)
    return out.withColumn("covered_chars", F.coalesce("covered", F.lit(0))).withColumn("coverage_pct", share).withColumn("vehicle_articles", F.array().cast("array<string>")).drop("covered", "islands")


def manifest_levels(chunks: DataFrame) -> DataFrame:
    """Chunks, external ones and characters by document, by document and type, by document and level, by type, and in all.

    Rows are (document_id, device_type, chunk_level, of, chunks, external, chars); ``of`` names the
    columns that a row stands for, the others are null. Grouping sets: one exchange serves all of them.
    """
    by = ["document_id", "device_type", "chunk_level"]
    c = chunks.select(*by, (F.col("origin_type") == "external" if "origin_type" in chunks.columns else F.lit(False)).alias("x"), F.greatest(F.col("canonical_end") - F.col("canonical_start"), F.lit(0)).alias("size"))
    sets = [["document_id"], ["document_id", "device_type"], ["document_id", "chunk_level"], ["device_type"], []]
    named = F.concat_ws(",", *[F.when(F.grouping(k) == 0, k) for k in by])
    sums = [F.count(F.lit(1)).alias("chunks"), F.count_if("x").alias("external"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("chars")]
    return c.groupingSets([[F.col(k) for k in s] for s in sets], *by).agg(named.alias("of"), *sums).select(*by, "of", "chunks", "external", "chars")


def run_manifest(runs: DataFrame) -> DataFrame:
    """Runs (run_id, document_id, status, started_at, ended_at, error) with their duration and outcome."""
    seconds = F.col("ended_at").cast("double") - F.col("started_at").cast("double")
    outcome = F.when(F.coalesce("error", F.lit("")) != "", "failed").when(F.col("ended_at").isNull(), "running").otherwise("success")
    return runs.withColumn("duration_seconds", F.round(seconds, 3)).withColumn("outcome", outcome)


def integrity(chunks: DataFrame, canonical: DataFrame) -> DataFrame:
    """Checks of each document: slices equal chunk texts (or begin them, where orphans were merged), canonical form, hash."""
    c = chunks.join(canonical.select("document_id", "canonical_text"), "document_id")
    part = F.substring(F.col("canonical_text"), F.col("canonical_start") + 1, F.col("canonical_end") - F.col("canonical_start"))
    own = F.col("canonical_start") >= 0
    good = (part == F.col("text")) | F.col("text").startswith(part)
    per = c.groupBy("document_id").agg(F.count_if(own).alias("sliced"), F.count_if(own & ~good).alias("mismatched"), F.bool_and(F.when(own, F.col("canonical_hash") == tx.sha256(F.col("canonical_text"))).otherwise(True)).alias("hashes_hold"))
    t = F.col("canonical_text")
    form = canonical.select("document_id", tx.is_canonical(t).alias("idempotent"), (~t.rlike(r"(?m)[ \t]+$")).alias("no_trailing_blanks"), (t.endswith("\n") & ~t.endswith("\n\n")).alias("one_final_newline"), (t == tx.nfc(t)).alias("composed"))
    return form.join(per, "document_id", "left")


def golden(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Precision, recall, offset rate and text match rate of each document against golden devices.

    ``expected`` is (document_id, span_id, text_prefix); ``found`` (document_id, span_id, text, canonical_start).
    Parágrafo único is matched under either of its ids.
    """
    key = lambda df: df.withColumn("k", F.regexp_replace("span_id", r"^(PAR-.*)-UNICO$", "$1-0"))
    both = key(expected).select("document_id", "k", "text_prefix", F.lit(1).alias("e")).join(key(found).select("document_id", "k", "text", "canonical_start", F.lit(1).alias("f")), ["document_id", "k"], "full_outer")
    hit = F.col("e").isNotNull() & F.col("f").isNotNull()
    n = both.groupBy("document_id").agg(F.count_if(hit).alias("matched"), F.count("e").alias("expected"), F.count("f").alias("found"), F.count_if(hit & (F.col("canonical_start") >= 0)).alias("with_offsets"), F.count_if(hit & F.col("text").startswith(F.col("text_prefix"))).alias("text_matched"))
    rate = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return n.select("document_id", "matched", "expected", "found", rate("matched", "found").alias("precision"), rate("matched", "expected").alias("recall"), rate("with_offsets", "matched").alias("offset_rate"), rate("text_matched", "matched").alias("text_match_rate"))


def markdown_elements(docs: DataFrame) -> DataFrame:
    """Elements of Markdown statutes by line (document_id, article, kind, label), the article carried forward."""
    line = docs.select("document_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    bare = F.regexp_replace("line", r"^[#*\s>-]+", "")
    kind = (
        F.when(bare.rlike(r"(?iuU)^CAP[ÍI]TULO\s"), "chapter").when(bare.rlike(r"(?iuU)^Art\.?\s*\d+"), "article").when(bare.rlike(r"(?iuU)^(§\s*\d+|Par[aá]grafo\s+[uú]nico)"), "paragraph")
        .when(bare.rlike(r"^[IVXLCDM]+\s*[-–—]"), "item").when(bare.rlike(r"^[a-z]\)\s"), "sub_item")
    )
    label = F.when(kind == "article", F.regexp_extract(bare, r"(\d+)", 1)).when(kind == "paragraph", F.coalesce(F.nullif(F.regexp_extract(bare, r"^§\s*(\d+)", 1), F.lit("")), F.lit("unico"))).when(kind == "item", F.regexp_extract(bare, r"^([IVXLCDM]+)", 1)).when(kind == "sub_item", F.left(bare, F.lit(1)))
    w = Window.partitionBy("document_id").orderBy("n")
    rows = line.select("document_id", "n", kind.alias("kind"), label.alias("label"))
    return rows.withColumn("article", F.last(F.when(F.col("kind") == "article", F.col("label")), ignorenulls=True).over(w)).where("kind is not null")


def sequence_gaps(numbers: DataFrame, keys: list[str], value: str = "number") -> DataFrame:
    """Numbers missing between 1 and the greatest of each key, as an array."""
    return numbers.groupBy(*keys).agg(F.array_sort(F.array_except(F.sequence(F.lit(1).cast("long"), F.max(F.col(value).cast("long"))), F.collect_set(F.col(value).cast("long")))).alias("missing"))


def by_article(elements: DataFrame) -> DataFrame:
    """Paragraph and item labels of each article."""
    of = lambda k: F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("label"))))
    return elements.groupBy("document_id", "article").agg(of("paragraph").alias("paragraphs"), of("item").alias("items"))


#: Shape of a statute as a model returns it.
STATUTE = "chapters array<struct<title:string,articles:array<struct<number:string,title:string,content:string,paragraphs:array<struct<identifier:string,content:string>>,items:array<struct<identifier:string,content:string,sub_items:array<struct<identifier:string,content:string>>>>>>>>"


def parse_statute(json: Column) -> Column:
    """A statute tree from JSON; null where it does not parse."""
    return F.from_json(json, f"struct<{STATUTE.replace(' ', ':', 1)}>")


def statute_counts(tree: DataFrame) -> DataFrame:
    """Chapters, articles, paragraphs, items and sub-items of each tree (document_id, chapters)."""
    total = lambda a, f: F.aggregate(F.coalesce(a, F.array()), F.lit(0), lambda s, x: s + f(x))
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    arts = F.flatten(F.transform("chapters", lambda c: F.coalesce(c["articles"], F.array().cast("array<struct<number:string,title:string,content:string,paragraphs:array<struct<identifier:string,content:string>>,items:array<struct<identifier:string,content:string,sub_items:array<struct<identifier:string,content:string>>>>>>"))))
    t = tree.withColumn("__a", arts)
    return t.select(
        "document_id", F.size("chapters").alias("chapters"), F.size("__a").alias("articles"), F.aggregate("__a", F.lit(0), lambda s, a: s + F.greatest(size(a["paragraphs"]), F.lit(0))).alias("paragraphs"),
        F.aggregate("__a", F.lit(0), lambda s, a: s + F.greatest(size(a["items"]), F.lit(0))).alias("items"),
        F.aggregate("__a", F.lit(0), lambda s, a: s + F.when(a["items"].isNull(), 0).otherwise(F.aggregate(a["items"], F.lit(0), lambda z, i: z + F.greatest(size(i["sub_items"]), F.lit(0))))).alias("sub_items"),
        F.array_sort(F.transform("__a", lambda a: F.regexp_extract(a["number"], r"(\d+)", 1).try_cast("int"))).alias("article_numbers"),
    )


def fix_statute(tree: DataFrame) -> DataFrame:
    """Repairs a model's tree: chapters without articles go, items that are paragraphs become such, sub-items that repeat their item go."""
    def article(a: Column) -> Column:
        items = F.coalesce(a["items"], F.array().cast("array<struct<identifier:string,content:string,sub_items:array<struct<identifier:string,content:string>>>>"))
        is_par = lambda i: i["identifier"].rlike(r"(?iuU)^\s*(§|par[aá]grafo)")
        moved = F.transform(F.filter(items, is_par), lambda i: F.struct(i["identifier"].alias("identifier"), i["content"].alias("content")))
        rest = F.transform(F.filter(items, lambda i: ~is_par(i)), lambda i: i.withField("sub_items", F.filter(i["sub_items"], lambda s: F.coalesce(s["content"], F.lit("")) != F.coalesce(i["content"], F.lit("")))))
        old = F.coalesce(a["paragraphs"], F.array().cast("array<struct<identifier:string,content:string>>"))
        return a.withField("paragraphs", F.concat(old, moved)).withField("items", rest)

    kept = F.filter("chapters", lambda c: F.size(c["articles"]) > 0)
    return tree.withColumn("chapters", F.transform(kept, lambda c: c.withField("articles", F.transform(c["articles"], article))))


def repeated_content(elements: DataFrame, keys: list[str], content: str = "content", prefix: int = 100) -> DataFrame:
    """Elements whose first characters occur more than once under a key."""
    head = elements.withColumn("head", F.left(F.col(content), F.lit(prefix))).where("head <> ''")
    return head.groupBy(*keys, "head").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def expected_diff(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Rows on one side only: (keys, side)."""
    a, b = expected.select(*keys).distinct(), found.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("side", F.lit("missing")).unionByName(b.join(a, keys, "left_anti").withColumn("side", F.lit("unexpected")))


def missing_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> list[str]:
    """Required columns that a vector table lacks."""
    return sorted(set(required) - set(df.columns))


def missing_fields(record: Column, required: tuple[str, ...] = REQUIRED_COLUMNS) -> Column:
    """Required fields that a record in JSON lacks, sorted; all of them where it is no object."""
    return F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))))


def reading_checks(matches: DataFrame) -> DataFrame:
    """How two readings of a page agree (document_id, page, text_a, text_b): pairs under 0.5 similar, share of them, whether it stays within a tenth."""
    from ..functions.legal import word_jaccard

    m = matches.withColumn("j", word_jaccard(F.col("text_a"), F.col("text_b")))
    out = m.groupBy("document_id").agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("j") < 0.5).alias("differing"))
    return out.withColumn("share", F.col("differing") / F.col("pairs")).withColumn("ok", F.col("share") <= 0.10)


def element_checks(elements: DataFrame) -> DataFrame:
    """Geometry and order of elements (document_id, element_id, parent_id, depth, page, pos, x0, y0, x1, y1): outside the parent's box, not one deeper than it, a jump of pages."""
    parents = elements.select("document_id", F.col("element_id").alias("parent_id"), *[F.col(c).alias(f"p_{c}") for c in ("depth", "x0", "y0", "x1", "y1")])
    e = elements.join(parents, ["document_id", "parent_id"], "left")
    outside = F.col("p_x0").isNotNull() & ~((F.col("x0") >= F.col("p_x0")) & (F.col("y0") >= F.col("p_y0")) & (F.col("x1") <= F.col("p_x1")) & (F.col("y1") <= F.col("p_y1")))
    jump = F.col("page") - F.lag("page").over(Window.partitionBy("document_id").orderBy("pos")) > 1
    wrong = F.col("p_depth").isNotNull() & (F.col("depth") != F.col("p_depth") + 1)
    return e.select("document_id", "element_id", outside.alias("outside_parent"), wrong.alias("depth_wrong"), F.coalesce(jump, F.lit(False)).alias("page_jump"))


def custody(registry: DataFrame, artifacts: DataFrame, index_rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """What each registered document has in the other stores: artifact with its hash, index rows, graph nodes; complete if all."""
    a = artifacts.groupBy("document_id").agg(F.max("canonical_hash").alias("artifact_hash"))
    i = index_rows.groupBy("document_id").agg(F.count(F.lit(1)).alias("index_rows"))
    n = nodes.groupBy("document_id").agg(F.count(F.lit(1)).alias("nodes"))
    d = registry.join(a, "document_id", "left").join(i, "document_id", "left").join(n, "document_id", "left").na.fill(0, ["index_rows", "nodes"])
    same = F.coalesce(F.col("artifact_hash") == F.col("canonical_hash"), F.lit(False))
    return d.select("document_id", same.alias("hash_matches"), "index_rows", "nodes", (same & (F.col("index_rows") > 0) & (F.col("nodes") > 0)).alias("complete"))
