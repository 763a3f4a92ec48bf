"""Stores as tables and folders: artifacts, offset maps, index rows, upserts, HTML and PDF adapters."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import legal

#: Bytes of blocks that leave a worker at once.
_PART = 1 << 20
FORMATS = ("parquet", "json", "orc", "csv", "text")


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options) -> DataFrame:
    """A table of any format that Spark reads; a schema spares an inference pass."""
    r = spark.read.format(fmt).options(**options)
    return (r.schema(schema) if schema else r).load(path)


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", by: list[str] | None = None) -> None:
    """Write a table, one folder for each value of ``by``; Spark's commit makes retries of tasks safe."""
    w = df.write.format(fmt).mode(mode)
    (w.partitionBy(*by) if by else w).save(path)


def files(spark: SparkSession, path: str, pattern: str | None = None, content: bool = True) -> DataFrame:
    """Objects under a path: path, length, modificationTime and, unless only their state is asked for, content."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    df = (r.option("pathGlobFilter", pattern) if pattern else r).load(path)
    return df if content else df.drop("content")


def object_key(document_id, version, name):
    """Key of a document's object: documents/{id}/{version}/{name}."""
    return F.concat_ws("/", F.lit("documents"), document_id, version, name)


def parse_pdfs(pdfs: DataFrame, parse: Callable[[bytes], list[dict]]) -> DataFrame:
    """Blocks of PDF files by an injected parser (bytes -> rows of page_number, block_index, text, bbox, first_flags).

    A file that does not parse gives no blocks. Canonical text and offsets follow in ``assemble``.
    """
    kinds = {"document_id": pa.string(), "page_number": pa.int32(), "block_index": pa.int32(), "text": pa.string(), "bbox": pa.list_(pa.float64()), "first_flags": pa.int32()}
    schema = "document_id string, page_number int, block_index int, text string, bbox array<double>, first_flags int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {c: [] for c in kinds}
        size = 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(v, kinds[c]) for c, v in out.items()], list(kinds))
        for b in batches:
            for i, raw in zip(*b.columns, strict=True):
                own = {"document_id": i.as_py(), "bbox": [], "first_flags": 0}
                try:
                    rows = parse(raw.as_py())
                except Exception:  # one bad file must not stop the batch
                    rows = []
                for r in rows:
                    for c, v in out.items():
                        v.append(r[c] if c in r else own.get(c))
                    size += 100 + len(r.get("text") or "")
                    if size >= _PART:
                        yield batch()
                        out, size = {c: [] for c in kinds}, 0
        yield batch()

    return pdfs.select("document_id", "content").mapInArrow(run, schema)


def assemble(blocks: DataFrame) -> DataFrame:
    """Blocks with offsets in reading order (page, top, left, index): texts joined by a line feed make the canonical text."""
    from pyspark.sql.window import Window

    top = F.coalesce(F.try_element_at("bbox", F.lit(2)), F.lit(0.0))
    left = F.coalesce(F.try_element_at("bbox", F.lit(1)), F.lit(0.0))
    clean = blocks.withColumn("text", F.regexp_replace("text", r"(?U)[\s&&[^\n]]+(?=\n|\z)", "")).where("text <> ''")
    w = Window.partitionBy("document_id").orderBy("page_number", top, left, "block_index").rowsBetween(Window.unboundedPreceding, -1)
    out = clean.withColumn("char_start", F.coalesce(F.sum(F.length("text") + 1).over(w), F.lit(0)).cast("int"))
    return out.withColumn("char_end", (F.col("char_start") + F.length("text")).cast("int"))


def transcribe(pages: DataFrame, client: Callable[[list[bytes]], list[str]]) -> DataFrame:
    """Texts of page images by an injected client; a page that fails is empty."""

    @F.pandas_udf("string")
    def run(images: pd.Series) -> pd.Series:
        out = []
        for raw in images:
            try:
                out.append(client([raw])[0])
            except Exception:  # the page is empty, the document goes on
                out.append("")
        return pd.Series(out)

    return pages.withColumn("text", run("image_png"))


#: The kinds of a page that follows its schema, keys in order, as a variant tells them.
_NUMBER = r"(?:BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE)"
_KINDS = {"bbox": f"ARRAY<{_NUMBER}>", "confidence": _NUMBER, "device_type": "STRING", "identifier": "STRING", "parent_identifier": "STRING", "text": "STRING"}
PLAIN_PAGE = rf"^OBJECT<devices: ARRAY<OBJECT<{', '.join(f'{k}: {v}' for k, v in _KINDS.items())}>>, page_number: BIGINT>$"


def structured_pages(answers: DataFrame, width: float, height: float) -> DataFrame:
    """Devices of pages that a model read as JSON (document_id, answer), boxes in points; an answer that holds no JSON has none.

    An answer whose values are of the schema's kinds is read as it stands. Any other is written anew from its variant first,
    with numbers in one form, which takes longer than all the rest.
    """
    from ..functions import text as tx
    from ..schemas import PAGE_EXTRACTION

    bare = answers.select("document_id", tx.unfenced(F.when(F.col("answer").contains("{"), F.col("answer"))).alias("bare"))
    whole = bare.withColumn("whole", tx.parsed_json(F.col("bare")))
    plain = F.schema_of_variant("whole").rlike(PLAIN_PAGE) & ~F.col("bare").contains("-0")  # a variant knows no negative zero
    anew = F.coalesce(*[F.to_json(v) for v in (F.col("whole"), *tx.embedded_json(F.col("bare")))])
    page = F.when(plain, F.from_json("bare", PAGE_EXTRACTION)).otherwise(F.from_json(anew, PAGE_EXTRACTION))
    d = whole.select("document_id", page.alias("p")).select("document_id", F.col("p.page_number").alias("page_number"), F.inline("p.devices"))
    return d.withColumn("bbox", legal.scale_bbox(F.col("bbox"), F.lit(width), F.lit(height)))


def pages_with_blocks(page_table: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pages with their blocks in order; a page without blocks has an empty list."""
    b = blocks.groupBy("document_id", "page_number").agg(F.sort_array(F.collect_list(F.struct("block_index", "text", "char_start", "char_end"))).alias("blocks"))
    out = page_table.join(b, ["document_id", "page_number"], "left")
    kind = b.schema["blocks"].dataType
    return out.withColumn("blocks", F.coalesce("blocks", F.array().cast(kind)))


#: Elements that end a paragraph where they begin or end, and named characters.
HTML_BLOCKS = "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section table tbody td tfoot th thead tr ul".split()
HTML_NAMED = {
    "quot": 34, "apos": 39, "lt": 60, "gt": 62, "nbsp": 160, "iexcl": 161, "cent": 162, "pound": 163, "sect": 167, "copy": 169, "ordf": 170, "laquo": 171, "reg": 174, "deg": 176, "middot": 183, "ordm": 186, "raquo": 187,
    "ndash": 8211, "mdash": 8212, "lsquo": 8216, "rsquo": 8217, "ldquo": 8220, "rdquo": 8221, "bull": 8226, "hellip": 8230, "euro": 8364, "trade": 8482,
}
_TAG_REST = r"""(?:[^>"']|"[^"]*+"|'[^']*+')*+>?"""


def _character(code: Column) -> Column:
    """The character of a number; the replacement character if there is none."""
    none = code.isNull() | (code <= 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(none, 0xFFFD).otherwise(code)), 8, "0")), "UTF-32")


def unescaped(text: Column) -> Column:
    """A text of HTML with its named and numbered characters as themselves, each read once."""
    parts = F.split(text, "&", -1)

    def one(part: Column, k: Column) -> Column:
        name = F.regexp_extract(part, r"^(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z]+);", 1)
        rest = F.substring(part, F.length(name) + 2, F.length(part))
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10)).otherwise(F.substring(name, F.lit(2), F.length(name))).try_cast("int")
        known = F.try_element_at(F.create_map(*[F.lit(x) for n, c in (HTML_NAMED | {"amp": 38}).items() for x in (n, chr(c))]), name)
        read = F.when(name == "", F.concat(F.lit("&"), part)).when(name.startswith("#"), F.concat(_character(number), rest)).when(known.isNotNull(), F.concat(known, rest)).otherwise(F.concat(F.lit("&"), part))
        return F.when(k == 0, part).otherwise(read)

    return F.when(text.contains("&"), F.array_join(F.transform(parts, one), "")).otherwise(text)


def html_blocks(html_pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Text of paragraphs and headings of HTML pages in order, whole: a native scan without a parser.

    A paragraph reaches to its end tag or to where another block begins or ends; elements within it
    leave their text, a line break is a blank, characters written by name or number are themselves.
    Text outside of paragraphs and headings is left out, as are comments, scripts and styles.
    """
    bare = F.regexp_replace(html_col, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "")
    pieces = F.split(bare, rf"(?i)<(?=/?(?:{'|'.join(HTML_BLOCKS)})(?![A-Za-z0-9]))", -1)
    found = F.filter(pieces, lambda x: x.rlike(r"^(?i)(?:p|h[1-6])(?![A-Za-z0-9])"))
    each = html_pages.select(F.col(id_col).alias("document_id"), F.posexplode(found).alias("block_index", "text"))
    text = F.regexp_replace(F.col("text"), f"^[A-Za-z0-9]+{_TAG_REST}", "")
    text = F.regexp_replace(F.regexp_replace(text, rf"(?i)<br(?![A-Za-z0-9]){_TAG_REST}", " "), f"</?[A-Za-z]{_TAG_REST}", "")
    text = F.trim(F.regexp_replace(unescaped(text), r"\s+", " "))
    return each.select("document_id", "block_index", text.alias("text")).where("text <> ''")


def offsets_map(chunks: DataFrame) -> DataFrame:
    """(document_id, offsets): span ids to their start and end; spans without real offsets are left out."""
    ok = chunks.where((F.col("canonical_start") >= 0) & (F.col("canonical_end") > F.col("canonical_start")))
    one = ok.groupBy("document_id", "span_id").agg(F.min(F.struct(F.col("canonical_start").alias("start"), F.col("canonical_end").alias("end"))).alias("v"))
    return one.groupBy("document_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("span_id", "v")))).alias("offsets"))


def artifacts(chunks: DataFrame, canonical: DataFrame) -> DataFrame:
    """What a document's artifacts hold: canonical text, its hash, offsets as JSON."""
    o = offsets_map(chunks).select("document_id", F.to_json("offsets").alias("offsets_json"))
    return canonical.join(o, "document_id", "left").select("document_id", "canonical_text", F.sha2("canonical_text", 256).alias("canonical_hash"), F.coalesce("offsets_json", F.lit("{}")).alias("offsets_json"))


#: Further columns of an index row and what stands where a chunk has none.
_INDEX_DEFAULTS = {
    "tipo_documento": "", "numero": "", "ano": 0, "part_index": 0, "part_total": 1, "ingest_run_id": "", "aliases": "[]", "origin_type": "self", "origin_reference": "", "origin_reference_name": "",
    "is_external_material": False, "origin_confidence": "high", "origin_reason": "",
}


def index_rows(chunks: DataFrame) -> DataFrame:
    """Rows of a vector index: '@P00' ids, boxes as scalars, citations as JSON, defaults instead of nulls."""
    box = lambda k: F.coalesce(F.try_element_at("bbox", F.lit(k)), F.lit(0.0))
    has = lambda c: c in chunks.columns
    cites = F.col("citations") if has("citations") else F.array().cast("array<struct<target_node_id:string,rel_type:string,rel_type_confidence:double>>")
    part = F.format_string("@P%02d", F.coalesce(F.col("part_index"), F.lit(0))) if has("part_index") else F.lit("@P00")
    return chunks.select(
        F.concat("node_id", part).alias("node_id"), F.col("node_id").alias("logical_node_id"), F.concat("chunk_id", part).alias("chunk_id"), F.coalesce("parent_node_id", F.lit("")).alias("parent_node_id"),
        "document_id", "span_id", legal.device_type(F.col("device_type")).alias("device_type"), F.coalesce("chunk_level", F.lit("")).alias("chunk_level"), "text", F.coalesce("retrieval_text", F.col("text")).alias("retrieval_text"),
        F.coalesce("article_number", F.lit("")).alias("article_number"), legal.article_number_int(F.col("article_number")).alias("article_number_int"), F.coalesce("canonical_start", F.lit(-1)).alias("canonical_start"),
        F.coalesce("canonical_end", F.lit(-1)).alias("canonical_end"), F.coalesce("canonical_hash", F.lit("")).alias("canonical_hash"), box(1).alias("bbox_x0"), box(2).alias("bbox_y0"), box(3).alias("bbox_x1"), box(4).alias("bbox_y1"),
        F.to_json(cites).alias("citations"), (F.size(cites) > 0).alias("has_citations"), F.size(cites).alias("citations_count"), F.coalesce("page_number", F.lit(0)).alias("page_number"),
        *[F.coalesce(F.col(c), F.lit(v)).alias(c) if has(c) else F.lit(v).alias(c) for c, v in _INDEX_DEFAULTS.items()],
    )


class Conflict(RuntimeError):
    """Another writer has committed the version in the meantime: read the table again and retry."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def put(spark: SparkSession, path: str, data: bytes, overwrite: bool = True) -> None:
    """Write one object of any file system that Spark reaches."""
    fs, p = _fs(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def get(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.format("binaryFile").load(path).first()["content"])


def stat(spark: SparkSession, path: str) -> dict | None:
    """Length and time of an object; None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    s = fs.getFileStatus(p)
    return {"length": s.getLen(), "modified": s.getModificationTime() / 1000}


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def newest(spark: SparkSession, path: str) -> int:
    """Number of a table's newest version, 0 if it has none."""
    return max(_versions(spark, path), default=0)


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, p = _fs(spark, f"{path}/log")
    return sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(p) if s.getPath().getName().endswith(".json")) if fs.exists(p) else []


def commit(spark: SparkSession, path: str, version: int, state: dict) -> None:
    """Make a version by creating its log file, which fails if there is one: of two writers one commits."""
    try:
        put(spark, f"{path}/log/{version:020d}.json", json.dumps(state).encode(), overwrite=False)
    except Exception as e:
        if "Exist" in str(e):
            raise Conflict(f"version {version} of {path}") from e
        raise


def _state(spark: SparkSession, path: str) -> dict:
    n = newest(spark, path)
    return json.loads(get(spark, f"{path}/log/{n:020d}.json")) if n else {}


def table_rows(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a table that ``replace_rows`` keeps."""
    state = _state(spark, path)
    return spark.read.schema(state["schema"]).parquet(*[f"{path}/{f}" for f in sorted(set(state["buckets"].values()))])


def replace_rows(spark: SparkSession, new: DataFrame, path: str, keys: list[str], at: str, buckets: int = 64, keep: int = 8) -> DataFrame:
    """Upsert into a Parquet table by keys; returns the table as it is then. New rows replace old ones of their key, the latest ``at`` of several new ones.

    Rows lie in ``buckets`` by a hash of their keys (fixed with the first version), each a folder. Only buckets that new
    rows fall into are merged and written anew; a version is a log file that names the folder of each bucket, created
    last and only if no other writer made it, so a lost job or a lost race (``Conflict``) changes nothing. Folders that
    none of the last ``keep`` versions names are deleted.
    """
    from ..operators.registry import upsert

    version, state = newest(spark, path), _state(spark, path)
    buckets, at_now = state.get("count", buckets), state.get("buckets", {})
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    touched = [r["b"] for r in new.select(bucket.alias("b")).distinct().collect()]  # at most the number of buckets
    old = [f"{path}/{at_now[str(b)]}" for b in touched if str(b) in at_now]
    merged = upsert(spark.read.schema(new.schema).parquet(*old) if old else new.limit(0), new, keys, at)
    run = uuid.uuid4().hex
    merged.withColumn("__bucket", bucket).repartition("__bucket").write.partitionBy("__bucket").parquet(f"{path}/data/{run}")
    state = {"count": buckets, "schema": state.get("schema") or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema), "buckets": at_now | {str(b): f"data/{run}/__bucket={b}" for b in touched}}
    commit(spark, path, version + 1, state)
    _forget(spark, path, keep)
    return table_rows(spark, path)


def _forget(spark: SparkSession, path: str, keep: int) -> None:
    """Drop old versions and the bucket folders that only they name."""
    versions = _versions(spark, path)
    named = lambda vs: {f for v in vs for f in json.loads(get(spark, f"{path}/log/{v:020d}.json"))["buckets"].values()}
    gone = versions[:-keep]
    if gone:
        for f in named(gone) - named(versions[-keep:]):
            delete(spark, f"{path}/{f}")
        for v in gone:
            delete(spark, f"{path}/log/{v:020d}.json")
