"""Schemas of the main tables, as DDL. Fixed values."""

BLOCKS = "document_id string, page_number int, block_index int, text string, char_start int, char_end int, bbox array<double>, has_strikethrough boolean, first_flags int"

CHUNKS = (
    "node_id string, chunk_id string, parent_node_id string, span_id string, device_type string, chunk_level string, text string, parent_text string, retrieval_text string, enriched_text string, context_header string, thesis_text string,"
    " thesis_type string, synthetic_questions string, document_id string, tipo_documento string, numero string, ano int, article_number string, colegiado string, processo string, relator string, data_sessao string, unidade_tecnica string,"
    " section_type string, authority_level string, section_path string, dense_vector array<float>, thesis_vector array<float>, sparse_vector map<bigint,float>, citations array<struct<target_node_id:string,rel_type:string,rel_type_confidence:double>>,"
    " schema_version string, aliases string, sparse_source string, canonical_start int, canonical_end int, canonical_hash string, origin_type string, origin_confidence string, origin_reference string, origin_reference_name string,"
    " is_external_material boolean, origin_reason string, page_number int, bbox array<double>, bbox_img array<double>, img_width int, img_height int, confidence double, is_cross_page boolean,"
    " bbox_spans array<struct<page_number:int,bbox_pdf:array<double>,bbox_img:array<double>>>, part_index int, part_total int, is_consolidated boolean, child_node_ids array<string>, child_offsets array<struct<node_id:string,start:int,end:int>>"
)

REGISTRY = (
    "id string, document_id string, version string, tipo_documento string, numero string, ano int, sha256_source string, sha256_canonical string, canonical_hash string, status string, error string, ingest_run_id string, pipeline_version string,"
    " chunk_count int, created_at timestamp, updated_at timestamp"
)

#: A page as a model reads it: devices with their parents and boxes in shares of the page.
PAGE_EXTRACTION = "page_number int, devices array<struct<device_type:string,identifier:string,text:string,parent_identifier:string,bbox:array<double>,confidence:double>>"


def conform(df, ddl: str):
    """A frame with exactly the columns of a schema: missing ones empty ('' , -1 for offsets, false, empty arrays; null for vectors), others cast."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    schema = T._parse_datatype_string(ddl)
    vectors = ("dense_vector", "thesis_vector", "sparse_vector")

    def default(f):
        if f.name in vectors:
            return F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, T.StringType):
            return F.lit("")
        if isinstance(f.dataType, T.IntegerType):
            return F.lit(-1 if f.name in ("canonical_start", "canonical_end") else 0)
        if isinstance(f.dataType, T.DoubleType):
            return F.lit(0.0)
        if isinstance(f.dataType, T.BooleanType):
            return F.lit(False)
        return F.array().cast(f.dataType) if isinstance(f.dataType, T.ArrayType) else F.lit(None).cast(f.dataType)

    return df.select(*[(F.coalesce(F.col(f.name).cast(f.dataType), default(f)) if f.name in df.columns else default(f)).cast(f.dataType).alias(f.name) for f in schema.fields])
