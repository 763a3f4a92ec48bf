"""Inputs on which queries once differed from their SQL, failed or grew too fast."""

import datetime

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexspark import plans
from lexspark.operators import registry, vectors


@pytest.fixture
def agree(spark, tmp_path):
    """Rows of a query on given tables, which must be those of its SQL."""

    def run(name, **tables):
        con = duckdb.connect()
        for n, df in tables.items():
            con.register("df", df)
            con.sql(f"COPY df TO '{tmp_path}/{n}.parquet' (FORMAT parquet)")
            con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{tmp_path}/{n}.parquet'")
        df = plans.QUERIES[name](spark, str(tmp_path))
        rel = con.sql(plans.ORACLES[name])
        cols = sorted(df.columns)
        got = sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect())))
        at = [rel.columns.index(c) for c in cols]
        assert got == sorted(repr(tuple(r[k] for k in at)) for r in rel.fetchall())
        return got

    return run


def test_cuts_at_halves_round_to_even(agree):
    agree("reading_agreement", documents=pd.DataFrame({"doc_id": [5, 7], "text": ["a bcd", "x y z"], "source": ["s", "u"]}))


def test_lifetimes_end_to_the_microsecond(agree, spark):
    at = pd.to_datetime(["2024-01-19 22:00:00.5", "2024-01-19 22:00:00", "2024-01-19 21:59:59.9", "2024-01-20 00:00:00"], format="ISO8601")
    agree("ttl_expiry", events=pd.DataFrame({"user_id": [1, 2, 3, 4], "ts": at.astype("datetime64[us]")}))
    then = datetime.datetime(2024, 1, 1, 0, 0, 0, 900_000)
    runs = [("a", "h", "v", "c", then), ("b", "h", "v", "c", then + datetime.timedelta(days=30, microseconds=1)), ("c", "h", "v", "c", then + datetime.timedelta(days=60, microseconds=1))]
    got = registry.drift(spark.createDataFrame(runs, "document_id string, pdf_hash string, pipeline_version string, canonical_hash string, run_ts timestamp"))
    assert {r.document_id: r.state for r in got.collect()} == {"a": "first_run", "b": "first_run", "c": "deterministic"}


def test_words_that_met_in_30_bits_have_weights_of_their_own(spark):
    df = spark.createDataFrame([("dieeinerberer mit",)], "text string")
    assert vectors.embed(df).select(F.size("sparse_vector")).first()[0] == 2


def test_islands_of_equal_intervals_leave_nothing_to_chance():
    con = duckdb.connect()
    con.sql("CREATE TABLE lineitem AS SELECT i % 5000 AS l_orderkey, CAST(hash(i) % 5 * 7 AS DOUBLE) AS l_quantity, CAST(1 AS INTEGER) AS l_linenumber FROM range(600000) r(i)")
    sums = {con.sql(f"SELECT sum(covered), sum(islands) FROM ({plans.ORACLES['offset_coverage']})").fetchall()[0] for _ in range(6)}
    assert len(sums) == 1


def test_heavy_work_is_dealt_over_all_partitions(spark):
    """One split of few rows is dealt out, and adaptive execution leaves the number as it is."""
    from lexspark.operators import origin

    sf = "/root/testdata/sf0.001"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = plans.QUERIES["overlap_chunks"].__globals__["_rulings"](spark, sf)
    assert docs.rdd.getNumPartitions() == n
    chunks = spark.createDataFrame([(f"D{k}", "Art. 1º x", 0, 9, str(k)) for k in range(400)], "document_id string, text string, canonical_start int, canonical_end int, node_id string")
    scored = origin.scores(chunks, chunks.select("document_id", F.concat("text", F.lit("\n")).alias("canonical_text")))
    assert scored.rdd.getNumPartitions() == n
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_partitions_of_trees_grow_with_the_input(spark, monkeypatch):
    """A document's blocks are sorted once, in as many partitions as the input has shares."""
    from lexspark.operators import ranges, statutes
    from lexspark.plans import statute_queries

    monkeypatch.setattr(ranges, "SHARE", 4096)
    blocks = statute_queries._tree_blocks(spark, "/root/testdata/sf0.001")
    n = ranges.parts(blocks)
    assert n > int(spark.conf.get("spark.sql.shuffle.partitions"))
    tree = statutes.hierarchy(blocks)
    assert tree.rdd.getNumPartitions() == n
    assert tree._jdf.queryExecution().executedPlan().toString().count("+- Sort [") == 1
    linked = statutes.link_children(statutes.dedup_versions(tree.where("accepted")))
    assert linked.rdd.getNumPartitions() == n


def test_orphans_join_their_device_without_a_second_pass(spark):
    """Devices and orphans of a document are read once; a paragraph of the article before is not in force."""
    from lexspark.operators import statutes

    lines = ["Art. 1º Um", "§ 1º do um", "I - do parágrafo", "Art. 2º Dois", "I - do artigo,", "texto solto que continua a frase anterior, sem marca alguma, com mais de uma vírgula, e segue."]
    blocks = spark.createDataFrame([("D", 1, k, x, k * 200, k * 200 + len(x)) for k, x in enumerate(lines)], "document_id string, page_number int, block_index int, text string, char_start int, char_end int")
    tree = statutes.merge_orphans(statutes.hierarchy(statutes.classify(blocks)))
    assert "Join" not in tree._jdf.queryExecution().executedPlan().toString()
    assert {r.span_id: (r.parent_span_id, r.n_merged) for r in tree.collect()} == {"ART-001": (None, 0), "PAR-001-1": ("ART-001", 0), "INC-001-1-I": ("PAR-001-1", 0), "ART-002": (None, 0), "INC-002-I": ("ART-002", 1)}


def test_canonical_form_of_all_blanks(spark):
    """Every white space of Unicode before a line end, against Python; and each step of the form stands once in the plan."""
    import re
    import unicodedata

    from lexspark.functions import text as tx

    blanks = [chr(c) for c in (9, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
    texts = [f"a{x}\nb{x}c{x}{y}\r\n{y}" for x in blanks for y in (" ", "\n")] + ["", None, "\n", " \r\r\n", "\x1c\n", "​\n", "é \n\n\n", "x\r\ry", "\n\nx"]

    def plain(t):
        t = re.sub("\r\n?", "\n", unicodedata.normalize("NFC", t or ""))
        t = re.sub("[" + "".join(b for b in blanks) + "]+(?=\n|\\Z)", "", t).rstrip("\n")
        return t and t + "\n"

    out = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.canonical(F.col("t")).alias("c"))
    assert out._jdf.queryExecution().executedPlan().toString().count("regexp_replace(") == 2
    assert all(r.c == plain(r.t) for r in out.collect())


def test_blocks_of_many_files_leave_together(spark, monkeypatch):
    from lexspark.sources import stores

    monkeypatch.setattr(stores, "_PART", 250)

    def parse(raw):
        if raw == b"!":
            raise ValueError
        return [{"page_number": 1, "block_index": k, "text": x, "bbox": (0, 1.5)} if k else {"block_index": k, "text": x} for k, x in enumerate(raw.decode().split("."))]

    files = spark.createDataFrame([("a", b"x.y.z"), ("b", b"!"), ("c", None), ("d", b"w")], "document_id string, content binary").coalesce(1)
    blocks = stores.parse_pdfs(files, parse)
    assert "MapInArrow" in blocks._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in blocks.orderBy("document_id", "block_index").collect()] == [("a", None, 0, "x", [], 0), ("a", 1, 1, "y", [0.0, 1.5], 0), ("a", 1, 2, "z", [0.0, 1.5], 0), ("d", None, 0, "w", [], 0)]


def test_edges_are_dealt_by_the_input_and_audited_once_written(spark, monkeypatch):
    from lexspark.operators import graph, ranges
    from lexspark.plans import graph_queries

    monkeypatch.setattr(ranges, "SHARE", 8192)
    edges = graph.edges(graph_queries._edges(spark, "/root/testdata/sf0.001"))
    assert edges.rdd.getNumPartitions() == ranges.parts(edges) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [("a", "b", "k"), ("a", "x", "k"), ("a", "x", "gone"), (None, "b", "k"), ("b", "b", "k")]
    table = spark.createDataFrame(rows, "source_node_id string, target_node_id string, source_chunk_id string")
    got = graph.audit(table, spark.createDataFrame([("a",), ("b",), ("b",)], "node_id string"), spark.createDataFrame([("k",)], "chunk_id string")).first()
    assert got.asDict() == {"nodes": 3, "edges": 5, "self_loops": 1, "dangling_edges": 2, "edges_without_chunk": 1}


def test_nearest_by_blocks_is_that_of_all_pairs(spark, monkeypatch):
    """Copies, null and uneven vectors, ties of rounded cosines and a group of many blocks, against every pair."""
    import random

    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = random.Random(3)
    rows = [(k, [rng.choice([-1.0, 0.5, 2.0]) for _ in range(3)], k % 3 % 2) for k in range(120)] + [(200, None, 0), (201, [1.0, None, 2.0], 1), (202, [1.0], 0), (203, [0.0, 0.0, 0.0], 1), (204, [1.0, 1.0, 1.0], None)]
    e = spark.createDataFrame(rows, "pos int, vector array<float>, label int")
    q = e.where("pos % 10 = 0 or pos > 199").select(F.col("pos").alias("query_id"), F.col("vector").alias("query_vector"), "label")
    near = vectors.nearest(q, e, "label", 4).select("query_id", "pos", F.round("cosine", 6).alias("score"))
    every = e.join(q, "label").where("pos <> query_id").select("query_id", "pos", F.round(vectors.cosine(F.col("query_vector"), F.col("vector")), 6).alias("score"))
    rows_of = lambda df: sorted((r.query_id, r["rank"], r.pos, r.score) for r in vectors.rerank(df, 4).collect())
    assert rows_of(near) == rows_of(every)
    assert near.count() < every.count()


def _odd_answers():
    """A page in the schema's kinds and, one change at a time, in others; whole, fenced, behind thoughts and amid words."""
    device = {"device_type": '"article"', "identifier": '"Art. 1"', "text": '"x {y} [z] \\"q\\" \\\\"', "parent_identifier": '""', "bbox": "[0.01, 0.02, 0.5, 1.0]", "confidence": "0.9"}
    values = ["2", "2.0", "2.50", "-0.0", "-0", "1e2", "1E400", "3000000000", "1" * 25, "0." + "1" * 45, '"5"', '"NaN"', "NaN", "null", "true", "[]", "{}", '{"b":1.10,"a":"\\u00e9"}', "[0.5, null]", "[0, 0.5]", '[0.1, "0.2"]', "[[1], 2]", '"\\ud83d\\ude00 \\ud800"', "'q'", '"a\nb"', "01", "xyz"]
    write = lambda d: "{" + ", ".join(f'"{k}": {v}' for k, v in d.items()) + "}"
    page = lambda *ds, n="3": f'{{"page_number": {n}, "devices": [{", ".join(ds)}]}}'
    good = write(device)
    pages = [page(), page(good), page(good, good), page(good, n="2.0"), page(good, "null"), f"[{page(good)}, {page()}]", f'{{"devices": [{good}]}}', '{"page_number": 1, "devices": null}', '{"page_number": 1}', page(good)[:-1], page(good).replace('"text"', '"more": [1], "text"'), page(good).replace('"text"', '"text": "y", "text"'), page(good).replace('"identifier"', '"Identifier"')]
    pages += [page(good, n=v) for v in values] + [page(write(device | {k: v})) for k in device for v in values] + [page(good, write({c: v for c, v in device.items() if c != k})) for k in device]
    plain = [page(), page(good), page(good, good)]
    around = ["{}", "```json\n{}\n```", "``` {} ```  \n", "<think>{{so}}</think>\n```json\n{}\n```", "Here: {} and {{more}}", "{} <think>never closed", "{}\n\n", "<thi<think>a</think>nk>{}"]
    return plain, pages, [a.format(p) for p in pages for a in around] + ["", None, "no answer", "null", "{", "}{", "[1]", "{}", "```", "```{}```````", "﻿{}", "true {}"]


def _salvaged_before(text):
    """What salvage_json was: every candidate parsed, whatever it begins with."""
    bare = F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(text, r"(?s)<think>.*?</think>\s*", ""), r"(?s)<think>.*\z", "")), r"^\s*```(?:json)?\s*", "")
    bare = F.trim(F.regexp_replace(bare, r"\s*```\s*\z", ""))
    return F.coalesce(*[F.to_json(F.try_parse_json(F.nullif(t, F.lit("")))) for t in (bare, F.regexp_extract(bare, r"(?s)\{.*\}", 0), F.regexp_extract(bare, r"(?s)\[.*\]", 0))])


def test_pages_read_as_they_stand_are_those_of_their_variants(spark):
    from lexspark.functions import legal
    from lexspark.functions import text as tx
    from lexspark.schemas import PAGE_EXTRACTION
    from lexspark.sources import stores

    answers = _odd_answers()[2]
    a = spark.createDataFrame([(str(k), x) for k, x in enumerate(answers)], "document_id string, answer string")
    differ = a.select("answer", tx.salvage_json(F.col("answer")).alias("now"), _salvaged_before(F.col("answer")).alias("before")).where("not now <=> before")
    assert differ.collect() == []
    p = a.select("document_id", F.from_json(_salvaged_before(F.col("answer")), PAGE_EXTRACTION).alias("p")).select("document_id", "p.page_number", F.inline("p.devices"))
    want = p.withColumn("bbox", legal.scale_bbox(F.col("bbox"), F.lit(1000.0), F.lit(2000.0)))
    rows = lambda df: sorted(map(repr, df.collect()))
    got = rows(stores.structured_pages(a, 1000.0, 2000.0))
    assert got == rows(want) and len(got) > len(answers) / 2


def test_pages_of_the_schema_are_not_written_anew(spark, monkeypatch):
    """With no way to write JSON, pages of the schema's kinds still have their devices, and others none."""
    from lexspark.sources import stores

    plain, pages, _ = _odd_answers()
    a = spark.createDataFrame([("plain", x) for x in plain] + [("odd", pages[3])], "document_id string, answer string")
    monkeypatch.setattr(F, "to_json", lambda c: F.lit(None).cast("string"))
    assert [r.document_id for r in stores.structured_pages(a, 1.0, 1.0).collect()] == ["plain"] * 3


def test_structured_page_devices_is_dealt_once_by_the_input(spark, monkeypatch):
    from lexspark.operators import ranges
    from lexspark.plans import QUERIES

    monkeypatch.setattr(ranges, "SHARE", 8192)
    out = QUERIES["structured_page_devices"](spark, "/root/testdata/sf0.001")
    n = ranges.parts(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and out.rdd.getNumPartitions() == n > int(spark.conf.get("spark.sql.shuffle.partitions"))
