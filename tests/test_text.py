import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexspark.functions import legal, rules
from lexspark.functions import text as tx

ODD = [None, "", "\n", "a", "a \r\nb\t\r c  \n\n\n", "é  \n", "x \ny", "ﬁm º … “q”", "que-\n  bra", "­​", "   "]


def _canonical(t):
    if not t:
        return ""
    t = unicodedata.normalize("NFC", t).replace("\r\n", "\n").replace("\r", "\n")
    t = "\n".join(x.rstrip() for x in t.split("\n")).rstrip("\n")
    return t + "\n" if t else ""


def test_canonical_text(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string")
    got = df.select(tx.canonical(F.col("t")).alias("c")).collect()
    assert [r.c for r in got] == [_canonical(t) for t in ODD]
    again = df.select(tx.canonical(F.col("t")).alias("t")).select(tx.is_canonical(F.col("t")).alias("ok")).collect()
    assert all(r.ok for r in again)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aé́ \t\n\r-.º", max_size=12), min_size=1, max_size=60))
def test_canonical_text_of_any_lines(spark, texts):
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(tx.canonical(F.col("t")).alias("c")).collect()
    assert [r.c for r in got] == [_canonical(t) for t in texts]


def test_matching_form_and_offsets(spark):
    df = spark.createDataFrame([("ﬁm – «Ação» nº 5…",), ("que-\n  bra  de\nlinha",), ("­",), (None,)], "t string")
    got = [r.m for r in df.select(tx.matching(F.col("t")).alias("m")).collect()]
    assert got == ['fim - "Ação" no 5...', "quebra de linha", "", ""]
    rows = df.select("t", tx.matching_with_offsets(F.col("t")).alias("m")).collect()
    assert [r.m.norm for r in rows] == got
    assert rows[0].m.source[:4] == [0, 0, 1, 2] and rows[1].m.source[:4] == [0, 1, 2, 7]


def test_model_output(spark):
    df = spark.createDataFrame([('<think>a</think>\n```json\n{"a": 1}\n```',), ('see {"a": [1, 2]} ok',), ("[1, 2] tail",), ("none",), ("x <think>open",)], "t string")
    r = df.select(tx.salvage_json(F.col("t")).alias("j"), tx.strip_thinking(F.col("t")).alias("s")).collect()
    assert [x.j for x in r] == ['{"a":1}', '{"a":[1,2]}', "[1,2]", None, None] and r[4].s == "x"


def test_document_ids(spark):
    cases = {"LEI 14133/2021": "LEI-14.133-2021", "lei-14.133-2021": "LEI-14.133-2021", "Lei no 14.133": "LEI-14.133", "IN-58-2022": "IN-58-2022", "DECRETO-10947-2022": "DECRETO-10.947-2022", "LEI-8666": "LEI-8666", "": "", "  ": "", "LC 101": "LC-101", "DL-1234567-1990": "DL-1.234.567-1990"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert [r.d for r in df.select(legal.document_id(F.col("t")).alias("d")).collect()] == list(cases.values())
    nodes = {"leis:LEI-14133-2021#ART-018": "leis:LEI-14.133-2021#ART-018", "LEIS:lei-14.133-2021#art-018": "leis:LEI-14.133-2021#ART-018", "x": "x", "": ""}
    df = spark.createDataFrame([(k,) for k in nodes], "t string")
    assert [r.d for r in df.select(legal.node_id(F.col("t")).alias("d")).collect()] == list(nodes.values())


def test_roman_numerals_and_child_order(spark):
    rows = [(rules.roman(n), n) for n in range(1, 81)] + [("MCMXC", 1990), ("abc", 9999), ("", 9999), ("iv", 4)]
    got = spark.createDataFrame(rows, "t string, n int").select(legal.roman_to_int(F.col("t")).alias("v"), "n").collect()
    assert all(r.v == r.n for r in got)
    spans = ["INC-005-I", "INC-005-II", "INC-005-IX", "INC-005-1-X", "ALI-005-I-a", "ALI-005-1-I-b", "PAR-005-UNICO", "PAR-005-1", "PAR-005-10"]
    got = spark.createDataFrame([(s,) for s in reversed(spans)], "s string").orderBy(legal.child_order(F.col("s"))).collect()
    assert [r.s for r in got] == spans


def test_relation_types(spark):
    cases = {"Ficam revogados os arts.": ("REVOGA_EXPRESSAMENTE", 0.95), "passa a vigorar com a seguinte REDAÇÃO": ("ALTERA_EXPRESSAMENTE", 0.95), "Regulamenta a Lei": ("REGULAMENTA", 0.9), "salvo o disposto no": ("EXCEPCIONA", 0.92), "nos termos do art. 3": ("DEPENDE_DE", 0.85), "vide art. 2": ("REFERENCIA", 0.75), "a Lei": ("CITA", 0.5), "": ("CITA", 0.0)}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = df.select(legal.rel_type(F.col("t")).alias("r")).collect()
    assert [tuple(x.r) for x in got] == list(cases.values())


def test_boxes_and_tiers(spark):
    df = spark.createDataFrame([([0.0, 0.0, 2.0, 2.0], [1.0, 1.0, 3.0, 3.0], 0.8), ([0.0, 0.0, 1.0, 1.0], [2.0, 2.0, 3.0, 3.0], 0.5)], "a array<double>, b array<double>, s double")
    got = df.select(F.round(legal.bbox_iou(F.col("a"), F.col("b")), 4).alias("i"), legal.confidence_tier(F.col("s")).alias("t"), legal.valid_bbox(F.col("a"), F.lit(1.5), F.lit(9.0)).alias("v"))
    assert [tuple(r) for r in got.collect()] == [(0.1429, "HIGH", True), (0.0, "MEDIUM", True)]


def test_offsets_of_the_matching_form_are_a_few_bytes_a_character_and_answered_in_parts(spark, monkeypatch):
    import numpy as np
    import pandas as pd

    form, at = tx.matching_form("«Ação»  que-\n bra…" * 100)
    assert isinstance(at, np.ndarray) and at.itemsize == 4 and len(at) == len(form)
    monkeypatch.setattr(tx, "_PART", 10)
    parts = list(tx.matching_with_offsets.func(iter([pd.Series(["abcdef"] * 5 + [None])])))
    assert [len(p) for p in parts] == [2, 2, 2] and [x for p in parts for x in p["norm"]] == ["abcdef"] * 5 + [""]


def test_normal_form_of_a_batch_in_parts(spark, monkeypatch):
    """Long batches leave in parts, in order, nulls and empty texts with them."""
    import pandas as pd
    from pyspark.sql import functions as F

    from lexspark.functions import text as tx

    texts = ["é", None, "", "abc" * 9, "ñ" * 5, "z"] * 4
    part = tx._PART
    tx._PART = 7
    try:
        assert len(list(tx._normal("NFC").func(iter([pd.Series(["abcd", "efgh", "ijkl", "mnop"])])))) == 2
        got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").coalesce(1).select("k", tx.nfc(F.col("t")).alias("n")).orderBy("k").collect()
    finally:
        tx._PART = part
    import unicodedata

    assert [r.n for r in got] == [t and unicodedata.normalize("NFC", t) for t in texts]
