import pytest
from pyspark.sql import functions as F

from lexspark.operators import consolidation, offsets, origin, quality, statutes

LAW = [
    "LEI Nº 1, DE 2020", "Dispõe sobre testes.", "O PRESIDENTE DA REPÚBLICA", "CAPÍTULO I", "Art. 1º O teste deve, conforme", "continuar na página seguinte, que segue adiante, com mais texto.", "I - primeiro;", "a) letra a;", "II – segundo.",
    "§ 1º Parágrafo primeiro.", "I - inciso do parágrafo;", "Parágrafo único. Não conta.", "Art. 2-A Sufixo vale.", "Art. 1º Versão nova. (Vigência encerrada)", "12/34", "Art. 5 ......... 3",
]


def _blocks(spark, lines, gap=0):
    rows, at = [], 0
    for k, x in enumerate(lines):
        rows.append(("D", 1, k, x, at, at + len(x)))
        at += len(x) + 1 + gap
    return spark.createDataFrame(rows, "document_id string, page_number int, block_index int, text string, char_start int, char_end int")


def test_devices_of_a_statute(spark):
    got = {r.span_id: r for r in statutes.devices(_blocks(spark, LAW)).collect()}
    assert set(got) == {"ART-001", "INC-001-I", "ALI-001-I-a", "INC-001-II", "PAR-001-1", "INC-001-1-I", "PAR-001-0", "ART-002-A"}
    assert got["ART-001"].text.endswith("com mais texto.") and got["ART-001"].n_merged == 1  # the version in force, with its orphan
    assert got["ALI-001-I-a"].parent_span_id == "INC-001-I" and got["INC-001-1-I"].parent_span_id == "PAR-001-1"
    assert got["ART-001"].children_span_ids == ["INC-001-I", "INC-001-II", "PAR-001-0", "PAR-001-1"]
    assert got["ART-001"].char_end - got["ART-001"].char_start == len(LAW[4])


@pytest.mark.parametrize("gap, merged", [(1500, 1), (1501, 0)])
def test_orphans_merge_by_gap(spark, gap, merged):
    rows = [("D", 1, 0, "Art. 1º Fim.", 0, 12), ("D", 1, 1, "continuação solta, sem marca, e mais, do texto acima de tudo isso.", 12 + gap, 100 + gap)]
    b = spark.createDataFrame(rows, "document_id string, page_number int, block_index int, text string, char_start int, char_end int")
    assert statutes.devices(b).first().n_merged == merged


def test_orphans_merge_into_open_sentences_whatever_the_gap(spark):
    far = 9000
    rows = [("D", 1, 0, "Art. 1º O texto que", 0, 19), ("D", 1, 1, "segue adiante, com vírgulas, e termina em a", far, far + 40), ("D", 1, 2, "segunda continuação, ainda longe, também, vale muito.", 2 * far, 2 * far + 40), ("D", 1, 3, "terceira, depois do ponto, já não, de forma alguma.", 3 * far, 3 * far + 40)]
    b = spark.createDataFrame(rows, "document_id string, page_number int, block_index int, text string, char_start int, char_end int")
    assert statutes.devices(b).first().n_merged == 2


def test_all_revoked_keeps_the_last(spark):
    b = _blocks(spark, ["Art. 7º Velha.", "Art. 7º Nova."]).withColumn("has_strikethrough", F.lit(True))
    assert [r.text for r in statutes.devices(b).collect()] == ["Art. 7º Nova."]


def test_browser_headers(spark):
    head = "01/02/2024, 10:30 L14133\nhttps://exemplo.gov.br/x\n3/90\n"
    b = _blocks(spark, [head + "Art. 9º Texto que vem depois do cabeçalho.", head + "curto demais"])
    got = statutes.split_headers(b).orderBy("char_start", "block_index").collect()
    assert [r.block_index for r in got] == [0, 10000, 1]
    assert got[1].text.startswith("Art. 9º") and got[1].char_start == len(head)


def test_pages_to_blocks_keep_offsets(spark):
    pages = spark.createDataFrame([("D", 1, "Art. 1º Um.  \nI - a;\n\nsolto"), ("D", 2, ""), ("D", 3, "mais\n§ 1º Dois.")], "document_id string, page_number int, text string")
    text = statutes.canonical_of_pages(pages).first().canonical_text
    got = statutes.split_pages(pages).orderBy("block_index").collect()
    assert [r.text for r in got] == ["Art. 1º Um.", "I - a;", "solto\nmais", "§ 1º Dois."]
    assert all(text[r.char_start : r.char_end] == r.text for r in got) and [r.page_number for r in got] == [1, 1, 1, 3]


def test_consolidation_splits_between_children():
    assert consolidation.split(10, [100, 100]) == [(0, 2)]
    parts = consolidation.split(500, [600, 600, 600, 600])
    assert parts == [(0, 2), (1, 3), (2, 4)] and all(500 + sum(601 for _ in range(a, b)) <= 2000 for a, b in parts)
    assert consolidation.split(10, [5000, 5000])[-1][1] == 2


def test_consolidated_rows(spark):
    t = "x" * 900
    rows = [("leis:D#ART-001", "", "ART-001", "article", "D", "caput"), *[(f"leis:D#INC-001-{r}", "leis:D#ART-001", f"INC-001-{r}", "inciso", "D", r + t) for r in ("X", "II", "I")]]
    c = spark.createDataFrame(rows, "node_id string, parent_node_id string, span_id string, device_type string, document_id string, text string")
    got = consolidation.consolidate(c).orderBy("part_index").collect()
    assert [r.node_id for r in got] == ["leis:D#ART-001@FULL-P1", "leis:D#ART-001@FULL-P2"]
    assert [x.split("-")[-1] for x in got[0].child_node_ids] == ["I", "II"] and [x.split("-")[-1] for x in got[1].child_node_ids] == ["II", "X"]
    assert all(r.text[o.start : o.end].startswith(o.node_id.split("-")[-1] + "x") for r in got for o in r.child_offsets)
    assert got[0].canonical_start == -1


def test_resolved_offsets_and_reasons(spark):
    canon = "Art. 1 IV - um V - dois a) x a) x fim"
    cases = [(0, len(canon), "V - dois", 15, None), (0, len(canon), "nada", None, "NOT_FOUND"), (0, len(canon), "a) x", None, "AMBIGUOUS_MULTIPLE_MATCHES"), (5, 5, "a", None, "INVALID_PARENT_RANGE"), (0, 9, "  ", None, "EMPTY_TEXT"), (0, len(canon), "IV -  um", None, "NOT_FOUND_WHITESPACE_MISMATCH"), (0, len(canon), "Art. 1", 0, None), (0, 14, "V - um", None, "NOT_FOUND_WHITESPACE_MISMATCH")]
    df = spark.createDataFrame([(k, canon, a, b, t) for k, (a, b, t, *_) in enumerate(cases)], "k int, canonical_text string, parent_start int, parent_end int, chunk_text string")
    got = offsets.resolve(df).orderBy("k").collect()
    assert [(r.start, r.reason) for r in got] == [(s, w) for *_, s, w in cases]


def test_fuzzy_offsets(spark):
    parent = "Art. 1º O órgão “deverá” observar o disposto na lei e os de-\nmais atos.\nII - outro"
    child = "O órgão \"deverá\" observar o disposto na lei e os demais atos."
    r = spark.createDataFrame([(parent, child), (parent, "texto que não existe em parte alguma do pai")], "p string, c string").select(offsets.fuzzy(F.col("p"), F.col("c")).alias("f")).collect()
    assert parent[r[0].f.start : r[0].f.end].startswith("O órgão") and r[0].f.similarity >= 0.8 and r[1].f.start is None


def _row(k, number=None, enter=0.0, exit_=0.0, ident="", **x):
    return {"start": k * 10, "end": k * 10 + 5, "number": number, "enter": enter, "enter_reasons": x.get("why", []), "exit": exit_, "exit_reasons": x.get("out", []), "id": ident, "name": x.get("name", "")}


def test_zones_open_close_and_expire():
    z = origin.zones([_row(0, 1.0), _row(1, 2.0, 0.6, ident="LEI-1", why=["trigger_phrase"]), _row(2, exit_=0.4, out=["nr_marker"]), _row(3, 3.0)])
    assert [x[0] for x in z] == ["self", "external", "external", "self"] and z[2][5] == "trigger_phrase + nr_marker"
    z = origin.zones([_row(0, enter=0.7)] + [_row(k) for k in range(1, 60)])
    assert [x[0] for x in z].count("external") == 51 and z[50][4] == "low" and z[51][0] == "self"
    far = [_row(0, 5.0), _row(1, 337.0, enter=0.2)]
    assert origin.zones(far)[1][0] == "external" and origin.zones(far, compat=True)[1][0] == "self"
    late = origin.zones([_row(0, enter=0.6), _row(1, ident="LEI-9", name="n")])
    assert late[1][2:4] == ("LEI-9", "n")
    assert origin.zones([{**_row(0, enter=1.0), "start": -1}])[0][0] == "self"


def test_contract_is_all_or_nothing(spark):
    cols = "document_id string, node_id string, span_id string, device_type string, parent_node_id string, canonical_start int, canonical_end int, canonical_hash string, is_cross_page boolean, n_bbox_spans int"
    good = ("A", "leis:A#ART-1", "ART-1", "article", "", 0, 5, "h", False, 0)
    bad = ("B", "leis:B#INC-1", "INC-1", "inciso", "", -1, -1, "", False, 0)
    c = spark.createDataFrame([good, bad, ("B", "leis:B#ART-1", "ART-1", "article", "", 0, 5, "h", False, 0), ("C", "leis:C", "x", "x", "", None, 1, "h", False, 0)], cols)
    assert sorted((r.document_id, r.rule) for r in quality.violations(c).collect()) == [("B", "child_without_parent"), ("B", "evidence_without_offsets"), ("C", "start_missing")]
    sound, rest = quality.split_by_contract(c)
    assert {r.document_id for r in sound.collect()} == {"A"} and rest.count() == 3
    assert quality.assert_contract(c.where("document_id = 'A'")).count() == 1
    with pytest.raises(Exception, match="contract broken"):
        quality.assert_contract(c).collect()
    assert quality.missing_columns(c) == [] and quality.missing_columns(c.drop("canonical_hash")) == ["canonical_hash"]


def test_statute_to_chunks_and_manifest(spark):
    lines = ["Art. 1º O teste.", "I - primeiro;", "II - segundo.", "Art. 2º Outro."]
    canon = spark.createDataFrame([("D", "\n".join(lines) + "\n")], "document_id string, canonical_text string")
    req = spark.createDataFrame([("D", "LEI", "1", 2020)], "document_id string, tipo_documento string, numero string, ano int")
    ch = statutes.to_chunks(statutes.devices(_blocks(spark, lines)), req, canon)
    assert quality.violations(ch).count() == 0
    assert ch.where("span_id = 'ART-001'").first().retrieval_text == "\n".join(lines[:3])
    i = quality.integrity(ch, canon).first()
    assert i.mismatched == 0 and i.hashes_hold and i.idempotent
    m = quality.manifest(ch, canon).first()
    assert m.chunks == 4 and m.article_numbers == ["1", "2"] and m.coverage_pct > 90


def test_origin_keeps_every_row_whatever_its_id(spark):
    from lexspark.operators import origin

    text = "Art. 1º Esta lei.\nArt. 2º Texto.\n"
    rows = [("D", "n", "Art. 1º Esta lei.", 0, 17, "old"), ("D", "n", "Art. 2º Texto.", 18, 32, "old"), ("D", None, "sem id", -1, -1, None), (None, "m", "sem documento", 0, 3, None)]
    ch = spark.createDataFrame(rows, "document_id string, node_id string, text string, canonical_start int, canonical_end int, origin_type string")
    out = origin.classify(ch, spark.createDataFrame([("D", text)], "document_id string, canonical_text string"))
    assert sorted((str(r.node_id), r.text, r.origin_type) for r in out.collect()) == sorted((str(n), x, "self") for _, n, x, *_ in rows)
    assert origin.classify(ch.limit(0), spark.createDataFrame([], "document_id string, canonical_text string")).count() == 0
