from hypothesis import given, settings
from hypothesis import strategies as st

from lexspark.operators import citations, graph, rulings


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 6000), max_size=60), st.integers(0, 300))
def test_packing_covers_all_in_order_and_ends(lens, head):
    parts = rulings.pack(lens, head, 0)
    if not lens:
        assert parts == []
        return
    assert parts[0][0] == 0 and parts[-1][1] == len(lens)
    for (a, b), (c, d) in zip(parts, parts[1:], strict=False):
        assert a < c <= b and d > b  # progress, no gap
    assert all(b - a == 1 or sum(lens[a:b]) <= rulings.CHUNK for a, b in parts)


def test_a_long_paragraph_after_a_short_one_ends():
    assert rulings.pack([100, 3950, 100], 0, 0) == [(0, 1), (1, 2), (2, 3)]
    assert rulings.pack([1, 1, 4000], 0, 0) == [(0, 2), (2, 3)]


def test_long_sections_split_with_context(spark):
    body = "VOTO\n" + "\n".join(f"{k}. " + "palavra " * 40 for k in range(1, 51)) + "\n"
    docs = spark.createDataFrame([("A", "ACÓRDÃO Nº 7/2021 - Plenário\nRelator: Ministro Fulano\n" + body)], "document_id string, text string")
    heads = rulings.header(docs)
    text = docs.first().text
    ch = rulings.chunk(rulings.parsed_sections(rulings.devices(docs), docs, heads), heads).where("section_type = 'voto'").orderBy("part_number").collect()
    assert 3 <= len(ch) <= 10 and all(text[c.canonical_start : c.canonical_end] == c.text for c in ch)
    assert all(a.canonical_end > b.canonical_start for a, b in zip(ch, ch[1:], strict=False))
    assert ch[0].retrieval_text.startswith("[CONTEXTO: Acórdão 7/2021-Plenario | Voto do Min. Fulano | parte 1 de ")


def test_request_fills_what_a_header_lacks(spark):
    docs = spark.createDataFrame([("A", "sem cabeçalho")], "document_id string, text string")
    req = spark.createDataFrame([("A", "9", "X")], "document_id string, numero string, relator string")
    h = rulings.header(docs, req).first()
    assert (h.numero, h.relator, h.ano) == ("9", "X", "")


def _refs(spark, text, doc="DOC", **kw):
    df = spark.createDataFrame([("n", text, doc)], "node_id string, text string, document_id string")
    return [(r.target_node_id, r.rel_type, r.confidence) for r in citations.extract(df, **kw).orderBy("ordinal").collect()]


def test_citation_sentences(spark):
    t = lambda text, **kw: [x[0] for x in _refs(spark, text, **kw)]
    assert t("conforme art. 9º da Lei 14.133/2021") == ["leis:LEI-14.133-2021#ART-009"]
    assert t("arts. 28, 29 e 33 da Lei Complementar nº 101, de 2000") == ["leis:LC-101-2000#ART-028", "leis:LC-101-2000#ART-029", "leis:LC-101-2000#ART-033"]
    assert t("arts. 62 a 64 da Lei 14.133/2021") == [f"leis:LEI-14.133-2021#ART-0{n}" for n in (62, 63, 64)]
    assert t("art. 75, inciso II, alínea 'a', da Lei nº 14.133") == ["leis:LEI-14.133-2021#ALI-075-II-a"]
    assert t("Lei nº 14.133, art. 5, § 2º") == ["leis:LEI-14.133-2021#PAR-005-2", "leis:DOC#PAR-005-2"]
    assert t("o art. 3º e o art. 4º") == ["leis:DOC#ART-003", "leis:DOC#ART-004"]
    assert t("Acórdão 2450/2025-P") == ["acordaos:AC-2450-2025"]
    assert t("a Constituição Federal") == ["leis:CF-1988"] and t("a Constituição Federal", compat=True) == [None]
    assert t("nada") == [] and t("") == []
    both = "o art. 5º da Lei 14.133/2021 e o art. 7º da Lei 14.133/2021"
    assert t(both) == ["leis:LEI-14.133-2021#ART-005", "leis:LEI-14.133-2021#ART-007"]
    assert t(both, compat=True) == ["leis:LEI-14.133-2021#ART-005"]
    assert t("Lei nº 99.999, de 16 de março de 2015") == ["leis:LEI-99.999-2015"]


def test_relations_follow_the_context(spark):
    assert _refs(spark, "Fica revogado o art. 2º da Lei nº 8.666/1993.")[0] == ("leis:LEI-8.666-1993#ART-002", "REVOGA_EXPRESSAMENTE", 0.95)
    far = "Fica revogado." + " " * 200 + "Veja a Lei nº 8.666/1993"
    assert _refs(spark, far)[0][1] == "CITA"


def test_loops_and_repeats_go(spark):
    c = spark.createDataFrame([("n", 1, "n"), ("n", 2, " x "), ("n", 3, "x"), ("n", 4, "p"), ("n", 5, ""), ("n", 6, None), ("n", 7, "y")], "node_id string, ordinal int, target_node_id string")
    ch = spark.createDataFrame([("n", "p")], "node_id string, parent_node_id string")
    got = lambda **k: sorted(r.target_node_id for r in citations.normalise(c, ch, **k).collect())
    assert got() == ["x", "y"] and got(compat=True) == ["p", "x", "y"]


def test_expansion_by_hops_tiers_and_floors(spark):
    rows = [("a", "b", "CITA", 0.9), ("b", "c", "CITA", 0.9), ("c", "d", "CITA", 0.9), ("a", "e", "CITA", 0.4), ("a", "f", "REVOGA", 0.6), ("b", "a", "CITA", 0.9), ("f", "c", "CITA", 0.9)]
    e = spark.createDataFrame([(s, t, r, c, "regex", "") for s, t, r, c in rows], "source_node_id string, target_node_id string, rel_type string, confidence double, extraction_method string, citation_text string")
    e, seed = graph.edges(e), spark.createDataFrame([("a",)], "node_id string")
    got = lambda **k: {r.node_id: (r.hop, r.frequency) for r in graph.expand(e, seed, **k).collect()}
    assert got(hops=2) == {"b": (1, 1), "e": (1, 1), "f": (1, 1), "c": (2, 2)}
    assert set(got(hops=3, least_tier="HIGH")) == {"b", "c", "d"}
    assert set(got(hops=1, rel_types=["REVOGA"])) == {"f"} and set(got(hops=1, floors={"REVOGA": 0.7})) == {"b", "e"}
    assert set(got(hops=2, top_k=2)) == {"b", "e"}
