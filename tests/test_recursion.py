"""Graph expansion, subtree text and offsets down trees of any depth against plain Python."""

import random

from lexspark.operators import graph, offsets, recursion, statutes
from lexspark.sources import scratch


def _brute_expand(edges, seeds, hops):
    at, found, hop = set(seeds), {}, 0
    frontier = set(seeds)
    while frontier and (hops is None or hop < hops):
        hop += 1
        new = {}
        for s, g, rel in edges:
            if s in frontier and g not in at:
                new.setdefault(g, []).append(rel)
        at |= set(new)
        found |= {g: (hop, len(rels), sorted(set(rels))) for g, rels in new.items()}
        frontier = set(new)
    return found


def test_expansion_with_circles_and_hubs(spark):
    rng = random.Random(2)
    edges = [(f"n{rng.randrange(40)}", f"n{rng.randrange(40)}", rng.choice("AB")) for _ in range(60)] + [("n0", f"h{k}", "A") for k in range(200)] + [(f"h{k}", "n1", "B") for k in range(200)]
    e = spark.createDataFrame([(s, g, r, 0.9, "HIGH") for s, g, r in edges], "source_node_id string, target_node_id string, rel_type string, confidence double, confidence_tier string")
    seeds = spark.createDataFrame([("n0",), ("n5",), ("n0",), (None,)], "node_id string")
    for hops in (0, 1, 2, None):
        got = {r.node_id: (r.hop, r.frequency, r.rel_types) for r in graph.expand(e, seeds, hops).collect()}
        assert got == _brute_expand(edges, ["n0", "n5"], hops)
    assert graph.expand(e.limit(0), seeds, None).count() == 0 and graph.expand(e, seeds.limit(0), None).count() == 0
    top = graph.expand(e, seeds, None, top_k=3).collect()
    assert [r.hop for r in top] == sorted(r.hop for r in top) and len(top) == 3


def test_floors_tiers_and_relations(spark):
    e = spark.createDataFrame([("a", "b", "CITA", 0.1, "LOW"), ("a", "c", "REGULAMENTA", 0.79, "HIGH"), ("a", "d", "REGULAMENTA", 0.8, "MEDIUM"), ("a", "e", "OTHER", 0.0, "HIGH"), ("a", "f", "CITA", None, "HIGH")], "source_node_id string, target_node_id string, rel_type string, confidence double, confidence_tier string")
    seeds = spark.createDataFrame([("a",)], "node_id string")
    ids = lambda **k: {r.node_id for r in graph.expand(e, seeds, 1, **k).collect()}
    assert ids(floors={"REGULAMENTA": 0.8, "CITA": 0.0}) == {"b", "d", "e", "f"}
    assert ids(floors=0.8) == {"d"} and ids(floors={}) == ids() == {"b", "c", "d", "e", "f"}
    assert ids(least_tier="MEDIUM") == {"c", "d", "e", "f"} and ids(rel_types=["CITA"], least_tier="HIGH") == {"f"}


def test_long_chain_of_edges(spark):
    e = spark.range(30).selectExpr("concat('n', id) AS source_node_id", "concat('n', id + 1) AS target_node_id", "'CITA' AS rel_type", "1D AS confidence", "'HIGH' AS confidence_tier")
    got = {r.node_id: r.hop for r in graph.expand(e, spark.createDataFrame([("n0",)], "node_id string"), None).collect()}
    assert got == {f"n{k}": k for k in range(1, 31)}


def test_subtree_text_of_random_trees(spark):
    rng = random.Random(4)
    rows = []
    for d in range(12):
        for k in range(rng.randrange(1, 25)):
            rows.append((f"D{d}", f"X-{k}", "" if k == 0 else f"X-{rng.randrange(max(0, k - 3), k)}", f"t{k}", rng.randrange(5)))
    rows += [("C", "X-1", "X-2", "a", 0), ("C", "X-2", "X-1", "b", 0), ("C", "X-3", "X-3", "self", 0), ("C", "X-4", "gone", "orphan", 0)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "document_id string, span_id string, parent_span_id string, text string, char_start int, hierarchy_depth int")

    def below(d, span, seen):
        kids = sorted((start, s, t) for dd, s, p, t, start in rows if dd == d and p == span and s not in seen)
        return [x for _, s, t in kids for x in (t, *below(d, s, {*seen, s}))]

    got = {(r.document_id, r.span_id): r.retrieval_text for r in statutes.subtree_text(df).collect()}
    assert got == {(d, s): "\n".join([t, *below(d, s, {s})]) for d, s, _, t, _ in rows}
    assert statutes.subtree_text(df.limit(0)).count() == 0


def test_offsets_to_any_depth(spark):
    depth = 40
    text = " ".join(f"w{k}" for k in range(depth))
    part = lambda k: " ".join(f"w{j}" for j in range(k, depth))
    rows = [("A", f"S{k}", f"S{k - 1}" if k else "", part(k), 0 if k == 0 else None, len(text) if k == 0 else None) for k in range(depth)]
    rows += [("A", "E", "S3", " ", None, None), ("A", "U", "E", "x", None, None), ("A", "lost", "nobody", "w1", None, None), ("A", "P", "Q", "w1", None, None), ("A", "Q", "P", "w1", None, None), ("B", "R", "", "no text", -1, 5), ("B", "K", "R", "no", None, None), ("A", "D", "S1", "w", None, None)]
    df = spark.createDataFrame(rows, "document_id string, span_id string, parent_span_id string, text string, char_start int, char_end int")
    got = {(r.document_id, r.span_id): (r.start, r.end, r.reason) for r in offsets.resolve_tree(df, spark.createDataFrame([("A", text)], "document_id string, canonical_text string")).collect()}
    assert len(got) == len(rows)
    assert all(got["A", f"S{k}"] == (text.index(part(k)), len(text), None) for k in range(depth))
    assert got["A", "E"][2] == "EMPTY_TEXT" and {got["A", x][2] for x in ("U", "lost", "P", "Q")} == {"INVALID_PARENT_RANGE"}
    assert got["B", "K"][2] == "INVALID_PARENT_RANGE" and got["A", "D"][2] == "AMBIGUOUS_MULTIPLE_MATCHES"


def test_row_limit_of_recursion_is_lifted_unless_set(spark):
    key = "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(key, "1000000")
    spark.conf.set(key, "1000000")
    recursion.unbounded(spark)
    assert spark.conf.get(key) == "-1"
    spark.conf.set(key, "5")
    recursion.unbounded(spark)
    assert spark.conf.get(key) == "5"
    spark.conf.set(key, old)


def test_scratch_falls_back_on_a_local_master_only(monkeypatch, spark):
    class Conf(dict):
        def get(self, k, default=None):
            return dict.get(self, k, default)

    class Session:
        conf = Conf({"spark.master": "local[2]"})

    assert scratch.shared_dir(Session()) == scratch.shared_dir(Session()) and scratch.shared_dir(Session()).startswith("file://")
    Session.conf["spark.master"] = "spark://host:7077"
    try:
        scratch.shared_dir(Session())
        raise AssertionError("no error")
    except ValueError:
        pass


def test_documents_pass_whole_and_answers_in_parts(spark, monkeypatch):
    """Documents that end within, at the end of and beyond a batch; nulls, circles reached from a span that stands twice, and few stages however deep."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    monkeypatch.setattr(recursion, "_ROWS", 2)
    try:
        rows = [(f"D{d}", f"X-{k}", f"X-{k - 1}" if k else "", f"t{k}", k) for d in range(1, 17) for k in range(d)]
        rows += [("N", "A", "", None, 0), ("N", "B", "A", None, 1), (None, "A", "", "a", 0), (None, "B", "A", "b", 1), ("Z", "R", "", "r", 0), ("Z", "S", "R", "s", 1), ("Z", "T", "S", "t", 2), ("Z", "S", "T", "again", 3)]
        df = spark.createDataFrame(rows, "document_id string, span_id string, parent_span_id string, text string, char_start int")
        out = statutes.subtree_text(df)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "UnionLoop" not in plan and "Join" not in plan
        got = {(r.document_id, r.char_start): r.retrieval_text for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert len(got) == len(rows)
    assert all(got[f"D{d}", k] == "\n".join(f"t{j}" for j in range(k, d)) for d in range(1, 17) for k in range(d))
    assert got["N", 0] == "" and got["N", 1] == "" and got[None, 0] == "a" and got["Z", 0] == "r\ns\nt" and got["Z", 1] == "s\nt"
