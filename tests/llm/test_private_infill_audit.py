"""Personal data, fill-in-middle and filter audit against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.llm import filter_audit, infill, private_data

# --- personal data ----------------------------------------------------------------------------
FORMATS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(d):
    return sum(v if k % 2 == 0 else v * 2 - 9 * (v > 4) for k, v in enumerate(map(int, reversed(d)))) % 10 == 0


def _base(text):
    out = []
    for kind, pattern in FORMATS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 16 <= len(d) <= 19 and _luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return private_data.train(spark)


def _texts():
    rng = random.Random(3)
    bits = ["a.b@c.d", "x@y", "@", "+1 (743) 555-3824", "+", "1.2.3.4", "300.1.2.3", "001.02.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "12", "-", " ", ".", "é", "𝔸", "a+b", "%", "5500005555555559", "\n", "(", "+49 30 123456", "1.2.3.4.5.6.7.8", "u@h.c+v@w.x", "00000000000000000000001.1.1.1", "_", "ß"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 14))) for _ in range(600)]
    return [None, "", " ", "9" * 40_000, "a" * 40_000, "1." * 20_000 + "@", "4 1" * 8000, "+" + "(1" * 20_000, ("me@site.com " + "+1 (743) 555-3824 ") * 3000, "-".join("4111111111111111" for _ in range(400))] + made


def test_base_spans_equal_a_plain_scan(spark, model):
    texts = _texts()
    rows = [(k, t, 7) for k, t in enumerate(texts)] + [(3, "again a@b.c", 7), (None, "1.1.1.1", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int").repartition(8)
    out = private_data.scan(df, model)
    got = sorted((str(r.doc_id), [tuple(x) for x in r.base], r.n_email, r.n_ip, r.n_card, r.n_phone) for r in out.collect())
    want = [(str(i), b := _base(t), *[sum(x[0] == k for x in b) for k in private_data.KINDS]) for i, t, _ in rows]
    assert got == sorted(want)
    for r in out.collect():
        spans = [tuple(x) for x in r.spans]
        assert set(map(tuple, r.base)) <= set(spans) and len(set(spans)) == len(spans)
        assert spans == sorted(spans, key=lambda x: (private_data.KINDS.index(x[0]), *x[1:]))
    assert private_data.scan(df.limit(0), model).count() == 0
    assert private_data.joined(F.col("spans")) is not None


def test_trees_in_sql_score_as_the_model_does(spark, model):
    texts = [private_data.sentence(random.Random(f"other:{k}"))[0] for k in range(300)]
    d = private_data.candidates(private_data.base_spans(spark.createDataFrame([(t,) for t in texts], "t string"), "t"))
    rows = d.select("proposed", F.expr(f"transform(proposed, c -> {model.sql('c')})").alias("z"), F.expr(f"transform(proposed, c -> coalesce({model.passes('c')}, false))").alias("ok")).collect()
    n = 0
    for r in rows:
        for c, z, ok in zip(r.proposed or (), r.z or (), r.ok or (), strict=True):
            own = model.score([c[f"f{k}"] for k in range(len(private_data.FEATURES))])
            limit = model.thresholds[c.kind]
            assert abs(own - z) < 1e-9 and ok == (limit is not None and own >= limit)
            n += 1
    assert n > 200


def test_sentences_of_another_seed_are_told_apart(spark, model):
    made = [private_data.sentence(random.Random(f"held:{k}")) for k in range(1500)]
    df = spark.createDataFrame([(k, t) for k, (t, *_) in enumerate(made)], "doc_id long, text string")
    found = {r.doc_id: [tuple(x) for x in r.spans] for r in private_data.scan(df, model).collect()}
    base = {k: _base(t) for k, (t, *_) in enumerate(made)}
    added = {k: [s for s in found[k] if s not in base[k]] for k in found}
    clean = [k for k, (*_, y) in enumerate(made) if not y]
    true = [k for k, (_, _, _, y) in enumerate(made) if y]
    assert sum(bool(added[k]) for k in clean) <= 0.01 * len(clean)
    assert sum((made[k][1], *made[k][2]) in found[k] for k in true) >= 0.6 * len(true)


def test_kinds_of_added_spans_and_redaction(spark, model):
    texts = ["Write to jane (at) house [dot] org please.", "host 2001:db8:85a3::8a2e:370:7334 is down", "card: 3782 822463 10005", "at 10:20:30 on 2024-01-15 we met, order 4111 1111 1111 1112", "mail a@b.org or +1 (743) 555-3824 é", "look at home. Then 12 345 678 more"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.spans] for r in private_data.scan(df, model).collect()}
    own = [("email", "jane (at) house [dot] org"), ("ip", "2001:db8:85a3::8a2e:370:7334"), ("card", "3782 822463 10005")]
    for k, (kind, hit) in enumerate(own):
        at = texts[k].index(hit)
        assert got[k] == [(kind, at, at + len(hit))]
    assert got[3] == [] and got[5] == [] and len(got[4]) == 2
    red = {r.doc_id: r.text for r in private_data.redact(df, model).collect()}
    assert red[0] == "Write to [EMAIL] please." and red[4] == "mail [EMAIL] or [PHONE] é" and red[3] == texts[3]


def test_thresholds_hold_their_precision():
    rng = np.random.default_rng(1)
    y = (rng.random(500) < 0.4).astype(float)
    z = y * 2 + rng.normal(size=500)
    cut = private_data.calibrate(z, y, 0.95)
    assert y[z >= cut].mean() >= 0.95
    assert private_data.calibrate(z, np.zeros(500)) is None and private_data.calibrate(z[:5], y[:5]) is None
    m = private_data.boost(np.stack([(z * 4).astype(int), rng.integers(0, 5, 500)], 1), y, 20)
    s = np.array([m.score(x) for x in np.stack([(z * 4).astype(int), np.zeros(500, int)], 1)])
    assert ((s > 0) == y).mean() > 0.8
    assert private_data.boost(np.zeros((0, 2), int), np.zeros(0)).trees == []


# --- fill-in-middle ---------------------------------------------------------------------------
def _infill(doc_id, text):
    text = text or ""
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(u), "plain", None, None, text
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    return (len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_infill_equals_brute_force_and_comes_back(spark):
    rng = random.Random(7)
    bits = ["a", "B", "word", " ", "  ", "\n", "é", "ñandú", "𝔸", "7", "<", ">", "<P", "P>", "<S>", "M>", "[", "`", "{", "@", "漢字", "\x00", "Z", "z"]
    texts = [None, "", "a", "é", " ", "<P>", "x<M>y", "<P", "ab" * 200_000, "é" * 300_000 + "x", "a b" * 150_000, "<S", "S>a", "?" * 9] + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))) for _ in range(500)]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(1, "again", "x"), (None, "no id here at all", "x"), (2**62, "large id", "x"), (-5, "negative id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string")
    out = infill.transform(df).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    key = lambda r: (str(r[0]), r[-1])
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect()), key=key)
    assert got == sorted(((i, *_infill(i, t)) for i, t, _ in rows), key=key)
    assert sorted((str(r.doc_id), r.back) for r in out.collect()) == sorted((str(i), t or "") for i, t, _ in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert infill.transform(df.limit(0)).count() == 0 and dict(infill.transform(df).dtypes)["doc_id"] == "bigint"


def test_ranks_from_sparse_events(monkeypatch):
    monkeypatch.setattr(infill, "BLOCK", 7)
    rng = random.Random(9)
    find = infill.Units()
    for _ in range(300):
        text = "".join(rng.choice("ab<>PSM é.1") for _ in range(rng.randrange(0, 40)))
        u, f = re.findall(r"[A-Za-z]+|[^A-Za-z]", text), find(text)
        assert f.n == len(u) and f.sentinel == any(s in text for s in ("<P>", "<S>", "<M>"))
        assert [f.end(k) for k in range(len(u) + 1)] == list(itertools.accumulate(map(len, u), initial=0))
        assert len(f.starts) <= 1 + 2 * len(re.findall("[A-Za-z]+", text))


# --- filter audit -----------------------------------------------------------------------------
def _fails(rows):
    out = []
    for i, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        copy = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": copy}
        out.append((i, part or "", {k for k, v in f.items() if v}))
    return out


def _audit(rows, labels):
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    docs, removed, out = _fails(rows), {}, {}
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {p for _, p, _ in docs}:
            left = [(i, f) for i, p, f in docs if p == part]
            every = left
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                fails = sum(name in f for _, f in every)
                out[part, order, step] = [len(left), len(gone), fails - len(gone), sum(f == {name} for _, f in every), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
                removed[part, name] = removed.get((part, name), 0) + len(gone)
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_brute_force(spark):
    rng = random.Random(5)
    words = ["word", "Other", "UPPER", "x#y", "a", "b", "ünder", "50%"]
    texts = [" ".join(rng.choice(words[: rng.choice([5, 8])] if rng.random() < 0.5 else [f"w{j}" for j in range(200)]) for _ in range(rng.randrange(0, 90))) for _ in range(40)]
    rows = [(rng.choice([k, k, k, None]), rng.choice([rng.choice(texts), texts[0], None, "\t\n ", "A" * 30_000 + " b" * 30_000]), rng.choice(["s1", "s2", None, ""])) for k in range(150)]
    rows += [rows[3], rows[3], (7, "other text of an id", "s3"), (7, "other text of an id", "s1"), (2**60, "", "s1")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 150, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, mask int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit.interactions(docs, lab).collect()}
    assert got == _audit(rows, labels)
    assert filter_audit.interactions(docs.limit(0), lab).count() == 0
    none = filter_audit.interactions(docs, lab.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(none) == (0, 0)


def test_matrices_cover_each_order():
    m = filter_audit.matrices()
    assert {v.shape for v in m.values()} == {(32, 600)} and len(set(filter_audit.orders())) == 120
    assert (m["removed"].reshape(32, 120, 5).sum(2) + m["kept"].reshape(32, 120, 5)[:, :, 4] == 1).all()  # each mask goes once or stays


def test_copies_of_one_text_meet_in_no_task(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one text for all of them").alias("text"), F.lit("s").alias("source"))
    each = filter_audit.masks(docs)
    assert {r["mask"] & 16: r["count"] for r in each.groupBy("mask").count().collect()} == {0: 1, 16: 3999}
    sizes = [r["n"] for r in each.groupBy(F.spark_partition_id()).agg(F.sum("n").alias("n")).collect()]
    assert len(sizes) == 1 or max(sizes) < 3000
