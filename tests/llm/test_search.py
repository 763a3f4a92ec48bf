import itertools
import random
import re

import numpy as np
import pytest

from lexspark.llm import decontaminate, licenses, topk

# --- licences ---------------------------------------------------------------------------------
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = {65 + k: 97 + k for k in range(26)}


def _base(text):
    w = WORDS.findall((text or "").translate(LOW))
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        hits = [k for k in range(len(w)) if w[k : k + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_places_and_labels(spark):
    texts = [
        None, "", "---", "mit license", "MIT License. MIT license; mit LICENSE", "smit license", "mit licenses", "Licensed under CC BY-NC 4.0.", "CC by", "ccby cc  BY x", "gnu general public license " * 3, "GNU general-public_license!",
        "é mit license é", "apache", "Licensed under the Apache License, Version 2.0 (the License)", "mit license", "the MIT license\nand the Apache license", "cc cc by by",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
    ]
    rows = list(enumerate(texts)) + [(3, "mit license"), (None, "mit license")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, labels int")
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(df).collect()), key=str)
    assert got == sorted(((i, *_base(t)) for i, t in rows), key=str)
    by = {r.doc_id: r for r in licenses.scan(df).collect() if r.doc_id is not None}
    assert by[7].labels == "cc-by,cc-by-nc" and by[14].labels == "apache,apache-2.0" and by[18].labels == "mit" and by[18].score > 0.6
    assert all(0 <= r.score <= 1 for r in by.values()) and by[1].score == 0
    assert set(by[7].base_labels.split(",")) <= set(by[7].labels.split(","))
    assert licenses.scan(df.limit(0)).count() == 0


def test_templates_need_position_and_phrase(spark):
    t = licenses.TEMPLATES[9].text
    shuffled = " ".join(sorted(t.split()))
    df = spark.createDataFrame([(1, "x y " + t + " z"), (2, shuffled), (3, t.replace("redistribution", "distribution"))], "doc_id long, text string")
    assert {r.doc_id: r.labels for r in licenses.scan(df).collect()} == {1: "bsd", 2: "", 3: ""}


def test_each_licence_of_a_long_notice_is_found(spark):
    by = {}
    for t in licenses.TEMPLATES:
        by.setdefault(t.label, t.text)
    four = " \n\n ".join(by[k] for k in ("cc0", "mit", "bsd", "unlicense"))
    every = " \n\n ".join(t.text for t in licenses.TEMPLATES)
    df = spark.createDataFrame([(1, four.replace(by["mit"], licenses.TEMPLATES[8].text)), (2, every)], "doc_id long, text string")
    got = {r.doc_id: r.labels.split(",") for r in licenses.scan(df.where("doc_id = 1")).collect() + licenses.scan(df.where("doc_id = 2")).collect()}
    assert got[1] == ["bsd", "cc0", "mit", "unlicense"]
    assert set(got[2]) == set(by) | set(licenses.BASE.values())


# --- top-k ------------------------------------------------------------------------------------
def _brute(rows, k=10):
    ok = [(i, np.floor(1024 * np.array(v, float)).astype(np.int64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in {i: v for i, v in reversed(ok) if i % 100 == 0}.items():
        s = sorted((-int(a @ b), i) for i, b in ok if i != q and len(b) == len(a))
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 4096])
def test_top_k_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk, "ROW_BLOCK", 64)
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=8).astype(np.float32).tolist()) for k in range(900)]
    rows += [(k, rows[7][1]) for k in range(900, 1300)]  # one very common vector: ties
    rows += [(2000, None), (2001, [1.0] * 7 + [None]), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8), (None, [1.0] * 8), (2100, [1.0, 2.0]), (2101, [0.5, 0.5]), (2102, []), (2200, [-3.0] * 8)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, rank int").repartition(3)
    assert sorted(map(tuple, topk.top_k(df).collect())) == _brute(rows)


def test_the_cutoff_saves_scoring(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(40):  # clusters whose vectors lie in a few components each
        centre = np.zeros(32)
        at = rng.choice(32, 4, replace=False)
        centre[at] = rng.normal(size=4) * 3
        rows += [(v, centre + (centre != 0) * rng.normal(size=32) * 0.1) for v in range(c * 60, c * 60 + 60)]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in rows] + [(100, rows[5][1].tolist()), (100, rows[6][1].tolist())]
    df, work = spark.createDataFrame(rows, "vec_id long, embedding array<float>"), {}
    got = sorted(map(tuple, topk.top_k(df, work=work).collect()))
    first = {}
    for i, v in rows:
        first[i] = min(first.get(i, v), v)
    want = [r for r in _brute([(i, v) for i, v in rows]) if r[0] != 100]
    assert [r for r in got if r[0] != 100] == want and not any(r[2] == 100 for r in got if r[0] == 100)
    assert work["first"] <= 0.3 * work["all"] and work["second"] < 0.7 * work["all"] and work["resolved"] * 32 < 0.2 * work["all"]


def test_very_long_and_large_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(k, (rng.normal(size=3000) * 5000).astype(np.float32).tolist()) for k in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(df, k=3).collect())) == _brute(rows, 3)


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(df).collect())) == [(0, 1, 1, 1024 * 2048), (0, 2, 2, -1024 * 1024)]
    assert topk.top_k(df.where("vec_id > 0")).count() == 0
    assert topk.top_k(df.limit(0)).count() == 0


# --- decontamination --------------------------------------------------------------------------
ITEM = "The train left Lisbon at 14 km per hour and met 3 tired horses near the old river bridge before noon on Monday evening with Maria"


def test_leaks_with_other_numbers_and_names(spark):
    docs = [
        (1, "Before it. " + ITEM + ". After it."), (2, ITEM.replace("14", "90").replace("Lisbon", "Madrid").replace("3", "71")), (3, ITEM.upper()), (4, "Nothing of it here at all, only other words that go on and on."), (5, None), (6, ""),
        (7, " ".join(ITEM.split()[:9]) + " but then it goes on in quite another way"), (8, ITEM + " . " + ITEM), (8, ITEM), (None, ITEM),
        (9, ITEM.replace("14 km", "14km")),
    ]
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, n_windows int")
    b = spark.createDataFrame([(77, ITEM), (78, None), (79, "too short"), (80, "five short words are enough")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(d, b).collect()}
    assert {k[0] for k in got} == {1, 2, 3, 8, 9, None} and {k[1] for k in got} == {77}
    assert got[2, 77].n_changed >= 2 and got[1, 77].n_changed == 0 and got[1, 77].coverage > 0.9
    left = decontaminate.clean(d, b).collect()
    assert sorted(str(r.doc_id) for r in left) == sorted(["4", "5", "6", "7"]) and left[0].n_windows == 0
    assert decontaminate.find_leaks(d.limit(0), b).count() == 0 and decontaminate.find_leaks(d, b.limit(0)).count() == 0


def test_slots_must_be_consistent(spark):
    # no run of 13 tokens is consistent in the second document
    item = "If Anna has 5 apples and gives 5 apples away then the remaining basket holds none"
    d = spark.createDataFrame([(1, item.replace("5", "9")), (2, item.replace("5 apples and", "9 apples and"))], "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.find_leaks(d, b).collect()] == [1]


def test_leaks_by_shuffle_equal_those_by_broadcast(spark, monkeypatch):
    rng = random.Random(2)
    items = [(k, " ".join(f"v{rng.randrange(900)}" for _ in range(rng.randrange(6, 40)))) for k in range(30)]
    docs = [(k, " ".join(f"v{rng.randrange(900)}" for _ in range(50)) + " " + (items[k % 30][1] if k % 3 == 0 else "") + " v1 v2") for k in range(120)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, decontaminate.find_leaks(d, b).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert one == sorted(map(tuple, decontaminate.find_leaks(d, b).collect()))
    assert {r[0] for r in one} == {k for k in range(120) if k % 3 == 0}


def test_verbatim_copies_need_no_literals(spark):
    items = {
        1: "What is 37 times 48 plus 12 minus 5?", 2: "Add 4 and 7 now", 3: "Is 9 prime?", 4: "Why?", 5: "Die Katze von Anna jagt im Garten von Herrn Meier die Maus von Peter und Paul",
        6: "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15",
    }
    docs = [(k, f"Some other words stand before it. {t} And after it others.") for k, t in items.items()]
    docs += [(10, items[1].replace("37", "38")), (11, items[3].replace("9", "8")), (12, "1 2 3 4 5 6 7 0 9 10 11 12 13 14 15"), (13, "is 9 prime, and is 9 prime")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_covered, r.n_changed) for r in decontaminate.find_leaks(d, b).collect()}
    assert got == {(1, 1): (9, 0), (2, 2): (5, 0), (3, 3): (3, 0), (4, 4): (1, 0), (5, 5): (16, 0), (6, 6): (15, 0), (13, 3): (3, 0)}


def test_names_that_begin_sentences(spark):
    items = {1: "Tom has 5 red apples. Tom buys 3 more apples. How many apples does Tom have?", 2: "Which old river runs through the quiet town near London", 3: "How many apples has Tom bought today"}
    docs = [
        (1, items[1].replace("Tom", "Anna")), (2, "Question 7 " + items[2].replace("London", "Paris")), (3, "He asked: how many apples has Anna bought today"),
        (4, items[1].replace("Tom", "Anna", 1)), (5, "Here. " + items[3].replace("Tom", "Anna")), (6, items[1].replace("Tom has", "Anna has").replace("Tom buys", "Eva buys").replace("Tom have", "Mia have")),
        (7, "It is known. Rivers of the old town run through many a quiet place."),
    ]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_covered, r.n_changed) for r in decontaminate.find_leaks(d, b).collect()}
    assert got[1, 1] == (16, 1) or got[1, 1] == (15, 1)
    assert {k: v for k, v in got.items() if k[0] in (2, 3, 5)} == {(2, 2): (10, 1), (3, 3): (7, 1), (5, 3): (7, 1)}
    # three names for one: only the 13 tokens around the second are consistent
    assert got[6, 1][0] == 13 and not any(k[0] == 7 for k in got)


def _brute_leaks(docs, items):
    """Hits by comparing every window of every item with every window of every document, under every reading."""
    template, out = decontaminate.Templates(), {}

    def options(ids, own, opens, words, keep, k):
        value = decontaminate._value(words[keep[k]])
        yield int(ids[k]), value if ids[k] <= 3 else None, False
        if opens[k]:
            yield decontaminate.NAME, value, True

    for (i, t), (item, bt) in itertools.product(docs, items):
        if t is None or bt is None:
            continue
        d, b = template(t), template(bt)
        n = min(len(b[0]), decontaminate.WINDOW)
        if not n or len(d[0]) < n:
            continue
        by_shift = {}
        for at, b_at in itertools.product(range(len(d[0]) - n + 1), range(len(b[0]) - n + 1)):
            both = [[(x, y) for x in options(*b, b_at + j) for y in options(*d, at + j) if x[0] == y[0]] for j in range(n)]
            found = by_shift.setdefault(at - b_at, [])
            for way in itertools.product(*both):
                pairs = [(x[1], y[1], x[2] or y[2]) for x, y in way if x[0] <= 3]
                if n >= decontaminate.FEWEST and n - len(pairs) >= min(decontaminate.LITERAL, n):
                    found.append((b_at, n, 2 if any(p[2] and p[0] != p[1] for p in pairs) else 0, pairs))
            if (d[1][at : at + n] == b[1][b_at : b_at + n]).all():
                values = [(decontaminate._value(b[3][b[4][k]]), False) for k in range(b_at, b_at + n) if b[0][k] <= 3]
                found.append((b_at, n, 1, [(v, v, o) for v, o in values]))
        need, most = min(decontaminate.RUN, len(b[0])), 0
        for found in by_shift.values():
            for reading in range(3):
                own = sorted((f for f in found if f[2] <= reading), key=lambda f: f[0])
                for a in range(len(own)):
                    for z in range(a + 1, len(own) + 1):
                        pairs = {p[:2] for f in own[a:z] for p in f[3] if reading == 2 or not p[2]}
                        if len(pairs) > len({p[0] for p in pairs}) or len(pairs) > len({p[1] for p in pairs}):
                            break
                        most = max(most, len({k for f in own[a:z] for k in range(f[0], f[0] + f[1])}))
        if most >= need:
            out[i, item] = max(most, out.get((i, item), 0))
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "stone", "river", "Tom", "Anna", "Eva", "5", "7", "12", "km", "5.", "river.", "runs", "holds", "The"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, text(rng.choice([1, 3, 4, 5, 6, 8, 9, 13, 14, 20, 30]))) for k in range(14)]
    docs = []
    for k in range(70):
        w = rng.choice(items)[1].split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(words)
        if rng.random() < 0.3:
            w = [{"5": "9", "7": "8", "Tom": "Mia"}.get(x, x) for x in w]
        docs.append((k, " ".join([text(rng.randrange(5)), *w, text(rng.randrange(5))])))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_covered for r in decontaminate.find_leaks(d, b).collect()}
    assert got == _brute_leaks(docs, items) and len(got) > 40


def test_consistency_is_asked_of_each_run(spark):
    item = "If Anna has 5 apples and 7 pears in the basket near the old stone bridge over the river then she gives 5 apples to the girl who holds the other basket and walks home over the same bridge with 7 pears left"
    docs = [(1, item[::-1].replace("5", "6", 1)[::-1]), (2, item.replace("gives 5", "gives 6")), (3, item.replace("5", "6"))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.find_leaks(d, b).collect()}
    assert set(got) == {1, 2, 3} and 13 <= got[2].n_covered < got[3].n_covered == got[3].item_tokens and got[3].n_changed == 1


def test_rows_without_id_or_with_one_id_are_searched_apart(spark):
    w = ITEM.split()
    half, rest = " ".join(w[:11]), " ".join(w[8:19])
    docs = [(None, half), (None, rest), (5, half), (5, rest), (None, ITEM), (6, ITEM), (6, "clean words only"), (7, None), (None, None), (8, "x " * 50_000 + ITEM)]
    d, b = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, i int, th int"), spark.createDataFrame([(1, ITEM), (1, "other words of the same id here"), (None, ITEM)], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.find_leaks(d, b).collect()), key=str)
    assert got == sorted([(x, y) for x in (None, 6, 8) for y in (1, None)], key=str)
    left = decontaminate.clean(d, b)
    assert left.columns == d.columns and sorted((str(r.doc_id), r.text) for r in left.collect() if r.text) == sorted((str(i), t) for i, t in docs if t and ITEM not in t)
    assert left.where("text is null").count() == 2


def test_readings_are_all_that_keep_enough_literals():
    rng = np.random.default_rng(1)
    ids, either = rng.integers(4, 1 << 60, 40).astype(np.uint64), rng.random(40) < 0.5
    ids[rng.random(40) < 0.1] = decontaminate.NUMBER
    either &= ids > 3
    want, got = set(), set()
    for a in range(40 - 8 + 1):
        opens = np.flatnonzero(either[a : a + 8])
        for bits in range(1 << len(opens)):
            w = ids[a : a + 8].copy()
            w[[o for k, o in enumerate(opens) if bits >> k & 1]] = decontaminate.NAME
            h = int(decontaminate.windows(w, 8)[0])
            want |= {(a, bits, h)} if h else set()
    for at, bits, h in decontaminate._readings(ids, either, 8):
        for k, x in enumerate(h.tolist()):
            got |= {(k if at is None else int(at[k]), bits, x)} if x else set()
    assert got == want and any(b > 2 for _, b, _ in got)
