import random

import numpy as np
from pyspark.sql import functions as F

from lexspark.llm import near_dup


def brute(rows):
    """Components by comparing all pairs of sets."""
    sets = [set(near_dup.shingle_set(t).tolist()) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[root(k)] = min(low.get(root(k), i), i)
    return sorted((i, len(s), low[root(k)], i == low[root(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))


def _got(spark, rows):
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, component_id string")
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect())


def _words(rng, n):
    return ["w%d" % rng.randrange(5000) for _ in range(n)]


def test_groups_passages_and_chains(spark):
    rng = random.Random(3)
    rows, i = [], 0
    passage = _words(rng, 60)
    for size in (9, 30, 90, 300):
        base = _words(rng, size)
        for _ in range(60):  # a large group: edits from none to many, some shared
            w = list(base)
            for _ in range(rng.randrange(0, max(2, size // 12))):
                w[rng.randrange(len(w))] = rng.choice(["e1", "e2", "w%d" % rng.randrange(5000)])
            rows.append((i, " ".join(w)))
            i += 1
        for cut in range(0, 40, 4):  # deletions share what they lack
            rows.append((i, " ".join(base[cut * size // 100 :])))
            i += 1
    for _ in range(80):  # a passage that many documents hold links none of them
        w = _words(rng, rng.choice([20, 150]))
        at = rng.randrange(len(w))
        rows.append((i, " ".join(w[:at] + passage + w[at:])))
        i += 1
    rng.shuffle(rows)
    assert _got(spark, rows) == brute(rows)


def test_edge_texts(spark):
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "one two"), (8, "ONE  two"), (7, "one two three four five"), (6, "One two\nthree four five"), (11, "é É"), (12, "É é")]
    assert _got(spark, rows) == brute(rows)


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(None, text), (2, text), (2, text), (None, "alone a b c d e f")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 2, False), (2, 2, True), (2, 2, True), (None, None, True)], key=str)
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_one_id_with_several_texts_and_clashing_columns(spark):
    text = lambda k, n=40: " ".join(f"t{k}w{j}" for j in range(n))
    rows = [(2, text(1)), (2, text(2)), (7, text(2)), (9, text(1)), (5, text(3)), (5, text(4)), (1, text(4)), (None, text(3)), (None, text(5)), (None, text(5)), (2, text(1)), (4, None), (4, ""), (None, " ")]
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, cls int, kept int, th int")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()), key=str)
    want = [(2, 2, True)] * 3 + [(7, 2, False), (9, 2, False), (5, 5, True), (5, 1, False), (1, 1, True), (None, 5, False)] + [(None, None, True)] * 3 + [(4, 4, True)] * 2
    assert got == sorted(want, key=str)
    one = near_dup.keep_one(df)
    assert one.columns == df.columns
    kept = sorted(((r.doc_id, r.text) for r in one.collect()), key=str)
    assert kept == sorted([(2, text(1)), (2, text(2)), (5, text(3)), (1, text(4)), (None, text(5)), (4, None), (4, ""), (None, " ")], key=str)


def test_hot_keys_dealt_apart_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "HOT", 8)
    monkeypatch.setattr(near_dup, "LIGHT", 4)
    rng = random.Random(9)
    rows = []
    for size in (12, 60, 200):
        base = _words(rng, size)
        for _ in range(70):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, size // 10))):
                w[rng.randrange(len(w))] = rng.choice(["e1", "e2", "w%d" % rng.randrange(5000)])
            rows.append((len(rows), " ".join(w)))
    for k in range(60):  # a chain and a star of small changes
        rows.append((len(rows), " ".join(f"c{j}" for j in range(k, k + 40))))
    rows.append((len(rows), " ".join(f"l{j % 9000}" for j in range(60_000))))  # a very long text
    assert _got(spark, rows) == brute(rows)


def test_shingles_are_of_whole_texts():
    assert len(near_dup.shingle_set(" ".join(map(str, range(1000))))) == 996
    assert np.array_equal(near_dup.shingle_set("A b c"), near_dup.shingle_set("a  B\tc"))


def _largest(df):
    """The most rows of one partition of a frame, and all of them."""
    n = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(n, default=0), sum(n)


def test_exact_copies_and_wordless_rows_are_dealt(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(near_dup, "HOT", 16)
    scratch = near_dup.Scratch(spark, "test")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(4000).select("id", F.when(F.col("id") % 10 < 6, F.lit("hot").cast("binary")).when(F.col("id") % 10 < 9, F.lit(None).cast("binary")).otherwise(F.col("id").cast("string").cast("binary")).alias("digest"))
        table = rows.where("digest is not null").select("digest").distinct().withColumn("name", F.col("digest").cast("string"))
        hot = near_dup._hot(rows.where("digest is not null").groupBy("digest").agg(F.count(F.lit(1)).alias("c")), "digest", "c", scratch)
        out = near_dup._deal(rows, "digest", table, hot, "left")
        most, n = _largest(out)
        assert n == 4000 and most < 0.5 * n
        assert out.where("digest is not null and name <> cast(digest as string)").count() == 0 and out.where("digest is null and name is not null").count() == 0
        assert near_dup._deal(rows, "digest", table, hot).count() == rows.where("digest is not null").count()
        one = near_dup._deal(rows, "digest", table, None, "left")
        assert one.count() == 4000
        # many rows on both sides of a key
        a = spark.range(3000).select(F.lit(1).alias("value"), F.col("id").alias("cls"), F.lit(8).alias("tasks"))
        b = spark.createDataFrame([(1, k, 8) for k in range(3)] + [(2, 9, 1)], "value int, b int, tasks int")
        met = near_dup._meet(a, b, ["value"], "tasks", "cls")
        assert met.count() == 9000 and met.select("cls", "b").distinct().count() == 9000
        most, n = _largest(met)
        assert most < 0.75 * n
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_nearly_all_rows_copies_or_without_words(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "HOT", 16)
    rng = random.Random(8)
    words = [f"w{k}" for k in range(500)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(60)
    docs = [(k, base) for k in range(300)] + [(1000 + k, rng.choice(["", None, " \t"])) for k in range(200)]
    for k in range(60):  # near copies around one text, and others
        w = base.split()
        w[rng.randrange(60)] = f"x{k}"
        docs.append((2000 + k, " ".join(w)))
        docs.append((3000 + k, text(40)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: (n, c, k) for i, n, c, k in brute(docs)}
