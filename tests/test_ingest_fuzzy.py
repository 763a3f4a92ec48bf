"""Files that pass once, sinks that may run again, and fuzzy places with misreads anywhere."""

import random

from pyspark.sql import functions as F

from lexspark.operators import offsets
from lexspark.streaming import ingest


def _run(spark, inbox, out, cp):
    q = ingest.run(ingest.once(ingest.checked(ingest.landing(spark, str(inbox), 2))), ingest.exactly_once(str(out)), str(cp))
    assert q.awaitTermination(60) and q.exception() is None


def test_repeated_uploads_and_batches_change_nothing(spark, tmp_path):
    inbox, out, cp = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    inbox.mkdir()
    for k in range(5):
        (inbox / f"f{k}.pdf").write_bytes(b"content %d" % (k % 3))
    (inbox / "note.txt").write_bytes(b"no pdf")
    _run(spark, inbox, out, cp)
    hashes = lambda: sorted(r.sha256_source for r in ingest.landed(spark, str(out)).collect())
    first = hashes()
    assert len(first) == 3 and len(set(first)) == 3
    assert [r.error for r in ingest.landed(spark, str(out), "refused").collect()] == ["not_pdf"]
    # the same content comes again under another name, and something new
    (inbox / "again.pdf").write_bytes(b"content 1")
    (inbox / "new.pdf").write_bytes(b"content 9")
    _run(spark, inbox, out, cp)
    assert len(hashes()) == 4 and set(first) < set(hashes())
    # a batch that is handed over once more overwrites what it wrote
    rows = ingest.landed(spark, str(out)).where("batch = 0").drop("batch").withColumn("error", F.lit(None).cast("string")).collect()
    before = hashes()
    if rows:
        ingest.exactly_once(str(out))(spark.createDataFrame(rows, ingest.landed(spark, str(out)).drop("batch").schema), 0)
    assert hashes() == before


def _edits(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def test_banded_edits_are_edits():
    rng = random.Random(3)
    for _ in range(300):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
        b = "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
        for most in (0, 2, 5, 20):
            assert offsets.banded(a, b, most) == min(_edits(a, b), most + 1)


def test_anchors_are_the_longest_growing_chain():
    rng = random.Random(4)
    for _ in range(100):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(40))) for _ in range(2))
        got = offsets.anchors(a, b, 3)
        single = lambda t: {t[k : k + 3]: k for k in range(len(t) - 2) if t.count(t[k : k + 3]) == 1 and t.find(t[k : k + 3], t.find(t[k : k + 3]) + 1) < 0}
        pairs = sorted((k, single(a)[g]) for g, k in single(b).items() if g in single(a))
        best = [1] * len(pairs)
        for i in range(len(pairs)):
            best[i] = 1 + max((best[j] for j in range(i) if pairs[j][1] < pairs[i][1]), default=0)
        assert len(got) == max(best, default=0) and set(got) <= set(pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


def test_places_with_misreads_anywhere(spark):
    rng = random.Random(6)
    words = ["licitação", "contrato", "prazo", "agente", "público", "administração", "edital", "recurso", "sanção", "objeto", "valor", "execução"]
    sentence = lambda n: " ".join(rng.choice(words) + str(rng.randrange(100)) for _ in range(n))
    rows, want = [], {}
    for k in range(120):
        before, own, after = sentence(20), f"{sentence(rng.randrange(6, 40))}.", sentence(15)
        parent = f"Art. {k}. {before};\nI - {own}\nII - {after}"
        child = list(f"I - {own}")
        if k % 3:  # misreads from the first letter on, lost and doubled letters
            for at in rng.sample(range(len(child)), max(1, len(child) // 30)) + ([0, 1] if k % 3 == 1 else []):
                child[at] = rng.choice(["x", "", child[at] * 2])
        rows.append((k, parent, "".join(child)))
        want[k] = parent.index(f"I - {own}")
    rows += [(1000, rows[0][1], "nada disso consta aqui em parte alguma do texto"), (1001, None, "x"), (1002, "x", None), (1003, "x", " "), (1004, "um dois", "dois"), (1005, "dois dois", "dois"), (1006, "palavra " * 50_000 + "fim do texto longo", "fim do texto longo")]
    got = {r.k: r.f for r in spark.createDataFrame(rows, "k int, p string, c string").select("k", offsets.fuzzy(F.col("p"), F.col("c")).alias("f")).collect()}
    near = [k for k in want if got[k].start is not None and abs(got[k].start - want[k]) <= 4]
    assert len(near) >= 118 and all(got[k].start == want[k] and got[k].similarity == 1.0 for k in want if k % 3 == 0)
    assert all(rows[k][1][got[k].end :].startswith("\nII - ") for k in near)
    assert all(got[k].start is None for k in (1000, 1001, 1002, 1003, 1005))
    assert (got[1004].start, got[1004].end) == (3, 7) and got[1006].start == 400_000
