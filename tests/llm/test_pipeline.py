import os

import pytest

import corpus_pipeline
from lexspark.llm import decontaminate, near_dup, toxicity
from lexspark.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def test_stages_follow_their_operators(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    model = toxicity.train(docs, table(spark, SF, "labels"))
    want = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").collect()}
    one = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert one.columns == columns and {r.doc_id for r in one.collect()} == want
    two = corpus_pipeline.drop_near_duplicates(spark, one, SF)
    assert two.columns == columns and {r.doc_id for r in two.collect()} == {r.doc_id for r in near_dup.near_duplicates(one).where("kept").collect()}
    three = corpus_pipeline.drop_leaks(spark, two, SF)
    leaks = {r.doc_id for r in decontaminate.find_leaks(two, table(spark, SF, "benchmark")).collect()}
    assert three.columns == columns and {r.doc_id for r in three.collect()} == {r.doc_id for r in two.collect()} - leaks
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in three.collect())
    assert all(len(r.ids) == 4 * r.n_tokens for r in out)


def test_stages_take_nulls_repeats_and_nothing(spark):
    docs = table(spark, SF, "documents").limit(40)
    extra = spark.createDataFrame([(None, None, None, None, None), (None, "a b c d e f g", "en", "s", 1), (1, None, "en", "s", 0)], docs.schema)
    odd = docs.unionByName(docs).unionByName(extra)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).count() > 0
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_no_stage_loses_another_text_of_an_id_or_a_clean_null_row(spark):
    docs = table(spark, SF, "documents")
    rows = [(1, "alpha beta gamma delta one two three"), (1, "other words stand in this text of the id"), (None, "a row without id that nothing repeats here"), (None, None), (3, ""), (4, "word")]
    fields = [f.name for f in docs.schema]
    odd = spark.createDataFrame([tuple({"doc_id": i, "text": t}.get(f) for f in fields) for i, t in rows], docs.schema)
    both = docs.unionByName(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        both = stage(spark, both, SF)
    left = [(r.doc_id, r.text) for r in both.collect()]
    assert all(r in left for r in rows)


def test_a_language_without_labels_is_kept(spark):
    import random

    rng = random.Random(3)
    docs = table(spark, SF, "documents")
    fields = [f.name for f in docs.schema]
    texts = [" ".join("".join(chr(0x3B1 + rng.randrange(24)) for _ in range(rng.randrange(2, 9))) for _ in range(rng.choice([3, 40, 400, 2000]))) for _ in range(60)]
    greek = spark.createDataFrame([tuple({"doc_id": 10**6 + k, "text": t, "lang": "el"}.get(f) for f in fields) for k, t in enumerate(texts)], docs.schema)
    left = docs.unionByName(greek)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF)
    assert {r.doc_id for r in left.where("doc_id >= 1000000").collect()} == {10**6 + k for k in range(60)}


def test_the_whole_pipeline_equals_brute_force(spark, tmp_path):
    import base64
    import random

    import numpy as np
    import public_tokenizers
    import tiktoken

    from tests.llm.test_near_dup import brute
    from tests.llm.test_search import _brute_leaks

    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(150)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, text(rng.choice([6, 15, 20]))) for k in range(5)]
    docs = []
    for k in range(120):
        t = text(rng.randrange(25, 40))
        if k % 6 == 0:
            t += " horrible scum"
        if k % 10 == 3:
            t += " " + items[k % 5][1]
        docs.append((k, t))
        if k % 8 == 1:  # near and exact copies
            w = t.split() * 3
            docs[-1] = (k, " ".join(w))
            w[rng.randrange(len(w))] = "changed"
            docs.append((1000 + k, " ".join(w if k % 16 == 1 else t.split() * 3)))
    docs += [(2000, None), (2001, "")]
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int("scum" in (t or ""))) for i, t in docs], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    at = f"file://{tmp_path}"
    model = toxicity.train(table(spark, at, "documents"), table(spark, at, "labels"))
    scores = model.of_texts([t for _, t in docs])
    clean = [d for d, x in zip(docs, scores, strict=True) if x < 0.5]
    assert 60 < len(clean) < len(docs)
    kept = {i for i, _, _, keep in brute(clean) if keep}
    single = [(i, t) for i, t in clean if i in kept]
    leaky = {i for i, _ in _brute_leaks(single, items)}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {i: enc.encode_ordinary(t or "") for i, t in single if i not in leaky}
    assert len(single) < len(clean) and leaky and {2000, 2001} <= set(want)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in corpus_pipeline.run(spark, at).collect()}
    assert got == want
