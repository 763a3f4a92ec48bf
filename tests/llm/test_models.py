import random
import re
import zlib

import pytest

from lexspark.llm import quotes, toxicity


def _text(rng, toxic, group=None):
    w = [f"palavra{rng.randrange(400)}" for _ in range(40)]
    if toxic:
        w[rng.randrange(40)] = rng.choice(["horrível", "imprestável", "horríveis"])
    if group:
        w[rng.randrange(40)] = group
    return " ".join(w)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    rows = [(k, _text(rng, k % 6 == 0), int(k % 6 == 0)) for k in range(1500)]
    docs = spark.createDataFrame([(i, t, 0.0) for i, t, _ in rows] + [(-1, None, 0.0), (-2, "", 0.0), (None, "palavra1", 0.0), (3, rows[3][1], 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    return docs, labels, {i: y for i, _, y in rows}


def test_held_out_accuracy_and_edges(labelled):
    docs, labels, truth = labelled
    out = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(out) == docs.count()
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert 200 < len(held) < 420 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    for r in out:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    assert all(r.predicted == 0 for r in out if r.doc_id in (-1, -2))
    assert toxicity.score(docs.limit(0), toxicity.Model(*_blank())).count() == 0


def _blank():
    import numpy as np

    return np.zeros(0, np.int64), np.zeros(0), -2.0


def test_a_group_mention_alone_moves_the_score_less(labelled):
    rng = random.Random(8)
    # labels in which one group is mentioned in toxic texts far more often than the others
    rows = [(_text(rng, True, "muslim" if rng.random() < 0.8 else "hindu"), 1) for _ in range(150)] + [(_text(rng, False, "muslim" if rng.random() < 0.1 else "christian"), 0) for _ in range(600)]
    texts, ys = [t for t, _ in rows], [y for _, y in rows]
    probes = [(_text(rng, False, "muslim"), None) for _ in range(60)]
    gap = []
    for weight in (0.0, 20.0):
        m = toxicity.fit(texts, ys, [1.0] * len(ys), weight)
        make = toxicity.Known(m)
        logit = lambda t, m=m, make=make: m.evidence([make(toxicity.tokens(t))])[0]
        gap.append(sum(abs(logit(t) - logit(t.replace("muslim", "christian"))) for t, _ in probes) / len(probes))
    assert gap[1] < 0.5 * gap[0]


def test_the_order_of_rows_changes_nothing(spark, labelled):
    docs, labels, _ = labelled
    one, two = toxicity.train(docs, labels), toxicity.train(docs.repartition(7).orderBy("text"), labels.orderBy("toxic", "doc_id"))
    assert len(one.weights) and (one.features == two.features).all() and (one.weights == two.weights).all() and one.bias == two.bias
    rng = random.Random(1)
    rows = [(_text(rng, k % 5 == 0, "hindu" if k % 3 else None), k % 5 == 0) for k in range(200)]
    a = toxicity.fit([t for t, _ in rows], [int(y) for _, y in rows], [1.0] * 200)
    rng.shuffle(rows)
    b = toxicity.fit([t for t, _ in rows], [int(y) for _, y in rows], [1.0] * 200)
    assert len(a.weights) and (a.weights == b.weights).all() and a.bias == b.bias


def test_short_texts_score_near_the_base_rate(spark):
    rng = random.Random(6)
    word = lambda k: "".join(chr(97 + int(d)) for d in str(k)) + "um"
    texts = [[word(rng.randrange(400)) for _ in range(rng.randrange(20, 60))] + ["the"] + ["horrible"] * (k % 6 == 0) for k in range(1200)]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    m = toxicity.train(docs, spark.createDataFrame([(k, int(k % 6 == 0)) for k in range(1200)], "doc_id long, toxic int"))
    short = spark.createDataFrame([(1, None), (2, ""), (3, "the"), (4, "neverseen"), (5, "12 !"), (6, "the " + word(7))], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(short, m).collect()}
    assert got[1] == got[2] == got[5] and 0.1 < got[1] < 0.25 and all(x < 0.5 for x in got.values())
    assert toxicity.keep_clean(short, m).count() == 6


def test_scores_equal_the_sum_over_distinct_features(labelled):
    docs, labels, _ = labelled
    m = toxicity.train(docs, labels)
    weight = dict(zip(m.features.tolist(), m.weights.tolist(), strict=True))
    assert 0 < len(weight) < 50
    for r in toxicity.score(docs, m).join(docs.select("doc_id", "text"), "doc_id").limit(300).collect():
        z = m.bias + sum(weight.get(int(f), 0.0) for f in toxicity.Features()(toxicity.tokens(r.text)))
        assert abs(r.score - 1 / (1 + 2.718281828459045**-z)) < 1e-6


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_unknown_vocabulary_keeps_the_base_rate_at_any_length(spark, sf):
    from lexspark.llm.common import table

    at = f"/root/testdata/{sf}"
    docs, labels = table(spark, at, "documents"), table(spark, at, "labels")
    m = toxicity.train(docs, labels)
    base = 1 / (1 + 2.718281828459045**-m.bias)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 10)))
    cyrillic = lambda: "".join(chr(0x430 + rng.randrange(32)) for _ in range(rng.randrange(3, 10)))
    texts = [" ".join(w() for _ in range(n)) for n in (1, 2, 10, 100, 1000, 10_000) for w in (word, cyrillic) for _ in range(4)]
    got = [r.score for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), m).collect()]
    assert base < 0.3 and all(x < 0.5 for x in got) and sum(abs(x - base) < 0.02 for x in got) >= len(got) - 2
    share = labels.where("toxic = 1").count() / labels.where("toxic is not null").count()
    assert toxicity.score(docs, m).where("predicted = 1").count() <= 2 * share * docs.count()


def test_the_cut_is_the_best_of_all(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(50):
        n = int(rng.integers(4, 40))
        y = (rng.random(n) < 0.4).astype(float)
        y[:2] = 0, 1
        z, sw = np.round(y + rng.normal(size=n), 1), rng.choice([1.0, 3.0], n)

        def f1(c, z=z, y=y, sw=sw):
            on = z >= c
            if sw[on].sum() > toxicity.MOST_FLAGGED * sw[y == 1].sum():
                return -1.0
            return 2 * sw[on & (y == 1)].sum() / (sw[on].sum() + sw[y == 1].sum())

        gaps = sorted({*z.tolist()})
        cuts = [gaps[0] - 1, *[(a + b) / 2 for a, b in zip(gaps, gaps[1:])], gaps[-1] + 1]
        assert f1(toxicity._cut(z, y, sw)) >= max(map(f1, cuts)) - 1e-9


def test_repeated_ids_and_bound_of_features(spark, labelled):
    docs, labels, _ = labelled
    many = docs.unionByName(docs.where("doc_id = 7")).unionByName(spark.createDataFrame([(7, "zzz other text", 0.0)], docs.schema))
    one, two = toxicity.train(docs, labels), toxicity.train(many, labels)
    assert one.bias == two.bias and len(one.weights) and (one.weights == two.weights).all()  # of several texts the smallest counts
    assert toxicity.train(docs, labels, features=20_000).weights.any()


def test_one_class_and_no_labels(spark, labelled):
    docs, labels, _ = labelled
    m = toxicity.train(docs, labels.where("toxic = 0"))
    assert {r.predicted for r in toxicity.score(docs, m).collect()} == {0}
    m = toxicity.train(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(docs, m).collect()} == {0}


def test_filter_keeps_columns_and_clean_rows(labelled):
    docs, labels, truth = labelled
    m = toxicity.train(docs, labels)
    kept = toxicity.keep_clean(docs, m)
    assert kept.columns == docs.columns
    want = sorted(str(r.doc_id) for r in toxicity.score(docs, m).where("predicted = 0").collect())
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


# --- quotations -------------------------------------------------------------------------------
CHAT = [
    (1, 0, "user", "The first line of the question.\nAnother line that can be quoted."),
    (1, 1, "assistant", "> The first line  of the question.\nMy answer to that line."),
    (1, 2, "user", ">> The first line of the question.\n> my ANSWER to that line.\nThanks for it."),
    (1, 3, "assistant", "On Monday user wrote:\n> Another line that can be quoted.\nSecond reply."),
    (1, 4, "user", "Nothing quoted, a > b holds."),
    (1, 5, "user", "> A line that nobody wrote before.\nOk then."),
    (1, 6, "user", "> > > Thanks for it.\n> Second reply.\nLast words."),
    (2, 0, "user", "My answer to that line."),
    (2, 1, "user", "> The first line of the question.\nOther conversation."),
    (3, 0, "user", None),
    (3, 1, "user", ""),
    (None, 0, "user", "> My answer to that line."),
    (4, None, "user", "> x"),
]


def test_threads(spark):
    df = spark.createDataFrame([(*r, 9) for r in CHAT], "conv_id long, turn long, role string, text string, depth int")
    got = {(r.conv_id, r.turn): r for r in quotes.thread(df).collect()}
    assert len(got) == len(CHAT)
    parents = {k: r.parent_turn for k, r in got.items() if r.parent_turn is not None}
    assert parents == {(1, 1): 0, (1, 2): 1, (1, 3): 0, (1, 6): 3}
    assert {k: (r.root_turn, r.depth) for k, r in got.items() if k in parents} == {(1, 1): (0, 1), (1, 2): (0, 2), (1, 3): (0, 1), (1, 6): (0, 2)}
    assert got[1, 3].text_clean == "Second reply." and got[1, 2].text_clean == "Thanks for it." and got[1, 4].text_clean == "Nothing quoted, a > b holds."
    assert (got[1, 5].n_quoted, got[1, 5].n_linked) == (1, 0) and got[2, 1].n_linked == 0 and got[1, 6].n_linked == 2
    order = [(r.conv_id, r.turn) for r in quotes.reply_ordered(quotes.thread(df)).collect() if r.conv_id == 1]
    assert order == [(1, 0), (1, 1), (1, 2), (1, 3), (1, 6), (1, 4), (1, 5)]
    assert quotes.thread(df.limit(0)).count() == 0


def test_long_chain_of_replies(spark):
    rows = [(1, k, "user", (f"> message number {k - 1} says something\n" if k else "") + f"message number {k} says something") for k in range(70)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quotes.thread(df).collect()
    assert all(r.root_turn == 0 and r.depth == r.turn for r in got)


def test_short_quotes_link_where_their_owner_is_unique(spark):
    rows = [(1, 0, "Shall we?"), (1, 1, "Yes."), (1, 2, "No."), (1, 3, "No."), (1, 4, "> Yes.\nFine, so we do."), (1, 5, "> No.\nWhy is that so?"), (1, 6, "---"), (1, 7, "> ---\nNothing said.")]
    df = spark.createDataFrame([(c, k, "user", t) for c, k, t in rows], "conv_id long, turn long, role string, text string")
    assert {r.turn: r.parent_turn for r in quotes.thread(df).collect() if r.parent_turn is not None} == {4: 1}


def test_a_lone_carriage_return_ends_a_line(spark):
    rows = [(0, "A question that is long enough.\rSecond line here too."), (1, "> A question that is long enough.\rMy own answer"), (2, "> My own answer\r\n> \rThanks\rfor it")]
    df = spark.createDataFrame([(1, k, "user", t) for k, t in rows], "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in quotes.thread(df).collect()}
    assert got[1].text_clean == "My own answer" and got[2].text_clean == "Thanks\nfor it"
    assert (got[1].parent_turn, got[2].parent_turn) == (0, 1)


def test_very_long_message_and_repeated_turns(spark):
    long = "\n".join(f"Line number {k} of a very long message." for k in range(20_000))
    rows = [(1, 0, "user", long), (1, 1, "user", "> Line number 17345 of a very long message.\nThat one."), (1, 1, "user", "> Line number 3 of a very long message.\nAgain."), (1, 2, "user", "> That one.\nNo.")]
    got = quotes.thread(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r.turn, r.parent_turn, r.text_clean[:9]) for r in got if r.turn) == [(1, 0, "Again."), (1, 0, "That one."), (2, 1, "No.")]


def test_rewrapped_paragraphs_and_cut_sentences_link(spark):
    import textwrap

    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(300)]
    sentence = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(5, 14))).capitalize() + rng.choice([".", "!", "?", '."'])
    rows, want = [], {}
    for conv in range(30):
        said = []
        for turn in range(8):
            body = [[sentence() for _ in range(rng.randrange(2, 7))] for _ in range(rng.randrange(1, 4))]
            text = "\n\n".join(textwrap.fill(" ".join(p), rng.choice([40, 70, 10_000])) for p in body)
            if turn and rng.random() < 0.8:
                of = rng.randrange(turn)
                p = rng.choice(said[of])
                how = rng.randrange(4)
                part = [rng.choice(p)] if how == 0 else p[rng.randrange(len(p)) :]
                if how == 3 and len(part) > 1:  # begins within a sentence
                    part = [part[0].split(" ", 2)[-1], *part[1:]]
                quote = "\n".join("> " + x for x in textwrap.wrap(" ".join(part).upper(), rng.choice([25, 60, 5000])))
                text = f"Someone wrote:\n{quote}\n\n{text}" if rng.random() < 0.5 else f"{text}\n{quote}"
                if how != 3 or len(part) > 1:
                    want[conv, turn] = of
            said.append(body)
            rows.append((conv, turn, "user", text))
    got = {(r.conv_id, r.turn): r for r in quotes.thread(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert len(want) > 120 and {k: got[k].parent_turn for k in want} == want
    assert all(r.parent_turn is None for k, r in got.items() if k not in want and ">" not in dict(((c, n), t) for c, n, _, t in rows)[k])
    assert all(r.n_linked <= r.n_quoted for r in got.values())


def test_passages_against_plain_reading():
    rng = random.Random(5)
    bits = ["> ", ">> ", "One two. ", "Three four five? ", "six", "\n", "\n\n", "  ", "\r\n", "\r", "e.g. this", '"Seven eight." ', "…", "\t"]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(0, 25)))
        plain = [(len(re.match(r"\s*((?:>\s*)*)", x)[1].replace(" ", "").replace("\t", "")), " ".join(re.sub(r"^\s*(?:>\s*)*", "", x).split()).lower()) for x in re.split("\r\n|\r|\n", text)]
        got = list(quotes.passages(text))
        assert [(k, v) for k, v, _, _, _, rank in got if rank == 0] == [(k, v) for k, (v, x) in enumerate(plain) if x]
        want, k = set(), 0
        while k < len(plain):
            j = k
            while j < len(plain) and plain[j][1] and plain[j][0] == plain[k][0]:
                j += 1
            whole = " ".join(x for _, x in plain[k:j])
            for said in re.split(r"(?<=[.!?…])(?: )|(?<=[.!?…][\"'”’»)\]]) ", whole) if whole else ():
                want.add(quotes._hashed(said.strip())[0])
            k = max(j, k + 1)
        assert {h for _, _, own, h, _, rank in got} == want | {own for _, _, own, _, _, _ in got}
