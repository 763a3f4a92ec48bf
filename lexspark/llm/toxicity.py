"""Toxicity by a counterfactual-regularised classifier.

A logistic model on hashed words and word beginnings that go with the labels beyond chance. For labelled texts that mention a group, the
same text with another group's term is made, and the squared change of the score between the two
is penalised, so the mention itself neither raises nor lowers a score.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bound_batches

#: Word beginnings that count as features, so inflected forms share their stem.
STEMS = (5, 7)
#: Labelled rows of each class that a model is fitted on, at most (the bound of the training sample).
PER_CLASS = 3000
#: Features of the sampled rows of a class that the driver takes, at most: 128 MB.
FEATURES = 1 << 24
#: Highest logit of a base rate, and the least evidence that may ever outweigh it.
MOST_BASE, LEAST_EVIDENCE = -0.2, 0.25
#: A feature counts if as many texts have it and its share of toxic ones is as many standard errors off the sample's.
LEAST_TEXTS, LEAST_Z = 3, 4.5
#: Of all held-back rows, as many times the labelled share may score one half or more.
MOST_FLAGGED = 1.5
#: Weight of the squared score change under a swap, and of the squared weights.
COUNTERFACTUAL, RIDGE, ROUNDS = 1.0, 1e-4, 200
#: Terms that name groups of people, by kind; a term is swapped for others of its kind.
IDENTITY = (
    "women men girls boys woman man female male femmes hommes frauen männer mujeres hombres".split(),
    "black white asian latino arab african european indigenous noir blanc schwarz weiß negro blanco".split(),
    "muslim christian jewish hindu buddhist atheist musulman chrétien juif christlich jüdisch muslimisch cristiano judío musulmán".split(),
    "gay straight lesbian bisexual transgender homosexual heterosexual".split(),
    "immigrant native foreigner refugee migrant citizen".split(),
    "disabled blind deaf autistic elderly young old".split(),
)
_KIND = {t: k for k, terms in enumerate(IDENTITY) for t in terms}
_words = re.compile(r"[^\W\d_]+").findall
_CACHE = 100_000


class Features:
    """Distinct feature numbers of a text: 64-bit hashes of words and of their beginnings."""

    def __init__(self):
        self.of: dict[str, tuple[int, ...]] = {}

    def _learn(self, w: str) -> tuple[int, ...]:
        raw = [xxhash.xxh3_64_intdigest(w.encode())] + [xxhash.xxh3_64_intdigest(w[:n].encode(), seed=n) for n in STEMS if len(w) >= n]
        return tuple(x >> 1 for x in raw)

    def __call__(self, words: set[str]) -> np.ndarray:
        new = words.difference(self.of)
        if len(self.of) + len(new) > _CACHE:
            self.of.clear()
            new = words
        self.of.update((w, self._learn(w)) for w in new)
        return np.unique(np.fromiter(chain.from_iterable(map(self.of.__getitem__, words)), np.int64))


class Known(Features):
    """Places of a text's features in a model, those alone that it has."""

    def __init__(self, model: Model):
        super().__init__()
        self.place = {f: k for k, f in enumerate(model.features.tolist())}

    def _learn(self, w: str) -> tuple[int, ...]:
        return tuple(self.place[f] for f in super()._learn(w) if f in self.place)


def tokens(text: str | None) -> set[str]:
    return set(_words((text or "").lower()))


def swaps(words: set[str], rng: random.Random) -> set[str] | None:
    """The words of a text with each group term replaced by another of its kind; None without such terms."""
    own = [w for w in words if w in _KIND]
    if not own:
        return None
    out = set(words).difference(own)
    for w in sorted(own):
        out.add(rng.choice([t for t in IDENTITY[_KIND[w]] if t != w]))
    return out


class Model:
    """A text's logit: the bias, which is that of the base rate, and the weights of those of its features that the model has.

    What a model has not seen says nothing: such a text scores the base rate, however long it is.
    """

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features, weights, bias

    def evidence(self, rows: list[np.ndarray]) -> np.ndarray:
        """Sums of weights of texts, from the places of their features, by one product with a sparse matrix of ones."""
        of = self.weights[np.concatenate([*rows, np.zeros(0, np.int64)])]
        return np.bincount(np.repeat(np.arange(len(rows)), [len(r) for r in rows]), of, len(rows))

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + self.evidence(rows), -700, 700)))

    def places(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Feature numbers as places; those that the model lacks are left out."""
        if not len(self.features):
            return [np.zeros(0, np.int64)] * len(rows)
        at = [np.minimum(np.searchsorted(self.features, r), len(self.features) - 1) for r in rows]
        return [k[self.features[k] == r] for k, r in zip(at, rows, strict=True)]

    def of_texts(self, texts: list[str | None]) -> np.ndarray:
        make = Known(self)
        return self.scores([make(tokens(t)) for t in texts])


def featured(text: str | None, make: Features) -> tuple[np.ndarray, np.ndarray | None]:
    """Features of a text, and of the same text with other group terms; the text alone decides which."""
    words = tokens(text)
    swapped = swaps(words, random.Random(xxhash.xxh3_64_intdigest((text or "").encode())))
    return make(words), None if swapped is None else make(swapped)


def fit(texts: list[str | None], labels: list[int], weights: list[float], counterfactual: float = COUNTERFACTUAL) -> Model:
    """A model of labelled texts. Their order changes nothing."""
    key = [xxhash.xxh3_64_intdigest((t or "").encode()) for t in texts]
    order = sorted(range(len(texts)), key=lambda k: (key[k], labels[k], weights[k]))
    make = Features()
    made = [featured(texts[k], make) for k in order]
    return fit_features([r for r, _ in made], [o for _, o in made], [labels[k] for k in order], [weights[k] for k in order], [key[k] & 1 for k in order], counterfactual)


def fit_features(rows: list[np.ndarray], others: list[np.ndarray | None], labels: list[int], weights: list[float], halves: list[int], counterfactual: float = COUNTERFACTUAL) -> Model:
    """A model whose score of one half is the cut that tells held-back training rows apart best.

    The bias stays at the base rate. Two models, each fitted on one half of the rows, weigh the
    other half; the evidence at the best cut there is scaled to make up for the bias, no more and no
    less, so a text without evidence keeps the base rate.
    """
    y, sw, half = np.array(labels, float), np.array(weights, float), np.array(halves, int)
    every = np.array([k for k in range(len(rows)) if len(rows[k])], int)  # texts without words teach nothing
    whole = _solve(rows, others, every, y, sw, counterfactual)
    z = np.zeros(len(rows))
    for side in (0, 1):
        a, b = every[half[every] == side], every[half[every] != side]
        if not len(b) or len(set(y[a])) < 2:
            return whole
        part = _solve(rows, others, a, y, sw, counterfactual)
        z[b] = part.evidence(part.places([rows[k] for k in b]))
    return Model(whole.features, whole.weights * (-whole.bias / max(_cut(z[every], y[every], sw[every]), LEAST_EVIDENCE)), whole.bias)


def _cut(z: np.ndarray, y: np.ndarray, sw: np.ndarray, most: float = MOST_FLAGGED) -> float:
    """The cut of evidence with the highest weighted F1, in the middle of the widest gap that has it, among those that flag at most ``most`` times the labelled share."""
    order = np.argsort(z)
    z, pos, neg = z[order], (sw * (y == 1))[order], (sw * (y == 0))[order]
    hit = pos.sum() - np.concatenate([[0], np.cumsum(pos)])
    false = neg.sum() - np.concatenate([[0], np.cumsum(neg)])
    f1 = 2 * hit / np.maximum(hit + false + pos.sum(), 1e-9)
    low, high = np.concatenate([[z[0] - 1], z]), np.concatenate([z, [z[-1] + 1]])
    f1[(hit + false > most * pos.sum()) | (low == high)] = -1  # no cut parts equal rows
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    k = best[np.argmax((high - low)[best])]
    return float((low[k] + high[k]) / 2)


def _solve(rows: list[np.ndarray], others: list[np.ndarray | None], own: np.ndarray, y: np.ndarray, sw: np.ndarray, counterfactual: float) -> Model:
    """Full-batch Adam on the weighted log loss, the ridge and the counterfactual penalty, over the logit of the base rate.

    With one class only, the base rate.
    ``rows`` are the features of each text, ``others`` those of its swapped form; ``own`` the texts to fit.
    """
    y, sw = y[own], sw[own]
    if len(set(y)) < 2:
        rate = min(max(float(y.mean()) if len(y) else 0.0, 0.01), 0.99)
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(rate / (1 - rate))))
    mine, swapped = [rows[k] for k in own], [others[k] for k in own]
    # only features that go with the labels beyond chance: the many rare ones of a small sample would add up to noise
    used, place, times = np.unique(np.concatenate(mine), return_inverse=True, return_counts=True)
    toxic = np.bincount(place, np.repeat(y, [len(r) for r in mine]), len(used))
    off = np.abs(toxic - times * y.mean()) / np.sqrt(times * y.mean() * (1 - y.mean()))
    model = Model(used[(times >= LEAST_TEXTS) & (off >= LEAST_Z)], np.zeros(0), 0.0)
    placed = model.places(mine)
    col, row = np.concatenate(placed), np.repeat(np.arange(len(mine)), [len(r) for r in placed])
    # differences of swapped texts: +1 what the text has alone, -1 what its counterpart has alone
    d_col, d_row, d_val, n_diff = [], [], [], 0
    for r, o in zip(mine, swapped, strict=True):
        if o is not None:
            for fs, v in ((np.setdiff1d(r, o), 1.0), (np.setdiff1d(o, r), -1.0)):
                fs = model.places([fs])[0]
                d_col.append(fs), d_row.append(np.full(len(fs), n_diff)), d_val.append(np.full(len(fs), v))
            n_diff += 1
    if n_diff:
        d_col, d_row, d_val = map(np.concatenate, (d_col, d_row, d_val))
    n, f, total = len(mine), len(model.features), sw.sum()
    w, b = np.zeros(f), min(float(np.log((sw @ y + 1) / (sw @ (1 - y) + 1))), MOST_BASE)
    m = v = np.zeros(f)
    for step in range(1, ROUNDS + 1):
        z = b + np.bincount(row, w[col], minlength=n)
        g = sw * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / total
        grad = np.bincount(col, g[row], minlength=f) + RIDGE * w
        if n_diff:
            change = np.bincount(d_row, d_val * w[d_col], minlength=n_diff)
            grad += np.bincount(d_col, 2 * counterfactual / n_diff * change[d_row] * d_val, minlength=f)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-12)
    return Model(model.features, w, b)


def _fold(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS, features: int = FEATURES) -> Model:
    """Fit on labelled rows outside the held-out fold: at most ``per_class`` of each class, chosen by a hash of the id.

    The classes' true sizes weight the sample, so scores keep the base rate. A document labelled
    more than once counts as its highest label; null labels, ids and unlabelled rows are left out. Of
    several texts of one id the smallest counts. Features are made on the executors; the driver gets
    those of the rows that come first by the hash, ``features`` numbers of each class at most.
    """
    bound_batches(docs.sparkSession)
    own = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (_fold(id_col) != 0)).groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    own = own.where("y in (0, 1)").select(F.col(id_col).alias("__id"), "y", F.xxhash64(id_col).alias("o"))
    size = {r["y"]: r["n"] for r in own.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    # at most per_class rows of each class
    few = own.where("y = 0").orderBy("o", "__id").limit(per_class).unionByName(own.where("y = 1").orderBy("o", "__id").limit(per_class))
    got = docs.select(F.col(id_col).alias("__i"), F.col(text_col).alias("t")).join(F.broadcast(few), F.col("__i") == F.col("__id")).groupBy("__id", "y", "o").agg(F.min("t").alias("t"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Features()
        for b in batches:
            made = [featured(t, make) for t in b["t"].tolist()]
            n = [len(r) + (0 if o is None else len(o)) for r, o in made]
            yield pd.DataFrame({"id": b["id"], "y": b["y"], "o": b["o"], "n": n, "r": [r.tobytes() for r, _ in made], "s": [None if o is None else o.tobytes() for _, o in made]})

    made = got.select(F.col("__id").cast("string").alias("id"), "y", "o", "t").mapInPandas(run, "id string, y int, o long, n long, r binary, s binary")
    so_far = F.sum("n").over(Window.partitionBy("y").orderBy("o", "id"))
    rows = sorted(made.withColumn("held", so_far).where(F.col("held") <= features).collect(), key=lambda r: (r["o"], r["id"]))
    n = Counter(r["y"] for r in rows)
    array = lambda x: None if x is None else np.frombuffer(x, np.int64)
    return fit_features([array(r["r"]) for r in rows], [array(r["s"]) for r in rows], [r["y"] for r in rows], [size[r["y"]] / n[r["y"]] for r in rows], [r["o"] & 1 for r in rows])


def _scorer(spark, model: Model):
    """Scores of a batch's texts, on executors; the model is broadcast once: at most a third of ``2 * FEATURES`` numbers and weights."""
    shared = spark.sparkContext.broadcast((model.features, model.weights.astype(np.float32), model.bias))
    state: dict = {}

    def scores(texts: list[str | None]) -> np.ndarray:
        if not state:
            features, weights, bias = shared.value
            state["model"] = Model(features, weights.astype(float), bias)
            state["make"] = Known(state["model"])
        out = [state["model"].scores([state["make"](tokens(t)) for t in texts[at : at + 256]]) for at in range(0, len(texts), 256)]
        return np.concatenate([*out, np.zeros(0)])

    return scores


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of whole texts by a fitted model: doc_id, held_out, score, predicted. A narrow scan.

    Null and empty texts, and those of words that the model has not, score the base rate of the labelled
    rows, however long they are; it is below one half unless all labels are 1. A very long text counts by its distinct words. A
    null id counts as held out; repeated rows stay; an empty table gives no rows; other columns are
    ignored.
    """
    bound_batches(docs.sparkSession)
    scores = _scorer(docs.sparkSession, model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"i": b["i"], "held_out": b["h"], "score": scores(b["t"].tolist())})

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("i"), F.coalesce(_fold(id_col) == 0, F.lit(True)).alias("h"), F.col(text_col).alias("t"))
    out = src.mapInPandas(run, f"i {kind}, held_out boolean, score double")
    return out.select(F.col("i").alias("doc_id"), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows whose text scores below one half, all columns kept, in one narrow scan."""
    bound_batches(docs.sparkSession)
    scores = _scorer(docs.sparkSession, model)

    @F.pandas_udf("boolean")
    def rejected(t: pd.Series) -> pd.Series:
        return pd.Series(scores(t.tolist()) >= 0.5)

    return docs.where(~rejected(F.col(text_col)))
