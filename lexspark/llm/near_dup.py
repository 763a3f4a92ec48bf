"""Near-duplicate documents by bottom-k sketches of one hash function.

Words lie between ASCII white space, with A-Z lowered; a document's set holds its distinct
five-word shingles as 64-bit hashes. Stages:

1. Documents with equal sets are one class; everything below works on classes.
2. Inverted lists of the ``KEYS`` smallest retained values. Two sets with a similarity of 0.85
   share none of them with a probability below 0.15 ** KEYS. A list of at most ``LIGHT`` classes
   gives its pairs.
3. Classes with a value on a longer list are taken further: of their whole sketch, the values that
   are rarest among such classes make the lists (prefix filter: two sketches that overlap by
   ``OVERLAP`` must meet in the ``SKETCH - OVERLAP + 1`` rarest). A passage that many documents
   hold is frequent, so it makes no list unless a document consists of little else.
4. Classes still on long lists are large groups of near copies. There the prefix filter runs on the
   full sets, and values that no other class holds bound the similarity of each pair from above.
   A list links its classes to one pivot first. A class that stays outside the pivot's component can
   only be linked to one that shares some of the values which the pivot lacks, and those are rare:
   they are looked up in the full sets. So a group costs rows in proportion to its size.
5. Union sketches estimate each pair's similarity and drop hopeless pairs, of short lists and of
   large groups alike; full sets decide.
6. Components by hash-to-minimum label propagation with pointer jumping.

Values, pivots, labels and sets that many rows name are hot keys: ``_deal`` joins them apart,
``_meet`` deals one side of a join of two lists, and ``_beside`` the pairs of a frequent member, over several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, bound_batches

WORDS = 5
#: Retained values of a set; those that make the first lists; the least overlap of two sketches at
#: the threshold (missed with a probability of 5e-9 at the very threshold); classes of a short list.
SKETCH, KEYS, OVERLAP, LIGHT = 64, 16, 34, 32
#: A class is named by its smallest doc_id; one of null ids alone, or of an id that has several texts, by a number from here on.
NO_ID = 1 << 62
#: A key is hot if it has more than HOT rows and is among the SHARE most frequent.
HOT, SHARE = 1024, 10_000

_ONE, _TWO, _SPREAD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _ONE
    h = (h ^ (h >> np.uint64(27))) * _TWO
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; one of the whole sequence if it is shorter."""
    w = (text or "").encode().lower().split()  # bytes: lowers A-Z only, splits at ASCII white space
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    n = min(words, len(h))
    out = _mix(h[: len(h) - n + 1] + np.uint64(n))
    for j in range(1, n):
        out = _mix(out * _SPREAD + h[j : len(h) - n + 1 + j])
    return np.unique(out)


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, th: hash of the text, n: set size, digest: of the set, sketch: its smallest values)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingle_set(t) for t in b["t"].tolist()]
            yield pd.DataFrame({
                "doc_id": pd.arrays.IntegerArray(b["i"].to_numpy(np.int64).copy(), b["null"].to_numpy(bool).copy()),
                "th": b["th"], "n": [len(s) for s in sets], "digest": [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                # in the order of unsigned values: the smallest hashes
                "sketch": [_signed(s[:SKETCH]) for s in sets],
            })

    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("i"), F.col(id_col).isNull().alias("null"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("th"))
    return src.mapInPandas(run, "doc_id long, th long, n long, digest binary, sketch array<long>")


def _pairs_of(lists: DataFrame) -> DataFrame:
    """Pairs within short lists (value, cls): a list is gathered only if it has at most LIGHT classes."""
    got = lists.groupBy("value").agg(F.sort_array(F.collect_set("cls")).alias("m"))
    a = got.select("m", F.posexplode("m").alias("k", "a"))
    return a.select("a", F.explode(F.slice("m", F.col("k") + 2, F.size("m"))).alias("b"))


def _hot(counts: DataFrame, key: str, count: str, scratch: Scratch) -> DataFrame | None:
    """Keys with more than HOT rows, the SHARE most frequent at most, so that any other has less than one row in SHARE; None if there are none."""
    hot = scratch.keep(counts.where(F.col(count) > HOT).orderBy(F.desc(count)).limit(SHARE).select(key, count))
    return hot if hot.count() else None


def _deal(rows: DataFrame, key: str, table: DataFrame, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """``rows`` joined with a table of one row a key, such that no task gets all rows of a hot key, nor all rows without key.

    The table's rows of hot keys, SHARE at most, are broadcast. Then the rows of hot keys need nothing
    more: they go through the shuffle of the others dealt by a hash of the row.
    """
    names = [c for c in table.columns if c != key]
    salt = F.lit(1) + F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20))
    far = table.select(key, F.lit(0).cast("long").alias("__salt"), F.struct(*names).alias("__far"))
    if hot is None:
        out, found, dealt = rows, F.col("__far"), F.col(key).isNull()
    else:
        hot = hot.select(key)
        near = table.join(F.broadcast(hot), key, "left_semi").select(key, F.struct(*names).alias("__near"))
        out = rows.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), key, "left").join(F.broadcast(near), key, "left")
        found, dealt = F.coalesce("__near", "__far"), F.coalesce("__hot", F.lit(False)) | F.col(key).isNull()
    if how == "inner":
        out = out.where(F.col(key).isNotNull())
    both = out.withColumn("__salt", F.when(dealt, salt).otherwise(0)).join(far, [key, "__salt"], "left").select(*rows.columns, found.alias("__x"))
    return (both.where("__x is not null") if how == "inner" else both).select(*rows.columns, "__x.*")


def _meet(rows: DataFrame, table: DataFrame, keys: list[str], parts, by: str) -> DataFrame:
    """An inner join of two sides with many rows a key: the rows dealt over ``parts`` tasks for each key by a hash of ``by``, the table's rows given to each of them.

    ``parts`` is a column that both sides have.
    """
    dealt = rows.withColumn("__part", F.pmod(F.hash(by), F.col(parts))).drop(parts)
    given = table.withColumn("__part", F.explode(F.sequence(F.lit(0), F.col(parts) - 1))).drop(parts)
    return dealt.join(given, [*keys, "__part"]).drop("__part")


def _tasks(size) -> Column:
    """Tasks for a key of so many rows."""
    return F.greatest(F.ceil(size / HOT), F.lit(1)).cast("int")


def _split(lists: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Members of lists with two classes or more, by the list's size: short ones, long ones.

    The join with the sizes is written, so that nothing above it needs a list in one place; only
    short lists are dealt by value again.
    """
    both = scratch.keep(_shared(lists, scratch))
    return both.where(F.col("df") <= LIGHT).drop("df"), both.where(F.col("df") > LIGHT)


def _shared(lists: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of lists (cls, n, m, value) that two classes or more are on, with the list's size df."""
    sizes = scratch.keep(lists.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    return _deal(lists, "value", sizes, _hot(sizes, "value", "df", scratch))


def _rarest(shared: DataFrame, take) -> DataFrame:
    """For each class (cls, n, m: its number of values) the rarest values by (df, value), as many as ``take`` says.

    Values of one class alone are not among ``shared``; they are the rarest, and ``own`` counts them.
    """
    held = shared.groupBy("cls", "n", "m").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"))
    held = held.withColumn("own", F.col("m") - F.size("v"))
    return held.withColumn("v", F.slice("v", 1, F.greatest(take(F.col("n"), F.col("m")) - F.col("own"), F.lit(0)).cast("int")))


def _least(n):
    """The least intersection that a set of n values has with a partner at the threshold: 0.85 n, upwards."""
    return F.floor((n * 85 + 99) / 100)


def estimate(a: str, b: str):
    """Similarity by the union sketch: the share of the union's smallest values that both sketches hold."""
    # unsigned order: flip the sign bit around the sort
    flip = lambda c: F.transform(c, lambda x: x.bitwiseXOR(F.lit(-(1 << 63))))
    union = F.slice(F.array_sort(F.array_union(flip(F.col(a)), flip(F.col(b)))), 1, SKETCH)
    both = F.array_intersect(F.array_intersect(union, flip(F.col(a))), flip(F.col(b)))
    return F.size(both) / F.greatest(F.size(union), F.lit(1))


def _frequent(pairs: DataFrame, scratch: Scratch) -> dict[str, DataFrame | None]:
    """Of each side of the pairs, the classes that are in very many."""
    return {side: _hot(pairs.groupBy(side).agg(F.count(F.lit(1)).alias("c")), side, "c", scratch) for side in ("a", "b")}


def _beside(pairs: DataFrame, table: DataFrame, names: dict[str, str], frequent: dict[str, DataFrame | None]) -> DataFrame:
    """Pairs (a, b) with columns of each side's row in a table (cls, ...): ``names`` gives them, as {column: its name before a or b}.

    The row of a frequent class is given to one task for each HOT of its pairs.
    """
    out = pairs
    for side, other in (("a", "b"), ("b", "a")):
        own = table.select(F.col("cls").alias(side), *[F.col(c).alias(n + side) for c, n in names.items()])
        if frequent.get(side) is None:
            out = out.join(own, side)
            continue
        heavy = F.broadcast(frequent[side].select(side, F.ceil(F.col("c") / HOT).cast("int").alias("parts")))  # SHARE rows at most
        part = F.coalesce("parts", F.lit(1))
        own = own.join(heavy, side, "left").withColumn("part", F.explode(F.sequence(F.lit(0), part - 1))).drop("parts")
        out = out.join(heavy, side, "left").withColumn("part", F.pmod(F.hash(other), part)).drop("parts").join(own, [side, "part"]).drop("part")
    return out


def _hopeful(pairs: DataFrame, cls: DataFrame, scratch: Scratch, frequent: dict[str, DataFrame | None]) -> DataFrame:
    """Pairs whose union sketch does not rule the threshold out."""
    near = _beside(pairs, cls, {"sketch": "s", "n": "n"}, frequent)
    sizes = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * 85
    return scratch.keep(near.where(sizes & (estimate("sa", "sb") * SKETCH >= F.least(F.lit(OVERLAP), F.floor(F.lit(0.85 * SKETCH))))).select("a", "b"))


def _verify(pairs: DataFrame, texts: DataFrame, frequent: dict[str, DataFrame | None]) -> DataFrame:
    """Links among pairs (a, b): 100 * |intersection| >= 85 * |union| of full sets, made again from whole texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[int, np.ndarray] = {}
        held = 0  # hashes in ``last``
        for p in batches:
            keep = []
            for a, b, ta, tb in zip(p["a"].tolist(), p["b"].tolist(), p["ta"].tolist(), p["tb"].tolist(), strict=True):
                if held > 1 << 20:
                    last, held = {}, 0
                for key, t in ((a, ta), (b, tb)):
                    if key not in last:
                        last[key] = shingle_set(t)
                        held += len(last[key])
                x, y = last[a], last[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 85 * (len(x) + len(y) - both) and both > 0)
            yield p.loc[keep, ["a", "b"]]

    return _beside(pairs, texts, {"t": "t"}, frequent).select("a", "b", "ta", "tb").mapInPandas(run, "a long, b long")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(cls, label): the smallest class reachable by links. Each round is written to the shared folder.

    A round takes the least label of the neighbours, then the label's own label, so a chain of
    length n takes about log n rounds and a star two. Nothing is gathered on the driver but a count.
    """
    edges = scratch.keep(links.select("a", "b").union(links.select("b", "a")).toDF("cls", "to"))
    first = scratch.keep(edges.groupBy("cls").agg(F.least(F.min("to"), F.first("cls")).alias("label"), F.count(F.lit(1)).alias("c")))
    centres = _hot(first.withColumnRenamed("cls", "to"), "to", "c", scratch)
    labels = first.select("cls", "label")
    while True:
        near = _deal(edges, "to", labels.withColumnRenamed("cls", "to"), centres).groupBy("cls").agg(F.min("label").alias("near"))
        low = scratch.keep(labels.join(near, "cls").select("cls", F.least("label", "near").alias("now"), F.col("label").alias("old")))
        jump = labels.select(F.col("cls").alias("now"), F.col("label").alias("far"))
        large = _hot(low.groupBy("now").agg(F.count(F.lit(1)).alias("c")), "now", "c", scratch)
        step = scratch.keep(_deal(low, "now", jump, large, "left").select("cls", F.least("now", "far").alias("label"), "old"))
        changed = step.where("label <> old").limit(1).count()
        scratch.drop(labels, low)
        labels = step.drop("old")
        if not changed:
            return labels


def _large_groups(full: DataFrame, cls: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Links among classes on long lists, from their full sets (cls, n, m, value)."""
    # values that only one class holds are in no intersection; s = n - own values bounds each one
    shared = scratch.keep(_shared(full, scratch))
    held = _rarest(shared, lambda n, m: n - _least(n) + 1).withColumn("s", F.col("n") - F.col("own"))
    held = held.where(F.col("s") * 100 >= F.col("n") * 85)
    lists = scratch.keep(held.select("cls", "n", "s", F.explode("v").alias("x")).select("cls", "n", "s", F.col("x.value").alias("value")))
    pivot = lists.groupBy("value").agg(F.max(F.struct((F.col("s") / F.col("n")).alias("share"), -F.col("cls"), "n", "s")).alias("p"), F.count(F.lit(1)).alias("c"))
    pivot = scratch.keep(pivot.select("value", (-F.col("p.col2")).alias("p"), F.col("p.n").alias("pn"), F.col("p.s").alias("ps"), "c"))
    can = lambda s, t, n, m: F.least(s, t) * 185 >= (F.col(n) + F.col(m)) * 85
    met = scratch.keep(_deal(lists, "value", pivot, _hot(pivot, "value", "c", scratch)))
    first = met.where((F.col("cls") != F.col("p")) & can(F.col("s"), F.col("ps"), "n", "pn"))
    first = scratch.keep(_ordered(first.select(F.col("cls").alias("a"), F.col("p").alias("b"))))
    often = _frequent(first, scratch)
    links = scratch.keep(_verify(_hopeful(first, cls, scratch, often), texts, often))
    label = components(links, scratch)
    named = scratch.keep(met.join(label, "cls", "left").withColumn("label", F.coalesce("label", "cls")))
    home = label.select(F.col("cls").alias("p"), F.col("label").alias("home"))
    # what follows are pairs of different components, one of them away from the component of its list's pivot
    led = _hot(named.groupBy("p").agg(F.count(F.lit(1)).alias("c")), "p", "c", scratch)
    away = _deal(named, "p", home, led, "left").where(F.col("label") != F.coalesce("home", "p"))
    away = away.groupBy("cls", "n", "s", "label", "p").agg(F.count(F.lit(1)).alias("c")).groupBy("cls", "n", "s", "label").agg(F.max_by("p", F.struct("c", "p")).alias("p"))
    away = scratch.keep(away)
    # A partner of m values misses at most b = n - 0.85 / 1.85 * (n + m) values of a class of n. So it
    # holds one of any b + 1 of them: here the rarest that the class's pivot lacks, own ones first.
    led = _hot(away.groupBy("p").agg(F.count(F.lit(1)).alias("c")), "p", "c", scratch)
    of = away.select("cls", "p", "s", "label")
    of = of.withColumn("tasks", F.lit(1)) if led is None else of.join(F.broadcast(led), "p", "left").withColumn("tasks", _tasks(F.coalesce("c", F.lit(1)))).drop("c")
    led = of.select("p", "tasks").distinct()
    mine = shared.join(of, "cls").select("cls", "p", "n", "s", "label", "value", "df", F.pmod(F.hash("cls"), F.col("tasks")).alias("part"))
    pivots = shared.select(F.col("cls").alias("p"), "value").join(led, "p").select("p", "value", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("part"))
    lacks = scratch.keep(mine.join(pivots, ["p", "value", "part"], "left_anti").drop("part"))
    rare = lacks.withColumn("r", F.row_number().over(Window.partitionBy("cls").orderBy("df", "value")))
    probes = rare.where(F.col("r") <= F.col("n") - _least(F.col("n")) + 1 - (F.col("n") - F.col("s")))
    probes = scratch.keep(probes.select("value", _tasks(F.col("df")).alias("tasks"), F.col("cls").alias("b"), F.col("n").alias("bn"), F.col("s").alias("bs"), F.col("label").alias("bl")))
    every = shared.join(held.select("cls", "s"), "cls").join(label, "cls", "left").select("value", "cls", "n", "s", F.coalesce("label", "cls").alias("label"), _tasks(F.col("df")).alias("tasks"))
    differ = (F.col("label") != F.col("bl")) & can(F.col("s"), F.col("bs"), "n", "bn")
    rest = _meet(every, probes, ["value"], "tasks", "cls").where(differ).select(F.col("cls").alias("a"), "b")
    # a partner so much smaller that b reaches all values the pivot lacks can share the pivot's values alone
    few = away.join(lacks.groupBy("cls").agg(F.count(F.lit(1)).alias("d")), "cls", "left").select(
        F.col("cls").alias("b"), F.col("n").alias("bn"), F.col("s").alias("bs"), F.col("label").alias("bl"), (F.coalesce("d", F.lit(0)) + F.col("n") - F.col("s")).alias("d")
    )
    named = named.withColumn("tasks", _tasks(F.col("c"))).drop("c")
    few = few.join(named.select(F.col("cls").alias("b"), "value", "tasks"), "b")
    small = (F.col("bn") - F.col("d")) * 185 >= (F.col("n") + F.col("bn")) * 85
    rest = rest.union(_meet(named, few, ["value"], "tasks", "cls").where(differ & small).select(F.col("cls").alias("a"), "b"))
    rest = _ordered(rest).join(first, ["a", "b"], "left_anti")
    rest = scratch.keep(rest)
    often = _frequent(rest, scratch)
    return links.unionByName(_verify(_hopeful(rest, cls, scratch, often), texts, often))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _classified(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """A row for each document: doc_id, th (hash of the text), n (set size), key (its component, null without words), top (the smallest doc_id there)."""
    bound_batches(docs.sparkSession)
    each = scratch.keep(sketches(docs, id_col, text_col))
    # a class's text is that of its smallest doc_id, and there of the smallest hash
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th"))
    held = each.where("n > 0").groupBy("digest").agg(first.alias("x"), F.min("n").alias("n"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies")).select("digest", F.col("x.doc_id").alias("m"), F.col("x.th").alias("th"), "n", "sketch", "copies")
    # an id that has several texts cannot name their classes; as a rule there is none, and the written table is read as a small one
    several = each.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").select(F.col("doc_id").alias("m"), F.lit(True).alias("several"))
    number = F.lit(NO_ID) + F.shiftright(F.xxhash64("digest"), 4).bitwiseAND(F.lit((1 << 59) - 1))
    named = F.when(F.col("m").isNull() | F.col("several"), number).otherwise(F.col("m"))
    cls = scratch.keep(held.join(scratch.keep(several), "m", "left").select("digest", named.alias("cls"), "m", "n", "sketch", "th", "copies"))

    keys = cls.select("cls", F.explode(F.slice("sketch", 1, KEYS)).alias("value"))
    short, long = _split(keys, scratch)
    pairs = _pairs_of(short)
    frequent = scratch.keep(long.select("cls").distinct())
    part = cls.join(frequent, "cls", "left_semi").select("cls", "n", F.size("sketch").alias("m"), "sketch")
    lists = _rarest(
        _shared(part.select("cls", "n", "m", F.explode("sketch").alias("value")), scratch),
        # a set within the sketch is exact, and so is every partner's as long as 0.85 of it fits
        lambda n, m: F.when(n <= SKETCH * 85 // 100, n - _least(n) + 1).otherwise(m - OVERLAP + 1),
    )
    lists = scratch.keep(lists.select("cls", F.explode("v").alias("x")).select("cls", F.col("x.value").alias("value")))
    short, long = _split(lists, scratch)
    # a class is in few such pairs: it has at most SKETCH short lists
    near = _hopeful(scratch.keep(_ordered(pairs.union(_pairs_of(short)))), cls, scratch, {})

    grouped = scratch.keep(long.select("cls").distinct())
    text = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("h"))
    want = near.select("a").union(near.select("b")).union(grouped).toDF("cls").distinct()
    want = cls.join(want, "cls", "left_semi").select("cls", "m", "th")
    texts = text.join(want, text["h"].eqNullSafe(want["th"]) & text["i"].eqNullSafe(want["m"])).select("cls", "t")
    texts = scratch.keep(texts.dropDuplicates(["cls"]))  # rows that repeat in id and text

    def explode_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for c, t in zip(b["cls"].tolist(), b["t"].tolist(), strict=True):
                s = shingle_set(t)
                yield pd.DataFrame({"cls": c, "n": len(s), "m": len(s), "value": _signed(s)})

    full = texts.join(grouped, "cls", "left_semi").mapInPandas(explode_sets, "cls long, n long, m int, value long")
    links = _large_groups(scratch.keep(full), cls, texts, scratch).unionByName(_verify(near, texts, {}))
    labels = components(scratch.keep(links), scratch)
    joined = cls.join(labels, "cls", "left").select("digest", "cls", "m", F.coalesce("label", "cls").alias("key"))
    # classes not named by their doc_id may have a smaller one than their component's name
    other = scratch.keep(joined.where(F.col("cls") >= NO_ID).where("m is not null").groupBy("key").agg(F.min("m").alias("least")))
    joined = joined.join(other, "key", "left").select("digest", "key", F.least(F.when(F.col("key") < NO_ID, F.col("key")), "least").alias("top"))
    # many exact copies, and rows without words, are dealt over tasks
    return _deal(each.select("doc_id", "th", "n", "digest"), "digest", joined, _hot(cls, "digest", "copies", scratch), "left").drop("digest")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id, kept.

    Documents whose sets have 100 * intersection >= 85 * union are linked; component_id is the
    smallest doc_id reachable; kept marks that document. Null and wordless texts have empty sets
    and are linked with nothing. Repeated rows stay, each with the same answer; rows of one doc_id
    with different texts are different documents, so each may be kept. A null doc_id takes part: its
    component_id is the smallest doc_id of its component, null if there is none, and it is kept only
    then. A very long text is read whole, in memory in proportion to it. An empty table gives no rows;
    other columns are ignored.
    """
    whole = _classified(docs, id_col, text_col, Scratch(docs.sparkSession, "near"))
    comp = F.when(F.col("n") > 0, F.col("top")).otherwise(F.col("doc_id"))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.col("doc_id").eqNullSafe(comp).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of near copies, all columns kept.

    It is the row of the smallest doc_id (null ids come last), and there of the smallest text hash; of
    rows that repeat in both, any one. Rows without words are copies of nothing and stay.
    """
    scratch = Scratch(docs.sparkSession, "one")
    own = _classified(docs, id_col, text_col, scratch).where("n > 0")
    first = own.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("x"))
    first = scratch.keep(first.select(F.coalesce("x.doc_id", F.lit(_NONE)).alias("__i"), F.col("x.th").alias("__th")))
    words = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    named = docs.where(words).withColumns({"__i": F.coalesce(F.col(id_col).cast("long"), F.lit(_NONE)), "__th": F.xxhash64(text_col)})
    return named.join(first, ["__i", "__th"], "left_semi").dropDuplicates(["__i", "__th"]).select(*docs.columns).unionByName(docs.where(~words))


_NONE = -(1 << 63)
