"""Licence scans by a positional index of rare tokens, in DataFrame functions only.

Words are runs of 0-9, a-z (A-Z lowered) and characters beyond ASCII. Templates are licence texts;
of each file the licence words of highest IDF, over the whole file and among each template's own, are
looked up in the templates' postings, postings are intersected by relative position, and a template
counts only with its mandatory phrase.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base phrases and their labels. Fixed values.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Licence words of highest IDF that are looked up for each file, and again for each template among its
#: own words, and the share of a template's postings for either that must stand at one shift.
RAREST, SHARE = 12, 0.6
#: Function words, which make no postings. Fixed values.
STOP = frozenset("a an and any are as at be by for from if in is it its may must not of on or shall that the their this to under we with without you your".split())
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: One of these must stand in the file.
    phrases: tuple[str, ...]


#: Licence notices and opening passages, as their publishers word them. Fixed values.
TEMPLATES = (
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu general public license as published by the free software foundation either version 3",)),
    Template("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ("gnu general public license as published by the free software foundation either version 2",)),
    Template("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    Template("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", ("gnu affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ("apache org licenses license 2 0",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge to any person obtaining a copy",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute this software",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related rights cc0 1 0 universal public domain dedication", ("cc0 1 0 universal", "waived all copyright and related")),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software released into the public domain",)),
    Template("epl-2.0", "made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
)


def _content(text: str) -> list[tuple[int, str]]:
    return [(k, w) for k, w in enumerate(text.split()) if w not in STOP]


def vocabulary(templates: tuple[Template, ...] = TEMPLATES) -> list[str]:
    return sorted({w for t in templates for _, w in _content(t.text)})


def _has(line: Column, phrase: str) -> Column:
    return line.contains(f" {phrase} ")


def _aligned(posts: list[tuple[int, int]], rare: Column) -> tuple[Column, Column]:
    """Most postings of a template at one shift against the places of the rare words, and postings looked up.

    Every looked-up posting meets every place of its word; equal shifts are counted as runs of the
    sorted shifts, so a long file costs n log n.
    """
    own = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(k).alias("k")) for r, k in posts])
    own = F.filter(own, lambda p: F.array_contains(rare, p["r"]))

    def shifts(x: Column) -> Column:
        return F.transform(F.filter(own, lambda p: p["r"] == x["r"]), lambda p: x["i"] - p["k"])

    def step(a: Column, s: Column) -> Column:
        run = F.when(a["s"] == s, a["run"] + 1).otherwise(1)
        return F.struct(s.alias("s"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

    start = F.struct(F.lit(None).cast("int").alias("s"), F.lit(0).alias("run"), F.lit(0).alias("best"))
    return F.aggregate(F.array_sort(F.flatten(F.transform("places", shifts))), start, step, lambda a: a["best"]), F.size(own)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row for each document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts the places where a base phrase's words stand consecutively; first_word and
    last_word are the smallest and largest of their starts (words from 0), null without any. The
    labels are distinct, sorted and comma-joined; ``labels`` adds the templates found. The score is
    the best share of a template's looked-up postings, at least 0.9 with a base place and 0 with
    nothing. Null and empty texts have 0 words and no labels; repeated rows and ids each keep a row;
    an empty table gives no rows; other columns are ignored.

    One scan counts the document frequency of the templates' words (as many rows as they have
    words); a second scores each row by itself, so nothing else is shuffled.
    """
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    vocab = vocabulary(templates)
    split = F.split(lowered, SEPARATORS)
    known = F.array_intersect(split, F.array(*map(F.lit, vocab)))
    counts = docs.select(F.explode(known).alias("w")).groupBy("w").count().collect()  # at most the templates' words
    df = {r["w"]: r["count"] for r in counts}
    by_rank = sorted(vocab, key=lambda w: (df.get(w, 0), w))  # highest IDF first
    rank = {w: k for k, w in enumerate(by_rank)}

    d = docs.select(F.col(id_col).alias("doc_id"), split.alias("w"))
    lead = (F.element_at("w", 1) == "").cast("int")
    trail = F.when(F.size("w") > 1, (F.element_at("w", -1) == "").cast("int")).otherwise(0)
    d = d.withColumn("n_words", (F.size("w") - lead - trail).cast("long"))
    # the work below is only for rows with a licence word: others leave through the first branch
    d = d.withColumn("rare", F.array_sort(F.array_intersect("w", F.array(*map(F.lit, by_rank)))))
    some = F.size("rare") > 0
    line = F.when(some | F.array_contains("w", "cc"), F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")))
    d = d.withColumn("line", F.regexp_replace(line, " +", " "))

    base, first, last = [], [], []
    for phrase in BASE:
        cut = F.split(F.col("line"), f"(?<= ){phrase}(?= )")
        hit = _has(F.col("line"), phrase)
        spaces = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
        base.append(F.when(hit, F.size(cut) - 1).otherwise(0))
        first.append(F.when(hit, spaces(F.element_at(cut, 1)) - 1))
        last.append(F.when(hit, F.col("n_words") - (spaces(F.element_at(cut, -1)) - 1) - len(phrase.split())))
    names = [F.when(_has(F.col("line"), p), F.lit(label)) for p, label in BASE.items()]
    d = d.withColumn("base", F.array_sort(F.array_distinct(F.array_compact(F.array(*names)))))
    d = d.withColumn("n_base", F.coalesce(sum(base[1:], base[0]), F.lit(0)).cast("long"))
    d = d.withColumn("first_word", F.least(*first).cast("long")).withColumn("last_word", F.greatest(*last).cast("long"))

    # the file's licence words as their ranks, rarest first
    ranks = F.create_map(*[x for w, k in rank.items() for x in (F.lit(w), F.lit(k))])
    # most rows of a corpus have no licence word of any weight; they skip the positions
    d = d.withColumn("held", F.array_sort(F.transform("rare", lambda w: F.element_at(ranks, w))))
    d = d.withColumn("at", F.when(F.size("held") > 1, F.split(F.trim("line"), " ")))
    places = F.filter(
        F.transform("at", lambda w, i: F.struct(F.try_element_at(ranks, w).alias("r"), i.alias("i"))),
        lambda x: x["r"].isNotNull(),
    )
    d = d.withColumn("places", places)

    matched = []
    for t in templates:
        posts = [(rank[w], k) for k, w in _content(t.text)]
        # a file of many licences has its rarest words in few of them, so each template's own are looked up too
        own = F.array_intersect("held", F.array(*[F.lit(r) for r in sorted({r for r, _ in posts})]))
        phrase = F.lit(False)
        for p in t.phrases:
            phrase = phrase | _has(F.col("line"), p)
        shares = [F.coalesce(most, F.lit(0)) / F.greatest(used, F.lit(1)) for most, used in (_aligned(posts, F.slice(x, 1, RAREST)) for x in (F.col("held"), own))]
        share = F.when(phrase, F.greatest(*shares)).otherwise(0.0)
        matched.append(F.struct(F.lit(t.label).alias("label"), F.when(share >= SHARE, F.least(share, F.lit(1.0))).otherwise(0.0).alias("share")))
    d = d.withColumn("found", F.filter(F.array(*matched), lambda m: m["share"] > 0))
    labels = F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.col("found.label")))), ",")
    best = F.greatest(F.coalesce(F.array_max(F.col("found.share")), F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(0.9)).otherwise(F.lit(0.0)))
    return d.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.coalesce(F.array_join("base", ","), F.lit("")).alias("base_labels"), F.coalesce(labels, F.lit("")).alias("labels"), best.alias("score"))
