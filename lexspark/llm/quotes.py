"""Chat formatting by quotation linking: replies are found from the passages that they quote."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bound_batches

#: Letters and digits that a passage needs to identify a message, unless only one message of the conversation has it.
LEAST = 8


def _line_ends(text: str):
    """A text with one kind of line end; a lone carriage return ends a line too."""
    return F.regexp_replace(text, "\r\n?", "\n")


_marks = re.compile(r"[ \t\f\v]*((?:>[ \t\f\v]*)*)").match
_blank = re.compile(r"[ \t\f\v]+")
#: Where a sentence ends: its mark, closing quotes and brackets, then a blank.
_ends = re.compile(r"[.!?…]+[\"'”’»)\]]*(?= )")
_PASSAGES = "conv_id long, turn long, k int, level int, own binary, hash binary, size int, rank int"


def _hashed(passage: str) -> tuple[bytes, int]:
    return blake2b(passage.encode(), digest_size=16).digest(), sum(map(str.isalnum, passage))


def passages(text: str) -> Iterator[tuple[int, int, bytes, bytes, int, int]]:
    """(k, level, own, hash, size, rank) of each line k that is not blank: itself (rank 0) and each sentence that lies in it (rank 1).

    A passage is normalised: quote marks off, white space collapsed, lower case. Sentences are those of
    paragraphs, runs of lines of one level, so a paragraph that was wrapped anew has the same. ``own`` is the
    line's hash; the level counts nested marks, '>' at the start of a line with blanks between allowed.
    """
    at, run = None, []  # the paragraph's level and its lines (k, own, passage)

    def sentences() -> Iterator[tuple[int, int, bytes, bytes, int, int]]:
        whole, first = " ".join(x for _, _, x in run), 0
        cuts = [m.end() for m in _ends.finditer(whole)] + [len(whole)]
        starts = list(accumulate((len(x) + 1 for _, _, x in run), initial=0))
        n = 0
        for end in cuts:
            said = _hashed(whole[first:end].strip())
            while starts[n + 1] <= first:
                n += 1
            j = n
            while j < len(run) and starts[j] < end:
                if run[j][1] != said[0]:
                    yield run[j][0], at, run[j][1], *said, 1
                j += 1
            first = end + 1

    for k, line in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
        m = _marks(line)
        level, passage = m[1].count(">"), _blank.sub(" ", line[m.end() :]).strip(" ").lower()
        if run and (not passage or level != at):
            yield from sentences()
            run = []
        if passage:
            own = _hashed(passage)
            yield k, level, own[0], *own, 0
            at = level
            run.append((k, own[0], passage))
    if run:
        yield from sentences()


def _read(messages: DataFrame, quoted: bool) -> DataFrame:
    """Passages of quoted lines, or of all others, each once a message."""
    bound_batches(messages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for conv, turn, text in zip(b["conv_id"].tolist(), b["turn"].tolist(), b["text"].tolist(), strict=True):
                rows = {(k, level, own, h, size, rank) if quoted else (0, 0, b"", h, size, 0) for k, level, own, h, size, rank in passages(text or "") if (level > 0) == quoted}
                yield pd.DataFrame([(conv, turn, *r) for r in sorted(rows)], columns=[c.split()[0] for c in _PASSAGES.split(", ")])

    return messages.select("conv_id", "turn", "text").mapInPandas(run, _PASSAGES)


def unquoted(text: str = "text"):
    """A text without its quoted lines, nor the line that introduces a quotation ('... wrote:'). Line ends become ``\\n``."""
    attribution = F.regexp_replace(_line_ends(text), r"(?m)^[^\n>]*\b(?:wrote|schrieb|escribió|a écrit)\s*:[ \t]*\n(?=\s*>)", "")
    return F.trim(F.regexp_replace(F.regexp_replace(attribution, r"(?m)^[ \t]*>[^\n]*(?:\n|$)", ""), r"\n{3,}", "\n\n"))


def thread(conversations: DataFrame) -> DataFrame:
    """Messages with what they answer, in a form that sorts into reply order.

    Result: conv_id, turn, role, text_clean (without quotations), n_quoted (quoted lines), n_linked
    (those found in an earlier message), parent_turn (the message that the outermost quotation
    level matches most, the latest of equals; null if none), root_turn (start of its thread),
    depth (0 for a start). Sorting by conv_id, root_turn, turn gives reply order, since a parent
    comes before its replies.

    Passages are lines and the sentences of paragraphs, so quotations that were wrapped anew, and sentences
    cut out of a line, are found too; a line that is found as a whole counts as that, else its longest
    sentence that is found. A passage belongs to the first message of its conversation that has it
    unquoted; one of under LEAST letters and digits only if no other message has it. Rows without
    conv_id or turn, and rows of a turn that occurs twice, are kept; the former link with nothing,
    the latter count as one message in links. Null and empty texts quote nothing; a very long text is
    read whole, a row a line and sentence. An empty table gives no rows; other columns are ignored. Links are joined by
    (conv_id, hash); only messages with a parent take part in the search for roots, which doubles its reach each round.
    """
    spark = conversations.sparkSession
    scratch = Scratch(spark, "quotes")
    messages = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").alias("role"), F.col("text").alias("text"))
    quoting = messages.where(F.col("text").contains(">") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    quoted = scratch.keep(_read(quoting, True).distinct())
    # only conversations that quote anything need their other lines; the first owner of each passage
    asking = quoted.select("conv_id").distinct()
    sources = _read(messages.where(F.col("turn").isNotNull()).join(asking, "conv_id", "left_semi"), False)
    owner = sources.groupBy("conv_id", "hash").agg(F.min("turn").alias("owner"), (F.min("turn") == F.max("turn")).alias("only"))
    sure = ((F.col("size") >= LEAST) | (F.col("size") > 0) & F.col("only")) & (F.col("owner") < F.col("turn"))
    met = quoted.join(owner, ["conv_id", "hash"], "left").withColumn("found", F.when(sure, F.struct(-F.col("rank"), "size", -F.col("owner"), "owner")))
    met = met.groupBy("conv_id", "turn", "k", "level", "own").agg(F.max("found")["owner"].alias("owner"))
    votes = met.groupBy("conv_id", "turn", "level", "owner").agg(F.count(F.lit(1)).alias("n"))
    # the least level that found an owner; there the most lines, then the latest message
    best = votes.groupBy("conv_id", "turn").agg(
        F.sum("n").alias("n_quoted"), F.sum(F.when(F.col("owner").isNotNull(), F.col("n")).otherwise(0)).alias("n_linked"),
        F.max(F.when(F.col("owner").isNotNull(), F.struct(-F.col("level"), "n", "owner"))).alias("x"),
    )
    best = scratch.keep(best.select("conv_id", "turn", "n_quoted", "n_linked", F.col("x.owner").alias("parent_turn")))
    # pointer doubling: up = an ancestor, hops = how far it is
    up = scratch.keep(best.where("parent_turn is not null").select("conv_id", "turn", F.col("parent_turn").alias("up"), F.lit(1).cast("long").alias("hops")))
    while True:
        far = up.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("up2"), F.col("hops").alias("hops2"))
        step = scratch.keep(up.join(far, ["conv_id", "up"], "left").select("conv_id", "turn", F.coalesce("up2", "up").alias("up"), (F.col("hops") + F.coalesce("hops2", F.lit(0))).alias("hops"), F.col("up2").isNotNull().alias("moved")))
        more = step.where("moved").limit(1).count()
        scratch.drop(up)
        up = step.drop("moved")
        if not more:
            break
    found = best.join(up, ["conv_id", "turn"], "left")
    out = messages.join(found, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", unquoted().alias("text_clean"), F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "parent_turn", F.coalesce("up", "turn").alias("root_turn"), F.coalesce("hops", F.lit(0)).alias("depth"),
    )


def reply_ordered(threads: DataFrame) -> DataFrame:
    """Messages sorted into reply order over the whole table: a range exchange, so no conversation is one task's alone."""
    return threads.orderBy("conv_id", "root_turn", "turn")
