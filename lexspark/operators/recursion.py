"""Walks down trees of any depth: by recursive queries, which read each row once a level, or document by document, which reads it once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import legal
from . import ranges

#: Levels that a walk may go down; trees of law have five, so more is a fault and an error.
MOST_LEVELS = 10_000


def unbounded(spark) -> None:
    """Let recursive queries give as many rows as they have; Spark ends them at a million otherwise. An own bound of the session stays.

    The setting stays: results are lazy, and rows are made when they are read.
    """
    key = "spark.sql.cteRecursionRowLimit"
    if spark.conf.get(key, "1000000") == "1000000":
        spark.conf.set(key, "-1")


def descend(roots: DataFrame, steps: DataFrame, columns: dict[str, str], guard: str, levels: int = MOST_LEVELS) -> DataFrame:
    """Rows of ``roots``, then again and again of ``steps`` that hang below one found at the level before.

    Both have document_id; roots and steps have span_id, steps parent_span_id. ``columns`` gives each
    further column of the roots as SQL over the row above (``r``) and the step (``c``). A step whose
    ``guard``, an array of spans of the row above, holds its span already would close a circle and is left out.
    """
    spark = roots.sparkSession
    unbounded(spark)
    names = ["document_id", "span_id", *columns]
    step = ", ".join(["c.document_id", "c.span_id", *columns.values()])
    return spark.sql(
        f"""WITH RECURSIVE r({", ".join(f"`{n}`" for n in names)}) MAX RECURSION LEVEL {levels} AS (
            SELECT {", ".join(f"`{n}`" for n in names)} FROM {{roots}}
            UNION ALL
            SELECT {step} FROM r JOIN {{steps}} c ON c.document_id = r.document_id AND c.parent_span_id = r.span_id AND NOT array_contains({guard}, c.span_id))
        SELECT * FROM r""",
        roots=roots.select(*names),
        steps=steps,
    )


def _key(span: Column, start: Column) -> Column:
    """Place among siblings: kind, number, start, span."""
    order = legal.child_order(span)
    return F.struct(order["kind"].alias("kind"), order["number"].alias("number"), start.cast("long").alias("start"), span.alias("span_id"))


def descendants(tree: DataFrame) -> DataFrame:
    """Every pair of a device and one below it: document_id, ancestor, span_id, path (places from below the ancestor down), text.

    Sorted by path, a device's descendants stand depth first in structural order. Its rows are as many
    as the depths of all devices together.
    """
    below = tree.where("parent_span_id <> '' and parent_span_id <> span_id")
    below = below.select("document_id", "span_id", "parent_span_id", _key(F.col("span_id"), F.col("char_start")).alias("at"), "text")
    roots = below.select("document_id", "span_id", F.col("parent_span_id").alias("ancestor"), F.array("at").alias("path"), F.array("parent_span_id", "span_id").alias("seen"), "text")
    columns = {"ancestor": "r.ancestor", "path": "concat(r.path, array(c.at))", "seen": "concat(r.seen, array(c.span_id))", "text": "c.text"}
    return descend(roots, below, columns, "r.seen").drop("seen")


#: Characters and rows that are answered at once.
_PART, _ROWS = 1 << 20, 10_000


def by_document(rows: DataFrame, order: list, needed: list[str], work: Callable[[list[list]], Iterator[tuple]], new: dict[str, T.DataType]) -> DataFrame:
    """Rows with the ``new`` columns that ``work`` tells of each, in turn, from the ``needed`` columns of a document's rows in ``order``.

    One shuffle by document_id, however deep the trees are: rows are sorted within partitions and
    streamed, a worker holds one document's rows, and answers leave it in parts.
    """
    names, kinds = [*rows.columns, *new], [pa.string() if isinstance(k, T.StringType) else pa.int64() for k in new.values()]
    at = rows.columns.index("document_id")

    def answer(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        docs, cols = table.column(at).to_pylist(), [table.column(c).to_pylist() for c in needed]
        first, out, chars = 0, [], 0

        def part() -> Iterator[pa.RecordBatch]:
            own = table.slice(first, len(out)).combine_chunks()
            yield from pa.Table.from_arrays([*own.columns, *[pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)]], names).to_batches()

        low = 0
        while low < len(docs):
            high = low + 1
            while high < len(docs) and docs[high] == docs[low] and docs[low] is not None:
                high += 1
            for said in work([c[low:high] for c in cols]):
                out.append(said)
                chars += sum(len(x) for x in said if isinstance(x, str))
                if chars >= _PART or len(out) >= _ROWS:
                    yield from part()
                    first, out, chars = first + len(out), [], 0
            low = high
        if out:
            yield from part()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            docs = b.column(at).to_pylist()
            cut = len(docs) - 1
            while cut and docs[cut - 1] == docs[-1]:
                cut -= 1
            if cut or held and held[-1].column(at)[0].as_py() != docs[0]:
                yield from answer([*held, b.slice(0, cut)])
                held = []
            held.append(b.slice(cut))
        if held:
            yield from answer(held)

    schema = T.StructType([*rows.schema.fields, *[T.StructField(c, k) for c, k in new.items()]])
    return ranges.dealt(rows, "document_id", n=ranges.parts(rows)).sortWithinPartitions("document_id", *order).mapInArrow(run, schema)


def subtrees(columns: list[list]) -> Iterator[tuple[str]]:
    """Of each device of a document (span_id, parent_span_id, text, siblings in order): its text and all below it, depth first. A span that leads back to itself ends there."""
    spans, parents, texts = columns
    kids: dict[str, list[int]] = {}
    for i, (s, p) in enumerate(zip(spans, parents, strict=True)):
        if p and p != s:
            kids.setdefault(p, []).append(i)
    known = set(spans)

    def walk(top: int, note: Callable[[int, int, int], None], said: list[str]) -> bool:
        """Texts depth first below and with ``top``; notes each device's place and end. False if a circle was cut."""
        whole, path, todo = True, set(), [(top, -1)]
        while todo:
            i, begin = todo.pop()
            if begin >= 0:
                path.discard(spans[i])
                note(i, begin, len(said))
                continue
            if spans[i] in path:
                whole = False
                continue
            path.add(spans[i])
            todo.append((i, len(said)))
            if texts[i] is not None:
                said.append(texts[i])
            todo += [(k, -1) for k in reversed(kids.get(spans[i], ()))]
        return whole

    at: dict[int, tuple[int, int]] = {}
    said: list[str] = []
    for i, (s, p) in enumerate(zip(spans, parents, strict=True)):
        if not p or p == s or p not in known:
            if not walk(i, lambda k, a, z: at.__setitem__(k, (a, z)), said):
                at.clear()
                break
    for i, text in enumerate(texts):
        own = said
        a, z = at.get(i, (-1, -1))
        if a < 0:  # in or below a circle
            own, places = [], {}
            walk(i, lambda k, a, z: places.setdefault(k, (a, z)), own)
            a, z = 0, len(own)
        below = [] if not kids.get(spans[i]) or kids[spans[i]] == [i] else ["\n".join(own[a + (text is not None) : z])]
        yield ("\n".join([*([] if text is None else [text]), *below]),)


def placed_below(columns: list[list]) -> Iterator[tuple]:
    """Of each device of a document (span_id, parent_span_id, start, end, reason; start and end within its parent): start and end in the whole text, reason.

    A device below an unresolved, missing or circular one has INVALID_PARENT_RANGE, an empty one EMPTY_TEXT.
    """
    spans, parents, starts, ends, reasons = columns
    where = {s: i for i, s in reversed(list(enumerate(spans)))}
    base: list = [None] * len(spans)  # start in the whole text, and whether the parent has one
    state = [0] * len(spans)  # 1: asked for, 2: known
    for i in range(len(spans)):
        chain, k = [], i
        while k is not None and state[k] == 0:
            state[k] = 1
            chain.append(k)
            k = where.get(parents[k]) if parents[k] else None
        for k in reversed(chain):
            up = where.get(parents[k]) if parents[k] else None
            if not parents[k]:
                base[k] = 0
            elif up is not None and state[up] == 2 and base[up] is not None and starts[up] is not None:
                base[k] = base[up] + starts[up]
            state[k] = 2
    for b, p, a, z, why in zip(base, parents, starts, ends, reasons, strict=True):
        if b is None:
            yield None, None, why if why == "EMPTY_TEXT" else "INVALID_PARENT_RANGE"
        else:
            yield (None if a is None else b + a), (None if z is None else b + z), why
