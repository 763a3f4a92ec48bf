"""Provenance: which chunks of a statute quote another norm that it amends.

Scores are column expressions over each chunk and 800 characters around it. The state machine with
two thresholds runs once over a document's chunks in order: a fold over sorted partitions in batch, a
stateful operator with a buffer for chunks out of order on a stream.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import rules
from . import ranges

#: Weights of the signs of a zone's start, but for the article's number, and of its end.
_W = {"trigger": 0.40, "quote": 0.20, "sequence": 0.50, "chapter": 0.40, "ref": 0.30, "name": 0.20, "annex": 0.15, "nr": 0.70, "nr_alone": 0.35, "close": 0.50, "resume": 0.30, "again": 0.40}


def article_number(text: Column) -> Column:
    """Number of the first article named, without points and letter; null if none."""
    digits = F.regexp_replace(F.substring_index(F.regexp_extract(text, rules.ZONE_ARTICLE, 1), "-", 1), r"\.", "")
    return digits.try_cast("double")


def _triggered(low: str) -> Column:
    """Whether a column of text in lower case holds a trigger."""
    return reduce(lambda a, b: a | b, [F.col(low).contains(p) for p in rules.TRIGGERS])


def _sum(signs: list[tuple[Column, float, str]]) -> tuple[Column, Column]:
    score = reduce(lambda a, b: a + b, [F.when(c, w).otherwise(0.0) for c, w, _ in signs])
    return score, F.array_compact(F.array(*[F.when(c, n) for c, _, n in signs]))


def reference(area: Column, refers: list[Column]) -> Column:
    """(id, name) of the first norm referred to, by patterns in order, of which ``refers`` says whether they match; known numbers have a fixed id."""
    known = [F.create_map(*[F.lit(x) for n, v in rules.KNOWN_REFERENCES.items() for x in (n, v[j])]) for j in (0, 1)]
    pick = F.when(F.lit(False), F.struct(F.lit("").alias("id"), F.lit("").alias("name")))
    for (pattern, kind, dated, named), found in zip(rules.REFERENCES, refers, strict=True):
        num = F.regexp_extract(area, pattern, 1)
        year = F.regexp_extract(F.regexp_extract(area, pattern, 2), r"(\d{4})", 1) if dated else F.lit("")
        own = F.concat_ws("-", F.lit(kind), F.regexp_replace(num, r"\.", ""), F.nullif(year, F.lit("")))
        name = F.regexp_extract(area, pattern, 3) if named else F.lit("")
        pick = pick.when(found, F.struct(F.coalesce(F.try_element_at(known[0], num), own).alias("id"), F.coalesce(F.try_element_at(known[1], num), name).alias("name")))
    return pick.otherwise(F.struct(F.lit("").alias("id"), F.lit("").alias("name")))


#: Code points of a piece of canonical text.
PIECE = 4000


def _windows(chunks: DataFrame, canonical: DataFrame) -> DataFrame:
    """Chunks with the text before and after each, as far as the window reaches; empty without offsets or text.

    Texts are cut into pieces that overlap by the window, and each chunk meets the piece where it starts and
    the one where it ends, so no row carries a whole text and the length of a text costs nothing twice.
    Spark takes cut texts for small and would send all of them to every task; the joins are by sorted keys.
    """
    reach = rules.ZONE_WINDOW
    cut = canonical.select("document_id", F.regexp_extract_all("canonical_text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("__a"))
    whole = F.transform("__a", lambda x, i: F.concat(F.when(i > 0, F.right(F.get("__a", i - 1), F.lit(reach))).otherwise(""), x, F.coalesce(F.left(F.get("__a", i + 1), F.lit(reach)), F.lit(""))))
    pieces = cut.select("document_id", F.posexplode(whole).alias("__n", "__piece"))
    s, e = F.col("canonical_start"), F.col("canonical_end")
    has = (s >= 0) & (e >= 0)
    number = lambda at: F.when(has, F.floor(at / PIECE).cast("int"))
    out = chunks.withColumn("__s", number(s)).withColumn("__e", number(e))
    for name, at, n in (("before", s, "__s"), ("after", e, "__e")):
        out = ranges.dealt(out, "document_id", n).join(pieces.withColumnRenamed("__n", n).hint("merge"), ["document_id", n], "left")
        local = at - F.col(n) * PIECE + F.when(F.col(n) > 0, reach).otherwise(0)  # where the offset lies in the piece
        low = F.greatest(local - reach, F.lit(0)) if name == "before" else local
        text = F.substring(F.col("__piece"), (low + 1).cast("int"), (F.least(local, F.lit(reach)) if name == "before" else F.lit(reach)).cast("int"))
        out = out.withColumn(name, F.coalesce(text, F.lit(""))).drop("__piece", n)
    return out.select(*chunks.columns, "before", "after")


def scores(chunks: DataFrame, canonical: DataFrame) -> DataFrame:
    """Signs of start and end for each chunk: enter (without the article's number), exit, their reasons, number, reference."""
    # columns that several signs read stand in a projection of their own, so that each pattern is matched once a chunk
    c = _windows(chunks, canonical).withColumns({"__area": F.concat("before", "text"), "__next": F.left("after", F.lit(400))})
    c = c.withColumns({"__low": F.lower("__area"), "__low_next": F.lower("__next"), "__quote": F.concat(F.right("before", F.lit(200)), F.left("text", F.lit(200)))})
    t, area = F.col("text"), F.col("__area")
    refers = [f"__refers_{k}" for k in range(len(rules.REFERENCES))]
    c = c.withColumns({
        **{n: F.col("__low").contains(rules.REFERENCE_STARTS[kind]) & area.rlike(p) for n, (p, kind, *_) in zip(refers, rules.REFERENCES, strict=True)},
        "__trigger": _triggered("__low"), "__opened": F.col("__quote").rlike(rules.ZONE_QUOTE_OPEN), "__chapter": t.rlike(rules.ZONE_QUOTED_CHAPTER), "__annex": t.rlike(rules.ZONE_ANNEX),
        "__article": article_number(F.col("__next")).isNotNull(), "__again": _triggered("__low_next"), "__nr": F.concat(t, F.left("after", F.lit(200))).rlike(rules.ZONE_NEW_WORDING),
        "__shut": t.rlike(rules.ZONE_QUOTE_CLOSE) | F.left("after", F.lit(100)).rlike(rules.ZONE_QUOTE_CLOSE), "number": article_number(t),
    })
    refers = [F.col(n) for n in refers]
    # the name counts if the first pattern that matches and has one does: patterns without one never stop the search
    named = reduce(lambda a, b: a | b, [r for r, (_, _, _, n) in zip(refers, rules.REFERENCES, strict=True) if n])
    first_named = F.when(refers[0], True)
    for r, (_, _, _, n) in list(zip(refers, rules.REFERENCES, strict=True))[1:]:
        first_named = first_named.when(r & F.lit(n), True)
    named = F.coalesce(first_named, named)
    enter = [(F.col("__trigger"), _W["trigger"], "trigger_phrase"), (F.col("__opened"), _W["quote"], "quote_open"), (F.col("__chapter"), _W["chapter"], "chapter_in_quotes"), (reduce(lambda a, b: a | b, refers), _W["ref"], "target_ref"), (named, _W["name"], "target_name"), (F.col("__annex"), _W["annex"], "annex_header")]
    next_art, again, nr = F.col("__article"), F.col("__again"), F.col("__nr")
    full = nr & (next_art | again)
    closed = F.col("__shut") & ~full & next_art
    leave = [(full, _W["nr"], "nr_marker"), (nr & ~full, _W["nr_alone"], "nr_marker_isolated"), (closed, _W["close"], "quote_close_resume"), (next_art & ~closed & ~full, _W["resume"], "resume_sequence"), (again, _W["again"], "new_trigger")]
    (es, er), (xs, xr) = _sum(enter), _sum(leave)
    return c.select(*chunks.columns, es.alias("enter"), er.alias("enter_reasons"), xs.alias("exit"), xr.alias("exit_reasons"), "number", reference(area, refers).alias("ref"))


_OUT = "origin_type string, is_external_material boolean, origin_reference string, origin_reference_name string, origin_confidence string, origin_reason string"
#: Order in which the signs of a start are named.
_ORDER = ("trigger_phrase", "quote_open", "out_of_sequence", "chapter_in_quotes", "target_ref", "target_name", "annex_header")


def confidence(target: str, name: str, entered: float, reasons: list[str]) -> str:
    """How sure a zone is: its target (0.4), the target's name (0.2), the score at its start, three signs or more."""
    if "ttl_forced_close" in reasons:
        return "low"
    e = 0.4 * bool(target) + 0.2 * bool(name) + (0.3 if entered >= 0.8 else 0.1 if entered >= 0.6 else 0) + 0.1 * (len(reasons) >= 3)
    return "high" if e >= 0.7 - 1e-9 else "medium" if e >= 0.4 - 1e-9 else "low"


class Zones:
    """The state machine over a document's scored chunks in order: a zone opens at 0.60, closes with the chunk that reaches 0.40, or after 50.

    The host's highest article number is taken from the chunks before, and its successor is never
    out of sequence; ``compat`` includes the chunk itself, so that none is. The state is an open zone
    and that number, whatever the document's length.
    """

    def __init__(self, compat: bool = False, zone: dict | None = None, highest: float = 0.0):
        self.compat, self.zone, self.highest = compat, zone, highest

    def step(self, r: dict) -> tuple:
        if r["start"] is None or r["start"] != r["start"] or r["start"] < 0 or r["end"] < 0:
            return "self", False, "", "", "high", ""
        n = r["number"] if r["number"] is not None and r["number"] == r["number"] else None
        if self.compat and self.zone is None and n is not None:
            self.highest = max(self.highest, n)
        odd = n is not None and self.highest > 0 and n > self.highest + 1 and (n >= 2 * self.highest or n >= self.highest + 100)
        entered = r["enter"] + _W["sequence"] * odd
        signs = sorted([*r["enter_reasons"], *["out_of_sequence"] * odd], key=_ORDER.index)
        added, ends = [], False
        if self.zone is None:
            if entered >= rules.ENTER - 1e-9:
                self.zone = {"id": r["id"] or "", "name": r["name"] or "", "score": entered, "why": list(signs), "n": 0}
                added = signs
            elif n is not None:
                self.highest = max(self.highest, n)
        else:
            zone = self.zone
            zone["n"] += 1
            if r["id"] and not zone["id"]:
                zone["id"], zone["name"] = r["id"], r["name"] or ""
            added = signs
            if r["exit"] >= rules.EXIT - 1e-9:
                added, ends = list(r["exit_reasons"]), True
            elif zone["n"] >= rules.ZONE_TTL:
                zone["why"].append("ttl_forced_close")
                added, ends = ["ttl_forced_close"], True
        if self.zone is None:
            return "self", False, "", "", "high", ""
        zone = self.zone
        why = " + ".join(dict.fromkeys([*zone["why"], *added]))
        if ends:
            self.zone = None
        return "external", True, zone["id"], zone["name"], confidence(zone["id"], zone["name"], zone["score"], zone["why"]), why


def zones(rows: list[dict], compat: bool = False) -> list[tuple]:
    """What the machine says of a document's chunks."""
    machine = Zones(compat)
    return [machine.step(r) for r in rows]


#: What the machine reads of a scored chunk, and its names in the table.
_READ = {"start": "canonical_start", "end": "canonical_end", "number": "number", "enter": "enter", "enter_reasons": "enter_reasons", "exit": "exit", "exit_reasons": "exit_reasons", "id": "ref_id", "name": "ref_name"}
_SCORED = ("number", "enter", "enter_reasons", "exit", "exit_reasons", "ref", "ref_id", "ref_name")
_NAMES = [c.split()[0] for c in _OUT.split(", ")]


def _flat(scored: DataFrame, own: list[str]) -> DataFrame:
    return scored.select(*own, *_SCORED[:5], F.col("ref.id").alias("ref_id"), F.col("ref.name").alias("ref_name"))


def _kinds(schema, own: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name in own)


def classify(chunks: DataFrame, canonical: DataFrame, compat: bool = False) -> DataFrame:
    """Chunks with the six origin columns, one row each whatever its id. Chunks without offsets are the document's own.

    Chunks are sorted within partitions and streamed past the machine, which keeps the state of one
    document and never its rows. A document's chunks pass through one task in order, as the zones
    ask; rows without a document are one document.
    """
    # columns of the chunks that are named as a score go by another name meanwhile
    clash = {c: f"__own_{c}" for c in chunks.columns if c in (*_SCORED, "before", "after")}
    chunks = chunks.drop(*_NAMES).withColumnsRenamed(clash)
    scored, own = scores(chunks, canonical), chunks.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, machine = object(), None
        for b in batches:
            keys = b["document_id"].astype(object).where(b["document_id"].notna(), None).tolist()
            out = []
            for key, *values in zip(keys, *[b[c].tolist() for c in _READ.values()], strict=True):
                if key != last:
                    last, machine = key, Zones(compat)
                out.append(machine.step(dict(zip(_READ, values, strict=True))))
            yield pd.concat([b[own], pd.DataFrame(out, columns=_NAMES, index=b.index)], axis=1)

    ordered = _flat(scored, own).repartition("document_id").sortWithinPartitions("document_id", "canonical_start", "node_id")
    return ordered.mapInPandas(run, f"{_kinds(chunks.schema, own)}, {_OUT}").withColumnsRenamed({v: k for k, v in clash.items()})


class ZoneStream(StatefulProcessor):
    """The machine on a stream of scored chunks with their number in the document (seq, from 0).

    State of a document: the machine and the number expected next, as JSON, and a map of the chunks
    that came before their turn. They wait for the missing ones; if a wait ends, by a timer, what is there goes on
    in order, and a chunk that comes after its turn is judged as the machine then stands.
    """

    def __init__(self, compat: bool, wait_ms: int):
        self.compat, self.wait_ms = compat, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.at = handle.getValueState("machine", "json string")
        self.early = handle.getMapState("early", "seq long", "json string")

    def _load(self) -> tuple[Zones, int]:
        if not self.at.exists():
            return Zones(self.compat), 0
        got = json.loads(self.at.get()[0])
        return Zones(self.compat, got["zone"], got["highest"]), got["next"]

    def _save(self, machine: Zones, due: int) -> None:
        self.at.update((json.dumps({"zone": machine.zone, "highest": machine.highest, "next": due}),))

    def _frame(self, key, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            out = pd.DataFrame(rows, columns=["node_id", *_NAMES])
            out.insert(0, "document_id", key[0])
            yield out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        machine, due = self._load()
        out = []
        new = sorted((r for b in rows for r in b.to_dict("records")), key=lambda r: r["seq"])
        for r in new:
            chunk = {k: list(r[c]) if k.endswith("reasons") else r[c] for k, c in _READ.items()} | {"node_id": r["node_id"]}
            if r["seq"] > due:
                self.early.updateValue((int(r["seq"]),), (json.dumps(chunk, default=float),))
                continue
            out.append((chunk["node_id"], *machine.step(chunk)))
            due += r["seq"] == due
            while self.early.containsKey((due,)):
                waiting = json.loads(self.early.getValue((due,))[0])
                self.early.removeKey((due,))
                out.append((waiting["node_id"], *machine.step(waiting)))
                due += 1
        self._save(machine, due)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if next(iter(self.early.keys()), None) is not None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
        yield from self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        machine, due = self._load()
        out = []
        for seq in sorted(k[0] for k in self.early.keys()):
            waiting = json.loads(self.early.getValue((seq,))[0])
            self.early.removeKey((seq,))
            out.append((waiting["node_id"], *machine.step(waiting)))
            due = seq + 1
        self._save(machine, due)
        yield from self._frame(key, out)

    def close(self) -> None:
        pass


def classify_stream(scored: DataFrame, compat: bool = False, wait_ms: int = 600_000) -> DataFrame:
    """document_id, node_id and the origin columns for a stream of ``scores`` with ``seq``. Needs the RocksDB state store."""
    slim = _flat(scored, ["document_id", "node_id", "seq", "canonical_start", "canonical_end"])
    kinds = dict(scored.dtypes)
    return slim.groupBy("document_id").transformWithStateInPandas(
        statefulProcessor=ZoneStream(compat, wait_ms), outputStructType=f"document_id {kinds['document_id']}, node_id {kinds['node_id']}, {_OUT}", outputMode="Append", timeMode="ProcessingTime"
    )


def prefix_external(chunks: DataFrame) -> DataFrame:
    """Put the quoted norm's name and id in front of the retrieval text of external chunks."""
    head = F.concat(F.col("origin_reference_name"), F.lit(" ("), F.col("origin_reference"), F.lit(")\n"))
    return chunks.withColumn("retrieval_text", F.when(F.col("is_external_material") & (F.col("origin_reference_name") != ""), F.concat(head, "retrieval_text")).otherwise(F.col("retrieval_text")))
