"""Sharding by fixed virtual slots: records hash to slots, slots map to shards, and only the map is edited."""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch

#: Virtual slots; fixed for the life of a dataset, so a record never changes its slot.
SLOTS = 8192
#: Bytes that a record takes besides its text.
ROW_BYTES = 16
#: The share of the mean by which the bytes of two shards may differ without a move.
TOLERANCE = 5e-4
#: Copies of a row that one task makes: more are dealt over several.
COPIES = 4096


@dataclass
class SlotMap:
    """A versioned slot-to-shard map. ``owner[s]`` is the shard of slot s in the newest version."""

    owner: list[int]
    shards: int
    version: int = 0
    #: Edits by version: (slot, from, to).
    history: list[list[tuple[int, int, int]]] = field(default_factory=list)

    @classmethod
    def even(cls, shards: int, slots: int = SLOTS) -> SlotMap:
        """Version 0: slots dealt round, before anything is known of their bytes."""
        return cls([s % shards for s in range(slots)], shards)

    def edit(self, moves: list[tuple[int, int, int]], shards: int | None = None) -> SlotMap:
        owner = list(self.owner)
        for s, _, to in moves:
            owner[s] = to
        return SlotMap(owner, shards or self.shards, self.version + 1, [*self.history, moves])

    def rebalanced(self, load: dict[int, int], shards: int | None = None) -> SlotMap:
        """The next version, in which shards hold nearly equal bytes, by few moves.

        Slots of shards that are no more go, largest first, to the shard with the fewest bytes. Then
        a slot moves from the fullest shard to the emptiest, or two are exchanged, such that their
        difference is as nearly closed as one such move can, until it is within TOLERANCE of the mean
        or no move makes it smaller; then the next fullest gives. A balanced map stays as it is, and a new shard gets its share and
        little else moves.
        """
        n = shards or self.shards
        owner = list(self.owner)
        slots: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # (bytes, slot) of each shard, ascending
        held = [0] * n
        homeless = []
        for s, k in enumerate(owner):
            if k < n:
                slots[k].append((load.get(s, 0), s))
                held[k] += load.get(s, 0)
            else:
                homeless.append((load.get(s, 0), s))
        for own in slots:
            own.sort()

        def put(x: tuple[int, int], k: int) -> None:
            insort(slots[k], x)
            held[k] += x[0]
            owner[x[1]] = k

        def take(x: tuple[int, int], k: int) -> None:
            del slots[k][bisect_left(slots[k], x)]
            held[k] -= x[0]

        for x in sorted(homeless, reverse=True):
            put(x, min(range(n), key=lambda k: (held[k], k)))
        enough = TOLERANCE * sum(held) / n
        givers = set(range(n))
        while givers:
            high, low = max(givers, key=lambda k: (held[k], -k)), min(range(n), key=lambda k: (held[k], k))
            gap = held[high] - held[low]
            if gap <= enough:
                break
            best = None  # (how far from closing half the gap, slot that goes, slot that comes)
            for back in [(0, -1), *slots[low]]:
                at = bisect_left(slots[high], (back[0] + gap / 2, -1))
                for x in slots[high][max(at - 1, 0) : at + 1]:
                    if 0 < x[0] - back[0] < gap:
                        found = (abs(2 * (x[0] - back[0]) - gap), x, back)
                        best = found if best is None else min(best, found)
                if back[1] < 0 and best is not None and best[0] < gap / 2:
                    break  # a plain move that closes most of the gap
            if best is None:  # a slot as large as this shard: the others are levelled without it
                givers.remove(high)
                continue
            _, x, back = best
            take(x, high)
            put(x, low)
            if back[1] >= 0:
                take(back, low)
                put(back, high)
        return self.edit([(s, old, new) for s, (old, new) in enumerate(zip(self.owner, owner, strict=True)) if old != new], n)


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Narrow rows (id, size, crc, virtual slot): the text itself is never shuffled.

    A record hashes to its slot by id, text and, among rows alike in both, its number there; so rows
    that repeat, however often, are spread over the slots. They are counted first, which combines
    before the shuffle, and made again from the counts; more than COPIES of one row by several tasks.
    """
    text = F.col(text_col)
    alike = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    ).groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    own = ("doc_id", "size", "text_crc32")
    first = alike.select(*own, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))).alias("at"))
    many = first.where(F.col("n") > COPIES).repartition(*own, "at")
    each = first.where(F.col("n") <= COPIES).unionByName(many).select(*own, F.explode(F.sequence("at", F.least(F.col("at") + COPIES, "n") - 1)).alias("copy"))
    return each.select(*own, F.pmod(F.xxhash64(*own, "copy"), F.lit(slots)).cast("int").alias("virtual_slot"))


def slot_loads(rows: DataFrame) -> DataFrame:
    """Bytes and rows of each slot: a partial aggregation, then at most as many rows as there are slots."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count(F.lit(1)).alias("slot_rows"))


def shard(docs: DataFrame, shards: int = 40, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text", old: SlotMap | None = None, maps: str | None = None) -> tuple[DataFrame, SlotMap]:
    """Put every row into a shard so that the shards' bytes are near equal (law ``bytes``).

    Result: doc_id, size (UTF-8 bytes of the text plus 16; a null text has none), text_crc32, law,
    shard, slot (the row's place in its shard, from 0 without gaps), grown_shard (null under this
    law), virtual_slot, map_version. Repeated ids and repeated rows are spread over slots; which of the
    rows that are alike gets which slot is not told apart. Null ids and texts hash like any value; a very
    long text counts by its bytes, which no slot can divide. An empty table gives an empty result and the
    even map. The map before and after balancing is stored in the folder ``maps`` (scratch if none is
    named), and rows get their shards from the stored map. The driver holds one number pair for each of
    the fixed slots, whatever the input's size.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    rows = scratch.keep(records(docs, id_col, text_col, slots))
    found = {r["virtual_slot"]: (r["slot_bytes"], r["slot_rows"]) for r in slot_loads(rows).collect()}
    before = old or SlotMap.even(shards, slots)
    plan = before.rebalanced({s: b for s, (b, _) in found.items()}, shards)
    maps = maps or f"{scratch.root}/maps"
    for version in (before, plan):
        store_map(spark, version, maps)
    start, entries = [0] * shards, []
    for s, k in enumerate(load_map(spark, maps, plan.version).owner):
        entries.append((s, k, start[k]))
        start[k] += found.get(s, (0, 0))[1]
    owners = spark.createDataFrame(entries, "virtual_slot int, shard int, first_place long")
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    out = rows.withColumn("place", place).join(F.broadcast(owners), "virtual_slot")
    return (
        out.select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("first_place") + F.col("place") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(plan.version).alias("map_version"),
        ),
        plan,
    )


def store_map(spark, plan: SlotMap, path: str) -> None:
    """Store a version of the map as a table of its own (slot, shard, shards) below ``path``. Storing it again changes nothing."""
    rows = [(s, k, plan.shards) for s, k in enumerate(plan.owner)]
    spark.createDataFrame(rows, "slot int, shard int, shards int").coalesce(1).write.mode("overwrite").parquet(f"{path}/version={plan.version}")


def load_map(spark, path: str, version: int | None = None) -> SlotMap:
    """A version of a stored map, the newest by default, with the edits since the oldest one stored. Bounded by slots and versions."""
    by: dict[int, dict[int, int]] = {}
    count: dict[int, int] = {}
    for r in spark.read.parquet(path).collect():
        by.setdefault(r["version"], {})[r["slot"]] = r["shard"]
        count[r["version"]] = r["shards"]
    version = max(by) if version is None else version
    stored = sorted(v for v in by if v <= version)
    history = [[(s, k, by[v][s]) for s, k in sorted(by[u].items()) if by[v][s] != k] for u, v in zip(stored, stored[1:], strict=False)]
    return SlotMap([k for _, k in sorted(by[version].items())], count[version], version, history)
