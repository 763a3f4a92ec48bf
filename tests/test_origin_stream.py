"""The zone machine on a stream of shuffled chunks against the fold in batch."""

import random
import time

import pytest
from pyspark.sql import functions as F

from lexspark.operators import origin
from lexspark.plans import QUERIES
from lexspark.plans.base import t

SF = "/root/testdata/sf0.001"
SCORED = "document_id string, node_id string, seq long, canonical_start int, canonical_end int, number double, enter double, enter_reasons array<string>, exit double, exit_reasons array<string>, ref struct<id:string,name:string>"


def _rows(docs=12, seed=1):
    rng = random.Random(seed)
    out = []
    for d in range(docs):
        for k in range(rng.choice([1, 3, 20, 70])):
            enter = rng.choice([0.0, 0.0, 0.3, 0.6, 0.9])
            signs = rng.sample(["trigger_phrase", "quote_open", "target_ref"], rng.randrange(3))
            leave = rng.choice([0.0, 0.0, 0.3, 0.4, 0.7])
            ref = rng.choice([("", ""), ("LEI-1", "Lei Um"), ("DEC-2", "")])
            start = rng.choice([k * 10] * 9 + [-1])
            out.append((f"D{d}", f"D{d}#{k}", k, start, start + 9 if start >= 0 else -1, rng.choice([None, 1.0, 5.0, 200.0, 900.0]), enter, signs, leave, ["resume_sequence"] if leave else [], ref))
    return out


def _want(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r[0], r[2])):
        by.setdefault(r[0], []).append(r)
    out = {}
    for d, own in by.items():
        said = origin.zones([{"start": r[3], "end": r[4], "number": r[5], "enter": r[6], "enter_reasons": r[7], "exit": r[8], "exit_reasons": r[9], "id": r[10][0], "name": r[10][1]} for r in own])
        out |= {(d, r[1]): s for r, s in zip(own, said, strict=True)}
    return out


@pytest.fixture
def no_empty_batches(spark):
    """Timers by processing time ask for batch after batch; without empty ones a stream ends with its input."""
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def _stream(spark, batches, tmp_path, wait_ms=600_000, pause=0.0):
    src, sink = f"{tmp_path}/in", f"{tmp_path}/out"
    done = 0
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCORED).coalesce(1).write.mode("append").json(src)
        read = spark.readStream.schema(SCORED).json(src)
        q = origin.classify_stream(read, wait_ms=wait_ms).writeStream.format("parquet").option("path", sink).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        assert q.awaitTermination(60) and q.exception() is None
        done = k
        time.sleep(pause)
    return done, {(r.document_id, r.node_id): tuple(r)[2:] for r in spark.read.parquet(sink).collect()}


def test_a_shuffled_stream_says_what_the_batch_says(spark, tmp_path, no_empty_batches):
    rows = _rows()
    want = _want(rows)
    random.Random(3).shuffle(rows)
    cut = [rows[: len(rows) // 3], rows[len(rows) // 3 : len(rows) // 2], rows[len(rows) // 2 :]]
    _, got = _stream(spark, cut, tmp_path)
    assert got == want
    batch = origin.Zones()
    assert [batch.step({"start": None, "end": 1})] == [("self", False, "", "", "high", "")]


def test_a_missing_chunk_is_waited_for_and_then_left(spark, tmp_path, no_empty_batches):
    rows = [r for r in _rows(1, 5) if r[2] < 20]
    assert len(rows) >= 3
    gap = [r for r in rows if r[2] != 1]
    _, got = _stream(spark, [gap, [("other", "o#0", 0, 0, 9, None, 0.0, [], 0.0, [], ("", ""))]], tmp_path, wait_ms=1, pause=1.0)
    mine = {k[1]: v for k, v in got.items() if k[0] == rows[0][0]}
    assert set(mine) == {r[1] for r in gap}  # the timer let go what had waited
    assert {(rows[0][0], k): v for k, v in mine.items()} == _want(gap)


def test_batch_classification_streams_documents_of_any_length(spark):
    long = [("L", f"L#{k}", k * 900, k * 900 + 899) for k in range(1500)]
    text = "".join(("Art. 6º O art. 2º da Lei nº 8.987, de 13 de fevereiro de 1995, passa a vigorar com a seguinte redação: “Art. 2º Nova" if k % 200 == 100 else f"Art. {k % 7 + 1}º Texto.").ljust(900, "y") for k in range(1500))
    ch = spark.createDataFrame([(d, n, a, z, text[a:z], 1) for d, n, a, z in long] + [(None, "x", 0, 5, "Art. 1", 2), ("L", "L#0", -1, -1, "again", 3), ("Q", None, None, None, None, 4)], "document_id string, node_id string, canonical_start int, canonical_end int, text string, enter int")
    out = origin.classify(ch, spark.createDataFrame([("L", text)], "document_id string, canonical_text string"))
    assert out.count() == 1503 and sorted(r.enter for r in out.where("enter > 1").collect()) == [2, 3, 4]
    n = {r.origin_type: r["count"] for r in out.groupBy("origin_type").count().collect()}
    assert n["external"] >= 7
    assert out.where("document_id is null or canonical_start < 0").where("origin_type <> 'self'").count() == 0
    assert origin.classify(ch.limit(0), spark.createDataFrame([], "document_id string, canonical_text string")).count() == 0


@pytest.mark.parametrize("name", ["origin_zones", "origin_of_orders"])
def test_no_grouped_pandas(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "MapInPandas" in plan
    assert t(spark, SF, "orders").count() and F is not None
