import random
import time

from lexspark.operators import registry
from lexspark.sources import stores
from lexspark.streaming import ingest, limits


def test_only_admitted_requests_count():
    got = [a for a, _ in limits.admit([0, 1, 2, 3, 59.9, 60, 61], 3, 60)]
    assert got == [True, True, True, False, False, True, True]


def test_batches_fill_or_time_out(spark):
    times = [0, 0.01, 0.02, 0.03, 0.2, 0.21, 0.3]
    rows = [(key, float(t), k) for key in ("a", None) for k, t in enumerate(times)]
    items = spark.createDataFrame(rows, "key string, s double, id long").selectExpr("key", "timestamp_micros(cast(s * 1000000 as long)) AS ts", "id")
    got = sorted(((r.key, r.id, r.batch, r.place) for r in limits.group_batches(items, 3, 50).collect()), key=str)
    assert got == sorted(((key, k, *x) for key in ("a", None) for k, x in enumerate([(0, 0), (0, 1), (0, 2), (1, 0), (2, 0), (2, 1), (3, 0)])), key=str)
    assert limits.group_batches(items.limit(0)).count() == 0


def _requests(spark):
    rng = random.Random(0)
    rows = [(f"k{rng.randrange(5)}", float(t), t) for t in range(0, 600, 2)]
    return spark.createDataFrame(rows, "key string, s double, id long").selectExpr("key", "timestamp_seconds(s) AS ts", "id")


def test_stream_admits_as_the_batch_does(spark, tmp_path):
    r = _requests(spark)
    want = {(x.key, x.id): x.admitted for x in limits.admit_batch(r, 7, 60).collect()}
    assert 0 < sum(want.values()) < len(want)
    src = str(tmp_path / "in")
    for k in range(3):  # files in order of time
        r.where(f"id >= {200 * k} AND id < {200 * (k + 1)}").coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = limits.admit_stream(stream, 7, 60).writeStream.format("memory").queryName("admitted").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    got = {(x.key, x.id): x.admitted for x in spark.table("admitted").collect()}
    assert got == want


def test_windowed_stream_equals_batch(spark, tmp_path):
    r = _requests(spark)
    r.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(r.schema).parquet(str(tmp_path / "in")).selectExpr("key", "ts", "cast(id as double) AS value")
    q = limits.tumbling(stream, "1 minute", ["key"]).writeStream.format("memory").queryName("tumbled").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = sorted(map(tuple, limits.tumbling(r.selectExpr("key", "ts", "cast(id as double) AS value"), "1 minute", ["key"]).collect()))
    assert sorted(map(tuple, spark.table("tumbled").collect())) == want


def test_landing_folder_to_sink(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.pdf").write_bytes(b"%PDF x")
    (inbox / "b.pdf").write_bytes(b"")
    (inbox / "c.txt").write_bytes(b"x")
    seen = []
    q = ingest.run(ingest.checked(ingest.landing(spark, str(inbox))), lambda df, n: seen.extend(df.select("path", "error").collect()), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert {r.path.rsplit("/", 1)[1]: r.error for r in seen} == {"a.pdf": None, "c.txt": "not_pdf"}  # file sources never yield empty files
    made = spark.createDataFrame([("/x/b.pdf", 0, bytearray()), ("/x/b.PDF", 1, bytearray(b"x"))], "path string, length long, content binary")
    assert [r.error for r in ingest.checked(made).collect()] == ["empty", None]


def test_versions_of_a_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    a = spark.createDataFrame([("x", 1, 1), ("y", 1, 1), ("x", 2, 5)], "k string, v int, at int")
    assert sorted(map(tuple, stores.replace_rows(spark, a, path, ["k"], "at").collect())) == [("x", 2, 5), ("y", 1, 1)]
    b = spark.createDataFrame([("y", 9, 0), ("z", 1, 1)], "k string, v int, at int")
    assert sorted(map(tuple, stores.replace_rows(spark, b, path, ["k"], "at").collect())) == [("x", 2, 5), ("y", 9, 0), ("z", 1, 1)]


def test_upserts_touch_only_their_buckets(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = lambda ks, v, at: spark.createDataFrame([(k, v, at) for k in ks], "k int, v int, at int")
    stores.replace_rows(spark, rows(range(200), 0, 0), path, ["k"], "at", buckets=16)
    files = {p.name for p in (tmp_path / "t").rglob("*.parquet")}
    out = stores.replace_rows(spark, rows([7], 1, 1), path, ["k"], "at")
    new = {p.name for p in (tmp_path / "t").rglob("*.parquet")} - files
    assert out.count() == 200 and [tuple(r) for r in out.where("k = 7").collect()] == [(7, 1, 1)] and len(new) == 1
    assert sorted(map(tuple, stores.table_rows(spark, path).collect())) == sorted(map(tuple, out.collect()))
    # a writer that read an old version finds its number taken
    import pytest

    version = stores.newest(spark, path)
    with pytest.raises(stores.Conflict):
        stores.commit(spark, path, version, {})
    for _ in range(4):
        stores.replace_rows(spark, rows([8], 2, 2), path, ["k"], "at", keep=2)
    assert len(list((tmp_path / "t" / "log").glob("*.json"))) == 2 and stores.table_rows(spark, path).count() == 200


def test_objects(spark, tmp_path):
    at = f"file://{tmp_path}/o/documents/d/v1/a.json"
    stores.put(spark, at, b"{}")
    assert stores.get(spark, at) == b"{}" and stores.stat(spark, at)["length"] == 2
    stores.put(spark, at, b"{1}")
    assert stores.get(spark, at) == b"{1}"
    assert stores.delete(spark, at) and stores.stat(spark, at) is None and not stores.delete(spark, at)
    row = spark.createDataFrame([("d", "v1", "a.json")], "i string, v string, n string").select(stores.object_key("i", "v", "n").alias("k")).first()
    assert row.k == "documents/d/v1/a.json"


def test_drift_states(spark):
    rows = [("d", "p", "1", "h1", 0), ("d", "p", "1", "h1", 10), ("d", "p", "1", "h2", 20), ("d", "p", "2", "h2", 30), ("d", "p", "1", "h2", 20 + 31 * 86400)]
    r = spark.createDataFrame(rows, "document_id string, pdf_hash string, pipeline_version string, canonical_hash string, s long").selectExpr("*", "timestamp_seconds(s) AS run_ts")
    assert [x.state for x in registry.drift(r).orderBy("s").collect()] == ["first_run", "deterministic", "drifted", "first_run", "first_run"]


def test_pdf_and_ocr_adapters(spark):
    pdfs = spark.createDataFrame([("A", b"one|two"), ("B", b"!")], "document_id string, content binary")

    def parse(raw):
        if raw == b"!":
            raise ValueError("broken")
        return [{"page_number": 1, "block_index": k, "text": t, "bbox": [0.0, float(-k), 1.0, 1.0]} for k, t in enumerate(raw.decode().split("|"))]

    got = stores.assemble(stores.parse_pdfs(pdfs, parse)).orderBy("char_start").collect()
    assert [(r.text, r.char_start, r.char_end) for r in got] == [("two", 0, 3), ("one", 4, 7)]

    def client(images):
        if images[0] == b"bad":
            raise TimeoutError
        return [images[0].decode()]

    pages = spark.createDataFrame([("A", 1, b"texto"), ("A", 2, b"bad")], "document_id string, page_number int, image_png binary")
    assert [r.text for r in stores.transcribe(pages, client).orderBy("page_number").collect()] == ["texto", ""]
    blocks = spark.createDataFrame([("A", 1, 0, "x", 0, 1)], "document_id string, page_number int, block_index int, text string, char_start int, char_end int")
    assert [len(r.blocks) for r in stores.pages_with_blocks(pages, blocks).orderBy("page_number").collect()] == [1, 0]


def test_remote_batches_and_retries(spark):
    from lexspark.sources import remote

    calls = []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise remote.Refused(503, "busy")
        return x

    assert remote.retried(flaky, sleep=lambda s: None)(7) == 7 and len(calls) == 3
    items = spark.createDataFrame([(k, None if k == 5 else k) for k in range(20)], "id int, x int").coalesce(1)

    def make():
        def call(xs):
            if 9 in xs:
                raise TimeoutError
            return [None if x != x or x is None else x * 2 for x in xs] if 13 not in xs else []

        return call

    got = {r.id: (r.result, r.error) for r in remote.scatter(items, make, "x", "long", most=4).collect()}
    assert all(got[k] == (2 * k, None) for k in (0, 1, 2, 3, 4, 6, 7, 16, 19)) and got[5] == (None, None)
    assert all(got[k] == (None, "TimeoutError") for k in range(8, 12)) and all(got[k] == (None, "0 results for 4 items") for k in range(12, 16))
    assert remote.scatter(items.limit(0), make, "x", "long").count() == 0


def test_a_model_must_answer_every_text(spark):
    import pytest

    from lexspark.operators import vectors

    texts = spark.createDataFrame([("a",), ("b",)], "text string").coalesce(1)
    with pytest.raises(Exception, match="vectors for"):
        vectors.embed(texts, lambda: lambda ts: ([], [])).collect()


def test_formats_and_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, t string")
    for fmt in ("parquet", "json", "orc"):
        stores.write(df, f"file://{tmp_path}/{fmt}", fmt)
        assert sorted(map(tuple, stores.read(spark, f"file://{tmp_path}/{fmt}", fmt, "k int, t string").collect())) == [(1, "a"), (2, "b")]
    stores.write(df, f"file://{tmp_path}/by", by=["k"])
    assert stores.files(spark, f"file://{tmp_path}/by", "*.parquet", content=False).count() == 2
