"""Range joins by bins, whole HTML blocks, manifests by grouping sets and sketches against plain Python."""

import html
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from lexspark.operators import quality, ranges, registry, rulings, statutes
from lexspark.sources import stores


def test_points_in_extents(spark):
    rng = random.Random(1)
    pts = [(rng.choice("ab"), k, rng.choice([None, rng.uniform(-50, 300), float(rng.randrange(0, 200, 20))])) for k in range(300)]
    ext = [(rng.choice("abc"), k, a := rng.choice([rng.uniform(-60, 250), float(rng.randrange(0, 200, 20)), None]), None if a is None else a + rng.choice([-5.0, 0.0, 3.0, 20.0, 150.0])) for k in range(60)] + [("a", 99, float("nan"), 5.0), ("a", 98, 0.0, float("inf"))]
    p, e = spark.createDataFrame(pts, "doc string, p int, at double"), spark.createDataFrame(ext, "doc string, e int, low double, high double")
    for closed in (False, True):
        got = sorted((r.p, r.e) for r in ranges.points_in(p, e, ["doc"], "at", "low", "high", 20, closed).collect())
        inside = lambda x, a, z, closed=closed: a <= x <= z if closed else a <= x < z
        assert got == sorted((i, j) for d, i, x in pts for f, j, a, z in ext if d == f and None not in (x, a, z) and abs(z) < float("inf") and inside(x, a, z))


def test_pages_of_offsets(spark):
    rng = random.Random(2)
    pages = [(f"D{d}", n, n * 3000, n * 3000 + rng.choice([2500, 3000, 4000])) for d in range(3) for n in range(1, 6)] + [("E", 1, 5, 5)]
    rows = [(rng.choice(["D0", "D0", "D0", "D1", "D2", "E", "none", None]), rng.choice([None, -1, 0, 3000, 5999, 6100, 10**6, rng.randrange(20000)]), k) for k in range(400)]

    def page(d, at):
        own = sorted((n, a, z) for e, n, a, z in pages if e == d)
        hit = [n for n, a, z in own if at is not None and a <= at < z]
        return hit[0] if hit else own[-1][0] if own else 1

    df = spark.createDataFrame(rows, "document_id string, char_start int, k int")
    out = rulings.on_pages(df, spark.createDataFrame(pages, "document_id string, page_number int, start int, end int"))
    assert {r.k: r.page_number for r in out.collect()} == {k: page(d, at) for d, at, k in rows} and out.columns == [*df.columns, "page_number"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "CartesianProduct" not in plan


def test_struck_blocks(spark):
    rng = random.Random(3)
    blocks = [("d", rng.randrange(3), k, [x := rng.uniform(0, 300), y := rng.uniform(0, 700), x + rng.choice([0.0, 50.0, 200.0]), y + rng.choice([10.0, 200.0])]) for k in range(80)] + [("d", 1, 999, None)]
    strokes = [("d", rng.randrange(3), x := rng.uniform(0, 300), y := rng.uniform(0, 800), x + rng.choice([10.0, 40.0, 250.0]), y + rng.choice([0.0, 1.0, 5.0])) for _ in range(120)]

    def hit(p, b):
        if b is None or b[2] <= b[0]:
            return False
        return any(q == p and x1 - x0 > 20 and abs(y1 - y0) < 3 and b[1] <= (y0 + y1) / 2 <= b[3] and (min(b[2], x1) - max(b[0], x0)) / (b[2] - b[0]) > 0.3 for _, q, x0, y0, x1, y1 in strokes)

    out = statutes.struck(spark.createDataFrame(blocks, "document_id string, page_number int, block_index int, bbox array<double>"), spark.createDataFrame(strokes, "document_id string, page_number int, x0 double, y0 double, x1 double, y1 double"))
    assert {r.block_index: r.has_strikethrough for r in out.collect()} == {k: hit(p, b) for _, p, k, b in blocks}


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.open, self.skip = [], False, 0

    def _block(self, tag, start):
        if tag in ("script", "style"):
            self.skip += 1 if start else -1
        elif tag in stores.HTML_BLOCKS:
            self.open = start and (tag == "p" or tag[0] == "h" and tag[1:].isdigit())
            if self.open:
                self.out.append("")
        elif tag == "br" and self.open:
            self.out[-1] += " "

    def handle_starttag(self, tag, attrs):
        self._block(tag, True)

    def handle_endtag(self, tag):
        self._block(tag, False)

    def handle_data(self, data):
        if self.open and not self.skip:
            self.out[-1] += data


def test_html_blocks_are_whole(spark):
    rng = random.Random(5)
    bits = ["<p>", "</p>", "<p class='a>b'>", '<P id="x">', "one ", "two <b>three</b> four", "<i><a href='?a=1&b=2'>link</a></i>", "<br>", "<br/>", "<h2>", "</h2>", "<div>", "</div>", "<li>", "&amp;lt;", "&copy; &#233;&#x4E2D;", "&unknown; & x", "<!-- <p>no</p> -->", "<script>var t='</p>';</script>", "<style>p{}</style>", "\n  ", "tail", "<pre>", "<param>", "ção"]
    pages = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) for _ in range(200)] + ["", None, "<p>" + "word <b>x</b> " * 20_000 + "</p>", "<p>one <b>two</b> three</p>", "<p><a>x</a></p>", "<p>open"]
    got = {}
    for r in stores.html_blocks(spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")).orderBy("document_id", "block_index").collect():
        got.setdefault(r.document_id, []).append(r.text)
    for k, page in enumerate(pages):
        parser = _Blocks()
        parser.feed(page or "")
        parser.close()
        want = [" ".join(x.replace("\xa0", "\0").split()).replace("\0", "\xa0") for x in parser.out]
        assert got.get(k, []) == [x for x in want if x], page and page[:300]


def test_characters_by_name_and_number(spark):
    texts = ["a &amp; b", "&lt;p&gt; &quot;x&quot; &#39;y&#x27;", "&amp;amp; &amp;#65;", "&#128512; &#x1F600;", "& &; &#; &#x; &#abc; &nosuch; &amp", "&hellip;&ndash;&euro;&ordm;", "", "none"]
    got = [r.x for r in spark.createDataFrame(list(enumerate(texts)), "k int, t string").orderBy("k").select(stores.unescaped(F.col("t")).alias("x")).collect()]
    # a name without its semicolon stays as it is here
    assert got == [html.unescape(t) if not t.startswith("& &;") else t for t in texts]
    bad = spark.createDataFrame([("&#0;&#xD800;&#99999999;&#99999999999999999999;",)], "t string").select(stores.unescaped(F.col("t")).alias("x")).first().x
    assert bad == "�" * 4


def test_manifest_levels_in_one_exchange(spark):
    rows = [("A", "article", "article", "external", 0, 10), ("A", "paragraph", "device", "self", 10, 5), ("B", "article", "article", "self", -1, -1), (None, None, "device", "self", 0, 3)]
    out = quality.manifest_levels(spark.createDataFrame(rows, "document_id string, device_type string, chunk_level string, origin_type string, canonical_start int, canonical_end int"))
    got = {(r.of, r.document_id, r.device_type, r.chunk_level): (r.chunks, r.external, r.chars) for r in out.collect()}
    assert got["", None, None, None] == (4, 1, 13) and got["document_id", "A", None, None] == (2, 1, 10) and got["document_id,device_type", "A", "paragraph", None] == (1, 0, 0)
    assert got["document_id", None, None, None] == (1, 0, 3) and got["device_type", None, "article", None] == (2, 1, 10) and len(got) == 1 + 3 + 4 + 4 + 3
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 1 and plan.count("Expand") == 1


def test_sketches_of_runs_merge(spark):
    df = spark.range(30000).selectExpr("id % 3 AS k", "concat('v', id % 9000) AS v", "id % 2 AS run").unionByName(spark.createDataFrame([(7, None, 0)], "k long, v string, run long"))
    halves = registry.merged(registry.sketches(df, ["k", "run"], "v"), ["k"])
    whole = registry.merged(registry.sketches(df, ["k"], "v"), ["k"])
    a, b = ({r.k: r.distinct_values for r in x.collect()} for x in (halves, whole))
    # a union estimates from its registers, a sketch that was filled row by row from their changes too
    assert set(a) == set(b) and all(abs(a[k] - b[k]) <= 0.02 * 3000 and abs(a[k] - 3000) < 0.04 * 3000 for k in (0, 1, 2)) and a[7] == b[7] == 0
