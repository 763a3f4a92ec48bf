"""Personal data by gradient-boosted candidates, in DataFrame functions only.

Patterns of exact format give the base spans. Generators of high recall propose further ones, which
may overlap; boosted trees over their format and the words around them score each, and those that
reach their kind's calibrated threshold join the base spans. The trees are fitted on the driver from
a bounded number of generated sentences and run as nested CASE expressions.
"""

from __future__ import annotations

import json
import random
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: The base formats. Fixed values, written so that Java's matcher neither recurses nor goes back over long runs:
#: ``++`` where what follows cannot match inside the run, and starts only where a run starts or the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a base span to be possible: cheap to look for. Fixed values.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
#: Digits of a card and of a phone number.
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)
#: Code points of context on each side.
AROUND = 32
#: Hits of a text that are summed at a time.
BLOCK = 256


@dataclass(frozen=True)
class Generator:
    kind: str
    hint: str
    pattern: str


#: Proposals beyond the base: spelt-out addresses, IPv6 and defanged addresses, digit runs of other card lengths
#: and separators, and numbers written as telephone numbers often are.
GENERATORS = (
    Generator("email", r"(?i)[\[({] ?(?:at|arroba|@) ?[\])}]|[\[({ ](?:dot|punto|ponto|punkt)[\])} ]|\S@ | @\S", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|[\[({] ?(?:at|arroba|@) ?[\])}]| at | arroba ) ?[A-Za-z0-9-]++(?: ?(?:\.|[\[({] ?(?:dot|punto|ponto|punkt) ?[\])}]| dot | punto | ponto | punkt ) ?[A-Za-z0-9-]++)++"),
    Generator("ip", r"[0-9A-Fa-f:]:[0-9A-Fa-f]{0,4}:", r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,8}+(?![0-9A-Za-z:])"),
    Generator("ip", r"[0-9] ?[\[(]\.[\])]", r"(?<![0-9.])[0-9]{1,3}+(?: ?[\[(]\.[\])] ?[0-9]{1,3}+){3}(?![0-9])"),
    Generator("card", r"[0-9](?:[ ._/-]{0,2}[0-9]){12}", r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9]){12,18}(?![0-9])"),
    Generator("phone", r"[0-9]\)?[ ./-]{1,2}\(?[0-9]{2}", r"(?<![0-9A-Za-z@._+/-])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z@]|[./-][0-9])"),
)

#: Words before a span that speak for its kind, in the languages of the corpus, and words that speak for other numbers. Fixed values.
CUES = {
    "email": r"mail|contact|kontakt|contacto|contato|write|schreib|escrib|écri",
    "ip": r"\bip\b|ipv|addr|adress|direcc|endere|host|server|serv|login|ping",
    "card": r"card|visa|master|amex|karte|carte|tarjeta|cartão|cartao|credit|credito|débito|debit",
    "phone": r"tel|phon|fon|fax|call|mobil|cell|celular|whatsapp|sms|appel|llam|ligue|ruf|dial|handy|portable",
}
AGAINST = r"isbn|issn|order|invoice|bestell|rechnung|factur|fatura|pedido|commande|total|sum|price|preis|prix|precio|preço|version|vers\.|v\.|ref|serial|tracking|page|seite|art\.|no\.|nr\.|nº|date|datum|fecha|time|uhr|mac|ratio|score|\$|€|£|build|figure"
_DATE = r"^(?:(?:19|20)[0-9]{2}[-/. ][0-9]{1,2}[-/. ][0-9]{1,2}|[0-9]{1,2}[-/. ][0-9]{1,2}[-/. ](?:[0-9]{2}){1,2}|(?:19|20)[0-9]{2}[-/ ](?:19|20)?[0-9]{2})$"
_CARD = r"^(?:4[0-9]{12}(?:[0-9]{3}){0,2}|5[1-5][0-9]{14}|2[2-7][0-9]{14}|3[47][0-9]{13}|3[0689][0-9]{12}|6[0-9]{15,18})$"
_ENDS = r"(?i)(?:com|org|net|edu|gov|info|io|eu|br|pt|de|fr|es|uk|us|ch|at|mx|ar|example)$"


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right. For short strings."""
    def add(total: Column, k: Column) -> Column:
        d = F.substring(digits, -k, F.lit(1)).cast("int")
        return total + F.when(k % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]+", "")


def _valid(kind: str, hit: Column) -> Column:
    """Whether a match of a base format counts."""
    if kind == "ip":
        bare = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(hit, r"\."), lambda p: (F.length(bare(p)) <= 3) & (F.coalesce(bare(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(F.length(_digits(hit)).between(*CARD_DIGITS), _luhn(_digits(hit))).otherwise(False)
    return F.length(_digits(hit)).between(*PHONE_DIGITS) if kind == "phone" else F.lit(True)


def _running(sizes: Column) -> Column:
    """Sums of an array up to each element, not included; block by block, so that a long array costs little more than its length."""
    def sums(xs: Column, first: Column) -> Column:  # one more than xs
        return F.aggregate(xs, F.array(first), lambda a, y: F.concat(a, F.array(F.element_at(a, -1) + y)))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda b: F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK)))
    firsts = sums(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, y: a + y)), F.lit(0))
    return F.flatten(F.zip_with(blocks, F.slice(firsts, F.lit(1), F.size(blocks)), lambda b, first: F.slice(sums(b, first), F.lit(1), F.size(b))))


def _found(d: DataFrame, wanted: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Adds arrays of the matches of patterns, each a name with (text column, pattern, hint): hits, gaps (what lies before, between and after them) and starts; null without any."""
    hits, gaps, starts = (lambda n: f"{n}_hits"), (lambda n: f"{n}_gaps"), (lambda n: f"{n}_starts")
    before = lambda n: F.slice(gaps(n), F.lit(1), F.size(hits(n)))
    d = d.withColumns({hits(n): F.when(F.col(t).rlike(hint), F.regexp_extract_all(F.col(t), F.lit(pattern), F.lit(0))) for n, (t, pattern, hint) in wanted.items()})
    d = d.withColumns({gaps(n): F.when(F.size(hits(n)) > 0, F.split(F.col(t), pattern, -1)) for n, (t, pattern, _) in wanted.items()})
    d = d.withColumns({starts(n): F.when(F.col(gaps(n)).isNotNull(), F.zip_with(before(n), hits(n), lambda g, h: F.length(g) + F.length(h))) for n in wanted})
    return d.withColumns({starts(n): F.when(F.col(gaps(n)).isNotNull(), F.zip_with(_running(F.col(starts(n))), before(n), lambda s, g: s + F.length(g))) for n in wanted})


def _without(d: DataFrame, names) -> DataFrame:
    return d.drop(*[f"{n}_{x}" for n in names for x in ("hits", "gaps", "starts")])


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """Adds for each kind its base spans, an array of (start, end) in code points, and the text with them blotted out, where its generators look on."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    d = _found(docs, {k: (text, BASE[k], HINTS[k]) for k in KINDS})
    checked = lambda k: F.zip_with(f"{k}_starts", f"{k}_hits", lambda s, h: F.struct(s.alias("start"), (s + F.length(h)).alias("end"), _valid(k, h).alias("ok")))
    d = d.withColumns({f"{k}_checked": checked(k) for k in KINDS})
    passed = lambda k: F.transform(F.filter(f"{k}_checked", lambda x: x["ok"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    d = d.withColumns({f"{k}_base": F.coalesce(passed(k), none) for k in KINDS})
    blot = lambda h, x: F.when(x["ok"], F.repeat(F.lit("\x01"), F.length(h))).otherwise(h)
    rest = lambda k: F.array_join(F.concat(F.zip_with(F.slice(f"{k}_gaps", F.lit(1), F.size(f"{k}_hits")), F.zip_with(f"{k}_hits", f"{k}_checked", blot), lambda g, h: F.concat(g, h)), F.slice(f"{k}_gaps", -1, 1)), "")
    d = d.withColumns({f"{k}_rest": F.when(F.size(f"{k}_base") > 0, rest(k)).otherwise(F.col(text)) for k in KINDS})
    return _without(d, KINDS).drop(*[f"{k}_checked" for k in KINDS])


def candidates(docs: DataFrame) -> DataFrame:
    """Adds ``proposed``: candidates of all generators with kind, start, end and features, an array that may overlap; null without any."""
    names = [f"g{k}" for k in range(len(GENERATORS))]
    d = _found(docs, {n: (f"{g.kind}_rest", g.pattern, g.hint) for n, g in zip(names, GENERATORS, strict=True)})

    def raw(n: str, kind: str) -> Column:
        around = F.zip_with(F.slice(f"{n}_gaps", F.lit(1), F.size(f"{n}_hits")), F.slice(f"{n}_gaps", F.lit(2), F.size(f"{n}_hits")), lambda a, b: F.struct(F.right(a, F.lit(AROUND)).alias("before"), F.left(b, F.lit(AROUND)).alias("after")))
        own = F.zip_with(f"{n}_starts", f"{n}_hits", lambda s, h: F.struct(s.alias("start"), h.alias("hit")))
        return F.zip_with(own, around, lambda x, y: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["hit"].alias("hit"), y["before"].alias("before"), y["after"].alias("after")))

    none = F.array().cast("array<struct<kind:string,start:int,hit:string,before:string,after:string>>")
    every = F.flatten(F.array(*[F.coalesce(raw(n, g.kind), none) for n, g in zip(names, GENERATORS, strict=True)]))
    some = F.coalesce(*[F.col(f"{n}_gaps") for n in names]).isNotNull()
    d = _without(d.withColumn("proposed", F.when(some, every)), names)
    d = d.withColumn("proposed", F.transform("proposed", _parts))
    return d.withColumn("proposed", F.transform("proposed", _features))


#: Features in the order in which the trees number them.
FEATURES = ("kind", "size", "digits", "letters", "groups", "first", "last", "longest", "shortest", "luhn", "lead", "brackets", "colons", "gaps", "card", "marks", "cue", "against", "next", "date", "octets", "spelt", "ends", "year")


def _parts(x: Column) -> Column:
    """A candidate with its digits and groups, which many features use."""
    groups = F.filter(F.split(x["hit"], "[^0-9A-Za-z]+", -1), lambda g: g != "")
    names = ("kind", "start", "hit", "after")
    return F.struct(*[x[n].alias(n) for n in names], F.lower(x["before"]).alias("before"), _digits(x["hit"]).alias("digits"), groups.alias("groups"), F.transform(groups, lambda g: F.length(g)).alias("sizes"))


def _features(x: Column) -> Column:
    """Format and context of a candidate as whole numbers."""
    hit, low, digits, sizes = x["hit"], x["before"], x["digits"], x["sizes"]
    n = F.length(digits)
    yes = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    at = lambda k: F.coalesce(F.try_element_at(sizes, F.lit(k)), F.lit(0))
    without = lambda pattern: F.length(F.regexp_replace(hit, pattern, ""))
    pick = lambda of: reduce(lambda c, k: c.when(x["kind"] == k, of(k)), KINDS[1:], F.when(x["kind"] == KINDS[0], of(KINDS[0])))
    values = {
        "kind": pick(lambda k: F.lit(KINDS.index(k))), "size": F.length(hit), "digits": n, "letters": without("[^A-Za-z]+"), "groups": F.size(sizes), "first": at(1), "last": at(-1),
        "longest": F.coalesce(F.array_max(sizes), F.lit(0)), "shortest": F.coalesce(F.array_min(sizes), F.lit(0)), "luhn": F.when(n.between(12, 19), yes(_luhn(digits))).otherwise(-1),
        "lead": F.when(hit.startswith("+"), 3).when(hit.startswith("00"), 2).when(hit.startswith("(") | hit.startswith("0"), 1).otherwise(0), "brackets": yes(hit.rlike(r"[()\[\]{}]")),
        "colons": without("[^:]+"), "gaps": yes(hit.contains("::")), "card": yes(digits.rlike(_CARD)), "marks": without("[0-9A-Za-z ]+"), "cue": yes(pick(lambda k: low.rlike(CUES[k]))), "against": yes(low.rlike(AGAINST)),
        "next": F.when(x["after"].rlike(r"^[%°$€£]|^ ?(?:eur|usd|brl|kg|km|mm|cm|ms)\b"), 2).when(x["after"].rlike("^[0-9A-Za-z_]"), 1).otherwise(0), "date": yes(hit.rlike(_DATE)),
        "octets": yes(F.forall(x["groups"], lambda g: (F.length(g) <= 3) & (F.coalesce(g.try_cast("int"), F.lit(999)) <= 255))), "spelt": F.when(hit.rlike(r"[\[({] ?(?i:at|arroba|@)"), 3).when(hit.rlike(r"(?i) (?:at|arroba) "), 2).when(hit.rlike(" @|@ "), 1).otherwise(0),
        "ends": yes(hit.rlike(_ENDS)), "year": yes(hit.rlike(r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])")),
    }
    return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), (x["start"] + F.length(hit)).alias("end"), *[values[f].cast("int").alias(f"f{k}") for k, f in enumerate(FEATURES)])


# --- the trees ------------------------------------------------------------------------------------
#: Generated sentences that a model is fitted on, the share of them that calibrates its thresholds, and the precision asked of a kind there.
EXAMPLES, CALIBRATION, PRECISION = 6000, 0.3, 0.995
TREES, DEPTH, RATE, LEAST = 48, 3, 0.25, 5.0


@dataclass
class Model:
    """Boosted trees: a start and, for each tree, (feature, limit, below, above) or a leaf's number; thresholds by kind, None where none is safe."""

    start: float = 0.0
    trees: list = field(default_factory=list)
    thresholds: dict[str, float | None] = field(default_factory=dict)

    def score(self, x) -> float:
        def leaf(node) -> float:
            while not isinstance(node, float):
                k, limit, below, above = node
                node = below if x[k] <= limit else above
            return node

        return self.start + sum(leaf(t) for t in self.trees)

    def sql(self, of: str = "c") -> str:
        def case(node) -> str:
            if isinstance(node, float):
                return f"{node!r}D"
            k, limit, below, above = node
            return f"(CASE WHEN {of}.f{k} <= {limit} THEN {case(below)} ELSE {case(above)} END)"

        return " + ".join([f"{self.start!r}D", *map(case, self.trees)])

    def passes(self, of: str = "c") -> str:
        """SQL of whether a candidate reaches its kind's threshold."""
        safe = [f"WHEN '{k}' THEN {v!r}D" for k, v in self.thresholds.items() if v is not None]
        return f"({self.sql(of)}) >= (CASE {of}.kind {' '.join(safe)} END)" if safe else "false"


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Model:
    """Trees by Newton steps on the log loss, each split the best of all features and limits."""
    rate = float(np.clip(y.mean() if len(y) else 0, 0.01, 0.99))
    model, z = Model(round(float(np.log(rate / (1 - rate))), 6)), None
    z = np.full(len(y), model.start)
    for _ in range(trees if len(set(y)) > 1 else 0):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        out = np.zeros(len(y))
        model.trees.append(_grow(x, g, h, np.arange(len(y)), DEPTH, out))
        z += out
    return model


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, own: np.ndarray, depth: int, out: np.ndarray):
    total_g, total_h = g[own].sum(), h[own].sum()
    best = (1e-6, 0, 0)
    for k in range(x.shape[1] if depth else 0):
        v = x[own, k]
        low = int(v.min())
        gs, hs = np.cumsum(np.bincount(v - low, g[own])), np.cumsum(np.bincount(v - low, h[own]))
        gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
        gain[(hs < LEAST / 10) | (total_h - hs < LEAST / 10)] = 0
        j = int(np.argmax(gain))
        if gain[j] > best[0]:
            best = (float(gain[j]), k, low + j)
    if best[0] <= 1e-6:
        leaf = round(float(RATE * total_g / (total_h + 1)), 6)
        out[own] = leaf
        return leaf
    _, k, limit = best
    left = x[own, k] <= limit
    return (k, limit, _grow(x, g, h, own[left], depth - 1, out), _grow(x, g, h, own[~left], depth - 1, out))


def calibrate(scores: np.ndarray, y: np.ndarray, precision: float = PRECISION, least: int = 20) -> float | None:
    """The smallest score at and above which held-back examples are right in ``precision`` of cases; None if fewer than ``least`` are."""
    order = np.argsort(-scores, kind="stable")
    s, right = scores[order], np.cumsum(y[order])
    n = np.arange(1, len(s) + 1)
    last = np.append(s[1:] != s[:-1], True)  # ties pass together
    ok = np.flatnonzero(last & (right >= precision * n) & (right >= least))
    return round(float(s[ok[-1]]) - 1e-6, 6) if len(ok) else None


def fit(rows: list, examples_y: list[int], halves: list[bool]) -> Model:
    """A model of candidates' features (rows with f0, f1, ...) and labels; ``halves`` says which calibrate."""
    x = np.array([[r[f"f{k}"] for k in range(len(FEATURES))] for r in rows], np.int64).reshape(-1, len(FEATURES))
    y, held = np.array(examples_y, float), np.array(halves, bool)
    model = boost(x[~held], y[~held])
    kinds = np.array([KINDS.index(r["kind"]) for r in rows])
    for k, kind in enumerate(KINDS):
        own = np.flatnonzero(held & (kinds == k))
        model.thresholds[kind] = calibrate(np.array([model.score(x[j]) for j in own]), y[own])
    return model


def train(spark: SparkSession, examples: int = EXAMPLES, seed: int = 11) -> Model:
    """Fit on ``examples`` generated sentences (the bound of the sample), each with one span that is or only looks like personal data.

    Their candidates and features come from the same expressions as those of documents. Nothing of
    the corpus is read, so the model is the same at every size; the seed decides it.
    """
    made = [sentence(random.Random(f"{seed}:{k}")) for k in range(examples)]
    # a literal, so that no rows pass through Python on the way to the executors
    literal = F.from_json(F.lit(json.dumps([t for t, _, _, _ in made])), "array<string>")
    texts = spark.range(1).select(F.posexplode(literal).alias("id", "t")).repartition(8, "id")
    rows, ys, halves = [], [], []
    # arrays as they are: a filter that comes with an explode would be pushed down and repeat every expression above
    for line in candidates(base_spans(texts, "t")).select("id", "proposed").orderBy("id").collect():  # at most a few candidates for each sentence
        _, kind, at, y = made[line["id"]]
        for r in line["proposed"] or ():
            hit = y and r["kind"] == kind and (r["start"], r["end"]) == at
            touches = r["start"] < at[1] and at[0] < r["end"]
            if hit or not y or not touches:  # a part or a stretch of a true span teaches nothing
                rows.append(r), ys.append(int(hit)), halves.append(random.Random(line["id"]).random() < CALIBRATION)
    return fit(rows, ys, halves)


# --- generated sentences --------------------------------------------------------------------------
_FILL = "the of and to in that was for on are with they at be this have from one had by hot word but what some we can out other were all there when up use your how said an each she which do their time if will way about many then them der die das und ist nicht el la los que por con le les des une pour dans não uma mais como para".split()
_LEADS = {
    "email": "mail e-mail email contact Kontakt contacto contato".split(), "ip": "IP host server address Adresse login ping".split(),
    "card": "card Visa credit Karte carte tarjeta cartão Mastercard".split(), "phone": "tel phone call Fax mobile Telefon llame ligue appelez cell WhatsApp".split(),
}
_OTHERS = "order invoice ISBN total version ref serial date page price Rechnung pedido tracking MAC ratio build".split()


def _run(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _checked(digits: str, right: bool) -> str:
    """Digits whose last is the right check digit, or another."""
    twice = lambda d: d * 2 - 9 * (d > 4)
    total = sum(twice(int(c)) if k % 2 == 0 else int(c) for k, c in enumerate(reversed(digits[:-1])))
    last = -total % 10
    return digits[:-1] + str(last if right else (last + 1 + int(digits[-1]) % 9) % 10)


def _true(rng: random.Random, kind: str) -> str:
    name = lambda: rng.choice(_FILL) + rng.choice(["", ".", "_", "-"]) + rng.choice(_FILL) + rng.choice(["", _run(rng, 2)])
    if kind == "email":
        host, end = rng.choice(_FILL) + rng.choice(_FILL), rng.choice("com org net edu de fr es pt io uk".split())
        dot = rng.choice(["{0}", " {0} "]).format(rng.choice(["[dot]", "(dot)", "{dot}", "(punkt)", "[punto]"])) if rng.random() < 0.6 else rng.choice([" dot ", "."])
        at = rng.choice(["[at]", "(at)", " [at] ", " (at) ", "{at}", " (arroba) ", "[@]", "(@)"]) if dot != " dot " else rng.choice([" at ", " (at) ", "[at]"])
        return name() + at + host + dot + end
    if kind == "ip":
        if rng.random() < 0.3:
            dot = rng.choice(["[.]", "(.)", " [.] "])
            return dot.join(str(rng.randrange(256)) for _ in range(4))
        part = lambda: f"{rng.randrange(16**rng.choice([4, 4, 4, 3, 2])):x}"
        full = [part() for _ in range(8)]
        if rng.random() < 0.5:
            return ":".join(full)
        a = rng.randrange(2, 6)
        return ":".join([rng.choice(["2001", "fe80", "2a02", "fd00", part()]), *full[1:a]]) + "::" + ":".join(full[a : rng.randrange(a + 1, 8)])
    if kind == "card":
        n, first = rng.choice([(15, "34"), (15, "37"), (14, "36"), (14, "38"), (16, "4"), (16, "51"), (16, "55"), (13, "4"), (16, "6011")])
        d = _checked((first + _run(rng, n))[:n], True)
        cut = [4, 6, n - 10] if n in (14, 15) else [4, 4, 4, n - 12]
        at, parts = 0, []
        for c in cut:
            parts.append(d[at : at + c])
            at += c
        return rng.choice([d, " ".join(parts), "-".join(parts)] if n < 16 else [".".join(parts), " - ".join(parts)[:0] or "  ".join(parts), "_".join(parts), "/".join(parts)])
    a, b, c = str(rng.randrange(201, 990)), str(rng.randrange(200, 999)), _run(rng, 4)
    forms = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}){' '}{b} {c}", f"0{a[:2]} {_run(rng, 4)} {c}", f"00{a[:2]} {a} {b} {c}", f"0{a}/{_run(rng, 3)} {c}", f"({a[:2]}) 9{_run(rng, 4)}-{c}", f"0{rng.randrange(1, 10)} {_run(rng, 2)} {_run(rng, 2)} {_run(rng, 2)} {_run(rng, 2)}"]
    return rng.choice(forms)


def _false(rng: random.Random, kind: str) -> str:
    word = lambda: rng.choice(_FILL)
    if kind == "email":
        return rng.choice([f"{word()} @ {word()}. {word()}", f"{word()} at {word()}. {word()}", f"{word()} at {word()}.{word()}", f"{word()} @ {word()}.{word()}", f"{word()} at {word()} dot {word()} dot {word()}", f"{word()}@ {word()}. {word()}", f"{word()} (at) {word()}. {word()}"])
    if kind == "ip":
        two = lambda: f"{rng.randrange(60):02d}"
        mac = ":".join(f"{rng.randrange(256):02x}" for _ in range(6))
        return rng.choice([f"{two()}:{two()}:{two()}", mac, mac.upper(), f"{rng.randrange(20)}:{rng.randrange(20)}:{rng.randrange(20)}", "::", f"{two()}:{two()}:{two()}:{two()}", f"{rng.randrange(300, 999)}[.]{rng.randrange(300, 999)}[.]1[.]{rng.randrange(999)}"])
    if kind == "card":
        n = rng.randrange(13, 20)
        plain = _run(rng, n)
        wrong = _checked(rng.choice("3456") + _run(rng, n - 1), False)
        four = " ".join(wrong[k : k + 4] for k in range(0, n, 4))
        return rng.choice([plain, plain, wrong, four, four.replace(" ", "-"), "978" + _run(rng, 10), "17" + _run(rng, 11), four.replace(" ", ".")])
    date = rng.choice([f"{rng.randrange(1900, 2100)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}", f"{rng.randrange(1, 29)}/{rng.randrange(1, 13)}/{rng.randrange(1900, 2100)}", f"{rng.randrange(1, 29):02d}.{rng.randrange(1, 13):02d}.{rng.randrange(1900, 2100)}", f"{rng.randrange(1900, 2100)}-{rng.randrange(1900, 2100)}"])
    dotted = ".".join(str(rng.randrange(256)) for _ in range(4))
    money = rng.choice([f"{rng.randrange(1, 999)} {_run(rng, 3)}", f"{rng.randrange(1, 999)}.{_run(rng, 3)}.{_run(rng, 3)}", f"{rng.randrange(1, 99)} {_run(rng, 3)} {_run(rng, 3)}"])
    card = " ".join(_run(rng, 4) for _ in range(4))
    many = " ".join(_run(rng, rng.randrange(2, 5)) for _ in range(rng.randrange(2, 6)))
    code = f"{_run(rng, 3)}-{rng.randrange(1, 9)}-{_run(rng, 5)}"
    return rng.choice([date, date, dotted, money, card, many, code, f"{_run(rng, 2)}-{_run(rng, 3)}", f"978-{_run(rng, 1)}-{_run(rng, 4)}-{_run(rng, 4)}-{_run(rng, 1)}"])


def sentence(rng: random.Random) -> tuple[str, str, tuple[int, int], bool]:
    """A sentence with one span: text, kind, (start, end) and whether it is personal data."""
    kind, y = rng.choice(KINDS), rng.random() < 0.45
    span = _true(rng, kind) if y else _false(rng, kind)
    words = lambda: [rng.choice(_FILL) for _ in range(rng.randrange(0, 8))]
    cue = rng.random()
    lead = rng.choice(_LEADS[kind]) if cue < (0.75 if y else 0.3) else rng.choice(_OTHERS) if cue > (0.97 if y else 0.6) else rng.choice(_FILL)
    before = " ".join([*words(), lead]) + rng.choice([": ", " ", ": ", " = "])
    after = rng.choice(["", ".", ",", " ", ") ", "; "]) + rng.choice(["", " "]) + " ".join(words())
    if after[:1].isalnum():
        after = " " + after
    return before + span + after, kind, (len(before), len(before) + len(span)), y


# --- the operator ---------------------------------------------------------------------------------
def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data in each whole text: doc_id, n_email, n_ip, n_card, n_phone, base, spans.

    ``base`` and ``spans`` are arrays of (kind, start, end) in code points, ends exclusive, by kind
    in the order of ``KINDS`` and then by start; the counts are of base spans. Base spans are the
    leftmost matches of a kind's format that do not overlap and pass its check; they always stay.
    ``spans`` adds candidates of the trees, which overlap no base span of their kind but may overlap
    those of others. Null and empty texts have none; repeated rows and ids each keep a row; an empty
    table gives no rows; other columns are ignored; very long texts are read whole. A narrow scan.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    d = candidates(base_spans(d, "t"))
    named = lambda spans, kind: F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    d = d.withColumn("added", F.when(F.col("proposed").isNotNull(), F.expr(f"filter(proposed, c -> {model.passes('c')})")))
    d = d.withColumn("base", F.concat(*[named(F.col(f"{k}_base"), k) for k in KINDS]))
    of = lambda kind: F.filter("added", lambda c: c["kind"] == kind)
    own = [F.array_sort(F.array_distinct(F.concat(named(F.col(f"{k}_base"), k), named(of(k), k)))) for k in KINDS]
    spans = F.when(F.size("added") > 0, F.concat(*own)).otherwise(F.col("base"))
    return d.select("doc_id", *[F.size(f"{k}_base").cast("long").alias(f"n_{k}") for k in KINDS], "base", spans.alias("spans"))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the text with each span replaced by its kind, as ``[EMAIL]``; of overlapping spans the first names the whole stretch."""
    found = scan(docs.select(F.struct(id_col, text_col).alias("row"), F.col(text_col).alias("t")), model, "row", "t")
    spans = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(a: Column, s: Column) -> Column:
        last = F.element_at(a, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        return F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["end"] > s["start"]), F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(longer))).otherwise(F.concat(a, F.array(s)))

    merged = F.aggregate(spans, F.array().cast("array<struct<start:int,end:int,kind:string>>"), step)
    d = found.select(F.col("doc_id")[id_col].alias("doc_id"), F.coalesce(F.col("doc_id")[text_col], F.lit("")).alias("t"), merged.alias("m"))
    before = lambda k: F.when(k > 0, F.get("m", k - 1)["end"]).otherwise(0)
    pieces = F.transform("m", lambda s, k: F.concat(F.substring(F.col("t"), before(k) + 1, s["start"] - before(k)), F.lit("["), F.upper(s["kind"]), F.lit("]")))
    rest = F.substring(F.col("t"), F.coalesce(F.try_element_at("m", F.lit(-1))["end"], F.lit(0)) + 1, F.length("t"))
    return d.select("doc_id", F.when(F.size("m") > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col("t")).alias("text"))
