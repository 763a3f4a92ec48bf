"""Column expressions on legal identifiers, devices, relations and boxes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def roman_to_int(text: Column) -> Column:
    """Value of a Roman numeral; 9999 for anything else. A sign counts negative before a larger one."""
    t = F.upper(F.trim(text))
    signs = F.split(t, "")
    value = _map({"M": 1000, "D": 500, "C": 100, "L": 50, "X": 10, "V": 5, "I": 1})
    seen = F.transform(signs, lambda c: F.try_element_at(value, c))
    # from the right: add what is not below its right neighbour, subtract the rest
    total = F.aggregate(
        F.reverse(seen),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last")),
        lambda a, v: F.struct((a["sum"] + F.when(v < a["last"], -v).otherwise(v)).alias("sum"), v.alias("last")),
        lambda a: a["sum"],
    )
    return F.when(t.rlike("^[MDCLXVI]+$"), total).otherwise(9999)


def _dotted(digits: Column) -> Column:
    """Thousands separated by points; leading zeros dropped."""
    n = F.regexp_replace(digits, r"^0+(?=\d)", "")
    return F.when(F.length(n) > 3, F.regexp_replace(n, r"(?<=\d)(?=(\d{3})+$)", ".")).otherwise(digits)


def document_id(raw: Column) -> Column:
    """Canonical document id: upper case, hyphens, numbers from 1000 with points, a final four-digit part left as a year."""
    t = F.upper(F.trim(F.coalesce(raw, F.lit(""))))
    t = F.regexp_replace(t, r"(?iU)\bN[oOº°]?\.?\s*", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?U)[\s/_]+", "-"), r"-+", "-")
    parts = F.split(t, "-")
    last = F.size(parts) - 1
    dotted = F.transform(parts, lambda p, i: F.when(p.rlike(r"^\d+$") & ~((i == last) & (F.length(p) == 4)), _dotted(p)).otherwise(p))
    joined = F.when(last >= 1, F.array_join(dotted, "-")).otherwise(t)
    return F.regexp_replace(joined, r"^-+|-+$", "")


def node_id(raw: Column) -> Column:
    """prefix:DOCUMENT#SPAN with each part in canonical form; anything without a prefix stays."""
    prefix, rest = F.lower(F.substring_index(raw, ":", 1)), F.expr("1")
    rest = F.substring(raw, F.instr(raw, ":") + 1, F.length(raw))
    doc = F.substring_index(rest, "#", 1)
    span = F.when(F.instr(rest, "#") > 0, F.concat(F.lit("#"), F.upper(F.substring(rest, F.instr(rest, "#") + 1, F.length(rest))))).otherwise("")
    return F.when(F.coalesce(raw, F.lit("")) == "", "").when(F.instr(raw, ":") == 0, raw).otherwise(F.concat(prefix, F.lit(":"), document_id(doc), span))


#: Types and the shape of their numbers, in order.
_NAMED = (("LEI", r"\d+[\.\d]*"), ("IN", r"\d+"), ("DECRETO", r"\d+[\.\d]*"), ("PORTARIA", r"\d+"))


def document_id_in(text: Column) -> Column:
    """The first norm named in a text, by type in a fixed order, as a canonical id; null if none."""
    upper = F.upper(text)
    out = []
    for kind, number in _NAMED:
        p = rf"(?iuU)\b({kind})\s*[nNoOº°\.]*\s*({number})[/-]?(\d{{4}})?\b"
        num, year = F.replace(F.regexp_extract(upper, p, 2), F.lit("."), F.lit("")), F.regexp_extract(upper, p, 3)
        out.append(F.when(num != "", document_id(F.concat_ws("-", F.lit(kind), num, F.nullif(year, F.lit(""))))))
    return F.coalesce(*out)


def span_id(kind: Column, identifier: Column, article: Column, suffix: Column, paragraph: Column, inciso: Column) -> Column:
    """Span id of a device from its own identifier and the numbers of the devices above it (null where there is none)."""
    art = F.concat(F.format_string("%03d", F.coalesce(article, F.lit(0))), F.coalesce(suffix, F.lit("")))
    join = lambda *c: F.concat_ws("-", *c)
    return (
        F.when(kind == "article", F.concat(F.lit("ART-"), art))
        .when(kind == "paragraph", join(F.concat(F.lit("PAR-"), art), paragraph.cast("string")))
        .when(kind == "inciso", join(F.concat(F.lit("INC-"), art), paragraph.cast("string"), F.upper(identifier)))
        .when(kind == "alinea", join(F.concat(F.lit("ALI-"), art), paragraph.cast("string"), inciso, identifier))
    )


def span_ref(article: Column, paragraph: Column, inciso: Column, alinea: Column, compat: bool = False) -> Column:
    """Span id that a citation points to. ``compat`` writes 'None' for an alínea without inciso."""
    blank = lambda c: F.nullif(F.coalesce(c, F.lit("")), F.lit(""))
    art = F.lpad(article, 3, "0")
    art = F.when(F.length(article) >= 3, article).otherwise(art)
    inc = F.coalesce(blank(inciso), F.lit("None")) if compat else blank(inciso)
    par = F.when(F.lower(paragraph).isin("único", "unico"), "UNICO").otherwise(paragraph)
    return (
        F.when(blank(alinea).isNotNull(), F.concat_ws("-", F.lit("ALI"), art, inc, alinea))
        .when(blank(inciso).isNotNull(), F.concat_ws("-", F.lit("INC"), art, inciso))
        .when(blank(paragraph).isNotNull(), F.concat_ws("-", F.lit("PAR"), art, par))
        .otherwise(F.concat(F.lit("ART-"), art))
    )


def same_span(a: Column, b: Column) -> Column:
    """Whether two span ids name one device, though single paragraphs are written '-0' here and '-UNICO' there."""
    plain = lambda c: F.regexp_replace(c, r"^(PAR-[^-]+(?:-[A-Z])?)-UNICO$", "$1-0")
    return plain(a) == plain(b)


def child_order(span: Column) -> Column:
    """Sort key of sibling spans: kind, then number (Roman numerals by value, letters by place)."""
    parts = F.split(span, "-")
    kind = parts[0]
    last = F.element_at(parts, -1)
    number = (
        F.when(kind == "PAR", F.when(last == "UNICO", 0).otherwise(last.try_cast("int")))
        .when(kind == "INC", roman_to_int(last))
        .when((kind == "ALI") & (F.length(last) == 1), F.ascii(F.lower(last)) - 97)
    )
    return F.struct(F.coalesce(F.try_element_at(_map(rules.DEVICE_ORDER), kind), F.lit(9)).alias("kind"), F.coalesce(number, F.lit(9999)).alias("number"))


def rel_type(context: Column) -> Column:
    """(rel_type, confidence) of a citation from the text around it; the first rule that matches decides."""
    low = F.lower(context)
    pick = lambda t, c: F.struct(F.lit(t).alias("rel_type"), F.lit(float(c)).alias("rel_type_confidence"))
    first = [(low.rlike("(?iuU)" + p), pick(t, c)) for p, t, c in rules.REL_TYPES]
    chain = reduce(lambda acc, x: acc.when(*x), first[1:], F.when(*first[0]))
    return F.when(F.coalesce(context, F.lit("")) == "", pick("CITA", 0.0)).otherwise(chain.otherwise(pick(*rules.REL_DEFAULT)))


def around(text: Column, start: Column, end: Column, window: int = rules.REL_WINDOW) -> Column:
    """The text from ``window`` characters before ``start`` to as many after ``end`` (0-based, code points)."""
    lo = F.greatest(start - window, F.lit(0))
    return F.substring(text, lo + 1, end + window - lo)


def rel_type_description(rel: Column) -> Column:
    return F.coalesce(F.try_element_at(_map(rules.REL_DESCRIPTIONS), rel), F.concat(F.lit("Tipo desconhecido: "), rel))


def citation_confidence(number: Column, year: Column, doc: Column) -> Column:
    """(confidence, is_ambiguous) by what a citation lacks: its number, then its year, then its document."""
    pick = lambda c, a: F.struct(F.lit(c).alias("confidence"), F.lit(a).alias("is_ambiguous"))
    none = lambda c: F.coalesce(c, F.lit("")) == ""
    return F.when(none(number), pick(0.3, True)).when(none(year), pick(0.6, True)).when(none(doc), pick(0.5, True)).otherwise(pick(0.95, False))


def confidence_tier(score: Column) -> Column:
    return F.when(score >= 0.8, "HIGH").when(score >= 0.5, "MEDIUM").otherwise("LOW")


def extraction_method(method: Column) -> Column:
    m = F.upper(F.trim(method))
    return F.when(m.isin("REGEX", "HEURISTIC", "NLI", "MANUAL"), m).otherwise("UNKNOWN")


def device_type(name: Column) -> Column:
    return F.coalesce(F.try_element_at(_map(rules.DEVICE_ALIASES), F.lower(F.trim(name))), F.lit("UNKNOWN"))


def article_number_int(number: Column) -> Column:
    return F.nullif(F.regexp_extract(number, r"^(\d+)", 1), F.lit("")).cast("int")


def scale_bbox(box: Column, width: Column, height: Column) -> Column:
    """A box in shares of the page to points."""
    return F.zip_with(box, F.array(width, height, width, height), lambda x, y: F.round(x * y, 2))


def valid_bbox(box: Column, width: Column, height: Column, tolerance: float = 1.0) -> Column:
    """Four numbers in order, within the page up to a tolerance in points."""
    x0, y0, x1, y1 = (box[k] for k in range(4))
    inside = (x0 >= -tolerance) & (y0 >= -tolerance) & (x1 <= width + tolerance) & (y1 <= height + tolerance)
    return F.coalesce((F.size(box) == 4) & (x0 < x1) & (y0 < y1) & inside, F.lit(False))


def bbox_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes; 0 when they do not meet."""
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    area = lambda r: (r[2] - r[0]) * (r[3] - r[1])
    both = w * h
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def word_jaccard(a: Column, b: Column) -> Column:
    """Similarity of the word sets of two texts; 0 if both are empty."""
    words = lambda t: F.array_distinct(F.filter(F.split(F.lower(t), r"\s+"), lambda w: w != ""))
    return F.size(F.array_intersect(words(a), words(b))) / F.greatest(F.size(F.array_union(words(a), words(b))), F.lit(1))


def client_key(api_key: Column, forwarded: Column, address: Column) -> Column:
    """Who a request counts for: the start of its API key, else the first forwarded address, else the peer's."""
    return F.coalesce(
        F.concat(F.lit("key:"), F.left(F.nullif(api_key, F.lit("")), F.lit(12))),
        F.concat(F.lit("ip:"), F.trim(F.substring_index(F.nullif(forwarded, F.lit("")), ",", 1))),
        F.concat(F.lit("ip:"), address), F.lit("ip:unknown"),
    )


#: Names of devices in an embedding text, and how much of a caput it shows from either end.
DEVICE_LABELS = {"article": "Artigo", "paragraph": "Parágrafo", "inciso": "Inciso", "alinea": "Alínea"}
CAPUT_HEAD, CAPUT_TAIL = 600, 200


def safe_article_number(number: Column, span: Column) -> Column:
    """A chunk's article number, else the one in its span id without leading zeros, else ''."""
    return F.coalesce(F.nullif(number, F.lit("")), F.regexp_extract(span, r"(?:INC|PAR|ART)-0*([0-9]+)", 1))


def head_and_tail(text: Column, head: int, tail: int) -> Column:
    """The start of a text, ended at a word, and its end, joined by ' ... '."""
    start = F.rtrim(F.left(text, F.lit(head)))
    cut = F.length(start) - F.length(F.substring_index(start, " ", -1)) - 1
    whole = start.rlike(r"[.,;:]$") | (cut <= head - 100)
    start = F.when(whole, start).otherwise(F.left(start, F.greatest(cut, F.lit(0))))
    return F.when(F.length(text) <= head + tail, text).otherwise(F.concat(start, F.lit(" ... "), F.ltrim(F.right(text, F.lit(tail)))))


def embedding_text(document: Column, number: Column, kind: Column, text: Column, parent_text: Column, span: Column) -> Column:
    """Text for an embedding: where the device stands, the device, then its caput as context."""
    parts = F.split(span, "-")
    last = F.element_at(parts, -1)
    own = (
        F.when((kind == "inciso") & (F.size(parts) >= 3), F.concat(F.lit(" "), last))
        .when((kind == "paragraph") & (F.size(parts) >= 3), F.when(F.upper(last) == "UNICO", " único").otherwise(F.concat(F.lit(" "), last, F.lit("º"))))
        .when((kind == "alinea") & (F.size(parts) >= 4), F.concat(F.lit(" "), last, F.lit(")")))
        .otherwise("")
    )
    label = F.coalesce(F.try_element_at(_map(DEVICE_LABELS), kind), F.initcap(kind))
    head = F.concat(document, F.lit(" | Art. "), number, F.lit(" | "), label, own)
    context = F.when((F.coalesce(parent_text, F.lit("")) != "") & (kind != "article"), F.concat(F.lit("[CONTEXTO] "), head_and_tail(parent_text, CAPUT_HEAD, CAPUT_TAIL)))
    return F.concat_ws("\n", head, text, context)
