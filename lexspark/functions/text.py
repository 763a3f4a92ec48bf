"""Column expressions on text: canonical form, hashes, matching form, salvage of model output."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rules

#: White space as Unicode has it, for Java patterns.
_U = "(?U)"
#: The same without the line feed, spelt out: Java asks for properties character by character.
_BLANKS = r"[\t\x0B\f\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def _normal(form: str):
    @F.pandas_udf("string")
    def normal(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:  # a batch of long texts is answered in parts, as in ``matching_with_offsets``
            low = chars = 0
            for high, x in enumerate(texts, 1):
                chars += len(x or "")
                if chars >= _PART or high == len(texts):
                    yield texts.iloc[low:high].map(lambda x: x if x is None or x.isascii() else unicodedata.normalize(form, x))
                    low, chars = high, 0

    return normal


def nfc(text: Column) -> Column:
    """Composed form. Spark has no such function; ASCII texts pass the Arrow function untouched."""
    return _normal("NFC")(text)


def nfkc(text: Column) -> Column:
    return _normal("NFKC")(text)


def canonical(text: Column, compose: bool = True) -> Column:
    """NFC, line feeds only, no blanks at line ends, exactly one line feed at the end; null and empty become empty."""
    t = F.coalesce(text, F.lit(""))
    t = nfc(t) if compose else t
    t = F.replace(F.replace(t, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    t = F.regexp_replace(t, _BLANKS + r"++(?=\n|\z)", "")
    return F.regexp_replace(F.concat(F.rtrim(t, F.lit("\n")), F.lit("\n")), r"\A\n\z", "")  # a condition on t would work it out twice


def is_canonical(text: Column) -> Column:
    return text == canonical(text)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def offsets_valid(stored_hash: Column, text: Column) -> Column:
    """Whether offsets taken on a text still hold: its canonical form has the stored hash. An empty hash never holds."""
    return (F.coalesce(stored_hash, F.lit("")) != "") & (stored_hash == sha256(canonical(text)))


def snippet(text: Column, start: Column, end: Column, stored_hash: Column) -> Column:
    """(snippet, used): the slice by offsets in code points, or '' when the offsets or the hash do not hold. Never searches."""
    good = (start >= 0) & (end > start) & (end <= F.length(text)) & (stored_hash == sha256(text))
    return F.struct(F.when(good, F.substring(text, start + 1, end - start)).otherwise("").alias("snippet"), F.coalesce(good, F.lit(False)).alias("used"))


def matching(text: Column, compose: bool = True) -> Column:
    """Form for comparing texts of different extractors: NFKC, look-alikes unified, broken words joined, white space collapsed."""
    t = F.coalesce(text, F.lit(""))
    t = nfkc(t) if compose else t
    t = F.replace(t, F.lit(rules.OCR_ELLIPSIS[0]), F.lit(rules.OCR_ELLIPSIS[1]))
    # translate drops the characters that have no counterpart
    t = F.translate(t, "".join(rules.OCR_ONE) + rules.OCR_DROPPED, "".join(rules.OCR_ONE.values()))
    t = F.regexp_replace(t, _U + r"-\s*\n\s*", "")
    return F.trim(F.regexp_replace(t, _U + r"\s+", " "))


_BROKEN, _SPACES = re.compile(r"-\s*\n\s*"), re.compile(" +")
_ALIKE = rules.OCR_ONE | dict.fromkeys(rules.OCR_DROPPED, "") | {rules.OCR_ELLIPSIS[0]: rules.OCR_ELLIPSIS[1]}


class _Table(dict):
    """What characters become, by code point; each is asked for once."""

    def __init__(self, by: Callable[[str], str]):
        self.by = by

    def __missing__(self, code: int) -> str:
        out = self[code] = self.by(chr(code))
        return out


_WIDE, _PLAIN = _Table(lambda c: unicodedata.normalize("NFKC", c)), _Table(lambda c: _ALIKE.get(c, c))
_BLANK = str.maketrans("\t\n\r\x0b\x0c", "     ")


def _put(text: str, source: np.ndarray, table: _Table) -> tuple[str, np.ndarray]:
    """A text with every character as the table has it, one or more or none; sources go along."""
    if text.isascii():  # no table changes those
        return text, source
    if any(len(table[ord(c)]) != 1 for c in set(text)):
        source = np.repeat(source, np.fromiter((len(table[ord(c)]) for c in text), np.int64, len(text)))
    return text.translate(table), source


def matching_form(text: str | None) -> tuple[str, np.ndarray]:
    """The matching form of one text and the source offset of each of its characters, as an array of numbers: a few bytes a character."""
    t = text or ""
    t, source = _put(t, np.arange(len(t), dtype=np.int32), _WIDE)
    broken = [m.span() for m in _BROKEN.finditer(t)] if "\n" in t else []
    if broken:
        own = list(zip([0, *(z for _, z in broken)], [*(a for a, _ in broken), len(t)], strict=True))
        t, source = "".join(t[a:z] for a, z in own), np.concatenate([source[a:z] for a, z in own])
    t, source = _put(t, source, _PLAIN)
    t = t.translate(_BLANK)
    if "  " in t:
        blank = np.frombuffer(t.encode("utf-32-le"), np.uint32) == 32
        keep = np.ones(len(t), bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        t, source = _SPACES.sub(" ", t), source[keep]
    lead = len(t) - len(t.lstrip())
    core = t.strip()
    return core, source[lead : lead + len(core)]


#: Characters that are answered at once.
_PART = 1 << 20


@F.pandas_udf(T.StructType([T.StructField("norm", T.StringType()), T.StructField("source", T.ArrayType(T.IntegerType()))]))
def matching_with_offsets(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The matching form with the source offset of each of its characters. A batch of long texts is answered in parts, so that memory is bounded by a part."""
    for texts in batches:
        out, chars = [], 0
        for t in texts:
            out.append(matching_form(t))
            chars += len(t or "")
            if chars >= _PART:
                yield pd.DataFrame(out, columns=["norm", "source"])
                out, chars = [], 0
        yield pd.DataFrame(out, columns=["norm", "source"])


def strip_thinking(text: Column) -> Column:
    """Model output without its thinking blocks: closed ones, then one that never closes."""
    closed = F.regexp_replace(text, r"(?s)<think>.*?</think>\s*", "")
    return F.trim(F.when(closed.contains("<think>"), F.regexp_replace(closed, r"(?s)<think>.*\z", "")).otherwise(closed))


def thinking_tokens(text: Column) -> Column:
    """Estimate: a token for four characters of thinking."""
    return F.floor(F.length(F.regexp_extract(text, r"(?s)<think>(.*?)(?:</think>|\z)", 1)) / 4)


def unfenced(text: Column) -> Column:
    """A model's answer without its thinking blocks and without a fence around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(strip_thinking(text), r"^\s*```(?:json)?\s*", ""), r"```\s*\z", ""))


def parsed_json(text: Column) -> Column:
    """JSON as a variant; null for what is none. Only what begins like JSON is parsed, for a failure costs more than a page."""
    return F.try_parse_json(F.when(text.rlike(r"^\s*(?:[\[{\"0-9-]|true|false|null)"), text))


def embedded_json(text: Column) -> list[Column]:
    """The first object and the first array in a text, as variants."""
    return [parsed_json(F.regexp_extract(text, p, 0)) for p in (r"(?s)\{.*\}", r"(?s)\[.*\]")]


def salvage_json(text: Column) -> Column:
    """JSON out of a model's answer, as a string: unfenced whole, else the first object or array; null if none parses."""
    bare = unfenced(text)
    return F.coalesce(*[F.to_json(v) for v in (parsed_json(bare), *embedded_json(bare))])


def no_think(role: Column, text: Column, is_last_user: Column) -> Column:
    """Ask a model not to think: the switch goes to the end of the last user turn, once."""
    return F.when((role == "user") & is_last_user & ~F.rtrim(text).endswith("/no_think"), F.concat(text, F.lit(" /no_think"))).otherwise(text)


def slug(text: Column) -> Column:
    """Upper-case ASCII words joined by hyphens; accents are dropped by decomposition."""
    plain = F.regexp_replace(_normal("NFKD")(F.trim(text)), r"[^\x00-\x7F]", "")
    return F.regexp_replace(F.regexp_replace(F.upper(plain), r"[^A-Z0-9]+", "-"), r"^-+|-+$", "")


def strip_offsets(text: Column, base: Column) -> Column:
    """(text, start, end) of a text without surrounding white space, offsets kept in step."""
    core = F.regexp_replace(text, _U + r"^\s+|\s+\z", "")
    lead = F.length(text) - F.length(F.regexp_replace(text, _U + r"^\s+", ""))
    return F.struct(core.alias("text"), (base + lead).alias("start"), (base + lead + F.length(core)).alias("end"))


def head_tail(text: Column, limit: int, mark: str = " [...] ") -> Column:
    """A text cut to ``limit`` characters by leaving out its middle."""
    half = (limit - len(mark)) // 2
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.left(text, F.lit(half)), F.lit(mark), F.right(text, F.lit(half))))
