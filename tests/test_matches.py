"""Many patterns by one automaton against each pattern by itself."""

import random
import re

import duckdb
import pytest

from lexspark.functions import rules
from lexspark.functions.matches import Anchored, leading

PATTERNS = [*(p for _, p in rules.NORMS), rules.DEVICE_CITED]
SAID = ["Lei nº 14.133/2021", "lei complementar 123", "LC nº 101", "Decreto-Lei 200", "decreto 10.024", "Instrução Normativa SEGES nº 65", "IN 5", "in", "Portaria MF 938", "RESOLUÇÃO 3", "Acórdão 1234/2021 - Plenário", "acordao 7", "MP 1.000", "EC 45", "CF/88", "CFX", "Constituição Federal", "arts. 5º, § 2º, inciso IV, alínea 'a'", "artigo 7", "ART.9", "art", "LeiLei 5", "Leı 7", "LEİ 8", "Reſolução 4", "ſ", "K", "\n", " ", ", ", "da ", "9", "ação "]


def test_leading_letters():
    assert [leading(p) for p in (r"Lei\s+x", r"(?:arts?\.?|artigos?)\s", r"\bCF(?:/\d)?", "Ac[oó]rd", "LC")] == ["lei", "art", "cf", "ac", "lc"]
    with pytest.raises(ValueError):
        leading(r"\d+")


def _plain(text):
    return [(k, m.span(), m.groups()) for k, p in enumerate(PATTERNS) for m in re.compile(p, re.IGNORECASE).finditer(text)]


def test_the_same_matches_on_random_texts():
    rng, find = random.Random(1), Anchored(PATTERNS)
    for _ in range(1500):
        text = "".join(rng.choice(SAID) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(0, 14)))
        assert [(k, m.span(), m.groups()) for k, m in find(text)] == _plain(text)


def test_the_same_matches_on_documents_with_citations():
    rng, find = random.Random(2), Anchored(PATTERNS)
    n = 0
    for (text,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' WHERE text IS NOT NULL").fetchall():
        words = text.split(" ")
        for _ in range(5):
            words.insert(rng.randrange(len(words) + 1), rng.choice(SAID))
        text = " ".join(words)
        want = _plain(text)
        n += len(want)
        assert [(k, m.span(), m.groups()) for k, m in find(text)] == want
    assert n > 500
