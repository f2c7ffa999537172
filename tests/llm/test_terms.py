import re
from collections import Counter

import pytest

from marketlens.llm import terms
from marketlens.llm.terms import LETTERS, LETTERS_DIGITS, words


@pytest.mark.parametrize("table, pattern", [
    (LETTERS, rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"),
    (LETTERS_DIGITS, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
])
def test_classes(table, pattern):
    text = "".join(map(chr, range(0x300))) + " İK\u2028字\x85é"
    lowered = text.encode().lower()
    assert [w for part in words(text.encode(), table) for w in part] == re.findall(pattern, lowered)


def test_slices(monkeypatch):
    text = ("Alpha beta " * 4_000 + "x" * 5000).encode()
    assert sum(map(len, words(text, LETTERS))) == 8001
    monkeypatch.setattr(terms, "SLICE", 777)
    assert Counter(w for part in words(text, LETTERS) for w in part) == Counter(text.lower().split())
    for other in ("", "word", " " * 3000, "y" * 3000, "é" * 2000 + " ü", "a " * 2000):
        told = [w for part in words(other.encode(), LETTERS) for w in part]
        assert told == other.encode().split()
