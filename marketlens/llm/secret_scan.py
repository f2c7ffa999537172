"""Secret scans: known shapes, and runs whose sliding-window entropy is that of random keys."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
BASE_KINDS = ("assign", "access", "hex")

#: Character classes that are scanned, with the least bits a character of a whole window.
#: Windows of digits alone are hex.
BITS = {"entropy_hex": 2.9, "entropy_base64": 3.3, "entropy_letters": 3.2}
KINDS = (*BASE_KINDS, *BITS)
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{16,}")
UPPER_HEX = re.compile(r"[0-9A-Fa-f]+")
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
WINDOW = 20
#: A window of random characters has this share of odd neighbours or more, words have not.
ODD = {"entropy_base64": 0.3, "entropy_letters": 0.25}

#: Candidates that look random and are public or harmless.
ALLOWED = (
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"[A-Z0-9]*EXAMPLE[A-Z0-9]*",
    r"(sha(1|256|384|512)-).*",
)
CONSONANTS = frozenset("bcdfghjklmnpqrstvwxz")
#: Consonants that stand next to each other in words of European languages.
USUAL = frozenset(
    "bb bl br bs bt cc ch ck cl cr cs ct dd dg dl dr ds ff fl fr ft gg gh gl gn gr gs ht hl hm hn"
    " hr kl kn kr ks kt lb lc ld lf lg lk ll lm ln lp ls lt lv lz mb mm mp ms nc nd nf ng nk nl nn"
    " np ns nt nv nz pf ph pl pp pr ps pt rb rc rd rf rg rk rl rm rn rp rr rs rt rv rz sc sh sk sl"
    " sm sn sp sq ss st sw tc th tl tr ts tt tw tz vr wh wn wr ws zt zw".split()
)


def kind_of_char(char: str) -> str:
    if char.isdigit():
        return "digit"
    return "upper" if char.isupper() else "lower" if char.islower() else "mark"


def odd_neighbours(left: str, right: str, after: str) -> bool:
    """Neighbours that words and numbers with marks between them hardly ever have: a digit
    next to a letter, a capital behind a small letter that begins no word, consonants
    that no word joins. A word that a capital begins goes on with a small letter."""
    a, b = kind_of_char(left), kind_of_char(right)
    if "mark" in (a, b):
        return False
    if (a == "digit") != (b == "digit"):
        return True
    if (a, b) == ("lower", "upper"):
        return kind_of_char(after) != "lower"
    pair = (left + right).lower()
    return pair[0] in CONSONANTS and pair[1] in CONSONANTS and pair not in USUAL


class WindowEntropy:
    """Shannon entropy of the last ``width`` characters, kept by counts as the window moves."""

    def __init__(self, width: int):
        self.width = width
        self.counts: dict[str, int] = {}
        self.weight = 0.0
        self.terms = [0.0] + [n * log2(n) for n in range(1, width + 1)]

    def _shift(self, char: str, by: int) -> None:
        before = self.counts.get(char, 0)
        self.weight += self.terms[before + by] - self.terms[before]
        self.counts[char] = before + by

    def runs(
        self, text: str, least: float, fits: Callable[[int], bool] = lambda end: True
    ) -> Iterator[tuple[int, int]]:
        """Maximal unions (start, end) of windows with ``least`` bits a character or more
        that ``fits`` accepts by their ends."""
        start = end = -1
        for i, char in enumerate(text):
            if i >= self.width:
                self._shift(text[i - self.width], -1)
            self._shift(char, 1)
            if i + 1 < self.width:
                continue
            if log2(self.width) - self.weight / self.width >= least and fits(i + 1):
                if i + 1 - self.width > end:
                    if end > 0:
                        yield start, end
                    start = i + 1 - self.width
                end = i + 1
        if end > 0:
            yield start, end


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost and non-overlapping per kind."""
    found = [
        (m.start(), m.end(), "assign")
        for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS
    ]
    found += [
        (m.start(), m.end(), "access")
        for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS
    ]
    # A run that starts after another character of its class is never leftmost.
    found += [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]
    return found


def entropy_spans(
    text: str, allowed: re.Pattern, window: int = WINDOW
) -> list[tuple[int, int, str]]:
    """(start, end, kind) where a candidate's windows look random for their character class."""
    found = []
    for match in CANDIDATE.finditer(text):
        word = match.group()
        if allowed.fullmatch(word):
            continue
        for start, end, kind in random_runs(word, min(window, len(word))):
            found.append((match.start() + start, match.start() + end, kind))
    return found


def random_runs(word: str, width: int) -> Iterator[tuple[int, int, str]]:
    """Unions of windows of one class that hold as many bits, and as many odd neighbours, as
    random characters do. Windows shorter than ``WINDOW`` need fewer bits."""
    part = log2(width) / log2(WINDOW)
    if UPPER_HEX.fullmatch(word):
        for start, end in WindowEntropy(width).runs(word, BITS["entropy_hex"] * part):
            if any(map(str.isdigit, word[start:end])) and any(map(str.isalpha, word[start:end])):
                yield start, end, "entropy_hex"
        return
    odd = [0, 0, *accumulate(map(odd_neighbours, word, word[1:], word[2:] + "-"))]
    digits = [0, *accumulate(map(str.isdigit, word))]

    def fits(kind: str) -> Callable[[int], bool]:
        return lambda end: (
            odd[end] - odd[end - width + 1] >= ODD[kind] * (width - 1)
            and (digits[end] > digits[end - width]) == (kind == "entropy_base64")
        )

    for kind in ODD:
        for start, end in WindowEntropy(width).runs(word, BITS[kind] * part, fits(kind)):
            yield start, end, kind


def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find_secrets(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    allowed: Sequence[str] = ALLOWED, window: int = WINDOW,
) -> DataFrame:
    """(doc_id, spans array of (start, end, kind)) per row; code points, end exclusive.

    Base kinds are ``assign``, ``access`` and ``hex``. The entropy kinds add parts of
    candidate runs of 16 characters or more in which every window of ``window``
    characters, or the whole run if it is shorter, has the entropy of a random key of its
    character class: hex digits, letters and digits, or letters alone. Words also vary
    their letters, so a window must have odd neighbours, too: cases and digits mixed without
    a mark between them, or consonants that no word joins. Candidates that match ``allowed``
    as a whole are left out, base spans never. Windows move one character at a time and
    update one count, so a run costs time in proportion to its length. Spans are ordered by
    start, then kind.

    One pass without a shuffle. Null or empty text has no spans; repeated rows and null
    ids come back as they are. Only the named columns are read.
    """
    pattern = "|".join(f"(?:{a})" for a in allowed) or r"(?!)"
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skip = re.compile(pattern)
        for batch in stream:
            found = []
            for value in batch.column(1):
                whole = value.as_py() or ""
                spans = ordered(base_spans(whole) + entropy_spans(whole, skip, window))
                found.append([dict(zip(("start", "end", "kind"), s)) for s in spans])
            yield pa.record_batch(
                [batch.column(0), pa.array(found, pa.list_(span))], names=["doc_id", "spans"]
            )

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(
        batches, "doc_id long, spans array<struct<start: long, end: long, kind: string>>"
    )
