import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from marketlens.llm.divergence import Column, audit_sources, difference, shares

SCHEMA = "doc_id long, text string, lang string, source string, term int, total string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least, top=50):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
                 for t in TERM.findall(text or "")]
        groups[lang].add(source)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def share(c):
            below = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // below for t in kept}

        p = {s: share(counts[lang, s]) for s in sources}
        q = share(whole)
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept
                     if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, i.decode(), -v, r + 1) for r, (v, i) in enumerate(found)]
    return sorted(out)


def run(spark, rows, least, **options):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    got = audit_sources(df, min_docs=least, **options)
    return sorted(tuple(r) for r in
                  got.select("lang", "source", "part", "item", "value", "rank").collect())


def made(n, seed=3, hot=False):
    pick = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopäöé字"]
    out = []
    for i in range(n):
        words = [vocabulary[min(99, int(pick.expovariate(0.05)))] for _ in range(pick.randrange(60))]
        words = [w.upper() if pick.random() < 0.2 else w for w in words]
        text = pick.choice([" ", "\n", "-", "3", "_"]).join(words)
        source = "s0" if hot and i % 3 else f"s{pick.randrange(7)}"
        out.append((i, text, pick.choice(["en", "de"]), source))
    return out


@pytest.mark.parametrize("block", [1, 7, 16_384])
def test_matches_brute_force(spark, block):
    rows = made(150)
    assert run(spark, rows, 5, block=block, top=6) == brute(rows, 5, 6)


def test_a_hot_source(spark):
    rows = made(200, seed=8, hot=True)
    assert run(spark, rows, 3) == brute(rows, 3)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "One one ONE ÉÉ éé", "en", None),
            (4, "one two\x00three", "en", "a"), (4, "one two\x00three", "en", "a"),
            (None, "1234 !!", "xx", "b"), (5, "İK", "xx", "a"), (6, "zwei", "de", "only")]
    for least in (1, 2, 9):
        assert run(spark, rows, least) == brute(rows, least)


def test_no_rows(spark):
    assert run(spark, [], 1) == []


def test_runs_are_exact_and_few():
    random = np.random.default_rng(4)
    for _ in range(50):
        size = int(random.integers(1, 40))
        columns, dense = [], []
        for _ in range(2):
            d = np.where(random.random(size) < 0.6, 0, random.integers(0, 3, size))
            places = np.flatnonzero(d)
            column = Column.encode(places, d[places], size, 100, size)
            values = shares(d, 100, size)
            changes = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
            assert column.starts.tolist() == changes.tolist()
            assert column.values.tolist() == values[changes].tolist()
            columns.append(column)
            dense.append(values)
        assert difference(*columns, size) == np.abs(dense[0] - dense[1]).sum()


def test_counts_beyond_64_bits_of_product():
    huge = np.array([0, 10**15, 3])
    assert shares(huge, 10**15 + 3, 3).tolist() == [
        1 + 10**9 * (int(c) + 5) // (10**15 + 18) for c in huge]
