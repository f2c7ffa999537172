import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from test_components import plain_components

import __spark_entry__ as driver
from marketlens.llm import simhash
from marketlens.llm.simhash import Forest, bands, fingerprint, one_of_each_group, simhash_groups


def plain_fingerprint(text, shingle=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    values = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_groups(rows):
    marks = [plain_fingerprint(t) for _, t in rows]
    distinct = sorted(set(marks))
    pairs = [(a, b) for i, a in enumerate(distinct) for b in distinct[i:]
             if (a ^ b).bit_count() <= 3]
    root = plain_components(pairs)
    least = {}
    for (doc, _), mark in zip(rows, marks):
        r = root[mark]
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return sorted(((doc, f"{m:016x}", least.get(root[m])) for (doc, _), m in zip(rows, marks)),
                  key=str)


TEXTS = ["", None, "One", "one two", "A b C d e", "É É\x85x y", "w " * 7, "\t\n", "a\x1cb c d"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_a_long_text(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000))
    assert fingerprint(text) == plain_fingerprint(text)
    monkeypatch.setattr(simhash, "RUN", 100)
    assert fingerprint(text) == plain_fingerprint(text)


def values_near(n, seed=2):
    """Random values, chains of small steps and one dense ball."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    x = rng.getrandbits(64)
    for _ in range(n):
        for _ in range(rng.randrange(1, 6)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    out |= {x ^ 1 << a ^ 1 << b for a in range(0, 64, 3) for b in range(5)}
    return sorted(out | {0, 1, (1 << 64) - 1})


def test_forest_finds_all_within_the_radius():
    values = np.array(values_near(150), np.uint64)
    buckets = np.sort(np.arange(len(values)) % 3)
    forest = Forest(values, buckets)
    got = set()
    for q, n in forest.within(values, buckets, 3):
        got |= set(zip(q.tolist(), n.tolist()))
    expected = {
        (i, j) for i, a in enumerate(values.tolist()) for j, b in enumerate(values.tolist())
        if buckets[i] == buckets[j] and (a ^ b).bit_count() <= 3
    }
    assert got == expected


@pytest.mark.parametrize("n", [10, 1 << 23, 1 << 32])
def test_some_band_agrees_for_near_values(n):
    rng, masks = random.Random(4), bands(3, n)
    for _ in range(200):
        flipped = set(rng.sample(range(64), 3))
        assert any(not flipped & set(m) for m in masks)


@pytest.mark.parametrize("tree", [4096, 8])
def test_groups_of_given_fingerprints(spark, tree, monkeypatch):
    """The linking alone, on values that no text would give, with trees of eight values too."""
    values = values_near(120)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    rows = [(i * 3 + 1, f"h{i}", v) for i, v in enumerate(signed)]
    marked = spark.createDataFrame(rows, "doc_id long, text_md5 string, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: marked)
    docs = spark.createDataFrame([(1, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash_groups(docs, tree=tree).collect()}
    root = plain_components(
        (i * 3 + 1, j * 3 + 1) for i, a in enumerate(values) for j, b in enumerate(values[:i + 1])
        if (a ^ b).bit_count() <= 3
    )
    assert got == root


def test_rows_as_they_come(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (2, ""), (9, None), (None, " \t"), (None, "x y z q"),
            (7, "A B C D"), (8, "solo"), (4, "long " * 30_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")
    got = simhash_groups(df)
    assert sorted(map(tuple, got.select("doc_id", "fingerprint", "component_id").collect()),
                  key=str) == plain_groups(rows)
    kept = one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted((r[0] for r in kept.collect()), key=str) == [2, 4, 5, 8, None]
    assert simhash_groups(df.limit(0)).collect() == []
    assert one_of_each_group(df.limit(0)).collect() == []


def test_unit_without_links_is_empty():
    rows = pd.DataFrame({"band": [0, 0], "key": [0, 0], "fp": [0, 255], "side": [0, 0],
                         "lo": [-1, -1], "hi": [-1, -1]})
    assert len(simhash.shard_links(rows, 3)) == 0


def test_query_matches_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = driver.queries()["op3_simhash"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == plain_groups([tuple(d) for d in docs])
