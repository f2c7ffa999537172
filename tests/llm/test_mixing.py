import random
import re

import pytest

import __spark_entry__ as driver
from marketlens.llm import mixing
from marketlens.llm.mixing import mix_sources, pivotal

SCHEMA = "doc_id long, text string, source string, target string, _mark int"


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    names = [s for s in names if s in sizes]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level >= 2 * sizes[s]}
        if not above:
            return target | {s: weight[s] * level for s in free}
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= above
    return target


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size_of(text)
    target = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]], rel=1e-9)
        assert r["size"] == size_of(r["text"])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    for source, words in taken.items():
        longest = max((size_of(t) for _, t, s in rows if s == source), default=0)
        assert abs(words - target[source]) <= longest + 1e-6
    return taken, target


def documents(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + ["a", "b", "C", "é", "", None])
        rows.append((i, "w " * int(rng.paretovariate(0.9) * 5) + str(i), source))
    return rows


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "t", 4) for r in rows], SCHEMA).repartition(parts)
    got = mix_sources(df)
    assert sorted(got.columns) == sorted(
        ["doc_id", "text", "source", "_mark", "size", "source_size", "target", "copies"])
    return got.collect()


def test_targets_and_taken_words(spark):
    rows = documents(600)
    check(rows, run(spark, rows))


def test_a_tree_of_small_leaves(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 10)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rows = documents(600, 1)
    first = run(spark, rows)
    taken, target = check(rows, first)
    assert taken["hot"] == pytest.approx(target["hot"], rel=0.02)
    second = run(spark, rows, parts=7)
    assert {r["doc_id"]: r["copies"] for r in first} == {r["doc_id"]: r["copies"] for r in second}


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", None), (None, "x y", None), (3, "z", "b"),
            (3, "z", "b"), (None, None, "empty"), (4, "long " * 200_000, "b"), (4, "other", "b")]
    got = run(spark, rows)
    assert len(got) == len(rows) and all(r["copies"] <= 2 for r in got)
    same = {r["copies"] for r in got if r["doc_id"] == 3}
    assert len(same) == 1
    assert run(spark, []) == []
    assert [r["copies"] for r in run(spark, [(1, None, "a")])] == [0]


def test_pivotal_keeps_words_and_expectation():
    rng, sums = random.Random(2), [0.0] * 30
    words = sorted((rng.randrange(1, 40) for _ in range(30)), reverse=True)
    start = [rng.random() for _ in range(30)]
    for turn in range(3000):
        marks = [rng.getrandbits(64) for _ in range(30)]
        out = pivotal(words, start, marks)
        assert sum(0 < p < 1 for p in out) <= 1
        assert sum(w * p for w, p in zip(words, out)) == pytest.approx(
            sum(w * p for w, p in zip(words, start)))
        sums = [s + p for s, p in zip(sums, out)]
    assert all(abs(s / 3000 - p) < 0.05 for s, p in zip(sums, start))


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    check(rows, mix_sources(docs).collect())
    query = driver.queries()["op7_mixing"]
    first = sorted(map(tuple, query(spark, sf_dir).collect()))
    assert first == sorted(map(tuple, query(spark, sf_dir).collect()))
    assert len(first) == len(rows)
