"""Components and units of pairwise work against plain Python."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm.components import components, unite
from marketlens.llm.shared import Shared, numbered, work_units


def plain_components(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


GRAPHS = {
    "none": [],
    "loops": [(1, 1), (2, 2)],
    "path": [(i, i + 1) for i in range(40)],
    "star": [(500, i) for i in range(60)],
    "negative": [(-5, 3), (3, 9), (9, -7), (1, 2), (2, 1), (1, 2)],
    "random": [(random.Random(5).randrange(90), random.Random(i).randrange(90)) for i in range(60)],
    "shuffled path": random.Random(3).sample([(i * 7 % 41, (i + 1) * 7 % 41) for i in range(40)], 40),
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components_match_union_find(spark, name):
    edges = spark.createDataFrame(GRAPHS[name], "a long, b long")
    got = {r["node"]: r["root"] for r in components(Shared(spark), edges).collect()}
    expected = plain_components(GRAPHS[name])
    assert got == {n: r for n, r in expected.items() if n != r}


def test_unite_matches_union_find():
    rng = np.random.default_rng(1)
    parent, pairs = np.arange(50), []
    for _ in range(5):
        a, b = rng.integers(0, 50, 8), rng.integers(0, 50, 8)
        parent = unite(parent, a, b)
        pairs += list(zip(a.tolist(), b.tolist()))
    expected = plain_components(pairs)
    assert [int(p) for p in parent] == [expected.get(i, i) for i in range(50)]


def test_numbers_are_global_and_consecutive(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x")).repartition(7)
    got = numbered(Shared(spark), rows, [F.col("x").desc()], "n").collect()
    assert {r["x"]: r["n"] for r in got} == {x: 999 - x for x in range(1000)}


def test_any_two_rows_of_a_key_meet_once(spark):
    rows = spark.createDataFrame(
        [(0, i) for i in range(60)] + [(1, i) for i in range(5)] + [(None, 3)], "k int, v long"
    )
    dealt = work_units(Shared(spark), rows, ["k"], "v", cap=8, unit_rows=50).collect()
    units = {}
    for r in dealt:
        units.setdefault((r["unit"], r["lo"], r["hi"]), []).append(r)
    met = {}
    for (_, lo, hi), members in units.items():
        for a, b in itertools.combinations(members, 2):
            if a["k"] == b["k"] and (lo == hi or a["side"] != b["side"]):
                pair = (a["k"], *sorted((a["v"], b["v"])))
                met[pair] = met.get(pair, 0) + 1
    expected = {(0, a, b) for a, b in itertools.combinations(range(60), 2)}
    expected |= {(1, a, b) for a, b in itertools.combinations(range(5), 2)}
    assert set(met) == expected and set(met.values()) == {1}
    hot = [len(m) for m in units.values() if m[0]["k"] == 0 and m[0]["lo"] >= 0]
    assert max(hot) < 40
