import math

import numpy as np
import pandas as pd
import pytest
from test_components import plain_components

from pyspark.sql import functions as F

from marketlens.llm.pivots import (
    NEAREST, WHOLE, embedding_groups, list_links, lists_to_cut, nearest, sublists,
)
from marketlens.llm.shared import Shared

SCHEMA = "vec_id long, embedding array<float>, label int, node string, copies int"


def brute(rows, cosine=0.93):
    def fine(v, label):
        return (label is not None and v is not None and v and any(x != 0 for x in v if x is not None)
                and all(x is not None and math.isfinite(x) for x in v))

    links = [[] for _ in rows]
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows):
            if i != j and la == lb and fine(a, la) and fine(b, lb) and len(a) == len(b):
                x, y = np.float32(a).astype(float), np.float32(b).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                    links[i].append(j)
    root = plain_components((i, j) for i, some in enumerate(links) for j in [i, *some])
    least = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            least[root[i]] = min(v, least.get(root[i], v))
    out = []
    for i, (v, _, _) in enumerate(rows):
        c = least.get(root[i])
        out.append((v, len(links[i]), c, v is not None and v == c))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "n", 3) for r in rows], SCHEMA)
    got = embedding_groups(df, **options)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, got.collect()), key=str)


def clouds(n, labels=3, dims=24, seed=0, spread=0.25):
    """Random directions, each with near copies around the threshold, and exact copies."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        centre, label = rng.normal(size=dims), int(rng.integers(labels))
        for _ in range(int(rng.integers(1, 5))):
            v = centre + rng.normal(size=dims) * spread * rng.random()
            rows += [(0, (v * rng.uniform(0.5, 2)).astype(np.float32).tolist(), label)]
            rows += [rows[-1]] * int(rng.random() < 0.1)
    order = rng.permutation(len(rows))
    return [(int(i) * 2 + 1, *rows[k][1:]) for i, k in enumerate(order)]


@pytest.mark.parametrize("cap", [2048, 5])
def test_one_dense_group_is_counted_in_full(spark, cap):
    """A third of all rows within one another's reach, cut into pieces of five as well."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    near = [(i, (centre + rng.normal(size=16) * 0.05).tolist(), 1) for i in range(60)]
    rows = near + [(100 + i, rng.normal(size=16).tolist(), 1 + i % 2) for i in range(100)]
    got, expected = run(spark, rows, list_rows=cap), brute(rows)
    assert got == expected


def test_recall_against_brute_force(spark):
    rows = clouds(220)
    got, expected = run(spark, rows), brute(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in expected)
    assert there > 200 and 0.95 * there <= found <= there
    most = {r[0]: r[1] for r in expected}
    assert all(n <= most[v] for v, n, _, _ in got)


def dense(n, dims=64, seed=5):
    """A third of the rows around one centre, near the threshold; the rest at random, in pairs."""
    rng = np.random.default_rng(seed)
    centre, pairs = rng.normal(size=dims), n // 3
    centre /= np.linalg.norm(centre)
    group = centre + rng.normal(size=(n - 2 * pairs, dims)) * 0.25 / dims**0.5
    rest = rng.normal(size=(pairs, dims))
    twins = rest + rng.normal(size=rest.shape) * 0.25 * rng.random((pairs, 1))
    return rng.permutation(np.vstack([group, rest, twins]).astype(np.float32))


def recall(spark, n):
    """Share of the links of brute force, and no row may have more than it."""
    v = dense(n)
    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], SCHEMA.split(", node")[0])
    got = {r["vec_id"]: r["n_links"] for r in embedding_groups(df).collect()}
    unit = v.astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    there = [int((unit[i] @ unit.T >= 0.93).sum()) - 1 for i in range(n)]
    assert len(got) == n and all(got[i] <= there[i] for i in range(n))
    return sum(got.values()) / sum(there)


@pytest.mark.parametrize("n", [300, 3000, 20_000])
def test_recall_with_a_third_of_the_rows_in_one_dense_group(spark, n):
    assert recall(spark, n) >= 0.95


def test_the_nearest_pivot_of_both_counts_twice():
    """All four are links; rows 2 and 3 share one pivot with row 0, nearest of both for row 2 only."""
    rows = pd.DataFrame({
        "vector": [[1.0, 0.0], [1.0, 0.1], [1.0, 0.2], [1.0, 0.3]], "copies": 1, "side": 0,
        "pivots": [[4, 1, 2], [2, 1, 4], [4, 5, 6], [7, 4, 8]], "lo": -1, "hi": -1,
    })
    links = {pivot: list_links(rows, pivot, 0.9, 2)[0].tolist() for pivot in (1, 2, 4)}
    assert links == {1: [1, 1, 0, 0], 2: [0, 0, 0, 0], 4: [1, 0, 1, 0]}


@pytest.mark.parametrize("shared_pivots", [1, 2])
def test_lists_cut_up_find_the_same_links(spark, shared_pivots):
    """Long lists of the second run are cut up by second pivots, some again into pieces."""
    rows = clouds(60, labels=1)
    whole = run(spark, rows, shared_pivots=shared_pivots)
    assert sum(r[1] for r in whole) > 40
    assert run(spark, rows, shared_pivots=shared_pivots, list_rows=16) == whole


def test_pairs_meet_once_under_two_pivots():
    """Four rows that all are links: each pair is counted under its two smallest common pivots."""
    rows = pd.DataFrame({
        "vector": [[1.0, 0.0], [1.0, 0.1], [1.0, 0.2], [1.0, 0.3]], "copies": 1, "side": 0,
        "pivots": [[4, 1, 2], [2, 1, 4], [4, 5, 6], [1, 4, 8]], "lo": -1, "hi": -1,
    })

    def links(pivot, second):
        own = [p for p in rows["pivots"]]
        here = [pivot in p and (second in p if second >= 0 else p[0] == pivot) for p in own]
        part = rows[here].reset_index(drop=True)
        found = list_links(part, pivot, 0.9, 2, second)[0] if len(part) else []
        return dict(zip(np.flatnonzero(here).tolist(), np.asarray(found).tolist()))

    assert links(1, 2) == {0: 1, 1: 1}
    assert links(1, 4) == {0: 1, 1: 1, 3: 2}
    assert links(2, 4) == {0: 0, 1: 0}
    assert links(4, NEAREST) == {0: 1, 2: 1}


def test_sublists(spark):
    rows = spark.createDataFrame(
        [([4, 1, 2], 4, True), ([4, 1, 2], 1, True), ([4, 1, 2], 2, True), ([4, 1, 2], 1, False),
         ([1], 1, True), ([2, 9], 9, True)],
        "pivots array<int>, pivot int, hot boolean")
    got = rows.select(sublists(F.col("pivots"), F.col("pivot"), F.col("hot")).alias("s")).collect()
    assert [sorted(r.s) for r in got] == [[NEAREST], [2, 4], [4], [WHOLE], [NEAREST], []]


def test_only_lists_that_gain_by_it_are_cut_up(spark):
    """Rows of label 1 share all three points. In label 2, 60 rows hold point 5, of which 30
    meet under 1 and 5 and have it as their nearest; all that hold point 1 hold 5 as well."""
    rows = [(1, [1, 2, 3], 4)] * 30 + [(2, [5, 1, 10 + i], 4) for i in range(30)]
    rows += [(2, [20 + i, 5, 60 + i], 4) for i in range(30)]
    told = spark.createDataFrame(rows, "label int, pivots array<int>, width int")
    lists = told.withColumn("pivot", F.explode("pivots"))
    cut = lists_to_cut(Shared(spark), lists, 20).collect()
    assert sorted((r._label, r._pivot) for r in cut) == [(2, 5)]


@pytest.mark.parametrize("prefix", [1, 3, 8, 40])
def test_nearest_points_come_in_order(prefix):
    rng = np.random.default_rng(11)
    v, points = rng.normal(size=(50, 6)), rng.normal(size=(20, 6))
    whole = np.argsort(-(v @ points.T), axis=1, kind="stable")
    assert (nearest(v, points, prefix) == whole[:, :prefix]).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2),
        (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (6, [-0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [inf, 0.0], 1), (9, [1.0, None], 1), (10, [], 1), (11, [], 1),
        (None, [1.0, 0.01], 1), (None, [0.0, 1.0], 3), (12, [1.0], 1), (13, [3.0], 1),
        (14, [-0.0, 1.0], 2), (15, [0.0, 1.0], 2), (16, [1e-38, 0.0], 2),
    ]
    assert run(spark, rows) == brute(rows)


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, None)]) == [(1, 0, 1, True)]
