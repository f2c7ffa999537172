"""Embedding near-dedup: a pivot-permutation index whose candidates are verified by cosine."""

from __future__ import annotations

from math import acos, cos, isqrt, pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from marketlens.llm.components import components, unite
from marketlens.llm.shared import Shared, work_units

#: Bounded sample of reference points, nearest of them that describe a vector.
MOST_PIVOTS = 1024
PREFIX = 8
#: Reference points stand this many times the angle of a link apart, so that a dense group
#: supplies one or two of them and its members agree on the rest.
SPACING = 1.7
#: Rows of an inverted list that a task holds, pairs that it checks at once.
LIST = 2048
STRIP = 512
PAIRS = 1 << 17
#: Above this share of candidates a strip's cosines are worked out in one product.
MANY = 1 / 16
#: In place of a second pivot: a list that is not cut up, rows whose nearest pivot it is.
WHOLE, NEAREST = -2, -1


def fitted(points: np.ndarray, width: int) -> np.ndarray:
    """Reference points cut or padded with zeros to ``width`` components."""
    out = np.zeros((len(points), width))
    out[:, :min(width, points.shape[1])] = points[:, :width]
    return out


def spaced(points: np.ndarray, cosine: float) -> np.ndarray:
    """Unit points in order, without those closer than ``SPACING`` links to one kept before."""
    most = cos(min(SPACING * acos(min(1.0, max(-1.0, cosine))), pi / 2))
    kept: list[int] = []
    for i, point in enumerate(points):
        if not kept or (points[kept] @ point).max() < most:
            kept.append(i)
    return points[kept]


def nearest(vectors: np.ndarray, points: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the ``prefix`` nearest reference points, nearest first."""
    away = -(vectors @ fitted(points, vectors.shape[1]).T)
    if prefix < len(points):
        near = np.sort(np.argpartition(away, prefix - 1, axis=1)[:, :prefix], axis=1)
    else:
        near = np.broadcast_to(np.arange(len(points)), away.shape)
    order = np.argsort(np.take_along_axis(away, near, axis=1), axis=1, kind="stable")
    return np.take_along_axis(near, order, axis=1)


def unit(rows: pd.Series, width: int) -> np.ndarray:
    v = np.array(rows.tolist(), np.float64).reshape(len(rows), width)
    v = v / np.abs(v).max(axis=1, initial=np.finfo(float).tiny, keepdims=True)
    return v / np.linalg.norm(v, axis=1)[:, None]


def sublists(pivots: Column, pivot: Column, hot: Column) -> Column:
    """Second pivots under which a row stands in the list of ``pivot``.

    A list that is not hot is one. A hot one is cut up by the greater pivots of its rows;
    rows whose nearest pivot it is meet once more for the sake of those that share no other.
    """
    others = F.filter(pivots, lambda q: q > pivot)
    own = F.when(pivots[0] == pivot, F.array(F.lit(NEAREST))).otherwise(
        F.array().cast("array<int>"))
    return F.when(hot, F.concat(others, own)).otherwise(F.array(F.lit(WHOLE)))


def lists_to_cut(shared: Shared, lists: DataFrame, most: int) -> DataFrame:
    """(_label, _pivot, _width) of lists of over ``most`` rows that take fewer comparisons once
    they are cut up. Rows that share all their points, as a dense group does, would only
    meet in more lists.
    """
    keys = ["label", "pivot", "width"]
    names = [F.col(k).alias(f"_{k}") for k in keys]
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    long = shared.put(
        lists.groupBy(*keys).count().filter(F.col("count") > most)
        .select(*names, F.col("count").alias("_rows"))
    )
    second = F.explode(sublists(F.col("pivots"), F.col("pivot"), F.lit(True)))
    parts = lists.join(long, same).select(*long.columns, second.alias("second"))
    parts = parts.groupBy(*long.columns, "second").count()
    square = lambda n: F.col(n).cast("double") * F.col(n)
    after = parts.groupBy(*long.columns).agg(F.sum(square("count")).alias("after"))
    return after.filter(F.col("after") < square("_rows")).select("_label", "_pivot", "_width")


def owned(common: np.ndarray, local: np.ndarray, pivot: int, second: int) -> np.ndarray:
    """Which pairs, by the ``local`` pivots they have in common, are counted in this list: that
    of their smallest common pivot, and there, if it is cut up, that of the next one."""
    at = common.argmax(axis=1)
    own = local[at] == pivot
    if second != WHOLE:
        rest = common.copy()
        rest[np.arange(len(at)), at] = False
        own &= np.where(rest.any(axis=1), local[rest.argmax(axis=1)], NEAREST) == second
    return own


def list_links(
    rows: pd.DataFrame, pivot: int, least: float, least_shared: int, second: int = WHOLE,
) -> tuple[np.ndarray, np.ndarray]:
    """Links found in one inverted list, as (number of links, local root) of its rows.

    The score of a pair is the number of its common pivots, and one more if the same
    pivot is the nearest of both. The cosine is worked out where the score is enough; a
    pair is counted only in one of the lists where it meets. With rows of side 1,
    pairs are taken across.
    """
    n, width = len(rows), len(rows["vector"].iloc[0])
    v, weight = unit(rows["vector"], width), rows["copies"].to_numpy()
    described = np.array(rows["pivots"].tolist())
    local, place = np.unique(described, return_inverse=True)
    marks = np.zeros((n, len(local)), np.float32)
    place = place.reshape(described.shape)
    np.put_along_axis(marks, place, 1, axis=1)
    first = place[:, 0]
    split = int(np.searchsorted(rows["side"].to_numpy(), 1))
    across = bool(rows["lo"].iloc[0] < rows["hi"].iloc[0])
    right = np.arange(split, n) if across else np.arange(n)
    links, parent = np.zeros(n, np.int64), np.arange(n)
    for low in range(0, split, STRIP):
        left = np.arange(low, min(split, low + STRIP))
        score = marks[left] @ marks[right].T + (first[left][:, None] == first[right])
        hit = score >= least_shared
        many = np.count_nonzero(hit) > MANY * hit.size
        if many:
            hit &= v[left] @ v[right].T >= least
        a, b = np.nonzero(hit)
        a, b = left[a], right[b]
        a, b = (a, b) if across else (a[a < b], b[a < b])
        for at in range(0, len(a), PAIRS):
            i, j = a[at:at + PAIRS], b[at:at + PAIRS]
            if not many:
                close = np.einsum("ij,ij->i", v[i], v[j]) >= least
                i, j = i[close], j[close]
            own = owned(marks[i] * marks[j] > 0, local, pivot, second)
            i, j = i[own], j[own]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            parent = unite(parent, i, j)
    return links, parent


def unit_links(rows: pd.DataFrame, least: float, least_shared: int) -> pd.DataFrame:
    """(node, links, root) of the rows with links in one unit of inverted lists."""
    found = []
    for (_, pivot, second, _), part in rows.groupby(["label", "pivot", "second", "width"]):
        if len(part) < 2:
            continue
        part = part.sort_values(["side", "node"], kind="stable")
        links, parent = list_links(part, pivot, least, least_shared, second)
        node = part["node"].to_numpy()
        some = links > 0
        found.append(pd.DataFrame(
            {"node": node[some], "links": links[some], "root": node[parent[some]]}
        ))
    none = {n: np.zeros(0, np.int64) for n in ("node", "links", "root")}
    return pd.concat(found) if found else pd.DataFrame(none)


def embedding_groups(
    vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
    cosine: float = 0.93, prefix: int = PREFIX, shared_pivots: int = 2,
    most_pivots: int = MOST_PIVOTS, list_rows: int = LIST,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``.

    Equal vectors of a label collapse first. Reference points are the first by hash of
    twice the square root of the number of distinct vectors, 16 to ``most_pivots``, less
    those close to one before; they are the only sample, every vector is indexed. Where
    nearly all vectors are close to one another few points are left and lists are long:
    that costs comparisons, not links. A vector is described by its ``prefix``
    nearest points in order and stands in the inverted list of each, per label. Vectors
    that share ``shared_pivots`` points are compared in double precision; the nearest
    point of both counts twice. A list of more than ``list_rows`` is cut up into lists of two
    points if that saves comparisons: whatever it compares shares a second one or has the
    first as its nearest. What is still longer is compared piece by piece. So hot lists lose
    nothing and no task holds more than two pieces; tasks return sums and spanning links,
    never pairs.

    Only equal, non-null labels and equal numbers of components are compared. Null
    vectors, zero vectors and those with null or non-finite components link with
    nothing. ``component_id`` is the smallest id reachable; a row is kept if that is its
    own. Copies, also repeated rows, are links. A null id counts for links and takes the
    smallest id of its component, or null; it is never kept. Only the named columns are
    read.
    """
    shared = Shared(vectors.sparkSession)
    rows = vectors.select(
        vectors[vec_id].cast("long").alias("vec_id"), vectors[label].alias("label"),
        F.transform(vectors[vector], lambda x: x.cast("double") + F.lit(0.0)).alias("vector"),
    )
    v = F.col("vector")
    fine = F.coalesce(
        F.col("label").isNotNull() & v.isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0), F.lit(False)
    )
    alone = rows.filter(~fine).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    nodes = rows.filter(fine).groupBy("label", "vector").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies")
    )
    nodes = shared.put(nodes.withColumn("node", F.monotonically_increasing_id()))
    wanted = min(most_pivots, max(16, 2 * isqrt(nodes.count())))
    first = nodes.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(wanted)
    sample = [r[0] for r in first.collect()]
    points = np.zeros((len(sample), max(map(len, sample), default=1)))
    for i, p in enumerate(sample):
        points[i, :len(p)] = unit(pd.Series([p]), len(p))[0]
    points = spaced(points, cosine)

    def describe(stream):
        for part in stream:
            for width, same in part.groupby(part["vector"].map(len)):
                pivots = nearest(unit(same["vector"], width), points, prefix)
                yield same.assign(pivots=list(pivots), width=np.int32(width))

    kind = ", ".join(f"{n} {t}" for n, t in nodes.drop("least").dtypes)
    told = shared.put(
        nodes.drop("least").mapInPandas(describe, f"{kind}, pivots array<int>, width int"))
    fits = min(shared_pivots, max(1, len(points)))
    # Where one common pivot is enough, a pair need not meet under a second one.
    lists = told.withColumn("pivot", F.explode("pivots"))
    cut = shared.put(lists_to_cut(shared, lists, list_rows).filter(F.lit(fits > 1)))
    same = [F.col(k) == F.col(f"_{k}") for k in ("label", "pivot", "width")]
    lists = lists.join(cut, same, "left").withColumn(
        "second",
        F.explode(sublists(F.col("pivots"), F.col("pivot"), F.col("_pivot").isNotNull())),
    ).drop(*cut.columns)
    keys = ["label", "pivot", "second", "width"]
    found = shared.put(
        work_units(shared, lists, keys, "node", list_rows, 4 * list_rows)
        .groupBy("unit", "lo", "hi")
        .applyInPandas(lambda part: unit_links(part, cosine, fits),
                       "node long, links long, root long")
    )
    degrees = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(shared, found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (
        nodes.join(degrees, "node", "left")
        .join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
        .select("label", "vector", "least",
                (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("root", "node").alias("root"))
    )
    known = shared.put(known)
    lowest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    lowest = shared.put(lowest)
    known = known.join(lowest, "root").select(
        F.col("label").alias("_l"), F.col("vector").alias("_v"), "n_links", "component_id"
    )
    linked = rows.filter(fine).join(
        known, (F.col("label") == F.col("_l")) & (F.col("vector") == F.col("_v"))
    ).select("vec_id", "n_links", "component_id")
    both = linked.unionByName(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"),
                                              F.lit(False)))
