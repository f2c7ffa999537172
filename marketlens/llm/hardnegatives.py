"""Hard-negative mining: a multiway hyperplane tree whose ranges rule out whole subtrees."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens.llm.shared import Shared, numbered
from marketlens.llm.topk import products

#: Split points of the upper level and of every node below, rows of a leaf and of a tree.
CELLS = 64
FANOUT = 8
LEAF = 256
TREE = 16_384
#: Rows that the split points of the upper level are chosen from.
SAMPLE = 1024
#: Bytes of anchors that are asked at once, anchors that walk through a tree together.
BATCH_BYTES = 1 << 24
STRIP = 1024
#: Distances are rounded; ranges are widened by this share of the largest one.
SLACK = 1e-6
NONE = np.iinfo(np.int64).min


@dataclass
class Space:
    """Inner products as distances: every row gets one more component that brings it to the
    same norm, every anchor a zero, so a larger product is a smaller distance.

    ``exact`` is false if products can leave the integers that doubles hold; then nothing
    is ruled out by distance.
    """

    norm: float
    exact: bool

    def rows(self, v: np.ndarray) -> np.ndarray:
        v = v.astype(np.float64)
        rest = np.maximum(self.norm**2 - np.einsum("ij,ij->i", v, v), 0)
        return np.hstack([v, np.sqrt(rest)[:, None]])

    def anchors(self, v: np.ndarray) -> np.ndarray:
        return np.hstack([v.astype(np.float64), np.zeros((len(v), 1))])

    def radius(self, squares: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance of a row with this product from an anchor with this squared norm."""
        return np.sqrt(np.maximum(squares + self.norm**2 - 2 * score, 0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)
    return np.sqrt(np.maximum(squares - 2 * (a @ b.T), 0))


def far_apart(points: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` different points, each the farthest from those before it."""
    chosen = [0]
    least = distances(points, points[:1])[:, 0]
    while len(chosen) < most and least.max() > SLACK * np.abs(points).max():
        chosen.append(int(least.argmax()))
        least = np.minimum(least, distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


@dataclass
class Node:
    """Split points with the range of distances from each to the rows of every subtree."""

    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    below: list[Node | Leaf] = field(default_factory=list)

    def reached(self, away: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
        """Which subtrees can hold rows between both radii, by anchor; ``away`` are the
        anchors' distances from the split points."""
        near = np.maximum(away - outer[:, None], inner[:, None] - away)[:, :, None]
        far = (away + outer[:, None])[:, :, None]
        return ((self.low <= far) & (self.high >= near)).all(axis=1)


@dataclass
class Leaf:
    rows: np.ndarray
    number: int


def ranges(away: np.ndarray, cell: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(split point, subtree) minima and maxima of distances; an empty subtree has none."""
    low, high = np.full((2, cells, cells), np.inf)
    high = -high
    for j in np.unique(cell):
        low[:, j], high[:, j] = away[cell == j].min(axis=0), away[cell == j].max(axis=0)
    return low, high


def grow(points: np.ndarray, slack: float, fanout: int, leaf: int) -> tuple[Node | Leaf, int]:
    """The tree over ``points`` and its number of leaves. Rows that no split point
    separates stay in one leaf, however many they are."""
    leaves = 0

    def split(rows: np.ndarray) -> Node | Leaf:
        nonlocal leaves
        if len(rows) > leaf:
            own = points[rows]
            centres = far_apart(own[::max(1, len(own) // (8 * fanout))], fanout)
            away = distances(own, centres)
            cell = away.argmin(axis=1)
            if len(np.unique(cell)) > 1:
                low, high = ranges(away, cell, len(centres))
                node = Node(centres, low - slack, high + slack)
                node.below = [split(rows[cell == j]) for j in range(len(centres))]
                return node
        leaves += 1
        return Leaf(rows, leaves - 1)

    return split(np.arange(len(points))), leaves


@dataclass
class Search:
    """Anchors with windows of products [low, high], and the best rows found in each so far.

    ``same`` asks for rows of the anchor's own label, else for those of other labels.
    """

    space: Space
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    k: int

    def __post_init__(self) -> None:
        n, windows = self.low.shape
        self.points = self.space.anchors(self.vectors)
        self.squares = np.einsum("ij,ij->i", self.points, self.points)
        self.scores = np.full((n * windows, self.k), NONE)
        self.found = np.full((n * windows, self.k), NONE)
        self.slack = SLACK * (self.space.norm + np.sqrt(self.squares.max(initial=0)))
        self.visited = 0

    def radii(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Annuli that hold whatever can still enter a list of these anchors."""
        if not self.space.exact:
            return np.zeros(len(at)), np.full(len(at), np.inf)
        last = self.scores[:, -1].reshape(self.low.shape)[at]
        least = np.maximum(self.low[at], last).min(axis=1, initial=np.iinfo(np.int64).max)
        most = self.high[at].max(axis=1, initial=NONE)
        outer = self.space.radius(self.squares[at], least.astype(np.float64))
        return self.space.radius(self.squares[at], most.astype(np.float64)), outer

    def reached(self, node: Node, at: np.ndarray) -> np.ndarray:
        away = distances(self.points[at], node.points)
        inner, outer = self.radii(at)
        return node.reached(away, inner - self.slack, outer + self.slack)

    def visit(self, at: np.ndarray, ids: np.ndarray, labels: np.ndarray, v: np.ndarray) -> None:
        """Offer the rows of a leaf to the lists of the anchors ``at``."""
        for low in range(0, len(ids), TREE):
            part = slice(low, low + TREE)
            self.offer(at, ids[part], labels[part], v[part])

    def offer(self, at: np.ndarray, ids: np.ndarray, labels: np.ndarray, v: np.ndarray) -> None:
        self.visited += len(at) * len(ids)
        if self.space.exact:
            score = (self.points[at, :-1] @ v.T.astype(np.float64)).astype(np.int64)
        else:
            score = products(self.vectors[at], v)
        fits = (self.labels[at][:, None] == labels) == self.same
        fits &= self.ids[at][:, None] != ids
        windows = self.low.shape[1]
        last = self.scores[:, -1].reshape(self.low.shape)
        slots, rows, scores = [], [], []
        for w in range(windows):
            least = np.maximum(self.low[at, w], last[at, w])
            a, row = np.nonzero(fits & (score >= least[:, None])
                                & (score <= self.high[at, w][:, None]))
            slots.append(at[a] * windows + w)
            rows.append(ids[row])
            scores.append(score[a, row])
        slot, row, score = map(np.concatenate, (slots, rows, scores))
        if not len(slot):
            return
        changed = np.unique(slot)
        held = self.found[changed] != NONE
        slot = np.concatenate([np.repeat(changed, held.sum(axis=1)), slot])
        row = np.concatenate([self.found[changed][held], row])
        score = np.concatenate([self.scores[changed][held], score])
        order = np.lexsort((row, ~score, slot))
        slot, row, score = slot[order], row[order], score[order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        top = rank < self.k
        self.found[changed], self.scores[changed] = NONE, NONE
        self.found[slot[top], rank[top]] = row[top]
        self.scores[slot[top], rank[top]] = score[top]

    def walk(self, at: np.ndarray, ids: np.ndarray, labels: np.ndarray, v: np.ndarray,
             fanout: int, leaf: int) -> None:
        """Search one tree: first every anchor's nearest leaf, then all that its lists,
        shorter by then, do not rule out."""
        top, leaves = grow(self.space.rows(v), self.slack, fanout, leaf)
        home = np.full(len(self.ids), -1)

        def descend(node: Node | Leaf, at: np.ndarray) -> None:
            if not len(at):
                return
            if isinstance(node, Leaf):
                home[at] = node.number
                self.visit(at, ids[node.rows], labels[node.rows], v[node.rows])
                return
            cell = distances(self.points[at], node.points).argmin(axis=1)
            for j in np.unique(cell):
                descend(node.below[j], at[cell == j])

        def search(node: Node | Leaf, at: np.ndarray) -> None:
            if isinstance(node, Leaf):
                at = at[home[at] != node.number]
                self.visit(at, ids[node.rows], labels[node.rows], v[node.rows])
                return
            for j, below in enumerate(node.below):
                on = at[self.reached(node, at)[:, j]] if len(at) else at
                if len(on):
                    search(below, on)

        for low in range(0, len(at), STRIP):
            descend(top, at[low:low + STRIP])
            if leaves > 1:
                search(top, at[low:low + STRIP])

    def lists(self) -> pd.DataFrame:
        """(slot, vec_id, score) of all lists."""
        slot, rank = np.nonzero(self.found != NONE)
        return pd.DataFrame({
            "slot": slot, "vec_id": self.found[slot, rank], "score": self.scores[slot, rank],
        })


def matrix(rows: pd.Series, width: int) -> np.ndarray:
    return np.array(rows.tolist(), np.int64).reshape(len(rows), width)


def runs(stream: Iterable[pd.DataFrame], most: int) -> Iterator[tuple[int, int, pd.DataFrame]]:
    """Rows of one width and cell after another, at most ``most`` at a time."""
    held: list[pd.DataFrame] = []
    key, size = None, 0
    for part in stream:
        change = (part[["width", "cell"]] != part[["width", "cell"]].shift()).any(axis=1)
        for _, same in part.groupby(change.cumsum()):
            here = (int(same["width"].iloc[0]), int(same["cell"].iloc[0]))
            if held and here != key:
                yield *key, pd.concat(held)
                held, size = [], 0
            key = here
            while size + len(same) >= most:
                cut = most - size
                yield *key, pd.concat([*held, same[:cut]])
                same, held, size = same[cut:], [], 0
            if len(same):
                held.append(same)
                size += len(same)
    if held:
        yield *key, pd.concat(held)


def mine_hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5,
    low: int = 80, high: int = 100, scale: int = 256,
    vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
    cells: int = CELLS, fanout: int = FANOUT, leaf: int = LEAF, tree: int = TREE,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the integer product of floor(scale * x). The rows with an anchor's label and
    the highest scores are its positives. For each, the negatives are the first rows of other
    labels whose score is from ``low`` to ``high`` percent of the positive's. Ties go to the
    smaller id. ``anchors`` is a predicate on ``vec_id``; labels are integers.

    Rows lie in cells of nearest split points, chosen from ``SAMPLE`` rows; every row is
    searched. Split points know the range of their distances to the rows of each cell, and
    in a task's trees to those of each sibling subtree. A window of scores is an annulus
    around the anchor, and whatever lies outside it by one of these ranges is passed over. Leaves
    are compared exactly. Cells are cut into trees of ``tree`` rows, so a hot one is many
    tasks' work. Anchors go to the rows in batches of bounded bytes, and each task
    answers with its best rows only; no row is copied for an anchor.

    Rows with a null id or label, a null vector or null or non-finite components take no
    part, nor do rows with an anchor's own id. Only equal numbers of components are
    compared. A repeated anchor is answered each time. An anchor without positives, or a
    positive without rows in its window, has no rows in the result. Products beyond 64 bits
    stop at the limits; then nothing is passed over. Only the named columns are read.
    """
    shared = Shared(vectors.sparkSession)
    x = F.col("v")
    odd = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.select(
        vectors[vec_id].cast("long").alias("vec_id"), vectors[label].cast("long").alias("label"),
        vectors[vector].alias("v"),
    ).filter("vec_id is not null and label is not null and v is not null").filter(~odd)
    whole = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long"))
    rows = rows.select("vec_id", "label", whole.alias("vector"),
                       F.size("v").cast("long").alias("width"))
    kinds = "vec_id long, label long, vector array<long>, width long"

    double = lambda e: e.cast("double")
    square = F.aggregate("vector", F.lit(0.0), lambda a, e: a + double(e) * double(e))
    most, widest, largest = rows.agg(
        F.max(square), F.max("width"),
        F.max(F.array_max(F.transform("vector", lambda e: F.abs(double(e))))),
    ).first()
    space = Space(float(most or 0) ** 0.5 * (1 + SLACK),
                  (largest or 0) ** 2 * (widest or 0) < 1 << 53)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    share = {int(w): max(1, round(cells * len(p) / len(sample)))
             for w, p in sample.groupby("width")}
    tops = {w: far_apart(space.rows(matrix(sample["vector"][sample["width"] == w], w)), n)
            for w, n in share.items()}

    def dealt(stream: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in stream:
            for width, same in part.groupby("width"):
                cell = np.zeros(len(same), np.int64)
                if width in tops:
                    away = distances(space.rows(matrix(same["vector"], width)), tops[width])
                    cell = away.argmin(axis=1)
                yield same.assign(cell=cell)

    ordered = ["width", "cell", F.xxhash64("vec_id"), "vec_id"]
    held = shared.put(
        rows.mapInPandas(dealt, f"{kinds}, cell long")
        .repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    )

    def extents(stream: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for width, cell, part in runs(stream, tree):
            if width in tops:
                away = distances(space.rows(matrix(part["vector"], width)), tops[width])
                yield pd.DataFrame({
                    "width": width, "cell": cell, "point": np.arange(away.shape[1]),
                    "low": away.min(axis=0), "high": away.max(axis=0),
                })

    measured = (
        held.mapInPandas(extents, "width long, cell long, point long, low double, high double")
        .groupBy("width", "cell", "point").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .collect()
    )
    slack = SLACK * space.norm
    upper = {}
    for w, points in tops.items():
        low_, high_ = np.full((2, len(points), len(points)), np.inf)
        upper[w] = Node(points, low_, -high_)
    for r in measured:
        upper[r["width"]].low[r["point"], r["cell"]] = r["low"] - slack
        upper[r["width"]].high[r["point"], r["cell"]] = r["high"] + slack

    def found(asked: pd.DataFrame, low: list, high: list, same: bool, k: int,
              home: bool = False) -> DataFrame:
        """(slot, vec_id, score): each task's best rows; ``home`` looks only into an anchor's
        own cell."""
        sent = shared.spark.sparkContext.broadcast((asked, low, high))

        def search(stream: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            asked, low, high = sent.value
            searches, width_of = {}, asked["width"].to_numpy()
            for width, cell, part in runs(stream, tree):
                if width not in searches:
                    at = np.flatnonzero(width_of == width)
                    own = asked.iloc[at]
                    searches[width] = at, Search(
                        space, own["vec_id"].to_numpy(), own["label"].to_numpy(),
                        matrix(own["vector"], width), low[at], high[at], same, k,
                    )
                asking = searches[width][1]
                on = np.arange(len(asking.ids))
                if width in upper and len(on):
                    away = distances(asking.points, upper[width].points)
                    on = on[away.argmin(axis=1) == cell] if home else on[
                        np.concatenate([asking.reached(upper[width], on[i:i + STRIP])[:, cell]
                                        for i in range(0, len(on), STRIP)])]
                if len(on):
                    part = part.sort_values("vec_id")
                    asking.walk(on, part["vec_id"].to_numpy(), part["label"].to_numpy(),
                                matrix(part["vector"], width), fanout, leaf)
            windows = low.shape[1]
            for at, asking in searches.values():
                lists = asking.lists()
                slot = lists["slot"].to_numpy()
                yield lists.assign(slot=at[slot // windows] * windows + slot % windows)

        lists = held.mapInPandas(search, "slot long, vec_id long, score long")
        best = Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id")
        return lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    asked = shared.put(numbered(shared, held.filter(anchors), [F.col("vec_id")], "n"))
    total = asked.count()
    schema = ("anchor_id long, positive_id long, rank int, negative_id long,"
              " positive_score long, negative_score long")
    if not total:
        return shared.spark.createDataFrame([], schema)
    batch = max(1, batch_bytes // (8 * max(1, widest)))
    folder = shared.path()
    for start in range(0, total, batch):
        some = asked.filter(F.col("n").between(start, start + batch - 1)).orderBy("n").toPandas()
        shape = (len(some), 1)
        least, top = np.full(shape, NONE), np.full(shape, np.iinfo(np.int64).max)
        near = found(some, least, top, True, positives, home=True)
        near = near.filter(F.col("rank") == positives).toPandas()
        least[near["slot"], 0] = near["score"]
        pairs = found(some, least, top, True, positives).toPandas()
        at, place = pairs["slot"].to_numpy(), pairs["rank"].to_numpy() - 1
        # An empty window: nothing is at least the largest and at most the smallest number.
        least, top = np.full((2, len(some), positives), np.iinfo(np.int64).max)
        top = np.full_like(top, NONE)
        score = pairs["score"].to_numpy()
        least[at, place] = [-(-low * int(s) // 100) for s in score]
        top[at, place] = [high * int(s) // 100 for s in score]
        windows = pd.DataFrame({
            "slot": at * positives + place, "anchor_id": some["vec_id"].to_numpy()[at],
            "positive_id": pairs["vec_id"], "positive_score": score,
        })
        told = shared.spark.createDataFrame(
            windows, "slot long, anchor_id long, positive_id long, positive_score long")
        hard = found(some, least, top, False, negatives).withColumnsRenamed(
            {"vec_id": "negative_id", "score": "negative_score"})
        hard.join(F.broadcast(told), "slot").select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        ).write.mode("append").parquet(folder)
    return shared.spark.read.schema(schema).parquet(folder)
