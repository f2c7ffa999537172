"""Mixing sources to target weights by pivotal dependent rounding in a reduction tree."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marketlens.llm.shared import Shared, numbered

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
#: Documents that one task rounds, fractional ones that one merge takes in.
LEAF = 8192
FAN_IN = 32
STATE = "source string, node long, id long, mark long, size long, words long, p double"
MASK = (1 << 64) - 1


def uniform(mark: int, turn: int) -> float:
    """A number in [0, 1) that only depends on its arguments."""
    x = (mark + turn * 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return ((x ^ (x >> 31)) >> 11) / (1 << 53)


def pivotal(words: Sequence[int], p: Sequence[float], marks: Sequence[int]) -> list[float]:
    """Round copy probabilities; at most one entry of the result stays fractional.

    The carried document and the next one exchange words until the probability of one
    of them is 0 or 1. The direction is drawn so that both keep their expectation, and
    the expected words of the two never change.
    """
    out = list(p)
    carry = -1
    for i, (size, q) in enumerate(zip(words, p)):
        if size == 0 or q <= 0.0 or q >= 1.0:
            out[i] = float(q >= 1.0) if size else 0.0
            continue
        if carry < 0:
            carry = i
            continue
        c, r = words[carry], out[carry]
        up = min((1.0 - r) * c, q * size)
        down = min(r * c, (1.0 - q) * size)
        rise = uniform(marks[i] ^ marks[carry], i) * (up + down) < down
        if rise:
            whole = (1.0 - r) * c <= q * size
            r, q = (1.0, q - up / size) if whole else (r + up / c, 0.0)
        else:
            whole = r * c <= (1.0 - q) * size
            r, q = (0.0, q + down / size) if whole else (r - down / c, 1.0)
        out[carry], out[i] = r, q
        if whole:
            carry = i if 0.0 < q < 1.0 else -1
        elif not 0.0 < r < 1.0:
            carry = -1
    return out


def rounding(root: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda rows: round_group(rows, root)


def round_group(rows: pd.DataFrame, root: bool) -> pd.DataFrame:
    """One node of the tree: long documents first, so what stays fractional is short."""
    rows = rows.sort_values(["words", "mark", "id"], ascending=[False, True, True])
    marks = [int(m) & MASK for m in rows["mark"]]
    out = pivotal(rows["words"].tolist(), rows["p"].tolist(), marks)
    if root:
        out = [float(uniform(m, -1) < p) if 0.0 < p < 1.0 else p for p, m in zip(out, marks)]
    return rows.assign(p=out)


def targets(
    shared: Shared, sizes: DataFrame, weights: Sequence[int], share: float, most: float
) -> DataFrame:
    """(source, source_size, target): weighted shares of ``share`` times all words.

    Sources in code point order, null last, take the weights in turn. A target stops at
    ``most`` times its source, and the excess goes to the others by weight, round by
    round until none is above. Rounds need two sums each, so sources may be many.
    """
    order = [F.col("source").isNull(), F.col("source")]
    rows = numbered(shared, sizes, order, "n")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("n") % len(weights) + 1).cast("int"))
    rows = shared.put(rows.select("source", "source_size", weight.alias("weight")))
    cap = F.col("source_size") * float(most)
    total = float(rows.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        free = cap > F.col("weight") * level
        spent, open_ = rows.agg(
            F.sum(F.when(~free, cap)), F.sum(F.when(free, F.col("weight")))
        ).first()
        if not open_:
            break
        following = (total - (spent or 0.0)) / open_
        if following <= level * (1 + 1e-12):
            break
        level = following
    return rows.select(
        "source", "source_size", F.least(cap, F.col("weight") * level).alias("target")
    )


def mix_sources(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
    weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 11,
) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target`` and ``copies``.

    Size: words of the text. A source's rows have copies in the proportion of its target
    to its size, ``most`` at most; the fraction is settled by pivotal rounding. Rows of a
    source are dealt into leaves of a bounded size by hash; each leaf leaves one fractional
    document at most, and ``FAN_IN`` leaves at a time are merged up to the source's root,
    where the last one is drawn. A source's words thus differ from its target by less
    than its last document. A hot source only has more leaves. Draws depend on ids,
    sizes and ``seed`` alone, so reruns agree.

    Null text has no words; texts without words get no copies beyond the whole ones of
    the rate. A null source is a source of its own. Rows that agree in id, source and
    text are rounded alike, as one document of their joint size; null ids are ids. No
    rows give no rows. Columns of ``docs`` called like the four new ones are replaced.
    """
    shared = Shared(docs.sparkSession)
    added = ["size", "source_size", "target", "copies"]
    key = [
        docs[source].cast("string").alias("_source"),
        F.xxhash64(docs[doc_id], docs[text], F.lit(seed)).alias("_mark"),
        F.coalesce(docs[doc_id].cast("long"), F.lit(0)).alias("_id"),
    ]
    rows = docs.select(
        F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("_row"), *key
    )
    size = F.regexp_count(F.coalesce(docs[text], F.lit("")), F.lit(WORDS)).cast("long")
    units = docs.select(*key, size.alias("size")).toDF("source", "mark", "id", "size")
    units = shared.put(units.groupBy("source", "mark", "id", "size").count())
    sizes = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("count")).alias("source_size"), F.count("*").alias("n")
    )
    sizes = shared.put(sizes)
    wanted = shared.put(targets(shared, sizes.select("source", "source_size"), weights, share, most))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    leaves = F.ceil(F.col("n") / LEAF)
    rates = wanted.join(
        sizes.select(F.col("source").alias("_s"), "n"), F.col("source").eqNullSafe(F.col("_s"))
    ).select(F.col("source").alias("_s"), "source_size", "target", rate.alias("rate"),
             leaves.alias("leaves"))
    rates = shared.put(rates)
    deepest = int(rates.agg(F.max("leaves")).first()[0] or 0)
    state = units.join(rates, F.col("source").eqNullSafe(F.col("_s"))).select(
        "source", F.pmod(F.xxhash64("mark", F.lit(seed)), F.col("leaves")).alias("node"),
        "id", "mark", "size", (F.col("size") * F.col("count")).alias("words"),
        (F.col("rate") - F.floor("rate")).alias("p"),
    )
    settled = []
    while deepest:
        root = deepest == 1
        node = state.groupBy("source", "node")
        state = shared.put(node.applyInPandas(rounding(root), STATE))
        whole = (F.col("p") <= 0.0) | (F.col("p") >= 1.0)
        settled.append(state.filter(whole))
        if root:
            break
        state = state.filter(~whole).withColumn("node", F.floor(F.col("node") / FAN_IN))
        deepest = -(-deepest // FAN_IN)
    if not settled:
        return docs.select(*[c for c in docs.columns if c not in added]).limit(0).withColumns({
            "size": F.lit(0).cast("long"), "source_size": F.lit(0).cast("long"),
            "target": F.lit(0.0), "copies": F.lit(0).cast("long")})
    drawn = settled[0]
    for more in settled[1:]:
        drawn = drawn.unionByName(more)
    drawn = drawn.select(
        F.col("source").alias("_ds"), F.col("id").alias("_di"), F.col("mark").alias("_dm"),
        "size", F.col("p").cast("long").alias("_extra"),
    )
    same = F.col("_source").eqNullSafe(F.col("_ds"))
    met = rows.join(drawn, same & (F.col("_id") == F.col("_di")) & (F.col("_mark") == F.col("_dm")))
    met = met.join(rates, F.col("_source").eqNullSafe(F.col("_s")))
    copies = F.floor("rate") + F.col("_extra")
    return met.select(
        *[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in added],
        "size", "source_size", "target", copies.cast("long").alias("copies"),
    )

