"""Exact top-k search: tiled products of query batches and shards, lists merged in a tree."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from marketlens.llm.shared import Shared, numbered

QUERY_BLOCK = 2048
SHARD = 16_384
FAN_IN = 16
#: Queries of a tile that are scored at once, bytes of queries that go to all rows at once.
STRIP = 128
BATCH_BYTES = 1 << 24
LIST = "query long, query_id long, vec_id long, score long, rank int, block long, shard long"


def stacked(rows: pd.DataFrame) -> dict[int, tuple[pd.DataFrame, np.ndarray]]:
    """Rows and their vectors as one integer matrix, by number of components."""
    return {
        int(d): (part, np.array(part["vector"].tolist(), np.int64).reshape(len(part), int(d)))
        for d, part in rows.groupby(rows["vector"].map(len))
    }


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products: in double precision while every sum stays below 2^53."""
    largest = [int(max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))) for m in (q, c)]
    most = largest[0] * largest[1] * max(1, q.shape[1])
    if most < 1 << 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return q @ c.T
    limits = np.iinfo(np.int64)
    exact = q.astype(object) @ c.astype(object).T
    return np.clip(exact, limits.min, limits.max).astype(np.int64)


def tile(queries: pd.DataFrame, shard: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best rows of a shard for every query of a block."""
    found = []
    held = stacked(shard.sort_values("vec_id"))
    for width, (asked, q) in stacked(queries).items():
        rows, c = held.get(width, (shard[:0], np.zeros((0, width), np.int64)))
        ids = rows["vec_id"].to_numpy()
        for low in range(0, len(asked), STRIP):
            scores = products(q[low:low + STRIP], c)
            own = asked["vec_id"].to_numpy()[low:low + STRIP, None] == ids[None, :]
            for i, (row, out) in enumerate(zip(scores, own)):
                some = np.flatnonzero(~out)
                if len(some) > k:
                    border = np.partition(row[some], len(some) - k)[len(some) - k]
                    above, ties = some[row[some] > border], some[row[some] == border]
                    some = np.concatenate([above, ties[:k - len(above)]])
                found.append((low + i, width, asked.index[low + i], some, row[some], ids[some]))
    if not found:
        return empty_list()
    label = np.repeat([f[2] for f in found], [len(f[3]) for f in found])
    source = queries.loc[label]
    out = pd.DataFrame({
        "query": source["query"].to_numpy(), "query_id": source["vec_id"].to_numpy(),
        "vec_id": np.concatenate([f[5] for f in found]),
        "score": np.concatenate([f[4] for f in found]),
    })
    return out


def empty_list() -> pd.DataFrame:
    return pd.DataFrame({n: np.zeros(0, np.int64) for n in ("query", "query_id", "vec_id", "score")})


def best(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's ``k`` first rows by score, ties to the smaller id, with their rank."""
    rows = rows.sort_values(["query", "score", "vec_id"], ascending=[True, False, True])
    rank = rows.groupby("query").cumcount() + 1
    return rows.assign(rank=rank.astype(np.int32))[rank <= k]


def whole_vectors(vectors: DataFrame, vector: str, vec_id: str, scale: int) -> DataFrame:
    """(vec_id, vector of longs): floor(scale * x) of vectors without null or non-finite parts."""
    x = F.col("v")
    odd = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[vector].alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & ~odd)
    part = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long"))
    return rows.select("vec_id", part.alias("vector"))


def top_inner_products(
    vectors: DataFrame, queries: Column, k: int = 20, scale: int = 64,
    vector: str = "embedding", vec_id: str = "vec_id",
    query_block: int = QUERY_BLOCK, shard: int = SHARD, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest integer products of every query.

    ``queries`` is a predicate on ``vec_id``. Queries go to the rows, in batches of
    ``batch_bytes`` at most; rows stay where they are stored. A task multiplies a batch with
    one shard of its rows after another and keeps ``k`` rows a query, so what is shuffled is
    ``k`` rows a query and task. These lists are merged in a tree, those of ``FAN_IN`` tasks
    and one block of queries at a time, so no task reads more than that.

    Ties go to the smaller id. Candidates are all rows but those with the query's own
    id; only vectors with as many components as the query can match. Rows with a null
    id, a null vector or null or non-finite components take no part; a query without
    candidates has no rows. A repeated query row is asked, and answered, each time.
    Products beyond 64 bits stop at the limits. Only the named columns are read.
    """
    shared = Shared(vectors.sparkSession)
    rows = shared.put(whole_vectors(vectors, vector, vec_id, scale))
    asked = shared.put(numbered(shared, rows.filter(queries), [F.col("vec_id")], "query"))
    total, widest = asked.agg(F.count("*"), F.max(F.size("vector"))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not total:
        return shared.spark.createDataFrame([], schema)
    tasks = rows.select(F.spark_partition_id().alias("task")).agg(F.max("task")).first()[0] + 1

    def lists(start: int, end: int) -> DataFrame:
        some = asked.filter(F.col("query").between(start, end - 1)).toPandas()
        sent = shared.spark.sparkContext.broadcast(some)

        def score(stream: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            asking, held = sent.value, []
            for part in shards(stream, shard):
                held = [best(pd.concat([*held, tile(asking, part, k)]), k)]
            for found in held:
                block = found["query"] // query_block
                yield found.assign(block=block, shard=TaskContext.get().partitionId())

        found, left = rows.mapInPandas(score, LIST), tasks
        while left > 1:
            found = found.withColumn("shard", F.floor(F.col("shard") / FAN_IN))
            found = found.groupBy("block", "shard").applyInPandas(merge, LIST)
            left = -(-left // FAN_IN)
        return found.select("query_id", "rank", "vec_id", "score")

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return best(rows, k).assign(block=key[0], shard=key[1])

    batch = max(1, batch_bytes // (8 * max(1, widest)))
    folder = shared.path()
    for start in range(0, total, batch):
        lists(start, start + batch).write.mode("append").parquet(folder)
    return shared.spark.read.schema(schema).parquet(folder)


def shards(stream: Iterable[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """A task's rows, ``most`` at a time."""
    held, size = [], 0
    for part in stream:
        while size + len(part) >= most:
            cut = most - size
            yield pd.concat([*held, part[:cut]])
            part, held, size = part[cut:], [], 0
        if len(part):
            held.append(part)
            size += len(part)
    if held:
        yield pd.concat(held)
