"""SimHash near-dedup: word-shingle fingerprints linked through BK-trees of bounded shards."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from marketlens.llm.components import components, unite
from marketlens.llm.shared import Shared, work_units

BITS = 64
SEED = 42
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWERED = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
RUN = 1 << 16
#: Fingerprints that a task compares at once, and most that one tree holds.
TREE = 4096
QUERIES = 256


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 majority bits over the XXH64 of all word shingles, repeats included.

    Fewer words than ``shingle`` form one shingle; without words the value is zero.
    """
    words = WORD.findall((text or "").translate(LOWERED))
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, RUN):
        parts = [words[start + k:min(n, start + RUN) + k] for k in range(shingle)]
        grams = map(" ".join, zip(*parts)) if len(words) >= shingle else [" ".join(words)]
        values = np.fromiter((hashed(g.encode(), SEED) for g in grams), np.uint64)
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3
) -> DataFrame:
    """(doc_id, text_md5, fp) per row; fp holds the 64 bits as a signed long."""

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            values = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column(2)), np.uint64
            ).view(np.int64)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(values)],
                names=["doc_id", "text_md5", "fp"],
            )

    rows = docs.select(
        docs[doc_id].cast("long").alias("doc_id"), md5_of(docs[text]).alias("text_md5"),
        docs[text].alias("text"),
    )
    return rows.mapInArrow(batches, "doc_id long, text_md5 string, fp long")


def md5_of(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


class Forest:
    """BK-trees, one per bucket: a child hangs from its parent by their Hamming distance."""

    def __init__(self, values: np.ndarray, buckets: np.ndarray):
        """``buckets``: ascending bucket numbers of the distinct ``values``."""
        n = len(values)
        self.values = values
        first = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if n else np.zeros(0, int)
        self.buckets, self.roots = buckets[first], first
        at = np.repeat(first, np.diff(np.r_[first, n]))
        rest = np.setdiff1d(np.arange(n), first, assume_unique=True)
        parents, children, edges = [], [], []
        while len(rest):
            up = at[rest]
            far = np.bitwise_count(values[rest] ^ values[up]).astype(np.int64)
            _, lead, group = np.unique(up * (BITS + 1) + far, return_index=True, return_inverse=True)
            parents.append(up[lead])
            children.append(rest[lead])
            edges.append(far[lead])
            at[rest] = rest[lead][group]
            keep = np.ones(len(rest), bool)
            keep[lead] = False
            rest = rest[keep]
        none = [np.zeros(0, np.int64)]
        parent = np.concatenate(parents or none)
        order = np.argsort(parent, kind="stable")
        self.children = np.concatenate(children or none)[order]
        self.edges = np.concatenate(edges or none)[order]
        self.starts = np.searchsorted(parent[order], np.arange(n + 1))

    def within(self, values: np.ndarray, buckets: np.ndarray, radius: int):
        """Yield (query numbers, node numbers) at ``radius`` bits or fewer, chunk by chunk."""
        place = np.searchsorted(self.buckets, buckets)
        place = np.minimum(place, max(0, len(self.buckets) - 1))
        known = self.buckets[place] == buckets if len(self.buckets) else np.zeros(len(buckets), bool)
        asked = np.flatnonzero(known)
        for low in range(0, len(asked), QUERIES):
            query = asked[low:low + QUERIES]
            node = self.roots[place[query]]
            while len(query):
                far = np.bitwise_count(values[query] ^ self.values[node]).astype(np.int64)
                near = far <= radius
                yield query[near], node[near]
                degree = self.starts[node + 1] - self.starts[node]
                walker = np.repeat(np.arange(len(query)), degree)
                first = np.cumsum(degree) - degree
                child = np.arange(len(walker)) - first[walker] + self.starts[node][walker]
                follow = np.abs(self.edges[child] - far[walker]) <= radius
                query, node = query[walker[follow]], self.children[child[follow]]


def shard_links(rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Spanning links (a, b) of one unit: tree rows (side 0) against themselves or side 1."""
    bucket = np.unique(rows[["band", "key"]].to_numpy(), axis=0, return_inverse=True)[1].ravel()
    value, side = rows["fp"].to_numpy().view(np.uint64), rows["side"].to_numpy()
    order = np.lexsort((value, bucket, side))
    bucket, value, side = bucket[order], value[order], side[order]
    split = int(np.searchsorted(side, 1))
    tree = Forest(value[:split], bucket[:split])
    pair = bool(rows["lo"].iloc[0] < rows["hi"].iloc[0])
    base = split if pair else 0
    parent = np.arange(len(value))
    for query, node in tree.within(value[base:], bucket[base:], radius):
        parent = unite(parent, query + base, node)
    linked = parent != np.arange(len(value))
    signed = value.view(np.int64)
    links = pd.DataFrame({"a": signed[linked], "b": signed[parent[linked]]})
    return links.drop_duplicates()


def bands(radius: int, n: int) -> list[tuple[int, ...]]:
    """Bit sets of which one at least agrees for any two values within ``radius`` bits.

    The bits are cut into blocks; ``radius`` of them may differ, so all others agree
    for some choice. More blocks make longer, rarer keys: as many as keep evenly
    spread buckets below some dozens of the ``n`` values.
    """
    for blocks in range(radius + 1, radius + 5):
        cuts = np.linspace(0, BITS, blocks + 1).astype(int)
        kept = [
            tuple(b for block in some for b in range(cuts[block], cuts[block + 1]))
            for some in combinations(range(blocks), blocks - radius)
        ]
        if n < 64 << min(map(len, kept)):
            break
    return kept


def simhash_groups(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    shingle: int = 3, radius: int = 3, tree: int = TREE,
) -> DataFrame:
    """(doc_id, fingerprint, component_id, text_md5, kept) per row of ``docs``.

    Equal fingerprints collapse first. Two values within ``radius`` bits agree on all
    bits of some band, so every band's buckets are the shards: one BK-tree each, built
    where the rows of the shard are and followed only along edges within the radius.
    A bucket of more than ``tree`` values becomes several trees, each asked by every
    piece of the bucket, so no task holds more than two pieces and no link is lost.
    Trees travel to their shard's queries by shuffle: a true broadcast would send all
    fingerprints through the driver.

    Null or empty text has fingerprint zero and links like any other. A null id takes
    the smallest id of its component, or null if there is none; repeated rows come
    back as often. ``component_id`` is the smallest id reachable; ``kept`` marks the rows of
    one document of each component, that with the smallest id, then text hash. No rows give
    no rows. Only the named columns are read.
    """
    shared = Shared(docs.sparkSession)
    marked = shared.put(fingerprints(docs, text, doc_id, shingle))
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_md5"))
    values = shared.put(marked.groupBy("fp").agg(lead.alias("lead")))
    masks = [sum(1 << b for b in kept) for kept in bands(radius, values.count())]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    keys = F.array(*[
        F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(signed)
    ])
    rows = values.select("fp", F.explode(keys).alias("k")).select("k.band", "k.key", "fp")
    links = (
        work_units(shared, rows, ["band", "key"], "fp", tree, 4 * tree)
        .groupBy("unit", "lo", "hi")
        .applyInPandas(lambda rows: shard_links(rows, radius), "a long, b long")
    )
    roots = components(shared, links)
    rooted = values.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "lead", F.coalesce("root", "fp").alias("root")
    )
    rooted = shared.put(rooted)
    first = shared.put(rooted.groupBy("root").agg(F.min("lead").alias("first")))
    named = rooted.join(first, "root").select(F.col("fp").alias("_fp"), "first")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    return marked.join(named, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"), "text_md5",
        (kept & (F.col("text_md5") == F.col("first.text_md5"))).alias("kept"),
    )


def one_of_each_group(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options: int
) -> DataFrame:
    """The rows of ``docs`` that ``simhash_groups`` keeps, one a component."""
    groups = simhash_groups(docs, text, doc_id, **options).filter("kept")
    kept = groups.select(F.col("doc_id").alias("_kept"), F.col("text_md5").alias("_md5"))
    rows = docs.select(
        F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("_row"),
        docs[doc_id].cast("long").alias("_id"), md5_of(docs[text]).alias("_hash"),
    )
    same = F.col("_id").eqNullSafe(F.col("_kept")) & (F.col("_hash") == F.col("_md5"))
    stay = rows.join(kept, same, "left_semi").dropDuplicates(["_id", "_hash"])
    return stay.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
