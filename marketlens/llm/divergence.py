"""Source divergence audit: sources of a language compared over run-length encoded counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marketlens.llm.shared import Shared, numbered
from marketlens.llm.terms import LETTERS, words

UNIT = 1_000_000_000
SMOOTH = 5
#: Entries a task counts before it hands them on.
HELD = 500_000
#: Terms whose columns are encoded together.
BLOCK = 2048
#: Sources whose counts order the blocks; within a block all do.
LEADING = 2


def count_terms(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task's rows, in parts of bounded size."""
    groups: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0

    def told() -> Iterator[pa.RecordBatch]:
        for (lang, source), (total, docs) in groups.items():
            if total:
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(total)), pa.array([source] * len(total)),
                    pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64()),
                    pa.array([docs[t] for t in total], pa.int64()),
                ], names=["lang", "source", "term", "n", "docs"])

    for batch in stream:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2)):
            total, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            seen, before = set(), len(total)
            for some in words(text.as_py(), LETTERS):
                total.update(some)
                seen.update(some)
            docs.update(seen)
            held += len(total) - before
            if held >= HELD:
                yield from told()
                groups, held = {}, 0
    yield from told()


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(UNIT * (count + SMOOTH) / (total + SMOOTH * kept)), exactly."""
    below = total + SMOOTH * kept
    if (int(counts.max(initial=0)) + SMOOTH) * UNIT < 1 << 63 and below < 1 << 63:
        return 1 + UNIT * (counts.astype(np.int64) + SMOOTH) // below
    return np.array([1 + UNIT * (int(c) + SMOOTH) // below for c in counts], np.int64)


@dataclass
class Column:
    """A source's shares over the terms of a block as runs: where each starts, its value."""

    starts: np.ndarray
    values: np.ndarray

    @classmethod
    def encode(cls, places: np.ndarray, counts: np.ndarray, size: int, total: int, kept: int
               ) -> Column:
        """Runs of equal counts; terms that are not among ``places`` have none."""
        starts = np.concatenate([[0], places, places + 1])
        count = np.concatenate([[0], counts, np.zeros(len(places), np.int64)])
        # At a place that follows another, the count there stands before the zero that ends it.
        order = np.lexsort((count, starts))
        starts, count = starts[order], count[order]
        last = np.r_[starts[1:] != starts[:-1], True] & (starts < size)
        starts, count = starts[last], count[last]
        change = np.r_[True, count[1:] != count[:-1]]
        return cls(starts[change], shares(count[change], total, kept))


def difference(a: Column, b: Column, size: int) -> int:
    """Sum over all terms of the distance of two columns: once per piece that the runs of
    both have in common, times its length."""
    starts = np.union1d(a.starts, b.starts)
    lengths = np.diff(starts, append=size)
    left = a.values[np.searchsorted(a.starts, starts, "right") - 1]
    right = b.values[np.searchsorted(b.starts, starts, "right") - 1]
    return int(np.dot(np.abs(left - right), lengths))


def audit_block(terms: pd.DataFrame, sizes: pd.DataFrame, top: int) -> pd.DataFrame:
    """Parts of all results from one block of a language's ordered terms: the distance of
    every pair of sources, and each source's ``top`` terms above the language."""
    row = sizes.iloc[0]
    names, totals = list(row["sources"]), [int(n) for n in row["totals"]]
    kept, size = int(row["kept"]), len(terms)
    entries = [[(e["source"], e["n"]) for e in v] for v in terms["counts"]]
    order = sorted(range(size), key=entries.__getitem__)
    terms, entries = terms.iloc[order], [entries[i] for i in order]
    held = list(map(len, entries))
    place = np.repeat(np.arange(size), held)
    source = np.array([e[0] for v in entries for e in v], np.int64)
    count = np.array([e[1] for v in entries for e in v], np.int64)
    spelled = terms["term"].to_numpy()
    whole = shares(terms["total"].to_numpy(), int(row["total"]), kept) if size else None
    out, columns = [], []
    for s, name in enumerate(names):
        own = source == s
        if size:
            columns.append(Column.encode(place[own], count[own], size, totals[s], kept))
        at = place[own]
        if len(at):
            over = shares(count[own], totals[s], kept) - whole[at]
            some = np.flatnonzero(over > 0)
            some = some[np.lexsort((spelled[at[some]], -over[some]))][:top]
            out += [(name, "term", spelled[at[i]], int(over[i])) for i in some]
    for a, name in enumerate(names):
        for b in range(a):
            value = difference(columns[a], columns[b], size) if size else 0
            out.append((names[b], "pair", name.encode(), value))
    return pd.DataFrame(out, columns=["source", "part", "item", "value"])


def audit_sources(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    min_docs: int = 30, top: int = 50, block: int = BLOCK,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source of every language.

    A term is a run of letters A-Z, in lower case, and of all characters beyond ASCII. A
    language keeps the terms of at least ``min_docs`` of its rows. p is a term's smoothed
    share of a source's kept terms, q that of what it is compared with. Part ``pair`` has the
    other sources of the language with the sum of abs(p - q) over all kept terms, part
    ``term`` the ``top`` terms that the source holds and that are above their share
    of the language. Ranks are by falling value, then by the item's UTF-8 bytes.

    Rows are counted in their tasks, so a hot source is summed before it is shuffled. Terms
    are ordered by their counts in all sources: equal ones stand together, and each
    source's column is a few runs of equal counts. A task takes a block of ``block`` terms,
    cuts two columns at the run ends of both and multiplies each piece's difference by its
    length. All arithmetic is on integers, so results are exact.

    Null text, lang or source is empty. Repeated rows count each time. A source without
    terms is compared all the same; a language that keeps no term has pairs of value 0. Long
    texts are split in slices. No rows give no rows; only the named columns are read.
    """
    shared = Shared(docs.sparkSession)
    lang_, source_ = (F.coalesce(docs[c].cast("string"), F.lit("")) for c in (lang, source))
    rows = docs.select(lang_.alias("lang"), source_.alias("source"),
                       F.encode(F.coalesce(docs[text], F.lit("")), "UTF-8").alias("text"))
    counted = rows.mapInArrow(
        count_terms, "lang string, source string, term binary, n long, docs long")
    counted = shared.put(
        counted.groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    groups = shared.put(rows.select("lang", "source").distinct())
    # Sources by number, so that counts are compared and stored as integers.
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long")
    named = shared.put(groups.withColumn("number", number))
    vocabulary = shared.put(
        counted.join(named, ["lang", "source"]).groupBy("lang", "term").agg(
            F.sum("docs").alias("docs"), F.sum("n").alias("total"),
            F.array_sort(F.collect_list(F.struct(F.col("number").alias("source"), "n")))
            .alias("counts"),
        ).filter(F.col("docs") >= min_docs).drop("docs")
    )
    # The ends of ranges go through the driver, so they hold no whole list of counts.
    order = [F.col("lang"), F.slice("counts", 1, LEADING), F.xxhash64("counts"), F.col("term")]
    ordered = shared.put(numbered(shared, vocabulary, order, "position").withColumn(
        "block", F.floor(F.col("position") / block)))

    per_source = ordered.select("lang", F.explode("counts").alias("c")).groupBy(
        "lang", F.col("c.source").alias("number")).agg(F.sum("c.n").alias("kept_n"))
    per_lang = ordered.groupBy("lang").agg(
        F.sum("total").alias("total"), F.count("*").alias("kept"))
    zero = F.lit(0).cast("long")
    every = named.join(per_source, ["lang", "number"], "left").groupBy("lang").agg(
        F.array_sort(F.collect_list(
            F.struct("number", "source", F.coalesce("kept_n", zero).alias("kept_n")))).alias("s"))
    every = every.join(per_lang, "lang", "left").select(
        "lang", F.col("s.source").alias("sources"), F.col("s.kept_n").alias("totals"),
        F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept"))
    blocks = ordered.select("lang", "block").distinct().unionByName(
        groups.select("lang").distinct().withColumn("block", F.lit(-1).cast("long")))
    sizes = shared.put(blocks.join(shared.put(every), "lang"))

    def audit(key: tuple, terms: pd.DataFrame, sizes: pd.DataFrame) -> pd.DataFrame:
        return audit_block(terms, sizes, top).assign(lang=key[0])

    found = shared.put(
        ordered.groupBy("lang", "block").cogroup(sizes.groupBy("lang", "block"))
        .applyInPandas(audit, "source string, part string, item binary, value long, lang string")
    )
    columns = ["lang", "source", "part", "item", "value"]
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "item", "part").agg(
        F.sum("value").alias("value"))
    turned = pairs.select(
        "lang", F.col("item").cast("string").alias("source"), "part",
        F.encode("source", "UTF-8").alias("item"), "value")
    both = pairs.select(columns).unionByName(turned)
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = found.filter("part = 'term'").select(columns).withColumn(
        "rank", F.row_number().over(first)).filter(F.col("rank") <= top)
    ranked = both.withColumn("rank", F.row_number().over(first)).unionByName(above)
    return ranked.withColumn("item", F.col("item").cast("string"))
