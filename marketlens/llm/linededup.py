"""Line dedup: lines found in many documents stay only in the last of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlens.llm.shared import Shared

BLANKS = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def drop_repeated_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    min_chars: int = 20, min_docs: int = 3,
) -> DataFrame:
    """Every row of ``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``.

    A line is compared by its text without blanks at the ends, A-Z in lower case.
    Such keys of ``min_chars`` code points or more that at least ``min_docs``
    documents hold lose their lines, except in the largest ``doc_id`` holding them.

    Only hashes, ids and positions are shuffled by line; a line that a third of all
    rows share is counted per (line, document) first. The text travels once, to meet
    the dropped positions of its row. Null or empty text is one empty line, which
    stays. Rows that share a ``doc_id`` count as one document; a null id counts as a
    document below all others. Repeated rows are treated alike. Other columns pass through;
    those called ``kept_text``, ``n_lines`` or ``n_dropped`` are replaced.
    """
    shared = Shared(docs.sparkSession)
    whole = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(
        F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("_row"),
        docs[doc_id].alias("_id"),
        F.md5(whole).alias("_hash"),
        whole.alias("_text"),
    )
    ident = ["_id", "_hash"]
    lines = rows.select(*ident, F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "line"))
    key = F.translate(F.btrim("line", F.lit(BLANKS)), UPPER, LOWER)
    keyed = lines.withColumn("key", key).filter(F.char_length("key") >= min_chars)
    keyed = shared.put(keyed.select(*ident, "_pos", F.unhex(F.md5("key")).alias("h")))

    held = keyed.groupBy("h", "_id").agg(F.lit(1).alias("one"))
    common = (
        held.groupBy("h").agg(F.count("*").alias("n"), F.max("_id").alias("last"))
        .filter(F.col("n") >= min_docs).select("h", "last")
    )
    # Stored, both sides of a join come from shuffles of their own, so Spark can split a hot key.
    common = shared.put(common)
    gone = shared.put(
        keyed.join(common, "h").filter(~F.col("_id").eqNullSafe(F.col("last")))
        .groupBy(*[F.col(c).alias(f"g{c}") for c in ident])
        .agg(F.collect_set("_pos").alias("_gone"))
    )
    met = rows.withColumn("_lines", F.split("_text", "\n", -1)).drop("_text").join(
        gone, [F.col(c).eqNullSafe(F.col(f"g{c}")) for c in ident], "left"
    )
    last = F.size("_lines") - 1
    stay = F.array_except(F.sequence(F.lit(0), last), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.array_join("_lines", "\n")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    )
    return met.select(
        *[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)
          if c not in ("kept_text", "n_lines", "n_dropped")],
        kept.alias("kept_text"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
