"""A training corpus from raw documents: every stage works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlens.llm.linededup import drop_repeated_lines
from marketlens.llm.mixing import mix_sources
from marketlens.llm.packing import pack_documents
from marketlens.llm.queries import table, tokenizer_path
from marketlens.llm.shared import Shared
from marketlens.llm.simhash import one_of_each_group
from marketlens.llm.toxicity import drop_toxic, train

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the CRF does not predict to be toxic."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; n_chars follows the text."""
    kept = drop_repeated_lines(docs)
    changed = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return kept.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return one_of_each_group(docs, shingle=3, radius=3)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mix_sources(docs).filter("copies > 0")
    turns = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mixed.withColumn("copies", turns).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 4096 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("mixing", mixing),
    ("packing", packing),
]

#: The CRF, XXH64 links, rounding and packing have no SQL form; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again."""
    shared = Shared(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = shared.put(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
