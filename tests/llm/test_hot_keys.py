"""A key with a third of all rows: joins can be split, and results stay whole."""

import pytest
from pyspark.sql import functions as F

from marketlens.llm.components import components
from marketlens.llm.linededup import drop_repeated_lines
from marketlens.llm.pivots import embedding_groups
from marketlens.llm.shared import Shared
from marketlens.llm.simhash import simhash_groups
from marketlens.llm.warc import read_archives, write_archives

SKIPPED = ("Sort", "InputAdapter", "WholeStageCodegen")


def children(node):
    below = node.children()
    return [below.apply(i) for i in range(below.size())]


def unsplittable(node):
    """Joins one of whose sides does not come straight from a shuffle made for the join."""
    found = []
    if node.nodeName() in ("SortMergeJoin", "ShuffledHashJoin"):
        for side in children(node):
            while side.nodeName().startswith(SKIPPED):
                side = children(side)[0]
            if side.nodeName() != "Exchange":
                found.append(node.simpleString(200) + " <- " + side.nodeName())
    for below in children(node):
        found += unsplittable(below)
    return found


@pytest.fixture
def plans(spark, monkeypatch):
    """Plans of all stored frames without broadcasts; ``check`` looks at one more."""
    found = []

    def check(df):
        found.extend(unsplittable(df._jdf.queryExecution().executedPlan()))
        return found

    put = Shared.put

    def watched(self, df):
        check(df)
        return put(self, df)

    monkeypatch.setattr(Shared, "put", watched)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield check
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


LINE = "This line stands in a third of all documents"


def test_line(spark, plans):
    rows = [(i, f"own {i}\n{LINE}" if i % 3 else f"only one long line of document {i}")
            for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = drop_repeated_lines(df)
    assert plans(got) == []
    kept = {r["doc_id"]: (r["kept_text"], r["n_dropped"]) for r in got.collect()}
    last = max(i for i in range(300) if i % 3)
    assert kept == {i: (t, 0) if i % 3 == 0 or i == last else (f"own {i}", 1) for i, t in rows}


def test_payload(spark, plans, tmp_path):
    rows = [(i, "http://x", "" if i % 3 == 1 else f"<p>{i}</p>") for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    shared = Shared(spark)
    archives = write_archives(df, str(tmp_path / "w"))
    assert plans(archives) == []
    got = read_archives(spark, shared.put(archives)).collect()
    assert {r["page_id"]: r["refers_to"] for r in got} == {
        i: 1 if i % 3 == 1 and i > 1 else None for i in range(300)}


def test_component(spark, plans):
    edges = [(i, 0) for i in range(1, 200)] + [(300 + 2 * i, 301 + 2 * i) for i in range(100)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = components(Shared(spark), df)
    assert plans(got) == []
    roots = dict(got.select("node", "root").collect())
    assert roots == {i: 0 for i in range(1, 200)} | {301 + 2 * i: 300 + 2 * i for i in range(100)}


def test_fingerprints(spark, plans):
    rows = [(i, "the same words in many documents" if i % 3 else f"words of {i} and {i * 7} alone")
            for i in range(120)]
    got = simhash_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert plans(got) == []
    found = {r["doc_id"]: r["component_id"] for r in got.collect()}
    assert {found[i] for i, _ in rows if i % 3} == {1}


def test_vectors(spark, plans):
    rows = [(i, [1.0, 0.5, 0.25] if i % 3 else [0.0, float(i), 1.0], 1) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embedding_groups(df)
    # ``node`` has one row on either side.
    assert [p for p in plans(got.select(F.col("vec_id"))) if "[node#" not in p] == []
    found = {r["vec_id"]: r["component_id"] for r in got.collect()}
    assert {found[i] for i in range(90) if i % 3} == {1}
