"""Arrays that are read in many tasks."""

import json
import random

import pytest
from pyspark.sql import functions as F
from test_sources import RECORDS

from marketlens.sources import RECORD_SCHEMA, json_array_texts, read_catalogue, read_json_array

NASTY = ['},{', '"', '\\', '\\"', '{"id":', '}\n{', "]", "[{", "", "é}", "\\\\", '\\"}', "a\nb"]


def made(n, seed):
    draw = random.Random(seed)

    def text():
        return "".join(draw.choice(NASTY + ["word ", "x" * 9]) for _ in range(draw.randrange(5)))

    def value(depth):
        kind = draw.randrange(6 if depth else 3)
        if kind == 3:
            return {text() + str(i): value(depth - 1) for i in range(draw.randrange(4))}
        if kind == 4:
            return [value(depth - 1) for _ in range(draw.randrange(4))]
        return draw.choice([text(), draw.randrange(100), None, True])

    return [{"id": i, "text": text(), "more": value(3)} for i in range(n)]


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def texts(spark, path):
    return sorted((json.loads(r[0]) for r in json_array_texts(spark, str(path)).collect()),
                  key=lambda r: (str(type(r.get("id"))), r.get("id")))


@pytest.mark.parametrize("indent, ascii", [(None, True), (2, False)])
@pytest.mark.parametrize("seed", [1, 2])
def test_records_across_many_blocks(spark, tmp_path, small_blocks, indent, ascii, seed):
    for part in range(2):
        records = made(150, 10 * seed + part)
        for r in records:
            r["id"] += 1000 * part
        (tmp_path / f"part{part}.json").write_text(
            json.dumps(records, indent=indent, ensure_ascii=ascii))
    rows = json_array_texts(spark, str(tmp_path))
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 8
    want = [{**r, "id": r["id"] + 1000 * part}
            for part in range(2) for r in made(150, 10 * seed + part)]
    assert sorted((json.loads(r[0]) for r in rows.collect()), key=lambda r: r["id"]) == want


def test_a_record_longer_than_several_blocks(spark, tmp_path, small_blocks):
    records = [{"id": 1, "a": "x" * 100}, {"id": 2, "a": {"b": '},{"' * 3000}}, {"id": 3},
               {"id": 4, "a": [{"k": i} for i in range(2000)]}, {"id": 5}]
    (tmp_path / "a.json").write_text(json.dumps(records))
    assert texts(spark, tmp_path) == records


@pytest.mark.parametrize("text, ids", [
    ("[]", []), ("", []), ("[{}]", [None]), (' [ {"id":1} ,\n{"id":2}]\n', [1, 2]),
    ('[1, "a{b", null, {"id":1}, [], "}", {"id":2}, 7]', [1, 2]), ('[{"id":1}', [1]),
    ('["}{", "}", "{{", {"id":1}, "\\\\", "\\"}", {"id":2}]', [1, 2]),
])
def test_small_arrays(spark, tmp_path, text, ids):
    (tmp_path / "a.json").write_text(text)
    assert [r.get("id") for r in texts(spark, tmp_path)] == ids


def test_strings_with_braces_across_blocks(spark, tmp_path, small_blocks):
    records = []
    for i in range(60):
        records += [{"id": i}, "}" * (i * 7), '{"x":', '"}' * i, [i], None]
    (tmp_path / "a.json").write_text(json.dumps(records))
    assert [r["id"] for r in texts(spark, tmp_path)] == list(range(60))


@pytest.mark.parametrize("indent", [None, 2])
def test_reads_what_the_whole_file_scan_reads(spark, tmp_path, small_blocks, indent):
    path = tmp_path / "catalogue.json"
    records = [{**r, "id": str(i)} for i, r in enumerate(RECORDS * 10)]
    path.write_text(json.dumps(records, indent=indent))
    split, whole = read_json_array(spark, str(path)), read_catalogue(spark, str(path))
    assert split.columns == ["id", *RECORD_SCHEMA.names] and split.schema == whole.schema

    def rows(df):
        return sorted(map(str, df.withColumn("tags", F.to_json("tags")).collect()))

    assert rows(split) == rows(whole)
