"""Objects with open key sets and values of mixed types."""

import json

from conftest import rows_of
from pyspark.sql import functions as F

from marketlens import operators as ops
from marketlens.sources import audit_inferred_keys

OBJECTS = [
    '{"a": 1, "b": "12", "c": {"d": [1, 2]}}', '{"a": 2.5, "b": null, "e": true}', "{}", "[1, 2]",
    '"text"', "7", None, "not json", '{"a": "x", "a": "y"}', '{"": 1e300, "a.b": [], "é\\"": {}}',
]


def objects(spark, texts=OBJECTS):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    return df.select("id", F.try_parse_json("t").alias("o"), F.lit("k").alias("key"))


def test_values_come_back_typed(spark):
    opened = ops.open_object(objects(spark), "o", keep=["id"], key="name")
    parts = [part.alias(name) for name, part in ops.typed_parts("value").items()]
    assert sorted(rows_of(opened.select("id", "name", *parts))) == [
        (0, "a", "BIGINT", 1.0, None, None), (0, "b", "STRING", None, "12", None),
        (0, "c", "OBJECT", None, None, '{"d":[1,2]}'), (1, "a", "DECIMAL", 2.5, None, None),
        (1, "b", "VOID", None, None, None), (1, "e", "BOOLEAN", None, None, "true"),
        (9, "", "DOUBLE", 1e300, None, None), (9, "a.b", "ARRAY", None, None, "[]"),
        (9, 'é"', "OBJECT", None, None, "{}"),
    ]


def test_census(spark):
    counts = ops.key_census(objects(spark, OBJECTS[:2] * 3), "o")
    assert ("a", "BIGINT", 3) in rows_of(counts) and ("b", "VOID", 3) in rows_of(counts)
    assert rows_of(ops.key_census(objects(spark, OBJECTS[:1] * 2), "o", k=1)) == [("a", "BIGINT", 2)]
    assert rows_of(ops.key_census(objects(spark, []), "o")) == []


def test_two_hundred_thousand_keys(spark, tmp_path):
    wide = spark.range(1000).select(F.concat(
        F.lit('{"data": {"tags": {'), F.array_join(F.transform(
            F.sequence(F.lit(0), F.lit(199)),
            lambda i: F.format_string('"k%06d": %d', F.col("id") * 200 + i, i)), ", "),
        F.lit("}}}")).alias("value"))
    wide.write.text(str(tmp_path / "wide"))
    audit = audit_inferred_keys(spark, str(tmp_path / "wide"), "data.tags", multi_line=False, first=2)
    assert len(audit.schema) == 3
    assert rows_of(audit) == [("data.tags", 200_000, "k000000, k000001")]


def test_fields_of_odd_records(spark, tmp_path):
    path = tmp_path / "a.json"

    def audit(records):
        path.write_text("\n".join(json.dumps(r) for r in records))
        return rows_of(audit_inferred_keys(spark, str(path), "d.x", multi_line=False))[0][1:]

    assert audit([{"d": {"x": {"b": 1}}}, {"d": {"x": None}}, {}, {"d": 3}]) == (1, "b")
    assert audit([{"d": {"x": {"b": 1}}}, {"d": {"x": [1]}}]) == (0, "")
    assert audit([{"d": {"x": {}}}]) == (0, "")
    path.write_text("")
    assert rows_of(audit_inferred_keys(spark, str(path), "d.x")) == [("d.x", 0, "")]
