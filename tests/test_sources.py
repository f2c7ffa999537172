"""JSON in, tables out."""

import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from marketlens.plans.catalogue import (
    catalogue_cleaning_report,
    clean,
    with_age_flags,
    with_cleaned_columns,
)
from marketlens.plans.dirty_catalogue import nested_records, raw_catalogue, write_json_arrays
from marketlens.sources import (
    CATALOGUE_SCHEMA,
    RECORD_SCHEMA,
    audit_inferred_keys,
    describe_schema,
    flatten_struct,
    literal_rows,
    discard,
    materialise,
    preview,
    read_catalogue,
    row_count,
    shared_folder,
)


def record(appid, **data):
    base = {
        "appid": appid,
        "name": f"item {appid}",
        "publisher": "Acme®",
        "genre": "Action, Indie",
        "tags": {"Action": 10, "Gore": 3},
        "type": "game",
        "categories": ["Solo", "Co-op"],
        "owners": "0 .. 20,000",
        "positive": 9,
        "negative": 1,
        "price": "999",
        "initialprice": "1999",
        "discount": "50",
        "languages": "English, French",
        "platforms": {"windows": True, "mac": False, "linux": True},
        "release_date": "2020/06/8",
        "required_age": "MA 15+",
    }
    return {"id": str(appid), "data": {**base, **data}}


RECORDS = [
    record(1),
    record(2, tags=[], platforms={"windows": True}, release_date="2015/09", required_age="180"),
    record(3, tags={"Calm": 1}, price="0", positive=0, negative=0, genre="", publisher=" \t"),
    record(4, type="movie", price=None, discount="x"),
]


@pytest.fixture(params=["one line", "pretty"])
def array_file(request, tmp_path):
    path = tmp_path / "catalogue.json"
    path.write_text(json.dumps(RECORDS, indent=2 if request.param == "pretty" else None))
    return str(path)


def test_array_scan(spark, array_file):
    raw = read_catalogue(spark, array_file)
    assert raw.columns == ["id", *RECORD_SCHEMA.names]
    assert len(raw.columns) == 23
    assert raw.schema["tags"].dataType.simpleString() == "map<string,bigint>"
    rows = {row["appid"]: row for row in raw.collect()}
    assert len(rows) == 4
    assert rows[1]["tags"] == {"Action": 10, "Gore": 3}
    assert rows[1]["categories"] == ["Solo", "Co-op"]
    assert rows[1]["platforms"].asDict() == {"windows": True, "mac": False, "linux": True}
    # An empty JSON list where an object is declared reads as NULL; its siblings survive.
    assert rows[2]["tags"] is None and rows[2]["name"] == "item 2"
    assert rows[2]["platforms"].asDict() == {"windows": True, "mac": None, "linux": None}
    assert rows[3]["short_description"] is None


def test_lines_scan(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text("\n".join(json.dumps(r) for r in RECORDS))
    assert read_catalogue(spark, str(path), multi_line=False).count() == 4


def test_one_array_can_be_spread(spark, array_file):
    spread = read_catalogue(spark, array_file, spread=3)
    assert "RoundRobinPartitioning(3)" in spread._jdf.queryExecution().executedPlan().toString()
    assert sorted(row["appid"] for row in spread.collect()) == [1, 2, 3, 4]


def test_nested_records_stay_nested_on_request(spark, array_file):
    assert read_catalogue(spark, array_file, nested=None).schema == CATALOGUE_SCHEMA


def test_inference_invents_a_column_per_key(spark, tmp_path):
    path = tmp_path / "keyed.json"
    # With an empty list among the objects inference would fall back to string.
    path.write_text(json.dumps([r for r in RECORDS if r["data"]["tags"] != []]))
    audit = audit_inferred_keys(spark, str(path), "data.tags", first=2)
    assert rows_of(audit) == [("data.tags", 3, "Action, Calm")]


def test_inference_of_mixed_types_has_no_fields(spark, array_file):
    assert rows_of(audit_inferred_keys(spark, array_file, "data.tags")) == [("data.tags", 0, "")]


def test_clean_from_json(spark, array_file):
    games = {row["appid"]: row for row in clean(read_catalogue(spark, array_file)).collect()}
    assert sorted(games) == [1, 2, 3]
    first = games[1]
    assert len(first) == 47
    assert (first["price_usd"], first["initial_price_usd"]) == (9.99, 19.99)
    assert (first["discount_pct"], first["is_free"]) == (50, False)
    assert str(first["release_date_parsed"]) == "2020-06-08"
    assert (first["release_year"], first["release_month"]) == (2020, 6)
    assert (first["genres"], first["n_genres"]) == (["Action", "Indie"], 2)
    assert (first["languages_list"], first["n_languages"]) == (["English", "French"], 2)
    assert first["publisher_clean"] == "Acme"
    assert (first["owners_min"], first["owners_max"], first["owners_mid"]) == (0, 20000, 10000.0)
    assert first["age_rating"] == 15
    assert (first["reviews"], first["positive_ratio"]) == (10, 0.9)
    assert first["wilson_score"] == pytest.approx(0.5958, abs=1e-4)
    assert (first["windows"], first["mac"], first["linux"]) == (True, False, True)
    assert first["n_platforms"] == 2
    assert first["owners_x_price"] == pytest.approx(199900.0)
    assert games[2]["age_rating"] is None and games[2]["n_platforms"] is None
    assert games[3]["is_free"] is True and games[3]["publisher_clean"] is None
    assert games[3]["wilson_score"] is None and games[3]["genres"] == []


def test_flags_and_report_from_json(spark, array_file):
    raw = read_catalogue(spark, array_file)
    flagged = with_age_flags(clean(raw)).select("appid", "age_gated", "mature").orderBy("appid")
    assert rows_of(flagged) == [(1, False, True), (2, False, False), (3, False, False)]
    report = [(row["rows_in"], row["n"]) for row in catalogue_cleaning_report(with_cleaned_columns(raw)).collect()]
    assert report == [
        (3, n) for n in (1, 0, 0, 0, 0, 1, 0, 3, 0, 1, 1)
    ]


def test_round_trip_through_array_files(spark, sf_dir, tmp_path):
    tables = [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("part", "lineitem")]
    raw = raw_catalogue(*tables)
    path = str(tmp_path / "arrays")
    write_json_arrays(nested_records(raw), path, key="data.appid", per_file=64)
    back = read_catalogue(spark, path, recursiveFileLookup="true")
    assert back.schema.simpleString() == raw.schema.simpleString()
    assert len(list((tmp_path / "arrays").glob("chunk=*/*.txt"))) > 1

    def comparable(df):
        return df.withColumn("tags", F.to_json("tags"))

    assert comparable(back).exceptAll(comparable(raw)).count() == 0
    assert comparable(raw).exceptAll(comparable(back)).count() == 0


@pytest.mark.parametrize("how", ["table", "checkpoint", "cache"])
def test_materialise(spark, how):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    stored = materialise(df, f"stored_{how}", how)
    assert sorted(rows_of(stored)) == sorted(rows_of(df))


def test_materialised_frames_of_one_name_live_side_by_side(spark):
    first = materialise(spark.range(10), "same")
    second = materialise(spark.range(3).withColumn("extra", F.lit("x")), "same")
    assert first.count() == 10 and second.columns == ["id", "extra"] and second.count() == 3
    discard(first)
    assert not spark.catalog.tableExists(first.stored_as[0]) and second.count() == 3


def test_materialise_writes_to_the_shared_folder(spark):
    stored = materialise(spark.range(3), "placed")
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert all(folder in name for name in stored.inputFiles())


def test_materialise_rejects_unknown_ways(spark):
    with pytest.raises(ValueError):
        materialise(spark.range(1), "x", "elsewhere")


def test_preview_and_count(spark):
    df = spark.range(50)
    assert preview(df, 7).count() == 7
    assert preview(df).count() == 50
    assert rows_of(row_count(df)) == [(50,)]


def test_preview_keeps_nullable_integers(spark):
    df = literal_rows(spark, [(1,), (None,)], ["v"])
    assert sorted(rows_of(preview(df)), key=str) == [(1,), (None,)]
    assert preview(df).schema["v"].dataType.simpleString() == "bigint"


def test_describe_schema(spark):
    df = literal_rows(spark, [("a", 1), ("b", 2)], ["k", "v"])
    assert rows_of(describe_schema(df)) == [(1, "k", "string", 2), (2, "v", "bigint", 2)]


def test_flatten_struct_keeps_position(spark):
    df = spark.range(1).select("id", F.struct(F.lit(1).alias("a"), F.lit(2).alias("b")).alias("s"))
    flat = flatten_struct(df.withColumn("z", F.lit(3)), "s")
    assert flat.columns == ["id", "a", "b", "z"]
