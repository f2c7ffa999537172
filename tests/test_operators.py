"""Operators against plain Python on small frames, hot groups included."""

import math
import random
from collections import Counter, defaultdict

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from marketlens import operators as ops
from marketlens.functions import LIST_LENGTH_BANDS, PRICE_BANDS, Bands


def half_up(value, digits):
    """Round half up on the decimal text, as Spark does."""
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def median(values):
    return sorted(values)[math.ceil(0.5 * len(values)) - 1]


@pytest.fixture(scope="module")
def catalogue():
    """3,000 entities; one group and one label each hold a third of them."""
    draw = random.Random(3)
    entities = []
    for i in range(3000):
        hot = draw.random() < 1 / 3
        group = "hot" if hot else draw.choice([None, f"solo {i}", f"g{draw.randrange(200)}"])
        labels = draw.sample(["a", "b", "c", "d", "e"], draw.randrange(4))
        labels += ["top"] if draw.random() < 1 / 3 else []
        good, bad = draw.randrange(40), draw.randrange(8)
        entities.append(
            {
                "id": i,
                "grp": group,
                "labels": labels,
                "year": draw.choice([2017, 2022, 2020, None]),
                "good": good,
                "bad": bad,
                "ratio": good / (good + bad) if good + bad else None,
                "free": draw.random() < 0.2,
                "price": round(draw.random() * 60, 2),
                "off": draw.choice([0, 0, 0, 25, 50, 75]),
                "mac": draw.random() < 0.3,
                "linux": draw.random() < 0.1,
            }
        )
    return entities


@pytest.fixture(scope="module")
def df(spark, catalogue):
    schema = (
        "id long, grp string, labels array<string>, year int, good long, bad long, ratio double,"
        " free boolean, price double, off int, mac boolean, linux boolean"
    )
    rows = [tuple(entity.values()) for entity in catalogue]
    return spark.createDataFrame(rows, schema).repartition(6)


@pytest.fixture(scope="module")
def facts(df):
    return ops.explode_labels(df, "labels", "label")


def exploded(catalogue):
    return [(entity, label) for entity in catalogue for label in entity["labels"]]


def test_explode_labels(catalogue, facts):
    assert facts.count() == sum(len(entity["labels"]) for entity in catalogue)
    assert facts.columns[-1] == "label" and "id" in facts.columns


def test_explode_keeps_only_named_columns(df):
    assert ops.explode_labels(df, "labels", "label", keep=["id"]).columns == ["id", "label"]


def test_explode_replaces_a_clashing_column(spark):
    clash = spark.createDataFrame(
        [("a,b", ["a", "b"]), ("", []), (None, None)], "genre string, genres array<string>"
    )
    opened = ops.explode_labels(clash, "genres", "genre")
    assert opened.columns == ["genres", "genre"]
    assert [row[1] for row in rows_of(opened)] == ["a", "b"]


def test_explode_keeps_null_labels_as_explode_does(spark):
    odd = spark.createDataFrame([(1, ["a", None]), (2, None)], "id int, ls array<string>")
    assert rows_of(ops.explode_labels(odd, "ls", "l", keep=["id"])) == [(1, "a"), (1, None)]


def test_open_map(spark):
    maps = spark.createDataFrame(
        [("x", {"p": 3, "q": 9, "r": 9}), ("y", {}), ("z", None)], "name string, m map<string, int>"
    )
    assert rows_of(ops.open_map(maps, "m", keep=["name"], k=2)) == [("x", "q", 9), ("x", "r", 9)]
    assert ops.open_map(maps, "m", keep=["name"]).count() == 3


def test_group_sizes(catalogue, df):
    expected = Counter(e["grp"] for e in catalogue if e["grp"] is not None)
    assert dict(rows_of(ops.group_sizes(df, "grp"))) == expected


def test_concentration(catalogue, df):
    sizes = Counter(e["grp"] for e in catalogue if e["grp"] is not None)
    names = ["1 game", "2-5 games", "6-20 games", "21+ games"]
    band = lambda n: names[0 if n == 1 else 1 if n <= 5 else 2 if n <= 20 else 3]
    groups, games = Counter(), Counter()
    for size in sizes.values():
        groups[band(size)] += 1
        games[band(size)] += size
    games["no publisher"] = sum(e["grp"] is None for e in catalogue)
    expected = {
        name: (groups[name], games[name], half_up(100 * games[name] / len(catalogue), 1))
        for name in games
    }
    expected["all"] = (len(sizes), len(catalogue), 100.0)
    result = rows_of(ops.concentration(df, "grp"))
    assert {row[0]: row[1:] for row in result} == expected
    # Bands by ascending number of groups, then the residual row, then the total.
    assert [row[0] for row in result[-2:]] == ["no publisher", "all"]
    assert [row[1] for row in result[:-2]] == sorted(row[1] for row in result[:-2])


def test_concentration_without_residual(spark):
    keyed = spark.createDataFrame([("a",), ("a",), ("b",)], "grp string")
    result = [row[0] for row in rows_of(ops.concentration(keyed, "grp"))]
    assert "no publisher" not in result and result[-1] == "all"


def test_top_k_breaks_ties(spark):
    ties = spark.createDataFrame([(i, 1) for i in range(50)], "id int, n int").repartition(7)
    assert rows_of(ops.top_k(ties, [F.desc("n"), F.asc("id")], 3)) == [(0, 1), (1, 1), (2, 1)]


def test_favourite_labels(catalogue, df, facts):
    sizes = Counter(e["grp"] for e in catalogue if e["grp"] is not None)
    leaders = sorted(sizes, key=lambda g: (-sizes[g], g))[:8]
    expected = []
    for group in sorted(leaders):
        counts = Counter(label for e, label in exploded(catalogue) if e["grp"] == group)
        for label in sorted(counts, key=lambda x: (-counts[x], x))[:3]:
            share = half_up(100 * counts[label] / sizes[group], 1)
            expected.append((group, label, counts[label], sizes[group], share))
    leaders = ops.largest_groups(ops.group_sizes(df, "grp"), "grp", total="publisher_games")
    rows = ops.members_of_leaders(facts, leaders, "grp")
    assert rows_of(ops.favourite_labels(rows, "grp", "label")) == expected
    weighted = rows.groupBy("grp", "publisher_games", "label", "year").agg(F.count("*").alias("w"))
    assert rows_of(ops.favourite_labels(weighted, "grp", "label", weight="w")) == expected


def test_keep_members(df, catalogue):
    leaders = ops.largest_groups(ops.group_sizes(df, "grp"), "grp", k=1)
    kept = ops.keep_members(df, leaders, "grp")
    assert kept.count() == sum(e["grp"] == "hot" for e in catalogue)
    assert kept.columns[0] == "grp" and len(kept.columns) == len(df.columns)


def test_label_prevalence(catalogue, df):
    counts = Counter(label for _, label in exploded(catalogue))
    expected = [
        (label, counts[label], half_up(100 * counts[label] / len(catalogue), 1))
        for label in sorted(counts, key=lambda x: (-counts[x], x))
    ]
    assert rows_of(ops.label_prevalence(df, "labels", "label")) == expected
    assert rows_of(ops.label_prevalence(df, "labels", "label", k=2)) == expected[:2]
    assert rows_of(ops.label_prevalence(df, "labels", "label", k=None)) == expected


def test_median_vs_pooled(catalogue, facts):
    rows = defaultdict(list)
    for entity, label in exploded(catalogue):
        rows[label].append(entity)
    result = rows_of(
        ops.median_vs_pooled(
            facts, "label", ratio="ratio", positive="good", negative="bad", min_rows=600
        )
    )
    kept = {label: es for label, es in rows.items() if len(es) >= 600}
    assert {row[0] for row in result} == set(kept)
    for label, games, middle, pooled in result:
        members = kept[label]
        assert games == len(members)
        ratios = [e["ratio"] for e in members if e["ratio"] is not None]
        assert middle == pytest.approx(half_up(median(ratios), 3), abs=1e-12)
        good, bad = sum(e["good"] for e in members), sum(e["bad"] for e in members)
        assert pooled == half_up(good / (good + bad), 3)
    medians = [row[2] for row in result]
    assert medians == sorted(medians, reverse=True)


def test_grouped_medians_edges(spark):
    """Even sizes take the lower median; NULL values and empty populations have none."""
    df = spark.createDataFrame(
        [("a", 0.1, True), ("a", 0.2, False), ("a", 0.3, False), ("a", 0.4, True), ("a", None, True)]
        + [("b", None, True), ("c", 0.5, False)],
        "k string, v double, m boolean",
    )
    medians = ops.grouped_medians(
        df, "k", "v", 3, {"n": ("med", None), "members": ("member_med", F.col("m"))}, {"s": "v"}
    )
    result = {row["k"]: tuple(row)[1:] for row in medians.collect()}
    assert result["a"] == (5, 3, pytest.approx(1.0), 0.2, 0.1)
    assert result["b"] == (1, 1, None, None, None)
    assert result["c"] == (1, 0, 0.5, 0.5, None)


def test_nan_sorts_last_in_medians(spark):
    nan = float("nan")
    rows = [("a", 0.5), ("a", 1.0), ("a", nan), ("b", nan), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {r["k"]: r["med"] for r in ops.grouped_medians(df, "k", "v", 3, {"n": ("med", None)}).collect()}
    assert found["a"] == 1.0
    assert found["c"] is None
    assert math.isnan(found["b"])


@pytest.mark.parametrize("p", [(0.5, "median_paid"), (0.9, "p90"), (0.99, "p99")])
def test_quantiles_of_a_summary(spark, p):
    draw = random.Random(11)
    values = [draw.random() * 1e9 for _ in range(3001)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    exact = sorted(values)[math.ceil(p[0] * len(values)) - 1]
    assert ops.distribution_summary(df, "v").first()[p[1]] == pytest.approx(round(exact, 2))


def test_total_row(spark):
    counts = spark.createDataFrame([("x", 2), ("y", 3)], "k string, n long")
    assert sorted(rows_of(ops.with_total_row(counts, "k", "n"))) == [("all", 5), ("x", 2), ("y", 3)]
    assert rows_of(ops.with_total_row(counts.limit(0), "k", "n")) == [("all", 0)]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 101, 1000])
def test_grouped_median_of_a_hot_group(spark, size):
    draw = random.Random(size)
    values = [draw.random() for _ in range(size)]
    df = spark.createDataFrame([("hot", v) for v in values], "k string, v double").repartition(4)
    row = ops.grouped_medians(df, "k", "v", 3, {"n": ("med", None)}).first()
    assert (row["n"], row["med"]) == (size, half_up(median(values), 3))


def test_cohort_by_label(catalogue, facts):
    result = {row[0]: row[1:] for row in rows_of(
        ops.cohort_by_label(facts, "label", F.col("grp") == "hot", "ratio")
    )}
    for label, (members, games, _) in result.items():
        hits = [e for e, name in exploded(catalogue) if name == label]
        assert games == len(hits)
        assert members == sum(e["grp"] == "hot" for e in hits)


def test_cohort_by_label_drops_labels_without_members(facts):
    assert ops.cohort_by_label(facts, "label", F.col("grp") == "nobody", "ratio").count() == 0


def test_cohort_vs_market(catalogue, df):
    bands = Bands((10, 20), ("few", "some", "many"))
    scored = df.withColumn("reviews", F.col("good") + F.col("bad"))
    result = rows_of(
        ops.cohort_vs_market(scored, "reviews", F.col("grp") == "hot", "ratio", bands=bands)
    )
    assert [row[0] for row in result] == ["few", "some", "many"]
    limits = {"few": (1, 9), "some": (10, 19), "many": (20, 10**9)}
    for band, games, middle, members, member_middle in result:
        low, high = limits[band]
        market = [e for e in catalogue if low <= e["good"] + e["bad"] <= high]
        cohort = [e for e in market if e["grp"] == "hot"]
        assert (games, members) == (len(market), len(cohort))
        assert middle == pytest.approx(half_up(median([e["ratio"] for e in market]), 3))
        assert member_middle == pytest.approx(half_up(median([e["ratio"] for e in cohort]), 3))


def test_mix_shift(catalogue, facts):
    counts = Counter((e["year"], label) for e, label in exploded(catalogue))
    totals = {y: sum(n for (year, _), n in counts.items() if year == y) for y in (2017, 2022)}
    result = rows_of(ops.mix_shift(facts, "year", (2017, 2022), "label"))
    assert len(result) == 6
    for label, early, late, shift in result:
        assert early == half_up(100 * counts[2017, label] / totals[2017], 1)
        assert late == half_up(100 * counts[2022, label] / totals[2022], 1)
        assert shift == half_up(late - early, 1)
    assert sum(row[1] for row in result) == pytest.approx(100, abs=0.5)
    assert [row[2] for row in result] == sorted((row[2] for row in result), reverse=True)


def test_mix_shift_with_a_label_in_one_period_only(spark):
    facts = spark.createDataFrame(
        [(2017, "old"), (2017, "both"), (2022, "both"), (2022, "new"), (2022, "new")],
        "year int, label string",
    )
    assert rows_of(ops.mix_shift(facts, "year", (2017, 2022), "label")) == [
        ("new", None, 66.7, None),
        ("both", 50.0, 33.3, -16.7),
        ("old", 50.0, None, None),
    ]


def test_band_shares(catalogue, df):
    result = rows_of(ops.band_shares(df, "price", PRICE_BANDS, first=F.col("free")))
    assert [row[0] for row in result] == ["free", "under $5", "$5-10", "$10-20", "$20-40", "$40+"]
    assert sum(row[1] for row in result) == len(catalogue)
    assert result[0][1] == sum(e["free"] for e in catalogue)
    for _, games, share in result:
        assert share == half_up(100 * games / len(catalogue), 1)


def test_empty_bands_give_no_row(spark):
    df = spark.createDataFrame([(1,), (25,)], "n int")
    assert rows_of(ops.band_shares(df, "n", LIST_LENGTH_BANDS)) == [("1", 1, 50.0), ("21+", 1, 50.0)]


def test_conditional_rate_by_band(catalogue, df):
    result = rows_of(
        ops.conditional_rate_by_band(
            df, "price", PRICE_BANDS, F.col("off") > 0, "off", first=F.col("free")
        )
    )
    free = [e for e in catalogue if e["free"]]
    cut = [e["off"] for e in free if e["off"] > 0]
    assert result[0][:3] == ("free", len(free), len(cut))
    assert result[0][3] == half_up(100 * (len(cut) / len(free)), 1)
    assert result[0][4] == half_up(sum(cut) / len(cut), 1)


def test_discount_summary(catalogue, df):
    cut = [e["off"] for e in catalogue if e["off"] > 0]
    assert rows_of(ops.discount_summary(df, "off")) == [
        (
            len(cut),
            half_up(100 * len(cut) / len(catalogue), 1),
            half_up(sum(cut) / len(cut), 1),
            median(cut),
        )
    ]


def test_discount_summary_of_an_empty_catalogue(df):
    empty = df.filter("id < 0")
    assert rows_of(ops.discount_summary(empty, "off")) == [(0, None, None, None)]


def test_distribution_summary(catalogue, df):
    paid = sorted(e["price"] for e in catalogue if not e["free"])
    row = ops.distribution_summary(df.filter(~F.col("free")), "price").first()
    n = len(paid)
    mean = sum(round(100 * p) for p in paid) / 100 / n
    deviation = math.sqrt(sum((p - mean) ** 2 for p in paid) / (n - 1))
    expected = (
        paid[0],
        paid[math.ceil(0.5 * n) - 1],
        half_up(mean, 2),
        half_up(deviation, 2),
        paid[math.ceil(0.9 * n) - 1],
        paid[math.ceil(0.99 * n) - 1],
        paid[-1],
    )
    assert tuple(row) == pytest.approx(expected)


def test_flag_rates_by_band(catalogue, df):
    bands = Bands((10,), ("low", "high"))
    flags = {"mac": ("mac", "pct_mac"), "linux": ("any_linux", "pct_linux")}
    result = ops.flag_rates_by_band(df, "price", bands, flags, band="level")
    assert result.columns == ["level", "games", "mac", "pct_mac", "any_linux", "pct_linux"]
    low = [e for e in catalogue if e["price"] < 10]
    macs = sum(e["mac"] for e in low)
    assert rows_of(result)[0][:4] == ("low", len(low), macs, half_up(100 * (macs / len(low)), 1))


def test_flag_reach_and_combinations(catalogue, df):
    flags = ["mac", "linux"]
    counts = Counter((e["mac"], e["linux"]) for e in catalogue)
    assert rows_of(ops.flag_reach(df, flags)) == [
        (len(catalogue), sum(e["mac"] for e in catalogue), sum(e["linux"] for e in catalogue))
    ]
    result = rows_of(ops.flag_combinations(df, flags))
    assert {row[:2]: row[2] for row in result} == counts
    assert [row[2] for row in result] == sorted(counts.values(), reverse=True)


def test_flag_rate_by_label(catalogue, facts):
    result = rows_of(ops.flag_rate_by_label(facts, "label", ["mac", "linux"], min_rows=800))
    sizes = Counter(label for _, label in exploded(catalogue))
    assert {row[0] for row in result} == {name for name, n in sizes.items() if n >= 800}
    assert [row[2] for row in result] == sorted((row[2] for row in result), reverse=True)


def test_value_by_label_identity(catalogue, facts):
    """The mean over all rows is the paid mean scaled by the paid share when free rows cost 0."""
    priced = facts.withColumn("price", F.when(F.col("free"), 0.0).otherwise(F.col("price")))
    valued = priced.withColumn("value", F.col("price") * 10000.5)
    result = ops.value_by_label(
        valued, "label", paid=~F.col("free"), price="price", value="value", min_rows=1
    )
    for _, games, paid, mean_all, mean_paid, value_all, value_paid in rows_of(result):
        assert mean_all == pytest.approx(mean_paid * paid / games, abs=0.011)
        assert value_all == pytest.approx(value_paid * paid / games, abs=0.011)


def test_value_by_label_without_paid_rows(spark):
    free = spark.createDataFrame([("a", 0.0, 0.0)], "label string, price double, value double")
    result = ops.value_by_label(
        free, "label", paid=F.col("price") > 0, price="price", value="value", min_rows=1
    )
    assert rows_of(result) == [("a", 1, 0, 0.0, None, 0.0, None)]


def test_calendar_counts(catalogue, df):
    years = Counter(e["year"] for e in catalogue if e["year"])
    assert rows_of(ops.calendar_counts(df, "year")) == sorted(years.items())
    recent = ops.calendar_counts(df, "year", within=F.col("year").between(2018, 2022))
    assert rows_of(recent) == [(y, years[y]) for y in (2020, 2022)]


def test_key_audit(spark):
    keyed = spark.createDataFrame(
        [("1", 1), ("2", 2), ("x", 2), (None, 3)], "id string, appid long"
    )
    assert rows_of(ops.key_audit(keyed, "appid", mirror="id")) == [(4, 3, 1)]
    assert rows_of(ops.key_audit(keyed, "appid")) == [(4, 3)]


def test_value_census(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "v string")
    assert rows_of(ops.value_census(df, ["v"])) == [("a", 2), ("b", 1), (None, 1)]
    assert rows_of(ops.value_census(df, ["v"], k=1)) == [("a", 2)]


def test_spelling_census(spark):
    df = spark.createDataFrame([("A",), ("A ",), ("",), (None,), ("B",), ("B",)], "v string")
    cleaned = F.nullif(F.trim("v"), F.lit(""))
    assert rows_of(ops.spelling_census(df, "v", cleaned)) == [(5, 3)]


def test_cleaning_report_counts_null_scope_as_dropped(spark):
    df = spark.createDataFrame([("g", 1), ("g", None), (None, None), ("h", 2)], "t string, v int")
    rules = [
        ops.Rule("scope", "dropped"),
        ops.Rule("v", "missing", F.col("v").isNull()),
        ops.Rule("v2", "unknown predicate is not a hit", F.col("v") > 5),
    ]
    assert rows_of(ops.cleaning_report(df, F.col("t") == "g", rules)) == [
        ("scope", 2, "dropped", 2),
        ("v", 2, "missing", 1),
        ("v2", 2, "unknown predicate is not a hit", 0),
    ]


def test_scope_filter(spark):
    df = spark.createDataFrame([("g",), ("h",), (None,)], "t string")
    assert rows_of(ops.scope_filter(df, "t", "g")) == [("g",)]


def test_perfect_scores(spark):
    df = spark.createDataFrame(
        [(1, 5, 1.0), (2, 1, 1.0), (3, 1, 1.0), (4, 9, 0.5), (5, 0, None)],
        "id int, n int, ratio double",
    )
    assert rows_of(ops.perfect_score_count(df, "ratio")) == [(3,)]
    assert rows_of(ops.perfect_score_examples(df, "ratio", "n", "id", ["id"], k=2)) == [(2,), (3,)]


def test_best_rated(spark):
    df = spark.createDataFrame(
        [(1, 0.91234, 0.51234), (2, 1.0, None), (3, 0.8, 0.7)], "id int, ratio double, score double"
    )
    best = ops.best_rated(df, score="score", ratio="ratio", key="id", columns=["id", "ratio", "score"])
    assert rows_of(best) == [(3, 0.8, 0.7), (1, 0.9123, 0.5123), (2, 1.0, None)]


def test_threshold_counts(spark):
    df = spark.createDataFrame([(0,), (7,), (18,), (None,)], "age int")
    age = F.col("age")
    counts = ops.threshold_counts(df, {"zero": age == 0, "adult": age >= 16, "none": age.isNull()})
    assert rows_of(counts) == [(1, 1, 1, 4)]
