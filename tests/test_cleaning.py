"""Every rule against the dirty shapes it exists for."""

import datetime
import random
import re

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from marketlens.functions import (
    cents_to_units,
    flags_from_struct,
    is_integer_text,
    json_to_map,
    normalise_name,
    parse_bounded_int,
    parse_bracket,
    parse_date_shapes,
    split_list,
)


def apply(spark, values, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    result = rows_of(df.orderBy("i").select(*[c.alias(f"c{n}") for n, c in enumerate(columns)]))
    return [row[0] if len(columns) == 1 else row for row in result]


def test_dates(spark):
    cases = {
        "2020/06/18": datetime.date(2020, 6, 18),
        "2020/06/8": datetime.date(2020, 6, 8),
        "2020/6/8": datetime.date(2020, 6, 8),
        "2015/09": datetime.date(2015, 9, 1),
        "2015/9": datetime.date(2015, 9, 1),
        "": None,
        None: None,
        "2020/06/31": None,
        "2020/13": None,
        "2020-06-18": None,
        "18 Jun, 2020": None,
        " 2020/06/18": None,
    }
    parsed = apply(spark, list(cases), parse_date_shapes("v"))
    assert dict(zip(cases, parsed)) == cases


def test_date_parts_of_missing_days(spark):
    day = parse_date_shapes("v")
    assert apply(spark, ["2015/09", ""], F.year(day), F.month(day)) == [(2015, 9), (None, None)]


@pytest.mark.parametrize(
    "text, labels",
    [
        ("English (full audio), French", ["English", "French"]),
        ("English;", ["English"]),
        ("English*", ["English"]),
        ("English,English", ["English"]),
        ("B,A,B,C,A", ["B", "A", "C"]),
        ("Spanish - Spain, Design & Illustration", ["Spanish - Spain", "Design & Illustration"]),
        ("", []),
        ("   ", []),
        (",, ,", []),
        ("(note)", []),
        ("A (x, y), B", ["A", "B"]),
        ("A (open, B", ["A (open", "B"]),
        ("  A  ,  B  ", ["A", "B"]),
        ("A\t, B", ["A\t", "B"]),
        (None, None),
    ],
)
def test_split_list(spark, text, labels):
    assert apply(spark, [text], split_list("v")) == [labels]


def test_split_list_other_separator(spark):
    assert apply(spark, ["a | b|c, d"], split_list("v", separator="|")) == [["a", "b", "c, d"]]


def test_list_sizes(spark):
    assert apply(spark, ["", "a,b,a"], F.size(split_list("v"))) == [0, 2]


def test_names(spark):
    cases = {
        "Acme\t\t\t\t": "Acme",
        "Acme®": "Acme",
        "Acme™ Games ®": "Acme Games",
        "  Acme \n  Games ": "Acme Games",
        "   ": None,
        "": None,
        "®": None,
        None: None,
        "Team17, NEXT Studios": "Team17, NEXT Studios",
        "Foo Co., Ltd.": "Foo Co., Ltd.",
    }
    assert dict(zip(cases, apply(spark, list(cases), normalise_name("v")))) == cases


def test_brackets(spark):
    cases = {
        "0 .. 20,000": (0, 20000, 10000.0),
        "10,000,000 .. 20,000,000": (10000000, 20000000, 15000000.0),
        "5..6": (5, 6, 5.5),
        "": (None, None, None),
        "unknown": (None, None, None),
        "7": (7, None, None),
        None: (None, None, None),
        "99999999999999999999 .. 1": (None, 1, None),
    }
    assert dict(zip(cases, apply(spark, list(cases), *parse_bracket("v")))) == cases


def test_bounded_integers(spark):
    cases = {
        "0": 0,
        "21+": 21,
        "7+": 7,
        "MA 15+": 15,
        "16 or 18": 16,
        "35": None,
        "180": None,
        "": None,
        "none": None,
        "99999999999": None,
        None: None,
    }
    assert dict(zip(cases, apply(spark, list(cases), parse_bounded_int("v", 0, 21)))) == cases


def test_money(spark):
    cases = {"999": 9.99, "0": 0.0, "-5": -0.05, "abc": None, "": None, None: None, "9.5": None}
    assert dict(zip(cases, apply(spark, list(cases), cents_to_units("v")))) == cases


def test_integer_text(spark):
    cases = {"999": True, "-1": True, "1.5": False, "": False, "x": False, None: None}
    assert dict(zip(cases, apply(spark, list(cases), is_integer_text("v")))) == cases


def test_json_map(spark):
    values = ['{"a": 1, "b": 2}', "{}", "[]", "not json", None]
    maps = apply(spark, values, json_to_map("v"))
    assert maps[0] == {"a": 1, "b": 2}
    assert maps[1] == {}
    assert maps[3:] == [None, None]


def test_struct_flags(spark):
    df = spark.createDataFrame(
        [((True, False, True),), ((False, False, False),), ((True, None, True),), (None,)],
        "p struct<windows: boolean, mac: boolean, linux: boolean>",
    )
    flags = flags_from_struct("p", ["windows", "mac", "linux"], "n")
    assert rows_of(df.withColumns(flags).drop("p")) == [
        (True, False, True, 2),
        (False, False, False, 0),
        (True, None, True, None),
        (None, None, None, None),
    ]


def random_texts(alphabet, seed, n=1500):
    draw = random.Random(seed)
    return ["".join(draw.choices(alphabet, k=draw.randrange(14))) for _ in range(n)]


def test_split_list_on_random_text(spark):
    def model(text):
        pieces = re.sub(r"\([^)]*\)|[;*]", "", text).split(",")
        return list(dict.fromkeys(p for p in (piece.strip(" ") for piece in pieces) if p))

    texts = random_texts(" ,,();*aB\t", 1)
    assert apply(spark, texts, split_list("v")) == [model(text) for text in texts]


def test_normalise_name_on_random_text(spark):
    def model(text):
        squeezed = re.sub(r"\s+", " ", re.sub("[®™]", "", text), flags=re.ASCII).strip(" ")
        return squeezed or None

    texts = random_texts(" \t\n®™aB,\u00a0", 2)
    assert apply(spark, texts, normalise_name("v")) == [model(text) for text in texts]


def test_numbers_on_random_text(spark):
    def bounded(text):
        match = re.search(r"(\d+)", text)
        return int(match[1]) if match and int(match[1]) <= 21 else None

    def bracket(text):
        digits = text.replace(",", "")
        low, high = re.match(r"(\d+)", digits), re.search(r"\.\.\s*(\d+)$", digits)
        low, high = (int(m[1]) if m else None for m in (low, high))
        return low, high, None if low is None or high is None else (low + high) / 2

    texts = random_texts("0123 .,,+..", 3)
    parsed = apply(spark, texts, parse_bounded_int("v", 0, 21), *parse_bracket("v"))
    assert parsed == [(bounded(text), *bracket(text)) for text in texts]
