import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from marketlens.llm.linededup import drop_repeated_lines

SPACE = " \t\n\x0b\x0c\r"


def plain(rows, least=20, docs=3):
    def key(line):
        line = line.strip(SPACE)
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(doc)
    common = {k: max(d for d in v if d is not None) for k, v in holders.items() if len(v) >= docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in common or common[key(x)] == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


LONG = "A line that Many Documents share"
ROWS = [
    (1, f"{LONG}\nown one\n{LONG}"), (2, f"  {LONG.lower()}\t\n\n"), (3, f"{LONG}\r\nlast"),
    (4, "x" * 19), (5, "x" * 19), (6, "x" * 19), (7, "É" * 20), (8, "É" * 20), (9, "é" * 20),
    (10, None), (11, ""), (12, "\n\n"), (13, f" {LONG}"), (14, "two docs hold this one line"),
    (14, "two docs hold this one line"), (15, "two docs hold this one line"),
    (16, "\n".join(f"{LONG} again {i}" for i in range(3000))),
    (17, "\n".join(f"{LONG} again {i}" for i in range(3000))),
    (18, "\n".join(f"{LONG} again {i}" for i in range(2999, -1, -1))),
]


def run(spark, rows):
    df = spark.createDataFrame([(*r, 5, "g") for r in rows],
                               "doc_id long, text string, n_lines int, _gone string")
    got = drop_repeated_lines(df)
    assert sorted(got.columns) == sorted(
        ["doc_id", "text", "_gone", "kept_text", "n_lines", "n_dropped"])
    return sorted((tuple(r) for r in got.select("doc_id", "kept_text", "n_lines", "n_dropped")
                   .collect()), key=str)


def test_matches_brute_force(spark):
    assert run(spark, ROWS) == plain(ROWS)


def test_null_ids_are_one_document(spark):
    rows = [(None, LONG), (None, LONG), (2, LONG), (3, LONG)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows[:3]) == plain(rows[:3])


def test_no_rows(spark):
    assert run(spark, []) == []


def test_thresholds(spark):
    df = spark.createDataFrame([(1, "ab\nc"), (2, "ab\nd")], "doc_id long, text string")
    got = drop_repeated_lines(df, min_chars=2, min_docs=2).orderBy("doc_id").collect()
    assert [r["kept_text"] for r in got] == ["c", "ab\nd"]


def test_plan_has_no_python(spark, sf_dir):
    plan = driver.queries()["op9_line_dedup"](spark, sf_dir)._jdf.queryExecution().toString()
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


@pytest.mark.parametrize("name", ["op1_topk", "op4_warc", "op9_line_dedup", "op10_embedding_dedup"])
def test_queries_match_their_statements(spark, duck, sf_dir, name):
    df = driver.queries()[name](spark, sf_dir)
    result = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(result.fetchall(), key=str)
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == expected


def test_pieces_of_plain_text_stay(spark):
    df = spark.createDataFrame([(1, "a\r\n\x85b c")], "doc_id long, text string")
    assert drop_repeated_lines(df).select(F.col("kept_text")).first()[0] == "a\r\n\x85b c"
