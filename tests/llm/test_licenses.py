import random
import re

import pytest

from marketlens.llm import terms
from marketlens.llm.licenses import (
    CONTAINMENT, PHRASES, TEMPLATES, Index, block_step, candidates, find_licenses, needed, split,
)

SCHEMA = "doc_id long, text string, labels int, score string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, templates=TEMPLATES, containment=CONTAINMENT):
    out = []
    for doc, text in rows:
        words = plain_words(text)
        places, base, blocks = [], set(), []
        for phrase, label in PHRASES:
            p = phrase.split()
            at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
            places += at
            base |= {label} if at else set()
        for label, template in templates:
            t = set(plain_words(template))
            step = block_step(len(plain_words(template)))
            for start in range(0, len(words), step):
                share = len(t & set(words[start:start + 2 * step])) / len(t)
                if share >= containment:
                    blocks.append((label, start, min(start + 2 * step, len(words)), share))
        out.append((
            doc, len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | {b[0] for b in blocks})),
            1.0 if base else max((b[3] for b in blocks), default=0.0),
            sorted(blocks, key=lambda b: (b[1], b[0], b[2], -b[3])),
        ))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], SCHEMA)
    got = find_licenses(df, **options).collect()
    return sorted(((*r[:8], [tuple(b) for b in r[8]]) for r in got), key=str)


def made(n, seed=2):
    pick = random.Random(seed)
    common = [w.decode() for _, t in TEMPLATES for w in split(t)] + "lorem ipsum dolor".split()
    rows = []
    for i in range(n):
        filler = [pick.choice(common) if pick.random() < 0.3 else f"w{pick.randrange(500)}"
                  for _ in range(pick.randrange(300))]
        for _ in range(pick.randrange(3)):
            notice = pick.choice(TEMPLATES)[1].split()
            for _ in range(pick.randrange(4)):
                notice[pick.randrange(len(notice))] = pick.choice(["", "changed"])
            at = pick.randrange(len(filler) + 1)
            filler[at:at] = notice
        rows.append((i, pick.choice([" ", "\n", " - "]).join(filler)))
    return rows


@pytest.mark.parametrize("containment", [0.5, 0.8, CONTAINMENT, 1.0])
def test_matches_brute_force(spark, containment):
    rows = made(80)
    assert run(spark, rows, containment=containment) == brute(rows, containment=containment)


def test_every_notice_is_found_wherever_it_stands(spark):
    rows = [(100 * k + i, "foo " * i + notice + " bar" * 40)
            for k, (_, notice) in enumerate(TEMPLATES) for i in range(0, 80, 7)]
    got = {r[0]: (r[6], r[7]) for r in run(spark, rows)}
    for k, (label, _) in enumerate(TEMPLATES):
        for i in range(0, 80, 7):
            labels, score = got[100 * k + i]
            assert label in labels.split(",") and score == 1.0


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n--"), (None, "the MIT License"), (4, "mit\x00license"),
            (4, "mit\x00license"), (5, "mit licenses, apache-license"), (6, "mit 字 license"),
            (7, "license " * 30 + "general public license general public license"),
            (8, "Licensed under CC BY-NC 4.0."), (9, "Licensed under CC BY-SA 4.0."),
            (10, "Released under the Apache License"), (11, "mitLicense MIT_LICENSE")]
    got = run(spark, rows)
    assert got == brute(rows)
    assert {r[0]: r[6] for r in got}[8] == "cc-by-nc"


def test_plain_prose_has_no_label(spark):
    rows = [(1, "You may use this copy of the work in any form and for any purpose, free of charge,"
                " subject to the terms under which it was published and the conditions above.")]
    assert run(spark, rows)[0][6:8] == ("", 0.0)


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, "some text")], templates=()) == brute([(1, "some text")], ())


def test_long_texts(spark, monkeypatch):
    rows = [(1, "word " * 50_000 + TEMPLATES[0][1] + " word" * 50_000)]
    assert run(spark, rows) == brute(rows)
    monkeypatch.setattr(terms, "SLICE", 500)
    index = Index.build(TEMPLATES, PHRASES, CONTAINMENT, {})
    text = rows[0][1].encode()
    sliced = index.ids(text)
    monkeypatch.setattr(terms, "SLICE", 1 << 22)
    assert sliced.tolist() == index.ids(text).tolist()


def test_filters_lose_nothing_and_pass_few():
    pick = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    templates = [(f"t{i}", " ".join(pick.sample(words, pick.randrange(1, 9)))) for i in range(40)]
    frequency = {w.encode(): pick.randrange(100) for w in words}
    index = Index.build(templates, (), 0.75, frequency)
    lists = {}
    for some in index.by_step.values():
        for token, found in some.items():
            lists.setdefault(token, []).extend(found)
    every = {id(t): t for found in lists.values() for t, _ in found}.values()
    assert len(every) == len(templates)
    passed = compared = 0
    for _ in range(300):
        block = sorted(pick.sample(range(len(index.rank)), pick.randrange(1, 14)))
        met = candidates(block, lists)
        true = [t for t in every if len(set(block) & set(t.tokens)) >= t.least]
        assert {id(t) for t in true} <= {id(t) for t in met}
        passed, compared = passed + len(met), compared + len(templates)
    assert passed < 0.2 * compared


def test_needed():
    assert [needed(n, 0.9) for n in (1, 5, 7, 10, 20)] == [1, 5, 7, 9, 18]
