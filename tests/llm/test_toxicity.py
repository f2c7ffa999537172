import itertools
import math
import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as driver
from marketlens.llm.toxicity import (
    Model, drop_toxic, fit, score_toxicity, token_labels, token_spans, train,
)


def plain_marginals(emissions, t):
    n, weight = len(emissions), {}
    for tags in itertools.product((0, 1), repeat=n):
        score = sum(e for e, y in zip(emissions, tags) if y)
        score += sum(t[a, b] for a, b in zip(tags, tags[1:]))
        weight[tags] = math.exp(score)
    total = sum(weight.values())
    return [sum(w for tags, w in weight.items() if tags[i]) / total for i in range(n)]


def test_marginals_match_all_taggings():
    rng = np.random.default_rng(0)
    model = Model()
    model.transition = rng.normal(size=(2, 2))
    lengths = np.array([3, 0, 1, 6, 2])
    emissions = rng.normal(size=lengths.sum()) * 2
    got, at = model.marginals(emissions, lengths), 0
    for n in lengths:
        expected = plain_marginals(emissions[at:at + n], model.transition)
        assert got[at:at + n] == pytest.approx(expected)
        at += n


def corpus(n=400, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeilnorst") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text, toxic = [rng.choice(words) for _ in range(rng.randrange(20, 80))], i % 4 == 0
        for _ in range(3 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(["Vile,", "foul", "nasty!", "gross"]))
        docs.append((i, " ".join(text), "label=1"))
        labels.append((i, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_learned_spans_scores_and_odd_rows(spark):
    docs, labels = corpus()
    odd = [(None, "plain words"), (900, None), (901, ""), (901, ""), (902, "a foul word"),
           (903, "ok " * 120_000 + "vile foul nasty gross vile foul nasty gross")]
    train_docs, given = frames(spark, docs, labels + [(None, 1), (5, None), (77, 0)])
    model = train(train_docs, given)
    df, _ = frames(spark, docs + [(*o, "s") for o in odd], labels)
    rows = score_toxicity(df, model).collect()
    assert len(rows) == len(docs) + len(odd)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    truth = dict(labels)
    held = [r for r in rows if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 50
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    by = {r["doc_id"]: r for r in rows}
    assert [tuple(s) for s in by[902]["spans"]] == [(2, 6)]
    assert len(by[903]["spans"]) == 8 and by[900]["spans"] == [] and by[901]["predicted"] == 0
    kept = drop_toxic(df, model)
    assert kept.columns == df.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(
        str(r["doc_id"]) for r in rows if not r["predicted"])


def test_without_labels_or_rows(spark):
    docs, labels = corpus(20)
    df, given = frames(spark, docs, labels)
    assert all(r["predicted"] == 0 for r in score_toxicity(df, train(df, given.limit(0))).collect())
    model = train(df.limit(0), given)
    assert score_toxicity(df.limit(0), model).collect() == []
    assert drop_toxic(df.limit(0), model).collect() == []


def test_offsets_of_repeated_tokens():
    text = "ab a ab\n😀ab ab"
    spans = token_spans(text, np.array([2, 4]))
    assert [text[s["start"]:s["end"]] for s in spans] == ["ab", "ab"]
    assert [s["start"] for s in spans] == [5, 12]


def test_query_on_the_held_out_fold(spark, sf_dir):
    rows = driver.queries()["op6_toxicity"](spark, sf_dir).collect()
    labels = dict(map(tuple, spark.read.parquet(f"{sf_dir}/labels.parquet")
                      .select("doc_id", "toxic").collect()))
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    known = [r for r in rows if r["doc_id"] in labels]
    clean = [r["predicted"] for r in known if not labels[r["doc_id"]]]
    assert sum(clean) <= 0.02 * len(clean)


@pytest.mark.parametrize("phrase", ["you vile", "vile", "you utter vile scum"])
def test_fixed_phrases_and_first_words_mark_tokens(phrase):
    """The insult always follows the same word, or starts its documents."""
    rng = random.Random(1)
    common = [f"word{i}" for i in range(300)] + ["you", "utter"]
    texts, toxic = [], []
    for i in range(400):
        words, bad = rng.sample(common, 30), i % 4 == 0
        at = 0 if phrase == "vile" else rng.randrange(30)
        texts.append(words[:at] + phrase.split() * bad + words[at:])
        toxic.append(int(bad))
    tags = token_labels(texts, toxic)
    assert all("vile" in np.array(t)[tag] for t, tag, y in zip(texts, tags, toxic) if y)
    model = fit([" ".join(t) for t in texts], toxic)
    emissions = np.array([model.emission(w) for t in texts for w in t])
    lengths = np.array([len(t) for t in texts])
    scores = model.scores(model.marginals(emissions, lengths), lengths)
    assert [int(s >= 0.5) for s in scores] == toxic


def test_copies_of_one_toxic_text_mark_nothing():
    rng = random.Random(2)
    clean = [[f"word{rng.randrange(300)}" for _ in range(30)] for _ in range(200)]
    copy = [f"other{i}" for i in range(30)]
    tags = token_labels(clean + [copy] * 60, [0] * 200 + [1] * 60)
    assert not any(t.any() for t in tags)


def test_query_recall_on_the_held_out_fold(spark, sf_dir):
    """Nearly all toxic documents with an insult, most of the others: those hold no such word."""
    folder = f"{sf_dir}/../sf0.1"
    rows = driver.queries()["op6_toxicity"](spark, folder).select("doc_id", "held_out", "predicted")
    given = spark.read.parquet(f"{folder}/labels.parquet").filter("toxic = 1").select("doc_id")
    insult = "(?i)clown|disgusting|idiot|loser|moron|pathetic|scum|stupid|trash|worthless"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    told = docs.select("doc_id", docs["text"].rlike(insult).alias("insult"))
    found = rows.filter("held_out").join(given.distinct(), "doc_id").join(told, "doc_id").collect()
    plain = [r["predicted"] for r in found if r["insult"]]
    assert len(plain) >= 50 and sum(plain) >= 0.95 * len(plain)
    assert sum(r["predicted"] for r in found) >= 0.8 * len(found)
