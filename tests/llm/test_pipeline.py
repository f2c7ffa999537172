import zlib
from collections import Counter

import numpy as np
from test_components import plain_components
from test_linededup import plain as plain_lines
from test_mixing import plain_targets, size_of
from test_packing import assert_gapless, plain_pieces
from test_simhash import plain_fingerprint
from test_toxicity import corpus
from tokenizers import Tokenizer

import corpus_pipeline
from marketlens.llm.queries import tokenizer_path
from marketlens.llm.toxicity import fit

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_toxicity(rows, labels):
    texts = {r[0]: r[1] for r in rows}
    given = [(i, y) for i, y in sorted(labels) if zlib.crc32(str(i).encode()) % 5]
    model = fit([texts[i] for i, _ in given], [y for _, y in given])
    kept = []
    for row in rows:
        words = row[1].split()
        n = np.array([len(words)])
        marginals = model.marginals(np.array([model.emission(w) for w in words]), n)
        kept += [row] * int(model.scores(marginals, n)[0] < 0.5)
    return kept


def plain_simhash(rows):
    marks = {r[0]: plain_fingerprint(r[1]) for r in rows}
    values = sorted(set(marks.values()))
    root = plain_components((a, b) for i, a in enumerate(values) for b in values[i:]
                            if (a ^ b).bit_count() <= 3)
    least = {}
    for doc in sorted(marks):
        least.setdefault(root[marks[doc]], doc)
    return [r for r in rows if r[0] in least.values()]


def test_every_stage_against_a_plain_version(spark, tmp_path):
    """Each stage on what the one before gave, with shared lines, copies and toxic documents."""
    docs, labels = corpus()
    line = "A line that many of the documents share"
    rows = [(i, f"{line}\n{t}" if i % 7 == 0 else t, "en", "abc"[i % 3]) for i, t, _ in docs]
    rows += [(1000 + i, rows[i][1], "en", "abc"[i % 2]) for i in range(1, 60, 2)]
    rows = sorted((*r, len(r[1])) for r in rows)
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash", "mixing", "packing"]

    def run(name, rows):
        df = spark.createDataFrame(rows, COLUMNS)
        out = stages[name](spark, df, str(tmp_path))
        assert name == "packing" or out.columns == df.columns
        return out.collect() if name == "packing" else sorted(map(tuple, out.collect()))

    clean = run("toxicity", rows)
    assert clean == plain_toxicity(rows, labels) and len(clean) < len(rows)

    cut = run("line_dedup", clean)
    text = {r[0]: r[1] for r in plain_lines([r[:2] for r in clean])}
    assert cut == [(*r[:1], text[r[0]], *r[2:4], len(text[r[0]])) for r in clean] and cut != clean

    single = run("simhash", cut)
    assert single == plain_simhash(cut) and len(single) < len(cut)

    mixed = run("mixing", single)
    copies, sizes, taken, longest = Counter(mixed), Counter(), Counter(), Counter()
    assert set(copies) <= set(single) and max(copies.values()) == 2
    for r in single:
        sizes[r[3]] += size_of(r[1])
        taken[r[3]] += copies[r] * size_of(r[1])
        longest[r[3]] = max(longest[r[3]], size_of(r[1]))
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= longest[source] + 1e-6

    packed = run("packing", mixed)
    pieces = plain_pieces(Tokenizer.from_file(tokenizer_path()), [r[:2] for r in mixed], 4096)
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed]
    assert sorted(got) == sorted(p[:5] for p in pieces)
    assert_gapless(packed, 4096)
