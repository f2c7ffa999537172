"""Toxicity: a linear-chain CRF tags toxic tokens; its marginals score the document."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Bounds of the labelled sample that the model is fitted on.
SAMPLE_DOCS = 2000
SAMPLE_CHARS = 20_000
#: A word marks a toxic token from this log odds, this many different words at one of the
#: places around it, and if chance explains it with this probability at most, all words of
#: the sample considered.
#: Marginals up to the floor say nothing about a document, however long it is.
LEAST_ODDS = 3.0
LEAST_CONTEXTS = 5
MOST_CONTEXTS = 64
PLACES = (-2, -1, 1, 2)
CHANCE = 0.05
FLOOR = 0.2
SLOTS = 1 << 20
KNOWN_WORDS = 400_000
STEPS = 40
#: Tokens that the fit works on at once.
PART_TOKENS = 1 << 18
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def plain(token: str) -> str:
    return EDGES.sub("", token).lower()


def features(word: str) -> list[int]:
    """Slots of the word itself and its ends."""
    marks = (f"w{word}", f"p{word[:4]}", f"s{word[-3:]}")
    return [zlib.crc32(m.encode("utf-8", "surrogatepass")) % SLOTS for m in marks]


class Chains:
    """Documents of tokens side by side: position by position over all that are long enough."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        starts = np.cumsum(lengths) - lengths
        self.first = starts[self.order]
        longest = int(self.lengths[0]) if len(lengths) else 0
        self.active = np.searchsorted(-self.lengths, -np.arange(longest), "left")

    def forward(self, odds: np.ndarray, t: np.ndarray, start: float) -> np.ndarray:
        """alpha(1) / alpha(0) of every token; ``odds``: emission potentials of tag 1."""
        out = np.empty_like(odds)
        for i, n in enumerate(self.active):
            at = self.first[:n] + i
            if i:
                r = r[:n]
                r = odds[at] * (t[0, 1] + r * t[1, 1]) / (t[0, 0] + r * t[1, 0])
            else:
                r = odds[at] * start
            out[at] = r
        return out

    def backward(self, odds: np.ndarray, t: np.ndarray) -> np.ndarray:
        """beta(1) / beta(0) of every token."""
        out = np.ones_like(odds)
        for i in range(len(self.active) - 2, -1, -1):
            at = self.first[:self.active[i + 1]] + i
            e = odds[at + 1] * out[at + 1]
            out[at] = (t[1, 0] + t[1, 1] * e) / (t[0, 0] + t[0, 1] * e)
        return out


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


class Model:
    """Emission weights of hashed features, tag transitions and the document calibration."""

    def __init__(self):
        self.weights = np.zeros(SLOTS, np.float64)
        self.bias = -3.0
        self.transition = np.zeros((2, 2))
        self.calibration = np.zeros(3)
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def emission(self, token: str) -> float:
        """Log potential of the toxic tag; the worker remembers a bounded number of tokens."""
        value = self.known.get(token)
        if value is None:
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            value = float(self.weights[features(plain(token))].sum() + self.bias)
            if len(token) <= 64:
                self.known[token] = value
        return value

    def potentials(self) -> np.ndarray:
        return np.exp(self.transition)

    def marginals(self, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """P(toxic) of every token by the forward and the backward pass."""
        odds = np.exp(np.clip(emissions, -30, 30))
        chains, t = Chains(lengths), self.potentials()
        both = chains.forward(odds, t, 1.0) * chains.backward(odds, t)
        return both / (1 + both)

    @staticmethod
    def summaries(marginals: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per document: 1, bits of evidence that any token is toxic (capped), expected number."""
        marginals = np.maximum(marginals - FLOOR, 0) / (1 - FLOOR)
        any_ = -sums(np.log1p(-np.minimum(marginals, 1 - 1e-9)), lengths)
        return np.column_stack(
            [np.ones(len(lengths)), np.minimum(any_, 5.0), np.log1p(sums(marginals, lengths))]
        )

    def scores(self, marginals: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.summaries(marginals, lengths) @ self.calibration))


def listed(words: Sequence) -> list:
    """A document's words as Python objects, one document at a time."""
    return words.tolist() if isinstance(words, np.ndarray) else list(words)


def token_labels(texts: Sequence[Sequence], toxic: list[int]) -> list[np.ndarray]:
    """Which tokens of toxic documents are toxic: words that clean documents lack.

    Words may be texts or their numbers; the empty word is "" or 0.

    A document counts for a word only as far as the words at one place near it differ, so
    the text of one much copied document does not count as many. The place that differs
    most decides: phrases of four words, first and last words keep theirs. A word that
    only copies of one text hold cannot be told from the words around it.
    """
    seen = (Counter(), Counter())
    for words, label in zip(texts, toxic):
        seen[label].update(set(listed(words)))
    n = [max(1, sum(1 for t in toxic if t == k)) for k in (0, 1)]
    doubt = math.log(max(1, len(seen[1])) / CHANCE)

    def telling(word: str, k: int) -> bool:
        c = seen[0][word]
        odds = math.log((k + 0.5) / n[1]) - math.log((c + 0.5) / n[0])
        expected = (k + c) * n[1] / (n[0] + n[1])
        surprise = k * math.log(k / expected)
        if c:
            surprise += c * math.log(c / (k + c - expected))
        return odds >= LEAST_ODDS and surprise >= doubt

    # Fewer documents tell less, so the contexts of other words need not be remembered.
    near = {
        w: [set() for _ in PLACES] for w, k in seen[1].items()
        if w and k >= LEAST_CONTEXTS and telling(w, k)
    }
    for words, label in zip(texts, toxic):
        if label:
            words = listed(words)
            for i, word in enumerate(words):
                for place, others in zip(PLACES, near.get(word, ())):
                    if len(others) < MOST_CONTEXTS:
                        others.add(words[i + place] if 0 <= i + place < len(words) else None)
    contexts = {w: max(map(len, places)) for w, places in near.items()}
    marked = {
        w for w, k in contexts.items()
        if k >= LEAST_CONTEXTS and telling(w, min(k, seen[1][w]))
    }
    return [
        np.array([w in marked for w in listed(words)] if label else [False] * len(words), bool)
        for words, label in zip(texts, toxic)
    ]


def numbers(texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
    """Every document's words by number, and the words; 0 is the empty word. Texts are given
    up as they are read."""
    number = {"": 0}
    out = []
    for i, text in enumerate(texts):
        texts[i] = ""
        words = [number.setdefault(w, len(number)) for w in map(plain, text.split())]
        out.append(np.array(words, np.int32))
    return out, list(number)


class Part:
    """Documents of similar length that are worked on at once."""

    def __init__(self, members: list[int], docs: list[np.ndarray], tags: list[np.ndarray]):
        self.members = members
        self.ids = np.concatenate([docs[i] for i in members])
        self.tags = np.concatenate([tags[i] for i in members])
        self.lengths = np.array([len(docs[i]) for i in members])
        self.chains = Chains(self.lengths)
        self.inner = np.ones(len(self.ids), bool)
        self.inner[np.cumsum(self.lengths) - 1] = False

    def pairs(self) -> np.ndarray:
        """Places that have a following one in their document."""
        return np.flatnonzero(self.inner)

    def gold(self) -> np.ndarray:
        at, out = self.pairs(), np.zeros((2, 2))
        np.add.at(out, (self.tags[at].astype(int), self.tags[at + 1].astype(int)), 1.0)
        return out

    def missing(self, model: Model, by_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per word, and per pair of tags: what the labels hold beyond what the model expects."""
        odds, t = np.exp(np.clip(by_word, -30, 30))[self.ids], model.potentials()
        alpha, beta = self.chains.forward(odds, t, 1.0), self.chains.backward(odds, t)
        p = alpha * beta / (1 + alpha * beta)
        words = np.bincount(self.ids, weights=self.tags - p, minlength=len(by_word))
        at = self.pairs()
        ahead, behind = odds[at + 1] * beta[at + 1], alpha[at]
        joint = (t[0, 0], t[0, 1] * ahead, t[1, 0] * behind, t[1, 1] * behind * ahead)
        total = joint[0] + joint[1] + joint[2] + joint[3]
        return words, np.array([(part / total).sum() for part in joint]).reshape(2, 2)


def parts(docs: list[np.ndarray], tags: list[np.ndarray]) -> list[Part]:
    """Documents by falling length, some ``PART_TOKENS`` tokens together."""
    out, held, size = [], [], 0
    for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        held.append(i)
        size += len(docs[i])
        if size >= PART_TOKENS:
            out.append(Part(held, docs, tags))
            held, size = [], 0
    if held:
        out.append(Part(held, docs, tags))
    return out


def fit(texts: list[str], toxic: list[int]) -> Model:
    """Conditional likelihood of the labelled tokens, then of the documents' labels.

    The driver holds a number a token and works on one part of the documents after another.
    ``texts`` is emptied.
    """
    model = Model()
    docs, words = numbers(texts)
    pairs = [(d, y) for d, y in zip(docs, toxic) if len(d)]
    docs, toxic = [d for d, _ in pairs], [y for _, y in pairs]
    if len(set(toxic)) < 2:
        model.calibration[0] = 4.0 if 1 in toxic else -4.0
        return model
    slots = np.array([features(w) for w in words], np.int32)
    n_words = len(words)
    del words
    dealt = parts(docs, token_labels(docs, toxic))
    gold = sum(part.gold() for part in dealt)
    size = SLOTS + 1 + 4
    first, second = np.zeros(size), np.zeros(size)
    scale = 1.0 / len(docs)
    for step in range(1, STEPS + 1):
        emission = model.weights[slots].sum(axis=1) + model.bias
        by_word, expected = np.zeros(n_words), np.zeros((2, 2))
        for part in dealt:
            more = part.missing(model, emission)
            by_word += more[0]
            expected += more[1]
        gradient = np.bincount(slots.ravel(), np.repeat(by_word * scale, slots.shape[1]), size)
        gradient[SLOTS] = by_word.sum() * scale
        gradient[SLOTS + 1:] = ((gold - expected) * scale).ravel()
        gradient[:SLOTS] -= 1e-4 * model.weights
        first *= 0.9
        first += 0.1 * gradient
        second *= 0.99
        second += 0.01 * gradient**2
        move = np.sqrt(second / (1 - 0.99**step))
        move += 1e-6
        np.divide(0.3 / (1 - 0.9**step) * first, move, out=move)
        model.weights += move[:SLOTS]
        model.bias += move[SLOTS]
        model.transition += move[SLOTS + 1:].reshape(2, 2)
    emission = model.weights[slots].sum(axis=1) + model.bias
    x = np.zeros((len(docs), 3))
    for part in dealt:
        marginals = model.marginals(emission[part.ids], part.lengths)
        x[part.members] = Model.summaries(marginals, part.lengths)
    y, theta = np.array(toxic, float), np.zeros(3)
    for _ in range(25):
        p = 1 / (1 + np.exp(-x @ theta))
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + 1e-3 * np.eye(3)
        theta += np.linalg.solve(hessian, x.T @ (y - p) / len(y) - 1e-3 * theta)
    model.calibration = theta
    return model


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
    label: str = "toxic", per_class: int = SAMPLE_DOCS, max_chars: int = SAMPLE_CHARS,
) -> Model:
    """Fit on at most ``per_class`` labelled documents of each class, each of at most
    ``max_chars`` characters: a bounded sample by hash of the id, outside the held-out fold.

    A document labelled more than once is toxic if any label says so; null labels and
    null ids are left out. Without both classes every document gets the only class.
    """
    given = labels.select(labels[doc_id].alias("doc_id"), labels[label].alias("y"))
    given = given.filter("doc_id is not null and y is not null")
    given = given.groupBy("doc_id").agg(F.max((F.col("y") > 0).cast("int")).alias("y"))
    given = given.filter(~held_out())
    texts = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    short = texts.filter(F.char_length("text") <= max_chars)
    found = short.select("doc_id").distinct().join(given, "doc_id")
    picked = None
    for y in (0, 1):
        some = found.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id")
        some = some.limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    chosen = short.join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])
    rows = sorted(tuple(r) for r in chosen.select("doc_id", "text", "y").collect())
    return fit([r[1] for r in rows], [r[2] for r in rows])


def score_toxicity(
    docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, score, predicted, spans, *keep) per row; spans: (start, end) of offending tokens.

    Every token of the whole text gets its marginal; ``score`` is the calibrated
    probability that the document is toxic, ``predicted`` 1 from 0.5 on. Offsets are
    code points of tokens whose marginal is 0.5 or more. One pass, no shuffle; the model
    is of fixed size. Null or empty text is scored by the calibration alone and has no
    spans; repeated rows and null ids come back as they are. A score reads the text only;
    the columns ``keep``, if any, pass by it in a struct ``row`` of fields c0, c1 ...
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        for batch in stream:
            emissions, lengths = [], []
            for value in batch.column(1):
                tokens = (value.as_py() or "").split()
                found = map(crf.known.get, tokens)
                emissions.append(np.array(
                    [crf.emission(t) if e is None else e for t, e in zip(tokens, found)],
                    np.float64,
                ))
                lengths.append(len(tokens))
            lengths = np.array(lengths, np.int64)
            flat = np.concatenate(emissions) if emissions else np.zeros(0)
            marginals = crf.marginals(flat, lengths)
            scores = crf.scores(marginals, lengths)
            offending = np.flatnonzero(marginals >= 0.5)
            owner = np.searchsorted(np.cumsum(lengths), offending, "right")
            place = offending - (np.cumsum(lengths) - lengths)[owner]
            spans: list[list] = [[] for _ in range(len(lengths))]
            for doc in np.unique(owner):
                spans[doc] = token_spans(batch.column(1)[int(doc)].as_py(), place[owner == doc])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch(
                [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)),
                 pa.array(spans, kind), *batch.columns[2:]],
                names=["doc_id", "score", "predicted", "spans", *batch.schema.names[2:]],
            )

    row = [F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)]).alias("row")] if keep else []
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), *row)
    kinds = dict(rows.dtypes)
    spans = "spans array<struct<start: long, end: long>>"
    passed = f", row {kinds['row']}" if keep else ""
    return rows.mapInArrow(
        batches, f"doc_id {kinds['doc_id']}, score double, predicted int, {spans}{passed}"
    )


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the model does not predict to be toxic."""
    kept = score_toxicity(docs, model, text, doc_id, docs.columns).filter("predicted = 0")
    return kept.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def token_spans(text: str, places: np.ndarray) -> list[dict[str, int]]:
    """Code-point offsets of the tokens at ``places`` (ascending)."""
    wanted, found = set(places.tolist()), []
    position = 0
    for i, token in enumerate(text.split()):
        position = text.index(token, position)
        if i in wanted:
            found.append({"start": position, "end": position + len(token)})
        position += len(token)
    return found
