"""Best-fit packing: minimum bin slack over the histogram of piece lengths."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketlens.llm.shared import Shared, numbered

#: Characters that a task tokenises at once; words, their characters and stems that it remembers.
TEXT_RUN = 1 << 20
WORDS = 400_000
WORD_CHARS = 1 << 23
STEMS = 800_000
#: Characters that never join a word of letters before them.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordTokens:
    """Token ids of whole texts, remembered word by word.

    For tokenizers whose tokens never reach across white space: cutting at a blank or
    line break gives the ids of the whole text. The letters of a word go to the
    tokenizer's model at once, without its normalisation and splitting, as far as each
    letter by itself shows that these only fold case; marks behind them are a word of
    their own. The memory is bounded; a full one starts afresh.
    """

    _of: dict[str, WordTokens] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._forget()
        self.stems: dict[str, bytes] = {}
        self.letters = self._single_letters()
        known = re.escape("".join(map(chr, self.letters)))
        self.simple = re.compile(f"([{known}]+)([{re.escape(MARKS)}]*)" if known else "(?!)")
        whole = self._whole(["one Two\nthree, Four."])
        if self.encode(["one Two\nthree, Four."]) != whole:
            raise ValueError("the tokenizer keeps white space, so words depend on each other")

    def _forget(self) -> None:
        self.known: dict[str, bytes] = {"": b""}
        self.chars = 0

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(encoding.ids, "<u4").tobytes() for encoding in found]

    def _of_letters(self, form: str) -> bytes:
        ids = [token.id for token in self.model.tokenize(form)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _single_letters(self) -> dict[int, str]:
        """What the model is given for the letters of one byte, capitals included."""
        forms, split = {}, self.tokenizer.pre_tokenizer
        for letter in filter(str.isalpha, map(chr, range(0x100))):
            parts = split.pre_tokenize_str(letter.lower()) if split else []
            if len(parts) == 1 and self._of_letters(parts[0][0]) == self._whole([letter])[0]:
                forms[ord(letter)] = parts[0][0]
        return forms

    @classmethod
    def load(cls, path: str) -> WordTokens:
        """One per worker process."""
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        chars = sum(map(len, new))
        if len(self.known) + len(new) > WORDS or self.chars + chars > WORD_CHARS:
            self._forget()
            new = list(words)
        self.chars += chars
        if len(self.stems) + len(new) > STEMS:
            self.stems = {}
        known, stems, rest = self.known, self.stems, []
        for word in new:
            parts = self.simple.fullmatch(word)
            if parts is None:
                rest.append(word)
                continue
            form, marks = parts[1].translate(self.letters), parts[2]
            ids = stems.get(form)
            if ids is None:
                ids = stems[form] = self._of_letters(form)
            if marks:
                behind = known.get(marks)
                if behind is None:
                    behind = known[marks] = self._whole([marks])[0]
                ids += behind
            known[word] = ids
        for start in range(0, len(rest), 4096):
            part = rest[start:start + 4096]
            self.known.update(zip(part, self._whole(part)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of every text."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        self._learn({w for words in split for w in words})
        known = self.known
        return [b"".join([known[w] for w in words]) for words in split]


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(piece, start, length, ids) of a document cut into runs of ``capacity`` ids."""
    for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
        part = ids[4 * start:4 * (start + capacity)]
        yield piece, start, len(part) // 4, part


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end: int,
    text: str = "text", doc_id: str = "doc_id", keep_ids: bool = False,
) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32[, ids]) of every tokenised row."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    closing = np.array([end], "<u4").tobytes()

    def cut(ids: list, texts: list[str], encoder: WordTokens) -> pa.RecordBatch:
        rows = []
        for key, encoded in zip(ids, encoder.encode(texts)):
            for piece, start, length, part in pieces_of(encoded + closing, capacity):
                rows.append((key, piece, start, length, zlib.crc32(part), part))
        columns = list(zip(*rows))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.record_batch(
            [pa.array(c, t) for c, t in zip(columns[:len(names)], types)], names=names
        )

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordTokens.load(tokenizer)
        for batch in stream:
            ids, texts, size = [], [], 0
            for key, value in zip(batch.column(0), batch.column(1)):
                ids.append(key.as_py())
                texts.append(value.as_py() or "")
                size += len(texts[-1])
                if size >= TEXT_RUN:
                    yield cut(ids, texts, encoder)
                    ids, texts, size = [], [], 0
            if ids:
                yield cut(ids, texts, encoder)

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(batches, schema + ", ids binary" * keep_ids)


def fullest(counts: np.ndarray, room: int) -> dict[int, int]:
    """The combination of available lengths that fills ``room`` best: {length: copies}.

    Subset sums are the bits of one integer. Longer lengths come first and the search
    ends as soon as the room can be filled, so short ones stay for later bins.
    """
    reached, layers = 1, []
    mask, goal = (1 << (room + 1)) - 1, 1 << room
    for length in np.flatnonzero(counts[:room + 1])[::-1].tolist():
        left, step = min(int(counts[length]), room // length), 1
        while left and not reached & goal:
            copies = min(step, left)
            wider = reached | (reached << (length * copies)) & mask
            if wider != reached:
                layers.append((length, copies, reached))
                reached = wider
            left, step = left - copies, step * 2
        if reached & goal:
            break
    total, used = reached.bit_length() - 1, {}
    for length, copies, before in reversed(layers):
        if not before >> total & 1:
            total -= length * copies
            used[length] = used.get(length, 0) + copies
    return used


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as (how many, [(length, copies of it)]), longest length first in each.

    Every bin takes the longest piece left and the fullest combination beside it. The
    same bin is repeated as long as its pieces last: it stays the fullest while lengths
    only get fewer. The histogram has at most ``capacity`` entries, whatever the corpus.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    bins = []
    while len(available := np.flatnonzero(counts)):
        seed = int(available[-1])
        counts[seed] -= 1
        used = fullest(counts, capacity - seed)
        counts[seed] += 1
        used[seed] = used.get(seed, 0) + 1
        times = min(int(counts[length]) // copies for length, copies in used.items())
        for length, copies in used.items():
            counts[length] -= times * copies
        bins.append((times, sorted(used.items(), reverse=True)))
    return bins


def placements(bins: list[tuple[int, list[tuple[int, int]]]], histogram: dict[int, int]):
    """Arrays over runs of pieces in order of falling length: first row, first bin,
    pieces a bin, offset in the bin, length."""
    first, before = {}, 0
    for length in sorted(histogram, reverse=True):
        first[length], before = before, before + histogram[length]
    rows, number = [], 0
    for times, used in bins:
        offset = 0
        for length, copies in used:
            rows.append((first[length], number, copies, offset, length))
            first[length] += times * copies
            offset += length * copies
        number += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 1,
    text: str = "text", doc_id: str = "doc_id", keep_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their ``sequence_id`` and ``offset``; gapless from 0.

    A document is its token ids and ``end``; only longer ones are cut, every
    ``capacity`` ids. The bins are planned from the counts per length (``capacity`` rows
    at most) and pieces find their bin by their rank among all pieces sorted by length,
    so neither a hot length nor the number of documents meets in one task.
    ``sequences`` joins the ids of each bin if ``keep_ids`` is set.

    Null or empty text is the single id ``end``. Repeated rows are packed as often, null
    ids as well; ties in length go by doc_id and piece. No rows give no rows. Only the
    named columns are read. ``tokenizer`` is a file path that exists on every executor.
    """
    shared = Shared(docs.sparkSession)
    pieces = shared.put(token_pieces(docs, tokenizer, capacity, end, text, doc_id, keep_ids))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = placements(plan(histogram, capacity), histogram)
    order = [F.col("length").desc(), F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    rows = numbered(shared, pieces, order, "_rank")

    def place(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            rank = batch.column("_rank").to_numpy()
            run = runs[np.searchsorted(runs[:, 0], rank, "right") - 1] if len(rank) else runs[:0]
            turn = rank - run[:, 0]
            kept = batch.drop_columns(["_rank"])
            yield pa.record_batch(
                [*kept.columns, pa.array(run[:, 1] + turn // run[:, 2]),
                 pa.array(run[:, 3] + turn % run[:, 2] * run[:, 4])],
                names=[*kept.schema.names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes)
    return rows.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, pieces): the packed ids of each bin, from pieces that keep theirs.

    A bin has at most ``capacity`` ids, so its group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id",
        F.aggregate("p.ids", F.lit(b""), lambda all_, x: F.concat(all_, x)).alias("ids"),
        F.size("p").alias("pieces"),
    )
