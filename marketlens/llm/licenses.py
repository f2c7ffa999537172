"""License scans: an exact containment join of text blocks with license templates."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketlens.llm.shared import ship
from marketlens.llm.terms import LETTERS_DIGITS, words

#: Phrases that name a license wherever their words stand next to one another (fixed values).
PHRASES = (
    ("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"),
)
#: Notices by which texts carry a license (fixed values, from the licenses themselves).
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of"
     " this software and associated documentation files (the \"Software\"), to deal in the"
     " Software without restriction, including without limitation the rights to use, copy,"
     " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use"
     " this file except in compliance with the License. You may obtain a copy of the License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the"
     " terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification,"
     " are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose"
     " with or without fee is hereby granted, provided that the above copyright notice and this"
     " permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International"
     " License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
)
CONTAINMENT = 0.9
LEAST_STEP = 8
FOUND = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long,"
    " base_labels string, labels string, score double,"
    " blocks array<struct<label: string, start: long, end: long, containment: double>>"
)


def split(text: str) -> list[bytes]:
    return [w for part in words(text.encode(), LETTERS_DIGITS) for w in part]


def block_step(n_words: int) -> int:
    """Words between the starts of blocks, half a block; a notice of ``n_words`` words
    always lies in one block as a whole."""
    return max(LEAST_STEP, 1 << (n_words - 1).bit_length())


@dataclass
class Template:
    label: str
    tokens: list[int]
    """Distinct words by global rank, rarest first."""
    least: int
    """Words that a block must share with it."""
    step: int


@dataclass
class Index:
    """Templates by the words of their prefixes, and the ranks of all words they hold.

    Ranks follow the frequency in the whole corpus. A block that shares ``least`` words
    with a template holds one of its ``size - least + 1`` rarest.
    """

    rank: dict[bytes, int]
    by_step: dict[int, dict[int, list[tuple[Template, int]]]]
    phrases: list[tuple[list[int], str]]
    prefix: dict[int, np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        self.prefix = {
            step: np.isin(np.arange(-1, len(self.rank)), list(lists))
            for step, lists in self.by_step.items()
        }

    @classmethod
    def build(cls, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]],
              containment: float, frequency: dict[bytes, int]) -> Index:
        told = [(label, split(text)) for label, text in templates]
        named = [(split(text), label) for text, label in phrases]
        held = {w for _, t in told for w in t} | {w for t, _ in named for w in t}
        rank = {w: i for i, w in enumerate(sorted(held, key=lambda w: (frequency.get(w, 0), w)))}
        by_step = defaultdict(lambda: defaultdict(list))
        for label, text in told:
            tokens = sorted({rank[w] for w in text})
            template = Template(label, tokens, needed(len(tokens), containment),
                                block_step(len(text)))
            for place, token in enumerate(tokens[:len(tokens) - template.least + 1]):
                by_step[template.step][token].append((template, place))
        return cls(rank, {s: dict(lists) for s, lists in by_step.items()},
                   [([rank[w] for w in text], label) for text, label in named])

    def ids(self, text: bytes) -> np.ndarray:
        """Ranks of a text's words, -1 for those that no template holds."""
        parts = [
            np.fromiter((self.rank.get(w, -1) for w in some), np.int32, len(some))
            for some in words(text, LETTERS_DIGITS)
        ]
        return np.concatenate(parts)

    def places(self, ids: np.ndarray) -> list[tuple[np.ndarray, str]]:
        """Where the words of each phrase stand next to one another."""
        out = []
        for phrase, label in self.phrases:
            at = np.flatnonzero(ids[:len(ids) - len(phrase) + 1] == phrase[0])
            for i, token in enumerate(phrase[1:], 1):
                at = at[ids[at + i] == token]
            out.append((at, label))
        return out

    def blocks(self, ids: np.ndarray) -> Iterator[tuple[str, int, int, float]]:
        """(label, first word, end, containment) of all blocks that hold enough of a template."""
        for step, lists in self.by_step.items():
            at = np.flatnonzero(self.prefix[step][ids + 1]) // step
            for number in np.unique(np.concatenate([at, at[at > 0] - 1])).tolist():
                start, end = number * step, min((number + 2) * step, len(ids))
                block = np.unique(ids[start:end])
                block = block[block >= 0].tolist()
                for template in candidates(block, lists):
                    shared = len(set(block).intersection(template.tokens))
                    if shared >= template.least:
                        yield template.label, start, end, shared / len(template.tokens)


def needed(size: int, containment: float) -> int:
    """The fewest of ``size`` words that are a share of ``containment`` or more."""
    return next(n for n in range(1, size + 1) if n / size >= containment)


def candidates(block: list[int], lists: dict[int, list[tuple[Template, int]]]) -> list[Template]:
    """Templates that can share enough words with a block, by length, prefix and position.

    ``block`` holds distinct ranks in order. A word counts if it lies in the prefixes of both;
    what may follow it in both bounds the words they can share.
    """
    met: dict[int, Template] = {}
    shared: dict[int, float] = {}
    for place, token in enumerate(block):
        for template, own in lists.get(token, ()):
            if place > len(block) - template.least:
                continue
            before = shared.get(id(template), 0)
            after = min(len(template.tokens) - own, len(block) - place)
            enough = before + after >= template.least
            met[id(template)] = template
            shared[id(template)] = before + 1 if enough else -np.inf
    return [template for key, template in met.items() if shared[key] > 0]


def find_licenses(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES, containment: float = CONTAINMENT,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks)
    per row of ``docs``.

    Words are runs of a-z (A-Z in lower case), digits and all characters beyond ASCII. Base
    places are those where a phrase's words stand next to one another: their number, first and
    last start and labels. The join adds labels: a text is cut into blocks of 2 s words that
    start every s words, where s is the power of two (8 at least) that holds a template, and
    every block with a share of ``containment`` or more of a template's distinct words is
    found, with its place. Words are ordered by the number of documents of the whole corpus
    that hold them; a block is compared with a template only if the rarest words of both
    meet, if it is long enough and if the places of the words they share leave room for
    enough others. These filters lose nothing.

    ``score`` is the largest containment found, 1 with a base place, else 0. Labels are
    distinct, sorted and comma-joined. Only the words of the templates are counted and
    sent, so what the driver holds does not grow with the corpus; a text becomes one
    number a word, in slices. Null text is empty: no words, no label, null places. Repeated
    rows and null ids are answered each. Only the named columns are read.
    """
    ship(docs.sparkSession)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       F.encode(F.coalesce(docs[text], F.lit("")), "UTF-8").alias("text"))
    wanted = {w for _, t in templates for w in split(t)}

    def count(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in stream:
            for value in batch.column(0):
                seen = set()
                for some in words(value.as_py(), LETTERS_DIGITS):
                    seen.update(wanted.intersection(some))
                held.update(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())],
            names=["word", "n"])

    counted = rows.select("text").mapInArrow(count, "word binary, n long")
    frequency = {bytes(r[0]): r[1] for r in counted.groupBy("word").agg(F.sum("n")).collect()}
    index = Index.build(templates, phrases, containment, frequency)

    def scan(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            found = [scanned(index, value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": d, **f} for d, f in zip(batch.column(0).to_pylist(), found)], schema)

    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
        ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
        ("labels", pa.string()), ("score", pa.float64()),
        ("blocks", pa.list_(pa.struct([
            ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
            ("containment", pa.float64())]))),
    ])
    return rows.mapInArrow(scan, FOUND)


def scanned(index: Index, text: bytes) -> dict:
    ids = index.ids(text)
    places = [(at, label) for at, label in index.places(ids) if len(at)]
    blocks = sorted(index.blocks(ids), key=lambda b: (b[1], b[0], b[2], -b[3]))
    base = {label for _, label in places}
    return {
        "n_words": len(ids), "n_base": sum(len(at) for at, _ in places),
        "first_word": min((int(at[0]) for at, _ in places), default=None),
        "last_word": max((int(at[-1]) for at, _ in places), default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {b[0] for b in blocks})),
        "score": 1.0 if base else max((b[3] for b in blocks), default=0.0),
        "blocks": [dict(zip(("label", "start", "end", "containment"), b)) for b in blocks],
    }
