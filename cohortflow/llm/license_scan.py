"""License scan: an exact set-similarity join of text blocks with license templates, next to plain phrase places.

A block meets a template if it holds at least ``threshold`` of the template's distinct words. Words are ordered by their frequency over
all documents, rarest first. A block that meets a template must share one of the template's first |T| - need + 1 words (prefix filter),
have at least ``need`` words of it (length filter), and the words still to come from the first shared one on must
suffice on both sides (positional filter). The filters lose nothing, and what passes is counted exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortflow.llm.text import as_bytes, slices

# The phrases whose places are counted, with their labels, and the wording that the block join looks for.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "mit": "Released under the MIT License",
    "mit-text": "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "apache": "Licensed under the Apache License Version",
    "apache-text": "you may not use this file except in compliance with the License you may obtain a copy of the License at",
    "gpl": "This work is licensed under the GNU General Public License version",
    "gpl-text": "This program is free software you can redistribute it and or modify it under the terms of the GNU General Public License",
    "cc-by-nc": "Licensed under CC BY NC",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "bsd": "Redistribution and use in source and binary forms with or without modification are permitted provided that",
    "all-rights-reserved": "Copyright all rights reserved no part may be reproduced",
}
#: Bytes that are no part of a word become blanks, A-Z become a-z.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_TABLE).split()


@dataclass(frozen=True)
class TemplateIndex:
    """``order``: word -> rank, rarest first. ``postings``: prefix word's rank -> (template, place). Bounded by the templates."""

    order: dict[bytes, int]
    sets: dict[str, tuple[int, ...]]
    need: dict[str, int]
    postings: dict[int, list[tuple[str, int]]]
    prefix_words: frozenset[bytes]

    @classmethod
    def build(cls, templates: Mapping[str, str], frequency: Mapping[bytes, int], threshold: float) -> TemplateIndex:
        sets = {label: {*words_of(t.encode())} for label, t in templates.items()}
        ranked = sorted(set().union(*sets.values()), key=lambda w: (frequency.get(w, 0), w))
        order = {w: n for n, w in enumerate(ranked)}
        ordered = {label: tuple(sorted(order[w] for w in s)) for label, s in sets.items() if s}
        need = {label: max(1, math.ceil(threshold * len(s) - 1e-9)) for label, s in ordered.items()}
        postings: dict[int, list[tuple[str, int]]] = {}
        for label, ranks in ordered.items():
            for place, rank in enumerate(ranks[: len(ranks) - need[label] + 1]):
                postings.setdefault(rank, []).append((label, place))
        return cls(order, ordered, need, postings, frozenset(w for w in ranked if order[w] in postings))

    def meets(self, block: list[int]) -> list[tuple[str, int]]:
        """(template, shared words) of every template that a block of distinct ranks in rising order meets."""
        found, seen = [], set()
        for at, rank in enumerate(block):
            for label, place in self.postings.get(rank, ()):
                if label in seen:
                    continue
                seen.add(label)
                need, ranks = self.need[label], self.sets[label]
                if min(len(block), len(block) - at, len(ranks) - place) < need:
                    continue
                shared = len({*block} & {*ranks})
                if shared >= need:
                    found.append((label, shared))
        return found


def template_frequency(docs: DataFrame, templates: Mapping[str, str], text: str = "text") -> dict[bytes, int]:
    """How often every template word occurs in all documents: partial counts per task, then one sum per word."""
    vocabulary = frozenset(w for t in templates.values() for w in words_of(t.encode()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in slices(batches, text):
            for whole in as_bytes(batch, text):
                total.update(filter(vocabulary.__contains__, words_of(whole)))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    partial = docs.select(text).mapInArrow(count, "word string, n long")
    return {r["word"].encode(): r["n"] for r in partial.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _places(joined: bytes, phrase: bytes) -> list[int]:
    """The word numbers at which ``phrase`` starts; places may overlap."""
    found, at = [], joined.find(phrase)
    while at >= 0:
        found.append(joined.count(b" ", 0, at))
        at = joined.find(phrase, at + 1)
    return found


def _blocks(words: list[bytes], index: TemplateIndex, size: int) -> list[tuple[str, int, int, float]]:
    """label, first word, end, containment: the best block per template and stretch. Blocks of ``size`` words start every half size."""
    if index.prefix_words.isdisjoint(words):
        return []
    half = max(1, size // 2)
    known = [(at, index.order[w]) for at, w in enumerate(words) if w in index.order]
    starts = sorted({s for at, r in known if r in index.postings for s in (at // half * half, max(0, at // half * half - half))})
    out, low = [], 0
    for start in starts:
        while low < len(known) and known[low][0] < start:
            low += 1
        ranks, n = set(), low
        while n < len(known) and known[n][0] < start + size:
            ranks.add(known[n][1])
            n += 1
        out += [(label, start, min(start + size, len(words)), shared / len(index.sets[label])) for label, shared in index.meets(sorted(ranks))]
    return out


_LONG, _TEXT, _SHARE = T.LongType(), T.StringType(), T.DoubleType()
BLOCK = T.StructType([T.StructField("label", _TEXT), T.StructField("first", _LONG), T.StructField("end", _LONG), T.StructField("containment", _SHARE)])
RESULT = T.StructType(
    [T.StructField(c, _LONG) for c in ("n_words", "n_base", "first_word", "last_word")]
    + [T.StructField("base_labels", _TEXT), T.StructField("labels", _TEXT), T.StructField("score", _SHARE), T.StructField("blocks", T.ArrayType(BLOCK))]
)


def license_scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    threshold: float = 0.9,
    block_words: int = 64,
    text: str = "text",
) -> DataFrame:
    """Every row of ``docs`` without its text, with its phrase places, its blocks and both as labels.

    ``n_base``, ``first_word`` and ``last_word`` are about phrase places only. ``score`` is 1 where a phrase stands, else the best
    containment found, else 0. Null and empty texts have no words. Template labels lose what follows their first "-text". Columns of
    ``docs`` named like a result are replaced by it; repeated rows stay. The templates are a list in the driver's memory.
    """
    index = TemplateIndex.build(templates, template_frequency(docs, templates, text), threshold)
    wanted = [(b" " + b" ".join(words_of(p.encode())) + b" ", label) for p, label in phrases.items()]
    rest = [c for c in docs.columns if c != text and c not in RESULT.names]
    schema = docs.select(F.struct(*rest).alias("_rest")).schema.add("_found", RESULT)
    kind = pa.struct(
        [(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")]
        + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
        + [("blocks", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())])))]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = []
            for whole in as_bytes(batch, "_text"):
                words = words_of(whole)
                joined = b" " + b" ".join(words) + b" "
                places = [(p, label) for phrase, label in wanted for p in _places(joined, phrase)]
                blocks = _blocks(words, index, block_words)
                base, at = {label for _, label in places}, [p for p, _ in places]
                labels = base | {b[0].removesuffix("-text") for b in blocks}
                found.append(
                    {
                        "n_words": len(words),
                        "n_base": len(at),
                        "first_word": min(at, default=None),
                        "last_word": max(at, default=None),
                        "base_labels": ",".join(sorted(base)),
                        "labels": ",".join(sorted(labels)),
                        "score": 1.0 if base else max((b[3] for b in blocks), default=0.0),
                        "blocks": [dict(zip(("label", "first", "end", "containment"), b, strict=True)) for b in blocks],
                    }
                )
            yield pa.RecordBatch.from_arrays([batch.column("_rest"), pa.array(found, kind)], ["_rest", "_found"])

    rows = docs.select(F.struct(*rest).alias("_rest"), F.col(text).alias("_text")).mapInArrow(scan, schema)
    return rows.select(*[F.col("_rest")[c].alias(c) for c in rest], "_found.*")
