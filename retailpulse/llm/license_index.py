"""Licences in texts, found by a positional index of licence words.

Every template is a list of words. A word weighs the more the fewer documents hold it;
a template's anchors are its heaviest words, as many as leave too little weight for a
match without any of them. An anchor in a text proposes the place where its template
would start; there all words of the template are looked up at their relative positions,
and the mandatory phrases must stand nearby as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from retailpulse.llm.common import text_bytes

#: Per cent of a template's weight that must be found in a text.
PERCENT = 80
#: How many words a template's word may lie off its place.
DRIFT = 3
#: Weights are whole numbers, so that sums are the same in any order: thousandths of a unit of information.
UNIT = 1000

#: Letters A-Z become a-z, all other ASCII but digits and letters becomes a blank.
_FOLDED = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c > 0x7F else 0x20 for c in range(256))


@dataclass(frozen=True)
class Template:
    """Words of a licence notice; ``phrases`` must stand in the text word for word."""

    label: str
    text: str
    phrases: tuple[str, ...]
    percent: int = PERCENT
    drift: int = DRIFT
    base: bool = False


def exact(label: str, phrase: str) -> Template:
    return Template(label, phrase, (phrase,), 100, 0, True)


# Phrases of the contract.
BASE = [
    exact("mit", "under the mit license"),
    exact("apache-2", "apache license version 2"),
    exact("cc-by-nc", "cc by nc"),
]

# Public licence notices and the phrases without which they are not meant.
NOTICES = [
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the Software), to deal in the Software without restriction, including without limitation the rights "
             "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
             ("permission is hereby granted free of charge", "without restriction")),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
             "with the License. You may obtain a copy of the License at", ("apache license", "version 2 0")),
    Template("apache-2", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
             "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
             ("gnu general public license", "version 2")),
    Template("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
             "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
             ("gnu general public license", "version 3")),
    Template("gpl-2", "licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    Template("gpl-3", "licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             ("gnu lesser general public license",)),
    Template("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
             ("gnu affero general public license",)),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
             ("with or without fee is hereby granted",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("cc0", "The person who associated a work with this deed has dedicated the work to the public domain under CC0 1.0 Universal",
             ("cc0 1 0 universal",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             ("creative commons attribution 4 0",)),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             ("creative commons attribution sharealike",)),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
             ("creative commons attribution noncommercial",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("by nc",)),
    Template("all-rights-reserved", "All rights reserved", ("all rights reserved",)),
]

TEMPLATES = BASE + NOTICES


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and bytes beyond ASCII, A-Z lower-cased."""
    return text.translate(_FOLDED).split()


def vocabulary(templates: list[Template]) -> list[str]:
    return sorted({w.decode() for t in templates for part in (t.text, *t.phrases) for w in words_of(part.encode())})


def document_counts(docs: DataFrame, templates: list[Template], column: str = "text") -> tuple[int, dict[str, int]]:
    """Number of documents, and of those that hold each word of ``templates``: at most one row a word reaches the driver."""
    known = {w.encode(): w for w in vocabulary(templates)}

    def run(batches):
        counts = dict.fromkeys(known, 0)
        n = 0
        for batch in batches:
            for text in batch["text"]:
                n += 1
                for w in known.keys() & words_of(text.as_py()):
                    counts[w] += 1
        words = [w for w in counts if counts[w]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *(known[w] for w in words)], pa.string()), pa.array([n, *(counts[w] for w in words)], pa.int64())], names=["word", "n"]
        )

    found = docs.select(text_bytes(column).alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r.word: r.n for r in found.collect()}
    return counts.pop(None, 0), counts


class Index:
    """Templates with their words' weights, and the postings of their anchors."""

    def __init__(self, templates: list[Template], n_docs: int, counts: dict[str, int]):
        names = vocabulary(templates)
        self.number = {w.encode(): k for k, w in enumerate(names)}
        self.weight = np.array([1 + math.floor(UNIT * math.log((n_docs + 1) / (counts.get(w, 0) + 1))) for w in names], np.int64)
        self.templates = templates
        self.words = [np.array([self.number[w] for w in words_of(t.text.encode())]) for t in templates]
        self.phrases = [[[self.number[w] for w in words_of(p.encode())] for p in t.phrases] for t in templates]
        self.total = [int(self.weight[w].sum()) for w in self.words]
        # (template, place) of every anchor, by word.
        self.postings: dict[int, list[tuple[int, int]]] = {}
        for k, template in enumerate(templates):
            left = self.total[k]
            for j in sorted(range(len(self.words[k])), key=lambda j: (-self.weight[self.words[k][j]], j)):
                if left * 100 < template.percent * self.total[k]:
                    break
                word = int(self.words[k][j])
                self.postings.setdefault(word, []).append((k, j))
                left -= int(self.weight[word])
        self.anchors = {names[w].encode() for w in self.postings}
        self.margin = DRIFT + max(max(len(w) for w in self.words), *(t.drift for t in templates))

    def places(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(template, start, weight found) of all matches, by template and start."""
        if self.anchors.isdisjoint(words):
            return []
        pad = self.margin
        ids = np.full(len(words) + 2 * pad, -1, np.int64)
        ids[pad:pad + len(words)] = [self.number.get(w, -1) for w in words]
        starts: dict[int, list[np.ndarray]] = {}
        for word, postings in self.postings.items():
            at = np.flatnonzero(ids == word)
            if len(at):
                for k, j in postings:
                    starts.setdefault(k, []).append(at - j)
        found = []
        for k in sorted(starts):
            template, own = self.templates[k], self.words[k]
            at = np.unique(np.concatenate(starts[k]))
            weight = np.zeros(len(at), np.int64)
            for j, word in enumerate(own):
                near = np.zeros(len(at), bool)
                for off in range(-template.drift, template.drift + 1):
                    near |= ids[np.clip(at + j + off, 0, len(ids) - 1)] == word
                weight += self.weight[word] * near
            good = weight * 100 >= template.percent * self.total[k]
            at, weight = at[good], weight[good]
            for phrase in self.phrases[k]:
                if len(at):
                    stands = np.flatnonzero(np.logical_and.reduce([ids[i:len(ids) - len(phrase) + 1 + i] == w for i, w in enumerate(phrase)]))
                    first = np.searchsorted(stands, at - template.drift)
                    held = np.append(stands, len(ids) * 2)[first] + len(phrase) <= at + len(own) + template.drift
                    at, weight = at[held], weight[held]
            found += [(k, int(a) - pad, int(w)) for a, w in zip(at, weight)]
        return found

    def spans(self, words: list[bytes]) -> list[dict]:
        """Matches as (label, base, start, end, share), by start; words are counted from 0, ends exclusive.

        Of a notice's matches that start within two drifts of one another the best
        counts, then the first.
        """
        out: list[dict] = []
        last: tuple[int, int] | None = None
        for k, start, weight in self.places(words):
            template, share = self.templates[k], weight / self.total[k]
            span = {"label": template.label, "base": template.base, "start": start, "end": start + len(self.words[k]), "share": share}
            if not template.base and last is not None and last[0] == k and start - last[1] <= 2 * template.drift:
                if share > out[-1]["share"]:
                    out[-1] = span
            else:
                out.append(span)
            last = (k, start)
        return sorted(out, key=lambda s: (s["start"], s["end"], s["label"], not s["base"]))


def scan(
    docs: DataFrame, templates: list[Template] | None = None, column: str = "text", out: str = "licenses", n_words: str = "n_words",
) -> DataFrame:
    """``docs`` with ``n_words`` (long) and ``out``: array of (label, base, start, end, share), in words.

    ``share`` is the part of a template's weight that the text holds at its place; a
    start may lie before the text, an end behind it, where the notice is cut off. Word
    weights come from all of ``docs``. Null and empty texts have no words and an empty
    array; repeated rows count as documents of their own. All rows and other columns
    are kept, columns named ``out`` and ``n_words`` are replaced. An empty table gives
    an empty one.
    """
    templates = templates or TEMPLATES
    index = Index(templates, *document_counts(docs, templates, column))
    kept = [c for c in docs.columns if c not in (out, n_words)]
    span = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))

    def run(batches):
        for batch in batches:
            counts, found = [], []
            for text in batch.column(column):
                words = words_of((text.as_py() or "").encode())
                counts.append(len(words))
                found.append(index.spans(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(counts, pa.int64()), pa.array(found, span)], names=[*kept, n_words, out]
            )

    chosen = docs.select(*[F.col(f"`{c}`") for c in kept])
    kind = StructType().add("label", "string").add("base", "boolean").add("start", "long").add("end", "long").add("share", "double")
    return chosen.mapInArrow(run, StructType(list(chosen.schema.fields)).add(n_words, "long").add(out, ArrayType(kind)))
