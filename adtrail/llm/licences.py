"""Licence notices found by a positional index of rare words over licence templates.

The templates are short, well-known notices. Their words form the index: word -> (template, position). The corpus
says how rare each of these words is (document frequency over all documents). Each template is looked up by its own
rarest words, as many as weigh more together than a place that counts may lack: such a place holds one of them, whatever
else the text holds. A template is placed where the word's position in the text and in the template agree, and the
places vote: a template's score is the share of its words (weighted by rarity) that stand at their relative position.
A template counts if its score reaches ``least_score`` and its key phrase stands there in consecutive words. The base
phrases are in the index by their rarest word each, and count where all their words stand in a row around it.

Words are ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z; everything else parts words.

Defined cases: a null or empty text has no words, no labels and score 0; overlapping places all count; of places with
equal scores the first is kept; repeated rows each get a row; an empty corpus gives an empty table. Only the id and
text columns are read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm.words import blocks

#: Lower-cases A-Z and turns every ASCII byte that is not a digit or a letter into a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def fold(data: bytes | None) -> bytes:
    return (data or b"").translate(FOLD)


@dataclass(frozen=True)
class Template:
    """A notice, the label it stands for, and phrases of which each must stand in the text at the notice's place."""

    label: str
    notice: str
    required: tuple[str, ...]


# Usual wordings of licence notices.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2.0", ("apache license", "2 0")),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("gpl", "this work is licensed under the gnu general public license version 3", ("general public license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("gnu general public license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0", ("mozilla public license",)),
    Template("cc-by-sa", "licensed under cc by sa 4.0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4.0", ("cc by nc",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4.0 international license", ("creative commons attribution",)),
    Template("cc0", "this work is dedicated to the public domain under cc0 1.0 universal", ("cc0 1 0 universal",)),
    Template("public-domain", "this work is in the public domain", ("in the public domain",)),
    Template("proprietary", "confidential and proprietary do not distribute", ("confidential and proprietary",)),
)

# Phrases counted wherever their words stand in a row.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


class Index:
    """The positional index of ``templates``, with the rarity of its words in the corpus."""

    def __init__(self, templates: tuple[Template, ...], seen: Mapping[bytes, int], total: int, least_score: float):
        self.templates, self.least_score = templates, least_score
        self.words = [fold(t.notice.encode()).split() for t in templates]
        self.required = [[b" " + b" ".join(fold(r.encode()).split()) + b" " for r in t.required] for t in templates]
        phrases = {label: phrase.encode().split() for phrase, label in BASE_PHRASES.items()}
        self.idf = {w: math.log((total + 1) / (seen.get(w, 0) + 1)) + 1e-9 for words in (*self.words, *phrases.values()) for w in words}
        self.weight = [sum(self.idf[w] for w in words) for words in self.words]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, words in enumerate(self.words):
            held = 0.0
            for word in sorted(set(words), key=lambda w: (-self.idf[w], w)):
                if held > (1 - least_score) * self.weight[t] * (1 + 1e-9):
                    break
                places = [at for at, w in enumerate(words) if w == word]
                self.postings[word] += [(t, at) for at in places]
                held += self.idf[word] * len(places)
        self.anchors: dict[bytes, list[tuple[list[bytes], int, str]]] = defaultdict(list)
        for label, words in phrases.items():
            place = max(range(len(words)), key=lambda i: self.idf[words[i]])
            self.anchors[words[place]].append((words, place, label))
        self.lookups = frozenset([*self.postings, *self.anchors])

    def find(self, words: list[bytes], held: set[bytes]) -> dict[str, float]:
        """Label to best score, of the templates that stand in ``words``. ``held``: the looked-up words among them."""
        hinted: set[tuple[int, int]] = set()
        for at, word in enumerate(words):
            if word in held:
                for template, place in self.postings.get(word, ()):
                    hinted.add((template, at - place))
        out: dict[str, float] = {}
        for template, start in sorted(hinted):
            expected = self.words[template]
            there = words[max(start, 0) : start + len(expected)]
            shift = max(-start, 0)
            score = sum(self.idf[w] for w, x in zip(expected[shift:], there, strict=False) if w == x) / self.weight[template]
            label = self.templates[template].label
            if score >= self.least_score and score > out.get(label, 0):
                stretch = b" " + b" ".join(there) + b" "
                if all(phrase in stretch for phrase in self.required[template]):
                    out[label] = score
        return out

    def base_places(self, words: list[bytes], held: set[bytes]) -> list[tuple[int, str]]:
        """(word position, label) of every place where a base phrase's words stand in a row."""
        out = []
        for anchor in held.intersection(self.anchors):
            at = -1
            for _ in range(words.count(anchor)):
                at = words.index(anchor, at + 1)
                for phrase, place, label in self.anchors[anchor]:
                    if at >= place and words[at - place : at - place + len(phrase)] == phrase:
                        out.append((at - place, label))
        return out


def document_frequencies(docs: DataFrame, text: str, vocabulary: set[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many rows each word of ``vocabulary`` stands, and the number of rows; the result is as small as the vocabulary."""
    wanted = frozenset(vocabulary)

    def count(batches):
        seen, rows = Counter(), 0
        for batch in batches:
            rows += batch.num_rows
            for data in batch.column(0).to_pylist():
                seen.update(wanted.intersection(fold(data).split()))
        words = [None, *seen]
        yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.binary()), "n": pa.array([rows, *seen.values()], pa.int64())})

    slim = docs.select(F.col(text).cast("string").cast("binary"))
    rows = slim.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {None if r["word"] is None else bytes(r["word"]): r["n"] for r in rows}
    total = found.pop(None, 0)
    return found, total


def scan_licences(docs: DataFrame, id: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES, least_score: float = 0.8) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    Word counts of the templates' words over the corpus reach the driver, nothing else.
    """
    vocabulary = {w for notice in (*(t.notice for t in templates), *BASE_PHRASES) for w in fold(notice.encode()).split()}
    seen, total = document_frequencies(docs, text, vocabulary)
    slim = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").cast("binary").alias("_text"))
    kind = slim.schema["_id"].dataType.simpleString()
    fields = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]

    def judge(index: Index, data: bytes | None) -> tuple:
        words = fold(data).split()
        held = index.lookups.intersection(words)
        places = index.base_places(words, held) if held else []
        base = {label for _, label in places}
        own = index.find(words, held) if held else {}
        at = [p for p, _ in places]
        score = 1.0 if base else max(own.values(), default=0.0)
        return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(own))), min(score, 1.0)

    def run(batches):
        index = Index(templates, seen, total, least_score)
        for batch in batches:
            for start, end in blocks(batch, "_text"):
                part = batch.slice(start, end - start)
                rows = [judge(index, data) for data in part.column("_text").to_pylist()]
                columns = [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([part.column("_id"), *columns], names=["_id", *[n for n, _ in fields]])

    schema = f"_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    return slim.mapInArrow(run, schema).withColumnRenamed("_id", id)
