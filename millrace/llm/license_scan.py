"""Licence notices in documents, by a trained paragraph classifier whose finds templates confirm.

A segment is a line or a paragraph (up to a blank line), or 32 words of a longer one, every 16 words, so that
wrapped notices are found. A softmax regression over
hashed word 1- to 3-grams names its family, "unknown" (licence talk of no known family) or "none". It is
trained here: on the notices below, mixed into ordinary text and with words dropped, on invented licence names,
and on at most ``TRAIN_TEXTS`` pieces of documents. A temperature fitted on examples set aside calibrates
the probabilities. A family is only reported as confirmed if the segment also holds most word pairs of one of
its notices; else it counts as unknown.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import registered, table
from millrace.llm.words import SIGNS, U64, ByteHash, Words, mix

# Usual notices, by family.
NOTICES = {
    "apache": ("Licensed under the Apache License, Version 2.0", "under the Apache License Version 2.0 the License you may not use this file except in compliance with the License",
               "distributed under the terms of the Apache 2.0 license"),
    "mit": ("Released under the MIT License", "This software is licensed under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "bsd": ("Licensed under the BSD 3-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "released under the 2-clause BSD license"),
    "gpl": ("This work is licensed under the GNU General Public License, version 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
            "licensed under the GNU GPL v2 or later", "under the terms of the GNU Lesser General Public License", "GNU Affero General Public License version 3"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "licensed under the Mozilla Public License 2.0"),
    "creative_commons": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
                         "released under CC BY-SA 3.0", "licensed under CC BY 4.0", "dedicated to the public domain under CC0 1.0"),
    "reserved": ("All rights reserved", "Copyright 2020 the authors. All rights reserved", "no part of this publication may be reproduced without permission"),
}
_SKELETONS = ("licensed under the {} license", "released under the {} license version {}", "distributed under the terms of the {} public license",
              "this work is licensed under {}", "see the {} license for the terms of use", "usage is governed by the {} license agreement")

FAMILIES = [*NOTICES, "unknown", "none"]
NONE, UNKNOWN = FAMILIES.index("none"), FAMILIES.index("unknown")
SEGMENT, STEP = 32, 16
TRAIN_TEXTS, TRAIN_CHARACTERS, COPIES, SEED = 400, 4000, 40, 7
#: Hashed n-grams; the least calibrated probability; the share of a notice's word pairs a find must hold.
DIMENSIONS, GRAMS, LEAST, CONFIRM = 1 << 16, 3, 0.6, 0.6

_HASH = ByteHash(71, lower=True)


def _grams(hashes: np.ndarray, paragraph: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n: the words an n-gram of one paragraph begins at, and the n-gram's feature."""
    out = []
    for n in range(1, GRAMS + 1):
        values = _HASH.windows(hashes, n)
        first = np.flatnonzero(paragraph[:len(values)] == paragraph[n - 1:]) if len(values) else np.empty(0, dtype=np.int64)
        out.append((first, (mix(values[first] + U64(n)) % U64(DIMENSIONS)).astype(np.int64)))
    return out


class _Text:
    """Words, paragraphs and segments of a batch."""

    def __init__(self, column: pa.Array):
        self.words = Words(column, SIGNS)
        feeds = np.concatenate([[0], np.cumsum(self.words.data == 0x0A)])
        self.owners = self.words.owners()
        before = np.diff(feeds[self.words.starts], prepend=0)  # line feeds between a word and the one before it
        text = np.diff(self.owners, prepend=-1) != 0
        self.paragraph = np.cumsum(text | (before > 1)) - 1
        parts = np.concatenate([self._windows(np.cumsum(text | (before > least)) - 1) for least in (0, 1)], axis=1)
        self.starts, self.ends = np.unique(parts, axis=1)
        self.hashes = self.words.hashes(_HASH)

    @staticmethod
    def _windows(part: np.ndarray) -> np.ndarray:
        """First words and ends of the windows over each part, a run of equal numbers."""
        first, size = np.unique(part, return_index=True, return_counts=True)[1:]
        inside, length = np.arange(len(part)) - first[part], size[part]
        starts = np.flatnonzero((inside % STEP == 0) & ((inside == 0) | (inside + STEP < length)))
        return np.stack([starts, np.minimum(starts + SEGMENT, starts + length[starts] - inside[starts])])

    def segment_words(self, k: int) -> list[str]:
        return [self.words.data[self.words.starts[i]:self.words.ends[i]].tobytes().decode("utf-8", "replace").lower()
                for i in range(self.starts[k], self.ends[k])]


@dataclass
class Model:
    weights: np.ndarray  # DIMENSIONS x families
    bias: np.ndarray
    temperature: float = 1.0

    def scores(self, text: _Text) -> np.ndarray:
        """Raw scores of each segment."""
        z = np.zeros((len(text.hashes) + 1, len(FAMILIES)))
        for first, features in _grams(text.hashes, text.paragraph):
            z[first + 1] += self.weights[features]
        np.cumsum(z, axis=0, out=z)
        return z[text.ends] - z[text.starts] + self.bias

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        z = scores / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


def _plain(text: str) -> list[str]:
    return "".join(c if not (c.isascii() and not c.isalnum()) else " " for c in text).lower().split()


_NOTICE_PAIRS = {family: [_pairs(_plain(n)) for n in notices] for family, notices in NOTICES.items()}


def template_match(words: list[str]) -> tuple[str | None, float]:
    """The family whose notice the words hold most of, and the share of its word pairs."""
    have = _pairs(words)
    best = max(((len(p & have) / len(p), family) for family, ps in _NOTICE_PAIRS.items() for p in ps))
    return (best[1], best[0]) if best[0] > 0 else (None, 0.0)


def examples(texts: list[str], seed: int = SEED) -> tuple[list[list[str]], np.ndarray]:
    """Training segments and their classes."""
    rng = np.random.default_rng(seed)
    plain, out, classes = [], [], []
    for text in texts:
        for line in text.split("\n"):
            words = _plain(line)
            plain += [words[i:i + SEGMENT] for i in range(0, len(words), SEGMENT) if len(words[i:i + SEGMENT]) > 1]
    plain = [w for w in plain if template_match(w)[1] < CONFIRM]
    fill = [w for s in plain[:2000] for w in s] or ["text"]

    def around(words: list[str]) -> list[str]:
        room = max(0, SEGMENT - len(words))
        before, after = (int(rng.integers(0, room // 2 + 1)) if rng.random() < 0.6 else 0 for _ in range(2))
        at = int(rng.integers(0, max(1, len(fill) - SEGMENT)))
        return fill[at:at + before] + words + fill[at + before:at + before + after]

    for family, notices in NOTICES.items():
        for notice in notices:
            words = _plain(notice)
            for _ in range(COPIES):
                kept = [w for w in words if rng.random() > 0.08] or words
                out.append(around(kept)[:SEGMENT + 16])
                classes.append(FAMILIES.index(family))
    names = [w for s in plain[:500] for w in s] + ["zlib", "eclipse", "python", "artistic", "vendor", "acme", "custom"] * 20
    for skeleton in _SKELETONS:
        for _ in range(COPIES):
            out.append(around(_plain(skeleton.format(*(names[int(rng.integers(len(names)))] for _ in range(2))))))
            classes.append(UNKNOWN)
    order = rng.permutation(len(plain))[:4000]
    out += [plain[i] for i in order] + [[]]
    classes += [NONE] * (len(order) + 1)
    return out, np.array(classes)


def train(segments: list[list[str]], classes: np.ndarray, rounds: int = 150, ridge: float = 1e-4) -> Model:
    """Softmax regression by Adagrad on four fifths of the examples; the temperature on the rest."""
    features, owners = [], []
    for k, words in enumerate(segments):
        text = _Text(pa.array([" ".join(words)]))
        got = np.concatenate([f for _, f in _grams(text.hashes, np.zeros(len(text.hashes), dtype=np.int64))])
        features.append(got)
        owners.append(np.full(len(got), k))
    features, owners, n = np.concatenate(features), np.concatenate(owners), len(segments)
    used, compact = np.unique(features, return_inverse=True)  # only these get weights
    aside = np.arange(n) % 5 == 4
    y = np.eye(len(FAMILIES))[classes]
    weights, bias = np.zeros((len(used), len(FAMILIES))), np.zeros(len(FAMILIES))
    square, square_b = np.full_like(weights, 1e-6), np.full_like(bias, 1e-6)
    share = 1 / np.maximum(np.bincount(classes, minlength=len(FAMILIES)), 1)[classes]
    share = np.where(aside, 0, share / share[~aside].sum())[:, None]

    def scores() -> np.ndarray:
        return np.column_stack([np.bincount(owners, weights=weights[compact, c], minlength=n) for c in range(len(FAMILIES))]) + bias

    for _ in range(rounds):
        z = scores()
        p = np.exp(z - z.max(axis=1, keepdims=True))
        g = (p / p.sum(axis=1, keepdims=True) - y) * share
        grad = np.column_stack([np.bincount(compact, weights=g[owners, c], minlength=len(used)) for c in range(len(FAMILIES))]) + ridge * weights
        square += grad * grad
        weights -= 0.2 * grad / np.sqrt(square)
        square_b += g.sum(axis=0) ** 2
        bias -= 0.2 * g.sum(axis=0) / np.sqrt(square_b)
    z, full = scores()[aside], np.zeros((DIMENSIONS, len(FAMILIES)))
    full[used] = weights
    model, best = Model(full, bias), (np.inf, 1.0)
    for temperature in np.geomspace(0.25, 8, 26):
        model.temperature = float(temperature)
        loss = -np.log(np.maximum(model.probabilities(z)[np.arange(len(z)), classes[aside]], 1e-12)).mean() if len(z) else 0.0
        best = min(best, (loss, float(temperature)))
    model.temperature = best[1]
    return model


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", most: int = TRAIN_TEXTS, size: int = TRAIN_CHARACTERS) -> Model:
    """A model with ordinary text: ``most`` pieces of ``size`` characters, chosen by a hash among those of all whole texts."""
    chosen = docs.where(F.length(F.col(text).cast("string")) > 0).select(
        F.col(text).cast("string").alias("text"), F.xxhash64(F.col(doc_id), F.col(text)).alias("h"))
    pieces = F.ceil(F.length("text") / F.lit(size)).cast("int")
    total = chosen.agg(F.sum(pieces)).first()[0] or 0
    # a hash picks a few times as many first, so that tasks don't each send that many
    share = min(1.0, 4 * most / max(1, total))
    drawn = chosen.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).withColumn("h", F.xxhash64("h", "piece")).where(
        F.pmod("h", F.lit(1 << 40)) < int(share * (1 << 40)))
    some = drawn.select(F.substring("text", F.col("piece") * size + 1, F.lit(size)).alias("text"), "h")
    return train(*examples([r.text for r in some.orderBy("h", "text").limit(most).collect()]))


_FOUND = pa.list_(pa.struct([("family", pa.string()), ("confirmed", pa.bool_()), ("probability", pa.float64()), ("word", pa.int64())]))


def found_in(column: pa.Array, model: Model) -> list[list[dict]]:
    """For each text, its licence segments: family, whether a template confirms it, probability, first word."""
    text, out = _Text(column), [[] for _ in range(len(column))]
    if not len(text.starts):
        return out
    scores = model.scores(text)
    maybe = np.flatnonzero(scores.argmax(axis=1) != NONE)
    for k, p in zip(maybe, model.probabilities(scores[maybe])):
        family = int(p.argmax())
        if 1 - p[NONE] < LEAST:
            continue
        named, share = template_match(text.segment_words(k))
        confirmed = share >= CONFIRM and (family == UNKNOWN or FAMILIES[family] == named)
        if family == UNKNOWN and not confirmed and p[UNKNOWN] < LEAST:
            continue
        owner = int(text.owners[text.starts[k]])
        out[owner].append({"family": named if confirmed else "unknown", "confirmed": bool(confirmed), "probability": float(1 - p[NONE]),
                           "word": int(text.starts[k] - text.words.first[owner])})
    return out


def licenses(docs: DataFrame, model: Model | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, found), one row per input row; ``found`` lists (family, confirmed, probability, word).

    Segments overlap, so a notice may be found twice. Null and empty texts hold none; null and repeated ids are
    judged row by row; an empty table gives no rows. Other columns are ignored.
    """
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model or fit(chosen))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found_in(batch.column("text"), held.value), type=_FOUND)],
                                             names=["doc_id", "found"])

    return chosen.mapInArrow(run, "doc_id long, found array<struct<family:string,confirmed:boolean,probability:double,word:long>>")


@registered()
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the licence families they name."""
    families = F.array_sort(F.array_distinct(F.transform(F.filter("found", lambda x: x["confirmed"]), lambda x: x["family"])))
    return licenses(table(spark, folder, "documents")).select(
        "doc_id", F.array_join(families, ",").alias("families"),
        F.exists("found", lambda x: ~x["confirmed"]).alias("unknown"), F.size("found").alias("segments"))
