"""Licence statements: a paragraph classifier on word n-grams proposes families, templates confirm them."""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.llm.text import NOT_WORD, ascii_lower, split_words

COMMON = 3  # examples without a licence that must share an n-gram for it to be a feature, if no other example has it
LONG, STRIDE = 48, 24  # a paragraph of more words is read in overlapping windows
CONFIRM = 0.75  # share of a template's word triples in the window, or of the window's in the template
BACKGROUND = 3000  # paragraphs of the collection that are fitted as unknown, at most
UNKNOWN = "unknown"
GROUP = 1024  # windows that are scored at once

# fixed values: wording that the licences themselves prescribe or that is usual for naming them
TEMPLATES = {
    "apache-2.0": (
        "licensed under the apache license version 2.0", "released under the apache 2.0 license",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2.0",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    "mit": (
        "released under the mit license", "licensed under the mit license", "this project is available under the terms of the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    "bsd": (
        "licensed under the bsd license", "released under the 3 clause bsd license", "distributed under the new bsd license",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    "gpl": (
        "this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 2",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "released under the gpl v3"),
    "lgpl": (
        "licensed under the gnu lesser general public license version 3", "released under the lgpl v2.1",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    "agpl": (
        "licensed under the gnu affero general public license version 3", "released under the agpl v3",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2.0",
        "licensed under the mozilla public license version 2.0"),
    "cc-by": (
        "licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license"),
    "cc-by-sa": (
        "licensed under cc by sa 4.0", "this work is licensed under a creative commons attribution sharealike 4.0 international license"),
    "cc-by-nc": (
        "licensed under cc by nc 4.0", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
    "cc-by-nd": (
        "licensed under cc by nd 4.0", "this work is licensed under a creative commons attribution noderivatives 4.0 international license"),
    "cc0": (
        "released under cc0 1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    "isc": ("released under the isc license",
            "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
}
# fixed values: short names, used with the word license or an SPDX tag, and names that say it alone
NAMES = {
    "apache-2.0": ("apache 2.0", "apache", "apache version 2.0"), "mit": ("mit", "expat"), "bsd": ("bsd", "bsd 3 clause", "bsd 2 clause", "new bsd"),
    "gpl": ("gpl", "gnu gpl", "gpl 3.0", "gpl 2.0", "gnu general public", "gpl 3.0 or later", "gpl 2.0 only"),
    "lgpl": ("lgpl", "gnu lgpl", "lgpl 3.0", "lgpl 2.1", "gnu lesser general public"), "agpl": ("agpl", "agpl 3.0", "gnu affero general public"),
    "mpl": ("mpl 2.0", "mozilla public"), "cc-by": ("cc by 4.0", "creative commons attribution"),
    "cc-by-sa": ("cc by sa 4.0", "creative commons attribution sharealike"), "cc-by-nc": ("cc by nc 4.0", "creative commons attribution noncommercial"),
    "cc-by-nd": ("cc by nd 4.0", "creative commons attribution noderivatives"), "cc0": ("cc0 1.0", "cc0"), "isc": ("isc",), "unlicense": (),
}
BARE = {
    "apache-2.0": ("apache license 2.0",), "mit": (), "bsd": ("bsd 3 clause", "bsd 2 clause"), "gpl": ("gplv3", "gplv2", "gpl v3", "gpl v2", "gnu gpl"),
    "lgpl": ("lgplv3", "lgpl v3", "lgpl v2.1"), "agpl": ("agplv3", "agpl v3"), "mpl": ("mpl 2.0",), "cc-by": ("cc by 4.0",), "cc-by-sa": ("cc by sa 4.0",),
    "cc-by-nc": ("cc by nc 4.0",), "cc-by-nd": ("cc by nd 4.0",), "cc0": ("cc0 1.0",), "isc": (), "unlicense": ("the unlicense", "spdx license identifier unlicense"),
}
# fixed values: licences without a template here; they teach what an unlisted licence looks like
UNLISTED = ("eclipse public", "common development and distribution", "artistic", "boost software", "zlib", "european union public",
            "microsoft public", "open font", "academic free", "python software foundation", "open database", "postgresql", "proprietary")
FORMS = ("{} license", "license {}", "spdx license identifier {}", "licensed under the {} license", "released under the {} license", "distributed under the {} license")
OPEN_FORMS = ("licensed under the {} license", "released under the {} license", "published under the {} license", "distributed under the {} license",
              "spdx license identifier {}", "available under the terms of the {} license")
#: Sentences near the subject that are no licence.
NEAR_MISSES = (
    "you need a driving license to rent a car", "the license fee is due every year", "their license was revoked last month",
    "all rights reserved", "the general public is welcome", "the software is distributed on a disk", "the office issues a permit",
    "this work was published under another title", "a version of the song was released", "the mit campus and the apache tribe",
    "the terms of the agreement are public", "creative work needs common sense and attribution", "permission to enter is granted",
    "license", "a license", "mit", "apache", "the license plate of the car", "a license is needed to drive", "they studied at mit", "released under pressure",
    "the bridge was built under the public road", "the version was published under the title", "an artistic license of the author", "a public library",
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def ngrams(h: np.ndarray) -> list[np.ndarray]:
    """64-bit hashes of the word 1-, 2- and 3-grams that begin at each word; from word hashes."""
    grams, rolled = [], np.zeros(h.shape, np.uint64)
    for n in range(1, 4):
        m = h.shape[-1] - n + 1
        if m <= 0:
            break
        rolled = _mix(rolled[..., :m] * np.uint64(0x9E3779B97F4A7C15) + h[..., n - 1:n - 1 + m])
        grams.append(rolled)
    return grams


@dataclass
class Model:
    """Weights of each known n-gram (a last row of zeros stands for all others) for each family, then for licences without
    a template, then for no licence; and what accepts a proposal."""

    families: list[str]
    known: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    accept: float
    triples: dict[str, list[np.ndarray]]

    def __post_init__(self):
        self.near = np.zeros(1 << 20, bool)  # leading bits of the known n-grams
        self.near[self.known >> np.uint64(44)] = True

    def rows(self, grams: np.ndarray) -> np.ndarray:
        """Row of the weights of each n-gram."""
        at = np.full(grams.shape, len(self.known), np.int32)
        maybe = self.near[grams >> np.uint64(44)]
        found = np.searchsorted(self.known, grams[maybe]).astype(np.int32)
        same = self.known[np.minimum(found, len(self.known) - 1)] == grams[maybe]
        at[maybe] = np.where(same, found, len(self.known))
        return at

    def _softmax(self, z: np.ndarray) -> np.ndarray:
        e = np.exp((z - z.max(-1, keepdims=True)) / self.temperature)
        return e / e.sum(-1, keepdims=True)

    def probabilities(self, h: np.ndarray) -> np.ndarray:
        at = self.rows(np.unique(np.concatenate(ngrams(h)))) if len(h) else np.zeros(0, np.int32)
        return self._softmax(self.weights[at].sum(0) + self.bias)

    def many(self, h: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """:meth:`probabilities` of the windows ``h[begin:begin + length]``, none longer than ``LONG``, a row each."""
        column, none = np.arange(LONG), len(self.known)
        words = h[np.minimum(begin[:, None] + column, max(len(h) - 1, 0))]
        at = np.concatenate([np.where(column[:LONG - n] + n < length[:, None], self.rows(grams), none)
                             for n, grams in enumerate(ngrams(words))], 1)
        at.sort(1)
        at[:, 1:][at[:, 1:] == at[:, :-1]] = none  # an n-gram counts once, as in the fit
        used = np.flatnonzero((at < none).any(0))  # after the sort most columns are empty
        return self._softmax(self.weights[at[:, used]].sum(1) + self.bias)

    def confirm(self, family: str, h: np.ndarray) -> float:
        """Largest share of a template's word triples in the window; or of the window's, if it has 5 words or more.

        Templates of one or two words are looked up whole.
        """
        grams, best = [np.unique(g) for g in ngrams(h)], 0.0
        for size, template in self.triples[family]:
            if size > len(grams):
                continue
            own = grams[size - 1]
            shared = len(np.intersect1d(own, template))
            best = max(best, shared / len(template), shared / len(own) if size == 3 and len(h) >= 5 else 0.0)
        return best

    def judge(self, h: np.ndarray, p: np.ndarray) -> tuple[str, float, float] | None:
        """Family, probability and confirmation of a window of class probabilities ``p``; ``unknown``, with the
        probability of any licence, if no template confirms; None if no licence is likely enough."""
        if 1 - p[-1] < self.accept:
            return None
        best = int(p[:-1].argmax())
        share = self.confirm(self.families[best], h) if best < len(self.families) else 0.0
        if share >= CONFIRM:
            return self.families[best], float(p[best]), share
        return UNKNOWN, float(1 - p[-1]), share

    def scan(self, h: np.ndarray) -> tuple[str, float, float] | None:
        return self.judge(h, self.probabilities(h))


def statements(name: str) -> list[str]:
    """Templates of a family: its sentences, its short names in usual forms, and names that say it alone."""
    return [*TEMPLATES[name], *(form.format(n) for n in NAMES[name] for form in FORMS), *BARE[name]]


def _template(h: np.ndarray) -> tuple[int, np.ndarray]:
    grams = ngrams(h)
    return len(grams), np.unique(grams[-1])


def fit(hashes: dict[str, int], background: list[np.ndarray], rounds: int = 30, rate: float = 0.4, seed: int = 2) -> Model:
    """Sparse multinomial regression by stochastic gradient descent on varied templates, on licences of other names and on paragraphs without one.

    ``hashes`` has the word hash that Spark gives each word used here. A fifth of the examples calibrates: the temperature of least
    log loss, and the acceptance level above which at most one in 500 examples without a licence lies, 0.5 at least.
    """
    rng = random.Random(seed)
    h = lambda words: np.array([hashes[w] for w in words], np.int64).view(np.uint64)
    families = sorted(TEMPLATES)
    other, nothing = len(families), len(families) + 1
    filler = sorted({w for s in NEAR_MISSES for w in _words(s)} - {"mit", "apache", "license"})
    rows: list[tuple[np.ndarray, int]] = []

    def within(kept):
        around = [rng.choice(filler) for _ in range(rng.choice((0, 0, 2, 6)))]
        return h(around + kept if rng.random() < 0.5 else kept + around)

    for k, name in enumerate(families):
        for template in TEMPLATES[name]:
            words = _words(template)
            for _ in range(14):
                kept = [w for w in words if rng.random() > 0.04]
                if len(kept) > 14 and rng.random() < 0.4:
                    begin = rng.randint(0, len(kept) - 12)
                    kept = kept[begin:begin + rng.randint(12, len(kept))]
                rows.append((within(kept), k))
        for short in statements(name)[len(TEMPLATES[name]):]:
            words = _words(short)
            rows += [(h(words), k)] * 3 + [(within(words), k) for _ in range(3)]
    for said in UNLISTED:
        for form in dict.fromkeys(FORMS + OPEN_FORMS):
            words = _words(form.format(said))
            rows += [(h(words), other), (within(words), other)]
    for form in OPEN_FORMS:
        before, after = (h(_words(part)) for part in form.split("{}"))
        for _ in range(30):
            made = np.array([rng.getrandbits(64) for _ in range(rng.choice((1, 1, 2, 3)))], np.uint64)
            rows.append((np.concatenate([before, made, after]), other))
    for said in NEAR_MISSES:
        words = _words(said)
        for _ in range(12):
            rows.append((h([w for w in words if rng.random() > 0.1] or words), nothing))
    for _ in range(800):  # words that no example has, and plain ones, so that a small collection is no different
        made = np.array([rng.getrandbits(64) for _ in range(rng.choice((1, 2, 6, 20)))], np.uint64)
        rows.append((np.concatenate([made, h([rng.choice(filler) for _ in range(rng.choice((0, 0, 1, 3)))])]), nothing))
    rows += [(np.asarray(b, np.int64).view(np.uint64), nothing) for b in background]
    rng.shuffle(rows)
    inputs = [(np.unique(np.concatenate(ngrams(x))) if len(x) else np.zeros(0, np.uint64), y) for x, y in rows]
    held, train = inputs[::5], [x for i, x in enumerate(inputs) if i % 5]
    plain, times = np.unique(np.concatenate([x for x, y in train if y == nothing]), return_counts=True)
    known = np.union1d(plain[times >= COMMON], np.concatenate([x for x, y in train if y != nothing]))
    model = Model(families, known, np.zeros((len(known) + 1, nothing + 1)), np.zeros(nothing + 1), 1.0, 0.5, {})
    weights, bias = model.weights, model.bias
    held, train = ([(at[at < len(known)], y) for at, y in ((model.rows(x), y) for x, y in part)] for part in (held, train))
    for r in range(rounds):
        step = rate / (1 + r / 5)
        rng.shuffle(train)
        for at, y in train:
            z = weights[at].sum(0) + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            if abs(p[y]) < 1e-3:
                continue
            weights[at] -= step * (p / max(len(at), 1) ** 0.5 + 1e-4 * weights[at])
            bias -= step * 0.1 * p
    raw = np.array([weights[at].sum(0) + bias for at, _ in held])
    target = np.array([y for _, y in held])
    best = (np.inf, 1.0)
    for t in np.geomspace(0.2, 8, 25):
        e = np.exp((raw - raw.max(1, keepdims=True)) / t)
        p = e / e.sum(1, keepdims=True)
        best = min(best, (-np.log(np.maximum(p[np.arange(len(target)), target], 1e-9)).mean(), t))
    e = np.exp((raw - raw.max(1, keepdims=True)) / best[1])
    p = 1 - (e / e.sum(1, keepdims=True))[target == nothing, -1]
    accept = max(0.5, float(np.sort(p)[int(len(p) * 0.998)]) if len(p) else 0.5)
    triples = {name: [_template(h(_words(t))) for t in statements(name)] for name in families}
    return Model(families, known, weights.astype(np.float32), bias, best[1], min(accept, 0.9), triples)


def paragraphs(docs: DataFrame, text: str) -> DataFrame:
    """All columns and ``_lines``: the word hashes of each line of the text."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    return docs.withColumn("_lines", F.transform(lines, lambda x: F.transform(
        split_words(ascii_lower(x), NOT_WORD), lambda w: F.xxhash64(w))))


def train(docs: DataFrame, text: str = "text", key: str = "doc_id", background: int = BACKGROUND, seed: int = 2) -> Model:
    """Model with ``background`` paragraphs of the collection, drawn by a seeded hash, as examples without a licence.

    Drawn paragraphs that say licence or copyright are left out; each gives its first window. Runs two small jobs.
    """
    spark = docs.sparkSession
    said = [*NEAR_MISSES, *FORMS, *OPEN_FORMS, *UNLISTED, *(t for name in TEMPLATES for t in statements(name))]
    words = sorted({w for t in said for w in _words(t)})
    found = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect()
    ids = docs.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).orderBy(
        F.xxhash64(F.lit(seed), "_key"), "_key").limit(background // 4)
    lines = docs.join(F.broadcast(ids), F.col(key) == F.col("_key")).select(
        F.explode(F.slice(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: ~x.rlike(
            "(?i)licen[sc]e|copyright")), 1, 4)).alias("_line"))
    drawn = lines.select(F.slice(F.transform(split_words(ascii_lower(F.col("_line")), NOT_WORD), lambda w: F.xxhash64(w)),
                                 1, LONG).alias("h")).limit(background).collect()
    return _fitted(tuple((r.w, r.h) for r in found), tuple(tuple(r.h) for r in drawn), seed)


@lru_cache(maxsize=2)
def _fitted(words, drawn, seed) -> Model:
    return fit(dict(words), [np.array(d, np.int64) for d in sorted(drawn)], seed=seed)


def windows(length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, first word and number of words of each window: a paragraph, or the overlapping windows of a long one."""
    count = np.where(length > LONG, -(-(length - STRIDE) // STRIDE), np.minimum(length, 1))
    line = np.repeat(np.arange(len(length)), count)
    at = (np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    return line, at, np.minimum(LONG, length[line] - at)


def scan(docs: DataFrame, model: Model, text: str = "text", out: str = "licenses") -> DataFrame:
    """All columns and ``out``: array of ``(line, family, probability, confirmed)``, by line, from 1.

    The classifier scores every window of every line. One entry for each line and family: the best window.
    ``unknown`` is a licence that no template confirms, listed or not. Long texts are scored window by window, ``GROUP``
    at once. Null, empty and word-less texts give an empty array. A column already named ``out`` is replaced.
    """
    entry = pa.list_(pa.struct([("line", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("confirmed", pa.float64())]))

    @F.arrow_udf("array<struct<line:int,family:string,probability:double,confirmed:double>>")
    def found(texts: pa.Array) -> pa.Array:
        lines = texts.flatten()
        h = lines.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)
        first_line = np.asarray(texts.offsets, np.int64) - texts.offsets[0].as_py()
        first_word = np.asarray(lines.offsets, np.int64) - (lines.offsets[0].as_py() if len(lines) else 0)
        line, at, length = windows(np.diff(first_word))
        begin = first_word[line] + at
        best: list[dict[tuple[int, str], tuple[float, float]]] = [{} for _ in range(len(texts))]
        owner = np.repeat(np.arange(len(texts)), np.diff(first_line))
        for g in range(0, len(line), GROUP):
            p = model.many(h, begin[g:g + GROUP], length[g:g + GROUP])
            for k in np.flatnonzero(1 - p[:, -1] >= model.accept):
                w, row = g + k, owner[line[g + k]]
                got = model.judge(h[begin[w]:begin[w] + length[w]], p[k])
                if got is None:
                    continue
                key = int(line[w] - first_line[row]) + 1, got[0]
                if (got[1], got[2]) > best[row].get(key, (-1.0, -1.0)):
                    best[row][key] = got[1], got[2]
        return pa.array([[{"line": k, "family": f, "probability": p, "confirmed": c} for (k, f), (p, c) in sorted(b.items())] for b in best], entry)

    return paragraphs(docs, text).withColumn(out, found("_lines")).drop("_lines")
