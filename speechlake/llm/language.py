"""Language of a text: averaged hashed subword embeddings under a linear softmax, with rejection."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKETS = 1 << 14  # rows of the embedding table
DIMENSIONS = 16
GRAMS = (2, 3, 4)  # characters of a subword
ROWS_PER_LANGUAGE = 300  # labelled rows that are fitted or calibrated on, for each language, at most
PARTS = 16  # groups of tasks that rank the rows of a label first
STEP = 1 << 20  # characters looked at together
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter, for all code points."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def subwords(text: str) -> Iterator[np.ndarray]:
    """Buckets of all subwords of a text in lower case, in arrays of bounded size.

    Runs of anything but letters count as one boundary mark; a subword may begin or end with one,
    but does not reach across.
    """
    for at in range(0, len(text), STEP):
        # the last characters again, so that no subword is lost between two steps
        codes = np.frombuffer(text[max(0, at - 3):at + STEP].lower().encode("utf-32-le", "replace"), np.uint32)
        inside = _letters()[codes]
        codes = np.where(inside, codes, 32).astype(np.uint32)
        keep = np.ones(len(codes), bool)
        keep[1:] = inside[1:] | inside[:-1]
        codes, inside = codes[keep], inside[keep]
        if at == 0:
            codes, inside = np.concatenate(([np.uint32(32)], codes)), np.concatenate(([False], inside))
        if at + STEP >= len(text):
            codes, inside = np.concatenate((codes, [np.uint32(32)])), np.concatenate((inside, [False]))
        for n in GRAMS:
            m = len(codes) - n + 1
            if m <= 0:
                continue
            h = np.full(m, 2166136261 + n, np.uint32)
            for k in range(n):
                h = (h ^ codes[k:k + m]) * np.uint32(16777619)
            whole = np.ones(m, bool)
            for k in range(1, n - 1):
                whole &= inside[k:k + m]
            if n == 2:
                whole = inside[:m] | inside[1:1 + m]
            yield ((h ^ (h >> np.uint32(15)))[whole] * np.uint32(2654435761)) >> np.uint32(32 - 14)


@dataclass
class Model:
    """Score of each bucket for each language, and how totals become probabilities."""

    languages: list[str]
    scores: np.ndarray  # buckets x languages, float32
    bias: np.ndarray
    temperature: float
    few: float  # a text of so many subwords counts half
    reject_below: float

    def probabilities(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for part in subwords(text):
            total += self.scores[part].sum(0, dtype=np.float64)
            n += len(part)
        return self.calibrated((total / max(n, 1) + self.bias)[None, :], np.array([n]))[0]

    def calibrated(self, raw: np.ndarray, n: np.ndarray) -> np.ndarray:
        z = raw * (n / (n + self.few))[:, None] / self.temperature
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def labelled_sample(rows: DataFrame, text: str, label: str, key: str, per_language: int, seed: int) -> DataFrame:
    """Up to ``per_language`` rows of each label, by a seeded hash of the key: subword counts, not texts.

    The ranking reads keys and labels only. Spark keeps the first rows of each label in every task; groups of tasks
    rank them first, then what ``PARTS`` groups keep is ranked, at most ``PARTS * per_language`` rows of a label.
    The rows chosen do not depend on how the input is split.
    """
    order = [F.xxhash64(F.lit(seed), "_key"), F.col("_key")]
    keys = rows.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("_key"), F.col(label).alias("_label"),
        F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("_part"))
    for within in (["_label", "_part"], ["_label"]):
        keys = keys.withColumn("_rank", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).where(
            F.col("_rank") <= per_language)
    chosen = keys.select("_key").distinct()

    @F.pandas_udf("struct<bucket:array<int>,weight:array<float>,n:long>")
    def counted(texts: pd.Series) -> pd.DataFrame:
        out = []
        for value in texts:
            counts = np.zeros(BUCKETS, np.int64)
            for part in subwords(value):
                counts += np.bincount(part, minlength=BUCKETS)
            at = np.flatnonzero(counts)
            out.append((at.astype(np.int32), (counts[at] / max(counts.sum(), 1)).astype(np.float32), int(counts.sum())))
        return pd.DataFrame(out, columns=["bucket", "weight", "n"])

    return rows.where(F.col(label).isNotNull() & has_letter(F.col(text))).join(
        F.broadcast(chosen), F.col(key) == F.col("_key")).select(
        F.col(label).alias("label"), F.xxhash64(F.lit(seed + 1), F.col(key)).alias("draw"),
        counted(F.col(text)).alias("c")).select("label", "draw", "c.*")


def fit(sample: pd.DataFrame, epochs: int = 12, rate: float = 0.5, seed: int = 4) -> Model:
    """Fit by stochastic gradient descent, one text at a time; a fifth of the rows calibrates.

    The calibration rows set temperature and the weight of short texts (least log loss), and the score
    below which a prediction is rejected: that of the lowest thousandth of them, 0.5 at most.
    """
    sample = sample.sort_values("draw", kind="stable").reset_index(drop=True)
    languages = sorted(sample.label.unique())
    k, rng = len(languages), np.random.default_rng(seed)
    y = sample.label.map({name: i for i, name in enumerate(languages)}).to_numpy()
    rows = [(np.asarray(b, np.int64), np.asarray(w, np.float32)) for b, w in zip(sample.bucket, sample.weight)]
    held = np.arange(len(rows)) % 5 == 4 if len(rows) >= 20 else np.zeros(len(rows), bool)
    train = np.flatnonzero(~held)
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights, bias = rng.normal(0, 0.3, (DIMENSIONS, k)).astype(np.float32), np.zeros(k, np.float32)
    share = np.bincount(y[train], minlength=k) / max(len(train), 1)
    cost = 1 / np.maximum(share * k, 1e-3)  # rare languages weigh as much as common ones
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(train):
            at, w = rows[i]
            mean = w @ table[at]
            z = mean @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= np.float32(min(cost[y[i]], 10.0))
            back = weights @ p
            weights -= step * np.outer(mean, p)
            bias -= 0.1 * step * p
            table[at] -= (step * 20) * w[:, None] * back  # each subword's share of the mean is small
    scores = (table @ weights).astype(np.float32)
    model = Model(languages, scores, bias.astype(np.float64), 1.0, 0.0, 0.0)
    check = np.flatnonzero(held) if held.any() else train
    raw = np.array([rows[i][1] @ scores[rows[i][0]] + bias for i in check], np.float64).reshape(len(check), k)
    n, target = sample.n.to_numpy()[check], y[check]
    best = np.inf
    for temperature in np.geomspace(0.05, 5, 25):
        for few in (0.0, 2.0, 5.0, 10.0, 20.0):
            trial = Model(languages, scores, model.bias, temperature, few, 0.0)
            loss = -np.log(np.maximum(trial.calibrated(raw, n)[np.arange(len(check)), target], 1e-9)).mean()
            if loss < best - 1e-6:
                best, model.temperature, model.few = loss, temperature, few
    top = np.sort(model.calibrated(raw, n).max(1))
    model.reject_below = float(min(0.5, top[int(len(top) * 0.001)]))
    return model


def train(labelled: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id",
          per_language: int = ROWS_PER_LANGUAGE, seed: int = 4) -> Model | None:
    """Model of the labels that occur; None without labelled rows. Runs jobs.

    The driver receives at most ``per_language`` rows of each label, each of at most ``BUCKETS`` counts,
    whatever the length of the texts.
    """
    sample = labelled_sample(labelled, text, label, key, per_language, seed).toPandas()
    return fit(sample, seed=seed) if len(sample) else None


def predict(docs: DataFrame, model: Model | None, text: str = "text", prediction: str = "lang_pred",
            score: str = "lang_score") -> DataFrame:
    """All columns, the language and its calibrated probability.

    A text that is null or has no letter gets ``und`` and score 0, and so does every text without a model.
    """
    if model is None:
        return docs.withColumn(prediction, F.lit(UNKNOWN)).withColumn(score, F.lit(0.0))

    @F.pandas_udf("struct<lang:string,score:double>")
    def guess(texts: pd.Series, any_letter: pd.Series) -> pd.DataFrame:
        out = []
        for value, letter in zip(texts, any_letter):
            if not letter:
                out.append((UNKNOWN, 0.0))
                continue
            p = model.probabilities(value)
            best = int(p.argmax())
            out.append((model.languages[best], float(p[best])))
        return pd.DataFrame(out, columns=["lang", "score"])

    return docs.withColumn("__guess", guess(F.col(text), has_letter(F.col(text)))).withColumns({
        prediction: F.col("__guess.lang"), score: F.col("__guess.score")}).drop("__guess")


def keep_recognised(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The documents whose language the model recognises, with their columns as they were."""
    least = model.reject_below if model else 0.0
    return predict(docs, model, text, "__lang", "__score").where(
        (F.col("__lang") != UNKNOWN) & (F.col("__score") >= least)).select(*[F.col(c) for c in docs.columns])
