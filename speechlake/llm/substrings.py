"""Passages that stand earlier in the collection: relative Lempel-Ziv factors over content-defined blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.llm.text import digest, split_words
from speechlake.operators.checkpoints import settle

WINDOW = 20  # words of a passage
GRAM = 4  # words of an anchor
ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd multipliers of the rolling hashes


def _rolled(words: np.ndarray, multiplier: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of ``word[t] * M ** t`` and the powers of the inverse of M, modulo 2 ** 64."""
    n = len(words)
    forward, inverse = np.full(n + 1, multiplier, np.uint64), np.full(n + 1, pow(multiplier, -1, 1 << 64), np.uint64)
    forward[0] = inverse[0] = 1
    forward, inverse = np.multiply.accumulate(forward), np.multiply.accumulate(inverse)
    sums = np.zeros(n + 1, np.uint64)
    np.add.accumulate(words * forward[:n], out=sums[1:])
    return sums, inverse


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def stretch_hashes(words: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """Hash of each stretch of words, the same wherever it stands."""
    source = words if which == 0 else _mixed(words)
    sums, inverse = _rolled(source, ODD[which])
    length = (end - begin).astype(np.uint64)
    return _mixed((sums[end] - sums[begin]) * inverse[begin] + length * np.uint64(0x2545F4914F6CDD1D))


def blocks(words: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor hash, first and last window start, and anchor place of each block of a text.

    Every window of ``window`` words chooses the smallest hash among its word n-grams, the leftmost of equals; it
    depends on the window's words alone. Successive windows that choose the same n-gram make a block.
    """
    n = len(words) - window + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty, empty
    begin = np.arange(len(words) - gram + 1)
    value = stretch_hashes(words, begin, begin + gram, 0)
    place, span, want = begin.copy(), 1, window - gram + 1
    low = value
    while span < want:  # smallest of a growing run of n-grams, by doubling
        step = min(span, want - span)
        left, right = low[:-step], low[step:]
        take = right < left
        place, low = np.where(take, place[step:], place[:-step]), np.where(take, right, left)
        span += step
    cut = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[cut[1:], len(place)] - 1
    return value[place[cut]], cut, last, place[cut]


def _word_hashes(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc"), digest(F.col(text)).alias("text_digest"), F.transform(
        split_words(F.col(text)), lambda w: F.xxhash64(w)).alias("words"))


def _arrow(rows: list[dict[str, np.ndarray]], schema: pa.Schema) -> pa.RecordBatch:
    joined = {f.name: np.concatenate([r[f.name] for r in rows]) if rows else [] for f in schema}
    return pa.RecordBatch.from_arrays([pa.array(joined[f.name], f.type, from_pandas=True) for f in schema], schema=schema)


def document_blocks(docs: DataFrame, text: str, doc_id: str, window: int, gram: int) -> DataFrame:
    """``doc, text_digest, anchor, phrase, first, last``: the blocks of every text.

    ``first`` and ``last`` are the window starts; ``phrase`` is the hash of all words the block's windows cover.
    """
    key = docs.schema[doc_id].dataType.simpleString()
    types = [("text_digest", pa.int64()), ("anchor", pa.int64()), ("phrase", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids, pick = [], [], []
            for i, (mark, words) in enumerate(zip(batch["text_digest"].to_pylist(), batch["words"])):
                w = words.values.to_numpy(zero_copy_only=False).view(np.uint64)
                anchor, first, last, place = blocks(w, window, gram)
                if not len(anchor):
                    continue
                phrase = stretch_hashes(w, first, last + window, 1) + (place - first).astype(np.uint64)
                rows.append({"text_digest": np.full(len(anchor), mark), "anchor": anchor.view(np.int64),
                             "phrase": phrase.view(np.int64), "first": first, "last": last})
                pick.append(np.full(len(anchor), i))
            if rows:
                ids = batch["doc"].take(pa.array(np.concatenate(pick)))
                out = _arrow(rows, pa.schema(types))
                yield pa.RecordBatch.from_arrays([ids, *out.columns], names=["doc", *[t[0] for t in types]])

    return _word_hashes(docs, text, doc_id).mapInArrow(
        task, f"doc {key}, text_digest long, anchor long, phrase long, first long, last long")


def edge_windows(docs: DataFrame, wanted: DataFrame, text: str, doc_id: str, window: int) -> DataFrame:
    """``doc, text_digest, start, w0, w1``: single windows of the blocks named in ``wanted``."""
    key = docs.schema[doc_id].dataType.simpleString()
    types = [("text_digest", pa.int64()), ("start", pa.int64()), ("w0", pa.int64()), ("w1", pa.int64())]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pick = [], []
            for i, (mark, words, spans) in enumerate(zip(batch["text_digest"].to_pylist(), batch["words"], batch["spans"])):
                w = words.values.to_numpy(zero_copy_only=False).view(np.uint64)
                at = spans.values
                first, last = (at.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                starts = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)]))
                rows.append({"text_digest": np.full(len(starts), mark), "start": starts,
                             "w0": stretch_hashes(w, starts, starts + window, 0).view(np.int64),
                             "w1": stretch_hashes(w, starts, starts + window, 1).view(np.int64)})
                pick.append(np.full(len(starts), i))
            if rows:
                out = _arrow(rows, pa.schema(types))
                ids = batch["doc"].take(pa.array(np.concatenate(pick)))
                yield pa.RecordBatch.from_arrays([ids, *out.columns], names=["doc", *[t[0] for t in types]])

    need = wanted.groupBy(F.col("doc").alias("_doc"), F.col("text_digest").alias("_digest")).agg(
        F.collect_list(F.struct("first", "last")).alias("spans"))
    texts = docs.select(F.col(doc_id).alias("doc"), digest(F.col(text)).alias("text_digest"), F.col(text).alias("_text"))
    found = texts.join(need, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("text_digest") == F.col("_digest")))
    return found.select("doc", "text_digest", F.transform(split_words(F.col("_text")), lambda w: F.xxhash64(w)).alias("words"),
                        "spans").mapInArrow(task, f"doc {key}, text_digest long, start long, w0 long, w1 long")


def earlier_windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
                    gram: int = GRAM) -> DataFrame:
    """``doc, text_digest, first, last``: runs of window starts whose words also start earlier. Runs jobs.

    Documents are factored against the blocks of the whole collection. A block whose phrase stands earlier (smaller
    doc_id, null last; then smaller digest; then earlier in the text) continues a factor with all its windows. A
    factor ends where a phrase is new though its anchor is known: there the words are compared window by window.
    Equal windows choose the same anchor, so an earlier equal window lies in an equal phrase or in another
    phrase of that anchor, and the first occurrences of the phrases are enough to find it. Anchors and phrases are counted
    before the shuffle, and only those that occur twice go on. Hashes that decide have 128 bits.
    """
    own = settle(document_blocks(docs, text, doc_id, window, gram).groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(F.col("anchor").alias("_anchor")))
    known = settle(document_blocks(docs, text, doc_id, window, gram).join(
        own, F.col("anchor") == F.col("_anchor"), "left_semi"))
    place = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "text_digest", "first", "last")
    phrases = settle(known.groupBy("anchor", "phrase").agg(F.min(place).alias("earliest")))
    later = known.join(phrases, ["anchor", "phrase"]).where(place != F.col("earliest")).select(
        "doc", "text_digest", "first", "last")
    several = phrases.groupBy(F.col("anchor").alias("_anchor")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    edges = phrases.join(several, F.col("anchor") == F.col("_anchor"), "left_semi").select("earliest.*")
    single = settle(edge_windows(docs, edges, text, doc_id, window))
    spot = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "text_digest", "start")
    first = single.groupBy("w0", "w1").agg(F.min(spot).alias("earliest"))
    repeated = single.join(first, ["w0", "w1"]).where(spot != F.col("earliest")).select(
        "doc", "text_digest", F.col("start").alias("first"), F.col("start").alias("last"))
    return later.unionByName(repeated)


def remove_repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
                    gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row: the words left, joined by one space.

    Words are runs without white space, unchanged. Null and empty texts have none and keep the empty text; texts shorter than
    the window keep everything. Rows with the same doc_id and text are one document with the same result. Runs jobs.
    """
    runs = settle(earlier_windows(docs, text, doc_id, window, gram).groupBy("doc", "text_digest").agg(
        F.collect_list("first").alias("first"), F.collect_list("last").alias("last")))
    texts = docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("_digest"),
                        F.coalesce(F.col(text), F.lit("")).alias("_text"))
    found = texts.join(runs, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("_digest") == F.col("text_digest")), "left")

    @F.pandas_udf("struct<n_words:long,n_removed:long,kept:string>")
    def cut(texts: pd.Series, firsts: pd.Series, lasts: pd.Series) -> pd.DataFrame:
        out = []
        for value, first, last in zip(texts, firsts, lasts):
            words = value.encode().split()  # splits at the six ASCII white space characters
            if first is None:
                out.append((len(words), 0, b" ".join(words).decode()))
                continue
            depth = np.zeros(len(words) + 1, np.int64)
            np.add.at(depth, np.asarray(first), 1)
            np.add.at(depth, np.asarray(last) + window, -1)
            gone = np.cumsum(depth)[:-1] > 0
            kept = b" ".join([words[i] for i in np.flatnonzero(~gone)])
            out.append((len(words), int(gone.sum()), kept.decode()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])

    return found.withColumn("_cut", cut("_text", "first", "last")).select("doc_id", "_cut.*")
