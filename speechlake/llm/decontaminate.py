"""Find passages of a benchmark in documents and take them, or the documents, out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.llm.text import NOT_WORD, ascii_lower, digest, split_words
from speechlake.operators.checkpoints import settle

WIDTH = 10  # words in a window
SLICE = 200_000  # windows that are broadcast at once, some 30 MB


def benchmark_windows(items: DataFrame, text: str = "text", item_id: str = "item_id", width: int = WIDTH) -> DataFrame:
    """``item, window, length``: every run of ``width`` words of an item; the whole of a shorter one."""
    words = items.select(F.col(item_id).alias("item"), split_words(ascii_lower(F.col(text)), NOT_WORD).alias("_w")
                         ).where(F.size("_w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - width + 1, F.lit(1)))
    return words.select("item", "_w", F.explode(starts).alias("_at")).select(
        "item", F.array_join(F.slice("_w", F.col("_at"), width), " ").alias("window"),
        F.least(F.size("_w"), F.lit(width)).alias("length")).distinct()


def find_hits(docs: DataFrame, windows: DataFrame, text: str = "text", doc_id: str = "doc_id",
              slice_size: int = SLICE) -> DataFrame:
    """``doc, text_digest, start, length, window``: where the windows occur, counted in words from 1.

    The windows are a broadcast hash set keyed by the hash of their word hashes; each document row probes it
    at every word inside one generated stage, without a shuffle, and a probe counts only if the words
    are the same. More windows than ``slice_size`` are probed slice by slice, so a broadcast stays small
    whatever the benchmark's size.
    """
    distinct = settle(windows.select("window", "length").distinct())
    lengths = [r[0] for r in distinct.select("length").distinct().collect()]  # WIDTH values at most
    slices = max(1, -(-distinct.count() // slice_size))
    parts = F.split("window", " ")
    known = distinct.select(
        "window", F.col("length").alias("_length"),
        F.xxhash64(F.transform(parts, lambda w: F.xxhash64(w))).alias("_key"))
    words = docs.select(F.col(doc_id).alias("doc"), digest(F.col(text)).alias("text_digest"),
                        split_words(ascii_lower(F.col(text)), NOT_WORD).alias("_w"))
    hashed = words.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    probes = []
    for length in lengths:
        # an array of as many words has this many windows; a shorter one has none
        starts = F.when(F.size("_h") >= length, F.sequence(F.lit(1), F.size("_h") - (length - 1)))
        probed = hashed.select("doc", "text_digest", "_w", "_h", F.explode(starts).alias("start")).withColumn(
            "_probe", F.xxhash64(F.slice("_h", F.col("start"), length)))
        for k in range(slices):
            mine = known.where((F.col("_length") == length) & (F.pmod(F.col("_key"), F.lit(slices)) == k))
            probes.append(probed.join(F.broadcast(mine), F.col("_probe") == F.col("_key")).where(
                F.array_join(F.slice("_w", F.col("start"), length), " ") == F.col("window")
            ).select("doc", "text_digest", "start", F.lit(length).alias("length"), "window"))
    if not probes:
        return words.select("doc", "text_digest", F.lit(0).alias("start"), F.lit(0).alias("length"),
                            F.lit("").alias("window")).limit(0)
    return reduce(DataFrame.unionByName, probes)


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id", width: int = WIDTH) -> DataFrame:
    """``doc, text_digest, spans, n_hit, items`` for every document that holds a window.

    ``spans`` are the hit stretches ``(start, length)`` in words from 1, merged; ``items`` the ids of the
    items found, as sorted strings (null ids left out). Repeated rows are reported once.
    """
    windows = settle(benchmark_windows(items, item_text, item_id, width))
    hits = settle(find_hits(docs, windows, text, doc_id))
    key = ["doc", "text_digest"]
    merged = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "length"))),
        F.expr("cast(array() as array<struct<start:int,length:int>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["start"] + F.element_at(done, -1)["length"] >= x["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"),
                F.greatest(F.element_at(done, -1)["length"],
                           x["start"] + x["length"] - F.element_at(done, -1)["start"]).alias("length"))))
        ).otherwise(F.concat(done, F.array(x))))
    spans = hits.groupBy(*key).agg(merged.alias("spans"))
    found = hits.select(*key, "window").distinct().join(windows.select("window", "item"), "window").select(
        *key, F.col("item").cast("string").alias("item")).distinct().groupBy(*key).agg(
        F.array_sort(F.collect_list("item")).alias("items"))
    s, i = spans.alias("s"), found.alias("i")
    return s.join(i, F.col("s.doc").eqNullSafe(F.col("i.doc")) & (F.col("s.text_digest") == F.col("i.text_digest"))
                  ).select("s.doc", "s.text_digest", "s.spans",
                           F.aggregate("s.spans", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("n_hit"),
                           "i.items")


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  mode: str = "documents", item_text: str = "text", least: int = 1, **names) -> DataFrame:
    """The documents without those that hold a window (``documents``), or without the words hit (``spans``).

    All columns stay. A null or empty text holds nothing and stays. In mode ``spans`` a word goes with the
    characters up to the next word; an empty benchmark changes nothing. Items of fewer than ``least`` words are left
    out: a word or two stand in clean documents as well. Runs jobs.
    """
    items = items.where(F.size(split_words(F.col(item_text), NOT_WORD)) >= least)
    names["item_text"] = item_text
    found = settle(contamination(docs, items, text, doc_id, **names).select(
        F.col("doc").alias("__doc"), F.col("text_digest").alias("__digest"), F.col("spans").alias("__spans")))
    same = docs[doc_id].eqNullSafe(found["__doc"]) & (digest(docs[text]) == found["__digest"])
    if mode == "documents":
        return docs.join(found, same, "left_anti")
    pieces = F.regexp_extract_all(F.col(text), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
                                                     r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"), F.lit(0))
    lead = F.regexp_extract(F.col(text), r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    # kept pieces: those between the spans, found from the spans alone
    bounds = F.concat(F.array(F.struct(F.lit(1).alias("start"), F.lit(0).alias("length"))), F.col("__spans"),
                      F.array(F.struct((F.size("__pieces") + 1).alias("start"), F.lit(0).alias("length"))))
    kept = F.transform(F.sequence(F.lit(1), F.size("__bounds") - 1), lambda k: F.array_join(F.slice(
        "__pieces", F.element_at("__bounds", k)["start"] + F.element_at("__bounds", k)["length"],
        F.element_at("__bounds", k + 1)["start"] - F.element_at("__bounds", k)["start"]
        - F.element_at("__bounds", k)["length"]), ""))
    cut = docs.join(found, same, "left").withColumn("__pieces", pieces).withColumn("__bounds", bounds)
    cleaned = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(F.concat(lead, F.array_join(kept, "")))
    return cut.withColumn("__cleaned", cleaned).select(
        *[F.col("__cleaned").alias(c) if c == text else F.col(c) for c in docs.columns])


def document_hits(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", **names) -> DataFrame:
    """``doc_id, n_words, n_hit, items``: one row for each document, hit or not. Runs jobs."""
    found = settle(contamination(docs, items, text, doc_id, **names))
    rows = docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("_digest"),
                       F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")),
                                  F.lit(0)).cast("long").alias("n_words"))
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("_digest") == F.col("text_digest")),
                     "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))
