"""Remove repeated multi-line passages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechlake.llm.text import digest
from speechlake.operators.checkpoints import settle

LEAST = 2  # lines; a repeated passage of fewer is never removed


def line_windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST, chunk: bool = False) -> DataFrame:
    """``place, h, g`` of every ``least`` lines that follow each other, and their text; those of white space alone are left out."""
    lines = F.split(F.col(text), "\n")
    rows = docs.where(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc"), digest(F.col(text)).alias("text_digest"), lines.alias("_lines")
    ).where(F.size("_lines") >= least)

    def window(i: Column) -> Column:
        held = F.slice("_lines", i, least)
        said = [F.array_join(held, "\n").alias("chunk")] if chunk else []
        return F.struct(i.alias("start"), F.xxhash64(held).alias("h"), F.xxhash64(F.lit(1), held).alias("g"),
                        F.exists(held, lambda x: x.rlike(r"\S")).alias("said"), *said)

    rows = rows.select("doc", "text_digest", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("_lines") - least + 1), window)).alias("w")).where("w.said")
    place = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "text_digest", F.col("w.start").alias("start"))
    return rows.select(place.alias("place"), "w.h", "w.g", *(["w.chunk"] if chunk else []))


def repeated_windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST) -> DataFrame:
    """``doc, text_digest, start`` of every ``least`` lines that stand earlier too, without sharing a line.

    Earlier: a smaller doc_id (null last), then a smaller digest of the text, then a smaller start. A longer passage that
    stands earlier is all of its windows. Windows meet by two hashes and those that repeat are compared byte by byte: if the
    smallest and the largest text under a key differ, the key is no repetition. Aggregates are partial, so a passage that
    a third of the documents share is one row from each task.
    """
    first = settle(line_windows(docs, text, doc_id, least).groupBy("h", "g").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("h", "g", "first"))
    met = settle(line_windows(docs, text, doc_id, least, chunk=True).join(first, ["h", "g"]))
    same = met.groupBy("h", "g").agg((F.min("chunk") == F.max("chunk")).alias("same")).where("same").select("h", "g")
    here, there = F.col("place"), F.col("first")
    own = here["doc"].eqNullSafe(there["doc"]) & (here["text_digest"] == there["text_digest"])
    return met.select("h", "g", "place", "first").join(same, ["h", "g"]).where(
        ~own | (here["start"] >= there["start"] + least)).select("place.doc", "place.text_digest", "place.start")


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n_chars: str | None = "n_chars",
                counts: bool = False, least: int = LEAST) -> DataFrame:
    """The documents without their repeated passages of ``least`` lines or more; all rows and columns stay, in no order.

    The first occurrence of a passage stays. A null text stays null, a text whose lines all go becomes empty; rows
    with the same doc_id and text are one document and keep the same lines. A column named ``n_chars``
    is set to the new length where a text changed. ``counts`` adds ``n_lines, n_removed``. Runs a job.
    """
    covered = F.flatten(F.transform(F.collect_set("start"), lambda s: F.sequence(s, s + least - 1)))
    gone = repeated_windows(docs, text, doc_id, least).groupBy("doc", "text_digest").agg(F.transform(
        F.array_sort(F.array_distinct(covered)), lambda i: F.struct(i.alias("start"), F.lit(1).alias("n_lines"))).alias("__gone")
    ).select(F.col("doc").alias("__doc"), F.col("text_digest").alias("__digest"), "__gone")
    lines = F.split(F.col(text), "\n")
    cut = docs.join(gone, docs[doc_id].eqNullSafe(gone["__doc"]) & (digest(docs[text]) == gone["__digest"]), "left")
    cut = cut.withColumn("__lines", lines)
    stop = F.struct(F.lit(0).alias("start"), F.lit(1).alias("n_lines"))
    end = F.struct((F.size("__lines") + 1).alias("start"), F.lit(0).alias("n_lines"))
    cut = cut.withColumn("__bounds", F.concat(F.array(stop), F.col("__gone"), F.array(end)))

    def between(k: Column) -> Column:
        here, after = F.element_at("__bounds", k), F.element_at("__bounds", k + 1)
        begin = here["start"] + here["n_lines"]
        return F.slice("__lines", begin, after["start"] - begin)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(1), F.size("__bounds") - 1), between)), "\n")
    cut = cut.withColumn("__kept", F.when(F.col("__gone").isNull(), F.col(text)).otherwise(kept))
    columns = [
        F.col("__kept").alias(c) if c == text
        else F.when(F.col("__gone").isNull(), F.col(c)).otherwise(F.length("__kept")).cast(docs.schema[c].dataType).alias(c)
        if c == n_chars else F.col(c) for c in docs.columns]
    if counts:
        columns += [F.coalesce(F.when(F.col(text).isNotNull(), F.size("__lines")), F.lit(0)).cast("long").alias("n_lines"),
                    F.aggregate(F.coalesce("__gone", F.expr("cast(array() as array<struct<start:int,n_lines:int>>)")),
                                F.lit(0).cast("long"), lambda n, x: n + x["n_lines"]).alias("n_removed")]
    return cut.select(*columns)
