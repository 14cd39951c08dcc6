"""How quality filters interact: what each removes, in every order of applying them."""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechlake.llm.text import UPPER, split_words

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
SLOTS = len(ORDERS) * len(FILTERS)  # one for each step of each order
COPY = 1 << FILTERS.index("E")
SALTS = 1024  # parts over which rows without an id are dealt where labels are looked up


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails; a null text counts as an empty one.

    A: under 200 words; B: fewer than half of the words are distinct; C: over 3 % of the code points are A-Z; D: holds one of ``#$%&*|``.
    """
    text = F.coalesce(text, F.lit(""))
    words = split_words(text)
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    failed = {
        "A": F.size(words) < 200, "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        "C": 100 * capitals.cast("long") > 3 * F.length(text).cast("long"), "D": text.rlike(r"[#$%&*|]")}
    bits = [F.when(is_bad, 1 << FILTERS.index(name)).otherwise(0) for name, is_bad in failed.items()]
    return (bits[0] + bits[1] + bits[2] + bits[3]).cast("int")


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``part, mask, good, toxic, n``: documents for each set of failed filters (bits, A lowest) and their labels.

    E: a smaller doc_id has the same text (by SHA-256) anywhere in the table. Null ids are larger than all others and not smaller than each
    other; rows with the same id and text do not make each other copies. A null text is an empty one, a null part the empty
    string. ``good``: some label row of the id has quality 1; ``toxic`` alike. Texts leave the scan as digests and bits; every
    aggregate is partial, so a text that a third of the rows share is a few rows from each task.
    """
    rows = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(doc_id).alias("id"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"), failures(F.col(text)).alias("mask"))
    rows = rows.groupBy("part", "id", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    said = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"), F.lit(0).alias("_salt"))
    salt = F.when(F.col("id").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int")).otherwise(0)
    sure = F.coalesce("id", F.lit(0).cast(docs.schema[doc_id].dataType))  # with a salt above zero this meets no label
    rows = rows.withColumn("_salt", salt).withColumn("_id", sure).join(said, ["_id", "_salt"], "left").select(
        "part", "id", "digest", "mask", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    # rows of a text, by what is counted apart: how many, its smallest id, and how many have that id
    same = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n")).alias("low"))
    first = same.groupBy("digest").agg(F.min(F.struct("low.none", "low.id")).alias("first")).withColumnRenamed("digest", "_digest")
    same = same.join(first, F.col("digest") == F.col("_digest"))
    originals = F.when(F.struct("low.none", "low.id").eqNullSafe(F.col("first")), F.col("low.n")).otherwise(0)
    either = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), originals.alias("n")),
        F.struct(F.col("mask").bitwiseOR(COPY).alias("mask"), (F.col("n") - originals).alias("n"))))
    return same.select("part", "good", "toxic", either.alias("of")).where("of.n > 0").groupBy(
        "part", F.col("of.mask").alias("mask"), "good", "toxic").agg(F.sum("of.n").alias("n"))


@lru_cache(maxsize=256)
def outcomes(mask: int, width: int) -> tuple[int, int, int]:
    """What each of the 600 steps does with a document that fails the filters of ``mask``, as integers of 600 fields
    of ``width`` bits that hold one or zero: kept after the step, removed by it, failing its filter but removed before."""
    kept = removed = redundant = 0
    for k, order in enumerate(ORDERS):
        gone = False
        for step, name in enumerate(order):
            field = 1 << width * (k * len(FILTERS) + step)
            fails = bool(mask >> FILTERS.index(name) & 1)
            if fails and gone:
                redundant |= field
            elif fails:
                removed |= field
            gone = gone or fails
            if not gone:
                kept |= field
    return kept, removed, redundant


def unpack(packed: int, width: int) -> list[int]:
    """The 600 fields of an integer."""
    bits = format(packed, f"0{width * SLOTS}b")
    return [int(bits[len(bits) - width * (k + 1):len(bits) - width * k], 2) for k in range(SLOTS)]


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _sum_up(counts: pd.DataFrame) -> pd.DataFrame:
    """All steps of one part, from its at most 128 counts."""
    width = max(1, int(counts["n"].sum()).bit_length())  # no field can pass the number of documents
    kept = removed = redundant = good = toxic = 0
    alone = dict.fromkeys(FILTERS, 0)
    for row in counts.itertuples():
        n, (k, r, d) = int(row.n), outcomes(int(row.mask), width)
        kept, removed, redundant = kept + n * k, removed + n * r, redundant + n * d
        good += n * r if row.good else 0
        toxic += n * r if row.toxic else 0
        for at, name in enumerate(FILTERS):
            alone[name] += n if row.mask == 1 << at else 0
    fields = [unpack(x, width) for x in (kept, removed, redundant, good, toxic)]
    names = [name for order in ORDERS for name in order]
    shapley = dict.fromkeys(FILTERS, 0)
    for name, lost in zip(names, fields[1]):
        shapley[name] += lost
    return pd.DataFrame({
        "part": counts["part"].iloc[0], "filter_order": [o for o in ORDERS for _ in FILTERS],
        "step": [s + 1 for _ in ORDERS for s in range(len(FILTERS))], "kept": fields[0], "removed": fields[1], "redundant": fields[2],
        "unique_fails": [alone[n] for n in names], "good_lost": fields[3], "toxic_lost": fields[4], "shapley": [shapley[n] for n in names]})


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``part, filter_order, step`` and counts, for all 120 orders of the filters A to E; see ``failures`` and ``mask_counts``.

    A mask of failed filters stands for an integer of 600 fields, one for each step of each order; the integers of a part's documents
    are summed, equal ones by multiplication, and unpacked. Fields are as wide as the number of the part's documents, so none overflows.
    A part's sum takes at most 128 rows (32 masks, two labels), however many documents it has. Null, empty and very long texts are
    judged like any other; an empty table has no parts and gives no rows; extra columns are not looked at.
    """
    ddl = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
    return mask_counts(docs, labels, part, text, doc_id).groupBy("part").applyInPandas(_sum_up, ddl)
