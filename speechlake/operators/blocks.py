"""Running calculations that split a long group into blocks.

A window over one key sorts that key in a single task, which fails to scale when one recording
or one pair holds much of the data. These helpers run the window inside ``(keys, block)``,
reduce every block to one summary row, run the carry over the summaries, and join it back.
The big side is shuffled once, by ``(keys, block)``; the summaries are tiny.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from speechlake.operators.checkpoints import settle

BLOCK = "_block"


def with_block(df: DataFrame, position: str, size: float, name: str = BLOCK) -> DataFrame:
    """Cut a numeric position column into cells of ``size``."""
    return df.withColumn(name, F.floor(F.col(position) / F.lit(size)))


def local_window(keys: Sequence[str], order: Sequence[str], block: str = BLOCK):
    return W.partitionBy(*keys, block).orderBy(*order)


def attach_carry(
    df: DataFrame,
    keys: Sequence[str],
    summary: dict[str, Column],
    carry: dict[str, Column],
    block: str = BLOCK,
    between: dict[str, Column] | None = None,
) -> DataFrame:
    """Reduce blocks with ``summary``, derive ``carry`` over the summaries, join it back.

    ``between`` holds summary-level columns that ``carry`` builds on. The summary also looks at
    every column for nulls and tests the (always true) outcome: both branches then read the same
    columns below the shuffle, so Spark computes that shuffle once and reuses it.
    """
    nulls = F.sum(sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0)))
    rows = df.groupBy(*keys, block).agg(
        *[c.alias(n) for n, c in summary.items()], nulls.alias("_nulls")
    ).where("_nulls >= 0")
    for name, col in (between or {}).items():
        rows = rows.withColumn(name, col)
    rows = rows.select(*keys, block, *[c.alias(n) for n, c in carry.items()])
    return df.join(rows, [*keys, block])


def block_order(keys: Sequence[str], block: str = BLOCK):
    """Blocks of a key in order; frames before the current block are taken from it."""
    return W.partitionBy(*keys).orderBy(block)


def running_max_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
    block: str = BLOCK,
) -> DataFrame:
    """Largest ``value`` among the earlier rows of the key (null for the first row)."""
    inside = local_window(keys, order, block).rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn("_inside", F.max(value).over(inside))
    earlier = block_order(keys, block).rowsBetween(W.unboundedPreceding, -1)
    df = attach_carry(
        df, keys, {"_top": F.max(value)}, {"_carried": F.max("_top").over(earlier)}, block
    )
    return df.withColumn(out, F.greatest("_inside", "_carried")).drop("_inside", "_carried")


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str,
    block: str = BLOCK,
) -> DataFrame:
    """Sum of ``value`` up to and including the row."""
    df = df.withColumn("_amount", value)
    inside = local_window(keys, order, block).rowsBetween(W.unboundedPreceding, W.currentRow)
    df = df.withColumn("_inside", F.sum("_amount").over(inside))
    earlier = block_order(keys, block).rowsBetween(W.unboundedPreceding, -1)
    df = attach_carry(
        df, keys, {"_total": F.sum("_amount")}, {"_carried": F.sum("_total").over(earlier)}, block
    )
    zero = F.lit(0)
    return df.withColumn(out, F.col("_inside") + F.coalesce("_carried", zero)).drop(
        "_inside", "_carried", "_amount"
    )


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
    block: str = BLOCK,
) -> DataFrame:
    """``value`` of the row just before (null for the first row); ``value`` is never null."""
    df = df.withColumn("_inside", F.lag(value).over(local_window(keys, order, block)))
    last = F.max_by(F.col(value), F.struct(*order))
    df = attach_carry(
        df, keys, {"_last": last},
        {"_carried": F.lag("_last").over(block_order(keys, block))}, block,
    )
    return df.withColumn(out, F.coalesce("_inside", "_carried")).drop("_inside", "_carried")


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, block: str = BLOCK
) -> DataFrame:
    """1, 2, 3 … per key in the given order."""
    return running_sum(df, keys, order, F.lit(1).cast("bigint"), out, block)


def number_all(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """1, 2, 3 … over the whole table in the given order.

    Blocks are the parts of a range partitioning by ``order``, as large as Spark's sample of the rows makes them, whatever
    the values are; the offsets run over one row per part. The parts are written, since a second sample could cut
    elsewhere; runs a job.
    """
    parts = df.repartitionByRange(*order).withColumn(BLOCK, F.spark_partition_id())
    return number_rows(settle(parts), [], order, out).drop(BLOCK)


def order_statistics(
    df: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, Callable[[Column], Column]],
    width: float,
) -> DataFrame:
    """Exact order statistics per key: ``ranks`` maps an output name to a 1-based rank of ``n``.

    Equal values are counted before they are shuffled, and the counts are accumulated in value
    cells of ``width``; no task ever holds all values of a key.
    """
    counts = with_block(df.where(F.col(value).isNotNull()).select(*keys, value), value, width)
    counts = (
        counts.groupBy(*keys, BLOCK, value).agg(F.count(F.lit(1)).alias("_n"))
        .repartition(*keys, BLOCK)
    )
    inside = local_window(keys, [value]).rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = counts.withColumn("_inside", F.sum("_n").over(inside))
    earlier = block_order(keys).rowsBetween(W.unboundedPreceding, -1)
    counts = attach_carry(
        counts, keys, {"_sum": F.sum("_n")},
        {"_before": F.coalesce(F.sum("_sum").over(earlier), F.lit(0)),
         "_total": F.sum("_sum").over(W.partitionBy(*keys))},
    )
    top = F.col("_before") + F.col("_inside")
    picks = []
    for name, rank in ranks.items():
        r = rank(F.col("_total"))
        picks.append(F.max(F.when((top >= r) & (top - F.col("_n") < r), F.col(value))).alias(name))
    return counts.groupBy(*keys).agg(*picks)


def middle_ranks(low: str = "_low", high: str = "_high") -> dict[str, Callable[[Column], Column]]:
    """Ranks of the two middle values; their mean is the median."""
    return {low: lambda n: F.floor((n + 1) / 2), high: lambda n: F.floor(n / 2) + 1}


def nearest_rank(q: float) -> Callable[[Column], Column]:
    """Rank of a percentile that picks a value instead of interpolating; ties to even."""
    return lambda n: F.rint((n - 1) * F.lit(q)).cast("bigint") + 1
