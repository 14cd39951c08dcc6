"""Union of intervals, and how much of each recording it covers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.operators.blocks import BLOCK, running_max_before, running_sum, with_block
from speechlake.operators.checkpoints import settle


def merge_intervals(
    intervals: DataFrame, keys: Sequence[str], cell: float, start: str = "start", end: str = "end"
) -> DataFrame:
    """Union per key; touching intervals merge. Equal starts are reduced before the shuffle; runs a job."""
    return _spans(intervals, keys, cell, start, end).drop("_matches")


def _spans(intervals, keys, cell, start="start", end="end"):
    """The union with the number of intervals in each span. The reduced starts are written once: each carry reads them again."""
    reach = intervals.groupBy(*keys, start).agg(F.max(end).alias(end), F.count(F.lit(1)).alias("_matches"))
    reach = with_block(settle(reach), start, cell).repartition(*keys, BLOCK)
    reach = running_max_before(reach, keys, [start], end, "_far")
    opens = F.when(F.col(start) <= F.col("_far"), 0).otherwise(1).cast("bigint")
    reach = running_sum(reach, keys, [start], opens, "_span")
    return reach.groupBy(*keys, "_span").agg(
        F.min(start).alias(start), F.max(end).alias(end), F.sum("_matches").alias("_matches")
    ).drop("_span")


def coverage(
    intervals: DataFrame, durations: DataFrame, key: str, cell: float
) -> DataFrame:
    """Per recording: raw matches, merged spans, covered time, share of its duration.

    ``durations`` has ``key, duration``; recordings without a match are kept with zeros and a
    zero duration gives a null share. Runs a job.
    """
    found = _spans(intervals, [key], cell).groupBy(key).agg(
        F.count(F.lit(1)).alias("spans"), F.sum(F.col("end") - F.col("start")).alias("covered"),
        F.sum("_matches").alias("matches"),
    )
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    return durations.join(found, key, "left").select(
        key, "duration", zero("matches"), zero("spans"), zero("covered")
    ).withColumn("share", F.col("covered") / F.nullif(F.col("duration"), F.lit(0)))


def total_coverage(per_recording: DataFrame) -> DataFrame:
    """One row: covered and total time and the percentage."""
    return per_recording.agg(
        F.sum("covered").alias("covered"), F.sum("duration").alias("duration")
    ).withColumn("percent", F.lit(100.0) * F.col("covered") / F.nullif(F.col("duration"), F.lit(0)))
