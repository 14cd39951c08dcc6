"""Capacity questions over an hourly demand series: ``fecha, hora, escuchas`` (and a weekday).

The windows run over hours of the calendar, after aggregation: a century has under a million of
them however much data lies behind, so one task per series is enough. ``keys`` separates series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Hours of audio a machine does per hour, price per machine hour, paid start.
REAL_TIME_FACTOR = 48
PRICE_PER_HOUR = 0.210
START_HOURS = 0.25

HOUR = ("fecha", "hora")


def hourly_demand(events: DataFrame, ts: str) -> DataFrame:
    """Events per hour as demand, with a zero for every hour between the first and the last."""
    hour = F.date_trunc("hour", ts)
    counts = events.groupBy(hour.alias("_hour")).agg(F.count(F.lit(1)).alias("_n"))
    span = counts.agg(F.min("_hour").alias("a"), F.max("_hour").alias("b"))
    hours = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("_hour"))
    return hours.join(counts, "_hour", "left").select(
        F.to_date("_hour").alias("fecha"), F.hour("_hour").alias("hora"),
        F.weekday("_hour").alias("dia"), F.coalesce("_n", F.lit(0)).alias("escuchas"),
    )


def day_profile(demand: DataFrame) -> DataFrame:
    active = F.when(F.col("escuchas") > 0, F.col("hora"))
    return demand.groupBy("fecha").agg(
        F.sum("escuchas").alias("total"), F.max("escuchas").alias("peak"),
        F.max_by("hora", F.struct("escuchas", -F.col("hora"))).alias("peak_hour"),
        F.min(active).alias("first_hour"), F.max(active).alias("last_hour"),
    )


def weekday_profile(demand: DataFrame, weekday: str = "dia") -> DataFrame:
    return demand.groupBy(weekday, "hora").agg(
        F.avg("escuchas").alias("mean"), F.max("escuchas").alias("peak")
    )


def machines_needed(
    demand: Column, backlog: Column | None = None, max_delay: float = 1.0,
    factor: float = REAL_TIME_FACTOR,
) -> Column:
    """Machines for the demand of an hour, and for working off a backlog within ``max_delay``."""
    load = demand if backlog is None else demand + backlog / F.lit(max_delay)
    return F.ceil(load / F.lit(factor)).cast("bigint")


def _in_time(keys: Sequence[str]):
    return W.partitionBy(*keys).orderBy(*HOUR)


def with_starts(schedule: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Machines switched on in each hour; before the first hour none run."""
    before = F.lag("machines", 1, 0).over(_in_time(keys))
    return schedule.withColumn("starts", F.greatest(F.lit(0), F.col("machines") - before))


def schedule_cost(
    schedule: DataFrame, keys: Sequence[str] = (), price: float = PRICE_PER_HOUR,
    start_hours: float = START_HOURS,
) -> DataFrame:
    totals = with_starts(schedule, keys).groupBy(*keys).agg(
        F.sum("machines").alias("machine_hours"), F.sum("starts").alias("starts")
    )
    paid = F.col("machine_hours") + F.lit(start_hours) * F.col("starts")
    return totals.withColumn("cost", F.lit(price) * paid)


def fixed_fleet(demand: DataFrame, capacity: float, keys: Sequence[str] = ()) -> DataFrame:
    """Backlog and delay of a fleet that does ``capacity`` hours of audio per hour.

    What is left over never falls below zero; with running sums that is the sum minus its lowest
    point so far, so no hour has to wait for the one before it.
    """
    so_far = _in_time(keys).rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = demand.withColumn(
        "_sum", F.sum(F.col("escuchas") - F.lit(capacity)).over(so_far)
    ).withColumn("_lowest", F.min("_sum").over(so_far))
    backlog = F.col("_sum") - F.least(F.lit(0.0), F.col("_lowest"))
    return summed.withColumn("backlog", backlog).withColumn(
        "delay", F.col("backlog") / F.lit(capacity)
    ).drop("_sum", "_lowest")


def schedule_ranges(schedule: DataFrame) -> DataFrame:
    """Consecutive hours of a day with the same number of machines, as ranges."""
    day = W.partitionBy("fecha").orderBy("hora")
    alike = W.partitionBy("fecha", "machines").orderBy("hora")
    island = F.row_number().over(day) - F.row_number().over(alike)
    return schedule.withColumn("_island", island).groupBy("fecha", "machines", "_island").agg(
        F.min("hora").alias("from_hour"), (F.max("hora") + 1).alias("to_hour")
    ).drop("_island")
