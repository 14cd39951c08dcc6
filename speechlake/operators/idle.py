"""Queue polls, and how long a queue has stayed empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from speechlake.operators.blocks import (
    BLOCK,
    attach_carry,
    block_order,
    local_window,
    previous_value,
    with_block,
)

# Seconds a queue must stay empty, and the longest gap between two polls.
IDLE_SECONDS = 600.0
POLL_BLOCK = 65536


def max_gap(poll_seconds: float) -> float:
    return poll_seconds * 2 + 30


def parse_polls(polls: DataFrame, capabilities: Sequence[str], status: str = "status") -> DataFrame:
    """Add ``valid`` and ``empty`` to polls that carry a JSON status.

    A status is valid when its capabilities are exactly the given set, both counts are
    whole non-negative numbers (no booleans, no text) and ``next_available_at`` is a key, be it null.
    """
    v = F.try_parse_json(F.col(status))
    field = lambda name: F.try_variant_get(v, f"$.{name}", "variant")
    number = lambda name: F.try_variant_get(v, f"$.{name}", "bigint")
    whole = lambda name: F.coalesce(
        (F.schema_of_variant(field(name)) == "BIGINT") & (number(name) >= 0), F.lit(False))
    listed = F.try_variant_get(v, "$.capabilities", "array<string>")
    same = F.array_sort(F.array_distinct(listed)) == F.array(
        *[F.lit(x) for x in sorted(set(capabilities))])
    has_key = F.coalesce(
        F.array_contains(F.json_object_keys(status), "next_available_at"), F.lit(False))
    valid = F.coalesce(same, F.lit(False)) & whole("available_jobs") & whole("active_leases") & has_key
    empty = (
        (number("available_jobs") == 0) & (number("active_leases") == 0)
        & F.get_json_object(status, "$.next_available_at").isNull()
    )
    return polls.withColumn("valid", valid).withColumn("empty", F.coalesce(valid & empty, F.lit(False)))


def judged_polls(polls: DataFrame, poll_seconds: float, valid: str = "valid", machine: str = "machine_state",
                 took: str = "took_seconds") -> DataFrame:
    """Polls whose ``empty`` holds only if the status is valid and the machine runs, and ``slow`` ones that took over two periods.

    A failed request is an invalid status; a slow poll restarts the clock instead of going on.
    """
    counts = F.coalesce(F.col(valid), F.lit(False)) & F.coalesce(F.col(machine) == "running", F.lit(False))
    return polls.withColumn("empty", F.coalesce(F.col("empty"), F.lit(False)) & counts).withColumn(
        "slow", F.coalesce(F.col(took) > 2 * poll_seconds, F.lit(False)))


def idle_windows(
    polls: DataFrame, gap: float, idle_seconds: float = IDLE_SECONDS, key: str = "source",
    block_rows: int = POLL_BLOCK,
) -> DataFrame:
    """Add ``since`` and ``fires`` to polls ``source, seq, poll_ts, empty``, and ``slow`` if there is one.

    The clock starts at the first empty poll, and again after a gap, when time runs backward, and at a poll that was ``slow``.
    A poll that is not empty (see :func:`judged_polls` for those that do not count) clears it.
    """
    p = with_block(polls, "seq", block_rows).repartition(key, BLOCK)
    p = p.withColumn("_now", F.struct("empty", "poll_ts"))
    p = previous_value(p, [key], ["seq"], "_now", "_prior").drop("_now")
    before = F.col("_prior.poll_ts")
    carries_on = (
        F.coalesce(F.col("_prior.empty"), F.lit(False))
        & (F.col("poll_ts") - before <= gap) & (F.col("poll_ts") >= before)
    )
    if "slow" in polls.columns:
        carries_on = carries_on & ~F.coalesce("slow", F.lit(False))
    p = p.withColumn("_start", F.when(F.col("empty") & ~carries_on, F.col("poll_ts")))
    so_far = local_window([key], ["seq"]).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = block_order([key]).rowsBetween(W.unboundedPreceding, -1)
    p = p.withColumn("_inside", F.last("_start", ignorenulls=True).over(so_far))
    at = F.when(F.col("_start").isNotNull(), F.col("seq"))
    p = attach_carry(
        p, [key], {"_latest": F.max_by("_start", at)},
        {"_carried": F.last("_latest", ignorenulls=True).over(earlier)},
    )
    since = F.when(F.col("empty"), F.coalesce("_inside", "_carried"))
    return p.withColumn("since", since).withColumn(
        "fires", F.coalesce(F.col("poll_ts") - F.col("since") >= idle_seconds, F.lit(False))
    ).select(*polls.columns, "since", "fires")
