"""Fold aligned units into speaker turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from speechlake.functions.rounding import round_exact
from speechlake.functions.text import collapse_ws, is_blank
from speechlake.operators.align import UNIT_BLOCK, dealt
from speechlake.operators.blocks import attach_carry, block_order, running_sum
from speechlake.operators.checkpoints import settle

TURN_BLOCK = 4096

WIDE = 16  # stretches are re-blocked over this many unit blocks


def _inside_block(rows: DataFrame, block: str) -> DataFrame:
    """Previous speaker, speaker run and the run's latest earlier end, seen from one block only."""
    order = W.partitionBy("audio_key", block).orderBy("seq")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    changed = F.col("_before") != F.col("speaker")
    # Runs are numbered upwards, so the largest (run, end) so far is of this run, if it has begun: one order serves all windows.
    return (
        rows.withColumn("_before", F.lag("speaker").over(order))
        .withColumn("_run", F.sum(F.when(changed, 1).otherwise(0)).over(order))
        .withColumn("_top", F.max(F.struct("_run", "end")).over(earlier))
        .withColumn("_reach", F.when(F.col("_top._run") == F.col("_run"), F.col("_top.end"))).drop("_top")
    )


def _is_break(max_gap: float):
    return (
        F.col("_before").isNull()
        | (F.col("_before") != F.col("speaker"))
        | (F.col("start") - F.col("_reach") > F.lit(max_gap))
    )


def _across_blocks(rows: DataFrame, block: str) -> DataFrame:
    """Complete :func:`_inside_block` with what the blocks before say."""
    blocks = block_order(["audio_key"], block)
    tail = (
        W.partitionBy("audio_key", "_segment").orderBy(block)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    continues = F.col("_before_block") == F.col("_first")
    fresh = (F.col("_runs") > 0) | ~F.coalesce(continues, F.lit(False))
    rows = attach_carry(
        rows, ["audio_key"],
        summary={
            "_first": F.min_by("speaker", "seq"),
            "_last": F.max_by("speaker", "seq"),
            "_runs": F.max("_run"),
            "_tail_end": F.max(F.struct("_run", "end"))["end"],
        },
        between={
            "_before_block": F.lag("_last").over(blocks),
            "_segment": F.sum(F.when(fresh, 1).otherwise(0)).over(blocks),
            "_tail_reach": F.max("_tail_end").over(tail),
        },
        carry={
            "_carried_speaker": F.col("_before_block"),
            "_carried_reach": F.when(continues, F.lag("_tail_reach").over(blocks)),
        },
        block=block,
    )
    reach = F.when(F.col("_run") == 0, F.greatest("_reach", "_carried_reach"))
    return rows.withColumn("_before", F.coalesce("_before", "_carried_speaker")).withColumn(
        "_reach", reach.otherwise(F.col("_reach"))
    ).drop("_carried_speaker", "_carried_reach", "_run")


def _split_turns(max_gap: float):
    """Exact breaks inside one turn that holds units ending before they start.

    Their end can pull a turn's end back, which the running maximum cannot show. It only ever
    adds breaks inside a turn, so replaying that one turn's own units is exact. A stretch without such units has no break
    inside, so it comes as one unit.
    """
    piece = "struct<start:{t},end:{t},texts:array<string>,n:bigint>"

    def step(acc, unit):
        cur = acc["cur"]
        joins = unit["start"] - cur["end"] <= F.lit(max_gap)
        begun = F.struct(unit["start"].alias("start"), unit["end"].alias("end"),
                         F.array(unit["text"]).alias("texts"), unit["n"].alias("n"))
        grown = F.struct(cur["start"].alias("start"),
                         F.greatest(cur["end"], unit["end"]).alias("end"),
                         F.concat(cur["texts"], F.array(unit["text"])).alias("texts"), (cur["n"] + unit["n"]).alias("n"))
        return F.when(cur.isNull(), F.struct(acc["done"].alias("done"), begun.alias("cur"))).when(
            joins, F.struct(acc["done"].alias("done"), grown.alias("cur"))
        ).otherwise(F.struct(F.concat(acc["done"], F.array(cur)).alias("done"), begun.alias("cur")))

    def split(time_type: str):
        p = piece.format(t=time_type)
        zero = F.struct(
            F.array().cast(f"array<{p}>").alias("done"), F.lit(None).cast(p).alias("cur")
        )
        return F.aggregate(
            "_units", zero, step, lambda acc: F.concat(acc["done"], F.array(acc["cur"]))
        )

    return split


def build_turns(
    aligned: DataFrame, max_gap: float = 0.8, block_rows: int = UNIT_BLOCK,
    turn_block: int = TURN_BLOCK, digits: int = 3,
) -> DataFrame:
    """``audio_key, turn_no, start, end, speaker, text, unit_count``; turns numbered from 0.

    Blank units are dropped before anything else. A turn ends at a speaker change or when the
    next unit starts more than ``max_gap`` after the latest end so far. Units are ordered by
    ``seq``, not by time. Times in fractions of seconds come out rounded to ``digits``. Runs a job: stretches are written once to the shared folder, and the
    passes that stitch them read only their times. The text of a stretch is joined before it is written; only stretches with units that end
    before they start keep their units apart.
    """
    time_type = dict(aligned.dtypes)["end"]
    if "seq_block" not in aligned.columns:
        aligned = aligned.withColumn("seq_block", F.floor(F.col("seq") / F.lit(block_rows)))
    units = dealt(aligned.where(~is_blank(F.col("text"))).select(
        "audio_key", "seq_block", "seq", "start", "end", "text", "speaker"
    ), "audio_key", "seq_block")
    # Stretches: turns as seen inside one block. No shuffle, and far fewer rows come out.
    in_block = W.partitionBy("audio_key", "seq_block").orderBy("seq")
    listed = F.transform("_units", lambda x: F.struct(
        x["seq"].alias("seq"), x["start"].alias("start"), x["end"].alias("end"), x["text"].alias("text"), F.lit(1).cast("bigint").alias("n")))
    joined = F.array(F.struct(
        F.col("_units")[0]["seq"].alias("seq"), F.col("_units")[0]["start"].alias("start"), F.col("end"),
        F.array_join(F.transform("_units", lambda x: x["text"]), "").alias("text"), F.size("_units").cast("bigint").alias("n")))
    stretches = (
        _inside_block(units, "seq_block")
        .withColumn("_stretch", F.sum(_is_break(max_gap).cast("int")).over(in_block))
        .groupBy("audio_key", "seq_block", "_stretch", "speaker")
        .agg(
            F.array_sort(F.collect_list(F.struct("seq", "start", "end", "text"))).alias("_units"),
            F.max("end").alias("end"),
            F.max(F.col("end") < F.col("start") - F.lit(max_gap)).alias("_backward"),
        )
        .select(
            "audio_key", "speaker", "end", F.when(F.col("_backward"), listed).otherwise(joined).alias("_units"), "_backward",
            F.col("_units")[0]["seq"].alias("seq"), F.col("_units")[0]["start"].alias("start"),
        )
    )
    stretches = settle(stretches)
    # Stitch stretches that continue over a block border; only times and speakers take part.
    outline = dealt(
        stretches.select("audio_key", "seq", "start", "end", "speaker")
        .withColumn("_wide_block", F.floor(F.col("seq") / F.lit(block_rows * WIDE))),
        "audio_key", "_wide_block")
    outline = _across_blocks(_inside_block(outline, "_wide_block"), "_wide_block")
    outline = running_sum(
        outline, ["audio_key"], ["seq"], _is_break(max_gap).cast("bigint"), "_turn", "_wide_block"
    ).select("audio_key", "seq", "_turn")
    turns = (
        dealt(stretches.join(outline, ["audio_key", "seq"])
              .withColumn("_turn_block", F.floor(F.col("_turn") / F.lit(turn_block))), "audio_key", "_turn_block")
        .groupBy("audio_key", "_turn_block", "_turn", "speaker")
        .agg(
            F.array_sort(F.flatten(F.collect_list("_units"))).alias("_units"),
            F.max("end").alias("_end"),
            F.max("_backward").alias("_backward"),
        )
    )
    whole = F.array(F.struct(
        F.col("_units")[0]["start"].alias("start"), F.col("_end").alias("end"),
        F.transform("_units", lambda x: x["text"]).alias("texts"),
        F.aggregate("_units", F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"]).alias("n"),
    ))
    pieces = F.when(F.col("_backward"), _split_turns(max_gap)(time_type)).otherwise(whole)
    turns = turns.select(
        "audio_key", "_turn_block", "_turn", "speaker", pieces.alias("_pieces")
    )
    turns = running_sum(
        turns, ["audio_key"], ["_turn"], F.size("_pieces").cast("bigint"), "_through",
        "_turn_block",
    )
    fractional = time_type in ("double", "float")
    shown = lambda t: round_exact(F.col(t), digits) if fractional else F.col(t)
    first_no = F.col("_through") - F.size("_pieces")
    return turns.select(
        "audio_key", "speaker", first_no.alias("_first_no"),
        F.posexplode("_pieces").alias("_k", "p"),
    ).select(
        "audio_key",
        (F.col("_first_no") + F.col("_k")).alias("turn_no"),
        shown("p.start").alias("start"),
        shown("p.end").alias("end"),
        "speaker",
        collapse_ws(F.array_join("p.texts", "")).alias("text"),
        F.col("p.n").alias("unit_count"),
    )
