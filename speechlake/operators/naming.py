"""Replace speaker labels by names, after corrections of single turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAME_TIME = 0.02  # fixed value: a correction fits a turn whose times differ by less


def name_turns(
    turns: DataFrame, speaker_map: DataFrame, corrections: DataFrame,
    same_time: float = SAME_TIME,
) -> DataFrame:
    """Add ``label``: the first fitting correction, then canonical name, display name or label.

    Corrections are joined on audio, label and a cell of the start time, so a recording with
    many corrections and many turns does not pair them all.
    """
    cell = lambda x: F.floor(x / F.lit(same_time)).cast("bigint")
    fixes = corrections.select(
        F.col("audio_key").alias("_fix_audio"), F.col("observed").alias("_observed"),
        "expected", F.col("pos").alias("_pos"),
        F.col("start").alias("_fix_start"), F.col("end").alias("_fix_end"),
        F.explode(F.sequence(cell(F.col("start")) - 1, cell(F.col("start")) + 1)).alias("_cell"),
    )
    fits = (
        (F.col("audio_key") == F.col("_fix_audio"))
        & (F.col("speaker") == F.col("_observed"))
        & (cell(F.col("start")) == F.col("_cell"))
        & (F.abs(F.col("_fix_start") - F.col("start")) < same_time)
        & (F.abs(F.col("_fix_end") - F.col("end")) < same_time)
    )
    rest = [c for c in turns.columns if c not in ("audio_key", "turn_no", "speaker")]
    fixed = (
        turns.join(fixes, fits, "left")
        .groupBy("audio_key", "turn_no")
        .agg(*[F.first(c).alias(c) for c in rest],
             F.coalesce(F.min_by("expected", "_pos"), F.first("speaker")).alias("speaker"))
    )
    empty = F.lit("")
    names = speaker_map.groupBy("audio_key", "speaker").agg(
        F.max_by(F.struct("canonical_name", "display_name"), "pos").alias("n")
    ).select(
        "audio_key", "speaker",
        F.coalesce(F.nullif(F.col("n.canonical_name"), empty),
                   F.nullif(F.col("n.display_name"), empty)).alias("_name"),
    )
    return fixed.join(names, ["audio_key", "speaker"], "left").select(
        *turns.columns, F.coalesce("_name", "speaker").alias("label")
    )
