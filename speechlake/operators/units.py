"""From nested transcripts and interval lists to flat, ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechlake.functions.text import is_blank
from speechlake.operators.blocks import BLOCK, number_rows, with_block


def explode_segments(transcripts: DataFrame) -> DataFrame:
    """One row per segment with its 0-based position; ``words`` stays null when the key is absent."""
    return transcripts.select(
        "audio_key", F.posexplode("segments").alias("segment_pos", "segment")
    ).select("audio_key", "segment_pos", "segment.*")


def explode_words(transcripts: DataFrame) -> DataFrame:
    """Every word, timed or not, with the times of its segment."""
    return explode_segments(transcripts).select(
        "audio_key", "segment_pos",
        F.col("start").alias("segment_start"), F.col("end").alias("segment_end"),
        F.posexplode("words").alias("word_pos", "w"),
    ).select(
        "audio_key", "segment_pos", "word_pos", "segment_start", "segment_end",
        F.col("w.start").alias("start"), F.col("w.end").alias("end"),
        F.col("w.word").alias("word"), F.col("w.probability").alias("probability"),
    )


def explode_units(transcripts: DataFrame) -> DataFrame:
    """Timed words; a segment without words but with text counts as one unit.

    A single narrow pass: a transcript is one row, so its units are listed inside the row and
    exploded once. Their place in that list is ``seq``, without gaps.
    """

    def units(segment: Column) -> Column:
        timed = F.filter(
            segment["words"], lambda w: w["start"].isNotNull() & w["end"].isNotNull())
        spoken = F.transform(timed, lambda w: F.struct(
            w["start"].alias("start"), w["end"].alias("end"),
            F.coalesce(w["word"], F.lit("")).alias("text"),
            w["probability"].alias("probability"),
        ))
        whole = F.array(F.struct(
            F.coalesce(segment["start"], F.lit(0.0)).alias("start"),
            F.coalesce(segment["end"], F.lit(0.0)).alias("end"),
            F.coalesce(segment["text"], F.lit("")).alias("text"),
            F.lit(None).cast("double").alias("probability"),
        ))
        none = F.slice(whole, 1, 0)
        return F.when(F.coalesce(F.size(segment["words"]), F.lit(0)) > 0, spoken).when(
            ~is_blank(segment["text"]), whole).otherwise(none)

    return transcripts.select(
        "audio_key", F.posexplode(F.flatten(F.transform("segments", units))).alias("seq", "u")
    ).select(
        "audio_key", F.col("seq").cast("bigint").alias("seq"),
        "u.start", "u.end", "u.text", "u.probability",
    )


def explode_intervals(diarizations: DataFrame, field: str = "exclusive_diarization") -> DataFrame:
    """Intervals in file order; writers already sort them by (start, end, speaker)."""
    return diarizations.select("audio_key", F.posexplode(field).alias("pos", "i")).select(
        "audio_key", "pos", "i.start", "i.end", "i.speaker"
    )


def order_key(start: Column, end: Column, speaker: Column) -> Column:
    """Sortable place of an interval; compares like (start, end, speaker)."""
    return F.struct(start.alias("start"), end.alias("end"), speaker.alias("speaker"))


def with_positions(intervals: DataFrame, cell: float = 3600.0) -> DataFrame:
    """Intervals with ``pos``, from 0 in the order of (start, end, speaker); a former ``pos`` is replaced.

    Numbers are assigned in cells of ``cell`` time units and carried over, so a long recording is never sorted in one task.
    """
    rows = with_block(intervals.drop("pos"), "start", cell)
    return number_rows(rows, ["audio_key"], ["start", "end", "speaker"], "pos").withColumn("pos", F.col("pos") - 1).drop(BLOCK)
