"""Text and subtitle lines, one row each: ``audio_key, line_no, txt, srt``.

Files are the rows of a recording in order. Nothing is collected into one value, so the length of
a recording does not matter. A subtitle block after the first starts with an empty line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechlake.functions.text import collapse_ws, dot_ts, hhmmss, srt_ts, trunc_ts


def _srt_block(number: Column, start: Column, end: Column, text: Column, first: Column) -> Column:
    return F.concat(
        F.when(first, F.lit("")).otherwise(F.lit("\n")),
        number.cast("string"), F.lit("\n"),
        srt_ts(start), F.lit(" --> "), srt_ts(end), F.lit("\n"), text,
    )


def transcript_lines(segments: DataFrame) -> DataFrame:
    """Segments with text. Subtitles keep the segment's own number, so numbers may skip."""
    shown = segments.withColumn("text", collapse_ws(F.col("text"))).where("text <> ''")
    first = shown.groupBy("audio_key").agg(F.min("segment_pos").alias("_first"))
    return shown.join(first, "audio_key").select(
        "audio_key", (F.col("segment_pos") + 1).cast("bigint").alias("line_no"),
        F.concat(F.lit("["), dot_ts(F.col("start")), F.lit("] "), "text").alias("txt"),
        _srt_block(F.col("segment_pos") + 1, F.col("start"), F.col("end"), F.col("text"),
                   F.col("segment_pos") == F.col("_first")).alias("srt"),
    )


def turn_lines(turns: DataFrame) -> DataFrame:
    """Speaker turns, numbered without gaps."""
    number = (F.col("turn_no") + 1).cast("bigint")
    return turns.select(
        "audio_key", number.alias("line_no"),
        F.concat(F.lit("["), trunc_ts(F.col("start")), F.lit(" - "), trunc_ts(F.col("end")),
                 F.lit("] "), "speaker", F.lit(": "), "text").alias("txt"),
        _srt_block(number, F.col("start"), F.col("end"),
                   F.concat(F.lit("["), "speaker", F.lit("] "), "text"),
                   F.col("turn_no") == 0).alias("srt"),
    )


def named_lines(named_turns: DataFrame) -> DataFrame:
    """Turns under their names; the text form rounds to whole seconds."""
    number = (F.col("turn_no") + 1).cast("bigint")
    said = F.concat("label", F.lit(": "), F.trim("text"))
    return named_turns.select(
        "audio_key", number.alias("line_no"),
        F.concat(F.lit("["), hhmmss(F.col("start")), F.lit(" - "), hhmmss(F.col("end")),
                 F.lit("] "), said).alias("txt"),
        _srt_block(number, F.col("start"), F.col("end"), said, F.col("turn_no") == 0).alias("srt"),
    )


def rttm_lines(intervals: DataFrame) -> DataFrame:
    """One SPEAKER line per interval: onset and duration with three decimals."""
    uri = F.regexp_replace(F.col("audio_key").cast("string"), r"\s", "_")
    return intervals.select(
        "audio_key", F.col("pos").cast("bigint").alias("line_no"),
        F.format_string(
            "SPEAKER %s 1 %.3f %.3f <NA> <NA> %s <NA> <NA>",
            uri, F.col("start"), F.col("end") - F.col("start"), F.col("speaker"),
        ).alias("rttm"),
    )
