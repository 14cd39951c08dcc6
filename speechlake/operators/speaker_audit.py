"""Audit of speaker assignments: coverage, unassigned words, fragmented speakers, warnings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.functions.rounding import round_exact
from speechlake.functions.text import is_blank
from speechlake.operators.align import UNKNOWN

# Thresholds of the audit, in seconds where they are times.
SHORT_TURN = 0.75
FRAGMENT_TURNS, FRAGMENT_TOTAL, FRAGMENT_MEAN = 10, 30.0, 1.0
MAX_SPEAKERS = 12
UNASSIGNED_RATE = 0.01
MIN_COVERAGE = 0.15
# The wording of warnings and of the note.
NO_SPEAKERS = "sin_hablantes"
MANY_SPEAKERS = "demasiados_hablantes"
NO_SPEECH_NOTE = "sin_voz_segun_whisper"
NO_TEXT = "sin_texto_alineado"
UNASSIGNED_TEXT = "texto_sin_hablante"
LITTLE_SPEECH = "muy_poca_voz"
FRAGMENTED = "speaker_fragmentado:"


MICRO = 1_000_000


def _length():
    """Length in whole microseconds, so sums do not depend on the order of rows."""
    micro = lambda name: F.round(F.col(name) * F.lit(float(MICRO))).cast("bigint")
    return micro("end") - micro("start")


def fragmented_speakers(turns: DataFrame) -> DataFrame:
    """Speakers heard often but only in scraps, joined by ``+`` per recording."""
    per_speaker = turns.where(F.col("speaker") != UNKNOWN).groupBy("audio_key", "speaker").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(_length()).alias("_total")
    )
    scraps = per_speaker.where(
        (F.col("_n") >= FRAGMENT_TURNS) & (F.col("_total") < int(FRAGMENT_TOTAL * MICRO))
        & (F.col("_total") < F.col("_n") * int(FRAGMENT_MEAN * MICRO))
    )
    return scraps.groupBy("audio_key").agg(
        F.array_join(F.array_sort(F.collect_set("speaker")), "+").alias("fragmented")
    )


def audit_speakers(
    diarizations: DataFrame, exclusive: DataFrame, units: DataFrame, turns: DataFrame,
    transcripts: DataFrame,
) -> DataFrame:
    """One row per diarized recording.

    ``diarizations``: ``audio_key, num_speakers, duration_seconds, processing_seconds``;
    ``transcripts``: ``audio_key, segments, duration_after_vad`` where a transcript exists.
    ``unassigned_words`` counts blank speakers; the label for unknown speakers has its own column.
    """
    zero = F.lit(0)
    speech = exclusive.groupBy("audio_key").agg((F.sum(_length()) / F.lit(float(MICRO))).alias("_speech"))
    said = units.groupBy("audio_key").agg(
        F.count(F.lit(1)).alias("words"),
        F.count_if(is_blank(F.col("speaker"))).alias("unassigned_words"),
        F.count_if(F.col("speaker") == UNKNOWN).alias("unknown_words"),
    )
    spoken = turns.groupBy("audio_key").agg(
        F.count(F.lit(1)).alias("turns"), F.count_if(_length() < int(SHORT_TURN * MICRO)).alias("_short")
    )
    heard = transcripts.select("audio_key", has_speech().alias("has_speech"))
    row = diarizations
    for other in (speech, said, spoken, fragmented_speakers(turns), heard):
        row = row.join(other, "audio_key", "left")
    covered = F.coalesce(F.col("_speech"), F.lit(0.0))
    row = row.select(
        "audio_key", "num_speakers", "duration_seconds", "processing_seconds",
        F.when(F.col("duration_seconds") > 0, covered / F.col("duration_seconds"))
        .otherwise(0.0).alias("coverage"),
        *[F.coalesce(n, zero).alias(n) for n in ("words", "unassigned_words", "unknown_words", "turns")],
        F.when(F.col("turns") > 0, F.col("_short") / F.col("turns")).otherwise(0.0).alias("short_turn_rate"),
        "fragmented", "has_speech",
    )
    no_words = F.col("words") == 0
    silent = no_words & F.coalesce(~F.col("has_speech"), F.lit(False))
    warnings = F.array_compact(F.array(
        F.when(F.coalesce("num_speakers", zero) < 1, NO_SPEAKERS),
        F.when(F.col("num_speakers") > MAX_SPEAKERS, MANY_SPEAKERS),
        F.when(no_words & ~silent, NO_TEXT),
        F.when(~no_words & (F.col("unassigned_words") / F.nullif(F.col("words"), zero) > UNASSIGNED_RATE),
               UNASSIGNED_TEXT),
        F.when(F.col("coverage") < MIN_COVERAGE, LITTLE_SPEECH),
        F.when(F.col("fragmented").isNotNull(), F.concat(F.lit(FRAGMENTED), "fragmented")),
    ))
    notes = F.array_compact(F.array(F.when(silent, NO_SPEECH_NOTE)))
    return row.withColumn("warnings", warnings).withColumn("notes", notes)


def has_speech():
    """A transcript with segments, or with voice time, has speech."""
    return (F.col("segments") > 0) | (F.coalesce("duration_after_vad", F.lit(0.0)) > 0)


def display_rows(rows: DataFrame) -> DataFrame:
    """Rounded, flat form of :func:`audit_speakers` for reports."""
    return rows.select(
        "audio_key", F.col("num_speakers").alias("speakers"),
        F.bround(F.col("duration_seconds") / 60, 1).alias("duration_min"),
        F.bround("processing_seconds", 1).alias("processing_s"),
        F.bround(F.col("coverage") * 100, 1).alias("speech_coverage_pct"),
        "words", "unassigned_words", "unknown_words", "turns",
        F.bround(F.col("short_turn_rate") * 100, 1).alias("short_turn_pct"),
        F.array_join("warnings", ",").alias("warnings"), F.array_join("notes", ",").alias("notes"),
    )


def speaker_summary(rows: DataFrame, audios: DataFrame, latest: DataFrame) -> DataFrame:
    """One row: recordings, finished, pending, current errors, warnings, mean seconds per file.

    The mean is taken over whole tenths of seconds and rounded to tenths, ties to even, in integers.
    """
    tenths = F.round(round_exact(F.col("processing_seconds"), 1) * 10).cast("bigint")
    left = F.pmod("_tenths", "_timed")
    whole = F.expr("(_tenths - pmod(_tenths, _timed)) div _timed")
    up = (left * 2 > F.col("_timed")) | ((left * 2 == F.col("_timed")) & (whole % 2 != 0))
    done = rows.agg(
        F.count(F.lit(1)).alias("finished"),
        F.count_if(F.size("warnings") > 0).alias("quality_warnings"),
        F.sum(tenths).alias("_tenths"), F.nullif(F.count(tenths), F.lit(0)).alias("_timed"),
    ).select(
        "finished", "quality_warnings",
        F.coalesce((whole + up.cast("int")) / F.lit(10.0), F.lit(0.0)).alias("mean_seconds_per_file"),
    )
    known = audios.agg(F.count(F.lit(1)).alias("audios"))
    errors = latest.agg(F.count_if(F.col("status") == "error").alias("current_errors"))
    one = known.join(done, F.lit(True), "left").join(errors, F.lit(True), "left")
    return one.withColumn("pending", F.greatest(F.lit(0), F.col("audios") - F.col("finished")))
