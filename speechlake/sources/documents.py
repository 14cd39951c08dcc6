"""Transcript and diarization JSON documents, one per file, with their key and parse state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechlake.sources.audio import under_root

SEGMENTS = (
    "array<struct<id: int, start: double, end: double, text: string, avg_logprob: double, "
    "no_speech_prob: double, compression_ratio: double, "
    "words: array<struct<start: double, end: double, word: string, probability: double>>>>"
)
TRANSCRIPT_DDL = (
    "audio string, language string, language_probability double, duration double, "
    f"duration_after_vad double, segments {SEGMENTS}"
)
INTERVALS = "array<struct<start: double, end: double, speaker: string>>"
DIARIZATION_DDL = (
    "audio string, model string, created_at_utc string, duration_seconds double, "
    "processing_seconds double, speaker_scope string, speakers array<string>, num_speakers int, "
    f"diarization {INTERVALS}, exclusive_diarization {INTERVALS}"
)
SPEAKERS_DDL = (
    "audio string, speaker_scope string, speakers array<string>, "
    "units array<struct<start: double, end: double, text: string, probability: double, speaker: string>>, "
    "turns array<struct<start: double, end: double, speaker: string, text: string, unit_count: bigint>>"
)
BROKEN = "_broken"


def read_documents(
    spark: SparkSession, root: str, ddl: str, suffix: str, glob: str | None = None
) -> DataFrame:
    """One row per file: ``audio_key`` (path without suffix), ``parse_ok``, then the fields.

    A document that does not parse has no fields: what the parser had read up to the break depends on where that is.
    """
    docs = (
        spark.read.schema(f"{ddl}, {BROKEN} string")
        .option("multiLine", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN)
        .option("recursiveFileLookup", True).option("pathGlobFilter", glob or f"*{suffix}")
        .json(root)
    )
    path = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    relative = under_root(path, root)
    key = F.substring(relative, F.lit(1), F.length(relative) - len(suffix))
    whole = F.col(BROKEN).isNull()
    fields = [F.when(whole, F.col(c)).alias(c) for c in docs.columns if c != BROKEN]
    return docs.select(key.alias("audio_key"), whole.alias("parse_ok"), *fields)


def read_transcripts(spark: SparkSession, root: str) -> DataFrame:
    """Plain ``*.json`` only: names with an inner dot belong to other documents."""
    docs = read_documents(spark, root, TRANSCRIPT_DDL, ".json")
    return docs.where(~F.col("audio_key").rlike(r"\.(diarization|speakers|speaker-map)$"))


def read_diarizations(spark: SparkSession, root: str) -> DataFrame:
    return read_documents(spark, root, DIARIZATION_DDL, ".diarization.json")


def read_speakers(spark: SparkSession, root: str) -> DataFrame:
    return read_documents(spark, root, SPEAKERS_DDL, ".speakers.json")
