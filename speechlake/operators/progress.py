"""Progress logs, pending work and completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Files a finished recording has, by kind of work.
REQUIRED = {
    "transcription": (".json",),
    "diarization": (".diarization.json", ".rttm", ".embeddings.npz", ".speakers.json",
                    ".speakers.txt", ".speakers.srt"),
    "diarization_light": (".diarization.json", ".speakers.json", ".speakers.txt", ".speakers.srt"),
    "pair": (".json", ".diarization.json", ".speakers.json"),
}


def latest_per_audio(log: DataFrame, order: str = "seq") -> DataFrame:
    """The row appended last for every recording; combined before the shuffle."""
    rest = [c for c in log.columns if c != "audio_key"]
    last = F.max_by(F.struct(*rest), order).alias("_last")
    return log.groupBy("audio_key").agg(last).select("audio_key", "_last.*")


def pending(
    inputs: DataFrame, listing: DataFrame, work: str, latest: DataFrame | None = None,
    force: bool = False,
) -> DataFrame:
    """Recordings still to do: a required file is missing, or (with ``latest``) the last run failed."""
    if force:
        return inputs
    required = REQUIRED[work]
    have = listing.where(F.col("suffix").isin(*required)).groupBy("audio_key").agg(
        F.count_distinct("suffix").alias("_have")
    )
    done = have.where(F.col("_have") == len(required)).select("audio_key")
    if latest is not None:
        done = done.join(latest.where("status = 'ok'").select("audio_key"), "audio_key", "left_semi")
    return inputs.join(done, "audio_key", "left_anti")


def result_index(audios: DataFrame, listing: DataFrame) -> DataFrame:
    """Output paths per recording and whether both documents exist."""
    needed = {".json": "_text", ".speakers.json": "_speakers"}
    have = listing.groupBy("audio_key").agg(
        *[F.max(F.col("suffix") == s).alias(n) for s, n in needed.items()]
    )
    key = F.col("audio_key").cast("string")
    path = lambda folder, suffix: F.concat(F.lit(folder + "/"), key, F.lit(suffix))
    complete = F.coalesce(F.col("_text") & F.col("_speakers"), F.lit(False))
    return audios.join(have, "audio_key", "left").select(
        "audio_key",
        path("transcripciones", ".json").alias("transcription_json"),
        path("diarizaciones", ".speakers.json").alias("diarized_transcription_json"),
        path("diarizaciones", ".speakers.txt").alias("diarized_transcription_txt"),
        path("diarizaciones", ".speakers.srt").alias("diarized_subtitles_srt"),
        F.lit("local_to_audio_file").alias("speaker_scope"),
        complete.alias("complete"),
    )


def index_header(index: DataFrame) -> DataFrame:
    return index.agg(
        F.count(F.lit(1)).alias("audio_count"), F.count_if("complete").alias("complete_count")
    )


def status_counts(latest: DataFrame) -> DataFrame:
    return latest.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def last_rows(latest: DataFrame, n: int = 3, order: str = "seq") -> DataFrame:
    return latest.orderBy(F.desc(order)).limit(n)


def outcome_counts(log: DataFrame) -> DataFrame:
    """Successes and errors of a batch."""
    return log.agg(
        F.count_if(F.col("status") == "ok").alias("successes"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )


def output_collisions(paths: DataFrame, key: str, path: str) -> DataFrame:
    """Inputs that would write the same output: one row per colliding file, with its group's size.

    Only the counts are joined back, so a key shared by very many files stays spread out.
    """
    clash = paths.groupBy(key).agg(F.count(F.lit(1)).alias("files")).where("files > 1")
    return paths.select(key, path).join(clash, key)


def key_differences(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on one side only, both ways, in one list."""
    one = left.select(*keys).subtract(right.select(*keys)).withColumn("side", F.lit("left"))
    two = right.select(*keys).subtract(left.select(*keys)).withColumn("side", F.lit("right"))
    return one.unionByName(two)
