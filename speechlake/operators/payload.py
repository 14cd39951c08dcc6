"""Result documents of finished jobs, as ordered fragments (see :mod:`speechlake.sinks.documents`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechlake.functions.text import collapse_ws, family_label, word_logprob
from speechlake.sinks.documents import assemble, items, json_text, json_value, piece

KEY = ["audio_key"]
# The family names model labels start with.
SPEECH_FAMILY = "whisper"
SPEAKER_FAMILY = "pyannote"


def _word(text: str, speaker: str | None, digits: int | None) -> Column:
    fields = [F.trim(collapse_edges(F.col(text))).alias("text"), "start", "end",
              F.lit("word").alias("type")]
    if speaker:
        fields.append(F.col(speaker).alias("speaker_id"))
    logprob = word_logprob(F.col("probability"))
    fields.append((logprob if digits is None else F.round(logprob, digits)).alias("logprob"))
    return F.to_json(F.struct(*fields))


def collapse_edges(text: Column) -> Column:
    """Strip white space at both ends; keep what is inside."""
    from speechlake.functions.text import UNICODE_SPACE as space

    return F.regexp_replace(F.coalesce(text, F.lit("")), f"^{space}+|{space}+$", "")


def _speech_middle(default_language: str | None, model: str) -> Column:
    language = F.coalesce(F.nullif(F.col("language"), F.lit("")), F.lit(default_language))
    return F.concat(
        F.lit('","language":'), json_value(language),
        F.lit(',"model":'), json_value(family_label(F.lit(model), SPEECH_FAMILY)),
        F.lit(',"words":['),
    )


def transcription_with_speakers(
    transcripts: DataFrame, turns: DataFrame, aligned: DataFrame, model: str,
    default_language: str | None = None, digits: int | None = None,
) -> DataFrame:
    """One ``[speaker] text`` line per turn; words carry their speaker.

    ``digits`` rounds log probabilities (null keeps all digits).
    """
    line = json_text(F.concat(F.lit("["), "speaker", F.lit("] "), "text"))
    return assemble(
        piece(transcripts, KEY, 0, F.lit('{"text":"')),
        items(turns, KEY, 1, "turn_no", line, "\\n", first=0),
        piece(transcripts, KEY, 2, _speech_middle(default_language, model)),
        items(aligned, KEY, 3, "seq", _word("text", "speaker", digits)),
        piece(transcripts, KEY, 4, F.lit("]}")),
    )


def transcription_plain(
    transcripts: DataFrame, segments: DataFrame, words: DataFrame, model: str,
    default_language: str | None = None, digits: int | None = None,
) -> DataFrame:
    """One line per segment, blank lines at both ends left out; words with both times only.

    ``words`` needs a ``seq``.
    """
    lines = segments.withColumn("text", collapse_ws(F.coalesce("text", F.lit(""))))
    span = lines.where("text <> ''").groupBy("audio_key").agg(
        F.min("segment_pos").alias("_from"), F.max("segment_pos").alias("_to")
    )
    lines = lines.join(span, "audio_key").where("segment_pos between _from and _to")
    timed = words.where(F.col("start").isNotNull() & F.col("end").isNotNull())
    return assemble(
        piece(transcripts, KEY, 0, F.lit('{"text":"')),
        items(lines, KEY, 1, "segment_pos", json_text(F.col("text")), "\\n"),
        piece(transcripts, KEY, 2, _speech_middle(default_language, model)),
        items(timed, KEY, 3, "seq", _word("word", None, digits)),
        piece(transcripts, KEY, 4, F.lit("]}")),
    )


def _diarization_ends(diarizations: DataFrame, count: Column, default_model: str):
    model = family_label(
        F.coalesce(F.nullif(F.col("model"), F.lit("")), F.lit(default_model)), SPEAKER_FAMILY
    )
    took = F.rint(F.col("processing_seconds") * 1000).cast("bigint")
    head = F.concat(F.lit('{"model":'), json_value(model), F.lit(',"segments":['))
    metadata = F.to_json(F.struct(
        count.cast("bigint").alias("speaker_count"), took.alias("processing_time_ms")
    ))
    return (
        piece(diarizations, KEY, 0, head),
        piece(diarizations, KEY, 2, F.concat(F.lit('],"metadata":'), metadata, F.lit("}"))),
    )


def diarization_with_transcript(
    diarizations: DataFrame, turns: DataFrame, default_model: str
) -> DataFrame:
    """Turns with text. ``diarizations``: ``audio_key, model, processing_seconds, speakers,
    aligned_speakers``; the first non-empty speaker list is counted."""
    count = F.when(F.size("speakers") > 0, F.size("speakers")).otherwise(
        F.coalesce(F.size("aligned_speakers"), F.lit(0))
    )
    head, tail = _diarization_ends(diarizations, count, default_model)
    body = F.to_json(F.struct(F.col("speaker").alias("speaker_id"), "start", "end", "text"))
    return assemble(head, items(turns, KEY, 1, "turn_no", body, first=0), tail)


def diarization_plain(
    diarizations: DataFrame, intervals: DataFrame, default_model: str
) -> DataFrame:
    """Exclusive intervals without text; the stated number of speakers, else the list's size."""
    count = F.coalesce("num_speakers", F.size("speakers"), F.lit(0))
    head, tail = _diarization_ends(diarizations, count, default_model)
    body = F.to_json(F.struct(F.col("speaker").alias("speaker_id"), "start", "end"))
    return assemble(head, items(intervals, KEY, 1, "pos", body, first=0), tail)


def missing_parts(wants_text: Column, wants_speakers: Column) -> Column:
    """Names of absent inputs, comma separated, or null; reads ``has_transcript``,
    ``has_diarization`` and ``has_speakers``."""
    absent = F.array_compact(F.array(
        F.when(wants_text & ~F.col("has_transcript"), "transcript"),
        F.when(wants_speakers & ~F.col("has_diarization"), "diarization"),
        F.when(wants_text & wants_speakers & ~F.col("has_speakers"), "speakers"),
    ))
    return F.when(F.size(absent) > 0, F.array_join(absent, ", "))


def check_jobs(jobs: DataFrame) -> DataFrame:
    """Add ``missing``; ``jobs`` has ``outputs`` and the three ``has_`` columns."""
    wants = [F.array_contains("outputs", kind) for kind in ("transcription", "diarization")]
    return jobs.withColumn("missing", missing_parts(*wants))


def job_payloads(
    jobs: DataFrame, speech_only: DataFrame, speech_both: DataFrame,
    speakers_only: DataFrame, speakers_both: DataFrame,
) -> DataFrame:
    """``job_id, part, ord, body`` of every complete job: only the outputs it asked for.

    The four inputs are the fragment tables above, for jobs that want one or both outputs.
    """
    ready = jobs.where(F.col("missing").isNull() & (F.size("outputs") > 0)).select(
        "job_id", "audio_key",
        F.array_contains("outputs", "transcription").alias("_text"),
        F.array_contains("outputs", "diarization").alias("_speakers"),
    )
    both = F.col("_text") & F.col("_speakers")
    keys = ["job_id"]

    def under(fragments: DataFrame, wanted: Column, shift: int) -> DataFrame:
        return ready.where(wanted).join(fragments, "audio_key").select(
            "job_id", (F.col("part") + shift).alias("part"), "ord", "body"
        )

    opening = F.concat(
        F.lit('{"outputs":{'),
        F.when(F.col("_text"), F.lit('"transcription":')).otherwise(F.lit('"diarization":')),
    )
    return assemble(
        piece(ready, keys, 0, opening),
        under(speech_both, both, 1),
        under(speech_only, F.col("_text") & ~F.col("_speakers"), 1),
        piece(ready.where(both), keys, 9, F.lit(',"diarization":')),
        under(speakers_both, both, 10),
        under(speakers_only, F.col("_speakers") & ~F.col("_text"), 10),
        piece(ready, keys, 19, F.lit("}}")),
    )
