"""Structural and confidence audit of transcripts: one row per recording, and corpus totals.

Inputs are flat tables, so no recording is ever gathered:

- ``audios``: ``audio_key``
- ``heads``: ``audio_key, parse_ok, duration, duration_after_vad, language, language_probability``
- ``segments``: ``audio_key, segment_pos, start, end, has_words`` (the words key is present)
- ``words``: ``audio_key, segment_start, segment_end, start, end, probability``
- ``listing``: ``audio_key, suffix`` of the files that exist
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.operators.blocks import (
    BLOCK,
    middle_ranks,
    nearest_rank,
    order_statistics,
    running_max_before,
    with_block,
)

# Thresholds of the audit.
LOW, VERY_LOW, GOOD = 0.5, 0.3, 0.8
NEAR_EMPTY_WORDS = 50
LOW_RATE = 0.05
SLACK_SECONDS = 1.0
OVERLAP_SECONDS = 1e-3
# Flags, in the order they are reported.
FLAGS = (
    "missing_json", "json_parse_error", "missing_txt", "missing_srt", "empty_transcript",
    "near_empty_transcript", "missing_word_timestamps", "high_low_confidence_rate",
    "invalid_segment_times", "invalid_word_times",
)
PROBABILITY_CELL = 1 / 4096
SEGMENT_BLOCK = 65536


def tables_from_transcripts(transcripts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Heads, segments and words of nested transcripts (with ``audio_key`` and ``parse_ok``)."""
    from speechlake.operators.units import explode_segments, explode_words

    heads = transcripts.select(
        "audio_key", "parse_ok", "duration", "duration_after_vad", "language",
        "language_probability",
    )
    segments = explode_segments(transcripts).select(
        "audio_key", "segment_pos", "start", "end", F.col("words").isNotNull().alias("has_words")
    )
    return heads, segments, explode_words(transcripts)


def _mean(p):
    """The mean over billionths: whole numbers add up the same in any order of rows."""
    whole = F.round(p * F.lit(1e9)).cast("bigint")
    return F.sum(whole).cast("double") / F.lit(1e9) / F.nullif(F.count(p), F.lit(0))


def _count_if(condition):
    return F.count_if(F.coalesce(condition, F.lit(False)))


def segment_overlaps(segments: DataFrame, block_rows: int = SEGMENT_BLOCK) -> DataFrame:
    """Segments that start before the latest earlier end, per recording: count and largest."""
    s = segments.select(
        "audio_key", "segment_pos",
        F.coalesce("start", F.lit(0.0)).alias("start"), F.coalesce("end", F.lit(0.0)).alias("end"),
    )
    s = with_block(s, "segment_pos", block_rows).repartition("audio_key", BLOCK)
    s = running_max_before(s, ["audio_key"], ["segment_pos"], "end", "_far")
    overlap = F.greatest("_far", F.lit(0.0)) - F.col("start")
    return s.groupBy("audio_key").agg(
        _count_if(overlap > OVERLAP_SECONDS).alias("segment_overlaps"),
        F.coalesce(F.max(F.when(overlap > OVERLAP_SECONDS, overlap)), F.lit(0.0))
        .alias("max_segment_overlap_seconds"),
    )


def word_statistics(words: DataFrame, exact: bool = False) -> DataFrame:
    """Count, mean, exact median and low-confidence counts of word probabilities; an ``exact`` mean does not depend on the order of rows."""
    p = F.col("probability")
    sums = words.groupBy("audio_key").agg(
        F.count(F.lit(1)).alias("words"),
        F.count(p).alias("scored"),
        (_mean(p) if exact else F.avg(p)).alias("mean_word_probability"),
        _count_if(p < LOW).alias("low_confidence_words"),
        _count_if(p < VERY_LOW).alias("very_low_confidence_words"),
    )
    middle = order_statistics(words, ["audio_key"], "probability", middle_ranks(), PROBABILITY_CELL)
    return sums.join(middle, "audio_key", "left").withColumn(
        "median_word_probability", (F.col("_low") + F.col("_high")) / 2
    ).withColumn(
        "low_confidence_rate", F.col("low_confidence_words") / F.nullif(F.col("scored"), F.lit(0))
    ).drop("_low", "_high")


def audit(
    audios: DataFrame, heads: DataFrame, segments: DataFrame, words: DataFrame, listing: DataFrame,
    exact: bool = False,
) -> DataFrame:
    """One row per recording with ``flags`` (array) in report order."""
    zero = F.lit(0.0)
    files = listing.groupBy("audio_key").agg(*[
        F.max(F.col("suffix") == f".{kind}").alias(f"{kind}_exists") for kind in ("txt", "srt")
    ])
    start, end = F.coalesce("start", zero), F.coalesce("end", zero)
    s0, s1 = F.coalesce("segment_start", zero), F.coalesce("segment_end", zero)
    with_length = segments.join(
        heads.select("audio_key", F.coalesce("duration", zero).alias("_length")), "audio_key"
    )
    bad_segment = (start < 0) | (end < start) | (end > F.col("_length") + SLACK_SECONDS)
    bad_word = (start < s0 - SLACK_SECONDS) | (end < start) | (end > s1 + SLACK_SECONDS)
    per_segment = with_length.groupBy("audio_key").agg(
        F.count(F.lit(1)).alias("segments"), F.max("has_words").alias("_has_words"),
        _count_if(bad_segment).alias("invalid_segment_times"),
    )
    per_word = words.groupBy("audio_key").agg(_count_if(bad_word).alias("invalid_word_times"))
    known = heads.withColumn("json_exists", F.lit(True))
    row = (
        audios.join(files, "audio_key", "left").join(known, "audio_key", "left")
        .join(per_segment, "audio_key", "left")
        .join(segment_overlaps(segments), "audio_key", "left")
        .join(word_statistics(words, exact), "audio_key", "left")
        .join(per_word, "audio_key", "left")
    )
    ok = F.coalesce("parse_ok", F.lit(False))
    counted = lambda name: F.when(ok, F.coalesce(name, F.lit(0))).otherwise(0).alias(name)
    only_ok = lambda value, name: F.when(ok, value).alias(name)
    flag = lambda name: F.coalesce(name, F.lit(False)).alias(name)
    length, speech = F.coalesce("duration", zero), F.coalesce("duration_after_vad", zero)
    row = row.select(
        "audio_key", flag("json_exists"), flag("txt_exists"), flag("srt_exists"),
        ok.alias("json_parse_ok"),
        only_ok(length, "duration_seconds"), only_ok(speech, "vad_seconds"),
        only_ok(speech / F.nullif(length, zero), "speech_coverage"),
        only_ok(F.col("language"), "language"),
        only_ok(F.col("language_probability"), "language_probability"),
        counted("segments"), counted("words"),
        (ok & F.coalesce("_has_words", F.lit(False)) & (F.coalesce("words", F.lit(0)) > 0))
        .alias("word_timestamps"),
        (ok & F.coalesce("_has_words", F.lit(False))).alias("_has_words"),
        only_ok(F.col("mean_word_probability"), "mean_word_probability"),
        only_ok(F.col("median_word_probability"), "median_word_probability"),
        counted("low_confidence_words"),
        only_ok(F.col("low_confidence_rate"), "low_confidence_rate"),
        counted("very_low_confidence_words"), counted("segment_overlaps"),
        F.when(ok, F.coalesce("max_segment_overlap_seconds", zero)).otherwise(0.0)
        .alias("max_segment_overlap_seconds"),
        counted("invalid_segment_times"), counted("invalid_word_times"),
        counted("scored"),
    )
    return row.withColumn("flags", _flags()).drop("_has_words")


def _flags():
    """Flags in order; without a readable document only the first two can apply."""
    readable = F.col("json_parse_ok")
    conditions = dict(zip(FLAGS, (
        ~F.col("json_exists"),
        F.col("json_exists") & ~readable,
        readable & ~F.col("txt_exists"),
        readable & ~F.col("srt_exists"),
        readable & (F.col("segments") == 0),
        readable & (F.col("segments") > 0) & F.col("words").between(1, NEAR_EMPTY_WORDS - 1),
        readable & (F.col("segments") > 0) & ~F.col("_has_words"),
        readable & (F.col("low_confidence_rate") > LOW_RATE),
        readable & (F.col("invalid_segment_times") > 0),
        readable & (F.col("invalid_word_times") > 0),
    )))
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))


def reconcile(audios: DataFrame, documents: DataFrame) -> DataFrame:
    """Full outer match of recordings and documents by key: ``both``, ``no_document``, ``no_audio``."""
    a = audios.select("audio_key", F.lit(1).alias("_a"))
    d = documents.select("audio_key", F.lit(1).alias("_d"))
    state = F.when(F.col("_d").isNull(), "no_document").when(F.col("_a").isNull(), "no_audio")
    return a.join(d, "audio_key", "full_outer").select("audio_key", state.otherwise("both").alias("state"))


def existing_kinds(audios: DataFrame, listing: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """One boolean per file kind and recording."""
    have = listing.groupBy("audio_key").pivot("suffix", list(kinds)).count()
    flags = [F.coalesce(F.col(f"`{k}`") > 0, F.lit(False)).alias(k.lstrip(".")) for k in kinds]
    return audios.join(have, "audio_key", "left").select("audio_key", *flags)


def corpus_summary(
    rows: DataFrame, words: DataFrame, documents: DataFrame, listing: DataFrame
) -> DataFrame:
    """One row of totals. Counts per language and per flag are maps.

    ``documents`` has the ``audio_key`` of every transcript document, with or without audio.
    """
    readable = rows.where("json_parse_ok").select("audio_key")
    p = F.col("probability")
    scored = words.join(readable, "audio_key", "left_semi").where(p.isNotNull())
    total = F.nullif(F.count(p), F.lit(0))
    rate = lambda c, name: (_count_if(c) / total).alias(name)
    probabilities = scored.agg(
        F.count(p).alias("total_scored_words"), _mean(p).alias("mean_word_probability"),
        rate(p < LOW, "words_below_0_5_rate"), rate(p < VERY_LOW, "words_below_0_3_rate"),
        rate(p >= GOOD, "words_at_least_0_8_rate"),
    )
    ranks = order_statistics(
        scored, [], "probability", {**middle_ranks(), "p10_word_probability": nearest_rank(0.10)},
        PROBABILITY_CELL,
    ).select("p10_word_probability", ((F.col("_low") + F.col("_high")) / 2).alias("median_word_probability"))
    files = rows.agg(
        F.count(F.lit(1)).alias("audio_files"),
        _count_if(~F.col("json_exists")).alias("audio_without_json"),
        _count_if(F.col("json_exists") & ~F.col("json_parse_ok")).alias("parse_errors"),
        _count_if(F.col("words") > 0).alias("files_with_scored_words"),
        _count_if(F.col("segment_overlaps") > 0).alias("files_with_segment_overlaps"),
        F.coalesce(F.sum("segment_overlaps"), F.lit(0)).alias("segment_overlap_events"),
        F.coalesce(F.max("max_segment_overlap_seconds"), F.lit(0.0)).alias("max_segment_overlap_seconds"),
    )
    orphans = documents.join(rows.select("audio_key"), "audio_key", "left_anti").agg(
        F.count(F.lit(1)).alias("json_without_audio"))
    kinds = documents.agg(F.count(F.lit(1)).alias("json_files"))
    listed = listing.agg(*[_count_if(F.col("suffix") == f".{k}").alias(f"{k}_files") for k in ("txt", "srt")])
    one = files
    # Every table below is a single aggregated row, so these joins have one pair.
    for other in (probabilities, ranks, orphans, kinds, listed,
                  counts_map(language_counts(rows), "languages"),
                  counts_map(flag_counts(rows), "flag_counts")):
        one = one.join(other, F.lit(True), "left")
    return one


def language_counts(rows: DataFrame) -> DataFrame:
    return rows.where("json_parse_ok").groupBy(
        F.coalesce("language", F.lit("None")).alias("name")
    ).agg(F.count(F.lit(1)).alias("n"))


def flag_counts(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("flags").alias("name")).groupBy("name").agg(
        F.count(F.lit(1)).alias("n"))


def counts_map(counts: DataFrame, name: str) -> DataFrame:
    """Named counts as one map; there are as many entries as languages or flags."""
    pairs = F.array_sort(F.collect_list(F.struct("name", "n")))
    return counts.agg(F.map_from_entries(pairs).alias(name))


# The flags that put a recording on each list.
CANDIDATES = {
    "empty": ("empty_transcript", "near_empty_transcript"),
    "no_word_times": ("missing_word_timestamps",),
    "low_confidence": ("high_low_confidence_rate",),
    "reprocess": ("missing_word_timestamps", "high_low_confidence_rate"),
}


def candidates(rows: DataFrame) -> DataFrame:
    """``list, audio_key`` for the four work lists, in one pass."""
    on_list = [
        F.when(F.arrays_overlap("flags", F.array(*[F.lit(f) for f in flags])), F.lit(name))
        for name, flags in CANDIDATES.items()
    ]
    return rows.select(F.explode(F.array_compact(F.array(*on_list))).alias("list"), "audio_key")


def flagged_report(rows: DataFrame) -> DataFrame:
    """Flagged recordings, least confident first; no confidence at all comes before any."""
    return rows.where(F.size("flags") > 0).orderBy(
        F.coalesce("mean_word_probability", F.lit(-1.0)), "audio_key"
    )
