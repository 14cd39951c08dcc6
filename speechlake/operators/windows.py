"""Clips and sliding windows of recordings, and scores for them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.functions.rounding import round_exact

# Clip length, window length and hop in seconds; labels that are scored;
# thresholds below and above which a window is a candidate to drop; rows shown.
CLIP_SECONDS = 30.0
WINDOW_SECONDS, HOP_SECONDS = 10.0, 5.0
LABELS = ("Speech", "Music", "Singing")
MAX_SPEECH, MIN_MUSIC, MIN_SINGING = 0.20, 0.85, 0.70
SHOWN = 30


def tile_clips(recordings: DataFrame, duration: str, length: float = CLIP_SECONDS) -> DataFrame:
    """Back-to-back clips; the last one ends with the recording."""
    last = F.ceil(F.col(duration) / F.lit(length)).cast("bigint") - 1
    numbers = F.when(F.col(duration) > 0, F.sequence(F.lit(0).cast("bigint"), last))
    start = F.col("clip_no") * F.lit(length)
    return recordings.withColumn("clip_no", F.explode(numbers)).withColumn(
        "start", start
    ).withColumn("end", F.least(F.col("start") + length, F.col(duration)))


def voice_seconds(clips: DataFrame, key: str, sample_rate: int) -> DataFrame:
    """Total length of voiced clips given in samples."""
    return clips.groupBy(key).agg(
        (F.sum(F.col("end") - F.col("start")) / F.lit(float(sample_rate))).alias("voice_seconds")
    )


def sliding_windows(
    recordings: DataFrame, duration: str, window: float = WINDOW_SECONDS,
    hop: float = HOP_SECONDS,
) -> DataFrame:
    """Windows from zero on; the last is the first that reaches the end, and is cut there."""
    more = F.ceil((F.col(duration) - F.lit(window)) / F.lit(hop)).cast("bigint")
    numbers = F.when(
        F.col(duration) > 0,
        F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), more)),
    )
    start = F.col("window_no") * F.lit(hop)
    return recordings.withColumn("window_no", F.explode(numbers)).withColumn(
        "start", round_exact(start, 2)
    ).withColumn("end", round_exact(F.least(start + F.lit(window), F.col(duration)), 2))


def label_positions(labels: dict[int, str]) -> dict[str, int]:
    """Where the scored labels stand in a model's output, whatever their case."""
    by_name = {name.lower(): position for position, name in labels.items()}
    absent = [name for name in LABELS if name.lower() not in by_name]
    if absent:
        raise ValueError(f"the model has no label {', '.join(absent)}")
    return {name: by_name[name.lower()] for name in LABELS}


def score_windows(
    windows: DataFrame, samples: str, load_scorer: Callable[[], Callable],
    labels: dict[int, str],
) -> DataFrame:
    """Add ``p_speech, p_music, p_singing``, rounded to four digits.

    ``load_scorer`` runs once per Python worker and returns a function from a series of sample
    arrays to one row of logits each.
    """
    at = label_positions(labels)
    columns = [f"p_{name.lower()}" for name in LABELS]

    @F.pandas_udf(", ".join(f"{c} double" for c in columns))
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import numpy as np

        scorer = load_scorer()
        for batch in batches:
            logits = np.asarray(scorer(batch), dtype=float).reshape(len(batch), -1)
            p = 1.0 / (1.0 + np.exp(-logits[:, [at[n] for n in LABELS]]))
            yield pd.DataFrame(np.round(p, 4), columns=columns)

    kept = [c for c in windows.columns if c != samples]
    return windows.withColumn("_p", scores(F.col(samples))).select(*kept, "_p.*")


def drop_candidates(scores: DataFrame) -> DataFrame:
    """Windows with hardly any speech but clear music or singing."""
    return scores.where(
        (F.col("p_speech") < MAX_SPEECH)
        & ((F.col("p_music") > MIN_MUSIC) | (F.col("p_singing") > MIN_SINGING))
    )


def first_candidates(scores: DataFrame, n: int = SHOWN) -> DataFrame:
    return drop_candidates(scores).orderBy("audio", "start").limit(n)
