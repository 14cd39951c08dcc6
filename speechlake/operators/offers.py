"""Choose among machine offers, and among benchmark runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_CUDA = 12.8  # fixed value
SHOWN, TRIED = 5, 3  # fixed values: offers listed, offers tried in turn


def suitable_offers(
    offers: DataFrame, gpus: Sequence[str], count: int = 1, min_disk: float = 0,
    min_reliability: float = 0, min_download: float = 0, max_price: float | None = None,
    excluded: Sequence[int] = (), min_cuda: float = MIN_CUDA,
) -> DataFrame:
    keep = (
        F.col("verified") & F.col("rentable") & ~F.col("rented")
        & F.col("gpu_name").isin(*gpus) & (F.col("num_gpus") == count)
        & (F.col("cuda_max_good") >= min_cuda) & (F.col("disk_space") >= min_disk)
        & (F.col("reliability") >= min_reliability) & (F.col("inet_down") >= min_download)
    )
    if max_price:
        keep = keep & (F.col("dph_total") <= max_price)
    if excluded:
        keep = keep & ~F.col("machine_id").isin(*excluded)
    return offers.where(keep)


def rank_offers(
    offers: DataFrame, gpus: Sequence[str], excluded: Sequence[int] = (), top: int | None = SHOWN
) -> DataFrame:
    """Most wanted model first, then the cheapest; a missing price counts as nothing.

    Offers that tie keep the order of their id.
    """
    wanted = F.array_position(F.array(*[F.lit(g) for g in gpus]), F.col("gpu_name"))
    allowed = offers.where(F.col("gpu_name").isin(*gpus))
    if excluded:
        allowed = allowed.where(F.coalesce(~F.col("machine_id").isin(*excluded), F.lit(True)))
    ranked = allowed.withColumn("preference", wanted).orderBy(
        "preference", F.coalesce("dph_total", F.lit(0.0)), "id"
    )
    return ranked if top is None else ranked.limit(top)


def leaderboard(runs: DataFrame, order: str, near: float = 0.999) -> DataFrame:
    """Runs with ``rtf`` and whether they count, against the first run.

    ``same_speakers``: as many speakers as the first run; ``same_text``: text as good as equal and
    a mean log probability that is not worse. The first run is a single row.
    """
    first = runs.agg(F.min_by(F.struct("n_spk", "mean_logprob"), order).alias("_first"))
    rated = runs.withColumn("rtf", F.col("audio_s") / F.col("elapsed_s")).join(first, F.lit(True))
    return rated.withColumn("same_speakers", F.col("n_spk") == F.col("_first.n_spk")).withColumn(
        "same_text",
        (F.col("similarity") >= near) & (F.col("mean_logprob") >= F.col("_first.mean_logprob")),
    ).drop("_first")


def configuration_table(runs: DataFrame) -> DataFrame:
    """What the runs of each configuration made: ``runs, segments, chars, mean_logprob, rtf``, fastest first.

    ``segments`` and ``chars`` are totals. The mean log probability is that of all segments, a run's mean counting as
    often as it has segments; ``rtf`` is all audio over all time. No segments or no time: null.
    """
    weight = F.when(F.col("mean_logprob").isNotNull(), F.col("segments"))
    return runs.groupBy("config").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("segments").alias("segments"), F.sum("chars").alias("chars"),
        (F.sum(F.col("mean_logprob") * weight) / F.nullif(F.sum(weight), F.lit(0))).alias("mean_logprob"),
        (F.sum("audio_s") / F.nullif(F.sum("elapsed_s"), F.lit(0))).alias("rtf"),
    ).orderBy(F.desc("rtf"))


def best_configuration(rated: DataFrame, accepted: str) -> DataFrame:
    """Fastest accepted run of each configuration, fastest first."""
    return rated.where(F.col(accepted)).groupBy("config").agg(
        F.count(F.lit(1)).alias("runs"), F.max("rtf").alias("best_rtf")
    ).orderBy(F.desc("best_rtf"))
