"""Landmarks ``(item, hash, t)`` from text, and from spectral peaks of audio."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from speechlake.functions.acoustics import (
    HOP_SAMPLES,
    SAMPLE_RATE,
    WINDOW_SAMPLES,
    pack_landmark,
)
from speechlake.operators.blocks import order_statistics
from speechlake.operators.checkpoints import settle


def text_landmarks(texts: DataFrame, n: int = 5, hashed: bool = True) -> DataFrame:
    """``(item, words)`` to one landmark per word n-gram, at the position of its first word.

    ``hash`` is a 64-bit digest of the n-gram, or the n-gram itself when not ``hashed``.
    """

    def gram(i):
        text = F.array_join(F.slice("words", i, n), " ")
        return F.xxhash64(text) if hashed else text

    grams = F.transform(F.sequence(F.lit(1), F.size("words") - (n - 1)), gram)
    return texts.where(F.size("words") >= n).select(
        "item", F.posexplode(grams).alias("t", "hash")
    ).select("item", "hash", "t")


# --- audio: spectrogram, peaks, landmarks ---------------------------------------------------
# Peak neighbourhood (frames and bins before and after), percentile a peak must
# exceed, pairs per anchor, and the distance of a pair in frames.
FRAMES_BEFORE, FRAMES_AFTER = 10, 9
BINS_BEFORE, BINS_AFTER = 5, 4
PEAK_QUANTILE = 0.75
FAN_OUT = 5
MIN_DISTANCE, MAX_DISTANCE = 1, 200
FLOOR = 1e-6

FRAME_BLOCK = 512
PAIR_BLOCK = 4096


def spectrogram(
    pcm: DataFrame, chunk_samples: int, window: int = WINDOW_SAMPLES, hop: int = HOP_SAMPLES
) -> DataFrame:
    """``item_id, frame, db``: log magnitude of Hann windows, no padding at the ends.

    ``pcm`` holds chunks of ``chunk_samples``, a multiple of ``hop``. A chunk borrows the first
    samples of the next one, so chunks are transformed independently of each other.
    """
    overlap = window - hop
    borrowed = pcm.select(
        "item_id", (F.col("chunk_no") - 1).alias("chunk_no"),
        F.slice("samples", 1, overlap).alias("_next"),
    )
    chunks = pcm.select("item_id", "chunk_no", "samples").join(
        borrowed, ["item_id", "chunk_no"], "left"
    ).select(
        "item_id", "chunk_no", F.size("samples").alias("_own"),
        F.when(F.col("_next").isNull(), F.col("samples"))
        .otherwise(F.concat("samples", "_next")).alias("samples"),
    )
    item_type = dict(pcm.dtypes)["item_id"]

    def transform(batches):
        import numpy as np
        import pandas as pd

        taper = np.hanning(window)
        for batch in batches:
            for item, chunk, own, samples in zip(
                batch["item_id"], batch["chunk_no"], batch["_own"], batch["samples"]
            ):
                x = np.asarray(samples, dtype=np.float64)
                count = min(1 + (len(x) - window) // hop, -(-own // hop))
                if count <= 0:
                    continue
                # the chunk as rows of one hop each; a frame is a row and the ones after it
                parts = -(-window // hop)
                lanes = np.zeros((count - 1 + parts, hop))
                lanes.flat[:min(len(x), lanes.size)] = x[:lanes.size]
                frames = np.hstack([lanes[k:k + count] for k in range(parts)])[:, :window]
                level = np.absolute(np.fft.rfft(taper * frames, n=window, axis=-1))
                db = np.log10(level + FLOOR) * 20
                yield pd.DataFrame({
                    "item_id": item, "_chunk": chunk, "_k": np.arange(count), "db": list(db),
                })

    frames = chunks.mapInPandas(
        transform, f"item_id {item_type}, _chunk long, _k long, db array<double>"
    )
    return frames.select(
        "item_id", (F.col("_chunk") * (chunk_samples // hop) + F.col("_k")).alias("frame"), "db"
    )


def level_threshold(spectrum: DataFrame, q: float = PEAK_QUANTILE) -> DataFrame:
    """``item_id, threshold``: linearly interpolated quantile of all cells of an item; exact.

    A histogram by whole decibels, combined before the shuffle, shows which cells hold the two
    values in question; only those values are then ordered.
    """
    level = F.floor("v").cast("bigint")
    histogram = spectrum.select("item_id", F.explode("db").alias("v")).groupBy(
        "item_id", level.alias("_level")
    ).agg(F.count(F.lit(1)).alias("_n"))
    up_to = W.partitionBy("item_id").orderBy("_level")
    whole = W.partitionBy("item_id")
    place = F.lit(q) * (F.col("_total") - 1)
    histogram = histogram.withColumn("_top", F.sum("_n").over(up_to)).withColumn(
        "_total", F.sum("_n").over(whole)
    ).withColumn("_k", F.floor(place)).withColumn("_share", place - F.floor(place))
    low, high = F.col("_k") + 1, F.least(F.col("_k") + 2, F.col("_total"))
    bottom = F.col("_top") - F.col("_n")
    wanted = histogram.where(
        ((F.col("_top") >= low) & (bottom < low)) | ((F.col("_top") >= high) & (bottom < high))
    ).groupBy("item_id").agg(
        F.min("_level").alias("_from"), F.max("_level").alias("_to"), F.min(bottom).alias("_below"),
        F.first("_k").alias("_k"), F.first("_share").alias("_share"), F.first("_total").alias("_all"),
    )
    values = spectrum.join(wanted, "item_id").select(
        "item_id", "_below", "_k", "_share", "_all",
        F.explode(F.filter("db", lambda x: F.floor(x).between(F.col("_from"), F.col("_to")))).alias("v"),
    )
    rank = lambda r: lambda n: r - F.col("_below")
    ends = order_statistics(
        values, ["item_id", "_below", "_k", "_share", "_all"], "v",
        {"_lo": rank(F.col("_k") + 1), "_hi": rank(F.least(F.col("_k") + 2, F.col("_all")))}, 1 / 1024,
    )
    return ends.select(
        "item_id", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_share")).alias("threshold")
    )


def find_peaks(spectrum: DataFrame, block: int = FRAME_BLOCK) -> DataFrame:
    """``item_id, t, f``: cells that top their neighbourhood and the item's threshold.

    Frames are processed in blocks with a border of neighbouring frames, so a group never
    holds more than a block, however long the item is.
    """
    at = F.col("frame")
    own = F.floor(at / F.lit(block)).cast("bigint")
    reaches = F.array_distinct(F.array(
        own, F.floor((at - FRAMES_AFTER) / F.lit(block)).cast("bigint"),
        F.floor((at + FRAMES_BEFORE) / F.lit(block)).cast("bigint"),
    ))
    blocks = spectrum.join(level_threshold(spectrum), "item_id").select(
        "item_id", F.explode(reaches).alias("_block"), own.alias("_own"), "frame", "db", "threshold"
    )
    item_type = dict(spectrum.dtypes)["item_id"]

    def pick(rows):
        import numpy as np
        import pandas as pd

        rows = rows.sort_values("frame", kind="stable")
        item = rows["item_id"].iloc[0]
        db = np.stack([np.asarray(x) for x in rows["db"]])
        frames = rows["frame"].to_numpy()
        top = _widest(db, BINS_BEFORE, BINS_AFTER, axis=1)
        top = _widest(top, FRAMES_BEFORE, FRAMES_AFTER, axis=0)
        mine = (rows["_own"] == rows["_block"]).to_numpy()
        keep = (db == top) & (db > rows["threshold"].to_numpy()[:, None]) & mine[:, None]
        t, f = np.nonzero(keep)
        found = {"item_id": np.full(len(t), item, dtype=object), "t": frames[t], "f": f}
        return pd.DataFrame(found)

    return blocks.groupBy("item_id", "_block").applyInPandas(
        pick, f"item_id {item_type}, t long, f long"
    )


def _widest(values, before: int, after: int, axis: int):
    """Largest value from ``before`` places back to ``after`` places on, cut off at the ends."""
    import numpy as np

    pad = [(0, 0), (0, 0)]
    pad[axis] = (before, after)
    padded = np.pad(values, pad, constant_values=-np.inf)
    return np.lib.stride_tricks.sliding_window_view(padded, before + after + 1, axis=axis).max(axis=-1)


def pair_peaks(peaks: DataFrame, block: int = PAIR_BLOCK) -> DataFrame:
    """Landmarks ``item, hash, t``: each peak with the first later ones in reach.

    Peaks of one frame share their partners, so partners are looked up per frame: at most
    ``FAN_OUT`` following frames that have peaks. Time blocks overlap by the reach.
    """
    frames = peaks.groupBy("item_id", "t").agg(F.array_sort(F.collect_set("f")).alias("_fs"))
    own = F.floor(F.col("t") / F.lit(block)).cast("bigint")
    copied = F.when(F.col("t") % block < MAX_DISTANCE, own - 1)
    frames = frames.select(
        "item_id", "t", "_fs", own.alias("_own"),
        F.explode(F.array_compact(F.array(own, copied))).alias("_block"),
    )
    following = W.partitionBy("item_id", "_block").orderBy("t").rowsBetween(1, FAN_OUT)
    nearest = F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("t", F.slice("_fs", 1, FAN_OUT).alias("fs"))).over(following)),
        lambda frame: F.transform(
            F.when(frame["t"] - F.col("t") <= MAX_DISTANCE, frame["fs"]).otherwise(
                F.array().cast("array<bigint>")),
            lambda f2: F.struct((frame["t"] - F.col("t")).alias("dt"), f2.alias("f2")),
        ),
    ))
    return frames.withColumn("_next", nearest).where("_own = _block").select(
        "item_id", "t", F.explode("_fs").alias("f1"), F.slice("_next", 1, FAN_OUT).alias("_next")
    ).select("item_id", "t", "f1", F.explode("_next").alias("n")).select(
        F.col("item_id").alias("item"),
        pack_landmark(F.col("f1"), F.col("n.f2"), F.col("n.dt")).alias("hash"), "t",
    )


def audio_landmarks(pcm: DataFrame, chunk_samples: int) -> DataFrame:
    """From PCM chunks to landmarks; the spectrogram is written once. Runs a job."""
    return pair_peaks(find_peaks(settle(spectrogram(pcm, chunk_samples))))


def clip_pcm(
    pcm: DataFrame, clips: DataFrame, chunk_samples: int, sample_rate: int = SAMPLE_RATE
) -> DataFrame:
    """PCM chunks of clips ``clip, item_id, start_s, end_s`` cut from their recordings.

    Clip times become chunk numbers, so recordings are joined by (item, chunk). A source chunk
    meets at most two chunks of the clip, and each of those is put together from two pieces.
    """
    start = F.floor(F.col("start_s") * sample_rate).cast("bigint")
    end = F.floor(F.col("end_s") * sample_rate).cast("bigint")
    first = F.floor(F.greatest(start, F.lit(0)) / F.lit(chunk_samples)).cast("bigint")
    last = F.floor((end - 1) / F.lit(chunk_samples)).cast("bigint")
    spans = clips.withColumn("_s0", F.greatest(start, F.lit(0))).withColumn("_s1", end).where(
        "_s1 > _s0").withColumn("chunk_no", F.explode(F.sequence(first, last)))
    base = F.col("chunk_no") * chunk_samples
    a = F.greatest(F.col("_s0"), base)
    b = F.least(F.col("_s1"), base + F.size("samples"))
    into = F.sequence(F.floor((F.col("_a") - F.col("_s0")) / F.lit(chunk_samples)),
                      F.floor((F.col("_b") - 1 - F.col("_s0")) / F.lit(chunk_samples)))
    met = pcm.join(spans, ["item_id", "chunk_no"]).withColumn("_a", a).withColumn("_b", b).where(
        "_b > _a").withColumn("_base", base).withColumn("_to", F.explode(into))
    lo = F.greatest(F.col("_a"), F.col("_s0") + F.col("_to") * chunk_samples)
    hi = F.least(F.col("_b"), F.col("_s0") + (F.col("_to") + 1) * chunk_samples)
    piece = F.slice("samples", (lo - F.col("_base") + 1).cast("int"), (hi - lo).cast("int"))
    return met.select("clip", F.col("_to").alias("chunk_no"), lo.alias("_at"), piece.alias("_piece")).groupBy(
        "clip", "chunk_no").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_piece"))).alias("_pieces")
    ).select(
        F.col("clip").alias("item_id"), "chunk_no",
        F.flatten(F.transform("_pieces", lambda p: p["_piece"])).alias("samples"),
    )


def clip_landmarks(pcm: DataFrame, clips: DataFrame, chunk_samples: int) -> DataFrame:
    """Landmarks of clips, found anew: peaks depend on the clip's own level."""
    return audio_landmarks(clip_pcm(pcm, clips, chunk_samples), chunk_samples)
