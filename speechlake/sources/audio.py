"""Find recordings and read mono 16-bit WAV into chunks of samples."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechlake.functions.acoustics import HOP_SAMPLES
from speechlake.functions.text import AUDIO_SUFFIXES, path_suffix, without_suffix

CHUNK_SAMPLES = 64 * HOP_SAMPLES
PCM_SCALE = 32768.0  # fixed value


def under_root(path: Column, root: str) -> Column:
    """The part of a path after its root folder."""
    root = root.rstrip("/") + "/"
    return F.substring_index(path, root, -1)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, relative, suffix, audio_key, length, modificationTime``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", "length", "modificationTime").withColumn(
        "relative", under_root(F.col("path"), root)
    ).withColumn("suffix", path_suffix(F.col("path"))).withColumn(
        "audio_key", without_suffix(F.col("relative"))
    )


def list_audio(spark: SparkSession, root: str, require: bool = False) -> DataFrame:
    """Recordings under a folder (or one file) by their suffix in any case, sorted by path.

    With ``require`` an empty result is an error; that check runs a job on the listing.
    """
    found = list_files(spark, root).where(F.col("suffix").isin(*AUDIO_SUFFIXES)).orderBy("path")
    if require and found.isEmpty():
        raise ValueError(f"no recordings under {root}")
    return found


def read_pcm(files: DataFrame, chunk_samples: int = CHUNK_SAMPLES) -> DataFrame:
    """``item_id, chunk_no, sr, samples, error`` from rows ``path, content``.

    A file that cannot be read gives one row with its ``error``; the others are not affected.
    """

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import wave

        import numpy as np

        names = ["item_id", "chunk_no", "sr", "samples", "error"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    with wave.open(io.BytesIO(content)) as w:
                        if (w.getnchannels(), w.getsampwidth()) != (1, 2):
                            raise ValueError("not mono 16-bit PCM")
                        rate = w.getframerate()
                        pcm = np.frombuffer(w.readframes(w.getnframes()), dtype="<i2")
                except Exception as exc:
                    failed = [(path, None, None, None, f"{type(exc).__name__}: {exc}")]
                    yield pd.DataFrame(failed, columns=names)
                    continue
                for k in range(0, len(pcm), chunk_samples):
                    part = pcm[k:k + chunk_samples].astype(np.float32) / np.float32(PCM_SCALE)
                    yield pd.DataFrame([(path, k // chunk_samples, rate, part, None)], columns=names)

    return files.select("path", "content").mapInPandas(
        decode, "item_id string, chunk_no long, sr int, samples array<float>, error string"
    )


def read_wav(spark: SparkSession, root: str, chunk_samples: int = CHUNK_SAMPLES) -> DataFrame:
    """Chunks (and errors) of every ``.wav`` under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.[wW][aA][vV]").load(root)
    return read_pcm(files, chunk_samples)


def good_chunks(pcm: DataFrame) -> DataFrame:
    return pcm.where(F.col("error").isNull()).drop("error")


def quarantine(pcm: DataFrame) -> DataFrame:
    return pcm.where(F.col("error").isNotNull()).select("item_id", "error")
