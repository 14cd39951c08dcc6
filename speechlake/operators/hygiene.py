"""Checks of a file collection: leaked tokens, required and forbidden files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.functions.text import path_suffix

# Shape of a leaked token; folders and suffixes that must not be shipped.
LEAK_PATTERN = r"hf_[A-Za-z0-9]{20,}"
FORBIDDEN_FOLDERS = (".venv", "modelos", "audios", "transcripciones", "diarizaciones")
FORBIDDEN_SUFFIXES = (".bin", ".safetensors", ".ckpt", ".pt", ".pth", ".mp3", ".wav")


def leaked_tokens(texts: DataFrame, text: str, pattern: str = LEAK_PATTERN) -> DataFrame:
    """Rows whose text holds something shaped like a token."""
    return texts.where(F.col(text).rlike(pattern))


def policy_findings(
    listing: DataFrame, required: Sequence[str], folders: Sequence[str] = FORBIDDEN_FOLDERS,
    suffixes: Sequence[str] = FORBIDDEN_SUFFIXES, path: str = "path",
) -> DataFrame:
    """``finding, path``: required files that are absent, forbidden files and folders present."""
    spark = listing.sparkSession
    wanted = spark.createDataFrame([(p,) for p in required], f"{path} string")
    absent = wanted.join(listing.select(path), path, "left_anti").select(
        F.lit("missing").alias("finding"), path
    )
    heavy = listing.where(path_suffix(F.col(path)).isin(*suffixes)).select(
        F.lit("forbidden file").alias("finding"), path
    )
    parts = F.split(path, "/")
    depth = F.posexplode(F.slice(parts, F.lit(1), F.size(parts) - 1)).alias("_at", "_part")
    inside = listing.select(parts.alias("_parts"), depth).where(F.col("_part").isin(*folders))
    present = inside.select(
        F.lit("forbidden folder").alias("finding"),
        F.array_join(F.slice("_parts", F.lit(1), F.col("_at") + 1), "/").alias(path),
    ).distinct()
    return absent.unionByName(heavy).unionByName(present)


def leak_findings(texts: DataFrame, path: str, text: str, pattern: str = LEAK_PATTERN) -> DataFrame:
    return leaked_tokens(texts, text, pattern).select(
        F.lit("possible token").alias("finding"), F.col(path).cast("string").alias("path")
    )
