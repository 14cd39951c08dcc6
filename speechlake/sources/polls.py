"""Poll files: lines of JSON that a monitor of queues and machines appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POLL_DDL = "source bigint, seq bigint, poll_ts bigint, status string, machine_state string, took_seconds double"
NEEDED = ("source", "seq", "poll_ts")


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Columns of ``POLL_DDL`` and ``broken``: the line itself where it is no whole object or lacks a needed field, else null.

    Broken lines keep a row whose other columns are null, so none goes unseen; blank lines go.
    """
    lines = lines.where(F.trim(F.col(value)) != "")
    read = lines.select(F.col(value).alias("_line"), F.from_json(
        F.col(value), f"{POLL_DDL}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("_p"))
    whole = F.col("_p").isNotNull() & F.col("_p._corrupt").isNull()
    for name in NEEDED:
        whole = whole & F.col(f"_p.{name}").isNotNull()
    names = [part.split()[0] for part in POLL_DDL.split(", ")]
    return read.select(*[F.when(whole, F.col(f"_p.{n}")).alias(n) for n in names], F.when(~whole, F.col("_line")).alias("broken"))


def read_polls(spark: SparkSession, path: str) -> DataFrame:
    """Poll files of a folder as a table."""
    return parse_lines(spark.read.text(path))


def stream_polls(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Poll files as they come."""
    return parse_lines(spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path))


def sound(polls: DataFrame) -> DataFrame:
    """Polls without the broken lines."""
    return polls.where(F.col("broken").isNull()).drop("broken")


def quarantined(polls: DataFrame) -> DataFrame:
    """Only the broken lines."""
    return polls.where(F.col("broken").isNotNull()).select("broken")
