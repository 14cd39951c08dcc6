"""Readers of text, CSV and JSON inputs. Parsers work on lines, so they also serve streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from speechlake.functions.text import collapse_ws

BOM = "\ufeff"

# Fixed value: one line of a match report, such as
# ``a [  1.0s- 12.5s]  <->  b [ 30.0s- 41.5s]  (57 hashes)``.
_SECONDS = r"([0-9]+(?:\.[0-9]+)?)s"
_SIDE = rf"(\S+)\s+\[\s*{_SECONDS}-\s*{_SECONDS}\]"
MATCH_LINE = rf"^\s*{_SIDE}\s+<->\s+{_SIDE}\s+\(([0-9]+) hashes\)"

PROGRESS_DDL = (
    "seq bigint, timestamp_utc timestamp, audio string, status string, audio_seconds double, "
    "processing_seconds double, speakers int, regular_segments int, exclusive_segments int, "
    "aligned_turns int, error string"
)
TRANSCRIPTION_LOG_DDL = (
    "seq bigint, audio string, status string, seconds double, duration double, language string, "
    "message string"
)
SCORES_DDL = (
    "audio string, start double, end double, p_speech double, p_music double, p_singing double"
)
DEMAND_DDL = (
    "fecha string, dia_semana string, hora_inicio string, hora_fin string, "
    "escuchas_simultaneas_maximas string, zona_horaria string"
)
OFFER_DDL = (
    "id bigint, machine_id bigint, gpu_name string, num_gpus int, dph_total double, "
    "cuda_max_good double, reliability double, inet_down double, disk_space double, "
    "verified boolean, rentable boolean, rented boolean, geolocation string"
)
SPEAKER_MAP_DDL = (
    "assignments array<struct<speaker: string, canonical_name: string, display_name: string>>, "
    "quality_notes array<struct<observed: string, expected: string, start: double, end: double>>"
)


def without_bom(text: Column) -> Column:
    return F.regexp_replace(text, f"^{BOM}", "")


def file_list(lines: DataFrame, value: str = "value", comments: bool = True) -> DataFrame:
    """Named files: stripped lines that are not blank and, with ``comments``, not ``#`` lines."""
    line = collapse_ends(without_bom(F.col(value)))
    named = lines.withColumn(value, line).where(F.col(value) != "")
    return named.where(~F.col(value).startswith("#")) if comments else named


def collapse_ends(text: Column) -> Column:
    from speechlake.functions.text import UNICODE_SPACE as space

    return F.regexp_replace(text, f"^{space}+|{space}+$", "")


def read_file_list(
    spark: SparkSession, path: str, root: str | None = None, comments: bool = True
) -> DataFrame:
    """``path`` of every listed file; relative names are put under ``root``."""
    named = file_list(spark.read.text(path), comments=comments).withColumnRenamed("value", "path")
    if root is None:
        return named
    absolute = F.col("path").startswith("/")
    under = F.concat(F.lit(root.rstrip("/") + "/"), "path")
    return named.withColumn("path", F.when(absolute, F.col("path")).otherwise(under))


def select_listed(listed: DataFrame, existing: DataFrame, path: str = "path") -> DataFrame:
    return existing.join(listed.select(path), path, "left_semi")


def missing_listed(listed: DataFrame, existing: DataFrame, path: str = "path") -> DataFrame:
    return listed.select(path).join(existing.select(path), path, "left_anti")


def parse_match_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """The match table of a printed report; other lines are ignored."""
    part = lambda i: F.regexp_extract(value, MATCH_LINE, i)
    return lines.where(F.col(value).rlike(MATCH_LINE)).select(
        part(1).alias("file_a"), part(2).cast("double").alias("a_start_s"),
        part(3).cast("double").alias("a_end_s"), part(4).alias("file_b"),
        part(5).cast("double").alias("b_start_s"), part(6).cast("double").alias("b_end_s"),
        part(7).cast("bigint").alias("n_hashes"),
    )


def read_match_report(spark: SparkSession, path: str) -> DataFrame:
    return parse_match_lines(spark.read.text(path))


def read_progress(spark: SparkSession, path: str, ddl: str = PROGRESS_DDL) -> DataFrame:
    """Progress log with the columns of ``ddl``, read by the names in its header; missing ones are null.

    Quotes inside quoted fields are doubled and messages may hold line breaks. ``seq`` is the append order: the
    log's own column, or else file name, then row in the file. A file is read by one task, as its quotes demand.
    """
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    if "seq" not in raw.columns:
        raw = raw.withColumn("_file", F.col("_metadata.file_path")).withColumn(
            "_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        files = raw.groupBy().agg(F.array_sort(F.collect_set("_file")).alias("_files"))
        raw = raw.crossJoin(F.broadcast(files)).withColumn(
            "seq", F.array_position("_files", F.col("_file")) * F.lit(1 << 33) + F.col("_row"))
    wanted = StructType.fromDDL(ddl)
    return raw.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in wanted])


def read_demand(spark: SparkSession, path: str) -> DataFrame:
    """Hourly demand: quoted numbers, a byte-order mark, and an end hour that may be 24:00."""
    raw = spark.read.schema(DEMAND_DDL).option("header", True).csv(path)
    return raw.select(
        F.to_date(without_bom(F.col("fecha"))).alias("fecha"), "dia_semana",
        F.split("hora_inicio", ":")[0].cast("int").alias("hora"),
        F.split("hora_fin", ":")[0].cast("int").alias("hora_fin"),
        F.col("escuchas_simultaneas_maximas").cast("int").alias("escuchas"), "zona_horaria",
    )


def read_window_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCORES_DDL).option("header", True).csv(path)


def read_offers(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Offer lists: JSON arrays, or one offer per line."""
    return spark.read.schema(OFFER_DDL).option("multiLine", multi_line).json(path)


def read_speaker_maps(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Assignments and corrections of all ``*.speaker-map.json`` files under a folder."""
    docs = spark.read.schema(SPEAKER_MAP_DDL).option("multiLine", True).option(
        "recursiveFileLookup", True).option("pathGlobFilter", "*.speaker-map.json").json(path)
    name = F.regexp_extract("_metadata.file_path", r"([^/]+)\.speaker-map\.json$", 1)
    docs = docs.withColumn("audio_key", name)
    names = docs.select("audio_key", F.posexplode("assignments").alias("pos", "x")).select(
        "audio_key", "pos", "x.*")
    notes = docs.select("audio_key", F.posexplode("quality_notes").alias("pos", "x")).select(
        "audio_key", "pos", "x.*")
    return names, notes
