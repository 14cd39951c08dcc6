"""Writers of plain files. ``published`` has the form that readers never see half of."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechlake.functions.rounding import round_exact


def write_lines(lines: DataFrame, path: str, column: str, order: str = "line_no") -> None:
    """Text of every recording in its own folder, lines in order.

    Rows are range-partitioned by recording and order, so one long recording may take several
    tasks; its part files, read by name, are still in order.
    """
    (
        lines.select("audio_key", order, F.col(column).alias("value"))
        .repartitionByRange("audio_key", order).sortWithinPartitions("audio_key", order)
        .select("audio_key", "value").write.mode("overwrite").partitionBy("audio_key").text(path)
    )


def write_fragments(fragments: DataFrame, path: str, key: str = "audio_key") -> None:
    """Documents made of fragments, one folder each; their text is the parts put together."""
    (
        fragments.repartitionByRange(key, "part", "ord")
        .sortWithinPartitions(key, "part", "ord")
        .select(key, F.col("body").alias("value"))
        .write.mode("overwrite").partitionBy(key).option("lineSep", " ").text(path)
    )


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_audit(rows: DataFrame, summary: DataFrame, candidates: DataFrame, path: str,
                report: DataFrame | None = None) -> None:
    """Audit table as CSV (flags joined), the summary as JSON, one list per candidate kind, and the report in order."""
    flat = rows.withColumn("flags", F.array_join("flags", ";"))
    write_csv(flat, f"{path}/files")
    summary.write.mode("overwrite").json(f"{path}/summary")
    candidates.select("list", F.col("audio_key").cast("string").alias("value")).write.mode(
        "overwrite").partitionBy("list").text(f"{path}/candidates")
    if report is not None:
        order = ["part", "rank", "audio_key"]
        report.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(f"{path}/report")


def report_line() -> Column:
    mean = F.col("mean_word_probability")
    percent = F.when(mean.isNotNull(), F.format_string("%.1f%%", round_exact(mean * 100, 1)))
    return F.format_string(
        "| %s | %d | %d | %s | %s |", F.col("audio_key").cast("string"), "segments", "words",
        F.coalesce(percent, F.lit("—")), F.array_join("flags", ", "))


def audit_report_lines(report: DataFrame) -> DataFrame:
    """Table lines of the flagged recordings; keeps the order of the report."""
    return report.select(report_line().alias("value"))


# The report's title, totals and table head, in order.
REPORT_HEAD = (
    "# Auditoría de calidad de transcripciones",
    "",
    "- Audios: %(audio_files)s",
    "- JSON/TXT/SRT: %(json_files)s/%(txt_files)s/%(srt_files)s",
    "- Palabras evaluadas: %(total_scored_words)s",
    "- Confianza media: %(mean_word_probability)s",
    "- Palabras con confianza menor a 50%%: %(words_below_0_5_rate)s",
    "- Palabras con confianza menor a 30%%: %(words_below_0_3_rate)s",
    "- Solapamientos breves entre bloques: %(segment_overlap_events)s en %(files_with_segment_overlaps)s archivos; "
    "máximo %(max_segment_overlap_seconds)s s",
    "- Nota: la confianza del modelo no equivale a una tasa de acierto medida contra una transcripción humana.",
    "",
    "## Archivos señalados",
    "",
    "| Archivo | Segmentos | Palabras | Confianza media | Banderas |",
    "|---|---:|---:|---:|---|",
)
SHARES = ("mean_word_probability", "words_below_0_5_rate", "words_below_0_3_rate")


def audit_report(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """The report as ``part, rank, audio_key, value``: totals (part 0), then a line per flagged recording (part 1).

    Order by the first three columns: totals by line number, recordings by mean probability (none comes first) and key. The
    totals are one row, so its lines are formed on one row; the recordings are never gathered.
    """
    def shown(name: str):
        if name in SHARES:
            return F.format_string("%.2f%%", round_exact(F.coalesce(name, F.lit(0.0)) * 100, 2))
        if name == "max_segment_overlap_seconds":
            return F.format_string("%.2f", round_exact(F.col(name), 2))
        return F.col(name).cast("string")

    lines = []
    for line in REPORT_HEAD:
        pieces = re.split(r"%\((\w+)\)s", line)  # text and field names take turns
        lines.append(F.concat(*[shown(p) if i % 2 else F.lit(p.replace("%%", "%")) for i, p in enumerate(pieces)]))
    totals = summary.select(F.posexplode(F.array(*lines)).alias("rank", "value")).select(
        F.lit(0).alias("part"), F.col("rank").cast("double").alias("rank"), F.lit(None).cast("string").alias("audio_key"), "value")
    flagged = rows.where(F.size("flags") > 0)
    mean = F.coalesce("mean_word_probability", F.lit(-1.0))
    table = flagged.select(F.lit(1).alias("part"), mean.alias("rank"), F.col("audio_key").cast("string").alias("audio_key"),
                           report_line().alias("value"))
    return totals.unionByName(table)


def write_matches(matches: DataFrame, path: str) -> None:
    matches.write.mode("overwrite").json(path)


def write_embeddings(embeddings: DataFrame, path: str) -> None:
    """``audio_key, label, embedding`` with 32-bit vectors."""
    embeddings.select(
        "audio_key", "label", F.col("embedding").cast("array<float>").alias("embedding")
    ).write.mode("overwrite").parquet(path)


def append_progress(rows: DataFrame, path: str) -> None:
    """Add rows to a progress log; nothing already there is touched. Quotes inside a field are doubled."""
    rows.write.mode("append").option("header", True).option("escape", '"').csv(path)


def save_clips(clips: DataFrame, landmarks: DataFrame, name: str, buckets: int = 64, path: str | None = None) -> None:
    """Clip database as two tables; landmarks are bucketed by hash, ready to join.

    Landmarks ``item, hash, t`` that repeat are one row with their number ``n``. Rows are dealt to the buckets first, so there is one
    file a bucket. With ``path`` the files go there and the tables can be dropped without them.
    """
    if {"item", "hash", "t"} <= set(landmarks.columns):
        landmarks = landmarks.groupBy("item", "hash", "t").agg(F.count(F.lit(1)).alias("n"))
    at = lambda writer, part: writer.option("path", f"{path}/{part}") if path else writer
    at(clips.write.mode("overwrite"), "clips").saveAsTable(f"{name}_clips")
    at(landmarks.repartition(buckets, "hash").write.mode("overwrite").bucketBy(buckets, "hash").sortBy("hash"),
       "landmarks").saveAsTable(f"{name}_landmarks")


def load_clips(spark, name: str) -> tuple[DataFrame, DataFrame]:
    return spark.table(f"{name}_clips"), spark.table(f"{name}_landmarks")
