"""JSON documents as ordered fragments: ``keys…, part, ord, body``.

A document is its fragments put together in order of ``part`` and ``ord``. Every list item is
its own row, so a long recording is never gathered into one value or one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechlake.functions.rounding import round_exact
from speechlake.functions.text import collapse_ws
from speechlake.operators.blocks import number_rows


def json_text(text: Column) -> Column:
    """The text escaped for use inside a JSON string, without the quotes."""
    quoted = F.to_json(F.array(text))
    return F.substring(quoted, F.lit(3), F.length(quoted) - 4)


def json_value(value: Column) -> Column:
    """A scalar or array as JSON; null stays the word null."""
    quoted = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)


def piece(df: DataFrame, keys: Sequence[str], part: int, body: Column) -> DataFrame:
    """One fragment per row of ``df``, such as a head or a tail."""
    return df.select(*keys, F.lit(part).alias("part"), F.lit(0).cast("bigint").alias("ord"),
                     body.alias("body"))


def items(
    df: DataFrame, keys: Sequence[str], part: int, order: str, body: Column, separator: str = ",",
    first: int | None = None,
) -> DataFrame:
    """One fragment per list item, each but the first led by the separator.

    Give ``first`` when every list is numbered from the same value; otherwise it is looked up.
    """
    rows = df.select(*keys, F.col(order).cast("bigint").alias("ord"), body.alias("_item"))
    if first is None:
        lowest = rows.groupBy(*keys).agg(F.min("ord").alias("_first"))
        rows = rows.join(lowest, list(keys))
    else:
        rows = rows.withColumn("_first", F.lit(first))
    lead = F.when(F.col("ord") == F.col("_first"), "").otherwise(separator)
    return rows.select(*keys, F.lit(part).alias("part"), "ord", F.concat(lead, "_item").alias("body"))


def assemble(*fragments: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, fragments)


LOCAL_SCOPE = "local_to_audio_file"  # fixed value: labels of speakers mean nothing outside their recording


def _members(**columns: Column) -> Column:
    """``"name":value`` for each column, comma-joined; nulls are written."""
    return F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), json_value(c)) for n, c in columns.items()])


def _seconds(name: str) -> Column:
    return round_exact(F.col(name), 3)


def _object(*names: str) -> Column:
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def diarization_document(heads: DataFrame, regular: DataFrame, exclusive: DataFrame) -> DataFrame:
    """Fragments of the diarization document of each recording.

    ``heads``: ``audio_key, audio, model, created_at_utc, duration_seconds, processing_seconds, speakers`` (array, in the order of the
    model's labels). ``regular`` and ``exclusive``: intervals ``audio_key, pos, start, end, speaker``; lists come in order of ``pos``, times
    rounded to milliseconds. Recordings without intervals get empty lists.
    """
    keys = ["audio_key"]

    def listed(intervals: DataFrame, part: int) -> DataFrame:
        rows = intervals.select("audio_key", "pos", _seconds("start").alias("start"), _seconds("end").alias("end"), "speaker")
        return items(rows, keys, part, "pos", _object("start", "end", "speaker"))

    head = F.concat(F.lit("{"), _members(
        audio=F.col("audio"), model=F.col("model"), created_at_utc=F.col("created_at_utc"), duration_seconds=_seconds("duration_seconds"),
        processing_seconds=_seconds("processing_seconds"), speaker_scope=F.lit(LOCAL_SCOPE), speakers=F.col("speakers"),
        num_speakers=F.size("speakers")), F.lit(',"diarization":['))
    return assemble(piece(heads, keys, 0, head), listed(regular, 1), piece(heads, keys, 2, F.lit('],"exclusive_diarization":[')),
                    listed(exclusive, 3), piece(heads, keys, 4, F.lit("]}")))


def speakers_document(heads: DataFrame, units: DataFrame, turns: DataFrame) -> DataFrame:
    """Fragments of the speakers document: who said each unit, and the turns.

    ``heads``: ``audio_key, audio, speakers``; ``units``: ``audio_key, seq, start, end, text, probability, speaker``; ``turns``: as
    :func:`speechlake.operators.turns.build_turns` gives them. Unit times are written as they are, lists in order of ``seq`` and ``turn_no``.
    """
    keys = ["audio_key"]
    head = F.concat(F.lit("{"), _members(
        audio=F.col("audio"), speaker_scope=F.lit(LOCAL_SCOPE), speakers=F.col("speakers")), F.lit(',"units":['))
    return assemble(
        piece(heads, keys, 0, head), items(units, keys, 1, "seq", _object("start", "end", "text", "probability", "speaker")),
        piece(heads, keys, 2, F.lit('],"turns":[')),
        items(turns, keys, 3, "turn_no", _object("start", "end", "speaker", "text", "unit_count"), first=0), piece(heads, keys, 4, F.lit("]}")))


def transcript_document(heads: DataFrame, segments: DataFrame) -> DataFrame:
    """Fragments of the transcript document.

    ``heads``: ``audio_key, audio, language, language_probability, duration, duration_after_vad``; ``segments``: ``audio_key, segment_pos, id, start,
    end, text, avg_logprob, no_speech_prob, compression_ratio, words``. Blank segments are left out, white space is collapsed, and a segment
    without words gets an empty list.
    """
    shown = segments.withColumn("text", collapse_ws(F.col("text"))).where("text <> ''")
    shown = shown.withColumn("words", F.coalesce("words", F.from_json(F.lit("[]"), shown.schema["words"].dataType)))
    head = F.concat(F.lit("{"), _members(**{n: F.col(n) for n in (
        "audio", "language", "language_probability", "duration", "duration_after_vad")}), F.lit(',"segments":['))
    body = _object("id", "start", "end", "text", "avg_logprob", "no_speech_prob", "compression_ratio", "words")
    return assemble(piece(heads, ["audio_key"], 0, head), items(shown, ["audio_key"], 1, "segment_pos", body),
                    piece(heads, ["audio_key"], 2, F.lit("]}")))


def index_document(index: DataFrame, numbered: str, **header: str) -> DataFrame:
    """Fragments of the one document that lists all results; ``numbered`` is the column of the order, ``header`` its first members.

    Counts come from one aggregate; each recording is a fragment of its own, so the list is never gathered.
    """
    counts = index.agg(F.count(F.lit(1)).alias("audio_count"), F.coalesce(F.count_if("complete"), F.lit(0)).alias("complete_count"))
    head = F.concat(F.lit("{"), _members(**{n: F.lit(v) for n, v in header.items()}, audio_count=F.col("audio_count"),
                                         complete_count=F.col("complete_count")), F.lit(',"items":['))
    fields = [c for c in index.columns if c != numbered]
    return assemble(piece(counts, [], 0, head), items(index, [], 1, numbered, _object(*fields), first=1), piece(counts, [], 2, F.lit("]}")))


def write_containers(fragments: DataFrame, keys: Sequence[str], path: str) -> None:
    """A few large files that hold all documents, each one's fragments in order and next to each other."""
    fragments.repartitionByRange(*keys, "part", "ord").sortWithinPartitions(*keys, "part", "ord").write.mode("overwrite").parquet(path)


def read_containers(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """``keys…, document``: every document as one text, for readers that need it whole."""
    pieces = F.array_sort(F.collect_list(F.struct("part", "ord", "body")))
    return spark.read.parquet(path).groupBy(*keys).agg(
        F.array_join(F.transform(pieces, lambda x: x["body"]), "").alias("document"))


def numbered(rows: DataFrame, by: str, out: str = "place", cells: int = 256) -> DataFrame:
    """The rows with ``out``, from 1 in the order of ``by`` (distinct texts), numbered over cells of close texts, not in one task."""
    place = F.conv(F.rpad(F.substring(F.hex(by), 1, 14), 14, "0"), 16, 10).cast("bigint")  # the first seven bytes, in order of texts
    marks = rows.select(F.percentile_approx(place, [k / cells for k in range(1, cells)], 10_000).alias("m")).first().m
    bounds = sorted(set(marks or []))
    cell = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= place)) if bounds else F.lit(0)
    return number_rows(rows.withColumn("_cell", cell), [], [by], out, "_cell").drop("_cell")
