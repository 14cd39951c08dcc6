"""Result documents, written as containers and read back: what a later stage sees of them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from speechlake.operators.checkpoints import checkpoint_dir, settle
from speechlake.operators.turns import build_turns
from speechlake.operators.units import with_positions
from speechlake.plans import audits, speech
from speechlake.plans import corpus as c
from speechlake.sinks import documents as docs
from speechlake.sources.documents import DIARIZATION_DDL, SPEAKERS_DDL, TRANSCRIPT_DDL, read_documents

MODEL = "hub/speaker-community-1"
CREATED = "2026-10-12T00:00:00+00:00"


def _round_trip(spark, fragments, keys, ddl):
    """Write the documents, read them whole and parse them."""
    path = f"{checkpoint_dir(spark)}/documents-{uuid.uuid4().hex}"
    docs.write_containers(fragments, keys, path)
    return docs.read_containers(spark, path, keys).select(*keys, F.from_json("document", ddl, {"mode": "FAILFAST"}).alias("d"))


def _as_files(spark, fragments, ddl):
    """A file per recording, as other programs leave them, read by the document reader; every 17th was cut short."""
    folder = f"{checkpoint_dir(spark)}/documents-{uuid.uuid4().hex}"
    docs.write_containers(fragments, ["audio_key"], f"{folder}/containers")
    whole = docs.read_containers(spark, f"{folder}/containers", ["audio_key"])
    cut = F.when(F.col("audio_key") % 17 == 0, F.substring("document", F.lit(1), F.floor(F.length("document") / 2).cast("int")))
    whole.select("audio_key", F.coalesce(cut, "document").alias("value")).write.partitionBy("audio_key").text(f"{folder}/files")
    found = read_documents(spark, f"{folder}/files", ddl, ".txt")
    return found.withColumn("audio_key", F.regexp_extract("audio_key", "audio_key=([0-9]+)/", 1).cast("bigint"))


def transcript_files(spark, sf):
    found = _as_files(spark, _transcripts(spark, sf), TRANSCRIPT_DDL)
    words = F.aggregate("segments", F.lit(0).cast("long"), lambda n, s: n + F.size(s["words"]))
    return found.select("audio_key", "parse_ok", "audio", "language", "duration", F.when(F.col("parse_ok"), F.size("segments")).cast("long").alias("n_segments"),
                        words.alias("n_words"))


def _speakers(spark, sf):
    """Speakers documents; the aligned units are written once, for the units and for the turns."""
    units = settle(c.talk_aligned(spark, sf))
    return docs.speakers_document(_heads(spark, sf), c.in_seconds(units), c.in_seconds(build_turns(units, max_gap=800)))


def speakers_files(spark, sf):
    found = _as_files(spark, _speakers(spark, sf), SPEAKERS_DDL)
    counted = lambda name: F.when(F.col("parse_ok"), F.size(name)).cast("long").alias(f"n_{name}")
    return found.select("audio_key", "parse_ok", "speaker_scope", counted("units"), counted("turns"), F.element_at("turns", -1)["end"].alias("last_end"))


def _heads(spark, sf):
    audio = F.concat(F.col("audio_key").cast("string"), F.lit(".wav"))
    return speech.speakers(spark, sf).select("audio_key", audio.alias("audio"), F.split("speakers", ",").alias("speakers"))


def assigned_positions(spark, sf):
    return with_positions(c.talk_intervals(spark, sf), 60_000).select("audio_key", "pos", "start", "end", "speaker")


def _exclusive(intervals):
    """The intervals cut where the next one starts."""
    after = intervals.select("audio_key", (F.col("pos") - 1).alias("pos"), F.col("start").alias("_next"))
    return intervals.join(after, ["audio_key", "pos"], "left").withColumn("end", F.least("end", "_next")).drop("_next")


def diarization_document(spark, sf):
    regular = assigned_positions(spark, sf)
    took = F.col("audio_key") * 0.0125
    heads = _heads(spark, sf).select("*", F.lit(MODEL).alias("model"), F.lit(CREATED).alias("created_at_utc"),
                                     (took * 2).alias("duration_seconds"), took.alias("processing_seconds"))
    back = _round_trip(spark, docs.diarization_document(heads, c.in_seconds(regular), c.in_seconds(_exclusive(regular))), ["audio_key"], DIARIZATION_DDL)
    lists = F.explode(F.array(*[F.struct(F.lit(n).alias("list"), F.col(f"d.{n}").alias("held")) for n in ("diarization", "exclusive_diarization")]))
    flat = back.select("audio_key", "d.audio", "d.model", "d.created_at_utc", "d.duration_seconds", "d.processing_seconds", "d.speaker_scope",
                       F.array_join("d.speakers", ",").alias("speakers"), "d.num_speakers", lists.alias("l"))
    return flat.select(*[n for n in flat.columns if n != "l"], "l.list", F.posexplode("l.held").alias("pos", "i")).select(
        "*", "i.start", "i.end", "i.speaker").drop("i")


def speakers_document(spark, sf):
    back = _round_trip(spark, _speakers(spark, sf), ["audio_key"], SPEAKERS_DDL)
    said = F.aggregate("d.units", F.lit(0).cast("long"), lambda n, u: n + F.length(u["text"]) + F.when(u["speaker"] == "UNKNOWN", 0).otherwise(1))
    return back.select("audio_key", "d.audio", "d.speaker_scope", F.size("d.units").cast("long").alias("n_units"), said.alias("unit_sum"),
                       F.posexplode("d.turns").alias("turn_no", "t")).select("*", "t.*").drop("t")


def _transcripts(spark, sf):
    spoken = c.talk_segments(spark, sf)
    words = F.filter(F.transform(F.split("text", r"\s+"), lambda w: F.struct(
        F.lit(0.5).alias("start"), F.lit(None).cast("double").alias("end"), w.alias("word"), F.lit(0.25).alias("probability"))), lambda x: x["word"] != "")
    no = F.lit(None).cast("double")
    segments = spoken.select(
        "audio_key", "segment_pos", F.col("segment_pos").cast("int").alias("id"), "start", "end", "text", no.alias("avg_logprob"),
        F.lit(0.125).alias("no_speech_prob"), no.alias("compression_ratio"), F.when(F.col("has_words"), words).alias("words"))
    heads = _heads(spark, sf).select("audio_key", "audio", F.lit("es").alias("language"), F.lit(0.5).alias("language_probability"),
                                     (F.col("audio_key") * 0.5).alias("duration"), no.alias("duration_after_vad"))
    return docs.transcript_document(heads, segments)


def transcript_document(spark, sf):
    back = _round_trip(spark, _transcripts(spark, sf), ["audio_key"], TRANSCRIPT_DDL)
    return back.select("audio_key", "d.language", "d.duration", F.explode("d.segments").alias("s")).select(
        "audio_key", "language", "duration", F.col("s.id").cast("long").alias("id"), "s.start", "s.end", "s.text",
        F.size("s.words").cast("long").alias("n_words"))


def index_document(spark, sf):
    index = audits.result_index(spark, sf).withColumn("audio", F.concat(F.col("audio_key").cast("string"), F.lit(".wav")))
    numbered = docs.numbered(index.drop("audio_key"), "audio")
    fragments = docs.index_document(numbered, "place", created_at_utc=CREATED, whisper_model="large-v3", pyannote_model=MODEL)
    names = [n for n in numbered.columns if n != "place"]
    ddl = ("created_at_utc string, audio_count long, complete_count long, items array<struct<"
           + ", ".join(f"{n}: {'boolean' if n == 'complete' else 'string'}" for n in names) + ">>")
    back = _round_trip(spark, fragments.withColumn("document_key", F.lit("index")), ["document_key"], ddl)
    return back.select("d.created_at_utc", "d.audio_count", "d.complete_count", F.posexplode("d.items").alias("place", "i")).select(
        "*", "i.*").drop("i")


QUERIES = {
    "p2_assigned_positions": assigned_positions,
    "snk1_transcript_json": transcript_document,
    "src4_transcript_files": transcript_files,
    "src5_speakers_files": speakers_files,
    "snk2_diarization_document": diarization_document,
    "snk4_speakers_json": speakers_document,
    "snk7_index_json": index_document,
}

_SPOKEN = "spoken AS (SELECT audio_key, list_sort(list_distinct(list(speaker))) AS l FROM intervals GROUP BY 1)"
_PLACED = "placed AS (SELECT *, row_number() OVER (PARTITION BY audio_key ORDER BY s, e, speaker) - 1 AS p FROM intervals)"

ORACLES = {
    "p2_assigned_positions": f"""WITH {c.UNITS_SQL}, {_PLACED} SELECT audio_key, p AS pos, s AS start, e AS "end", speaker FROM placed""",
    "snk1_transcript_json": f"""WITH {c.SEGMENTS_SQL}, shown AS (SELECT *, {c.collapse_sql('text')} AS t FROM segs)
        SELECT audio_key, 'es' AS language, audio_key * 0.5::DOUBLE AS duration, segment_pos::BIGINT AS id, s_ms / 1000.0::DOUBLE AS start,
          e_ms / 1000.0::DOUBLE AS "end", t AS text,
          CASE WHEN has_words THEN len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) ELSE 0 END::BIGINT AS n_words
        FROM shown WHERE t <> ''""",
    "src4_transcript_files": f"""WITH {c.SEGMENTS_SQL}, shown AS (SELECT *, {c.collapse_sql('text')} AS t FROM segs),
        held AS (SELECT audio_key, count(*) AS n, sum(CASE WHEN has_words THEN len(list_filter(regexp_split_to_array(text, '\\s+'),
            lambda w: w <> '')) ELSE 0 END)::BIGINT AS k FROM shown WHERE t <> '' GROUP BY 1),
        keys AS (SELECT DISTINCT audio_key, audio_key % 17 <> 0 AS ok FROM segs)
        SELECT audio_key, ok AS parse_ok, CASE WHEN ok THEN audio_key || '.wav' END AS audio, CASE WHEN ok THEN 'es' END AS language,
          CASE WHEN ok THEN audio_key * 0.5::DOUBLE END AS duration, CASE WHEN ok THEN coalesce(n, 0) END AS n_segments,
          CASE WHEN ok THEN coalesce(k, 0) END AS n_words FROM keys LEFT JOIN held USING (audio_key)""",
    "src5_speakers_files": f"""WITH {c.TURNS_SQL},
        keys AS (SELECT DISTINCT audio_key, audio_key % 17 <> 0 AS ok FROM intervals),
        u AS (SELECT audio_key, count(*) AS n FROM aligned GROUP BY 1),
        t AS (SELECT audio_key, count(*) AS n, arg_max(end_ms, turn_no) AS e FROM turns GROUP BY 1)
        SELECT k.audio_key, ok AS parse_ok, CASE WHEN ok THEN 'local_to_audio_file' END AS speaker_scope, CASE WHEN ok THEN coalesce(u.n, 0) END AS n_units,
          CASE WHEN ok THEN coalesce(t.n, 0) END AS n_turns, CASE WHEN ok THEN e / 1000.0::DOUBLE END AS last_end
        FROM keys k LEFT JOIN u ON k.audio_key = u.audio_key LEFT JOIN t ON k.audio_key = t.audio_key""",
    "snk2_diarization_document": f"""WITH {c.UNITS_SQL}, {_SPOKEN}, {_PLACED},
        lists AS (SELECT audio_key, 'diarization' AS list, p, s, e, speaker FROM placed
          UNION ALL SELECT audio_key, 'exclusive_diarization', p, s, least(e, coalesce(lead(s) OVER (PARTITION BY audio_key ORDER BY p), e)), speaker FROM placed)
        SELECT audio_key, audio_key || '.wav' AS audio, '{MODEL}' AS model, '{CREATED}' AS created_at_utc,
          printf('%.3f', audio_key * 0.0125::DOUBLE * 2)::DOUBLE AS duration_seconds,
          printf('%.3f', audio_key * 0.0125::DOUBLE)::DOUBLE AS processing_seconds, 'local_to_audio_file' AS speaker_scope,
          array_to_string(l, ',') AS speakers, len(l)::INT AS num_speakers, list, p::INT AS pos, s / 1000.0::DOUBLE AS start,
          e / 1000.0::DOUBLE AS "end", speaker
        FROM lists JOIN spoken USING (audio_key)""",
    "snk4_speakers_json": f"""WITH {c.TURNS_SQL},
        told AS (SELECT audio_key, count(*) AS n, sum(length(word) + 1 + CASE WHEN speaker = 'UNKNOWN' THEN 0 ELSE 1 END)::BIGINT AS k
                 FROM aligned GROUP BY 1)
        SELECT audio_key, audio_key || '.wav' AS audio, 'local_to_audio_file' AS speaker_scope, n AS n_units, k AS unit_sum,
          turn_no::INT AS turn_no, start_ms / 1000.0::DOUBLE AS start, end_ms / 1000.0::DOUBLE AS "end", speaker, text, unit_count
        FROM turns JOIN told USING (audio_key)""",
    "snk7_index_json": f"""WITH {audits.LISTS}, listed AS ({audits.INDEX})
        SELECT '{CREATED}' AS created_at_utc, count(*) OVER () AS audio_count, count(*) FILTER (WHERE complete) OVER () AS complete_count,
          (row_number() OVER (ORDER BY audio_key || '.wav') - 1)::INT AS place, transcription_json, diarized_transcription_json,
          diarized_transcription_txt, diarized_subtitles_srt, speaker_scope, complete, audio_key || '.wav' AS audio
        FROM listed""",
}
