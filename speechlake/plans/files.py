"""Tables written by the sinks and read back by the sources, and nested documents taken apart."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from speechlake.operators import windows
from speechlake.operators.align import pair_documents
from speechlake.operators.checkpoints import checkpoint_dir
from speechlake.operators.units import explode_units
from speechlake.plans import audits, corpus, operations, repeats, speech
from speechlake.plans.corpus import spread, table
from speechlake.sinks import files as sink
from speechlake.sources import tables as src


def _path(spark):
    return f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


def progress_log(spark, sf):
    """Successes appended first, errors after them, then read with the log's schema."""
    path = _path(spark)
    log = audits.log(spark, sf).select(
        "seq", F.col("audio_key").cast("string").alias("audio"), "status", "seconds",
        (F.col("seconds") * 2).alias("duration"), F.lit("en").alias("language"), F.lit("a, \"b\"").alias("message"))
    for status in ("ok", "error"):
        sink.append_progress(log.where(F.col("status") == status), path)
    return src.read_progress(spark, path, src.TRANSCRIPTION_LOG_DDL)


def demand_csv(spark, sf):
    """Quoted text with a byte-order mark before the first column name."""
    path = _path(spark)
    hour = lambda h: F.format_string("%02d:00", h)
    operations.demand(spark, sf).select(
        F.col("fecha").cast("string").alias("\ufefffecha"), F.col("dia").cast("string").alias("dia_semana"),
        hour(F.col("hora")).alias("hora_inicio"), hour(F.col("hora") + 1).alias("hora_fin"),
        F.col("escuchas").cast("string").alias("escuchas_simultaneas_maximas"), F.lit("UTC").alias("zona_horaria"),
    ).write.option("header", True).option("quoteAll", True).csv(path)
    return src.read_demand(spark, path).withColumn("fecha", F.col("fecha").cast("string"))


def offers_json(spark, sf):
    path = _path(spark)
    operations.offer_rows(spark, sf).write.json(path)
    return src.read_offers(spark, path, multi_line=False).drop("geolocation")


def matches_json(spark, sf):
    path = _path(spark)
    sink.write_matches(repeats.clip_hits(spark, sf), path)
    return spark.read.schema(
        "capture bigint, clip bigint, alignment bigint, start bigint, end bigint, n_hashes bigint").json(path)


def scores_csv(spark, sf):
    path = _path(spark)
    scores = operations._scores(spark, sf).select(
        F.col("audio").cast("string").alias("audio"), "start", (F.col("start") + 10).alias("end"),
        "p_speech", "p_music", "p_singing")
    sink.write_csv(scores, path)
    return src.read_window_scores(spark, path)


def embeddings_file(spark, sf):
    path = _path(spark)
    sink.write_embeddings(table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("audio_key"), F.col("label").cast("string").alias("label"), "embedding"), path)
    return spark.read.parquet(path).select(
        "audio_key", "label", F.posexplode("embedding").alias("pos", "x"))


def nested_units(spark, sf):
    """A transcript per conversation turn: one segment with words, one without, one blank."""
    c = spread(table(spark, sf, "conversations"))
    words = F.transform(corpus._tokens("text"), lambda w, i: F.struct(
        F.when(i % 9 != 4, i * 0.5).alias("start"), (i * 0.5 + 0.25).alias("end"), w.alias("word"),
        F.lit(0.5).alias("probability")))
    none = F.lit(None).cast("double")
    segment = lambda start, text, words: F.struct(
        start.alias("start"), start.alias("end"), text.alias("text"), words.alias("words"))
    nothing = F.filter(words, lambda w: F.lit(False))
    transcripts = c.select(
        F.concat_ws("/", "conv_id", "turn").alias("audio_key"),
        F.array(segment(F.lit(0.0), F.col("text"), words), segment(F.lit(7.5), F.col("role"), nothing),
                segment(none, F.lit(" \n"), nothing), segment(none, F.col("role"), F.nullif(nothing, nothing))
                ).alias("segments"))
    return explode_units(transcripts)


def window_scores(spark, sf):
    """Every third component of the whole vector, added up, plays one of the model's logits."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("audio"), "embedding")

    def load():
        return lambda batch: [[sum(float(v) for v in x[k::3]) for k in range(3)] for x in batch]

    return windows.score_windows(vectors, "embedding", load, {0: "speech", 1: "MUSIC", 2: "Singing"})


def paired_documents(spark, sf):
    spoken = speech.speakers(spark, sf)
    heads = audits.heads(spark, sf).select("audio_key", "duration")
    return pair_documents(spoken, heads)


QUERIES = {
    "src6_snk13_progress_log": progress_log,
    "src10_demand_csv": demand_csv,
    "src13_offers_json": offers_json,
    "snk11_matches_json": matches_json,
    "snk10_window_scores_csv": scores_csv,
    "snk6_embeddings_file": embeddings_file,
    "p1_nested_units": nested_units,
    "g6_score_windows": window_scores,
    "j9_pair_documents": paired_documents,
}

ORACLES = {
    "src6_snk13_progress_log": f"""WITH {audits.LOG} SELECT seq, audio_key::VARCHAR AS audio, status, seconds,
        seconds * 2 AS duration, 'en' AS language, 'a, "b"' AS message FROM log""",
    "src10_demand_csv": f"""WITH {operations.DEMAND} SELECT fecha::VARCHAR AS fecha, dia::VARCHAR AS dia_semana, hora,
        hora + 1 AS hora_fin, escuchas::INT AS escuchas, 'UTC' AS zona_horaria FROM demand""",
    "src13_offers_json": """SELECT p_partkey AS id, p_partkey AS machine_id, p_brand AS gpu_name,
        CASE WHEN p_size % 10 = 0 THEN 2 ELSE 1 END AS num_gpus, CASE WHEN p_partkey % 97 <> 0 THEN p_retailprice END AS dph_total,
        12.0::DOUBLE + p_size % 3 AS cuda_max_good, p_size / 50 AS reliability, (p_partkey % 900)::DOUBLE AS inet_down,
        (p_partkey % 200)::DOUBLE AS disk_space, p_size <> 3 AS verified, p_size <> 4 AS rentable, p_size = 5 AS rented FROM part""",
    "snk11_matches_json": repeats.ORACLES["j6_search_clips"],
    "snk10_window_scores_csv": f"""WITH {operations.SCORES} SELECT audio::VARCHAR AS audio, start, start + 10 AS "end",
        p_speech, p_music, p_singing FROM scores""",
    "snk6_embeddings_file": """SELECT vec_id AS audio_key, label::VARCHAR AS label, (i - 1)::INT AS pos, embedding[i] AS x
        FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
    "p1_nested_units": f"""WITH {corpus.UNITS_SQL},
        timed AS (SELECT *, row_number() OVER (PARTITION BY audio_key, turn ORDER BY i) - 1 AS k FROM units WHERE i % 9 <> 4),
        listed AS (
          SELECT audio_key || '/' || turn AS audio_key, 0 AS part, k, i * 0.5::DOUBLE AS start,
            i * 0.5::DOUBLE + 0.25 AS "end", word AS text, 0.5::DOUBLE AS probability FROM timed
          UNION ALL SELECT conv_id || '/' || turn, 1, 0, 7.5, 7.5, role, NULL FROM conversations
          UNION ALL SELECT conv_id || '/' || turn, 3, 0, 0.0, 0.0, role, NULL FROM conversations
          UNION ALL SELECT conv_id || '/' || turn, 0, 0, 0.0, 0.0, text, NULL FROM conversations
            WHERE len({corpus.TOKENS}) = 0 AND {corpus.collapse_sql('text')} <> '')
        SELECT audio_key, row_number() OVER (PARTITION BY audio_key ORDER BY part, k) - 1 AS seq,
          start, "end", text, probability FROM listed""",
    "g6_score_windows": f"""SELECT vec_id AS audio, round(1 / (1 + exp(-{operations.THIRD.format(1)})), 4) AS p_speech,
        round(1 / (1 + exp(-{operations.THIRD.format(2)})), 4) AS p_music,
        round(1 / (1 + exp(-{operations.THIRD.format(3)})), 4) AS p_singing FROM embeddings""",
    "j9_pair_documents": f"""WITH {corpus.UNITS_SQL}, {audits.LISTS},
        spoken AS (SELECT audio_key, list_sort(list_distinct(list(speaker))) AS l FROM intervals GROUP BY 1)
        SELECT s.audio_key, array_to_string(l, ',') AS speakers, len(l) AS num_speakers, duration,
          h.audio_key IS NOT NULL AS has_transcript FROM spoken s LEFT JOIN heads h ON s.audio_key = h.audio_key""",
}
