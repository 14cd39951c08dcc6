"""Spectra, peaks and landmarks over numeric tables that stand in for sound."""

from __future__ import annotations

from pyspark.sql import functions as F

from speechlake.operators import landmarks as lm
from speechlake.operators.blocks import number_rows, with_block
from speechlake.plans.corpus import table

WINDOW, HOP, CHUNK = 16, 8, 32


def _pcm(spark, sf):
    """Embeddings as sound: 64 samples each, in chunks of 32."""
    e = table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("item_id"), F.posexplode(F.array(
        F.slice("embedding", 1, CHUNK), F.slice("embedding", CHUNK + 1, CHUNK))).alias("chunk_no", "samples")
    ).withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


def spectrum(spark, sf):
    s = lm.spectrogram(_pcm(spark, sf), CHUNK, WINDOW, HOP)
    return s.select("item_id", "frame", F.posexplode("db").alias("bin", "db")).withColumn("db", F.round("db", 5))


def _grid(spark, sf):
    """One grid per label: a frame per embedding in order of id, a bin for each of its numbers."""
    e = table(spark, sf, "embeddings").select("label", "vec_id", F.transform(
        "embedding", lambda x: F.floor(x.cast("double") * 1000) / 8.0).alias("db"))
    numbered = number_rows(with_block(e, "vec_id", 64), ["label"], ["vec_id"], "frame")
    return numbered.select(F.col("label").alias("item_id"), (F.col("frame") - 1).alias("frame"), "db")


def thresholds(spark, sf):
    return lm.level_threshold(_grid(spark, sf)).withColumn("threshold", F.round("threshold", 6))


def peaks(spark, sf):
    return lm.find_peaks(_grid(spark, sf), block=16)


def _points(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("item_id"), F.col("l_partkey").alias("t"), (F.col("l_orderkey") % 97).alias("f"))


def paired(spark, sf):
    return lm.pair_peaks(_points(spark, sf), block=512)


def cut_clips(spark, sf):
    """Two clips per item, in samples at one sample per second."""
    k = F.col("vec_id")
    clips = table(spark, sf, "embeddings").select(F.explode(F.array(
        F.struct(F.concat(k.cast("string"), F.lit("a")).alias("clip"), k.alias("item_id"),
                 (k % 20).cast("double").alias("start_s"), (k % 20 + 35).cast("double").alias("end_s")),
        F.struct(F.concat(k.cast("string"), F.lit("b")).alias("clip"), k.alias("item_id"),
                 (k % 40).cast("double").alias("start_s"), F.lit(90.0).alias("end_s")))).alias("c")).select("c.*")
    cut = lm.clip_pcm(_pcm(spark, sf), clips, CHUNK, 1)
    return cut.select(F.col("item_id").alias("clip"), "chunk_no", F.posexplode("samples").alias("pos", "sample"))


QUERIES = {
    "g1_spectrogram": spectrum,
    "g2_level_threshold": thresholds,
    "g2_find_peaks": peaks,
    "g3_f11_pair_peaks": paired,
    "g4_clip_pcm": cut_clips,
}

GRID = """
grid AS (SELECT item_id, frame, b - 1 AS f, floor(embedding[b]::DOUBLE * 1000) / 8 AS db FROM
  (SELECT *, unnest(range(1, len(embedding) + 1)) AS b FROM (SELECT label AS item_id, embedding,
          row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame FROM embeddings))),
thr AS (SELECT item_id, quantile_cont(db, 0.75) AS threshold FROM grid GROUP BY 1)"""

ORACLES = {
    "g1_spectrogram": """WITH x AS (SELECT vec_id, fr, n, embedding[fr * 8 + n + 1]::DOUBLE * (0.5 - 0.5 * cos(2 * pi() * n / 15)) AS v
          FROM embeddings, (SELECT unnest(range(7)) AS fr), (SELECT unnest(range(16)) AS n)),
        y AS (SELECT vec_id, fr, b, sum(v * cos(2 * pi() * b * n / 16)) AS re, sum(v * sin(2 * pi() * b * n / 16)) AS im
          FROM x, (SELECT unnest(range(9)) AS b) GROUP BY 1, 2, 3)
        SELECT vec_id AS item_id, fr AS frame, b::INT AS bin, round(20 * log10(sqrt(re * re + im * im) + 1e-6), 5) AS db FROM y""",
    "g2_level_threshold": f"WITH {GRID} SELECT item_id, round(threshold, 6) AS threshold FROM thr",
    "g2_find_peaks": f"""WITH {GRID}
        SELECT g.item_id, g.frame AS t, g.f FROM grid g JOIN thr USING (item_id)
        WHERE g.db > threshold AND NOT EXISTS (SELECT 1 FROM grid h WHERE h.item_id = g.item_id
          AND h.frame BETWEEN g.frame - 10 AND g.frame + 9 AND h.f BETWEEN g.f - 5 AND g.f + 4 AND h.db > g.db)""",
    "g3_f11_pair_peaks": """WITH p AS (SELECT DISTINCT l_suppkey AS item, l_partkey AS t, l_orderkey % 97 AS f FROM lineitem),
        r AS (SELECT a.item, a.t, a.f AS f1, b.f AS f2, b.t - a.t AS dt, row_number() OVER
              (PARTITION BY a.item, a.t, a.f ORDER BY b.t, b.f) AS k
              FROM p a JOIN p b ON a.item = b.item AND b.t BETWEEN a.t + 1 AND a.t + 200)
        SELECT item, ((f1 << 20) | (f2 << 10) | dt)::BIGINT AS hash, t FROM r WHERE k <= 5""",
    "g4_clip_pcm": """WITH c AS (SELECT vec_id || 'a' AS clip, embedding, vec_id % 20 AS a, vec_id % 20 + 35 AS b FROM embeddings
          UNION ALL SELECT vec_id || 'b', embedding, vec_id % 40, 64 FROM embeddings),
        s AS (SELECT clip, a, embedding, unnest(range(a, b)) AS i FROM c)
        SELECT clip, (i - a) // 32 AS chunk_no, ((i - a) % 32)::INT AS pos, embedding[i + 1] AS sample FROM s""",
}
