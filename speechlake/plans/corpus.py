"""Speech-shaped corpora derived from the given tables.

Conversations give words, speaker intervals and segments (times in whole milliseconds);
documents and benchmark passages give landmarks (word 5-grams at word positions). Each
derivation has its SQL twin below, so a query and its oracle see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 5
TURN_MS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a table of few file splits to all cores before it is exploded.

    A large table already has more splits than cores and is returned as it is, unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _tokens(text: str):
    parts = F.split(F.regexp_replace(text, "[ \n]+", " "), " ")
    return F.filter(parts, lambda w: w != "")


def talk_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per word of a conversation turn, with its position ``i``."""
    c = spread(table(spark, sf_dir, "conversations"))
    return c.select(
        F.col("conv_id").alias("audio_key"), "turn", F.col("role"),
        F.posexplode(_tokens("text")).alias("i", "word"),
    )


def talk_units(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    start = F.col("turn") * TURN_MS + F.col("i") * 400
    prob = (F.col("audio_key") * 31 + F.col("turn") * 17 + F.col("i") * 7) % 100
    return talk_words(spark, sf_dir).select(
        "audio_key", *extra,
        (F.col("turn") * 100_000 + F.col("i")).alias("seq"),
        start.alias("start"),
        (start + 250 + (F.col("i") % 3) * 100).alias("end"),
        F.concat(F.lit(" "), "word").alias("text"),
        (prob / F.lit(100.0)).alias("probability"),
    )


def talk_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    start = F.col("turn") * TURN_MS + (F.col("conv_id") % 5) * 100
    length = (F.size(_tokens("text")) * 350).cast("bigint")
    return c.select(
        F.col("conv_id").alias("audio_key"), F.col("turn").alias("pos"),
        start.alias("start"), (start + length).alias("end"), F.col("role").alias("speaker"),
    )


def talk_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    from speechlake.operators.align import assign_speaker

    return assign_speaker(
        talk_units(spark, sf_dir), talk_intervals(spark, sf_dir),
        tolerance=750, look_back=1000, bin_width=30_000,
    )


def talk_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from speechlake.operators.turns import build_turns

    return build_turns(talk_aligned(spark, sf_dir), max_gap=800)


def grams(
    spark: SparkSession, sf_dir: str, name: str, key: str, hashed: bool = True
) -> DataFrame:
    """Landmarks of a text table: hash of every word 5-gram and its word position."""
    from speechlake.operators.landmarks import text_landmarks

    t = spread(table(spark, sf_dir, name))
    return text_landmarks(t.select(F.col(key).alias("item"), _tokens("text").alias("words")), GRAM, hashed)


# --- the same derivations in SQL ---------------------------------------------------------

TOKENS = (
    "list_filter(string_split(regexp_replace(text, '[ \\n]+', ' ', 'g'), ' '), "
    "lambda x: x <> '')"
)

UNITS_SQL = f"""
ws AS (SELECT conv_id, turn, role, {TOKENS} AS w FROM conversations),
words AS (
  SELECT conv_id AS audio_key, turn, role, w[i + 1] AS word, i
  FROM (SELECT conv_id, turn, role, w, unnest(range(len(w))) AS i FROM ws)),
units AS (
  SELECT audio_key, turn, i, turn * 100000 + i AS seq, turn * 20000 + i * 400 AS us,
         turn * 20000 + i * 400 + 250 + (i % 3) * 100 AS ue, word,
         ((audio_key * 31 + turn * 17 + i * 7) % 100) / 100.0::DOUBLE AS probability
  FROM words),
intervals AS (
  SELECT conv_id AS audio_key, turn AS pos, turn * 20000 + (conv_id % 5) * 100 AS s,
         turn * 20000 + (conv_id % 5) * 100 + len(w) * 350 AS e, role AS speaker
  FROM ws)"""

ALIGNED_SQL = UNITS_SQL + """,
scored AS (
  SELECT u.audio_key, u.seq, v.pos, v.speaker,
         greatest(0, least(ue, e) - greatest(us, s)) AS ov,
         CASE WHEN (us + ue) / 2.0 BETWEEN s AND e THEN 0
              ELSE least(abs((us + ue) / 2.0 - s), abs((us + ue) / 2.0 - e)) END AS dist
  FROM units u JOIN intervals v
    ON u.audio_key = v.audio_key AND v.s <= u.ue + 750 AND v.e >= u.us - 750),
best AS (
  SELECT audio_key, seq,
         arg_max(speaker, ov * 1000000 - pos) FILTER (WHERE ov > 0) AS by_overlap,
         arg_min(speaker, dist * 1000000 + pos) FILTER (WHERE dist <= 750) AS by_distance
  FROM scored GROUP BY audio_key, seq),
aligned AS (
  SELECT u.*, coalesce(by_overlap, by_distance, 'UNKNOWN') AS speaker
  FROM units u LEFT JOIN best b ON u.audio_key = b.audio_key AND u.seq = b.seq)"""

TURNS_SQL = ALIGNED_SQL + """,
runs AS (
  SELECT *, sum(chg) OVER (PARTITION BY audio_key ORDER BY seq) AS run
  FROM (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY audio_key ORDER BY seq)
                       THEN 0 ELSE 1 END AS chg FROM aligned)),
reach AS (
  SELECT *, max(ue) OVER (PARTITION BY audio_key, run ORDER BY seq
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far
  FROM runs),
marked AS (
  SELECT *, sum(CASE WHEN far IS NULL OR us - far > 800 THEN 1 ELSE 0 END)
            OVER (PARTITION BY audio_key ORDER BY seq) - 1 AS turn_no FROM reach),
turns AS (
  SELECT audio_key, turn_no::BIGINT AS turn_no, arg_min(us, seq) AS start_ms, max(ue) AS end_ms,
         speaker, string_agg(word, ' ' ORDER BY seq) AS text, count(*) AS unit_count
  FROM marked GROUP BY audio_key, turn_no, speaker)"""


def grams_sql(table_name: str, key: str) -> str:
    return f"""(SELECT item, i AS t, array_to_string(w[i + 1:i + {GRAM}], ' ') AS hash
  FROM (SELECT item, w, unnest(range(len(w) - {GRAM - 1})) AS i
        FROM (SELECT {key} AS item, {TOKENS} AS w FROM {table_name})))"""

SPACE_SQL = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def collapse_sql(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{SPACE_SQL}+', ' ', 'g'))"


def clock_sql(total: str, unit: int) -> str:
    return (f"(printf('%02d', ({total}) // {3600 * unit}) || ':' || "
            f"printf('%02d', (({total}) // {60 * unit}) % 60) || ':' || "
            f"printf('%02d', (({total}) // {unit}) % 60))")


def srt_sql(ms: str, mark: str = ",") -> str:
    return f"({clock_sql(ms, 1000)} || '{mark}' || printf('%03d', ({ms}) % 1000))"


def talk_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment per conversation turn, in seconds; some end before they start."""
    c = spread(table(spark, sf_dir, "conversations"))
    start = F.col("turn") * TURN_MS
    backward = (F.col("conv_id") % 13 == 0) & (F.col("turn") == 1)
    end = F.when(backward, start - 1000).otherwise(start + F.size(_tokens("text")) * 400 + 250)
    return c.select(
        F.col("conv_id").alias("audio_key"), F.col("turn").alias("segment_pos"),
        (start / 1000.0).alias("start"), (end / 1000.0).alias("end"),
        "text",
        (F.col("conv_id") % 19 != 0).alias("has_words"),
        F.size(_tokens("text")).alias("n_tokens"),
    )


def in_seconds(df: DataFrame) -> DataFrame:
    return df.withColumn("start", F.col("start") / 1000.0).withColumn("end", F.col("end") / 1000.0)


def talk_segment_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of :func:`talk_segments` with the times of their segment."""
    heads = talk_segments(spark, sf_dir).select(
        "audio_key", F.col("segment_pos").alias("turn"),
        F.col("start").alias("segment_start"), F.col("end").alias("segment_end"),
    )
    words = in_seconds(talk_units(spark, sf_dir, ("turn",)))
    return words.join(heads, ["audio_key", "turn"]).withColumnRenamed("turn", "segment_pos")


SEGMENTS_SQL = f"""
segs AS (
  SELECT conv_id AS audio_key, turn AS segment_pos, turn * 20000 AS s_ms,
         CASE WHEN conv_id % 13 = 0 AND turn = 1 THEN turn * 20000 - 1000
              ELSE turn * 20000 + len({TOKENS}) * 400 + 250 END AS e_ms,
         text,
         conv_id % 19 <> 0 AS has_words
  FROM conversations)"""
