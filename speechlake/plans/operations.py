"""Capacity, offers, windows, checks and queue polls over the business tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from speechlake.functions import text as fx
from speechlake.operators import capacity as cap
from speechlake.operators import hygiene, idle, offers, windows
from speechlake.plans import corpus as c
from speechlake.plans.corpus import table
from speechlake.sources import tables as src

FACTOR = 3
GPUS = [f"Brand#{i}" for i in (7, 3, 12, 21)]
EXCLUDED = [11, 77]
TOKENS = r"(?:sk-|AKIA|token|password)[A-Za-z0-9_-]*"
ERROR_TOKEN = "s3cret\"key"


def demand(spark, sf):
    return cap.hourly_demand(table(spark, sf, "events"), "ts")


def day_profile(spark, sf):
    return cap.day_profile(demand(spark, sf)).withColumn("fecha", F.col("fecha").cast("string"))


def weekday_profile(spark, sf):
    return cap.weekday_profile(demand(spark, sf)).withColumn("mean", F.round("mean", 6))


def schedule(spark, sf):
    return demand(spark, sf).withColumn("machines", cap.machines_needed(F.col("escuchas"), factor=FACTOR))


def schedule_rows(spark, sf):
    return cap.with_starts(schedule(spark, sf)).select(
        F.col("fecha").cast("string").alias("fecha"), "hora", "escuchas", "machines", "starts")


def schedule_cost(spark, sf):
    return cap.schedule_cost(schedule(spark, sf)).withColumn("cost", F.round("cost", 6))


def backlog(spark, sf):
    fleet = cap.fixed_fleet(demand(spark, sf), 14.0)
    return fleet.select(
        F.col("fecha").cast("string").alias("fecha"), "hora", F.round("backlog", 6).alias("backlog"),
        F.round("delay", 6).alias("delay"),
        cap.machines_needed(F.col("escuchas"), F.col("backlog"), 2.0, FACTOR).alias("machines"))


def ranges(spark, sf):
    return cap.schedule_ranges(schedule(spark, sf)).withColumn("fecha", F.col("fecha").cast("string"))


def offer_rows(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf, "part").select(
        k.alias("id"), k.alias("machine_id"), F.col("p_brand").alias("gpu_name"),
        F.when(size % 10 == 0, 2).otherwise(1).alias("num_gpus"),
        F.when(k % 97 != 0, F.col("p_retailprice")).alias("dph_total"),
        (12.0 + (size % 3)).alias("cuda_max_good"), (size / 50.0).alias("reliability"),
        (k % 900).cast("double").alias("inet_down"), (k % 200).cast("double").alias("disk_space"),
        (size != 3).alias("verified"), (size != 4).alias("rentable"), (size == 5).alias("rented"))


def suitable(spark, sf):
    return offers.suitable_offers(
        offer_rows(spark, sf), GPUS, min_disk=40, min_reliability=0.3, min_download=100,
        max_price=1500, excluded=EXCLUDED).select("id", "gpu_name", "dph_total")


def ranked(spark, sf):
    return offers.rank_offers(offer_rows(spark, sf), GPUS, EXCLUDED).select(
        "id", "gpu_name", "dph_total", "preference")


def _runs(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
                 "l_extendedprice").alias("run"),
        F.col("l_linenumber").alias("config"), F.col("l_extendedprice").alias("audio_s"),
        F.col("l_quantity").alias("elapsed_s"), (F.col("l_suppkey") % 5).alias("n_spk"),
        (-F.col("l_tax")).alias("mean_logprob"), (1 - F.col("l_discount")).alias("similarity"))


def _best(accepted):
    def query(spark, sf):
        best = offers.best_configuration(offers.leaderboard(_runs(spark, sf), "run", 0.97), accepted)
        return best.withColumn("best_rtf", F.round("best_rtf", 6))
    return query


def configurations(spark, sf):
    runs = _runs(spark, sf).withColumn("segments", F.col("run.l_partkey") % 50).withColumn("chars", F.col("run.l_orderkey") % 5000)
    made = offers.configuration_table(runs)
    return made.withColumn("mean_logprob", F.round("mean_logprob", 6)).withColumn("rtf", F.round("rtf", 6))


def _recordings(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("seconds"))


def clips(spark, sf):
    return windows.tile_clips(_recordings(spark, sf), "seconds").select("o_orderkey", "start", "end")


def voiced(spark, sf):
    k = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("start"),
        (F.col("l_partkey") + F.col("l_quantity").cast("bigint") * 160).alias("end"))
    return windows.voice_seconds(k, "l_orderkey", 16000).withColumn("voice_seconds", F.round("voice_seconds", 6))


def slides(spark, sf):
    return windows.sliding_windows(_recordings(spark, sf), "seconds").select("o_orderkey", "start", "end")


def _scores(spark, sf):
    """Every third component of the whole vector, added up in order, plays one of the three scores."""
    third = lambda i: F.filter("embedding", lambda x, k: k % 3 == i)
    p = lambda i: F.round(F.aggregate(third(i), F.lit(0.0), lambda a, x: a + x.cast("double")) + 0.5, 4)
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("audio"), (F.col("vec_id") * 5.0).alias("start"),
        p(0).alias("p_speech"), p(1).alias("p_music"), p(2).alias("p_singing"))


def dropped(spark, sf):
    return windows.drop_candidates(_scores(spark, sf))


def first_dropped(spark, sf):
    return windows.first_candidates(_scores(spark, sf))


def longest_recordings(spark, sf):
    """First thousand recordings by key, as a limited run would take them."""
    return _recordings(spark, sf).orderBy("o_orderkey").limit(1000).select("o_orderkey")


def redacted(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fx.redact(F.col("text"), (), TOKENS).alias("text"))


def error_details(spark, sf):
    k = F.col("event_id").cast("string")
    tagged = F.concat(F.lit('{"error":"bad  hf_abc'), k, F.lit('\\nkey s3cret\\"key","detail":"","event":'), "props", F.lit("}"))
    listed = F.concat(F.lit('{"title":0,"message":'), "props", F.lit("}"))
    page = F.concat(F.lit("<p>\t rpa_x-"), k, F.lit(" "), "props", F.lit(" </p>\n"))
    empty = F.regexp_replace("props", "(?s).", "")
    bodies = {"plain": F.col("props"), "json": tagged, "nested": listed, "page": page, "empty": empty}
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), body.alias("body")) for kind, body in bodies.items()])
    return table(spark, sf, "events").select("event_id", F.inline(pairs)).select(
        "event_id", "kind", fx.redacted_detail(F.col("body"), [ERROR_TOKEN]).alias("detail"))


def leaks(spark, sf):
    return hygiene.leaked_tokens(table(spark, sf, "documents"), "text", TOKENS).select("doc_id")


REQUIRED = ["docs/en/1", "missing.txt", "README"]


def findings(spark, sf):
    """Pages as files: paths of their URLs; texts that hold tokens join the same list."""
    path = F.substring_index(F.substring_index(F.substring_index("url", "?", 1), "#", 1), "://", -1)
    listing = table(spark, sf, "pages").select(path.alias("path"))
    policy = hygiene.policy_findings(listing, REQUIRED, folders=("fr", "de"), suffixes=(".html", ".php"))
    return policy.unionByName(hygiene.leak_findings(table(spark, sf, "documents"), "doc_id", "text", TOKENS))


def polls(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").alias("source"), F.col("event_id").alias("seq"),
        F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts AS timestamp_ntz))")
        .alias("poll_ts"), (F.col("event_type") != "purchase").alias("empty"))


def idle_windows(spark, sf):
    return idle.idle_windows(polls(spark, sf), gap=100_000, idle_seconds=86_400, block_rows=512)


def _status_texts(spark, sf):
    kind = F.col("event_id") % 9
    jobs = (F.when(kind == 1, "false").when(kind == 2, '"0"').when(kind == 3, "1.5")
            .otherwise((F.col("user_id") % 2).cast("string")))
    caps = F.when(kind == 4, '["transcription"]').otherwise('["diarization","transcription"]')
    last = F.when(kind == 5, "").when(kind == 6, ',"next_available_at":"2026-10-29T15:00:00Z"').otherwise(
        ',"next_available_at":null')
    leases = F.when(kind == 7, "-1").otherwise("0")
    return table(spark, sf, "events").select("event_id", F.concat(
        F.lit('{"capabilities":'), caps, F.lit(',"available_jobs":'), jobs,
        F.lit(',"active_leases":'), leases, last, F.when(kind == 8, "").otherwise("}")).alias("status"))


CAPABILITIES = ["transcription", "diarization"]
POLL_SECONDS = 30.0


def controller_polls(spark, sf):
    """Polls of a machine: the queue's status, the machine's state, and how long the poll took."""
    texts = _status_texts(spark, sf).withColumnRenamed("event_id", "seq")
    return polls(spark, sf).drop("empty").join(texts, "seq").select(
        "source", "seq", "poll_ts", "status", F.when(F.col("seq") % 11 == 3, "loading").otherwise("running").alias("machine_state"),
        F.when(F.col("seq") % 13 == 4, 61.5).otherwise(0.5).alias("took_seconds"))


def controller_windows(spark, sf):
    judged = idle.judged_polls(idle.parse_polls(controller_polls(spark, sf).where(F.col("seq") % 100 != 50), CAPABILITIES), POLL_SECONDS)
    return idle.idle_windows(judged, gap=100_000, idle_seconds=86_400, block_rows=512).select(
        "source", "seq", "poll_ts", "empty", "since", "fires")


def parsed_polls(spark, sf):
    parsed = idle.parse_polls(_status_texts(spark, sf), ["transcription", "diarization"])
    return parsed.select("event_id", "valid", "empty")


def listed_files(spark, sf):
    lines = table(spark, sf, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "value"))
    return src.file_list(lines)


def match_report(spark, sf):
    li = table(spark, sf, "lineitem")
    sep = F.when(F.col("l_linenumber") == 1, "->").otherwise("<->")
    line = F.format_string(
        "  f%d [%6.1fs-%6.1fs]  %s  g%d [%6.1fs-%6.1fs]  (%d hashes)", "l_orderkey",
        F.col("l_partkey") / 2, F.col("l_partkey") / 2 + 7, sep, "l_suppkey", F.col("l_quantity"),
        F.col("l_quantity") + 7, F.col("l_partkey"))
    return src.parse_match_lines(li.select(line.alias("value")))


QUERIES = {
    "c1_day_profile": day_profile,
    "c1_weekday_profile": weekday_profile,
    "c2_c4_schedule_starts": schedule_rows,
    "c4_schedule_cost": schedule_cost,
    "c5_c3_backlog": backlog,
    "c6_schedule_ranges": ranges,
    "p6_suitable_offers": suitable,
    "t1_ranked_offers": ranked,
    "a10_best_same_speakers": _best("same_speakers"),
    "a10_best_same_text": _best("same_text"),
    "a10_configuration_table": configurations,
    "p10_tile_clips": clips,
    "a7_voice_seconds": voiced,
    "p11_sliding_windows": slides,
    "p5_drop_candidates": dropped,
    "p5_first_candidates": first_dropped,
    "t3_first_recordings": longest_recordings,
    "f12_redacted_text": redacted,
    "f12_error_details": error_details,
    "f13_leaked_tokens": leaks,
    "f14_t6_findings": findings,
    "st2_idle_windows": idle_windows,
    "st2_controller_windows": controller_windows,
    "src12_parsed_polls": parsed_polls,
    "src3_listed_files": listed_files,
    "src8_match_report": match_report,
}

DEMAND = """
counted AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1),
hours AS (SELECT unnest(generate_series((SELECT min(h) FROM counted), (SELECT max(h) FROM counted), INTERVAL 1 HOUR)) AS h),
demand AS (SELECT hours.h::TIMESTAMP::DATE AS fecha, hour(hours.h)::INT AS hora, (isodow(hours.h) - 1)::INT AS dia, coalesce(n, 0) AS escuchas
           FROM hours LEFT JOIN counted USING (h)),
schedule AS (SELECT *, ceil(escuchas / 3)::BIGINT AS machines FROM demand),
started AS (SELECT *, greatest(0, machines - lag(machines, 1, 0) OVER (ORDER BY fecha, hora)) AS starts FROM schedule)"""

OFFERS = """
offers AS (SELECT p_partkey AS id, p_brand AS gpu_name, CASE WHEN p_partkey % 97 <> 0 THEN p_retailprice END AS dph_total,
  list_position(['Brand#7', 'Brand#3', 'Brand#12', 'Brand#21'], p_brand) AS preference, p_size, p_partkey FROM part
  WHERE p_brand IN ('Brand#7', 'Brand#3', 'Brand#12', 'Brand#21') AND p_partkey NOT IN (11, 77))"""

RUNS = """
runs AS (SELECT *, l_suppkey % 5 AS n_spk, l_extendedprice / l_quantity AS rtf,
  row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS r FROM lineitem),
one AS (SELECT n_spk AS n1, -l_tax AS lp1 FROM runs WHERE r = 1)"""

THIRD = "list_reduce(embedding[{0}:len(embedding):3]::DOUBLE[], lambda a, b: a + b)"
SCORES = f"""
scores AS (SELECT vec_id AS audio, vec_id * 5.0::DOUBLE AS start, round({THIRD.format(1)} + 0.5, 4) AS p_speech,
  round({THIRD.format(2)} + 0.5, 4) AS p_music, round({THIRD.format(3)} + 0.5, 4) AS p_singing FROM embeddings),
low AS (SELECT * FROM scores WHERE p_speech < 0.2 AND (p_music > 0.85 OR p_singing > 0.7))"""

TOKENS_SQL = r"(?:sk-|AKIA|token|password)[A-Za-z0-9_-]*"
BODIES = {
    "plain": "props", "json": r"""CASE WHEN props IS NOT NULL THEN '"bad ***\nkey ***"' END""",
    "nested": "regexp_replace(props, '([:,]) +', '\\1', 'g')", "page": "'<p> *** ' || props || ' </p>'",
    "empty": "CASE WHEN props IS NOT NULL THEN 'no reason was given' END"}
DETAILS = " UNION ALL ".join(
    f"SELECT event_id, '{kind}' AS kind, {c.collapse_sql(sql)} AS detail FROM events" for kind, sql in BODIES.items())

CONTROLLER_SQL = """WITH p AS (
    SELECT user_id AS source, event_id AS seq, floor(epoch_us(ts) / 1000000)::BIGINT AS poll_ts,
      event_id % 9 = 0 AND user_id % 2 = 0 AND event_id % 11 <> 3 AS empty, event_id % 13 = 4 AS slow
    FROM events WHERE event_id % 100 <> 50),
  q AS (SELECT *, lag(poll_ts) OVER w AS t0, coalesce(lag(empty) OVER w, false) AS e0 FROM p WINDOW w AS (PARTITION BY source ORDER BY seq)),
  r AS (SELECT *, CASE WHEN empty AND NOT (e0 AND poll_ts - t0 <= 100000 AND poll_ts >= t0 AND NOT slow) THEN seq END AS st FROM q),
  g AS (SELECT *, max(st) OVER (PARTITION BY source ORDER BY seq) AS started FROM r)
  SELECT g.source, g.seq, g.poll_ts, g.empty, CASE WHEN g.empty THEN s.poll_ts END AS since,
    coalesce(g.empty AND g.poll_ts - s.poll_ts >= 86400, false) AS fires
  FROM g LEFT JOIN p s ON g.source = s.source AND g.started = s.seq"""

POLL_FILES_SQL = """SELECT CASE WHEN ok THEN user_id END AS source, CASE WHEN ok THEN event_id END AS seq,
    CASE WHEN ok THEN floor(epoch_us(ts) / 1000000)::BIGINT END AS poll_ts,
    CASE WHEN ok THEN CASE WHEN event_id % 11 = 3 THEN 'loading' ELSE 'running' END END AS machine_state,
    CASE WHEN ok THEN CASE WHEN event_id % 13 = 4 THEN 61.5 ELSE 0.5 END::DOUBLE END AS took_seconds, NOT ok AS is_broken
  FROM (SELECT *, event_id % 100 <> 50 AS ok FROM events)"""

ORACLES = {
    "st2_controller_windows": CONTROLLER_SQL,
    "c1_day_profile": f"""WITH {DEMAND} SELECT fecha::VARCHAR AS fecha, sum(escuchas)::BIGINT AS total, max(escuchas) AS peak,
        arg_max(hora, escuchas * 100 - hora) AS peak_hour, min(hora) FILTER (WHERE escuchas > 0) AS first_hour,
        max(hora) FILTER (WHERE escuchas > 0) AS last_hour FROM demand GROUP BY fecha""",
    "c1_weekday_profile": f"""WITH {DEMAND} SELECT dia, hora, round(avg(escuchas), 6) AS mean, max(escuchas) AS peak
        FROM demand GROUP BY 1, 2""",
    "c2_c4_schedule_starts": f"WITH {DEMAND} SELECT fecha::VARCHAR AS fecha, hora, escuchas, machines, starts FROM started",
    "c4_schedule_cost": f"""WITH {DEMAND} SELECT sum(machines)::BIGINT AS machine_hours, sum(starts)::BIGINT AS starts,
        round(0.21::DOUBLE * (sum(machines) + 0.25::DOUBLE * sum(starts)), 6) AS cost FROM started""",
    "c5_c3_backlog": f"""WITH RECURSIVE {DEMAND},
        n AS (SELECT *, row_number() OVER (ORDER BY fecha, hora) AS r FROM demand),
        b AS (SELECT 1::BIGINT AS r, greatest(0, escuchas - 14.0::DOUBLE) AS backlog FROM n WHERE r = 1
              UNION ALL SELECT n.r, greatest(0, b.backlog + escuchas - 14.0::DOUBLE) FROM b JOIN n ON n.r = b.r + 1)
        SELECT fecha::VARCHAR AS fecha, hora, round(backlog, 6) AS backlog, round(backlog / 14, 6) AS delay,
          ceil((escuchas + backlog / 2) / 3)::BIGINT AS machines FROM n JOIN b USING (r)""",
    "c6_schedule_ranges": f"""WITH {DEMAND}, i AS (SELECT *, hora - row_number() OVER
          (PARTITION BY fecha, machines ORDER BY hora) AS g FROM schedule)
        SELECT fecha::VARCHAR AS fecha, machines, min(hora) AS from_hour, max(hora) + 1 AS to_hour FROM i GROUP BY fecha, machines, g""",
    "p6_suitable_offers": f"""WITH {OFFERS} SELECT id, gpu_name, dph_total FROM offers WHERE p_size % 10 <> 0 AND p_size % 3 <> 0
        AND p_size / 50 >= 0.3 AND p_partkey % 900 >= 100 AND p_partkey % 200 >= 40 AND p_size NOT IN (3, 4, 5) AND dph_total <= 1500""",
    "t1_ranked_offers": f"""WITH {OFFERS} SELECT id, gpu_name, dph_total, preference FROM offers
        ORDER BY preference, coalesce(dph_total, 0), id LIMIT 5""",
    "a10_best_same_speakers": f"""WITH {RUNS} SELECT l_linenumber AS config, count(*) AS runs, round(max(rtf), 6) AS best_rtf
        FROM runs, one WHERE n_spk = n1 GROUP BY 1""",
    "a10_best_same_text": f"""WITH {RUNS} SELECT l_linenumber AS config, count(*) AS runs, round(max(rtf), 6) AS best_rtf
        FROM runs, one WHERE 1 - l_discount >= 0.97::DOUBLE AND -l_tax >= lp1 GROUP BY 1""",
    "a10_configuration_table": """SELECT l_linenumber AS config, count(*) AS runs, sum(l_partkey % 50)::BIGINT AS segments,
        sum(l_orderkey % 5000)::BIGINT AS chars, round(sum(-l_tax * (l_partkey % 50)) / nullif(sum(l_partkey % 50), 0), 6) AS mean_logprob,
        round(sum(l_extendedprice) / nullif(sum(l_quantity), 0), 6) AS rtf FROM lineitem GROUP BY 1""",
    "p10_tile_clips": """SELECT o_orderkey, k * 30.0::DOUBLE AS start, least(k * 30.0::DOUBLE + 30, d) AS "end"
        FROM (SELECT o_orderkey, d, unnest(range(ceil(d / 30)::BIGINT)) AS k FROM
              (SELECT o_orderkey, o_totalprice / 1000 AS d FROM orders WHERE o_totalprice > 0))""",
    "a7_voice_seconds": """SELECT l_orderkey, round(sum(l_quantity::BIGINT * 160)::BIGINT / 16000.0::DOUBLE, 6) AS voice_seconds
        FROM lineitem GROUP BY 1""",
    "p11_sliding_windows": """SELECT o_orderkey, k * 5.0::DOUBLE AS start, printf('%.2f', least(k * 5.0::DOUBLE + 10, d))::DOUBLE AS "end"
        FROM (SELECT o_orderkey, d, unnest(range(greatest(0, ceil((d - 10) / 5))::BIGINT + 1)) AS k FROM
              (SELECT o_orderkey, o_totalprice / 1000 AS d FROM orders WHERE o_totalprice > 0))""",
    "p5_drop_candidates": f"WITH {SCORES} SELECT * FROM low",
    "p5_first_candidates": f"WITH {SCORES} SELECT * FROM low ORDER BY audio, start LIMIT 30",
    "t3_first_recordings": "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 1000",
    "f12_redacted_text": f"SELECT doc_id, regexp_replace(text, '{TOKENS_SQL}', '***', 'g') AS text FROM documents",
    "f12_error_details": DETAILS,
    "f13_leaked_tokens": f"SELECT doc_id FROM documents WHERE regexp_matches(text, '{TOKENS_SQL}')",
    "f14_t6_findings": rf"""WITH l AS (SELECT regexp_replace(split_part(split_part(url, '?', 1), '#', 1), '^[a-z]+://', '') AS path FROM pages),
        s AS (SELECT string_split(path, '/') AS a FROM l),
        f AS (SELECT a, unnest(range(1, len(a))) AS k FROM s)
        SELECT 'missing' AS finding, p AS path FROM (SELECT unnest(['docs/en/1', 'missing.txt', 'README']) AS p) WHERE p NOT IN (SELECT path FROM l)
        UNION ALL SELECT 'forbidden file', path FROM l WHERE regexp_matches(path, '[^/](\.html|\.php)/*$')
        UNION ALL SELECT DISTINCT 'forbidden folder', array_to_string(a[1:k], '/') FROM f WHERE a[k] IN ('fr', 'de')
        UNION ALL SELECT 'possible token', doc_id::VARCHAR FROM documents WHERE regexp_matches(text, '{TOKENS_SQL}')""",
    "st2_idle_windows": """WITH p AS (SELECT user_id AS source, event_id AS seq, floor(epoch_us(ts) / 1000000)::BIGINT AS poll_ts, event_type <> 'purchase' AS empty FROM events),
        q AS (SELECT *, lag(poll_ts) OVER w AS t0, coalesce(lag(empty) OVER w, false) AS e0 FROM p WINDOW w AS (PARTITION BY source ORDER BY seq)),
        r AS (SELECT *, CASE WHEN empty AND NOT (e0 AND poll_ts - t0 <= 100000 AND poll_ts >= t0) THEN seq END AS st FROM q),
        g AS (SELECT *, max(st) OVER (PARTITION BY source ORDER BY seq) AS started FROM r)
        SELECT g.source, g.seq, g.poll_ts, g.empty, CASE WHEN g.empty THEN s.poll_ts END AS since,
          coalesce(g.empty AND g.poll_ts - s.poll_ts >= 86400, false) AS fires
        FROM g LEFT JOIN p s ON g.source = s.source AND g.started = s.seq""",
    "src12_parsed_polls": """SELECT event_id, event_id % 9 IN (0, 6) AS valid,
        event_id % 9 = 0 AND user_id % 2 = 0 AS empty FROM events""",
    "src3_listed_files": f"""SELECT doc_id, (pos - 1)::INT AS pos, v AS value FROM (
        SELECT doc_id, pos, regexp_replace(l[pos], '^{c.SPACE_SQL}+|{c.SPACE_SQL}+$', '', 'g') AS v FROM
          (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)))
        WHERE v <> '' AND NOT starts_with(v, '#')""",
    "src8_match_report": """SELECT 'f' || l_orderkey AS file_a, l_partkey / 2 AS a_start_s, l_partkey / 2 + 7 AS a_end_s,
        'g' || l_suppkey AS file_b, l_quantity AS b_start_s, l_quantity + 7 AS b_end_s, l_partkey AS n_hashes
        FROM lineitem WHERE l_linenumber <> 1""",
}
