"""Audits and progress over conversations (as transcripts) and events (as a progress log)."""

from __future__ import annotations

from pyspark.sql import functions as F

from speechlake.operators import progress as pg
from speechlake.operators import speaker_audit as sa
from speechlake.operators import transcript_audit as ta
from speechlake.operators.checkpoints import settle
from speechlake.operators.turns import build_turns
from speechlake.plans import corpus as c
from speechlake.plans.corpus import table
from speechlake.sinks import files as sink


def _talks(spark, sf):
    return table(spark, sf, "conversations").select(F.col("conv_id").alias("audio_key")).distinct()


def audios(spark, sf):
    return _talks(spark, sf)


def _filed(key):
    """Every recording has a document, but every eleventh is filed under a key that no recording has."""
    return F.when(key % 11 == 0, -key).otherwise(key)


def documents(spark, sf):
    return _talks(spark, sf).select(_filed(F.col("audio_key")).alias("audio_key"))


def listing(spark, sf):
    kinds = F.array_compact(F.array(
        F.when(F.col("audio_key") % 11 != 0, ".json"),
        F.when(F.col("audio_key") % 7 != 0, ".txt"), F.when(F.col("audio_key") % 9 != 0, ".srt"),
        F.when(F.col("audio_key") % 4 != 0, ".speakers.json"),
        F.when(F.col("audio_key") % 5 != 0, ".diarization.json")))
    return _talks(spark, sf).select("audio_key", F.explode(kinds).alias("suffix"))


def heads(spark, sf):
    size = F.size(c._tokens("text"))
    k = F.col("audio_key")
    per = c.spread(table(spark, sf, "conversations")).groupBy(F.col("conv_id").alias("audio_key")).agg(
        (F.max("turn") * 20 + 15).cast("double").alias("length"), (F.sum(size) * 0.25).alias("voice"))
    ok = k % 17 != 0
    return per.select(
        _filed(k).alias("audio_key"), ok.alias("parse_ok"),
        F.when(ok & (k % 29 != 0), F.col("length")).alias("duration"),
        F.when(ok, F.col("voice")).alias("duration_after_vad"),
        F.when(ok & (k % 5 != 0), F.when(k % 2 == 0, "en").otherwise("fr")).alias("language"),
        F.when(ok, F.lit(0.5)).alias("language_probability"),
    )


def segments(spark, sf):
    return c.talk_segments(spark, sf)


def words(spark, sf):
    return c.talk_segment_words(spark, sf)


def audit_rows(spark, sf, exact=False):
    return ta.audit(audios(spark, sf), heads(spark, sf), segments(spark, sf), words(spark, sf),
                    listing(spark, sf), exact)


ROUNDED = ("speech_coverage", "mean_word_probability", "median_word_probability",
           "low_confidence_rate", "max_segment_overlap_seconds")


def transcript_audit(spark, sf):
    rows = audit_rows(spark, sf)
    for name in ROUNDED:
        rows = rows.withColumn(name, F.round(name, 6))
    return rows.drop("scored").withColumn("flags", F.array_join("flags", ";"))


def summary(spark, sf):
    rows = settle(audit_rows(spark, sf))
    one = ta.corpus_summary(rows, words(spark, sf), documents(spark, sf), listing(spark, sf))
    listed = lambda name: F.array_join(F.transform(
        F.array_sort(F.map_entries(name)),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    one = one.withColumn("languages", listed("languages")).withColumn("flag_counts", listed("flag_counts"))
    doubles = [n for n, t in one.dtypes if t == "double"]
    return one.select(*[F.round(n, 6).alias(n) if n in doubles else n for n in one.columns])


def report(spark, sf):
    """Totals and the lines of the flagged recordings."""
    rows = settle(audit_rows(spark, sf, exact=True))
    return sink.audit_report(rows, ta.corpus_summary(rows, words(spark, sf), documents(spark, sf), listing(spark, sf))).withColumn(
        "rank", _six("rank"))


def candidates(spark, sf):
    return ta.candidates(audit_rows(spark, sf))


def flagged(spark, sf):
    return ta.flagged_report(audit_rows(spark, sf)).select(
        "audio_key", "segments", "words", F.array_join("flags", ", ").alias("flags"))


def reconciled(spark, sf):
    return ta.reconcile(audios(spark, sf), documents(spark, sf))


def existing(spark, sf):
    return ta.existing_kinds(audios(spark, sf), listing(spark, sf), (".txt", ".srt"))


def key_differences(spark, sf):
    return pg.key_differences(audios(spark, sf), documents(spark, sf), ["audio_key"])


def overlaps(spark, sf):
    return ta.segment_overlaps(segments(spark, sf)).withColumn(
        "max_segment_overlap_seconds", F.round("max_segment_overlap_seconds", 6))


def word_statistics(spark, sf):
    s = ta.word_statistics(words(spark, sf))
    return s.select("audio_key", "words", "low_confidence_words", "very_low_confidence_words",
                    *[F.round(n, 6).alias(n) for n in (
                        "mean_word_probability", "median_word_probability", "low_confidence_rate")])


def price_percentiles(spark, sf):
    """Nearest-rank percentiles of the order value per priority."""
    q = {f"p{int(100 * x)}": ta.nearest_rank(x) for x in (0.1, 0.5, 0.95)}
    return ta.order_statistics(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice", q, 1000.0)


def _speaker_rows(spark, sf):
    """Word gaps of 60 s and more make fragments; some units lose their speaker."""
    aligned = settle(c.talk_aligned(spark, sf))
    units = aligned.withColumn("speaker", F.when(
        (F.col("audio_key") % 8 == 3) & (F.col("seq") % 20 == 0), F.lit(" ")).otherwise(F.col("speaker")))
    turns = c.in_seconds(build_turns(aligned, max_gap=60))
    intervals = c.in_seconds(c.talk_intervals(spark, sf))
    per = intervals.groupBy("audio_key").agg(
        F.count_distinct("speaker").alias("n"), (F.max("pos") * 60 + 20).cast("double").alias("length"))
    k = F.col("audio_key")
    diarizations = per.select(
        "audio_key", F.when(k % 10 == 0, 0).when(k % 15 == 1, 13).otherwise(F.col("n")).alias("num_speakers"),
        F.when(k % 12 != 0, F.col("length")).alias("duration_seconds"),
        (k * 0.35).alias("processing_seconds"))
    transcripts = heads(spark, sf).select("audio_key", (k % 6).alias("segments"),
                                          F.when(k % 18 != 0, F.col("duration_after_vad")).alias("duration_after_vad"))
    return sa.audit_speakers(diarizations, intervals, units, turns, transcripts)


def _six(name):
    """Six decimals, ties upwards, after twelve, so that a tie in decimals is one in both engines."""
    return F.round(F.col(name).cast("decimal(18,12)"), 6).cast("double")


def speaker_audit(spark, sf):
    rows = _speaker_rows(spark, sf)
    return rows.select(
        "audio_key", "num_speakers", "words", "unassigned_words", "unknown_words", "turns",
        *[_six(n).alias(n) for n in ("coverage", "short_turn_rate")],
        "fragmented", "has_speech", F.array_join("warnings", ",").alias("warnings"),
        F.array_join("notes", ",").alias("notes"))


def speaker_summary(spark, sf):
    return sa.speaker_summary(_speaker_rows(spark, sf), audios(spark, sf), latest(spark, sf))


def log(spark, sf):
    status = F.when(F.col("event_type") == "error", "error").otherwise("ok")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("audio_key"), F.col("event_id").alias("seq"), status.alias("status"),
        F.col("value").alias("seconds"))


def latest(spark, sf):
    return pg.latest_per_audio(log(spark, sf))


def status_counts(spark, sf):
    return pg.status_counts(latest(spark, sf))


def last_rows(spark, sf):
    return pg.last_rows(latest(spark, sf))


def outcome_counts(spark, sf):
    return pg.outcome_counts(log(spark, sf))


def pending_work(spark, sf):
    talks, files = _talks(spark, sf), listing(spark, sf)
    kinds = [
        pg.pending(talks, files, "transcription", latest(spark, sf)).withColumn("work", F.lit("transcription")),
        pg.pending(talks, files, "pair").withColumn("work", F.lit("pair")),
        pg.pending(talks, files, "diarization").withColumn("work", F.lit("diarization")),
        pg.pending(talks, files, "diarization_light").withColumn("work", F.lit("diarization_light")),
    ]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).unionByName(kinds[3])


def result_index(spark, sf):
    return pg.result_index(audios(spark, sf), listing(spark, sf))


def index_header(spark, sf):
    return pg.index_header(result_index(spark, sf))


def collisions(spark, sf):
    """Pages whose URL path ends in the same name."""
    name = F.regexp_replace(F.substring_index("url", "?", 1), r"\.[^./]+$", "")
    return pg.output_collisions(
        table(spark, sf, "pages").select("page_id", F.regexp_extract(name, "[^/]*$", 0).alias("key")), "key", "page_id")


QUERIES = {
    "q1_q2_snk9_transcript_audit": transcript_audit,
    "snk9_report": report,
    "q3_a6_corpus_summary": summary,
    "q4_candidates": candidates,
    "q5_flagged_report": flagged,
    "j7_reconcile": reconciled,
    "j8_existing_kinds": existing,
    "t4_key_differences": key_differences,
    "w5_segment_overlaps": overlaps,
    "a5_word_statistics": word_statistics,
    "a6_nearest_rank": price_percentiles,
    "q6_q7_q8_j10_speaker_audit": speaker_audit,
    "q9_speaker_summary": speaker_summary,
    "p9_latest_per_audio": latest,
    "q10_status_counts": status_counts,
    "q10_last_rows": last_rows,
    "a9_outcome_counts": outcome_counts,
    "p7_pending": pending_work,
    "p8_snk7_result_index": result_index,
    "snk7_index_header": index_header,
    "p3_output_collisions": collisions,
}

LISTS = f"""
talks AS (SELECT DISTINCT conv_id AS audio_key FROM conversations),
audios AS (SELECT * FROM talks),
documents AS (SELECT CASE WHEN audio_key % 11 = 0 THEN -audio_key ELSE audio_key END AS audio_key FROM talks),
listing AS (
  SELECT audio_key, '.json' AS suffix FROM talks WHERE audio_key % 11 <> 0
  UNION ALL SELECT audio_key, '.txt' FROM talks WHERE audio_key % 7 <> 0
  UNION ALL SELECT audio_key, '.srt' FROM talks WHERE audio_key % 9 <> 0
  UNION ALL SELECT audio_key, '.speakers.json' FROM talks WHERE audio_key % 4 <> 0
  UNION ALL SELECT audio_key, '.diarization.json' FROM talks WHERE audio_key % 5 <> 0),
heads AS (
  SELECT CASE WHEN conv_id % 11 = 0 THEN -conv_id ELSE conv_id END AS audio_key, conv_id % 17 <> 0 AS parse_ok,
    CASE WHEN conv_id % 17 <> 0 AND conv_id % 29 <> 0 THEN (max(turn) * 20 + 15)::DOUBLE END AS duration,
    CASE WHEN conv_id % 17 <> 0 THEN sum(len({c.TOKENS})) * 0.25::DOUBLE END AS duration_after_vad,
    CASE WHEN conv_id % 17 <> 0 AND conv_id % 5 <> 0 THEN CASE WHEN conv_id % 2 = 0 THEN 'en' ELSE 'fr' END END AS language
  FROM conversations GROUP BY conv_id)"""

AUDIT = f"""{c.UNITS_SQL}, {c.SEGMENTS_SQL}, {LISTS},
rsegs AS (SELECT *, s_ms / 1000.0::DOUBLE AS s, e_ms / 1000.0::DOUBLE AS e FROM segs),
rwords AS (SELECT u.audio_key, probability, us / 1000.0::DOUBLE AS us, ue / 1000.0::DOUBLE AS ue, s, e
           FROM units u JOIN rsegs g ON u.audio_key = g.audio_key AND u.turn = g.segment_pos),
seg AS (SELECT g.audio_key, count(*) AS segments, bool_or(has_words) AS has_words,
    count(*) FILTER (WHERE s < 0 OR e < s OR e > coalesce(duration, 0) + 1) AS invalid_segment_times
  FROM rsegs g JOIN heads h ON g.audio_key = h.audio_key GROUP BY 1),
ovl AS (SELECT audio_key, count(*) FILTER (WHERE o > 1e-3) AS segment_overlaps,
    coalesce(max(o) FILTER (WHERE o > 1e-3), 0) AS max_overlap
  FROM (SELECT audio_key, greatest(coalesce(max(e) OVER (PARTITION BY audio_key ORDER BY segment_pos
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) - s AS o FROM rsegs) GROUP BY 1),
wst AS (SELECT audio_key, count(*) AS words, avg(probability) AS mean, median(probability) AS med,
    count(*) FILTER (WHERE probability < 0.5) AS low, count(*) FILTER (WHERE probability < 0.3) AS vlow,
    count(*) FILTER (WHERE us < s - 1 OR ue < us OR ue > e + 1) AS invalid_word_times FROM rwords GROUP BY 1),
base AS (
  SELECT a.audio_key, h.audio_key IS NOT NULL AS json_exists,
    coalesce(t.audio_key IS NOT NULL, false) AS txt_exists, r.audio_key IS NOT NULL AS srt_exists,
    coalesce(h.ok, false) AS ok, coalesce(duration, 0) AS d, coalesce(duration_after_vad, 0) AS v, language,
    CASE WHEN h.ok THEN coalesce(segments, 0) ELSE 0 END AS segments, CASE WHEN h.ok THEN coalesce(words, 0) ELSE 0 END AS words,
    coalesce(seg.has_words, false) AS has_words, CASE WHEN h.ok THEN mean END AS mean, CASE WHEN h.ok THEN med END AS med,
    CASE WHEN h.ok THEN coalesce(low, 0) ELSE 0 END AS low, CASE WHEN h.ok THEN coalesce(vlow, 0) ELSE 0 END AS vlow,
    CASE WHEN h.ok THEN low / nullif(wst.words, 0) END AS rate,
    CASE WHEN h.ok THEN coalesce(segment_overlaps, 0) ELSE 0 END AS segment_overlaps,
    CASE WHEN h.ok THEN coalesce(max_overlap, 0) ELSE 0 END AS max_overlap,
    CASE WHEN h.ok THEN coalesce(invalid_segment_times, 0) ELSE 0 END AS invalid_segment_times,
    CASE WHEN h.ok THEN coalesce(invalid_word_times, 0) ELSE 0 END AS invalid_word_times
  FROM audios a LEFT JOIN (SELECT *, parse_ok AS ok FROM heads) h USING (audio_key) LEFT JOIN seg USING (audio_key)
  LEFT JOIN ovl USING (audio_key) LEFT JOIN wst USING (audio_key)
  LEFT JOIN (SELECT audio_key FROM listing WHERE suffix = '.txt') t USING (audio_key)
  LEFT JOIN (SELECT audio_key FROM listing WHERE suffix = '.srt') r USING (audio_key)),
audit AS MATERIALIZED (SELECT *, list_filter([
    CASE WHEN NOT json_exists THEN 'missing_json' END,
    CASE WHEN json_exists AND NOT ok THEN 'json_parse_error' END,
    CASE WHEN ok AND NOT txt_exists THEN 'missing_txt' END,
    CASE WHEN ok AND NOT srt_exists THEN 'missing_srt' END,
    CASE WHEN ok AND segments = 0 THEN 'empty_transcript' END,
    CASE WHEN ok AND segments > 0 AND words BETWEEN 1 AND 49 THEN 'near_empty_transcript' END,
    CASE WHEN ok AND segments > 0 AND NOT has_words THEN 'missing_word_timestamps' END,
    CASE WHEN ok AND rate > 0.05 THEN 'high_low_confidence_rate' END,
    CASE WHEN ok AND invalid_segment_times > 0 THEN 'invalid_segment_times' END,
    CASE WHEN ok AND invalid_word_times > 0 THEN 'invalid_word_times' END], lambda x: x IS NOT NULL) AS flags FROM base)"""

SPEAKERS = f"""{c.ALIGNED_SQL}, {LISTS},
units2 AS (SELECT * REPLACE (CASE WHEN audio_key % 8 = 3 AND seq % 20 = 0 THEN ' ' ELSE speaker END AS speaker)
           FROM aligned),
runs AS (SELECT *, sum(chg) OVER (PARTITION BY audio_key ORDER BY seq) AS run
  FROM (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY audio_key ORDER BY seq)
                       THEN 0 ELSE 1 END AS chg FROM aligned)),
reach AS (SELECT *, max(ue) OVER (PARTITION BY audio_key, run ORDER BY seq
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM runs),
marked AS (SELECT *, sum(CASE WHEN far IS NULL OR us - far > 60 THEN 1 ELSE 0 END)
            OVER (PARTITION BY audio_key ORDER BY seq) AS turn_no FROM reach),
turns2 AS (SELECT audio_key, turn_no, speaker, max(ue) - arg_min(us, seq) AS len
           FROM marked GROUP BY ALL),
dia AS (SELECT audio_key, CASE WHEN audio_key % 10 = 0 THEN 0 WHEN audio_key % 15 = 1 THEN 13
      ELSE count(DISTINCT speaker) END AS num_speakers,
    CASE WHEN audio_key % 12 <> 0 THEN (max(pos) * 60 + 20)::DOUBLE END AS length,
    sum(e - s) / 1000.0::DOUBLE AS speech, audio_key * 0.35::DOUBLE AS processing FROM intervals GROUP BY 1),
said AS (SELECT audio_key, count(*) AS words, count(*) FILTER (WHERE trim(speaker) = '') AS un,
    count(*) FILTER (WHERE speaker = 'UNKNOWN') AS unknown FROM units2 GROUP BY 1),
spoken AS (SELECT audio_key, count(*) AS turns, count(*) FILTER (WHERE len < 750) AS short FROM turns2 GROUP BY 1),
scraps AS (SELECT audio_key, speaker FROM turns2 WHERE speaker <> 'UNKNOWN' GROUP BY 1, 2
    HAVING count(*) >= 10 AND sum(len) < 30000 AND sum(len) < 1000 * count(*)),
frag AS (SELECT audio_key, string_agg(speaker, '+' ORDER BY speaker) AS fragmented FROM scraps GROUP BY 1),
heard AS (SELECT audio_key, audio_key % 6 > 0 OR coalesce(CASE WHEN audio_key % 18 <> 0 THEN duration_after_vad END, 0) > 0
    AS has_speech FROM heads),
merged AS (SELECT d.*, coalesce(words, 0) AS w, coalesce(un, 0) AS un2, coalesce(unknown, 0) AS unk, coalesce(turns, 0) AS t,
    CASE WHEN length > 0 THEN speech / length ELSE 0 END AS cov, coalesce(short / nullif(turns, 0), 0) AS sr, fragmented, has_speech
  FROM dia d LEFT JOIN said USING (audio_key) LEFT JOIN spoken USING (audio_key)
  LEFT JOIN frag USING (audio_key) LEFT JOIN heard USING (audio_key)),
rows2 AS (SELECT audio_key, num_speakers, w AS words, un2 AS unassigned_words, unk AS unknown_words, t AS turns,
    round(cov::DECIMAL(18, 12), 6)::DOUBLE AS coverage, round(sr::DECIMAL(18, 12), 6)::DOUBLE AS short_turn_rate, fragmented, has_speech, processing,
    concat_ws(',', CASE WHEN num_speakers < 1 THEN 'sin_hablantes' END,
      CASE WHEN num_speakers > 12 THEN 'demasiados_hablantes' END,
      CASE WHEN w = 0 AND coalesce(has_speech, true) THEN 'sin_texto_alineado' END,
      CASE WHEN w > 0 AND un2 / w > 0.01 THEN 'texto_sin_hablante' END,
      CASE WHEN cov < 0.15 THEN 'muy_poca_voz' END,
      CASE WHEN fragmented IS NOT NULL THEN 'speaker_fragmentado:' || fragmented END) AS warnings,
    CASE WHEN w = 0 AND NOT has_speech THEN 'sin_voz_segun_whisper' ELSE '' END AS notes FROM merged)"""

LOG = """
log AS (SELECT user_id AS audio_key, event_id AS seq,
        CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, value AS seconds FROM events),
latest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY audio_key ORDER BY seq DESC) = 1)"""

INDEX = """SELECT audio_key, 'transcripciones/' || audio_key || '.json' AS transcription_json,
  'diarizaciones/' || audio_key || '.speakers.json' AS diarized_transcription_json,
  'diarizaciones/' || audio_key || '.speakers.txt' AS diarized_transcription_txt,
  'diarizaciones/' || audio_key || '.speakers.srt' AS diarized_subtitles_srt,
  'local_to_audio_file' AS speaker_scope,
  audio_key % 11 <> 0 AND audio_key % 4 <> 0 AS complete FROM audios"""


def _report_head():
    """The head lines as SQL expressions over the totals."""
    share = lambda c: f"printf('%.2f%%', {c} * 100)"
    fields = {"total_scored_words": "scored", "mean_word_probability": share("mean_p"), "words_below_0_5_rate": share("low_p"),
              "words_below_0_3_rate": share("very_low_p"), "max_segment_overlap_seconds": "printf('%.2f', longest)"}

    class Named(dict):
        def __missing__(self, name):
            return f"' || {fields.get(name, name)} || '"

    return ", ".join("'" + line % Named() + "'" for line in sink.REPORT_HEAD)


def _mean(p):
    """The mean over billionths, which add up the same in any order."""
    return f"sum(round({p} * 1e9::DOUBLE)::BIGINT)::BIGINT::DOUBLE / 1e9::DOUBLE / count({p})"


def _pending(work, suffixes, also="true"):
    listed = ", ".join(f"'{s}'" for s in suffixes)
    return (f"SELECT audio_key, '{work}' AS work FROM talks WHERE NOT (({also}) AND audio_key IN "
            f"(SELECT audio_key FROM listing WHERE suffix IN ({listed}) GROUP BY 1 HAVING count(*) = {len(suffixes)}))")


ORACLES = {
    "q1_q2_snk9_transcript_audit": f"""WITH {AUDIT} SELECT audio_key, json_exists, txt_exists, srt_exists,
        ok AS json_parse_ok, CASE WHEN ok THEN d END AS duration_seconds, CASE WHEN ok THEN v END AS vad_seconds,
        CASE WHEN ok THEN round(v / nullif(d, 0), 6) END AS speech_coverage, language,
        CASE WHEN ok THEN 0.5::DOUBLE END AS language_probability, segments, words,
        ok AND has_words AND words > 0 AS word_timestamps, round(mean, 6) AS mean_word_probability,
        round(med, 6) AS median_word_probability, low AS low_confidence_words, round(rate, 6) AS low_confidence_rate,
        vlow AS very_low_confidence_words, segment_overlaps, round(max_overlap, 6) AS max_segment_overlap_seconds,
        invalid_segment_times, invalid_word_times, array_to_string(flags, ';') AS flags FROM audit""",
    "q3_a6_corpus_summary": f"""WITH {AUDIT},
        sw AS MATERIALIZED (SELECT probability AS p FROM rwords JOIN audit USING (audio_key) WHERE ok),
        counts AS (SELECT count(*) AS audio_files, count(*) FILTER (WHERE NOT json_exists) AS audio_without_json,
          count(*) FILTER (WHERE json_exists AND NOT ok) AS parse_errors, count(*) FILTER (WHERE words > 0) AS files_with_scored_words,
          count(*) FILTER (WHERE segment_overlaps > 0) AS files_with_segment_overlaps,
          sum(segment_overlaps)::BIGINT AS segment_overlap_events, round(max(max_overlap), 6) AS max_segment_overlap_seconds FROM audit),
        probs AS (SELECT count(*) AS total_scored_words, round(avg(p), 6) AS mean_word_probability,
          round(median(p), 6) AS median_word_probability,
          round(count(*) FILTER (WHERE p < 0.5) / count(*), 6) AS words_below_0_5_rate,
          round(count(*) FILTER (WHERE p < 0.3) / count(*), 6) AS words_below_0_3_rate,
          round(count(*) FILTER (WHERE p >= 0.8) / count(*), 6) AS words_at_least_0_8_rate FROM sw),
        tenth AS (SELECT p AS p10_word_probability FROM (SELECT p, row_number() OVER (ORDER BY p) AS r, count(*) OVER () AS n FROM sw)
          WHERE r = round_even((n - 1) * 0.10::DOUBLE, 0)::BIGINT + 1)
        SELECT *, (SELECT count(*) FROM documents WHERE audio_key NOT IN (SELECT audio_key FROM audios)) AS json_without_audio,
          (SELECT count(*) FROM documents) AS json_files,
          (SELECT count(*) FROM listing WHERE suffix = '.txt') AS txt_files,
          (SELECT count(*) FROM listing WHERE suffix = '.srt') AS srt_files,
          (SELECT string_agg(l || '=' || n, ';' ORDER BY l) FROM (SELECT coalesce(language, 'None') AS l, count(*) AS n FROM audit WHERE ok GROUP BY 1)) AS languages,
          (SELECT string_agg(f || '=' || n, ';' ORDER BY f) FROM (SELECT f, count(*) AS n FROM (SELECT unnest(flags) AS f FROM audit) GROUP BY 1)) AS flag_counts
        FROM counts, probs, tenth""",
    "snk9_report": f"""WITH {AUDIT.replace("avg(probability) AS mean", _mean("probability") + " AS mean")},
        sw AS MATERIALIZED (SELECT probability AS p FROM rwords JOIN audit USING (audio_key) WHERE ok),
        one AS (SELECT count(*) AS audio_files, count(*) FILTER (WHERE segment_overlaps > 0) AS files_with_segment_overlaps,
          sum(segment_overlaps)::BIGINT AS segment_overlap_events, max(max_overlap) AS longest,
          (SELECT count(*) FROM documents) AS json_files, (SELECT count(*) FROM sw) AS scored, (SELECT coalesce({_mean('p')}, 0) FROM sw) AS mean_p,
          (SELECT coalesce(count(*) FILTER (WHERE p < 0.5) / nullif(count(*), 0), 0) FROM sw) AS low_p,
          (SELECT coalesce(count(*) FILTER (WHERE p < 0.3) / nullif(count(*), 0), 0) FROM sw) AS very_low_p,
          (SELECT count(*) FROM listing WHERE suffix = '.txt') AS txt_files,
          (SELECT count(*) FROM listing WHERE suffix = '.srt') AS srt_files FROM audit),
        head AS (SELECT unnest([{_report_head()}]) AS value, unnest(range({len(sink.REPORT_HEAD)})) AS k FROM one)
        SELECT 0 AS part, k::DOUBLE AS rank, NULL::VARCHAR AS audio_key, value FROM head
        UNION ALL SELECT 1, round(coalesce(mean, -1)::DECIMAL(18, 12), 6)::DOUBLE, audio_key::VARCHAR, '| ' || audio_key || ' | ' || segments || ' | ' || words
          || ' | ' || coalesce(printf('%.1f%%', mean * 100), '—') || ' | ' || array_to_string(flags, ', ') || ' |'
        FROM audit WHERE len(flags) > 0""",
    "q4_candidates": f"""WITH {AUDIT} SELECT 'empty' AS list, audio_key FROM audit
          WHERE list_has_any(flags, ['empty_transcript', 'near_empty_transcript'])
        UNION ALL SELECT 'no_word_times', audio_key FROM audit WHERE list_contains(flags, 'missing_word_timestamps')
        UNION ALL SELECT 'low_confidence', audio_key FROM audit WHERE list_contains(flags, 'high_low_confidence_rate')
        UNION ALL SELECT 'reprocess', audio_key FROM audit
          WHERE list_has_any(flags, ['missing_word_timestamps', 'high_low_confidence_rate'])""",
    "q5_flagged_report": f"""WITH {AUDIT} SELECT audio_key, segments, words, array_to_string(flags, ', ') AS flags
        FROM audit WHERE len(flags) > 0""",
    "j7_reconcile": f"""WITH {LISTS} SELECT audio_key, CASE WHEN d.k IS NULL THEN 'no_document' WHEN a.k IS NULL
        THEN 'no_audio' ELSE 'both' END AS state FROM (SELECT audio_key, 1 AS k FROM audios) a
        FULL JOIN (SELECT audio_key, 1 AS k FROM documents) d USING (audio_key)""",
    "j8_existing_kinds": f"""WITH {LISTS} SELECT audio_key, audio_key % 7 <> 0 AS txt, audio_key % 9 <> 0 AS srt FROM audios""",
    "t4_key_differences": f"""WITH {LISTS} SELECT audio_key, 'left' AS side FROM (SELECT * FROM audios EXCEPT SELECT * FROM documents)
        UNION ALL SELECT audio_key, 'right' FROM (SELECT * FROM documents EXCEPT SELECT * FROM audios)""",
    "w5_segment_overlaps": f"""WITH {AUDIT} SELECT audio_key, segment_overlaps,
        round(max_overlap, 6) AS max_segment_overlap_seconds FROM ovl""",
    "a5_word_statistics": f"""WITH {AUDIT} SELECT audio_key, words, low AS low_confidence_words, vlow AS very_low_confidence_words,
        round(mean, 6) AS mean_word_probability, round(med, 6) AS median_word_probability,
        round(low / words, 6) AS low_confidence_rate FROM wst""",
    "a6_nearest_rank": """SELECT o_orderpriority, max(p) FILTER (WHERE r = round_even((n - 1) * 0.1::DOUBLE, 0) + 1) AS p10,
          max(p) FILTER (WHERE r = round_even((n - 1) * 0.5::DOUBLE, 0) + 1) AS p50,
          max(p) FILTER (WHERE r = round_even((n - 1) * 0.95::DOUBLE, 0) + 1) AS p95
        FROM (SELECT o_orderpriority, o_totalprice AS p, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS r,
              count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) GROUP BY 1""",
    "q6_q7_q8_j10_speaker_audit": f"WITH {SPEAKERS} SELECT * EXCLUDE (processing) FROM rows2",
    "q9_speaker_summary": f"""WITH {SPEAKERS}, {LOG}
        SELECT (SELECT count(*) FROM audios) AS audios, count(*) AS finished,
          count(*) FILTER (WHERE warnings <> '') AS quality_warnings,
          (SELECT (k // n + CASE WHEN 2 * (k % n) > n OR (2 * (k % n) = n AND (k // n) % 2 = 1) THEN 1 ELSE 0 END) / 10.0::DOUBLE
           FROM (SELECT sum(round(printf('%.1f', processing)::DOUBLE * 10)::BIGINT)::BIGINT AS k, count(*) AS n FROM rows2))
            AS mean_seconds_per_file,
          (SELECT count(*) FROM latest WHERE status = 'error') AS current_errors,
          greatest(0, (SELECT count(*) FROM audios) - count(*)) AS pending FROM rows2""",
    "p9_latest_per_audio": f"WITH {LOG} SELECT * FROM latest",
    "q10_status_counts": f"WITH {LOG} SELECT status, count(*) AS n FROM latest GROUP BY 1",
    "q10_last_rows": f"WITH {LOG} SELECT * FROM latest ORDER BY seq DESC LIMIT 3",
    "a9_outcome_counts": f"""WITH {LOG} SELECT count(*) FILTER (WHERE status = 'ok') AS successes,
        count(*) FILTER (WHERE status = 'error') AS errors FROM log""",
    "p7_pending": f"WITH {LISTS}, {LOG} " + " UNION ALL ".join([
        _pending("transcription", [".json"], "audio_key IN (SELECT audio_key FROM latest WHERE status = 'ok')"),
        _pending("pair", pg.REQUIRED["pair"]), _pending("diarization", pg.REQUIRED["diarization"]),
        _pending("diarization_light", pg.REQUIRED["diarization_light"])]),
    "p8_snk7_result_index": f"WITH {LISTS} {INDEX}",
    "snk7_index_header": f"""WITH {LISTS} SELECT count(*) AS audio_count,
        count(*) FILTER (WHERE complete) AS complete_count FROM ({INDEX})""",
    "p3_output_collisions": r"""WITH p AS (SELECT page_id, regexp_extract(regexp_replace(split_part(url, '?', 1), '\.[^./]+$', ''),
        '[^/]*$', 0) AS key FROM pages) SELECT key, page_id, count(*) OVER (PARTITION BY key) AS files FROM p QUALIFY files > 1""",
}
