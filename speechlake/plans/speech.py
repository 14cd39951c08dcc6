"""Words, turns, subtitles and result documents from conversations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from speechlake.functions import text as fx
from speechlake.functions.acoustics import frames_to_seconds, pack_landmark
from speechlake.operators import jobs as jb
from speechlake.operators import payload
from speechlake.operators.checkpoints import checkpoint_dir, settle
from speechlake.operators.naming import name_turns
from speechlake.operators.turns import build_turns
from speechlake.operators.units import order_key
from speechlake.plans import corpus as c
from speechlake.plans.corpus import table
from speechlake.sinks import render
from speechlake.sinks.documents import assemble, items, json_value, piece

SPEECH_MODEL = "models/large-v3"
SPEAKER_MODEL = "hub/speaker-community-1"


def _named(df, *names):
    return df.select("audio_key", *names)


def timestamps(spark, sf):
    sec = F.col("o_totalprice") - F.lit(200_000)
    return table(spark, sf, "orders").select(
        "o_orderkey", fx.srt_ts(sec).alias("srt"), fx.trunc_ts(sec).alias("cut"),
        fx.dot_ts(sec).alias("dotted"), fx.hhmmss(sec).alias("whole"),
    )


def collapsed_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fx.collapse_ws(F.col("text")).alias("text"))


def word_scores(spark, sf):
    return _named(c.talk_units(spark, sf), "seq",
                  F.round(fx.word_logprob(F.col("probability")), 6).alias("logprob"))


def model_labels(spark, sf):
    model = F.concat_ws("/", "p_type", "p_name")
    return table(spark, sf, "part").select(
        "p_partkey", fx.family_label(model, "red").alias("red_label"),
        fx.family_label(model, "small").alias("small_label"),
    )


def uris(spark, sf):
    path = F.substring_index(F.substring_index("url", "://", -1), "?", 1)
    return table(spark, sf, "pages").select("page_id", fx.safe_uri(path).alias("uri"))


def suffixes(spark, sf):
    kind = F.element_at(F.array(*[F.lit(x) for x in (
        "video/mp4; rate=8000", "text/none", "audio/mpeg", "")]), (F.col("page_id") % 4 + 1).cast("int"))
    url = F.concat("url", F.when(F.col("page_id") % 3 == 0, ".WAV?x=1").otherwise(""))
    return table(spark, sf, "pages").select("page_id", fx.audio_suffix(url, kind).alias("suffix"))


def packed(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        pack_landmark(F.col("l_partkey") % 513, F.col("l_suppkey") % 513,
                      F.col("l_quantity").cast("int")).alias("hash"),
        frames_to_seconds(F.col("l_partkey")).alias("seconds"),
    )


def aligned(spark, sf):
    return _named(c.talk_aligned(spark, sf), "seq", "start", "end", "speaker")


def turns(spark, sf):
    return c.talk_turns(spark, sf).select(
        "audio_key", "turn_no", F.col("start").alias("start_ms"), F.col("end").alias("end_ms"),
        "speaker", "text", "unit_count",
    )


def ordered_intervals(spark, sf):
    """Overlapping intervals put into (start, end, speaker) order, as one sortable key each."""
    i = c.talk_intervals(spark, sf)
    key = order_key(F.col("start"), F.col("end"), F.col("speaker"))
    return i.withColumn("k", key).select("audio_key", "pos", "k.start", "k.end", "k.speaker").orderBy(
        "audio_key", "start", "end", "speaker")


def speakers(spark, sf):
    found = c.talk_intervals(spark, sf).groupBy("audio_key").agg(
        F.array_sort(F.collect_set("speaker")).alias("s"))
    return found.select("audio_key", F.array_join("s", ",").alias("speakers"),
                        F.size("s").cast("bigint").alias("num_speakers"))


def transcript_files(spark, sf):
    return render.transcript_lines(c.talk_segments(spark, sf))


def turn_files(spark, sf):
    return render.turn_lines(c.in_seconds(c.talk_turns(spark, sf)))


def rttm(spark, sf):
    return render.rttm_lines(c.in_seconds(c.talk_intervals(spark, sf)))


def _speaker_map(spark, sf):
    """Names by role and audio; a later row for the same speaker wins."""
    roles = c.talk_intervals(spark, sf).select("audio_key", "speaker").distinct()
    first = roles.select("audio_key", "speaker", F.lit(0).alias("pos"),
                         F.lit("replaced").alias("canonical_name"), F.lit(None).cast("string").alias("display_name"))
    second = roles.select(
        "audio_key", "speaker", F.lit(1).alias("pos"),
        F.when(F.col("speaker") == "user", F.concat(F.lit("Guest "), F.col("audio_key"))).otherwise("")
        .alias("canonical_name"),
        F.when(F.col("speaker") == "assistant", F.lit("Host")).alias("display_name"),
    )
    return first.unionByName(second)


def _corrections(spark, sf):
    """Two corrections for every interval of a third role; the first one listed wins."""
    i = c.talk_units(spark, sf, ("turn",)).where("turn = 1").groupBy("audio_key").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    return i.select(
        "audio_key", F.explode(F.array(
            F.struct(F.lit(0).alias("pos"), F.lit("user").alias("expected")),
            F.struct(F.lit(1).alias("pos"), F.lit("nobody").alias("expected")))).alias("x"),
        F.lit("assistant").alias("observed"), (F.col("start") / 1000.0).alias("start"),
        ((F.col("end") + 10) / 1000.0).alias("end"),
    ).select("audio_key", "x.pos", "observed", "x.expected", "start", "end")


def named_files(spark, sf):
    named = name_turns(c.in_seconds(c.talk_turns(spark, sf)), _speaker_map(spark, sf), _corrections(spark, sf))
    return render.named_lines(named)


def diarization_json(spark, sf):
    i = c.in_seconds(c.talk_intervals(spark, sf)).select(
        "audio_key", "pos", F.bround("start", 3).alias("start"), F.bround("end", 3).alias("end"), "speaker")
    body = F.to_json(F.struct("start", "end", "speaker"))
    head = speakers(spark, sf).select("audio_key", F.concat(
        F.lit('{"audio":'), json_value(F.concat(F.col("audio_key").cast("string"), F.lit(".wav"))),
        F.lit(',"speakers":'), json_value(F.split("speakers", ",")),
        F.lit(',"num_speakers":'), F.col("num_speakers").cast("string"),
        F.lit(',"diarization":[')).alias("head"))
    keys = ["audio_key"]
    return assemble(
        piece(head, keys, 0, F.col("head")),
        items(i, keys, 1, "pos", body, first=0),
        piece(head, keys, 2, F.lit('],"exclusive_diarization":[')),
        items(i, keys, 3, "pos", body, first=0),
        piece(head, keys, 4, F.lit("]}")),
    )


def _heads(spark, sf):
    """One row per audio: language and the diarization head."""
    spoken = speakers(spark, sf)
    language = F.when(F.col("audio_key") % 5 != 0, F.lit("fr"))
    return spoken.select(
        "audio_key", language.alias("language"),
        F.when(F.col("audio_key") % 3 != 0, F.lit("hub/Pyannote-x")).alias("model"),
        (F.col("audio_key") * 0.0125).alias("processing_seconds"),
        F.when(F.col("audio_key") % 4 == 0, F.array().cast("array<string>"))
        .otherwise(F.split("speakers", ",")).alias("speakers"),
        F.split("speakers", ",").alias("aligned_speakers"),
        F.when(F.col("audio_key") % 2 == 0, F.col("num_speakers")).alias("num_speakers"),
    )


def speech_with_speakers(spark, sf):
    words = settle(c.talk_aligned(spark, sf))
    return payload.transcription_with_speakers(
        _heads(spark, sf), c.in_seconds(build_turns(words, max_gap=800)), c.in_seconds(words), SPEECH_MODEL, "es", digits=9)


def speech_plain(spark, sf):
    words = c.talk_segment_words(spark, sf).withColumnRenamed("text", "word").withColumn(
        "start", F.when(F.col("seq") % 10 != 3, F.col("start")))
    return payload.transcription_plain(
        _heads(spark, sf), c.talk_segments(spark, sf), words, SPEECH_MODEL, "es", digits=9)


def speakers_with_text(spark, sf):
    return payload.diarization_with_transcript(
        _heads(spark, sf), c.in_seconds(c.talk_turns(spark, sf)), SPEAKER_MODEL)


def speakers_plain(spark, sf):
    return payload.diarization_plain(
        _heads(spark, sf), c.in_seconds(c.talk_intervals(spark, sf)), SPEAKER_MODEL)


def _job_lines(spark, sf):
    """Job texts with every variant of field names, lists and options."""
    key = F.col("o_orderkey").cast("string")
    kind = F.substring("o_orderpriority", 1, 1)
    asked = (
        F.when(kind == "1", '"requested_outputs":["diarization","transcription"]')
        .when(kind == "2", '"requested_outputs":[" Transcription "]')
        .when(kind == "3", F.concat(
            F.lit('"requested_outputs":[],"options":{"transcribe":true,"diarize":'),
            (F.col("o_orderkey") % 2 == 0).cast("string"), F.lit("}")))
        .when(kind == "4", '"requested_outputs":["summary","diarization","chapters"]')
        .otherwise('"options":null')
    )
    even = F.col("o_orderkey") % 2 == 0
    return table(spark, sf, "orders").select("o_orderkey", F.concat(
        F.when(even, '{"job_id":"j').otherwise('{"id":"j'), key,
        F.when(even, '","lease_id":"l').otherwise('","leaseId":"l'), key, F.lit('",'),
        F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(
            F.concat(F.lit('"audio":{"url":"http://host/'), key, F.lit('.mp3"},'))),
        asked, F.lit("}")).alias("value"))


def normalised_jobs(spark, sf):
    return jb.parse_jobs(_job_lines(spark, sf)).select("job_id", "lease_id", "url", "valid")


def resolved_jobs(spark, sf):
    both = jb.resolve_outputs(jb.parse_jobs(_job_lines(spark, sf)))
    only = jb.resolve_outputs(both.select("job_id", "requested_outputs", "options"), ["transcription"])
    return both.select(
        "job_id", F.array_join("outputs", ",").alias("outputs"), "reject_reason",
    ).join(only.select("job_id", F.col("reject_reason").alias("narrow_reason")), "job_id")


def _checked_jobs(spark, sf):
    """All jobs: ``accepted`` tells the valid ones, and a job on no conversation lacks everything it needs."""
    jobs = jb.resolve_outputs(jb.parse_jobs(_job_lines(spark, sf)))
    number = F.substring("job_id", 2, 20).cast("bigint")
    heads = _heads(spark, sf).select("audio_key")
    known = F.col("_known").isNotNull()
    jobs = jobs.select(
        "job_id", number.alias("audio_key"), "outputs", (F.col("valid") & F.col("reject_reason").isNull()).alias("accepted"),
    ).join(heads.withColumn("_known", F.lit(True)), "audio_key", "left").select(
        "job_id", "audio_key", "outputs", "accepted", (known & (F.col("audio_key") % 11 != 0)).alias("has_transcript"),
        (known & (F.col("audio_key") % 6 != 0)).alias("has_diarization"),
        (known & (F.col("audio_key") % 9 != 0)).alias("has_speakers"))
    return payload.check_jobs(jobs)


def checked_jobs(spark, sf):
    return _checked_jobs(spark, sf).select("job_id", "accepted", "missing")


def _asked(spark, sf, keys):
    """A folder with the conversations of those recordings; the derivations read it like the whole tables."""
    folder = f"{checkpoint_dir(spark)}/asked-{uuid.uuid4().hex}"
    table(spark, sf, "conversations").join(
        keys.select(F.col("audio_key").alias("conv_id")).distinct(), "conv_id", "left_semi",
    ).write.parquet(f"{folder}/conversations.parquet")
    return folder


def job_payloads(spark, sf):
    """Only recordings that a complete job asks for are read on, by kind of job. Aligned words and turns are written once; both kinds of output read them."""
    jobs = settle(_checked_jobs(spark, sf).where("accepted"))
    ready = jobs.where("missing is null")
    text, who = (F.array_contains("outputs", kind) for kind in ("transcription", "diarization"))
    both = _asked(spark, sf, ready.where(text & who))
    words = settle(c.talk_aligned(spark, both))
    said = c.in_seconds(settle(build_turns(words, max_gap=800)))
    heads = settle(_heads(spark, both))
    return payload.job_payloads(
        jobs, speech_plain(spark, _asked(spark, sf, ready.where(text & ~who))),
        payload.transcription_with_speakers(
            heads, said, c.in_seconds(words), SPEECH_MODEL, "es", digits=9),
        speakers_plain(spark, _asked(spark, sf, ready.where(who & ~text))),
        payload.diarization_with_transcript(heads, said, SPEAKER_MODEL))


QUERIES = {
    "f1_f2_f3_f4_timestamps": timestamps,
    "f5_collapse_ws": collapsed_text,
    "f6_word_logprob": word_scores,
    "f7_model_labels": model_labels,
    "f8_safe_uri": uris,
    "f9_audio_suffix": suffixes,
    "f10_f11_landmark_numbers": packed,
    "p2_ordered_intervals": ordered_intervals,
    "j1_j2_p1_assign_speaker": aligned,
    "w1_build_turns": turns,
    "a8_distinct_speakers": speakers,
    "snk1_w6_transcript_files": transcript_files,
    "snk4_w6_turn_files": turn_files,
    "snk3_rttm": rttm,
    "n1_snk5_named_files": named_files,
    "snk2_diarization_json": diarization_json,
    "pl1_speech_with_speakers": speech_with_speakers,
    "pl1_speech_plain": speech_plain,
    "pl2_speakers_with_text": speakers_with_text,
    "pl2_speakers_plain": speakers_plain,
    "src11_normalised_jobs": normalised_jobs,
    "p4_t5_resolved_outputs": resolved_jobs,
    "pl3_checked_jobs": checked_jobs,
    "snk8_pl3_job_payloads": job_payloads,
}

MS = "greatest(0, round_even((o_totalprice - 200000) * 1000, 0)::BIGINT)"
STEM = (r"regexp_replace(regexp_extract(p, '([^/]+)/*$', 1), '(?s)^(.+)\.[^.]+$', '\1')")

FIXES = c.TURNS_SQL + """,
fix AS (SELECT audio_key, min(us) AS s, max(ue) + 10 AS e FROM units WHERE turn = 1 GROUP BY 1),
fixed AS (SELECT t.*, CASE WHEN f.s IS NOT NULL THEN 'user' ELSE speaker END AS final
  FROM turns t LEFT JOIN fix f ON t.audio_key = f.audio_key AND t.speaker = 'assistant'
   AND abs(f.s - start_ms) < 20 AND abs(f.e - end_ms) < 20),
known AS (SELECT DISTINCT conv_id AS audio_key, role AS speaker FROM conversations),
named AS (SELECT f.*, CASE WHEN k.speaker = 'user' THEN 'Guest ' || f.audio_key
    WHEN k.speaker = 'assistant' THEN 'Host' ELSE final END AS label
  FROM fixed f LEFT JOIN known k ON f.audio_key = k.audio_key AND f.final = k.speaker)"""


def _srt(number, s, e, text, first):
    return (f"CASE WHEN {first} THEN '' ELSE chr(10) END || ({number}) || chr(10) || {c.srt_sql(s)} "
            f"|| ' --> ' || {c.srt_sql(e)} || chr(10) || {text}")


def _sec(ms):
    return f"(({ms}) / 1000.0::DOUBLE)"


def _num(ms):
    """A JSON number as both engines print a double."""
    return f"to_json({_sec(ms)})::VARCHAR"


def _list(source, part, order, body, sep="','"):
    return (f"SELECT audio_key, {part} AS part, {order} AS ord, CASE WHEN {order} = min({order}) "
            f"OVER (PARTITION BY audio_key) THEN '' ELSE {sep} END || {body} AS body FROM {source}")


HEADS = """
spoken AS (SELECT audio_key, list_sort(list_distinct(list(speaker))) AS l FROM intervals GROUP BY 1),
heads AS (SELECT audio_key, CASE WHEN audio_key % 5 <> 0 THEN 'fr' ELSE 'es' END AS language,
   CASE WHEN audio_key % 3 <> 0 THEN 'Pyannote-x' ELSE 'pyannote-speaker-community-1' END AS model,
   round_even(audio_key * 0.0125::DOUBLE * 1000, 0)::BIGINT AS took, len(l) AS n FROM spoken)"""


def _ends(first, middle, last, n=2):
    return (f"SELECT audio_key, 0 AS part, 0 AS ord, {first} AS body FROM heads UNION ALL "
            f"SELECT audio_key, 2, 0, {middle} FROM heads"
            + (f" UNION ALL SELECT audio_key, 4, 0, {last} FROM heads" if n == 3 else ""))


def _word(speaker=""):
    return (f"""'{{"text":' || to_json(word) || ',"start":' || {_num('us')} || ',"end":' || {_num('ue')}
 || ',"type":"word"' {speaker} || CASE WHEN probability > 0 THEN ',"logprob":' || to_json(round(ln(probability), 9))
 ELSE '' END || '}}'""")


TEXT_HEAD = "'{\"text\":\"'"
TEXT_MIDDLE = "'\",\"language\":' || to_json(language) || ',\"model\":\"whisper-large-v3\",\"words\":['"


def _inside(text):
    return f"(to_json({text})::VARCHAR)[2:-2]"


SPEECH_BOTH = (
    _ends(TEXT_HEAD, TEXT_MIDDLE, "']}'", 3) + " UNION ALL "
    + _list("turns", 1, "turn_no", _inside("'[' || speaker || '] ' || text"), r"'\n'") + " UNION ALL "
    + _list("aligned", 3, "seq", _word("|| ',\"speaker_id\":' || to_json(speaker)"))
)
PLAIN_SQL = c.SEGMENTS_SQL + f""",
lines AS (SELECT audio_key, segment_pos, {c.collapse_sql('text')} AS t FROM segs),
bounds AS (SELECT audio_key, min(segment_pos) AS f, max(segment_pos) AS l FROM lines WHERE t <> '' GROUP BY 1),
shown AS (SELECT lines.* FROM lines JOIN bounds USING (audio_key) WHERE segment_pos BETWEEN f AND l),
timed AS (SELECT u.* FROM units u JOIN segs s ON u.audio_key = s.audio_key AND u.turn = s.segment_pos
          WHERE seq % 10 <> 3)"""
SPEECH_ONLY = (
    _ends(TEXT_HEAD, TEXT_MIDDLE, "']}'", 3) + " UNION ALL "
    + _list("shown", 1, "segment_pos", _inside("t"), r"'\n'") + " UNION ALL "
    + _list("timed", 3, "seq", _word())
)
MODEL_HEAD = "'{\"model\":' || to_json(model) || ',\"segments\":['"
META = "'],\"metadata\":{\"speaker_count\":' || n || ',\"processing_time_ms\":' || took || '}}'"
SPAN = "',\"start\":' || %s || ',\"end\":' || %s"
SPEAKERS_BOTH = _ends(MODEL_HEAD, META, "") + " UNION ALL " + _list(
    "turns", 1, "turn_no", "'{\"speaker_id\":' || to_json(speaker) || "
    + SPAN % (_num("start_ms"), _num("end_ms")) + " || ',\"text\":' || to_json(text) || '}'")
SPEAKERS_ONLY = _ends(MODEL_HEAD, META, "") + " UNION ALL " + _list(
    "intervals", 1, "pos", "'{\"speaker_id\":' || to_json(speaker) || "
    + SPAN % (_num("s"), _num("e")) + " || '}'")

JOBS = """
jobs AS (SELECT o_orderkey AS k, 'j' || o_orderkey AS job_id, 'l' || o_orderkey AS lease_id,
   CASE WHEN o_orderkey % 7 <> 0 THEN 'http://host/' || o_orderkey || '.mp3' END AS url,
   CASE left(o_orderpriority, 1) WHEN '1' THEN 'transcription,diarization' WHEN '2' THEN 'transcription'
     WHEN '3' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'transcription,diarization' ELSE 'transcription' END
   END AS outputs,
   CASE left(o_orderpriority, 1) WHEN '4' THEN 'unknown output: chapters, summary'
     WHEN '5' THEN 'no output requested' END AS reject_reason FROM orders),
checked AS (SELECT job_id, k AS audio_key, outputs, url IS NOT NULL AND reject_reason IS NULL AS accepted, nullif(concat_ws(', ',
    CASE WHEN contains(outputs, 'transc') AND (k % 11 = 0 OR conv IS NULL) THEN 'transcript' END,
    CASE WHEN contains(outputs, 'diar') AND (k % 6 = 0 OR conv IS NULL) THEN 'diarization' END,
    CASE WHEN contains(outputs, 'diar') AND (k % 9 = 0 OR conv IS NULL) THEN 'speakers' END), '') AS missing
  FROM jobs LEFT JOIN (SELECT DISTINCT conv_id AS conv FROM conversations) ON k = conv)"""

ORACLES = {
    "f1_f2_f3_f4_timestamps": f"""SELECT o_orderkey, {c.srt_sql(MS)} AS srt,
        {c.clock_sql(MS, 1000)} AS cut, {c.srt_sql(MS, '.')} AS dotted,
        {c.clock_sql('greatest(0, round_even(o_totalprice - 200000, 0)::BIGINT)', 1)} AS whole FROM orders""",
    "f5_collapse_ws": f"SELECT doc_id, {c.collapse_sql('text')} AS text FROM documents",
    "f6_word_logprob": f"""WITH {c.UNITS_SQL} SELECT audio_key, seq,
        CASE WHEN probability > 0 THEN round(ln(probability), 6) END AS logprob FROM units""",
    "f7_model_labels": """SELECT p_partkey,
        CASE WHEN starts_with(p_name, 'red') THEN p_name ELSE 'red-' || p_name END AS red_label,
        CASE WHEN starts_with(p_name, 'small') THEN p_name ELSE 'small-' || p_name END AS small_label FROM part""",
    "f8_safe_uri": f"""SELECT page_id, left(regexp_replace({STEM}, '[^\\p{{L}}\\p{{N}}]', '_', 'g'), 48)
        || '_' || left(sha1(p), 12) AS uri
        FROM (SELECT page_id, split_part(split_part(url, '://', -1), '?', 1) AS p FROM pages)""",
    "f9_audio_suffix": """SELECT page_id, CASE
        WHEN page_id % 3 = 0 AND regexp_matches(split_part(url || '.WAV', '?', 1), '(?i)[^/]\\.(aac|flac|m4a|mp3|mp4|ogg|wav|wma)/*$')
          THEN lower(regexp_extract(split_part(url || '.WAV', '?', 1), '(\\.[^./]+)/*$', 1))
        WHEN regexp_matches(split_part(url, '?', 1), '(?i)[^/]\\.(aac|flac|m4a|mp3|mp4|ogg|wav|wma)/*$')
          THEN lower(regexp_extract(split_part(url, '?', 1), '(\\.[^./]+)/*$', 1))
        WHEN page_id % 4 = 0 THEN '.mp4' ELSE '.mp3' END AS suffix FROM pages""",
    "f10_f11_landmark_numbers": """SELECT l_orderkey, l_linenumber,
        ((l_partkey % 513) << 20) | ((l_suppkey % 513) << 10) | l_quantity::BIGINT AS hash,
        l_partkey * 512 / 8000.0::DOUBLE AS seconds FROM lineitem""",
    "p2_ordered_intervals": f"""WITH {c.UNITS_SQL} SELECT audio_key, pos, s AS start, e AS "end", speaker
        FROM intervals""",
    "j1_j2_p1_assign_speaker": f"""WITH {c.ALIGNED_SQL}
        SELECT audio_key, seq, us AS start, ue AS "end", speaker FROM aligned""",
    "w1_build_turns": f"WITH {c.TURNS_SQL} SELECT * FROM turns",
    "a8_distinct_speakers": f"""WITH {c.UNITS_SQL}, {HEADS}
        SELECT audio_key, array_to_string(l, ',') AS speakers, len(l) AS num_speakers FROM spoken""",
    "snk1_w6_transcript_files": f"""WITH {c.SEGMENTS_SQL},
        shown AS (SELECT *, {c.collapse_sql('text')} AS t FROM segs WHERE {c.collapse_sql('text')} <> '')
        SELECT audio_key, segment_pos + 1 AS line_no, '[' || {c.srt_sql('s_ms', '.')} || '] ' || t AS txt,
          {_srt('segment_pos + 1', 's_ms', 'greatest(0, e_ms)', 't',
                'segment_pos = min(segment_pos) OVER (PARTITION BY audio_key)')} AS srt FROM shown""",
    "snk4_w6_turn_files": f"""WITH {c.TURNS_SQL} SELECT audio_key, turn_no + 1 AS line_no,
        '[' || {c.clock_sql('start_ms', 1000)} || ' - ' || {c.clock_sql('end_ms', 1000)} || '] '
        || speaker || ': ' || text AS txt,
        {_srt('turn_no + 1', 'start_ms', 'end_ms', "'[' || speaker || '] ' || text", 'turn_no = 0')} AS srt
        FROM turns""",
    "snk3_rttm": f"""WITH {c.UNITS_SQL} SELECT audio_key, pos AS line_no,
        'SPEAKER ' || audio_key || ' 1 ' || printf('%.3f', s / 1000.0::DOUBLE) || ' '
        || printf('%.3f', (e - s) / 1000.0::DOUBLE) || ' <NA> <NA> ' || speaker || ' <NA> <NA>' AS rttm
        FROM intervals""",
    "n1_snk5_named_files": f"""WITH {FIXES} SELECT audio_key, turn_no + 1 AS line_no,
        '[' || {c.clock_sql('round_even(start_ms / 1000.0::DOUBLE, 0)::BIGINT', 1)} || ' - '
        || {c.clock_sql('round_even(end_ms / 1000.0::DOUBLE, 0)::BIGINT', 1)} || '] ' || label || ': ' || text AS txt,
        {_srt('turn_no + 1', 'start_ms', 'end_ms', "label || ': ' || text", 'turn_no = 0')} AS srt FROM named""",
    "snk2_diarization_json": f"""WITH {c.UNITS_SQL}, {HEADS}
        SELECT audio_key, 0 AS part, 0 AS ord, '{{"audio":"' || audio_key || '.wav","speakers":' || to_json(l)
          || ',"num_speakers":' || len(l) || ',"diarization":[' AS body FROM spoken
        UNION ALL SELECT audio_key, 2, 0, '],"exclusive_diarization":[' FROM spoken
        UNION ALL SELECT audio_key, 4, 0, ']}}' FROM spoken
        UNION ALL {_list('intervals', 1, 'pos', "'{' || substr(" + SPAN % (_num('s'), _num('e')) + ", 2) || ',\"speaker\":' || to_json(speaker) || '}'")}
        UNION ALL {_list('intervals', 3, 'pos', "'{' || substr(" + SPAN % (_num('s'), _num('e')) + ", 2) || ',\"speaker\":' || to_json(speaker) || '}'")}""",
    "pl1_speech_with_speakers": f"WITH {c.TURNS_SQL}, {HEADS} {SPEECH_BOTH}",
    "pl1_speech_plain": f"WITH {c.UNITS_SQL}, {HEADS}, {PLAIN_SQL} {SPEECH_ONLY}",
    "pl2_speakers_with_text": f"WITH {c.TURNS_SQL}, {HEADS} {SPEAKERS_BOTH}",
    "pl2_speakers_plain": f"WITH {c.UNITS_SQL}, {HEADS} {SPEAKERS_ONLY}",
    "src11_normalised_jobs": f"WITH {JOBS} SELECT job_id, lease_id, url, url IS NOT NULL AS valid FROM jobs",
    "p4_t5_resolved_outputs": f"""WITH {JOBS} SELECT job_id, outputs, reject_reason,
        coalesce(reject_reason, CASE WHEN contains(outputs, 'diar')
          THEN 'outside capabilities: diarization' END) AS narrow_reason FROM jobs""",
    "pl3_checked_jobs": f"WITH {JOBS} SELECT job_id, accepted, missing FROM checked",
    "snk8_pl3_job_payloads": f"""WITH {c.TURNS_SQL}, {HEADS}, {PLAIN_SQL}, {JOBS},
        ready AS (SELECT *, contains(outputs, ',') AS two FROM checked WHERE missing IS NULL AND accepted),
        sb AS ({SPEECH_BOTH}), so AS ({SPEECH_ONLY}), db AS ({SPEAKERS_BOTH})
        SELECT job_id, 0 AS part, 0 AS ord, '{{"outputs":{{"transcription":' AS body FROM ready
        UNION ALL SELECT job_id, 19, 0, '}}}}' FROM ready
        UNION ALL SELECT job_id, 9, 0, ',"diarization":' FROM ready WHERE two
        UNION ALL SELECT job_id, part + 1, ord, body FROM ready JOIN sb USING (audio_key) WHERE two
        UNION ALL SELECT job_id, part + 10, ord, body FROM ready JOIN db USING (audio_key) WHERE two
        UNION ALL SELECT job_id, part + 1, ord, body FROM ready JOIN so USING (audio_key) WHERE NOT two""",
}
