"""Alignment, turns, naming, rendering and payloads against small sequential models."""

import json
import random

from pyspark.sql import functions as F

from speechlake.operators import payload, turns
from speechlake.operators.align import assign_speaker
from speechlake.operators.checkpoints import settle
from speechlake.operators.jobs import normalise_jobs, parse_capabilities, resolve_outputs
from speechlake.operators.naming import name_turns
from speechlake.operators.turns import build_turns
from speechlake.operators.units import explode_intervals, explode_units
from speechlake.plans import speech
from speechlake.sinks import render

UNIT = "audio_key string, seq bigint, start double, end double, text string, probability double"
SPAN = "audio_key string, pos int, start double, end double, speaker string"


def model_speaker(s, e, spans):
    """Scores every interval; the rules of choice are stated as two sorts."""
    c = (s + e) / 2
    scored = []
    for pos, (a, b, who) in enumerate(spans):
        if b < s - 1.0:
            continue
        away = 0.0 if a <= c <= b else min(abs(c - a), abs(c - b))
        scored.append((min(e, b) - max(s, a), away, pos, who))
    over = sorted((-o, p, w) for o, _, p, w in scored if o > 0)
    near = sorted((d, p, w) for _, d, p, w in scored if d <= 0.75)
    return over[0][2] if over else near[0][2] if near else "UNKNOWN"


def model_turns(rows, gap=0.8):
    """rows in order: (start, end, speaker, text)."""
    out = []
    for s, e, who, text in rows:
        if not text.strip():
            continue
        last = out[-1] if out else None
        if last and last[2] == who and s - last[1] <= gap:
            last[1] = max(last[1], e)
            last[3] += text
            last[4] += 1
        else:
            out.append([s, e, who, text, 1])
    return [(s, e, who, " ".join(t.split()), n) for s, e, who, t, n in out]


def random_talk(seed, reversed_units=False, n=160):
    rng = random.Random(seed)
    t, units, spans = 0.0, [], []
    for i in range(n):
        t += rng.choice([0, 0.25, 0.5, 1.0, 3.5])
        length = rng.choice([0, 0.25, 0.5, 2.0, 8.0])
        if reversed_units and rng.random() < 0.15:
            length = -rng.choice([0.5, 1.5, 4.0])
        units.append((t, t + length, rng.choice([" a", " b", "  ", " cc"])))
    end = 0.0
    while end < t:
        a = end + rng.choice([-0.5, 0, 0.25, 2.0, 6.0])
        end = max(a + rng.choice([0.0, 0.5, 2.0, 45.0]), end + 0.25)
        spans.append((a, end, rng.choice("AB")))
    spans.sort()
    return units, spans


def frames(spark, talks):
    u = [(k, i, s, e, x, 0.5) for k, (us, _) in talks.items() for i, (s, e, x) in enumerate(us)]
    v = [(k, i, a, b, w) for k, (_, vs) in talks.items() for i, (a, b, w) in enumerate(vs)]
    return spark.createDataFrame(u, UNIT), spark.createDataFrame(v, SPAN)


def check_talks(spark, talks, block_rows):
    units, spans = frames(spark, talks)
    aligned = assign_speaker(units, spans, block_rows=block_rows)
    got = {(r.audio_key, r.seq): r.speaker for r in aligned.collect()}
    want = {}
    for k, (us, vs) in talks.items():
        for i, (s, e, _) in enumerate(us):
            want[k, i] = model_speaker(s, e, vs)
    assert got == want
    turns = build_turns(aligned, block_rows=block_rows, turn_block=3).collect()
    by = {}
    for r in sorted(turns, key=lambda r: (r.audio_key, r.turn_no)):
        by.setdefault(r.audio_key, []).append(r)
    for k, (us, _) in talks.items():
        rows = [(s, e, want[k, i], x) for i, (s, e, x) in enumerate(us)]
        assert [r.turn_no for r in by[k]] == list(range(len(by[k])))
        assert [(r.start, r.end, r.speaker, r.text, r.unit_count) for r in by[k]] == model_turns(rows)


def test_alignment_and_turns_random(spark):
    check_talks(spark, {f"x{s}": random_talk(s) for s in range(8)}, block_rows=7)


def test_alignment_and_turns_with_reversed_units(spark):
    check_talks(spark, {f"x{s}": random_talk(s, True) for s in range(20, 28)}, block_rows=5)


def test_alignment_golden(spark):
    units = [("a", 0, 1.0, 2.0, " tie", None), ("a", 1, 5.0, 5.0, " point", None),
             ("a", 2, 20.75, 20.75, " edge", None), ("a", 3, 40.76, 40.76, " far", None)]
    spans = [("a", 0, 0.5, 1.5, "A"), ("a", 1, 1.5, 2.5, "B"), ("a", 2, 4.5, 6.0, "C"),
             ("a", 3, 10.0, 20.0, "D"), ("a", 4, 30.0, 40.0, "E")]
    got = assign_speaker(spark.createDataFrame(units, UNIT), spark.createDataFrame(spans, SPAN)).collect()
    assert {r.seq: r.speaker for r in got} == {0: "A", 1: "C", 2: "D", 3: "UNKNOWN"}


def test_turn_gap_limit(spark):
    rows = [("a", 0, 0, 1000, "x", "A"), ("a", 1, 1800, 1900, " ", "B"), ("a", 2, 1800, 1900, "y", "A"),
            ("a", 3, 2701, 2800, "z", "A")]
    df = spark.createDataFrame(rows, "audio_key string, seq bigint, start bigint, end bigint, text string, speaker string")
    got = [(r.turn_no, r.text, r.unit_count) for r in build_turns(df, max_gap=800).orderBy("turn_no").collect()]
    assert got == [(0, "xy", 2), (1, "z", 1)]


def nested(spark):
    from speechlake.sources.documents import TRANSCRIPT_DDL

    word = lambda s, e, w: dict(start=s, end=e, word=w, probability=0.5)
    seg = lambda **k: dict({n: None for n in (
        "id", "start", "end", "text", "avg_logprob", "no_speech_prob", "compression_ratio", "words")}, **k)
    segs = [
        seg(id=0, start=0.0, end=1.0, text=" Hi you", words=[word(0.0, 0.5, " Hi"), word(None, 1.0, " lost"), word(0.5, 1.0, " you")]),
        seg(id=1, start=2.0, end=3.0, text="whole", words=[]),
        seg(id=2, start=None, end=None, text="no times", words=None),
        seg(id=3, start=5.0, end=6.0, text=" \t", words=[]),
    ]
    row = ("a", True, "a.mp3", "en", 0.9, 10.0, 5.0, segs)
    return spark.createDataFrame([row], f"audio_key string, parse_ok boolean, {TRANSCRIPT_DDL}")


def test_explode_units(spark):
    got = [(r.start, r.end, r.text, r.probability) for r in explode_units(nested(spark)).orderBy("seq").collect()]
    assert got == [(0.0, 0.5, " Hi", 0.5), (0.5, 1.0, " you", 0.5), (2.0, 3.0, "whole", None), (0.0, 0.0, "no times", None)]


def test_audit_of_nested_documents(spark):
    from speechlake.operators import transcript_audit as ta

    heads, segments, words = ta.tables_from_transcripts(nested(spark))
    audios = spark.createDataFrame([("a",), ("b",)], "audio_key string")
    listing = spark.createDataFrame([("a", ".txt")], "audio_key string, suffix string")
    rows = {r.audio_key: r for r in ta.audit(audios, heads, segments, words, listing).collect()}
    assert rows["b"].flags == ["missing_json"]
    a = rows["a"]
    assert (a.segments, a.words, a.word_timestamps, a.speech_coverage) == (4, 3, True, 0.5)
    assert a.flags == ["missing_srt", "near_empty_transcript"]
    assert a.segment_overlaps == 1 and a.max_segment_overlap_seconds == 3.0
    assert a.median_word_probability == 0.5


def turns_df(spark, rows):
    return spark.createDataFrame(rows, "audio_key string, turn_no bigint, start double, end double, speaker string, text string, unit_count bigint")


def test_naming(spark):
    turns = turns_df(spark, [("a", 0, 1.0, 2.0, "S0", "hello", 1), ("a", 1, 3.0, 4.0, "S0", "x", 1), ("a", 2, 5.0, 6.0, "S1", "y", 1)])
    names = spark.createDataFrame([("a", 0, "S0", "Old", None), ("a", 1, "S0", "", "Shown"), ("a", 2, "S2", "Canon", "d")],
                                  "audio_key string, pos int, speaker string, canonical_name string, display_name string")
    fixes = spark.createDataFrame([("a", 0, "S0", "S2", 1.01, 2.01), ("a", 1, "S0", "S1", 1.0, 2.0), ("a", 2, "S0", "S2", 3.02, 4.0)],
                                  "audio_key string, pos int, observed string, expected string, start double, end double")
    named = name_turns(turns, names, fixes)
    assert {r.turn_no: r.label for r in named.collect()} == {0: "Canon", 1: "Shown", 2: "S1"}
    lines = named_text = [r.txt for r in render.named_lines(named).orderBy("line_no").collect()]
    assert named_text == lines and lines[0] == "[00:00:01 - 00:00:02] Canon: hello"


def test_srt_numbering(spark):
    segs = spark.createDataFrame([("a", 0, 0.0, 1.0, " one"), ("a", 1, 1.0, 2.0, " "), ("a", 2, 2.0, 3.5, "three")],
                                 "audio_key string, segment_pos int, start double, end double, text string")
    srt = [r.srt for r in render.transcript_lines(segs).orderBy("line_no").collect()]
    assert "\n".join(srt) + "\n" == (
        "1\n00:00:00,000 --> 00:00:01,000\none\n\n3\n00:00:02,000 --> 00:00:03,500\nthree\n")
    turns = turns_df(spark, [("a", 0, 0.0, 1.0, "A", "x", 1), ("a", 1, 1.0, 2.0, "B", "y", 1)])
    srt = [r.srt for r in render.turn_lines(turns).orderBy("line_no").collect()]
    assert "\n".join(srt) + "\n" == (
        "1\n00:00:00,000 --> 00:00:01,000\n[A] x\n\n2\n00:00:01,000 --> 00:00:02,000\n[B] y\n")


def document(fragments, **where):
    rows = [r for r in fragments.collect() if all(r[k] == v for k, v in where.items())]
    return json.loads("".join(r.body for r in sorted(rows, key=lambda r: (r.part, r.ord))))


def test_payloads(spark):
    heads = spark.createDataFrame([("a", None, None, 1.2345, [], ["A", "B"], 7)],
                                  "audio_key string, language string, model string, processing_seconds double, speakers array<string>, aligned_speakers array<string>, num_speakers int")
    turns = turns_df(spark, [("a", 0, 0.0, 1.0, "A", 'say "hi"', 1), ("a", 1, 1.0, 2.0, "B", "ñ\\", 1)])
    units = spark.createDataFrame([("a", 3, 0.0, 1.0, " hi ", 0.0, "A"), ("a", 9, 1.0, 2.0, "ñ", 1.0, "B")],
                                  UNIT + ", speaker string")
    both = document(payload.transcription_with_speakers(heads, turns, units, "m/large", "es"))
    assert both == {"text": '[A] say "hi"\n[B] ñ\\', "language": "es", "model": "whisper-large", "words": [
        {"text": "hi", "start": 0.0, "end": 1.0, "type": "word", "speaker_id": "A"},
        {"text": "ñ", "start": 1.0, "end": 2.0, "type": "word", "speaker_id": "B", "logprob": 0.0}]}
    seg = spark.createDataFrame([("a", 0, " "), ("a", 1, " x  y"), ("a", 2, ""), ("a", 3, "z"), ("a", 4, " ")],
                                "audio_key string, segment_pos int, text string")
    words = units.withColumnRenamed("text", "word").withColumn("end", F.when(F.col("seq") == 9, F.col("end")))
    plain = document(payload.transcription_plain(heads, seg, words, "whisper-x"))
    assert plain["text"] == "x y\n\nz" and plain["language"] is None and len(plain["words"]) == 1
    speakers = document(payload.diarization_with_transcript(heads, turns, "p/community-1"))
    assert speakers["model"] == "pyannote-community-1"
    assert speakers["metadata"] == {"speaker_count": 2, "processing_time_ms": 1234}
    assert speakers["segments"][0] == {"speaker_id": "A", "start": 0.0, "end": 1.0, "text": 'say "hi"'}
    spans = spark.createDataFrame([("a", 0, 0.0, 1.0, "A")], SPAN)
    only = document(payload.diarization_plain(heads, spans, "p/x"))
    assert only["metadata"]["speaker_count"] == 7 and only["segments"] == [{"speaker_id": "A", "start": 0.0, "end": 1.0}]
    jobs = payload.check_jobs(spark.createDataFrame([
        ("j1", "a", ["transcription", "diarization"], True, True, True), ("j2", "a", ["diarization"], False, True, False),
        ("j3", "a", ["transcription", "diarization"], True, False, False)],
        "job_id string, audio_key string, outputs array<string>, has_transcript boolean, has_diarization boolean, has_speakers boolean"))
    assert {r.job_id: r.missing for r in jobs.collect()} == {"j1": None, "j2": None, "j3": "diarization, speakers"}
    out = payload.job_payloads(
        jobs, payload.transcription_plain(heads, seg, words, "whisper-x"),
        payload.transcription_with_speakers(heads, turns, units, "m/large", "es"),
        payload.diarization_plain(heads, spans, "p/x"), payload.diarization_with_transcript(heads, turns, "p/community-1"))
    assert document(out, job_id="j1") == {"outputs": {"transcription": both, "diarization": speakers}}
    assert document(out, job_id="j2") == {"outputs": {"diarization": only}}
    assert out.where("job_id = 'j3'").isEmpty()


def test_jobs(spark):
    assert parse_capabilities("Diarization, transcription") == ["transcription", "diarization"]
    ddl = "job_id string, requested_outputs array<string>, options struct<transcribe: boolean, diarize: boolean>"
    rows = [("a", ["Diarization ", "transcription"], None), ("b", [], (True, False)), ("c", None, None),
            ("d", ["video"], None), ("e", ["diarization"], None)]
    got = {r.job_id: (r.outputs, r.reject_reason) for r in resolve_outputs(spark.createDataFrame(rows, ddl), ["transcription"]).collect()}
    assert got["b"] == (["transcription"], None)
    assert got["a"][1] == got["e"][1] == "outside capabilities: diarization"
    assert got["c"][1] == "no output requested" and got["d"][1] == "unknown output: video"
    from speechlake.operators.jobs import JOB_DDL
    raw = spark.createDataFrame([(None, "i", "", "L", ("u", None), None, None), ("j", None, "l", None, None, None, None)], JOB_DDL)
    assert [(r.job_id, r.lease_id, r.valid) for r in normalise_jobs(raw).collect()] == [("i", "L", True), ("j", "l", False)]


def test_explode_intervals(spark):
    df = spark.createDataFrame([("a", [(0.0, 1.0, "A"), (1.0, 2.0, "B")])],
                               "audio_key string, exclusive_diarization array<struct<start: double, end: double, speaker: string>>")
    assert [(r.pos, r.speaker) for r in explode_intervals(df).collect()] == [(0, "A"), (1, "B")]


def test_speakers_documents_align_once(spark, monkeypatch):
    from speechlake.plans import results

    calls, real = [], results.c.talk_aligned
    monkeypatch.setattr(results.c, "talk_aligned", lambda *a: calls.append(a) or real(*a))
    assert results.speakers_document(spark, "/root/testdata/sf0.001").count() > 0 and len(calls) == 1


def test_payloads_read_only_recordings_of_complete_jobs(spark, monkeypatch):
    sf, seen, real = "/root/testdata/sf0.001", [], speech.settle

    def settle(df):
        seen.append(real(df))
        return seen[-1]

    monkeypatch.setattr(speech, "settle", settle)
    speech.job_payloads(spark, sf)
    keys = lambda df: {r[0] for r in df.select("audio_key").distinct().collect()}
    jobs = next(df for df in seen if "missing" in df.columns)
    both = keys(jobs.where("missing is null and array_contains(outputs, 'transcription') and array_contains(outputs, 'diarization')"))
    words = next(df for df in seen if "seq_block" in df.columns)
    assert both and keys(words) == both & keys(speech.c.talk_words(spark, sf))
    assert len(keys(words)) < len(keys(speech.c.talk_words(spark, sf)))


def test_texts_move_once_until_their_stretches_are_joined(spark, monkeypatch):
    """Words move to their place in one exchange, and are one text a stretch when they are written; before, they moved twice and stayed apart."""
    import re

    talk = random_talk(5)
    units, spans = frames(spark, {"a": talk})
    written = []
    monkeypatch.setattr(turns, "settle", lambda df: written.append(settle(df)) or written[-1])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        aligned = assign_speaker(units, spans)
        plan = spark._jvm.PythonSQLUtils.explainString(aligned._jdf.queryExecution(), "formatted")
        moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
        assert sum("text#" in columns for columns in moved) == 1
        assert build_turns(aligned).count() > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    spoken = sum(bool(text.strip()) for _, _, text in talk[0])
    assert sum(u["n"] for r in written[0].collect() for u in r["_units"]) == spoken
    assert all(len(r["_units"]) == 1 for r in written[0].collect())


def test_reversed_unit_next_to_joined_stretches(spark):
    """A turn over several blocks, one of whose stretches holds a unit that ends before it starts."""
    rows = [(0.0, 9.0), (1.0, 1.5), (2.0, 2.5), (9.5, 4.0), (9.6, 9.7), (12.0, 12.5), (12.6, 13.0), (13.1, 20.0), (14.0, 14.2)]
    aligned = spark.createDataFrame([("a", i, s, e, " w", "A") for i, (s, e) in enumerate(rows)],
                                    "audio_key string, seq bigint, start double, end double, text string, speaker string")
    want = model_turns([(s, e, "A", " w") for s, e in rows])
    for block_rows in (2, 3, 4, 100):
        got = build_turns(aligned, block_rows=block_rows).orderBy("turn_no").collect()
        assert [(r["start"], r["end"], r["speaker"], r["text"], r["unit_count"]) for r in got] == want
