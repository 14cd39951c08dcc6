"""Result documents as JSON: every field, order, nulls, empty lists; positions and numbers."""

import json

from speechlake.operators.units import with_positions
from speechlake.sinks import documents as docs

HEAD = "audio_key string, audio string, model string, created_at_utc string, duration_seconds double, processing_seconds double, speakers array<string>"
SPAN = "audio_key string, pos bigint, start double, end double, speaker string"


def read(spark, fragments, keys, path):
    docs.write_containers(fragments, keys, path)
    return {tuple(r[k] for k in keys): json.loads(r.document) for r in docs.read_containers(spark, path, keys).collect()}


def test_diarization_document(spark, tmp_path):
    heads = spark.createDataFrame([("a", 'a "1".wav', "m", "2026-01-01T00:00:00+00:00", 12.34567, None, ["S1", "S0"]), ("b", "b.wav", None, None, 0.0, 1.0, [])], HEAD)
    regular = spark.createDataFrame([("a", 0, 0.12349, 1.0, "S0"), ("a", 1, 1.0, 2.0005, "é"), ("a", 10, 3.0, 4.0, None)], SPAN)
    exclusive = spark.createDataFrame([("a", 3, 0.5, 1.0, "S0")], SPAN)
    got = read(spark, docs.diarization_document(heads, regular, exclusive), ["audio_key"], f"{tmp_path}/d")
    assert got["a",] == {
        "audio": 'a "1".wav', "model": "m", "created_at_utc": "2026-01-01T00:00:00+00:00", "duration_seconds": 12.346, "processing_seconds": None,
        "speaker_scope": "local_to_audio_file", "speakers": ["S1", "S0"], "num_speakers": 2,
        "diarization": [{"start": 0.123, "end": 1.0, "speaker": "S0"}, {"start": 1.0, "end": round(2.0005, 3), "speaker": "é"},
                        {"start": 3.0, "end": 4.0, "speaker": None}],
        "exclusive_diarization": [{"start": 0.5, "end": 1.0, "speaker": "S0"}]}
    assert got["b",]["diarization"] == got["b",]["exclusive_diarization"] == got["b",]["speakers"] == [] and got["b",]["model"] is None


def test_speakers_and_transcript_documents(spark, tmp_path):
    heads = spark.createDataFrame([("a", "a.wav", ["S0"]), ("b", "b.wav", [])], "audio_key string, audio string, speakers array<string>")
    units = spark.createDataFrame([("a", 7, 0.1, 0.2, " \"x\"\n", None, "S0"), ("a", 100007, 0.3, 0.4, " y", 0.5, "UNKNOWN")],
                                  "audio_key string, seq bigint, start double, end double, text string, probability double, speaker string")
    turns = spark.createDataFrame([("a", 0, 0.1, 0.2, "S0", '"x"', 1), ("a", 1, 0.3, 0.4, "UNKNOWN", "y", 1)],
                                  "audio_key string, turn_no bigint, start double, end double, speaker string, text string, unit_count bigint")
    got = read(spark, docs.speakers_document(heads, units, turns), ["audio_key"], f"{tmp_path}/s")
    assert got["a",] == {
        "audio": "a.wav", "speaker_scope": "local_to_audio_file", "speakers": ["S0"],
        "units": [{"start": 0.1, "end": 0.2, "text": " \"x\"\n", "probability": None, "speaker": "S0"},
                  {"start": 0.3, "end": 0.4, "text": " y", "probability": 0.5, "speaker": "UNKNOWN"}],
        "turns": [{"start": 0.1, "end": 0.2, "speaker": "S0", "text": '"x"', "unit_count": 1},
                  {"start": 0.3, "end": 0.4, "speaker": "UNKNOWN", "text": "y", "unit_count": 1}]}
    assert got["b",]["units"] == got["b",]["turns"] == []
    heads = spark.createDataFrame([("a", "a.wav", "es", 0.9, 5.0, None)], "audio_key string, audio string, language string, language_probability double, "
                                  "duration double, duration_after_vad double")
    word = "array<struct<start: double, end: double, word: string, probability: double>>"
    segments = spark.createDataFrame(
        [("a", 0, 1, 0.0, 1.0, " one\ttwo ", -0.5, None, 1.5, [(0.0, None, " one", 0.5)]), ("a", 1, 2, 1.0, 2.0, " \n", None, None, None, None),
         ("a", 2, 3, 2.0, 3.0, "three", None, None, None, None)],
        f"audio_key string, segment_pos bigint, id int, start double, end double, text string, avg_logprob double, no_speech_prob double, compression_ratio double, words {word}")
    (doc,) = read(spark, docs.transcript_document(heads, segments), ["audio_key"], f"{tmp_path}/t").values()
    assert doc["duration_after_vad"] is None and [s["id"] for s in doc["segments"]] == [1, 3] and [s["text"] for s in doc["segments"]] == ["one two", "three"]
    assert doc["segments"][0]["words"] == [{"start": 0.0, "end": None, "word": " one", "probability": 0.5}] and doc["segments"][1]["words"] == []


def test_index_document_and_numbers(spark, tmp_path):
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(f"{k % 7}/é{k}.wav", k % 3 == 0) for k in range(50)], "audio string, complete boolean")
    placed = docs.numbered(rows, "audio", cells=8)
    fragments = docs.index_document(placed, "place", model="m").withColumn("k", F.lit("i"))
    (doc,) = read(spark, fragments, ["k"], f"{tmp_path}/i").values()
    names = sorted(r.audio for r in rows.collect())
    assert [x["audio"] for x in doc["items"]] == names and (doc["audio_count"], doc["complete_count"], doc["model"]) == (50, 17, "m")
    none = docs.index_document(docs.numbered(rows.limit(0), "audio"), "place").withColumn("k", F.lit("i"))
    assert list(read(spark, none, ["k"], f"{tmp_path}/n").values()) == [{"audio_count": 0, "complete_count": 0, "items": []}]


def test_positions(spark):
    import random
    rng = random.Random(3)
    spans = [(f"a{k % 3}", 99, float(rng.randrange(50)), float(rng.randrange(50)), f"S{rng.randrange(3)}") for k in range(200)]
    got = with_positions(spark.createDataFrame(spans, SPAN), cell=7.0).collect()
    for key in ("a0", "a1", "a2"):
        mine = sorted((r.pos, r.start, r.end, r.speaker) for r in got if r.audio_key == key)
        assert [m[0] for m in mine] == list(range(len(mine))) and [m[1:] for m in mine] == sorted(s[2:] for s in spans if s[0] == key)


def test_broken_documents_have_no_fields(spark, tmp_path):
    """Wherever a document is cut, inside units or turns too, nothing of it is taken."""
    from speechlake.sources.documents import SPEAKERS_DDL, read_documents
    unit = {"start": 0.5, "end": 1.5, "text": " a", "probability": 0.5, "speaker": "S0"}
    whole = json.dumps({"audio": "b.wav", "speaker_scope": "x", "speakers": ["S0"], "units": [unit] * 2,
                        "turns": [{"start": 0.5, "end": 1.5, "speaker": "S0", "text": "a a", "unit_count": 2}]})
    for at in range(1, len(whole), 3):
        (tmp_path / f"{at}.txt").write_text(whole[:at])
    (tmp_path / "whole.txt").write_text(whole)
    got = {r.audio_key: r for r in read_documents(spark, str(tmp_path), SPEAKERS_DDL, ".txt").collect()}
    sound = got.pop("whole")
    assert sound.parse_ok and (sound.audio, sound.speaker_scope, len(sound.units), len(sound.turns)) == ("b.wav", "x", 2, 1)
    assert [k for k, r in got.items() if r.parse_ok or any(v is not None for v in r[2:])] == []
