"""Files in, files out."""

import json
import os

import pytest
from pyspark.sql import functions as F

from speechlake.operators import transcript_audit as ta
from speechlake.sinks import files as sink
from speechlake.sinks import published, render
from speechlake.sinks.documents import assemble, items, piece
from speechlake.sources import documents as docs
from speechlake.sources import tables as src
from speechlake.operators.checkpoints import settle
from speechlake.sources.manifest import arrival_order, read_manifest


def put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def content(folder):
    parts = sorted(p for p in os.listdir(folder) if p.startswith("part-"))
    return "".join(open(os.path.join(folder, p), encoding="utf-8").read() for p in parts)


def test_documents(spark, tmp_path):
    root = str(tmp_path / "tr x")
    seg = {"id": 0, "start": 0.0, "end": 1.0, "text": "a", "words": []}
    put(f"{root}/r1/one.json", json.dumps({"audio": "r1/one.mp3", "language": None, "duration": 2.0, "segments": [seg]}, indent=2))
    bare = {k: v for k, v in seg.items() if k != "words"}
    put(f"{root}/two.json", json.dumps({"audio": "two.mp3", "duration": 2.0, "segments": [bare]}))
    put(f"{root}/bad.json", "{nope")
    put(f"{root}/one.diarization.json", json.dumps({"audio": "one.mp3", "num_speakers": 1, "speakers": ["A"],
        "exclusive_diarization": [{"start": 0, "end": 1.5, "speaker": "A"}]}))
    put(f"{root}/one.speakers.json", json.dumps({"units": [], "turns": []}))
    t = {r.audio_key: r for r in docs.read_transcripts(spark, root).collect()}
    assert sorted(t) == ["bad", "r1/one", "two"]
    assert [t[k].parse_ok for k in ("bad", "r1/one", "two")] == [False, True, True]
    assert t["r1/one"].segments[0].words == [] and t["two"].segments[0].words is None
    d = docs.read_diarizations(spark, root).collect()
    assert [(r.audio_key, r.num_speakers, r.exclusive_diarization[0].end) for r in d] == [("one", 1, 1.5)]
    assert [r.audio_key for r in docs.read_speakers(spark, root).collect()] == ["one"]
    heads, segments, words = ta.tables_from_transcripts(docs.read_transcripts(spark, root))
    audios = heads.select("audio_key")
    none = spark.createDataFrame([], "audio_key string, suffix string")
    flags = {r.audio_key: r.flags for r in ta.audit(audios, heads, segments, words, none).collect()}
    assert flags["bad"] == ["json_parse_error"]
    assert "missing_word_timestamps" in flags["two"] and "missing_word_timestamps" not in flags["r1/one"]


def test_lists_and_reports(spark, tmp_path):
    path = str(tmp_path / "list.txt")
    put(path, "﻿a.mp3\n\n  # no\n b/c.mp3 \n/abs.mp3\n")
    listed = src.read_file_list(spark, path, "/root/x/")
    assert [r.path for r in listed.collect()] == ["/root/x/a.mp3", "/root/x/b/c.mp3", "/abs.mp3"]
    assert src.read_file_list(spark, path, comments=False).count() == 4
    have = spark.createDataFrame([("/abs.mp3",), ("/other",)], "path string")
    assert [r.path for r in src.select_listed(listed, have).collect()] == ["/abs.mp3"]
    assert src.missing_listed(listed, have).count() == 2
    path = str(tmp_path / "report.txt")
    put(path, "a [  1.0s- 12.5s]  <->  b [ 30.0s- 41.5s]  (57 hashes)\nTotal: 1\n")
    assert src.read_match_report(spark, path).first().asDict() == {
        "file_a": "a", "a_start_s": 1.0, "a_end_s": 12.5, "file_b": "b", "b_start_s": 30.0, "b_end_s": 41.5, "n_hashes": 57}
    path = str(tmp_path / "demand.csv")
    put(path, '"fecha","dia_semana","hora_inicio","hora_fin","escuchas_simultaneas_maximas","zona_horaria"\n'
              '"2026-01-05","Lunes","23:00","24:00","7","America/Lima"\n', "utf-8-sig")
    row = src.read_demand(spark, path).first()
    assert (str(row.fecha), row.hora, row.hora_fin, row.escuchas) == ("2026-01-05", 23, 24, 7)


def test_manifest_order(spark, tmp_path):
    path = str(tmp_path / "manifest.json")
    put(path, json.dumps([{"id": "b", "started_at": "2026-01-02T00:00"}, {"id": "a", "started_at": "2026-01-02T00:00"},
                          {"id": "z", "started_at": "2026-01-01T09:00"}]))
    names = spark.createDataFrame([("a",), ("b",), ("q",), ("z",)], "item string")
    order = lambda m: [r.item for r in arrival_order(names, m).orderBy("arrival").collect()]
    assert order(read_manifest(spark, path)) == ["q", "z", "a", "b"]
    assert order(None) == ["a", "b", "q", "z"]


def test_speaker_map(spark, tmp_path):
    put(str(tmp_path / "x.speaker-map.json"), json.dumps({
        "assignments": [{"speaker": "S0", "canonical_name": "N"}, {"speaker": "S1", "display_name": "D"}],
        "quality_notes": [{"observed": "S0", "expected": "S1", "start": 1, "end": 2.5}]}), "utf-8-sig")
    names, notes = src.read_speaker_maps(spark, str(tmp_path))
    assert [(r.audio_key, r.pos, r.speaker) for r in names.orderBy("pos").collect()] == [("x", 0, "S0"), ("x", 1, "S1")]
    assert notes.first().end == 2.5


def test_written_files(spark, tmp_path):
    turns = spark.createDataFrame(
        [(k, n, float(n), n + 1.0, "A", f"t{n}", 1) for k in ("a", "b") for n in range(30)],
        "audio_key string, turn_no bigint, start double, end double, speaker string, text string, unit_count bigint")
    lines = render.turn_lines(turns)
    sink.write_lines(lines, str(tmp_path / "srt"), "srt")
    text = content(str(tmp_path / "srt" / "audio_key=a"))
    assert text.startswith("1\n00:00:00,000 --> 00:00:01,000\n[A] t0\n\n2\n") and text.endswith("[A] t29\n")
    keys = ["audio_key"]
    heads = turns.select(*keys).distinct()
    doc = assemble(piece(heads, keys, 0, F.lit("[")), items(turns, keys, 1, "turn_no", F.to_json(F.struct("text"))),
                   piece(heads, keys, 2, F.lit("]")))
    sink.write_fragments(doc, str(tmp_path / "doc"))
    assert [x["text"] for x in json.loads(content(str(tmp_path / "doc" / "audio_key=b")))] == [f"t{n}" for n in range(30)]


def test_audit_files_and_clip_tables(spark, tmp_path):
    rows = spark.createDataFrame([("a", 3, 2, 0.5, ["x", "y"]), ("b", 0, 0, None, ["z"])],
                                 "audio_key string, segments bigint, words bigint, mean_word_probability double, flags array<string>")
    report = [r.value for r in sink.audit_report_lines(ta.flagged_report(rows)).collect()]
    assert report == ["| b | 0 | 0 | — | z |", "| a | 3 | 2 | 50.0% | x, y |"]
    picked = spark.createDataFrame([("empty", "a")], "list string, audio_key string")
    sink.write_audit(rows, rows.groupBy().count(), picked, str(tmp_path / "audit"))
    assert content(str(tmp_path / "audit" / "candidates" / "list=empty")) == "a\n"
    marks = spark.createDataFrame([(1, 5, 0), (1, 6, 1)], "jingle_id int, hash bigint, t int")
    sink.save_clips(spark.createDataFrame([(1, "f")], "jingle_id int, file_id string"), marks, "known", 4)
    clips, saved = sink.load_clips(spark, "known")
    assert clips.count() == 1 and saved.count() == 2
    spark.sql("DROP TABLE known_clips")
    spark.sql("DROP TABLE known_landmarks")


def test_arrivals_spread_over_parts(spark, monkeypatch):
    """Times of every recording, of some and of none: numbers are dense and in order, and no part holds most of the rows."""
    from speechlake.operators import blocks

    written = []
    monkeypatch.setattr(blocks, "settle", lambda df: written.append(settle(df)) or written[-1])
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        for share in (0, 3, 100):
            rows = [(f"item{k:05d}", f"2026-01-0{k % 3 + 1}T00:00:{k % 60:02d}" if k % 100 < share else "") for k in range(4000)]
            df = spark.createDataFrame(rows[::-1], "item string, started_at string").repartition(5)
            got = blocks.number_all(df, ["started_at", "item"], "n").orderBy("n").collect()
            assert [(r.item, r.started_at) for r in got] == sorted(rows, key=lambda r: (r[1], r[0]))
            assert [r.n for r in got] == list(range(1, 4001))
            sizes = [r["count"] for r in written[-1].groupBy(blocks.BLOCK).count().collect()]
            assert len(sizes) > 1 and max(sizes) < 2 * 4000 / len(sizes)
    finally:
        spark.conf.set(name, before)


def test_published_versions(spark, tmp_path):
    root = str(tmp_path / "result")
    with pytest.raises(FileNotFoundError):
        published.current(spark, root)
    for n in (3, 5):
        published.publish_table(spark.range(n), root)
    reader = published.read_published(spark, root)

    def fails(folder):
        spark.range(2).write.parquet(folder)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        published.publish(spark, root, fails)
    assert published.read_published(spark, root).count() == 5
    assert len([f for f in os.listdir(root) if f.startswith("version-")]) == 2
    # A claim of a writer that died, and a newer version while a reader holds the one before.
    open(f"{root}/_published/claim-{3:012d}", "w").close()
    published.publish_table(spark.range(7), root)
    assert published.read_published(spark, root).count() == 7 and reader.count() == 5
    assert [n for n, _ in published.versions(spark, root)] == [2, 4]


def test_audit_report(spark, tmp_path):
    rows = spark.createDataFrame([("a", 3, 2, 0.5, ["x", "y"]), ("b", 0, 0, None, ["z"]), ("c", 1, 1, 0.9, [])],
                                 "audio_key string, segments bigint, words bigint, mean_word_probability double, flags array<string>")
    summary = spark.createDataFrame(
        [(3, 2, 1, 0, 8, None, 0.03125, 0.5, 4, 1, 2.125)],
        "audio_files bigint, json_files bigint, txt_files bigint, srt_files bigint, total_scored_words bigint, mean_word_probability double, "
        "words_below_0_5_rate double, words_below_0_3_rate double, segment_overlap_events bigint, files_with_segment_overlaps bigint, "
        "max_segment_overlap_seconds double")
    report = sink.audit_report(rows, summary)
    picked = spark.createDataFrame([("empty", "a")], "list string, audio_key string")
    sink.write_audit(rows, summary, picked, str(tmp_path / "audit"), report)
    lines = content(str(tmp_path / "audit" / "report")).split("\n")
    assert lines[2:9] == ["- Audios: 3", "- JSON/TXT/SRT: 2/1/0", "- Palabras evaluadas: 8", "- Confianza media: 0.00%",
                          "- Palabras con confianza menor a 50%: 3.12%", "- Palabras con confianza menor a 30%: 50.00%",
                          "- Solapamientos breves entre bloques: 4 en 1 archivos; máximo 2.12 s"]
    assert lines[-3:] == ["| b | 0 | 0 | — | z |", "| a | 3 | 2 | 50.0% | x, y |", ""]
