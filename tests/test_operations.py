"""Capacity, offers, windows, idle detection and checks against small models."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechlake.operators import capacity as cap
from speechlake.operators import hygiene, idle, offers, windows
from speechlake.operators import progress as pg


def demand(spark, values):
    rows = [(f"2026-01-{1 + i // 24:02d}", i % 24, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "fecha string, hora int, escuchas int")


def test_capacity(spark):
    rng = random.Random(1)
    values = [rng.choice([0, 0, 5, 50, 140]) for _ in range(72)]
    d = demand(spark, values)
    machines = [-(-v // 48) for v in values]
    starts = sum(max(0, b - a) for a, b in zip([0, *machines], machines))
    s = d.withColumn("machines", cap.machines_needed(F.col("escuchas")))
    cost = cap.schedule_cost(s).first()
    assert (cost.machine_hours, cost.starts) == (sum(machines), starts)
    assert cost.cost == pytest.approx(0.21 * (sum(machines) + 0.25 * starts))
    waiting, want = 0.0, []
    for v in values:
        waiting = max(0.0, waiting + v - 48)
        want.append(waiting)
    got = [r.backlog for r in cap.fixed_fleet(d, 48.0).orderBy("fecha", "hora").collect()]
    assert got == want
    flat = [m for r in cap.schedule_ranges(s).orderBy("fecha", "from_hour").collect()
            for m in [r.machines] * (r.to_hour - r.from_hour)]
    assert flat == machines
    day = cap.day_profile(d).orderBy("fecha").first()
    active = [h for h in range(24) if values[h] > 0]
    assert (day.total, day.peak, day.first_hour, day.last_hour) == (
        sum(values[:24]), max(values[:24]), active[0], active[-1])
    assert day.peak_hour == values.index(max(values[:24]))
    need = d.select(cap.machines_needed(F.lit(10), F.lit(87.0), 1.0).alias("n")).first().n
    assert need == 3


def test_offers_prefer_model_over_price(spark):
    rows = [(1, 10, "B", 0.1), (2, 11, "A", 0.3), (3, 12, "A", 0.2), (4, 13, "C", 0.0), (5, 14, "A", None)]
    df = spark.createDataFrame(rows, "id bigint, machine_id bigint, gpu_name string, dph_total double")
    assert [r.id for r in offers.rank_offers(df, ["A", "B"]).collect()] == [5, 3, 2, 1]
    assert [r.id for r in offers.rank_offers(df, ["A", "B"], [14, 12], top=1).collect()] == [2]


def test_windows(spark):
    lengths = [0.0, 0.5, 10.0, 10.01, 15.0, 29.999, 30.0, 30.001, 61.5]
    df = spark.createDataFrame([(v,) for v in lengths], "d double")
    tiles, slides = {}, {}
    for v in lengths:
        tiles[v] = [(s, min(s + 30.0, v)) for s in np.arange(0, v, 30.0)] if v else []
        out, s = [], 0.0
        while s < v:
            out.append((round(s, 2), round(min(s + 10, v), 2)))
            if s + 10 >= v:
                break
            s += 5
        slides[v] = out
    for fn, want in ((windows.tile_clips, tiles), (windows.sliding_windows, slides)):
        got = {v: [] for v in lengths}
        for r in fn(df, "d").orderBy("d", "start").collect():
            got[r.d].append((r.start, r.end))
        assert got == want


def test_scorer(spark):
    labels = {0: "noise", 1: "MUSIC", 2: "speech", 3: "Singing"}
    df = spark.createDataFrame([("a", [0.0, 9.0, -9.0, 9.0]), ("b", [0.0, 0.0, 1.0, 2.0])], "audio string, x array<double>")
    got = {r.audio: r for r in windows.score_windows(df, "x", lambda: lambda xs: list(xs), labels).collect()}
    assert got["b"].p_music == 0.5 and got["b"].p_speech == 0.7311 and got["b"].p_singing == 0.8808
    scores = spark.createDataFrame([(r.audio, 0.0, r.p_speech, r.p_music, r.p_singing) for r in got.values()],
                                   "audio string, start double, p_speech double, p_music double, p_singing double")
    assert [r.audio for r in windows.drop_candidates(scores).collect()] == ["a"]
    with pytest.raises(ValueError):
        windows.label_positions({0: "speech"})


def idle_model(polls, gap, limit):
    since = last = None
    out = []
    for now, empty in polls:
        if empty:
            since = since if last is not None and last <= now <= last + gap else now
            last = now
        else:
            since = last = None
        out.append((since, since is not None and now - since >= limit))
    return out


@pytest.mark.parametrize("block_rows", [1, 4, 1000])
def test_idle(spark, block_rows):
    rng = random.Random(6)
    steady = [(t, True) for t in range(0, 601, 30)] + [(630, False), (660, True), (690, True)]
    jump = [(0, True), (900, True), (-1, True)]
    noise, t = [], 0
    for _ in range(150):
        t += rng.choice([30, 30, 60, 90, 91, -5])
        noise.append((t, rng.random() < 0.85))
    polls = {1: steady, 2: jump, 3: noise}
    rows = [(k, i, t, e) for k, ps in polls.items() for i, (t, e) in enumerate(ps)]
    df = spark.createDataFrame(rows, "source bigint, seq bigint, poll_ts bigint, empty boolean")
    got = idle.idle_windows(df, gap=idle.max_gap(30), idle_seconds=600, block_rows=block_rows)
    by = {(r.source, r.seq): (r.since, r.fires) for r in got.collect()}
    for k, ps in polls.items():
        assert [by[k, i] for i in range(len(ps))] == idle_model(ps, 90, 600)
    assert [i for i in range(len(steady)) if by[1, i][1]] == [20]


def test_polls(spark):
    ok = '{"capabilities": ["a", "b"], "available_jobs": 0, "active_leases": 0, "next_available_at": null}'
    cases = {
        ok: (True, True), ok.replace('"available_jobs": 0', '"available_jobs": 1'): (True, False),
        ok.replace('null', '"2026-10-29T15:00:00Z"'): (True, False),
        ok.replace('"available_jobs": 0', '"available_jobs": false'): (False, False),
        ok.replace('"available_jobs": 0', '"available_jobs": "0"'): (False, False),
        ok.replace('"active_leases": 0', '"active_leases": -1'): (False, False),
        ok.replace('["a", "b"]', '["a"]'): (False, False), ok.replace('["a", "b"]', '["b", "a", "a"]'): (True, True),
        ok.replace(', "next_available_at": null', ''): (False, False), "[]": (False, False), "{": (False, False),
    }
    df = spark.createDataFrame([(k,) for k in cases], "status string")
    assert {r.status: (r.valid, r.empty) for r in idle.parse_polls(df, ["b", "a"]).collect()} == cases


def test_policy(spark):
    df = spark.createDataFrame([("a.py",), ("audios/x/y.MP3",), ("b/modelos/z.txt",), ("audios/q.txt",)], "path string")
    got = {(r.finding, r.path) for r in hygiene.policy_findings(df, ["a.py", "README.md"]).collect()}
    assert got == {("missing", "README.md"), ("forbidden file", "audios/x/y.MP3"), ("forbidden folder", "audios"),
                   ("forbidden folder", "b/modelos")}
    texts = spark.createDataFrame([("p", "x hf_" + "a1" * 10), ("q", "hf_short")], "path string, text string")
    assert [r.path for r in hygiene.leak_findings(texts, "path", "text").collect()] == ["p"]


def test_progress(spark):
    log = spark.createDataFrame([("a", 1, "error"), ("a", 2, "ok"), ("b", 3, "ok"), ("b", 9, "error")],
                                "audio_key string, seq bigint, status string")
    latest = pg.latest_per_audio(log)
    assert {r.audio_key: r.status for r in latest.collect()} == {"a": "ok", "b": "error"}
    inputs = spark.createDataFrame([("a",), ("b",), ("c",)], "audio_key string")
    files = spark.createDataFrame([("a", ".json"), ("b", ".json")], "audio_key string, suffix string")
    left = lambda **k: sorted(r.audio_key for r in pg.pending(inputs, files, "transcription", **k).collect())
    assert left(latest=latest) == ["b", "c"] and left() == ["c"] and left(force=True) == ["a", "b", "c"]
    clash = spark.createDataFrame([("k", "k.mp3"), ("k", "k.wav"), ("m", "m.mp3")], "audio_key string, path string")
    assert sorted(r.path for r in pg.output_collisions(clash, "audio_key", "path").collect()) == ["k.mp3", "k.wav"]
