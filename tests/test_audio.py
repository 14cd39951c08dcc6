"""From WAV files to matches: spectra, peaks, landmarks, clips."""

import os
import wave

import numpy as np
import pytest

from speechlake.operators import landmarks as lm
from speechlake.operators import matching
from speechlake.sources import audio

CHUNK = 8 * 512


def tune(seed, seconds):
    """Short tone bursts at random pitches over faint noise."""
    rng = np.random.default_rng(seed)
    n = int(seconds * 8000)
    x = rng.normal(0, 0.002, n)
    at = 0
    while at < n:
        length = int(rng.integers(400, 1600))
        t = np.arange(min(length, n - at)) / 8000
        x[at:at + len(t)] += 0.3 * np.sin(2 * np.pi * rng.integers(200, 3600) * t) * np.hanning(len(t))
        at += length
    return x


def wav(path, x, channels=1):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with wave.open(path, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes((np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("rec"))
    jingle = tune(100, 12)
    wav(f"{root}/one.wav", np.concatenate([tune(1, 5), jingle, tune(2, 7)]))
    wav(f"{root}/sub/two.WAV", np.concatenate([tune(3, 9), jingle, tune(4, 3)]))
    wav(f"{root}/tiny.wav", tune(5, 0.1))
    wav(f"{root}/stereo.wav", np.zeros(100), channels=2)
    with open(f"{root}/broken.wav", "wb") as f:
        f.write(b"RIFF nothing")
    with open(f"{root}/note.txt", "w") as f:
        f.write("x")
    return root


@pytest.fixture(scope="module")
def pcm(spark, folder):
    return audio.good_chunks(audio.read_wav(spark, folder, CHUNK)).persist()


def samples_of(pcm):
    whole = {}
    for r in pcm.orderBy("item_id", "chunk_no").collect():
        whole.setdefault(r.item_id, []).extend(r.samples)
    return {k: np.asarray(v) for k, v in whole.items()}


def name(path):
    return os.path.basename(path)


def test_listing_and_quarantine(spark, folder):
    found = audio.list_audio(spark, folder, require=True).collect()
    assert [r.relative for r in found] == ["broken.wav", "one.wav", "stereo.wav", "sub/two.WAV", "tiny.wav"]
    assert found[3].audio_key == "sub/two" and found[3].suffix == ".wav"
    bad = audio.quarantine(audio.read_wav(spark, folder, CHUNK)).collect()
    assert sorted(name(r.item_id) for r in bad) == ["broken.wav", "stereo.wav"]
    with pytest.raises(ValueError):
        audio.list_audio(spark, f"{folder}/note.txt", require=True)


def spectrum_of(x):
    count = max(0, 1 + (len(x) - 1024) // 512)
    frames = [x[k * 512:k * 512 + 1024] * np.hanning(1024) for k in range(count)]
    return np.array([20 * np.log10(np.abs(np.fft.rfft(f)) + 1e-6) for f in frames])


def peaks_of(spec):
    level = np.percentile(spec, 75)
    out = set()
    for t, f in np.argwhere(spec > level):
        near = spec[max(0, t - 10):t + 10, max(0, f - 5):f + 5]
        if spec[t, f] == near.max():
            out.add((int(t), int(f)))
    return out


def marks_of(peaks):
    out = []
    for t, f in peaks:
        later = sorted((u, g) for u, g in peaks if 1 <= u - t <= 200)[:5]
        out += [((f << 20) + (g << 10) + (u - t), t) for u, g in later]
    return sorted(out)


def test_spectrum_peaks_and_landmarks(spark, pcm):
    whole = samples_of(pcm)
    spectra = {}
    spec = lm.spectrogram(pcm, CHUNK)
    for r in spec.collect():
        spectra.setdefault(r.item_id, {})[r.frame] = r.db
    for item, x in whole.items():
        want = spectrum_of(x.astype(float))
        got = spectra.get(item, {})
        assert sorted(got) == list(range(len(want)))
        for t in got:
            np.testing.assert_allclose(got[t], want[t], atol=1e-9)
    found = {}
    for r in lm.find_peaks(spec, block=16).collect():
        found.setdefault(r.item_id, set()).add((r.t, r.f))
    marks = {}
    for r in lm.audio_landmarks(pcm, CHUNK).collect():
        marks.setdefault(r.item, []).append((r.hash, r.t))
    for item, rows in spectra.items():
        grid = np.array([rows[t] for t in sorted(rows)])
        assert found[item] == peaks_of(grid)
        assert sorted(marks[item]) == marks_of(found[item])


def test_repeated_passage_and_clip_search(spark, pcm):
    marks = lm.audio_landmarks(pcm, CHUNK).persist()
    best = matching.strongest_first(matching.with_seconds(matching.corpus_matches(marks))).first()
    assert {name(best.file_a), name(best.file_b)} == {"one.wav", "two.WAV"}
    starts = {name(best.file_a): best.a_start_s, name(best.file_b): best.b_start_s}
    assert abs(starts["one.wav"] - 5) < 1 and abs(starts["two.WAV"] - 9) < 1
    item = next(r.item_id for r in pcm.select("item_id").distinct().collect() if name(r.item_id) == "one.wav")
    clips = spark.createDataFrame([("jingle", item, 5.0, 17.0)], "clip string, item_id string, start_s double, end_s double")
    x = samples_of(pcm)[item][40000:136000].astype(float)
    known = lm.clip_landmarks(pcm, clips, CHUNK).persist()
    assert sorted((r.hash, r.t) for r in known.collect()) == marks_of(peaks_of(spectrum_of(x)))
    hits = matching.search_clips(marks, known).collect()
    assert {name(r.capture) for r in hits} == {"one.wav", "two.WAV"}


