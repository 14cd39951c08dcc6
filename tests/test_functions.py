import hashlib
import random

import pytest
from pyspark.sql import functions as F

from speechlake.functions import text as fx
from speechlake.functions.acoustics import pack_landmark, seconds_to_frames


def one(spark, value, kind, fn):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize("seconds,want", [
    (0.0, "00:00:00,000"), (0.0005, "00:00:00,000"), (0.0015, "00:00:00,002"),
    (-3.0, "00:00:00,000"), (3661.5, "01:01:01,500"), (360000.25, "100:00:00,250"),
    (59.9996, "00:01:00,000"),
])
def test_srt_golden(spark, seconds, want):
    assert one(spark, seconds, "double", fx.srt_ts) == want
    assert one(spark, seconds, "double", fx.trunc_ts) == want[:-4]
    assert one(spark, seconds, "double", fx.dot_ts) == want.replace(",", ".")


def test_srt_rounds_like_python(spark):
    rng = random.Random(3)
    values = [rng.uniform(0, 9000) for _ in range(500)] + [k / 2000 for k in range(200)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", fx.srt_ts(F.col("v")), fx.hhmmss(F.col("v"))).collect()
    for v, srt, whole in rows:
        ms = round(v * 1000)
        assert srt == "%02d:%02d:%02d,%03d" % (ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000)
        s = round(v)
        assert whole == "%02d:%02d:%02d" % (s // 3600, s // 60 % 60, s % 60)


def test_collapse_ws_is_unicode_split(spark):
    spaces = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    text = "  a" + spaces + "b​c \x1c d　"
    assert one(spark, text, "string", fx.collapse_ws) == " ".join(text.split())
    assert one(spark, spaces, "string", fx.is_blank) is True
    assert one(spark, "​", "string", fx.is_blank) is False


def test_paths(spark):
    for path in ("a/Ñandú 1.mp3", "x.tar.gz", ".hidden", "dir.d/name", "a" * 60 + ".wav"):
        import pathlib
        p = pathlib.PurePosixPath(path)
        stem = "".join(ch if ch.isalnum() else "_" for ch in p.stem)[:48]
        want = f"{stem}_{hashlib.sha1(path.encode()).hexdigest()[:12]}"
        assert one(spark, path, "string", fx.safe_uri) == want
        assert one(spark, path, "string", fx.path_suffix) == p.suffix.lower()
        assert one(spark, path, "string", fx.without_suffix) == str(p.with_suffix(""))


def test_audio_suffix(spark):
    rows = spark.createDataFrame([
        ("http://h/a.FLAC?x=.mp3", None), ("http://h/a", "audio/mpeg; q=1"), ("http://h/a.txt", "odd/type"),
    ], "u string, c string").select(fx.audio_suffix(F.col("u"), F.col("c"))).collect()
    assert [r[0] for r in rows] == [".flac", ".mp3", ".mp3"]


def test_redaction(spark):
    secret = 'secret"value'
    body = '{"error": "no secret\\"value here", "title": "t"}'
    out = one(spark, body, "string", lambda c: fx.redacted_detail(c, [secret]))
    assert "secret" not in out and out == '"no *** here"'
    assert one(spark, "", "string", fx.redacted_detail) == fx.NO_REASON
    assert one(spark, " <b> hf_abc-1 </b>\n", "string", fx.redacted_detail) == "<b> *** </b>"
    assert one(spark, '{"detail": "", "message": 0, "x": 1}', "string", fx.redacted_detail) == (
        '{"detail": "", "message": 0, "x": 1}')


def test_labels_and_numbers(spark):
    assert one(spark, "a/large-v3", "string", lambda c: fx.family_label(c, "whisper")) == "whisper-large-v3"
    assert one(spark, "a/Whisper-x", "string", lambda c: fx.family_label(c, "whisper")) == "Whisper-x"
    assert one(spark, 0.0, "double", fx.word_logprob) is None
    assert seconds_to_frames(5.0) == 78
    packed = spark.range(1).select(pack_landmark(F.lit(3), F.lit(5), F.lit(7))).first()[0]
    assert packed == (3 << 20) | (5 << 10) | 7


def test_round_exact_is_python_round(spark):
    from speechlake.functions.rounding import round_exact

    rng = random.Random(5)
    values = [k / 1000 for k in range(0, 3000, 5)] + [rng.uniform(-5000, 90000) for _ in range(800)]
    values += [69.195, 1.0005, 2.5, 0.125, 0.375, -0.125, 1e-9, 123456.0005] + [rng.randrange(10 ** 8) / 16000 for _ in range(800)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for r in df.select("v", *[round_exact(F.col("v"), d).alias(f"d{d}") for d in (1, 2, 3)]).collect():
        assert (r.d1, r.d2, r.d3) == (round(r.v, 1), round(r.v, 2), round(r.v, 3)), r.v


def test_an_error_body_is_cleaned_and_parsed_once(spark):
    bodies = [' {"detail":"","message":"a  b"}', '{"error":0,"title":"t"', '"detail"', "[1]", "", None, '\ufeff{"title":"x"}', '{"title":"","detail":null}']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string").select("i", fx.redacted_detail(F.col("body")).alias("d"))
    got = [r.d for r in sorted(df.collect())]
    assert got[:6] == ['"a b"', '{"error":0,"title":"t"', '"detail"', "[1]", "no reason was given", None] and got[7] == '""'
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("parse_json(") == 1 and plan.count("regexp_replace(") <= 3
