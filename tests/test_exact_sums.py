"""Sums and means that decide something do not depend on how floating point numbers add up."""

from speechlake.operators import speaker_audit as sa
from speechlake.operators import transcript_audit as ta


def test_turns_of_one_second_on_average_are_no_scraps(spark):
    starts = [s / 10 for s in range(1000) if (s + 10) / 10 - s / 10 < 1][:12]
    rows = [("a", "S0", s, round(s + 1, 1)) for s in starts] + [("a", "S1", s, round(s + 0.9, 1)) for s in starts]
    turns = spark.createDataFrame(rows, "audio_key string, speaker string, start double, end double")
    assert [tuple(r) for r in sa.fragmented_speakers(turns).collect()] == [("a", "S1")]


def test_mean_seconds_in_whole_tenths(spark):
    def mean(seconds):
        rows = spark.createDataFrame([("a", [], s) for s in seconds], "audio_key string, warnings array<string>, processing_seconds double")
        keys = rows.select("audio_key").distinct()
        return sa.speaker_summary(rows, keys, spark.createDataFrame([], "audio_key string, status string")).first().mean_seconds_per_file

    assert mean([0.35]) == 0.3  # its binary value lies below the tie
    assert mean([0.1, 0.2]) == 0.2 and mean([0.2, 0.3]) == 0.2 and mean([0.1] * 7) == 0.1  # ties to even
    assert mean([None]) == 0.0 and mean([1.0, None]) == 1.0


def test_mean_probability_of_equal_words(spark):
    words = spark.createDataFrame([("a", 0.1)] * 10 + [("b", None)], "audio_key string, probability double").coalesce(1)
    got = {r.audio_key: r.mean_word_probability for r in ta.word_statistics(words, exact=True).collect()}
    assert got == {"a": 0.1, "b": None}
