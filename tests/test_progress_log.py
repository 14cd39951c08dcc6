"""Progress logs as Python's csv module writes them."""

import csv

from speechlake.sources import tables


def test_log_without_sequence(spark, tmp_path):
    names = ["audio", "status", "seconds", "duration", "language", "message"]
    for part, rows in (("b.csv", [("third", "ok", "1.5", "20.0", "es", "")]),
                       ("a.csv", [("first", "ok", "2.5", "30.0", "es", 'bad "x", line\nsecond'), ("second", "error", "", "", "", "no")])):
        with open(tmp_path / part, "w", newline="", encoding="utf-8") as f:
            w = csv.DictWriter(f, names)
            w.writeheader()
            w.writerows(dict(zip(names, r)) for r in rows)
    got = tables.read_progress(spark, str(tmp_path), tables.TRANSCRIPTION_LOG_DDL).orderBy("seq").collect()
    assert [r.audio for r in got] == ["first", "second", "third"]
    assert got[0].message == 'bad "x", line\nsecond' and got[0].seconds == 2.5 and got[1].seconds is None


def test_log_with_sequence_and_other_columns(spark, tmp_path):
    (tmp_path / "x.csv").write_text("status,seq,audio,extra\nok,7,one,z\n", encoding="utf-8")
    row = tables.read_progress(spark, str(tmp_path)).collect()[0]
    assert (row.seq, row.audio, row.status, row.error) == (7, "one", "ok", None)
