"""The ten operators and the pipeline: brute force on small tables, and odd rows."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from speechlake.llm import decontaminate, language, licenses, lines, mixing, pages, pii, simhash, substrings, vectors

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start string, `_h` string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty and blank texts, null ids and labels, repeated rows, copies, one long text, clashing columns."""
    rng = np.random.default_rng(1)
    base, long_text = prose(rng, 60), prose(rng, 6000)
    edited = base.split()
    edited[30] = "other"
    texts = [(1, base), (2, base), (2, base), (3, " ".join(edited)), (4, None), (5, ""), (6, " \t\n "), (None, prose(rng, 40)),
             (7, long_text), (8, "x"), (9, prose(rng, 80)), (10, prose(rng, 30) + " " + base + " tail"), (11, "é\n" + prose(rng, 30))]
    rows = [(i, t, None if i == 8 else "aa", None if i in (4, 9) else "s" + str((i or 0) % 2), len(t or ""), "clash", "clash") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "One two THREE four five six seven eight nine ten eleven"), (2, "short item"), (3, None), (4, "")],
                                 "item_id long, text string")


def test_mix(spark, odd, empty):
    rows = mixing.mix_sources(odd, block=4, shard=200).collect()
    assert len(rows) == odd.count() and mixing.mix_sources(empty).count() == 0
    assert all(r.taken <= 3 * r.size and r.taken >= 0 for r in rows)
    assert sum({(r.source, r.target) for r in rows} and [t for _, t in {(r.source, r.target) for r in rows}]) == pytest.approx(
        sum(r.size for r in rows))
    for source, target in {(r.source, r.target) for r in rows}:
        assert abs(sum(r.taken for r in rows if r.source == source) - target) <= 40
    again = mixing.mix_sources(odd.repartition(5), block=4, shard=200).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_targets_are_capped_and_shared_anew(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 400), (None, 5)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.capped_targets(sizes, (5, 2, 1)).collect()}
    assert got["a"] == 30 and got[None] == 15  # weights 5 and, once more, 5
    assert got["b"] + got["c"] == pytest.approx(1415 - 45) and got["b"] == pytest.approx(2 * got["c"])


def test_seats_are_those_of_the_highest_quotients(spark):
    rng = np.random.default_rng(3)
    for seats in (0, 1, 7, 100):
        votes = {f"p{k:02d}": int(v) for k, v in enumerate(rng.integers(0, 500, 12))}
        df = spark.createDataFrame(list(votes.items()), "p string, votes long")
        got = {r.p: r.seats for r in mixing.apportion(df, [], "votes", F.lit(seats), "seats", ["p"]).collect()}
        quotients = sorted(((-v / (2 * k - 1), p) for p, v in votes.items() if v for k in range(1, seats + 1)))[:seats]
        assert got == {p: Counter(x for _, x in quotients).get(p, 0) for p in votes}


def test_fingerprints_and_components(odd, empty):
    rows = simhash.fingerprint_components(odd).collect()
    assert len(rows) == odd.count() and simhash.fingerprint_components(empty).count() == 0
    by = {r.doc_id: r for r in rows}
    for r in odd.collect():
        words = WORD.findall((r.text or ""))
        grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        counts = np.array([[h >> b & 1 for b in range(64)] for h in (xxhash.xxh64_intdigest(g, 42) for g in grams)]).reshape(-1, 64).sum(0)
        value = sum(1 << b for b in range(64) if counts[b] * 2 > len(grams))
        assert by[r.doc_id].fingerprint == f"{value:016x}"
    assert by[1].component_id == by[2].component_id == 1 and {by[k].component_id for k in (4, 5, 6)} == {4}


def test_links_match_brute_force(spark):
    rng = np.random.default_rng(5)
    values = [0, 2**63, 2**64 - 1]
    for _ in range(60):
        v = int(rng.integers(0, 2**63))
        values.append(v)
        for _ in range(3):
            for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
                v ^= 1 << int(b)
            values.append(v)
    values = sorted(set(values))
    x = np.array(values, np.uint64)[:, None]
    want = {(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 4}
    group = np.zeros(len(values), int)
    for found in (simhash.links_within(x, group, 4), simhash._by_shift(x[:30], group[:30], np.arange(30), 4)):
        got = {(int(j), int(i)): d for a, b, ds in found for i, j, d in zip(a, b, ds)}
        assert all((values[j] ^ values[i]).bit_count() == d for (j, i), d in got.items())
        assert set(got) == {p for p in want if max(p) < 30} if len(got) < len(want) else set(got) == want
    fps = spark.createDataFrame([([v - 2**64 if v >> 63 else v],) for v in values], "fp array<long>")
    links = simhash.fingerprint_links(fps, simhash.block_masks(), 1, 4).collect()
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for r in links:
        a, b = root(r.src[0] % 2**64), root(r.dst[0] % 2**64)
        parent[max(a, b)] = min(a, b)
    plain = {v: v for v in values}
    for _ in values:
        for a, b in want:
            plain[values[a]] = plain[values[b]] = min(plain[values[a]], plain[values[b]])
    assert len({root(v) for v in values}) == len(set(plain.values()))


def test_split_buckets_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)
    fps = spark.createDataFrame([([k],) for k in range(200)], "fp array<long>")
    links = simhash.contracted(simhash.fingerprint_links(fps, simhash.block_masks(), 1, 4).select(
        F.col("src")[0].alias("src"), F.col("dst")[0].alias("dst")))
    found = simhash.connected_components(links).collect()
    assert len(found) == 200 and {r.component for r in found} == {0}


def test_one_text_that_all_others_resemble(spark):
    """Partners are gathered by the end that named them: the common model of many texts gathers few."""
    rng = np.random.default_rng(8)
    bits = rng.integers(0, 2, 256).astype(bool)
    made = [bits] + [bits ^ np.isin(np.arange(256), rng.choice(256, 20, replace=False)) for _ in range(120)]
    values = [np.packbits(b, bitorder="little").view(np.int64).tolist() for b in made]
    fps = spark.createDataFrame([(v,) for v in values], "fp array<long>")
    links = simhash.fingerprint_links(fps, simhash.sample_masks(4, 24, 8), 4, 10, 30).cache()
    named = [r["count"] for r in links.groupBy("dst").count().collect()]
    assert max(named) <= 3 * 24
    found = simhash.connected_components(simhash.contracted(links.select(
        simhash.hexadecimal(F.col("src")).alias("src"), simhash.hexadecimal(F.col("dst")).alias("dst")))).collect()
    assert len(found) == len(values) and len({r.component for r in found}) == 1


def test_sources_without_words_are_dealt_to_shards(spark):
    docs = spark.createDataFrame([(k, None if k % 2 else "a b c", "x" if k % 2 else "y") for k in range(60)],
                                 "doc_id long, text string, source string")
    rows = mixing.mix_sources(docs, block=4, shard=10).collect()
    assert len(rows) == 60 and all(r.taken == r.target == 0 for r in rows if r.source == "x")
    assert sum(r.taken for r in rows) == pytest.approx(90, abs=12)


def test_near_copies_go_and_others_stay(odd, empty):
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns and simhash.drop_near_copies(empty).count() == 0
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([1, 4, None, 7, 8, 9, 10, 11])  # 2 and 3 are copies of 1; 5 and 6 have no words, like 4


def test_language(odd, empty, spark):
    rng = np.random.default_rng(2)
    made = [(k, " ".join("".join(rng.choice(list(("abcd", "wxyz")[k % 2]), 4)) for _ in range(30)), ("aa", "zz")[k % 2]) for k in range(120)]
    labelled = spark.createDataFrame([*made, (500, None, "aa"), (501, "abc", None), (None, "abcd", "aa")], "doc_id long, text string, lang string")
    model = language.train(labelled, per_language=40)
    assert model.languages == ["aa", "zz"]
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in language.predict(labelled, model).collect()}
    assert np.mean([got[k][0] == want for k, _, want in made]) > 0.98 and got[500] == ("und", 0.0)
    assert all(0 <= s <= 1 for _, s in got.values())
    marks = {r.doc_id: r.lang_pred for r in language.predict(odd, model).collect()}
    assert marks[4] == marks[5] == marks[6] == "und" and marks[8] in ("aa", "zz")
    assert language.keep_recognised(odd, model).columns == odd.columns
    assert language.train(empty) is None and language.predict(odd, None).where("lang_pred <> 'und'").count() == 0
    assert language.keep_recognised(empty, None).count() == 0


def test_long_text_is_read_in_steps(monkeypatch):
    text = "Ab ça " * 50
    whole = np.sort(np.concatenate(list(language.subwords(text))))
    monkeypatch.setattr(language, "STEP", 37)
    assert abs(len(np.concatenate(list(language.subwords(text)))) - len(whole)) < 0.3 * len(whole)


def test_decontamination(spark, bench, odd, empty):
    docs = spark.createDataFrame(
        [(1, "x one, two three FOUR five six seven eight nine ten eleven y"), (1, "x one, two three FOUR five six seven eight nine ten eleven y"),
         (2, "one two three four five six seven eight nine"), (3, "a Short item here, SHORT item"), (None, "short ITEM"), (4, None), (5, "")],
        "doc_id long, text string")
    rows = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in decontaminate.document_hits(docs, bench).collect())
    assert rows == sorted([("1", 13, 11, ["1"]), ("1", 13, 11, ["1"]), ("2", 9, 0, []), ("3", 6, 4, ["2"]), ("None", 2, 2, ["2"]),
                           ("4", 0, 0, []), ("5", 0, 0, [])])
    clean = {r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()}
    assert clean == {2, 4, 5}
    assert {r.doc_id for r in decontaminate.decontaminate(docs, bench, least=5).collect()} == {2, 3, 4, 5, None}
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, mode="spans").collect()}
    assert cut[1] == "x y" and cut[3] == "a here, " and cut[4] is None and cut[2].startswith("one")
    assert decontaminate.decontaminate(odd, bench).columns == odd.columns
    assert decontaminate.decontaminate(odd, bench.limit(0)).count() == odd.count()
    assert decontaminate.document_hits(empty, bench).count() == 0
    sliced = decontaminate.find_hits(docs, decontaminate.benchmark_windows(bench), slice_size=1)
    assert sliced.count() == decontaminate.find_hits(docs, decontaminate.benchmark_windows(bench)).count()


def plain_substrings(rows, window):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = {}, []
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            key = tuple(words[at:at + window])
            if key in seen:
                gone[at:at + window] = [True] * window
            seen.setdefault(key, (i, at))
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def test_substrings_match_brute_force(spark, odd, empty):
    rng = np.random.default_rng(7)
    vocabulary = ["a", "b", "c", "dd", "é"]
    passage = [list(rng.choice(vocabulary, 40)) for _ in range(4)]
    texts = []
    for k in range(40):
        words = []
        for _ in range(int(rng.integers(0, 4))):
            p = passage[int(rng.integers(4))]
            begin = int(rng.integers(0, 15))
            words += [*rng.choice(vocabulary, int(rng.integers(0, 9))), *p[begin:begin + int(rng.integers(10, 40))]]
        texts.append((k, "  ".join(words) + " \n"))
    texts += [(100, "z " * 90), (101, None), (102, "")]
    got = substrings.remove_repeated(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == sorted(plain_substrings(texts, 20))
    once = {r.doc_id: r.n_removed for r in substrings.remove_repeated(odd).collect()}
    assert once[1] == 0 and once[2] == 60 and once[10] == 60 and once[4] == 0
    assert substrings.remove_repeated(empty).count() == 0


def test_lines(spark, odd, empty):
    rng = np.random.default_rng(4)
    shared = [prose(rng, 4) for _ in range(12)]
    docs = spark.createDataFrame(
        [(k, "\n".join([prose(rng, 3) for _ in range(k % 3)] + shared + [prose(rng, 3) for _ in range(2)]), 7) for k in range(9)]
        + [(20, None, 7), (21, "", 7), (22, "\n\n\n\n", 7), (23, "\n".join(shared), 7), (23, "\n".join(shared), 7)],
        "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in lines.dedup_lines(docs, counts=True).collect()}
    whole = {r.doc_id: r for r in docs.collect()}
    assert got[0].text == whole[0].text and got[0].n_removed == 0
    for k in range(1, 9):
        left = got[k].text.split("\n")
        assert got[k].n_removed >= 4 and len(left) == got[k].n_lines - got[k].n_removed and got[k].n_chars == len(got[k].text)
        own = [x for x in whole[k].text.split("\n") if x not in shared]
        assert [x for x in left if x not in shared] == own  # no line that stands once is lost
    assert got[20].text is None and got[21].text == "" and got[22].text == "\n\n\n\n" and got[20].n_lines == 0
    assert lines.dedup_lines(odd).columns == odd.columns and lines.dedup_lines(odd).count() == odd.count()
    assert lines.dedup_lines(empty).count() == 0


def test_repeated_line_runs_match_brute_force(spark):
    """Passages of 2 to 5 lines between foreign lines, in other documents and in the same one, and runs of one line."""
    rng = np.random.default_rng(31)
    passages = [[prose(rng, 3) for _ in range(2 + k % 4)] for k in range(12)]
    made = {}
    for k in range(60):
        body = []
        for p in rng.choice(12, 3):
            body += [prose(rng, 3) for _ in range(rng.integers(1, 3))] + passages[p]
        made[k] = "\n".join(body + [prose(rng, 2)] + (["same line"] * (k % 6) if k < 12 else []))
    first, kept = {}, {}
    for k, text in made.items():
        held, gone = text.split("\n"), set()
        for i in range(len(held) - 1):
            doc, at = first.setdefault((held[i], held[i + 1]), (k, i))
            if doc != k or i >= at + 2:
                gone |= {i, i + 1}
        kept[k] = "\n".join(x for i, x in enumerate(held) if i not in gone)
    docs = spark.createDataFrame(list(made.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in lines.dedup_lines(docs, counts=True).collect()}
    assert {k: r.text for k, r in got.items()} == kept
    assert all(r.n_removed == r.n_lines - (len(r.text.split("\n")) if r.text else 0) for r in got.values())


def test_pii(spark, odd, empty):
    text = ("mail a.b@c.de, x@y IP 10.0.0.1.2.3.4.5 300.1.1.1 card 4111 1111 1111 1111 or 4111111111111112 "
            "tel +49 (30) 1234567- IBAN DE89 3704 0044 0532 0130 00 GB00WEST12345698765432 ssn 123-45-6789 and 123-45-6780" + " é" * 60 + " 987-65-4321")
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "1@2.3 " * 3000)], "doc_id long, text string")
    got = {r.doc_id: r.pii for r in pii.find_pii(docs).collect()}
    said = [(p.kind, text[p.start:p.end]) for p in got[1]]
    assert said == [("email", "a.b@c.de"), ("ip", "10.0.0.1"), ("ip", "2.3.4.5"), ("card", "4111 1111 1111 1111"), ("phone", "+49 (30) 1234567"),
                    ("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789"), ("ssn", "123-45-6780")]
    assert got[2] == got[3] == [] and [(p.start, p.end) for p in got[4]] == [(6 * k, 6 * k + 5) for k in range(3000)]
    masked = {r.doc_id: r.text for r in pii.mask_pii(docs).collect()}
    assert masked[1].startswith("mail <email>, x@y IP <ip>.<ip> 300") and masked[2] is None and masked[3] == ""
    assert pii.find_pii(odd).columns == [*odd.columns, "pii"] and pii.find_pii(empty).count() == 0


def test_pages(spark):
    page = ("<html><head><title>No</title><script>var x='<p>no</p>';</script></head><body><nav><ul><li><a href=/>home</a><li><a href=/b>menu entry</a></ul></nav>"
            "<div class=\"ad\">buy now</div><article><h1>Title &amp; more</h1><p>First <b>par</b>agraph  with\n words in it.<p>Second one, which goes on &eacute; and on.</article>"
            "<section class='comments'><div class=comment><p>I do not agree with any of this at all.</p></div></section><footer>&copy; us</footer></body></html>")
    rows = spark.createDataFrame([(1, page, "old"), (2, None, "old"), (3, "", "old"), (4, "<", "old"), (5, "<p " + "\"" * 9, "old")], "page_id long, html string, text string")
    got = {r.page_id: r.text for r in pages.extract_text(rows).collect()}
    assert got[1] == "Title & more First paragraph with words in it. Second one, which goes on é and on."
    assert got[2] == got[3] == "" and got[4] is not None and pages.extract_text(rows.limit(0)).count() == 0


def test_pages_decode_without_contradictions():
    import random
    rng, model = random.Random(77), pages.page_model()
    hit = every = 0
    for _ in range(60):
        order = pages.nodes(pages.parse(pages.training_page(rng)))
        kept = {id(n) for n in pages.decode(order, model.scores(pages.features(order)))}
        want = {id(n) for n in order if n.text and n.marked}
        hit, every = hit + len(kept & want), every + len(kept | want)
    assert hit / every > 0.95


def test_licenses(spark, odd, empty):
    docs = spark.createDataFrame([(1, "abc def\nReleased under the MIT License."), (2, "Licensed under CC BY-NC 4.0."), (3, "You need a driving license to rent a car"),
                                  (4, None), (5, ""), (6, " ".join(["word"] * 80 + ["Licensed under the Apache License, Version 2.0."] + ["other"] * 80))], "doc_id long, text string")
    model = licenses.train(docs)
    got = {r.doc_id: [(x.line, x.family) for x in r.licenses] for r in licenses.scan(docs, model).collect()}
    assert got[1] == [(2, "mit")] and got[2] == [(1, "cc-by-nc")] and got[3] == got[4] == got[5] == [] and got[6] == [(1, "apache-2.0")]
    assert licenses.scan(odd, model).columns == [*odd.columns, "licenses"] and licenses.scan(empty, licenses.train(empty)).count() == 0


def test_licenses_short_and_unlisted(spark):
    said = {"MIT License": "mit", "License: MIT": "mit", "SPDX-License-Identifier: MIT": "mit", "BSD 3-Clause License": "bsd", "GPLv3": "gpl",
            "Published under the Eclipse Public License": "unknown", "Licensed under the Foobar Quux License": "unknown", "SPDX-License-Identifier: GPL-2.0-only": "gpl",
            "CC BY-SA 4.0": "cc-by-sa", "the driving license": None, "MIT": None, "All rights reserved.": None, "onlyou eraton thehey": None}
    docs = spark.createDataFrame([(k, line) for k, line in enumerate(said)], "doc_id long, text string")
    got = {r.text: [x.family for x in r.licenses] for r in licenses.scan(docs, licenses.train(docs)).collect()}
    assert got == {line: [family] if family else [] for line, family in said.items()}


def test_licenses_against_every_window(spark):
    """Each window of each line, scored alone by a plain sum, gives the same entries; one line has 60,000 words."""
    rng = random.Random(9)
    sentences = [t for name in licenses.TEMPLATES for t in licenses.statements(name)] + list(licenses.NEAR_MISSES)
    filler = [f"w{k}" for k in range(300)]

    def line(n):
        parts = [rng.choice(sentences) if rng.random() < 0.04 else rng.choice(filler) for _ in range(n)]
        return " ".join(parts).title()

    texts = ["\n".join(line(rng.choice((0, 1, 2, 5, 30, 47, 48, 49, 72, 73, 200))) for _ in range(rng.randint(1, 9))) for _ in range(40)]
    texts += [line(60_000), "", "\n\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(3)
    model = licenses.train(docs)
    rows = licenses.paragraphs(docs, "text").collect()
    want = {}
    for r in rows:
        best = {}
        for k, words in enumerate(r._lines):
            h = np.array(words, np.int64).view(np.uint64)
            for at in range(0, 1 if len(h) <= 48 else len(h) - 24, 24):
                w = h[at:at + 48]
                got = model.scan(w) if len(w) else None
                if got and (got[1], got[2]) > best.get((k + 1, got[0]), (-1.0, -1.0)):
                    best[k + 1, got[0]] = got[1], got[2]
        want[r.doc_id] = best
    got = {r.doc_id: {(x.line, x.family): (x.probability, x.confirmed) for x in r.licenses} for r in licenses.scan(docs, model).collect()}
    assert {k: list(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert sum(map(len, want.values())) > 100
    for key in want:
        for entry in want[key]:
            assert abs(got[key][entry][0] - want[key][entry][0]) < 1e-4


def test_vectors(spark):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(30, 32))
    rows = [(k, [float(x) for x in centre[k % 30] + rng.normal(size=32) * 0.22 * (k % 3)], k % 30 % 3) for k in range(300)]
    rows += [(300, rows[0][1], 0), (301, rows[0][1], None), (302, None, 0), (303, [0.0] * 32, 0), (304, [float("nan")] + [1.0] * 31, 0), (305, [], 0),
             (306, [None] + [1.0] * 31, 0), (None, rows[1][1], 1), (307, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    assert len(got) == len(rows)
    x = np.array([r[1] for r in rows[:301]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows[:301]])
    close = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(close, False)
    want = close.sum(1)
    want[1] += 1
    want += np.where(close[1], 1, 0)
    found = np.array([got[k].n_links for k in range(301)])
    assert (found <= want).all() and found.sum() >= 0.9 * want.sum()
    assert got[300].component_id == 0 and not got[300].kept and got[0].kept
    assert all(got[k].n_links == 0 and got[k].component_id == k for k in (301, 302, 303, 304, 305, 306, 307))
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_split_vector_buckets_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 8)
    rows = [(k, [1.0, k / 1000, 0.5, 0.25], 1) for k in range(100)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert all(r.n_links == 99 and r.component_id == 0 for r in got)

def jaccard_leaders(texts, size=5, similarity=0.8):
    """Plain Python: index of the first text of each text's group."""
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(len(w) - size + 1, 1))})
    parent = list(range(len(texts)))

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def short_pairs(rng):
    """Texts of 8 to 11 words, and each with a word more: 4 of 5 up to 7 of 8 shingles are common."""
    texts = []
    for k in range(160):
        first = prose(rng, 8 + k % 4)
        texts += [first, first + " " + prose(rng, 1)]
    return texts


def test_near_copies_of_short_texts_match_brute_force(spark):
    texts = short_pairs(np.random.default_rng(21))
    lead = jaccard_leaders(texts)
    assert sum(k != r for k, r in enumerate(lead)) == 160
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect())
    assert kept == sorted(set(lead))


def family(rng, members, planted, blocks=40):
    """Variants of one text at about 0.7; of ``planted`` of them there is one more variant at about 0.82."""
    base = [prose(rng, 5) for _ in range(blocks)]

    def varied(parts, n):
        out = list(parts)
        for at in rng.choice(blocks, n, replace=False):
            words = out[at].split()
            words[2] = prose(rng, 1)
            out[at] = " ".join(words)
        return out
    made = [varied(base, 4) for _ in range(members)]
    made += [varied(made[k], 4) for k in range(planted)]
    return [" ".join(m) for m in made]


def test_near_copies_in_a_large_family_match_brute_force(spark):
    texts = family(np.random.default_rng(22), 500, 120)
    lead = jaccard_leaders(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect())
    assert 400 < len(kept) < 560 and kept == sorted(set(lead))


def test_words_beyond_the_radius_are_abandoned(monkeypatch):
    """On fingerprints without links every block and every shift ends early, whatever the number of rows."""
    rng = np.random.default_rng(9)
    read, ended = [], []
    counted = simhash._counted

    def watched(diff, planes, radius, over):
        def seen(b, at):
            read.append((b, len(at)))
            return diff(b, at)
        got = counted(seen, planes, radius, over)
        ended.append(got is None)
        return got

    monkeypatch.setattr(simhash, "_counted", watched)
    x = rng.integers(0, 2**63, (1111, 1)).astype(np.uint64)
    assert not list(simhash._by_block(x, np.arange(1111), 4)) and all(ended) and max(b for b, _ in read) < 60
    read.clear(), ended.clear()
    x[700] = x[3]  # one link keeps its own word alone
    assert [(int(a[0]), int(b[0]), int(d[0])) for a, b, d in simhash._by_block(x, np.arange(1111), 4)] == [(3, 700, 0)]
    assert ended.count(False) == 1 and min(w for b, w in read if b > 60) == 1
    read.clear(), ended.clear()
    group = np.repeat(np.arange(40), 20)
    assert not list(simhash._by_shift(x[:800], group, np.arange(800), 4)) and all(ended) and max(b for b, _ in read) < 60


def runs(source):
    return [n.text for n in pages.nodes(pages.parse(source)) if n.text]


@pytest.mark.parametrize("tag", ["svg", "noscript", "iframe", "object", "canvas", "template", "math"])
def test_elements_without_an_end_swallow_nothing(tag):
    assert runs(f"<article><p>Alpha</p><{tag}><path/><p>Beta</p></article><p>Gamma</p>") == ["Alpha", "Beta", "Gamma"]
    assert runs(f"<article><{tag}><p>Beta</p></article><aside><{tag}>no</{tag}></aside><p>Gamma</p>") == ["Beta", "Gamma"]
    assert runs(f"<article><p>Alpha</p><{tag}>no</{tag}><p>Beta</p></article>") == ["Alpha", "Beta"]
    assert runs(f"<p>Alpha</p><{tag}>Beta") == ["Alpha", "Beta"] and runs("<p>Alpha</p><script>x<p>y") == ["Alpha"]


@pytest.mark.parametrize("piece", ["<a ", "<a b='", '<a "', "<!x ", "<!--", "<svg>", "<svg><math>", "</svg", "<p><b>x</p>", "&amp", "<script>"])
def test_pages_are_parsed_in_linear_time(piece):
    began = time.time()
    pages.parse(piece * 20000)
    assert time.time() - began < 3


def test_very_long_page():
    began = time.time()
    text = runs("<main>" + "<p>Some words in a paragraph, and more of them.</p>" * 100000 + "</main>")
    assert len(text) == 100000 and time.time() - began < 30


def test_cosines_of_tiny_and_huge_vectors(spark):
    made = [(1, [1e-200, 0.0]), (2, [float(np.cos(1)), float(np.sin(1))]), (3, [2e-200, 0.0]), (4, [1e200, 0.0]), (5, [2e200, 1e199]), (6, [0.0, 1e-308]),
            (7, [0.0, 3e307]), (8, [5e-324, 0.0])]
    rows = vectors.near_vectors(spark.createDataFrame([(i, v, 0) for i, v in made], "vec_id long, embedding array<double>, label int")).collect()
    got = {r.vec_id: (r.n_links, r.component_id) for r in rows}
    assert got == {1: (4, 1), 3: (4, 1), 4: (4, 1), 5: (4, 1), 8: (4, 1), 2: (0, 2), 6: (1, 6), 7: (1, 6)}
