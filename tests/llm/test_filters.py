"""The filter audit against a plain count, and odd rows."""

import re
from collections import Counter
from itertools import permutations

import numpy as np

from speechlake.llm import filters

SCHEMA = "doc_id long, text string, lang string, source string, mask string, n string, part string, digest string"


def plain(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rank = lambda i: (i is None, i or 0)
    first = {}
    for i, text, _ in docs:
        first[text or ""] = min(first.get(text or "", rank(i)), rank(i))
    marks = []
    for i, text, lang in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
               "D": bool(re.search(r"[#$%&*|]", t)), "E": rank(i) > first[t]}
        marks.append((lang or "", {x for x in bad if bad[x]}, i in good, i in toxic))
    out = {}
    for part in {m[0] for m in marks}:
        mine, shapley = [m for m in marks if m[0] == part], Counter()
        for order in permutations("ABCDE"):
            gone = [False] * len(mine)
            for step, x in enumerate(order, 1):
                c = Counter()
                for k, (_, bad, is_good, is_toxic) in enumerate(mine):
                    if x in bad:
                        c["redundant" if gone[k] else "removed"] += 1
                        c["unique_fails"] += bad == {x}
                        c["good_lost"] += not gone[k] and is_good
                        c["toxic_lost"] += not gone[k] and is_toxic
                        gone[k] = True
                    c["kept"] += not gone[k]
                shapley[x] += c["removed"]
                out[part, "".join(order), step] = c
        for (p, order, step), c in out.items():
            if p == part:
                c["shapley"] = shapley[order[step - 1]]
    return {k: tuple(c[name] for name in filters.COUNTS) for k, c in out.items()}


def test_audit_matches_a_plain_count(spark):
    rng = np.random.default_rng(4)
    texts = [None, "", " \t\n", "One two THREE", "a " * 300, "é " * 300 + "#", "word" * 50000 + " |", *(
        " ".join(rng.choice(["aa", "bb", "Cc", "dd", "e$", *[f"w{k}" for k in range(900)]], int(rng.integers(150, 400)))) for _ in range(20))]
    docs = [(int(rng.integers(0, 60)) if rng.random() < 0.9 else None, texts[int(rng.integers(len(texts)))],
             [None, "", "aa", "bb"][int(rng.integers(4))]) for _ in range(150)]
    docs += [docs[0], (None, None, "aa"), (None, None, "aa")]
    labels = [(int(i), [None, 0, 1][int(rng.integers(3))], [None, 0, 1][int(rng.integers(3))]) for i in rng.integers(0, 60, 50)] + [(None, 1, 1)]
    df = spark.createDataFrame([(i, t, lang, "s", "x", "x", "x", "x") for i, t, lang in docs], SCHEMA).repartition(4)
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = filters.audit(df, marked).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in filters.COUNTS) for r in rows} == plain(docs, labels)
    assert len(rows) == 600 * len({lang or "" for *_, lang in docs})
    assert filters.audit(df.limit(0), marked).count() == 0
    assert all(r.good_lost == r.toxic_lost == 0 for r in filters.audit(df, marked.limit(0)).collect())


def test_fields_hold_every_count():
    for n in (1, 2, 3, 255, 256, 10**12):
        width = n.bit_length()
        for mask in (0, 1, 31):
            sums = [filters.unpack(n * x, width) for x in filters.outcomes(mask, width)]
            assert all(len(s) == 600 and set(s) <= {0, n} for s in sums) and all(
                k + r + d == n or k == r == 0 or mask for k, r, d in zip(*sums))
    assert filters.unpack(filters.outcomes(0, 3)[0] * 7, 3) == [7] * 600
