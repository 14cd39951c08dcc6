"""Landmark matching against brute force, including very common hashes and copies."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from speechlake.operators import coverage as cov
from speechlake.operators import groups, matching
from speechlake.operators.blocks import middle_ranks, nearest_rank, order_statistics
from speechlake.sinks import files

MARK = "item bigint, hash bigint, t bigint"


def random_marks(seed, items=24, length=60):
    """A third of the landmarks share one hash; some items are copies, some share a passage."""
    rng = random.Random(seed)
    rows = []
    passage = [rng.randrange(50, 90) for _ in range(25)]
    for item in range(items):
        hashes = [7 if rng.random() < 0.33 else rng.randrange(1000) for _ in range(length)]
        if item % 3 == 0:
            at = rng.randrange(30)
            hashes[at:at + 25] = passage
        if item % 7 == 1:
            hashes = [h for i, h, t in rows if i == 0]
        if item % 9 == 2:
            hashes = [7] * length
        rows += [(item, h, t) for t, h in enumerate(hashes)]
    return rows


def brute_pairs(rows):
    by = defaultdict(list)
    for item, h, t in rows:
        by[h].append((item, t))
    return [(a, b, ta - tb, ta) for occ in by.values() for a, ta in occ for b, tb in occ if a < b]


def votes_of(pairs, least):
    return {k: n for k, n in Counter(p[:3] for p in pairs).items() if n >= least}


@pytest.mark.parametrize("hot_pairs", [0, 30, 400, 5000, 10 ** 9])
def test_offset_pairs_are_exact_whatever_is_hot(spark, hot_pairs):
    rows = random_marks(1)
    got = matching.count_votes(
        matching.offset_pairs(spark.createDataFrame(rows, MARK), min_votes=6, hot_pairs=hot_pairs), 6)
    assert {(r.file_a, r.file_b, r.offset): r.votes for r in got.collect()} == votes_of(brute_pairs(rows), 6)


@pytest.mark.parametrize("hot_pairs", [0, 10, 10 ** 9])
def test_repeated_landmarks_count_each_time(spark, hot_pairs):
    four_times = [(item, h, h) for item in (1, 2) for h in (1, 2, 3) for _ in range(4)]
    rows = four_times + [(1, 99, 9), (2, 99, 9)]
    got = matching.count_votes(matching.offset_pairs(
        spark.createDataFrame(rows, MARK), min_votes=14, hot_pairs=hot_pairs), 14)
    assert [(r.file_a, r.file_b, r.offset, r.votes) for r in got.collect()] == [(1, 2, 0, 49)]
    rng = random.Random(8)
    rows = [row for row in random_marks(4, items=12) for _ in range(rng.choice([1, 1, 1, 2, 3]))]
    got = matching.count_votes(matching.offset_pairs(
        spark.createDataFrame(rows, MARK), min_votes=9, hot_pairs=hot_pairs), 9)
    assert {(r.file_a, r.file_b, r.offset): r.votes for r in got.collect()} == votes_of(brute_pairs(rows), 9)


@pytest.mark.parametrize("hot_pairs", [0, 50, 10 ** 9])
def test_two_tables(spark, hot_pairs):
    a, b = random_marks(2), random_marks(3, items=6)
    left = defaultdict(list)
    for item, h, t in a:
        left[h].append((item, t))
    want = Counter((x, i, tx - t) for i, h, t in b for x, tx in left[h])
    got = matching.count_votes(matching.offset_pairs(
        spark.createDataFrame(a, MARK), spark.createDataFrame(b, MARK), 6, hot_pairs), 6)
    assert {(r.file_a, r.file_b, r.offset): r.votes for r in got.collect()} == {k: n for k, n in want.items() if n >= 6}


def test_sampling_bound(spark):
    rows = [(i, 1, i % 5) for i in range(200)] + [(i, 2, 0) for i in range(10)]
    got = matching.sampled_pairs(spark.createDataFrame(rows, MARK), partners=20).collect()
    per = Counter((r.file_a, r.ta) for r in got)
    common = [r for r in got]
    assert len(common) <= 200 * 20 + 45
    assert max(per.values()) <= 20 + 9
    assert len({(r.file_a, r.file_b, r.offset, r.ta) for r in got}) >= len(got) - 45
    again = matching.sampled_pairs(spark.createDataFrame(rows[::-1], MARK), partners=20).collect()
    assert sorted(got) == sorted(again)


def test_incremental_equals_loop(spark):
    rows = [(i, h % 12, t) for i, h, t in random_marks(5)]
    order = {i: (i * 7) % 24 for i in range(24)}
    index, want = defaultdict(list), Counter()
    for item in sorted(order, key=order.get):
        mine = sorted((t, h) for i, h, t in rows if i == item)
        for t, h in mine:
            for other, to in index[h]:
                want[item, other, t - to] += 1
        for t, h in mine:
            if len(index[h]) < 30:
                index[h].append((item, t))
    df = spark.createDataFrame([(i, h, t, order[i]) for i, h, t in rows], MARK + ", arrival bigint")
    got = matching.incremental_pairs(df, limit=30).groupBy("file_a", "file_b", "offset").count().collect()
    assert {(r.file_a, r.file_b, r.offset): r["count"] for r in got} == dict(want)


@pytest.mark.parametrize("cell", [5, 100, 8192])
def test_clusters(spark, cell):
    rng = random.Random(9)
    pairs, want = [], Counter()
    for key in [(1, 2, 3), (1, 2, 4), (5, 6, 0)]:
        t, group = 0, []
        clusters = [group]
        for _ in range(120):
            step = rng.choice([0, 1, 2, 78, 79])
            t += step
            if step > 78:
                group = []
                clusters.append(group)
            group.append(t)
            pairs.append((*key, t))
        for g in clusters:
            if len(g) >= 5:
                want[(*key, len(g), min(g), max(g))] += 1
    df = spark.createDataFrame(pairs, "file_a bigint, file_b bigint, offset bigint, ta bigint")
    got = matching.cluster_votes(df, min_votes=5, cell=cell).collect()
    assert Counter((r.file_a, r.file_b, r.offset, r.n_hashes, r.a_first, r.a_last) for r in got) == want
    assert all(r.b_first == r.a_first - r.offset for r in got)


@pytest.mark.parametrize("cell", [3, 1000])
def test_union_and_coverage(spark, cell):
    rng = random.Random(4)
    rows = [(k, s, s + rng.randrange(0, 12)) for k in range(3) for s in [rng.randrange(200) for _ in range(40)]]
    want = []
    for k in range(3):
        merged = []
        for _, s, e in sorted(r for r in rows if r[0] == k):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        want += [(k, s, e) for s, e in merged]
    df = spark.createDataFrame(rows, "k bigint, start bigint, end bigint")
    got = cov.merge_intervals(df, ["k"], cell).collect()
    assert sorted((r.k, r.start, r.end) for r in got) == want
    length = spark.createDataFrame([(0, 400), (1, 0), (9, 50)], "k bigint, duration bigint")
    rows = {r.k: r for r in cov.coverage(df, length, "k", cell).collect()}
    assert rows[9].covered == 0 and rows[1].share is None
    assert rows[0].covered == sum(e - s for k, s, e in want if k == 0)


def test_components(spark):
    rng = random.Random(8)
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(0, 150)]
    edges += [(f"m{rng.randrange(60)}", f"m{rng.randrange(60)}") for _ in range(40)]
    edges += [("hub", f"h{i}") for i in range(80)] + [("self", "self")]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = groups.connected_components(spark.createDataFrame(edges, "src string, dst string")).collect()
    assert {r.node: r.component for r in got} == {n: root(n) for n in list(parent)}


def test_clips(spark):
    rows = [("c", "n1", "f1", 0.0, 12.0), ("c", "n2", "f2", 5.0, 20.0), ("c", "n3", "f3", 1.0, 2.0),
            ("d", "n4", "f4", 0.0, 50.0), ("d", "n5", "f5", 0.0, 9.0), ("d", "n6", "f5", 20.0, 21.0)]
    df = spark.createDataFrame(rows, "component string, node string, file_id string, start_s double, end_s double")
    got = groups.canonical_clips(df).collect()
    assert [(r.component, r.file_id, r.start_s, r.n_occurrences, r.typical_s) for r in got] == [("c", "f2", 5.0, 3, 12.0)]


@pytest.mark.parametrize("width", [0.001, 0.1, 10.0])
def test_order_statistics(spark, width):
    import statistics

    rng = random.Random(2)
    data = {k: [round(rng.random(), 2) for _ in range(n)] for k, n in (("a", 1), ("b", 10), ("c", 301))}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v double")
    ranks = {**middle_ranks(), "p": nearest_rank(0.1)}
    for r in order_statistics(df, ["k"], "v", ranks, width).collect():
        ordered = sorted(data[r.k])
        assert (r._low + r._high) / 2 == pytest.approx(statistics.median(ordered))
        assert r.p == ordered[round((len(ordered) - 1) * 0.1)]


@pytest.mark.parametrize("hot_pairs", [1, 40, 10**9])
def test_incremental_matches_whatever_is_hot(spark, hot_pairs):
    rows = [(i, h % 9, t) for i, h, t in random_marks(8)]
    df = spark.createDataFrame([(i, h, t, (i * 7) % 24) for i, h, t in rows], MARK + ", arrival bigint")
    want = matching.cluster_votes(matching.incremental_pairs(df), 3).collect()
    got = matching.incremental_matches(df, 3, hot_pairs)
    assert sorted(want) == sorted(got.select(*want[0].__fields__).collect())


@pytest.mark.parametrize("hot_pairs", [1, 40, 10**9])
@pytest.mark.parametrize("kept", [1, 3])
def test_late_items_meet_the_known_ones_whatever_is_hot(spark, hot_pairs, kept):
    """Two tables in order: the last arrivals against all, or against a part of the landmarks that leaves gaps in lines."""
    rows = [(i, h % 9, t, (i * 7) % 24) for i, h, t in random_marks(8)]
    late, known = [r for r in rows if r[3] >= 16], [r for k, r in enumerate(rows) if kept == 1 or k % kept]
    pairs = defaultdict(list)
    for a, h, t, arrived in late:
        for b, g, s, before in known:
            if h == g and before < arrived:
                pairs[a, b, t - s].append(t)
    df, held = (spark.createDataFrame(r, MARK + ", arrival bigint") for r in (late, known))
    got = matching.count_votes(matching.offset_pairs(*[
        x.select((-F.col("arrival")).alias("item"), "hash", "t") for x in (df, held)], 3, hot_pairs, ordered=True), 3)
    number = {i: -n for i, _, _, n in rows}
    assert {(r.file_a, r.file_b, r.offset): r.votes for r in got.collect()} == {
        (number[a], number[b], o): len(ts) for (a, b, o), ts in pairs.items() if len(ts) >= 3}
    plain = spark.createDataFrame([(*k, t) for k, ts in pairs.items() for t in ts], "file_a bigint, file_b bigint, offset bigint, ta bigint")
    want = matching.cluster_votes(plain, 3)
    found = matching.incremental_matches(df, 3, hot_pairs, known=held).select(*want.columns).collect()
    assert found and sorted(found) == sorted(want.collect())


@pytest.mark.parametrize("hot_rows", [5, 10**9])
def test_saved_clips(spark, tmp_path, hot_rows):
    captures = spark.createDataFrame([(i, h % 11, t) for i, h, t in random_marks(6)], MARK)
    known = spark.createDataFrame([(i, h % 11, t) for i, h, t in random_marks(7, items=5)] * 2, MARK)
    files.save_clips(known.select("item").distinct(), known, "told", 4, str(tmp_path / "told"))
    try:
        saved = files.load_clips(spark, "told")[1]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = matching.search_saved_clips(captures, saved, 4, hot_rows, salts=3)
        want = matching.search_clips(captures, known, 4)
        assert found.count() > 0 and sorted(found.collect()) == sorted(want.select(*found.columns).collect())
        if hot_rows > 5:  # the saved side goes into the join as it lies: no exchange above its scan
            executed = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].split("\n")
            at = next(i for i, line in enumerate(executed) if "told_landmarks" in line)
            above, depth = [], executed[at].index("FileScan")
            for line in reversed(executed[:at]):
                mark = len(line) - len(line.lstrip(" :+-"))
                if mark < depth:
                    depth = mark
                    above.append(line)
                    if "Join" in line:
                        break
            assert "Join" in above[-1] and not any("Exchange" in line for line in above)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for part in ("clips", "landmarks"):
            spark.sql(f"DROP TABLE IF EXISTS told_{part}")


@pytest.mark.parametrize("hot_pairs", [0, 10 ** 9])
def test_neighbouring_pairs_are_first_and_last_rows(spark, monkeypatch, hot_pairs):
    """A line that 30 items share is two rows a pair of items, wherever blocks of time cut it; its clusters stay whole."""
    monkeypatch.setattr(matching, "TIME_CELL", 7)
    monkeypatch.setattr(matching, "DEAL", 4)
    rows = [(i, h, 3 * i + h + (200 if h > 12 else 0)) for i in range(30) for h in range(20)]
    pairs = matching.offset_pairs(spark.createDataFrame(rows, MARK), min_votes=5, hot_pairs=hot_pairs)
    assert pairs.count() == 435 * 4  # of 435 * 20
    got = {tuple(r) for r in matching.cluster_votes(pairs, 5, cell=7).select("file_a", "file_b", "offset", "n_hashes", "a_first", "a_last").collect()}
    assert got == {(a, b, 3 * (a - b), n, 3 * a + s, 3 * a + e) for a in range(30) for b in range(a + 1, 30) for n, s, e in ((13, 0, 12), (7, 213, 219))}


def recorded(monkeypatch):
    """Rows of the tables that matching writes."""
    sizes, real = [], matching.settle

    def settle(df):
        out = real(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(matching, "settle", settle)
    return sizes


def test_captures_under_unknown_hashes_are_not_moved(spark, monkeypatch):
    captures = [(i, 1000 * i + t if t >= 40 else t, t) for i in range(3) for t in range(400)]
    clips = [(9, h, h) for h in range(40)]
    sizes = recorded(monkeypatch)
    got = matching.search_clips(spark.createDataFrame(captures, MARK), spark.createDataFrame(clips, MARK), 30).collect()
    assert sorted((r.capture, r.clip, r.n_hashes) for r in got) == [(0, 9, 40), (1, 9, 40), (2, 9, 40)]
    assert max(sizes) == 120  # of 1,200


def test_captures_stay_where_they_are_when_many_clips_share_few_hashes(spark):
    """The size of the list of hashes decides whether it is broadcast, not that of the clip table."""
    rng = random.Random(5)
    clips = matching.settle(spark.createDataFrame([(i, h, rng.randrange(10 ** 12)) for i in range(400) for h in range(40)], MARK))
    captures = spark.createDataFrame([(1, h, h) for h in range(400)], MARK)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        kept = matching._under_known(captures, clips)
        assert "BroadcastHashJoin" in kept._jdf.queryExecution().sparkPlan().toString()
        assert kept.count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_samples_of_common_text_hashes(spark, monkeypatch):
    """Beyond several stretches, against a plain loop; hashes that occur once are not written."""
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    common = [(i % 60, "a b c d e", i) for i in range(150)]
    rows = common + [(i, f"only {i}", 1) for i in range(500)]
    order = sorted(common, key=lambda r: (int(md5(str(r[0]))[:3], 16), r[0], r[2]))
    n, want = len(order), []
    for i, (item, text, t) in enumerate(order):
        first = int(md5(f"{text}-{i}")[:8], 16)
        for k in range(20):
            other, _, tb = order[(i + 1 + (first + k) % (n - 1)) % n]
            if item < other:
                want.append((item, other, t - tb, t))
    sizes = recorded(monkeypatch)
    table = spark.createDataFrame(rows, "item bigint, hash string, t bigint")
    assert sorted(tuple(r) for r in matching.sampled_pairs(table).collect()) == sorted(want)
    assert max(sizes, default=0) == n


def above_the_exchange(df):
    """The steps of the first plan above its topmost exchange."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return lines[:next(i for i, line in enumerate(lines) if "Exchange" in line)]


@pytest.mark.parametrize("hot_pairs", [0, 40, 10 ** 9])
def test_pairs_are_made_and_counted_in_one_place(spark, monkeypatch, hot_pairs):
    """Landmarks go to cells of items; votes of their pairs are counted and cut there, however many cells there are."""
    monkeypatch.setattr(matching, "DEAL", 8)
    rows = random_marks(11)
    marks, want = spark.createDataFrame(rows, MARK), votes_of(brute_pairs(rows), 6)
    pairs = matching.offset_pairs(marks, min_votes=6, hot_pairs=hot_pairs)
    votes = matching.count_votes(pairs, 6)
    for found in (votes, matching.cluster_votes(pairs, 6)):
        assert sum("Generate" in line for line in above_the_exchange(found)) >= 2
    assert {(r.file_a, r.file_b, r.offset): r.votes for r in votes.collect()} == want
    assert pairs.select("cell").distinct().count() > 20
    plain = matching.cluster_votes(matching.landmark_pairs(marks), 6)
    assert sorted(matching.cluster_votes(pairs, 6).collect()) == sorted(plain.collect())


def test_stretches_are_one_row_only_where_they_always_stand_together(spark):
    """2 stands alone in item 4, so 1 2 3 stay apart; 5 6 become one over 78 frames, 7 8 do not over 79; repeated landmarks stay apart."""
    rows = [(i, h, 10 * i + h) for i in (1, 2, 3) for h in (1, 2, 3)] + [(4, 2, 0)]
    rows += [(i, h, 500 + i + 78 * (h - 5)) for i in (1, 2) for h in (5, 6)] + [(i, h, 900 + i + 79 * (h - 7)) for i in (1, 2) for h in (7, 8)]
    rows += [(i, h, 2000 + h) for i in (1, 2) for h in (20, 20, 21)]
    marks = spark.createDataFrame(rows, MARK).withColumn("_rank", F.col("item")).withColumn("_side", F.lit(0))
    counted = marks.groupBy("hash").agg(F.count(F.lit(1)).alias("_all"))
    found = {(r.item, r.hash, r.t, r.till, r["size"], r.n): (r._i, r._pre, r._post) for r in matching._stretches(marks.join(counted, "hash")).collect()}
    want = {(i, 1, 10 * i + 1, 10 * i + 1, 1, 1) for i in (1, 2, 3)}
    want |= {(i, h, 10 * i + h, 10 * i + h, 1, 1) for i in (1, 2, 3) for h in (2, 3)} | {(4, 2, 0, 0, 1, 1)}
    want |= {(i, 5, 500 + i, 578 + i, 2, 1) for i in (1, 2)} | {(i, h, 900 + i + 79 * (h - 7), 900 + i + 79 * (h - 7), 1, 1) for i in (1, 2) for h in (7, 8)}
    want |= {(i, 20, 2020, 2020, 1, 2) for i in (1, 2)} | {(i, 21, 2021, 2021, 1, 1) for i in (1, 2)}
    assert set(found) == want
    assert [found[i, 2, 10 * i + 2, 10 * i + 2, 1, 1][0] for i in (1, 2, 3)] == [2, 2, 2]
    assert len({found[i, 2, 10 * i + 2, 10 * i + 2, 1, 1][1:] for i in (1, 2, 3)}) == 1 and found[4, 2, 0, 0, 1, 1][1:] == (0, 0)


def test_edges_shrink_from_round_to_round(spark, monkeypatch):
    """Cliques become single nodes in the first round; their edges are not carried through the others."""
    sizes, real = [], groups.settle

    def settle(df):
        out = real(df)
        if out.columns == ["src", "dst"]:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(groups, "settle", settle)
    edges = [(100 * k + i, 100 * k + j) for k in range(8) for i in range(20) for j in range(i)] + [(100 * k + 19, 100 * k + 119) for k in range(7)]
    got = groups.connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()
    assert {r.node: r.component for r in got} == {100 * k + i: 0 for k in range(8) for i in range(20)}
    assert sizes[0] == 8 * 190 + 7 and len(sizes) <= 3 and sum(sizes[1:]) <= 7


def test_occurrences_of_one_name_are_one_node(spark):
    """Times that differ but agree to a tenth of a second link their groups; the earliest is kept; a node is named once."""
    rows = [("a", "b", 1.0, 2.0, 1.0, 2.0), ("c", "d", 5.0, 6.0, 7.0, 8.0), ("c", "b", 5.04, 6.04, 0.96, 2.04), ("e", "f", 0.0, 1.0, 3.0, 4.0)]
    df = spark.createDataFrame(rows, "file_a string, file_b string, a_start_s double, a_end_s double, b_start_s double, b_end_s double")
    got = {tuple(r) for r in groups.group_occurrences(df).select("component", "node", "file_id", "start_s", "end_s").collect()}
    one = "a|1.0|2.0"
    assert got == {(one, one, "a", 1.0, 2.0), (one, "b|1.0|2.0", "b", 0.96, 2.04), (one, "c|5.0|6.0", "c", 5.0, 6.0), (one, "d|7.0|8.0", "d", 7.0, 8.0),
                   ("e|0.0|1.0", "e|0.0|1.0", "e", 0.0, 1.0), ("e|0.0|1.0", "f|3.0|4.0", "f", 3.0, 4.0)}


def test_texts_under_other_hashes_do_not_move(spark):
    """All keys are found, few others pass, and they are picked below the only exchange."""
    words = spark.range(20_000).select(F.concat(F.lit("w "), "id").alias("hash"))
    keys = matching.settle(words.where("hash like 'w 7%'").select(F.xxhash64("hash").alias("hash")))
    found = matching._texts(words, keys)
    assert not any("Join" in line for line in above_the_exchange(found))
    assert keys.join(found, "hash").select("_text").distinct().count() == keys.count() == 1111
    assert found.count() < 1111 + 0.1 * 20_000


def test_ties_of_strength_spread_over_tasks_in_a_fixed_order(spark):
    rows = [(a, a + 1, 0, 8 if a % 50 else 9, 0, 7, 0, 7) for a in range(4000)]
    ddl = "file_a bigint, file_b bigint, offset bigint, n_hashes bigint, a_first bigint, a_last bigint, b_first bigint, b_last bigint"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = matching.strongest_first(spark.createDataFrame(rows[::-1], ddl).repartition(4))
        assert [tuple(r) for r in found.collect()] == sorted(rows, key=lambda r: (-r[3], r))
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
