"""Near copies by SimHash: bit planes stored vertically, distances counted by carry-save adders."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechlake.llm.text import ascii_lower, digest, split_words
from speechlake.operators.checkpoints import discard, settle
from speechlake.operators.groups import connected_components

CHUNK = 1024  # a bucket of more than twice as many fingerprints is compared in pairs of such parts
SMALL = 32  # buckets up to this size are compared shift by shift, larger ones block by block
FLUSH = 1 << 16  # rows compared together
STEP = 255 * 32  # hashes whose bits are counted together


def with_shingles(docs: DataFrame, text: str, size: int, out: str) -> DataFrame:
    """Adds the XXH64 (seed 42) of every run of ``size`` words, repeats included; of all words if there are fewer."""
    words = docs.withColumn("__words", split_words(ascii_lower(F.col(text))))
    starts = F.sequence(F.lit(1), F.greatest(F.size("__words") - size + 1, F.lit(1)))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice("__words", i, size), " ")))
    return words.withColumn(out, F.when(F.size("__words") > 0, hashes).otherwise(
        F.expr("cast(array() as array<bigint>)"))).drop("__words")


def _mix(h: np.ndarray, lane: int) -> np.ndarray:
    """Other 64 bits for each hash."""
    with np.errstate(over="ignore"):
        z = h + np.uint64(lane * 0x9E3779B97F4A7C15 % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _lane(h: np.ndarray, lane: int) -> np.ndarray:
    """The hashes in lane 0; in others, bits of them that are as good for counting."""
    if not lane:
        return h
    with np.errstate(over="ignore"):
        z = h * np.uint64((lane * 0x9E3779B97F4A7C15 | 1) % 2**64)
        return (z ^ (z >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) ^ (z >> np.uint64(29))


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> np.ndarray:
    """``lanes`` 64-bit words; a bit is set if it is in over half of the hashes. No hashes give zero."""
    h = np.asarray(hashes).view(np.uint64)
    counts = np.zeros(64 * lanes, np.int64)
    for at in range(0, len(h), STEP):
        part = h[at:at + STEP]
        mixed = np.stack([_lane(part, lane) for lane in range(lanes)], 1)
        bits = np.zeros((-(-len(part) // 255) * 255, 64 * lanes), np.uint8)
        bits[:len(part)] = np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little")
        counts += bits.reshape(-1, 255, 64 * lanes).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)  # a sum of 255 bits fits a byte
    return np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)


def fingerprints(hashes: Column) -> Column:
    """Array of one long for an array of shingle hashes."""

    @F.pandas_udf("array<long>")
    def made(rows: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(r).view(np.int64) for r in rows])

    return made(hashes)


# --- comparing

def _counted(diff: Callable[[int, np.ndarray], np.ndarray], planes: int, radius: int,
             over: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray] | None:
    """Lanes within the radius, as set bits, the counters, and which words they are of; None if every lane left it.

    ``diff(b, at)`` has a set bit for every lane of the words ``at`` that differs in plane b; lanes set in ``over`` do not count from
    the start. Counters are vertical: bit i of all lanes' counts is one array. They start so that the last carry comes exactly when a
    count passes the radius. Three planes at a time go through a full adder, so two additions do for three planes. Words
    whose lanes are all beyond the radius are abandoned: once they are half of the words left, the rest is packed together.
    """
    at = np.arange(over.shape[-1])
    width = max(1, radius.bit_length())
    offset = (1 << width) - 1 - radius
    state = None

    def add(carry: np.ndarray, weight: int) -> None:
        nonlocal over
        for i in range(weight, width):
            after = state[i] & carry
            state[i] = state[i] ^ carry
            carry = after
        over = over | carry

    for b in range(0, planes, 3):
        if b == 0 or b > radius:
            live = np.bitwise_and.reduce(over, axis=tuple(range(over.ndim - 1))) != np.uint64(0xFFFFFFFFFFFFFFFF)
            left = np.count_nonzero(live)
            if not left:
                return None
            if 2 * left <= len(at):
                at, over = at[live], over[..., live]
                state = state and [c[..., live] for c in state]
        x = diff(b, at)
        if state is None:
            state = [np.full_like(x, np.uint64(0xFFFFFFFFFFFFFFFF) if offset >> i & 1 else np.uint64(0)) for i in range(width)]
        if b + 2 >= planes:
            add(x, 0)
            if b + 1 < planes:
                add(diff(b + 1, at), 0)
            break
        y, z = diff(b + 1, at), diff(b + 2, at)
        half = x ^ y
        add(half ^ z, 0)
        carry = (x & y) | (z & half)
        if width > 1:
            add(carry, 1)
        else:
            over = over | carry
    return ~over, state, at


def _distances(counters: list[np.ndarray], radius: int, where: tuple[np.ndarray, ...]) -> np.ndarray:
    """Counts of single lanes; the last index of ``where`` numbers lanes, not words."""
    word, bit = where[-1] // 64, (where[-1] % 64).astype(np.uint64)
    at = (*where[:-1], word)
    total = sum(((c[at] >> bit) & np.uint64(1)).astype(np.int64) << i for i, c in enumerate(counters))
    return total - ((1 << len(counters)) - 1 - radius)


def _lanes(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), axis=-1, bitorder="little")


def _planes(fps: np.ndarray, n: int) -> np.ndarray:
    """Bit planes of fingerprints (rows x lanes): planes x words."""
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8), axis=1, bitorder="little")
    pad = np.zeros((-n % 64, bits.shape[1]), np.uint8)
    return np.ascontiguousarray(np.packbits(np.vstack([bits, pad]).T, axis=1, bitorder="little")).view(np.uint64)


def links_within(fps: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row pairs of one group (sorted) that differ in at most ``radius`` bits: earlier, later, distance."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    for low, high in ((1, 4), (4, SMALL)):
        mine = np.flatnonzero((sizes > low) & (sizes <= high))
        if len(mine):
            rows = np.concatenate([np.arange(starts[g], starts[g] + sizes[g]) for g in mine]) if len(mine) < 64 else \
                np.flatnonzero(np.repeat((sizes > low) & (sizes <= high), sizes))
            yield from _by_shift(fps, group, rows, radius)
    for g in np.flatnonzero(sizes > SMALL):
        yield from _by_block(fps, np.arange(starts[g], starts[g] + sizes[g]), radius)


def _by_shift(fps, group, rows, radius):
    """All rows against the row k places on, for k up to the largest group."""
    n, planes, own = len(rows), _planes(fps[rows], len(rows)), group[rows]
    for k in range(1, SMALL):
        same = own[k:] == own[:-k] if k < n else np.zeros(0, bool)
        if not same.any():
            return
        words, rest = divmod(k, 64)
        # lanes beyond the last row and of other groups do not count
        over = np.packbits(np.r_[~same, np.ones(-len(same) % 64, bool)], bitorder="little").view(np.uint64)

        def diff(b, at, words=words, rest=rest):
            p = planes[b]
            moved = p[at + words] >> np.uint64(rest)
            if rest:
                further = at + words + 1
                moved |= np.where(further < len(p), p[np.minimum(further, len(p) - 1)], np.uint64(0)) << np.uint64(64 - rest)
            return p[at] ^ moved

        got = _counted(diff, len(planes), radius, over)
        if got is None:
            continue
        near, counters, at = got
        word, bit = np.divmod(np.flatnonzero(_lanes(near[None, :])[0]), 64)
        if len(word):
            first = at[word] * 64 + bit
            yield rows[first], rows[first + k], _distances(counters, radius, (word * 64 + bit,))


def _by_block(fps, rows, radius, queries: int = 256):
    """A large group: blocks of queries against all rows of the group before them and in their block."""
    n, planes = len(rows), _planes(fps[rows], len(rows))
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    for begin in range(0, n, queries):
        mine = np.ascontiguousarray(fps[rows[begin:begin + queries]])
        bits = np.unpackbits(mine.view(np.uint8), axis=1, bitorder="little").astype(bool)
        width = -(-min(n, begin + queries) // 64)
        later = np.arange(width * 64)[None, :] >= np.arange(begin, begin + len(mine))[:, None]  # itself and what follows it
        over = np.packbits(later, axis=1, bitorder="little").view(np.uint64)

        def diff(b, at, bits=bits):
            return planes[b][None, at] ^ np.where(bits[:, b], ones, np.uint64(0))[:, None]

        got = _counted(diff, len(planes), radius, over)
        if got is None:
            continue
        near, counters, at = got
        q, lane = np.nonzero(_lanes(near))
        if len(q):
            word, bit = np.divmod(lane, 64)
            yield rows[at[word] * 64 + bit], rows[q + begin], _distances(counters, radius, (q, lane))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest row that each row reaches over the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _by_parts(made: Callable[[pd.DataFrame], pa.RecordBatch | None]):
    """A task that hands whole bucket parts, many at a time, to ``made``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch.to_pandas())
            rows += len(held[-1])
            if rows < FLUSH:
                continue
            table = pd.concat(held, ignore_index=True)
            key = table[["bucket", "part"]].to_numpy()
            begin = int(np.flatnonzero((key != key[-1]).any(1))[-1]) + 1 if (key != key[-1]).any() else 0
            if begin and (out := made(table.iloc[:begin])) is not None:
                yield out
            held, rows = [table.iloc[begin:]], len(table) - begin
        if rows and (out := made(pd.concat(held, ignore_index=True))) is not None:
            yield out

    return task


def _compare(lanes: int, sure: int, maybe: int):
    schema = pa.schema([(f"{s}{i}", pa.int64()) for s in "ab" for i in range(lanes)] + [("sure", pa.bool_())])

    def edges(table: pd.DataFrame) -> pa.RecordBatch | None:
        fps = np.ascontiguousarray(table[[f"f{i}" for i in range(lanes)]].to_numpy(np.int64)).view(np.uint64)
        parts = table[["bucket", "part"]].to_numpy(np.int64)
        group = np.cumsum(np.r_[True, (parts[1:] != parts[:-1]).any(1)])
        n, near_a, near_b, src, dst = len(table), [], [], [], []
        best = [np.full(n, 1 << 40), np.full(n, 1 << 40)]  # distance and row of the nearest before and after
        held = 0
        for a, b, d in links_within(fps, group, maybe):
            close = d <= sure
            near_a.append(a[close])
            near_b.append(b[close])
            held += int(close.sum())
            if held > 1 << 21:  # keep memory bounded in dense groups
                root = _forest(np.concatenate(near_a), np.concatenate(near_b), n)
                moved = np.flatnonzero(root != np.arange(n))
                near_a, near_b, held = [root[moved]], [moved], len(moved)
            if maybe > sure:
                far = ~close
                np.minimum.at(best[0], b[far], (d[far] << 32) | a[far])
                np.minimum.at(best[1], a[far], (d[far] << 32) | b[far])
        root = _forest(np.concatenate(near_a), np.concatenate(near_b), n) if near_a else np.arange(n)
        moved = np.flatnonzero(root != np.arange(n))
        src, dst, flag = [root[moved]], [moved], [np.ones(len(moved), bool)]
        for nearest in best if maybe > sure else ():
            at = np.flatnonzero(nearest < 1 << 40)
            to = nearest[at] & 0xFFFFFFFF
            src, dst, flag = [*src, to], [*dst, at], [*flag, np.zeros(len(at), bool)]
        a, b = np.concatenate(src).astype(np.int64), np.concatenate(dst).astype(np.int64)
        if not len(a):
            return None
        columns = [pa.array(fps[x, i].view(np.int64)) for x in (a, b) for i in range(lanes)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(flag))], schema=schema)

    ddl = ", ".join([f"{s}{i} long" for s in "ab" for i in range(lanes)] + ["sure boolean"])
    return _by_parts(edges), ddl


def block_masks(blocks: int = 6, keyed: int = 2) -> list[list[int]]:
    """Masks of ``keyed`` of ``blocks`` blocks of 64 bits: with blocks - keyed differing bits one mask misses all."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    part = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [[sum(part[i] for i in chosen)] for chosen in combinations(range(blocks), keyed)]


def sample_masks(lanes: int, tables: int, bits: int, seed: int = 3) -> list[list[int]]:
    """Masks of ``bits`` bits drawn from all lanes, one for each table."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(tables):
        drawn = rng.choice(64 * lanes, bits, replace=False).tolist()
        out.append([sum(1 << (b - 64 * lane) for b in drawn if b // 64 == lane) for lane in range(lanes)])
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_links(fps: DataFrame, masks: list[list[int]], lanes: int, sure: int, maybe: int | None = None) -> DataFrame:
    """``src, dst, sure`` between distinct fingerprints (column ``fp``, array of longs); ``dst`` named ``src``.

    Fingerprints that agree under a mask share a bucket; in it, sure links (distance at most ``sure``) come as a
    spanning forest, and each fingerprint also names its nearest partners up to ``maybe`` bits, so
    a bucket gives rows in proportion to its size. Buckets of over two chunks are dealt out as
    pairs of chunks: each pair meets in a task of its own and none is left out. Runs jobs; the result is settled.
    """
    maybe = sure if maybe is None else maybe
    keys = F.array(*[F.xxhash64(F.lit(t), *[F.col("fp")[i].bitwiseAND(F.lit(_signed(m))) for i, m in enumerate(mask)])
                     for t, mask in enumerate(masks)])
    keyed = fps.select(*[F.col("fp")[i].alias(f"f{i}") for i in range(lanes)], F.explode(keys).alias("bucket"))
    hot = settle(keyed.groupBy("bucket").count().where(F.col("count") > 2 * CHUNK).select(
        F.col("bucket").alias("hot"), F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks")))
    dealt = keyed.withColumn("part", F.lit(0).cast("long"))
    if not hot.isEmpty():
        mine = F.pmod(F.xxhash64(F.lit(7), *[f"f{i}" for i in range(lanes)]), F.col("chunks")).cast("long")
        pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.least(mine, j.cast("long")) * F.col(
            "chunks") + F.greatest(mine, j.cast("long")))
        dealt = keyed.join(hot, F.col("bucket") == F.col("hot"), "left").withColumn(
            "part", F.explode(F.when(F.col("hot").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pairs))
        ).drop("hot", "chunks")
    task, ddl = _compare(lanes, sure, maybe)
    order = ["bucket", "part", *[f"f{i}" for i in range(lanes)]]
    found = dealt.select(*order).repartition("bucket", "part").sortWithinPartitions(*order).mapInArrow(task, ddl)
    links = settle(found.groupBy(*[f"{s}{i}" for s in "ab" for i in range(lanes)]).agg(F.max("sure").alias("sure")).select(
        F.array(*[f"a{i}" for i in range(lanes)]).alias("src"), F.array(*[f"b{i}" for i in range(lanes)]).alias("dst"), "sure"))
    discard(hot)
    return links


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components, from ``src, dst`` where ``dst`` is the node that named the partner.

    A node's partners in all tables are tied to the smallest of them instead of to the node; as the members of a
    group share their partners, most of these edges are the same one. A node names three partners at most in each
    bucket part it stands in, however many name it, so the sets stay small also where one text is the model of all others.
    """
    tied = edges.groupBy("dst").agg(F.collect_set("src").alias("_named"))
    return tied.select(F.array_min("_named").alias("src"), F.explode(F.array_union("_named", F.array("dst"))).alias("dst")).where(
        F.col("src") != F.col("dst")).distinct()


def hexadecimal(fp: Column) -> Column:
    """Lanes as 16 lower-case digits each."""
    return F.array_join(F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def fingerprint_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4,
                           radius: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row; runs jobs.

    64-bit fingerprints of all shingles, repeats included, link at ``radius`` (4 or less) differing bits; a component
    is named by its smallest doc_id (null ids are passed over; null if there is no other). Two of six blocks of bits
    agree in any linked pair, so no link is missed. Equal fingerprints are one class: copies are never
    compared. Null, empty and word-less texts have fingerprint zero and link like any other.
    """
    rows = with_shingles(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), "_text", shingle, "_h")
    rows = settle(rows.select("doc_id", fingerprints(F.col("_h")).alias("fp")))
    classes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    links = fingerprint_links(classes, block_masks(radius + 2, 2), 1, radius)
    edges = settle(contracted(links.select(F.col("src")[0].alias("src"), F.col("dst")[0].alias("dst"))))
    discard(links)
    found = connected_components(edges)
    discard(edges)
    named = classes.join(found, F.col("fp")[0] == F.col("node"), "left").withColumn(
        "_of", F.coalesce("component", F.col("fp")[0]))
    lowest = named.groupBy("_of").agg(F.min("low").alias("component_id"))
    members = named.select("fp", "_of").join(lowest, "_of").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(members, F.col("fp") == F.col("_fp")).select(
        "doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


LANES, TABLES, BITS = 4, 24, 14  # 256-bit fingerprints; tables of so many sampled bits
NONE, MAYBE = -1, 54  # bits: no distance links unseen; partners of a similarity as low as 0.68 are looked at


PARITY = 16  # words of 64 bits: parities that go to every bucket
SAMPLE, OFTEN, MOST = 10000, 4, 100_000  # texts that name frequent shingles, in how many of them, and how many at most


def word_hashes(text: Column) -> Column:
    """A long for each word of the text, A-Z in lower case."""
    return F.transform(split_words(ascii_lower(text)), lambda w: F.xxhash64(w))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of every run of ``size`` word hashes, sorted; of all of them if there are fewer, of none if there are none."""
    w = np.asarray(words, np.int64).view(np.uint64)
    size = min(size, len(w))
    if not size:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(w) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        w = _mix(w, 1)
        for k in range(size):
            h = h * np.uint64(0x100000001B3) + w[k:len(w) - size + 1 + k]
    return np.unique(_mix(h, 2))


def _frequent_shingles(docs: DataFrame, text: str, shingle: int) -> np.ndarray:
    """Frequent shingles of some texts, the rarer first. They only decide an order that is the same for all texts."""
    every = max(1, docs.count() // SAMPLE)
    some = docs.select(F.col(text).alias("_text")).where(F.pmod(F.xxhash64("_text"), F.lit(every)) == 0).distinct()
    found = some.select(F.explode(_shingles(word_hashes(F.col("_text")), shingle)).alias("s")).groupBy("s").count()
    often = found.where(F.col("count") >= OFTEN).orderBy(F.desc("count"), "s").limit(MOST).collect()
    return np.array([r.s for r in reversed(often)], np.int64).view(np.uint64)


def _shingles(words: Column, shingle: int) -> Column:
    @F.pandas_udf("array<long>")
    def made(rows: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(r, shingle).view(np.int64) for r in rows])

    return made(words)


def parities(u: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the number of hashes that fall to each of ``bits`` (a power of two), as longs.

    Parities of two sets differ in at most as many bits as the sets do in members. Half as many bits are the XOR of the halves.
    """
    at = (u >> np.uint64(8) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1, bitorder="little").view(np.int64)


def sketch_bits(n: int) -> int:
    """Bits of the sketch of a set of ``n``: a power of two, at least twice its size."""
    return max(64, 1 << (2 * n - 1).bit_length())


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    while len(sketch) > words:
        sketch = sketch[:len(sketch) // 2] ^ sketch[len(sketch) // 2:]
    return sketch


def allowed(a, b, similarity: float):
    """In how many members two sets of these sizes may differ at that Jaccard similarity."""
    return (1 - similarity) / (1 + similarity) * (a + b) + 1e-6


def prefix(u: np.ndarray, often: np.ndarray, by: np.ndarray, similarity: float) -> np.ndarray:
    """The first ``n - ceil(similarity * n) + 1`` shingles in an order that puts those of ``often`` last.

    Two sets of that Jaccard similarity share one of them.
    """
    many = len(u) - int(np.ceil(similarity * len(u) - 1e-9)) + 1
    if not len(often) or not len(u):
        return u[:many]
    at = np.minimum(np.searchsorted(often, u, sorter=by), len(often) - 1)
    known = often[by[at]] == u
    rare = u[~known]
    if len(rare) < many:
        rank = by[at[known]]
        rare = np.r_[rare, u[known][np.argsort(rank, kind="stable")]]
    return rare[:many]


def _described(often: np.ndarray, shingle: int, similarity: float):
    """UDF from word hashes to what the stage needs of a text: fingerprint, key and size of its set, prefix and sketches."""
    by = np.argsort(often)

    @F.pandas_udf("fp array<long>, key long, n int, parity array<long>, prefix array<long>, sketch array<long>")
    def made(rows: pd.Series) -> pd.DataFrame:
        out = []
        for r in rows:
            u = shingle_set(r, shingle)
            key = int(u.sum(dtype=np.uint64).view(np.int64))
            out.append((fingerprint(u, LANES).view(np.int64), key, len(u), parities(u, 64 * PARITY),
                        prefix(u, often, by, similarity).view(np.int64), parities(u, sketch_bits(len(u)))))
        return pd.DataFrame(out, columns=["fp", "key", "n", "parity", "prefix", "sketch"])

    return made


def _near_sets(table: pd.DataFrame, similarity: float) -> np.ndarray:
    """Row pairs of one bucket part and of different components whose sizes and parities allow the similarity."""
    parts = table[["bucket", "part"]].to_numpy(np.int64)
    group = np.cumsum(np.r_[True, (parts[1:] != parts[:-1]).any(1)])
    n, of = table["n"].to_numpy(np.int64), table["of"].to_numpy(np.int64)
    parity = np.stack(table["parity"].to_numpy()).view(np.uint64)
    found = []

    def keep(a: np.ndarray, b: np.ndarray) -> None:
        for at in range(0, len(a), FLUSH):
            x, y = a[at:at + FLUSH], b[at:at + FLUSH]
            apart = np.bitwise_count(parity[x] ^ parity[y]).sum(1, dtype=np.int64)
            close = apart <= allowed(n[x], n[y], similarity)
            found.append(np.stack([x[close], y[close]], 1))

    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    small = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    for k in range(1, SMALL):
        a, b = small[:-k], small[k:]
        same = group[a] == group[b]
        if not same.any():
            break
        ok = same & (of[a] != of[b]) & (n[a] >= similarity * n[b] - 1e-6)
        keep(a[ok], b[ok])
    for g in np.flatnonzero(sizes > SMALL):
        rows = np.arange(starts[g], starts[g] + sizes[g])
        for at in range(0, len(rows), 256):  # rows stand by size
            mine = rows[at:at + 256]
            reach = rows[at:np.searchsorted(n[rows] * similarity - 1e-6, n[mine[-1]], side="right")]
            ok = (mine[:, None] < reach[None, :]) & (of[mine][:, None] != of[reach][None, :]) & (
                n[mine][:, None] >= similarity * n[reach][None, :] - 1e-6)
            a, b = np.nonzero(ok)
            keep(mine[a], reach[b])
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def set_candidates(sets: DataFrame, similarity: float) -> DataFrame:
    """``src, dst`` (keys) of all sets of different components that can be alike to that degree; ``sets`` has ``key, n, parity, prefix, of``.

    Sets meet under each shingle of their prefixes, so no pair of that Jaccard similarity is missed. Shingles whose sets are all of one
    component already are left out. Buckets of over two chunks are dealt out as pairs of chunks.
    """
    keyed = sets.select("key", "of", F.explode("prefix").alias("bucket"))
    live = settle(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("of").alias("low"), F.max("of").alias("high")).where(
        F.col("low") < F.col("high")).select("bucket", F.ceil(F.col("size") / CHUNK).cast("long").alias("chunks")))
    mine = F.pmod(F.xxhash64(F.lit(7), "key"), F.col("chunks"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda j: F.least(mine, j) * F.col("chunks") + F.greatest(mine, j))
    dealt = settle(keyed.join(live, "bucket").select("key", "bucket", F.explode(
        F.when(F.col("chunks") <= 2, F.array(F.lit(0).cast("long"))).otherwise(pairs)).alias("part")))
    order = ["bucket", "part", "n", "key"]
    met = dealt.join(sets.select("key", "n", "of", "parity"), "key").select(*order, "of", "parity")

    def pairs_of(table: pd.DataFrame) -> pa.RecordBatch | None:
        keys, at = table["key"].to_numpy(np.int64), _near_sets(table, similarity)
        if not len(at):
            return None
        both = np.unique(np.sort(keys[at], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["src", "dst"])

    found = settle(met.repartition("bucket", "part").sortWithinPartitions(*order).mapInArrow(
        _by_parts(pairs_of), "src long, dst long").distinct())
    discard(live)
    discard(dealt)
    return found


def sketched(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``src, dst`` that sketches in proportion to their sets (``key, n, sketch``) leave possible; none that is alike is lost."""
    a, b = (sets.select(F.col("key").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}")) for c in ("src", "dst"))

    @F.pandas_udf("boolean")
    def possible(na: pd.Series, nb: pd.Series, sa: pd.Series, sb: pd.Series) -> pd.Series:
        least = [min(len(x), len(y)) for x, y in zip(sa, sb)]
        apart = [int(np.bitwise_count(folded(x.view(np.uint64), k) ^ folded(y.view(np.uint64), k)).sum()) for x, y, k in zip(sa, sb, least)]
        return pd.Series(np.array(apart) <= allowed(na.to_numpy(), nb.to_numpy(), similarity))

    return pairs.join(a, "src").join(b, "dst").where(possible("n_src", "n_dst", "s_src", "s_dst")).select("src", "dst")


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``src, dst`` whose sets (``key, shingles``) have the Jaccard similarity."""
    a, b = (sets.select(F.col("key").alias(c), F.col("shingles").alias(f"_{c}")) for c in ("src", "dst"))
    both = F.size(F.array_intersect("_src", "_dst"))
    return pairs.join(a, "src").join(b, "dst").where(
        both >= similarity * (F.size("_src") + F.size("_dst") - both)).select("src", "dst")


def near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 5,
                similarity: float = 0.8) -> DataFrame:
    """``doc_id, text_digest, leader_id, leader_digest`` of every row that goes in favour of its group's leader.

    A first filter, 256-bit SimHash of the distinct five-word shingles, ties most copies: the shingle sets of the nearest
    partners up to 54 differing bits are compared. Then all sets of different groups that share a shingle of
    their prefixes are compared, so every pair at a Jaccard similarity of ``similarity`` is linked. The leader of a
    group is its smallest doc_id (null last), then the smallest digest. Runs jobs.
    """
    often = _frequent_shingles(docs, text, shingle)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_digest")
    texts = docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("text_digest"), F.col(text).alias("_text"))
    described = settle(texts.select("doc_id", "text_digest", _described(often, shingle, similarity)(
        word_hashes(F.col("_text"))).alias("s")).select("doc_id", "text_digest", "s.*"))
    rows = settle(described.select("doc_id", "text_digest", "fp"))
    classes = settle(rows.groupBy("fp").agg(F.min(place).alias("lead")))
    # one row for each set of shingles
    distinct = settle(described.where(F.col("n") > 0).groupBy("key").agg(
        F.min(place).alias("lead"), *[F.first(c).alias(c) for c in ("fp", "n", "parity", "prefix", "sketch")]))
    discard(described)

    def sets_of(ends: DataFrame) -> DataFrame:
        """``key, shingles`` for ``key, lead``."""
        held = texts.join(ends, texts["doc_id"].eqNullSafe(F.col("lead.doc_id")) & (F.col("text_digest") == F.col("lead.text_digest")))
        return settle(held.dropDuplicates(["key"]).select("key", _shingles(word_hashes(F.col("_text")), shingle).alias("shingles")))

    def verified(pairs: DataFrame, leads: DataFrame) -> DataFrame:
        """The alike ones of ``src, dst``, keys of ``leads`` (``key, lead``)."""
        ends = pairs.select(F.explode(F.array("src", "dst")).alias("key")).distinct()
        sets = sets_of(ends.join(leads, "key"))
        found = settle(alike(pairs, sets, similarity))
        discard(sets)
        return found

    links = fingerprint_links(classes, sample_masks(LANES, TABLES, BITS), LANES, NONE, MAYBE)
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    # each pair is checked once; which end named the other is kept
    named_pairs = links.groupBy(low.alias("low"), high.alias("high")).agg(
        F.max(F.col("dst") == high).alias("_by_high")).select(
        F.when(F.col("_by_high"), F.col("low")).otherwise(F.col("high")).alias("src"),
        F.when(F.col("_by_high"), F.col("high")).otherwise(F.col("low")).alias("dst"))
    every = verified(named_pairs, classes.select(F.col("fp").alias("key"), "lead"))
    discard(links)
    edges = settle(contracted(every.select(hexadecimal(F.col("src")).alias("src"), hexadecimal(F.col("dst")).alias("dst"))))
    found = connected_components(edges)
    named = classes.withColumn("_node", hexadecimal(F.col("fp"))).join(found, F.col("_node") == F.col("node"), "left")
    named = settle(named.select("fp", "lead", F.coalesce("component", "_node").alias("_of")))
    for done in (every, edges, found, classes):
        discard(done)
    # the sets of one fingerprint are of one group
    of = settle(distinct.select("key", "fp").join(named.select("fp", "_of"), "fp").select("key", "_of"))
    grouped = settle(distinct.select("key", "n", "parity", "prefix").join(of.select("key", F.xxhash64("_of").alias("of")), "key"))
    met = set_candidates(grouped, similarity)
    discard(grouped)
    pairs = settle(sketched(met, distinct, similarity))
    more = verified(pairs, distinct.select("key", "lead"))
    for done in (met, pairs, distinct):
        discard(done)
    further = settle(more.join(of.select(F.col("key").alias("src"), F.col("_of").alias("_a")), "src").join(
        of.select(F.col("key").alias("dst"), F.col("_of").alias("_b")), "dst").select(
        F.least("_a", "_b").alias("src"), F.greatest("_a", "_b").alias("dst")).distinct())
    joined = connected_components(further)
    last = settle(named.join(joined.select("node", F.col("component").alias("_to")), F.col("_of") == F.col("node"), "left").select(
        "fp", "lead", F.coalesce("_to", "_of").alias("_of")))
    for done in (more, of, further, joined, named):
        discard(done)
    leaders = last.groupBy("_of").agg(F.min("lead").alias("leader"))
    leads = last.select(F.col("fp").alias("_fp"), "_of").join(leaders, "_of").select("_fp", "leader")
    gone = settle(rows.join(leads, F.col("fp") == F.col("_fp")).where(place != F.col("leader")).select(
        "doc_id", "text_digest", F.col("leader.doc_id").alias("leader_id"), F.col("leader.text_digest").alias("leader_digest")))
    discard(last)
    discard(rows)
    return gone


def drop_near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One document of each group of near copies, with all columns; rows alike in doc_id and text are one. Runs jobs."""
    gone = near_copies(docs, text, doc_id, **options).select(
        F.col("doc_id").alias("__doc"), F.col("text_digest").alias("__digest"))
    marked = docs.withColumn("__own", digest(F.col(text)))
    kept = marked.join(gone, marked[doc_id].eqNullSafe(gone["__doc"]) & (F.col("__own") == F.col("__digest")), "left_anti")
    return kept.dropDuplicates([doc_id, "__own"]).select(*[F.col(c) for c in docs.columns])
