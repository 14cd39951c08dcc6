"""Near copies among vectors: cross-polytope hashing after fast Hadamard rotations, with several probes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.operators.checkpoints import settle
from speechlake.operators.groups import connected_components

TABLES = 6
CHUNK = 1024  # a bucket of more than twice as many vectors is compared in pairs of such parts
SMALL = 16  # buckets up to this size are compared shift by shift, larger ones as a matrix
FLUSH = 1 << 14


@lru_cache(maxsize=64)
def _signs(table: int, part: int, size: int, seed: int) -> np.ndarray:
    return np.random.default_rng((seed, table, part, size)).choice(np.array([-1.0, 1.0]), (3, size))


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row divided by its largest component, so that no square over- or underflows; angles stay as they are."""
    return x / np.abs(x).max(1, keepdims=True)


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Three rounds of random signs and a fast Hadamard transform; columns are a power of two."""
    n, d = x.shape
    for s in signs:
        x = x * s
        h = 1
        while h < d:
            x = x.reshape(n, d // (2 * h), 2, h)
            x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), 2).reshape(n, d)
            h *= 2
        x = x / np.sqrt(d)
    return x


def polytope_codes(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Codes of a table (rows x 3): two nearest signed axes together, then with each one's second choice."""
    d = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), d))
    padded[:, :x.shape[1]] = x
    best, second = [], []
    for part in range(2):
        y = rotate(padded, _signs(table, part, d, seed))
        order = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
        size = np.abs(np.take_along_axis(y, order, 1))
        order = np.where((size[:, 0] >= size[:, 1])[:, None], order, order[:, ::-1])
        sign = np.take_along_axis(y, order, 1) > 0
        best.append(order[:, 0] * 2 + sign[:, 0])
        second.append(order[:, 1] * 2 + sign[:, 1])
    both = 2 * d
    return np.stack((best[0] * both + best[1], second[0] * both + best[1], best[0] * both + second[1]), 1)


def _codes(tables: int, seed: int):
    @F.pandas_udf("array<long>")
    def coded(vectors: pd.Series) -> pd.Series:
        out = np.empty(len(vectors), object)
        sizes = vectors.map(len).to_numpy()
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            x = scaled(np.stack([np.asarray(v, np.float64) for v in vectors.iloc[at]]))
            all_codes = np.concatenate([polytope_codes(x, t, seed) * tables + t for t in range(tables)], 1)
            for row, codes in zip(at, all_codes):
                out[row] = codes
        return pd.Series(out)

    return coded


def _verify(threshold: float):
    schema = pa.schema([("a", pa.string()), ("b", pa.string())])

    def by_length(table: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        for _, part in table.groupby(table["v"].map(len), sort=False):
            yield pairs(part.reset_index(drop=True))

    def pairs(table: pd.DataFrame) -> pa.RecordBatch:
        x = scaled(np.stack(table["v"].to_numpy()).astype(np.float64))
        norm = np.sqrt((x * x).sum(1))
        key = table[["bucket", "part"]].to_numpy(np.int64)
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
        sizes = np.diff(np.r_[starts, len(table)])
        left, right = [], []
        small = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
        group = np.repeat(np.arange(len(sizes)), sizes)
        for k in range(1, SMALL):
            i = small[:-k]
            j = small[k:]
            same = group[i] == group[j]
            if not same.any():
                break
            i, j = i[same], j[same]
            close = np.einsum("ij,ij->i", x[i], x[j]) / (norm[i] * norm[j]) >= threshold
            left.append(i[close])
            right.append(j[close])
        for g in np.flatnonzero(sizes > SMALL):
            begin, end = starts[g], starts[g] + sizes[g]
            for at in range(begin, end, 256):
                mine = slice(at, min(at + 256, end))
                cos = x[mine] @ x[begin:end].T / (norm[mine, None] * norm[None, begin:end])
                i, j = np.nonzero(cos >= threshold)
                i, j = i + at, j + begin
                left.append(i[i < j])
                right.append(j[i < j])
        i, j = (np.concatenate(s) if s else np.zeros(0, int) for s in (left, right))
        node = table["node"].to_numpy()
        found = pd.DataFrame({"a": node[i], "b": node[j]})
        swap = found["a"] > found["b"]
        found.loc[swap, ["a", "b"]] = found.loc[swap, ["b", "a"]].to_numpy()
        return pa.RecordBatch.from_pandas(found.drop_duplicates(), schema=schema, preserve_index=False)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch.to_pandas())
            rows += len(held[-1])
            if rows < FLUSH:
                continue
            table = pd.concat(held, ignore_index=True)
            key = table[["bucket", "part"]].to_numpy()
            other = np.flatnonzero((key != key[-1]).any(1))
            begin = int(other[-1]) + 1 if len(other) else 0
            if begin:
                yield from by_length(table.iloc[:begin])
            held, rows = [table.iloc[begin:]], len(table) - begin
        if rows:
            yield from by_length(pd.concat(held, ignore_index=True))

    return task


def vector_links(classes: DataFrame, threshold: float, tables: int = TABLES, seed: int = 10) -> DataFrame:
    """``a, b`` (nodes, a < b) with a cosine of ``threshold`` or more, from ``node, label, v``; runs jobs.

    Vectors of the same label and length that share a code of a table are compared in double precision. Every vector
    also stands in the buckets of its second choices, so it suffices that one's choice is the other's first or second.
    Buckets of over two chunks are dealt out as pairs of chunks; no pair is left out.
    """
    coded = settle(classes.withColumn("codes", _codes(tables, seed)("v")))
    keyed = coded.select("node", "label", F.size("v").alias("d"), "v", F.explode(F.array_distinct("codes")).alias("code")).select(
        "node", "v", F.xxhash64("label", "d", "code").alias("bucket"))
    hot = settle(keyed.groupBy("bucket").count().where(F.col("count") > 2 * CHUNK).select(
        F.col("bucket").alias("hot"), F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks")))
    dealt = keyed.withColumn("part", F.lit(0).cast("long"))
    if not hot.isEmpty():
        mine = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("long")
        parts = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.least(mine, j.cast("long")) * F.col(
            "chunks") + F.greatest(mine, j.cast("long")))
        dealt = keyed.join(hot, F.col("bucket") == F.col("hot"), "left").withColumn(
            "part", F.explode(F.when(F.col("hot").isNull(), F.array(F.lit(0).cast("long"))).otherwise(parts)))
    return dealt.select("bucket", "part", "node", "v").repartition("bucket", "part").sortWithinPartitions(
        "bucket", "part").mapInArrow(_verify(threshold), "a string, b string").distinct()


def near_vectors(rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
                 threshold: float = 0.93, tables: int = TABLES) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row; runs jobs.

    Equal vectors of a label are one class, compared once; links between classes count for all their members.
    Vectors that are null, empty, zero or hold a null or non-finite value, and rows without a label, link with nothing.
    A component is named by its smallest vec_id (null ids passed over).
    """
    v, one = F.col("v"), F.lit(1.0)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    nonzero = F.exists(v, lambda x: x != 0)
    base = rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    fit = F.coalesce(F.col("label").isNotNull() & v.isNotNull() & finite & nonzero, F.lit(False))
    plus = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x * one))  # minus zero is zero
    name = F.concat_ws("-", *[F.hex(F.xxhash64(F.lit(k), "label", plus)) for k in range(2)])
    own = settle(base.withColumn("node", F.when(fit, name)))
    classes = settle(own.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("low"), F.first("label").alias("label"), F.first("v").alias("v")))
    links = settle(vector_links(classes.select("node", "label", "v"), threshold, tables))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("node").alias("_b"), F.col("n").alias("_n"))
    reach = both.join(sizes, F.col("b") == F.col("_b")).groupBy("a").agg(F.sum("_n").alias("_others"))
    found = connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))).withColumnRenamed("node", "_node")
    named = classes.select("node", "n", "low").join(found, F.col("node") == F.col("_node"), "left").withColumn(
        "_of", F.coalesce("component", "node"))
    lowest = named.groupBy("_of").agg(F.min("low").alias("component_id"))
    members = named.join(lowest, "_of").join(reach, F.col("node") == F.col("a"), "left").select(
        F.col("node").alias("_class"), (F.col("n") - 1 + F.coalesce("_others", F.lit(0))).alias("n_links"), "component_id")
    return own.select("vec_id", "node").join(members, F.col("node") == F.col("_class"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
