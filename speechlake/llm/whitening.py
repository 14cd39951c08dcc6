"""Whitening of vectors: exact products from bit planes, centred as integers, then eigenvectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1024.0
REFERENCE = 100_000  # added to every scaled entry
LIMIT = 1 << 62  # scaled entries beyond it are held at it, so that they stay long integers
COMPONENTS = 8
PLANE_BYTES = 1 << 21  # bit planes worked on together
LIMB, LIMBS = 40, 4  # sums travel as four numbers of 40 bits, the last of which keeps the sign


@dataclass(frozen=True)
class Whitening:
    """What vectors of one length need: count, sums of the scaled entries (without REFERENCE), and components as columns."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: list[float | None]
    identity_error: float | None


def usable(vector: Column) -> Column:
    """Not null and without null or non-finite entries."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def scaled(v: np.ndarray) -> np.ndarray:
    """floor(1024 * entry) as int64."""
    with np.errstate(over="ignore"):
        z = np.floor(v * SCALE)
    return np.clip(z, -float(LIMIT), float(LIMIT)).astype(np.int64)


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Planes (one row for each bit of each column, 64 rows of ``y`` to a word) and the number of bits of each column."""
    bits = np.array([int(top).bit_length() for top in y.max(0)])
    first = np.r_[0, np.cumsum(bits)]
    turned = np.zeros((y.shape[1], -(-len(y) // 64) * 64), np.uint64)
    turned[:, :len(y)] = y.T
    planes = np.empty((first[-1], turned.shape[1] // 64), np.uint64)
    for b in range(bits.max(initial=0)):
        mine = np.flatnonzero(bits > b)
        on = (turned[mine] >> np.uint64(b) & np.uint64(1)).astype(np.uint8)
        planes[first[mine] + b] = np.packbits(on, axis=1, bitorder="little").view(np.uint64)
    return planes, bits


def scatter(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Column sums and sums of products of each two columns (upper half) as Python integers, exactly.

    Entries are shifted by their column's minimum. The number of rows in which bit a of one column and bit b of another are both
    set is the popcount of the AND of two planes; it weighs 2^(a+b).
    """
    n, d = z.shape
    low = z.min(0)
    planes, bits = bit_planes(z.view(np.uint64) - low.view(np.uint64)[None, :])
    wide = 2 * int(bits.max(initial=0)) + int(n).bit_length() > 62
    weight = np.array([1 << b for k in bits for b in range(k)], object if wide else np.int64)
    live = np.flatnonzero(bits)
    first = (np.cumsum(bits) - bits)[live]
    products = np.zeros((d, d), object)
    totals = np.zeros(d, object)
    for k, i in enumerate(live):
        begin, row = first[k], 0
        for a in range(bits[i]):
            both = np.bitwise_count(planes[begin + a] & planes[begin:]).sum(1, dtype=np.int64).astype(weight.dtype)
            row = row + np.add.reduceat(both * weight[begin:], first[k:] - begin) * (1 << a)
        products[i, live[k:]] = row.astype(object)
        totals[i] = int((np.bitwise_count(planes[begin:begin + bits[i]]).sum(1, dtype=np.int64).astype(object)
                         * weight[begin:begin + bits[i]].astype(object)).sum())
    low = low.astype(object)
    products = products + np.outer(low, totals) + np.outer(totals, low) + n * np.outer(low, low)
    return totals + n * low, products


def _limbs(value: int) -> list[int]:
    return [(value >> LIMB * k) & ((1 << LIMB) - 1) for k in range(LIMBS - 1)] + [value >> LIMB * (LIMBS - 1)]


def _vectors(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The vectors of a batch, those of one length together."""
    held = batch.column(0)
    flat, ends = held.flatten().to_numpy(zero_copy_only=False), np.asarray(held.offsets)
    ends = ends - ends[0]
    sizes = np.diff(ends)
    for d in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == d)
        yield flat[ends[at][:, None] + np.arange(d)]


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``d, i, j, l0..l3`` of a task: products of columns i and j, sums (i = -1), count (i = j = -1)."""
    done: dict[int, list] = {}
    waiting: dict[int, list[np.ndarray]] = {}

    def put(d: int, z: np.ndarray) -> None:
        sums, products = scatter(z)
        state = done.setdefault(d, [0, 0, 0])
        done[d] = [state[0] + len(z), state[1] + sums, state[2] + products]

    for batch in batches:
        for v in _vectors(batch):
            d = v.shape[1]
            rows = max(64, PLANE_BYTES * 8 // (16 * d) // 64 * 64)
            held = waiting.setdefault(d, [])
            held.append(scaled(v))
            while sum(map(len, held)) >= rows:
                whole = np.concatenate(held)
                put(d, whole[:rows])
                held[:] = [whole[rows:]]
    for d, held in waiting.items():
        if sum(map(len, held)):
            put(d, np.concatenate(held))
    for d, (n, sums, products) in done.items():
        at = [(-1, -1), *((-1, j) for j in range(d)), *((i, j) for i in range(d) for j in range(i, d))]
        limbs = [_limbs(v) for v in [n, *sums, *(products[i, j] for i, j in at[d + 1:])]]
        columns = [pa.array([d] * len(at), pa.int32()), *(pa.array(c, pa.int32()) for c in zip(*at)),
                   *(pa.array(c, pa.int64()) for c in zip(*limbs))]
        yield pa.RecordBatch.from_arrays(columns, names=["d", "i", "j", *(f"l{k}" for k in range(LIMBS))])


def solve(n: int, sums: list[int], products: dict[tuple[int, int], int], components: int = COMPONENTS) -> Whitening:
    """Components of the covariance (divisor n): n * products - sums * sums as integers, each divided once, then eigh."""
    d = len(sums)
    v = np.zeros((d, d))
    for (i, j), p in products.items():
        v[i, j] = v[j, i] = (n * p - sums[i] * sums[j]) / (n * n)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    e = np.where(e > d * np.finfo(float).eps * max(e[0], 0.0), e, 0.0)
    trace = float(np.trace(v))
    kept = e > 0
    error = None
    if kept.any():
        w = u[:, kept] / np.sqrt(e[kept])
        error = float(np.abs(w.T @ v @ w - np.eye(int(kept.sum()))).max())
    return Whitening(n, sums, u, e, [float(x) / trace if trace > 0 else None for x in e], error)


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitening]:
    """What ``whiten`` needs, for every length of vectors; runs a job over all usable vectors.

    Each task sums its own vectors' products from bit planes; Spark adds up d * (d + 1) / 2 exact sums, and those alone reach the driver.
    Vectors of different lengths are different spaces and are fitted apart; empty ones are in none.
    """
    held = rows.where(usable(F.col(vector))).select(F.col(vector).cast("array<double>").alias("v"))
    ddl = "d int, i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))
    found = held.mapInArrow(_partial_sums, ddl).groupBy("d", "i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)])
    values: dict[int, dict[tuple[int, int], int]] = {}
    for r in found.collect():
        values.setdefault(r.d, {})[r.i, r.j] = sum(r[f"l{k}"] << LIMB * k for k in range(LIMBS))
    return {d: solve(at[-1, -1], [at[-1, j] for j in range(d)], {k: p for k, p in at.items() if k[0] >= 0}, components)
            for d, at in values.items()}


def project(v: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Squared deviations, times n squared, as exact integers, and whitened coordinates (NaN on components without spread)."""
    z, n = scaled(v), model.n
    reach = n * int(max(abs(int(z.max())), abs(int(z.min())))) + max(map(abs, model.sums))
    if reach < 1 << 62:
        q = z * n - np.array(model.sums, np.int64)
    else:
        q = z.astype(object) * n - np.array(model.sums, object)
    exact = q if z.shape[1] * reach * reach < 1 << 63 else q.astype(object)
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(model.eigenvalues > 0, 1 / np.sqrt(model.eigenvalues), np.nan)
    return (exact * exact).sum(1), (q / n).astype(np.float64) @ model.components * scale


def whiten(rows: DataFrame, models: dict[int, Whitening], vector: str = "embedding", out: str = "whitening") -> DataFrame:
    """The usable rows with all columns and ``out``: struct ``n, deviation, whitened, explained, identity_error``.

    With x = floor(1024 * entry) + 100000 and S the sums of x over the fitted vectors: ``deviation`` (decimal(38,0), exact; null beyond it)
    sums (n * x - S)^2 over the dimensions; ``whitened`` holds x - S / n projected on each component over the root of its
    eigenvalue (null where the eigenvalue is zero: equal vectors, fewer vectors than components); ``explained`` is each
    eigenvalue's share of the trace (null where that is zero); ``identity_error`` is the largest absolute entry of the whitened
    covariance less the identity, over components with spread. REFERENCE cancels out in all of them. Rows whose vector is
    null or holds a null or non-finite entry go; vectors of a length without a model (empty ones) get empty arrays. Entries beyond
    2^62 / 1024 count as that. Repeated rows stay; a column already named ``out`` is replaced.
    """

    @F.pandas_udf("n long, high long, low long, whitened array<double>, explained array<double>, identity_error double")
    def made(vectors: pd.Series) -> pd.DataFrame:
        none = np.zeros(0)
        table = [(None, None, None, none, none, None)] * len(vectors)
        sizes = vectors.map(len).to_numpy()
        for d in np.unique(sizes):
            if (model := models.get(int(d))) is None:
                continue
            at = np.flatnonzero(sizes == d)
            deviation, whitened = project(np.stack([np.asarray(v, np.float64) for v in vectors.iloc[at]]), model)
            dead = ~(model.eigenvalues > 0)
            lists = [np.where(dead, None, w) for w in whitened] if dead.any() else list(whitened)
            for k, x, w in zip(at, deviation, lists):
                high, low = divmod(int(x), 10**18)
                big = high >= 10**18
                table[k] = (model.n, None if big else high, low, w, model.explained, model.identity_error)
        return pd.DataFrame(table, columns=["n", "high", "low", "whitened", "explained", "identity_error"])

    held = rows.where(usable(F.col(vector))).withColumn(out, made(F.col(vector).cast("array<double>")))
    at, big = F.col(out), "decimal(38,0)"
    exact = (at["high"].cast("decimal(18,0)") * F.lit(10**18).cast("decimal(19,0)") + at["low"].cast("decimal(18,0)")).cast(big)
    return held.withColumn(out, F.struct(
        at["n"].alias("n"), exact.alias("deviation"), at["whitened"].alias("whitened"), at["explained"].alias("explained"),
        at["identity_error"].alias("identity_error")))
