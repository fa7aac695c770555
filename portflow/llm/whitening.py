"""Whitening of embeddings: covariance by Spark, eigenvectors in single precision, mended in higher precision.

Passes over the vectors, each a sum that is combined by Spark: exact sums of every dimension, the covariance of the centred vectors,
the covariance of the whitened ones, and the rows themselves. What reaches the driver is one matrix of dimensions times dimensions,
whatever the number of vectors. There its eigenvectors are found in float32 and corrected by the iterations of Ogita and
Aishima, which are matrix products in extended precision: each about squares the error of vectors whose eigenvalues are told
apart. Eigenvalues that are not form clusters, and each cluster is solved again within its own subspace, whose matrix is
shifted by the cluster's middle so that its small differences are all that is left.

Vectors that are null, empty, or hold null or non-finite entries take no part; nor do those with entries of 2**50 or more, which have no
exact x, and those that have not the length that most have (of lengths as frequent, the longest). A null vec_id stays null,
repeated rows count each and give rows each, other columns are ignored. Without vectors there are no rows. A component on which nothing
varies (its eigenvalue is below 1e-12 of the trace) can't be whitened: `whitened` is null there, and it is left out of
identity_error, which is null if no component is left. A deviation that is too large for a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.llm.shared import checkpointed

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
#: Entries from here on are not taken; eigenvalues below this share of the trace are nought; rounds of mending at most, and
#: those that may pass without halving the error.
LARGEST, NOUGHT, ROUNDS, IDLE = 2.0**50, 1e-12, 30, 2
#: Rows that are turned at a time, so that a task needs memory for these only.
SLICE_ROWS = 4096

Rows = Iterator[tuple[pa.Array, np.ndarray]]


# ---------------------------------------------------------------- eigenvectors


def _norm(a: np.ndarray) -> float:
    """An upper bound of the spectral norm of a symmetric matrix."""
    return float(np.abs(a).sum(axis=1).max(initial=0.0))


def _mended(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One iteration on approximate eigenvectors x of a: better ones, their eigenvalues, and how close two of these may be to be one cluster."""
    r = np.eye(x.shape[1], dtype=x.dtype) - x.T @ x
    s = x.T @ (a @ x)
    value = np.diag(s) / (1 - np.diag(r))
    close = 2 * (_norm(s - np.diag(value)) + _norm(a) * _norm(r))
    gap = value[None, :] - value[:, None]
    told = np.abs(gap) > close
    e = np.where(told, (s + value[None, :] * r) / np.where(told, gap, 1), r / 2)
    return x + x @ e, value, close


def _clusters(value: np.ndarray, close: float) -> list[np.ndarray]:
    """Runs of eigenvalues whose neighbours are no further apart than `close`, of two at least."""
    order = np.argsort(value)
    cuts = np.flatnonzero(np.diff(value[order]) > close) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _solved_within(a: np.ndarray, x: np.ndarray, value: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """The cluster's vectors turned within their subspace. The shift takes off what they share, so that float64 tells the rest apart."""
    v = x[:, cluster]
    v = v + v @ (np.eye(len(cluster), dtype=x.dtype) - v.T @ v) / 2
    middle = value[cluster].mean()
    t = v.T @ (a @ v - middle * v)
    t = (t + t.T) / 2
    size = np.abs(t).max()
    if size == 0:
        return v
    turn = np.linalg.eigh((t / size).astype(np.float64))[1].astype(x.dtype)
    return v @ (turn + turn @ (np.eye(len(cluster), dtype=x.dtype) - turn.T @ turn) / 2)  # orthogonal beyond float64


def eigenvectors(a: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix from the largest on, and unit eigenvectors as columns, to double precision.

    The start is float32's; every product after it is in extended precision (numpy's longdouble).
    """
    a = np.asarray(a, np.longdouble)
    scale = np.abs(a).max(initial=0.0)
    if scale == 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = (a + a.T) / 2 / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    best, error, idle = x, np.inf, 0
    for _ in range(rounds):
        x, value, close = _mended(a, x)
        for cluster in _clusters(value, close):
            x[:, cluster] = _solved_within(a, x, value, cluster)
        s = x.T @ (a @ x)
        now = float(max(np.abs(s - np.diag(np.diag(s))).max(), np.abs(np.eye(len(a)) - x.T @ x).max()))
        idle = 0 if now < error / 2 else idle + 1
        if now < error:
            best, error = x, now
        if idle == IDLE:
            break
    best = best / np.sqrt((best * best).sum(axis=0))
    value = (best * (a @ best)).sum(axis=0) * scale
    order = np.argsort(-value, kind="stable")
    return value[order].astype(np.float64), best[:, order].astype(np.float64)


# ---------------------------------------------------------------- passes


def _whole_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, flat x, sizes, fit): a batch's vectors end to end, and which of them may take part."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            some = batch.slice(at, SLICE_ROWS)
            vectors = some.column("embedding")
            values = vectors.flatten()
            c = values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
            sizes = np.zeros(len(vectors), np.int64)
            known = vectors.is_valid().to_numpy(zero_copy_only=False)
            sizes[known] = vectors.value_lengths().drop_null().to_numpy()
            bad = ~(np.abs(c) < LARGEST)
            row = np.repeat(np.arange(len(sizes)), sizes)
            fit = (sizes > 0) & (np.bincount(row[bad], minlength=len(sizes)) == 0)
            x = np.floor(SCALE * np.where(bad, 0, c)).astype(np.int64) + SHIFT
            yield some.column("vec_id"), x, sizes, fit


def _of_length(batches: Iterator[pa.RecordBatch], d: int) -> Rows:
    for ids, x, sizes, fit in _whole_numbers(batches):
        keep = fit & (sizes == d)
        yield ids.filter(pa.array(keep)), x[np.repeat(keep, sizes)].reshape(-1, d)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, j, n, total): for each length of vectors the sums of their dimensions. Totals are exact: they travel as decimals."""
    found: dict[int, tuple[int, list[int]]] = {}
    for _, x, sizes, fit in _whole_numbers(batches):
        for d in np.unique(sizes[fit]).tolist():
            keep = fit & (sizes == d)
            rows = x[np.repeat(keep, sizes)].reshape(-1, d)
            high, low = rows >> 24, rows & 0xFFFFFF  # sums of either fit a long
            part = [(h << 24) + m for h, m in zip(high.sum(axis=0).tolist(), low.sum(axis=0).tolist(), strict=True)]
            n, before = found.get(d, (0, [0] * d))
            found[d] = n + len(rows), [a + b for a, b in zip(before, part, strict=True)]
    for d, (n, totals) in found.items():
        yield pa.record_batch({"d": pa.array([d] * d, pa.int32()), "j": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()), "total": [str(t) for t in totals]})


@dataclass(frozen=True)
class Centre:
    """n vectors of d dimensions and the exact sums of these."""

    n: int
    sums: tuple[int, ...]

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: longs if they fit, else Python's integers."""
        middle = [s // self.n for s in self.sums]
        y = x - np.array(middle, np.int64)
        rest = [s - self.n * m for s, m in zip(self.sums, middle, strict=True)]
        if (int(np.abs(y).max(initial=0)) + 1) * self.n < 2**63:
            return y * self.n - np.array(rest, np.int64)
        return y.astype(object) * self.n - np.array(rest, object)

    def deviations(self, differences: np.ndarray) -> pa.Array:
        """Sums of their squares over the dimensions, exact; null where they are too large for a long."""
        most = int(np.abs(differences).max(initial=0))
        if most * most * differences.shape[1] < 2**63:
            return pa.array((differences.astype(np.int64) ** 2).sum(axis=1))
        whole = (differences.astype(object) ** 2).sum(axis=1).tolist()
        return pa.array([v if v < 2**63 else None for v in whole], pa.int64())

    def centred(self, differences: np.ndarray) -> np.ndarray:
        """x - S / n to the last digit of a double."""
        return differences.astype(np.float64) / self.n


def _products(rows: Iterator[np.ndarray], d: int) -> Iterator[pa.RecordBatch]:
    """(i, j, value) of the sum of r r' over all r, i <= j, and j = -1 for the sums of r: one matrix a task."""
    total, sums = np.zeros((d, d)), np.zeros(d)
    for r in rows:
        total += r.T @ r
        sums += r.sum(axis=0)
    i, j = np.triu_indices(d)
    yield pa.record_batch({"i": pa.array(np.concatenate([i, np.arange(d)]).astype(np.int32)), "j": pa.array(np.concatenate([j, np.full(d, -1)]).astype(np.int32)), "value": np.concatenate([total[i, j], sums])})


def _covariance(vectors: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], d: int, n: int) -> np.ndarray:
    """The covariance of what run makes products of. One matrix of d times d reaches the driver."""
    parts = vectors.mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    total, mean = np.zeros((d, d)), np.zeros(d)
    for p in parts:
        if p["j"] < 0:
            mean[p["i"]] = p["value"] / n
        else:
            total[p["i"], p["j"]] = total[p["j"], p["i"]] = p["value"] / n
    return total - np.outer(mean, mean)  # the vectors are centred already: the mean is what rounding leaves


@dataclass(frozen=True)
class Whitener:
    """What whitening needs to know: small, and fit on all vectors."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    def turned(self) -> np.ndarray:
        """Component vectors over the square root of their eigenvalue; those of nought are nought."""
        return self.vectors / np.sqrt(np.where(self.values > 0, self.values, np.inf))


def _vectors(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))


def fit(embeddings: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Centre, components and their check, from all vectors. None if there are none."""
    vectors = _vectors(embeddings)
    totals = vectors.mapInArrow(_sums, "d int, j int, n long, total string").groupBy("d", "j").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    totals = checkpointed(totals)  # a row for each dimension of each length
    most = totals.where("j = 0").orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        return None
    d, n = most["d"], most["n"]
    centre = Centre(n, tuple(int(r["total"]) for r in totals.where(F.col("d") == d).orderBy("j").collect()))  # d rows

    def centred(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        return (centre.centred(centre.differences(x)) for _, x in _of_length(batches, d))

    covariance = _covariance(vectors, lambda batches: _products(centred(batches), d), d, n)
    values, found = eigenvectors(covariance)
    trace, k = float(np.trace(covariance)), min(components, d)
    values, found = values[:k], found[:, :k]
    whitener = Whitener(centre, np.where(values > NOUGHT * trace, values, 0), found, values / trace if trace else np.zeros(k))
    turned, live = whitener.turned(), int((whitener.values > 0).sum())
    if not live:
        return whitener
    turned = turned[:, :live]
    unit = _covariance(vectors, lambda batches: _products((z @ turned for z in centred(batches)), live), live, n)
    return Whitener(centre, whitener.values, found, whitener.explained, float(np.abs(unit - np.eye(live)).max()))


def whiten(embeddings: DataFrame, whitener: Whitener) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    centre, turned, k = whitener.centre, whitener.turned(), len(whitener.values)
    live = whitener.values > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _of_length(batches, len(centre.sums)):
            rows, differences = len(x), centre.differences(x)
            each = pa.array(np.repeat(np.arange(rows), k))
            whitened = centre.centred(differences) @ turned
            yield pa.record_batch(
                {
                    "vec_id": ids.take(each), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), "n": pa.array(np.full(rows * k, centre.n, np.int64)),
                    "deviation": centre.deviations(differences).take(each), "whitened": pa.array(whitened.ravel(), mask=np.tile(~live, rows)),
                    "explained": pa.array(np.tile(whitener.explained, rows)), "identity_error": pa.array([whitener.identity_error] * (rows * k), pa.float64()),
                }
            )

    return _vectors(embeddings).mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitened_rows(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    whitener = fit(embeddings, components)
    if whitener is None:  # a whitener of no dimensions, for no rows
        whitener = Whitener(Centre(1, ()), np.zeros(0), np.zeros((0, 0)), np.zeros(0))
        return whiten(embeddings.where("false"), whitener)
    return whiten(embeddings, whitener)
