"""Whitening of vectors by an incremental eigendecomposition.

Every task keeps the mean and the eigenpairs of the scatter of its rows so far. A block of rows is centred on
its own mean and turned by an orthogonal map into at most d rows of the same scatter; each of these, and the
difference of the two means, is one rank-one update of the eigenpairs: components that don't take part are
deflated, the secular equation gives the new eigenvalues, and the eigenvectors follow from weights recomputed
from these, which keeps them orthogonal. The tasks' spectra are combined in rounds, some at a time, by
successive rank-one updates with each other's eigenpairs. One pass over all rows then forms the covariance in the
basis found, whose small eigenproblem (Rayleigh-Ritz) refines values and vectors to double precision.

Rows are vectors of whole numbers (`whole` makes them of embeddings); sums are exact, and rows are centred
before anything is multiplied. What reaches the driver are d x d matrices.

Defined cases: a null vector, one without components or with a null or non-finite one is dropped, a null id
is kept; vectors of different lengths are separate spaces, each with its own fit; components along which the
rows don't vary have a null result and take no part in the identity error; with fewer components than asked, all are given; equal
eigenvalues (ties) have vectors in any basis of their space, the same one for all rows; equal rows count each
and give equal rows; a deviation beyond 64 bits is null; an empty table gives an empty result; further columns are not passed on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetday.sources.tables import stage

#: Spectra that one task combines in a round.
FAN_IN = 16
_EPS = np.finfo(float).eps
#: Shares of the largest eigenvalue below which rows don't vary.
_FLAT = 1e-12


def usable(vector: Column) -> Column:
    """At least one component, and every one finite."""
    v = vector.cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce(~F.exists(v, bad) & (F.size(v) > 0), F.lit(False))


def whole(vector: Column, scale: int = 1024, shift: int = 100_000) -> Column:
    """floor(scale * c) + shift of every component c, as long; at most 2**40 either way, so that sums hold."""
    most = F.lit(float(1 << 40))
    cut = lambda c: F.greatest(-most, F.least(most, F.floor(F.greatest(-most, F.least(most, c * scale))) + F.lit(float(shift))))
    return F.transform(vector.cast("array<double>"), lambda c: cut(c).cast("long"))


def _secular(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z2 / (d - x) for rising, different d: (nearest pole, distance from it) of each root."""
    k = len(d)
    room = np.append(d[1:], d[-1] + z2.sum()) - d
    below = np.arange(k)
    gap = d[None, :] - d[:, None]  # gap[i, j]: pole j seen from pole i
    middle = 1 + (z2 / (gap - room[:, None] / 2)).sum(1)
    # left of the root the function is negative: the origin is the pole nearer to the root
    upper = (middle < 0) & (below < k - 1)
    origin = np.where(upper, below + 1, below)
    low, high = np.where(upper, -room / 2, 0.0), np.where(upper, 0.0, room / 2)
    last = k - 1
    if middle[last] < 0:
        low[last], high[last] = room[last] / 2, room[last]
    seen = d[None, :] - d[origin][:, None]
    for _ in range(110):
        # halving the exponent first finds roots that lie very near to their pole
        a, b = np.abs(low), np.abs(high)
        near, far = np.minimum(a, b), np.maximum(a, b)
        step = np.where(near < far / 4, np.sqrt(np.maximum(near, far * 1e-30) * far), (near + far) / 2)
        x = np.where(upper, -step, step)
        with np.errstate(divide="ignore", over="ignore"):
            value = 1 + (z2 / (seen - x[:, None])).sum(1)
        low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
        if (np.abs(high - low) <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high))).all():
            break
    x = np.where(np.abs(low) > 0, np.where(np.abs(high) > 0, (low + high) / 2, low), high)
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs (rising values, vectors in columns) of vectors diag(values) vectors' + row row'."""
    z = vectors.T @ row
    total = z @ z
    if not total > 0:
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    scale = max(abs(values[-1]), total)
    # deflation: directions that the row doesn't touch, and all but one of nearly equal values
    live = np.abs(z) * np.sqrt(total) > 4 * _EPS * scale
    at = np.flatnonzero(live)
    for i, j in zip(at[:-1], at[1:]):
        if values[j] - values[i] <= 8 * _EPS * scale:
            r = np.hypot(z[i], z[j])
            c, s = z[j] / r, z[i] / r
            vectors[:, i], vectors[:, j] = c * vectors[:, i] - s * vectors[:, j], s * vectors[:, i] + c * vectors[:, j]
            z[i], z[j], live[i] = 0.0, r, False
    at = np.flatnonzero(live)
    if not len(at):
        return values, vectors
    d = values[at]
    origin, x = _secular(d, z[at] ** 2)
    apart = d[:, None] - d[origin][None, :] - x[None, :]  # pole i less root j
    # weights for which the roots found are exact
    poles = d[:, None] - d[None, :]
    np.fill_diagonal(poles, 1.0)
    quotient = -apart[:, :-1] / np.where(np.arange(len(at))[None, :-1] < np.arange(len(at))[:, None], poles[:, :-1], poles[:, 1:])
    weight = np.sqrt(np.abs(np.prod(quotient, axis=1) * apart[:, -1])) * np.sign(z[at])
    turned = weight[:, None] / apart
    turned /= np.sqrt((turned * turned).sum(0))
    vectors[:, at] = vectors[:, at] @ turned
    values[at] = d[origin] + x
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number, exact sum and eigenpairs of the scatter around the mean of some rows of whole numbers."""

    n: int
    total: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of_none(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size, np.int64), np.zeros(size), np.eye(size))

    def add(self, n: int, total: np.ndarray, centred: Iterable[np.ndarray]) -> None:
        """Take in n rows of this sum, given rows with their scatter around their own mean."""
        for row in centred:
            self.values, self.vectors = rank_one(self.values, self.vectors, row)
        if self.n and n:
            apart = _mean(total, n) - _mean(self.total, self.n)
            self.values, self.vectors = rank_one(self.values, self.vectors, apart * np.sqrt(self.n / (self.n + n) * n))
        self.n, self.total = self.n + n, self.total + total

    def add_rows(self, x: np.ndarray) -> None:
        total = x.sum(0)
        self.add(len(x), total, np.linalg.qr(x - _mean(total, len(x)), mode="r"))

    def join(self, other: Spectrum) -> None:
        self.add(other.n, other.total, (other.vectors * np.sqrt(np.maximum(other.values, 0))).T[::-1])


def _mean(total: np.ndarray, n: int) -> np.ndarray:
    whole_part = total // n  # sums may be longer than a double's digits
    return whole_part + (total - whole_part * n) / n


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, rows) of the vectors of each length."""
    ids, lists = batch.columns
    flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    sizes = np.diff(offsets)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield ids.take(pa.array(at)), flat[offsets[at][:, None] + np.arange(size)]


_SPECTRUM = "size int, part long, n long, total array<long>, values array<double>, vectors array<double>"


def _spectra(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, Spectrum] = {}
    for batch in batches:
        for _, x in _by_size(batch):
            found.setdefault(x.shape[1], Spectrum.of_none(x.shape[1])).add_rows(x)
    rows = [(k, TaskContext.get().partitionId(), s.n, s.total, s.values, s.vectors.ravel()) for k, s in found.items()]
    if rows:
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64())]
        names = ["size", "part", "n", "total", "values", "vectors"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)


def _spectrum(row) -> Spectrum:
    size = len(row.total)
    return Spectrum(int(row.n), np.array(row.total, np.int64), np.array(row.values, float), np.array(row.vectors, float).reshape(size, size))


def _combine(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    parts = [_spectrum(r) for r in rows.itertuples(index=False)]
    for other in parts[1:]:
        parts[0].join(other)
    s = parts[0]
    return pd.DataFrame({"size": [len(s.total)], "part": [rows["group"].iloc[0]], "n": [s.n], "total": [s.total], "values": [s.values], "vectors": [s.vectors.ravel()]})


def spectra(rows: DataFrame) -> dict[int, Spectrum]:
    """The spectrum of all rows (id, x) of each length."""
    parts = stage(rows.mapInArrow(_spectra, _SPECTRUM), "spectra")
    while (most := parts.groupBy("size").count().agg(F.max("count")).first()[0] or 0) > 1:
        # parts are numbered anew, so that a round leaves a FAN_IN-th of them
        group = F.expr(f"part div {FAN_IN}") if most > FAN_IN else F.lit(0).cast("long")
        grouped = parts.withColumn("group", group)
        parts = stage(grouped.groupBy("size", "group").applyInPandas(_combine, _SPECTRUM), "spectra")
    return {r["size"]: _spectrum(r) for r in parts.collect()}


def _sums(rows: DataFrame, of) -> dict[int, np.ndarray]:
    """Per length the sum over all rows of `of(x, size)`, a vector: added up in tasks, then by place in it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _by_size(batch):
                size = x.shape[1]
                found[size] = found.get(size, 0) + of(x, size)
        for size, v in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(v), size, np.int32)), pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)], names=["size", "at", "v"]
            )

    summed = rows.mapInArrow(run, "size int, at int, v double").groupBy("size", "at").agg(F.sum("v").alias("v")).collect()
    out: dict[int, np.ndarray] = {}
    for size in {r["size"] for r in summed}:
        out[size] = np.array([r["v"] for r in sorted((r for r in summed if r["size"] == size), key=lambda r: r["at"])])
    return out


@dataclass(frozen=True)
class Whitener:
    """The fit of one length: exact counts, the mean, and what maps centred rows to whitened ones."""

    n: int
    total: np.ndarray
    mean: np.ndarray
    values: np.ndarray  # falling
    explained: np.ndarray
    matrix: np.ndarray  # size x components; nan where the rows don't vary


def fit(rows: DataFrame, components: int = 8) -> dict[int, Whitener]:
    """Whiteners of all rows (id, x), by length."""
    found = spectra(rows)
    basis = {size: (_mean(s.total, s.n), s.vectors[:, ::-1]) for size, s in found.items()}

    def projected(x: np.ndarray, size: int) -> np.ndarray:
        y = (x - basis[size][0]) @ basis[size][1]
        return (y.T @ y).ravel()

    out = {}
    for size, ritz in _sums(rows, projected).items():
        s, (mean, vectors) = found[size], basis[size]
        ritz = ritz.reshape(size, size) / s.n
        e, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        e, vectors = e[::-1], (vectors @ turn)[:, ::-1]
        flat = e <= _FLAT * max(e[0], 0)
        spread = np.sqrt(np.where(flat, np.nan, e))
        trace = e.sum()
        out[size] = Whitener(s.n, s.total, mean, e, e / trace if trace > 0 else np.zeros(size), (vectors / spread)[:, :components])
    return out


def identity_errors(rows: DataFrame, fitted: dict[int, Whitener]) -> dict[int, float]:
    """Per length the largest entry of the whitened rows' covariance less the identity."""

    def moments(x: np.ndarray, size: int) -> np.ndarray:
        w = fitted[size]
        y = (x - w.mean) @ w.matrix[:, ~np.isnan(w.matrix[0])]
        return np.concatenate([(y.T @ y).ravel(), y.sum(0)])

    out = dict.fromkeys(fitted, 0.0)
    for size, v in _sums(rows, moments).items():
        k = int((~np.isnan(fitted[size].matrix[0])).sum())
        first = v[k * k :] / fitted[size].n
        covariance = v[: k * k].reshape(k, k) / fitted[size].n - np.outer(first, first)
        out[size] = float(np.abs(covariance - np.eye(k)).max())
    return out


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """Sum over components of (n * x - total) ** 2, exact; null beyond 64 bits."""
    if n * (int(np.abs(x).max(initial=0)) + 1) >= 1 << 62:
        exact = ((n * x.astype(object) - total.astype(object)) ** 2).sum(1)
    else:
        # squares of 24-bit halves, so that no sum of them overflows
        d = np.abs(n * x - total)
        if int(d.max(initial=0)) >= 1 << 48:
            exact = (d.astype(object) ** 2).sum(1)
        else:
            high, low = d >> 24, d & 0xFFFFFF
            parts = zip((high * high).sum(1).tolist(), (high * low).sum(1).tolist(), (low * low).sum(1).tolist())
            exact = [(a << 48) + (b << 25) + c for a, b, c in parts]
    return [int(v) if v < 1 << 63 else None for v in exact]


_OUT = pa.schema(
    [("id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()),
     ("explained", pa.float64()), ("identity_error", pa.float64())]
)


def apply(rows: DataFrame, fitted: dict[int, Whitener], errors: dict[int, float]) -> DataFrame:
    """One row per vector and component."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _by_size(batch):
                w = fitted[x.shape[1]]
                k = w.matrix.shape[1]
                white = ((x - w.mean) @ w.matrix).ravel()
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(each), w.n)), pa.array(deviations(x, w.n, w.total), pa.int64()).take(pa.array(each)),
                     pa.array(white, mask=np.isnan(white)), pa.array(np.tile(w.explained[:k], len(x))),
                     pa.array(np.full(len(each), errors[x.shape[1]]))],
                    schema=_OUT,
                )

    return rows.mapInArrow(run, "id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 8) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every usable vector."""
    rows = vectors.where(usable(F.col(embedding))).select(F.col(vec_id).cast("long").alias("id"), whole(F.col(embedding)).alias("x"))
    fitted = fit(rows, components)
    return apply(rows, fitted, identity_errors(rows, fitted))
