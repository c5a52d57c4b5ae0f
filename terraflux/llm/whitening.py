"""Embedding whitening by incremental eigendecomposition.

Each partition keeps the eigendecomposition of its own scatter and adds a row to it as a centred rank-one update: the
new eigenvalues are the roots of the secular equation, after entries without influence and equal eigenvalues have been
deflated. Spectra of partitions are combined, sixteen at a time, by one such update for each of the other's
eigenvectors and one for the distance of the means. What is left is a basis of d vectors; a pass over all rows projects
the covariance on it, and the eigenvectors of that small matrix are the components, to double precision, whatever the
updates have lost. A task holds one spectrum (d * d doubles, and sixteen when they are combined), the driver one.

Vectors are integers here, x = floor(1024 * c) + 100000, so that their number, sums and deviations are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm.common import cut, table

SCALE, OFFSET = 1024, 100_000
#: Entries from here on count as not finite: sums of their integers would not be exact.
TOO_LARGE = 2.0**30
COMPONENTS = 8
#: Spectra that a task combines at a time.
FAN_IN = 16
EPS = np.finfo(float).eps


@dataclass
class Spectrum:
    """Of the vectors seen: their number, their mean, and the scatter around it as ascending values and their vectors (columns)."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(d: int) -> Spectrum:
        return Spectrum(0, np.zeros(d), np.zeros(d), np.eye(d))

    def add(self, row: np.ndarray) -> None:
        off = row - self.mean
        self.n += 1
        self.mean = self.mean + off / self.n
        self._rank_one((self.n - 1) / self.n, off)

    def merge(self, other: Spectrum) -> None:
        off, n = other.mean - self.mean, self.n + other.n
        for k in np.flatnonzero(other.values > EPS * other.values[-1] * len(other.values)) if other.n > 1 else ():
            self._rank_one(other.values[k], other.vectors[:, k])
        self._rank_one(self.n * other.n / n, off)
        self.mean, self.n = self.mean + off * (other.n / n), n

    def _rank_one(self, weight: float, v: np.ndarray) -> None:
        """Adds weight * v v' to the scatter."""
        z = v @ self.vectors
        rho, size = weight * (z @ z), np.sqrt(z @ z)
        if not rho > 0:
            return
        z /= size
        tol = 8 * EPS * max(self.values[-1], rho)
        edges = np.flatnonzero(np.diff(self.values, prepend=-np.inf, append=np.inf) > tol)
        for a, b in zip(edges[:-1], edges[1:]):  # equal values: a reflection leaves one of them with all of z
            part = z[a:b]
            if b - a > 1 and np.any(part[:-1]):
                whole = np.copysign(np.linalg.norm(part), part[-1])
                u = part.copy()
                u[-1] += whole
                self.vectors[:, a:b] -= np.outer(self.vectors[:, a:b] @ u, u * (2 / (u @ u)))
                part[:] = 0
                part[-1] = -whole
        at = np.flatnonzero(rho * np.abs(z) > tol)
        if not len(at):
            return
        self.values[at], turn = secular(self.values[at], z[at], rho)
        self.vectors[:, at] = self.vectors[:, at] @ turn
        order = np.argsort(self.values, kind="stable")
        self.values, self.vectors = self.values[order], self.vectors[:, order]


def secular(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of diag(d) + rho z z': d ascends without equals, z has no zeros.

    Each root of 1 + rho sum(z^2 / (d - t)) lies between two poles and is sought as its distance from the nearer one, by
    interpolation with both poles, or by halving where that leaves the bracket. The vectors are those of the z for
    which the roots found are exact, so that they are orthogonal however close the roots lie.
    """
    k, w = len(d), rho * z * z
    gap = np.append(np.diff(d), w.sum())
    diff = d[:, None] - d[None, :]
    middle = 1 + (w[:, None] / (diff - gap / 2)).sum(0)
    right = (middle < 0) & (np.arange(k) < k - 1)
    origin = np.arange(k) + right
    poles = d[:, None] - d[origin][None, :]
    low, high = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, np.where(np.arange(k) < k - 1, gap / 2, gap))
    tau = (low + high) / 2
    below = np.arange(k)[:, None] <= np.arange(k)[None, :]
    left_pole, right_pole = poles.diagonal(), np.append(poles.diagonal(-1), np.inf)
    last = k - 1
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(120):
            away = poles - tau
            term = w[:, None] / away
            f = 1 + term.sum(0)
            done = (np.abs(f) <= 4 * k * EPS * (1 + np.abs(term).sum(0))) | (high - low <= 2 * EPS * np.abs(tau))
            if done.all():
                break
            low, high = np.where(f < 0, tau, low), np.where(f < 0, high, tau)
            slope = term / away
            psi = (slope * below).sum(0)
            phi = slope.sum(0) - psi
            p, q = left_pole - tau, right_pole - tau
            a, b, c = (p + q) * f - p * q * (psi + phi), p * q * f, f - p * psi - q * phi
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[last] = p[last] + p[last] ** 2 * psi[last] / (f[last] - p[last] * psi[last])
            new = tau + step
            tau = np.where(done, tau, np.where((new > low) & (new < high), new, (low + high) / 2))
    away = poles - tau
    np.fill_diagonal(diff, -1.0)
    size = np.sqrt(np.abs((away / diff).prod(1)))
    turn = np.copysign(size, z)[:, None] / away
    return d[origin] + tau, turn / np.linalg.norm(turn, axis=0)


def _integers(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors of d finite entries, and those as integers."""
    ok = pc.fill_null(pc.equal(pc.list_value_length(column), d), False)
    entries = column.filter(ok).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    usable = (np.abs(entries) < TOO_LARGE).all(1)
    which = np.asarray(ok.to_numpy(zero_copy_only=False), bool).copy()
    which[which] = usable
    return which, np.floor(SCALE * entries[usable]).astype(np.int64) + OFFSET


@dataclass(frozen=True)
class Centre:
    """Number, dimension and exact sums of all vectors."""

    n: int
    sums: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n with the large part taken off in integers."""
        return (x - self.whole) - np.array([s % self.n for s in self.sums], float) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sum of (n * x - S)^2 of each row; null beyond 64 bits."""
        off, rest = x - self.whole, [s % self.n for s in self.sums]
        most = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if len(self.sums) * most * most < 2**63:
            return ((self.n * off - np.array(rest, np.int64)) ** 2).sum(1).tolist()
        exact = (sum((self.n * v - r) ** 2 for v, r in zip(row, rest)) for row in off.tolist())
        return [v if v < 2**63 else None for v in exact]


@dataclass(frozen=True)
class Whitening:
    """values: the largest eigenvalues of the covariance, falling; basis: their unit vectors as columns; error: of the whitened covariance."""

    centre: Centre
    values: np.ndarray
    basis: np.ndarray
    trace: float
    error: float | None = None

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; NaN in components without variance."""
        zero = self.values <= EPS * len(self.basis) * self.values.max(initial=0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(zero, np.nan, (self.centre.centred(x) @ self.basis) / np.sqrt(np.where(zero, 1.0, self.values)))


def _sums(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, x = _integers(batch.column(0), d)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array(x.sum(0), pa.int64()), pa.array(np.full(d, len(x)), pa.int64())], ["dim", "s", "n"])


def _packed(part: int, s: Spectrum) -> pa.RecordBatch:
    doubles = [pa.array([v.reshape(-1)], pa.list_(pa.float64())) for v in (s.mean, s.values, s.vectors)]
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([s.n], pa.int64()), *doubles], ["part", "n", "mean", "values", "vectors"])


def _unpacked(row: dict) -> Spectrum:
    mean, values, vectors = (np.array(row[c], float) for c in ("mean", "values", "vectors"))
    return Spectrum(row["n"], mean, values, vectors.reshape(len(mean), -1))


_SPECTRUM = "part int, n long, mean array<double>, values array<double>, vectors array<double>"


def _spectra(batches: Iterator[pa.RecordBatch], centre: Centre) -> Iterator[pa.RecordBatch]:
    found, part = Spectrum.empty(len(centre.sums)), None
    for batch in batches:
        if batch.num_rows:
            part = batch.column(1)[0].as_py()
        for row in centre.centred(_integers(batch.column(0), len(centre.sums))[1]):
            found.add(row)
    if found.n:
        yield _packed(part, found)


def _merged(rows: pa.Table) -> pa.Table:
    own = sorted(rows.to_pylist(), key=lambda r: r["part"])  # FAN_IN of them at most
    whole = _unpacked(own[0])
    for row in own[1:]:
        whole.merge(_unpacked(row))
    return pa.Table.from_batches([_packed(own[0]["part"] // FAN_IN, whole)])


def _combined(spectra: DataFrame) -> np.ndarray:
    """The vectors of all partitions' spectra combined, FAN_IN by FAN_IN."""
    parts = spectra.agg(F.max("part")).first()[0]
    while parts:
        spectra = cut(spectra.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(_merged, _SPECTRUM), "whitening-merged")
        parts //= FAN_IN
    return _unpacked(spectra.first().asDict()).vectors


def _products(batches: Iterator[pa.RecordBatch], centre: Centre, basis: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The partition's sum of y y', y being its centred vectors in the basis, as (cell, v)."""
    sums = np.zeros((basis.shape[1],) * 2)
    for batch in batches:
        y = centre.centred(_integers(batch.column(0), len(centre.sums))[1]) @ basis
        sums += y.T @ y
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size), pa.int64()), pa.array(sums.reshape(-1))], ["cell", "v"])


def _covariance(vectors: DataFrame, centre: Centre, basis: np.ndarray) -> np.ndarray:
    """basis' V basis over all vectors; cells are summed by Spark, and the driver gets one matrix."""
    cells = vectors.mapInArrow(partial(_products, centre=centre, basis=basis), "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(basis.shape[1] ** 2)
    out[cells["cell"].to_numpy()] = cells["v"].to_numpy()
    return out.reshape((basis.shape[1],) * 2) / centre.n


def dimension(rows: DataFrame, vector: str) -> int:
    """The length that most vectors of finite entries have, the longer one of a tie; 0 without any."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < TOO_LARGE))
    sizes = rows.filter(F.col(vector).isNotNull() & finite).groupBy(F.size(vector).alias("d")).count()
    first = sizes.filter("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def fit(rows: DataFrame, *, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of rows' vectors; None if there is none.

    Rows take no part whose vector is null, holds null or non-finite entries (those of 2^30 and more count as such) or
    has another length than most. Equal vectors count each; sign: the largest entry of a component is positive.
    """
    vectors, d = rows.select(F.col(vector).alias("v")), dimension(rows, vector)
    if not d:
        return None
    sums = vectors.mapInArrow(partial(_sums, d=d), "dim int, s long, n long").groupBy("dim").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s"), F.sum("n").alias("n")).orderBy("dim").collect()
    centre = Centre(sums[0]["n"], tuple(int(r["s"]) for r in sums))  # a row for each dimension
    spectra = cut(vectors.select("v", F.spark_partition_id().alias("part")).mapInArrow(partial(_spectra, centre=centre), _SPECTRUM), "whitening-spectra")
    basis, _ = np.linalg.qr(_combined(spectra))
    ritz = _covariance(vectors, centre, basis)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    found = basis @ turn[:, ::-1][:, :components]
    found *= np.sign(found[np.abs(found).argmax(0), np.arange(found.shape[1])])
    model = Whitening(centre, np.maximum(values[::-1][:components], 0.0), found, float(np.trace(ritz)))
    white = model.basis / np.sqrt(np.where(model.values > EPS * d * values.max(), model.values, np.inf))
    off = np.abs(_covariance(vectors, centre, white) - np.diag(white.any(0).astype(float)))
    return Whitening(centre, model.values, model.basis, model.trace, float(off.max()))


def _whitened(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        which, x = _integers(batch.column(1), len(model.centre.sums))
        white = model.project(x)
        yield pa.RecordBatch.from_arrays([
            batch.column(0).filter(pa.array(which)), pa.array(model.centre.deviation(x), pa.int64()),
            pa.FixedSizeListArray.from_arrays(pa.array(white.reshape(-1), mask=np.isnan(white.reshape(-1))), white.shape[1]).cast(pa.list_(pa.float64())),
        ], ["id", "deviation", "whitened"])


def whiten(rows: DataFrame, model: Whitening | None, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per row of `rows` with a usable vector (see fit()): id, deviation long, whitened array<double>.

    whitened is null in components without variance, as of one vector alone; deviation is null beyond 64 bits. A null
    key stays; repeated rows are rows of their own; without a model, as of an empty table, the result is empty.
    """
    schema = f"id {rows.schema[key].dataType.simpleString()}, deviation long, whitened array<double>"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    return rows.select(key, vector).mapInArrow(partial(_whitened, model=model), schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    model = fit(rows)
    explained = [float(v / model.trace) if model.trace else None for v in model.values] if model else []
    return whiten(rows, model).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), F.lit(model.centre.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*[F.lit(v) for v in explained]).cast("array<double>"), F.col("at")).alias("explained"), F.lit(model.error if model else None).cast("double").alias("identity_error"),
    )
