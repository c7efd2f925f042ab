"""Whitening of embeddings by incremental eigendecomposition.

Method.  Every partition reads its vectors once and keeps the eigendecomposition of
its scatter matrix: each vector, centred by the mean so far, is a rank-one update,
solved by its secular equation with deflation (``spectra``).  Two partitions' spectra
are combined by the second one's eigenpairs and the difference of the means, again
as rank-one updates, in rounds of ``FAN`` states a task.  A Rayleigh-Ritz step ends
it: one more pass projects all vectors, centred by the exact mean, on the basis found,
sums the products, and the eigenvectors of that small matrix turn the basis.  So the
result is that of the covariance itself to double precision, whatever rounding the
updates have gathered.

Vectors are whole numbers here, x = floor(1024 c) + 100000.  Counts and sums are exact
at every size (sums in two parts of 32 bits), and x - S / n is taken as the whole number
x - floor(S / n) less the rest, so nothing is lost by cancellation.

What moves between tasks and to the driver is d * d numbers a partition, d the length
of the vectors, and one such state at last.  Vectors are never shuffled.

Defined results: rows are left out whose vector is null, empty, or has null or
non-finite entries, and those of another length than most rows have (of two such
lengths the larger counts); 1024 c is held within +-2**61; a null or repeated vec_id
is a row like any other; a vector that a third of all rows share is as many updates;
components are numbered 1 to min(8, d), the largest entry by size of each is
positive; a component without variance (to rounding) has null for its whitened
values, and counts neither in the error; ``deviation`` beyond a long is null; an
empty table gives no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written
from .spectra import EPS, add_rank_one

COMPONENTS = 8
SCALE, SHIFT = 1024.0, 100000
#: Partitions' states that one task combines.
FAN = 8
LIMIT = 1 << 61
STATE = "id long, n long, whole array<long>, reals array<double>"


def valid_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, vector of doubles) of the rows that remain, and the vectors' length (0: none remain)."""
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.filter(F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & (F.size("vector") > 0))
    most = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return (rows.filter(F.size("vector") == most.d), most.d) if most else (rows, 0)


def whole_numbers(column: pa.Array, d: int) -> np.ndarray:
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * c), -LIMIT, LIMIT).astype(np.int64) + SHIFT


class Mean:
    """Exact count and sums: n, and S = high * 2**32 + low per dimension."""

    def __init__(self, n: int, high: np.ndarray, low: np.ndarray):
        self.n, self.high, self.low = n, high + (low >> 32), low & 0xFFFFFFFF

    @classmethod
    def of(cls, x: np.ndarray) -> Mean:
        return cls(len(x), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))

    def __add__(self, other: Mean) -> Mean:
        return Mean(self.n + other.n, self.high + other.high, self.low + other.low)

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        """floor(S / n) and the rest S mod n, both exact."""
        both = [divmod((int(h) << 32) + int(w), self.n) for h, w in zip(self.high, self.low)]
        return np.array([b[0] for b in both], np.int64), np.array([b[1] for b in both], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        q, r = self.parts()
        return (x - q).astype(float) - r / self.n

    def less(self, other: Mean) -> np.ndarray:
        (q, r), (p, s) = self.parts(), other.parts()
        return (q - p).astype(float) + (r / self.n - s / other.n)


class Spectrum:
    """A scatter matrix about its own mean, as eigenvalues (rising) and eigenvectors."""

    def __init__(self, mean: Mean, values: np.ndarray, vectors: np.ndarray):
        self.mean, self.values, self.vectors = mean, values, vectors

    @classmethod
    def of_batches(cls, batches, d: int) -> Spectrum | None:
        total, first, at, n = None, None, np.zeros(d), 0
        values, vectors = np.zeros(d), np.eye(d)
        for x in batches:
            if not len(x):
                continue
            total, first = (Mean.of(x), x[0]) if total is None else (total + Mean.of(x), first)
            for y in (x - first).astype(float):
                apart = y - at
                if n:
                    values, vectors = add_rank_one(values, vectors, apart, n / (n + 1))
                n += 1
                at = at + apart / n
        return cls(total, values, vectors) if n else None

    def __add__(self, other: Spectrum) -> Spectrum:
        values, vectors = self.values, self.vectors
        for size, v in zip(other.values, other.vectors.T):
            if size > 0:
                values, vectors = add_rank_one(values, vectors, v, size)
        n, m = self.mean.n, other.mean.n
        values, vectors = add_rank_one(values, vectors, self.mean.less(other.mean), n * (m / (n + m)))
        return Spectrum(self.mean + other.mean, values, vectors)

    def row(self) -> tuple:
        return self.mean.n, np.concatenate([self.mean.high, self.mean.low]), np.concatenate([self.values, self.vectors.ravel()])

    @classmethod
    def from_row(cls, n: int, whole, reals) -> Spectrum:
        whole, reals = np.asarray(whole, np.int64), np.asarray(reals, float)
        d = len(whole) // 2
        return cls(Mean(int(n), whole[:d], whole[d:]), reals[:d], reals[d:].reshape(d, d))


class Products:
    """n, mean and centred sums of products of rows of reals; exact means of no use here are zero."""

    def __init__(self, n: int, mean: np.ndarray, scatter: np.ndarray):
        self.n, self.mean, self.scatter = n, mean, scatter

    @classmethod
    def of(cls, y: np.ndarray, centre: bool) -> Products:
        mean = y.mean(axis=0) if centre else np.zeros(y.shape[1])
        return cls(len(y), mean, (y - mean).T @ (y - mean))

    def __add__(self, other: Products) -> Products:
        n = self.n + other.n
        apart = other.mean - self.mean
        return Products(n, self.mean + apart * (other.n / n), self.scatter + other.scatter + np.outer(apart, apart) * (self.n * (other.n / n)))

    def row(self) -> tuple:
        return self.n, np.zeros(0, np.int64), np.concatenate([self.mean, self.scatter.ravel()])

    @classmethod
    def from_row(cls, n: int, whole, reals) -> Products:
        reals = np.asarray(reals, float)
        d = int((np.sqrt(1 + 4 * len(reals)) - 1) / 2 + 0.5)
        return cls(int(n), reals[:d], reals[d:].reshape(d, d))


def _state_batch(state) -> pa.RecordBatch:
    from pyspark import TaskContext

    n, whole, reals = state.row()
    return pa.record_batch({"id": pa.array([TaskContext.get().partitionId()], pa.int64()), "n": pa.array([n], pa.int64()), "whole": pa.array([whole], pa.list_(pa.int64())), "reals": pa.array([reals], pa.list_(pa.float64()))})


def combined(states: DataFrame, kind):
    """Add up the states of all partitions in rounds of ``FAN`` a task; the driver gets one."""
    states = written(states, "spectra")  # a round reads what the last one wrote: nothing is made twice
    left = states.agg(F.max("id").alias("top")).first().top
    if left is None:
        return None
    left += 1

    def step(key, frame):
        frame = frame.sort_values("id")
        total = None
        for n, whole, reals in zip(frame["n"], frame["whole"], frame["reals"]):
            state = kind.from_row(n, whole, reals)
            total = state if total is None else total + state
        n, whole, reals = total.row()
        return pd.DataFrame({"id": [key[0]], "n": [n], "whole": [whole], "reals": [reals]})

    while left > 1:
        left = -(-left // FAN)
        states = states.groupBy(F.floor(F.col("id") / FAN).alias("to")).applyInPandas(step, STATE)
    row = states.first()
    return kind.from_row(row.n, row.whole, row.reals)


def spectrum(rows: DataFrame, d: int) -> Spectrum | None:
    """The scatter spectrum of all vectors, by rank-one updates."""

    def of_partition(batches):
        state = Spectrum.of_batches((whole_numbers(b.column(0), d) for b in batches), d)
        if state is not None:
            yield _state_batch(state)

    return combined(rows.select("vector").mapInArrow(of_partition, STATE), Spectrum)


def _products(rows: DataFrame, d: int, project, centre: bool) -> Products:
    def of_partition(batches):
        total = None
        for b in batches:
            if b.num_rows:
                part = Products.of(project(whole_numbers(b.column(0), d)), centre)
                total = part if total is None else total + part
        if total is not None:
            yield _state_batch(total)

    return combined(rows.select("vector").mapInArrow(of_partition, STATE), Products)


class Whitener:
    """The exact mean, the components (as columns) and their eigenvalues, and the trace of the covariance."""

    def __init__(self, mean: Mean, components: np.ndarray, values: np.ndarray, trace: float):
        self.mean, self.components, self.values, self.trace = mean, components, values, trace
        self.spread = values > len(components) * EPS * max(values[0], 0.0)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Whitened values; NaN for components without variance."""
        scale = np.sqrt(np.where(self.spread, self.values, np.nan))
        return self.mean.centred(x) @ self.components / scale


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitener | None:
    """Rank-one spectra of the partitions, combined, then one Rayleigh-Ritz step over all rows."""
    found = spectrum(rows, d)
    if found is None:
        return None
    basis, mean = np.linalg.qr(found.vectors)[0], found.mean
    ritz = _products(rows, d, lambda x: mean.centred(x) @ basis, centre=False).scatter / mean.n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    k = min(components, d)
    found = (basis @ turn)[:, ::-1][:, :k]
    found = found * np.where(found[np.abs(found).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    return Whitener(mean, found, values[::-1][:k], float(np.trace(ritz)))


def identity_error(rows: DataFrame, d: int, model: Whitener) -> float | None:
    """Largest entry by size of the whitened values' covariance less the identity."""
    if not model.spread.any():
        return None
    seen = _products(rows, d, lambda x: model(x)[:, model.spread], centre=True)
    return float(np.abs(seen.scatter / seen.n - np.eye(int(model.spread.sum()))).max())


def deviations(x: np.ndarray, mean: Mean) -> list:
    """Sum over dimensions of (n x - S)**2, exact; None beyond a long."""
    q, r = mean.parts()
    apart, n = x - q, mean.n
    most = (float(np.abs(apart.astype(float)).max()) + 1) * n if len(x) else 0.0
    if most * most * len(q) < 2.0**62:
        return ((n * apart - r) ** 2).sum(axis=1).tolist()
    sums = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, r)) for row in apart]
    return [s if s < 1 << 63 else None for s in sums]


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation and the whitened vector of each row that remains; ``explained`` per component and ``identity_error``."""
    rows, d = valid_vectors(df, id_col, vector_col)
    model = fit(rows, d, components) if d else None
    kind = rows.schema["vec_id"].dataType
    schema = T.StructType([T.StructField("vec_id", kind), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if model is None:
        out, shares, error, n = df.sparkSession.createDataFrame([], schema), [], None, 0
    else:

        def of_partition(batches):
            for b in batches:
                x = whole_numbers(b.column(1), d)
                y = model(x)
                values = pa.array(y.ravel(), mask=np.isnan(y).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * y.shape[1], pa.int32()), values)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(deviations(x, model.mean), pa.int64()), lists], ["vec_id", "deviation", "whitened"])

        out, n = rows.mapInArrow(of_partition, schema), model.mean.n
        error = identity_error(rows, d, model)
        shares = [float(v / model.trace) if s else 0.0 for v, s in zip(model.values, model.spread)]
    explained = F.array(*map(F.lit, shares)).cast("array<double>")
    return out.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"))
    per = found.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "one"))
    return per.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "one.whitened", "one.explained", "identity_error")
