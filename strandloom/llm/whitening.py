"""Whitening of embeddings along their leading components, found by a randomised range finder.

Entries become whole numbers, so sums and deviations are exact. A random basis, wider than the components asked for, is
multiplied with the covariance by a pass over all centred rows, again and again; what each pass gives serves three
times: as the next basis, for the Rayleigh-Ritz values and vectors within the present one, and for their residuals.
Where these are still too large, as with a flat spectrum, the basis is widened to full dimension, which one further pass
makes exact. Tasks add up their rows' products; only sums of the size of the basis reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, pick, place

#: Units and zero of the whole numbers; entries beyond this size are taken as of this size.
UNIT, ZERO, MOST = 64, 1_000_000, 1 << 62
#: Residual of a vector against the distance to the nearest other value that counts as converged.
CLOSE = 1e-12
#: Share of the largest value under which a component has no variance but rounding.
NOTHING = 1e-13
_LOW = (1 << 31) - 1


def whole_numbers(batch: pa.RecordBatch, size: int | None) -> tuple[pa.Array, dict[int, np.ndarray], np.ndarray]:
    """(ids of the usable rows, their whole numbers by length of vector, places of these rows): null vectors, empty
    ones, those with null or non-finite entries and, if ``size`` is given, those of another length are left out."""
    column = batch.column(1)
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), 0)
    found, rows = {}, []
    for n in [size] if size else np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == n)
        values = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), n)
        finite = np.isfinite(values).all(1)
        at, values = at[finite], values[finite]
        with np.errstate(over="ignore"):
            scaled = np.clip(np.floor(UNIT * values), -MOST, MOST)
        found[n] = scaled.astype(np.int64) + ZERO
        rows.append(at)
    at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return batch.column(0).take(pa.array(at)), found, at


@dataclass
class Fit:
    """Rows, sums of each dimension, and (once they are found) components, their values and the whole variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray | None = None
    values: np.ndarray | None = None
    variance: float = 0.0

    def exact(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n*x - S modulo 2^64, and as doubles; the first is exact where the second is under 2^62."""
        mean = np.array([s / self.n for s in self.sums])
        with np.errstate(over="ignore"):
            low = x * np.int64(self.n) - np.array([(s + (1 << 63)) % (1 << 64) - (1 << 63) for s in self.sums], np.int64)
            rough = (x - mean) * float(self.n)
        return low, rough

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean, from the exact difference."""
        low, rough = self.exact(x)
        return np.where(np.abs(rough) < 2.0**62, low, rough) / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """The squares of n*x - S, added up exactly; null where the sum is no long."""
        low, rough = self.exact(x)
        with np.errstate(over="ignore"):
            total, about = (low * low).sum(1), (rough * rough).sum(1)
        unsure = np.flatnonzero((about > 9.1e18) & (about < 9.3e18))
        for i in unsure.tolist():
            true = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[i], self.sums))
            total[i], about[i] = (true, 0) if true < 1 << 63 else (0, np.inf)
        return pa.array(total, mask=about > 9.2e18)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        scale = np.where(self.values > 0, 1 / np.sqrt(np.where(self.values > 0, self.values, 1)), 0.0)
        return self.centred(x) @ (self.vectors * scale)


def _sums(rows: DataFrame) -> Fit | None:
    """Rows and sums of the most common length of vectors (of the shorter one, if two are)."""

    def make():
        n: dict[int, int] = {}
        high: dict[int, np.ndarray] = {}
        low: dict[int, np.ndarray] = {}

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for size, x in whole_numbers(batch, None)[1].items():
                n[size] = n.get(size, 0) + len(x)
                high[size] = high.get(size, 0) + (x >> 31).sum(0)
                low[size] = low.get(size, 0) + (x & _LOW).sum(0)
            return iter(())

        def finish() -> Iterator[pa.RecordBatch]:
            for size in n:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, size, np.int32)), pa.array(np.arange(size, dtype=np.int32)), pa.array(np.full(size, n[size])), pa.array(high[size]), pa.array(low[size])], names=["size", "i", "n", "high", "low"])

        each.finish = finish
        return each

    sums = arrow_map(rows, make, "size int, i int, n bigint, high bigint, low bigint", rows=1 << 16).groupBy("size", "i").agg(*(F.sum(c).alias(c) for c in ("n", "high", "low")))
    best = sums.groupBy("size").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "high", "low"))).alias("s")).filter("n > 0").orderBy(F.desc("n"), "size").first()
    return Fit(best["n"], [(s["high"] << 31) + s["low"] for s in best["s"]]) if best else None


def _added(rows: DataFrame, size: int, product: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of what ``product`` makes of a block of them, cell by cell."""

    def make():
        total: list[np.ndarray] = []

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            x = whole_numbers(batch, size)[1][size]
            if len(x):
                p = product(x).ravel()
                total[:] = [total[0] + p if total else p]
            return iter(())

        def finish() -> Iterator[pa.RecordBatch]:
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total[0]), dtype=np.int32)), pa.array(total[0])], names=["cell", "value"])

        each.finish = finish
        return each

    # map tasks give one row a cell; of cells there are as many as the basis has entries
    found = arrow_map(rows, make, "cell int, value double", rows=1 << 16).groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(found.num_rows)
    out[found["cell"].to_numpy()] = found["value"].to_numpy()
    return out


def fit(rows: DataFrame, components: int = 32, oversampling: int = 10, power: int = 3, seed: int = 5) -> Fit | None:
    """Components of all usable rows, by falling value, or None if there are none."""
    found = _sums(rows)
    if found is None:
        return None
    d, n = len(found.sums), found.n
    wanted, width = min(components, d), min(d, components + oversampling)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    left = power
    while True:

        def product(x: np.ndarray, q: np.ndarray = basis, of: Fit = found) -> np.ndarray:
            c = of.centred(x) / n**0.5
            return np.concatenate([(c.T @ (c @ q)).ravel(), [(c * c).sum()]])

        cells = _added(rows, d, product)
        image, found.variance = cells[:-1].reshape(d, -1), float(cells[-1])
        small = basis.T @ image
        values, turned = np.linalg.eigh((small + small.T) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        vectors = basis @ turned
        residual = np.linalg.norm(image @ turned - vectors * values, axis=0)[:wanted]
        apart = np.abs(values[:, None] - values[None, :]) + np.where(np.eye(len(values)), np.inf, 0)
        if basis.shape[1] == d or bool((residual <= CLOSE * apart.min(1)[:wanted]).all()):
            break
        basis = np.linalg.qr(image)[0] if left else np.eye(d)
        left -= 1
    found.vectors = np.linalg.qr(vectors[:, :wanted])[0]
    # the signs that the decomposition has turned over
    found.vectors *= np.sign((found.vectors * vectors[:, :wanted]).sum(0))
    found.values = np.where(values[:wanted] > NOTHING * max(values[0], 0.0), values[:wanted], 0.0)
    return found


def identity_error(rows: DataFrame, found: Fit) -> float:
    """The largest entry of the whitened rows' covariance less the identity, over components that have a variance."""

    def product(x: np.ndarray) -> np.ndarray:
        w = found.whitened(x)
        w = np.concatenate([w, np.ones((len(w), 1))], axis=1) / found.n**0.5
        return w.T @ w

    cells = _added(rows, len(found.sums), product)
    k = found.vectors.shape[1]
    cells = cells.reshape(k + 1, k + 1)
    covariance = cells[:k, :k] - np.outer(cells[k, :k], cells[k, :k])
    some = found.values > 0
    return float(np.abs(covariance - np.eye(k))[np.ix_(some, some)].max(initial=0.0))


def whiten(vectors: DataFrame, components: int = 32, oversampling: int = 10, power: int = 3, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    Null and empty vectors, those with null or non-finite entries and those of another length than most are left out;
    repeated rows count each; null ids stay null. With fewer dimensions than ``components`` there is one component a
    dimension. A component along which all vectors are alike has whitened and explained 0. Entries beyond 2^56 count as
    of that size; deviation is null where it is no long. Extra columns do no harm, whatever their names; a table
    without a usable vector gives an empty one.
    """
    kind = vectors.schema.fields[place(vectors, vector_col)].dataType.simpleString()
    rows = pick(vectors, **{id_col: "bigint", vector_col: kind if kind == "array<float>" else "array<double>"})
    schema = f"`{id_col}` bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    found = fit(rows, components, oversampling, power)
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error, k = identity_error(rows, found), found.vectors.shape[1]
    explained = found.values / found.variance if found.variance > 0 else np.zeros(k)

    def make():
        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids, by_size, _ = whole_numbers(batch, len(found.sums))
            x = by_size[len(found.sums)]
            every = np.repeat(np.arange(len(x)), k)
            columns = [
                ids.take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(every), found.n)), found.deviations(x).take(pa.array(every)),
                pa.array(found.whitened(x).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(every), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

        return each

    return arrow_map(rows, make, schema, rows=4096)
