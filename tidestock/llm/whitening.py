"""Embedding whitening: incremental eigendecomposition in tasks, spectra combined in a tree, one distributed refinement.

1. Every entry becomes an integer, ``floor(scale * c) + offset``, so that counts, sums and centred values are exact.
2. A task keeps the eigenpairs of the scatter of its vectors. A block of vectors, centred on its own exact mean, is
   condensed by a QR step to as many rows as there are dimensions, with the same scatter; each row, and the step
   between the old mean and the block's, is a rank-one update that solves a secular equation with deflation
   (:mod:`secular`). So a task works in the square of the dimension, however many vectors it reads.
3. Spectra of tasks meet in groups of eight, round by round, each in a Spark task: the eigenvectors of one, scaled by
   the roots of their eigenvalues, and the difference of the means update the other one by one.
4. The last basis is refined: Rayleigh-Ritz over all vectors, whose small matrix is the sum of one for each task;
   its eigenvectors turn the basis. The driver sees one spectrum and one small matrix.

Defined results: rows whose vector is null, or has null or non-finite entries, are left out; so are vectors of
another length than most have (the longer one on a tie), as they have no place in the covariance. Grid values beyond
2^52 are held there. Components whose variance is zero to rounding have null whitened values. Repeated rows and ids
count each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.llm.rows import ddl
from tidestock.llm.secular import rank_one
from tidestock.session import staged

#: Values (rows times dimensions) that are condensed together, spectra that meet in one task.
BLOCK_VALUES, FAN_IN = 1 << 19, 8
FAR = 1 << 52
PART = "part long, payload binary"


@dataclass(frozen=True)
class Grid:
    """Integers that stand for entries."""

    scale: float = 64.0
    offset: int = 1_000_000

    def __call__(self, entries: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(self.scale * entries), -FAR, FAR).astype(np.int64) + self.offset


def vectors_of(column: pa.Array, dim: int, grid: Grid) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a vector that counts, and those vectors on the grid."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    sized = np.flatnonzero(lengths == dim)
    starts = np.cumsum(lengths) - lengths
    entries = flat[starts[sized][:, None] + np.arange(dim)]
    fine = np.isfinite(entries).all(axis=1)
    return sized[fine], grid(entries[fine])


def slices(batches: Iterator[pa.RecordBatch], column: int, dim: int, grid: Grid) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of batches with a bounded number of values, the rows that count there and their vectors."""
    rows = max(1, BLOCK_VALUES // dim)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield part, *vectors_of(part.column(column), dim, grid)


class Spectrum:
    """Count, exact sums, and eigenpairs of the scatter about the mean."""

    def __init__(self, dim: int):
        self.n, self.sums = 0, [0] * dim
        self.values, self.vectors = np.zeros(dim), np.eye(dim)

    def update(self, v: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, v)

    def join(self, n: int, sums: list[int], rows: np.ndarray) -> None:
        """Add ``n`` vectors with these sums, whose scatter about their own mean is that of ``rows`` about 0."""
        for row in rows:
            self.update(row)
        if self.n:
            both = self.n * n
            step = np.array([(t * self.n - s * n) / both for s, t in zip(self.sums, sums)])
            self.update(step * np.sqrt(both / (self.n + n)))
        self.n += n
        self.sums = [s + t for s, t in zip(self.sums, sums)]

    def add(self, grid_vectors: np.ndarray) -> None:
        n = len(grid_vectors)
        if n:
            first = grid_vectors[0]
            moved = (grid_vectors - first).astype(np.float64)
            sums = [int(s) for s in grid_vectors.astype(object).sum(axis=0)] if np.abs(grid_vectors).max() > FAR // n else grid_vectors.sum(axis=0).tolist()
            self.join(n, sums, np.linalg.qr(moved - moved.mean(axis=0), mode="r"))

    def merge(self, other: Spectrum) -> None:
        rows = other.vectors * np.sqrt(np.maximum(other.values, 0.0))
        self.join(other.n, other.sums, rows.T[other.values > 0])

    def pack(self) -> bytes:
        counts = ",".join(map(str, [self.n, *self.sums])).encode()
        return len(counts).to_bytes(8, "little") + counts + self.values.tobytes() + self.vectors.tobytes()

    @classmethod
    def unpack(cls, payload: bytes) -> Spectrum:
        at = 8 + int.from_bytes(payload[:8], "little")
        n, *sums = map(int, payload[8:at].split(b","))
        own = cls(len(sums))
        numbers = np.frombuffer(payload, np.float64, offset=at)
        own.n, own.sums = n, sums
        own.values, own.vectors = numbers[:len(sums)].copy(), numbers[len(sums):].reshape(len(sums), -1).copy()
        return own


def joined_spectra(payloads: list[bytes]) -> bytes:
    first, *others = sorted(map(Spectrum.unpack, payloads), key=lambda s: -s.n)
    for other in others:
        first.merge(other)
    return first.pack()


def summed(payloads: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(p, np.float64) for p in payloads], axis=0).tobytes()


def tree(parts: DataFrame, join: Callable[[list[bytes]], bytes], name: str) -> bytes | None:
    """One payload from the payloads of all tasks, joined ``FAN_IN`` at a time; None if there is none."""
    parts = staged(parts, name)
    highest = parts.agg(F.max("part")).first()[0]

    def meet(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("part")
        payloads = list(some["payload"])
        return pd.DataFrame({"part": [some["part"].iloc[0] // FAN_IN], "payload": [join(payloads) if payloads[1:] else payloads[0]]})

    while highest:
        parts = parts.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(meet, PART)
        highest //= FAN_IN
    one = parts.first()
    return one and bytes(one["payload"])


def each_task(df: DataFrame, column: int, dim: int, grid: Grid, collect: Callable[[Iterator[np.ndarray]], bytes | None]) -> DataFrame:
    """What ``collect`` makes of a task's vectors, a row for each task that has any."""

    def run(batches):
        payload = collect(x for _, _, x in slices(batches, column, dim, grid) if len(x))
        if payload is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()), "payload": pa.array([payload], pa.binary())})

    return df.mapInArrow(run, PART)


def spectrum_of(blocks: Iterator[np.ndarray]) -> bytes | None:
    own = None
    for block in blocks:
        own = own or Spectrum(block.shape[1])
        own.add(block)
    return own and own.pack()


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: components are columns of ``vectors`` by falling variance."""

    grid: Grid
    n: int
    sums: tuple[int, ...]
    variances: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def scales(self) -> np.ndarray:
        """What a projection is multiplied with; NaN for components without variance."""
        none = self.variances <= 64 * self.dim * np.finfo(np.float64).eps * self.variances[0]
        return 1 / np.sqrt(np.where(none, np.nan, self.variances))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact: int64 where that is enough, else Python integers."""
        small = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums))) < 1 << 62
        kind = np.int64 if small else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)

    def squares(self, x: np.ndarray) -> list[int]:
        """Exact sums of squared :meth:`deviations`, which 128 bits hold."""
        off = self.deviations(x)
        if off.dtype == object or np.abs(off).max(initial=0) >= FAR or self.dim > 1 << 10:
            return [sum(int(v) ** 2 for v in row) for row in off]
        high, low = off >> 26, off & ((1 << 26) - 1)
        parts = [(high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1)]
        return [(a << 52) + (b << 27) + c for a, b, c in zip(*(p.tolist() for p in parts))]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.vectors) * self.scales

    @property
    def explained(self) -> list[float]:
        """Each component's share of all variance; 0 if there is none at all."""
        return (self.variances / self.trace if self.trace else self.variances).tolist()


def common_length(vectors: DataFrame) -> int:
    """The length that most vectors have; 0 without any."""
    usable = F.forall("vector", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    sizes = vectors.where(F.col("vector").isNotNull()).where(usable).groupBy(F.size("vector").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return most["size"] if most else 0


def vectors_only(df: DataFrame, vector_col: str) -> DataFrame:
    return df.select(F.col(vector_col).cast("array<double>").alias("vector"))


def fit_whitening(df: DataFrame, vector_col: str = "embedding", components: int = 32, grid: Grid = Grid()) -> Whitening | None:
    """Mean and leading components of all vectors; None if there are no vectors."""
    vectors = vectors_only(df, vector_col)
    dim = common_length(vectors)
    if not dim:
        return None
    payload = tree(each_task(vectors, 0, dim, grid, spectrum_of), joined_spectra, "spectra")
    found = Spectrum.unpack(payload)
    basis = np.linalg.qr(found.vectors[:, ::-1])[0]  # rounding of many updates goes
    rough = Whitening(grid, found.n, tuple(found.sums), np.maximum(found.values[::-1], 0.0) / found.n, basis, 1.0)

    def ritz(blocks):
        own = None
        for block in blocks:
            turned = rough.centred(block) @ rough.vectors
            own = turned.T @ turned + (0.0 if own is None else own)
        return None if own is None else own.tobytes()

    small = np.frombuffer(tree(each_task(vectors, 0, dim, grid, ritz), summed, "ritz")).reshape(dim, dim) / found.n
    variances, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-variances, kind="stable")[:components]
    return Whitening(
        grid, found.n, tuple(found.sums), np.maximum(variances[order], 0.0), basis @ turn[:, order], float(np.trace(small)),
    )


def identity_error(df: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened covariance less the identity, over components with variance."""
    fine = np.flatnonzero(np.isfinite(model.scales))
    if not len(fine):
        return 0.0

    def moments(blocks):
        own = None
        for block in blocks:
            white = model.whitened(block)[:, fine]
            ones = np.column_stack([np.ones(len(white)), white])
            own = ones.T @ ones + (0.0 if own is None else own)
        return None if own is None else own.tobytes()

    parts = each_task(vectors_only(df, vector_col), 0, model.dim, model.grid, moments)
    both = np.frombuffer(tree(parts, summed, "moments")).reshape(len(fine) + 1, -1) / model.n
    mean = both[0, 1:]
    return float(np.abs(both[1:, 1:] - np.outer(mean, mean) - np.eye(len(fine))).max())


def whiten(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col``, ``deviation`` (exact) and ``whitened``, an array with one value for each component."""
    source = df.select(F.col(id_col), F.col(vector_col).cast("array<double>").alias("vector"))
    key = ddl(source.select(id_col))
    kind = pa.decimal128(38, 0)

    def run(batches):
        for batch, rows, x in slices(batches, 1, model.dim, model.grid):
            if len(rows):
                white = model.whitened(x)
                flat = pa.array(white.ravel(), mask=np.isnan(white.ravel()))
                ends = pa.array(np.arange(len(rows) + 1) * white.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(model.squares(x), kind), pa.ListArray.from_arrays(ends, flat)],
                    names=[id_col, "deviation", "whitened"],
                )

    return source.mapInArrow(run, f"{key}, deviation decimal(38,0), whitened array<double>")
