"""Whitening of embeddings by an incremental eigendecomposition.

Every partition follows the spectrum of its own scatter matrix, one centred rank-one update a vector. Spectra are
combined in groups of eight, again by rank-one updates, until one is left. Its basis then is refined by
a Rayleigh-Ritz step: the covariance inside the basis is summed over all vectors in one more pass and solved.
Tasks hold a few matrices of dimensions x dimensions; only one such matrix comes to the driver.

Sums and deviations are exact integers; vectors are centred before anything is multiplied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podwatch.llm.rank_one import Spectrum
from podwatch.llm.scratch import Scratch
from podwatch.llm.tree import PART, combined, one_part, summed

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
BLOCK = 1024  # vectors multiplied at a time
LARGEST = 2**40  # entries beyond would leave the range in which sums are exact
# Eigenvalues below this part of the trace are zero but for rounding.
NOTHING = 1e-13
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are finite."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def quantised(vector: Column) -> Column:
    """Entries as long: floor(SCALE * c) + SHIFT."""
    return F.transform(vector, lambda c: F.try_add(F.floor(c.cast("double") * SCALE), F.lit(SHIFT)))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, _matrix(part, size)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, from the exact integers n * x - sums. ``sums`` are Python's integers."""
    low = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - low).astype(np.float64) - rest


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sum of (n * x - sums)^2 of each row; None where it does not fit a long."""
    low = np.array([s // n for s in sums], dtype=np.int64)
    rest = [s % n for s in sums]
    small = x - low
    widest = n * (int(np.abs(small).max(initial=0)) + 1)
    if widest**2 * x.shape[1] < 2**63:
        away = small * np.int64(n) - np.array(rest, dtype=np.int64)
        return (away * away).sum(axis=1).tolist()
    exact = [sum((int(v) * n - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in small.tolist()]
    return [d if d < 2**63 else None for d in exact]


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row and component.

    Reads vec_id and embedding. Rows whose vector is NULL, empty, or holds NULL or non-finite entries are left
    out, and so are vectors of another length than most (of the longest among these, if lengths tie). Rows
    that repeat count as often as they are there; vec_id may be NULL. Components of no variance (all
    vectors equal in that direction) are left out, so a single vector gives no rows; an empty table neither.
    A deviation beyond the range of a long is NULL. An entry of 2^40 or more in size fails the job.
    Results are columns of their own; extra columns are not read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).where(usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("size")).count()
    commonest = lengths.orderBy(F.col("count").desc(), F.col("size").desc()).first()
    if commonest is None:
        return spark.createDataFrame([], OUT)
    size = commonest["size"]
    fits = F.assert_true(~usable(F.col("v")) | F.forall("v", lambda c: F.abs(c) < LARGEST), F.lit("an entry of an embedding is 2^40 or more"))
    rows = rows.where(F.size("v") == size).where(fits.isNull()).select("vec_id", quantised(F.col("v")).alias("x"))
    n = int(commonest["count"])
    entries = rows.select(F.posexplode("x").alias("k", "c")).groupBy("k").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"))
    sums = [int(r["s"]) for r in entries.orderBy("k").collect()]  # one for each dimension
    start = np.array([s // n for s in sums], dtype=np.int64)

    def spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum = Spectrum(size)
        for _, x in _blocks(batches, size):
            for v in (x - start).astype(np.float64):
                spectrum.add(v)
        if spectrum.n:
            yield one_part(spectrum.tobytes())

    def joined(payloads: list[bytes]) -> bytes:
        first, *others = (Spectrum.frombytes(p, size) for p in payloads)
        for other in others:
            first.join(other)
        return first.tobytes()

    found = Spectrum.frombytes(combined(rows.mapInArrow(spectra, PART), joined, scratch, "spectra"), size)
    basis = np.linalg.qr(found.vectors[:, ::-1])[0]  # largest first; orthonormal to rounding

    def covariance(project: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((project.shape[1] + 1, project.shape[1]))
            for _, x in _blocks(batches, size):
                y = _centred(x, n, sums) @ project
                total[:-1] += y.T @ y
                total[-1] += y.sum(axis=0)
            yield one_part(total.tobytes())

        return run

    def measured(project: np.ndarray, name: str) -> np.ndarray:
        total = np.frombuffer(combined(rows.mapInArrow(covariance(project), PART), summed, scratch, name))
        total = total.reshape(-1, project.shape[1]) / n
        return total[:-1] - np.outer(total[-1], total[-1])

    inside = measured(basis, "inside")
    values, turn = np.linalg.eigh((inside + inside.T) / 2)
    values, axes = values[::-1], basis @ turn[:, ::-1]
    trace = float(np.trace(inside))
    kept = int((values[:components] > NOTHING * trace).sum()) if trace > 0 else 0
    if not kept:
        return spark.createDataFrame([], OUT)
    scaled = axes[:, :kept] / np.sqrt(values[:kept])
    error = float(np.abs(measured(scaled, "identity") - np.eye(kept)).max())
    explained = values[:kept] / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches, size):
            m = len(x)
            y = _centred(x, n, sums) @ scaled
            ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), kept)))
            deviation = pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), kept)))
            columns = [
                ids,
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), m)),
                pa.array(np.full(m * kept, n, dtype=np.int64)),
                deviation,
                pa.array(y.ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * kept, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in OUT.split(", ")])

    return rows.mapInArrow(project, OUT)
