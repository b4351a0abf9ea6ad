"""Embedding whitening by matrix-free block subspace iteration.

Entries become integers x; one pass gives their number n and exact sums S by dimension. The covariance V is never
formed: each pass over the vectors computes V·Q for a block Q of ``k + oversample`` orthonormal columns, as the sum over
rows of xcᵀ(xc·Q) / n with centred xc = (n·x - S) / n, whose numerator is exact. A pass is followed by Rayleigh-Ritz (an
eigenproblem of the block's size on the driver) and a QR factorisation of V·Q, the next block. Iteration ends when the
residuals |V·q - e·q| of all k components are within ``TOLERANCE`` of the largest eigenvalue and no longer fall; where the
block spans the space (``k + oversample`` dimensions or fewer) the first pass is certified. Block sums are added up by task,
then by groups of tasks, one block in memory at a time; the driver gets a block a group. Vectors are read anew in each pass
from a table in the shared folder, and a lost task is run again.

Defined cases: vectors that are null or hold null or non-finite entries have no rows in the result and no part in the fit;
the dimension is the length that most vectors have (the greater of two that tie), and vectors of other lengths, empty ones
among them, are not of this space and go too; components whose eigenvalue is within rounding of zero (of copies of one vector,
constant dimensions, or fewer vectors than dimensions) can't be scaled to one and have no rows; an empty table, or one without
any vector, gives no rows; a null vec_id is kept, and repeated vec_ids give their rows each; equal eigenvalues are numbered in
an arbitrary but common order; a deviation beyond the range of long (of very many or very large vectors) is null; entries that
do not fit the exact integer arithmetic raise ``embedding_out_of_range``; a block that does not converge in ``max_passes`` raises ``whitening_not_certified``; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.errors import GridloomError
from gridloom.llm import common
from gridloom.session import Run

COMPONENTS, OVERSAMPLE, MAX_PASSES = 32, 32, 500
#: Residuals, as a share of the largest eigenvalue, at which components are certified.
TOLERANCE = 1e-12
#: Eigenvalues below this share of the largest, times the dimension, are zero to double precision.
NO_VARIANCE = 1e-13
#: The contract's integers: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Integers beyond this are refused.
LARGEST = 1 << 52
#: Entries of vectors worked on at a time.
SLICE_ENTRIES = 1 << 18

SCHEMA = "vec_id long, component int, n long, deviation long, whitened double"


def usable(table: DataFrame) -> DataFrame:
    """vec_id and x (array of long) of the vectors without null or non-finite entries, whatever their length."""
    v = table["embedding"].cast("array<double>")
    sound = v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    # a value beyond the range of long becomes null
    x = F.transform(v, lambda c: F.when(F.abs(c) < LARGEST / SCALE, F.floor(c * SCALE) + SHIFT))
    return table.where(sound).select(table["vec_id"].cast("long").alias("vec_id"), x.alias("x"))


def matrices(batches: Iterable[pa.RecordBatch], d: int, column: str = "x") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches cut to ``SLICE_ENTRIES`` entries, with their vectors as the rows of an integer matrix."""
    rows = max(SLICE_ENTRIES // d, 1)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield part, part.column(part.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def added_up(vectors: DataFrame, d: int, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all slices of ``of(matrix)``, an array of ``width`` numbers: by task, then by groups of tasks, then here."""
    common.ship(vectors.sparkSession)

    def by_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(width)
        for _, x in matrices(batches, d):
            total += of(x)
        yield pa.RecordBatch.from_pydict({"task": [TaskContext.get().partitionId()], "block": [total.tobytes()]}, pa.schema([("task", pa.int64()), ("block", pa.binary())]))
        common.release()

    def together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, met = np.zeros(width), False
        for batch in batches:
            for block in batch.column(1):
                total += np.frombuffer(block.as_buffer(), np.float64)
                met = True
        if met:
            yield pa.RecordBatch.from_pydict({"block": [total.tobytes()]}, pa.schema([("block", pa.binary())]))

    blocks = vectors.select("x").mapInArrow(by_task, "task long, block binary").repartition("task").mapInArrow(together, "block binary").collect()
    return sum((np.frombuffer(bytes(b[0]), np.float64) for b in blocks), np.zeros(width))


@dataclass
class Whitening:
    """n, sums S, components (columns), their eigenvalues, the trace of V, the largest residual by the largest eigenvalue, and passes."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    residual: float
    passes: int


def exact_sums(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """The number of vectors and their exact sum by dimension; partial sums are made by the tasks that read."""
    entry = vectors.select(F.posexplode("x").alias("at", "x"))
    rows = entry.groupBy("at").agg(F.count("*").alias("n"), F.try_sum("x").alias("s"), F.max(F.abs("x")).alias("most"), F.count("x").alias("sound")).collect()
    found = sorted((r["at"], r["n"], r["s"] or 0, r["most"] or 0, r["sound"]) for r in rows)
    if any(n != sound or n * most >= 1 << 62 for _, n, _, most, sound in found):
        raise GridloomError("embedding_out_of_range")
    return (found[0][1] if found else 0), np.array([s for _, _, s, _, _ in found], np.int64)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


def fit(vectors: DataFrame, k: int = COMPONENTS, oversample: int = OVERSAMPLE, max_passes: int = MAX_PASSES, seed: int = 0) -> Whitening | None:
    """The first k components of vectors of one length (``x``); None without any."""
    n, sums = exact_sums(vectors)
    if not n:
        return None
    d = len(sums)
    width, k = min(d, k + oversample), min(d, k)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    passes, last = 0, np.inf
    while True:

        def product(x: np.ndarray, q: np.ndarray = q) -> np.ndarray:
            xc = centred(x, n, sums)
            return np.append(xc.T @ (xc @ q), np.einsum("ij,ij->", xc, xc))

        total = added_up(vectors, d, d * width + 1, product) / n
        y, trace = total[:-1].reshape(d, width), float(total[-1])
        passes += 1
        values, turn = np.linalg.eigh((q.T @ y + y.T @ q) / 2)
        order = np.argsort(values)[::-1]
        values, turn = values[order], turn[:, order]
        ritz = q @ turn[:, :k]
        residual = float(np.linalg.norm(y @ turn[:, :k] - ritz * values[:k], axis=0).max() / max(values[0], np.finfo(float).tiny))
        # residuals fall until rounding stops them: go on while a pass still halves them
        if residual <= TOLERANCE and (width == d or residual >= last / 2):
            break
        if passes >= max_passes or width == d:
            raise GridloomError("whitening_not_certified")
        q, last = np.linalg.qr(y @ turn)[0], residual
    kept = values[:k] > max(values[0], 0) * NO_VARIANCE * d
    ritz, values = ritz[:, kept], values[:k][kept]
    largest = ritz[np.abs(ritz).argmax(axis=0), np.arange(ritz.shape[1])]
    return Whitening(n, sums, ritz * np.where(largest < 0, -1.0, 1.0), values, trace, residual, passes)


def deviations(off: np.ndarray) -> pa.Array:
    """The exact sum of squares of each row; null beyond the range of long."""
    about = np.square(off.astype(float)).sum(axis=1)
    if (about < 2.0**62).all():
        return pa.array(np.square(off).sum(axis=1), pa.int64())
    exact = (sum(v * v for v in row.tolist()) if size < 2.0**64 else 1 << 63 for row, size in zip(off, about, strict=True))
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whitened(vectors: DataFrame, fitted: Whitening) -> DataFrame:
    """A row for each vector and component."""
    n, sums, scaled = fitted.n, fitted.sums, fitted.components / np.sqrt(fitted.eigenvalues)
    d, k = scaled.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, d):
            off, rows = n * x - sums, len(x)
            each = pa.array(np.repeat(np.arange(rows), k))
            columns = [part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n, np.int64)), deviations(off).take(each)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(((off / n) @ scaled).ravel())], names=["vec_id", "component", "n", "deviation", "whitened"])
        common.release()

    return vectors.select("vec_id", "x").mapInArrow(run, SCHEMA)


def identity_error(vectors: DataFrame, fitted: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity, by a pass of its own."""
    n, sums, scaled = fitted.n, fitted.sums, fitted.components / np.sqrt(fitted.eigenvalues)
    k = scaled.shape[1]

    def product(x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ scaled
        return np.append((w.T @ w).ravel(), w.sum(axis=0))

    total = added_up(vectors, len(sums), k * k + k, product) / n
    return float(np.abs(total[: k * k].reshape(k, k) - np.outer(total[k * k :], total[k * k :]) - np.eye(k)).max())


def of_one_length(vectors: DataFrame) -> DataFrame:
    """The vectors of the length that most have; the greater of two that tie."""
    lengths = vectors.groupBy(F.size("x").alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return vectors.where(F.size("x") == (lengths[0]["d"] if lengths else -1))


def whiten(table: DataFrame, k: int = COMPONENTS, oversample: int = OVERSAMPLE, max_passes: int = MAX_PASSES) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every usable vector of a table."""
    run = Run(table.sparkSession, "whitening")
    vectors = of_one_length(run.table(usable(table), "vectors"))
    fitted = fit(vectors, k, oversample, max_passes)
    if fitted is None or not fitted.eigenvalues.size:
        return table.sparkSession.createDataFrame([], SCHEMA + ", explained double, identity_error double")
    explained = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.eigenvalues])
    return whitened(vectors, fitted).withColumns({"explained": F.element_at(explained, F.col("component")), "identity_error": F.lit(identity_error(vectors, fitted))})


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(common.documents(spark, sf_dir, "embeddings"))
