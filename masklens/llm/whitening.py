"""Embedding whitening by shifted Cholesky QR of the centred rows.

A Gram pass sums the d x d product of the rows in every task and adds the products up in a tree; its Cholesky factor
R, with a shift on the diagonal while the rows are ill-conditioned, orthogonalises the rows by a triangular solve in
the next pass. The factors of all passes, multiplied, are the R of a QR decomposition that is accurate to double
precision even where the Gram matrix itself is not (its condition is the square of the rows'). The singular vectors of
that R are the principal components, its singular values their scales.

A vector takes part as whole numbers, floor(256 x), so sums, means and deviations are exact. Every distinct vector
counts once in the fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masklens.llm.common import stored
from masklens.llm.topk import usable

SCALE = 256.0
COMPONENTS = 4
#: partial matrices that one task of the summing tree adds up
FAN_IN = 16
#: directions whose share of the rows' norm is below this have no variance in double precision
FLOOR = 1e-13
#: a Gram matrix this close to the identity has a factor that leaves nothing to repeat; passes at most
CLOSE, PASSES = 1e-7, 12
LARGEST = 2 ** 63 - 1


class Centre(NamedTuple):
    """Exact means of n whole-number vectors: ``floor`` + ``rest`` / n for each dimension."""

    n: int
    floor: np.ndarray
    rest: np.ndarray

    def shifted(self, x: np.ndarray) -> np.ndarray:
        """x less the mean's whole part, exact (as Python integers where 64 bits might not do)."""
        if len(x) and max(abs(int(x.max())), abs(int(x.min())), int(np.abs(self.floor).max())) >= 2 ** 62:
            return x.astype(object) - self.floor.astype(object)
        return x - self.floor

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.shifted(x).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list:
        """Sum over dimensions of (n x - S) ** 2 for every row, exact; null where a long can't hold it."""
        y = self.shifted(x)
        reach = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if reach * reach * max(1, y.shape[1]) > LARGEST:
            y = y.astype(object)
        far = self.n * y - self.rest
        return [v if v <= LARGEST else None for v in map(int, (far * far).sum(axis=1))]


def solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows @ inverse(factor) for an upper triangular factor, column by column."""
    out = np.empty(rows.shape)
    for j in range(factor.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def as_matrix(column, width: int) -> np.ndarray:
    """An Arrow column of integer lists of one width as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def whole_numbers(vectors: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, x array<long>) of the usable rows, filled with zeros to the longest one, and that width."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(usable(F.col("v")))
    width = rows.agg(F.max(F.size("v")).alias("width")).first()["width"] or 0
    x = F.transform("v", lambda c: F.floor(F.lit(SCALE) * c))
    full = F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))
    return rows.select("vec_id", full.alias("x")), width


def centre_of(fit: DataFrame, width: int) -> Centre:
    """Number and exact sums of the fit list (x); one row per dimension reaches the driver."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, sums = 0, [0] * width
        for batch in batches:
            x = as_matrix(batch.column(0), width)
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            n += len(x)
            sums = [s + (int(h) << 32) + int(w) for s, h, w in zip(sums, high, low, strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()),
                 pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], names=["dim", "n", "total"])

    found = (fit.mapInArrow(run, "dim int, n long, total decimal(38,0)").groupBy("dim")
             .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
    n = found[0]["n"] if found else 0
    sums = [0] * width
    for r in found:
        sums[r["dim"]] = int(r["total"])
    parts = [divmod(s, max(1, n)) for s in sums]
    return Centre(n, np.array([q for q, _ in parts], dtype=np.int64), np.array([r for _, r in parts], dtype=np.int64))


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of all rows (sums binary: ``size`` doubles), added up in a tree; one row at last."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, some = np.zeros(size), False
        for batch in batches:
            for value in batch.column(0):
                total += np.frombuffer(value.as_buffer(), dtype=np.float64)
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    tasks = parts.rdd.getNumPartitions()
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        parts = parts.repartition(tasks).mapInArrow(run, "sums binary")
    return sum((np.frombuffer(r["sums"], dtype=np.float64) for r in parts.collect()), np.zeros(size))


def gram_pass(fit: DataFrame, width: int, out: int, rows_of) -> np.ndarray:
    """Sum over the fit list of the outer products of ``rows_of(x)``, which has ``out`` columns."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, some = np.zeros((out, out)), False
        for batch in batches:
            q = rows_of(as_matrix(batch.column(0), width))
            total += q.T @ q
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return summed(fit.mapInArrow(run, "sums binary"), out * out).reshape(out, out)


def triangular_factor(gram, n: int, width: int) -> tuple[np.ndarray, float]:
    """R of a QR decomposition of the centred rows over a small multiple of the identity, and that multiple's square.

    ``gram(factors)`` returns the Gram matrix of the rows after the triangular solves with ``factors``. The
    rows of the multiple (``FLOOR`` of the norm) keep R regular where the rows have no variance; they are known here, so only the
    rows themselves are passed over.
    """
    factors: list[np.ndarray] = []
    whole, floor = np.eye(width), 0.0
    for k in range(PASSES):
        g = gram(factors)
        if not k:
            norm = float(np.trace(g))
            floor = FLOOR * FLOOR * norm
            if norm <= 0:
                return np.zeros((width, width)), 0.0
        added = np.sqrt(floor) * np.eye(width)
        for f in factors:
            added = solve(added, f)
        g = g + added.T @ added
        shift = 11 * (n * width + width * (width + 1)) * 2.0 ** -53 * float(np.trace(g))
        try:
            # the first pass is always shifted, a later one where its Gram matrix has no factor
            lower = np.linalg.cholesky(g + (0 if k else shift) * np.eye(width))
        except np.linalg.LinAlgError:
            lower = np.linalg.cholesky(g + shift * np.eye(width))
        factors.append(lower.T)
        whole = lower.T @ whole
        if np.abs(g - np.eye(width)).max() <= CLOSE:
            break
    return whole, floor


def whiten(vectors: DataFrame, path: str, *, vec_id: str = "vec_id", vector: str = "embedding",
           most: int = COMPONENTS) -> DataFrame:
    """Rows (``vec_id``, ``component`` from 1 by falling eigenvalue, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``) for every usable vector and each of the ``most`` leading components.

    Vectors that are null or hold null or non-finite entries are left out. Entries become floor(256 x) (those
    beyond a long stop at its limits); shorter vectors are filled with zeros. The fit list is each distinct
    vector once: ``n`` vectors with sums S; ``deviation`` is the sum of (n x - S) ** 2, exact, null where a long can't hold it.
    ``whitened`` is x - S / n along the component's unit vector over the square root of its eigenvalue, ``explained`` the
    eigenvalue's share of the trace, ``identity_error`` the largest absolute entry of (covariance of ``whitened`` over the fit list
    - identity), measured in a pass of its own. Components without variance are left out, so equal
    vectors, a single one, vectors without entries and an empty table give no rows. Of equal eigenvalues the order is
    arbitrary but one for all rows; a component's largest entry is positive. Null ids and repeated rows are
    returned like others; other columns are not read.

    Scale: one shuffle finds the distinct vectors (copies meet in the tasks first); each pass reads the stored fit
    list and moves one d x d matrix a task, added up in a tree. The driver holds d x d numbers.
    """
    rows, width = whole_numbers(vectors, vec_id, vector)
    schema = ("component int, n long, deviation long, whitened double, explained double, identity_error double")
    kind = rows.schema["vec_id"].dataType.simpleString()
    empty = rows.sparkSession.createDataFrame([], f"vec_id {kind}, {schema}")
    if not width:
        return empty
    fit = stored(rows.select("x").distinct(), f"{path}/fit")
    centre = centre_of(fit, width)

    def gram(factors: list[np.ndarray]) -> np.ndarray:
        def rows_of(x: np.ndarray) -> np.ndarray:
            q = centre.centred(x)
            for f in factors:
                q = solve(q, f)
            return q

        return gram_pass(fit, width, width, rows_of)

    whole, floor = triangular_factor(gram, centre.n, width)
    _, singular, right = np.linalg.svd(whole)
    squares = singular * singular
    told = squares > 4 * floor
    squares = np.where(told, squares - floor, 0.0)
    k = min(most, int(told.sum()))
    if not k:
        return empty
    unit = right[:k].T * np.sign(right[:k][np.arange(k), np.abs(right[:k]).argmax(axis=1)])
    scales = np.sqrt(squares[:k] / centre.n)
    explained = squares[:k] / squares.sum()
    project = lambda x: centre.centred(x) @ unit / scales
    identity = gram_pass(fit, width, k, project) / centre.n
    error = float(np.abs(identity - np.eye(k)).max())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = as_matrix(batch.column(1), width)
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, centre.n), pa.int64()), pa.array(centre.deviations(x), pa.int64()).take(each),
                 pa.array(project(x).ravel(), pa.float64()), pa.array(np.tile(explained, m), pa.float64()),
                 pa.array(np.full(m * k, error), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"vec_id {kind}, {schema}")
