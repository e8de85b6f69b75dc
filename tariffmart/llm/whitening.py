"""Whitening of embeddings on their principal components, found by a block Jacobi-Davidson method without a matrix.

The covariance is never formed: the only thing asked of the table is the product of the covariance with a few columns,
summed over the tasks from centred rows. The method keeps an orthonormal basis and its products. Rayleigh-Ritz on the
basis gives approximate eigenpairs; for each one that is not there yet the correction equation, projected on what is
orthogonal to the wanted vectors, is solved roughly by a few MINRES steps, all of them in step so that one pass serves
all; the corrections join the basis. Leading pairs whose residual has reached double precision are locked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.llm.common import argument, by_bytes, written

Product = Callable[[np.ndarray], np.ndarray]
EPS = float(np.finfo(float).eps)
WHOLE = 1 << 62  # integers below it are summed in 64 bits


def integer_rows(vectors: DataFrame, scale: int, shift: int) -> DataFrame:
    """(vec_id, x): floor(scale * c) + shift of every entry, packed as 64-bit integers, of the vectors that take part."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = np.where(lists.is_valid().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
            entries = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null entry is not a number
            with np.errstate(over="ignore", invalid="ignore"):
                entries = np.floor(scale * entries) + shift
                good = np.abs(entries) < WHOLE  # also false for what is not a number
            until = np.concatenate([[0], np.cumsum(lengths)])
            bad = np.concatenate([[0], np.cumsum(~good)])
            takes_part = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[until[1:]] == bad[until[:-1]])
            raw = np.where(good, entries, 0).astype("<i8").tobytes()
            rows = np.flatnonzero(takes_part)
            packed = [raw[8 * a : 8 * b] for a, b in zip(until[rows].tolist(), until[rows + 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(packed, pa.binary())], ["vec_id", "x"])

    slim = argument(vectors, "vec_id", "embedding")
    return slim.mapInArrow(mapped, f"vec_id {slim.schema['vec_id'].dataType.simpleString()}, x binary")


def matrix(packed: pa.Array, dims: int, fill: int) -> np.ndarray:
    """Packed rows as a matrix; the entries that a short vector lacks count as zero, so their integer is ``fill``."""
    rows = [np.frombuffer(v, "<i8") for v in packed.to_pylist()]
    out = np.full((len(rows), dims), fill, np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


class Centred:
    """The exact centred rows of a table: n * x - S as integers of 64 bits, or of any size where those do not suffice."""

    def __init__(self, n: int, sums: list[int], fill: int, part_bytes: int):
        self.n, self.sums, self.fill, self.part_bytes = n, sums, fill, part_bytes

    def parts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
        """The ids and centred integers of a task's rows, a few at a time."""
        for batch in by_bytes(batches, 1, self.part_bytes):
            x = matrix(batch.column(1), len(self.sums), self.fill)
            large = max([1, *map(abs, self.sums)]) + self.n * (int(np.abs(x).max()) if x.size else 0)
            if large >= WHOLE:
                x = x.astype(object)
            yield batch.column(0), self.n * x - np.array(self.sums, object if large >= WHOLE else np.int64)

    def deviations(self, exact: np.ndarray) -> list[int | None]:
        """The sum of squares of each row; None where it is no 64-bit integer."""
        most = int(np.abs(exact).max()) if exact.size else 0
        if most * most * max(1, exact.shape[1]) < WHOLE:
            return (exact * exact).sum(axis=1).tolist()
        found = [sum(v * v for v in row) for row in exact.astype(object)]
        return [v if v < 1 << 63 else None for v in found]


def summed(rows: DataFrame, centred: Centred, per_part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of a matrix that ``per_part`` makes from centred rows, divided by their number.

    A task sums its own parts, then the entries of the tasks' matrices are summed by position, so the driver gets one
    matrix and no task more than one entry of each other.
    """

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for _, exact in centred.parts(batches):
            total += per_part((exact / centred.n).astype(float))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["position", "value"])

    entries = rows.mapInArrow(mapped, "position long, value double").groupBy("position").agg(F.sum("value").alias("value"))
    out = np.zeros(shape[0] * shape[1])
    for r in entries.collect():  # as many as the matrix has entries
        out[r["position"]] = r["value"]
    return out.reshape(shape) / centred.n


def orthonormal(new: np.ndarray, *old: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal columns ``old``."""
    for _ in range(2):
        for basis in old:
            new = new - basis @ (basis.T @ new)
        lengths = np.linalg.norm(new, axis=0)
        new = new[:, lengths > 0] / lengths[lengths > 0]
        if not new.shape[1]:
            return new
        left, size, _ = np.linalg.svd(new, full_matrices=False)
        new = left[:, size > 1e-8 * size[0]]
    return new[:, : max(0, len(new) - sum(b.shape[1] for b in old))]


def minres(product: Product, right: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Solutions of symmetric systems with one operator for each column, by MINRES on all columns in step."""
    columns = right.shape[1]
    x, w, w_before = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    first, second, y = right, right, right
    beta = start = np.linalg.norm(right, axis=0)
    old_beta, d_bar, eps, rest = np.ones(columns), np.zeros(columns), np.zeros(columns), start.copy()
    cos, sin = -np.ones(columns), np.zeros(columns)
    for step in range(steps):
        runs = beta > 4 * EPS * start  # a column whose space is exhausted has its solution
        if not runs.any() or (rest <= enough * start).all():
            break
        safe = np.where(runs, beta, 1)
        v = y / safe
        y = product(v)
        if step:
            y = y - beta / old_beta * first
        alpha = (v * y).sum(axis=0)
        y = y - alpha / safe * second
        first, second, old_beta = second, y, safe
        beta = np.linalg.norm(y, axis=0)
        old_eps, delta, g_bar = eps, cos * d_bar + sin * alpha, sin * d_bar - cos * alpha
        eps, d_bar = sin * beta, -cos * beta
        gamma = np.maximum(np.hypot(g_bar, beta), EPS)
        cos, sin = g_bar / gamma, beta / gamma
        w_older, w_before = w_before, w
        w = (v - old_eps * w_older - delta * w_before) / gamma
        x = np.where(runs, x + cos * rest * w, x)
        rest = np.where(runs, sin * rest, rest)
    return x


def jacobi_davidson(product: Product, dims: int, wanted: int, seed: int = 13, inner: int = 6, most: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric operator in falling order, and their unit vectors as columns.

    A pair is locked when its residual is at most 64 roundings of the largest eigenvalue. Where the operator's own
    rounding is above that, the best that was reached counts once it stands still; residuals above 1e-10 raise an error.
    """
    basis = orthonormal(np.random.default_rng(seed).standard_normal((dims, min(dims, wanted + 4))))
    products = product(basis)
    locked, values = np.zeros((dims, 0)), np.zeros(0)
    best, stood = np.inf, 0
    for _ in range(most):
        ritz, turn = np.linalg.eigh((basis.T @ products + products.T @ basis) / 2)
        order = np.argsort(-ritz)
        ritz, basis, products = ritz[order], basis @ turn[:, order], products @ turn[:, order]
        asked = min(wanted - len(values), basis.shape[1])
        top = max([*values[:1], ritz[0], 0.0])
        residual = products[:, :asked] - basis[:, :asked] * ritz[:asked]
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        stood = stood + 1 if size.max() > best / 2 else 0
        best = min(best, size.max())
        whole = len(values) + basis.shape[1] == dims  # no direction is left to add
        enough = size <= 64 * EPS * top
        if whole or stood >= 4:
            if size.max() > 1e-10 * top:
                raise RuntimeError(f"residual {size.max() / top:.1e} stands still")
            enough[:] = True
        done = int(np.argmin(enough)) if not enough.all() else asked
        locked, values = np.hstack([locked, basis[:, :done]]), np.concatenate([values, ritz[:done]])
        if len(values) == wanted:
            return values, locked
        if done:
            best, stood = np.inf, 0
        basis, products = basis[:, done:], products[:, done:]
        residual, ritz, kept = residual[:, done:], ritz[done:], asked - done
        held = np.hstack([locked, basis[:, :kept]])  # the corrections are orthogonal to these

        def projected(columns: np.ndarray) -> np.ndarray:
            columns = columns - held @ (held.T @ columns)
            made = product(columns) - columns * ritz[:kept]
            return made - held @ (held.T @ made)

        if basis.shape[1] > 4 * wanted:  # start again from the best
            basis, products = basis[:, : 2 * wanted], products[:, : 2 * wanted]
        right = held @ (held.T @ residual) - residual
        correction = minres(projected, right, inner, 0.05)
        fresh = orthonormal(correction, locked, basis)
        if not fresh.shape[1]:
            fresh = orthonormal(np.random.default_rng(seed + len(values)).standard_normal((dims, kept)), locked, basis)
        basis, products = np.hstack([basis, fresh]), np.hstack([products, product(fresh)])
    raise RuntimeError("the eigenvectors were not reached")


def whiten(
    vectors: DataFrame, components: int = 32, scale: int = 64, shift: int = 1_000_000, least: float = 1e-11, part_bytes: int = 1 << 22
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every vector and leading component.

    ``vectors`` has vec_id and embedding; an entry c, as double, counts as the integer x = floor(scale * c) + shift. Rows
    whose vector is null or holds a null or non-finite entry, or one whose x needs more than 62 bits, take no part; all
    others do, repeated rows and rows of a null id too, one by one. A vector that is shorter than the longest one counts
    as filled up with zeros. Components are numbered by falling variance; those of variance at most ``least`` of the
    largest have no direction in double precision and are not returned, so equal vectors, one vector or an empty table
    give no rows. ``deviation`` is exact, and null where it is no 64-bit integer. Other columns are ignored.

    The rows are written once as integers and read by every product; the driver holds matrices of vector length times
    components. Nothing else is shuffled than entries of such matrices.
    """
    rows = written(integer_rows(vectors, scale, shift), "whitening")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(0, object)
        for batch in by_bytes(batches, 1, part_bytes):
            dims = max([len(sums), *(len(v) // 8 for v in batch.column(1).to_pylist())])
            x = matrix(batch.column(1), dims, shift).astype(object).sum(axis=0) if dims else sums
            sums = np.concatenate([sums, np.full(dims - len(sums), n * shift, object)]) + x
            n += batch.num_rows
        columns = [pa.array([-1, *range(len(sums))]), pa.array([n] * (len(sums) + 1)), pa.array([str(v) for v in [0, *sums]])]
        yield pa.RecordBatch.from_arrays(columns, ["position", "n", "total"])

    parts = rows.mapInArrow(totals, "position long, n long, total string").withColumn("total", F.col("total").cast("decimal(38,0)"))
    found = {r["position"]: r for r in parts.groupBy("position").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()}
    n, dims = (found[-1]["n"], len(found) - 1) if found else (0, 0)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not n or not dims:
        return vectors.sparkSession.createDataFrame([], schema)
    sums = [int(found[i]["total"]) + shift * (n - found[i]["n"]) for i in range(dims)]  # a task may have short vectors alone
    centred = Centred(n, sums, shift, part_bytes)

    def product(columns: np.ndarray) -> np.ndarray:
        return summed(rows, centred, lambda c: c.T @ (c @ columns), columns.shape)

    trace = float(summed(rows, centred, lambda c: np.array([[(c * c).sum()]]), (1, 1))[0, 0])
    if trace <= 0:
        return vectors.sparkSession.createDataFrame([], schema)
    values, axes = jacobi_davidson(product, dims, min(components, dims))
    order = [i for i in np.argsort(-values, kind="stable") if values[i] > least * values.max()]
    values, turn = values[order], axes[:, order] / np.sqrt(values[order])
    kept = len(values)
    error = float(np.abs(summed(rows, centred, lambda c: (c @ turn).T @ (c @ turn), (kept, kept)) - np.eye(kept)).max())
    names = [c.split()[0] for c in schema.split(", ")]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, exact in centred.parts(batches):
            count = len(exact)
            white = (exact / n).astype(float) @ turn
            columns = [
                ids.take(pa.array(np.repeat(np.arange(count), kept))),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), count)),
                pa.array(np.full(count * kept, n)),
                pa.array(centred.deviations(exact), pa.int64()).take(pa.array(np.repeat(np.arange(count), kept))),
                pa.array(white.ravel()),
                pa.array(np.tile(values / trace, count)),
                pa.array(np.full(count * kept, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(mapped, schema)
