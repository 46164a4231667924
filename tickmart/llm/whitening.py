"""Embedding whitening (operator 12): pivoted Cholesky and one-sided Jacobi.

Entries become integers, ``x = floor(64 * c) + 1000000``, so copies are found exactly
and sums are exact.  The fit list is each distinct x vector once (one grouped
shuffle; copies of one vector are merged before it).  Three passes over the staged
fit list follow, each a partial sum a task: count and sums S, the scatter of the
centred vectors ``(n * x - S) / n``, and the covariance of what was whitened.  Only sums
of the width of a vector (d, then d * d) reach the driver, however many vectors
there are.  There the scatter V is factored with pivots, ``V[p, p] = L L^T``, up to its
rank, and plane rotations from the right make the columns of L orthogonal: their
squared norms are the eigenvalues, the normalised columns the components.

Defined results: a null vector, or one with a null or non-finite entry, is dropped;
so is one whose length is not that of most distinct vectors (of equally many, the
longest), which has no place in the scatter; entries beyond +-2**45 in x count as
that bound; repeated rows are whitened each, but fitted once; a null id stays; as
many components come out as the scatter has rank (none for one distinct vector),
16 at most; equal eigenvalues give any unit vectors of their space, the same for all
rows; a deviation beyond 64 bits is null; an empty table gives no rows.  Only the
named columns are looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.sinks.tables import stage

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
BOUND = 1 << 45
LONG = (1 << 63) - 1
RANK_TOLERANCE = 1e-12          # pivots below this share of the first one are none
BLOCK = 4096                    # vectors multiplied at a time


def grid_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, x (array of longs) of the rows whose vectors are whole and finite."""
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    grid = F.transform("v", lambda c: F.least(F.greatest(F.floor(SCALE * c), F.lit(-BOUND)), F.lit(BOUND)) + SHIFT)
    return (vectors.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
            .where(F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True))).select("vec_id", grid.alias("x")))


def _matrix(column) -> np.ndarray:
    """The vectors of an Arrow batch, one a row."""
    if not len(column):
        return np.zeros((0, 0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _fits(x: np.ndarray, n: int, sums: list[int]) -> bool:
    """Whether n * x - S stays within 64 bits."""
    most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    return n * most + max((abs(s) for s in sums), default=0) <= LONG


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact (Python integers where 64 bits are too few)."""
    if _fits(x, n, sums):
        return n * x - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return deviations(x, n, sums).astype(np.float64) / n


def _column_sums(batches):
    """Per task: how many vectors (place -1), and the sum at each place."""
    count, sums = 0, None
    for batch in batches:
        x = _matrix(batch.column(0))
        if not len(x):
            continue
        # Halves of 32 bits each, so that a batch's sums stay exact.
        part = [(int(a) << 32) + int(b) for a, b in zip((x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0), strict=True)]
        count += len(x)
        sums = part if sums is None else [a + b for a, b in zip(sums, part, strict=True)]
    if sums is not None:
        yield pa.RecordBatch.from_pydict({"place": pa.array([-1, *range(len(sums))], pa.int32()),
                                          "total": pa.array([str(s) for s in [count, *sums]])})


def _products(to_rows):
    """Per task: upper triangle of sum(rows^T rows) and, at (-1, j), the sums."""
    def run(batches):
        total = ones = None
        for batch in batches:
            x = _matrix(batch.column(0))
            for lo in range(0, len(x), BLOCK):
                rows = to_rows(x[lo:lo + BLOCK])
                total = rows.T @ rows if total is None else total + rows.T @ rows
                ones = rows.sum(0) if ones is None else ones + rows.sum(0)
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(np.concatenate((i, np.full(len(ones), -1))).astype(np.int32)),
                "j": pa.array(np.concatenate((j, np.arange(len(ones)))).astype(np.int32)),
                "v": pa.array(np.concatenate((total[i, j], ones)))})
    return run


def covariance(fit: DataFrame, n: int, to_rows) -> np.ndarray:
    """Covariance, divisor n, of ``to_rows(x)`` over the fit list."""
    sums = fit.mapInArrow(_products(to_rows), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    pairs = sums[sums["i"] >= 0]
    width = int(pairs["j"].max()) + 1
    out, ones = np.zeros((width, width)), np.zeros(width)
    out[pairs["i"], pairs["j"]] = out[pairs["j"], pairs["i"]] = pairs["v"]
    single = sums[sums["i"] < 0]
    ones[single["j"]] = single["v"]
    return out / n - np.outer(ones / n, ones / n)


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L (d rows, rank columns) with ``L L^T = v``: each step takes the largest
    remaining diagonal entry.  Rows stay in the order of v."""
    left = np.diag(v).astype(float).copy()
    columns = []
    first = left.max(initial=0.0)
    while len(columns) < len(v):
        p = int(left.argmax())
        if left[p] <= RANK_TOLERANCE * first or left[p] <= 0:
            break
        column = v[:, p].astype(float).copy()
        for c in columns:
            column -= c * c[p]
        column /= np.sqrt(left[p])
        left -= column * column
        left[p] = -1.0          # taken; its row in later columns is zero
        columns.append(column)
    return np.column_stack(columns) if columns else np.zeros((len(v), 0))


def _rounds(n: int):
    """Pairings of n columns, each pair once: a round-robin tournament."""
    ring = list(range(n + n % 2))
    for _ in range(len(ring) - 1):
        pairs = [(min(a, b), max(a, b)) for a, b in zip(ring[:len(ring) // 2], ring[::-1], strict=False)]
        pairs = [p for p in pairs if p[1] < n]
        if pairs:
            yield np.array(pairs).T
        ring = [ring[0], ring[-1], *ring[1:-1]]


def jacobi_columns(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of ``factor factor^T``, falling:
    rotations of two columns each until all are orthogonal to double precision."""
    a = factor.astype(float).copy()
    rounds = list(_rounds(a.shape[1]))
    for _ in range(sweeps):
        worst = 0.0
        for p, q in rounds:
            left, right = a[:, p], a[:, q]
            alpha, beta, gamma = (left * left).sum(0), (right * right).sum(0), (left * right).sum(0)
            scale = np.sqrt(alpha * beta)
            turn = np.abs(gamma) > 1e-15 * scale
            if not turn.any():
                continue
            worst = max(worst, float((np.abs(gamma[turn]) / scale[turn]).max()))
            g = np.where(turn, gamma, 1.0)
            zeta = (beta - alpha) / (2 * g)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            a[:, p], a[:, q] = c * left - s * right, s * left + c * right
        if worst < 1e-14:
            break
    values = (a * a).sum(0)
    order = np.argsort(-values, kind="stable")
    values = values[order]
    return values, a[:, order] / np.sqrt(values)


def _usual_width(fit: DataFrame) -> int | None:
    top = fit.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    return top["w"] if top else None


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = grid_vectors(vectors, key, vector)
    spark = rows.sparkSession
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    fit = stage(rows.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit")
    width = _usual_width(fit)
    if not width:
        return spark.createDataFrame([], schema)
    usual = F.size("x") == width
    fit = fit.where(usual)
    totals = (fit.mapInArrow(_column_sums, "place int, total string").groupBy("place")
              .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("place").collect())
    n, sums = int(totals[0]["total"]), [int(r["total"]) for r in totals[1:]]

    v = covariance(fit, n, lambda x: _centred(x, n, sums))
    values, vectors_ = jacobi_columns(pivoted_cholesky(v))
    m = min(components, len(values))
    if not m:
        return spark.createDataFrame([], schema)
    trace = float(np.trace(v))
    project = vectors_[:, :m] / np.sqrt(values[:m])
    explained = values[:m] / trace

    error = float(np.abs(covariance(fit, n, lambda x: _centred(x, n, sums) @ project) - np.eye(m)).max())

    def whitened(batches):
        for batch in batches:
            ids, x = batch.column(0), _matrix(batch.column(1))
            for lo in range(0, len(x), BLOCK):
                d = deviations(x[lo:lo + BLOCK], n, sums)
                size = len(d)
                w = (d.astype(np.float64) / n) @ project
                most = int(np.abs(d).max(initial=0))
                if d.dtype != object and most * most * width > LONG:
                    d = d.astype(object)
                squares = (d * d).sum(1)
                exact = pa.array([int(s) if s <= LONG else None for s in squares], pa.int64())
                again = pa.array(np.repeat(np.arange(size), m))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, size).take(again), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * m, n, np.int64)), exact.take(again), pa.array(w.ravel()),
                    pa.array(np.tile(explained, size)), pa.array(np.full(size * m, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(usual).mapInArrow(whitened, schema)
