"""Embeddings projected on their principal components and scaled to unit variance.

The leading eigenvectors of the covariance come from Chebyshev-filtered subspace
iteration. A block of ``WANTED + SPARE`` orthonormal columns Q is multiplied by
the covariance in passes over the stored vectors: each task centres its rows,
adds up its share of X'(XQ) and hands on one row per dimension; Spark sums those.
A filter is a polynomial in the covariance, run as the Chebyshev recurrence of
one pass per degree: on the interval that holds the unwanted eigenvalues it stays
within 1, above it grows as fast as any polynomial can. QR and a Rayleigh-Ritz step
follow. The interval ends at the least Ritz value of the block; it starts where a
residual bound of the first block puts its least Ritz value. Leading pairs that have converged are locked.
The iteration ends when it is certified: every wanted pair has ``|V q - e q| <= TOLERANCE * e1``. Degenerate eigenvalues
do no harm, any basis of their space fulfils that. The covariance itself is never
made, and of the vectors only d x (WANTED + SPARE) sums reach the driver.

Numbers. An entry c counts as ``x = floor(64 c) + 1000000``. Rows are centred
as whole numbers, ``n x - S``, before anything is multiplied, so the large offset
costs no digits. They are stored once in packed blocks of ``BLOCK_BYTES``, under
the shared folder, and each pass reads those.

Rows whose vector is null or holds a null or a number that is not finite are left
out; the dimension is the length of the longest vector left, and shorter ones, which
lack entries, are left out too. Entries beyond 2**52 / 64 count as that. Components
without variance (eigenvalue below 1e-12 of the first) have no unit variance to
scale to and are left out, so a table of equal vectors gives no rows. Ids are only
carried along: null and repeated ids do no harm. A deviation beyond 64 bits is null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.shipping import ship
from readloom.session import written

SCALE = 64
OFFSET = 1_000_000
WANTED = 32
SPARE = 16
DEGREE = 10
TOLERANCE = 1e-14
ROUNDS = 40
SEED = 42
MOST = 2.0 ** 52
BLOCK_BYTES = 1 << 18
NO_VARIANCE = 1e-12
SPREAD = 1e8


class NotCertified(RuntimeError):
    """The wanted pairs did not reach the tolerance."""


def whole_vectors(df: DataFrame, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v``: vectors of finite entries as whole numbers, without the common offset."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(v, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(MOST)), F.lit(-MOST))).cast("long"))
    return df.select(F.col(row_id).alias("vec_id"), whole.alias("v"), F.coalesce(fine, F.lit(False)).alias("_fine")).where("_fine").drop("_fine")


def packed(vectors: DataFrame, d: int) -> DataFrame:
    """``vec_ids, body``: the vectors of ``d`` entries, many in one row as the bytes of a matrix."""
    of_id = vectors.schema["vec_id"].dataType.simpleString()
    rows = max(1, BLOCK_BYTES // (8 * max(d, 1)))

    def pack(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                part = batch.slice(low, rows)
                body = part.column(1).flatten().to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([ids, pa.array([body], pa.binary())], ["vec_ids", "body"])

    return vectors.where(F.size("v") == d).mapInArrow(pack, f"vec_ids array<{of_id}>, body binary")


def matrix_of(body, d: int) -> np.ndarray:
    return np.frombuffer(body.as_buffer(), "<i8").reshape(-1, d)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n x - S``, exact: as Python's whole numbers where 64 bits may not hold it."""
    most = int(np.abs(x).max(initial=0))
    if 2 * n * most < 1 << 62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def column_sums(blocks: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Vectors, and their sum in each dimension as Python's whole numbers."""

    def add(batches):
        n, sums = 0, np.zeros(d, object)
        for batch in batches:
            for body in batch.column(0):
                x = matrix_of(body, d)
                n += len(x)
                # sums of halves stay within 64 bits
                sums += (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        high = [int(s) >> 40 for s in sums]
        low = [int(s) & ((1 << 40) - 1) for s in sums]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64())],
                                         ["i", "n", "high", "low"])

    # the sum of a long column that may outgrow it
    wide = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low")]
    found = blocks.select("body").mapInArrow(add, "i int, n long, high long, low long").groupBy("i").agg(F.sum("n").alias("n"), *wide).collect()
    sums, n = np.zeros(d, object), 0
    for r in found:
        n, sums[r.i] = r.n, (int(r.high) << 40) + int(r.low)
    return n, sums


def product(blocks: DataFrame, q: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, float]:
    """V Q in one pass over the vectors, and the trace of V."""
    d, m = q.shape

    def add(batches):
        out, square = np.zeros((d, m)), np.zeros(d)
        for batch in batches:
            for body in batch.column(0):
                x = centred(matrix_of(body, d), n, sums).astype(float) / n
                out += x.T @ (x @ q)
                square += (x * x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(np.column_stack([out, square])), pa.list_(pa.float64()))], ["i", "z"])

    parts = blocks.select("body").mapInArrow(add, "i int, z array<double>")
    total = parts.groupBy("i").agg(F.array(*[F.sum(F.col("z")[k]) for k in range(m + 1)]).alias("z")).collect()
    out = np.zeros((d, m + 1))
    for r in total:
        out[r.i] = r.z
    return out[:, :m] / n, float(out[:, m].sum() / n)


def filtered(multiply, q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of that degree for [low, high], applied to Q and scaled to stay near 1 at ``top``."""
    centre, half = (low + high) / 2, max((high - low) / 2, np.finfo(float).eps * max(top, 1e-300))
    scale = first = half / max(top - centre, half)
    before, now = q, (multiply(q) - centre * q) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        before, now = now, (multiply(now) - centre * now) * (2 * following / half) - scale * following * before
        scale = following
    return now


def ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors, and the residual norm of each pair."""
    small = q.T @ vq
    value, turn = np.linalg.eigh((small + small.T) / 2)
    value, turn = value[::-1], turn[:, ::-1]
    vectors = q @ turn
    return value, vectors, np.linalg.norm(vq @ turn - vectors * value, axis=0)


def degree_for(values: np.ndarray, k: int, low: float, high: float, most: int) -> int:
    """The largest degree up to ``most`` that raises the first of the values no more than ``SPREAD`` times above the ``k``-th.

    A higher one would drown the lesser columns in rounding errors along the first.
    """
    centre, half = (low + high) / 2, max((high - low) / 2, np.finfo(float).eps * values[0])
    first, last = (np.arccosh(max((v - centre) / half, 1.0)) for v in (values[0], values[k - 1]))
    return int(np.clip(np.log(SPREAD) / max(first - last, 1e-9), 1, most))


def components(multiply, d: int, wanted: int = WANTED, spare: int = SPARE, degree: int = DEGREE, tolerance: float = TOLERANCE,
               seed: int = SEED, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, int]:
    """The leading eigenvalues and eigenvectors of ``multiply``, and the filters it took.

    Leading pairs that are certified are locked: the filter runs on the others, at right angles to them.
    Raises ``NotCertified`` when some pair has not reached the tolerance after ``rounds`` filters.
    """
    k, m = min(wanted, d), min(wanted + spare, d)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, m)))[0]
    low, best, steps = None, np.inf, 0
    while True:
        value, vectors, residual = ritz(q, multiply(q))
        worst, bound = residual[:k].max(), tolerance * max(value[0], 0.0)
        # on long sums rounding may stop the residual a little above the tolerance; no filter lowers it further
        if worst <= bound or not value[0] > 0 or (best <= 64 * bound and worst >= best):
            return np.maximum(value[:k], 0), vectors[:, :k], steps
        if steps == rounds:
            raise NotCertified(f"residual {worst / value[0]:.1e} of the first eigenvalue after {steps} filters")
        best = min(best, worst)
        low = max(value[-1] - residual[-1], 0.0) if low is None else min(low, max(value[-1], 0.0))
        high = max(value[-1], low)
        done = int(np.argmax(residual > bound))
        locked, rest = vectors[:, :done], value[done:]

        def deflated(x):
            y = multiply(x)
            return y - locked @ (locked.T @ y)

        raised = filtered(deflated, vectors[:, done:], low, high, rest[0], degree_for(rest, k - done, low, high, degree))
        q = np.linalg.qr(np.column_stack([locked, raised]))[0]
        steps += 1


def whitened_rows(blocks: DataFrame, n: int, sums: np.ndarray, vectors: np.ndarray, values: np.ndarray) -> DataFrame:
    """``vec_id, deviation, whitened``: one row per vector, its components as an array."""
    d = len(sums)
    of_id = blocks.schema["vec_ids"].dataType.elementType.simpleString()
    turn = vectors / np.sqrt(values)

    def project(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                far = centred(matrix_of(batch.column(1)[at], d), n, sums)
                most = int(np.abs(far).max(initial=0))
                if most * most * d < 1 << 63:
                    square = pa.array((far * far).sum(axis=1).astype(np.int64))
                else:
                    square = pa.array([s if s < 1 << 63 else None for s in (sum(int(v) ** 2 for v in row) for row in far)], pa.int64())
                z = (far.astype(float) / n) @ turn
                yield pa.RecordBatch.from_arrays([batch.column(0)[at].values, square, pa.array(list(z), pa.list_(pa.float64()))], ["vec_id", "deviation", "whitened"])

    return blocks.mapInArrow(project, f"vec_id {of_id}, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity; one pass, k x k sums."""

    def add(batches):
        both, plain = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            z = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            both += z.T @ z
            plain += z.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(np.column_stack([both, plain])), pa.list_(pa.float64()))], ["i", "z"])

    parts = rows.select("whitened").mapInArrow(add, "i int, z array<double>")
    out = np.zeros((k, k + 1))
    for r in parts.groupBy("i").agg(F.array(*[F.sum(F.col("z")[j]) for j in range(k + 1)]).alias("z")).collect():
        out[r.i] = r.z
    mean = out[:, k] / n
    return float(np.abs(out[:, :k] / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, row_id: str = "vec_id", vector: str = "embedding", wanted: int = WANTED, spare: int = SPARE,
           degree: int = DEGREE, seed: int = SEED) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every vector left and component.

    Components are numbered from 1 by falling variance.
    """
    of_id = df.schema[row_id].dataType.simpleString()
    vectors = written(whole_vectors(df, row_id, vector), "vectors")
    d = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    none = vectors.sparkSession.createDataFrame([], f"vec_id {of_id}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if not d:
        return none
    blocks = written(packed(vectors, d), "packed")
    n, sums = column_sums(blocks, d)
    trace = 0.0

    def multiply(q):
        nonlocal trace
        out, trace = product(blocks, q, n, sums)
        return out

    values, turn, _ = components(multiply, d, wanted, spare, degree, seed=seed)
    k = int((values > NO_VARIANCE * values[0]).sum())
    if not k:
        return none
    values, turn = values[:k], turn[:, :k]
    rows = whitened_rows(blocks, n, sums, turn, values)
    error = identity_error(rows, n, k)
    part = F.element_at(F.array(*[F.lit(float(v / trace)) for v in values]), F.col("component"))
    return (rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .withColumn("component", F.col("at") + 1)
            .select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", part.alias("explained"),
                    F.lit(error).alias("identity_error")))


ship(__name__)
