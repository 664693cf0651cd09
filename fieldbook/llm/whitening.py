"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred table of vectors.

The table X (one centred vector a row) is only used in products with a vector: X v, one number a row, and the
sum of rows times such numbers, X' u. Each step makes one job of both. Left vectors u have one number a row and
are never stored: all lie in the span of X, so each is X w with a w as short as a vector, and tasks compute
its part from their rows. Step j takes v_j, removes from X v_j what the left vectors before hold of
it, twice (once with the products X' u already known, once with those that the job measures), and X' u_j
gives v_j+1 after the same against the right vectors. The small bidiagonal matrix that results has the
singular values of X; its singular vectors turn the right vectors into components.

There are as many steps as a vector has entries, which is exact, repeated values included; for long vectors
``still`` ends earlier. Sums of tasks are added by Spark; the driver holds vectors of one row's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldbook.llm.tables import Scratch

COMPONENTS = 32
SHIFT = 1_000_000
_TINY = 1e-10


def integers(docs: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is complete, as ``x``: floor(64 c) + 1000000 of each entry c.

    A vector that is null, empty or holds a null or non-finite entry leaves. So do vectors of another length than
    the commonest (of equally common ones the longest). An entry of 2**56 or more, which could leave 64 bits, is an error.
    """
    entry = F.col(column)
    whole = F.size(entry) > 0
    whole &= ~F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    large = F.raise_error(F.lit("an entry is outside 64-bit integers")).cast("long")
    x = F.transform(entry, lambda c: F.when(F.abs(c) < 2.0 ** 56, F.floor(c.cast("double") * 64) + F.lit(SHIFT).cast("long")).otherwise(large))
    return docs.where(F.coalesce(whole, F.lit(False))).select(F.struct("*").alias("row"), x.alias("x"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sums(part, width: int):
    """A task's sum of ``part`` over its batches, one row of ``width`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if len(batch):
                total += part(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["part"])

    return run


def _added(rows: DataFrame, part, width: int) -> np.ndarray:
    """The sum of ``part`` over all batches of the rows; tasks send one row each, which Spark adds."""
    parts = rows.mapInArrow(_sums(part, width), "part array<double>")
    total = np.zeros(width)
    for k, value in parts.select(F.posexplode("part").alias("k", "v")).groupBy("k").agg(F.sum("v")).collect():
        total[k] = value
    return total


class Centred:
    """The centred table: sums of its products with vectors of a row's length."""

    def __init__(self, rows: DataFrame, n: int, sums: list[int]):
        self.rows, self.size = rows, len(sums)
        # n x - S is exact in integers, so centring loses nothing.
        self.block = lambda batch: centred(_matrix(batch.column("x"), len(sums)), n, sums).astype(float) / n

    def step(self, w: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """For r = X w: the products of the left vectors before with r, r'r and X'r, in one job."""
        k, block = len(before), self.block

        def part(batch: pa.RecordBatch) -> np.ndarray:
            x = block(batch)
            r = x @ w
            return np.concatenate([before @ (x.T @ r), [r @ r], x.T @ r])

        found = _added(self.rows, part, k + 1 + self.size)
        return found[:k], float(found[k]), found[k + 1:]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S; beyond 53 bits the integers stay exact, beyond 63 they become Python's."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    if most < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def bidiagonalised(table: Centred, wanted: int, still: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of the table, falling, and its right singular vectors as rows; zero values are left out.

    All steps, or only until no wanted value is further than ``still`` times the largest one from a true value; then
    copies of a value that occurs more than once may be missing.
    """
    size = table.size
    random = np.random.default_rng(12)
    right, left, images = np.zeros((0, size)), np.zeros((0, size)), np.zeros((0, size))
    alphas: list[float] = []
    links: list[float] = []

    def away(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - right.T @ (right @ v)
        return v

    v = random.normal(size=size)
    v /= np.linalg.norm(v)
    while True:
        # What the left vectors hold of X v is known from their images X'u; the job measures what rounding left of it.
        w = v - left.T @ (images @ v)
        more, square, image = table.step(w, left)
        w, image = w - left.T @ more, image - images.T @ more
        alpha = float(np.sqrt(max(square - more @ more, 0.0)))
        right = np.vstack([right, v])
        scale = max([alpha, *alphas])
        # Where X v lies in what the left vectors hold, there is no further left vector.
        ends = alpha <= _TINY * scale or scale == 0.0
        alphas.append(0.0 if ends else alpha)
        left = np.vstack([left, np.zeros(size) if ends else w / alpha])
        images = np.vstack([images, np.zeros(size) if ends else image / alpha])
        rest = away(images[-1] - alphas[-1] * v)
        link = float(np.linalg.norm(rest))
        if link <= _TINY * scale or scale == 0.0:
            link = 0.0
        done = len(alphas) == size
        if done or still is not None and len(alphas) > wanted and link:
            u, values, vt = np.linalg.svd(np.diag(alphas) + np.diag(links, 1))
            if done or (link * np.abs(u[-1, :wanted]) <= still * values[0]).all():
                keep = values > _TINY * scale
                return values[keep], (vt @ right)[keep]
        links.append(link)
        if not link:
            rest = away(random.normal(size=size))
        v = rest / np.linalg.norm(rest)


def whitened(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS, still: float | None = None) -> DataFrame:
    """The complete rows of ``vectors`` (as the struct ``row``) with their whitened coordinates.

    Further columns: n (rows), deviation (sum over dimensions of (n x - S)^2, exact), whitened (array, one number a
    component), explained (array, eigenvalue over the trace) and identity_error (how far the covariance of ``whitened``
    is from the identity). Null, empty or incomplete vectors are left out, as are those of an unusual length (see
    ``integers``); very long vectors only make the driver's vectors longer, and its small matrices as large as their square.
    Repeated rows count as often as they occur. Components of no variance do not exist, so equal vectors or a single row have none
    and empty arrays; an empty table gives an empty table. Of equal eigenvalues any basis may come. A deviation beyond 64 bits is
    an error. Columns of any name stay inside ``row``.
    """
    scratch = Scratch(vectors.sparkSession, "whitening")
    rows = scratch.put(integers(vectors, column), "rows")
    lengths = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    out = "row struct<{}>, n long, deviation long, whitened array<double>, explained array<double>".format(
        ", ".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in vectors.schema)
    )
    if lengths is None:
        return rows.select("row", *(F.lit(None).cast(t).alias(c) for c, t in (
            ("n", "long"), ("deviation", "long"), ("whitened", "array<double>"), ("explained", "array<double>"), ("identity_error", "double"))))
    size, n = lengths
    rows = rows.where(F.size("x") == size)
    # Exact, as decimals: sums of 64-bit numbers can leave 64 bits.
    sums = [int(s) for s in rows.agg(*(F.sum(F.col("x")[k].cast("decimal(20,0)")) for k in range(size))).first()]
    table = Centred(rows.select("x"), n, sums)
    block = table.block
    trace = float(_added(table.rows, lambda batch: np.array([np.square(block(batch)).sum()]), 1)[0]) / n
    values, basis = bidiagonalised(table, components, still)
    values, basis = values[:components], basis[:components]
    eigen = values ** 2 / n
    scaled = basis / np.sqrt(eigen)[:, None]
    k = len(eigen)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        y = block(batch) @ scaled.T
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    error = 0.0
    if k:
        found = _added(table.rows, moments, k + k * k) / n
        error = float(np.abs(found[k:].reshape(k, k) - np.outer(found[:k], found[:k]) - np.eye(k)).max())
    explained = (eigen / trace).tolist() if k else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = centred(_matrix(batch.column("x"), size), n, sums)
            if len(x) and float(np.square(x.astype(float)).sum(1).max()) >= 2.0 ** 63:
                raise OverflowError("a deviation does not fit into 64 bits")
            y = (x.astype(float) / n) @ scaled.T
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), pa.array([n] * len(x), pa.int64()), pa.array(np.square(x).sum(1).astype(np.int64)),
                pa.array(y.tolist(), pa.list_(pa.float64())), pa.array([explained] * len(x), pa.list_(pa.float64())),
            ], ["row", "n", "deviation", "whitened", "explained"])

    return rows.mapInArrow(run, out).withColumn("identity_error", F.lit(error))
