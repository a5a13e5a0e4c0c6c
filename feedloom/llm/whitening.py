"""Whitening of embeddings by a bit-sliced scatter matrix.

Each entry c becomes the whole number floor(scale * c).  The fit list holds each distinct vector once.  Over it,
every dimension is shifted by its minimum, so that its values are not negative, and the bits of equal weight of
all rows of a block are packed into 64-bit words, a plane for each bit.  The AND of plane a of dimension i and
plane b of dimension j has as many ones as rows in which both bits are set, so the sum of those counts times
2^(a+b) is the sum of products of the two dimensions, exactly, and the counts of single planes give the sums.
Counts of equal weight a+b are added in 64 bits, in tasks and then in Spark; weights are applied in Python's
unbounded integers, which also undo the shift and centre: n * sum(xy) - sum(x) * sum(y).  Only then does the
matrix become floating, and its eigenvectors are found.

What reaches the driver depends on the number of dimensions and of bits, not on rows.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped, and so are
those of another length than most rows (of equally frequent lengths the smaller one counts); repeated rows and
rows without an id are returned like all others; entries beyond 64 bits take the nearest whole number that
fits; a component without variance can't be whitened and is left out, as are those beyond the dimensions, so
an empty table or one distinct vector gives no rows; ``deviation`` is null where it doesn't fit 64 bits.  Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import work_path

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 1 << 15  # rows whose planes are held at a time
FLAT = 1e-13  # share of the whole variance under which a component has none


@dataclass(frozen=True)
class Whitening:
    """What the fit list holds: counts, sums, and the leading components of its covariance."""

    rows: int
    sums: tuple[int, ...]
    vectors: np.ndarray  # a column for each component
    variances: np.ndarray
    explained: np.ndarray


def usable(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, x`` of the rows that take part, as whole numbers."""
    v = F.col("v")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(v.isNotNull() & (F.size(v) > 0) & finite)
    sizes = rows.groupBy(F.size(v).alias("size")).count().orderBy(F.desc("count"), "size").first()
    rows = rows.where(F.size(v) == (sizes["size"] if sizes else 0))
    return rows.select("vec_id", F.transform(v, lambda c: F.floor(c * scale)).cast("array<long>").alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def planes(x: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of the columns of a matrix of unsigned numbers, packed along the rows into words.

    A row for each plane, with the dimension and the weight of each.
    """
    n, padding = len(x), -len(x) % 64
    dimension = np.repeat(np.arange(len(bits)), bits)
    weight = np.arange(len(dimension)) - np.repeat(np.cumsum(bits) - bits, bits)
    ones = np.zeros((len(dimension), n + padding), np.uint8)
    for k, (d, w) in enumerate(zip(dimension, weight)):
        ones[k, :n] = (x[:, d] >> np.uint64(w)) & np.uint64(1)
    return np.packbits(ones, axis=1).view(np.uint64), dimension, weight


def scatter(x: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Counts of rows by pair of dimensions i <= j and weight: ``[i, j, weight]``; the row after the last one of i
    has the single planes, so that sums come from the same counts."""
    d, widest = len(bits), int(bits.max(initial=0))
    packed, dimension, weight = planes(x, bits)
    counts = np.zeros((d + 1, d, max(2 * widest - 1, 1)), np.int64)
    np.add.at(counts, (d, dimension, weight), np.bitwise_count(packed).sum(1, dtype=np.int64))
    for k in range(len(dimension)):
        rest = slice(np.searchsorted(dimension, dimension[k]), None)
        both = np.bitwise_count(packed[rest] & packed[k]).sum(1, dtype=np.int64)
        np.add.at(counts, (dimension[k], dimension[rest], weight[rest] + weight[k]), both)
    return counts


def _extent(fit: DataFrame) -> tuple[int, list[int], list[int]]:
    """Rows, and the least and largest value of each dimension."""

    def run(batches):
        n, least, most = 0, None, None
        for batch in batches:
            x = _matrix(batch.column(0))
            if not len(x):
                continue
            n += len(x)
            low, high = x.min(0), x.max(0)
            least, most = (low, high) if least is None else (np.minimum(least, low), np.maximum(most, high))
        if n:
            at = np.arange(len(least))
            yield pa.record_batch([pa.array(at), pa.array(least), pa.array(most), pa.array(np.full(len(at), n))], names=["d", "least", "most", "n"])

    found = fit.select("x").mapInArrow(run, "d long, least long, most long, n long")
    rows = found.groupBy("d").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n")).orderBy("d").collect()
    return (rows[0]["n"] if rows else 0), [r["least"] for r in rows], [r["most"] for r in rows]


def moments(fit: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums and sums of products of ``x``, exact, over all rows of ``fit``."""
    n, least, most = _extent(fit)
    if not n:
        return 0, [], []
    d = len(least)
    bits = np.array([(high - low).bit_length() for low, high in zip(least, most)], np.int64)
    shift = np.array(least, np.int64)

    def run(batches):
        counts, held, size = None, [], 0

        def flush():
            nonlocal counts, held, size
            x = np.concatenate(held).view(np.uint64) - shift.view(np.uint64)  # differences of 64-bit numbers, unsigned
            own = scatter(x, bits)
            counts, held, size = own if counts is None else counts + own, [], 0

        for batch in batches:
            x = _matrix(batch.column(0))
            for at in range(0, len(x), block_rows):
                part = np.ascontiguousarray(x[at:at + block_rows])
                if size and size + len(part) > block_rows:
                    flush()
                held.append(part)
                size += len(part)
        if size:
            flush()
        if counts is not None:
            i, j, weight = np.nonzero(counts)
            yield pa.record_batch([pa.array(i), pa.array(j), pa.array(weight), pa.array(counts[i, j, weight])], names=["i", "j", "weight", "n"])

    found = fit.select("x").mapInArrow(run, "i long, j long, weight long, n long")
    table = found.groupBy("i", "j", "weight").agg(F.sum("n").alias("n")).toArrow()
    sums, products = [0] * d, [[0] * d for _ in range(d)]
    for i, j, weight, count in zip(*(table[c].to_pylist() for c in ("i", "j", "weight", "n"))):
        if i == d:
            sums[j] += count << weight
        else:
            products[i][j] += count << weight
    for i in range(d):  # undo the shift: x = least + u
        for j in range(i, d):
            products[i][j] += least[i] * sums[j] + least[j] * sums[i] + n * least[i] * least[j]
            products[j][i] = products[i][j]
    return n, [s + n * low for s, low in zip(sums, least)], products


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct vector once, written to the shared folder."""
    path = work_path(rows.sparkSession, "vectors")
    rows.select("x").distinct().write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def learn(fit: DataFrame, components: int = COMPONENTS, block_rows: int = BLOCK_ROWS) -> Whitening:
    """The leading components of the covariance of the rows of ``fit``."""
    n, sums, products = moments(fit, block_rows)
    d = len(sums)
    centred = np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)]).reshape(d, d)
    trace = sum(n * products[i][i] - sums[i] ** 2 for i in range(d)) / (n * n) if n else 0.0
    variances, vectors = np.linalg.eigh(centred) if d else (np.zeros(0), np.zeros((0, 0)))
    order = [i for i in np.argsort(-variances, kind="stable") if variances[i] > FLAT * trace][:components]
    return Whitening(n, tuple(sums), vectors[:, order], variances[order], variances[order] / trace if order else np.zeros(0))


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    """A row for each row of ``x`` and a column for each component, of unit variance over the fit list."""
    whole = [divmod(s, model.rows) for s in model.sums]  # the mean as a whole number and a rest, so that nothing large is subtracted in doubles
    base, rest = np.array([w for w, _ in whole], np.int64), np.array([r / model.rows for _, r in whole])
    return ((x - base).astype(float) - rest) @ model.vectors / np.sqrt(model.variances)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened fit list less the identity, measured on its rows."""
    k = len(model.variances)
    if not k:
        return 0.0

    def run(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            y = _projected(_matrix(batch.column(0)), model) if batch.num_rows else np.zeros((0, k))
            first += y.sum(0)
            second += y.T @ y
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.record_batch([pa.array(np.r_[np.full(k, -1), i]), pa.array(np.r_[np.arange(k), j]), pa.array(np.r_[first, second.ravel()])], names=["i", "j", "s"])

    sums = {(r["i"], r["j"]): r["s"] / model.rows for r in fit.select("x").mapInArrow(run, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
    return max(abs(sums[i, j] - sums[-1, i] * sums[-1, j] - (i == j)) for i in range(k) for j in range(k))


def deviations(x: np.ndarray, rows: int, sums: tuple[int, ...]) -> pa.Array:
    """Sum over dimensions of (rows * x - sum)^2 of each row, exact; null beyond 64 bits."""
    s = np.array([float(v) for v in sums])
    rough = ((rows * x.astype(float) - s) ** 2).sum(1)
    if rough.max(initial=0) < 2.0 ** 62:  # no gap, square or sum of squares leaves 64 bits; products that do wrap back
        gap = np.int64(rows) * x - np.array([v % (1 << 64) for v in sums], np.uint64).view(np.int64)
        return pa.array((gap * gap).sum(1))
    exact = [sum((rows * v - t) ** 2 for v, t in zip(row, sums)) for row in x.tolist()]
    return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())


def transform(rows: DataFrame, model: Whitening, error: float) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each row and component."""
    k = len(model.variances)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            each = pa.array(np.repeat(np.arange(len(x)), k))
            columns = [
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, model.rows)),
                deviations(x, model.rows, model.sums).take(each), pa.array(_projected(x, model).ravel()), pa.array(np.tile(model.explained, len(x))),
                pa.array(np.full(len(x) * k, error)),
            ]
            yield pa.record_batch(columns, names=names)

    kinds = ("long", "int", "long", "long", "double", "double", "double")
    return rows.select("vec_id", "x").mapInArrow(run, ", ".join(f"{n} {kind}" for n, kind in zip(names, kinds)))


def whiten(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """All steps: the rows of a table of vectors, whitened by the components of its own distinct vectors."""
    rows = usable(table, id_column, vector, scale)
    fit = fit_list(rows)
    model = learn(fit, components)
    return transform(rows, model, identity_error(fit, model))
