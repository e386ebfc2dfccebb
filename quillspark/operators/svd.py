"""Truncated SVD of a distributed sparse matrix.

Rows stay where they are. A pass over them multiplies A'A with a few columns:
each task sums its rows' part, sends it in packed blocks of features, and the
blocks are added up by block number. On the driver live only feature-sized
arrays of a few dozen columns (features x (k + oversample), bounded by the
vocabulary size and k); the rest is small matrices.

The range finder starts from random columns and extends a block Krylov basis by
the residuals of the Ritz vectors until they vanish, restarting from the best
Ritz vectors when the basis is full, so a few passes give all digits. No
centring (as a truncated SVD of text features has none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 1 << 12
ENTRIES = 1 << 16  # non-zero entries that are worked on at once
KEPT_BLOCKS = 4


def sparse_rows(df: DataFrame, features: str, *keep: str) -> DataFrame:
    """(keep..., idx, val, size): a vector column as indices and values; null vectors are rows of zeros."""
    v = F.unwrap_udt(F.col(features))
    dense = v["type"] == 1
    positions = F.sequence(F.lit(0), F.size(v["values"]) - 1)
    idx = F.when(dense, F.when(F.size(v["values"]) > 0, positions)).otherwise(v["indices"])
    none = F.array()
    return df.select(*keep, F.coalesce(idx, none.cast("array<int>")).alias("idx"), F.coalesce(v["values"], none.cast("array<double>")).alias("val"),
                     F.when(dense, F.size(v["values"])).otherwise(v["size"]).alias("size"))


def _lists(batch: pa.RecordBatch, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each entry, index, value) of a batch with lists of both."""
    idx, val = batch.column(first), batch.column(first + 1)
    size = np.diff(idx.offsets.to_numpy())
    return np.repeat(np.arange(len(size)), size), idx.flatten().to_numpy(), val.flatten().to_numpy()


def _project(row: np.ndarray, idx: np.ndarray, val: np.ndarray, n: int, q: np.ndarray) -> np.ndarray:
    """Rows times q, for n rows given by their entries in row order."""
    out = np.zeros((n, q.shape[1]))
    for lo in range(0, len(row), ENTRIES):
        r, i, v = row[lo: lo + ENTRIES], idx[lo: lo + ENTRIES], val[lo: lo + ENTRIES]
        first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        out[r[first]] += np.add.reduceat(v[:, None] * q[i], first, axis=0)
    return out


def gram_times(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """A'A q for the rows A of (idx, val): one pass, summed per task and then per block of features."""
    d, width = q.shape
    sent = rows.sparkSession.sparkContext.broadcast(q)

    def part(batches):
        q = sent.value
        total = np.zeros((d, width))
        for batch in batches:
            row, idx, val = _lists(batch, 0)
            y = _project(row, idx, val, batch.num_rows, q)
            order = np.argsort(idx, kind="stable")
            row, idx, val = row[order], idx[order], val[order]
            for lo in range(0, len(row), ENTRIES):
                i = idx[lo: lo + ENTRIES]
                first = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
                total[i[first]] += np.add.reduceat(val[lo: lo + ENTRIES, None] * y[row[lo: lo + ENTRIES]], first, axis=0)
        for b in range(0, d, BLOCK):
            if total[b: b + BLOCK].any():
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([total[b: b + BLOCK].tobytes()], pa.binary())], names=["block", "sums"])

    def add(batches):
        now, total = None, None
        for batch in batches:
            for b, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if b != now:
                    if now is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "sums"])
                    now, total = b, 0.0
                total = total + np.frombuffer(sums)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "sums"])

    blocks = rows.select("idx", "val").mapInArrow(part, "block int, sums binary")
    out = np.zeros((d, width))
    for r in blocks.repartition("block").sortWithinPartitions("block").mapInArrow(add, "block int, sums binary").collect():
        out[r.block: r.block + BLOCK] = np.frombuffer(r.sums).reshape(-1, width)
    return out


def _orthonormal(block: np.ndarray, basis: np.ndarray | None = None) -> np.ndarray:
    """Orthonormal columns of what the block adds to the basis; columns that add nothing go."""
    for _ in range(2):  # once more for what rounding leaves
        if basis is not None:
            block = block - basis @ (basis.T @ block)
        size = np.linalg.norm(block, axis=0)
        block = block[:, size > 1e-12] / size[size > 1e-12]
        if not block.shape[1]:
            return block
        block, r = np.linalg.qr(block)
        block = block[:, np.abs(np.diag(r)) > 1e-10]
    return block


@dataclass
class SvdModel:
    """Singular values and right singular vectors (features x k; each vector's largest entry is positive)."""

    values: np.ndarray
    components: np.ndarray

    def transform(self, df: DataFrame, features: str = "features", id_col: str = "text_id", out: str = "svd") -> DataFrame:
        """(id, out): each row's coordinates along the singular vectors, in Arrow batches."""
        sent = df.sparkSession.sparkContext.broadcast(self.components)
        source = sparse_rows(df, features, id_col)
        schema = T.StructType([source.schema[id_col], T.StructField(out, T.ArrayType(T.DoubleType()))])

        def run(batches):
            for batch in batches:
                y = _project(*_lists(batch, 1), batch.num_rows, sent.value)
                at = pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(at, pa.array(y.ravel()))], names=schema.names)

        return source.mapInArrow(run, schema)


def fit_svd(df: DataFrame, k: int = 63, features: str = "features", oversample: int = 10, tolerance: float = 1e-10,
            max_passes: int = 60, seed: int = 42) -> SvdModel:
    """The k largest singular values and right singular vectors of the rows; fewer if there are fewer features.

    Stops when the residuals |A'A v - s^2 v| of all k are under ``tolerance`` times the largest s^2; raises if
    ``max_passes`` do not get there. A table without rows or features gives an empty model."""
    rows = sparse_rows(df, features)
    d = rows.agg(F.max("size")).first()[0] or 0
    k = min(k, d)
    width = min(d, k + oversample)
    if not width:
        return SvdModel(np.zeros(0), np.zeros((d, 0)))
    basis, products = np.zeros((d, 0)), np.zeros((d, 0))
    fresh = _orthonormal(np.random.default_rng(seed).standard_normal((d, width)))
    for _ in range(max_passes):
        products = np.hstack([products, gram_times(rows, fresh)])
        basis = np.hstack([basis, fresh])
        small = basis.T @ products
        size, mix = np.linalg.eigh((small + small.T) / 2)
        best = np.argsort(-size)[:width]
        size, ritz, image = size[best], basis @ mix[:, best], products @ mix[:, best]
        rest = image - ritz * size
        if np.linalg.norm(rest[:, :k], axis=0).max() <= tolerance * max(size[0], 1e-300):
            break
        if basis.shape[1] + width > KEPT_BLOCKS * width:
            basis, products = ritz, image
        fresh = _orthonormal(rest, basis)
        if not fresh.shape[1]:
            break
    else:
        raise ValueError("the singular vectors did not settle: raise max_passes or the tolerance")
    top = np.abs(ritz[:, :k]).argmax(axis=0)
    return SvdModel(np.sqrt(np.maximum(size[:k], 0)), ritz[:, :k] * np.where(ritz[top, np.arange(k)] < 0, -1.0, 1.0))


def reduce_svd(df: DataFrame, k: int = 63, features: str = "features", id_col: str = "text_id") -> DataFrame:
    """(id, svd): projection on the k largest singular directions, without centring."""
    return fit_svd(df, k, features).transform(df, features, id_col)
