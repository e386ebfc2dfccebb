"""Operator 5: quality classifier with random Fourier features.

Each text gives a short vector of document statistics. Random Fourier features
of the standardised vector approximate a Gaussian kernel; ridge weights come
from normal equations summed over partitions of the labelled rows, all of them
(nothing is sampled). An isotonic map, fitted on labelled scores counted in
fixed bins, turns ridge scores into probabilities.

Only the statistics (one row of ``len(STATISTICS)`` numbers a text) meet the
labels; texts are read once and never shuffled. What reaches the driver has a
size that does not follow the corpus: moments, a matrix of ``features`` + 1
rows, and ``bins`` counts.

Cases: null or empty text has all-zero statistics and is scored like any other;
equal texts get equal scores; a row repeated in the input is scored each time;
null labels and null ids do not train; with no labelled rows every score is 0.5;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import textvec as V
from quillspark.session import cut_lineage

FEATURES = 128
GAMMA = 0.08
RIDGE = 1e-2
BINS = 512
SEED = 17
PARTS = 32
STATISTICS = ("log_words", "word_length", "word_length_sd", "upper", "digit", "sign", "symbol", "pipe", "shout", "stop_comma", "non_ascii",
              "distinct_words", "same_next", "repeat_grams", "dup_lines", "line_words", "mixed_words", "short_words")


def _mask(chars: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


UPPER, DIGIT = _mask(bytes(range(65, 91))), _mask(b"0123456789")
LETTER = _mask(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
SYMBOL, PIPE, SHOUT, STOP = _mask(b"#*$%&<>{}[]=~^@_"), _mask(b"|"), _mask(b"!?"), _mask(b".,;:")
SIGN = ~(LETTER | DIGIT | V.SPACE)


def statistics(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text of a slice."""
    n = len(offs) - 1
    space = V.SPACE[raw]
    starts, ends, of = V.runs(~space, offs)
    hashed = V.Hasher(raw)
    h = hashed.of(starts, ends)
    words = V.word_counts(of, n)
    per_word = np.maximum(words, 1)
    seen = np.maximum(V.per_text(~space, offs), 1)
    size = (ends - starts).astype(float)
    mean = np.bincount(of, weights=size, minlength=n) / per_word
    var = np.bincount(of, weights=size * size, minlength=n) / per_word - mean ** 2
    share = lambda table: V.per_text(table[raw], offs) / seen

    def distinct(key: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return V.word_counts(owner[np.unique(V.in_text(key, owner), return_index=True)[1]], n)

    signs = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(SIGN[raw], out=signs[1:])
    mixed = (signs[ends] - signs[starts]) >= 2
    g, at = V.grams(h, of, 3)
    lines0, lines1, lof = V.runs(raw != 10, offs)
    lines = V.word_counts(lof, n)
    next_same = np.zeros(len(h), bool)
    if len(h) > 1:
        next_same[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    grams = V.word_counts(of[at], n)
    return np.column_stack([
        np.log1p(words), mean, np.sqrt(np.maximum(var, 0)), share(UPPER), share(DIGIT), share(SIGN), share(SYMBOL), share(PIPE), share(SHOUT),
        share(STOP), share(_mask(bytes(range(128, 256)))), distinct(h, of) / per_word, np.bincount(of[next_same], minlength=n) / per_word,
        1 - distinct(g, of[at]) / np.maximum(grams, 1) * (grams > 0) - (grams == 0), 1 - distinct(hashed.of(lines0, lines1), lof) / np.maximum(lines, 1) * (lines > 0) - (lines == 0),
        np.log1p(words / np.maximum(lines, 1)), np.bincount(of[mixed], minlength=n) / per_word, np.bincount(of[size <= 2], minlength=n) / per_word])


def with_statistics(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``stats`` (array<double>)."""
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("stats", T.ArrayType(T.DoubleType()))])
    kind = pa.list_(pa.float64())

    def run(batches):
        for batch in batches:
            for lo, hi, raw, offs in V.slices(batch.column(len(keep))):
                x = statistics(raw, offs)
                flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel())).cast(kind)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(lo, hi - lo) for k in range(len(keep))), flat], names=schema.names)

    return df.select(*keep, text).mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


class Kernel:
    """Standardisation and random Fourier map; the last feature is 1."""

    def __init__(self, mean: np.ndarray, sd: np.ndarray, features: int = FEATURES, gamma: float = GAMMA, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.sd = mean, np.where(sd > 1e-9, sd, 1.0)
        self.w = rng.normal(0.0, np.sqrt(2 * gamma), (len(mean), features))
        self.b = rng.uniform(0, 2 * np.pi, features)

    def map(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.sd, -8, 8) @ self.w + self.b
        return np.column_stack([np.cos(z) * np.sqrt(2 / len(self.b)), np.ones(len(x))])


def _moments(stats: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    cols = [F.col("stats")[i] for i in range(len(STATISTICS))]
    row = stats.agg(*[F.avg(c) for c in cols], *[F.stddev_pop(c) for c in cols]).first()
    both = np.array([0.0 if v is None else v for v in row])
    return both[:len(cols)], both[len(cols):]


def normal_equations(labelled: DataFrame, kernel: Kernel, ridge: float = RIDGE) -> np.ndarray:
    """Ridge weights for ``label`` (0 or 1) over (stats, label) rows; each partition sends one Gram matrix to the sum."""
    shared = labelled.sparkSession.sparkContext.broadcast(kernel)
    d = len(kernel.b) + 1

    def run(batches):
        total = np.zeros((d, d + 1))
        for batch in batches:
            z = shared.value.map(_matrix(batch.column(0)))
            total += z.T @ np.column_stack([z, batch.column(1).to_numpy(zero_copy_only=False)])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])

    rows = (labelled.select("stats", F.col("label").cast("double")).repartition(PARTS).mapInArrow(run, "i long, j long, v double")
            .groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas())
    a = np.zeros((d, d + 1))
    a[rows["i"], rows["j"]] = rows["v"]
    return np.linalg.solve(a[:, :d] + ridge * max(a[d - 1, d - 1], 1.0) / d * np.eye(d), a[:, d])


def isotonic(counts: np.ndarray, positives: np.ndarray) -> np.ndarray:
    """Pool adjacent violators over bins in score order: rising share of positives by bin, empty bins filled between."""
    blocks: list[list[float]] = []
    for k in np.flatnonzero(counts):
        blocks.append([positives[k], counts[k], [k]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p, c, at = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p, blocks[-1][1] + c, blocks[-1][2] + at]
    if not blocks:
        return np.full(len(counts), 0.5)
    at = np.concatenate([b[2] for b in blocks])
    value = np.concatenate([[b[0] / b[1]] * len(b[2]) for b in blocks])
    return np.interp(np.arange(len(counts)), at, value)


def _position(raw: np.ndarray) -> np.ndarray:
    return np.clip(raw * 0.5 + 0.25, 0, 1) * (BINS - 1)


def scores(stats: DataFrame, kernel: Kernel, weights: np.ndarray, curve: np.ndarray | None, keep: tuple[str, ...]) -> DataFrame:
    """``score``: calibrated with ``curve`` (by bin, linear between), or the bin position if there is none."""
    shared = stats.sparkSession.sparkContext.broadcast((kernel, weights, curve))
    schema = T.StructType([stats.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])

    def run(batches):
        kernel, weights, curve = shared.value
        for batch in batches:
            at = _position(kernel.map(_matrix(batch.column(len(keep)))) @ weights)
            out = at if curve is None else np.interp(at, np.arange(BINS), curve)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(out)], names=schema.names)

    return stats.select(*keep, "stats").mapInArrow(run, schema)


def classify(df: DataFrame, labels: DataFrame, trains: Column, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """id, held_out, score, predicted for every row of ``df``. ``labels``: (id, label); ``trains``: condition on the id of rows to learn from."""
    stats = cut_lineage(with_statistics(df.select(id_col, text), text, (id_col,)))
    kernel = Kernel(*_moments(stats))
    marks = labels.where(trains & F.col(label).isNotNull()).select(id_col, F.col(label).cast("int").alias("label"))
    known = cut_lineage(stats.join(marks, id_col))
    if known.isEmpty():
        weights, curve = np.zeros(FEATURES + 1), np.full(BINS, 0.5)
    else:
        weights = normal_equations(known, kernel)
        bins = (scores(known, kernel, weights, None, ("label",)).groupBy(F.round("score").cast("int").alias("bin"))
                .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p")).toPandas())
        counts, positives = np.zeros(BINS), np.zeros(BINS)
        counts[bins["bin"]], positives[bins["bin"]] = bins["n"], bins["p"]
        curve = isotonic(counts, positives)
    out = scores(stats, kernel, weights, curve, (id_col,))
    return out.select(id_col, (~F.coalesce(trains, F.lit(False))).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
