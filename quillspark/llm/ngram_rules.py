"""Operator 9: quality rules with a hashed n-gram likelihood ratio.

Rule counts come from the whole text. The verdict compares two multinomials
over hashed token unigrams and bigrams: one of trusted target texts, one of the
whole raw corpus, both with add-alpha smoothing. A text's score is the sum of
log ratios over its n-grams divided by their number; it is kept when the score
reaches a fixed threshold. Tokens of the n-grams are runs of letters and digits
(any non-ASCII byte counts as a letter) and runs of other signs.

The trusted side counts the whole texts of all trusted ids (up to BROADCAST_IDS
ids are sent to all tasks, more are joined by shuffle), the raw side those of
every row. The two count vectors have ``buckets`` entries whatever the corpus
size. Tasks send them in packed stretches of ``STRETCH`` buckets, which are
summed stretch by stretch; only the finished ratios (16 MB) reach the driver.

Cases: null text is empty, has no words and fails the base rule; equal texts
get equal rows; repeated rows are kept; empty tables give no rows and an empty
trusted set makes every ratio the smoothing ratio (0), so the base rule decides;
other columns are ignored, but those named in ``keep`` pass through. A text of
any length is scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import textvec as V
from quillspark.session import cut_lineage

BUCKETS = 1 << 22
STRETCH = 1 << 14
BUFFER = 1 << 22  # n-grams held before they are counted
ALPHA = 1.0
THRESHOLD = -0.25
BROADCAST_IDS = 500_000  # 4 MB of ids; more are joined by shuffle
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
KIND = np.full(256, 2, np.uint8)  # 0 white space, 1 letters and digits, 2 other signs
KIND[V.SPACE] = 0
KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def rule_counts(raw: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words for each text of a slice."""
    n = len(offs) - 1
    space = V.SPACE[raw]
    starts, ends, of = V.runs(~space, offs)
    hashed = V.Hasher(raw)
    out = {"n_words": V.word_counts(of, n)}
    out["word_chars"] = V.per_text(~space & ((raw & 0xC0) != 0x80), offs)
    out["n_symbols"] = V.per_text(SYMBOLS[raw], offs)
    # lines with a word, less the distinct ones of their text
    l0, l1, lof = V.runs(raw != 10, offs)
    seen = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(~space, out=seen[1:])
    worded = seen[l1] > seen[l0]
    l0, l1, lof = l0[worded], l1[worded], lof[worded]
    distinct = np.unique(V.in_text(hashed.of(l0, l1), lof), return_index=True)[1]
    out["n_dup_lines"] = V.word_counts(lof, n) - V.word_counts(lof[distinct], n)
    g, at = V.grams(hashed.of(starts, ends), of, 5)
    first = at[V.repeated(V.in_text(g, of[at]))]
    covered = np.zeros(len(starts), bool)
    for k in range(5):
        covered[first + k] = True
    out["n_repeat_words"] = np.bincount(of[covered], minlength=n).astype(np.int64)
    return out


def ngram_buckets(raw: np.ndarray, offs: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text index) of every token unigram and bigram of a slice."""
    kind = KIND[raw]
    parts = [V.runs(kind == k, offs) for k in (1, 2)]
    starts, ends, of = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(starts, kind="stable")
    starts, ends, of = starts[order], ends[order], of[order]
    h = V.Hasher(raw).of(starts, ends)
    g, at = V.grams(h, of, 2)
    mask = V.U64(buckets - 1)
    return (np.concatenate([h & mask, g & mask]).astype(np.int64), np.concatenate([of, of[at]]))


def corpus_counts(df: DataFrame, text: str, trusted: Column, buckets: int = BUCKETS) -> DataFrame:
    """Per stretch of buckets: stretch, packed raw counts over all rows, packed target counts over the rows where ``trusted``, and both sums."""
    stretch = min(STRETCH, buckets)

    def count(batches):
        total = np.zeros((2, buckets), np.int64)
        held, size = [], 0

        def settle():
            if held:
                b, t = (np.concatenate(x) for x in zip(*held))
                total[0] += np.bincount(b, minlength=buckets)
                total[1] += np.bincount(b[t], minlength=buckets)
                held.clear()

        for batch in batches:
            flag = np.asarray(batch.column(1).fill_null(False).to_numpy(zero_copy_only=False), bool)
            for lo, hi, raw, offs in V.slices(batch.column(0)):
                b, of = ngram_buckets(raw, offs, buckets)
                held.append((b, flag[lo:hi][of]))
                size += len(b)
                if size > BUFFER:
                    settle()
                    size = 0
        settle()
        for k in np.flatnonzero(total[0].reshape(-1, stretch).any(axis=1)).tolist():
            part = total[:, k * stretch: (k + 1) * stretch]
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in part)], names=["stretch", "raw", "target"])

    def add(batches):
        now, total = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in total),
                                               *(pa.array([int(x.sum())], pa.int64()) for x in total)], names=["stretch", "raw", "target", "n_raw", "n_target"])

        for batch in batches:
            for k, raw, target in zip(*(c.to_pylist() for c in batch.columns)):
                if k != now:
                    if now is not None:
                        yield done()
                    now, total = k, np.zeros((2, stretch), np.int64)
                total += np.stack([np.frombuffer(raw, np.int64), np.frombuffer(target, np.int64)])
        if now is not None:
            yield done()

    blocks = df.select(F.col(text), trusted).mapInArrow(count, "stretch int, raw binary, target binary")
    return blocks.repartition("stretch").sortWithinPartitions("stretch").mapInArrow(add, "stretch int, raw binary, target binary, n_raw long, n_target long")


def log_ratios(counts: DataFrame, buckets: int = BUCKETS, alpha: float = ALPHA) -> np.ndarray:
    """ln of the smoothed target share over the smoothed raw share, by bucket."""
    counts = cut_lineage(counts)
    n_raw, n_target = (x or 0 for x in counts.agg(F.sum("n_raw"), F.sum("n_target")).first())
    stretch = min(STRETCH, buckets)
    if not n_target:
        return np.zeros(buckets, np.float32)

    def ratio(raw, target):
        return np.log((target + alpha) / (n_target + alpha * buckets)) - np.log((raw + alpha) / (n_raw + alpha * buckets))

    def run(batches):
        for batch in batches:
            for k, raw, target in zip(*(c.to_pylist() for c in batch.columns)):
                part = ratio(np.frombuffer(raw, np.int64), np.frombuffer(target, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.astype(np.float32).tobytes()], pa.binary())], names=["stretch", "ratio"])

    out = np.full(buckets, ratio(0, 0), np.float32)
    for row in counts.select("stretch", "raw", "target").mapInArrow(run, "stretch int, ratio binary").collect():
        out[row.stretch * stretch: (row.stretch + 1) * stretch] = np.frombuffer(row.ratio, np.float32)
    return out


def score_rules(df: DataFrame, ratios: np.ndarray, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                threshold: float = THRESHOLD) -> DataFrame:
    """Rule counts, base_failed, score (mean log ratio) and kept for every row."""
    table = df.sparkSession.sparkContext.broadcast(ratios)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in names]
                          + [T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()),
                             T.StructField("kept", T.BooleanType())])

    def run(batches):
        for batch in batches:
            for lo, hi, raw, offs in V.slices(batch.column(len(keep))):
                c = rule_counts(raw, offs)
                b, of = ngram_buckets(raw, offs, len(table.value))
                size = np.bincount(of, minlength=hi - lo)
                score = np.bincount(of, weights=table.value[b], minlength=hi - lo) / np.maximum(size, 1)
                failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
                cols = [batch.column(k).slice(lo, hi - lo) for k in range(len(keep))]
                cols += [pa.array(c[x]) for x in names] + [pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return df.select(*keep, text).mapInArrow(run, schema)


def apply_rules(df: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text: str = "text",
                threshold: float = THRESHOLD) -> DataFrame:
    """Counts both corpora, then scores every row. ``trusted_ids``: ids of target texts, all are used."""
    chosen = cut_lineage(trusted_ids.select(F.col(id_col).alias("__t")).where(F.col("__t").isNotNull()).distinct().withColumn("__target", F.lit(True)))
    if chosen.count() <= BROADCAST_IDS:
        chosen = F.broadcast(chosen)
    marked = df.select(id_col, text).join(chosen, F.col(id_col) == F.col("__t"), "left")
    ratios = log_ratios(corpus_counts(marked, text, F.col("__target")))
    return score_rules(df, ratios, text, (id_col,), threshold)
