"""Paired bootstrap significance (M1-M4).

Resample draws are keyed by (seed, dataset, replicate, slot), so every model
of a dataset sees the same resamples without storing index lists. Draws are
reduced to weights (dataset, replicate, ordinal, w) first; metrics are then
weighted counts, and the shuffle carries (dataset, model, replicate) partial
sums rather than per-draw rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import key

N_BOOTSTRAPS = 10_000
SEED = 42


def pair_patterns(scores: DataFrame, dataset_col: str = "dataset", model_col: str = "model", pair_col: str = "pair_id",
                  label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """One row per (dataset, pair): the label and the predictions of every model
    packed into a pattern key 'label|model=pred,...' (models in name order)."""
    per = scores.groupBy(dataset_col, pair_col).agg(
        F.first(label_col).alias("label"), F.sort_array(F.collect_list(F.struct(F.col(model_col).alias("m"), F.col(pred_col).alias("p")))).alias("preds"))
    key_s = F.concat_ws("|", F.col("label").cast("string"),
                        F.array_join(F.transform("preds", lambda x: F.concat(x["m"], F.lit("="), x["p"].cast("string"))), ","))
    return per.withColumn("pattern", key_s)


# a unit of draws: at most so many slots, and so many draws in all
UNIT_SLOTS, UNIT_DRAWS = 1 << 16, 1 << 21
HASH_LANES = 1 << 14
MD5_SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
MD5_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2 ** 32)) for i in range(64)]


def _md5_keys(head: bytes, replicate: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """``keys.key`` of head + replicate + '|' + slot, for numbers that have as many digits each: md5 over whole arrays."""
    rl, sl = len(str(replicate[0])), len(str(slot[0]))
    at = len(head)
    body = head + b"0" * rl + b"|" + b"0" * sl
    padded = body + b"\x80" + b"\0" * ((55 - len(body)) % 64) + (8 * len(body)).to_bytes(8, "little")
    words = [*np.frombuffer(padded, "<u4")]  # numbers, and arrays where digits are
    for digits, n, first in ((replicate, rl, at), (slot, sl, at + rl + 1)):
        for i in range(n):
            place = first + i
            digit = (digits // 10 ** (n - 1 - i) % 10).astype(np.uint32)
            words[place // 4] = words[place // 4] + (digit << np.uint32(8 * (place % 4)))
    state = [np.full(len(slot), x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    with np.errstate(over="ignore"):
        for lo in range(0, len(words), 16):
            a, b, c, d = state
            for i in range(64):
                kind = i // 16
                if kind == 0:
                    f, g = d ^ (b & (c ^ d)), i
                elif kind == 1:
                    f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
                elif kind == 2:
                    f, g = b ^ c ^ d, (3 * i + 5) % 16
                else:
                    f, g = c ^ (b | ~d), 7 * i % 16
                f += a
                f += MD5_SINES[i] + words[lo + g]
                left = MD5_SHIFTS[kind][i % 4]
                turned = f << np.uint32(left)
                f >>= np.uint32(32 - left)
                turned |= f
                turned += b
                a, d, c, b = d, c, b, turned
            state = [x + y for x, y in zip(state, (a, b, c, d))]
    return (state[0].byteswap().astype(np.uint64) << np.uint64(28)) | (state[1].byteswap() >> np.uint32(4))


def _same_digits(lo: int, hi: int):
    """[lo, hi) in parts whose numbers have as many digits."""
    while lo < hi:
        stop = min(hi, 10 ** len(str(lo)))
        yield lo, stop
        lo = stop


def _draw_unit(head: str, counts: np.ndarray, rep_lo: int, rep_hi: int, slot_lo: int, slot_hi: int) -> np.ndarray:
    """How often the draws of a unit fall on each pattern: replicates x patterns, flat."""
    ends = np.cumsum(counts)
    out = np.zeros((rep_hi - rep_lo) * len(counts), np.int64)
    for r0, r1 in _same_digits(rep_lo, rep_hi):
        for s0, s1 in _same_digits(slot_lo, slot_hi):
            for lo in range(0, (r1 - r0) * (s1 - s0), HASH_LANES):
                cell = np.arange(lo, min(lo + HASH_LANES, (r1 - r0) * (s1 - s0)))
                rep, slot = r0 + cell // (s1 - s0), s0 + cell % (s1 - s0)
                drawn = (_md5_keys(head.encode(), rep, slot) % np.uint64(ends[-1])).astype(np.int64)
                into = (rep - rep_lo) * len(counts) + np.searchsorted(ends, drawn, "right")
                first = int(into.min())
                got = np.bincount(into - first)
                out[first: first + len(got)] += got
    return out


def _keyed_draws(replicates: int, seed: int):
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def drawn(dataset: pd.Series, counts: pd.Series, rep: pd.Series, reps: pd.Series, slot: pd.Series, slots: pd.Series) -> pd.Series:
        return pd.Series([_draw_unit(f"{seed}|boot|{d}|", np.asarray(c), r, min(r + k, replicates), s, min(s + m, int(sum(c))))
                          for d, c, r, k, s, m in zip(dataset, counts, rep, reps, slot, slots)])
    return drawn


def bootstrap_weights(scores: DataFrame, replicates: int = N_BOOTSTRAPS, seed: int = SEED,
                      dataset_col: str = "dataset", pair_col: str = "pair_id", model_col: str = "model",
                      label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """M1: n draws with replacement per (dataset, replicate), reduced to weights
    per *pattern* (label and all models' predictions): (dataset, replicate, pattern, w).

    Rows are ordered by (pattern, pair_id); draw d of a replicate picks row
    ``key(seed, dataset, replicate, d) % n``, which falls in its pattern's
    range. Metrics only depend on how often each pattern is drawn, so no draw is
    a row: a row is a unit of draws (a range of replicates and of slots of a
    dataset, at most ``UNIT_DRAWS``) with the counts of the patterns, its draws
    are hashed and counted as arrays, and (dataset, replicate, pattern) counts leave
    it. Units are spread by hash, so a dataset with most rows is many tasks' work."""
    from quillspark.operators.joins import join_small
    from quillspark.session import cut_lineage
    pp = pair_patterns(scores, dataset_col, model_col, pair_col, label_col, pred_col)
    pat = pp.filter(F.col(dataset_col).isNotNull()).groupBy(dataset_col, "pattern").agg(F.count(F.lit(1)).cast("bigint").alias("n_p"))
    # a row a dataset, with its patterns
    packed = cut_lineage(pat.groupBy(dataset_col).agg(F.array_sort(F.collect_list(F.struct("pattern", "n_p"))).alias("pats"), F.sum("n_p").alias("n")))
    slots = F.least("n", F.lit(UNIT_SLOTS))
    reps = F.greatest(F.lit(1), F.least(F.lit(replicates), F.floor(F.lit(UNIT_DRAWS) / F.greatest(slots, F.size("pats"))))).cast("int")
    nparts = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = packed.select(dataset_col, F.col("pats.n_p").alias("counts"), "n", slots.alias("slots"), reps.alias("reps"))
    units = units.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1), F.col("reps"))).alias("rep"))
    units = units.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.col("slots"))).alias("slot"))
    units = units.repartition(nparts, dataset_col, "rep", "slot")
    drawn = units.select(dataset_col, "rep", F.size("counts").alias("size"),
                         F.posexplode(_keyed_draws(replicates, seed)(F.col(dataset_col).cast("string"), "counts", "rep", "reps", "slot", "slots")).alias("at", "w"))
    sums = drawn.filter("w > 0").groupBy(dataset_col, (F.col("rep") + F.floor(F.col("at") / F.col("size"))).cast("int").alias("replicate"),
                                         (F.col("at") % F.col("size")).alias("at")).agg(F.sum("w").cast("bigint").alias("w"))
    names = packed.select(dataset_col, F.posexplode("pats.pattern").alias("at", "pattern"))
    return join_small(sums, names, [dataset_col, "at"]).select(dataset_col, "replicate", "pattern", "w")


@F.pandas_udf(T.ArrayType(T.LongType()))
def _multinomial(counts: pd.Series, seeds: pd.Series) -> pd.Series:
    """Numbers of draws by pattern, one multinomial sample a row (a chain of conditional binomials)."""
    return pd.Series([np.random.Generator(np.random.PCG64(int(s))).multinomial(c.sum(), c / c.sum()) for c, s in zip(counts, seeds)])


def multinomial_weights(scores: DataFrame, replicates: int = N_BOOTSTRAPS, seed: int = SEED,
                        dataset_col: str = "dataset", pair_col: str = "pair_id", model_col: str = "model",
                        label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """M1 with the distribution of ``bootstrap_weights``, but without its draws: (dataset, replicate, pattern, w), w > 0.

    n draws with replacement fall on the patterns as a multinomial sample, so a replicate takes one keyed sample over
    the counts of the patterns. The rows are read once, for those counts; the work of a replicate follows the number of
    distinct patterns (at most 2 to the power of models + 1 for labels and predictions of 0 and 1), not of rows.
    Samples depend on (seed, dataset, replicate) only, so a lost task is drawn again alike."""
    pp = pair_patterns(scores, dataset_col, model_col, pair_col, label_col, pred_col)
    pat = pp.groupBy(dataset_col, "pattern").agg(F.count(F.lit(1)).cast("bigint").alias("n_p"))
    packed = pat.groupBy(dataset_col).agg(F.array_sort(F.collect_list(F.struct("pattern", "n_p"))).alias("pats"))
    nparts = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reps = packed.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate")).repartition(nparts, dataset_col, "replicate")
    drawn = reps.withColumn("w", _multinomial(F.col("pats.n_p"), key(seed, "multinomial", F.col(dataset_col), F.col("replicate"))))
    rows = drawn.select(dataset_col, "replicate", F.explode(F.arrays_zip(F.col("pats.pattern").alias("pattern"), F.col("w").alias("w"))).alias("x"))
    return rows.select(dataset_col, "replicate", "x.pattern", "x.w").filter("w > 0")


def bootstrap_metrics(scores: DataFrame, replicates: int = N_BOOTSTRAPS, seed: int = SEED,
                      dataset_col: str = "dataset", model_col: str = "model", pair_col: str = "pair_id",
                      label_col: str = "label", pred_col: str = "pred", weights=None) -> DataFrame:
    """M2: F1 and accuracy of every resample and model:
    (dataset, model, replicate, f1, accuracy). ``weights``: ``bootstrap_weights`` (every draw is keyed) or
    ``multinomial_weights`` (cost independent of the rows)."""
    from quillspark.operators.joins import join_small
    pp = pair_patterns(scores, dataset_col, model_col, pair_col, label_col, pred_col)
    per_model = pp.select(dataset_col, "pattern", "label", F.explode("preds").alias("x")).select(
        dataset_col, "pattern", "label", F.col("x.m").alias(model_col), F.col("x.p").alias(pred_col)).distinct()
    w = (weights or bootstrap_weights)(scores, replicates, seed, dataset_col, pair_col, model_col, label_col, pred_col)
    j = join_small(w, per_model, [dataset_col, "pattern"])
    y, p, wt = F.col("label") == 1, F.col(pred_col) == 1, F.col("w")
    agg = j.groupBy(dataset_col, model_col, "replicate").agg(
        F.sum(F.when(y & p, wt).otherwise(0)).alias("tp"), F.sum(F.when(~y & p, wt).otherwise(0)).alias("fp"),
        F.sum(F.when(y & ~p, wt).otherwise(0)).alias("fn"), F.sum(F.when(F.col("label") == F.col(pred_col), wt).otherwise(0)).alias("ok"),
        F.sum(wt).alias("n"))
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return agg.select(dataset_col, model_col, F.col("replicate").cast("bigint").alias("replicate"),
                      F.when(den == 0, F.lit(0.0)).otherwise(2 * F.col("tp").cast("double") / den.cast("double")).alias("f1"),
                      (F.col("ok").cast("double") / F.col("n").cast("double")).alias("accuracy"))


def full_sample_metrics(scores: DataFrame, dataset_col: str = "dataset", model_col: str = "model",
                        label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """F1 and accuracy on the whole set per (dataset, model)."""
    y, p = F.col(label_col) == 1, F.col(pred_col) == 1
    a = scores.groupBy(dataset_col, model_col).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"),
        F.count_if(y == p).alias("ok"), F.count(F.lit(1)).alias("n"))
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return a.select(dataset_col, model_col,
                    F.when(den == 0, F.lit(0.0)).otherwise(2 * F.col("tp").cast("double") / den.cast("double")).alias("f1"),
                    (F.col("ok").cast("double") / F.col("n").cast("double")).alias("accuracy"))


def compare_adjacent(boot: DataFrame, full: DataFrame, metric: str = "f1", dataset_col: str = "dataset",
                     model_col: str = "model") -> DataFrame:
    """M3: rank models by the full-sample metric (desc, ties by name); for each
    model and the next one: mean bootstrap difference, 2.5 / 97.5 percentiles,
    p = min(1, 2 min(share <= 0, share >= 0)) and significance (CI excludes 0)."""
    from quillspark.operators.rank import rank_models
    r = rank_models(full.select(dataset_col, model_col, metric), metric, [dataset_col], model_col)
    pairs = r.filter(F.col("next_model").isNotNull()).select(
        dataset_col, F.col(model_col).alias("model_a"), F.col("next_model").alias("model_b"),
        F.col("rank").alias("rank_a"), (F.col("rank") + 1).alias("rank_b"),
        F.col(metric).alias("score_a"), F.col("next_value").alias("score_b"))
    ba = boot.select(dataset_col, F.col(model_col).alias("model_a"), "replicate", F.col(metric).alias("va"))
    bb = boot.select(dataset_col, F.col(model_col).alias("model_b"), "replicate", F.col(metric).alias("vb"))
    d = pairs.join(ba, [dataset_col, "model_a"]).join(bb, [dataset_col, "model_b", "replicate"]) \
        .withColumn("d", F.col("va") - F.col("vb"))
    g = [dataset_col, "model_a", "model_b", "rank_a", "rank_b", "score_a", "score_b"]
    agg = d.groupBy(*g).agg(
        F.avg("d").alias("mean_diff"), F.percentile("d", F.array(F.lit(0.025), F.lit(0.975))).alias("ci"),
        F.avg((F.col("d") <= 0).cast("double")).alias("le0"), F.avg((F.col("d") >= 0).cast("double")).alias("ge0"))
    return agg.select(*g, "mean_diff",
                      F.least(F.lit(1.0), F.lit(2.0) * F.least("le0", "ge0")).alias("p_value"),
                      F.col("ci")[0].alias("ci_low"), F.col("ci")[1].alias("ci_high"),
                      ((F.col("ci")[0] > 0) | (F.col("ci")[1] < 0)).alias("significance"),
                      F.lit(metric).alias("metric"))


def significance_report(scores: DataFrame, replicates: int = N_BOOTSTRAPS, seed: int = SEED, weights=None) -> DataFrame:
    """M4 (Z7): F1 and accuracy rankings with adjacent comparisons, one table."""
    from quillspark.session import cut_lineage
    boot = cut_lineage(bootstrap_metrics(scores, replicates, seed, weights=weights))
    full = full_sample_metrics(scores)
    return compare_adjacent(boot, full, "f1").unionByName(compare_adjacent(boot, full, "accuracy"))
