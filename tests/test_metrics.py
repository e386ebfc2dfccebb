"""Metrics against brute-force Python definitions and metric invariants."""

import random

from pyspark.sql import functions as F

from quillspark.operators import metrics as M


def _auc(y, p):
    pos = [s for s, t in zip(p, y) if t == 1]
    neg = [s for s, t in zip(p, y) if t == 0]
    if not pos or not neg:
        return 0.0
    u = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    return u / (len(pos) * len(neg))


def _df(spark, y, p, model="m"):
    rows = [("d", model, i, int(t), float(s)) for i, (t, s) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "dataset string, model string, pair_id long, label int, prob double")


def test_auc_matches_bruteforce_with_ties(spark):
    rnd = random.Random(1)
    y = [rnd.randint(0, 1) for _ in range(300)]
    p = [rnd.randint(0, 20) / 20 for _ in range(300)]
    got = M.roc_auc(_df(spark, y, p)).first().auc
    assert abs(got - _auc(y, p)) < 1e-12
    flipped = M.roc_auc(_df(spark, y, [1 - x for x in p])).first().auc
    assert abs(got + flipped - 1.0) < 1e-12


def test_auc_single_class_is_zero(spark):
    assert M.roc_auc(_df(spark, [1, 1, 1], [0.1, 0.5, 0.9])).first().auc == 0.0


def test_pan_parts_hand_rows(spark):
    y = [1, 0, 1, 0, 1]
    p = [0.9, 0.1, 0.5, 0.7, 0.2]
    r = M.pan_parts(_df(spark, y, p), ["dataset", "model"]).first()
    n, nu, nc = 5, 1, 2
    assert abs(r.c_at_1 - (1 / n) * (nc + nu * nc / n)) < 1e-12
    tp, fp, fn = 1, 1, 1
    assert abs(r.f_05_u - 1.25 * tp / (1.25 * tp + 0.25 * (fn + nu) + fp)) < 1e-12
    assert abs(r.f1 - 2 * tp / (2 * tp + fp + fn)) < 1e-12
    assert abs(r.brier - (1 - sum((a - b) ** 2 for a, b in zip(p, y)) / 5)) < 1e-12
    bad = M.pan_parts(_df(spark, [1, 0], [1.5, 0.2]), ["dataset", "model"]).first()
    assert bad.brier == 0.0


def test_youden_prefers_highest_threshold_on_ties(spark):
    y = [1, 1, 0, 0]
    p = [0.9, 0.8, 0.3, 0.2]
    t = M.youden_threshold(_df(spark, y, p)).first().threshold
    assert t == 0.8   # J = 1 at thresholds 0.8 (first) and above 0.3
    none = M.youden_threshold(_df(spark, [1, 0], [0.1, 0.9])).first().threshold
    assert none == float("inf")


def test_threshold_grid_last_best(spark):
    y = [0, 1, 0, 1]
    p = [0.0, 1.0, 0.2, 0.8]
    r = M.threshold_grid(_df(spark, y, p)).first()
    grid = [i * (1.0 / 99) for i in range(99)] + [1.0]
    accs = [sum((s >= t) == (l == 1) for s, l in zip(p, y)) / 4 for t in grid]
    best = max(range(100), key=lambda i: (accs[i], i))
    assert abs(r.threshold - grid[best]) < 1e-12 and r.accuracy == accs[best]


def test_bootstrap_equal_models_p_value_capped(spark):
    from quillspark.operators import significance as S
    y = [1, 0, 1, 1, 0, 0, 1, 0]
    p = [0.9, 0.2, 0.6, 0.4, 0.3, 0.7, 0.8, 0.1]
    df = _df(spark, y, p, "a").unionByName(_df(spark, y, p, "b")).withColumn("pred", M.binarize("prob", 0.5))
    rep = S.significance_report(df, replicates=200).collect()
    assert rep and all(r.p_value <= 1.0 and r.mean_diff == 0.0 and not r.significance for r in rep)
