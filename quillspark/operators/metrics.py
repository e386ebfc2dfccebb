"""Verification and attribution metrics (D6, L1-L15) as DataFrame plans.

Inputs are long score tables: one row per (group keys..., pair) with an
integer ``label`` (0/1) and a double ``prob``. Every metric is computed per
group with hash aggregates; curve metrics first reduce rows to distinct
scores per group and use skew-safe running sums (``ranking.prefix_sums``),
so one (model, dataset) with a billion rows is not put into one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.joins import join_small
from quillspark.operators.ranking import prefix_sums

ABSTAIN = 0.5
GRID_POINTS = 100


def _div(a: Column, b: Column) -> Column:
    """a / b as double, 0 when b is 0 (zero_division=0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def binarize(p, threshold=0.5, triple_valued: bool = False) -> Column:
    """L1: p >= t -> 1, p < t -> 0; triple-valued leaves p == t as t."""
    p = F.col(p) if isinstance(p, str) else p
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    if triple_valued:
        return F.when(p > t, F.lit(1.0)).when(p < t, F.lit(0.0)).otherwise(t.cast("double"))
    return F.when(p >= t, F.lit(1)).otherwise(F.lit(0))


def score_counts(df: DataFrame, keys: Sequence[str], prob_col: str = "prob", label_col: str = "label") -> DataFrame:
    """Distinct scores per group with positive / negative counts (map-side combined)."""
    y = F.col(label_col) == 1
    return df.groupBy(*keys, F.col(prob_col).alias("score")).agg(
        F.count_if(y).cast("bigint").alias("pos"), F.count_if(~y).cast("bigint").alias("neg"))


def roc_auc(df: DataFrame, keys: Sequence[str] = ("dataset", "model"), prob_col: str = "prob",
            label_col: str = "label") -> DataFrame:
    """L3: exact ROC-AUC with ties (Mann-Whitney); single-class groups give 0.0."""
    keys = list(keys)
    sc = score_counts(df, keys, prob_col, label_col)
    cum = prefix_sums(sc, keys, [F.col("score")], ["neg"], prefix="below_", inclusive=False)
    agg = cum.groupBy(*keys).agg(
        F.sum(F.col("pos").cast("double") * (F.col("below_neg").cast("double") + F.lit(0.5) * F.col("neg").cast("double"))).alias("__u"),
        F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    return agg.select(*keys, F.when((F.col("__p") == 0) | (F.col("__n") == 0), F.lit(0.0))
                      .otherwise(F.col("__u") / (F.col("__p").cast("double") * F.col("__n").cast("double"))).alias("auc"))


def roc_curve(df: DataFrame, keys: Sequence[str] = ("dataset", "model"), prob_col: str = "prob",
              label_col: str = "label") -> DataFrame:
    """L4: (threshold, tpr, fpr, j) for every distinct score, thresholds from high to low."""
    keys = list(keys)
    sc = score_counts(df, keys, prob_col, label_col)
    tot = sc.groupBy(*keys).agg(F.sum("pos").alias("__P"), F.sum("neg").alias("__N"))
    cum = prefix_sums(sc, keys, [F.col("score").desc()], ["pos", "neg"], prefix="ge_", inclusive=True)
    c = join_small(cum, tot, keys)
    tpr = _div(F.col("ge_pos"), F.col("__P"))
    fpr = _div(F.col("ge_neg"), F.col("__N"))
    return c.select(*keys, F.col("score").alias("threshold"), tpr.alias("tpr"), fpr.alias("fpr"),
                    ((tpr + (F.lit(1.0) - fpr)) - F.lit(1.0)).alias("j"),
                    ((F.col("__P") > 0) & (F.col("__N") > 0)).alias("__ok"))


def youden_threshold(df: DataFrame, keys: Sequence[str] = ("dataset", "model"), prob_col: str = "prob",
                     label_col: str = "label") -> DataFrame:
    """L4: threshold with the largest J = tpr + (1 - fpr) - 1; the highest
    threshold wins ties, and the leading +inf point (J = 0) wins when no
    score does better or a class is missing."""
    keys = list(keys)
    rc = roc_curve(df, keys, prob_col, label_col)
    best = rc.groupBy(*keys).agg(
        F.max_by(F.struct("threshold", "j"), F.struct(F.col("j"), F.col("threshold"))).alias("__b"),
        F.min(F.col("__ok").cast("int")).alias("__ok"))
    inf = F.lit(float("inf"))
    return best.select(*keys, F.when((F.col("__ok") == 1) & (F.col("__b.j") > 0), F.col("__b.threshold")).otherwise(inf)
                       .alias("threshold"))


def apply_threshold(scores: DataFrame, thresholds: DataFrame | None, keys: Sequence[str] = ("dataset", "model"),
                    default: float = 0.0, prob_col: str = "prob") -> DataFrame:
    """Tuned threshold per (model, dataset) (default if none), pred = p >= t."""
    keys = list(keys)
    if thresholds is None:
        s = scores.withColumn("threshold", F.lit(float(default)))
    else:
        s = scores.join(thresholds.select(*keys, F.col("threshold").alias("__t")), keys, "left") \
            .withColumn("threshold", F.coalesce(F.col("__t"), F.lit(float(default)))).drop("__t")
    return s.withColumn("pred", (F.col(prob_col) >= F.col("threshold")).cast("int"))


def confusion(df: DataFrame, keys: Sequence[str], label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    y, p = F.col(label_col) == 1, F.col(pred_col) == 1
    return df.groupBy(*keys).agg(
        F.count_if(y & p).cast("bigint").alias("tp"), F.count_if(~y & p).cast("bigint").alias("fp"),
        F.count_if(y & ~p).cast("bigint").alias("fn"), F.count_if(~y & ~p).cast("bigint").alias("tn"))


def basic_metrics(df: DataFrame, keys: Sequence[str] = ("dataset", "model"), label_col: str = "label",
                  pred_col: str = "pred", prob_col: str = "prob") -> DataFrame:
    """L2: accuracy, precision, recall, F1 (positive class 1, zero division 0) and ROC-AUC."""
    keys = list(keys)
    c = confusion(df, keys, label_col, pred_col)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    m = c.select(*keys, _div(tp + tn, tp + fp + fn + tn).alias("accuracy"), _div(tp, tp + fp).alias("precision"),
                 _div(tp, tp + fn).alias("recall"), _div(2 * tp, 2 * tp + fp + fn).alias("f1_score"))
    return m.join(roc_auc(df, keys, prob_col, label_col).withColumnRenamed("auc", "roc_auc"), keys)


def pan_parts(df: DataFrame, keys: Sequence[str], prob_col: str = "prob", label_col: str = "label") -> DataFrame:
    """Unrounded PAN measures: c@1 (L5), F0.5u (L7), F1 without abstentions (L6), Brier complement."""
    p, y = F.col(prob_col), F.col(label_col).cast("double")
    u = p == ABSTAIN
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.count_if(u).cast("double").alias("nu"),
        F.count_if(~u & ((p > ABSTAIN) == (y > 0.5))).cast("double").alias("nc"),
        F.count_if((p > ABSTAIN) & (y == 1)).cast("double").alias("tp"),
        F.count_if((p > ABSTAIN) & (y != 1)).cast("double").alias("fp"),
        F.count_if((p < ABSTAIN) & (y == 1)).cast("double").alias("fn"),
        F.count_if((p < 0) | (p > 1)).alias("bad"),
        F.sum((p - y) * (p - y)).alias("sq"))
    n, nu, nc, tp, fp, fn = (F.col(x) for x in ("n", "nu", "nc", "tp", "fp", "fn"))
    c_at_1 = (F.lit(1.0) / n) * (nc + (nu * nc / n))
    f05u_den = F.lit(1.25) * tp + F.lit(0.25) * (fn + nu) + fp
    f05u = F.when(f05u_den == 0, F.lit(0.0)).otherwise((F.lit(1.25) * tp) / f05u_den)
    f1_den = F.lit(2.0) * tp + fp + fn
    f1 = F.when(f1_den == 0, F.lit(0.0)).otherwise(F.lit(2.0) * tp / f1_den)
    brier = F.when(F.col("bad") > 0, F.lit(0.0)).otherwise(F.lit(1.0) - F.col("sq") / n)
    return agg.select(*keys, c_at_1.alias("c_at_1"), f05u.alias("f_05_u"), f1.alias("f1"), brier.alias("brier"))


def pan_scores(df: DataFrame, keys: Sequence[str] = ("dataset", "model"), prob_col: str = "prob",
               label_col: str = "label", digits: int = 3) -> DataFrame:
    """AUC, c@1, F0.5u, F1, Brier and their mean (taken before rounding),
    each rounded half-to-even to ``digits``."""
    keys = list(keys)
    parts = pan_parts(df, keys, prob_col, label_col).join(roc_auc(df, keys, prob_col, label_col), keys)
    overall = ((((F.col("auc") + F.col("c_at_1")) + F.col("f_05_u")) + F.col("f1")) + F.col("brier")) / F.lit(5.0)
    cols = ["auc", "c_at_1", "f_05_u", "f1", "brier"]
    return parts.select(*keys, *[F.bround(c, digits).alias(c) for c in cols], F.bround(overall, digits).alias("overall"))


def av_metrics(df: DataFrame, keys: Sequence[str] = ("dataset", "model"), label_col: str = "label",
               pred_col: str = "pred", prob_col: str = "prob", threshold_col: str = "threshold") -> DataFrame:
    """Accuracy, balanced accuracy (classes in the truth), micro / macro
    precision and recall (labels in truth or predictions, zero division 0),
    threshold, AUC and F1 of class 1."""
    keys = list(keys)
    y, p = F.col(label_col) == 1, F.col(pred_col) == 1
    c = df.groupBy(*keys).agg(
        F.count_if(y & p).cast("bigint").alias("tp"), F.count_if(~y & p).cast("bigint").alias("fp"),
        F.count_if(y & ~p).cast("bigint").alias("fn"), F.count_if(~y & ~p).cast("bigint").alias("tn"),
        F.max(threshold_col).alias("threshold"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    has1_true, has0_true = (tp + fn) > 0, (tn + fp) > 0
    has1, has0 = has1_true | ((tp + fp) > 0), has0_true | ((tn + fn) > 0)
    r1, r0 = _div(tp, tp + fn), _div(tn, tn + fp)
    p1, p0 = _div(tp, tp + fp), _div(tn, tn + fn)
    n_true = has1_true.cast("int") + has0_true.cast("int")
    n_lab = has1.cast("int") + has0.cast("int")
    bal = _div(F.when(has1_true, r1).otherwise(0.0) + F.when(has0_true, r0).otherwise(0.0), n_true)
    mrec = _div(F.when(has1, r1).otherwise(0.0) + F.when(has0, r0).otherwise(0.0), n_lab)
    mprec = _div(F.when(has1, p1).otherwise(0.0) + F.when(has0, p0).otherwise(0.0), n_lab)
    acc = _div(tp + tn, n)
    m = c.select(*keys, acc.alias("accuracy"), bal.alias("macro_accuracy"), acc.alias("micro_recall"),
                 mrec.alias("macro_recall"), acc.alias("micro_precision"), mprec.alias("macro_precision"),
                 F.col("threshold").cast("double").alias("threshold"), _div(2 * tp, 2 * tp + fp + fn).alias("f1"))
    return m.join(roc_auc(df, keys, prob_col, label_col), keys)


def threshold_grid(df: DataFrame, keys: Sequence[str] = ("dataset", "model"), prob_col: str = "prob",
                   label_col: str = "label", points: int = GRID_POINTS) -> DataFrame:
    """Evenly spaced thresholds from min to max score (numpy linspace);
    per threshold accuracy (p >= t), AUC, c@1 and F0.5u (PAN form at 0.5),
    F1 without rows at p == t, and their mean. Returns the best threshold by
    accuracy, the **last** one on ties.

    Scores are bucketed to the grid cell that holds them (exact comparison
    with the grid values), so the work is one aggregate per (group, cell)
    instead of a rows x thresholds cross product.
    """
    keys = list(keys)
    p = F.col(prob_col)
    mm = df.groupBy(*keys).agg(F.min(prob_col).alias("__lo"), F.max(prob_col).alias("__hi"),
                               F.count_if(F.col(label_col) == 1).cast("bigint").alias("__P"),
                               F.count(F.lit(1)).cast("bigint").alias("__n"))
    step = (F.col("__hi") - F.col("__lo")) / F.lit(float(points - 1))

    def grid(i: Column) -> Column:
        return F.when(i >= points - 1, F.col("__hi")).otherwise(i.cast("double") * step + F.col("__lo"))

    d = join_small(df, mm, keys)
    b0 = F.when(step == 0, F.lit(points - 1)).otherwise(
        F.least(F.lit(points - 1), F.greatest(F.lit(0), F.floor((p - F.col("__lo")) / step).cast("int"))))
    d = d.withColumn("__b0", b0.cast("int"))
    d = d.withColumn("__b", F.when((F.col("__b0") < points - 1) & (grid(F.col("__b0") + 1) <= p), F.col("__b0") + 1)
                     .when((F.col("__b0") > 0) & (grid(F.col("__b0")) > p), F.col("__b0") - 1).otherwise(F.col("__b0")))
    y = F.col(label_col) == 1
    eq = p == grid(F.col("__b"))
    cells = d.groupBy(*keys, "__b").agg(
        F.count_if(y).cast("bigint").alias("pos"), F.count_if(~y).cast("bigint").alias("neg"),
        F.count_if(y & eq).cast("bigint").alias("eq_pos"), F.count_if(~y & eq).cast("bigint").alias("eq_neg"))
    grid_rows = mm.withColumn("__b", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    full = grid_rows.join(cells, [*keys, "__b"], "left").fillna(0, ["pos", "neg", "eq_pos", "eq_neg"])
    w = Window.partitionBy(*keys).orderBy(F.col("__b").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = full.withColumn("ge_pos", F.sum("pos").over(w)).withColumn("ge_neg", F.sum("neg").over(w))
    P, n = F.col("__P"), F.col("__n")
    N = n - P
    acc = (F.col("ge_pos") + (N - F.col("ge_neg"))).cast("double") / n.cast("double")
    tp = F.col("ge_pos") - F.col("eq_pos")
    fp = F.col("ge_neg") - F.col("eq_neg")
    fn = P - F.col("ge_pos")
    f1 = _div(2 * tp, 2 * tp + fp + fn)
    full = full.select(*keys, grid(F.col("__b")).alias("threshold"), F.col("__b").alias("idx"), acc.alias("accuracy"), f1.alias("f1"))
    fixed = pan_parts(df, keys, prob_col, label_col).join(roc_auc(df, keys, prob_col, label_col), keys)
    full = full.join(fixed.select(*keys, "auc", "c_at_1", "f_05_u"), keys)
    overall = ((((F.col("accuracy") + F.col("auc")) + F.col("c_at_1")) + F.col("f_05_u")) + F.col("f1")) / F.lit(5.0)
    full = full.withColumn("overall", overall)
    best = full.groupBy(*keys).agg(F.max_by(F.struct("accuracy", "auc", "c_at_1", "f_05_u", "f1", "overall", "threshold"),
                                            F.struct(F.col("accuracy"), F.col("idx"))).alias("b"))
    return best.select(*keys, "b.*")


def mean_threshold_accuracy(df: DataFrame, keys: Sequence[str], threshold: float | None = None,
                            prob_col: str = "prob", label_col: str = "label") -> DataFrame:
    """L12 (fixed form): accuracy at a given threshold; NULL means the mean score (q12)."""
    keys = list(keys)
    t = df.groupBy(*keys).agg(F.avg(prob_col).alias("__mean"))
    d = df.join(t, keys)
    thr = F.col("__mean") if threshold is None else F.lit(float(threshold))
    pred = (F.col(prob_col) >= thr).cast("int")
    return d.groupBy(*keys).agg(F.avg((pred == F.col(label_col)).cast("double")).alias("accuracy"),
                                F.first(thr).alias("threshold"))
