"""Registered queries: metrics (D6, D7, L1-L13), ranking (E4, E9) and bootstrap significance (M1-M4)
over the ``scores`` view (three models whose probabilities mix a keyed draw with the label)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import key_sql
from quillspark.operators import metrics as M
from quillspark.operators import rank, significance as S, stats
from quillspark.plans.registry import register
from quillspark.session import cut_lineage
from quillspark.sources import views

K = ["dataset", "model"]
SC = views.scores_sql()
B = S.N_BOOTSTRAPS


def D(x) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _scores(spark, sf_dir):
    return views.scores(spark, sf_dir)


_SC_COUNTS = f"SELECT dataset, model, prob AS score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM ({SC}) s GROUP BY dataset, model, prob"
AUC_SQL = f"""SELECT dataset, model, CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN {D(0)} ELSE
      sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + {D(0.5)} * CAST(neg AS DOUBLE))) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc
    FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY dataset, model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
          FROM ({_SC_COUNTS}) c) x GROUP BY dataset, model"""


@register("roc_auc", AUC_SQL)
def q_roc_auc(spark, sf_dir):
    return M.roc_auc(_scores(spark, sf_dir), K)


_ROC_SQL = f"""
    WITH sc AS ({_SC_COUNTS}),
    tot AS (SELECT dataset, model, sum(pos) AS P, sum(neg) AS N FROM sc GROUP BY dataset, model),
    c AS (SELECT sc.*, sum(pos) OVER w AS ge_pos, sum(neg) OVER w AS ge_neg FROM sc
          WINDOW w AS (PARTITION BY dataset, model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    r AS (SELECT c.dataset, c.model, c.score AS threshold,
                 CASE WHEN tot.P = 0 THEN {D(0)} ELSE CAST(ge_pos AS DOUBLE) / CAST(tot.P AS DOUBLE) END AS tpr,
                 CASE WHEN tot.N = 0 THEN {D(0)} ELSE CAST(ge_neg AS DOUBLE) / CAST(tot.N AS DOUBLE) END AS fpr,
                 tot.P > 0 AND tot.N > 0 AS ok
          FROM c JOIN tot ON c.dataset = tot.dataset AND c.model = tot.model)
    SELECT *, (tpr + ({D(1)} - fpr)) - {D(1)} AS j FROM r"""


@register("roc_curve", f"SELECT dataset, model, threshold, tpr, fpr, j FROM ({_ROC_SQL}) x")
def q_roc_curve(spark, sf_dir):
    return M.roc_curve(_scores(spark, sf_dir), K).drop("__ok")


YOUDEN_SQL = f"""SELECT dataset, model, CASE WHEN bool_and(ok) AND max(j) > 0 THEN first(threshold ORDER BY j DESC, threshold DESC)
    ELSE CAST('Infinity' AS DOUBLE) END AS threshold FROM ({_ROC_SQL}) x GROUP BY dataset, model"""


@register("youden_threshold", YOUDEN_SQL)
def q_youden(spark, sf_dir):
    return M.youden_threshold(_scores(spark, sf_dir), K)


@register("binarize", f"""SELECT dataset, model, pair_id, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS pred,
    CASE WHEN prob > 0.5 THEN {D(1)} WHEN prob < 0.5 THEN {D(0)} ELSE {D(0.5)} END AS pred3 FROM ({SC}) s""")
def q_binarize(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return s.select("dataset", "model", "pair_id", M.binarize("prob", 0.5).alias("pred"),
                    M.binarize("prob", 0.5, triple_valued=True).alias("pred3"))


_APPLIED_SQL = f"""SELECT s.*, coalesce(t.threshold, {D(0)}) AS threshold, CAST(s.prob >= coalesce(t.threshold, {D(0)}) AS INTEGER) AS pred
    FROM ({SC}) s LEFT JOIN ({YOUDEN_SQL}) t ON s.dataset = t.dataset AND s.model = t.model"""


def _applied(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return M.apply_threshold(s, M.youden_threshold(s, K), K, default=0.0)


@register("apply_threshold", f"SELECT dataset, model, pair_id, threshold, pred FROM ({_APPLIED_SQL}) a")
def q_apply_threshold(spark, sf_dir):
    return _applied(spark, sf_dir).select("dataset", "model", "pair_id", "threshold", "pred")


_CONF_SQL = f"""SELECT dataset, model, CAST(count_if(label = 1 AND pred = 1) AS BIGINT) AS tp, CAST(count_if(label <> 1 AND pred = 1) AS BIGINT) AS fp,
    CAST(count_if(label = 1 AND pred <> 1) AS BIGINT) AS fn, CAST(count_if(label <> 1 AND pred <> 1) AS BIGINT) AS tn FROM ({_APPLIED_SQL}) a GROUP BY dataset, model"""


@register("confusion_counts", _CONF_SQL)
def q_confusion(spark, sf_dir):
    return stats.confusion_counts(_applied(spark, sf_dir), K, "label", "pred")


def _div(a, b):
    return f"CASE WHEN ({b}) = 0 THEN {D(0)} ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


@register("basic_metrics", f"""
    SELECT c.dataset, c.model, {_div('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {_div('tp', 'tp + fp')} AS precision,
      {_div('tp', 'tp + fn')} AS recall, {_div('2 * tp', '2 * tp + fp + fn')} AS f1_score, a.auc AS roc_auc
    FROM ({_CONF_SQL}) c JOIN ({AUC_SQL}) a ON c.dataset = a.dataset AND c.model = a.model""")
def q_basic_metrics(spark, sf_dir):
    return M.basic_metrics(_applied(spark, sf_dir), K)


_PAN_PARTS_SQL = f"""
    SELECT dataset, model, ({D(1)} / n) * (nc + (nu * nc / n)) AS c_at_1,
      CASE WHEN {D(1.25)} * tp + {D(0.25)} * (fn + nu) + fp = 0 THEN {D(0)} ELSE ({D(1.25)} * tp) / ({D(1.25)} * tp + {D(0.25)} * (fn + nu) + fp) END AS f_05_u,
      CASE WHEN {D(2)} * tp + fp + fn = 0 THEN {D(0)} ELSE {D(2)} * tp / ({D(2)} * tp + fp + fn) END AS f1,
      CASE WHEN bad > 0 THEN {D(0)} ELSE {D(1)} - sq / n END AS brier
    FROM (SELECT dataset, model, CAST(count(*) AS DOUBLE) AS n, CAST(count_if(prob = 0.5) AS DOUBLE) AS nu,
            CAST(count_if(prob <> 0.5 AND ((prob > 0.5) = (CAST(label AS DOUBLE) > 0.5))) AS DOUBLE) AS nc,
            CAST(count_if(prob > 0.5 AND label = 1) AS DOUBLE) AS tp, CAST(count_if(prob > 0.5 AND label <> 1) AS DOUBLE) AS fp,
            CAST(count_if(prob < 0.5 AND label = 1) AS DOUBLE) AS fn, count_if(prob < 0 OR prob > 1) AS bad,
            sum((prob - CAST(label AS DOUBLE)) * (prob - CAST(label AS DOUBLE))) AS sq
          FROM ({SC}) s GROUP BY dataset, model) x"""


@register("pan_parts", f"SELECT dataset, model, c_at_1, f_05_u, f1, round(brier, 9) AS brier FROM ({_PAN_PARTS_SQL}) p")
def q_pan_parts(spark, sf_dir):
    p = M.pan_parts(_scores(spark, sf_dir), K)
    return p.withColumn("brier", F.round("brier", 9))


@register("pan_scores", f"""
    SELECT p.dataset, p.model, round_even(a.auc, 3) AS auc, round_even(c_at_1, 3) AS c_at_1, round_even(f_05_u, 3) AS f_05_u,
      round_even(f1, 3) AS f1, round_even(brier, 3) AS brier,
      round_even(((((a.auc + c_at_1) + f_05_u) + f1) + brier) / {D(5)}, 3) AS overall
    FROM ({_PAN_PARTS_SQL}) p JOIN ({AUC_SQL}) a ON p.dataset = a.dataset AND p.model = a.model""")
def q_pan_scores(spark, sf_dir):
    return M.pan_scores(_scores(spark, sf_dir), K)


@register("av_metrics", f"""
    WITH s AS (SELECT *, {D(0.5)} AS threshold, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS pred FROM ({SC}) x),
    c AS (SELECT dataset, model, count_if(label = 1 AND pred = 1) AS tp, count_if(label <> 1 AND pred = 1) AS fp,
                 count_if(label = 1 AND pred <> 1) AS fn, count_if(label <> 1 AND pred <> 1) AS tn, max(threshold) AS threshold
          FROM s GROUP BY dataset, model),
    d AS (SELECT *, tp + fn > 0 AS h1t, tn + fp > 0 AS h0t, (tp + fn > 0) OR (tp + fp > 0) AS h1, (tn + fp > 0) OR (tn + fn > 0) AS h0,
            {_div('tp', 'tp + fn')} AS r1, {_div('tn', 'tn + fp')} AS r0, {_div('tp', 'tp + fp')} AS p1, {_div('tn', 'tn + fn')} AS p0 FROM c)
    SELECT d.dataset, d.model, {_div('tp + tn', 'tp + fp + fn + tn')} AS accuracy,
      {_div('(CASE WHEN h1t THEN r1 ELSE 0.0 END) + (CASE WHEN h0t THEN r0 ELSE 0.0 END)', 'CAST(h1t AS INTEGER) + CAST(h0t AS INTEGER)')} AS macro_accuracy,
      {_div('tp + tn', 'tp + fp + fn + tn')} AS micro_recall,
      {_div('(CASE WHEN h1 THEN r1 ELSE 0.0 END) + (CASE WHEN h0 THEN r0 ELSE 0.0 END)', 'CAST(h1 AS INTEGER) + CAST(h0 AS INTEGER)')} AS macro_recall,
      {_div('tp + tn', 'tp + fp + fn + tn')} AS micro_precision,
      {_div('(CASE WHEN h1 THEN p1 ELSE 0.0 END) + (CASE WHEN h0 THEN p0 ELSE 0.0 END)', 'CAST(h1 AS INTEGER) + CAST(h0 AS INTEGER)')} AS macro_precision,
      threshold, {_div('2 * tp', '2 * tp + fp + fn')} AS f1, a.auc
    FROM d JOIN ({AUC_SQL}) a ON d.dataset = a.dataset AND d.model = a.model""")
def q_av_metrics(spark, sf_dir):
    s = _scores(spark, sf_dir).withColumn("threshold", F.lit(0.5)).withColumn("pred", M.binarize("prob", 0.5))
    return M.av_metrics(s, K)


@register("threshold_grid", f"""
    WITH s AS ({SC}),
    mm AS (SELECT dataset, model, min(prob) AS lo, max(prob) AS hi, count(*) AS n FROM s GROUP BY dataset, model),
    g AS (SELECT mm.*, i, CASE WHEN i >= 99 THEN hi ELSE CAST(i AS DOUBLE) * ((hi - lo) / CAST(99 AS DOUBLE)) + lo END AS t
          FROM mm CROSS JOIN range(0, 100) r(i)),
    per AS (SELECT g.dataset, g.model, g.i, g.t, CAST(count_if((s.prob >= g.t) = (s.label = 1)) AS DOUBLE) / CAST(g.n AS DOUBLE) AS accuracy,
                   count_if(s.prob > g.t AND s.label = 1) AS tp, count_if(s.prob > g.t AND s.label <> 1) AS fp,
                   count_if(s.prob < g.t AND s.label = 1) AS fn
            FROM g JOIN s ON g.dataset = s.dataset AND g.model = s.model GROUP BY g.dataset, g.model, g.i, g.t, g.n),
    fl AS (SELECT per.dataset, per.model, per.i, per.t AS threshold, per.accuracy, a.auc, pp.c_at_1, pp.f_05_u,
                    {_div('2 * tp', '2 * tp + fp + fn')} AS f1
             FROM per JOIN ({AUC_SQL}) a ON per.dataset = a.dataset AND per.model = a.model
             JOIN ({_PAN_PARTS_SQL}) pp ON per.dataset = pp.dataset AND per.model = pp.model),
    o AS (SELECT *, ((((accuracy + auc) + c_at_1) + f_05_u) + f1) / {D(5)} AS overall FROM fl)
    SELECT dataset, model, first(accuracy ORDER BY accuracy DESC, i DESC) AS accuracy, first(auc ORDER BY accuracy DESC, i DESC) AS auc,
      first(c_at_1 ORDER BY accuracy DESC, i DESC) AS c_at_1, first(f_05_u ORDER BY accuracy DESC, i DESC) AS f_05_u,
      first(f1 ORDER BY accuracy DESC, i DESC) AS f1, first(overall ORDER BY accuracy DESC, i DESC) AS overall,
      first(threshold ORDER BY accuracy DESC, i DESC) AS threshold
    FROM o GROUP BY dataset, model""")
def q_threshold_grid(spark, sf_dir):
    return M.threshold_grid(_scores(spark, sf_dir), K)


@register("similarity_stats", f"""SELECT model, CAST(min(prob) AS DOUBLE) AS min, CAST(max(prob) AS DOUBLE) AS max, round(avg(prob), 9) AS mean,
    round(stddev_pop(prob), 9) AS std, CAST(median(prob) AS DOUBLE) AS median FROM ({SC}) s GROUP BY model""")
def q_similarity_stats(spark, sf_dir):
    d = stats.similarity_stats(_scores(spark, sf_dir), "prob", ["model"])
    return d.withColumn("mean", F.round("mean", 9)).withColumn("std", F.round("std", 9))


# ---- bootstrap ------------------------------------------------------------------
_PRED_SQL = f"SELECT *, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS pred FROM ({SC}) x"
_PAT_SQL = f"""SELECT dataset, pair_id, first(label) AS label,
    concat_ws('|', CAST(first(label) AS VARCHAR), string_agg(concat(model, '=', CAST(pred AS VARCHAR)), ',' ORDER BY model)) AS pattern
    FROM ({_PRED_SQL}) s GROUP BY dataset, pair_id"""
_ROWS_SQL = f"""SELECT dataset, pair_id, pattern, row_number() OVER (PARTITION BY dataset ORDER BY pattern, pair_id) - 1 AS ord,
    count(*) OVER (PARTITION BY dataset) AS n FROM ({_PAT_SQL}) z"""
_W_SQL = f"""SELECT d.dataset, d.replicate, r.pattern, CAST(count(*) AS BIGINT) AS w FROM (
    SELECT dataset, rp.replicate, {key_sql(S.SEED, 'boot', '@dataset', '@rp.replicate', '@slot')} % n AS ord2
    FROM (SELECT dataset, n, unnest(generate_series(0, n - 1)) AS slot FROM (SELECT DISTINCT dataset, n FROM ({_ROWS_SQL}) q) q2) rw
    CROSS JOIN range(0, {B}) rp(replicate)) d JOIN ({_ROWS_SQL}) r ON r.dataset = d.dataset AND r.ord = d.ord2
    GROUP BY d.dataset, d.replicate, r.pattern"""
_BOOT_SQL = f"""
    WITH p AS (SELECT DISTINCT pt.dataset, pt.pattern, s.model, s.label, s.pred FROM ({_PRED_SQL}) s JOIN ({_PAT_SQL}) pt
               ON s.dataset = pt.dataset AND s.pair_id = pt.pair_id),
    j AS (SELECT w.*, p.model, p.label, p.pred FROM ({_W_SQL}) w JOIN p ON w.dataset = p.dataset AND w.pattern = p.pattern),
    a AS (SELECT dataset, model, replicate, sum(CASE WHEN label = 1 AND pred = 1 THEN w ELSE 0 END) AS tp,
                 sum(CASE WHEN label <> 1 AND pred = 1 THEN w ELSE 0 END) AS fp, sum(CASE WHEN label = 1 AND pred <> 1 THEN w ELSE 0 END) AS fn,
                 sum(CASE WHEN label = pred THEN w ELSE 0 END) AS ok, sum(w) AS n FROM j GROUP BY dataset, model, replicate)
    SELECT dataset, model, CAST(replicate AS BIGINT) AS replicate, {_div('2 * tp', '2 * tp + fp + fn')} AS f1,
           CAST(ok AS DOUBLE) / CAST(n AS DOUBLE) AS accuracy FROM a"""


def _pred_scores(spark, sf_dir):
    return _scores(spark, sf_dir).withColumn("pred", M.binarize("prob", 0.5))


@register("bootstrap_weights", f"""SELECT dataset, CAST(replicate AS BIGINT) AS replicate, CAST(count(*) AS BIGINT) AS n_patterns,
    CAST(sum(w) AS BIGINT) AS n_draws, CAST(max(w) AS BIGINT) AS max_w FROM ({_W_SQL}) w GROUP BY dataset, replicate""")
def q_bootstrap_weights(spark, sf_dir):
    w = S.bootstrap_weights(_pred_scores(spark, sf_dir))
    return w.groupBy("dataset", F.col("replicate").cast("bigint").alias("replicate")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_patterns"), F.sum("w").cast("bigint").alias("n_draws"),
        F.max("w").cast("bigint").alias("max_w"))


@register("bootstrap_metrics", _BOOT_SQL)
def q_bootstrap_metrics(spark, sf_dir):
    return S.bootstrap_metrics(_pred_scores(spark, sf_dir))


@register("significance_multinomial")
def q_significance_multinomial(spark, sf_dir):
    """M4 over multinomial samples of the patterns. The samples are numpy's, so SQL has no twin; pytest holds
    their moments and the report against the keyed draws."""
    return S.significance_report(_pred_scores(spark, sf_dir), weights=S.multinomial_weights)


_FULL_SQL = f"""SELECT dataset, model, {_div('2 * tp', '2 * tp + fp + fn')} AS f1, CAST(ok AS DOUBLE) / CAST(n AS DOUBLE) AS accuracy FROM (
    SELECT dataset, model, count_if(label = 1 AND pred = 1) AS tp, count_if(label <> 1 AND pred = 1) AS fp,
           count_if(label = 1 AND pred <> 1) AS fn, count_if(label = pred) AS ok, count(*) AS n FROM ({_PRED_SQL}) s GROUP BY dataset, model) x"""


@register("rank_models", f"""SELECT dataset, model, f1, CAST(row_number() OVER w AS BIGINT) AS rank, lead(model) OVER w AS next_model,
    lead(f1) OVER w AS next_value FROM ({_FULL_SQL}) f WINDOW w AS (PARTITION BY dataset ORDER BY f1 DESC, model)""")
def q_rank_models(spark, sf_dir):
    full = S.full_sample_metrics(_pred_scores(spark, sf_dir)).select("dataset", "model", "f1")
    return rank.rank_models(full, "f1", ["dataset"], "model")


def _cmp_sql(metric: str) -> str:
    return f"""
    WITH boot AS ({_BOOT_SQL}),
    r AS (SELECT dataset, model, {metric} AS v, row_number() OVER w AS rk, lead(model) OVER w AS nm, lead({metric}) OVER w AS nv
          FROM ({_FULL_SQL}) f WINDOW w AS (PARTITION BY dataset ORDER BY {metric} DESC, model)),
    pr AS (SELECT dataset, model AS model_a, nm AS model_b, CAST(rk AS BIGINT) AS rank_a, CAST(rk + 1 AS BIGINT) AS rank_b, v AS score_a, nv AS score_b
           FROM r WHERE nm IS NOT NULL),
    d AS (SELECT pr.*, a.{metric} - b.{metric} AS d FROM pr JOIN boot a ON a.dataset = pr.dataset AND a.model = pr.model_a
          JOIN boot b ON b.dataset = pr.dataset AND b.model = pr.model_b AND b.replicate = a.replicate)
    SELECT dataset, model_a, model_b, rank_a, rank_b, score_a, score_b, round(avg(d), 9) AS mean_diff,
      least({D(1)}, {D(2)} * least(avg(CASE WHEN d <= 0 THEN {D(1)} ELSE {D(0)} END), avg(CASE WHEN d >= 0 THEN {D(1)} ELSE {D(0)} END))) AS p_value,
      round(quantile_cont(d, 0.025), 9) AS ci_low, round(quantile_cont(d, 0.975), 9) AS ci_high,
      quantile_cont(d, 0.025) > 0 OR quantile_cont(d, 0.975) < 0 AS significance, '{metric}' AS metric
    FROM d GROUP BY dataset, model_a, model_b, rank_a, rank_b, score_a, score_b"""


def _round_cmp(df):
    return (df.withColumn("mean_diff", F.round("mean_diff", 9)).withColumn("ci_low", F.round("ci_low", 9))
            .withColumn("ci_high", F.round("ci_high", 9)))


@register("compare_adjacent", _cmp_sql("f1"))
def q_compare_adjacent(spark, sf_dir):
    s = _pred_scores(spark, sf_dir)
    boot = cut_lineage(S.bootstrap_metrics(s))  # read for both models of a pair
    return _round_cmp(S.compare_adjacent(boot, S.full_sample_metrics(s), "f1"))


@register("significance_report", f"SELECT * FROM ({_cmp_sql('f1')}) a UNION ALL SELECT * FROM ({_cmp_sql('accuracy')}) b")
def q_significance_report(spark, sf_dir):
    return _round_cmp(S.significance_report(_pred_scores(spark, sf_dir)))
