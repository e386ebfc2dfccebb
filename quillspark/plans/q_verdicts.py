"""Registered queries: verdict scoring of logged model output (N1-N4), attribution metrics (L11) and run selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import key, key_sql
from quillspark.functions import text as T
from quillspark.operators import metrics as M
from quillspark.operators import metrics_aa as MA
from quillspark.operators import verdicts as N
from quillspark.plans.registry import register
from quillspark.plans.q_vectors import _vsplit, _TC_SQL
from quillspark.sources import views


def D(x) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def token_logprobs(spark, sf_dir):
    """Logged top-2 candidates per generated position, derived from assistant turns:
    candidate 0 is the turn's own token, candidate 1 a keyed answer word."""
    c = views.table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    pid = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    t = c.select(pid.alias("pair_id"), F.posexplode(T.tokenize("text")).alias("pos", "tok"))
    k = key(7, "alt", F.col("pair_id"), F.col("pos"))
    alt = (F.when(k % 4 == 0, "Yes").when(k % 4 == 1, "no").when(k % 4 == 2, "know").otherwise("maybe"))
    lp0 = -(key(7, "lp0", F.col("pair_id"), F.col("pos")) % 1000).cast("double") / F.lit(250.0)
    lp1 = -(key(7, "lp1", F.col("pair_id"), F.col("pos")) % 1000).cast("double") / F.lit(250.0)
    return (t.select("pair_id", F.col("pos").cast("bigint").alias("pos"), F.col("tok").alias("token"), lp0.alias("logprob"))
            .unionByName(t.select("pair_id", F.col("pos").cast("bigint").alias("pos"), alt.alias("token"), lp1.alias("logprob"))))


_K = lambda name: key_sql(7, name, "@pair_id", "@pos")
_LP_SQL = f"""
    WITH t AS (SELECT concat(CAST(conv_id AS VARCHAR), ':', CAST(turn AS VARCHAR)) AS pair_id, unnest({T.tokenize_sql('text')}) AS tok,
                      unnest(generate_series(0, len({T.tokenize_sql('text')}) - 1)) AS pos FROM conversations WHERE role = 'assistant')
    SELECT pair_id, CAST(pos AS BIGINT) AS pos, tok AS token, -CAST({_K('lp0')} % 1000 AS DOUBLE) / {D(250)} AS logprob FROM t
    UNION ALL
    SELECT pair_id, CAST(pos AS BIGINT) AS pos, CASE {_K('alt')} % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN 'know' ELSE 'maybe' END AS token,
           -CAST({_K('lp1')} % 1000 AS DOUBLE) / {D(250)} AS logprob FROM t"""


@register("verdict_score", f"""
    WITH lp AS ({_LP_SQL}),
    pp AS (SELECT pair_id, pos, sum(CASE WHEN contains(lower(token), 'yes') THEN exp(logprob) ELSE {D(0)} END) AS sy,
                  sum(CASE WHEN contains(lower(token), 'no') THEN exp(logprob) ELSE {D(0)} END) AS sn,
                  count_if(contains(lower(token), 'yes')) AS cy, count_if(contains(lower(token), 'no')) AS cn FROM lp GROUP BY pair_id, pos),
    f AS (SELECT pair_id, first((sy - sn) / CAST(cy + cn AS DOUBLE) ORDER BY pos) AS score FROM pp WHERE cy + cn > 0 GROUP BY pair_id)
    SELECT i.pair_id, round(coalesce(f.score, {D(0)}), 9) AS score FROM (SELECT DISTINCT pair_id FROM lp) i LEFT JOIN f ON i.pair_id = f.pair_id""")
def q_verdict_score(spark, sf_dir):
    return N.verdict_score(token_logprobs(spark, sf_dir)).withColumn("score", F.round("score", 9))


@register("verdict_label", """SELECT conv_id, turn, coalesce(contains(lower(right(text, 10)), 'yes'), false) AS yes_label,
    coalesce(contains(lower(right(text, 10)), 'ja'), false) AS ja_label FROM conversations WHERE role = 'assistant'""")
def q_verdict_label(spark, sf_dir):
    c = views.table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    return c.select("conv_id", "turn", F.coalesce(N.verdict_label("text", "yes"), F.lit(False)).alias("yes_label"),
                    F.coalesce(N.verdict_label("text", "ja"), F.lit(False)).alias("ja_label"))


@register("truncate_pair_tokens", f"""
    SELECT a.conv_id, a.turn, array_to_string({T.tokenize_sql('a.text')}[1:64], ' ') AS tokens0, array_to_string({T.tokenize_sql('b.text')}[1:64], ' ') AS tokens1
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def q_truncate_pair_tokens(spark, sf_dir):
    c = views.table(spark, sf_dir, "conversations")
    a = c.select("conv_id", "turn", T.tokenize("text").alias("tokens0"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("turn"), T.tokenize("text").alias("tokens1"))
    t = N.truncate_pair_tokens(a.join(b, ["conv_id", "turn"]), 128)
    return t.select("conv_id", "turn", F.array_join("tokens0", " ").alias("tokens0"), F.array_join("tokens1", " ").alias("tokens1"))


@register("broadcast_single", """SELECT d.doc_id, b.item_id, length(b.text) AS n0, length(d.text) AS n1 FROM documents d,
    (SELECT * FROM benchmark ORDER BY item_id LIMIT 1) b""")
def q_broadcast_single(spark, sf_dir):
    b = views.table(spark, sf_dir, "benchmark").orderBy("item_id").limit(1).select("item_id", F.length("text").cast("bigint").alias("n0"))
    d = views.table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("bigint").alias("n1"))
    return N.broadcast_single(b, d).select("doc_id", "item_id", "n0", "n1")


# L11 --------------------------------------------------------------------------------------
_PRED_SQL = f"""SELECT x.text_id, s.author_id AS label, x.pred FROM (
    SELECT text_id, first(author_id ORDER BY d, author_id) AS pred FROM ({_TC_SQL}) t GROUP BY text_id) x
    JOIN ({views.vec_sql()}) s ON s.text_id = x.text_id"""


def _aa_preds(spark, sf_dir):
    from quillspark.operators import vectors as V
    s = _vsplit(spark, sf_dir)
    r = V.attribute_by_vectors(s.filter("split = 'test'"), s.filter("split = 'train'"))
    return r.join(s.select("text_id", F.col("author_id").alias("label")), "text_id")


def _div(a, b):
    return f"CASE WHEN ({b}) = 0 THEN {D(0)} ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


@register("aa_metrics", f"""
    WITH p AS ({_PRED_SQL}),
    bt AS (SELECT label AS cls, count(*) AS support, count_if(label = pred) AS tp FROM p GROUP BY label),
    bp AS (SELECT pred AS cls, count(*) AS predicted FROM p GROUP BY pred),
    c AS (SELECT coalesce(bt.cls, bp.cls) AS cls, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted
          FROM bt FULL JOIN bp ON bt.cls = bp.cls),
    m AS (SELECT avg({_div('tp', 'support')}) AS macro_recall, avg({_div('tp', 'predicted')}) AS macro_precision,
                 avg({_div('2 * tp', 'support + predicted')}) AS macro_f1,
                 sum(CASE WHEN support > 0 THEN {_div('tp', 'support')} END) / count_if(support > 0) AS macro_accuracy FROM c),
    t AS (SELECT count(*) AS n, count_if(label = pred) AS ok FROM p)
    SELECT round({_div('ok', 'n')}, 9) AS accuracy, round(macro_accuracy, 9) AS macro_accuracy, round({_div('ok', 'n')}, 9) AS micro_recall,
      round(macro_recall, 9) AS macro_recall, round({_div('ok', 'n')}, 9) AS micro_precision, round(macro_precision, 9) AS macro_precision,
      round({_div('ok', 'n')}, 9) AS micro_f1, round(macro_f1, 9) AS macro_f1 FROM t, m""")
def q_aa_metrics(spark, sf_dir):
    m = MA.aa_metrics(_aa_preds(spark, sf_dir), [], "label", "pred")
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@register("aa_topk", f"""
    WITH r AS (SELECT t.text_id, t.author_id AS cls, s.author_id AS label, row_number() OVER (PARTITION BY t.text_id ORDER BY -t.d DESC, t.author_id) AS rk
               FROM ({_TC_SQL}) t JOIN ({views.vec_sql()}) s ON s.text_id = t.text_id)
    SELECT {", ".join(f"avg(CASE WHEN rk <= {k} THEN {D(1)} ELSE {D(0)} END) AS top{k}" for k in range(2, 11))} FROM r WHERE cls = label""")
def q_aa_topk(spark, sf_dir):
    from quillspark.operators import vectors as V
    s = _vsplit(spark, sf_dir)
    c = V.author_centroids(s.filter("split = 'train'"))
    cands = c.select(F.col("author_id").alias("cand_id"), "author_id", F.col("centroid").alias("embedding"))
    nn = V.nearest_candidates(s.filter("split = 'test'"), cands, None, "euclidean", "text_id", "cand_id", "author_id")
    sc = nn.join(s.select("text_id", F.col("author_id").alias("label")), "text_id").select(
        "text_id", "label", F.col("author_id").alias("cls"), (-F.col("d")).alias("p"))
    return MA.top_k_accuracy(sc, range(2, 11), "text_id", "label", "cls", "p")


def _class_scores(spark, sf_dir):
    """(text_id, label, cls, p): every test text scored for every author, p = -distance to the centroid."""
    from quillspark.operators import vectors as V
    s = _vsplit(spark, sf_dir)
    c = V.author_centroids(s.filter("split = 'train'"))
    cands = c.select(F.col("author_id").alias("cand_id"), "author_id", F.col("centroid").alias("embedding"))
    nn = V.nearest_candidates(s.filter("split = 'test'"), cands, None, "euclidean", "text_id", "cand_id", "author_id")
    return nn.join(s.select("text_id", F.col("author_id").alias("label")), "text_id").select(
        "text_id", "label", F.col("author_id").alias("cls"), F.round(-F.col("d"), 9).alias("p"))


# every (text of the class, other text) pair is compared, on purpose another way than the running counts
_PAIRWISE_SQL = f"""t AS (SELECT t.text_id, t.author_id AS cls, s.author_id AS label, round(-t.d, 9) AS p
        FROM ({_TC_SQL}) t JOIN ({views.vec_sql()}) s ON s.text_id = t.text_id),
    n AS (SELECT label AS cls, CAST(count(*) AS DOUBLE) AS s FROM t WHERE cls = label GROUP BY label),
    u AS (SELECT a.cls, b.label, sum(CASE WHEN a.p > b.p THEN {D(1)} WHEN a.p = b.p THEN {D(0.5)} ELSE {D(0)} END) AS w
          FROM t a JOIN t b ON a.cls = b.cls AND a.label = a.cls AND b.label <> b.cls GROUP BY a.cls, b.label)"""


@register("ovo_auc", f"""
    WITH {_PAIRWISE_SQL},
    d AS (SELECT least(u.cls, u.label) AS j, greatest(u.cls, u.label) AS k, avg(u.w / (x.s * y.s)) AS auc, max(x.s + y.s) AS weight
          FROM u JOIN n x ON x.cls = u.cls JOIN n y ON y.cls = u.label GROUP BY 1, 2)
    SELECT round(avg(auc), 9) AS ovo_macro_auc, round(sum(auc * weight) / sum(weight), 9) AS ovo_weighted_auc FROM d""")
def q_ovo_auc(spark, sf_dir):
    m = MA.ovo_auc(_class_scores(spark, sf_dir))
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@register("ovr_auc", f"""
    WITH {_PAIRWISE_SQL},
    d AS (SELECT u.cls, sum(u.w) / (max(x.s) * sum(y.s)) AS auc, max(x.s) AS weight
          FROM u JOIN n x ON x.cls = u.cls JOIN n y ON y.cls = u.label GROUP BY u.cls)
    SELECT round(avg(auc), 9) AS ovr_macro_auc, round(sum(auc * weight) / sum(weight), 9) AS ovr_weighted_auc FROM d""")
def q_ovr_auc(spark, sf_dir):
    m = MA.ovr_auc(_class_scores(spark, sf_dir))
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


# L15 ----------------------------------------------------------------------------------------
_GRID = [0.3, 0.4, 0.5, 0.6, 0.7]


@register("best_run", f"""
    WITH g AS (SELECT m.model, t.threshold FROM (SELECT DISTINCT model FROM ({views.scores_sql()}) s) m,
               (VALUES {", ".join(f"({D(x)})" for x in _GRID)}) t(threshold)),
    l AS (SELECT g.model, g.threshold, CAST(count_if(CAST(s.prob >= g.threshold AS INTEGER) <> s.label) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS val_loss
          FROM g JOIN ({views.scores_sql()}) s ON s.model = g.model GROUP BY g.model, g.threshold)
    SELECT first(model ORDER BY val_loss, model, threshold) AS model, first(threshold ORDER BY val_loss, model, threshold) AS threshold,
           min(val_loss) AS val_loss FROM l""")
def q_best_run(spark, sf_dir):
    s = views.scores(spark, sf_dir)
    grid = s.select("model").distinct().withColumn("threshold", F.explode(F.array(*[F.lit(x) for x in _GRID])))
    l = grid.join(s, "model").groupBy("model", "threshold").agg(
        (F.count_if((F.col("prob") >= F.col("threshold")).cast("int") != F.col("label")).cast("double") / F.count(F.lit(1)).cast("double")).alias("val_loss"))
    return MA.best_run(l, "val_loss", ["model", "threshold"])
