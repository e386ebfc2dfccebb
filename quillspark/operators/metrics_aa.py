"""Attribution metrics and rankings."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def aa_metrics(preds: DataFrame, keys: Sequence[str] = (), label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """L11 (label-based part): accuracy, balanced accuracy (classes in the
    truth), micro / macro precision, recall and F1 (labels in truth or
    predictions, zero division 0). Per-class counts come from two aggregates
    (by label, by prediction), not from a confusion matrix."""
    keys = list(keys)
    ok = (F.col(label_col) == F.col(pred_col))
    tot = preds.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.count_if(ok).alias("__ok")) if keys else \
        preds.agg(F.count(F.lit(1)).alias("__n"), F.count_if(ok).alias("__ok"))
    by_true = preds.groupBy(*keys, F.col(label_col).alias("cls")).agg(F.count(F.lit(1)).alias("support"), F.count_if(ok).alias("tp"))
    by_pred = preds.groupBy(*keys, F.col(pred_col).alias("cls")).agg(F.count(F.lit(1)).alias("predicted"))
    cls = by_true.join(by_pred, [*keys, "cls"], "full").fillna(0, ["support", "tp", "predicted"])
    cls = cls.select(*keys, "cls", "support", _div(F.col("tp"), F.col("support")).alias("rec"),
                     _div(F.col("tp"), F.col("predicted")).alias("prec"),
                     _div(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"))
    agg = (cls.groupBy(*keys) if keys else cls).agg(
        F.avg("rec").alias("macro_recall"), F.avg("prec").alias("macro_precision"), F.avg("f1").alias("macro_f1"),
        (F.sum(F.when(F.col("support") > 0, F.col("rec"))) / F.count_if(F.col("support") > 0)).alias("macro_accuracy"))
    j = tot.join(agg, keys) if keys else tot.crossJoin(agg)
    acc = _div(F.col("__ok"), F.col("__n"))
    return j.select(*keys, acc.alias("accuracy"), "macro_accuracy", acc.alias("micro_recall"), "macro_recall",
                    acc.alias("micro_precision"), "macro_precision", acc.alias("micro_f1"), "macro_f1")


def top_k_accuracy(scores: DataFrame, ks: Sequence[int] = tuple(range(2, 11)), id_col: str = "text_id",
                   label_col: str = "label", cls_col: str = "cls", score_col: str = "p") -> DataFrame:
    """Share of texts whose true class is among the k best scored classes
    (long input: one row per (text, class, score); ties by class)."""
    w = Window.partitionBy(id_col).orderBy(F.desc(score_col), F.col(cls_col))
    r = scores.withColumn("__r", F.row_number().over(w)).filter(F.col(cls_col) == F.col(label_col))
    return r.agg(*[F.avg((F.col("__r") <= k).cast("double")).alias(f"top{k}") for k in ks])


def ovr_auc(scores: DataFrame, id_col: str = "text_id", label_col: str = "label", cls_col: str = "cls",
            score_col: str = "p") -> DataFrame:
    """One-vs-rest AUC per class, macro and support-weighted averages."""
    from quillspark.operators.metrics import roc_auc
    s = scores.select(cls_col, (F.col(label_col) == F.col(cls_col)).cast("int").alias("y"), F.col(score_col).alias("prob"))
    per = roc_auc(s, [cls_col], "prob", "y")
    sup = scores.filter(F.col(label_col) == F.col(cls_col)).groupBy(cls_col).agg(F.count(F.lit(1)).alias("__s"))
    j = per.join(sup, cls_col)
    return j.agg(F.avg("auc").alias("ovr_macro_auc"), (F.sum(F.col("auc") * F.col("__s")) / F.sum("__s")).alias("ovr_weighted_auc"))


def class_pair_wins(scores: DataFrame, label_col: str = "label", cls_col: str = "cls", score_col: str = "p") -> DataFrame:
    """Rank statistic of every ordered pair of classes: (cls, label, wins2).

    In the column of scores for ``cls``, wins2 counts the (text of cls, text of ``label``) pairs
    that the text of cls wins, twice, ties once. One sorted pass with a running count of the
    column's own texts gives it: a text of any other class is beaten by those above it, so no
    row is copied per class pair. Equal scores are counted together first."""
    from quillspark.operators.ranking import prefix_sums
    counts = scores.groupBy(F.col(cls_col).alias("cls"), F.col(label_col).alias("label"), F.col(score_col).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    own = F.sum(F.when(F.col("cls") == F.col("label"), F.col("n")).otherwise(0))
    above = prefix_sums(counts.groupBy("cls", "p").agg(own.alias("own")), ["cls"], [F.col("p").desc()], ["own"], inclusive=False)
    rivals = counts.filter(F.col("cls") != F.col("label"))
    return (rivals.join(above, ["cls", "p"]).groupBy("cls", "label")
            .agg(F.sum(F.col("n") * (2 * F.col("cum_own") + F.col("own"))).cast("bigint").alias("wins2")))


def ovo_auc(scores: DataFrame, label_col: str = "label", cls_col: str = "cls", score_col: str = "p") -> DataFrame:
    """One-vs-one AUC. For each pair of classes the mean of both directions, then the
    mean over pairs (macro) or weighted by the pair's texts. Classes are those of the truth;
    with fewer than two of them both averages are null. ``scores`` has a row per (text, class)."""
    support = scores.filter(F.col(label_col) == F.col(cls_col)).groupBy(F.col(cls_col).alias("cls")).agg(F.count(F.lit(1)).alias("s"))
    j = (class_pair_wins(scores, label_col, cls_col, score_col).join(support.withColumnRenamed("s", "a"), "cls")
         .join(support.select(F.col("cls").alias("label"), F.col("s").alias("b")), "label"))
    auc = F.col("wins2") / (2.0 * F.col("a") * F.col("b"))
    total = support.agg(F.count(F.lit(1)).alias("k"), F.sum("s").alias("n"))
    pairs = j.agg(F.sum(auc).alias("plain"), F.sum(auc * (F.col("a") + F.col("b"))).alias("weighted"))
    many = F.col("k") > 1
    return pairs.crossJoin(total).select(F.when(many, F.col("plain") / (F.col("k") * (F.col("k") - 1))).alias("ovo_macro_auc"),
                                         F.when(many, F.col("weighted") / (2 * (F.col("k") - 1) * F.col("n"))).alias("ovo_weighted_auc"))


def loss_normalised_ranking(test_loss: DataFrame, norm_loss: DataFrame | None, id_col: str = "text_id",
                            author_col: str = "author_id", loss_col: str = "loss") -> DataFrame:
    """Subtract each author's mean loss on a normalisation split (None = no
    normalisation), then rank authors per text by the normalised loss (E7)."""
    from quillspark.operators.rank import rank_authors_for_text
    t = test_loss
    if norm_loss is not None:
        mu = norm_loss.groupBy(author_col).agg(F.avg(loss_col).alias("__mu"))
        t = t.join(mu, author_col).withColumn(loss_col, F.col(loss_col) - F.col("__mu")).drop("__mu")
    return rank_authors_for_text(t, id_col, author_col, loss_col)


def best_run(runs: DataFrame, loss_col: str = "val_loss", settings: Sequence[str] = ()) -> DataFrame:
    """The run with the lowest validation loss (ties by settings)."""
    s = F.struct(*[F.col(c) for c in settings]) if settings else F.struct(*[F.col(c) for c in runs.columns if c != loss_col])
    return runs.agg(F.min_by(s, F.struct(F.col(loss_col), s)).alias("best"), F.min(loss_col).alias(loss_col)).select("best.*", loss_col)


def param_grid(spark, grid: dict) -> DataFrame:
    """All combinations of parameter values, built by exploding arrays
    (one row per combination)."""
    df = spark.range(1).drop("id")
    for name, values in grid.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df
