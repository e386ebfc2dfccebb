"""Corpus invariants (O1) as one table (check, n_bad); every check is an
aggregate or a semi/anti join, so it runs on corpora of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_corpus(df: DataFrame, split_col: str = "split", label_col: str = "author_id", text_col: str = "text",
                 train: str = "train") -> DataFrame:
    """O1 on an AA table (split, label, text):

    * ``labels_dense``: train rows whose label is NULL or outside 0..A-1 (A = distinct train labels);
    * ``eval_labels_in_train``: non-train rows whose label never occurs in train;
    * ``text_in_two_splits``: distinct texts present in more than one split.
    """
    tr = df.filter(F.col(split_col) == train)
    A = tr.agg(F.countDistinct(label_col).alias("__A"))
    dense = tr.crossJoin(F.broadcast(A)).agg(F.count_if(
        F.col(label_col).isNull() | (F.col(label_col) < 0) | (F.col(label_col) >= F.col("__A"))).cast("bigint").alias("n_bad"))
    ev = df.filter(F.col(split_col) != train)
    unseen = ev.join(tr.select(label_col).distinct(), label_col, "left_anti").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_bad"))
    leak = (df.groupBy(F.xxhash64(text_col).alias("__h"), F.col(text_col))
            .agg(F.countDistinct(split_col).alias("__s")).agg(F.count_if(F.col("__s") > 1).cast("bigint").alias("n_bad")))
    return (dense.select(F.lit("labels_dense").alias("check"), "n_bad")
            .unionByName(unseen.select(F.lit("eval_labels_in_train").alias("check"), "n_bad"))
            .unionByName(leak.select(F.lit("text_in_two_splits").alias("check"), "n_bad")))


def check_av_labels(pairs: DataFrame, label_col: str = "label") -> DataFrame:
    """O1 (AV form): pair labels outside {0, 1}."""
    return pairs.agg(F.count_if(~F.coalesce(F.col(label_col).cast("int").isin(0, 1), F.lit(False)))
                     .cast("bigint").alias("n_bad")).select(F.lit("av_labels_binary").alias("check"), "n_bad")
