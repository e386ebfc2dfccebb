"""Ranking, top-k and ordering operators."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.ranking import dense_ids, ordinal_in_group


def cap_texts_per_author(df: DataFrame, n: int, author_col: str = "author_id", id_col: str = "text_id",
                         text_col: str | None = None, max_chars: int | None = None) -> DataFrame:
    """First n texts of each author by id, optional char cut.

    ``row_number() <= n`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so each map task sends at most n rows per author.
    """
    w = Window.partitionBy(author_col).orderBy(id_col)
    out = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")
    if text_col is not None and max_chars is not None:
        out = out.withColumn(text_col, F.substring(text_col, 1, max_chars))
    return out


def top_authors(df: DataFrame, n: int, author_col: str = "author") -> DataFrame:
    """The n authors with most texts (ties by name), labelled 0..n-1 in that order."""
    counts = df.groupBy(author_col).agg(F.count(F.lit(1)).cast("bigint").alias("n_texts"))
    top = counts.orderBy(F.desc("n_texts"), F.col(author_col)).limit(n)
    # n rows only: a global window over the top-k result is fine
    return top.withColumn("label", (F.row_number().over(Window.orderBy(F.desc("n_texts"), F.col(author_col))) - 1).cast("bigint"))


def build_vocab(counts: DataFrame, min_count: int = 1, top_k: int | None = None,
                specials: Sequence[str] = ("<UNK>", "<PAD>"), term_col: str = "term", n_col: str = "n") -> DataFrame:
    """Drop rare terms, keep the top-k by count (ties by term), ids after the specials.

    Special tokens get ids 0..s-1; terms follow from s (so no word shares an id
    with a special token, q19).
    """
    kept = counts.filter(F.col(n_col) >= min_count)
    if top_k is not None:
        kept = kept.orderBy(F.desc(n_col), F.col(term_col)).limit(top_k)
        w = Window.orderBy(F.desc(n_col), F.col(term_col))  # top_k rows only
        ranked = kept.withColumn("id", (F.row_number().over(w) - 1 + len(specials)).cast("bigint"))
    else:
        from quillspark.operators.ranking import global_rank
        ranked = global_rank(kept.withColumn("__neg", -F.col(n_col)), ["__neg", term_col], "__r") \
            .withColumn("id", (F.col("__r") - 1 + len(specials)).cast("bigint")).drop("__neg", "__r")
    spark = counts.sparkSession
    sp = spark.createDataFrame([(t, None, i) for i, t in enumerate(specials)],
                               f"{term_col} string, {n_col} bigint, id bigint")
    return sp.unionByName(ranked.select(term_col, F.col(n_col).cast("bigint"), "id"))


def rank_models(df: DataFrame, metric: str, keys: Sequence[str] = ("dataset",), model_col: str = "model") -> DataFrame:
    """Order models by a metric (desc) within a dataset; each row gets its lower neighbour."""
    w = Window.partitionBy(*keys).orderBy(F.desc(metric), F.col(model_col))
    return (df.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .withColumn("next_model", F.lead(model_col).over(w))
            .withColumn("next_value", F.lead(metric).over(w)))


def dense_author_ids(df: DataFrame, author_col: str = "author", id_col: str = "post_id",
                     out_col: str = "author_id") -> DataFrame:
    """E5: author -> 0..A-1 in first-seen order (by smallest text id), joined back."""
    ids = dense_ids(df, [author_col], [id_col], id_col=out_col)
    return df.join(ids, author_col)


def split_by_position(df: DataFrame, author_col: str = "author", id_col: str = "post_id",
                      train_n: int = 600, val_n: int = 200) -> DataFrame:
    """Per author rows 0..train_n-1 train, next val_n validation, rest test (by id)."""
    o = ordinal_in_group(df, [author_col], [id_col], col="__o")
    return o.withColumn("split", F.when(F.col("__o") < train_n, "train")
                        .when(F.col("__o") < train_n + val_n, "validation").otherwise("test")).drop("__o")


def rank_authors_for_text(df: DataFrame, text_col: str = "text_id", author_col: str = "author_id",
                          loss_col: str = "loss") -> DataFrame:
    """For each text all candidate authors by increasing loss (rank 1 = best)."""
    w = Window.partitionBy(text_col).orderBy(F.col(loss_col), F.col(author_col))
    return df.withColumn("rank", F.row_number().over(w).cast("bigint"))


def knn_vote(dist: DataFrame, k: int, query_col: str = "text_id", label_col: str = "author_id",
             d_col: str = "d", cand_col: str = "cand_id") -> DataFrame:
    """Majority label among the k nearest candidates; ties -> smallest label."""
    w = Window.partitionBy(query_col).orderBy(F.col(d_col), F.col(cand_col))
    near = dist.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
    votes = near.groupBy(query_col, label_col).agg(F.count(F.lit(1)).alias("__v"))
    return votes.groupBy(query_col).agg(
        F.min_by(label_col, F.struct(-F.col("__v"), F.col(label_col))).alias("pred"))


def sort_results(df: DataFrame, metric: str) -> DataFrame:
    """Final table by metric, descending."""
    return df.orderBy(F.desc(metric))
