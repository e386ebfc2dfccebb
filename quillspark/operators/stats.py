"""Aggregations (D1-D10): hash aggregates with map-side partial combine.

None of them collects an unbounded group into one value except ``group_texts``
(D1) without ``part_size``, which is the reference's explicit per-author list
form and is meant for authors already capped by ``clean.filter_author_size``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_texts(df: DataFrame, author_col: str = "author", order_col: str = "post_id",
                cols: Sequence[str] = ("text",), part_size: int | None = None) -> DataFrame:
    """Per author, the posts as an array of structs ordered by ``order_col``.

    With ``part_size`` an author's posts come in parts of at most so many (author, part from 0, posts): rows of bounded size for
    authors of any size. Posts are numbered skew-safe and no task holds more than a part."""
    s = F.struct(F.col(order_col), *[F.col(c) for c in cols])
    if part_size is None:
        return df.groupBy(author_col).agg(F.sort_array(F.collect_list(s)).alias("posts"))
    from quillspark.operators.ranking import ordinal_in_group
    at = ordinal_in_group(df.select(author_col, order_col, *cols), [author_col], [order_col, *cols], col="__at")
    parted = at.withColumn("part", F.floor(F.col("__at") / part_size).cast("bigint"))
    return parted.groupBy(author_col, "part").agg(F.sort_array(F.collect_list(s)).alias("posts"))


def ungroup_texts(grouped: DataFrame, author_col: str = "author") -> DataFrame:
    """D1 inverse: one row per post again."""
    return grouped.select(author_col, F.explode("posts").alias("p")).select(author_col, "p.*")


def summarize_corpus(df: DataFrame, split_col: str = "split", author_col: str = "author",
                     text_col: str = "text") -> DataFrame:
    """Per split: authors, documents, words; docs and words per author as
    mean / max / min / median / population std. Two grouping levels."""
    from quillspark.functions.text import word_count
    per_author = df.groupBy(split_col, author_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("docs"),
        F.sum(word_count(text_col)).cast("bigint").alias("words"))
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_authors"),
            F.sum("docs").cast("bigint").alias("n_docs"),
            F.sum("words").cast("bigint").alias("n_words")]
    for c in ("docs", "words"):
        aggs += [F.avg(c).alias(f"{c}_mean"), F.max(c).cast("bigint").alias(f"{c}_max"),
                 F.min(c).cast("bigint").alias(f"{c}_min"), F.median(c).cast("double").alias(f"{c}_median"),
                 F.stddev_pop(c).alias(f"{c}_std")]
    return per_author.groupBy(split_col).agg(*aggs)


def summarize_pairs(pairs: DataFrame, split_col: str = "split", label_col: str = "label") -> DataFrame:
    """D3: positive and negative pairs per split."""
    lab = F.col(label_col).cast("boolean")
    return pairs.groupBy(split_col).agg(F.count_if(lab).cast("bigint").alias("n_pos"),
                                        F.count_if(~lab).cast("bigint").alias("n_neg"))


def count_terms(tokens: DataFrame, token_col: str = "token", kind: str = "token") -> DataFrame:
    """Corpus counts of terms: (kind, term, n). ``tokens`` has one token per row."""
    return tokens.groupBy(F.col(token_col).alias("term")).agg(F.count(F.lit(1)).cast("bigint").alias("n")) \
        .select(F.lit(kind).alias("kind"), "term", "n")


def count_chars(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """D4 (characters): one row per code point, counted."""
    chars = texts.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "")).alias("term")) \
        .filter(F.col("term") != "")
    return chars.groupBy("term").agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
        F.lit("char").alias("kind"), "term", "n")


def distinct_users(df: DataFrame, user_col: str = "user_id", exact: bool = True) -> DataFrame:
    """D5."""
    agg = F.countDistinct(user_col) if exact else F.approx_count_distinct(user_col)
    return df.agg(agg.cast("bigint").alias("n_users"))


def confusion_counts(df: DataFrame, keys: Sequence[str] = ("dataset", "model"), label_col: str = "label",
                     pred_col: str = "pred") -> DataFrame:
    """Tp, fp, fn, tn per group."""
    y, p = F.col(label_col) == 1, F.col(pred_col) == 1
    return df.groupBy(*keys).agg(
        F.count_if(y & p).cast("bigint").alias("tp"), F.count_if(~y & p).cast("bigint").alias("fp"),
        F.count_if(y & ~p).cast("bigint").alias("fn"), F.count_if(~y & ~p).cast("bigint").alias("tn"))


def similarity_stats(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Min, max, mean, population std, median."""
    aggs = [F.min(col).cast("double").alias("min"), F.max(col).cast("double").alias("max"),
            F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"), F.median(col).cast("double").alias("median")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def duplicate_report(df: DataFrame, author_col: str = "author", text_col: str = "text") -> DataFrame:
    """Texts seen more than once: copies, authors sharing the text.

    Grouped by a 64-bit text hash first (short shuffle key), then by the text
    itself to stay exact under collisions.
    """
    g = df.groupBy(F.xxhash64(text_col).alias("h"), F.col(text_col)).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_copies"),
        F.countDistinct(author_col).cast("bigint").alias("n_authors"),
        F.min(author_col).alias("first_author"))
    return g.filter(F.col("n_copies") > 1).drop("h")


def duplicate_summary(df: DataFrame, author_col: str = "author", text_col: str = "text") -> DataFrame:
    """D8 totals: duplicated texts, rows a first-wins dedupe removes, texts shared by authors."""
    rep = duplicate_report(df, author_col, text_col)
    return rep.agg(F.count(F.lit(1)).cast("bigint").alias("dup_texts"),
                   F.coalesce(F.sum(F.col("n_copies") - 1), F.lit(0)).cast("bigint").alias("rows_removed"),
                   F.count_if(F.col("n_authors") > 1).cast("bigint").alias("shared_texts"))


def pair_reduce(df: DataFrame, pair_col: str = "pair_id", pos_col: str = "pos", d_col: str = "d",
                seed: int = 42) -> DataFrame:
    """Several chunk distances per pair -> mean, median, first, keyed random."""
    from quillspark.functions import key
    return df.groupBy(pair_col).agg(
        F.avg(d_col).alias("d_mean"), F.median(d_col).cast("double").alias("d_median"),
        F.min_by(d_col, F.col(pos_col)).cast("double").alias("d_first"),
        F.min_by(d_col, F.struct(key(seed, "pick", F.col(pair_col), F.col(pos_col)), F.col(pos_col))).cast("double").alias("d_random"))
