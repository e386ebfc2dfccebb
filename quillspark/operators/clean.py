"""Row filters, predicates and projections.

All are column expressions, so Catalyst pushes the plain ones into the
parquet scan; author-size filters are an aggregate plus a semi join (no
per-author lists are built).
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as T

# Fixed values (reference preprocessing settings).
DROPPED_TWEET_TYPES = ("status", "reply", "user", "retweet")
BOT_PATTERNS = ("bot", "Bot", "BOT")
FORUM_BOT_NAMES = ("null", "AutoModerator")
MIN_WORDS_SHORT = 25
MAX_CHARS_SHORT = 300
MIN_LEN_FORUM = 25
MAX_LEN_FORUM = 1000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_types(df: DataFrame, col: str = "type", types: Iterable[str] = DROPPED_TWEET_TYPES) -> DataFrame:
    """B1: drop rows whose type is listed (NULL type is kept)."""
    return df.filter(~F.coalesce(_c(col).isin(list(types)), F.lit(False)))


def once(df: DataFrame, col: str, value: Column | None = None) -> DataFrame:
    """``col`` computed once a row. A plain expression would be repeated in the filter for every comparison."""
    return df.withColumn(col, F.explode(F.array(_c(col) if value is None else value)))


def filter_words_chars(df: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS_SHORT,
                       max_chars: int = MAX_CHARS_SHORT) -> DataFrame:
    """B2: strip the text, keep words >= min_words and chars <= max_chars (inclusive)."""
    s = once(df, text_col, T.strip(text_col))
    return s.filter((T.word_count(text_col) >= min_words) & (F.length(text_col) <= max_chars))


def filter_length_open(df: DataFrame, col: str = "text_length", lo: int = MIN_LEN_FORUM,
                       hi: int = MAX_LEN_FORUM) -> DataFrame:
    """Lo < length < hi, both exclusive."""
    return once(df, col).filter((_c(col) > lo) & (_c(col) < hi))


def drop_url_posts(df: DataFrame, col: str = "url_count", enabled: bool = True) -> DataFrame:
    """Keep rows without URLs."""
    return df.filter(_c(col) == 0) if enabled else df


def keep_languages(df: DataFrame, langs: Sequence[str], col: str = "text_lang") -> DataFrame:
    """B5."""
    return df.filter(_c(col).isin(list(langs)))


def bot_name(col, extra: Iterable[str] = ()) -> Column:
    """True if the name contains a bot-like substring (case-sensitive); NULL -> False."""
    parts = [*BOT_PATTERNS, *extra]
    cond = None
    for p in parts:
        c = F.coalesce(_c(col).contains(p), F.lit(False))
        cond = c if cond is None else (cond | c)
    return cond


def drop_bot_users(df: DataFrame, col: str = "author", extra: Iterable[str] = ()) -> DataFrame:
    """Drop bot-like users. ``extra=FORUM_BOT_NAMES`` gives the forum rule."""
    return df.filter(~bot_name(col, extra))


def drop_unknown_domain(df: DataFrame, col: str = "domain") -> DataFrame:
    """B7."""
    return df.filter(_c(col) != "unknown")


def strip_nul_and_short(df: DataFrame, text_cols: Sequence[str] = ("text",), min_chars: int = 50) -> DataFrame:
    """Drop rows where a text has <= min_chars chars, then delete NUL chars."""
    out = df
    for c in text_cols:
        out = out.filter(F.length(c) > min_chars)
    for c in text_cols:
        out = out.withColumn(c, F.translate(F.col(c), "\u0000", ""))
    return out


def truncate_text(df: DataFrame, text_cols: Sequence[str], n: int) -> DataFrame:
    """Cut text columns at n chars."""
    out = df
    for c in text_cols:
        out = out.withColumn(c, T.truncate(c, n))
    return out


def author_counts(df: DataFrame, author_col: str = "author", distinct_col: str | None = None) -> DataFrame:
    """Texts (or distinct values of ``distinct_col``) per author; partial aggregation before the shuffle."""
    agg = F.count(F.lit(1)) if distinct_col is None else F.countDistinct(distinct_col)
    return df.groupBy(author_col).agg(agg.cast("bigint").alias("n_texts"))


def filter_author_size(df: DataFrame, author_col: str = "author", min_n: int | None = None,
                       max_n: int | None = None, distinct_col: str | None = None) -> DataFrame:
    """Keep authors with min_n <= texts <= max_n (semi join, no lists)."""
    counts = author_counts(df, author_col, distinct_col)
    cond = F.lit(True)
    if min_n is not None:
        cond = cond & (F.col("n_texts") >= min_n)
    if max_n is not None:
        cond = cond & (F.col("n_texts") <= max_n)
    keep = counts.filter(cond).select(author_col)
    return df.join(keep, author_col, "left_semi")


def drop_short_pairs(df: DataFrame, cols: Sequence[str] = ("text0", "text1"), min_chars: int = 50) -> DataFrame:
    """B11 (pair form): drop pairs where any text is shorter than min_chars."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.coalesce(F.length(c), F.lit(0)) >= min_chars)
    return df.filter(cond)


def short_text_losses(df: DataFrame, author_col: str = "author_id", text_col: str = "text",
                      min_chars: int = 50) -> DataFrame:
    """B11 (AA form) check table: texts each author loses to the length rule."""
    return df.groupBy(author_col).agg(
        F.count_if(F.coalesce(F.length(text_col), F.lit(0)) < min_chars).cast("bigint").alias("n_lost"),
        F.count(F.lit(1)).cast("bigint").alias("n_texts"))


def refuse_short_text_losses(df: DataFrame, max_lost: int = 9, author_col: str = "author_id", text_col: str = "text", min_chars: int = 50) -> DataFrame:
    """B11 (AA form): the texts of ``min_chars`` or more; reading or writing them fails, naming the author, if any author loses
    more than ``max_lost`` texts. The check is part of the plan: no count runs on the driver, and a failed task commits no file."""
    lost = short_text_losses(df, author_col, text_col, min_chars)
    bad = F.concat(F.lit("author "), F.coalesce(F.col(author_col).cast("string"), F.lit("null")), F.lit(" loses "), F.col("n_lost").cast("string"), F.lit(" texts"))
    checked = lost.select(F.col(author_col).alias("__author"), F.when(F.col("n_lost") > max_lost, F.raise_error(bad).cast("bigint")).otherwise(F.col("n_lost")).alias("__lost"))
    # every author's verdict is in the one row that all texts need, so no text comes out before all authors are seen
    seen = checked.agg(F.coalesce(F.sum("__lost"), F.lit(0)).alias("__lost"))
    return drop_short_pairs(df, (text_col,), min_chars).crossJoin(F.broadcast(seen)).filter(F.col("__lost") >= 0).drop("__lost")


def limit_authors(df: DataFrame, n: int, col: str = "author_id", inverse: bool = False) -> DataFrame:
    """Author label < n (or >= n)."""
    return df.filter(_c(col) >= n) if inverse else df.filter(_c(col) < n)


def route_topics(df: DataFrame, col: str, in_dist: Sequence[str], cross_topic: Sequence[str] = (),
                 cross_genre: Sequence[str] = (), out_col: str = "route") -> DataFrame:
    """Route rows by category; an unknown category raises at run time."""
    c = _c(col)
    route = (F.when(c.isin(list(in_dist)), F.lit("in_distribution"))
             .when(c.isin(list(cross_topic)) if cross_topic else F.lit(False), F.lit("cross_topic"))
             .when(c.isin(list(cross_genre)) if cross_genre else F.lit(False), F.lit("cross_genre"))
             .otherwise(F.raise_error(F.concat(F.lit("unknown category: "), F.coalesce(c.cast("string"), F.lit("NULL"))))))
    return df.withColumn(out_col, route.cast("string"))


def min_words(df: DataFrame, text_col: str = "text", n: int = 101) -> DataFrame:
    """Keep texts with at least n whitespace-separated words."""
    return df.filter(T.word_count(text_col) >= n)


def min_chars(df: DataFrame, text_col: str = "text", n: int = 100) -> DataFrame:
    """B14 (char form)."""
    return df.filter(F.coalesce(F.length(text_col), F.lit(0)) >= n)


def normalize_pair_labels(df: DataFrame, a_col: str = "auth0", b_col: str = "auth1", out: str = "label",
                          signed: bool = False) -> DataFrame:
    """1 if the two author ids are equal else 0 (or +1/-1)."""
    same = F.col(a_col) == F.col(b_col)
    val = F.when(same, 1).otherwise(-1 if signed else 0)
    return df.withColumn(out, val.cast("int"))


def select_subset(df: DataFrame, n: int, order: Sequence[str] = ("pair_id",)) -> DataFrame:
    """First n rows by a stable order (TakeOrderedAndProject; the limit is the feature)."""
    return df.orderBy(*order).limit(n)
