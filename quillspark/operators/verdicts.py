"""Turning logged language-model output into scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Answer words of the verdict prompts.
POSITIVE, NEGATIVE = "yes", "no"
POSITIVE_DE = "ja"


def verdict_score(logprobs: DataFrame, id_col: str = "pair_id", pos_col: str = "pos", token_col: str = "token",
                  lp_col: str = "logprob", positive: str = POSITIVE, negative: str = NEGATIVE) -> DataFrame:
    """From top-k (token, logprob) rows per generated position: the first
    position holding a token that contains the positive or negative word
    (case-insensitive); score = (sum p(yes tokens) - sum p(no tokens)) / number
    of such tokens (a token matching both counts twice); 0 if none."""
    t = F.lower(F.col(token_col))
    y = t.contains(positive.lower())
    n = t.contains(negative.lower())
    p = F.exp(F.col(lp_col))
    per_pos = logprobs.groupBy(id_col, pos_col).agg(
        F.sum(F.when(y, p).otherwise(0.0)).alias("__sy"), F.sum(F.when(n, p).otherwise(0.0)).alias("__sn"),
        F.count_if(y).alias("__cy"), F.count_if(n).alias("__cn"))
    hit = per_pos.filter((F.col("__cy") + F.col("__cn")) > 0)
    first = hit.groupBy(id_col).agg(F.min_by(F.struct("__sy", "__sn", "__cy", "__cn"), F.col(pos_col)).alias("f"))
    ids = logprobs.select(id_col).distinct()
    j = ids.join(first, id_col, "left")
    score = F.when(F.col("f").isNull(), F.lit(0.0)).otherwise(
        (F.col("f.__sy") - F.col("f.__sn")) / (F.col("f.__cy") + F.col("f.__cn")).cast("double"))
    return j.select(id_col, score.alias("score"))


def verdict_label(text_col: str = "response", positive: str = POSITIVE):
    """The last 10 characters contain the positive word (case-insensitive)."""
    c = F.col(text_col)
    return F.lower(F.substring(c, -10, 10)).contains(positive.lower()) & c.isNotNull()


def truncate_pair_tokens(df: DataFrame, max_tokens: int, a: str = "tokens0", b: str = "tokens1") -> DataFrame:
    """Cut both token arrays to half of the model window."""
    half = max_tokens // 2
    return df.withColumn(a, F.slice(a, 1, half)).withColumn(b, F.slice(b, 1, half))


def broadcast_single(one: DataFrame, many: DataFrame) -> DataFrame:
    """One text against many: the single-row side is attached to every row."""
    if one.count() != 1:
        raise ValueError("broadcast_single expects exactly one row on the first side")
    return many.crossJoin(F.broadcast(one))
