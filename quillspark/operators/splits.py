"""Splits and sampling.

Draws are keyed (``functions.keys.key``), so a split is a pure function of
(seed, ids) and survives repartitioning and retries.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import key
from quillspark.operators.ranking import global_rank, ordinal_in_group

SPLIT_NAMES = ("train", "validation", "test")


def split_authors(df: DataFrame, author_col: str = "author", seed: int = 42, holdout: float = 0.4,
                  test_of_holdout: float = 0.5) -> DataFrame:
    """disjoint author sets (default 60/20/20).

    Returns one row per author: (author, split, split_idx, split_n) where
    split_idx numbers the authors 0..split_n-1 inside their split. Sizes follow
    the two-step rule holdout = ceil(holdout*n), test = ceil(test_of_holdout*holdout).
    Authors are ordered by a keyed draw; the global rank is computed without a
    single-partition window.
    """
    authors = df.select(author_col).distinct().withColumn("__k", key(seed, "split", F.col(author_col)))
    ranked = global_rank(authors, ["__k", author_col], rank_col="__r")
    n = authors.agg(F.count(F.lit(1)).cast("bigint").alias("__n"))
    h = F.ceil(F.lit(float(holdout)) * F.col("__n").cast("double")).cast("bigint")
    t = F.ceil(F.lit(float(test_of_holdout)) * h.cast("double")).cast("bigint")
    r = F.col("__r")
    out = ranked.crossJoin(F.broadcast(n)).select(
        author_col,
        F.when(r <= t, "test").when(r <= h, "validation").otherwise("train").alias("split"),
        F.when(r <= t, r - 1).when(r <= h, r - 1 - t).otherwise(r - 1 - h).cast("bigint").alias("split_idx"),
        F.when(r <= t, t).when(r <= h, h - t).otherwise(F.col("__n") - h).cast("bigint").alias("split_n"),
    )
    return out


def split_authors_sql(source: str, author_col: str = "author", seed: int = 42, holdout: float = 0.4,
                      test_of_holdout: float = 0.5) -> str:
    """DuckDB twin of ``split_authors`` over the relation ``source``."""
    from quillspark.functions import key_sql
    k = key_sql(seed, "split", f"@{author_col}")
    return f"""
    SELECT {author_col},
      CASE WHEN r <= t THEN 'test' WHEN r <= h THEN 'validation' ELSE 'train' END AS split,
      CAST(CASE WHEN r <= t THEN r - 1 WHEN r <= h THEN r - 1 - t ELSE r - 1 - h END AS BIGINT) AS split_idx,
      CAST(CASE WHEN r <= t THEN t WHEN r <= h THEN h - t ELSE n - h END AS BIGINT) AS split_n
    FROM (
      SELECT {author_col}, r, n, h, CAST(ceil(CAST({float(test_of_holdout)!r} AS DOUBLE) * CAST(h AS DOUBLE)) AS BIGINT) AS t
      FROM (
        SELECT {author_col}, r, n, CAST(ceil(CAST({float(holdout)!r} AS DOUBLE) * CAST(n AS DOUBLE)) AS BIGINT) AS h
        FROM (
          SELECT {author_col}, row_number() OVER (ORDER BY k, {author_col}) AS r, count(*) OVER () AS n
          FROM (SELECT DISTINCT {author_col}, {k} AS k FROM ({source}) s0) s1
        ) s2
      ) s3
    ) s4"""


def split_stratified(df: DataFrame, author_col: str = "author", id_col: str = "post_id",
                     shares: Sequence[float] = (0.6, 0.2, 0.2), names: Sequence[str] = SPLIT_NAMES,
                     seed: int = 42) -> DataFrame:
    """split rows so that each author has the same shares in every part.

    Inside an author, rows are ordered by a keyed draw; part i takes the
    positions [floor(n*c_{i-1}), floor(n*c_i)) with c the cumulative shares.
    The per-author ordinal is skew-safe (a hot author spans many tasks).
    """
    if len(shares) != len(names) or not math.isclose(sum(shares), 1.0):
        raise ValueError("shares must sum to 1 and match names")
    k = df.withColumn("__k", key(seed, "strat", F.col(id_col)))
    ordd = ordinal_in_group(k, [author_col], ["__k", id_col], col="__o")
    n = df.groupBy(author_col).agg(F.count(F.lit(1)).cast("bigint").alias("__n"))
    j = ordd.join(n, author_col)
    cum = 0.0
    expr = None
    for share, name in zip(shares, names):
        cum += share
        bound = F.floor(F.col("__n").cast("double") * F.lit(min(cum, 1.0))) if name != names[-1] else F.col("__n")
        cond = F.col("__o") < bound
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return j.withColumn("split", expr).drop("__k", "__o", "__n")


def split_whole(df: DataFrame, unit_col: str, shares: Sequence[float] = (0.6, 0.2, 0.2), names: Sequence[str] = SPLIT_NAMES,
                seed: int = 42) -> DataFrame:
    """Whole units (authors, topics, genres) go to one part, parts as near their shares of rows as whole units allow.

    Units are put in keyed order and laid end to end by their numbers of rows; a unit belongs to the part that holds its middle
    row. Sizes are one row a unit, their running sum is skew-safe, and the rows get their part by an equi join on the unit.
    Rows without a unit (null) are a unit of their own."""
    from quillspark.operators.ranking import prefix_sums
    if len(shares) != len(names) or not math.isclose(sum(shares), 1.0):
        raise ValueError("shares must sum to 1 and match names")
    u = F.col(unit_col)
    size = df.groupBy(u.alias("__u")).agg(F.count(F.lit(1)).cast("bigint").alias("n")).withColumn("__k", key(seed, "whole", F.col("__u"))).withColumn("__all", F.lit(0))
    laid = prefix_sums(size, ["__all"], ["__k", F.col("__u")], ["n"], inclusive=False)
    total = size.agg(F.sum("n").alias("__n"))
    middle = (2 * F.col("cum_n") + F.col("n")).cast("double") / (2 * F.col("__n")).cast("double")
    part, cum = F, 0.0
    for share, name in zip(shares[:-1], names[:-1]):
        cum += share
        part = part.when(middle < F.lit(cum), F.lit(name))
    units = laid.crossJoin(F.broadcast(total)).select("__u", part.otherwise(F.lit(names[-1])).alias("split"))
    return df.join(units, u.eqNullSafe(F.col("__u"))).drop("__u")


def split_whole_sql(source: str, unit_col: str, shares: Sequence[float] = (0.6, 0.2, 0.2), names: Sequence[str] = SPLIT_NAMES, seed: int = 42) -> str:
    """DuckDB twin of ``split_whole``: the relation with a split column."""
    from quillspark.functions import key_sql
    cum, cases = 0.0, []
    for share, name in zip(shares[:-1], names[:-1]):
        cum += share
        cases.append(f"WHEN middle < CAST({cum!r} AS DOUBLE) THEN '{name}'")
    return f"""SELECT s.*, u.split FROM ({source}) s JOIN (
      SELECT {unit_col}, CASE {' '.join(cases)} ELSE '{names[-1]}' END AS split FROM (
        SELECT {unit_col}, CAST(2 * sum(n) OVER (ORDER BY k, {unit_col}) - n AS DOUBLE) / CAST(2 * sum(n) OVER () AS DOUBLE) AS middle
        FROM (SELECT {unit_col}, count(*) AS n, {key_sql(seed, 'whole', '@' + unit_col)} AS k FROM ({source}) s0 GROUP BY {unit_col}) s1) s2) u
      ON s.{unit_col} IS NOT DISTINCT FROM u.{unit_col}"""


def split_bernoulli(df: DataFrame, id_col: str, share: float = 0.2, seed: int = 42,
                    names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """independent draw per row: ``share`` of rows go to the second part."""
    u = key(seed, "bern", F.col(id_col)) % 1000000
    return df.withColumn("split", F.when(u < int(round(share * 1000000)), names[1]).otherwise(names[0]))


def sample_rows(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """n rows without replacement, the first in keyed order. Counts of key buckets give the threshold first, so
    n rows never meet in one task."""
    from quillspark.operators.ranking import first_by_key
    return first_by_key(df, [], key(seed, "sample", F.col(id_col)), [id_col], n)
