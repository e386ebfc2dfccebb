"""Set operations and relabelling."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def concat_sets(*dfs: DataFrame) -> DataFrame:
    """Union by name, missing columns as NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def distinct_per_author(df: DataFrame, author_col: str = "author_id", text_col: str = "text",
                        id_col: str | None = None) -> DataFrame:
    """Distinct texts in each author (first id kept when ``id_col`` is given)."""
    if id_col is None:
        return df.dropDuplicates([author_col, text_col])
    return df.groupBy(author_col, text_col).agg(F.min(id_col).alias(id_col))


def distinct_global(df: DataFrame, text_col: str = "text", id_col: str = "text_id") -> DataFrame:
    """Keep only the first occurrence (smallest id) of each text over all authors.

    A min-by aggregate (map-side combine, so a text repeated a million times
    is reduced before the shuffle), not a window over the hot text.
    """
    firsts = df.groupBy(F.xxhash64(text_col).alias("__h"), F.col(text_col)).agg(F.min(id_col).alias(id_col))
    return df.join(firsts.select(id_col), id_col, "left_semi")


def append_new_pairs(first: DataFrame, second: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of ``second`` that are not in ``first`` (by ``cols``), appended."""
    new = second.join(first.select(*cols).distinct(), list(cols), "left_anti")
    return first.unionByName(new)


def set_difference_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """P5: sizes of a EXCEPT b and b EXCEPT a (both 0 means equal sets)."""
    return a.exceptAll(b).agg(F.count(F.lit(1)).cast("bigint").alias("a_minus_b")).crossJoin(
        b.exceptAll(a).agg(F.count(F.lit(1)).cast("bigint").alias("b_minus_a")))


def merge_corpora(c1: DataFrame, c2: DataFrame, n: int, label_col: str = "author_id",
                  id_col: str = "text_id") -> DataFrame:
    """Drop labels 0..n-1 of corpus 1, renumber its other authors n, n+1, ...
    (first-seen order) and put them into corpus 2, replacing corpus 2's authors
    with the same new labels."""
    from quillspark.operators.ranking import dense_ids
    rest1 = c1.filter(F.col(label_col) >= n)
    ids = dense_ids(rest1, [label_col], [id_col], id_col="__new")
    k = ids.agg(F.count(F.lit(1)).alias("__k"))
    moved = rest1.join(ids, label_col).withColumn(label_col, (F.col("__new") + n).cast("bigint")).drop("__new")
    kept = c2.crossJoin(F.broadcast(k)).filter((F.col(label_col) < n) | (F.col(label_col) >= n + F.col("__k"))).drop("__k")
    return kept.withColumn(label_col, F.col(label_col).cast("bigint")).unionByName(moved.select(*kept.columns))


def label_map(first: DataFrame, label_col: str = "author_id", id_col: str = "text_id") -> DataFrame:
    """P7 map: labels of the first file numbered 0.. in first-seen order -> (old, new)."""
    from quillspark.operators.ranking import dense_ids
    return dense_ids(first, [label_col], [id_col], id_col="new").withColumnRenamed(label_col, "old")


def remap_labels(df: DataFrame, mapping: DataFrame, label_col: str = "author_id") -> DataFrame:
    """Replace labels by the dense labels of ``mapping`` (old, new); an unseen label fails."""
    m = mapping.select(F.col("old").alias(label_col), F.col("new").alias("__new"))
    j = df.join(m, label_col, "left")
    err = F.raise_error(F.concat(F.lit("label not in map: "), F.col(label_col).cast("string")))
    return j.withColumn(label_col, F.coalesce(F.col("__new"), err.cast("bigint"))).drop("__new")


def force_singletons_to_train(df: DataFrame, author_col: str = "author", split_col: str = "split") -> DataFrame:
    """Authors with a single text go to train."""
    n = df.groupBy(author_col).agg(F.count(F.lit(1)).alias("__n"))
    return df.join(n, author_col).withColumn(
        split_col, F.when(F.col("__n") == 1, F.lit("train")).otherwise(F.col(split_col))).drop("__n")
