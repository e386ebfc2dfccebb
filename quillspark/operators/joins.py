"""Joins used across the library.

Dimension tables are broadcast only when their size is bounded by
construction (the domain map is a fixed list of clusters); everything else is
left to Catalyst / AQE (sort-merge or shuffled hash join, skew splitting).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Broadcast threshold for dimension tables whose size is only known at run time.
MAX_BROADCAST_ROWS = 1_000_000


def domain_map_from_dict(spark: SparkSession, clusters: Mapping[str, Sequence[str]]) -> DataFrame:
    """(key lower-cased, cluster) rows from {cluster: [names]}."""
    rows = [(name.lower(), cluster) for cluster, names in clusters.items() for name in names]
    return spark.createDataFrame(rows, "key string, cluster string").dropDuplicates(["key"])


def read_domain_map(spark: SparkSession, path: str) -> DataFrame:
    """Cluster JSON ([{cluster, description, subreddits: [...]}, ...]) -> (key, cluster)."""
    j = spark.read.option("multiLine", True).schema(
        "cluster string, description string, subreddits array<string>").json(path)
    return j.select(F.lower(F.explode("subreddits")).alias("key"), "cluster").dropDuplicates(["key"])


def assign_domain(df: DataFrame, domain_map: DataFrame, col: str = "subreddit", out: str = "domain") -> DataFrame:
    """Name -> cluster, lower-cased, missing = 'unknown'. Adaptive execution
    broadcasts the map if its bytes allow that, and splits hot names if not."""
    m = domain_map.select(F.col("key").alias("__key"), F.col("cluster").alias("__cluster"))
    j = df.join(m, F.lower(F.col(col)) == F.col("__key"), "left")
    return j.withColumn(out, F.coalesce(F.col("__cluster"), F.lit("unknown"))).drop("__key", "__cluster")


def align_answers(truth: DataFrame, answers: DataFrame, id_col: str = "id", value_col: str = "value", refuse_extra: bool = True) -> DataFrame:
    """Gold left join answers; a missing answer is 0.5. With ``refuse_extra`` an answer to no gold row fails the job that
    reads the result, naming the id: a full join carries such answers into the plan, no count runs on the driver."""
    a = answers.select(id_col, F.col(value_col).cast("double").alias("__v"))
    if not refuse_extra:
        return truth.join(a, id_col, "left").withColumn(value_col, F.coalesce(F.col("__v"), F.lit(0.5))).drop("__v")
    j = truth.withColumn("__gold", F.lit(True)).join(a, id_col, "full")
    error = F.raise_error(F.concat(F.lit("answer to an unknown id: "), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))).cast("double")
    value = F.when(F.col("__gold").isNull(), error).otherwise(F.coalesce(F.col("__v"), F.lit(0.5)))
    # the filter reads the value, so a plan that leaves the column out still refuses
    return j.withColumn(value_col, value).filter(F.col(value_col).isNotNull()).drop("__v", "__gold")


def extra_answers(truth: DataFrame, answers: DataFrame, id_col: str = "id") -> DataFrame:
    """Answers to no gold row (the check table)."""
    return answers.join(truth.select(id_col), id_col, "left_anti")


def leaked_texts(a: DataFrame, b: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct texts present in both sets (hash first, then the text)."""
    ka = a.select(F.xxhash64(text_col).alias("__h"), F.col(text_col)).distinct()
    kb = b.select(F.xxhash64(text_col).alias("__h"), F.col(text_col)).distinct()
    return ka.join(kb, ["__h", text_col], "left_semi").drop("__h")


def overlapping_keys(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys of ``a`` that are also in ``b``."""
    return a.select(*cols).distinct().join(b.select(*cols).distinct(), list(cols), "left_semi")


def missing_keys(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys of ``a`` not in ``b`` (e.g. test labels never seen in train)."""
    return a.select(*cols).distinct().join(b.select(*cols).distinct(), list(cols), "left_anti")


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join a per-group side table whose size is only known at run time.

    The side table is written once (checkpoint) and counted; it is broadcast
    only if it has at most ``max_rows`` rows, otherwise a shuffle join is
    planned (AQE then splits skewed partitions).
    """
    from quillspark.session import cut_lineage
    small = cut_lineage(small)
    if small.count() <= max_rows:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
