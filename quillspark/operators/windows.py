"""Text windows and chunking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _safe_seq(n):
    """0..n-1, or an empty array when n <= 0 (``sequence`` would count down)."""
    return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), (n - 1).cast("bigint"))).otherwise(
        F.array().cast("array<bigint>"))


def fixed_windows(df: DataFrame, text_col: str, n: int, k: int | None = None, id_col: str = "text_id") -> DataFrame:
    """Cut each text every n chars; keep the first k windows (all if None).

    Output (id, pos, chunk); a text of length 0 or NULL gives no rows.
    """
    ln = F.coalesce(F.length(text_col), F.lit(0)).cast("bigint")
    nw = F.ceil(ln / F.lit(n)).cast("bigint")
    if k is not None:
        nw = F.least(nw, F.lit(k).cast("bigint"))
    ex = df.select(id_col, text_col, F.explode(_safe_seq(nw)).alias("pos"))
    return ex.select(id_col, F.col("pos").cast("bigint").alias("pos"),
                     F.col(text_col).substr((F.col("pos") * n + 1).cast("int"), F.lit(n)).alias("chunk"))


def token_windows(df: DataFrame, tokens_col: str, max_len: int, stride: int, id_col: str = "text_id") -> DataFrame:
    """Overlapping token windows of ``max_len`` starting every ``stride``
    tokens until the end is covered; at least one window per text."""
    ln = F.size(tokens_col).cast("bigint")
    nw = F.greatest(F.lit(1).cast("bigint"), F.ceil((ln - max_len + stride) / F.lit(stride)).cast("bigint"))
    ex = df.select(id_col, tokens_col, F.explode(F.sequence(F.lit(0).cast("bigint"), nw - 1)).alias("pos"))
    return ex.select(id_col, F.col("pos").cast("bigint").alias("pos"),
                     F.array_join(F.slice(tokens_col, (F.col("pos") * stride + 1).cast("int"), F.lit(max_len)), " ").alias("window"))


def pairs_from_blocks(pairs: DataFrame, n: int = 1280, id_col: str = "pair_id", a: str = "text0",
                      b: str = "text1") -> DataFrame:
    """F16: chunk i of text0 with chunk i of text1, up to the shorter text."""
    la = F.ceil(F.coalesce(F.length(a), F.lit(0)) / F.lit(n)).cast("bigint")
    lb = F.ceil(F.coalesce(F.length(b), F.lit(0)) / F.lit(n)).cast("bigint")
    ex = pairs.select("*", F.explode(_safe_seq(F.least(la, lb))).alias("pos"))
    return ex.select(id_col, F.col("pos").cast("bigint").alias("pos"),
                     F.col(a).substr((F.col("pos") * n + 1).cast("int"), F.lit(n)).alias("chunk0"),
                     F.col(b).substr((F.col("pos") * n + 1).cast("int"), F.lit(n)).alias("chunk1"),
                     *[c for c in pairs.columns if c not in (id_col, a, b)])
