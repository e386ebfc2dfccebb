"""Views that stand in for the reference's corpora on the driver's tables.

``documents`` has no author column, so ``source`` plays the author (20
authors) and, where pair operators need more authors, ``source-doc_id%7``.
Each view has a DuckDB twin (a CTE body) used by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import key, key_sql
from quillspark.functions import text as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str, fine: bool = False) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    author = F.concat_ws("-", F.col("source"), (F.col("doc_id") % 7).cast("string")) if fine else F.col("source")
    return d.select(
        F.col("doc_id").alias("post_id"),
        author.alias("author"),
        F.col("lang").alias("domain"),
        F.col("text"),
        T.word_count("text").alias("text_length"),
        F.col("lang").alias("text_lang"),
        T.url_count("text").alias("url_count"),
    )


def posts_sql(fine: bool = False) -> str:
    author = "concat(source, '-', CAST(doc_id % 7 AS VARCHAR))" if fine else "source"
    return (
        f"SELECT doc_id AS post_id, {author} AS author, lang AS domain, text, "
        f"{T.word_count_sql('text')} AS text_length, lang AS text_lang, {T.url_count_sql('text')} AS url_count "
        f"FROM documents"
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long score table: three models whose probabilities mix a keyed draw with the label.

    dataset = lang, pair_id = doc_id, label = quality. Rows with doc_id % 11 = 0
    are abstentions (prob exactly 0.5).
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    base = d.join(lab, "doc_id")
    models = [("m1", 0.0), ("m2", 0.3), ("m3", 0.6)]
    rows = None
    for name, w in models:
        noise = (key(name, F.col("doc_id")) % 1000) / F.lit(999.0)
        prob = F.when(F.col("doc_id") % 11 == 0, F.lit(0.5)).otherwise(
            F.lit(1.0 - w) * noise + F.lit(w) * F.col("quality").cast("double"))
        part = base.select(
            F.col("lang").alias("dataset"), F.lit(name).alias("model"), F.col("doc_id").alias("pair_id"),
            F.col("quality").cast("int").alias("label"), prob.alias("prob"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def scores_sql() -> str:
    parts = []
    for name, w in [("m1", 0.0), ("m2", 0.3), ("m3", 0.6)]:
        noise = f"(CAST({key_sql(name, '@d.doc_id')} % 1000 AS DOUBLE) / CAST(999.0 AS DOUBLE))"
        prob = (f"CASE WHEN d.doc_id % 11 = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST({1.0 - w!r} AS DOUBLE) * {noise} "
                f"+ CAST({w!r} AS DOUBLE) * CAST(l.quality AS DOUBLE) END")
        parts.append(
            f"SELECT d.lang AS dataset, '{name}' AS model, d.doc_id AS pair_id, CAST(l.quality AS INTEGER) AS label, "
            f"{prob} AS prob FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
    return " UNION ALL ".join(parts)


def vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("text_id"), F.col("label").cast("bigint").alias("author_id"), "embedding")


def vec_sql() -> str:
    return "SELECT vec_id AS text_id, CAST(label AS BIGINT) AS author_id, embedding FROM embeddings"
