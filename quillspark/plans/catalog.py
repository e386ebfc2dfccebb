"""Query catalog: every registered query as (Spark builder, DuckDB twin).

Each Spark builder takes (spark, sf_dir) and returns a DataFrame over the
driver's tables; the twin is SQL over the same tables (pre-registered views
``documents``, ``labels``, ...). Column names and types agree on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import clean, pairs
from quillspark.plans import sql_twins as Q
from quillspark.sources import views

from quillspark.plans.registry import QUERIES, SQL, register  # noqa: F401


def forum_posts(spark: SparkSession, sf_dir: str, fine: bool = True) -> DataFrame:
    """posts -> B3 -> B10, id columns only (texts are joined back by id when needed).

    The per-text counts are computed in one pass and written once, so the
    length filter and the author-size aggregate read integers instead of
    re-running the word regex in every branch."""
    from quillspark.session import cut_lineage
    p = cut_lineage(views.posts(spark, sf_dir, fine=fine).select("post_id", "author", "domain", "text_length", "url_count"))
    p = clean.filter_length_open(p, "text_length", 25, 1000)
    return clean.filter_author_size(p, "author", 2, 1000)


# --- slice 1: posts -> B3, B10 -> F1 -> F6 ---------------------------------

@register("pairs_in_domain", Q.pairs_by_domain_sql(Q.forum_posts_sql(True), "in_domain"))
def q_pairs_in_domain(spark, sf_dir):
    return pairs.pairs_in_domain(forum_posts(spark, sf_dir))


@register("pairs_cross_domain", Q.pairs_by_domain_sql(Q.forum_posts_sql(True), "cross_domain"))
def q_pairs_cross_domain(spark, sf_dir):
    return pairs.pairs_cross_domain(forum_posts(spark, sf_dir))


def _five_positives(spark, sf_dir, mode):
    indexed, _ = pairs.indexed_posts(forum_posts(spark, sf_dir))
    return pairs.positive_pairs_by_domain(indexed, mode, 5)


@register("positive_pairs_in_domain", Q.positives_by_domain_sql(Q.forum_posts_sql(True), "in_domain", 5))
def q_positive_pairs_in_domain(spark, sf_dir):
    """F6 with up to five positives per user."""
    return _five_positives(spark, sf_dir, "in_domain")


@register("positive_pairs_cross_domain", Q.positives_by_domain_sql(Q.forum_posts_sql(True), "cross_domain", 5))
def q_positive_pairs_cross_domain(spark, sf_dir):
    """F6 across domains with up to five positives per user."""
    return _five_positives(spark, sf_dir, "cross_domain")


@register("pair_counts_in_domain", f"""
    SELECT split, label, CAST(count(*) AS BIGINT) AS n_pairs
    FROM ({Q.pairs_by_domain_sql(Q.forum_posts_sql(True), 'in_domain')}) x GROUP BY split, label""")
def q_pair_counts(spark, sf_dir):
    return q_pairs_in_domain(spark, sf_dir).groupBy("split", "label").agg(F.count(F.lit(1)).cast("bigint").alias("n_pairs"))


# Area modules register themselves on import.
from quillspark.plans import q_text, q_corpus, q_metrics, q_features, q_ppm, q_vectors, q_verdicts, q_text2, q_models  # noqa: E402,F401
