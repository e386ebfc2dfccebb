"""Stateless cleaning on a file stream.

The reference has no streaming; its filters (B1-B8, B14) and text functions
(G1-G21) are plain column expressions, so the same code runs on a streaming
DataFrame: new parquet files dropped into a folder are cleaned as they arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspark.functions import text as T
from quillspark.operators import clean

DOCUMENT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def document_stream(spark: SparkSession, folder: str, schema: str = DOCUMENT_SCHEMA, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files is not None:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def clean_posts(docs: DataFrame, languages=None, lo: int = 25, hi: int = 1000) -> DataFrame:
    """posts view columns + B3 (lo < words < hi), B4 (no URLs), B5, G3 masking."""
    p = docs.select(F.col("doc_id").alias("post_id"), F.col("source").alias("author"), F.col("lang").alias("domain"),
                    "text", T.word_count("text").alias("text_length"), T.url_count("text").alias("url_count"))
    p = clean.filter_length_open(p, "text_length", lo, hi)
    p = clean.drop_url_posts(p, "url_count")
    if languages:
        p = clean.keep_languages(p, languages, "domain")
    return p.withColumn("masked", T.mask_urls("text"))


def start_cleaning(spark: SparkSession, folder: str, out: str, checkpoint: str | None = None,
                   languages=None) -> StreamingQuery:
    """Clean new files of ``folder`` into parquet at ``out``; the stream's
    checkpoint goes under the session's shared checkpoint folder by default."""
    from quillspark.session import ensure_checkpoint_dir
    if checkpoint is None:
        checkpoint = ensure_checkpoint_dir(spark).rstrip("/") + "/stream-clean"
    q = (clean_posts(document_stream(spark, folder), languages).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", checkpoint).outputMode("append").start())
    return q
