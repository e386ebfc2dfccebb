"""Corpus pipeline: documents in, cleaned and encoded documents out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``. Each stage works on every
row that its predecessor kept.

1. language: the byte network is fitted on the rows' own labels; rows whose text
   has no letters, or whose best language has a score under MIN_LANGUAGE, go.
   ``lang`` stays as it was.
2. near_dedup: one row of each group of near duplicate texts stays, the one with
   the smallest id (rows without an id come last). Rows are decided by their own
   text: of rows that share an id but not the text each stays or goes by itself.
3. decontaminate: rows with a passage similar to a benchmark item go, other rows
   of their id stay.
4. pii: found personal data is replaced by its kind; n_chars follows the text.
5. encode: piece ids and decoded text, with digests.

Null or odd values: a null text is rejected by the first stage; an empty table
passes through all stages. More columns than those of ``documents`` are dropped.
"""

from __future__ import annotations

import itertools
import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import boosted_pii, byte_cnn, prob_minhash, simhash_decon, sp_codec
from quillspark.session import cut_lineage, ensure_checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_LANGUAGE = 0.26


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = docs.select(*COLUMNS)
    net = byte_cnn.train(docs, F.col("doc_id").isNotNull())
    found = byte_cnn.predict(docs, net, keep=COLUMNS, with_text=True)
    return found.where((F.col("lang_pred") != byte_cnn.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = docs.select(*COLUMNS)
    node, counted = _text_nodes(docs)
    groups = prob_minhash.near_duplicates(docs.select(node.alias("node"), "text"), "node").select("node", "group_id").distinct()
    least = counted.groupBy("node").agg(F.min("doc_id").alias("least"))
    first = F.min(F.struct(F.col("least").isNull().alias("no_id"), "least", "node")).alias("k")
    keep = cut_lineage(least.join(groups, "node").groupBy("group_id").agg(first).select(F.col("k.least").alias("__id"), F.col("k.node").alias("__node")))

    def pick(rows: DataFrame, of: DataFrame, how: str) -> DataFrame:
        return rows.join(of, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("node") == F.col("__node")), how)

    def pairs(rows: DataFrame) -> DataFrame:
        return _small(cut_lineage(rows.select(F.col("doc_id").alias("__id"), F.col("node").alias("__node"))))

    kept = pick(docs.withColumn("node", node), pairs(pick(counted, keep, "left_anti")), "left_anti")
    # rows equal in id and text are one document: one row of it stays
    twice = pairs(pick(counted.where("n > 1"), keep, "left_semi"))
    if twice.isEmpty():
        return kept.select(*COLUMNS)
    once = pick(kept, twice, "left_anti").select(*COLUMNS)
    more = pick(kept, twice, "left_semi")
    return once.union(more.groupBy("node").agg(F.min(F.struct(*COLUMNS)).alias("r")).select(*[F.col(f"r.{c}").alias(c) for c in COLUMNS]))


def _text_nodes(docs: DataFrame) -> tuple[Column, DataFrame]:
    """A 64-bit hash of ``text`` that no two different texts of ``docs`` share (they are told apart by 60 more bits; with
    two that meet the next seed is taken), and the distinct (doc_id, node) with their number of rows n."""
    text = F.coalesce("text", F.lit(""))
    more = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    for seed in itertools.count():
        node = F.xxhash64(F.lit(seed), text)
        counted = cut_lineage(docs.groupBy("doc_id", node.alias("node"), more.alias("more")).agg(F.count(F.lit(1)).alias("n")))
        if counted.groupBy("node").agg(F.min("more").alias("lo"), F.max("more").alias("hi")).where("lo <> hi").isEmpty():
            return node, counted.drop("more")


def _small(ids: DataFrame, limit: int = 500_000) -> DataFrame:
    """Broadcast up to ``limit`` rows of one or two ids (8 MB), a shuffle beyond."""
    return F.broadcast(ids) if ids.count() <= limit else ids


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = docs.select(*COLUMNS)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = cut_lineage(simhash_decon.matches(docs, items).select(F.col("id").alias("__bad"), F.col("stamp").alias("__stamp")).distinct())
    return docs.join(_small(bad), F.col("doc_id").eqNullSafe(F.col("__bad")) & (F.xxhash64("text") == F.col("__stamp")), "left_anti")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    clean = boosted_pii.redact(boosted_pii.find_spans(docs.select(*COLUMNS)))
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sp_codec.encode_texts(docs.select(*COLUMNS), public_tokenizers.path("piece_bpe_32k.model"),
                                 keep=["doc_id", "lang", "source", "n_chars"], ids=True, decoded=False)


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pii", pii), ("encode", encode)]

# The stages fit models and hash with functions that SQL does not have: no twin, tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; between stages rows are written to the shared checkpoint folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
