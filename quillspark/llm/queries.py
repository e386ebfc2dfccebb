"""One query per operator, over whole tables with production parameters, and DuckDB twins where SQL can say it.

A query takes (spark, sf_dir). The operators keep their own general outputs;
the queries derive the digest columns from them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.keys import key, key_sql
from quillspark.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(f):
        def query(spark, sf_dir):
            ensure_checkpoint_dir(spark)
            return f(spark, sf_dir)

        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return f
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op4_sentencepiece")
def op4(spark, sf_dir):
    from quillspark.llm import sp_codec
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sp_codec.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"], ids=False, decoded=False)


# --- operator 10 -----------------------------------------------------------
# The tables hold one copy of the pages, so the second replica is derived from
# it: records drawn by key (3 in 100) have a character changed, lose their last
# five characters, or are lost.

def _merkle_levels() -> str:
    up = []
    for k in range(1, 6):
        for s in "ab":
            up.append(f"""{s}{k} AS (SELECT node // 64 AS node, sha256(string_agg(hash, '' ORDER BY node)) AS hash
                FROM {s}{k - 1} GROUP BY node // 64)""")
    return ",\n".join(up)


OP10_SQL = f"""
WITH r AS (SELECT page_id, {key_sql('op10', 'damage', '@page_id')} % 100 AS d,
        'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
        || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
        || chr(13) || chr(10) || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR)
        || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS a FROM pages),
c AS (SELECT *, CASE WHEN d = 0 THEN substr(a, 1, CAST(length(a) // 2 AS BIGINT) - 1)
        || CASE WHEN substr(a, CAST(length(a) // 2 AS BIGINT), 1) = 'x' THEN 'y' ELSE 'x' END || substr(a, CAST(length(a) // 2 AS BIGINT) + 1)
        WHEN d = 1 THEN substr(a, 1, length(a) - 5) WHEN d = 2 THEN NULL ELSE a END AS b FROM r),
h AS (SELECT page_id, sha256(a) AS da, CAST(strlen(a) AS BIGINT) AS la, sha256(b) AS db, CAST(strlen(b) AS BIGINT) AS lb FROM c),
p AS (SELECT *, row_number() OVER w - 1 AS node, CAST(coalesce(sum(la) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS lo
        FROM h WINDOW w AS (ORDER BY page_id NULLS FIRST, da)),
a0 AS (SELECT node, sha256(concat_ws(':', lo, la, da)) AS hash FROM p),
b0 AS (SELECT node, sha256(concat_ws(':', lo, lb, db)) AS hash FROM p WHERE db IS NOT NULL),
{_merkle_levels()}
SELECT page_id, CAST(node AS BIGINT) AS ordinal, lo AS record_offset, la AS length,
    CASE WHEN db IS NULL THEN 'missing' WHEN la <> lb THEN 'resized' ELSE 'changed' END AS status,
    da AS digest_a, db AS digest_b, (SELECT hash FROM a5) AS root_a, (SELECT hash FROM b5) AS root_b
FROM p WHERE db IS NULL OR da <> db
"""


@register("op10_merkle_audit", OP10_SQL)
def op10(spark, sf_dir):
    from quillspark.llm import merkle
    record = merkle.warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    changed = F.expr("concat(substring(record, 1, length(record) div 2 - 1), "
                     "if(substring(record, length(record) div 2, 1) = 'x', 'y', 'x'), substring(record, length(record) div 2 + 1))")
    damage = key("op10", "damage", F.col("page_id")) % 100
    replica = (F.when(damage == 0, changed).when(damage == 1, F.expr("substring(record, 1, length(record) - 5)"))
               .when(damage == 2, F.lit(None).cast("string")).otherwise(F.col("record")))
    pages = table(spark, sf_dir, "pages").select("page_id", record.alias("record"))
    return merkle.audit_replicas(pages, "page_id", F.col("record"), replica).withColumnRenamed("record_id", "page_id")


@register("op9_quality_rules")
def op9(spark, sf_dir):
    from quillspark.llm import ngram_rules
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").where((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id")
    return ngram_rules.apply_rules(docs, good)


def remainder(n: int, col: str = "doc_id"):
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


@register("op5_kernel_quality")
def op5(spark, sf_dir):
    from quillspark.llm import kernel_quality
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return kernel_quality.classify(docs, labels, remainder(3) != 1)


@register("op3_substring_dedup")
def op3(spark, sf_dir):
    from quillspark.llm import gear_dedup
    report = gear_dedup.dedup_report(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.array_join(F.transform("removed", lambda r: F.concat_ws(":", r["start"], r["stop"])), ",")
    return report.select("doc_id", "n_words", "n_chunks", "n_repeat_words", "repeats_across", "n_removed_words", spans.alias("removed"))


@register("op6_byte_cnn_language")
def op6(spark, sf_dir):
    from quillspark.llm import byte_cnn
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = byte_cnn.train(docs, remainder(4) != 2)
    return byte_cnn.predict(docs, net).select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@register("op1_prob_minhash")
def op1(spark, sf_dir):
    from quillspark.llm import prob_minhash
    return prob_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op7_simhash_decontamination")
def op7(spark, sf_dir):
    from quillspark.llm import simhash_decon
    return simhash_decon.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op8_boosted_pii")
def op8(spark, sf_dir):
    from quillspark.llm import boosted_pii
    found = boosted_pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = [F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{name}") for k, name in enumerate(boosted_pii.KINDS)]
    return found.select("doc_id", *count, F.sha2(boosted_pii.spans_text("base"), 256).alias("base_sha256"), boosted_pii.spans_text("spans").alias("spans"))


@register("op2_gru_language_model")
def op2(spark, sf_dir):
    from quillspark.llm import gru_lm
    return gru_lm.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), remainder(7) != 2)


OP11_SQL = """
WITH piece AS (SELECT lang, rid, row_number() OVER () AS pid, unnest(p) AS t FROM (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS rid,
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS p FROM documents)),
numbered AS (SELECT lang, row_number() OVER () AS pid, list_filter(regexp_split_to_array(t, '[ \\t]+'), lambda x: x <> '') AS w FROM piece),
place AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM numbered WHERE len(w) > 0),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM numbered GROUP BY lang),
gram AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM place, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w)),
known AS (SELECT lang, phrase, k, count(*)::BIGINT AS f FROM gram GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM known WHERE k > 1),
inner_part AS (SELECT lang, a AS longer, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT lang, a, w, k, unnest(generate_series(2, k - 1)) AS m FROM cand WHERE k > 2), (SELECT unnest([1, 2, 3, 4]) AS i) WHERE i + m - 1 <= k),
kept AS (SELECT c.* FROM cand c LEFT JOIN (SELECT lang, phrase, max(longer) AS longer FROM inner_part GROUP BY ALL) USING (lang, phrase)
        WHERE coalesce(100 * longer, 0) < 100 * a),
cuts AS (SELECT lang, phrase, a, w, k AS size, unnest(generate_series(1, k - 1)) AS k FROM kept),
scored AS (SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000 * c.a::HUGEINT * t.n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
        FROM cuts c JOIN known x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
        JOIN known y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.size], ' ') JOIN total t ON t.lang = c.lang),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM least QUALIFY rank <= 2000
"""


@register("op11_phrase_mining", OP11_SQL)
def op11(spark, sf_dir):
    from quillspark.llm import phrase_mining
    return phrase_mining.mine_phrases(table(spark, sf_dir, "documents"))


@register("op12_licence_index")
def op12(spark, sf_dir):
    from quillspark.llm import licence_index
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licence_index.scan_licences(docs, keep=["doc_id"], matches=False)


@register("op13_merge_align")
def op13(spark, sf_dir):
    from quillspark.llm import merge_align
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return merge_align.align_texts(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
