"""Registered queries: scalar text functions (G*), filters (B*) and the domain join."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import key, key_sql
from quillspark.functions import text as T
from quillspark.operators import clean, joins
from quillspark.plans import sql_twins as Q
from quillspark.plans.registry import register
from quillspark.sources import views


def _docs(spark, sf_dir):
    return views.table(spark, sf_dir, "documents")


def _doc_fn(name, spark_fn, sql_fn, out, table="documents", id_col="doc_id", src="text"):
    sql = f"SELECT {id_col}, {sql_fn(src)} AS {out} FROM {table}"

    @register(name, sql)
    def q(spark, sf_dir):
        return views.table(spark, sf_dir, table).select(id_col, spark_fn(src).alias(out))
    return q


# Counts --------------------------------------------------------
_doc_fn("word_count", T.word_count, T.word_count_sql, "text_length")
_doc_fn("url_count", T.url_count, lambda s: T.url_count_sql(s), "url_count", table="pages", id_col="page_id", src="html")
_doc_fn("non_space_chars", T.non_space_chars, T.non_space_chars_sql, "n_chars_no_space")
# Rewrites (md5 of the result keeps the compared rows short)
_doc_fn("mask_tweet", lambda s: T.mask_tweet(s), T.mask_tweet_sql, "text")
_doc_fn("digits_to_zero", lambda s: F.md5(T.digits_to_zero(s)), lambda s: f"md5({T.digits_to_zero_sql(s)})", "h")
_doc_fn("mask_letters", T.mask_letters, T.mask_letters_sql, "text")
_doc_fn("keep_alnum_space", lambda s: F.md5(T.keep_alnum_space(s)), lambda s: f"md5({T.keep_alnum_space_sql(s)})", "h")
_doc_fn("escape_separator", lambda s: F.md5(T.escape_separator(s)), lambda s: f"md5({T.escape_separator_sql(s)})", "h")
# Token and sentence arrays (compared as size + joined string)
_doc_fn("tokenize", lambda s: F.array_join(T.tokenize(s), " "), lambda s: f"array_to_string({T.tokenize_sql(s)}, ' ')", "tokens")
_doc_fn("sentences", lambda s: F.array_join(T.tokenized_sentences(s), "\n"),
        lambda s: f"array_to_string({T.tokenized_sentences_sql(s)}, chr(10))", "sentences")


@register("mask_urls", f"SELECT page_id, md5({T.mask_urls_sql("concat_ws(' ', url, html)")}) AS h FROM pages")
def q_mask_urls(spark, sf_dir):
    p = views.table(spark, sf_dir, "pages")
    return p.select("page_id", F.md5(T.mask_urls(F.concat_ws(" ", "url", "html"))).alias("h"))


# Random window -----------------------------------------------------------
@register("random_window", f"SELECT doc_id, {T.random_window_sql('text', 256, key_sql(42, 'win', '@doc_id'))} AS text FROM documents")
def q_random_window(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.random_window("text", 256, key(42, "win", F.col("doc_id"))).alias("text"))


# Fixed windows (first k windows of n chars) ------------------------------
WIN_N, WIN_K = 512, 4


@register("fixed_windows", f"""
    SELECT doc_id, CAST(w AS BIGINT) AS pos, substr(text, CAST(w * {WIN_N} + 1 AS BIGINT), {WIN_N}) AS chunk
    FROM documents, range(0, {WIN_K}) r(w) WHERE w * {WIN_N} < length(text)""")
def q_fixed_windows(spark, sf_dir):
    from quillspark.operators.windows import fixed_windows
    return fixed_windows(_docs(spark, sf_dir), "text", WIN_N, WIN_K, id_col="doc_id")


@register("fixed_windows_all", f"""
    SELECT doc_id, CAST(w AS BIGINT) AS pos, substr(text, CAST(w * {WIN_N} + 1 AS BIGINT), {WIN_N}) AS chunk
    FROM (SELECT doc_id, text, unnest(generate_series(0, (length(text) - 1) // {WIN_N})) AS w FROM documents WHERE length(text) > 0) x""")
def q_fixed_windows_all(spark, sf_dir):
    """G17 without its prefix option: every window of every text."""
    from quillspark.operators.windows import fixed_windows
    return fixed_windows(_docs(spark, sf_dir), "text", WIN_N, None, id_col="doc_id")


# Token windows with a stride ----------------------------------------------
TW_LEN, TW_STRIDE = 64, 32


@register("token_windows", f"""
    WITH t AS (SELECT doc_id, {T.tokenize_sql('text')} AS toks FROM documents)
    SELECT doc_id, CAST(s AS BIGINT) AS pos, array_to_string(toks[s * {TW_STRIDE} + 1 : s * {TW_STRIDE} + {TW_LEN}], ' ') AS window
    FROM t, range(0, 100000) r(s)
    WHERE s * {TW_STRIDE} < greatest(len(toks) - {TW_LEN - TW_STRIDE}, 1) AND (s = 0 OR s * {TW_STRIDE} < len(toks))""")
def q_token_windows(spark, sf_dir):
    from quillspark.operators.windows import token_windows
    d = _docs(spark, sf_dir).select("doc_id", T.tokenize("text").alias("toks"))
    return token_windows(d, "toks", TW_LEN, TW_STRIDE, id_col="doc_id")


# Prompts and chat rows over consecutive conversation turns ----------
PROMPT = "Text A: {text_a}\nText B: {text_b}\nSame author? Answer yes or no."


def _turn_pairs(spark, sf_dir):
    c = views.table(spark, sf_dir, "conversations")
    a = c.select("conv_id", "turn", F.col("text").alias("text_a"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("text_b"))
    return a.join(b, ["conv_id", "turn"])


_TURN_SQL = ("SELECT a.conv_id, a.turn, a.text AS text_a, b.text AS text_b FROM conversations a "
             "JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1")


@register("render_prompt", f"SELECT conv_id, turn, {T.render_prompt_sql(PROMPT, 'text_a', 'text_b')} AS prompt FROM ({_TURN_SQL}) x")
def q_render_prompt(spark, sf_dir):
    return _turn_pairs(spark, sf_dir).select("conv_id", "turn", T.render_prompt(PROMPT, "text_a", "text_b").alias("prompt"))


@register("to_chat", f"""
    SELECT conv_id, turn, CAST(0 AS BIGINT) AS msg, 'user' AS role, {T.render_prompt_sql(PROMPT, 'text_a', 'text_b')} AS content FROM ({_TURN_SQL}) x
    UNION ALL
    SELECT conv_id, turn, CAST(1 AS BIGINT) AS msg, 'assistant' AS role,
           CASE WHEN conv_id % 2 = 0 THEN 'Ja' ELSE 'Nein' END AS content FROM ({_TURN_SQL}) y""")
def q_to_chat(spark, sf_dir):
    from quillspark.operators.prompts import to_chat
    p = _turn_pairs(spark, sf_dir).withColumn("label", F.col("conv_id") % 2 == 0)
    chat = to_chat(p, PROMPT, "text_a", "text_b", "label")
    return chat.select("conv_id", "turn", F.posexplode("messages").alias("msg", "m")).select(
        "conv_id", "turn", F.col("msg").cast("bigint").alias("msg"), F.col("m.role").alias("role"),
        F.col("m.content").alias("content"))


# B1-B16 -------------------------------------------------------------------------
@register("drop_types", "SELECT event_id, event_type FROM events WHERE event_type IS NULL OR event_type NOT IN ('error', 'signup')")
def q_drop_types(spark, sf_dir):
    e = views.table(spark, sf_dir, "events").select("event_id", "event_type")
    return clean.drop_types(e, "event_type", ("error", "signup"))


@register("filter_words_chars", f"""
    SELECT doc_id, t AS text FROM (SELECT doc_id, {T.strip_sql('text')} AS t FROM documents) x
    WHERE {T.word_count_sql('t')} >= 25 AND length(t) <= 300""")
def q_filter_words_chars(spark, sf_dir):
    return clean.filter_words_chars(_docs(spark, sf_dir).select("doc_id", "text"), "text", 25, 300)


@register("filter_length_open", f"SELECT post_id, text_length FROM ({views.posts_sql()}) p WHERE text_length > 25 AND text_length < 1000")
def q_filter_length_open(spark, sf_dir):
    return clean.filter_length_open(views.posts(spark, sf_dir), "text_length", 25, 1000).select("post_id", "text_length")


@register("drop_url_posts", f"SELECT page_id FROM pages WHERE {T.url_count_sql('html')} = 0")
def q_drop_url_posts(spark, sf_dir):
    p = views.table(spark, sf_dir, "pages").select("page_id", T.url_count("html").alias("url_count"))
    return clean.drop_url_posts(p, "url_count").select("page_id")


@register("keep_languages", f"SELECT post_id, text_lang FROM ({views.posts_sql()}) p WHERE text_lang IN ('de', 'fr')")
def q_keep_languages(spark, sf_dir):
    return clean.keep_languages(views.posts(spark, sf_dir), ["de", "fr"], "text_lang").select("post_id", "text_lang")


_BOT_SQL = " OR ".join(f"coalesce(contains(author, '{p}'), false)" for p in (*clean.BOT_PATTERNS, *clean.FORUM_BOT_NAMES))


@register("drop_bot_users", f"SELECT post_id, author FROM ({views.posts_sql(True)}) p WHERE NOT ({_BOT_SQL})")
def q_drop_bot_users(spark, sf_dir):
    p = views.posts(spark, sf_dir, fine=True)
    return clean.drop_bot_users(p, "author", clean.FORUM_BOT_NAMES).select("post_id", "author")


# C1 + B7: lang -> domain cluster (small fixed dimension, broadcast), unknown dropped
DOMAIN_MAP = {"Germanic": ["EN", "De"], "Romance": ["fr"]}


@register("assign_domain", f"""
    SELECT doc_id, coalesce(m.cluster, 'unknown') AS domain FROM documents d LEFT JOIN
    (SELECT * FROM (VALUES ('en', 'Germanic'), ('de', 'Germanic'), ('fr', 'Romance')) v(key, cluster)) m ON lower(d.lang) = m.key""")
def q_assign_domain(spark, sf_dir):
    m = joins.domain_map_from_dict(spark, DOMAIN_MAP)
    return joins.assign_domain(_docs(spark, sf_dir), m, "lang").select("doc_id", "domain")


@register("drop_unknown_domain", f"""
    SELECT doc_id, m.cluster AS domain FROM documents d JOIN
    (SELECT * FROM (VALUES ('en', 'Germanic'), ('de', 'Germanic'), ('fr', 'Romance')) v(key, cluster)) m ON lower(d.lang) = m.key""")
def q_drop_unknown_domain(spark, sf_dir):
    m = joins.domain_map_from_dict(spark, DOMAIN_MAP)
    return clean.drop_unknown_domain(joins.assign_domain(_docs(spark, sf_dir), m, "lang"), "domain").select("doc_id", "domain")


@register("strip_nul_and_short", "SELECT doc_id, md5(replace(text, chr(0), '')) AS h FROM documents WHERE length(text) > 50")
def q_strip_nul(spark, sf_dir):
    d = clean.strip_nul_and_short(_docs(spark, sf_dir).select("doc_id", "text"), ["text"], 50)
    return d.select("doc_id", F.md5("text").alias("h"))


@register("truncate_text", "SELECT doc_id, substr(text, 1, 1000) AS text FROM documents")
def q_truncate(spark, sf_dir):
    return clean.truncate_text(_docs(spark, sf_dir).select("doc_id", "text"), ["text"], 1000)


@register("filter_author_size", f"""
    SELECT post_id, author FROM ({views.posts_sql(True)}) p
    WHERE author IN (SELECT author FROM ({views.posts_sql(True)}) q GROUP BY author HAVING count(*) >= 7 AND count(*) <= 8)""")
def q_filter_author_size(spark, sf_dir):
    return clean.filter_author_size(views.posts(spark, sf_dir, True), "author", 7, 8).select("post_id", "author")


@register("route_topics", "SELECT doc_id, CASE WHEN lang = 'en' THEN 'in_distribution' WHEN lang IN ('de', 'fr') THEN 'cross_topic' "
          "WHEN lang = 'es' THEN 'cross_genre' END AS route FROM documents")
def q_route_topics(spark, sf_dir):
    return clean.route_topics(_docs(spark, sf_dir), "lang", ["en"], ["de", "fr"], ["es"]).select("doc_id", "route")


@register("min_words", f"SELECT doc_id FROM documents WHERE {T.word_count_sql('text')} >= 101")
def q_min_words(spark, sf_dir):
    return clean.min_words(_docs(spark, sf_dir), "text", 101).select("doc_id")


# Pair-based filters over the in-domain pairs ----------------------------------------
_PAIRS_SQL = Q.pairs_by_domain_sql(Q.forum_posts_sql(True), "in_domain")


def _pairs_with_text(spark, sf_dir):
    from quillspark.plans.catalog import q_pairs_in_domain
    p = q_pairs_in_domain(spark, sf_dir)
    d = _docs(spark, sf_dir)
    return (p.join(d.select(F.col("doc_id").alias("post_id_a"), F.col("text").alias("text0")), "post_id_a")
            .join(d.select(F.col("doc_id").alias("post_id_b"), F.col("text").alias("text1")), "post_id_b"))


_PAIRS_TEXT_SQL = (f"SELECT x.*, a.text AS text0, b.text AS text1 FROM ({_PAIRS_SQL}) x "
                   "JOIN documents a ON a.doc_id = x.post_id_a JOIN documents b ON b.doc_id = x.post_id_b")


@register("drop_short_pairs", f"""
    SELECT split, post_id_a, post_id_b, label FROM ({_PAIRS_TEXT_SQL}) y
    WHERE coalesce(length(text0), 0) >= 1000 AND coalesce(length(text1), 0) >= 1000""")
def q_drop_short_pairs(spark, sf_dir):
    p = clean.drop_short_pairs(_pairs_with_text(spark, sf_dir), ["text0", "text1"], 1000)
    return p.select("split", "post_id_a", "post_id_b", "label")


@register("normalize_pair_labels", f"""
    SELECT post_id_a, post_id_b, CAST(CASE WHEN author_a = author_b THEN 1 ELSE -1 END AS INTEGER) AS y FROM ({_PAIRS_SQL}) x""")
def q_normalize_pair_labels(spark, sf_dir):
    from quillspark.plans.catalog import q_pairs_in_domain
    p = q_pairs_in_domain(spark, sf_dir)
    return clean.normalize_pair_labels(p, "author_a", "author_b", "y", signed=True).select("post_id_a", "post_id_b", "y")


@register("select_subset", f"""
    SELECT post_id_a, post_id_b, label FROM ({_PAIRS_SQL}) x ORDER BY post_id_a, post_id_b, label LIMIT 100""")
def q_select_subset(spark, sf_dir):
    from quillspark.plans.catalog import q_pairs_in_domain
    p = q_pairs_in_domain(spark, sf_dir).select("post_id_a", "post_id_b", "label")
    return clean.select_subset(p, 100, ["post_id_a", "post_id_b", "label"])
