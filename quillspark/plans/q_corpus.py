"""Registered queries: corpus building (splits, pairs, stats, ranks, sets, checks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import key, key_sql
from quillspark.functions import text as T
from quillspark.operators import checks, joins, pairs, rank, sets, splits, stats
from quillspark.operators.ranking import dense_ids
from quillspark.plans import sql_twins as Q
from quillspark.plans.registry import register
from quillspark.sources import views


def aa(spark, sf_dir):
    """AA view: author_id = dense id of documents.source (first seen), text_id, text, lang."""
    d = views.table(spark, sf_dir, "documents")
    ids = dense_ids(d, ["source"], ["doc_id"], id_col="author_id")
    return d.join(ids, "source").select(F.col("author_id").cast("bigint").alias("author_id"),
                                        F.col("doc_id").alias("text_id"), "text", "lang")


AA_SQL = """SELECT CAST(a.id AS BIGINT) AS author_id, d.doc_id AS text_id, d.text, d.lang FROM documents d JOIN
  (SELECT source, row_number() OVER (ORDER BY min(doc_id), source) - 1 AS id FROM documents GROUP BY source) a
  ON d.source = a.source"""


@register("dense_author_ids", f"SELECT text_id, author_id FROM ({AA_SQL}) x")
def q_dense_author_ids(spark, sf_dir):
    return aa(spark, sf_dir).select("text_id", "author_id")


# F1 ------------------------------------------------------------------------
@register("split_authors", splits.split_authors_sql(f"SELECT author FROM ({views.posts_sql(True)}) p"))
def q_split_authors(spark, sf_dir):
    return splits.split_authors(views.posts(spark, sf_dir, True), "author")


# F2 ------------------------------------------------------------------------
_C1, _C2 = 0.6, 0.6 + 0.2


@register("split_whole_authors", splits.split_whole_sql("SELECT post_id, author FROM (" + views.posts_sql(True) + ") p", "author"))
def q_split_whole_authors(spark, sf_dir):
    """A19, unseen authors: every author's posts in one part."""
    return splits.split_whole(views.posts(spark, sf_dir, fine=True).select("post_id", "author"), "author").select("post_id", "author", "split")


@register("cross_topic_corpus", f"""
    WITH s AS ({splits.split_whole_sql(f"SELECT author_id, text_id, lang FROM ({AA_SQL}) a", "lang")}),
    ids AS (SELECT author_id, row_number() OVER (ORDER BY min(text_id), author_id) - 1 AS nid FROM s WHERE split = 'train' GROUP BY author_id)
    SELECT CAST(ids.nid AS BIGINT) AS author_id, s.text_id, s.lang, s.split FROM s JOIN ids ON ids.author_id = s.author_id""")
def q_cross_topic_corpus(spark, sf_dir):
    """A19, cross-topic (languages play topics): topics whole in one part, only authors of the training part, dense labels."""
    from quillspark.sources.io import cross_corpus
    return cross_corpus(aa(spark, sf_dir).select("author_id", "text_id", "lang"), "lang")


@register("split_stratified", f"""
    SELECT post_id, author, CASE WHEN o < floor(CAST(n AS DOUBLE) * {_C1!r}) THEN 'train'
                                 WHEN o < floor(CAST(n AS DOUBLE) * {_C2!r}) THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT post_id, author, row_number() OVER (PARTITION BY author ORDER BY {key_sql(42, 'strat', '@post_id')}, post_id) - 1 AS o,
                 count(*) OVER (PARTITION BY author) AS n FROM ({views.posts_sql()}) p) x""")
def q_split_stratified(spark, sf_dir):
    p = views.posts(spark, sf_dir).select("post_id", "author")
    return splits.split_stratified(p, "author", "post_id", (0.6, 0.2, 0.2)).select("post_id", "author", "split")


# F3, F4 --------------------------------------------------------------------
@register("split_bernoulli", f"""
    SELECT doc_id, CASE WHEN {key_sql(42, 'bern', '@doc_id')} % 1000000 < 200000 THEN 'test' ELSE 'train' END AS split FROM documents""")
def q_split_bernoulli(spark, sf_dir):
    return splits.split_bernoulli(views.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.2)


@register("sample_rows", f"SELECT doc_id, lang FROM documents ORDER BY {key_sql(42, 'sample', '@doc_id')}, doc_id LIMIT 100")
def q_sample_rows(spark, sf_dir):
    return splits.sample_rows(views.table(spark, sf_dir, "documents").select("doc_id", "lang"), 100, "doc_id")


# F5 ------------------------------------------------------------------------
@register("pairs_random", Q.pairs_random_sql(f"SELECT author, post_id FROM ({views.posts_sql(True)}) p"))
def q_pairs_random(spark, sf_dir):
    return pairs.pairs_random(views.posts(spark, sf_dir, True).select("author", "post_id"))


# F9, F10, F11, F13 ------------------------------------------------------------
@register("pairs_per_text", Q.pairs_per_text_sql(AA_SQL, passes=1, mode="both"))
def q_pairs_per_text(spark, sf_dir):
    return pairs.pairs_per_text(aa(spark, sf_dir), "author_id", "text_id")


@register("pairs_coin_flip", Q.pairs_per_text_sql(AA_SQL, passes=1, mode="coin"))
def q_pairs_coin_flip(spark, sf_dir):
    return pairs.pairs_per_text(aa(spark, sf_dir), "author_id", "text_id", mode="coin")


@register("pairs_training_compression", f"""
    SELECT p.pass, p.text_id_a, p.text_id_b, p.label, md5(substr(a.text, 1, 50000)) AS h0, md5(substr(b.text, 1, 50000)) AS h1
    FROM ({Q.pairs_per_text_sql(AA_SQL, passes=2, mode='both')}) p
    JOIN documents a ON a.doc_id = p.text_id_a JOIN documents b ON b.doc_id = p.text_id_b""")
def q_pairs_training_compression(spark, sf_dir):
    d = views.table(spark, sf_dir, "documents")
    p = pairs.pairs_per_text(aa(spark, sf_dir), "author_id", "text_id", passes=2)
    p = p.join(d.select(F.col("doc_id").alias("text_id_a"), F.md5(T.truncate("text", 50000)).alias("h0")), "text_id_a")
    p = p.join(d.select(F.col("doc_id").alias("text_id_b"), F.md5(T.truncate("text", 50000)).alias("h1")), "text_id_b")
    return p.select("pass", "text_id_a", "text_id_b", "label", "h0", "h1")


@register("augment_pairs", f"""
    SELECT DISTINCT text_id_a, author_a, text_id_b, author_b, label FROM ({Q.pairs_per_text_sql(AA_SQL, passes=2, mode='both')}) p""")
def q_augment_pairs(spark, sf_dir):
    return pairs.augment_pairs(aa(spark, sf_dir), "author_id", "text_id")


# F12 -----------------------------------------------------------------------
_IN_SQL = Q.pairs_by_domain_sql(Q.forum_posts_sql(True), "in_domain")
_CROSS_SQL = Q.pairs_by_domain_sql(Q.forum_posts_sql(True), "cross_domain")


def _mix_sql(name, rel, n):
    k = key_sql(42, "mix", name, "@split", "@post_id_a", "@post_id_b", "@label")
    return f"""SELECT split, label, author_a, post_id_a, author_b, post_id_b, slot, anchor, '{name}' AS source FROM (
        SELECT *, row_number() OVER (PARTITION BY split, label ORDER BY {k}, post_id_a, post_id_b) AS rn FROM ({rel}) r) x
        WHERE rn <= {n}"""


@register("mix_pair_sets", f"{_mix_sql('in', _IN_SQL, 20)} UNION ALL {_mix_sql('cross', _CROSS_SQL, 20)}")
def q_mix_pair_sets(spark, sf_dir):
    from quillspark.plans.catalog import forum_posts
    fp = forum_posts(spark, sf_dir)
    return pairs.mix_pair_sets({"in": pairs.pairs_in_domain(fp), "cross": pairs.pairs_cross_domain(fp)}, 20)


# D1, D2, D3, D5, D8 -------------------------------------------------------------
@register("group_texts", f"""
    SELECT author, CAST(count(*) AS BIGINT) AS n_posts, string_agg(CAST(post_id AS VARCHAR), ',' ORDER BY post_id) AS ids
    FROM ({views.posts_sql()}) p GROUP BY author""")
def q_group_texts(spark, sf_dir):
    g = stats.group_texts(views.posts(spark, sf_dir), "author", "post_id", ["domain"])
    return g.select("author", F.size("posts").cast("bigint").alias("n_posts"),
                    F.array_join(F.transform("posts", lambda s: s["post_id"].cast("string")), ",").alias("ids"))


_SPLIT_POSTS_SQL = f"""SELECT p.*, u.split FROM ({views.posts_sql(True)}) p JOIN
    ({splits.split_authors_sql(f"SELECT author FROM ({views.posts_sql(True)}) q")}) u ON p.author = u.author"""


def _split_posts(spark, sf_dir):
    p = views.posts(spark, sf_dir, True)
    return p.join(splits.split_authors(p, "author").select("author", "split"), "author")


@register("summarize_corpus", f"""
    SELECT split, CAST(count(*) AS BIGINT) AS n_authors, CAST(sum(docs) AS BIGINT) AS n_docs, CAST(sum(words) AS BIGINT) AS n_words,
      avg(docs) AS docs_mean, CAST(max(docs) AS BIGINT) AS docs_max, CAST(min(docs) AS BIGINT) AS docs_min,
      CAST(median(docs) AS DOUBLE) AS docs_median, stddev_pop(docs) AS docs_std,
      avg(words) AS words_mean, CAST(max(words) AS BIGINT) AS words_max, CAST(min(words) AS BIGINT) AS words_min,
      CAST(median(words) AS DOUBLE) AS words_median, stddev_pop(words) AS words_std
    FROM (SELECT split, author, count(*) AS docs, sum({T.word_count_sql('text')}) AS words FROM ({_SPLIT_POSTS_SQL}) s GROUP BY split, author) x
    GROUP BY split""")
def q_summarize_corpus(spark, sf_dir):
    return stats.summarize_corpus(_split_posts(spark, sf_dir), "split", "author", "text")


@register("summarize_pairs", f"""
    SELECT split, CAST(count_if(label) AS BIGINT) AS n_pos, CAST(count_if(NOT label) AS BIGINT) AS n_neg FROM ({_IN_SQL}) x GROUP BY split""")
def q_summarize_pairs(spark, sf_dir):
    from quillspark.plans.catalog import q_pairs_in_domain
    return stats.summarize_pairs(q_pairs_in_domain(spark, sf_dir))


@register("distinct_users", "SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS n_users FROM events")
def q_distinct_users(spark, sf_dir):
    return stats.distinct_users(views.table(spark, sf_dir, "events"), "user_id")


@register("duplicate_report", """
    SELECT text, CAST(count(*) AS BIGINT) AS n_copies, CAST(count(DISTINCT source) AS BIGINT) AS n_authors, min(source) AS first_author
    FROM documents GROUP BY text HAVING count(*) > 1""")
def q_duplicate_report(spark, sf_dir):
    return stats.duplicate_report(views.table(spark, sf_dir, "documents"), "source", "text")


@register("duplicate_summary", """
    SELECT CAST(count(*) AS BIGINT) AS dup_texts, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS rows_removed,
           CAST(count_if(a > 1) AS BIGINT) AS shared_texts
    FROM (SELECT text, count(*) AS n, count(DISTINCT source) AS a FROM documents GROUP BY text HAVING count(*) > 1) x""")
def q_duplicate_summary(spark, sf_dir):
    return stats.duplicate_summary(views.table(spark, sf_dir, "documents"), "source", "text")


# E1, E2, E6 ----------------------------------------------------------------------
@register("cap_texts_per_author", f"""
    SELECT author_id, text_id, substr(text, 1, 200) AS text FROM (
      SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY text_id) AS rn FROM ({AA_SQL}) a) x WHERE rn <= 5""")
def q_cap_texts(spark, sf_dir):
    a = aa(spark, sf_dir).select("author_id", "text_id", "text")
    return rank.cap_texts_per_author(a, 5, "author_id", "text_id", "text", 200)


@register("top_authors", f"""
    SELECT author, n_texts, CAST(row_number() OVER (ORDER BY n_texts DESC, author) - 1 AS BIGINT) AS label FROM (
      SELECT author, CAST(count(*) AS BIGINT) AS n_texts FROM ({views.posts_sql(True)}) p GROUP BY author
      ORDER BY n_texts DESC, author LIMIT 10) x""")
def q_top_authors(spark, sf_dir):
    return rank.top_authors(views.posts(spark, sf_dir, True), 10, "author")


@register("split_by_position", f"""
    SELECT post_id, author, CASE WHEN o < 30 THEN 'train' WHEN o < 40 THEN 'validation' ELSE 'test' END AS split FROM (
      SELECT post_id, author, row_number() OVER (PARTITION BY author ORDER BY post_id) - 1 AS o FROM ({views.posts_sql()}) p) x""")
def q_split_by_position(spark, sf_dir):
    p = views.posts(spark, sf_dir).select("post_id", "author")
    return rank.split_by_position(p, "author", "post_id", 30, 10)


# P2-P8 ------------------------------------------------------------------------------
@register("distinct_per_author", f"SELECT author_id, md5(text) AS h, min(text_id) AS text_id FROM ({AA_SQL}) a GROUP BY author_id, text")
def q_distinct_per_author(spark, sf_dir):
    d = sets.distinct_per_author(aa(spark, sf_dir), "author_id", "text", "text_id")
    return d.select("author_id", F.md5("text").alias("h"), "text_id")


@register("distinct_global", f"SELECT text_id, author_id FROM ({AA_SQL}) a WHERE text_id IN (SELECT min(text_id) FROM ({AA_SQL}) b GROUP BY text)")
def q_distinct_global(spark, sf_dir):
    return sets.distinct_global(aa(spark, sf_dir), "text", "text_id").select("text_id", "author_id")


_PPT1 = Q.pairs_per_text_sql(AA_SQL, passes=2, mode="both")


@register("append_new_pairs", f"""
    WITH p AS ({_PPT1}), a AS (SELECT text_id_a, text_id_b, label FROM p WHERE pass = 0),
    b AS (SELECT text_id_a, text_id_b, label FROM p WHERE pass = 1)
    SELECT * FROM a UNION ALL (SELECT * FROM b WHERE (text_id_a, text_id_b, label) NOT IN (SELECT (text_id_a, text_id_b, label) FROM a))""")
def q_append_new_pairs(spark, sf_dir):
    p = pairs.pairs_per_text(aa(spark, sf_dir), "author_id", "text_id", passes=2)
    cols = ["text_id_a", "text_id_b", "label"]
    return sets.append_new_pairs(p.filter("pass = 0").select(*cols), p.filter("pass = 1").select(*cols), cols)


@register("same_text_sets", f"""
    WITH a AS (SELECT text FROM ({AA_SQL}) x), b AS (SELECT d.text FROM ({_PPT1}) p JOIN documents d ON d.doc_id = p.text_id_a)
    SELECT (SELECT CAST(count(*) AS BIGINT) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS a_minus_b,
           (SELECT CAST(count(*) AS BIGINT) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS b_minus_a""")
def q_same_text_sets(spark, sf_dir):
    d = views.table(spark, sf_dir, "documents")
    p = pairs.pairs_per_text(aa(spark, sf_dir), "author_id", "text_id", passes=2)
    b = p.join(d.select(F.col("doc_id").alias("text_id_a"), "text"), "text_id_a").select("text")
    return sets.set_difference_count(aa(spark, sf_dir).select("text"), b)


@register("merge_corpora", f"""
    WITH a AS ({AA_SQL}), c1 AS (SELECT * FROM a WHERE lang IN ('en', 'de') AND author_id >= 5),
    c2 AS (SELECT * FROM a WHERE lang IN ('fr', 'es')),
    ids AS (SELECT author_id, row_number() OVER (ORDER BY min(text_id), author_id) - 1 AS nid FROM c1 GROUP BY author_id),
    k AS (SELECT count(*) AS k FROM ids)
    SELECT CAST(author_id AS BIGINT) AS author_id, text_id FROM c2, k WHERE author_id < 5 OR author_id >= 5 + k.k
    UNION ALL SELECT CAST(ids.nid + 5 AS BIGINT) AS author_id, c1.text_id FROM c1 JOIN ids ON c1.author_id = ids.author_id""")
def q_merge_corpora(spark, sf_dir):
    a = aa(spark, sf_dir).select("author_id", "text_id", "lang")
    c1 = a.filter(F.col("lang").isin("en", "de")).drop("lang")
    c2 = a.filter(F.col("lang").isin("fr", "es")).drop("lang")
    return sets.merge_corpora(c1, c2, 5, "author_id", "text_id")


@register("remap_labels", f"""
    WITH d AS (SELECT doc_id AS text_id, source, lang FROM documents),
    m AS (SELECT source AS old, row_number() OVER (ORDER BY min(text_id), source) - 1 AS new FROM d WHERE lang IN ('en', 'de') GROUP BY source)
    SELECT d.text_id, CAST(m.new AS BIGINT) AS author_id FROM d JOIN m ON d.source = m.old""")
def q_remap_labels(spark, sf_dir):
    d = views.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("text_id"), F.col("source").alias("author_id"), "lang")
    m = sets.label_map(d.filter(F.col("lang").isin("en", "de")), "author_id", "text_id")
    return sets.remap_labels(d, m, "author_id").select("text_id", "author_id")


_LANG_AUTHOR_SQL = "SELECT doc_id AS post_id, concat(source, '-', lang) AS author FROM documents"


@register("force_singletons_to_train", f"""
    WITH p AS ({_LANG_AUTHOR_SQL}),
    s AS (SELECT post_id, author, row_number() OVER (PARTITION BY author ORDER BY {key_sql(42, 'strat', '@post_id')}, post_id) - 1 AS o,
                 count(*) OVER (PARTITION BY author) AS n FROM p)
    SELECT post_id, author, CASE WHEN n = 1 THEN 'train' WHEN o < floor(CAST(n AS DOUBLE) * {_C1!r}) THEN 'train'
      WHEN o < floor(CAST(n AS DOUBLE) * {_C2!r}) THEN 'validation' ELSE 'test' END AS split FROM s""")
def q_force_singletons(spark, sf_dir):
    d = views.table(spark, sf_dir, "documents")
    p = d.select(F.col("doc_id").alias("post_id"), F.concat_ws("-", "source", "lang").alias("author"))
    s = splits.split_stratified(p, "author", "post_id", (0.6, 0.2, 0.2))
    return sets.force_singletons_to_train(s, "author", "split").select("post_id", "author", "split")


# C7, C8, O1 --------------------------------------------------------------------------
_STRAT_SQL = f"""SELECT p.post_id, p.author, p.text, CASE WHEN o < floor(CAST(n AS DOUBLE) * {_C1!r}) THEN 'train'
      WHEN o < floor(CAST(n AS DOUBLE) * {_C2!r}) THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT *, row_number() OVER (PARTITION BY author ORDER BY {key_sql(42, 'strat', '@post_id')}, post_id) - 1 AS o,
                 count(*) OVER (PARTITION BY author) AS n FROM ({views.posts_sql()}) q) p"""


def _strat(spark, sf_dir):
    p = views.posts(spark, sf_dir).select("post_id", "author", "text")
    return splits.split_stratified(p, "author", "post_id", (0.6, 0.2, 0.2))


@register("leaked_texts", f"""
    SELECT DISTINCT md5(a.text) AS h FROM ({_STRAT_SQL}) a WHERE a.split = 'train'
      AND a.text IN (SELECT text FROM ({_STRAT_SQL}) b WHERE b.split = 'test')""")
def q_leaked_texts(spark, sf_dir):
    s = _strat(spark, sf_dir)
    lk = joins.leaked_texts(s.filter("split = 'train'"), s.filter("split = 'test'"), "text")
    return lk.select(F.md5("text").alias("h"))


@register("missing_keys", f"""
    SELECT DISTINCT author FROM ({_SPLIT_POSTS_SQL}) a WHERE split = 'test'
      AND author NOT IN (SELECT author FROM ({_SPLIT_POSTS_SQL}) b WHERE split = 'train')""")
def q_missing_keys(spark, sf_dir):
    s = _split_posts(spark, sf_dir)
    return joins.missing_keys(s.filter("split = 'test'"), s.filter("split = 'train'"), ["author"])


@register("overlapping_keys", f"""
    SELECT DISTINCT author FROM ({_STRAT_SQL}) a WHERE split = 'test'
      AND author IN (SELECT author FROM ({_STRAT_SQL}) b WHERE split = 'train')""")
def q_overlapping_keys(spark, sf_dir):
    s = _strat(spark, sf_dir)
    return joins.overlapping_keys(s.filter("split = 'test'"), s.filter("split = 'train'"), ["author"])


@register("check_corpus", Q.check_corpus_sql(_STRAT_SQL))
def q_check_corpus(spark, sf_dir):
    s = _strat(spark, sf_dir)
    ids = dense_ids(s.filter("split = 'train'"), ["author"], ["post_id"], id_col="author_id")
    s = s.join(ids, "author", "left")
    return checks.check_corpus(s, "split", "author_id", "text")


# F7 / F8 / C6 --------------------------------------------------------------------------
_PROFILE_POSTS_SQL = f"""SELECT u.split, p.author, p.post_id, d.text FROM ({Q.forum_posts_sql(True)}) p
    JOIN ({splits.split_authors_sql(f"SELECT author FROM ({Q.forum_posts_sql(True)}) q")}) u ON p.author = u.author
    JOIN documents d ON d.doc_id = p.post_id"""


@register("pairs_profile", Q.profile_pairs_sql(_PROFILE_POSTS_SQL))
def q_pairs_profile(spark, sf_dir):
    from quillspark.operators import profiles
    from quillspark.plans.catalog import forum_posts
    fp = forum_posts(spark, sf_dir)
    users = splits.split_authors(fp, "author")
    d = views.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("post_id"), "text")
    posts = fp.select("author", "post_id").join(users.select("author", "split"), "author").join(d, "post_id")
    return profiles.pairs_profile(profiles.profile_lengths(profiles.profile_members(posts)))


@register("sample_episodes", Q.sample_episodes_sql(AA_SQL, 5, 2, 100))
def q_sample_episodes(spark, sf_dir):
    """100 episodes of 5-way 2-shot over the AA view."""
    return pairs.sample_episodes(aa(spark, sf_dir), 5, 2, 100, "author_id", "text_id")
