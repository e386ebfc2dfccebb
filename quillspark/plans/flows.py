"""User-level flows (Z1-Z9): compositions of the operators, read -> write.

Each flow is one Spark plan per output (plus the checkpoints the operators
take); nothing is collected to the driver.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.functions.normalize import fold_accents
from quillspark.operators import checks, clean, joins, metrics, models, pairs, ppm, profiles, splits
from quillspark.operators import significance as sig
from quillspark.operators.ranking import dense_ids
from quillspark.session import cut_lineage
from quillspark.sources import io


def build_forum_pairs(posts: DataFrame, out: str | None = None, domain_map: DataFrame | None = None,
                      languages: Sequence[str] | None = None, seed: int = 42, with_texts: bool = False) -> DataFrame:
    """Posts -> C1/B7 -> B4 -> B3 + B5 -> B10 -> B6 -> F1 -> {F8, F6 in, F6 cross} -> A16.

    ``posts``: (post_id, author, text, subreddit or domain, ...). Returns the pair table with a ``kind`` column (profile,
    in_domain, cross_domain), written partitioned by kind and split when ``out`` is given: ids (posts, or authors and their
    halves), and with ``with_texts`` both texts, joined last."""
    p = posts
    if domain_map is not None:
        p = clean.drop_unknown_domain(joins.assign_domain(p, domain_map, "subreddit", "domain"))
    if "url_count" not in p.columns:
        p = p.withColumn("url_count", T.url_count("text"))
    if "text_length" not in p.columns:
        p = p.withColumn("text_length", T.word_count("text"))
    p = clean.drop_url_posts(p)
    p = clean.filter_length_open(p, "text_length", 25, 1000)
    if languages:
        p = clean.keep_languages(p, languages, "text_lang")
    p = clean.filter_author_size(p, "author", 2, 1000)
    p = clean.drop_bot_users(p, "author", clean.FORUM_BOT_NAMES)
    users = splits.split_authors(p, "author", seed=seed)
    a = pairs.pairs_in_domain(p, users, seed=seed).withColumn("kind", F.lit("in_domain"))
    b = pairs.pairs_cross_domain(p, users, seed=seed).withColumn("kind", F.lit("cross_domain"))
    members = profiles.profile_members(p.join(users.select("author", "split"), "author"), seed)
    c = profiles.pairs_profile(profiles.profile_lengths(members), seed)
    both = a.unionByName(b)
    if with_texts:
        texts = p.select("post_id", "text")
        both = (both.join(texts.select(F.col("post_id").alias("post_id_a"), F.col("text").alias("text0")), "post_id_a")
                .join(texts.select(F.col("post_id").alias("post_id_b"), F.col("text").alias("text1")), "post_id_b"))
        c = profiles.attach_profiles(c, members, p)
    out_df = both.unionByName(c.withColumn("kind", F.lit("profile")), allowMissingColumns=True)
    if out is not None:
        from quillspark.sources.io import write_pair_sets
        write_pair_sets(out_df, out)
    return out_df


def build_short_post_pairs(tweets: DataFrame, seed: int = 42, languages: Sequence[str] | None = None, language_model=None,
                           out: str | None = None, with_texts: bool = False) -> DataFrame:
    """A6 -> B1 -> G1, G22, G2 -> B4, B5, B6 -> B2 -> B10 (>= 2 texts) -> F1 -> F5 -> A16.

    ``language_model`` (from ``models.fit_language_id``) gives tweets without a ``lang`` column their language; with ``out``
    pairs are written by kind and split, with ``with_texts`` both texts are joined last.

    ``tweets``: (type, text, user[, lang][, post_id]). Without ``post_id`` the id is the 128-bit digest of
    (author, text), and equal texts of an author are one post (P2), so no pair holds a post twice and ids
    can be joined back to the texts."""
    t = clean.drop_types(tweets, "type")
    t = t.withColumn("url_count", T.url_count("text"))
    t = clean.drop_url_posts(t)
    if languages:
        if "lang" not in t.columns:
            if language_model is None:
                raise ValueError("languages need a lang column or a language model")
            t = models.language_id(t, language_model, "text", "lang")
        t = clean.keep_languages(t, languages, "lang")
    t = clean.drop_bot_users(t.withColumnRenamed("user", "author"), "author")
    t = clean.filter_words_chars(t, "text", 25, 300)
    if "post_id" not in t.columns:
        t = t.withColumn("post_id", F.md5(F.to_json(F.struct("author", "text"))))
    texts = t.select("post_id", "text")
    t = t.select("author", "post_id", F.md5("text").alias("__same")).groupBy("author", "__same").agg(F.min("post_id").alias("post_id"))
    t = clean.filter_author_size(t, "author", 2, None)
    p = pairs.pairs_random(t.select("author", "post_id"), seed=seed)
    if with_texts:
        texts = texts.groupBy("post_id").agg(F.min("text").alias("text"))  # equal posts share an id
        p = (p.join(texts.select(F.col("post_id").alias("post_id_a"), F.col("text").alias("text0")), "post_id_a")
             .join(texts.select(F.col("post_id").alias("post_id_b"), F.col("text").alias("text1")), "post_id_b"))
    if out is not None:
        io.write_pair_sets(p.withColumn("kind", F.lit("short_posts")), out)
    return p


def build_mix(sets: dict, n_per_label: int | dict = 10_000, seed: int = 42) -> DataFrame:
    """Z3: F12 over the outputs of Z1 / Z2."""
    return pairs.mix_pair_sets(sets, n_per_label, seed)


# What each corpus of Z4 takes: its reader, duplicates per author or over all, authors' sizes, the form of its split.
CORPORA = {
    "reviews": {"read": io.read_reviews, "distinct": "global", "min_texts": 5},
    "imdb62": {"read": io.read_imdb62, "distinct": "author", "min_texts": 2},
    "blogs": {"read": lambda spark, path: io.read_blog_posts(spark, path).withColumnRenamed("blog_id", "author"), "distinct": "author", "min_texts": 5},
    "tree": {"read": io.read_text_tree, "distinct": "author", "min_texts": 2},
    "topics": {"read": lambda spark, path: io.read_text_tree(spark, path, category_level=-3), "distinct": "author", "min_texts": 2, "form": "cross", "unit": "category"},
    "unseen": {"read": io.read_text_tree, "distinct": "global", "min_texts": 2, "form": "unseen"},
}


def build_corpus(spark: SparkSession, kind: str, source: str, out: str, seed: int = 42, **changes) -> DataFrame:
    """Reader -> P2 / P3 -> B10 -> E5 -> A19; corpus, pairs and stats under ``out``. Returns the invariants (O1) of what was
    written. ``kind`` names an entry of ``CORPORA``, ``changes`` override its parts (for a table: read=lambda spark, path: df).

    Text ids are digests of (author, text): equal texts of an author are one text, so ids need no order over the corpus."""
    want = {**CORPORA[kind], **changes}
    d = want["read"](spark, source)
    unit = want.get("unit")
    d = d.select("author", "text", *([unit] if unit else [])).filter(F.length("text") > 0)
    same = ["text"] if want["distinct"] == "global" else ["author", "text"]
    least = [F.min(c).alias(c) for c in d.columns if c not in same]
    d = d.groupBy(F.xxhash64(*same).alias("__h"), *same).agg(*least).drop("__h") if least else d.dropDuplicates(same)
    d = clean.filter_author_size(d, "author", want["min_texts"], want.get("max_texts"))
    d = d.withColumn("text_id", F.md5(F.to_json(F.struct("author", "text"))))
    d = cut_lineage(d)
    labels = dense_ids(d.select("author", "text_id"), ["author"], ["text_id"], id_col="author_id")
    aa = d.join(labels, "author").drop("author")
    io.write_id_map(labels, f"{out}/authors", mode="errorifexists")
    io.materialize_corpus(aa, out, seed, form=want.get("form", "stratified"), unit_col=unit)
    return checks.check_corpus(spark.read.parquet(f"{out}/aa"))


def train_and_score(method: str, train: DataFrame, test: DataFrame, dataset: str = "corpus", threshold: float = 0.5, seed: int = 42) -> DataFrame:
    """One method trained on one table and scored on the other, as score rows (dataset, model, id, label, prob, pred).

    * ``features``: pairs with the texts' vectors (pair_id, label, features_a, features_b), H13 + H14;
    * ``entropy``: pairs with texts (pair_id, label, text0, text1), I5 + I6;
    * ``entropy_authors``: texts (text_id, author_id, text), I1 + I3 + I4; prob is the margin, label and pred are authors;
    * ``ngrams``: texts likewise, J1 + J3 on character 1- to 3-grams; prob is that of the predicted author."""
    def rows(df, id_col):
        return df.select(F.lit(dataset).alias("dataset"), F.lit(method).alias("model"), F.col(id_col).cast("string").alias("id"),
                         F.col("label").cast("bigint").alias("label"), F.col("prob"), F.col("pred").cast("bigint").alias("pred"))

    if method == "features":
        both = train.withColumn("__train", F.lit(True)).unionByName(test.withColumn("__train", F.lit(False)))
        both = cut_lineage(both.select("pair_id", "label", "__train", F.monotonically_increasing_id().alias("__row"), "features_a", "features_b"))
        side = [both.select(F.concat_ws(":", "__row", F.lit(x)).alias("text_id"), F.col(f"features_{x}").alias("features"), "__train") for x in "ab"]
        texts = cut_lineage(side[0].unionByName(side[1]))
        pair_rows = both.select("pair_id", "label", "__train", F.concat_ws(":", "__row", F.lit("a")).alias("text_id_a"), F.concat_ws(":", "__row", F.lit("b")).alias("text_id_b"))
        d = cut_lineage(models.pair_difference(pair_rows, texts.select("text_id", "features"), texts.filter("__train").select("text_id")))
        model = models.fit_pair_classifier(d.filter("__train"), seed=seed)
        return rows(models.score_pairs(model, d.filter("not __train"), threshold), "pair_id")
    if method == "entropy":
        rates = [cut_lineage(ppm.pair_entropy_features(x).join(x.select("pair_id", "label"), "pair_id")) for x in (train, test)]
        return rows(models.score_entropy(models.fit_entropy_classifier(rates[0], seed=seed), rates[1], threshold), "pair_id")
    if method == "entropy_authors":
        test = test.filter(F.length("text") > 0)
        h = ppm.cross_entropy_authors(test, ppm.context_counts(train, "author_id"))
        got = ppm.attribute_by_entropy(h, texts=test, authors=train.filter(F.length("text") > 0))
        return rows(got.join(test.select("text_id", F.col("author_id").alias("label")), "text_id").withColumnRenamed("margin", "prob"), "text_id")
    if method == "ngrams":
        grams = [cut_lineage(x.select("text_id", "author_id", fold_accents(F.col("text")).alias("folded"))) for x in (train, test)]
        vec, vectors = models.fit_ngram_vectors(grams[0], "folded", min_df=2.0, sublinear=True, sizes=(1, 3))
        model = models.fit_author_classifier(cut_lineage(vectors), "author_id", reg=0.01)
        got = model.transform(vec.transform(grams[1])).withColumn("prob", F.array_max(vector_to_array("probability")))
        return rows(got.withColumn("label", F.col("author_id")).withColumn("pred", F.col("prediction")), "text_id")
    raise ValueError(f"unknown method {method}")


def evaluate_scores(validation: DataFrame, test: DataFrame, keys: Sequence[str] = ("dataset", "model")) -> DataFrame:
    """Youden threshold tuned on validation (L4) -> applied to test
    -> basic metrics (L2), PAN scores (L9) and verification metrics (L10, prefix ``av_``)."""
    keys = list(keys)
    thr = cut_lineage(metrics.youden_threshold(validation, keys))
    applied = cut_lineage(metrics.apply_threshold(test, thr, keys, default=0.0))
    basic = metrics.basic_metrics(applied, keys)
    pan = metrics.pan_scores(test, keys).drop("auc")
    av = metrics.av_metrics(applied, keys)
    av = av.select(*keys, *[F.col(c).alias(f"av_{c}") for c in av.columns if c not in (*keys, "threshold", "auc")])
    return basic.join(pan, keys).join(av, keys).join(thr, keys)


def significance_flow(test: DataFrame, thresholds: DataFrame | None = None, replicates: int = sig.N_BOOTSTRAPS,
                      seed: int = sig.SEED) -> DataFrame:
    """M1 -> M2 -> M3 -> M4 on thresholded predictions."""
    applied = metrics.apply_threshold(test, thresholds, ("dataset", "model"), default=0.5)
    return sig.significance_report(applied, replicates, seed)


def prepare_finetune_set(pairs_with_text: DataFrame, template: str) -> DataFrame:
    """G19 + G20 for all splits: (split, messages)."""
    from quillspark.operators.prompts import to_chat
    return to_chat(pairs_with_text, template, "text0", "text1", "label").select("split", "messages")


def encode_corpus(docs: DataFrame, id_col: str = "text_id", text_col: str = "text", t_w: int = 30,
                  max_sents: int = 50, min_count: int = 2, top_k: int | None = 5000) -> DataFrame:
    """G8 -> G11 -> (D4 -> E3) -> G12 -> G13."""
    from quillspark.functions.normalize import normalize_text
    from quillspark.operators import encode, features, rank, stats
    d = docs.select(id_col, normalize_text(text_col).alias("__t"))
    counts = stats.count_terms(features.token_table(d, id_col, "__t"), "token")
    vocab = rank.build_vocab(counts, min_count=min_count, top_k=top_k).select("term", "id")
    p = d.select(id_col, encode.add_markers(T.tokenized_sentences("__t"), t_w).alias("pieces"))
    return encode.encode_ids(p, vocab, id_col, "pieces", max_sents, t_w)
