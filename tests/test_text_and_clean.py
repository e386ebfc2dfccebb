"""Scalar text functions and filters on hand-made edge rows (FIXTURES part 3)."""

from pyspark.sql import functions as F

from quillspark.functions import key, key_sql
from quillspark.functions import text as T
from quillspark.operators import clean


def test_key_matches_duckdb_and_is_stable(spark, duck):
    df = spark.range(50).select(F.col("id"), key(42, "x", F.col("id")).alias("k"))
    a = {r.id: r.k for r in df.collect()}
    b = dict(duck.sql(f"SELECT range AS id, {key_sql(42, 'x', '@range')} AS k FROM range(50)").fetchall())
    assert a == b
    again = {r.id: r.k for r in df.repartition(7).collect()}
    assert again == a
    assert all(0 <= v < 2 ** 60 for v in a.values())


def test_word_count_edge_cases(spark):
    rows = [(None,), ("",), ("   ",), ("a\u0000b",), ("one\ttwo\nthree",), ("emoji 😀 here",),
            ("éte accent",), ("word",), ("a b",)]
    out = [r[0] for r in spark.createDataFrame(rows, "t string").select(T.word_count("t")).collect()]
    assert out == [0, 0, 0, 1, 3, 3, 2, 1, 2]
    assert out == [len((r[0] or "").split()) for r in rows]


def test_url_mask_and_mentions(spark):
    df = spark.createDataFrame([("see http://a https://b and www.c now @user #tag",)], "t string")
    r = df.select(T.url_count("t").alias("n"), T.mask_urls("t").alias("m"), T.mask_tweet("t").alias("w")).first()
    assert r.n == 2
    assert r.m == "see  URL   URL  and  URL  now @user #tag"
    assert "@USER" in r.w and "http" not in r.w


def test_filter_words_chars_boundaries(spark):
    def text(words, extra=""):
        return " ".join(["w"] * words) + extra
    rows = [(1, text(24)), (2, text(25)), (3, text(26)), (4, "  " + text(25) + "  ")]
    df = spark.createDataFrame(rows, "id int, text string")
    kept = sorted(r.id for r in clean.filter_words_chars(df, "text", 25, 300).collect())
    assert kept == [2, 3, 4]
    long = spark.createDataFrame([(1, "x " * 149 + "y"), (2, "x " * 150 + "y")], "id int, text string")
    # 299 chars vs 301 chars
    assert [r.id for r in clean.filter_words_chars(long, "text", 1, 300).collect()] == [1]


def test_filter_length_open_is_exclusive(spark):
    df = spark.createDataFrame([(i,) for i in (24, 25, 26, 999, 1000)], "text_length int")
    assert sorted(r.text_length for r in clean.filter_length_open(df).collect()) == [26, 999]


def test_bot_names(spark):
    names = [("bot",), ("Robot",), ("BOTany",), ("AutoModerator",), (None,), ("bOt",), ("nullable",)]
    df = spark.createDataFrame(names, "author string")
    kept = [r.author for r in clean.drop_bot_users(df, "author").collect()]
    assert kept == ["AutoModerator", None, "bOt", "nullable"]
    kept_forum = [r.author for r in clean.drop_bot_users(df, "author", clean.FORUM_BOT_NAMES).collect()]
    assert kept_forum == [None, "bOt"]


def test_escape_and_joined_pairs(spark):
    from quillspark.sources.io import read_joined_pairs
    df = spark.createDataFrame([("only",), ("a$$$b",), ("a$$$b$$$c",)], "review string")
    out = [(r.text0, r.text1) for r in read_joined_pairs(df).collect()]
    assert out == [("only", "only"), ("a", "b"), ("a", "c")]
    assert spark.createDataFrame([("x$$$y",)], "t string").select(T.escape_separator("t")).first()[0] == "x&&&y"


def test_render_prompt_requires_both_fields():
    import pytest
    with pytest.raises(ValueError):
        T.render_prompt("only {text_a}", "a", "b")


def test_prepare_and_merge_entries(spark):
    from quillspark.operators import features as H
    df = spark.createDataFrame([("a", 1, "See WWW.X.COM now"), ("a", 2, "Second one")], "author string, text_id long, text string")
    e = H.prepare_entries(df, "text")
    first = e.orderBy("text_id").first().entry
    assert first.preprocessed == "see  URL  now" and first.tokens == ["see", "URL", "now"]
    m = H.merge_entries(e, "author", "entry", "text_id").first().entry
    assert m.preprocessed == "see  URL  now second one" and m.tokens == ["see", "URL", "now", "second", "one"]
