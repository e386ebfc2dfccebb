"""Forms that scale: the same results as the plain ones, and plans that compute or move less."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators import clean, features, ppm, significance as S, vectors as V

ODD = ["", " ", "a b", " x y 　", "tab\tand\x1cfile\x85next", "\x00\x07 \x7f", " o᠎​", "Привет, мир 🙂 ok", "x" * 500 + " " * 300 + "y\n\n"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fast_word_and_edge_patterns_match_the_plain_ones(spark):
    random.seed(1)
    chars = "ab \t\n\x0b\x1c\x1f\x85\xa0\xa1   ​   　、🙂ж\x00\x7f"
    rows = [(i, t) for i, t in enumerate([*ODD, *("".join(random.choices(chars, k=random.randint(0, 40))) for _ in range(300))])]
    df = spark.createDataFrame([*rows, (-1, None)], "id int, t string")
    got = df.select(F.regexp_extract_all("t", F.lit(T.WORD_RE), 0).alias("a"), F.regexp_extract_all("t", F.lit(T.WORD_JVM), 0).alias("b"),
                    F.regexp_replace("t", T.EDGE_WS_RE, "").alias("c"), T.strip("t").alias("d"), T.word_count("t").alias("n")).collect()
    for r in got:
        assert r.a == r.b and r.c == r.d and r.n == len(r.a or [])


def test_length_filters_compute_the_text_once(spark, tmp_path):
    spark.createDataFrame([(1, "a b c"), (2, None), (3, " d ")], "id int, text string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    kept = clean.filter_length_open(df.withColumn("n", T.word_count("text")), "n", 1, 9)
    assert _plan(kept).count("regexp_extract_all") == 1 and [r.id for r in kept.collect()] == [1]
    short = clean.filter_words_chars(df, "text", 1, 3)
    assert _plan(short).count("regexp_replace") == 1 and [tuple(r) for r in short.collect()] == [(3, "d")]


def test_keyed_draws_are_md5_and_do_not_pass_as_rows(spark):
    for head in ("42|boot|en|", "42|boot|" + "ж" * 40 + "|"):
        rep, slot = np.array([7, 8, 9] * 4), np.arange(100, 112)
        assert [int(x) for x in S._md5_keys(head.encode(), rep, slot)] == [
            int(hashlib.md5(f"{head}{a}|{b}".encode()).hexdigest()[:15], 16) for a, b in zip(rep, slot)]
    rows = [(d, m, p, p % 2, (p * 7 + len(m)) % 3 % 2) for d, n in (("x", 13), ("y", 1)) for p in range(n) for m in ("a", "bb")] + [(None, "a", 99, 1, 1)]
    w = S.bootstrap_weights(spark.createDataFrame(rows, "dataset string, model string, pair_id int, label int, pred int"), replicates=12)
    assert "Nested" not in _plan(w)
    got = {(r.dataset, r.replicate, r.pattern): r.w for r in w.collect()}
    want = {}
    for d, n in (("x", 13), ("y", 1)):
        order = sorted((f"{p % 2}|a={(p * 7 + 1) % 3 % 2},bb={(p * 7 + 2) % 3 % 2}", p) for p in range(n))
        for r in range(12):
            for s in range(n):
                pat = order[int(hashlib.md5(f"42|boot|{d}|{r}|{s}".encode()).hexdigest()[:15], 16) % n][0]
                want[d, r, pat] = want.get((d, r, pat), 0) + 1
    assert got == want


def test_word_ngram_counts_move_texts_not_terms(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None), (1, ["a", "b"]), (4, ["z"])], "id int, toks array<string>")
    a = features.word_ngram_counts(df, "id", "toks", 1, 3)
    assert _plan(a).count("Exchange") == 1
    b = features.term_counts(df, "id", features.word_ngrams("toks", 1, 3))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_contexts_are_counted_from_their_longest(spark):
    texts = [(1, "abcabcabd" * 30 + "é🙂"), (1, None), (2, "x"), (None, "lost"), (2, "xy\nxy" + "z" * 200)]
    df = spark.createDataFrame(texts, "author_id int, text string")
    want = {}
    for a, t in texts:
        for i in range(len(t or "") if a else 0):
            for k in range(min(i, 3) + 1):
                want[a, k, t[i - k:i], t[i]] = want.get((a, k, t[i - k:i], t[i]), 0) + 1
    c = ppm.context_counts(df, "author_id", order=3)
    got = {(r.author_id, r.k, r.ctx, r.ch): r.n for r in c.collect()}
    assert got == want
    totals = {}
    for (a, k, ctx, _), n in want.items():
        totals[a, k, ctx] = totals.get((a, k, ctx), 0) + n
    assert all(r.ctx_n == totals[r.author_id, r.k, r.ctx] for r in c.collect())
    assert "Join" not in _plan(c)


def test_block_search_matches_pairwise_distances(spark):
    rng = random.Random(3)
    rows = [(i, i % 4 if i % 9 else None, [float(rng.randint(0, 3)) for _ in range(3)] if i % 11 else None) for i in range(40)]
    rows += [(40, 1, [0.0, 0.0, 0.0]), (41, 2, [1.0, 2.0]), (42, 2, [1.0, None, 2.0]), (43, 3, [])]
    v = spark.createDataFrame(rows, "text_id int, author_id int, embedding array<float>")
    c = v.withColumnRenamed("text_id", "cand_id")
    for metric in ("euclidean", "manhattan", "cosine"):
        for same in (None, True, False):
            for k, largest in ((1, True), (3, False), (None, False)):
                got = V.nearest_candidates(v, c, k, metric, exclude_self=True, same_label=same, query_label="author_id", largest=largest, block_size=16).collect()
                pairs = v.alias("q").crossJoin(c.alias("c")).filter("q.text_id <> c.cand_id")
                if same is not None:
                    pairs = pairs.filter("q.author_id = c.author_id" if same else "q.author_id <> c.author_id")
                want = {}
                for r in pairs.select("q.text_id", "c.cand_id", V.distance("q.embedding", "c.embedding", metric).alias("d")).collect():
                    want.setdefault(r.text_id, []).append((r.d is not None, 0 if r.d is None else -r.d if largest else r.d, r.cand_id))
                want = {(q, n + 1): (x[2], None if not x[0] else abs(x[1]) if metric != "cosine" else (-x[1] if largest else x[1]))
                        for q, xs in want.items() for n, x in enumerate(sorted(xs)[:k])}
                assert {(r.text_id, r.rank): (r.cand_id, r.d) for r in got} == want
