"""Terms counted in the tasks (F5, F13, F14, F15), parse trees walked a level at a time (F24), character grids."""

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from quillspark.operators import encode, features, models, ngrams, search

TEXTS = ["abcabc é🙂日本 Zz", "", None, "a", "x\0y\0", "ſtraße 日本語 🙂🙂🙂 abc", "hello world " * 40, "abc hello"]


def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").repartition(3)


def test_hashed_grams_equal_hashing_tf(spark):
    df = texts(spark)
    tf = HashingTF(inputCol="g", outputCol="f", numFeatures=1 << 10)
    want = {r.id: r.f for r in tf.transform(df.select("id", features.char_ngrams("text", 1, 3).alias("g"))).collect()}
    assert {r.id: r.f for r in df.select("id", ngrams.hashed_char_grams(F.lower("text"), 1, 3, 1 << 10).alias("f")).collect()} == want


@pytest.mark.parametrize("sublinear", [False, True])
def test_vectors_of_texts_equal_those_of_their_arrays(spark, sublinear, monkeypatch):
    monkeypatch.setattr(ngrams, "ROWS", 2)
    df = texts(spark)
    lists = df.select("id", features.char_ngrams("text", 1, 2, lowercase=False).alias("g"))
    got, train = models.fit_ngram_vectors(df, "text", min_df=2.0, sublinear=sublinear, sizes=(1, 2))
    assert "text" not in train.columns
    rows = {r.id: r.features.toArray() for r in train.collect()}
    grams = {r.id: r.g for r in lists.collect()}
    terms = sorted({t for g in grams.values() for t in g if sum(t in h for h in grams.values()) >= 2})
    assert sorted(t for _, t in got.words) == terms
    m = np.zeros((len(TEXTS), len(terms)))
    for i, g in grams.items():
        for k, (_, t) in enumerate(got.words):
            n, d = g.count(t), sum(t in h for h in grams.values())
            m[i, k] = n and (1 + np.log(n) if sublinear else n) * (np.log((len(TEXTS) + 1) / (d + 1)) + 1)
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    m /= m.max(axis=0)
    assert all(np.allclose(rows[i], m[i]) for i in range(len(TEXTS)))
    arrays, _ = models.fit_ngram_vectors(lists, "g", min_df=2.0, sublinear=sublinear)
    assert [t for _, t in arrays.words] == [t for _, t in sorted(got.words, key=lambda w: [x for _, x in arrays.words].index(w[1]))]


def test_search_on_a_text_column_equals_arrays(spark):
    rows = [(i, i % 2, "train" if i % 3 else "test", f"{'ab' if i % 2 else 'xy'}{i} é{i % 5}") for i in range(30)]
    rows += [(4, 0, "train", "again and again"), (None, 1, "train", "no id"), (31, 1, "test", None)]
    df = spark.createDataFrame(rows, "text_id long, author_id long, part string, text string")
    space = {"n_max": (1, 3), "max_features": (9, 40), "min_df": (1, 2), "sublinear": (0, 1), "reg": ("log", 1e-3, 1.0)}
    arrays = search.NgramSearch(df, lambda n: features.char_ngrams("text", n, n, lowercase=False), 3)
    for given in (None, space):
        shared = search.NgramSearch(df, "text", 3, space=given)
        for setting in ((3, 40, 1, True), (1, 9, 2, False)):
            (a, n), (b, k) = arrays.features(*setting), shared.features(*setting)
            key = [(r.id, r.label, r.train, [round(x, 9) for x in r.features.toArray()]) for r in a.collect()]
            assert n == k and sorted(map(str, key)) == sorted(str((r.id, r.label, r.train, [round(x, 9) for x in r.features.toArray()])) for r in b.collect())


def test_paths_of_repeated_and_null_rows(spark):
    rows = [(1, 1, 0, "a"), (1, 1, 0, "a"), (1, 2, 1, "b"), (1, 3, 2, None), (1, 4, 3, "c"), (1, 5, 4, "d"), (1, None, 1, "n"), (1, 9, None, "z"),
            (None, 1, 0, "a"), (None, 2, 1, "b"), (2, 1, 0, None), (2, 2, 1, "a"), (3, 5, 6, "q"), (4, 1, 0, "a_b"), (4, 2, 1, "c"), (4, 3, 0, "a"), (4, 4, 3, "b_c")]
    df = spark.createDataFrame(rows, "text_id long, tok int, head int, dep string").repartition(4)
    got = {(r.text_id, r.path): r.n for r in features.dependency_ngrams(df, 4).collect()}
    assert got == {(1, "a"): 2, (1, "a_b"): 4, (1, "a_n"): 2, (1, "a_b_c"): 2, (None, "a"): 1, (2, None): 1, (2, "a"): 1,
                   (4, "a_b"): 1, (4, "a"): 1, (4, "a_b_c"): 2}
    plan = features.dependency_ngrams(df, 4)._jdf.queryExecution().toString()
    assert "Join" not in plan


def test_grids_of_null_pieces(spark):
    vocab = spark.createDataFrame([(encode.PAD, 0), (encode.UNK, 1), ("a", 7)], "term string, id int")
    df = spark.createDataFrame([(1, ["a b", None]), (2, None), (3, [""])], "doc_id long, pieces array<string>")
    e = encode.encode_chars(df, vocab, "doc_id", "pieces", 2, 2, 1)
    assert {r.doc_id: r.chars for r in e.collect()} == {1: [[[7], [1]], None], 2: None, 3: [[[0], [0]], [[0], [0]]]}


def test_counts_are_packed(spark):
    """Places and counts come back as they were, in far fewer bytes than two lists of integers."""
    rng = np.random.default_rng(5)
    for size in (0, 1, 2, 700):
        f, n = np.sort(rng.choice(60_000, size, False)), rng.integers(1, 400 if size == 2 else 4, size)
        data = ngrams.pack_counts(f, n)
        back = ngrams.unpack_counts(data)
        assert back[0].tolist() == f.tolist() and back[1].tolist() == n.tolist()
    assert len(data) < 3 * 700
    first, f, n = ngrams.flat_counts([None, data, b""])
    assert first.tolist() == [0, 0, 700, 700] and len(f) == len(n) == 700


def test_a_setting_joins_and_writes_nothing(spark, monkeypatch):
    """Counts of a search lie in the rows of their texts: no join and no written vectors for a setting."""
    rows = [(i, i % 2, "train" if i % 3 else "test", f"{'ab' if i % 2 else 'xy'}{i}") for i in range(30)]
    for more in ([], [(4, 0, "train", "again"), (None, 1, "train", "no id")]):
        df = spark.createDataFrame(rows + more, "text_id long, author_id long, part string, text string")
        space = {"n_max": (1, 2), "max_features": (9, 40), "min_df": (1, 2), "sublinear": (0, 1), "reg": ("log", 1e-3, 1.0)}
        shared = search.NgramSearch(df, "text", 2, space=space)
        with monkeypatch.context() as m:
            m.setattr(search, "cut_lineage", None)
            table, _ = shared.features(2, 40, 1, True)
            plan = table._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in plan and "Exchange" not in plan
            assert shared.score({"n_max": 2, "max_features": 40, "min_df": 1, "sublinear": 1, "reg": 0.01}, 1.0) > 0.5
