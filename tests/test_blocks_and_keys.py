"""Block scoring, n-gram counts, keyed choices and multinomial resamples against plain definitions."""

import math
from collections import Counter

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quillspark.functions import key
from quillspark.operators import features as H, models, pairs, ppm, significance as S, splits
from quillspark.operators.ranking import first_by_key


def _keyed_entropy(test, counts, order):
    """I3 by the join of all events with all entries."""
    ev = ppm.position_events(test, ["text_id"], "text", order)
    bits = ppm._score_keyed(ev, counts, ["text_id"], [], "author_id")
    n = {r.text_id: len(r.text) for r in test.filter("text <> ''").collect()}
    return {(r.text_id, r.author_id): (r.bits + (n[r.text_id] - r.matched) * 8.0) / n[r.text_id] for r in bits.collect()}


def _texts(spark):
    train = [(f"a{k % 7}", f"{'the cat sat on a mat ' * (k % 3 + 1)}{chr(97 + k % 26) * (k % 9)} é日{k}") for k in range(40)]
    test = [(k, f"a cat {k} on the {chr(97 + k % 26) * 4}") for k in range(30)] + [(90, ""), (91, None), (92, "Ω"), (93, "e"), (93, "e")]
    return spark.createDataFrame(train, "author_id string, text string"), spark.createDataFrame(test, "text_id long, text string")


def test_block_scores_equal_the_join(spark, monkeypatch):
    train, test = _texts(spark)
    counts = ppm.context_counts(train, "author_id", "text", order=3)
    want = _keyed_entropy(test.dropDuplicates(["text_id"]), counts, 3)
    for small in (False, True):
        if small:  # many shares of texts and models, a slice per event
            for name, value in (("BLOCK_CHARS", 200), ("BLOCK_TEXTS", 9), ("BLOCK_ENTRIES", 300), ("BLOCK_MODELS", 2), ("MAX_HITS", 3), ("BLOCK_EVENTS", 3)):
                monkeypatch.setattr(ppm, name, value)
        got = {(r.text_id, r.author_id): r.h for r in ppm.cross_entropy_authors(test, counts, order=3).collect()}
        assert got.keys() == want.keys()
        assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
    assert ppm.cross_entropy_authors(test.filter("false"), counts, order=3).count() == 0
    assert ppm.cross_entropy_authors(test, counts.filter("false"), order=3).count() == 0


def test_block_match_separates_equal_first_hashes():
    import pyarrow as pa
    texts = pa.table({"text": [1, 1, 2, 2], "e1": [5, 5, 5, 9], "e2": [1, 3, 2, 1], "zero": [True, False, True, True], "cnt": [2, 1, 1, 4]})
    entries = pa.table({"model": ["x", "x", "y", "y"], "e1": [5, 5, 5, 7], "e2": [2, 1, 1, 1], "w": [-1.0, -2.0, -4.0, -8.0]})
    got = sorted(ppm._match_block(texts, entries).to_pylist(), key=lambda r: (r["text"], r["model"]))
    assert got == [{"text": 1, "model": "x", "bits": 4.0, "matched": 2}, {"text": 1, "model": "y", "bits": 8.0, "matched": 2},
                   {"text": 2, "model": "x", "bits": 1.0, "matched": 1}]


def test_char_wb_counts_equal_the_arrays(spark):
    df = spark.createDataFrame([(1, "a bb I x 日本 a"), (2, None), (3, ""), (4, "The the THE there"), (4, "the"), (5, "!? -")], "doc_id long, text string")
    for lo, hi in ((1, 3), (3, 3), (4, 6)):
        want = H.term_counts(df, "doc_id", H.char_wb_ngrams("text", lo, hi))
        got = H.char_wb_counts(df, "doc_id", "text", lo, hi)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not got.isEmpty()


def test_first_by_key_is_the_sorted_prefix(spark):
    rows = [(None if g == 2 else g, i) for g, n in ((0, 3000), (1, 40), (2, 5), (3, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, i long").withColumn("k", key(1, "t", F.coalesce("g", F.lit(-1)), F.col("i")))
    all_rows = df.collect()
    for n in (1, 7, 40, 5000):
        got = {(r.g, r.i) for r in first_by_key(df, ["g"], F.col("k"), ["i"], n).collect()}
        want = {(r.g, r.i) for g in (0, 1, None, 3) for r in sorted((x for x in all_rows if x.g == g), key=lambda x: (x.k, x.i))[:n]}
        assert got == want
    # ties in the key go by the next columns, an empty table gives none
    same = df.filter("g = 1").withColumn("k", F.lit(5).cast("bigint"))
    assert sorted(r.i for r in first_by_key(same, ["g"], F.col("k"), ["i"], 6).collect()) == list(range(6))
    assert first_by_key(df.filter("false"), ["g"], F.col("k"), ["i"], 6).count() == 0
    assert splits.sample_rows(df.select("i"), 10, "i").count() == 10 and splits.sample_rows(df.filter("false"), 10, "i").count() == 0


def test_mix_keeps_n_of_each_label(spark):
    cols = "split string, label boolean, author_a long, post_id_a long, author_b long, post_id_b long"
    a = spark.createDataFrame([("train" if i % 3 else "test", i % 2 == 0, i, i, i, i + 1) for i in range(300)], cols)
    got = Counter((r.source, r.split, r.label) for r in pairs.mix_pair_sets({"x": a, "y": a.filter("post_id_a < 12")}, {"x": 20, "y": 3}).collect())
    assert got == {**{("x", s, b): 20 for s in ("train", "test") for b in (True, False)},
                   **{("y", s, b): n for s, n in (("train", 3), ("test", 2)) for b in (True, False)}}


def test_sublinear_keeps_vectors_sparse(spark):
    v = [Vectors.sparse(6, [1, 4], [2.0, 1.0]), Vectors.sparse(6, [], []), Vectors.sparse(6, [0, 2], [0.0, 9.0])]
    got = [r.v for r in models._sublinear(spark.createDataFrame([(x, i) for i, x in enumerate(v)], ["v", "i"]), "v").orderBy("i").collect()]
    for x, y in zip(v, got):
        a, b = x.toArray(), y.toArray()
        assert hasattr(y, "indices") and np.allclose(b, np.where(a > 0, 1 + np.log(np.where(a > 0, a, 1)), 0))


def test_multinomial_weights_have_the_moments_of_the_draws(spark):
    rows = [(d, m, i, i % 2, int((i * 7 + j) % 5 < 2)) for d, n in (("a", 60), ("b", 9), ("c", 1)) for i in range(n) for j, m in enumerate(("m", "n"))]
    scores = spark.createDataFrame(rows, "dataset string, model string, pair_id long, label int, pred int")
    counts = {(r.dataset, r.pattern): r.n for r in S.pair_patterns(scores).groupBy("dataset", "pattern").agg(F.count("*").alias("n")).collect()}
    reps = 3000
    w = S.multinomial_weights(scores, reps).collect()
    size = {"a": 60, "b": 9, "c": 1}
    total = Counter()
    for r in w:
        assert r.w > 0
        total[r.dataset, r.replicate] += r.w
    assert total == {(d, k): n for d, n in size.items() for k in range(reps)}
    for (d, p), c in counts.items():
        x = np.zeros(reps)
        for r in w:
            if (r.dataset, r.pattern) == (d, p):
                x[r.replicate] = r.w
        n, q = size[d], c / size[d]
        assert abs(x.mean() - n * q) < 5 * math.sqrt(n * q * (1 - q) / reps) + 1e-9
        assert abs(x.var() - n * q * (1 - q)) <= 0.2 * n * q * (1 - q) + 1e-9
    again = {(r.dataset, r.replicate, r.pattern): r.w for r in S.multinomial_weights(scores.repartition(5), reps).collect()}
    assert again == {(r.dataset, r.replicate, r.pattern): r.w for r in w}
    a, b = ({(r.dataset, r.metric, r.model_a): r for r in S.significance_report(scores, reps, weights=f).collect()} for f in (None, S.multinomial_weights))
    assert a.keys() == b.keys()
    for k in a:
        assert abs(a[k].mean_diff - b[k].mean_diff) < 0.03 and abs(a[k].ci_low - b[k].ci_low) < 0.08 and abs(a[k].p_value - b[k].p_value) < 0.1
