"""Search, SVD, class-pair AUC, leave-one-out entropy and pair draws against brute force."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quillspark.operators import metrics_aa, models, pairs, ppm, search, svd


# L11 ------------------------------------------------------------------------

def brute_auc(pos, neg):
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_one_vs_one_auc_with_ties(spark):
    rng = random.Random(4)
    truth = {i: rng.choice("abcd") for i in range(60)}
    p = {(i, c): rng.randint(0, 6) / 6 + 0.3 * (truth[i] == c) for i in truth for c in "abcd"}
    df = spark.createDataFrame([(i, truth[i], c, float(x)) for (i, c), x in p.items()], "text_id long, label string, cls string, p double").repartition(5)
    per, weight = [], []
    for j, k in itertools.combinations("abcd", 2):
        tj, tk = [i for i in truth if truth[i] == j], [i for i in truth if truth[i] == k]
        per.append((brute_auc([p[i, j] for i in tj], [p[i, j] for i in tk]) + brute_auc([p[i, k] for i in tk], [p[i, k] for i in tj])) / 2)
        weight.append(len(tj) + len(tk))
    got = metrics_aa.ovo_auc(df).first()
    assert got.ovo_macro_auc == pytest.approx(np.mean(per)) and got.ovo_weighted_auc == pytest.approx(np.average(per, weights=weight))
    rest = [(brute_auc([p[i, c] for i in truth if truth[i] == c], [p[i, c] for i in truth if truth[i] != c]), sum(t == c for t in truth.values())) for c in "abcd"]
    ovr = metrics_aa.ovr_auc(df).first()
    assert ovr.ovr_macro_auc == pytest.approx(np.mean([a for a, _ in rest])) and ovr.ovr_weighted_auc == pytest.approx(np.average([a for a, _ in rest], weights=[n for _, n in rest]))


def test_one_vs_one_auc_of_one_class_or_none(spark):
    one = spark.createDataFrame([(1, "a", "a", 0.3), (2, "a", "a", 0.4)], "text_id long, label string, cls string, p double")
    for df in (one, one.where("false")):
        assert list(metrics_aa.ovo_auc(df).first()) == [None, None]


# J2 -------------------------------------------------------------------------

def sparse_table(spark, n, d, seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((n, d)) * (rng.random((n, d)) < 0.3) * np.linspace(3, 0.2, d)
    a[3] = 0
    rows = [(i, Vectors.dense(r) if i % 3 == 0 else Vectors.sparse(d, np.flatnonzero(r).tolist(), r[r != 0].tolist())) for i, r in enumerate(a)]
    return a, spark.createDataFrame(rows, ["text_id", "features"]).repartition(6)


def test_svd_matches_dense_svd(spark):
    a, df = sparse_table(spark, 120, 50, 1)
    model = svd.fit_svd(df, 12, oversample=6)
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.abs(model.values - s[:12]).max() < 1e-6
    # the same subspace: all principal angles vanish
    assert np.abs(np.linalg.svd(model.components.T @ vt[:12].T)[1] - 1).max() < 1e-6
    got = {r.text_id: r.svd for r in model.transform(df).collect()}
    assert all(np.allclose(got[i], a[i] @ model.components, atol=1e-9) for i in range(len(a)))
    again = {r.text_id: r.svd for r in models.reduce_svd(df, 12).collect()}
    assert len(again) == len(a) and np.allclose(np.sqrt(sum(np.square(v) for v in again.values())), s[:12], atol=1e-6)


def test_svd_of_small_and_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(svd, "BLOCK", 7)
    a, df = sparse_table(spark, 40, 20, 2)
    assert np.allclose(svd.fit_svd(df, 63).values, np.linalg.svd(a)[1], atol=1e-6)  # more directions asked for than there are
    low = spark.createDataFrame([(i, Vectors.dense([i, 2.0 * i, 0.0])) for i in range(5)], ["text_id", "features"])
    assert np.allclose(svd.fit_svd(low, 3).values, [math.sqrt(150), 0, 0], atol=1e-6)
    assert svd.reduce_svd(df.where("false"), 3).count() == 0
    zero = spark.createDataFrame([(1, Vectors.sparse(4, [], []))], ["text_id", "features"])
    assert [list(r.svd) for r in svd.reduce_svd(zero, 2).collect()] == [[0.0, 0.0]]


# J5 -------------------------------------------------------------------------

def test_draws_are_keyed_and_log_uniform(spark):
    rows = search.draw_settings(spark, search.NGRAM_SPACE, 300).collect()
    assert [r.reg for r in rows] == pytest.approx(search.log_uniform(300))
    logs = [math.log10(r.reg) for r in rows]
    assert -4 <= min(logs) and max(logs) <= 0 and abs(np.mean(logs) + 2) < 0.2
    assert {r.n_max for r in rows} == {2, 3, 4} and set(Counter(r.min_df for r in rows)) == {1, 2, 5}


def test_halving_keeps_the_best_and_breaks_ties(spark):
    runs = [(s, r, v) for s, vs in {0: (.5, .1), 1: (.5, .9), 2: (.4, 1.), 3: (None, 1.)}.items() for r, v in enumerate(vs)]
    df = spark.createDataFrame(runs, "setting long, rung int, score double")
    got = {(r.setting, r.rung): (r["rank"], r.kept) for r in search.successive_halving(df, (2, 1)).collect()}
    assert got == {(0, 0): (1, True), (1, 0): (2, True), (2, 0): (3, False), (3, 0): (4, False), (1, 1): (1, True), (0, 1): (2, False)}


def tiny_corpus(spark):
    rng = random.Random(9)
    words = {a: [f"{x}{y}{a}" for x in "xyz" for y in "uvw"] + ["the", "and", "of"] * 3 for a in (0, 1, 2)}
    rows = [(i, i % 3, "train" if i % 4 else "test", " ".join(rng.choice(words[i % 3] if rng.random() < 0.3 else words[rng.randrange(3)]) for _ in range(8))) for i in range(90)]
    return spark.createDataFrame(rows + [(90, 0, "test", ""), (91, 1, "train", None)], "text_id long, author_id long, part string, text string")


def test_search_finds_what_an_exhaustive_search_finds(spark):
    from quillspark.operators.features import word_ngrams
    df = tiny_corpus(spark)
    space = {"n_max": (1, 2), "max_features": (5, 40), "min_df": (1, 3), "sublinear": (0, 1), "reg": ("log", 1e-3, 1.0)}

    def grams(n):
        return word_ngrams(F.split(F.coalesce("text", F.lit("")), " "), n, n)

    shared = search.NgramSearch(df, grams, 2)
    settings = search.draw_settings(spark, space, 4)
    scores = {r.setting: shared.score(r.asDict(), 1.0) for r in settings.collect()}
    # one rung on all texts is the exhaustive search
    full = search.search(settings, shared.score, 1).collect()
    assert {r.setting: r.score for r in full} == pytest.approx(scores)
    assert [r.setting for r in full if r.kept] == [min(scores, key=lambda s: (-scores[s], s))]
    halved = search.search_ngram_classifier(df, grams, 4, 2, 2, space).collect()
    assert Counter(r.rung for r in halved) == {0: 4, 1: 2} and all(r.score == pytest.approx(scores[r.setting]) for r in halved if r.rung == 1)


def test_shared_features_match_a_direct_count(spark):
    from quillspark.operators.features import word_ngrams
    df = tiny_corpus(spark)
    shared = search.NgramSearch(df, lambda n: word_ngrams(F.split(F.coalesce("text", F.lit("")), " "), n, n), 2)
    table, size = shared.features(2, 25, 2, True)
    texts = {r.text_id: (r.part, (r.text or "").split(" ")) for r in df.collect()}
    tf = {i: Counter([w for w in ws] + [" ".join(p) for p in zip(ws, ws[1:])]) for i, (_, ws) in texts.items()}
    train = [i for i, (p, _) in texts.items() if p == "train"]
    dfreq, cf = Counter(), Counter()
    for i in train:
        dfreq.update(tf[i].keys())
        cf.update(tf[i])
    terms = sorted((t for t in cf if dfreq[t] >= 2), key=lambda t: (-cf[t], t))[:25]
    m = np.array([[(1 + math.log(tf[i][t])) * (math.log((1 + len(train)) / (1 + dfreq[t])) + 1) if tf[i][t] else 0.0 for t in terms] for i in sorted(texts)])
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    m /= np.abs(m[[sorted(texts).index(i) for i in train]]).max(axis=0)
    got = {r.id: r.features.toArray() for r in table.collect()}
    assert size == 25 and all(np.allclose(got[i], m[k]) for k, i in enumerate(sorted(texts)))


# I2, I6 ---------------------------------------------------------------------

TEXTS = [(1, 10, "abracadabra"), (1, 11, "abra kadabra"), (1, 12, ""), (1, 13, None), (2, 14, "hocus pocus"), (2, 15, "hocus pocus"), (3, 16, "alone"),
         (1, 17, "aaaaaaa"), (2, 18, "é🙂é🙂 pocus")]


def test_leave_one_out_matches_rebuilt_models(spark):
    df = spark.createDataFrame(TEXTS, "author_id long, text_id long, text string").repartition(3)
    got = {r.text_id: r.h for r in ppm.leave_one_out_entropy(df).collect()}
    assert set(got) == {i for _, i, t in TEXTS if t}
    for a, i, t in TEXTS:
        if not t:
            continue
        counts = {}
        for b, j, u in TEXTS:
            if b == a and j != i and u:
                for pos in range(len(u)):
                    for k in range(min(pos, ppm.ORDER) + 1):
                        counts.setdefault(u[pos - k:pos], Counter())[u[pos]] += 1
        bits = 0.0
        for pos in range(len(t)):
            for k in range(min(pos, ppm.ORDER), -1, -1):
                c = counts.get(t[pos - k:pos])
                if c and c[t[pos]]:
                    bits -= math.log2(c[t[pos]] / sum(c.values()))
                    break
            else:
                bits += 8
        assert got[i] == pytest.approx(bits / len(t)), t


def test_subtracting_a_model_gives_the_model_of_the_rest(spark):
    df = spark.createDataFrame(TEXTS, "author_id long, text_id long, text string")
    whole, part, rest = (ppm.context_counts(d, "author_id") for d in (df, df.where("text_id % 2 = 1"), df.where("text_id % 2 = 0")))
    cols = ["author_id", "k", "ctx", "ch", "n", "ctx_n"]
    left = ppm.subtract_model(whole, part, "author_id").select(*cols)
    assert sorted(map(tuple, left.collect())) == sorted(map(tuple, rest.select(*cols).collect()))
    with pytest.raises(Exception, match="does not contain"):
        ppm.subtract_model(part, whole, "author_id").collect()


def test_entropy_classifier_separates_pairs(spark):
    rng = random.Random(1)
    voice = {0: "abcd ", 1: "uvwxyz "}
    rows = []
    for i in range(40):
        a, same = i % 2, i % 4 < 2
        rows.append((i, int(same), "".join(rng.choice(voice[a]) for _ in range(60)), "".join(rng.choice(voice[a if same else 1 - a]) for _ in range(60))))
    df = spark.createDataFrame(rows, "pair_id long, label int, text0 string, text1 string")
    f = ppm.pair_entropy_features(df).join(df.select("pair_id", "label"), "pair_id")
    model = models.fit_entropy_classifier(f.where("pair_id < 28"))
    got = models.score_entropy(model, f.where("pair_id >= 28")).collect()
    assert len(got) == 12 and all(r.pred == r.label and (r.prob >= 0.5) == r.label for r in got)
    empty = spark.createDataFrame([(1, None, None, None, None)], "pair_id long, d1 double, d2 double, mean double, diff double")
    assert models.score_entropy(model, empty).first().prob is not None


def test_entropy_classifier_without_any_pair(spark, tmp_path):
    """Authors with one text each, or with too many, have no pairs: there is nothing to fit and no row."""
    from quillspark.plans.catalog import QUERIES
    rows = [(i, " ".join(["word"] * 40), "en", f"s{i}") for i in range(5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["entropy_classifier"](spark, str(tmp_path))
    assert got.columns == ["pair_id", "split", "label", "prob", "pred"] and got.collect() == []


# F6 -------------------------------------------------------------------------

def test_unranking_is_exact_for_large_groups(spark):
    js = [1, 2, 3, 10 ** 6, 94906267, 10 ** 9, 2 * 10 ** 9, 3 * 10 ** 9 - 1]
    rs = sorted({j * (j - 1) // 2 + d for j in js for d in (-1, 0, 1, j - 1) if j * (j - 1) // 2 + d >= 0})
    got = spark.createDataFrame([(r,) for r in rs], "r long").select("r", pairs._unrank_j(F.col("r")).alias("j")).collect()
    for r, j in got:
        assert j * (j - 1) // 2 <= r < (j + 1) * j // 2


def test_distinct_draws_are_distinct_and_uniform(spark):
    from quillspark.functions import key
    got = spark.range(6000).select(pairs.distinct_draws(F.lit(7).cast("bigint"), 5, lambda i: key(1, "t", F.col("id"), i)).alias("d")).collect()
    seen = Counter()
    for r in got:
        assert len(set(r.d)) == 5 and 0 <= min(r.d) and max(r.d) < 7
        seen.update(r.d)
    assert max(seen.values()) - min(seen.values()) < 0.06 * 6000
