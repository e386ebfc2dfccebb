"""Operators 2, 5, 6 and 9: gradients, brute force, held-out accuracy, odd cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark.llm import byte_cnn, gru_lm, kernel_quality, ngram_rules, textvec as V
from quillspark.llm.queries import QUERIES, remainder

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slope_errors(loss, params, grads, places):
    worst = 0.0
    for name, place in places:
        old, e = params[name][place], 1e-6
        params[name][place] = old + e
        up = loss()
        params[name][place] = old - e
        down = loss()
        params[name][place] = old
        worst = max(worst, abs((up - down) / (2 * e) - grads[name][place]))
    return worst


def test_words_and_hashes_match_python():
    texts = ["", None, " a  bb\tccc\n", "É è 日本語 x", "a" * 3000, "\x0b\x0c x\x00y"]
    for lo, hi, raw, offs in V.slices(pa.array(texts), 64):
        starts, ends, of = V.runs(~V.SPACE[raw], offs)
        got = [[raw[s:e].tobytes().decode() for s, e, t in zip(starts, ends, of) if t == k] for k in range(hi - lo)]
        assert got == [WORD.findall(t or "") for t in texts[lo:hi]]
        h = V.Hasher(raw).of(starts, ends)
        assert len(set(h.tolist())) == len({raw[s:e].tobytes() for s, e in zip(starts, ends)})
    one, two = (V.Hasher(np.frombuffer(b, np.uint8)).of(np.array([a]), np.array([a + 3]))[0] for b, a in ((b"xx abc", 3), (b"abc yy", 0)))
    assert one == two


def test_gru_gradients():
    rng = np.random.default_rng(0)
    m = gru_lm.Gru(dtype=np.float64)
    ids, want = rng.integers(0, gru_lm.HEAD + 1, (2, 5, 3))
    fresh, state = rng.random((5, 3)) < 0.3, rng.normal(0, 0.5, (3, gru_lm.HIDDEN))
    g = m.gradients(ids, fresh, want, state)[1]
    places = [("x", (int(ids[1, 0]), 3)), ("x", (int(ids[4, 2]), 20)), ("u", (2, 5)), ("u", (7, 40)), ("cw", (1, 4)), ("cb", (31,)),
              ("ow", (int(min(want[2, 1] // 64, 30)), 3, 9)), ("ob", (int(min(want[3, 0] // 64, 30)), 5))]
    assert slope_errors(lambda: m.gradients(ids, fresh, want, state)[0], m.p, g, places) < 1e-7


def test_gru_state_runs_over_whole_texts():
    rng = np.random.default_rng(1)
    m = gru_lm.Gru()
    at = np.array([0, 4, 5, 90, 91, 400])
    ids = rng.integers(0, gru_lm.HEAD + 1, 400)
    together = m.score(ids, at, lanes=3)
    alone = [m.score(ids[a:b], np.array([0, b - a]))[0] for a, b in zip(at[:-1], at[1:])]
    assert np.allclose(together, alone, rtol=1e-4)


def lm_tokens(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) + ["\n"]


@pytest.mark.parametrize("hot", [1 << 16, 2500])
def test_language_model_base_and_gain(spark, sf, hot, monkeypatch):
    monkeypatch.setattr(gru_lm, "HOT", hot)  # the smaller one sends most words through the join
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    count = Counter()
    for r in docs:
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            count.update(lm_tokens(r.text))
    total, distinct = sum(count.values()), len(count)
    got = {r.doc_id: r for r in QUERIES["op2_gru_language_model"](spark, sf).collect()}
    assert len(got) == len(docs)
    for r in docs:
        words, g = lm_tokens(r.text), got[r.doc_id]
        assert g.n_tokens == len(words) and g.n_known == sum(count[w] > 0 for w in words) and g.train_tokens == total
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert math.isclose(g.base_score, sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in words), rel_tol=1e-9)
    held = [g for g in got.values() if g.held_out]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)


def test_language_model_odd_rows(odd, none):
    got = gru_lm.score_texts(odd, F.col("doc_id") != 7).collect()
    assert len(got) == odd.count() and all(g.score < 0 and math.isfinite(g.score) for g in got)
    assert {g.n_tokens for g in got if g.doc_id in (1, 2, 3)} == {1} and next(g for g in got if g.doc_id is None).held_out
    same = [g.score for g in got if g.doc_id in (8, 9)]
    assert max(same) - min(same) < 1e-4  # single precision, summed in other lanes
    assert gru_lm.score_texts(none, F.lit(True)).count() == 0
    assert {g.train_tokens for g in gru_lm.score_texts(odd, F.lit(False)).collect()} == {0}


def test_quality_held_out_accuracy(spark, sf):
    sf = sf.replace("0.001", "0.01")
    got = QUERIES["op5_kernel_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 80 and sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(2)
    n, p = rng.integers(0, 4, 30), np.zeros(30)
    p = np.minimum(n, rng.integers(0, 4, 30)).astype(float)
    fit = kernel_quality.isotonic(n, p)
    assert (np.diff(fit) >= -1e-12).all()
    use = n > 0
    least = [max(min(p[i:j + 1].sum() / n[i:j + 1].sum() for j in range(k, 30) if n[i:j + 1].sum()) for i in range(k + 1) if n[i:30].sum() and n[i:k + 1].sum())
             for k in np.flatnonzero(use)]
    assert np.allclose(fit[use], least)


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 0), (7, 1), (8, 1), (11, 0), (1, None), (None, 1)], "doc_id long, quality int")
    got = kernel_quality.classify(odd, labels, F.col("doc_id") < 100).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    for same in ((8, 9), (1, 2)):  # to the last bits of sums over a batch
        of = [r.score for r in got if r.doc_id in same]
        assert max(of) - min(of) < 1e-9
    assert {r.score for r in kernel_quality.classify(odd, labels.where("false"), F.lit(True)).collect()} == {0.5}
    assert kernel_quality.classify(none, labels, F.lit(True)).count() == 0


def test_byte_net_gradients():
    rng = np.random.default_rng(0)
    n = byte_cnn.ByteNet(["a", "b", "c"])
    n.p = {k: v.astype(np.float64) for k, v in n.p.items()}
    w, y = rng.integers(1, 255, (4, byte_cnn.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1])
    g = n.gradients(w, y, np.ones(4))[1]
    places = [("embed", (int(w[0, 9]), 2)), ("embed", (int(w[3, 100]), 5)), ("conv", (3, 1)), ("conv", (20, 30)), ("bias", (4,)), ("out", (7, 1)), ("prior", (2,))]
    assert slope_errors(lambda: n.gradients(w, y, np.ones(4))[0], n.p, g, places) < 1e-7


def test_language_held_out_accuracy(spark, sf):
    sf = sf.replace("0.001", "0.01")
    got = QUERIES["op6_byte_cnn_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_language_odd_rows(spark, odd, none):
    known = spark.createDataFrame([(k, ("the cat and the dog " if k % 2 else "der hund und die katze ") * 9, "en" if k % 2 else "de") for k in range(60)],
                                  "doc_id long, text string, lang string")
    net = byte_cnn.train(known.union(spark.createDataFrame([(None, "x", None), (70, None, "fr"), (71, "", "fr")], known.schema)), F.lit(True))
    assert net.languages == ["de", "en"]
    got = {r.doc_id: r for r in byte_cnn.predict(odd, net).collect()}
    assert byte_cnn.predict(odd, net).count() == odd.count()
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (1, 2, 3, 11)) and got[6].lang_pred in net.languages
    texts = spark.createDataFrame([(1, "日本語"), (2, "123 ٣ !"), (3, "the cat and the dog")], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in byte_cnn.predict(texts, net).orderBy("doc_id").collect()] == [False, True, False]
    assert byte_cnn.train(none.withColumn("lang", F.lit("x")), F.lit(True)) is None
    assert {r.lang_pred for r in byte_cnn.predict(odd, None).collect()} == {"und"} and byte_cnn.predict(none, net).count() == 0


def brute_rules(t):
    t = t or ""
    words, seen, dup = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    repeat = {k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(repeat) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeat), failed


def brute_grams(t):
    """Token unigrams and bigrams as byte runs of letters/digits or of other signs."""
    tok = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0D]+", (t or "").encode())
    return [(x,) for x in tok] + list(zip(tok, tok[1:]))


def test_quality_rules_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, sf).collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 and toxic = 0").collect()}
    raw, target = Counter(), Counter()
    grams = {r.doc_id: brute_grams(r.text) for r in docs}
    for d, g in grams.items():
        raw.update(g)
        if d in good:
            target.update(g)
    nr, nt = sum(raw.values()) + ngram_rules.BUCKETS, sum(target.values()) + ngram_rules.BUCKETS
    for r in docs:
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == brute_rules(r.text)
        # without bucket collisions; hashing moves a mean by little
        exact = np.mean([math.log((target[x] + 1) / nt) - math.log((raw[x] + 1) / nr) for x in grams[r.doc_id]])
        assert abs(g.score - exact) < 0.12
        assert g.kept == (not g.base_failed and g.score >= ngram_rules.THRESHOLD)


def test_quality_rules_odd_rows(spark, odd, none):
    ids = spark.createDataFrame([(7,), (None,), (7,)], "doc_id long")
    got = ngram_rules.apply_rules(odd, ids).collect()
    by = {r.doc_id: r for r in got}
    text = {r.doc_id: r.text for r in odd.collect()}
    assert len(got) == odd.count()
    assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(text[i]) for i, r in by.items())
    assert not by[1].kept and by[7].kept and by[8].score == by[9].score
    assert {r.score for r in ngram_rules.apply_rules(odd, ids.where("false")).collect()} == {0.0}
    assert ngram_rules.apply_rules(none, ids).count() == 0
    lines = spark.createDataFrame([(1, "a b\n\n \na b\nc\r\na b\nc\nc"), (2, "x y z w v " * 3 + "é ** |")], "doc_id long, text string")
    for r in ngram_rules.apply_rules(lines, ids).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules({1: "a b\n\n \na b\nc\r\na b\nc\nc", 2: "x y z w v " * 3 + "é ** |"}[r.doc_id])


def test_quality_rules_count_all_trusted_texts(spark, monkeypatch):
    docs = spark.range(20_500).select(F.col("id").alias("doc_id"), F.concat(F.lit("plain words of text number t"), "id").alias("text"))
    for most in (ngram_rules.BROADCAST_IDS, 10):  # ids broadcast, ids joined by shuffle
        monkeypatch.setattr(ngram_rules, "BROADCAST_IDS", most)
        # all texts are trusted: both sides have the same counts
        assert {r.score for r in ngram_rules.apply_rules(docs, docs.select("doc_id")).select("score").distinct().collect()} == {0.0}
