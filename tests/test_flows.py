"""Corpora written end to end (Z4, A19) and methods trained and scored."""

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quillspark.operators import checks, splits
from quillspark.plans import flows
from quillspark.sources import io


def tree(tmp_path, topics=("war", "sex", "tax", "art"), authors=6, each=5):
    rng = random.Random(2)
    for a in range(authors):
        for t in topics:
            for i in range(each):
                f = tmp_path / "in" / t / f"author{a}" / f"{i}.txt"
                f.parent.mkdir(parents=True, exist_ok=True)
                f.write_text(f"{t} " + " ".join(rng.choice([f"w{a}{k}" for k in range(5)] + ["the", "of"]) for _ in range(12)))
    same = tmp_path / "in" / "war" / "author0" / "copy.txt"
    same.write_text((tmp_path / "in" / "war" / "author0" / "0.txt").read_text())
    return str(tmp_path / "in" / "*" / "*" / "*.txt")


@pytest.mark.parametrize("kind,form", [("tree", "stratified"), ("topics", "cross"), ("unseen", "unseen")])
def test_corpora_keep_their_invariants(spark, tmp_path, kind, form):
    out = str(tmp_path / "out")
    bad = {r.check: r.n_bad for r in flows.build_corpus(spark, kind, tree(tmp_path), out).collect()}
    assert bad["text_in_two_splits"] == 0
    aa = spark.read.parquet(f"{out}/aa").collect()
    assert len(aa) == 120 and len({r.text_id for r in aa}) == 120  # the copy is gone
    parts = {s: [r for r in aa if r.split == s] for s in splits.SPLIT_NAMES}
    assert all(0.1 < len(p) / len(aa) < 0.7 for p in parts.values())
    seen = {s: {r.author_id for r in p} for s, p in parts.items()}
    if form == "unseen":
        assert not (seen["train"] & seen["test"]) and not (seen["train"] & seen["validation"])
    else:
        assert bad["labels_dense"] == 0 and bad["eval_labels_in_train"] == 0 and seen["test"] <= seen["train"]
    if form == "cross":
        units = {s: {r.category for r in p} for s, p in parts.items()}
        assert not (units["train"] & units["test"])
    for s in splits.SPLIT_NAMES:
        av = spark.read.parquet(f"{out}/av/{s}")
        assert checks.check_av_labels(av).first().n_bad == 0
        assert {r.text_id_a for r in av.collect()} <= {r.text_id for r in parts[s]}
    assert spark.read.json(f"{out}/stats").count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        flows.build_corpus(spark, kind, str(tmp_path / "in" / "*" / "*" / "*.txt"), out)


def test_whole_units_meet_their_shares(spark):
    rows = [(i, u) for u, n in [("a", 40), ("b", 30), (None, 20), ("c", 5), ("d", 5)] for i in range(n)]
    df = spark.createDataFrame(rows, "id long, unit string")
    got = splits.split_whole(df, "unit", (0.5, 0.5), ("x", "y"))
    assert got.count() == 100 and got.select("unit", "split").distinct().count() == 5
    assert splits.split_whole(df.where("false"), "unit").count() == 0
    sizes = [r["count"] for r in got.groupBy("split").count().collect()]
    assert max(sizes) <= 70


def test_a_corpus_from_a_table(spark, tmp_path):
    rows = [(f"a{i % 3}", f"text {i}") for i in range(30)] + [("a0", ""), ("a1", None), ("lonely", "one")]
    df = spark.createDataFrame(rows, "author string, text string")
    flows.build_corpus(spark, "tree", "", str(tmp_path / "o"), read=lambda s, p: df)
    assert spark.read.parquet(str(tmp_path / "o" / "aa")).count() == 30
    assert {r.author for r in spark.read.json(str(tmp_path / "o" / "authors")).collect()} == {"a0", "a1", "a2"}


def voices(n, seed):
    rng = random.Random(seed)
    letters = {0: "abcd ", 1: "uvwxyz ", 2: "mnopq "}
    return [(i, i % 3, "".join(rng.choice(letters[i % 3]) for _ in range(50))) for i in range(n)]


def test_train_and_score_attribution(spark):
    train = spark.createDataFrame(voices(30, 1), "text_id long, author_id long, text string")
    test = spark.createDataFrame([(100 + i, a, t) for i, a, t in voices(9, 2)], "text_id long, author_id long, text string")
    for method in ("entropy_authors", "ngrams"):
        got = flows.train_and_score(method, train, test).collect()
        assert len(got) == 9 and all(r.model == method and r.label == r.pred and 0 <= r.prob <= 1 for r in got)


def test_train_and_score_pairs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        same = i % 2
        a = [rng.gauss(0, 1) for _ in range(4)]
        b = [x + rng.gauss(0, 0.05) for x in a] if same else [x + 3 + rng.random() for x in a]
        rows.append((i, same, Vectors.dense(a), Vectors.dense(b)))
    df = spark.createDataFrame(rows, ["pair_id", "label", "features_a", "features_b"])
    got = flows.train_and_score("features", df.where("pair_id < 40"), df.where("pair_id >= 40")).collect()
    assert len(got) == 20 and all(r.label == r.pred for r in got)
    v = [t for _, _, t in voices(60, 5)]
    pairs = spark.createDataFrame([(i, int(i % 2 == 0), v[3 * i % 57], v[3 * i % 57 + (3 if i % 2 == 0 else 1)]) for i in range(40)], "pair_id long, label int, text0 string, text1 string")
    got = flows.train_and_score("entropy", pairs.where("pair_id < 26"), pairs.where("pair_id >= 26"))
    assert got.where("label = pred").count() == got.count() == 14
    with pytest.raises(ValueError):
        flows.train_and_score("magic", df, df)
    out = flows.evaluate_scores(got, got).first()
    assert out.accuracy == 1.0 and out.av_macro_accuracy == 1.0


# Z1, Z2 ---------------------------------------------------------------------

def test_forum_pairs_of_three_kinds_with_texts(spark, tmp_path):
    rng = random.Random(8)
    rows = [(100 * a + i, f"user{a}", " ".join(rng.choice(["red", "green", "blue", f"w{a}"]) for _ in range(26 + rng.randrange(40))), f"d{i % 2}")
            for a in range(12) for i in range(6)] + [(9000, "AutoModerator", "word " * 30, "d0"), (9001, "user0", "see http://x.y " + "word " * 30, "d0")]
    posts = spark.createDataFrame(rows, "post_id long, author string, text string, domain string")
    ids = flows.build_forum_pairs(posts)
    got = flows.build_forum_pairs(posts, str(tmp_path / "p"), with_texts=True)
    back = spark.read.parquet(str(tmp_path / "p"))
    assert {r.kind for r in back.select("kind").distinct().collect()} == {"profile", "in_domain", "cross_domain"}
    assert back.count() == ids.count() == got.count()
    text = {r[0]: r[2] for r in rows}
    for r in back.collect():
        assert (r.author_a == r.author_b) == r.label and r.text0 and r.text1 and "AutoModerator" not in (r.author_a, r.author_b)
        if r.kind == "profile":
            assert len(r.text0.split()) == r.len_a and len(r.text1.split()) == r.len_b
        else:
            assert (text[r.post_id_a], text[r.post_id_b]) == (r.text0, r.text1) and 9001 not in (r.post_id_a, r.post_id_b)


def test_short_post_pairs_with_a_language_step(spark, tmp_path):
    from quillspark.operators import models
    rng = random.Random(4)
    voc = {"en": ["the", "house", "and", "with", "water"], "fr": ["le", "château", "et", "avec", "où"]}
    rows = [("tweet", " ".join(rng.choice(voc["fr" if u == 5 else "en"]) for _ in range(30 + k)), f"u{u}") for u in range(6) for k in range(4)]
    tweets = spark.createDataFrame(rows, "type string, text string, user string")
    labelled = spark.createDataFrame([(" ".join(rng.choice(w) for _ in range(20)), lang) for lang, w in voc.items() for _ in range(10)], "text string, lang string")
    fitted = models.fit_language_id(labelled, "text", "lang", 1 << 12)
    got = flows.build_short_post_pairs(tweets, languages=["en"], language_model=fitted, out=str(tmp_path / "t"), with_texts=True).collect()
    assert got and all("u5" not in (r.author_a, r.author_b) and r.text0 and r.text1 for r in got)
    assert spark.read.parquet(str(tmp_path / "t")).count() == len(got)
    with pytest.raises(ValueError):
        flows.build_short_post_pairs(tweets, languages=["en"])
