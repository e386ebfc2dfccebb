"""Profile pairs (F7/F8/C6), episodes (F17) and flows on the smallest tables."""

from pyspark.sql import functions as F

from quillspark.operators import pairs, profiles, splits
from quillspark.sources import views

SF = "/root/testdata/sf0.001"


def _halves(spark):
    from quillspark.plans.catalog import forum_posts
    fp = forum_posts(spark, SF)
    users = splits.split_authors(fp, "author")
    d = views.table(spark, SF, "documents").select(F.col("doc_id").alias("post_id"), "text")
    posts = fp.select("author", "post_id").join(users.select("author", "split"), "author").join(d, "post_id")
    return profiles.profile_split(posts)


def test_profile_split_halves(spark):
    h = _halves(spark).collect()
    by = {}
    for r in h:
        by.setdefault(r.author, {})[r.side] = r
    for a, sides in by.items():
        assert set(sides) == {"a", "b"}
        for s in sides.values():
            assert s.len == len(s.text.split())      # separators counted like the reference


def test_profile_pairs_negatives_match_bucket(spark):
    h = _halves(spark)
    out = profiles.pairs_profile(h).collect()
    pos = [r for r in out if r.label]
    neg = [r for r in out if not r.label]
    assert len(neg) == len(pos)
    assert all(r.author_a != r.author_b for r in neg)
    assert all(r.author_a == r.author_b for r in pos)


def test_interval_edges_are_exact(spark):
    # every integer length inside [L1, L2] u [L3, L4] satisfies the predicate, the neighbours do not
    rows = [(a, lo, hi) for a in (1, 7, 30, 101) for lo, hi in ((0.0, 0.1), (0.1, 0.35), (0.2, 1.0), (0.05, 0.05))]
    df = spark.createDataFrame(rows, "len_a long, lo double, hi double")
    for r in profiles._length_intervals(df).collect():
        def ok(h):
            return h >= 0 and r.len_a + h > 0 and r.lo <= abs(r.len_a - h) / (r.len_a + h) <= r.hi
        want = {h for h in range(0, 2000) if ok(h)}
        got = set(range(r.L1, r.L2 + 1)) | set(range(r.L3, min(r.L4, 1999) + 1))
        assert got == want, (r.len_a, r.lo, r.hi)


def test_sample_episodes(spark):
    d = views.table(spark, SF, "documents").select(F.col("source").alias("author_id"), F.col("doc_id").alias("text_id"))
    ep = pairs.sample_episodes(d, 5, 2, 20, "author_id", "text_id").collect()
    by = {}
    for r in ep:
        by.setdefault(r.episode, []).append(r)
    assert len(by) == 20
    for rows in by.values():
        assert len({r.author_id for r in rows}) == 5
        assert sorted({r.label for r in rows}) == [0, 1, 2, 3, 4]
        assert len({r.text_id for r in rows}) == 20
        assert sum(r.role == "adapt" for r in rows) == 10


def test_evaluate_flow(spark):
    from quillspark.plans import flows
    s = views.scores(spark, SF)
    out = flows.evaluate_scores(s, s).collect()
    assert out and all(0.0 <= r.accuracy <= 1.0 for r in out)
