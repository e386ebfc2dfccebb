"""Invariants of splits and pair builders (the reference's corpus checks)."""

from pyspark.sql import functions as F

from quillspark.operators import pairs, splits
from quillspark.sources import views

SF = "/root/testdata/sf0.001"


def _posts(spark):
    p = views.posts(spark, SF, fine=True)
    return p.filter((F.col("text_length") > 25) & (F.col("text_length") < 1000))


def test_split_authors_disjoint_and_sized(spark):
    p = _posts(spark)
    u = splits.split_authors(p, "author").collect()
    n = len(u)
    by = {}
    for r in u:
        by.setdefault(r.split, []).append(r)
    import math
    h = math.ceil(0.4 * n)
    t = math.ceil(0.5 * h)
    assert len(by["test"]) == t and len(by["validation"]) == h - t and len(by["train"]) == n - h
    for name, rs in by.items():
        assert sorted(r.split_idx for r in rs) == list(range(len(rs)))
        assert all(r.split_n == len(rs) for r in rs)


def test_in_domain_pairs_invariants(spark):
    p = _posts(spark)
    out = pairs.pairs_in_domain(p).collect()
    dom = {r.post_id: (r.author, r.domain) for r in p.collect()}
    users = {r.author: r.split for r in splits.split_authors(p, "author").collect()}
    pos = [r for r in out if r.label]
    neg = [r for r in out if not r.label]
    for r in out:
        a, b = dom[r.post_id_a], dom[r.post_id_b]
        assert a[0] == r.author_a and b[0] == r.author_b
        assert a[1] == b[1]                       # same domain (in-domain rule)
        assert r.label == (r.author_a == r.author_b)
        assert users[r.author_a] == users[r.author_b] == r.split
    assert all(r.post_id_a < r.post_id_b for r in pos)
    per_user = {}
    for r in pos:
        per_user.setdefault(r.author_a, set()).add((r.post_id_a, r.post_id_b))
    assert all(len(s) <= 2 for s in per_user.values())
    assert sum(len(s) for s in per_user.values()) == len(pos)   # positives are distinct
    assert len(neg) <= len(pos)


def test_cross_domain_pairs_differ_in_domain(spark):
    p = _posts(spark)
    dom = {r.post_id: r.domain for r in p.collect()}
    for r in pairs.pairs_cross_domain(p).collect():
        assert dom[r.post_id_a] != dom[r.post_id_b]


def test_pairs_random_and_per_text(spark):
    p = views.posts(spark, SF, fine=True).select("author", "post_id")
    out = pairs.pairs_random(p).collect()
    users = {r.author: r.split for r in splits.split_authors(p, "author").collect()}
    for r in out:
        assert r.label == (r.author_a == r.author_b)
        assert users[r.author_b] == r.split      # negatives drawn inside the split (q3)
        if r.label:
            assert r.post_id_a != r.post_id_b
    d = views.table(spark, SF, "documents").select(F.col("source").alias("author_id"), F.col("doc_id").alias("text_id"))
    ppt = pairs.pairs_per_text(d, "author_id", "text_id").collect()
    for r in ppt:
        assert (r.label == 1) == (r.author_a == r.author_b)
        assert r.text_id_a != r.text_id_b        # q17: never the text itself
    # one positive and one negative per text of authors with >= 2 texts
    assert len(ppt) == 2 * d.count()


def test_stratified_split_shares(spark):
    d = views.posts(spark, SF).select("post_id", "author")
    s = splits.split_stratified(d, "author", "post_id", (0.6, 0.2, 0.2)).collect()
    counts = {}
    for r in s:
        counts.setdefault(r.author, {}).setdefault(r.split, 0)
        counts[r.author][r.split] += 1
    import math
    for a, c in counts.items():
        n = sum(c.values())
        assert c.get("train", 0) == math.floor(n * 0.6)
        assert c.get("train", 0) + c.get("validation", 0) == math.floor(n * 0.8)


def test_global_rank_is_dense_and_ordered(spark):
    from quillspark.operators.ranking import global_rank, ordinal_in_group
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 3).alias("g"))
    r = global_rank(df, ["v"], "rank").orderBy("v").collect()
    assert [x["rank"] for x in r] == list(range(1, 1001))
    o = ordinal_in_group(df, ["g"], ["v"], "o").collect()
    for g in range(3):
        vs = sorted((x.v, x.o) for x in o if x.g == g)
        assert [x[1] for x in vs] == list(range(len(vs)))


def test_negatives_retry_until_every_positive_is_served(spark):
    # 8 users, each with two posts in a domain of their own, except u0 and u1 who
    # share domain X: in-domain negatives exist only between u0 and u1, so most
    # keyed attempts fail and further rounds are needed.
    rows, pid = [], 0
    for u in range(8):
        dom = "X" if u < 2 else f"D{u}"
        for _ in range(2):
            rows.append((f"u{u}", pid, dom))
            pid += 1
    posts = spark.createDataFrame(rows, "author string, post_id long, domain string")
    users = spark.createDataFrame([(f"u{u}", "train", u, 8) for u in range(8)],
                                  "author string, split string, split_idx long, split_n long")
    out = pairs.pairs_in_domain(posts, users).collect()
    pos = [r for r in out if r.label]
    neg = [r for r in out if not r.label]
    assert len(pos) == 8 and len(neg) == 8
    assert all({r.author_a, r.author_b} == {"u0", "u1"} for r in neg)


def test_negatives_by_domain_need_no_rounds(spark):
    from quillspark.operators import pairs
    # 40 users with a domain of their own, one domain shared by two of them: almost no drawn user pair is allowed
    rows = [(f"u{k:02d}", 10 * k + j, f"d{k}") for k in range(40) for j in range(3)]
    rows += [(f"u{k:02d}", 1000 + 10 * k + j, "shared") for k in (3, 4) for j in range(2)]
    posts = spark.createDataFrame(rows, "author string, post_id long, domain string")
    users = spark.createDataFrame([(f"u{k:02d}", "train", k, 40) for k in range(40)], "author string, split string, split_idx long, split_n long")
    where = {}
    for a, i, d in rows:
        where[i] = (a, d)
    for mode in ("in_domain", "cross_domain"):
        got = pairs.pairs_by_domain(posts, users, mode=mode).collect()
        pos, neg = [r for r in got if r.label], [r for r in got if not r.label]
        if mode == "in_domain":
            assert len(pos) == len(neg) and len(pos) >= 40
        else:
            assert len(pos) == len(neg) > 0
        for r in neg:
            (a, d), (b, e) = where[r.post_id_a], where[r.post_id_b]
            assert (a, b) == (r.author_a, r.author_b) and a != b and (d == e) == (mode == "in_domain")
        assert len({(r.anchor, r.slot) for r in neg}) == len(neg)
    lone = posts.filter("domain <> 'shared'")
    assert not [r for r in pairs.pairs_by_domain(lone, users, mode="in_domain").collect() if not r.label]


def test_direct_cross_domain_negatives_skip_the_only_user(spark):
    from quillspark.operators import pairs
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 3, "x"), ("c", 4, "x")]
    ix = pairs.index_posts(spark.createDataFrame(rows, "author string, post_id long, domain string"), domain_col="domain").selectExpr("*", "'t' AS split")
    need = spark.createDataFrame([("t", f"p{k}", k) for k in range(60)], "split string, author_a string, slot long")
    got = pairs.direct_negatives(ix, need, "cross_domain").collect()
    assert len(got) == 60 and {frozenset((r.author_a, r.author_b)) for r in got} == {frozenset("ab"), frozenset("ac")}
