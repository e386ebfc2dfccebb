"""Same-author / different-author pair building.

No operator enumerates all pairs of a group or draws from Python's RNG:

* positives are *unranked*: a user with n posts has n(n-1)/2 pairs; a keyed
  ordinal in that range is mapped back to (i, j) with the closed form of the
  colex order, so the cost is per draw, not per pair;
* a "random other author" is a keyed index j in 0..A-2, shifted past the
  anchor's own index, followed by an equi join on the author index; a random
  text of that author is another keyed index and an equi join on
  (author, text ordinal);
* a negative with a domain rule weighs the allowed (domain of a, domain of b)
  cells by n_a(d)*n_b(e), draws an ordinal and maps it back to (cell, i, j).

Pair rows are id-only (split, label, author_a, post_id_a, author_b, post_id_b,
...); ``attach_posts`` joins the post columns back at the end so the shuffles
above stay narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import key
from quillspark.operators.ranking import ordinal_in_group
from quillspark.operators.splits import split_authors
from quillspark.session import cut_lineage

PAIR_COLS = ["split", "label", "author_a", "post_id_a", "author_b", "post_id_b"]


def _pairs_below(j: Column) -> Column:
    """j(j-1)/2 in integers."""
    return F.shiftright(j * (j - 1), 1)


def _unrank_j(r: Column) -> Column:
    """Largest j with j(j-1)/2 <= r (colex order of 2-subsets), exact for all r under 2^62.

    The closed form in doubles is less than one off there; integers decide."""
    from quillspark.operators.features import let

    def exact(j):
        return j - (_pairs_below(j) > r).cast("bigint") + (_pairs_below(j + 1) <= r).cast("bigint")
    return let(F.floor((F.lit(1.0) + F.sqrt(F.lit(1.0) + F.lit(8.0) * r.cast("double"))) / F.lit(2.0)).cast("bigint"), exact)


def distinct_draws(n_pool: Column, m: int, key_fn) -> Column:
    """m different ordinals of [0, n_pool), n_pool >= m, in draw order (array).

    Draws without replacement by the shift rule: the i-th draw is uniform in [0, n_pool - i) and is moved past every
    earlier pick <= it, in ascending order, so nothing is enumerated."""
    def step(acc, i):
        raw = key_fn(i) % (n_pool - i)
        shifted = F.aggregate(F.array_sort(acc), raw, lambda x, c: x + (x >= c).cast("bigint"))
        return F.concat(acc, F.array(shifted))
    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), F.lit(m - 1).cast("bigint")), F.array().cast("array<bigint>"), step)


def index_posts(posts: DataFrame, author_col: str = "author", id_col: str = "post_id",
                domain_col: str | None = None, skew_safe: bool = True) -> DataFrame:
    """Add ``tord`` (ordinal of the post inside its author by id) and, with a
    domain column, ``dord`` (ordinal inside (author, domain))."""
    out = ordinal_in_group(posts, [author_col], [id_col], col="tord", skew_safe=skew_safe)
    if domain_col is not None:
        out = ordinal_in_group(out, [author_col, domain_col], [id_col], col="dord", skew_safe=skew_safe)
    return out


# ---------------------------------------------------------------------------
# in-domain / cross-domain pairs
# ---------------------------------------------------------------------------

def _domain_cells(counts: DataFrame, mode: str) -> DataFrame:
    """Per user, the allowed (d, e) domain cells of a positive pair with their
    pair counts, ordered (d, e), with running sums. Bounded by domains^2 per user."""
    if mode == "in_domain":
        cells = counts.select("split", "author", F.col("domain").alias("d"), F.col("domain").alias("e"),
                              _pairs_below(F.col("n")).alias("w"),
                              F.col("n").alias("n_d"), F.col("n").alias("n_e"))
    elif mode == "cross_domain":
        a = counts.select("split", "author", F.col("domain").alias("d"), F.col("n").alias("n_d"))
        b = counts.select("author", F.col("domain").alias("e"), F.col("n").alias("n_e"))
        cells = (a.join(b, "author").filter(F.col("d") < F.col("e"))
                 .select("split", "author", "d", "e", (F.col("n_d") * F.col("n_e")).alias("w"), "n_d", "n_e"))
    else:
        raise ValueError(f"unknown mode {mode}")
    cells = cells.filter(F.col("w") > 0)
    w = Window.partitionBy("author").orderBy("d", "e")
    return (cells.withColumn("cum", F.coalesce(F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("total", F.sum("w").over(Window.partitionBy("author"))))


def positive_pairs_by_domain(indexed: DataFrame, mode: str = "in_domain", max_per_user: int = 2,
                             seed: int = 42) -> DataFrame:
    """F6 positives: up to ``max_per_user`` (any number) distinct pairs per user whose domains
    are equal (in_domain) or differ (cross_domain); all of them when there are fewer.

    ``indexed`` has split, author, post_id, domain, dord (see ``index_posts``).
    """
    counts = indexed.groupBy("split", "author", "domain").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    cells = _domain_cells(counts, mode)
    totals = cells.select("split", "author", "total").distinct()
    m = max_per_user
    # Distinct ordinals in [0, T): all of them if T <= m, else m keyed draws without replacement.
    T = F.col("total")
    drawn = distinct_draws(T, m, lambda i: key(seed, "pos", mode, F.col("author"), i))
    draws = totals.select("split", "author", F.posexplode(F.when(T <= m, F.sequence(F.lit(0).cast("bigint"), T - 1)).otherwise(drawn)).alias("slot", "o"))
    picked = (draws.join(cells.drop("split"), "author")
              .filter((F.col("o") >= F.col("cum")) & (F.col("o") < F.col("cum") + F.col("w")))
              .withColumn("r", F.col("o") - F.col("cum")))
    if mode == "in_domain":
        j = _unrank_j(F.col("r"))
        picked = picked.withColumn("j_ord", j).withColumn("i_ord", F.col("r") - _pairs_below(F.col("j_ord")))
    else:
        picked = picked.withColumn("i_ord", F.expr("r div n_e")).withColumn("j_ord", F.col("r") % F.col("n_e"))
    picked = picked.select("split", "author", "slot", "d", "e",
                           F.col("i_ord").cast("bigint").alias("i_ord"), F.col("j_ord").cast("bigint").alias("j_ord"))
    pa = indexed.select("author", F.col("domain").alias("d"), F.col("dord").alias("i_ord"), F.col("post_id").alias("pa"))
    pb = indexed.select("author", F.col("domain").alias("e"), F.col("dord").alias("j_ord"), F.col("post_id").alias("pb"))
    out = picked.join(pa, ["author", "d", "i_ord"]).join(pb, ["author", "e", "j_ord"])
    lo = F.least("pa", "pb")
    hi = F.greatest("pa", "pb")
    return out.select("split", F.lit(True).alias("label"), F.col("author").alias("author_a"), lo.alias("post_id_a"),
                      F.col("author").alias("author_b"), hi.alias("post_id_b"), F.col("slot").cast("bigint").alias("slot"))


def negative_pairs_by_domain(indexed: DataFrame, users: DataFrame, positives: DataFrame, mode: str = "in_domain",
                             attempts: int = 8, seed: int = 42, first_attempt: int = 0) -> DataFrame:
    """F6 negatives: one per positive, from two distinct users of the same split whose
    posts are drawn uniformly among the pairs allowed by the domain rule.

    Each positive gets ``attempts`` keyed user-pair draws numbered from
    ``first_attempt``; the first draw that has an allowed post pair is used.
    ``pairs_by_domain`` draws directly (``direct_negatives``) for positives left
    without a negative; where the split admits no pair the shortfall is
    reported by ``negative_shortfall`` (the reference would loop forever).
    """
    pos = positives.select("split", F.col("author_a").alias("anchor"), "slot")
    att = pos.withColumn("t", F.explode(F.sequence(F.lit(first_attempt), F.lit(first_attempt + attempts - 1))))
    u = users.select("split", "split_idx", "split_n", "author")
    n_split = u.select("split", "split_n").distinct()
    att = att.join(F.broadcast(n_split), "split").filter(F.col("split_n") >= 2)
    ka = key(seed, "neg", mode, "a", F.col("anchor"), F.col("slot"), F.col("t")) % F.col("split_n")
    kb = key(seed, "neg", mode, "b", F.col("anchor"), F.col("slot"), F.col("t")) % (F.col("split_n") - 1)
    att = att.withColumn("ia", ka).withColumn("ib", kb).withColumn("ib", F.col("ib") + (F.col("ib") >= F.col("ia")).cast("bigint"))
    ua = u.select("split", F.col("split_idx").alias("ia"), F.col("author").alias("ua"))
    ub = u.select("split", F.col("split_idx").alias("ib"), F.col("author").alias("ub"))
    att = att.join(ua, ["split", "ia"]).join(ub, ["split", "ib"]).select("split", "anchor", "slot", "t", "ua", "ub")
    counts = indexed.groupBy("author", "domain").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    ca = counts.select(F.col("author").alias("ua"), F.col("domain").alias("d"), F.col("n").alias("n_d"))
    cb = counts.select(F.col("author").alias("ub"), F.col("domain").alias("e"), F.col("n").alias("n_e"))
    if mode == "in_domain":
        # equi join on the domain: at most (domains of a) rows per attempt
        cells = att.join(ca, "ua").join(cb.withColumnRenamed("e", "d"), ["ub", "d"]).withColumn("e", F.col("d"))
    else:
        cells = att.join(ca, "ua").join(cb, ["ub"]).filter(F.col("d") != F.col("e"))
    cells = cells.withColumn("w", F.col("n_d") * F.col("n_e"))
    aid = ["split", "anchor", "slot", "t"]
    wa = Window.partitionBy(*aid).orderBy("d", "e")
    cells = (cells.withColumn("cum", F.coalesce(F.sum("w").over(wa.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("w_all", F.sum("w").over(Window.partitionBy(*aid))))
    first_ok = cells.groupBy("split", "anchor", "slot").agg(F.min("t").alias("t"))
    chosen = cells.join(first_ok, ["split", "anchor", "slot", "t"])
    o = key(seed, "neg", mode, "pick", F.col("anchor"), F.col("slot"), F.col("t")) % F.col("w_all")
    chosen = (chosen.withColumn("o", o)
              .filter((F.col("o") >= F.col("cum")) & (F.col("o") < F.col("cum") + F.col("w")))
              .withColumn("r", F.col("o") - F.col("cum"))
              .select("split", "anchor", "slot", "ua", "ub", "d", "e",
                      F.expr("r div n_e").alias("i_ord"),
                      (F.col("r") % F.col("n_e")).cast("bigint").alias("j_ord")))
    pa = indexed.select(F.col("author").alias("ua"), F.col("domain").alias("d"), F.col("dord").alias("i_ord"),
                        F.col("post_id").alias("post_id_a"))
    pb = indexed.select(F.col("author").alias("ub"), F.col("domain").alias("e"), F.col("dord").alias("j_ord"),
                        F.col("post_id").alias("post_id_b"))
    out = chosen.join(pa, ["ua", "d", "i_ord"]).join(pb, ["ub", "e", "j_ord"])
    return out.select("split", F.lit(False).alias("label"), F.col("ua").alias("author_a"), "post_id_a",
                      F.col("ub").alias("author_b"), "post_id_b", F.col("slot").cast("bigint").alias("slot"),
                      F.col("anchor"))


def indexed_posts(posts: DataFrame, users: DataFrame | None = None, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(posts with split, domain and ordinals; users with split), ids only, both written once: many branches read them."""
    posts = cut_lineage(posts.select("author", "post_id", "domain"))
    users = cut_lineage(split_authors(posts, "author", seed=seed) if users is None else users)
    # the domain rule needs no ordinal inside the author alone
    indexed = ordinal_in_group(posts, ["author", "domain"], ["post_id"], col="dord")
    return cut_lineage(indexed.join(users.select("author", "split"), "author")), users


def pairs_by_domain(posts: DataFrame, users: DataFrame | None = None, mode: str = "in_domain", max_per_user: int = 2,
                    attempts: int = 8, seed: int = 42) -> DataFrame:
    """``pairs_in_domain`` / ``pairs_cross_domain`` for all splits.

    ``posts``: author, post_id, domain. ``users``: output of ``split_authors``
    (computed here when missing). Returns id-only pair rows.
    """
    indexed, users = indexed_posts(posts, users, seed)
    pos = cut_lineage(positive_pairs_by_domain(indexed, mode, max_per_user, seed))
    neg = cut_lineage(negative_pairs_by_domain(indexed, users, pos, mode, attempts, seed))
    # positives whose attempts all failed: one direct draw among the pairs their split allows
    missing = cut_lineage(pos.join(neg.select("split", F.col("anchor").alias("author_a"), "slot"), ["split", "author_a", "slot"], "left_anti"))
    if not missing.isEmpty():
        neg = neg.unionByName(direct_negatives(indexed, missing, mode, seed))
    return pos.withColumn("anchor", F.col("author_a")).unionByName(neg)


def direct_negatives(indexed: DataFrame, missing: DataFrame, mode: str, seed: int = 42) -> DataFrame:
    """Negatives for positives without one, in one plan: a keyed ordinal picks a (domain, domain) cell of the
    split by its number of ordered user pairs, the users are unranked inside the cell (the second one skips the
    first), and each user's post is drawn by key. A split that allows no pair gives no rows."""
    held = indexed.groupBy("split", "domain", "author").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    held = cut_lineage(ordinal_in_group(held, ["split", "domain"], ["author"], col="at"))
    size = held.groupBy("split", "domain").agg(F.count(F.lit(1)).cast("bigint").alias("u"))
    if mode == "in_domain":
        cells = size.select("split", F.col("domain").alias("d"), F.col("domain").alias("e"), F.col("u").alias("ud"), F.col("u").alias("ue"),
                            F.lit(None).cast("bigint").alias("skip"), (F.col("u") * (F.col("u") - 1)).alias("w"))
    else:
        x, y = held.select("split", F.col("domain").alias("d"), "author", "at"), held.select("split", F.col("domain").alias("e"), "author")
        both = x.join(y, ["split", "author"]).filter("d <> e").groupBy("split", "d", "e").agg(F.count(F.lit(1)).cast("bigint").alias("c"), F.min("at").alias("at"))
        cells = (size.select("split", F.col("domain").alias("d"), F.col("u").alias("ud"))
                 .join(size.select("split", F.col("domain").alias("e"), F.col("u").alias("ue")), "split").filter("d <> e")
                 .join(both, ["split", "d", "e"], "left").fillna({"c": 0}))
        # the only user of e cannot come first
        cells = cells.withColumn("skip", F.when((F.col("ue") == 1) & (F.col("c") == 1), F.col("at"))).withColumn("w", F.col("ud") * F.col("ue") - F.col("c"))
    cells = cells.filter("w > 0").select("split", "d", "e", "ud", "ue", "skip", "w")
    order = Window.partitionBy("split").orderBy("d", "e")  # a row per pair of domains
    cells = cells.withColumn("end", F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # one row a split: its cells in order, so that a missing positive meets one row and picks its cell there
    cells = cells.groupBy("split").agg(F.array_sort(F.collect_list(F.struct("end", "d", "e", "ud", "ue", "skip"))).alias("cells"), F.max("end").alias("w_all"))

    def draw(what, n):
        return key(seed, "neg", mode, what, F.col("anchor"), F.col("slot")) % n

    got = missing.select("split", F.col("author_a").alias("anchor"), "slot").join(cells, "split").withColumn("o", draw("cell", F.col("w_all")))
    got = got.withColumn("cell", F.element_at("cells", F.size(F.filter("cells", lambda c: c["end"] <= F.col("o"))) + 1))
    got = got.select("split", "anchor", "slot", *[F.col(f"cell.{c}").alias(c) for c in ("d", "e", "ud", "ue", "skip")])
    ia = draw("first", F.col("ud") - F.when(F.col("skip").isNull(), 0).otherwise(1))
    got = got.withColumn("ia", ia).withColumn("ia", F.col("ia") + F.when(F.col("ia") >= F.col("skip"), 1).otherwise(0))
    first = held.select("split", F.col("domain").alias("d"), F.col("at").alias("ia"), F.col("author").alias("ua"), F.col("n").alias("na"))
    own = held.select("split", F.col("domain").alias("e"), F.col("author").alias("ua"), F.col("at").alias("own"))
    got = got.join(first, ["split", "d", "ia"]).join(own, ["split", "e", "ua"], "left")
    ib = draw("second", F.col("ue") - F.when(F.col("own").isNull(), 0).otherwise(1))
    got = got.withColumn("ib", ib).withColumn("ib", F.col("ib") + F.when(F.col("ib") >= F.col("own"), 1).otherwise(0))
    second = held.select("split", F.col("domain").alias("e"), F.col("at").alias("ib"), F.col("author").alias("ub"), F.col("n").alias("nb"))
    got = (got.join(second, ["split", "e", "ib"]).withColumn("i_ord", draw("post_a", F.col("na"))).withColumn("j_ord", draw("post_b", F.col("nb"))))
    pa = indexed.select(F.col("author").alias("ua"), F.col("domain").alias("d"), F.col("dord").alias("i_ord"), F.col("post_id").alias("post_id_a"))
    pb = indexed.select(F.col("author").alias("ub"), F.col("domain").alias("e"), F.col("dord").alias("j_ord"), F.col("post_id").alias("post_id_b"))
    out = got.join(pa, ["ua", "d", "i_ord"]).join(pb, ["ub", "e", "j_ord"])
    return out.select("split", F.lit(False).alias("label"), F.col("ua").alias("author_a"), "post_id_a", F.col("ub").alias("author_b"), "post_id_b",
                      F.col("slot").cast("bigint").alias("slot"), "anchor")


def pairs_in_domain(posts: DataFrame, users: DataFrame | None = None, **kw) -> DataFrame:
    return pairs_by_domain(posts, users, mode="in_domain", **kw)


def pairs_cross_domain(posts: DataFrame, users: DataFrame | None = None, **kw) -> DataFrame:
    return pairs_by_domain(posts, users, mode="cross_domain", **kw)


def negative_shortfall(pairs: DataFrame) -> DataFrame:
    """Per split: positives, negatives and how many negatives are missing (q5)."""
    return pairs.groupBy("split").agg(
        F.count_if(F.col("label")).cast("bigint").alias("n_pos"),
        F.count_if(~F.col("label")).cast("bigint").alias("n_neg"),
    ).withColumn("shortfall", F.col("n_pos") - F.col("n_neg"))


def attach_posts(pairs: DataFrame, posts: DataFrame, id_col: str = "post_id") -> DataFrame:
    """Nest the post columns as ``post_a`` / ``post_b`` structs (the reference's PostPair)."""
    cols = [c for c in posts.columns if c != id_col]
    a = posts.select(F.col(id_col).alias("post_id_a"), F.struct(*[F.col(c) for c in cols]).alias("post_a"))
    b = posts.select(F.col(id_col).alias("post_id_b"), F.struct(*[F.col(c) for c in cols]).alias("post_b"))
    return pairs.join(a, "post_id_a").join(b, "post_id_b")


# ---------------------------------------------------------------------------
# random pairs per author (short-post corpora)
# ---------------------------------------------------------------------------

def author_table(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Per author: split, split_idx, split_n and n_texts."""
    n = posts.groupBy("author").agg(F.count(F.lit(1)).cast("bigint").alias("n_texts"))
    return users.join(n, "author")


def pairs_random(posts: DataFrame, users: DataFrame | None = None, pos_per_author: int = 2,
                 neg_per_author: int = 2, seed: int = 42, negatives_from: str = "split") -> DataFrame:
    """per author ``pos_per_author`` positives (two different texts, drawn
    independently each time) and ``neg_per_author`` negatives (own text + a
    text of a uniformly drawn other author).

    ``negatives_from='split'`` draws the other author inside the anchor's split
    (no text leaks across splits, q3); ``'all'`` draws from every split like
    the reference.
    """
    posts = cut_lineage(posts.select("author", "post_id"))
    if users is None:
        users = split_authors(posts, "author", seed=seed)
    users = cut_lineage(users)
    idx = cut_lineage(index_posts(posts))
    auth = author_table(idx, users)
    texts = idx.select("author", "tord", "post_id")
    # positives ---------------------------------------------------------------
    pos = auth.filter(F.col("n_texts") >= 2).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(pos_per_author - 1))))
    i = key(seed, "f5", "pi", F.col("author"), F.col("slot")) % F.col("n_texts")
    j0 = key(seed, "f5", "pj", F.col("author"), F.col("slot")) % (F.col("n_texts") - 1)
    pos = pos.withColumn("ia", i).withColumn("jb", j0 + (j0 >= F.col("ia")).cast("bigint"))
    pos = (pos.join(texts.select("author", F.col("tord").alias("ia"), F.col("post_id").alias("post_id_a")), ["author", "ia"])
           .join(texts.select("author", F.col("tord").alias("jb"), F.col("post_id").alias("post_id_b")), ["author", "jb"])
           .select("split", F.lit(True).alias("label"), F.col("author").alias("author_a"), "post_id_a",
                   F.col("author").alias("author_b"), "post_id_b", F.col("slot").cast("bigint").alias("slot")))
    # negatives ---------------------------------------------------------------
    if negatives_from == "split":
        pool_n, own_idx = F.col("split_n"), F.col("split_idx")
        other = users.select(F.col("split"), F.col("split_idx").alias("ob"), F.col("author").alias("author_b"))
        on = ["split", "ob"]
    elif negatives_from == "all":
        from quillspark.operators.ranking import dense_ids
        g = dense_ids(users, ["author"], ["author"], id_col="gidx")
        total = users.agg(F.count(F.lit(1)).cast("bigint").alias("g_n"))
        auth = auth.join(g, "author").crossJoin(F.broadcast(total))
        pool_n, own_idx = F.col("g_n"), F.col("gidx")
        other = g.select(F.col("gidx").alias("ob"), F.col("author").alias("author_b"))
        on = ["ob"]
    else:
        raise ValueError(negatives_from)
    neg = auth.filter(pool_n >= 2).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(neg_per_author - 1))))
    neg = neg.withColumn("ia", key(seed, "f5", "ni", F.col("author"), F.col("slot")) % F.col("n_texts"))
    b0 = key(seed, "f5", "nb", F.col("author"), F.col("slot")) % (pool_n - 1)
    neg = neg.withColumn("ob", b0 + (b0 >= own_idx).cast("bigint"))
    neg = neg.join(other, on)
    nb = auth.select(F.col("author").alias("author_b"), F.col("n_texts").alias("n_b"))
    neg = neg.join(nb, "author_b").withColumn("jb", key(seed, "f5", "nj", F.col("author"), F.col("slot")) % F.col("n_b"))
    neg = (neg.join(texts.select("author", F.col("tord").alias("ia"), F.col("post_id").alias("post_id_a")), ["author", "ia"])
           .join(texts.select(F.col("author").alias("author_b"), F.col("tord").alias("jb"), F.col("post_id").alias("post_id_b")),
                 ["author_b", "jb"])
           .select("split", F.lit(False).alias("label"), F.col("author").alias("author_a"), "post_id_a", "author_b",
                   "post_id_b", F.col("slot").cast("bigint").alias("slot")))
    return pos.unionByName(neg)


# ---------------------------------------------------------------------------
# Pairs anchored on every text
# ---------------------------------------------------------------------------

def _text_frame(df: DataFrame, author_col: str, id_col: str):
    from quillspark.operators.ranking import dense_ids
    base = cut_lineage(df.select(F.col(author_col).alias("author"), F.col(id_col).alias("text_id")))
    idx = index_posts(base, "author", "text_id")
    n = base.groupBy("author").agg(F.count(F.lit(1)).cast("bigint").alias("n_texts"))
    ids = dense_ids(base, ["author"], ["text_id"], id_col="aidx")
    A = ids.agg(F.count(F.lit(1)).cast("bigint").alias("A"))
    authors = cut_lineage(ids.join(n, "author").crossJoin(F.broadcast(A)))
    return cut_lineage(idx.join(authors, "author")), authors


def pairs_per_text(df: DataFrame, author_col: str = "author_id", id_col: str = "text_id", seed: int = 42,
                   passes: int = 1, mode: str = "both") -> DataFrame:
    """Pairs anchored on each text.

    * ``mode='both'`` (F9, F11, F13): one positive with a different text of the
      same author and one negative with a text of a different author; authors
      with fewer than 2 texts are skipped; ``passes`` > 1 repeats the draw with
      the pass number in the key (F11, F13).
    * ``mode='coin'`` (F10): one pair per text, a keyed coin picks same (another
      text of the author) or different author.
    Output: (pass, text_id_a, author_a, text_id_b, author_b, label int).
    """
    idx, authors = _text_frame(df, author_col, id_col)
    anchors = idx.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    if mode == "both":
        anchors = anchors.filter(F.col("n_texts") >= 2)
        pos = anchors.withColumn("label", F.lit(1))
        neg = anchors.withColumn("label", F.lit(0))
        rows = pos.unionByName(neg)
    elif mode == "coin":
        coin = key(seed, "coin", F.col("pass"), F.col("text_id")) % 2
        rows = anchors.filter((F.col("n_texts") >= 2) | (coin == 0)).withColumn("label", coin.cast("int"))
    else:
        raise ValueError(mode)
    rows = rows.filter((F.col("label") == 1) | (F.col("A") >= 2))
    kj = key(seed, "ppt", "same", F.col("pass"), F.col("text_id")) % (F.col("n_texts") - 1)
    kb = key(seed, "ppt", "other", F.col("pass"), F.col("text_id")) % (F.col("A") - 1)
    rows = rows.withColumn("jb", F.when(F.col("label") == 1, kj + (kj >= F.col("tord")).cast("bigint")))
    rows = rows.withColumn("ob", F.when(F.col("label") == 0, kb + (kb >= F.col("aidx")).cast("bigint")))
    other = authors.select(F.col("aidx").alias("ob"), F.col("author").alias("author_o"), F.col("n_texts").alias("n_o"))
    rows = rows.join(other, "ob", "left")
    rows = rows.withColumn("author_b", F.when(F.col("label") == 1, F.col("author")).otherwise(F.col("author_o")))
    ko = key(seed, "ppt", "otext", F.col("pass"), F.col("text_id")) % F.col("n_o")
    rows = rows.withColumn("jb", F.when(F.col("label") == 1, F.col("jb")).otherwise(ko))
    t = idx.select(F.col("author").alias("author_b"), F.col("tord").alias("jb"), F.col("text_id").alias("text_id_b"))
    out = rows.join(t, ["author_b", "jb"])
    return out.select(F.col("pass").cast("bigint").alias("pass"), F.col("text_id").alias("text_id_a"),
                      F.col("author").alias("author_a"), "text_id_b", "author_b", F.col("label").cast("int").alias("label"))


def augment_pairs(df: DataFrame, author_col: str = "author_id", id_col: str = "text_id", seed: int = 42) -> DataFrame:
    """sample per-text pairs twice and keep the distinct ones."""
    p = pairs_per_text(df, author_col, id_col, seed, passes=2)
    return p.select("text_id_a", "author_a", "text_id_b", "author_b", "label").distinct()


# ---------------------------------------------------------------------------
# mixing pair sets
# ---------------------------------------------------------------------------

def mix_pair_sets(sets: dict[str, DataFrame], n_per_label: int | dict[str, int], seed: int = 42) -> DataFrame:
    """per source set and split, n positives and n negatives (keyed choice),
    concatenated; user ids stay top-level columns, the ``source`` is kept.

    Counts of key buckets say which rows can be among the n of a (split, label);
    only those are ranked, in range partitions, so a label is not one task.
    """
    from quillspark.operators.ranking import first_by_key
    parts = []
    for name, df in sets.items():
        n = n_per_label[name] if isinstance(n_per_label, dict) else n_per_label
        k = key(seed, "mix", name, F.col("split"), F.col("post_id_a"), F.col("post_id_b"), F.col("label"))
        parts.append(first_by_key(cut_lineage(df), ["split", "label"], k, ["post_id_a", "post_id_b"], n).withColumn("source", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def triplet_rows(df: DataFrame, author_col: str = "author_id", id_col: str = "text_id") -> DataFrame:
    """(author, text) rows for triplet training, clustered by author so a
    batch reader sees an author's texts together (no own sampling logic)."""
    return df.repartition(author_col).sortWithinPartitions(author_col, id_col)


def sample_episodes(df: DataFrame, n_way: int, k_shot: int, episodes: int, author_col: str = "author_id",
                    id_col: str = "text_id", seed: int = 42) -> DataFrame:
    """``episodes`` n-way k-shot episodes. Each episode draws n distinct
    authors (among authors with >= 2k texts) and 2k distinct texts of each:
    the first k adapt, the next k evaluate; labels 0..n-1 in draw order.

    Draws are those of ``distinct_draws``, so no group is enumerated."""
    from quillspark.operators.ranking import dense_ids

    base = df.select(F.col(author_col).alias("author"), F.col(id_col).alias("text_id"))
    n = base.groupBy("author").agg(F.count(F.lit(1)).cast("bigint").alias("n_texts")).filter(F.col("n_texts") >= 2 * k_shot)
    ids = dense_ids(base.join(n, "author", "left_semi"), ["author"], ["text_id"], id_col="aidx")
    A = ids.agg(F.count(F.lit(1)).cast("bigint").alias("A"))
    ep = df.sparkSession.range(episodes).select(F.col("id").alias("episode")).crossJoin(F.broadcast(A)).filter(F.col("A") >= n_way)
    picks = ep.select("episode", F.posexplode(distinct_draws(F.col("A"), n_way, lambda i: key(seed, "ep", F.col("episode"), i))).alias("label", "aidx"))
    picks = picks.join(ids, "aidx").join(n, "author")
    tx = picks.select("episode", "label", "author", F.posexplode(distinct_draws(
        F.col("n_texts"), 2 * k_shot, lambda i: key(seed, "shot", F.col("episode"), F.col("author"), i))).alias("slot", "tord"))
    idx = index_posts(base, "author", "text_id")
    out = tx.join(idx.select("author", "tord", "text_id"), ["author", "tord"])
    return out.select(F.col("episode").cast("bigint").alias("episode"), F.col("label").cast("int").alias("label"),
                      F.col("author").alias(author_col), F.col("text_id").alias(id_col),
                      F.when(F.col("slot") < k_shot, "adapt").otherwise("evaluate").alias("role"))
