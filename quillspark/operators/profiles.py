"""Profile-based pairs with length-matched negatives.

F7 cuts each user's shuffled posts into two halves at a keyed random token
share (up to ``tries`` keyed targets, else the middle post); F8 pairs the two
halves as the positive and draws, for each positive, a half of another user
whose length difference to the anchor half falls in the same decile bucket
as the positive's own difference.

The length match is a range predicate. Instead of a nested loop it is turned
into integer length intervals; counts of halves below an interval edge come
from one skew-safe running count over (halves + interval edges) sorted by
length, and the drawn candidate is found by its rank (an equi join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import key, unit
from quillspark.functions import text as T
from quillspark.operators.joins import join_small
from quillspark.operators.ranking import global_rank, ordinal_in_group, prefix_sums
from quillspark.session import cut_lineage

SEPARATOR = " <POST> "
MIN_TOKENS, MIN_RATIO, MAX_RATIO, TRIES, BUCKETS = 25, 0.3, 0.7, 10, 10


def profile_members(posts: DataFrame, seed: int = 42, min_tokens: int = MIN_TOKENS, min_ratio: float = MIN_RATIO,
                    max_ratio: float = MAX_RATIO, tries: int = TRIES) -> DataFrame:
    """F7 without texts: (split, author, side 'a'/'b', o, post_id, tok) for authors with >= 2 posts, o the post's place in its
    author's shuffled order. ``posts``: (split, author, post_id, text), post ids unique in their author. Only ids and word
    counts are ranked, summed and written; texts are read once, for the counts."""
    p = posts.select("split", "author", "post_id", T.word_count("text").alias("tok"),
                     key(seed, "prof", F.col("author"), F.col("post_id")).alias("__k"))
    p = ordinal_in_group(p, ["author"], ["__k", "post_id"], col="o")
    p = prefix_sums(p, ["author"], [F.col("o")], ["tok"], prefix="acc_", inclusive=True)
    p = cut_lineage(p)
    per = p.groupBy("split", "author").agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.sum("tok").cast("bigint").alias("T"))
    per = per.filter(F.col("n") >= 2)
    # candidate cut after post o (0-based) for every try r; the first try with a valid cut wins
    tr = per.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(tries - 1))))
    u = unit(seed, "target", F.col("author"), F.col("r"))
    tr = tr.withColumn("target", (F.lit(min_ratio) + F.lit(max_ratio - min_ratio) * u) * F.col("T").cast("double"))
    cuts = p.select("author", "o", F.col("acc_tok").alias("acc"))
    j = tr.join(cuts, "author").filter(
        (F.col("o") < F.col("n") - 1) & (F.col("acc").cast("double") >= F.col("target")) &
        (F.col("acc") >= min_tokens) & ((F.col("T") - F.col("acc")) >= min_tokens))
    first_cut = j.groupBy("author").agg(F.min_by(F.col("o") + 1, F.struct("r", "o")).alias("sp_try"))
    sp = per.join(first_cut, "author", "left").select(
        "split", "author", "n",
        F.when(F.col("n") == 2, F.lit(1)).otherwise(F.coalesce(F.col("sp_try"), (F.col("n") / 2).cast("bigint"))).cast("bigint").alias("sp"))
    side = F.when(F.col("o") < F.col("sp"), "a").otherwise("b").alias("side")
    return cut_lineage(p.join(sp, ["split", "author"]).select("split", "author", side, "o", "post_id", "tok"))


def profile_lengths(members: DataFrame) -> DataFrame:
    """(split, author, side, len): whitespace words of the joined half (separators included, as the reference counts them)."""
    return members.groupBy("split", "author", "side").agg((F.sum("tok") + F.count(F.lit(1)) - 1).cast("bigint").alias("len"))


def profile_texts(members: DataFrame, posts: DataFrame) -> DataFrame:
    """(split, author, side, text, len): the halves as texts, for those that are written."""
    j = members.join(posts.select("author", "post_id", "text"), ["author", "post_id"])
    agg = j.groupBy("split", "author", "side").agg(F.sort_array(F.collect_list(F.struct("o", "text"))).alias("__s"),
                                                   (F.sum("tok") + F.count(F.lit(1)) - 1).cast("bigint").alias("len"))
    return agg.select("split", "author", "side", F.array_join(F.transform("__s", lambda x: x["text"]), SEPARATOR).alias("text"), "len")


def profile_split(posts: DataFrame, seed: int = 42, **rules) -> DataFrame:
    """(split, author, side 'a'/'b', text, len) for authors with >= 2 posts."""
    return profile_texts(profile_members(posts, seed, **rules), posts)


def attach_profiles(pairs: DataFrame, members: DataFrame, posts: DataFrame) -> DataFrame:
    """F8 pairs with the texts of both halves (text0, text1); only halves that a pair names are put together."""
    named = pairs.select(F.explode(F.array(*[F.struct(F.col(f"author_{x}").alias("author"), F.col(f"side_{x}").alias("side")) for x in "ab"])).alias("h")).select("h.*").distinct()
    texts = cut_lineage(profile_texts(members.join(named, ["author", "side"], "left_semi"), posts).select("author", "side", "text"))
    for x, out in (("a", "text0"), ("b", "text1")):
        pairs = pairs.join(texts.select(F.col("author").alias(f"author_{x}"), F.col("side").alias(f"side_{x}"), F.col("text").alias(out)), [f"author_{x}", f"side_{x}"])
    return pairs


def _diff(a: Column, h: Column) -> Column:
    """|a - h| / (a + h) as the reference computes it; NULL when a + h = 0."""
    return F.when((a + h) > 0, F.abs(a.cast("double") - h.cast("double")) / (a + h).cast("double"))


def exact_quantiles(df: DataFrame, group: str, col: str, qs) -> DataFrame:
    """numpy-style linear quantiles per group, exact, without collecting a group:
    rank the values (range-partitioned), pick the two neighbours of each position."""
    r = ordinal_in_group(df.select(group, col), [group], [col], col="__o")
    n = df.groupBy(group).agg(F.count(F.lit(1)).cast("bigint").alias("__n"))
    qd = n.select(group, "__n", F.posexplode(F.array(*[F.lit(float(q)) for q in qs])).alias("qi", "q"))
    qd = qd.withColumn("__h", F.col("q") * (F.col("__n") - 1).cast("double")).withColumn(
        "__lo", F.floor("__h").cast("bigint")).withColumn("__hi", F.ceil("__h").cast("bigint"))
    lo = r.select(group, F.col("__o").alias("__lo"), F.col(col).alias("__vlo"))
    hi = r.select(group, F.col("__o").alias("__hi"), F.col(col).alias("__vhi"))
    j = qd.join(lo, [group, "__lo"]).join(hi, [group, "__hi"])
    t = F.col("__h") - F.col("__lo").cast("double")
    d = F.col("__vhi") - F.col("__vlo")
    # numpy's lerp: a + (b - a) t below t = 0.5, b - (b - a)(1 - t) from there
    v = F.when(t >= 0.5, F.col("__vhi") - d * (F.lit(1.0) - t)).otherwise(F.col("__vlo") + d * t)
    return j.select(group, "qi", v.alias("value"))


def pairs_profile(halves: DataFrame, seed: int = 42, buckets: int = BUCKETS) -> DataFrame:
    """F8: one positive per user (its two halves) and one negative per positive:
    the anchor half 'a' with a half of another user of the same split whose
    length difference lies in the positive's decile bucket [q_b, q_b+1]; if
    none exists, any half of another user.

    Output: (split, label, author_a, side_a, author_b, side_b, len_a, len_b)."""
    h = cut_lineage(halves.select("split", "author", "side", "len"))
    a = h.filter("side = 'a'").select("split", "author", F.col("len").alias("len_a"))
    b = h.filter("side = 'b'").select("split", "author", F.col("len").alias("len_b"))
    pos = a.join(b, ["split", "author"]).withColumn("diff", _diff(F.col("len_a"), F.col("len_b")))
    pos = cut_lineage(pos)
    qv = exact_quantiles(pos, "split", "diff", [i / buckets for i in range(buckets + 1)])
    qarr = qv.groupBy("split").agg(F.sort_array(F.collect_list(F.struct("qi", "value"))).alias("__q")).select(
        "split", F.transform("__q", lambda x: x["value"]).alias("q"))
    pos = join_small(pos, qarr, "split")
    # bucket = (number of edges <= diff) - 1, held in 0..buckets-1
    nle = F.size(F.filter("q", lambda e: e <= F.col("diff")))
    pos = pos.withColumn("bucket", F.least(F.lit(buckets - 1), F.greatest(F.lit(0), nle - 1)))
    pos = pos.withColumn("lo", F.element_at("q", F.col("bucket") + 1)).withColumn("hi", F.element_at("q", F.col("bucket") + 2))
    # integer length intervals of the predicate lo <= |a-h|/(a+h) <= hi, checked exactly at the edges
    pos = cut_lineage(pos.select("split", "author", "len_a", "len_b", "lo", "hi"))
    iv = _length_intervals(pos)
    # candidate ranks: halves sorted by (len, author, side) inside the split
    hr = ordinal_in_group(h, ["split"], ["len", "author", "side"], col="rank")
    hr = cut_lineage(hr)
    counts = _count_below(hr, iv)
    own = hr.select("split", F.col("author"), "rank", "len")
    c = counts.join(own.groupBy("split", "author").agg(F.collect_list(F.struct("rank", "len")).alias("own")), ["split", "author"])
    # own halves inside the candidate intervals are excluded
    inside = lambda x, l1, l2: (x["len"] >= F.col(l1)) & (x["len"] <= F.col(l2))
    c = c.withColumn("own_in", F.filter("own", lambda x: inside(x, "L1", "L2") | inside(x, "L3", "L4")))
    c = c.withColumn("C", F.col("c12") + F.col("c34") - F.size("own_in"))
    total = hr.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("N"))
    c = join_small(c, total, "split")
    own_cnt = F.size("own")
    fallback = F.col("C") <= 0
    c = c.withColumn("pool", F.when(fallback, F.col("N") - own_cnt).otherwise(F.col("C")))
    c = c.filter(F.col("pool") > 0)
    o = key(seed, "profneg", F.col("split"), F.col("author")) % F.col("pool")
    c = c.withColumn("__o", o)
    c = c.withColumn("__excl", F.when(fallback, F.transform("own", lambda x: x["rank"])).otherwise(F.transform("own_in", lambda x: x["rank"])))
    c = c.withColumn("__base", F.when(fallback, F.col("__o")))
    c = _map_ordinal(c)
    tgt = hr.select("split", F.col("rank").alias("__rank"), F.col("author").alias("author_b"), F.col("side").alias("side_b"),
                    F.col("len").alias("len_b2"))
    neg = c.join(tgt, ["split", "__rank"])
    pos_rows = pos.select("split", F.lit(True).alias("label"), F.col("author").alias("author_a"), F.lit("a").alias("side_a"),
                          F.col("author").alias("author_b"), F.lit("b").alias("side_b"), "len_a", "len_b")
    neg_rows = neg.select("split", F.lit(False).alias("label"), F.col("author").alias("author_a"), F.lit("a").alias("side_a"),
                          "author_b", "side_b", "len_a", F.col("len_b2").alias("len_b"))
    return pos_rows.unionByName(neg_rows)


def _length_intervals(pos: DataFrame) -> DataFrame:
    """L1..L2 (h <= a) and L3..L4 (h > a) with lo <= diff(a, h) <= hi, exact.

    Closed forms give the edges up to rounding; each edge is then moved by one
    while the exact predicate says so (diff is monotone on each side)."""
    a = F.col("len_a").cast("double")
    lo, hi = F.col("lo"), F.col("hi")

    def ok(hv: Column) -> Column:
        d = _diff(F.col("len_a"), hv)
        return F.coalesce((hv >= 0) & ((F.col("len_a") + hv) > 0) & (d >= lo) & (d <= hi), F.lit(False))

    big = F.lit(1 << 40).cast("bigint")
    # left side: diff decreases in h; L1 = min h with diff <= hi, L2 = max h <= a with diff >= lo
    l1 = F.greatest(F.lit(0).cast("bigint"), F.ceil(a * (F.lit(1.0) - hi) / (F.lit(1.0) + hi)).cast("bigint"))
    l2 = F.least(F.col("len_a"), F.floor(a * (F.lit(1.0) - lo) / (F.lit(1.0) + lo)).cast("bigint"))
    # right side: diff increases in h; L3 = min h > a with diff >= lo, L4 = max h with diff <= hi
    l3 = F.greatest(F.col("len_a") + 1, F.ceil(F.when(lo < 1, a * (F.lit(1.0) + lo) / (F.lit(1.0) - lo)).otherwise(F.lit(float(1 << 40)))).cast("bigint"))
    l4 = F.when(hi >= 1, big).otherwise(F.floor(a * (F.lit(1.0) + hi) / (F.lit(1.0) - hi)).cast("bigint"))
    d = pos.withColumn("L1", l1).withColumn("L2", l2).withColumn("L3", l3).withColumn("L4", l4)
    for _ in range(2):
        d = (d.withColumn("L1", F.when((F.col("L1") > 0) & ok(F.col("L1") - 1), F.col("L1") - 1)
                          .when(~ok(F.col("L1")) & (F.col("L1") < F.col("len_a")), F.col("L1") + 1).otherwise(F.col("L1")))
             .withColumn("L2", F.when((F.col("L2") < F.col("len_a")) & ok(F.col("L2") + 1), F.col("L2") + 1)
                         .when(~ok(F.col("L2")) & (F.col("L2") > 0), F.col("L2") - 1).otherwise(F.col("L2")))
             .withColumn("L3", F.when((F.col("L3") > F.col("len_a") + 1) & ok(F.col("L3") - 1), F.col("L3") - 1)
                         .when(~ok(F.col("L3")) & (F.col("L3") < big), F.col("L3") + 1).otherwise(F.col("L3")))
             .withColumn("L4", F.when((F.col("L4") < big) & ok(F.col("L4") + 1), F.col("L4") + 1)
                         .when(~ok(F.col("L4")) & (F.col("L4") > F.col("len_a")), F.col("L4") - 1).otherwise(F.col("L4"))))
    # empty intervals become (1, 0)
    e12 = ~(ok(F.col("L1")) & ok(F.col("L2")) & (F.col("L1") <= F.col("L2")))
    e34 = ~(ok(F.col("L3")) & ok(F.col("L4")) & (F.col("L3") <= F.col("L4")))
    return (d.withColumn("L1", F.when(e12, 1).otherwise(F.col("L1"))).withColumn("L2", F.when(e12, 0).otherwise(F.col("L2")))
            .withColumn("L3", F.when(e34, 1).otherwise(F.col("L3"))).withColumn("L4", F.when(e34, 0).otherwise(F.col("L4"))))


def _count_below(hr: DataFrame, iv: DataFrame) -> DataFrame:
    """For each positive: number of halves with len < L1, <= L2, < L3, <= L4
    (one running count over halves and interval edges sorted by length)."""
    edges = iv.select("split", "author", F.posexplode(F.array(
        F.struct(F.col("L1").alias("x"), F.lit(0).alias("t")), F.struct((F.col("L2") + 1).alias("x"), F.lit(0).alias("t")),
        F.struct(F.col("L3").alias("x"), F.lit(0).alias("t")), F.struct((F.col("L4") + 1).alias("x"), F.lit(0).alias("t")))).alias("e", "s"))
    q = edges.select("split", F.col("author").alias("__q"), "e", F.col("s.x").alias("len"), F.lit(0).alias("kind"), F.lit(0).alias("is_half"))
    hs = hr.select("split", F.lit(None).cast("string").alias("__q"), F.lit(-1).alias("e"), "len", F.lit(1).alias("kind"), F.lit(1).alias("is_half"))
    u = q.unionByName(hs).withColumn("__tie", F.monotonically_increasing_id())
    # queries sort before halves of the same length: count = halves with len < x
    cum = prefix_sums(u, ["split"], [F.col("len"), F.col("kind"), F.col("__q"), F.col("e"), F.col("__tie")], ["is_half"],
                      prefix="cum_", inclusive=True)
    qq = cum.filter(F.col("kind") == 0).groupBy("split", F.col("__q").alias("author")).agg(
        *[F.max(F.when(F.col("e") == i, F.col("cum_is_half"))).alias(f"b{i}") for i in range(4)])
    j = iv.join(qq, ["split", "author"])
    return j.withColumn("s12", F.col("b0")).withColumn("c12", F.col("b1") - F.col("b0")) \
        .withColumn("s34", F.col("b2")).withColumn("c34", F.col("b3") - F.col("b2"))


def _map_ordinal(c: DataFrame) -> DataFrame:
    """Candidate ordinal -> 0-based rank in the split's sorted halves.

    Fallback: all ranks except the user's own. Otherwise the ordinal walks
    [s12, s12 + c12) then [s34, s34 + c34); the user's own ranks inside the
    intervals are skipped (shift past each excluded rank in ascending order)."""
    o = F.col("__o")

    def skip(start_pos: Column) -> Column:
        return F.aggregate(F.array_sort("__excl"), start_pos, lambda x, e: x + (x >= e).cast("bigint"))

    # count own excluded ranks in the first interval to know how many candidates it holds
    own12 = F.size(F.filter("__excl", lambda e: (e >= F.col("s12")) & (e < F.col("s12") + F.col("c12"))))
    n12 = F.col("c12") - own12
    in_first = o < n12
    # within the first interval: skip own ranks there; second interval similarly
    first = F.aggregate(F.array_sort(F.filter("__excl", lambda e: (e >= F.col("s12")) & (e < F.col("s12") + F.col("c12")))),
                        F.col("s12") + o, lambda x, e: x + (x >= e).cast("bigint"))
    second = F.aggregate(F.array_sort(F.filter("__excl", lambda e: (e >= F.col("s34")) & (e < F.col("s34") + F.col("c34")))),
                         F.col("s34") + (o - n12), lambda x, e: x + (x >= e).cast("bigint"))
    fb = skip(o)
    rank = F.when(F.col("__base").isNotNull(), fb).when(in_first, first).otherwise(second)
    return c.withColumn("__rank", rank.cast("bigint"))
