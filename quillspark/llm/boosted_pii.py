"""Operator 8: personal data by boosted trees over candidate spans (DataFrame functions only).

Base rules find e-mail addresses, IP addresses, card and phone numbers; their
spans always stay. High-recall generators propose more spans, which may overlap
(dotted and grouped digits, numbers without a country sign, spelled-out mail
signs). Boosted trees score every candidate on format and context; candidates
that reach a calibrated threshold and touch no base span or better candidate
are added.

There is no labelled personal data, so the trees learn from the corpus: base
spans are positives, candidates that break a rule of their kind (check digit,
range, number of digits, inside a longer token) are negatives, the rest is
unlabelled and only scored. All candidates of all documents are counted; every
feature has a few values, so the counts by feature vector are a table whose size
does not follow the corpus (``FEATURES`` bounds it), and trees are fitted on that
table. The threshold is the least score with the wanted precision on the half of
the documents that trees did not learn from. Trees become CASE expressions.

Base patterns are written so that every regular expression runs in linear time
without recursion: single separators between digits, and dots between labels,
are first replaced one for one by private characters, so a card or a mail domain
is one run of a character class.

Positions count code points, ends are exclusive. Cases: null and empty texts
have no spans; repeated rows are kept; texts of any length are searched whole;
empty tables give no rows and train nothing (then base spans alone remain);
other columns pass through, but those named like an output column are replaced.
Spans are found in the row that holds the text: nothing is shuffled but counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# stand-ins for a single separator between digits and a dot between labels; in the text itself they become TAKEN
GAP, DOT, TAKEN = "\ue000", "\ue001", "\ue002"
ROUNDS, RATE = 24, 0.4
PRECISION, LEAST_SCORE = 0.98, 0.9
MIN_CALIBRATION = 20
SPAN = "struct<kind:int,start:int,stop:int>"
HIT = "struct<kind:int,start:int,stop:int,body:string>"

#: features and their number of values (from 0); those in NOMINAL are split by equality
FEATURES = {"kind": 4, "digits": 8, "groups": 6, "brackets": 2, "last_group": 6, "left": 4, "right": 4, "cue": 2}
NOMINAL = ("kind", "left", "right")

LOCAL, LABEL = f"A-Za-z0-9._%+{DOT}-", "A-Za-z0-9-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{LABEL}]++{DOT}[{LABEL}{DOT}]+"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = f"[0-9][0-9{GAP}]+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# candidates: bounded repetition, so that no match scans far
WIDE = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|\{at\}|@) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{2,24}){1,4}",
    r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){3,5}",
    r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,20}",
    r"(?<![0-9A-Za-z])(?:\+|00)?[0-9(][\x20().0-9-]{5,22}[0-9]",
)
CUES = (r"mail|contact|write", r"\bip\b|addr|host|server", "card|visa|credit|account|iban|pay", "tel|phone|call|mobile|fax")


def _found(text: Column, pattern: str, kind: int) -> Column:
    """array<HIT> of the pattern's matches, left to right, without overlap."""
    body = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    pairs = F.arrays_zip(body.alias("body"), F.split(text, pattern, -1).alias("pre"))
    state = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{HIT}>").alias("out"))

    def step(s, p):
        start = s["at"] + F.length(p["pre"])
        stop = start + F.length(p["body"])
        hit = F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), p["body"].alias("body"))
        return F.struct(stop.alias("at"), F.concat(s["out"], F.array(hit)).alias("out"))

    return F.aggregate(F.filter(pairs, lambda p: p["body"].isNotNull()), state, step, lambda s: s["out"])


def _n_digits(body: Column) -> Column:
    return F.length(F.regexp_replace(body, "[^0-9]", ""))


def _luhn(body: Column) -> Column:
    """Check digit rule over the digits of ``body``: from the right, every second digit is doubled and its digits summed."""
    digits = F.reverse(F.split(F.regexp_replace(body, "[^0-9]", ""), ""))

    def add(s, d):
        v = F.coalesce(d.try_cast("int"), F.lit(0))
        v = F.when(s["odd"], v).otherwise((2 * v) % 10 + F.when(v > 4, 1).otherwise(0))
        return F.struct((s["sum"] + v).alias("sum"), (~s["odd"]).alias("odd"))

    return F.aggregate(digits, F.struct(F.lit(0).alias("sum"), F.lit(True).alias("odd")), add, lambda s: s["sum"] % 10 == 0)


def _small_parts(body: Column) -> Column:
    """Every dotted part is at most 255."""
    return F.forall(F.split(body, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))


def _base_valid(h: Column) -> Column:
    n = _n_digits(h["body"])
    return (F.when(h["kind"] == 0, True).when(h["kind"] == 1, _small_parts(h["body"]))
            .when(h["kind"] == 2, n.between(16, 19) & _luhn(h["body"])).otherwise(n.between(8, 15)))


def with_base(df: DataFrame, text: str) -> DataFrame:
    """Adds ``base``: array<SPAN> of the base rules, by kind, then start."""
    t = F.coalesce(F.col(text), F.lit(""))
    plain = F.translate(t, GAP + DOT, TAKEN * 2)
    df = (df.withColumn("__d", F.when(t.contains("@"), F.regexp_replace(plain, rf"(?<=[{LABEL}])\.(?=[{LABEL}])", DOT)))
          .withColumn("__i", F.when(t.rlike(r"[0-9]\.[0-9]"), t))
          .withColumn("__g", F.when(t.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), F.regexp_replace(plain, r"(?<=[0-9])[\x20-](?=[0-9])", GAP)))
          .withColumn("__p", F.when(t.contains("+"), t)))
    parts = [_found(F.col(c), pattern, k) for k, (c, pattern) in enumerate((("__d", EMAIL), ("__i", IP), ("__g", CARD), ("__p", PHONE)))]
    every = F.concat(*[F.coalesce(x, F.array().cast(f"array<{HIT}>")) for x in parts])
    kept = F.transform(F.filter(every, _base_valid), lambda h: F.struct(h["kind"].alias("kind"), h["start"].alias("start"), h["stop"].alias("stop")))
    return df.withColumn("base", kept).drop("__d", "__i", "__g", "__p")


def _meets(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def _char_class(c: Column) -> Column:
    return F.when((c == "") | c.rlike(r"\s"), 0).when(c.rlike(r"\p{L}"), 1).when(c.rlike("[0-9]"), 2).otherwise(3)


def with_candidates(df: DataFrame, text: str) -> DataFrame:
    """Adds ``cands``: array of spans with the values of FEATURES and ``label`` (1, 0 or null). Needs ``base``."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = (df.withColumn("__n", F.when(t.rlike("[0-9][^0-9]?[0-9]"), t))
          .withColumn("__a", F.when(t.contains("@") | t.rlike(r"\(at\)|\[at\]|\{at\}"), t)))
    parts = [_found(F.col("__a" if k == 0 else "__n"), pattern, k) for k, pattern in enumerate(WIDE)]
    df = df.withColumn("__c", F.concat(*[F.coalesce(x, F.array().cast(f"array<{HIT}>")) for x in parts]))

    def describe(h):
        n = _n_digits(h["body"])
        groups = F.filter(F.split(h["body"], "[^0-9]+"), lambda g: g != "")
        before = F.substring(t, F.greatest(h["start"] - 23, F.lit(1)), F.least(h["start"], F.lit(24)))
        left = F.when(h["start"] == 0, "").otherwise(F.substring(t, h["start"], F.lit(1)))
        cue = F.when(h["kind"] == 0, F.lower(before).rlike(CUES[0])).when(h["kind"] == 1, F.lower(before).rlike(CUES[1])).when(
            h["kind"] == 2, F.lower(before).rlike(CUES[2])).otherwise(F.lower(before).rlike(CUES[3]))
        return F.struct(
            h["kind"].alias("kind"), h["start"].alias("start"), h["stop"].alias("stop"), h["body"].alias("body"),
            F.when(n < 7, 0).when(n < 10, 1).when(n == 10, 2).when(n == 11, 3).when(n < 14, 4).when(n < 16, 5).when(n < 20, 6).otherwise(7).alias("digits"),
            F.least(F.size(groups), F.lit(5)).alias("groups"), h["body"].contains("(").cast("int").alias("brackets"),
            F.coalesce(F.least(F.length(F.try_element_at(groups, F.lit(-1))), F.lit(5)), F.lit(0)).alias("last_group"),
            _char_class(left).alias("left"), _char_class(F.substring(t, h["stop"] + 1, F.lit(1))).alias("right"), cue.cast("int").alias("cue"))

    def judged(c):
        base = F.col("base")
        agrees = F.exists(base, lambda b: (b["kind"] == c["kind"]) & _meets(b, c))
        parts = F.size(F.split(c["body"], r"\."))
        broken = (c["left"].isin(1, 2) | c["right"].isin(1, 2) | F.exists(base, lambda b: (b["kind"] != c["kind"]) & _meets(b, c))
                  | F.when(c["kind"] == 1, (parts != 4) | ~_small_parts(c["body"])).when(c["kind"] > 1, ~_base_valid(c)).otherwise(False))
        return F.struct(*[c[x].alias(x) for x in ("start", "stop", *FEATURES)], F.when(agrees, 1).when(broken, 0).alias("label"))

    df = df.withColumn("__c", F.transform("__c", describe))
    return df.withColumn("cands", F.transform("__c", judged)).drop("__n", "__a", "__c")


def _splits() -> list[tuple[str, int]]:
    return [(f, v) for f, n in FEATURES.items() for v in range(n if f in NOMINAL else n - 1)]


def _goes(row, split: tuple[str, int]) -> bool:
    f, v = split
    return row[f] == v if f in NOMINAL else row[f] <= v


def _best_split(rows: list[tuple], least: float = 1.0):
    """Split of (features, gradient, hessian) rows with the largest gain, or None."""
    def score(g, h):
        return g * g / (h + 1.0)

    g0, h0 = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = None
    for split in _splits():
        g = h = 0.0
        for r in rows:
            if _goes(r[0], split):
                g, h = g + r[1], h + r[2]
        gain = score(g, h) + score(g0 - g, h0 - h) - score(g0, h0)
        if gain > 1e-9 and min(h, h0 - h) > 1e-6 * least and (best is None or gain > best[0] + 1e-12):
            best = (gain, split)
    return best and best[1]


def _grow(rows: list[tuple], depth: int):
    split = _best_split(rows) if depth else None
    if split is None:
        return RATE * sum(r[1] for r in rows) / (sum(r[2] for r in rows) + 1.0)
    yes, no = [r for r in rows if _goes(r[0], split)], [r for r in rows if not _goes(r[0], split)]
    return split, _grow(yes, depth - 1), _grow(no, depth - 1)


def _leaf(tree, row) -> float:
    while isinstance(tree, tuple):
        split, yes, no = tree
        tree = yes if _goes(row, split) else no
    return tree


def fit_trees(counts: list[dict], rounds: int = ROUNDS, depth: int = 2) -> list:
    """Logistic boosting over rows of feature values with ``pos`` and ``neg`` counts."""
    trees, margin = [], [0.0] * len(counts)
    if not any(c["pos"] for c in counts) or not any(c["neg"] for c in counts):
        return trees
    for _ in range(rounds):
        rows = []
        for c, m in zip(counts, margin):
            q = 1 / (1 + math.exp(-m))
            rows.append((c, c["pos"] - (c["pos"] + c["neg"]) * q, (c["pos"] + c["neg"]) * q * (1 - q)))
        tree = _grow(rows, depth)
        trees.append(tree)
        margin = [m + _leaf(tree, c) for m, c in zip(margin, counts)]
    return trees


def calibrate(trees: list, counts: list[dict], precision: float = PRECISION) -> float:
    """Least score with the wanted precision on ``counts``; above 1 (nothing is added) if there is none."""
    scored = sorted(((1 / (1 + math.exp(-sum(_leaf(t, c) for t in trees))), c["pos"], c["neg"]) for c in counts), reverse=True)
    best, pos, neg = 2.0, 0, 0
    for k, (score, p, n) in enumerate(scored):
        pos, neg = pos + p, neg + n
        last = k + 1 == len(scored) or scored[k + 1][0] < score
        if last and trees and score >= LEAST_SCORE and pos + neg >= MIN_CALIBRATION and pos >= precision * (pos + neg):
            best = score
    return best


def _case(tree, c: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    (f, v), yes, no = tree
    return F.when(c[f] == v if f in NOMINAL else c[f] <= v, _case(yes, c)).otherwise(_case(no, c))


def pattern_counts(df: DataFrame, text: str) -> list[dict]:
    """Labelled candidates of all documents by feature vector and half (drawn by text); the product of FEATURES bounds the rows."""
    cands = with_candidates(with_base(df.select(text), text), text)
    rows = cands.select((F.pmod(F.xxhash64(text), F.lit(2))).alias("half"), F.explode_outer("cands").alias("c")).where(F.col("c.label").isNotNull())
    sums = rows.groupBy("half", *[F.col(f"c.{f}").alias(f) for f in FEATURES]).agg(
        F.sum("c.label").alias("pos"), F.sum(1 - F.col("c.label")).alias("neg"))
    return sorted((r.asDict() for r in sums.collect()), key=lambda r: tuple(r.values()))


def find_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``base`` and ``spans`` (array<struct<kind, start, stop>>, kind an index of KINDS, by kind, then start)."""
    counts = pattern_counts(df, text)
    trees = fit_trees([c for c in counts if c["half"] == 0])
    least = calibrate(trees, [c for c in counts if c["half"] == 1])
    df = with_base(df.drop("base", "spans"), text)
    if least > 1:
        return df.withColumn("spans", F.col("base"))
    df = with_candidates(df, text)

    def scored(c):
        margin = F.lit(0.0)
        for tree in trees:
            margin = margin + _case(tree, c)
        return F.struct((-margin).alias("order"), c["start"].alias("start"), c["stop"].alias("stop"), c["kind"].alias("kind"))

    cut = math.log(least / (1 - least)) - 1e-9 if least < 1 else math.inf
    free = F.filter("cands", lambda c: c["label"].isNull() & ~F.exists(F.col("base"), lambda b: _meets(b, c)))
    df = df.withColumn("__s", F.array_sort(F.filter(F.transform(free, scored), lambda s: s["order"] <= -cut)))

    def take(out, s):
        span = F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))
        return F.when(F.exists(out, lambda o: _meets(o, s)), out).otherwise(F.concat(out, F.array(span)))

    added = F.aggregate("__s", F.array().cast(f"array<{SPAN}>"), take)
    return df.withColumn("spans", F.array_sort(F.concat("base", added))).drop("cands", "__s")


def redact(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Replaces every span by its kind in brackets; spans that overlap become one, named by the first (the longer of two with one start)."""
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("back"), s["kind"].alias("kind"), s["stop"].alias("stop"))))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    t = F.coalesce(F.col(text), F.lit(""))

    def step(s, p):
        gap = F.substring(t, s["at"] + 1, F.greatest(p["start"] - s["at"], F.lit(0)))
        name = F.when(p["start"] >= s["at"], F.element_at(names, p["kind"] + 1)).otherwise("")
        return F.struct(F.greatest(s["at"], p["stop"]).alias("at"), F.concat(s["out"], gap, name).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(by_place, start, step, lambda s: F.concat(s["out"], F.substring(t, s["at"] + 1, F.length(t))))
    return df.withColumn(text, F.when(F.size(spans) > 0, done).otherwise(F.col(text)))


def spans_text(spans: str) -> Column:
    """kind:start:stop, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["stop"])), ",")
