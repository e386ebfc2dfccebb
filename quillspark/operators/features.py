"""Stylometric features.

Per-text features (H5-H7) are array expressions evaluated inside the row (no
shuffle). Sparse n-gram features are long tables (text_id, term, tf) and
tf-idf is a plan over them: document frequency is a partial aggregate per
term, the idf table is joined back broadcast only behind a size check, and
the L2 norm is an aggregate per text.
"""

from __future__ import annotations

from typing import Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from quillspark.functions import text as T
from quillspark.operators.joins import MAX_BROADCAST_ROWS
from quillspark.session import cut_lineage

RICHNESS_WINDOW = 1000
TREES = 1024  # parse trees that are walked at once
# Feature names of the 17 vocabulary-richness indices, in order.
RICHNESS_NAMES = ["type_token_ratio", "guiraud_r", "herdan_c", "dugast_k", "maas_a2", "dugast_u", "tuldava_ln",
                  "brunet_w", "cttr", "summer_s", "sichel_s", "michea_m", "honore_h", "herdan_vm", "entropy",
                  "yule_k", "simpson_d"]
BRUNET_A = -0.172
MAX_WORD_LEN_BIN = 10
# Fixed value: the punctuation characters profiled by H10, in the reference's order.
PUNCTUATION = list('!"#$%&\'()*+,-./:;<=>?@[\\]^_`{¦}~')


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body``.

    Expressions referenced inside a lambda are re-evaluated for every
    element; binding them through a one-element array keeps the work linear."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _eq(k):
    return lambda v: v == k


def _add_at(i):
    return lambda a, x: a + x[i]


def by_id(df: DataFrame, id_col: str) -> DataFrame:
    """Rows dealt by id. Counts per (id, anything) and per id then need no shuffle of their own: the texts move, not their terms."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), id_col)


def token_table(df: DataFrame, id_col: str = "text_id", text_col: str = "text") -> DataFrame:
    """(id, pos, token) from G10 tokens."""
    return df.select(id_col, F.posexplode(T.tokenize(text_col)).alias("pos", "token")).withColumn(
        "pos", F.col("pos").cast("bigint"))


# H5 ----------------------------------------------------------------------------
def _runs(st: Column) -> Column:
    """Run lengths of a sorted array (bound once): array<int>."""
    def body(starts):
        ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(st) + 1))
        return F.zip_with(starts, ends, lambda a, b: b - a)
    idx = F.sequence(F.lit(1), F.size(st))
    starts = F.filter(idx, lambda i: (i == 1) | (F.element_at(st, i) != F.element_at(st, i - 1)))
    return F.when(F.size(st) > 0, let(starts, body)).otherwise(F.array().cast("array<int>"))


def type_frequencies(tokens) -> Column:
    """Occurrences of each distinct token of an array (order: sorted tokens)."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return let(F.array_sort(t), _runs)


def hapax_ratio(tokens) -> Column:
    """H5: types seen once / types seen twice; 0 if none twice or no tokens."""
    def body(r):
        once = F.size(F.filter(r, lambda x: x == 1))
        twice = F.size(F.filter(r, lambda x: x == 2))
        return F.when(twice == 0, F.lit(0.0)).otherwise(once.cast("double") / twice.cast("double"))
    return let(type_frequencies(tokens), body)


# H6 ----------------------------------------------------------------------------
def word_length_stats(tokens) -> Column:
    """H6: struct(avg_len, n_tokens, dist_1..dist_10): mean chars per token and
    the share of tokens of each length 1..10 (empty tokens ignored, q22)."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens

    def body(all_lens):
        lens = F.filter(all_lens, lambda l: l > 0)
        n = F.size(all_lens)
        total = F.aggregate(lens, F.lit(0).cast("bigint"), lambda acc, l: acc + l)
        fields = [F.when(F.size(lens) == 0, F.lit(0.0)).otherwise(total.cast("double") / F.size(lens).cast("double")).alias("avg_len"),
                  n.cast("bigint").alias("n_tokens")]
        for k in range(1, MAX_WORD_LEN_BIN + 1):
            c = F.size(F.filter(lens, _eq(k)))
            fields.append(F.when(n == 0, F.lit(0.0)).otherwise(c.cast("double") / n.cast("double")).alias(f"dist_{k}"))
        return F.struct(*fields)
    return let(F.transform(t, lambda x: F.length(x)), body)


# H7 ----------------------------------------------------------------------------
def _div0(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(None).cast("double")).otherwise(a / b)


def _ln(x: Column) -> Column:
    return F.when(x > 0, F.ln(x))


def _richness(N: Column, V: Column, f1: Column, f2: Column, s2: Column, ent: Column, simp: Column) -> list[Column]:
    """The 17 indices from window statistics: N tokens, V types, f1 / f2 types seen
    once / twice, s2 = sum r^2, ent = sum -(r/N) ln(r/N), simp = sum r(r-1). Undefined -> 0."""
    N, V = N.cast("double"), V.cast("double")
    lnN, lnV = _ln(N), _ln(V)
    vals = [
        _div0(V, N), _div0(V, F.sqrt(N)), _div0(lnV, lnN), _div0(lnV, _ln(lnN)), _div0(lnN - lnV, lnN * lnN),
        _div0(lnN * lnN, lnN - lnV), _div0(F.lit(1.0) - V * V, V * V * lnN), F.pow(N, F.pow(V, F.lit(BRUNET_A))),
        _div0(V, F.sqrt(F.lit(2.0) * N)), _div0(_ln(lnV), _ln(lnN)), _div0(f2.cast("double"), V), _div0(V, f2.cast("double")),
        _div0(F.lit(100.0) * lnN, F.lit(1.0) - _div0(f1.cast("double"), V)),
        F.when((_div0(s2, N * N) - _div0(F.lit(1.0), V)) >= 0, F.sqrt(_div0(s2, N * N) - _div0(F.lit(1.0), V))),
        ent, F.lit(1e4) * (_div0(s2, N * N) - _div0(F.lit(1.0), N)), _div0(simp, N * (N - F.lit(1.0))),
    ]
    return [F.coalesce(F.when(F.isnan(v), None).otherwise(v), F.lit(0.0)) for v in vals]


def vocab_richness(tokens, window: int = RICHNESS_WINDOW) -> Column:
    """H7: the 17 indices on consecutive windows of ``window`` tokens, mean over
    windows; all 0 for an empty token list. Evaluated inside the row."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens

    def per_text(tt):
        nw = F.ceil(F.size(tt) / F.lit(window)).cast("int")

        def win_stats(w):
            def on_chunk(chunk):
                N = F.size(chunk).cast("double")

                def on_runs(r):
                    s2 = F.aggregate(r, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
                    ent = F.aggregate(r, F.lit(0.0), lambda a, x: a + (-(x.cast("double") / N) * F.ln(x.cast("double") / N)))
                    simp = F.aggregate(r, F.lit(0.0), lambda a, x: a + x.cast("double") * (x.cast("double") - 1.0))
                    vals = _richness(N, F.size(r), F.size(F.filter(r, lambda x: x == 1)),
                                     F.size(F.filter(r, lambda x: x == 2)), s2, ent, simp)
                    return F.array(*vals)
                return let(type_frequencies(chunk), on_runs)
            return let(F.slice(tt, w * window + 1, window), on_chunk)

        def summarize(per):
            fields = []
            for i, name in enumerate(RICHNESS_NAMES):
                s = F.aggregate(per, F.lit(0.0), _add_at(i))
                fields.append(F.when(nw == 0, F.lit(0.0)).otherwise(s / nw.cast("double")).alias(name))
            return F.struct(*fields)
        return let(F.transform(F.sequence(F.lit(0), F.greatest(nw - 1, F.lit(0))), win_stats), summarize)
    return let(t, per_text)


# N-gram extraction --------------------------------------------------
def char_wb_ngrams(text, n_min: int = 1, n_max: int = 3, lowercase: bool = True) -> Column:
    """H1: character n-grams inside space-padded words (sklearn ``char_wb``): a
    padded word shorter than or equal to n yields itself once and stops the
    larger sizes."""
    s = F.col(text) if isinstance(text, str) else text
    if lowercase:
        s = F.lower(s)
    words = F.coalesce(F.regexp_extract_all(s, F.lit(T.WORD_JVM), 0), F.array().cast("array<string>"))

    def grams(p):
        L = F.length(p)
        per_n = F.transform(F.sequence(F.lit(n_min), F.lit(n_max)), lambda n: F.when(
            n < L, F.transform(F.sequence(F.lit(0), L - n), lambda o: F.substring(p, o + 1, n)))
            .when(n == F.greatest(F.lit(n_min), L), F.array(p)).otherwise(F.array().cast("array<string>")))
        return F.flatten(per_n)

    return F.flatten(F.transform(words, lambda w: let(F.concat(F.lit(" "), w, F.lit(" ")), grams)))


def char_wb_counts(df: DataFrame, id_col: str, text_col: str = "text", n_min: int = 1, n_max: int = 3, lowercase: bool = True) -> DataFrame:
    """H1 as a long table (id, term, tf): the counts of ``char_wb_ngrams``.

    Words of a text are counted first, so a word that occurs often is cut into
    n-grams once, and n-grams are cut row by row in generated code, without
    arrays of a whole text's n-grams. Rows of one id are counted together; texts are
    dealt by id first, so that words and n-grams are counted where they are cut."""
    df = by_id(df.select(id_col, text_col), id_col)
    s = F.lower(text_col) if lowercase else F.col(text_col)
    words = (df.select(id_col, F.explode(F.regexp_extract_all(s, F.lit(T.WORD_JVM), 0)).alias("w"))
             .groupBy(id_col, "w").agg(F.count(F.lit(1)).alias("c")))
    padded = words.select(id_col, "c", F.concat(F.lit(" "), "w", F.lit(" ")).alias("p")).withColumn("L", F.length("p"))
    # a word no longer than n yields itself once, at the smallest such n
    sized = padded.select(id_col, "c", "p", "L", F.explode(F.sequence(F.lit(n_min), F.greatest(F.lit(n_min), F.least(F.lit(n_max), F.col("L"))))).alias("n"))
    cut = sized.select(id_col, "c", "p", "n", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("L") - F.col("n") + 1))).alias("o"))
    return cut.groupBy(id_col, F.substring("p", F.col("o"), F.col("n")).alias("term")).agg(F.sum("c").cast("bigint").alias("tf"))


def char_ngrams(text, n_min: int = 1, n_max: int = 3, lowercase: bool = True) -> Column:
    """Plain character n-grams over the whole text.

    The text is split into code points once and grams are array slices:
    substring offsets on UTF-8 strings would rescan the text per gram."""
    s = F.col(text) if isinstance(text, str) else text
    if lowercase:
        s = F.lower(s)

    def body(chars):
        L = F.size(chars)
        per_n = F.transform(F.sequence(F.lit(n_min), F.lit(n_max)), lambda n: F.when(
            n <= L, F.transform(F.sequence(F.lit(0), L - n), lambda o: F.array_join(F.slice(chars, o + 1, n), "")))
            .otherwise(F.array().cast("array<string>")))
        return F.flatten(per_n)
    return let(F.regexp_extract_all(F.coalesce(s, F.lit("")), F.lit("(?s)."), 0), body)


def word_ngrams(tokens, n_min: int = 1, n_max: int = 1, sep: str = " ") -> Column:
    """H2: 1..n-grams over a token (or tag) array, joined by ``sep``."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens

    def body(tt):
        L = F.size(tt)
        per_n = F.transform(F.sequence(F.lit(n_min), F.lit(n_max)), lambda n: F.when(
            n <= L, F.transform(F.sequence(F.lit(1), L - n + 1), lambda o: F.array_join(F.slice(tt, o, n), sep)))
            .otherwise(F.array().cast("array<string>")))
        return F.flatten(per_n)
    return let(t, body)


def word_ngram_counts(df: DataFrame, id_col: str, tokens, n_min: int = 1, n_max: int = 1, sep: str = " ") -> DataFrame:
    """H2 as a long table (id, term, tf): the counts of ``word_ngrams``.

    A row per token carries the next ``n_max`` - 1 tokens, so n-grams are put together row by row in generated
    code. Rows of one id are counted together. ``df`` is dealt by id before ``tokens`` is evaluated."""
    t = by_id(df, id_col).select(id_col, (F.col(tokens) if isinstance(tokens, str) else tokens).alias("__t"))
    shifted = F.arrays_zip(*[F.slice("__t", i + 1, F.greatest(F.size("__t"), F.lit(0))).alias(f"w{i}") for i in range(n_max)])
    rows = t.select(id_col, F.size("__t").alias("__left"), F.posexplode(shifted).alias("__pos", "__w"))
    rows = rows.withColumn("__left", F.col("__left") - F.col("__pos")).filter(F.col("__left") >= n_min)
    rows = rows.select(id_col, "__w", F.explode(F.sequence(F.lit(n_min), F.least(F.lit(n_max), F.col("__left")))).alias("__n"))
    term = F.lit(None).cast("string")
    for n in range(n_max, n_min - 1, -1):
        term = F.when(F.col("__n") == n, F.concat_ws(sep, *[F.col(f"__w.w{i}") for i in range(n)])).otherwise(term)
    return rows.groupBy(id_col, term.alias("term")).agg(F.count(F.lit(1)).cast("bigint").alias("tf"))


def term_counts(df: DataFrame, id_col: str, terms: Column) -> DataFrame:
    """Long table (id, term, tf) from an array of terms per row."""
    return df.select(id_col, F.explode(terms).alias("term")).groupBy(id_col, "term").agg(
        F.count(F.lit(1)).cast("bigint").alias("tf"))


def tfidf(counts: DataFrame, id_col: str = "text_id", min_df: float | int = 1, max_df: float | int = 1.0,
          sublinear: bool = False, norm: str | None = "l2", vocabulary: DataFrame | None = None,
          n_docs: DataFrame | None = None) -> DataFrame:
    """tf-idf over a long table (id, term, tf) with sklearn's conventions:
    smooth idf = ln((1 + N) / (1 + df)) + 1, float min_df / max_df are
    shares of N, sublinear tf = 1 + ln(tf), L2 norm per id.
    ``vocabulary`` (term) fixes the terms instead (H3). Returns (id, term, weight)."""
    if n_docs is None:
        n_docs = counts.select(id_col).distinct().agg(F.count(F.lit(1)).cast("bigint").alias("__N"))
    df_t = counts.groupBy("term").agg(F.count(F.lit(1)).cast("bigint").alias("df"))
    df_t = df_t.crossJoin(F.broadcast(n_docs))
    if vocabulary is None:
        lo = F.lit(float(min_df)) * F.col("__N").cast("double") if isinstance(min_df, float) else F.lit(min_df)
        hi = F.lit(float(max_df)) * F.col("__N").cast("double") if isinstance(max_df, float) else F.lit(max_df)
        df_t = df_t.filter((F.col("df") >= lo) & (F.col("df") <= hi))
    else:
        df_t = vocabulary.select("term").join(df_t, "term", "left").fillna(0, ["df"]).drop("__N").crossJoin(F.broadcast(n_docs))
    idf = df_t.select("term", (F.ln((F.lit(1.0) + F.col("__N")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf"))
    idf = cut_lineage(idf)
    if idf.count() <= MAX_BROADCAST_ROWS:
        # terms out of the vocabulary go before they are counted: the semi join moves below the count
        j = counts.join(F.broadcast(idf.select("term")), "term", "left_semi").join(F.broadcast(idf), "term")
    else:
        j = counts.join(idf, "term")
    tf = (F.lit(1.0) + F.ln(F.col("tf").cast("double"))) if sublinear else F.col("tf").cast("double")
    w = j.select(id_col, "term", (tf * F.col("idf")).alias("weight"))
    if norm == "l2":
        squares = F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(id_col))
        w = w.filter(F.col(id_col).isNotNull()).withColumn("__norm", F.sqrt(squares)).withColumn("weight", F.when(F.col("__norm") == 0, F.col("weight"))
                                           .otherwise(F.col("weight") / F.col("__norm"))).drop("__norm")
    return w


def function_word_freq(tokens_df: DataFrame, vocabulary: DataFrame, id_col: str = "text_id",
                       tokens_col: str = "tokens") -> DataFrame:
    """H3: unnormalised tf-idf over a fixed vocabulary, divided by (1 + tokens)."""
    n = tokens_df.select(id_col, F.size(tokens_col).alias("__n"))
    vocabulary = cut_lineage(vocabulary.select("term"))
    words = tokens_df.select(id_col, F.explode(tokens_col).alias("term"))
    # other tokens go before they are counted
    known = words.join(F.broadcast(vocabulary) if vocabulary.count() <= MAX_BROADCAST_ROWS else vocabulary, "term", "left_semi")
    c = known.groupBy(id_col, "term").agg(F.count(F.lit(1)).cast("bigint").alias("tf")).join(vocabulary, "term")
    n_docs = tokens_df.agg(F.count(F.lit(1)).cast("bigint").alias("__N"))
    w = tfidf(c, id_col, norm=None, vocabulary=vocabulary, n_docs=n_docs)
    return w.join(n, id_col).select(id_col, "term", (F.col("weight") / (F.lit(1.0) + F.col("__n"))).alias("weight"))


def punctuation_counts(df: DataFrame, id_col: str = "text_id", text_col: str = "text",
                       chars: Iterable[str] = PUNCTUATION) -> DataFrame:
    """H10 input: occurrences of each fixed punctuation character per text (long, nonzero only)."""
    arr = F.array(*[F.struct(F.lit(ch).alias("term"), (F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit(ch), F.lit(""))))
                             .cast("bigint").alias("tf")) for ch in chars])
    return df.select(id_col, F.inline(arr)).filter(F.col("tf") > 0)


def masked_stopwords(tokens, tags, stopwords: Sequence[str]) -> Column:
    """H4: keep a token if it is a stop word, else its POS tag."""
    sw = F.array(*[F.lit(w) for w in stopwords])
    return F.zip_with(F.col(tokens) if isinstance(tokens, str) else tokens, F.col(tags) if isinstance(tags, str) else tags,
                      lambda t, g: F.when(F.array_contains(sw, F.lower(t)), t).otherwise(g))


def misspelling_rates(tokens_df: DataFrame, word_lists: DataFrame, list_names: Sequence[str], id_col: str = "text_id",
                      tokens_col: str = "tokens") -> DataFrame:
    """H9: share of each text's tokens found in each word list (list, word); a
    text without tokens has rate 0 (q22). Long output (id, list, rate)."""
    n = tokens_df.select(id_col, F.size(tokens_col).alias("__n"))
    # a word's occurrences in a text are one row before they meet the lists: a frequent word is a row a text, not one a place
    toks = tokens_df.select(id_col, F.explode(tokens_col).alias("word")).groupBy(id_col, "word").agg(F.count(F.lit(1)).alias("__c"))
    hits = toks.join(word_lists.select("list", "word"), "word").groupBy(id_col, "list").agg(F.sum("__c").alias("__h"))
    grid = n.withColumn("list", F.explode(F.array(*[F.lit(x) for x in list_names])))
    g = grid.join(hits, [id_col, "list"], "left").fillna(0, ["__h"])
    return g.select(id_col, "list", F.when(F.col("__n") == 0, F.lit(0.0)).otherwise(F.col("__h") / F.col("__n")).alias("rate"))


def pos_tag_stats(df: DataFrame, tags: Sequence[str], id_col: str = "text_id", tokens_col: str = "tokens",
                  tags_col: str = "tags") -> DataFrame:
    """H8: per tag, share of the text's distinct words carrying it and their mean length."""
    ex = by_id(df.select(id_col, tokens_col, tags_col), id_col).select(id_col, F.explode(F.arrays_zip(F.col(tokens_col).alias("tok"), F.col(tags_col).alias("tag"))).alias("z")) \
        .select(id_col, F.lower("z.tok").alias("tok"), "z.tag")
    nd = ex.groupBy(id_col).agg(F.countDistinct("tok").alias("__nd"))
    per = ex.groupBy(id_col, "tag").agg(F.countDistinct("tok").alias("__d"), F.avg(F.length("tok")).alias("mean_len"))
    per = per.join(nd, id_col).withColumn("share", F.col("__d") / F.col("__nd"))
    return per.groupBy(id_col).pivot("tag", list(tags)).agg(F.first("share").alias("share"), F.first("mean_len").alias("len")).fillna(0.0)


def _label_paths(row: np.ndarray, edges: pa.StructArray, max_len: int) -> tuple[np.ndarray, list, np.ndarray]:
    """(row, path, n) of the edges (tok, head, dep) of several rows: a level of all their trees at once."""
    tok, head = (edges.field(c) for c in ("tok", "head"))
    has_tok, has_head = (x.is_valid().to_numpy(zero_copy_only=False) for x in (tok, head))
    tok, head = (x.fill_null(0).to_numpy().astype(np.int64) for x in (tok, head))
    code, both = np.unique(np.concatenate([tok, head]), return_inverse=True)
    below, above = row * len(code) + both[:len(tok)], row * len(code) + both[len(tok):]
    order = np.flatnonzero(has_head)
    order = order[np.argsort(above[order], kind="stable")]
    heads = above[order]
    dep = edges.field("dep").dictionary_encode(null_encoding="encode")
    labels, dep = dep.dictionary.to_pylist(), dep.indices.to_numpy().astype(np.int64)
    names = {x: i for i, x in enumerate(labels)}  # paths, labels first
    node, path = np.flatnonzero(has_head & (head == 0)), None
    path, rows, paths = dep[node], [], []
    for level in range(max_len):
        rows.append(row[node])
        paths.append(path)
        if level == max_len - 1 or not len(node):
            break
        node, path = node[has_tok[node]], path[has_tok[node]]
        lo, hi = np.searchsorted(heads, below[node]), np.searchsorted(heads, below[node], "right")
        n = hi - lo
        child = order[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
        pair, inv = np.unique(np.repeat(path, n) * len(labels) + dep[child], return_inverse=True)
        known = list(names)
        joined = ["_".join(x for x in (known[p // len(labels)], labels[p % len(labels)]) if x is not None) for p in pair.tolist()]
        node, path = child, np.array([names.setdefault(x, len(names)) for x in joined], np.int64)[inv]
    key, n = np.unique(np.concatenate(rows) * len(names) + np.concatenate(paths), return_counts=True)
    known = list(names)
    return key // len(names), [known[i] for i in (key % len(names)).tolist()], n


def dependency_ngrams(deps: DataFrame, max_len: int = 4, id_col: str = "text_id") -> DataFrame:
    """Label paths from the root down to each node, up to ``max_len`` labels.

    ``deps``: (text_id, tok INT, head INT (0 = root), dep STRING). A text's rows come together once and its tree is walked
    level by level in the task, many texts at a time. Output (text_id, path, n)."""
    whole = deps.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.collect_list(F.struct("tok", "head", "dep")).alias("e"))
    schema = ST.StructType([whole.schema[id_col], ST.StructField("path", ST.StringType()), ST.StructField("n", ST.LongType())])

    def part(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, TREES):
                ids, e = (c.slice(lo, TREES) for c in batch.columns)
                edges = pc.list_flatten(e)
                if len(edges):
                    row, path, n = _label_paths(pc.list_parent_indices(e).to_numpy().astype(np.int64), edges, max_len)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(path, pa.string()), pa.array(n, pa.int64())], names=schema.names)

    # rows without an id are no text's: only their roots count
    roots = deps.filter(F.col(id_col).isNull() & (F.col("head") == 0)).groupBy(id_col, F.col("dep").alias("path")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return whole.mapInArrow(part, schema).unionByName(roots)


def prepare_entries(df: DataFrame, text_col: str = "text", tags_col: str | None = None,
                    chunks_col: str | None = None, out: str = "entry") -> DataFrame:
    """Text -> struct(preprocessed = G3 masked text, tokens = G10 tokens of
    it, plus optional tag / chunk arrays given as input columns)."""
    pre = T.mask_urls(text_col)
    fields = [pre.alias("preprocessed"), T.tokenize(pre).alias("tokens")]
    if tags_col is not None:
        fields.append(F.col(tags_col).alias("pos_tags"))
    if chunks_col is not None:
        fields.append(F.col(chunks_col).alias("pos_tag_chunks"))
    return df.withColumn(out, F.struct(*fields))


def prepare_tweet_entries(df: DataFrame, user_col: str = "author", text_col: str = "text", order_col: str = "post_id",
                          out: str = "entry") -> DataFrame:
    """H16 (tweets): all tweets of a user, G4-masked, joined by newlines in
    ``order_col`` order, as one entry per user."""
    g = df.groupBy(user_col).agg(F.sort_array(F.collect_list(F.struct(F.col(order_col), T.mask_tweet(text_col).alias("t")))).alias("__s"))
    joined = F.array_join(F.transform("__s", lambda x: x["t"]), "\n")
    return g.select(user_col, F.struct(joined.alias("preprocessed"), T.tokenize(joined).alias("tokens")).alias(out))


def merge_entries(df: DataFrame, author_col: str = "author", entry_col: str = "entry", order_col: str = "text_id") -> DataFrame:
    """Concatenate an author's entries: preprocessed texts joined by a
    space, token arrays concatenated, in ``order_col`` order."""
    g = df.groupBy(author_col).agg(F.sort_array(F.collect_list(F.struct(F.col(order_col), F.col(entry_col)))).alias("__s"))
    return g.select(author_col, F.struct(
        F.array_join(F.transform("__s", lambda x: x[entry_col]["preprocessed"]), " ").alias("preprocessed"),
        F.flatten(F.transform("__s", lambda x: x[entry_col]["tokens"])).alias("tokens")).alias(entry_col))
