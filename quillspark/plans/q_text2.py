"""Registered queries: normalisation (G8, G9, G15), sentence markers and ids (G11-G13), block pairs (F16), triplet rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import normalize as NZ
from quillspark.functions import text as T
from quillspark.operators import encode, rank, stats, windows
from quillspark.operators import features as H
from quillspark.plans.registry import register
from quillspark.session import cut_lineage
from quillspark.sources import views


def _q(s):
    return T._q(s)


def _docs(spark, sf_dir):
    return views.table(spark, sf_dir, "documents")


_ENT = [("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"),
        ("&amp;", "&")]


def _html_sql(col: str) -> str:
    s = col
    for r in NZ.HTML_DROP_RES:
        s = f"regexp_replace({s}, {_q(r)}, '', 'g')"
    s = f"regexp_replace({s}, {_q(NZ.HTML_TAG_RE)}, '', 'g')"
    for a, b in _ENT:
        s = f"replace({s}, {_q(a)}, {_q(b)})"
    return s


@register("html_to_text", f"SELECT page_id, md5({_html_sql('html')}) AS h, length({_html_sql('html')}) AS n FROM pages")
def q_html_to_text(spark, sf_dir):
    p = views.table(spark, sf_dir, "pages").select("page_id", NZ.html_to_text("html").alias("t"))
    return p.select("page_id", F.md5("t").alias("h"), F.length("t").cast("bigint").alias("n"))


def _norm_sql(col: str) -> str:
    s = f"nfc_normalize({col})"
    s = f"regexp_replace({s}, {_q(NZ.ZERO_WIDTH_RE)}, '', 'g')"
    s = f"regexp_replace({s}, {_q(NZ.LINEBREAK_RE)}, chr(10), 'g')"
    s = f"regexp_replace({s}, {_q(NZ.NONBREAK_RE)}, ' ', 'g')"
    s = T.strip_sql(s)
    s = f"translate({s}, {_q(NZ.SINGLE_QUOTES)}, {_q(chr(39) * len(NZ.SINGLE_QUOTES))})"
    return f"translate({s}, {_q(NZ.DOUBLE_QUOTES)}, {_q(chr(34) * len(NZ.DOUBLE_QUOTES))})"


@register("normalize_text", f"SELECT doc_id, md5({_norm_sql('text')}) AS h FROM documents")
def q_normalize_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(NZ.normalize_text("text")).alias("h"))


def _tweet_sql(col: str) -> str:
    c = f"replace(replace({col}, '’', ''''), '…', '...')"
    toks = T.tokenize_sql(c)
    s = (f"array_to_string(list_transform({toks}, lambda tok: CASE WHEN starts_with(tok, '@') THEN '@USER' "
         f"WHEN starts_with(lower(tok), 'http') OR starts_with(lower(tok), 'www') THEN 'HTTPURL' ELSE tok END), ' ')")
    s = f"concat({s}, ' ')"
    for a, b in NZ.TWEET_REPLACEMENTS:
        s = f"replace({s}, {_q(a)}, {_q(b)})"
    return f"regexp_replace({T.strip_sql(s)}, {_q(T.ALL_WS_RE)}, ' ', 'g')"


@register("normalize_tweet", f"SELECT conv_id, turn, {_tweet_sql('text')} AS text FROM conversations")
def q_normalize_tweet(spark, sf_dir):
    c = views.table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", NZ.normalize_tweet("text").alias("text"))


T_W = 12


def _markers_sql(t_w: int, joined: bool = True) -> str:
    cap = t_w - 1
    rest = f"toks[{cap + 1}:]"
    m = f"CAST(ceil(len({rest}) / {cap - 1}) AS BIGINT)"
    long = (f"list_concat([array_to_string(list_concat(toks[1:{cap}], ['<ELB>']), ' ')], "
            f"list_transform(generate_series(0, {m} - 1), lambda j: array_to_string(list_concat(['<SLB>'], "
            f"({rest})[j * {cap - 1} + 1 : j * {cap - 1} + {cap - 1}], [CASE WHEN j = {m} - 1 THEN '<EOS>' ELSE '<ELB>' END]), ' ')))")
    return f"""
    WITH s AS (SELECT doc_id, unnest(sents) AS sent, unnest(generate_series(1, len(sents))) AS si
               FROM (SELECT doc_id, {T.tokenized_sentences_sql('text')} AS sents FROM documents) x),
    t AS (SELECT doc_id, si, list_concat(['<SOS>'], list_filter(string_split(sent, ' '), lambda x: x <> '')) AS toks FROM s),
    p AS (SELECT doc_id, si, CASE WHEN len(toks) <= {cap} THEN [array_to_string(list_concat(toks, ['<EOS>']), ' ')] ELSE {long} END AS pieces FROM t)
    SELECT d.doc_id, {"coalesce(array_to_string(flatten(list(p.pieces ORDER BY p.si)), ' | '), '')" if joined else "flatten(list(p.pieces ORDER BY p.si))"} AS pieces
    FROM documents d LEFT JOIN p ON d.doc_id = p.doc_id GROUP BY d.doc_id"""


@register("add_markers", _markers_sql(T_W))
def q_add_markers(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return d.select("doc_id", F.array_join(encode.add_markers(T.tokenized_sentences("text"), T_W), " | ").alias("pieces"))


@register("encode_ids")
def q_encode_ids(spark, sf_dir):
    """G13 + E3 + D4 (Z9): vocabulary from the corpus, ids padded to 50 x 12 (rows-only check)."""
    d = _docs(spark, sf_dir)
    counts = stats.count_terms(H.token_table(d, "doc_id"), "token")
    vocab = rank.build_vocab(counts, min_count=2, top_k=5000).select("term", "id")
    p = d.select("doc_id", encode.add_markers(T.tokenized_sentences("text"), T_W).alias("pieces"))
    e = encode.encode_ids(p, vocab, "doc_id", "pieces", 50, T_W)
    return e.select("doc_id", "n_sents", F.size("ids").alias("rows"), F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + F.size(x)).alias("cells"))


# the vocabularies as the library's vocabulary query numbers them; grids as text, all cells
_CHAR_COUNTS_SQL = "SELECT ch AS term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '(?s).')) AS ch FROM documents) c GROUP BY ch"
_GRID = (50, 12, 15)


def _char_vocab(spark, sf_dir):
    counts = _docs(spark, sf_dir).select(F.explode(F.regexp_extract_all("text", F.lit("(?s)."), 0)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    v = counts.filter("n >= 50").select("term", (F.ascii("term") + 2).cast("int").alias("id"))
    return v.unionByName(spark.createDataFrame([(encode.PAD, 0), (encode.UNK, 1)], "term string, id int"))


def _cells(x):
    return F.md5(F.array_join(F.flatten(F.flatten(x)).cast("array<string>"), ","))


@register("encode_chars", f"""
    WITH v AS (SELECT term, unicode(term) + 2 AS id FROM ({_CHAR_COUNTS_SQL}) c WHERE n >= 50),
    m AS (SELECT map_from_entries(list((term, id))) AS ids FROM v),
    s AS (SELECT doc_id, coalesce(list_filter(pieces, lambda x: x IS NOT NULL), [])[1:{_GRID[0]}] AS p FROM ({_markers_sql(T_W, False)}) x),
    t AS (SELECT doc_id, list_transform(p, lambda x: string_split(x, ' ')[1:{_GRID[1]}]) AS t FROM s),
    c AS (SELECT doc_id, t, list_transform(range(1, {_GRID[0] + 1}), lambda i: list_transform(range(1, {_GRID[1] + 1}), lambda j: list_transform(range(1, {_GRID[2] + 1}),
            lambda k: CASE WHEN coalesce(substr(t[i][j], k, 1), '') = '' THEN 0 ELSE coalesce(m.ids[substr(t[i][j], k, 1)], 1) END))) AS g FROM t, m)
    SELECT doc_id, CAST(len(t) AS INTEGER) AS n_sents, CAST(coalesce(list_sum(list_transform(t, lambda x: len(x))), 0) AS BIGINT) AS n_tokens,
      CAST(coalesce(list_sum(list_transform(flatten(t), lambda x: least(length(x), {_GRID[2]}))), 0) AS BIGINT) AS n_chars,
      md5(array_to_string(flatten(flatten(g)), ',')) AS cells FROM c""")
def q_encode_chars(spark, sf_dir):
    """The character grid of every text, all cells, and the true lengths."""
    d = H.by_id(_docs(spark, sf_dir).select("doc_id", "text"), "doc_id")
    # the pieces are read several times
    d = cut_lineage(d.select("doc_id", encode.add_markers(T.tokenized_sentences("text"), T_W).alias("pieces")))
    e = encode.encode_chars(d, _char_vocab(spark, sf_dir), "doc_id", "pieces", *_GRID)

    def total(a):
        return F.aggregate(a, F.lit(0).cast("bigint"), lambda x, y: x + y)
    return e.select("doc_id", "n_sents", total("n_tokens").alias("n_tokens"), total(F.flatten("n_chars")).alias("n_chars"), _cells("chars").alias("cells"))


@register("pairs_from_blocks", f"""
    SELECT p.pair_id, CAST(w AS BIGINT) AS pos, substr(p.text0, CAST(w * 1280 + 1 AS BIGINT), 1280) AS chunk0, substr(p.text1, CAST(w * 1280 + 1 AS BIGINT), 1280) AS chunk1
    FROM (SELECT concat(CAST(a.conv_id AS VARCHAR), ':', CAST(a.turn AS VARCHAR)) AS pair_id, a.text AS text0, b.text AS text1
          FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1) p,
         LATERAL (SELECT unnest(generate_series(0, CAST(least(ceil(length(p.text0) / 1280), ceil(length(p.text1) / 1280)) AS BIGINT) - 1)) AS w) g""")
def q_pairs_from_blocks(spark, sf_dir):
    c = views.table(spark, sf_dir, "conversations")
    a = c.select("conv_id", "turn", F.col("text").alias("text0"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("text1"))
    p = a.join(b, ["conv_id", "turn"]).select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("pair_id"), "text0", "text1")
    return windows.pairs_from_blocks(p, 1280, "pair_id", "text0", "text1")


@register("triplet_rows", "SELECT source AS author, doc_id AS text_id FROM documents")
def q_triplet_rows(spark, sf_dir):
    from quillspark.operators.pairs import triplet_rows
    return triplet_rows(views.posts(spark, sf_dir), "author", "post_id").select("author", F.col("post_id").alias("text_id"))
