"""Registered queries: vector distances, similarity scoring and vector attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import key_sql
from quillspark.operators import pairs, rank, splits, stats
from quillspark.operators import vectors as V
from quillspark.plans.registry import register
from quillspark.plans import sql_twins as Q
from quillspark.sources import views

_C1, _C2 = 0.6, 0.6 + 0.2


def D(x) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _vec(spark, sf_dir):
    return views.vec(spark, sf_dir)


_VEC_AA = "SELECT author_id, text_id FROM (" + views.vec_sql() + ") v"
_VP_SQL = f"""SELECT p.text_id_a, p.text_id_b, p.label, a.embedding AS va, b.embedding AS vb FROM ({Q.pairs_per_text_sql(_VEC_AA)}) p
    JOIN ({views.vec_sql()}) a ON a.text_id = p.text_id_a JOIN ({views.vec_sql()}) b ON b.text_id = p.text_id_b"""


def _vpairs(spark, sf_dir):
    v = _vec(spark, sf_dir)
    p = pairs.pairs_per_text(v.select("author_id", "text_id"), "author_id", "text_id")
    return (p.join(v.select(F.col("text_id").alias("text_id_a"), F.col("embedding").alias("va")), "text_id_a")
            .join(v.select(F.col("text_id").alias("text_id_b"), F.col("embedding").alias("vb")), "text_id_b"))


def _sum_sql(expr: str) -> str:
    return f"list_reduce(list_transform(generate_series(1, len(va)), lambda i: {expr}), lambda x, y: x + y, {D(0)})"


_EUC = f"sqrt({_sum_sql('(CAST(va[i] AS DOUBLE) - CAST(vb[i] AS DOUBLE)) * (CAST(va[i] AS DOUBLE) - CAST(vb[i] AS DOUBLE))')})"
_MAN = _sum_sql("abs(CAST(va[i] AS DOUBLE) - CAST(vb[i] AS DOUBLE))")


def _dot_sql(x, y):
    return f"list_reduce(list_transform(generate_series(1, len({x})), lambda i: CAST({x}[i] AS DOUBLE) * CAST({y}[i] AS DOUBLE)), lambda p, q: p + q, {D(0)})"


_COS = f"({D(1)} - {_dot_sql('va', 'vb')} / (sqrt({_dot_sql('va', 'va')}) * sqrt({_dot_sql('vb', 'vb')})))"


@register("vector_distance", f"""SELECT text_id_a, text_id_b, label, round({_EUC}, 9) AS euclidean, round({_MAN}, 9) AS manhattan,
    round({_COS}, 9) AS cosine FROM ({_VP_SQL}) x""")
def q_vector_distance(spark, sf_dir):
    p = _vpairs(spark, sf_dir)
    return p.select("text_id_a", "text_id_b", "label", F.round(V.euclidean("va", "vb"), 9).alias("euclidean"),
                    F.round(V.manhattan("va", "vb"), 9).alias("manhattan"), F.round(V.cosine_distance("va", "vb"), 9).alias("cosine"))


@register("distance_to_similarity", f"""SELECT text_id_a, text_id_b, round({D(1)} / ({D(1)} + {_EUC}), 9) AS inv_sim,
    round(exp(-{D(0.09)} * {_EUC} * {_EUC} * {_EUC}) + {D(1e-10)}, 9) AS kernel_sim FROM ({_VP_SQL}) x""")
def q_distance_to_similarity(spark, sf_dir):
    p = _vpairs(spark, sf_dir).withColumn("d", V.euclidean("va", "vb"))
    return p.select("text_id_a", "text_id_b", F.round(V.inverse_similarity("d"), 9).alias("inv_sim"),
                    F.round(V.kernel_similarity("d"), 9).alias("kernel_sim"))


_THR = 0.1


@register("score_vector_pairs", f"""SELECT text_id_a, text_id_b, label, CAST({D(1)} / ({D(1)} + {_EUC}) >= {D(_THR)} AS INTEGER) AS pred
    FROM ({_VP_SQL}) x""")
def q_score_vector_pairs(spark, sf_dir):
    v = _vec(spark, sf_dir)
    p = pairs.pairs_per_text(v.select("author_id", "text_id"), "author_id", "text_id")
    return V.score_vector_pairs(p, v, _THR).select("text_id_a", "text_id_b", "label", "pred")


@register("contrastive_loss", f"""SELECT round(avg(CAST(label AS DOUBLE) * pow(greatest({D(0)}, {D(0.75)} - s), 2)
    + ({D(1)} - CAST(label AS DOUBLE)) * pow(greatest({D(0)}, s - {D(0.25)}), 2)), 9) AS loss
    FROM (SELECT label, {D(1)} / ({D(1)} + {_EUC}) AS s FROM ({_VP_SQL}) x) y""")
def q_contrastive_loss(spark, sf_dir):
    p = _vpairs(spark, sf_dir).withColumn("similarity", V.inverse_similarity(V.euclidean("va", "vb")))
    return V.contrastive_loss(p, "similarity", "label").select(F.round("loss", 9).alias("loss"))


_CHUNKS = 4


# chunk vectors of 16 dimensions; texts have one to four of them
def _chunk_vectors(spark, sf_dir):
    v = _vec(spark, sf_dir).select("author_id", "text_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(_CHUNKS - 1))).alias("pos"))
    return v.filter(F.col("pos") <= F.col("text_id") % _CHUNKS).select(
        "author_id", "text_id", F.col("pos").cast("bigint").alias("pos"), F.slice("embedding", F.col("pos") * 16 + 1, 16).alias("embedding"))


_CHUNK_SQL = f"""SELECT author_id, text_id, CAST(k AS BIGINT) AS pos, list_transform(generate_series(k * 16 + 1, k * 16 + 16), lambda i: CAST(embedding[i] AS DOUBLE)) AS v
    FROM ({views.vec_sql()}) v CROSS JOIN range(0, {_CHUNKS}) r(k) WHERE k <= text_id % {_CHUNKS}"""
_CELL_SQL = f"SELECT author_id, text_id, pos, unnest(v) AS x, unnest(generate_series(0, 15)) AS dim FROM ({_CHUNK_SQL}) c"


def _cells(df):
    return df.select("author_id", "pos", F.posexplode("embedding").alias("dim", "x")).select(
        "author_id", "pos", F.col("dim").cast("bigint").alias("dim"), F.round(F.col("x").cast("double"), 9).alias("x"))


@register("author_vectors_mean", f"""SELECT author_id, CAST(NULL AS BIGINT) AS pos, dim, round(avg(x), 9) AS x FROM (
    SELECT author_id, text_id, dim, avg(x) AS x FROM ({_CELL_SQL}) c GROUP BY ALL) t GROUP BY author_id, dim""")
def q_author_vectors_mean(spark, sf_dir):
    return _cells(V.author_vectors(_chunk_vectors(spark, sf_dir), "mean"))


@register("author_vectors_chunk", f"SELECT author_id, pos, dim, round(avg(x), 9) AS x FROM ({_CELL_SQL}) c GROUP BY author_id, pos, dim")
def q_author_vectors_chunk(spark, sf_dir):
    return _cells(V.author_vectors(_chunk_vectors(spark, sf_dir), "chunk"))


@register("author_vectors_first", f"""SELECT author_id, pos, dim, round(x, 9) AS x FROM ({_CELL_SQL}) c
    WHERE text_id = (SELECT min(text_id) FROM ({views.vec_sql()}) v WHERE v.author_id = c.author_id)""")
def q_author_vectors_first(spark, sf_dir):
    return _cells(V.author_vectors(_chunk_vectors(spark, sf_dir), "first"))


@register("chunked_pair_scores", f"""
    WITH c AS ({_CHUNK_SQL}),
    p AS (SELECT DISTINCT text_id_a, text_id_b, label, concat(CAST(text_id_a AS VARCHAR), '-', CAST(text_id_b AS VARCHAR), '-', CAST(label AS VARCHAR)) AS pair_id FROM ({_VP_SQL}) x),
    d AS (SELECT p.pair_id, sqrt(list_reduce(list_transform(generate_series(1, 16), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i])), lambda x, y: x + y, {D(0)})) AS d
          FROM p JOIN c a ON a.text_id = p.text_id_a JOIN c b ON b.text_id = p.text_id_b AND b.pos = a.pos),
    m AS (SELECT pair_id, count(*) AS n, CAST(median(d) AS DOUBLE) AS d FROM d GROUP BY pair_id)
    SELECT p.pair_id, CAST(coalesce(n, 0) AS BIGINT) AS n_chunks, round(d, 9) AS distance, round({D(1)} / ({D(1)} + d), 9) AS similarity
    FROM p LEFT JOIN m ON m.pair_id = p.pair_id""")
def q_chunked_pair_scores(spark, sf_dir):
    v = _vec(spark, sf_dir)
    p = pairs.pairs_per_text(v.select("author_id", "text_id"), "author_id", "text_id")
    pid = F.concat_ws("-", F.col("text_id_a").cast("string"), F.col("text_id_b").cast("string"), F.col("label").cast("string"))
    p = p.select(pid.alias("pair_id"), "text_id_a", "text_id_b").distinct()
    r = V.chunked_pair_scores(p, _chunk_vectors(spark, sf_dir), reduce="median")
    return r.select("pair_id", "n_chunks", F.round("distance", 9).alias("distance"), F.round("similarity", 9).alias("similarity"))


@register("pair_reduce", f"""
    WITH c AS (SELECT text_id_a, text_id_b, label, CAST(k AS BIGINT) AS pos,
                      sqrt(list_reduce(list_transform(generate_series(k * 16 + 1, k * 16 + 16), lambda i: (CAST(va[i] AS DOUBLE) - CAST(vb[i] AS DOUBLE)) * (CAST(va[i] AS DOUBLE) - CAST(vb[i] AS DOUBLE))), lambda x, y: x + y, {D(0)})) AS d
               FROM ({_VP_SQL}) x CROSS JOIN range(0, {_CHUNKS}) r(k)),
    c2 AS (SELECT concat(CAST(text_id_a AS VARCHAR), '-', CAST(text_id_b AS VARCHAR), '-', CAST(label AS VARCHAR)) AS pair_id, pos, d FROM c)
    SELECT pair_id, round(avg(d), 9) AS d_mean, round(CAST(median(d) AS DOUBLE), 9) AS d_median, round(first(d ORDER BY pos), 9) AS d_first,
      round(first(d ORDER BY {key_sql(42, 'pick', '@pair_id', '@pos')}, pos), 9) AS d_random FROM c2 GROUP BY pair_id""")
def q_pair_reduce(spark, sf_dir):
    p = _vpairs(spark, sf_dir)
    pid = F.concat_ws("-", F.col("text_id_a").cast("string"), F.col("text_id_b").cast("string"), F.col("label").cast("string"))
    ch = p.select(pid.alias("pair_id"), "va", "vb", F.explode(F.sequence(F.lit(0), F.lit(_CHUNKS - 1))).alias("pos"))
    ch = ch.select("pair_id", F.col("pos").cast("bigint").alias("pos"),
                   V.euclidean(F.slice("va", F.col("pos") * 16 + 1, 16), F.slice("vb", F.col("pos") * 16 + 1, 16)).alias("d"))
    r = stats.pair_reduce(ch, "pair_id", "pos", "d")
    return r.select("pair_id", *[F.round(c, 9).alias(c) for c in ("d_mean", "d_median", "d_first", "d_random")])


# vector attribution on a stratified split of the embeddings --------------------------
_VSPLIT_SQL = f"""SELECT text_id, author_id, embedding, CASE WHEN o < floor(CAST(n AS DOUBLE) * {_C1!r}) THEN 'train'
      WHEN o < floor(CAST(n AS DOUBLE) * {_C2!r}) THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY {key_sql(42, 'strat', '@text_id')}, text_id) - 1 AS o,
                 count(*) OVER (PARTITION BY author_id) AS n FROM ({views.vec_sql()}) v) x"""


def _vsplit(spark, sf_dir):
    return splits.split_stratified(_vec(spark, sf_dir), "author_id", "text_id", (0.6, 0.2, 0.2))


_CENT_SQL = f"""SELECT author_id, list(x ORDER BY dim) AS centroid FROM (
    SELECT author_id, dim, avg(CAST(x AS DOUBLE)) AS x FROM (
      SELECT author_id, unnest(embedding) AS x, unnest(generate_series(0, len(embedding) - 1)) AS dim FROM ({_VSPLIT_SQL}) s WHERE split = 'train') e
    GROUP BY author_id, dim) g GROUP BY author_id"""


@register("author_centroids", f"""SELECT author_id, CAST(dim AS INTEGER) AS dim, round(avg(CAST(x AS DOUBLE)), 9) AS x FROM (
    SELECT author_id, unnest(embedding) AS x, unnest(generate_series(0, len(embedding) - 1)) AS dim FROM ({_VSPLIT_SQL}) s WHERE split = 'train') e
    GROUP BY author_id, dim""")
def q_author_centroids(spark, sf_dir):
    c = V.author_centroids(_vsplit(spark, sf_dir).filter("split = 'train'"))
    return c.select("author_id", F.posexplode("centroid").alias("dim", "x")).select(
        "author_id", F.col("dim").cast("int").alias("dim"), F.round("x", 9).alias("x"))


_TC_SQL = f"""SELECT t.text_id, c.author_id, sqrt(list_reduce(list_transform(generate_series(1, len(t.embedding)),
      lambda i: (CAST(t.embedding[i] AS DOUBLE) - c.centroid[i]) * (CAST(t.embedding[i] AS DOUBLE) - c.centroid[i])), lambda x, y: x + y, {D(0)})) AS d
    FROM ({_VSPLIT_SQL}) t, ({_CENT_SQL}) c WHERE t.split = 'test'"""


@register("attribute_by_vectors", f"SELECT text_id, first(author_id ORDER BY d, author_id) AS pred, round(min(d), 9) AS d FROM ({_TC_SQL}) x GROUP BY text_id")
def q_attribute_by_vectors(spark, sf_dir):
    s = _vsplit(spark, sf_dir)
    r = V.attribute_by_vectors(s.filter("split = 'test'"), s.filter("split = 'train'"))
    return r.withColumn("d", F.round("d", 9))


@register("rank_authors_for_text", f"""SELECT text_id, author_id, round(d, 9) AS d, CAST(row_number() OVER (PARTITION BY text_id ORDER BY d, author_id) AS BIGINT) AS rank
    FROM ({_TC_SQL}) x""")
def q_rank_authors_for_text(spark, sf_dir):
    s = _vsplit(spark, sf_dir)
    c = V.author_centroids(s.filter("split = 'train'"))
    cands = c.select(F.col("author_id").alias("cand_id"), "author_id", F.col("centroid").alias("embedding"))
    nn = V.nearest_candidates(s.filter("split = 'test'"), cands, None, "euclidean", "text_id", "cand_id", "author_id")
    r = rank.rank_authors_for_text(nn.select("text_id", "author_id", F.col("d").alias("loss")), "text_id", "author_id", "loss")
    return r.select("text_id", "author_id", F.round("loss", 9).alias("d"), "rank")


@register("loss_normalised_ranking", f"""
    WITH val AS (SELECT t.author_id AS a, c.author_id, sqrt(list_reduce(list_transform(generate_series(1, len(t.embedding)),
      lambda i: (CAST(t.embedding[i] AS DOUBLE) - c.centroid[i]) * (CAST(t.embedding[i] AS DOUBLE) - c.centroid[i])), lambda x, y: x + y, {D(0)})) AS d
      FROM ({_VSPLIT_SQL}) t, ({_CENT_SQL}) c WHERE t.split = 'validation'),
    nrm AS (SELECT author_id, avg(d) AS mu FROM val GROUP BY author_id),
    x AS (SELECT tc.text_id, tc.author_id, tc.d - nrm.mu AS loss FROM ({_TC_SQL}) tc JOIN nrm ON tc.author_id = nrm.author_id)
    SELECT text_id, first(author_id ORDER BY loss, author_id) AS pred FROM x GROUP BY text_id""")
def q_loss_normalised_ranking(spark, sf_dir):
    from quillspark.operators.metrics_aa import loss_normalised_ranking
    s = _vsplit(spark, sf_dir)
    c = V.author_centroids(s.filter("split = 'train'"))
    cands = c.select(F.col("author_id").alias("cand_id"), "author_id", F.col("centroid").alias("embedding"))
    test = V.nearest_candidates(s.filter("split = 'test'"), cands, None, "euclidean", "text_id", "cand_id", "author_id")
    val = V.nearest_candidates(s.filter("split = 'validation'"), cands, None, "euclidean", "text_id", "cand_id", "author_id")
    r = loss_normalised_ranking(test.withColumnRenamed("d", "loss"), val.withColumnRenamed("d", "loss"))
    return r.filter("rank = 1").select("text_id", F.col("author_id").alias("pred"))


_KNN_SQL = f"""SELECT t.text_id, c.text_id AS cand_id, c.author_id, sqrt(list_reduce(list_transform(generate_series(1, len(t.embedding)),
      lambda i: (CAST(t.embedding[i] AS DOUBLE) - CAST(c.embedding[i] AS DOUBLE)) * (CAST(t.embedding[i] AS DOUBLE) - CAST(c.embedding[i] AS DOUBLE))), lambda x, y: x + y, {D(0)})) AS d
    FROM ({_VSPLIT_SQL}) t, ({_VSPLIT_SQL}) c WHERE t.split = 'test' AND c.split = 'train'"""


@register("knn_vote", f"""
    WITH nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text_id ORDER BY d, cand_id) AS rk FROM ({_KNN_SQL}) x) y WHERE rk <= 3),
    v AS (SELECT text_id, author_id, count(*) AS n FROM nn GROUP BY text_id, author_id)
    SELECT text_id, first(author_id ORDER BY n DESC, author_id) AS pred FROM v GROUP BY text_id""")
def q_knn_vote(spark, sf_dir):
    s = _vsplit(spark, sf_dir)
    return V.knn_attribution(s.filter("split = 'test'"), s.filter("split = 'train'"), 3)


_ALLV = f"""SELECT t.text_id, t.author_id AS ta, c.text_id AS cand_id, c.author_id AS ca, sqrt(list_reduce(list_transform(generate_series(1, len(t.embedding)),
      lambda i: (CAST(t.embedding[i] AS DOUBLE) - CAST(c.embedding[i] AS DOUBLE)) * (CAST(t.embedding[i] AS DOUBLE) - CAST(c.embedding[i] AS DOUBLE))), lambda x, y: x + y, {D(0)})) AS d
    FROM ({views.vec_sql()}) t, ({views.vec_sql()}) c WHERE t.text_id <> c.text_id"""


@register("hard_pairs", f"""
    WITH a AS ({_ALLV}),
    p AS (SELECT text_id, first(cand_id ORDER BY d DESC, cand_id) AS hard_pos, round(max(d), 9) AS d_pos FROM a WHERE ta = ca GROUP BY text_id),
    n AS (SELECT text_id, first(cand_id ORDER BY d, cand_id) AS hard_neg, round(min(d), 9) AS d_neg FROM a WHERE ta <> ca GROUP BY text_id)
    SELECT coalesce(p.text_id, n.text_id) AS text_id, hard_pos, d_pos, hard_neg, d_neg FROM p FULL JOIN n ON p.text_id = n.text_id""")
def q_hard_pairs(spark, sf_dir):
    h = V.hard_pairs(_vec(spark, sf_dir))
    return h.withColumn("d_pos", F.round("d_pos", 9)).withColumn("d_neg", F.round("d_neg", 9))
