"""Vector similarity scoring and vector attribution.

Vectors are ARRAY<FLOAT/DOUBLE> columns; distances of pairs are array expressions
evaluated inside the row. Text x candidate comparisons never emit one row per
(text, candidate): texts and candidates are dealt into blocks of about
``block_size`` vectors, a pair of blocks is compared as arrays, and only the k best
candidates of a block leave it; a final window merges the blocks.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_SIZE = 4096
QUERY_ROWS = 64  # of a block at a time
FEW = 8


def _arr(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def euclidean(a, b) -> Column:
    """K1."""
    return F.sqrt(F.aggregate(F.zip_with(_arr(a), _arr(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
                              F.lit(0.0), lambda acc, v: acc + v))


def manhattan(a, b) -> Column:
    """K1."""
    return F.aggregate(F.zip_with(_arr(a), _arr(b), lambda x, y: F.abs(x.cast("double") - y.cast("double"))),
                       F.lit(0.0), lambda acc, v: acc + v)


def _dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_arr(a), _arr(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v)


def cosine_similarity(a, b) -> Column:
    """K1: a.b / (|a| |b|); NULL when a vector is all zero."""
    na, nb = F.sqrt(_dot(a, a)), F.sqrt(_dot(b, b))
    return F.when((na == 0) | (nb == 0), F.lit(None).cast("double")).otherwise(_dot(a, b) / (na * nb))


def cosine_distance(a, b) -> Column:
    """K1: 1 - cosine similarity."""
    return F.lit(1.0) - cosine_similarity(a, b)


def cosine_01(a, b) -> Column:
    """K1: cosine similarity mapped to 0..1."""
    return (cosine_similarity(a, b) + F.lit(1.0)) / F.lit(2.0)


def distance(a, b, metric: str = "euclidean") -> Column:
    return {"euclidean": euclidean, "manhattan": manhattan, "cosine": cosine_distance}[metric](a, b)


def inverse_similarity(d) -> Column:
    """K2: 1 / (1 + d)."""
    return F.lit(1.0) / (F.lit(1.0) + _arr(d))


def kernel_similarity(d, gamma: float = 0.09) -> Column:
    """K2: exp(-gamma d^3) + 1e-10."""
    x = _arr(d)
    return F.exp(-F.lit(gamma) * x * x * x) + F.lit(1e-10)


def score_vector_pairs(pairs: DataFrame, vectors: DataFrame, threshold: float = 0.5, metric: str = "euclidean",
                       id_a: str = "text_id_a", id_b: str = "text_id_b", vec_col: str = "embedding",
                       id_col: str = "text_id") -> DataFrame:
    """K3: join both vectors by id, distance -> 1/(1+d) -> label (sim >= threshold)."""
    va = vectors.select(F.col(id_col).alias(id_a), F.col(vec_col).alias("__va"))
    vb = vectors.select(F.col(id_col).alias(id_b), F.col(vec_col).alias("__vb"))
    j = pairs.join(va, id_a).join(vb, id_b)
    d = distance("__va", "__vb", metric)
    j = j.withColumn("distance", d).withColumn("similarity", inverse_similarity("distance"))
    return j.withColumn("pred", (F.col("similarity") >= threshold).cast("int")).drop("__va", "__vb")


def contrastive_loss(df: DataFrame, sim_col: str = "similarity", label_col: str = "label", m_s: float = 0.75,
                     m_d: float = 0.25) -> DataFrame:
    """K5: mean of y max(0, m_s - sim)^2 + (1 - y) max(0, sim - m_d)^2."""
    y = F.col(label_col).cast("double")
    s = F.col(sim_col)
    term = y * F.pow(F.greatest(F.lit(0.0), F.lit(m_s) - s), 2) + (F.lit(1.0) - y) * F.pow(F.greatest(F.lit(0.0), s - F.lit(m_d)), 2)
    return df.agg(F.avg(term).alias("loss"))


def author_centroids(vectors: DataFrame, author_col: str = "author_id", vec_col: str = "embedding") -> DataFrame:
    """Mean vector per author (element-wise, in dimension order)."""
    ex = vectors.select(author_col, F.posexplode(vec_col).alias("dim", "x"))
    per = ex.groupBy(author_col, "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return per.groupBy(author_col).agg(F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("__s")).select(
        author_col, F.transform("__s", lambda s: s["x"]).alias("centroid"))


def mean_vectors(vectors: DataFrame, keys: Sequence[str], vec_col: str = "embedding", out: str = "centroid") -> DataFrame:
    """Element-wise mean per key, summed as whole vectors per partition: a group of any size sends one vector a task."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    v = array_to_vector(F.col(vec_col).cast("array<double>"))
    return vectors.groupBy(*keys).agg(vector_to_array(Summarizer.mean(v)).alias(out))


def author_vectors(chunks: DataFrame, form: str = "mean", max_texts: int | None = None, author_col: str = "author_id", id_col: str = "text_id",
                   pos_col: str = "pos", vec_col: str = "embedding") -> DataFrame:
    """D10 over chunk vectors (author, text, pos, vector); (author, pos, embedding), ``pos`` null where it means nothing.

    * ``mean``: mean over texts of each text's mean over its chunks, so long texts weigh as much as short ones;
    * ``chunk``: mean per chunk position over the texts that have that chunk;
    * ``first``: the chunk vectors of the author's first text (smallest id);
    * ``all``: every chunk vector.

    ``max_texts`` keeps an author's first texts only (the reference's n documents per author)."""
    cols = [F.col(author_col).alias("author"), F.col(id_col).alias("text"), F.col(pos_col).cast("bigint").alias("pos"), F.col(vec_col).alias("v")]
    c = chunks.select(*cols)
    if max_texts is not None:
        from quillspark.operators.ranking import ordinal_in_group
        few = ordinal_in_group(c.select("author", "text").distinct(), ["author"], ["text"], col="at").filter(F.col("at") < max_texts)
        c = c.join(few.select("author", "text"), ["author", "text"], "left_semi")
    if form == "mean":
        out = mean_vectors(mean_vectors(c, ["author", "text"], "v", "v"), ["author"], "v", "v").withColumn("pos", F.lit(None).cast("bigint"))
    elif form == "chunk":
        out = mean_vectors(c, ["author", "pos"], "v", "v")
    elif form == "first":
        first = c.groupBy("author").agg(F.min("text").alias("text"))
        out = c.join(first, ["author", "text"], "left_semi")
    elif form == "all":
        out = c
    else:
        raise ValueError(f"unknown form {form}")
    return out.select(F.col("author").alias(author_col), *(["text"] if form == "all" else []), "pos", F.col("v").alias(vec_col))


def chunked_pair_scores(pairs: DataFrame, chunks: DataFrame, metric: str = "euclidean", reduce: str = "mean", similarity=inverse_similarity,
                        pair_col: str = "pair_id", id_a: str = "text_id_a", id_b: str = "text_id_b", id_col: str = "text_id",
                        pos_col: str = "pos", vec_col: str = "embedding", seed: int = 42) -> DataFrame:
    """K6: chunk i of one text against chunk i of the other up to the shorter text, distances reduced per pair
    (``reduce``: mean, median, first, random), then a similarity. (pair, n_chunks, distance, similarity).

    Vectors are met by two equi joins on (text, position), never text by text; a pair without a common chunk has n_chunks 0 and nulls."""
    from quillspark.operators.stats import pair_reduce
    v = chunks.select(F.col(id_col).alias("__t"), F.col(pos_col).cast("bigint").alias("pos"), F.col(vec_col).alias("__v"))
    left = pairs.select(pair_col, id_a, id_b).join(v.withColumnsRenamed({"__t": id_a, "__v": "__va"}), id_a)
    both = left.join(v.withColumnsRenamed({"__t": id_b, "__v": "__vb"}), [id_b, "pos"]).select(pair_col, "pos", distance("__va", "__vb", metric).alias("d"))
    reduced = pair_reduce(both, pair_col, "pos", "d", seed).join(both.groupBy(pair_col).agg(F.count(F.lit(1)).alias("n_chunks")), pair_col)
    out = pairs.select(pair_col).join(reduced, pair_col, "left")
    return out.select(pair_col, F.coalesce("n_chunks", F.lit(0)).cast("bigint").alias("n_chunks"), F.col(f"d_{reduce}").alias("distance"),
                      similarity(F.col(f"d_{reduce}")).alias("similarity"))


def _matrix(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows of doubles and their lengths; -1 for a vector that is null or holds a null."""
    lists = col.combine_chunks()
    size = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    if not values.null_count and (size == size[0]).all() and size[0] >= 0:
        return values.to_numpy().astype(np.float64).reshape(len(size), size[0]), size
    out = np.zeros((len(size), max(size.max(), 0)))
    for i, v in enumerate(lists.to_pylist()):
        if v is None or None in v:
            size[i] = -1
        else:
            out[i, : len(v)] = v
    return out, size


def _summed(a: np.ndarray, b: np.ndarray, term) -> np.ndarray:
    """Sum over dimensions, one after the other, of a term for every row of ``a`` and every row of ``b``."""
    acc = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, b.T):
        acc += term(x[:, None], y[None, :])
    return acc


def _distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """``distance`` for every row of ``a`` and every row of ``b`` with the same sums; NaN with ``cosine`` for a zero vector."""
    if metric == "euclidean":
        def squared(x, y):
            d = x - y
            d *= d
            return d
        return np.sqrt(_summed(a, b, squared))
    if metric == "manhattan":
        return _summed(a, b, lambda x, y: np.abs(x - y))
    na, nb = (np.sqrt(sum((x * x for x in m.T), np.zeros(len(m)))) for m in (a, b))
    with np.errstate(divide="ignore", invalid="ignore"):
        return 1.0 - _summed(a, b, np.multiply) / (na[:, None] * nb[None, :])


def _nearest_block(k: int | None, metric: str, exclude_self: bool, same_label: bool | None, largest: bool):
    """The k best candidates of a block for each query of a block, as (query, o, cid, label); a null distance comes first."""
    def codes(x, y):
        both = pa.chunked_array([*x.chunks, *y.chunks]).combine_chunks().dictionary_encode().indices
        c = pc.fill_null(both, -1).to_numpy(zero_copy_only=False)
        return c[: len(x)], c[len(x):]

    def best(queries: pa.Table, cands: pa.Table) -> pa.Table:
        cands = cands.take(pc.sort_indices(cands["cid"], null_placement="at_start"))  # equal distances go to the smaller id
        picked = []
        if len(queries) and len(cands):
            (q, qn), (c, cn) = _matrix(queries["v"]), _matrix(cands["v"])
            width = max(q.shape[1], c.shape[1])
            q, c = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, c))
            ids = codes(queries["query"].cast(cands["cid"].type), cands["cid"]) if exclude_self else None
            labels = codes(queries["ql"].cast(cands["label"].type), cands["label"]) if same_label is not None else None
            for lo in range(0, len(q), QUERY_ROWS):
                at = slice(lo, lo + QUERY_ROWS)
                d = _distances(q[at], c, metric)
                none = (qn[at, None] < 0) | (qn[at, None] != cn[None, :])
                if metric == "cosine":
                    none |= np.isnan(d) & ~(np.isnan(q[at]).any(1)[:, None] | np.isnan(c).any(1)[None, :])
                out = np.zeros(d.shape, bool)
                if ids is not None:
                    out |= (ids[0][at, None] == ids[1][None, :]) | (ids[0][at, None] < 0) | (ids[1][None, :] < 0)
                if labels is not None:
                    out |= ((labels[0][at, None] == labels[1][None, :]) != same_label) | (labels[0][at, None] < 0) | (labels[1][None, :] < 0)
                o = -d if largest else d
                order = np.where(none, -np.inf, np.where(np.isnan(o), np.inf, o))
                order[out] = np.nan
                if k is None or k > FEW:
                    cols = np.argsort(order, axis=1, kind="stable")[:, :k]
                else:
                    cols = np.empty((len(order), min(k, order.shape[1])), np.int64)
                    rows = np.arange(len(order))
                    left = np.where(out, np.inf, order)
                    for i in range(cols.shape[1]):
                        cols[:, i] = left.argmin(1)
                        left[rows, cols[:, i]] = np.inf
                rows = np.repeat(np.arange(len(order)), cols.shape[1])
                cols = cols.ravel()
                fits = ~out[rows, cols]
                rows, cols = rows[fits], cols[fits]
                if k is not None and k <= FEW and len(rows):  # a column is taken again when a row has fewer than k candidates
                    first = np.unique(rows * order.shape[1] + cols, return_index=True)[1]
                    rows, cols = rows[first], cols[first]
                picked.append((rows + lo, cols, o[rows, cols], none[rows, cols]))
        rows, cols, o, none = (np.concatenate(x) for x in zip(*picked)) if picked else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool))
        return pa.table({"query": queries["query"].take(pa.array(rows)), "o": pa.array(o, pa.float64(), mask=none),
                         "cid": cands["cid"].take(pa.array(cols)), "label": cands["label"].take(pa.array(cols))})
    return best


def nearest_candidates(queries: DataFrame, cands: DataFrame, k: int | None = 1, metric: str = "euclidean",
                       query_id: str = "text_id", cand_id: str = "cand_id", label_col: str = "author_id",
                       vec_col: str = "embedding", exclude_self: bool = False, same_label: bool | None = None,
                       query_label: str | None = None, block_size: int = BLOCK_SIZE, largest: bool = False) -> DataFrame:
    """Exact k nearest (or farthest) candidates per query vector, block by block; all candidates if k is None.

    Queries and candidates are dealt into blocks of about ``block_size`` by a hash of the id; each pair of blocks is
    one group, whose distances are computed as arrays. Output (query_id, rank, cand_id, label, d) with rank 1..k.
    ``same_label`` restricts candidates to the query's label (True) or the other labels
    (False); ``exclude_self`` drops cand_id == query_id.
    """
    q = queries.select(F.col(query_id).alias("query"), F.col(vec_col).alias("v"), *([F.col(query_label).alias("ql")] if query_label else []))
    c = cands.select(F.col(cand_id).alias("cid"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))

    def blocks(n: int) -> int:  # small tables are cut finer, for the tasks
        return max(1, -(-n // block_size), min(8, n // 256))

    nq, nc = blocks(q.count()), blocks(c.count())
    left = q.select(F.pmod(F.xxhash64("query"), F.lit(nq)).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(nc - 1)).cast("array<bigint>")).alias("cb"), "*")
    right = c.select(F.explode(F.sequence(F.lit(0), F.lit(nq - 1)).cast("array<bigint>")).alias("qb"), F.pmod(F.xxhash64("cid"), F.lit(nc)).alias("cb"), "*")
    schema = T.StructType([T.StructField("query", q.schema["query"].dataType), T.StructField("o", T.DoubleType()),
                           T.StructField("cid", c.schema["cid"].dataType), T.StructField("label", c.schema["label"].dataType)])
    top = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(
        _nearest_block(k, metric, exclude_self, same_label if query_label else None, largest), schema)
    w = Window.partitionBy("query").orderBy(F.col("o"), F.col("cid"))
    best = top.withColumn("rank", F.row_number().over(w))
    if k is not None:
        best = best.filter(F.col("rank") <= k)
    d = -F.col("o") if largest else F.col("o")
    return best.select(F.col("query").alias(query_id), F.col("rank").cast("bigint").alias("rank"), F.col("cid").alias(cand_id),
                       F.col("label").alias(label_col), d.alias("d"))


def attribute_by_vectors(test: DataFrame, train: DataFrame, metric: str = "euclidean", id_col: str = "text_id",
                         author_col: str = "author_id", vec_col: str = "embedding") -> DataFrame:
    """Nearest author centroid per test vector (smallest author id on ties)."""
    c = author_centroids(train, author_col, vec_col).select(F.col(author_col).alias("cand_id"), F.col(author_col), F.col("centroid").alias(vec_col))
    nn = nearest_candidates(test, c, 1, metric, id_col, "cand_id", author_col, vec_col)
    return nn.select(id_col, F.col(author_col).alias("pred"), F.col("d"))


def knn_attribution(test: DataFrame, train: DataFrame, k: int = 3, metric: str = "euclidean", id_col: str = "text_id",
                    author_col: str = "author_id", vec_col: str = "embedding") -> DataFrame:
    """Majority author among the k nearest training vectors; ties -> smallest author."""
    from quillspark.operators.rank import knn_vote
    cands = train.select(F.col(id_col).alias("cand_id"), author_col, vec_col)
    nn = nearest_candidates(test, cands, k, metric, id_col, "cand_id", author_col, vec_col)
    return knn_vote(nn, k, id_col, author_col, "d", "cand_id")


def hard_pairs(vectors: DataFrame, metric: str = "euclidean", id_col: str = "text_id", author_col: str = "author_id",
               vec_col: str = "embedding") -> DataFrame:
    """For each text the hardest positive (farthest text of the same
    author) and hardest negative (closest text of another author)."""
    cands = vectors.select(F.col(id_col).alias("cand_id"), author_col, vec_col)
    pos = nearest_candidates(vectors, cands, 1, metric, id_col, "cand_id", author_col, vec_col, exclude_self=True,
                             same_label=True, query_label=author_col, largest=True)
    neg = nearest_candidates(vectors, cands, 1, metric, id_col, "cand_id", author_col, vec_col, exclude_self=True,
                             same_label=False, query_label=author_col)
    return (pos.select(id_col, F.col("cand_id").alias("hard_pos"), F.col("d").alias("d_pos"))
            .join(neg.select(id_col, F.col("cand_id").alias("hard_neg"), F.col("d").alias("d_neg")), id_col, "full"))
