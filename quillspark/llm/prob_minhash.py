"""Operator 1: near-duplicate groups by ProbMinHash.

A text is a weighted set: its five-word shingles with their counts (a shorter
text is one shingle of all its words). Every shingle starts a Poisson process
with its weight as rate, driven by its hash; each arrival offers the shingle to
one register, and a register keeps its earliest arrival. A shingle stops as soon
as its next arrival is later than every register's, which bounds the work to
about n + m log m arrivals for n shingles and m registers. Two texts agree in a
register with probability equal to their probability Jaccard similarity

    J_P(x, y) = sum over common i of 1 / sum_j max(x_j / x_i, y_j / y_i).

The first half of the registers is cut into bands (24 bands of 5: a pair at 0.8
meets with probability 0.9999). Pairs that meet are verified with the exact
J_P >= 0.8.

Equal texts form a class and are compared once, through the smallest id. In a
bucket all members are verified against the bucket's smallest member. Members
that are then still in different components are compared among themselves, in
blocks of a bucket and on sketches (a byte of each register): pairs that agree
in fewer registers than a pair at 0.8 does with probability 1 - 1e-6 are not
read again, all others are verified. So a bucket of thousands of near copies
costs about one check a member, pairs are never listed, only the links that join
components; such a link is lost only with the two probabilities above. Groups are
the connected components, computed without collecting links.

Rows that share an id are one document. Null ids never link: such rows return
null class and group. Null and empty texts (and texts without words) have no
shingles: they group by equality alone. Repeated rows are returned as often as
they come. An empty table gives no rows; other columns are ignored. Texts of any
length are used whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import textvec as V
from quillspark.llm.components import components, release
from quillspark.session import cut_lineage

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
REGISTERS = 240
AGREE = int(REGISTERS * THRESHOLD - 4.75 * (REGISTERS * THRESHOLD * (1 - THRESHOLD)) ** 0.5)
BLOCK = 512
BLOCK_BYTES, BLOCK_TEXTS = 1 << 20, 256
BROADCAST_IDS = 500_000  # 4 MB of ids; more are joined by shuffle


def weighted_shingles(raw: np.ndarray, offs: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, weight, text index) of the distinct shingles of each text of a slice, in text order."""
    n = len(offs) - 1
    starts, ends, of = V.runs(~V.SPACE[raw], offs)
    h = V.Hasher(raw).of(starts, ends)
    g, at = V.grams(h, of, words)
    owner = of[at]
    # texts of fewer words: one shingle of all of them
    count = V.word_counts(of, n)
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        base = np.searchsorted(of, short)
        one = np.zeros(len(short), np.uint64)
        for k in range(words - 1):
            have = count[short] > k
            one[have] = one[have] * V._GRAM + h[base[have] + k]
        g, owner = np.concatenate([g, V.mix(one + count[short].astype(np.uint64))]), np.concatenate([owner, short])
    _, first, weight = np.unique(V.in_text(g, owner), return_index=True, return_counts=True)
    order = np.argsort(owner[first], kind="stable")
    first = first[order]
    return g[first], weight[order], owner[first]


def signatures(g: np.ndarray, weight: np.ndarray, owner: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """(n, m) hash of the shingle with the earliest arrival in each register (0 for texts without shingles)."""
    early = np.full(n * m, np.inf)
    kept = np.zeros(n * m, np.uint64)
    live = np.arange(len(g))
    now = np.zeros(len(g))
    done = 0
    while len(live):
        k = int(np.clip((1 << 17) // len(live), 1, 32))  # arrivals a shingle in this round
        number = (np.arange(done + 1, done + k + 1, dtype=np.uint64) * V._GOLD)[None]
        draw = V.mix(g[live][:, None] + number)
        gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight[live][:, None]
        # one addition after the other, so that times do not depend on how rounds are cut
        time = np.cumsum(np.concatenate([now[live][:, None], gap], axis=1), axis=1)[:, 1:]
        slot = owner[live][:, None] * m + (V.mix(draw ^ V._GRAM) % np.uint64(m)).astype(np.int64)
        latest = early.reshape(n, m).max(axis=1)
        use = time < latest[owner[live]][:, None]
        s, t, e = slot[use], time[use], np.broadcast_to(g[live][:, None], slot.shape)[use]
        np.minimum.at(early, s, t)
        won = early[s] == t
        kept[s[won]] = e[won]
        now[live] = time[:, -1]
        live = live[time[:, -1] < early.reshape(n, m).max(axis=1)[owner[live]]]
        done += k
    return kept.reshape(n, m)


def band_hashes(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    n = len(sig)
    part = sig[:, : bands * ROWS].reshape(n, bands, ROWS)
    h = np.broadcast_to(V.mix(np.arange(1, bands + 1, dtype=np.uint64) * V._GOLD), (n, bands)).copy()
    for k in range(part.shape[2]):
        h = V.mix(h * V._GRAM + part[:, :, k])
    return h.view(np.int64)


def with_bands(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """id, d1, d2 (digest of the text), bands (array<long>, empty without shingles) and sketch (a byte a register)."""
    schema = T.StructType([df.schema[id_col], T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()),
                           T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for lo, hi, raw, offs in V.slices(batch.column(1)):
                n = hi - lo
                data = raw.tobytes()
                d = np.frombuffer(b"".join(hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())),
                                  np.int64).reshape(-1, 2)
                g, weight, owner = weighted_shingles(raw, offs)
                full = np.bincount(owner, minlength=n) > 0
                sig = signatures(g, weight, owner, n)
                bands = band_hashes(sig)[full]
                sketch = V.mix(sig).astype(np.uint8).tobytes()
                at = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.array(np.ascontiguousarray(d[:, 0])), pa.array(np.ascontiguousarray(d[:, 1])),
                                                  pa.ListArray.from_arrays(pa.array(at), pa.array(bands.ravel())),
                                                  pa.array([sketch[k: k + REGISTERS] for k in range(0, n * REGISTERS, REGISTERS)], pa.binary())], names=schema.names)
        V.give_back()

    return df.select(id_col, text).mapInArrow(run, schema)


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """J_P of two aligned weight vectors (0: absent)."""
    both = np.flatnonzero((x > 0) & (y > 0))
    if not len(both):
        return 0.0
    if x.max() == 1 and y.max() == 1:
        return len(both) / len(x)
    order = np.argsort(y / np.maximum(x, 1e-300), kind="stable")
    x, y = x[order].astype(float), y[order].astype(float)
    # below an element's ratio y/x the x side is the larger one, above it the y side
    sum_x, sum_y = np.cumsum(x), y.sum() - np.cumsum(y)
    i = np.flatnonzero((x > 0) & (y > 0))
    return float((1.0 / (sum_x[i] / x[i] + sum_y[i] / y[i])).sum())


class Texts:
    """Sorted shingles and weights of some texts, for exact similarities of pairs of them."""

    def __init__(self, texts: pa.Array):
        raw, offs = V.buffer_of(texts)
        g, w, owner = weighted_shingles(raw, offs)
        order = np.lexsort((g, owner))
        at = np.searchsorted(owner, np.arange(len(texts) + 1))
        self.parts = [(g[order[a:b]], w[order[a:b]]) for a, b in zip(at[:-1], at[1:])]

    def similarity(self, i: int, other: Texts, j: int) -> float:
        (g0, w0), (g1, w1) = self.parts[i], other.parts[j]
        if not len(g0) or not len(g1):
            return 0.0
        place = np.minimum(np.searchsorted(g1, g0), len(g1) - 1)
        hit = g1[place] == g0
        if w0.max() == 1 and w1.max() == 1:
            same = np.count_nonzero(hit)
            return same / (len(g0) + len(g1) - same)
        only = np.ones(len(g1), bool)
        only[place[hit]] = False
        x = np.concatenate([w0, np.zeros(np.count_nonzero(only), w0.dtype)])
        y = np.concatenate([np.where(hit, w1[place], 0), w1[only]])
        return probability_jaccard(x, y)


def verified(pairs: DataFrame, df: DataFrame, id_col: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """The (lead, member) pairs whose texts have J_P >= threshold.

    The members of a lead are dealt to blocks of about BLOCK_BYTES and BLOCK_TEXTS, and the lead's text meets each block once,
    so a large bucket is many tasks' work and a member's text moves once for each of its leads.
    """
    pairs = cut_lineage(pairs)
    nodes = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("__n")).distinct())
    if nodes.count() <= BROADCAST_IDS:
        nodes = F.broadcast(nodes)
    texts = cut_lineage(df.select(F.col(id_col).alias("node"), F.col(text).alias("text")).join(nodes, F.col("node") == F.col("__n"))
                        .select("node", "text").distinct())  # copies of a text count once
    members = pairs.join(texts.select(F.col("node").alias("b"), F.octet_length("text").alias("bytes")), "b")
    size = members.groupBy("a").agg(F.greatest(F.ceil(F.sum("bytes") / BLOCK_BYTES), F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.lit(1)).cast("int").alias("blocks"))
    dealt = pairs.join(size, "a").select("a", "b", F.pmod(F.xxhash64("b"), "blocks").cast("int").alias("block"))
    blocks = (dealt.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").groupBy("a", "block")
              .agg(F.collect_list("b").alias("b"), F.collect_list(F.coalesce("tb", F.lit(""))).alias("tb")))
    both = blocks.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").select("a", "ta", "b", "tb")
    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                lead, members = Texts(batch.column(1).slice(row, 1)), batch.column(2)[row].values
                held = Texts(batch.column(3)[row].values)
                near = members.filter(pa.array([lead.similarity(0, held, k) >= threshold for k in range(len(members))], pa.bool_()))
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[row].as_py()] * len(near), batch.schema.field(0).type), near], names=schema.names)

    return both.mapInArrow(run, schema).distinct()


def _block_pairs(rows: DataFrame, payload: list[str], size: str) -> DataFrame:
    """Pairs of blocks of each bucket of (key, rep, comp, ...) rows that has several components.

    A block holds about BLOCK members and BLOCK_BYTES of ``size``; pairs are joined by (bucket, block, block), so a large
    bucket spreads over tasks. Columns: key, then arrays rep, comp and ``payload`` of both sides (_i, _j), and one (a block with itself).
    """
    many = (rows.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                                    F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(size) / BLOCK_BYTES)).cast("int").alias("blocks"))
            .where("c0 <> c1").select("key", "blocks"))
    held = ["rep", "comp", *payload]
    blocks = cut_lineage(rows.join(many, "key").groupBy("key", "blocks", F.pmod(F.xxhash64("rep"), "blocks").cast("int").alias("block"))
                         .agg(F.collect_list(F.struct(*held)).alias("m")))
    side = lambda s: [F.col(f"m.{c}").alias(f"{c}_{s}") for c in held]
    i = blocks.select("key", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), *side("i"))
    j = blocks.select("key", F.col("block").alias("j"), F.explode(F.sequence(F.lit(0), "block")).alias("i"), *side("j"))
    return i.join(j, ["key", "i", "j"]).select("key", *[f"{c}_{s}" for s in "ij" for c in held], (F.col("i") == F.col("j")).alias("one"))


def _agreeing(batch: pa.RecordBatch, row: int, width: int) -> tuple:
    """(columns of both sides, mask of pairs in different components whose sketches agree in AGREE registers or more)."""
    cols = [batch.column(1 + k)[row].values for k in range(2 * width)]
    c0, c1 = (cols[k].to_numpy(zero_copy_only=False) for k in (1, width + 1))
    m0, m1 = (np.frombuffer(b"".join(cols[k].to_pylist()), np.uint8).reshape(-1, REGISTERS) for k in (2, width + 2))
    return cols, (np.stack([(m1 == m).sum(axis=1) for m in m0]) >= AGREE) & (c0[:, None] != c1[None])


def apart_links(placed: DataFrame, marks: DataFrame, df: DataFrame, id_col: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """Links (a, b) that join all components with a verified pair in a common bucket.

    ``placed``: (key, rep, comp); ``marks``: (id, bands, sketch). Sketches first name the members with a pair to check
    (rows, not pairs, leave the tasks); then only their texts join the blocks. Inside two blocks a pair is checked in its
    first common band, and not if links found there have already joined it.
    """
    kind = placed.schema["rep"].dataType
    rows = placed.join(marks, F.col("rep") == F.col("id")).withColumn("size", F.lit(REGISTERS))

    def members(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                cols, mask = _agreeing(batch, row, 3)
                reps = pa.concat_arrays([cols[0].filter(pa.array(mask.any(axis=1))), cols[3].filter(pa.array(mask.any(axis=0)))]).unique()
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[row].as_py()] * len(reps), pa.int64()), reps], names=["key", "rep"])

    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("rep", kind)])
    wanted = cut_lineage(_block_pairs(rows, ["sketch"], "size").mapInArrow(members, schema).distinct())
    nodes = cut_lineage(wanted.select(F.col("rep").alias("__n")).distinct())
    if nodes.count() <= BROADCAST_IDS:
        nodes = F.broadcast(nodes)
    texts = df.select(F.col(id_col).alias("__i"), F.col(text).alias("text")).join(nodes, F.col("__i") == F.col("__n")).select("__i", "text").distinct()
    full = (placed.join(wanted, ["key", "rep"]).join(marks, F.col("rep") == F.col("id")).join(texts, F.col("rep") == F.col("__i"))
            .select("key", "rep", "comp", "sketch", "bands", "text", F.octet_length("text").alias("size")))

    def links(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                cols, mask = _agreeing(batch, row, 5)
                key, one = batch.column(0)[row].as_py(), batch.column(11)[row].as_py()
                b0, b1 = (c.flatten().to_numpy().reshape(-1, BANDS) for c in (cols[3], cols[8]))
                x, y = np.nonzero(np.triu(mask) if one else mask)
                at_key = (b0 == key).argmax(axis=1)
                here = np.empty(len(x), bool)
                for lo in range(0, len(x), 1 << 14):  # rows of all bands of many pairs are large
                    i, j = x[lo: lo + (1 << 14)], y[lo: lo + (1 << 14)]
                    here[lo: lo + (1 << 14)] = (b0[i] == b1[j]).argmax(axis=1) == at_key[i]
                x, y = x[here], y[here]
                t0 = Texts(cols[4])
                t1 = t0 if one else Texts(cols[9])
                c0, c1 = cols[1].to_pylist(), cols[6].to_pylist()
                up: dict = {}

                def top(c):
                    while c in up:
                        c = up[c]
                    return c

                found = []
                for p, q in zip(x.tolist(), y.tolist()):
                    u, v = top(c0[p]), top(c1[q])
                    if u != v and t0.similarity(p, t1, q) >= threshold:
                        up[max(u, v)] = min(u, v)
                        found.append((p, q))
                at = np.array(found, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([cols[0].take(pa.array(at[:, 0])), cols[5].take(pa.array(at[:, 1]))], names=["a", "b"])

    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return _block_pairs(full, ["sketch", "bands", "text"], "size").mapInArrow(links, schema).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, class_id (smallest id of equal texts), group_id (smallest id of the group) and
    kept (it is the group's smallest id) for every row."""
    signed = cut_lineage(with_bands(df, id_col, text).withColumnRenamed(id_col, "id"))
    classes = cut_lineage(signed.where(F.col("id").isNotNull()).groupBy("d1", "d2").agg(F.min(F.struct("id", "bands", "sketch")).alias("m"))
                          .select("d1", "d2", F.col("m.id").alias("rep"), F.col("m.bands").alias("bands"), F.col("m.sketch").alias("sketch")))
    rows = classes.select("rep", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead <> last")
    bucketed = cut_lineage(rows.join(shared.select("key", "lead"), "key"))
    tried = bucketed.where("rep <> lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    edges = cut_lineage(verified(tried, df, id_col, text, threshold))
    comps = cut_lineage(components(edges))
    release(df)
    # members of a bucket that are still apart
    placed = bucketed.join(comps, F.col("rep") == F.col("node"), "left").select("key", "rep", F.coalesce("component", "rep").alias("comp"))
    marks = classes.select(F.col("rep").alias("id"), "bands", "sketch")
    more = cut_lineage(apart_links(placed, marks, df, id_col, text, threshold))
    grouped = classes.select("d1", "d2", "rep").join(comps, F.col("rep") == F.col("node"), "left").select("d1", "d2", "rep", F.coalesce("component", "rep").alias("group"))
    if not more.isEmpty():
        # links between components: components of components
        top = comps.select(F.col("node"), F.col("component").alias("top"))
        between = more.join(top.withColumnRenamed("node", "a"), "a", "left").select(F.coalesce("top", "a").alias("a"), "b")
        between = between.join(top.withColumnRenamed("node", "b"), "b", "left").select("a", F.coalesce("top", "b").alias("b"))
        joined = components(between)
        grouped = grouped.join(joined, F.col("group") == F.col("node"), "left").select("d1", "d2", "rep", F.coalesce("component", "group").alias("group"))
    release(df)
    one = signed.select("id", "d1", "d2").join(grouped, ["d1", "d2"], "left")
    there = F.col("id").isNotNull()
    return one.select(F.col("id").alias(id_col), F.when(there, F.col("rep")).alias("class_id"), F.when(there, F.col("group")).alias("group_id"),
                      F.coalesce(F.col("id") == F.col("group"), F.lit(True)).alias("kept"))
