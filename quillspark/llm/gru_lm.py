"""Operator 2: gated recurrent language model scores of whole texts.

Tokens are words (A-Z in lower case) and one end token a text. Training counts
of all words are made by Spark; the most frequent ``HEAD`` tokens are the
recurrent model's own vocabulary, the others one tail class. A GRU reads the
text token by token; its output softmax is factored into a class (frequency
classes of ``CLASS`` head tokens, and the tail) and the token within the class.
A tail token's share within its class follows the corpus counts, (c + 1) over
the tail's sum of (c + 1), unseen words counting as one more type, so every text
has a proper log-probability.

Training is truncated backpropagation through time in numpy: windows of
``STEPS`` tokens, the state carried across windows of a text. A start model is
fitted on at most ``SEED_TEXTS`` whole training texts of at most ``SEED_CHARS``
characters; then every partition trains on
all its training texts from there, and the weights are averaged by tokens.
Scoring carries the state over all windows of a text, whatever its length.

Counts of the ``HOT`` most frequent words are sent to the tasks; rarer words of
a text meet their counts in an equi-join, so what is sent to a task is bounded
and no frequent word becomes a shuffle key.

Cases: null and empty texts are the end token alone; repeated rows are scored
each; null ids are held out; without training rows all counts are 0 and the
start weights score; empty tables give no rows; other columns are ignored.
Weights depend on how the input is cut into partitions, counts do not.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import textvec as V
from quillspark.session import cut_lineage

HIDDEN = 16
CLASS, CLASSES = 64, 31
HEAD = CLASS * CLASSES
HOT = 1 << 16
STEPS = 32
TRAIN_LANES, SCORE_LANES = 384, 1024
SEED_TEXTS, SEED_CHARS, SEED_EPOCHS = 400, 20_000, 3
SEED_RATE, RATE = 8e-3, 2e-3
SCORE_BYTES = 8 << 20
TAIL, START = HEAD, HEAD + 1
END = np.uint64(0xE0D)
LOWERED = V.BYTE_VALUE[V.LOWER]
LN10 = np.log(10.0)
TOP = 60.0  # logits stay far below it; keeps exp finite


def tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, offsets by text); the last token of a text is END."""
    n = len(offs) - 1
    starts, ends, of = V.runs(~V.SPACE[raw], offs)
    at = np.concatenate([[0], np.cumsum(V.word_counts(of, n) + 1)])
    out = np.full(at[-1], END, np.uint64)
    out[np.arange(len(of)) + of] = V.Hasher(raw, LOWERED).of(starts, ends)
    return out, at


def train_counts(df: DataFrame, text: str) -> DataFrame:
    """(h, c): tokens of all rows and their counts."""

    def run(batches):
        for batch in batches:
            for _, _, raw, offs in V.slices(batch.column(0), SCORE_BYTES):
                h, c = np.unique(tokens(raw, offs)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=["h", "c"])

    return df.select(text).mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


class Lexicon:
    """The HOT most frequent tokens: hash -> count and head id (by rank; TAIL beyond the head), and the totals of all tokens."""

    def __init__(self, h: np.ndarray, c: np.ndarray, total: int, distinct: int):
        order = np.argsort(h)
        self.h, self.c = h[order], c[order]
        self.id = np.minimum(np.arange(len(h)), TAIL)[order].astype(np.int64)
        self.total, self.distinct = total, distinct
        self.complete = distinct <= len(h)
        head = int(c[:HEAD].sum())
        self.tail_log = float(np.log10(total - head + distinct - min(HEAD, len(h)) + 1))

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(head id, count or -1 where the word is not among the hot ones)."""
        if not len(self.h):
            return np.full(len(h), TAIL), np.full(len(h), -1)
        k = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        hit = self.h[k] == h
        return np.where(hit, self.id[k], TAIL), np.where(hit, self.c[k], -1)


def hot_words(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, count) of the most frequent words, by falling count: all above the least count that at most ``limit`` reach.

    A histogram of counts finds that count first, so that few more rows than wanted are fetched from all partitions together."""
    band = F.floor(F.log2("c") * 8).cast("int")
    sizes = sorted(((r.b, r.n) for r in counts.groupBy(band.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, held = None, 0
    for b, n in sizes:
        if held + n > limit:
            break
        least, held = b, held + n
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = counts.where(band >= least).toPandas().sort_values(["c", "h"], ascending=[False, True])
    return rows["h"].to_numpy(np.int64).view(np.uint64), rows["c"].to_numpy(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Gru:
    """Weights: x (input token -> gates), u (state -> gates), cw/cb (state -> class), ow/ob (state -> token of a class)."""

    def __init__(self, seed: int = 5, dtype=np.float32):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {"x": rng.normal(0, 0.3, (HEAD + 2, 3 * h)), "u": rng.normal(0, 0.25, (h, 3 * h)), "cw": rng.normal(0, 0.1, (h, CLASSES + 1)),
                  "cb": np.zeros(CLASSES + 1), "ow": rng.normal(0, 0.1, (CLASSES, h, CLASS)), "ob": np.zeros((CLASSES, CLASS))}
        self.p = {k: v.astype(dtype) for k, v in self.p.items()}

    def set_counts(self, lex: Lexicon) -> None:
        """Output biases at the counts' log shares."""
        c = np.zeros(HEAD)
        c[lex.id[lex.id < TAIL]] = lex.c[lex.id < TAIL]
        c = c.reshape(CLASSES, CLASS) + 0.5
        dtype = self.p["cb"].dtype
        self.p["ob"] = np.log(c / c.sum(axis=1, keepdims=True)).astype(dtype)
        mass = np.concatenate([c.sum(axis=1), [max(lex.total - c.sum(), 1.0)]])
        self.p["cb"] = np.log(mass / mass.sum()).astype(dtype)

    def run(self, ids: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: bool = False):
        """States after each of the (steps, lanes) input ids; ``fresh`` marks inputs that start a text (state 0 before)."""
        h, u = HIDDEN, self.p["u"]
        gates = self.p["x"][ids]
        out = np.empty((*ids.shape, h), state.dtype)
        saved = []
        for t in range(len(ids)):
            before = state
            if fresh[t].any():
                before = state.copy()
                before[fresh[t]] = 0
            a = before @ u
            zr = _sigmoid(gates[t, :, : 2 * h] + a[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            n = np.tanh(gates[t, :, 2 * h:] + r * a[:, 2 * h:])
            state = n + z * (before - n)
            out[t] = state
            if keep:
                saved.append((before, z, r, n, a[:, 2 * h:]))
        return out, state, saved

    def outputs(self, states: np.ndarray, want: np.ndarray, grads: dict | None = None):
        """ln probability of class (and token, for head tokens) of ``want`` after ``states`` (rows); adds gradients of the
        mean negative log-likelihood if ``grads`` is given and returns them with respect to the states."""
        p, n = self.p, len(want)
        cls = want // CLASS  # TAIL falls into the last class
        z = np.minimum(states @ p["cw"] + p["cb"], TOP)
        e = np.exp(z)
        s = e.sum(axis=1)
        rows = np.arange(n)
        logp = z[rows, cls] - np.log(s)
        back = None
        if grads is not None:
            d = e / s[:, None]
            d[rows, cls] -= 1
            d /= n
            grads["cw"] += states.T @ d
            grads["cb"] += d.sum(0)
            back = d @ p["cw"].T
        order = np.argsort(cls, kind="stable")
        edge = np.searchsorted(cls[order], np.arange(CLASSES + 1))
        for c in range(CLASSES):
            at = order[edge[c]: edge[c + 1]]
            if not len(at):
                continue
            w = want[at] - c * CLASS
            g = states[at]
            z = np.minimum(g @ p["ow"][c] + p["ob"][c], TOP)
            e = np.exp(z)
            s = e.sum(axis=1)
            k = np.arange(len(at))
            logp[at] += z[k, w] - np.log(s)
            if grads is not None:
                d = e / s[:, None]
                d[k, w] -= 1
                d /= n
                grads["ow"][c] += g.T @ d
                grads["ob"][c] += d.sum(0)
                back[at] += d @ p["ow"][c].T
        return logp, back

    def gradients(self, ids, fresh, want, state):
        """(mean loss, gradients, last state) of one window of (steps, lanes)."""
        h, u = HIDDEN, self.p["u"]
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        out, last, saved = self.run(ids, fresh, state, keep=True)
        logp, back = self.outputs(out.reshape(-1, h), want.ravel(), grads)
        back = back.reshape(out.shape)
        dg = np.empty((*ids.shape, 3 * h), out.dtype)
        dh = np.zeros_like(state)
        for t in range(len(ids) - 1, -1, -1):
            before, z, r, n, an = saved[t]
            dh = dh + back[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (before - n) * z * (1 - z)
            dr = dn * an * r * (1 - r)
            da = np.concatenate([dz, dr, dn * r], axis=1)
            dg[t] = np.concatenate([dz, dr, dn], axis=1)
            grads["u"] += before.T @ da
            dh = np.where(fresh[t][:, None], 0, dh * z + da @ u.T)
        flat, rows = ids.ravel(), dg.reshape(-1, 3 * h)
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) > 0]))
        grads["x"][flat[order][first]] = np.add.reduceat(rows[order], first, axis=0)
        return -float(logp.mean()), grads, last

    def fit(self, ids: np.ndarray, at: np.ndarray, rate: float, lanes: int = TRAIN_LANES, memory: dict | None = None) -> None:
        """One pass over texts (ids by offsets) laid end to end in lanes; ``memory`` keeps the optimiser between calls."""
        if not len(ids):
            return
        memory = {} if memory is None else memory
        if not memory:
            memory.update(t=0, m={k: np.zeros_like(v) for k, v in self.p.items()}, v={k: np.zeros_like(v) for k, v in self.p.items()})
        into, first = _inputs(ids, at)
        lanes = max(1, min(lanes, len(ids) // (2 * STEPS)))
        length = -(-len(ids) // lanes)
        fill = lanes * length - len(ids)  # the last lane ends with a repeat of the first tokens

        def laid(x):
            return np.concatenate([x, np.resize(x, fill)]).reshape(lanes, length).T

        into, first, want = laid(into), laid(first), laid(ids)
        first[0] = True
        state = np.zeros((lanes, HIDDEN), self.p["u"].dtype)
        for lo in range(0, length, STEPS):
            _, g, state = self.gradients(into[lo: lo + STEPS], first[lo: lo + STEPS], want[lo: lo + STEPS], state)
            memory["t"] += 1
            for k, m, v in ((k, memory["m"][k], memory["v"][k]) for k in self.p):
                m += 0.1 * (g[k] - m)
                v += 0.01 * (g[k] * g[k] - v)
                self.p[k] -= rate * (m / (1 - 0.9 ** memory["t"])) / (np.sqrt(v / (1 - 0.99 ** memory["t"])) + 1e-8)

    def score(self, ids: np.ndarray, at: np.ndarray, lanes: int = SCORE_LANES) -> np.ndarray:
        """ln probability of every text: the state runs over the whole text. Texts are dealt to lanes, longest first."""
        size = np.diff(at)
        total = np.zeros(len(size))
        if not len(size):
            return total
        lanes = max(1, min(lanes, len(size)))
        queue = [(0, k) for k in range(lanes)]
        dealt: list[list[int]] = [[] for _ in range(lanes)]
        for t in np.argsort(-size, kind="stable").tolist():
            load, k = heapq.heappop(queue)
            dealt[k].append(t)
            heapq.heappush(queue, (load + int(size[t]), k))
        dealt.sort(key=lambda x: -int(size[x].sum()))
        loads = np.array([int(size[x].sum()) for x in dealt])
        into, first = _inputs(ids, at)
        # lanes end to end: a long text makes a long lane, not a wide table
        begin = np.cumsum(loads) - loads
        seq = np.concatenate([np.arange(at[t], at[t + 1], dtype=np.int32) for texts in dealt for t in texts])
        owner = np.concatenate([np.repeat(np.array(texts, np.int32), size[texts]) for texts in dealt])
        state = np.zeros((lanes, HIDDEN), self.p["u"].dtype)
        for lo in range(0, int(loads[0]), STEPS):
            live = int(np.searchsorted(-loads, -lo, "left"))  # lanes with tokens left, the longest are first
            step = np.arange(lo, min(lo + STEPS, int(loads[0])))[:, None]
            used = step < loads[None, :live]
            spot = np.minimum(begin[None, :live] + step, len(seq) - 1)
            p = seq[spot]
            out, last, _ = self.run(into[p], first[p], state[:live])
            state[:live] = last
            logp, _ = self.outputs(out[used], ids[p[used]])
            total += np.bincount(owner[spot[used]], weights=logp, minlength=len(total))
        return total


def _inputs(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token before each token, START at a text's first; marks of the first tokens)."""
    into = np.concatenate([[START], ids[:-1]])
    first = np.zeros(len(ids), bool)
    first[at[:-1]] = True
    into[first] = START
    return into, first


def _batch_ids(batch_column: pa.Array, lex: Lexicon):
    for lo, hi, raw, offs in V.slices(batch_column, SCORE_BYTES):
        h, at = tokens(raw, offs)
        yield lo, hi, h, at, *lex.find(h)


def fit_model(rows: DataFrame, text: str, lex: Lexicon) -> Gru:
    """Start model from SEED_TEXTS rows, then one pass over all rows in partitions, weights averaged by tokens."""
    model = Gru()
    model.set_counts(lex)
    short = rows.where(F.length(text) <= SEED_CHARS).select(F.col(text).alias("w"), F.xxhash64(text).alias("k"))
    # keys first, so that no task sends texts that are not used
    keys = [r.k for r in short.select("k").distinct().orderBy("k").limit(SEED_TEXTS).collect()]
    seed = short.where(F.col("k").isin(keys)).dropDuplicates(["k"]).orderBy("k").toPandas()["w"]
    if not len(seed):
        return model
    ids, sizes = [], []
    for _, _, _, at, found, _ in _batch_ids(pa.array(seed, pa.string()), lex):
        ids.append(found)
        sizes.append(np.diff(at))
    memory: dict = {}
    ids, at = np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    for _ in range(SEED_EPOCHS):
        model.fit(ids, at, SEED_RATE, lanes=32, memory=memory)
    shared = rows.sparkSession.sparkContext.broadcast((model, lex))
    names = list(model.p)

    def run(batches):
        model, lex = shared.value
        own = Gru()
        own.p = {k: v.copy() for k, v in model.p.items()}
        seen, memory = 0, {}
        for batch in batches:
            for _, _, _, at, found, _ in _batch_ids(batch.column(0), lex):
                own.fit(found, at, RATE, memory=memory)
                seen += len(found)
        if seen:
            flat = np.concatenate([own.p[k].ravel() for k in names]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(flat))), pa.array(np.concatenate([[1.0], flat]) * seen)], names=["i", "v"])

    sums = rows.select(text).mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    if len(sums):
        flat = np.zeros(len(sums))
        flat[sums["i"].to_numpy() + 1] = sums["v"]
        flat = flat[1:] / flat[0]
        lo = 0
        for k in names:
            n = model.p[k].size
            model.p[k] = flat[lo: lo + n].reshape(model.p[k].shape).astype(np.float32)
            lo += n
    return model


def score_texts(df: DataFrame, trains: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) for every row. ``trains``: rows to learn from."""
    rows = df.where(trains)
    counts = cut_lineage(train_counts(rows, text))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    lex = Lexicon(*hot_words(counts, HOT), int(total), int(distinct))
    model = fit_model(rows, text, lex)
    shared = df.sparkSession.sparkContext.broadcast((model, lex))
    rare = T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("n", T.LongType())]))
    schema = T.StructType([df.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()),
                           T.StructField("logs", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("rare", rare)])

    def run(batches):
        model, lex = shared.value
        for batch in batches:
            for lo, hi, h, at, ids, c in _batch_ids(batch.column(1), lex):
                n = hi - lo
                of = np.repeat(np.arange(n), np.diff(at))
                logs = np.where(c > 0, np.log10(np.maximum(c, 0) + 1.0), 0.0)
                tail = ids == TAIL
                own = model.score(ids, at) / LN10 + np.bincount(of[tail], weights=logs[tail] - lex.tail_log, minlength=n)
                far = (c < 0) & (not lex.complete)
                key = V.in_text(h[far], of[far])
                _, first, times = np.unique(key, return_index=True, return_counts=True)
                keep = np.flatnonzero(far)[first]
                order = np.argsort(of[keep], kind="stable")
                keep, times = keep[order], times[order]
                edge = np.searchsorted(of[keep], np.arange(n + 1)).astype(np.int32)
                items = pa.StructArray.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(times.astype(np.int64))], names=["h", "n"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), pa.array(np.diff(at)), pa.array(np.bincount(of[c > 0], minlength=n).astype(np.int64)),
                     pa.array(np.bincount(of, weights=logs, minlength=n)), pa.array(own), pa.ListArray.from_arrays(pa.array(edge), items)], names=schema.names)

    part = cut_lineage(df.select(id_col, text).mapInArrow(run, schema)).withColumn("__row", F.monotonically_increasing_id())
    joined = (part.select("__row", F.inline("rare")).join(counts, "h").groupBy("__row")
              .agg(F.sum("n").alias("__n"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("__logs")))
    more = F.coalesce("__logs", F.lit(0.0))
    return part.drop("rare").join(joined, "__row", "left").select(
        id_col, (~F.coalesce(trains, F.lit(False))).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("__n", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * float(np.log10(total + distinct + 1.0))).alias("base_score"), (F.col("score") + more).alias("score"))
