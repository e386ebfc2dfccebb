"""Operator 6: language identification with a byte convolutional network.

Bytes are embedded, filters of several widths run over windows of fixed length,
each filter keeps its maximum over the window, and a softmax gives languages.
Trained in numpy (Adam, gradients through the pooled positions) on windows of
labelled texts; applied to all windows of every text in Arrow batches. A text's
languages are the softmax of its windows' mean logits, weighted by their bytes.

Training reads at most ``PER_LANGUAGE`` texts of each language (the first by key
of the id, one window of ``WINDOW`` bytes each), which bounds what the driver
fetches; key buckets counted first say which rows those are, so no language's
windows meet in one task. Scoring needs
no shuffle; memory follows slices of about a megabyte, and a longer text is
taken in blocks of windows.

Cases: null text, or text without a letter, gives ``und`` with score 0; equal
texts get equal rows; repeated rows are kept; null languages and empty texts do
not train; without any training row every text is ``und``; empty tables give no
rows; other columns are ignored, but those named in ``keep`` pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import textvec as V
from quillspark.operators.ranking import first_by_key

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
PER_LANGUAGE = 1_500
EPOCHS = 6
BATCH = 32
RATE = 4e-3
SEED = 11
UNKNOWN = "und"
BLOCK = 256

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


class ByteNet:
    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages = languages
        wide, n = max(WIDTHS), FILTERS * len(WIDTHS)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, EMBED)), "conv": rng.normal(0, 0.2, (wide * EMBED, n)), "bias": np.zeros(n),
            "out": rng.normal(0, 0.2, (n, len(languages))), "prior": np.zeros(len(languages))}
        # a filter of width w sees the first w bytes of a place only
        self.mask = np.concatenate([np.repeat(np.arange(wide) < w, EMBED)[:, None].repeat(FILTERS, 1) for w in WIDTHS], axis=1)
        self.p["conv"] *= self.mask
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def places(self, windows: np.ndarray) -> np.ndarray:
        """(windows, places, wide * EMBED) embedded bytes of every place."""
        x = self.p["embed"][windows]
        wide = max(WIDTHS)
        n, length, e = x.shape
        s = x.strides
        return np.lib.stride_tricks.as_strided(x, (n, length - wide + 1, wide * e), s, writeable=False)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        x = self.places(windows)
        return (x.reshape(-1, x.shape[2]) @ self.p["conv"]).reshape(*x.shape[:2], -1).max(axis=1) + self.p["bias"]

    def logits(self, windows: np.ndarray) -> np.ndarray:
        return np.maximum(self.pooled(windows), 0) @ self.p["out"] + self.p["prior"]

    def gradients(self, windows: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted cross-entropy and its gradient."""
        p = self.p
        x = self.places(windows)
        a = (x.reshape(-1, x.shape[2]) @ p["conv"]).reshape(*x.shape[:2], -1)
        best = a.argmax(axis=1)
        h = np.take_along_axis(a, best[:, None], 1)[:, 0] + p["bias"]
        r = np.maximum(h, 0)
        z = r @ p["out"] + p["prior"]
        z -= z.max(axis=1, keepdims=True)
        q = np.exp(z)
        q /= q.sum(axis=1, keepdims=True)
        rows = np.arange(len(label))
        loss = float(-(weight * np.log(q[rows, label] + 1e-12)).sum())
        dz = q * weight[:, None]
        dz[rows, label] -= weight
        dh = (dz @ p["out"].T) * (h > 0)
        seen = x[rows[:, None], best]  # (window, filter, place vector)
        g = {"out": r.T @ dz, "prior": dz.sum(0), "bias": dh.sum(0),
             "conv": np.einsum("nfk,nf->kf", seen, dh) * self.mask}
        back = (dh[:, :, None] * p["conv"].T[None]).reshape(len(label), -1, max(WIDTHS), EMBED)
        at = windows[rows[:, None, None], best[:, :, None] + np.arange(max(WIDTHS))]
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], at.ravel(), back.reshape(-1, EMBED))
        return loss, g

    def fit(self, windows: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        size = np.bincount(label, minlength=len(self.languages))
        weight = (1.0 / np.sqrt(np.maximum(size, 1)))[label]
        weight = (weight / weight.mean()).astype(np.float32)
        m, v, t = ({k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}, 0)
        steps = epochs * -(-len(label) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(label))
            for lo in range(0, len(order), BATCH):
                at = order[lo: lo + BATCH]
                # some windows are cut short, as short texts and last windows are
                w = windows[at].copy()
                short = np.where(rng.random(len(at)) < 0.3, rng.integers(16, WINDOW, len(at)), WINDOW)
                w[np.arange(WINDOW) >= short[:, None]] = 0
                g = self.gradients(w, label[at], weight[at] / len(at))[1]
                t += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    rate = RATE * (1 - t / (steps + 1))
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)


def text_windows(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, length, text index) of the windows of each text of a slice."""
    size = np.diff(offs)
    count = -(-size // WINDOW)
    of = np.repeat(np.arange(len(size)), count)
    k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    start = offs[of] + k * WINDOW
    return start, np.minimum(offs[of + 1] - start, WINDOW), of


def windows_of(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    at = start[:, None] + np.arange(WINDOW)
    return np.where(np.arange(WINDOW) < size[:, None], raw[np.minimum(at, len(raw) - 1)], 0).astype(np.uint8)


def _has_letter(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    out = V.per_text(LETTER[raw], offs) > 0
    for t in np.flatnonzero(~out):
        out[t] = any(map(str.isalpha, raw[offs[t]: offs[t + 1]].tobytes().decode("utf-8", "replace")))
    return out


def train(df: DataFrame, trains: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = PER_LANGUAGE) -> ByteNet | None:
    """Fits on at most ``per_language`` rows a language; None if there is nothing to learn from."""
    key = F.xxhash64(id_col)
    begin = F.pmod(F.xxhash64(id_col, F.lit("at")), F.greatest(F.length(text) - WINDOW, F.lit(0)) + 1).cast("int") + 1
    rows = (df.where(trains & F.col(lang).isNotNull() & (F.length(text) > 0))
            .select(F.col(lang).alias("lang"), key.alias("k"), F.col(id_col).alias("id"), F.substring(F.col(text), begin, F.lit(WINDOW)).alias("w")))
    # counts of key buckets say which rows can be among the first of a language; only those are moved and ranked
    got = (first_by_key(rows, ["lang"], F.shiftrightunsigned("k", 4), ["k", "id", "w"], per_language)
           .orderBy("lang", "k", "id", "w").select("lang", "w").toPandas())
    if got.empty:
        return None
    net = ByteNet(sorted(set(got["lang"])))
    data = np.zeros((len(got), WINDOW), np.uint8)
    for k, w in enumerate(got["w"]):
        b = np.frombuffer(w.encode()[:WINDOW], np.uint8)
        data[k, : len(b)] = b
    net.fit(data, np.searchsorted(np.array(net.languages), got["lang"].to_numpy(str)))
    return net


def predict(df: DataFrame, net: ByteNet | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """``keep`` columns, lang_pred and score for every row. ``with_text``: ``keep`` names the text too (it is sent once)."""
    if net is None:
        return df.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = df.sparkSession.sparkContext.broadcast(net)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        net = shared.value
        names = np.array([*net.languages, UNKNOWN], object)
        for batch in batches:
            for lo, hi, raw, offs in V.slices(batch.column(place)):
                n = hi - lo
                start, size, of = text_windows(raw, offs)
                total = np.zeros((n, len(net.languages)))
                for a in range(0, len(start), BLOCK):
                    z = net.logits(windows_of(raw, start[a: a + BLOCK], size[a: a + BLOCK]))
                    np.add.at(total, of[a: a + BLOCK], z * size[a: a + BLOCK, None])
                total /= np.maximum(np.diff(offs), 1)[:, None]
                q = np.exp(total - total.max(axis=1, keepdims=True))
                q /= q.sum(axis=1, keepdims=True)
                known = _has_letter(raw, offs)
                best = np.where(known, q.argmax(axis=1), len(net.languages))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(lo, n) for k in range(len(keep))), pa.array(names[best], pa.string()),
                     pa.array(np.where(known, q.max(axis=1), 0.0))], names=schema.names)
        V.give_back()

    place = list(keep).index(text) if with_text else len(keep)
    return df.select(*keep, *([] if with_text else [text])).mapInArrow(run, schema)
