"""Operator 13: alignment of the tokens of two tokenizers by merge-path partitioning.

Tokenizer A (byte-level BPE) encodes a space and the text, B (sentencepiece)
the text, which it puts a space before. Both cut the same bytes, so a text is
two increasing lists of token ends. The texts of a slice lie end to end, and
binary searches along equidistant diagonals of the (A ends x B ends) grid cut
the merge of the two lists into pieces of ``PIECE`` ends that need nothing from
each other, however long a single text is. A piece emits its overlaps: one
(A token, B token) pair for each distinct end. Where a piece ends between two
equal ends, both sides emit the same overlap; stitching keeps one. An overlap
at whose end both tokens end is a link, and closes a group.

Corpus counts of linked (A id, B id) pairs are summed per task, then by pair.
Pairs that hold more than 1 / 2^20 of all links (fewer than 2^20 pairs by
arithmetic, whatever the corpus) are sent to the tasks as packed arrays; the
rows of all other pairs, none of which can be frequent, are joined by shuffle.
The two parts always run side by side, no size decides between them.

A's ids come from the byte ranks of its JSON vocabulary through tiktoken; in
each slice one whole text is checked against the JSON tokenizer itself, and a
difference raises. A text that tiktoken cannot cut goes through the JSON tokenizer.

Null and empty texts, and texts whose joined A or B bytes differ from space and
text, have no tokens: zeros and an empty digest. Rows are kept one to one,
repeated rows and ids count each; other columns pass through only if named in
``keep`` (an input column named like an output column is replaced). An empty
table gives no rows. Texts of any length are used whole; memory follows the
longest text.
"""

from __future__ import annotations

import hashlib
import itertools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.session import cut_lineage

PIECE = 4096
SLICE_CHARS = 1 << 19
HEAVY = 1 << 20
BUFFER = 1 << 21
# Fixed value: how byte-level BPE cuts a text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others as code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(odd)}


class Tokenizers:
    """Both tokenizers and the bytes of each of their ids."""

    def __init__(self, json_a: str, model_b: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_str(json_a)
        self.exact.encode_special_tokens = True
        spec = json.loads(json_a)
        symbol = byte_symbols()
        self.a_bytes = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        special = {t["content"] for t in spec["added_tokens"]}
        for piece, i in spec["model"]["vocab"].items():
            self.a_bytes[i] = piece.encode() if piece in special else bytes(map(symbol.__getitem__, piece))
        ranks = {b: i for i, b in enumerate(self.a_bytes) if b and self.a_bytes[i].decode("utf-8", "replace") not in special}
        self.quick = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.lib = lib = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if lib.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, lib.id_to_piece(i)) for i in range(lib.get_piece_size()))]
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        # one table of decimals with their separators: A inside a group, A before B, B inside a group, B at its end
        na, nb = len(self.a_bytes), len(self.b_bytes)
        self.shown = [f"{i}{s}" for n, s in ((na, ","), (na, "|"), (nb, ","), (nb, ";")) for i in range(n)]

    def encode_exact(self, text: str) -> list[int]:
        return self.exact.encode(" " + text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides of each text; empty where a text has no tokens by the rule above."""
        a, checked = [], False
        b = self.lib.encode(texts, num_threads=1)
        for k, t in enumerate(texts):
            if not t:
                a.append([])
                b[k] = []
                continue
            try:
                ids = self.quick.encode_ordinary(" " + t)
            except BaseException as e:  # the word pattern gives up on some very long runs
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
                ids = self.encode_exact(t)
            if not checked:
                if ids != self.encode_exact(t):
                    raise ValueError(f"byte ranks and the tokenizer differ on the text {t[:80]!r}")
                checked = True
            whole = (" " + t).encode()
            if b"".join(map(self.a_bytes.__getitem__, ids)) != whole or b"".join(map(self.b_bytes.__getitem__, b[k])) != whole:
                ids, b[k] = [], []
            a.append(ids)
        return a, b


def diagonals(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two increasing lists (a before b when equal) crosses every ``piece``-th diagonal: counts taken of each."""
    d = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    lo, hi = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while True:
        todo = np.flatnonzero(lo < hi)
        if not len(todo):
            return lo, d - lo
        mid = (lo[todo] + hi[todo]) >> 1
        less = a[mid] <= b[d[todo] - 1 - mid]
        lo[todo[less]] = mid[less] + 1
        hi[todo[~less]] = mid[~less]


def piece_overlaps(a: np.ndarray, b: np.ndarray, a0: int, a1: int, b0: int, b1: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps of one piece: (A token, B token, end) for each distinct end in a[a0:a1] and b[b0:b1]."""
    ends = np.sort(np.concatenate([a[a0:a1], b[b0:b1]]), kind="stable")
    ends = ends[np.append(True, ends[1:] != ends[:-1])]
    return a0 + np.searchsorted(a[a0:a1], ends), b0 + np.searchsorted(b[b0:b1], ends), ends


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, both end there) of all overlaps in order; a and b increase and have the same last end."""
    if not len(a):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, bool)
    i, j = diagonals(a, b, piece)
    parts = [piece_overlaps(a, b, *cut) for cut in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist())]
    x, y, end = (np.concatenate(p) for p in zip(*parts))
    # A piece that starts between two equal ends sees only B's end there, with the A token after it; the piece before has the pair right.
    new = np.append(True, end[1:] != end[:-1])
    x, y, end = x[new], y[new], end[new]
    return x, y, (a[x] == end) & (b[y] == end)


def aligned(tools: Tokenizers, texts: list[str]) -> dict[str, list | np.ndarray]:
    """Tokens, groups and linked pairs of each text of a slice."""
    ids_a, ids_b = tools.encode(texts)
    n = len(texts)
    na, nb = (np.fromiter(map(len, side), np.int64, n) for side in (ids_a, ids_b))
    a, b = (np.fromiter(itertools.chain.from_iterable(side), np.int64, int(size.sum())) for side, size in ((ids_a, na), (ids_b, nb)))
    x, y, both = overlaps(np.cumsum(tools.a_size[a]), np.cumsum(tools.b_size[b]))
    x, y = x[both], y[both]  # last tokens of the groups
    first_a, first_b = np.append(0, np.cumsum(na)), np.append(0, np.cumsum(nb))
    at = np.searchsorted(x, first_a)
    closes_a, closes_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    closes_a[x] = closes_b[y] = 1
    group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
    order = np.zeros(len(a) + len(b), np.int64)
    # a token of A stands behind B's tokens of all earlier groups, one of B behind A's tokens of its own group too
    order[np.arange(len(a)) + np.append(0, y + 1)[group_a]] = a + closes_a * len(tools.a_bytes)
    order[np.arange(len(b)) + (x + 1)[group_b]] = b + closes_b * len(tools.b_bytes) + 2 * len(tools.a_bytes)
    shown = [*map(tools.shown.__getitem__, order.tolist())]
    cut = (first_a + first_b).tolist()
    return {"n_a": na, "n_b": nb, "n_groups": np.diff(at), "at": at, "pairs": a[x] * len(tools.b_bytes) + b[y],
            "groups": ["".join(shown[lo:hi])[:-1] for lo, hi in zip(cut, cut[1:])]}


_tools: dict[str, Tokenizers] = {}


def _tokenizers(json_a: str, model_b: bytes) -> Tokenizers:
    key = hashlib.md5(json_a.encode() + model_b).hexdigest()
    if key not in _tools:
        _tools[key] = Tokenizers(json_a, model_b)
    return _tools[key]


def _groups(texts: list[str], limit: int):
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def tokens_aligned(df: DataFrame, json_path: str, model_path: str, text: str = "text", keep: list[str] | None = None,
                   groups: bool = True) -> DataFrame:
    """Adds n_a, n_b, n_groups, groups_sha256, pairs (array of A id * size of B's vocabulary + B id, one a link) and, on wish, groups (string).

    The vocabulary files (about 2 MB) are read on the driver and sent to the tasks.
    """
    with open(json_path, encoding="utf-8") as f, open(model_path, "rb") as g:
        files = df.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    added = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups")]
    added += [T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.ArrayType(T.IntegerType()))]
    if groups:
        added.append(T.StructField("groups", T.StringType()))
    names = {f.name for f in added}
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    source = df.select(*kept, df[text].alias("__text"))
    schema = T.StructType([source.schema[c] for c in kept] + added)

    def run(batches):
        tools = _tokenizers(*files.value)
        if len(tools.a_bytes) * len(tools.b_bytes) > 1 << 31:
            raise ValueError("the vocabularies are too large for 32-bit pairs")
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(len(kept)).to_pylist()]
            for lo, hi in _groups(texts, SLICE_CHARS):
                got = aligned(tools, texts[lo:hi])
                digest = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in got["groups"]]
                cols = [batch.column(k).slice(lo, hi - lo) for k in range(len(kept))]
                cols += [pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups")]
                cols += [pa.array(digest, pa.string()), pa.ListArray.from_arrays(pa.array(got["at"], pa.int32()), pa.array(got["pairs"], pa.int32()))]
                if groups:
                    cols.append(pa.array(got["groups"], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return source.mapInArrow(run, schema)


def pair_counts(stored: DataFrame) -> DataFrame:
    """(pair, n): links of the whole corpus that hold each pair."""
    def run(batches):
        held, size = [], 0

        def flush():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair, pa.int32()), pa.array(n, pa.int64())], names=["pair", "n"])

        for batch in batches:
            held.append(batch.column(0).flatten().to_numpy())
            size += len(held[-1])
            if size > BUFFER:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return stored.select("pairs").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def align_texts(df: DataFrame, json_path: str, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 to the kept columns."""
    kept = [c for c in (df.columns if keep is None else keep) if c not in {"n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}]
    given = df.select(*[F.col(c).alias(f"k{k}") for k, c in enumerate(kept)], F.col(text).alias("t"))
    carried = [f"k{k}" for k in range(len(kept))]
    stored = cut_lineage(tokens_aligned(given, json_path, model_path, "t", carried, groups=False).withColumn("row", F.monotonically_increasing_id()))
    counts = cut_lineage(pair_counts(stored))
    total = counts.agg(F.sum("n")).first()[0] or 0
    import sentencepiece
    size_b = sentencepiece.SentencePieceProcessor(model_file=model_path).get_piece_size()
    b_id = F.col("pair") % size_b
    top = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))  # at most B's vocabulary
    counts = cut_lineage(counts.join(F.broadcast(top), b_id == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best")))
    heavy = counts.where(F.col("n") * HEAVY > total).toArrow().combine_chunks()
    order = np.argsort(heavy["pair"].to_numpy())
    known = df.sparkSession.sparkContext.broadcast(tuple(heavy[c].to_numpy()[order] for c in ("pair", "n", "best")))
    fields = [f"k{k}" for k in range(len(kept))] + ["row", "n_a", "n_b", "n_groups", "groups_sha256"]
    source = stored.select(*fields, "pairs")
    schema = T.StructType([*(source.schema[c] for c in fields), T.StructField("best_sum", T.LongType()), T.StructField("n_sum", T.LongType()),
                           T.StructField("rare", T.ArrayType(T.IntegerType()))])

    def run(batches):
        pair, n, best = known.value
        for batch in batches:
            listed = batch.column(len(fields))
            p = listed.flatten().to_numpy()
            size = np.diff(listed.offsets.to_numpy())
            at = np.append(0, np.cumsum(size))
            k = np.minimum(np.searchsorted(pair, p), max(len(pair) - 1, 0))
            hit = pair[k] == p if len(pair) else np.zeros(len(p), bool)
            sums = []
            for values in (best, n):
                run_sum = np.append(0, np.cumsum(np.where(hit, values[k], 0) if len(pair) else np.zeros(len(p), np.int64)))
                sums.append(pa.array(run_sum[at[1:]] - run_sum[at[:-1]], pa.int64()))
            left = np.append(0, np.cumsum(~hit))[at]
            rare = pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(p[~hit], pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(len(fields))), *sums, rare], names=schema.names)

    looked = cut_lineage(source.mapInArrow(run, schema))
    rare = looked.select("row", F.explode("rare").alias("pair")).join(counts.where(F.col("n") * HEAVY <= total), "pair")
    rare = rare.groupBy("row").agg(F.sum("n").alias("n_more"), F.sum("best").alias("best_more"))
    done = looked.drop("rare").join(rare, "row", "left")
    return done.select(*[F.col(f"k{k}").alias(c) for k, c in enumerate(kept)], "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
                       (F.col("best_sum") + F.coalesce("best_more", F.lit(0))).alias("n_best"),
                       (F.col("n_sum") + F.coalesce("n_more", F.lit(0))).alias("count_sum"), "groups_sha256")
