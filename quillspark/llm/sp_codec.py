"""Operator 4: SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The encoder keeps, per unit of text, an agenda of adjacent symbol pairs ordered
by (score of the merged piece, leftmost first). It merges the best pair and puts
the two new neighbour pairs on the agenda, until no pair is in the vocabulary;
symbols outside it become byte pieces. No vocabulary piece has a word mark after
another character or holds a line feed, and some punctuation signs never follow
a letter or digit inside a piece, so merges never cross those places: a text is
cut there. The agendas of all new units of a slice of a batch are flat arrays
and advance together, one merge per unit and round; units of more than
``ROUND_CHARS`` characters use a heap each. Merged units are kept by a worker, as
packed ids, in a memo of two generations that is bounded in entries and in unit
length: units of the older one that do not come again go, frequent ones stay.

Every text's ids are checked against the sentencepiece library, a slice of an
Arrow batch (about a million characters) at a time. A difference raises.

Nulls and empty texts encode to the end id alone and decode to "". Rows are
kept one to one, repeated rows too; other columns pass through untouched, and
an input column named like an output column is replaced. An empty table gives
no rows. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quillspark.llm.textvec import give_back

MARK = "▁"
MEMO_ENTRIES = 60_000  # of a generation
MEMO_CHARS = 40
ROUND_CHARS = 64
PAIR = 1 << 22  # above any symbol id
PLACE_BITS = 32
FAR = (1 << 62) - 1
CALL_CHARS = 1 << 20


class PieceCodec:
    """Agenda encoder over the pieces of a sentencepiece model (bytes of the model file)."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.lib = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        every = range(lib.get_piece_size())
        self.shown = [f" {i}" for i in every]
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        for i in every:
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i)):
                self.ids[piece] = i
                self.rank[piece] = -lib.get_score(i)
        if not all(self.byte_ids):
            raise ValueError("the vocabulary has no byte pieces")
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.ids):
            raise ValueError("the vocabulary has pieces that span words")
        if len(self.shown) + 0x110000 > PAIR:
            raise ValueError("the vocabulary is too large")
        order = {v: k for k, v in enumerate(sorted(set(self.rank.values())))}
        known = {c: i for c, i in self.ids.items() if len(c) == 1}
        self.char_id = np.full(max(map(ord, known)) + 1, -1, np.int64)
        for c, i in known.items():
            self.char_id[ord(c)] = i
        found = sorted((self._id(p[:k]) * PAIR + self._id(p[k:]), order[self.rank[p]], i) for p, i in self.ids.items()
                       for k in range(1, len(p)) if all(len(x) == 1 or x in self.ids for x in (p[:k], p[k:])))
        found.append((1 << 62, 0, 0))
        self.pair_key, self.pair_rank, self.pair_id = (np.array(x, np.int64) for x in zip(*found))
        self.end = lib.eos_id()
        after_word = {b for p in self.ids for a, b in zip(p, p[1:]) if a.isalnum()}
        cut = "".join(re.escape(c) for c in string.punctuation if c not in after_word) or "\n"
        self.units = re.compile(f"\n|(?:{MARK}+|[^{MARK}\n])[^{MARK}\n{cut}]*(?:(?<![^\\W_])[{cut}][^{MARK}\n{cut}]*)*").findall
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def packed_units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit, packed as 32-bit integers."""
        short = [k for k, u in enumerate(units) if len(u) <= ROUND_CHARS]
        out = [b""] * len(units)
        for k, ids in zip(short, self._merge_rounds([units[k] for k in short])):
            out[k] = ids
        for k, u in enumerate(units):
            if len(u) > ROUND_CHARS:
                out[k] = self._ids([*map(self._id, self._merge_heap(u))])
        return out

    def merge_units(self, units: list[str]) -> list[str]:
        """Ids of each unit as decimals, each after one space."""
        return ["".join(map(self.shown.__getitem__, np.frombuffer(b, np.int32))) for b in self.packed_units(units)]

    def _ids(self, symbols: list[int]) -> bytes:
        """Packed symbols, those that are no piece written as byte pieces."""
        top, ids = len(self.shown), []
        for s in symbols:
            if s < top:
                ids.append(s)
            else:
                ids += [self.byte_ids[b] for b in chr(s - top).encode()]
        return np.array(ids, np.int32).tobytes()

    def _id(self, symbol: str) -> int:
        """Piece id, or the number of pieces plus the code point of a character that is none."""
        got = self.ids.get(symbol)
        return len(self.shown) + ord(symbol) if got is None else got

    def _offer(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Agenda keys (rank of the score, place) of the pairs and the merged ids; FAR where no piece."""
        key = left * PAIR + right
        k = np.searchsorted(self.pair_key, key)
        hit = self.pair_key[k] == key
        return np.where(hit, self.pair_rank[k] << PLACE_BITS | at, FAR), self.pair_id[k]

    def _merge_rounds(self, units: list[str]) -> list[bytes]:
        if not units:
            return []
        code = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        sym = self.char_id[np.minimum(code, len(self.char_id) - 1)]
        sym = np.where((sym < 0) | (code >= len(self.char_id)), len(self.shown) + code, sym)
        size = np.fromiter(map(len, units), np.int64, len(units))
        first = np.cumsum(size) - size
        n = len(sym)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[first + size - 1] = n
        prv[first] = -1
        key, into = np.full(n + 1, FAR), np.zeros(n + 1, np.int64)
        left = np.flatnonzero(nxt < n)
        key[left], into[left] = self._offer(sym[left], sym[left + 1], left)
        while True:
            best = np.minimum.reduceat(key[:n], first)
            p = best[best < FAR] & ((1 << PLACE_BITS) - 1)
            if not len(p):
                break
            q = nxt[p]
            sym[p] = into[p]
            sym[q] = -1
            key[q] = key[p] = FAR
            r = nxt[q]
            nxt[p] = r
            more = r < n
            a, b = p[more], r[more]
            prv[b] = a
            key[a], into[a] = self._offer(sym[a], sym[b], a)
            b = p[prv[p] >= 0]
            a = prv[b]
            key[a], into[a] = self._offer(sym[a], sym[b], a)
        live = sym >= 0
        counts = np.add.reduceat(live, first, dtype=np.int64)
        symbols = sym[live]
        ends = np.cumsum(counts)
        data, at = symbols.astype(np.int32).tobytes(), (4 * ends).tolist()
        out = [data[lo:hi] for lo, hi in zip([0, *at], at)]
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(symbols >= len(self.shown)), "right")).tolist()
        for k in odd:
            out[k] = self._ids(symbols[ends[k] - counts[k]: ends[k]].tolist())
        return out

    def _merge_heap(self, unit: str) -> list[str]:
        sym = list(unit)
        n = len(sym)
        prev, nxt = list(range(-1, n - 1)), [*range(1, n), -1]
        rank, agenda = self.rank, []
        for i in range(n - 1):
            pair = sym[i] + sym[i + 1]
            if pair in rank:
                agenda.append((rank[pair], i, i + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, pair = heapq.heappop(agenda)
            # an entry holds only while both symbols are as they were offered
            if nxt[i] != j or sym[i] + sym[j] != pair or not sym[i]:
                continue
            sym[i], sym[j] = pair, ""
            k = nxt[i] = nxt[j]
            nxt[j] = -2
            if k >= 0:
                prev[k] = i
                new = pair + sym[k]
                if new in rank:
                    heapq.heappush(agenda, (rank[new], i, k, new))
            h = prev[i]
            if h >= 0:
                new = sym[h] + pair
                if new in rank:
                    heapq.heappush(agenda, (rank[new], h, i, new))
        return [s for s in sym if s]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, end id last."""
        cut = [self.units(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        every = set().union(*cut)
        new = every - self.memo.keys()
        back = new & self.older.keys()
        self.memo.update((u, self.older[u]) for u in back)
        fresh = [*(new - back)]
        self.memo.update(zip(fresh, self.packed_units(fresh)))
        out = []
        for units in cut:
            ids = np.frombuffer(b"".join(map(self.memo.__getitem__, units)), np.int32).tolist()
            ids.append(self.end)
            out.append(ids)
        for u in fresh:
            if len(u) > MEMO_CHARS:
                del self.memo[u]
        if len(self.memo) > MEMO_ENTRIES:
            self.memo, self.older = {}, self.memo
        return out

    def joined(self, ids: list[int]) -> str:
        """Decimal ids with one space between two."""
        return "".join(map(self.shown.__getitem__, ids))[1:]

    def encode_joined(self, texts: list[str]) -> list[str]:
        """Decimal ids of each text, joined by one space, end id last."""
        return [*map(self.joined, self.encode(texts))]

    def check_texts(self, texts: list[str], ids: list[list[int]]) -> None:
        wanted = self.lib.encode(texts, add_eos=True, num_threads=1)
        if wanted != ids:
            text = next(t for t, a, b in zip(texts, wanted, ids) if a != b)
            raise ValueError(f"the encoder and the library differ on the text {text[:80]!r}")


_codecs: dict[str, PieceCodec] = {}


def _codec(model: bytes) -> PieceCodec:
    key = hashlib.md5(model).hexdigest()
    if key not in _codecs:
        _codecs[key] = PieceCodec(model)
    return _codecs[key]


def _groups(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def encode_texts(df: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None,
                 ids: bool = True, decoded: bool = True) -> DataFrame:
    """Adds n_tokens, ids_sha256, decoded_sha256, and on wish ids (array<int>) and decoded (string).

    ``model_path`` is read on the driver and sent to the tasks (a vocabulary of
    some hundred KB). ``keep`` names the input columns to carry (all if None).
    """
    with open(model_path, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
             T.StructField("decoded_sha256", T.StringType())]
    if ids:
        added.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    if decoded:
        added.append(T.StructField("decoded", T.StringType()))
    names = {f.name for f in added}
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    source = df.select(*kept, df[text].alias("__text"))
    schema = T.StructType([source.schema[c] for c in kept] + added)

    def run(batches):
        codec = _codec(model.value)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(len(kept)).to_pylist()]
            for lo, hi in _groups(texts, CALL_CHARS):
                lists = codec.encode(texts[lo:hi])
                codec.check_texts(texts[lo:hi], lists)
                back = codec.lib.decode(lists, num_threads=1)
                cols = [batch.column(k).slice(lo, hi - lo) for k in range(len(kept))]
                cols.append(pa.array([len(x) for x in lists], pa.int64()))
                cols.append(pa.array([hashlib.sha256(codec.joined(x).encode()).hexdigest() for x in lists], pa.string()))
                cols.append(pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back], pa.string()))
                if ids:
                    cols.append(pa.array(lists, pa.list_(pa.int32())))
                if decoded:
                    cols.append(pa.array(back, pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)
        give_back()

    return source.mapInArrow(run, schema)
