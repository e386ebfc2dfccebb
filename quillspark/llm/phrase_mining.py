"""Operator 11: phrase collocations by mergeable Misra-Gries summaries per hash partition.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
those into words ``[^\\x20\\x09]+``. Everything is counted per language.

Which phrases of 1 to 5 words occur ``least`` times or more is found level by
level: words, then pairs of surviving words, triples of surviving pairs, and
longer phrases of surviving triples (a phrase is never more frequent than its
parts). A level hashes each offered phrase with its language; the leading bits
name one of P hash partitions, P being a power of two that grows with the number
of words, and 32 more bits tell phrases apart (two that meet add up, so both are
kept at worst). Tasks send, per partition, the mass they offer and packed
(hash, count) blocks.
Rows of one partition arrive with all masses first, so its capacity, a count
above mass / least, is known before blocks are merged: equal hashes add up, and
when more than ``capacity`` counters are held, the (capacity+1)-th largest is
subtracted from all and what is not positive goes. That takes less than
``least`` from any counter, in whatever order summaries meet, so every phrase
of ``least`` occurrences survives. Survivors become bits of a filter of fixed
size (``FILTER_BITS``, 8 MB a level, whatever the corpus), each partition filling its
own stretch; it may let other phrases pass, never stop a survivor.

A last pass counts exactly: phrases that pass the filters leave each task in
blocks of a hash partition, are summed there by language and phrase, and those
under ``least`` go. Only then are l, r and scores looked up by joins on phrases.

This pass groups phrases by 64-bit hashes inside a slice; two that collide there
would be counted as one (for 10^10 distinct and 10^6 frequent phrases a chance
of 5 in 10,000 that any count is off).

Null languages count as ``und``, null texts as empty. Ids play no part, repeated
rows count each. An empty table, or one without frequent phrases, gives no
rows. Other columns are ignored. Texts of any length are used whole, in slices of
about a megabyte (one longer text is one slice).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import textvec as V
from quillspark.session import cut_lineage

LEAST = 100
MOST_WORDS = 5
FIRST = 2000
HELD = 1 << 16      # counters a hash partition should need
FILTER_LOG = 26
FILTER_BITS = 1 << FILTER_LOG
BUFFER = 1 << 20    # phrases of a task that are held before they are sent, and entries before they are merged
SALTS = 32
SIZE_KEY = V.mix(np.arange(64, dtype=np.uint64) * V._GOLD)  # keeps phrases of different numbers of words apart
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True


def language_key(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)[0]


class Slice:
    """Words of a slice of texts: hash, piece, byte range and language key of each."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray, keys: np.ndarray):
        self.raw = raw = V.LOWER[raw]
        stop = BREAK[raw]
        self.starts, self.ends, self.of = V.runs(~(stop | BLANK[raw]), offs)
        breaks = np.append(0, np.cumsum(stop))
        self.piece = breaks[self.starts] + self.of
        self.hash = V.Hasher(raw).of(self.starts, self.ends) if len(self.starts) else np.zeros(0, np.uint64)
        self.key = keys[self.of]

    def phrases(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash with language, first word) of all phrases of n words."""
        g, at = V.grams(self.hash, self.piece, n)
        return V.mix(g ^ (self.key[at] + SIZE_KEY[n])), at

    def offered(self, n: int, filters: list) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of n words whose parts pass the filter of the longest level below them."""
        g, at = self.phrases(n)
        if n == 1 or not len(g):
            return g, at
        size = min(n - 1, len(filters))
        part, part_at = self.phrases(size)
        good = np.zeros(len(self.hash) + n, bool)
        good[part_at] = passes(filters[size - 1].value, part)
        ok = good[at]
        for k in range(1, n - size + 1):
            ok &= good[at + k]
        return g[ok], at[ok]


def passes(bits: np.ndarray, g: np.ndarray) -> np.ndarray:
    place = g >> np.uint64(64 - FILTER_LOG)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def sum_sorted(g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(g)
    g, n = g[order], n[order]
    first = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
    return g[first], np.add.reduceat(n, first) if len(g) else n


class Summary:
    """Misra-Gries counters of a known capacity. ``taken`` is what a counter may lack at most."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.g, self.n = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, g: np.ndarray, n: np.ndarray, taken: int = 0) -> None:
        self.g, self.n = sum_sorted(np.concatenate([self.g, g]), np.concatenate([self.n, n]))
        self.taken += taken
        over = len(self.g) - self.capacity
        if over > 0:
            cut = int(np.partition(self.n, over - 1)[over - 1])  # the (capacity + 1)-th largest
            live = self.n > cut
            self.g, self.n, self.taken = self.g[live], self.n[live] - cut, self.taken + cut

    def frequent(self, least: int) -> np.ndarray:
        """Hashes that may have ``least`` occurrences; all that have are among them."""
        return self.g[self.n + self.taken >= least]


def _slices(batches, lang: int, text: int):
    seen: dict[str, np.uint64] = {}
    for batch in batches:
        names = ["und" if x is None else x for x in batch.column(lang).to_pylist()]
        for x in set(names) - seen.keys():
            seen[x] = language_key(x)
        keys = np.array([seen[x] for x in names], np.uint64)
        for lo, hi, raw, offs in V.slices(batch.column(text)):
            yield names[lo:hi], Slice(raw, offs, keys[lo:hi])


BLOCK = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("mass", T.LongType()),
                      T.StructField("hashes", T.BinaryType()), T.StructField("counts", T.BinaryType())])


def offers(docs: DataFrame, sizes: list[int], filters, parts: int) -> DataFrame:
    """Blocks of all phrases of the given sizes that their level offers: per task and hash partition one row of mass (kind 0) and
    rows of packed (hash, count) (kind 1)."""
    drop = np.uint64(33 - parts.bit_length())  # leading bits name the partition, 32 more are kept
    edges = np.arange(parts, dtype=np.uint64) << np.uint64(32)

    def run(batches):
        mass = np.zeros(parts, np.int64)
        held, size = [], 0

        def blocks():
            g, n = sum_sorted(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
            cut = np.append(np.searchsorted(g, edges), len(g)).tolist()
            for p, (a, b) in enumerate(zip(cut, cut[1:])):
                if b > a:
                    mass[p] += n[a:b].sum()
                    yield p, 1, 0, g[a:b].astype(np.uint32).tobytes(), n[a:b].astype(np.uint32).tobytes()

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                              names=BLOCK.names)

        for _, part in _slices(batches, 0, 1):
            for n in sizes:
                g, _at = part.offered(n, filters)
                if len(g):
                    held.append(np.unique(g >> drop, return_counts=True))
                    size += len(held[-1][0])
            if size > 2 * BUFFER:
                g, n = sum_sorted(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
                held, size = [(g, n)], len(g)
                if size > BUFFER:
                    yield batch_of([*blocks()])
                    held, size = [], 0
        if size:
            yield batch_of([*blocks()])
        rows = [(p, 0, m, b"", b"") for p, m in enumerate(mass.tolist()) if m]
        if rows:
            yield batch_of(rows)

    return docs.mapInArrow(run, BLOCK)


def survivors(blocks: DataFrame, parts: int, least: int) -> np.ndarray:
    """Filter of the hashes that may occur ``least`` times, merged per hash partition and put together on the driver (a fixed size)."""
    stretch = FILTER_BITS // parts // 8

    def run(batches):
        now, mass, summary, held, size = None, 0, None, [], 0

        def settle():
            nonlocal held, size
            if held:
                summary.merge(*(np.concatenate(x) for x in zip(*held)))
            held, size = [], 0

        def done():
            settle()
            bits = np.zeros(stretch * 8, np.uint8)
            bits[summary.frequent(least) // ((1 << 32) // len(bits))] = 1
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())],
                                              names=["part", "bits"])

        for batch in batches:
            for part, kind, m, hashes, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now:
                    if summary is not None:
                        yield done()
                    now, mass, summary = part, 0, None
                if kind == 0:
                    mass += m
                    continue
                if summary is None:
                    summary = Summary(mass // least + 1)
                held.append((np.frombuffer(hashes, np.uint32), np.frombuffer(counts, np.uint32).astype(np.int64)))
                size += len(held[-1][0])
                if size > BUFFER:
                    settle()
        if summary is not None:
            yield done()

    ordered = blocks.repartition(parts, "part").sortWithinPartitions("part", "kind")
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in ordered.mapInArrow(run, "part int, bits binary").collect():
        out[row.part * stretch: (row.part + 1) * stretch] = np.frombuffer(row.bits, np.uint8)
    return out


def exact_counts(docs: DataFrame, filters: list, levels: list[list[int]], parts: int, least: int) -> DataFrame:
    """(lang, phrase, size, f) of all phrases that pass the filters and occur ``least`` times or more in the corpus."""
    drop = np.uint64(65 - parts.bit_length())

    def count(batches):
        held: dict[tuple[int, str], dict[str, int]] = {}

        def blocks():
            keys, n = [*held], [len(x) for x in held.values()]
            at = pa.array(np.append(0, np.cumsum(n)), pa.int32())
            phrases = pa.array([x for c in held.values() for x in c], pa.string())
            counts = pa.array([x for c in held.values() for x in c.values()], pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()),
                                               pa.ListArray.from_arrays(at, phrases), pa.ListArray.from_arrays(at, counts)], names=["part", "lang", "phrases", "counts"])

        for names, part in _slices(batches, 0, 1):
            data, size = part.raw.tobytes(), part.ends - part.starts
            for level, sizes in enumerate(levels):
                for n in sizes:
                    g, at = part.offered(n, filters)
                    ok = passes(filters[level].value, g)
                    g, first, times = np.unique(g[ok], return_index=True, return_counts=True)
                    w = at[ok][first]
                    lo, hi = part.starts[w], part.ends[w + n - 1]
                    # words of a phrase that are parted by one blank are already the phrase
                    tight = hi - lo == sum(size[w + k] for k in range(n)) + n - 1
                    for p, a, b, t, c, one in zip((g >> drop).tolist(), lo.tolist(), hi.tolist(), part.of[w].tolist(), times.tolist(), tight.tolist()):
                        phrase = data[a:b].replace(b"\t", b" ").decode()
                        if not one:
                            phrase = " ".join(x for x in phrase.split(" ") if x)
                        counts = held.setdefault((p, names[t]), {})
                        counts[phrase] = counts.get(phrase, 0) + c
            if sum(map(len, held.values())) > BUFFER // 2:
                yield blocks()
        if held:
            yield blocks()

    def add(batches):
        now, held = None, {}

        def done():
            rows = [(lang, x, x.count(" ") + 1, n) for lang, counts in held.items() for x, n in counts.items() if n >= least]
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.string(), pa.string(), pa.int32(), pa.int64()))],
                                              names=["lang", "phrase", "size", "f"])

        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.column(0)[k].as_py()
                if part != now:
                    if held:
                        yield done()
                    now, held = part, {}
                counts = held.setdefault(batch.column(1)[k].as_py(), {})
                for x, n in zip(batch.column(2)[k].as_py(), batch.column(3)[k].as_py()):
                    counts[x] = counts.get(x, 0) + n
        if held:
            yield done()

    blocks = docs.mapInArrow(count, "part int, lang string, phrases array<string>, counts array<long>")
    return blocks.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(add, "lang string, phrase string, size int, f long")


def word_totals(docs: DataFrame) -> DataFrame:
    """(lang, n): all word occurrences of each language."""
    def run(batches):
        total: dict[str, int] = {}
        for names, part in _slices(batches, 0, 1):
            for name, c in zip(names, np.bincount(part.of, minlength=len(names)).tolist()):
                total[name] = total.get(name, 0) + c
        yield pa.RecordBatch.from_arrays([pa.array([*total], pa.string()), pa.array([*total.values()], pa.int64())], names=["lang", "n"])

    return docs.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, total: int, least: int = LEAST, most_words: int = MOST_WORDS) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of 1 to ``most_words`` words with f >= ``least``; docs: (lang, text); total: its words."""
    context = docs.sparkSession.sparkContext
    levels = [[n] for n in range(1, min(most_words, 3) + 1)] + ([[*range(4, most_words + 1)]] if most_words > 3 else [])
    parts = 1 << min(20, max(5, (total // (least * HELD)).bit_length()))
    filters: list = []
    for sizes in levels:
        filters.append(context.broadcast(survivors(offers(docs, sizes, filters[:3], parts), parts, least)))
    return exact_counts(docs, filters, levels, parts, least)


def mine_phrases(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, most_words: int = MOST_WORDS,
                 first: int = FIRST, absorbed: int = 100) -> DataFrame:
    """Each language's ``first`` phrases by score: lang, rank, phrase, a, l, r, n, score.

    A phrase goes if a longer candidate holds it ``absorbed`` percent of the times or more.
    """
    docs = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    totals = cut_lineage(word_totals(docs))
    total = totals.agg(F.sum("n")).first()[0] or 0
    known = cut_lineage(frequent_phrases(docs, total, least, most_words))
    words = F.split("phrase", " ", -1)
    longer = known.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("w"))

    def joined(a, n):
        return F.array_join(F.slice("w", a, n), " ")

    # the next longer candidate that holds a phrase is at least as frequent as any longer one that does
    holds = (longer.where("size > 2").select("lang", F.explode(F.array(joined(F.lit(1), F.col("size") - 1), joined(F.lit(2), F.col("size") - 1))).alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("most")))
    kept = longer.join(holds, ["lang", "phrase"], "left").where(F.coalesce(F.col("most"), F.lit(0)) * 100 < F.col("a") * absorbed)
    cuts = kept.select("lang", "phrase", "size", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    f = known.select("lang", F.col("phrase").alias("part"), F.col("f"))
    cuts = (cuts.join(f.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(f.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"]))
    # a language may hold most rows: its total is met in salts
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    cuts = cuts.withColumn("salt", salt).join(totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>"))), ["lang", "salt"])
    # 38 digits hold 1000 * a * n and l * r beyond 64 bits; div on decimals is exact
    score = F.expr("cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    rows = cut_lineage(best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = rows.withColumn("salt", salt)
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= first).drop("salt", "rank")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return near.withColumn("rank", rank).where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
