"""Operator 3: substring deduplication with content-defined chunks.

A chunk ends where a gear rolling hash over the last ``WINDOW`` bytes is largest
among the ``LEAST`` - 1 bytes on either side (of equal ones the first), so cuts
depend on content alone and an insertion moves only the chunks it touches. Cuts
lie ``least`` bytes or more apart; where none comes within ``most`` bytes
(repetitive text), the largest hash in reach is the cut, so that such text is
cut by content too. Cuts fall between characters. A chunk's digest is 128 bits.
A digest found at two or more places (document, offset) is a repeat; the
place that sorts first keeps the chunk. Runs of consecutive repeated chunks
with at least ``min_words`` words form a repeated passage; in these passages
every chunk but its first place is removed. Shorter runs are left alone. Words
of a passage's first and last chunk that it shares only in part do not count and
stay in the text.

Chunk rows are grouped by digest with map-side combine (smallest and largest
place), so a line that a third of all documents share is one row per task there;
the join back to chunk rows is an equi-join that adaptive execution can split.
Texts are read twice and never shuffled.

Cases: null and empty texts have no chunks; rows that share an id are one
document (one result row, its chunks taken together), and rows equal in id and
text are no repeats of each other; null ids are one document; an empty table
gives no rows; other columns are ignored. Texts of any length are chunked whole,
and a text without cut places has chunks of at most ``most`` bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import textvec as V

WINDOW = 16
LEAST, MOST = 21, 64
MIN_WORDS = 16
GEAR = (V.mix(np.arange(256, dtype=np.uint64) + np.uint64(7919)) >> np.uint64(32)).astype(np.uint32)


def gear_hash(raw: np.ndarray) -> np.ndarray:
    """Gear hash of the last WINDOW bytes at every byte, by doubling: h2k[i] = hk[i] + (hk[i-k] << k)."""
    h = GEAR[raw]
    k = 1
    while k < WINDOW:
        wide = h.copy()
        wide[k:] += h[:-k] << np.uint32(k)
        h, k = wide, 2 * k
    return h


def _largest(x: np.ndarray, n: int) -> np.ndarray:
    """Maximum of ``n`` consecutive values, by the place of the first."""
    k = 1
    while k < n:
        step = min(k, n - k)
        x, k = np.maximum(x[:-step], x[step:]), k + step
    return x


def cut_places(raw: np.ndarray, offs: np.ndarray, least: int = LEAST, most: int = MOST) -> list[tuple[int, int, int]]:
    """(text index, start, end) of every chunk, in order."""
    h = gear_hash(raw)
    of = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    at = np.arange(len(raw))
    h[at - offs[of] < WINDOW - 1] = 0  # has bytes of the text before
    h[:-1][(raw[1:] & 0xC0) == 0x80] = 0  # no cut within a character
    # texts are laid apart, so that cuts do not depend on the neighbours in a slice
    reach = least - 1
    wide = np.zeros(len(raw) + reach * len(offs), h.dtype)
    at += reach * (of + 1)
    wide[at] = h
    around = _largest(wide, reach)
    ends = (np.flatnonzero((h > around[at - reach]) & (h >= around[at + 1])) + 1).tolist()
    out, k = [], 0
    for t, (last, stop) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
        while last < stop:
            while k < len(ends) and ends[k] - last < least:
                k += 1
            end = min(ends[k] if k < len(ends) else stop, stop)
            if end - last > most:
                # least bytes stay before the next cut, which no forced one may move
                end = last + least + int(h[last + least - 1: min(last + most, end - least)].argmax())
            out.append((t, last, end))
            last = end
    return out


def with_chunks(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_words and chunks: array of (d1, d2, ord, start, stop, words), start and stop in characters."""
    chunk = T.StructType([T.StructField(c, T.LongType()) for c in ("d1", "d2", "ord", "start", "stop", "words")])
    schema = T.StructType([df.schema[id_col], T.StructField("n_words", T.LongType()), T.StructField("chunks", T.ArrayType(chunk))])

    def run(batches):
        for batch in batches:
            for lo, hi, raw, offs in V.slices(batch.column(1)):
                n = hi - lo
                of, first, last = np.array(cut_places(raw, offs), np.int64).reshape(-1, 3).T
                data = raw.tobytes()
                digests = b"".join([hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(first.tolist(), last.tolist())])
                d = np.frombuffer(digests, np.int64).reshape(-1, 2)
                chars = np.zeros(len(raw) + 1, np.int64)
                np.cumsum((raw & 0xC0) != 0x80, out=chars[1:])
                begins = np.zeros(len(raw) + 1, np.int64)
                starts, _, wof = V.runs(~V.SPACE[raw], offs)
                begins[starts + 1] = 1
                np.cumsum(begins, out=begins)
                count = np.bincount(of, minlength=n)
                at = np.concatenate([[0], np.cumsum(count)])
                base = chars[offs[of]]
                parts = [d[:, 0], d[:, 1], np.arange(len(of)) - at[of], chars[first] - base, chars[last] - base, begins[last] - begins[first]]
                items = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(p)) for p in parts], names=chunk.names)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.array(V.word_counts(wof, n)),
                                                  pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), items)], names=schema.names)

    return df.select(id_col, text).mapInArrow(run, schema)


def repeated_chunks(chunked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Chunks whose digest has several places: id, ord, start, stop, words, first (keeps the chunk), across (other documents have it)."""
    rows = chunked.select(F.col(id_col).alias("__id"), F.inline("chunks"))
    place = F.struct("__id", "start")
    found = (rows.groupBy("d1", "d2").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
             .where(~F.col("lo").eqNullSafe(F.col("hi"))))
    # two numbers in a long (all are under 2^31): fewer bytes are shuffled
    packed = rows.select("d1", "d2", "__id", (F.shiftleft("start", 32) + F.col("ord")).alias("at"),
                         (F.shiftleft(F.col("stop") - F.col("start"), 32) + F.col("words")).alias("size"))
    low = F.lit((1 << 32) - 1)
    met = packed.join(found, ["d1", "d2"]).select(
        "__id", "lo", "hi", F.col("at").bitwiseAND(low).alias("ord"), F.shiftright("at", 32).alias("start"),
        (F.shiftright("at", 32) + F.shiftright("size", 32)).alias("stop"), F.col("size").bitwiseAND(low).alias("words"))
    return (met.select(F.col("__id").alias(id_col), "ord", "start", "stop", "words", place.eqNullSafe(F.col("lo")).alias("first"),
                       (~F.col("lo.__id").eqNullSafe(F.col("hi.__id"))).alias("across")).distinct())


def passages(repeats: DataFrame, id_col: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """Repeated chunks that lie in runs of at least ``min_words`` words. Windows hold one document each."""
    in_doc = Window.partitionBy(id_col).orderBy("ord")
    run = Window.partitionBy(id_col, "__run")
    return (repeats.withColumn("__run", F.col("ord") - F.dense_rank().over(in_doc))
            .withColumn("__words", F.sum("words").over(run)).where(F.col("__words") >= min_words).drop("__words"))


def dedup_report(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: n_words, n_chunks, n_repeat_words (in repeated passages), repeats_across (a passage is in another
    document), n_removed_words and removed (array of [start, stop) in characters)."""
    chunked = with_chunks(df, id_col, text)
    runs = passages(repeated_chunks(chunked, id_col), id_col, min_words)
    per_doc = runs.groupBy(F.col(id_col).alias("__id")).agg(
        F.sum("words").alias("n_repeat_words"), F.max("across").alias("repeats_across"),
        F.coalesce(F.sum(F.when(~F.col("first"), F.col("words"))), F.lit(0)).cast("bigint").alias("n_removed_words"),
        F.sort_array(F.collect_list(F.when(~F.col("first"), F.struct("start", "stop")))).alias("removed"))
    docs = chunked.groupBy(id_col).agg(F.sum("n_words").alias("n_words"), F.sum(F.size("chunks")).cast("bigint").alias("n_chunks"))
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return docs.join(per_doc, docs[id_col].eqNullSafe(per_doc["__id"]), "left").select(
        id_col, "n_words", "n_chunks", F.coalesce("n_repeat_words", F.lit(0)).alias("n_repeat_words"),
        F.coalesce("repeats_across", F.lit(False)).alias("repeats_across"),
        F.coalesce("n_removed_words", F.lit(0)).alias("n_removed_words"), F.coalesce("removed", none).alias("removed"))


def deduplicated(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The input with repeated passages cut out of ``text`` (ids are taken as unique here)."""
    cuts = dedup_report(df, id_col, text, min_words).where(F.size("removed") > 0).select(F.col(id_col).alias("__id"), "removed")
    # what stays lies between one removed piece's end and the next one's start
    stays = F.expr("""aggregate(removed, struct(0L as at, '' as kept),
        (s, r) -> struct(greatest(s.at, r.stop) as at, concat(s.kept, substring(__t, int(s.at + 1), int(greatest(r.start - s.at, 0)))) as kept),
        s -> concat(s.kept, substring(__t, int(s.at + 1))))""")
    joined = df.withColumn("__t", F.col(text)).join(cuts, F.col(id_col) == F.col("__id"), "left")
    return joined.withColumn(text, F.when(F.col("removed").isNull(), F.col("__t")).otherwise(stays)).select(*df.columns)
