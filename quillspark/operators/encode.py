"""Sentence markers and id encoding for sequence models."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from quillspark.operators.features import let
from quillspark.operators.joins import join_small

# Special tokens.
SOS, EOS, ELB, SLB = "<SOS>", "<EOS>", "<ELB>", "<SLB>"
UNK, PAD = "<UNK>", "<PAD>"
ROWS = 256  # texts whose grids are built at once


def add_markers(sentences, t_w: int) -> Column:
    """Per sentence (space-separated tokens) prepend <SOS>; a sentence of at
    most t_w - 1 tokens ends with <EOS>; a longer one is cut into pieces of
    t_w - 1 tokens ending in <ELB>, each next piece starting with <SLB>, the
    last ending in <EOS>. Returns the pieces (strings) of all sentences."""
    s = F.col(sentences) if isinstance(sentences, str) else sentences
    cap = t_w - 1

    def pieces(toks):
        L = F.size(toks)
        short = F.array(F.array_join(F.concat(toks, F.array(F.lit(EOS))), " "))
        first = F.array_join(F.concat(F.slice(toks, 1, cap), F.array(F.lit(ELB))), " ")

        def rest_pieces(rest):
            m = F.ceil(F.size(rest) / F.lit(cap - 1)).cast("int")
            return F.transform(F.sequence(F.lit(0), m - 1), lambda j: F.array_join(F.concat(
                F.array(F.lit(SLB)), F.slice(rest, j * (cap - 1) + 1, cap - 1),
                F.array(F.when(j == m - 1, F.lit(EOS)).otherwise(F.lit(ELB)))), " "))
        long = F.concat(F.array(first), let(F.slice(toks, cap + 1, L), rest_pieces))
        return F.when(L <= cap, short).otherwise(long)

    per = F.transform(s, lambda sent: let(F.concat(F.array(F.lit(SOS)), F.filter(F.split(sent, " "), lambda x: x != "")), pieces))
    return F.flatten(per)


def encode_ids(df: DataFrame, vocab: DataFrame, id_col: str, pieces_col: str, max_sents: int = 50,
               max_tokens: int = 30) -> DataFrame:
    """Token ids per sentence piece, OOV -> <UNK>, each piece padded / cut to
    ``max_tokens`` with <PAD>, at most ``max_sents`` pieces (also padded).

    ``vocab``: (term, id) from ``rank.build_vocab`` (specials first). The vocab
    is joined on the exploded tokens (size-checked broadcast)."""
    v = vocab.select(F.col("term").alias("tok"), F.col("id").alias("tid"))
    unk = vocab.filter(F.col("term") == UNK).select(F.col("id").alias("__unk"))
    pad = vocab.filter(F.col("term") == PAD).select(F.col("id").alias("__pad"))
    ex = df.select(id_col, F.posexplode(F.slice(pieces_col, 1, max_sents)).alias("s", "piece"))
    toks = ex.select(id_col, "s", F.posexplode(F.slice(F.split("piece", " "), 1, max_tokens)).alias("t", "tok"))
    j = join_small(toks, v, "tok", "left").crossJoin(F.broadcast(unk)).withColumn("tid", F.coalesce("tid", "__unk"))
    rows = j.groupBy(id_col, "s").agg(F.sort_array(F.collect_list(F.struct("t", "tid"))).alias("__ts"))
    rows = rows.crossJoin(F.broadcast(pad)).withColumn(
        "ids", F.concat(F.transform("__ts", lambda x: x["tid"]),
                        F.array_repeat(F.col("__pad"), F.lit(max_tokens) - F.size("__ts"))))
    docs = rows.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("s", "ids"))).alias("__ss"), F.first("__pad").alias("__pad"))
    return docs.select(id_col, F.concat(F.transform("__ss", lambda x: x["ids"]),
                                        F.array_repeat(F.array_repeat(F.col("__pad"), max_tokens), F.lit(max_sents) - F.size("__ss"))).alias("ids"),
                       F.size("__ss").alias("n_sents"))


def char_grid(pieces: Sequence[Sequence[str] | None], chars: np.ndarray, ids: np.ndarray, unk: int, pad: int, max_sents: int = 50, max_tokens: int = 30, max_chars: int = 15) -> pa.Array:
    """Character ids of the tokens of sentence pieces as fixed (max_sents, max_tokens, max_chars) grids, one a row.

    ``chars``, ``ids``: code points in order and their ids. Sentences, tokens and characters beyond the grid are cut, what is
    missing is ``pad``, unknown characters are ``unk``; a null row or piece has no grid."""
    where, tokens = [], []
    for r, row in enumerate(pieces):
        for i, s in enumerate((row or [])[:max_sents]):
            cut = [] if s is None else s.split(" ")[:max_tokens]
            at = (r * max_sents + i) * max_tokens
            where += range(at, at + len(cut))
            tokens += [t[:max_chars] for t in cut]
    codes = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in tokens], np.int64)
    place = np.minimum(np.searchsorted(chars, codes), len(chars) - 1)
    grid = np.full(len(pieces) * max_sents * max_tokens * max_chars, pad, np.int32)
    inside = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
    grid[np.repeat(np.array(where, np.int64), size) * max_chars + inside] = np.where(chars[place] == codes, ids[place], unk)

    def lists(values, n: int, missing=None):
        at = pa.array(np.arange(0, len(values) + 1, n), pa.int32())
        return pa.ListArray.from_arrays(at, values, mask=None if missing is None else pa.array(missing))

    none = np.zeros((len(pieces), max_sents), bool)
    for r, row in enumerate(pieces):
        none[r, :len(row or [])] = [s is None for s in (row or [])[:max_sents]]
    return lists(lists(lists(pa.array(grid), max_chars), max_tokens, none.ravel()), max_sents, np.array([row is None for row in pieces]))


def grid_lengths(pieces, max_sents: int = 50, max_tokens: int = 30, max_chars: int = 15) -> Column:
    """True lengths inside the grid: struct(n_sents, n_tokens array a sentence, n_chars array of arrays)."""
    p = F.slice(F.col(pieces) if isinstance(pieces, str) else pieces, 1, max_sents)
    toks = F.transform(p, lambda s: F.slice(F.split(s, " "), 1, max_tokens))
    return F.struct(F.size(p).alias("n_sents"), F.transform(toks, F.size).alias("n_tokens"),
                    F.transform(toks, lambda ts: F.transform(ts, lambda t: F.least(F.length(t), F.lit(max_chars)))).alias("n_chars"))


def encode_chars(df: DataFrame, char_vocab: DataFrame, id_col: str, pieces_col: str, max_sents: int = 50, max_tokens: int = 30, max_chars: int = 15) -> DataFrame:
    """(id, chars, n_sents, n_tokens, n_chars). ``char_vocab``: (term, id) of single characters with <UNK> and <PAD>
    (``rank.build_vocab`` over character counts, at most its top_k rows), sent to the tasks as two arrays."""
    ids = {r.term: r.id for r in char_vocab.select("term", F.col("id").cast("int").alias("id")).collect()}
    known = sorted((ord(t), i) for t, i in ids.items() if t is not None and len(t) == 1) or [(-1, -1)]
    sent = df.sparkSession.sparkContext.broadcast([np.array(x, np.int64) for x in zip(*known)])
    unk, pad = ids[UNK], ids[PAD]
    source = df.select(id_col, F.col(pieces_col).alias("chars"), grid_lengths(pieces_col, max_sents, max_tokens, max_chars).alias("__n")).select(id_col, "chars", "__n.*")
    schema = ST.StructType([source.schema[id_col], ST.StructField("chars", ST.ArrayType(ST.ArrayType(ST.ArrayType(ST.IntegerType())))), *source.schema.fields[2:]])

    def part(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                rows = batch.slice(lo, ROWS)
                grid = char_grid(rows.column(1).to_pylist(), *sent.value, unk, pad, max_sents, max_tokens, max_chars)
                yield pa.RecordBatch.from_arrays([rows.column(0), grid, *rows.columns[2:]], names=schema.names)

    return source.mapInArrow(part, schema)
