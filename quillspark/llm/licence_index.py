"""Operator 12: licence scan with a positional index of rare words.

The index holds short licence notices (``NOTICES``) and licence phrases
(``PHRASES``), each a list of words with positions. A first pass counts in how
many texts each of their words stands, over all texts, which gives an inverse
document frequency (idf) to every word of the index. A notice is looked up
through its rarest words only: as many of the highest idf as weigh more than
what a match may lack, so a text that reaches the notice's ``coverage`` has one
of them at its place. A phrase must stand whole, so its rarest word is enough.

In a text, every occurrence of a looked-up word gives, by its postings, places
where a notice or phrase would begin; equal places meet. Each place is then
verified on all words of the entry at their relative positions: a phrase by all
of them, a notice by idf weight of the words in place (>= ``coverage``) and by
its mandatory key phrases, which must stand within ``SLACK`` words of their
place. Words found by hash are compared byte by byte with the index.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased.
Null and empty texts have no words: zeros, empty labels, null places. Rows are
kept one to one, repeated rows too; other columns pass through only if named in
``keep`` (an input column named like an output column is replaced). An empty
table gives no rows. Texts are used whole, in slices of about a megabyte (one
longer text is one slice). The index is fixed in size, whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import textvec as V

COVERAGE = 0.6
SLACK = 3
CHUNK = 1 << 20
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True

# Phrases that label a text wherever they stand.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Label, words of the notice, key phrases that must be there.
NOTICES = [
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("general public license", "version 3")),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ("general public license", "version 2")),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
                   "as published by the free software foundation", ("general public license", "free software foundation")),
    ("lgpl-notice", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license "
                    "as published by the free software foundation", ("lesser general public license",)),
    ("agpl-notice", "you can redistribute it and or modify it under the terms of the gnu affero general public license", ("affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("apache-2.0-notice", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
                          "you may obtain a copy of the license at", ("apache license", "in compliance with the license")),
    ("mit-release", "released under the mit license", ("mit license",)),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
                   "the software to deal in the software without restriction", ("free of charge", "without restriction")),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
                   "conditions are met", ("source and binary forms", "conditions are met")),
    ("isc-notice", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
                   "provided that the above copyright notice and this permission notice appear in all copies", ("with or without fee",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc-by-notice", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("released into the public domain",)),
    ("boost", "distributed under the boost software license version 1 0", ("boost software license",)),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
    ("proprietary", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means",
     ("all rights reserved", "no part of this")),
]


@dataclass
class Entry:
    """A notice or phrase of the index: word numbers, share of its weight a match needs, key phrases as (entry, place)."""

    label: str
    words: list[int]
    share: float
    keys: list[tuple[int, int]]


class Index:
    """Words, entries and, once idf is known, the postings of looked-up words."""

    def __init__(self, phrases: dict[str, str], notices: list[tuple], coverage: float = COVERAGE):
        said = [*phrases, *(k for _, _, keys in notices for k in keys)]
        self.vocab = sorted({w for t in (*said, *(n[1] for n in notices)) for w in t.split(" ")})
        number = {w: i for i, w in enumerate(self.vocab)}
        place = {}
        self.entries: list[Entry] = []
        for p in said:
            if p not in place:
                place[p] = len(self.entries)
                self.entries.append(Entry(phrases.get(p, ""), [number[w] for w in p.split(" ")], 1.0, []))
        self.base = [place[p] for p in phrases]
        self.n_phrases = len(self.entries)
        for label, text, keys in notices:
            words = text.split(" ")
            at = [(place[k], next(i for i in range(len(words)) if words[i: i + len(k.split(" "))] == k.split(" "))) for k in keys]
            self.entries.append(Entry(label, [number[w] for w in words], coverage, at))
        data = [w.encode() for w in self.vocab]
        self.size = np.array([len(w) for w in data])
        self.letters = np.zeros((len(data), self.size.max()), np.uint8)
        for i, w in enumerate(data):
            self.letters[i, : len(w)] = np.frombuffer(w, np.uint8)
        raw = np.frombuffer(b"".join(data), np.uint8)
        ends = np.cumsum(self.size)
        h = V.Hasher(raw).of(ends - self.size, ends)
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        self.width = max(len(e.words) for e in self.entries)
        self.grid = np.full((len(self.entries), self.width), -2)
        for k, e in enumerate(self.entries):
            self.grid[k, : len(e.words)] = e.words
        self.length = np.array([len(e.words) for e in self.entries])

    def words(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number in the index or -1, text index) of each word of a slice of lower-cased bytes."""
        starts, ends, of = V.runs(WORD[raw], offs)
        if not len(starts):
            return np.zeros(0, np.int64), of
        h = V.Hasher(raw).of(starts, ends)
        k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        number = np.where(self.hashes[k] == h, self.order[k], -1)
        hit = np.flatnonzero(number >= 0)
        v, s = number[hit], starts[hit]
        same = ends[hit] - s == self.size[v]
        for c in range(self.letters.shape[1]):
            inside = c < self.size[v]
            same &= ~inside | (raw[np.minimum(s + c, len(raw) - 1)] == self.letters[v, c])
        number[hit[~same]] = -1
        return number, of

    def weigh(self, texts_with: np.ndarray, texts: int) -> None:
        """Sets idf weights and the postings: per entry its rarest words, until the others weigh less than a match needs."""
        self.idf = 1 + np.log((texts + 1) / (texts_with + 1.0))
        self.weight = np.where(self.grid >= 0, self.idf[self.grid], 0.0)
        self.weight /= self.weight.sum(axis=1, keepdims=True)
        listed = []
        for k, e in enumerate(self.entries):
            rest = 1.0
            for p in sorted(range(len(e.words)), key=lambda p: (-self.idf[e.words[p]], e.words[p], p)):
                listed.append((e.words[p], k, p))
                rest -= self.weight[k, p]
                if rest < e.share - 1e-9:
                    break
        listed.sort()
        self.post_entry, self.post_place = (np.array([x[c] for x in listed]) for c in (1, 2))
        self.post_first = np.searchsorted([x[0] for x in listed], np.arange(len(self.vocab) + 1))

    def places(self, number: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, entry, first word of the slice) where a looked-up word stands as the entry has it."""
        found = []
        at = np.flatnonzero(number >= 0)
        many = (self.post_first[1:] - self.post_first[:-1])[number[at]]
        at, many = at[many > 0], many[many > 0]
        for lo in range(0, len(at), CHUNK):
            a, m = at[lo: lo + CHUNK], many[lo: lo + CHUNK]
            w = np.repeat(a, m)
            post = np.arange(len(w)) - np.repeat(np.cumsum(m) - m, m) + self.post_first[number[w]]
            found.append(np.unique(np.stack([of[w], self.post_entry[post], w - self.post_place[post]]), axis=1))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.unique(np.concatenate(found, axis=1), axis=1))

    def scan(self, number: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Verified (text, entry, first word in the text, share of weight in place), sorted by text, entry and word."""
        first = np.searchsorted(of, np.arange(n + 1))
        text, entry, at = self.places(number, of)
        share = np.zeros(len(text))
        step = CHUNK // self.width
        for lo in range(0, len(text), step):
            t, e = text[lo: lo + step], entry[lo: lo + step]
            w = at[lo: lo + step, None] + np.arange(self.width)
            inside = (w >= first[t][:, None]) & (w < first[t + 1][:, None])
            right = inside & (number[np.clip(w, 0, len(number) - 1)] == self.grid[e])
            share[lo: lo + step] = (right * self.weight[e]).sum(axis=1)
            whole = right.sum(axis=1) == self.length[e]
            share[lo: lo + step][whole] = 1.0
        need = np.array([e.share for e in self.entries])
        ok = np.where(entry < self.n_phrases, share == 1.0, share >= need[entry])
        text, entry, at, share = text[ok], entry[ok], at[ok] - first[text[ok]], share[ok]
        ok = np.ones(len(text), bool)
        for k in np.unique(entry[entry >= self.n_phrases]):
            mine = np.flatnonzero(entry == k)
            for phrase, place in self.entries[k].keys:
                there = entry == phrase
                span = int(at.max(initial=0)) + 4 * self.width + 4 * SLACK
                code = text[there] * span + at[there] + self.width + SLACK
                want = text[mine] * span + at[mine] + place + self.width + SLACK
                ok[mine] &= np.searchsorted(code, want + SLACK, "right") > np.searchsorted(code, want - SLACK)
        return text[ok], entry[ok], at[ok], share[ok]


def texts_with_words(df: DataFrame, text: str, index: Index) -> tuple[np.ndarray, int]:
    """In how many texts each word of the index stands, and how many texts there are; one row a task is summed."""
    size = len(index.vocab)

    def run(batches):
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for lo, hi, raw, offs in V.slices(batch.column(0)):
                number, of = index.words(V.LOWER[raw], offs)
                hit = number >= 0
                total[:size] += np.bincount(np.unique(of[hit] * size + number[hit]) % size, minlength=size)
                total[size] += hi - lo
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array(total)], names=["word", "n"])

    got = df.select(text).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size + 1, np.int64)
    total[got["word"].to_numpy()] = got["n"].to_numpy()
    return total[:size], int(total[size])


def scan_licences(df: DataFrame, text: str = "text", keep: list[str] | None = None, phrases: dict[str, str] = PHRASES,
                  notices: list[tuple] = NOTICES, coverage: float = COVERAGE, matches: bool = True) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels, score (share of weight of the best verified entry that
    has a label, 0 without) and, on wish, matches: (label, first word, share) of every verified phrase and notice."""
    index = Index(phrases, notices, coverage)
    index.weigh(*texts_with_words(df, text, index))
    longs = [T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")]
    added = [*longs, T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType())]
    kind = T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()), T.StructField("share", T.DoubleType())])
    if matches:
        added.append(T.StructField("matches", T.ArrayType(kind)))
    names = {f.name for f in added}
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    source = df.select(*kept, df[text].alias("__text"))
    schema = T.StructType([source.schema[c] for c in kept] + added)
    name = [e.label for e in index.entries]
    is_base = np.zeros(len(name), bool)
    is_base[index.base] = True
    labelled = np.array([bool(x) for x in name])

    def run(batches):
        for batch in batches:
            for lo, hi, raw, offs in V.slices(batch.column(len(kept))):
                n = hi - lo
                number, of = index.words(V.LOWER[raw], offs)
                t, e, at, share = index.scan(number, of, n)
                b = is_base[e]
                n_base = np.bincount(t[b], minlength=n)
                low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                np.minimum.at(low, t[b], at[b])
                np.maximum.at(high, t[b], at[b])
                score = np.zeros(n)
                use = labelled[e]
                np.maximum.at(score, t[use], share[use])
                base_of, all_of = ([set() for _ in range(n)] for _ in range(2))
                for i, k in {*zip(t[use].tolist(), e[use].tolist())}:
                    all_of[i].add(name[k])
                    if is_base[k]:
                        base_of[i].add(name[k])
                none = pa.array(n_base == 0)
                cols = [batch.column(k).slice(lo, n) for k in range(len(kept))]
                cols += [pa.array(V.word_counts(of, n)), pa.array(n_base.astype(np.int64)),
                         *(pc.if_else(none, None, pa.array(x)) for x in (low, high)),
                         *(pa.array([",".join(sorted(s)) for s in sets], pa.string()) for sets in (base_of, all_of)), pa.array(np.minimum(score, 1.0))]
                if matches:
                    found = [[] for _ in range(n)]
                    for i, k, w, s in zip(t[use].tolist(), e[use].tolist(), at[use].tolist(), share[use].tolist()):
                        found[i].append({"label": name[k], "first_word": w, "share": s})
                    cols.append(pa.array(found, pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("share", pa.float64())]))))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return source.mapInArrow(run, schema)
