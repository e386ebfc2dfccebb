"""Operators 11 to 13 against brute force, and their handling of odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from quillspark.llm import licence_index, merge_align, ngram_rules, phrase_mining
from quillspark.llm import textvec as V
from quillspark.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


# --- 11 -------------------------------------------------------------------

def brute_phrases(rows, least, first=2000, absorbed=100):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for n in range(1, 6):
                f.update((lang, *words[i:i + n]) for i in range(len(words) - n + 1))
    f = {k: v for k, v in f.items() if v >= least}
    inside = {}
    for (lang, *w), a in f.items():
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                part = (lang, *w[i:i + n])
                inside[part] = max(inside.get(part, 0), a)
    out = []
    for (lang, *w), a in f.items():
        if len(w) < 2 or 100 * inside.get((lang, *w), 0) >= absorbed * a:
            continue
        score, k = min((1000 * a * total[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[(lang, *w[:k])], f[(lang, *w[k:])], total[lang], score))
    ranked, seen = [], Counter()
    for r in sorted(out, key=lambda r: (r[0], -r[6], -r[2], r[1].encode())):
        seen[r[0]] += 1
        if seen[r[0]] <= first:
            ranked.append((r[0], seen[r[0]], *r[1:]))
    return ranked


def got_phrases(df, **how):
    return sorted(tuple(r) for r in phrase_mining.mine_phrases(df, **how).collect())


@pytest.mark.parametrize("least,absorbed", [(3, 100), (2, 60)])
def test_phrases_match_brute_force(spark, least, absorbed):
    rng = random.Random(least)
    words = ["a", "b", "C", "of the", "é", "x\ty", "p  q", "z\x00", "日本"]
    rows = [(rng.choice(["en", "fr", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", ". ", "\n", "\t "]) for _ in range(30)))
            for _ in range(60)]
    rows += [("en", None), (None, ""), ("en", ".,;"), rows[0], rows[0]]
    df = spark.createDataFrame([(lang, t, 1, "k") for lang, t in rows], "lang string, text string, n int, phrase string").repartition(5)
    assert got_phrases(df, least=least, absorbed=absorbed) == sorted(brute_phrases(rows, least, absorbed=absorbed))


def test_phrases_rank_is_cut_per_language(spark):
    rows = [("en", " ".join(f"w{i % 40}" for i in range(400)))] * 3 + [("fr", "a b a b a b a b")]
    assert got_phrases(spark.createDataFrame(rows, "lang string, text string"), least=2, first=5) == sorted(brute_phrases(rows, 2, first=5))


def test_score_beyond_64_bits(spark):
    got = spark.range(1).selectExpr("cast(3000000000 as bigint) a", "cast(90000000000 as bigint) n", "cast(3000000000 as bigint) l").selectExpr(
        "cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)) div (cast(l as decimal(19,0)) * cast(l as decimal(19,0))) s").first().s
    assert got == 1000 * 3000000000 * 90000000000 // 3000000000 ** 2


def test_phrases_odd_rows(spark, odd, none):
    assert got_phrases(none.selectExpr("*", "'en' lang")) == []
    plain = odd.selectExpr("*", "cast(null as string) lang", "3 rank", "'z' phrase", "1 n")
    rows = [("und", r.text) for r in odd.collect()]
    assert got_phrases(plain, least=2) == sorted(brute_phrases(rows, 2))


def test_summary_keeps_all_frequent_hashes():
    rng = np.random.default_rng(1)
    for _ in range(30):
        least = int(rng.integers(5, 40))
        items = np.concatenate([rng.zipf(1.3, 3000) % 500, rng.integers(0, 10**6, 3000)]).astype(np.uint64)
        rng.shuffle(items)
        whole = phrase_mining.Summary(len(items) // least + 1)
        parts = np.array_split(items, 7)
        for k, p in enumerate(parts):
            g, n = np.unique(p, return_counts=True)
            if k % 2:  # merge a summary instead of raw counts
                s = phrase_mining.Summary(whole.capacity)
                s.merge(g, n)
                whole.merge(s.g, s.n, s.taken)
            else:
                whole.merge(g, n)
        g, n = np.unique(items, return_counts=True)
        assert set(g[n >= least].tolist()) <= set(whole.frequent(least).tolist())
        assert whole.taken < least and len(whole.g) <= whole.capacity


def test_phrases_survive_small_partitions(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    usual = got_phrases(docs)
    monkeypatch.setattr(phrase_mining, "HELD", 16)
    monkeypatch.setattr(phrase_mining, "BUFFER", 500)
    assert got_phrases(docs.repartition(7)) == usual
    assert usual == sorted(brute_phrases([(r.lang, r.text) for r in docs.select("lang", "text").collect()], 100))


# --- 12 -------------------------------------------------------------------

def licence_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute_base(text):
    words, hits, labels = licence_words(text), [], set()
    for phrase, label in licence_index.PHRASES.items():
        p = phrase.split(" ")
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        hits += at
        labels |= {label} if at else set()
    return len(words), len(hits), min(hits, default=None), max(hits, default=None), ",".join(sorted(labels))


def brute_labels(texts, coverage=licence_index.COVERAGE):
    """Labels and score of each text by testing every entry at every place."""
    words = [licence_words(t) for t in texts]
    vocab = {w for p in licence_index.PHRASES for w in p.split()} | {w for _, n, keys in licence_index.NOTICES for t in (n, *keys) for w in t.split()}
    with_word = Counter(w for ws in words for w in set(ws) & vocab)
    idf = {w: 1 + np.log((len(texts) + 1) / (with_word[w] + 1)) for w in vocab}
    out = []
    for ws in words:
        labels, score = set(), 0.0
        for p, label in licence_index.PHRASES.items():
            p = p.split()
            if any(ws[i:i + len(p)] == p for i in range(len(ws))):
                labels.add(label)
                score = 1.0
        for label, notice, keys in licence_index.NOTICES:
            n = notice.split()
            total = sum(idf[w] for w in n)
            for s in range(-len(n) + 1, len(ws)):
                share = sum(idf[w] for j, w in enumerate(n) if 0 <= s + j < len(ws) and ws[s + j] == w) / total
                if share < coverage - 1e-12:
                    continue
                good = True
                for key in keys:
                    k = key.split()
                    place = next(i for i in range(len(n)) if n[i:i + len(k)] == k)
                    good &= any(s + place + d >= 0 and ws[s + place + d: s + place + d + len(k)] == k for d in range(-licence_index.SLACK, licence_index.SLACK + 1))
                if good:
                    labels.add(label)
                    score = max(score, share)
        out.append((",".join(sorted(labels)), score))
    return out


def test_licence_base_matches_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op12_licence_index"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(docs[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_licence_labels_match_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", "--", "GNU General Public License", "gnu general public license " * 40, "The CC-BY! apache\nLICENSE mit license mit",
             "no license here", "version 3", "日本 apache license版"]
    for _, notice, keys in licence_index.NOTICES:
        words = notice.split()
        texts.append("intro words " + notice.title().replace(" ", ", ") + " and more")
        for _ in range(4):
            some = [w if rng.random() > 0.2 else "other" for w in words]
            if rng.random() < 0.5:
                some.insert(rng.randrange(len(some)), "inserted")
            texts.append(" ".join(some[rng.randrange(3):]))
        texts.append(keys[0])
    df = spark.createDataFrame([(i, t, 9, "x", 0.1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int, labels string, score double").repartition(4)
    got = {r.doc_id: r for r in licence_index.scan_licences(df, keep=["doc_id", "labels"]).collect()}
    found = 0
    for i, (labels, score) in enumerate(brute_labels(texts)):
        assert got[i].labels == labels and got[i].score == pytest.approx(score), texts[i]
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels) == brute_base(texts[i])
        assert {m.label for m in got[i].matches} == set(labels.split(",")) - {""}
        found += bool(labels)
    assert found > len(licence_index.NOTICES)


def test_licence_odd_rows(spark, odd, none):
    got = licence_index.scan_licences(odd, keep=["doc_id", "id", "score"]).collect()
    assert len(got) == odd.count() and all(r.n_base == 0 and r.labels == "" and r.first_word is None and r.score == 0 for r in got)
    assert licence_index.scan_licences(none).count() == 0


# --- 13 -------------------------------------------------------------------

def brute_tokens(tools, text):
    if not text:
        return [], []
    a, b = tools.exact.encode(" " + text, add_special_tokens=False).ids, tools.lib.encode(text)
    whole = (" " + text).encode()
    if b"".join(tools.a_bytes[i] for i in a) != whole or b"".join(tools.b_bytes[i] for i in b) != whole:
        return [], []
    return a, b


def brute_aligned(tools, texts):
    docs = []
    for t in texts:
        a, b = brute_tokens(tools, t)
        ends = [np.cumsum([len(table[i]) for i in ids]).tolist() for table, ids in ((tools.a_bytes, a), (tools.b_bytes, b))]
        groups, links, i, j = [], [], 0, 0
        at = [{e: k for k, e in enumerate(x)} for x in ends]
        for e in ends[0]:
            if e in at[1]:
                p, q = at[0][e] + 1, at[1][e] + 1
                groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
                links.append((a[p - 1], b[q - 1]))
                i, j = p, q
        docs.append((len(a), len(b), groups, links))
    count = Counter(x for d in docs for x in d[3])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    return [(na, nb, len(g), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for na, nb, g, links in docs]


@pytest.fixture(scope="module")
def tools():
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        return merge_align.Tokenizers(f.read(), g.read())


def cells(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256


@pytest.mark.parametrize("heavy", [1 << 20, 50])
def test_alignment_matches_brute_force(spark, sf, tools, heavy, monkeypatch):
    monkeypatch.setattr(merge_align, "HEAVY", heavy)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], brute_aligned(tools, [r.text for r in docs])))
    got = QUERIES["op13_merge_align"](spark, sf).collect()
    assert {r.doc_id: cells(r) for r in got} == want and len(got) == len(docs)


def test_alignment_odd_rows(spark, odd, none, tools):
    rows = odd.union(spark.createDataFrame([(20, "▁x", "x", 0, [1], "y", 0.5, True), (21, "<|endoftext|></s><0x0A>", "x", 0, [1], "y", 0.5, True),
                                            (22, " " * 300_000 + "end", "x", 0, [1], "y", 0.5, True)], odd.schema)).withColumnRenamed("h", "n_a")
    given = rows.select("doc_id", "text").collect()
    got = merge_align.align_texts(rows, A, B, keep=["doc_id", "id", "n_a"]).collect()
    want = brute_aligned(tools, [r.text for r in given])
    key = lambda x: (-1 if x[0] is None else x[0], x[1])
    assert sorted([(r.doc_id, cells(r)) for r in got], key=key) == sorted(zip([r.doc_id for r in given], want), key=key)
    assert got[0].id == "x"
    assert merge_align.align_texts(none, A, B).count() == 0
    assert next(cells(r) for r in got if r.doc_id == 20)[:4] == (0, 0, 0, 0)


def test_pieces_are_equal_work_and_stitch():
    rng = random.Random(3)
    for piece in (1, 2, 3, 7, 4096):
        for _ in range(150):
            n = rng.randint(1, 60)
            a, b = (np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n})) for _ in range(2))
            i, j = merge_align.diagonals(a, b, piece)
            assert all(np.diff(i + j)[:-1] == piece) and (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all()
            x, y, both = merge_align.overlaps(a, b, piece)
            ends = sorted({*a.tolist(), *b.tolist()})
            assert x.tolist() == [int((a < e).sum()) for e in ends] and y.tolist() == [int((b < e).sum()) for e in ends]
            assert both.tolist() == [e in a and e in b for e in ends]


# --- 9: packed count vectors ----------------------------------------------

def test_packed_counts_match_counts_by_the_same_buckets(spark, sf, monkeypatch):
    monkeypatch.setattr(ngram_rules, "BUFFER", 1000)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    good = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 and toxic = 0").select("doc_id")
    got = {r.doc_id: r.score for r in ngram_rules.apply_rules(docs.repartition(5), good).collect()}
    rows, ids = docs.collect(), {r.doc_id for r in good.collect()}
    raw, offs = V.buffer_of(pa.array([r.text for r in rows], pa.string()))
    bucket, of = ngram_rules.ngram_buckets(raw, offs)
    trusted = np.array([r.doc_id in ids for r in rows])
    both = np.stack([np.bincount(bucket, minlength=ngram_rules.BUCKETS), np.bincount(bucket[trusted[of]], minlength=ngram_rules.BUCKETS)]) + 1.0
    ratio = np.log(both[1] / both[1].sum()) - np.log(both[0] / both[0].sum())
    for k, r in enumerate(rows):
        mine = ratio[bucket[of == k]]
        assert got[r.doc_id] == pytest.approx(mine.mean() if len(mine) else 0.0, abs=1e-6)
