"""Operators 1, 3 and 7 against brute force, and their odd cases."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from quillspark.llm import components, gear_dedup, prob_minhash as P, simhash_decon, textvec as V


def shingles(t):
    w = (t or "").split()
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])


def jp(x, y):
    x, y = Counter(x), Counter(y)
    u = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in u) for i in u if x[i] and y[i])


def test_probability_jaccard_and_register_agreement():
    rng = np.random.default_rng(3)
    for _ in range(4):
        x = rng.integers(0, 4, 60)
        y = np.where(rng.random(60) < 0.8, x, rng.integers(0, 4, 60))
        use = (x > 0) | (y > 0)
        x, y = x[use], y[use]
        g = V.mix(np.arange(1, len(x) + 1, dtype=np.uint64))
        exact = P.probability_jaccard(x, y)
        assert abs(exact - jp(np.repeat(np.arange(len(x)), x).tolist(), np.repeat(np.arange(len(y)), y).tolist())) < 1e-9
        sig = P.signatures(np.concatenate([g[x > 0], g[y > 0]]), np.concatenate([x[x > 0], y[y > 0]]),
                           np.concatenate([np.zeros((x > 0).sum(), int), np.ones((y > 0).sum(), int)]), 2, 4096)
        assert abs((sig[0] == sig[1]).mean() - exact) < 0.035


def test_signature_does_not_depend_on_the_batch():
    texts = [" ".join(f"t{(k * 7 + j) % 90}" for j in range(5 + 13 * k)) for k in range(12)]
    def sig(part):
        raw, offs = V.buffer_of(pa.array(part))
        return P.signatures(*P.weighted_shingles(raw, offs), len(part))
    whole = sig(texts)
    assert all((whole[k] == sig([t])[0]).all() for k, t in enumerate(texts))


def brute_groups(rows):
    texts = sorted({(i, t or "") for i, t in rows if i is not None})
    up = {i: i for i, _ in texts}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, (i, a) in enumerate(texts):
        for j, b in texts[:k]:
            if a == b or (shingles(a) and shingles(b) and jp(shingles(a), shingles(b)) >= 0.8):
                u, v = sorted((top(i), top(j)))
                up[v] = u
    return {i: top(i) for i in up}


def family(make_passage, n, edits, seed):
    rng = random.Random(seed)
    base = make_passage(seed, 160).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_match_brute_force(spark, make_passage, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 8)  # several blocks a bucket
    texts = family(make_passage, 40, 6, 11) + family(make_passage, 12, 3, 12) + [make_passage(k, 50) for k in range(20, 40)]
    texts += [texts[0], texts[0], texts[45], "short text", "short text", "", None]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in P.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_groups(rows)
    assert {i: r.group_id for i, r in got.items()} == want
    first = {}
    for i, t in rows:
        first.setdefault(t or "", i)
    assert all(got[i].class_id == first[t or ""] for i, t in rows)
    assert all(r.kept == (r.doc_id == r.group_id) for r in got.values())


def test_near_duplicates_odd_rows(odd, none):
    got = P.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[8]) == 2 and {r.group_id for r in by[8] + by[9]} == {8}
    assert [r.group_id for r in by[1] + by[2]] == [1, 1] and by[3][0].group_id == 3
    assert by[None][0].group_id is None and by[None][0].kept
    assert P.near_duplicates(none).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}}


def test_chunks_cover_the_text_and_survive_an_insertion(make_passage):
    a = make_passage(5, 900)
    b = a[:1000] + " inserted words " + a[1000:]
    cuts = []
    for t in (a, b, "é日" * 3000):
        raw, offs = V.buffer_of(pa.array([t]))
        c = gear_dedup.cut_places(raw, offs)
        assert c[0][1] == 0 and c[-1][2] == len(raw) and all(x[2] == y[1] for x, y in zip(c, c[1:]))
        assert all(x[2] - x[1] >= gear_dedup.LEAST for x in c[:-1]) and max(x[2] - x[1] for x in c) <= gear_dedup.MOST
        for _, s, e in c:
            raw[s:e].tobytes().decode()
        cuts.append({raw[s:e].tobytes() for _, s, e in c})
    assert len(cuts[0] - cuts[1]) <= 4


def test_substring_dedup_finds_shared_passages(spark, make_passage):
    shared = make_passage(99, 55)
    rows = [(1, make_passage(1, 80) + " " + shared + " " + make_passage(2, 40)), (2, make_passage(3, 50) + "\n" + shared),
            (3, make_passage(4, 200)), (4, make_passage(6, 30) + " tiny " + shared[:40])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in gear_dedup.dedup_report(df).collect()}
    assert got[1].repeats_across and got[2].repeats_across and not got[3].repeats_across and not got[4].repeats_across
    assert got[1].n_removed_words == 0 and got[2].n_removed_words >= 30
    text = {r.doc_id: r.text for r in gear_dedup.deduplicated(df).collect()}
    assert text[1] == rows[0][1] and text[3] == rows[2][1]
    kept, at = "", 0
    for s, e in got[2].removed:
        kept, at = kept + rows[1][1][at:s], e
    assert text[2] == kept + rows[1][1][at:] and len(text[2]) < len(rows[1][1]) - 150


def test_substring_dedup_finds_passages_of_few_words(spark, make_passage):
    rng = random.Random(8)
    rows = []
    for k in range(40):
        few = [f"{rng.choice('abcdefgh') * rng.randint(1, 4)}{rng.randrange(900)}" for _ in range(rng.randint(1, 6))]
        shared = " ".join((few * 51)[:51])
        rows += [(2 * k + j, f"{make_passage(600 + 2 * k + j, 20 + j)} {shared} {make_passage(800 + 2 * k + j, 20)}") for j in (0, 1)]
    got = gear_dedup.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 80 and not [r.doc_id for r in got if not r.repeats_across]


def test_cuts_do_not_depend_on_the_slice(make_passage):
    texts = [make_passage(k, n) for k, n in ((31, 60), (32, 3), (33, 200))] + ["", "ab " * 90, "日本" * 70]
    def cuts(part):
        raw, offs = V.buffer_of(pa.array(part))
        return [(t, s - offs[t], e - offs[t]) for t, s, e in gear_dedup.cut_places(raw, offs)]
    assert cuts(texts) == [(k, s, e) for k, t in enumerate(texts) for _, s, e in cuts([t])]


def test_substring_dedup_odd_rows(odd, none):
    got = {r.doc_id: r for r in gear_dedup.dedup_report(odd).collect()}
    assert len(got) == 12 and got[1].n_chunks == got[2].n_chunks == 0
    assert got[9].n_removed_words > 0 and got[8].n_removed_words == 0 and got[8].repeats_across and not got[7].repeats_across
    assert gear_dedup.dedup_report(none).count() == 0


def test_decontamination_matches_brute_force(spark, make_passage):
    rng = random.Random(4)
    items = [(k, make_passage(200 + k, 15 + 3 * k)) for k in range(14)] + [(50, "three word item"), (51, ""), (52, None), (53, "aa aa aa aa aa aa aa aa aa bb")]
    docs = [(k, make_passage(300 + k, 70)) for k in range(15)]
    for n in range(45):
        w = items[n % 14][1].split()
        for _ in range(n // 14):
            k = rng.randrange(len(w))
            how = rng.randrange(3)
            w[k:k + 1] = [[f"z{n}"], [w[k], f"z{n}"], []][how]
        docs.append((100 + n, make_passage(400 + n, rng.randrange(40)) + " " + " ".join(w).upper() + "\n" + make_passage(500 + n, rng.randrange(1, 30))))
    docs += [(900, "three word item"), (901, "aa " * 9 + "bb"), (902, None), (903, "")]
    want = set()
    for d, t in docs:
        s = shingles((t or "").lower())
        for i, u in items:
            it = shingles((u or "").lower())
            if not it or not s:
                continue
            for a in range(max(1, len(s) - len(it) + 1)):
                x, y = Counter(s[a:a + len(it)]), Counter(it)
                m = sum((x & y).values())
                if m / (sum(x.values()) + len(it) - m) >= 0.8:
                    want.add((d, i))
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = simhash_decon.decontaminate(df, it).collect()
    got = {(r.doc_id, i) for r in rows for i in r["items"]}
    assert got <= want and len(want - got) <= 1 and len(rows) == len(docs)  # the radius keeps 0.9998 of pairs at 0.8
    assert {r.doc_id for r in rows if r.contaminated} == {d for d, _ in got}
    assert all((r.similarity >= 0.8) == r.contaminated for r in rows)


def test_hamming_blocks_meet_within_the_radius(spark):
    rng = random.Random(8)
    pairs = []
    for _ in range(60):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), simhash_decon.RADIUS):
            b ^= 1 << k
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long").select(simhash_decon.block_keys("a").alias("x"), simhash_decon.block_keys("b").alias("y"))
    assert all(set(r.x) & set(r.y) for r in df.collect())


def test_decontamination_odd_rows(spark, odd, none, make_passage):
    items = spark.createDataFrame([(1, make_passage(2, 60), 3), (2, None, 3), (3, "", 4)], "item_id long, text string, n int")
    rows = simhash_decon.decontaminate(odd, items).collect()
    assert {r.doc_id for r in rows if r.contaminated} == {8, 9} and len(rows) == 12
    assert simhash_decon.decontaminate(none, items).count() == 0
    assert not any(r.contaminated for r in simhash_decon.decontaminate(odd, items.where("false")).collect())
