"""Operators 4, 8 and 10, the pipeline, and the driver's entries for the subpackage."""

import hashlib
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillspark.llm import boosted_pii as B, merkle, sp_codec
from quillspark.llm.queries import OP10_SQL, QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return sp_codec.PieceCodec(open(MODEL, "rb").read())


def test_encoder_equals_the_library(codec):
    rng = random.Random(3)
    texts = ["", " ", "  a  b ", "a\nb", "\n", "\n ", " \n", "▁x", "▁▁ ▁", "a\x00b", "日本語 テスト", "<s> </s> <0x0A>", "\t\r\nx", "x" * 3000, "ab" * 40,
             "🙂👍🏽 é", "　\xa0", "e.g. don't! (a.b),c;d"]
    texts += ["".join(rng.choice("abe \n▁é.x,!t'h-(日") for _ in range(rng.randint(1, 150))) for _ in range(1500)]
    joined = codec.encode_joined(texts)
    for t, j in zip(texts, joined):
        assert [int(x) for x in j.split()] == [*codec.lib.encode(t), codec.end]
    # long units by heap and short ones by rounds give the same
    units = ["▁" + "".join(rng.choice("theandio") for _ in range(60)) for _ in range(200)]
    for u, ids in zip(units, codec.merge_units(units)):
        assert ids == "".join(codec.shown[codec._id(s)] for s in codec._merge_heap(u))


def test_encode_texts_odd_rows(odd, none, codec):
    got = sp_codec.encode_texts(odd, MODEL).collect()
    assert len(got) == odd.count() and set(odd.columns) <= set(got[0].asDict())
    for r in got:
        ids = [*codec.lib.encode(r.text or ""), codec.end]
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == codec.lib.decode(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert sp_codec.encode_texts(none, MODEL).count() == 0


def test_every_text_is_checked(spark, monkeypatch):
    """Wrong ids of any text raise, not only those of a slice's shortest one."""
    import pyarrow as pa
    codec, kept = sp_codec.PieceCodec(open(MODEL, "rb").read()), []
    right = codec.encode
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: kept.append(run))
    monkeypatch.setattr(sp_codec, "_codec", lambda model: codec)
    sp_codec.encode_texts(df, MODEL)
    texts = ["short", None, "", "a text of some more words", "the longest text of all of them, by far"]

    def batches():
        yield pa.record_batch([pa.array(range(5)), pa.array(texts), pa.array(texts)], names=["doc_id", "text", "__text"])
    assert sum(len(b) for b in kept[0](batches())) == 5
    for wrong in filter(None, texts):
        monkeypatch.setattr(codec, "encode", lambda some: [[5, *ids] if t == wrong else ids for t, ids in zip(some, right(some))])
        with pytest.raises(ValueError, match="differ"):
            list(kept[0](batches()))


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute_spans(t):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_match_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", "a@b.c_d@e.f", "x a@b.c.d. y@z", "1.2.3.4.5.6.7.8", "+1+1 234567 8", "4111 1111 1111 1111", "4111-1111-1111-1111 5", "a@-b.-c", "@a.b",
             "1.2.3.256 255.255.255.255 001.002.003.0004", "9" * 4000, "a" * 9000 + "@b.c", "a@" + "b." * 3000 + "c", "1 " * 3000, " 41111111", "é🙂 +49 30 1234567"]
    texts += ["".join(rng.choice("ab@@..__ 0123456789+-()\n é") for _ in range(rng.randint(5, 60))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in B.with_base(rows, "text").select("doc_id", B.spans_text("base").alias("s")).collect()}
    assert [got[k] for k in range(len(texts))] == [brute_spans(t) for t in texts]


def test_trees_learn_and_calibrate():
    rng = random.Random(6)
    counts = []
    for _ in range(200):
        row = {f: rng.randrange(n) for f, n in B.FEATURES.items()}
        good = row["kind"] == 2 and row["digits"] >= 6 or row["brackets"] == 1 and row["left"] == 0
        counts.append({**row, "pos": 20 if good else 0, "neg": 0 if good else 20})
    trees = B.fit_trees(counts[:150])
    wrong = sum((sum(B._leaf(t, c) for t in trees) > 0) != (c["pos"] > 0) for c in counts[150:])
    assert wrong <= 4
    assert B.calibrate(trees, counts[150:]) <= 1 and B.calibrate(trees, []) > 1 and B.calibrate([], counts) > 1
    assert B.fit_trees([{**counts[0], "pos": 3, "neg": 0}]) == []


def test_pii_adds_likely_spans_and_keeps_base(spark):
    rng = random.Random(7)
    digits = lambda n: "".join(rng.choice("123456789") for _ in range(n))
    texts = []
    for k in range(120):
        texts.append(f"call me at +1 ({digits(3)}) {digits(3)}-{digits(4)} please number {k}")
        texts.append(f"code x{digits(3)}-{digits(3)}-{digits(4)}x and {digits(3)}.{digits(3)}.999.{digits(3)}")
    texts.append("phone (409) 555-8387 now")
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in B.find_spans(rows).select("doc_id", B.spans_text("base").alias("b"), B.spans_text("spans").alias("s")).collect()}
    assert all(got[k].b == brute_spans(t) and set(filter(None, got[k].b.split(","))) <= set(got[k].s.split(",")) for k, t in enumerate(texts))
    assert got[240].b == "" and got[240].s in ("", "phone:6:20")
    clean = {r.doc_id: r.text for r in B.redact(B.find_spans(rows)).collect()}
    assert clean[0] == "call me at [PHONE] please number 0" and clean[1] == texts[1]


def test_pii_odd_rows(odd, none):
    got = B.find_spans(odd).collect()
    assert len(got) == odd.count() and not any(r.base or r.spans for r in got)
    assert [r.text for r in B.redact(B.find_spans(odd)).orderBy("doc_id").collect()] == [r.text for r in odd.orderBy("doc_id").collect()]
    assert B.find_spans(none).count() == 0
    both = odd.sparkSession.createDataFrame([("a 1.2.3.4@x.org b",)], "text string")
    assert B.redact(B.find_spans(both)).first().text == "a [EMAIL] b"  # overlapping kinds become one


def test_merkle_matches_sql_and_finds_all_damage(spark, duck, sf):
    got = QUERIES["op10_merkle_audit"](spark, sf).toPandas()
    want = duck.execute(OP10_SQL).df()
    cols = sorted(want.columns)
    rows = lambda d: sorted(map(repr, d[cols].astype(object).where(d[cols].notna(), None).values.tolist()))
    assert rows(got) == rows(want) and len(got)


def test_merkle_odd_rows(spark):
    data = [(k, f"record {k}") for k in range(300)] + [(5, "record 5"), (None, "no id"), (400, None)]
    df = spark.createDataFrame(data, "id long, body string").withColumn("hash", F.lit(1)).withColumn("node", F.lit("x"))
    record = F.coalesce("body", F.lit(""))
    assert merkle.audit_replicas(df, "id", record, record, fanout=4).count() == 0
    bad = F.when(F.col("id") == 17, "Record 17").when(F.col("id") == 18, "short").when(F.col("id").isNull(), F.lit(None)).otherwise(record)
    got = {r.record_id: r.status for r in merkle.audit_replicas(df, "id", record, bad, fanout=4).collect()}
    assert got == {17: "changed", 18: "resized", None: "missing"}
    lost = merkle.audit_replicas(df, "id", record, F.lit(None).cast("string"), fanout=4)
    assert lost.count() == len(data) and {r.status for r in lost.collect()} == {"missing"}
    assert merkle.audit_replicas(df.where("false"), "id", record, record).count() == 0


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf).checkpoint()
        if k < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            before, after = ({r.doc_id: r for r in x.collect()} for x in (docs, out))
            assert set(after) <= set(before)
            changed = [i for i in after if after[i] != before[i]]
            gone = len(before) - len(after)
            if name == "pii":
                assert gone == 0 and changed and all(after[i].n_chars == len(after[i].text) and not brute_spans(after[i].text) for i in changed)
                assert set(changed) == {i for i, r in before.items() if brute_spans(r.text)}
            else:
                assert not changed
            if name == "near_dedup":
                from quillspark.llm import prob_minhash
                groups = prob_minhash.near_duplicates(docs).collect()
                assert set(after) == {r.doc_id for r in groups if r.kept} and gone
            if name == "decontaminate":
                from quillspark.llm import simhash_decon
                hits = simhash_decon.decontaminate(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()
                assert set(before) - set(after) == {r.doc_id for r in hits if r.contaminated} and gone
        else:
            assert out.count() == docs.count() and {"doc_id", "ids", "n_tokens"} <= set(out.columns)
        docs = out


def test_pipeline_odd_rows(spark, odd, none, sf):
    shape = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    rows = spark.createDataFrame([(r.doc_id, r.text, "en", None, None, "x") for r in odd.collect()], shape)
    for start in (rows, rows.where("false")):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf).checkpoint()
        assert sorted(r.doc_id or 0 for r in docs.collect()) == ([0, 4, 5, 6, 7, 8, 10] if start is rows else [])


def test_pipeline_decides_by_row(spark, sf, make_passage):
    """Rows without an id, and rows that share an id but not the text, stay or go by their own text."""
    a, b, c, d = (make_passage(k, 160) for k in range(70, 74))
    near = c.replace(c.split()[80], "edited")
    item = max((r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()), key=len)

    def left(stage, rows):
        docs = spark.createDataFrame([(i, t, "en", None, len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        return sorted(((r.doc_id or 0, r.text) for r in stage(spark, docs, sf).collect()))

    kept = left(corpus_pipeline.near_dedup, [(1, b), (5, a), (5, b), (6, a), (6, a), (None, c), (None, c), (None, near), (None, d), (None, b)])
    assert [r for r in kept if r[1] not in (c, near)] == sorted([(0, d), (1, b), (5, a)]) and len(kept) == 4
    clean = left(corpus_pipeline.decontaminate, [(None, item), (None, d), (5, a), (5, f"{item} {b}")])
    assert clean == sorted([(0, d), (5, a)])


def test_entry_lists_the_queries():
    import __spark_entry__ as entry
    found = entry.queries()
    assert [sum(q.startswith(f"op{n}_") for q in found) for n in range(1, 11)] == [1] * 10 and "pipeline" in found
    assert set(entry.oracle_sql()) <= set(found) and "op10_merkle_audit" in entry.oracle_sql()
