"""Readers / writers on small files, the file stream, and the driver contract."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from quillspark.sources import io

SF = "/root/testdata/sf0.001"


def _tmp():
    return tempfile.mkdtemp(prefix="qs-test-", dir="/tmp")


def test_aa_av_roundtrip(spark):
    d = _tmp()
    aa = spark.createDataFrame([(0, 'multi\nline "quoted", text'), (1, "plain")], "author_id long, text string")
    io.write_aa(aa, f"{d}/aa")
    back = sorted((r.author_id, r.text) for r in io.read_aa(spark, f"{d}/aa").collect())
    assert back == [(0, 'multi\nline "quoted", text'), (1, "plain")]
    av = spark.createDataFrame([(1, "a, b", "c\nd")], "label int, text0 string, text1 string")
    io.write_av(av, f"{d}/av")
    r = io.read_av(spark, f"{d}/av").first()
    assert (r.label, r.text0, r.text1) == (1, "a, b", "c\nd")
    header = open([os.path.join(f"{d}/av", f) for f in os.listdir(f"{d}/av") if f.endswith(".csv")][0]).readline().strip()
    assert header == "same/diff auth,text1,text2"


def test_pan_pairs_and_answers(spark):
    d = _tmp()
    with open(f"{d}/pairs.jsonl", "w") as f:
        f.write(json.dumps({"id": "a", "pair": ["t0", "t1"]}) + "\n" + json.dumps({"id": "b", "pair": ["u0", "u1"]}) + "\n")
    with open(f"{d}/truth.jsonl", "w") as f:
        f.write(json.dumps({"id": "a", "authors": ["x", "x"], "same": True}) + "\n" + json.dumps({"id": "b", "authors": ["x", "y"], "same": False}) + "\n")
    p = {r.id: r for r in io.read_pan_pairs(spark, f"{d}/pairs.jsonl", f"{d}/truth.jsonl").collect()}
    assert p["a"].auth0 == "x" and p["b"].text1 == "u1"
    ans = {r.id: r.value for r in io.read_answers(spark, f"{d}/truth.jsonl").collect()}
    assert ans == {"a": 1.0, "b": 0.0}


def test_blog_posts(spark):
    d = _tmp()
    doc = ("<Blog>\n<date>01,May,2004</date>\n<post>\n  first line\n\n  second line\n</post>\n"
           "<date>02,May,2004</date>\n<post>\nonly\n</post>\n</Blog>\n")
    with open(f"{d}/123.male.25.Student.Leo.xml", "w") as f:
        f.write(doc)
    rows = io.read_blog_posts(spark, f"{d}/*.xml").orderBy("post_idx").collect()
    assert [r.text for r in rows] == ["first line second line", "only"]
    assert rows[0].date == "01,May,2004" and rows[0].gender == "male" and rows[0].topic == "Student"


def test_reviews_and_author_lines(spark):
    d = _tmp()
    with open(f"{d}/Books.json", "w") as f:
        f.write(json.dumps({"reviewerID": "r1", "summary": "Great", "reviewText": "x" * 60}) + "\n")
        f.write(json.dumps({"reviewerID": "r2", "reviewText": "y" * 60}) + "\n")
        f.write(json.dumps({"reviewerID": "r3", "summary": "no text"}) + "\n")
    r = {x.author: x for x in io.read_reviews(spark, f"{d}/*.json").collect()}
    assert set(r) == {"r1", "r2"} and r["r1"].text.startswith("Great ") and r["r2"].text.startswith(" y") and r["r1"].topic == "Books"
    with open(f"{d}/authors.jsonl", "w") as f:
        for a in ("a", "b", "c"):
            f.write(json.dumps({"author_id": a, "syms": [a + "1", a + "2"]}) + "\n")
    al = io.read_author_lines(spark, f"{d}/authors.jsonl", num_authors=2).collect()
    assert sorted({(x.author_idx, x.author_id) for x in al}) == [(0, "a"), (1, "b")]


def test_file_stream_cleaning(spark):
    from quillspark.streaming.files import clean_posts, document_stream
    src = _tmp()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # the documents table split into three files
    for i in range(3):
        docs.filter(F.col("doc_id") % 3 == i).coalesce(1).write.parquet(f"{src}/part{i}")
    stream = clean_posts(document_stream(spark, f"{src}/*"))
    q = stream.writeStream.format("memory").queryName("cleaned_posts").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT count(*) AS n FROM cleaned_posts").first().n
    batch = clean_posts(docs).count()
    assert got == batch and got > 0


def test_driver_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 100


def test_tweet_tsv_repair(spark):
    d = _tmp()
    lines = [
        "1\t10\thello world\t2020",        # good
        "21\t11",                           # a record broken between its fields
        "tweet\t2021",
        "x3\t12\tbad user\t2020",          # user id not an int: dropped
        "4\t13\thello world\t2022",        # duplicate tweet: dropped
        "5\t14\tfine\x00 text\t2023",      # NUL removed
        "61\t15\tthree fields",             # five fields in the run: straddles a record, dropped
        "other half\t2024",
        "7\t16\tbetween\t2025",
        "81\t17",                           # two records in one run, a one-character field ignored
        "first\tx\t2026",
        "91",
        "18\tsecond\t2027",
    ]
    with open(f"{d}/tweets.tsv", "w") as f:
        f.write("\n".join(lines) + "\n")
    out = sorted((r.user_id, r.text, r.label) for r in io.read_tweet_tsv(spark, f"{d}/tweets.tsv").collect())
    # labels in first-seen order
    assert out == [(1, "hello world", 0), (5, "fine text", 2), (7, "between", 3), (21, "tweet", 1), (81, "first", 4), (91, "second", 5)]
