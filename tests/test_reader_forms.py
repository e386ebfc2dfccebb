"""Readers, writers and refusing forms on small files."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import clean, encode, joins, vectors
from quillspark.sources import io


def put(path, data: bytes):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


# A10, A11 -------------------------------------------------------------------

def test_text_tree_with_category_and_encodings(spark, tmp_path):
    put(tmp_path / "news" / "ann" / "1.txt", "café – “au”\nau lait €".encode("cp1252"))
    put(tmp_path / "blog" / "bob" / "2.txt", "naïve\r\n\nlast".encode("cp1252"))
    whole = {r.path.rsplit("/", 1)[1]: r for r in io.read_text_tree(spark, str(tmp_path / "*" / "*" / "*.txt"), "windows-1252", category_level=-3).collect()}
    assert (whole["1.txt"].author, whole["1.txt"].category, whole["1.txt"].text) == ("ann", "news", "café – “au”\nau lait €")
    lines = io.read_text_tree(spark, str(tmp_path / "*" / "*" / "*.txt"), "windows-1252", per_line=True).collect()
    assert sorted((r.author, r.text) for r in lines) == [("ann", "au lait €"), ("ann", "café – “au”"), ("bob", ""), ("bob", "last"), ("bob", "naïve")]
    put(tmp_path / "u" / "eve" / "3.txt", "日本\né".encode())
    assert sorted(r.text for r in io.read_text_tree(spark, str(tmp_path / "u" / "*" / "*.txt"), per_line=True).collect()) == ["é", "日本"]


PATTERN = r"^(S[0-9]{2})([A-Z]+)_([a-z]+)\.txt$"


def coded(spark, *names):
    df = spark.createDataFrame([(f"/x/{n}",) for n in names], "path string")
    return io.parse_coded_filenames(df, PATTERN, ("author", "genre", "topic"), codes={"genre": ("ESSAY", "MAIL", "BLOG"), "topic": ("war", "sex", "tax")})


def test_coded_names_are_repaired_by_the_nearest_code(spark):
    got = {(r.author, r.genre, r.topic) for r in coded(spark, "S01ESSAY_war.txt", "S02ESAY_sex.txt", "S03MAIL_wars.txt").collect()}
    assert got == {("S01", "ESSAY", "war"), ("S02", "ESSAY", "sex"), ("S03", "MAIL", "war")}


@pytest.mark.parametrize("name,why", [("S01ESSAY-war.txt", "bad file name"), ("S01CHATS_war.txt", "unknown genre"), ("S01MAIL_sax.txt", "ambiguous topic")])
def test_coded_names_that_cannot_be_repaired_fail(spark, name, why):
    with pytest.raises(Exception, match=why):
        coded(spark, "S01ESSAY_war.txt", name).collect()


# A18, A20 -------------------------------------------------------------------

def test_report_forms(spark, tmp_path):
    m = spark.createDataFrame([("test", "f1", 0.123456), ("test", "auc", 1.0)], "scope string, metric string, value double")
    io.write_report(m, str(tmp_path / "t"), form="text")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == ["test auc: 1.0000", "test f1: 0.1235"]
    io.write_report(m, str(tmp_path / "j"), digits=2)
    assert {r.value for r in spark.read.json(str(tmp_path / "j")).collect()} == {0.12, 1.0}


def test_label_tsv(spark, tmp_path):
    df = spark.createDataFrame([("a\tb\nc", 1), (None, 0), ("abcdef", 2)], "text string, label int")
    io.write_label_tsv(df, str(tmp_path / "x"), window=4)
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "x")).collect())
    assert lines == ["a b \t1", "abcd\t2", "c\t1", "ef\t2"]


# B11, C3 --------------------------------------------------------------------

def test_authors_who_lose_too_many_texts_stop_the_write(spark, tmp_path):
    rows = [(1, "x" * 60)] * 3 + [(1, "short")] * 9 + [(2, "y" * 50), (2, None)]
    ok = spark.createDataFrame(rows, "author_id long, text string")
    assert clean.refuse_short_text_losses(ok).count() == 4
    bad = ok.union(spark.createDataFrame([(1, "one more")], ok.schema)).repartition(4)
    with pytest.raises(Exception, match="author 1 loses 10 texts"):
        clean.refuse_short_text_losses(bad).write.parquet(str(tmp_path / "out"))
    assert not list((tmp_path / "out").glob("part-*"))
    assert clean.refuse_short_text_losses(ok.where("false")).count() == 0


def test_answers_to_unknown_ids_fail(spark):
    truth = spark.createDataFrame([("a", 1), ("b", 0)], "id string, label int")
    answers = spark.createDataFrame([("a", 0.9)], "id string, value double")
    assert {(r.id, r.label, r.value) for r in joins.align_answers(truth, answers).collect()} == {("a", 1, 0.9), ("b", 0, 0.5)}
    more = answers.union(spark.createDataFrame([("zz", 0.1)], answers.schema))
    with pytest.raises(Exception, match="unknown id: zz"):
        joins.align_answers(truth, more).select("id").collect()
    assert joins.align_answers(truth, more, refuse_extra=False).count() == 2
    assert [r.id for r in joins.extra_answers(truth, more).collect()] == ["zz"]


# G13, D10, K6 ---------------------------------------------------------------

def test_character_grid(spark):
    vocab = spark.createDataFrame([(encode.PAD, 0), (encode.UNK, 1), ("a", 2), ("b", 3), ("é", 4)], "term string, id int")
    rows = [(1, ["ab é", "zabba"]), (2, []), (3, ["a b a b", "b", "a"]), (4, ["a\U0001F642b"])]
    df = spark.createDataFrame(rows, "doc_id long, pieces array<string>")
    ids = {"a": 2, "b": 3, "é": 4}
    for r in encode.encode_chars(df, vocab, "doc_id", "pieces", 2, 3, 4).collect():
        pieces = dict(rows)[r.doc_id]
        grid = np.zeros((2, 3, 4), int)
        for i, p in enumerate(pieces[:2]):
            for j, t in enumerate(p.split(" ")[:3]):
                for k, c in enumerate(t[:4]):
                    grid[i, j, k] = ids.get(c, 1)
        assert np.array_equal(np.array(r.chars), grid)
        assert r.n_sents == len(pieces[:2]) and r.n_tokens == [min(3, len(p.split(" "))) for p in pieces[:2]]
        assert r.n_chars == [[min(4, len(t)) for t in p.split(" ")[:3]] for p in pieces[:2]]


CHUNKS = [(1, 10, 0, [1.0, 0.0]), (1, 10, 1, [3.0, 0.0]), (1, 11, 0, [0.0, 4.0]), (2, 12, 0, [5.0, 5.0]), (2, 13, 1, [1.0, 1.0])]


def chunk_table(spark):
    return spark.createDataFrame(CHUNKS, "author_id long, text_id long, pos long, embedding array<double>")


def test_author_vector_forms(spark):
    def got(form, **kw):
        return sorted((r.author_id, r.pos, r.embedding) for r in vectors.author_vectors(chunk_table(spark), form, **kw).collect())
    assert got("mean") == [(1, None, [1.0, 2.0]), (2, None, [3.0, 3.0])]
    assert got("chunk") == [(1, 0, [0.5, 2.0]), (1, 1, [3.0, 0.0]), (2, 0, [5.0, 5.0]), (2, 1, [1.0, 1.0])]
    assert got("first") == [(1, 0, [1.0, 0.0]), (1, 1, [3.0, 0.0]), (2, 0, [5.0, 5.0])]
    assert len(got("all")) == 5 and got("mean", max_texts=1) == [(1, None, [2.0, 0.0]), (2, None, [5.0, 5.0])]


def test_chunked_pair_scores_stop_at_the_shorter_text(spark):
    pairs = spark.createDataFrame([("p", 10, 11), ("q", 10, 10), ("r", 12, 13)], "pair_id string, text_id_a long, text_id_b long")
    got = {r.pair_id: r for r in vectors.chunked_pair_scores(pairs, chunk_table(spark)).collect()}
    assert (got["p"].n_chunks, got["q"].n_chunks, got["r"].n_chunks) == (1, 2, 0)
    assert got["p"].distance == pytest.approx(math.sqrt(17)) and got["p"].similarity == pytest.approx(1 / (1 + math.sqrt(17)))
    assert got["q"].similarity == 1.0 and got["r"].distance is None and got["r"].similarity is None


# D1 -------------------------------------------------------------------------

def test_grouped_texts_in_parts(spark):
    from quillspark.operators import stats
    rows = [("a", i, f"t{i}") for i in range(7)] + [("b", 1, "x"), ("b", 1, "x")]
    df = spark.createDataFrame(rows, "author string, post_id long, text string").repartition(4)
    got = stats.group_texts(df, part_size=3).collect()
    assert sorted((r.author, r.part, len(r.posts)) for r in got) == [("a", 0, 3), ("a", 1, 3), ("a", 2, 1), ("b", 0, 2)]
    assert [p.post_id for r in sorted(got, key=lambda r: r.part) if r.author == "a" for p in r.posts] == list(range(7))
    assert {r.author: len(r.posts) for r in stats.group_texts(df).collect()} == {"a": 7, "b": 2}


# H4, H8, H11 ----------------------------------------------------------------

def test_tag_and_parse_features(spark):
    from quillspark.operators import features
    df = spark.createDataFrame([(1, ["The", "cat", "saw", "the", "cat"], ["DT", "NN", "VB", "DT", "NN"]), (2, [], [])], "text_id long, tokens array<string>, tags array<string>")
    masked = {r.text_id: r.m for r in df.select("text_id", features.masked_stopwords("tokens", "tags", ["the"]).alias("m")).collect()}
    assert masked == {1: ["The", "NN", "VB", "the", "NN"], 2: []}
    r = features.pos_tag_stats(df, ["DT", "NN", "VB", "JJ"]).first()
    assert (r.DT_share, r.NN_share, r.NN_len, r.JJ_share) == (1 / 3, 1 / 3, 3.0, 0.0)
    deps = spark.createDataFrame([(1, 1, 2, "det"), (1, 2, 3, "nsubj"), (1, 3, 0, "ROOT"), (1, 4, 5, "det"), (1, 5, 3, "dobj"), (2, 1, 0, "ROOT")],
                                 "text_id long, tok int, head int, dep string")
    got = {(r.text_id, r.path): r.n for r in features.dependency_ngrams(deps, 3).collect()}
    assert got == {(1, "ROOT"): 1, (1, "ROOT_nsubj"): 1, (1, "ROOT_dobj"): 1, (1, "ROOT_nsubj_det"): 1, (1, "ROOT_dobj_det"): 1, (2, "ROOT"): 1}
