"""Readers and writers.

Every reader returns a DataFrame with an explicit schema (no inference on the
data path); file-level metadata comes from ``_metadata.file_path``. Writers
use Spark's writers (parquet by default; CSV / JSON where the reference's
formats are needed) and never collect to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# CSV headers of the reference's AA / AV files.
AA_HEADER = ("author_id", "text")
AV_HEADER = ("same/diff auth", "text1", "text2")
PAIR_SEPARATOR_RE = r"\$\$\$"


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
            .option("mode", "PERMISSIVE").csv(path))


def read_aa(spark: SparkSession, path: str) -> DataFrame:
    """A1: ``author_id,text`` CSV (quoted, multi-line) -> (author_id LONG, text)."""
    return _csv(spark, path, "author_id long, text string")


def read_av(spark: SparkSession, path: str) -> DataFrame:
    """A2: ``same/diff auth,text1,text2`` CSV -> (label INT, text0, text1)."""
    d = _csv(spark, path, "label int, text0 string, text1 string")
    return d


def write_aa(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A5: AA CSV with the fixed header."""
    df.select(F.col("author_id").cast("long").alias(AA_HEADER[0]), F.col("text").alias(AA_HEADER[1])) \
        .write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_av(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A5: AV CSV with the fixed header."""
    df.select(F.col("label").cast("int").alias(AV_HEADER[0]), F.col("text0").alias(AV_HEADER[1]),
              F.col("text1").alias(AV_HEADER[2])).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def flatten_pairs(pairs: DataFrame, split: str | None = None) -> DataFrame:
    """A3: nested pair set (post_a, post_b structs, label) -> (label INT, text0, text1)."""
    p = pairs if split is None else pairs.filter(F.col("split") == split)
    return p.select(F.col("label").cast("int").alias("label"), F.col("post_a.text").alias("text0"), F.col("post_b.text").alias("text1"))


def read_pan_pairs(spark: SparkSession, pairs_path: str, truth_path: str) -> DataFrame:
    """JSONL pairs {id, pair: [t0, t1]} joined to truth {id, authors: [a0, a1]} by id."""
    p = spark.read.schema("id string, pair array<string>").json(pairs_path)
    t = spark.read.schema("id string, authors array<string>, same boolean").json(truth_path)
    j = p.join(t, "id")
    return j.select("id", F.col("authors")[0].alias("auth0"), F.col("authors")[1].alias("auth1"),
                    F.col("pair")[0].alias("text0"), F.col("pair")[1].alias("text1"))


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Truth / answer JSONL: {id, value} or {id, same} -> (id, value DOUBLE)."""
    d = spark.read.schema("id string, value double, same boolean").json(path)
    return d.select("id", F.coalesce(F.col("value"), F.col("same").cast("double")).alias("value"))


def merge_pan_files(spark: SparkSession, pairs: Sequence[str], truths: Sequence[str]) -> DataFrame:
    """Concatenate pair sets (every pair row stays); the first file's truth wins for a repeated id."""
    ps = [spark.read.schema("id string, pair array<string>").json(p).withColumn("__src", F.lit(i)) for i, p in enumerate(pairs)]
    ts = [spark.read.schema("id string, authors array<string>").json(t).withColumn("__src", F.lit(i)) for i, t in enumerate(truths)]
    u = ps[0]
    for p in ps[1:]:
        u = u.unionByName(p)
    tu = ts[0]
    for t in ts[1:]:
        tu = tu.unionByName(t)
    first_truth = tu.groupBy("id").agg(F.min_by("authors", "__src").alias("authors"))
    return u.drop("__src").join(first_truth, "id")


def read_tweets(spark: SparkSession, path_glob: str) -> DataFrame:
    """Every JSON file holds an array of tweet objects (type, text, user)."""
    return spark.read.option("multiLine", True).schema("type string, text string, user string").json(path_glob)


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """A7."""
    return spark.read.parquet(path)


def write_posts(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A7."""
    df.write.mode(mode).parquet(path)


def read_author_lines(spark: SparkSession, path: str, num_authors: int | None = None) -> DataFrame:
    """JSONL {author_id, syms: [texts]} -> (author_idx, author_id, text_idx, text).

    Authors are numbered by their first line (file order via the row's file
    position); with ``num_authors`` only the first N authors are kept."""
    from quillspark.session import cut_lineage
    d = spark.read.schema("author_id string, syms array<string>").json(path).select(
        "*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("mid")).alias("__line"))
    d = cut_lineage(d)  # fixes the row ids that stand for the place in a split
    firsts = d.groupBy("author_id").agg(F.min("__line").alias("__first"))
    from quillspark.operators.ranking import global_rank
    ranked = global_rank(firsts, ["__first", "author_id"], "__r").select("author_id", (F.col("__r") - 1).alias("author_idx"))
    if num_authors is not None:
        ranked = ranked.filter(F.col("author_idx") < num_authors)
    ex = d.join(ranked, "author_id").select("author_idx", "author_id", "__line", F.posexplode("syms").alias("text_idx", "text"))
    return ex.drop("__line")


def read_reviews(spark: SparkSession, path: str, min_chars: int = 50, max_chars: int | None = None) -> DataFrame:
    """Review JSONL files; text = summary (or '') + ' ' + reviewText; rows
    without reviewText dropped; topic = file name without extension."""
    # the length rule comes before NUL characters go
    d = spark.read.schema("reviewerID string, summary string, reviewText string").json(path).select(
        "*", F.col("_metadata.file_name").alias("__file"))
    d = d.filter(F.col("reviewText").isNotNull())
    text = F.concat(F.coalesce(F.col("summary"), F.lit("")), F.lit(" "), F.col("reviewText"))
    d = d.filter(F.length(text) >= min_chars)
    if max_chars is not None:
        text = F.substring(text, 1, max_chars)
    return d.select(F.col("reviewerID").alias("author"), F.translate(text, "\u0000", "").alias("text"),
                    F.regexp_extract("__file", r"^(.*?)(\.[^.]*)?$", 1).alias("topic"))


def decode_text(content: Column, encoding: str = "UTF-8") -> Column:
    """Bytes to text. Spark decodes ISO-8859-1 and the UTF encodings; cp1252 differs from ISO-8859-1 in 27 signs, which are translated."""
    if encoding.lower().replace("windows-", "cp") != "cp1252":
        return F.decode(content, encoding)
    signs = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
    return F.translate(F.decode(content, "ISO-8859-1"), "".join(signs), "".join(signs.values()))


def read_text_tree(spark: SparkSession, path_glob: str, encoding: str = "UTF-8", author_level: int = -2,
                   per_line: bool = False, category_level: int | None = None) -> DataFrame:
    """A10: one text per file (or per line); author, and category if a level is given, are directory names of the path
    (-2 = parent directory). Lines come as bytes from Spark's splittable reader and are decoded one by one in ``encoding``
    (of one byte a character, or UTF-8): (author[, category], text, path)."""
    if per_line:
        d = spark.read.text(path_glob).select(F.col("value").cast("binary").alias("content"), F.col("_metadata.file_path").alias("path"))
    else:
        d = spark.read.format("binaryFile").load(path_glob)
    parts = F.split(F.col("path"), "/")
    names = [F.element_at(parts, author_level).alias("author")]
    if category_level is not None:
        names.append(F.element_at(parts, category_level).alias("category"))
    return d.select(*names, decode_text(F.col("content"), encoding).alias("text"), "path")


def parse_coded_filenames(df: DataFrame, pattern: str, names: Sequence[str], path_col: str = "path",
                          codes: Mapping[str, Sequence[str]] | None = None, max_edits: int = 1) -> DataFrame:
    """Fields out of a file name by regex; a name that does not match fails the job.

    ``codes`` names the valid values of a field. A value that is none of them is repaired to the nearest one by edit distance;
    more than ``max_edits`` edits, or two codes equally near, fail the job with the name."""
    base = F.element_at(F.split(F.col(path_col), "/"), -1)

    def refuse(why):
        return F.raise_error(F.concat(F.lit(f"{why}: "), F.col("__base")))

    out = df.withColumn("__base", base).withColumn("__base", F.when(F.col("__base").rlike(pattern), F.col("__base")).otherwise(refuse("bad file name")))
    for i, n in enumerate(names, start=1):
        value = F.regexp_extract("__base", pattern, i)
        valid = list((codes or {}).get(n, ()))
        if valid:
            out = out.withColumn("__v", value).withColumn("__near", F.array_sort(F.array(*[
                F.struct(F.levenshtein(F.col("__v"), F.lit(c)).alias("edits"), F.lit(c).alias("code")) for c in valid])))
            first = F.col("__near")[0]
            tie = (F.col("__near")[1]["edits"] == first["edits"]) if len(valid) > 1 else F.lit(False)
            out = out.withColumn(n, F.when(first["edits"] == 0, first["code"]).when(first["edits"] > max_edits, refuse(f"unknown {n}"))
                                 .when(tie, refuse(f"ambiguous {n}")).otherwise(first["code"])).drop("__v", "__near")
        else:
            out = out.withColumn(n, value)
    return out.drop("__base")


def read_imdb62(spark: SparkSession, path: str) -> DataFrame:
    """6-field TSV (reviewId, userId, itemId, rating, title, content);
    text = title + ' ' + content; duplicates per author dropped."""
    lines = spark.read.text(path)
    parts = F.split(F.col("value"), "\t")
    d = lines.select(F.assert_true(F.size(parts) == 6, F.lit("imdb62 line without 6 fields")).alias("__ok"), parts.alias("p"))
    d = d.select(F.col("p")[1].alias("author"), F.concat(F.col("p")[4], F.lit(" "), F.col("p")[5]).alias("text"))
    return d.dropDuplicates(["author", "text"])


def read_blog_posts(spark: SparkSession, path_glob: str) -> DataFrame:
    """Posts between <post> and </post> lines; inner lines stripped and
    joined by one space; date = latest <date> before the post; metadata
    (id.gender.age.topic.sign) from the file name."""
    d = spark.read.text(path_glob, wholetext=True).select(F.col("value").alias("doc"), F.col("_metadata.file_name").alias("file"))
    pat = r"(?s)<date>([^<]*)</date>\s*<post>(.*?)</post>"
    ex = d.select("file", F.posexplode(F.regexp_extract_all("doc", F.lit(pat), 0)).alias("post_idx", "m"))
    body = F.regexp_extract("m", pat, 2)
    lines = F.filter(F.transform(F.split(body, "\n"), lambda x: F.trim(F.translate(x, "\u0000", ""))), lambda x: x != "")
    meta = F.split("file", r"\.")
    return ex.select(F.element_at(meta, 1).alias("blog_id"), F.element_at(meta, 2).alias("gender"),
                     F.element_at(meta, 3).alias("age"), F.element_at(meta, 4).alias("topic"),
                     F.element_at(meta, 5).alias("sign"), F.col("post_idx").cast("bigint").alias("post_idx"),
                     F.trim(F.regexp_extract("m", pat, 1)).alias("date"), F.array_join(lines, " ").alias("text"))


def read_joined_pairs(df: DataFrame, col: str = "review") -> DataFrame:
    """Two texts in one column separated by '$$$'; with more parts the first and last are kept."""
    parts = F.split(F.col(col), PAIR_SEPARATOR_RE)
    return df.withColumn("text0", F.element_at(parts, 1)).withColumn("text1", F.element_at(parts, -1))


def write_pair_sets(pairs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One directory per pair kind and split."""
    pairs.write.mode(mode).partitionBy("kind", "split").parquet(path)


def write_scores(scores: DataFrame, path: str, mode: str = "append") -> None:
    """Long score table partitioned by (dataset, model)."""
    scores.withColumn("written_at", F.current_timestamp()).write.mode(mode).partitionBy("dataset", "model").parquet(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Keep the rows of the last write per (dataset, model)."""
    d = spark.read.parquet(path)
    last = d.groupBy("dataset", "model").agg(F.max("written_at").alias("written_at"))
    return d.join(last, ["dataset", "model", "written_at"], "left_semi")


def parse_score_lists(df: DataFrame, col: str, out: str, element: str = "double") -> DataFrame:
    """List columns stored as text ('[0.1, 0.2]'): JSON first, numbers by regex as fallback."""
    js = F.from_json(F.col(col), f"array<{element}>")
    rx = F.transform(F.regexp_extract_all(F.col(col), F.lit(r"-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"), 0), lambda x: x.cast(element))
    return df.withColumn(out, F.coalesce(js, rx))


def write_report(metrics: DataFrame, path: str, mode: str = "overwrite", form: str = "json", digits: int | None = None) -> None:
    """Metrics as JSON lines, or as text lines ``scope metric: value`` (``form='text'``); with ``digits`` numbers are
    written with so many decimals."""
    doubles = [f.name for f in metrics.schema if f.dataType.typeName() in ("double", "float")]
    if digits is not None and form == "json":
        metrics = metrics.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in metrics.columns])
    if form == "json":
        metrics.write.mode(mode).json(path)
        return
    if form != "text":
        raise ValueError(f"unknown form {form}")
    names = [c for c in metrics.columns if c not in doubles]
    number = [F.format_string(f"%.{4 if digits is None else digits}f", F.col(c)) for c in doubles]
    line = F.concat(F.concat_ws(" ", *[F.col(c).cast("string") for c in names]), F.lit(": "), F.concat_ws(" ", *number))
    metrics.select(line.alias("value")).write.mode(mode).text(path)


def to_label_tsv(df: DataFrame, text_col: str = "text", label_col: str = "label", window: int | None = None) -> DataFrame:
    """(text, label) with tabs / newlines replaced by spaces; long texts cut
    into windows of ``window`` chars (one row per window)."""
    clean = F.translate(F.col(text_col), "\t\n\r", "   ")
    d = df.select(clean.alias("text"), F.col(label_col).alias("label"))
    if window is None:
        return d
    n = F.ceil(F.length("text") / F.lit(window)).cast("int")
    ex = d.select("label", "text", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))).alias("w"))
    return ex.select(F.col("text").substr(F.col("w") * window + 1, F.lit(window)).alias("text"), "label")


def write_label_tsv(df: DataFrame, path: str, text_col: str = "text", label_col: str = "label", window: int | None = None, mode: str = "errorifexists") -> None:
    """``text TAB label`` lines without header or quotes (tabs and line ends inside texts are spaces by then)."""
    rows = to_label_tsv(df, text_col, label_col, window)
    rows.select(F.concat_ws("\t", F.coalesce("text", F.lit("")), F.col("label").cast("string")).alias("value")).write.mode(mode).text(path)


def write_counts(counts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """(kind, term, n) parquet."""
    counts.write.mode(mode).partitionBy("kind").parquet(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """A21."""
    return spark.read.parquet(path)


def save_counts_model(model: DataFrame, path: str, model_col: str = "author_id", buckets: int = 64,
                      mode: str = "overwrite") -> None:
    """Context-count models, one partition directory per model-id bucket."""
    model.withColumn("bucket", F.pmod(F.xxhash64(model_col), F.lit(buckets))).write.mode(mode).partitionBy("bucket").parquet(path)


def load_counts_model(spark: SparkSession, path: str) -> DataFrame:
    """A24."""
    return spark.read.parquet(path).drop("bucket")


def write_id_map(ids: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Id -> author name per split as JSON lines."""
    ids.write.mode(mode).json(path)


def cross_corpus(aa: DataFrame, unit_col: str, shares=(0.6, 0.2, 0.2), seed: int = 42) -> DataFrame:
    """A19, cross-topic or cross-genre: whole topics (genres) in one part; texts of authors without a training text go, as nobody
    could attribute them, and authors get dense labels in first-seen order of the training part."""
    from quillspark.operators import sets, splits
    s = splits.split_whole(aa, unit_col, shares, seed=seed)
    labels = sets.label_map(s.filter(F.col("split") == "train"), "author_id", "text_id")
    j = s.join(labels, s["author_id"] == labels["old"])
    return j.select(*[F.col("new").cast("bigint").alias("author_id") if c == "author_id" else s[c] for c in s.columns])


def materialize_corpus(aa: DataFrame, path: str, seed: int = 42, shares=(0.6, 0.2, 0.2), form: str = "stratified", unit_col: str | None = None) -> DataFrame:
    """An AA split and per-text AV pairs for every part, written as parquet under ``path`` with corpus stats (refuses a
    target that exists). Returns the stats table. ``aa``: (author_id, text_id, text, ...).

    * ``stratified``: every author has the same shares in every part;
    * ``cross``: topics or genres (``unit_col``) whole in one part (see ``cross_corpus``);
    * ``unseen``: authors whole in one part, labels as they are (verification of authors never seen in training)."""
    from quillspark.operators import pairs, splits, stats
    from quillspark.session import cut_lineage
    ids = aa.drop("text")
    if form == "stratified":
        s = splits.split_stratified(ids, "author_id", "text_id", shares, seed=seed)
    elif form == "cross":
        s = cross_corpus(ids, unit_col, shares, seed)
    elif form == "unseen":
        s = splits.split_whole(ids, "author_id", shares, seed=seed)
    else:
        raise ValueError(f"unknown form {form}")
    s = cut_lineage(s)  # ids only; texts are joined once a table is written
    texts = aa.select("text_id", "text")
    full = s.join(texts, "text_id")
    full.write.mode("errorifexists").partitionBy("split").parquet(f"{path}/aa")
    for name in splits.SPLIT_NAMES:
        av = pairs.pairs_per_text(s.filter(F.col("split") == name), "author_id", "text_id", seed=seed)
        av = (av.join(texts.select(F.col("text_id").alias("text_id_a"), F.col("text").alias("text0")), "text_id_a")
              .join(texts.select(F.col("text_id").alias("text_id_b"), F.col("text").alias("text1")), "text_id_b"))
        av.write.mode("errorifexists").parquet(f"{path}/av/{name}")
    st = stats.summarize_corpus(full.withColumnRenamed("author_id", "author"), "split", "author", "text")
    st.write.mode("errorifexists").json(f"{path}/stats")
    return aa.sparkSession.read.json(f"{path}/stats")


def _joined_records(lines: DataFrame) -> DataFrame:
    """Records broken over several lines: (file, block, mid, f0..f3).

    A run is a stretch of adjacent malformed lines of a file. Fields longer than one character are numbered
    through the run; the lines that hold fields 4j .. 4j+3 are record j if they hold exactly those, else they
    are dropped. Lines next to each other across a split count as adjacent. Windows see malformed lines only."""
    ends = lines.groupBy("file", "block").agg(F.min("mid").alias("__first"), F.max("mid").alias("__last"))
    fields = F.filter(F.transform("parts", lambda p: F.trim(p)), lambda p: F.length(p) > 1)
    bad = lines.filter(F.size("parts") != 4).select("file", "block", "mid", fields.alias("fields")).join(ends, ["file", "block"])
    in_file = Window.partitionBy("file").orderBy("block", "mid")
    touches = (F.when(F.lag("block").over(in_file) == F.col("block"), F.lag("mid").over(in_file) + 1 == F.col("mid"))
               .otherwise((F.lag("mid").over(in_file) == F.lag("__last").over(in_file)) & (F.col("mid") == F.col("__first"))))
    bad = bad.withColumn("__new", F.when(touches, 0).otherwise(1))
    bad = bad.withColumn("__run", F.sum("__new").over(in_file))
    before = F.sum(F.size("fields")).over(Window.partitionBy("file", "__run").orderBy("block", "mid")) - F.size("fields")
    rec = (bad.withColumn("__rec", F.floor(before / 4)).groupBy("file", "__run", "__rec")
           .agg(F.sort_array(F.collect_list(F.struct("block", "mid", "fields"))).alias("m")))
    rec = rec.select("file", F.element_at("m", -1).alias("last"), F.flatten("m.fields").alias("f")).filter(F.size("f") == 4)
    return rec.select("file", "last.block", "last.mid", *[F.col("f")[i].alias(f"f{i}") for i in range(4)])


def read_tweet_tsv(spark: SparkSession, path: str, label_map: DataFrame | None = None) -> DataFrame:
    """``user_id \\t tweet_id \\t tweet \\t created`` lines; NUL characters
    removed; records broken over several lines re-assembled per file; rows whose
    user id is not an integer dropped; exact duplicate tweets dropped (first
    occurrence in file order kept); users mapped to labels 0.. in first-seen
    order, or through ``label_map`` (user_id, label) where unmapped users are
    dropped. Tabs only separate fields (quotes are not interpreted).

    Well-formed lines (the bulk) are parsed in parallel; only malformed lines
    are ordered, by the split offset and the row position inside the split."""
    lines = spark.read.text(path).select(
        F.split(F.translate("value", "\u0000", ""), "\t").alias("parts"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mid"))
    from quillspark.session import cut_lineage
    lines = cut_lineage(lines)  # fixes the row ids used as file order below
    good = lines.filter(F.size("parts") == 4).select(
        "file", "block", "mid", *[F.col("parts")[i].alias(f"f{i}") for i in range(4)])
    rec = good.unionByName(_joined_records(lines)).withColumn("user_id", F.expr("try_cast(f0 AS BIGINT)")).filter(F.col("user_id").isNotNull())
    order = F.struct("file", "block", "mid")
    first = rec.groupBy(F.xxhash64("f2").alias("__h"), F.col("f2")).agg(F.min(order).alias("__o"))
    rec = rec.withColumn("__o", order).join(first.select("f2", "__o"), ["f2", "__o"], "left_semi")
    rec = rec.select("user_id", F.col("f1").alias("tweet_id"), F.col("f2").alias("text"), F.col("f3").alias("created"), "__o")
    if label_map is None:
        from quillspark.operators.ranking import dense_ids
        ids = dense_ids(rec, ["user_id"], ["__o"], id_col="label")
    else:
        ids = label_map.select("user_id", "label")
    return rec.join(ids, "user_id").drop("__o")
