"""Operator 7: benchmark decontamination with SimHash windows (DataFrame functions only).

Items and documents become sequences of hashed five-word shingles (lower case; a
text of fewer words is one shingle). A window of a document is as long as an
item. A window that is similar to an item shares a shingle with it, so windows
are placed by shared shingles: for each diagonal (place in the document less
place in the item) the window on the diagonal, the one that starts at its first
shared shingle and the one that ends at its last; between such places the number
of shared shingles changes linearly. Equal windows are fingerprinted once.

A 64-bit SimHash of the window's weighted shingles is compared with those of
items of that length: fingerprints are cut into RADIUS + 1 bit blocks, so two
within RADIUS bits agree in a block and meet in an equi-join on (length, prefix
shingle, block, bits). At weighted similarity 0.8 the expected distance is 10
bits, the radius 20. Pairs within the radius are verified with the exact weighted
Jaccard similarity (sum of smaller counts over sum of larger counts) >= 0.8.

Blocks of three bits alone would let nearly every window meet nearly every item
of its length. The prefix shingle splits them: of the n shingles of a side in
hash order, repeats counted, a pair at similarity t or more shares at least t * n,
so the first n - ceil(t * n) + 1 of both sides have one in common. No pair at
the threshold is lost by it, and unrelated texts share none.

Item shingles are broadcast only up to BROADCAST_ROWS, else joined by shuffle;
texts are read again only for documents with a shared shingle.

Cases: null and empty texts and items never match; a document shorter than an
item is its own window; items with equal texts all match; rows that share id and
text are one document, rows that share an id only are matched each and reported
together; null ids are one document; with an empty table on either side nothing
is contaminated; other columns are ignored. Texts of any length are used whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.session import cut_lineage

WORDS = 5
THRESHOLD = 0.8
RADIUS = 20
BROADCAST_ROWS = 1_000_000
BROADCAST_IDS = 500_000


def shingle_array(words: str) -> Column:
    """Hashed shingles of an array<string> column, in order; one for fewer than WORDS words, none for none."""
    w = F.col(words)
    n = F.size(w)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(n - (WORDS - 1), F.lit(1))),
                        lambda i: F.xxhash64(*[F.try_element_at(w, i + k) for k in range(WORDS)]))
    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(grams)


def with_shingles(df: DataFrame, text: str) -> DataFrame:
    """Adds ``h`` (array<long>), drops the text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    return df.withColumn("__w", words).withColumn("h", shingle_array("__w")).drop("__w", text)


def fingerprint(h: str) -> Column:
    """64-bit SimHash: a bit is set where more than half of the (repeated) shingles have it. Two 32-bit counters a sum."""
    lanes = F.lit(0x0000000100000001)
    half = F.size(h)
    bits = None

    def count(b: int) -> Column:
        return F.aggregate(h, F.lit(0).cast("bigint"), lambda acc, x: acc + F.shiftrightunsigned(x, b).bitwiseAND(lanes))

    for b in range(32):
        ones = count(b)
        low = F.when(2 * ones.bitwiseAND(F.lit(0xFFFFFFFF)) > half, F.lit(1 << b)).otherwise(F.lit(0).cast("bigint"))
        top = F.lit((1 << (32 + b)) - (1 << 64 if b == 31 else 0))
        high = F.when(2 * F.shiftrightunsigned(ones, 32) > half, top).otherwise(F.lit(0).cast("bigint"))
        both = low.bitwiseOR(high)
        bits = both if bits is None else bits.bitwiseOR(both)
    return bits


def block_keys(fp: str, radius: int = RADIUS) -> Column:
    """array<struct<block, bits>>: radius + 1 blocks that cover the 64 bits; two fingerprints within the radius agree in one."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(*[F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(F.col(fp), a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"))
                     for k, (a, b) in enumerate(zip(edges, edges[1:]))])


def prefix_shingles(h: str, threshold: float = THRESHOLD) -> Column:
    """The first shingles in hash order, of which two arrays of similarity ``threshold`` or more share one."""
    n = F.size(h)
    least = F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int")
    return F.array_distinct(F.slice(F.array_sort(h), F.lit(1), F.greatest(n - least + 1, F.lit(1))))


def weighted_jaccard(a: str, b: str) -> Column:
    """Sum of smaller counts over sum of larger counts of two shingle arrays."""
    def times(arr, x):
        return F.size(F.filter(arr, lambda y: y == x))

    shared = F.array_intersect(a, b)
    once = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    # where one side has no repeats every shared shingle counts once
    least = F.when(once, F.size(shared)).otherwise(
        F.aggregate(shared, F.lit(0), lambda acc, x: acc + F.least(times(F.col(a), x), times(F.col(b), x))))
    return F.when(F.size(shared) > 0, least / (F.size(a) + F.size(b) - least)).otherwise(F.lit(0.0))


def _maybe_broadcast(df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= limit else df


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
            threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """(id, stamp, item, start, similarity) of document windows similar to an item; stamp is the text's xxhash64, start is in shingles."""
    # written before use: a filter or a second reference on top would evaluate the words once for each shingle
    item = cut_lineage(with_shingles(items.select(F.col(item_id).alias("item"), item_text), item_text)).where(F.size("h") > 0)
    item = cut_lineage(item.withColumn("n", F.size("h")).withColumn("fp", fingerprint("h")))
    places = cut_lineage(item.select("item", "n", F.posexplode("h").alias("k", "x")).groupBy("x", "n", "k").agg(F.min("item").alias("any")).drop("any"))
    known = _maybe_broadcast(places.select("x").distinct(), BROADCAST_ROWS)
    stamp = F.xxhash64(text).alias("stamp")
    # outer: a plain explode adds a filter on the array's size below, which evaluates the array twice
    seen = (with_shingles(docs.select(F.col(id_col).alias("id"), stamp, text), text).select("id", "stamp", F.posexplode_outer("h").alias("pos", "x"))
            .join(known, "x"))
    diagonal = F.col("pos") - F.col("k")
    runs = cut_lineage(seen.join(_maybe_broadcast(places, BROADCAST_ROWS), "x").groupBy("id", "stamp", "n", diagonal.alias("diagonal"))
                       .agg(F.min("pos").alias("first"), F.max("pos").alias("last")))
    ids = _maybe_broadcast(runs.select(F.col("id").alias("__id")).distinct(), BROADCAST_IDS)
    held = docs.select(F.col(id_col).alias("id"), stamp, text).join(ids, F.col("id").eqNullSafe(F.col("__id")), "left_semi")
    arrays = with_shingles(held, text).dropDuplicates(["id", "stamp"])
    starts = F.explode(F.array_distinct(F.array("diagonal", "first", F.col("last") - F.col("n") + 1)))
    windows = runs.select("id", "stamp", "n", starts.alias("s")).distinct()
    a, b = windows.alias("a"), arrays.alias("b")
    start = F.greatest(F.lit(0), F.least(F.col("s"), F.size("h") - F.col("n")))
    cut = cut_lineage(
        a.join(b, F.col("a.id").eqNullSafe(F.col("b.id")) & F.col("a.stamp").eqNullSafe(F.col("b.stamp")))
        .select("a.id", "a.stamp", "n", start.alias("start"), "h").select("id", "stamp", "n", "start", F.slice("h", F.col("start") + 1, F.col("n")).alias("w"))
        .select("id", "stamp", "n", "start", "w", F.xxhash64("w").alias("w1"), F.xxhash64(F.lit(1), F.reverse("w")).alias("w2")).distinct())
    distinct = cut_lineage(cut.groupBy("n", "w1", "w2").agg(F.first("w").alias("w")).withColumn("fp", fingerprint("w")))
    probe = distinct.select("n", "w1", "w2", "fp", F.explode(prefix_shingles("w", threshold)).alias("x"))
    probe = probe.select("n", "x", "w1", "w2", "fp", F.explode(block_keys("fp", radius)).alias("key")).select("n", "x", "w1", "w2", "fp", "key.*")
    index = item.select("item", "n", F.col("fp").alias("ifp"), F.explode(prefix_shingles("h", threshold)).alias("x"))
    index = index.select("item", "n", "x", "ifp", F.explode(block_keys("ifp", radius)).alias("key")).select("item", "n", "x", "ifp", "key.*")
    near = (probe.join(index, ["n", "x", "block", "bits"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= radius)
            .select("n", "w1", "w2", "item").distinct())
    checked = (near.join(distinct.drop("fp"), ["n", "w1", "w2"]).join(item.select("item", "n", F.col("h").alias("ih")), ["item", "n"])
               .select("n", "w1", "w2", "item", weighted_jaccard("w", "ih").alias("similarity")).where(F.col("similarity") >= threshold)).distinct()
    return cut.drop("w").join(checked, ["n", "w1", "w2"]).select("id", "stamp", "item", "start", "similarity")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: contaminated, items (ids of the matched items in order), similarity (the best, 0 without match)."""
    found = matches(docs, items, id_col, text, item_id, item_text, threshold)
    per_doc = found.groupBy("id").agg(F.sort_array(F.collect_set("item")).alias("items"), F.max("similarity").alias("similarity"))
    kind = items.schema[item_id].dataType.simpleString()
    return (docs.select(id_col).distinct().join(per_doc, F.col(id_col).eqNullSafe(F.col("id")), "left")
            .select(id_col, F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.array().cast(f"array<{kind}>")).alias("items"),
                    F.coalesce("similarity", F.lit(0.0)).alias("similarity")))
