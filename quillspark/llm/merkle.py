"""Operator 10: Merkle fixity audit of archive replicas.

Records of an archive have a fixed order and byte offsets. A leaf hashes one
record with the offset range it fills; a node hashes up to ``fanout`` children,
so it stands for an ordered range of offsets. Two replicas are compared at the
root; where hashes differ only the children of differing nodes are joined and
compared, level by level, down to the damaged records. Equal replicas cost one
comparison and return no row.

The work is DataFrame functions only. Numbering uses a range exchange of narrow
rows (digests, never record bytes), so ties and a third of all rows sharing one
id spread over tasks; groups have at most ``fanout`` rows; differing nodes are
joined by key, never collected.

Cases: a null record is empty text; null ids sort first; repeated rows are
records of their own; a record that one replica lacks is reported as missing
(or extra), one with another length as resized, else as changed. Empty tables
give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import cut_lineage

FANOUT = 64
MIN_DEPTH = 5


def warc_record(record_id: Column, uri: Column, payload: Column) -> Column:
    """One WARC response record as text."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(uri, F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def number_records(df: DataFrame, order: Sequence[str], size: str) -> DataFrame:
    """Adds ``ordinal`` (0-based, in ``order``) and ``record_offset`` (bytes before the record). Rows should be narrow."""
    keys = [F.col(c) for c in order]
    ranged = (df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "__tie")
              .sortWithinPartitions(*keys, "__tie").drop("__tie"))
    rows = cut_lineage(ranged.withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = (rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.sum(size).alias("__b"))
             .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"),
                     F.coalesce(F.sum("__b").over(before), F.lit(0)).alias("__b0")))
    inside = Window.partitionBy("__part").orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("__b", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    place = F.col("__row") - F.shiftleft(F.col("__part").cast("bigint"), 33)
    return (local.join(F.broadcast(parts), "__part")
            .withColumn("ordinal", F.col("__n0") + place).withColumn("record_offset", F.col("__b0") + F.col("__b"))
            .drop("__part", "__row", "__n0", "__b0", "__b"))


def leaves(records: DataFrame, digest: str, size: str) -> DataFrame:
    """Leaf level of a replica: node (the ordinal), range of offsets, hash over the range and the record's digest."""
    end = F.col("record_offset") + F.col(size)
    return records.select(F.col("ordinal").alias("node"), F.col("record_offset").alias("lo"), end.alias("hi"),
                          F.sha2(F.concat_ws(":", "record_offset", size, digest), 256).alias("hash"))


def parents(level: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The next level up: one node for ``fanout`` places, hashed over its children in order."""
    kids = F.sort_array(F.collect_list(F.struct("node", "hash")))
    return (level.groupBy(F.expr(f"node div {int(fanout)}").alias("parent"))
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), kids.alias("kids"))
            .select(F.col("parent").alias("node"), "lo", "hi", F.sha2(F.concat_ws("", "kids.hash"), 256).alias("hash")))


def build_tree(leaf_level: DataFrame, depth: int, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels from the leaves up to the root (``depth`` levels above the leaves)."""
    levels = [leaf_level]
    for _ in range(depth):
        # each level is 1/fanout of the one below; writing it keeps the one above from rebuilding it
        levels.append(cut_lineage(parents(levels[-1], fanout)))
    return levels


def depth_for(n: int, fanout: int = FANOUT, least: int = MIN_DEPTH) -> int:
    depth = least
    while fanout ** depth < n:
        depth += 1
    return depth


def audit(tree_a: list[DataFrame], tree_b: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Differing leaves: ordinal, lo_a, hi_a, hash_a, lo_b, hi_b, hash_b, root_a, root_b."""
    wrong = None
    for level_a, level_b in zip(reversed(tree_a), reversed(tree_b)):
        a, b = (x.select("node", *[F.col(c).alias(f"{c}_{s}") for c in ("lo", "hi", "hash")]) for x, s in ((level_a, "a"), (level_b, "b")))
        if wrong is not None:
            # descend: only children of nodes that differ take part
            up = wrong.select(F.col("node").alias("parent"), "root_a", "root_b")
            a, b = (x.withColumn("parent", F.expr(f"node div {int(fanout)}")).join(up, "parent") for x in (a, b))
            both = a.join(b, ["parent", "node", "root_a", "root_b"], "full")
        else:
            both = a.join(b, "node", "full").withColumns({"root_a": F.coalesce("hash_a", F.lit("")), "root_b": F.coalesce("hash_b", F.lit(""))})
        # written: both sides of the next level read it, and a plan that repeats it would double with every level
        wrong = cut_lineage(both.where(~F.col("hash_a").eqNullSafe(F.col("hash_b"))))
    return wrong.drop("parent").withColumnRenamed("node", "ordinal")


def audit_replicas(records: DataFrame, record_id: str, record: Column, replica: Column, fanout: int = FANOUT) -> DataFrame:
    """Audits ``replica`` (null: lost) against ``record`` of the same rows, in order of ``record_id``.

    Returns a row per damaged record: record_id, ordinal, record_offset, length,
    status (changed, resized, missing), digest_a, digest_b, root_a, root_b.
    """
    seen = records.select(
        F.col(record_id).alias("record_id"),
        F.sha2(record, 256).alias("digest_a"), F.octet_length(record).cast("bigint").alias("size_a"),
        F.sha2(replica, 256).alias("digest_b"), F.octet_length(replica).cast("bigint").alias("size_b"))
    placed = cut_lineage(number_records(seen, ["record_id", "digest_a"], "size_a"))
    depth = depth_for(placed.count(), fanout)
    tree_a = build_tree(leaves(placed, "digest_a", "size_a"), depth, fanout)
    tree_b = build_tree(leaves(placed.where(F.col("digest_b").isNotNull()), "digest_b", "size_b"), depth, fanout)
    found = audit(tree_a, tree_b, fanout).select("ordinal", "root_a", "root_b")
    status = (F.when(F.col("digest_b").isNull(), "missing").when(F.col("size_a") != F.col("size_b"), "resized").otherwise("changed"))
    return placed.join(found, "ordinal").select(
        "record_id", "ordinal", "record_offset", F.col("size_a").alias("length"), status.alias("status"),
        "digest_a", "digest_b", "root_a", "root_b")
