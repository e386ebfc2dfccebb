"""Ranks and ordinals without single-partition windows.

``Window.orderBy`` with no partition pulls every row into one task, and a
window partitioned by a hot key puts that key in one task. The helpers here
range-partition on the full sort key (a hot group spans many partitions),
number rows inside each partition, and add per-partition offsets from a table
with one row per partition (tiny, broadcast).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import cut_lineage

_PID = "__qs_pid"
_MID = "__qs_mid"
# groups whose one-row tables ``first_by_key`` broadcasts (a key and a number each)
MAX_GROUPS = 100_000


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def global_rank(df: DataFrame, order: Sequence, rank_col: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based row number over the total order ``order`` (must be unique).

    Shuffles once (range exchange); per-partition counts are one row each.
    """
    order_cols = _cols(order)
    if num_partitions is None:
        num_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(num_partitions, *order_cols).sortWithinPartitions(*order_cols)
    # Partition ids and row ids are written once (reliable checkpoint): the
    # counts below and the join read the same rows, even if the range
    # boundaries would be sampled differently on a recomputation.
    tagged = cut_lineage(ranged.withColumn(_PID, F.spark_partition_id()).withColumn(_MID, F.monotonically_increasing_id()))
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__qs_n"))
    # one row per partition: a global window here is over num_partitions rows only
    offsets = counts.select(
        _PID,
        (F.sum("__qs_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1))).alias("__qs_off"),
    ).fillna(0, ["__qs_off"])
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    return (
        tagged.join(F.broadcast(offsets), _PID)
        .withColumn(rank_col, (F.col("__qs_off") + local + 1).cast("bigint"))
        .drop(_PID, _MID, "__qs_off")
    )


def ordinal_in_group(df: DataFrame, group: Sequence[str], order: Sequence, col: str = "ordinal",
                     skew_safe: bool = True) -> DataFrame:
    """0-based position of each row inside its group, ordered by ``order``.

    ``skew_safe`` uses a global rank over (group, order) and subtracts each
    group's first rank (an aggregate with map-side combine, joined back with
    AQE skew-join splitting). Otherwise a plain per-group window, for inputs
    whose groups are already bounded.
    """
    group = list(group)
    order_cols = _cols(order)
    if not skew_safe:
        w = Window.partitionBy(*group).orderBy(*order_cols)
        return df.withColumn(col, (F.row_number().over(w) - 1).cast("bigint"))
    ranked = global_rank(df, [*_cols(group), *order_cols], rank_col="__qs_r")
    first = ranked.groupBy(*group).agg(F.min("__qs_r").alias("__qs_first"))
    # one row per group: broadcast when small (the range partitioning of
    # ``ranked`` then survives, so a hot group stays spread over many tasks)
    from quillspark.operators.joins import join_small
    return (
        join_small(ranked, first, group)
        .withColumn(col, (F.col("__qs_r") - F.col("__qs_first")).cast("bigint"))
        .drop("__qs_r", "__qs_first")
    )


def first_by_key(df: DataFrame, group: Sequence[str], draw: Column, ties: Sequence[str], n: int, bits: int = 60) -> DataFrame:
    """The first ``n`` rows of every group in the order (draw, ties), without a task per group.

    ``draw`` is a uniform key of ``bits`` bits (``functions.key``). Its leading bits cut a group into 4,096
    buckets; the counts of the buckets say up to which one rows are needed, so only about n + 1/4,096 of a
    group is ranked, by range partitions. ``df`` is read twice. Groups of null keys are groups."""
    group = list(group)
    d = df.withColumn("__draw", draw).withColumn("__bucket", F.shiftright("__draw", bits - 12))
    sums = d.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # 4,096 rows a group at most
    edge = (sums.withColumn("__before", F.coalesce(F.sum("__c").over(before), F.lit(0))).filter(F.col("__before") < n)
            .groupBy(*[F.col(g).alias(f"__g_{g}") for g in group]).agg(F.max("__bucket").alias("__edge")))
    edge = cut_lineage(edge)
    few = edge.count() <= MAX_GROUPS  # a row a group

    def side(small: DataFrame) -> DataFrame:
        return F.broadcast(small) if few else small

    same = F.col("__bucket") <= F.col("__edge")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    kept = d.join(side(edge), same, "left_semi")
    ranked = global_rank(kept.drop("__bucket"), [*_cols(group), "__draw", *_cols(ties)], rank_col="__r")
    start = ranked.groupBy(*[F.col(g).alias(f"__g_{g}") for g in group]).agg(F.min("__r").alias("__start"))
    inside = F.col("__r") < F.col("__start") + n
    for g in group:
        inside = inside & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    return ranked.join(side(start), inside, "left_semi").drop("__r", "__draw")


def dense_ids(df: DataFrame, key_cols: Sequence[str], order: Sequence, id_col: str = "id") -> DataFrame:
    """Distinct ``key_cols`` numbered 0..K-1 by ``min(order)`` (first seen first).

    Returns one row per key: (*key_cols, id_col).
    """
    key_cols = list(key_cols)
    first = df.groupBy(*key_cols).agg(F.min(F.struct(*_cols(order))).alias("__qs_first"))
    ranked = global_rank(first, [F.col("__qs_first"), *[F.col(k) for k in key_cols]], rank_col="__qs_r")
    return ranked.select(*key_cols, (F.col("__qs_r") - 1).alias(id_col))


def prefix_sums(df: DataFrame, group: Sequence[str], order: Sequence, values: Sequence[str],
                prefix: str = "cum_", inclusive: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Running sums of ``values`` inside each group in ``order`` (unique per group).

    Skew-safe: rows are range-partitioned on (group, order), so one large
    group spans many tasks. Each task sums its own slice (window on
    (partition, group)); slice totals (one row per partition and group)
    give the offsets. Adds ``prefix+value`` columns.
    """
    group = list(group)
    order_cols = _cols(order)
    if num_partitions is None:
        num_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(num_partitions, *_cols(group), *order_cols).withColumn(_PID, F.spark_partition_id())
    w = Window.partitionBy(_PID, *group).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut_lineage(ranged.select("*", *[F.sum(v).over(w).alias(f"__loc_{v}") for v in values]))
    tot = local.groupBy(_PID, *group).agg(*[F.sum(v).alias(f"__tot_{v}") for v in values])
    wo = Window.partitionBy(*group).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(_PID, *group, *[F.coalesce(F.sum(f"__tot_{v}").over(wo), F.lit(0)).alias(f"__off_{v}") for v in values])
    from quillspark.operators.joins import join_small
    out = join_small(local, off, [_PID, *group])
    for v in values:
        c = F.col(f"__off_{v}") + F.col(f"__loc_{v}")
        if not inclusive:
            c = c - F.col(v)
        out = out.withColumn(prefix + v, c)
    return out.drop(_PID, *[f"__loc_{v}" for v in values], *[f"__off_{v}" for v in values])
