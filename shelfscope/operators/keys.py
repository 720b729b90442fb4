"""Sequential keys and ranks that do not funnel a table or a group into one task.

``row_number() over (order by k)`` runs in a single task; ``row_number() over
(partition by g order by k)`` runs each group in one task, so a group holding a
third of the rows is a third of the job in one task. Here the rows are
range-partitioned on (group, order) — a hot group is spread over several
partitions, whose number AQE takes from the data's size — sorted within partitions and
written as a Parquet table with each row's partition and place (so a recomputation after
executor loss cannot move rows, and readers prune columns).
A tiny table of (partition, group) counts gives each group's offset in each
partition; rank = offset + position inside the partition. Only that count
table (at most partitions x groups-per-partition boundary rows) is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import together, written


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def rank_within_groups(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column | str],
                       name: str, partitions: int | None = None) -> DataFrame:
    """Adds ``name`` = row_number() over (partition by group_cols order by order).

    ``order`` should make rows unique within a group (deterministic ranks).
    """
    sort_cols = _cols(group_cols) + _cols(order)
    ranged = (df.repartitionByRange(*([partitions] if partitions else []), *sort_cols)
                .sortWithinPartitions(*sort_cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()))
    ranged = written(ranged, "ranked")
    g = list(group_cols)
    counts = (ranged.groupBy("_pid", *g)
                    .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_p0")))
    w = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    # |counts| <= partitions x (groups starting/ending in a partition + groups inside it). Written,
    # so its size is known: Spark joins it by broadcast below its threshold, else by shuffle.
    counts = written(counts.select("_pid", *g, "_off", "_p0"), "rank-offsets")
    joined = ranged.join(counts, ["_pid", *g], "inner")
    return (joined.withColumn(name, (F.col("_off") + F.col("_pos") - F.col("_p0") + 1).cast("bigint"))
                  .drop("_pid", "_pos", "_off", "_p0"))


def ranks_within_groups(df: DataFrame, group_cols: Sequence[str],
                        ranks: Mapping[str, Sequence[str | tuple[Column, bool]]], key: Sequence[str]) -> DataFrame:
    """Several ranks of the same rows. ``ranks`` names each with its order: column names
    (ascending) and pairs of a column and whether it descends. ``key`` tells the rows of ``df`` apart and
    holds the group columns.

    The rows are written once. Each rank is found on a narrow copy (key and order columns), and
    the copies are joined to the rows on the key, which shuffles the wide rows once for all."""
    rows = written(df, "rows-to-rank")

    def ranked(name: str, order: Sequence) -> DataFrame:
        parts = [(F.col(o), False) if isinstance(o, str) else o for o in order]
        narrow = rows.select(*key, *[c.alias(f"_o{i}") for i, (c, _) in enumerate(parts)])
        return rank_within_groups(narrow, group_cols,
                                  [F.col(f"_o{i}").desc() if down else F.col(f"_o{i}") for i, (_, down) in enumerate(parts)],
                                  name).select(*key, name)

    out = rows
    for r in together(df.sparkSession, *[lambda n=n, o=o: ranked(n, o) for n, o in ranks.items()]):
        out = out.join(r, list(key))
    return out


def sequential_key(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Dense 1..N key by ``order`` (unique) without a single-task global window."""
    sort_cols = _cols(order)
    ranged = (df.repartitionByRange(*sort_cols)
                .sortWithinPartitions(*sort_cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()))
    ranged = written(ranged, "ranked")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_p0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a proven bound, safe to broadcast
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    joined = ranged.join(F.broadcast(offsets.select("_pid", "_off", "_p0")), "_pid")
    return (joined.withColumn(name, (F.col("_off") + F.col("_pos") - F.col("_p0") + 1).cast("bigint"))
                  .drop("_pid", "_pos", "_off", "_p0"))


def small_key(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Global row_number for tables bounded by configuration (seeds, store x region)."""
    w = Window.orderBy(*_cols(order))
    return df.withColumn(name, F.row_number().over(w).cast("bigint"))
