"""Exact quantiles of groups of any size, by selection across tasks.

Groups of at most ``SMALL`` rows are sorted as one array each: a bound that holds whatever the
input. Nothing orders a larger group. Each round cuts the value range that still holds a wanted position
into ``CELLS`` equal cells and counts the rows per cell (combined map-side, so a hot group is a few
thousand rows per task); of a cell only count, least and greatest value are kept. The cell that
holds the position is the next round's range, until its least and greatest value are the same: the
value at that position. A range shrinks by a factor of ``CELLS`` a round, so prices in whole
cents take two rounds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

CELLS = 2048
SMALL = 4096
RUNNING = ("aggregate(_cells, named_struct('s', cast(array() as array<struct<lo: double, hi: double, below: bigint, n: bigint>>), 'm', _below), "
           "(a, c) -> named_struct('s', concat(a.s, array(named_struct('lo', c.lo, 'hi', c.hi, 'below', a.m, 'n', c.n))), 'm', a.m + c.n), "
           "a -> a.s)")


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """``keys`` and one column per entry of ``probs``: the linearly interpolated quantile of
    the non-null values, which must be finite (as percentile_cont). Null keys are a group."""
    k = list(keys)
    mine = [f"_k{i}" for i in range(len(k))]
    rows = df.where(F.col(value).isNotNull()).select(*[F.col(c).alias(m) for c, m in zip(k, mine)], F.col(value).cast("double").alias("_v"))
    at = lambda p: (F.col("_n") - 1) * F.lit(float(p))
    places = F.array_distinct(F.array(*[f(at(p)).cast("long") for p in probs.values() for f in (F.floor, F.ceil)]))
    whole = rows.groupBy(*mine).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    sizes = written(whole.withColumn("_at", places), "quantile-groups")
    named = lambda d, pick: d.select(*[F.col(m).alias(c) for m, c in zip(mine, k)], *[
        (pick(p, F.floor) + (pick(p, F.ceil) - pick(p, F.floor)) * (at(p) - F.floor(at(p)))).alias(name) for name, p in probs.items()])
    few = sizes.where(F.col("_n") <= SMALL).select(*[F.col(m).alias(f"_f{i}") for i, m in enumerate(mine)])
    sorted_ = rows.join(few, [F.col(m).eqNullSafe(F.col(f"_f{i}")) for i, m in enumerate(mine)], "left_semi").groupBy(*mine).agg(
        F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_list("_v")).alias("_s"))
    small = written(named(sorted_, lambda p, f: F.get("_s", f(at(p)).cast("int"))), "quantile-small")
    sizes = sizes.where(F.col("_n") > SMALL)
    if sizes.isEmpty():
        return small
    # a range: its bounds, the rows of its group below it, the positions it holds
    ranges = sizes.select(*mine, "_lo", "_hi", F.lit(0).cast("long").alias("_below"), "_at")
    found = None
    while True:
        done = ranges.where("_lo = _hi").select(*mine, F.explode("_at").alias("_p"), F.col("_lo").alias("_x"))
        found = done if found is None else found.unionByName(done)
        wide = ranges.where("_lo < _hi")
        if wide.limit(1).isEmpty():
            break
        theirs = [f"_r{i}" for i in range(len(k))]
        target = wide.select(*[F.col(a).alias(b) for a, b in zip(mine, theirs)], "_lo", "_hi", "_below", "_at")
        inside = rows.join(target, [*[F.col(a).eqNullSafe(F.col(b)) for a, b in zip(mine, theirs)],
                                    F.col("_v").between(F.col("_lo"), F.col("_hi"))])
        cell = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * CELLS), F.lit(CELLS - 1)).cast("int")
        cells = inside.groupBy(*theirs, "_lo", "_below", "_at", cell.alias("_c")).agg(
            F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        strips = cells.groupBy(*theirs, "_lo", "_below", "_at").agg(F.sort_array(F.collect_list(F.struct("_c", "n", "lo", "hi"))).alias("_cells"))
        # running count over a range's cells (at most CELLS), then the cells that hold a position
        nxt = strips.select(*[F.col(b).alias(a) for a, b in zip(mine, theirs)], "_at", F.explode(F.expr(RUNNING)).alias("c")).select(
            *mine, F.col("c.lo").alias("_lo"), F.col("c.hi").alias("_hi"), F.col("c.below").alias("_below"),
            F.expr("filter(_at, p -> p >= c.below and p < c.below + c.n)").alias("_at"))
        ranges = written(nxt.where("size(_at) > 0"), "quantile-ranges")
    values = found.groupBy(*mine).agg(F.map_from_entries(F.collect_list(F.struct("_p", "_x"))).alias("_values"))
    j = sizes.join(values.select(*[F.col(m).alias(f"_j{i}") for i, m in enumerate(mine)], "_values"),
                   [F.col(m).eqNullSafe(F.col(f"_j{i}")) for i, m in enumerate(mine)])
    return small.unionByName(named(j, lambda p, f: F.col("_values")[f(at(p)).cast("long")]))
