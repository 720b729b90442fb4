"""Price history snapshot (M-21) and its incremental / query forms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import scd
from ..session import written

KEY = ["product_id", "supermarket", "region"]
ATTRS = ["product_name", "brand", "min_price", "avg_price", "max_price", "min_list_price", "is_available",
         "sku_count", "total_available_quantity", "scraped_date", "scraped_at"]
WATCHED = ["min_price", "avg_price", "max_price", "min_list_price", "is_available"]


def snap_product_prices(tru: DataFrame, strategy: str = "timestamp", dealt: bool = False) -> DataFrame:
    """M-21: SCD-2 history keyed by product x store x region (decision: a
    3-column key, not the reference's separator-less concatenation)."""
    return scd.history_from_observations(tru, KEY, "scraped_at", ATTRS, strategy=strategy,
                                         check_cols=WATCHED, dealt=dealt)


def incremental_snapshot(tru: DataFrame, cutoff: dt.date, strategy: str = "timestamp",
                         hard_deletes: str = "ignore", as_of=None) -> DataFrame:
    """History built up to ``cutoff`` then merged with the later observations."""
    before = tru.where(F.col("scraped_date") < F.lit(cutoff))
    after = tru.where(F.col("scraped_date") >= F.lit(cutoff))
    hist = snap_product_prices(before, strategy, dealt=True)
    return scd.merge(hist, after, KEY, "scraped_at", ATTRS, strategy=strategy, check_cols=WATCHED,
                     hard_deletes=hard_deletes, as_of=as_of, dealt=True)


def snapshot_batches(tru: DataFrame, bounds: list[dt.date], strategy: str = "timestamp",
                     hard_deletes: str = "ignore") -> DataFrame:
    """History built up to the first bound, then merged with the days up to each next one; a
    batch is complete at its upper bound, where keys that it lacks count as deleted. Each
    step's history is written, as a run would, so the plan doesn't grow with the steps."""
    day = F.col("scraped_date")
    hist = snap_product_prices(tru.where(day < F.lit(bounds[0])), strategy, dealt=True)
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        batch = tru.where((day >= F.lit(low)) & (day < F.lit(high)))
        new = scd.merge(hist, batch, KEY, "scraped_at", ATTRS, strategy=strategy, check_cols=WATCHED, hard_deletes=hard_deletes,
                        as_of=dt.datetime.combine(high, dt.time(0)), dealt=i == 0)
        hist = scd.unpacked(written(scd.packed(new, KEY), "snapshot"), KEY)
    return hist


def with_rescrapes(tru: DataFrame) -> DataFrame:
    """The trusted rows and two later looks at each of them: a day and a half hour later nothing has
    changed; another 24 hours and a quarter later products with a number divisible by three cost 10 cents more."""
    looks = F.explode(F.array(*[F.struct(F.lit(m).alias("minutes"), F.lit(c).alias("more")) for m, c in ((0, 0), (1470, 0), (2925, 10))]))
    seen = tru.withColumn("_look", looks)  # beside each other: one scan, and rows that pack well
    minutes, more = F.col("_look.minutes"), F.col("_look.more")
    at = F.when(minutes == 0, F.col("scraped_at")).otherwise(F.timestamp_micros(F.unix_micros("scraped_at") + minutes.cast("bigint") * 60_000_000))
    dearer = (more > 0) & (F.pmod(F.col("product_id").cast("bigint"), F.lit(3)) == 0)
    cents = F.round(F.col("min_price") * 100).cast("bigint")
    return (seen.withColumn("scraped_at", at)
                .withColumn("scraped_date", F.when(minutes == 0, F.col("scraped_date")).otherwise(F.to_date("scraped_at")))
                .withColumn("min_price", F.when(dearer, (cents + more) / 100.0).otherwise(F.col("min_price"))).drop("_look"))
