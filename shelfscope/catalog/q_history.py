"""Registered queries: SCD-2 history (M-21, SCD-01 .. SCD-05)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config
from ..operators import scd
from ..plans.history import incremental_snapshot, snap_product_prices, snapshot_batches, with_rescrapes
from ..plans.warehouse import warehouse
from .oracle import register as cte, with_ctes
from .registry import register

SNAP_COLS = ("product_id, supermarket, region, product_name, brand, min_price, avg_price, max_price, "
             "min_list_price, is_available, sku_count, total_available_quantity, scraped_date, scraped_at")
KEYS = "product_id, supermarket, region"
LAST_DAY = config.DEFAULT_AS_OF
CUTOFF = LAST_DAY - dt.timedelta(days=14)
CLOSE_AT = dt.datetime.combine(LAST_DAY + dt.timedelta(days=1), dt.time(0))
OUT = SNAP_COLS + ", valid_from, valid_to, scd_id, updated_at"

cte("snap_ts", f"""
snap_ts AS (
  SELECT {SNAP_COLS}, scraped_at AS valid_from,
         lead(scraped_at) OVER (PARTITION BY {KEYS} ORDER BY scraped_at) AS valid_to,
         md5(concat_ws('|', {KEYS}, CAST(scraped_at AS VARCHAR))) AS scd_id, scraped_at AS updated_at
  FROM tru
)""", ["tru"])

# every trusted row seen again unchanged, and once more with a new price for every third product
cte("observed", f"""
observed AS (
  SELECT {SNAP_COLS} FROM tru
  UNION ALL
  SELECT * REPLACE (scraped_at + INTERVAL 1470 MINUTE AS scraped_at, CAST(scraped_at + INTERVAL 1470 MINUTE AS DATE) AS scraped_date)
  FROM (SELECT {SNAP_COLS} FROM tru)
  UNION ALL
  SELECT * REPLACE (scraped_at + INTERVAL 2925 MINUTE AS scraped_at, CAST(scraped_at + INTERVAL 2925 MINUTE AS DATE) AS scraped_date,
                    CASE WHEN CAST(product_id AS BIGINT) % 3 = 0
                         THEN (CAST(round(min_price * 100) AS BIGINT) + 10) / 100.0 ELSE min_price END AS min_price)
  FROM (SELECT {SNAP_COLS} FROM tru)
)""", ["tru"])

cte("snap_chk", f"""
snap_chk AS (
  WITH o AS (
    SELECT *, row_number() OVER w AS rn,
           lag(min_price) OVER w AS l1, lag(avg_price) OVER w AS l2, lag(max_price) OVER w AS l3,
           lag(min_list_price) OVER w AS l4, lag(is_available) OVER w AS l5
    FROM observed WINDOW w AS (PARTITION BY {KEYS} ORDER BY scraped_at)),
  v AS (
    SELECT * FROM o WHERE rn = 1 OR min_price IS DISTINCT FROM l1 OR avg_price IS DISTINCT FROM l2
       OR max_price IS DISTINCT FROM l3 OR min_list_price IS DISTINCT FROM l4 OR is_available IS DISTINCT FROM l5)
  SELECT {SNAP_COLS}, scraped_at AS valid_from,
         lead(scraped_at) OVER (PARTITION BY {KEYS} ORDER BY scraped_at) AS valid_to,
         md5(concat_ws('|', {KEYS}, CAST(scraped_at AS VARCHAR))) AS scd_id, scraped_at AS updated_at
  FROM v
)""", ["observed"])


def _tru(spark, sf):
    return warehouse(spark, sf).tru()


@register("M-21", with_ctes(["snap_ts"], f"SELECT {OUT} FROM snap_ts"))
def m21(spark, sf):
    return snap_product_prices(_tru(spark, sf)).select(*[c.strip() for c in OUT.split(",")])


@register("SCD-01", with_ctes(["snap_ts"], f"SELECT {OUT} FROM snap_ts"))
def scd01(spark, sf):
    """Timestamp strategy, incremental: history to the cutoff, then merge the rest."""
    return incremental_snapshot(_tru(spark, sf), CUTOFF).select(*[c.strip() for c in OUT.split(",")])


@register("SCD-02", with_ctes(["snap_chk"], f"SELECT {OUT} FROM snap_chk"))
def scd02(spark, sf):
    """Check strategy (watched price/availability columns), incremental merge."""
    return incremental_snapshot(with_rescrapes(_tru(spark, sf)), CUTOFF, strategy="check").select(
        *[c.strip() for c in OUT.split(",")])


@register("SCD-03", with_ctes(["snap_ts"], f"""
SELECT {SNAP_COLS}, valid_from,
       CASE WHEN valid_to IS NULL AND ({KEYS}) NOT IN (
              SELECT ({KEYS}) FROM tru WHERE scraped_date >= DATE '{LAST_DAY.isoformat()}')
            THEN TIMESTAMP '{CLOSE_AT.isoformat(sep=' ')}' ELSE valid_to END AS valid_to,
       scd_id, updated_at, false AS is_deleted
FROM snap_ts"""))
def scd03(spark, sf):
    """Hard deletes, invalidate: keys missing from the latest batch are closed."""
    cols = [c.strip() for c in OUT.split(",")] + ["is_deleted"]
    return incremental_snapshot(_tru(spark, sf), LAST_DAY, hard_deletes="invalidate",
                                as_of=CLOSE_AT).select(*cols)


BOUNDS = [LAST_DAY - dt.timedelta(days=20), LAST_DAY - dt.timedelta(days=10), LAST_DAY + dt.timedelta(days=1)]
_END = [f"TIMESTAMP '{b.isoformat()} 00:00:00'" for b in BOUNDS]


@register("SCD-03b", with_ctes(["tru"], f"""
, o AS (SELECT {SNAP_COLS}, CASE WHEN scraped_at < {_END[0]} THEN 0 WHEN scraped_at < {_END[1]} THEN 1 ELSE 2 END AS b FROM tru),
k AS (SELECT {KEYS}, bool_or(b = 0) AS in0, bool_or(b = 1) AS in1, bool_or(b = 2) AS in2 FROM o GROUP BY ALL),
gone AS (
  SELECT o.*, {_END[1]} AS gone_at FROM o JOIN k USING ({KEYS}) WHERE in0 AND NOT in1 AND b = 0
  UNION ALL SELECT o.*, {_END[2]} FROM o JOIN k USING ({KEYS}) WHERE in1 AND NOT in2 AND b <= 1),
version AS (
  SELECT {SNAP_COLS}, scraped_at AS valid_from, false AS is_deleted FROM o
  UNION ALL
  SELECT {SNAP_COLS}, gone_at, true FROM gone QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY scraped_at DESC) = 1)
SELECT *, lead(valid_from) OVER (PARTITION BY {KEYS} ORDER BY valid_from) AS valid_to,
       md5(concat_ws('|', {KEYS}, CAST(valid_from AS VARCHAR))) AS scd_id, valid_from AS updated_at
FROM version"""))
def scd03b(spark, sf):
    """Hard deletes, new_record: two batches lack keys, which get a deletion version; keys of
    the second batch that the first lacked come back and end theirs."""
    cols = [c.strip() for c in OUT.split(",")] + ["is_deleted"]
    return snapshot_batches(_tru(spark, sf), BOUNDS, hard_deletes="new_record").select(*cols)


@register("SCD-04", with_ctes(["snap_chk"], f"SELECT {OUT} FROM snap_chk"))
def scd04(spark, sf):
    """Whole history in one pass, change points by lag + islands."""
    return snap_product_prices(with_rescrapes(_tru(spark, sf)), "check").select(*[c.strip() for c in OUT.split(",")])


@register("SCD-05", with_ctes(["snap_chk"], f"""
SELECT {KEYS}, product_name, min_price, is_available, valid_from, valid_to,
       date_diff('day', CAST(valid_from AS DATE), CAST(coalesce(valid_to, TIMESTAMP '{CLOSE_AT.isoformat(sep=' ')}') AS DATE)) AS days_at_price,
       valid_to IS NULL AS is_current,
       CASE WHEN valid_to IS NULL AND NOT is_available THEN valid_from END AS out_of_stock_since,
       count(*) OVER (PARTITION BY {KEYS}) - 1 AS price_changes_count
FROM snap_chk"""))
def scd05(spark, sf):
    """History queries: days at price, current version, out of stock since, change count."""
    h = scd.days_at_price(snap_product_prices(with_rescrapes(_tru(spark, sf)), "check"), CLOSE_AT)
    from pyspark.sql import Window
    w = Window.partitionBy("product_id", "supermarket", "region")
    cur = F.col("valid_to").isNull()
    return h.select("product_id", "supermarket", "region", "product_name", "min_price", "is_available",
                    "valid_from", "valid_to", "days_at_price", cur.alias("is_current"),
                    F.when(cur & ~F.col("is_available"), F.col("valid_from")).alias("out_of_stock_since"),
                    (F.count(F.lit(1)).over(w) - 1).alias("price_changes_count"))
