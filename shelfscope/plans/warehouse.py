"""The model DAG of one build: bronze -> staging -> trusted -> dims -> facts.

Trusted, dimensions and marts are materialised once as Parquet tables under the
shared checkpoint folder (``table`` materialisation, SNK-04): this cuts lineage,
survives executor loss, and lets every consumer's scan prune columns and push
filters down. Staging and the one view stay lazy and Catalyst inlines them.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT, Params
from ..session import scratch_path, together
from ..sources import adapter

_LOCK = threading.RLock()
_BUILDS: dict[tuple, "Warehouse"] = {}


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = DEFAULT,
                 materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.p = params
        self.materialize = materialize
        self._tables: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.RLock] = {}
        tag = hashlib.sha1(f"{sf_dir}|{params.as_of}".encode()).hexdigest()[:10]
        self._prefix = f"wh-{tag}-{spark.sparkContext.applicationId}"

    # -- materialisation ---------------------------------------------------
    def table(self, name: str, build) -> DataFrame:
        with _LOCK:
            lock = self._locks.setdefault(name, threading.RLock())
        with lock:  # a table is built once; different ones may be built side by side
            if name in self._tables:
                return self._tables[name]
            df = build()
            if self.materialize:
                path = scratch_path(self.spark, f"{self._prefix}/{name}")
                df.write.mode("overwrite").option("compression", "zstd").parquet(path)
                df = self.spark.read.parquet(path)
            self._tables[name] = df
            return df

    def path(self, name: str) -> str:
        """A fresh location for a table this build writes."""
        import uuid
        return scratch_path(self.spark, f"{self._prefix}/{name}-{uuid.uuid4().hex[:8]}")

    def landed(self) -> str:
        """The bronze records landed once as Hive-partitioned Parquet (SNK-01 layout)."""
        if "_landed" not in self._tables:
            with _LOCK:
                if "_landed" not in self._tables:
                    from ..sinks.writers import BRONZE_PARTITIONS, write_partitioned
                    p = self.path("landed_bronze")
                    # clustered while the rows are narrow
                    rows = adapter.bronze_products(self.spark, self.sf_dir, lambda df: df.hint("rebalance", *BRONZE_PARTITIONS))
                    write_partitioned(rows, p, clustered=True)
                    self._tables["_landed"] = p
        return self._tables["_landed"]

    # -- layers ---------------------------------------------------------------
    def bronze(self) -> DataFrame:
        return adapter.bronze_products(self.spark, self.sf_dir)

    def stg(self) -> DataFrame:
        from .staging import stg_products
        return stg_products(self.bronze())

    def tru(self) -> DataFrame:
        from .trusted import enforce_contract, tru_product
        # the adapter's rows lie by product
        return self.table("tru_product", lambda: enforce_contract(tru_product(self.stg(), laid=True)))

    def silver(self) -> DataFrame:
        """Flat landed records (SRC-05), written once: every report reads it."""
        from .reports import silver_products
        return self.table("silver_products", lambda: silver_products(self.bronze()))

    def snapshot(self) -> DataFrame:
        """Latest collection per store x region (R-00), a table as in the reference."""
        from .reports import build_snapshot
        return self.table("snapshot", lambda: build_snapshot(self.silver(), self.p.as_of, self.p.snapshot_days))

    def reference(self) -> DataFrame:
        from .staging import stg_reference_products
        return stg_reference_products(adapter.reference_products(self.spark, self.sf_dir))

    def dim(self, name: str) -> DataFrame:
        from . import dims
        builders = {
            "dim_store": lambda: dims.dim_store(self.spark),
            "dim_date": lambda: dims.dim_date(self.tru(), self.p.as_of),
            "dim_product": lambda: dims.dim_product(self.tru()),
            "dim_brand": lambda: dims.dim_brand(self.tru()),
            "dim_region": lambda: dims.dim_region(self.tru()),
            "dim_location": lambda: dims.dim_location(self.tru()),
            "dim_store_location": lambda: dims.dim_store_location(
                self.tru(), self.dim("dim_store"), self.dim("dim_location"), dims.region_seed(self.spark)),
            "dim_ean": lambda: dims.dim_ean(self.tru(), self.reference()),
        }
        if name in self._tables:
            return self._tables[name]
        if name == "dim_store":  # a seed
            with _LOCK:
                return self._tables.setdefault(name, builders[name]())
        return self.table(name, builders[name])

    def fact(self, name: str) -> DataFrame:
        from . import facts
        if name == "fct_daily_prices":
            self.tru()  # all dimensions read it
            dims = ["dim_product", "dim_store", "dim_region", "dim_date", "dim_brand", "dim_ean"]
            return self.table(name, lambda: facts.fct_daily_prices(
                self.tru(), *together(self.spark, *[lambda d=d: self.dim(d) for d in dims])))
        builders = {
            "fct_active_promotions": lambda: facts.fct_active_promotions(self.fact("fct_daily_prices")),
            "fct_hot_deals_validated": lambda: facts.fct_hot_deals_validated(
                self.fact("fct_active_promotions"), self.p),
            "vw_suspicious_hot_deals": lambda: facts.vw_suspicious_hot_deals(
                self.fact("fct_hot_deals_validated")),
            "fct_promotion_summary": lambda: facts.fct_promotion_summary(
                self.fact("fct_active_promotions"), self.fact("fct_daily_prices")),
            "fct_daily_price_index": lambda: facts.fct_daily_price_index(self.tru()),
            "fct_price_comparison": lambda: facts.fct_price_comparison(self.tru()),
            "fct_price_comparison_v2": lambda: facts.fct_price_comparison_v2(self.fact("fct_daily_prices")),
            "fct_product_availability": lambda: facts.fct_product_availability(self.tru()),
        }
        if name == "vw_suspicious_hot_deals":  # the one view; every other mart is a table
            return builders[name]()
        return self.table(name, builders[name])


def warehouse(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir, params)
    with _LOCK:
        wh = _BUILDS.get(key)
        if wh is None:
            wh = _BUILDS[key] = Warehouse(spark, sf_dir, params)
    return wh
