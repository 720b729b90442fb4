"""Incremental model strategies (INC-01 .. INC-06).

Plain Parquet has no MERGE; the merge-like functions keep a MERGE signature
(target, source, key) so a table format can replace them. Partition
overwrites use dynamic partition overwrite: only the touched days are rewritten.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_per_key
from ..sinks.published import Published, Version


def new_since_watermark(source: DataFrame, target: DataFrame, ts: str = "scraped_at") -> DataFrame:
    """INC-01: source rows newer than the target's max timestamp (a one-row
    aggregate joined on a constant key: no scan of the target beyond one column)."""
    wm = target.agg(F.max(ts).alias("_wm")).withColumn("_k", F.lit(1))
    return (source.withColumn("_k", F.lit(1)).join(F.broadcast(wm), "_k")
                  .where(F.col("_wm").isNull() | (F.col(ts) > F.col("_wm"))).drop("_k", "_wm"))


def append_new_days(target: DataFrame, source: DataFrame, day: str = "scraped_date") -> DataFrame:
    """INC-02: append only days the target does not have (anti join on the day)."""
    have = target.select(day).distinct()
    return target.unionByName(source.join(have, day, "left_anti"))


def merge_upsert(target: DataFrame, source: DataFrame, key: Sequence[str],
                 update_columns: Sequence[str] | None = None) -> DataFrame:
    """INC-03: upsert by the full grain key (decision: never by product_id alone).
    Source rows win; with ``update_columns`` only those columns are taken from
    the source and the rest keep the target's values."""
    t = target.withColumn("_src", F.lit(0))
    s = source.withColumn("_src", F.lit(1))
    if update_columns is not None:
        # when matched: update only these columns; when not matched: insert every column
        keep = [c for c in target.columns if c not in key and c not in update_columns]
        old = target.select(*key, *[F.col(c).alias(f"_old_{c}") for c in keep], F.lit(True).alias("_matched"))
        s = s.join(old, list(key), "left")
        s = s.select(*[F.when(F.col("_matched"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) if c in keep
                       else F.col(c) for c in t.columns])
    merged = latest_per_key(t.unionByName(s), list(key), ["_src"])
    return merged.drop("_src").select(*target.columns)


def overwrite_partitions(df: DataFrame, path: str, partition_col: str = "scraped_date") -> str:
    """INC-04: insert_overwrite / delete+insert — rewrite only the partitions present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))
    return path


def lookback_window(source: DataFrame, target: DataFrame, days: int = 3, day: str = "scraped_date") -> DataFrame:
    """INC-05: reprocess the last ``days`` days before the target's newest day (late data)."""
    last = target.agg(F.max(day).alias("_d")).withColumn("_k", F.lit(1))
    return (source.withColumn("_k", F.lit(1)).join(F.broadcast(last), "_k")
                  .where(F.col("_d").isNull() | (F.col(day) >= F.date_sub("_d", days))).drop("_k", "_d"))


# -- INC-06: on_schema_change -------------------------------------------------------------------

def apply_schema_change(target: DataFrame, new: DataFrame, policy: str = "append_new_columns") -> DataFrame:
    """INC-06: on_schema_change = append_new_columns | fail | ignore | sync_all_columns."""
    tcols, ncols = list(target.columns), list(new.columns)
    added = [c for c in ncols if c not in tcols]
    removed = [c for c in tcols if c not in ncols]
    if policy == "fail" and (added or removed):
        raise ValueError(f"schema changed: added {added}, removed {removed}")
    if policy == "ignore":
        return target.unionByName(new.select(*[c for c in tcols if c in ncols]), allowMissingColumns=True)
    if policy == "append_new_columns":
        return target.unionByName(new, allowMissingColumns=True)
    if policy == "sync_all_columns":
        return target.drop(*removed).unionByName(new, allowMissingColumns=True)
    raise ValueError(f"unknown policy {policy!r}")


WIDER = {"tinyint": ["smallint", "int", "bigint", "double"], "smallint": ["int", "bigint", "double"],
         "int": ["bigint", "double"], "float": ["double"], "date": ["timestamp"]}   # casts that lose nothing
POLICIES = ("ignore", "fail", "append_new_columns", "sync_all_columns")


class SchemaRefused(ValueError):
    """The policy doesn't take a batch of this schema."""


def schema_difference(have: dict[str, str], batch: dict[str, str]) -> str:
    """Added and removed columns and changed types, in words; empty if there are none."""
    out = [f"added {c}" for c in batch if c not in have] + [f"removed {c}" for c in have if c not in batch]
    return "; ".join(out + [f"changed {c} {have[c]} to {batch[c]}" for c in have if c in batch and batch[c] != have[c]])


def reconcile(have: dict[str, str], batch: dict[str, str], policy: str) -> dict[str, str]:
    """The table's columns and types after a batch, by policy.

    fail: the schemas must be equal. ignore: new columns are left out, a missing one is refused.
    append_new_columns: new columns are added, missing ones are NULL. sync_all_columns: the
    batch's columns and types are the table's. Types: the first three take a changed type
    only if one side widens to the other without loss (append widens the table, ignore the batch).
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    diff = schema_difference(have, batch)
    if not diff:
        return dict(have)
    if policy == "fail" or policy == "ignore" and any(c not in batch for c in have):
        raise SchemaRefused(diff)
    if policy == "sync_all_columns":
        kept = {c: batch[c] for c in have if c in batch}
        return {**kept, **{c: t for c, t in batch.items() if c not in kept}}
    out = {}
    for c, t in have.items():
        b = batch.get(c, t)
        if b == t or t in WIDER.get(b, ()):
            out[c] = t
        elif policy == "append_new_columns" and b in WIDER.get(t, ()):
            out[c] = b
        else:
            raise SchemaRefused(diff)
    return out if policy == "ignore" else {**out, **{c: t for c, t in batch.items() if c not in have}}


class EvolvingTable:
    """A partitioned table whose columns change from batch to batch (INC-06).

    Each batch is a folder of partitions written once, in the schema the table had then; a
    version names the folders, each with its schema, and the columns of today. Old partitions are
    never rewritten: a reader casts what they stored and fills what they lack with NULL. A column's
    values are found under a stored name that is used only once, so a column that was dropped and
    comes back doesn't bring its old values along."""

    def __init__(self, spark: SparkSession, base: str, partition_col: str):
        self.state, self.partition_col = Published(spark, base), partition_col

    def columns(self) -> dict[str, str]:
        return {c: f["type"] for c, f in self.state.current().values.get("columns", {}).items()}

    def append(self, batch: DataFrame, policy: str = "append_new_columns") -> Version:
        """Adds a batch under a policy; raises SchemaRefused and leaves the table as it was."""
        now = self.state.current()
        have: dict = now.values.get("columns", {})
        incoming = {f.name: f.dataType.simpleString() for f in batch.schema}
        types = reconcile({c: f["type"] for c, f in have.items()}, incoming, policy) if have else incoming
        used = set(now.values.get("used", []))
        columns = {}
        for c, t in types.items():
            stored = have[c]["stored"] if c in have else c if c not in used else f"{c}__{now.number + 1}"
            columns[c] = {"type": t, "stored": stored}
        rows = batch.select(*[F.col(c).cast(columns[c]["type"]).alias(columns[c]["stored"]) for c in columns if c in incoming])
        part = f"data/batch={uuid.uuid4().hex}"
        key = columns[self.partition_col]["stored"]
        rows.hint("rebalance", key).write.partitionBy(key).parquet(f"{self.state.base}/{part}")
        stored = {f["stored"]: f["type"] for c, f in columns.items() if c in incoming}
        return self.state.commit(now, {"data": [*now.tables.get("data", []), part]}, {
            "columns": columns, "used": sorted(used | {f["stored"] for f in columns.values()}),
            "schemas": {**now.values.get("schemas", {}), part: stored}})

    def read(self) -> DataFrame:
        """All rows in the columns of today: one scan per schema that was ever stored."""
        now = self.state.current()
        groups: dict[str, list[str]] = {}
        for part in now.tables["data"]:
            groups.setdefault(json.dumps(now.values["schemas"][part]), []).append(part)
        out = None
        for schema, parts in groups.items():
            stored = json.loads(schema)
            ddl = ", ".join(f"`{c}` {t}" for c, t in stored.items())
            raw = self.state.spark.read.schema(ddl).option("basePath", f"{self.state.base}/data").parquet(
                *[f"{self.state.base}/{p}" for p in parts])
            rows = raw.select(*[(F.col(f["stored"]).cast(f["type"]) if f["stored"] in stored else F.lit(None).cast(f["type"])).alias(c)
                                for c, f in now.values["columns"].items()])
            out = rows if out is None else out.unionByName(rows)
        return out


def run_incremental(spark: SparkSession, tru: DataFrame, path: str, cutoff: dt.date, lookback_days: int = 3) -> DataFrame:
    """INC-04 + INC-05 together: load the history up to ``cutoff``, then re-run the
    last days with a lookback and overwrite only those partitions."""
    overwrite_partitions(tru.where(F.col("scraped_date") < F.lit(cutoff)), path)
    current = spark.read.parquet(path)
    redo = lookback_window(tru, current, lookback_days)
    overwrite_partitions(redo, path)
    return spark.read.parquet(path)
