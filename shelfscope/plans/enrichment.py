"""Barcode enrichment jobs (ENR-01 .. ENR-05)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import pct, valid_barcode_length
from ..functions.validate import normalize_reference, reference_rules
from ..operators.dedup import latest_per_key
from ..sinks.published import Published, Version
from ..sources.bronze import delta_files, delta_records

REQUESTED = "ean string, requested_in long"
REFERENCE = ["code", "product_name", "brands", "nutriscore_grade"]
REFERENCE_SCHEMA = "code string, product_name string, brands string, nutriscore_grade string, as_of_delta long"


def unique_barcodes(tru: DataFrame) -> DataFrame:
    """ENR-01: distinct valid barcodes of the products (sorted on output)."""
    e = tru.where(F.col("eans").isNotNull()).select(F.explode("eans").alias("code"))
    return e.where(valid_barcode_length(F.col("code"))).distinct().orderBy("code")


def new_barcodes(codes: DataFrame, watermark: DataFrame) -> DataFrame:
    """ENR-02: barcodes never requested before (anti join to the watermark set)."""
    return codes.join(watermark.select(F.col("ean").alias("code")), "code", "left_anti")


def requested_barcodes(state: Published) -> DataFrame:
    """ENR-02: every barcode requested so far, found or not, with the version that requested it."""
    have = state.read("requested", REQUESTED)
    return have if have is not None else state.spark.createDataFrame([], REQUESTED)


def request_new(state: Published, codes: DataFrame) -> tuple[DataFrame, Version]:
    """ENR-02: the barcodes never requested before, and the version whose watermark holds them.

    The watermark grows by one folder per run and is never rewritten. What is returned is read
    back from that folder, so what a caller requests is exactly what the watermark says; a
    run without new barcodes publishes nothing."""
    now = state.current()
    new = new_barcodes(codes.distinct(), requested_barcodes(state)).select(
        F.col("code").alias("ean"), F.lit(now.number + 1).cast("long").alias("requested_in"))
    part = state.stage("requested", new)
    staged = state.spark.read.schema(REQUESTED).parquet(f"{state.base}/{part}")
    if staged.isEmpty():
        return staged, now
    done = state.commit(now, {"requested": [*now.tables.get("requested", []), part]}, {})
    return staged, done


# -- ENR-04: delta synchronisation -----------------------------------------------------------

def import_reference(state: Published, records: DataFrame, last_timestamp: int) -> Version:
    """The bulk import a delta synchronisation starts from: records up to ``last_timestamp``."""
    part = state.stage("reference", records.select(*REFERENCE, F.lit(last_timestamp).cast("long").alias("as_of_delta")))
    return state.commit(state.current(), {"reference": [part]}, {"last_timestamp": last_timestamp, "refresh": True})


def latest_reference(state: Published, at: Version | None = None) -> DataFrame:
    """The latest record of every barcode: of the newest delta that changed it, else the import."""
    rows = state.read("reference", REFERENCE_SCHEMA, at)
    if rows is None:
        return state.spark.createDataFrame([], REFERENCE_SCHEMA)
    return latest_per_key(rows, ["code"], ["as_of_delta", "product_name", "brands", "nutriscore_grade"],
                          keep=["product_name", "brands", "nutriscore_grade", "as_of_delta"])


def delta_sync(state: Published, deltas: str, codes: DataFrame) -> dict:
    """ENR-04: the delta files after the watermark, applied to the reference records.

    Files are chosen by the time range in their names. Of the records for wanted barcodes only
    those that differ from the barcode's present record are kept (the newest per barcode), in a
    folder of their own. That folder, the advanced watermark and the flag that dependent
    tables need a refresh are published in one version; the flag is set only if a record
    changed, and stays until ``refresh_if_changed`` clears it. A run that fails before has
    changed nothing, and the next one reads the same files again. Malformed lines are kept in a table of
    their own."""
    now = state.current()
    mark = int(now.values.get("last_timestamp", 0))
    files = delta_files(state.spark, deltas, mark)
    if not files:
        return {"version": now.number, "files": 0, "changed": 0, "malformed": 0, "last_timestamp": mark, "refresh": False}
    recs, bad = delta_records(state.spark, files, codes)
    lines = state.stage("malformed", bad)
    recs = normalize_reference(recs.where(reference_rules()["VAL-09 code"]))
    new = latest_per_key(recs, ["code"], ["delta_end", "last_modified_t", "product_name", "brands", "nutriscore_grade"],
                         keep=["product_name", "brands", "nutriscore_grade", "delta_end"])
    value = F.struct("product_name", "brands", "nutriscore_grade")
    have = latest_reference(state, now).select("code", value.alias("_have"))
    changed = (new.join(have, "code", "left").where(F.col("_have").isNull() | ~value.eqNullSafe(F.col("_have")))
               .select(*REFERENCE, F.col("delta_end").alias("as_of_delta")))
    part = state.stage("reference", changed)
    n = state.spark.read.schema(REFERENCE_SCHEMA).parquet(f"{state.base}/{part}").count()
    end = max(f[1] for f in files)
    malformed = state.spark.read.schema(bad.schema).parquet(f"{state.base}/{lines}").count()
    done = state.commit(now, {"reference": [*now.tables.get("reference", []), *([part] if n else [])],
                              "malformed": [*now.tables.get("malformed", []), *([lines] if malformed else [])]},
                        {"last_timestamp": end, "refresh": bool(n) or bool(now.values.get("refresh", False))})
    return {"version": done.number, "files": len(files), "changed": n, "malformed": malformed,
            "last_timestamp": end, "refresh": n > 0}


def refresh_if_changed(state: Published, name: str, build: Callable[[DataFrame], DataFrame]) -> bool:
    """Builds table ``name`` from the latest reference records if the flag is set, and publishes
    it with the flag cleared. Returns whether it did."""
    now = state.current()
    if not now.values.get("refresh", False):
        return False
    part = state.stage(name, build(latest_reference(state, now)))
    state.commit(now, {name: [part]}, {"refresh": False})
    return True


def enrichment_stats(requested: DataFrame, found: DataFrame) -> DataFrame:
    """ENR-05: requested, found, missing and the success rate."""
    r = requested.select("code").distinct()
    f = found.select("code").distinct().withColumn("_hit", F.lit(True))
    j = r.join(f, "code", "left")
    return j.agg(F.count(F.lit(1)).alias("requested"), F.count("_hit").alias("found"),
                 F.count_if(F.col("_hit").isNull()).alias("missing")) \
            .withColumn("success_rate_pct", pct("found", "requested"))
