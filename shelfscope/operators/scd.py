"""Slowly changing dimension, type 2 (SCD-01 .. SCD-05).

Versions of a key are rows with [valid_from, valid_to); valid_to NULL = current.
Every window here is partitioned by the business key: one product in one
store x region — its history is bounded by the number of scrape days.

* ``history_from_observations`` builds the whole history in one pass
  (timestamp strategy: every newer observation is a version; check strategy:
  a version starts when a watched column changes — gaps-and-islands).
* ``merge`` applies a new batch of observations to an existing history, the
  incremental form (MERGE on a table format; on plain Parquet: closed rows +
  re-timed open rows + new rows, written by partition overwrite).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _changed(cols: Sequence[str], w) -> Column:
    """A watched column differs from the previous row's (NULL compared as a value); the
    first row of a key counts as a change."""
    now = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    return ~F.lag(now).over(w).eqNullSafe(now)


def scd_id(key: Sequence[str], ts: str) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.col(ts).cast("string")))


def _laid(df: DataFrame, near: Sequence[str], key: Sequence[str]) -> DataFrame:
    """``df`` in ranges of ``near`` and the key: rows of a key and of its neighbours lie side by side and
    pack better than dealt by a hash, in the shuffle and in what is written of them."""
    return df.repartitionByRange(*near, *key)


def _dealt(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df`` dealt by the hash of the key to a number of tasks that frames of one session share, so that a
    union of two of them needs no further shuffle for windows over the key."""
    conf = df.sparkSession.conf
    parts = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions")
    return df.repartition(int(parts), *key)


def history_from_observations(obs: DataFrame, key: Sequence[str], ts: str, attrs: Sequence[str],
                              strategy: str = "timestamp",
                              check_cols: Sequence[str] | None = None, near: Sequence[str] = (),
                              dealt: bool = False) -> DataFrame:
    """Full SCD-2 history from all observations (one row per key and ts). ``near`` names columns
    of ``obs`` that follow from the key: the history comes in their order, task by task, with them.
    ``dealt``: the history will be merged with a batch in the same plan."""
    k, n = list(key), list(near)
    w = Window.partitionBy(*n, *k).orderBy(ts)
    base = obs.select(*n, *k, *attrs, *([] if ts in attrs else [ts]))
    base = _laid(base, n, k) if n else _dealt(base, k) if dealt else base
    if strategy == "timestamp":
        v = base.withColumn("valid_from", F.col(ts))
    elif strategy == "check":
        cc = list(check_cols or attrs)
        v = (base.withColumn("_chg", _changed(cc, w)).where("_chg").drop("_chg")
                 .withColumn("valid_from", F.col(ts)))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    wv = Window.partitionBy(*n, *k).orderBy("valid_from")
    return (v.withColumn("valid_to", F.lead("valid_from").over(wv))
             .withColumn("scd_id", scd_id(k, "valid_from"))
             .withColumn("updated_at", F.col(ts)))


def merge(history: DataFrame, batch: DataFrame, key: Sequence[str], ts: str, attrs: Sequence[str],
          strategy: str = "timestamp", check_cols: Sequence[str] | None = None,
          hard_deletes: str = "ignore", as_of=None, near: Sequence[str] = (), dealt: bool = False) -> DataFrame:
    """Apply ``batch`` observations to ``history``; returns the new full history.

    hard_deletes: 'ignore' | 'invalidate' (close the current version of keys
    absent from the batch at ``as_of``) | 'new_record' (also add a deletion version, a copy
    of the closed one with is_deleted = true). A key that comes back ends its deletion version
    at its first new observation, which is a version whatever its values; a key that stays
    away gets no second deletion version. Timestamp strategy: every new observation is a version.
    Check strategy: a row is a version only when its watched columns differ from
    the row before it. Late observations take their place in the key's history: the
    versions of every key in the batch are laid out again (one product in one store x
    region, bounded by its scrape days); other keys keep theirs untouched. A NULL in a key equals
    nothing: versions with one stay as they are.

    History and batch are shuffled once, together: whether a key is in the batch and whether an
    observation is known is read off the rows of the key. ``near`` as in ``history_from_observations``,
    of ``history`` and ``batch`` both. ``dealt``: ``history`` was made so in this plan, only the batch moves.
    """
    if hard_deletes != "ignore":
        if as_of is None:
            raise ValueError("as_of is required to invalidate deleted keys")
        if hard_deletes not in ("invalidate", "new_record"):
            raise ValueError(f"unknown hard_deletes {hard_deletes!r}")
    k, n = list(key), list(near)
    cols = [*n, *k, *[a for a in attrs if a != ts], ts]
    out_cols = list(history.columns)
    flagged = "is_deleted" in out_cols
    h = history if flagged else history.withColumn("is_deleted", F.lit(False))
    extra = [c for c in out_cols if c not in (*cols, "valid_from", "valid_to", "scd_id", "updated_at", "is_deleted")]
    nowhere = F.coalesce(*[F.when(F.col(c).isNull(), True) for c in k], F.lit(False))
    # ids and times that follow from key and start needn't travel
    differs = lambda c, usual: F.when(~F.col(c).eqNullSafe(usual), F.struct(F.col(c)))
    old = h.select(*cols, *extra, "is_deleted", F.col("valid_from").alias("_at"), F.col("valid_to").alias("_end"),
                   differs("scd_id", scd_id(k, "valid_from")).alias("_id"),
                   differs("updated_at", F.col("valid_from")).alias("_updated"), F.lit(0).alias("_new"))
    new = batch.select(*cols, F.lit(False).alias("is_deleted"), F.col(ts).cast("timestamp").alias("_at"),
                       F.lit(None).cast("timestamp").alias("_end"), F.lit(1).alias("_new"))
    both = old.unionByName(_dealt(new, k) if dealt else new, allowMissingColumns=True)
    both = both.withColumn("_apart", F.when(nowhere, F.col("_new")).otherwise(0))
    part = [*n, *k, "_apart"]
    both = both if dealt else _laid(both, n, [*k, "_apart"])
    stored = F.when((F.col("_new") == 0) & ~F.col("is_deleted"), 1)
    both = (both.withColumn("_known", F.max(stored).over(Window.partitionBy(*part, ts)))
                .withColumn("_seen", F.max("_new").over(Window.partitionBy(*part)) == 1)
                .where((F.col("_new") == 0) | F.col("_known").isNull() | F.col(ts).isNull()))
    w = Window.partitionBy(*part).orderBy("_at", F.desc("is_deleted"))
    seen = F.col("_seen")
    if strategy == "check":
        both = both.withColumn("_chg", _changed(["is_deleted", *(check_cols or attrs)], w)).where(~seen | F.col("_chg"))
    m = (both.withColumn("valid_from", F.col("_at"))
             # an end set by a deletion stays unless a version comes before it
             .withColumn("valid_to", F.when(seen, F.least(F.lead("_at").over(w), "_end")).otherwise(F.col("_end")))
             .withColumn("scd_id", F.when(seen | F.col("_id").isNull(), scd_id(k, "valid_from")).otherwise(F.col("_id.scd_id")))
             .withColumn("updated_at", F.when(seen | F.col("_updated").isNull(), F.col("_at")).otherwise(F.col("_updated.updated_at")))
             .withColumns({c: F.when(~seen, F.col(c)) for c in extra}))
    if hard_deletes == "ignore":
        return m.select(*out_cols)
    close_at = F.lit(as_of).cast("timestamp")
    gone = F.col("valid_to").isNull() & ~F.col("is_deleted") & (~seen | nowhere)
    m = m.withColumn("_gone", F.coalesce(gone, F.lit(False)))
    m = m.withColumn("_tomb", F.explode(F.when(F.col("_gone") & F.lit(hard_deletes == "new_record"), F.array(F.lit(False), F.lit(True)))
                                        .otherwise(F.array(F.lit(False)))))
    tomb = F.col("_tomb")
    m = (m.withColumn("valid_to", F.when(F.col("_gone") & ~tomb, close_at).when(~tomb, F.col("valid_to")))
          .withColumn("valid_from", F.when(tomb, close_at).otherwise(F.col("valid_from")))
          .withColumn("scd_id", F.when(tomb, scd_id(k, "valid_from")).otherwise(F.col("scd_id")))
          .withColumn("updated_at", F.when(tomb, close_at).otherwise(F.col("updated_at")))
          .withColumn("is_deleted", tomb | F.col("is_deleted")))
    return m.select(*out_cols, *([] if flagged else ["is_deleted"]))


# ------------------------------------------------------------------ storage
_FOLLOWS = ("scd_id", "updated_at")


def packed(history: DataFrame, key: Sequence[str]) -> DataFrame:
    """``history`` for storage: ids and times that follow from key and start are left empty."""
    usual = {"scd_id": scd_id(key, "valid_from"), "updated_at": F.col("valid_from")}
    return history.withColumns({c: F.when(~F.col(c).eqNullSafe(usual[c]), F.struct(F.col(c))) for c in _FOLLOWS})


def unpacked(stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """The history that ``packed`` has stored."""
    usual = {"scd_id": scd_id(key, "valid_from"), "updated_at": F.col("valid_from")}
    return stored.withColumns({c: F.when(F.col(c).isNull(), usual[c]).otherwise(F.col(c)[c]) for c in _FOLLOWS})


# ------------------------------------------------------------------ SCD-05
def current_versions(hist: DataFrame) -> DataFrame:
    return hist.where(F.col("valid_to").isNull())


def as_of_versions(hist: DataFrame, at) -> DataFrame:
    t = F.lit(at).cast("timestamp")
    return hist.where((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def days_at_price(hist: DataFrame, as_of) -> DataFrame:
    end = F.coalesce(F.col("valid_to"), F.lit(as_of).cast("timestamp"))
    return hist.withColumn("days_at_price",
                           F.datediff(F.to_date(end), F.to_date("valid_from")).cast("bigint"))
