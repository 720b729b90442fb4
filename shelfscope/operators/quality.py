"""Data-quality tests (DQ-01 .. DQ-14).

Every test returns the failing rows as a DataFrame; ``summarize`` turns them
into one lazy summary row (test, model, column_name, severity, failures,
status) with warn/error thresholds. Suites are unions of summaries — one Spark
job per suite when collected, nothing pulled to the driver per test.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _rows(df: DataFrame, bad: Column) -> DataFrame:
    """The rows of ``df`` that fail; a suite finds the condition again and counts all
    row-level tests of one table in one aggregate."""
    out = df.where(bad)
    out.row_test = (df, bad)
    return out


def not_null(df: DataFrame, column: str) -> DataFrame:
    return _rows(df, F.col(column).isNull())


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Duplicate key groups (DQ-02 / DQ-03): one row per duplicated key with its count."""
    cols = list(columns)
    return (df.where(F.coalesce(*[F.col(c).isNotNull() for c in cols]))
              .groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return _rows(df, F.col(column).isNotNull() & ~F.col(column).isin(*values))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Orphans (DQ-05): child keys with no parent; NULL passes."""
    p = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(p, column, "left_anti")


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | ((c < min_value) if inclusive else (c <= min_value))
    if max_value is not None:
        bad = bad | ((c > max_value) if inclusive else (c >= max_value))
    return _rows(df, c.isNotNull() & bad)


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    e = F.expr(expression) if isinstance(expression, str) else expression
    return _rows(df, ~F.coalesce(e, F.lit(False)))


def fewer_rows_than(df: DataFrame, other: DataFrame, group_by: Sequence[str],
                    where: str | None = None) -> DataFrame:
    """DQ-08: groups where ``df`` does not have fewer rows than ``other``."""
    a = (df.where(where) if where else df).groupBy(*group_by).agg(F.count(F.lit(1)).alias("n_model"))
    b = other.groupBy(*group_by).agg(F.count(F.lit(1)).alias("n_compare"))
    j = a.join(b, list(group_by), "full")
    return j.where(F.coalesce("n_model", F.lit(0)) >= F.coalesce("n_compare", F.lit(0)))


def recency(df: DataFrame, ts_column: str, as_of: dt.datetime, max_age: dt.timedelta) -> DataFrame:
    """DQ-09: one row when the newest timestamp is older than ``as_of - max_age`` (or absent)."""
    m = df.agg(F.max(ts_column).alias("latest"))
    return m.where(F.col("latest").isNull() | (F.col("latest") < F.lit(as_of - max_age)))


def schema_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """DQ-10: per contract column the expected type, the type in the files, rows, nulls, and
    whether it holds (same type, no null where none is allowed). One aggregate."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    n = F.count(F.lit(1))

    def row(f: T.StructField) -> Column:
        same = F.lit(actual.get(f.name) == f.dataType.simpleString())
        nulls = F.count_if(F.col(f.name).isNull()) if f.name in actual else n
        return F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("expected"),
                        F.lit(actual.get(f.name)).cast("string").alias("actual"), n.alias("checked"), nulls.alias("nulls"),
                        (same & (F.lit(f.nullable) | (nulls == 0))).alias("holds"))
    return df.agg(F.array(*[row(f) for f in contract.fields]).alias("r")).select(F.explode("r").alias("s")).select("s.*")


def non_negative(df: DataFrame, column: str) -> DataFrame:
    """DQ-11: custom generic test."""
    return _rows(df, F.col(column) < 0)


def reconcile(model: DataFrame, source: DataFrame, measure_model: Column, measure_source: Column,
              tolerance: float = 0.0) -> DataFrame:
    """DQ-12: one row when an aggregate of the model differs from the source's."""
    a = model.agg(measure_model.alias("model_value")).withColumn("_k", F.lit(1))
    b = source.agg(measure_source.alias("source_value")).withColumn("_k", F.lit(1))
    j = a.join(b, "_k").drop("_k")
    return j.where(F.abs(F.col("model_value") - F.col("source_value")) > tolerance)


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    """DQ-13: rows whose id occurs more than once (all copies flagged)."""
    d = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return df.join(d.select(key), key, "left_semi")


def summarize(failing: DataFrame, test: str, model: str, column: str | None = None,
              severity: str = "error", warn_if: int = 0, error_if: int = 0) -> DataFrame:
    """One summary row; status 'fail' above error_if (error severity), 'warn' above warn_if."""
    row = (test, model, column, severity, warn_if, error_if)
    out = failing.agg(_summary(F.count(F.lit(1)), *row).alias("s")).select("s.*")
    if hasattr(failing, "row_test"):
        out.row_test = (*failing.row_test, row)
    return out


def _summary(n: Column, test, model, column, severity, warn_if, error_if) -> Column:
    status = (F.when((F.lit(severity) == "error") & (n > error_if), "fail")
               .when(n > warn_if, "warn").otherwise("pass"))
    return F.struct(F.lit(test).alias("test"), F.lit(model).alias("model"),
                    F.lit(column).cast("string").alias("column_name"), F.lit(severity).alias("severity"),
                    n.alias("failures"), status.alias("status"))


def suite(summaries: Sequence[DataFrame]) -> DataFrame:
    """All summaries; row-level tests of the same table share one scan."""
    tables: dict[int, tuple[DataFrame, list]] = {}
    parts = []
    for s in summaries:
        if hasattr(s, "row_test"):
            df, bad, row = s.row_test
            tables.setdefault(id(df), (df, []))[1].append((bad, row))
        else:
            parts.append(s)
    for df, tests in tables.values():
        rows = F.array(*[_summary(F.count_if(bad), *row) for bad, row in tests])
        parts.append(df.agg(rows.alias("r")).select(F.explode("r").alias("s")).select("s.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
