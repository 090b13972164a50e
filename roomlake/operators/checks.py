"""Data-quality checks (CHK-1 unique, CHK-2 not null, CHK-3 required columns).

All checks of one run are evaluated as one Spark job: each table contributes
one grouped pass (both checks) and the rows are unioned, so the driver
receives (table, column, check, failures) records, never data.  Keys are
counted with a partial aggregation, so duplicated hot keys are combined
before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(found: list[str], required: list[str], what: str = "input") -> None:
    missing = [c for c in required if c not in found]
    if missing:
        raise RuntimeError(f"{what} missing columns: {missing}. Found: {list(found)}")


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """Failing rows of a unique test: keys that occur more than once."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def not_null_violations(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def check_frame(name: str, df: DataFrame, col: str) -> DataFrame:
    """Two rows (unique, not_null failure counts) from one grouped pass.

    Rows are counted per key with a partial aggregate; NULL keys form their
    own group, so both checks come out of the same shuffle.
    """
    per_key = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum(F.when(F.col(col).isNotNull() & (F.col("n") > 1), 1)), F.lit(0))
         .cast("long").alias("unique"),
        F.coalesce(F.sum(F.when(F.col(col).isNull(), F.col("n"))), F.lit(0))
         .cast("long").alias("not_null"))
    return totals.select(F.lit(name).alias("table_name"), F.lit(col).alias("column_name"),
                         F.expr("stack(2, 'unique', `unique`, 'not_null', `not_null`)")
                          .alias("check_name", "failures"))


def run_checks(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``{table: (frame, key column)}`` -> one frame of check results."""
    frames = [check_frame(name, df, col) for name, (df, col) in tables.items()]
    return reduce(DataFrame.unionByName, frames)


def assert_checks(results: DataFrame) -> list:
    rows = results.collect()   # two small rows per table
    bad = [r for r in rows if r.failures]
    if bad:
        raise AssertionError("data checks failed: " + ", ".join(
            f"{r.table_name}.{r.column_name} {r.check_name}={r.failures}" for r in bad))
    return rows
