"""Data-quality kit: keep-first de-duplication, required-value filters, checks.

Scale notes
-----------
* ``keep_first`` is ``row_number() == 1`` over ``partitionBy(keys)``; Spark plans it with a
  partial ``WindowGroupLimit`` *before* the shuffle, so a hot key (a third of all rows)
  reaches the exchange as at most one row per map partition.
* Checks aggregate with partial (map-side) aggregation; nothing is collected except the
  single summary row a check needs to decide whether to raise.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions.scalars import col


class DataQualityError(ValueError):
    """Raised by the V-checks, like the reference's runtime contracts."""


# ------------------------------------------------------------------ F4
def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in source order; NULL keys compare equal.

    ``order`` must be a total order of the rows (file name, block start, row id for
    files; every remaining column for tables without an order).
    """
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*[col(o).asc_nulls_first() for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# ------------------------------------------------------------------ F1
def required_present(columns: Iterable[str], blank_is_null: bool = False) -> Column:
    cond = F.lit(True)
    for c in columns:
        x = F.col(c)
        ok = x.isNotNull()
        if blank_is_null:
            ok = ok & ~x.cast("string").rlike(r"(?U)^\s*$")
        cond = cond & ok
    return cond


def drop_required_nulls(df: DataFrame, columns: Iterable[str], blank_is_null: bool = False) -> DataFrame:
    return df.where(required_present(list(columns), blank_is_null))


# ------------------------------------------------------------------ V1
def validate_required_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Plan-time check; the error names every absent column."""
    have = set(df.columns)
    absent = ", ".join(sorted({c for c in required if c not in have}))
    if absent:
        raise DataQualityError(f"the input lacks {absent}")


# ------------------------------------------------------------------ V2 / V5 / A12: one profile
PROFILE = ("row_count", "null_count", "min_value", "max_value")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column_name, row_count, null_count, min_value, max_value): a row for each column, in one aggregate.

    Profiles add up (``merged_profile``), so a table that grows by months is checked from its
    months' profiles and the new rows alone.  Least and greatest values are those of the values'
    text, which is enough to tell a column that varies and is the same for every type.
    """
    columns = list(columns if columns is not None else [c for c in df.columns if c not in by])

    def text(c: str) -> Column:
        nested = isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType))
        return F.to_json(F.struct(F.col(f"`{c}`"))) if nested else F.col(f"`{c}`").cast("string")

    held = df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), *[
        F.struct(F.count_if(F.col(f"`{c}`").isNull()).alias("null_count"), F.min(text(c)).alias("min_value"),
                 F.max(text(c)).alias("max_value")).alias(f"p{i}") for i, c in enumerate(columns)])
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), "row_count", f"p{i}.null_count", f"p{i}.min_value", f"p{i}.max_value") for i, c in enumerate(columns)])
    return held.select(*by, F.explode(each).alias("p")).select(*by, "p.*")


def merged_profile(profile: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The profile of the union of profiled tables, by fewer columns or none."""
    return profile.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"))


def null_ratio() -> Column:
    """V2 of a profile row: share of nulls; null for a table without rows."""
    return F.try_divide(F.col("null_count").cast("double"), F.col("row_count"))


def varies() -> Column:
    """A12 of a profile row: whether a column has two distinct values that are not null."""
    return F.coalesce(F.col("min_value") != F.col("max_value"), F.lit(False))


def null_ratios(df: DataFrame) -> DataFrame:
    """(column_name, null_ratio) of all columns."""
    return column_profile(df).select("column_name", null_ratio().alias("null_ratio"))


def validate_null_threshold(df: DataFrame, threshold: float) -> None:
    over = null_ratios(df).where(F.col("null_ratio") > threshold).collect()  # <= #columns rows
    if over:
        listed = ", ".join(f"{r.column_name} ({r.null_ratio:.1%})" for r in over)
        raise DataQualityError(f"more than {threshold:.1%} of the values are null in {listed}")


# ------------------------------------------------------------------ V3
def count_duplicate_surplus(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-row frame ``duplicate_rows`` = rows - distinct keys (NULL keys equal)."""
    per_key = df.groupBy(*keys).count()
    return per_key.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def validate_no_duplicates(df: DataFrame, keys: Sequence[str]) -> None:
    n = count_duplicate_surplus(df, keys).first()["duplicate_rows"]
    if n:
        raise DataQualityError(f"{n} rows repeat a key ({', '.join(keys)})")


# ------------------------------------------------------------------ V4
def validate_label(df: DataFrame, label: str) -> DataFrame:
    """Raise when the label is NULL or non-numeric; return it cast to int."""
    bad = df.agg(F.count_if(F.col(label).cast("string").try_cast("double").isNull()).alias("bad")).first()["bad"]
    if bad:
        raise DataQualityError(f"{bad} rows have no numeric value in {label}")
    return df.withColumn(label, F.col(label).cast("string").try_cast("double").cast("int"))


# ------------------------------------------------------------------ V6
def value_distributions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, row_count): ``value_counts(dropna=False)`` of several columns in one pass; NULL is a value of its own."""
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    return df.select(F.explode(each).alias("p")).groupBy("p.column_name", "p.value").agg(F.count(F.lit(1)).alias("row_count"))
