"""Joins: dimension lookups (J5) and the n-way outer merge.

No join here carries a broadcast hint.  The planner broadcasts a side whose bytes are below
``spark.sql.autoBroadcastJoinThreshold``, AQE does so with the bytes a shuffle really wrote,
and other joins are sort-merge joins whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.scalars import key_norm, map_lookup


@dataclass
class Lookup:
    """A dimension: literal dict (constant-folded map) or a DataFrame (key, value)."""

    mapping: Mapping[str, str] | DataFrame
    default: str | None
    key_col: str = "code"
    value_col: str = "region"

    def apply(self, df: DataFrame, key: Column, out: str) -> DataFrame:
        """Add ``out`` = dim[key] else default; never fans out (one value per key)."""
        if not isinstance(self.mapping, DataFrame):
            return df.withColumn(out, map_lookup(key, self.mapping, self.default))
        dim = (self.mapping
               .groupBy(F.col(self.key_col).alias("_lk_key"))
               .agg(F.min(self.value_col).alias("_lk_val")))
        joined = df.withColumn("_lk_key", key).join(dim, "_lk_key", "left")
        val = F.col("_lk_val") if self.default is None else F.coalesce(F.col("_lk_val"), F.lit(self.default))
        return joined.withColumn(out, val).drop("_lk_key", "_lk_val")

    def apply_normalized(self, df: DataFrame, source: str | Column, out: str) -> DataFrame:
        """Lookup after fill-UNKNOWN / strip / upper (the reference's map_* helpers)."""
        return self.apply(df, key_norm(source), out)


def outer_merge_aggregates(frames: Sequence[DataFrame], keys: Sequence[str],
                           measures: Sequence[tuple[str, str]]) -> DataFrame:
    """Null-safe n-way full outer join of per-key aggregates.

    Each input holds at most one row per key, so union + ``max`` per measure equals the
    full outer merge with NULL keys matching NULL keys -- in one shuffle and without the
    join fan-out.  ``measures`` lists (name, type) of the fixed output schema; measures a
    frame lacks are NULL.
    """
    aligned = []
    for f in frames:
        cols = [F.col(k) for k in keys]
        for name, typ in measures:
            cols.append((F.col(name) if name in f.columns else F.lit(None)).cast(typ).alias(name))
        aligned.append(f.select(*cols))
    union = aligned[0]
    for f in aligned[1:]:
        union = union.unionByName(f)
    return union.groupBy(*keys).agg(*[F.max(n).alias(n) for n, _ in measures])
