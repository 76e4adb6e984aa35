"""riskmart: Spark-native aviation-safety analytics.

Raw operational, voluntary-report, investigation, promotion and culture extracts
become checked, de-duplicated trusted tables; from those come monthly marts,
rule-based narrative enrichment, a narrative feature table and out-of-fold model
evaluation tables.  Every builder is a pure function ``DataFrame(s) -> DataFrame``
so Catalyst sees one logical plan per written table.

Layout
------
functions/  column expressions (codes, dates, indicators, text cleaning, fixed dictionaries)
sources/    CSV / multi-file / two-row-header / three-table readers and table sinks
operators/  data-quality kit, keep-first de-duplication, marts, text rules,
            narrative features, evaluation curves and model tables
plans/      trusted-layer adapters, role views over the driver tables, SQL views,
            dashboard queries and the oracle SQL used by the correctness gate
llm/        operators for preparing training data; nothing else imports them
"""

from riskmart.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
