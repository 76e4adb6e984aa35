"""Monthly marts (A1-A5, A8, J3) and the SQL views.

Every mart is one ``groupBy().agg()`` over a trusted table: Spark plans a partial
(map-side) hash aggregate, one shuffle on the grouping keys, and a final aggregate.
Group keys are low-cardinality (month x airport x ...), so hot keys collapse to one row
per map partition before the exchange.

``digits`` switches averages to the exact, order-independent form rounded to that many
digits (None keeps Spark's floating ``avg``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions import dictionaries as D
from riskmart.functions.scalars import (
    contains_flag, exact_avg, key_norm, month_key, py_strip, to_timestamp_col, round_half_even, theme_slug,
)
from riskmart.operators.joins import Lookup, outer_merge_aggregates


def airport_lookup(mapping=None) -> Lookup:
    return Lookup(D.AIRPORT_REGION if mapping is None else mapping, D.AIRPORT_REGION_DEFAULT)


def state_lookup(mapping=None) -> Lookup:
    return Lookup(D.STATE_REGION if mapping is None else mapping, D.STATE_REGION_DEFAULT)


def carrier_lookup(mapping=None) -> Lookup:
    return Lookup(D.OPERATOR_CARRIER_GROUP if mapping is None else mapping, D.OPERATOR_CARRIER_DEFAULT,
                  value_col="carrier")


def _avg(c: str, digits: int | None) -> Column:
    return F.avg(F.col(c)) if digits is None else exact_avg(c, digits)


def with_month(df: DataFrame, date_col: str, out: str = "report_month") -> DataFrame:
    """Parse, drop unparseable, ``yyyy-MM``."""
    ts = to_timestamp_col(df, date_col)
    return df.withColumn("_mts", ts).where(F.col("_mts").isNotNull()).withColumn(out, month_key(F.col("_mts"))).drop("_mts")


def _serious_flag(c: str = "severity_normalized") -> Column:
    return F.coalesce(F.col(c).isin(D.SERIOUS_OR_HIGHER), F.lit(False)).cast("int")


# ------------------------------------------------------------------ A1
def operational_disruption_summary(ops: DataFrame, airports: Lookup | None = None,
                                   digits: int | None = None) -> DataFrame:
    airports = airports or airport_lookup()
    df = airports.apply_normalized(with_month(ops, "flight_date"), F.col("origin_airport"), "region")
    out = df.groupBy("report_month", "carrier", "origin_airport", "destination_airport", "route", "region").agg(
        F.count("flight_number").alias("flight_leg_count"),
        F.sum("cancelled_flag").cast("long").alias("cancelled_flight_count"),
        F.sum("diverted_flag").cast("long").alias("diverted_flight_count"),
        _avg("departure_delay_minutes", digits).alias("avg_departure_delay_minutes"),
        _avg("arrival_delay_minutes", digits).alias("avg_arrival_delay_minutes"),
    )
    return out.withColumns({
        "cancellation_rate": round_half_even(F.try_divide(F.col("cancelled_flight_count"), F.col("flight_leg_count")), 4),
        "diversion_rate": round_half_even(F.try_divide(F.col("diverted_flight_count"), F.col("flight_leg_count")), 4),
        "data_basis": F.lit(D.BASIS_DISRUPTION),
    })


# ------------------------------------------------------------------ A2
def fatigue_theme_trends(reports: DataFrame, airports: Lookup | None = None,
                         carriers: Lookup | None = None) -> DataFrame:
    airports = airports or airport_lookup()
    carriers = carriers or carrier_lookup()
    df = with_month(reports, "event_date").withColumn("airport", key_norm("location"))
    df = carriers.apply_normalized(df, F.col("aircraft_operator"), "carrier")
    df = airports.apply_normalized(df, F.col("airport"), "region")
    df = df.withColumn("human_factor_theme", theme_slug("human_factors"))
    df = df.withColumn("fatigue_related_flag", contains_flag(F.col("human_factor_theme"), "fatigue"))
    out = df.groupBy("report_month", "airport", "carrier", "region", "human_factor_theme",
                     "fatigue_related_flag").agg(
        F.count("report_id").alias("report_count"),
        F.count_distinct("anomaly").alias("unique_anomaly_count"),
    )
    return out.withColumn("data_basis", F.lit(D.BASIS_FATIGUE))


# ------------------------------------------------------------------ A3
def investigation_trends(inv: DataFrame, airports: Lookup | None = None,
                         carriers: Lookup | None = None) -> DataFrame:
    airports = airports or airport_lookup()
    carriers = carriers or carrier_lookup()
    df = with_month(inv, "event_date").withColumn("airport", key_norm("airport_code"))
    df = carriers.apply_normalized(df, F.col("operator_name"), "operator_group")
    df = airports.apply_normalized(df, F.col("airport"), "region")
    out = df.groupBy("report_month", "airport", "operator_group", "region", "investigation_category",
                     "severity_normalized").agg(
        F.count("ntsb_event_id").alias("investigation_count"),
        F.sum(_serious_flag()).cast("long").alias("serious_or_higher_count"),
    )
    return out.withColumn("data_basis", F.lit(D.BASIS_INVESTIGATION))


# ------------------------------------------------------------------ A4
def safety_promotion_summary(promo: DataFrame, states: Lookup | None = None) -> DataFrame:
    """Input is the raw extract and is not de-duplicated (Q13)."""
    states = states or state_lookup()
    df = with_month(promo, "event_date").withColumn("state", key_norm("state"))
    df = states.apply_normalized(df, F.col("state"), "region")
    df = df.withColumns({
        "topic": py_strip(F.coalesce(F.col("topic").cast("string"), F.lit("UNKNOWN"))),
        "audience_type": py_strip(F.coalesce(F.col("audience_type").cast("string"), F.lit("UNKNOWN"))),
    })
    out = df.groupBy("report_month", "state", "region", "topic", "audience_type").agg(
        F.count("event_id").alias("event_count"))
    return out.withColumn("data_basis", F.lit(D.BASIS_PROMOTION))


# ------------------------------------------------------------------ A5 (+A8, J3, O1)
OVERVIEW_KEYS = ["report_month", "airport", "region"]
# FIXED VALUES: columns of the overview, in the extract's order.
OVERVIEW_MEASURES = [
    ("operational_flight_legs", "long"),
    ("cancelled_flights", "long"),
    ("diverted_flights", "long"),
    ("avg_departure_delay_minutes", "double"),
    ("avg_arrival_delay_minutes", "double"),
    ("asrs_report_count", "long"),
    ("fatigue_related_report_count", "long"),
    ("ntsb_investigation_count", "long"),
    ("serious_or_higher_investigation_count", "long"),
    ("avg_training_completion_rate", "double"),
    ("avg_safety_engagement_score", "double"),
    ("fatigue_training_completion_rate", "double"),
    ("synthetic_elevated_risk_count", "long"),
]


def _overview_parts(ops, reports, inv, culture, airports: Lookup, digits):
    parts = []
    if ops is not None:
        o = with_month(ops, "flight_date").withColumn("airport", F.col("origin_airport"))
        o = airports.apply_normalized(o, F.col("airport"), "region")
        parts.append(o.groupBy(*OVERVIEW_KEYS).agg(
            F.count("flight_number").alias("operational_flight_legs"),
            F.sum("cancelled_flag").cast("long").alias("cancelled_flights"),
            F.sum("diverted_flag").cast("long").alias("diverted_flights"),
            _avg("departure_delay_minutes", digits).alias("avg_departure_delay_minutes"),
            _avg("arrival_delay_minutes", digits).alias("avg_arrival_delay_minutes"),
        ))
    if reports is not None:
        r = with_month(reports, "event_date").withColumn("airport", key_norm("location"))
        r = airports.apply_normalized(r, F.col("airport"), "region")
        parts.append(r.groupBy(*OVERVIEW_KEYS).agg(
            F.count("report_id").alias("asrs_report_count"),
            F.sum(contains_flag(F.coalesce(F.col("human_factors"), F.lit("")), "fatigue")).cast("long")
             .alias("fatigue_related_report_count"),
        ))
    if inv is not None:
        n = with_month(inv, "event_date").withColumn("airport", key_norm("airport_code"))
        n = airports.apply_normalized(n, F.col("airport"), "region")
        parts.append(n.groupBy(*OVERVIEW_KEYS).agg(
            F.count("ntsb_event_id").alias("ntsb_investigation_count"),
            F.sum(_serious_flag()).cast("long").alias("serious_or_higher_investigation_count"),
        ))
    if culture is not None:
        c = with_month(culture, "event_date").withColumn("airport", key_norm("base_location"))
        c = airports.apply_normalized(c, F.col("airport"), "region")
        parts.append(c.groupBy(*OVERVIEW_KEYS).agg(
            _avg("training_completion_rate", digits).alias("avg_training_completion_rate"),
            _avg("safety_engagement_score", digits).alias("avg_safety_engagement_score"),
            _avg("fatigue_training_flag", digits).alias("fatigue_training_completion_rate"),
            F.count_if(F.coalesce(F.col("severity_score"), F.lit(0.0)) > 0).cast("long")
             .alias("synthetic_elevated_risk_count"),
        ))
    return parts


def monthly_risk_overview(ops: DataFrame | None, reports: DataFrame | None, inv: DataFrame | None,
                          culture: DataFrame | None, airports: Lookup | None = None,
                          digits: int | None = None, sort: bool = True) -> DataFrame:
    """Four per-source aggregates, merged null-safely on (month, airport, region).

    Always emits the fixed 17-column schema (Q11 fix); a missing source leaves NULLs.
    """
    airports = airports or airport_lookup()
    parts = _overview_parts(ops, reports, inv, culture, airports, digits)
    if not parts:
        raise ValueError("monthly_risk_overview needs at least one source")
    merged = outer_merge_aggregates(parts, OVERVIEW_KEYS, OVERVIEW_MEASURES)
    merged = merged.withColumn("data_basis", F.lit(D.BASIS_OVERVIEW))
    return merged.orderBy("report_month", "airport") if sort else merged


# ------------------------------------------------------------------ A9
def monthly_overview_joined_view(ops: DataFrame, reports: DataFrame, inv: DataFrame, culture: DataFrame,
                                 airports: Lookup | None = None, digits: int | None = None) -> DataFrame:
    """The SQL view's record-level left joins, computed from per-key aggregates.

    The view joins every operations row to every report, investigation and culture row of
    the same (month, airport) before grouping, so its counts are multiplied by the other
    sides' match counts (Q1/Q2).  Within one key every operations row meets the same
    partner rows, so each measure factors exactly:

      COUNT(*)            = n_ops * M_rep * M_inv * M_cul        (M = max(matches, 1))
      SUM(ops flag)       = sum_ops(flag) * M_rep * M_inv * M_cul
      AVG(ops x), AVG(culture x)  = the plain per-side average (constant multiplicity)
      COUNT(DISTINCT id)  = distinct ids on that side
      SUM(CASE side ...)  = count_side(cond) * n_ops * (M of the other two sides)

    So no pair is ever materialised: four aggregations, three joins of aggregates.  The
    products are DECIMAL(38,0): four counts multiplied soon leave the range of BIGINT.
    """
    airports = airports or airport_lookup()
    o = with_month(ops, "flight_date").withColumn("airport", F.col("origin_airport"))
    o = airports.apply(o, F.col("airport"), "region")  # the view's CASE: no fill, no upper
    ops_k = o.groupBy("report_month", "airport", "region").agg(
        F.count(F.lit(1)).alias("n_ops"),
        F.sum("cancelled_flag").alias("s_cancelled"),
        F.sum("diverted_flag").alias("s_diverted"),
        _avg("departure_delay_minutes", digits).alias("avg_departure_delay_minutes"),
        _avg("arrival_delay_minutes", digits).alias("avg_arrival_delay_minutes"),
    )
    rep_k = with_month(reports, "event_date").groupBy(
        F.col("report_month").alias("r_month"), F.col("location").alias("r_airport")).agg(
        F.count(F.lit(1)).alias("m_rep"),
        F.count_distinct("report_id").alias("d_rep"),
        F.count_if(F.lower(F.col("human_factors")).contains("fatigue")).alias("f_rep"))
    inv_k = with_month(inv, "event_date").groupBy(
        F.col("report_month").alias("n_month"), F.col("airport_code").alias("n_airport")).agg(
        F.count(F.lit(1)).alias("m_inv"),
        F.count_distinct("ntsb_event_id").alias("d_inv"),
        F.count_if(F.col("severity_normalized").isin(D.SERIOUS_OR_HIGHER)).alias("s_inv"))
    cul_k = with_month(culture, "event_date").groupBy(
        F.col("report_month").alias("c_month"), F.col("base_location").alias("c_airport")).agg(
        F.count(F.lit(1)).alias("m_cul"),
        _avg("training_completion_rate", digits).alias("avg_training_completion_rate"),
        _avg("safety_engagement_score", digits).alias("avg_safety_engagement_score"),
        _avg("fatigue_training_flag", digits).alias("fatigue_training_completion_rate"),
        F.count_if(F.col("severity_score") > 0).alias("e_cul"))
    j = (ops_k
         .join(rep_k, (F.col("report_month") == F.col("r_month")) & (F.col("airport") == F.col("r_airport")), "left")
         .join(inv_k, (F.col("report_month") == F.col("n_month")) & (F.col("airport") == F.col("n_airport")), "left")
         .join(cul_k, (F.col("report_month") == F.col("c_month")) & (F.col("airport") == F.col("c_airport")), "left"))
    mr = F.greatest(F.coalesce(F.col("m_rep"), F.lit(0)), F.lit(1))
    mi = F.greatest(F.coalesce(F.col("m_inv"), F.lit(0)), F.lit(1))
    mc = F.greatest(F.coalesce(F.col("m_cul"), F.lit(0)), F.lit(1))
    n = F.col("n_ops").cast("decimal(38,0)")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return j.select(
        "report_month", "airport", "region",
        (n * mr * mi * mc).cast("decimal(38,0)").alias("operational_flight_legs"),
        (F.col("s_cancelled").cast("decimal(38,0)") * mr * mi * mc).cast("decimal(38,0)").alias("cancelled_flights"),
        (F.col("s_diverted").cast("decimal(38,0)") * mr * mi * mc).cast("decimal(38,0)").alias("diverted_flights"),
        "avg_departure_delay_minutes", "avg_arrival_delay_minutes",
        z("d_rep").cast("long").alias("asrs_report_count"),
        (z("f_rep") * n * mi * mc).cast("decimal(38,0)").alias("fatigue_related_report_count"),
        z("d_inv").cast("long").alias("ntsb_investigation_count"),
        (z("s_inv") * n * mr * mc).cast("decimal(38,0)").alias("serious_or_higher_investigation_count"),
        "avg_training_completion_rate", "avg_safety_engagement_score", "fatigue_training_completion_rate",
        (z("e_cul") * n * mr * mi).cast("decimal(38,0)").alias("synthetic_elevated_risk_count"),
    )


# ------------------------------------------------------------------ A10
def disruption_view(ops: DataFrame, digits: int | None = None) -> DataFrame:
    return with_month(ops, "flight_date").groupBy(
        "report_month", "carrier", "origin_airport", "destination_airport", "route").agg(
        F.count(F.lit(1)).alias("flight_leg_count"),
        F.sum("cancelled_flag").cast("long").alias("cancelled_flight_count"),
        F.sum("diverted_flag").cast("long").alias("diverted_flight_count"),
        _avg("departure_delay_minutes", digits).alias("avg_departure_delay_minutes"),
        _avg("arrival_delay_minutes", digits).alias("avg_arrival_delay_minutes"),
    )


# ------------------------------------------------------------------ A11
def investigation_view(inv: DataFrame) -> DataFrame:
    return with_month(inv, "event_date").groupBy(
        "report_month", F.col("airport_code").alias("airport"), F.col("operator_name").alias("operator_group"),
        "investigation_category", "severity_normalized").agg(F.count(F.lit(1)).alias("investigation_count"))


# ------------------------------------------------------------------ D1-D3 dashboard queries
def kpi_and_concentration(overview: DataFrame) -> DataFrame:
    """Monthly totals and each airport's share of the month's flight legs.

    The overview holds one row per (month, airport), so the per-month window sees at most
    #airports rows.
    """
    from pyspark.sql import Window
    w = Window.partitionBy("report_month")
    legs = F.coalesce(F.col("operational_flight_legs"), F.lit(0))
    return overview.select(
        "report_month", "airport",
        legs.alias("operational_flight_legs"),
        F.sum(legs).over(w).alias("month_flight_legs"),
        F.sum(F.coalesce(F.col("asrs_report_count"), F.lit(0))).over(w).alias("month_report_count"),
        F.sum(F.coalesce(F.col("ntsb_investigation_count"), F.lit(0))).over(w).alias("month_investigation_count"),
        F.bround(F.try_divide(legs.cast("double"), F.sum(legs).over(w).cast("double")), 6).alias("airport_leg_share"),
    )


def investigation_mix(trends: DataFrame) -> DataFrame:
    """Per month x category x severity: count, share of the month, change vs previous month."""
    from pyspark.sql import Window
    g = trends.groupBy("report_month", "investigation_category", "severity_normalized").agg(
        F.sum("investigation_count").cast("long").alias("investigation_count"))
    month = Window.partitionBy("report_month")
    series = Window.partitionBy("investigation_category", "severity_normalized").orderBy("report_month")
    return g.select(
        "*",
        F.bround(F.col("investigation_count") / F.sum("investigation_count").over(month), 6).alias("month_share"),
        F.lag("investigation_count").over(series).alias("previous_month_count"),
    )


def theme_top_k(trends: DataFrame, k: int = 3) -> DataFrame:
    """D3: top-k human-factor themes per month by report count, with month-to-month change.

    The limit is the feature (a top-k report); ties share a rank and are all kept.
    """
    from pyspark.sql import Window
    g = trends.groupBy("report_month", "human_factor_theme").agg(
        F.sum("report_count").cast("long").alias("report_count"),
        F.count_distinct("carrier").alias("carrier_count"))
    series = Window.partitionBy("human_factor_theme").orderBy("report_month")
    ranked = g.select(
        "*",
        F.lag("report_count").over(series).alias("previous_month_count"),
        F.rank().over(Window.partitionBy("report_month").orderBy(F.desc("report_count"))).alias("theme_rank"),
    )
    return ranked.where(F.col("theme_rank") <= k)
