"""Promotion and culture marts, the J3 union rewrite and the aggregate-only A9 view."""
import random

from pyspark.sql import functions as F

from riskmart.operators import marts
from riskmart.operators.joins import outer_merge_aggregates


def test_promotion_counts_duplicates(spark):
    rows = [("F1", "2025-01-10", "GA", "Runway Safety", "Pilots"), ("F2", "2025-01-12", "MI", "Fatigue", "Pilots"),
            ("F2", "2025-01-12", "MI", "Fatigue", "Pilots"), ("F3", "2025-01-20", "WA", "ADM", "Pilots"),
            ("F4", "2025-01-22", None, None, None)]
    df = spark.createDataFrame(rows, "event_id string, event_date string, state string, topic string, audience_type string")
    out = {(r.state, r.region): r.event_count for r in marts.safety_promotion_summary(df).collect()}
    assert out == {("GA", "Southeast"): 1, ("MI", "Midwest"): 2, ("WA", "West"): 1, ("UNKNOWN", "Unknown"): 1}


def test_outer_merge_equals_null_safe_full_join(spark):
    a = spark.createDataFrame([("m1", "A", 1), ("m1", None, 2), ("m2", "B", 3)], "m string, k string, x int")
    b = spark.createDataFrame([("m1", None, 10), ("m3", "C", 30)], "m string, k string, y int")
    got = sorted((tuple(r) for r in outer_merge_aggregates([a, b], ["m", "k"], [("x", "int"), ("y", "int")]).collect()), key=repr)
    assert got == sorted([("m1", "A", 1, None), ("m1", None, 2, 10), ("m2", "B", 3, None), ("m3", "C", None, 30)], key=repr)


def test_joined_view_matches_record_level_joins(spark):
    rnd = random.Random(3)
    airports = ["ATL", "JFK", "SEA"]
    months = ["2025-01-0%d" % d for d in (2, 3)] + ["2025-02-01"]
    ops = [(rnd.choice(months), rnd.choice(airports), str(i), rnd.choice([0, 1]), rnd.choice([0, 1]),
            rnd.choice([None, 1.0, 2.5, -3.0]), rnd.choice([None, 4.0, 7.5])) for i in range(40)]
    rep = [(str(i), rnd.choice(months), rnd.choice(airports + [None]), rnd.choice(["Fatigue", "Other", None]))
           for i in range(15)]
    inv = [(str(i), rnd.choice(months), rnd.choice(airports), rnd.choice(["serious_injury", "minor_injury"]))
           for i in range(12)]
    cul = [(str(i), rnd.choice(months), rnd.choice(airports), rnd.choice([None, .5, .9]), rnd.choice([1.0, 3.0]),
            rnd.choice([0, 1]), rnd.choice([None, -1.0, 2.0])) for i in range(10)]
    o = spark.createDataFrame(ops, "flight_date string, origin_airport string, flight_number string, cancelled_flag int, "
                                   "diverted_flag int, departure_delay_minutes double, arrival_delay_minutes double")
    r = spark.createDataFrame(rep, "report_id string, event_date string, location string, human_factors string")
    n = spark.createDataFrame(inv, "ntsb_event_id string, event_date string, airport_code string, severity_normalized string")
    c = spark.createDataFrame(cul, "event_id string, event_date string, base_location string, "
                                   "training_completion_rate double, safety_engagement_score double, "
                                   "fatigue_training_flag int, severity_score double")
    got = {(x.report_month, x.airport): x for x in marts.monthly_overview_joined_view(o, r, n, c, digits=6).collect()}
    for v, name in ((o, "o"), (r, "r"), (n, "n"), (c, "c")):
        v.createOrReplaceTempView(name)
    brute = spark.sql("""
        SELECT substr(o.flight_date, 1, 7) AS m, o.origin_airport AS a, count(*) AS legs,
               sum(o.cancelled_flag) AS canc, round(avg(o.departure_delay_minutes), 6) AS dep,
               count(DISTINCT r.report_id) AS reps,
               sum(CASE WHEN lower(r.human_factors) LIKE '%fatigue%' THEN 1 ELSE 0 END) AS fat,
               count(DISTINCT n.ntsb_event_id) AS invs,
               sum(CASE WHEN n.severity_normalized IN ('serious_injury', 'fatal_injury') THEN 1 ELSE 0 END) AS ser,
               round(avg(c.training_completion_rate), 6) AS tr,
               sum(CASE WHEN c.severity_score > 0 THEN 1 ELSE 0 END) AS elev
        FROM o LEFT JOIN r ON substr(r.event_date, 1, 7) = substr(o.flight_date, 1, 7) AND r.location = o.origin_airport
               LEFT JOIN n ON substr(n.event_date, 1, 7) = substr(o.flight_date, 1, 7) AND n.airport_code = o.origin_airport
               LEFT JOIN c ON substr(c.event_date, 1, 7) = substr(o.flight_date, 1, 7) AND c.base_location = o.origin_airport
        GROUP BY 1, 2""").collect()
    assert len(brute) == len(got)
    for b in brute:
        g = got[(b.m, b.a)]
        assert (g.operational_flight_legs, g.cancelled_flights, g.asrs_report_count, g.fatigue_related_report_count,
                g.ntsb_investigation_count, g.serious_or_higher_investigation_count,
                g.synthetic_elevated_risk_count) == (b.legs, b.canc, b.reps, b.fat, b.invs, b.ser, b.elev)
        assert g.avg_departure_delay_minutes == (float(b.dep) if b.dep is not None else None)
        assert g.avg_training_completion_rate == (float(b.tr) if b.tr is not None else None)
