"""Operations adapter and disruption mart on the literal sample (FIXTURES section 1)."""
import os

from pyspark.sql import functions as F

from conftest import write_csv
from riskmart.operators import marts
from riskmart.plans.trusted import trusted_operations
from riskmart.sources.files import SOURCE_ORDER, read_csv_folder

HEADER = ["FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin", "Dest",
          "DepDelay", "ArrDelay", "Cancelled", "Diverted", "Tail_Number"]
SAMPLE = [
    ["2025-01-03", "DL", "1045", "ATL", "JFK", 12, 6, 0, 0, "N123DN"],
    ["2025-01-03", "DL", "1045", "ATL", "JFK", 12, 6, 0, 0, "N123DN"],
    ["2025-01-05", "DL", "2201", "MSP", "DTW", 0, -3, 0, 0, "N784DN"],
    ["2025-01-08", "OO", "3912", "SLC", "LAX", None, None, 1, 0, None],
    ["2025-01-11", "WN", "611", "DAL", "HOU", 47, 39, 0, 0, "N771SA"],
    ["2025-01-14", "DL", "998", "SEA", "ATL", 4, None, 0, 1, "N519DN"],
]


def _trusted(spark, folder):
    raw, order = read_csv_folder(spark, folder, lineage=True, order=True), SOURCE_ORDER
    return trusted_operations(raw, order)


def test_disruption_mart_golden(spark, tmp):
    write_csv(os.path.join(tmp, "ops"), "bts_2025_01.csv", HEADER, SAMPLE)
    t = _trusted(spark, os.path.join(tmp, "ops"))
    assert t.count() == 5
    m = {(r.carrier, r.origin_airport): r for r in marts.operational_disruption_summary(t).collect()}
    assert set(m) == {("DL", "ATL"), ("DL", "MSP"), ("OO", "SLC"), ("WN", "DAL"), ("DL", "SEA")}
    r = m[("DL", "ATL")]
    assert (r.region, r.flight_leg_count, r.avg_departure_delay_minutes, r.avg_arrival_delay_minutes) == \
        ("Southeast", 1, 12.0, 6.0)
    assert m[("OO", "SLC")].avg_departure_delay_minutes is None and m[("OO", "SLC")].cancellation_rate == 1.0
    assert m[("DL", "SEA")].diversion_rate == 1.0 and m[("DL", "SEA")].avg_arrival_delay_minutes is None
    assert m[("DL", "MSP")].region == "Midwest" and m[("WN", "DAL")].region == "South"
    assert all(x.report_month == "2025-01" for x in m.values())


def test_quirks_window_and_dedupe_order(spark, tmp):
    rows = [
        ["2025-02-01", "DL", "1", "ATL", "JFK", 1, 1, None, 0, "a"],   # first copy, NULL cancelled
        ["2025-02-01", "DL", "1", "ATL", "JFK", 1, 1, 0, 0, "b"],      # good copy: hidden by dedupe (Q5)
        ["2025-02-28 10:00:00", "DL", "2", "ATL", "JFK", 1, 1, 0, 0, "c"],  # out of window
        ["2025-02-28", "DL", "3", "ATL", "JFK", 1, 1, 0, 0, "d"],           # in
        ["bad", "DL", "4", "ATL", "JFK", 1, 1, 0, 0, "e"],
    ]
    write_csv(os.path.join(tmp, "ops"), "a.csv", HEADER, rows)
    t = _trusted(spark, os.path.join(tmp, "ops"))
    assert sorted(r.flight_number for r in t.collect()) == ["3"]


def test_rate_half_even(spark, tmp):
    rows = [["2025-01-02", "DL", str(i), "ATL", "JFK", 0, 0, 1 if i == 0 else 0, 0, "x"] for i in range(800)]
    write_csv(os.path.join(tmp, "ops"), "a.csv", HEADER, rows)
    m = marts.operational_disruption_summary(_trusted(spark, os.path.join(tmp, "ops"))).collect()
    assert m[0].cancellation_rate == 0.0012 and m[0].flight_leg_count == 800


def test_write_with_observed_counters(spark, tmp):
    from riskmart.plans.trusted import write_trusted_operations
    rows = SAMPLE + [["bad", "DL", "7", "ATL", "JFK", 1, 1, 0, 0, "x"], ["2025-01-09", "DL", "8", "ATL", "JFK", 1, 1, None, 0, "y"]]
    write_csv(os.path.join(tmp, "ops"), "a.csv", HEADER, rows)
    raw, order = read_csv_folder(spark, os.path.join(tmp, "ops"), lineage=True, order=True), SOURCE_ORDER
    counters = dict((k, v) for _, k, v in write_trusted_operations(raw, order, os.path.join(tmp, "trusted")))
    assert counters == {"loaded": 8, "deduplicated": 7, "required_present": 6, "written": 5}
    back = spark.read.parquet(os.path.join(tmp, "trusted"))
    assert back.count() == 5 and "flight_date" in back.columns


def test_partitioned_write_makes_few_files_and_counts(spark, tmp):
    from riskmart.plans.trusted import write_trusted_operations
    days = 6
    raw = spark.range(3000, numPartitions=12).select(
        F.concat(F.lit("2025-01-0"), (F.col("id") % days + 1).cast("string")).alias("FlightDate"), F.lit("AA").alias("Reporting_Airline"),
        F.col("id").cast("string").alias("Flight_Number_Reporting_Airline"), F.lit("ATL").alias("Origin"), F.lit("JFK").alias("Dest"),
        F.lit("0").alias("Cancelled"), F.lit("0").alias("Diverted"), F.col("id").alias("src_row"))
    counters = {step: n for _, step, n in write_trusted_operations(raw, ["src_row"], f"{tmp}/ops")}
    assert counters == {"loaded": 3000, "deduplicated": 3000, "required_present": 3000, "written": 3000}
    folders = [f for f in os.listdir(f"{tmp}/ops") if f.startswith("flight_date=")]
    files = [f for d in folders for f in os.listdir(f"{tmp}/ops/{d}") if f.endswith(".parquet")]
    assert len(folders) == days and len(files) == days
    assert spark.read.parquet(f"{tmp}/ops").count() == 3000


def test_empty_tables_are_written_with_counters(spark, tmp):
    from riskmart.plans.trusted import write_trusted_investigations, write_trusted_reports
    reports = spark.createDataFrame([("1", "2030-01-01", "x", "y", "z", 1)], "ACN string, event_date string, anomaly string, human_factors string, narrative string, src_row int")
    got = write_trusted_reports(reports.withColumnRenamed("ACN", "report_id"), ["src_row"], f"{tmp}/r")
    assert got == [("reports", "loaded", 1), ("reports", "deduplicated", 1), ("reports", "required_present", 1), ("reports", "written", 0)]
    events = spark.createDataFrame([("1", "2030-01-01", "ACC", "FATL", 1)], "ntsb_event_id string, event_date string, event_type string, injury_severity string, src_row int")
    got = write_trusted_investigations(events, ["src_row"], f"{tmp}/i")
    assert [n for _, _, n in got] == [1, 1, 1, 0] and "severity_normalized" in spark.read.parquet(f"{tmp}/i").columns


def test_line_items_are_not_dealt_by_customer(spark, tmp_path):
    """The orders' region is found before they meet the line items."""
    from riskmart.plans import roles
    schemas = {"lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                           "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
               "orders": "o_orderkey long, o_custkey long", "customer": "c_custkey long, c_nationkey int", "supplier": "s_suppkey long, s_nationkey int",
               "nation": "n_nationkey int, n_name string, n_regionkey int", "region": "r_regionkey int, r_name string"}
    rows = {"lineitem": [(1, 1, 1, n, 5.0, 1000.0, 0.1, 0.05, "N", "O", None) for n in (1, 2)] + [(9, 1, 1, 1, 5.0, 1.0, 0.1, 0.05, "N", "O", None)],
            "orders": [(1, 1), (1, 2)], "customer": [(1, 1), (2, 2)], "supplier": [(1, 1)],
            "nation": [(1, "PERU", 1), (2, "CHINA", 2)], "region": [(1, "AMERICA"), (2, "ASIA")]}
    for name, schema in schemas.items():
        spark.createDataFrame(rows[name], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    raw = roles.operations_raw(spark, str(tmp_path))
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    try:
        plan = raw._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert not [line for line in plan.splitlines() if "Project" in line and "l_extendedprice" in line and "o_custkey" in line]
    # keys may repeat: every pair of a line item and a row of its order
    assert sorted((r.flight_number, r.src_linenumber, r.origin, r.dest) for r in raw.collect()) == [
        ("1", n, "peru", d) for n in (1, 2) for d in ("AMERICA", "ASIA")]
