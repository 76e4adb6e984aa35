"""Role views: the driver's tables dressed as the raw extracts each operator expects.

The driver has no aviation data, so each adapter runs on a view built from the
TPC-H-like tables.  Every view is defined twice, side by side: as a DataFrame
(``*_raw``) and as SQL (``SQL[...]``) that DuckDB runs for the correctness oracle.
Both must stay identical in meaning.

All derivations are joins along the tables' own foreign keys plus CASE rules on
their columns; no row is dropped here (drops happen in the adapters under test).  A tenth of
the reports, investigations and culture rows comes twice, with a differing later copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions import dictionaries as D

# Study window used with the driver tables (their dates run 1995-2001).
DRIVER_WINDOW = ("1996-01-01", "2000-12-31")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ----------------------------------------------------------------- dimensions
def airport_region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """airport code -> region: nation name -> region name (25 rows by spec)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("code"), F.col("r_name").alias("region"))


# ----------------------------------------------------------------- operations
def operations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    # line items meet their orders by the flight number, a key of keep-first, which so needs no dealing of its own
    li = table(spark, sf_dir, "lineitem").withColumn("flight_number", F.col("l_orderkey").cast("string"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n1 = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n2 = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("cn_key"), F.col("n_regionkey").alias("cn_region"))
    r2 = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("cr_key"), F.col("r_name").alias("cr_name"))
    # orders find their region before they meet the line items, which are so dealt once and not by customer again
    region = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
               .join(n2, F.col("c_nationkey") == F.col("cn_key"))
               .join(r2, F.col("cn_region") == F.col("cr_key"))).select(F.col("o_orderkey").cast("string").alias("o_flight"), "cr_name")
    origin = s.join(n1, F.col("s_nationkey") == F.col("sn_key")).select("s_suppkey", "sn_name")
    j = li.join(origin, F.col("l_suppkey") == F.col("s_suppkey")).join(region, F.col("flight_number") == F.col("o_flight"))
    return j.select(
        F.when(F.col("l_linenumber") == 7, F.lit("n/a-date"))
         .when(F.col("l_linenumber") == 6, F.concat(F.date_format("l_shipdate", "M/d/yyyy"), F.lit(" 12:00:00 AM")))
         .when(F.col("l_linenumber") == 5, F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T00:00:00Z")))
         .when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("flight_date"),
        F.lower("l_returnflag").alias("reporting_airline"),
        "flight_number",
        F.lower("sn_name").alias("origin"),
        F.col("cr_name").alias("dest"),
        F.when(F.col("l_quantity") == 50, F.lit(None).cast("string"))
         .when((F.col("l_linestatus") == "O") & (F.col("l_tax") >= 0.07), F.lit("1"))
         .otherwise(F.lit("0.00")).alias("cancelled"),
        F.when(F.col("l_tax") <= 0.01, F.lit("1")).otherwise(F.lit("0")).alias("diverted"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity") - 25).alias("dep_delay"),
        (F.col("l_extendedprice") / 1000 - 50).alias("arr_delay"),
        F.col("l_linenumber").alias("src_linenumber"), F.col("l_partkey").alias("src_partkey"),
        F.col("l_suppkey").alias("src_suppkey"), F.col("l_quantity").alias("src_quantity"),
        F.col("l_extendedprice").alias("src_price"), F.col("l_discount").alias("src_discount"),
        F.col("l_tax").alias("src_tax"), F.col("l_linestatus").alias("src_linestatus"),
    )


OPERATIONS_ORDER = ["src_linenumber", "src_partkey", "src_suppkey", "src_quantity", "src_price",
                    "src_discount", "src_tax", "src_linestatus"]


def _with_copies(df: DataFrame, twice: Column) -> DataFrame:
    """``df`` with src_row, its place in the source: 1, and for rows of ``twice`` a later copy 2.

    The copies differ in other columns, so keep-first must go by src_row to be right.
    """
    return df.withColumn("src_row", F.explode(F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))


SRC_ORDER = ["src_row"]

# ----------------------------------------------------------------- reports
def reports_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    # labels join by the report's key as text: texts are dealt by it once, for this join and for keep-first,
    # and not sorted for the join
    d = table(spark, sf_dir, "documents").withColumn("report_id", F.col("doc_id").cast("string"))
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("l_doc"), "quality", "toxic")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = d.join(lab.hint("shuffle_hash"), F.col("report_id") == F.col("l_doc"), "left").join(
        F.broadcast(n), F.pmod(F.col("doc_id"), F.lit(25)) == F.col("n_nationkey"), "left")
    day = F.date_add(F.lit("1996-01-01").cast("date"), F.pmod(F.col("doc_id"), F.lit(2000)).cast("int"))
    base = _with_copies(base, F.pmod(F.col("doc_id"), F.lit(10)) == 3)
    copy = F.col("src_row") == 2
    synopsis_only = F.pmod(F.col("doc_id"), F.lit(20))  # 5: no narrative, 15: an empty one
    return base.select(
        "report_id",
        F.when(F.col("n_chars") < 200, F.lit("unknown"))
         .when(F.col("lang") == "de", F.date_format(day, "yyyyMM"))
         .when(F.col("lang") == "es", F.date_format(day, "MMMM d, yyyy"))
         .otherwise(F.date_format(day, "yyyy-MM-dd")).alias("event_date"),
        F.when(copy, F.lit("A LATER COPY")).otherwise(F.col("n_name")).alias("location"),
        F.when(F.col("source").isin("src0", "src1", "src2"), F.lit("Delta Air Lines"))
         .when(F.col("source").isin("src3", "src4"), F.lit(" skywest airlines"))
         .when(F.col("source") == "src5", F.lit(None).cast("string"))
         .otherwise(F.lit("Regional Charter")).alias("aircraft_operator"),
        F.col("source").alias("anomaly"),
        F.when(F.col("lang") == "en", F.lit("Fatigue; Situational Awareness"))
         .when(F.col("lang") == "fr", F.lit("Communication Breakdown"))
         .when(F.col("lang") == "de", F.lit("Distraction"))
         .otherwise(F.lit(None).cast("string")).alias("human_factors"),
        F.when(copy, F.lit("the der que")).when(synopsis_only == 5, F.lit(None).cast("string"))
         .when(synopsis_only == 15, F.lit("")).otherwise(F.col("text")).alias("narrative"),
        F.when(F.col("quality") == 1, F.lit("Human Factors"))
         .when(F.col("quality") == 0, F.lit("Procedure"))
         .otherwise(F.lit(None).cast("string")).alias("assessments_contributing_factors_situations"),
        F.when(F.col("toxic") == 1, F.lit("Ambiguous")).otherwise(F.lit(None).cast("string"))
         .alias("assessments_primary_problem"),
        F.when(synopsis_only.isin(5, 15), F.col("text")).alias("narrative_synopsis"),
        F.col("quality").alias("quality_label"),
        "src_row",
    )


REPORTS_ORDER = ["src_row"]

# ----------------------------------------------------------------- investigations
def investigation_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    pri = F.col("o_orderpriority")
    j = _with_copies(j, F.pmod(F.col("o_orderkey"), F.lit(10)) == 3)
    return j.select(
        F.col("o_orderkey").cast("string").alias("ev_id"),
        F.when(F.col("o_orderkey") % 16 == 1, F.date_format("o_orderdate", "MM/dd/yy"))
         .when(F.col("o_orderkey") % 16 == 2, F.date_format("o_orderdate", "MMM. d, yyyy"))
         .when(F.col("o_orderkey") % 16 == 3, F.date_format("o_orderdate", "d MMM yy"))
         .when(F.col("o_orderkey") % 16 == 4, F.date_format("o_orderdate", "yyyy/MM/dd'T'HH:mm"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("ev_date"),
        F.when(F.col("src_row") == 2, F.lit("A Later Copy"))
         .when(F.col("o_orderstatus") == "F", F.lit("ACC"))
         .when(F.col("o_orderstatus") == "O", F.lit("inc "))
         .otherwise(F.lit("ground damage")).alias("ev_type"),
        F.when(pri == "1-URGENT", F.lit("FATL"))
         .when(pri == "2-HIGH", F.lit("sers "))
         .when(pri == "3-MEDIUM", F.lit("MINR"))
         .when((pri == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "F"), F.lit(None).cast("string"))
         .when(pri == "4-NOT SPECIFIED", F.lit(" "))
         .otherwise(F.lit("UNK")).alias("ev_highest_injury"),
        F.col("n_name").alias("ev_nr_apt_id"),
        F.when((pri == "4-NOT SPECIFIED") & (F.col("o_totalprice") > 150000), F.lit(2))
         .otherwise(F.lit(0)).alias("inj_tot_n"),
        F.lit(0).alias("inj_tot_t"),
        "src_row",
    )


def investigation_aircraft_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("ev_id"),
        F.when(F.col("l_discount") == 0, F.lit(" "))
         .when(F.col("l_returnflag") == "A", F.lit("Delta Air Lines"))
         .when(F.col("l_returnflag") == "R", F.lit("SkyWest Airlines "))
         .otherwise(F.lit("Charter Ops")).alias("oper_name"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("string"))
         .when(F.col("l_linestatus") == "F", F.lit("SUBS"))
         .otherwise(F.lit("Minor Damage")).alias("damage"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus").alias("src_order"),
    )


def investigation_injury_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("ev_id"),
        F.when(F.col("l_returnflag") == "A", F.lit("FATL"))
         .when(F.col("l_returnflag") == "R", F.lit(" sers"))
         .when(F.col("l_linestatus") == "F", F.lit("MINR"))
         .otherwise(F.lit("NONE")).alias("injury_level"),
        F.when(F.col("l_quantity") > 25, F.col("l_quantity").cast("string"))
         .otherwise(F.lit("0")).alias("inj_person_count"),
    )


def aliased_investigations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows under the source's own names: the type is in the first of three columns that has one."""
    k = F.pmod(F.col("o_orderkey"), F.lit(4))
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("ev_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ev_date"),
        F.when(k == 0, F.lit("ACC")).otherwise(none).alias("ev_type"),
        F.when(k == 1, F.lit("turbulence injury")).when(k == 0, F.lit("not this")).otherwise(none).alias("investigation_type"),
        F.when(k == 2, F.lit("Hard Landing")).otherwise(none).alias("broad_phase_of_flight"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("fatal")).otherwise(F.lit("none ")).alias("ev_highest_injury"),
        F.lit(1).alias("src_row"))


# ----------------------------------------------------------------- promotion
def promotion_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when((F.col("event_type") == "view") & (F.col("value") > 400), F.lit("TBD"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("event_date"),
        F.when(F.col("event_type") == "click", F.lit("GA"))
         .when(F.col("event_type") == "signup", F.lit(" mi"))
         .when(F.col("event_type") == "error", F.lit("WA"))
         .when(F.col("event_type") == "purchase", F.lit("TX"))
         .otherwise(F.lit(None).cast("string")).alias("state"),
        F.col("event_type").alias("topic"),
        F.when(F.col("value") >= 250, F.lit("Pilots "))
         .when(F.col("value") >= 50, F.lit("Mechanics"))
         .otherwise(F.lit(None).cast("string")).alias("audience_type"),
        F.lit("FAASTEAM").alias("source_system"),
    )


#: Columns of the reports as an export has them: our column, upper and lower header cell.
EXPORT_HEADER = (("report_id", "", "ACN"), ("event_date", "Time", "Date"), ("location", "Place", "Locale Reference"),
                 ("anomaly", "Events", "Anomaly"), ("human_factors", "Person 1", "Human Factors"),
                 ("narrative", "Report 1", "Narrative"), ("narrative_synopsis", "Report 1", "Synopsis"))


def planted_phrases() -> list[str]:
    """Every phrase of the reference's rules, and two hypothetical sentences."""
    e = [D.FATIGUE_KEYWORD_RULES, D.FATIGUE_STRONG_RULES, D.FATIGUE_SLEEP_REST_RULES, D.FATIGUE_ALERTNESS_RULES, D.FATIGUE_CONTEXT_RULES,
         *D.THEME_RULES.values(), D.EXPLICIT_TERMS, D.CONTEXT_TERMS, *D.OPERATIONAL_THEME_TERMS.values()]
    found = list(dict.fromkeys(p for phrases in e for p in phrases))
    return [*found, "could have been fatigue", "fatigue may have been a factor; we were tired"]


def planted_reports_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with a sentence of three phrases of the reference's rules before the narrative."""
    phrases = planted_phrases()
    n, doc = len(phrases), F.col("report_id").cast("long")
    pick = lambda i: F.element_at(F.array(*[F.lit(p) for p in phrases]), (F.pmod(doc * (2 * i + 1) + i, F.lit(n)) + 1).cast("int"))
    sentence = F.concat(F.lit("I was "), pick(0), F.lit(". We had "), pick(1), F.lit(" "), pick(2), F.lit("! "))
    return reports_raw(spark, sf_dir).withColumn("narrative", F.concat(sentence, F.coalesce("narrative", F.lit(""))))


# ----------------------------------------------------------------- culture
def culture_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    o = table(spark, sf_dir, "orders")
    act = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"),
                                     F.max("o_orderdate").alias("last_order"))
    j = c.join(act, c.c_custkey == act.o_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
    seg = F.col("c_mktsegment")
    j = _with_copies(j, F.pmod(F.col("c_custkey"), F.lit(10)) == 3)
    return j.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("event_id"),
        F.concat(F.lit("EP"), F.col("c_custkey").cast("string")).alias("employee_period_key"),
        F.date_format("last_order", "yyyy-MM-dd").alias("event_date"),
        F.date_format("first_order", "yyyy-MM-dd").alias("period_start_date"),
        F.lit("SYNTHETIC_CULTURE").alias("source_system"),
        F.col("n_name").alias("base_location"),
        seg.alias("fleet_group"),
        F.when(F.col("src_row") == 2, F.lit(-99.0)).otherwise(F.col("c_acctbal") / 1000).alias("severity_score"),
        F.when((seg == "HOUSEHOLD") & (F.col("c_acctbal") < 0), F.lit(None).cast("double"))
         .otherwise((F.col("c_acctbal") + 1000) / 11000).alias("training_completion_rate"),
        F.when((seg == "AUTOMOBILE") & (F.col("c_acctbal") < 5000), F.lit(None).cast("double"))
         .otherwise(F.col("c_acctbal") / 2500 + 1).alias("safety_engagement_score"),
        F.when(seg.isin("BUILDING", "MACHINERY"), F.lit(1)).otherwise(F.lit(0)).alias("fatigue_training_flag"),
        F.col("c_name").alias("report_text"),
        F.col("c_name").alias("employee_id"),
        "src_row",
    )


# ----------------------------------------------------------------- scored rows
def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, label, score, fold) over ``events``: ties wanted, so scores are coarse."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("row_id"),
        F.when(F.col("event_type") == "error", F.lit(1)).otherwise(F.lit(0)).alias("label"),
        (F.floor(F.col("value") / 5) / 100.0).alias("score"),
    )


# =========================================================================
# SQL twins (DuckDB dialect) -- same meaning as the DataFrames above.
# =========================================================================
SQL = {}

SQL["airport_region_dim"] = """
SELECT n.n_name AS code, r.r_name AS region
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""

SQL["operations_raw"] = """
SELECT
  CASE WHEN l.l_linenumber = 7 THEN 'n/a-date'
       WHEN l.l_linenumber = 6 THEN strftime(l.l_shipdate, '%-m/%-d/%Y') || ' 12:00:00 AM'
       WHEN l.l_linenumber = 5 THEN strftime(l.l_shipdate, '%Y-%m-%d') || 'T00:00:00Z'
       WHEN l.l_linestatus = 'F' THEN strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S')
       ELSE strftime(l.l_shipdate, '%Y-%m-%d') END AS flight_date,
  lower(l.l_returnflag) AS reporting_airline,
  CAST(l.l_orderkey AS VARCHAR) AS flight_number,
  lower(n1.n_name) AS origin,
  r2.r_name AS dest,
  CASE WHEN l.l_quantity = 50 THEN NULL
       WHEN l.l_linestatus = 'O' AND l.l_tax >= 0.07 THEN '1' ELSE '0.00' END AS cancelled,
  CASE WHEN l.l_tax <= 0.01 THEN '1' ELSE '0' END AS diverted,
  CASE WHEN l.l_discount = 0 THEN NULL ELSE l.l_quantity - 25 END AS dep_delay,
  l.l_extendedprice / 1000 - 50 AS arr_delay,
  l.l_linenumber AS src_linenumber, l.l_partkey AS src_partkey, l.l_suppkey AS src_suppkey,
  l.l_quantity AS src_quantity, l.l_extendedprice AS src_price, l.l_discount AS src_discount,
  l.l_tax AS src_tax, l.l_linestatus AS src_linestatus
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n1 ON s.s_nationkey = n1.n_nationkey
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n2 ON c.c_nationkey = n2.n_nationkey
JOIN region r2 ON n2.n_regionkey = r2.r_regionkey
"""

SQL["reports_raw"] = """
SELECT
  CAST(d.doc_id AS VARCHAR) AS report_id,
  CASE WHEN d.n_chars < 200 THEN 'unknown'
       WHEN d.lang = 'de' THEN strftime(DATE '1996-01-01' + CAST(d.doc_id % 2000 AS INTEGER), '%Y%m')
       WHEN d.lang = 'es' THEN strftime(DATE '1996-01-01' + CAST(d.doc_id % 2000 AS INTEGER), '%B %-d, %Y')
       ELSE strftime(DATE '1996-01-01' + CAST(d.doc_id % 2000 AS INTEGER), '%Y-%m-%d') END AS event_date,
  CASE WHEN s.src_row = 2 THEN 'A LATER COPY' ELSE n.n_name END AS location,
  CASE WHEN d.source IN ('src0', 'src1', 'src2') THEN 'Delta Air Lines'
       WHEN d.source IN ('src3', 'src4') THEN ' skywest airlines'
       WHEN d.source = 'src5' THEN NULL
       ELSE 'Regional Charter' END AS aircraft_operator,
  d.source AS anomaly,
  CASE WHEN d.lang = 'en' THEN 'Fatigue; Situational Awareness'
       WHEN d.lang = 'fr' THEN 'Communication Breakdown'
       WHEN d.lang = 'de' THEN 'Distraction' ELSE NULL END AS human_factors,
  CASE WHEN s.src_row = 2 THEN 'the der que' WHEN d.doc_id % 20 = 5 THEN NULL WHEN d.doc_id % 20 = 15 THEN ''
       ELSE d.text END AS narrative,
  CASE WHEN lb.quality = 1 THEN 'Human Factors' WHEN lb.quality = 0 THEN 'Procedure' ELSE NULL END
    AS assessments_contributing_factors_situations,
  CASE WHEN lb.toxic = 1 THEN 'Ambiguous' ELSE NULL END AS assessments_primary_problem,
  CASE WHEN d.doc_id % 20 IN (5, 15) THEN d.text END AS narrative_synopsis,
  lb.quality AS quality_label,
  s.src_row
FROM documents d
JOIN (VALUES (1), (2)) s(src_row) ON s.src_row = 1 OR d.doc_id % 10 = 3
LEFT JOIN labels lb ON d.doc_id = lb.doc_id
LEFT JOIN nation n ON d.doc_id % 25 = n.n_nationkey
"""

_PHRASES = ", ".join("'" + p.replace("'", "''") + "'" for p in planted_phrases())
_PICK = ("([" + _PHRASES + "])[((CAST(report_id AS BIGINT) * {m} + {i}) % " + str(len(planted_phrases())) + ") + 1]")
SQL["planted_reports_raw"] = f"""
SELECT * REPLACE ('I was ' || {_PICK.format(m=1, i=0)} || '. We had ' || {_PICK.format(m=3, i=1)} || ' ' || {_PICK.format(m=5, i=2)} || '! '
                  || coalesce(narrative, '') AS narrative)
FROM ({SQL["reports_raw"]})
"""

SQL["investigation_events_raw"] = """
SELECT
  CAST(o.o_orderkey AS VARCHAR) AS ev_id,
  CASE WHEN o.o_orderkey % 16 = 1 THEN strftime(o.o_orderdate, '%m/%d/%y')
       WHEN o.o_orderkey % 16 = 2 THEN strftime(o.o_orderdate, '%b. %-d, %Y')
       WHEN o.o_orderkey % 16 = 3 THEN strftime(o.o_orderdate, '%-d %b %y')
       WHEN o.o_orderkey % 16 = 4 THEN strftime(o.o_orderdate, '%Y/%m/%dT%H:%M')
       ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS ev_date,
  CASE WHEN s.src_row = 2 THEN 'A Later Copy' WHEN o.o_orderstatus = 'F' THEN 'ACC' WHEN o.o_orderstatus = 'O' THEN 'inc '
       ELSE 'ground damage' END AS ev_type,
  CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'FATL'
       WHEN o.o_orderpriority = '2-HIGH' THEN 'sers '
       WHEN o.o_orderpriority = '3-MEDIUM' THEN 'MINR'
       WHEN o.o_orderpriority = '4-NOT SPECIFIED' AND o.o_orderstatus = 'F' THEN NULL
       WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN ' '
       ELSE 'UNK' END AS ev_highest_injury,
  n.n_name AS ev_nr_apt_id,
  CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' AND o.o_totalprice > 150000 THEN 2 ELSE 0 END AS inj_tot_n,
  0 AS inj_tot_t,
  s.src_row
FROM orders o
JOIN (VALUES (1), (2)) s(src_row) ON s.src_row = 1 OR o.o_orderkey % 10 = 3
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

SQL["investigation_aircraft_raw"] = """
SELECT
  CAST(l_orderkey AS VARCHAR) AS ev_id,
  CASE WHEN l_discount = 0 THEN ' ' WHEN l_returnflag = 'A' THEN 'Delta Air Lines'
       WHEN l_returnflag = 'R' THEN 'SkyWest Airlines ' ELSE 'Charter Ops' END AS oper_name,
  CASE WHEN l_discount = 0 THEN NULL WHEN l_linestatus = 'F' THEN 'SUBS' ELSE 'Minor Damage' END AS damage,
  l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus
FROM lineitem
"""

SQL["investigation_injury_raw"] = """
SELECT
  CAST(l_orderkey AS VARCHAR) AS ev_id,
  CASE WHEN l_returnflag = 'A' THEN 'FATL' WHEN l_returnflag = 'R' THEN ' sers'
       WHEN l_linestatus = 'F' THEN 'MINR' ELSE 'NONE' END AS injury_level,
  CASE WHEN l_quantity > 25 THEN CAST(l_quantity AS VARCHAR) ELSE '0' END AS inj_person_count
FROM lineitem
"""

SQL["aliased_investigations_raw"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS ntsb_event_id, strftime(o_orderdate, '%Y-%m-%d') AS event_date,
       CASE o_orderkey % 4 WHEN 0 THEN 'ACC' WHEN 1 THEN 'turbulence injury' WHEN 2 THEN 'Hard Landing' END AS event_type,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'fatal' ELSE 'none ' END AS injury_severity,
       CAST(NULL AS VARCHAR) AS airport_code, CAST(NULL AS VARCHAR) AS operator_name, CAST(NULL AS VARCHAR) AS aircraft_damage,
       1 AS src_row
FROM orders
"""

SQL["promotion_raw"] = """
SELECT
  CAST(event_id AS VARCHAR) AS event_id,
  CASE WHEN event_type = 'view' AND value > 400 THEN 'TBD'
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_date,
  CASE WHEN event_type = 'click' THEN 'GA' WHEN event_type = 'signup' THEN ' mi'
       WHEN event_type = 'error' THEN 'WA' WHEN event_type = 'purchase' THEN 'TX' ELSE NULL END AS state,
  event_type AS topic,
  CASE WHEN value >= 250 THEN 'Pilots ' WHEN value >= 50 THEN 'Mechanics' ELSE NULL END AS audience_type,
  'FAASTEAM' AS source_system
FROM events
"""

SQL["culture_raw"] = """
SELECT
  'C' || CAST(c.c_custkey AS VARCHAR) AS event_id,
  'EP' || CAST(c.c_custkey AS VARCHAR) AS employee_period_key,
  strftime(a.last_order, '%Y-%m-%d') AS event_date,
  strftime(a.first_order, '%Y-%m-%d') AS period_start_date,
  'SYNTHETIC_CULTURE' AS source_system,
  n.n_name AS base_location,
  c.c_mktsegment AS fleet_group,
  CASE WHEN s.src_row = 2 THEN -99.0 ELSE c.c_acctbal / 1000 END AS severity_score,
  CASE WHEN c.c_mktsegment = 'HOUSEHOLD' AND c.c_acctbal < 0 THEN NULL
       ELSE (c.c_acctbal + 1000) / 11000 END AS training_completion_rate,
  CASE WHEN c.c_mktsegment = 'AUTOMOBILE' AND c.c_acctbal < 5000 THEN NULL ELSE c.c_acctbal / 2500 + 1 END
    AS safety_engagement_score,
  CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS fatigue_training_flag,
  c.c_name AS report_text,
  c.c_name AS employee_id,
  s.src_row
FROM customer c
JOIN (VALUES (1), (2)) s(src_row) ON s.src_row = 1 OR c.c_custkey % 10 = 3
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
      FROM orders GROUP BY o_custkey) a ON c.c_custkey = a.o_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

SQL["scored_rows"] = """
SELECT event_id AS row_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
       floor(value / 5) / 100.0 AS score
FROM events
"""


# =========================================================================
# Corpus rule sets for the invented ``documents`` prose.  The reference dictionaries
# match none of these texts, so the registered text queries run the same operators with
# dictionaries of common corpus words (frequent, rare and absent phrases mixed).
# =========================================================================
CORPUS_ENRICHMENT = dict(
    keyword=["the", "of the", "de la", "der", "que", "it is", "been", "for the", "on the", "ein",
             "las", "por", "con", "y", "sleep"],
    strong=["of the", "de la", "der", "it is", "been", "las", "y"],
    sleep_rest=["the", "for the", "on the", "por"],
    alertness=["que", "con", "ein", "been"],
    context=["for the", "on the", "por"],
    hypothetical=[r"\bbeen(?:\s+\w+){0,3}\s+(?:the|of)\b", r"\bit\s+is\b", r"\bqui\s+\w+\s+la\b"],
    themes={
        "fatigue": ["the", "of the", "de la", "der", "que", "it is", "been", "for the", "on the", "ein",
                    "las", "por", "con", "y", "sleep"],
        "communication": ["and the", "de de", "la la", "with the", "readback"],
        "distraction": ["tion", "ment", "eau"],
        "workload": ["sch", "ci", "und"],
        "procedure_checklist": ["los", "el", "du", "une"],
        "ground_taxi_conflict": ["zu", "von", "den"],
        "approach_landing_instability": ["le", "les", "et", "qui"],
    },
    theme_priority=["fatigue", "communication", "distraction", "workload", "ground_taxi_conflict",
                    "approach_landing_instability", "procedure_checklist"],
)

CORPUS_FEATURES = dict(
    explicit=["der", "die", "been", "it is", "las", "y", "por", "el", "worn out"],
    context=["the", "of the", "de la", "que", "for the", "on the", "the the", "of of", "de de", "ein",
             "con", "la de", "der die", "que la", "is the", "to the", "in the", "late night"],
    hypothetical=[r"\bbeen(?:\s+\w+){0,3}\s+(?:the|of)\b", r"\bit\s+is\b", r"\bqui\s+\w+\s+la\b"],
    operational={
        "communication": ["and the", "de de", "la la", "with the"],
        "workload": ["sch", "ci", "und"],
        "distraction": ["tion", "ment", "eau"],
        "procedure": ["los", "el", "du", "une"],
        "approach_landing": ["le", "les", "et", "qui"],
        "ground_taxi": ["zu", "von", "den", "tow bar"],
    },
)
