"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query's SQL is built from the role-view SQL (``roles.SQL``) plus CTEs that restate
the trusted adapters and marts in plain SQL.  Conventions shared with the Spark side:
counts and sums are BIGINT, averages are exact integer-sum means rounded to 6 digits, rates are half-even to 4.
"""

from __future__ import annotations

from riskmart.functions import dictionaries as D
from riskmart.plans.roles import DRIVER_WINDOW, SQL as ROLE

W0, W1 = DRIVER_WINDOW


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ts_parse(expr: str) -> str:
    e = f"trim(CAST({expr} AS VARCHAR))"
    return (f"COALESCE(CASE WHEN regexp_full_match({e}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}}') THEN try_strptime({e}, '%m/%d/%y') END, "
            f"try_strptime({e}, '%b. %d, %Y'), CASE WHEN regexp_full_match({e}, '[0-9]+ [A-Z][a-z]+ [0-9]{{2}}') THEN try_strptime({e}, '%d %b %y') END, "
            f"try_strptime({e}, '%Y/%m/%dT%H:%M'), try_strptime({e}, '%Y-%m-%d %H:%M:%S'), try_strptime({e}, '%Y-%m-%d'), "
            f"try_strptime({e}, '%Y-%m-%dT%H:%M:%S'), try_strptime({e}, '%Y-%m-%dT%H:%M:%SZ'), "
            f"try_strptime({e}, '%Y/%m/%d'), try_strptime({e}, '%m/%d/%Y %I:%M:%S %p'), "
            f"try_strptime({e}, '%m/%d/%Y'), try_strptime({e}, '%B %d, %Y'), try_strptime({e}, '%Y%m%d'))")


def ts_parse_month_first(expr: str) -> str:
    e = f"trim(CAST({expr} AS VARCHAR))"
    return f"COALESCE(CASE WHEN regexp_full_match({e}, '[0-9]{{6}}') THEN try_strptime({e}, '%Y%m') END, {ts_parse(expr)})"


def in_window(ts: str) -> str:
    return f"{ts} BETWEEN TIMESTAMP '{W0} 00:00:00' AND TIMESTAMP '{W1} 00:00:00'"


def map_case(expr: str, mapping: dict, default: str | None) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    d = "NULL" if default is None else q(default)
    return f"(CASE {expr} {whens} ELSE {d} END)"


def key_norm(expr: str) -> str:
    return f"upper(trim(coalesce(CAST({expr} AS VARCHAR), 'UNKNOWN')))"


def indicator(expr: str) -> str:
    return f"CAST(trunc(greatest(0.0, least(1.0, coalesce(TRY_CAST({expr} AS DOUBLE), 0.0)))) AS INTEGER)"


def keep_first(src: str, keys: list[str], order: list[str]) -> str:
    o = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return f"SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {o}) = 1"


def not_null(cols: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def exact_avg(x: str, digits: int = 6, quantum: int = 12) -> str:
    u = f"sum(CAST(round(CAST({x} AS DOUBLE) * 1e{quantum}) AS HUGEINT))"
    d = f"(count({x}) * {10 ** (quantum - digits)})"
    return (f"(CASE WHEN count({x}) = 0 THEN NULL ELSE "
            f"CAST(sign({u}) * ((2 * abs({u}) + {d}) // (2 * {d})) AS DOUBLE) / 1e{digits} END)")


def rint4(expr: str) -> str:
    return f"round_even(({expr}) * 10000.0, 0) / 10000.0"


# ---------------------------------------------------------------- trusted CTEs
OPS_ORDER = ["src_linenumber", "src_partkey", "src_suppkey", "src_quantity", "src_price",
             "src_discount", "src_tax", "src_linestatus"]

CTE = {}
CTE["region_dim"] = ROLE["airport_region_dim"]
CTE["ops_raw"] = ROLE["operations_raw"]
CTE["ops_dedup"] = keep_first("ops_raw", D.OPERATIONS_KEYS, OPS_ORDER)
CTE["ops_valid"] = f"""
SELECT *, {ts_parse('flight_date')} AS _ts FROM ops_dedup WHERE {not_null(D.OPERATIONS_REQUIRED)}
"""
CTE["trusted_operations"] = f"""
SELECT CAST(_ts AS DATE) AS flight_date, reporting_airline, trim(flight_number) AS flight_number,
       origin, dest, cancelled, diverted, dep_delay, arr_delay,
       upper(trim(reporting_airline)) AS carrier,
       upper(trim(origin)) AS origin_airport, upper(trim(dest)) AS destination_airport,
       concat_ws('_', upper(trim(origin)), upper(trim(dest))) AS route,
       TRY_CAST(dep_delay AS DOUBLE) AS departure_delay_minutes,
       TRY_CAST(arr_delay AS DOUBLE) AS arrival_delay_minutes,
       {indicator('cancelled')} AS cancelled_flag,
       {indicator('diverted')} AS diverted_flag,
       CASE WHEN {indicator('cancelled')} = 1 THEN 'cancelled'
            WHEN {indicator('diverted')} = 1 THEN 'diverted' ELSE 'completed' END AS operational_status
FROM ops_valid WHERE _ts IS NOT NULL AND {in_window('_ts')}
"""

CTE["rep_raw"] = ROLE["reports_raw"]
CTE["rep_dedup"] = keep_first("rep_raw", D.REPORTS_KEYS, ["src_row"])
CTE["trusted_reports"] = f"""
SELECT * EXCLUDE (event_date, location, aircraft_operator, _ts, src_row, narrative),
       coalesce(nullif(narrative, ''), narrative_synopsis) AS narrative,
       CAST(_ts AS DATE) AS event_date,
       coalesce(location, 'UNKNOWN') AS location,
       coalesce(aircraft_operator, 'UNKNOWN') AS aircraft_operator,
       'NASA_ASRS' AS source_system,
       {q(D.NARRATIVE_PRIVACY_NOTE)} AS narrative_privacy_note
FROM (SELECT *, {ts_parse_month_first('event_date')} AS _ts FROM rep_dedup
      WHERE {not_null(D.REPORTS_NOT_NULL)})
WHERE _ts IS NOT NULL AND {in_window('_ts')}
"""

CTE["inv_events"] = ROLE["investigation_events_raw"]
CTE["inv_aircraft"] = ROLE["investigation_aircraft_raw"]
CTE["inv_injury"] = ROLE["investigation_injury_raw"]
_AC_ORDER = ("l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
             "l_returnflag, l_linestatus")
# first non-blank per event in source order: rank non-blank rows, keep the first
CTE["aircraft_lookup"] = f"""
SELECT e.ntsb_event_id, o.operator_name, d.aircraft_damage
FROM (SELECT DISTINCT ev_id AS ntsb_event_id FROM inv_aircraft WHERE ev_id IS NOT NULL) e
LEFT JOIN (SELECT ev_id, trim(oper_name) AS operator_name FROM inv_aircraft
           WHERE ev_id IS NOT NULL AND trim(oper_name) <> ''
           QUALIFY row_number() OVER (PARTITION BY ev_id ORDER BY {_AC_ORDER}) = 1) o
  ON e.ntsb_event_id = o.ev_id
LEFT JOIN (SELECT ev_id, trim(damage) AS aircraft_damage FROM inv_aircraft
           WHERE ev_id IS NOT NULL AND trim(damage) <> ''
           QUALIFY row_number() OVER (PARTITION BY ev_id ORDER BY {_AC_ORDER}) = 1) d
  ON e.ntsb_event_id = d.ev_id
"""
_RANK = map_case("lvl", {k: str(v) for k, v in D.INJURY_LEVEL_RANK.items()}, None)
CTE["injury_lookup"] = f"""
SELECT ev_id AS ntsb_event_id, arg_max(lvl, CAST({_RANK} AS INTEGER)) AS injury_severity_from_injury
FROM (SELECT ev_id, upper(trim(injury_level)) AS lvl,
             coalesce(TRY_CAST(inj_person_count AS DOUBLE), 0.0) AS cnt
      FROM inv_injury WHERE ev_id IS NOT NULL)
WHERE lvl IN ('NONE', 'MINR', 'SERS', 'FATL') AND cnt > 0
GROUP BY ev_id
"""
CTE["inv_merged"] = f"""
SELECT m.ev_id AS ntsb_event_id, m.ev_date AS event_date, m.ev_type AS event_type,
       CASE WHEN (sev IS NULL OR trim(sev) = '')
                 AND coalesce(TRY_CAST(m.inj_tot_n AS DOUBLE), 0) + coalesce(TRY_CAST(m.inj_tot_t AS DOUBLE), 0) = 0
            THEN 'NONE' ELSE sev END AS injury_severity,
       m.ev_nr_apt_id AS airport_code, a.operator_name, a.aircraft_damage, m.src_row
FROM (SELECT e.*, coalesce(e.ev_highest_injury, i.injury_severity_from_injury) AS sev
      FROM inv_events e LEFT JOIN injury_lookup i ON e.ev_id = i.ntsb_event_id) m
LEFT JOIN aircraft_lookup a ON m.ev_id = a.ntsb_event_id
"""
_BLANK = "CASE WHEN regexp_full_match(CAST({c} AS VARCHAR), '\\s*') THEN NULL ELSE {c} END"
CTE["inv_std"] = f"""
SELECT {_BLANK.format(c='ntsb_event_id')} AS ntsb_event_id, {_BLANK.format(c='event_date')} AS event_date,
       {_BLANK.format(c='injury_severity')} AS injury_severity, {_BLANK.format(c='event_type')} AS event_type,
       airport_code, operator_name, aircraft_damage, src_row
FROM inv_merged
"""
CTE["inv_valid"] = f"""
SELECT *, {ts_parse('event_date')} AS _ts
FROM ({keep_first('inv_std', D.INVESTIGATIONS_KEYS, ['src_row'])})
WHERE {not_null(D.INVESTIGATIONS_REQUIRED)}
"""
_SEV_SRC = "nullif(upper(trim(injury_severity)), '')"
_ET_SRC = "nullif(upper(trim(event_type)), '')"
_DMG_SRC = "nullif(upper(trim(aircraft_damage)), '')"
_TITLE = ("array_to_string(list_transform(string_split(lower(trim(event_type)), ' '), "
          "lambda w: upper(w[1]) || w[2:]), ' ')")
CTE["trusted_investigations"] = f"""
SELECT ntsb_event_id, CAST(_ts AS DATE) AS event_date,
       coalesce(nullif(trim(airport_code), ''), 'UNKNOWN') AS airport_code,
       coalesce(nullif(trim(operator_name), ''), 'UNKNOWN') AS operator_name,
       {map_case(_SEV_SRC, D.SEVERITY_MAP, D.OTHER_OR_UNKNOWN)} AS injury_severity,
       coalesce({map_case(_ET_SRC, D.EVENT_TYPE_DISPLAY_MAP, None)}, {_TITLE}) AS event_type,
       coalesce({map_case(_DMG_SRC, D.DAMAGE_MAP, None)}, replace(lower(trim(aircraft_damage)), ' ', '_'), 'unknown')
         AS aircraft_damage,
       'NTSB' AS source_system, {q('|'.join(D.INVESTIGATION_FILES))} AS raw_file_name,
       injury_severity AS injury_severity_raw, event_type AS event_type_raw,
       {map_case(_SEV_SRC, D.SEVERITY_MAP, D.OTHER_OR_UNKNOWN)} AS severity_normalized,
       {map_case(_ET_SRC, D.EVENT_CATEGORY_MAP, D.OTHER_OR_UNKNOWN)} AS investigation_category
FROM inv_valid WHERE _ts IS NOT NULL AND {in_window('_ts')}
"""

CTE["cul_raw"] = ROLE["culture_raw"]
CTE["trusted_culture"] = f"SELECT * EXCLUDE (src_row) FROM ({keep_first('cul_raw', D.CULTURE_KEYS, ['src_row'])})"
CTE["promo_raw"] = ROLE["promotion_raw"]


def with_ctes(names: list[str], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in names) + "\n" + body


OPS = ["region_dim", "ops_raw", "ops_dedup", "ops_valid", "trusted_operations"]
REP = ["region_dim", "rep_raw", "rep_dedup", "trusted_reports"]
INV = ["region_dim", "inv_events", "inv_aircraft", "inv_injury", "aircraft_lookup", "injury_lookup",
       "inv_merged", "inv_std", "inv_valid", "trusted_investigations"]
CUL = ["region_dim", "cul_raw", "trusted_culture"]


def uniq(*groups):
    out = []
    for g in groups:
        for n in g:
            if n not in out:
                out.append(n)
    return out


def region_of(expr: str, alias: str) -> str:
    return f"LEFT JOIN region_dim {alias} ON {alias}.code = {key_norm(expr)}"


CARRIER = lambda e: map_case(key_norm(e), D.OPERATOR_CARRIER_GROUP, D.OPERATOR_CARRIER_DEFAULT)
STATE = lambda e: map_case(e, D.STATE_REGION, D.STATE_REGION_DEFAULT)

# ---------------------------------------------------------------- queries
ORACLE: dict[str, str] = {}

ORACLE["operational_disruption_summary"] = with_ctes(OPS, f"""
SELECT strftime(t.flight_date, '%Y-%m') AS report_month, t.carrier, t.origin_airport, t.destination_airport,
       t.route, coalesce(d.region, 'Unknown') AS region,
       count(t.flight_number) AS flight_leg_count,
       CAST(sum(t.cancelled_flag) AS BIGINT) AS cancelled_flight_count,
       CAST(sum(t.diverted_flag) AS BIGINT) AS diverted_flight_count,
       {exact_avg('t.departure_delay_minutes')} AS avg_departure_delay_minutes,
       {exact_avg('t.arrival_delay_minutes')} AS avg_arrival_delay_minutes,
       {rint4('CAST(sum(t.cancelled_flag) AS DOUBLE) / count(t.flight_number)')} AS cancellation_rate,
       {rint4('CAST(sum(t.diverted_flag) AS DOUBLE) / count(t.flight_number)')} AS diversion_rate,
       {q(D.BASIS_DISRUPTION)} AS data_basis
FROM trusted_operations t {region_of('t.origin_airport', 'd')}
GROUP BY ALL
""")

ORACLE["dedupe_keep_first"] = f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
           l_linestatus, l_shipdate) = 1
"""

ORACLE["fatigue_theme_trends"] = with_ctes(REP, f"""
SELECT report_month, airport, carrier, coalesce(d.region, 'Unknown') AS region, human_factor_theme,
       fatigue_related_flag, count(report_id) AS report_count,
       count(DISTINCT anomaly) AS unique_anomaly_count, {q(D.BASIS_FATIGUE)} AS data_basis
FROM (SELECT strftime(event_date, '%Y-%m') AS report_month, {key_norm('location')} AS airport,
             {CARRIER('aircraft_operator')} AS carrier,
             replace(lower(trim(coalesce(human_factors, 'UNKNOWN'))), ' ', '_') AS human_factor_theme,
             CAST(contains(replace(lower(trim(coalesce(human_factors, 'UNKNOWN'))), ' ', '_'), 'fatigue') AS INTEGER)
               AS fatigue_related_flag,
             report_id, anomaly
      FROM trusted_reports) r
{region_of('r.airport', 'd')}
GROUP BY ALL
""")

ORACLE["investigation_trends"] = with_ctes(INV, f"""
SELECT report_month, airport, operator_group, coalesce(d.region, 'Unknown') AS region,
       investigation_category, severity_normalized,
       count(ntsb_event_id) AS investigation_count,
       CAST(sum(CASE WHEN severity_normalized IN ('serious_injury', 'fatal_injury') THEN 1 ELSE 0 END) AS BIGINT)
         AS serious_or_higher_count,
       {q(D.BASIS_INVESTIGATION)} AS data_basis
FROM (SELECT strftime(event_date, '%Y-%m') AS report_month, {key_norm('airport_code')} AS airport,
             {CARRIER('operator_name')} AS operator_group, investigation_category, severity_normalized,
             ntsb_event_id
      FROM trusted_investigations) t
{region_of('t.airport', 'd')}
GROUP BY ALL
""")

ORACLE["promotion_summary"] = with_ctes(["promo_raw"], f"""
SELECT report_month, state, {STATE('state')} AS region, topic, audience_type,
       count(event_id) AS event_count, {q(D.BASIS_PROMOTION)} AS data_basis
FROM (SELECT strftime({ts_parse('event_date')}, '%Y-%m') AS report_month, {key_norm('state')} AS state,
             trim(coalesce(topic, 'UNKNOWN')) AS topic, trim(coalesce(audience_type, 'UNKNOWN')) AS audience_type,
             event_id
      FROM promo_raw WHERE {ts_parse('event_date')} IS NOT NULL)
GROUP BY ALL
""")

_OVERVIEW_PARTS = f"""
ops_k AS (
  SELECT strftime(t.flight_date, '%Y-%m') AS report_month, t.origin_airport AS airport,
         coalesce(d.region, 'Unknown') AS region,
         count(t.flight_number) AS operational_flight_legs,
         CAST(sum(t.cancelled_flag) AS BIGINT) AS cancelled_flights,
         CAST(sum(t.diverted_flag) AS BIGINT) AS diverted_flights,
         {exact_avg('t.departure_delay_minutes')} AS avg_departure_delay_minutes,
         {exact_avg('t.arrival_delay_minutes')} AS avg_arrival_delay_minutes
  FROM trusted_operations t {region_of('t.origin_airport', 'd')} GROUP BY ALL),
rep_k AS (
  SELECT strftime(r.event_date, '%Y-%m') AS report_month, {key_norm('r.location')} AS airport,
         coalesce(d.region, 'Unknown') AS region,
         count(r.report_id) AS asrs_report_count,
         CAST(sum(CASE WHEN contains(lower(coalesce(r.human_factors, '')), 'fatigue') THEN 1 ELSE 0 END) AS BIGINT)
           AS fatigue_related_report_count
  FROM trusted_reports r {region_of(key_norm('r.location'), 'd')} GROUP BY ALL),
inv_k AS (
  SELECT strftime(n.event_date, '%Y-%m') AS report_month, {key_norm('n.airport_code')} AS airport,
         coalesce(d.region, 'Unknown') AS region,
         count(n.ntsb_event_id) AS ntsb_investigation_count,
         CAST(sum(CASE WHEN n.severity_normalized IN ('serious_injury', 'fatal_injury') THEN 1 ELSE 0 END) AS BIGINT)
           AS serious_or_higher_investigation_count
  FROM trusted_investigations n {region_of(key_norm('n.airport_code'), 'd')} GROUP BY ALL),
cul_k AS (
  SELECT strftime(CAST(c.event_date AS DATE), '%Y-%m') AS report_month, {key_norm('c.base_location')} AS airport,
         coalesce(d.region, 'Unknown') AS region,
         {exact_avg('c.training_completion_rate')} AS avg_training_completion_rate,
         {exact_avg('c.safety_engagement_score')} AS avg_safety_engagement_score,
         {exact_avg('c.fatigue_training_flag')} AS fatigue_training_completion_rate,
         CAST(count(*) FILTER (WHERE coalesce(c.severity_score, 0) > 0) AS BIGINT) AS synthetic_elevated_risk_count
  FROM trusted_culture c {region_of(key_norm('c.base_location'), 'd')}
  WHERE TRY_CAST(c.event_date AS DATE) IS NOT NULL GROUP BY ALL)
"""

_ALL = uniq(OPS, REP, INV, CUL)
ORACLE["monthly_risk_overview"] = with_ctes(_ALL, f""", {_OVERVIEW_PARTS}
SELECT *, {q(D.BASIS_OVERVIEW)} AS data_basis FROM (
SELECT coalesce(o.report_month, r.report_month, n.report_month, c.report_month) AS report_month,
       coalesce(o.airport, r.airport, n.airport, c.airport) AS airport,
       coalesce(o.region, r.region, n.region, c.region) AS region,
       o.operational_flight_legs, o.cancelled_flights, o.diverted_flights,
       o.avg_departure_delay_minutes, o.avg_arrival_delay_minutes,
       r.asrs_report_count, r.fatigue_related_report_count,
       n.ntsb_investigation_count, n.serious_or_higher_investigation_count,
       c.avg_training_completion_rate, c.avg_safety_engagement_score, c.fatigue_training_completion_rate,
       c.synthetic_elevated_risk_count
FROM ops_k o
FULL OUTER JOIN rep_k r ON o.report_month IS NOT DISTINCT FROM r.report_month
  AND o.airport IS NOT DISTINCT FROM r.airport AND o.region IS NOT DISTINCT FROM r.region
FULL OUTER JOIN inv_k n
  ON coalesce(o.report_month, r.report_month) IS NOT DISTINCT FROM n.report_month
  AND coalesce(o.airport, r.airport) IS NOT DISTINCT FROM n.airport
  AND coalesce(o.region, r.region) IS NOT DISTINCT FROM n.region
FULL OUTER JOIN cul_k c
  ON coalesce(o.report_month, r.report_month, n.report_month) IS NOT DISTINCT FROM c.report_month
  AND coalesce(o.airport, r.airport, n.airport) IS NOT DISTINCT FROM c.airport
  AND coalesce(o.region, r.region, n.region) IS NOT DISTINCT FROM c.region)
""")

# the view as written: record-level left joins, then GROUP BY (fan-out semantics, Q1)
ORACLE["monthly_overview_joined_view"] = with_ctes(_ALL, f"""
SELECT b.report_month, b.origin_airport AS airport, coalesce(dm.region, 'Unknown') AS region,
       CAST(count(*) AS DECIMAL(38,0)) AS operational_flight_legs,
       CAST(sum(b.cancelled_flag) AS DECIMAL(38,0)) AS cancelled_flights,
       CAST(sum(b.diverted_flag) AS DECIMAL(38,0)) AS diverted_flights,
       {exact_avg('b.departure_delay_minutes')} AS avg_departure_delay_minutes,
       {exact_avg('b.arrival_delay_minutes')} AS avg_arrival_delay_minutes,
       count(DISTINCT a.report_id) AS asrs_report_count,
       CAST(sum(CASE WHEN lower(a.human_factors) LIKE '%fatigue%' THEN 1 ELSE 0 END) AS DECIMAL(38,0)) AS fatigue_related_report_count,
       count(DISTINCT n.ntsb_event_id) AS ntsb_investigation_count,
       CAST(sum(CASE WHEN n.severity_normalized IN ('serious_injury', 'fatal_injury') THEN 1 ELSE 0 END) AS DECIMAL(38,0))
         AS serious_or_higher_investigation_count,
       {exact_avg('s.training_completion_rate')} AS avg_training_completion_rate,
       {exact_avg('s.safety_engagement_score')} AS avg_safety_engagement_score,
       {exact_avg('s.fatigue_training_flag')} AS fatigue_training_completion_rate,
       CAST(sum(CASE WHEN s.severity_score > 0 THEN 1 ELSE 0 END) AS DECIMAL(38,0)) AS synthetic_elevated_risk_count
FROM (SELECT substr(CAST(flight_date AS VARCHAR), 1, 7) AS report_month, origin_airport,
             departure_delay_minutes, arrival_delay_minutes, cancelled_flag, diverted_flag
      FROM trusted_operations) b
LEFT JOIN region_dim dm ON dm.code = b.origin_airport
LEFT JOIN trusted_reports a
  ON substr(CAST(a.event_date AS VARCHAR), 1, 7) = b.report_month AND a.location = b.origin_airport
LEFT JOIN trusted_investigations n
  ON substr(CAST(n.event_date AS VARCHAR), 1, 7) = b.report_month AND n.airport_code = b.origin_airport
LEFT JOIN trusted_culture s
  ON substr(CAST(s.event_date AS VARCHAR), 1, 7) = b.report_month AND s.base_location = b.origin_airport
GROUP BY 1, 2, 3
""")

ORACLE["disruption_view"] = with_ctes(OPS, f"""
SELECT substr(CAST(flight_date AS VARCHAR), 1, 7) AS report_month, carrier, origin_airport,
       destination_airport, route, count(*) AS flight_leg_count,
       CAST(sum(cancelled_flag) AS BIGINT) AS cancelled_flight_count,
       CAST(sum(diverted_flag) AS BIGINT) AS diverted_flight_count,
       {exact_avg('departure_delay_minutes')} AS avg_departure_delay_minutes,
       {exact_avg('arrival_delay_minutes')} AS avg_arrival_delay_minutes
FROM trusted_operations GROUP BY 1, 2, 3, 4, 5
""")

ORACLE["investigation_view"] = with_ctes(INV, """
SELECT substr(CAST(event_date AS VARCHAR), 1, 7) AS report_month, airport_code AS airport,
       operator_name AS operator_group, investigation_category, severity_normalized,
       count(*) AS investigation_count
FROM trusted_investigations GROUP BY 1, 2, 3, 4, 5
""")


# ---------------------------------------------------------------- narrative text
from riskmart.plans.roles import CORPUS_ENRICHMENT as _CE, CORPUS_FEATURES as _CF  # noqa: E402

_WS = "[\\t\\n\\x0b\\f\\r \\x1c-\\x1f]+"


def t_clean(x: str) -> str:
    return (f"trim(regexp_replace(lower(translate(coalesce(CAST({x} AS VARCHAR), ''), '‘’“”', '''''\"\"')), "
            f"'{_WS}', ' ', 'g'))")


def t_match(clean: str) -> str:
    return f"trim(regexp_replace({clean}, '[^a-z0-9]+', ' ', 'g'))"


def t_join(parts: list[str]) -> str:
    return "concat_ws(' ', " + ", ".join(f"nullif({p}, '')" for p in parts) + ")"


def t_pad(x: str) -> str:
    return f"(' ' || {x} || ' ')"


def t_count(pad: str, phrases: list[str]) -> str:
    ps = list(dict.fromkeys(phrases))
    if not ps:
        return "0"
    return "(" + " + ".join(f"CAST(contains({pad}, {q(' ' + p + ' ')}) AS INTEGER)" for p in ps) + ")"


def t_any(pad: str, phrases: list[str]) -> str:
    ps = list(dict.fromkeys(phrases))
    return "(" + " OR ".join(f"contains({pad}, {q(' ' + p + ' ')})" for p in ps) + ")" if ps else "FALSE"


def t_rx(patterns: list[str]) -> str:
    return q("|".join(f"(?:{p})" for p in patterns))


def t_hyp(clean: str, patterns: list[str]) -> str:
    return (f"coalesce(list_bool_or(list_transform(string_split_regex({clean}, '[.!?;]+'), "
            f"lambda x: regexp_matches({t_match('x')}, {t_rx(patterns)}))), FALSE)")


_OPT = ["assessments_contributing_factors_situations", "assessments_primary_problem", "narrative_synopsis"]
CTE["nlp_text"] = f"""
SELECT *, {t_join(['narrative_match_text', 'structured_match_text'])} AS analysis_text FROM (
  SELECT *, {t_match('narrative_clean')} AS narrative_match_text FROM (
    SELECT *, {t_clean('narrative')} AS narrative_clean,
           {t_join([t_match(t_clean(c)) for c in _OPT + ['human_factors']])} AS structured_match_text
    FROM trusted_reports))
"""


def _primary_sql(counts: dict[str, str], priority: list[str]) -> str:
    best = "greatest(" + ", ".join(counts[t] for t in priority) + ")"
    whens = " ".join(f"WHEN {counts[t]} = {best} AND {best} > 0 THEN {q(t)}" for t in priority)
    return f"(CASE {whens} ELSE 'none' END)"


def _nlp_sql(r: dict) -> str:
    ana, st, na = t_pad("analysis_text"), t_pad("structured_match_text"), t_pad("narrative_match_text")
    hyp = t_hyp("narrative_clean", r["hypothetical"])
    explicit = f"({t_any(st, r['strong'])} OR ({t_any(na, r['strong'])} AND NOT {hyp}))"
    contextual = f"({t_any(na, r['context'])} OR ({t_any(na, r['sleep_rest'])} AND {t_any(na, r['alertness'])}))"
    tier = (f"(CASE WHEN {explicit} THEN 'high' WHEN {hyp} THEN 'low_or_none' WHEN {contextual} THEN 'medium' "
            f"ELSE 'low_or_none' END)")
    counts = {t: t_count(ana, p) for t, p in r["themes"].items()}
    primary = _primary_sql(counts, r["theme_priority"])
    primary = f"(CASE WHEN {primary} = 'communication' AND {explicit} THEN 'fatigue' ELSE {primary} END)"
    flags = ",\n       ".join(f"CAST({counts[t]} > 0 AS INTEGER) AS theme_{t}_flag" for t in D.THEME_FLAG_ORDER)
    kw = t_count(ana, r["keyword"])
    return f"""
SELECT report_id, strftime(event_date, '%Y-%m-%d') AS event_date, location, aircraft_operator, narrative,
       human_factors, assessments_contributing_factors_situations, assessments_primary_problem, narrative_clean,
       CAST({kw} > 0 AS INTEGER) AS fatigue_keyword_flag, {kw} AS fatigue_keyword_count,
       {tier} AS fatigue_confidence_tier,
       CAST({tier} IN ('high', 'medium') AS INTEGER) AS weak_fatigue_label,
       {flags},
       {primary} AS theme_primary_label
FROM nlp_text
"""


CTE["nlp_enriched"] = _nlp_sql(_CE)
NLP = uniq(REP, ["nlp_text"])

ORACLE["text_normalised"] = with_ctes(NLP, """
SELECT report_id, narrative_clean, narrative_match_text, structured_match_text, analysis_text FROM nlp_text
""")
ORACLE["nlp_enrichment"] = with_ctes(uniq(NLP, ["nlp_enriched"]), "SELECT * FROM nlp_enriched")


def _ratio6_sql(num: str, den: str) -> str:
    return f"round_even(CAST({num} AS DOUBLE) / ({den}), 6)"


def _features_sql(r: dict) -> str:
    raw = t_clean("narrative_clean")
    ops = {f"operational_{t}_term_count": t_count(t_pad("_norm"), p) for t, p in r["operational"].items()}
    noise = " + ".join(ops)
    rx = t_rx(r["hypothetical"])

    def cl_count(cond: str) -> str:
        return f"len(list_filter(_clauses, lambda x: {cond}))"
    both = list(r["explicit"]) + list(r["context"])
    return f"""
SELECT report_id, event_date, weak_fatigue_label, narrative_word_count, narrative_char_count, sentence_count,
       first_person_pronoun_count, explicit_fatigue_term_count, fatigue_context_term_count,
       explicit_fatigue_term_count + fatigue_context_term_count AS fatigue_keyword_count,
       explicit_fatigue_clause_count, context_fatigue_clause_count, fatigue_clause_count,
       hypothetical_fatigue_clause_count,
       CAST(hypothetical_fatigue_clause_count > 0 AS INTEGER) AS hypothetical_fatigue_flag,
       {", ".join(ops)}, {noise} AS operational_noise_count,
       CASE WHEN narrative_word_count > 0
            THEN {_ratio6_sql('explicit_fatigue_term_count + fatigue_context_term_count', 'narrative_word_count')}
            ELSE 0.0 END AS fatigue_density,
       CASE WHEN narrative_word_count > 0 THEN {_ratio6_sql(noise, 'narrative_word_count')} ELSE 0.0 END
         AS operational_density,
       CASE WHEN sentence_count > 0 THEN {_ratio6_sql('fatigue_clause_count', 'sentence_count')} ELSE 0.0 END
         AS fatigue_clause_share,
       CASE WHEN ({noise}) > 0
            THEN {_ratio6_sql('explicit_fatigue_term_count + fatigue_context_term_count', noise)}
            ELSE CAST(explicit_fatigue_term_count + fatigue_context_term_count AS DOUBLE) END AS fatigue_to_noise_ratio
FROM (
  SELECT report_id, event_date, CAST(weak_fatigue_label AS INTEGER) AS weak_fatigue_label,
         CAST(CASE WHEN _norm = '' THEN 0 ELSE len(string_split(_norm, ' ')) END AS INTEGER) AS narrative_word_count,
         CAST(length(_raw) AS INTEGER) AS narrative_char_count,
         CAST(len(_clauses) AS INTEGER) AS sentence_count,
         CAST(len(regexp_extract_all(_norm, {q(D.FIRST_PERSON_PATTERN)})) AS INTEGER) AS first_person_pronoun_count,
         {t_count(t_pad('_norm'), r['explicit'])} AS explicit_fatigue_term_count,
         {t_count(t_pad('_norm'), r['context'])} AS fatigue_context_term_count,
         CAST({cl_count(t_any(t_pad('x'), r['explicit']))} AS INTEGER) AS explicit_fatigue_clause_count,
         CAST({cl_count(t_any(t_pad('x'), r['context']))} AS INTEGER) AS context_fatigue_clause_count,
         CAST({cl_count(t_any(t_pad('x'), both))} AS INTEGER) AS fatigue_clause_count,
         CAST({cl_count(f"regexp_matches(x, {rx})")} AS INTEGER) AS hypothetical_fatigue_clause_count,
         {", ".join(f"{v} AS {k}" for k, v in ops.items())}
  FROM (SELECT *, {t_match('_raw')} AS _norm,
               list_transform(list_filter(string_split_regex(_raw, '[.!?;]+'), lambda x: trim(x) <> ''),
                              lambda x: {t_match('x')}) AS _clauses
        FROM (SELECT *, {raw} AS _raw FROM nlp_enriched)))
"""


ORACLE["narrative_features"] = with_ctes(uniq(NLP, ["nlp_enriched"]), _features_sql(_CF))


# ---------------------------------------------------------------- quality kit and friends
_OPS_REQ_NN = not_null(D.OPERATIONS_REQUIRED)
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_FIRST = ORACLE["dedupe_keep_first"]
ORACLE["quality_metrics"] = with_ctes(["ops_raw", "ops_dedup"], f""", li_first AS ({_LI_FIRST})
SELECT 'rows_loaded' AS check_name, '*' AS column_name, CAST(count(*) AS DOUBLE) AS value FROM ops_raw
UNION ALL
SELECT check_name, '*', value FROM (
  SELECT CAST(count(*) AS DOUBLE) AS deduplicated_rows,
         CAST(count(*) FILTER (WHERE NOT ({_OPS_REQ_NN})) AS DOUBLE) AS required_null_rows,
         CAST(count(*) FILTER (WHERE ({_OPS_REQ_NN}) AND _ts IS NULL) AS DOUBLE) AS invalid_date_rows,
         CAST(count(*) FILTER (WHERE ({_OPS_REQ_NN}) AND _ts IS NOT NULL AND NOT ({in_window('_ts')})) AS DOUBLE)
           AS outside_window_rows,
         CAST(count(*) FILTER (WHERE ({_OPS_REQ_NN}) AND _ts IS NOT NULL AND {in_window('_ts')}) AS DOUBLE)
           AS trusted_rows
  FROM (SELECT *, {ts_parse('flight_date')} AS _ts FROM ops_dedup))
UNPIVOT (value FOR check_name IN (deduplicated_rows, required_null_rows, invalid_date_rows, outside_window_rows,
                                  trusted_rows))
UNION ALL
{" UNION ALL ".join(f"SELECT 'null_count', '{c}', CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) FROM ops_raw"
                    for c in D.OPERATIONS_REQUIRED)}
UNION ALL
SELECT 'key_duplicates', 'l_orderkey,l_linenumber', CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS DOUBLE)
FROM lineitem
UNION ALL
{" UNION ALL ".join(f"SELECT 'null_ratio', '{c}', avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) FROM li_first"
                    for c in _LI_COLS)}
UNION ALL
{" UNION ALL ".join(f"SELECT 'varies', '{c}', CAST(count(DISTINCT {c}) > 1 AS DOUBLE) FROM li_first"
                    for c in _LI_COLS)}
""")

ORACLE["trusted_counters"] = with_ctes(uniq(OPS, REP, INV, ["cul_raw", "trusted_culture"]), f"""
{" UNION ALL ".join(f"SELECT '{source}' AS source, '{step}' AS step, count(*) AS row_count FROM {table}" for source, step, table in (
    ("operations", "loaded", "ops_raw"), ("operations", "deduplicated", "ops_dedup"), ("operations", "required_present", "ops_valid"),
    ("operations", "written", "trusted_operations"), ("reports", "loaded", "rep_raw"), ("reports", "deduplicated", "rep_dedup"),
    ("reports", "required_present", f"rep_dedup WHERE {not_null(D.REPORTS_NOT_NULL)}"), ("reports", "written", "trusted_reports"),
    ("investigations", "loaded", "inv_std"), ("investigations", "deduplicated", f"({keep_first('inv_std', D.INVESTIGATIONS_KEYS, ['src_row'])})"), ("investigations", "required_present", "inv_valid"),
    ("investigations", "written", "trusted_investigations"), ("culture", "loaded", "cul_raw"), ("culture", "deduplicated", "trusted_culture"),
    ("culture", "written", "trusted_culture")))}
""")

def _profile_sql(month: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {month} AS month, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"min(CAST({c} AS VARCHAR)) AS min_value, max(CAST({c} AS VARCHAR)) AS max_value FROM trusted_investigations GROUP BY 1" for c in D.INVESTIGATIONS_OUTPUT)


_MONTH = "strftime(event_date, '%Y-%m')"
ORACLE["column_profiles"] = with_ctes(INV, f"""
, p AS ({_profile_sql(_MONTH)} UNION ALL {_profile_sql("'all'")})
SELECT *, null_count / CAST(row_count AS DOUBLE) AS null_ratio, coalesce(min_value <> max_value, FALSE) AS varies FROM p
""")

ORACLE["label_distribution"] = with_ctes(uniq(NLP, ["nlp_enriched"]), """
SELECT 'quality_label' AS column_name, CAST(quality_label AS VARCHAR) AS value, count(*) AS row_count
FROM trusted_reports GROUP BY ALL
UNION ALL
SELECT 'theme_primary_label', theme_primary_label, count(*) FROM nlp_enriched GROUP BY ALL
UNION ALL
SELECT 'fatigue_confidence_tier', fatigue_confidence_tier, count(*) FROM nlp_enriched GROUP BY ALL
""")

ORACLE["event_child_collapse"] = with_ctes(
    ["inv_events", "inv_aircraft", "inv_injury", "aircraft_lookup", "injury_lookup", "inv_merged"], """
SELECT ntsb_event_id, injury_severity, operator_name, aircraft_damage FROM inv_merged
""")

ORACLE["event_features"] = with_ctes(["cul_raw", "trusted_culture"], f"""
SELECT event_id, employee_period_key, CAST({ts_parse('event_date')} AS TIMESTAMP) AS event_date, period_start_date,
       source_system, base_location, fleet_group, severity_score, training_completion_rate, safety_engagement_score,
       fatigue_training_flag, report_text, '***MASKED***' AS employee_id,
       CAST(year({ts_parse('event_date')}) AS INTEGER) AS event_year,
       CAST(month({ts_parse('event_date')}) AS INTEGER) AS event_month,
       CAST(coalesce(contains(lower(source_system), 'asrs'), FALSE) AS INTEGER) AS is_fatigue_proxy,
       CAST(length(coalesce(report_text, '')) AS INTEGER) AS report_text_length
FROM trusted_culture
""")

_OVERVIEW_SQL = ORACLE["monthly_risk_overview"]
ORACLE["kpi_and_concentration"] = f"""
WITH ov AS ({_OVERVIEW_SQL})
SELECT report_month, airport, coalesce(operational_flight_legs, 0) AS operational_flight_legs,
       CAST(sum(coalesce(operational_flight_legs, 0)) OVER (PARTITION BY report_month) AS BIGINT) AS month_flight_legs,
       CAST(sum(coalesce(asrs_report_count, 0)) OVER (PARTITION BY report_month) AS BIGINT) AS month_report_count,
       CAST(sum(coalesce(ntsb_investigation_count, 0)) OVER (PARTITION BY report_month) AS BIGINT)
         AS month_investigation_count,
       round_even(CAST(coalesce(operational_flight_legs, 0) AS DOUBLE)
                  / nullif(sum(coalesce(operational_flight_legs, 0)) OVER (PARTITION BY report_month), 0), 6)
         AS airport_leg_share
FROM ov
"""

ORACLE["investigation_mix"] = f"""
WITH tr AS ({ORACLE["investigation_trends"]}),
g AS (SELECT report_month, investigation_category, severity_normalized,
             CAST(sum(investigation_count) AS BIGINT) AS investigation_count FROM tr GROUP BY ALL)
SELECT *, round_even(CAST(investigation_count AS DOUBLE) / sum(investigation_count) OVER (PARTITION BY report_month), 6)
         AS month_share,
       lag(investigation_count) OVER (PARTITION BY investigation_category, severity_normalized ORDER BY report_month)
         AS previous_month_count
FROM g
"""

ORACLE["theme_top_k"] = f"""
WITH tr AS ({ORACLE["fatigue_theme_trends"]}),
g AS (SELECT report_month, human_factor_theme, CAST(sum(report_count) AS BIGINT) AS report_count,
             count(DISTINCT carrier) AS carrier_count FROM tr GROUP BY ALL),
r AS (SELECT *, lag(report_count) OVER (PARTITION BY human_factor_theme ORDER BY report_month) AS previous_month_count,
             CAST(rank() OVER (PARTITION BY report_month ORDER BY report_count DESC) AS INTEGER) AS theme_rank FROM g)
SELECT * FROM r WHERE theme_rank <= 3
"""


# ---------------------------------------------------------------- evaluation tables
ORACLE["stratified_folds"] = with_ctes(uniq(NLP, ["nlp_enriched"]), """
SELECT report_id, weak_fatigue_label,
       CAST((row_number() OVER (ORDER BY weak_fatigue_label NULLS FIRST, md5(CAST(report_id AS VARCHAR) || ':42'),
                                report_id) - 1) % 3 + 1 AS INTEGER) AS fold
FROM nlp_enriched
""")

CTE["scored"] = ROLE["scored_rows"]


def _curve_sql(src: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""
SELECT {g}threshold, positives, negatives, tp, fp, total_positives, total_negatives,
       tp / (tp + fp) AS precision,
       CASE WHEN total_positives > 0 THEN tp / total_positives ELSE 1.0 END AS recall,
       CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + (total_positives - tp)) ELSE 0.0 END AS f1
FROM (SELECT *, CAST(sum(positives) OVER ({part}ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
             CAST(sum(negatives) OVER ({part}ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
             CAST(sum(positives) OVER ({part.strip()}) AS BIGINT) AS total_positives,
             CAST(sum(negatives) OVER ({part.strip()}) AS BIGINT) AS total_negatives
      FROM (SELECT {g}score AS threshold, count(*) FILTER (WHERE label = 1) AS positives,
                   count(*) FILTER (WHERE label = 0) AS negatives
            FROM {src} GROUP BY ALL))
"""


CTE["curve"] = _curve_sql("scored")
_SHIFT = ("CASE WHEN (tp - positives) > 0 THEN 2 * (tp - positives) / (2 * (tp - positives) + (fp - negatives) "
          "+ (total_positives - (tp - positives))) ELSE 0.0 END")


def _threshold_sql(f1: str, mode: str) -> str:
    return (f"SELECT round_even(threshold, 6) AS threshold, 'oof_pr_curve_max_f1' AS strategy, "
            f"round_even(f1x, 4) AS best_f1, '{mode}' AS mode FROM (SELECT threshold, {f1} AS f1x FROM curve) "
            f"ORDER BY f1x DESC, threshold ASC LIMIT 1")


ORACLE["pr_curve"] = with_ctes(["scored", "curve"], "SELECT * FROM curve")
ORACLE["pr_threshold"] = with_ctes(["scored", "curve"], f"""
({_threshold_sql(_SHIFT, 'compat')}) UNION ALL ({_threshold_sql('f1', 'corrected')})
""")
CTE["thr"] = _threshold_sql(_SHIFT, "compat")


def _sd(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) ELSE 0.0 END)"


_P1, _R1 = _sd("tp", "tp + fp"), _sd("tp", "tp + fn")
_P0, _R0 = _sd("tn", "tn + fn"), _sd("tn", "tn + fp")
_F11, _F10 = _sd(f"2 * {_P1} * {_R1}", f"{_P1} + {_R1}"), _sd(f"2 * {_P0} * {_R0}", f"{_P0} + {_R0}")
_N = "(tp + fp + tn + fn)"
_METRICS = {
    "positive_precision": _P1, "positive_recall": _R1, "positive_f1": _F11, "positive_support": "tp + fn",
    "negative_precision": _P0, "negative_recall": _R0, "negative_f1": _F10, "negative_support": "tn + fp",
    "macro_precision": f"({_P1} + {_P0}) / 2", "macro_recall": f"({_R1} + {_R0}) / 2",
    "macro_f1": f"({_F11} + {_F10}) / 2", "macro_support": _N, "weighted_support": _N,
    "weighted_precision": _sd(f"{_P1} * (tp + fn) + {_P0} * (tn + fp)", _N),
    "weighted_recall": _sd(f"{_R1} * (tp + fn) + {_R0} * (tn + fp)", _N),
    "weighted_f1": _sd(f"{_F11} * (tp + fn) + {_F10} * (tn + fp)", _N),
    "accuracy": _sd("tp + tn", _N), "average_precision": "average_precision", "roc_auc": "roc_auc",
    "tn": "tn", "fp": "fp", "fn": "fn", "tp": "tp", "predicted_positive_rate": _sd("tp + fp", _N),
}
_AP = (f"sum({_sd('positives', 'total_positives')} * (tp / (tp + fp)))")
_AUC = (f"sum({_sd('negatives', 'total_negatives')} * {_sd('2 * tp - positives', '2 * total_positives')})")
ORACLE["classification_metrics"] = with_ctes(["scored", "curve", "thr"], f"""
, cm AS (SELECT CAST(count(*) FILTER (WHERE score >= t AND label = 1) AS BIGINT) AS tp,
                CAST(count(*) FILTER (WHERE score >= t AND label = 0) AS BIGINT) AS fp,
                CAST(count(*) FILTER (WHERE score < t AND label = 0) AS BIGINT) AS tn,
                CAST(count(*) FILTER (WHERE score < t AND label = 1) AS BIGINT) AS fn
         FROM scored, (SELECT threshold AS t FROM thr)),
rs AS (SELECT {_AP} AS average_precision, {_AUC} AS roc_auc FROM curve),
wide AS (SELECT {", ".join(f"round_even(CAST({v} AS DOUBLE), 4) AS {k}" for k, v in _METRICS.items())} FROM cm, rs)
SELECT metric, value FROM wide UNPIVOT (value FOR metric IN ({", ".join(_METRICS)}))
""")

CTE["scored_folds"] = """
SELECT *, CAST((row_number() OVER (ORDER BY label NULLS FIRST, md5(CAST(row_id AS VARCHAR) || ':42'), row_id) - 1)
               % 3 + 1 AS INTEGER) AS fold
FROM scored
"""
CTE["fold_curve"] = _curve_sql("scored_folds", "fold")
ORACLE["fold_metrics"] = with_ctes(["scored", "curve", "thr", "scored_folds", "fold_curve"], f"""
, cm AS (SELECT fold, CAST(count(*) FILTER (WHERE score >= t AND label = 1) AS BIGINT) AS tp,
                CAST(count(*) FILTER (WHERE score >= t AND label = 0) AS BIGINT) AS fp,
                CAST(count(*) FILTER (WHERE score < t AND label = 0) AS BIGINT) AS tn,
                CAST(count(*) FILTER (WHERE score < t AND label = 1) AS BIGINT) AS fn, any_value(t) AS t
         FROM scored_folds, (SELECT threshold AS t FROM thr) GROUP BY fold),
ap AS (SELECT fold, {_AP} AS average_precision FROM fold_curve GROUP BY fold),
tot AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS p FROM scored)
SELECT cm.fold, n - (tp + fp + tn + fn) AS train_rows, tp + fp + tn + fn AS test_rows,
       p - (tp + fn) AS train_positive_rows, tp + fn AS test_positive_rows,
       round_even({_P1}, 4) AS precision, round_even({_R1}, 4) AS recall, round_even({_F11}, 4) AS f1,
       tp + fn AS support, round_even(average_precision, 4) AS average_precision,
       round_even({_sd('tp + fp', 'tp + fp + tn + fn')}, 4) AS predicted_positive_rate,
       round_even(t, 6) AS decision_threshold
FROM cm JOIN ap ON cm.fold = ap.fold, tot
""")


# ---------------------------------------------------------------- TF-IDF weights (M7)
ORACLE["tfidf_weights"] = with_ctes(uniq(NLP, ["nlp_enriched"]), """
, toks AS (SELECT report_id, regexp_extract_all(strip_accents(lower(coalesce(narrative_clean, ''))),
                                              '[\\pL\\pN_]{2,}') AS t FROM nlp_enriched),
grams AS (SELECT report_id, unnest(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term
          FROM toks),
tf AS (SELECT report_id, term, count(*) AS tf FROM grams GROUP BY ALL),
nd AS (SELECT count(*) AS n FROM nlp_enriched),
vocab AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
v AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM vocab, nd WHERE df >= 2 AND df <= 0.95 * n),
w AS (SELECT tf.report_id, tf.term, (1.0 + ln(tf.tf)) * v.idf AS w FROM tf JOIN v ON tf.term = v.term),
nrm AS (SELECT report_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY report_id)
SELECT w.report_id, w.term, round(w.w / nrm.nrm, 8) AS weight FROM w JOIN nrm ON w.report_id = nrm.report_id
""")

# ---------------------------------------------------------------- benchmark (M8, M9): what no solver decides
CTE["bench_rows"] = """
SELECT report_id, event_date, narrative_clean, weak_fatigue_label, theme_primary_label, fatigue_confidence_tier,
       CAST((row_number() OVER (ORDER BY weak_fatigue_label NULLS FIRST, md5(CAST(report_id AS VARCHAR) || ':42'),
                                report_id) - 1) % 3 + 1 AS INTEGER) AS oof_fold
FROM nlp_enriched
"""
_BENCH = uniq(NLP, ["nlp_enriched", "bench_rows"])
ORACLE["fatigue_benchmark_rows"] = with_ctes(_BENCH, """
SELECT report_id, event_date, weak_fatigue_label, oof_fold, theme_primary_label, fatigue_confidence_tier FROM bench_rows
""")
ORACLE["fatigue_benchmark_design"] = with_ctes(_BENCH, """
, toks AS (SELECT report_id, oof_fold, regexp_extract_all(strip_accents(lower(coalesce(narrative_clean, ''))),
                                                        '[\\pL\\pN_]{2,}') AS t FROM bench_rows),
grams AS (SELECT DISTINCT report_id, oof_fold,
                 unnest(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term FROM toks),
k AS (SELECT unnest([0, 1, 2, 3]) AS fold),
tr AS (SELECT k.fold, count(*) AS n, CAST(sum(weak_fatigue_label) AS BIGINT) AS p
       FROM k JOIN bench_rows b ON b.oof_fold <> k.fold GROUP BY k.fold),
df AS (SELECT k.fold, term, count(*) AS df FROM k JOIN grams g ON g.oof_fold <> k.fold GROUP BY ALL),
voc AS (SELECT df.fold, count(*) AS vocabulary_size FROM df JOIN tr ON df.fold = tr.fold
        WHERE df.df >= 2 AND df.df <= 0.95 * tr.n GROUP BY df.fold)
SELECT CAST(tr.fold AS INTEGER) AS fold, tr.n AS train_rows, tr.p AS train_positive_rows,
       tr.n / (2.0 * tr.p) AS positive_weight, tr.n / (2.0 * (tr.n - tr.p)) AS negative_weight, voc.vocabulary_size
FROM tr JOIN voc ON tr.fold = voc.fold
""")

# columns of a fit: terms with equal lists of (report, tf) over its training rows share one
ORACLE["fatigue_benchmark_columns"] = with_ctes(_BENCH, """
, toks AS (SELECT report_id, oof_fold, regexp_extract_all(strip_accents(lower(coalesce(narrative_clean, ''))),
                                                        '[\\pL\\pN_]{2,}') AS t FROM bench_rows),
grams AS (SELECT report_id, oof_fold, term, count(*) AS tf
          FROM (SELECT report_id, oof_fold, unnest(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term FROM toks)
          GROUP BY ALL),
k AS (SELECT unnest([0, 1, 2, 3]) AS fold),
tr AS (SELECT k.fold, count(*) AS n FROM k JOIN bench_rows b ON b.oof_fold <> k.fold GROUP BY k.fold),
lists AS (SELECT k.fold, term, count(*) AS df, md5(string_agg(report_id || ':' || tf, ',' ORDER BY report_id)) AS list
          FROM k JOIN grams g ON g.oof_fold <> k.fold GROUP BY k.fold, term)
SELECT CAST(tr.fold AS INTEGER) AS fold, count(*) AS vocabulary_size, count(DISTINCT list) AS merged_columns
FROM lists JOIN tr ON lists.fold = tr.fold WHERE df >= 2 AND df <= 0.95 * tr.n GROUP BY tr.fold
""")

# M1-M3: target, low-variance screen and imputation (exact median, most frequent with smallest on ties)
ORACLE["imputed_features"] = with_ctes(["cul_raw", "trusted_culture"], """
, f AS (SELECT *, CAST(coalesce(severity_score, 0) > 0 AS INTEGER) AS elevated_risk_flag FROM trusted_culture),
med AS (SELECT median(training_completion_rate) AS m1, median(safety_engagement_score) AS m2,
               median(CAST(fatigue_training_flag AS DOUBLE)) AS m3,
               median(CAST(length(coalesce(report_text, '')) AS DOUBLE)) AS m4,
               median(CAST(year(CAST(event_date AS DATE)) AS DOUBLE)) AS m5,
               median(CAST(month(CAST(event_date AS DATE)) AS DOUBLE)) AS m6 FROM f)
SELECT event_id, elevated_risk_flag, base_location, fleet_group,
       coalesce(training_completion_rate, m1) AS training_completion_rate,
       coalesce(safety_engagement_score, m2) AS safety_engagement_score,
       coalesce(CAST(fatigue_training_flag AS DOUBLE), m3) AS fatigue_training_flag,
       report_text,
       coalesce(CAST(year(CAST(event_date AS DATE)) AS DOUBLE), m5) AS event_year,
       coalesce(CAST(month(CAST(event_date AS DATE)) AS DOUBLE), m6) AS event_month
FROM f, med
""")

ORACLE["operations_from_csv"] = ORACLE["operational_disruption_summary"]

# ---------------------------------------------------------------- operators behind files and adapters
ORACLE["promotion_from_layers"] = ORACLE["promotion_summary"]
ORACLE["trusted_investigations"] = with_ctes(INV, "SELECT * FROM trusted_investigations")
ORACLE["three_file_source"] = ORACLE["trusted_investigations"]
_ALIASED = dict(CTE)
_ALIASED["inv_std"] = ROLE["aliased_investigations_raw"]
ORACLE["aliased_investigations"] = "WITH " + ",\n".join(
    f"{n} AS ({_ALIASED[n]})" for n in ("inv_std", "inv_valid", "trusted_investigations")) + "\nSELECT * FROM trusted_investigations"

_DRIFTED = dict(CTE)
_DRIFTED["ops_raw"] = f"""
SELECT * REPLACE (CASE WHEN CAST(flight_number AS BIGINT) % 2 = 1 THEN NULL ELSE dep_delay END AS dep_delay)
FROM ({ROLE["operations_raw"]})
"""
_DISRUPTION_BODY = ORACLE["operational_disruption_summary"].split("\nSELECT strftime(t.flight_date", 1)[1]
ORACLE["union_by_name"] = "WITH " + ",\n".join(f"{n} AS ({_DRIFTED[n]})" for n in OPS) + "\nSELECT strftime(t.flight_date" + _DISRUPTION_BODY

_EXPORTED = dict(CTE)
_EXPORTED["rep_raw"] = f"""
SELECT * REPLACE (regexp_replace(narrative, '[\\s"]+', ' ', 'g') AS narrative,
                  regexp_replace(narrative_synopsis, '[\\s"]+', ' ', 'g') AS narrative_synopsis, CAST(NULL AS VARCHAR) AS aircraft_operator)
FROM ({ROLE["reports_raw"]})
"""
ORACLE["two_row_header"] = "WITH " + ",\n".join(f"{n} AS ({_EXPORTED[n]})" for n in REP) + """
SELECT report_id, event_date, location, aircraft_operator, anomaly, human_factors, narrative, source_system, narrative_privacy_note
FROM trusted_reports
"""

ORACLE["event_features_defaults"] = f"""
SELECT * EXCLUDE (severity_score, report_text, report_text_length), CAST(0.0 AS DOUBLE) AS severity_score
FROM ({ORACLE["event_features"]})
"""

ORACLE["bi_extract"] = f"""
SELECT * REPLACE (CAST(report_month || '-01' AS DATE) AS report_month,
                  {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in (
                      "operational_flight_legs", "cancelled_flights", "diverted_flights", "avg_departure_delay_minutes",
                      "avg_arrival_delay_minutes", "asrs_report_count", "fatigue_related_report_count", "ntsb_investigation_count",
                      "serious_or_higher_investigation_count", "avg_training_completion_rate", "avg_safety_engagement_score",
                      "fatigue_training_completion_rate", "synthetic_elevated_risk_count"))})
FROM ({_OVERVIEW_SQL})
"""

_REFERENCE = dict(
    keyword=D.FATIGUE_KEYWORD_RULES, strong=D.FATIGUE_STRONG_RULES, sleep_rest=D.FATIGUE_SLEEP_REST_RULES,
    alertness=D.FATIGUE_ALERTNESS_RULES, context=D.FATIGUE_CONTEXT_RULES, hypothetical=D.HYPOTHETICAL_PATTERNS,
    themes=D.THEME_RULES, theme_priority=D.THEME_PRIORITY)
_PLANTED = dict(CTE)
_PLANTED["rep_raw"] = ROLE["planted_reports_raw"]
_PLANTED["nlp_enriched"] = _nlp_sql(_REFERENCE)
_PLANTED_CTES = "WITH " + ",\n".join(f"{n} AS ({_PLANTED[n]})" for n in uniq(NLP, ["nlp_enriched"])) + "\n"
ORACLE["reference_rules"] = _PLANTED_CTES + "SELECT * EXCLUDE (narrative, narrative_clean) FROM nlp_enriched"
ORACLE["reference_features"] = _PLANTED_CTES + _features_sql(dict(
    explicit=D.EXPLICIT_TERMS, context=D.CONTEXT_TERMS, hypothetical=D.HYPOTHETICAL_PATTERNS, operational=D.OPERATIONAL_THEME_TERMS))

# ---------------------------------------------------------------- M4, M5
CTE["risk_rows"] = "SELECT *, CAST(coalesce(severity_score, 0) > 0 AS INTEGER) AS elevated_risk_flag FROM trusted_culture"
ORACLE["holdout_split"] = with_ctes(["cul_raw", "trusted_culture", "risk_rows"], """
SELECT event_id, elevated_risk_flag,
       row_number() OVER (PARTITION BY elevated_risk_flag ORDER BY md5(event_id || ':42'), event_id)
         <= round(0.2 * count(*) OVER (PARTITION BY elevated_risk_flag)) AS is_test
FROM risk_rows
""")
_HOT = ("base_location", "fleet_group", "report_text")
ORACLE["one_hot_features"] = with_ctes(["cul_raw", "trusted_culture", "risk_rows"], f"""
, filled AS (SELECT event_id, elevated_risk_flag,
                    coalesce(training_completion_rate, (SELECT median(training_completion_rate) FROM risk_rows)) AS x0,
                    CAST(fatigue_training_flag AS DOUBLE) AS x1, {", ".join(_HOT)} FROM risk_rows),
pairs AS ({" UNION ALL ".join(f"SELECT event_id, elevated_risk_flag, '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM filled" for c in _HOT)}),
idx AS (SELECT feature, value, row_number() OVER (ORDER BY md5(feature || ':' || value), feature, value) - 1 + 2 AS i
        FROM (SELECT DISTINCT feature, value FROM pairs WHERE elevated_risk_flag = 1 AND value IS NOT NULL)),
entries AS (SELECT event_id, 0 AS i, x0 AS v FROM filled WHERE x0 <> 0 UNION ALL SELECT event_id, 1, x1 FROM filled WHERE x1 <> 0
            UNION ALL SELECT p.event_id, idx.i, 1.0 FROM pairs p JOIN idx ON p.feature = idx.feature AND p.value = idx.value)
SELECT f.event_id, coalesce(string_agg(CAST(e.i AS VARCHAR), ',' ORDER BY e.i), '') AS indices,
       coalesce(string_agg(CAST(CAST(round(e.v * 1e6) AS BIGINT) AS VARCHAR), ',' ORDER BY e.i), '') AS values_e6
FROM filled f LEFT JOIN entries e ON f.event_id = e.event_id GROUP BY f.event_id
""")
