"""Trusted-layer adapters (E1): raw extract -> checked, de-duplicated trusted table.

Each adapter is a pure function over DataFrames.  Step order follows the reference,
including its quirks: de-duplication runs before the null and date filters (Q5), keys
are compared as read (Q7).  Fixed deviations: dates parse over an explicit format list
(Q9), absent optional columns become NULL (Q10), Parquet keeps types between layers (Q18).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions import dictionaries as D
from riskmart.functions.scalars import (
    blank_or_null, blank_to_null, code_norm, indicator, in_window, lenient_double, lenient_double_of, map_lookup,
    null_safe_sum, py_strip, py_title, snake_case_columns, to_timestamp_col,
)
from riskmart.operators.quality import (
    drop_required_nulls, keep_first, validate_no_duplicates, validate_null_threshold,
    validate_required_columns,
)
from riskmart.session import written


def rename_if_absent(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Rename source -> target only when the source exists and the target does not."""
    mapping = {s: t for s, t in aliases.items() if s in df.columns and t not in df.columns}
    return df.withColumnsRenamed(mapping) if mapping else df


def coalesce_aliases(df: DataFrame, aliases: Sequence[tuple[str, str]]) -> DataFrame:
    """Fold ``target := coalesce(target, source)`` in alias order."""
    for source, target in aliases:
        if source not in df.columns:
            continue
        if target not in df.columns:
            df = df.withColumn(target, F.col(source))
        else:
            df = df.withColumn(target, F.coalesce(F.col(target), F.col(source)))
    return df


def _drop_helpers(df: DataFrame, helpers: Sequence[str]) -> DataFrame:
    """Drop source-order helper columns (``src_*`` / ``_src_*``) once de-duplication is done."""
    return df.drop(*[c for c in helpers if isinstance(c, str) and c.startswith(("src_", "_src"))
                     and c in df.columns])


# ============================================================ operations (E1.3)
def _watch(df: DataFrame, observe: dict | None, step: str) -> DataFrame:
    if observe and step in observe:
        return df.observe(observe[step], F.count(F.lit(1)).alias("rows"))
    return df


def trusted_operations(raw: DataFrame, order: Sequence[str], window=D.STUDY_WINDOW,
                       observe: dict | None = None) -> DataFrame:
    """S2 -> P1 -> P2 -> V1 -> F4 -> F1 -> F2 -> G1..G5.

    ``observe`` optionally maps stage names (loaded, deduplicated, required_present) to
    ``Observation`` objects filled by whatever job finally runs the plan (F6).
    """
    df = snake_case_columns(raw)
    df = rename_if_absent(df, D.OPERATIONS_ALIASES)
    validate_required_columns(df, D.OPERATIONS_REQUIRED)
    df = _watch(df, observe, "loaded")
    df = _watch(keep_first(df, D.OPERATIONS_KEYS, order), observe, "deduplicated")
    df = _watch(drop_required_nulls(df, D.OPERATIONS_REQUIRED), observe, "required_present")
    ts = to_timestamp_col(df, "flight_date")
    df = df.withColumn("_ts", ts).where(F.col("_ts").isNotNull() & in_window(F.col("_ts"), window))
    df = df.withColumn("flight_date", F.to_date("_ts")).drop("_ts")
    df = _drop_helpers(df, order)
    dep = lenient_double_of(df, "dep_delay") if "dep_delay" in df.columns else F.lit(None).cast("double")
    arr = lenient_double_of(df, "arr_delay") if "arr_delay" in df.columns else F.lit(None).cast("double")
    cancelled = indicator("cancelled")
    diverted = indicator("diverted")
    return df.withColumns({
        "carrier": code_norm("reporting_airline"),
        "origin_airport": code_norm("origin"),
        "destination_airport": code_norm("dest"),
    }).withColumns({
        "route": F.concat_ws("_", "origin_airport", "destination_airport"),
        "departure_delay_minutes": dep,
        "arrival_delay_minutes": arr,
        "cancelled_flag": cancelled,
        "diverted_flag": diverted,
        "operational_status": F.when(cancelled == 1, "cancelled")
                               .when(diverted == 1, "diverted").otherwise("completed"),
        "flight_number": py_strip(F.col("flight_number").cast("string")),
    })


# ============================================================ reports (E1.1)
def trusted_reports(raw: DataFrame, order: Sequence[str], window=D.STUDY_WINDOW,
                    observe: dict | None = None) -> DataFrame:
    """S3 -> P1 -> P2/P4 -> V1 -> F4 -> F1 -> F3 -> G9 -> P5; ``observe`` as in ``trusted_operations``."""
    df = snake_case_columns(raw)
    df = rename_if_absent(df, D.REPORTS_ALIASES)
    if "narrative" not in df.columns and "narrative_synopsis" in df.columns:
        df = df.withColumn("narrative", F.col("narrative_synopsis"))
    if "narrative" in df.columns and "narrative_synopsis" in df.columns:
        df = df.withColumn("narrative", F.coalesce(F.nullif(F.col("narrative"), F.lit("")),
                                                   F.col("narrative_synopsis")))
    if "source_system" not in df.columns:
        df = df.withColumn("source_system", F.lit("NASA_ASRS"))
    validate_required_columns(df, D.REPORTS_REQUIRED)
    df = _watch(keep_first(_watch(df, observe, "loaded"), D.REPORTS_KEYS, order), observe, "deduplicated")
    df = _watch(drop_required_nulls(df, D.REPORTS_NOT_NULL), observe, "required_present")
    ts = to_timestamp_col(df, "event_date", month_first=True)
    df = df.withColumn("_ts", ts).where(F.col("_ts").isNotNull() & in_window(F.col("_ts"), window))
    df = df.withColumn("event_date", F.to_date("_ts")).drop("_ts")
    df = _drop_helpers(df, order)
    for c in ("location", "aircraft_operator"):
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit("UNKNOWN")) if c in df.columns else F.lit("UNKNOWN"))
    return df.withColumn("narrative_privacy_note", F.lit(D.NARRATIVE_PRIVACY_NOTE))


# ============================================================ investigations (E1.2)
def aircraft_lookup(aircraft: DataFrame, order: Column) -> DataFrame:
    """Per event, first non-blank trimmed operator and damage in source order."""
    ac = snake_case_columns(aircraft).where(F.col("ev_id").isNotNull())
    ac = ac.select("ev_id", order.alias("_ord"), py_strip(F.col("oper_name").cast("string")).alias("_op"),
                   py_strip(F.col("damage").cast("string")).alias("_dm"))

    def first_non_empty(v: str) -> Column:
        # min over (order, value) of the non-blank rows: the value at the smallest order
        return F.min(F.when(F.col(v) != "", F.struct(F.col("_ord"), F.col(v).alias("v"))))

    agg = ac.groupBy(F.col("ev_id").alias("ntsb_event_id")).agg(
        first_non_empty("_op").alias("_o"), first_non_empty("_dm").alias("_d"))
    return agg.select("ntsb_event_id", F.col("_o.v").alias("operator_name"), F.col("_d.v").alias("aircraft_damage"))


def injury_lookup(injury: DataFrame) -> DataFrame:
    """F5 + A7: highest known injury level with a positive person count, per event."""
    inj = snake_case_columns(injury).where(F.col("ev_id").isNotNull())
    level = F.upper(py_strip(F.col("injury_level").cast("string")))
    count = F.coalesce(lenient_double("inj_person_count"), F.lit(0.0))
    rank = map_lookup(level, {k: str(v) for k, v in D.INJURY_LEVEL_RANK.items()}, None).cast("int")
    kept = (inj.select(F.col("ev_id"), level.alias("lvl"), count.alias("cnt"), rank.alias("rnk"))
               .where(F.col("lvl").isin(list(D.INJURY_LEVEL_RANK)) & (F.col("cnt") > 0)))
    # the level is a 1:1 function of its rank: max(rank) (a hash aggregate on an int) mapped
    # back to the level equals max_by(level, rank) without a sort-based aggregate.
    by_rank = {str(v): k for k, v in D.INJURY_LEVEL_RANK.items()}
    top = kept.groupBy(F.col("ev_id").alias("ntsb_event_id")).agg(F.max("rnk").alias("_top"))
    return top.select("ntsb_event_id",
                      map_lookup(F.col("_top").cast("string"), by_rank, None).alias("injury_severity_from_injury"))


def investigation_events(events: DataFrame, aircraft: DataFrame | None, injury: DataFrame | None,
                         aircraft_order: Column, raw_file_name: str = "|".join(D.INVESTIGATION_FILES)) -> DataFrame:
    """Events + aircraft + injury to event grain."""
    ev = snake_case_columns(events)
    merged = ev.withColumns({
        "ntsb_event_id": F.col("ev_id"),
        "event_date": F.col("ev_date"),
        "event_type": F.col("ev_type"),
        "injury_severity": F.col("ev_highest_injury"),
        "airport_code": F.col("ev_nr_apt_id"),
        "source_system": F.lit("NTSB"),
        "raw_file_name": F.lit(raw_file_name),
    })
    if aircraft is not None:
        merged = merged.join(aircraft_lookup(aircraft, aircraft_order), "ntsb_event_id", "left")
    else:
        merged = merged.withColumns({"operator_name": F.lit(None).cast("string"),
                                     "aircraft_damage": F.lit(None).cast("string")})
    if injury is not None:
        merged = (merged.join(injury_lookup(injury), "ntsb_event_id", "left")
                        .withColumn("injury_severity", F.coalesce(F.col("injury_severity"),
                                                                  F.col("injury_severity_from_injury")))
                        .drop("injury_severity_from_injury"))
    totals = [c for c in D.INJURY_TOTAL_COLUMNS if c in merged.columns]
    if totals:
        all_zero = null_safe_sum([lenient_double(c) for c in totals]) == 0
        infer = blank_or_null(F.col("injury_severity")) & all_zero
        merged = merged.withColumn("injury_severity",
                                   F.when(infer, F.lit("NONE")).otherwise(F.col("injury_severity")))
    return merged


def trusted_investigations(merged: DataFrame, order: Sequence[str | Column], window=D.STUDY_WINDOW,
                           observe: dict | None = None) -> DataFrame:
    """P1 -> P3/P9 -> V1 -> F4 -> F1 -> F2 -> G7/G8/G9 -> P6; ``observe`` as in ``trusted_operations``."""
    df = snake_case_columns(merged)
    df = coalesce_aliases(df, D.INVESTIGATIONS_ALIASES)
    files = "|".join(D.INVESTIGATION_FILES)
    df = df.withColumn("source_system", F.coalesce(F.col("source_system"), F.lit("NTSB"))
                       if "source_system" in df.columns else F.lit("NTSB"))
    df = df.withColumn("raw_file_name", F.coalesce(F.col("raw_file_name"), F.lit(files))
                       if "raw_file_name" in df.columns else F.lit(files))
    for c in D.INVESTIGATIONS_REQUIRED:
        if c in df.columns:
            df = df.withColumn(c, blank_to_null(F.col(c).cast("string")))
    validate_required_columns(df, D.INVESTIGATIONS_REQUIRED)
    df = _watch(keep_first(_watch(df, observe, "loaded"), D.INVESTIGATIONS_KEYS, order), observe, "deduplicated")
    df = _watch(drop_required_nulls(df, D.INVESTIGATIONS_REQUIRED, blank_is_null=True), observe, "required_present")
    ts = to_timestamp_col(df, "event_date")
    df = df.withColumn("_ts", ts).where(F.col("_ts").isNotNull() & in_window(F.col("_ts"), window))
    df = df.withColumn("event_date", F.to_date("_ts")).drop("_ts")
    norm = normalize_investigations(df)
    return norm.select(*[F.col(c) if c in norm.columns else F.lit(None).cast("string").alias(c)
                         for c in D.INVESTIGATIONS_OUTPUT])


def _src(c: str) -> Column:
    s = F.upper(py_strip(F.col(c).cast("string")))
    return F.when(s != "", s)


def normalize_investigations(df: DataFrame) -> DataFrame:
    """G7 dictionaries, G8 derived defaults, G9 blank -> UNKNOWN."""
    for c in ("operator_name", "aircraft_damage", "airport_code"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    sev = map_lookup(_src("injury_severity"), D.SEVERITY_MAP, D.OTHER_OR_UNKNOWN)
    et_src = _src("event_type")
    event_type = F.coalesce(map_lookup(et_src, D.EVENT_TYPE_DISPLAY_MAP, None),
                            py_title(py_strip(F.col("event_type").cast("string"))))
    category = map_lookup(et_src, D.EVENT_CATEGORY_MAP, D.OTHER_OR_UNKNOWN)
    raw_damage = F.col("aircraft_damage").cast("string")
    damage = F.coalesce(map_lookup(_src("aircraft_damage"), D.DAMAGE_MAP, None),
                        F.replace(F.lower(py_strip(raw_damage)), F.lit(" "), F.lit("_")),
                        F.lit("unknown"))

    def unknown_if_blank(c: str) -> Column:
        v = py_strip(F.col(c).cast("string"))
        return F.coalesce(F.when(v != "", v), F.lit("UNKNOWN"))

    return df.withColumns({
        "injury_severity_raw": F.col("injury_severity"),
        "event_type_raw": F.col("event_type"),
        "severity_normalized": sev,
        "injury_severity": sev,
        "event_type": event_type,
        "investigation_category": category,
        "aircraft_damage": damage,
        "airport_code": unknown_if_blank("airport_code"),
        "operator_name": unknown_if_blank("operator_name"),
    })


# ============================================================ culture (E1.4)
def trusted_culture(raw: DataFrame, order: Sequence[str], null_threshold: float | None = D.NULL_RATIO_THRESHOLD,
                    check: bool = True, observe: dict | None = None) -> DataFrame:
    """S1 -> P1 -> V1 -> F4 -> V2 -> V3 (no window filter, no normalisation); ``observe`` as in ``trusted_operations``."""
    df = snake_case_columns(raw)
    validate_required_columns(df, D.CULTURE_REQUIRED)
    df = _watch(keep_first(_watch(df, observe, "loaded"), D.CULTURE_KEYS, order), observe, "deduplicated")
    df = _drop_helpers(df, order)
    if check:
        if null_threshold is not None:
            validate_null_threshold(df, null_threshold)
        validate_no_duplicates(df, D.CULTURE_KEYS)
    return df


# ============================================================ starter features
def event_features(trusted: DataFrame) -> DataFrame:
    """Rows with bad dates are kept (parts NULL)."""
    validate_required_columns(trusted, D.CULTURE_REQUIRED)
    ts = to_timestamp_col(trusted, "event_date").cast("timestamp_ntz")
    out = trusted.withColumns({
        "event_date": ts,
        "event_year": F.year(ts),
        "event_month": F.month(ts),
        "is_fatigue_proxy": F.coalesce(F.lower(F.col("source_system")).contains("asrs"), F.lit(False)).cast("int"),
    })
    if "severity_score" not in out.columns:
        out = out.withColumn("severity_score", F.lit(0.0))
    if "report_text" in out.columns:
        out = out.withColumn("report_text_length", F.length(F.coalesce(F.col("report_text"), F.lit(""))))
    for c in D.MASKED_ID_COLUMNS:
        if c in out.columns:
            out = out.withColumn(c, F.lit(D.MASK_LITERAL))
    return out


# ============================================================ build + write with counters
STEPS = ("loaded", "deduplicated", "required_present", "written")


def _write_counted(source: str, build: Callable[[dict], DataFrame], path: str, partition_by: Sequence[str] = (),
                   steps: Sequence[str] = STEPS, write: Callable[[DataFrame], None] | None = None) -> list[tuple[str, str, int]]:
    """Write the table that ``build`` makes, also if it is empty, and return its stage counters (source, step, rows).

    The counters are ``DataFrame.observe`` metrics of the write job itself, so no extra pass over
    the data is made.  Rows are dealt by ``partition_by`` before they are written: a folder gets
    one file or, if AQE splits a large one, a few; not one from every task.
    """
    from pyspark.sql import Observation
    seen = {step: Observation(f"{source}_{step}") for step in steps}
    out = _watch(build(seen), seen, "written")
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    if write is not None:
        write(out)
    else:
        w = out.write.mode("overwrite")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return [(source, step, int(o.get["rows"])) for step, o in seen.items()]


def write_trusted_operations(raw: DataFrame, order: Sequence[str], path: str, window=D.STUDY_WINDOW,
                             partition_by: Sequence[str] = ("flight_date",)) -> list[tuple[str, str, int]]:
    """E1.3 as a write job: rows loaded, after de-dup, with all required values, and written."""
    return _write_counted("operations", lambda seen: trusted_operations(raw, order, window, observe=seen), path, partition_by)


def write_trusted_reports(raw: DataFrame, order: Sequence[str], path: str, window=D.STUDY_WINDOW,
                          partition_by: Sequence[str] = ()) -> list[tuple[str, str, int]]:
    """E1.1 as a write job with its counters."""
    return _write_counted("reports", lambda seen: trusted_reports(raw, order, window, observe=seen), path, partition_by)


def write_trusted_investigations(merged: DataFrame, order: Sequence[str | Column], path: str, window=D.STUDY_WINDOW,
                                 partition_by: Sequence[str] = ()) -> list[tuple[str, str, int]]:
    """E1.2 as a write job with its counters; an empty table is written with its columns."""
    return _write_counted("investigations", lambda seen: trusted_investigations(merged, order, window, observe=seen), path, partition_by)


def write_trusted_culture(raw: DataFrame, order: Sequence[str], path: str,
                          null_threshold: float | None = D.NULL_RATIO_THRESHOLD) -> list[tuple[str, str, int]]:
    """E1.4 as a write job: the rows are built once, V2 and V3 read the copy, and only a table that passes is written."""
    def checked(out: DataFrame) -> None:
        built = written(out, "trusted-culture")
        if null_threshold is not None:
            validate_null_threshold(built, null_threshold)
        validate_no_duplicates(built, D.CULTURE_KEYS)
        built.write.mode("overwrite").parquet(path)

    return _write_counted("culture", lambda seen: trusted_culture(raw, order, check=False, observe=seen), path,
                          steps=("loaded", "deduplicated", "written"), write=checked)
