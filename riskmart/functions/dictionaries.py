"""Lookup tables and rule phrase lists.

FIXED VALUES — these must equal the reference application's values for results to
match.  They are stated plainly, in their natural order.  Every builder takes its
dictionaries as parameters; these are only the defaults.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: study window, thresholds, null tokens
# ---------------------------------------------------------------------------
STUDY_WINDOW = ("2025-01-01", "2025-02-28")
NULL_RATIO_THRESHOLD = 0.2

# Tokens a CSV reader treats as missing (pandas default list).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: dimension maps
# ---------------------------------------------------------------------------
AIRPORT_REGION = {
    "ATL": "Southeast",
    "BOS": "Northeast",
    "DAL": "South",
    "DTW": "Midwest",
    "HOU": "South",
    "JFK": "Northeast",
    "LAX": "West",
    "MSP": "Midwest",
    "SEA": "West",
    "SLC": "West",
    "UNKNOWN": "Unknown",
}
AIRPORT_REGION_DEFAULT = "Unknown"

STATE_REGION = {
    "GA": "Southeast",
    "MI": "Midwest",
    "WA": "West",
    "TX": "South",
}
STATE_REGION_DEFAULT = "Unknown"

OPERATOR_CARRIER_GROUP = {
    "DELTA AIR LINES": "DL",
    "DELTA CONNECTION": "DL",
    "SKYWEST AIRLINES": "OO",
    "SOUTHWEST AIRLINES": "WN",
    "UNKNOWN": "UNKNOWN",
}
OPERATOR_CARRIER_DEFAULT = "OTHER_PUBLIC_OPERATOR"

SEVERITY_MAP = {
    "NONE": "no_injury",
    "NO INJURY": "no_injury",
    "NO_INJURY": "no_injury",
    "MINR": "minor_injury",
    "MINOR": "minor_injury",
    "SERS": "serious_injury",
    "SERIOUS": "serious_injury",
    "FATL": "fatal_injury",
    "FATAL": "fatal_injury",
}
EVENT_CATEGORY_MAP = {
    "ACC": "accident",
    "ACCIDENT": "accident",
    "INC": "incident",
    "INCIDENT": "incident",
    "GROUND DAMAGE": "ground_event",
    "TURBULENCE INJURY": "in_flight_injury",
    "HARD LANDING": "landing_event",
    "MAINTENANCE ISSUE": "maintenance_event",
}
EVENT_TYPE_DISPLAY_MAP = {
    "ACC": "Accident",
    "ACCIDENT": "Accident",
    "INC": "Incident",
    "INCIDENT": "Incident",
}
DAMAGE_MAP = {
    "DEST": "destroyed",
    "DESTROYED": "destroyed",
    "MINR": "minor",
    "MINOR": "minor",
    "SUBS": "substantial",
    "SUBSTANTIAL": "substantial",
    "UNK": "unknown",
    "UNKNOWN": "unknown",
    "NONE": "none",
}
OTHER_OR_UNKNOWN = "other_or_unknown"
INJURY_LEVEL_RANK = {"NONE": 0, "MINR": 1, "SERS": 2, "FATL": 3}
INJURY_TOTAL_COLUMNS = [
    "inj_f_grnd", "inj_m_grnd", "inj_s_grnd", "inj_tot_f",
    "inj_tot_m", "inj_tot_n", "inj_tot_s", "inj_tot_t",
]
SERIOUS_OR_HIGHER = ["serious_injury", "fatal_injury"]
MASK_LITERAL = "***MASKED***"
MASKED_ID_COLUMNS = ["employee_id", "reporter_id"]

# ---------------------------------------------------------------------------
# FIXED VALUES: column aliases and keys of the source adapters
# ---------------------------------------------------------------------------
OPERATIONS_REQUIRED = ["flight_date", "reporting_airline", "flight_number", "origin", "dest",
                       "cancelled", "diverted"]
OPERATIONS_KEYS = ["flight_date", "reporting_airline", "flight_number", "origin", "dest"]
OPERATIONS_ALIASES = {
    "flight_number_reporting_airline": "flight_number",
    "iata_code_reporting_airline": "reporting_airline",
}
REPORTS_REQUIRED = ["report_id", "event_date", "anomaly", "human_factors", "narrative"]
REPORTS_NOT_NULL = ["report_id", "event_date", "anomaly", "human_factors"]
REPORTS_KEYS = ["report_id"]
REPORTS_ALIASES = {
    "acn": "report_id",
    "time_date": "event_date",
    "place_locale_reference": "location",
    "aircraft_1_aircraft_operator": "aircraft_operator",
    "events_anomaly": "anomaly",
    "person_1_human_factors": "human_factors",
    "report_1_narrative": "narrative",
    "report_1_synopsis": "narrative_synopsis",
}
INVESTIGATIONS_REQUIRED = ["ntsb_event_id", "event_date", "injury_severity", "event_type"]
INVESTIGATIONS_KEYS = ["ntsb_event_id"]
INVESTIGATIONS_ALIASES = [
    ("ev_id", "ntsb_event_id"),
    ("event_id", "ntsb_event_id"),
    ("ev_date", "event_date"),
    ("ev_type", "event_type"),
    ("investigation_type", "event_type"),
    ("broad_phase_of_flight", "event_type"),
    ("ev_highest_injury", "injury_severity"),
    ("injury_level", "injury_severity_from_injury"),
    ("ev_nr_apt_id", "airport_code"),
    ("airport_code", "airport_code"),
    ("oper_name", "operator_name"),
    ("air_carrier", "operator_name"),
    ("damage", "aircraft_damage"),
]
INVESTIGATIONS_OUTPUT = [
    "ntsb_event_id", "event_date", "airport_code", "operator_name", "injury_severity",
    "event_type", "aircraft_damage", "source_system", "raw_file_name", "injury_severity_raw",
    "event_type_raw", "severity_normalized", "investigation_category",
]
INVESTIGATION_FILES = ["ntsb_events.csv", "ntsb_aircraft.csv", "ntsb_injury.csv"]
CULTURE_REQUIRED = ["event_id", "event_date", "source_system"]
CULTURE_KEYS = ["event_id"]
RISK_MODEL_EXCLUDED = [
    "event_id", "employee_period_key", "event_date", "period_start_date",
    "source_system", "severity_score", "elevated_risk_flag",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: data_basis texts and notes
# ---------------------------------------------------------------------------
BASIS_DISRUPTION = "Public BTS On-Time / Delay data used as an operational proxy, not FOQA."
BASIS_FATIGUE = ("Public NASA ASRS reports used as a voluntary safety-report and fatigue proxy, "
                 "not ASAP.")
BASIS_INVESTIGATION = ("Public NTSB investigations used as external investigation context, "
                       "not an internal SMS system.")
BASIS_PROMOTION = ("Public FAASTeam event listings used as a safety-promotion proxy, not internal "
                   "training completion data.")
BASIS_OVERVIEW = ("Integrated from public BTS, ASRS, and NTSB sources plus synthetic safety-culture "
                  "data at monthly airport level; all links are proxy-driven and aggregate only.")
NARRATIVE_PRIVACY_NOTE = ("Narratives are preserved in the trusted layer for analysis, but downstream "
                          "analytics should minimize exposure and avoid broad audience access.")

# ---------------------------------------------------------------------------
# FIXED VALUES: narrative rule dictionaries (enrichment stage)
# ---------------------------------------------------------------------------
FATIGUE_KEYWORD_RULES = [
    "fatigue", "fatigued", "tired", "tiredness", "exhausted", "exhaustion", "drowsy",
    "sleepy", "sleep", "lack of sleep", "sleep deprived", "sleep deprivation",
    "reduced alertness", "alertness", "long duty day", "extended duty", "duty period",
    "circadian", "rest period", "inadequate rest", "minimal rest", "poor rest",
    "short rest", "overnight duty", "rest break", "poor rest break",
]
FATIGUE_STRONG_RULES = [
    "fatigue", "fatigued", "tired", "tiredness", "exhausted", "exhaustion", "drowsy",
    "sleepy", "lack of sleep", "sleep deprived", "sleep deprivation", "reduced alertness",
    "long duty day", "extended duty", "duty period", "circadian", "rest period",
    "inadequate rest", "minimal rest", "poor rest", "short rest", "overnight duty",
    "rest break", "poor rest break",
]
FATIGUE_SLEEP_REST_RULES = [
    "sleep", "lack of sleep", "sleep deprived", "sleep deprivation", "rest period",
    "inadequate rest", "minimal rest", "poor rest", "short rest", "overnight duty",
    "extended duty", "long duty day", "rest break", "poor rest break",
]
FATIGUE_ALERTNESS_RULES = [
    "alertness", "reduced alertness", "performance", "attention", "focus", "workload",
    "time pressure", "task saturated", "busy", "circadian",
]
FATIGUE_CONTEXT_RULES = [
    "long duty day", "extended duty", "duty period", "circadian", "rest period",
    "inadequate rest", "minimal rest", "poor rest", "short rest", "overnight duty",
    "rest break", "poor rest break",
]
HYPOTHETICAL_PATTERNS = [
    r"\bif(?:\s+\w+){0,5}\s+(?:tired|tiredness|fatigue|fatigued|sleepy|drowsy|exhausted|exhaustion|sharp|alert|alertness)\b",
    r"\b(?:could|might|may|would)\s+have(?:\s+been)?(?:\s+\w+){0,5}\s+(?:tired|tiredness|fatigue|fatigued|sleepy|drowsy|exhausted|exhaustion|sharp|alert|alertness)\b",
    r"\bif\s+not\s+sharp\b",
    r"\bnot\s+sharp\b",
]
THEME_RULES = {
    "fatigue": FATIGUE_KEYWORD_RULES,
    "communication": [
        "communication", "communication breakdown", "miscommunication", "misunderstood",
        "misheard", "readback", "hearback", "coordination", "phraseology", "clarification",
        "communications",
    ],
    "distraction": [
        "distraction", "distracted", "distracting", "interrupted", "interruption",
        "diverted attention", "attention diverted", "lost focus", "loss of focus", "startle",
        "startled",
    ],
    "workload": [
        "workload", "high workload", "task saturated", "task saturation", "busy", "overloaded",
        "overload", "rushed", "hectic", "time pressure",
    ],
    "procedure_checklist": [
        "checklist", "checklists", "check list", "procedure", "procedures", "procedural", "sop",
        "sops", "standard operating procedure", "missed step", "omitted", "skipped",
        "not completed", "failed to complete",
    ],
    "ground_taxi_conflict": [
        "taxiway", "runway incursion", "ground incursion", "surface movement", "hold short",
        "pushback", "tow bar", "taxi conflict", "ground conflict",
    ],
    "approach_landing_instability": [
        "unstable approach", "unstabilized approach", "approach became unstable",
        "unstable on final", "unstable final", "hard landing", "go around", "missed approach",
        "late runway change", "bounced landing", "landing long", "landed long",
        "below glide slope", "above glide slope",
    ],
}
THEME_PRIORITY = [
    "fatigue", "communication", "distraction", "workload", "ground_taxi_conflict",
    "approach_landing_instability", "procedure_checklist",
]
THEME_FLAG_ORDER = [
    "fatigue", "communication", "distraction", "workload", "procedure_checklist",
    "ground_taxi_conflict", "approach_landing_instability",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: narrative feature dictionaries (feature-table stage)
# ---------------------------------------------------------------------------
EXPLICIT_TERMS = [
    "fatigue", "fatigued", "tired", "tiredness", "exhausted", "exhaustion", "sleepy",
    "drowsy", "worn out",
]
CONTEXT_TERMS = [
    "rest period", "rest break", "inadequate rest", "minimal rest", "poor rest", "short rest",
    "sleep", "lack of sleep", "sleep deprived", "sleep deprivation", "overnight duty",
    "extended duty", "long duty day", "duty period", "circadian", "late night",
    "early morning", "reduced alertness",
]
OPERATIONAL_THEME_TERMS = {
    "communication": [
        "communication", "communications", "miscommunication", "misunderstood", "misheard",
        "readback", "hearback", "coordination", "phraseology", "clarification",
    ],
    "workload": [
        "workload", "task saturated", "task saturation", "busy", "overloaded", "overload",
        "rushed", "hectic", "time pressure",
    ],
    "distraction": [
        "distraction", "distracted", "distracting", "interrupted", "interruption",
        "diverted attention", "attention diverted", "lost focus", "loss of focus", "startled",
        "startle",
    ],
    "procedure": [
        "checklist", "checklists", "procedure", "procedures", "procedural", "sop", "sops",
        "standard operating procedure", "missed step", "omitted", "skipped", "not completed",
        "failed to complete",
    ],
    "approach_landing": [
        "unstable approach", "unstabilized approach", "approach became unstable",
        "unstable on final", "unstable final", "hard landing", "go around", "missed approach",
        "late runway change", "bounced landing", "landing long", "landed long",
        "below glide slope", "above glide slope",
    ],
    "ground_taxi": [
        "taxiway", "runway incursion", "ground incursion", "surface movement", "hold short",
        "pushback", "tow bar", "taxi conflict", "ground conflict",
    ],
}
FIRST_PERSON_PATTERN = r"\b(?:i|we|my|our|me|us|mine|ours)\b"
