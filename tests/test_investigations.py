"""Three-file investigation source and trusted investigations (FIXTURES section 3)."""
import os

from pyspark.sql import functions as F

from conftest import write_csv
from riskmart.plans.trusted import investigation_events, trusted_investigations
from riskmart.sources.files import read_investigation_files

EV = ["ev_id", "ev_date", "ev_type", "ev_highest_injury", "ev_nr_apt_id", "inj_tot_f", "inj_tot_n", "inj_tot_t"]


def test_events_children_and_normalisation(spark, tmp):
    folder = os.path.join(tmp, "ntsb")
    write_csv(folder, "ntsb_events.csv", EV, [
        ["E1", "2025-01-02", "ACC", "", "ATL", 0, 0, 0],          # blank severity, totals 0 -> NONE (G6)
        ["E2", "2025-01-06", "INC", None, "DTW", 0, 0, 0],        # NULL severity, filled from injury file (J2)
        ["E3", "2025-01-10", "in-flight o'hare", "", " ", 0, 2, 0],  # uninjured 2 -> not inferred (Q6) -> dropped
        ["E4", "2025-01-15", "HARD LANDING", "None", "SEA", 1, 0, 1],  # literal None -> NULL -> dropped
        ["E5", "2025-01-20", "in-flight o'hare", "FATL", "", 1, 0, 1],
        ["E5", "2025-01-21", "ACC", "FATL", "BOS", 1, 0, 1],      # duplicate id: first kept
        ["E6", "2025-03-01", "ACC", "FATL", "BOS", 1, 0, 1],      # outside window
    ])
    write_csv(folder, "ntsb_aircraft.csv", ["ev_id", "oper_name", "damage"], [
        ["E1", "  ", "minr"], ["E1", "Delta Air Lines", "DEST"], ["E2", "SkyWest Airlines", "Bent Prop"],
    ])
    write_csv(folder, "ntsb_injury.csv", ["ev_id", "injury_level", "inj_person_count"], [
        ["E2", "MINR", "2"], ["E2", "SERS", "0"], ["E2", "FATL", "junk"], ["E2", "MINR", "1"],
    ])
    events, aircraft, injury, lineage = read_investigation_files(spark, folder)
    assert lineage == "ntsb_events.csv|ntsb_aircraft.csv|ntsb_injury.csv"
    merged = investigation_events(events, aircraft, injury, F.col("src_row"), lineage)
    t = {r.ntsb_event_id: r for r in trusted_investigations(merged, ["src_row"]).collect()}
    assert sorted(t) == ["E1", "E2", "E5"]
    e1 = t["E1"]
    assert (e1.severity_normalized, e1.operator_name, e1.aircraft_damage, e1.investigation_category) == \
        ("no_injury", "Delta Air Lines", "minor", "accident")
    e2 = t["E2"]
    assert (e2.severity_normalized, e2.aircraft_damage, e2.event_type, e2.airport_code) == \
        ("minor_injury", "bent_prop", "Incident", "DTW")
    e5 = t["E5"]
    assert (e5.event_type, e5.investigation_category, e5.airport_code, e5.operator_name, e5.aircraft_damage) == \
        ("In-Flight O'Hare", "other_or_unknown", "UNKNOWN", "UNKNOWN", "unknown")
    assert str(e5.event_date) == "2025-01-20"


def test_missing_events_file(spark, tmp):
    assert read_investigation_files(spark, os.path.join(tmp, "none"))[0] is None
