"""S1/S2/P7 CSV folders, S7/S8 sinks, S9 extract, M3/M4 preprocessing."""
import json
import os
import statistics

from pyspark.sql import functions as F

from conftest import write_csv
from riskmart.operators import models as MD
from riskmart.sources.files import (
    overview_extract, read_csv_folder, read_raw_dataset, read_table, write_summary, write_table,
)


def test_folder_union_by_name_tokens_and_lineage(spark, tmp):
    folder = os.path.join(tmp, "raw")
    write_csv(folder, "a.csv", ["Event ID", "Topic"], [["1", "NA"], ["2", "None"], ["3", "NONE"]])
    write_csv(folder, "b.csv", ["Topic", "Event ID", "State"], [["x", "4", "GA"], ["", "5", "null"]])
    df = read_csv_folder(spark, folder, lineage=True)
    rows = {r["Event ID"]: r for r in df.collect()}
    assert rows["1"]["Topic"] is None and rows["2"]["Topic"] is None and rows["3"]["Topic"] == "NONE"
    assert rows["4"]["State"] == "GA" and rows["5"]["State"] is None and rows["1"]["State"] is None
    assert rows["4"]["raw_file_name"] == "b.csv"
    assert read_raw_dataset(spark, folder).columns[:2] == ["event_id", "topic"]
    assert read_csv_folder(spark, os.path.join(tmp, "none"), columns_if_empty=["a"]).count() == 0


def test_sinks_and_extract(spark, tmp):
    empty = spark.createDataFrame([], "a string, b long")
    write_table(empty, os.path.join(tmp, "t_csv"), "csv")
    write_table(empty, os.path.join(tmp, "t_pq"))
    assert read_table(spark, os.path.join(tmp, "t_pq")).count() == 0
    assert read_table(spark, os.path.join(tmp, "missing")) is None
    write_summary(spark.createDataFrame([("trained", 0.75)], "status string, accuracy double"), os.path.join(tmp, "s"))
    part = [f for f in os.listdir(os.path.join(tmp, "s")) if f.endswith(".json")][0]
    assert json.loads(open(os.path.join(tmp, "s", part)).readline())["status"] == "trained"
    ov = spark.createDataFrame([("2025-01", "ATL", "Southeast", 3, 1.5, "basis")],
                               "report_month string, airport string, region string, legs long, avg double, data_basis string")
    ex = overview_extract(ov)
    assert dict(ex.dtypes) == {"report_month": "date", "airport": "string", "region": "string", "legs": "double",
                               "avg": "double", "data_basis": "string"}


def test_impute_and_one_hot(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "b"), (4.0, "a"), (None, None)], "x double, c string")
    out = MD.impute(df, ["x"], ["c"]).collect()
    assert out[-1].x == 2.5 and out[-1].c == "a"  # exact median; most frequent, smallest on ties
    index = MD.category_index(MD.impute(df, ["x"], ["c"]), ["c"])
    assert sorted((r.value, r["index"]) for r in index.collect()) in ([("a", 0), ("b", 1)], [("a", 1), ("b", 0)])
    unseen = spark.createDataFrame([(1, 1.0, "zzz"), (2, 2.0, "b"), (3, 0.0, None)], "k int, x double, c string")
    rows = {r.k: [tuple(e) for e in r.entries] for r in MD.one_hot(unseen, "k", ["x"], ["c"], index).collect()}
    b = {r.value: r["index"] for r in index.collect()}["b"] + 1
    assert rows == {1: [(0, 1.0)], 2: [(0, 2.0), (b, 1.0)], 3: []}  # unseen category -> all-zero block


def test_medians_and_modes_of_many_values(spark):
    for values in ([3.0, 1.0, 2.0], [4.0, 1.0, 2.0, 9.0], [5.0] * 9 + [1.0], [float(i * i % 97) for i in range(501)]):
        df = spark.createDataFrame([(v, None if i % 3 else "x") for i, v in enumerate(values)] + [(None, "y")], "x double, c string")
        got = MD.impute(df, ["x"], ["c"]).where("c is not null").collect()
        assert {r.x for r in got if r.x not in values} <= {statistics.median(values)}
        assert MD.medians(df, ["x"])["x"] == statistics.median(values)
    assert MD.modes(spark.createDataFrame([("b",), ("a",), (None,), (None,)], "c string"), ["c"]) == {"c": "a"}
    assert MD.medians(spark.createDataFrame([], "x double"), ["x"]) == {"x": None}


def test_drifting_headers_keep_source_order(spark, tmp):
    from riskmart.operators.quality import keep_first
    from riskmart.sources.files import SOURCE_ORDER
    write_csv(tmp, "b.csv", ["v", "k"], [["late", "1"], ["only", "2"]])
    write_csv(tmp, "a.csv", ["k", "w"], [["1", "early"], ["1", "later"]])
    rows = {r.k: r for r in keep_first(read_csv_folder(spark, tmp, order=True), ["k"], SOURCE_ORDER).collect()}
    assert rows["1"].w == "early" and rows["1"].v is None and rows["2"].v == "only"


def test_first_records_of_any_file(spark, tmp):
    from riskmart.sources.files import first_records, list_csv_files
    folder = os.path.join(tmp, "raw é%20 #1")
    os.makedirs(folder)
    files = {"a b.csv": "k,v\n1,2\n", "c%41.csv": "﻿k,v\r\n3,4\r\n", "é#1.csv": '"k\n1","v, ""w"""\n5,6\n', "empty.csv": "", "blank.csv": "\n\nk,v\n7,8\n"}
    for name, text in files.items():
        open(os.path.join(folder, name), "w", encoding="utf-8", newline="").write(text)
    with open(os.path.join(folder, "long.csv"), "w") as fh:  # several splits and batches
        fh.write("k,v\n" + "".join(f"{i},{'x' * 50}\n" for i in range(60_000)))
    listed = list_csv_files(spark, folder)
    assert len(listed) == 6
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    groups = first_records(spark, listed, 1)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == kept
    name = {head: sorted(os.path.basename(p) for p in paths) for head, paths in groups.items()}
    assert name == {(("k", "v"),): ["a b.csv", "blank.csv", "c%41.csv", "long.csv"], (("k\n1", 'v, "w"'),): ["é#1.csv"]}
    assert read_csv_folder(spark, [folder]).where("k is not null").count() == 60_003
    assert first_records(spark, [], 1) == {}


def test_two_row_headers_in_one_scan(spark, tmp):
    from riskmart.sources.files import read_two_row_header_exports
    for n in range(12):  # many files a task; the second header row and the separator also occur as data
        rows = [["Place", "Date"], [",", "----"], [f"id{n}", "x"], ["Place", "Date"]] + [[f"row{n}-{i}", "y"] for i in range(n * 400)]
        write_csv(os.path.join(tmp, "r"), f"f{n:02d}.csv", ["A", "B"], rows)
    write_csv(os.path.join(tmp, "r"), "short.csv", ["A", "B"], [["Place", "Date"]])
    for lines in (True, False):
        kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")  # a file in many blocks where lines are read
        try:
            df = read_two_row_header_exports(spark, os.path.join(tmp, "r"), multi_line=lines)
            plan = df._jdf.queryExecution().executedPlan().toString()
            got = sorted((r.raw_file_name, r["A_Place"]) for r in df.collect())
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
        want = sorted([(f"f{n:02d}.csv", v) for n in range(12) for v in [f"id{n}", "Place"] + [f"row{n}-{i}" for i in range(n * 400)]])
        assert got == want
        assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_medians_of_many_columns_at_once(spark):
    import random
    rnd = random.Random(5)
    columns = {f"c {i}.x": [rnd.choice([None, rnd.random(), 1e9 * rnd.random(), -5.0, 7.0]) for _ in range(3000 + i % 2)] for i in range(8)}
    columns["rare"] = [None] * 2999 + [4.5]
    columns["none"] = [None] * 3000
    rows = list(zip(*[v[:3000] for v in columns.values()]))
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns)).repartition(6)
    got = MD.medians(df, list(columns))
    for c, v in columns.items():
        known = [x for x in v[:3000] if x is not None]
        assert got[c] == (statistics.median(known) if known else None), c
    assert MD.medians(df, []) == {} and MD.modes(df, []) == {}
    values = spark.createDataFrame([(float(i),) for i in range(100_000)], "x double")
    assert MD.medians(values, ["x"])["x"] == 49_999.5


def test_rows_without_an_order_are_not_dealt(spark, tmp, monkeypatch):
    from riskmart.plans import catalog
    from riskmart.sources import files
    plans, write = [], files.write_table

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, *args)

    monkeypatch.setattr(files, "write_table", seen)
    df = spark.createDataFrame([("a", 2), ("b", 1), ("a", 1)], "ev_id string, n int")
    catalog._as_csv(df, f"{tmp}/dealt", ["ev_id"], ["n"])
    catalog._as_csv(df, f"{tmp}/as-is", ["ev_id"], [])
    assert "Repartition" in plans[0] and "Repartition" not in plans[1]
    assert sorted(tuple(r) for r in files.read_csv_folder(spark, f"{tmp}/as-is").collect()) == [("a", "1"), ("a", "2"), ("b", "1")]
