import pytest
from pyspark.sql import functions as F

from riskmart.operators.quality import (
    DataQualityError, count_duplicate_surplus, keep_first, validate_label, validate_no_duplicates,
    validate_null_threshold, validate_required_columns,
)


def test_keep_first_partition_independent(spark):
    rows = [(k % 7 if k % 11 else None, k, f"v{k}") for k in range(200)]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    outs = []
    for n in (1, 2, 8):
        outs.append(sorted((tuple(r) for r in keep_first(df.repartition(n), ["k"], ["o"]).collect()), key=repr))
    assert outs[0] == outs[1] == outs[2]
    assert len(outs[0]) == 8  # 7 keys + the NULL key group
    again = keep_first(keep_first(df, ["k"], ["o"]), ["k"], ["o"])
    assert sorted((tuple(r) for r in again.collect()), key=repr) == outs[0]  # idempotent


def test_checks_raise(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, None), (3, "b")], "id int, x string")
    with pytest.raises(DataQualityError):
        validate_required_columns(df, ["id", "missing"])
    with pytest.raises(DataQualityError):
        validate_null_threshold(df, 0.2)
    validate_null_threshold(df, 0.5)
    with pytest.raises(DataQualityError):
        validate_no_duplicates(df, ["id"])
    assert count_duplicate_surplus(df, ["id"]).first()["duplicate_rows"] == 1
    with pytest.raises(DataQualityError):
        validate_label(df.withColumn("y", F.lit("x")), "y")
    assert validate_label(df.withColumn("y", F.lit("1.0")), "y").first()["y"] == 1


def test_checks_of_the_write_jobs(spark, tmp):
    from riskmart.operators.text_rules import write_narrative_features
    from riskmart.plans.trusted import write_trusted_culture
    from riskmart.functions import dictionaries as D
    columns = list(D.CULTURE_REQUIRED)
    rows = [tuple(f"{c}{i}" for c in columns) for i in (1, 1, 2)]
    raw = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], [*columns, "src_row"])
    write_trusted_culture(raw, ["src_row"], f"{tmp}/c")
    assert spark.read.parquet(f"{tmp}/c").count() == 2
    with pytest.raises(DataQualityError):
        write_trusted_culture(raw.withColumn(columns[-1], F.lit(None).cast("string")), ["src_row"], f"{tmp}/d")
    nlp = spark.createDataFrame([("r1", "2025-01-01", "i was tired.", "1"), ("r2", "2025-01-01", "", "x")],
                                "report_id string, event_date string, narrative_clean string, weak_fatigue_label string")
    with pytest.raises(DataQualityError):
        write_narrative_features(nlp, f"{tmp}/f")
    write_narrative_features(nlp.where("report_id = 'r1'"), f"{tmp}/f")
    assert spark.read.parquet(f"{tmp}/f").first().weak_fatigue_label == 1


def test_checkpoint_folder_is_required_on_a_cluster():
    from riskmart.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        checkpoint_dir(Session())


def test_profiles_add_up(spark):
    from riskmart.operators.quality import column_profile, merged_profile, null_ratio, null_ratios, value_distributions, varies
    rows = [(f"2025-0{i % 3 + 1}", None if i % 4 == 0 else i % 5, "same" if i % 2 else None, [i], 0.5 * i) for i in range(40)]
    df = spark.createDataFrame(rows, "month string, n int, s string, a array<int>, `odd name` double")
    months = column_profile(df, by=["month"])
    assert months.count() == 3 * 4
    whole = {r.column_name: tuple(r) for r in column_profile(df.drop("month")).collect()}
    assert {r.column_name: tuple(r) for r in merged_profile(months).collect()} == whole
    assert {c: w[1:3] for c, w in whole.items()} == {"n": (40, 10), "s": (40, 20), "a": (40, 0), "odd name": (40, 0)}
    assert {r.column_name: r.v for r in merged_profile(months).select("column_name", varies().alias("v")).collect()} == {
        "n": True, "s": False, "a": True, "odd name": True}
    assert {r.column_name: r.null_ratio for r in null_ratios(df).collect()}["n"] == 0.25
    empty = column_profile(df.limit(0), ["n"]).select("row_count", "null_count", null_ratio().alias("r"), varies().alias("v")).first()
    assert tuple(empty) == (0, 0, None, False)
    counts = {(r.column_name, r.value): r.row_count for r in value_distributions(df, ["s", "n"]).collect()}
    assert counts["s", None] == 20 and counts["s", "same"] == 20 and counts["n", None] == 10
