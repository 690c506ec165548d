"""Operators on tiny frames: edges of time, ties, rules, guards, files and manifests."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairn.functions import scalar, temporal
from cairn.operators import aggregate, cohort, joins, reduce, rules
from cairn.operators.quality import fail_on_errors, validate
from cairn.sources import manifests, readers, writers


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_parse_timestamp(spark):
    df = spark.createDataFrame([(x,) for x in ("20240105", "20240105123059", "2024-01-05", "2024-01-05 12:30:59", "2024-01", "bad", "", None, "20241399")], "raw string")
    got = [r[0] for r in df.select(temporal.parse_timestamp(F.col("raw"))).collect()]
    day, moment = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 5, 12, 30, 59)
    assert got == [day, moment, day, moment, None, None, None, None, None]
    with pytest.raises(Exception, match="not a date"):
        df.select(temporal.parse_timestamp_strict(F.col("raw"))).collect()


def test_precision_and_inclusive_end(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-01-05 00:00:00",), (None,)], "raw string")
    assert [r[0] for r in df.select(temporal.precision(F.col("raw"))).collect()] == ["date_only", "timestamp", "timestamp"]
    assert [r[0] for r in df.select(temporal.precision(F.col("raw"), False)).collect()] == ["date_only", "timestamp", None]
    end = df.limit(1).select(temporal.inclusive_end(temporal.parse_timestamp(F.col("raw")), F.lit("date_only"))).first()[0]
    assert end == dt.datetime(2024, 1, 5, 23, 59, 59, 999999)


def test_boundaries_count_crossings(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2, 0, 0, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(temporal.boundaries("day", F.col("a"), F.col("b")), temporal.boundaries("hour", F.col("a"), F.col("b"))).first()[:] == (1, 1)


def test_look_back_bounds(spark):
    index = dt.datetime(2024, 1, 10, 12)
    rows = [(index - dt.timedelta(days=7), "timestamp", True), (index - dt.timedelta(days=7, microseconds=1), "timestamp", False), (dt.datetime(2024, 1, 3), "date_only", True), (index + dt.timedelta(microseconds=1), "timestamp", False), (dt.datetime(2024, 1, 10, 23), "date_only", True)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, kind string, want boolean")
    got = df.select(temporal.in_look_back(F.col("ts"), F.col("kind"), F.lit(index).cast("timestamp_ntz"), 7), "want").collect()
    assert all(a == b for a, b in got)


def test_number_is_soft(spark):
    df = spark.createDataFrame([(x,) for x in ("1e3", " 4.6 ", "x", "", None, "NaN", "0x1", "-.5")], "v string")
    assert [r[0] for r in df.select(scalar.number(F.col("v"))).collect()] == [1000.0, 4.6, None, None, None, None, None, -0.5]


def test_half_visible(spark):
    df = spark.createDataFrame([(45.3,), (1234.6,), (None,)], "v double")
    assert [r[0] for r in df.select(scalar.half_visible_or_null(F.col("v"))).collect()] == [45.3, 1235.0, None]


def test_status_is_three_valued(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert [r[0] for r in df.select(scalar.status(F.col("f"))).collect()] == ["met", "indeterminate", "indeterminate"]
    assert df.select(scalar.any_true(F.lit(None).cast("boolean"), F.lit(False))).first()[0] is None


def test_match_codes_overlap_and_nulls(spark):
    df = spark.createDataFrame([(1, " j96.00 ", "ICD-10"), (2, "J96.1", "icd 10"), (3, None, "ICD10"), (4, "X", "LOINC"), (4, "X", "LOINC")], "id int, code string, system string")
    cat = rules.catalog(spark, [("a", "dx", "ICD10", "J96.00", "exact", True), ("b", "dx", "ANY", "j96", "prefix", True), ("c", "dx", "LOINC", "^X$", "regex", True), ("d", "dx", "ANY", "X", "exact", False)])
    got = sorted(values(rules.match_codes(df, cat, code="code", system="system"), "id", "rule"))
    assert got == [(1, "a"), (1, "b"), (2, "b"), (4, "c"), (4, "c")]
    assert rules.match_codes(df, cat, code="code", system="system", how="left").filter("rule is null").count() == 1


def test_catalog_refuses_bad_rules(spark):
    for rows in ([("a", "d", "s", "c", "like", True)], [("a", "d", "s", "c", "exact", True)] * 2, [("a", "d", "s", "(", "regex", True)]):
        with pytest.raises(Exception):
            rules.catalog(spark, rows)


def test_numeric_rule_first_failure_wins(spark):
    rule = rules.NumericRule("r", exact=("A",), systems=("L",), low=1, high=10, closed_low=True, units={"u": 2.0})
    df = spark.createDataFrame([("A", "L", "1", "u"), ("A", "L", "0.5", "u"), ("A", "L", "5", "u"), ("A", "M", "1", "z"), ("A", "L", "x", "z"), ("A", "L", "x", "u"), ("A", "L", "inf", "u"), ("B", "L", "1", "u")], "code string, system string, v string, unit string")
    judged = rules.numeric_rule(df, rule, code="code", value="v", unit="unit", system="system")
    assert [r["outcome"] for r in judged.collect()] == ["accepted", "accepted", "rejected_range", "rejected_system", "rejected_unit", "rejected_non_numeric", "rejected_non_numeric"]
    assert rules.audit(judged).first()["considered"] == 7


def test_two_level_last_takes_smallest_encounter_on_ties(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, 5, t, 1), (1, 3, t, 2), (1, 9, t - dt.timedelta(1), 3)], "p int, e int, ts timestamp_ntz, id int")
    assert values(reduce.two_level_last(df, patient="p", encounter="e", ts="ts", tie="id"), "e") == [(3,)]


def test_ordered_first_keeps_null_values(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5.0)], "k int, o int, v double")
    assert df.groupBy("k").agg(reduce.first_value("v", "o"), reduce.last_value("v", "o")).first()[1:] == (None, 5.0)


def test_guards(spark):
    left, right = spark.createDataFrame([(1,), (None,)], "k int"), spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="is not unique"):
        joins.guarded_left(left, right, ["k"]).collect()
    with pytest.raises(Exception, match="null in"):
        joins.guarded_left(left, right.limit(1), ["k"], require_keys=True).collect()


def test_merge_update_keeps_old_on_null(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    patch = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    assert sorted(values(joins.merge_update(base, patch, ["k"], ["v"]), "k", "v")) == [(1, "x"), (2, "b"), (3, "c")]


def test_as_of_ties_and_none(spark):
    t = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, 1, t), (2, 9, t)], "id int, k int, ts timestamp_ntz")
    right = spark.createDataFrame([(1, t, 7), (1, t - dt.timedelta(1), 6), (1, t - dt.timedelta(1), 5)], "k int, rts timestamp_ntz, rid int")
    got = joins.as_of_backward(left, right, ["k"], left_ts="ts", right_ts="rts", values=["rid"], tie="rid", left_id=["id"])
    assert sorted(values(got, "id", "rid")) == [(1, 6), (2, None)]


def test_reduce_encounters_drops_rather_than_repairs(spark):
    d = lambda n: dt.datetime(2022, 1, n)
    rows = [(1, 1, d(5), d(2), "IMP"), (1, 1, d(6), d(9), "IMP"), (2, 1, d(3), None, "EMER"), (3, 1, dt.datetime(2021, 12, 31), d(2), "IMP"), (4, 1, d(3), d(4), "OTHER")]
    enc = spark.createDataFrame(rows, "encounter_id int, subject_id int, start timestamp_ntz, end timestamp_ntz, type string")
    got = cohort.reduce_encounters(enc, types=["IMP", "EMER"], not_before="2022-01-01", end_default="2022-01-31", order=[reduce.asc("start")])
    assert values(got, "encounter_id", "los") == [(2, 29)]


def test_empty_tables_keep_schemas(spark):
    df = spark.createDataFrame([], "k int, v double, code string")
    assert aggregate.missingness(df, ["v"]).first()["pct_missing"] is None
    assert aggregate.table_hash(df).first()["rows"] == 0
    assert reduce.keep_first(df, ["k"], [reduce.asc("v")]).columns == df.columns


def test_table_hash_is_order_free(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(None, 2), ("x", 1)], "v string, k int")
    assert aggregate.table_hash(a).first() == aggregate.table_hash(b).first()
    assert aggregate.table_hash(a).first() != aggregate.table_hash(a.limit(1)).first()


def test_validate(spark):
    df = spark.range(3)
    found = validate({"none": df.filter("id > 9"), "some": df})
    assert sorted(values(found, "error", "n")) == [("none", 0), ("some", 3)]
    with pytest.raises(ValueError, match="some: 3"):
        fail_on_errors(found)


def test_csv_union_by_name_and_family(spark, tmp_path):
    (tmp_path / "lab_0002.csv").write_text("b,a\n1,2\n")
    (tmp_path / "lab_0010.csv").write_text("a,b,c\n3,4,5\n6\n")
    (tmp_path / "other.csv").write_text("z\n1\n")
    files = readers.select_family(readers.list_files(spark, f"file://{tmp_path}"), "lab")
    assert [f.rsplit("/", 1)[-1] for f in files] == ["lab_0002.csv", "lab_0010.csv"]
    df = readers.read_csv(spark, files, ["a", "b", "c", "d"])
    assert sorted(values(df, "a", "b", "c", "d")) == [("2", "1", None, None), ("3", "4", "5", None), ("6", None, None, None)]
    report = readers.validate_export(spark, f"file://{tmp_path}", {"lab": ["a", "q"], "gone": ["x"]})
    assert len(report.errors) == 3 and not report.ok


def test_one_csv_keeps_header_of_nothing(spark, tmp_path):
    path = writers.write_one_csv(spark, spark.createDataFrame([], "a int, b int"), f"file://{tmp_path}/x.csv")
    assert (tmp_path / "x.csv").read_text().strip() == "a,b"
    assert readers.header(spark, path) == ["a", "b"]


def test_manifest_stage_and_publish(spark, tmp_path):
    root = f"file://{tmp_path}"
    df = spark.range(5)
    a = manifests.write_manifest(spark, f"{root}/m", {"t": df})
    assert manifests.read_manifest(spark, f"{root}/m")["tables"] == a["tables"]
    key = manifests.identity(config=1)
    assert manifests.stage(spark, f"{root}/s", key, lambda: df).count() == 5
    assert manifests.stage(spark, f"{root}/s", key, lambda: 1 / 0).count() == 5
    with pytest.raises(readers.SourceError):
        manifests.stage(spark, f"{root}/s", "other", lambda: df)
    df.write.parquet(f"{root}/new")
    writers.publish(spark, f"{root}/new", f"{root}/live")
    assert spark.read.parquet(f"{root}/live").count() == 5
    (tmp_path / ".git").mkdir()
    with pytest.raises(readers.SourceError):
        writers.refuse_inside_worktree(f"{root}/deep/er")


def test_many_csv_files_are_few_jobs(spark, tmp_path):
    """200 files take a handful of jobs, not one each for their headers; other headers, odd names, empty and large files keep their columns."""
    path = writers.split_csv(spark.range(2_000).selectExpr("id", "id % 7 AS code"), f"file://{tmp_path}/split", 10)
    files = readers.list_files(spark, path)
    spark.sparkContext.setJobGroup("many files", "")
    try:
        rows = readers.row_counts(readers.read_csv(spark, files)).agg(F.sum("rows"), F.max("rows"), F.count("*")).first()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("many files"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(files) >= 200 and tuple(rows) == (2_000, 10, len(files)) and jobs < 20

    mixed = tmp_path / "a %41 b" / "deep"
    mixed.mkdir(parents=True)
    texts = {"x 1.csv": "id,name\n1,a\n", "y+2.CSV": '"name","id"\nb,2\n', "z%20.csv": "id,other\n3,c\n\n4,d\n", "none.csv": "", "_hidden.txt": "id\n9\n"}
    for name, text in texts.items():
        (mixed / name).write_text(text)
    found = readers.list_files(spark, f"file://{tmp_path}/a %41 b")
    assert [f.rsplit("/", 1)[-1] for f in found] == sorted(n for n in texts if n.lower().endswith(".csv"))
    for most in (readers.SCANNED_FOR_HEADERS, 13):
        before, readers.SCANNED_FOR_HEADERS = readers.SCANNED_FOR_HEADERS, most
        try:
            assert {f.rsplit("/", 1)[-1]: n for f, n in readers.headers(spark, found).items()} == {"x 1.csv": ["id", "name"], "y+2.CSV": ["name", "id"], "z%20.csv": ["id", "other"], "none.csv": []}
            out = readers.read_csv(spark, found, ["id", "name", "other"])
            assert sorted(tuple(r)[:3] for r in out.collect()) == [("1", "a", None), ("2", "b", None), ("3", None, "c"), ("4", None, "d")]
            assert out.select("_file").distinct().count() == 3
        finally:
            readers.SCANNED_FOR_HEADERS = before
