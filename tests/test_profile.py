import random

from pyspark.sql import functions as F

from marrow.operators import profile
from marrow.operators.bounded import collect_bounded

SCHEMA = "load_no int, tnm_stage struct<T:string,N:string,M:string>, tumor_grade string, histological_diagnosis string, primary_site string, value string, n int"


def rows(seed=1, loads=8, size=300, change=None):
    r = random.Random(seed)
    out = []
    for load in range(1, loads + 1):
        for _ in range(size):
            row = [load, (r.choice(["pT1", "pT2", "T3"]), "pN0", None if r.random() < 0.5 else "M0"), r.choice(["G1", "G2"]), r.choice(["a", "b", "c"]), r.choice(["x", "y", "unknown"]), "v", 1]
            out.append(change(r, load, row) if change else row)
    return out


def found(spark, data, **kw):
    return {tuple(x) for x in profile.find_drift(spark.createDataFrame(data, SCHEMA), **kw).collect()}


def test_no_findings_without_change(spark):
    assert found(spark, rows()) == set()


def test_each_kind_of_finding(spark):
    def change(r, load, row):
        if load == 2 and r.random() < 0.3:
            row[4] = " N/A "
        if load == 3 and r.random() < 0.3:
            row[2] = "odd"
        if load == 4 and r.random() < 0.5:
            row[3] = "A "
        if load == 5 and r.random() < 0.4:
            row[1] = None
        return row

    assert found(spark, rows(change=change)) == {
        (2, "primary_site", "missing_shift"), (3, "tumor_grade", "pattern_shift"), (4, "histological_diagnosis", "mix_shift"),
        (5, "tnm_stage.T", "missing_shift"), (5, "tnm_stage.N", "missing_shift"), (5, "tnm_stage.M", "missing_shift"),
    }


def test_edges(spark):
    assert found(spark, []) == set()
    assert found(spark, rows(loads=1)) == set()
    assert found(spark, [[None, None, None, None, None, None, None]] * 5) == set()
    empty = profile.profile(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    r = {x.column_name: x for x in profile.profile(spark.createDataFrame([[1, None, "G1", "", "x" * 50_000, "c", 1], [1, None, "odd", None, "b", "c", 1]], SCHEMA)).collect()}
    assert (r["tumor_grade"].n_failed, r["tumor_grade"].n_distinct, r["primary_site"].max_length) == (1, 2, 50_000)
    assert (r["histological_diagnosis"].n_null, r["histological_diagnosis"].n_missing, r["tnm_stage.T"].n_null, r["tnm_stage.T"].min_value) == (1, 2, 2, None)


def test_repeated_rows_do_not_change_findings(spark):
    data = rows()
    assert found(spark, data + data) == set()


def test_bounded(spark):
    df = spark.range(5)
    assert len(collect_bounded(df, 5, "x")) == 5
    try:
        collect_bounded(df.select(F.col("id")), 4, "x")
    except ValueError as e:
        assert "more than 4" in str(e)
    else:
        raise AssertionError
