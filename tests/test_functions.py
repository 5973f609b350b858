import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from marrow.functions.grades import grade_steps, laterality, parse_grade
from marrow.functions.text import normalize, pyrepr, pystrip
from marrow.functions.vectors import cosine
from marrow.functions.vocab import grade_ok, tnm_ok
from marrow.operators.profile import _quantile, normal_quantile


def one(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").select("i", expression(F.col("v")).alias("o"))
    return [r.o for r in sorted(rows.collect(), key=lambda r: r.i)]


def test_strip_follows_python(spark):
    values = ["  a ", "\t\na\r\n", "\xa0a\x1c", "", None, "   ", "a b"]
    assert one(spark, values, pystrip) == [None if v is None else v.strip() for v in values]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\x00"), max_size=12), min_size=40, max_size=80))
def test_strip_on_any_text(spark, values):
    assert one(spark, values, pystrip) == [v.strip() for v in values]


def test_normalize_brackets_only_in_site_fields(spark):
    assert one(spark, ["Left Lung (hilum) "], lambda c: normalize(c, "primary_site")) == ["left lung"]
    assert one(spark, ["Left Lung (hilum) "], lambda c: normalize(c, "tumor_grade")) == ["left lung (hilum)"]
    assert one(spark, ["  ", None], lambda c: normalize(c, "primary_site")) == ["", None]


def test_repr_quotes(spark):
    values = ["a", "it's", 'say "x"', "both ' and \"", "back\\slash", "line\nfeed"]
    assert one(spark, values, pyrepr) == [repr(v) for v in values]


@pytest.mark.parametrize(
    ("letter", "good", "bad"),
    [
        ("T", ["pT2", "PT1", "T1", "pTis", "pT4b(mult)", "yT2", "pTX", "pT2\n"], ["ypT2", "pT1mi", "banana", "T5", " pT2", "pT2\r", "T2?"]),
        ("N", ["pN0", "pN1mi", "pN0(i-)(sn)", "pN0(i+) (sn)", "NX"], ["pN01", "N4", "pN?", "N1 "]),
        ("M", ["M0", "pM1", "cM0", "MX", "M1a"], ["M7", "pM01", "yM0", "M"]),
    ],
)
def test_tnm_patterns(spark, letter, good, bad):
    assert one(spark, good + bad, lambda c: tnm_ok(c, letter)) == [True] * len(good) + [False] * len(bad)


def test_grade_vocabulary(spark):
    good = ["Grade 1", "Grade II", " grade iii ", "G2", "GX", "Grade 2–3", "Grade II-III", "NHG1", "High", "moderately to poorly differentiated"]
    bad = ["weird", "grade 5", "x", "grade 1 (of 3)", "Gleason 7", "NHG4"]
    assert one(spark, good + bad, grade_ok) == [True] * len(good) + [False] * len(bad)


def test_grade_tokens_and_steps(spark):
    table = {
        "Grade 2": "G2", "grade II": "G2", "NHG3": "G3", "G1": "G1", "Grade 2-3": "G2-G3", "Grade II–III": "G2-G3", "well differentiated": "G1",
        "moderately to poorly differentiated": "G2-G3", "undifferentiated": "G4", "low": "G1", "high grade": "G3", "GX": None, "": None, "Grade 3 (of 3)": "G3",
    }
    assert one(spark, [*table, None], parse_grade) == [*table.values(), None]
    assert one(spark, ["G2-G3", "G1", None], grade_steps) == [[2, 3], [1], None]


def test_sides(spark):
    assert one(spark, ["Left breast", "RIGHT", "left and right", "bilateral", "cleft", None], laterality) == ["left", "right", "bilateral", "bilateral", None, None]


def test_cosine_edges(spark):
    rows = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0, 1.0], [1.0, 0.0]), (None, [1.0])], "a array<double>, b array<double>")
    got = [r.c for r in rows.select(cosine(F.col("a"), F.col("b")).alias("c")).collect()]
    assert got[:2] == [1.0, 0.0] and math.isclose(got[2], 0.5**0.5) and got[3] is None


def test_quantile_is_close(spark):
    odds = [20.0, 100.0, 1e4, 1e6]
    assert all(abs(a - normal_quantile(b)) < 2e-3 for a, b in zip(one(spark, odds, _quantile, "double"), odds, strict=True))
