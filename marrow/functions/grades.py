"""Grades and sides as comparable tokens."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marrow.functions.text import arabic_grades, let, plain_dashes, pylower, pystrip

#: Wordings and the grade they state, tried in this order.
WORDED = (
    ("moderate to poorly differentiated", "G2-G3"),
    ("moderately to poorly differentiated", "G2-G3"),
    ("poorly to moderately differentiated", "G2-G3"),
    ("well differentiated", "G1"),
    ("moderately differentiated", "G2"),
    ("poorly differentiated", "G3"),
    ("undifferentiated", "G4"),
)
#: Whole entries and the grade they state.
PLAIN = (("low", "G1"), ("low grade", "G1"), ("intermediate", "G2"), ("intermediate grade", "G2"), ("high", "G3"), ("high grade", "G3"))
#: Patterns of a stated range and of a stated step.
_RANGE = r"(?U)\bgrade\s*([1-4])\s*-\s*([1-4])\b"
_NUMBER = r"(?U)\b(?:grade|nhg|g)\s*([1-4])\b"


def parse_grade(c: Column) -> Column:
    """'G1' to 'G4', a range 'Ga-Gb', or NULL where no grade is stated."""
    text = pystrip(F.regexp_replace(c, r"(?U)\s*\([^)]*\)", ""))
    return let(arabic_grades(plain_dashes(pylower(text))), _grade_of_key)


def _grade_of_key(key: Column) -> Column:
    out = F.when(key.rlike(_RANGE), F.concat(F.lit("G"), F.regexp_extract(key, _RANGE, 1), F.lit("-G"), F.regexp_extract(key, _RANGE, 2)))
    for words, grade in WORDED:
        out = out.when(F.contains(key, F.lit(words)), F.lit(grade))
    out = out.when(key.rlike(_NUMBER), F.concat(F.lit("G"), F.regexp_extract(key, _NUMBER, 1)))
    for entry, grade in PLAIN:
        out = out.when(key == entry, F.lit(grade))
    return out


def grade_steps(token: Column) -> Column:
    """All steps of a grade token as an array; NULL for NULL."""
    digits = F.transform(F.regexp_extract_all(token, F.lit(r"([1-4])"), F.lit(1)), lambda d: d.cast("int"))
    return F.when(token.isNotNull(), F.sequence(F.array_min(digits), F.array_max(digits)))


def laterality(c: Column) -> Column:
    """'left', 'right' or 'bilateral' (also where both sides are named); NULL if no side is."""
    return let(pylower(c), _side_of)


def _side_of(low: Column) -> Column:
    left, right, both = (low.rlike(rf"(?U)\b{w}\b") for w in ("left", "right", "bilateral"))
    return F.when(both | (left & right), "bilateral").when(left, "left").when(right, "right")
