"""Controlled vocabularies of coded fields, as Catalyst predicates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marrow.functions.text import grade_key, pyrepr

#: Accepted forms of the three stage codes, compared without case.
TNM_PATTERNS = {
    "T": r"(p|c|y|r|a)?T([0-4][a-c]?|X|is)(\([^)]+\))?",
    "N": r"(p|c|y|r)?N([0-3][a-c]?|X)(mi)?(\s*\([^)]+\))*",
    "M": r"(p|c)?M([01][a-c]?|X)",
}
#: Accepted grades, lower case, Arabic digits, plain hyphens.
GRADES = (
    "grade 1", "grade 2", "grade 3", "grade 4",
    "g1", "g2", "g3", "g4", "gx",
    "grade 1-2", "grade 2-3", "grade 3-4",
    "nhg1", "nhg2", "nhg3",
    "low", "intermediate", "high",
    "well differentiated", "moderately differentiated", "poorly differentiated", "undifferentiated",
    "low grade", "intermediate grade", "high grade",
    "moderate to poorly differentiated", "moderately to poorly differentiated", "poorly to moderately differentiated",
)


def tnm_ok(c: Column, letter: str) -> Column:
    """Whole-value match; a final line feed is tolerated, a carriage return is not."""
    return c.rlike(rf"(?iu)^(?:{TNM_PATTERNS[letter]})(?=\n?\z)")


def grade_ok(c: Column) -> Column:
    return grade_key(c).isin(*GRADES)


def _flag(c: Column, ok: Column, label: str) -> Column:
    return F.when(c.isNotNull() & (c != "") & ~ok, F.concat(F.lit(f"{label}: "), pyrepr(c)))


def vocab_flags(t: Column, n: Column, m: Column, grade: Column) -> Column:
    """Array of complaints in the order T, N, M, grade; nulls and '' are not checked."""
    return F.filter(
        F.array(
            _flag(t, tnm_ok(t, "T"), "invalid_tnm_T"),
            _flag(n, tnm_ok(n, "N"), "invalid_tnm_N"),
            _flag(m, tnm_ok(m, "M"), "invalid_tnm_M"),
            _flag(grade, grade_ok(grade), "unrecognised_grade"),
        ),
        lambda x: x.isNotNull(),
    )
