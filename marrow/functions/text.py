"""Text expressions that follow Python's string rules inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: The dashes that count as a hyphen.
DASHES = "‐‑‒–—―−"
_EDGE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
#: Fields whose parenthesised remarks do not take part in a comparison.
PAREN_FREE = ("primary_site", "specimen_type")


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``c`` with ``c`` evaluated once, however often ``body`` mentions it.

    Without it a CASE chain over a long expression repeats that expression in every branch.
    """
    return F.get(F.transform(F.array(c), body), F.lit(0))


def pystrip(c: Column) -> Column:
    """Strip every Unicode space at both ends; ``trim`` only knows U+0020."""
    return F.regexp_replace(c, _EDGE, "")


def pylower(c: Column) -> Column:
    return F.lower(c)


def normalize(c: Column, field: str | None = None) -> Column:
    """Stripped lower-case text; free-text site fields also lose bracketed remarks.

    NULL stays NULL; blank text becomes '' and still counts as a value.
    """
    out = pylower(pystrip(c))
    if field in PAREN_FREE:
        out = pystrip(F.regexp_replace(out, r"(?U)\s*\([^)]*\)", ""))
    return out


def normalize_by(c: Column, field: Column) -> Column:
    """As ``normalize`` where the field name is itself a column (after an unpivot)."""
    bare = lambda x: pystrip(F.regexp_replace(x, r"(?U)\s*\([^)]*\)", ""))
    return let(pylower(pystrip(c)), lambda x: F.when(field.isin(*PAREN_FREE), bare(x)).otherwise(x))


def plain_dashes(c: Column) -> Column:
    return F.regexp_replace(c, f"[{DASHES}]", "-")


def arabic_grades(c: Column) -> Column:
    """Roman numerals I to IV as whole words, in lower-case text, become digits."""
    for roman, digit in (("iv", "4"), ("iii", "3"), ("ii", "2"), ("i", "1")):
        c = F.regexp_replace(c, rf"(?U)\b{roman}\b", digit)
    return c


def grade_key(c: Column) -> Column:
    """Comparison form of a grade: stripped, lower case, plain dashes, Arabic digits."""
    return arabic_grades(plain_dashes(pylower(pystrip(c))))


def pyrepr(c: Column) -> Column:
    """Text in quotes as Python prints it: single quotes unless only those occur inside."""
    inner = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        inner = F.replace(inner, F.lit(raw), F.lit(shown))
    has_single, has_double = F.contains(c, F.lit("'")), F.contains(c, F.lit('"'))
    return (
        F.when(has_single & ~has_double, F.concat(F.lit('"'), inner, F.lit('"')))
        .when(has_single & has_double, F.concat(F.lit("'"), F.replace(inner, F.lit("'"), F.lit("\\'")), F.lit("'")))
        .otherwise(F.concat(F.lit("'"), inner, F.lit("'")))
    )
