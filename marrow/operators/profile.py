"""Column profile per load, and loads whose columns drift from the others.

Every column is unpivoted to (load, column, value) and counted once; nulls, distinct
values, ranges, failed checks and all comparisons are read off that count table, so
the wide table is scanned once and shuffled once, after map-side counting. A value that
fills a third of a column is one partial count per task, not a hot partition.

Defined cases: an empty table gives no rows; a null load is a load of its own in the
profile and takes no part in the comparison; null, blank and stand-ins for "not known"
are "missing"; a table with one load has no findings; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from marrow.functions.text import pystrip
from marrow.functions.vocab import grade_ok, tnm_ok
from marrow.operators.bounded import collect_bounded
from marrow.session import cut

#: Entries that stand for "not known", compared stripped and lower case.
STAND_INS = (
    "", "-", "--", "?", "unknown", "unk", "not known", "n/a", "na", "n.a.", "nil", "none", "none given", "null",
    "not given", "not stated", "not available", "not applicable", "not recorded", "not provided", "not reported",
    "missing", "pending", "see comment", "see note", "see synoptic table", "same as above",
)

#: Least population stability index over chance of a finding: of two shares, and of a whole mix.
MIN_PSI = {"missing_shift": 0.01, "pattern_shift": 0.01, "mix_shift": 0.06}
MAX_LOADS = 100_000

Check = Callable[[Column], Column]
#: Columns of extractions to describe, and the check of each (None: no check).
EXTRACTION_CHECKS: dict[str, Check | None] = {
    "tnm_stage.T": lambda c: tnm_ok(c, "T"),
    "tnm_stage.N": lambda c: tnm_ok(c, "N"),
    "tnm_stage.M": lambda c: tnm_ok(c, "M"),
    "tumor_grade": grade_ok,
    "histological_diagnosis": None,
    "primary_site": None,
}


def is_missing(value: Column) -> Column:
    return value.isNull() | F.lower(pystrip(value)).isin(*STAND_INS)


def value_counts(df: DataFrame, load: str, checks: Mapping[str, Check | None] = EXTRACTION_CHECKS) -> DataFrame:
    """(load_no, column_name, value, n, missing, failed): one row per distinct value."""
    pairs = ", ".join(f"'{c}', cast({'.'.join(f'`{p}`' for p in c.split('.'))} as string)" for c in checks)
    counted = (
        df.selectExpr(f"`{load}` as load_no", f"stack({len(checks)}, {pairs}) as (column_name, value)")
        .groupBy("load_no", "column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    failed = F.lit(False)
    for name, check in checks.items():
        if check is not None:
            failed = F.when(F.col("column_name") == name, ~check(F.col("value"))).otherwise(failed)
    return counted.withColumn("missing", is_missing(F.col("value"))).withColumn("failed", ~F.col("missing") & F.coalesce(failed, F.lit(False)))


def profile(df: DataFrame, load: str = "load_no", checks: Mapping[str, Check | None] = EXTRACTION_CHECKS) -> DataFrame:
    """One row per load and column: rows, nulls, missing, distincts, ranges, failed checks."""
    n, v = F.col("n"), F.col("value")
    return (
        value_counts(df, load, checks)
        .groupBy("load_no", "column_name")
        .agg(
            F.sum("n").alias("n_rows"),
            F.sum(F.when(v.isNull(), n).otherwise(0)).alias("n_null"),
            F.sum(F.when(F.col("missing"), n).otherwise(0)).alias("n_missing"),
            F.sum(F.when(F.col("failed"), n).otherwise(0)).alias("n_failed"),
            F.count("value").alias("n_distinct"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.min(F.length("value")).cast("bigint").alias("min_length"),
            F.max(F.length("value")).cast("bigint").alias("max_length"),
            F.max(F.when(v.isNotNull(), n)).alias("top_count"),
        )
        .withColumn("null_rate", F.round(F.col("n_null") / F.col("n_rows"), 6))
    )


def mix_key(value: Column) -> Column:
    """Form in which values are compared between loads: lower case, runs of other signs as one space."""
    return F.trim(F.regexp_replace(F.lower(value), r"(?U)[^\p{L}\p{N}]+", " "))


def comparisons(counts: DataFrame, checks: Mapping[str, Check | None]) -> DataFrame:
    """(column_name, finding, load_no, key, n): the category counts that are compared between loads.

    Missing or not over all rows, failed or not over rows that are not missing (columns with
    a check only), and the values over what is left.
    """
    has_check = F.col("column_name").isin(*[c for c, check in checks.items() if check is not None])
    part = lambda finding, use, key: F.when(use, F.struct(F.lit(finding).alias("finding"), key.alias("key")))
    parts = F.array(
        part("missing_shift", F.lit(True), F.col("missing").cast("string")),
        part("pattern_shift", has_check & ~F.col("missing"), F.col("failed").cast("string")),
        part("mix_shift", ~F.col("missing") & ~F.col("failed"), mix_key(F.col("value"))),
    )
    return (
        counts.select("column_name", "load_no", "n", F.explode(F.array_compact(parts)).alias("p"))
        .groupBy("column_name", "p.finding", "load_no", "p.key")
        .agg(F.sum("n").alias("n"))
    )


def distances(cells: DataFrame, min_expected: float = 5.0) -> DataFrame:
    """(column_name, finding, load_no, chi2, df, psi, ...): each load against the median load.

    Categories expected fewer than ``min_expected`` times in the load are pooled. Only
    categories that some load can expect that often are paired with the loads one by one:
    at most 1 / ``min_expected`` of the rows of the largest load.
    """
    group = ["column_name", "finding"]
    loads = cells.groupBy(*group, "load_no").agg(F.sum("n").alias("n_load"))
    collect_bounded(loads.select("load_no").distinct(), MAX_LOADS, "the list of loads")
    # one row a comparison, so that its loads are never the key of a join
    totals = loads.groupBy(*group).agg(F.sum("n_load").alias("n_all"), F.max("n_load").alias("n_most"), F.count(F.lit(1)).alias("tests"), F.collect_list(F.struct("load_no", "n_load")).alias("loads"))
    keys = cells.groupBy(*group, "key").agg(F.sum("n").alias("all_of_key")).join(F.broadcast(totals), group).where(F.col("all_of_key") * F.col("n_most") >= min_expected * F.col("n_all"))
    shown = (
        keys.select(*group, "key", F.explode("loads").alias("l"))
        .select(*group, "key", "l.load_no")
        .join(cells, [*group, "key", "load_no"], "left")
        .groupBy(*group, "key")
        .agg(F.collect_list(F.struct("load_no", F.coalesce("n", F.lit(0)).alias("n"))).alias("found"))
        .join(F.broadcast(totals.select(*group, F.map_from_entries("loads").alias("size"))), group)
        .withColumn("found", F.transform("found", lambda x: F.struct(x["load_no"].alias("load_no"), x["n"].alias("n"), F.col("size")[x["load_no"]].alias("n_load"))))
        .withColumn("base", median(F.transform("found", lambda x: x["n"] / x["n_load"])))
        .select(*group, "base", F.explode("found").alias("x"))
        .select(*group, "base", "x.*")
        .withColumn("expected", F.col("base") * F.col("n_load"))
        .where(F.col("expected") >= min_expected)
        .groupBy(*group, "load_no")
        .agg(
            F.sum((F.col("n") - F.col("expected")) ** 2 / F.col("expected")).alias("chi2"),
            F.count(F.lit(1)).alias("shown"),
            F.sum(psi_term(F.col("n") / F.col("n_load"), F.col("base"))).alias("psi"),
            F.sum("n").alias("n_shown"),
            F.sum("base").alias("base_shown"),
        )
    )
    tail_share = (F.col("n_load") - F.coalesce("n_shown", F.lit(0))) / F.col("n_load")
    return (
        loads.join(shown, [*group, "load_no"], "left")
        .join(F.broadcast(totals.drop("loads", "n_most")), group)
        .withColumn("tail", F.greatest(1 - F.coalesce("base_shown", F.lit(0.0)), F.lit(0.0)))
        .withColumn("tail_share", tail_share)
        .withColumn("has_tail", (F.col("tail") > 1e-9) | (F.col("tail_share") > 1e-9))
        .withColumn("tail_expected", F.greatest(F.col("tail") * F.col("n_load"), F.lit(min_expected)))
        .withColumn("chi2", F.coalesce("chi2", F.lit(0.0)) + F.when(F.col("has_tail"), (F.col("tail_share") * F.col("n_load") - F.col("tail_expected")) ** 2 / F.col("tail_expected")).otherwise(0.0))
        .withColumn("psi", F.coalesce("psi", F.lit(0.0)) + psi_term(F.col("tail_share"), F.col("tail")))
        .withColumn("df", F.greatest(F.coalesce("shown", F.lit(0)) + F.col("has_tail").cast("int") - 1, F.lit(1)))
        .select(*group, "load_no", "n_load", "n_all", "tests", "chi2", "df", "psi")
    )


def find_drift(
    df: DataFrame,
    load: str = "load_no",
    checks: Mapping[str, Check | None] = EXTRACTION_CHECKS,
    alpha: float = 0.1,
    min_psi: Mapping[str, float] = MIN_PSI,
    min_expected: float = 5.0,
) -> DataFrame:
    """(load_no, column_name, finding) of loads that differ from the others beyond chance.

    Each comparison is a chi-square test of a load's category counts against the median load,
    scaled by what the loads vary anyway (the median statistic of all loads over that of pure
    chance, at least 1), and must also exceed a population stability index of ``min_psi`` over
    what chance gives. ``alpha`` is the error over all comparisons together. Of several
    findings the first of missing, pattern, mix is given.
    """
    counts = cut(value_counts(df, load, checks).where("load_no is not null"))  # small; read several times
    found = distances(comparisons(counts, checks), min_expected).where("n_all > n_load")
    middle = F.col("df") * F.pow(1 - 2 / (9 * F.col("df")), 3)  # median of chi-square
    spread_of = F.expr("percentile(ratio, 0.5)").over(W.partitionBy("column_name", "finding"))
    found = found.withColumn("ratio", F.col("chi2") / middle).withColumn("scale", F.greatest(spread_of, F.lit(1.0)))
    # the other loads' own sampling error adds n_load / rest; Wilson-Hilferty: chi-square as a normal deviate
    chi2 = F.col("chi2") / F.col("scale") / (1 + F.col("n_load") / (F.col("n_all") - F.col("n_load")))
    deviate = (F.pow(chi2 / F.col("df"), 1 / 3) - (1 - 2 / (9 * F.col("df")))) / F.sqrt(2 / (9 * F.col("df")))
    by_chance = F.col("df") * (1 / F.col("n_load") + 1 / (F.col("n_all") - F.col("n_load")))
    least = F.create_map(*[F.lit(x) for kv in min_psi.items() for x in kv])[F.col("finding")]
    found = found.withColumns({"deviate": deviate, "limit": _quantile(F.col("tests") * len(checks) * 3 / alpha), "over_chance": F.col("psi") - by_chance})
    order = F.expr("array_position(array('missing_shift', 'pattern_shift', 'mix_shift'), finding)")
    return (
        found.where((F.col("deviate") > F.col("limit")) & (F.col("over_chance") > least))
        .groupBy("load_no", "column_name")
        .agg(F.min_by("finding", order).alias("finding"))
        .select(F.col("load_no").cast("int"), "column_name", "finding")
    )


def psi_term(share: Column, base: Column) -> Column:
    """A category's part of the population stability index; shares of 0 count as 1 in 10,000."""
    return (share - base) * F.log((share + 1e-4) / (base + 1e-4))


def median(values: Column) -> Column:
    """Median of an array."""
    ordered = F.array_sort(values)
    size = F.size(ordered)
    return (F.get(ordered, F.floor((size - 1) / 2).cast("int")) + F.get(ordered, F.floor(size / 2).cast("int"))) / 2


def _quantile(odds: Column) -> Column:
    """Normal quantile exceeded once in ``odds`` draws, by the Abramowitz-Stegun rational form."""
    t = F.sqrt(2 * F.log(odds))
    return t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t * t * t)


def normal_quantile(odds: float) -> float:
    """The exact value that ``_quantile`` approximates, for tests."""
    return NormalDist().inv_cdf(1 - 1 / odds)
