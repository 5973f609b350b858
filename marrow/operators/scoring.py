"""Scores of extractions against gold records.

Predictions and gold are deduplicated by report (the last one wins), joined once on the
report, unpivoted over the fields and counted in one aggregation whose keys are the field
and, where asked, a stratum or a model. Partial aggregation keeps the shuffle at a few
rows per task, however skewed the strata are.

Empty inputs give 0.0 for every rate and still one row per field where there is a key to
give it for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marrow.functions.text import normalize_by
from marrow.plans.fields import FIELDS, PASSED, WEIGHTS, column_of
from marrow.session import cut


def last_by(df: DataFrame, key: str, order: str | Column) -> DataFrame:
    """The last row of each key: one partial and one final aggregation.

    Spark keeps whole rows in such aggregates sorted by key (no window over a hot key, but a
    sort on either side of the shuffle), so callers pass only the columns they need.
    """
    order = F.col(order) if isinstance(order, str) else order
    return df.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), order).alias("_row")).select("_row.*")


def first_by(df: DataFrame, key: str, order: str | Column) -> DataFrame:
    """The first row of each key."""
    order = F.col(order) if isinstance(order, str) else order
    return df.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), order).alias("_row")).select("_row.*")


def slim(df: DataFrame, *more: str) -> DataFrame:
    """Only what scoring reads, so that wide records are neither scanned nor shuffled."""
    plain = [f for f in FIELDS if "." not in f]
    names = dict.fromkeys(["report_id", *more, *plain, "validation_status", "hallucination_flags"])
    stage = F.struct(*[F.col(f"tnm_stage.{n}").alias(n) for n in ("T", "N", "M")]).alias("tnm_stage")
    return df.select(*[c for c in names if c in df.columns], stage)


def any_order(df: DataFrame) -> Column:
    """An order of rows by what they hold, the same wherever they lie."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))


def last_gold(golds: DataFrame, order: Column | None, *more: str) -> DataFrame:
    """One gold row a report: the last by ``order``, without one the largest by content."""
    if order is not None:
        return slim(last_by(golds, "report_id", order), *more)
    few = slim(golds, *more)
    return last_by(few, "report_id", any_order(few))


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0.0 where b is 0 or NULL."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def passed(status: Column) -> Column:
    return F.coalesce(status.isin(*PASSED), F.lit(False))


def flag_count(flags: Column) -> Column:
    return F.coalesce(F.size(flags), F.lit(0))


def field_pairs(preds: DataFrame, golds: DataFrame, by: list[str] | None = None, on: list[str] | None = None) -> DataFrame:
    """(by..., report_id, field, pred, gold): both values in comparison form, one row a field.

    ``golds`` carries the columns ``by``; ``on`` are the join keys, by default the report.
    """
    by, on = by or [], on or ["report_id"]
    p = preds.select(*on, *[F.col(f).alias(f"p_{column_of(f)}") for f in FIELDS], *[F.col(c).alias(f"p_{c}") for c in ("validation_status", "hallucination_flags") if c in preds.columns])
    g = golds.select(*dict.fromkeys([*on, *by]), *[F.col(f).alias(f"g_{column_of(f)}") for f in FIELDS])
    joined = g.join(p, on, "left")
    stack = ", ".join(f"'{f}', p_{column_of(f)}, g_{column_of(f)}" for f in FIELDS)
    keys = list(dict.fromkeys([*by, *on]))
    long = joined.selectExpr(*[f"`{k}`" for k in keys], f"stack({len(FIELDS)}, {stack}) as (field, pred, gold)")
    return long.withColumns({"pred": normalize_by(F.col("pred"), F.col("field")), "gold": normalize_by(F.col("gold"), F.col("field"))})


def count_pairs(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., field, pred, gold, n): how often each pair of values occurs.

    All scores are sums over this table, which has a row per distinct pair, not per report; it
    is kept once for everything that is computed from it.
    """
    return cut(pairs.groupBy(*(by or []), "field", "pred", "gold").agg(F.count(F.lit(1)).alias("n")))


def score_fields(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts and rates of each field (and stratum) over pairs, counted ones or single ones; a wrong value is a miss and a false find."""
    p, g = F.col("pred"), F.col("gold")
    n_of = F.col("n") if "n" in pairs.columns else F.lit(1)
    count = lambda which: F.sum(F.when(which, n_of).otherwise(0)).cast("bigint")
    counted = pairs.groupBy(*(by or []), "field").agg(
        count(p.isNotNull() & g.isNotNull() & (p == g)).alias("tp"),
        count(p.isNotNull() & (g.isNull() | (p != g))).alias("fp"),
        count(g.isNotNull() & (p.isNull() | (p != g))).alias("fn"),
        count(p.isNull() & g.isNull()).alias("tn"),
        count(p.isNull() == g.isNull()).alias("same_nullness"),
        F.sum(n_of).cast("bigint").alias("n_gold"),
    )
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n_gold"))
    return (
        counted.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)})
        .withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
        .withColumns({"exact_match": ratio(tp + tn, n), "null_accuracy": ratio(F.col("same_nullness"), n)})
        .drop("same_nullness")
    )


def field_metrics(preds: DataFrame, golds: DataFrame, order: str = "extraction_id", gold_order: Column | None = None) -> DataFrame:
    """One row per field; ``n_predictions`` counts all predicted reports."""
    n = preds.agg(F.count_distinct("report_id"))
    return score_fields(field_pairs(last_by(slim(preds, order), "report_id", order), last_gold(golds, gold_order))).withColumn("n_predictions", n.scalar())


def weight_of(field: Column) -> Column:
    return F.create_map(*[F.lit(x) for f, w in WEIGHTS.items() for x in (f, float(w))])[field]


def roll_up(scores: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Weighted and plain means of the fields' scores."""
    w = weight_of(F.col("field"))
    return scores.groupBy(*(by or [])).agg(
        ratio(F.sum(w * F.col("f1")), F.sum(w)).alias("weighted_f1"),
        F.coalesce(F.avg("f1"), F.lit(0.0)).alias("mean_f1"),
        F.coalesce(F.avg("exact_match"), F.lit(0.0)).alias("mean_exact_match"),
    )


def aggregate_metrics(preds: DataFrame, golds: DataFrame, order: str = "extraction_id", gold_order: Column | None = None) -> DataFrame:
    """One row; ``n_records`` counts gold rows, repeated ones too; flags count over all predicted rows."""
    rolled = roll_up(field_metrics(preds, golds, order, gold_order))
    rate = hallucination_rate(preds)
    return rolled.withColumns({"hallucination_rate": rate.scalar(), "n_records": golds.agg(F.count(F.lit(1))).scalar()})


def hallucination_rate(preds: DataFrame) -> DataFrame:
    """Share of structurally valid rows with at least one flag; 0.0 without such rows."""
    ok = passed(F.col("validation_status"))
    return preds.agg(ratio(F.count_if(ok & (flag_count(F.col("hallucination_flags")) > 0)), F.count_if(ok)).alias("hallucination_rate"))


def quality_rates(preds: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Pass rate over all rows; flag rate and M null rate over structurally valid ones."""
    ok = passed(F.col("validation_status"))
    return preds.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n_rows"),
        ratio(F.count_if(ok), F.count(F.lit(1))).alias("pass_rate"),
        ratio(F.count_if(ok & (flag_count(F.col("hallucination_flags")) > 0)), F.count_if(ok)).alias("hallucination_rate"),
        ratio(F.count_if(ok & F.col("tnm_stage.M").isNull()), F.count_if(ok)).alias("m_null_rate"),
    )


def field_null_rates(preds: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Null share of every field over structurally valid rows, four decimals."""
    ok = passed(F.col("validation_status"))
    return preds.groupBy(*(by or [])).agg(
        *[F.round(ratio(F.count_if(ok & F.col(f).isNull()), F.count_if(ok)), 4).alias(f"null_rate_{column_of(f)}") for f in FIELDS]
    )


def stratified_metrics(preds: DataFrame, golds: DataFrame, stratum: str, order: str = "extraction_id", gold_order: Column | None = None) -> DataFrame:
    """Rolled-up scores per stratum of the gold records; a null stratum is 'unknown'.

    The flag rate of a stratum is over its matched, deduplicated predictions.
    """
    if stratum not in ("cancer_type", "style"):
        raise ValueError(f"Unsupported stratum {stratum!r}")
    marked = golds.withColumn("stratum", F.coalesce(F.col(stratum), F.lit("unknown")))
    gold = last_gold(marked, gold_order, "stratum")
    pred = last_by(slim(preds, order), "report_id", order)
    rolled = roll_up(score_fields(field_pairs(pred, gold, ["stratum"]), ["stratum"]), ["stratum"])
    sizes = marked.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_records"))
    ok = passed(F.col("validation_status"))
    flags = (
        pred.select("report_id", "validation_status", "hallucination_flags")
        .join(gold.select("report_id", "stratum"), "report_id")
        .groupBy("stratum")
        .agg(ratio(F.count_if(ok & (flag_count(F.col("hallucination_flags")) > 0)), F.count_if(ok)).alias("hallucination_rate"))
    )
    return rolled.join(sizes, "stratum").join(flags, "stratum", "left").withColumn("hallucination_rate", F.coalesce("hallucination_rate", F.lit(0.0)))


def style_lookup(corpus: DataFrame, order: str) -> DataFrame:
    """(report_id, style), the last one of each report; empty ids and styles are left out."""
    return last_by(corpus.where((F.col("report_id") != "") & (F.col("style") != "")).select("report_id", "style", order), "report_id", order).drop(order)


def attach_style(records: DataFrame, lookup: DataFrame) -> DataFrame:
    """``records`` with style: an existing one, else the looked up one, else 'unknown'."""
    found = lookup.select("report_id", F.col("style").alias("_style"))
    own = F.col("style") if "style" in records.columns else F.lit(None).cast("string")
    return records.join(found, "report_id", "left").withColumn("style", F.coalesce(own, F.col("_style"), F.lit("unknown"))).drop("_style")
