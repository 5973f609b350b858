"""Models side by side on one gold set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marrow.operators import scoring, semantic
from marrow.operators.bounded import collect_bounded

MAX_MODELS = 1000


def record_cost(prices: DataFrame | None, records: DataFrame) -> DataFrame:
    """``records`` with ``cost`` by a table (model, input_price, output_price) per million tokens; unknown models cost 0."""
    if prices is None:
        return records.withColumn("cost", F.lit(0.0))
    known = prices.select("model", "input_price", "output_price")
    cost = (F.coalesce("input_tokens", F.lit(0)) * F.col("input_price") + F.coalesce("output_tokens", F.lit(0)) * F.col("output_price")) / 1e6
    return records.join(known, "model", "left").withColumn("cost", F.coalesce(cost, F.lit(0.0))).drop("input_price", "output_price")


def cost_per_model(records: DataFrame, prices: DataFrame | None) -> DataFrame:
    return record_cost(prices, records).groupBy("model").agg(F.avg("cost").alias("cost_per_record"), F.sum("cost").alias("total_cost"), F.count(F.lit(1)).alias("n_rows"))


def comparison_matrix(
    preds: DataFrame,
    golds: DataFrame,
    embedder: semantic.Embedder,
    prices: DataFrame | None = None,
    traits: DataFrame | None = None,
    order: str = "extraction_id",
    gold_order: Column | None = None,
) -> DataFrame:
    """One row per model: scores over all gold records, flag rate, cost, latency.

    ``traits`` (model, trait) adds a yes/no trait, false where a model isn't listed. Every
    model is scored on every gold record, so gold rows are repeated per model; the list of
    models is small and checked.
    """
    models = [r[0] for r in collect_bounded(preds.select("model").where("model is not null").distinct(), MAX_MODELS, "the list of models")]
    gold = scoring.last_gold(golds, gold_order)
    each = gold.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models]) if models else F.expr("cast(array() as array<string>)")))
    few = scoring.slim(preds.where("model is not null"), "model", order)
    pred = few.groupBy("model", "report_id").agg(F.max_by(F.struct(*[c for c in few.columns if c not in ("model", "report_id")]), order).alias("r")).select("model", "report_id", "r.*")
    pairs = scoring.count_pairs(scoring.field_pairs(pred, each, ["model"], ["model", "report_id"]), ["model"])
    fields = scoring.score_fields(pairs, ["model"])
    sims = semantic.semantic_metrics(semantic.score_pairs(pairs, embedder), ["model"])
    means = sims.groupBy("model").agg(F.avg("mean_similarity").alias("mean_similarity"), F.avg("mean_similarity_complete").alias("mean_similarity_complete"))
    ok = scoring.passed(F.col("validation_status"))
    usage = (
        record_cost(prices, preds.select("model", "input_tokens", "output_tokens", "latency_ms", "validation_status", "hallucination_flags"))
        .groupBy("model")
        .agg(
            F.avg("cost").alias("avg_cost"),
            F.avg("latency_ms").alias("avg_latency_ms"),
            scoring.ratio(F.count_if(ok & (scoring.flag_count(F.col("hallucination_flags")) > 0)), F.count_if(ok)).alias("hallucination_rate"),
        )
    )
    out = semantic.combined_score(fields, sims, ["model"]).join(scoring.roll_up(fields, ["model"]).select("model", "weighted_f1"), "model").join(means, "model").join(usage, "model")
    if traits is not None:
        out = out.join(traits.select("model", "trait"), "model", "left")
    rounded = {c: F.round(c, 4) for c in ("combined_score", "weighted_f1", "mean_similarity", "mean_similarity_complete", "hallucination_rate")}
    out = out.withColumns(rounded | {"avg_cost": F.round("avg_cost", 6), "avg_latency_ms": F.round("avg_latency_ms", 1)})
    return out.withColumn("trait", F.coalesce("trait", F.lit(False))) if traits is not None else out
