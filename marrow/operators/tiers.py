"""Review tiers of extraction records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marrow.operators.scoring import flag_count, ratio

TIERS = ("tier_1", "tier_2", "tier_3")


def tier() -> Column:
    """tier_3 for failed records or more than two flags; tier_2 for any doubt; else tier_1.

    A missing M stage is no doubt; an unknown status is judged by flags and T, N alone.
    """
    status, flags = F.col("validation_status"), flag_count(F.col("hallucination_flags"))
    return (
        F.when(status.isin("json_failed", "schema_failed") | (flags > 2), "tier_3")
        .when((status == "vocab_flagged") | (flags >= 1) | F.col("tnm_stage.T").isNull() | F.col("tnm_stage.N").isNull(), "tier_2")
        .otherwise("tier_1")
    )


def classify(records: DataFrame) -> DataFrame:
    return records.withColumn("tier", tier())


def tier_distribution(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of each tier; all three are present, 0.0 for empty input."""
    return classify(records).groupBy(*(by or [])).agg(*[ratio(F.count_if(F.col("tier") == t), F.count(F.lit(1))).alias(f"{t}_rate") for t in TIERS])
