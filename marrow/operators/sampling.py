"""Stratified development subset."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

#: Parts of a cell that are ranked on their own first.
BUCKETS = 1024


def dev_subset(records: DataFrame, n: int = 20, seed: int = 42, key: str = "report_id") -> DataFrame:
    """``n`` records spread over cancer type and style in proportion, at least one each while they last.

    Deterministic for a seed, whatever the partitioning. Ties and order follow a keyed hash.
    No record beyond the first ``n`` of its cell can be picked, so each bucket of a cell gives
    its first ``n`` keys and only those are ranked together; a cell of a third of all rows is
    ranked in ``BUCKETS`` parts, and whole records are fetched for the picked keys alone.
    """
    salt = F.xxhash64(F.col(key), F.lit(seed))
    keys = records.select(F.col(key).alias("_key"), F.coalesce("cancer_type", F.lit("")).alias("_c"), F.coalesce("style", F.lit("")).alias("_s"), salt.alias("_salt"))
    sizes = keys.groupBy("_c", "_s").agg(F.count(F.lit(1)).alias("_size"))
    total = sizes.agg(F.sum("_size")).scalar()
    quotas = sizes.withColumn("_quota", F.greatest(F.lit(1), F.rint(F.lit(n) * F.col("_size") / total).cast("int"))).drop("_size")
    cell = ["_c", "_s"]
    few = keys.withColumn("_bucket", F.pmod(F.xxhash64("_key", "_salt"), F.lit(BUCKETS)))
    few = few.withColumn("_rank", F.row_number().over(W.partitionBy(*cell, "_bucket").orderBy("_salt", "_key"))).where(F.col("_rank") <= n)
    ranked = few.withColumn("_rank", F.row_number().over(W.partitionBy(*cell).orderBy("_salt", "_key"))).where(F.col("_rank") <= n).join(F.broadcast(quotas), cell)
    # within quotas first, then the rest; of each in hash order
    order = [F.when(F.col("_rank") <= F.col("_quota"), 0).otherwise(1), "_salt", "_key"]
    picked = ranked.orderBy(*order).limit(n).select("_key", *cell, F.row_number().over(W.partitionBy("_key", *cell).orderBy("_salt")).alias("_nth"))
    marked = records.withColumn("_nth", F.row_number().over(W.partitionBy(key, F.coalesce("cancer_type", F.lit("")), F.coalesce("style", F.lit(""))).orderBy(F.lit(1))))
    same = (marked[key].eqNullSafe(picked["_key"])) & (F.coalesce(marked["cancer_type"], F.lit("")) == picked["_c"]) & (F.coalesce(marked["style"], F.lit("")) == picked["_s"]) & (marked["_nth"] == picked["_nth"])
    return marked.join(F.broadcast(picked), same, "left_semi").drop("_nth")
