"""Run history: store, baselines, alerts on drift, change against the run before.

A run's baseline is the mean over the latest finished other runs of its experiment
(``n_baseline``, by end time). Only the latest ``n_baseline`` + 1 finished runs can serve
any run as baseline, so one top-k per experiment is joined to all runs, instead of a query
per run. Metrics that are missing or NaN are left out; comparisons are strict.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from marrow.plans.fields import FIELDS, column_of

#: Thresholds and what they apply to.
TIER1_CHANGE, PASS_DROP, FLAG_RATE, NULL_RISE = 0.10, 0.10, 0.08, 0.15
USAGE_FACTORS = {"mean_output_tokens": 1.5, "mean_latency_s": 2.0}
NULL_METRICS = tuple(f"null_rate_{column_of(f)}" for f in FIELDS)
DELTAS = {"pass_rate": True, "hallucination_rate": False, "weighted_f1": True, "mean_output_tokens": False}
RUN = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("run_id", "experiment", "run_name", "status")]
    + [T.StructField(n, T.TimestampType()) for n in ("start_time", "end_time")]
    + [T.StructField("params", T.MapType(T.StringType(), T.StringType())), T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())), T.StructField("tags", T.MapType(T.StringType(), T.StringType()))]
)


def metric(name: str | Column) -> Column:
    """A logged value; NULL where it is missing or NaN."""
    return F.nanvl(F.col("metrics")[name], F.lit(None).cast("double"))


def latest_finished(runs: DataFrame, n: int) -> DataFrame:
    """The ``n`` finished runs of each experiment that ended last, with their rank."""
    order = W.partitionBy("experiment").orderBy(F.col("end_time").desc_nulls_last(), "run_id")
    return runs.where("status = 'FINISHED'").withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)


def baselines(runs: DataFrame, metrics: list[str], n_baseline: int = 5) -> DataFrame:
    """(run_id, metric, current, baseline, n_prior): every run against its baseline."""
    prior = latest_finished(runs, n_baseline + 1).select("experiment", F.col("run_id").alias("_other"), F.col("metrics").alias("_metrics"), "_rank")
    pairs = (
        runs.select("run_id", "experiment", "metrics")
        .join(prior, (runs["experiment"] == prior["experiment"]) & (F.col("run_id") != F.col("_other")), "left")
        .drop(prior["experiment"])
        .withColumn("_nth", F.row_number().over(W.partitionBy("run_id").orderBy("_rank")))
        .where(F.col("_other").isNull() | (F.col("_nth") <= n_baseline))
    )
    aggs = [F.avg(F.nanvl(F.col("_metrics")[m], F.lit(None).cast("double"))).alias(f"b{k}") for k, m in enumerate(metrics)]
    wide = pairs.groupBy("run_id", "experiment").agg(F.any_value("metrics").alias("metrics"), F.count("_other").alias("n_prior"), *aggs)
    parts = F.array(*[F.struct(F.lit(m).alias("metric"), metric(m).alias("current"), F.col(f"b{k}").alias("baseline")) for k, m in enumerate(metrics)])
    return wide.select("run_id", "experiment", "n_prior", F.explode(parts).alias("p")).select("run_id", "experiment", "n_prior", "p.*")


#: What a monitor says of a run with too few others before it, and of one that lacks the metric.
_FEW, _UNLOGGED = "fewer than 2 finished runs to compare with", "not logged in this run"
WATCHED = ("pass_rate", "tier1_rate", "hallucination_rate", *NULL_METRICS, *USAGE_FACTORS)


def _percent(c: Column) -> Column:
    return F.format_string("%.1f%%", c * 100)


def _change_alert(based: DataFrame, name: str, delta: Column, limit: float, verb: str) -> DataFrame:
    """(run_id, alert, level, message, current, baseline, delta); ``delta`` is 0.0 where there is nothing to compare."""
    d = based.where(F.col("metric") == name)
    known = (F.col("n_prior") >= 2) & F.col("current").isNotNull() & F.col("baseline").isNotNull()
    alert = F.coalesce(known & (delta > limit), F.lit(False))
    level = F.when(F.col("current").isNull(), "OK").when(F.col("n_prior") < 2, "INSUFFICIENT_DATA").when(alert, "WARN").otherwise("OK")
    moved = F.concat(F.lit(f"{name} "), F.when(alert, verb).otherwise("within range"), F.lit(": "), _percent(F.col("baseline")), F.lit(" -> "), _percent(F.col("current")))
    message = F.when(F.col("current").isNull(), f"{name} {_UNLOGGED}").when(F.col("n_prior") < 2, _FEW).when(F.col("baseline").isNull(), f"{name} not logged in the runs before").otherwise(moved)
    return d.select("run_id", alert.alias("alert"), level.alias("level"), message.alias("message"), "current", "baseline", F.when(known, F.round(delta, 4)).otherwise(0.0).alias("delta"))


def tier1_drift(runs: DataFrame, n_baseline: int = 5) -> DataFrame:
    """Share of tier 1 that moved either way; ``delta`` is the distance."""
    return _change_alert(baselines(runs, ["tier1_rate"], n_baseline), "tier1_rate", F.abs(F.col("current") - F.col("baseline")), TIER1_CHANGE, "moved")


def pass_rate_drift(runs: DataFrame, n_baseline: int = 5) -> DataFrame:
    """Pass rate that fell; ``delta`` is the drop, negative where it rose."""
    return _change_alert(baselines(runs, ["pass_rate"], n_baseline), "pass_rate", F.col("baseline") - F.col("current"), PASS_DROP, "fell")


def flag_rate_alert(runs: DataFrame) -> DataFrame:
    """Runs whose flag rate asks for a pause; a rate that was not logged is 0.0."""
    rate = metric("hallucination_rate")
    high = F.coalesce(rate > FLAG_RATE, F.lit(False))
    message = F.when(rate.isNull(), f"hallucination_rate {_UNLOGGED}").otherwise(F.concat(F.lit("hallucination_rate "), F.when(high, "above").otherwise("within"), F.lit(f" {FLAG_RATE:.0%}: "), _percent(rate)))
    return runs.select("run_id", high.alias("alert"), F.when(high, "CRITICAL").otherwise("OK").alias("level"), message.alias("message"), F.coalesce(F.round(rate, 4), F.lit(0.0)).alias("rate"), high.alias("should_pause"))


def _payload(based: DataFrame, metrics: tuple[str, ...], drifted: Column, item: Column, alerts: str, calm: str, warn: str, name: str, shown: Column) -> DataFrame:
    """One row a run: alert, level, message and the array ``alerts`` of its drifted metrics, in their order."""
    d = based.where(F.col("metric").isin(*metrics)).withColumn("_nth", F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col("metric")))
    known = F.col("current").isNotNull()
    hit = F.coalesce(known & (F.col("n_prior") >= 2) & drifted, F.lit(False))
    rows = d.groupBy("run_id").agg(
        F.max("n_prior").alias("n_prior"),
        F.count_if(known).alias("n_logged"),
        F.array_sort(F.collect_list(F.when(hit, F.struct("_nth", item.alias("x"), shown.alias("shown"))))).alias("_found"),
    )
    found, n = F.size("_found") > 0, F.col("n_logged")
    level = F.when(n == 0, "OK").when(F.col("n_prior") < 2, "INSUFFICIENT_DATA").when(found, "WARN").otherwise("OK")
    message = (
        F.when(n == 0, f"{name} {_UNLOGGED}")
        .when(F.col("n_prior") < 2, _FEW)
        .when(found, F.concat(F.lit(f"{warn}: "), F.array_join(F.transform("_found", lambda x: x["shown"]), ", ")))
        .otherwise(F.concat(n.cast("string"), F.lit(f" {calm} within range")))
    )
    return rows.select("run_id", found.alias("alert"), level.alias("level"), message.alias("message"), F.transform("_found", lambda x: x["x"]).alias(alerts))


def null_rate_drift(runs: DataFrame, n_baseline: int = 5) -> DataFrame:
    """One row a run: ``field_alerts`` (field, current, baseline, delta) of the null shares that rose."""
    delta = F.col("current") - F.col("baseline")
    field = F.replace("metric", F.lit("null_rate_"), F.lit(""))
    item = F.struct(field.alias("field"), F.round("current", 4).alias("current"), F.round("baseline", 4).alias("baseline"), F.round(delta, 4).alias("delta"))
    shown = F.concat(field, F.format_string(" (+%.0f%%)", delta * 100))
    return _payload(baselines(runs, list(NULL_METRICS), n_baseline), NULL_METRICS, delta > NULL_RISE, item, "field_alerts", "null shares", "null shares rose", "null shares", shown)


def usage_drift(runs: DataFrame, n_baseline: int = 5) -> DataFrame:
    """One row a run: ``metric_alerts`` (metric, current, baseline, ratio) of tokens and latency beyond their factor."""
    ratio = F.try_divide("current", "baseline")
    item = F.struct("metric", F.round("current", 2).alias("current"), F.round("baseline", 2).alias("baseline"), F.round(ratio, 2).alias("ratio"))
    shown = F.concat(F.col("metric"), F.format_string(" (%.1fx)", ratio))
    return _payload(baselines(runs, list(USAGE_FACTORS), n_baseline), tuple(USAGE_FACTORS), _spike(), item, "metric_alerts", "usage metrics", "usage rose", "usage", shown)


def _spike() -> Column:
    factor = F.create_map(*[F.lit(x) for kv in USAGE_FACTORS.items() for x in kv])[F.col("metric")]
    return (F.col("baseline") > 0) & (F.col("current") > F.col("baseline") * factor)


def all_alerts(runs: DataFrame, n_baseline: int = 5) -> DataFrame:
    """(run_id, monitor, level, detail) of the five monitors, only raised alerts, from one set of baselines."""
    based = baselines(runs, list(WATCHED), n_baseline)
    m, now, before = F.col("metric"), F.col("current"), F.col("baseline")
    drifted = (
        F.when(m == "pass_rate", before - now > PASS_DROP)
        .when(m == "tier1_rate", F.abs(now - before) > TIER1_CHANGE)
        .when(m.startswith("null_rate_"), now - before > NULL_RISE)
        .when(m.isin(*USAGE_FACTORS), _spike())
    )
    raised = F.when(m == "hallucination_rate", now > FLAG_RATE).otherwise(drifted & (F.col("n_prior") >= 2))
    monitor = F.when(m == "pass_rate", "pass_rate").when(m == "tier1_rate", "tier1").when(m == "hallucination_rate", "hallucination").when(m.startswith("null_rate_"), "null_rate").otherwise("usage")
    level = F.when(m == "hallucination_rate", "CRITICAL").otherwise("WARN")
    return based.where(raised).select("run_id", monitor.alias("monitor"), level.alias("level"), F.regexp_replace("metric", "^null_rate_", "").alias("detail"))


def rolling_history(runs: DataFrame, name: str, n_baseline: int = 5) -> DataFrame:
    """Every finished run against the ``n_baseline`` before it, by end time."""
    w = W.partitionBy("experiment").orderBy("end_time", "run_id").rowsBetween(-n_baseline, -1)
    done = runs.where("status = 'FINISHED'").withColumn("value", metric(name))
    return done.select("run_id", "experiment", "value", F.avg("value").over(w).alias("baseline"), F.count(F.lit(1)).over(w).alias("n_prior")).withColumn("delta", F.col("value") - F.col("baseline"))


def deltas(runs: DataFrame) -> DataFrame:
    """(run_id, metric, current, previous, delta, change) against the finished run before, by end time."""
    w = W.partitionBy("experiment").orderBy("end_time", "run_id")
    done = runs.where("status = 'FINISHED'")
    wide = done.select("run_id", *[metric(m).alias(f"c{k}") for k, m in enumerate(DELTAS)], *[F.lag(metric(m)).over(w).alias(f"p{k}") for k, m in enumerate(DELTAS)])
    parts = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"c{k}").alias("current"), F.col(f"p{k}").alias("previous"), F.lit(up).alias("up")) for k, (m, up) in enumerate(DELTAS.items())])
    d = wide.select("run_id", F.explode(parts).alias("x")).select("run_id", "x.*").where("current is not null")
    delta = F.col("current") - F.col("previous")
    return d.select("run_id", "metric", "current", "previous", delta.alias("delta"), F.when(delta.isNull(), "new").when(delta == 0, "same").when((delta > 0) == F.col("up"), "better").otherwise("worse").alias("change"))


def compare_logged(recomputed: DataFrame, run: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """(metric, recomputed, logged, matches) of (metric, value) rows against one run's log."""
    logged = run.select(F.explode("metrics").alias("metric", "logged"))
    return recomputed.join(logged, "metric", "left").select("metric", F.col("value").alias("recomputed"), "logged", F.coalesce(F.abs(F.col("value") - F.col("logged")) < tolerance, F.lit(False)).alias("matches"))


class RunStore:
    """Runs as rows of a parquet table; a run is written once, when it ends."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUN).option("recursiveFileLookup", "false").parquet(f"{self.path}/runs")

    def start(self, experiment: str, model: str, prompt_version: str, params: dict[str, object] | None = None) -> Run:
        return Run(self, experiment, model, prompt_version, params or {})

    def register_prompt(self, version: str, text: str) -> bool:
        """Add a prompt text once per version; True if it was new."""
        schema = "version string, text string"
        new = self.spark.createDataFrame([(version, text)], schema)
        try:
            new = new.join(self.spark.read.schema(schema).parquet(f"{self.path}/prompts"), "version", "left_anti")
        except Exception as error:  # the first prompt: no table yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
        if new.isEmpty():
            return False
        new.write.mode("append").parquet(f"{self.path}/prompts")
        return True


class Run:
    """One tracked run as a context; an error ends it as FAILED and is not suppressed."""

    def __init__(self, store: RunStore, experiment: str, model: str, prompt_version: str, params: dict[str, object]):
        self.store, self.experiment = store, experiment
        self.params = {"model": model, "prompt_version": prompt_version} | {k: str(v) for k, v in params.items()}
        self.metrics: dict[str, float] = {}
        self.tags: dict[str, str] = {}
        self.run_id: str | None = None

    def __enter__(self) -> Run:
        self.started = dt.datetime.now(dt.UTC).replace(tzinfo=None)
        self.run_id = uuid.uuid4().hex
        self.name = f"{self.params['model'].replace(':', '-')}__{self.params['prompt_version']}__{self.started:%Y%m%dT%H%M%S}"
        return self

    def log_metrics(self, metrics: dict[str, float]) -> None:
        self.metrics |= {k: float(v) for k, v in metrics.items()}

    def log_artifact(self, path: str) -> None:
        if Path(path).exists():
            self.tags[f"artifact.{Path(path).name}"] = str(path)
        else:
            logging.getLogger(__name__).warning("artifact not found, skipped: %s", path)

    def log_prompt(self, version: str, text: str) -> None:
        self.store.register_prompt(version, text)
        self.tags["prompt"] = version

    def log_dataset(self, path: str, n_rows: int) -> None:
        self.tags["dataset"] = f"{path} ({n_rows})"

    def __exit__(self, kind, value, trace) -> bool:
        row = (self.run_id, self.experiment, self.name, "FAILED" if kind else "FINISHED", self.started, dt.datetime.now(dt.UTC).replace(tzinfo=None), self.params, self.metrics, self.tags)
        self.store.spark.createDataFrame([row], RUN).coalesce(1).write.mode("append").parquet(f"{self.store.path}/runs")
        return False
