"""Registered queries of the core: callables over (spark, data folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from marrow.functions.grades import laterality, parse_grade
from marrow.functions.text import normalize, pystrip
from marrow.functions.vectors import cosine
from marrow.functions.vocab import vocab_flags
from marrow.operators import compare, extract, profile, prompts, runs, sampling, scoring, semantic, tiers, validate
from marrow.plans.fields import FIELDS, column_of
from marrow.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
_six = lambda *names: {n: F.round(n, 6) for n in names}


def _preds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extractions")


def _golds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gold_records")


def _embedder(spark: SparkSession, d: str) -> semantic.LookupEmbedder:
    """Vectors of the embeddings table, by a plain function of the string; for checks only."""
    return semantic.LookupEmbedder(table(spark, d, "embeddings"), "vec_id", "embedding", (F.char_length("value") * 31 + F.ascii("value")) % table(spark, d, "embeddings").agg(F.count(F.lit(1))).scalar())


def _units(spark: SparkSession) -> DataFrame:
    """Neutral price table: one unit a million tokens in, four out."""
    return spark.createDataFrame([("gpt-4o", 1.0, 4.0), ("o4-mini", 1.0, 4.0)], "model string, input_price double, output_price double")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return profile.find_drift(table(spark, d, "extractions"))


def p3_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.profile(table(spark, d, "extractions"))


def field_metrics(spark: SparkSession, d: str) -> DataFrame:
    return scoring.field_metrics(_preds(spark, d), _golds(spark, d)).withColumns(_six("precision", "recall", "f1", "exact_match", "null_accuracy"))


def aggregate_metrics(spark: SparkSession, d: str) -> DataFrame:
    return scoring.aggregate_metrics(_preds(spark, d), _golds(spark, d)).withColumns(_six("weighted_f1", "mean_f1", "mean_exact_match", "hallucination_rate"))


def stratified_by_type(spark: SparkSession, d: str) -> DataFrame:
    return scoring.stratified_metrics(_preds(spark, d), _golds(spark, d), "cancer_type").withColumns(_six("weighted_f1", "mean_f1", "mean_exact_match", "hallucination_rate"))


def stratified_by_style(spark: SparkSession, d: str) -> DataFrame:
    corpus = table(spark, d, "pilot_corpus").withColumn("style", F.lower(pystrip(F.col("style"))))
    golds = scoring.attach_style(_golds(spark, d), scoring.style_lookup(corpus, "record_id"))
    return scoring.stratified_metrics(_preds(spark, d), golds, "style").withColumns(_six("weighted_f1", "mean_f1", "mean_exact_match", "hallucination_rate"))


def quality_rates(spark: SparkSession, d: str) -> DataFrame:
    return scoring.quality_rates(_preds(spark, d), ["load_no"]).withColumns(_six("pass_rate", "hallucination_rate", "m_null_rate"))


def field_null_rates(spark: SparkSession, d: str) -> DataFrame:
    return scoring.field_null_rates(_preds(spark, d), ["model"])


def tier_records(spark: SparkSession, d: str) -> DataFrame:
    return tiers.classify(_preds(spark, d)).select("extraction_id", "tier")


def tier_distribution(spark: SparkSession, d: str) -> DataFrame:
    return tiers.tier_distribution(_preds(spark, d), ["model"]).withColumns(_six("tier_1_rate", "tier_2_rate", "tier_3_rate"))


def vocab_flags_query(spark: SparkSession, d: str) -> DataFrame:
    flags = vocab_flags(F.col("tnm_stage.T"), F.col("tnm_stage.N"), F.col("tnm_stage.M"), F.col("tumor_grade"))
    return _preds(spark, d).select("extraction_id", F.array_join(flags, "; ").alias("flags"), F.size(flags).cast("bigint").alias("n_flags"))


def normalized_fields(spark: SparkSession, d: str) -> DataFrame:
    return _preds(spark, d).select("extraction_id", *[normalize(F.col(f), f).alias(column_of(f)) for f in FIELDS])


def grade_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _preds(spark, d).groupBy("tumor_grade").agg(F.count(F.lit(1)).alias("n")).select("tumor_grade", parse_grade(F.col("tumor_grade")).alias("grade"), "n")


def site_sides(spark: SparkSession, d: str) -> DataFrame:
    return _preds(spark, d).groupBy("primary_site").agg(F.count(F.lit(1)).alias("n")).select("primary_site", laterality(F.col("primary_site")).alias("side"), "n")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    preds = scoring.slim(_preds(spark, d), "extraction_id")
    return scoring.field_pairs(scoring.last_by(preds, "report_id", "extraction_id"), scoring.last_gold(_golds(spark, d), None))


def semantic_rules(spark: SparkSession, d: str) -> DataFrame:
    pairs = _pairs(spark, d).where(F.col("field").isin(*semantic.SEMANTIC_FIELDS))
    return pairs.select("report_id", "field", "pred", "gold", semantic.rule_score(F.col("pred"), F.col("gold"), F.col("field")).alias("score"))


def semantic_metrics(spark: SparkSession, d: str) -> DataFrame:
    return semantic.semantic_metrics(semantic.score_pairs(scoring.count_pairs(_pairs(spark, d)), _embedder(spark, d))).withColumns(_six("mean_similarity", "mean_similarity_complete"))


def semantic_metrics_ngram(spark: SparkSession, d: str) -> DataFrame:
    return semantic.semantic_metrics(semantic.score_pairs(scoring.count_pairs(_pairs(spark, d)), semantic.NgramEmbedder())).withColumns(_six("mean_similarity", "mean_similarity_complete"))


def combined_score(spark: SparkSession, d: str) -> DataFrame:
    pairs = scoring.count_pairs(_pairs(spark, d))
    sims = semantic.semantic_metrics(semantic.score_pairs(pairs, _embedder(spark, d)))
    return semantic.combined_score(scoring.score_fields(pairs), sims).withColumn("mean_similarity", semantic.mean_of_scored(sims).scalar()).withColumns(_six("combined_score", "mean_similarity"))


def embedding_cosine(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


def comparison_matrix(spark: SparkSession, d: str) -> DataFrame:
    traits = spark.createDataFrame([("llama3.2", True)], "model string, trait boolean")
    return compare.comparison_matrix(_preds(spark, d), _golds(spark, d), _embedder(spark, d), _units(spark), traits)


def cost_per_record(spark: SparkSession, d: str) -> DataFrame:
    return compare.cost_per_model(_preds(spark, d), _units(spark)).withColumns(_six("cost_per_record", "total_cost"))


def run_counters(spark: SparkSession, d: str) -> DataFrame:
    return extract.run_counters(_preds(spark, d), ["run_id"]).withColumns(_six("avg_latency_ms", "mean_input_tokens", "mean_output_tokens", "pass_rate"))


def drift_tier1(spark: SparkSession, d: str) -> DataFrame:
    return runs.tier1_drift(table(spark, d, "run_log")).withColumns(_six("current", "baseline"))


def drift_pass_rate(spark: SparkSession, d: str) -> DataFrame:
    return runs.pass_rate_drift(table(spark, d, "run_log")).withColumns(_six("current", "baseline"))


def hallucination_alert(spark: SparkSession, d: str) -> DataFrame:
    return runs.flag_rate_alert(table(spark, d, "run_log"))


def _with_null_rates(spark: SparkSession, d: str) -> DataFrame:
    """The run log with each run's null shares added to its metrics, from its records."""
    rates = scoring.field_null_rates(_preds(spark, d), ["run_id"])
    names = rates.columns[1:]
    logged = F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*names)).alias("_rates")
    log = table(spark, d, "run_log").join(rates.select("run_id", logged), "run_id", "left")
    own = F.map_filter("metrics", lambda k, _: ~k.startswith("null_rate_"))
    return log.withColumn("metrics", F.when(F.col("_rates").isNull(), F.col("metrics")).otherwise(F.map_concat(F.coalesce(own, F.expr("cast(map() as map<string, double>)")), "_rates"))).drop("_rates")


def drift_null_rates(spark: SparkSession, d: str) -> DataFrame:
    found = runs.null_rate_drift(_with_null_rates(spark, d))
    shown = F.transform("field_alerts", lambda x: F.concat(x["field"], F.format_string(" %.4f %.4f %.4f", x["current"], x["baseline"], x["delta"])))
    return found.withColumn("field_alerts", F.array_join(shown, "; "))


def drift_usage(spark: SparkSession, d: str) -> DataFrame:
    found = runs.usage_drift(table(spark, d, "run_log"))
    shown = F.transform("metric_alerts", lambda x: F.concat(x["metric"], F.format_string(" %.2f %.2f %.2f", x["current"], x["baseline"], x["ratio"])))
    return found.withColumn("metric_alerts", F.array_join(shown, "; "))


def run_alerts(spark: SparkSession, d: str) -> DataFrame:
    return runs.all_alerts(_with_null_rates(spark, d))


def rolling_pass_rate(spark: SparkSession, d: str) -> DataFrame:
    return runs.rolling_history(table(spark, d, "run_log"), "pass_rate").withColumns(_six("value", "baseline", "delta"))


def run_deltas(spark: SparkSession, d: str) -> DataFrame:
    return runs.deltas(table(spark, d, "run_log")).withColumns(_six("current", "previous", "delta"))


def recompute_check(spark: SparkSession, d: str) -> DataFrame:
    """Recomputed pass rates of all runs against the logged ones."""
    again = extract.run_counters(_preds(spark, d), ["run_id"]).select("run_id", F.col("pass_rate").alias("recomputed"))
    logged = table(spark, d, "run_log").select("run_id", runs.metric("pass_rate").alias("logged"))
    both = again.join(logged, "run_id", "left")
    return both.select("run_id", *[F.round(c, 6).alias(c) for c in ("recomputed", "logged")], F.coalesce(F.abs(F.col("recomputed") - F.col("logged")) < 1e-3, F.lit(False)).alias("matches"))


def resume_remaining(spark: SparkSession, d: str) -> DataFrame:
    return extract.remaining(table(spark, d, "pilot_corpus").select("record_id", "report_id"), _preds(spark, d))


def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    return extract.deduplicated(_preds(spark, d).select("report_id", "extraction_id", "validation_status"), "extraction_id")


def dedup_last(spark: SparkSession, d: str) -> DataFrame:
    return scoring.last_by(_preds(spark, d).select("report_id", "extraction_id", "validation_status"), "report_id", "extraction_id")


def style_lookup(spark: SparkSession, d: str) -> DataFrame:
    return scoring.style_lookup(table(spark, d, "pilot_corpus"), "record_id")


def style_attach(spark: SparkSession, d: str) -> DataFrame:
    lookup = scoring.style_lookup(table(spark, d, "pilot_corpus"), "record_id")
    return scoring.attach_style(_preds(spark, d).select("extraction_id", "report_id"), lookup)


TEMPLATE = "Read the report.\n<<output_skeleton>>\n\nPATHOLOGY REPORT:\n<<report_text>>\n"


def prompt_build(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "pilot_corpus").select("record_id", "text")
    filled = prompts.fill(F.col("text"), "Read.\n\nPATHOLOGY REPORT:\n<<report_text>>\n", "## Example 1")
    return docs.select("record_id", filled.alias("prompt"))


def prompt_tokens(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "pilot_corpus").select("record_id", "report_id", "text")
    built = prompts.build_prompts(docs, TEMPLATE)
    counted = built.withColumn("n_tokens", prompts.count_tokens("prompt"))
    return counted.select("record_id", "truncated", "n_tokens", prompts.context_overflow(F.col("n_tokens"), "ollama:llama3.2").alias("ctx_overflow"))


def dev_subset(spark: SparkSession, d: str) -> DataFrame:
    corpus = table(spark, d, "pilot_corpus").select("record_id", "report_id", "cancer_type", "style")
    return sampling.dev_subset(scoring.first_by(corpus, "report_id", "record_id"), 40, 42)


def _replies(spark: SparkSession, d: str) -> DataFrame:
    """Every stored extraction as the reply it came from: the raw text of failures, else its fields as JSON."""
    fields = ("patient", "primary_site", "histological_diagnosis", "histological_subtype", "tumor_grade", "tnm_stage", "specimen_type", "extraction_notes", "hallucination_flags")
    written = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    # every third record comes as models often answer: fenced, after a line of prose
    fenced = F.when(F.col("extraction_id") % 3 == 0, F.concat(F.lit("Here it is:\n```json\n"), written, F.lit("\n```"))).otherwise(written)
    return _preds(spark, d).select("extraction_id", "report_id", F.coalesce("cancer_type", F.lit("unknown")).alias("cancer_type"), F.coalesce("raw_text", fenced).alias("raw_text"))


def parse_validate_status(spark: SparkSession, d: str) -> DataFrame:
    done = validate.validate(_replies(spark, d))
    return done.select("extraction_id", "validation_status", F.size("vocab_flags").cast("bigint").alias("n_flags"), F.col("tnm_stage.T").alias("t"), "tumor_grade")


def failed_replies(spark: SparkSession, d: str) -> DataFrame:
    """Stored failures, judged again: what is wrong with each."""
    raw = _preds(spark, d).where("raw_text is not null")
    hint = validate.correction(F.col("raw_text"))
    return raw.select("extraction_id", "validation_status", validate.parse_json(F.col("raw_text")).isNotNull().alias("is_json"), hint.isNotNull().alias("asks_again"))


def correction_messages(spark: SparkSession, d: str) -> DataFrame:
    """Errors of every stored reply."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return _replies(spark, d).select("extraction_id", "report_id", validate.problems(F.col("raw_text")).alias("errors"))


def extract_replay(spark: SparkSession, d: str) -> DataFrame:
    """A whole run over the reports, answered by their stored replies: the first, and the next one where that fails."""
    corpus = table(spark, d, "pilot_corpus").select("record_id", "report_id", "cancer_type", "style", "text")
    corpus = scoring.first_by(corpus.where("report_id is not null"), "report_id", "record_id").withColumn("text", F.coalesce("text", F.lit("")))
    built = prompts.build_prompts(corpus, TEMPLATE).select("report_id", F.coalesce("cancer_type", F.lit("unknown")).alias("cancer_type"), "truncated", "prompt")
    by_report = W.partitionBy("report_id").orderBy("extraction_id")
    stored = _replies(spark, d).withColumns({"attempt": F.row_number().over(by_report), "input_tokens": F.lit(10).cast("bigint"), "output_tokens": F.lit(4).cast("bigint"), "latency_ms": F.lit(5.0)}).where("attempt <= 2")
    replies = extract.replay(built, stored, correct=extract.reply_problem)
    return extract.as_results(validate.validate(replies)).select("report_id", "validation_status", "primary_site", "output_tokens")


QUERIES: dict[str, Query] = {
    "p3_found": p3_found,
    "p3_profile": p3_profile,
    "field_metrics": field_metrics,
    "aggregate_metrics": aggregate_metrics,
    "stratified_by_type": stratified_by_type,
    "stratified_by_style": stratified_by_style,
    "quality_rates": quality_rates,
    "field_null_rates": field_null_rates,
    "tier_records": tier_records,
    "tier_distribution": tier_distribution,
    "vocab_flags": vocab_flags_query,
    "normalized_fields": normalized_fields,
    "grade_tokens": grade_tokens,
    "site_sides": site_sides,
    "semantic_rules": semantic_rules,
    "semantic_metrics": semantic_metrics,
    "semantic_metrics_ngram": semantic_metrics_ngram,
    "combined_score": combined_score,
    "embedding_cosine": embedding_cosine,
    "comparison_matrix": comparison_matrix,
    "cost_per_record": cost_per_record,
    "run_counters": run_counters,
    "drift_tier1": drift_tier1,
    "drift_pass_rate": drift_pass_rate,
    "hallucination_alert": hallucination_alert,
    "drift_null_rates": drift_null_rates,
    "drift_usage": drift_usage,
    "run_alerts": run_alerts,
    "rolling_pass_rate": rolling_pass_rate,
    "run_deltas": run_deltas,
    "recompute_check": recompute_check,
    "resume_remaining": resume_remaining,
    "dedup_first": dedup_first,
    "dedup_last": dedup_last,
    "style_lookup": style_lookup,
    "style_attach": style_attach,
    "prompt_build": prompt_build,
    "prompt_tokens": prompt_tokens,
    "dev_subset": dev_subset,
    "parse_validate_status": parse_validate_status,
    "failed_replies": failed_replies,
    "correction_messages": correction_messages,
    "extract_replay": extract_replay,
}
