"""Command line: an extraction run, scoring of finished output, monitors over the run log.

    python -m marrow.cli run --input corpus.jsonl --output out/ --model ollama:llama3.2 --prompt-file p_v1.7.txt --store runs/
    python -m marrow.cli recompute --predictions out/ --eval-set gold.jsonl
    python -m marrow.cli monitors --store runs/ --run-id ID
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marrow.operators import compare, extract, prompts, runs, sampling, scoring, semantic, tiers, validate
from marrow.plans.fields import EXTRACTION, FIELDS, RESULT, column_of
from marrow.sources import jsonl

GOLD = T.StructType([T.StructField("report_id", T.StringType()), T.StructField("cancer_type", T.StringType()), *EXTRACTION.fields])


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="marrow")
    sub = top.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run")
    for name in ("input", "output", "model", "prompt-file", "store"):
        run.add_argument(f"--{name}", required=True)
    run.add_argument("--few-shot")
    run.add_argument("--eval-set")
    run.add_argument("--replay", help="JSON lines of report_id, attempt, raw_text, tokens; answers without a model")
    run.add_argument("--prices", help="JSON lines of model, input_price, output_price per million tokens; without it no cost is logged")
    run.add_argument("--experiment", default="extraction")
    run.add_argument("--n-records", type=int, default=0)
    run.add_argument("--seed", type=int, default=42)
    run.add_argument("--max-tokens", type=int, default=8192)
    run.add_argument("--num-ctx", type=int)
    run.add_argument("--debug", action="store_true", help="keep whole raw replies of failures, not their first 500 characters")
    run.add_argument("--no-semantic", action="store_true")
    again = sub.add_parser("recompute")
    again.add_argument("--predictions", required=True)
    again.add_argument("--eval-set", required=True)
    again.add_argument("--store")
    again.add_argument("--run-id")
    again.add_argument("--no-semantic", action="store_true")
    watch = sub.add_parser("monitors")
    watch.add_argument("--store", required=True)
    watch.add_argument("--run-id", required=True)
    return top


def quality_metrics(results: DataFrame) -> dict[str, float]:
    """Figures of output that need no gold."""
    rows = [scoring.quality_rates(results), tiers.tier_distribution(results), scoring.field_null_rates(results)]
    found: dict[str, float] = {}
    for df in rows:
        found |= df.collect()[0].asDict()
    found.pop("n_rows", None)
    return {k.replace("tier_", "tier") if k.startswith("tier_") else k: round(v, 4) for k, v in found.items()}


def gold_metrics(preds: DataFrame, golds: DataFrame, with_similarity: bool, order: str = "created_at") -> dict[str, float]:
    """Figures of output against gold; fields with a dot are named with an underscore."""
    few = scoring.last_by(scoring.slim(preds, order), "report_id", order)
    pairs = scoring.count_pairs(scoring.field_pairs(few, scoring.last_gold(golds, None)))
    fields = scoring.score_fields(pairs).cache()
    out = {f"f1_{column_of(r['field'])}": round(r["f1"], 4) for r in fields.collect()}
    rolled = scoring.roll_up(fields).collect()[0]
    out |= {"weighted_f1": round(rolled["weighted_f1"], 4), "mean_f1": round(rolled["mean_f1"], 4)}
    if with_similarity:
        sims = semantic.semantic_metrics(semantic.score_pairs(pairs, semantic.NgramEmbedder())).cache()
        rows = sims.collect()
        for r in rows:
            out |= {f"similarity_complete_{r['field']}": round(r["mean_similarity_complete"], 4), f"omissions_{r['field']}": r["n_omission"], f"hallucinations_{r['field']}": r["n_hallucination"]}
        if rows:
            out["mean_similarity_complete"] = round(sum(r["mean_similarity_complete"] for r in rows) / len(rows), 4)
        out["combined_score"] = round(semantic.combined_score(fields, sims).collect()[0]["combined_score"], 4)
        sims.unpersist()
    fields.unpersist()
    return out


def warn_of_overflow(asked: DataFrame, args: argparse.Namespace) -> int:
    """Warn of prompts that a locally served model's context would cut; how many there are."""
    if args.model.startswith("openai:"):
        return 0
    counted = asked.withColumn("n_tokens", prompts.count_tokens("prompt"))
    row = counted.where(prompts.context_overflow(F.col("n_tokens"), args.model, args.num_ctx)).agg(F.count(F.lit(1)), F.max("n_tokens"), F.min("report_id")).collect()[0]
    if row[0]:
        print(f"{row[0]} prompts have up to {row[1]} tokens (first: {row[2]}), more than the context of {args.num_ctx or prompts.DEFAULT_CONTEXT}; --num-ctx sets a larger one", file=sys.stderr)
    return row[0]


def extraction_run(spark: SparkSession, args: argparse.Namespace) -> int:
    template_path = Path(args.prompt_file)
    if not template_path.is_file():
        print(f"no such template: {template_path}", file=sys.stderr)
        return 1
    version = prompts.version_of(args.prompt_file)
    records = jsonl.load_records(spark, args.input)
    if args.n_records:
        records = sampling.dev_subset(records, args.n_records, args.seed)
    output = Path(args.output)
    if output.exists():
        jsonl.rewrite_deduplicated(spark, args.output)
        records = extract.remaining(records, jsonl.load_results(spark, args.output))
    few_shot = prompts.few_shot_block(args.few_shot) if args.few_shot else None
    store = runs.RunStore(spark, args.store)
    with store.start(args.experiment, args.model, version, {"few_shot_path": args.few_shot, "input": args.input}) as run:
        template = template_path.read_text(encoding="utf-8")
        run.log_prompt(version, template)
        asked = prompts.build_prompts(records, template, few_shot).select("report_id", "cancer_type", "truncated", "prompt")
        warn_of_overflow(asked, args)
        correct = None if extract.provider_of(args.model).get("structured") else extract.reply_problem
        if args.replay:
            schema = "report_id string, attempt int, raw_text string, input_tokens long, output_tokens long, latency_ms double"
            answered = extract.replay(asked, spark.read.schema(schema).json(args.replay), correct=correct)
        else:
            model, most, context = args.model, args.max_tokens, args.num_ctx
            answered = extract.call_models(asked, lambda: extract.HttpResponder(model, None, most, context), correct=correct)
        # replies are kept before anything is computed from them, so no model call is repeated
        replies = f"{args.store}/replies/{run.run_id}"
        answered.write.parquet(replies)
        checked = validate.validate(spark.read.parquet(replies))
        if not args.debug:
            checked = checked.withColumn("raw_text", F.left("raw_text", F.lit(500)))
        meta = {"model": args.model, "prompt_version": version, "few_shot_path": args.few_shot, "run_id": run.run_id, "created_at": dt.datetime.now(dt.UTC).replace(tzinfo=None)}
        session = extract.as_results(jsonl.build_output(checked, meta)).cache()
        jsonl.write_results(session, args.output)
        everything = spark.read.schema(RESULT).json(args.output).cache()
        counters = extract.run_counters(session).collect()[0].asDict()
        metrics = quality_metrics(everything) | {
            "mean_latency_s": round(counters["avg_latency_ms"] / 1000, 4),
            **{k: counters[k] for k in ("total_input_tokens", "total_output_tokens")},
            **{k: round(counters[k], 1) for k in ("mean_input_tokens", "mean_output_tokens")},
        }
        if args.prices:
            prices = spark.read.schema("model string, input_price double, output_price double").json(args.prices)
            metrics["total_cost"] = compare.record_cost(prices, everything).agg(F.coalesce(F.sum("cost"), F.lit(0.0))).collect()[0][0]
        if args.eval_set and Path(args.eval_set).exists():
            golds = jsonl.load_records(spark, args.eval_set, GOLD)
            run.log_dataset(args.eval_set, golds.count())
            metrics |= gold_metrics(everything, golds, not args.no_semantic)
        run.log_metrics(metrics)
        summary = counters | metrics | {"run_id": run.run_id}
        jsonl.write_summary(summary, f"{str(output).rstrip('/')}.summary.json")
        run.log_artifact(f"{str(output).rstrip('/')}.summary.json")
        run_id = run.run_id
        session.unpersist()
        everything.unpersist()
    print(json.dumps(summary, default=str))
    return monitors(store, run_id)


def recompute(spark: SparkSession, args: argparse.Namespace) -> int:
    preds, golds = spark.read.schema(RESULT).json(args.predictions), jsonl.load_records(spark, args.eval_set, GOLD)
    for df, what in ((preds, args.predictions), (golds, args.eval_set)):
        if df.isEmpty():
            print(f"no records in {what}", file=sys.stderr)
            return 1
    metrics = gold_metrics(preds, golds, not args.no_semantic)
    print(json.dumps(metrics))
    if not (args.store and args.run_id):
        return 0
    run = runs.RunStore(spark, args.store).runs().where(F.col("run_id") == args.run_id)
    again = spark.createDataFrame([(k, float(v)) for k, v in metrics.items()], "metric string, value double")
    wrong = runs.compare_logged(again, run).where("not matches").collect()
    for r in wrong:
        print(f"differs: {r.metric} {r.recomputed} logged {r.logged}", file=sys.stderr)
    return int(bool(wrong))


def monitors(store: runs.RunStore, run_id: str) -> int:
    """Alerts of one run; 1 if one of them is critical."""
    log = store.runs()
    found = runs.all_alerts(log).where(F.col("run_id") == run_id).collect()
    for r in found:
        print(f"{r.level}: {r.monitor} {r.detail}")
    for r in runs.deltas(log).where(F.col("run_id") == run_id).collect():
        if r.delta is not None:
            print(f"{r.metric}: {r.current:.4g} ({r.delta:+.4g}, {r.change})")
    return int(any(r.level == "CRITICAL" for r in found))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("marrow").getOrCreate()
    if args.command == "run":
        return extraction_run(spark, args)
    if args.command == "recompute":
        return recompute(spark, args)
    return monitors(runs.RunStore(spark, args.store), args.run_id)


if __name__ == "__main__":
    sys.exit(main())
