import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marrow.operators import extract, prompts, runs, validate
from marrow.plans import core_queries
from marrow.plans.fields import RESULT
from marrow.sources import jsonl
from marrow.streaming import ingest


def log(spark, *metrics, status=None):
    t = dt.datetime(2024, 1, 1)
    rows = [(f"r{i}", "e", "n", (status or {}).get(i, "FINISHED"), t, t + dt.timedelta(days=i), {}, m, {}) for i, m in enumerate(metrics)]
    return spark.createDataFrame(rows, runs.RUN)


def get(df, run):
    return next(r for r in df.collect() if r.run_id == run)


def test_drift_levels(spark):
    some = log(spark, *[{"tier1_rate": x, "pass_rate": 1 - x} for x in (0.5, 0.5, 0.5, 0.75)])
    assert get(runs.tier1_drift(some), "r3").level == "WARN" and get(runs.pass_rate_drift(some), "r3").level == "WARN"
    # the drop, positive where the rate fell; either way for tier 1
    assert get(runs.pass_rate_drift(some), "r3").delta == 0.25 and get(runs.tier1_drift(some), "r3").delta == 0.25
    better = log(spark, *[{"tier1_rate": x, "pass_rate": 1 - x} for x in (0.5, 0.5, 0.5, 0.25)])
    assert get(runs.pass_rate_drift(better), "r3").delta == -0.25 and get(runs.pass_rate_drift(better), "r3").level == "OK" and get(runs.tier1_drift(better), "r3").delta == 0.25
    assert get(runs.tier1_drift(some), "r3").message == "tier1_rate moved: 50.0% -> 75.0%"
    assert get(runs.tier1_drift(log(spark, {"tier1_rate": 0.5}, {"tier1_rate": 0.9})), "r1").level == "INSUFFICIENT_DATA"
    assert get(runs.tier1_drift(log(spark, {"x": 1.0}, {"tier1_rate": 0.9})), "r0").level == "OK"
    assert get(runs.tier1_drift(log(spark, {"x": 1.0}, {"tier1_rate": 0.9})), "r0").delta == 0.0
    assert get(runs.tier1_drift(log(spark, {"x": 1.0}, {"x": 1.0}, {"tier1_rate": 0.9})), "r2").level == "OK"


def test_baseline_leaves_out_failed_runs_nan_and_older_than_five(spark):
    many = log(spark, *[{"tier1_rate": x} for x in (9.0, 0.5, float("nan"), 0.5, 0.5, 0.5, 0.5)], status={3: "FAILED"})
    r = get(runs.tier1_drift(many), "r6")
    assert (r.level, r.baseline) == ("WARN", pytest.approx((9.0 + 0.5 + 0.5 + 0.5) / 4))
    assert get(runs.tier1_drift(log(spark, *[{"tier1_rate": x} for x in (9.0, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5)])), "r6").baseline == 0.5


def test_thresholds_are_strict(spark):
    assert [r.level for r in runs.flag_rate_alert(log(spark, {"hallucination_rate": 0.08}, {"hallucination_rate": 0.081}, {})).orderBy("run_id").collect()] == ["OK", "CRITICAL", "OK"]
    usage = runs.usage_drift(log(spark, *[{"mean_output_tokens": x} for x in (100.0, 100.0, 150.0, 250.0)]))
    assert not get(usage, "r2").alert and get(usage, "r3").alert and get(usage, "r0").level == "OK"
    assert [tuple(x) for x in get(usage, "r3").metric_alerts] == [("mean_output_tokens", 250.0, 116.67, 2.14)] and get(usage, "r3").message == "usage rose: mean_output_tokens (2.1x)"
    few = runs.usage_drift(log(spark, {"mean_latency_s": 1.0}, {"x": 1.0}))
    assert [get(few, r).level for r in ("r0", "r1")] == ["INSUFFICIENT_DATA", "OK"]
    nulls = runs.null_rate_drift(log(spark, *[{"null_rate_tumor_grade": x} for x in (0.25, 0.25, 0.25, 0.5)]))
    assert [tuple(x) for x in get(nulls, "r3").field_alerts] == [("tumor_grade", 0.5, 0.25, 0.25)] and not get(nulls, "r0").alert and get(nulls, "r0").field_alerts == []
    assert {(r.monitor, r.detail) for r in runs.all_alerts(log(spark, *[{"null_rate_tumor_grade": x} for x in (0.25, 0.25, 0.25, 0.5)])).collect()} == {("null_rate", "tumor_grade")}
    assert {r.monitor for r in runs.all_alerts(log(spark, *[{"pass_rate": x} for x in (1.0, 1.0, 0.5)])).collect()} == {"pass_rate"}


def test_deltas_and_empty_log(spark):
    d = runs.deltas(log(spark, {"pass_rate": 0.5}, {"pass_rate": 0.75}, {"pass_rate": 0.75}))
    assert [r.change for r in d.orderBy("run_id").collect()] == ["new", "better", "same"]
    assert runs.deltas(log(spark)).count() == 0 and runs.all_alerts(log(spark)).count() == 0


def test_store_writes_failed_runs_too(spark, tmp_path):
    store = runs.RunStore(spark, str(tmp_path))
    with store.start("e", "ollama:m", "v1", {"n": 3}) as run:
        run.log_metrics({"pass_rate": 1})
        run.log_artifact(str(tmp_path / "missing"))
        run.log_prompt("v1", "text")
    with pytest.raises(RuntimeError), store.start("e", "m", "v1"):
        raise RuntimeError
    rows = store.runs().orderBy("end_time").collect()
    assert [r.status for r in rows] == ["FINISHED", "FAILED"] and rows[0].run_name.startswith("ollama-m__v1__") and rows[0].params["n"] == "3"
    assert not store.register_prompt("v1", "other") and store.register_prompt("v2", "text")


GOOD = '{"tnm_stage": {"T": "pT2", "N": null, "confidence": " Stated ", "odd": 1}, "patient": {"sex": "M"}, "tumor_grade": "G2", "unknown": [1]}'
CASES = [
    (GOOD, "valid", 0),
    (f"prose\n```json\n{GOOD}\n``` more", "valid", 0),
    (f"Reasoning: none. {GOOD}", "valid", 0),
    (f"{GOOD} trailing", "json_failed", 0),
    ('{"a": 1}] x', "json_failed", 0),
    ("", "json_failed", 0),
    (None, "json_failed", 0),
    ("[1, 2]", "json_failed", 0),
    ('{"primary_site": 4}', "schema_failed", 0),
    ('{"tnm_stage": []}', "schema_failed", 0),
    ('{"patient": "x"}', "schema_failed", 0),
    ('{"tumor_grade": "weird", "hallucination_flags": "own"}', "vocab_flagged", 1),
    ('{"tnm_stage": {"T": "ypT2", "N": "pN01", "M": "M7"}, "tumor_grade": "x"}', "vocab_flagged", 4),
    ('{"tumor_grade": "", "tnm_stage": null}', "valid", 0),
    ('{"tumor_grade": "G1", "tumor_grade": "G3"}', "valid", 0),
]


def test_validation(spark):
    rows = spark.createDataFrame([(i, f"r{i}", "X", raw) for i, (raw, _, _) in enumerate(CASES)], "i int, report_id string, cancer_type string, raw_text string")
    out = validate.validate(rows).orderBy("i").collect()
    assert [(r.validation_status, len(r.vocab_flags)) for r in out] == [c[1:] for c in CASES]
    assert out[0].patient.sex == "male" and out[0].tnm_stage.confidence == "stated" and out[0].raw_text is None and out[0].schema_version == "v1.3"
    assert out[3].raw_text.endswith("trailing") and out[3].tumor_grade is None and out[14].tumor_grade == "G3"
    assert out[11].hallucination_flags == ["own", "unrecognised_grade: 'weird'"]
    nulls = spark.createDataFrame([(0, "r", None, GOOD), (1, None, "X", GOOD)], rows.schema)
    assert [r.validation_status for r in validate.validate(nulls).collect()] == ["schema_failed"] * 2
    assert validate.validate(rows.limit(0)).count() == 0


def test_flags_of_any_type(spark):
    values = ['"a"', '["a", true, null, 3]', "null", "7"]
    rows = spark.createDataFrame([(i, f'{{"hallucination_flags": {v}}}') for i, v in enumerate(values)], "i int, raw string")
    got = rows.select("i", validate.flags_of(validate.parse_json(F.col("raw"))).alias("f")).orderBy("i").collect()
    assert [r.f for r in got] == [["a"], ["a", "True", "None", "3"], None, ["7"]]


def test_stored_failures_have_their_errors(spark, sf):
    """The replies as stored, judged by Python's own JSON reader."""
    classes = {"patient": "PatientIdentification", "tnm_stage": "TNMStage"}

    def errors(raw):
        inner = raw.strip().split("```")[1] if "```" in raw else raw.strip()
        try:
            data = json.loads(inner[inner.index("{") :])
        except ValueError:
            return "no json"
        lines = []
        for field in ("patient", "primary_site", "tumor_grade", "tnm_stage", "specimen_type"):
            v = data.get(field)
            if field in classes:
                if v is not None and not isinstance(v, dict):
                    lines.append(f"- {field}: Input should be a valid dictionary or instance of {classes[field]}")
                elif field == "tnm_stage":
                    lines += [f"- {field}.{k}: Input should be a valid string" for k in "TNM" if not isinstance((v or {}).get(k), str | None)]
            elif not isinstance(v, str | None):
                lines.append(f"- {field}: Input should be a valid string")
        return "\n".join(lines)

    stored = spark.read.parquet(f"{sf}/extractions.parquet").where("raw_text is not null").collect()
    failed = {r.extraction_id for r in stored}
    got = [r for r in core_queries.correction_messages(spark, sf).collect() if r.extraction_id in failed]
    assert stored and sorted((r.extraction_id, r.report_id, r.errors) for r in got) == sorted((r.extraction_id, r.report_id, errors(r.raw_text)) for r in stored)
    assert len({r.errors for r in got}) > 3


def test_worker_and_columns_judge_replies_alike(spark):
    raws = [raw for raw, _, _ in CASES] + ['{"tnm_stage": {"T": 4}, "patient": 1}', '{"a": NaN}', '{"specimen_type": ["x"], "extraction_notes": {}}']
    rows = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    got = [r.c for r in rows.select("i", validate.correction(F.col("raw")).alias("c")).orderBy("i").collect()]
    assert got == [extract.reply_problem(raw) for raw in raws] and None in got


def test_replayed_replies_are_joined(spark):
    asked = spark.createDataFrame([("a", "X", "p"), ("b", "X", "p"), ("c", "X", "p")], "report_id string, cancer_type string, prompt string")
    stored = spark.createDataFrame([("a", 1, GOOD, 1, 1, 1.0), ("b", 1, '{"primary_site": 4}', 1, 1, 1.0), ("b", 2, GOOD, 2, 2, 1.0), ("d", None, GOOD, 1, 1, 1.0)], "report_id string, attempt int, raw_text string, input_tokens long, output_tokens long, latency_ms double")
    got = {r.report_id: (r.raw_text, r.input_tokens) for r in extract.replay(asked, stored, correct=extract.reply_problem).collect()}
    assert got == {"a": (GOOD, 1), "b": (GOOD, 3), "c": (None, 0)}


def test_structured_requests_carry_the_schema():
    s = extract.reply_schema()
    assert s["type"] == "object" and s["properties"]["tnm_stage"]["properties"]["T"] == {"type": ["string", "null"]} and s["additionalProperties"] is False
    assert s["properties"]["hallucination_flags"] == {"type": ["array", "null"], "items": {"type": "string"}} and set(s["required"]) == set(s["properties"])


def test_output_is_rewritten_with_the_first_line_of_each_report(spark, tmp_path):
    out = str(tmp_path / "out")
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "1.json").write_text('{"report_id": "a", "x": 1}\nbad\n{"report_id": "b"}\n{"report_id": "a", "x": 2}\n')
    assert jsonl.rewrite_deduplicated(spark, out) == 2
    assert sorted(r.value for r in spark.read.text(out).collect()) == ['{"report_id": "a", "x": 1}', '{"report_id": "b"}']
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_bpe_tokenizer_counts_and_cuts():
    t = prompts.BpeTokenizer()
    assert t.count("") == 0 and t.truncate("one two three", 2) == ("one two", True) and t.truncate("one two", 2) == ("one two", False) and t.count("<|endoftext|>") > 1


def test_corrections(spark):
    rows = spark.createDataFrame([(0, "no"), (1, '{"tnm_stage": {"T": 4}, "patient": 1}'), (2, GOOD)], "i int, raw string")
    got = [r.c for r in rows.select("i", validate.correction(F.col("raw")).alias("c")).orderBy("i").collect()]
    assert "no valid JSON" in got[0] and got[2] is None
    assert "- patient: Input should be a valid dictionary or instance of PatientIdentification\n- tnm_stage.T: Input should be a valid string" in got[1]


def test_prompts(spark, tmp_path):
    path = tmp_path / "shots.jsonl"
    path.write_text('{"text": "t", "ground_truth": {"a": "é"}}\n\n{"text": "u"}\n', encoding="utf-8")
    block = prompts.few_shot_block(str(path))
    assert block.startswith("## Example 1\nReport:\nt\n\nOutput:\n{") and "## Example 3" in block and "\\u00e9" in block
    rows = spark.createDataFrame([("a", "one two"), ("b", "w " * 9000), ("c", None), ("d", "x\nPATHOLOGY REPORT:\ny")], "report_id string, text string")
    out = {r.report_id: r for r in prompts.build_prompts(rows, "<<output_skeleton>>\nPATHOLOGY REPORT:\n<<report_text>>", "S").collect()}
    assert out["a"].prompt.endswith("one two") and not out["a"].truncated and out["b"].truncated and out["c"].prompt is None
    assert out["d"].prompt.count("FEW-SHOT") == 2 and json.loads(prompts.null_skeleton())["tnm_stage"]["T"] is None
    assert prompts.version_of("p/extraction_v1.7.txt") == "v1.7" and prompts.version_of("extraction.txt") == "extraction"
    w = prompts.WordTokenizer()
    assert w.count("") == 0 and w.truncate("a b c", 2) == ("a b", True) and w.truncate("a b", 2) == ("a b", False)


def test_retry_happens_once_and_adds_up():
    calls = []

    class Two:
        def respond(self, key, prompt, attempt):
            calls.append(prompt)
            return extract.Reply("bad" if attempt == 1 else '{"a": 1}', 10, 5, 1.5)

    r = extract.ask(Two(), "k", "p", extract.reply_problem)
    assert (r.raw_text, r.input_tokens, r.latency_ms, len(calls)) == ('{"a": 1}', 20, 3.0, 2) and calls[1].startswith("p\n\n")
    fine = extract.ReplayResponder({("k", 1): extract.Reply('{"a": 1}')})
    assert extract.ask(fine, "k", "p", extract.reply_problem).raw_text == '{"a": 1}'


def test_http_responder_speaks_both_protocols():
    seen = {}

    def post(url, body, timeout):
        seen.update(url=url, body=body, timeout=timeout)
        return {"message": {"content": "x"}, "eval_count": 2} if "/api/" in url else {"choices": [{"message": {"content": "y"}}]}

    r = extract.HttpResponder("ollama:openbiollm", "http://h/v1", num_ctx=9, post=post).respond("k", "p", 1)
    assert seen["url"] == "http://h/api/chat" and seen["body"]["options"]["num_ctx"] == 9 and r.output_tokens == 2
    r = extract.HttpResponder("openai:o4-mini", "http://h/v1", post=post).respond("k", "p", 1)
    assert seen["url"] == "http://h/v1/chat/completions" and "temperature" not in seen["body"] and seen["timeout"] == 120 and seen["body"]["response_format"]["type"] == "json_schema" and r.raw_text == "y" and r.input_tokens == 0


def test_run_from_prompts_to_files_and_resume(spark, tmp_path):
    prompts_df = spark.createDataFrame([("a", "X", "p"), ("b", "X", "p")], "report_id string, cancer_type string, prompt string")
    done = extract.as_results(validate.validate(extract.call_models(prompts_df, lambda: extract.ReplayResponder({("a", 1): extract.Reply(GOOD, 1, 1, 1.0)}))))
    assert done.schema.names == RESULT.names
    out = str(tmp_path / "out")
    jsonl.write_results(done, out)
    jsonl.write_results(done.where("report_id = 'a'"), out)
    (tmp_path / "out" / "bad.json").write_text("not json\n\n")
    back = jsonl.load_results(spark, out)
    assert back.count() == 3 and extract.deduplicated(back).count() == 2
    assert '"primary_site":null' in back.first().line
    more = spark.createDataFrame([("a",), ("c",)], "report_id string")
    assert [r.report_id for r in extract.remaining(more, back).collect()] == ["c"]
    with pytest.raises(ValueError, match="collide"):
        jsonl.build_output(done, {"run_id": "x", "report_id": "y"})
    with pytest.raises(FileNotFoundError):
        jsonl.write_results(done, str(tmp_path / "none" / "out"))


def test_json_lines_source(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"report_id": "1", "text": "é"}\n\n   \n{"report_id": "2"}\n', encoding="utf-8")
    assert [r.report_id for r in jsonl.load_records(spark, str(tmp_path / "c.jsonl")).collect()] == ["1", "2"]
    (tmp_path / "d.jsonl").write_text('{"report_id": \n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        jsonl.load_records(spark, str(tmp_path / "d.jsonl")).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jsonl.load_records(spark, str(tmp_path / "no.jsonl"))


def test_stream_validates_each_report_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    line = lambda i, raw: json.dumps({"report_id": i, "cancer_type": "X", "raw_text": raw, "received_at": "2024-01-01T00:00:00Z"})
    (src / "1.json").write_text(line("a", GOOD) + "\n" + line("a", GOOD) + "\n" + line("b", "no") + "\n")
    run = lambda: ingest.write_validated(ingest.read_replies(spark, str(src)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    (src / "2.json").write_text(line("a", GOOD) + "\n" + line("c", GOOD) + "\n")
    run()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.report_id, r.validation_status) for r in rows) == [("a", "valid"), ("b", "json_failed"), ("c", "valid")]
