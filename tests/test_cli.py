import json

from marrow import cli

GOOD = '{"primary_site": "lung", "tumor_grade": "G2", "tnm_stage": {"T": "pT2", "N": "pN0", "M": "M0"}, "hallucination_flags": ["sure?"]}'


def lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def test_run_resume_recompute_and_monitors(spark, tmp_path, capsys):
    corpus = [{"report_id": str(i), "cancer_type": "X", "style": "s", "text": f"report {i}"} for i in range(6)]
    replies = [{"report_id": str(i), "attempt": 1, "raw_text": GOOD if i else "no", "input_tokens": 5, "output_tokens": 3, "latency_ms": 1.0} for i in range(6)]
    gold = lines(tmp_path / "gold.jsonl", [{"report_id": str(i), "cancer_type": "X", "primary_site": "lung", "tumor_grade": "grade 2", "tnm_stage": {"T": "pT2", "N": None, "M": "M0"}} for i in range(6)])
    template = tmp_path / "extraction_v1.7.txt"
    template.write_text("<<output_skeleton>>\nPATHOLOGY REPORT:\n<<report_text>>")
    out, store = str(tmp_path / "out"), str(tmp_path / "runs")
    args = ["run", "--input", lines(tmp_path / "c.jsonl", corpus[:4]), "--output", out, "--model", "ollama:m", "--prompt-file", str(template), "--store", store, "--replay", lines(tmp_path / "r.jsonl", replies), "--eval-set", gold]
    # every valid record carries a flag: the rate asks for a pause
    assert cli.main(args, spark) == 1 and "CRITICAL: hallucination" in capsys.readouterr().out
    lines(tmp_path / "c.jsonl", corpus)
    assert cli.main(args, spark) == 1
    log = cli.runs.RunStore(spark, store).runs().orderBy("end_time").collect()
    assert [r.metrics["total_input_tokens"] for r in log] == [25.0, 10.0]  # the failed reply was asked for twice
    assert log[1].metrics["pass_rate"] == round(5 / 6, 4) and log[1].params["prompt_version"] == "v1.7" and log[1].metrics["f1_tumor_grade"] == 0.0
    assert "total_cost" not in log[1].metrics
    assert json.loads((tmp_path / "out.summary.json").read_text())["combined_score"] == log[1].metrics["combined_score"]
    assert cli.main(["recompute", "--predictions", out, "--eval-set", gold, "--store", store, "--run-id", log[1].run_id], spark) == 0
    assert cli.main(["recompute", "--predictions", out, "--eval-set", gold, "--store", store, "--run-id", log[0].run_id], spark) == 1
    assert cli.main(["monitors", "--store", store, "--run-id", log[1].run_id], spark) == 1
    assert cli.main([*args[:8], str(tmp_path / "none.txt"), *args[9:]], spark) == 1
    assert cli.main(["recompute", "--predictions", out, "--eval-set", lines(tmp_path / "e.jsonl", [])], spark) == 1
