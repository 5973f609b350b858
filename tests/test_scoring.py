import pytest
from pyspark.sql import functions as F

from marrow.operators import compare, extract, sampling, scoring, semantic, tiers
from marrow.plans.fields import FIELDS

RECORD = (
    "extraction_id long, report_id string, primary_site string, specimen_type string, histological_diagnosis string, histological_subtype string, tumor_grade string,"
    " tnm_stage struct<T:string,N:string,M:string>, validation_status string, hallucination_flags array<string>, model string, input_tokens long, output_tokens long, latency_ms double, truncated boolean"
)
GOLD = "report_id string, cancer_type string, primary_site string, specimen_type string, histological_diagnosis string, histological_subtype string, tumor_grade string, tnm_stage struct<T:string,N:string,M:string>"


def pred(spark, *rows):
    base = {"primary_site": None, "specimen_type": None, "histological_diagnosis": None, "histological_subtype": None, "tumor_grade": None, "tnm_stage": None, "validation_status": "valid", "hallucination_flags": None, "model": "m", "input_tokens": 10, "output_tokens": 5, "latency_ms": 2.0, "truncated": False}
    return spark.createDataFrame([base | {"extraction_id": i} | r for i, r in enumerate(rows)], RECORD) if rows else spark.createDataFrame([], RECORD)


def gold(spark, *rows):
    base = dict.fromkeys(["cancer_type", "primary_site", "specimen_type", "histological_diagnosis", "histological_subtype", "tumor_grade", "tnm_stage"])
    return spark.createDataFrame([base | r for r in rows], GOLD) if rows else spark.createDataFrame([], GOLD)


def by_field(df):
    return {r.field: r for r in df.collect()}


def test_wrong_value_is_miss_and_false_find_and_missing_prediction_is_null(spark):
    p = pred(spark, {"report_id": "a", "primary_site": "LEFT lung (x)"}, {"report_id": "b", "primary_site": "liver"}, {"report_id": "z"})
    g = gold(spark, {"report_id": "a", "primary_site": "left lung"}, {"report_id": "b", "primary_site": "lung"}, {"report_id": "c", "primary_site": "lung"}, {"report_id": "d"})
    r = by_field(scoring.field_metrics(p, g))["primary_site"]
    assert (r.tp, r.fp, r.fn, r.tn, r.n_gold, r.n_predictions) == (1, 1, 2, 1, 4, 3)
    assert r.precision == 0.5 and r.recall == pytest.approx(1 / 3) and r.exact_match == 0.5


def test_last_prediction_wins_and_fields_are_all_there(spark):
    p = pred(spark, {"report_id": "a", "tumor_grade": "G1"}, {"report_id": "a", "tumor_grade": "G2"})
    out = by_field(scoring.field_metrics(p, gold(spark, {"report_id": "a", "tumor_grade": "g2"})))
    assert set(out) == set(FIELDS) and out["tumor_grade"].tp == 1


def test_empty_inputs(spark):
    assert scoring.aggregate_metrics(pred(spark), gold(spark)).collect()[0].asDict() == {"weighted_f1": 0.0, "mean_f1": 0.0, "mean_exact_match": 0.0, "hallucination_rate": 0.0, "n_records": 0}
    assert tiers.tier_distribution(pred(spark)).collect()[0].asDict() == {"tier_1_rate": 0.0, "tier_2_rate": 0.0, "tier_3_rate": 0.0}
    assert scoring.field_null_rates(pred(spark)).collect()[0].null_rate_tnm_stage_T == 0.0
    assert compare.comparison_matrix(pred(spark), gold(spark), semantic.NgramEmbedder()).count() == 0


def test_rates_over_structurally_valid_rows(spark):
    p = pred(
        spark,
        {"report_id": "a", "hallucination_flags": ["x"], "tnm_stage": ("T1", "N0", "M0")},
        {"report_id": "b", "validation_status": "vocab_flagged", "hallucination_flags": []},
        {"report_id": "c", "validation_status": "json_failed", "hallucination_flags": ["x"]},
        {"report_id": "d", "validation_status": None},
    )
    r = scoring.quality_rates(p).collect()[0]
    assert (r.n_rows, r.pass_rate, r.hallucination_rate, r.m_null_rate) == (4, 0.5, 0.5, 0.5)


@pytest.mark.parametrize(
    ("row", "tier"),
    [
        ({"tnm_stage": ("T1", "N0", None)}, "tier_1"),
        ({"tnm_stage": ("T1", None, "M0")}, "tier_2"),
        ({"tnm_stage": ("T1", "N0", "M0"), "hallucination_flags": ["a", "b"]}, "tier_2"),
        ({"tnm_stage": ("T1", "N0", "M0"), "hallucination_flags": ["a", "b", "c"]}, "tier_3"),
        ({"tnm_stage": ("T1", "N0", "M0"), "validation_status": "vocab_flagged"}, "tier_2"),
        ({"validation_status": "schema_failed"}, "tier_3"),
        ({"tnm_stage": ("T1", "N0", "M0"), "validation_status": "other"}, "tier_1"),
    ],
)
def test_tiers(spark, row, tier):
    assert tiers.classify(pred(spark, {"report_id": "a"} | row)).collect()[0].tier == tier


def test_semantic_rules_in_order(spark):
    rows = [
        ("tumor_grade", "grade 2", "g2", 1.0), ("tumor_grade", "grade 2-3", "grade iii", 0.5), ("tumor_grade", "g1", "g3", 0.0), ("tumor_grade", "odd", "g3", 0.0),
        ("histological_subtype", "nst", "nos", 1.0), ("histological_diagnosis", "nst", "nos", -1.0), ("primary_site", "left lung", "right lung", 0.0),
        ("primary_site", "left lung", "lung", -1.0), ("primary_site", None, "lung", None), ("tumor_grade", "odd", "odd", 1.0),
    ]
    df = spark.createDataFrame([(i, f, p, g) for i, (f, p, g, _) in enumerate(rows)], "i int, field string, pred string, gold string")
    got = df.select("i", semantic.rule_score(F.col("pred"), F.col("gold"), F.col("field")).alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [r[3] for r in rows]


def test_similarity_counts_missing_sides_and_combined_weights(spark):
    p = pred(spark, {"report_id": "a", "primary_site": "lung"}, {"report_id": "b", "tnm_stage": ("T1", None, None)})
    g = gold(spark, {"report_id": "a", "primary_site": "lung"}, {"report_id": "b", "primary_site": "lung", "tnm_stage": ("T1", None, None)})
    pairs = scoring.field_pairs(p, g)
    sims = semantic.semantic_metrics(semantic.score_pairs(pairs, semantic.NgramEmbedder()))
    site = by_field(sims)["primary_site"]
    assert (site.mean_similarity, site.mean_similarity_complete, site.n_omission, site.n_scored_pairs) == (1.0, 0.5, 1, 1)
    # 1 * 0.5 + 7 * 1 (fields missing on both sides) + 3 * 1 (T) + 3 * 0 + 1 * 0, over 15
    assert semantic.combined_score(scoring.score_fields(pairs), sims).collect()[0].combined_score == pytest.approx(10.5 / 15)


def test_strata(spark):
    g = gold(spark, {"report_id": "a", "cancer_type": "X", "tumor_grade": "g1"}, {"report_id": "b", "tumor_grade": "g1"}, {"report_id": "b", "tumor_grade": "g1"})
    out = {r.stratum: r for r in scoring.stratified_metrics(pred(spark, {"report_id": "a", "tumor_grade": "g1", "hallucination_flags": ["f"]}), g, "cancer_type").collect()}
    assert (out["X"].n_records, out["X"].hallucination_rate) == (1, 1.0) and (out["unknown"].n_records, out["unknown"].hallucination_rate) == (2, 0.0)
    with pytest.raises(ValueError, match="Unsupported"):
        scoring.stratified_metrics(pred(spark), g, "model")


def test_matrix_scores_every_model_on_all_gold(spark):
    p = pred(spark, {"report_id": "a", "model": "x", "tumor_grade": "g1"}, {"report_id": "a", "model": "y", "tumor_grade": "g1"}, {"report_id": "b", "model": "y", "tumor_grade": "g2"})
    g = gold(spark, {"report_id": "a", "tumor_grade": "g1"}, {"report_id": "b", "tumor_grade": "g2"})
    prices = spark.createDataFrame([("y", 1.0, 2.0)], "model string, input_price double, output_price double")
    traits = spark.createDataFrame([("x", True)], "model string, trait boolean")
    out = {r.model: r for r in compare.comparison_matrix(p, g, semantic.NgramEmbedder(), prices, traits).collect()}
    assert out["x"].avg_cost == 0.0 and out["y"].avg_cost == 0.00002 and out["x"].trait and not out["y"].trait
    assert out["y"].weighted_f1 > out["x"].weighted_f1 > 0


def test_dev_subset_is_exact_deterministic_and_spread(spark):
    rows = spark.createDataFrame([(f"r{i}", ["A", "B", None][i % 3], ["s", None][i % 2]) for i in range(60)], "report_id string, cancer_type string, style string")
    a = sampling.dev_subset(rows, 20, 1).collect()
    assert len(a) == 20 and len({(r.cancer_type, r.style) for r in a}) == 6
    assert {r.report_id for r in a} == {r.report_id for r in sampling.dev_subset(rows.repartition(7), 20, 1).collect()} != {r.report_id for r in sampling.dev_subset(rows, 20, 2).collect()}
    assert sampling.dev_subset(rows, 100).count() == 60 and sampling.dev_subset(rows.limit(0), 5).count() == 0


def test_style_lookup_and_attach(spark):
    corpus = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "", 3), ("", "z", 4), ("c", None, 5)], "report_id string, style string, n int")
    lookup = scoring.style_lookup(corpus, "n")
    assert [tuple(r) for r in lookup.collect()] == [("a", "y")]
    records = spark.createDataFrame([("a", None), ("b", None), ("c", "own")], "report_id string, style string")
    assert sorted(tuple(r) for r in scoring.attach_style(records, lookup).collect()) == [("a", "y"), ("b", "unknown"), ("c", "own")]


def test_counters(spark):
    r = extract.run_counters(pred(spark, {"report_id": "a"}, {"report_id": "b", "validation_status": "json_failed", "truncated": True})).collect()[0]
    assert (r.total, r.valid, r.json_failed, r.truncated, r.total_input_tokens, r.avg_latency_ms, r.pass_rate) == (2, 1, 1, 1, 20, 2.0, 0.5)


def double_of(path):
    """A model made from a file: vectors of the letters it lists."""
    letters = open(path).read().strip()
    return lambda texts: [[float(t.count(c)) for c in letters] for t in texts]


def test_model_is_loaded_by_path(spark, tmp_path):
    (tmp_path / "model").write_text("abc\n")
    strings = spark.createDataFrame([("aab",), ("cc",), ("",)], "value string")
    got = {r.value: r.vector for r in semantic.ModelEmbedder(str(tmp_path / "model"), double_of, batch=2).table(strings).collect()}
    assert got == {"aab": [2.0, 1.0, 0.0], "cc": [0.0, 0.0, 2.0], "": [0.0, 0.0, 0.0]}


def test_scores_from_counted_pairs_equal_those_of_single_pairs(spark):
    rows = [("tumor_grade", "g1", "g1")] * 5 + [("tumor_grade", "g1", "g2")] * 3 + [("tumor_grade", None, "g2")] * 2 + [("primary_site", None, None), ("primary_site", "x", None), ("primary_site", "a b", "a c")]
    pairs = spark.createDataFrame(rows, "field string, pred string, gold string")
    both = [(df, semantic.semantic_metrics(semantic.score_pairs(df, semantic.NgramEmbedder()))) for df in (pairs, scoring.count_pairs(pairs))]
    plain, counted = ([scoring.score_fields(df).orderBy("field").collect(), sims.orderBy("field").collect()] for df, sims in both)
    assert plain[0] == counted[0] and [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in plain[1]] == [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in counted[1]]
