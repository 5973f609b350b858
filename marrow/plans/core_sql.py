"""SQL of the core queries, for a second engine over the same tables."""

from __future__ import annotations

_TRIM = r"'^[\s\pZ\x1c-\x1f\x85]+|[\s\pZ\x1c-\x1f\x85]+$'"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, {_TRIM}, '', 'g')"


def _norm(c: str, parens: bool) -> str:
    low = f"lower({_strip(c)})"
    return _strip(rf"regexp_replace({low}, '\s*\([^)]*\)', '', 'g')") if parens else low


_FIELDS = {
    "primary_site": 1, "specimen_type": 1, "histological_diagnosis": 2, "histological_subtype": 2,
    "tumor_grade": 2, "tnm_stage.T": 3, "tnm_stage.N": 3, "tnm_stage.M": 1,
}
_WEIGHT = "CASE field " + " ".join(f"WHEN '{f}' THEN {w}.0" for f, w in _FIELDS.items()) + " END"
_OK = "validation_status IN ('valid', 'vocab_flagged')"
_FLAGGED = "coalesce(len(hallucination_flags), 0) > 0"
_PRED = "pred AS (SELECT * FROM extractions QUALIFY row_number() OVER (PARTITION BY report_id ORDER BY extraction_id DESC) = 1)"
_GOLD = "gold AS (SELECT DISTINCT * FROM gold_records)"


def _pairs(keys: str = "", on: str = "g.report_id = p.report_id", gold: str = "gold") -> str:
    parts = [
        f"SELECT {keys} g.report_id, '{f}' AS field, {_norm('p.' + f, f in ('primary_site', 'specimen_type'))} AS pred, {_norm('g.' + f, f in ('primary_site', 'specimen_type'))} AS gold FROM {gold} g LEFT JOIN pred p ON {on}"
        for f in _FIELDS
    ]
    return "pairs AS (" + " UNION ALL ".join(parts) + ")"


def _scores(by: str = "") -> str:
    return f"""counted AS (
      SELECT {by} field,
        count(*) FILTER (pred IS NOT NULL AND gold IS NOT NULL AND pred = gold) AS tp,
        count(*) FILTER (pred IS NOT NULL AND (gold IS NULL OR pred <> gold)) AS fp,
        count(*) FILTER (gold IS NOT NULL AND (pred IS NULL OR pred <> gold)) AS fn,
        count(*) FILTER (pred IS NULL AND gold IS NULL) AS tn,
        count(*) FILTER ((pred IS NULL) = (gold IS NULL)) AS same, count(*) AS n_gold
      FROM pairs GROUP BY {by} field
    ), rated AS (
      SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS "precision", coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall FROM counted
    ), scores AS (
      SELECT *, coalesce(2 * "precision" * recall / nullif("precision" + recall, 0), 0.0) AS f1,
        coalesce((tp + tn) / nullif(n_gold, 0), 0.0) AS exact_match, coalesce(same / nullif(n_gold, 0), 0.0) AS null_accuracy FROM rated
    )"""


_ROLL = f"round(sum({_WEIGHT} * f1) / sum({_WEIGHT}), 6) AS weighted_f1, round(avg(f1), 6) AS mean_f1, round(avg(exact_match), 6) AS mean_exact_match"


def _stratified(gold: str) -> str:
    return f"""
    WITH {_PRED}, marked AS ({gold}), gold AS (SELECT DISTINCT * FROM marked), {_pairs('g.stratum,')}, {_scores('stratum,')},
    flags AS (
      SELECT g.stratum, coalesce(count(*) FILTER ({_OK} AND {_FLAGGED}) / nullif(count(*) FILTER ({_OK}), 0), 0.0) AS r
      FROM pred p JOIN gold g ON p.report_id = g.report_id GROUP BY 1
    ), sizes AS (SELECT stratum, count(*) AS n_records FROM marked GROUP BY 1)
    SELECT s.stratum, {_ROLL}, any_value(n_records) AS n_records, round(coalesce(any_value(r), 0.0), 6) AS hallucination_rate
    FROM scores s JOIN sizes z ON s.stratum = z.stratum LEFT JOIN flags f ON s.stratum = f.stratum GROUP BY s.stratum
    """


_LOOKUP = "lookup AS (SELECT report_id, max_by(style, record_id) AS style FROM corpus WHERE report_id <> '' AND style <> '' GROUP BY 1)"
_T = "regexp_matches({0}, '^(p|c|y|r|a)?T([0-4][a-c]?|X|is)(\\([^)]+\\))?$', 'i')"
_N = "regexp_matches({0}, '^(p|c|y|r)?N([0-3][a-c]?|X)(mi)?(\\s*\\([^)]+\\))*$', 'i')"
_M = "regexp_matches({0}, '^(p|c)?M([01][a-c]?|X)$', 'i')"


def _grade_key(c: str) -> str:
    out = rf"regexp_replace(lower({_strip(c)}), '[‐-―−]', '-', 'g')"
    for roman, digit in (("iv", 4), ("iii", 3), ("ii", 2), ("i", 1)):
        out = rf"regexp_replace({out}, '\b{roman}\b', '{digit}', 'g')"
    return out


_GRADES = ", ".join(
    f"'{g}'"
    for g in (
        "grade 1", "grade 2", "grade 3", "grade 4", "g1", "g2", "g3", "g4", "gx", "grade 1-2", "grade 2-3", "grade 3-4", "nhg1", "nhg2", "nhg3",
        "low", "intermediate", "high", "well differentiated", "moderately differentiated", "poorly differentiated", "undifferentiated", "low grade",
        "intermediate grade", "high grade", "moderate to poorly differentiated", "moderately to poorly differentiated", "poorly to moderately differentiated",
    )
)
_GRADE_OK = f"({_grade_key('{0}')} IN ({_GRADES}))"


def _parse_grade(c: str) -> str:
    k = _grade_key(rf"regexp_replace({c}, '\s*\([^)]*\)', '', 'g')")
    worded = [("moderate to poorly differentiated", "G2-G3"), ("moderately to poorly differentiated", "G2-G3"), ("poorly to moderately differentiated", "G2-G3"), ("well differentiated", "G1"), ("moderately differentiated", "G2"), ("poorly differentiated", "G3"), ("undifferentiated", "G4")]
    plain = [("low", "G1"), ("low grade", "G1"), ("intermediate", "G2"), ("intermediate grade", "G2"), ("high", "G3"), ("high grade", "G3")]
    rng, num = r"\bgrade\s*([1-4])\s*-\s*([1-4])\b", r"\b(?:grade|nhg|g)\s*([1-4])\b"
    return (
        f"CASE WHEN regexp_matches({k}, '{rng}') THEN 'G' || regexp_extract({k}, '{rng}', 1) || '-G' || regexp_extract({k}, '{rng}', 2) "
        + " ".join(f"WHEN contains({k}, '{w}') THEN '{g}'" for w, g in worded)
        + f" WHEN regexp_matches({k}, '{num}') THEN 'G' || regexp_extract({k}, '{num}', 1) "
        + " ".join(f"WHEN {k} = '{w}' THEN '{g}'" for w, g in plain)
        + " END"
    )


def _side(c: str) -> str:
    word = lambda w: rf"regexp_matches(lower({c}), '\b{w}\b')"
    return f"CASE WHEN {word('bilateral')} OR ({word('left')} AND {word('right')}) THEN 'bilateral' WHEN {word('left')} THEN 'left' WHEN {word('right')} THEN 'right' END"


def _nst(c: str) -> str:
    return f"CASE WHEN field = 'histological_subtype' AND {c} IN ('nst', 'nos', 'no special type', 'not otherwise specified', 'nos (no special type)', 'nos (not otherwise specified)') THEN 'nst' ELSE {c} END"


_RULES = f"""facts AS (
      SELECT *, {_nst('pred')} AS p, {_nst('gold')} AS g, {_parse_grade('pred')} AS gp, {_parse_grade('gold')} AS gg, {_side('pred')} AS sp, {_side('gold')} AS sg
      FROM pairs WHERE field IN ('primary_site', 'histological_diagnosis', 'histological_subtype', 'tumor_grade', 'specimen_type')
    ), ruled AS (
      SELECT *, CASE WHEN p IS NULL OR g IS NULL THEN NULL WHEN p = g THEN 1.0
        WHEN field = 'tumor_grade' THEN CASE WHEN gp IS NULL OR gg IS NULL THEN 0.0 WHEN gp = gg THEN 1.0
          WHEN greatest(CAST(substr(gp, 2, 1) AS INT), CAST(substr(gg, 2, 1) AS INT)) <= least(CAST(right(gp, 1) AS INT), CAST(right(gg, 1) AS INT)) THEN 0.5 ELSE 0.0 END
        WHEN field = 'primary_site' AND sp <> sg THEN 0.0 ELSE -1.0 END AS score FROM facts
    )"""
_SIM = f"""{_RULES}, sims AS (
      SELECT r.*, CASE WHEN score = -1.0 THEN coalesce(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 0.0) ELSE score END AS similarity
      FROM ruled r LEFT JOIN embeddings a ON a.vec_id = (length(pred) * 31 + ascii(pred)) % (SELECT count(*) FROM embeddings) LEFT JOIN embeddings b ON b.vec_id = (length(gold) * 31 + ascii(gold)) % (SELECT count(*) FROM embeddings)
    )"""


def _semantic(by: str = "") -> str:
    return f"""semantics AS (
      SELECT {by} field, coalesce(avg(similarity), 0.0) AS mean_similarity,
        avg(CASE WHEN pred IS NULL AND gold IS NULL THEN 1.0 WHEN pred IS NULL OR gold IS NULL THEN 0.0 ELSE similarity END) AS mean_similarity_complete,
        count(similarity) AS n_scored_pairs, count(*) FILTER (pred IS NULL AND gold IS NULL) AS n_both_null,
        count(*) FILTER (pred IS NULL AND gold IS NOT NULL) AS n_omission, count(*) FILTER (pred IS NOT NULL AND gold IS NULL) AS n_hallucination
      FROM sims GROUP BY {by} field
    )"""


_COMBINED = f"round(sum({_WEIGHT.replace('field', 's.field')} * coalesce(m.mean_similarity_complete, s.f1)) / sum({_WEIGHT.replace('field', 's.field')}), {{0}})"
_NULL_RATES = ", ".join(f"round(coalesce(count(*) FILTER ({_OK} AND {f} IS NULL) / nullif(count(*) FILTER ({_OK}), 0), 0.0), 4) AS null_rate_{f.replace('.', '_')}" for f in _FIELDS)


def _baseline(metrics: list[str], log: str = "run_log") -> str:
    value = lambda t, m: f"{t}.metrics['{m}']"
    avgs = ", ".join(f"avg({value('o', m)}) AS b{k}" for k, m in enumerate(metrics))
    cur = ", ".join(f"any_value({value('r', m)}) AS c{k}" for k, m in enumerate(metrics))
    return f"""latest AS (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY end_time DESC NULLS LAST, run_id) AS k FROM {log} WHERE status = 'FINISHED' QUALIFY k <= 6),
    nth AS (SELECT r.run_id, o.run_id AS other, row_number() OVER (PARTITION BY r.run_id ORDER BY o.k) AS n FROM {log} r JOIN latest o ON r.experiment = o.experiment AND r.run_id <> o.run_id),
    based AS (SELECT r.run_id, count(o.run_id) AS n_prior, {cur}, {avgs} FROM {log} r LEFT JOIN nth ON nth.run_id = r.run_id AND n <= 5 LEFT JOIN latest o ON o.run_id = nth.other GROUP BY r.run_id)"""


def _change(metric: str, delta: str, limit: float, verb: str) -> str:
    known = "(n_prior >= 2 AND c0 IS NOT NULL AND b0 IS NOT NULL)"
    alert = f"coalesce({known} AND {delta} > {limit}, false)"
    return f"""WITH {_baseline([metric])}
    SELECT run_id, {alert} AS alert, CASE WHEN c0 IS NULL THEN 'OK' WHEN n_prior < 2 THEN 'INSUFFICIENT_DATA' WHEN {alert} THEN 'WARN' ELSE 'OK' END AS level,
      CASE WHEN c0 IS NULL THEN '{metric} not logged in this run' WHEN n_prior < 2 THEN 'fewer than 2 finished runs to compare with' WHEN b0 IS NULL THEN '{metric} not logged in the runs before'
        ELSE '{metric} ' || CASE WHEN {alert} THEN '{verb}' ELSE 'within range' END || ': ' || printf('%.1f', b0 * 100) || '% -> ' || printf('%.1f', c0 * 100) || '%' END AS message,
      round(c0, 6) AS current, round(b0, 6) AS baseline, CASE WHEN {known} THEN round({delta}, 4) ELSE 0.0 END AS delta FROM based"""


_TIER1 = ("tier1_rate", "abs(c0 - b0)", 0.10, "moved")
_PASS = ("pass_rate", "b0 - c0", 0.10, "fell")


def _payload(rows: str, hit: str, shown: str, item: str, alerts: str, calm: str, warn: str, name: str) -> str:
    """One row a run over ``rows`` (run_id, n_prior, nth, metric, c, b)."""
    return f"""h AS (SELECT *, coalesce(c IS NOT NULL AND n_prior >= 2 AND {hit}, false) AS hit FROM ({rows})),
    g AS (SELECT run_id, max(n_prior) AS n_prior, count(c) AS n, count(*) FILTER (hit) AS k, coalesce(string_agg({item}, '; ' ORDER BY nth) FILTER (hit), '') AS items, string_agg({shown}, ', ' ORDER BY nth) FILTER (hit) AS shown FROM h GROUP BY run_id)
    SELECT run_id, k > 0 AS alert, CASE WHEN n = 0 THEN 'OK' WHEN n_prior < 2 THEN 'INSUFFICIENT_DATA' WHEN k > 0 THEN 'WARN' ELSE 'OK' END AS level,
      CASE WHEN n = 0 THEN '{name} not logged in this run' WHEN n_prior < 2 THEN 'fewer than 2 finished runs to compare with' WHEN k > 0 THEN '{warn}: ' || shown ELSE n || ' {calm} within range' END AS message, items AS {alerts} FROM g"""


_USAGE_ROWS = "SELECT run_id, n_prior, 1 AS nth, 'mean_output_tokens' AS metric, c0 AS c, b0 AS b, 1.5 AS f FROM based UNION ALL SELECT run_id, n_prior, 2, 'mean_latency_s', c1, b1, 2.0 FROM based"
_USAGE_HIT = "b > 0 AND c > b * f"
_NULLS = [f"null_rate_{f.replace('.', '_')}" for f in _FIELDS]
_NULL_ROWS = " UNION ALL ".join(f"SELECT run_id, n_prior, {k} AS nth, '{m[10:]}' AS metric, c{k} AS c, b{k} AS b FROM based" for k, m in enumerate(_NULLS))
_NULL_LOG = f"""rates AS (SELECT run_id, {_NULL_RATES} FROM extractions GROUP BY run_id),
    log AS (SELECT r.run_id, experiment, status, end_time, CASE WHEN q.run_id IS NULL THEN metrics ELSE MAP {{{', '.join(f"'{m}': q.{m}" for m in _NULLS)}}} END AS metrics FROM run_log r LEFT JOIN rates q ON q.run_id = r.run_id)"""
_COUNTERS = f"""SELECT run_id, count(*) AS total, count(*) FILTER (validation_status = 'valid') AS valid, count(*) FILTER (validation_status = 'vocab_flagged') AS vocab_flagged,
      count(*) FILTER (validation_status = 'json_failed') AS json_failed, count(*) FILTER (validation_status = 'schema_failed') AS schema_failed, count(*) FILTER (truncated) AS truncated,
      CAST(coalesce(sum(input_tokens), 0) AS BIGINT) AS total_input_tokens, CAST(coalesce(sum(output_tokens), 0) AS BIGINT) AS total_output_tokens,
      round(coalesce(sum(latency_ms), 0) / count(*), 6) AS avg_latency_ms, round(coalesce(sum(input_tokens), 0) / count(*), 6) AS mean_input_tokens,
      round(coalesce(sum(output_tokens), 0) / count(*), 6) AS mean_output_tokens, round(count(*) FILTER ({_OK}) / count(*), 6) AS pass_rate FROM extractions GROUP BY run_id"""
_TIER = """CASE WHEN validation_status IN ('json_failed', 'schema_failed') OR coalesce(len(hallucination_flags), 0) > 2 THEN 'tier_3'
      WHEN validation_status = 'vocab_flagged' OR coalesce(len(hallucination_flags), 0) >= 1 OR tnm_stage.T IS NULL OR tnm_stage.N IS NULL THEN 'tier_2' ELSE 'tier_1' END"""


def _flag(c: str, ok: str, label: str) -> str:
    shown = rf"""CASE WHEN contains({c}, '''') AND NOT contains({c}, '"') THEN '"' || {c} || '"' ELSE '''' || {c} || '''' END"""
    return f"CASE WHEN {c} IS NOT NULL AND {c} <> '' AND NOT {ok.format(c)} THEN '{label}: ' || {shown} END"


_VOCAB = "list_filter([" + ", ".join([_flag("tnm_stage.T", _T, "invalid_tnm_T"), _flag("tnm_stage.N", _N, "invalid_tnm_N"), _flag("tnm_stage.M", _M, "invalid_tnm_M"), _flag("tumor_grade", _GRADE_OK, "unrecognised_grade")]) + "], lambda x: x IS NOT NULL)"
_COST = "(coalesce(input_tokens, 0) * CASE WHEN model IN ('gpt-4o', 'o4-mini') THEN 1.0 ELSE 0 END + coalesce(output_tokens, 0) * CASE WHEN model IN ('gpt-4o', 'o4-mini') THEN 4.0 ELSE 0 END) / 1e6"
_DELTA_METRICS = {"pass_rate": "true", "hallucination_rate": "false", "weighted_f1": "true", "mean_output_tokens": "false"}
_CHECKED = {"tnm_stage.T": _T.format("value"), "tnm_stage.N": _N.format("value"), "tnm_stage.M": _M.format("value"), "tumor_grade": _GRADE_OK.format("value"), "histological_diagnosis": "true", "primary_site": "true"}
_UNKNOWN = "('', '-', '--', '?', 'unknown', 'unk', 'not known', 'n/a', 'na', 'n.a.', 'nil', 'none', 'none given', 'null', 'not given', 'not stated', 'not available', 'not applicable', 'not recorded', 'not provided', 'not reported', 'missing', 'pending', 'see comment', 'see note', 'see synoptic table', 'same as above')"

#: Stored replies taken apart again: the object, whether it is one, and its type errors in schema order.
_TEXT_FIELDS = ("primary_site", "histological_diagnosis", "histological_subtype", "tumor_grade")
_ERRORS = [("patient", "PatientIdentification"), *[(f, None) for f in _TEXT_FIELDS], ("tnm_stage", "TNMStage"), *[(f"tnm_stage.{x}", None) for x in ("T", "N", "M", "edition")], ("specimen_type", None), ("extraction_notes", None)]


def _error(path: str, cls: str | None) -> str:
    kind = f"json_type(obj, '$.{path}')"
    want = f"Input should be a valid dictionary or instance of {cls}" if cls else "Input should be a valid string"
    return f"CASE WHEN {kind} NOT IN ('NULL', '{'OBJECT' if cls else 'VARCHAR'}') THEN '- {path}: {want}' END"


_JUDGED = f"""parts AS (SELECT *, CASE WHEN contains(raw_text, '```') THEN regexp_replace(split_part(raw_text, '```', 2), '^json', '') ELSE {_strip('raw_text')} END AS inner_text FROM extractions),
    objects AS (SELECT *, CASE WHEN instr(inner_text, '{{') > 0 THEN substr(inner_text, instr(inner_text, '{{')) END AS obj_text FROM parts),
    checked AS (SELECT *, raw_text IS NULL OR (obj_text IS NOT NULL AND json_valid(obj_text)) AS is_json FROM objects),
    readable AS (SELECT *, CASE WHEN raw_text IS NOT NULL AND is_json THEN obj_text::JSON END AS obj FROM checked),
    judged AS (SELECT *, CASE WHEN obj IS NULL THEN '' ELSE concat_ws(chr(10), {', '.join(_error(p, c) for p, c in _ERRORS)}) END AS errors FROM readable)"""

SQL: dict[str, str] = {
    "p3_profile": f"""WITH long AS ({" UNION ALL ".join(f"SELECT load_no, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, {ok.replace('value', c)} AS ok FROM extractions" for c, ok in _CHECKED.items())}),
      judged AS (SELECT *, (value IS NULL OR lower({_strip('value')}) IN {_UNKNOWN}) AS missing FROM long)
      SELECT load_no, column_name, count(*) AS n_rows, count(*) FILTER (value IS NULL) AS n_null, count(*) FILTER (missing) AS n_missing, count(*) FILTER (NOT missing AND NOT ok) AS n_failed,
        count(DISTINCT value) AS n_distinct, min(value) AS min_value, max(value) AS max_value, min(length(value)) AS min_length, max(length(value)) AS max_length,
        (SELECT max(n) FROM (SELECT j.load_no AS l, j.column_name AS c, j.value, count(*) AS n FROM judged j WHERE j.value IS NOT NULL GROUP BY ALL) q WHERE q.l = judged.load_no AND q.c = judged.column_name) AS top_count,
        round(count(*) FILTER (value IS NULL) / count(*), 6) AS null_rate
      FROM judged GROUP BY load_no, column_name""",
    "field_metrics": f"""WITH {_PRED}, {_GOLD}, {_pairs()}, {_scores()}
      SELECT field, tp, fp, fn, tn, n_gold, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, round(exact_match, 6) AS exact_match, round(null_accuracy, 6) AS null_accuracy,
        (SELECT count(DISTINCT report_id) FROM extractions) AS n_predictions FROM scores""",
    "aggregate_metrics": f"""WITH {_PRED}, {_GOLD}, {_pairs()}, {_scores()}
      SELECT {_ROLL}, (SELECT round(coalesce(count(*) FILTER ({_OK} AND {_FLAGGED}) / nullif(count(*) FILTER ({_OK}), 0), 0.0), 6) FROM extractions) AS hallucination_rate,
        (SELECT count(*) FROM gold_records) AS n_records FROM scores""",
    "stratified_by_type": _stratified("SELECT *, coalesce(cancer_type, 'unknown') AS stratum FROM gold_records"),
    "stratified_by_style": _stratified(
        f"SELECT g.*, coalesce(l.style, 'unknown') AS stratum FROM gold_records g LEFT JOIN (WITH corpus AS (SELECT report_id, record_id, lower({_strip('style')}) AS style FROM pilot_corpus), {_LOOKUP} SELECT * FROM lookup) l ON l.report_id = g.report_id"
    ),
    "quality_rates": f"""SELECT load_no, count(*) AS n_rows, round(count(*) FILTER ({_OK}) / count(*), 6) AS pass_rate,
        round(coalesce(count(*) FILTER ({_OK} AND {_FLAGGED}) / nullif(count(*) FILTER ({_OK}), 0), 0.0), 6) AS hallucination_rate,
        round(coalesce(count(*) FILTER ({_OK} AND tnm_stage.M IS NULL) / nullif(count(*) FILTER ({_OK}), 0), 0.0), 6) AS m_null_rate FROM extractions GROUP BY load_no""",
    "field_null_rates": f"SELECT model, {_NULL_RATES} FROM extractions GROUP BY model",
    "tier_records": f"SELECT extraction_id, {_TIER} AS tier FROM extractions",
    "tier_distribution": f"WITH t AS (SELECT model, {_TIER} AS tier FROM extractions) SELECT model, " + ", ".join(f"round(count(*) FILTER (tier = '{t}') / count(*), 6) AS {t}_rate" for t in ("tier_1", "tier_2", "tier_3")) + " FROM t GROUP BY model",
    "vocab_flags": f"WITH v AS (SELECT extraction_id, {_VOCAB} AS f FROM extractions) SELECT extraction_id, array_to_string(f, '; ') AS flags, CAST(len(f) AS BIGINT) AS n_flags FROM v",
    "normalized_fields": "SELECT extraction_id, " + ", ".join(f"{_norm(f, f in ('primary_site', 'specimen_type'))} AS {f.replace('.', '_')}" for f in _FIELDS) + " FROM extractions",
    "grade_tokens": f"SELECT tumor_grade, {_parse_grade('tumor_grade')} AS grade, count(*) AS n FROM extractions GROUP BY tumor_grade",
    "site_sides": f"SELECT primary_site, {_side('primary_site')} AS side, count(*) AS n FROM extractions GROUP BY primary_site",
    "semantic_rules": f"WITH {_PRED}, {_GOLD}, {_pairs()}, {_RULES} SELECT report_id, field, pred, gold, score FROM ruled",
    "semantic_metrics": f"WITH {_PRED}, {_GOLD}, {_pairs()}, {_SIM}, {_semantic()} SELECT field, round(mean_similarity, 6) AS mean_similarity, round(mean_similarity_complete, 6) AS mean_similarity_complete, n_scored_pairs, n_both_null, n_omission, n_hallucination FROM semantics",
    "combined_score": f"""WITH {_PRED}, {_GOLD}, {_pairs()}, {_scores()}, {_SIM}, {_semantic()}
      SELECT {_COMBINED.format(6)} AS combined_score, (SELECT round(avg(mean_similarity), 6) FROM semantics WHERE n_scored_pairs > 0) AS mean_similarity FROM scores s LEFT JOIN semantics m ON s.field = m.field""",
    "embedding_cosine": "SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "comparison_matrix": f"""WITH pred AS (SELECT * FROM extractions WHERE model IS NOT NULL QUALIFY row_number() OVER (PARTITION BY model, report_id ORDER BY extraction_id DESC) = 1),
      gold AS (SELECT g.*, m.model FROM (SELECT DISTINCT * FROM gold_records) g, (SELECT DISTINCT model FROM extractions WHERE model IS NOT NULL) m),
      {_pairs('g.model,', 'g.report_id = p.report_id AND g.model = p.model')}, {_scores('model,')}, {_SIM}, {_semantic('model,')},
      c AS (SELECT s.model, {_COMBINED.format(4)} AS combined_score, round(sum({_WEIGHT.replace('field', 's.field')} * f1) / sum({_WEIGHT.replace('field', 's.field')}), 4) AS weighted_f1 FROM scores s LEFT JOIN semantics m ON s.field = m.field AND s.model = m.model GROUP BY s.model),
      a AS (SELECT model, round(avg(mean_similarity), 4) AS mean_similarity, round(avg(mean_similarity_complete), 4) AS mean_similarity_complete FROM semantics GROUP BY model),
      u AS (SELECT model, round(coalesce(count(*) FILTER ({_OK} AND {_FLAGGED}) / nullif(count(*) FILTER ({_OK}), 0), 0.0), 4) AS hallucination_rate, round(avg({_COST}), 6) AS avg_cost, round(avg(latency_ms), 1) AS avg_latency_ms, model = 'llama3.2' AS trait FROM extractions GROUP BY model)
      SELECT c.*, a.mean_similarity, a.mean_similarity_complete, u.hallucination_rate, u.avg_cost, u.avg_latency_ms, u.trait FROM c JOIN a ON a.model = c.model JOIN u ON u.model = c.model""",
    "cost_per_record": f"SELECT model, round(avg({_COST}), 6) AS cost_per_record, round(sum({_COST}), 6) AS total_cost, count(*) AS n_rows FROM extractions GROUP BY model",
    "run_counters": _COUNTERS,
    "drift_tier1": _change(*_TIER1),
    "drift_pass_rate": _change(*_PASS),
    "hallucination_alert": """SELECT run_id, coalesce(r > 0.08, false) AS alert, CASE WHEN r > 0.08 THEN 'CRITICAL' ELSE 'OK' END AS level, coalesce(round(r, 4), 0.0) AS rate, coalesce(r > 0.08, false) AS should_pause,
        CASE WHEN r IS NULL THEN 'hallucination_rate not logged in this run' ELSE 'hallucination_rate ' || CASE WHEN r > 0.08 THEN 'above' ELSE 'within' END || ' 8%: ' || printf('%.1f', r * 100) || '%' END AS message
      FROM (SELECT run_id, metrics['hallucination_rate'] AS r FROM run_log)""",
    "drift_null_rates": f"""WITH {_NULL_LOG}, {_baseline(_NULLS, 'log')}, {_payload(_NULL_ROWS, 'c - b > 0.15', "metric || ' (+' || printf('%.0f', (c - b) * 100) || '%)'", "metric || printf(' %.4f %.4f %.4f', c, b, c - b)", 'field_alerts', 'null shares', 'null shares rose', 'null shares')}""",
    "drift_usage": f"""WITH {_baseline(['mean_output_tokens', 'mean_latency_s'])}, {_payload(_USAGE_ROWS, _USAGE_HIT, "metric || printf(' (%.1fx)', c / b)", "metric || printf(' %.2f %.2f %.2f', c, b, c / b)", 'metric_alerts', 'usage metrics', 'usage rose', 'usage')}""",
    "run_alerts": f"""SELECT run_id, 'pass_rate' AS monitor, level, 'pass_rate' AS detail FROM ({_change(*_PASS)}) WHERE alert
      UNION ALL SELECT run_id, 'tier1', level, 'tier1_rate' FROM ({_change(*_TIER1)}) WHERE alert
      UNION ALL SELECT run_id, 'hallucination', 'CRITICAL', 'hallucination_rate' FROM run_log WHERE metrics['hallucination_rate'] > 0.08
      UNION ALL SELECT run_id, 'null_rate', 'WARN', metric FROM (WITH {_NULL_LOG}, {_baseline(_NULLS, 'log')} {_NULL_ROWS}) WHERE c - b > 0.15 AND n_prior >= 2
      UNION ALL SELECT run_id, 'usage', 'WARN', metric FROM (WITH {_baseline(['mean_output_tokens', 'mean_latency_s'])} {_USAGE_ROWS}) WHERE {_USAGE_HIT} AND n_prior >= 2""",
    "rolling_pass_rate": """WITH v AS (SELECT run_id, experiment, metrics['pass_rate'] AS value, avg(metrics['pass_rate']) OVER w AS baseline, count(*) OVER w AS n_prior FROM run_log WHERE status = 'FINISHED'
      WINDOW w AS (PARTITION BY experiment ORDER BY end_time NULLS FIRST, run_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
      SELECT run_id, experiment, round(value, 6) AS value, round(baseline, 6) AS baseline, n_prior, round(value - baseline, 6) AS delta FROM v""",
    "run_deltas": "WITH d AS ("
    + " UNION ALL ".join(f"SELECT run_id, '{m}' AS metric, metrics['{m}'] AS current, lag(metrics['{m}']) OVER (PARTITION BY experiment ORDER BY end_time NULLS FIRST, run_id) AS previous, {up} AS up FROM run_log WHERE status = 'FINISHED'" for m, up in _DELTA_METRICS.items())
    + ") SELECT run_id, metric, round(current, 6) AS current, round(previous, 6) AS previous, round(current - previous, 6) AS delta, CASE WHEN previous IS NULL THEN 'new' WHEN current = previous THEN 'same' WHEN (current > previous) = up THEN 'better' ELSE 'worse' END AS change FROM d WHERE current IS NOT NULL",
    "recompute_check": f"""WITH a AS (SELECT run_id, count(*) FILTER ({_OK}) / count(*) AS r FROM extractions GROUP BY run_id)
      SELECT a.run_id, round(r, 6) AS recomputed, round(l.metrics['pass_rate'], 6) AS logged, coalesce(abs(r - l.metrics['pass_rate']) < 1e-3, false) AS matches FROM a LEFT JOIN run_log l ON l.run_id = a.run_id""",
    "resume_remaining": "SELECT record_id, report_id FROM pilot_corpus p WHERE NOT EXISTS (SELECT 1 FROM extractions e WHERE e.report_id = p.report_id)",
    "dedup_first": "SELECT report_id, extraction_id, validation_status FROM extractions QUALIFY row_number() OVER (PARTITION BY report_id ORDER BY extraction_id) = 1",
    "dedup_last": "SELECT report_id, extraction_id, validation_status FROM extractions QUALIFY row_number() OVER (PARTITION BY report_id ORDER BY extraction_id DESC) = 1",
    "style_lookup": f"WITH corpus AS (SELECT * FROM pilot_corpus), {_LOOKUP} SELECT * FROM lookup",
    "style_attach": f"WITH corpus AS (SELECT * FROM pilot_corpus), {_LOOKUP} SELECT e.extraction_id, e.report_id, coalesce(l.style, 'unknown') AS style FROM extractions e LEFT JOIN lookup l ON l.report_id = e.report_id",
    "prompt_build": """SELECT record_id, replace(replace('Read.' || chr(10) || chr(10) || 'PATHOLOGY REPORT:' || chr(10) || '<<report_text>>' || chr(10), '<<report_text>>', text), chr(10) || 'PATHOLOGY REPORT:',
      chr(10) || '---' || chr(10) || chr(10) || 'FEW-SHOT EXAMPLES (for reference only — do not copy, extract from the report below):' || chr(10) || chr(10) || '## Example 1' || chr(10) || chr(10) || 'PATHOLOGY REPORT:') AS prompt FROM pilot_corpus""",
    "parse_validate_status": f"""WITH {_JUDGED}
      SELECT extraction_id, CASE WHEN NOT is_json THEN 'json_failed' WHEN errors <> '' OR report_id IS NULL THEN 'schema_failed' WHEN len(flags) > 0 THEN 'vocab_flagged' ELSE 'valid' END AS validation_status,
        CAST(CASE WHEN is_json AND errors = '' AND report_id IS NOT NULL THEN len(flags) ELSE 0 END AS BIGINT) AS n_flags,
        CASE WHEN is_json AND errors = '' AND report_id IS NOT NULL THEN tnm_stage.T END AS t, CASE WHEN is_json AND errors = '' AND report_id IS NOT NULL THEN tumor_grade END AS tumor_grade
      FROM (SELECT * REPLACE (CASE WHEN raw_text IS NULL THEN tumor_grade ELSE json_extract_string(obj, '$.tumor_grade') END AS tumor_grade,
        CASE WHEN raw_text IS NULL THEN tnm_stage ELSE {{'T': json_extract_string(obj, '$.tnm_stage.T'), 'N': json_extract_string(obj, '$.tnm_stage.N'), 'M': json_extract_string(obj, '$.tnm_stage.M'), 'edition': NULL, 'confidence': NULL}} END AS tnm_stage), {_VOCAB} AS flags FROM judged)""",
    "failed_replies": f"WITH {_JUDGED} SELECT extraction_id, validation_status, is_json, NOT is_json OR errors <> '' AS asks_again FROM judged WHERE raw_text IS NOT NULL",
    "correction_messages": f"WITH {_JUDGED} SELECT extraction_id, report_id, CASE WHEN is_json THEN errors ELSE 'no json' END AS errors FROM judged",
    "extract_replay": f"""WITH {_JUDGED}, asked AS (SELECT DISTINCT report_id FROM pilot_corpus WHERE report_id IS NOT NULL),
      nth AS (SELECT *, {_VOCAB} AS flags, row_number() OVER (PARTITION BY report_id ORDER BY extraction_id) AS k FROM judged),
      firsts AS (SELECT * FROM nth WHERE k = 1), seconds AS (SELECT * FROM nth WHERE k = 2),
      tried AS (SELECT a.report_id, NOT coalesce(f.is_json AND f.errors = '', false) AS again, f, s FROM asked a LEFT JOIN firsts f ON f.report_id = a.report_id LEFT JOIN seconds s ON s.report_id = a.report_id),
      taken AS (SELECT report_id, again, CASE WHEN again AND s.report_id IS NOT NULL THEN s ELSE f END AS r, CASE WHEN f.report_id IS NULL THEN 0 WHEN again THEN 8 ELSE 4 END AS output_tokens FROM tried)
      SELECT report_id, CASE WHEN NOT coalesce(r.is_json, false) THEN 'json_failed' WHEN r.errors <> '' THEN 'schema_failed' WHEN r.raw_text IS NULL AND len(r.flags) > 0 THEN 'vocab_flagged' ELSE 'valid' END AS validation_status,
        CASE WHEN r.is_json AND r.errors = '' AND r.raw_text IS NULL THEN r.primary_site END AS primary_site, CAST(output_tokens AS BIGINT) AS output_tokens FROM taken""",
}
