"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marrow.llm import canon, encode, langid, leak, ocr, quota, split, stable_sample, token_budget
from marrow.sources.tables import table


def p9_spans(spark: SparkSession, d: str) -> DataFrame:
    return leak.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), "doc_id")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_spans(spark, d).select("doc_id", "item_id")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.relabelled(table(spark, d, "documents"), "doc_id").select("doc_id", "lang")


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    return langid.identify(table(spark, d, "documents"), "doc_id")


#: Wordings of "grade cannot be assessed" that the list lacks.
P1_ALSO = {"TUE-005": ["ungradable", "ungradeable", "not gradable", "not assessable", "grade not assessable", "cannot assess grade"]}
P1_FIELDS = ["primary_site", "histological_subtype", "tumor_grade", "specimen_type"]


def p1_mapped(spark: SparkSession, d: str) -> DataFrame:
    return canon.map_values(table(spark, d, "extractions"), table(spark, d, "canonical_terms"), "extraction_id", P1_FIELDS, P1_ALSO)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_mapped(spark, d).select("extraction_id", "field_name", "term_id")


def p1_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that mean no entry, by how often they occur."""
    missed = p1_mapped(spark, d).where(F.col("term_id") == canon.NONE)
    return missed.groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return split.oversized(table(spark, d, "pilot_corpus"), table(spark, d, "split_specs"), "record_id")


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.split(table(spark, d, "pilot_corpus"), table(spark, d, "split_specs"), "record_id")


def p2_joined(spark: SparkSession, d: str) -> DataFrame:
    """Split texts put together again from their pieces, and whether these keep the limit and the overlap."""
    return split.rejoined(table(spark, d, "pilot_corpus"), table(spark, d, "split_specs"), "record_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return quota.unmet(table(spark, d, "pilot_corpus"), table(spark, d, "sample_targets"))


def p4_sample(spark: SparkSession, d: str) -> DataFrame:
    return quota.sample(table(spark, d, "pilot_corpus"), table(spark, d, "sample_targets"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Every target cell, and whether its drawing kept floors, shares and size."""
    return quota.checked(table(spark, d, "pilot_corpus"), table(spark, d, "sample_targets"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return ocr.find_noise(table(spark, d, "pilot_corpus"), table(spark, d, "labs"))


def p5_repaired(spark: SparkSession, d: str) -> DataFrame:
    return ocr.repair(table(spark, d, "pilot_corpus"), table(spark, d, "labs"))


def p6_reports(spark: SparkSession, d: str) -> DataFrame:
    return token_budget.count_tokens(table(spark, d, "pilot_corpus"), ["record_id"])


def p6_totals(spark: SparkSession, d: str) -> DataFrame:
    return token_budget.totals(table(spark, d, "pilot_corpus"), ["lab_code", "lang", "cancer_type", "style"])


def p7_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = stable_sample.select(table(spark, d, "pilot_corpus").select("record_id", "report_id", "load_no"), "report_id", "load_no")
    return rows.select("record_id", "report_id", "load_no")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "ids")


QUERIES = {"p1_found": p1_found, "p1_unmatched": p1_unmatched, "p2_found": p2_found, "p2_pieces": p2_pieces, "p2_joined": p2_joined, "p4_found": p4_found, "p4_sample": p4_sample, "p4_report": p4_report, "p5_found": p5_found, "p5_repaired": p5_repaired, "p6_reports": p6_reports, "p6_totals": p6_totals, "p7_sample": p7_sample, "p8_ids": p8_ids, "p9_found": p9_found, "p9_spans": p9_spans, "p10_found": p10_found, "p10_segments": p10_segments}
