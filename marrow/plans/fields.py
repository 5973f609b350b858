"""Scored fields, their weights and the result schema; fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = "v1.3"
#: Weight of each scored field in the weighted scores.
WEIGHTS = {
    "primary_site": 1,
    "specimen_type": 1,
    "histological_diagnosis": 2,
    "histological_subtype": 2,
    "tumor_grade": 2,
    "tnm_stage.T": 3,
    "tnm_stage.N": 3,
    "tnm_stage.M": 1,
}
FIELDS = tuple(WEIGHTS)
#: Free-text fields that are scored by meaning.
SEMANTIC_FIELDS = ("primary_site", "histological_diagnosis", "histological_subtype", "tumor_grade", "specimen_type")
#: Those of them that are compared by embedding.
CONCEPT_FIELDS = tuple(f for f in SEMANTIC_FIELDS if f != "tumor_grade")
PASSED = ("valid", "vocab_flagged")

TNM = T.StructType([T.StructField(n, T.StringType()) for n in ("T", "N", "M", "edition", "confidence")])
PATIENT = T.StructType([T.StructField("sex", T.StringType())])
#: What a model reply holds.
EXTRACTION = T.StructType(
    [
        T.StructField("patient", PATIENT),
        T.StructField("primary_site", T.StringType()),
        T.StructField("histological_diagnosis", T.StringType()),
        T.StructField("histological_subtype", T.StringType()),
        T.StructField("tumor_grade", T.StringType()),
        T.StructField("tnm_stage", TNM),
        T.StructField("specimen_type", T.StringType()),
        T.StructField("extraction_notes", T.StringType()),
        T.StructField("hallucination_flags", T.ArrayType(T.StringType())),
    ]
)
#: One output record, success or failure.
RESULT = T.StructType(
    EXTRACTION.fields
    + [T.StructField(n, T.StringType()) for n in ("schema_version", "report_id", "cancer_type", "model", "prompt_version", "few_shot_path")]
    + [
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("input_tokens", T.LongType()),
        T.StructField("output_tokens", T.LongType()),
        T.StructField("validation_status", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("truncated", T.BooleanType()),
        T.StructField("raw_text", T.StringType()),
    ]
)
#: A corpus record.
CORPUS = T.StructType([T.StructField(n, T.StringType()) for n in ("report_id", "cancer_type", "style", "text")])


def column_of(field: str) -> str:
    """A dotted field as a column name."""
    return field.replace(".", "_")
