"""Model replies to validated records: strict JSON, strict types, vocabulary checks.

All in the JVM with variants. The text is parsed with a sentinel behind it, so prose after
the object fails instead of being ignored. NaN and Infinity count as invalid JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marrow.functions.text import let, pylower, pystrip
from marrow.functions.vocab import vocab_flags
from marrow.plans.fields import SCHEMA_VERSION

_SENTINEL = "end-of-reply"
#: Fields that must be text or missing, in the order they are reported, and the two objects.
CHECKED = (
    ("patient", "PatientIdentification"), ("primary_site", None), ("histological_diagnosis", None), ("histological_subtype", None),
    ("tumor_grade", None), ("tnm_stage", "TNMStage"), ("tnm_stage.T", None), ("tnm_stage.N", None), ("tnm_stage.M", None),
    ("tnm_stage.edition", None), ("specimen_type", None), ("extraction_notes", None),
)


def json_part(raw: Column) -> Column:
    """The text that should be one JSON object: inside the first fence, from the first brace on."""
    text = pystrip(raw)
    fenced = F.split(text, "```", -1)
    inner = F.when(F.contains(text, F.lit("```")), F.get(fenced, F.lit(1))).otherwise(text)
    inner = F.when(F.startswith(inner, F.lit("json")), F.substr(inner, F.lit(5))).otherwise(inner)
    at = F.instr(inner, "{")
    return F.when(at > 0, F.substr(inner, at))


def parse_json(raw: Column) -> Column:
    """The object as a variant; NULL if there is none or anything follows it."""
    whole = F.try_parse_json(F.concat(F.lit("["), json_part(raw), F.lit(f',"{_SENTINEL}"]')))
    closed = F.try_variant_get(whole, "$[1]", "string") == _SENTINEL
    item = F.try_variant_get(whole, "$[0]", "variant")
    return F.when(closed & F.try_variant_get(whole, "$[2]", "variant").isNull() & F.startswith(F.schema_of_variant(item), F.lit("OBJECT")), item)


def _kind(data: Column, path: str) -> Column:
    """Variant type at ``path``; NULL where it is absent."""
    return F.schema_of_variant(F.try_variant_get(data, f"$.{path}", "variant"))


def schema_errors(data: Column) -> Column:
    """One line for each field of a wrong type, in schema order."""
    lines = []
    for path, cls in CHECKED:
        kind = _kind(data, path)
        if cls:
            bad = kind.isNotNull() & (kind != "VOID") & ~F.startswith(kind, F.lit("OBJECT"))
            message = f"Input should be a valid dictionary or instance of {cls}"
        else:
            bad = kind.isNotNull() & ~kind.isin("STRING", "VOID")
            message = "Input should be a valid string"
        lines.append(F.when(bad, F.lit(f"- {path}: {message}")))
    return F.filter(F.array(*lines), lambda x: x.isNotNull())


def _text(data: Column, path: str) -> Column:
    return F.try_variant_get(data, f"$.{path}", "string")


def flags_of(data: Column) -> Column:
    """Flags as an array of text, whatever was sent: text is one flag, other values are shown as text."""
    value = F.try_variant_get(data, "$.hallucination_flags", "variant")
    kind = F.schema_of_variant(value)

    def shown(v: Column) -> Column:
        k = F.schema_of_variant(v)
        text = F.try_variant_get(v, "$", "string")
        return F.when(k == "BOOLEAN", F.initcap(text)).when(v.isNull() | (k == "VOID"), F.lit("None")).otherwise(F.coalesce(text, F.to_json(v)))

    items = F.try_variant_get(data, "$.hallucination_flags", "array<variant>")
    return F.when(kind.isNull() | (kind == "VOID"), None).when(F.startswith(kind, F.lit("ARRAY")), F.transform(items, shown)).otherwise(F.array(shown(value)))


def sex_of(c: Column) -> Column:
    low = pylower(pystrip(c))
    return F.when(low.isin("m", "male"), "male").when(low.isin("f", "female"), "female")


def confidence_of(c: Column) -> Column:
    low = pylower(pystrip(c))
    return F.when(low.isin("stated", "inferred"), low)


def _any_text(data: Column, path: str) -> Column:
    """Text of a lenient field; other types are shown as text and then not recognised."""
    return F.when(_kind(data, path) == "STRING", _text(data, path))


def extraction(data: Column) -> list[Column]:
    """Typed columns of a valid object."""
    patient, tnm = _kind(data, "patient"), _kind(data, "tnm_stage")
    return [
        F.when(F.startswith(patient, F.lit("OBJECT")), F.struct(sex_of(_any_text(data, "patient.sex")).alias("sex"))).alias("patient"),
        *[_text(data, f).alias(f) for f in ("primary_site", "histological_diagnosis", "histological_subtype", "tumor_grade")],
        F.when(
            F.startswith(tnm, F.lit("OBJECT")),
            F.struct(*[_text(data, f"tnm_stage.{f}").alias(f) for f in ("T", "N", "M", "edition")], confidence_of(_any_text(data, "tnm_stage.confidence")).alias("confidence")),
        ).alias("tnm_stage"),
        *[_text(data, f).alias(f) for f in ("specimen_type", "extraction_notes")],
        flags_of(data).alias("hallucination_flags"),
    ]


def validate(replies: DataFrame, raw: str = "raw_text") -> DataFrame:
    """``replies`` (report_id, cancer_type, raw text) with the record, ``validation_status`` and ``vocab_flags``.

    A NULL reply is json_failed; a missing report_id or cancer_type is schema_failed.
    Failed records keep their raw text and have no fields; duplicate keys: the last one counts.
    """
    replies.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    keep = [c for c in replies.columns if c != raw]
    data = replies.select(*keep, raw, parse_json(F.col(raw)).alias("_data"))
    sound = F.col("_data").isNotNull() & (F.size(schema_errors(F.col("_data"))) == 0) & F.col("report_id").isNotNull() & F.col("cancer_type").isNotNull()
    data = data.withColumn("_sound", sound)
    typed = data.select(*keep, raw, "_data", "_sound", F.when(F.col("_sound"), F.struct(*extraction(F.col("_data")))).alias("_x")).select("*", "_x.*")
    vocab = F.when(F.col("_sound"), vocab_flags(F.col("tnm_stage.T"), F.col("tnm_stage.N"), F.col("tnm_stage.M"), F.col("tumor_grade")))
    typed = typed.withColumn("vocab_flags", F.coalesce(vocab, F.expr("cast(array() as array<string>)")))
    status = F.when(F.col("_data").isNull(), "json_failed").when(~F.col("_sound"), "schema_failed").when(F.size("vocab_flags") > 0, "vocab_flagged").otherwise("valid")
    merged = F.when(F.size("vocab_flags") > 0, F.concat(F.coalesce("hallucination_flags", F.expr("cast(array() as array<string>)")), F.col("vocab_flags"))).otherwise(F.col("hallucination_flags"))
    return (
        typed.withColumns({"validation_status": status, "hallucination_flags": merged, "schema_version": F.when(F.col("_sound"), F.lit(SCHEMA_VERSION))})
        .withColumn(raw, F.when(~F.col("_sound") | F.col("_data").isNull(), F.col(raw)))
        .drop("_data", "_sound", "_x")
    )


def correction(raw: Column) -> Column:
    """What to tell a model whose reply must be asked for again; NULL if the reply is sound."""
    ask = "Answer with the corrected JSON object alone: it starts with { and ends with }, without markdown."
    return let(
        problems(raw),
        lambda errors: F.when(errors == NO_JSON, F.lit(f"\n\nThe last answer was no valid JSON. {ask}")).when(errors != "", F.concat(F.lit("\n\nThe last answer did not fit the schema:\n"), errors, F.lit(f"\n{ask}"))),
    )


NO_JSON = "no json"


def problems(raw: Column) -> Column:
    """Lines of the type errors of a reply, empty if it is sound, ``NO_JSON`` if it is none; parsed once."""
    return let(parse_json(raw), lambda data: F.when(data.isNull(), NO_JSON).otherwise(F.array_join(schema_errors(data), "\n")))
