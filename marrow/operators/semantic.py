"""Similarity of free-text fields: rules first, embeddings for what they leave open.

The rules are one CASE expression; only pairs they leave open go on, and only their
distinct strings are embedded, so a costly embedder sees each string once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from marrow.functions.grades import grade_steps, laterality, parse_grade
from marrow.functions.text import let
from marrow.functions.vectors import cosine
from marrow.operators.scoring import ratio, weight_of
from marrow.plans.fields import CONCEPT_FIELDS, SEMANTIC_FIELDS

#: Wordings of "no special type", which are one meaning.
UNSPECIFIED = ("nst", "nos", "no special type", "not otherwise specified", "nos (no special type)", "nos (not otherwise specified)")


class Embedder(Protocol):
    def table(self, strings: DataFrame) -> DataFrame:
        """(value, vector) of the distinct strings in column ``value``."""


class NgramEmbedder:
    """Offline default: hashed character trigrams. No substitute for a trained model."""

    def __init__(self, size: int = 128):
        self.size = size

    def table(self, strings: DataFrame) -> DataFrame:
        size = self.size

        @F.pandas_udf(T.ArrayType(T.FloatType()))
        def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            import zlib

            for batch in batches:
                out = []
                for s in batch:
                    v = np.zeros(size, np.float32)
                    padded = f"  {s} "
                    for i in range(len(padded) - 2):
                        v[zlib.crc32(padded[i : i + 3].encode()) % size] += 1
                    out.append(v)
                yield pd.Series(out)

        return strings.select("value", embed("value").alias("vector"))


_MODELS: dict[str, Callable[[list[str]], np.ndarray]] = {}


def onnx_model(path: str) -> Callable[[list[str]], np.ndarray]:
    """Embeds texts by an ONNX model that takes strings and gives one vector each (tokenizer inside the graph)."""
    import onnxruntime

    session = onnxruntime.InferenceSession(path, providers=["CPUExecutionProvider"])
    feed = session.get_inputs()[0].name
    return lambda texts: session.run(None, {feed: np.array(texts, dtype=object)})[0]


class ModelEmbedder:
    """Vectors of a trained model that lies at ``path``, which every worker can read.

    ``load`` makes the model from the path, once per Python worker; ``batch`` strings are
    embedded at a time.
    """

    def __init__(self, path: str, load: Callable[[str], Callable[[list[str]], np.ndarray]] = onnx_model, batch: int = 64):
        self.path, self.load, self.batch = path, load, batch

    def table(self, strings: DataFrame) -> DataFrame:
        path, load, size = self.path, self.load, self.batch

        @F.pandas_udf(T.ArrayType(T.FloatType()))
        def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = _MODELS.get(path) or _MODELS.setdefault(path, load(path))
            for batch in batches:
                texts, out = batch.tolist(), []
                for at in range(0, len(texts), size):
                    out += [np.asarray(v, np.float32) for v in model(texts[at : at + size])]
                yield pd.Series(out, dtype=object)

        return strings.select("value", embed("value").alias("vector"))


class LookupEmbedder:
    """Vectors from a table, by a key expression over the string."""

    def __init__(self, vectors: DataFrame, id_column: str, vector_column: str, key: Column):
        self.vectors, self.key = vectors.select(F.col(id_column).alias("_id"), F.col(vector_column).alias("vector")), key

    def table(self, strings: DataFrame) -> DataFrame:
        return strings.withColumn("_id", self.key).join(self.vectors, "_id", "left").select("value", "vector")


def rule_score(pred: Column, gold: Column, field: Column) -> Column:
    """Score of normalised values where a rule decides, -1.0 where embeddings must, NULL where a side is missing."""
    unify = lambda c: F.when((field == "histological_subtype") & c.isin(*UNSPECIFIED), F.lit("nst")).otherwise(c)
    facts = F.struct(unify(pred).alias("p"), unify(gold).alias("g"), parse_grade(pred).alias("gp"), parse_grade(gold).alias("gg"), laterality(pred).alias("sp"), laterality(gold).alias("sg"), field.alias("field"))
    return let(facts, _rule)


def _rule(x: Column) -> Column:
    p, g, gp, gg = x["p"], x["g"], x["gp"], x["gg"]
    grade = F.when(gp.isNull() | gg.isNull(), 0.0).when(gp == gg, 1.0).when(F.arrays_overlap(grade_steps(gp), grade_steps(gg)), 0.5).otherwise(0.0)
    return (
        F.when(p.isNull() | g.isNull(), None)
        .when(p == g, 1.0)
        .when(x["field"] == "tumor_grade", grade)
        .when((x["field"] == "primary_site") & (x["sp"] != x["sg"]), 0.0)
        .when(~x["field"].isin(*CONCEPT_FIELDS), 0.0)
        .otherwise(-1.0)
    )


def score_pairs(pairs: DataFrame, embedder: Embedder) -> DataFrame:
    """``pairs`` (field, pred, gold, ...) of the semantic fields with ``similarity``."""
    scored = pairs.where(F.col("field").isin(*SEMANTIC_FIELDS)).withColumn("rule", rule_score(F.col("pred"), F.col("gold"), F.col("field")))
    left = scored.where("rule = -1.0")
    strings = left.select(F.explode(F.array("pred", "gold")).alias("value")).distinct()
    vectors = embedder.table(strings)
    open_pairs = left.select("pred", "gold").distinct()
    known = (
        open_pairs.join(vectors.select(F.col("value").alias("pred"), F.col("vector").alias("_p")), "pred", "left")
        .join(vectors.select(F.col("value").alias("gold"), F.col("vector").alias("_g")), "gold", "left")
        .select("pred", "gold", F.coalesce(cosine(F.col("_p"), F.col("_g")), F.lit(0.0)).alias("_cosine"))
    )
    return scored.join(known, ["pred", "gold"], "left").withColumn("similarity", F.when(F.col("rule") == -1.0, F.col("_cosine")).otherwise(F.col("rule"))).drop("rule", "_cosine")


def semantic_metrics(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per field: mean over scored pairs, mean with missing values counted, and the four parts.

    In the complete mean a value missing on both sides is 1, on one side 0.
    """
    p, g, s = F.col("pred"), F.col("gold"), F.col("similarity")
    n = F.col("n") if "n" in scored.columns else F.lit(1)
    whole = F.when(p.isNull() & g.isNull(), 1.0).when(p.isNull() | g.isNull(), 0.0).otherwise(s)
    count = lambda which: F.sum(F.when(which, n).otherwise(0)).cast("bigint")
    return scored.groupBy(*(by or []), "field").agg(
        ratio(F.sum(s * n), count(s.isNotNull())).alias("mean_similarity"),
        ratio(F.sum(whole * n), count(whole.isNotNull())).alias("mean_similarity_complete"),
        count(s.isNotNull()).alias("n_scored_pairs"),
        count(p.isNull() & g.isNull()).alias("n_both_null"),
        count(p.isNull() & g.isNotNull()).alias("n_omission"),
        count(p.isNotNull() & g.isNull()).alias("n_hallucination"),
    )


def combined_score(fields: DataFrame, semantics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Weighted mean of the complete similarity of free-text fields and the F1 of the others."""
    by = by or []
    both = fields.select(*by, "field", "f1").join(semantics.select(*by, "field", "mean_similarity_complete"), [*by, "field"], "left")
    value = F.when(F.col("field").isin(*SEMANTIC_FIELDS), F.coalesce("mean_similarity_complete", F.lit(0.0))).otherwise(F.col("f1"))
    w = weight_of(F.col("field"))
    return both.groupBy(*by).agg(ratio(F.sum(w * value), F.sum(w)).alias("combined_score"))


def mean_of_scored(semantics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean similarity over the fields that have scored pairs at all."""
    return semantics.where("n_scored_pairs > 0").groupBy(*(by or [])).agg(F.avg("mean_similarity").alias("mean_similarity"))
