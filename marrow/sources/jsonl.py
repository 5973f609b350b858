"""JSON lines in and out."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marrow.plans.fields import CORPUS


def load_records(spark: SparkSession, path: str, schema: T.StructType = CORPUS) -> DataFrame:
    """Records of a JSON lines file: blank lines skipped, a bad line or a missing file is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def load_results(spark: SparkSession, path: str) -> DataFrame:
    """(report_id, line) of output written before, in file order; bad lines are skipped."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    lines = spark.read.text(path).withColumn("_seq", F.monotonically_increasing_id())
    rid = F.try_variant_get(F.try_parse_json("value"), "$.report_id", "string")
    return lines.select(rid.alias("report_id"), F.col("value").alias("line"), "_seq").where("report_id is not null")


def build_output(records: DataFrame, meta: dict[str, object]) -> DataFrame:
    """``records`` with run columns; a name on both sides is an error."""
    both = sorted(set(records.columns) & set(meta))
    if both:
        raise ValueError(f"column names collide: {both}")
    return records.withColumns({k: F.lit(v) for k, v in meta.items()})


def write_results(records: DataFrame, path: str) -> None:
    """Append records as JSON lines, nulls included; the parent folder must exist."""
    if "://" not in path and not Path(path).parent.is_dir():
        raise FileNotFoundError(Path(path).parent)
    records.write.mode("append").option("ignoreNullFields", "false").json(path)


def rewrite_deduplicated(spark: SparkSession, path: str) -> int:
    """Keep the first line of each report of output written before; the number of reports.

    The lines that stay are written beside the output first, which is then replaced by two
    renames, so an interrupted rewrite loses nothing: the old output stays as ``path``.old
    until the new one stands in its place.
    """
    from marrow.operators.extract import deduplicated

    first = deduplicated(load_results(spark, path)).select("line")
    new, old = f"{path.rstrip('/')}.new", f"{path.rstrip('/')}.old"
    first.write.mode("overwrite").text(new)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(hadoop.Path(old), True)
    if not (fs.rename(hadoop.Path(path), hadoop.Path(old)) and fs.rename(hadoop.Path(new), hadoop.Path(path))):
        raise OSError(f"cannot replace {path}; its lines are in {old} or {new}")
    fs.delete(hadoop.Path(old), True)
    return spark.read.text(path).count()


def write_summary(stats: dict[str, object], path: str) -> None:
    Path(path).write_text(json.dumps(stats, indent=2, default=str), encoding="utf-8")
