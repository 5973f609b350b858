"""Sample whose shares of each category match given targets, with floors.

Reports (distinct keys) are ordered at random within sorted cells; a report's inclusion
probability in a request is its cell's allocation over its cell's size. Probabilities are
prefix-summed over the whole order and a report is taken where the running sum passes an
integer counted from one random start per request (systematic unequal-probability
sampling). Cells that end below their floor are then repaired from the same order.

The order is made without gathering a cell anywhere: a report falls into one of
``BUCKETS`` buckets by its keyed digest, only (cell, bucket) counts are prefix-summed, and
ranks are counted inside a bucket. The ranked reports are kept once (``cut``); cell sizes,
draws, repairs and the report on the cells are read off them. Cell counts and targets are
small tables by their meaning and are checked (``MAX_CELLS``); nothing per report reaches
the driver.

Defined cases: labels are compared stripped and without case; a null or blank style is
'unknown'; a null or blank cancer type and a null key fit no cell; a key delivered
several times counts once, with the labels of its first row; style 'any' is all styles
together; a cell without reports is reported, not an error; an empty table yields a
report with nothing available and an empty sample.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from marrow.functions.text import pystrip
from marrow.operators.bounded import collect_bounded
from marrow.session import cut

MAX_CELLS = 100_000
BUCKETS = 4096
ANY = "any"


def _label(c: Column) -> Column:
    plain = F.lower(pystrip(c))
    return F.when(plain != "", plain)


def _draw(*parts: Column) -> Column:
    """Uniform in [0, 1) from a keyed digest."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def units(df: DataFrame, key: str, group: str, style: str, order: str) -> DataFrame:
    """One row per key with its compared labels, those of the row that is first by ``order``."""
    first = F.struct(F.col(f"`{order}`").alias("o"), _label(F.col(f"`{group}`")).alias("g"), F.coalesce(_label(F.col(f"`{style}`")), F.lit("unknown")).alias("s"))
    return (
        df.where(F.col(f"`{key}`").isNotNull())
        .groupBy(F.col(f"`{key}`").alias("key"))
        .agg(F.min(first).alias("f"))
        .select("key", F.col("f.g").alias("g"), F.col("f.s").alias("s"))
        .where("g is not null")
    )


def allocate(cells: list[dict]) -> list[float]:
    """Expected rows per cell of one request: its share, lifted to its floor, within what there is.

    What floors add is taken from the cells above their floor, in proportion to their room,
    so the size stays the asked one wherever the cells can give it.
    """
    size = cells[0]["sample_size"]
    floor = [min(c["min_rows"] or 0, c["available"]) for c in cells]
    want = [min(max((c["target_share"] or 0.0) * size, f), c["available"]) for c, f in zip(cells, floor, strict=True)]
    for _ in range(100):
        gap = size - sum(want)
        if abs(gap) < 1e-9:
            break
        room = [c["available"] - w if gap > 0 else w - f for c, w, f in zip(cells, want, floor, strict=True)]
        weigh = [r * (c["target_share"] or 0.0) if gap > 0 else r for r, c in zip(room, cells, strict=True)]
        if sum(weigh) <= 1e-12:
            break
        scale = gap / sum(weigh)
        want = [w + math.copysign(min(abs(scale) * x, r), gap) for w, x, r in zip(want, weigh, room, strict=True)]
    return want


def _ranked(df: DataFrame, cells: DataFrame, key: str, group: str, style: str, order: str, seed: str) -> DataFrame:
    """(key, g, s, rank): place of each report in the random order of its cell, and in that of all styles.

    Only cells that ``cells`` (g, s) asks for are kept.
    """
    found = units(df, key, group, style, order)
    placed = found.withColumn("s", F.explode(F.array(F.col("s"), F.lit(ANY)))).join(F.broadcast(cells), ["g", "s"], "left_semi")
    placed = placed.withColumn("draw", _draw(F.lit(seed), F.col("key"))).withColumn("bucket", F.floor(F.col("draw") * BUCKETS).cast("int"))
    in_bucket = W.partitionBy("g", "s", "bucket")
    ranked = placed.withColumn("rank", F.row_number().over(in_bucket.orderBy("draw", "key"))).drop("draw")
    counts = placed.groupBy("g", "s", "bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.withColumn("offset", F.sum("n").over(W.partitionBy("g", "s").orderBy("bucket")) - F.col("n")).drop("n")
    return cut(ranked.join(offsets, ["g", "s", "bucket"]).select("key", "g", "s", (F.col("rank") + F.col("offset")).alias("rank")))


class Sampled:
    """One drawing for all requests of ``targets``."""

    def __init__(self, df: DataFrame, targets: DataFrame, key: str = "report_id", group: str = "cancer_type", style: str = "style", order: str = "record_id", seed: str = "quota"):
        self.key = key
        cells = collect_bounded(targets.select("request_id", "cancer_type", "style", "sample_size", "target_share", "min_rows", _label(F.col("cancer_type")).alias("g"), F.coalesce(_label(F.col("style")), F.lit("unknown")).alias("s")), MAX_CELLS, "the table of targets")
        spark = df.sparkSession
        wanted = spark.createDataFrame(sorted({(r["g"], r["s"]) for r in cells if r["g"] is not None}), "g string, s string")
        ranked = _ranked(df, wanted, key, group, style, order, seed)
        sizes = {(r["g"], r["s"]): r["n"] for r in ranked.groupBy("g", "s").agg(F.max("rank").alias("n")).collect()}  # one row per wanted cell at most
        requests: dict[int, list[dict]] = {}
        for r in sorted((r.asDict() for r in cells), key=lambda r: (r["request_id"], r["g"] or "", r["s"])):
            requests.setdefault(r["request_id"], []).append(r | {"available": sizes.get((r["g"], r["s"]), 0)})
        plan = []
        for request, asked in requests.items():
            before = 0.0
            for c, take in zip(asked, allocate(asked), strict=True):
                pi = take / c["available"] if c["available"] else 0.0
                needed = max(float(c["min_rows"] or 0), (c["target_share"] or 0.0) * (c["sample_size"] or 0))
                plan.append((request, c["g"], c["s"], c["cancer_type"], c["style"], before, pi, int(min(c["min_rows"] or 0, c["available"])), int(c["available"]), needed, float(take), c["sample_size"]))
                before += take
        schema = "request_id int, g string, s string, cancer_type string, style string, before double, pi double, floor bigint, available bigint, needed double, allocated double, sample_size bigint"
        self.planned = spark.createDataFrame(plan, schema)
        start = _draw(F.lit(seed), F.lit("start"), F.col("request_id").cast("string"))
        upto = F.col("before") + F.col("rank") * F.col("pi") + start
        # 1e-9 keeps a cell taken whole (pi = 1) from losing a member to rounding
        taken = (F.col("pi") > 0) & (F.floor(upto + 1e-9) > F.floor(upto - F.col("pi") + 1e-9))
        marked = ranked.join(F.broadcast(self.planned), ["g", "s"]).withColumn("taken", taken)
        # floors: the expected number is at least the floor, so a cell can lack one member by rounding at most
        got = marked.where("taken").groupBy("request_id", "g", "s").agg(F.count(F.lit(1)).alias("got"))
        lacking = self.planned.join(got, ["request_id", "g", "s"], "left").select("request_id", "g", "s", F.greatest(F.col("floor") - F.coalesce("got", F.lit(0)), F.lit(0)).alias("lack"))
        repaired = marked.join(F.broadcast(lacking.where("lack > 0")), ["request_id", "g", "s"]).where("not taken and rank <= lack + floor")
        spare = repaired.withColumn("nth", F.row_number().over(W.partitionBy("request_id", "g", "s").orderBy("rank"))).where("nth <= lack")
        out = ["request_id", F.col("key").alias(key), "cancer_type", "style"]
        #: (request_id, key, cancer_type, style) of the sampled reports of every request.
        self.rows = marked.where("taken").select(*out).unionByName(spare.select(*out))

    def outcome(self) -> DataFrame:
        """Each target cell as the drawing met it: what there is, what is needed and missing, and what was drawn."""
        cell = ["request_id", "cancer_type", "style"]
        drawn = self.rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("drawn"), F.count_distinct(self.key).alias("n_keys"))
        return self.planned.join(drawn, cell, "left").select(
            *cell,
            "available",
            "needed",
            F.greatest(F.ceil(F.col("needed") - 1e-9) - F.col("available"), F.lit(0)).cast("bigint").alias("short"),
            "floor",
            "allocated",
            "sample_size",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("drawn", "n_keys")],
        )


def sample(df: DataFrame, targets: DataFrame, **names: str) -> DataFrame:
    """(request_id, key, cancer_type, style) of the sampled reports of every request."""
    return Sampled(df, targets, **names).rows


def unmet(df: DataFrame, targets: DataFrame, **names: str) -> DataFrame:
    """(request_id, cancer_type, style) of cells that the drawing took whole and that still have fewer keys than they need."""
    return Sampled(df, targets, **names).outcome().where("short > 0 and drawn = available").select("request_id", "cancer_type", "style")


def checked(df: DataFrame, targets: DataFrame, **names: str) -> DataFrame:
    """``outcome`` with what must hold of every drawing: floors, shares within one, size within one, no repeats.

    A request's size is met if its cells can give it: they are allocated ``sample_size`` in all.
    """
    request = W.partitionBy("request_id")
    return (
        Sampled(df, targets, **names)
        .outcome()
        .withColumn("floor_met", F.col("drawn") >= F.col("floor"))
        .withColumn("share_met", F.abs(F.col("drawn") - F.col("allocated")) < 1 + 1e-6)
        .withColumn("size_met", F.abs(F.sum("drawn").over(request) - F.sum("allocated").over(request)) < 1 + 1e-6)
        .withColumn("no_repeats", F.col("drawn") == F.col("n_keys"))
        .select("request_id", "cancer_type", "style", "available", "needed", "short", "floor_met", "share_met", "size_met", "no_repeats")
    )
