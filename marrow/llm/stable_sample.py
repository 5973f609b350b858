"""Reproducible sample that only grows as data grows.

Each identifier keeps the epoch (load) in which it was first seen and the rate that was in
force for that epoch then; both are persisted as state and never change. It is selected
when a counter-based generator (Threefry-2x32, 20 rounds) keyed by the identifier falls
below its rate. Nothing depends on row order or partitioning, and members stay members when
loads are added, rates change, or rows of an older load come in late.

State is a folder of parquet parts, one per ``advance``. A part counts once it is complete,
so an advance that fails midway leaves nothing behind and can be repeated; a repeated
advance over the same rows adds no identifier.

Defined cases: a null identifier is never selected; rows with a null epoch count as
unseen, so their identifier takes its other rows' epoch and, if there is none, is not
selected; an empty table gives no rows; repeated rows share their identifier's fate; other
columns pass through, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marrow.session import shared_folder

#: Rate in force by epoch; epochs from the last entry on use its rate.
DEFAULT_RATES = {0: 0.20, 4: 0.15, 10: 0.10}
#: Fixed values of the generator: rotations, key parity, and rounds between two additions of the key.
ROTATIONS, PARITY, GROUP, ROUNDS = (13, 15, 26, 6, 17, 29, 16, 24), 0x1BD11BDA, 4, 20
_WORD = 0xFFFFFFFF
STATE = "key string, first_epoch long, rate double"


def threefry(k0: Column, k1: Column, c0: int, c1: int) -> Column:
    """struct(x0, x1): the two 32-bit words for a key and a counter, in 64-bit integers."""
    keys = [k0, k1, F.lit(PARITY).bitwiseXOR(k0).bitwiseXOR(k1)]
    steps = []
    for r in range(ROUNDS):
        s = (r + 1) // GROUP
        added = (keys[s % 3], keys[(s + 1) % 3] + s) if (r + 1) % GROUP == 0 else (F.lit(0), F.lit(0))
        turn = ROTATIONS[r % len(ROTATIONS)]
        steps.append(F.struct(F.lit(1 << turn).cast("bigint").alias("up"), F.lit(1 << 32 - turn).cast("bigint").alias("down"), added[0].cast("bigint").alias("a0"), added[1].cast("bigint").alias("a1")))
    word = lambda c: c.bitwiseAND(F.lit(_WORD))

    def turn_and_mix(x: Column, step: Column) -> Column:
        a = word(x["x0"] + x["x1"])
        # shifts as products and quotients, so that the distance may be a column
        b = word(x["x1"] * step["up"]).bitwiseOR(F.floor(x["x1"] / step["down"])).bitwiseXOR(a)
        return F.struct(word(a + step["a0"]).alias("x0"), word(b + step["a1"]).alias("x1"))

    start = F.struct(word(F.lit(c0).cast("bigint") + k0).alias("x0"), word(F.lit(c1).cast("bigint") + k1).alias("x1"))
    return F.aggregate(F.array(*steps), start, turn_and_mix)


def uniform(key: Column, seed: str, counter: int = 0) -> Column:
    """Draw ``counter`` of the stream of ``key``, in [0, 1): 52 bits."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), key).cast("binary"))
    k0, k1 = (F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint") for at in (1, 9))
    x = threefry(k0, k1, counter, 0)
    return (x["x0"] * F.lit(1 << 20) + F.floor(x["x1"] / F.lit(1 << 12))) / F.lit(float(1 << 52))


def rate_of(epoch: Column, rates: dict[int, float]) -> Column:
    out = F.lit(0.0)
    for start in sorted(rates):
        out = F.when(epoch >= start, F.lit(float(rates[start]))).otherwise(out)
    return out


def first_seen(df: DataFrame, key: str, epoch: str, rates: dict[int, float] | None = None) -> DataFrame:
    """(key, first_epoch, rate) of every identifier, as of these rows alone; map-side minima, one shuffle."""
    rates = DEFAULT_RATES if rates is None else rates
    return (
        df.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{epoch}`").isNotNull())
        .groupBy(F.col(f"`{key}`").cast("string").alias("key"))
        .agg(F.min(F.col(f"`{epoch}`").cast("long")).alias("first_epoch"))
        .withColumn("rate", rate_of(F.col("first_epoch"), rates))
    )


def _parts(spark: SparkSession, path: str) -> list[str]:
    """Complete parts of the state below ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = [str(x.getPath()) for x in fs.listStatus(folder)]
    return sorted(p for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{p}/_SUCCESS")))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """State below ``path``; empty if nothing was written yet."""
    parts = _parts(spark, path)
    return spark.read.schema(STATE).parquet(*parts) if parts else spark.createDataFrame([], STATE)


def advance(df: DataFrame, key: str, epoch: str, path: str, rates: dict[int, float] | None = None) -> DataFrame:
    """Persist the identifiers of ``df`` that the state below ``path`` lacks; the whole state, read back.

    Identifiers that the state holds keep their epoch and rate. New ones of an epoch that it
    holds, such as rows of an older load that come in late, get that epoch's frozen rate.
    """
    spark = df.sparkSession
    known = read_state(spark, path)
    frozen = known.groupBy("first_epoch").agg(F.min("rate").alias("_frozen"))
    new = first_seen(df, key, epoch, rates).join(known.select("key"), "key", "left_anti").join(frozen, "first_epoch", "left")
    part = f"{path}/{len(_parts(spark, path)):08d}"
    new.select("key", "first_epoch", F.coalesce("_frozen", "rate").alias("rate")).write.mode("overwrite").parquet(part)
    return read_state(spark, path)


def select(df: DataFrame, key: str, epoch: str, seed: str = "stable", rates: dict[int, float] | None = None, path: str | None = None) -> DataFrame:
    """Rows of selected identifiers, all rows of an identifier alike.

    ``path`` is the state's folder, which is advanced by these rows first; without one a new
    state is written to the shared folder. Identifiers are aggregated map-side, and the
    selected ones are joined back as a semi join, which adaptive execution splits where one
    identifier holds many rows.
    """
    path = path or f"{shared_folder(df.sparkSession)}/stable-sample-{uuid.uuid4().hex}"
    state = advance(df, key, epoch, path, rates)
    chosen = state.where(uniform(F.col("key"), seed) < F.col("rate")).select(F.col("key").alias("_chosen"))
    return df.join(chosen, F.col(f"`{key}`").cast("string") == F.col("_chosen"), "left_semi")
