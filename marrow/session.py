"""Session helpers: settings the queries rely on, and how lineage is cut."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """A session for tests and bench runs on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("marrow")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of reliable checkpoints, which all executors can read and write.

    The cluster names it in ``spark.checkpoint.dir``. Where that setting is missing, a local
    session uses a folder of its machine; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="marrow-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def once[V, T](shared: Broadcast[V], make: Callable[[V], T]) -> T:
    """``make`` of a broadcast value, made once per Python worker and kept with the broadcast.

    A worker runs one task after the other, so what is made may keep a bounded memory of its own.
    """
    made = getattr(shared, "_made", None)
    if made is None:
        made = shared._made = make(shared.value)
    return made


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where a small input lies in fewer partitions than there are cores.

    Only for scans ahead of work that is heavy per row. A small input's rows, whole texts
    included, are shuffled once for that; a large input has many partitions and stays as it
    is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
