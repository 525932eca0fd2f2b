"""What operators need to know of the session they run in: parallelism and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

from pyspark.errors import PythonException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that readers do not repeat its plan and a lost
    executor costs nothing. The folder is ``spark.checkpoint.dir`` of the session; only a local session that has none gets
    a temporary folder of this machine, anywhere else a missing folder is an error. ``spark.cleaner.referenceTracking.
    cleanCheckpoints`` lets Spark remove what nothing refers to any more."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quire-ckpt-"))
    return df.checkpoint()


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Round-robin a scan that has fewer splits than the cluster has cores before a CPU-heavy stage. A scan of many
    files already has enough splits and is returned as it is: no shuffle at scale."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores * per_core)


_READY: set[str] = set()


def on_workers(spark: SparkSession) -> None:
    """Make the package importable in the Python workers: nothing to do where they find it (installed, or on their path),
    else it is sent to the executors once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _READY:
        return

    def probe(batches: Iterator) -> Iterator:
        import importlib.util

        import pyarrow

        there = importlib.util.find_spec("quire") is not None
        for b in batches:
            yield pyarrow.RecordBatch.from_arrays([pyarrow.array([there] * b.num_rows)], ["there"])

    probe.__module__ = "__main__"  # sent by value: it must run where the package is missing
    try:
        there = spark.range(1).mapInArrow(probe, "there boolean").first()[0]
    except PythonException:  # a worker without what the probe imports gets the package, too
        there = False
    if not there:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="quire-"), "quire.zip")  # on the driver, which serves it
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, files in os.walk(root):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
    _READY.add(sc.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def latest(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """One row per key: that of the greatest ``by`` (null is least), ties by the other columns' values. A
    map-side-combined aggregate, so a key that holds a third of the rows is reduced before the shuffle, and each value is
    carried once: the row is the greatest struct that begins with ``by``. Maps, which have no order, are carried beside it
    and do not take part in the tie-break."""
    rest = [c for c in df.columns if c not in keys]
    kinds = dict(df.dtypes)
    ordered = F.struct(F.col(by), *[F.col(c) for c in rest if c != by and "map<" not in kinds[c]])
    maps = any("map<" in kinds[c] for c in rest)
    picked = df.groupBy(*keys).agg((F.max_by(F.struct(*rest), ordered) if maps else F.max(ordered)).alias("__row"))
    return picked.select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def blocked_lag(df: DataFrame, keys: list[str], order: str, value: Column, out: str, block: int = 4096) -> DataFrame:
    """``lag(value)`` over (keys, order) that no hot key can stall: the integer axis ``order`` is cut into blocks, the
    window runs per (keys, block), and only each block's last value crosses to the next block."""
    df = df.withColumn("__v", value).withColumn("__b", F.floor(F.col(order) / F.lit(block)))
    inner = df.withColumn("__lag", F.lag(F.struct("__v")).over(Window.partitionBy(*keys, "__b").orderBy(order)))
    ends = df.groupBy(*keys, "__b").agg(F.max_by("__v", order).alias("__e"))
    carried = ends.withColumn("__carry", F.lag(F.struct("__e")).over(Window.partitionBy(*keys).orderBy("__b"))).drop("__e")
    carried = carried.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__b").alias("__kb"), "__carry")
    on = F.col("__b") == F.col("__kb")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    joined = inner.join(carried, on, "left").withColumn(out, F.coalesce(F.col("__lag")["__v"], F.col("__carry")["__e"]))
    return joined.drop("__v", "__b", "__lag", "__carry", "__kb", *[f"__k{i}" for i in range(len(keys))])
