"""Session, table loading and lineage cuts shared by every operator."""

from __future__ import annotations

import atexit
import functools
import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.text import BLANK as WS
from .functions.text import squeeze, strip

__all__ = ["WS", "arrow_schema", "cut", "folder", "keep", "ranked", "scratch", "session", "spread", "squeeze", "strip", "table"]


def session(cores: int = 8, partitions: int = 8) -> SparkSession:
    """A local session for tests and bench; a cluster passes its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, where the files are too few for them; else as they are read.

    A table of one small file is one task, however dear the work on its rows.
    Inputs of at least as many splits as cores, as at scale, are left alone.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def folder(spark: SparkSession) -> str:
    """The shared folder of checkpoints and kept tables, named by the session in
    spark.checkpoint.dir. A local session without one gets a temporary folder; a
    cluster without one raises, as no folder of one machine serves all."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        named = os.path.join(tempfile.gettempdir(), "folioloom-checkpoints")
    return named


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(folder(df.sparkSession))
    return df.checkpoint(eager=True)


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    """``df`` with each row's place from 1 in its group. ``order`` should be total.

    A group that holds much of the rows is ranked by many tasks: rows are range-
    partitioned by (group, order), ranked within their partition, and the
    group's rows in the partitions before, one number a partition, are added.
    """
    keys = [f"_o{i}" for i in range(len(order))]
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = cut(df.withColumns(dict(zip(keys, cols))).repartitionByRange(*group, *keys).withColumn("_p", F.spark_partition_id()))
    before = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*group, "_p").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    on = [*group, "_p"]
    sizes = sizes.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(on)], "_before")
    here = F.row_number().over(Window.partitionBy(*group, "_p").orderBy(*keys))
    match = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(on)])
    return placed.withColumn("_here", here).join(sizes, match, "left").select(*df.columns, (F.col("_here") + F.col("_before")).alias(name))


_KEPT: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder, removed when the program ends."""
    if not _KEPT:
        atexit.register(_sweep)
    path = f"{folder(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
    _KEPT.append((spark, path))
    return path


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` as a compressed table in the shared checkpoint folder and read it
    back: for wide rows that are read again by columns. Removed when the program ends."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _sweep() -> None:
    while _KEPT:
        spark, path = _KEPT.pop()
        try:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session has ended before; its folder is the cluster's to clean
            return


def arrow_schema(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
