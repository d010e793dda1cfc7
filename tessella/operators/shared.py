"""Tables of rounds in the shared folder, and numbering of rows without a single task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Without that setting a folder of this machine serves local mode only; on a cluster other nodes could not read it.
    """
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        place = f"{tempfile.gettempdir()}/tessella-checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(place)
    return place


def passing_place(spark: SparkSession, name: str = "tessella") -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    place = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(conf).deleteOnExit(path)
    return place


def stored(df: DataFrame) -> DataFrame:
    """df, written once as a table in the shared folder and read again.

    Unlike a checkpoint, a table brings none of the constraints and partitionings of the plan that made it, which
    loops would pile up in the driver; and it survives lost executors just as well.
    """
    place = passing_place(df.sparkSession)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def numbered(df: DataFrame, order: list[Column], name: str, start: int = 0) -> DataFrame:
    """df with consecutive numbers in the given order, as a long.

    Rows are dealt into ranges of the order and numbered inside each; the ranges' sizes, one number for each
    partition, are all that the driver sees. The ranges are stored first, so that both passes see the same ones.
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = df.select("*", F.struct(*order).alias("_order"))
    dealt = stored(keyed.repartitionByRange(n, "_order").withColumn("_range", F.spark_partition_id()))
    sizes = {r[0]: r[1] for r in dealt.groupBy("_range").count().collect()}
    before, at = [], start
    for k in sorted(sizes):
        before += [F.lit(k), F.lit(at).cast("long")]
        at += sizes[k]
    offset = F.element_at(F.create_map(*before), F.col("_range")) if before else F.lit(0).cast("long")
    place = F.row_number().over(W.partitionBy("_range").orderBy("_order"))
    return dealt.withColumn(name, (offset + place - 1).cast("long")).drop("_order", "_range")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its source has fewer parts than there are cores; else as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df
