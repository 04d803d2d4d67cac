"""Reading the input tables and the small helpers that every plan shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latest(df: DataFrame, keys: list[str], order: str = "updated_at") -> DataFrame:
    """The row of each key with the latest ``order`` (null is earliest).

    Rows that tie are copies of each other, so either may stay. A null key is a
    key of its own. One shuffle on the keys; a key holds only its own copies.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last()))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session in ``spark.checkpoint.dir``.

    Only where the session names none and runs on this machine alone (tests), a
    temporary folder is made and set. On a cluster a session without one fails:
    a folder of one machine would not be seen by the others.
    """
    context = spark.sparkContext
    have = context.getCheckpointDir()
    if have:
        return have
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cernido-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: the rows are written to the shared folder, so a
    lost executor costs nothing and later rounds don't replan earlier ones."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table in the shared folder. It is deleted when
    the session's JVM ends, unless ``drop_scratch`` did it before."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def drop_scratch(spark: SparkSession) -> int:
    """Deletes all written tables of this process; frames that read them, results
    of queries included, can't be used afterwards. Returns their number."""
    n = len(_SCRATCH)
    while _SCRATCH:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return n


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blank_to_null(c: Column) -> Column:
    """The value without surrounding white space; null where nothing is left."""
    return F.nullif(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""), F.lit(""))


def hashed(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` hashed on the keys into a fixed number of partitions, at least two
    a core. Joins and windows on these keys need no other shuffle, and the
    partitions aren't merged by their size: for work that costs far more than
    the size of its rows tells."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


def spread(df: DataFrame) -> DataFrame:
    """A scan over all cores, where it gives fewer partitions than there
    are cores. For work that costs far more than moving its rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def bounded_broadcast(df: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """A broadcast hint, given only once the rows are counted to be at most
    ``max_rows``; a larger side is left to the optimizer."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
