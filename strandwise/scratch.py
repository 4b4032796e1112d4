"""Tables that an operator writes once and reads again, in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Folder of each application, so that it is made, and marked for deletion at the application's end, once.
_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a local session (a test) gets a temporary folder; a cluster has to set it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="strandwise-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _folder(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/strandwise-{app}")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _FOLDERS[app] = path.toString()
    return _FOLDERS[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it goes when the application ends."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage, and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``written``, and the number of its rows, counted while it was written."""
    seen = Observation()
    out = written(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, int(seen.get["n"])


def ranged(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """df dealt by ranges of keys and written, with the number of its range as column ``part``: ranges follow one another."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id()), name)


def numbered(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """df with its 0-based place in the order of keys as long column ``out``; gapless, keys must tell rows apart.

    Rows are dealt by ranges of the keys and each range is numbered after those before it: no row passes through a single task.
    """
    dealt = ranged(df, keys, "numbered")
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # One row a range: the only window over all of them.
    starts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(*keys)) - 1
    return dealt.withColumn(out, own).join(starts, "part").withColumn(out, (F.col("start") + F.col(out)).cast("long")).drop("start", "part")


def dropped(df: DataFrame) -> None:
    """Delete the files behind a frame that ``written`` gave, once no later frame reads them."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
