"""Counts that follow newly landed files, and stage tables that are written once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def incremental_counts(spark: SparkSession, path: str, schema, keys: list[str], measures: dict[str, Column], out: str, checkpoint: str) -> DataFrame:
    """Sums of measures by keys over all files that have landed at path so far.

    Each call reads only files that the checkpoint has not seen. A batch writes its own partial sums, overwriting what a
    lost attempt left, so that every file counts once; the result adds up the batches. Measures must be additive.
    """
    def put(batch: DataFrame, number: int) -> None:
        batch.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in measures.items()]).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(path)
    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in measures])


#: The state store of streams whose state grows with the data: on disk, not in the executors' memory.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATE = "late"


def _follow(spark: SparkSession, frame: DataFrame, put, checkpoint: str) -> None:
    """Run a stream over what has landed since its checkpoint, with its state on disk."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKS)
    try:
        frame.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before)


def landed_funnel(spark: SparkSession, path: str, out: str, checkpoint: str, late: str = "INTERVAL 0 DAY") -> DataFrame:
    """stage, reads, genes: distinct ids over all Parquet files (stage, read_id, gene_id, ts) that have landed at path so far.

    Each call reads only files that the checkpoint has not seen. Ids that any earlier file has shown are known from the
    stream's state; a batch writes how many are new, overwriting what a lost attempt left, and the result adds the batches
    up. Rows that are older than ``late`` before the newest row of the calls before count in a stage of their own, LATE.
    Null ids count nowhere, null times are never late, a null stage is the stage ''; no files give no rows.
    """
    stream = spark.readStream.schema("stage string, read_id long, gene_id long, ts timestamp").parquet(path)
    marks = spark.createDataFrame([], "ts timestamp")
    if _exists(spark, f"{out}/marks"):
        marks = spark.read.schema("ts timestamp").parquet(f"{out}/marks")
    newest = marks.agg(F.max("ts").alias("ts")).first()["ts"]
    is_late = F.lit(False) if newest is None else F.coalesce(F.col("ts") < F.lit(newest) - F.expr(late), F.lit(False))
    stage = F.when(is_late, F.lit(LATE)).otherwise(F.coalesce("stage", F.lit("")))
    ids = stream.select(stage.alias("stage"), F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("id")) for k, c in (("reads", "read_id"), ("genes", "gene_id"))])))

    def count(batch: DataFrame, number: int) -> None:
        batch.groupBy("stage", "kind").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out}/counts/batch={number}")

    def mark(batch: DataFrame, number: int) -> None:
        batch.agg(F.max("ts").alias("ts")).write.mode("overwrite").parquet(f"{out}/marks/batch={number}")

    _follow(spark, ids.filter("id IS NOT NULL").dropDuplicates(["stage", "kind", "id"]), count, f"{checkpoint}/counts")
    _follow(spark, stream.select("ts"), mark, f"{checkpoint}/marks")
    if not _exists(spark, f"{out}/counts"):
        return spark.createDataFrame([], "stage string, reads long, genes long")
    counts = spark.read.schema("stage string, kind string, n long").parquet(f"{out}/counts")
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(kind)
    return counts.groupBy("stage").agg(of("reads"), of("genes"))


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema
    except AnalysisException:
        return False
    return True


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per window and type of a stream or table with ts and event_type; a stream drops rows later than ``late``."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def stage_table(spark: SparkSession, path: str, make) -> DataFrame:
    """The stage's table at path: read if it was completed (its _SUCCESS exists), else made and written first."""
    try:
        spark.read.format("binaryFile").load(f"{path}/_SUCCESS").schema
        done = True
    except AnalysisException:
        done = False
    if not done:
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
