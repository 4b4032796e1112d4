"""Helpers shared by the operators of this package: table reading, shared scratch tables, salted ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwise.scratch import written  # noqa: F401

#: Words are runs of anything but the six ASCII white-space characters.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fifth of the rows that no model may learn from."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(F.encode(c.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def bind(value: Column, body) -> Column:
    """Evaluate value once per row and hand it to body, so that a lambda inside body does not repeat it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Hexadecimal digits of an MD5 that make up a draw.
DRAW = 12


def draw(key: Column) -> Column:
    """A number (long) from 0 to 16^DRAW - 1 by the MD5 of a string."""
    return F.conv(F.substring(F.md5(F.encode(key, "UTF-8")), 1, DRAW), 16, 10).cast("long")


def draw_bucket(drawn: Column, buckets: int) -> Column:
    """The bucket of a draw, rising with it: ranks that ``salted_rank`` gives in the order of draws then depend on no number of buckets."""
    return F.floor(drawn / F.lit(float(16**DRAW)) * buckets).cast("int")


def salted_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, buckets: int, sized: DataFrame | None = None, bucket: Column | None = None) -> DataFrame:
    """Gapless 0-based rank of each row within its (non-null) keys, as a new long column ``out``.

    A key may hold any share of the rows: every key is split into ``buckets`` hash buckets of the order columns, each
    bucket is ranked by itself, and a prefix sum over the bucket sizes (at most keys x buckets rows) turns that into one
    numbering. The order columns should tell all rows apart that differ in anything (add a hash of the content): rows equal
    in all of them share a bucket, and a task that runs anew may swap them. ``sized`` may give a cheaper frame with the same
    rows (keys and order columns) from which to count. ``bucket`` may give the bucket otherwise (from the order columns).
    """
    salt, first = f"{out}__salt", f"{out}__first"
    salted = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(buckets)).cast("int") if bucket is None else bucket
    count = (sized if sized is not None else df).select(*keys, salted.alias(salt)).groupBy(*keys, salt).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    starts = count.select(*keys, salt, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(first))
    place = F.row_number().over(Window.partitionBy(*keys, salt).orderBy(*order))
    ranked = df.withColumn(salt, salted).withColumn(out, place.cast("long") - 1)
    return ranked.join(starts, [*keys, salt]).withColumn(out, F.col(out) + F.col(first)).drop(salt, first)


def rank_buckets(rows: int) -> int:
    """Hash buckets for ``salted_rank`` over that many rows: 256 at least, and no more than some 100,000 rows a bucket if one key holds all."""
    return max(256, -(-rows // 100_000))


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker process, so that later tasks of the worker find what earlier ones cached."""
    import sys
    import types

    return sys.modules.setdefault("strandwise_worker_store", types.ModuleType("strandwise_worker_store")).__dict__.setdefault(name, {})


#: Texts of more UTF-8 bytes are scored, but no model learns from them: with the number of rows it bounds what comes to the driver.
LEARNED_BYTES = 100_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """text and y of at most ``rows`` labelled documents of each class, never of the held-out fifth; chosen by a hash of the id.

    The ids are chosen from the narrow label table, so only the chosen texts move; they are few enough to broadcast by
    the bound on ``rows``. An id that repeats in either table counts once (its smallest text by hash), and texts of more
    than LEARNED_BYTES are left out: at most 2 * rows * LEARNED_BYTES bytes come back.
    """
    own = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("y")).filter(F.col("__id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("__id"))
    once = own.groupBy("__id").agg(F.max("y").alias("y"))
    picked = [once.filter(F.col("y") == y).orderBy(F.xxhash64("__id"), "__id").limit(rows) for y in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    met = docs.select(F.col("doc_id").alias("__doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter(F.octet_length("text") <= LEARNED_BYTES).join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))
    return met.groupBy(F.col("__doc").alias("doc_id"), "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")).select("doc_id", "text", "y")
