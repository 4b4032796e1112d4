"""Records and blocks of lines that a file's splits cut anywhere, put together where they are read.

A first pass over the text leaves one small row a split: its lines, the first and last three of them, its last header. From
these each split learns which line of its file it begins with and which header stands above it (some 30 bytes a split, and
a header where there is one, go to the tasks), and the second pass makes rows without a shuffle of text. Only lines of
records that a border cuts, three a side at most, are exchanged. Both passes plan the same splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwise.scratch import written

#: Lines of a record; lines at either end of a split that may belong to a record which it cuts.
LINES, EDGE = 4, 3


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """value, f (a hash of the file's path) and s (where the split begins) of every line, in order within a split."""
    return spark.read.text(path).select("value", F.xxhash64(F.col("_metadata.file_path")).alias("f"), F.col("_metadata.file_block_start").alias("s"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """Each split's lines in a batch."""
    f, s = batch.column(1).to_numpy(), batch.column(2).to_numpy()
    cuts = [0, *(np.flatnonzero((np.diff(f) != 0) | (np.diff(s) != 0)) + 1).tolist(), len(f)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        if hi > lo:
            yield (int(f[lo]), int(s[lo])), batch.column(0).slice(lo, hi - lo)


def split_ends(spark: SparkSession, path: str, mark: str | None = None) -> DataFrame:
    """f, s, n (lines), head and tail (the first three lines and the last three others), before (lines of the file before the split),
    above (the last line that begins with ``mark`` in the splits before it), one row a split, written."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
    names = ["f", "s", "n", "head", "tail", "header"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        for batch in batches:
            for key, lines in _runs(batch):
                seen = found.setdefault(key, [0, [], [], None])
                more = lines.slice(0, EDGE - len(seen[1])).to_pylist() if len(seen[1]) < EDGE else []
                rest = lines.slice(max(len(more), len(lines) - EDGE)).to_pylist()
                seen[0], seen[1], seen[2] = seen[0] + len(lines), seen[1] + more, (seen[2] + rest)[-EDGE:]
                if mark is not None and len(at := np.flatnonzero(pc.starts_with(lines, mark).to_numpy(zero_copy_only=False))):
                    seen[3] = lines[int(at[-1])].as_py()
        columns = zip(*[(*key, *v) for key, v in found.items()], strict=True) if found else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    rows = written(_scan(spark, path).mapInArrow(run, "f long, s long, n long, head array<string>, tail array<string>, header string"), "splits")
    earlier = Window.partitionBy("f").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn("above", F.last("header", ignorenulls=True).over(earlier))


def records(spark: SparkSession, path: str) -> DataFrame:
    """l0, l1, l2, l3 of every four lines of a file, whatever they begin with; what a last record lacks is null."""
    ends = written(split_ends(spark, path), "split-ends")
    known = spark.sparkContext.broadcast({(r.f, r.s): r.before for r in ends.select("f", "s", "before").collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, key, held, skip = known.value, None, None, 0
        for batch in batches:
            for now, lines in _runs(batch):
                if now != key:  # what the split before left over is of a record that its border cuts
                    key, held, skip = now, lines.slice(0, 0), -before[now] % LINES
                # A split begins with what is left of a record that begins before it.
                lines, skip = lines.slice(min(skip, len(lines))), max(skip - len(lines), 0)
                lines = pa.concat_arrays([held, lines])
                whole = len(lines) // LINES * LINES
                held = lines.slice(whole)
                if whole:
                    yield pa.RecordBatch.from_arrays([lines.take(pa.array(np.arange(k, whole, LINES))) for k in range(LINES)], [f"l{k}" for k in range(LINES)])

    inside = _scan(spark, path).mapInArrow(run, ", ".join(f"l{k} string" for k in range(LINES)))
    head = ends.select("f", "n", "before", F.col("before").alias("first"), F.posexplode("head").alias("i", "value"))
    tail = ends.select("f", "n", "before", (F.col("before") + F.col("n") - F.size("tail")).alias("first"), F.posexplode("tail").alias("i", "value"))
    edges = head.unionByName(tail).withColumn("line", F.col("first") + F.col("i")).withColumn("record", F.floor(F.col("line") / LINES))
    cut = (F.col("record") * LINES < F.col("before")) | ((F.col("record") + 1) * LINES > F.col("before") + F.col("n"))
    part = lambda k: F.max(F.when(F.col("line") % LINES == k, F.col("value"))).alias(f"l{k}")
    return inside.unionByName(edges.filter(cut).groupBy("f", "record").agg(*[part(k) for k in range(LINES)]).drop("f", "record"))


def below_headers(spark: SparkSession, path: str, mark: str) -> DataFrame:
    """header, value, s, at of every line that is not blank and has a line beginning with ``mark`` above it in its file: the
    nearest one is its header. s and at (the split's beginning, the line in it) give the order within a file."""
    ends = split_ends(spark, path, mark)
    known = spark.sparkContext.broadcast({(r.f, r.s): r.above for r in ends.filter("above IS NOT NULL").select("f", "s", "above").collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, header, place = None, None, 0
        for batch in batches:
            for now, lines in _runs(batch):
                if now != key:
                    key, header, place = now, known.value.get(now), 0
                heads = pc.starts_with(lines, mark).to_numpy(zero_copy_only=False)
                last = np.maximum.accumulate(np.where(heads, np.arange(len(lines)), -1))
                own = pa.concat_arrays([pa.array([header], pa.string()), lines.cast(pa.string())]).take(pa.array(last + 1))
                full = pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(lines)), 0).to_numpy(zero_copy_only=False)
                keep = pa.array(~heads & full & own.is_valid().to_numpy(zero_copy_only=False))
                at = pa.array(np.arange(place, place + len(lines)))
                yield pa.RecordBatch.from_arrays([own.filter(keep), lines.filter(keep), pa.array(np.full(len(lines), now[1])).filter(keep), at.filter(keep)], ["header", "value", "s", "at"])
                header, place = own[len(own) - 1].as_py(), place + len(lines)

    return _scan(spark, path).mapInArrow(run, "header string, value string, s long, at long")
