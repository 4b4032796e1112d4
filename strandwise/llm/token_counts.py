"""Token counts by a two-tier map-side lookup, without any shuffle of pre-tokens.

The model never joins pieces over a space or a line feed (checked against its vocabulary), so a text is a sequence
of pre-tokens whose token counts add up. Tier one is a broadcast table of the counts of frequent pre-tokens (at
most FREQUENT entries, gathered from at most SAMPLE_ROWS documents; it changes the speed only, never a count).
Tier two is each Python worker's own cache, emptied whenever it is full. Texts whose spacing the pre-token rule does
not cover (two spaces in a row, a space at either end or before a line feed, the escape character itself) are
encoded whole by the library.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from urllib.parse import unquote

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm.common import table, worker_store

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Entries of the broadcast table, of a worker's cache, and documents from which the former is gathered.
FREQUENT, CACHED, SAMPLE_ROWS = 32_768, 400_000, 4_000
#: Partitions of the sample, each of which sends at most FREQUENT entries to the driver; files from which the query takes it.
SAMPLE_PARTS, SAMPLE_FILES = 4, 8
ESCAPE = "▁"


def _pieces(text: str) -> list[str] | None:
    """The pre-tokens of a text: runs without a space or line feed, the latter leading its run. None: encode it whole."""
    if ESCAPE in text:
        return None
    parts = text.replace("\n", " \n").split(" ")
    return None if "" in parts else parts


class Tiers(dict):
    """Pre-token -> count. What the broadcast table lacks comes from the worker's cache or the library."""

    def __init__(self, frequent: dict[str, int], model: str):
        import sentencepiece

        super().__init__(frequent)
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.cache: dict[str, int] = worker_store(model)
        size = self.sp.get_piece_size()
        pieces = [self.sp.id_to_piece(i) for i in range(size)]
        #: Whether counts of pre-tokens add up under this model.
        self.adds_up = not any(ESCAPE in p.lstrip(ESCAPE) or "\n" in p for p in pieces) and len(self.sp.encode("\n")) == 2

    def __missing__(self, part: str) -> int:
        n = self.cache.get(part)
        if n is None:
            # The library puts a space before a text; before a line feed that space is a token of its own.
            n = len(self.sp.encode(part)) - (part[0] == "\n")
            if len(self.cache) >= CACHED:
                self.cache.clear()
            self.cache[part] = n
        return n

    def count(self, text: str) -> int:
        parts = _pieces(text) if self.adds_up else None
        return sum(map(self.__getitem__, parts)) if parts else len(self.sp.encode(text))


def frequent_lengths(docs: DataFrame, model: str = MODEL, rows: int | None = None) -> dict[str, int]:
    """Counts of the most frequent pre-tokens of a bounded sample: top lists per partition, merged on the driver."""
    rows = docs.count() if rows is None else rows
    texts = docs.select("text")
    sample = (texts.sample(SAMPLE_ROWS / rows, 7) if rows > SAMPLE_ROWS else texts).limit(2 * SAMPLE_ROWS).repartition(SAMPLE_PARTS)

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(_pieces(text or "") or ())
        most = seen.most_common(FREQUENT)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in most], pa.string()), pa.array([n for _, n in most], pa.int64())], ["part", "n"])

    total: Counter[str] = Counter()
    for part, n in sample.mapInArrow(top, "part string, n long").toLocalIterator():
        total[part] += n
    tiers = Tiers({}, model)
    return {part: tiers[part] for part, _ in total.most_common(FREQUENT)} if tiers.adds_up else {}


def some_files(docs: DataFrame, files: int = SAMPLE_FILES) -> DataFrame:
    """The rows of so many of the Parquet files behind a table as it was read, chosen by a hash of their paths: a sample costs no second pass over all texts."""
    chosen = sorted(map(unquote, docs.inputFiles()), key=lambda f: (zlib.crc32(f.encode()), f))[:files]
    return docs.sparkSession.read.schema(docs.schema).parquet(*chosen) if chosen else docs


def count_tokens(docs: DataFrame, limit: int = 4096, model: str = MODEL, sample: DataFrame | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each whole text; null counts as empty (0 tokens).

    Every row has one row, repeats and null ids too; other columns are ignored; an empty table gives no rows. The frequent
    pre-tokens come from the texts of ``sample``, by default those of docs; the counts do not depend on it.
    """
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_lengths(docs if sample is None else sample, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiers = Tiers(frequent.value, model)
        for batch in batches:
            counts = pa.array([tiers.count(text) for text in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce("text", F.lit(""))
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return count_tokens(docs, sample=some_files(docs))
