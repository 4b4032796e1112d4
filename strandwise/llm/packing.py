"""Packing token sequences by cutting-stock column generation.

Documents are tokenized map-side; a document longer than a sequence is cut into full pieces and a rest. The histogram
of piece lengths (at most WIDTH-wide classes of one sequence, so a bounded table) goes to the driver, where
``cutting_stock`` plans how many sequences hold which lengths. Pieces are then ranked within their class, and each
rank's place in the plan (pattern, copy, slot) follows by arithmetic from a small table: no piece is ever searched for.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwise.batches import slices
from strandwise.llm.common import rank_buckets, salted_rank, table, worker_store, written
from strandwise.llm.cutting_stock import plan

MODEL = public_tokenizers.path("word_bpe_49k.json")
CAPACITY, END = 2048, 1
#: Lengths are planned in classes of this many tokens.
WIDTH = 8
#: Entries of a worker's caches of white-space-delimited runs and of words; of a full cache the KEPT oldest stay, as frequent ones come early.
CACHED, KEPT = 240_000, 120_000
#: Runs of these characters split into words as below; all others go to the library as they are.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: Characters that Python, but not the tokenizer, takes for white space.
ODD_SPACE = re.compile("[\x1c-\x1f]")


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet of the tokenizer's model: printable Latin-1 stands for itself, the other bytes follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(own)))}


class Words(dict):
    """Word of plain characters -> its ids (bytes), by the library's model; the word is what its own splitting would give."""

    alphabet = _byte_alphabet()

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize

    def __missing__(self, word: str) -> bytes:
        ids = [t.id for t in self.tokenize(word.encode().decode("latin-1").translate(self.alphabet))]
        self[word] = found = struct.pack(f"<{len(ids)}I", *ids)
        return found


def _shrink(cache: dict) -> None:
    if len(cache) > CACHED:
        oldest = list(islice(cache.items(), KEPT))
        cache.clear()
        cache.update(oldest)


class RunTokenizer:
    """Ids of whole texts (bytes of little-endian unsigned 32-bit ids). The tokenizer drops white space, so runs between it are independent."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        store = worker_store(model)
        if "tokenizer" not in store:
            tokenizer = Tokenizer.from_file(model)
            store.update(tokenizer=tokenizer, runs={}, words=Words(tokenizer.model))
        self.tokenizer, self.runs, self.words = store["tokenizer"], store["runs"], store["words"]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, new: set[str]) -> None:
        _shrink(self.words)
        odd = []
        for run in new:
            if PLAIN.fullmatch(run) and "<|" not in run:
                self.runs[run] = b"".join(map(self.words.__getitem__, PARTS.findall(run.lower())))
            else:
                odd.append(run)
        self.runs.update(zip(odd, self._encode(odd), strict=True))

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if ODD_SPACE.search(text):
                yield self._encode([text])[0]
                continue
            runs = text.split()
            _shrink(self.runs)
            if new := set(runs).difference(self.runs):
                self._learn(new)
            yield b"".join(map(self.runs.__getitem__, runs))


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(docs: DataFrame, capacity: int = CAPACITY, model: str = MODEL, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens (and ids). A null text is empty: its end id alone."""
    end = np.array([END], "<u4").tobytes()
    schema = PIECE + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = RunTokenizer(model)
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc_id, body in zip(batch.column(0).to_pylist(), tokenizer.ids(batch.column(1).to_pylist()), strict=True):
                body += end
                total = len(body) // 4
                for start in range(0, total, capacity):
                    part = body[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total, *([np.frombuffer(part, "<u4").tolist()] if with_ids else [])))
            names = [f.split()[0] for f in schema.split(", ")]
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id and offset for every row of ``pieces`` (doc_id, start, length, ...; read twice, so pass a written table)."""
    if capacity % WIDTH:
        raise ValueError(f"the capacity must be a multiple of {WIDTH}")
    spark = pieces.sparkSession
    classed = pieces.withColumn("cls", F.ceil(F.col("length") / WIDTH).cast("int"))
    # Class k holds lengths up to k widths and counts as k, so that any pieces of the planned classes fit together.
    top = capacity // WIDTH
    demand = np.zeros(top + 1, np.int64)
    for cls, n in classed.groupBy("cls").count().collect():  # at most capacity / WIDTH rows
        demand[cls] = n
    taken, sequence, entries = np.zeros(top + 1, np.int64), 0, []
    for uses, parts in plan(np.arange(top + 1), demand, capacity // WIDTH):
        slot = 0
        for cls, copies in parts:
            entries.append((cls, int(taken[cls]), int(taken[cls] + uses * copies), copies, sequence, slot))
            taken[cls] += uses * copies
            slot += copies
        sequence += uses
    places = spark.createDataFrame(entries, "cls int, first long, past long, copies int, sequence long, slot int")
    places = places.groupBy("cls").agg(F.collect_list(F.struct("first", "past", "copies", "sequence", "slot")).alias("places"))
    ranked = salted_rank(classed, ["cls"], ["doc_id", "start", "ids_crc32", "length", "doc_tokens"], "rank", rank_buckets(int(demand.sum())))
    # places has at most capacity / WIDTH rows; its entries are bounded by the patterns of the plan (a few per class).
    placed = ranked.join(F.broadcast(places), "cls").withColumn("place", F.element_at(F.filter("places", lambda p: (p["first"] <= F.col("rank")) & (F.col("rank") < p["past"])), 1))
    nth = F.col("rank") - F.col("place.first")
    copies = F.col("place.copies")
    placed = placed.withColumn("sequence_id", F.col("place.sequence") + F.floor(nth / copies).cast("long")).withColumn("slot", F.col("place.slot") + nth % copies)
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    return placed.withColumn("offset", offset).select(*pieces.columns, "sequence_id", "offset")


def pack(docs: DataFrame, capacity: int = CAPACITY, model: str = MODEL) -> DataFrame:
    """Pieces of all documents with their sequence_id and gapless offset there; every row of docs is packed, repeats too.

    Other columns of docs are ignored. Rows that repeat an id are told apart by their tokens; equal ones are interchangeable.
    Null or empty texts give a piece of the end id alone; an empty table gives no rows.
    """
    return assign(written(cut(docs, capacity, model), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its tokens and its pieces in order (a sequence holds at most ``capacity`` pieces)."""
    part = F.struct("offset", "doc_id", "start", "length")
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(part)).alias("pieces"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


