"""Exact de-duplication against a minimal perfect hash over the digests of earlier documents.

The distinct digests of the history are dealt by a digest prefix into shards. Each shard becomes one row: a
minimal perfect hash (levels of bit arrays; a digest's slot is the rank of its bit), a slot array of full 32-byte
digests, and the winner and group size of each slot. A batch is first reduced to one row per distinct digest
(map-side combine, so a group of copies of any size is one row), meets its shard by co-grouping, and is looked up
by slot. A perfect hash gives some slot for any key, so the slot's 32 bytes are compared before a hit counts.
Hits merge into the slot's group; nonmembers form groups of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm.common import table
from strandwise.scratch import written_counted

#: Bits per remaining key in each level of the perfect hash; digests of a shard of the index; repeats of a row that come back at once.
GAMMA, DIGESTS, STEP = 2, 500_000, 10_000
GROUP = "digest binary, keep_id long, group_size long"


def _mixed(words: np.ndarray, level: int) -> np.ndarray:
    """A hash of each digest for this level, from its four 64-bit words."""
    step = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) % (1 << 64))
    x = words[:, level % 4] ^ (words[:, (level + 1) % 4] * step)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


class PerfectHash:
    """Minimal perfect hash of distinct 32-byte digests: n digests get the slots 0 to n-1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = []
        first = 0
        for bits in levels:
            self.ranks.append(first + np.cumsum(bits, dtype=np.int64) - bits)
            first += int(bits.sum())

    @classmethod
    def build(cls, digests: list[bytes]) -> PerfectHash:
        left, levels = _words(digests), []
        while len(left):
            size = max(8, GAMMA * len(left))
            at = (_mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            bits = np.bincount(at, minlength=size) == 1
            levels.append(bits)
            left = left[~bits[at]]
        return cls(levels)

    def slots(self, digests: list[bytes]) -> np.ndarray:
        """A slot for each digest; -1 where no level claims it. A digest outside the built set may get any slot."""
        words = _words(digests)
        out = np.full(len(words), -1, dtype=np.int64)
        open_ = np.arange(len(words))
        for level, bits in enumerate(self.levels):
            at = (_mixed(words[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self.ranks[level][at[hit]]
            open_ = open_[~hit]
        return out

    def dump(self) -> list[bytes]:
        return [len(bits).to_bytes(8, "little") + np.packbits(bits).tobytes() for bits in self.levels]

    @classmethod
    def load(cls, parts: list[bytes]) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(p, np.uint8, offset=8), count=int.from_bytes(p[:8], "little")).astype(bool) for p in parts])


INDEX = "shard int, levels array<binary>, digests binary, winners binary, sizes binary"


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    digests = [bytes(d) for d in pdf["digest"]]
    mph = PerfectHash.build(digests)
    slot = mph.slots(digests)
    order = np.argsort(slot)
    ids = pdf["keep_id"].fillna(np.iinfo(np.int64).min).astype("int64").to_numpy()[order]
    sizes = pdf["group_size"].to_numpy("int64")[order]
    row = (int(pdf["shard"].iloc[0]), mph.dump(), b"".join(digests[i] for i in order), ids.tobytes(), sizes.tobytes())
    return pd.DataFrame([row], columns=["shard", "levels", "digests", "winners", "sizes"])


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """Index rows (one per shard) over history's groups (digest binary, keep_id, group_size)."""
    return history.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(_build, INDEX)


def _shard(shards: int):
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def _apply(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    lowest = np.iinfo(np.int64).min
    digests = [bytes(d) for d in new["digest"]]
    ids = new["keep_id"].fillna(lowest).astype("int64").to_numpy()
    sizes = new["group_size"].to_numpy("int64")
    old, winners, held = [], np.empty(0, np.int64), np.empty(0, np.int64)
    member = np.zeros(len(digests), bool)
    if len(index):
        row = index.iloc[0]
        blob = bytes(row["digests"])
        old = [blob[i : i + 32] for i in range(0, len(blob), 32)]
        winners, held = np.frombuffer(row["winners"], np.int64).copy(), np.frombuffer(row["sizes"], np.int64).copy()
        slot = PerfectHash.load([bytes(p) for p in row["levels"]]).slots(digests) if digests else np.empty(0, np.int64)
        member = np.fromiter((s >= 0 and old[s] == d for s, d in zip(slot, digests, strict=True)), bool, len(digests))
        winners[slot[member]] = np.maximum(winners[slot[member]], ids[member])  # digests of a batch are distinct: no slot twice
        held[slot[member]] += sizes[member]
    own = np.flatnonzero(~member)
    out = pd.DataFrame({"digest": [*old, *(digests[i] for i in own)], "keep_id": np.concatenate([winners, ids[own]]), "group_size": np.concatenate([held, sizes[own]])})
    out["keep_id"] = out["keep_id"].astype("Int64").mask(out["keep_id"] == lowest)
    return out


def resolve(batch: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Groups (digest, keep_id, group_size) after the batch's groups met the index: updated slots and new groups."""
    return batch.withColumn("shard", _shard(shards)).groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_apply, GROUP)


def groups_of(rows: DataFrame) -> DataFrame:
    """One row per distinct digest: the largest doc_id and the number of rows."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def digested(docs: DataFrame) -> DataFrame:
    """doc_id and the SHA-256 of each whole text, nothing changed in it; null counts as empty. Other columns of docs are ignored."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(_sha()).alias("digest"))


def _sha() -> Column:
    return F.sha2(F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8"), 256)


def dedup(rows: DataFrame, history: DataFrame | None = None, shards: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``rows`` and of ``history`` (frames of ``digested``).

    Of equal texts the row with the largest doc_id stays (a null doc_id counts as smallest; among rows that repeat
    the same doc_id and text, one stays). Without a history the earlier half of the id range serves as history and
    the later half as the batch. An empty table gives no rows. The digests are worked out once and written, as several
    steps read them; a shard of the index holds about DIGESTS of them.
    """
    every, n = written_counted(rows if history is None else rows.unionByName(history), "digests")
    if history is None:
        low, high = every.select(F.min("doc_id"), F.max("doc_id")).first()
        cut = 0 if low is None else (low + high + 1) // 2
        old = F.coalesce(F.col("doc_id") < cut, F.lit(True))
        history, batch = every.filter(old), every.filter(~old)
    else:
        batch = rows
    shards = shards or max(2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // DIGESTS))
    groups = resolve(groups_of(batch), build_index(groups_of(history), shards), shards)
    # Repeats of the very same row are counted first; the join's other side has one row per digest, and Spark splits a hot digest.
    repeats = every.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    met = repeats.join(groups, "digest")
    # A row that repeats often comes back in steps, so that no array grows with it.
    steps = met.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / STEP).cast("long"))))
    one = steps.withColumn("i", F.explode(F.sequence(F.col("step") * STEP + 1, F.least(F.col("n"), (F.col("step") + 1) * STEP))))
    return one.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(digested(table(spark, sf_dir, "documents")))


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def unique_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns: one of each text, that of the largest doc_id (null is smallest).

    Rows equal in doc_id and text are reduced to one map-side, whatever their other columns (any one of them stays). The
    rows are then dealt once, by doc_id and digest, which serves both this and the look-up of what stays.
    """
    kept = dedup(digested(docs)).filter("kept").select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("__dedup_id"), F.col("doc_id").isNull().alias("__dedup_none"), F.col("text_sha256").alias("__dedup_sha"))
    own = {"__dedup_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), "__dedup_none": F.col("doc_id").isNull(), "__dedup_sha": _sha()}
    return docs.withColumns(own).dropDuplicates(list(own)).join(kept, list(own), "left_semi").select(*docs.columns)
