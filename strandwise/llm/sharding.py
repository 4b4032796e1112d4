"""Weighted rendezvous hashing of stable record keys over shards, in DataFrame functions only.

Each record draws one number u in (0, 1) per shard from the MD5 of its key and the shard's number, and goes to the
shard with the smallest -ln(u) / weight. A shard gets records in proportion to its weight; a new shard can only
win records for itself, and the loss of a shard moves only that shard's records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm.common import DRAW, draw, draw_bucket, rank_buckets, salted_rank, table
from strandwise.scratch import written_counted


def cost(key: Column, shard: int, weight: float) -> Column:
    """-ln(u) / weight for the number u in (0, 1) that the key draws for the shard. A null key counts as ''."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    u = (draw(F.concat(text, F.lit(f":{shard}"))).cast("double") + 0.5) / float(16**DRAW)
    return -F.log(u) / F.lit(float(weight))


def winner(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """Struct (cost, shard) of the cheapest shard; the shards' numbers begin at ``first``. Ties go to the lower shard."""
    draws = [F.struct(cost(key, i, w).alias("cost"), F.lit(i).alias("shard")) for i, w in enumerate(weights, first) if w > 0]
    return F.least(*draws) if len(draws) > 1 else draws[0]


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (int) of a key, among len(weights) shards."""
    return winner(key, weights)["shard"]


def shard(docs: DataFrame, weights: Sequence[float], new: float | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for every row.

    size: UTF-8 bytes of the text plus one (null text: one). slot: gapless from 0 in each shard, in the order of a draw from doc_id, checksum
    and size. grown_shard: the shard
    after one more, of weight ``new`` (by default the mean), has come: its draw alone meets the cheapest of the others.
    doc_id and the shard weights alone decide, so rows that repeat a doc_id go to the same shard, and equal texts of
    different ids do not; null ids count as one key. Other columns are ignored; an empty table gives no rows.
    """
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    key = F.col("doc_id")
    rows = docs.select(key.cast("long").alias("doc_id"), (F.length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"), winner(key, weights).alias("won"))
    more = winner(key, [sum(weights) / len(weights) if new is None else new], len(weights))
    # Written, as both the sizes of the buckets and the rows themselves come from it: the draws are made once.
    own = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32", "size")
    drawn, n = written_counted(rows.select("doc_id", "size", "text_crc32", F.col("won.shard").alias("shard"), F.least("won", more)["shard"].alias("grown_shard"), draw(own).alias("drawn")), "drawn-shards")
    buckets = rank_buckets(n)
    ranked = salted_rank(drawn, ["shard"], ["drawn", "doc_id", "text_crc32", "size"], "slot", buckets, bucket=draw_bucket(F.col("drawn"), buckets))
    return ranked.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), [1.0] * 16)


#: Half bytes of a part of a text whose CRC-32 the SQL works out by itself.
PART = 128


def _crc(c: int, zeros: int) -> int:
    """What so many zero half bytes make of a CRC-32 register."""
    for _ in range(4 * zeros):
        c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
    return c


def _crc_past_part(register: str) -> str:
    """SQL for a register after PART zero half bytes: a linear map, so the exclusive or of what each half byte of it becomes."""
    terms = [f"{[_crc(v << 4 * j, PART) for v in range(16)]}[(({register} >> {4 * j}) & 15) + 1]" for j in range(8)]
    for term in terms[1:]:
        terms[0] = f"xor({terms[0]}, {term})"
    return terms[0]


#: With equal weights the cheapest shard is that of the largest draw. The checksums of the parts of a text, the first of which
#: is the short one, are put together; in each, half a byte is a step, the lower one first.
OP8_SQL = f"""
WITH d AS (SELECT doc_id, h, length(h) % {PART} AS r FROM (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents)),
q AS (SELECT doc_id, j, CASE WHEN j = 0 THEN h[1 : r] ELSE h[r + {PART} * (j - 1) + 1 : r + {PART} * j] END AS part FROM d, unnest(range(length(h) // {PART} + 1)) AS t(j)),
g AS (SELECT doc_id, j, list_reduce(list_prepend(CASE WHEN j = 0 THEN 4294967295 ELSE 0 END::BIGINT,
             list_transform(range(length(part)), lambda i: (strpos('0123456789ABCDEF', substr(part, xor(i, 1) + 1, 1)) - 1)::BIGINT)),
             lambda c, b: xor(c >> 4, {[_crc(v, 1) for v in range(16)]}[(xor(c, b) & 15) + 1])) AS c FROM q),
x AS (SELECT doc_id, xor(list_reduce(list(c ORDER BY j), lambda c, b: xor({_crc_past_part('c')}, b)), 4294967295)::BIGINT AS text_crc32 FROM g GROUP BY doc_id),
m AS (SELECT doc_id, (length(h) // 2 + 1)::BIGINT AS size, text_crc32 FROM d JOIN x USING (doc_id)),
s AS (SELECT doc_id, k, ('0x' || substr(md5(concat(doc_id, ':', k)), 1, 12))::BIGINT AS u FROM documents, range(17) AS t(k)),
w AS (SELECT doc_id, arg_max(k, u) FILTER (k < 16)::INTEGER AS shard, arg_max(k, u)::INTEGER AS grown_shard FROM s GROUP BY doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard, row_number() OVER (PARTITION BY shard
       ORDER BY ('0x' || substr(md5(concat(doc_id, ':', text_crc32, ':', size)), 1, 12))::BIGINT, doc_id) - 1 AS slot
FROM m JOIN w USING (doc_id)
"""
