"""SimHash near-duplicates by a self-join of binary tries.

Cut into b blocks, two fingerprints at no more than three differing bits agree in at least b - 3 of them. Each distinct
fingerprint is laid out once per choice of b - 3 blocks, so that they lead: four blocks give four layouts led by 16 bits,
five blocks ten led by 25. The number of fingerprints sets b, so that tries stay small. Fingerprints with the same lead
are the leaves of a binary trie over the other bits. The join descends pairs of nodes of that trie together, adds up the
bits in which their paths differ, and drops a pair whose sum exceeds the budget. Pairs of small nodes end in a direct
comparison of their leaves. A trie of more than ``hot`` leaves is first descended eight levels by Spark itself, so that
its node pairs are dealt over many tasks. A task reports its links as a forest (each fingerprint with the smallest one it
reaches there): no link between different texts is lost, and a group of copies never becomes all of its pairs.

Near copies with many small changes lie further apart than three bits. The pipeline's stage therefore adds links between
texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8: texts with an equal band of MinHashes
are candidates (a pair at 0.8 misses all bands once in 14,000), each meets two texts of its band, and both texts are
compared in full. A group of near copies so costs a few comparisons a text instead of all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.batches import slices
from strandwise.llm.common import table, written
from strandwise.llm.components import components

SHINGLE, BITS, BUDGET = 3, 64, 3
#: Blocks beyond the budget at most, and the share of ``HOT`` leaves that a trie of evenly spread fingerprints may have.
MORE, FULL = 4, 0.1
#: Leaves of a trie beyond which Spark deals its node pairs over tasks; levels that it descends at once.
HOT, STEP = 50_000, 8
#: Node pairs with at most this many leaf pairs are compared directly; node pairs that a task expands at once.
SMALL, CHUNK = 64, 1 << 15
#: Links that a task holds, besides one for each of its keys, before it unites them; keys that a task gets about.
UNITE, KEYS = 1 << 20, 1 << 20
#: Near copies: words of a shingle, least Jaccard similarity, bands of MinHashes, MinHashes of a band, orders by which a band chooses whom to compare with.
WORDS, ALIKE, BANDS, ROWS, ORDERS = 5, 0.8, 24, 5, 3


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text: bit i is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    ones, n = np.zeros(BITS, np.int64), max(1, len(words) - shingle + 1)
    for at in range(0, n, 1 << 14):
        part = words[at : min(at + (1 << 14), n) + shingle - 1] if n > 1 else words
        runs = zip(*[part[k:] for k in range(shingle)], strict=False) if len(part) >= shingle else [part]
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: tuple[str, ...] = (), keys: bool = False) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and the columns carry of each row, with its band keys if asked for; null text has no words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            bands = [pa.array([band_keys(t) for t in texts], pa.list_(pa.int64()))] if keys else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), *batch.columns[2:], *bands], ["doc_id", "fp", *carry, *(["keys"] if keys else [])])

    return rows.mapInArrow(run, "doc_id long, fp long" + (f", {kinds}" if kinds else "") + (", keys array<long>" if keys else ""))


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """Where the leaves of each node [lo, hi) whose given bit is one begin, by bisection: the keys of a node are sorted."""
    a, b = lo.copy(), hi.copy()
    while True:
        open_ = a < b
        if not open_.any():
            return a
        mid = (a + b) >> 1
        one = (keys[np.minimum(mid, len(keys) - 1)] >> bit) & np.uint64(1) == 1
        b = np.where(open_ & one, mid, b)
        a = np.where(open_ & ~one, mid + 1, a)


def _leaves(keys: np.ndarray, pairs: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """The linked leaves of node pairs (rows lo, hi, lo2, hi2), by comparing all their leaf pairs."""
    lo, hi, lo2, hi2 = pairs
    n2 = hi2 - lo2
    size = (hi - lo) * n2
    own = np.repeat(np.arange(len(lo)), size)
    k = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
    i, j = lo[own] + k // n2[own], lo2[own] + k % n2[own]
    ok = np.bitwise_count(keys[i] ^ keys[j]) <= budget
    ok &= (i < j) | (lo[own] != lo2[own])
    return i[ok], j[ok]


def trie_links(keys: np.ndarray, pairs: np.ndarray, errors: np.ndarray, depth: int, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of linked keys under node pairs (rows lo, hi, lo2, hi2; a node with itself where lo is lo2).

    Keys are sorted within each node. All node pairs stand at the same depth, their paths differ in ``errors`` bits.
    The walk goes depth first in chunks, so that few node pairs are held at once.
    """
    stack = [(depth, pairs, errors)]
    while stack:
        depth, pairs, errors = stack.pop()
        if pairs.shape[1] > CHUNK:
            stack += [(depth, pairs[:, CHUNK:], errors[CHUNK:])]
            pairs, errors = pairs[:, :CHUNK], errors[:CHUNK]
        lo, hi, lo2, hi2 = pairs
        few = ((hi - lo) * (hi2 - lo2) <= SMALL) | (depth == BITS)
        if few.any():
            yield _leaves(keys, pairs[:, few], budget)
            pairs, errors = pairs[:, ~few], errors[~few]
        if not pairs.shape[1]:
            continue
        lo, hi, lo2, hi2 = pairs
        bit = np.uint64(BITS - 1 - depth)
        mid, mid2 = _split(keys, lo, hi, bit), _split(keys, lo2, hi2, bit)
        same = lo == lo2
        out, errs = [], []
        for a, b, c, d, extra, use in ((lo, mid, lo2, mid2, 0, None), (mid, hi, mid2, hi2, 0, None), (lo, mid, mid2, hi2, 1, None), (mid, hi, lo2, mid2, 1, ~same)):
            ok = (a < b) & (c < d) & (errors + extra <= budget)
            if use is not None:
                ok &= use
            out.append(np.stack([a[ok], b[ok], c[ok], d[ok]]))
            errs.append(errors[ok] + extra)
        stack.append((depth + 1, np.concatenate(out, axis=1), np.concatenate(errs)))


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of n items reaches over the links i, j."""
    root = np.arange(n)
    while len(i):
        a, b = root[i], root[j]
        np.minimum.at(root, a, b)
        np.minimum.at(root, b, a)
        while (root[root] != root).any():
            root = root[root]
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    return root


def layouts(blocks: int, budget: int) -> list[list[tuple[int, int, int]]]:
    """For each choice of the blocks - budget blocks that lead: (first bit, width, new first bit) of every block."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    out = []
    for lead in combinations(range(blocks), blocks - budget):
        at, moves = BITS, []
        for k in (*lead, *(x for x in range(blocks) if x not in lead)):
            at -= edges[k + 1] - edges[k]
            moves.append((edges[k], edges[k + 1] - edges[k], at))
        out.append(moves)
    return out


def lead_bits(blocks: int, budget: int) -> int:
    """Bits that lead every layout."""
    return min(sum(width for _, width, _ in moves[: blocks - budget]) for moves in layouts(blocks, budget))


def blocks_for(keys: int, budget: int, hot: int) -> int:
    """The fewest blocks with which tries of that many evenly spread fingerprints stay far below ``hot`` leaves."""
    return next((b for b in range(budget + 1, budget + MORE) if keys / 2.0 ** lead_bits(b, budget) <= FULL * hot), budget + MORE)


def _united(root: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The forest root (each item's smallest reachable one so far) with more links."""
    own = np.arange(len(root))
    known = root != own
    i, j = (np.concatenate([x, *(f[k] for f in found)]) for k, x in enumerate((own[known], root[known])))
    return _roots(len(root), i, j)


def _link_tasks(depth: int, budget: int, blocks: int):
    """A mapInArrow body over whole groups: columns block, head, p, q (the node pair), key. Emits each linked key and its root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if got is None or not got.num_rows:
            return
        block, head, p, q, mine = (got.column(c).to_numpy() for c in ("block", "head", "p", "q", "mine"))
        keys = got.column("key").to_numpy().view(np.uint64)
        order = np.lexsort((keys, mine, q, p, head, block))
        block, head, p, q, mine, keys = (x[order] for x in (block, head, p, q, mine, keys))
        change = np.flatnonzero((np.diff(block) != 0) | (np.diff(head) != 0) | (np.diff(p) != 0) | (np.diff(q) != 0) | (np.diff(mine) != 0)) + 1
        lo = np.concatenate([[0], change])
        hi = np.concatenate([change, [len(keys)]])
        own = p[lo] == q[lo]
        # A node against itself, or the two sides of a node pair, which follow one another.
        pair = np.flatnonzero(~own & (mine[lo] == p[lo]))
        pair = pair[pair + 1 < len(lo)]
        nxt = pair + 1
        pair = pair[(block[lo[nxt]] == block[lo[pair]]) & (head[lo[nxt]] == head[lo[pair]]) & (p[lo[nxt]] == p[lo[pair]]) & (q[lo[nxt]] == q[lo[pair]])]
        selves = np.flatnonzero(own & (hi - lo > 1))
        pairs = np.stack([np.concatenate([lo[selves], lo[pair]]), np.concatenate([hi[selves], hi[pair]]), np.concatenate([lo[selves], lo[pair + 1]]), np.concatenate([hi[selves], hi[pair + 1]])])
        errors = np.bitwise_count(p[pairs[0]].astype(np.uint64) ^ q[pairs[0]].astype(np.uint64)).astype(np.int64)
        root, held, size = np.arange(len(keys)), [], 0
        for i, j in trie_links(keys, pairs, errors, depth, budget):
            held.append((i, j))
            size += len(i)
            if size > len(keys) + UNITE:  # united now and then, so that neither the links nor the passes over all keys grow
                root, held, size = _united(root, held), [], 0
        root = _united(root, held)
        linked = np.flatnonzero(root != np.arange(len(keys)))
        own, u, v = block[linked], np.zeros(len(linked), np.uint64), np.zeros(len(linked), np.uint64)
        for n, moves in enumerate(layouts(blocks, budget)):
            of = own == n
            for first, width, at in moves:
                part = np.uint64((1 << width) - 1)
                for out, at_leaf in ((u, linked), (v, root[linked])):
                    out[of] |= ((keys[at_leaf[of]] >> np.uint64(at)) & part) << np.uint64(first)
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    return run


def links(fps: DataFrame, budget: int = BUDGET, hot: int = HOT, blocks: int | None = None) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp; read several times) that connect all that differ in at most budget bits."""
    if not 0 <= budget < BITS // 2:
        raise ValueError(f"no budget of {budget} bits")
    spark = fps.sparkSession
    fewest = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = fps.count()
    blocks = blocks or blocks_for(n, budget, hot)
    wide = lead_bits(blocks, budget)
    laid = []
    for b, moves in enumerate(layouts(blocks, budget)):
        key = F.lit(0).cast("long")
        for first, width, at in moves:
            key = key.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1)), at))
        laid.append(F.struct(F.lit(b).alias("block"), key.alias("key")))
    keys, turned = n * len(laid), F.array(*laid)
    none = F.lit(0).cast("long")
    rows = fps.select(F.explode(turned).alias("r")).select("r.block", "r.key", F.shiftrightunsigned("r.key", BITS - wide).alias("head"), none.alias("p"), none.alias("q"), none.alias("mine"))
    node, depth, out = ["block", "head", "p", "q"], wide, None
    while True:
        if depth < BITS:
            counts = written(rows.groupBy(*node).count().filter(F.col("count") > hot).select(*node), "hot-tries")
            any_hot = not counts.isEmpty()
        else:
            any_hot = False
        cold = rows.join(counts, node, "left_anti") if any_hot else rows
        parts = max(fewest, -(-keys // KEYS))
        found = cold.select(*node, "mine", "key").repartition(parts, *node).mapInArrow(_link_tasks(depth, budget, blocks), "u long, v long")
        out = found if out is None else out.unionByName(found)
        if not any_hot:
            return out
        # Descend STEP levels: each leaf meets the nodes whose next bits differ from its own within what is left of the budget.
        step = min(STEP, BITS - depth)
        masks = F.array(*[F.lit(m).cast("long") for m in range(1 << step) if m.bit_count() <= budget])
        bits = F.shiftrightunsigned("key", BITS - depth - step).bitwiseAND(F.lit((1 << step) - 1))
        deep = F.shiftleft("mine", step).bitwiseOR(bits)
        other = F.shiftleft(F.when(F.col("mine") == F.col("p"), F.col("q")).otherwise(F.col("p")), step).bitwiseOR(bits.bitwiseXOR(F.col("m")))
        down = rows.join(counts, node, "left_semi").withColumn("m", F.explode(masks)).withColumn("deep", deep).withColumn("other", other)
        down = down.filter(F.bit_count(F.col("deep").bitwiseXOR(F.col("other"))) <= budget)
        rows = down.select("block", "key", "head", F.least("deep", "other").alias("p"), F.greatest("deep", "other").alias("q"), F.col("deep").alias("mine"))
        depth += step


def near_groups(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET, hot: int = HOT) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable over links) for every row of docs, repeats too.

    A null or empty text has no words: its fingerprint is 0 and is linked like any other. Null ids count as no id: a group
    of them alone has a null component_id. Other columns of docs are ignored; an empty table gives no rows.
    """
    fps = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    of = components(links(distinct.select("fp"), budget, hot)).withColumnRenamed("node", "fp")
    rooted = distinct.join(of, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _shingles(text: str | None, size: int) -> set[bytes]:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return {b" ".join(r) for r in zip(*[words[k:] for k in range(size)], strict=False)} if len(words) >= size else {b" ".join(words)} if words else set()


def band_keys(text: str | None) -> list[int]:
    """A key for each band of MinHashes over the text's shingles; none without words."""
    found = _shingles(text, WORDS)
    if not found:
        return []
    hashes = np.fromiter((xxhash.xxh64_intdigest(x, 43) for x in found), np.uint64, len(found))
    rng = np.random.default_rng(7)
    times, plus = rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 1 << 10):
        mixed = hashes[at : at + (1 << 10), None] * times + plus
        # The low bits of a product depend on the low bits of its factors only.
        np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=0), out=least)
    return [xxhash.xxh64_intdigest(x.tobytes(), k) - (1 << 63) for k, x in enumerate(least.reshape(BANDS, ROWS))]


def alike_links(held: DataFrame, texts: DataFrame, alike: float = ALIKE) -> DataFrame:
    """Links (u, v) between the fp of held (id, fp, keys) whose texts (id, text) have a Jaccard similarity of at least ``alike``.

    Every text meets two others of each of its bands, so near copies are linked over chains rather than pair by pair.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            u, v, a, b = (c.to_pylist() for c in batch.columns)
            out = []
            for i in range(len(u)):
                x, y = _shingles(a[i], WORDS), _shingles(b[i], WORDS)
                both = len(x & y) if alike * max(len(x), len(y)) <= min(len(x), len(y)) else 0
                if both and both >= alike * (len(x) + len(y) - both):
                    out.append((u[i], v[i]))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], ["u", "v"])

    member = held.select("id", "fp", F.posexplode("keys").alias("band", "key"))
    ordered = F.struct(F.xxhash64("id", F.col("band") % ORDERS).alias("h"), "id", "fp")
    ends = member.groupBy("band", "key").agg(F.min(ordered).alias("lo"), F.max(ordered).alias("hi")).filter("lo.id <> hi.id")
    met = member.join(ends, ["band", "key"]).select("id", "fp", F.explode(F.array("lo", "hi")).alias("o"))
    pairs = met.filter("fp <> o.fp").select(F.col("id").alias("a"), F.col("fp").alias("u"), F.col("o.id").alias("b"), F.col("o.fp").alias("v"))
    pairs = written(pairs.select(F.when(F.col("a") < F.col("b"), F.struct("a", "u", "b", "v")).otherwise(F.struct(F.col("b").alias("a"), F.col("v").alias("u"), F.col("a").alias("b"), F.col("u").alias("v"))).alias("p")).select("p.*").distinct(), "near-pairs")
    needed = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    known = written(texts.join(needed, "id", "left_semi").groupBy("id").agg(F.first("text").alias("text")), "near-texts")
    one = pairs.join(known.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    two = one.join(known.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return two.select("u", "v", "ta", "tb").mapInArrow(compare, "u long, v long")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay: exactly one of each group of rows linked by fingerprints (3 bits) or by Jaccard similarity.

    It is the first by doc_id (null last), then by the text's digest, then by a hash of the whole row; of rows that are
    equal in all three any one. A row is known by these three and not by its doc_id, which may be null or repeat. Texts
    without words (null, empty, white space) have fingerprint 0 and are one group; an empty table gives no rows; columns of
    any other name and kind stay as they are.
    """
    spare = lambda k: f"__stay_{k}"
    key = {"none": F.col("doc_id").isNull(), "id": F.col("doc_id").cast("long"), "digest": F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("")), "row": F.xxhash64(*docs.columns)}
    keyed = docs.select("*", *[c.alias(spare(k)) for k, c in key.items()], F.xxhash64("text").alias(spare("text")))
    fps = written(fingerprints(keyed, carry=(*map(spare, key), spare("text")), keys=True), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min(F.struct(*map(spare, key))).alias("first")), "distinct-fingerprints")
    near = alike_links(fps.select(F.col(spare("text")).alias("id"), "fp", "keys"), docs.select(F.xxhash64("text").alias("id"), "text"))
    of = components(links(distinct.select("fp")).unionByName(near)).withColumnRenamed("node", "fp")
    stay = distinct.join(of, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("s")).select("s.*").drop(spare("none"))
    # Equal rows are reduced to one before they are dealt by their key, so that a row that repeats often is no single task.
    names = [spare(k) for k in key if k != "none"]
    one = keyed.groupBy(*names).agg(F.first(F.struct(*docs.columns)).alias("kept")).alias("one")
    same = [F.col(f"one.{k}").eqNullSafe(F.col(f"stay.{k}")) for k in names]
    return one.join(stay.alias("stay"), same, "left_semi").select("kept.*")
