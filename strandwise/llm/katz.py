"""Scoring texts by a Katz backoff language model of word pairs that is counted and evaluated on Spark.

P(w | v) = d(c(v w)) * c(v w) / T(v)        for a pair seen in training, with the Good-Turing discount d of its count,
P(w | v) = weight(v) * P(w)                 for any other word, where the weight is what the seen pairs of v leave,
                                            divided by the P(w) of all words that v does not precede, summed exactly;
P(w)     = d(c(w)) * c(w) / N               and what that leaves is the probability of the one event "unknown word".

Texts are tokenized once, into chunks of token codes with a dictionary each. Chunks ask the word parts (by hash of the
word) for counts and ids, then the pair parts (by hash of the first word; one that is very frequent is dealt over as many
parts as its count asks for) for the counts of their distinct pairs. Each part adds up what all chunks bring, stores its
n-gram counts, and answers in the order it was asked. All tables are written in the shared folder; a task holds one
chunk or one part, whose sizes are bounded, however large or skewed the corpus is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm.common import table
from strandwise.scratch import scratch, written

#: Counts up to this are discounted; UTF-8 bytes of text in a chunk (one text of more is a chunk of its own).
K, CHUNK = 5, 8 << 20
#: Entries that a part holds at most, by and large; occurrences of a first word beyond which its pairs are dealt over parts.
ENTRIES, SPLIT = 1_000_000, 400_000
#: The token at the end of each text: no word is empty. Ids: the context at a text's beginning, a word unseen in training, words from FIRST on.
END = ""
BEGIN, UNKNOWN, FIRST = 0, 1, 2

CHUNKS = "chunk long, n_learned long, n_words long, n_tokens long, ids binary, no_id binary, held binary, sizes binary, codes binary, words binary, trained binary"
#: What goes to a chunk: its texts' ids (kind -2) and tokens (-1), answers of word parts (0), of pair parts (1), and the weights it needs (2, a row each).
TO_CHUNK = "chunk long, kind int, part int, a binary, b binary, c binary, v long, weight double, total long"
FOUND = "kind int, chunk long, part int, a binary, b binary, c binary, stats array<long>, v long, lower double"


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes: the planes of small numbers' high bytes take next to nothing."""
    planes = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()


def pack_words(words: Sequence[str]) -> bytes:
    """Words hold no line feed."""
    return zstandard.ZstdCompressor(level=3).compress("\n".join(words).encode())


def unpack_words(blob: bytes) -> list[str]:
    return zstandard.ZstdDecompressor().decompress(blob).decode().split("\n")


def _parts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each 64-bit hash, rising with it."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _hashed(words: Sequence[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode(), 11) for w in words), np.uint64, len(words))


def _runs(cuts: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, from, past) of each run of a sorted array."""
    at = np.flatnonzero(np.diff(cuts)) + 1
    lo, hi = np.concatenate([[0], at]), np.concatenate([at, [len(cuts)]])
    return [(int(cuts[a]), int(a), int(b)) for a, b in zip(lo, hi, strict=True)] if len(cuts) else []


def _pairs(codes: np.ndarray, sizes: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (word before, word) of a chunk as one number each, and which of them every token is. ``begin`` is the code before a text."""
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    before[np.cumsum(sizes) - sizes] = begin
    return np.unique(before * (begin + 1) + codes, return_inverse=True)


def _chunk(texts: pa.Array, ids: list, held: np.ndarray, number: int) -> dict:
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))[real]
    coded = flat.filter(pa.array(real)).dictionary_encode()
    words = [*coded.dictionary.to_pylist(), END]
    sizes = np.bincount(of, minlength=len(texts)) + 1
    codes = np.full(sizes.sum(), len(words) - 1, np.int64)
    ends = np.zeros(len(codes), bool)
    ends[np.cumsum(sizes) - 1] = True
    codes[~ends] = coded.indices.to_numpy()
    order = np.argsort(hashes := _hashed(words), kind="stable")
    codes = np.argsort(order)[codes]
    trained = np.bincount(codes[np.repeat(~held, sizes)], minlength=len(words))
    none = np.array([i is None for i in ids])
    return {
        "chunk": number, "n_learned": int((~held).sum()), "n_words": len(words), "n_tokens": len(codes),
        "ids": pack(np.array([i or 0 for i in ids], np.int64)), "no_id": pack(none), "held": pack(held), "sizes": pack(sizes),
        "codes": pack(codes), "words": pack_words([words[i] for i in order]), "trained": pack(trained),
    }


ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], ARROW[k]) for n, k in fields], [n for n, _ in fields])


def chunked(docs: DataFrame, held: Column) -> DataFrame:
    """docs (doc_id, text) as written chunks of token codes; ``held`` marks texts that nothing is learned from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, ids, out = batch.column(1), batch.column(0).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.binary_length(texts).to_numpy())
            lo = 0
            while lo < len(ids):
                past = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHUNK, side="right")))
                yield _batch([_chunk(texts.slice(lo, past - lo), ids[lo:past], out[lo:past], number)], CHUNKS)
                lo, number = past, number + 1

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(held, F.lit(False)).alias("held")).mapInArrow(run, CHUNKS), "katz-chunks")


def discounts(seen: Sequence[int]) -> np.ndarray:
    """Good-Turing discounts d[0..K] (d[0] unused) from the numbers of n-grams seen 1 .. K+1 times, in Katz's form.

    Where the numbers give none between 0 and 1 (too few n-grams, none of some count), that count is discounted by the
    constant that the n-grams seen once and twice suggest instead.
    """
    n = [float(x) for x in seen]
    constant = n[0] / (n[0] + 2 * n[1]) if n[0] > 0 and n[1] > 0 else 0.5
    out = np.ones(K + 1)
    rest = (K + 1) * n[K] / n[0] if n[0] > 0 else 1.0
    for r in range(1, K + 1):
        d = ((r + 1) * n[r] / (r * n[r - 1]) - rest) / (1 - rest) if n[r - 1] > 0 and rest != 1 else 0.0
        out[r] = d if 0 < d < 1 else 1 - constant / r
    return out


def discounted(d: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.where(count <= K, d[np.minimum(count, K)], 1.0) * count


class Unigrams:
    """P of a word by its count, and of the one unknown word. ``seen``: words seen 1 .. K+1 times."""

    def __init__(self, seen: Sequence[int], total: int):
        self.d = discounts(seen)
        lost = sum((1 - self.d[r]) * r * seen[r - 1] for r in range(1, K + 1))
        self.total = total if lost > 0 else total + 1  # where no count is discounted, one occurrence is set aside
        self.unknown = (lost if lost > 0 else 1) / self.total

    def __call__(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, discounted(self.d, count) / self.total, self.unknown)


def _word_requests(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, n = unpack_words(blob), unpack(counts)
                rows = [{"part": p, "chunk": chunk, "a": pack_words(words[lo:hi]), "b": pack(n[lo:hi])} for p, lo, hi in _runs(_parts_of(_hashed(words), parts))]
                yield _batch(rows, "part int, chunk long, a binary, b binary")

    return run


def _word_part(got: pa.Table) -> pa.Table:
    """Adds up one part of the words. Answers (kind 0): place in the part by falling count (-1: not in training), count. Kind 1: sums. Kind 2: the words."""
    got = got.sort_by("chunk")
    lists, counts = [unpack_words(x) for x in got.column("a").to_pylist()], [unpack(x) for x in got.column("b").to_pylist()]
    part = got.column("part")[0].as_py()
    coded = pa.array([w for x in lists for w in x], pa.string()).dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary
    total = np.zeros(len(words), np.int64)
    np.add.at(total, codes, np.concatenate(counts))
    order = pc.sort_indices(pa.table({"n": total, "w": words}), [("n", "descending"), ("w", "ascending")]).to_numpy()
    known = int((total > 0).sum())
    place = np.full(len(words), -1, np.int64)
    place[order[:known]] = np.arange(known)
    rows, at = [], 0
    for chunk, x in zip(got.column("chunk").to_pylist(), lists, strict=True):
        mine = codes[at : at + len(x)]
        rows.append({"kind": 0, "chunk": chunk, "part": part, "a": pack(place[mine]), "b": pack(total[mine])})
        at += len(x)
    rows.append({"kind": 1, "stats": [*(int((total == r).sum()) for r in range(1, K + 2)), known, int(total.sum())]})
    if known:
        rows.append({"kind": 2, "part": part, "a": pack_words(words.take(pa.array(order[:known])).to_pylist()), "b": pack(total[order[:known]])})
    return pa.Table.from_batches([_batch(rows, FOUND)])


def _spread(v: np.ndarray, w: np.ndarray, count: np.ndarray, parts: int, split: int) -> np.ndarray:
    """The part of each pair: by its first word alone, or, where that has a large count, by one of several shares of its second words."""
    share = w % (1 + count // split)
    mixed = (v.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (share.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return _parts_of(mixed ^ (mixed >> np.uint64(32)), parts)


class Chunk:
    """A chunk with the answers that it has got so far."""

    def __init__(self, got: pa.Table, word_parts: int, pair_parts: int, n_docs: int, split: int):
        rows = got.filter(pc.less(got.column("kind"), 2)).select(["kind", "part", "a", "b", "c"]).sort_by([("kind", "ascending"), ("part", "ascending")]).to_pylist()
        own, answers = next(r for r in rows if r["kind"] == -1), [r for r in rows if r["kind"] == 0]
        self.codes, self.sizes, self.held = unpack(own["a"]), unpack(own["b"]), unpack(own["c"]).astype(bool)
        place, self.count = (np.concatenate([unpack(r[k]) for r in answers]) for k in "ab")
        part = np.repeat([r["part"] for r in answers], [len(unpack(r["a"])) for r in answers])
        self.gid = np.where(place >= 0, FIRST + place * word_parts + part, UNKNOWN)
        begin = len(self.gid)
        self.keys, self.of = _pairs(self.codes, self.sizes, begin)
        self.before, self.word = self.keys // (begin + 1), self.keys % (begin + 1)
        self.v, self.w = np.append(self.gid, BEGIN)[self.before], self.gid[self.word]
        # Pairs with an unknown second word are asked for too: they need the weight of the first.
        self.asked = np.flatnonzero(self.v != UNKNOWN)
        to = _spread(self.v[self.asked], self.w[self.asked], np.append(self.count, n_docs)[self.before[self.asked]], pair_parts, split)
        self.asked = self.asked[order := np.argsort(to, kind="stable")]
        self.to = to[order]
        self.pairs = [r for r in rows if r["kind"] == 1]


def _pair_requests(word_parts: int, pair_parts: int, n_docs: int):
    def run(key: tuple, got: pa.Table) -> pa.Table:
        c = Chunk(got, word_parts, pair_parts, n_docs, SPLIT)
        trained = np.bincount(c.of[np.repeat(~c.held, c.sizes)], minlength=len(c.keys))
        rows = []
        for p, lo, hi in _runs(c.to):
            at = c.asked[lo:hi]
            rows.append({"part": p, "chunk": key[0].as_py(), "a": pack(c.v[at]), "b": pack(c.w[at]), "c": pack(trained[at]), "d": pack(c.count[c.word[at]])})
        return pa.Table.from_batches([_batch(rows, REQUESTS)])

    return run


REQUESTS = "part int, chunk long, a binary, b binary, c binary, d binary"


def _pair_part(unigrams: Unigrams):
    def run(got: pa.Table) -> pa.Table:
        """Adds up one part of the pairs. Answers (kind 0): counts. Kind 1: what the seen pairs of a first word add up to. Kind 2: pairs and counts. Kind 3: first words whose weight a chunk needs."""
        got = got.sort_by("chunk")
        part, chunks = got.column("part")[0].as_py(), got.column("chunk").to_pylist()
        v, w, n, lower = (np.concatenate([unpack(x) for x in got.column(k).to_pylist()]) for k in "abcd")
        sizes = [len(unpack(x)) for x in got.column("a").to_pylist()]
        order = np.lexsort((w, v))
        new = np.ones(len(v), bool)
        new[1:] = (np.diff(v[order]) != 0) | (np.diff(w[order]) != 0)
        of = np.empty(len(v), np.int64)
        of[order] = np.cumsum(new) - 1
        first = order[new]
        total = np.add.reduceat(n[order], np.flatnonzero(new))
        seen = total > 0
        sv, st = v[first][seen], total[seen]
        firsts, at = np.unique(sv, return_index=True)
        rows = []
        if len(firsts):
            times = np.stack([np.add.reduceat((st == r).astype(np.int64), at) for r in range(1, K + 2)], 1)
            big = np.add.reduceat(np.where(st > K + 1, st, 0), at)
            below = np.add.reduceat(unigrams(lower[first][seen]), at)
            rows += [{"kind": 1, "v": a, "stats": [*b, c], "lower": d} for a, b, c, d in zip(firsts.tolist(), times.tolist(), big.tolist(), below.tolist(), strict=True)]
            rows.append({"kind": 2, "part": part, "a": pack(sv), "b": pack(w[first][seen]), "c": pack(st)})
            plain = firsts[times[:, :K].sum(1) == 0]
        else:
            plain = firsts
        lo = 0
        for chunk, size in zip(chunks, sizes, strict=True):
            mine = total[of[lo : lo + size]]
            rows.append({"kind": 0, "chunk": chunk, "part": part, "a": pack(mine)})
            own = v[lo : lo + size]
            rows += [{"kind": 3, "chunk": chunk, "v": x} for x in np.unique(own[(mine == 0) | np.isin(own, plain)]).tolist()]
            lo += size
        return pa.Table.from_batches([_batch(rows, FOUND)])

    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scores(word_parts: int, pair_parts: int, n_docs: int, unigrams: Unigrams, n: int, vocabulary: int, d: np.ndarray):
    def run(got: pa.Table) -> pa.Table:
        c = Chunk(got, word_parts, pair_parts, n_docs, SPLIT)
        own = got.filter(pc.equal(got.column("kind"), -2)).to_pylist()[0]
        ids, none = unpack(own["a"]), unpack(own["b"])
        need = got.filter(pc.equal(got.column("kind"), 2)).select(["v", "weight", "total"]).sort_by("v")
        nv, weight, whole = (need.column(k).to_numpy() for k in ("v", "weight", "total"))
        # One probability for every distinct pair: seen, backed off, or (unknown word before it) of the word alone.
        p = unigrams(c.count[c.word])
        count = np.zeros(len(c.keys), np.int64)
        if c.pairs:
            count[c.asked] = np.concatenate([unpack(r["a"]) for r in c.pairs])
        total = np.append(c.count, n_docs)[c.before]
        at = np.minimum(np.searchsorted(nv, c.v), max(len(nv) - 1, 0))
        met = (nv[at] == c.v) if len(nv) else np.zeros(len(c.v), bool)
        scale = np.ones(len(c.v))
        if len(nv):
            total = np.where(met, whole[at], total)
            scale = np.where(met, weight[at], 1.0)
        seen = count > 0
        p = np.where(seen, discounted(d, count) / np.maximum(total, 1), scale * p)
        logs = np.log10(p)[c.of]
        counts = c.count[c.codes]
        starts = np.cumsum(c.sizes) - c.sizes
        known = np.add.reduceat((counts > 0).astype(np.int64), starts)
        base = np.add.reduceat(np.log10((counts + 1) / (n + vocabulary + 1)), starts)
        return pa.table([pa.array(ids, pa.int64(), mask=none.astype(bool)), pa.array(c.held), pa.array(c.sizes), pa.array(known), pa.array(base), pa.array(np.add.reduceat(logs, starts))], names=[f.split()[0] for f in SCORES.split(", ")])

    return run


def _by_kind(df: DataFrame, name: str) -> dict[int, DataFrame]:
    """df written in a folder for each kind, so that a reader of one kind reads no other."""
    path = scratch(df.sparkSession, name)
    df.write.partitionBy("kind").parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    return {k: read.filter(F.col("kind") == k) for k in range(4)}


class Model:
    """What was counted: tables in the shared folder.

    words: part, a (words by falling count), b (counts); pairs: part, a and b (ids of the words), c (counts), in the
    packed forms of this module; weights: v (id of the first word), weight, total. A word's id is FIRST + its place *
    parts + part. n, vocabulary, n_docs: tokens, distinct tokens and texts of the training rows.
    """

    def __init__(self, **parts):
        self.__dict__.update(parts)


def fit_and_score(docs: DataFrame, held: Column) -> tuple[DataFrame, Model]:
    """Scores (doc_id, held_out, n_tokens, n_known, base_score, score) of all rows of docs, and the model of those not held out.

    A null text is empty: its end alone; a null id stays null and counts as not held out if ``held`` is null there. Rows
    that repeat count and are scored each. Other columns are ignored. Without training rows the model knows one event
    only, so that both scores are 0; an empty table gives no rows.
    """
    spark = docs.sparkSession
    chunks = chunked(docs, held)
    fewest = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_words, n_tokens, n_docs = chunks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_words", "n_tokens", "n_learned")]).first()
    word_parts, pair_parts = max(fewest, -(-n_words // ENTRIES)), max(fewest, -(-n_tokens // ENTRIES))

    requests = chunks.select("chunk", "words", "trained").mapInArrow(_word_requests(word_parts), "part int, chunk long, a binary, b binary")
    word = _by_kind(requests.groupBy("part").applyInArrow(_word_part, FOUND), "katz-words")
    stats = word[1].agg(*[F.coalesce(F.sum(F.get("stats", F.lit(i))), F.lit(0)) for i in range(K + 3)]).first()
    seen, vocabulary, n = list(stats[: K + 1]), int(stats[K + 1]), int(stats[K + 2])
    unigrams = Unigrams(seen, n)
    to_chunk = [f.split()[0] for f in TO_CHUNK.split(", ")]
    fill = lambda df: df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in (f.split() for f in TO_CHUNK.split(", "))])
    own = fill(chunks.select("chunk", F.lit(-1).alias("kind"), F.col("codes").alias("a"), F.col("sizes").alias("b"), F.col("held").alias("c")))
    asked = own.unionByName(fill(word[0].select("chunk", "kind", "part", "a", "b")))
    pair = _by_kind(asked.groupBy("chunk").applyInArrow(_pair_requests(word_parts, pair_parts, n_docs), REQUESTS).groupBy("part").applyInArrow(_pair_part(unigrams), FOUND), "katz-pairs")

    sums = pair[1].groupBy("v").agg(*[F.sum(F.get("stats", F.lit(i))).alias(f"n{i + 1}") for i in range(K + 2)], F.sum("lower").alias("lower"))
    sums = written(sums, "katz-sums")
    times = sums.agg(*[F.coalesce(F.sum(f"n{r}"), F.lit(0)) for r in range(1, K + 2)]).first()
    d = discounts(list(times))
    lost = sum(((1 - float(d[r])) * r * F.col(f"n{r}") for r in range(1, K + 1)), F.lit(0.0))
    count = sum((r * F.col(f"n{r}") for r in range(1, K + 2)), F.col(f"n{K + 2}"))
    plain = sum((F.col(f"n{r}") for r in range(1, K + 1)), F.lit(0)) == 0
    total = F.when(plain, count + 1).otherwise(count)
    left = F.when(plain, F.lit(1.0)).otherwise(lost) / total
    # Never below the probability of the unknown word, which no pair holds: rounding errors of long sums end there.
    unseen = F.greatest(1 - F.col("lower"), F.lit(float(unigrams.unknown)))
    weights = written(sums.select("v", (left / unseen).alias("weight"), total.cast("long").alias("total")), "katz-weights")

    needed = pair[3].select("chunk", "v").join(weights, "v").select("chunk", F.lit(2).alias("kind"), "v", "weight", "total")
    names = fill(chunks.select("chunk", F.lit(-2).alias("kind"), F.col("ids").alias("a"), F.col("no_id").alias("b")))
    answers = fill(pair[0].select("chunk", F.lit(1).alias("kind"), "part", "a"))
    every = names.unionByName(asked).unionByName(answers).unionByName(fill(needed)).select(*to_chunk)
    scored = every.groupBy("chunk").applyInArrow(_scores(word_parts, pair_parts, n_docs, unigrams, n, vocabulary, d), SCORES)
    model = Model(words=word[2].select("part", "a", "b"), pairs=pair[2].select("part", "a", "b", "c"), weights=weights, n=n, vocabulary=vocabulary, n_docs=n_docs, unigrams=unigrams, discounts=d)
    return scored, model


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the model of the documents whose crc32(doc_id) mod 7 is not 2."""
    held = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 2
    scored, model = fit_and_score(table(spark, sf_dir, "documents"), held)
    return scored.withColumn("train_tokens", F.lit(model.n).cast("long"))
