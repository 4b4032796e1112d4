"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary passages, and one on the parts of words that set toxic documents
apart (a word, or a beginning of it, is far more common in toxic than in ordinary documents of the sample). A window is
one word of the text or one beginning of it, repeated up to a least size, so that what matches it does not depend on its
neighbours. The toxic dictionary holds its commonest parts as whole windows: a window that is one of them becomes a
single match, any other saves a few bytes at most. Every window is compressed twice, on the ordinary dictionary alone
and on the toxic one followed by it, so that both know ordinary language equally well and the bytes saved measure toxic
language. How many different words save how many bytes, counted and as a share of all, gives the score through a
logistic calibration.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm.common import held_out, labelled_sample, table, worker_store

#: Labelled documents of each class that training takes at most, and ordinary windows for the dictionary.
TRAIN_ROWS, TRAIN_WINDOWS = 2_000, 60_000
#: Least bytes of a window; sizes of the dictionaries' contents; bytes of the ordinary dictionary's training windows.
WINDOW, ORDINARY_BYTES, TOXIC_BYTES, PASSAGE = 32, 14_000, 400, 24
#: A word sets toxic texts apart from this ratio of document shares, and this share of the toxic documents, on. So does a
#: beginning of it: its beginnings are those of STEM to MEASURED - 1 bytes.
LIFT, LEAST_SHARE, LEAST_DOCS, STEM, MEASURED = 8.0, 0.03, 4, 3, 64
#: Telling parts of words whose windows the toxic dictionary holds whole.
WHOLE = 60
WORDS = re.compile(r"\w+")
#: Words whose saved bytes a worker remembers (those of at most MEASURED bytes); it then starts afresh.
REMEMBERED = 200_000
#: Bytes saved from which a window counts, and steps and rate of the calibration.
SAVED, STEPS, RATE = (2, 3, 4, 5, 6, 8, 10, 12), 3_000, 0.5
#: Least bytes of a match.
MATCH = 4
#: Short matches are what tells words apart; the chain table (2^15 places) holds every place of both contents.
PARAMETERS = {"window_log": 15, "hash_log": 14, "chain_log": 15, "search_log": 4, "min_match": MATCH, "target_length": 32, "strategy": zstandard.STRATEGY_GREEDY, "write_content_size": False, "write_checksum": False, "write_dict_id": False, "format": zstandard.FORMAT_ZSTD1_MAGICLESS}


def runs(text: str) -> list[bytes]:
    """The words of a text: runs of letters, digits and underscores, lower-cased."""
    return [w.encode("utf-8", "surrogatepass") for w in WORDS.findall(text.lower())]


def passages(words: Sequence[bytes]) -> list[bytes]:
    """Consecutive passages of whole words, each of PASSAGE bytes or a little more; the last may be short."""
    out: list[bytes] = []
    part: list[bytes] = []
    size = 0
    for word in words:
        part.append(word)
        size += len(word) + 1
        if size >= PASSAGE:
            out.append(b" %b " % b" ".join(part))
            part, size = [], 0
    if part:
        out.append(b" %b " % b" ".join(part))
    return out


def window(word: bytes) -> bytes:
    """The word between spaces, once, and again until WINDOW bytes are reached."""
    return b" " + (word + b" ") * max(1, -(-(WINDOW - 1) // (len(word) + 1)))


def stems(word: bytes) -> list[bytes]:
    """The word's beginnings, itself last."""
    return [*(word[:k] for k in range(STEM, min(len(word), MEASURED))), word]


class Distance:
    """Bytes that the toxic dictionary saves on each window of a text."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        parameters = zstandard.ZstdCompressionParameters(**PARAMETERS)
        both = [zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for d in (ordinary, toxic + ordinary)]
        for d in both:
            d.precompute_compress(compression_params=parameters)
        self.plain, self.toxic = (zstandard.ZstdCompressor(dict_data=d, compression_params=parameters).compress for d in both)
        joined = toxic + ordinary[: MATCH - 1]
        self.grams = {joined[i : i + MATCH] for i in range(len(toxic))}
        self.known: dict[str, int] = {}

    def _measured(self, part: bytes) -> int:
        w = window(part)
        # Without a least match in the toxic content, which stands before the ordinary one and so moves no distance to it,
        # the compressor finds the same matches with both dictionaries and gives the same length.
        if not any(w[i : i + MATCH] in self.grams for i in range(len(part) + 1)):
            return 0
        return len(self.plain(w)) - len(self.toxic(w))

    def saved(self, word: str) -> int:
        """The most that a window of the word, or of one of its beginnings, saves."""
        found = self.known.get(word)
        if found is None:
            own = word.encode("utf-8", "surrogatepass")
            found = max(map(self._measured, stems(own)))
            if len(own) <= MEASURED:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[word] = found
        return found

    def features(self, text: str) -> list[float]:
        saved = np.array([self.saved(w) for w in set(WORDS.findall(text.lower()))] or [0])
        counts = [int((saved >= k).sum()) for k in SAVED]
        share = len(saved) + 3
        return [*(math.log1p(c) for c in counts), *(c / share for c in counts), saved.max() / 10, float(np.maximum(saved - 2, 0).sum()) / share, math.log(len(saved) + 1)]


def _content(samples: list[bytes], size: int) -> bytes:
    """The content part of a trained dictionary (its best segments come last); plain samples where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size + 500, samples).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def train(rows: Sequence[tuple[str, int]], seed: int = 7) -> tuple[bytes, bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(ordinary content, toxic content, feature means, deviations, calibration weights with the bias last)."""
    rows = list(dict(rows).items())  # copies of a text would count as many
    words = [(runs(text), y) for text, y in rows]
    seen = (Counter(), Counter())
    for found, y in words:
        seen[y].update({s for w in set(found) for s in stems(w)})
    n = [sum(y == k for _, y in rows) for k in (0, 1)]
    least = max(LEAST_DOCS, LEAST_SHARE * n[1])
    apart = {w for w, c in seen[1].items() if c >= least and (c + 0.5) / (n[1] + 1) > LIFT * (seen[0][w] + 0.5) / (n[0] + 1)}
    rng = np.random.default_rng(seed)
    plain = [w for found, y in words if not y for w in passages(found)]
    plain = [plain[i] for i in rng.permutation(len(plain))[:TRAIN_WINDOWS]]
    # Of a word's telling parts the one that covers the most bytes of toxic documents stands for it.
    parts = [max(telling, key=lambda s: seen[1][s] * len(s)) for found, y in words if y for w in sorted(set(found)) if (telling := [s for s in stems(w) if s in apart])]
    marked = [window(s) for s in parts]
    ordinary = _content(plain, ORDINARY_BYTES)
    toxic = _content(marked * (1 + 4_000 // len(marked)), TOXIC_BYTES) if marked else b""
    # Trained segments cut windows short; those of the most common parts follow whole, the most common last.
    toxic += b"".join(window(s) for s, _ in reversed(sorted(Counter(parts).items(), key=lambda c: (-c[1], c[0]))[:WHOLE]))
    distance = Distance(ordinary, toxic)
    x = np.array([distance.features(text) for text, _ in rows])
    y = np.array([label for _, label in rows], float)
    mean, deviation = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / deviation, np.ones(len(x))])
    weights = np.zeros(z.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-(z * weights).sum(1)))
        weights -= RATE * ((z * (p - y)[:, None]).mean(0) + 1e-3 * weights)
    return ordinary, toxic, mean, deviation, weights


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every whole text, whatever its length; null counts as empty.

    Every row has one row, repeats too; a null doc_id is not held out. Other columns of docs are ignored. Without labels of
    both kinds every score is 0; an empty table gives no rows.
    """
    sample = [(r["text"], r["y"]) for r in labelled_sample(docs, labels, "toxic", rows).orderBy("doc_id").collect()]  # bounded, see there
    fitted = None
    if {y for _, y in sample} == {0, 1}:
        fitted = train(sample)
        # The sample has equal shares at most; the bias goes back to the classes' own odds.
        odds = labels.filter(~held_out()).agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
        distinct = dict(sample)
        drawn = [sum(v == y for v in distinct.values()) for y in (1, 0)]
        fitted[4][-1] += math.log((odds[0] + 1) / (odds[1] + 1)) - math.log((drawn[0] + 1) / (drawn[1] + 1))
    model = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model.value is not None:
            ordinary, toxic, mean, deviation, weights = model.value
            kept, key = worker_store("toxicity"), hashlib.sha256(b"%d %b%b" % (len(ordinary), ordinary, toxic)).digest()
            if key not in kept:
                kept.clear()
                kept[key] = Distance(ordinary, toxic)
            distance = kept[key]
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            if model.value is not None and batch.num_rows:
                x = np.array([distance.features(t) for t in batch.column(1).to_pylist()])
                margin = ((x - mean) / deviation * weights[:-1]).sum(1) + weights[-1]
                scores = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
