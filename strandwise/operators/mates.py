"""Merging the mates of a pair where their ends overlap, mismatches tolerated, and cutting adapters off.

A correlation of two classes of bases (fast Fourier transforms over whole numbers, rounded back to them) bounds the
mismatches of all overlaps of a pair from below; the few that may do are compared base by base. Where very many may do,
as in repeats, mismatches and quality-weighted scores of all overlaps come from correlations too, so that a pair costs
n log n whatever it repeats. Pairs of similar length are transformed together.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.batches import slices
from strandwise.functions.reads import reverse_complement

#: Points that are transformed at once, and the best quality of a merged base.
POINTS, BEST = 1 << 20, 41
#: Bases of a pair's overlaps that are compared one by one, by the length of its shorter mate, before all overlaps are transformed instead.
DIRECT = 32
BASES = b"ACGT"
#: Classes of bases: A and G, C and T, others.
_CLASS = np.zeros(256, np.int8)
_CLASS[list(b"AG")], _CLASS[list(b"CT")] = 1, -1


def _codes(texts: list[str], size: int) -> np.ndarray:
    out = np.zeros((len(texts), size), np.uint8)
    for row, text in zip(out, texts, strict=True):
        row[: len(text)] = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
    return out


def _values(quals: list[str], lengths: list[int], size: int, base: int) -> np.ndarray:
    """Qualities above 0; what a shorter quality string lacks is 0."""
    q = _codes([x[:n] for x, n in zip(quals, lengths, strict=True)], size).astype(np.int64)
    return np.where(q > 0, np.maximum(q - base, 0), 0)


def overlap_scores(ones: list[str], others: list[str], q1: list[str], q2: list[str], base: int = 33) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each pair, by the length of the overlap from 0 to the shorter mate: bases compared, mismatches, and the score.

    The end of one lies over the beginning of other. Bases other than A, C, G and T are not compared. Each compared pair of
    bases weighs the sum of its two qualities, for the overlap if they agree and against it if not.
    """
    size = 1 << int(max(len(a) + len(b) for a, b in zip(ones, others, strict=True)) + 1 - 1).bit_length()
    a, b = _codes(ones, size), _codes(others, size)
    wa, wb = _values(q1, [len(x) for x in ones], size, base), _values(q2, [len(x) for x in others], size, base)
    spectrum = lambda x: np.fft.rfft(x.astype(np.float64), axis=1)
    same = weight_same = 0
    valid = [np.isin(x, np.frombuffer(BASES, np.uint8)) for x in (a, b)]
    for c in BASES:
        ia, ib = spectrum(a == c), np.conj(spectrum(b == c))
        same = same + ia * ib
        weight_same = weight_same + spectrum((a == c) * wa) * ib + ia * np.conj(spectrum((b == c) * wb))
    va, vb = spectrum(valid[0]), np.conj(spectrum(valid[1]))
    every = va * vb
    weight = spectrum(valid[0] * wa) * vb + va * np.conj(spectrum(valid[1] * wb))
    same, every, weight_same, weight = (np.rint(np.fft.irfft(x, size, axis=1)).astype(np.int64) for x in (same, every, weight_same, weight))
    out = []
    for i, (x, y) in enumerate(zip(ones, others, strict=True)):
        at = (len(x) - np.arange(min(len(x), len(y)) + 1)) % size
        out.append((every[i, at], every[i, at] - same[i, at], 2 * weight_same[i, at] - weight[i, at]))
    return out


def chosen_overlap(scores: tuple[np.ndarray, np.ndarray, np.ndarray], least: int, differ: int, rate: float) -> tuple[int, int]:
    """(overlap, mismatches) of the best score among the overlaps that are long and alike enough; of equal scores the longest; (0, 0) without one."""
    compared, mismatches, score = scores
    n = np.arange(len(score))
    fits = (n >= max(least, 1)) & (compared >= least) & (mismatches <= differ) & (mismatches <= rate * n)
    if not fits.any():
        return 0, 0
    best = score[fits].max()
    at = int(n[fits & (score == best)].max())
    return at, int(mismatches[at])


def possible_overlaps(ones: list[str], others: list[str], least: int, differ: int, rate: float) -> list[np.ndarray]:
    """For each pair the lengths of overlap, rising, that may be long and alike enough: all that are, and few others where nothing repeats.

    Bases of different classes differ, so the mismatches are no fewer than the compared bases of different classes. Only the
    last bases of one and the first of other, as many as the shorter has, can lie over each other.
    """
    most = [min(len(x), len(y)) for x, y in zip(ones, others, strict=True)]
    size = 1 << int(2 * max(most) - 1).bit_length()
    a, b = _CLASS[_codes([x[len(x) - m :] for x, m in zip(ones, most, strict=True)], size)], _CLASS[_codes([y[:m] for y, m in zip(others, most, strict=True)], size)]
    met = lambda x, y: np.rint(np.fft.irfft(np.fft.rfft(x.astype(np.float64), axis=1) * np.conj(np.fft.rfft(y.astype(np.float64), axis=1)), size, axis=1))
    alike = met(a, b)
    whole = all(a[i, :m].all() and b[i, :m].all() for i, m in enumerate(most))
    every = None if whole else met(a != 0, b != 0)
    out = []
    for i, m in enumerate(most):
        n = np.arange(max(least, 1), m + 1)
        at = m - n
        compared = n if every is None else every[i, at]
        apart = (compared - alike[i, at]) / 2
        out.append(n[(compared >= least) & (apart <= differ) & (apart <= rate * n)])
    return out


def best_overlap(one: str, other: str, q1: str, q2: str, lengths: np.ndarray, least: int, differ: int, rate: float, base: int = 33) -> tuple[int, int]:
    """What ``chosen_overlap`` gives, by comparing the bases of the overlaps of the given lengths (rising)."""
    x, y = (np.frombuffer(t.encode("latin-1", "replace"), np.uint8) for t in (one, other))
    wx, wy = (_values([q], [len(t)], len(t), base)[0] for q, t in ((q1, one), (q2, other)))
    best, found = None, (0, 0)
    for n in lengths.tolist():
        a, b = x[len(x) - n :], y[:n]
        compared = (_CLASS[a] != 0) & (_CLASS[b] != 0)
        differing = compared & (a != b)
        d = int(differing.sum())
        if int(compared.sum()) < least or d > differ or d > rate * n:
            continue
        w = wx[len(x) - n :] + wy[:n]
        score = int(w[compared].sum()) - 2 * int(w[differing].sum())
        if best is None or score >= best:
            best, found = score, (n, d)
    return found


def merged_read(one: str, other: str, q1: str, q2: str, n: int, base: int = 33) -> tuple[str, str]:
    """Sequence and qualities of two mates that overlap by n: where they agree the qualities add up to BEST at most, else the
    better base stands (mate 1 of equal ones, a real base before any other) with what its quality is above the other's, 2 at least."""
    head, tail = len(one) - n, other[n:]
    x, y, p, q = (np.frombuffer(t.encode("utf-32-le"), np.uint32).astype(np.int64) for t in (one[head:], other[:n], q1[head:], q2[:n]))
    p, q = p - base, q - base
    real_x, real_y = (np.isin(t, np.frombuffer(BASES, np.uint8)) for t in (x, y))
    first = np.where(real_x == real_y, p >= q, real_x)  # mate 1's base stands
    qual = np.where(x == y, np.minimum(p + q, BEST), np.where(real_x == real_y, np.maximum(np.abs(p - q), 2), np.where(first, p, q)))
    text = lambda t: t.astype("<u4").tobytes().decode("utf-32-le")
    return one[:head] + text(np.where(first, x, y)) + tail, q1[:head] + text(base + qual) + q2[n:]


def merge_mates(mate1: DataFrame, mate2: DataFrame, min_overlap: int = 10, max_mismatches: int = 10, max_rate: float = 0.2, base: int = 33) -> DataFrame:
    """part (merged, pair_1, pair_2), read_id, seq, qual, overlap, mismatches of the pairs of both mates (read_id, seq, qual).

    Mate 1's end is laid over the beginning of mate 2's reverse complement. Overlaps of at least min_overlap bases with no
    more than max_mismatches of them, nor more than max_rate, compete by their quality-weighted score; of equal scores the
    longest counts. A merged pair is one row; any other stays two rows as they came, with overlap 0. Reads of one mate only
    give no row. A null or empty sequence never merges; a quality string that is shorter than its sequence counts 0 for the
    rest. Ids must not repeat within a mate.
    """
    fields = ["read_id", "seq", "qual"]
    kind = mate1.schema["read_id"].dataType.simpleString()
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    whole = lambda q, s: F.rpad(F.left(q, F.length(s)), F.length(s), chr(base))
    one = mate1.select("read_id", F.col("seq").alias("seq1"), F.col("qual").alias("qual1"), text("seq").alias("s1"), whole(text("qual"), text("seq")).alias("q1"))
    two = mate2.select("read_id", F.col("seq").alias("seq2"), F.col("qual").alias("qual2"), reverse_complement(text("seq")).alias("s2"), F.reverse(whole(text("qual"), text("seq"))).alias("q2"))
    both = one.join(two, "read_id").select("read_id", "s1", "q1", "s2", "q2", "seq1", "qual1", "seq2", "qual2")
    names = ["part", *fields, "overlap", "mismatches"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, s1, q1, s2, q2, *raw = (c.to_pylist() for c in batch.columns)
            sized, picked = defaultdict(list), [(0, 0)] * len(ids)
            for i, (x, y) in enumerate(zip(s1, s2, strict=True)):
                if min(len(x), len(y)) >= max(min_overlap, 1):
                    sized[(2 * min(len(x), len(y)) - 1).bit_length()].append(i)
            for bits, mine in sized.items():
                step = max(POINTS >> (bits + 1), 1)
                for lo in range(0, len(mine), step):
                    some, many = mine[lo : lo + step], []
                    for i, n in zip(some, possible_overlaps([s1[i] for i in some], [s2[i] for i in some], min_overlap, max_mismatches, max_rate), strict=True):
                        if n.sum() > DIRECT * min(len(s1[i]), len(s2[i])):
                            many.append(i)
                        elif len(n):
                            picked[i] = best_overlap(s1[i], s2[i], q1[i], q2[i], n, min_overlap, max_mismatches, max_rate, base)
                    few = max(step // 4, 1)
                    for part in (many[k : k + few] for k in range(0, len(many), few)):
                        ends = [min(len(s1[i]), len(s2[i])) for i in part]
                        tails = [[c[i][len(c[i]) - m :] for i, m in zip(part, ends, strict=True)] for c in (s1, q1)]
                        heads = [[c[i][:m] for i, m in zip(part, ends, strict=True)] for c in (s2, q2)]
                        for i, f in zip(part, overlap_scores(tails[0], heads[0], tails[1], heads[1], base), strict=True):
                            picked[i] = chosen_overlap(f, min_overlap, max_mismatches, max_rate)
            rows = []
            for i, (n, d) in enumerate(picked):
                if n:
                    rows.append(("merged", ids[i], *merged_read(s1[i], s2[i], q1[i], q2[i], n, base), n, d))
                else:
                    rows += [("pair_1", ids[i], raw[0][i], raw[1][i], 0, 0), ("pair_2", ids[i], raw[2][i], raw[3][i], 0, 0)]
            kinds = [pa.string(), batch.schema.field("read_id").type, pa.string(), pa.string(), pa.int32(), pa.int32()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    return both.mapInArrow(run, f"part string, read_id {kind}, seq string, qual string, overlap int, mismatches int")


class Adapters:
    """Several adapters as one bit-parallel automaton (Shift-And with errors): all of them move on together, a base at a time.

    Each adapter is a run of bits; row e of the state holds which beginnings of an adapter end here with at most e
    mismatches. An N of the read, or of an adapter, fits any base.
    """

    def __init__(self, adapters: dict[str, str], rate: float, least: int):
        self.rate, self.least = rate, least
        self.names = [n for n, s in adapters.items() if s]
        lengths = [len(adapters[n]) for n in self.names]
        self.starts = [sum(lengths[:k]) for k in range(len(lengths))]
        self.first = sum(1 << s for s in self.starts)
        self.errors = max((int(rate * n + 1e-9) for n in lengths), default=0)
        self.full = (1 << sum(lengths)) - 1
        self.masks: dict[str, int] = defaultdict(int)
        wild = 0
        for name, start in zip(self.names, self.starts, strict=True):
            for k, c in enumerate(adapters[name].upper()):
                if c == "N":
                    wild |= 1 << (start + k)
                else:
                    self.masks[c] |= 1 << (start + k)
        self.masks = {c: m | wild for c, m in self.masks.items()} | {"N": self.full}
        self.wild = wild
        # What a match of k bases may differ by, as bits per number of errors: whole adapters anywhere, beginnings at the end.
        self.whole = [sum(1 << (s + n - 1) for s, n in zip(self.starts, lengths, strict=True) if n >= least and e <= int(rate * n + 1e-9)) for e in range(self.errors + 1)]
        self.part = [sum(1 << (s + k - 1) for s, n in zip(self.starts, lengths, strict=True) for k in range(least, n + 1) if e <= int(rate * k + 1e-9)) for e in range(self.errors + 1)]
        self.place = [(name, start) for name, start in zip(self.names, self.starts, strict=True)]

    def find(self, seq: str) -> tuple[int, str | None]:
        """(where the leftmost adapter begins, its name); of several there the first by name. (length, None) without one."""
        best: tuple[int, str | None] = (len(seq), None)
        state = [0] * (self.errors + 1)
        text = seq.upper()
        for i, c in enumerate(text):
            mask = self.masks.get(c, self.wild)
            before = 0
            for e in range(self.errors + 1):
                old = state[e]
                moved = (old << 1 | self.first) & self.full
                state[e] = (moved & mask) | (((before << 1 | self.first) & self.full) if e else 0)
                before = old
            end = self.part if i == len(text) - 1 else self.whole
            hits = 0
            for e in range(self.errors + 1):
                hits |= state[e] & end[e]
            best = self.better(hits, i, best)
            if best[1] is not None and i - best[0] > len(self.names) + self.full.bit_length():
                break  # no adapter that ends further on begins as early
        return best

    def better(self, hits: int, i: int, best: tuple[int, str | None]) -> tuple[int, str | None]:
        """The best of ``best`` and the adapters that end at place i by the bits of hits."""
        while hits:
            bit = hits.bit_length() - 1
            hits ^= 1 << bit
            name, start = next((n, s) for n, s in reversed(self.place) if s <= bit)
            at = i - (bit - start)
            if at >= 0 and (at < best[0] or (at == best[0] and best[1] is not None and name < best[1])):
                best = (at, name)
        return best


class AdapterLanes:
    """``Adapters`` of at most 64 bases each for many reads at once: words of 64 bits hold whole adapters, and all reads move on together."""

    def __init__(self, adapters: dict[str, str], rate: float, least: int):
        self.lanes, lane, size = [], {}, 0
        for name, bases in adapters.items():
            if bases:
                if size + len(bases) > 64:
                    self.lanes.append(Adapters(lane, rate, least))
                    lane, size = {}, 0
                lane[name], size = bases, size + len(bases)
        if lane:
            self.lanes.append(Adapters(lane, rate, least))
        self.tables = [np.array([one.masks.get(chr(c), one.wild) for c in range(256)], np.uint64) for one in self.lanes]

    def find(self, texts: list[str]) -> list[tuple[int, str | None]]:
        """What ``Adapters.find`` gives for each text; texts of similar length are stepped through together."""
        best: list[tuple[int, str | None]] = [(len(t), None) for t in texts]
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        while order and texts[order[0]]:
            some = order[: max(1, POINTS // len(texts[order[0]]))]
            order = order[len(some) :]
            codes = np.ascontiguousarray(_codes([texts[i].upper() for i in some], len(texts[some[0]])).T)
            sizes = np.array([len(texts[i]) for i in some])
            for one, table in zip(self.lanes, self.tables, strict=True):
                self._step(one, table, codes, sizes, some, best)
        return best

    @staticmethod
    def _step(one: Adapters, table: np.ndarray, codes: np.ndarray, sizes: np.ndarray, some: list[int], best: list) -> None:
        first, by = np.uint64(one.first), np.uint64(1)
        whole, part = (np.array(x, np.uint64)[:, None] for x in (one.whole, one.part))
        state = np.zeros((one.errors + 1, len(some)), np.uint64)
        for i, row in enumerate(codes):
            active = int(np.searchsorted(-sizes, -i, side="left"))  # the reads that reach here come first
            mask, before = table[row[:active]], None
            for e in range(one.errors + 1):
                old = state[e, :active].copy()
                now = ((old << by) | first) & mask
                state[e, :active] = now if before is None else now | (before << by) | first
                before = old
            last = int(np.searchsorted(-sizes, -(i + 1), side="left"))  # from here on this is a read's last base
            hits = np.concatenate([np.bitwise_or.reduce(state[:, :last] & whole, axis=0), np.bitwise_or.reduce(state[:, last:active] & part, axis=0)])
            for k in np.flatnonzero(hits).tolist():
                best[some[k]] = one.better(int(hits[k]), i, best[some[k]])


def trim_adapters(reads: DataFrame, adapters: DataFrame, min_overlap: int = 3, rate: float = 1 / 3, most: int = 10_000) -> DataFrame:
    """read_id, adapter, cut, seq, qual of reads (read_id, seq, qual): cut before the leftmost adapter, or null and the whole read.

    adapters is (adapter, bases), a table of ``most`` rows at most (more are an error). An adapter may stand anywhere in
    whole, or with its first min_overlap bases and more at the read's end; of n bases laid over each other floor(rate * n)
    may differ, an N fits any base. Of several that begin at one place the smallest name counts. Null or empty reads stay
    as they are.
    """
    table = adapters.select(F.col("adapter").cast("string"), F.col("bases").cast("string")).filter("bases IS NOT NULL").limit(most + 1).collect()
    if len(table) > most:
        raise ValueError(f"more than {most} adapters")
    named = {r.adapter: r.bases for r in sorted(table, key=lambda r: (r.adapter or "", r.bases))}
    short = all(len(s) <= 64 for s in named.values())
    found = (AdapterLanes if short else Adapters)(named, rate, min_overlap)
    held = reads.sparkSession.sparkContext.broadcast(found)
    kind = reads.schema["read_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [s or "" for s in batch.column(1).to_pylist()]
            cuts = held.value.find(texts) if short else [held.value.find(s) for s in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for _, n in cuts], pa.string()), pa.array([c for c, _ in cuts], pa.int32()), batch.column(1), batch.column(2)], ["read_id", "adapter", "cut", "seq", "qual"])

    cut = reads.select("read_id", F.col("seq").cast("string"), F.col("qual").cast("string")).mapInArrow(run, f"read_id {kind}, adapter string, cut int, seq string, qual string")
    part = lambda c: F.when(F.col("adapter").isNull(), F.col(c)).otherwise(F.left(c, F.col("cut"))).alias(c)
    return cut.select("read_id", "adapter", F.when(F.col("adapter").isNotNull(), F.col("cut")).alias("cut"), part("seq"), part("qual"))
