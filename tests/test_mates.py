"""Merging with mismatches and adapter tables against plain loops."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandwise.operators import maps, mates


def plain_overlap(x, y, p, q, least, differ, rate):
    best = (None, 0, 0)
    for n in range(max(least, 1), min(len(x), len(y)) + 1):
        d = s = k = 0
        for a, b, u, v in zip(x[len(x) - n :], y[:n], p[len(x) - n :], q[:n], strict=True):
            if a in "ACGT" and b in "ACGT":
                k, d = k + 1, d + (a != b)
                s += (ord(u) + ord(v) - 66) * (1 if a == b else -1)
        if d <= differ and d <= rate * n and k >= least and (best[0] is None or s >= best[0]):
            best = (s, n, d)
    return best[1:]


def pairs():
    rng = np.random.default_rng(8)
    base = lambda n: "".join(rng.choice(list("ACGT"), n))
    qual = lambda n: "".join(chr(c) for c in rng.integers(35, 74, n))
    out = []
    for k in range(60):
        whole = base(120)
        n = int(rng.integers(0, 80))
        one, other = whole[:80], list(whole[80 - n : 160 - n] + base(20))
        for i in rng.choice(len(other), k % 5, replace=False):
            other[i] = "ACGTN"[rng.integers(5)]
        out.append((k, one, qual(80), "".join(other), qual(len(other))))
    return [*out, (90, "A" * 50, "I" * 50, "A" * 40, "I" * 40), (91, "", "", "ACGT", "IIII"), (92, "ACGTACGTAC", "I" * 10, "ACGTACGTAC", "I" * 10), (93, "NNNNNNNNNNNN", "I" * 12, "NNNNNNNNNNNN", "I" * 12)]


COMPLEMENT = str.maketrans("ACGT", "TGCA")


@pytest.mark.parametrize(("differ", "rate"), [(10, 0.2), (0, 1.0), (3, 0.05)])
def test_overlaps_equal_plain_loops(spark, differ, rate):
    rows = pairs()
    frame = lambda r: spark.createDataFrame(r, "read_id int, seq string, qual string").withColumn("part", F.lit(1))
    mate1 = frame([(k, x, p) for k, x, p, _, _ in rows] + [(900, "ACGT", None), (901, None, "II")])
    mate2 = frame([(k, y[::-1].translate(COMPLEMENT), q[::-1]) for k, _, _, y, q in rows] + [(900, "ACGT", "IIII"), (901, "ACGT", None), (902, "ACGT", None)])
    got = mates.merge_mates(mate1, mate2, 10, differ, rate).collect()
    merged = {r.read_id: r for r in got if r.part == "merged"}
    for k, x, p, y, q in rows:
        n, d = plain_overlap(x, y, p, q, 10, differ, rate)
        assert ((merged[k].overlap, merged[k].mismatches) if k in merged else (0, 0)) == (n, d), k
        if n:
            assert len(merged[k].seq) == len(merged[k].qual) == len(x) + len(y) - n
            assert merged[k].seq.startswith(x[: len(x) - n]) and merged[k].seq.endswith(y[n:])
    left = {(r.part, r.read_id, r.seq, r.qual) for r in got if r.part != "merged" and r.read_id >= 900}
    assert left == {("pair_1", 900, "ACGT", None), ("pair_2", 900, "ACGT", "IIII"), ("pair_1", 901, None, "II"), ("pair_2", 901, "ACGT", None)}
    assert sum(r.part == "pair_1" for r in got) == sum(r.part == "pair_2" for r in got) == len(rows) + 2 - len(merged)
    assert mates.merge_mates(mate1.limit(0), mate2).count() == 0


def test_merged_bases():
    seq, qual = mates.merged_read("GGACN", "ACTTT", "IIII#", "I5III", 3)
    assert seq == "GG" + "ACT" + "TT" and qual[:2] == "II" and qual[-2:] == "II"
    assert [ord(c) - 33 for c in qual[2:5]] == [41, 41, 40]


def test_repetitive_pairs_take_little_time():
    began = time.time()
    n = 200_000
    (compared, mismatches, score), = mates.overlap_scores(["A" * n], ["A" * n], ["I" * n], ["I" * n])
    assert mates.chosen_overlap((compared, mismatches, score), 10, 10, 0.2) == (n, 0) and mismatches.max() == 0 and (compared == np.arange(n + 1)).all()
    assert maps.longest_overlap("A" * n + "C", "A" * n, 10, n) == 0 and maps.longest_overlap("CA" * n, "CA" * n + "G", 10, 2 * n + 1) == 2 * n
    assert maps.longest_overlap("GGG" + "A" * 9_000, "A" * 8_999 + "C" + "A" * 9_000, 10, 20_000) == 8_999
    assert time.time() - began < 20


def plain_trim(seq, adapters, least, rate):
    best = (len(seq), None)
    for name, a in adapters.items():
        for at in range(len(seq) - least + 1):
            n = min(len(a), len(seq) - at)
            if n < least:
                continue
            differ = sum(x != y and "N" not in (x, y) for x, y in zip(seq[at:], a, strict=False))
            if differ <= int(rate * n + 1e-9) and (at, name) < (best[0], best[1] or "~"):
                best = (at, name)
    return best


@pytest.mark.parametrize(("rate", "longest"), [(0.0, 40), (0.15, 40), (1 / 3, 40), (0.15, 70)])
def test_adapters_equal_plain_loops(spark, rate, longest):
    rng = np.random.default_rng(9)
    base = lambda n: "".join(rng.choice(list("ACGT"), n))
    adapters = {"a1": "AGATCGGAAGAGC", "a2": "CTGTCTCTTATA", "b": "ACGNNT", "c": base(longest)}
    reads = []
    for k in range(150):
        a = list(adapters[list(adapters)[k % 4]])
        for i in rng.choice(len(a), k % 4, replace=False):
            a[i] = "ACGTN"[rng.integers(5)]
        reads.append((k, base(int(rng.integers(0, 60))) + "".join(a)[: rng.integers(1, len(a) + 1)] + (base(10) if k % 3 == 0 else "")))
    frame = spark.createDataFrame([(k, s, "I" * len(s)) for k, s in reads] + [(900, "", ""), (901, None, None)], "read_id int, seq string, qual string").withColumn("cut", F.lit("x"))
    table = spark.createDataFrame([*adapters.items(), ("none", None), ("empty", "")], "adapter string, bases string")
    got = {r.read_id: r for r in mates.trim_adapters(frame, table, 5, rate).collect()}
    for k, s in reads:
        at, name = plain_trim(s, adapters, 5, rate)
        assert (got[k].adapter, got[k].cut if name else at, got[k].seq, got[k].qual) == (name, at, s[:at], "I" * at), k
    assert (got[900].seq, got[901].seq, got[900].adapter) == ("", None, None)
    assert mates.trim_adapters(frame, table.limit(0)).filter("adapter IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="adapters"):
        mates.trim_adapters(frame, table, most=2)
