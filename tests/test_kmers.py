"""The k-mer operators against plain loops: repeats, k-mers that all texts hold, odd texts, full filters."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandwise.operators import hits, kmers


def runs(text, k):
    return [text[i : i + k] for i in range(len(text or "") - k + 1)]


def plain_hits(reads, refs, k, frac, band):
    out = []
    for q, x in reads:
        a, mine = runs(x, k), defaultdict(list)
        for i, s in enumerate(a):
            mine[s].append(i)
        rows = []
        for t, y in refs:
            theirs = defaultdict(list)
            for j, s in enumerate(runs(y, k)):
                theirs[s].append(j)
            shared = set(mine) & set(theirs)
            if not shared or len(shared) < frac * len(mine):
                continue
            seeds = []
            for s in shared:
                m, n = mine[s], theirs[s]
                seeds += zip(m, n, strict=False) if len(m) > 1 and len(n) > 1 else [(i, j) for i in m for j in n]
            chains = defaultdict(list)
            for i, j in seeds:
                chains[(j - i) // band].append((i, j))
            for b, c in chains.items():
                covered = {i + d for i, _ in c for d in range(k)}
                start, end = min(i for i, _ in c), max(i for i, _ in c) + k
                rows.append((t, b, q, len(shared), round(100 * len(shared) / len(mine), 6), len(c), start, end, min(j for _, j in c), max(j for _, j in c) + k, end - start, len(covered), round(100 * len(covered) / (end - start), 6), len(x), round(100 * (end - start) / len(x), 6)))
        out += [(*r, n + 1) for n, r in enumerate(sorted(rows))]
    return sorted(out)


def as_rows(df):
    return sorted((r.target, r.band, r.query, r.shared, round(r.containment, 6), r.seeds, r.q_start, r.q_end, r.t_start, r.t_end, r.aln_len, r.score, round(r.identity, 6), r.qlen, round(r.coverage, 6), r.file_order) for r in df.collect())


def texts():
    rng = np.random.default_rng(4)
    base = lambda n: "".join(rng.choice(list("ACGT"), n))
    genomes = [base(400) for _ in range(6)]
    refs = [(i, g + "ACGTACGTAC") for i, g in enumerate(genomes)] + [(10, "A" * 120), (11, ""), (12, None), (13, genomes[0][100:300] * 2), (14, "ACGTACGTAC")]
    reads = [(100 + i, genomes[i % 6][s : s + 60]) for i, s in enumerate(range(0, 300, 20))]
    mutated = list(genomes[2][50:130])
    mutated[20], mutated[45] = "N", "N"
    reads += [(200, "".join(mutated)), (201, genomes[3][10:60] + genomes[3][75:140]), (202, "A" * 90), (203, "ACGTACGTAC"), (204, None), (205, ""), (206, "ACG"), (207, base(50)), (208, "A" * 7 + genomes[1][:30])]
    return reads, refs


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, seq string").withColumn("pos", F.lit("x")).withColumn("a", F.lit(1))


@pytest.mark.parametrize(("frac", "band"), [(0.5, 16), (1.0, 4), (0.0, 1000)])
def test_hits_equal_plain_loops(spark, frac, band):
    reads, refs = texts()
    got = kmers.kmer_hits(frame(spark, reads), frame(spark, refs), 6, "", frac, band)
    assert as_rows(got) == plain_hits([r for r in reads if r[1]], [r for r in refs if r[1]], 6, frac, band)


def test_hits_feed_the_best_hit(spark):
    reads, refs = texts()
    found = kmers.kmer_hits(frame(spark, reads), frame(spark, refs), 6)
    best = {r.query: r.target for r in hits.best_hit(found, (F.col("identity") > 85) & (F.col("aln_len") > 0.65 * F.col("qlen")) & (F.col("score") >= 40), "score").collect()}
    assert {100 + i: best[100 + i] for i in range(1, 6)} == {100 + i: i for i in range(1, 6)} and best[200] == 2 and 207 not in best and best[202] == 10
    assert kmers.kmer_hits(frame(spark, reads[:0]), frame(spark, refs), 6).count() == 0
    assert kmers.kmer_hits(frame(spark, reads), frame(spark, refs[:0]), 6).count() == 0


def test_a_kmer_of_all_texts_makes_no_candidates(spark):
    common = "ACGTACGTACGT"
    rng = np.random.default_rng(6)
    reads = [(i, common + "".join(rng.choice(list("ACGT"), 40))) for i in range(40)]
    refs = [(i, common + "".join(rng.choice(list("ACGT"), 200))) for i in range(40)]
    one = lambda rows, name: kmers.positions(frame(spark, rows), 8, "", name).select(name, "a", "b").distinct()
    assert kmers.kmer_counts(frame(spark, reads), frame(spark, refs), 8).count() == 1600
    assert kmers._candidates(one(reads, "query"), one(refs, "target"), 0.5).count() < 40


@pytest.mark.parametrize("most", [kmers.MOST, 64])
def test_screen_equals_plain_loops(spark, monkeypatch, most):
    monkeypatch.setattr(kmers, "MOST", most)  # 64 bits: the filter is full, and the join alone decides
    reads, refs = texts()
    whole = {s for _, y in refs for s in runs(y, 6)}
    for least, frac in ((1, 0.0), (3, 0.5), (1, 1.0)):
        want = []
        for i, x in reads:
            own = set(runs(x, 6))
            if len(own & whole) >= least and len(own & whole) >= frac * len(own):
                want.append((i, len(own & whole), round(len(own & whole) / len(own), 9)))
        got = sorted((r.id, r.hits, round(r.frac, 9)) for r in kmers.kmer_screen(frame(spark, reads), frame(spark, refs), 6, least, "", frac).collect())
        assert got == sorted(want)
    assert kmers.kmer_screen(frame(spark, reads), frame(spark, refs[:0]), 6).count() == 0


def test_classification_by_common_ancestors(spark):
    parent = {2: 1, 3: 1, 4: 2, 5: 2, 6: 4, 7: 4}
    nodes = spark.createDataFrame([(1, 1), *parent.items()], "taxid int, parent int")
    refs = [(1, "AAAACCCCGGGG"), (2, "AAAACCCCTTTT"), (3, "GGGGTTTTCCCC"), (4, "ACACACACACAC"), (5, "TGTGTGTGTGTG")]
    taxa = {1: 6, 2: 7, 3: 5, 4: 3, 5: 99}
    reads = [(1, "AAAACCCC"), (2, "AAAACCCCGGGG"), (3, "ACACACAC"), (4, "TGTGTGTG"), (5, None), (6, "GGGGTTTTACACAC")]

    def way(t):
        return [t, *way(parent[t])] if t in parent else [t]

    held = defaultdict(set)
    for i, y in refs:
        if taxa[i] != 99:
            for s in runs(y, 4):
                held[s].add(taxa[i])
    common = {s: max(set.intersection(*(set(way(t)) for t in ts)), key=lambda a: len(way(a))) for s, ts in held.items()}
    want = {}
    for i, x in reads:
        votes = Counter(common[s] for s in set(runs(x, 4)) if s in common)
        want[i] = max(votes, key=lambda t: (sum(votes[a] for a in way(t)), -t), default=0)
    got = kmers.kmer_lca_classify(frame(spark, reads), frame(spark, refs), spark.createDataFrame(list(taxa.items()), "id int, taxid int"), nodes, 4)
    assert {r.read_id: r.taxid for r in got.collect()} == want and want[1] == 4 and want[4] == 0
