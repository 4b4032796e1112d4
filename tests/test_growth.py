"""Work that must not grow faster than the input: the cases failed, or took very long, before."""

import time

import pyarrow as pa
from pyspark.sql import functions as F

from strandwise.batches import slices
from strandwise.operators import hits, kmers, mates, taxonomy


def test_rows_of_a_contig_do_not_multiply_with_its_reads(spark):
    n = 30_000
    rows = spark.range(n).select(F.lit("c1").alias("query"), (F.col("id") % 7).cast("int").alias("taxid"), F.col("id").alias("place"))
    own = spark.createDataFrame([("r1", 90, 5), ("r1", 91, 8), ("r2", 92, n + 1), ("r2", 80, n + 1)], "query string, taxid int, place long")
    reads = spark.range(n).select(F.lit("c1").alias("contig_id"), F.concat(F.lit("r"), F.col("id").cast("string")).alias("read_id"))
    began = time.time()
    for own_wins, want in ((True, (91, 80, 0)), (False, ((n - 1) % 7, 80, (n - 1) % 7))):
        got = {r.read_id: r.taxid for r in taxonomy.spread_contigs(rows.unionByName(own), reads, own_wins).collect()}
        assert len(got) == n and (got["r1"], got["r2"], got["r3"]) == want
    assert time.time() - began < 30


def test_kmers_of_one_side_only_are_not_shuffled(spark, monkeypatch):
    counts = {}

    def counted(df, name):
        out = write(df, name)
        counts[name] = out.count()
        return out

    write = kmers.written
    monkeypatch.setattr(kmers, "written", counted)
    reads = spark.range(2000).select("id", F.when(F.col("id") == 7, "ACGTACGTCC").otherwise(F.md5(F.col("id").cast("string"))).alias("seq"))
    reference = spark.createDataFrame([(1, "TTACGTACGT"), (2, "GGGGG")], "id int, seq string")
    assert [tuple(r) for r in kmers.kmer_counts(reads, reference, 8).collect()] == [(7, 1, 1)]
    assert counts["hits-query"] < 100
    nodes = spark.createDataFrame([(1, 1), (2, 1)], "taxid int, parent int")
    got = kmers.kmer_lca_classify(reads, reference, spark.createDataFrame([(1, 2), (2, 2)], "id int, taxid int"), nodes, 8).collect()
    assert len(got) == 2000 and [r.read_id for r in got if r.taxid] == [7] and counts["hits-query"] < 100


def test_batches_are_cut_by_bytes():
    texts = ["a" * 400, None, "é" * 300, "", "b" * 5000, "c"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    parts = list(slices(iter([batch, batch.slice(0, 0)]), 1000))
    assert [x for p in parts for x in p.column(1).to_pylist()] == texts and [x for p in parts for x in p.column(0).to_pylist()] == list(range(len(texts)))
    assert all(p.num_rows == 1 or sum(len((x or "").encode()) for x in p.column(1).to_pylist()) <= 1000 for p in parts) and len(parts) > 6


def test_few_pairs_are_transformed_in_full(spark, monkeypatch):
    import random

    rng = random.Random(2)
    base = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    ones, others = [base(3000) for _ in range(20)], []
    for one in ones:
        end = list(one[2000:])
        for at in (5, 500, 900):
            end[at] = "ACGT"["TGCA".index(end[at])]
        others.append("".join(end) + base(100))
    found = mates.possible_overlaps(ones, others, 10, 10, 0.2)
    for x, y, n in zip(ones, others, found, strict=True):
        assert n.sum() < mates.DIRECT * len(y)
        want = mates.chosen_overlap(mates.overlap_scores([x], [y], ["I" * len(x)], ["I" * len(y)])[0], 10, 10, 0.2)
        assert mates.best_overlap(x, y, "I" * len(x), "I" * len(y), n, 10, 10, 0.2) == want == (1000, 3)


def test_group_sums_read_their_rows_once(spark):
    rows = [(1, 2.0, 5, 1.5), (1, 2.0, 6, 0.5), (2, 3.0, None, 0.0), (3, 4.0, 5, 4.0)]
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    by_taxon = spark.createDataFrame(rows, "gene_id int, rpkm double, taxid int, taxon_rpkm double")
    members = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "b")], "gene_id int, g string")
    got = sorted(map(tuple, hits.rpkm_of_groups(by_taxon.mapInArrow(look, by_taxon.schema), members, "g").collect()), key=str)
    assert got == [("a", 2, 5.0, 5, 1.5), ("a", 2, 5.0, 6, 0.5), ("b", 1, 4.0, 5, 4.0)]
    assert seen.value == len(rows)
