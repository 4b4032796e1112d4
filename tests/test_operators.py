"""Small hand-made frames: ties, empty inputs, nulls and repeats."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandwise.functions import hits as X
from strandwise.functions import reads as R
from strandwise.operators import enzyme, hits, kmers, route, taxonomy


def test_best_hit_ties_and_strict(spark):
    rows = [("q", "a", 90, True, 1), ("q", "b", 90, True, 0), ("q", "c", 80, False, 2), ("r", "d", 5, False, 0)]
    df = spark.createDataFrame(rows, "query string, target string, score int, ok boolean, file_order int")
    assert [tuple(r)[:2] for r in hits.best_hit(df, F.col("ok"), "score").collect()] == [("q", "b")]
    assert hits.best_hit(df, F.col("ok"), "score", "strict").collect() == []


def test_strict_best_hit_against_loops(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abcdefgh"), f"t{rng.randrange(4)}", rng.choice([None, 1, 2, 3, 4]), rng.choice([True, True, True, False, None]), rng.randrange(3), i) for i in range(90)]
    rows = list({(r[0], r[1], r[2], r[4]): r for r in rows}.values()) + [("only null", "t", 3, None, 0, -1)]
    want = {}
    for q in {r[0] for r in rows}:
        # In order of score (none last), place in the file and target: what stands after the last row that fails.
        mine = sorted((r for r in rows if r[0] == q), key=lambda r: (r[2] is None, -(r[2] or 0), r[4], r[1]))
        after = mine[max((i + 1 for i, r in enumerate(mine) if not r[3]), default=0) :]
        want |= {q: after[0]} if after else {}
    df = spark.createDataFrame(rows, "query string, target string, score int, ok boolean, file_order int, more int")
    got = hits.best_hit(df, F.col("ok"), "score", "strict")
    assert got.columns == df.columns
    assert {r[0]: tuple(r) for r in got.collect()} == want and len(want) > 3
    assert hits.best_hit(df.filter("false"), F.col("ok"), "score", "strict").collect() == []


def test_repopulate_restores_everything_when_nothing_is_filtered(spark):
    reads = spark.createDataFrame([("1", "A"), ("2", "A"), ("3", "C")], "read_id string, seq string")
    clusters = route.exact_dedup(reads, ["seq"])
    reps = clusters.select(F.col("rep_id").alias("read_id")).distinct()
    assert sorted(r[0] for r in route.repopulate(reps, clusters, reads).collect()) == ["1", "2", "3"]


def test_pair_sync_keeps_every_read(spark):
    a = spark.createDataFrame([("1",), ("2",)], "read_id string")
    b = spark.createDataFrame([("2",), ("3",)], "read_id string")
    assert sorted((r.part, r.read_id) for r in route.pair_sync(a, b).collect()) == [("pair_1", "2"), ("pair_2", "2"), ("singletons", "1"), ("singletons", "3")]


def test_cigar_and_codons(spark):
    df = spark.createDataFrame([("10S80M", "ATGTAAN"), ("", "")], "cigar string, seq string")
    got = df.select(X.cigar_match_pct(F.col("cigar")), R.translate_codons(F.col("seq")), R.reverse_complement(F.col("seq"))).collect()
    assert abs(got[0][0] - 800 / 9) < 1e-9 and got[0][1] == "M" and got[0][2] == "NTTACAT"
    assert tuple(got[1]) == (0.0, "", "")


def test_rollup_gives_small_taxa_to_the_nearest_present_ancestor(spark):
    nodes = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 99), (5, 3), (6, 5)], "taxid int, parent int")
    counts = spark.createDataFrame([(6, 3), (3, 1), (4, 2), (77, 1), (0, 7)], "taxid int, reads long")
    # 6 is small; 5 has no reads, so 3 takes them and reaches the cutoff; a taxon that the tree lacks stands below the root.
    rolled = taxonomy.rollup(counts, nodes, least=4)
    got = {r.taxid: (r.reported, r.reads) for r in rolled.collect()}
    assert got == {6: (3, 3), 3: (3, 1), 4: (1, 2), 77: (1, 1), 1: (1, 7)}
    assert {r.taxid: r.reads for r in taxonomy.rolled_counts(rolled).collect()} == {3: 4, 1: 10}
    # A share of the 7 reads below the root; a count equal to the cutoff stays.
    assert {r.taxid: r.reported for r in taxonomy.rollup(counts, nodes, share=2 / 7).collect()} == {6: 6, 3: 1, 4: 4, 77: 1, 1: 1}
    reads = spark.createDataFrame([("a", 6), ("b", 0), ("c", 4)], "read_id string, taxid int")
    assert sorted(map(tuple, taxonomy.repointed(reads, rolled).collect())) == [("a", 3), ("b", 1), ("c", 1)]
    assert taxonomy.rollup(counts.limit(0), nodes).count() == 0


def test_deep_and_large_trees(spark):
    import pytest

    chain = spark.createDataFrame([(1, 1)] + [(k, k - 1) for k in range(2, 62)], "taxid int, parent int")
    up = taxonomy.ancestor_closure(chain)
    assert up.count() == 61 * 62 // 2 and up.filter("taxid = 61").agg(F.max("distance")).first()[0] == 60
    leaf = spark.createDataFrame([(61, 1), (2, 100)], "taxid int, reads long")
    assert {r.taxid: r.reads for r in taxonomy.rolled_counts(taxonomy.rollup(leaf, chain, least=10)).collect()} == {2: 101}
    every = spark.range(2, 62).selectExpr("CAST(id AS INT) AS taxid", "1L AS reads")
    got = {r.taxid: r.reads for r in taxonomy.rolled_counts(taxonomy.rollup(every, chain, least=7)).collect()}
    assert got == {k: 7 for k in range(6, 62, 7)} | {1: 4}
    ranked = chain.withColumn("rank", F.when(F.col("taxid") == 61, "species").when(F.col("taxid") == 2, "superkingdom").otherwise("no rank"))
    names = chain.select("taxid", F.concat(F.lit("n"), "taxid").alias("name"))
    reads = spark.createDataFrame([("a", 61), ("b", 3), ("c", 0), ("d", 99)], "read_id string, taxid int")
    assert sorted(map(tuple, taxonomy.classified_reads(reads, ranked, names).collect())) == [("C", "a", "no root;k_;p_;c_;o_;f_;g_;s_n61"), ("C", "b", "root;k_n2"), ("U", "c", "unclassified"), ("U", "d", "unclassified")]
    wide = spark.range(1, 500_001).selectExpr("CAST(id AS INT) AS taxid", "CAST(CASE WHEN id < 1000 THEN 1 ELSE id % 998 + 2 END AS INT) AS parent")
    assert taxonomy.ancestor_closure(wide).count() == 1 + 2 * 998 + 3 * (500_000 - 999)
    assert taxonomy.ancestor_closure(wide, spark.createDataFrame([(499_999,), (7,), (-5,)], "taxid int")).count() == 5
    with pytest.raises(ValueError, match="cycle"):
        taxonomy.ancestor_closure(spark.createDataFrame([(1, 1), (2, 3), (3, 2)], "taxid int, parent int"))


def test_common_ancestors_and_ranks_of_deep_trees(spark):
    # A chain of 60 with a twig of 3 at every fifth node; the root is not in the table.
    rows = [(k, k - 1) for k in range(2, 62)] + [(1000 * k + j, 1000 * k + j - 1 if j else k) for k in range(5, 62, 5) for j in range(3)]
    parent = dict(rows)
    nodes = spark.createDataFrame(rows, "taxid int, parent int")

    def way(t):
        out = [t]
        while out[-1] in parent:
            out.append(parent[out[-1]])
        return out

    tree = {r.taxid: r for r in taxonomy.numbered_tree(nodes).collect()}
    assert sorted(r.enter for r in tree.values()) == list(range(len(rows)))
    for a in tree.values():
        assert a.path == way(a.taxid) and a.depth == len(a.path) - 1
        assert {b.taxid for b in tree.values() if a.enter <= b.enter <= a.leave} == {t for t in parent if a.taxid in way(t)}
    sets = {"one": [61], "twigs": [5002, 40_001, 61], "up": [7, 30_000], "top": [2, 60_002], "same": [9, 9], "none": [0, 99_999], "part": [99_999, 33]}
    reads = spark.createDataFrame([(k, t) for k, v in sets.items() for t in v], "read_id string, taxid int")
    got = {r.read_id: r.lca for r in taxonomy.lca(reads, nodes).collect()}
    assert got == {"one": 61, "twigs": 5, "up": 7, "top": 2, "same": 9, "part": 33}
    ranks = {2: "superkingdom", 10: "family", 12: "subfamily", 20: "genus", 22: "subgenus", 30: "species", 31: "subspecies", 40: "clade"}
    ranked = nodes.join(spark.createDataFrame(list(ranks.items()), "taxid int, rank string"), "taxid", "left")
    asked = spark.createDataFrame([(k, t) for k, t in enumerate([61, 31, 30, 29, 22, 21, 13, 11, 5002, 1, 0, 12_345, None])], "read_id int, taxid int")

    def taxa(target):
        rows = sorted(taxonomy.constrain_reads(asked, ranked, target).collect(), key=lambda r: r.read_id)
        assert all((r.flag == "U") == (r.taxid == 0) for r in rows)
        return [r.taxid for r in rows]

    assert taxa("subspecies") == [31, 31, 30, 22, 22, 20, 12, 10, 2, 0, 0, 0, 0]
    assert taxa("subgenus") == [22, 22, 22, 22, 22, 20, 12, 10, 2, 0, 0, 0, 0]
    assert taxa("genus") == [20, 20, 20, 20, 20, 20, 12, 10, 2, 0, 0, 0, 0]
    rooted = ranked.unionByName(spark.createDataFrame([(1, 1, "no rank")], "taxid int, parent int, rank string"))
    rows = taxonomy.constrain_reads(asked.filter("taxid IN (1, 5002)"), rooted.filter("taxid <> 2").unionByName(spark.createDataFrame([(2, 1, "x")], "taxid int, parent int, rank string")), "class").collect()
    assert {(r.flag, r.taxid) for r in rows} == {("C", 1)}
    assert taxonomy.lca(reads.limit(0), nodes).count() == 0 and taxonomy.numbered_tree(nodes.limit(0)).count() == 0


def test_rollup_equals_plain_loops(spark):
    import numpy as np

    rng = np.random.default_rng(12)
    for shape in ("random", "deep", "comb"):
        parent = {k: (int(rng.integers(1, k)) if shape == "random" else k - 1 if shape == "deep" or k % 2 == 0 else max(k - 2, 1)) for k in range(2, 90)}
        nodes = spark.createDataFrame([(1, 1), *parent.items()], "taxid int, parent int")
        counts = {int(t): int(rng.integers(1, 9)) for t in rng.choice(np.arange(2, 90), 60, replace=False)} | {0: 2, 700: 1}
        least = 10

        def way(t):
            return [t] if t == 1 else [t, *way(parent.get(t, 1))]

        reads = {1: counts[0]} | {t: n for t, n in counts.items() if t}
        above = {t: next(a for a in way(t)[1:] if a in reads) for t in reads if t != 1}
        total, kept = dict(reads), {1}
        for t in sorted(above, key=lambda t: -len(way(t))):
            if total[t] < least:
                total[above[t]] += total[t]
            else:
                kept.add(t)
        want = {t: (next(a for a in way(t) if a in kept), reads[t]) for t in reads}
        got = taxonomy.rollup(spark.createDataFrame(list(counts.items()), "taxid int, reads long"), nodes, least=least).collect()
        assert {r.taxid: (r.reported, r.reads) for r in got} == want
    tree, _ = taxonomy._heavy_paths(spark.createDataFrame([(k, 1) for k in range(2, 90)], "taxid int, reads long"), spark.createDataFrame([(1, 1), *((k, k - 1) for k in range(2, 90))], "taxid int, parent int"))
    assert tree.agg(F.max("light"), F.count_distinct("head")).first()[:] == (0, 1)  # a chain is one path, and one round
    assert taxonomy.rollup(spark.createDataFrame([], "taxid int, reads long"), nodes).count() == 0


def test_contig_ties_go_to_the_first_contig(spark):
    best = spark.createDataFrame([("c1", "gZ", 5, 1), ("c2", "gA", 5, 2), ("c3", "gB", 9, 3), ("r9", "gC", 1, 4)], "query string, target string, score int, file_order int")
    members = spark.createDataFrame([("c1", "r1"), ("c2", "r1"), ("c3", "r2"), ("c1", "r2"), ("c2", "r3")], "contig_id string, read_id string")
    got = hits.claim_once(hits.expand_contigs(best, members, ("file_order", "query")))
    assert {r.read_id: r.gene_id for r in got.collect()} == {"r1": "gZ", "r2": "gB", "r3": "gA", "r9": "gC"}


def test_checks_of_mates(spark):
    import pytest

    a, b, c = (spark.createDataFrame([(x,) for x in ids], "read_id string") for ids in ("xy", "yx", "xz"))
    route.assert_same_ids(a, b, "quality")
    with pytest.raises(ValueError, match="quality"):
        route.assert_same_ids(a, c, "quality")
    route.assert_pairs_balanced({"host": (a, c)})
    with pytest.raises(ValueError, match="bad data in vectors: 2 and 3 reads"):
        route.assert_pairs_balanced({"host": (a, b), "vectors": (a, b.unionByName(c.filter("read_id = 'z'")))})
    with pytest.raises(ValueError, match="x is in both"):
        route.assert_disjoint(a, c, "contig map")
    route.assert_disjoint(a, c.filter("read_id = 'z'"), "contig map")


def test_kmers_do_not_mix_up_words(spark):
    reads = spark.createDataFrame([(1, "a b c d e"), (2, "ab c d e"), (3, "a  b c"), (4, None), (5, "")], "id int, seq string")
    ref = spark.createDataFrame([(9, "x b c d e b c d")], "id int, seq string")
    assert sorted(map(tuple, kmers.kmer_counts(reads, ref, 3, " ").collect())) == [(1, 9, 2), (2, 9, 1)]
    assert [tuple(r)[:2] for r in kmers.kmer_screen(reads, ref, 3, 2, " ").collect()] == [(1, 2)]


def test_gene_sources(spark):
    names = ["123__x|k__B|p__y|s__z|g", "gi|1|ref|ACC.2|a|b|c|d|e", "x||ACC||y", "ACC.1", "a|b|c|d|e", ""]
    got = [tuple(r.s) for r in spark.createDataFrame([(n,) for n in names], "g string").select(X.gene_source(F.col("g")).alias("s")).collect()]
    assert got == [(None, 123), ("ACC", None), ("ACC", None), ("ACC", None), ("a|b|c|d|e", None), ("", None)]


def test_per_base_counts_of_uneven_reads(spark):
    rows = [("II#",), ("",), (None,), ("I",), ("#" * 70_000,)] * 20
    got = {(r.pos, r.q): r.k for r in R.per_base_codes(spark.createDataFrame(rows, "qual string")).collect()}
    assert got[0, 73] == 40 and got[0, 35] == 20 and got[2, 35] == 40 and got[69_999, 35] == 20 and len(got) == 70_002


def test_ec_consensus_without_pairs(spark):
    detect = spark.createDataFrame([("g", "2.1.1.1", 0.5), ("g", "1.1.1.1", 0.9)], "gene_id string, ec string, prob double")
    common = spark.createDataFrame([("h", "3.1.1.1", 0.9), ("h", "1.9.9.9", 0.1)], "gene_id string, ec string, prob double")
    pairs = spark.createDataFrame([], "ec_lo string, ec_hi string")
    got = sorted(map(tuple, enzyme.ec_consensus(detect, common, pairs).collect()))
    assert got == [("g", "1.1.1.1", "detect"), ("h", "1.9.9.9", "common")]


def test_n50_of_nothing_and_of_equal_lengths(spark):
    df = spark.createDataFrame([(4,), (4,), (4,), (4,)], "n int")
    assert tuple(hits.n50_l50(df, "n").collect()[0]) == (4, 3)


def test_read_formats_on_edge_rows(spark, tmp_path):
    from strandwise.sources import formats as S

    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    fastq = put("a.fastq", "@r1 lane/x\nACGT\n+\n@III\n@r2\n\n+\n\n")
    assert sorted(map(tuple, S.read_fastq(spark, fastq).collect())) == [("r1", "ACGT", "@III"), ("r2", "", "")]
    fasta = put("a.fasta", ">s1 one >NODE\nAC GT\n\nAC\n>s2\n>s3\nTT")
    assert sorted(map(tuple, S.read_fasta(spark, fasta).collect())) == [("s1", "one >NODE", "ACGTAC", 6), ("s2", "", "", 0), ("s3", "", "TT", 2)]
    sam = put("a.sam", "@SQ\tx\n\nq\t4\tt\t1\t0\t10S80M\t*\t0\t0\tA\tI\tNM:i:0\tAS:i:7\nq2\t0\tt\t1\t0\t9M\t*\t0\t0\tA\tI\n")
    assert sorted(map(tuple, S.read_sam(spark, sam).collect())) == [("q", 4, "t", "10S80M", 7), ("q2", 0, "t", "9M", None)]
    assert S.trim_sam(spark, sam).count() == 1
    tab = put("a.tab", "q\tt\t85\t26\t0\t0\t1\t9\t1\t9\t1e-5\t60\nq\tt\t85\t26\t0\t0\t1\t9\t1\t9\t1e-5\n")
    assert S.read_blast_tab(spark, tab).count() == 1 and S.read_blast_tab(spark, tab, rejected=True).count() == 1
    clstr = put("a.clstr", ">Cluster 0\n0\t8nt, >r1... *\n1\t8nt, >r7... at 100.00%\n>Cluster 1\n0\t9nt, >r2... *\n")
    assert sorted(map(tuple, S.read_clstr(spark, clstr).collect())) == [("r1", "r1"), ("r1", "r7"), ("r2", "r2")]
    names = put("names.dmp", "2\t|\tBacteria\t|\tBacteria <x>\t|\tscientific name\t|\n2\t|\teubacteria\t|\t\t|\tsynonym\t|\n")
    assert sorted(map(tuple, S.read_dmp_names(spark, names).collect())) == [(0, "unclassified"), (2, "Bacteria")]
    priam = put("p.txt", ">g1 x\n1.1.1.1\t0.9\t1e-9\n# 2.2.2.2\t0.3\t1e-2\n\n>g2\n")
    assert [tuple(r) for r in S.read_priam_blocks(spark, priam).collect()] == [("g1", "1.1.1.1", 0.9, 1e-9, True)]
    assert S.read_priam_blocks(spark, priam, best_only=False).count() == 2
    pairs = put("pairs.txt", "EC1_EC2\tNum_of_prots\n1.1.1.1_2.2.2.2\t5\n")
    assert [tuple(r) for r in S.read_ec_pairs(spark, pairs).collect()] == [("1.1.1.1", "2.2.2.2", 5)]
    dat = put("e.dat", "ID   1.1.1.1\nDE   Alcohol dehydrogenase.\nDR   P07327, ADH1A_HUMAN ;  P28469, ADH1A_MACMU ;\n//\n")
    assert sorted(map(tuple, S.read_enzyme_dat(spark, dat).collect())) == [("1.1.1.1", "Alcohol dehydrogenase", "P07327"), ("1.1.1.1", "Alcohol dehydrogenase", "P28469")]


def test_pathways_reports_and_line_rules(spark, tmp_path):
    from strandwise.sources import formats as S

    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    assert sorted(map(tuple, S.read_pathway(spark, put("p.tsv", "path:ec1\tec:1.1.1.1\nec2\t2.2.2.2\n")).collect())) == [("ec1", "1.1.1.1"), ("ec2", "2.2.2.2")]
    csv = put("s.csv", 'Superpathway,Pathway ID,Pathway\n"Lipids, all",ec00061,"Fatty ""acid"" steps"\n')
    got = S.read_superpathway(spark, csv).select("superpathway", "pathway_id").collect()
    assert [tuple(r) for r in got] == [("Lipids, all", "ec00061")]
    report = spark.createDataFrame([("a", 1), (None, 2)], "gene string, n int")
    for kind, sep in (("tsv", "\t"), ("csv", ",")):
        S.write_table(report.coalesce(1), str(tmp_path / kind), kind)
        assert spark.read.option("sep", sep).option("header", True).csv(str(tmp_path / kind)).count() == 2
    S.write_table(report, str(tmp_path / "parquet"), "parquet")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "parquet")).collect()), key=str) == [("a", 1), (None, 2)]
    both = S.concat_reports(spark, [put("one.txt", "x\ny\n"), put("two.txt", "x\n"), put("none.txt", "")])
    assert sorted((r.report, r.value) for r in both.collect()) == [("one.txt", "x"), ("one.txt", "y"), ("two.txt", "x")]
    heads = spark.createDataFrame([(">NODE_1>NODE_2",), (">s1",), ("",)], "h string")
    swapped = heads.select(S.swap_header_marker(F.col("h")).alias("h"))
    assert [r.h for r in swapped.collect()] == [">NODE_1_NODE_2", ">s1", ""]
    lines = spark.createDataFrame([(">a\tb",), ("",), (" \t",), ("AC GT",), (None,)], "value string")
    assert [r.value for r in S.strip_fasta_whitespace(lines).collect()] == [">ab", "ACGT"]


def test_adapter_with_mismatches_against_brute_force(spark):
    import random

    def brute(seq, adapter, least, rate):
        for at in range(len(seq) - least + 1):
            n = min(len(adapter), len(seq) - at)
            if sum(a != b and a != "N" for a, b in zip(seq[at:], adapter)) <= int(rate * n + 1e-9):
                return at
        return len(seq)

    rng = random.Random(3)
    seqs = ["", "AG", "NNNN", "AGATCGGA", *("".join(rng.choices("ACGTN", [9, 9, 9, 9, 1], k=rng.randrange(60))) for _ in range(150))]
    seqs += [s + "AGATCGGAAG"[: k % 11] for k, s in enumerate(seqs)]
    df = spark.createDataFrame([(s,) for s in seqs] + [(None,)], "seq string")
    for rate in (0.0, 0.2):
        got = df.select("seq", R.adapter_start_fuzzy(F.col("seq"), "AGATCGGAAG", 3, rate).alias("cut")).collect()
        assert all(r.cut == (None if r.seq is None else brute(r.seq, "AGATCGGAAG", 3, rate)) for r in got)


def test_incremental_counts_read_each_file_once(spark, tmp_path):
    from strandwise.streaming import funnel

    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for values in ([("a", 1), ("b", 2)], [("a", 5)], []):
        spark.createDataFrame(values, "k string, v int").write.mode("append").parquet(landed)
        got = funnel.incremental_counts(spark, landed, "k string, v int", ["k"], {"n": F.lit(1), "v": F.col("v")}, out, state)
    assert sorted(map(tuple, got.collect())) == [("a", 2, 6), ("b", 1, 2)]


def test_stage_table_is_made_once(spark, tmp_path):
    from strandwise.streaming import funnel

    made = []

    def make():
        made.append(1)
        return spark.range(3)

    assert [funnel.stage_table(spark, str(tmp_path / "s"), make).count() for _ in range(2)] == [3, 3] and len(made) == 1


def test_whole_tables_reach_the_rpkm_table(spark):
    from strandwise.plans import gene_queries as Q
    from strandwise.plans.views import view

    sf = "/root/testdata/sf0.001"
    members = view(spark, sf, "v_contig").distinct()
    best = Q._aln_best(spark, sf)
    reached = members.join(best, best.query == members.contig_id).select("target", "read_id", "score")
    assert reached.filter("read_id % 50 <> 0").count() > 0
    got = Q.QUERIES["expand_contigs"](spark, sf).select("gene_id", "read_id", "score")
    assert reached.exceptAll(got).count() == 0
    reads = got.select("read_id").distinct().count()
    assert Q.QUERIES["claim_read_once"](spark, sf).count() == reads


def test_merge_pairs_with_long_overlaps_against_brute_force(spark):
    import random

    from strandwise.operators import maps

    rng = random.Random(5)
    whole = "".join(rng.choice("ACGT") for _ in range(3000))
    pairs = [(whole[:2000], whole[1300:]), (whole[:800], whole[500:700]), (whole[:800], whole[600:]), ("A" * 400, "A" * 300), (whole[:50], whole[41:90]), ("ACGT", "ACGT"), (None, "A" * 20)]
    pairs += [("".join(rng.choice("AC") for _ in range(300)) + whole[:n], whole[:n] + "".join(rng.choice("AC") for _ in range(300))) for n in (10, 149, 150, 151, 400)]
    best = lambda a, b: max((n for n in range(10, min(len(a), len(b)) + 1) if a[-n:] == b[:n]), default=0) if a else 0
    mate1 = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "read_id long, seq string")
    mate2 = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(pairs)], "read_id long, seq string").select("read_id", R.reverse_complement(F.col("seq")).alias("seq"))
    got = {r.read_id: (r.overlap, r.merged) for r in maps.merge_pairs(mate1, mate2).collect()}
    for i, (a, b) in enumerate(pairs):
        n = best(a, b)
        assert got[i] == (n, a + b[n:] if n else None)
    assert got[0] == (700, whole) and got[3][0] == 300


def test_landed_funnel_follows_files(spark, tmp_path):
    from datetime import datetime, timedelta

    from strandwise.streaming import funnel

    path, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    day = lambda n: datetime(2020, 1, 1) + timedelta(days=n)
    land = lambda rows: spark.createDataFrame(rows, "stage string, read_id long, gene_id long, ts timestamp").write.mode("append").parquet(path)
    run = lambda: {r.stage: (r.reads, r.genes) for r in funnel.landed_funnel(spark, path, out, state, "INTERVAL 10 DAY").collect()}
    (tmp_path / "in").mkdir()
    assert run() == {}
    land([("a", 1, 7, day(0)), ("a", 1, 8, day(100)), ("a", 2, None, day(1)), (None, 3, 7, None), ("b", 1, 7, day(100))])
    assert run() == {"a": (2, 2), "": (1, 1), "b": (1, 1)}
    assert run() == {"a": (2, 2), "": (1, 1), "b": (1, 1)}  # nothing new
    land([("a", 1, 9, day(95)), ("a", 4, 9, day(200)), ("b", 1, 7, day(99)), ("a", 50, 60, day(89)), ("b", 50, 61, day(2)), ("a", None, None, day(100))])
    assert run() == {"a": (3, 3), "": (1, 1), "b": (1, 1), "late": (1, 2)}
    land([("a", 4, 9, day(191)), ("a", 51, 60, day(189))])
    assert run() == {"a": (3, 3), "": (1, 1), "b": (1, 1), "late": (2, 2)}


def test_totals_groups_and_disjoint_reads(spark):
    import pytest

    from strandwise.operators import maps

    cells = spark.createDataFrame([("g1", "x", 2), ("g1", "x", 1), ("g2", "x", None), ("g1", "y", 0), ("g2", "z", 5), ("g3", "z", -5), (None, "x", 1)], "gene string, taxon string, n int")
    assert sorted(map(str, map(tuple, maps.with_totals(cells, "gene", "taxon", "n").collect()))) == sorted(map(str, [("g1", "x", 3), ("g2", "x", 0), (None, "x", 1), ("All", "x", 4)]))
    assert maps.with_totals(cells.limit(0), "gene", "taxon", "n").count() == 0
    aln = spark.createDataFrame([("r1", "c1", 5, 0), ("r1", "c2", 6, 1)], "query string, target string, as_score int, file_order int")
    reads = lambda *ids: spark.createDataFrame([(i,) for i in ids], "read_id string")
    assert [tuple(r) for r in maps.contig_assign(aln, F.lit(True), reads("r1"), reads("r2")).collect()] == [("r1", "c2")]
    with pytest.raises(ValueError, match="r1 is in both"):
        maps.contig_assign(aln, F.lit(True), reads("r1", "r3"), reads("r1"))


def test_quality_measures_of_odd_reads(spark):
    rows = ["", None, "IIII", "!~", "\u00e9I", "I" * 70_000, "\u20acI"]
    worth = lambda q: None if q is None else sum(10 ** ((33 - c) / 10) for c in q.encode("latin-1", "replace"))
    df = spark.createDataFrame([(i, q) for i, q in enumerate(rows)], "i int, qual string")
    for r in df.select("i", "qual", R.expected_error(F.col("qual")).alias("ee"), R.mean_code(F.col("qual")).alias("mean")).collect():
        assert r.ee is None if r.qual is None else r.ee == pytest.approx(worth(r.qual))
        codes = (r.qual or "").encode("latin-1", "replace")
        assert r.mean is None if not codes else r.mean == pytest.approx(sum(codes) / len(codes))
    assert df.filter("false").select(R.expected_error(F.col("qual"))).collect() == []


def test_quality_blocks_cut_anywhere(monkeypatch):
    texts = pa.array(["skipped", "abc", None, "", "defghijk", "", "l"]).slice(1)
    for size in (1, 2, 3, 5, 100):
        monkeypatch.setattr(R, "CHUNK", size)
        got = [(chr(c), int(r), int(p)) for block in R._blocks(texts) for c, r, p in zip(*block, strict=True)]
        assert got == [(c, i, p) for i, t in enumerate(texts.to_pylist()) for p, c in enumerate(t or "")]
    assert list(R._blocks(pa.array([None, None], pa.string()))) == [] == list(R._blocks(pa.array([], pa.string())))


@pytest.mark.parametrize(("quals", "base"), [(["@@@", "h?"], 33), (["@@@", "hh", None, ""], 64), (["", None], 33), ([], 33)])
def test_quality_base(spark, quals, base):
    assert spark.createDataFrame([(q,) for q in quals], "qual string").agg(R.quality_base(F.col("qual"))).first()[0] == base
