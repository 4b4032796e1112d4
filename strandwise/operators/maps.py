"""Merging mates and maps, contigs, reference groups and report tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.batches import slices
from strandwise.functions.reads import reverse_complement
from strandwise.operators.enzyme import ec_report
from strandwise.operators.hits import best_hit
from strandwise.operators.route import assert_disjoint, first_by


#: Places that are looked at one by one before the search turns to the prefix function.
PLACES = 16


def longest_overlap(one: str, other: str, least: int, most: int) -> int:
    """Length of the longest end of one, of least to most characters, that other begins with; 0 without one. Linear, whatever repeats."""
    most = min(most, len(one), len(other))
    if most < least:
        return 0
    # The leftmost place where the other's first characters stand is the longest overlap that can be.
    at, tries = one.find(other[:least], len(one) - most), 0
    while at >= 0 and tries < PLACES:
        if other.startswith(one[at:]):
            return len(one) - at
        at, tries = one.find(other[:least], at + 1), tries + 1
    if at < 0:
        return 0
    head, fall, k = other[:most], [0] * most, 0
    for i in range(1, most):
        while k and head[i] != head[k]:
            k = fall[k - 1]
        k += head[i] == head[k]
        fall[i] = k
    k = 0
    for i, c in enumerate(end := one[len(one) - most :]):
        while k and (k == most or c != head[k]):
            k = fall[k - 1]
        k += c == head[k]
        if k == most and i < len(end) - 1:
            k = fall[k - 1]
    return k if k >= least else 0


def merge_pairs(mate1: DataFrame, mate2: DataFrame, min_overlap: int = 10, max_overlap: int | None = None) -> DataFrame:
    """read_id, merged, overlap: mates whose ends overlap exactly (mate 1 with mate 2's reverse complement) become one read.

    The longest overlap of min_overlap bases to the whole shorter mate counts, or to max_overlap bases if that is given.
    Unmerged pairs have a null merged and overlap 0. ``mates.merge_mates`` tolerates mismatches and weighs qualities.
    """
    both = mate1.select("read_id", "seq").join(mate2.select("read_id", reverse_complement(F.col("seq")).alias("other")), "read_id")
    kind = both.schema["read_id"].dataType.simpleString()

    def longest(one: str | None, other: str | None) -> int:
        return 0 if one is None or other is None else longest_overlap(one, other, max(min_overlap, 1), len(one) if max_overlap is None else max_overlap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ones, others = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            sizes = [longest(x, y) for x, y in zip(ones, others, strict=True)]
            merged = [x + y[n:] if n else None for x, y, n in zip(ones, others, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(merged, pa.string()), pa.array(sizes, pa.int32())], ["read_id", "merged", "overlap"])

    return both.select("read_id", F.col("seq").cast("string"), "other").mapInArrow(run, f"read_id {kind}, merged string, overlap int")


def flush_unmapped_contigs(contigs: DataFrame, contig_map: DataFrame) -> DataFrame:
    return contigs.join(contig_map.select("contig_id"), "contig_id", "left_semi")


def filter_taxa_by_segments(taxa: DataFrame, segments: DataFrame, is_contig: Column) -> DataFrame:
    """Rows of taxa (query, ...) that are no contigs, and the contigs (by query) that have segments."""
    known = taxa.filter(is_contig).join(segments.select(F.col("contig_id").alias("query")), "query", "left_semi")
    return taxa.filter(~is_contig).unionByName(known.select(*taxa.columns))


def select_reference_groups(read_taxa: DataFrame, groups: DataFrame, manifest: DataFrame, cutoff: float, nodes: DataFrame | None = None) -> DataFrame:
    """taxid, percent, group, exists: taxa with at least cutoff percent of the reads, their group (null: rejected) and whether the manifest has it.

    With nodes (taxid, rank) the group's ``rank`` too, null for a group that the tree lacks.
    """
    counts = read_taxa.groupBy("taxid").agg(F.count(F.lit(1)).alias("n"))
    share = counts.join(F.broadcast(counts.agg(F.sum("n").alias("total")))).select("taxid", (100 * F.col("n") / F.col("total")).alias("percent"))
    have = manifest.select("group").distinct().withColumn("hit", F.lit(True))
    met = share.filter(F.col("percent") >= cutoff).join(groups, "taxid", "left").join(have, "group", "left").select("taxid", "percent", "group", F.coalesce("hit", F.lit(False)).alias("exists"))
    return met if nodes is None else met.join(nodes.select(F.col("taxid").alias("group"), "rank"), "group", "left").select("taxid", "percent", "group", "rank", "exists")


def reconcile_pair_maps(map1: DataFrame, map2: DataFrame) -> DataFrame:
    """Of a read that both mates map, the gene of the higher score; mate 1 wins ties, then the smaller gene."""
    both = map1.withColumn("mate", F.lit(1)).unionByName(map2.withColumn("mate", F.lit(2)))
    return first_by(both, ["read_id"], [F.col("score").desc(), F.col("mate"), F.col("gene_id")])


def concat_gene_maps(maps: list[DataFrame], distinct: bool = True) -> DataFrame:
    """gene_id, length, read_id of several maps; where lengths disagree the largest is the gene's.

    Each pair stands once, or as often as the maps hold it if ``distinct`` is off (plain appending).
    """
    every = maps[0].select("gene_id", "length", "read_id")
    for m in maps[1:]:
        every = every.unionByName(m.select("gene_id", "length", "read_id"))
    length = every.groupBy("gene_id").agg(F.max("length").alias("length"))
    pairs = every.select("gene_id", "read_id")
    return (pairs.distinct() if distinct else pairs).join(length, "gene_id")


def segment_reads(segments: DataFrame, contig_counts: DataFrame) -> DataFrame:
    """contig_id, gene_id, share, reads: a segment's part of its contig's segment lengths, and that part of the contig's reads, rounded.

    segments is (contig_id, gene_id, length); a contig without reads counts 0.
    """
    total = segments.groupBy("contig_id").agg(F.sum("length").alias("total"))
    met = segments.join(total, "contig_id").join(contig_counts.select("contig_id", "reads"), "contig_id", "left")
    share = F.col("length") / F.col("total")
    return met.select("contig_id", "gene_id", share.alias("share"), F.bround(F.coalesce("reads", F.lit(0)) * share).cast("long").alias("reads"))


def gene_taxon_counts(gene_reads: DataFrame, read_taxa: DataFrame, genes: DataFrame, gene_ec: DataFrame) -> DataFrame:
    """gene_id, taxon, length, reads, ecs: distinct reads of each gene and taxon; ecs joined by |, 0.0.0.0 without one.

    read_taxa is (read_id, taxon); reads without a taxon are left out, genes that the database lacks too.
    """
    per = gene_reads.select("gene_id", "read_id").distinct().join(read_taxa.select("read_id", "taxon"), "read_id").groupBy("gene_id", "taxon").agg(F.count(F.lit(1)).alias("reads"))
    return per.join(genes.select("gene_id", "length"), "gene_id").join(ec_report(gene_ec).select("gene_id", "ecs"), "gene_id", "left").select("gene_id", "taxon", "length", "reads", F.coalesce("ecs", F.lit("0.0.0.0")).alias("ecs"))


def read_funnel(counts: DataFrame, gene_reads: DataFrame, ecs_hq: DataFrame, ecs_lq: DataFrame) -> DataFrame:
    """One row: reads of each stage, annotated reads, genes and enzymes, with the percentages of the report as text.

    counts is one row with raw, hq, host, vector, rrna and mrna. Annotated reads are the distinct reads of the gene map;
    enzymes are the distinct numbers of ecs_hq and ecs_lq (ec) but 0.0.0.0. Percentages are of the raw reads, of the mRNA
    reads for the annotated ones.
    """
    genes = gene_reads.agg(F.count_distinct("read_id").alias("annotated"), F.count_distinct("gene_id").alias("genes"))
    known = lambda df, name: df.filter(F.col("ec") != "0.0.0.0").agg(F.count_distinct("ec").alias(name))
    # Four one-row frames side by side.
    one = counts.join(F.broadcast(genes)).join(F.broadcast(known(ecs_hq, "ecs_hq"))).join(F.broadcast(known(ecs_lq, "ecs_lq")))
    percent = lambda part, whole: F.format_string("%.2f", F.coalesce(100.0 * F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))).alias(f"{part}_percent")
    return one.select("raw", "hq", "host", "vector", "rrna", "mrna", "annotated", "genes", "ecs_hq", "ecs_lq", *[percent(p, "raw") for p in ("hq", "host", "vector", "rrna", "mrna")], percent("annotated", "mrna"))


def contig_assign(aln: DataFrame, passes: Column, singletons: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """query, contig_id: the contig of the highest passing score, null for reads that no alignment assigns.

    If singletons and pairs (read_id) are given, a read that is in both is an error.
    """
    if singletons is not None and pairs is not None:
        assert_disjoint(singletons, pairs, "contig assignment")
    best = best_hit(aln, passes, "as_score").select("query", F.col("target").alias("contig_id"))
    return aln.select("query").distinct().join(best, "query", "left")


def contig_segment_counts(gene_members: DataFrame, contig_counts: DataFrame) -> DataFrame:
    """gene_id, reads from (gene_id, member): a contig counts its reads, another member 1; genes with 0 are dropped."""
    met = gene_members.join(contig_counts.select(F.col("contig_id").alias("member"), "reads"), "member", "left")
    return met.groupBy("gene_id").agg(F.sum(F.coalesce("reads", F.lit(1))).alias("reads")).filter("reads > 0")


def explode_ec_rows(rows: DataFrame, column: str = "ecs", separator: str = r"\|") -> DataFrame:
    """One row for each enzyme number of a joined list, as column ec."""
    return rows.withColumn("ec", F.explode(F.split(column, separator))).drop(column)


def annotated_only(seqs: DataFrame, ec_accessions: DataFrame, ec_prefix: str = "") -> DataFrame:
    """Sequences (id, ...) whose accession has an enzyme number, or one that begins with ec_prefix."""
    return seqs.join(ec_accessions.filter(F.col("ec").startswith(ec_prefix)).select(F.col("accession").alias("id")), "id", "left_semi")


def taxa_table_weighted(queries: DataFrame, contig_counts: DataFrame, inside: DataFrame, is_contig: Column) -> DataFrame:
    """lineage, reads from (query, lineage): contigs weigh their reads (unknown ones 0), reads within contigs 0, others 1."""
    met = queries.withColumn("contig", is_contig).join(contig_counts.select(F.col("contig_id").alias("query"), "reads"), "query", "left")
    met = met.join(inside.select(F.col("read_id").alias("query"), F.lit(True).alias("within")).distinct(), "query", "left")
    weight = F.when(F.col("contig"), F.coalesce("reads", F.lit(0))).when(F.col("within"), 0).otherwise(1)
    return met.groupBy("lineage").agg(F.sum(weight).alias("reads"))


def category_of_lineage(lineages: DataFrame, categories: DataFrame) -> DataFrame:
    """taxid, category: that of the deepest name of the lineage that has one, else other. Lineages are ;-joined, categories (name, category)."""
    named = lineages.select("taxid", F.posexplode(F.split("lineage", ";")).alias("pos", "name")).join(categories, "name")
    return lineages.select("taxid").join(named.groupBy("taxid").agg(F.max_by("category", "pos").alias("category")), "taxid", "left").select("taxid", F.coalesce("category", F.lit("other")).alias("category"))


def drop_all_zero(long: DataFrame, column: str, value: str) -> DataFrame:
    """Rows of a long table whose column's total of value is not 0."""
    alive = long.groupBy(column).agg(F.sum(value).alias("total")).filter("total <> 0")
    return long.join(alive, column, "left_semi").select(*long.columns)


def with_totals(long: DataFrame, row: str, column: str, value: str, name: str = "All") -> DataFrame:
    """row, column, value of a long table without the columns whose total is 0, and a row ``name`` with the total of each column left.

    Values of a row and column that occur several times are added up; a null value counts 0.
    """
    cells = long.groupBy(F.col(row).cast("string").alias(row), column).agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias(value))
    totals = cells.groupBy(column).agg(F.sum(value).alias(value)).filter(F.col(value) != 0)
    kept = cells.join(totals.select(column), column, "left_semi")
    return kept.select(row, column, value).unionByName(totals.select(F.lit(name).alias(row), column, value))


def dedup_by_id(seqs: DataFrame, source_order: str, keep: str = "first") -> DataFrame:
    """One row an id: the first or the last by source order; equal orders go by the smaller sequence."""
    order = F.col(source_order) if keep == "first" else F.col(source_order).desc()
    return first_by(seqs, ["id"], [order, F.col("seq")])
