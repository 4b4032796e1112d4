"""Best hits, gene maps and abundance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwise.operators.route import first_by
from strandwise.scratch import written


def best_hit(hits: DataFrame, passes: Column, score: str, mode: str = "best") -> DataFrame:
    """Per query the passing hit of the highest score; ties: earlier file order, then the smaller target.

    mode strict: a failing row cancels what passed before it (a higher score, or an equal one earlier), so only the hits
    after a query's last failing row count. A null of ``passes`` fails; a null score comes last.
    """
    order = [F.col(score).desc(), F.col("file_order"), F.col("target")]
    if mode == "best":
        return first_by(hits.filter(passes), ["query"], order)
    place = F.struct(F.col(score).isNull().alias("none"), (-F.col(score)).alias("down"), F.col("file_order"), F.col("target"))
    # Both sides of the join are put together by aggregation; no query's hits are sorted among themselves.
    failed = hits.filter(~F.coalesce(passes, F.lit(False))).groupBy("query").agg(F.max(place).alias("__failed"))
    after = hits.filter(passes).join(failed, "query", "left").filter(F.col("__failed").isNull() | (place > F.col("__failed")))
    return after.groupBy("query").agg(F.min_by(F.struct(*hits.columns), place).alias("__best")).select("__best.*")


def unmapped_queries(queries: DataFrame, best: DataFrame) -> DataFrame:
    return queries.join(best.select("query"), "query", "left_anti")


def unmapped_in_all_chunks(left: DataFrame, chunks: int) -> DataFrame:
    """Queries that every one of the chunks left over (columns query, chunk)."""
    return left.groupBy("query").agg(F.count_distinct("chunk").alias("n")).filter(F.col("n") == chunks).select("query")


def expand_contigs(best: DataFrame, contig_reads: DataFrame | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(gene_id, read_id, score): a query that is a contig stands for its reads, another one for itself. ``keep`` names columns of best that stay."""
    genes = best.select(F.col("target").alias("gene_id"), "query", "score", *[c for c in keep if c != "query"])
    if contig_reads is None:
        return genes.select("gene_id", F.col("query").alias("read_id"), "score", *keep)
    met = genes.join(contig_reads.select(F.col("contig_id").alias("query"), F.col("read_id").alias("member")), "query", "left")
    return met.select("gene_id", F.coalesce("member", "query").alias("read_id"), "score", *keep)


def attach_gene_length(gene_reads: DataFrame, genes: DataFrame) -> DataFrame:
    """Inner join with the genes' lengths; genes the database lacks are dropped."""
    return gene_reads.join(genes, "gene_id")


#: The order in which tools and contexts win ties (fixed values of the pipeline); labels not named here follow by name.
TOOLS, CONTEXTS = ("bwa", "blat", "dmd"), ("pair_1", "pair_2", "singletons", "contigs")


def merge_gene_maps(gene_reads: DataFrame, tools: tuple[str, ...] = TOOLS, contexts: tuple[str, ...] = CONTEXTS) -> DataFrame:
    """Per read the gene of the highest score; ties: tool and context in the given order, then the smaller gene.

    Columns gene_id, read_id, score, tool, context.
    """
    def rank(column: str, order: tuple[str, ...]) -> list[Column]:
        place = F.array_position(F.array(*map(F.lit, order)), F.col(column)) if order else F.lit(0)
        return [F.when(place > 0, place).otherwise(len(order) + 1), F.col(column)]

    return first_by(gene_reads, ["read_id"], [F.col("score").desc(), *rank("tool", tools), *rank("context", contexts), F.col("gene_id")])


def gene_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("gene_id").agg(F.count_distinct("read_id").alias("reads"))


def rpkm(gene_reads: DataFrame) -> DataFrame:
    """gene_id, length, reads, rpkm = reads / ((length / 1000) * (mapped / 1e6)) from distinct reads with gene lengths.

    The total is a one-row aggregate of the per-gene counts, joined to them; no row is sent to one task.
    """
    counts = gene_reads.groupBy("gene_id", "length").agg(F.count_distinct("read_id").alias("reads"))
    total = counts.agg(F.sum("reads").alias("mapped"))
    return counts.join(F.broadcast(total)).select("gene_id", "length", "reads", (F.col("reads") / ((F.col("length") / 1000) * (F.col("mapped") / 1e6))).alias("rpkm"))


def rpkm_by_taxon(gene_reads: DataFrame, genes: DataFrame, read_taxa: DataFrame) -> DataFrame:
    """gene_id, length, reads, rpkm, taxid, taxon_reads, taxon_rpkm: each gene's RPKM and that of each reported taxon's reads.

    read_taxa is (read_id, taxid), one row a read, as a roll-up has re-pointed them (the root stands for unclassified). A
    read without a row counts in the gene's own measures only; a gene without any has one row with a null taxid.
    """
    own = gene_reads.select("gene_id", "read_id").distinct()
    per = own.join(read_taxa.select("read_id", "taxid"), "read_id", "left").groupBy("gene_id", "taxid").agg(F.count(F.lit(1)).alias("taxon_reads"))
    sized = per.groupBy("gene_id").agg(F.sum("taxon_reads").alias("reads"), F.array_compact(F.collect_list(F.when(F.col("taxid").isNotNull(), F.struct("taxid", "taxon_reads")))).alias("taxa")).join(genes.select("gene_id", "length"), "gene_id")
    total = sized.agg(F.sum("reads").alias("mapped"))
    div = (F.col("length") / 1000) * (F.col("mapped") / 1e6)
    rows = sized.join(F.broadcast(total)).select("gene_id", "length", "reads", div.alias("div"), F.explode_outer("taxa").alias("t"))
    return rows.select("gene_id", "length", "reads", (F.col("reads") / F.col("div")).alias("rpkm"), F.col("t.taxid").alias("taxid"), F.coalesce("t.taxon_reads", F.lit(0)).alias("taxon_reads"), (F.coalesce("t.taxon_reads", F.lit(0)) / F.col("div")).alias("taxon_rpkm"))


def rpkm_of_groups(by_taxon: DataFrame, members: DataFrame, group: str) -> DataFrame:
    """group, genes, rpkm, taxid, taxon_rpkm: the sums over the genes of each group (members: gene_id, group), total and by taxon."""
    # Both sums read what is written once: the roll-up and the gene maps behind it are not worked out for each.
    of = written(by_taxon.select("gene_id", "rpkm", "taxid", "taxon_rpkm"), "gene-taxa")
    met = of.join(members.select("gene_id", group).distinct(), "gene_id")
    total = met.select("gene_id", group, "rpkm").distinct().groupBy(group).agg(F.count(F.lit(1)).alias("genes"), F.sum("rpkm").alias("rpkm"))
    per = met.filter("taxid IS NOT NULL").groupBy(group, "taxid").agg(F.sum("taxon_rpkm").alias("taxon_rpkm"))
    return total.join(per, group, "left")


def drop_multi_target(hits: DataFrame, passes: Column) -> DataFrame:
    """Queries whose passing hits all name one target, with it."""
    return hits.filter(passes).groupBy("query").agg(F.count_distinct("target").alias("n"), F.min("target").alias("target")).filter("n = 1").select("query", "target")


def claim_once(gene_reads: DataFrame, order: tuple[str, ...] = ("file_order", "query")) -> DataFrame:
    """(gene_id, read_id, score): a read reached through several contigs goes to one contig's gene.

    The highest score counts, then the first contig by ``order`` (where its hit stands in the file, then its id), then the
    smaller gene.
    """
    return first_by(gene_reads, ["read_id"], [F.col("score").desc(), *map(F.col, order), F.col("gene_id")]).select("gene_id", "read_id", "score")


def shares(df: DataFrame, key: str) -> DataFrame:
    """key, n and percent of all rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(counts.agg(F.sum("n").alias("total")))).select(key, "n", (100 * F.col("n") / F.col("total")).alias("percent"))


def n50_l50(lengths: DataFrame, column: str) -> DataFrame:
    """One row n50, l50: longest first, the length and place at which the running sum first exceeds half of the total.

    Lengths are counted first: the running sum goes over distinct lengths only.
    """
    counts = lengths.groupBy(F.col(column).alias("len")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.col("len").desc())
    run = counts.withColumn("bases", F.sum(F.col("len") * F.col("n")).over(w)).withColumn("rows", F.sum("n").over(w))
    total = counts.agg(F.sum(F.col("len") * F.col("n")).alias("total"))
    first = run.join(F.broadcast(total)).filter(F.col("bases") * 2 > F.col("total")).agg(F.max_by(F.struct("len", "n", "bases", "rows", "total"), "len").alias("r"))
    before = F.col("r.bases") - F.col("r.len") * F.col("r.n")
    return first.select(F.col("r.len").alias("n50"), (F.col("r.rows") - F.col("r.n") + F.floor((F.col("r.total") / 2 - before) / F.col("r.len")) + 1).cast("long").alias("l50"))
