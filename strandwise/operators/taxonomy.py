"""The taxonomy tree: ancestors, lineages, votes and roll-up.

Trees may have any depth and any number of nodes. Every node's way up to the root is put together by joining ways of 1, 4,
16, ... nodes, so a tree of depth d takes log4(d) tables of one row a node; only the taxa in use are then expanded to all
their ancestors. ``numbered_tree`` numbers the nodes in preorder: a node's descendants are the numbers from its ``enter`` to
its ``leave``, and the lowest common ancestor of any set is that of its first and its last number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strandwise.functions.hits import gene_source
from strandwise.operators.route import first_by
from strandwise.scratch import dropped, numbered, written

#: Ranks of a lineage in order, with the prefixes of their names (fixed values of the format).
RANKS = ("superkingdom", "phylum", "class", "order", "family", "genus", "species")
PREFIXES = ("k_", "p_", "c_", "o_", "f_", "g_", "s_")
#: All ranks that a taxon can be constrained to, from the top (fixed values of the format).
ALL_RANKS = ("unclassified", "superkingdom", "phylum", "subphylum", "class", "subclass", "superorder", "order", "suborder", "superfamily", "family", "subfamily", "genus", "subgenus", "species", "subspecies")
ROOT = 1
#: Nodes below the root beyond which a lineage is cut and marked as one without root (fixed value of the format).
LONGEST = 20


def paths(nodes: DataFrame) -> DataFrame:
    """(taxid, path) of every node, written: the node, its parent and so on up to the root. A missing parent means the root; a cycle is an error."""
    nodes = written(nodes.select("taxid", "parent"), "tree")
    known = nodes.select(F.col("taxid").alias("k"))
    top = F.when(F.col("taxid") != ROOT, F.coalesce("k", F.lit(ROOT)))
    ways = nodes.join(known, F.col("parent") == F.col("k"), "left").select("taxid", F.array("taxid").alias("path"), top.alias("top"), F.lit(True).alias("own"))
    root = nodes.sparkSession.range(1).select(F.lit(ROOT).alias("taxid"), F.array(F.lit(ROOT)).alias("path"), F.lit(None).cast("int").alias("top"), F.lit(False).alias("own"))
    ways = ways.unionByName(root.join(known, F.col("taxid") == F.col("k"), "left_anti"))
    length, before = 1, None
    while True:
        longer = ways
        for _ in range(3):
            step = ways.select(F.col("taxid").alias("t"), F.col("path").alias("more"), F.col("top").alias("next"))
            longer = longer.join(step, F.col("top") == F.col("t"), "left").select("taxid", F.when(F.col("t").isNull(), F.col("path")).otherwise(F.concat("path", "more")).alias("path"), F.col("next").alias("top"), "own")
        seen = Observation()
        ways = written(longer.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col("top").isNotNull()).alias("open")), "paths")
        if before is not None:
            dropped(before)
        length, before = 4 * length, ways
        if not seen.get["open"]:
            return ways.filter("own").select("taxid", "path")
        if length > seen.get["n"]:
            raise ValueError("the tree has a cycle")


def ways_of(nodes: DataFrame, taxa: DataFrame | None = None) -> DataFrame:
    """``paths``, or those of ``taxa`` (taxid; repeats count once) that the tree has."""
    ways = paths(nodes)
    return ways if taxa is None else ways.join(taxa.select("taxid"), "taxid", "left_semi")


def _expanded(ways: DataFrame) -> DataFrame:
    """All columns of ways with ancestor, distance and the ancestor's depth below the root, a row each."""
    out = ways.select(*[c for c in ways.columns if c != "path"], F.size("path").alias("__n"), F.posexplode("path").alias("distance", "ancestor"))
    return out.withColumn("depth", F.col("__n") - 1 - F.col("distance")).drop("__n")


def ancestor_closure(nodes: DataFrame, taxa: DataFrame | None = None) -> DataFrame:
    """(taxid, ancestor, distance) from every node, or those of ``taxa`` (taxid) that the tree has, up to the root; itself at 0.

    A missing parent means the root.
    """
    return _expanded(ways_of(nodes, taxa)).select("taxid", "ancestor", "distance")


def numbered_tree(nodes: DataFrame) -> DataFrame:
    """taxid, path, depth, enter, leave, written: numbers from 0 in preorder (siblings by taxid); enter to leave are a node's descendants and itself."""
    ways = paths(nodes)
    placed = numbered(ways.withColumn("down", F.reverse("path")), ["down"], "enter").drop("down")
    below = ways.select(F.explode("path").alias("taxid")).groupBy("taxid").agg(F.count(F.lit(1)).alias("n"))
    met = placed.join(below, "taxid").select("taxid", "path", (F.size("path") - 1).alias("depth"), "enter", (F.col("enter") + F.col("n") - 1).alias("leave"))
    return written(met, "numbered-tree")


def common_ancestor(ends: DataFrame, tree: DataFrame) -> DataFrame:
    """ends (lo, hi: the first and the last number of a set) with ``lca``, the taxid of its lowest common ancestor. Distinct pairs meet the tree."""
    way = lambda name: tree.select(F.col("enter").alias(name), F.col("path").alias(f"{name}_path"))
    pairs = ends.select("lo", "hi").distinct().join(way("lo"), "lo").join(way("hi"), "hi")
    found = pairs.select("lo", "hi", F.get(F.array_intersect("lo_path", "hi_path"), F.lit(0)).alias("lca"))
    return ends.join(found, ["lo", "hi"])


def _rank_of(column: str, order: tuple[str, ...] = RANKS) -> Column:
    ranks = F.create_map(*[x for i, r in enumerate(order) for x in (F.lit(r), F.lit(i))])
    return F.try_element_at(ranks, F.col(column))


def lineages(nodes: DataFrame, names: DataFrame, taxa: DataFrame | None = None) -> DataFrame:
    """(taxid, lineage): root and the seven ranks down to the most specific one; skipped ranks keep their bare prefix.

    A taxon with more than LONGEST nodes below the root gets ``no root`` in its place and the ranks of the nearest LONGEST.
    """
    up = _expanded(ways_of(nodes, taxa)).withColumn("far", F.col("depth") + F.col("distance") > LONGEST)
    named = up.filter(~F.col("far") | (F.col("distance") < LONGEST)).join(nodes.select(F.col("taxid").alias("ancestor"), "rank"), "ancestor").join(names.select(F.col("taxid").alias("ancestor"), "name"), "ancestor", "left")
    ranked = named.withColumn("i", _rank_of("rank"))
    wide = ranked.groupBy("taxid").agg(F.bool_or("far").alias("far"), F.max("i").alias("deepest"), *[F.max(F.when(F.col("i") == i, F.coalesce("name", F.lit("")))).alias(r) for i, r in enumerate(RANKS)])
    parts = [F.when(F.col("deepest") >= i, F.concat(F.lit(p), F.coalesce(F.col(r), F.lit("")))) for i, (p, r) in enumerate(zip(PREFIXES, RANKS, strict=True))]
    return wide.select("taxid", F.concat_ws(";", F.when(F.col("far"), "no root").otherwise("root"), *parts).alias("lineage"))


def classified_reads(read_taxa: DataFrame, nodes: DataFrame, names: DataFrame) -> DataFrame:
    """(flag, read_id, lineage): C and the lineage of the read's taxon; U and unclassified for taxid 0 and taxa that the tree lacks."""
    of = lineages(nodes, names, read_taxa.filter("taxid <> 0"))
    met = read_taxa.select("read_id", "taxid").join(of, "taxid", "left")
    return met.select(F.when(F.col("lineage").isNull(), "U").otherwise("C").alias("flag"), "read_id", F.coalesce("lineage", F.lit("unclassified")).alias("lineage"))


def taxa_summary(classified: DataFrame) -> DataFrame:
    """(lineage, reads): reads of each lineage string."""
    return classified.groupBy("lineage").agg(F.count(F.lit(1)).alias("reads"))


def constrain_to_rank(nodes: DataFrame, target: str, taxa: DataFrame | None = None) -> DataFrame:
    """(taxid, constrained) of every node, or of ``taxa`` (taxid): the nearest node upwards, itself included, whose rank is the target's or above.

    Ranks are those of ALL_RANKS, nodes of any other rank are passed over; the root stays the root and takes what finds no
    other. Of ``taxa``, 0, null and those that the tree lacks become 0.
    """
    fit = nodes.filter((_rank_of("rank", ALL_RANKS) <= ALL_RANKS.index(target)) | (F.col("taxid") == ROOT)).select(F.col("taxid").alias("ancestor"))
    found = ancestor_closure(nodes, taxa).join(fit, "ancestor").groupBy("taxid").agg(F.min_by("ancestor", "distance").alias("constrained"))
    if taxa is None:
        return found
    return taxa.select("taxid").distinct().join(found, "taxid", "left").select("taxid", F.coalesce("constrained", F.lit(0)).alias("constrained"))


def constrain_reads(read_taxa: DataFrame, nodes: DataFrame, target: str) -> DataFrame:
    """(flag, read_id, taxid) of reads (read_id, taxid): C and the constrained taxon, U and 0 for taxid 0 and taxa that the tree lacks."""
    of = constrain_to_rank(nodes, target, read_taxa.filter("taxid <> 0"))
    met = read_taxa.join(of, "taxid", "left").select("read_id", F.coalesce("constrained", F.lit(0)).alias("taxid"))
    return met.select(F.when(F.col("taxid") == 0, "U").otherwise("C").alias("flag"), "read_id", "taxid")


def lca(read_taxa: DataFrame, nodes: DataFrame) -> DataFrame:
    """(read_id, lca): the deepest common ancestor of a read's taxa; reads with no known taxon are left out.

    A read keeps the first and the last preorder number of its taxa, whatever their number.
    """
    tree = numbered_tree(nodes)
    met = read_taxa.select("read_id", "taxid").join(tree.select("taxid", "enter"), "taxid")
    ends = met.groupBy("read_id").agg(F.min("enter").alias("lo"), F.max("enter").alias("hi"))
    return common_ancestor(ends, tree).select("read_id", "lca")


def spread_contigs(read_taxa: DataFrame, contig_reads: DataFrame, own_wins: bool = True) -> DataFrame:
    """(read_id, taxid) of one classifier whose rows (query, taxid) name reads or contigs: a contig's taxid goes to its reads.

    own_wins: a read's own row overwrites what its contigs say. Otherwise the last row of the report counts, by its column
    ``place``. Of several contigs the first by place fills the gap; ties go to the smaller taxid.
    """
    member = contig_reads.select(F.col("contig_id").alias("query"), F.col("read_id").alias("member"))
    # Of a query's rows only the first and the last can count: they are picked before the query meets its reads.
    first, last = F.struct("place", "taxid"), F.struct((-F.col("place")).alias("place"), "taxid")
    ends = read_taxa.groupBy("query").agg(F.min(first).alias("first"), F.min(last).alias("last"))
    met = ends.join(member, "query", "left")
    own = F.col("member").isNull()
    # Own rows: the last one; contigs: the first one.
    order = F.struct((~own).cast("int").alias("own"), F.when(own, F.col("last")).otherwise(F.col("first")).alias("end")) if own_wins else F.struct(F.col("last").alias("end"))
    rows = met.select(F.coalesce("member", "query").alias("read_id"), order.alias("o"))
    return rows.groupBy("read_id").agg(F.min("o").alias("o")).select("read_id", F.col("o.end.taxid").alias("taxid"))


def combine_classifiers(read_taxa: DataFrame, tools: list[str]) -> DataFrame:
    """One row per read with a taxid column per tool, 0 where the tool has none (the largest of several)."""
    return read_taxa.groupBy("read_id").pivot("tool", tools).agg(F.max("taxid")).fillna(0)


def vote_taxon(read_taxa: DataFrame, nodes: DataFrame, least: float = 2) -> DataFrame:
    """(read_id, taxid) from votes (read_id, taxid, weight): the deepest taxon that weights of at least ``least`` support.

    A vote supports a taxon and all its ancestors; equal depths go by weight, then the smaller taxid; 0 without one.
    Votes are added up per read and taxon before they meet the tree.
    """
    votes = read_taxa.filter("taxid <> 0").groupBy("read_id", "taxid").agg(F.sum("weight").alias("w"))
    support = _expanded(votes.join(paths(nodes), "taxid")).groupBy("read_id", "ancestor").agg(F.sum("w").alias("w"), F.max("depth").alias("depth")).filter(F.col("w") >= least)
    won = support.groupBy("read_id").agg(F.max_by("ancestor", F.struct("depth", "w", -F.col("ancestor"))).alias("taxid"))
    return read_taxa.select("read_id").distinct().join(won, "read_id", "left").select("read_id", F.coalesce("taxid", F.lit(0)).alias("taxid"))


def assign_to_list(read_taxa: DataFrame, nodes: DataFrame, chosen: DataFrame) -> DataFrame:
    """(read_id, reported): the nearest ancestor within ``chosen`` (taxid); 0 (other) where none is."""
    near = ancestor_closure(nodes, read_taxa).join(chosen.select(F.col("taxid").alias("ancestor")), "ancestor").groupBy("taxid").agg(F.min_by("ancestor", "distance").alias("reported"))
    return read_taxa.join(near, "taxid", "left").select("read_id", F.coalesce("reported", F.lit(0)).alias("reported"))


def _heavy_paths(taxa: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, up) of the taxa (taxid, reads) and the root, both written: up is (taxid, ancestor, distance) among them, itself at 0;
    tree is taxid, reads, above (its nearest ancestor), head, light and place.

    A taxon's heavy child is the one with the most taxa below it. Runs of heavy children are paths: head is the first taxon of
    a taxon's path, light the paths above it (at most log2 of the number of taxa), place its distance from the root in taxa.
    """
    ways = taxa.select("taxid").join(paths(nodes), "taxid", "left")
    short = F.when(F.col("taxid") == ROOT, F.array(F.lit(ROOT))).otherwise(F.array("taxid", F.lit(ROOT)))
    root = taxa.sparkSession.range(1).select(F.lit(ROOT).alias("taxid"))
    every = taxa.select("taxid").unionByName(root).distinct()
    rows = ways.select("taxid", F.posexplode(F.coalesce("path", short)).alias("distance", "ancestor")).unionByName(root.select("taxid", F.lit(0).alias("distance"), F.col("taxid").alias("ancestor"))).distinct()
    up = written(rows.join(every.select(F.col("taxid").alias("ancestor")), "ancestor", "left_semi").select("taxid", "ancestor", "distance"), "present-ancestors")
    sizes = up.groupBy(F.col("ancestor").alias("taxid")).agg(F.count(F.lit(1)).alias("size"))
    above = up.filter("distance > 0").groupBy("taxid").agg(F.min_by("ancestor", "distance").alias("above"))
    known = written(every.join(sizes, "taxid").join(above, "taxid", "left"), "present-taxa")
    heavy = known.filter("above IS NOT NULL").groupBy("above").agg(F.max_by("taxid", F.struct("size", -F.col("taxid"))).alias("taxid"))
    heads = known.join(heavy.select("taxid"), "taxid", "left_anti").select(F.col("taxid").alias("ancestor"), F.lit(True).alias("is_head"))
    of = up.join(heads, "ancestor", "left").groupBy("taxid").agg(F.min_by("ancestor", F.when(F.col("is_head"), F.col("distance"))).alias("head"), (F.count("is_head") - 1).alias("light"), F.count(F.lit(1)).alias("place"))
    tree = known.join(of, "taxid").join(taxa, "taxid", "left").select("taxid", "reads", "above", "head", "light", "place")
    return written(tree, "heavy-paths"), up


def rollup(counts: DataFrame, nodes: DataFrame, share: float = 0.01, least: float | None = None) -> DataFrame:
    """(taxid, reported, reads) of every taxon in counts (taxid, reads): where its reads are reported after merging.

    Bottom-up, a taxon with fewer reads than the cutoff (those merged into it included) gives them to its nearest ancestor
    that has reads itself; a count equal to the cutoff stays, and so does the root, which takes what has no other. The
    cutoff is ``least`` reads, or the given share of all reads below the root. Taxid 0 counts as the root, and a taxon that
    the tree lacks stands right below it.

    The taxa are cut into heavy paths, of which any way up meets log2 of the number of taxa at most: a round merges all
    paths of one height, each from its end to its head in one task, so that a deep tree takes few rounds.
    """
    taxa = counts.select(F.when(F.col("taxid") == 0, ROOT).otherwise(F.col("taxid")).alias("taxid"), "reads").groupBy("taxid").agg(F.sum("reads").alias("reads"))
    taxa = written(taxa, "taxon-counts")
    if least is None:
        least = share * (taxa.filter(F.col("taxid") != ROOT).agg(F.sum("reads")).first()[0] or 0)
    tree, up = _heavy_paths(taxa, nodes)
    kind = taxa.schema["reads"].dataType.simpleString()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of their heads, each path from its end; what a head does not keep goes to the taxon above it."""
        head, above, carry = None, None, 0
        for batch in batches:
            taxid, more_kind = batch.schema.field("taxid").type, batch.schema.field("more").type
            out = []
            for t, now, up_to, reads, more in zip(*(batch.column(c).to_pylist() for c in ("taxid", "head", "above", "reads", "more")), strict=True):
                if now != head:
                    out += [(None, None, above, carry)] if carry else []
                    carry = 0
                total = (reads or 0) + (more or 0) + carry
                kept = t == ROOT or total >= least
                head, above, carry = now, up_to, 0 if kept else total
                out.append((t, kept, None, None))
            columns = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (taxid, pa.bool_(), taxid, more_kind), strict=True)], ["taxid", "kept", "above", "more"])
        if carry:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((None, None, above, carry), (taxid, pa.bool_(), taxid, more_kind), strict=True)], ["taxid", "kept", "above", "more"])

    done, more = None, None
    for light in range(tree.agg(F.max("light")).first()[0], -1, -1):
        mine = tree.filter(F.col("light") == light)
        mine = mine.withColumn("more", F.lit(None).cast(kind)) if more is None else mine.join(more, "taxid", "left")
        dealt = mine.select("taxid", "head", "above", "reads", "more", "place").repartition("head").sortWithinPartitions("head", F.desc("place"))
        merged = written(dealt.mapInArrow(merge, f"taxid int, kept boolean, above int, more {kind}"), "merged-paths")
        more = merged.filter("above IS NOT NULL").groupBy(F.col("above").alias("taxid")).agg(F.sum("more").cast(kind).alias("more"))
        kept = merged.filter("kept").select(F.col("taxid").alias("ancestor"))
        done = kept if done is None else done.unionByName(kept)
    found = up.join(done, "ancestor").groupBy("taxid").agg(F.min_by("ancestor", "distance").alias("reported"))
    return taxa.join(found, "taxid").select("taxid", "reported", "reads")


def rolled_counts(rolled: DataFrame) -> DataFrame:
    """(taxid, reads) of the taxa that a roll-up reports."""
    return rolled.groupBy(F.col("reported").alias("taxid")).agg(F.sum("reads").alias("reads"))


def repointed(read_taxa: DataFrame, rolled: DataFrame) -> DataFrame:
    """(read_id, taxid): every read at the taxon that reports it; taxid 0 is the root's."""
    own = read_taxa.select("read_id", F.when(F.col("taxid") == 0, ROOT).otherwise(F.col("taxid")).alias("own"))
    return own.join(rolled.select(F.col("taxid").alias("own"), "reported"), "own", "left").select("read_id", F.coalesce("reported", "own").alias("taxid"))


def best_accession(gene_taxa: DataFrame) -> DataFrame:
    """(read_id, taxid) by priority (accession first), then gene."""
    return first_by(gene_taxa, ["read_id"], [F.col("priority"), F.col("gene_id")]).select("read_id", "taxid")


def accession_to_taxid(gene_reads: DataFrame, acc_taxid: DataFrame) -> DataFrame:
    """(read_id, taxid) of gene reads (gene_id, read_id): the taxid of the gene's accession, else the one in the gene's name.

    acc_taxid is (accession, taxid); its accessions meet the distinct genes, not the reads. A read with several genes takes
    an accession's taxid before one from a name, then the smaller gene id; reads without either are left out.
    """
    genes = gene_reads.select("gene_id").distinct().withColumn("source", gene_source(F.col("gene_id"))).select("gene_id", "source.*").withColumnRenamed("taxid", "named")
    known = genes.join(acc_taxid.select("accession", F.col("taxid").alias("found")), "accession", "left")
    taxa = known.select("gene_id", F.coalesce("found", "named").alias("taxid"), F.when(F.col("found").isNotNull(), 0).otherwise(1).alias("priority")).filter("taxid IS NOT NULL")
    return best_accession(gene_reads.select("gene_id", "read_id").join(taxa, "gene_id"))


def lineage_order(nodes: DataFrame) -> DataFrame:
    """taxid, place (from 1): preorder of the tree, parents before children, siblings by taxid."""
    ways = paths(nodes).select("taxid", F.reverse("path").alias("path"))
    return numbered(ways, ["path"], "place").select("taxid", (F.col("place") + 1).cast("int").alias("place"))
