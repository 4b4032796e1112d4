"""Keeping mates together: routing, screening, duplicates and re-inflation of reads, by semi- and anti-joins on ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwise.scratch import numbered


def pair_sync(mate1: DataFrame, mate2: DataFrame) -> DataFrame:
    """All reads with ``part``: pair_1 and pair_2 for ids in both mates, singletons for the others."""
    ids1, ids2 = mate1.select("read_id"), mate2.select("read_id")
    both = lambda a, b, part: a.join(b, "read_id", "left_semi").withColumn("part", F.lit(part))
    alone = mate1.join(ids2, "read_id", "left_anti").unionByName(mate2.join(ids1, "read_id", "left_anti"))
    return both(mate1, ids2, "pair_1").unionByName(both(mate2, ids1, "pair_2")).unionByName(alone.withColumn("part", F.lit("singletons")))


def route_by_hits(reads: DataFrame, aln: DataFrame, mode: str = "high") -> DataFrame:
    """reads with ``rejected``. high: any mapped row rejects; low: only if no row is unmapped. Reads without rows stay."""
    unmapped = F.col("flag").bitwiseAND(4) != 0
    seen = aln.groupBy(F.col("query").alias("read_id")).agg(F.bool_or(~unmapped).alias("hit"), F.bool_or(unmapped).alias("miss"))
    bad = F.col("hit") if mode == "high" else ~F.col("miss")
    return reads.join(seen, "read_id", "left").withColumn("rejected", F.coalesce(bad, F.lit(False))).drop("hit", "miss")


def screen_filter(reads: DataFrame, hits1: DataFrame, hits2: DataFrame, stringency: str = "high") -> DataFrame:
    """reads with ``accepted``: contaminated ids are those of either mate (high) or of both (low)."""
    ids = hits1.select("read_id").union(hits2.select("read_id")).distinct() if stringency == "high" else hits1.select("read_id").intersect(hits2.select("read_id"))
    return reads.join(ids.withColumn("bad", F.lit(True)), "read_id", "left").withColumn("accepted", F.col("bad").isNull()).drop("bad")


def unbalanced_ids(mate1: DataFrame, mate2: DataFrame) -> DataFrame:
    """read_id, n1, n2 of ids that the two mates do not hold equally often."""
    both = mate1.select("read_id", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(mate2.select("read_id", F.lit(0).alias("a"), F.lit(1).alias("b")))
    return both.groupBy("read_id").agg(F.sum("a").alias("n1"), F.sum("b").alias("n2")).filter("n1 <> n2")


def assert_same_ids(mate1: DataFrame, mate2: DataFrame, what: str) -> None:
    """Raise if the mates' ids differ; at most one row comes back."""
    odd = unbalanced_ids(mate1, mate2).take(1)
    if odd:
        raise ValueError(f"{what}: read {odd[0].read_id} stands {odd[0].n1} and {odd[0].n2} times in the mates")


def assert_disjoint(one: DataFrame, other: DataFrame, what: str) -> None:
    """Raise if the two read sets share an id (singletons and pairs must not)."""
    shared = one.select("read_id").join(other.select("read_id"), "read_id", "left_semi").take(1)
    if shared:
        raise ValueError(f"{what}: read {shared[0].read_id} is in both sets")


def pair_balance(sets: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """reads (the set's name), n1, n2: rows of either mate of each set."""
    rows = [m.select(F.lit(name).alias("reads"), F.lit(1 - i).alias("a"), F.lit(i).alias("b")) for name, mates in sets.items() for i, m in enumerate(mates)]
    every = rows[0]
    for r in rows[1:]:
        every = every.unionByName(r)
    return every.groupBy("reads").agg(F.sum("a").alias("n1"), F.sum("b").alias("n2"))


def assert_pairs_balanced(sets: dict[str, tuple[DataFrame, DataFrame]]) -> None:
    """Raise if the mates of any set differ in number."""
    for r in pair_balance(sets).collect():  # one row a set
        if r.n1 != r.n2:
            raise ValueError(f"bad data in {r.reads}: {r.n1} and {r.n2} reads")


def rrna_split(reads: DataFrame, hits1: list[DataFrame], hits2: list[DataFrame] | None = None, stringency: str = "high") -> DataFrame:
    """reads with ``accepted``: not rRNA. The hits of a mate are those of all tools; hits2 None: single reads.

    Pairs are rRNA where either mate has a hit (high) or both have (low).
    """
    def every(hits: list[DataFrame]) -> DataFrame:
        ids = hits[0].select("read_id")
        for h in hits[1:]:
            ids = ids.unionByName(h.select("read_id"))
        return ids

    one = every(hits1)
    return screen_filter(reads, one, one if hits2 is None else every(hits2), stringency)


def sort_reads(reads: DataFrame) -> DataFrame:
    """Reads with their place (from 0) in the order of their ids, which must differ; ranges of ids are sorted each by itself."""
    return numbered(reads, ["read_id"], "place")


def exact_dedup(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Clusters (rep_id, member_id) of reads with equal keys; the smallest id represents. Aggregated first, so one key is never one task's window.

    Keys meet by their SHA-256, so that no text is shuffled; a null key equals a null key.
    """
    digest = F.sha2(F.concat_ws("/", *[F.coalesce(F.sha2(F.col(k).cast("binary"), 256), F.lit("null")) for k in keys]), 256)
    slim = reads.select("read_id", digest.alias("digest"))
    reps = slim.groupBy("digest").agg(F.min("read_id").alias("rep_id"))
    return slim.join(reps, "digest").select("rep_id", F.col("read_id").alias("member_id"))


def repopulate(survivors: DataFrame, clusters: DataFrame, full: DataFrame) -> DataFrame:
    """The rows of full whose id survived itself or through the representative of its cluster."""
    met = survivors.select(F.col("read_id").alias("rep_id")).join(clusters, "rep_id", "left")
    ids = met.select(F.coalesce("member_id", "rep_id").alias("read_id")).unionByName(survivors.select("read_id")).distinct()
    return full.join(ids, "read_id", "left_semi")


def removed_by_stage(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.join(after.select("read_id"), "read_id", "left_anti")


def conditional_pair_keep(mate1: DataFrame, mate2: DataFrame, alive1: DataFrame, alive2: DataFrame) -> DataFrame:
    """Rows of both mates with ``kept``: the id survived in both."""
    ids = alive1.select("read_id").intersect(alive2.select("read_id")).withColumn("ok", F.lit(True))
    return mate1.unionByName(mate2).join(ids, "read_id", "left").withColumn("kept", F.col("ok").isNotNull()).drop("ok")


def mapped_split(aln: DataFrame) -> DataFrame:
    """query and mapped: mapped at least once over all alignments."""
    return aln.groupBy("query").agg(F.bool_or(F.col("flag").bitwiseAND(4) == 0).alias("mapped"))


def leftover_reads(mate1: DataFrame, mate2: DataFrame, annotated: DataFrame, singletons: DataFrame | None = None, contigs: DataFrame | None = None) -> DataFrame:
    """Ids without annotation, with ``part``: pairs where both mates are left, singletons where one is; prior singletons and
    contigs that are left keep their part. annotated is (read_id, m) with m 1 and 2 for the mates, 0 for singletons and 3 for contigs.
    """
    every = mate1.select("read_id", F.lit(1).alias("m")).unionByName(mate2.select("read_id", F.lit(2).alias("m")))
    for frame, m in ((singletons, 0), (contigs, 3)):
        if frame is not None:
            every = every.unionByName(frame.select("read_id", F.lit(m).alias("m")))
    left = every.join(annotated, ["read_id", "m"], "left_anti")
    group = F.when(F.col("m") == 3, "contigs").otherwise("reads")
    return left.groupBy("read_id", group.alias("kind")).agg(F.when(F.max("m") == 3, "contigs").when(F.count_distinct(F.nullif(F.col("m"), F.lit(0))) == 2, "pair").otherwise("singletons").alias("part")).drop("kind")


def contig_flag(reads: DataFrame, contig_reads: DataFrame) -> DataFrame:
    """read_id and in_contig (yes or no)."""
    inside = contig_reads.select("read_id").distinct().withColumn("x", F.lit(True))
    return reads.select("read_id").distinct().join(inside, "read_id", "left").select("read_id", F.when(F.col("x").isNotNull(), "yes").otherwise("no").alias("in_contig"))


def unique_contigs(contig_reads: DataFrame) -> DataFrame:
    """Contigs none of whose reads is in another contig."""
    pairs = contig_reads.select("contig_id", "read_id").distinct()
    shared = pairs.groupBy("read_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    bad = pairs.join(shared, "read_id", "left_semi").select("contig_id").distinct()
    return pairs.select("contig_id").distinct().join(bad, "contig_id", "left_anti")


def aligned_contig_reads(aln: DataFrame, passes: Column) -> DataFrame:
    """(contig_id, read_id) of the alignments that pass, each pair once: what ``fractional_counts`` and contig maps are made from."""
    return aln.filter(passes).select(F.col("target").alias("contig_id"), F.col("query").alias("read_id")).distinct()


def fractional_counts(contig_reads: DataFrame) -> DataFrame:
    """contig_id and its reads, each counting 1 / (contigs that hold it)."""
    pairs = contig_reads.select("contig_id", "read_id").distinct()
    n = pairs.groupBy("read_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.join(n, "read_id").groupBy("contig_id").agg(F.sum(1 / F.col("n")).alias("reads"))


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order.

    Spark reduces such a numbering map-side (WindowGroupLimit), so every task sends at most one row of a key, hot or not.
    """
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("rn = 1").drop("rn")
