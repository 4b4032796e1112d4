"""Finding reads in reference texts by k-mers: a screen, hits with their alignment measures, and classification.

A text's units are its characters, or what a pattern separates; a k-mer is k units in a row. It is known by XXH64 under two
seeds, 128 bits in all, so that joins move no strings; the second seed's half tells apart what the first one mixes up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwise.operators.taxonomy import common_ancestor, numbered_tree
from strandwise.scratch import written, written_counted

#: Bits of the filter of k-mers: BITS for each k-mer, at least LEAST and never more than MOST (128 MB), in segments of SEGMENT bytes.
BITS, LEAST, MOST, SEGMENT = 12, 1 << 20, 1 << 30, 1 << 16


def _hashed_units(texts: DataFrame, k: int, unit: str, name: str) -> DataFrame:
    """name, units, count (of k-mers) and the units' hashes under both seeds as arrays __a and __b; texts of fewer than k units are left out."""
    parts = F.array_remove(F.split("seq", unit), "")
    hashed = texts.select(F.col("id").alias(name), F.transform(parts, lambda c: F.xxhash64(c)).alias("__a"), F.transform(parts, lambda c: F.xxhash64(F.lit(1), c)).alias("__b"))
    return hashed.filter(F.size("__a") >= k).withColumns({"units": F.size("__a"), "count": F.size("__a") - (k - 1)})


def _shifted(half: str, k: int) -> dict[str, Column]:
    """The hashes of a k-mer's units, by their place in it: arrays that begin 0 to k - 1 units later."""
    return {f"{half}{j}": F.slice(half, j + 1, F.col("count")) for j in range(k)}


def positions(texts: DataFrame, k: int, unit: str, name: str, places: bool = True) -> DataFrame:
    """name (the id), units (of the text), pos (from 0), a and b of every k-mer of texts (id, seq); without ``places`` only name, a and b.

    Null texts and those of fewer units have none. Each unit is hashed once; shifted by 0 to k - 1 units the hashes are laid
    side by side, so that a k-mer is a row of them and its own hashes are taken in generated code.
    """
    side = _shifted("__a", k) | _shifted("__b", k) | ({"pos": F.sequence(F.lit(0), F.col("count") - 1)} if places else {})
    rows = _hashed_units(texts, k, unit, name).select(name, "units", F.inline(F.arrays_zip(*side.values())).alias(*side))
    halves = [F.xxhash64(*_shifted(f"__{half}", k)).alias(half) for half in "ab"]
    return rows.select(name, *(["units", "pos"] if places else []), *halves)


def _segments(bits: int):
    """A mapInArrow body: the bits of hashes (column a), in segments: segment, blob."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in _probes(batch.column(0).to_numpy(zero_copy_only=False), bits):
                of = at // (8 * SEGMENT)
                order = np.argsort(of, kind="stable")
                cuts = np.flatnonzero(np.diff(of[order])) + 1
                for part in np.split(at[order], cuts):
                    if len(part):
                        segment = held.setdefault(int(part[0] // (8 * SEGMENT)), np.zeros(8 * SEGMENT, bool))
                        segment[part % (8 * SEGMENT)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([np.packbits(x).tobytes() for x in held.values()], pa.binary())], ["segment", "blob"])

    return run


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash."""
    h = hashes.view(np.uint64)
    return tuple(((x * np.uint64(bits)) >> np.uint64(32)).astype(np.int64) for x in (h >> np.uint64(32), h & np.uint64(0xFFFFFFFF)))


def _united(rows: pa.Table) -> pa.Table:
    whole = np.zeros(SEGMENT, np.uint8)
    for blob in rows.column("blob"):
        whole |= np.frombuffer(blob.as_py(), np.uint8)
    return pa.table({"segment": rows.column("segment").slice(0, 1), "blob": pa.array([whole.tobytes()], pa.binary())})


class Filter:
    """A Bloom filter of k-mers: built by tasks segment by segment, then held whole (at most MOST bits) where it is tested."""

    def __init__(self, kmers: DataFrame, count: int):
        self.bits = min(max(BITS * count, LEAST), MOST)
        parts = kmers.select("a").mapInArrow(_segments(self.bits), "segment long, blob binary").groupBy("segment").applyInArrow(_united, "segment long, blob binary")
        whole = np.zeros(-(-self.bits // (8 * SEGMENT)) * SEGMENT, np.uint8)
        for r in parts.collect():  # at most MOST bits
            whole[r.segment * SEGMENT : (r.segment + 1) * SEGMENT] = np.frombuffer(r.blob, np.uint8)
        self.held = kmers.sparkSession.sparkContext.broadcast(whole)

    def passing(self, kmers: DataFrame) -> DataFrame:
        """The rows of kmers (a, ...) that may be in the set; all that are."""
        bits, held, schema = self.bits, self.held, kmers.schema
        place = kmers.columns.index("a")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = held.value
            for batch in batches:
                one, two = _probes(batch.column(place).to_numpy(zero_copy_only=False), bits)
                ok = (whole[one >> 3] >> (7 - (one & 7)).astype(np.uint8)) & (whole[two >> 3] >> (7 - (two & 7)).astype(np.uint8)) & 1
                yield batch.filter(pa.array(ok.astype(bool)))

        return kmers.mapInArrow(run, schema)


def kmer_screen(reads: DataFrame, reference: DataFrame, k: int, min_hits: int = 1, unit: str = "", min_frac: float = 0.0) -> DataFrame:
    """id, hits, frac of reads (id, seq) with at least min_hits distinct k-mers, and at least min_frac of their distinct k-mers, anywhere in the reference.

    A filter of the reference's k-mers is tested where the reads are read, and a filter of what passed where the reference
    is read, so that only k-mers which may be on both sides are shuffled and compared in full. Ids that repeat are one read;
    texts that are null or shorter than a k-mer have none; an empty reference finds nothing.
    """
    whole, n = written_counted(positions(reference.select("id", "seq"), k, unit, "target", False).select("a", "b"), "screen-reference")
    mine = positions(reads.select("id", "seq"), k, unit, "id", False)
    near, n = written_counted(Filter(whole, n).passing(mine), "screen-passed")
    both = Filter(near, n).passing(whole)
    hits = near.join(both.distinct(), ["a", "b"], "left_semi").groupBy("id").agg(F.count_distinct("a", "b").alias("hits")).filter(F.col("hits") >= min_hits)
    # The reads' own k-mers are counted for those alone that the filter leaves a hit.
    found = written(hits, "screen-hits")
    sizes = positions(reads.select("id", "seq").join(found.select("id"), "id", "left_semi"), k, unit, "id", False).groupBy("id").agg(F.count_distinct("a", "b").alias("n"))
    out = found.join(sizes, "id").select("id", "hits", (F.col("hits") / F.col("n")).alias("frac"))
    return out.filter(F.col("frac") >= min_frac)


def _occurrences(kmers: DataFrame, name: str, prefix: str) -> DataFrame:
    """kmers with the number of times each stands in its text, and which of them a row is (from 1)."""
    own = Window.partitionBy(name, "a", "b")
    return kmers.withColumn(f"{prefix}_times", F.count(F.lit(1)).over(own)).withColumn(f"{prefix}_nth", F.row_number().over(own.orderBy("pos"))).withColumnsRenamed({"pos": f"{prefix}_pos", "units": f"{prefix}_units"})


def _candidates(mine: DataFrame, theirs: DataFrame, min_frac: float, sizes: DataFrame | None = None) -> DataFrame:
    """(query, target, n): the pairs that may share min_frac of the query's n distinct k-mers.

    A query that shares s of its n k-mers with a target shares one of any n - s + 1 of them. Those that fewest targets
    hold are taken, so that a k-mer which all texts hold pairs up only texts that have hardly any others. mine may lack
    k-mers that no target holds if ``sizes`` (query, n) counts them.
    """
    sizes = mine.groupBy("query").agg(F.count(F.lit(1)).alias("n")) if sizes is None else sizes
    spread = theirs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("df"))
    size = Window.partitionBy("query")
    ranked = mine.join(spread, ["a", "b"]).withColumn("present", F.count(F.lit(1)).over(size)).withColumn("rn", F.row_number().over(size.orderBy("df", "a", "b")))
    least = F.greatest(F.ceil(F.col("n") * min_frac - 1e-9), F.lit(1))
    # All that no target holds come first in the order, and find nothing.
    probes = ranked.join(sizes, "query").filter(F.col("rn") <= F.col("present") - least + 1).select("query", "n", "a", "b")
    return probes.join(theirs, ["a", "b"]).select("query", "target", "n").distinct()


def _on_both_sides(reads: DataFrame, reference: DataFrame, k: int, unit: str, places: bool = True) -> tuple[DataFrame, DataFrame]:
    """The positions of reads (query) and reference (target), written, without k-mers that the other side surely lacks.

    A filter of the side with fewer bytes is tested where the other is read, then one of what passed where the first is.
    """
    sides = {name: (texts, positions(texts.select("id", "seq"), k, unit, name, places)) for name, texts in (("query", reads), ("target", reference))}
    volume = {name: texts.agg(F.coalesce(F.sum(F.octet_length(F.col("seq").cast("string"))), F.lit(0))).first()[0] for name, (texts, _) in sides.items()}
    few, many = sorted(volume, key=volume.get)
    one, other = sides[few][1], sides[many][1]
    near = {many: written(Filter(one, one.select("a").count()).passing(other), f"hits-{many}")}
    near[few] = written(Filter(near[many], near[many].count()).passing(one), f"hits-{few}")
    return near["query"], near["target"]


def kmer_hits(reads: DataFrame, reference: DataFrame, k: int, unit: str = "", min_frac: float = 0.5, band: int = 16) -> DataFrame:
    """The hits of reads on reference texts (both id, seq): query, target, shared, containment, band and the measures of its chain.

    A target counts if it holds at least min_frac of the query's distinct k-mers: ``shared`` of them, ``containment`` in
    percent. Equal k-mers of the two texts are seeds: every place of one that is alone in its text with every place in the
    other, those that repeat in both texts first with first, second with second. Seeds whose places differ by the same
    multiple of ``band`` form a chain: seeds; q_start, q_end, t_start, t_end (units, ends past the last); aln_len = q_end -
    q_start; score, the units of the query that its seeds cover; identity = score in percent of aln_len; qlen, the query's
    units; coverage = aln_len in percent of qlen. Each chain is a row; file_order numbers a query's chains by target and band.

    Ids must not repeat. Texts that are null or shorter than a k-mer have no hits.
    """
    mine, theirs = _on_both_sides(reads, reference, k, unit)
    # A text's distinct k-mers are told apart by 64 bits where only their number counts.
    hashes = F.transform(F.arrays_zip(*_shifted("__a", k).values()), lambda r: F.xxhash64(*[r[str(j)] for j in range(k)]))
    sizes = _hashed_units(reads, k, unit, "query").select("query", F.size(F.array_distinct(hashes)).alias("n"))
    pairs = written(_candidates(mine.select("query", "a", "b").distinct(), theirs.select("target", "a", "b").distinct(), min_frac, sizes), "hits-candidates")
    q = _occurrences(mine.join(pairs.select("query").distinct(), "query", "left_semi"), "query", "q")
    t = written(_occurrences(theirs.join(pairs.select("target").distinct(), "target", "left_semi"), "target", "t"), "hits-targets")
    asked = written(pairs.join(q, "query"), "hits-asked")
    single = asked.filter("q_times = 1").join(t, ["target", "a", "b"])
    one = asked.filter("q_times > 1").join(t.filter("t_times = 1"), ["target", "a", "b"])
    repeated = asked.filter("q_times > 1").join(t.filter("t_times > 1").withColumn("q_nth", F.col("t_nth")), ["target", "a", "b", "q_nth"])
    keep = ["query", "target", "n", "a", "b", "q_pos", "q_units", "t_pos"]
    seeds = single.select(*keep).unionByName(one.select(*keep)).unionByName(repeated.select(*keep))
    seeds = written(seeds.withColumn("band", F.floor((F.col("t_pos") - F.col("q_pos")) / band).cast("int")), "hits-seeds")
    held = seeds.groupBy("query", "target", "n").agg(F.count_distinct("a", "b").alias("shared")).filter(F.col("shared") >= F.col("n") * min_frac - 1e-9)
    chain = ["query", "target", "band"]
    places = seeds.groupBy(*chain, "q_units", "q_pos").agg(F.min("t_pos").alias("t_min"), F.max("t_pos").alias("t_max"), F.count(F.lit(1)).alias("k"))
    after = F.lead("q_pos").over(Window.partitionBy(*chain).orderBy("q_pos"))
    covered = F.least(F.lit(k), F.coalesce(after - F.col("q_pos"), F.lit(k)))
    chains = places.withColumn("covered", covered).groupBy(*chain, "q_units").agg(
        F.sum("k").alias("seeds"), F.min("q_pos").alias("q_start"), (F.max("q_pos") + k).alias("q_end"), F.min("t_min").alias("t_start"), (F.max("t_max") + k).alias("t_end"), F.sum("covered").cast("int").alias("score")
    )
    met = chains.join(held, ["query", "target"]).withColumn("aln_len", F.col("q_end") - F.col("q_start"))
    place = F.row_number().over(Window.partitionBy("query").orderBy("target", "band"))
    percent = lambda part, whole: (100.0 * F.col(part) / F.col(whole))
    return met.select("query", "target", "shared", percent("shared", "n").alias("containment"), "band", "seeds", "q_start", "q_end", "t_start", "t_end", "aln_len", "score", percent("score", "aln_len").alias("identity"), F.col("q_units").alias("qlen"), percent("aln_len", "q_units").alias("coverage"), place.alias("file_order"))


def kmer_counts(reads: DataFrame, reference: DataFrame, k: int, unit: str = "") -> DataFrame:
    """query, target, shared: every pair that shares any k-mer. As many rows as there are such pairs: ``kmer_hits`` asks for more in common.

    k-mers that the other side surely lacks are left out where the texts are read; no others are shuffled.
    """
    mine, theirs = _on_both_sides(reads, reference, k, unit, False)
    return mine.distinct().join(theirs.distinct(), ["a", "b"]).groupBy("query", "target").agg(F.count(F.lit(1)).alias("shared"))


def kmer_taxa(met: DataFrame, taxa: DataFrame, tree: DataFrame) -> DataFrame:
    """(a, b, taxid): each k-mer of the reference (met: target, a, b) with the lowest common ancestor of the texts (taxa: id, taxid) that hold it.

    A k-mer keeps the first and the last preorder number of its texts' taxa, whatever their number. Texts without a taxon of
    the tree are left out. ``tree`` is what ``numbered_tree`` gives.
    """
    placed = taxa.select("id", "taxid").join(tree.select("taxid", "enter"), "taxid").select(F.col("id").alias("target"), "enter")
    ends = met.join(placed, "target").groupBy("a", "b").agg(F.min("enter").alias("lo"), F.max("enter").alias("hi"))
    return common_ancestor(ends, tree).select("a", "b", F.col("lca").alias("taxid"))


def kmer_lca_classify(reads: DataFrame, reference: DataFrame, taxa: DataFrame, nodes: DataFrame, k: int, unit: str = "") -> DataFrame:
    """read_id, taxid: each distinct k-mer of a read votes for the lowest common ancestor of the references that hold it;
    of the taxa voted for, the one with the heaviest way to the root counts; ties: the smaller taxid; 0 without a vote.

    reads and reference are (id, seq), taxa is (id, taxid) of the references, nodes the tree. A k-mer meets one row; those
    that the other side surely lacks are left out where the texts are read.
    """
    tree = numbered_tree(nodes)
    near, theirs = _on_both_sides(reads, reference, k, unit, False)
    mine = near.withColumnRenamed("query", "read_id").distinct()
    votes = mine.join(kmer_taxa(theirs, taxa, tree), ["a", "b"]).groupBy("read_id", "taxid").agg(F.count(F.lit(1)).alias("w"))
    votes = written(votes, "kmer-votes")
    way = votes.select("read_id", "taxid").join(tree.select("taxid", "path"), "taxid").select("read_id", "taxid", F.explode("path").alias("ancestor"))
    along = way.join(votes.select("read_id", F.col("taxid").alias("ancestor"), "w"), ["read_id", "ancestor"])
    heavy = along.groupBy("read_id", "taxid").agg(F.sum("w").alias("w"))
    best = heavy.groupBy("read_id").agg(F.max_by("taxid", F.struct("w", -F.col("taxid"))).alias("taxid"))
    return reads.select(F.col("id").alias("read_id")).distinct().join(best, "read_id", "left").select("read_id", F.coalesce("taxid", F.lit(0)).alias("taxid"))
