"""Column expressions on alignments, hits and enzyme predictions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cigar_sum(cigar: Column, ops: str) -> Column:
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{ops}]"), 1), F.lit(0), lambda a, n: a + n.cast("int"))


def _pct(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(0.0))


def cigar_match_pct(cigar: Column) -> Column:
    """Matched positions as a percentage of all operations; 0 for none."""
    return _pct(_cigar_sum(cigar, "M"), _cigar_sum(cigar, "MIDNSHPX="))


def cigar_query_match_pct(cigar: Column) -> Column:
    """Matched positions as a percentage of the operations that consume the query."""
    return _pct(_cigar_sum(cigar, "M"), _cigar_sum(cigar, "MISX="))


def is_unmapped(flag: Column) -> Column:
    return flag.bitwiseAND(4) != 0


def aln_passes(flag: Column, cigar: Column, cutoff: float = 90.0) -> Column:
    return ~is_unmapped(flag) & (cigar_match_pct(cigar) >= cutoff)


def hit_passes(identity: Column, aln_len: Column, qlen: Column, score: Column, protein: bool = False) -> Column:
    """Strictly above identity 85, 65 % of the query and score 60; protein lengths count three bases each."""
    return (identity > 85) & (aln_len * (3 if protein else 1) > 0.65 * qlen) & (score > 60)


def evalue_tier(evalue: Column) -> Column:
    return F.when(evalue <= 1e-10, "HQ").when(evalue <= 1e-5, "LQ").otherwise("none")


def priam_tier(prob: Column, evalue: Column, best: Column) -> Column:
    """HQ for best rows (none behind a #) of probability 0.5 and more; else LQ below an e-value of 1e-5."""
    return F.when(best & (prob >= 0.5), "HQ").when(evalue < 1e-5, "LQ").otherwise("none")


def ec_hit_rule(aln_len: Column, identity: Column, qlen: Column, score: Column) -> Column:
    """Long hits (100 and more) need a score of 60; short ones identity 85 and 65 % of the query in bases."""
    return F.when(aln_len >= 100, score >= 60).otherwise((identity >= 85) & (100 * 3 * aln_len / qlen >= 65))


def detect_cutoff(prob: Column, positive_hits: Column) -> Column:
    """Predictions of probability 0.2 and more with over five positive hits."""
    return (prob >= 0.2) & (positive_hits > 5)


def complete_ec(ec: Column) -> Column:
    """Enzyme numbers of four parts."""
    return F.size(F.split(ec, r"\.")) == 4


def gene_source(gene_id: Column) -> Column:
    """Struct (accession, taxid) that names a gene's taxon: exactly one of the two is not null.

    Five-part ids with a kingdom (|k__) begin with their taxid, up to an underscore; nine-part ids hold the accession in the
    fourth part, a||b||c in the middle, all others before their first dot. It is decided for each gene by itself.
    """
    parts = F.split(gene_id, r"\|")
    named = gene_id.contains("|k__") & (F.size(parts) == 5)
    dotless = lambda c: F.split_part(c, F.lit("."), F.lit(1))
    accession = F.when(F.size(parts) == 9, dotless(F.get(parts, F.lit(3)))).when(gene_id.contains("||"), F.split_part(gene_id, F.lit("||"), F.lit(2))).otherwise(dotless(gene_id))
    return F.struct(F.when(~named, accession).alias("accession"), F.when(named, F.split_part(F.get(parts, F.lit(0)), F.lit("_"), F.lit(1)).try_cast("int")).alias("taxid"))
