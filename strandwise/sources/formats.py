"""Text formats of sequence data: readers and writers on Spark's text source, so that any file system and split works."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.scratch import numbered
from strandwise.sources.splits import below_headers, records

#: Reads that one line of a gene map names at most; a gene with more has several lines, which the reader unites.
READS_PER_LINE = 10_000


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """read_id, seq, qual: every four physical lines are a record, whatever they begin with; the id ends at the first space.

    Records are put together where their split is read; only those that a border cuts are exchanged.
    """
    return records(spark, path).select(F.split_part(F.expr("substr(l0, 2)"), F.lit(" "), F.lit(1)).alias("read_id"), F.col("l1").alias("seq"), F.col("l3").alias("qual"))


def write_fastq(reads: DataFrame, path: str, per_file: int = 0) -> None:
    """Four lines a read (read_id, seq, qual; null is empty); at most per_file reads a file, if it is 2 or more."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    split_files(reads.select(F.concat(F.lit("@"), text("read_id"), F.lit("\n"), text("seq"), F.lit("\n+\n"), text("qual")).alias("value")), path, per_file)


def split_files(lines: DataFrame, path: str, per_file: int = 0) -> None:
    """Text files of at most per_file rows each; below 2 there is no limit."""
    lines.write.option("maxRecordsPerFile", per_file if per_file >= 2 else 0).text(path)


def chunked(rows: DataFrame, keys: list[str], per_chunk: int) -> DataFrame:
    """rows with chunk_id: numbered by keys (which must tell rows apart) from 0, per_chunk rows a chunk; below 2 all rows are chunk 0."""
    if per_chunk < 2:
        return rows.withColumn("chunk_id", F.lit(0).cast("long"))
    return numbered(rows, keys, "chunk_id").withColumn("chunk_id", F.floor(F.col("chunk_id") / per_chunk).cast("long"))


def _blocks(spark: SparkSession, path: str, separator: str, mark: str = "") -> DataFrame:
    """Non-blank records between separators, without the mark that the first one of a file begins with."""
    value = F.regexp_replace("value", f"^{mark}", "") if mark else F.col("value")
    return spark.read.option("lineSep", separator).text(path).select(value.alias("value")).filter(F.trim(F.col("value"), F.lit(" \t\r\n")) != "")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """id, description, seq, length: a > at the start of a line begins a record, whose other lines are joined without white space."""
    head, body = F.substring_index("value", "\n", 1), F.expr("if(instr(value, '\n') > 0, substr(value, instr(value, '\n') + 1), '')")
    r = _blocks(spark, path, "\n>", ">").select(F.rtrim(head).alias("h"), F.regexp_replace(body, r"\s", "").alias("seq"))
    return r.select(F.split_part("h", F.lit(" "), F.lit(1)).alias("id"), F.ltrim(F.regexp_replace("h", r"^\S*", "")).alias("description"), "seq", F.length("seq").alias("length"))


def write_fasta(seqs: DataFrame, path: str, width: int = 0, per_file: int = 0) -> None:
    """Records of id and seq; width cuts the sequence into lines."""
    seq = F.coalesce("seq", F.lit(""))
    lines = F.regexp_replace(seq, f"(.{{{width}}})", "$1\n") if width else seq
    split_files(seqs.select(F.concat(F.lit(">"), F.col("id").cast("string"), F.lit("\n"), lines).alias("value")), path, per_file)


def swap_header_marker(header: Column, mark: str = "NODE", back: bool = False) -> Column:
    """Headers with a second >mark inside get _mark there; back reverses it."""
    return F.regexp_replace(header, f"_{mark}", f">{mark}") if back else F.regexp_replace(header, f"(?<!^)>{mark}", f"_{mark}")


def strip_fasta_whitespace(lines: DataFrame) -> DataFrame:
    """Lines (value) without blanks and tabs; blank ones go."""
    return lines.select(F.translate("value", "\t ", "").alias("value")).filter("value <> ''")


def _fields(spark: SparkSession, path: str, separator: str = "\t") -> DataFrame:
    return spark.read.text(path).select("value", F.split("value", separator).alias("f"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """query, flag, target, cigar, as_score (null without the tag) of alignment rows; header and one-character lines go."""
    rows = _fields(spark, path).filter(~F.col("value").startswith("@") & (F.length("value") > 1))
    score = F.get(F.filter("f", lambda x: x.startswith("AS:i:")), 0)
    return rows.select(F.get("f", 0).alias("query"), F.get("f", 1).cast("int").alias("flag"), F.get("f", 2).alias("target"), F.get("f", 5).alias("cigar"), F.substring_index(score, ":", -1).cast("int").alias("as_score"))


def trim_sam(spark: SparkSession, path: str) -> DataFrame:
    """Rows of 13 columns and more, cut to 12, as text (value)."""
    return _fields(spark, path).filter((F.size("f") >= 13) & ~F.col("value").startswith("@")).select(F.array_join(F.slice("f", 1, 12), "\t").alias("value"))


BLAST = "query target identity aln_len mismatch gapopen qstart qend sstart send evalue bitscore".split()
WHOLE = ("aln_len", "mismatch", "gapopen", "qstart", "qend", "sstart", "send")


def read_blast_tab(spark: SparkSession, path: str, rejected: bool = False) -> DataFrame:
    """The rows of exactly twelve columns, typed; or the rejected others as text (value)."""
    rows = _fields(spark, path)
    if rejected:
        return rows.filter(F.size("f") != len(BLAST)).select("value")
    kind = lambda c: "string" if c in BLAST[:2] else "int" if c in WHOLE else "double"
    return rows.filter(F.size("f") == len(BLAST)).select(*[F.get("f", i).cast(kind(c)).alias(c) for i, c in enumerate(BLAST)])


def read_clstr(spark: SparkSession, path: str) -> DataFrame:
    """rep_id, member_id of a cluster listing; the line that ends in * names the representative (of several the smallest), null without one.

    A cluster is what stands below equal header lines, so a large one may have its header several times. Each member is a row
    from the start, however many there are.
    """
    lines = below_headers(spark, path, ">Cluster ").filter(F.col("value").contains("..."))
    found = lines.select("header", F.regexp_extract("value", r">(.*?)\.\.\.", 1).alias("member_id"), F.rtrim("value").endswith("*").alias("first"))
    reps = found.filter("first").groupBy("header").agg(F.min("member_id").alias("rep_id"))
    return found.join(reps, "header", "left").select("rep_id", "member_id")


def write_blocks(rows: DataFrame, header: str, line: str, path: str) -> None:
    """Text files of blocks: the lines (column ``line``) of each header below it; one of more than READS_PER_LINE lines comes again and again, with some of them each time."""
    n = rows.groupBy(header).agg(F.ceil(F.count(F.lit(1)) / READS_PER_LINE).alias("parts"))
    dealt = rows.join(n, header).withColumn("part", F.pmod(F.xxhash64(line), F.col("parts")))
    blocks = dealt.groupBy(header, "part").agg(F.collect_list(line).alias("lines"))
    blocks.select(F.concat(F.col(header), F.lit("\n"), F.array_join("lines", "\n")).alias("value")).write.text(path)


def write_gene_map(gene_reads: DataFrame, path: str) -> None:
    """Lines gene_id, length, reads in the line, then read<score>value for each; no line names over about READS_PER_LINE reads."""
    n = gene_reads.groupBy("gene_id").agg(F.ceil(F.count(F.lit(1)) / READS_PER_LINE).alias("lines"))
    entry = F.concat(F.col("read_id").cast("string"), F.lit("<score>"), F.col("score").cast("string"))
    rows = gene_reads.join(n, "gene_id").withColumn("part", F.pmod(F.xxhash64("read_id", "score"), F.col("lines")))
    line = rows.groupBy("gene_id", "length", "part").agg(F.collect_list(entry).alias("reads"))
    line.select(F.concat_ws("\t", F.col("gene_id").cast("string"), F.col("length").cast("string"), F.size("reads").cast("string"), F.array_join("reads", "\t")).alias("value")).write.text(path)


def write_contig_map(contig_reads: DataFrame, path: str) -> None:
    """Lines contig_id, reads in the line, read ids; no line names over about READS_PER_LINE reads."""
    n = contig_reads.groupBy("contig_id").agg(F.ceil(F.count(F.lit(1)) / READS_PER_LINE).alias("lines"))
    rows = contig_reads.join(n, "contig_id").withColumn("part", F.pmod(F.xxhash64("read_id"), F.col("lines")))
    line = rows.groupBy("contig_id", "part").agg(F.collect_list(F.col("read_id").cast("string")).alias("reads"))
    line.select(F.concat_ws("\t", F.col("contig_id").cast("string"), F.size("reads").cast("string"), F.array_join("reads", "\t")).alias("value")).write.text(path)


def read_contig_map(spark: SparkSession, path: str) -> DataFrame:
    """contig_id, read_id of a contig map, whose reads begin in the third field; lines of up to five characters are skipped."""
    rows = _fields(spark, path).filter(F.length("value") > 5)
    return rows.select(F.get("f", 0).alias("contig_id"), F.explode(F.expr("slice(f, 3, greatest(size(f) - 2, 0))")).alias("read_id"))


def read_ragged_map(spark: SparkSession, path: str) -> DataFrame:
    """gene_id, length, read_id, score of a gene map, whose reads begin in the fourth field; lines of up to five characters are skipped."""
    rows = _fields(spark, path).filter(F.length("value") > 5)
    one = rows.select(F.get("f", 0).alias("gene_id"), F.get("f", 1).cast("int").alias("length"), F.explode(F.expr("slice(f, 4, greatest(size(f) - 3, 0))")).alias("r"))
    return one.select("gene_id", "length", F.substring_index("r", "<", 1).alias("read_id"), F.regexp_extract("r", "<[^>]+>(.*)$", 1).try_cast("double").alias("score"))


def read_dmp_nodes(spark: SparkSession, path: str) -> DataFrame:
    """taxid, parent, rank, and taxid 0 (unclassified) below the root."""
    f = _fields(spark, path, r"\t\|\t?")
    zero = spark.range(1).select(F.lit(0).alias("taxid"), F.lit(1).alias("parent"), F.lit("no rank").alias("rank"))
    return f.select(F.get("f", 0).cast("int").alias("taxid"), F.get("f", 1).cast("int").alias("parent"), F.get("f", 2).alias("rank")).unionByName(zero)


def read_dmp_names(spark: SparkSession, path: str) -> DataFrame:
    """taxid, name: scientific names only, and taxid 0 as unclassified."""
    f = _fields(spark, path, r"\t\|\t?")
    zero = spark.range(1).select(F.lit(0).alias("taxid"), F.lit("unclassified").alias("name"))
    return f.filter(F.get("f", 3) == "scientific name").select(F.get("f", 0).cast("int").alias("taxid"), F.get("f", 1).alias("name")).unionByName(zero)


def read_vote_report(spark: SparkSession, path: str) -> DataFrame:
    """read_id, assignment: the first and the last field of a vote report of nine or twelve fields; other rows go."""
    return _fields(spark, path).filter(F.size("f").isin(9, 12)).select(F.get("f", 0).alias("read_id"), F.element_at("f", -1).try_cast("int").alias("assignment"))


def read_priam_blocks(spark: SparkSession, path: str, best_only: bool = True) -> DataFrame:
    """query, ec, prob, evalue and best of blocks that a >query line heads; rows behind a # are not the best ones."""
    one = below_headers(spark, path, ">").select(F.split_part(F.trim(F.expr("substr(header, 2)")), F.lit(" "), F.lit(1)).alias("query"), F.col("value").alias("r"))
    best = ~F.ltrim("r").startswith("#")
    kept = one.filter(best) if best_only else one
    f = F.transform(F.split(F.ltrim(F.col("r"), F.lit("# ")), "\t"), lambda x: F.trim(x))
    return kept.select("query", F.get(f, 0).alias("ec"), F.get(f, 1).try_cast("double").alias("prob"), F.get(f, 2).try_cast("double").alias("evalue"), best.alias("best"))


def read_ec_pairs(spark: SparkSession, path: str) -> DataFrame:
    """ec1, ec2, n of lines EC1_EC2 <tab> n after a header line; ``operators.enzyme.ec_pairs`` puts them in order."""
    f = _fields(spark, path).filter(F.get("f", 1).try_cast("long").isNotNull())
    pair = F.split(F.get("f", 0), "_")
    return f.select(F.get(pair, 0).alias("ec1"), F.get(pair, 1).alias("ec2"), F.get("f", 1).cast("long").alias("n"))


def read_enzyme_dat(spark: SparkSession, path: str) -> DataFrame:
    """ec, name, accession of a flat file of ID, DE and DR lines; one row for each accession, the name is the first DE line."""
    lines = below_headers(spark, path, "ID   ").select(F.regexp_extract("header", r"^ID   (\S+)", 1).alias("ec"), "value", "s", "at")
    names = lines.filter(F.col("value").startswith("DE   ")).groupBy("ec").agg(F.min_by("value", F.struct("s", "at")).alias("l"))
    found = lines.filter(F.col("value").startswith("DR   ")).select("ec", F.explode(F.regexp_extract_all("value", F.lit(r"(\w+), *\w+ *;"), 1)).alias("accession"))
    return found.join(names, "ec", "left").select("ec", F.coalesce(F.regexp_extract("l", r"^DE   (.*?)\.?$", 1), F.lit("")).alias("name"), "accession")


def read_pathway(spark: SparkSession, path: str) -> DataFrame:
    """pathway_id (without path:), ec of a tab-separated file without header."""
    return _fields(spark, path).select(F.regexp_replace(F.get("f", 0), "^path:", "").alias("pathway_id"), F.regexp_replace(F.get("f", 1), "^ec:", "").alias("ec"))


def read_superpathway(spark: SparkSession, path: str) -> DataFrame:
    """superpathway, pathway_id, pathway of a quoted CSV with header."""
    return spark.read.schema("superpathway string, pathway_id string, pathway string").option("header", True).option("enforceSchema", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str, kind: str = "tsv") -> None:
    """A report: tsv or csv with header, or parquet."""
    if kind == "parquet":
        df.write.parquet(path)
    else:
        df.write.option("sep", "\t" if kind == "tsv" else ",").option("header", True).csv(path)


def concat_reports(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines of several reports, with the name and the path of the file of each."""
    return spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("report"), F.col("_metadata.file_path").alias("path"))
