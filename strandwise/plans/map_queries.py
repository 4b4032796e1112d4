"""Queries over files, streams, maps and reports, with the same queries in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.functions import hits as X
from strandwise.functions import reads as R
from strandwise.operators import kmers as K
from strandwise.operators import maps as M
from strandwise.operators import taxonomy as T
from strandwise.plans.read_queries import KMER, _texts
from strandwise.plans.views import view, with_views
from strandwise.scratch import scratch
from strandwise.sources import formats as S
from strandwise.streaming import funnel

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = with_views(sql)
        return f

    return put


@query("SELECT read_id, seq, qual FROM v_reads")
def fastq_files(spark, d):
    path = scratch(spark, "fastq")
    S.write_fastq(view(spark, d, "v_reads"), path, 1000)
    return S.read_fastq(spark, path)


@query("SELECT read_id AS id, seq, length(seq) AS length FROM v_reads")
def fasta_files(spark, d):
    path = scratch(spark, "fasta")
    S.write_fasta(view(spark, d, "v_reads").withColumnRenamed("read_id", "id"), path, 60)
    return S.read_fasta(spark, path).select("id", "seq", "length")


@query("SELECT CAST(query AS VARCHAR) AS query, flag, CAST(target AS VARCHAR) AS target, cigar, as_score FROM v_aln")
def sam_files(spark, d):
    path = scratch(spark, "sam")
    line = F.concat_ws("\t", F.col("query").cast("string"), F.col("flag").cast("string"), F.col("target").cast("string"), F.lit("1\t60"), "cigar", F.lit("*\t0\t0\t*\t*"), F.concat(F.lit("AS:i:"), F.col("as_score").cast("string")))
    view(spark, d, "v_aln").select(line.alias("value")).write.text(path)
    return S.read_sam(spark, path)


@query("SELECT CAST(query AS VARCHAR) AS query, CAST(target AS VARCHAR) AS target, round(identity, 4) AS identity, aln_len, CAST(bitscore AS DOUBLE) AS bitscore FROM v_hits")
def blast_tab_files(spark, d):
    path = scratch(spark, "hits")
    text = lambda c: F.col(c).cast("string")
    line = F.concat_ws("\t", text("query"), text("target"), text("identity"), text("aln_len"), F.lit("0\t0\t1\t9\t1\t9\t1e-5"), text("bitscore"))
    view(spark, d, "v_hits").select(line.alias("value")).write.text(path)
    return S.read_blast_tab(spark, path).select("query", "target", F.round("identity", 4).alias("identity"), "aln_len", "bitscore")


@query("SELECT CAST(gene_id AS VARCHAR) AS gene_id, length, CAST(read_id AS VARCHAR) AS read_id, round(score, 2) AS score FROM v_gene_reads JOIN v_genes USING (gene_id)")
def gene_map_files(spark, d):
    path = scratch(spark, "gene-map")
    S.write_gene_map(view(spark, d, "v_gene_reads").join(view(spark, d, "v_genes"), "gene_id"), path)
    return S.read_ragged_map(spark, path).withColumn("score", F.round("score", 2))


@query("SELECT taxid, parent, rank FROM v_nodes UNION ALL SELECT 0, 1, 'no rank'")
def dmp_files(spark, d):
    path = scratch(spark, "nodes")
    row = F.concat_ws("\t|\t", F.col("taxid").cast("string"), F.col("parent").cast("string"), "rank", F.lit("\t|"))
    view(spark, d, "v_nodes").select(row.alias("value")).write.text(path)
    return S.read_dmp_nodes(spark, path)


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def incremental_funnel(spark, d):
    schema = view(spark, d, "events").schema
    # A pattern, as a stream refuses the plain path of a single file.
    got = funnel.incremental_counts(spark, f"{d}/event[s].parquet", schema, ["event_type"], {"n": F.lit(1), "total": F.col("value").cast("decimal(28,6)")}, scratch(spark, "funnel"), scratch(spark, "funnel-state"))
    return got.select("event_type", "n", F.round(F.col("total").cast("double"), 2).alias("total"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_funnel(spark, d):
    return funnel.windowed_counts(view(spark, d, "events"))


RC = "reverse(translate({x}, 'ACGT', 'TGCA'))"
MATES = f"""m AS (SELECT read_id, seq, concat(right(seq, CAST(doc_id % 80 AS INT)), 'GATTACA', left(seq, 50)) AS other FROM v_reads),
s AS (SELECT *, right(seq, 150) AS t, left(other, 150) AS h FROM m),
o AS (SELECT *, coalesce(list_max([n FOR n IN range(10, least(length(t), length(h)) + 1) IF right(t, n) = left(h, n)]), 0) AS overlap FROM s)"""


@query(f"WITH {MATES} SELECT read_id, CASE WHEN overlap > 0 THEN concat(seq, substr(other, overlap + 1)) END AS merged, CAST(overlap AS INT) AS overlap FROM o")
def merge_pairs(spark, d):
    v = view(spark, d, "v_reads")
    other = F.concat(F.right("seq", (F.col("doc_id") % 80).cast("int")), F.lit("GATTACA"), F.left("seq", F.lit(50)))
    return M.merge_pairs(v, v.select("read_id", R.reverse_complement(other).alias("seq")))


@query("SELECT s_suppkey AS contig_id, s_name FROM supplier WHERE s_suppkey IN (SELECT contig_id FROM v_contig)")
def flush_unmapped_contigs(spark, d):
    return M.flush_unmapped_contigs(view(spark, d, "supplier").select(F.col("s_suppkey").alias("contig_id"), "s_name"), view(spark, d, "v_contig"))


@query("""WITH g AS (SELECT name, l_orderkey AS read_id FROM lineitem JOIN v_gene_names ON gene_id = l_partkey), n AS (SELECT DISTINCT name, string_split(name, '|') AS p FROM g),
s AS (SELECT name, CASE WHEN len(p) = 5 AND contains(name, '|k__') THEN NULL WHEN len(p) = 9 THEN split_part(p[4], '.', 1) WHEN contains(name, '||') THEN split_part(name, '||', 2) ELSE split_part(name, '.', 1) END AS accession, CASE WHEN len(p) = 5 AND contains(name, '|k__') THEN CAST(split_part(p[1], '_', 1) AS INT) END AS named FROM n),
t AS (SELECT name, coalesce(a.taxid, named) AS taxid, CASE WHEN a.taxid IS NOT NULL THEN 0 ELSE 1 END AS priority FROM s LEFT JOIN v_acc_taxid a USING (accession))
SELECT read_id, taxid FROM g JOIN t USING (name) WHERE taxid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY priority, name) = 1""")
def accession_to_taxid(spark, d):
    named = view(spark, d, "v_gene_names").select("gene_id", "name")
    g = view(spark, d, "lineitem").select(F.col("l_partkey").alias("gene_id"), F.col("l_orderkey").alias("read_id")).join(named, "gene_id").select(F.col("name").alias("gene_id"), "read_id")
    return T.accession_to_taxid(g, view(spark, d, "v_acc_taxid"))


SEGMENTS = "s AS (SELECT DISTINCT l_suppkey AS contig_id FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)"


@query(f"WITH {SEGMENTS} SELECT o_orderkey AS query, o_orderstatus AS taxon FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey IN (SELECT contig_id FROM s)")
def filter_taxa_by_contig_segments(spark, d):
    seg = view(spark, d, "lineitem").filter("l_returnflag = 'R' AND l_quantity > 45").select(F.col("l_suppkey").alias("contig_id"))
    return M.filter_taxa_by_segments(view(spark, d, "orders").select(F.col("o_orderkey").alias("query"), F.col("o_orderstatus").alias("taxon")), seg, F.col("taxon") == "F")


GROUPS = "c AS (SELECT taxid, 100.0 * count(*) / sum(count(*)) OVER () AS percent FROM v_read_taxon WHERE tool = 'gene' GROUP BY taxid)"


@query(f"""WITH {GROUPS} SELECT c.taxid, round(percent, 6) AS percent, CAST(n.parent AS INT) AS "group", g.rank, coalesce(n.parent IN (SELECT 10 + r_regionkey FROM region WHERE r_name < 'B'), false) AS "exists" FROM c LEFT JOIN v_nodes n USING (taxid) LEFT JOIN v_nodes g ON g.taxid = n.parent WHERE percent >= 2""")
def select_reference_groups(spark, d):
    nodes = view(spark, d, "v_nodes").select("taxid", F.col("parent").alias("group"))
    have = view(spark, d, "region").filter("r_name < 'B'").select((10 + F.col("r_regionkey")).alias("group"))
    got = M.select_reference_groups(view(spark, d, "v_read_taxon").filter("tool = 'gene'"), nodes, have, 2.0, view(spark, d, "v_nodes"))
    return got.select("taxid", F.round("percent", 6).alias("percent"), F.col("group").cast("int").alias("group"), "rank", "exists")


@query("SELECT read_id, gene_id, score, mate FROM (SELECT *, CASE context WHEN 'F' THEN 1 ELSE 2 END AS mate FROM v_gene_reads) QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY score DESC, mate, gene_id) = 1")
def reconcile_pair_maps(spark, d):
    g = view(spark, d, "v_gene_reads").select("read_id", "gene_id", "score", "context")
    return M.reconcile_pair_maps(g.filter("context = 'F'"), g.filter("context <> 'F'")).select("read_id", "gene_id", "score", "mate")


@query("SELECT DISTINCT gene_id, read_id, max(length) OVER (PARTITION BY gene_id) AS length FROM (SELECT gene_id, read_id, length + CASE tool WHEN 'A' THEN 3 ELSE 0 END AS length FROM v_gene_reads JOIN v_genes USING (gene_id))")
def concat_gene_maps(spark, d):
    g = view(spark, d, "v_gene_reads").join(view(spark, d, "v_genes"), "gene_id")
    a = g.filter("tool = 'A'").withColumn("length", F.col("length") + 3)
    return M.concat_gene_maps([a, g.filter("tool <> 'A'")])


PCT = "(100.0 * CAST(regexp_extract(cigar, '^([0-9]+)M', 1) AS INT) / (CAST(regexp_extract(cigar, '^([0-9]+)M', 1) AS INT) + CAST(regexp_extract(cigar, 'M([0-9]+)S', 1) AS INT)))"


@query(f"SELECT DISTINCT v.query, coalesce(b.target, -1) AS contig_id FROM v_aln v LEFT JOIN (SELECT query, target FROM v_aln WHERE flag = 0 AND {PCT} >= 90 QUALIFY row_number() OVER (PARTITION BY query ORDER BY as_score DESC, file_order, target) = 1) b ON b.query = v.query")
def contig_assign(spark, d):
    reads = view(spark, d, "v_aln").select(F.col("query").alias("read_id"))
    odd = F.col("read_id") % 2 == 1
    got = M.contig_assign(view(spark, d, "v_aln"), X.aln_passes(F.col("flag"), F.col("cigar")), reads.filter(odd), reads.filter(~odd))
    return got.select("query", F.coalesce("contig_id", F.lit(-1)).alias("contig_id"))


CONTIG_N = "n AS (SELECT contig_id, CASE WHEN contig_id % 5 = 0 THEN 0 ELSE count(*) END AS reads FROM v_contig GROUP BY contig_id)"


def _contig_counts(spark, d):
    return view(spark, d, "v_contig").groupBy("contig_id").agg(F.when(F.col("contig_id") % 5 == 0, 0).otherwise(F.count(F.lit(1))).alias("reads"))


@query(f"WITH {CONTIG_N} SELECT gene_id, CAST(sum(coalesce(reads, 1)) AS BIGINT) AS reads FROM v_gene_reads LEFT JOIN n ON contig_id = read_id GROUP BY gene_id HAVING sum(coalesce(reads, 1)) > 0")
def contig_segment_counts(spark, d):
    return M.contig_segment_counts(view(spark, d, "v_gene_reads").select("gene_id", F.col("read_id").alias("member")), _contig_counts(spark, d))


@query("WITH " + KMER + """, t AS (SELECT item_id, CASE WHEN item_id % 3 = 0 THEN 10 + item_id % 5 ELSE 100 + item_id % 25 END AS taxid FROM benchmark),
a AS (SELECT taxid AS t, taxid AS anc, 0 AS up FROM v_nodes UNION SELECT taxid, parent, 1 FROM v_nodes WHERE taxid <> 1 UNION SELECT n.taxid, p.parent, 2 FROM v_nodes n JOIN v_nodes p ON p.taxid = n.parent WHERE n.taxid <> 1 AND p.taxid <> 1),
x AS (SELECT DISTINCT kmer, taxid FROM (SELECT item_id, unnest(ks) AS kmer FROM r) JOIN t USING (item_id) WHERE taxid IN (SELECT taxid FROM v_nodes)),
m AS (SELECT kmer, count(*) AS n FROM x GROUP BY kmer), c AS (SELECT kmer, anc, count(*) AS n, min(up) AS up FROM x JOIN a ON t = x.taxid GROUP BY ALL),
l AS (SELECT kmer, arg_min(anc, c.up) AS taxid FROM c JOIN m USING (kmer) WHERE c.n = m.n GROUP BY kmer),
e AS (SELECT id, unnest(ks) AS kmer FROM k), v AS (SELECT id, taxid, count(*) AS w FROM e JOIN l USING (kmer) GROUP BY ALL),
s AS (SELECT c.id, c.taxid, sum(u.w) AS w FROM v c JOIN a ON t = c.taxid JOIN v u ON u.id = c.id AND u.taxid = anc GROUP BY ALL),
b AS (SELECT id, arg_max(taxid, (w, -taxid)) AS taxid FROM s GROUP BY id) SELECT DISTINCT doc_id AS read_id, coalesce(taxid, 0) AS taxid FROM documents LEFT JOIN b ON id = doc_id""")
def kmer_lca_classify(spark, d):
    i = F.col("item_id")
    taxa = view(spark, d, "benchmark").select(i.alias("id"), F.when(i % 3 == 0, 10 + i % 5).otherwise(100 + i % 25).alias("taxid"))
    return K.kmer_lca_classify(*_texts(spark, d), taxa, view(spark, d, "v_nodes"), 4, " ")


@query("SELECT p_partkey AS id, p_name AS seq FROM part WHERE p_partkey IN (SELECT gene_id FROM v_gene_ec WHERE ec LIKE '2.%')")
def annotated_only(spark, d):
    seqs = view(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("seq"))
    return M.annotated_only(seqs, view(spark, d, "v_gene_ec").withColumnRenamed("gene_id", "accession"), "2.")


@query("SELECT DISTINCT gene_id, ec FROM v_gene_ec")
def explode_ec_rows(spark, d):
    from strandwise.operators.enzyme import ec_report

    return M.explode_ec_rows(ec_report(view(spark, d, "v_gene_ec"))).select("gene_id", "ec")


@query(f"""WITH {CONTIG_N} SELECT o_orderpriority AS lineage, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN coalesce(reads, 0) WHEN o_orderkey IN (SELECT read_id FROM v_contig WHERE contig_id = 1) THEN 0 ELSE 1 END) AS BIGINT) AS reads
FROM orders LEFT JOIN n ON contig_id = o_orderkey GROUP BY 1""")
def taxa_table_weighted(spark, d):
    q = view(spark, d, "orders").select(F.col("o_orderkey").alias("query"), F.col("o_orderpriority").alias("lineage"), "o_orderstatus")
    return M.taxa_table_weighted(q, _contig_counts(spark, d), view(spark, d, "v_contig").filter("contig_id = 1"), F.col("o_orderstatus") == "F")


@query("""SELECT c.taxid, CASE WHEN n.name < 'C' THEN n.name WHEN r.name < 'B' THEN r.name ELSE 'other' END AS category FROM v_nodes c JOIN v_nodes n ON n.taxid = c.parent JOIN v_nodes r ON r.taxid = n.parent WHERE c.rank = 'genus'""")
def category_of_lineage(spark, d):
    v = view(spark, d, "v_nodes")
    names = v.filter("(rank = 'phylum' AND name < 'C') OR (rank = 'superkingdom' AND name < 'B')")
    lines = T.lineages(v, v.select("taxid", "name")).join(v.filter("rank = 'genus'"), "taxid", "left_semi")
    keys = names.select(F.concat(F.when(F.col("rank") == "phylum", "p_").otherwise("k_"), "name").alias("name"), F.col("name").alias("category"))
    return M.category_of_lineage(lines, keys)


ZERO = "z AS (SELECT ec, gene_id, CASE WHEN gene_id % 2 = 0 OR length(ec) > 8 THEN 0 ELSE 1 END AS n FROM v_gene_ec)"


@query(f"WITH {ZERO} SELECT * FROM z WHERE ec IN (SELECT ec FROM z GROUP BY ec HAVING sum(n) <> 0)")
def drop_all_zero_taxa(spark, d):
    z = view(spark, d, "v_gene_ec").select("ec", "gene_id", F.when((F.col("gene_id") % 2 == 0) | (F.length("ec") > 8), 0).otherwise(1).alias("n"))
    return M.drop_all_zero(z, "ec", "n")


@query("SELECT source AS id, arg_max(text, doc_id) AS seq, max(doc_id) AS place FROM documents GROUP BY source")
def dedup_seqs_by_id(spark, d):
    s = view(spark, d, "documents").select(F.col("source").alias("id"), F.col("text").alias("seq"), F.col("doc_id").alias("place"))
    return M.dedup_by_id(s, "place", "last").select("id", "seq", "place")


@query("""WITH RECURSIVE p AS (SELECT taxid, [taxid] AS k FROM v_nodes WHERE taxid = 1 UNION ALL SELECT n.taxid, list_append(k, n.taxid) FROM v_nodes n JOIN p ON n.parent = p.taxid WHERE n.taxid <> 1)
SELECT taxid, CAST(row_number() OVER (ORDER BY k) AS INT) AS place FROM p""")
def sort_taxa_by_lineage(spark, d):
    return T.lineage_order(view(spark, d, "v_nodes"))


@query("""WITH c AS (SELECT CAST(p_partkey AS VARCHAR) AS gene_id, l_linenumber AS taxon, CAST(sum(CASE WHEN l_linenumber < 4 THEN 0 ELSE l_linenumber END) AS BIGINT) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
t AS (SELECT taxon, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY taxon HAVING sum(n) <> 0) SELECT gene_id, taxon, n FROM c WHERE taxon IN (SELECT taxon FROM t) UNION ALL SELECT 'All', taxon, n FROM t""")
def taxa_with_totals(spark, d):
    met = view(spark, d, "lineitem").join(view(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
    n = F.when(F.col("l_linenumber") < 4, 0).otherwise(F.col("l_linenumber"))
    return M.with_totals(met.select(F.col("p_partkey").alias("gene_id"), F.col("l_linenumber").alias("taxon"), n.cast("long").alias("n")), "gene_id", "taxon", "n")
