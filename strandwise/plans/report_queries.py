"""Queries over report files, tool outputs and checks, with the same queries in SQL.

The file queries write the format from the supplied tables and read it back, so the reader sees every row of them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.functions import hits as X
from strandwise.functions import reads as R
from strandwise.operators import enzyme as E
from strandwise.operators import maps as M
from strandwise.operators import route as P
from strandwise.operators import taxonomy as T
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


def _lines(spark, df, name: str, *parts):
    """The path of a text file set with the parts of each row joined by tabs."""
    path = scratch(spark, name)
    df.select(F.concat_ws("\t", *[p.cast("string") for p in parts]).alias("value")).write.text(path)
    return path


C = F.col


@query("SELECT concat_ws(chr(9), CAST(query AS VARCHAR), CAST(flag AS VARCHAR), CAST(target AS VARCHAR), '1', '60', cigar, '*', '0', '0', '*', '*', CASE WHEN l_returnflag = 'A' THEN 'NM:i:0' ELSE 'x' END) AS value FROM (SELECT *, CASE WHEN flag = 4 THEN 'N' ELSE 'A' END AS l_returnflag FROM v_aln)")
def trim_sam_files(spark, d):
    v = view(spark, d, "v_aln")
    tag = F.when(C("flag") == 4, "x").otherwise("NM:i:0")
    path = _lines(spark, v, "sam", C("query"), C("flag"), C("target"), F.lit("1\t60"), C("cigar"), F.lit("*\t0\t0\t*\t*"), tag, F.concat(F.lit("AS:i:"), C("as_score")))
    return S.trim_sam(spark, path)


@query("SELECT concat('d', CAST(min(doc_id) OVER (PARTITION BY text) AS VARCHAR)) AS rep_id, concat('d', CAST(doc_id AS VARCHAR)) AS member_id FROM documents")
def clstr_files(spark, d):
    clusters = P.exact_dedup(view(spark, d, "documents").select(C("doc_id").alias("read_id"), "text"), ["text"])
    line = F.concat(F.lit("8nt, >d"), C("member_id").cast("string"), F.lit("..."), F.when(C("member_id") == C("rep_id"), " *").otherwise(" at 100%"))
    path = scratch(spark, "clstr")
    S.write_blocks(clusters.select(F.concat(F.lit(">Cluster "), C("rep_id").cast("string")).alias("header"), line.alias("line")), "header", "line", path)
    return S.read_clstr(spark, path)


@query("SELECT CAST(contig_id AS VARCHAR) AS contig_id, CAST(read_id AS VARCHAR) AS read_id FROM (SELECT DISTINCT contig_id, read_id FROM v_contig)")
def contig_map_files(spark, d):
    path = scratch(spark, "contig-map")
    S.write_contig_map(view(spark, d, "v_contig").distinct(), path)
    return S.read_contig_map(spark, path)



@query("SELECT taxid, name FROM v_nodes UNION ALL SELECT 0, 'unclassified'")
def dmp_name_files(spark, d):
    v = view(spark, d, "v_nodes")
    every = v.select("taxid", "name", F.lit("scientific name").alias("class")).unionByName(v.filter("rank <> 'species'").select("taxid", F.concat(F.lit("old "), "name").alias("name"), F.lit("synonym").alias("class")))
    path = scratch(spark, "names")
    every.select(F.concat_ws("\t|\t", C("taxid").cast("string"), "name", F.lit(""), F.concat("class", F.lit("\t|"))).alias("value")).write.text(path)
    return S.read_dmp_names(spark, path)


PRIAM = "p AS (SELECT gene_id, ec, prob, evalue, tool <> 'N' AS best FROM v_ec_pred)"


def _priam(spark, d):
    """The predictions as PRIAM blocks: one block a gene, rows that are not the best behind a #."""
    p = view(spark, d, "v_ec_pred")
    row = F.concat_ws("\t", F.concat(F.when(C("tool") == "N", "# ").otherwise(""), C("ec")), C("prob").cast("string"), C("evalue").cast("string"))
    path = scratch(spark, "priam")
    S.write_blocks(p.select(F.concat(F.lit(">"), C("gene_id").cast("string"), F.lit(" x")).alias("header"), row.alias("line")), "header", "line", path)
    return path


@query(f"WITH {PRIAM} SELECT CAST(gene_id AS VARCHAR) AS query, ec, prob, round(evalue, 8) AS evalue, best FROM p")
def priam_files(spark, d):
    return S.read_priam_blocks(spark, _priam(spark, d), best_only=False).withColumn("evalue", F.round("evalue", 8))


@query(f"WITH {PRIAM} SELECT ec, CASE WHEN best AND prob >= 0.5 THEN 'HQ' WHEN evalue < 1e-5 THEN 'LQ' ELSE 'none' END AS tier, count(*) AS n FROM p GROUP BY ALL")
def priam_tier(spark, d):
    p = view(spark, d, "v_ec_pred")
    return p.groupBy("ec", X.priam_tier(C("prob"), C("evalue"), C("tool") != "N").alias("tier")).agg(F.count(F.lit(1)).alias("n"))


PAIRS = "q AS (SELECT a.ec AS ec1, b.ec AS ec2, count(*) AS n FROM v_gene_ec a JOIN v_gene_ec b USING (gene_id) WHERE a.ec <> b.ec GROUP BY ALL), s AS (SELECT CASE WHEN ec1 LIKE '1.1%' THEN concat(ec1, 'n') ELSE ec1 END AS ec1, ec2, n FROM q)"


def _pairs(spark, d):
    e = view(spark, d, "v_gene_ec")
    both = e.alias("a").join(e.alias("b"), (C("a.gene_id") == C("b.gene_id")) & (C("a.ec") != C("b.ec"))).groupBy(C("a.ec").alias("ec1"), C("b.ec").alias("ec2")).agg(F.count(F.lit(1)).alias("n"))
    # Serial numbers that are only provisional carry an n.
    return both.withColumn("ec1", F.when(C("ec1").startswith("1.1"), F.concat("ec1", F.lit("n"))).otherwise(C("ec1")))


@query(f"WITH {PAIRS} SELECT least(ec1, ec2) AS ec_lo, greatest(ec1, ec2) AS ec_hi, max(n) AS n FROM s WHERE NOT contains(ec1, 'n') AND NOT contains(ec2, 'n') GROUP BY ALL")
def ec_pair_files(spark, d):
    path = _lines(spark, _pairs(spark, d), "ec-pairs", F.concat_ws("_", "ec1", "ec2"), C("n"))
    return E.ec_pairs(S.read_ec_pairs(spark, path))


@query("SELECT DISTINCT ec, concat('Enzyme ', ec) AS name, concat('A', CAST(gene_id AS VARCHAR)) AS accession FROM v_gene_ec")
def enzyme_dat_files(spark, d):
    lines = F.concat(F.lit("DR   A"), C("gene_id").cast("string"), F.lit(", G_X ;"))
    path = scratch(spark, "enzyme-dat")
    header = F.concat(F.lit("ID   "), "ec", F.lit("\nDE   Enzyme "), "ec", F.lit("."))
    S.write_blocks(view(spark, d, "v_gene_ec").distinct().select(header.alias("header"), lines.alias("line")), "header", "line", path)
    return S.read_enzyme_dat(spark, path)


@query("SELECT pathway_id, ec FROM v_path")
def pathway_files(spark, d):
    path = _lines(spark, view(spark, d, "v_path"), "pathways", F.concat(F.lit("path:"), "pathway_id"), F.concat(F.lit("ec:"), "ec"))
    return S.read_pathway(spark, path)


@query("SELECT DISTINCT superpathway, pathway_id, concat('The \"', pathway_id, '\", all') AS pathway FROM v_path")
def superpathway_files(spark, d):
    path = scratch(spark, "superpathways")
    rows = view(spark, d, "v_path").select("superpathway", C("pathway_id").alias("Pathway ID"), F.concat(F.lit('The "'), "pathway_id", F.lit('", all')).alias("Pathway")).distinct()
    # Quotes are doubled inside quotes, as in the published file.
    rows.write.option("header", True).option("escape", '"').csv(path)
    return S.read_superpathway(spark, path)


@query("SELECT superpathway, count(DISTINCT ec) AS ecs FROM v_path GROUP BY superpathway")
def superpathway_ecs(spark, d):
    return view(spark, d, "v_path").select("superpathway", "ec").distinct().groupBy("superpathway").agg(F.count(F.lit(1)).alias("ecs"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS gene, p_name AS name, CAST(p_size AS VARCHAR) AS size, kind FROM part, (VALUES ('tsv'), ('csv'), ('parquet')) k(kind)")
def table_files(spark, d):
    rows = view(spark, d, "part").select(C("p_partkey").cast("string").alias("gene"), C("p_name").alias("name"), C("p_size").cast("string").alias("size"))
    back = []
    for kind, sep in (("tsv", "\t"), ("csv", ","), ("parquet", None)):
        path = scratch(spark, kind)
        S.write_table(rows, path, kind)
        read = spark.read.parquet(path) if sep is None else spark.read.schema(rows.schema).option("header", True).option("sep", sep).csv(path)
        back.append(read.withColumn("kind", F.lit(kind)))
    return back[0].unionByName(back[1]).unionByName(back[2])


@query("SELECT l_returnflag AS report, concat_ws(chr(9), CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR)) AS value, count(*) AS n FROM lineitem GROUP BY ALL")
def concat_report_files(spark, d):
    line = view(spark, d, "lineitem")
    paths = {flag: _lines(spark, line.filter(C("l_returnflag") == flag), f"report-{flag}", C("l_orderkey"), C("l_partkey")) for flag in ("A", "N", "R")}
    one = S.concat_reports(spark, list(paths.values()))
    return one.groupBy(F.regexp_extract("path", "/report-([ANR])-", 1).alias("report"), "value").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, concat('>NODE_', CAST(doc_id AS VARCHAR), '_NODE_', source) AS swapped, concat('>NODE_', CAST(doc_id AS VARCHAR), '>NODE_', source) AS back FROM documents")
def swap_header_marker(spark, d):
    head = F.concat(F.lit(">NODE_"), C("doc_id").cast("string"), F.lit(">NODE_"), C("source"))
    swapped = view(spark, d, "documents").select("doc_id", S.swap_header_marker(head).alias("swapped"))
    return swapped.select("doc_id", "swapped", S.swap_header_marker(C("swapped"), back=True).alias("back"))


@query("SELECT l AS value, count(*) AS n FROM (SELECT replace(replace(unnest(string_split(text, chr(10))), ' ', ''), chr(9), '') AS l FROM documents) WHERE l <> '' GROUP BY l")
def strip_fasta_whitespace(spark, d):
    lines = view(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return S.strip_fasta_whitespace(lines).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(l_linenumber AS INT) AS line, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS total FROM lineitem GROUP BY 1")
def stage_tables(spark, d):
    path = scratch(spark, "stage")
    make = lambda: view(spark, d, "lineitem").select("l_linenumber", "l_partkey")
    funnel.stage_table(spark, path, make)
    # The second call finds the finished stage and does not make it again.
    again = funnel.stage_table(spark, path, lambda: make().limit(0))
    return again.groupBy(C("l_linenumber").cast("int").alias("line")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("total"))


@query("SELECT read_id, (row_number() OVER (ORDER BY read_id) - 1) // 100 AS chunk_id FROM v_reads")
def chunked_reads(spark, d):
    return S.chunked(view(spark, d, "v_reads").select("read_id"), ["read_id"], 100).select("read_id", "chunk_id")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS read_id, CAST(o_custkey AS INT) AS assignment FROM orders")
def vote_report_files(spark, d):
    o = view(spark, d, "orders")
    # Reports of five and of eight tools have nine and twelve fields.
    middle = F.when(C("o_orderstatus") == "F", F.lit("3\t2\t2\t1\tx\t0\t0")).otherwise(F.lit("5\t4\t4\t1\tx\t0\t0\t0\t0\t0"))
    return S.read_vote_report(spark, _lines(spark, o, "votes", C("o_orderkey"), middle, C("o_custkey")))


@query("SELECT query, count(*) AS n FROM (SELECT l_orderkey AS query, 10 * l_discount AS prob, l_quantity / 5 AS positive_hits FROM lineitem) WHERE round(prob, 6) >= 0.2 AND positive_hits > 5 GROUP BY query")
def detect_cutoff(spark, d):
    p = view(spark, d, "lineitem").select(C("l_orderkey").alias("query"), F.round(10 * C("l_discount"), 6).alias("prob"), (C("l_quantity") / 5).alias("positive_hits"))
    return p.filter(X.detect_cutoff(C("prob"), C("positive_hits"))).groupBy("query").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT gene_id, ec, len(string_split(ec, '.')) = 4 AS complete FROM (SELECT gene_id, CASE WHEN gene_id IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') THEN regexp_replace(ec, '[.][0-9]+$', '') ELSE ec END AS ec FROM v_gene_ec)")
def complete_ec_only(spark, d):
    promo = view(spark, d, "part").filter("p_type = 'PROMO'").select(C("p_partkey").alias("gene_id"), F.lit(True).alias("short"))
    e = view(spark, d, "v_gene_ec").join(promo, "gene_id", "left")
    cut = e.select("gene_id", F.when(C("short"), F.regexp_replace("ec", r"[.][0-9]+$", "")).otherwise(C("ec")).alias("ec"))
    return cut.select("gene_id", "ec", X.complete_ec(C("ec")).alias("complete"))


@query("SELECT page_id, regexp_replace(url, '[?<>\\\\:*|]', '_', 'g') AS name FROM pages")
def safe_name(spark, d):
    return view(spark, d, "pages").select("page_id", R.safe_name(C("url")).alias("name"))


@query("SELECT query, count(*) AS n FROM (SELECT l_orderkey AS query, CAST(floor(l_quantity * 4) AS INT) AS aln_len, 100 - 200 * l_discount AS identity, 300 AS qlen, CAST(floor(l_extendedprice / 500) AS INT) AS bitscore FROM lineitem) WHERE CASE WHEN aln_len >= 100 THEN bitscore >= 60 ELSE identity >= 85 AND 300.0 * aln_len / qlen >= 65 END GROUP BY query")
def ec_hit_rule_long(spark, d):
    h = view(spark, d, "lineitem").select(C("l_orderkey").alias("query"), F.floor(C("l_quantity") * 4).cast("int").alias("aln_len"), (100 - 200 * C("l_discount")).alias("identity"), F.lit(300).alias("qlen"), F.floor(C("l_extendedprice") / 500).cast("int").alias("bitscore"))
    return h.filter(X.ec_hit_rule(C("aln_len"), C("identity"), C("qlen"), C("bitscore"))).groupBy("query").agg(F.count(F.lit(1)).alias("n"))


RRNA = "SELECT read_id, read_id NOT IN ({hits}) AS accepted FROM v_reads"
TOOLS = {m: f"(SELECT read_id FROM v_pair{m} WHERE seq LIKE '%GATTAC%' UNION ALL SELECT read_id FROM v_pair{m} WHERE qual LIKE '%z%')" for m in (1, 2)}


def _rrna(spark, d, how, single=False):
    def hits(mate):
        v = view(spark, d, mate)
        return [v.filter(C("seq").contains("GATTAC")), v.filter(C("qual").contains("z"))]

    return P.rrna_split(view(spark, d, "v_reads").select("read_id"), hits("v_pair1"), None if single else hits("v_pair2"), how)


@query(RRNA.format(hits=f"SELECT read_id FROM {TOOLS[1]} UNION SELECT read_id FROM {TOOLS[2]}"))
def rrna_split_high(spark, d):
    return _rrna(spark, d, "high")


@query(RRNA.format(hits=f"SELECT read_id FROM {TOOLS[1]} INTERSECT SELECT read_id FROM {TOOLS[2]}"))
def rrna_split_low(spark, d):
    return _rrna(spark, d, "low")


@query(RRNA.format(hits=f"SELECT read_id FROM {TOOLS[1]}"))
def rrna_split_single(spark, d):
    return _rrna(spark, d, "high", True)


@query("SELECT read_id, CAST(sum(a) AS BIGINT) AS n1, CAST(sum(b) AS BIGINT) AS n2 FROM (SELECT read_id, 1 AS a, 0 AS b FROM v_pair1 UNION ALL SELECT read_id, 0, 1 FROM v_pair2) GROUP BY read_id HAVING sum(a) <> sum(b)")
def unbalanced_ids(spark, d):
    return P.unbalanced_ids(view(spark, d, "v_pair1"), view(spark, d, "v_pair2"))


@query("SELECT 'all' AS reads, (SELECT count(*) FROM v_pair1) AS n1, (SELECT count(*) FROM v_pair2) AS n2 UNION ALL SELECT 'synced', (SELECT count(*) FROM v_pair1 WHERE read_id IN (SELECT read_id FROM v_pair2)), (SELECT count(*) FROM v_pair2 WHERE read_id IN (SELECT read_id FROM v_pair1))")
def pair_balance(spark, d):
    a, b = view(spark, d, "v_pair1"), view(spark, d, "v_pair2")
    synced = (a.join(b.select("read_id"), "read_id", "left_semi"), b.join(a.select("read_id"), "read_id", "left_semi"))
    P.assert_pairs_balanced({"synced": synced})
    return P.pair_balance({"all": (a, b), "synced": synced}).select("reads", "n1", "n2")


@query("SELECT read_id, seq, row_number() OVER (ORDER BY read_id) AS place FROM v_pair1")
def sort_reads(spark, d):
    return P.sort_reads(view(spark, d, "v_pair1").select("read_id", "seq")).withColumn("place", C("place") + 1)


@query("""WITH l AS (SELECT read_id, 1 AS m FROM v_pair1 WHERE seq NOT LIKE '%GATTAC%' UNION ALL SELECT read_id, 2 FROM v_pair2 WHERE qual NOT LIKE '%z%' UNION ALL SELECT read_id, 0 FROM v_reads WHERE doc_id % 15 = 0 UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 3 FROM supplier WHERE s_acctbal > 0)
SELECT read_id, CASE WHEN max(m) = 3 THEN 'contigs' WHEN count(DISTINCT m) FILTER (m > 0) = 2 THEN 'pair' ELSE 'singletons' END AS part FROM l GROUP BY read_id""")
def leftover_reads_all(spark, d):
    a, b, reads = view(spark, d, "v_pair1"), view(spark, d, "v_pair2"), view(spark, d, "v_reads")
    contigs = view(spark, d, "supplier").select(C("s_suppkey").cast("string").alias("read_id"), "s_acctbal")
    known = a.filter(C("seq").contains("GATTAC")).select("read_id", F.lit(1).alias("m")).unionByName(b.filter(C("qual").contains("z")).select("read_id", F.lit(2).alias("m"))).unionByName(contigs.filter("s_acctbal <= 0").select("read_id", F.lit(3).alias("m")))
    # Reads that neither mate file holds are the singletons.
    return P.leftover_reads(a, b, known, reads.filter("doc_id % 15 = 0"), contigs)


PCT = "(100.0 * CAST(regexp_extract(cigar, '^([0-9]+)M', 1) AS INT) / (CAST(regexp_extract(cigar, '^([0-9]+)M', 1) AS INT) + CAST(regexp_extract(cigar, 'M([0-9]+)S', 1) AS INT)))"


@query(f"WITH p AS (SELECT DISTINCT target AS contig_id, query AS read_id FROM v_aln WHERE flag = 0 AND {PCT} >= 90), n AS (SELECT read_id, count(*) AS k FROM p GROUP BY read_id) SELECT contig_id, round(sum(1.0 / k), 6) AS reads FROM p JOIN n USING (read_id) GROUP BY contig_id")
def fractional_counts_of_alignments(spark, d):
    pairs = P.aligned_contig_reads(view(spark, d, "v_aln"), X.aln_passes(C("flag"), C("cigar")))
    return P.fractional_counts(pairs).select("contig_id", F.round("reads", 6).alias("reads"))


@query("""WITH s AS (SELECT DISTINCT l_suppkey AS contig_id, gene_id, length FROM lineitem JOIN v_genes ON gene_id = l_partkey), t AS (SELECT *, length / sum(length) OVER (PARTITION BY contig_id) AS share FROM s),
n AS (SELECT contig_id, count(*) AS reads FROM v_contig GROUP BY contig_id) SELECT contig_id, gene_id, round(share, 6) AS share, CAST(round_even(reads * share, 0) AS BIGINT) AS reads FROM t JOIN n USING (contig_id)""")
def segment_reads(spark, d):
    seg = view(spark, d, "lineitem").select(C("l_suppkey").alias("contig_id"), C("l_partkey").alias("gene_id")).distinct().join(view(spark, d, "v_genes"), "gene_id")
    counts = view(spark, d, "v_contig").groupBy("contig_id").agg(F.count(F.lit(1)).alias("reads"))
    return M.segment_reads(seg, counts).withColumn("share", F.round("share", 6))


@query("SELECT gene_id, read_id, max(length) OVER (PARTITION BY gene_id) AS length FROM (SELECT gene_id, read_id, length + CASE tool WHEN 'A' THEN 3 ELSE 0 END AS length FROM v_gene_reads JOIN v_genes USING (gene_id))")
def append_gene_maps(spark, d):
    g = view(spark, d, "v_gene_reads").join(view(spark, d, "v_genes"), "gene_id")
    a = g.filter("tool = 'A'").withColumn("length", C("length") + 3)
    return M.concat_gene_maps([a, g.filter("tool <> 'A'")], distinct=False)


SPREAD = """q AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 + o_orderkey % 200 ELSE o_orderkey END AS query, o_orderstatus = 'F' AS c, CAST(100 + o_custkey % 25 AS INT) AS taxid, o_orderkey AS place FROM orders),
s AS (SELECT concat(CASE WHEN c THEN 'c' ELSE 'r' END, CAST(query AS VARCHAR)) AS query, taxid, place FROM q), m AS (SELECT DISTINCT concat('c', CAST(l_suppkey AS VARCHAR)) AS contig_id, concat('r', CAST(l_orderkey AS VARCHAR)) AS read_id FROM lineitem),
x AS (SELECT coalesce(m.read_id, s.query) AS read_id, taxid, place, m.read_id IS NULL AS own FROM s LEFT JOIN m ON m.contig_id = s.query)"""


def _spread(spark, d, own_wins):
    contig = C("o_orderstatus") == "F"
    key = F.when(contig, F.concat(F.lit("c"), (1 + C("o_orderkey") % 200).cast("string"))).otherwise(F.concat(F.lit("r"), C("o_orderkey").cast("string")))
    rows = view(spark, d, "orders").select(key.alias("query"), (100 + C("o_custkey") % 25).cast("int").alias("taxid"), C("o_orderkey").alias("place"))
    member = view(spark, d, "lineitem").select(F.concat(F.lit("c"), C("l_suppkey").cast("string")).alias("contig_id"), F.concat(F.lit("r"), C("l_orderkey").cast("string")).alias("read_id"))
    return T.spread_contigs(rows, member, own_wins)


@query(f"WITH {SPREAD} SELECT read_id, taxid FROM x QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY own DESC, CASE WHEN own THEN -place ELSE place END, taxid) = 1")
def spread_contig_taxa(spark, d):
    return _spread(spark, d, True)


@query(f"WITH {SPREAD} SELECT read_id, taxid FROM x QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY place DESC, taxid) = 1")
def spread_contig_taxa_last(spark, d):
    return _spread(spark, d, False)


UP = "up AS (SELECT taxid, taxid AS ancestor, 0 AS distance FROM v_nodes UNION ALL SELECT u.taxid, CAST(coalesce(k.taxid, 1) AS INT), distance + 1 FROM up u JOIN v_nodes n ON n.taxid = u.ancestor LEFT JOIN v_nodes k ON k.taxid = n.parent WHERE u.ancestor <> 1)"
LINEAGE = f"""{UP}, r AS (SELECT u.taxid, n.rank, n.name FROM up u JOIN v_nodes n ON n.taxid = u.ancestor),
w AS (SELECT taxid, max(name) FILTER (rank = 'superkingdom') AS k, max(name) FILTER (rank = 'phylum') AS p, max(name) FILTER (rank = 'genus') AS g, max(name) FILTER (rank = 'species') AS s FROM r GROUP BY taxid),
line AS (SELECT taxid, CASE WHEN k IS NULL THEN 'root' WHEN p IS NULL THEN 'root;k_' || k WHEN g IS NULL THEN 'root;k_' || k || ';p_' || p WHEN s IS NULL THEN 'root;k_' || k || ';p_' || p || ';c_;o_;f_;g_' || g ELSE 'root;k_' || k || ';p_' || p || ';c_;o_;f_;g_' || g || ';s_' || s END AS lineage FROM w),
cl AS (SELECT CASE WHEN lineage IS NULL THEN 'U' ELSE 'C' END AS flag, read_id, coalesce(lineage, 'unclassified') AS lineage FROM v_read_taxid LEFT JOIN line USING (taxid))"""


def _classified(spark, d):
    nodes = view(spark, d, "v_nodes")
    return T.classified_reads(view(spark, d, "v_read_taxid"), nodes, nodes.select("taxid", "name"))


@query(f"WITH RECURSIVE {LINEAGE} SELECT flag, read_id, lineage FROM cl")
def classified_reads(spark, d):
    return _classified(spark, d)


@query(f"WITH RECURSIVE {LINEAGE} SELECT lineage, count(*) AS reads FROM cl GROUP BY lineage")
def taxa_summary_by_lineage(spark, d):
    return T.taxa_summary(_classified(spark, d))


CUTOFFS = "k AS (SELECT concat('1.1.1.', CAST(n AS VARCHAR)) AS ec, b AS beta, n * b / 20.0 AS cutoff FROM (SELECT DISTINCT l_linenumber AS n FROM lineitem WHERE l_linenumber < 7), (VALUES (0.5), (1.0)) v(b))"
BAYES = "b AS (SELECT l_orderkey AS query, concat('1.1.1.', CAST(l_linenumber AS STRING)) AS ec, CASE WHEN l_tax = 0 AND l_discount = 0 THEN 1e-10 ELSE 0.3 * l_tax / (0.3 * l_tax + 0.7 * l_discount) END AS p FROM lineitem), c AS (SELECT query, ec, round(1 - product(1 - p), 6) AS prob FROM b GROUP BY ALL)"


@query(f"WITH {CUTOFFS}, {BAYES} SELECT query, ec FROM c JOIN k USING (ec) WHERE beta = 1 AND prob > cutoff AND prob > 1e-10")
def fbeta_predictions(spark, d):
    line = view(spark, d, "lineitem")
    p = E.bayes_score(F.lit(0.3), C("l_tax"), C("l_discount"))
    preds = E.cumulative_probability(line.select(C("l_orderkey").alias("query"), F.concat(F.lit("1.1.1."), C("l_linenumber").cast("string")).alias("ec"), p.alias("p"))).withColumn("prob", F.round("prob", 6))
    own = line.filter("l_linenumber < 7").select("l_linenumber").distinct().select(F.concat(F.lit("1.1.1."), C("l_linenumber").cast("string")).alias("ec"), C("l_linenumber").alias("n"), F.explode(F.array(F.lit(0.5), F.lit(1.0))).alias("beta"))
    return E.fbeta_predictions(preds, own.select("ec", "beta", (C("n") * C("beta") / 20).alias("cutoff")), 1.0).select("query", "ec")


@query("""WITH m AS (SELECT max(l_shipdate) AS newest FROM lineitem WHERE l_linestatus = 'O'),
r AS (SELECT CASE WHEN l_linestatus = 'F' AND l_shipdate < newest - INTERVAL 1500 DAY THEN 'late' ELSE l_returnflag END AS stage, l_orderkey, l_partkey FROM lineitem, m)
SELECT stage, count(DISTINCT l_orderkey) AS reads, count(DISTINCT l_partkey) AS genes FROM r GROUP BY stage""")
def landed_funnel(spark, d):
    path, out, checkpoint = (scratch(spark, f"landed-{x}") for x in ("files", "counts", "checkpoint"))
    rows = view(spark, d, "lineitem").select(C("l_returnflag").alias("stage"), C("l_orderkey").alias("read_id"), C("l_partkey").alias("gene_id"), C("l_shipdate").cast("timestamp").alias("ts"), "l_linestatus")
    for status in ("O", "F"):  # two landings: the second call reads the second one's files only
        rows.filter(C("l_linestatus") == status).drop("l_linestatus").write.mode("append").parquet(path)
        found = funnel.landed_funnel(spark, path, out, checkpoint, "INTERVAL 1500 DAY")
    return found
