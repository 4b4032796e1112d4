"""Queries over hits, genes, taxa and enzymes, with the same queries in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.functions import hits as X
from strandwise.operators import enzyme as E
from strandwise.operators import hits as H
from strandwise.operators import maps
from strandwise.operators import taxonomy as T
from strandwise.plans.views import view, with_views

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = with_views(sql)
        return f

    return put


M = "CAST(regexp_extract(cigar, '^([0-9]+)M', 1) AS INT)"
PCT = f"(100.0 * {M} / ({M} + CAST(regexp_extract(cigar, 'M([0-9]+)S', 1) AS INT)))"
PASS = "(identity > 85 AND aln_len > 0.65 * qlen AND bitscore > 60)"
BEST = f"SELECT query, target, as_score AS score, file_order FROM v_aln WHERE flag = 0 AND {PCT} >= 90 QUALIFY row_number() OVER (PARTITION BY query ORDER BY as_score DESC, file_order, target) = 1"


def _aln_best(spark, d):
    v = view(spark, d, "v_aln")
    return H.best_hit(v, X.aln_passes(F.col("flag"), F.col("cigar")), "as_score").select("query", "target", F.col("as_score").alias("score"), "file_order")


def _hit_passes(protein: bool = False):
    return X.hit_passes(F.col("identity"), F.col("aln_len"), F.col("qlen"), F.col("bitscore"), protein)


@query(f"SELECT DISTINCT cigar, flag, round({PCT}, 6) AS match_pct, flag = 4 AS unmapped, flag = 0 AND {PCT} >= 90 AS passes FROM v_aln")
def aln_passes(spark, d):
    cigar, flag = F.col("cigar"), F.col("flag")
    return view(spark, d, "v_aln").select("cigar", "flag", F.round(X.cigar_match_pct(cigar), 6).alias("match_pct"), X.is_unmapped(flag).alias("unmapped"), X.aln_passes(flag, cigar).alias("passes")).distinct()


@query("""WITH c AS (SELECT cigar, list_transform(regexp_extract_all(cigar, '([0-9]+)M', 1), lambda n: CAST(n AS INT)) AS m, list_transform(regexp_extract_all(cigar, '([0-9]+)[MISX=]', 1), lambda n: CAST(n AS INT)) AS q FROM v_aln)
SELECT cigar, round(coalesce(100.0 * list_sum(m) / list_sum(q), 0), 6) AS query_match_pct, coalesce(100.0 * list_sum(m) / list_sum(q), 0) >= 90 AS kept, count(*) AS n FROM c GROUP BY ALL""")
def cigar_query_match(spark, d):
    counted = view(spark, d, "v_aln").groupBy("cigar").agg(F.count(F.lit(1)).alias("n"))
    pct = X.cigar_query_match_pct(F.col("cigar"))
    return counted.select("cigar", F.round(pct, 6).alias("query_match_pct"), (pct >= 90).alias("kept"), "n")


@query(f"SELECT query, count(*) FILTER {'(WHERE ' + PASS + ')'} AS nucleotide, count(*) FILTER (WHERE identity > 85 AND aln_len * 3 > 0.65 * qlen AND bitscore > 60) AS protein FROM v_hits GROUP BY query")
def hit_passes(spark, d):
    return view(spark, d, "v_hits").groupBy("query").agg(F.count_if(_hit_passes()).alias("nucleotide"), F.count_if(_hit_passes(True)).alias("protein"))


@query(f"SELECT query, target, bitscore FROM v_hits WHERE {PASS} QUALIFY row_number() OVER (PARTITION BY query ORDER BY bitscore DESC, file_order, target) = 1")
def best_hit(spark, d):
    return H.best_hit(view(spark, d, "v_hits"), _hit_passes(), "bitscore").select("query", "target", "bitscore")


@query(f"""WITH r AS (SELECT *, {PASS} AS ok, row_number() OVER (PARTITION BY query ORDER BY bitscore DESC, file_order, target) AS rn FROM v_hits),
f AS (SELECT *, coalesce(max(CASE WHEN NOT ok THEN rn END) OVER (PARTITION BY query), 0) AS failed FROM r)
SELECT query, target, bitscore FROM f WHERE rn > failed QUALIFY row_number() OVER (PARTITION BY query ORDER BY rn) = 1""")
def best_hit_strict(spark, d):
    return H.best_hit(view(spark, d, "v_hits"), _hit_passes(), "bitscore", "strict").select("query", "target", "bitscore")


@query(f"SELECT o_orderkey AS query FROM orders WHERE o_orderkey NOT IN (SELECT query FROM v_hits WHERE {PASS})")
def unmapped_queries(spark, d):
    best = H.best_hit(view(spark, d, "v_hits"), _hit_passes(), "bitscore")
    return H.unmapped_queries(view(spark, d, "orders").select(F.col("o_orderkey").alias("query")), best)


@query(f"SELECT query FROM (SELECT DISTINCT query, chunk FROM v_hits WHERE NOT {PASS}) GROUP BY query HAVING count(*) = 2")
def unmapped_in_all_chunks(spark, d):
    return H.unmapped_in_all_chunks(view(spark, d, "v_hits").filter(~_hit_passes()).select("query", "chunk"), 2)


@query(f"SELECT query, min(target) AS target FROM v_hits WHERE {PASS} GROUP BY query HAVING count(DISTINCT target) = 1")
def drop_multi_target(spark, d):
    return H.drop_multi_target(view(spark, d, "v_hits"), _hit_passes())


EXPANDED = f"b AS ({BEST}), x AS (SELECT target AS gene_id, coalesce(c.read_id, b.query) AS read_id, score, file_order, query FROM b LEFT JOIN (SELECT DISTINCT contig_id AS contig_id, read_id FROM v_contig) c ON b.query = c.contig_id)"


def _expanded(spark, d):
    return H.expand_contigs(_aln_best(spark, d), view(spark, d, "v_contig").distinct(), ("file_order", "query"))


@query(f"WITH {EXPANDED} SELECT gene_id, read_id, score FROM x")
def expand_contigs(spark, d):
    return _expanded(spark, d).drop("file_order", "query")


@query(f"WITH {EXPANDED} SELECT gene_id, read_id, score FROM x QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY score DESC, file_order, query, gene_id) = 1")
def claim_read_once(spark, d):
    return H.claim_once(_expanded(spark, d))


@query(f"WITH {EXPANDED} SELECT gene_id, read_id, score FROM (SELECT gene_id, read_id, score // 20000 AS score, file_order, query FROM x) QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY score DESC, file_order, query, gene_id) = 1")
def claim_read_once_of_equal_scores(spark, d):
    coarse = F.floor(F.col("score") / 20000).cast("int")
    return H.claim_once(_expanded(spark, d).withColumn("score", coarse))


TOOL_RANK = "CASE tool WHEN 'bwa' THEN 1 WHEN 'blat' THEN 2 ELSE 3 END, CASE context WHEN 'pair_1' THEN 1 WHEN 'singletons' THEN 3 ELSE 4 END"
MERGED = f"m AS (SELECT gene_id, read_id, score, tool, context FROM v_gene_maps QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY score DESC, {TOOL_RANK}, gene_id) = 1)"


@query(f"WITH {MERGED} SELECT read_id, gene_id, score, tool, context FROM m")
def merge_gene_maps(spark, d):
    return H.merge_gene_maps(view(spark, d, "v_gene_maps"))


@query(f"WITH {MERGED} SELECT gene_id, count(DISTINCT read_id) AS reads FROM m GROUP BY gene_id")
def merged_gene_counts(spark, d):
    return H.gene_counts(H.merge_gene_maps(view(spark, d, "v_gene_maps")))


@query(f"""WITH {EXPANDED}, c AS (SELECT gene_id, read_id FROM x QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY score DESC, file_order, query, gene_id) = 1),
g AS (SELECT gene_id, length, count(DISTINCT read_id) AS reads FROM c JOIN v_genes USING (gene_id) GROUP BY ALL)
SELECT gene_id, length, reads, round(reads / ((length / 1000.0) * (sum(reads) OVER () / 1e6)), 6) AS rpkm FROM g""")
def rpkm_table(spark, d):
    claimed = H.claim_once(_expanded(spark, d))
    return H.rpkm(H.attach_gene_length(claimed, view(spark, d, "v_genes"))).withColumn("rpkm", F.round("rpkm", 6))


PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "not_specified", "5-LOW": "low"}
# Dear orders stand for reads without a taxon.
TAXON = "t AS (SELECT o_orderkey AS read_id, CASE WHEN o_totalprice < 200000 THEN o_orderpriority END AS taxon FROM orders)"


@query(f"""WITH {MERGED}, {TAXON}, g AS (SELECT gene_id, length, count(*) AS reads FROM m JOIN v_genes USING (gene_id) GROUP BY ALL), d AS (SELECT gene_id, length, reads, (length / 1000.0) * (sum(reads) OVER () / 1e6) AS div FROM g)
SELECT gene_id, length, reads, round(reads / div, 6) AS rpkm, {', '.join(f"round(count(*) FILTER (taxon = '{p}') / div, 6) AS {n}" for p, n in PRIORITIES.items())}, round(count(*) FILTER (taxon IS NULL) / div, 6) AS unclassified
FROM m JOIN d USING (gene_id) LEFT JOIN t USING (read_id) GROUP BY gene_id, length, reads, div""")
def gene_by_taxon(spark, d):
    m = H.merge_gene_maps(view(spark, d, "v_gene_maps"))
    t = view(spark, d, "orders").select(F.col("o_orderkey").alias("read_id"), F.when(F.col("o_totalprice") < 200000, F.col("o_orderpriority")).otherwise("none").alias("taxid"))
    rows = H.rpkm_by_taxon(m, view(spark, d, "v_genes"), t)
    wide = rows.groupBy("gene_id", "length", "reads", "rpkm").pivot("taxid", [*PRIORITIES, "none"]).agg(F.sum("taxon_rpkm")).fillna(0.0)
    named = wide.toDF("gene_id", "length", "reads", "rpkm", *PRIORITIES.values(), "unclassified")
    return named.select("gene_id", "length", "reads", *[F.round(c, 6).alias(c) for c in ("rpkm", *PRIORITIES.values(), "unclassified")])


@query("SELECT tool, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM v_read_taxon GROUP BY tool")
def taxon_shares(spark, d):
    return H.shares(view(spark, d, "v_read_taxon"), "tool").withColumn("percent", F.round("percent", 6))


UP = "up AS (SELECT taxid, taxid AS ancestor, 0 AS distance FROM v_nodes UNION ALL SELECT u.taxid, CAST(coalesce(k.taxid, 1) AS INT), distance + 1 FROM up u JOIN v_nodes n ON n.taxid = u.ancestor LEFT JOIN v_nodes k ON k.taxid = n.parent WHERE u.ancestor <> 1)"


@query(f"WITH RECURSIVE {UP} SELECT taxid, ancestor, distance FROM up")
def ancestor_closure(spark, d):
    return T.ancestor_closure(view(spark, d, "v_nodes"))


@query(f"""WITH RECURSIVE {UP}, r AS (SELECT u.taxid, n.rank, n.name FROM up u JOIN v_nodes n ON n.taxid = u.ancestor),
w AS (SELECT taxid, max(name) FILTER (rank = 'superkingdom') AS k, max(name) FILTER (rank = 'phylum') AS p, max(name) FILTER (rank = 'genus') AS g, max(name) FILTER (rank = 'species') AS s FROM r GROUP BY taxid)
SELECT taxid, CASE WHEN k IS NULL THEN 'root' WHEN p IS NULL THEN 'root;k_' || k WHEN g IS NULL THEN 'root;k_' || k || ';p_' || p WHEN s IS NULL THEN 'root;k_' || k || ';p_' || p || ';c_;o_;f_;g_' || g ELSE 'root;k_' || k || ';p_' || p || ';c_;o_;f_;g_' || g || ';s_' || s END AS lineage FROM w""")
def lineage_string(spark, d):
    nodes = view(spark, d, "v_nodes")
    return T.lineages(nodes.select("taxid", "parent", "rank"), nodes.select("taxid", "name"))


@query(f"""WITH RECURSIVE {UP} SELECT u.taxid, arg_min(u.ancestor, u.distance) AS constrained FROM up u JOIN v_nodes n ON n.taxid = u.ancestor WHERE n.rank IN ('superkingdom', 'phylum', 'class', 'order', 'family') OR n.taxid = 1 GROUP BY u.taxid""")
def constrain_to_family(spark, d):
    return T.constrain_to_rank(view(spark, d, "v_nodes"), "family")


@query(f"""WITH RECURSIVE {UP}, d AS (SELECT taxid, max(distance) AS depth FROM up GROUP BY taxid),
t AS (SELECT DISTINCT read_id, taxid FROM v_read_taxon WHERE taxid IN (SELECT taxid FROM v_nodes)), n AS (SELECT read_id, count(*) AS n FROM t GROUP BY read_id),
c AS (SELECT t.read_id, u.ancestor, count(*) AS k FROM t JOIN up u USING (taxid) GROUP BY ALL)
SELECT c.read_id, arg_max(c.ancestor, d.depth) AS lca FROM c JOIN n ON n.read_id = c.read_id AND n.n = c.k JOIN d ON d.taxid = c.ancestor GROUP BY c.read_id""")
def lca(spark, d):
    return T.lca(view(spark, d, "v_read_taxon"), view(spark, d, "v_nodes"))


@query("SELECT read_id, coalesce(max(taxid) FILTER (tool = 'kmer'), 0) AS kmer, coalesce(max(taxid) FILTER (tool = 'gene'), 0) AS gene, coalesce(max(taxid) FILTER (tool = 'marker'), 0) AS marker FROM v_read_taxon GROUP BY read_id")
def combine_classifiers(spark, d):
    return T.combine_classifiers(view(spark, d, "v_read_taxon"), ["kmer", "gene", "marker"])


@query(f"""WITH RECURSIVE {UP}, d AS (SELECT taxid, max(distance) AS depth FROM up GROUP BY taxid),
s AS (SELECT v.read_id, u.ancestor, sum(v.weight) AS w FROM v_read_taxon v JOIN up u USING (taxid) GROUP BY ALL HAVING sum(v.weight) >= 2),
b AS (SELECT s.read_id, s.ancestor FROM s JOIN d ON d.taxid = s.ancestor QUALIFY row_number() OVER (PARTITION BY s.read_id ORDER BY depth DESC, w DESC, s.ancestor) = 1)
SELECT read_id, coalesce(b.ancestor, 0) AS taxid FROM (SELECT DISTINCT read_id FROM v_read_taxon) LEFT JOIN b USING (read_id)""")
def vote_taxon(spark, d):
    return T.vote_taxon(view(spark, d, "v_read_taxon"), view(spark, d, "v_nodes"))


@query(f"""WITH RECURSIVE {UP}, a AS (SELECT u.taxid, arg_min(u.ancestor, u.distance) AS reported FROM up u WHERE u.ancestor IN (SELECT taxid FROM v_nodes WHERE rank = 'phylum' AND taxid % 2 = 0) GROUP BY u.taxid)
SELECT coalesce(a.reported, 0) AS reported, count(*) AS reads FROM v_read_taxon LEFT JOIN a USING (taxid) GROUP BY 1""")
def assign_to_list(spark, d):
    nodes = view(spark, d, "v_nodes")
    out = T.assign_to_list(view(spark, d, "v_read_taxon").select("read_id", "taxid"), nodes, nodes.filter("rank = 'phylum' AND taxid % 2 = 0"))
    return out.groupBy("reported").agg(F.count(F.lit(1)).alias("reads"))


def _level(before: str, level: int) -> str:
    """One level of the roll-up in SQL: taxa at that depth below the cutoff go to their nearest present ancestor."""
    return f"""l{level} AS (SELECT n.taxid, CASE WHEN p.depth = {level} AND t.total < c.least THEN p.above ELSE n.reported END AS reported, n.reads FROM {before} n
JOIN (SELECT reported, sum(reads) AS total FROM {before} GROUP BY reported) t USING (reported) LEFT JOIN tree p ON p.taxid = n.reported CROSS JOIN cut c)"""


SHARE = 0.004
ROLLED = f"""c AS (SELECT CASE WHEN taxid = 0 THEN 1 ELSE taxid END AS taxid, count(*) AS reads FROM v_read_taxid GROUP BY 1), cut AS (SELECT {SHARE} * sum(reads) AS least FROM c WHERE taxid <> 1),
own AS (SELECT * FROM up WHERE taxid IN (SELECT taxid FROM c)), far AS (SELECT taxid, max(distance) AS depth FROM own GROUP BY taxid),
near AS (SELECT taxid, arg_min(ancestor, distance) AS above FROM own WHERE distance > 0 AND (ancestor = 1 OR ancestor IN (SELECT taxid FROM c)) GROUP BY taxid),
tree AS (SELECT c.taxid, CASE WHEN c.taxid = 1 THEN 0 ELSE coalesce(depth, 1) END AS depth, coalesce(above, 1) AS above FROM c LEFT JOIN far USING (taxid) LEFT JOIN near USING (taxid)),
l5 AS (SELECT taxid, taxid AS reported, reads FROM c), {_level('l5', 4)}, {_level('l4', 3)}, {_level('l3', 2)}, {_level('l2', 1)}"""


def _rolled(spark, d):
    counts = view(spark, d, "v_read_taxid").groupBy("taxid").agg(F.count(F.lit(1)).alias("reads"))
    return T.rollup(counts, view(spark, d, "v_nodes").select("taxid", "parent"), SHARE)


@query(f"WITH RECURSIVE {UP}, {ROLLED} SELECT reported AS taxid, CAST(sum(reads) AS BIGINT) AS reads FROM l1 GROUP BY reported")
def taxon_rollup(spark, d):
    return T.rolled_counts(_rolled(spark, d))


@query(f"WITH RECURSIVE {UP}, {ROLLED} SELECT read_id, reported AS taxid FROM v_read_taxid v JOIN l1 ON l1.taxid = CASE WHEN v.taxid = 0 THEN 1 ELSE v.taxid END")
def repointed_reads(spark, d):
    return T.repointed(view(spark, d, "v_read_taxid"), _rolled(spark, d))


BY_TAXON = f"""{ROLLED}, r AS (SELECT read_id, reported FROM v_read_taxid v JOIN l1 ON l1.taxid = CASE WHEN v.taxid = 0 THEN 1 ELSE v.taxid END), {MERGED},
g AS (SELECT gene_id, length, count(*) AS reads FROM m JOIN v_genes USING (gene_id) GROUP BY ALL), d AS (SELECT gene_id, length, reads, (length / 1000.0) * (sum(reads) OVER () / 1e6) AS div FROM g),
x AS (SELECT gene_id, d.length, d.reads, div, r.reported AS taxid, count(*) AS taxon_reads FROM m JOIN d USING (gene_id) JOIN r USING (read_id) GROUP BY ALL)"""


def _by_taxon(spark, d):
    merged = H.merge_gene_maps(view(spark, d, "v_gene_maps"))
    return H.rpkm_by_taxon(merged, view(spark, d, "v_genes"), T.repointed(view(spark, d, "v_read_taxid"), _rolled(spark, d)))


@query(f"WITH RECURSIVE {UP}, {BY_TAXON} SELECT gene_id, length, reads, round(reads / div, 6) AS rpkm, taxid, taxon_reads, round(taxon_reads / div, 6) AS taxon_rpkm FROM x")
def rpkm_by_taxon(spark, d):
    return _by_taxon(spark, d).withColumn("rpkm", F.round("rpkm", 6)).withColumn("taxon_rpkm", F.round("taxon_rpkm", 6))


@query("SELECT taxid, CASE WHEN taxid = 0 THEN 'U' ELSE 'C' END AS flag, count(*) AS reads FROM v_read_taxon GROUP BY ALL")
def taxa_summary(spark, d):
    return view(spark, d, "v_read_taxon").groupBy("taxid", F.when(F.col("taxid") == 0, "U").otherwise("C").alias("flag")).agg(F.count(F.lit(1)).alias("reads"))


@query("SELECT DISTINCT gene_id, ec, tool FROM v_ec_pred WHERE tool = 'A' AND (gene_id, ec) IN (SELECT (gene_id, ec) FROM v_ec_pred WHERE tool = 'R')")
def tool_intersection(spark, d):
    p = view(spark, d, "v_ec_pred")
    return E.tool_intersection(p.filter("tool = 'A'"), p.filter("tool = 'R'")).withColumn("tool", F.lit("A"))


@query("SELECT gene_id, ec FROM v_ec_pred WHERE tool = 'N' UNION (SELECT gene_id, ec FROM v_ec_pred WHERE tool = 'A' INTERSECT SELECT gene_id, ec FROM v_ec_pred WHERE tool = 'R')")
def ec_union(spark, d):
    p = view(spark, d, "v_ec_pred")
    return E.ec_union(p.filter("tool = 'A'"), p.filter("tool = 'R'"), p.filter("tool = 'N'"))


@query("SELECT evalue, CASE WHEN evalue <= 1e-10 THEN 'HQ' WHEN evalue <= 1e-5 THEN 'LQ' ELSE 'none' END AS tier, count(*) AS n FROM v_ec_pred GROUP BY ALL")
def evalue_tier(spark, d):
    return view(spark, d, "v_ec_pred").groupBy("evalue", X.evalue_tier(F.col("evalue")).alias("tier")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT query, count(*) AS n FROM v_hits WHERE CASE WHEN aln_len >= 100 THEN bitscore >= 60 ELSE identity >= 85 AND 300.0 * aln_len / qlen >= 65 END GROUP BY query")
def ec_hit_rule(spark, d):
    return view(spark, d, "v_hits").filter(X.ec_hit_rule(F.col("aln_len"), F.col("identity"), F.col("qlen"), F.col("bitscore"))).groupBy("query").agg(F.count(F.lit(1)).alias("n"))


CONSENSUS = """p AS (SELECT least(a.ec, b.ec) AS lo, greatest(a.ec, b.ec) AS hi FROM (SELECT DISTINCT gene_id, ec FROM v_ec_pred) a JOIN (SELECT DISTINCT gene_id, ec FROM v_ec_pred) b ON a.gene_id = b.gene_id AND a.ec < b.ec GROUP BY ALL HAVING count(*) >= 3),
t AS (SELECT gene_id, ec, tool, row_number() OVER (PARTITION BY gene_id, tool ORDER BY prob DESC, ec) AS rn FROM (SELECT gene_id, ec, tool, max(prob) AS prob FROM v_ec_pred WHERE tool <> 'R' GROUP BY ALL)),
w AS (SELECT gene_id, max(ec) FILTER (tool = 'N' AND rn = 1) AS d1, max(ec) FILTER (tool = 'N' AND rn = 2) AS d2, max(ec) FILTER (tool = 'A' AND rn = 1) AS c1, max(ec) FILTER (tool = 'A' AND rn = 2) AS c2 FROM t GROUP BY gene_id),
c AS (SELECT gene_id, coalesce(d1, c1) AS a, CASE WHEN d2 IS NOT NULL THEN d2 WHEN d1 IS NOT NULL THEN c1 ELSE c2 END AS b, CASE WHEN d1 IS NULL THEN 'common' ELSE 'detect' END AS origin FROM w)
SELECT DISTINCT gene_id, unnest(CASE WHEN p.lo IS NOT NULL THEN [a, b] WHEN origin = 'detect' THEN [a] ELSE [least(a, b)] END) AS ec, origin FROM c LEFT JOIN p ON p.lo = least(a, b) AND p.hi = greatest(a, b) AND a IS NOT NULL AND b IS NOT NULL"""


@query("WITH " + CONSENSUS)
def ec_consensus(spark, d):
    v = view(spark, d, "v_ec_pred")
    best = v.groupBy("gene_id", "ec", "tool").agg(F.max("prob").alias("prob"))
    distinct = v.select("gene_id", "ec").distinct()
    pairs = distinct.alias("x").join(distinct.alias("y"), (F.col("x.gene_id") == F.col("y.gene_id")) & (F.col("x.ec") < F.col("y.ec"))).groupBy(F.col("x.ec").alias("ec_lo"), F.col("y.ec").alias("ec_hi")).agg(F.count(F.lit(1)).alias("n")).filter("n >= 3")
    return E.ec_consensus(best.filter("tool = 'N'"), best.filter("tool = 'A'"), pairs)


@query("SELECT gene_id, count(DISTINCT ec) AS n, string_agg(DISTINCT ec, '|' ORDER BY ec) AS ecs FROM v_gene_ec GROUP BY gene_id")
def ec_report(spark, d):
    return E.ec_report(view(spark, d, "v_gene_ec"))


PROBES = "probe AS (SELECT DISTINCT l_linenumber AS ec, l_quantity * 2 AS score FROM lineitem), point AS (SELECT l_linenumber AS ec, l_extendedprice / 1000 AS score, avg(l_discount + l_tax) AS density FROM lineitem GROUP BY ALL)"


@query(f"WITH {PROBES}, b AS (SELECT ec, score, density, lag(density) OVER w AS lo, lead(density) OVER w AS hi FROM point WINDOW w AS (PARTITION BY ec ORDER BY score))" + """
SELECT p.ec, p.score, CASE WHEN x.ec IS NOT NULL THEN coalesce(round((x.lo + x.hi) / 2, 6), 0.0) WHEN y.density IS NOT NULL AND z.density IS NOT NULL THEN round((y.density + z.density) / 2, 6) ELSE 0.0 END AS density
FROM probe p LEFT JOIN b x ON x.ec = p.ec AND x.score = p.score ASOF LEFT JOIN point y ON y.ec = p.ec AND y.score < p.score ASOF LEFT JOIN point z ON z.ec = p.ec AND z.score > p.score""")
def density_lookup(spark, d):
    line = view(spark, d, "lineitem")
    probes = line.select(F.col("l_linenumber").alias("ec"), (F.col("l_quantity") * 2).alias("score"))
    points = line.select(F.col("l_linenumber").alias("ec"), (F.col("l_extendedprice") / 1000).alias("score"), (F.col("l_discount") + F.col("l_tax")).alias("density"))
    return E.density_lookup(probes, points).withColumn("density", F.round("density", 6))


BAYES = "b AS (SELECT l_orderkey AS query, concat('1.1.1.', CAST(l_linenumber AS STRING)) AS ec, CASE WHEN l_tax = 0 AND l_discount = 0 THEN 1e-10 ELSE 0.3 * l_tax / (0.3 * l_tax + 0.7 * l_discount) END AS p FROM lineitem), c AS (SELECT query, ec, 1 - product(1 - p) AS prob, count(*) AS positive_hits FROM b GROUP BY ALL), n AS (SELECT *, sum(positive_hits) OVER (PARTITION BY query) - positive_hits AS negative_hits FROM c)"


def _cumulative(spark, d):
    p = E.bayes_score(F.lit(0.3), F.col("l_tax"), F.col("l_discount"))
    return E.cumulative_probability(view(spark, d, "lineitem").select(F.col("l_orderkey").alias("query"), F.concat(F.lit("1.1.1."), F.col("l_linenumber").cast("string")).alias("ec"), p.alias("p")))


@query(f"WITH {BAYES} SELECT query, ec, round(prob, 6) + 0.0 AS prob, positive_hits, CAST(negative_hits AS BIGINT) AS negative_hits FROM n WHERE prob > 1e-10")
def cumulative_ec(spark, d):
    return _cumulative(spark, d).withColumn("prob", F.round("prob", 6) + 0.0)


@query(f"WITH {BAYES} SELECT query, ec, positive_hits FROM n WHERE round(prob, 6) > 0.2 QUALIFY row_number() OVER (PARTITION BY query ORDER BY round(prob, 6) DESC, ec) <= 2")
def top_predictions(spark, d):
    return E.top_predictions(_cumulative(spark, d).withColumn("prob", F.round("prob", 6)), 2).select("query", "ec", "positive_hits")


GROUPED = "n AS (SELECT {key}, count(*) AS genes, round(sum(reads / div), 4) AS rpkm FROM d JOIN e USING (gene_id) GROUP BY {key}), k AS (SELECT {key}, taxid, round(sum(taxon_reads / div), 4) AS taxon_rpkm FROM x JOIN e USING (gene_id) GROUP BY ALL) SELECT {key}, genes, rpkm, taxid, taxon_rpkm FROM n LEFT JOIN k USING ({key})"


@query(f"WITH RECURSIVE {UP}, {BY_TAXON}, e AS (SELECT DISTINCT gene_id, ec FROM v_gene_ec), " + GROUPED.format(key="ec"))
def ec_network(spark, d):
    rows = H.rpkm_of_groups(_by_taxon(spark, d), view(spark, d, "v_gene_ec"), "ec")
    return rows.withColumn("rpkm", F.round("rpkm", 4)).withColumn("taxon_rpkm", F.round("taxon_rpkm", 4))


def _heatmap(spark, d):
    e = view(spark, d, "v_path").select("superpathway", "ec").distinct()
    members = view(spark, d, "v_gene_ec").join(e, "ec").select("gene_id", "superpathway")
    rows = H.rpkm_of_groups(_by_taxon(spark, d), members, "superpathway")
    return rows.withColumn("rpkm", F.round("rpkm", 4)).withColumn("taxon_rpkm", F.round("taxon_rpkm", 4))


HEATMAP = f"WITH RECURSIVE {UP}, {BY_TAXON}, e AS (SELECT DISTINCT gene_id, superpathway FROM v_gene_ec JOIN v_path USING (ec)), " + GROUPED.format(key="superpathway")


@query(HEATMAP)
def superpathway_heatmap(spark, d):
    return _heatmap(spark, d)


@query(f"SELECT * FROM ({HEATMAP}) WHERE taxid <> 1")
def superpathway_heatmap_classified(spark, d):
    return _heatmap(spark, d).filter(F.col("taxid") != T.ROOT)


@query("""WITH e AS (SELECT DISTINCT superpathway, ec FROM v_path), m AS (SELECT DISTINCT ec FROM v_gene_ec WHERE gene_id IN (SELECT gene_id FROM v_gene_reads WHERE tool = 'A' AND context = 'F'))
SELECT superpathway, count(m.ec) AS matched, count(*) AS total, round(100.0 * count(m.ec) / count(*), 2) AS coverage FROM e LEFT JOIN m USING (ec) GROUP BY superpathway""")
def superpathway_coverage(spark, d):
    e = view(spark, d, "v_path").select("superpathway", "ec").distinct()
    mapped = view(spark, d, "v_gene_reads").filter("tool = 'A' AND context = 'F'").select("gene_id")
    m = view(spark, d, "v_gene_ec").join(mapped, "gene_id", "left_semi").select("ec", F.lit(1).alias("hit")).distinct()
    return e.join(m, "ec", "left").groupBy("superpathway").agg(F.count("hit").alias("matched"), F.count(F.lit(1)).alias("total"), F.round(100.0 * F.count("hit") / F.count(F.lit(1)), 2).alias("coverage"))


@query("SELECT gene_id, ec FROM v_gene_ec WHERE gene_id IN (SELECT gene_id FROM v_gene_reads WHERE tool = 'A' AND context = 'F')")
def ecs_of_mapped_genes(spark, d):
    genes = view(spark, d, "v_gene_reads").filter("tool = 'A' AND context = 'F'").select("gene_id")
    return view(spark, d, "v_gene_ec").join(genes, "gene_id", "left_semi").select("gene_id", "ec")


@query("SELECT contig_id, gene_id, round(length * 1.0 / sum(length) OVER (PARTITION BY contig_id), 6) AS share FROM (SELECT DISTINCT l_suppkey AS contig_id, gene_id, length FROM lineitem JOIN v_genes ON gene_id = l_partkey)")
def segment_share(spark, d):
    seg = view(spark, d, "lineitem").select(F.col("l_suppkey").alias("contig_id"), F.col("l_partkey").alias("gene_id")).distinct().join(view(spark, d, "v_genes"), "gene_id")
    total = seg.groupBy("contig_id").agg(F.sum("length").alias("total"))
    return seg.join(total, "contig_id").select("contig_id", "gene_id", F.round(F.col("length") / F.col("total"), 6).alias("share"))


@query("""WITH c AS (SELECT DISTINCT gene_id, read_id FROM v_gene_reads), n AS (SELECT o_orderkey AS read_id, n_name AS taxon FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
e AS (SELECT gene_id, string_agg(DISTINCT ec, '|' ORDER BY ec) AS ecs FROM v_gene_ec WHERE ec NOT LIKE '1.%' GROUP BY gene_id)
SELECT gene_id, taxon, length, count(*) AS reads, coalesce(ecs, '0.0.0.0') AS ecs FROM c JOIN n USING (read_id) JOIN v_genes USING (gene_id) LEFT JOIN e USING (gene_id) GROUP BY ALL""")
def gene_taxon_counts(spark, d):
    t = view(spark, d, "orders").join(view(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(view(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    taxa = t.select(F.col("o_orderkey").alias("read_id"), F.col("n_name").alias("taxon"))
    return maps.gene_taxon_counts(view(spark, d, "v_gene_reads"), taxa, view(spark, d, "v_genes"), view(spark, d, "v_gene_ec").filter(~F.col("ec").startswith("1.")))


GENES = "SELECT CASE gene_id % 6 WHEN 0 THEN concat(CAST(gene_id AS STRING), '__t|k__B|p__c|s__d|g') WHEN 1 THEN concat('a|b|c|N', CAST(gene_id AS STRING), '.2|e|f|g|h|i') WHEN 2 THEN concat('x||', CAST(gene_id AS STRING), '||y') WHEN 3 THEN concat('t', CAST(gene_id AS STRING), '.3|a|b|c|d') WHEN 4 THEN concat('x|k__B|', CAST(gene_id AS STRING)) ELSE concat('P', CAST(gene_id AS STRING), '.1') END AS gene FROM v_genes"


@query(f"""WITH g AS (SELECT DISTINCT gene, string_split(gene, '|') AS p FROM ({GENES}))
SELECT gene, CASE WHEN len(p) = 5 AND contains(gene, '|k__') THEN '' WHEN len(p) = 9 THEN split_part(p[4], '.', 1) WHEN contains(gene, '||') THEN split_part(gene, '||', 2) ELSE split_part(gene, '.', 1) END AS accession,
       CASE WHEN len(p) = 5 AND contains(gene, '|k__') THEN CAST(split_part(p[1], '_', 1) AS INT) ELSE 0 END AS taxid FROM g""")
def parse_gene_key(spark, d):
    genes = spark.sql(GENES.replace("v_genes", "{v_genes}"), v_genes=view(spark, d, "v_genes")).distinct()
    return genes.select("gene", X.gene_source(F.col("gene")).alias("s")).select("gene", F.coalesce("s.accession", F.lit("")).alias("accession"), F.coalesce("s.taxid", F.lit(0)).alias("taxid"))


FINE = """SELECT taxid, parent, CASE WHEN taxid BETWEEN 100 AND 199 THEN CASE taxid % 3 WHEN 0 THEN 'family' WHEN 1 THEN 'subfamily' ELSE 'clade' END WHEN taxid BETWEEN 1000 AND 999999 THEN CASE taxid % 3 WHEN 0 THEN 'genus' WHEN 1 THEN 'subgenus' ELSE 'no rank' END
WHEN taxid >= 1000000 AND taxid % 4 = 0 THEN 'subspecies' ELSE rank END AS rank FROM v_nodes"""
RANK_PLACE = "list_position(['unclassified', 'superkingdom', 'phylum', 'subphylum', 'class', 'subclass', 'superorder', 'order', 'suborder', 'superfamily', 'family', 'subfamily', 'genus', 'subgenus', 'species', 'subspecies'], n.rank)"
CONSTRAINED = """WITH RECURSIVE {UP}, f AS ({FINE}), c AS (SELECT u.taxid, arg_min(u.ancestor, u.distance) AS constrained FROM up u JOIN f n ON n.taxid = u.ancestor WHERE {RANK_PLACE} <= {place} OR n.taxid = 1 GROUP BY u.taxid)
SELECT CASE WHEN constrained IS NULL THEN 'U' ELSE 'C' END AS flag, read_id, coalesce(constrained, 0) AS taxid FROM v_read_taxid LEFT JOIN c USING (taxid)"""


def _constrained(spark, d, target: str):
    nodes = spark.sql(FINE.replace("v_nodes", "{v_nodes}"), v_nodes=view(spark, d, "v_nodes"))
    return T.constrain_reads(view(spark, d, "v_read_taxid"), nodes, target)


@query(CONSTRAINED.format(UP=UP, FINE=FINE, RANK_PLACE=RANK_PLACE, place=14))
def constrain_reads_to_subgenus(spark, d):
    return _constrained(spark, d, "subgenus")


@query(CONSTRAINED.format(UP=UP, FINE=FINE, RANK_PLACE=RANK_PLACE, place=15))
def constrain_reads_to_species(spark, d):
    return _constrained(spark, d, "species")
