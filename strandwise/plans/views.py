"""The annotation tables as views on the supplied tables: one SQL text for each, valid in Spark and in other engines.

``{table}`` names a supplied table, ``{v_name}`` another view; ``{g}`` is what makes regexp_replace replace all.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ACGT = "translate(regexp_replace(lower(text), '[^a-z]', ''{g}), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"

VIEWS = {
    "v_reads": f"SELECT concat('d', CAST(doc_id AS STRING)) AS read_id, {ACGT} AS seq, regexp_replace(text, '[^!-~]', ''{{g}}) AS qual, doc_id FROM {{documents}}",
    "v_pair1": "SELECT read_id, seq, qual FROM {v_reads} WHERE doc_id % 3 <> 0",
    "v_pair2": "SELECT read_id, seq, qual FROM {v_reads} WHERE doc_id % 5 <> 0",
    "v_aln": "SELECT l_orderkey AS query, l_partkey AS target, CASE WHEN l_returnflag = 'N' THEN 4 ELSE 0 END AS flag, concat(CAST(CAST(floor(l_quantity) AS INT) AS STRING), 'M', CAST(l_linenumber AS STRING), 'S') AS cigar, CAST(floor(l_extendedprice) AS INT) AS as_score, CAST(l_linenumber AS BIGINT) * 1000000 + l_suppkey AS file_order FROM {lineitem}",
    "v_hits": "SELECT l_orderkey AS query, l_partkey AS target, 100 - 200 * l_discount AS identity, CAST(floor(l_quantity) AS INT) AS aln_len, 40 AS qlen, CAST(floor(l_extendedprice / 500) AS INT) AS bitscore, CAST(l_linenumber AS BIGINT) * 1000000 + l_suppkey AS file_order, l_tax * 0.001 AS evalue, l_linestatus AS chunk FROM {lineitem}",
    "v_contig": "SELECT l_suppkey AS contig_id, l_orderkey AS read_id FROM {lineitem}",
    "v_gene_reads": "SELECT l_partkey AS gene_id, l_orderkey AS read_id, l_extendedprice AS score, l_returnflag AS tool, l_linestatus AS context FROM {lineitem}",
    "v_genes": "SELECT p_partkey AS gene_id, p_size * 100 AS length FROM {part}",
    "v_nodes": "SELECT 1 AS taxid, 1 AS parent, 'root' AS rank, 'root' AS name UNION ALL SELECT 10 + r_regionkey, 1, 'superkingdom', r_name FROM {region} UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, 'phylum', n_name FROM {nation} UNION ALL SELECT DISTINCT 1000 + 26 * c_nationkey + ascii(c_mktsegment) - 65, 100 + c_nationkey, 'genus', concat(c_mktsegment, CAST(c_nationkey AS STRING)) FROM {customer} UNION ALL SELECT CAST(1000000 + c_custkey AS INT), 1000 + 26 * c_nationkey + ascii(c_mktsegment) - 65, 'species', c_name FROM {customer}",
    "v_read_taxon": "SELECT o_orderkey AS read_id, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(1000000 + o_custkey AS INT) END AS taxid, 'kmer' AS tool, 1 AS weight FROM {orders} UNION ALL SELECT l_orderkey, CAST(100 + s_nationkey AS INT), 'gene', 3 FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey WHERE l_linenumber = 1 UNION ALL SELECT o_orderkey, CAST(1000000 + (o_custkey + o_orderkey % 3) AS INT), 'marker', 1 FROM {orders} WHERE o_orderpriority = '5-LOW'",
    "v_read_taxid": "SELECT o_orderkey AS read_id, CASE WHEN o_orderstatus = 'P' THEN 0 WHEN o_orderpriority = '1-URGENT' THEN CAST(1000000 + o_custkey AS INT) WHEN o_orderpriority = '2-HIGH' THEN CAST(1000 + 26 * c_nationkey + ascii(c_mktsegment) - 65 AS INT) WHEN o_orderpriority = '3-MEDIUM' THEN CAST(100 + c_nationkey AS INT) WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(10 + n_regionkey AS INT) ELSE 5000000 END AS taxid FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey",
    "v_gene_maps": "SELECT l_partkey AS gene_id, l_orderkey AS read_id, CAST(floor(l_quantity / 10) AS INT) AS score, CASE l_returnflag WHEN 'A' THEN 'bwa' WHEN 'N' THEN 'blat' ELSE 'dmd' END AS tool, CASE WHEN l_linestatus = 'F' THEN 'contigs' WHEN l_linenumber < 3 THEN 'singletons' ELSE 'pair_1' END AS context FROM {lineitem}",
    "v_gene_names": "SELECT p_partkey AS gene_id, CASE p_type WHEN 'ECONOMY' THEN concat(CAST(100 + p_size AS STRING), '__x|k__Bacteria|p__y|s__z|g', CAST(p_partkey AS STRING)) WHEN 'PROMO' THEN concat('gi|', CAST(p_partkey AS STRING), '|ref|A', CAST(p_partkey AS STRING), '.2|a|b|c|d|e') WHEN 'LARGE' THEN concat('x||A', CAST(p_partkey AS STRING), '||y') ELSE concat('A', CAST(p_partkey AS STRING), '.1') END AS name FROM {part}",
    "v_acc_taxid": "SELECT concat('A', CAST(p_partkey AS STRING)) AS accession, CAST(200 + p_size AS INT) AS taxid FROM {part} WHERE p_size > 5",
    "v_ec_pred": "SELECT l_partkey AS gene_id, concat('1.', replace(p_brand, 'Brand#', ''), '.', CAST(length(p_type) AS STRING), '.', CAST(l_linenumber AS STRING)) AS ec, round(10 * l_discount, 2) + 0.0 AS prob, l_returnflag AS tool, l_tax * 0.001 AS evalue FROM {lineitem} JOIN {part} ON l_partkey = p_partkey",
    "v_gene_ec": "SELECT p_partkey AS gene_id, concat('1.', replace(p_brand, 'Brand#', ''), '.', CAST(length(p_type) AS STRING), '.', CAST(p_size % 5 AS STRING)) AS ec FROM {part} UNION ALL SELECT p_partkey, concat('2.', CAST(p_size AS STRING), '.', CAST(length(p_type) AS STRING), '.1') FROM {part} WHERE p_size % 3 = 0",
    "v_path": "SELECT DISTINCT p_type AS pathway_id, concat('1.', replace(p_brand, 'Brand#', ''), '.', CAST(length(p_type) AS STRING), '.', CAST(p_size % 5 AS STRING)) AS ec, concat('super', CAST(length(p_type) % 3 AS STRING)) AS superpathway FROM {part} WHERE p_size % 2 = 0",
}
NAME = re.compile(r"\{(\w+)\}")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a supplied table, as a frame."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name].replace("{g}", "")
    return spark.sql(text, **{n: view(spark, sf_dir, n) for n in set(NAME.findall(text))})


def needed(name: str) -> list[str]:
    """The views that a view stands on, itself last."""
    out: list[str] = []
    for n in NAME.findall(VIEWS[name]):
        if n in VIEWS:
            out += [x for x in needed(n) if x not in out]
    return [*out, name]


def with_views(sql: str) -> str:
    """SQL for another engine: the views that it names as common table expressions before it."""
    names: list[str] = []
    for n in re.findall(r"\bv_\w+\b", sql):
        if n in VIEWS:
            names += [x for x in needed(n) if x not in names]
    if not names:
        return sql.strip()
    own = ",\n".join(f"{n} AS ({NAME.sub(lambda m: m[1], VIEWS[n].replace('{g}', ', ' + chr(39) + 'g' + chr(39)))})" for n in names)
    head, _, rest = sql.strip().partition("WITH ")
    if not head:
        recursive = rest.startswith("RECURSIVE ")
        return f"WITH {'RECURSIVE ' if recursive else ''}{own},\n{rest.removeprefix('RECURSIVE ')}"
    return f"WITH {own}\n{sql.strip()}"
