"""Queries over reads and mates, with the same queries in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.functions import reads as R
from strandwise.operators import hits as H
from strandwise.operators import kmers as K
from strandwise.operators import maps as M
from strandwise.operators import mates
from strandwise.operators import route as P
from strandwise.plans.views import view, with_views

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = with_views(sql)
        return f

    return put


@query("SELECT read_id, replace(split_part(concat('a.', read_id, ' x'), ' ', 1), '.', '_') AS id, CASE WHEN doc_id % 2 = 0 THEN split_part(concat(read_id, '/1'), '/', 1) ELSE concat(read_id, '/3') END AS untagged FROM v_reads")
def read_ids(spark, d):
    v = view(spark, d, "v_reads")
    tagged = F.concat("read_id", F.when(F.col("doc_id") % 2 == 0, "/1").otherwise("/3"))
    return v.select("read_id", R.normalise_read_id(F.concat(F.lit("a."), "read_id", F.lit(" x"))).alias("id"), R.strip_mate_tag(tagged).alias("untagged"))


@query("SELECT CASE WHEN min(ord) >= 64 THEN 64 ELSE 33 END AS base FROM (SELECT ascii(unnest(string_split(qual, ''))) AS ord FROM v_reads WHERE qual <> '')")
def quality_base(spark, d):
    return view(spark, d, "v_reads").agg(R.quality_base(F.col("qual")).alias("base"))


@query("SELECT read_id, round(ee, 6) AS ee, ee <= 2.0 AS kept FROM (SELECT read_id, coalesce(list_sum(list_transform(list_filter(string_split(qual, ''), lambda c: c <> ''), lambda c: pow(10.0, (33 - ascii(c)) / 10.0))), 0.0) AS ee FROM v_reads)")
def expected_error_filter(spark, d):
    ee = R.expected_error(F.col("qual"))
    return view(spark, d, "v_reads").select("read_id", F.round(ee, 6).alias("ee"), (ee <= 2.0).alias("kept"))


@query("SELECT read_id, length(t) AS length, t AS qual FROM (SELECT read_id, trim(qual, '!\"#') AS t FROM v_reads) WHERE length(t) >= 30")
def quality_trim(spark, d):
    t = view(spark, d, "v_reads").select("read_id", R.trimmed(F.col("seq"), F.col("qual"), F.col("qual")).alias("qual"))
    return t.filter(F.length("qual") >= 30).select("read_id", F.length("qual").alias("length"), "qual")


@query("""SELECT read_id, CASE WHEN instr(seq, 'GATC') > 0 THEN instr(seq, 'GATC') - 1 WHEN ends_with(seq, 'GAT') THEN length(seq) - 3 ELSE length(seq) END AS cut FROM v_reads""")
def trim_adapter(spark, d):
    return view(spark, d, "v_reads").select("read_id", R.adapter_start(F.col("seq"), "GATC").alias("cut"))


@query("""WITH c AS (SELECT read_id, seq, regexp_extract_all(seq, '...') AS codons FROM v_reads)
SELECT read_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS reverse_complement, replace(coalesce(array_to_string([
  substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', 16 * (instr('TCAG', x[1]) - 1) + 4 * (instr('TCAG', x[2]) - 1) + instr('TCAG', x[3]), 1) FOR x IN codons], ''), ''), '*', '') AS protein FROM c""")
def codons(spark, d):
    return view(spark, d, "v_reads").select("read_id", R.reverse_complement(F.col("seq")).alias("reverse_complement"), R.translate_codons(F.col("seq")).alias("protein"))


@query("""SELECT read_id, CASE WHEN a.n > 0 AND b.n > 0 THEN 'pair' ELSE 'singletons' END AS part, count(*) AS n FROM
(SELECT read_id FROM v_pair1 UNION ALL SELECT read_id FROM v_pair2) u LEFT JOIN (SELECT read_id AS r1, 1 AS n FROM v_pair1) a ON r1 = read_id LEFT JOIN (SELECT read_id AS r2, 1 AS n FROM v_pair2) b ON r2 = read_id GROUP BY ALL""")
def pair_sync(spark, d):
    out = P.pair_sync(view(spark, d, "v_pair1"), view(spark, d, "v_pair2"))
    return out.groupBy("read_id", F.when(F.col("part") == "singletons", "singletons").otherwise("pair").alias("part")).agg(F.count(F.lit(1)).alias("n"))


ROUTE = "SELECT o.o_orderkey AS read_id, coalesce({bad}, false) AS rejected FROM orders o LEFT JOIN (SELECT query, bool_or(flag = 0) AS hit, bool_or(flag = 4) AS miss FROM v_aln GROUP BY query) s ON s.query = o.o_orderkey"


@query(ROUTE.format(bad="hit"))
def route_by_hits_high(spark, d):
    return P.route_by_hits(view(spark, d, "orders").select(F.col("o_orderkey").alias("read_id")), view(spark, d, "v_aln"), "high")


@query(ROUTE.format(bad="NOT miss"))
def route_by_hits_low(spark, d):
    return P.route_by_hits(view(spark, d, "orders").select(F.col("o_orderkey").alias("read_id")), view(spark, d, "v_aln"), "low")


SCREEN = "SELECT read_id, read_id NOT IN (SELECT read_id FROM v_pair1 WHERE length(seq) > 100 {op} SELECT read_id FROM v_pair2 WHERE qual LIKE '%.%') AS accepted FROM v_reads"


def _screen(spark, d, how):
    a = view(spark, d, "v_pair1").filter(F.length("seq") > 100)
    return P.screen_filter(view(spark, d, "v_reads").select("read_id"), a, view(spark, d, "v_pair2").filter(F.col("qual").contains(".")), how)


@query(SCREEN.format(op="UNION"))
def screen_filter_high(spark, d):
    return _screen(spark, d, "high")


@query(SCREEN.format(op="INTERSECT"))
def screen_filter_low(spark, d):
    return _screen(spark, d, "low")


@query("SELECT min(doc_id) OVER (PARTITION BY text) AS rep_id, doc_id AS member_id FROM documents")
def exact_clusters(spark, d):
    return P.exact_dedup(view(spark, d, "documents").select(F.col("doc_id").alias("read_id"), "text"), ["text"])


@query("""SELECT min(a.doc_id) OVER (PARTITION BY a.text, b.text) AS rep_id, a.doc_id AS member_id FROM documents a JOIN (SELECT doc_id, left(text, 40) AS text FROM documents) b USING (doc_id)""")
def exact_pair_clusters(spark, d):
    docs = view(spark, d, "documents").select(F.col("doc_id").alias("read_id"), F.col("text").alias("seq1"))
    mate2 = view(spark, d, "documents").select(F.col("doc_id").alias("read_id"), F.left("text", F.lit(40)).alias("seq2"))
    return P.exact_dedup(docs.join(mate2, "read_id"), ["seq1", "seq2"])


@query("SELECT doc_id AS read_id, source FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING min(doc_id) % 7 <> 0)")
def repopulate(spark, d):
    docs = view(spark, d, "documents").select(F.col("doc_id").alias("read_id"), "text", "source")
    clusters = P.exact_dedup(docs, ["text"])
    survivors = clusters.select(F.col("rep_id").alias("read_id")).distinct().filter(F.col("read_id") % 7 != 0)
    return P.repopulate(survivors, clusters, docs).select("read_id", "source")


@query("SELECT read_id FROM v_pair1 WHERE read_id NOT IN (SELECT read_id FROM v_pair2)")
def removed_by_stage(spark, d):
    return P.removed_by_stage(view(spark, d, "v_pair1"), view(spark, d, "v_pair2")).select("read_id")


@query("""SELECT read_id, length(qual) >= 150 AND read_id IN (SELECT read_id FROM v_pair1) AND read_id IN (SELECT read_id FROM v_pair2) AS kept, count(*) AS n
FROM (SELECT * FROM v_pair1 UNION ALL SELECT * FROM v_pair2) GROUP BY ALL""")
def conditional_pair_keep(spark, d):
    a, b = view(spark, d, "v_pair1"), view(spark, d, "v_pair2")
    out = P.conditional_pair_keep(a, b, a.filter(F.length("qual") >= 150), b.filter(F.length("qual") >= 150))
    return out.groupBy("read_id", "kept").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT query, bool_or(flag = 0) AS mapped FROM v_aln GROUP BY query")
def mapped_unmapped(spark, d):
    return P.mapped_split(view(spark, d, "v_aln"))


@query("""WITH l AS (SELECT read_id, 1 AS m FROM v_pair1 WHERE length(seq) < 120 OR read_id LIKE '%7' UNION ALL SELECT read_id, 2 FROM v_pair2 WHERE read_id NOT LIKE '%1')
SELECT read_id, CASE WHEN count(DISTINCT m) = 2 THEN 'pair' ELSE 'singletons' END AS part FROM l GROUP BY read_id""")
def leftover_reads(spark, d):
    a, b = view(spark, d, "v_pair1"), view(spark, d, "v_pair2")
    known = a.filter(~((F.length("seq") < 120) | F.col("read_id").endswith("7"))).select("read_id", F.lit(1).alias("m")).unionByName(b.filter(F.col("read_id").endswith("1")).select("read_id", F.lit(2).alias("m")))
    return P.leftover_reads(a, b, known)


WORDS = "list_distinct([array_to_string(s[i : i + 3], ' ') FOR i IN range(1, len(s) - 2)]) AS ks FROM (SELECT {id}, list_filter(string_split(text, ' '), lambda c: c <> '') AS s FROM {t})"
KMER = "k AS (SELECT doc_id AS id, " + WORDS.format(id="doc_id", t="documents") + "), r AS (SELECT item_id, " + WORDS.format(id="item_id", t="benchmark") + ")"


def _texts(spark, d):
    return view(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("seq")), view(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("seq"))


@query("WITH " + KMER + ", q AS (SELECT DISTINCT unnest(ks) AS kmer FROM r), e AS (SELECT id, unnest(ks) AS kmer FROM k) SELECT id, count(*) AS hits FROM e JOIN q USING (kmer) GROUP BY id HAVING count(*) >= 4")
def kmer_screen(spark, d):
    return K.kmer_screen(*_texts(spark, d), 4, 4, " ").select("id", "hits")


@query("WITH " + KMER + ", q AS (SELECT DISTINCT unnest(ks) AS kmer FROM r), e AS (SELECT id, len(ks) AS n, unnest(ks) AS kmer FROM k) SELECT id, count(*) AS hits, round(count(*) / n, 9) AS frac FROM e JOIN q USING (kmer) GROUP BY id, n HAVING count(*) / n >= 0.1")
def kmer_screen_by_fraction(spark, d):
    return K.kmer_screen(*_texts(spark, d), 4, 1, " ", 0.1).withColumn("frac", F.round("frac", 9))


@query("WITH " + KMER + ", q AS (SELECT item_id AS target, unnest(ks) AS kmer FROM r), e AS (SELECT id AS query, unnest(ks) AS kmer FROM k) SELECT query, target, count(*) AS shared FROM e JOIN q USING (kmer) GROUP BY ALL")
def kmer_shared_counts(spark, d):
    return K.kmer_counts(*_texts(spark, d), 4, " ")


PLACES = "{n}k AS (SELECT {id} AS {n}_id, len(s) AS units, i - 1 AS pos, array_to_string(s[i : i + 3], ' ') AS kmer FROM (SELECT {id}, list_filter(string_split(text, ' '), lambda c: c <> '') AS s FROM {t}), unnest(range(1, len(s) - 2)) AS u(i)), {n} AS (SELECT *, count(*) OVER (PARTITION BY {n}_id, kmer) AS times, row_number() OVER (PARTITION BY {n}_id, kmer ORDER BY pos) AS nth FROM {n}k)"
HITS = "WITH " + PLACES.format(n="q", id="item_id", t="benchmark") + ", " + PLACES.format(n="t", id="doc_id", t="documents") + """, n AS (SELECT q_id, count(DISTINCT kmer) AS n FROM q GROUP BY q_id),
seed AS (SELECT q_id, t_id, q.kmer, q.pos AS q_pos, q.units, t.pos AS t_pos, CAST(floor((t.pos - q.pos) / 16.0) AS INTEGER) AS band FROM q JOIN t USING (kmer) WHERE q.times = 1 OR t.times = 1 OR q.nth = t.nth),
held AS (SELECT q_id, t_id, n, count(DISTINCT kmer) AS shared FROM seed JOIN n USING (q_id) GROUP BY ALL HAVING count(DISTINCT kmer) >= 0.5 * n),
place AS (SELECT q_id, t_id, band, units, q_pos, min(t_pos) AS t_min, max(t_pos) AS t_max, count(*) AS k FROM seed GROUP BY ALL),
cover AS (SELECT *, least(4, coalesce(lead(q_pos) OVER (PARTITION BY q_id, t_id, band ORDER BY q_pos) - q_pos, 4)) AS c FROM place),
chain AS (SELECT q_id, t_id, band, units, sum(k) AS seeds, min(q_pos) AS q_start, max(q_pos) + 4 AS q_end, min(t_min) AS t_start, max(t_max) + 4 AS t_end, sum(c) AS score FROM cover GROUP BY ALL),
hit AS (SELECT q_id AS query, t_id AS target, shared, 100.0 * shared / n AS containment, band, CAST(seeds AS BIGINT) AS seeds, q_start, q_end, t_start, t_end, q_end - q_start AS aln_len, CAST(score AS INTEGER) AS score,
        100.0 * score / (q_end - q_start) AS identity, units AS qlen, 100.0 * (q_end - q_start) / units AS coverage, row_number() OVER (PARTITION BY q_id ORDER BY t_id, band) AS file_order FROM chain JOIN held USING (q_id, t_id))
"""


def _hits(spark, d):
    documents, passages = _texts(spark, d)
    return K.kmer_hits(passages, documents, 4, " ")


@query(HITS + "SELECT * REPLACE (round(containment, 6) AS containment, round(identity, 6) AS identity, round(coverage, 6) AS coverage) FROM hit")
def kmer_hits(spark, d):
    return _hits(spark, d).withColumns({c: F.round(c, 6) for c in ("containment", "identity", "coverage")})


@query(HITS + "SELECT query, target, score, aln_len, qlen, q_start, t_start FROM hit WHERE identity > 85 AND aln_len > 0.65 * qlen AND score > 30 QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, file_order) = 1")
def kmer_best_hit(spark, d):
    long = (F.col("identity") > 85) & (F.col("aln_len") > 0.65 * F.col("qlen")) & (F.col("score") > 30)
    return H.best_hit(_hits(spark, d), long, "score").select("query", "target", "score", "aln_len", "qlen", "q_start", "t_start")


@query("SELECT read_id, CASE WHEN read_id IN (SELECT read_id FROM v_contig) THEN 'yes' ELSE 'no' END AS in_contig FROM (SELECT DISTINCT o_orderkey AS read_id FROM orders)")
def read_in_contig(spark, d):
    return P.contig_flag(view(spark, d, "orders").select(F.col("o_orderkey").alias("read_id")), view(spark, d, "v_contig"))


UNIQUE = "c AS (SELECT DISTINCT l_orderkey // 4 + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS contig_id, l_orderkey AS read_id FROM lineitem), n AS (SELECT *, count(*) OVER (PARTITION BY read_id) AS k FROM c)"


def _contigs(spark, d):
    contig = F.floor(F.col("l_orderkey") / 4) + F.when(F.col("l_linenumber") == 7, 1).otherwise(0)
    return view(spark, d, "lineitem").select(contig.alias("contig_id"), F.col("l_orderkey").alias("read_id"))


@query("WITH " + UNIQUE + " SELECT contig_id FROM n GROUP BY contig_id HAVING max(k) = 1")
def contig_unique(spark, d):
    return P.unique_contigs(_contigs(spark, d))


@query("WITH " + UNIQUE + " SELECT contig_id, round(sum(1.0 / k), 6) AS reads FROM n GROUP BY contig_id")
def fractional_contig_counts(spark, d):
    return P.fractional_counts(_contigs(spark, d)).select("contig_id", F.round("reads", 6).alias("reads"))


@query("SELECT pos, count(*) AS n, round(avg(q), 6) AS mean, round(coalesce(stddev_samp(q), 0), 6) AS sd, median(q) AS median, max(q) AS highest, min(q) AS lowest, quantile_cont(q, 0.25) AS q1, quantile_cont(q, 0.75) AS q3 FROM (SELECT generate_subscripts(string_split(qual, ''), 1) - 1 AS pos, ascii(unnest(string_split(qual, ''))) AS q FROM v_reads WHERE qual <> '') GROUP BY pos")
def per_base_quality(spark, d):
    # One row for each place and code holds all that the measures need.
    per = R.per_base_codes(view(spark, d, "v_reads"))
    q, k = F.col("q"), F.col("k")
    quarters = F.percentile("q", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), k)
    sums = per.groupBy("pos").agg(F.sum("k").alias("n"), F.sum(q * k).alias("s"), F.sum((q * q * k).cast("double")).alias("s2"), quarters.alias("p"), F.max("q").alias("highest"), F.min("q").alias("lowest"))
    variance = (F.col("s2") - F.col("s").cast("double") * F.col("s") / F.col("n")) / (F.col("n") - 1)
    sd = F.when(F.col("n") > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).otherwise(F.lit(0.0))
    return sums.select("pos", "n", F.round(F.col("s") / F.col("n"), 6).alias("mean"), F.round(sd, 6).alias("sd"), F.get("p", 1).alias("median"), "highest", "lowest", F.get("p", 0).alias("q1"), F.get("p", 2).alias("q3"))


@query("SELECT CAST(floor(mean / 10) * 10 AS INT) AS bin, count(*) AS n, CAST(sum(len) AS BIGINT) AS bases FROM (SELECT length(qual) AS len, list_avg(list_transform(string_split(qual, ''), lambda c: ascii(c))) AS mean FROM v_reads WHERE qual <> '') GROUP BY 1")
def read_quality(spark, d):
    r = view(spark, d, "v_reads").filter("qual <> ''").select(F.length("qual").alias("len"), R.mean_code(F.col("qual")).alias("mean"))
    return r.groupBy((F.floor(F.col("mean") / 10) * 10).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("bases"))


@query("""WITH r AS (SELECT n_chars AS len, sum(n_chars) OVER (ORDER BY n_chars DESC, doc_id) AS cum, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rn, sum(n_chars) OVER () AS total FROM documents)
SELECT len AS n50, rn AS l50 FROM r WHERE cum * 2 > total ORDER BY rn LIMIT 1""")
def n50_l50(spark, d):
    return H.n50_l50(view(spark, d, "documents"), "n_chars")


@query("SELECT a AS before, b AS after, b - a AS difference, round(100.0 * (b - a) / a, 2) AS percent FROM (SELECT count(*) AS a, count(*) FILTER (doc_id % 3 <> 0) AS b FROM v_reads)")
def change_metrics(spark, d):
    both = view(spark, d, "v_reads").agg(F.count(F.lit(1)).alias("before")).join(view(spark, d, "v_pair1").agg(F.count(F.lit(1)).alias("after")))
    return both.select("before", "after", (F.col("after") - F.col("before")).alias("difference"), F.round(100.0 * (F.col("after") - F.col("before")) / F.col("before"), 2).alias("percent"))


STAGES = "s AS (SELECT read_id, length(qual) >= 100 AS hq, seq LIKE '%GATTAC%' AS host, seq LIKE '%CCAATT%' AS vector, lang <> 'en' AS rrna, source, n_chars FROM v_reads JOIN documents USING (doc_id))"
PERCENT = "printf('%.2f', 100.0 * {part} / {whole}) AS {part}_percent"


@query(f"""WITH {STAGES}, c AS (SELECT count(*) AS raw, count(*) FILTER (hq) AS hq, count(*) FILTER (hq AND host) AS host, count(*) FILTER (hq AND NOT host AND vector) AS vector, count(*) FILTER (hq AND NOT host AND NOT vector AND rrna) AS rrna, count(*) FILTER (hq AND NOT host AND NOT vector AND NOT rrna) AS mrna FROM s),
g AS (SELECT read_id, source AS gene_id FROM s WHERE hq AND NOT host AND NOT vector AND NOT rrna AND n_chars > 500 UNION ALL SELECT read_id, concat(source, 'b') FROM s WHERE hq AND NOT host AND NOT vector AND NOT rrna AND n_chars > 1000),
h AS (SELECT count(DISTINCT read_id) AS annotated, count(DISTINCT gene_id) AS genes FROM g),
e AS (SELECT count(DISTINCT ec) FILTER (tier = 'HQ') AS ecs_hq, count(DISTINCT ec) AS ecs_lq FROM (SELECT ec, CASE WHEN prob >= 0.5 THEN 'HQ' ELSE 'LQ' END AS tier FROM v_ec_pred))
SELECT raw, hq, host, vector, rrna, mrna, annotated, genes, ecs_hq, ecs_lq, {', '.join(PERCENT.format(part=p, whole='raw') for p in ('hq', 'host', 'vector', 'rrna', 'mrna'))}, {PERCENT.format(part='annotated', whole='mrna')} FROM c, h, e""")
def read_funnel(spark, d):
    v = view(spark, d, "v_reads").join(view(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")
    s = v.select("read_id", "source", "n_chars", (F.length("qual") >= 100).alias("hq"), F.col("seq").contains("GATTAC").alias("host"), F.col("seq").contains("CCAATT").alias("vector"), (F.col("lang") != "en").alias("rrna"))
    hq, host, vector, rrna = F.col("hq"), F.col("host"), F.col("vector"), F.col("rrna")
    mrna = hq & ~host & ~vector & ~rrna
    counts = s.agg(F.count(F.lit(1)).alias("raw"), F.count_if(hq).alias("hq"), F.count_if(hq & host).alias("host"), F.count_if(hq & ~host & vector).alias("vector"), F.count_if(hq & ~host & ~vector & rrna).alias("rrna"), F.count_if(mrna).alias("mrna"))
    # A gene map that leaves short reads without a gene and gives long ones two.
    long = s.filter(mrna)
    genes = long.filter("n_chars > 500").select("read_id", F.col("source").alias("gene_id")).unionByName(long.filter("n_chars > 1000").select("read_id", F.concat("source", F.lit("b")).alias("gene_id")))
    ecs = view(spark, d, "v_ec_pred")
    return M.read_funnel(counts, genes, ecs.filter("prob >= 0.5"), ecs)


ADAPTERS = "SELECT r_name AS adapter, left(repeat(translate(regexp_replace(lower(r_name), '[^a-z]', ''{g}), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC'), 3), 12) AS bases FROM region"


@query("WITH a AS (" + ADAPTERS.replace("{g}", ", 'g'") + """), p AS (SELECT read_id, adapter, i AS place, least(length(bases), length(seq) - i) AS n, seq, bases FROM v_reads, a, unnest(range(0, length(seq) - 4)) AS u(i)),
f AS (SELECT read_id, min({'place': place, 'adapter': adapter}) AS f FROM p WHERE hamming(substr(seq, place + 1, n), left(bases, n)) <= n // 5 GROUP BY read_id)
SELECT read_id, coalesce(f.adapter, '') AS adapter, CASE WHEN f IS NULL THEN seq ELSE left(seq, f.place) END AS seq, CASE WHEN f IS NULL THEN qual ELSE left(qual, f.place) END AS qual FROM v_reads LEFT JOIN f USING (read_id)""")
def trim_adapter_table(spark, d):
    adapters = spark.sql(ADAPTERS.replace("{g}", "").replace("FROM region", "FROM {region}"), region=view(spark, d, "region"))
    out = mates.trim_adapters(view(spark, d, "v_reads"), adapters, 5, 0.2)
    return out.select("read_id", F.coalesce("adapter", F.lit("")).alias("adapter"), "seq", "qual")


def merge_mates(spark, d):
    """Whole reads and mates that begin with their last third, of which up to four bases differ. All overlaps of whole texts
    are too slow in SQL; tests hold the operator against plain loops."""
    v = view(spark, d, "v_reads")
    begin = F.right("seq", F.floor(F.length("seq") / 3).cast("int"))
    other = F.concat(begin, F.lit("GATTACA"), F.left("seq", F.lit(50)))
    for k in range(4):
        at = (1 + (F.col("doc_id") * (k + 3)) % F.greatest(F.length(begin), F.lit(1))).cast("int")
        other = F.when(F.col("doc_id") % 5 > k, F.overlay(other, F.lit("T"), at)).otherwise(other)
    mate2 = v.select("read_id", R.reverse_complement(other).alias("seq"), F.reverse(F.rpad(F.right("qual", F.length(begin)), F.length(other), "F")).alias("qual"))
    return mates.merge_mates(v.select("read_id", "seq", "qual"), mate2)


QUERIES["merge_mates"] = merge_mates
