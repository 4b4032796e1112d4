"""How far apart the sources of a language are in the words they use: an exact audit over k-squared trees.

Per language, the counts of its kept terms form a matrix: a row a source, a column a term. Nearly all of it is zero. A
zero has the same smoothed share throughout its row, z, so a quadrant in which two rows are both empty adds |z - z'| a
column, and one in which a single row has counts adds what the sorted shares and their prefix sums give: both are priced
without looking into them. Only where both rows have counts are the trees (k = 2: each node's four quadrants, stored only
where something is in them) descended together, for all pairs of rows at once, down to the leaves that both hold:

    value(g, h) = V |zg - zh|  +  sum over g's terms of (|pg - zh| - |zg - zh|)  +  the same for h's terms
                 + sum over terms of both of (|pg - ph| - |pg - zh| - |zg - ph| + |zg - zh|)

Spark deals the matrix out by blocks of rows and strips of columns; a task holds one strip of two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwise.llm.common import rank_buckets, salted_rank, table
from strandwise.scratch import written

#: Documents of a language that a kept term stands in, pseudo-count, scale of the shares, ranks of terms that are returned.
LEAST, PRIOR, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Rows and columns of a tree (two to the power LEVELS), strips that a language has about, trees of a strip at most.
LEVELS, STRIPS, TREES = 8, 64, 64
SIDE = 1 << LEVELS
#: Node pairs that are expanded at once; UTF-8 bytes of text that are counted at once.
PAIRS, CHUNK = 1 << 20, 6 << 20

#: Bytes of a term stand for themselves (A-Z lower-cased), all others for a space.
_TERM = np.array([b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)], np.uint8)


def _terms(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of the texts, coded, and the text that each is of."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
    body = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    plain = pa.StringArray.from_buffers(len(texts), pa.py_buffer((offsets - offsets[0]).astype(np.int32)), pa.py_buffer(_TERM[body]))
    lists = pc.ascii_split_whitespace(plain)
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))[real]
    return flat.filter(pa.array(real)).dictionary_encode(), of


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), df (rows of docs it stands in). Counted in chunks of CHUNK bytes, then added up."""
    names = ["lang", "source", "term", "n", "df"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ends, lo = batch.column(2), None, 0
            ends = np.cumsum(pc.binary_length(texts).to_numpy())
            while lo < len(texts):
                past = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHUNK, side="right")))
                coded, of = _terms(texts.slice(lo, past - lo))
                groups = pc.binary_join_element_wise(batch.column(0).slice(lo, past - lo), batch.column(1).slice(lo, past - lo), "\0").dictionary_encode()
                first = np.zeros(len(groups.dictionary), np.int64)
                group = groups.indices.to_numpy()
                first[group[::-1]] = np.arange(lo, past)[::-1]
                size = max(len(coded.dictionary), 1)
                codes = coded.indices.to_numpy().astype(np.int64)
                cells, n = np.unique(group[of].astype(np.int64) * size + codes, return_counts=True)
                once = np.unique(of * size + codes)
                df = np.unique(group[once // size].astype(np.int64) * size + once % size, return_counts=True)[1]
                at = pa.array(first[cells // size])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), coded.dictionary.take(pa.array(cells % size)), pa.array(n), pa.array(df)], names)
                lo = past

    counted = _plain(docs).mapInArrow(run, "lang string, source string, term string, n long, df long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _share(count: Column, total: Column, terms: Column, scale: int, prior: int) -> Column:
    """1 + floor(scale * (count + prior) / (total + prior * terms)), exactly; null without terms."""
    whole = (count + prior).cast("decimal(20,0)") * F.lit(scale).cast("decimal(11,0)")
    part = F.nullif((total + prior * terms).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.lit(1).cast("long") + F.call_function("div", whole, part)


class Tree:
    """The k-squared tree (k = 2) of the cells of a square: per level the nodes that hold something, with their four children."""

    def __init__(self, row: np.ndarray, col: np.ndarray):
        code = np.zeros(len(row), np.int64)
        for b in range(LEVELS):
            code |= ((row >> b & 1) << (2 * b + 1)) | ((col >> b & 1) << (2 * b))
        self.order = np.argsort(code)
        levels = [np.unique(code >> 2 * (LEVELS - k)) for k in range(LEVELS + 1)]
        self.children = []
        for up, down in zip(levels, levels[1:], strict=False):
            children = np.full((len(up), 4), -1)
            children[np.searchsorted(up, down >> 2), down & 3] = np.arange(len(down))
            self.children.append(children)
        self.rows = [self._row(x) for x in levels]  # the rows above each node's, at its level

    @staticmethod
    def _row(code: np.ndarray) -> np.ndarray:
        out = np.zeros_like(code)
        for b in range(LEVELS):
            out |= (code >> (2 * b + 1) & 1) << b
        return out


def both_leaves(a: Tree, b: Tree, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of leaves of two trees in the same column, in pieces; where the trees are the ``same``, those of a smaller and a larger row.

    Node pairs are expanded from the root down. A pair of which one side is empty is never made. What waits is at most
    PAIRS node pairs and their unexpanded siblings on each level.
    """
    stack = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        if level == LEVELS:
            yield i, j
            continue
        if len(i) > PAIRS:
            half = len(i) // 2
            stack += [(level, i[:half], j[:half]), (level, i[half:], j[half:])]
            continue
        found = []
        for q in range(4):
            for r in (q & 1, q & 1 | 2):  # the same half of the columns
                x, y = a.children[level][i, q], b.children[level][j, r]
                ok = (x >= 0) & (y >= 0)
                if same:
                    ok &= (a.rows[level + 1][x] < b.rows[level + 1][y]) if level == LEVELS - 1 else (a.rows[level + 1][x] <= b.rows[level + 1][y])
                found.append((x[ok], y[ok]))
        i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        if len(i):
            stack.append((level + 1, i, j))


def _one_sided(row: np.ndarray, p: np.ndarray, z: np.ndarray, other: np.ndarray) -> np.ndarray:
    """[row, other row]: sum over the row's cells of |p - z'| - |z - z'|, by sorted shares and prefix sums."""
    out = np.zeros((SIDE, SIDE), np.int64)
    order = np.lexsort((p, row))
    row, p = row[order], p[order]
    for r, lo, hi in zip(*_bounds(row), strict=True):
        own = p[lo:hi]
        sums = np.concatenate([[0], np.cumsum(own)])
        at = np.searchsorted(own, other)
        out[r] = (other * at - sums[at]) + (sums[-1] - sums[at] - other * (len(own) - at)) - len(own) * np.abs(z[r] - other)
    return out


def _bounds(values: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    at = np.flatnonzero(np.diff(values)) + 1
    lo, hi = [0, *at.tolist()], [*at.tolist(), len(values)]
    return ([int(values[x]) for x in lo], lo, hi) if len(values) else ([], [], [])


def _strip(got: pd.DataFrame, block_a: int, block_b: int) -> np.ndarray:
    """[row of a, row of b]: what one strip of two row blocks adds to V |z - z'|. Rows of got with col < 0 give the z of their row."""
    same = block_a == block_b
    sides = []
    for block in (block_a, block_b):
        mine = got[got.block == block]
        flat, cells = mine[mine.col < 0], mine[mine.col >= 0]
        z = np.zeros(SIDE, np.int64)
        z[flat.row.to_numpy() % SIDE] = flat.p.to_numpy()
        sides.append((z, cells.row.to_numpy() % SIDE, cells.col.to_numpy(), cells.p.to_numpy()))
    (za, ra, ca, pa_), (zb, rb, cb, pb) = sides
    out = _one_sided(ra, pa_, za, zb) + _one_sided(rb, pb, zb, za).T
    for t in np.intersect1d(ca // SIDE, cb // SIDE):
        ma, mb = ca // SIDE == t, cb // SIDE == t
        a, b = Tree(ra[ma], ca[ma] % SIDE), Tree(rb[mb], cb[mb] % SIDE)
        xr, xp, yr, yp = ra[ma][a.order], pa_[ma][a.order], rb[mb][b.order], pb[mb][b.order]
        for i, j in both_leaves(a, b, same):
            for lo in range(0, len(i), PAIRS):
                k, m = i[lo : lo + PAIRS], j[lo : lo + PAIRS]
                p, q, z, y = xp[k], yp[m], za[xr[k]], zb[yr[m]]
                price = np.abs(p - q) - np.abs(p - y) - np.abs(z - q) + np.abs(z - y)
                # At most 2^20 prices of at most 2^33 each: exact as doubles.
                out += np.bincount(xr[k] * SIDE + yr[m], price, SIDE * SIDE).astype(np.int64).reshape(SIDE, SIDE)
    return out


def _corrections(key: tuple, got: pd.DataFrame) -> pd.DataFrame:
    lang, _, block_a, block_b = key
    out = _strip(got, block_a, block_b)
    if block_a == block_b:
        out = np.triu(out, 1)
    g, h = np.nonzero(out)
    return pd.DataFrame({"lang": lang, "g": g + block_a * SIDE, "h": h + block_b * SIDE, "more": out[g, h]})


def audit(docs: DataFrame, least: int = LEAST, prior: int = PRIOR, scale: int = SCALE, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank for docs (lang, source, text).

    part ``pair``: each other source of the lang with the sum over the kept terms of the differences of their shares;
    part ``term``: the ``top`` terms whose share in the source most exceeds the lang's. Nulls are empty strings, and an
    empty text makes its group occur; a lang without kept terms has pairs of value 0. Rows that repeat count each. Other
    columns of docs are ignored; an empty table gives no rows.
    """
    docs = docs.select("lang", "source", "text")
    counts = written(term_counts(docs), "divergence-counts")
    by_term = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df")).filter(F.col("df") >= least)
    kept = written(by_term, "divergence-kept")
    groups = written(_plain(docs.withColumn("text", F.lit(""))).select("lang", "source").distinct(), "divergence-groups")
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    stats = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("total"))
    langs = written(langs.join(stats, "lang", "left").na.fill(0), "divergence-langs")
    n_kept, most, n_groups = (*kept.agg(F.count(F.lit(1))).first(), *langs.agg(F.max("v"), F.sum("sources")).first())
    trees = int(min(max(-(-(most or 0) // (SIDE * STRIPS)), 1), TREES))

    # Frequent terms come first, so that the columns of rare ones, nearly empty, share quadrants.
    buckets = rank_buckets(n_kept)
    salt = -(-buckets // 64)
    frequent = (F.lit(63) - F.floor(F.log2("df")).cast("int")) * salt + F.pmod(F.xxhash64("term"), F.lit(salt)).cast("int")
    columns = written(salted_rank(kept, ["lang"], ["term"], "col", buckets, bucket=frequent), "divergence-columns")
    cells = written(counts.select("lang", "source", "term", "n").join(columns.select("lang", "term", "lang_n", "col"), ["lang", "term"]), "divergence-cells")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    rows = salted_rank(groups.join(totals, ["lang", "source"], "left").na.fill(0, ["group_n"]), ["lang"], ["source"], "row", rank_buckets(n_groups or 0))
    zero = _share(F.lit(0).cast("long"), F.col("group_n"), F.col("v"), scale, prior)
    rows = written(rows.join(langs, "lang").withColumn("z", zero), "divergence-rows")
    blocks = F.floor((F.col("sources") - 1) / SIDE)
    shared = cells.join(rows.select("lang", "source", "row", "sources", "group_n", "v", "total"), ["lang", "source"])
    shared = shared.withColumn("p", _share(F.col("n"), F.col("group_n"), F.col("v"), scale, prior))

    strip = F.floor(F.col("col") / (SIDE * trees))
    to_blocks = lambda df: df.withColumn("block", F.floor(F.col("row") / SIDE)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks)))
    dealt = ["lang", "strip", "block_a", "block_b"]
    in_pair = lambda df: df.select("lang", "strip", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"), "block", "row", "col", "p")
    strips = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("v") - 1) / (SIDE * trees))))
    flat = rows.filter("v > 0").withColumn("strip", strips).withColumn("col", F.lit(-1).cast("long")).withColumn("p", F.col("z"))
    tiles = in_pair(to_blocks(shared.withColumn("strip", strip))).unionByName(in_pair(to_blocks(flat)))
    more = tiles.groupBy(*dealt).applyInPandas(_corrections, "lang string, g long, h long, more long").groupBy("lang", "g", "h").agg(F.sum("more").alias("more"))

    # All pairs of a lang's sources are the result itself; blocks of rows keep a lang of very many from being one task's.
    side = lambda mine, a, b: to_blocks(rows).select("lang", F.col("block").alias(a), F.col("other").alias(b), *[F.col(c).alias(f"{mine}_{c}") for c in ("row", "source", "z", "v")])
    pairs = side("g", "block_a", "block_b").join(side("h", "block_b", "block_a"), ["lang", "block_a", "block_b"]).filter("g_row <> h_row")
    pairs = pairs.withColumns({"g": F.least("g_row", "h_row"), "h": F.greatest("g_row", "h_row")}).join(more, ["lang", "g", "h"], "left")
    base = F.coalesce(F.col("g_v") * F.abs(F.col("g_z") - F.col("h_z")), F.lit(0))
    out = pairs.select("lang", F.col("g_source").alias("source"), F.lit("pair").alias("part"), F.col("h_source").alias("item"), (base + F.coalesce("more", F.lit(0))).cast("long").alias("value"))
    above = shared.withColumn("q", _share(F.col("lang_n"), F.col("total"), F.col("v"), scale, prior)).filter(F.col("p") > F.col("q"))
    above = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    place = F.row_number().over(order)
    return out.withColumn("rank", place).unionByName(above.withColumn("rank", place).filter(F.col("rank") <= top))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms, row_number() OVER () AS rid FROM documents),
t AS (SELECT rid, lang, source, unnest(terms) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
k AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= {LEAST}),
l AS (SELECT lang, count(*) AS v, sum(lang_n)::HUGEINT AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
cell AS (SELECT g.lang, g.source, k.term, lang_n, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS group_n, v, total
         FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, term, n, 1 + {SCALE}::HUGEINT * (n + {PRIOR}) // (group_n + {PRIOR} * v) AS p, 1 + {SCALE}::HUGEINT * (lang_n + {PRIOR}) // (total + {PRIOR} * v) AS q FROM cell),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM s WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM terms) WHERE rank <= {TOP}
"""
