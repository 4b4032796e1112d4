"""Enzyme predictions: agreement of tools, consensus, densities and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwise.functions.hits import complete_ec
from strandwise.scratch import ranged

#: Enzyme numbers that no prediction reports (fixed values).
EXCLUDED = ("2.7.11.1", "2.7.7.6", "2.7.13.3")


def ec_pairs(pairs: DataFrame) -> DataFrame:
    """(ec_lo, ec_hi, n): pairs in one order, provisional serials (with an n) dropped, the largest count kept."""
    ok = pairs.filter(~F.col("ec1").contains("n") & ~F.col("ec2").contains("n"))
    return ok.groupBy(F.least("ec1", "ec2").alias("ec_lo"), F.greatest("ec1", "ec2").alias("ec_hi")).agg(F.max("n").alias("n"))


def tool_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("gene_id", "ec").intersect(b.select("gene_id", "ec"))


def ec_union(priam: DataFrame, diamond: DataFrame, detect: DataFrame) -> DataFrame:
    """(priam and diamond) or detect; complete numbers only, each once."""
    every = tool_intersection(priam, diamond).union(detect.select("gene_id", "ec"))
    return every.filter(complete_ec(F.col("ec"))).distinct()


def _top_two(preds: DataFrame, order: list[Column], name: str) -> DataFrame:
    ranked = preds.withColumn("rn", F.row_number().over(Window.partitionBy("gene_id").orderBy(*order))).filter("rn <= 2")
    return ranked.groupBy("gene_id").agg(F.max(F.when(F.col("rn") == 1, F.col("ec"))).alias(f"{name}1"), F.max(F.when(F.col("rn") == 2, F.col("ec"))).alias(f"{name}2"))


def ec_consensus(detect: DataFrame, common: DataFrame, pairs: DataFrame) -> DataFrame:
    """(gene_id, ec, origin). Both inputs are (gene_id, ec, prob); pairs is (ec_lo, ec_hi).

    Two or more of detect: the top two if they are a frequent pair, else the top one. One of detect with common ones:
    it and the top common one if a frequent pair, else it. Without detect: the top two common ones if a frequent pair,
    else the lexicographically first of those two. Ties of prob go to the smaller number.
    """
    order = [F.col("prob").desc(), F.col("ec")]
    both = _top_two(detect, order, "d").join(_top_two(common, order, "c"), "gene_id", "full")
    a = F.when(F.col("d2").isNotNull(), F.col("d1")).when(F.col("d1").isNotNull(), F.col("d1")).otherwise(F.col("c1"))
    b = F.when(F.col("d2").isNotNull(), F.col("d2")).when(F.col("d1").isNotNull(), F.col("c1")).otherwise(F.col("c2"))
    cand = both.select("gene_id", a.alias("a"), b.alias("b"), F.when(F.col("d1").isNotNull(), "detect").otherwise("common").alias("origin"))
    met = cand.join(pairs.select("ec_lo", "ec_hi", F.lit(True).alias("pair")), (F.least("a", "b") == F.col("ec_lo")) & (F.greatest("a", "b") == F.col("ec_hi")) & F.col("a").isNotNull() & F.col("b").isNotNull(), "left")
    alone = F.when(F.col("origin") == "detect", F.col("a")).otherwise(F.least("a", "b"))
    ecs = F.when(F.col("pair"), F.array("a", "b")).otherwise(F.array(alone))
    return met.select("gene_id", F.explode(F.array_distinct(ecs)).alias("ec"), "origin")


def ec_report(gene_ec: DataFrame) -> DataFrame:
    """gene_id, n and its numbers joined by |, in order."""
    sets = gene_ec.groupBy("gene_id").agg(F.array_sort(F.collect_set("ec")).alias("e"))
    return sets.select("gene_id", F.size("e").alias("n"), F.array_join("e", "|").alias("ecs"))


def density_lookup(probes: DataFrame, points: DataFrame) -> DataFrame:
    """probes (ec, score) with density: the mean of the nearest points strictly below and above, 0 unless both exist.

    Points are averaged per (ec, score), probes are distinct, and both are dealt by ranges of (ec, score); a range is
    searched by itself, and what the ranges before and after it end in (one row an ec and range) goes over to it.
    """
    probe = probes.select("ec", "score").distinct().withColumn("density", F.lit(None).cast("double"))
    both = points.groupBy("ec", "score").agg(F.avg("density").alias("density")).unionByName(probe)
    # Strictly before and after: rows of the same score are merged into one, which holds the point apart from the probe.
    one = both.groupBy("ec", "score").agg(F.max("density").alias("point"), F.bool_or(F.col("density").isNull()).alias("probe"))
    dealt = ranged(one, ["ec", "score"], "densities")
    ends = dealt.filter("point IS NOT NULL").groupBy("ec", "part").agg(F.max_by("point", "score").alias("top"), F.min_by("point", "score").alias("bottom"))
    ends = dealt.select("ec", "part").distinct().join(ends, ["ec", "part"], "left")
    across = Window.partitionBy("ec").orderBy("part")
    back_across = Window.partitionBy("ec").orderBy(F.desc("part"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("ec", "part", F.last("top", ignorenulls=True).over(earlier(across)).alias("lo_in"), F.last("bottom", ignorenulls=True).over(earlier(back_across)).alias("hi_in"))
    own = Window.partitionBy("ec", "part").orderBy("score")
    # From the other end, as a frame that reaches to the end is read anew for every row.
    back = Window.partitionBy("ec", "part").orderBy(F.desc("score"))
    near = dealt.withColumn("lo", F.last("point", ignorenulls=True).over(earlier(own))).withColumn("hi", F.last("point", ignorenulls=True).over(earlier(back))).filter("probe").join(ends, ["ec", "part"])
    lo, hi = F.coalesce("lo", "lo_in"), F.coalesce("hi", "hi_in")
    return near.select("ec", "score", F.when(lo.isNotNull() & hi.isNotNull(), (lo + hi) / 2).otherwise(0.0).alias("density"))


def bayes_score(prior: Column, positive: Column, negative: Column) -> Column:
    """prior * pos / (prior * pos + (1 - prior) * neg); 1e-10 if both densities are 0, 0 without a prior."""
    return F.when(prior.isNull(), 0.0).when((positive == 0) & (negative == 0), 1e-10).otherwise(prior * positive / (prior * positive + (1 - prior) * negative))


def cumulative_probability(scored: DataFrame) -> DataFrame:
    """Per (query, ec): 1 - product(1 - p), positive hits, and negative hits (all of the query's other hits)."""
    per = scored.groupBy("query", "ec").agg((1 - F.product(1 - F.col("p"))).alias("prob"), F.count(F.lit(1)).alias("positive_hits"))
    total = F.sum("positive_hits").over(Window.partitionBy("query"))
    out = per.withColumn("negative_hits", total - F.col("positive_hits"))
    return out.filter(~F.col("ec").isin(*EXCLUDED) & (F.col("prob") > 1e-10))


def top_predictions(preds: DataFrame, n: int = 5, least: float = 0.2) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.col("prob").desc(), F.col("ec"))
    return preds.filter(F.col("prob") > least).withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def fbeta_predictions(preds: DataFrame, cutoffs: DataFrame, beta: float) -> DataFrame:
    """Predictions (query, ec, prob, ...) above their enzyme's own cutoff for beta; cutoffs is (ec, beta, cutoff). Enzymes without one are left out."""
    own = cutoffs.filter(F.col("beta") == beta).select("ec", "cutoff")
    return preds.join(own, "ec").filter(F.col("prob") > F.col("cutoff"))
