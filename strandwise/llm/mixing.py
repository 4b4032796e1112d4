"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Each source's rows are cut into blocks. With weight w, block j of a source is released at slot floor(j / w) and due
by slot ceil((j + 1) / w); in each slot the released block with the earliest deadline goes next. Then after any number
of slots every source is less than one block away from its target. Release and deadline follow from the given weights by
whole-number arithmetic, for every block by itself, so that no error adds up along the schedule. Blocks grow with the
mixture, so that the schedule has about MOST slots at most, however many rows there are; it is worked out once, and every
row finds its slot by its source and block.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwise.llm.common import bind, draw, draw_bucket, rank_buckets, salted_rank, table
from strandwise.scratch import written, written_counted

#: Weights are whole numbers of units that add up to UNITS. Rows of a block at least; slots that the blocks of a mixture
#: fill at most, by and large; slots that are scheduled in one inner loop.
UNITS, BLOCK, MOST, SPAN = 2_000_000_000, 16, 1 << 17, 512
#: Epochs of a row that one task deals out; a row of more is spread over tasks in such steps.
EPOCHS = 1_000
#: Without given weights a source weighs its row count to this power: below 1, small sources gain and large ones give way.
TEMPER = 0.8
NO_SOURCE = "\u0000none"


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(NO_SOURCE))


def weighed(docs: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """source, n (its rows), w (its weight). A source that given ``weights`` do not name, or name with no weight above 0, is an error."""
    counted = docs.select(_source().alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        return counted.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(TEMPER)))
    pairs = [x for s, w in weights.items() for x in (F.lit(s), F.lit(float(w)))]
    given = F.try_element_at(F.create_map(*pairs), F.col("source")) if pairs else F.lit(None).cast("double")
    return counted.withColumn("w", F.when(given > 0, given).otherwise(F.raise_error(F.concat(F.lit("no weight above 0 for source "), F.col("source"))).cast("double")))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def release(block: Column, units: Column) -> Column:
    """floor(block / weight), exactly: no product passes UNITS squared."""
    return _div(block, units) * UNITS + _div(block % units * UNITS, units)


def deadline(block: Column, units: Column) -> Column:
    """ceil((block + 1) / weight), exactly."""
    return _div(block + 1, units) * UNITS + _div((block + 1) % units * UNITS + units - 1, units)


def shares(found: DataFrame) -> DataFrame:
    """found (source, n, w) with units, its weight: one at least; they add up to UNITS. One row per source.

    Weights are taken to one part in UNITS of the whole; largest remainders get the units that rounding leaves.
    """
    # All sources make up the one distribution: a row each.
    every = Window.partitionBy(F.lit(0))
    total = F.sum("w").over(every.orderBy("source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    each = found.withColumn("free", F.lit(UNITS) - F.count(F.lit(1)).over(every)).withColumn("exact", F.col("w") / total * F.col("free"))
    by_rest = every.orderBy((F.col("exact") - F.floor("exact")).desc(), "source")
    spare = F.col("free") - F.sum(F.floor("exact")).over(every)
    units = F.lit(1) + F.floor("exact") + F.when(F.row_number().over(by_rest) <= spare, 1).otherwise(0)
    return each.select("source", "n", units.cast("long").alias("units"))


def _block_rows(shared: DataFrame, block: int, most: int) -> int:
    """Rows of a block: ``block``, or as many more as keep the schedule near ``most`` slots."""
    rows = shared.agg(F.max(F.col("n") * (UNITS / F.col("units")))).first()[0] or 0
    return max(block, int(-(-rows // most)))


def schedule(shared: DataFrame, block: int) -> DataFrame:
    """source, n, block, slot, release, deadline for all slots until every source has shown all its rows once. Empty without sources."""
    blocks = F.ceil(F.col("n") / block).cast("long")
    one = shared.agg(F.array_sort(F.collect_list(F.struct("source", "n", "units"))).alias("s"), F.max(deadline(blocks - 1, F.col("units"))).alias("slots")).filter("slots > 0")
    next_of = lambda nth, units: F.struct(release(nth, units).alias("rel"), deadline(nth, units).alias("due"), nth.alias("nth"))

    def step(state: Column, slot: Column) -> Column:
        ready = F.array_min(F.transform(state["next"], lambda x, i: F.when(x["rel"] <= slot, F.struct(x["due"].alias("due"), i.alias("i")))))
        return bind(
            ready["i"],
            lambda first: F.struct(
                F.transform(state["next"], lambda x, i: F.when(i == first, next_of(x["nth"] + 1, F.get("s", i)["units"])).otherwise(x)).alias("next"),
                F.concat(state["picks"], F.array(F.struct(first.alias("i"), F.get(state["next"], first).alias("at"), slot.alias("slot")))).alias("picks"),
            ),
        )

    none = F.array().cast("array<struct<i:int,at:struct<rel:bigint,due:bigint,nth:bigint>,slot:bigint>>")

    def span(state: Column, k: Column) -> Column:
        slots = F.sequence(k * SPAN, F.least(F.col("slots"), (k + 1) * SPAN) - 1)
        return bind(F.aggregate(slots, F.struct(state["next"].alias("next"), none.alias("picks")), step), lambda x: F.struct(x["next"].alias("next"), F.concat(state["spans"], F.array(x["picks"])).alias("spans")))

    start = F.struct(F.transform("s", lambda x: next_of(F.lit(0).cast("long"), x["units"])).alias("next"), F.array().cast("array<array<struct<i:int,at:struct<rel:bigint,due:bigint,nth:bigint>,slot:bigint>>>").alias("spans"))
    spans = F.sequence(F.lit(0).cast("long"), _div(F.col("slots") - 1, F.lit(SPAN).cast("long")))
    run = one.select("s", F.explode(F.aggregate(spans, start, span)["spans"]).alias("span"))
    picked = run.select("s", F.explode("span").alias("p")).select(F.get("s", F.col("p.i")).alias("x"), "p")
    return picked.select(F.col("x.source").alias("source"), F.col("x.n").alias("n"), F.col("p.at.nth").alias("block"), F.col("p.slot").alias("slot"), F.col("p.at.rel").alias("release"), F.col("p.at.due").alias("deadline"))


def _own(docs: DataFrame) -> list[Column]:
    """Source, id and a hash of the text of each row, which tell its rows apart (rows equal in all are interchangeable), and a draw from id and text."""
    text = F.col("text").cast("string") if "text" in docs.columns else F.lit("")
    drawn = draw(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))))
    return [_source().alias("m_source"), F.col("doc_id").alias("m_id"), F.xxhash64(text).alias("m_text"), drawn.alias("m_draw")]


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK, columns: tuple[str, ...] = ("doc_id",), most: int = MOST) -> DataFrame:
    """The mixture: each row of docs once or, where its source runs out early, in several epochs.

    Returns ``columns`` of docs with source, epoch (from 0), block (number within its source), slot, release, deadline
    and place (row within the block); slot and place give the order of the mixture. It ends when every source has been
    shown in full, so no row is left out; a source shows its rows in the order of a draw from id and text. Given
    ``weights`` must name every source. A null source is a source of its own (source null); repeated rows count
    separately; an empty table gives no rows. A block has ``block`` rows, or more where that would make more than about
    ``most`` slots.
    """
    shared = written(shares(weighed(docs, weights)), "mixing-shares")
    size = _block_rows(shared, block, most)
    plan, slots = written_counted(schedule(shared, size), "mixing-schedule")
    keyed = docs.select(*[F.col(c).alias(f"c_{c}") for c in columns], *_own(docs))
    buckets = rank_buckets(shared.agg(F.sum("n")).first()[0] or 0)
    ranked = salted_rank(keyed, ["m_source"], ["m_draw", "m_id", "m_text"], "m_rank", buckets, docs.select(*_own(docs)), draw_bucket(F.col("m_draw"), buckets))
    sized = plan.groupBy(F.col("source").alias("m_source"), "n").agg((F.count(F.lit(1)) * size).alias("rows"))
    plan = plan.select(F.col("source").alias("m_source"), "block", "slot", "release", "deadline")
    # The schedule has no more slots than ``most`` asks for, unless a tiny weight alone asks for more; then Spark joins as it sees fit.
    small = F.broadcast if slots <= 2 * most else lambda x: x
    met = ranked.join(small(sized), "m_source").withColumn("last", F.greatest(F.ceil((F.col("rows") - F.col("m_rank")) / F.col("n")).cast("long") - 1, F.lit(0).cast("long")))
    from_step = lambda step: F.explode(F.sequence(step * EPOCHS, F.least(F.col("last"), (step + 1) * EPOCHS - 1)))
    epochs = met.filter(F.col("last") < EPOCHS).withColumn("epoch", from_step(F.lit(0).cast("long")))
    if not sized.filter(F.col("rows") > EPOCHS * F.col("n")).isEmpty():
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = met.filter(F.col("last") >= EPOCHS).withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / EPOCHS).cast("long"))))
        spread = spread.repartition(parts, "m_source", "m_rank", "step").withColumn("epoch", from_step(F.col("step"))).drop("step")
        epochs = epochs.unionByName(spread)
    seen = epochs.withColumn("seen", F.col("epoch") * F.col("n") + F.col("m_rank")).filter(F.col("seen") < F.col("rows"))
    rows = F.lit(size).cast("long")
    placed = seen.withColumn("block", _div(F.col("seen"), rows)).withColumn("place", (F.col("seen") % rows).cast("int")).join(small(plan), ["m_source", "block"])
    return placed.select(*[F.col(f"c_{c}").alias(c) for c in columns], F.nullif(F.col("m_source"), F.lit(NO_SOURCE)).alias("source"), "epoch", "block", "slot", "release", "deadline", "place")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def _sql_release(j: str) -> str:
    return f"({j} // w * {UNITS} + {j} % w * {UNITS} // w)"


def _sql_deadline(j: str) -> str:
    return f"(({j} + 1) // w * {UNITS} + (({j} + 1) % w * {UNITS} + w - 1) // w)"


#: For ids that do not repeat, and mixtures of no more than MOST slots. ``s`` steps through the slots: the released block that is due first goes next.
OP7_SQL = f"""
WITH RECURSIVE r AS (SELECT doc_id, source, coalesce(source, '') AS k, row_number() OVER (PARTITION BY source ORDER BY
       ('0x' || substr(md5(concat(doc_id, ':', md5(coalesce(text, '')))), 1, 12))::BIGINT, doc_id) - 1 AS rank FROM documents),
c AS (SELECT k, count(*) AS n, pow(count(*), {TEMPER}) AS w FROM r GROUP BY k),
e AS (SELECT k, n, w / sum(w) OVER () * ({UNITS} - count(*) OVER ()) AS x, {UNITS} - count(*) OVER () AS free FROM c),
p AS (SELECT k, n, 1 + floor(x)::BIGINT + (row_number() OVER (ORDER BY x - floor(x) DESC, k) <= free - sum(floor(x)) OVER ())::BIGINT AS w FROM e),
l AS (SELECT list(w ORDER BY k) AS shares, list(k ORDER BY k) AS names, max({_sql_deadline(f"((n + {BLOCK - 1}) // {BLOCK} - 1)")}) AS slots FROM p),
s(slot, pick, nth, done) AS (
    SELECT -1::BIGINT, 0::BIGINT, 0::BIGINT, list_transform(shares, lambda x: 0::BIGINT) FROM l
    UNION ALL
    SELECT slot, pick, done[pick], list_transform(done, lambda x, i: x + (i = pick)::BIGINT) FROM (
        SELECT slot, done, list_position(due, list_min(due)) AS pick FROM (
            SELECT slot + 1 AS slot, done, list_transform(shares, lambda w, i: CASE WHEN {_sql_release("done[i]")} <= slot + 1
                   THEN {_sql_deadline("done[i]")} ELSE 1000000000000000 END) AS due FROM s, l WHERE slot < slots - 1))),
plan AS (SELECT slot, names[pick] AS k, nth FROM s, l WHERE slot >= 0),
b AS (SELECT k, n, w, {BLOCK} * count(*) AS rows FROM p JOIN plan USING (k) GROUP BY k, n, w),
t AS (SELECT doc_id, source, k, w, epoch, (epoch * n + rank)::BIGINT AS seen FROM r JOIN b USING (k), unnest(range((rows - rank + n - 1) // n)) AS u(epoch))
SELECT doc_id, source, epoch::BIGINT AS epoch, seen // {BLOCK} AS block, slot, {_sql_release(f"(seen // {BLOCK})")} AS release, {_sql_deadline(f"(seen // {BLOCK})")} AS deadline, (seen % {BLOCK})::INTEGER AS place
FROM t JOIN plan ON plan.k = t.k AND nth = seen // {BLOCK}
"""


def mixed_documents(docs: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """The rows of the mixture with the columns of docs: a row of a source that runs out early occurs once per epoch.

    Null ids, texts and sources, repeated rows and empty tables are as in ``mix``; all columns of docs stay, whatever they
    are called.
    """
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("row"))
    return mix(rows, weights, columns=("row",)).select("row.*")
