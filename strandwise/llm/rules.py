"""Quality rules as a bitmask ledger, in DataFrame functions only.

One pass measures every document and evaluates every rule once; the ledger holds the measurements and one bit per
failed rule. A policy is a named, versioned set of rule bits: applying it, or asking what each rule alone would
have removed, is bit arithmetic on the ledger and never reads a text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm.common import WHITE, bind, table

#: The length of the word windows that count as a repetition.
WINDOW = 5

#: Rules; each holds for documents that FAIL it. All thresholds are here.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "too_many_symbols": "10 * n_symbols > 5 * n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "short_words": "word_chars < 2 * n_words",
}

#: The bit of each rule in stored ledgers: a new rule takes the next number, none is ever given anew.
BITS = {"too_few_words": 0, "repeated_windows": 1, "too_many_symbols": 2, "repeated_lines": 3, "long_words": 4, "short_words": 5}

#: Versioned policies: the rules whose failure removes a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": tuple(RULES),
}


def mask(policy: str) -> int:
    return sum(1 << BITS[name] for name in POLICIES[policy])


def _words(text: Column) -> Column:
    """The words as an array: a split leaves at most an empty first and last part."""
    return F.filter(F.split(text, f"{WHITE}+"), lambda w: w != F.lit(""))


def _covered(hashes: Column) -> Column:
    """Words within windows whose hash occurs twice or more: sort (hash, place), mark equal neighbours, add up gaps."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    hit = bind(pairs, lambda p: F.filter(F.transform(p, lambda x, k: F.when((F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull()))
    span = bind(F.sort_array(hit), lambda s: F.aggregate(F.transform(s, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x))
    return span.cast("long")


def _repeat_words(words: Column) -> Column:
    """Words in windows of five words that occur twice or more in the text; only texts with such a window pay for the sort.

    Windows are compared by a 64-bit hash of their words' hashes: a text of n words is miscounted with a chance of about n^2 / 2^65.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = bind(hashes, lambda h: F.transform(F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)])))
    return bind(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(_covered(w)))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of each whole text. A null text has none; every count is 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = _words(text)
    # One binding holds the words, so that the text is split once for all word measurements.
    by_word = bind(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeat_words(w).alias("n_repeat_words")))
    lines = bind(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    symbols = (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long")
    one = docs.select("doc_id", by_word.alias("w"), symbols.alias("n_symbols"), lines.alias("n_dup_lines"))
    return one.select("doc_id", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and failed_bits: a rule's bit is set where it fails. Every row of docs has one row, repeats and nulls too.

    A null text counts as empty, other columns are ignored, and an empty table gives no rows.
    """
    bits = [F.when(F.expr(rule), F.lit(1 << BITS[name])).otherwise(F.lit(0)) for name, rule in RULES.items()]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(docs).withColumn("failed_bits", total.cast("int"))


def fails(policy: str, bits: str = "failed_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask(policy))) != 0


def ablations(book: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that only it removes. One aggregation over the bits."""
    m = mask(policy)
    of = F.col("failed_bits").bitwiseAND(F.lit(m))
    row = book.agg(*[F.count_if(F.col("failed_bits").bitwiseAND(F.lit(1 << i)) != 0).alias(f"f{i}") for i in BITS.values()], *[F.count_if(of == (1 << i)).alias(f"o{i}") for i in BITS.values()])
    parts = ", ".join(f"'{name}', {i}, f{i}, o{i}" for name, i in BITS.items() if m >> i & 1)
    return row.selectExpr(f"stack({bin(m).count('1')}, {parts}) as (rule, bit, failed, only_this_rule)")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = ledger(table(spark, sf_dir, "documents"))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", fails("base").alias("base_failed"), (~fails("v1")).alias("kept"), "failed_bits")


def kept_documents(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The rows of docs whose failed bits the policy does not name. Rows carry their ledger: no join, so repeated and null ids are safe.

    A null text counts as empty (and fails where too few words do); columns of docs stay, whatever they are called; an
    empty table gives no rows.
    """
    book = ledger(docs.select(F.struct(*docs.columns).alias("doc_id"), "text"))
    return book.filter(~fails(policy)).select("doc_id.*")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
win AS (SELECT rid, i, words[i : i + 4] AS g FROM w, unnest(range(1, len(words) - 3)) AS t(i)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
cover AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 5)) AS t(k) GROUP BY rid),
line AS (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d),
dup AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cover USING (rid) LEFT JOIN dup USING (rid)),
b AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
             + (CASE WHEN 10 * n_symbols > 5 * n_words THEN 4 ELSE 0 END) + (CASE WHEN 10 * n_dup_lines > 3 * n_words THEN 8 ELSE 0 END)
             + (CASE WHEN word_chars > 25 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END) AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 AS base_failed,
       bits = 0 AS kept, bits::INTEGER AS failed_bits FROM b
"""
