"""URL filters: rules first, else logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm.common import table

#: (rule, verdict): host and path prefix. Fixed values of the query.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: Words that unwanted hosts are made of, by topic, words of ordinary hosts, and words that stand in both: fixed example
#: values, chosen without regard to any table that is judged.
UNWANTED = {
    "gambling": "poker jackpot lottery roulette blackjack bingo wager gambling sportsbook baccarat craps",
    "adult": "porn sexcam escort erotic nude hookup stripper fetish camgirl",
    "pharmacy": "viagra cialis steroids oxycodone xanax levitra painkiller slimming",
    "advertising": "adserver popunder clickbait affiliate adclick adnetwork doubleclicks",
    "spam": "backlinks clickfarm linkbuilder massmailer seoboost bulkmail",
    "fraud": "payday replica phishing getrich cashloan freeprize sweepstakes",
    "piracy": "warez torrent keygen cracked serialz nulled pirated",
}
ORDINARY = """
university library museum school college academy research science journal archive history geography weather climate news
press radio city council parliament ministry court statistics census health hospital clinic sports football chess music
orchestra theatre cinema gallery painting poetry novel books cooking recipes bread garden forest river mountain travel
railway airport harbour bicycle kitchen carpenter weaving pottery software kernel compiler database network wiki docs forum
community family village church festival market farmer animals birds insects plants minerals physics chemistry biology
mathematics logic language dictionary translation grammar education lesson exam student teacher professor
"""
NEUTRAL = "best online hot fast big top my world mega"
SYLLABLES = "an ber cor del en fil gar hol in jun kal lor men nor op per quin ros sal tor ul ver wen yor zan"
ENDINGS = "example.org example.net example.edu example.info"
SUBDOMAINS = ("", "www.", "shop.", "static.")
#: Paths of both labels, of unwanted and of ordinary URLs; {n} is a number.
PATHS = {None: "/{n}.html /index.html / /{n}?page=2", 1: "/bonus/{n} /claim-now/{n} /signup/offer{n} /out.php?id={n}", 0: "/article/{n} /about/ /docs/{n}/ /events/{n}#top"}
#: Share of unwanted URLs that is expected outside the table, in which they are overrepresented.
PRIOR = 0.1
#: Hash residue of the host words whose URLs only measure the model, one of so many.
HELD_OUT = 5


def labelled_table() -> list[tuple[str, int, str]]:
    """The small table of labelled URLs (url, label, host word; 1 to block), made from the word lists above.

    Each host holds one word of its label, alone or with a neutral word before or behind it. Subdomains, endings and half of
    the paths are dealt to both labels alike; the other half are paths of the label's own.
    """
    neutral, parts, ends = NEUTRAL.split(), SYLLABLES.split(), ENDINGS.split()
    bad = [w for words in UNWANTED.values() for w in words.split()]
    names = [a + parts[(k + j) % len(parts)] + rest for k, a in enumerate(parts) for j, rest in ((3, ""), (5, "a"), (7, parts[(k + 11) % len(parts)]), (13, "o"))]
    out = []
    for label, words in ((1, bad), (0, ORDINARY.split() + names)):
        paths = [PATHS[None].split(), PATHS[label].split()]
        for k, w in enumerate(words):
            forms = [w, w, *(f for j in (0, 3) for o in [neutral[(k + j) % len(neutral)]] for f in (f"{w}-{o}", f"{o}{w}", f"{o}-{w}", f"{w}{o}"))]
            for j, host in enumerate(forms):
                n = k * len(forms) + j
                out.append((f"https://{SUBDOMAINS[n % 4]}{host}.{ends[n // 4 % 4]}{paths[j % 2][n // 2 % 4].format(n=17 * n % 997)}", label, w))
    return out


#: Hash buckets of n-grams, their lengths, and the training passes, rate and penalty.
BUCKETS, GRAMS, PASSES, RATE, PENALTY = 1 << 16, (3, 4, 5), 1_500, 0.5, 1e-5


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; '' without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; '' without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]], value: int) -> Column:
    """The longest fitting rule (value 0) or its verdict (value 1); null without one. Of rules of one length the first wins."""
    out = None
    for rule in sorted(rules, key=lambda r: -len(r[0])):
        name, _, rest = rule[0].partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, rule[value]) if out is None else out.when(fits, rule[value])
    return F.lit(None).cast("string") if out is None else out


def features(host: str, path: str) -> np.ndarray:
    """Hash buckets of the character n-grams of host and path (apart from one another), each once."""
    seen = set()
    for mark, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in GRAMS:
            seen.update(zlib.crc32(f"{mark}{text[i : i + n]}".encode("utf-8", "surrogatepass")) % BUCKETS for i in range(len(text) - n + 1))
    return np.fromiter(sorted(seen), np.int64, len(seen))


def train(rows: Sequence[tuple[str, str, int]]) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression by gradient descent over (host, path, label); the table is small by contract.

    The bias goes from the table's own odds to those of PRIOR.
    """
    found = [features(h, p) for h, p, _ in rows]
    at = np.concatenate(found)
    of = np.repeat(np.arange(len(rows)), [len(f) for f in found])
    scale = 1 / np.sqrt(np.bincount(of, minlength=len(rows)))
    labels = np.array([y for _, _, y in rows], float)
    weights, bias = np.zeros(BUCKETS), 0.0
    for _ in range(PASSES):
        margin = scale * np.bincount(of, weights=weights[at], minlength=len(rows)) + bias
        error = 1 / (1 + np.exp(-margin)) - labels
        weights -= RATE * (np.bincount(at, weights=(error * scale)[of], minlength=BUCKETS) / len(rows) * 10 + PENALTY * weights)
        bias -= RATE * error.mean()
    odds = (labels.sum() + 1) / (len(labels) - labels.sum() + 1)
    return weights, bias + np.log(PRIOR / (1 - PRIOR)) - np.log(odds)


def labelled_urls(spark: SparkSession, held_out: bool = False) -> DataFrame:
    """The small table of labelled URLs (url, label): the rows to learn from, or those, of other host words, that only measure the model."""
    return spark.createDataFrame([(u, y) for u, y, w in labelled_table() if (zlib.crc32(w.encode()) % HELD_OUT == 0) == held_out], "url string, label int")


#: Rows of a labelled table that training takes at most.
TRAIN_ROWS = 10_000


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]] = RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict and score for every row of pages, repeats too; other columns are ignored.

    A rule's verdict stands (its rows have no score); without a fitting rule the model blocks from ``threshold`` on. A null url, or one without
    ://, has an empty host and path; no rule fits it, and the model judges the empty strings. Rules are a short list,
    so their test is part of the scan. An empty table gives no rows. Labelled rows without a label of 0 or 1 are left out;
    if none of either label remains, there is no model: scores are 0, and what no rule fits is allowed.
    """
    url = F.col("url")
    few = labelled.select(host_of(url).alias("h"), path_of(url).alias("p"), F.col("label").cast("int").alias("y")).filter(F.col("y").isin(0, 1)).orderBy("h", "p", "y").limit(TRAIN_ROWS).collect()
    weights, bias = train([tuple(r) for r in few]) if {r.y for r in few} == {0, 1} else (np.zeros(BUCKETS), -np.inf)

    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            # Rows that a rule decides come as nulls.
            margins = [np.nan if h is None else weights[f := features(h, p)].sum() / np.sqrt(max(1, len(f))) + bias for h, p in zip(hosts, paths, strict=True)]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(margins, float), -500, 500))) * (bias > -np.inf))

    block = F.pandas_udf(score, "double")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    host, path = F.col("host"), F.col("path")
    ruled = parts.select("page_id", "host", "path", rule_for(host, path, rules, 0).alias("rule"), rule_for(host, path, rules, 1).alias("ruled"))
    ruled = ruled.withColumn("score", block(F.when(F.col("ruled").isNull(), host), path))
    return ruled.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), labelled_urls(spark))
