"""The language model against a plain implementation on small tables, its normalisation and its edge cases."""

import math
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandwise.llm import katz

SF = "/root/testdata/sf0.001"
HELD = "crc32(encode(cast(doc_id AS string), 'UTF-8')) % 7 = 2"


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


class Plain:
    """Dictionaries and loops."""

    def __init__(self, texts):
        tokens = [[*words(t), None] for t in texts]
        self.c = Counter(w for t in tokens for w in t)
        self.n, self.v = sum(self.c.values()), len(self.c)
        pairs = Counter(p for t in tokens for p in zip(["<s>", *t], t, strict=False))
        self.after = defaultdict(dict)
        for (a, b), k in pairs.items():
            self.after[a, 0][b] = k
        self.d1, self.d2 = (katz.discounts([sum(x == r for x in c.values()) for r in range(1, katz.K + 2)]) for c in (self.c, pairs))
        lost = sum(k * (1 - self.d1[k]) for k in self.c.values() if k <= katz.K)
        self.total = self.n if lost > 0 else self.n + 1
        self.unknown = (lost or 1) / self.total

    def one(self, w):
        k = self.c.get(w, 0)
        return (self.d1[k] if k <= katz.K else 1) * k / self.total if k else self.unknown

    def two(self, v, w):
        seen = self.after.get((v, 0))
        if not seen:
            return self.one(w)
        total = sum(seen.values()) + all(k > katz.K for k in seen.values())
        p = lambda k: (self.d2[k] if k <= katz.K else 1) * k / total
        if w in seen:
            return p(seen[w])
        return (1 - sum(map(p, seen.values()))) / (1 - sum(map(self.one, seen))) * self.one(w)


def check(got, docs, held):
    model = Plain([t for t, h in zip(docs.text, held, strict=True) if not h])
    want = []
    for (i, t), h in zip(docs[["doc_id", "text"]].itertuples(index=False), held, strict=True):
        tokens = [*words(t), None]
        base = sum(math.log10((model.c.get(w, 0) + 1) / (model.n + model.v + 1)) for w in tokens)
        score = sum(math.log10(model.two(v, w)) for v, w in zip(["<s>", *tokens], tokens, strict=False))
        want.append((None if pd.isna(i) else int(i), bool(h), len(tokens), sum(w in model.c for w in tokens), round(base, 6), round(score, 6)))
    rows = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in got]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    for a, b in zip(sorted(rows, key=key), sorted(want, key=key), strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], abs=1e-5)
    return model


@pytest.mark.parametrize("small", [False, True])
def test_scores_equal_a_plain_model(spark, monkeypatch, small):
    if small:  # many chunks, many parts, frequent first words dealt over parts
        monkeypatch.setattr(katz, "CHUNK", 60_000)
        monkeypatch.setattr(katz, "ENTRIES", 15_000)
        monkeypatch.setattr(katz, "SPLIT", 20)
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = katz.op11_lm_scoring(spark, SF).collect()
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in docs.doc_id]
    model = check(got, docs, held)
    assert {r.train_tokens for r in got} == {model.n}


def test_probabilities_add_up_to_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    scored, model = katz.fit_and_score(docs, F.expr(HELD))
    rows = docs.filter(~F.expr(HELD)).collect()
    plain = Plain([r.text for r in rows])
    assert sum(map(plain.one, plain.c)) + plain.unknown == pytest.approx(1, abs=1e-9)
    for v in ["<s>", *[w for w, _ in plain.c.most_common(4) if w], *[w for w in list(plain.c)[:40:8] if w]]:
        assert sum(plain.two(v, w) for w in plain.c) + plain.two(v, "\n") == pytest.approx(1, abs=1e-9)
    # The stored tables hold the counts.
    known = {}
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    for r in model.words.collect():
        for k, (w, n) in enumerate(zip(katz.unpack_words(r.a), katz.unpack(r.b), strict=True)):
            known[katz.FIRST + k * parts + r.part] = (w, int(n))
    assert {w or None: n for w, n in known.values()} == dict(plain.c)
    stored = {(v, w): n for r in model.pairs.collect() for v, w, n in zip(katz.unpack(r.a), katz.unpack(r.b), katz.unpack(r.c), strict=True)}
    assert sum(stored.values()) == plain.n
    weights = {r.v: r.weight for r in model.weights.collect()}
    v = next(i for i, (w, _) in known.items() if w == plain.c.most_common(1)[0][0])
    lower = model.unigrams
    seen = {w: n for (a, w), n in stored.items() if a == v}
    total = sum(katz.discounted(model.discounts, n) / sum(seen.values()) for n in seen.values())
    rest = sum(float(lower(n)) for i, (_, n) in known.items() if i not in seen) + lower.unknown
    assert total + weights[v] * rest == pytest.approx(1, abs=1e-9)


def test_edges(spark):
    rows = [(1, None, "s"), (2, "", "s"), (None, "A b\x0bC\x1cd \u0085 x", "s"), (4, "a a a a a a a a", "s"), (4, "a a a a a a a a", None), (5, "É é \n\n\t z", "s"), (6, "a b " * 3000, "s"), (19, "unseen words a", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk string")
    scored, model = katz.fit_and_score(docs, F.col("doc_id") == 19)
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "chunk"]).astype({"doc_id": "Int64"})
    check(scored.collect(), frame, [r[0] == 19 for r in rows])
    assert katz.fit_and_score(docs.limit(0), F.lit(True))[0].count() == 0
    none = katz.fit_and_score(docs, F.lit(True))[0].collect()
    assert {(r.n_known, r.base_score, r.score) for r in none} == {(0, 0.0, 0.0)}


def test_discounts_fall_back():
    assert all(0 < d <= 1 for n in ([0] * 6, [5, 0, 0, 0, 0, 0], [1, 2, 3, 4, 5, 6], [100, 40, 20, 12, 8, 5]) for d in katz.discounts(n)[1:])
    d = katz.discounts([100, 40, 20, 12, 8, 5])
    rest = 6 * 5 / 100
    assert d[1] == pytest.approx((2 * 40 / 100 - rest) / (1 - rest))
