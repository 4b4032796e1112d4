"""The divergence audit against SQL and brute force, whitening against a numerical solver, and their edge cases."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandwise.llm import divergence, whitening

SF = "/root/testdata/sf0.001"


def brute_audit(rows, least, top=divergence.TOP):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    rows = [(lang or "", source or "", [t.encode().lower().decode() for t in term.findall(text or "")]) for lang, source, text in rows]
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, terms in rows:
        groups[lang].add(source)
        df[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        share = lambda c, kept=kept: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}
        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items[:limit])]
    return sorted(out)


def as_rows(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


def test_audit_equals_sql(spark):
    got = divergence.op12_source_divergence(spark, SF).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(divergence.OP12_SQL).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got[want.columns].astype(str).values.tolist())) == sorted(map(tuple, want.astype(str).values.tolist()))


def test_audit_of_many_sources_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [("x", f"s{k % 300}", " ".join(f"T{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}é" for i in rng.zipf(1.3, 40) % 700)) for k in range(900)]
    rows += [(None, None, "A-b\x00c Ünï a"), (None, "t", None), ("y", "only", ""), ("z", "p", "kelvin K K k"), ("z", "p", "kelvin K K k"), ("z", "q", "")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("term", F.lit(1)).withColumn("row", F.lit(2))
    for least in (1, 3):
        assert as_rows(divergence.audit(docs, least=least)) == brute_audit(rows, least)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_trees_meet_in_all_pairs_of_leaves(monkeypatch):
    monkeypatch.setattr(divergence, "PAIRS", 64)
    rng = np.random.default_rng(1)
    cells = [np.unique(rng.integers(0, divergence.SIDE, (n, 2)), axis=0).T for n in (900, 700)]
    cells[1][1, :300] %= 8
    cells[1] = np.unique(cells[1], axis=1)
    a, b = (divergence.Tree(*c) for c in cells)
    for x, y, cx, cy, same in ((a, b, *cells, False), (a, a, cells[0], cells[0], True)):
        got = sorted((int(cx[0][x.order[i]]), int(cy[0][y.order[j]]), int(cx[1][x.order[i]])) for p, q in divergence.both_leaves(x, y, same) for i, j in zip(p, q, strict=True))
        want = sorted((int(r), int(s), int(c)) for r, c in cx.T for s, d in cy.T if c == d and (not same or r < s))
        assert got == want


def whitened(df):
    pdf = df.toPandas().sort_values(["vec_id", "component"])
    return pdf, pdf.pivot(index="vec_id", columns="component", values="whitened").to_numpy()


def test_whitening_equals_a_numerical_solver(spark):
    pdf, w = whitened(whitening.op13_embedding_whitening(spark, SF))
    data = pd.read_parquet(f"{SF}/embeddings.parquet").sort_values("vec_id")
    x = np.floor(1024 * np.stack(data.embedding).astype(float)) + 100_000
    n = len(x)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    want = (x - x.mean(0)) @ vectors[:, :8] / np.sqrt(values[:8])
    for k in range(8):
        sign = np.sign(want[:, k] @ w[:, k])
        assert np.abs(want[:, k] * sign - w[:, k]).max() < 1e-7
    assert pdf.n.eq(n).all()
    assert np.allclose(pdf.explained[:8], values[:8] / values.sum(), rtol=1e-9)
    assert pdf.identity_error.nunique() == 1 and pdf.identity_error[0] < 1e-9
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, x.astype(np.int64).sum(0), strict=True)) for row in x]
    assert pdf.drop_duplicates("vec_id").deviation.tolist() == exact


def test_characteristic_polynomial_is_exact(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(-1000, 1000, (9, 5))
    m = [[int(v) for v in r] for r in a @ a.T]  # rank 5
    poly = whitening.characteristic(spark, m)
    assert poly[9] == 1 and poly[8] == -sum(m[i][i] for i in range(9)) and poly[:4] == [0] * 4
    values = np.linalg.eigvalsh(np.array(m, float))[::-1]
    roots, shift = whitening.largest_roots(poly, sum(m[i][i] for i in range(9)), 9)
    assert np.allclose([r / 2**shift for r in roots], np.maximum(values, 0), rtol=1e-9, atol=1e-6)
    assert roots[5:] == [0] * 4
    assert whitening.roots_above([-6, 11, -6, 1], 1) == 2 and whitening.roots_above([-6, 11, -6, 1], 0) == 3


def test_whitening_edges(spark):
    inf, nan = math.inf, math.nan
    rows = [(1, [1.0, 0.0, 0.0]), (2, [-1.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.0]), (4, [0.0, -1.0, 0.0]), (5, None), (6, [nan, 0.0, 1.0]), (7, [inf, 1.0, 1.0]), (8, [1.0, None, 1.0]), (9, []), (10, [5.0, 5.0]), (4, [0.0, -1.0, 0.0]), (3, [0.0, 1.0, 0.0]), (None, [0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("w", F.lit("x"))
    got = whitening.whiten(frame).collect()
    assert Counter(r.vec_id for r in got) == {1: 2, 2: 2, 3: 4, 4: 4, None: 2}
    assert {r.component for r in got} == {1, 2} and all(r.identity_error < 1e-9 for r in got)
    equal = frame.filter("vec_id < 5").groupBy("vec_id").agg(F.first("embedding").alias("embedding"))  # two equal roots
    got = whitening.whiten(equal).collect()
    assert len(got) == 8 and all(r.explained == pytest.approx(0.5, rel=1e-12) and r.identity_error < 1e-9 for r in got)
    assert whitening.whiten(frame.filter("vec_id = 1")).count() == 0
    assert whitening.whiten(frame.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [1e16, 0.0]), (2, [-1e16, 1.0])], "vec_id long, embedding array<double>")
    assert [r.deviation for r in whitening.whiten(huge).collect()] == [None, None]
