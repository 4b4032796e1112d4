"""Every registered query against the same query in SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from strandwise import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    for c in cols:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].map(lambda v: format(v, ".6g"))
    return [cols, *sorted(map(tuple, df[cols].astype(str).values.tolist()))]


def test_queries_without_sql():
    """These are too slow in SQL; their operators are tested against plain loops."""
    assert set(registry.queries()) - set(registry.oracle_sql()) == {"merge_mates"}


def test_merged_mates_of_whole_texts(spark):
    got = registry.queries()["merge_mates"](spark, SF).toPandas()
    reads = spark.read.parquet(f"{SF}/documents.parquet").count()
    merged = got[got.part == "merged"]
    assert len(merged) + (got.part == "pair_1").sum() == reads and (got.part == "pair_1").sum() == (got.part == "pair_2").sum()
    assert len(merged) > 0.8 * reads and merged.mismatches.max() >= 2


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF).toPandas()
    assert len(got)
    assert rows(got) == rows(duck.execute(registry.oracle_sql()[name]).df())
