"""Readers on files that splits cut within every line, and on blocks of very many lines."""

import contextlib

import pytest
from pyspark.sql import functions as F

from strandwise.sources import formats as S
from strandwise.sources import splits


@contextlib.contextmanager
def split_bytes(spark, n):
    conf = {"spark.sql.files.maxPartitionBytes": str(n), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


FASTQ = ["@r1 lane/x", "ACGTACGTAC", "+", "@IIIIIIIII", "@r2", "", "+", "", "@r3 y", "AC", "+r3", "@@", "", "G", "", "+"]


@pytest.mark.parametrize("n", [7, 16, 1000])
def test_records_of_cut_files(spark, tmp_path, n):
    (tmp_path / "a.fastq").write_text("\n".join(FASTQ) + "\n")
    (tmp_path / "b.fastq").write_text("\n".join(FASTQ[4:] + ["@left over", "TT"]))
    (tmp_path / "c.fastq").write_text("")
    with split_bytes(spark, n):
        frame = S.read_fastq(spark, str(tmp_path))
        got = sorted(map(tuple, frame.collect()), key=str)
    whole = [("r1", "ACGTACGTAC", "@IIIIIIIII"), ("r2", "", ""), ("r3", "AC", "@@"), ("", "G", "+")]
    assert got == sorted([*whole, *whole[1:], ("left", "TT", None)], key=str)
    if n == 7:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan


@pytest.mark.parametrize("n", [9, 1000])
def test_blocks_of_cut_files(spark, tmp_path, n):
    (tmp_path / "a.clstr").write_text("lost line >x...\n>Cluster 0\n0\t8nt, >r1... *\n1\t8nt, >r7... at 100.00%\n\n>Cluster 1\n>Cluster 2\n0\t9nt, >r2... *\n")
    (tmp_path / "b.clstr").write_text(">Cluster 9\n0\t9nt, >r3... at 1%\n0\t9nt, >r4... at 1%\n0\t9nt, >r5... at 1%\n")
    with split_bytes(spark, n):
        rows = S.read_clstr(spark, str(tmp_path)).collect()
        order = splits.below_headers(spark, str(tmp_path / "b.clstr"), ">Cluster ").orderBy("s", "at").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([("r1", "r1"), ("r1", "r7"), ("r2", "r2"), (None, "r3"), (None, "r4"), (None, "r5")], key=str)
    assert [r.value.split(">")[1][:2] for r in order] == ["r3", "r4", "r5"]


def test_a_block_of_very_many_lines(spark, tmp_path):
    path = str(tmp_path / "large")
    members = spark.range(300_000).select(F.lit(">Cluster 5").alias("header"), F.concat(F.lit("8nt, >m"), "id", F.when(F.col("id") == 77, "... *").otherwise("... at 99%")).alias("line"))
    S.write_blocks(members, "header", "line", path)
    assert spark.read.text(path).filter(F.col("value").startswith(">Cluster")).count() == 30
    with split_bytes(spark, 1 << 20):
        got = S.read_clstr(spark, path)
        assert got.agg(F.count("*"), F.count_distinct("member_id"), F.min("rep_id"), F.max("rep_id")).first()[:] == (300_000, 300_000, "m77", "m77")
    assert S.read_fastq(spark, str(_empty(tmp_path))).count() == 0 and S.read_enzyme_dat(spark, str(_empty(tmp_path))).count() == 0


def _empty(tmp_path):
    path = tmp_path / "none.txt"
    path.write_text("")
    return path
