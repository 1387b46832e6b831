from pyspark.sql import functions as F

from panelmint.operators.ranking import distributed_rank


def test_rank_equals_row_number(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        (F.xxhash64("id") % 40).alias("v"),
        "id",
    )
    order = [F.desc("v"), F.asc("id")]
    for by in ((), ("g",)):
        got = {r.id: r.rank for r in distributed_rank(rows, order, by).collect()}
        groups = {}
        for r in rows.collect():
            groups.setdefault(r.g if by else 0, []).append((-r.v, r.id))
        want = {i: k for g in groups.values() for k, (_, i) in enumerate(sorted(g), start=1)}
        assert got == want


def test_no_single_task_and_empty(spark):
    plan = distributed_rank(spark.range(100), [F.asc("id")])._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan
    assert distributed_rank(spark.range(0), [F.asc("id")]).count() == 0
