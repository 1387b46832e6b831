import os
import re
import time

import pyarrow.parquet as pq
import pytest

from panelmint.llm.common import KEPT, WordCache, land, land_long, sieved
from pyspark.sql import functions as F


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sieve_stands_before_the_shuffle(spark, no_broadcast):
    rows = spark.range(10_000).select(F.col("id").alias("key"), F.lit("x").alias("payload"))
    wanted = spark.createDataFrame([(3,), (3,), (None,), (77,), (20_000,)], "key long")
    met = sieved(rows, wanted, "key")
    assert sorted(r.key for r in met.collect()) == [3, 77]
    # In the final plan, the branch of `rows` (a Range) meets the broadcast sieve with no exchange between them.
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    depth = {}
    for line in plan.splitlines():
        text = line.lstrip(" :+-|")
        indent = len(line) - len(text)
        depth[indent] = text
        for deeper in [d for d in depth if d > indent]:
            del depth[deeper]
        if text.startswith("Range"):
            above = [depth[d] for d in sorted(depth, reverse=True) if depth[d].startswith("Join")]
            assert "strategy=broadcast" in above[0], plan
            break
    else:
        raise AssertionError(plan)
    assert re.search(r"Join Inner, \(key", plan)


def test_word_cache_is_bounded_in_bytes():
    cache = WordCache(len, limit=1000)
    for k in range(50):
        words = {b"w%d" % k, b"x" * 300}
        assert {w: cache.learn(words)(w) for w in words} == {w: len(w) for w in words}
        assert cache.held <= 1000 + 2 * 450


def test_landing_leaves_no_shuffle_files(spark, no_broadcast):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        blocks = manager.getAllBlocks()
        return {str(blocks.apply(k)) for k in range(blocks.size()) if str(blocks.apply(k)).startswith("shuffle_")}

    held = shuffled()
    rows = spark.range(1000).withColumn("key", F.col("id") % 7)
    landed = land(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "shuffled")
    for _ in range(50):
        if not shuffled() - held:
            break
        time.sleep(0.1)
    assert not shuffled() - held
    assert spark.conf.get(name, None) == before
    assert sorted(map(tuple, landed.collect()))[:2] == [(0, 143), (1, 143)]


def test_a_cache_goes_through_what_is_asked_only_and_frees_what_others_kept():
    class Known(dict):
        def keys(self):
            raise AssertionError("all known words are gone through")

        __iter__ = keys

    KEPT["words of another operator"] = [0] * 1000
    cache = WordCache(len)
    assert not KEPT
    cache.known = Known()
    assert cache.learn({b"one", b"three"})(b"three") == 5 and cache.learn({b"one", b"to"})(b"to") == 2


def test_long_rows_leave_the_writer_a_few_at_a_time(spark):
    rows = spark.createDataFrame([(k, os.urandom(1 << 20)) for k in range(40)], "id long, data binary").coalesce(1)
    landed = land_long(rows, "long")
    assert {r.id: bytes(r.data) for r in landed.collect()} == {r.id: bytes(r.data) for r in rows.collect()}
    [path] = [p for p in landed.inputFiles() if p.endswith(".parquet")]
    groups = pq.ParquetFile(path.removeprefix("file://")).metadata
    most = max(groups.row_group(k).total_byte_size for k in range(groups.num_row_groups))
    assert groups.num_rows == 40 and most <= 20 << 20
