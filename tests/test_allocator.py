"""Keys of appended facts: unique over runs, retries, hot partitions and empty runs."""
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from strata.operators.allocator import BLOCK_BITS, RESERVE, TASK_BITS, KeyBlocks, append_with_keys


def keys(spark, path, run=None):
    df = spark.read.parquet(path)
    return [r[0] for r in (df.where(F.col("_pipeline_run_id") == run) if run else df).select("sk").collect()]


def test_two_runs_have_no_key_in_common(spark, scratch):
    path, blocks = scratch(), KeyBlocks(spark, scratch())
    a = append_with_keys(spark.range(10_000).repartition(7), path, "sk", blocks, "r1")
    b = append_with_keys(spark.range(20_000, numPartitions=3), path, "sk", blocks, "r2")
    found = keys(spark, path)
    assert len(found) == len(set(found)) == 30_000
    assert a["rows"] == 10_000 and a["first"] == 1 and a["last"] == max(keys(spark, path, "r1"))
    assert b["first"] == a["last"] + 1 == min(keys(spark, path, "r2"))
    assert blocks.high_water() == b["last"]


def test_a_task_larger_than_a_block(spark, scratch):
    path, blocks = scratch(), KeyBlocks(spark, scratch())
    n = 3 * (1 << BLOCK_BITS) + 5
    append_with_keys(spark.range(n, numPartitions=2).union(spark.range(n, numPartitions=1)), path, "sk", blocks, "r1")
    found = keys(spark, path)
    assert len(set(found)) == 2 * n and max(found) > 1 << (BLOCK_BITS + TASK_BITS) and max(found) < RESERVE


def test_a_repeated_run_replaces_its_rows(spark, scratch):
    path, blocks = scratch(), KeyBlocks(spark, scratch())
    append_with_keys(spark.range(100), path, "sk", blocks, "r1")
    append_with_keys(spark.range(5000, numPartitions=4), path, "sk", blocks, "r1")      # none came after it
    assert len(set(keys(spark, path))) == 5000 and len(blocks.claims()) == 1
    append_with_keys(spark.range(50), path, "sk", blocks, "r2")
    append_with_keys(spark.range(9000, numPartitions=9), path, "sk", blocks, "r1")      # r2 lies right above
    found = keys(spark, path)
    assert len(found) == len(set(found)) == 9050
    append_with_keys(spark.range(9100, numPartitions=9), path, "sk", blocks, "r1")      # and once more
    append_with_keys(spark.range(60), path, "sk", blocks, "r3")
    found = keys(spark, path)
    assert len(found) == len(set(found)) == 9210


def test_an_unfinished_run_keeps_its_reserve(spark, scratch):
    blocks = KeyBlocks(spark, scratch())
    dead = blocks.claim("dead")
    other = blocks.claim("other")
    assert other.first == dead.first + RESERVE and blocks.claim("dead") == dead
    path = scratch()
    append_with_keys(spark.range(10), path, "sk", blocks, "other")
    append_with_keys(spark.range(10), path, "sk", blocks, "dead")           # the retry comes late
    assert len(set(keys(spark, path))) == 20


def test_claims_made_together_differ(spark, scratch):
    blocks = KeyBlocks(spark, scratch())
    with ThreadPoolExecutor(6) as pool:
        claims = list(pool.map(lambda i: blocks.claim(f"r{i}"), range(12)))
    assert len({c.first for c in claims}) == len({c.number for c in claims}) == 12
    assert all(abs(a.first - b.first) >= RESERVE for a in claims for b in claims if a != b)


def test_empty_and_partitioned_runs(spark, scratch):
    path, blocks = scratch(), KeyBlocks(spark, scratch())
    got = append_with_keys(spark.range(0).withColumn("p", F.lit("a")), path, "sk", blocks, "r0")
    assert got["rows"] == 0 and blocks.high_water() == 0
    df = spark.range(30_000).withColumn("p", F.when(F.col("id") % 3 == 0, "x").otherwise("hot"))
    append_with_keys(df, path, "sk", blocks, "r1", partition_by=["p"])
    found = spark.read.parquet(f"{path}/_pipeline_run_id=r1")
    assert found.select("sk").distinct().count() == 30_000 and found.where("p = 'x'").count() == 10_000


def test_the_fact_is_not_sorted(spark, scratch):
    from strata.operators.allocator import block_key
    plan = spark.range(100).withColumn("sk", block_key(1))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_a_broken_claim_is_an_error(spark, scratch):
    blocks = KeyBlocks(spark, scratch())
    blocks.claim("a")
    out = blocks._system().create(blocks._file("claim=00000009"), False)
    out.close()
    with pytest.raises(RuntimeError):
        blocks.claim("b")
