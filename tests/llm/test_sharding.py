from collections import Counter

from pyspark.sql import functions as F

from rainledger.llm import sharding
from rainledger.llm.queries import op9_sharding
from tests.helpers import plan
from tests.llm import brute

COLUMNS = ("doc_id", "size", "text_crc32", "law", "shard", "grown_shard")


def test_contract(spark, tables):
    folder, docs = tables
    rows = op9_sharding(spark, folder).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in rows) == Counter(brute.op9(docs))
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_empty(spark, empty_tables):
    assert op9_sharding(spark, empty_tables).collect() == []


def test_no_python_and_no_group_in_one_task(spark, tables):
    text = plan(op9_sharding(spark, tables[0]))
    assert "Python" not in text and "Arrow" not in text and "SinglePartition" not in text


def test_jump_hash_equals_the_published_algorithm(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 123456789, *range(-50, 500, 7), None]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for shards in (1, 2, 9, 200):
        rows = df.select("k", sharding.jump_hash(F.col("k"), shards).alias("s")).collect()
        assert all(r.s == brute.jump(r.k or 0, shards) for r in rows)


def test_growing_moves_rows_only_into_the_new_shard(spark):
    df = spark.range(20_000).select(sharding.jump_hash(F.col("id"), 8).alias("a"), sharding.jump_hash(F.col("id"), 9).alias("b"))
    moved = df.where("a <> b")
    assert moved.where("b <> 8").count() == 0
    assert abs(moved.count() - 20_000 / 9) < 250


def test_hot_key_clashing_names_and_repeated_rows(spark):
    df = spark.range(3000).select(F.lit(None).cast("bigint").alias("k"), F.lit("x").alias("slot"), F.col("id").alias("bucket"), F.lit(1).alias("First"))
    df = df.unionAll(df.limit(5))
    out = sharding.shard_table(df, "k", 4)
    rows = out.collect()
    assert {r.shard for r in rows} == {brute.jump(0, 4)}
    assert sorted(r.slot for r in rows) == list(range(3005))
    assert set(out.columns) == {"k", "bucket", "First", "shard", "grown_shard", "slot"}
