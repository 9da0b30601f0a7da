from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm.shard_tree import Shard, assign_shards, fleet, grown, shard_of


def test_slots_are_gapless_and_growth_moves_rows_into_the_new_shard_only(documents):
    found = assign_shards(documents).toPandas()
    assert (found.groupby("shard")["slot"].apply(sorted).apply(lambda s: s == list(range(len(s))))).all()
    moved = found[found["shard"] != found["grown_shard"]]
    assert set(moved["grown_shard"]) <= {40}
    assert found.sort_values(["shard", "doc_id"]).groupby("shard")["slot"].apply(lambda s: s.is_monotonic_increasing).all()


def test_only_changed_subtrees_exchange_rows(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    old = fleet(3, 2, 4)
    # one shard of region 0, rack 0 gets heavier: rows move into that region, within it into that rack,
    # and within that into the shard
    new = [Shard(s.number, s.region, s.rack, 3.0 if s.number == 1 else s.weight) for s in old]
    moves = keys.select(shard_of(F.col("k"), old).alias("a"), shard_of(F.col("k"), new).alias("b")).filter("a <> b")
    assert moves.filter("b >= 8").count() == 0
    assert moves.filter("a < 8 AND b >= 4").count() == moves.filter("a < 4 AND b <> 1").count() == 0
    assert moves.count() > 0


def test_weights_decide_the_share(spark):
    tree = [Shard(0, 0, 0, 3.0), Shard(1, 1, 0, 1.0)]
    n = spark.range(20_000).select(shard_of(F.col("id").cast("string"), tree).alias("s")).filter("s = 0").count()
    assert 0.72 < n / 20_000 < 0.78
    assert grown(tree)[-1] == Shard(2, 2, 0, 1.0)


def test_odd_rows(odd_rows, no_rows):
    found = assign_shards(odd_rows)
    assert found.count() == odd_rows.count()
    assert found.filter("doc_id IS NULL").select("shard").distinct().count() == 1
    assert found.filter("doc_id = 7").select("shard", "slot").distinct().count() == 3
    assert assign_shards(no_rows).count() == 0


def test_no_python_in_the_plan(documents):
    plan = assign_shards(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
