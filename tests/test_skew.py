"""One key with a third of the rows: plans must split it, results must stay whole."""

import pytest
from pyspark.sql import functions as F

from lectern.operators import conversations, relational as R, rollouts
from lectern.operators.model_stage import apply_error_policy
from lectern.plans import trending

SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@pytest.fixture
def skewed(spark):
    """Thresholds small enough for test data to count as skewed."""
    before = {k: spark.conf.get(k) for k in SPLIT_EARLY}
    for key, value in SPLIT_EARLY.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def hot(column, times=3):
    """Every third row gets the key 0."""
    return F.when(F.col("id") % times == 0, F.lit(0)).otherwise(F.col(column))


def test_ranking_with_a_hot_package_and_repository(skewed, folder):
    spark = skewed
    n = 30_000
    packages = spark.range(n).select(
        "id",
        F.concat(F.lit("p"), F.col("id")).alias("name"),
        F.lit("2024-08-01").alias("created_at"),
        F.concat(F.lit("r"), hot("id")).alias("repository"),
        F.lit("d" * 20).alias("description"),
        F.lit("doc").alias("documentation"),
        F.lit("home").alias("homepage"),
        F.lit("x" * 200).alias("readme"),
    )
    # Packages and versions have the same ids; every third edge points at package 1.
    versions = spark.range(n).select("id", F.col("id").alias("crate_id"))
    edges = spark.range(4 * n).select(
        (F.col("id") * 7 % n).alias("version_id"),
        F.when(F.col("id") % 3 == 1, F.lit(1)).otherwise(F.col("id") * 13 % n).alias("crate_id"),
    )
    for name, df in [("p", packages), ("v", versions), ("e", edges)]:
        df.repartition(8).write.parquet(f"{folder}/{name}")
    p, v, e = (spark.read.parquet(f"{folder}/{name}") for name in "pve")
    downloads = p.select(F.col("id").alias("crate_id"), F.lit(1).alias("downloads"))
    best = trending.trending_packages(p, downloads, e, v)
    plan = final_plan(best)
    assert "SortMergeJoin(skew=true) [repository" in plan, "a third of the packages in one repository"
    assert "SortMergeJoin(skew=true) [crate_id" in plan, "a third of the edges to one package"

    # Brute force on the driver.
    repo = {i: 0 if i % 3 == 0 else i for i in range(n)}
    users: dict[int, set[int]] = {}
    for i in range(4 * n):
        users.setdefault(1 if i % 3 == 1 else i * 13 % n, set()).add(i * 7 % n)
    internal = {c for c, ds in users.items() if any(repo[c] == repo[d] for d in ds)}
    wanted = sorted(((-len(users.get(i, ())), i) for i in range(n) if i not in internal))[:20]
    assert [(r.name, r.direct_dependant_count) for r in best.collect()] == [
        (f"p{i}", -c) for c, i in wanted]


def test_distinct_count_spreads_a_hot_key(skewed, folder):
    skewed.range(30_000).select(hot("id").alias("k"), F.col("id").alias("v")).write.parquet(folder)
    counted = R.distinct_count(skewed.read.parquet(folder), "k", "v", "n")
    plan = counted._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    by_key, by_pair = shuffles
    assert by_pair.count("#") > by_key.count("#"), "pairs are spread before they are counted"
    assert counted.where("k = 0").first().n == 10_000


def test_advantage_of_a_hot_task(skewed, folder):
    skewed.range(30_000).select(
        hot("id").alias("k"), (F.col("id") % 2).cast("double").alias("reward"),
        F.md5(F.col("id").cast("string")).alias("attempt"),
    ).repartition(8).write.parquet(folder)
    scored = rollouts.group_advantage(skewed.read.parquet(folder), "k")
    assert "skew=true" in final_plan(scored)
    assert scored.count() == 30_000
    got = scored.where("k = 0 and reward = 1").select(F.round("advantage", 3)).distinct().collect()
    assert [r[0] for r in got] == [1.0]


def test_long_conversation_sends_few_rows(skewed, folder):
    skewed.range(60_000).select(
        hot("id").alias("conv_id"), F.col("id").alias("turn"),
        F.lit("[no text content]").alias("text"),
    ).repartition(8).write.parquet(folder)
    events = skewed.read.parquet(folder)
    stuck = conversations.stuck_conversations(events, 1)
    assert [tuple(r) for r in stuck.collect()] == [(0, 3)]
    plan = final_plan(stuck)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    kept = conversations.until_stuck(events, 1)
    assert "SortMergeJoin(skew=true)" in final_plan(kept)
    assert kept.where("conv_id = 0").count() == 2 and kept.count() == 40_002


def test_dropping_a_group_with_many_rows(skewed, folder):
    skewed.range(30_000).select(
        F.col("id").alias("k"), hot("id").alias("g"),
        F.when(F.col("id").isin(1, 4), F.lit("e")).alias("error"),
        F.when(F.col("id").isin(1, 4), F.lit("other")).alias("error_kind"),
    ).repartition(8).write.parquet(folder)
    kept = apply_error_policy(skewed.read.parquet(folder), "drop_group", "g")
    assert "SortMergeJoin(skew=true)" in final_plan(kept)
    assert kept.count() == 30_000 - 2
