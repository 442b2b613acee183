"""Joins with keys that hold a large share of the rows, positions, and group statistics."""

import pytest
from pyspark.sql import functions as F

from tallymark.functions import math_equal
from tallymark.operators import (
    distinct,
    exists_join,
    first_rows,
    group_advantage,
    hot_keys,
    join_teacher,
    join_truth,
    join_unique,
    math_equal_distinct,
    rollout_requests,
    running_total,
    stable_index,
)
from tallymark.queries import QUERIES
from tallymark.sources import scan_problems, with_positions
from tallymark.storage import materialize, shared_folder


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of 12,000 rows under one key, some without key, the rest two per key."""
    share = F.when(F.col("n") % 2 == 0, "hot").when(F.col("n") % 97 == 0, None).otherwise(F.concat(F.lit("k"), F.floor(F.col("n") / 4)))
    return spark.range(12_000, numPartitions=8).withColumnRenamed("id", "n").select(
        share.alias("id"), F.col("n").alias("gen"), (F.col("n") % 7 / 10).alias("total_reward")
    )


@pytest.fixture(scope="module")
def truth(skewed):
    return skewed.select("id").filter("id is not null").distinct().withColumn("ground_truth", F.concat(F.lit("t"), "id"))


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(value is None, str(value).zfill(9)) for value in row])


def test_hot_keys(spark, skewed):
    assert {row[0]: row[1] for row in hot_keys(skewed, "id").collect()} == {"hot": 16}
    assert hot_keys(skewed.filter("gen < 0"), "id").collect() == []
    assert hot_keys(skewed, "gen").collect() == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skewed_join_gives_what_a_plain_join_gives(skewed, truth, how):
    half = truth.filter(F.pmod(F.hash("id"), F.lit(2)) == 0).unionByName(truth.filter("id = 'hot'")).distinct()
    ours = join_unique(skewed, half, "id", ["gen"], how).select("id", "gen", "ground_truth")
    assert rows(ours) == rows(skewed.join(half, "id", how).select("id", "gen", "ground_truth"))


def test_hot_key_is_split(spark, skewed, truth):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_truth(skewed, truth).withColumn("task", F.spark_partition_id())
        tasks = joined.filter("id = 'hot'").select("task").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks >= 2


def test_doubled_truths_are_an_error(skewed, truth):
    doubled = truth.unionByName(truth.filter("id = 'hot'"))
    with pytest.raises(Exception, match="more than one ground truth row for key hot"):
        join_truth(skewed, doubled).collect()
    with pytest.raises(ValueError):
        join_unique(skewed, truth, "id", ["gen"], "full")


def test_exists(skewed):
    some = skewed.filter("id = 'hot' or id = 'k3' or id is null").select("id")
    found = exists_join(skewed, some, "id", ["gen"])
    missing = exists_join(skewed, some, "id", ["gen"], missing=True)
    assert rows(found) == rows(skewed.filter("id in ('hot', 'k3')"))
    assert rows(missing) == rows(skewed.filter("id is null or id not in ('hot', 'k3')"))


def test_teacher(spark):
    samples = spark.createDataFrame([("a",), ("b",)], "id string")
    teacher = spark.createDataFrame([("a", "worked"), ("z", "other")], "id string, completion string")
    assert rows(join_teacher(samples, teacher)) == [("a", "worked"), ("b", None)]


def test_rollouts(spark):
    prompts = spark.createDataFrame([("a",), ("b",)], "id string")
    assert rows(rollout_requests(prompts, 3)) == [(i, g) for i in "ab" for g in range(3)]
    with pytest.raises(ValueError):
        rollout_requests(prompts, 0)


def test_advantage(skewed):
    known = skewed.filter("id is not null")
    ours = {row.gen: row.advantage for row in group_advantage(known).collect()}
    assert len(ours) == known.count()
    groups = {}
    for row in known.collect():
        groups.setdefault(row.id, []).append((row.gen, row.total_reward))
    for members in groups.values():
        values = [reward for _, reward in members]
        mean = sum(values) / len(values)
        std = (sum((v - mean) ** 2 for v in values) / max(len(values) - 1, 1)) ** 0.5
        for gen, reward in members:
            expected = (reward - mean) / (std + 1e-4) if max(values) > min(values) else 0.0
            assert ours[gen] == pytest.approx(expected, abs=1e-9)
        assert sum(ours[gen] for gen, _ in members) == pytest.approx(0, abs=1e-6)


def test_advantage_of_one_and_of_equal_rewards(spark):
    scored = spark.createDataFrame([("a", 0, 1.01), ("b", 0, 0.1), ("b", 1, 0.1)], "id string, gen long, total_reward double")
    assert [row.advantage for row in group_advantage(scored).collect()] == [0.0] * 3


def test_stable_index(spark):
    keys = spark.range(5_000, numPartitions=6).select(F.md5(F.col("id").cast("string")).alias("key"), "id")
    for partitions in (1, 7):
        indexed = stable_index(keys, ["key"], partitions=partitions).orderBy("idx").collect()
        assert [row.idx for row in indexed] == list(range(5_000))
        assert [row.key for row in indexed] == sorted(row.key for row in indexed)
    assert stable_index(keys.filter("id < 0"), ["key"]).collect() == []


def test_running_total(spark):
    amounts = spark.range(100).select("id", (F.col("id") * 3).alias("n"))
    ours = {row.id: row.before for row in running_total(amounts, ["id"], "n", "before").collect()}
    assert ours == {i: sum(3 * j for j in range(i)) for i in range(100)}


def test_positions_across_files(spark):
    path = shared_folder(spark)
    spark.range(1_000, numPartitions=5).selectExpr("id", "concat('p', id) as problem").sortWithinPartitions("id").write.parquet(path)
    placed = with_positions(spark.read.parquet(path)).orderBy("idx").collect()
    assert [row.idx for row in placed] == list(range(1_000))
    assert [row.id for row in placed] == list(range(1_000))
    scanned = scan_problems(spark, path).orderBy("idx").collect()
    assert [(row.idx, row.problem, row.answer, row.images) for row in scanned[:2]] == [(0, "p0", "", []), (1, "p1", "", [])]


def test_first_rows(spark):
    df = spark.range(500, numPartitions=4).withColumnRenamed("id", "idx")
    assert rows(first_rows(df, 20, "idx")) == [(i,) for i in range(20)]
    assert first_rows(df, 0, "idx").count() == first_rows(df, None, "idx").count() == 500
    assert first_rows(df, 900, "idx").count() == 500
    with pytest.raises(ValueError):
        first_rows(df, -1, "idx")


@pytest.mark.parametrize("extra", [3, None])
def test_positions_need_a_unique_key_without_nulls(spark, extra):
    df = spark.createDataFrame([(i,) for i in range(6)] + [(extra,)], "idx long")
    for ask in (lambda: stable_index(df, ["idx"], "at").count(), lambda: first_rows(df, 2, "idx").collect()):
        with pytest.raises(Exception, match="not a unique key"):
            ask()


def test_doubled_truths_fail_whatever_is_asked_for(spark):
    many = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "id string, gen long")
    doubled = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "id string, ground_truth string")
    for ask in (
        lambda: join_truth(many, doubled).count(),
        lambda: join_truth(many, doubled).select("gen").collect(),
        lambda: join_truth(many, doubled.select("id")).count(),
        lambda: join_truth(many, doubled).collect(),
    ):
        with pytest.raises(Exception, match="more than one"):
            ask()


def test_rows_without_a_group_stay(spark):
    scored = spark.createDataFrame(
        [("a", 0, 1.0), ("a", 1, 0.0), (None, 0, 1.0), (None, 1, 0.0)], "id string, gen long, total_reward double"
    )
    out = group_advantage(scored).collect()
    assert len(out) == 4
    assert all((row.advantage is None) == (row.id is None) for row in out)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["exact_form", "math_equal_variables", "closed_value", "math_equal_functions", "same_closed_form", "sql_functions"])
def test_costly_rows_of_a_small_file_are_dealt_out(spark, tmp_path, name):
    made = [(i if i % 10 else None, i % 50 + 1, "STANDARD TIN", "blue tin") for i in range(1, 200)] * 2
    rows = spark.createDataFrame(made, "p_partkey long, p_size int, p_type string, p_name string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    # A number of partitions that was asked for is not made smaller at run time.
    assert "REPARTITION_BY_NUM" in _plan(QUERIES[name](spark, str(tmp_path)))


def test_pairs_are_combined_without_sorting_all_rows(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(distinct, "materialize", lambda df: written.append(df) or materialize(df))
    df = spark.createDataFrame([(i, "1", str(i % 3)) for i in range(60)], "i int, l string, r string")
    assert math_equal_distinct(materialize(df.coalesce(1)), "l", "r").filter("equal").count() == 20
    assert "SortAggregate" not in _plan(written[0]) and "HashAggregate" in _plan(written[0])


def test_each_distinct_pair_is_graded_once(spark):
    texts = ["1", r"\frac{2}{2}", "x+1", "1+x", None, "2", ""]
    made = [(i, texts[i % 7], texts[i // 7 % 7]) for i in range(400)] + [(i, "3!", "6") for i in range(400, 700)]
    df = spark.createDataFrame(made, "i int, l string, r string").repartition(5)
    wanted = {r.i: r.equal for r in df.select("i", math_equal(F.col("l"), F.col("r")).alias("equal")).collect()}
    found = math_equal_distinct(df, "l", "r")
    assert found.columns == ["i", "l", "r", "equal"]
    assert {r.i: r.equal for r in found.collect()} == wanted and len(wanted) == 700
