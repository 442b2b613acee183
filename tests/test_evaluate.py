"""Scoring pipelines, reports, streams and SQL names."""

import json
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tallymark import evaluate, grade_rollouts, register_sql_functions
from tallymark.functions import DEFAULT_REWARDS, Reward, apply_rewards
from tallymark.plans import evaluate_by_run, grade_all, score_rollouts, ungraded
from tallymark.schemas import COMPLETION, PREDICTION
from tallymark.storage import materialize, shared_folder
from tallymark.streaming import score_stream

COMPLETIONS = [
    ("p1", 0, "½ so ½ <answer>0.5</answer>"),
    ("p1", 1, "<answer>2</answer>"),
    ("p1", 2, "no block ½"),
    ("p1", 3, None),
    ("p2", 0, "<answer>yes</answer>"),
    ("p2", 1, "<answer>Yes</answer>"),
    ("nobody", 0, "<answer>1</answer>"),
]
TRUTHS = [("p1", r"\frac{1}{2}"), ("p2", "Yes"), ("p3", "3")]


@pytest.fixture(scope="module")
def completions(spark):
    return spark.createDataFrame(COMPLETIONS, COMPLETION)


@pytest.fixture(scope="module")
def truths(spark):
    return spark.createDataFrame(TRUTHS, "id string, ground_truth string")


def test_rollouts(completions, truths):
    rows = {(row.id, row.gen): row for row in grade_rollouts(completions, truths).collect()}
    assert set(rows) == {("p1", 0), ("p1", 1), ("p1", 2), ("p1", 3), ("p2", 0), ("p2", 1)}
    assert [rows["p1", g].accuracy_reward for g in range(4)] == [1.0, 0.0, 0.0, 0.0]
    assert [rows["p1", g].format_reward for g in range(4)] == [0.1, 0.05, 0.05, 0.0]
    assert rows["p1", 0].total_reward == 1.0 * 1.0 + 0.1 * 0.1
    assert sum(rows["p1", g].advantage for g in range(4)) == pytest.approx(0)
    assert rows["p2", 0].advantage == rows["p2", 1].advantage == 0.0


def test_own_rewards(completions, truths):
    @pandas_udf("double")
    def shortness(text: pd.Series) -> pd.Series:
        return 1.0 / (1.0 + text.fillna("").str.len())

    own = Reward("shortness", 2.0, lambda kept, truth: kept, of_completion=shortness)
    same = Reward("same_text", 1.0, lambda text, truth: F.when(text.contains(truth), 1.0).otherwise(0.0))
    rows = {(r.id, r.gen): r for r in score_rollouts(completions, truths, (*DEFAULT_REWARDS, own, same)).collect()}
    row = rows["p2", 1]
    assert row.shortness == 1 / 21 and row.same_text == 1.0
    assert row.total_reward == pytest.approx(1.0 + 0.1 * 0.05 + 2 / 21 + 1.0)
    with pytest.raises(ValueError):
        score_rollouts(completions, truths, (own, own))


def test_joined_and_side_by_side_scores_agree(completions, truths):
    together = apply_rewards(completions.join(truths, "id")).select("id", "gen", "total_reward")
    apart = score_rollouts(completions, truths).select("id", "gen", "total_reward")
    assert sorted(together.collect()) == sorted(apart.collect())


def test_messages_score_like_texts(completions, truths):
    spoken = F.array(
        F.struct(F.lit("user").alias("role"), F.lit("").alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col("completion").alias("content")),
    )
    by_message = score_rollouts(completions.withColumn("completion", spoken), truths)
    assert sorted(by_message.collect()) == sorted(score_rollouts(completions, truths).collect())


def test_answers_without_truth(spark, completions):
    truths = spark.createDataFrame([("p1", "2"), ("p2", None)], "id string, ground_truth string")
    graded = grade_rollouts(completions, truths)
    assert sorted((row.id, row.gen) for row in ungraded(graded).collect()) == [("p2", 0), ("p2", 1)]
    assert {row.advantage for row in graded.filter("id = 'p2'").collect()} == {None}


def dataset(spark):
    rows = [("rl_00000", "5"), ("rl_00002", r"\frac{1}{2}"), ("rl_99999", "7"), ("rl_100000", None), ("rl_100001", "9")]
    return spark.createDataFrame(rows, "id string, ground_truth string")


def predictions(spark):
    rows = [
        ("rl_00000", "ask", "ask <answer> 5 </answer>"),
        ("rl_00002", "ask", "<answer>0.5</answer>"),
        ("rl_99999", "ask", "ask seven"),
        ("rl_100000", "ask", "<answer>1</answer>"),
        ("rl_777", "ask", "<answer>1</answer>"),
    ]
    return spark.createDataFrame(rows, PREDICTION)


def test_report(spark):
    done = evaluate(dataset(spark), predictions(spark), "out/run-1/", max_samples=0)
    assert done.report.first().asDict() == {
        "model_name_or_path": "out/run-1/",
        "num_samples": 3,
        "format_rate": 2 / 3,
        "exact_match": 1 / 3,
        "symbolic_accuracy": 2 / 3,
    }
    samples = {row.id: row for row in done.samples.collect()}
    assert samples["rl_00000"].prediction == "<answer> 5 </answer>" and samples["rl_00000"].predicted_answer == "5"
    assert samples["rl_99999"].prediction == "seven" and samples["rl_99999"].predicted_answer is None
    assert sorted(tuple(row) for row in done.rejects.collect()) == [("rl_100000", "no_ground_truth"), ("rl_100001", "no_prediction")]
    folder = shared_folder(spark)
    path = done.write(folder)
    assert path.endswith("/eval_run-1.json")
    line = json.loads(next(Path(path).glob("*.json")).read_text())
    assert line["num_samples"] == 3 and list(line)[0] == "model_name_or_path"
    assert {row.run_name for row in spark.read.parquet(f"{folder}/samples").collect()} == {"run-1"}


def test_first_samples_are_first_by_number(spark):
    done = evaluate(dataset(spark), predictions(spark), "m", max_samples=3)
    assert {row.id for row in done.samples.collect()} == {"rl_00000", "rl_00002", "rl_99999"}


def test_empty_report(spark):
    done = evaluate(dataset(spark), predictions(spark).limit(0), "m")
    assert done.report.first().asDict() == {
        "model_name_or_path": "m",
        "num_samples": 0,
        "format_rate": 0.0,
        "exact_match": 0.0,
        "symbolic_accuracy": 0.0,
    }


def test_stream_gives_what_the_batch_gives(spark, completions, truths):
    folder = shared_folder(spark)
    completions.repartition(3, "gen").write.json(f"{folder}/in")

    def run():
        score_stream(spark, f"{folder}/in", truths, f"{folder}/out", f"{folder}/state", files_per_batch=1).awaitTermination()
        return sorted(spark.read.parquet(f"{folder}/out").drop("batch").collect())

    batch = sorted(score_rollouts(completions, truths).collect())
    assert run() == batch
    # A second run sees only what is new.
    spark.createDataFrame([("p3", 0, "<answer>3</answer>")], COMPLETION).write.mode("append").json(f"{folder}/in")
    rows = run()
    assert len(rows) == len(batch) + 1 and ("p3", 0, 1.0) in {(r.id, r.gen, r.accuracy_reward) for r in rows}


def test_stream_accounts_for_every_line(spark, truths):
    folder = shared_folder(spark)
    lines = [
        '{"id": "p3", "gen": 0, "completion": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "<answer>3</answer>"}]}',
        '{"id": "p3", "gen": 1, "completion": [{"role": "assistant", "content": "<answ',
        '{"id": "nobody", "gen": 2, "completion": [{"role": "assistant", "content": "<answer>3</answer>"}]}',
        "",
    ]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(f"{folder}/in")
    schema = T.StructType.fromDDL("id string, gen long, completion array<struct<role: string, content: string>>")
    score_stream(spark, f"{folder}/in", truths, f"{folder}/out", f"{folder}/state", schema=schema).awaitTermination()
    assert [(r.id, r.gen, r.accuracy_reward) for r in spark.read.parquet(f"{folder}/out").collect()] == [("p3", 0, 1.0)]
    rejected = spark.read.parquet(f"{folder}/out_rejects").drop("batch").collect()
    assert sorted((r.reason, r.id, r.gen, r.line) for r in rejected if r.id) == [("no_problem", "nobody", 2, None)]
    assert sorted(r.line for r in rejected if not r.id) == sorted([lines[1], lines[3]])


def test_unmatched_pairs_are_rejects(spark, completions, truths):
    done = grade_all(completions, truths)
    assert [tuple(row) for row in done.rejects.collect()] == [("nobody", 0, "no_problem")]
    assert done.graded.count() == completions.count() - 1
    graded = evaluate(dataset(spark), predictions(spark).filter("id != 'rl_00000'"), "m", max_samples=0)
    assert ("rl_00000", "no_prediction") in {tuple(row) for row in graded.rejects.collect()}


def test_sql_names(spark):
    names = register_sql_functions(spark, "tm_")
    assert "tm_extract_answer" in names
    row = spark.sql(
        r"""select tm_extract_answer('a <ANSWER> 5 </answer>') a, tm_extract_answer('none') b, tm_extract_answer('<answer></answer>') c,
        tm_normalize_latex(r'$ \displaystyle  x \\ y $') d, tm_format_reward('½ <answer></answer>') e, tm_format_reward(null) f,
        tm_has_answer(null) g, tm_clean_ground_truth(' $5$') h, tm_strip_image_tag('<image> q') i, tm_strip_image_tag(' <image> ') j,
        tm_run_name('a/b//') k, tm_clean_ground_truth(null) l"""
    ).first()
    assert tuple(row) == ("5", None, "", "x \\ y", 0.1, 0.0, False, "$5", "q", "<image>", "b", "")


class Session:
    """Settings of a session that was never started."""

    def __init__(self, checkpoint_dir=None, **settings):
        self.settings = {key.replace("_", "."): value for key, value in settings.items()}
        self.conf = self.sparkContext = self
        self.setCheckpointDir(checkpoint_dir)

    def setCheckpointDir(self, folder):
        self.folder = folder

    def getCheckpointDir(self):
        return self.folder

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_intermediate_tables_go_to_the_set_folder(spark):
    folder = shared_folder(Session(spark_checkpoint_dir="hdfs://shared/x/", spark_master="yarn"))
    assert folder.startswith("hdfs://shared/x/tallymark-")
    assert shared_folder(Session("hdfs://other", spark_master="yarn")).startswith("hdfs://other/tallymark-")
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_folder(Session(spark_master=master))
    assert "tallymark-" in shared_folder(Session(spark_master="local[8]"))
    assert materialize(spark.range(3)).count() == 3


def test_all_runs_in_one_pass(spark):
    truths = spark.createDataFrame([(f"t{i}", str(i)) for i in range(12)] + [("none", None)], "id string, ground_truth string")
    rows = [(f"run{r}", f"t{i}", "q", f"<answer>{i + (i + r) % 3 % 2}</answer>") for r in range(3) for i in range(12)]
    rows += [("run0", "none", "q", "<answer>1</answer>"), ("run0", "none else", "q", "x"), ("run1", "none", "q", "no answer")]
    schema = "run string, id string, prompt_text string, generated string"
    found = evaluate_by_run(truths, spark.createDataFrame(rows, schema))
    report = {r.run: r for r in found.report.collect()}
    for run in range(3):
        right = sum((i + run) % 3 % 2 == 0 for i in range(12))
        assert report[f"run{run}"].num_samples == 12 + (run == 1)
        assert round(report[f"run{run}"].symbolic_accuracy * report[f"run{run}"].num_samples) == right
    assert found.samples.count() == 37
    assert sorted((r.run, r.id, r.reason) for r in found.rejects.collect()) == [("run0", "none", "no_ground_truth"), ("run0", "none else", "no_example")]
    with pytest.raises(Exception, match="more than one prediction"):
        evaluate_by_run(truths, spark.createDataFrame(rows + rows[:1], schema)).report.collect()
