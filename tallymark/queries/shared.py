"""Tables and SQL texts that several queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.fixed import GENERATIONS, MOCK_COMPLETION, WHITESPACE
from tallymark.fixtures import COMPLETION, TRUTH, illustrated, problems
from tallymark.functions.latex import clean_ground_truth
from tallymark.operators.joins import rollout_requests
from tallymark.operators.samples import sample_id, split_rl
from tallymark.operators.skew import dealt
from tallymark.plans.prepare import classify, prepare_rl, prepare_sft

DATA_DIR = "data"
# Problems of the first split: fewer than by default, so that the smallest test tables have both.
SPLIT = 100
MODEL = "output/tuned/"
RUN = "tuned"

WHITESPACE_SQL = f"'{WHITESPACE}'"

SFT_ID_SQL = "printf('sft_%05d', idx)"
RL_ID_SQL = f"printf('rl_%05d', idx - {SPLIT})"
ID_SQL = f"case when idx < {SPLIT} then {SFT_ID_SQL} else {RL_ID_SQL} end"
SPLIT_SQL = f"case when idx < {SPLIT} then 'sft' else 'rl' end"
IMAGE_SQL = f"concat('{DATA_DIR}/images/', {SPLIT_SQL}, '/', {ID_SQL}, '.png')"
PROMPT_SQL = "replace(problem, '<image>', '')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def template_sql(template: str, **columns: str) -> str:
    """A filled text template as SQL."""
    sql = _quoted(template)
    for name, column in columns.items():
        sql = f"replace({sql}, '{{{name}}}', {column})"
    return sql


MOCK_SQL = template_sql(
    MOCK_COMPLETION, question="problem", answer=f"case when answer is null then 'N/A' else {TRUTH} end"
)

EXTRACTED_SQL = (
    "case when regexp_matches(completion, '(?is)<answer>.*?</answer>') "
    r"then trim(regexp_extract(completion, '(?is)<answer>(.*?)</answer>', 1), concat(' ', chr(10))) end"
)

RL_SAMPLES_SQL = (
    f"select {RL_ID_SQL} as id, {IMAGE_SQL} as image, problem as prompt, {TRUTH} as ground_truth, "
    f"answer as raw_answer from problems where idx >= {SPLIT} and n_images > 0"
)

TEACHER_COLUMNS = {
    "status_code": "case when idx % 3 = 0 then 200 when idx % 3 = 1 then 429 else 500 end",
    "completion": "case when idx % 3 = 0 then concat('½ taught ½ <answer>', coalesce(answer, 'none'), '</answer>') end",
}


def truths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``idx, ground_truth`` of all problems."""
    return problems(spark, sf_dir).select("idx", clean_ground_truth(F.col("answer")).alias("ground_truth"))


def paired(spark: SparkSession, sf_dir: str, generations: int = GENERATIONS) -> DataFrame:
    """Completions next to their problem's columns, made row by row without a join."""
    requests = rollout_requests(dealt(problems(spark, sf_dir), "idx"), generations)
    return requests.select(
        "*", F.expr(COMPLETION).alias("completion"), clean_ground_truth(F.col("answer")).alias("ground_truth")
    )


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(illustrated(spark, sf_dir), count=SPLIT, data_dir=DATA_DIR)


def sft_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_sft(illustrated(spark, sf_dir), count=SPLIT, data_dir=DATA_DIR)


def rl_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_rl(illustrated(spark, sf_dir), count=SPLIT, data_dir=DATA_DIR)


def teacher_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A teacher that answers every third problem of the first split."""
    return problems(spark, sf_dir).select(
        sample_id(F.col("idx"), SPLIT).alias("id"),
        F.expr(TEACHER_COLUMNS["status_code"]).alias("status_code"),
        F.expr(TEACHER_COLUMNS["completion"]).alias("completion"),
    )


def predictions(spark: SparkSession, sf_dir: str, gen: int = 0) -> DataFrame:
    """One generation per problem of the second split; every other one repeats its prompt."""
    prompt = F.concat(F.lit("user: "), F.col("problem"), F.lit("\nassistant: "))
    first = split_rl(paired(spark, sf_dir, generations=gen + 1).filter(F.col("gen") == gen), SPLIT)
    repeated = F.concat(prompt, F.col("completion"))
    return first.select(
        sample_id(F.col("idx"), SPLIT).alias("id"),
        prompt.alias("prompt_text"),
        F.when(F.col("idx") % 2 == 0, repeated).otherwise(F.col("completion")).alias("generated"),
    )


# Graded predictions in SQL: the second split, samples with a picture, all generations or the first.
ALL_GRADED_SQL = (
    f"select {RL_ID_SQL} as id, idx, gen, completion, {EXTRACTED_SQL} as predicted_answer, c.ground_truth "
    f"from completions c join problems p using (idx) where idx >= {SPLIT} and n_images > 0"
)
GRADED_SQL = f"{ALL_GRADED_SQL} and gen = 0"
