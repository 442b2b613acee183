"""Problems and completions derived from the part table of the test data.

The text of each column is SQL that Spark and DuckDB both read, so that both sides of a
comparison start from the same rows. Grades are known from ``idx`` and ``gen`` alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators.joins import rollout_requests
from tallymark.schemas import IMAGE

PNG_HEAD = bytes.fromhex("89504E470D0A1A0A0000000D49484452")

PROBLEM_COLUMNS = {
    "idx": "cast(p_partkey as bigint)",
    "problem": "concat('<image>Find x for ', p_name, '.')",
    "answer": r"""case p_partkey % 8
        when 0 then concat('$', p_size, '$')
        when 1 then concat(chr(92), 'frac{', 2 * p_size, '}{10}')
        when 2 then concat(p_size, chr(92), 'sqrt{3}')
        when 3 then concat('$ ', chr(92), 'sqrt{', p_size, '} $')
        when 4 then concat(p_size, chr(92), 'pi')
        when 5 then concat(chr(92), 'displaystyle ', chr(92), 'frac{', chr(92), 'sqrt{', p_size, '}}{2}')
        when 6 then p_type
        else null end""",
    "alt_answer": r"""case p_partkey % 8
        when 0 then concat(chr(92), 'frac{', 2 * p_size, '}{2}')
        when 1 then concat(chr(92), 'frac{', p_size, '}{5}')
        when 2 then concat(chr(92), 'sqrt{', 3 * p_size * p_size, '}')
        when 3 then concat(chr(92), 'frac{', chr(92), 'sqrt{', 4 * p_size, '}}{2}')
        when 4 then concat(chr(92), 'frac{', 2 * p_size, chr(92), 'pi}{2}')
        when 5 then concat(chr(92), 'sqrt{', chr(92), 'frac{', p_size, '}{4}}')
        when 6 then lower(p_type)
        else '7' end""",
    "n_images": "case when p_partkey % 17 = 0 then 0 else 1 end",
}

COMPLETION = r"""case (idx + gen) % 6
    when 0 then concat('½ steps ½', chr(10), '<answer>', coalesce(answer, 'N/A'), '</answer>')
    when 1 then concat('<answer>', alt_answer, '</answer>')
    when 2 then '½ steps ½ <answer>-1</answer>'
    when 3 then concat('½ the answer is ', coalesce(answer, 'N/A'))
    when 4 then concat('<ANSWER>', chr(10), '  ', coalesce(answer, 'N/A'), '  ', chr(10), '</Answer> <answer>-1</answer>')
    else '<answer> </answer>' end"""

# What the ground truth of a problem is, and the grades of a completion, as known by construction.
TRUTH = "coalesce(trim(trim(answer, '$')), '')"
HAS_ANSWER = "((idx + gen) % 6 <> 3)"
HAS_MARKER = "((idx + gen) % 6 in (0, 2, 3))"
IS_EXACT = "(((idx + gen) % 6 in (0, 4) and idx % 8 in (1, 2, 4, 5, 6)) or ((idx + gen) % 6 = 5 and idx % 8 = 7))"
IS_EQUIVALENT = "(((idx + gen) % 6 in (0, 1, 4) and idx % 8 <> 7) or ((idx + gen) % 6 = 5 and idx % 8 = 7))"

PROBLEMS_SQL = "select {} from part".format(", ".join(f"{sql} as {name}" for name, sql in PROBLEM_COLUMNS.items()))
COMPLETIONS_SQL = (
    f"select idx, gen, {COMPLETION} as completion, answer, alt_answer, {TRUTH} as ground_truth "
    "from problems, (select unnest(range(4)) as gen) as g"
)


def with_fixtures(sql: str) -> str:
    """A DuckDB query over the views ``problems`` and ``completions``."""
    return f"with problems as ({PROBLEMS_SQL}), completions as ({COMPLETIONS_SQL}) {sql}"


def problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``idx, problem, answer, alt_answer, n_images``, one per part."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.selectExpr(*[f"{sql} as {name}" for name, sql in PROBLEM_COLUMNS.items()])


def images_of(n_images: Column) -> Column:
    """Picture lists of the given lengths."""
    picture = F.struct(F.lit(PNG_HEAD).alias("bytes"), F.lit(None).cast("string").alias("path"))
    return F.array_repeat(picture, n_images).cast(f"array<{IMAGE.simpleString()}>")


def illustrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The problems as a source table with pictures."""
    return problems(spark, sf_dir).select("idx", "problem", "answer", images_of(F.col("n_images")).alias("images"))


def completions(spark: SparkSession, sf_dir: str, generations: int = 4) -> DataFrame:
    """``idx, gen, completion``, four per problem."""
    requests = rollout_requests(problems(spark, sf_dir), generations)
    return requests.select("idx", "gen", F.expr(COMPLETION).alias("completion"))
