"""Text functions, equivalence, rewards, reports and streams."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.fixed import EVAL_SAMPLES, GENERATIONS
from tallymark.fixtures import (
    HAS_ANSWER,
    HAS_MARKER,
    IS_EQUIVALENT,
    IS_EXACT,
    completions,
    illustrated,
    problems,
)
from tallymark.functions import (
    DEFAULT_REWARDS,
    Reward,
    accuracy_reward,
    apply_rewards,
    closed_form,
    closed_value,
    completion_text,
    compute_reward,
    exact_equal,
    extract_answer,
    format_reward,
    has_answer,
    latex_to_expr,
    math_equal,
    normalize_latex,
    register_sql_functions,
    register_sql_table_functions,
    report_name,
    run_name,
    same_closed_form,
    strip_image_tag,
    strip_prompt_prefix,
    text_chunks,
    text_messages,
    text_plain,
    text_variant,
)
from tallymark.operators import (
    eval_report,
    eval_row,
    first_rows,
    format_rate,
    grade,
    group_advantage,
    join_predictions,
    join_truth,
    math_equal_distinct,
    num_samples,
    predicted_answers,
    rate,
)
from tallymark.operators.samples import sample_id
from tallymark.operators.skew import dealt
from tallymark.plans import evaluate, evaluate_by_run, grade_rollouts, graded_predictions, prepare_rl, score_round, store_truths
from tallymark.queries.registry import query
from tallymark.queries.shared import (
    ALL_GRADED_SQL,
    DATA_DIR,
    EXTRACTED_SQL,
    GRADED_SQL,
    MODEL,
    PROMPT_SQL,
    RL_ID_SQL,
    RUN,
    SPLIT,
    WHITESPACE_SQL,
    paired,
    predictions,
    rl_samples,
    truths,
)
from tallymark.schemas import COMPLETION
from tallymark.sources import write_eval_samples, write_report
from tallymark.storage import materialize, remove, shared_folder
from tallymark.streaming import advantage_stream, report_stream, running_report, score_stream

# --- payloads ------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")


def _digest(name: str, column) -> list:
    """Long texts by their digest and length, for comparison."""
    return [F.md5(column).alias(f"{name}_md5"), F.length(column).cast("long").alias(f"{name}_chars")]


def _digest_sql(name: str, sql: str) -> str:
    return f"md5({sql}) as {name}_md5, length({sql}) as {name}_chars"


def _message(role: str, content):
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _chunk(kind: str, text):
    return F.struct(F.lit(kind).alias("type"), text.alias("text"))


def _messages():
    return F.array(
        _message("system", F.col("source")),
        _message("user", F.lit("")),
        _message("tool", F.lit(None).cast("string")),
        _message("assistant", F.col("text")),
    )


def _typed_messages():
    return F.array(
        _message("user", F.array(_chunk("image", F.lit("picture")), _chunk("text", F.col("source")))),
        _message("assistant", F.array(_chunk("text", F.lit("")), _chunk("text", F.col("text")))),
    )


_JOINED_SQL = "concat(source, chr(10), text)"


@query("text_plain", f"select doc_id, {_digest_sql('text', 'text')} from documents", on_fixtures=False)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", *_digest("text", text_plain(F.col("text"))))


@query("text_messages", f"select doc_id, {_digest_sql('text', _JOINED_SQL)} from documents", on_fixtures=False)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", *_digest("text", text_messages(_messages())))


@query("text_chunks", f"select doc_id, {_digest_sql('text', _JOINED_SQL)} from documents", on_fixtures=False)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", *_digest("text", text_chunks(_typed_messages())))


_VARIANT_SQL = f"case when doc_id % 4 in (1, 2) then {_JOINED_SQL} else text end"


@query("text_variant", f"select doc_id, {_digest_sql('text', _VARIANT_SQL)} from documents", on_fixtures=False)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text: alone, in messages, in typed chunks, and among items that are no messages."""
    shape = F.col("doc_id") % 4
    said = F.to_json(F.struct(F.col("text").alias("content")))
    payload = (
        F.when(shape == 0, F.regexp_extract(F.to_json(F.struct(F.col("text").alias("t"))), r"(?s)^\{\"t\":(.*)\}$", 1))
        .when(shape == 1, F.to_json(_messages()))
        .when(shape == 2, F.to_json(_typed_messages()))
        .otherwise(F.concat(F.lit('["loose", 5, null, {"role": "x"}, '), said, F.lit("]")))
    )
    return _documents(spark, sf_dir).select("doc_id", *_digest("text", text_variant(F.parse_json(payload))))


@query("completion_text", f"select idx, gen, {EXTRACTED_SQL} as messages, {EXTRACTED_SQL} as chunks, {EXTRACTED_SQL} as mixed, {EXTRACTED_SQL} as maps, null::varchar as loose from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("completion")
    rows = completions(spark, sf_dir).select(
        "idx",
        "gen",
        F.array(_message("system", F.lit("")), _message("assistant", text)).alias("messages"),
        F.array(_message("assistant", F.array(_chunk("image", F.lit("none")), _chunk("text", text)))).alias("chunks"),
        F.parse_json(F.to_json(F.array(_message("assistant", text)))).alias("mixed"),
        F.array(F.create_map(F.lit("role"), F.lit("user")), F.create_map(F.lit("role"), F.lit("a"), F.lit("content"), text)).alias("maps"),
        F.array(text).alias("loose"),
    )
    texts = {name: extract_answer(completion_text(rows, name)) for name in ("messages", "chunks", "mixed", "maps", "loose")}
    return rows.withColumns(texts)


# --- text functions ------------------------------------------------------------


@query("extract_answer", f"select idx, gen, {EXTRACTED_SQL} as predicted_answer from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = extract_answer(F.col("completion")).alias("predicted_answer")
    return completions(spark, sf_dir).select("idx", "gen", extracted)


@query(
    "extract_answer_documents",
    f"select doc_id, {_digest_sql('answer', f'trim(text, {WHITESPACE_SQL})')} from documents",
    on_fixtures=False,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = F.concat(F.lit("½ worked ½ <Answer>\n"), "text", F.lit(" </ANSWER>"), "text", F.lit("<answer>0</answer>"))
    return _documents(spark, sf_dir).select("doc_id", *_digest("answer", extract_answer(wrapped)))


_NORMAL_SQL = (
    f"replace(trim(regexp_replace(replace(trim(trim(answer, '$'), {WHITESPACE_SQL}), '\\displaystyle', ''), "
    f"'[{WHITESPACE_SQL[1:-1]}]+', ' ', 'g'), ' '), '\\\\', '\\')"
)


@query("normalize_latex", f"select idx, {_NORMAL_SQL} as text from problems")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return problems(spark, sf_dir).select("idx", normalize_latex(F.col("answer")).alias("text"))


@query(
    "normalize_latex_documents",
    f"select doc_id, {_digest_sql('text', _NORMAL_SQL)} from (select doc_id, concat('$$', text, ' \\\\displaystyle $') as answer "
    "from documents)",
    on_fixtures=False,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = F.concat(F.lit("$$"), "text", F.lit(" \\\\displaystyle $"))
    return _documents(spark, sf_dir).select("doc_id", *_digest("text", normalize_latex(wrapped)))


def _expr_sql(column: str) -> str:
    sql = _NORMAL_SQL.replace("answer", column)
    for _ in range(3):
        sql = f"regexp_replace({sql}, '\\\\frac\\{{([^{{}}]+)\\}}\\{{([^{{}}]+)\\}}', '((\\1)/(\\2))', 'g')"
        sql = f"regexp_replace({sql}, '\\\\sqrt\\{{([^{{}}]+)\\}}', 'sqrt(\\1)', 'g')"
    for old, new in (("{", "("), ("}", ")"), ("^", "**"), ("\\cdot", "*"), ("\\times", "*"), ("\\pi", "pi")):
        sql = f"replace({sql}, '{old}', '{new}')"
    return sql


@query(
    "latex_to_expr",
    f"select idx, {_expr_sql('answer')} as expr, {_expr_sql('alt_answer')} as alt_expr from problems",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return problems(spark, sf_dir).select(
        "idx", latex_to_expr(F.col("answer")).alias("expr"), latex_to_expr(F.col("alt_answer")).alias("alt_expr")
    )


@query("strip_image_tag", f"select idx, {PROMPT_SQL} as prompt, '<image>' as bare from problems")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = F.concat(F.lit(" <IMAGE>\n "), "problem", F.lit("<image>  "))
    return problems(spark, sf_dir).select(
        "idx", strip_image_tag(tagged).alias("prompt"), strip_image_tag(F.lit(" <image> ")).alias("bare")
    )


@query("strip_prompt_prefix", "select idx, gen, trim(completion, concat(' ', chr(10))) as prediction from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = paired(spark, sf_dir)
    generated = F.when(F.col("gen") % 2 == 0, F.concat("problem", F.lit(" \n"), "completion")).otherwise(F.col("completion"))
    return rows.select("idx", "gen", strip_prompt_prefix(generated, F.col("problem")).alias("prediction"))


@query("has_answer", f"select idx, gen, {HAS_ANSWER} as has_answer from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completions(spark, sf_dir).select("idx", "gen", has_answer(F.col("completion")).alias("has_answer"))


@query("exact_equal", f"select idx, gen, case when {HAS_ANSWER} then {IS_EXACT} end as is_exact from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    equal = exact_equal(extract_answer(F.col("completion")), F.col("ground_truth"))
    return paired(spark, sf_dir).select("idx", "gen", equal.alias("is_exact"))


@query(
    "run_name",
    "select idx, concat('model-', idx) as run, concat('eval_model-', idx, '.json') as report from problems",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("output/runs/model-"), F.col("idx").cast("string"), F.expr("repeat('/', int(idx % 3))"))
    return problems(spark, sf_dir).select("idx", run_name(path).alias("run"), report_name(path).alias("report"))


# --- values and equivalence ----------------------------------------------------

_SIZE_SQL = "(select p_partkey, p_size::bigint as s, p_partkey % 8 as k from part)"


@query(
    "closed_form",
    f"""select p_partkey as idx, 1 as sign, (num // gcd(num, den))::varchar as num, (den // gcd(num, den))::varchar as den,
        case k when 4 then 1 else 0 end as pi_power
        from (select *, case k when 0 then s * s when 1 then s * s when 2 then 3 * s * s when 3 then s when 4 then s * s
                else s end as num, case k when 1 then 25 when 5 then 4 else 1 end as den from {_SIZE_SQL}) where k < 6
        union all select p_partkey, null, null, null, null from {_SIZE_SQL} where k >= 6""",
    on_fixtures=False,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = dealt(problems(spark, sf_dir), "idx").select("idx", closed_form(F.col("answer")).alias("key"))
    return keys.select(
        "idx",
        F.col("key.sign").alias("sign"),
        F.col("key.num").cast("string").alias("num"),
        F.col("key.den").cast("string").alias("den"),
        F.col("key.pi_power").alias("pi_power"),
    )


@query("same_closed_form", "select idx, idx % 8 < 6 as same from problems")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    same = same_closed_form(F.col("answer"), F.col("alt_answer"))
    return dealt(problems(spark, sf_dir), "idx").select("idx", same.alias("same"))


@query(
    "closed_value",
    """select p_partkey as idx, round((p_size + sqrt(5)) / 2, 6) as golden, round(p_size * pi() / 3 - sqrt(p_size), 6) as arc,
        round(power(p_size, 2) - 1 / (2 * sqrt(3)), 6) as height, null::double as text from part""",
    on_fixtures=False,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    def value(template: str, name: str):
        pieces = [F.lit(piece) for piece in template.split("SIZE")]
        parts = [pieces[0]]
        for piece in pieces[1:]:
            parts += [F.col("p_size").cast("string"), piece]
        return F.round(closed_value(F.concat(*parts)), 6).alias(name)

    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size")
    return dealt(part, *part.columns).select(
        F.col("p_partkey").alias("idx"),
        value(r"\frac{SIZE+\sqrt{5}}{2}", "golden"),
        value(r"$\frac{SIZE\pi}{3} - \sqrt{ SIZE }$", "arc"),
        value(r"SIZE^{2}-\dfrac{1}{2 \cdot \sqrt{3}}", "height"),
        value(r"SIZE cm", "text"),
    )


@query("math_equal", f"select idx, gen, case when {HAS_ANSWER} then {IS_EQUIVALENT} end as is_equivalent from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    equal = math_equal(extract_answer(F.col("completion")), F.col("ground_truth"))
    return paired(spark, sf_dir).select("idx", "gen", equal.alias("is_equivalent"))


def _filled(template: str):
    """A template with the size of a part in place of N."""
    first, *rest = [F.lit(piece) for piece in template.split("N")]
    return F.concat(first, *[part for piece in rest for part in (F.col("p_size").cast("string"), piece)])


# Equal texts, and one that is near but differs.
_SUMS = (
    (r"N(1+\sqrt{2})", r"N+N\sqrt{2}", r"N+\sqrt{2}+1"),
    ("2*(N+4)", r"\frac{4*N+16}{2}", "2*N+4"),
    (r"\frac{N+\sqrt{5}}{2}+3", r"\frac{N+6+\sqrt{5}}{2}", r"\frac{N+3+\sqrt{5}}{2}"),
    ("(N+1)^2-1", "N^2+2*N", "N^2+2*N+1"),
)
_NESTED = (
    (r"\sqrt{\frac{\sqrt{N}}{2}}", r"(N/4)^{\frac{1}{4}}", r"\sqrt{\frac{N}{2}}+1"),
    (r"\frac{\frac{\frac{N}{2}}{3}}{4}", r"\frac{N}{24}", r"\frac{N}{25}"),
    (r"\left(\frac{N}{1+\frac{1}{N}}\right)^{2^1}", r"(\frac{N*N}{N+1})^2", r"\frac{N*N}{N+1}+1"),
    (r"\sqrt{\pi^2}(N-(1-(2-N)))", r"\pi", r"\pi^2"),
)


def _agreements(spark: SparkSession, sf_dir: str, cases) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size")
    rows = part.select(
        F.col("p_partkey").alias("idx"),
        F.posexplode(F.array(*[F.struct(*[_filled(t).alias(n) for t, n in zip(case, "abc")]) for case in cases])).alias("nth", "t"),
    )
    # A row costs far more to grade than its bytes suggest: rows are dealt out before that.
    rows = dealt(rows, "idx", "nth")
    a, b, c = (F.col(f"t.{name}") for name in "abc")
    same, swapped = math_equal(a, b).alias("same"), math_equal(b, a).alias("swapped")
    return rows.select("idx", F.col("nth").cast("long").alias("nth"), same, swapped, math_equal(a, c).alias("near"))


_AGREE_SQL = "select p_partkey as idx, unnest(range(4)) as nth, true as same, true as swapped, false as near from part"


@query("math_equal_sums", _AGREE_SQL, on_fixtures=False)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _agreements(spark, sf_dir, _SUMS)


@query("math_equal_nested", _AGREE_SQL, on_fixtures=False)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _agreements(spark, sf_dir, _NESTED)


# --- rewards -------------------------------------------------------------------

ACCURACY_SQL = f"(case when {IS_EQUIVALENT} then 1.0::double else 0.0::double end)"
FORMAT_SQL = (
    f"((case when {HAS_MARKER} then 0.05::double else 0.0::double end) "
    f"+ (case when {HAS_ANSWER} then 0.05::double else 0.0::double end))"
)
TOTAL_SQL = f"(1.0::double * {ACCURACY_SQL} + 0.1::double * {FORMAT_SQL})"
SCORES_SQL = f"{ACCURACY_SQL} as accuracy_reward, {FORMAT_SQL} as format_reward, {TOTAL_SQL} as total_reward"


@query("accuracy_reward", f"select idx, gen, {ACCURACY_SQL} as accuracy_reward from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    reward = accuracy_reward(F.col("completion"), F.col("ground_truth"))
    return paired(spark, sf_dir).select("idx", "gen", reward.alias("accuracy_reward"))


@query(
    "compute_reward",
    f"select idx, gen, (case when {HAS_ANSWER} then 0.1::double else 0.0::double end) + {ACCURACY_SQL} as reward from completions",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    reward = compute_reward(F.col("completion"), F.col("ground_truth"))
    return paired(spark, sf_dir).select("idx", "gen", reward.alias("reward"))


@query("format_reward", f"select idx, gen, {FORMAT_SQL} as format_reward from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completions(spark, sf_dir).select("idx", "gen", format_reward(F.col("completion")).alias("format_reward"))


@query("total_reward", f"select idx, gen, {SCORES_SQL} from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = paired(spark, sf_dir).select("idx", "gen", "completion", "ground_truth")
    return apply_rewards(rows).drop("completion", "ground_truth")


@query(
    "reward_registry",
    f"select idx, gen, {SCORES_SQL.replace(' as total_reward', ' + 0.5::double * (case when length(completion) < 40 then 1.0::double else 0.0::double end) as total_reward')}, "
    "(case when length(completion) < 40 then 1.0::double else 0.0::double end) as brevity from completions",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    brevity = Reward("brevity", 0.5, lambda completion, truth: F.when(F.length(completion) < 40, 1.0).otherwise(0.0))
    rows = paired(spark, sf_dir).select("idx", "gen", "completion", "ground_truth")
    return apply_rewards(rows, (*DEFAULT_REWARDS, brevity)).drop("completion", "ground_truth")


@query(
    "sql_functions",
    f"select idx, gen, {EXTRACTED_SQL} as extracted, {_NORMAL_SQL.replace('answer', 'alt_answer')} as normalized, "
    f"{FORMAT_SQL} as format_reward, case when {HAS_ANSWER} then {IS_EQUIVALENT} end as is_equivalent, "
    f"{ACCURACY_SQL} as accuracy_reward, (case when {HAS_ANSWER} then 0.1::double else 0.0::double end) + {ACCURACY_SQL} as reward "
    "from completions",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_sql_functions(spark)
    paired(spark, sf_dir).createOrReplaceTempView("tallymark_completions")
    return spark.sql(
        "select idx, gen, extract_answer(completion) as extracted, normalize_latex(alt_answer) as normalized, "
        "format_reward(completion) as format_reward, math_equal(extract_answer(completion), ground_truth) as is_equivalent, "
        "accuracy_reward(completion, ground_truth) as accuracy_reward, compute_reward(completion, ground_truth) as reward "
        "from tallymark_completions"
    )


# --- joins ---------------------------------------------------------------------


@query(
    "join_truth",
    "select idx, gen, completion, ground_truth from completions join problems using (idx) where n_images > 0",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = problems(spark, sf_dir).filter("n_images > 0").select("idx").join(truths(spark, sf_dir), "idx")
    return join_truth(completions(spark, sf_dir), known, "idx")


# A third of all events under one key, the others spread by user.
_HOT_SQL = "case when event_id % 3 = 0 then 'hot' else concat('u', user_id) end"


def _hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(F.expr(_HOT_SQL).alias("id"), F.col("event_id").alias("gen"), F.col("value").alias("total_reward"))


@query(
    "join_truth_skewed",
    f"select {_HOT_SQL} as id, event_id as gen, value as total_reward, length({_HOT_SQL}) as size from events",
    on_fixtures=False,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _hot_events(spark, sf_dir)
    truth = events.select("id").distinct().withColumn("size", F.length("id").cast("long"))
    return join_truth(events, truth)


@query(
    "group_advantage_skewed",
    f"""select id, gen, case when max(r) over w = min(r) over w then 0.0::double
        else round((r - avg(r) over w) / (stddev_samp(r) over w + 0.0001::double), 6) end as advantage
        from (select {_HOT_SQL} as id, event_id as gen, value as r from events) window w as (partition by id)""",
    on_fixtures=False,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = group_advantage(materialize(_hot_events(spark, sf_dir)))
    return rows.select("id", "gen", F.round("advantage", 6).alias("advantage"))


@query("join_predictions", f"select id, completion as prediction, predicted_answer, ground_truth from ({GRADED_SQL})")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = rl_samples(spark, sf_dir).select("id", "ground_truth")
    return join_predictions(examples, predicted_answers(predictions(spark, sf_dir)))


# --- aggregates ----------------------------------------------------------------


def _graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade(graded_predictions(rl_samples(spark, sf_dir), predictions(spark, sf_dir)))


def _all_graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = paired(spark, sf_dir).withColumn("predicted_answer", extract_answer(F.col("completion")))
    return grade(rows)


def _rate_sql(flag: str) -> str:
    return f"coalesce((count(*) filter ({flag}))::double / nullif(count(*), 0), 0)"


REPORT_SQL = (
    f"count(*) as num_samples, {_rate_sql(HAS_ANSWER)} as format_rate, {_rate_sql(IS_EXACT)} as exact_match, "
    f"{_rate_sql(IS_EQUIVALENT)} as symbolic_accuracy"
)


@query("num_samples", "select count(*) as num_samples from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completions(spark, sf_dir).agg(num_samples().alias("num_samples"))


@query("format_rate", f"select {_rate_sql(HAS_ANSWER)} as format_rate from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completions(spark, sf_dir).agg(format_rate(extract_answer(F.col("completion"))).alias("format_rate"))


@query("exact_match", f"select {_rate_sql(IS_EXACT)} as exact_match from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_graded(spark, sf_dir).agg(rate(F.col("is_exact")).alias("exact_match"))


@query("symbolic_accuracy", f"select {_rate_sql(IS_EQUIVALENT)} as symbolic_accuracy from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_graded(spark, sf_dir).agg(rate(F.col("is_equivalent")).alias("symbolic_accuracy"))


@query("eval_report", f"select concat('run-', gen) as run_name, {REPORT_SQL} from completions group by 1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = _all_graded(spark, sf_dir).withColumn("run_name", F.concat(F.lit("run-"), F.col("gen").cast("string")))
    return eval_report(graded, "run_name")


@query("eval_row", f"select id, completion as prediction, predicted_answer, ground_truth from ({GRADED_SQL})")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eval_row(_graded(spark, sf_dir))


@query("eval_limit", f"select {RL_ID_SQL} as id from problems where idx >= {SPLIT} and n_images > 0 order by idx limit {EVAL_SAMPLES}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare_rl(illustrated(spark, sf_dir), count=SPLIT, data_dir=DATA_DIR)
    numbered = rows.select("id", F.substring_index("id", "_", -1).cast("long").alias("number"))
    return first_rows(numbered, EVAL_SAMPLES, "number").select("id")


@query(
    "group_advantage",
    f"""select idx, gen, case when max(r) over w = min(r) over w then 0.0::double
        else round((r - avg(r) over w) / (stddev_samp(r) over w + 0.0001::double), 6) end as advantage
        from (select idx, gen, {TOTAL_SQL} as r from completions) window w as (partition by idx)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = apply_rewards(paired(spark, sf_dir).select("idx", "gen", "completion", "ground_truth"))
    rows = group_advantage(materialize(scored.select("idx", "gen", "total_reward")), group="idx")
    return rows.select("idx", "gen", F.round("advantage", 6).alias("advantage"))


# --- pipelines and sinks -------------------------------------------------------


@query(
    "grade_rollouts",
    f"""select idx, gen, accuracy_reward, format_reward, total_reward, case when max(total_reward) over w = min(total_reward) over w
        then 0.0::double else round((total_reward - avg(total_reward) over w) / (stddev_samp(total_reward) over w + 0.0001::double), 6)
        end as advantage from (select idx, gen, {SCORES_SQL} from completions) window w as (partition by idx)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = grade_rollouts(completions(spark, sf_dir), truths(spark, sf_dir), key="idx")
    return graded.withColumn("advantage", F.round("advantage", 6))


def _evaluation(spark: SparkSession, sf_dir: str, max_samples: int | None = None):
    return evaluate(rl_samples(spark, sf_dir), predictions(spark, sf_dir), MODEL, max_samples)


@query("evaluate", f"select '{MODEL}' as model_name_or_path, {REPORT_SQL} from ({GRADED_SQL})")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluation(spark, sf_dir).report


@query("evaluate_runs", f"select concat('output/run-', gen, '/') as model_name_or_path, {REPORT_SQL} from ({ALL_GRADED_SQL}) group by gen")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every generation as a run of its own."""
    examples = rl_samples(spark, sf_dir)
    runs = [evaluate(examples, predictions(spark, sf_dir, gen), f"output/run-{gen}/", None) for gen in range(GENERATIONS)]
    return reduce(DataFrame.unionByName, [run.report for run in runs])


@query(
    "evaluate_first",
    f"select '{MODEL}' as model_name_or_path, {REPORT_SQL} from (select * from ({GRADED_SQL}) order by idx limit {EVAL_SAMPLES})",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluation(spark, sf_dir, EVAL_SAMPLES).report


@query("write_report", f"select '{MODEL}' as model_name_or_path, {REPORT_SQL} from ({GRADED_SQL})")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluation = _evaluation(spark, sf_dir)
    path = write_report(evaluation.report.drop("model_name_or_path"), shared_folder(spark), MODEL)
    return spark.read.schema(evaluation.report.schema).json(path)


@query(
    "write_eval_samples",
    f"select id, completion as prediction, predicted_answer, ground_truth, {HAS_ANSWER} as has_answer, {IS_EXACT} as is_exact, "
    f"{IS_EQUIVALENT} as is_equivalent, '{RUN}' as run_name from ({GRADED_SQL})",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    write_eval_samples(_evaluation(spark, sf_dir).samples, folder, RUN)
    return spark.read.parquet(folder)


@query("grade_rounds", f"select idx, gen, gen % 2 as round, {SCORES_SQL} from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, name = shared_folder(spark), f"tallymark_truths_{uuid4().hex}"
    stored = store_truths(truths(spark, sf_dir), name, key="idx", path=folder)
    rounds = [completions(spark, sf_dir).filter(F.col("gen") % 2 == i) for i in (0, 1)]
    # One round after the other, as they come: each is a plan of its own.
    scores = [materialize(score_round(rows, stored, key="idx").withColumn("round", F.lit(i).cast("long"))) for i, rows in enumerate(rounds)]
    graded = reduce(DataFrame.unionByName, scores)
    spark.sql(f"drop table {name}")
    remove(spark, folder)
    return graded


@query("score_stream", f"select idx::varchar as id, gen, {SCORES_SQL} from completions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    as_id = F.col("idx").cast("string").alias("id")
    completions(spark, sf_dir).select(as_id, "gen", "completion").repartition(4, "gen").to(COMPLETION).write.json(f"{folder}/in")
    truth = truths(spark, sf_dir).select(as_id, "ground_truth")
    running = score_stream(spark, f"{folder}/in", truth, f"{folder}/out", f"{folder}/state", files_per_batch=2)
    running.awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


@query(
    "advantage_stream",
    f"""select idx::varchar as id, gen, case when max(r) over w = min(r) over w then 0.0::double
        else round((r - avg(r) over w) / (stddev_samp(r) over w + 0.0001::double), 6) end as advantage
        from (select idx, gen, {TOTAL_SQL} as r from completions) window w as (partition by idx)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generations arrive in files of their own, one of them twice."""
    folder = shared_folder(spark)
    scored = apply_rewards(paired(spark, sf_dir).select("idx", "gen", "completion", "ground_truth"))
    scored = materialize(scored.select(F.col("idx").cast("string").alias("id"), "gen", "total_reward"))
    for gen in (*range(GENERATIONS), 1):
        # In few files, however many tasks graded them: a group is looked at in every micro-batch that brings some of it.
        scored.filter(F.col("gen") == gen).coalesce(3).write.mode("append").parquet(f"{folder}/in")
    advantage_stream(spark, f"{folder}/in", f"{folder}/out", f"{folder}/state", files_per_batch=16).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("id", "gen", F.round("advantage", 6).alias("advantage"))


@query("report_stream", f"select concat('run-', gen) as run, {REPORT_SQL} from ({ALL_GRADED_SQL}) group by gen")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every generation as a run of its own, in files that arrive one after the other."""
    folder = shared_folder(spark)
    every = [predictions(spark, sf_dir, gen).withColumn("run", F.lit(f"run-{gen}")) for gen in range(GENERATIONS)]
    lines = reduce(DataFrame.unionByName, every).repartition(8, "id")
    lines.select(F.to_json(F.struct("run", "id", "prompt_text", "generated")).alias("value")).write.text(f"{folder}/in")
    running = report_stream(
        spark, f"{folder}/in", rl_samples(spark, sf_dir), f"{folder}/ledger", f"{folder}/state", files_per_batch=4
    )
    running.awaitTermination()
    return running_report(spark, f"{folder}/ledger")


@query(
    "math_equal_distinct",
    "select p_partkey as idx, nth, which, which <> 'near' as equal from part, range(4) as r(nth), (values ('same'), ('swapped'), ('near')) as w(which)",
    on_fixtures=False,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of ``math_equal_sums``, of which few are different, each graded once."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size")
    cases = [
        F.struct(F.lit(nth).cast("long").alias("nth"), F.lit(which).alias("which"), _filled(l).alias("l"), _filled(r).alias("r"))
        for nth, (a, b, c) in enumerate(_SUMS)
        for which, l, r in (("same", a, b), ("swapped", b, a), ("near", a, c))
    ]
    rows = part.select(F.col("p_partkey").alias("idx"), F.explode(F.array(*cases)).alias("t")).select("idx", "t.*")
    return math_equal_distinct(materialize(rows), "l", "r").select("idx", "nth", "which", "equal")


@query(
    "sql_table_functions",
    f"select concat('run-', gen) as run, {REPORT_SQL}, round(avg({TOTAL_SQL}), 9) as mean_reward from ({ALL_GRADED_SQL}) group by gen",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report per run from SQL alone."""
    register_sql_table_functions(spark)
    known = rl_samples(spark, sf_dir).select("id")
    rows = paired(spark, sf_dir).withColumn("id", sample_id(F.col("idx"), SPLIT)).filter(F.col("idx") >= SPLIT)
    rows.join(known, "id").createOrReplaceTempView("tallymark_rollouts")
    return spark.sql(
        "SELECT concat('run-', c.gen) AS run, count(*) AS num_samples, avg(CAST(g.has_answer AS DOUBLE)) AS format_rate, "
        "avg(CAST(g.is_exact AS DOUBLE)) AS exact_match, avg(CAST(g.is_equivalent AS DOUBLE)) AS symbolic_accuracy, "
        "round(avg(g.total_reward), 9) AS mean_reward "
        "FROM tallymark_rollouts c, LATERAL graded_completion(c.completion, c.ground_truth) g GROUP BY c.gen"
    )


def _by_run(spark: SparkSession, sf_dir: str):
    every = [predictions(spark, sf_dir, gen).withColumn("run", F.lit(f"run-{gen}")) for gen in range(GENERATIONS)]
    return evaluate_by_run(rl_samples(spark, sf_dir), reduce(DataFrame.unionByName, every))


_RUN_SAMPLES_SQL = (
    f"select concat('run-', gen) as run, id, completion as prediction, predicted_answer, ground_truth, {HAS_ANSWER} as has_answer, "
    f"{IS_EXACT} as is_exact, {IS_EQUIVALENT} as is_equivalent from ({ALL_GRADED_SQL})"
)


@query("evaluate_by_run", f"select concat('run-', gen) as run, {REPORT_SQL} from ({ALL_GRADED_SQL}) group by gen")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All generations, each a run, in one pass."""
    return _by_run(spark, sf_dir).report


@query("join_predictions_runs", f"select run, id, prediction, predicted_answer, ground_truth from ({_RUN_SAMPLES_SQL})")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_run(spark, sf_dir).samples.select("run", "id", "prediction", "predicted_answer", "ground_truth")


@query("write_eval_samples_runs", f"select * exclude (run), run as run_name from ({_RUN_SAMPLES_SQL})")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_by_run(spark, sf_dir).write(shared_folder(spark)))
