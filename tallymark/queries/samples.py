"""Scans, splits, projections and joins of the preparation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.fixed import TEACHER_SYSTEM_PROMPT, TEACHER_USER_PROMPT
from tallymark.fixtures import PNG_HEAD, TRUTH, illustrated, problems
from tallymark.functions.latex import clean_ground_truth
from tallymark.operators import (
    chat_rl,
    chat_rows,
    chat_sft,
    chat_user,
    completion_fallback,
    completion_source,
    field_defaults,
    first_image,
    image_intact,
    image_kind,
    image_path,
    join_teacher,
    mock_completion,
    prep_summary,
    require_image,
    rl_sample,
    rollout_requests,
    sample_id,
    sft_sample,
    split_of,
    split_rl,
    split_sft,
    stable_index,
    teacher_request,
    teacher_request_json,
    with_image,
    without_image,
)
from tallymark.plans import accepted, prepare_all, prepare_sft
from tallymark.queries.registry import query
from tallymark.queries.shared import (
    SPLIT,
    DATA_DIR,
    ID_SQL,
    IMAGE_SQL,
    MOCK_SQL,
    PROMPT_SQL,
    RL_ID_SQL,
    RL_SAMPLES_SQL,
    SFT_ID_SQL,
    SPLIT_SQL,
    TEACHER_COLUMNS,
    classified,
    rl_samples,
    sft_samples,
    teacher_answers,
    template_sql,
)
from tallymark.schemas import RL_SAMPLE
from tallymark.sources import (
    scan_images,
    scan_jsonl,
    scan_jsonl_positions,
    scan_problems,
    scan_teacher,
    teacher_successes,
    with_positions,
    write_image_manifest,
    write_jsonl,
    write_rejects,
)
from tallymark.storage import shared_folder

KINDS = {
    0: ("png", PNG_HEAD.hex()),
    1: ("jpeg", "FFD8FFE000104A46"),
    2: ("gif", "47494638396101000100"),
    3: ("webp", "524946461A00000057454250"),
    4: (None, "25504446"),
}


# --- scans and sinks -----------------------------------------------------------


@query("scan_problems", "select idx, problem, answer, n_images from problems")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several files without the column idx: a row's position is its place among all of them."""
    path = shared_folder(spark)
    rows = illustrated(spark, sf_dir).repartitionByRange(5, "idx").sortWithinPartitions("idx")
    rows.drop("idx").write.parquet(path)
    return scan_problems(spark, path).select("idx", "problem", "answer", F.size("images").alias("n_images"))


@query(
    "scan_jsonl",
    f"select {ID_SQL} as id, {IMAGE_SQL} as image, problem as prompt, {TRUTH} as ground_truth, answer as raw_answer "
    "from problems where n_images > 0",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    write_jsonl(sft_samples(spark, sf_dir), f"{path}/sft")
    write_jsonl(rl_samples(spark, sf_dir), f"{path}/rl")
    return scan_jsonl(spark, [f"{path}/sft", f"{path}/rl"], RL_SAMPLE)


@query(
    "scan_teacher",
    f"select {ID_SQL} as id, {TEACHER_COLUMNS['completion']} as completion from problems "
    f"where {TEACHER_COLUMNS['status_code']} = 200",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    teacher_answers(spark, sf_dir).write.parquet(path)
    return scan_teacher(spark, path)


@query(
    "scan_images",
    "select p_brand as folder, count(*) as num_rows, true as has_bytes from part group by p_brand",
    on_fixtures=False,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file of rows per brand; the folders that hold files meet the table they came from."""
    path = shared_folder(spark)
    part = spark.read.parquet(f"{sf_dir}/part.parquet").withColumn("folder", F.col("p_brand"))
    part.repartition("folder").write.partitionBy("folder").parquet(path)
    files = scan_images(spark, path, "*.parquet").select(
        F.url_decode(F.regexp_extract("image", "/folder=([^/]*)/", 1)).alias("folder"), "length"
    )
    found = files.groupBy("folder").agg((F.sum("length") > 0).alias("has_bytes"))
    return part.groupBy("folder").agg(F.count(F.lit(1)).alias("num_rows")).join(found, "folder")


@query(
    "write_jsonl",
    f"select to_json(struct_pack(id := {SFT_ID_SQL}, image := {IMAGE_SQL}, prompt := problem, completion := {MOCK_SQL}, "
    f"ground_truth := {TRUTH}, raw_answer := answer, completion_source := 'mock'))::varchar as line "
    f"from problems where idx < {SPLIT} and n_images > 0 union all "
    f"select to_json(struct_pack(id := id, image := image, prompt := prompt, ground_truth := ground_truth, raw_answer := raw_answer))::varchar "
    f"from ({RL_SAMPLES_SQL})",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    write_jsonl(sft_samples(spark, sf_dir), f"{path}/sft")
    write_jsonl(rl_samples(spark, sf_dir), f"{path}/rl")
    return spark.read.text([f"{path}/sft", f"{path}/rl"]).select(F.col("value").alias("line"))


REJECTS_SQL = f"select {SPLIT_SQL} as split, idx, 'no_image' as reason from problems where n_images = 0"


@query("write_rejects", REJECTS_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    write_rejects(classified(spark, sf_dir), path)
    return spark.read.parquet(path)


@query(
    "write_image_manifest",
    f"select {ID_SQL} as id, {IMAGE_SQL} as image, '{PNG_HEAD.hex().upper()}' as bytes from problems where n_images > 0",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    write_image_manifest(accepted(classified(spark, sf_dir)), path)
    return spark.read.parquet(path).withColumn("bytes", F.hex("bytes"))


# --- splits and projections ----------------------------------------------------


@query("split_sft", f"select idx, problem from problems where idx < {SPLIT}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_sft(problems(spark, sf_dir), SPLIT).select("idx", "problem")


@query("split_rl", f"select idx, problem from problems where idx >= {SPLIT}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_rl(problems(spark, sf_dir), SPLIT).select("idx", "problem")


@query("field_defaults", "select idx, '' as problem, answer, 0 as n_images from problems")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = field_defaults(problems(spark, sf_dir).select("idx", "answer"))
    return rows.select("idx", "problem", "answer", F.size("images").alias("n_images"))


@query("require_image", "select idx, problem from problems where n_images > 0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_image(illustrated(spark, sf_dir)).select("idx", "problem")


@query(
    "first_image",
    f"select idx, case when n_images > 0 then '{PNG_HEAD.hex().upper()}' end as bytes from problems",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return illustrated(spark, sf_dir).select("idx", F.hex(first_image(F.col("images"))["bytes"]).alias("bytes"))


@query(
    "image_kind",
    "select idx, case idx % 5 "
    + " ".join(f"when {which} then '{kind}'" for which, (kind, _) in KINDS.items() if kind)
    + " end as kind from problems",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.lit(None).cast("binary")
    for which, (_, head) in KINDS.items():
        data = F.when(F.col("idx") % 5 == which, F.unhex(F.lit(head))).otherwise(data)
    return problems(spark, sf_dir).select("idx", image_kind(data).alias("kind"))


@query("sample_id", f"select idx, {ID_SQL} as id from problems")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return problems(spark, sf_dir).select("idx", sample_id(F.col("idx"), SPLIT).alias("id"))


@query("image_path", f"select idx, {IMAGE_SQL} as image from problems")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = F.col("idx")
    path = image_path(DATA_DIR, split_of(idx, SPLIT), sample_id(idx, SPLIT))
    return problems(spark, sf_dir).select("idx", path.alias("image"))


@query("clean_ground_truth", f"select idx, {TRUTH} as ground_truth from problems")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return problems(spark, sf_dir).select("idx", clean_ground_truth(F.col("answer")).alias("ground_truth"))


@query("mock_completion", f"select idx, {MOCK_SQL} as completion from problems")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = mock_completion(F.col("problem"), F.col("answer"))
    return problems(spark, sf_dir).select("idx", text.alias("completion"))


@query(
    "completion_fallback",
    f"select idx, coalesce(taught, {MOCK_SQL}) as completion, "
    "case when taught is null then 'mock' else 'teacher' end as completion_source "
    f"from (select *, {TEACHER_COLUMNS['completion']} as taught from problems)",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = problems(spark, sf_dir).withColumn("taught", F.expr(TEACHER_COLUMNS["completion"]))
    taught = F.col("taught")
    return rows.select(
        "idx",
        completion_fallback(taught, F.col("problem"), F.col("answer")).alias("completion"),
        completion_source(taught).alias("completion_source"),
    )


@query(
    "sft_sample",
    f"select {ID_SQL} as id, {IMAGE_SQL} as image, problem as prompt, {MOCK_SQL} as completion, {TRUTH} as ground_truth, "
    "answer as raw_answer, 'mock' as completion_source from problems where n_images > 0",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accepted(classified(spark, sf_dir)).withColumn("teacher_completion", F.lit(None).cast("string"))
    return sft_sample(rows)


@query(
    "rl_sample",
    f"select {ID_SQL} as id, {IMAGE_SQL} as image, problem as prompt, {TRUTH} as ground_truth, "
    "answer as raw_answer from problems where n_images > 0",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rl_sample(accepted(classified(spark, sf_dir)))


_USER_PROMPT_SQL = template_sql(TEACHER_USER_PROMPT, question="problem", answer="coalesce(answer, 'None')")


@query(
    "teacher_request",
    f"""select idx, concat('[{{"role":"system","content":[{{"text":', to_json('{TEACHER_SYSTEM_PROMPT}')::varchar,
        '}}]}},{{"role":"user","content":[{{"image":', to_json(concat('file:///', {IMAGE_SQL}))::varchar,
        '}},{{"text":', to_json({_USER_PROMPT_SQL})::varchar, '}}]}}]') as request from problems""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = F.col("idx")
    image = image_path(f"/{DATA_DIR}", split_of(idx, SPLIT), sample_id(idx, SPLIT))
    messages = teacher_request(image, F.col("problem"), F.col("answer"))
    return problems(spark, sf_dir).select("idx", teacher_request_json(messages).alias("request"))


@query("chat_user", f"select idx, 'user' as role, {PROMPT_SQL} as content from problems")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return problems(spark, sf_dir).select("idx", F.inline(chat_user(F.col("problem"))))


CHAT_SFT_SQL = (
    f"select {SFT_ID_SQL} as id, concat('user:', {PROMPT_SQL}, chr(10), 'assistant:', {MOCK_SQL}) as messages, "
    f"{IMAGE_SQL} as image, {TRUTH} as ground_truth from problems where idx < {SPLIT} and n_images > 0"
)
CHAT_RL_SQL = (
    f"select {RL_ID_SQL} as id, concat('user:', {PROMPT_SQL}) as messages, {IMAGE_SQL} as image, "
    f"{TRUTH} as ground_truth from problems where idx >= {SPLIT} and n_images > 0"
)


def _as_text(messages: str):
    """Messages as one text, for comparison."""
    return F.array_join(
        F.transform(messages, lambda message: F.concat(message["role"], F.lit(":"), message["content"])), "\n"
    )


@query("chat_sft", CHAT_SFT_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_sft(sft_samples(spark, sf_dir)).withColumn("messages", _as_text("messages"))


@query("chat_rl", f"select *, ground_truth as answer from ({CHAT_RL_SQL})")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_rl(rl_samples(spark, sf_dir)).withColumn("prompt", _as_text("prompt")).withColumnRenamed("prompt", "messages")


@query("chat_mode", f"select id, messages from ({CHAT_SFT_SQL}) union all select id, messages from ({CHAT_RL_SQL})")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    supervised = chat_rows(sft_samples(spark, sf_dir), "sft").select("id", _as_text("messages").alias("messages"))
    prompts = chat_rows(rl_samples(spark, sf_dir), "grpo").select("id", _as_text("prompt").alias("messages"))
    return supervised.unionByName(prompts)


# --- joins, positions and counts -----------------------------------------------


@query(
    "join_teacher",
    f"select {ID_SQL} as id, {TEACHER_COLUMNS['completion']} as teacher_completion from problems",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = problems(spark, sf_dir).select(sample_id(F.col("idx"), SPLIT).alias("id"))
    return join_teacher(samples, teacher_successes(teacher_answers(spark, sf_dir)))


@query(
    "join_images",
    f"select {ID_SQL} as id, answer is not null as has_image from problems where n_images > 0",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accepted(classified(spark, sf_dir)).select("id", "image", "answer")
    existing = rows.filter(F.col("answer").isNotNull()).select("image")
    found = with_image(rows, existing).select("id", F.lit(True).alias("has_image"))
    return found.unionByName(without_image(rows, existing).select("id", F.lit(False).alias("has_image")))


@query("rollout_requests", "select idx, gen from problems, (select unnest(range(4)) as gen)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollout_requests(problems(spark, sf_dir).select("idx"))


@query(
    "stable_index",
    "select o_custkey, o_orderkey, row_number() over (order by o_custkey, o_orderkey) - 1 as idx from orders",
    on_fixtures=False,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey")
    return stable_index(orders, ["o_custkey", "o_orderkey"])


@query("source_positions", "select c_custkey, c_custkey as idx from customer", on_fixtures=False)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_positions(spark.read.parquet(f"{sf_dir}/customer.parquet")).select("c_custkey", "idx")


SUMMARY_SQL = (
    f"select {SPLIT_SQL} as split, count(*) as problems, count(*) filter (n_images > 0) as samples, "
    "count(*) filter (n_images > 0) as images, count(*) filter (n_images = 0) as no_image, 0::bigint as bad_image "
    "from problems group by 1"
)


@query("prep_summary", SUMMARY_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep_summary(classified(spark, sf_dir))


# --- pipelines -----------------------------------------------------------------

PREPARE_SFT_SQL = (
    f"select {SFT_ID_SQL} as id, {IMAGE_SQL} as image, problem as prompt, coalesce(taught, {MOCK_SQL}) as completion, "
    f"{TRUTH} as ground_truth, answer as raw_answer, case when taught is null then 'mock' else 'teacher' end as completion_source "
    f"from (select *, {TEACHER_COLUMNS['completion']} as taught from problems) where idx < {SPLIT} and n_images > 0"
)


@query("prepare_sft", PREPARE_SFT_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    teacher = teacher_successes(teacher_answers(spark, sf_dir))
    return prepare_sft(illustrated(spark, sf_dir), count=SPLIT, data_dir=DATA_DIR, teacher=teacher)


@query("prepare_rl", RL_SAMPLES_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rl_samples(spark, sf_dir)


_COLUMNS = ("id", "image", "prompt", "completion", "ground_truth", "raw_answer")


def _outputs_sql(target: str, sql: str, **columns: str) -> str:
    values = ", ".join(f"{columns.get(name, 'null')}::varchar as {name}" for name in _COLUMNS)
    return f"select '{target}' as target, {values} from ({sql})"


_SAMPLE = {name: name for name in _COLUMNS}
_SUMMARY_SQL = (
    f"select {SPLIT_SQL} as split, count(*) as problems, count(*) filter (n_images > 0) as samples, "
    "count(*) filter (n_images = 0) as no_image from problems group by 1"
)


@query(
    "prepare_all",
    " union all ".join(
        [
            _outputs_sql("sft", PREPARE_SFT_SQL, **_SAMPLE),
            _outputs_sql("rl", RL_SAMPLES_SQL, **{k: v for k, v in _SAMPLE.items() if k != "completion"}),
            _outputs_sql("rejects", REJECTS_SQL, id="idx", image="split", prompt="reason"),
            _outputs_sql(
                "images",
                f"select {ID_SQL} as id, {IMAGE_SQL} as image from problems where n_images > 0",
                id="id", image="image", prompt=f"'{PNG_HEAD.hex().upper()}'",
            ),
            _outputs_sql("summary", _SUMMARY_SQL, id="split", image="problems", prompt="samples", completion="no_image"),
        ]
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every output."""
    folder = shared_folder(spark)
    teacher = teacher_successes(teacher_answers(spark, sf_dir))
    prepare_all(illustrated(spark, sf_dir), count=SPLIT, data_dir=DATA_DIR, teacher=teacher).write(folder)

    def rows(target: str, table: DataFrame, **columns) -> DataFrame:
        values = [columns.get(name, F.lit(None)).cast("string").alias(name) for name in _COLUMNS]
        return table.select(F.lit(target).alias("target"), *values)

    sample = {name: F.col(name) for name in _COLUMNS}
    summary = T.StructType.fromDDL("split string, problems long, samples long, images long, no_image long, bad_image long")
    sft = T.StructType([*RL_SAMPLE.fields, T.StructField("completion", T.StringType())])
    parts = [
        rows("sft", scan_jsonl(spark, f"{folder}/sft.jsonl", sft), **sample),
        rows("rl", scan_jsonl(spark, f"{folder}/rl.jsonl", RL_SAMPLE), **{k: v for k, v in sample.items() if k != "completion"}),
        rows("rejects", spark.read.parquet(f"{folder}/rejects"), id=F.col("idx"), image=F.col("split"), prompt=F.col("reason")),
        rows("images", spark.read.parquet(f"{folder}/images"), id=F.col("id"), image=F.col("image"), prompt=F.hex("bytes")),
        rows(
            "summary",
            spark.read.schema(summary).json(f"{folder}/summary"),
            id=F.col("split"), image=F.col("problems"), prompt=F.col("samples"), completion=F.col("no_image"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("scan_jsonl_positions", "select row_number() over (order by doc_id) - 1 as position, cast(doc_id as varchar) as id, md5(text) as text_md5 from documents", on_fixtures=False)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON Lines in several files, each in the order of ids."""
    folder = shared_folder(spark)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("doc_id").cast("string").alias("id"), "text")
    ordered = rows.repartitionByRange(6, "doc_id").sortWithinPartitions("doc_id").drop("doc_id")
    ordered.write.option("ignoreNullFields", "false").json(folder)
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType())])
    found = scan_jsonl_positions(spark, folder, schema)
    return found.select("position", "id", F.md5("text").alias("text_md5"))


def _png_chunk(kind: str, data: str) -> str:
    whole = f"concat(CAST('{kind}' AS BINARY), {data})"
    return f"concat(unhex(lpad(hex(length({data})), 8, '0')), {whole}, unhex(lpad(hex(crc32({whole})), 8, '0')))"


_PNG = (
    f"concat(unhex('89504E470D0A1A0A'), {_png_chunk('IHDR', "unhex('00000010000000100802000000')")}, "
    f"{_png_chunk('IDAT', 'CAST(p_name AS BINARY)')}, {_png_chunk('IEND', "unhex('')")})"
)
_JPEG = "concat(unhex('FFD8FFE000074A46494600FFDA000401020300'), CAST(p_name AS BINARY), unhex('FFD9'))"


@query("image_intact", "select p_partkey as idx, p_partkey % 3 = 0 as intact from part", on_fixtures=False)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A picture per part: whole, without its end, or with a changed byte in its middle, of which a JPEG's is its head's."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    made = part.withColumn("whole", F.expr(f"CASE WHEN p_partkey % 2 = 0 THEN {_PNG} ELSE {_JPEG} END"))
    cut = F.expr("substring(whole, 1, length(whole) - 1)")
    changed = F.expr("concat(substring(whole, 1, 20), unhex('FE'), substring(whole, 22))")
    broken = F.expr("concat(substring(whole, 1, 2), unhex('00'), substring(whole, 4))")
    data = F.expr("p_partkey % 3")
    picture = F.when(data == 0, F.col("whole")).when(data == 1, cut).when(F.col("p_partkey") % 2 == 0, changed).otherwise(broken)
    return made.select(F.col("p_partkey").alias("idx"), image_intact(picture).alias("intact"))
