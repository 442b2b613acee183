"""Preparation: splits, rejects, samples, chat rows and their files."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallymark.fixed import TEACHER_SYSTEM_PROMPT
from tallymark.operators import (
    chat_rows,
    field_defaults,
    image_kind,
    mock_completion,
    require_image,
    sample_id,
    sample_number,
    split_rl,
    split_sft,
    teacher_request,
    teacher_request_json,
)
from tallymark.operators.joins import with_image, without_image
from tallymark.plans import classify, prepare_all
from tallymark.schemas import PROBLEM, RL_SAMPLE, SFT_SAMPLE, TEACHER, TYPED_MESSAGE
from tallymark.sources import scan_images, scan_jsonl, scan_problems, scan_teacher, split_bad_lines, write_jsonl
from tallymark.storage import shared_folder

PNG = bytes.fromhex("89504E470D0A1A0A00")
ROWS = [
    (0, "<image>Find x.", "$ 5 $", [(PNG, None)]),
    (1, "No picture", "6", []),
    (2, None, None, [(b"\xff\xd8\xff\xe0", "b.jpg"), (PNG, None)]),
    (3, "Not a picture", "7", [(b"%PDF", None)]),
    (4, "Null list", "8", None),
    (5, "Empty answer", "", [(PNG, None)]),
    (6, "Null bytes", "9", [(None, "gone.png")]),
    (7, "Dollars", "$", [(PNG, None)]),
]


@pytest.fixture(scope="module")
def problems(spark):
    return spark.createDataFrame(ROWS, PROBLEM)


def test_splits_are_disjoint_and_complete(problems):
    for count in (0, 3, 100):
        head = {row.idx for row in split_sft(problems, count).collect()}
        tail = {row.idx for row in split_rl(problems, count).collect()}
        assert head | tail == set(range(8)) and not head & tail
    for split in (split_sft, split_rl):
        with pytest.raises(ValueError):
            split(problems, -1)


def test_samples_and_rejects_cover_the_source(problems):
    prepared = prepare_all(problems, 3, "/data/")
    sft = {row.id: row for row in prepared.sft.collect()}
    rl = {row.id: row for row in prepared.rl.collect()}
    assert list(sft) == ["sft_00000", "sft_00002"] and list(rl) == ["rl_00002", "rl_00004"]
    assert {(row.split, row.idx, row.reason) for row in prepared.rejects.collect()} == {
        ("sft", 1, "no_image"),
        ("rl", 3, "bad_image"),
        ("rl", 4, "no_image"),
        ("rl", 6, "bad_image"),
    }
    assert sft["sft_00000"].image == "/data/images/sft/sft_00000.png"
    assert sft["sft_00000"].ground_truth == "5" and sft["sft_00000"].raw_answer == "$ 5 $"
    assert sft["sft_00002"].ground_truth == "" and sft["sft_00002"].raw_answer is None
    assert sft["sft_00002"].prompt is None
    assert "the answer is N/A.\n½\n\n<answer>\nN/A\n</answer>" in sft["sft_00002"].completion
    assert sft["sft_00000"].completion.startswith("½\nLooking at this geometry problem")
    assert "\n\nQuestion: <image>Find x.\n\n" in sft["sft_00000"].completion
    assert rl["rl_00002"].ground_truth == "" and rl["rl_00002"].raw_answer == ""
    images = {row.id: bytes(row.bytes) for row in prepared.images.collect()}
    assert images["sft_00002"] == b"\xff\xd8\xff\xe0" and len(images) == 4
    summary = {row.split: row.asDict() for row in prepared.summary.collect()}
    assert summary["sft"] == dict(split="sft", problems=3, samples=2, images=2, no_image=1, bad_image=0)
    assert summary["rl"] == dict(split="rl", problems=5, samples=2, images=2, no_image=1, bad_image=2)
    assert prepared.sft.schema.names == SFT_SAMPLE.names and prepared.rl.schema.names == RL_SAMPLE.names


def test_more_samples_than_problems(problems):
    prepared = prepare_all(problems, 100)
    assert prepared.rl.count() == 0 and prepared.sft.count() == 4


def test_mock_answers(spark):
    df = spark.createDataFrame([("q", None), ("q", ""), ("q", "$"), (None, "5")], "q string, a string").coalesce(1)
    texts = [row[0] for row in df.select(mock_completion(F.col("q"), F.col("a"))).collect()]
    assert [text.split("<answer>\n")[1] for text in texts] == ["N/A\n</answer>"] * 2 + ["\n</answer>", "5\n</answer>"]
    assert "Question: None\n" in texts[3]


def test_teacher_completions_come_first(spark, problems):
    path = shared_folder(spark)
    answers = [("sft_00000", 200, "½ taught ½"), ("sft_00002", 500, "broken"), ("sft_00099", 200, "nobody")]
    spark.createDataFrame(answers, TEACHER).write.parquet(path)
    sft = {row.id: row for row in prepare_all(problems, 3, teacher=scan_teacher(spark, path)).sft.collect()}
    assert (sft["sft_00000"].completion, sft["sft_00000"].completion_source) == ("½ taught ½", "teacher")
    assert sft["sft_00002"].completion_source == "mock"


def test_ids_grow_past_five_digits(spark):
    df = spark.createDataFrame([(7,), (99_999,), (100_000,), (1_234_567,)], "idx long").coalesce(1)
    ids = [tuple(row) for row in df.select(sample_id(F.col("idx"), 10), sample_number(sample_id(F.col("idx"), 10))).collect()]
    assert ids == [("sft_00007", 7), ("rl_99989", 99_989), ("rl_99990", 99_990), ("rl_1234557", 1_234_557)]


def test_defaults_apply_to_missing_columns_only(spark, problems):
    bare = field_defaults(problems.drop("answer", "images")).filter("idx = 2").first()
    assert (bare.problem, bare.answer, bare.images) == (None, "", [])
    assert {row.idx for row in require_image(problems).collect()} == {0, 2, 3, 5, 6, 7}


def test_image_kinds(spark):
    heads = {
        "89504E470D0A1A0A": "png",
        "FFD8FFDB": "jpeg",
        "474946383761": "gif",
        "474946383961": "gif",
        "52494646000000005745425056": "webp",
        "5249464600000000": None,
        "": None,
    }
    df = spark.createDataFrame([(bytes.fromhex(h),) for h in heads], "b binary").coalesce(1)
    assert [row[0] for row in df.select(image_kind(F.col("b"))).collect()] == list(heads.values())


def test_teacher_request(spark):
    df = spark.createDataFrame([("/d/a.png", 'Find "x".', "5")], "image string, q string, a string")
    messages = teacher_request(F.col("image"), F.col("q"), F.col("a"))
    typed = df.select(messages.alias("m"), teacher_request_json(messages).alias("j"))
    assert typed.schema["m"].dataType.elementType.names == TYPED_MESSAGE.names
    row = typed.first()
    assert [chunk.type for chunk in row.m[1].content] == ["image", "text"]
    assert json.loads(row.j) == [
        {"role": "system", "content": [{"text": TEACHER_SYSTEM_PROMPT}]},
        {
            "role": "user",
            "content": [{"image": "file:///d/a.png"}, {"text": '题目：Find "x".\n已知正确答案是：5\n请开始你的推演：'}],
        },
    ]
    own = df.select(teacher_request_json(teacher_request(F.col("image"), F.col("q"), F.col("a"), "S", "{answer}?{question}")))
    assert json.loads(own.first()[0])[1]["content"][1]["text"] == '5?Find "x".'


def test_written_lines(spark, problems):
    folder = shared_folder(spark)
    prepared = prepare_all(problems, 3, "/data")
    prepared.write(folder)
    lines = [line for part in sorted(Path(f"{folder}/sft.jsonl").glob("*.json")) for line in part.read_text("utf-8").splitlines()]
    first, second = map(json.loads, lines)
    assert list(first) == SFT_SAMPLE.names and second["raw_answer"] is None and "raw_answer" in second
    assert '"½\\nLooking' in lines[0]
    again = scan_jsonl(spark, f"{folder}/sft.jsonl", SFT_SAMPLE)
    assert sorted(again.collect()) == sorted(prepared.sft.collect())
    assert spark.read.parquet(f"{folder}/rejects").count() == 4


def test_lines_in_order(spark):
    df = spark.range(2_000).select(sample_id(F.col("id"), 0).alias("id")).repartition(5)
    path = shared_folder(spark)
    write_jsonl(df, path, order=sample_number(F.col("id")))
    lines = [line for part in sorted(Path(path).glob("*.json")) for line in part.read_text().splitlines()]
    assert [json.loads(line)["id"] for line in lines] == [f"rl_{i:05d}" for i in range(2_000)]


def test_required_fields(spark):
    path = shared_folder(spark)
    spark.createDataFrame([('{"id": "a", "prompt": "p"}',), ('{"id": "b"}',)], "value string").write.text(path)
    good, bad = split_bad_lines(scan_jsonl(spark, path, RL_SAMPLE, "keep", required=["id", "prompt"]))
    assert [row.id for row in good.collect()] == ["a"]
    assert [row.bad_line for row in bad.collect()] == ['{"id": "b"}']
    assert scan_jsonl(spark, path, RL_SAMPLE).count() == 2
    with pytest.raises(Exception, match="required"):
        scan_jsonl(spark, path, RL_SAMPLE, required=["prompt"]).collect()


def test_bad_lines(spark):
    path = shared_folder(spark)
    Path(path).mkdir(parents=True)
    good = '{"id": "a", "ground_truth": "½", "extra": 1}'
    Path(path, "x.jsonl").write_text(f"{good}\n\n{{broken\n5\n", "utf-8")
    kept, bad = split_bad_lines(scan_jsonl(spark, path, RL_SAMPLE, "keep"))
    assert [(row.id, row.ground_truth, row.prompt) for row in kept.collect()] == [("a", "½", None)]
    assert sorted(row.bad_line for row in bad.collect()) == ["", "5", "{broken"]
    with pytest.raises(Exception, match="not a JSON object"):
        scan_jsonl(spark, path, RL_SAMPLE).collect()
    with pytest.raises(ValueError):
        scan_jsonl(spark, path, RL_SAMPLE, "ignore")


def test_images_on_disk(spark, problems):
    folder = shared_folder(spark)
    Path(f"{folder}/images/sft").mkdir(parents=True)
    Path(f"{folder}/images/sft/sft_00000.png").write_bytes(PNG)
    images = scan_images(spark, f"{folder}/images")
    assert [(Path(row.image).name, row.length) for row in images.collect()] == [("sft_00000.png", len(PNG))]
    samples = prepare_all(problems, 3, folder).sft
    assert [row.id for row in with_image(samples, images).collect()] == ["sft_00000"]
    assert [row.id for row in without_image(samples, images).collect()] == ["sft_00002"]


def test_chat_rows(spark, problems):
    prepared = prepare_all(problems, 3)
    sft = chat_rows(prepared.sft, "sft").filter("id = 'sft_00000'").first()
    assert [(m.role, m.content[:7]) for m in sft.messages] == [("user", "Find x."), ("assistant", "½\nLooki")]
    rl = chat_rows(prepared.rl, "grpo").first()
    assert (rl.prompt[0].role, rl.answer, rl.ground_truth) == ("user", "", "")
    with pytest.raises(ValueError):
        chat_rows(prepared.rl, "dpo")


def test_source_without_positions(spark, problems):
    path = shared_folder(spark)
    problems.orderBy("idx").drop("idx").coalesce(1).write.parquet(path)
    scanned = scan_problems(spark, path)
    assert scanned.schema.names == PROBLEM.names
    assert [row.idx for row in scanned.orderBy("idx").collect()] == list(range(8))
    assert classify(scanned, 3).filter("reason is null").count() == 4
