"""Text columns against plain Python, on fixed and random strings."""

import random
import re

from pyspark.sql import functions as F

from tallymark.fixed import WHITESPACE
from tallymark.functions import (
    completion_text,
    clean_ground_truth,
    exact_equal,
    extract_answer,
    has_answer,
    latex_to_expr,
    normalize_latex,
    report_name,
    run_name,
    strip,
    strip_image_tag,
    strip_prompt_prefix,
    text_chunks,
    text_messages,
    text_variant,
)

PIECES = (
    ["<answer>", "</answer>", "<ANSWER>", "</Answer>", "<image>", "<IMAGE>", "$", "$$", "\\", "\\\\", "\\displaystyle"]
    + ["\\frac{", "\\frac{1}{2}", "\\sqrt{3}", "}{", "{", "}", "^", "\\cdot", "\\times", "\\pi", "½", "a", "7", "é", "\n"]
    + list(WHITESPACE)
)


def random_texts(count=4000, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(12))) for _ in range(count)]


def check(spark, column, twin, texts):
    df = spark.createDataFrame([(text,) for text in texts], "s string").repartition(8)
    rows = df.select("s", column(F.col("s")).alias("got")).collect()
    wrong = [(row.s, row.got, twin(row.s)) for row in rows if row.got != twin(row.s)]
    assert wrong[:3] == []


def find_any_case(text, tag, start=0):
    return text.lower().find(tag, start)


def answer_twin(text):
    opened = find_any_case(text, "<answer>")
    closed = find_any_case(text, "</answer>", opened + 8) if opened >= 0 else -1
    return text[opened + 8 : closed].strip() if closed >= 0 else None


def normal_twin(text):
    words = text.strip("$").strip().replace(r"\displaystyle", "").split()
    return " ".join(words).replace("\\" * 2, "\\")


def tag_twin(text):
    out, at = "", 0
    while (found := find_any_case(text, "<image>", at)) >= 0:
        out += text[at:found]
        at = found + 7
        while at < len(text) and text[at].isspace():
            at += 1
    return (out + text[at:]).strip() or text.strip()


INNERMOST = re.compile(r"\\frac\{([^{}]+)\}\{([^{}]+)\}|\\sqrt\{([^{}]+)\}")


def expr_twin(text):
    text = normal_twin(text)
    while match := INNERMOST.search(text):
        over, under, root = match.groups()
        new = f"sqrt({root})" if root is not None else f"(({over})/({under}))"
        text = text[: match.start()] + new + text[match.end() :]
    names = {r"\cdot": "*", r"\times": "*", r"\pi": "pi"}
    for name, new in names.items():
        text = new.join(text.split(name))
    return text.translate(str.maketrans({"{": "(", "}": ")", "^": "**"}))


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(code) for code in range(0x110000) if chr(code).isspace()}


def test_strip(spark):
    check(spark, strip, str.strip, random_texts())


def test_extract_answer(spark):
    check(spark, extract_answer, answer_twin, random_texts())
    check(spark, has_answer, lambda text: answer_twin(text) is not None, random_texts(seed=8))


def test_extract_answer_stays_linear(spark):
    """Many opening tags without a closing one, and long runs of blanks."""
    texts = ["<answer>" * 40_000, "<answer>" + " " * 200_000 + "x", "<answer> 5" + " " * 200_000 + "</answer>"]
    check(spark, extract_answer, answer_twin, texts)


def test_normalize_latex(spark):
    check(spark, normalize_latex, normal_twin, random_texts() + [" $x$ ", "$$x$$", "\\\\\\\\"])


def test_latex_to_expr(spark):
    nested = "1"
    for depth in range(30):
        nested = rf"\frac{{{nested}}}{{\sqrt{{{depth}}}}}"
    check(spark, latex_to_expr, expr_twin, random_texts() + [nested, r"\frac{\frac{a}{b}}{c}^{2}\cdot\pi"])


def test_strip_image_tag(spark):
    check(spark, strip_image_tag, tag_twin, random_texts() + ["<image>", " <image> \n"])


def test_clean_ground_truth(spark):
    check(spark, clean_ground_truth, lambda text: text.strip("$").strip(), random_texts())
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(clean_ground_truth(F.col("s"))).first()[0] == ""


def test_prompt_prefix_and_names(spark):
    rows = [("ask: 1 + 1\n 2 ", "ask: 1 + 1"), ("2", "ask"), (" 2", None), ("ask", "ask"), (None, "ask")]
    df = spark.createDataFrame(rows, "g string, p string").coalesce(1)
    assert [r[0] for r in df.select(strip_prompt_prefix(F.col("g"), F.col("p"))).collect()] == ["2", "2", "2", "", None]
    paths = spark.createDataFrame([("a/b/c",), ("a/b//",), ("c",)], "p string").coalesce(1)
    assert [tuple(r) for r in paths.select(run_name(F.col("p")), report_name(F.col("p"))).collect()] == [
        ("c", "eval_c.json"),
        ("b", "eval_b.json"),
        ("c", "eval_c.json"),
    ]
    assert df.select(exact_equal(F.lit(" a\u00a0"), F.lit("a"))).first()[0]


def test_payloads(spark):
    df = spark.range(1).select(
        F.expr(
            "array(named_struct('role', 'user', 'content', 'a'), named_struct('role', 'x', 'content', ''), "
            "named_struct('role', 'y', 'content', cast(null as string)), named_struct('role', 'z', 'content', 'b'))"
        ).alias("plain"),
        F.expr(
            "array(named_struct('role', 'user', 'content', array(named_struct('type', 'image', 'text', 'no'), "
            "named_struct('type', 'text', 'text', 'a'), named_struct('type', 'text', 'text', ''))), "
            "named_struct('role', 'y', 'content', null), "
            "named_struct('role', 'z', 'content', array(named_struct('type', 'text', 'text', 'b'))))"
        ).alias("typed"),
    )
    assert df.select(text_messages(F.col("plain"))).first()[0] == "a\nb"
    assert df.select(text_chunks(F.col("typed"))).first()[0] == "a\nb"


def test_payloads_of_other_types(spark):
    df = spark.range(1).select(
        F.expr("array(map('role', 'user'), map('content', 'a'), map('content', 'b'))").alias("maps"),
        F.expr("array(map('content', array(named_struct('type', 'text', 'text', 'a'))))").alias("typed"),
        F.expr("array('<answer>5</answer>')").alias("loose"),
        F.expr("named_struct('role', 'x', 'content', 'a')").alias("single"),
        F.expr("cast(null as array<string>)").alias("nothing"),
    )
    texts = [completion_text(df, name) for name in df.columns]
    assert tuple(df.select(*texts).first()) == ("a\nb", "a", "", '{"role":"x","content":"a"}', None)


def test_mixed_payloads(spark):
    cases = {
        '"plain <answer>5</answer>"': "plain <answer>5</answer>",
        '[{"role":"a","content":"x"},{"role":"b","content":[{"type":"text","text":"y"},{"type":"image"}]}]': "x\ny",
        '[{"role":"a"},{"content":5},"loose",{"content":null},{"content":"z"}]': "z",
        "[]": "",
        "42": "42",
        "true": "True",
        '{"content":"x"}': '{"content":"x"}',
        "null": None,
    }
    df = spark.createDataFrame([(case,) for case in cases], "j string").coalesce(1)
    rows = df.select("j", text_variant(F.parse_json("j")).alias("got")).collect()
    assert {row.j: row.got for row in rows} == cases
