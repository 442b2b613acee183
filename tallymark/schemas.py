"""Explicit schemas of every table that enters or leaves the engine."""

from pyspark.sql import types as T

IMAGE = T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())])


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


PROBLEM = T.StructType(
    [
        T.StructField("idx", T.LongType()),
        T.StructField("problem", T.StringType()),
        T.StructField("answer", T.StringType()),
        T.StructField("images", T.ArrayType(IMAGE)),
    ]
)

SFT_SAMPLE = _strings("id", "image", "prompt", "completion", "ground_truth", "raw_answer", "completion_source")
RL_SAMPLE = _strings("id", "image", "prompt", "ground_truth", "raw_answer")
EVAL_ROW = _strings("id", "prediction", "predicted_answer", "ground_truth")
PREDICTION = _strings("id", "prompt_text", "generated")

COMPLETION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("gen", T.LongType()),
        T.StructField("completion", T.StringType()),
    ]
)

TEACHER = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("completion", T.StringType()),
    ]
)

MESSAGE = _strings("role", "content")
CHUNK = _strings("type", "text", "image")
TYPED_MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.ArrayType(CHUNK))]
)
