"""Text columns: payloads to text, answer extraction, prompt cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.fixed import ANSWER_BLOCK, IMAGE_TAG, WHITESPACE, WHITESPACE_CLASS


def strip(text: Column) -> Column:
    """Drop Unicode whitespace at both ends (``F.trim`` alone drops only blanks)."""
    return F.btrim(text, F.lit(WHITESPACE))


def text_plain(payload: Column) -> Column:
    """A payload that is already text."""
    return payload


def _join_parts(parts: Column) -> Column:
    return F.array_join(F.filter(parts, lambda part: part != ""), "\n")


def text_messages(messages: Column) -> Column:
    """Non-empty contents of ``array<struct<role, content string>>``, one per line."""
    return _join_parts(F.transform(messages, lambda message: message["content"]))


def text_chunks(messages: Column) -> Column:
    """Like :func:`text_messages`, where each content is an array of typed chunks."""

    def texts(message: Column) -> Column:
        kept = F.filter(F.coalesce(message["content"], F.array()), lambda chunk: chunk["type"] == "text")
        return F.transform(kept, lambda chunk: chunk["text"])

    return _join_parts(F.flatten(F.transform(messages, texts)))


def text_variant(payload: Column) -> Column:
    """Text of a VARIANT payload of any of the shapes above.

    Any other value gives its own text: JSON for an object, ``True``/``False`` for a boolean.
    """

    def kind(value: Column) -> Column:
        return F.schema_of_variant(value)

    def texts(item: Column) -> Column:
        content = F.try_variant_get(item, "$.content", "variant")
        chunks = F.try_variant_get(content, "$", "array<variant>")
        kept = F.filter(chunks, lambda chunk: F.try_variant_get(chunk, "$.type", "string") == "text")
        return (
            F.when(kind(content) == "STRING", F.array(F.try_variant_get(content, "$", "string")))
            .when(
                kind(content).startswith("ARRAY"),
                F.transform(kept, lambda chunk: F.try_variant_get(chunk, "$.text", "string")),
            )
            .otherwise(F.array().cast("array<string>"))
        )

    items = F.try_variant_get(payload, "$", "array<variant>")
    return (
        F.when(kind(payload) == "STRING", F.try_variant_get(payload, "$", "string"))
        .when(kind(payload).startswith("ARRAY"), _join_parts(F.flatten(F.transform(items, texts))))
        .when(kind(payload).startswith("OBJECT"), F.to_json(payload))
        .when(kind(payload) == "BOOLEAN", F.initcap(F.try_variant_get(payload, "$", "string")))
        .otherwise(F.try_variant_get(payload, "$", "string"))
    )


def completion_text(df: DataFrame, name: str = "completion") -> Column:
    """Text of a payload column, whatever its type: text, messages (structs or maps), messages of chunks, or VARIANT.

    Other lists have no text; a single struct or map gives its JSON, any other value its own text.
    """
    kind, payload = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.MapType):
        # Maps are messages by their key "content"; a map of text has no chunks.
        contents = F.transform(payload, lambda message: F.struct(F.try_element_at(message, F.lit("content")).alias("content")))
        value = kind.elementType.valueType
        if isinstance(value, T.StringType):
            return text_messages(contents)
        return text_chunks(contents) if isinstance(value, T.ArrayType) else F.when(payload.isNotNull(), F.lit(""))
    if isinstance(kind, T.StringType):
        return text_plain(payload)
    if isinstance(kind, T.VariantType):
        return text_variant(payload)
    message = kind.elementType if isinstance(kind, T.ArrayType) else None
    if isinstance(message, T.StructType) and "content" in message.names:
        of_chunks = isinstance(message["content"].dataType, T.ArrayType)
        return text_chunks(payload) if of_chunks else text_messages(payload)
    if isinstance(kind, T.ArrayType):
        # Items that are no messages say nothing.
        return F.when(payload.isNotNull(), F.lit(""))
    return F.to_json(payload) if isinstance(kind, (T.StructType, T.MapType)) else payload.cast("string")


def extract_answer(text: Column) -> Column:
    """Content of the first answer block: NULL without one, ``''`` for an empty one.

    The pattern is anchored, goes from one ``<`` to the next and never back, so that its cost
    stays linear in the length of the text.
    """
    return strip(F.get(F.regexp_extract_all(text, F.lit(ANSWER_BLOCK), F.lit(1)), F.lit(0)))


def has_answer(text: Column) -> Column:
    """Whether the text holds an answer block.

    Spelled with the extraction, so that a plan that needs both searches the text once.
    """
    return extract_answer(text).isNotNull()


def strip_image_tag(text: Column) -> Column:
    """Remove picture placeholders; where nothing else is left, keep the text as it was."""
    cleaned = strip(F.regexp_replace(text, f"(?iu){IMAGE_TAG}{WHITESPACE_CLASS}*", ""))
    return F.when(cleaned != "", cleaned).otherwise(strip(text))


def strip_prompt_prefix(generated: Column, prompt: Column) -> Column:
    """Remove the prompt where the generation repeats it."""
    rest = generated.substr(F.length(prompt) + 1, F.length(generated))
    return strip(F.when(F.startswith(generated, prompt), rest).otherwise(generated))


def exact_equal(left: Column, right: Column) -> Column:
    """Equal up to whitespace at the ends, with no other normalisation."""
    return strip(left) == strip(right)


def run_name(model_path: Column) -> Column:
    """Last component of a model path."""
    return F.substring_index(F.rtrim(model_path, F.lit("/")), "/", -1)


def report_name(model_path: Column) -> Column:
    """File name of the report of a run."""
    return F.concat(F.lit("eval_"), run_name(model_path), F.lit(".json"))
