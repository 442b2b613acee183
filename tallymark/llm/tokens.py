"""Token ids of texts by a public tokenizer, as little-endian unsigned 32-bit numbers.

White space separates the tokenizer's words, and a word's ids depend on nothing around it, so each distinct word goes
through the library once and is remembered. That shortcut is taken for texts of characters whose classes and lower case
are beyond doubt; any other text, or one with a special token in it, is encoded by the library as a whole.
"""

from __future__ import annotations

import itertools
import os
import re
import sys
import types
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

END = 1
END_BYTES = END.to_bytes(4, "little")
# Words that a task keeps in memory.
REMEMBERED = 400_000
# Texts encoded together.
BATCH = 256

_PLAIN = re.compile("[\x00-\x1b\x20-\x84\x86-įı-ſ‐-‧€]*")
_WORD = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zªµºß-öø-ſ]+|[0-9²³¹¼-¾]|[^\\s0-9a-zª²³µ¹º¼-¾ß-öø-ſ]+")
#: What the shortcut relies on; a tokenizer with anything else is used as it is.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes: themselves where they are visible in Latin-1, else those from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in visible]
    return {b: chr(256 + i) for i, b in enumerate(others)}


_BYTES = _byte_characters()


class Encoder:
    """Encodes texts; null counts as empty."""

    def __init__(self, path: str):
        import json

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            about = json.load(file)
        model = about["model"]
        suffix = model.get("end_of_word_suffix")
        self.size = 1 + max(model["vocab"].values())
        self.size = max([self.size, *(1 + token["id"] for token in about["added_tokens"])])
        byte_level = '"ByteLevel"' in json.dumps(about["pre_tokenizer"])
        self._by_word = bool(suffix) and byte_level and _SPLIT in json.dumps(about["pre_tokenizer"]).replace("\\\\", "\\")
        self._special = [token["content"] for token in about["added_tokens"]]
        self._known: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self._library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn(self, new: Iterable[str]) -> None:
        """The ids of words, from the library's merges alone: what comes before those leaves a plain word as it is."""
        tokenize, known = self._library.model.tokenize, self._known
        for word in new:
            # The merges work on characters that stand for bytes; printable ASCII stands for itself.
            plain = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(_BYTES)
            known[word] = array("I", [token.id for token in tokenize(plain)]).tobytes()

    def forget(self) -> None:
        """Free the memory that words take."""
        self._known = {}

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        texts = ["" if text is None else text for text in texts]
        if not self._by_word:
            return self._whole(texts)
        plain = [_PLAIN.fullmatch(t) is not None and not any(s in t for s in self._special) for t in texts]
        split = [_WORD.findall(t.lower()) if p else () for t, p in zip(texts, plain)]
        new = set(itertools.chain.from_iterable(split)).difference(self._known)
        if len(self._known) + len(new) > REMEMBERED:
            self.forget()
            new = set(itertools.chain.from_iterable(split))
        self._learn(new)
        get = self._known.__getitem__
        out = [b"".join(map(get, words)) for words in split]
        rest = [i for i, p in enumerate(plain) if not p]
        if rest:
            for i, ids in zip(rest, self._whole([texts[i] for i in rest])):
                out[i] = ids
        return out


def worker_encoder(path: str) -> Encoder:
    """The encoder that this Python worker keeps between tasks: to make one takes longer than many a task."""
    held = sys.modules.setdefault("tallymark_worker", types.ModuleType("tallymark_worker"))
    encoders = vars(held).setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch (its column ``text``) in slices, with the ids of every text and the end id."""
    encoder = worker_encoder(path)
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            part = batch.slice(start, BATCH)
            ids = encoder.encode(part.column("text").to_pylist())
            yield part, [data + END_BYTES for data in ids]
    encoder.forget()
