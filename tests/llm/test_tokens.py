from __future__ import annotations

import functools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymark.llm import packing, token_output
from tallymark.llm.tokens import Encoder, vocabulary

from tests.llm.samples import docs, prose

TEXTS = [
    None,
    "",
    " \n\t",
    "Hello, WORLD's best don't 'soup ''s 123 4½ x²",
    "İstanbul ΣΑΣ <|endoftext|> ok",
    "Ⱥ ſtraße ŉ Ÿ naïve\x1cfoo\x85bar baz  x",
    "é combining ́start",
    "日本語 \U0001f600 mixed with words",
    "“quoted” — dash… €5",
    prose(3, 9_000),
    "a" * 50_000,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(library):
    encoder = Encoder(vocabulary())
    for texts in (TEXTS, TEXTS[::-1]):
        got = [np.frombuffer(data, "<u4").tolist() for data in encoder.encode(texts)]
        assert got == [ids_of(library, t) for t in texts]


@functools.cache
def both():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary()), Encoder(vocabulary())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x2100, exclude_categories=["Cs"]), max_size=40), max_size=4))
def test_encoder_equals_the_library_on_any_text(texts):
    library, encoder = both()
    assert [np.frombuffer(d, "<u4").tolist() for d in encoder.encode(texts)] == [ids_of(library, t) for t in texts]


def test_encoder_with_another_vocabulary():
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), Encoder(path)
    assert [np.frombuffer(d, "<u4").tolist() for d in encoder.encode(TEXTS)] == [ids_of(library, t) for t in TEXTS]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=70))
def test_variable_length_codes_round_trip(numbers):
    control, data = token_output.encode_numbers(np.array(numbers, "<u4"))
    assert len(control) == -(-len(numbers) // 4)
    assert token_output.decode_numbers(control, data, len(numbers)).tolist() == numbers


ROWS = [(100 - i, t) for i, t in enumerate(TEXTS)] + [(50, "repeated row"), (50, "repeated row"), (50, "another"), (None, "no id")]


def expected(library):
    rows = [(i, np.array([*ids_of(library, t), 1], "<u4").tobytes()) for i, t in ROWS]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, np.frombuffer(r[1], "<u4").astype("<u2").tobytes()))
    out, at = [], 0
    for i, data in rows:
        out.append((i, at, len(data) // 4, zlib.crc32(data)))
        at += len(data) // 4
    return sorted(out, key=repr)


def test_files_hold_all_ids_in_order(spark, library, monkeypatch):
    monkeypatch.setattr(token_output, "FILE_IDS", 5_000)
    folder = token_output.write_tokens(docs(spark, ROWS))
    got = token_output.digest(token_output.read_tokens(spark, folder)).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=repr) == expected(library)


def test_no_documents(spark):
    folder = token_output.write_tokens(docs(spark, []))
    assert token_output.read_tokens(spark, folder).count() == 0
    assert packing.pack(docs(spark, [])).count() == 0


def test_frequent_ids_are_small(spark, library):
    tokens = token_output.token_ids(docs(spark, [(1, "b b b a a c"), (2, "a a a")]), vocabulary())
    ranked = token_output.ranked_ids(tokens, 49_408)
    a, b, c = (ids_of(library, w)[0] for w in "abc")
    assert ranked[:2] == [a, b] and set(ranked[2:4]) == {1, c} and sorted(ranked) == list(range(49_408))


def check_plan(lengths, capacity):
    room: dict[int, list] = {}
    ranks: dict[int, set] = {}
    for length, first, n, sequence, offset, each in packing.plan(lengths, capacity):
        for k in range(n):
            room.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
            assert first + k not in ranks.setdefault(length, set())
            ranks[length].add(first + k)
    assert {k: len(v) for k, v in ranks.items()} == {k: v for k, v in lengths.items() if v}
    for places in room.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(room) == list(range(len(room)))
    return len(room)


def one_by_one(lengths, capacity):
    rooms: list[int] = []
    for length in sorted((k for k, v in lengths.items() for _ in range(v)), reverse=True):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - length)
        else:
            rooms.append(capacity - length)
    return len(rooms)


def test_plan_is_best_fit():
    pick = random.Random(4)
    for capacity in (7, 20, 100):
        for _ in range(60):
            lengths = {pick.randint(1, capacity): pick.randint(1, 30) for _ in range(pick.randint(1, 12))}
            assert check_plan(lengths, capacity) == one_by_one(lengths, capacity)
    assert check_plan({}, 10) == 0
    with pytest.raises(ValueError):
        packing.plan({11: 1}, 10)


def test_packing(spark, library):
    rows = packing.pack(docs(spark, ROWS * 5)).collect()
    want = []
    for doc_id, text in ROWS * 5:
        ids = np.array([*ids_of(library, text), 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.append((doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(want, key=repr)
    places: dict[int, list] = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(places) == one_by_one({k: sum(w[3] == k for w in want) for k in {w[3] for w in want}}, 4096)
