"""Ids and decoded texts against the tokenizers library on whole texts: every code point, and random strings."""

import random

import numpy as np
import pytest

from marketlake.llm import backtrack_bpe, token_files
from marketlake.llm.queries import tokenizer_file

BPE = tokenizer_file("word_bpe_49k.json")


def random_texts():
    rng = random.Random(1)
    plain = list(map(chr, range(0x300))) + list("  ''\n\tstrevemlld") * 20
    mixed = list(map(chr, list(range(0x250)) * 3 + list(range(0x250, 0x3000)) + [0x301, 0x345, 0x1E9E, 0x130, 0x3A3, 0xAC00, 0x1100, 0x1161] * 50 + [0x20, 0x9, 0xA, 0x85, 0xA0, 0x1C, 0x2028] * 60))
    out = ["".join(rng.choices(pool, k=rng.randint(1, 30))) for pool in (plain, mixed) for _ in range(20_000)]
    out += ["".join(rng.choices("abcdeerstin 's'tll", k=rng.randint(1, 60))) for _ in range(12_000)]
    return [*out, "<|endoftext|>é<|startoftext|>a <|EndOfText|> <|<|endoftext|>", "ab" * 5000, "a" * 3000, "Ɛwe Ɓasa Ɗan Ƒ", "", "́a ́"]


def code_points():
    return [f"ab{chr(c)}Ab" for c in range(0x20000) if not 0xD800 <= c < 0xE000]


@pytest.mark.parametrize("made", [code_points, random_texts])
def test_same_as_the_library(made):
    from tokenizers import Tokenizer

    lib, texts = Tokenizer.from_file(BPE), made()
    want = [x.ids for x in lib.encode_batch(texts, add_special_tokens=False)]
    own = backtrack_bpe.Encoder(BPE)
    for e in (own, token_files.LibraryEncoder(BPE)):
        got = [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)]
        assert [ascii(t) for t, a, b in zip(texts, got, want, strict=True) if a != b] == []
    flat = np.array([i for x in want for i in x], np.int64)
    decoded = own.decode(flat, np.array([len(x) for x in want]))
    assert [x.decode() for x in decoded] == lib.decode_batch(want, skip_special_tokens=False)


def test_null_and_empty_texts():
    for e in (backtrack_bpe.Encoder(BPE), token_files.LibraryEncoder(BPE)):
        assert e.encode([None, "", " \n"]) == [b"", b"", b""]
