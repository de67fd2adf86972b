"""Texts that hold added tokens of the vocabulary, against a freshly loaded tokenizer."""

from __future__ import annotations

import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermend.llm.word_bpe import word_bpe

WORDS = public_tokenizers.path("word_bpe_49k.json")
FRESH = tokenizers.Tokenizer.from_file(WORDS)
PARTS = st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|end", "oftext|>", "a", "It's", "é", "漢", "9", " ", "\n", "\x85", "<", "|>"])


@pytest.mark.parametrize("text", ["<|endoftext|>", "ab<|endoftext|>cd", "x <|startoftext|><|endoftext|>'s y", "some words <|endoftext|> " * 9000])
def test_added_tokens_are_the_librarys(text):
    ids = word_bpe(WORDS).encode(text).tolist()
    assert ids == FRESH.encode(text, add_special_tokens=False).ids and 49407 in ids


@settings(max_examples=500, deadline=None)
@given(st.lists(PARTS, max_size=12).map("".join))
def test_any_mixture_is_the_librarys(text):
    assert word_bpe(WORDS).encode(text).tolist() == FRESH.encode(text, add_special_tokens=False).ids
