"""Ids by pre-tokens equal the library's on whole texts."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from threadlens.llm.pretokens import Encoder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
TEXTS = [
    "", " ", "\n\n", "  a", "a  ", "a \n b", "don't I'll 'sx ''s .'s 'S", "x<|endoftext|>y <|endoftext|>", "<|startoftext|>a", "<|endoftext|",
    "ÀÉß Œuvre Straße İstanbul ıd", "naïve é É", "²½Ⅷ١٢ ٣", "日本語 テスト 한국어", "привет Мир ΣΑΣ σας", "a\x1cb\x1fc\x85d\xa0e f　g", "😀😃 👩‍👩‍👧", "​﻿", "\x00\x01", "“quoted” — dash… €5",
    "᠎ᛮ\U0001e900\U00011f04", "a" * 5000, "1234567890" * 50, "!?" * 300, " ' s", " x y",
]


@pytest.mark.parametrize("name", FILES)
def test_named_cases(name):
    path = public_tokenizers.path(name)
    library, ours = Tokenizer.from_file(path), Encoder(path)
    for text in TEXTS + ["".join(TEXTS)] * 2:
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("name", FILES)
def test_random_text(name):
    path = public_tokenizers.path(name)
    library, ours = Tokenizer.from_file(path), Encoder(path, cache_size=50)
    chars = st.one_of(st.sampled_from(" \n\t'sdlv.,aZé0"), st.characters(exclude_categories=["Cs"]))

    @settings(max_examples=400, deadline=None)
    @given(st.text(chars, max_size=60))
    def same(text):
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids

    same()
