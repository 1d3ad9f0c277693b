"""The check of decoded ids sees an encoder that is wrong."""

from __future__ import annotations

import pytest

from dayfold.llm import bpe
from dayfold.llm.queries import tokenizer_file


def test_check_compares_letters():
    own = bpe.WordTokenizer(tokenizer_file("word_bpe_49k.json"))
    text = "Some words, x<|endoftext|>y 你好 it's"
    own.check(text, own.encode(text))
    right = own.encode_word
    wrong = bpe.WordTokenizer(tokenizer_file("word_bpe_49k.json"))
    wrong.encode_word = lambda word: right(word + "s")
    with pytest.raises(ValueError, match="do not decode"):
        wrong.check(text, wrong.encode(text))
