"""The encoder of byte-level vocabularies against the library the file is written for."""

from functools import lru_cache

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm.bytelevel import byte_level_encoder
from workloads.registry import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = st.sampled_from([" ", "  ", "\n", " \n", "\t", "\r\n", "\x1c", "　", "a", "don't", "I'LL", "12", "x9", "é", "日本", "🙂", "...", "<|endoftext|>", "<|endof"])


@lru_cache
def library(specials):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = not specials
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("specials", [False, True])
def test_ids(spark, sf_dir, specials):
    texts = [r.text or "" for r in table(spark, sf_dir, "documents").collect()]
    texts += ["", " " * 1_500_000, "x" * 200_000, "a <|endoftext|>  b<|endoftext|>"]
    assert byte_level_encoder(PATH, specials)(texts) == library(specials)(texts)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(PARTS, st.text(max_size=4)), max_size=15), st.booleans())
def test_random_texts(parts, specials):
    text = "".join(parts)
    assert byte_level_encoder(PATH, specials)([text]) == library(specials)([text])


def test_other_vocabularies_go_to_their_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    text = "Some Words, in CAPITALS"
    assert byte_level_encoder(path, True)([text]) == [Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids]
