from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

import public_tokenizers
from claimlake.llm.token_count import TokenCounter, count_tokens, merged, pre_token_pattern

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def size(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_same_counts_as_the_library(library):
    counter, pick = TokenCounter(FILE), random.Random(3)
    parts = [*"abcdethe  \n\t'é日ж!.²½³12 　\xa0\x1c\x85", "the", "  ", "'s", "'ll", "ation", "<|endoftext|>", "<|endof", "\U0001e5d0", "ꟈ"]
    for text in ["".join(pick.choices(parts, k=pick.randint(0, 40))) for _ in range(6000)] + ["ab" * 30_000 + "z", "a" * 5000, "\n" * 999]:
        assert counter.count(text) == size(library, text)


def test_whole_tokens_are_one_token(library):
    counter = TokenCounter(FILE)
    for token in random.Random(1).sample(sorted(counter.whole), 2000):
        assert len(merged(token.encode(), counter.bytes, counter.merges)) == 1
        if pre_token_pattern().fullmatch(token):
            assert size(library, token) == 1


def test_documents(edge_docs, edge_rows, no_docs, library, rows_of):
    found = rows_of(count_tokens(edge_docs, FILE, 1024))
    assert found == sorted(((r[0], len((r[1] or "").encode()), n := size(library, r[1]), n > 1024) for r in edge_rows), key=repr)
    assert count_tokens(no_docs, FILE, 1024).collect() == []


def test_memo_may_overflow(library, monkeypatch):
    monkeypatch.setattr("claimlake.llm.token_count.MEMO_SIZE", 3)
    counter = TokenCounter(FILE)
    text = " ".join(f"zq{n}x" for n in range(50))
    assert counter.count(text) == counter.count(text) == size(library, text)
