from __future__ import annotations

import random

import pytest
import sentencepiece

import public_tokenizers
from claimlake.llm.pieces import BLANK, BYTE, CONTROL, NORMAL, UNIGRAM, UNKNOWN, PieceCodec, decode_texts, encode_texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts(n):
    pick = random.Random(2)
    parts = [*"abcdethe  \n\t▁é日ж!.<𐍈", "the", "  ", "     ", "ation", "<s>", "<0x0A>", "ing "]
    return ["".join(pick.choices(parts, k=pick.randint(0, 40))) for _ in range(n)]


def test_same_ids_as_the_library(library):
    codec = PieceCodec(MODEL)
    for text in [*texts(4000), *(" " * n for n in range(50)), "ab" * 30_000]:
        assert codec.encode(text) == library.encode(text)
        assert codec.decode(codec.encode(text)) == text.replace(BLANK, " ")


def test_unigram_models_take_the_highest_sum():
    codec = PieceCodec.__new__(PieceCodec)
    pieces = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL), (BLANK, -2.0, NORMAL), ("a", -1.5, NORMAL), ("b", -1.7, NORMAL), ("ab", -2.9, NORMAL), ("ba", -3.4, NORMAL), (BLANK + "a", -2.5, NORMAL)]
    codec.__setstate__({"pieces": pieces, "model_type": UNIGRAM})
    scores = {p: s for p, s, kind in pieces if kind == NORMAL}

    def best(text):  # over all splits
        if not text:
            return 0.0
        return max([scores[text[:k]] + best(text[k:]) for k in range(1, len(text) + 1) if text[:k] in scores], default=-1e9)

    pick = random.Random(1)
    for _ in range(300):
        text = "".join(pick.choices("ab ", k=pick.randint(1, 9))).replace("  ", " ")
        ids = codec.encode(text)
        assert codec.decode(ids) == text
        assert sum(pieces[i][1] for i in ids) == pytest.approx(best(BLANK + text.replace(" ", BLANK)))
    assert codec.encode("xyz") == [2, 0]  # unknown characters side by side are one piece
    codec.__setstate__({"pieces": [*pieces, *((f"<0x{b:02X}>", 0.0, BYTE) for b in range(256))], "model_type": UNIGRAM})
    assert codec.decode(codec.encode("aé日b")) == "aé日b"


def test_documents(spark, edge_docs, edge_rows, no_docs, library, rows_of):
    coded = encode_texts(edge_docs, MODEL)
    want = sorted(((r[0], len(ids := library.encode(r[1] or "")), ids, True) for r in edge_rows), key=repr)
    assert rows_of(coded) == want
    assert encode_texts(no_docs, MODEL).collect() == []
    back = decode_texts(coded, MODEL).select("doc_id", "text")
    assert rows_of(back) == sorted(((r[0], (r[1] or "").replace(BLANK, " ")) for r in edge_rows), key=repr)
