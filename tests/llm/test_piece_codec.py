import random

import public_tokenizers
import pytest
import sentencepiece

from ledgerflow.llm.piece_codec import PieceCodec, decode_column, digest, encode_column

MODEL = public_tokenizers.path("piece_bpe_32k.model")
EDGE = ["", " ", "  ", "a", " a", "a ", "\n", "\t\t", "▁", "a▁b", "▁▁ a", "</s><s>", "<0x41>", "\x00", "日本語 ß é",
        "\U0001f600 \U0001f600", "a b", "é", " " * 77, "=" * 130, "q" * 5000, "word " * 3000,
        "The end.\n\nThe  end.", "[INST] x [/INST]", "<unk>"]
LINES = ["\n", "\n\n", "a\n", "\na", "a\nb", "one two\nthree four\n\nfive", "a \nb", "a\n b", "x\n \ny", "\n \n", "a\r\nb", "é\n日本 ß\n\U0001f600"]


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    with open(MODEL, "rb") as f:
        return PieceCodec(f.read())


def test_equal_to_library(codec, lib):
    rnd = random.Random(5)
    pieces = [*codec.ids] + EDGE * 400
    made = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 9))).replace("▁", rnd.choice(["▁", " "]))
            for _ in range(1500)]
    for text in EDGE + made:
        ids = codec.encode(text)
        assert ids == lib.encode(text), repr(text)
        assert codec.decode_bytes(ids).decode() == lib.decode(ids), repr(text)


def test_any_ids_decode_like_the_library(codec, lib):
    rnd = random.Random(6)
    for _ in range(400):
        ids = [rnd.randrange(0, 300 if rnd.random() < .7 else 32000) for _ in range(rnd.randint(0, 12))]
        assert codec.decode_bytes(ids).decode() == lib.decode(ids), ids


def test_columns(frame, lib):
    rows = [(i, t, "x", 1) for i, t in enumerate(EDGE)] + [(99, None, None, None), (0, "", "x", 1)]
    df = encode_column(frame(rows, "doc_id long, text string, piece string, unit int"), MODEL)
    got = decode_column(df, MODEL)
    assert got.columns == ["doc_id", "text", "piece", "unit", "ids", "decoded"]
    for r in got.collect():
        assert r.ids == lib.encode(r.text or "") and r.decoded == lib.decode(r.ids)
    assert digest(got).filter("doc_id = 99").collect()[0].n_tokens == 0
    empty = frame([], "doc_id long, text string")
    assert decode_column(encode_column(empty, MODEL), MODEL).collect() == []
    assert encode_column(df, MODEL).columns == df.columns


def test_lines_share_the_words_of_texts_without_line_breaks(codec, lib):
    rnd = random.Random(8)
    made = ["".join(rnd.choice([" ", "\n", "a", "The", "ße", "日", "\t"]) for _ in range(rnd.randint(1, 12))) for _ in range(800)]
    for text in LINES + made:
        ids = codec.encode(text)
        assert ids == lib.encode(text) and codec.decode_bytes(ids).decode() == lib.decode(ids), repr(text)
    codec.encode("alpha beta gamma")
    codec.encode("first\ngamma")
    known = len(codec._words), len(codec._other)
    codec.encode("alpha beta\ngamma alpha\ngamma beta")      # a word and a line break are no unit
    assert (len(codec._words), len(codec._other)) == known


def test_frequent_words_outlive_a_full_memory(lib, monkeypatch):
    from ledgerflow.llm import piece_codec as P
    monkeypatch.setattr(P, "REMEMBER_WORDS", 8)
    monkeypatch.setattr(P, "REMEMBER_PAIRS", 6)
    with open(MODEL, "rb") as f:
        codec = PieceCodec(f.read())
    asked, plain = [], codec.unit_ids
    codec.unit_ids = lambda unit: asked.append(unit) or plain(unit)
    for k in range(50):
        text = f"often word{k} often n{k}"
        assert codec.encode(text) == lib.encode(text)
    assert asked.count("▁often") == 1 and len(codec._words) + len(codec._words.before) <= 8
