import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerflow.llm import wavelet
from ledgerflow.llm.wavelet import Shard, UnitEncoder, WaveletMatrix, read_documents, write_shards

FILE = public_tokenizers.path("byte_bpe_50k.json")
EDGE = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", "\n x", "x\t y", "x  y", "x　 y z", "it's  100% ok",
        "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b c", "日本 語", "é è", "\U0001f600 \U0001f600", "x" * 5000,
        "word " * 2000, "\x1c a \x85 b", "</s> [INST]", "a  b"]


def test_matrix_against_plain_lists():
    rng = np.random.default_rng(1)
    for n, width in ((0, 3), (1, 1), (5000, 4), (9001, 16)):
        ids = rng.integers(0, min(2 ** width, 50), n).astype(np.uint32)
        m = WaveletMatrix.build(ids, width)
        plain = ids.tolist()
        assert m.ids().tolist() == plain
        for i in range(0, n, 997):
            assert m.access(i) == plain[i]
        for v in (0, 1, 7, 49, 2 ** width):
            where = [i for i, x in enumerate(plain) if x == v]
            assert m.count(v) == len(where) and m.rank(v, n // 2) == sum(i < n // 2 for i in where)
            assert [m.select(v, k) for k in range(0, len(where), 17)] == where[::17]
        assert m.occurrences(3) == [i for i, x in enumerate(plain) if x == 3]
    with pytest.raises(IndexError):
        m.access(n)


def test_shard_file_round_trip():
    ids = [np.array(x, "<u4").tobytes() for x in ([5, 6, 2], [2], [9] * 3000 + [2])]
    shard = Shard.from_bytes(Shard.build([3, None, 7], ids, 4).to_bytes())
    assert shard.doc_ids == [3, None, 7] and shard.ends.tolist() == [3, 4, 3005]
    assert shard.matrix.count(9) == 3000 and shard.matrix.access(0) == 5 and shard.matrix.select(2, 2) == 3004
    with pytest.raises(ValueError):
        Shard.from_bytes(b"nothing of the kind" * 3)


def test_units_equal_whole_texts():
    tok = Tokenizer.from_file(FILE)
    got = UnitEncoder(tok.to_str(), 2).encode([*EDGE, None])
    for text, one in zip([*EDGE, ""], got):
        assert np.frombuffer(one, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids + [2], repr(text)


def test_random_units_equal_the_library():
    """Letters, numbers, signs, marks and control strings in any order, by both encoders."""
    tok = Tokenizer.from_file(FILE)
    rng = random.Random(5)
    bits = ["a", "Z", "é", "ß", "Ɏ", "ɐ", "я", "日", "\u0301", "1", "½", "²", "'s", "'LL", "'", ".", "!!", "-", "_", "\xa0", "\x85", "\x1c",
            "\x00", "\x7f", "\n", "\t", " ", " ", " ", "the", "ing", "<|endoftext|>", "</s>", "\U0001f600", "ª", "ĸ", "\xad"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 40))) for _ in range(4000)]
    encoder = UnitEncoder(tok.to_str(), 2)
    assert encoder.ranked is not None
    for k in range(0, len(texts), 100):
        for text, one in zip(texts[k:k + 100], encoder.encode(texts[k:k + 100])):
            assert np.frombuffer(one, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids + [2], repr(text)


def test_a_file_with_merges_in_another_order_goes_to_the_library():
    config = json.loads(Tokenizer.from_file(FILE).to_str())
    config["model"]["merges"] = config["model"]["merges"][::-1]
    other = json.dumps(config)
    encoder, tok = UnitEncoder(other, 2), Tokenizer.from_str(other)
    assert encoder.ranked is None
    got, = encoder.encode(["words of another order"])
    assert np.frombuffer(got, "<u4").tolist() == tok.encode("words of another order", add_special_tokens=False).ids + [2]


def test_documents_in_order(spark, frame, monkeypatch):
    tok = Tokenizer.from_file(FILE)
    rows = [((i * 7) % 53, t, "x") for i, t in enumerate(EDGE * 2)] + [(1000, None, "y"), (None, "none", "z"), (4, "again", "z")]
    path = write_shards(frame(rows, "doc_id long, text string, part string"), FILE, 2, shard_tokens=900)
    assert spark.read.parquet(path).count() >= 2
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in read_documents(spark, path).collect())
    want, start = [], 0
    for i, t, _ in sorted(rows, key=lambda r: (r[0] if r[0] is not None else -1, r[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    empty = write_shards(frame([], "doc_id long, text string"), FILE, 2)
    assert read_documents(spark, empty).collect() == []
