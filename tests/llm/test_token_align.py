"""Cross-tokenizer alignment against brute force over byte ranges."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb
from tokenizers import Tokenizer

from ledgerflow.llm import token_align as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "tab\there", "x▁y", "<|endoftext|> and </s> <s> <unk>",
       "naïve café über", "नमस्ते 你好 \U0001f600\U0001f601", "it's we'll I'd", " nbsp   x", "\x1c y \x1c",
       "line\r\nline\n\n\nline", "0123456789 3.14 1,000", "same words same words", "same words same words", "\x00 \x07", "é ́x"]


@pytest.fixture(scope="module")
def libs():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    proto = pb.ModelProto()
    proto.ParseFromString(open(B, "rb").read())
    chars = ta._byte_of_char()
    words = {i: bytes(chars[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items() if all(c in chars for c in t)}
    pieces = [bytes([int(p.piece[3:5], 16)]) if p.type == p.BYTE else p.piece.replace("▁", " ").encode() for p in proto.pieces]
    return a, sentencepiece.SentencePieceProcessor(model_file=B), words, pieces


def brute_force(rows, libs):
    a_lib, b_lib, words, pieces = libs
    documents = []
    for doc_id, text in rows:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if b"".join(words[i] for i in a) != whole or b"".join(pieces[i] for i in b) != whole:
            a, b = [], []

        def ranges(ids, sizes):
            at, got = 0, []
            for i in ids:
                got.append((i, at, at + len(sizes[i])))
                at += len(sizes[i])
            return got
        ra, rb = ranges(a, words), ranges(b, pieces)
        cuts = sorted({e for _, _, e in ra} & {e for _, _, e in rb})
        links = [(i, j) for i, s, e in ra for j, t, f in rb if s < f and t < e]
        text_of = []
        start = 0
        for cut in cuts:
            text_of.append("|".join(",".join(str(i) for i, s, e in r if start < e <= cut) for r in (ra, rb)))
            start = cut
        documents.append((doc_id, len(a), len(b), len(cuts), links,
                          hashlib.sha256(";".join(text_of).encode()).hexdigest() if a else ""))
    counts = Counter(p for d in documents for p in set(d[4]))
    top = defaultdict(int)
    for (i, _), n in counts.items():
        top[i] = max(top[i], n)
    return [(d, na, nb, ng, len(links), sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links), sha)
            for d, na, nb, ng, links, sha in documents]


def _key(row):
    return tuple(-1 if v is None else v for v in row)


@pytest.mark.parametrize("work,links", [(3, 40), (1 << 15, 1 << 21)])
def test_equals_brute_force(frame, libs, work, links):
    texts = ODD + ["the quick brown fox jumps over the lazy dog " * k for k in (1, 3, 5)]
    rows = [(k if k % 7 else None, t) for k, t in enumerate(texts)] + [(3, "same words same words"), (3, "other")]
    df = frame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, block int, pairs string")
    got = ta.align(df, A, B, block_links=links, piece_work=work).collect()
    assert sorted(map(_key, got)) == sorted(map(_key, brute_force(rows, libs)))


def test_random_texts(libs, frame):
    rng = np.random.default_rng(5)
    alphabet = list("aeiouthns  .,'\néßह́中") + ["\U0001f600"]
    rows = [(k, "".join(rng.choice(alphabet, rng.integers(0, 60)))) for k in range(150)]
    got = ta.align(frame(rows, "doc_id long, text string"), A, B, block_links=500, piece_work=17).collect()
    assert sorted(map(tuple, got)) == sorted(brute_force(rows, libs))


@pytest.mark.parametrize("seed", range(4))
def test_any_pieces_give_the_whole_merge(seed):
    rng = np.random.default_rng(seed)
    total = 400
    a, b = (np.unique(np.append(rng.integers(1, total, rng.integers(0, 200)), total)) for _ in range(2))
    want = ta.overlaps(a, b, 1 << 20)
    assert len(want[0]) == len(np.union1d(a, b)) and want[2][-1] == len(np.intersect1d(a, b)) - 1
    for work in (1, 2, 3, 7, 64):
        assert all((x == y).all() for x, y in zip(ta.overlaps(a, b, work), want))
        at = np.arange(0, len(a) + len(b), work)
        merged = np.sort(np.concatenate([a * 2, b * 2 + 1]))[:, None]
        assert [int((merged[:d] % 2 == 0).sum()) for d in at] == ta.diagonals(a, b, at).tolist()


def test_empty_table_and_long_text(spark, libs):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ta.align(empty, A, B).collect() == []
    text = "the same words and some others, again " * 3000
    row, = ta.align(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B).collect()
    a, b = libs[0].encode(" " + text, add_special_tokens=False).ids, libs[1].encode(text)
    assert (row.n_a, row.n_b) == (len(a), len(b)) and row.n_links == row.n_a + row.n_b - row.n_groups == row.count_sum
