"""SentencePiece (merge type) encoding and decoding.

Encoding finds the merge result without merging the text: Aho-Corasick lists
the longest vocabulary piece at each position, pieces are laid end to end, and
a piece may follow another only if re-merging the two alone gives the same two
pieces.  A position from which nothing fits is marked in a bit field, the last
piece is taken back and its next shorter prefix is tried; marked positions are
never entered again, so the work stays linear in the text.

No piece has the space mark after another character (checked on the model), so
no merge crosses from a word into the next space: each unit of a space run and
the word behind it is encoded alone and remembered.  A model with other pieces
is encoded text by text.  Where no piece joins a line break to another character,
no merge crosses one either: lines are encoded one by one, or else the last word of
a line and the first of the next would be one unit that hardly ever comes again.

Supported: merge-type models with the identity normaliser; anything else raises
ValueError.  Defined results: null and empty texts give no ids and decode to an
empty text; characters outside the vocabulary become byte pieces, or the
unknown id if the model has none; control strings such as ``</s>`` inside a
text are ordinary characters; decoding gives the text with U+2581 read as a
space; rows repeat as they come; other columns are kept, one named like the output is
replaced.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import chain, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import arrow_column

SPACE = "▁"
UNKNOWN = "�"
#: Entries a worker remembers of words and of piece pairs: half of them new, half the ones before,
#: of which those asked for again become new, so frequent ones are never lost.
REMEMBER_WORDS, REMEMBER_PAIRS = 150_000, 300_000
#: More than there are pieces and characters.
PAIR = 1 << 21


class _Units(dict):
    """Ids of the units seen so far, behind one mark each."""

    def __init__(self, codec: PieceCodec, mark: str):
        super().__init__()
        self.codec, self.mark = codec, mark
        self.before: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        got = self.before.get(unit)
        if got is None:
            got = self.codec.unit_ids(self.mark + unit)
        if len(self) >= REMEMBER_WORDS // 2:
            self.before = dict(self)
            self.clear()
        self[unit] = got
        return got


class PieceCodec:
    """Exact encoder and decoder for one model."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm, kind = proto.normalizer_spec, proto.trainer_spec
        if kind.model_type != kind.BPE:
            raise ValueError("only merge-type (BPE) models are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces \
                or kind.treat_whitespace_as_suffix:
            raise ValueError("only the identity normaliser with escaped spaces is supported")
        piece = pb.ModelProto.SentencePiece
        if any(p.type in (piece.USER_DEFINED, piece.UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.dummy_prefix = norm.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == piece.NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == piece.NORMAL}
        self.unk = next(i for i, p in enumerate(proto.pieces) if p.type == piece.UNKNOWN)
        by_value = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == piece.BYTE}
        self.byte_ids = [by_value[b] for b in range(256)] if kind.byte_fallback else None
        self.by_words = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.by_lines = not any("\n" in p and p != "\n" for p in self.ids)

        #: Every token by number: the pieces, then characters outside the vocabulary as they come.
        self.tokens = [p.piece for p in proto.pieces]
        self.n_pieces = len(self.tokens)
        self.sizes = [len(t) for t in self.tokens]
        self.outside: dict[str, int] = {}
        self.find = ahocorasick.Automaton()
        self.shorter = [-1] * self.n_pieces
        for p, i in self.ids.items():
            self.find.add_word(p, (len(p) - 1, i))
            self.shorter[i] = next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), -1)
        self.find.make_automaton()

        self.surface = [b""] * len(proto.pieces)       # of each id, as bytes
        self.byte_of = {}
        for i, p in enumerate(proto.pieces):
            if p.type == piece.NORMAL:
                self.surface[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == piece.BYTE:
                value = self.byte_of[i] = int(p.piece[3:5], 16)
                # ASCII stands for itself in any run; a space is left out, for the one before a text
                self.surface[i] = bytes([value]) if value < 0x80 and value != 0x20 else None
            elif p.type == piece.UNKNOWN:
                self.surface[i] = kind.unk_surface.encode()
        self._fits: dict[int, bool] = {}
        self._fits_before: dict[int, bool] = {}
        self._words = _Units(self, SPACE)          # of words, without the mark before them
        self._other = _Units(self, "")
        self._break = self.unit_ids("\n") if self.by_lines else b""

    # -- encoding ---------------------------------------------------------
    def merged(self, text: str) -> list[str]:
        """The merge result by definition; for pairs of pieces only."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, last: int, token: int) -> bool:
        """Whether ``token`` may follow ``last`` (-1: start a text)."""
        key = (last + 1) * PAIR + token
        known = self._fits.get(key)
        if known is None:
            known = self._fits_before.get(key)
        if known is None:
            text = self.tokens[token]
            if last < 0:
                known = self.merged(text) == [text]
            else:
                before = self.tokens[last]
                known = self.fits(-1, last) and self.fits(-1, token) and self.merged(before + text) == [before, text]
        if len(self._fits) >= REMEMBER_PAIRS // 2:
            self._fits_before = dict(self._fits)
            self._fits.clear()
        self._fits[key] = known
        return known

    def _outside(self, char: str) -> int:
        got = self.outside.get(char)
        if got is None:
            got = self.outside[char] = len(self.tokens)
            self.tokens.append(char)
            self.sizes.append(1)
            self.shorter.append(-1)
        return got

    def pieces(self, text: str) -> list[int]:
        """Tokens of a text: backtracking over longest matches."""
        n, sizes, shorter, checked = len(text), self.sizes, self.shorter, self._fits
        longest = [-1] * n
        for end, (back, i) in self.find.iter(text):     # ends ascend: the last piece from a place is its longest
            longest[end - back] = i
        failed = bytearray(n + 1)
        out: list[int] = []
        pos = 0
        token = last = -1
        while pos < n:
            if token < 0:
                token = longest[pos]
                if token < 0:                  # a character outside the vocabulary stands alone
                    token = self._outside(text[pos])
            start = (last + 1) * PAIR
            while token >= 0:
                end = pos + sizes[token]
                if not failed[end]:
                    fits = checked.get(start + token)
                    if fits is None:
                        fits = self.fits(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos, last, token = end, token, -1
                continue
            if not out:
                raise ValueError("no merge result covers this text")
            failed[pos] = 1                    # nothing fits here: take the last piece back, shorten it
            token = out.pop()
            pos -= sizes[token]
            last = out[-1] if out else -1
        return out

    def unit_ids(self, unit: str) -> bytes:
        got, n = self.pieces(unit), self.n_pieces
        if not got or max(got) < n:
            return array("i", got).tobytes()
        ids = array("i")
        for i in got:
            if i < n:
                ids.append(i)
            elif self.byte_ids is not None:
                ids.extend(self.byte_ids[b] for b in self.tokens[i].encode())
            else:
                ids.append(self.unk)
        return ids.tobytes()

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if self.by_words and self.dummy_prefix and text[0] != " " and "  " not in text and SPACE not in text:
            if not self.by_lines or "\n" not in text:
                return b"".join(map(self._words.__getitem__, text.split(" ")))
            return self._break.join(map(self._line_bytes, text.split("\n"), chain((self._words,), repeat(self._other))))
        marked = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
        if not self.by_words:
            return self.unit_ids(marked)
        return b"".join(map(self._other.__getitem__, re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", marked)))

    def _line_bytes(self, line: str, first: _Units) -> bytes:
        """Ids of one line; ``first`` has those of its first word, which only in the first line has a mark."""
        word, space, rest = line.partition(" ")
        head = first[word] if word or first is self._words else b""
        return head + b"".join(map(self._words.__getitem__, rest.split(" "))) if space else head

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    # -- decoding ---------------------------------------------------------
    def _from_bytes(self, run: bytes) -> bytes:
        """Byte pieces: each valid character, U+FFFD for every other byte."""
        out, k = [], 0
        while k < len(run):
            size = 1 if run[k] < 0x80 else 2 if run[k] < 0xE0 else 3 if run[k] < 0xF0 else 4
            try:
                run[k:k + size].decode()
                out.append(run[k:k + size])
                k += size
            except UnicodeDecodeError:
                out.append(UNKNOWN.encode())
                k += 1
        return b"".join(out)

    def decode_bytes(self, ids: list[int]) -> bytes:
        surface = self.surface
        parts = [surface[i] for i in ids]
        if None in parts:                      # byte pieces: runs of them are read together
            whole, run = [], bytearray()
            for i, part in zip(ids, parts):
                if part is None:
                    run.append(self.byte_of[i])
                    continue
                if run:
                    whole.append(self._from_bytes(bytes(run)))
                    run.clear()
                whole.append(part)
            whole.append(self._from_bytes(bytes(run)))
            parts = whole
        text = b"".join(parts)
        first = next((i for i in ids if surface[i] != b""), self.unk)
        return text[1:] if self.dummy_prefix and first != self.unk and (surface[first] or b"").startswith(b" ") else text


@lru_cache(maxsize=2)
def codec(model: bytes) -> PieceCodec:
    return PieceCodec(model)


def encode_column(df: DataFrame, model_path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` with ``out_col``: the ids (array<int>) of each whole text."""
    with open(model_path, "rb") as f:           # a tokenizer file installed beside the driver; half a megabyte
        model = f.read()

    def make():
        c = codec(model)

        def of(texts: pa.Array) -> pa.Array:
            got = [c.encode_bytes(t or "") for t in texts.to_pylist()]
            ends = np.cumsum([0, *(len(g) // 4 for g in got)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(got), np.int32)))
        return of

    return arrow_column(df, text_col, out_col, T.ArrayType(T.IntegerType()), make)


def decode_column(df: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``: the text that the ids decode to (null ids: empty)."""
    with open(model_path, "rb") as f:
        model = f.read()

    def make():
        c = codec(model)

        def of(ids: pa.Array) -> pa.Array:
            flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            real = ids.is_valid().to_numpy(zero_copy_only=False)
            texts = [c.decode_bytes(flat[a:b].tolist()) if ok else b"" for a, b, ok in zip(ends[:-1], ends[1:], real)]
            return pa.array(texts, pa.binary()).cast(pa.string())
        return of

    return arrow_column(df, ids_col, out_col, T.StringType(), make)


def digest_columns(ids_col: str = "ids", decoded_col: str = "decoded") -> list[Column]:
    """n_tokens, ids_sha256, decoded_sha256 from encoded and decoded columns."""
    return [F.size(ids_col).cast("long").alias("n_tokens"),
            F.sha2(F.concat_ws(",", F.col(ids_col).cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
            F.sha2(F.col(decoded_col).cast("binary"), 256).alias("decoded_sha256")]


def digest(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return df.select(F.col(id_col).alias("doc_id"), *digest_columns())
