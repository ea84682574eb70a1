"""Byte-level BPE encoding and decoding.

Every byte stands for one Latin-1 character, so an Aho-Corasick automaton over the vocabulary finds, in one
pass, all tokens that start at each byte of a piece. Encoding takes the longest token, checks that it can
stand next to the token before it, and falls back to the next shorter one. Two tokens can stand side by
side if no merge across their boundary would have come before the merges that built them; answers are
memoised by pair. The encoding of a prefix is unique, so a place given up once is never tried again and the
work is linear in the piece.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.llm.common import Memo, by_chunks, list_array


class ByteBpe:
    """A vocabulary of ranks. Byte strings are held as Latin-1 text: one character for each byte."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.rank = {token.decode("latin-1"): r for token, r in ranks.items()}
        self.bytes_of = {r: token for token, r in ranks.items()}
        self.text_of = {r: token for token, r in self.rank.items()}
        self.pieces = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for token, r in self.rank.items():
            self.automaton.add_word(token, (len(token), r))
        self.automaton.make_automaton()
        self.parts = Memo(self._parts, len(self.rank) + 1)
        self.length = {r: len(token) for r, token in self.text_of.items()}
        self.shorter = Memo(self._shorter, len(self.rank) + 1)
        self.side_by_side = Memo(self._side_by_side, 1 << 18)  # by both ids in one number
        self.of_rest = Memo(self._encode_rest, 1 << 18)

    def _parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a single byte (or a token no merge makes)."""
        run = list(self.text_of[token])
        while len(run) > 2:
            best, at = token, -1
            for i in range(len(run) - 1):
                r = self.rank.get(run[i] + run[i + 1])
                if r is not None and r < best:
                    best, at = r, i
            if at < 0:
                return None
            run[at:at + 2] = [run[at] + run[at + 1]]
        return (self.rank[run[0]], self.rank[run[1]]) if len(run) == 2 else None

    def _side_by_side(self, pair: int) -> bool:
        """Undoes the merges of both tokens, latest first, and looks for an earlier merge across the boundary."""
        left, right = pair >> 32, pair & 0xFFFFFFFF
        text_of, rank = self.text_of, self.rank
        before = len(self.rank) + max(left, right) + 2
        while True:
            across = rank.get(text_of[left] + text_of[right])
            if across is not None and across < before:
                return False
            # Equal ranks merge from the left, so of two equal tokens the right one was built last.
            inner_left, inner_right = self.parts[left], self.parts[right]
            if inner_left is not None and (inner_right is None or left > right):
                before, left = left, inner_left[1]
            elif inner_right is not None:
                before, right = right + 1, inner_right[0]
            else:
                return True

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one match of the pattern."""
        text = piece.encode().decode("latin-1")
        whole = self.rank.get(text)
        if whole is not None:
            return [whole]
        fits = self.side_by_side
        # The longest token at every place, one after the other: often this is the answer.
        longest = [found[1] for _end, found in self.automaton.iter_long(text)]
        before = longest[0]
        for k, token in enumerate(longest):
            if k and not fits[before << 32 | token]:
                return self._backtrack(text, longest, k)
            before = token
        return longest

    def _backtrack(self, text: str, longest: list[int], kept: int) -> list[int]:
        """Goes on from the first ``kept`` of the longest tokens, of which the next one does not fit."""
        n, length, fits, shorter = len(text), self.length, self.side_by_side, self.shorter
        places, first, at = [], {}, 0  # first: the longest token at a place, for the places reached
        for token in longest:
            places.append(at)
            first[at] = token
            at += length[token]
        out, closed = longest[:kept], bytearray(n + 1)
        at, token = places[kept], shorter[longest[kept]]
        del places[kept:]
        while at < n:
            while token is not None:
                end = at + length[token]
                if not closed[end] and (not out or fits[out[-1] << 32 | token]):
                    break
                token = shorter[token]
            if token is not None:
                out.append(token)
                places.append(at)
                at = end
                if at < n and at not in first:
                    place = at
                    for _end, (size, found) in self.automaton.iter_long(text, at):
                        if place in first:
                            break
                        first[place] = found
                        place += size
                token = first.get(at)
            elif out:
                closed[at] = 1
                token, at = shorter[out.pop()], places.pop()
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
        return out

    def _shorter(self, token: int) -> int | None:
        """The longest token that begins ``token`` and is shorter."""
        text = self.text_of[token]
        return next((self.rank[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in self.rank), None)

    def _encode_chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for piece in self.pieces(chunk):
            ids += self.encode_piece(piece)
        return array("I", ids).tobytes()

    def _encode_rest(self, rest: str) -> bytes:
        """Ids of a space and ``rest``. Letters alone are one match; a mark after letters is a match of its own."""
        if rest.isalpha():
            return array("I", self.encode_piece(" " + rest)).tobytes()
        if rest[-1] in ".,;:!?" and rest[:-1].isalpha():
            return self.of_rest[rest[:-1]] + array("I", self.encode_piece(rest[-1])).tobytes()
        return self._encode_chunk(" " + rest)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return by_chunks(text, self.of_rest, self._encode_chunk)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> ByteBpe:
    """One copy for each Python worker; its size is the vocabulary's, whatever the data."""
    return ByteBpe(path, pattern)


def encode(text: Column, path: str, pattern: str) -> Column:
    """array<int> of token ids of ``text``; NULL and the empty text give an empty array. No special tokens:
    their strings are ordinary text. Texts of any length; each match of ``pattern`` is encoded on its own."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        encode_one = vocabulary(path, pattern).encode
        return list_array([encode_one(t) if t else b"" for t in texts.to_pylist()], pa.int32(), 4)

    return run(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of an array of ids; NULL and the empty array give no bytes. An id outside the vocabulary is an error."""

    @F.arrow_udf("binary")
    def run(lists: pa.Array) -> pa.Array:
        decode_one = vocabulary(path, pattern).decode
        values, offsets = lists.values.to_numpy().tolist(), lists.offsets.to_pylist()
        return pa.array([decode_one(values[a:b]) for a, b in zip(offsets, offsets[1:])], pa.binary())

    return run(F.coalesce(ids, F.array().cast("array<int>")))


def ids_sha256(ids: Column) -> Column:
    """Lowercase hex SHA-256 of an id array written as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        import hashlib

        values, offsets = lists.values.to_numpy().astype("<u4"), lists.offsets.to_pylist()
        return pa.array([hashlib.sha256(values[a:b].tobytes()).hexdigest() for a, b in zip(offsets, offsets[1:])])

    return run(F.coalesce(ids, F.array().cast("array<int>")))
