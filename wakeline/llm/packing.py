"""Best-fit packing of documents into sequences under several capacities at once.

Pieces of documents are dealt to groups by hash, each group small enough for one task and large enough
that the last sequences of a group weigh nothing. In a group pieces come longest first; each goes to the
open sequence that fits best among those with room in every capacity (tokens, documents, attention cost):
either the largest dot product of the piece's needs with the room left, weighted by capacity, or the least
norm of the room left after it.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import free_name, settle
from wakeline.session import cut_lineage

#: Pieces of one group, about.
GROUP_PIECES = 20_000

#: A run of white space on which the pattern engine of the rank form could run out of stack.
_LONG_BLANK = re.compile(r"\s{10000,}")


@dataclass(frozen=True)
class Capacity:
    """Of one sequence: tokens, documents, and the sum of squared piece lengths. NULL-like None: no bound of its own."""

    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None


def _byte_alphabet() -> dict[str, int]:
    """Character a byte-level vocabulary writes for each byte: printable bytes for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)) - set(shown))
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


def as_ranks(vocabulary: dict) -> dict[bytes, int] | None:
    """Ranks (token bytes -> id) of a vocabulary file that byte pairs by rank encode alike, else None.

    So it is where the file has plain byte-level pairs (no normalizer, prefix, suffix, dropout, or added tokens other
    than special ones), its pattern is the usual one, and the merges make the ids in order, each after both its parts.
    """
    model, before = vocabulary["model"], vocabulary.get("pre_tokenizer") or {}
    plain = (model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
             and not before.get("add_prefix_space") and not vocabulary.get("normalizer")
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
             and all(t["special"] for t in vocabulary.get("added_tokens", [])))
    if not plain:
        return None
    alphabet, ids = _byte_alphabet(), model["vocab"]
    special = {t["content"] for t in vocabulary.get("added_tokens", [])}
    if any(c not in alphabet for token in ids if token not in special for c in token):
        return None
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [ids.get(a + b, -1) for a, b in merges]
    if made != list(range(256, 256 + len(merges))) or any(not max(ids.get(a, i), ids.get(b, i)) < i for (a, b), i in zip(merges, made)):
        return None
    return {bytes(alphabet[c] for c in token): i for token, i in ids.items() if token not in special}


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """encode(text) -> array of the ids that the tokenizers library gives, special strings as ordinary text.

    A vocabulary that ``as_ranks`` takes is encoded by tiktoken, which gives the same ids in a third of the time and
    remembers nothing; any other, and texts with very long runs of white space, by tokenizers itself.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    tokenizer.no_padding()
    tokenizer.no_truncation()

    def slow(text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    with open(path, encoding="utf-8") as file:
        ranks = as_ranks(json.load(file))
    if ranks is None:
        return slow
    by_rank = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: slow(text) if _LONG_BLANK.search(text) else by_rank.encode_to_numpy(text, disallowed_special=())


def token_pieces(docs: DataFrame, path: str, last_id: int, tokens: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document: its ids and ``last_id``, cut if over ``tokens``.

    All pieces but the first are of full length. NULL and empty texts are ``last_id`` alone.
    """

    @F.arrow_udf("array<struct<piece: int, start: bigint, length: bigint, ids_crc32: bigint>>")
    def cut(texts: pa.Array) -> pa.Array:
        encode = _tokenizer(path)
        ends, start, length, crc, piece = [0], [], [], [], []
        for text in texts.to_pylist():
            ids = np.append(encode(text) if text else [], [last_id]).astype("<u4")
            total = len(ids)
            first = total % tokens or tokens
            edges = [0, *range(first, total + 1, tokens)]
            for k, (a, b) in enumerate(zip(edges, edges[1:])):
                piece.append(k)
                start.append(a)
                length.append(b - a)
                crc.append(zlib.crc32(ids[a:b]))
            ends.append(len(piece))
        rows = pa.StructArray.from_arrays([pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                                          ["piece", "start", "length", "ids_crc32"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    return docs.select(F.col(id_col).alias(id_col), F.explode(cut(F.col(text_col))).alias("p")).select(id_col, "p.*")


def fit(lengths: np.ndarray, capacity: Capacity, rule: str = "norm") -> np.ndarray:
    """Sequence number of every piece; pieces must come longest first and fit an empty sequence.

    rule ``dot``: the open sequence with the largest weighted dot product of needs and room; ``norm``: with the
    least norm of the room left. Rooms and needs are shares of the capacities. Ties go to the older sequence.
    """
    most = np.array([capacity.tokens, capacity.documents or capacity.tokens, capacity.attention or capacity.tokens ** 2], dtype=np.int64)
    n = len(lengths)
    rooms = np.empty((n, 3), dtype=np.int64)  # of open sequences, then rubbish
    names = np.empty(n, dtype=np.int64)
    open_count, made = 0, 0
    out = np.empty(n, dtype=np.int64)
    for i, length in enumerate(lengths.tolist()):
        need = np.array([length, 1, length * length])
        room = rooms[:open_count]
        fits = np.flatnonzero((room[:, 0] >= need[0]) & (room[:, 1] >= 1) & (room[:, 2] >= need[2]))
        if len(fits):
            if rule == "dot":
                best = fits[np.argmax((room[fits] / most * (need / most)).sum(axis=1))]
            else:
                left = (room[fits] - need) / most
                best = fits[np.argmin((left * left).sum(axis=1))]
        else:
            best, open_count = open_count, open_count + 1
            rooms[best], names[best] = most, made
            made += 1
        rooms[best] -= need
        out[i] = names[best]
        if rooms[best][0] == 0 or rooms[best][1] == 0 or rooms[best][2] == 0:
            open_count -= 1  # closed: the last open sequence takes its row
            rooms[best], names[best] = rooms[open_count], names[open_count]
    return out


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), length: str = "length", order: tuple[str, ...] = ("doc_id", "piece"),
         rule: str = "norm") -> DataFrame:
    """``pieces`` with sequence_id and offset (place in its sequence, gapless from 0).

    Every row is packed; one that fills a sequence by itself is not dealt at all. A length NULL, below 1 or over a
    capacity is an error. Groups are dealt by a hash of ``order`` and a number of the row, so equal rows are spread; their number grows with the rows. Repeated rows are
    packed each. Column names other than sequence_id and offset may be any.
    """
    settle(pieces.sparkSession)
    whole = pieces.schema
    bad = (F.col(length).isNull() | (F.col(length) < 1) | (F.col(length) > capacity.tokens)
           | (F.col(length) * F.col(length) > (capacity.attention or capacity.tokens ** 2)))
    row = free_name(pieces, "_row")  # fixed by the checkpoint; tells equal rows apart, so that they are dealt too
    rows = cut_lineage(pieces.withColumn(row, F.monotonically_increasing_id()).withColumn(length, F.when(bad, F.raise_error(F.lit("a piece has no length or does not fit"))).otherwise(F.col(length))))
    full = F.col(length) == capacity.tokens
    short = rows.where(~full)
    groups = max(1, math.ceil(short.count() / GROUP_PIECES))
    key = F.xxhash64(*[F.col(c) for c in order], F.col(row), F.lit(11))
    out_schema = pa.schema([])

    def pack_group(table: pa.Table) -> pa.Table:
        table = table.sort_by([(length, "descending"), *[(c, "ascending") for c in order], (row, "ascending")])
        group = table.column("_group")[0].as_py()
        lengths = table.column(length).to_numpy().astype(np.int64)
        sequence = fit(lengths, capacity, rule)
        by = np.argsort(sequence, kind="stable")
        before = np.cumsum(lengths[by]) - lengths[by]
        starts = np.searchsorted(sequence[by], np.arange(sequence.max() + 1 if len(sequence) else 0))
        offset = np.empty(len(lengths), np.int64)
        offset[by] = before - before[starts][sequence[by]]
        table = table.drop(["_group", row])
        return table.append_column("sequence_id", pa.array(sequence * groups + group)).append_column("offset", pa.array(offset))

    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in whole)}, sequence_id bigint, offset bigint"
    packed = short.withColumn("_group", F.pmod(key, F.lit(groups))).groupBy("_group").applyInArrow(pack_group, schema)
    # Full pieces are numbered below zero: any numbers will do, and no task has to see them all.
    alone = rows.where(full).drop(row).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint"))
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, path: str, last_id: int, capacity: Capacity = Capacity(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Documents as token pieces in sequences: (id, piece, start, length, ids_crc32, sequence_id, offset).

    Every row of ``docs`` is there, NULL and empty texts too (one token); NULL and repeated ids are documents
    of their own. Other columns are not read. An empty table gives no rows.
    """
    settle(docs.sparkSession)
    pieces = token_pieces(docs, path, last_id, capacity.tokens, id_col, text_col)
    return pack(pieces, capacity, order=(id_col, "piece"))
