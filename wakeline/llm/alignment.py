"""Alignment of two tokenizations of one text.

The cumulative byte ends of both id lists go into dictionaries from end to index. Ends that both have, by
intersection of the key sets, in order, slice both lists into groups; tokens whose byte ranges end together
are linked, group by group.

Both tokenizers cut before a single space that stands between other characters, so a text is aligned word
by word there and the groups are put end to end; words met before are remembered up to a bound.

Counts over all texts need each pair of ids once for a block of documents, not for each document: a block
is one row of a written table (its documents' numbers of links by pair, and the pairs it has). Blocks hold a
bounded number of documents and, but for single long documents, a bounded number of tokens.
"""

from __future__ import annotations

import os
import re
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wakeline.llm.common import Memo, settle
from wakeline.llm.token_counts import byte_alphabet
from wakeline.session import checkpoint_dir

#: Documents of a block, and links after which a block ends.
BLOCK_DOCS, BLOCK_LINKS = 1000, 1 << 20

#: Words of a text that are aligned at once.
PART_WORDS = 1000

#: Words up to this many characters are remembered.
MEMO_CHARS = 48

#: A space between other characters than spaces, the next one no white space: both tokenizers cut before it.
CUT = re.compile(r"(?<=[^ ]) (?=\S)")
GLUE = re.compile(r" (?:\s|$)")

Ids = np.ndarray

#: How the groups of a word are written, each with a semicolon behind; its pairs of linked ids as 64-bit integers; its
#: numbers of tokens of A, of B and of groups in one integer of three fields.
Word = tuple[str, bytes, int]
FIELD = 40


def cut_points(a_ends: list[int], b_ends: list[int]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The common ends in order, and behind which token of A and of B each lies. The later of equal ends counts, so
    a slice reaches over tokens without bytes."""
    after_a, after_b = dict(zip(a_ends, count(1))), dict(zip(b_ends, count(1)))
    common = sorted(after_a.keys() & after_b.keys())
    return common, *(np.fromiter(map(after.__getitem__, common), np.int64, len(common)) for after in (after_a, after_b))


def align(a_ends: Ids, b_ends: Ids) -> tuple[Ids, Ids, list[tuple[int, int]] | None]:
    """Cumulative byte ends of two tokenizations of the same bytes -> (ends of the groups in A, in B, links).

    Group k is what lies between the ends k - 1 and k. Links are all (index of A, index of B) whose byte ranges end
    together; None stands for the last ones of each group, which are all where every token has bytes."""
    common, p, q = cut_points(a_ends.tolist(), b_ends.tolist())
    if (np.diff(a_ends, prepend=0) > 0).all() and (np.diff(b_ends, prepend=0) > 0).all():
        return p, q, None
    links, i, j = [], 0, 0
    for end, x, y in zip(common, p.tolist(), q.tolist()):
        links += [(k, m) for k in range(i, x) if a_ends[k] == end for m in range(j, y) if b_ends[m] == end]
        i, j = x, y
    return p, q, links


class Aligner:
    """Tokenizers A (a byte-level vocabulary of the tokenizers library, on a space and the text) and B (a piece
    model of sentencepiece, which adds the space itself)."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.a.no_padding()
        self.a.no_truncation()
        alphabet, names = byte_alphabet(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in name) if all(c in alphabet for c in name) else name.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
                        for i, piece in enumerate(pieces)]
        self.a_length, self.b_length = (np.array(list(map(len, table)), np.int64) for table in (self.a_bytes, self.b_bytes))
        # Word by word is sound if no piece reaches over the begin of a word.
        self.by_word = not any("▁" in piece.lstrip("▁") for piece in pieces)
        # Ids as they are written: A before a comma, A before a bar, B before a comma, B before a semicolon.
        self.shift = len(self.a_bytes)
        self.shown = [f"{i}{mark}" for mark in ",|" for i in range(self.shift)] + [f"{i}{mark}" for mark in ",;" for i in range(len(pieces))]
        self.known = Memo(lambda word: self._many([word])[0], 1 << 19, self._many)

    def _ids(self, words: list[str]) -> tuple[list[int], list[int]]:
        """Ids of A and of B of all words, each with a space before it, put end to end."""
        if all(w.split() == [w] for w in words):  # without white space inside: encoded as one text
            text = " ".join(words)
            return self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text)
        a = self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)
        return list(chain.from_iterable(x.ids for x in a)), list(chain.from_iterable(self.b.encode(words, num_threads=1)))

    def _many(self, words: list[str]) -> list[Word | None]:
        """Words between cuts, aligned at once."""
        plain = [w for w in words if w.split() == [w]]
        found = dict(zip(plain, self._aligned(plain)))
        rest = [w for w in words if w not in found]
        found.update(zip(rest, self._aligned(rest)))
        return [found[w] for w in words]

    def _aligned(self, words: list[str]) -> list[Word | None]:
        if not words:
            return []
        a, b = self._ids(words)
        want = "".join([" " + w for w in words]).encode()
        if any(b"".join(map(table.__getitem__, ids)) != want for table, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            if len(words) == 1:
                return [None]
            half = len(words) // 2
            return self._aligned(words[:half]) + self._aligned(words[half:])
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        p, q, links = align(a_end, b_end)
        ends = a_end[p - 1]
        if links is None:
            pairs, pair_end = a[p - 1] << 32 | b[q - 1], ends
        else:
            pairs = np.array([int(a[x]) << 32 | int(b[y]) for x, y in links], np.int64)
            pair_end = a_end[[x for x, _y in links]]
        # Each group as it is written: its ids of A, then those of B.
        order = np.empty(len(a) + len(b), np.int64)
        for ids, mine, others, first, last in ((a, p, np.concatenate([[0], q[:-1]]), 0, self.shift), (b, q, p, 2 * self.shift, 2 * self.shift + len(self.b_bytes))):
            shown = ids + first
            shown[mine - 1] += last - first
            order[np.arange(len(ids)) + np.repeat(others, np.diff(mine, prepend=0))] = shown
        told = list(map(self.shown.__getitem__, order.tolist()))
        # The end of a word is a common end: what lies between two of them is the word's.
        word_end = np.cumsum([len(w.encode()) + 1 for w in words])
        group = np.searchsorted(ends, word_end) + 1
        n_a, n_b, n_links = p[group - 1], q[group - 1], np.searchsorted(pair_end, word_end, "right")
        out, x, i, j, g = [], 0, 0, 0, 0
        data = pairs.tobytes()
        for y, k, m, h in zip(n_links.tolist(), n_a.tolist(), n_b.tolist(), group.tolist()):
            out.append(("".join(told[i + j:k + m]), data[8 * x:8 * y], (k - i) | (m - j) << FIELD | (h - g) << 2 * FIELD))
            x, i, j, g = y, k, m, h
        return out

    def words(self, text: str) -> Iterator[list[Word | None]]:
        """The words of a text, part by part: both tokenizers cut between them."""
        if "▁" in text or not self.by_word:  # a text with the space mark itself is taken whole
            yield self._aligned([text])
            return
        words = CUT.split(text) if GLUE.search(" " + text) else text.split(" ")
        for start in range(0, len(words), PART_WORDS):
            part = words[start:start + PART_WORDS]
            known = list(map(self.known.get, part))
            if None in known:
                at = [k for k, one in enumerate(known) if one is None]
                found = self.known.fetch({part[k] for k in at if len(part[k]) <= MEMO_CHARS})
                for k in at:
                    known[k] = found[part[k]] if len(part[k]) <= MEMO_CHARS else self._aligned([part[k]])[0]
            yield known

    def document(self, text: str | None) -> dict | None:
        """Numbers of tokens, groups and links, the digest of the groups, the pairs of ids linked and how often each;
        None for the empty text and one that a vocabulary does not give back byte for byte."""
        if not text:
            return None
        digest, linked, sizes, open_end = sha256(), [], 0, ""
        for words in self.words(text):
            if None in words:
                return None
            told, links, numbers = zip(*words)
            digest.update((open_end + "".join(told)[:-1]).encode())
            linked += links
            sizes += sum(numbers)
            open_end = ";"
        pairs, uses = np.unique(np.frombuffer(b"".join(linked), np.int64), return_counts=True)
        mask = (1 << FIELD) - 1
        return {"n_a": sizes & mask, "n_b": sizes >> FIELD & mask, "n_groups": sizes >> 2 * FIELD, "n_links": int(uses.sum()),
                "groups_sha256": digest.hexdigest(), "pairs": pairs, "uses": uses.astype(np.int32)}


#: Of a text without tokens.
NOTHING = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "pairs": np.zeros(0, np.int64), "uses": np.zeros(0, np.int32)}


@lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One for each Python worker; its size is that of the vocabularies and a bounded memo."""
    return Aligner(byte_path, piece_path)


#: One row for each document; the first one of a block also has the block's pairs.
ROW = ("block bigint, id {id}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
       "places array<int>, uses array<int>, pairs array<bigint>, times array<bigint>")


def _blocks(batches: Iterator[pa.RecordBatch], one: Aligner, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    rows, held = [], 0

    def block() -> pa.RecordBatch:
        pairs, back = np.unique(np.concatenate([r["pairs"] for r in rows]), return_inverse=True)
        times = np.bincount(back, weights=np.concatenate([r["uses"] for r in rows]), minlength=len(pairs)).astype(np.int64)
        at = 0
        for k, r in enumerate(rows):
            size = len(r["pairs"])
            r.update(block=first, places=back[at:at + size].astype(np.int32), pairs=None if k else pairs, times=None if k else times)
            at += size
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows.append({"id": key, **(one.document(text) or NOTHING)})
            held += len(rows[-1]["pairs"])
            if len(rows) >= BLOCK_DOCS or held >= BLOCK_LINKS:
                yield block()
                rows, held, first = [], 0, first + 1
    if rows:
        yield block()


def _sums(docs: pa.Table, told: pa.Table, schema: pa.Schema) -> pa.Table:
    """Adds the counts of a block's pairs by document."""
    pos = told["pos"].to_numpy()
    count, best = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
    count[pos], best[pos] = told["count"].to_numpy(), told["is_best"].to_numpy(zero_copy_only=False)
    out = {name: docs[name] for name in schema.names if name in docs.column_names}
    places, uses = (docs[name].combine_chunks() for name in ("places", "uses"))
    sizes = places.value_lengths().to_numpy()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at, weight = places.flatten().to_numpy(), uses.flatten().to_numpy().astype(np.int64)
    for name, of in (("n_best", best), ("count_sum", count)):
        total = np.zeros(len(sizes), np.int64)
        np.add.at(total, owner, weight * of[at])
        out[name] = pa.array(total)
    return pa.table([out[name] for name in schema.names], schema=schema)


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    ``n_best``: links whose pair has the highest count of its id of B in all rows (ties included); ``count_sum``:
    the counts of all links' pairs, added. Texts that are NULL, empty, or that a vocabulary does not give back
    byte for byte have zeros and an empty ``groups_sha256``. Rows with the same id, or none, are rows of their own;
    other columns are not looked at; an empty table gives no rows. Writes a table into the checkpoint folder.
    """
    spark = settle(docs.sparkSession)
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    row, out = StructType.fromDDL(ROW.format(id=kind)), StructType.fromDDL(
        f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
    arrow_row, arrow_out = to_arrow_schema(row), to_arrow_schema(out)
    folder = f"{checkpoint_dir(spark)}/alignment-{uuid.uuid4().hex}"
    given.mapInArrow(lambda batches: _blocks(batches, aligner(byte_path, piece_path), arrow_row), row).write.option(
        "compression", "zstd").parquet(folder)
    written_rows, of_block = spark.read.schema(row).parquet(folder), spark.read.schema(row).parquet(folder).drop("pairs", "times")

    # A block has a pair once, so no pair is hot.
    each = written_rows.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "times"))).select(
        "block", "pos", "col.pairs", "col.times")
    counts = each.groupBy("pairs").agg(F.sum("times").alias("count"))
    second = F.col("pairs").bitwiseAND(F.lit(0xFFFFFFFF))
    # One row for each id of B: bounded by its vocabulary.
    best = F.broadcast(counts.groupBy(second.alias("b")).agg(F.max("count").alias("best")))
    told = each.select("block", "pos", "pairs").join(counts, "pairs").join(best, second == F.col("b")).select(
        "block", "pos", "count", (F.col("count") == F.col("best")).alias("is_best"))
    return of_block.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        lambda left, right: _sums(left, right, arrow_out), out).withColumnRenamed("id", id_col)
