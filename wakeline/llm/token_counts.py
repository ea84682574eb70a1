"""Token counts by finite-state transducers compiled from a byte-level BPE vocabulary.

Two deterministic transducers read a text. The first walks code points by class and marks where a match of
the splitting pattern begins. The second walks bytes and says with every transition by how much the number
of tokens grows, so that the sum over a text is its number of tokens. A mark sends the second one back to
its first state. No ids are made and no merges are run on texts.

A batch of texts is one run of bytes, cut into chunks of equal size that step side by side (each step is
one lookup for all chunks). Which state a chunk begins in is known from state maps:

* The first transducer has 12 states, so a chunk's map is a row of 12 numbers. The maps are composed by a
  parallel prefix scan, in as many rounds as the number of chunks has binary digits.
* For the second one, a chunk that holds a mark is a constant map: whatever state it begins in, it ends in
  the same. Those are known after one pass. Only the bytes before a chunk's first mark depend on the chunk
  before; they are read once its end is known. A match over several chunks is read chunk after chunk.

States of the second transducer. The encoding of every prefix of a match is unique, and its last token is
the one token that fits the encoding of the prefix without it. So it is enough to know, for each place at
which a token not yet ended may have begun, how far into the vocabulary's tree it is, which token ended
there, and how the counts differ. Token after token "fits" if no merge across their boundary comes before
the merges that made them. Places that no token can fit are dropped, and tokens before a place that allow
the same ends are one. States and transitions are made when first met and kept up to a bound.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of one run of texts, about (a longer text is a run of its own), and of one chunk.
RUN_BYTES, CHUNK = 1 << 21, 128

#: Ends under a node of the tree up to which tokens before it are told apart by the ends they allow.
FEW = 6

#: Growths and differences of counts are kept with this added (both are less than the longest token, checked).
ZERO = 2048

#: Transitions held; when more are known all are forgotten.
MOST_TRANSITIONS = 1 << 19

# The splitting pattern's classes of code points.
OTHER, LETTER, NUMBER, SPACE, WHITE, QUOTE, SHORT, OPEN, ELL, EE, END = range(11)
CONTRACTED = {"'": QUOTE, "s": SHORT, "t": SHORT, "m": SHORT, "d": SHORT, "r": OPEN, "v": OPEN, "l": ELL, "e": EE}
PATTERN = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(0x110000, np.uint8)
    for number, kind in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        for run in regex.finditer(kind + "+", points):
            a, b = run.span()
            shift = 0x800 if a >= 0xD800 else 0
            out[a + shift:b + shift] = number
    out[ord(" ")] = SPACE
    for char, number in CONTRACTED.items():
        out[ord(char)] = number
    return out


#: States of the splitter: what the match being read consists of so far.
START, LETTERS, NUMBERS, ONE_SPACE, ONE_WHITE, RUN_SPACE, RUN_WHITE, OTHERS, QUOTED, QUOTED_OPEN, QUOTED_ELL, SUFFIX = range(12)

#: A transition marks the character it reads (1), the one before it (2), or both.
HERE, BEFORE = 1, 2


@lru_cache(maxsize=1)
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks) by state * 11 + class, for
    's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^white, L, N]+|white+ not before other than white|white+ ."""
    letters = {LETTER, SHORT, OPEN, ELL, EE}

    def fresh(kind: int) -> int:
        """State after a character that begins a match."""
        if kind in letters:
            return LETTERS
        return {NUMBER: NUMBERS, SPACE: ONE_SPACE, WHITE: ONE_WHITE, QUOTE: QUOTED, END: START}.get(kind, OTHERS)

    def after_space(kind: int) -> int:
        """A single space goes to the match it stands before; a quote after it begins no contraction."""
        return OTHERS if kind == QUOTE else fresh(kind)

    def go(state: int, kind: int) -> tuple[int, int]:
        if kind == END:  # a run of white space at the end is one match; an open contraction was none
            return START, BEFORE * (state in (QUOTED_OPEN, QUOTED_ELL))
        if state in (ONE_SPACE, ONE_WHITE, RUN_SPACE, RUN_WHITE):
            if kind in (SPACE, WHITE):
                return (RUN_SPACE if kind == SPACE else RUN_WHITE), 0
            last = BEFORE * (state in (RUN_SPACE, RUN_WHITE))  # the last of a run is a match of its own or goes with what follows
            return (after_space(kind), last) if state in (ONE_SPACE, RUN_SPACE) else (fresh(kind), last | HERE)
        if state == LETTERS and kind in letters or state == NUMBERS and kind == NUMBER:
            return state, 0
        if state in (OTHERS, QUOTED) and kind in (OTHER, QUOTE):
            return OTHERS, 0
        if state == QUOTED and kind in (SHORT, OPEN, ELL):
            return {SHORT: SUFFIX, OPEN: QUOTED_OPEN, ELL: QUOTED_ELL}[kind], 0
        if (state, kind) in ((QUOTED_OPEN, EE), (QUOTED_ELL, ELL)):
            return SUFFIX, 0
        if state in (QUOTED_OPEN, QUOTED_ELL):  # no contraction: the letter begins a match
            return (LETTERS, BEFORE) if kind in letters else (fresh(kind), BEFORE | HERE)
        return fresh(kind), HERE

    table = np.array([go(state, kind) for state in range(12) for kind in range(11)])
    return table[:, 0].astype(np.uint8), table[:, 1].astype(np.uint8)


def chunked(values: np.ndarray, fill: int) -> np.ndarray:
    """Row t holds the t-th value of every chunk; the last chunk is filled up."""
    chunks = -(-len(values) // CHUNK)
    out = np.full(chunks * CHUNK, fill, values.dtype)
    out[:len(values)] = values
    return np.ascontiguousarray(out.reshape(chunks, CHUNK).T)


def scan(maps: np.ndarray) -> np.ndarray:
    """Composes maps (one row each, applied in order): row k is map 0, then 1, ... then k."""
    step = 1
    while step < len(maps):
        maps = np.concatenate([maps[:step], np.take_along_axis(maps[step:], maps[:-step], axis=1)])
        step *= 2
    return maps


def marks(kinds: np.ndarray) -> np.ndarray:
    """For each character whether a match begins there."""
    following, told = splitter()
    rows = chunked(kinds, END)
    maps = np.tile(np.arange(12, dtype=np.uint8), (rows.shape[1], 1))
    for t, row in enumerate(rows):
        if maps.shape[1] > 1 and t % 8 == 0 and (maps == maps[:, :1]).all():
            maps = np.ascontiguousarray(maps[:, :1])  # all chunks have forgotten where they began
        maps = following[maps * np.intp(11) + row[:, None]]
    ends = scan(np.broadcast_to(maps, (len(maps), 12)))[:, START]
    state = np.concatenate([[START], ends[:-1]]).astype(np.intp)
    out = np.empty(rows.shape, np.uint8)
    for t, row in enumerate(rows):
        at = state * 11 + row
        out[t] = told[at]
        state = following[at].astype(np.intp)
    flat = out.T.reshape(-1)[:len(kinds)]
    begins = (flat & HERE).astype(bool)
    begins[:-1] |= (flat[1:] & BEFORE) > 0
    return begins


class Transitions:
    """(state, byte) -> (state, growth): open addressing in arrays, so that many are looked up at once."""

    def __init__(self):
        self.held = 0
        self._clear(1 << 16)

    def _clear(self, size: int) -> None:
        self.mask = size - 1
        self.keys = np.full(size, -1, np.int64)
        self.values = np.zeros(size, np.int64)

    def place(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is, or the free place where its search ends."""
        at = ((keys * 0x9E3779B1) >> 15) & self.mask  # keys are under 2^31
        found = self.keys[at]
        left = np.flatnonzero((found != keys) & (found != -1))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            found = self.keys[at[left]]
            left = left[(found != keys[left]) & (found != -1)]
        return at

    def get(self, key: int) -> int:
        """The value of one key, -1 if there is none."""
        at = ((key * 0x9E3779B1) >> 15) & self.mask
        while (found := self.keys[at]) != key:
            if found == -1:
                return -1
            at = (at + 1) & self.mask
        return int(self.values[at])

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Different keys that are not held yet."""
        if 2 * (self.held + len(keys)) > self.mask:
            known, held = self.keys[self.keys >= 0], self.values[self.keys >= 0]
            self._clear(4 * (self.mask + 1))
            self._put(known, held)
        self._put(keys, values)
        self.held += len(keys)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        while len(keys):
            at = self.place(keys)
            self.keys[at] = keys  # of several keys for one place the last one has it
            self.values[at] = values
            lost = self.keys[at] != keys
            self.values[at[~lost]] = values[~lost]
            keys, values = keys[lost], values[lost]


def byte_alphabet() -> dict[str, int]:
    """How a byte-level vocabulary writes bytes: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Counter:
    """Transducers of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        added = spec["added_tokens"]
        if (model["type"] != "BPE" or not plain or spec["normalizer"] or any(before.get(k) != v for k, v in PATTERN.items())
                or any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))):
            raise ValueError("only byte-level BPE without normalizer, with added tokens that stand for themselves")
        names = sorted((a["content"] for a in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        alphabet, vocabulary = byte_alphabet(), model["vocab"]
        if max(map(len, vocabulary)) >= ZERO or max(vocabulary.values()) >= 0xFFFFF:
            raise ValueError("the vocabulary's tokens are too long or too many")
        self.merge_rank = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> rank of its merge, left, right
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocabulary[left], vocabulary[right]
            self.merge_rank[pair] = rank
            self.parts.setdefault(vocabulary[left + right], (rank, *pair))
        # The tree of tokens that single bytes or merges make.
        self.child: dict[int, int] = {}
        self.token_at, self.below = [-1], [0]
        for name, token in vocabulary.items():
            if any(c not in alphabet for c in name) or (len(name) > 1 and token not in self.parts):
                continue
            node, way = 0, [0]
            for char in name:
                key = node << 8 | alphabet[char]
                if key not in self.child:
                    self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.below.append(0)
                node = self.child[key]
                way.append(node)
            self.token_at[node] = token
            for n in way[:-1]:
                self.below[n] += 1
        self.ends: dict[int, list[int]] = {}  # tokens under a node that has few
        children: dict[int, list[int]] = {}
        for key, node in self.child.items():
            children.setdefault(key >> 8, []).append(node)
        for node in range(len(self.token_at) - 1, 0, -1):  # children come after their node
            if 0 < self.below[node] <= FEW:
                self.ends[node] = [t for c in children[node] for t in ([self.token_at[c]] if self.token_at[c] >= 0 else []) + self.ends.get(c, [])]
        self.fit: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        """State 0 is the begin of a match, state 1 that of a chunk whose begin is not known yet."""
        self.table = Transitions()
        start, unknown = (ZERO,), ()
        self.states = [start, unknown]
        self.number = {start: 0, unknown: 1}
        self.alike: dict[int, int] = {}
        self.like: dict[int, int] = {}
        self.fit.clear()
        self.table.add(np.arange(256) | 1 << 8, np.full(256, 1 << 12 | ZERO))

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``: undoes their merges, latest first, looking for an earlier merge across."""
        pair = left << 32 | right
        known = self.fit.get(pair)
        if known is not None:
            return known
        a, b, bound, answer = left, right, 1 << 60, True
        while True:
            across = self.merge_rank.get((a, b))
            if across is not None and across < bound:
                answer = False
                break
            made_a, made_b = self.parts.get(a), self.parts.get(b)
            # Of equal merges the left one is made first, so the right token is undone first.
            if made_a and (not made_b or made_a[0] > made_b[0]):
                bound, a = made_a[0], made_a[2]
            elif made_b:
                bound, b = made_b[0] + 1, made_b[1]
            else:
                break
        self.fit[pair] = answer
        return answer

    def _before(self, node: int, last: int) -> int | None:
        """The token that stands for all that leave the same ends open at ``node``; None: no end is open."""
        if last < 0 or node not in self.ends:
            return last
        known = self.alike.get(node << 32 | last, -2)
        if known == -2:
            mask = sum(self.fits(last, token) << k for k, token in enumerate(self.ends[node]))
            known = self.like.setdefault(node << FEW | mask, last) if mask else None
            self.alike[node << 32 | last] = known
        return known

    def compile(self, key: int) -> int:
        """The next state and the growth, as one number, of a state and a byte.

        A state holds one number for each place: node, token before (0 for none, else its id and 1), and the count
        there less the count here."""
        byte, places, ended, growth = key & 255, [], -1, 0
        for place in self.states[key >> 8]:
            node, last, count = place >> 32, (place >> 12 & 0xFFFFF) - 1, (place & 4095) - ZERO
            below = self.child.get(node << 8 | byte)
            if below is None:
                continue
            token = self.token_at[below]
            if ended < 0 and token >= 0 and (last < 0 or self.fits(last, token)):
                ended, growth = token, count + 1
            if self.below[below]:
                before = self._before(below, last)
                if before is not None:
                    places.append((below << 32 | (before + 1) << 12) + count + ZERO)
        if ended < 0:
            raise ValueError(f"no token for byte {byte}")
        now = ((ended + 1) << 12 | ZERO, *(place - growth for place in places))
        number = self.number.setdefault(now, len(self.states))
        if number == len(self.states):
            self.states.append(now)
        return number << 12 | (growth + ZERO)

    def _step(self, state: np.ndarray, bytes_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = state << 8 | bytes_
        table = self.table
        at = table.place(keys)
        new = table.keys[at] != keys
        if new.any():
            missing = sorted(set(keys[new].tolist()))
            table.add(np.array(missing), np.array([self.compile(key) for key in missing]))
            at = table.place(keys)
        values = table.values[at]
        return values >> 12, (values & 4095) - ZERO

    def growths(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """By how much the number of tokens grows with every byte; ``begins`` marks the bytes that begin a match."""
        if self.table.held > MOST_TRANSITIONS:
            self.forget()
        rows, flags = chunked(data, 0), chunked(begins, True)
        steps, chunks = rows.shape
        out = np.zeros(rows.shape, np.int16)
        state = np.ones(chunks, np.int64)
        state[0] = 0
        for t in range(steps):
            state, out[t] = self._step(np.where(flags[t], 0, state), rows[t])
        # Bytes before the first mark of a chunk, from the state the chunk before ends in.
        head = np.where(flags.any(axis=0), flags.argmax(axis=0), steps)
        todo = [k for k in range(1, chunks) if head[k]]
        ready = np.array([k for k in todo if state[k - 1] != 1], np.int64)
        late = [k for k in todo if state[k - 1] == 1]
        inside = state[ready - 1]
        for t in range(int(head[ready].max()) if len(ready) else 0):
            on = head[ready] > t
            inside[on], out[t, ready[on]] = self._step(inside[on], rows[t, ready[on]])
        through = head[ready] == steps
        state[ready[through]] = inside[through]
        for k in late:  # in order: a match over several chunks
            at = int(state[k - 1])
            for t in range(int(head[k])):
                at, out[t, k] = self._one(at, int(rows[t, k]))
            if head[k] == steps:
                state[k] = at
        return out.T.reshape(-1)[:len(data)]

    def _one(self, state: int, byte: int) -> tuple[int, int]:
        key = state << 8 | byte
        value = self.table.get(key)
        if value < 0:
            value = self.compile(key)
            self.table.add(np.array([key]), np.array([value]))
        return value >> 12, (value & 4095) - ZERO

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Number of tokens of every text."""
        out = np.zeros(len(texts), np.int64)
        run, owner, size = [], [], 0
        for k, text in enumerate(texts):
            parts = self.special.split(text or "") if self.special else [text or ""]
            out[k] += len(parts) - 1
            for part in parts:
                if part:
                    run.append(part)
                    owner.append(k)
                    size += len(part)
            if size >= RUN_BYTES:
                self._count_run(run, owner, out)
                run, owner, size = [], [], 0
        if run:
            self._count_run(run, owner, out)
        return out

    def _count_run(self, parts: list[str], owner: list[int], out: np.ndarray) -> None:
        text = "\n".join(parts) + "\n"
        kinds = classes()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        kinds[np.cumsum([len(p) + 1 for p in parts]) - 1] = END
        data = np.frombuffer(text.encode(), np.uint8)
        first = np.flatnonzero((data & 0xC0) != 0x80)
        begins = np.zeros(len(data), bool)
        begins[first[marks(kinds) | (kinds == END)]] = True
        grown = self.growths(data, begins).astype(np.int64)
        grown[first[kinds == END]] = 0
        starts = np.concatenate([[0], first[kinds == END][:-1] + 1])
        np.add.at(out, owner, np.add.reduceat(grown, starts))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One for each Python worker; its size is bounded by the vocabulary and MOST_TRANSITIONS."""
    return Counter(path)


def token_count(text: Column, path: str) -> Column:
    """bigint: tokens of ``text`` as the vocabulary's library gives them without begin, end or added special
    tokens; special strings inside a text are one token each. NULL and the empty text have none. Texts of any
    length; equal texts have equal counts."""

    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(counter(path).count(texts.to_pylist()))

    return run(text)
