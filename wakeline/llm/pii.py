"""Personal data: patterns, and a skip-chain conditional random field that carries labels to like tokens.

Patterns give the base spans. The field is over the units of a document: its base spans and all other
tokens that hold a digit or an at sign. Neighbours share a potential, and so do units that repeat or
resemble each other at any distance (the same digits, the same last digits, the same name before the at
sign). Loopy message passing gives every unit the probability of each label; base spans are observed, other
units that end with a label become spans too. The weights are learned here from the base spans themselves.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import free_name, settle

KINDS = ("email", "ip", "card", "phone")

#: Messages go round until none changes by more than STILL; should they never settle, for ROUNDS rounds.
ROUNDS, STILL, DAMPING = 500, 1e-3, 0.5
#: Weights are learned until no derivative is above this.
FLAT = 1e-7
#: Digits that make two tokens alike, counted from the end; letters of a name before the at sign.
ALIKE_DIGITS, ALIKE_NAME = 7, 3
#: A unit becomes a span from this probability on.
SURE = 0.5

_NAME_BEFORE = re.compile(r"[A-Za-z0-9._%+-]")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_TOKEN = re.compile(r"\S+")
_LETTER, _BRACKET = re.compile(r"[^\W\d_]"), re.compile(r"[()-]")
_EDGE = "\"'()[]{}<>,.;:!?|&%$#*="


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every at sign, as far left as name characters go and as far right as a host goes: the same
    spans as a search from the left, without trying every start."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _NAME_BEFORE.match(text, start - 1):
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            done = host.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then place; kinds count as in KINDS, places are code points."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((3, *m.span()))
    return out


#: What is seen of a unit: one number each.
SHAPE = ("bias", "at sign", "dot after at sign", "three dots", "parts to 255", "plus first", "digits 7-8", "digits 9-11", "digits 12-15",
         "digits 16-19", "luhn", "digits only", "letters", "brackets or dashes")


def _shape(token: str) -> tuple[float, ...]:
    """The whole token is read, however long."""
    digits = _NOT_DIGIT.sub("", token)
    n = len(digits)
    parts = token.split(".", 4)  # a fifth part holds what is left
    four = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    at = token.rfind("@")
    return tuple(map(float, (
        1, at >= 0, at >= 0 and "." in token[at:], len(parts) == 4, four and all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts),
        token[0] == "+", 7 <= n <= 8, 9 <= n <= 11, 12 <= n <= 15, 16 <= n <= 19, 16 <= n <= 19 and luhn(digits), n == len(token),
        _LETTER.search(token) is not None, _BRACKET.search(token) is not None)))


def units(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(label, start, end) in order of place: base spans with their kind and one, other candidate tokens with 0.

    Of base spans that overlap, the first by kind is the unit.
    """
    out, taken = [], []
    for kind, a, b in base:
        at = bisect_left(taken, (a, b))
        if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or b <= taken[at][0]):
            taken.insert(at, (a, b))
            out.append((kind + 1, a, b))
    if "@" in text or _DIGIT.search(text):
        k = 0
        for m in _TOKEN.finditer(text):
            token = m.group()
            if "@" not in token and not _DIGIT.search(token):
                continue
            a, b = m.start() + len(token) - len(token.lstrip(_EDGE)), m.start() + len(token.rstrip(_EDGE))
            while k < len(taken) and taken[k][1] <= a:
                k += 1
            if a < b and not (k < len(taken) and taken[k][0] < b):
                out.append((0, a, b))
    return sorted(out, key=lambda u: (u[1], u[2]))


def _likeness_keys(token: str) -> list[str]:
    digits, at = _NOT_DIGIT.sub("", token), token.find("@")
    keys = []
    if at >= ALIKE_NAME:
        keys.append("@" + token[:at].casefold())
    elif len(digits) >= ALIKE_DIGITS and not any(map(str.isalpha, token)):
        keys += [digits, "-" + digits[-ALIKE_DIGITS:]]
    return keys


def edges(tokens: list[str], labels: list[int]) -> list[tuple[int, int, int]]:
    """(unit, unit, kind of edge): 0 to the next unit, 1 to the last like unit before and to the first base span of the
    like ones, or to the first of them all. Their number is linear in the units."""
    out, last, seen, hub = [(i, i + 1, 0) for i in range(len(tokens) - 1)], {}, set(), {}
    keys = [_likeness_keys(token) for token in tokens]
    for i, own in enumerate(keys):
        for key in own:
            if key not in hub or labels[i] and not labels[hub[key]]:
                hub[key] = i
    for i, own in enumerate(keys):
        for key in own:
            for j in (last.get(key, i), hub[key]):
                pair = (min(i, j), max(i, j))
                if i != j and pair not in seen:
                    seen.add(pair)
                    out.append((*pair, 1))
            last[key] = i
    return out


@dataclass
class Field:
    """Weights: shape by label, and by kind of edge a table of label by label. Label 0 is no personal data."""

    shape: np.ndarray
    pair: np.ndarray

    def marginals(self, shapes: np.ndarray, observed: np.ndarray, links: list[tuple[int, int, int]]) -> np.ndarray:
        """Probabilities of the labels of every unit, by loopy sum-product messages in both directions of each edge."""
        alone = shapes @ self.shape
        alone[observed > 0] = -1e9  # whatever all messages to it say
        alone[observed > 0, observed[observed > 0]] = 0.0
        if not links:
            return _softmax(alone)
        source = np.array([a for a, b, _ in links] + [b for a, b, _ in links])
        target = np.array([b for a, b, _ in links] + [a for a, b, _ in links])
        table = np.exp(np.stack([self.pair[t] for *_, t in links] + [self.pair[t].T for *_, t in links]))
        back = np.concatenate([np.arange(len(links)) + len(links), np.arange(len(links))])
        message = np.zeros((len(source), self.shape.shape[1]))  # logarithms
        for _ in range(ROUNDS):
            belief = alone.copy()
            np.add.at(belief, target, message)
            said = belief[source] - message[back]
            said = np.exp(said - said.max(1, keepdims=True))
            new = np.log(np.einsum("ei,eij->ej", said, table) + 1e-300)
            new -= new.max(1, keepdims=True)
            still = np.abs(new - message).max() <= STILL
            message = DAMPING * message + (1 - DAMPING) * new
            if still:
                break
        belief = alone.copy()
        np.add.at(belief, target, message)
        return _softmax(belief)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def find(text: str | None, model: Field) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) of all spans, by kind, then place."""
    if not text:
        return []
    base = base_spans(text)
    out = [(k, a, b, True) for k, a, b in base]
    all_units = units(text, base)
    if any(label == 0 for label, _, _ in all_units):
        tokens = [text[a:b] for _, a, b in all_units]
        observed = np.array([label for label, _, _ in all_units])
        found = model.marginals(np.array([_shape(t) for t in tokens]), observed, edges(tokens, observed.tolist()))
        for (label, a, b), p in zip(all_units, found):
            k = int(p.argmax())
            if label == 0 and k and p[k] > SURE:
                out.append((k - 1, a, b, False))
    return sorted(out)


def _rounded(count: int) -> int:
    """Counts of like neighbours over 8 as a power of two, so that there are few different ones."""
    return count if count <= 8 else 1 << count.bit_length() - 1


def examples(text: str) -> Counter:
    """How often a unit of the text has a label, shape and labels around it: (label, shape as bits, numbers of labels of
    neighbours, and of like units) as a text."""
    found = units(text, base_spans(text))
    tokens, labels = [text[a:b] for _, a, b in found], [label for label, _, _ in found]
    around = [([0] * (len(KINDS) + 1), [0] * (len(KINDS) + 1)) for _ in found]
    for i, j, kind in edges(tokens, labels):
        around[i][kind][labels[j]] += 1
        around[j][kind][labels[i]] += 1
    return Counter(" ".join(map(str, (label, sum(1 << k for k, x in enumerate(_shape(token)) if x), *near, *map(_rounded, alike))))
                   for label, token, (near, alike) in zip(labels, tokens, around))


def fit(docs: DataFrame, text_col: str = "text", ridge: float = 2e-3) -> Field:
    """Learns the weights from all documents, equal texts once.

    The likelihood of every unit's label given its neighbours' labels is raised by Newton steps until it is flat; labels
    are those of the base spans. Every label counts the same in all, however rare, so a kind's weights do not depend on
    the size of the table. Units that look the same, with the same labels around, are counted in Spark: the driver
    gets one row for each combination. Without any base span in the documents the field labels nothing.
    """
    settle(docs.sparkSession)

    @F.arrow_udf("array<struct<key: string, n: bigint>>")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.array([[{"key": k, "n": n} for k, n in examples(t).items()] for t in texts.to_pylist()],
                        pa.list_(pa.struct([("key", pa.string()), ("n", pa.int64())])))

    once = (docs.where(F.col(text_col).rlike("[0-9@]"))
            .select(F.xxhash64(text_col).alias("a"), F.xxhash64(text_col, F.lit(13)).alias("b"), counted(F.col(text_col)).alias("e"))
            .groupBy("a", "b").agg(F.first("e").alias("e")))
    rows = once.select(F.explode("e").alias("e")).groupBy("e.key").agg(F.sum("e.n").alias("n")).orderBy("key").collect()
    labels = len(KINDS) + 1
    model = Field(np.zeros((len(SHAPE), labels)), np.zeros((2, labels, labels)))
    model.shape[0, 0] = 4.0  # nothing is personal data unless learned
    table = np.array([r["key"].split(" ") for r in rows], dtype=np.int64).reshape(len(rows), 2 + 2 * labels)
    y, n = table[:, 0], np.array([r["n"] for r in rows], float)
    if not y.any():
        return model
    x = (table[:, 1:2] >> np.arange(len(SHAPE)) & 1).astype(float)
    around = table[:, 2:].reshape(len(rows), 2, labels).astype(float)
    of = np.bincount(y, n, labels)
    learn(model, x, y, around, n / of[y] / np.count_nonzero(of), ridge)
    return model


def learn(model: Field, x: np.ndarray, y: np.ndarray, around: np.ndarray, w: np.ndarray, ridge: float, steps: int = 200) -> float:
    """Newton steps on the weighted likelihood less ``ridge`` times half the squared distance from the first weights;
    the tables of pairs stay symmetric. Gives the largest derivative left."""
    labels = model.shape.shape[1]
    pairs = [(i, j) for i in range(labels) for j in range(i, labels)]
    wide = x.shape[1] * labels
    size = wide + 2 * len(pairs)

    def features(at: slice) -> np.ndarray:
        """(row, label, weight)"""
        out = np.zeros((len(x[at]), labels, size))
        for label in range(labels):
            out[:, label, label:wide:labels] = x[at]
            for side in range(2):
                for p, (i, j) in enumerate(pairs):
                    if label in (i, j):
                        out[:, label, wide + side * len(pairs) + p] = around[at, side, j if label == i else i]
        return out

    first = np.concatenate([model.shape.ravel(), *[[model.pair[side][p] for p in pairs] for side in range(2)]])
    parts = [slice(k, k + 2_000) for k in range(0, len(x), 2_000)]

    def value(theta: np.ndarray) -> float:
        total = -ridge / 2 * ((theta - first) ** 2).sum()
        for at in parts:
            scores = features(at) @ theta
            top = scores.max(1)
            total += (w[at] * (scores[np.arange(len(scores)), y[at]] - top - np.log(np.exp(scores - top[:, None]).sum(1)))).sum()
        return total

    theta, steepest = first.copy(), math.inf
    for _ in range(steps):
        slope, curve = -ridge * (theta - first), ridge * np.eye(size)
        for at in parts:
            f = features(at)
            p = _softmax(f @ theta)
            mean = np.einsum("nl,nls->ns", p, f)
            slope += w[at] @ (f[np.arange(len(f)), y[at]] - mean)
            flat = (f * np.sqrt(p * w[at, None])[:, :, None]).reshape(-1, size)
            curve += flat.T @ flat - (mean * w[at, None]).T @ mean
        steepest = np.abs(slope).max()
        if steepest <= FLAT:
            break
        step, now, size_of = np.linalg.solve(curve, slope), value(theta), 1.0
        while size_of > 1e-9 and value(theta + size_of * step) < now:
            size_of /= 2
        theta = theta + size_of * step
    model.shape[:] = theta[:wide].reshape(model.shape.shape)
    for side in range(2):
        for p, (i, j) in enumerate(pairs):
            model.pair[side, i, j] = model.pair[side, j, i] = theta[wide + side * len(pairs) + p]
    return float(steepest)


def spans(text: Column, model: Field) -> Column:
    """array<struct<kind, start, end, base>> of a text, by kind in the order of KINDS, then place; code points, end
    exclusive. NULL and empty texts have none. Base spans are always there; others never overlap them."""

    @F.arrow_udf("array<struct<kind: string, start: bigint, end: bigint, base: boolean>>")
    def run(texts: pa.Array) -> pa.Array:
        ends, rows = [0], []
        for text in texts.to_pylist():
            rows += find(text, model)
            ends.append(len(rows))
        kind, start, end, base = zip(*rows) if rows else ((), (), (), ())
        flat = pa.StructArray.from_arrays([pa.array([KINDS[k] for k in kind], pa.string()), pa.array(start, pa.int64()),
                                           pa.array(end, pa.int64()), pa.array(base, pa.bool_())], ["kind", "start", "end", "base"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)

    return run(text)


def mask(docs: DataFrame, model: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans become one, named by the
    first. Texts without spans stay as they are, NULL stays NULL; no other column is changed or read."""
    name = free_name(docs, "found_spans")

    @F.arrow_udf("string")
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts.to_pylist(), lists.to_pylist()):
            if not found:
                out.append(text)
                continue
            pieces, done = [], 0
            for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= done:
                    pieces += [text[done:s["start"]], f"<{s['kind'].upper()}>"]
                done = max(done, s["end"])
            out.append("".join(pieces) + text[done:])
        return pa.array(out, pa.string())

    marked = docs.withColumn(name, spans(F.col(text_col), model))
    return marked.withColumn(text_col, F.when(F.size(name) > 0, run(F.col(text_col), F.col(name))).otherwise(F.col(text_col))).drop(name)
