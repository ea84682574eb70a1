"""A quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text is binned; for each, boosting goes round the features in turn and adds a shallow
tree over that feature alone, with a small step, to its lookup table. Then the pairs of features that best
explain what is left get tables of their own. A score is the sum of table entries, so scoring is a few
vectorised additions.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import settle

#: Most labelled rows that a model is fitted on, about: more are thinned by a hash of the id.
FIT_ROWS = 20_000

#: Features of a text, in order.
FEATURES = ("log_words", "word_chars", "longest_word", "letters", "capitals", "digits", "blanks", "other_bytes", "marks", "stops",
            "bars", "exclamations", "symbols", "distinct_words", "top_word", "repeated_next", "distinct_lines", "line_words",
            "capital_words", "wordless", "marked_words")

_KINDS = np.zeros((256, 9), dtype=np.float64)
for _k, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t\n\r\x0b\x0c", range(128, 256), b",.;:?'\"()-",
                             b"|", b"!", b"&%$#*@=<>{}[]~^_\\/+`")):
    _KINDS[list(_bytes), _k] = 1.0


def features(text: str | None) -> tuple[float, ...]:
    """Numbers that describe the whole text; a NULL, empty or blank text is all zeros."""
    words = text.split() if text else ()
    if not words:
        return (0.0,) * len(FEATURES)
    raw = np.frombuffer(text.encode(), np.uint8)
    small, capital, digit, blank, other, marks, bars, shouts, symbols = (np.bincount(raw, minlength=256) @ _KINDS / len(raw)).tolist()
    n = len(words)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line]
    lengths = list(map(len, words))
    ends = "".join([w[-1] for w in words])
    return (float(np.log1p(n)), sum(lengths) / n, float(np.log1p(max(lengths))), small + capital, capital, digit, blank, other, marks,
            sum(map(ends.count, ".,")) / n, bars, shouts, symbols, len(counts) / n, counts.most_common(1)[0][1] / n,
            sum(map(eq, words, words[1:])) / n, len(set(lines)) / max(1, len(lines)), float(np.log1p(n / max(1, len(lines)))),
            sum(map(str.isupper, words)) / n, sum([not any(map(str.isalpha, w)) for w in counts]) / len(counts),
            sum(map(ends.count, "&%$#*!|")) / n)


def feature_column(text: Column) -> Column:
    """array<double> of FEATURES."""

    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        rows = [features(t) for t in texts.to_pylist()]
        return pa.FixedSizeListArray.from_arrays(pa.array(np.array(rows, float).ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))

    return run(text)


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables by feature, tables by pair of features, and what every score starts from."""

    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1) if self.edges else x

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features."""
        total = np.full(len(x), self.start)
        b = self.bins(x)
        for j, table in enumerate(self.tables):
            total += table[b[:, j]]
        for i, j, table in self.pairs:
            total += table[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-total))


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int, least: float, ridge: float) -> np.ndarray:
    """Leaf value of every bin: the best splits of one ordered feature, up to ``leaves`` leaves."""
    spans = [(0, len(grad))]
    cg, ch = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    worth = lambda g, h: g * g / (h + ridge)
    while len(spans) < leaves:
        best = (1e-9, None, None)
        for a, b in spans:
            cut = np.arange(a + 1, b)
            if not len(cut):
                continue
            gl, hl, gr, hr = cg[cut] - cg[a], ch[cut] - ch[a], cg[b] - cg[cut], ch[b] - ch[cut]
            gain = np.where((hl >= least) & (hr >= least), worth(gl, hl) + worth(gr, hr) - worth(cg[b] - cg[a], ch[b] - ch[a]), 0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (a, b), int(cut[k]))
        if best[1] is None:
            break
        spans.remove(best[1])
        spans += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(grad))
    for a, b in spans:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, step: float = 0.1, most_bins: int = 32, leaves: int = 3,
        pairs: int = 6, pair_rounds: int = 40) -> AdditiveModel:
    """Boosts the tables on features ``x`` and labels ``y`` (0 or 1). One label alone, or none, gives a constant."""
    rate = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(rate / (1 - rate))))
    if len(np.unique(y)) < 2:
        return model
    for j in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, j], np.linspace(0, 1, most_bins + 1)[1:-1])))
    b = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in sizes]
    total = np.full(len(y), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, size in enumerate(sizes):
            grad, hess = slopes()
            add = step * _tree(np.bincount(b[:, j], grad, size), np.bincount(b[:, j], hess, size), leaves, 1.0, 1.0)
            model.tables[j] += add
            total += add[b[:, j]]
    # Pairs whose joint bins leave the most unexplained.
    grad, hess = slopes()
    gains = []
    for i, j in combinations(range(x.shape[1]), 2):
        cell = b[:, i] * sizes[j] + b[:, j]
        g, h = np.bincount(cell, grad, sizes[i] * sizes[j]), np.bincount(cell, hess, sizes[i] * sizes[j])
        gains.append((float((g * g / (h + 5.0)).sum()), i, j))
    chosen = [(i, j, np.zeros((sizes[i], sizes[j]))) for _gain, i, j in sorted(gains, reverse=True)[:pairs]]
    for _ in range(pair_rounds):
        for i, j, table in chosen:
            grad, hess = slopes()
            cell = b[:, i] * sizes[j] + b[:, j]
            g = np.bincount(cell, grad, table.size).reshape(table.shape)
            h = np.bincount(cell, hess, table.size).reshape(table.shape)
            # A split of one feature, then of the other on either side.
            side = _tree(g.sum(1), h.sum(1), 2, 1.0, 1.0)
            low = side == side[0]
            add = np.empty_like(table)
            for rows in (low, ~low):
                if rows.any():
                    add[rows] = step * _tree(g[rows].sum(0), h[rows].sum(0), 2, 1.0, 5.0)
            table += add
            total += add[b[:, i], b[:, j]]
    model.pairs = chosen
    return model


def fit_labelled(docs: DataFrame, labels: DataFrame, label: str, allowed: Column | None = None, id_col: str = "doc_id",
                 text_col: str = "text", most: int = FIT_ROWS) -> AdditiveModel:
    """Fits a model on the labelled rows (those ``allowed``, an expression over ``id``), on about ``most`` at most.

    Labels other than 0 and 1 and rows without an id are left out. The thinning is by a hash of the id, so it
    is the same in every run. The sample is broadcast: its size is bounded by ``most``, whatever the data.
    """
    settle(docs.sparkSession)
    marked = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label")).where("label IN (0, 1) AND id IS NOT NULL")
    if allowed is not None:
        marked = marked.where(allowed)
    count = marked.count()
    if count > most:
        marked = marked.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1_000_000)) < F.lit(int(1_000_000 * most / count)))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(marked), "id")
    # Rows come to the driver as numbers, in an order that does not depend on partitions.
    rows = texts.select("id", "label", feature_column(F.col("text")).alias("x")).toArrow().sort_by([("id", "ascending"), ("label", "ascending")])
    if not rows.num_rows:
        return AdditiveModel(0.0)
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return fit(x, rows.column("label").to_numpy().astype(float))


def score(text: Column, model: AdditiveModel) -> Column:
    """Probability that a text has label 1; NULL and empty texts get that of a text of no words."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        x = np.array([features(t) for t in texts.to_pylist()], float).reshape(-1, len(FEATURES))
        return pa.array(model.score(x))

    return run(text)


def with_quality(docs: DataFrame, model: AdditiveModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column of scores; every row is kept, and no other column is read."""
    return docs.withColumn(out, score(F.col(text_col), model))
