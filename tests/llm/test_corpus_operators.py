"""Token counts, alignment of tokenizers, divergence of sources: against the libraries and plain versions, on awkward inputs."""

import os
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

os.environ["TOKENIZERS_PARALLELISM"] = "false"

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wakeline.llm import alignment, divergence, token_counts

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["'", "s", "t", "re", "ve", "m", "ll", "d", " ", "  ", "\n", "\t", "a", "l", "r", "v", "e", "é", "1", "²", "!", "…", "漢", "𝄞",
         "\xa0", "<|endoftext|>", "the", "S", "aaaa", "😀", "\x00", "Ⅷ", "े", "‍", "▁", "<s>", "<0x0A>", "word", " and"]
AWKWARD = [None, "", " ", "\n\n", "a", "a" * 5_000, " " * 1_000, "'" * 700, "aaaaab" * 999, "x" * 300 + "'re" + "x" * 400, "▁", "b▁c",
           "<|endoftext|>", "the quick " * 2_000, "漢" * 900, "  the", "the  "]


def texts(count, seed):
    r = random.Random(seed)
    return ["".join(r.choices(PARTS, k=r.randint(0, 30))) for _ in range(count)] + AWKWARD


def test_counts_equal_the_library():
    library = Tokenizer.from_file(BYTES)
    some = texts(20_000, 1)
    want = [len(e.ids) for e in library.encode_batch([t or "" for t in some], add_special_tokens=False)]
    own = token_counts.Counter(BYTES)
    assert own.count(some).tolist() == want
    own.forget()  # as when the bound of transitions is met
    assert own.count(some[-500:]).tolist() == want[-500:]


def test_every_code_point_has_the_class_of_the_library():
    library = Tokenizer.from_file(BYTES)
    own = token_counts.Counter(BYTES)
    points = [chr(c) for c in [*range(0x3400), *range(0xA000, 0xAC10), *range(0xF900, 0x13500), *range(0x16800, 0x1F000, 3)] if not 0xD800 <= c < 0xE000]
    some = ["".join(f"a{c}1{c}!{c} {c}{c}\n" for c in points[k:k + 50]) for k in range(0, len(points), 50)]
    want = [len(e.ids) for e in library.encode_batch(some, add_special_tokens=False)]
    assert own.count(some).tolist() == want


def test_scan_composes_maps():
    r = np.random.default_rng(3)
    maps = r.integers(0, 12, (37, 12)).astype(np.uint8)
    plain, state = [], np.arange(12)
    for row in maps:
        state = row[state]
        plain.append(state)
    assert (token_counts.scan(maps) == np.array(plain)).all()


def test_counts_do_not_depend_on_the_chunks(monkeypatch):
    own, some = token_counts.Counter(BYTES), texts(300, 4)
    want = own.count(some).tolist()
    for size in (1, 3, 17):
        monkeypatch.setattr(token_counts, "CHUNK", size)
        monkeypatch.setattr(token_counts, "RUN_BYTES", 50)
        assert own.count(some).tolist() == want


def test_count_column(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(AWKWARD)] + [(0, "again", "x", 2), (None, "no id", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `N_Tokens` string, n long").repartition(3)
    library = Tokenizer.from_file(BYTES)
    got = df.select("text", token_counts.token_count(F.col("text"), BYTES).alias("n")).collect()
    assert len(got) == len(rows)
    assert all(r.n == len(library.encode(r.text or "", add_special_tokens=False).ids) for r in got)
    assert df.limit(0).select(token_counts.token_count(F.col("text"), BYTES).alias("n")).collect() == []


def plain_alignment(docs):
    """Whole texts by the libraries, no words, no memo."""
    one = alignment.Aligner(BYTES, PIECES)
    links, out = Counter(), []
    for key, text in docs:
        want = (" " + (text or "")).encode()
        a, b = one.a.encode(" " + (text or ""), add_special_tokens=False).ids, one.b.encode(text or "")
        parts = [[one.a_bytes[i] for i in a], [one.b_bytes[i] for i in b]]
        if not text or any(b"".join(p) != want for p in parts):
            out.append((key, 0, 0, 0, [], ""))
            continue
        ends = [{e: k for k, e in enumerate(np.cumsum([len(x) for x in p]).tolist())} for p in parts]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for e in common:
            p, q = ends[0][e] + 1, ends[1][e] + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        pairs = [(a[ends[0][e]], b[ends[1][e]]) for e in common]
        links.update(pairs)
        out.append((key, len(a), len(b), len(groups), pairs, sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_a, b), n in links.items():
        best[b] = max(best[b], n)
    return Counter((key, a, b, g, len(p), sum(links[x] == best[x[1]] for x in p), sum(links[x] for x in p), told) for key, a, b, g, p, told in out)


def test_alignment_equals_whole_texts(spark, monkeypatch):
    docs = list(enumerate(texts(400, 7))) + [(3, "the same id"), (3, "the same id"), (None, "no id"), (None, None)]
    monkeypatch.setattr(alignment, "BLOCK_DOCS", 50)
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, Block long, pairs string").repartition(3)
    got = alignment.align_documents(df, BYTES, PIECES)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == plain_alignment(docs)


def test_alignment_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id string, text string")
    assert alignment.align_documents(df, BYTES, PIECES).collect() == []


def test_groups_and_links():
    def ends(*parts):
        return np.cumsum(np.array(list(map(len, parts)), np.int64))

    p, q, links = alignment.align(ends("a", "bc", "d"), ends("ab", "cd"))
    assert (p.tolist(), q.tolist(), links) == ([3], [2], None)  # no links given: the last ones of each group
    # A token without bytes ends where the one before it ends: both are linked.
    p, q, links = alignment.align(ends("a", "b"), ends("a", "", "b"))
    assert (p.tolist(), q.tolist(), links) == ([1, 2], [2, 3], [(0, 0), (0, 1), (1, 2)])
    p, q, links = alignment.align(ends(), ends())
    assert (p.tolist(), q.tolist(), links) == ([], [], None)


def plain_divergence(docs, least, top, scale=1_000_000_000, prior=5):
    docs = [(lang or "", source or "", re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
            for text, lang, source in docs]
    out = Counter()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        in_docs = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in in_docs.items() if n >= least}
        groups = {s: Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in own}}

        def share(count):
            n = sum(count.values()) + prior * len(kept)
            return {t: 1 + scale * (count[t] + prior) // n for t in kept}

        p, q = {s: share(c) for s, c in groups.items()}, share(sum(groups.values(), Counter()))
        for s in groups:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s), key=lambda x: (x[0], x[1].encode()))
            terms = sorted(((q[t] - p[s][t], t) for t in kept if groups[s][t] and p[s][t] > q[t]), key=lambda x: (x[0], x[1].encode()))[:top]
            out.update((lang, s, part, item, -v, k + 1) for part, found in (("pair", pairs), ("term", terms)) for k, (v, item) in enumerate(found))
    return out


@pytest.mark.parametrize("blocks", [64, 2])
def test_divergence_equals_plain(spark, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", blocks)
    monkeypatch.setattr(divergence, "SLICE_TERMS", 4 * blocks)
    monkeypatch.setattr(divergence, "MOST_SUMS", 40)
    r = random.Random(5)
    words = ["the", "The", "É", "é", "漢字", "a1b", "x-y", "wörd", "zebra", "İ", "K", "ß", "😀", "o'clock", "A_B"]
    docs = [(" ".join(r.choices(words, k=r.randint(0, 9))), r.choice(["en", "de", None]), r.choice(["s1", "s2", "s3", "s4", "é", None])) for _ in range(300)]
    docs += [("the same text the", "en", s) for s in ("s1", "s1", "s2", None)] * 30 + [(None, "fr", "s1"), ("12 !", "fr", "s2"), ("", "", ""), (None, None, None)]
    docs += [("zebra " * 3_000, "en", "hot")]
    df = spark.createDataFrame([(*d, "x", 1.5) for d in docs], "text string, lang string, source string, Term string, value double").repartition(4)
    got = divergence.divergence(df, least_docs=10, top=5)
    assert Counter(tuple(x) for x in got.collect()) == plain_divergence(docs, 10, 5)


def test_divergence_without_rows_or_terms(spark):
    kind = "text string, lang string, source string"
    assert divergence.divergence(spark.createDataFrame([], kind)).collect() == []
    got = divergence.divergence(spark.createDataFrame([("a", "en", "s"), ("b", "en", "t")], kind)).collect()
    assert {tuple(x) for x in got} == {("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)}


def test_shares_are_exact(spark):
    big = 3_000_000_000_000  # a billion times this is over 64 bits
    got = spark.range(1).select(divergence.share(F.lit(big), F.lit(2 * big + 1), F.lit(7).cast("bigint"), 1_000_000_000, 5).alias("p")).first().p
    assert got == 1 + 1_000_000_000 * (big + 5) // (2 * big + 1 + 35)
