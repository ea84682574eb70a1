"""Operators on one text at a time: exact against the public libraries or plain versions, on awkward inputs."""

import base64
import hashlib
import html
import json
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wakeline.llm import byte_bpe, chat, fingerprints, html_extract, packing, pii, quality, sharding
from wakeline.llm.shingles import shingles

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LETTERS = "abcdeé ñ\n\t  '!?.,0123٣²½字漢😀\x1c\x85 aaaa<|endoftext|>"
AWKWARD = [None, "", " ", "\n\n", "a", "a" * 20_000, " " * 3_000 + "x", "é" * 5_000, "it's  'll\t\n x", "<|endoftext|>", "the quick " * 2_000]


def random_texts(count, seed):
    r = random.Random(seed)
    return ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 60))) for _ in range(count)]


def documents(spark, texts):
    """Rows with extra columns whose names clash, over several partitions."""
    rows = [(i, t, "x", 1.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, `Text_` string, start double").repartition(3)


def test_bpe_equals_tiktoken():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = byte_bpe.ByteBpe(RANKS, PATTERN)
    for text in random_texts(4_000, 1) + [t for t in AWKWARD if t]:
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_bpe_columns(spark):
    df = documents(spark, AWKWARD)
    ids = byte_bpe.encode(F.col("text"), RANKS, PATTERN)
    rows = df.select("doc_id", "text", ids.alias("ids")).select(
        "*", byte_bpe.decode(F.col("ids"), RANKS, PATTERN).alias("back"), byte_bpe.ids_sha256(F.col("ids")).alias("digest")).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        assert bytes(r.back) == (r.text or "").encode()
        assert r.digest == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
    assert df.limit(0).select(ids.alias("ids")).collect() == []


def test_tokens_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    own = packing._tokenizer(path)
    texts = random_texts(3_000, 2) + [t for t in AWKWARD if t] + ["a" + " " * 200_000 + "b", "\n" * 1_200_000, "x" * 300_000, "<|endoftext|>"]
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(f"a{c}a {c}1 {c}{c} !{c}! " for c in points[i:i + 50]) for i in range(0, len(points), 50)]  # every character in several places
    for text in texts:
        assert own(text).tolist() == library.encode_batch_fast([text], add_special_tokens=False)[0].ids


def test_every_pair_of_tokens_that_is_a_token_merges_as_in_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)
    library, ranks = Tokenizer.from_file(path), packing.as_ranks(vocabulary)
    for token, i in vocabulary["model"]["vocab"].items():  # no two tokens of a finished text could still be one
        assert packing._byte_alphabet().keys() >= set(token) and [t.id for t in library.model.tokenize(token)] == [i]
    assert len(ranks) == len(vocabulary["model"]["vocab"])


def test_a_vocabulary_that_ranks_do_not_describe_is_left_to_the_library():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        assert packing.as_ranks(json.load(file)) is None
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = json.load(file)
    merges = vocabulary["model"]["merges"]
    merges[0], merges[1] = merges[1], merges[0]
    assert packing.as_ranks(vocabulary) is None
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    assert packing._tokenizer(path)("Two words, 3 marks!").tolist() == library.encode("Two words, 3 marks!", add_special_tokens=False).ids


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_fit_keeps_every_capacity(rule):
    lengths = np.sort(np.random.default_rng(1).integers(1, 100, 800))[::-1]
    capacity = packing.Capacity(100, 4, 6_000)
    lengths = lengths[lengths ** 2 <= 6_000]
    sequence = packing.fit(lengths, capacity, rule)
    assert np.bincount(sequence, lengths).max() <= 100
    assert np.bincount(sequence).max() <= 4
    assert np.bincount(sequence, lengths ** 2).max() <= 6_000
    plain = packing.fit(lengths, packing.Capacity(100), rule)
    assert plain.max() + 1 <= 1.02 * lengths.sum() / 100 + 1


def test_pack_documents(spark):
    df = documents(spark, AWKWARD + AWKWARD)
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack_documents(df, path, 2, packing.Capacity(64)).collect()
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(AWKWARD + AWKWARD):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces))) and sum(p.length for p in pieces) == len(ids)
        assert all(p.length == 64 for p in pieces[1:]) and (len(ids) > 64) == (len(pieces) > 1)
        at = 0
        for p in pieces:
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
    for rows_of in by_sequence.values():
        at = 0
        for r in sorted(rows_of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert packing.pack_documents(df.limit(0), path, 2).collect() == []


def test_fingerprints(spark):
    a, b = shingles("one two three four five six seven " * 3, 5), shingles("x y z", 5)
    assert fingerprints.likeness(fingerprints.write(a), fingerprints.write(a)) == 1.0
    assert fingerprints.likeness(fingerprints.write(a), fingerprints.write(b)) < 1.0
    big = shingles(" ".join(f"w{i}" for i in range(20_000)), 5)
    part = shingles(" ".join(f"w{i}" for i in range(4_000)), 5)
    assert abs(fingerprints.containment(fingerprints.write(part), fingerprints.write(big)) - 1) < 0.05
    assert abs(fingerprints.containment(fingerprints.write(big), fingerprints.write(part)) - 0.2) < 0.05
    merged = fingerprints.read(fingerprints.merge(fingerprints.write(part), fingerprints.write(a)))[1]
    assert set(merged) == set(fingerprints.read(fingerprints.write(part))[1]) | set(fingerprints.read(fingerprints.write(a))[1])


@pytest.mark.parametrize("parts", [1, 4, 9, 4500])
def test_next_by_descending_id(spark, parts):
    texts = [f"t{i} " * (i % 5) for i in range(40)] + [None, ""]
    rows = [(i // 2 * 3, t) for i, t in enumerate(texts)] + [(None, "n1"), (None, "n2")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    order = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda r: (-r[0], r[1])) + [(None, "n1"), (None, "n2")]
    want = sorted((str(i), t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order))
    assert sorted((str(r.id), r.text, r.next_text) for r in fingerprints.with_next(df, "doc_id", "text", parts).collect()) == want
    assert fingerprints.fingerprint_edits(df.limit(0)).collect() == []
    one = fingerprints.fingerprint_edits(df.where("doc_id = 0").limit(1)).first()
    assert one.near_next == 1.0


def test_quality_learns_and_scores_awkward_texts(spark):
    r = random.Random(4)
    good = [" ".join(r.choice(["the", "and", "tion", "er", "ly"]) + r.choice("abcd") for _ in range(r.randint(1, 80))) + "." for _ in range(150)]
    bad = [t.upper().replace(" ", "!! ") for t in good]
    df = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)] + [(5, None), (None, 1), (999, 0)], "doc_id long, quality int")
    model = quality.fit_labelled(df, labels, "quality", F.col("id") % 3 != 0)
    scored = quality.with_quality(df, model, out="s").where("doc_id % 3 = 0").collect()
    assert np.mean([(x.s >= 0.5) == (x.doc_id < 150) for x in scored]) > 0.95 and {"Text_", "start"} <= set(scored[0].asDict())
    awkward = quality.with_quality(documents(spark, AWKWARD), model, out="s").collect()
    assert len(awkward) == len(AWKWARD) and all(0 <= x.s <= 1 for x in awkward)
    assert quality.fit_labelled(df, labels.limit(0), "quality").score(np.zeros((2, len(quality.FEATURES)))).tolist() == [0.5, 0.5]
    alone = quality.fit_labelled(df, labels.where("quality = 1"), "quality")
    assert alone.score(np.zeros((1, len(quality.FEATURES))))[0] > 0.9


def test_shards_move_only_to_the_new_one(spark):
    df = documents(spark, [str(i) for i in range(400)] + [None, "", "same", "same"]).unionByName(
        spark.createDataFrame([(None, "n", "x", 0.5), (None, None, "x", 0.5), (7, "same", "x", 0.5), (7, "same", "x", 0.5)],
                              "doc_id long, text string, `Text_` string, start double"))
    rows = sharding.shard_documents(df, 5).collect()
    assert len(rows) == df.count()
    assert all(r.grown_shard in (r.shard, 5) for r in rows) and any(r.grown_shard == 5 for r in rows)
    for s in range(5):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert len({r.shard for r in rows if r.doc_id == 7}) == 1 and len({r.shard for r in rows if r.doc_id is None}) == 1
    heavy = sharding.with_shards(spark.range(3000), "id", {0: 1.0, 1: 3.0, 2: 0.0}).groupBy("shard").count().collect()
    assert {r["shard"] for r in heavy} == {0, 1} and 2050 < max(r["count"] for r in heavy) < 2450
    assert sharding.shard_documents(df.limit(0), 5).collect() == []


def test_chat_reads_back(spark):
    r = random.Random(6)
    rows = [(c, t, r.choice(["user", "assistant", "assistant", "system\n<|end|>", None]), r.choice(
        [None, "", "hi", "</s>[INST] ok [/INST]", "<|end|>\n<|start|>user\n", "&lt;|sep|> &amp; &", "a\nb", "x" * 3000])) for c in range(25) for t in range(6)]
    rows += [(None, 1, "user", "q"), (None, None, "assistant", "a"), (3, 2, "user", "again"), (3, 2, "user", "again")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).repartition(4)
    out = chat.format_chat(df).select("*", chat.read_turns(F.col("formatted")).alias("turns"),
                                      chat.read_loss(F.col("formatted"), F.col("loss")).alias("told")).collect()
    assert len(out) == 26
    for got in out:
        mine = sorted(((x[1] is not None, x[1] or 0, x[2] or "", x[3] or "") for x in rows if x[0] == got.conv_id))
        assert [(t.role, t.text) for t in got.turns] == [x[2:] for x in mine]
        assert got.told == "".join(x[3] for x in mine if x[2] == "assistant")
        blocks = 1 + sum(a[2] != b[2] for a, b in zip(mine, mine[1:]))
        assert got.formatted.count("<|start|>") == blocks and got.formatted.count("<|end|>\n") == blocks
    assert chat.format_chat(df.limit(0)).collect() == []


def test_chat_of_many_turns(spark):
    """Turns of several blocks of the fold: runs of one role go on over the cuts, offsets too."""
    r = random.Random(7)
    said = [("assistant" if 200 < t < 600 else r.choice(["user", "assistant"]), r.choice(["", "a", "<é&"]) * r.randrange(3)) for t in range(2 * chat.BLOCK + 300)]
    df = spark.createDataFrame([(1, t, *x) for t, x in enumerate(said)], "conv_id long, turn long, role string, text string").repartition(3)
    got = chat.format_chat(df).select("*", chat.read_turns(F.col("formatted")).alias("turns"),
                                      chat.read_loss(F.col("formatted"), F.col("loss")).alias("told")).first()
    assert [(t.role, t.text) for t in got.turns] == said
    assert got.told == "".join(x for role, x in said if role == "assistant") and len(got.loss) == sum(role == "assistant" for role, _ in said)
    assert got.formatted.count("<|start|>") == 1 + sum(a[0] != b[0] for a, b in zip(said, said[1:]))


PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m.group().split(".")) or kind == 2 and 16 <= len(digits) <= 19
                    and pii.luhn(digits) or kind == 3 and 8 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_a_plain_search():
    r = random.Random(3)
    parts = ["a", "b.", "@", "1", "2", "255", ".", ". ", "-", "+", " ", "(", ")", "4111111111111111", "+1", "é", "12.3.4.5", "a@b.c", "00"]
    for _ in range(15_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert pii.base_spans(text) == plain_spans(text)


def test_field_carries_labels_to_like_tokens(spark):
    r = random.Random(8)

    def phone():
        return f"+1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)}"

    texts = [f"call {p} or {p} about {r.randint(1, 99)} of {r.randint(1990, 2030)}" for p in (phone() for _ in range(300))]
    texts += [f"write {n}@mail{r.randint(1, 9)}.example.com, item {r.randint(1, 500)}" for n in ("ann", "bob", "cyd") for _ in range(40)]
    df = documents(spark, texts + AWKWARD)
    model = pii.fit(df)
    held = "+1 (017) 555-7713"
    found = pii.find(f"ring {held} soon, that is 017-555-7713, in 2020", model)
    assert [(k, base) for k, _, _, base in found] == [(3, True), (3, False)]
    assert pii.find("nothing here in 2020 or 17", model) == []
    rows = df.select("doc_id", "text", pii.spans(F.col("text"), model).alias("s")).collect()
    assert len(rows) == df.count()
    for row in rows:
        assert [(pii.KINDS.index(s.kind), s.start, s.end) for s in row.s if s.base] == plain_spans(row.text or "")
    masked = {x.doc_id: x.text for x in pii.mask(df, model).collect()}
    assert masked[0].startswith("call <PHONE> or <PHONE> about") and masked[len(texts)] is None and masked[len(texts) + 1] == ""
    assert pii.find("a@b.c", pii.fit(df.limit(0))) == [(0, 0, 5, True)]
    assert pii.mask(df.limit(0), model).collect() == []


def page(title, body, nav="menu", extra=""):
    return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><a>{nav}</a></nav>"
            f"<!-- <p>no</p> --><div class='ad'>buy</div>{body}<footer>&copy; x</footer>{extra}</body></html>")


def test_blocks_of_marked_pages():
    got = html_extract.parse(page("t", "<article><h1>A &amp;&#33; b</h1><p><b>one\n two<br><p>three <i>f</i>our<div class=comments>no</div>"
                                       "<aside>no</aside><form>no</form><p>a < b &lt;p&gt;</article>"))
    assert [b["text"] for b in got["blocks"]] == ["A &! b", "one two", "three four", "a < b <p>"]
    cut = html_extract.parse("<body><article><p>one</p><p>two &am")
    assert [b["text"] for b in cut["blocks"]] == ["one", html.unescape("two &am")]
    for empty in (None, "", "<", "<!--", "<p", "<script>x", "</p>", "<nav>x</nav>"):
        assert [b["text"] for b in html_extract.parse(empty)["blocks"]] in ([], ["<"])
    deep = html_extract.parse("<div>" * 3000 + "x" + "</div>" * 3000)
    assert [b["text"] for b in deep["blocks"]] == ["x"]


def test_wrapper_drops_what_a_host_repeats(spark):
    rows = [(i, f"http://a.example/{i}", f"<body><div>Welcome to A</div><section><p>story {i} of {i * i}</p></section><div>Imprint</div></body>") for i in range(8)]
    rows += [(20 + i, "http://b.example/x", "<body><div>Same page</div><p>copied</p></body>") for i in range(5)]
    rows += [(30, None, None), (31, "nohost", ""), (32, "http://c.example/", page("t", "<article><h1>T</h1><p>p</p></article>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("text", F.lit(1)).repartition(3)
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    assert len(got) == len(rows)
    assert all(got[i].text == f"story {i} of {i * i}" for i in range(8))
    assert all(got[20 + i].text == "Same page\ncopied" for i in range(5))  # copies say nothing about the template
    assert got[30].text == "" and got[30].n_chars == 0 and got[31].text == "" and got[32].text == "T\np" and got[32].n_chars == 3
    assert html_extract.extract(df.limit(0)).collect() == []


def test_simple_tree_matching():
    a = html_extract.tree_of(["/0:html/0:div", "/0:html/1:p", "/0:html/2:div/0:p"])
    b = html_extract.tree_of(["/0:html/0:p", "/0:html/1:div/0:p"])
    size, pairs = html_extract.match(a, b)
    assert size == 4 and ("/0:html/2:div/0:p", "/0:html/1:div/0:p") in pairs
    assert json.dumps(html_extract.match({}, b)) == "[0, []]"


def content(source):
    return [b["text"] for b in html_extract.parse(source)["blocks"]]


def test_marked_words_are_votes():
    body = "<p>" + "long story " * 40 + "</p>"
    story = ("long story " * 40).strip()
    for around in ('<body class="no-sidebar">{}', '<div class="content with-sidebar">{}</div>', '<div class="elementor-widget x">{}</div>',
                   '<div id="page-header-fixed">{}</div>', '<div class="search-page"><div class="with-sidebar">{}</div></div>'):
        for inner in (body, f"<article>{body}</article>", f"<article class='post widget'>{body}</article>"):
            assert content(around.format(inner)) == [story]
            assert content(around.format(inner + "<div class='related'>more</div>")) == [story]
    assert content(f"<article><div class='article-header'><h1>Head</h1><h2>Lead</h2></div>{body}<div class=comments>no</div></article>") == ["Head", "Lead", story]
    assert content(f"<div class='header'><h1>Head</h1>menu</div>{body}") == ["Head", story]
    assert content(f"<div class=widget>{body}</div><div class=widget>{body}</div><p>short</p>") == [story, story, "short"]
    assert content(f"<div class=related><article><p>teaser</p></article></div>{body}") == ["teaser", story]  # one article alone
    assert content(f"<article>{body}</article><div class=related><article><p>teaser</p></article></div>") == [story]
    assert content("<p>one <span class='search'>two</span> three</p>") == ["one two three"]


def test_marked_text_beside_template(spark):
    rows = [(i, f"http://a.example/{i}", f"<body class=no-sidebar><div class=top>{'Welcome to A ' * 20}</div><div class='main widget'>story {i} of {i * i}</div></body>")
            for i in range(6)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].endswith(f"story {i} of {i * i}") for i in range(6))


def test_only_repeated_texts_are_template(spark):
    def html_of(title, body):
        return f"<body><div>Welcome</div><h1>{title}</h1><section>{body}</section><div>Imprint</div></body>"

    near, own = "copied story " * 20, [f"story {i} " * 20 for i in range(10)]
    pages = [html_of(f"copy {i}", near) for i in range(20)] + [html_of(f"head {i}", t) for i, t in enumerate(own)]
    pages += [html_of(f"note {i}", "Members only, please log in" * 2) + f"<p>{'teaser %d ' % i * 30}</p>" for i in range(12)]
    df = spark.createDataFrame([(i, "http://a.example/x", p) for i, p in enumerate(pages)], "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert [got[i] for i in range(20)] == [f"copy {i}\n{near.strip()}" for i in range(20)]
    assert [got[20 + i] for i in range(10)] == [f"head {i}\n{t.strip()}" for i, t in enumerate(own)]
    assert [got[30 + i] for i in range(12)] == [f"note {i}\n{('teaser %d ' % i * 30).strip()}" for i in range(12)]


def test_long_tags_end_where_they_end():
    data = "x > y " * 30_000
    assert content(f"<article><p data-page='{data}' title=\"it's > that\">one</p><p title=it's>two</p></article>") == ["one", "two"]
    assert content('<article><p>one</p><p title="never closed>two</p></article>') == ["one", "two"]
    assert content("<article><p>one</p>" + "<p title='x" * 50_000) == ["one"]


def test_rare_kinds_are_learned_whatever_the_table(spark):
    r = random.Random(9)
    rare = [f"call {p} or {p} today" for p in (f"+1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)}" for _ in range(6))]
    common = [f"host 10.{i % 250}.{i % 7}.{i % 99} and 10.{i % 250}.{i % 7}.{i % 99} of item {i} in {1990 + i % 40}" for i in range(9_000)]
    held = "ring +1 (017) 555-7713 soon, that is 017-555-7713, in 2020"
    for texts in (rare + common[:60], rare + common, rare + common[:60] + [common[0]] * 9_000):
        found = pii.find(held, pii.fit(documents(spark, texts)))
        assert [(k, base) for k, _, _, base in found] == [(3, True), (3, False)]


def test_weights_are_learned_until_flat():
    r = np.random.default_rng(1)
    x, y = (r.random((300, len(pii.SHAPE))) < 0.5).astype(float), r.integers(0, 5, 300)
    model = pii.Field(np.zeros((len(pii.SHAPE), 5)), np.zeros((2, 5, 5)))
    assert pii.learn(model, x, y, r.integers(0, 3, (300, 2, 5)).astype(float), np.full(300, 1 / 300), 2e-3) <= pii.FLAT


def test_labels_reach_every_mention_of_a_text(spark):
    phones = [f"+1 ({100 + i}) 555-{1000 + i}" for i in range(200)]
    model = pii.fit(documents(spark, [f"call {p} or {p} about {i}" for i, p in enumerate(phones)]))
    for before, after in ((0, 60), (60, 0), (30, 30)):
        text = "that is 017-555-7713, " * before + "ring +1 (017) 555-7713 soon, " + "that is 017-555-7713, " * after
        assert [base for *_, base in pii.find(text, model)].count(False) == 60
    tokens, labels = ["017-555-7713"] * 1_000, [0] * 999 + [4]
    links = pii.edges(tokens, labels)
    assert {i for i, j, kind in links if j == 999 and kind} == set(range(999)) and len(links) <= 3 * len(tokens)


@pytest.mark.parametrize("words, mean, most", [(14, 0.11, 0.32), (30, 0.07, 0.2), (120, 0.035, 0.09), (4_000, 0.008, 0.02)])
def test_likeness_error_by_length(words, mean, most):
    r = random.Random(words)
    errors = []
    for k in range(300):
        text = [f"w{k}x{i}" for i in range(words)]
        a, b = (shingles(" ".join(t), 5) for t in (text, text[:r.randint(0, words)] + ["other"] * 5))
        shared = len(np.intersect1d(a, b))
        errors.append(abs(fingerprints.likeness(fingerprints.write(a), fingerprints.write(b)) - shared / (len(a) + len(b) - shared)))
    assert np.mean(errors) <= mean and np.quantile(errors, 0.95) <= most


def test_edits_equal_a_plain_computation(spark):
    """Every column of op3 against plain Python, over texts that are empty, short, repeated and long."""
    r = random.Random(5)
    words = [f"w{i}é" for i in range(40)]
    texts = [None, "", "one", " "] + [" ".join(r.choices(words, k=r.choice([3, 12, 90, 900]))) for _ in range(60)] + ["same words here and there again"] * 4
    df = spark.createDataFrame([(7 * i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fingerprint string").repartition(6)
    got = {row.doc_id: row for row in fingerprints.fingerprint_edits(df).collect()}
    assert len(got) == len(texts)

    def kept(text):
        every = shingles(text, fingerprints.WORDS)
        return {int(x) for x in every}, {int(x) for x in every if int(x) < 2 ** 64 // fingerprints.ONE_IN}

    def like(a, b):
        (all_a, a), (all_b, b) = kept(a), kept(b)
        return 1.0 if all_a == all_b else min(len(a & b) / len(a | b), 1 - 2.0 ** -20) if a | b else 0.0

    for i, text in enumerate(texts):
        row, own, after = got[7 * i], text or "", texts[i - 1] or ""
        edited = own[:len(own) - len(own) // 2] + after[:len(own) // 2]
        assert (row.n_chars, row.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert {int(x) for x in fingerprints.read(row.fingerprint)[1]} == kept(own)[1]
        assert {int(x) for x in fingerprints.read(row.edited_fingerprint)[1]} == kept(edited)[1]
        assert row.near_edited == pytest.approx(like(own, edited)) and row.near_next == pytest.approx(like(own, after))


def test_shapes_read_whole_tokens():
    names = dict(zip(pii.SHAPE, range(len(pii.SHAPE))))
    token = "-" * 100 + "x" + "4111111111111111"
    shape = pii._shape(token)
    assert shape[names["digits 16-19"]] and shape[names["luhn"]] and shape[names["letters"]] and not shape[names["digits only"]]
    assert pii._shape("0" * 80 + "10.0.0.1")[names["parts to 255"]] and not pii._shape("10.0.0." + "9" * 5000)[names["parts to 255"]]
    assert not pii._shape("1.2.3.4.5")[names["three dots"]] and pii._shape("1.2.3.4")[names["three dots"]]
    assert pii._shape("9" * 5000)[names["digits only"]]


def test_deep_paths_tell_places_apart():
    deep = "<div>" * 60 + "<p>one</p><section><p>two</p></section><section><b>three</b></section>" + "</div>" * 60
    paths = [path for path, *_ in html_extract.blocks(deep)]
    assert len(paths) == 3 and len(set(paths)) == 3 and all(len(p.split("/")) == html_extract.PATH_DEPTH + 2 for p in paths)
    assert paths == [path for path, *_ in html_extract.blocks(deep)] and paths[0].endswith(":flow")
    tree = html_extract.tree_of(paths)
    assert sorted(a for a, b in html_extract.match(tree, tree)[1] if a == b and a in paths) == sorted(paths)
