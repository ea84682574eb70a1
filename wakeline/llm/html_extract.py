"""Main text of web pages by wrapper induction.

Every page becomes a tree of labelled nodes in which runs of like siblings count as one. The trees of a host
are aligned, by simple tree matching, with the host's most common tree, so that a node of any page has a slot
of the host. A text that a slot holds on most different pages of its host is template; other texts of the slot,
on other pages, are content. What tags say outright (navigation, footers, scripts) is never content, and a page that marks
its article or main part has its content there: headings and running text of it are kept. A word of a class, id or
role that tells of adverts, comments and the like only marks what is under it: marked text goes where it is small
beside the unmarked text of its page, or where it is template.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import settle
from wakeline.session import cut_lineage

#: A text of a slot is template from this share of a host's different pages on, and from so many pages on.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.5, 3
#: Text under one marked word goes from a page if it is up to this share of the page's unmarked text.
MARKED_SMALL = 0.25
#: From this level on a path ends in one step that hashes all deeper ones, so paths stay short and no two places share one.
PATH_DEPTH = 40
#: A list of template texts up to this many bytes may be broadcast; a larger one is joined by host.
BROADCAST_BYTES = 8 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
                    "strike strong sub sup time tt u var wbr input").split())
FLOW = frozenset("p h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr".split())
ASIDE_TAGS = frozenset(("head nav footer aside form script style textarea title noscript iframe xmp template button select option svg canvas "
                        "object menu dialog input").split())
#: Words of a class, id or role that mark what may not be the article. They are no mark on the elements of NEVER_MARKED.
ASIDE_WORDS = frozenset(("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar "
                         "navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert popup modal "
                         "newsletter subscribe subscription comment comments disqus replies share sharing social related recommended widget login "
                         "signup search toolbar pagination contentinfo complementary").split())
NEVER_MARKED = frozenset("html body article main h1".split())
#: Words that, like the tag header, mark nothing inside the main part.
HEADER_WORDS = frozenset("header masthead".split())
#: Which open elements a start tag closes, up to the elements in the second place.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
ENDS_P = frozenset(("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
                    "nav ol p pre section table ul").split())
_WORD = re.compile(r"[A-Za-z]+")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")


#: A tag up to its >, once over; a > inside a quoted value ends nothing, a quote that is never closed is text of the value.
_TAG = re.compile(r"""<[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+>""")


def _tag_end(source: str, at: int) -> int:
    """Place of the > that ends the tag opened at ``at``, quoted values heeded however long; -1 if none does."""
    tag = _TAG.match(source, at)
    return tag.end() - 1 if tag else -1


def events(source: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("start", tag, attributes) and ("end", tag, "") in order; comments and declarations are left out."""
    at, n = 0, len(source)
    raw = ""
    while at < n:
        if raw:
            close = _find_end(source, raw, at)
            yield "text", source[at:close], ""
            at, raw = close, ""
            continue
        lt = source.find("<", at)
        if lt < 0:
            yield "text", source[at:], ""
            return
        if lt > at:
            yield "text", source[at:lt], ""
        following = source[lt + 1:lt + 2]
        if following == "!" or following == "?":
            mark = "-->" if source.startswith("<!--", lt) else ">"
            close = source.find(mark, lt + 2)
            at = n if close < 0 else close + len(mark)
        elif following == "/" or following.isalpha():
            end = _tag_end(source, lt)
            if end < 0:
                return  # a tag the page was cut in
            inside = source[lt + 1:end]
            if following == "/":
                yield "end", inside[1:].strip().lower(), ""
            else:
                parts = inside.split(None, 1)
                tag = parts[0].split("/")[0].lower()
                yield "start", tag, parts[1] if len(parts) > 1 else ""
                raw = tag if tag in RAW and not inside.endswith("/") else ""
            at = end + 1
        else:
            yield "text", "<", ""
            at = lt + 1


def _find_end(source: str, tag: str, at: int) -> int:
    close = source.find("</", at)
    while close >= 0 and source[close + 2:close + 2 + len(tag)].lower() != tag:
        close = source.find("</", close + 2)
    return len(source) if close < 0 else close


class _Mark:
    """A marked element. ``holds``: the article or main part of the page is in it, so the word tells of the layout."""

    __slots__ = ("word", "holds")

    def __init__(self, word: str):
        self.word, self.holds = word, False


class _Open:
    """An element that is open; path None for an inline one. last, count: label and number of its last run of children."""

    __slots__ = ("tag", "path", "depth", "aside", "main", "marks", "last", "count")

    def __init__(self, tag: str, path: str | None, depth: int, aside: bool, main: bool, marks: tuple[_Mark, ...] = ()):
        self.tag, self.path, self.depth, self.aside, self.main, self.marks, self.last, self.count = tag, path, depth, aside, main, marks, "", -1


def _deep_path(top: _Open, label: str) -> str:
    """Path of a child of ``top``: the first PATH_DEPTH steps, then "places:labels:label", both hashed along the way."""
    above, places, labels = top.path, "", ""
    if top.depth > PATH_DEPTH:
        above, step = top.path.rsplit("/", 1)
        places, labels, _ = step.split(":", 2)
    return f"{above}/{_hash(f'{places}/{top.count}')}:{_hash(f'{labels}/{label}')}:{label}"


def blocks(source: str | None) -> list[tuple[str, bool, str, str]]:
    """(path, in the main part, text, marked word or nothing) of every block that is not aside by its tags, in page
    order; white space is one space.

    The word of an element that holds most of the page's text tells of the layout and marks nothing. So does that of
    one that holds an article or main part, unless the page has another article outside of such elements: then they
    may as well hold comments or teasers.
    """
    if not source:
        return []
    out: list[tuple[str, bool, str, tuple[_Mark, ...]]] = []
    stack = [_Open("", "", 0, False, False)]
    gathered: list[tuple[str, tuple[_Mark, ...]]] = []

    def flush() -> None:
        if gathered:
            text = " ".join(html.unescape("".join(t for t, _ in gathered)).split())
            # A marked inline element is part of the sentence around it; alone in its block, it marks the block.
            inner = {m for t, m in gathered if t.strip()}
            gathered.clear()
            if text:
                marks = inner.pop() if len(inner) == 1 else block.marks
                path = block.path if len(marks) == len(block.marks) else f"{block.path}/0:{marks[-1].word}!"
                out.append((path, block.main, text, () if block.tag == "h1" else marks))

    block = stack[0]
    for kind, what, rest in events(source):
        top = stack[-1]
        if kind == "text":
            if not top.aside:
                gathered.append((what, top.marks))
        elif kind == "start":
            if what in INLINE and what not in ASIDE_TAGS:
                if what == "br":
                    gathered.append((" ", top.marks))
                elif what not in VOID:
                    word = _mark_word(_names(rest), top.main) if rest else ""
                    stack.append(_Open(what, None, top.depth, top.aside, top.main, (*top.marks, _Mark(word)) if word else top.marks))
                continue
            flush()
            if what in ENDS_P:
                _close(stack, {"p"}, {"table", "button", "article", "section", "div", "li", "td"})
            elif what in CLOSES:
                _close(stack, *CLOSES[what])
            block = top = _block_of(stack)
            if what in VOID:
                continue
            words = _names(rest) if rest else ()
            heart = what in ("article", "main") or "role=main" in words
            main = top.main or heart
            aside = stack[-1].aside or what in ASIDE_TAGS or (what == "header" and not top.main)
            marks = stack[-1].marks
            if heart or what == "body":
                if not aside:
                    for mark in marks:
                        mark.holds = True
                word = ""
            else:
                word = _mark_word(words, main) if what not in NEVER_MARKED else ""
            if word:
                marks = (*marks, _Mark(word))
            label = ("flow" + "!" * bool(word)) if what in FLOW else ".".join([what, *sorted(w for w in set(words) if "=" not in w)])
            if label != top.last:
                top.last, top.count = label, top.count + 1
            path = f"{top.path}/{top.count}:{label}" if top.depth < PATH_DEPTH else _deep_path(top, label)
            stack.append(_Open(what, path, top.depth + 1, aside, main and not aside, marks))
            block = stack[-1]
        else:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == what), 0)
            if not depth:
                continue
            if stack[depth].path is not None:
                flush()
            elif any(s.path is not None for s in stack[depth:]):
                continue  # an inline end tag closes no block
            del stack[depth:]
            block = _block_of(stack)
    flush()
    elsewhere = any(main and not any(m.holds for m in marks) for _, main, _, marks in out)
    sizes = Counter()
    for _, _, text, marks in out:
        sizes.update(dict.fromkeys(marks, len(text)))
    most = sum(len(text) for _, _, text, _ in out) / 2
    told = [(path, main, text, next((m.word for m in marks if sizes[m] <= most and (elsewhere or not m.holds)), "")) for path, main, text, marks in out]
    # Articles that are all under marks, and small beside the other text, do not stand for the page.
    small = not elsewhere and _chars(b for b in told if b[1]) <= MARKED_SMALL * _chars(b for b in told if not b[1] and not b[3])
    return [(path, False, text, word) for path, _, text, word in told] if small else told


def _chars(found: Iterable[tuple[str, bool, str, str]]) -> int:
    return sum(len(text) for _, _, text, _ in found)


def _mark_word(words: list[str] | tuple, main: bool) -> str:
    return next((w for w in words if w in ASIDE_WORDS and not (main and w in HEADER_WORDS)), "")


def _block_of(stack: list[_Open]) -> _Open:
    return next(s for s in reversed(stack) if s.path is not None)


def _close(stack: list[_Open], tags: set[str], up_to: frozenset | set) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].path is not None and stack[k].tag in up_to:
            return


def _names(attributes: str) -> list[str]:
    """Words of class, id and role; the role main as role=main; hidden elements count as notices."""
    out = []
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            out += _WORD.findall(value)
            if name == "role" and value == "main":
                out.append("role=main")
        elif name == "hidden":
            out.append("notice")
    return out


# Alignment -----------------------------------------------------------------------------------------------------------

def tree_of(paths: list[str]) -> dict:
    """Nested {label with place: children} of a list of paths."""
    root: dict = {}
    for path in paths:
        node = root
        for step in path.split("/")[1:]:
            node = node.setdefault(step, {})
    return root


def match(a: dict, b: dict) -> tuple[int, list[tuple[str, str]]]:
    """Simple tree matching of two forests: the most pairs of nodes with equal labels, ancestors and order kept.
    Gives their number and the paths of ``a`` with those of ``b``."""
    left, right = list(a.items()), list(b.items())
    worth = [[(0, [])] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, (name_a, under_a) in enumerate(left):
        for j, (name_b, under_b) in enumerate(right):
            best = max(worth[i][j + 1], worth[i + 1][j], key=lambda w: w[0])
            if name_a.split(":", 1)[1] == name_b.split(":", 1)[1]:
                inner, pairs = match(under_a, under_b)
                if worth[i][j][0] + 1 + inner > best[0]:
                    here = [("/" + name_a, "/" + name_b)] + [(f"/{name_a}{x}", f"/{name_b}{y}") for x, y in pairs]
                    best = (worth[i][j][0] + 1 + inner, worth[i][j][1] + here)
            worth[i + 1][j + 1] = best
    return worth[-1][-1]


# Spark ---------------------------------------------------------------------------------------------------------------

_PARSED = ("struct<skeleton: bigint, whole: bigint, page: bigint, slots: array<struct<path: string, hash: bigint, chars: int, mark: string>>, "
           "blocks: array<struct<slot: int, text: string>>>")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def read_page(source: str | None) -> dict:
    """Slots (path, hash and length of all text there, marked word) and blocks of a page; the main part alone, if there
    is one with text.

    Headings and running text of an unmarked main part are content whatever other pages say: their hash is NULL.
    """
    found = blocks(source)
    main = any(b[1] for b in found)
    if main:
        found = [b for b in found if b[1]]
    texts: dict[tuple[str, str], list[str]] = {}
    for path, _, text, mark in found:
        texts.setdefault((path, mark), []).append(text)
    place = {slot: k for k, slot in enumerate(texts)}
    return {"skeleton": _hash("\n".join(path for path, _ in texts)), "whole": _hash("\n".join(b[2] for b in found)), "page": _longest(texts),
            "slots": [{"path": p, "hash": None if main and not mark and p.endswith((":h1", ":flow")) else _hash("\n".join(t)),
                       "chars": sum(map(len, t)), "mark": mark or None} for (p, mark), t in texts.items()],
            "blocks": [{"slot": place[p, mark], "text": t} for p, _, t, mark in found]}


def kept_slots(slots: list[dict], template: frozenset | set = frozenset(), common: frozenset | set = frozenset()) -> list[int]:
    """Slots that are content: not in ``template``, and not marked by a word whose text is small beside the unmarked
    text that is left, not counting slots in ``common``. A page of which nothing is left keeps what it has without
    the template."""
    left = [k for k in range(len(slots)) if k not in template]
    sizes = Counter()
    for k in left:
        if slots[k]["mark"] is not None or k not in common:
            sizes[slots[k]["mark"]] += slots[k]["chars"]
    out = [k for k in left if slots[k]["mark"] is None or sizes[slots[k]["mark"]] > MARKED_SMALL * sizes[None]]
    return out if out or not template else kept_slots(slots)


def _longest(texts: dict[tuple[str, str], list[str]]) -> int:
    """Hash of the text of the longest slot, unmarked if there is one: pages that share it are copies of one another."""
    of = max(texts, key=lambda slot: (not slot[1], sum(map(len, texts[slot])), _hash("\n".join(texts[slot]))), default=None)
    return _hash("\n".join(texts[of])) if of else 0


def parse(source: str | None) -> dict:
    """``read_page``, with the blocks that are content as far as the page alone tells."""
    page = read_page(source)
    kept = set(kept_slots(page["slots"]))
    return page | {"blocks": [b for b in page["blocks"] if b["slot"] in kept]}


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row of ``pages``: its main text, blocks joined by line feeds.

    NULL, empty and textless pages give the empty text. Pages without a host in their url are one host. Pages whose
    longest slot holds the same text are copies, which count once in what is template. A page all of whose slots are template keeps its text. Other columns
    are not read. An empty table gives no rows. Pages are read whole, however long.
    """
    settle(pages.sparkSession)
    slot_kind = pa.list_(pa.struct([("path", pa.string()), ("hash", pa.int64()), ("chars", pa.int32()), ("mark", pa.string())]))
    kind = pa.struct([("skeleton", pa.int64()), ("whole", pa.int64()), ("page", pa.int64()), ("slots", slot_kind),
                      ("blocks", pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())])))])

    @F.arrow_udf(_PARSED)
    def parsed(sources: pa.Array) -> pa.Array:
        return pa.array([read_page(s) for s in sources.to_pylist()], kind)

    @F.arrow_udf("array<string>")
    def aligned(own: pa.Array, common: pa.Array) -> pa.Array:
        out = []
        for paths, reference in zip(own.to_pylist(), common.to_pylist()):
            to = dict(zip(paths, paths)) if paths == reference else dict(match(tree_of(paths), tree_of(reference))[1])
            out.append([to.get(p, "own " + p) for p in paths])
        return pa.array(out, pa.list_(pa.string()))

    @F.arrow_udf("array<int>")
    def kept(slots: pa.Array, template: pa.Array) -> pa.Array:
        out = []
        for own, told in zip(slots.to_pylist(), template.to_pylist()):
            texts = {(t["slot"], t["hash"]): t["sure"] for t in told or ()}
            sure = [texts.get((k, s["hash"])) for k, s in enumerate(own)]
            out.append(kept_slots(own, {k for k, x in enumerate(sure) if x}, {k for k, x in enumerate(sure) if x is False}))
        return pa.array(out, pa.list_(pa.int32()))

    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = cut_lineage(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), parsed(F.col(html_col)).alias("p"))
                       .select("id", "url", "host", "p.*"))
    paths = F.transform("slots", lambda s: s["path"])
    shapes = rows.where(F.size("slots") > 0).groupBy("host", "skeleton").agg(F.count("*").alias("pages"), F.first(paths).alias("paths"))
    common = shapes.groupBy("host").agg(F.max_by("paths", F.struct("pages", "skeleton")).alias("common"))
    homes = cut_lineage(shapes.join(common, "host").select("host", "skeleton", aligned(F.col("paths"), F.col("common")).alias("homes")))
    slots = homes.select("host", "skeleton", F.posexplode("homes").alias("slot", "home"))
    # One row for each page text of a host, slot of the host and text. Copies say nothing about the template; what is only
    # common when copies count (an article in many near copies, or boilerplate longer than all else) stays, but no marked
    # text is small beside it.
    seen = cut_lineage(rows.select("host", "skeleton", "whole", "page", F.posexplode("slots").alias("slot", "s"))
                       .select("host", "skeleton", "whole", "page", "slot", F.col("s.hash").alias("hash")).where("hash IS NOT NULL").distinct()
                       .join(slots, ["host", "skeleton", "slot"]).select("host", "home", "whole", "page", "hash").distinct())
    texts = seen.groupBy("host", "home", "hash").agg(F.count("*").alias("copies"), F.count_distinct("page").alias("n"))
    pages_with = (texts.groupBy("host", "home").agg(F.sum("copies").alias("all_copies"))
                  .join(seen.groupBy("host", "home").agg(F.count_distinct("page").alias("all")), ["host", "home"]))
    template = (texts.where(F.col("copies") >= TEMPLATE_PAGES).join(pages_with, ["host", "home"])
                .withColumn("sure", (F.col("n") >= TEMPLATE_PAGES) & (F.col("n") >= TEMPLATE_SHARE * F.col("all")))
                .where(F.col("sure") | (F.col("copies") >= TEMPLATE_SHARE * F.col("all_copies"))).select("host", "home", "hash", "sure"))
    drop = cut_lineage(slots.join(template, ["host", "home"]).groupBy("host", "skeleton").agg(F.collect_set(F.struct("slot", "hash", "sure")).alias("template")))
    size = drop.agg(F.sum(F.octet_length("host") + 16 + 12 * F.size("template"))).first()[0] or 0
    left = rows.join(F.broadcast(drop) if size <= BROADCAST_BYTES else drop, ["host", "skeleton"], "left")
    read = left.withColumn("kept", kept(F.transform("slots", lambda s: F.struct(s["hash"], s["chars"], s["mark"])), F.col("template")))
    text = F.array_join(F.transform(F.filter("blocks", lambda b: F.array_contains("kept", b["slot"])), lambda b: b["text"]), "\n")
    return read.select(F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text"), F.char_length(text).cast("bigint").alias("n_chars"))
