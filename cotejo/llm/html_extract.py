"""Main text of pages by wrappers that are inferred for each host.

A wrapper is a regular expression without union over page tokens: tags, text that is the same on
all pages, text slots, optional groups and repeated groups. It starts as one page of a host and
is aligned with one page after the other; a text that differs becomes a slot, a tag that differs
is resolved into a repeated group if the tokens before it repeat, else into an optional group.
The wrapper strikes what it fixes, wherever it stands, and records that repeat with a short name
first, as readers' comments do; tags tell the article from menus, notices and the like.
"""

from __future__ import annotations

import bisect
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import record_batch

# Pages of a host that one wrapper is made from, about; larger hosts are split by hash.
GROUP = 64
# Places to which hosts of any size are first split.
SALTS = 1 << 20
# Hosts that are split: those with more than this share of all pages, so there are fewer than
# LARGE of them, and with more than a few groups.
LARGE = 1 << 16
# Different articles that a wrapper has to be from before its fixed texts are struck, and the
# share of an article that they may be.
TOLD, STRUCK = 4, 0.3
# Words of a name at the head of a reader's comment, at most.
NAME_WORDS = 5
# An article beside the longest one counts from this share of its text on; others are teasers.
BESIDE = 0.25

# Element names of HTML.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "math", "object", "textarea", "select", "title", "canvas", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
NOT_MAIN = frozenset("nav aside footer form head button label dialog menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements whose start ends an open paragraph or a like element.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Words in class, id or role by which pages mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "sidebar aside footer masthead banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social comment comments commentlist respond disqus replies related recommended recommendations pagination pager widget toolbar skip hidden "
    "contentinfo complementary search".split()
)
# Last words of names for boxes, which say nothing of what is inside.
BOXES = frozenset(
    "area bar block body box btn button buttons container content count form group icons inner item items link links list module panel post posts "
    "row section slot thread tools unit wrap wrapper".split()
)
ARTICLE_MARKS = frozenset("articlebody".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$)|<(?![A-Za-z/!]))*)(?:>|(?=<)|$)", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
_PARTS = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(frozen=True, slots=True)
class Token:
    """A tag by ``key`` (``<name marks``, ``</name``) or, with key ``#``, a text."""

    key: str
    name: str = ""
    words: frozenset = frozenset()
    text: str = ""


def tokens(page: str) -> list[Token]:
    """Tags and texts of a page; comments, scripts and styles are left out."""
    out: list[Token] = []
    at, size = 0, len(page)

    def text(piece: str) -> None:
        if piece:
            if out and out[-1].key == "#":
                piece = out.pop().text + piece
            out.append(Token("#", text=piece))

    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                text(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        name = m[2].lower()
        if m[1]:
            out.append(Token(f"</{name}", name))
            continue
        words, hides = _marks(m[3]) if m[3].strip(" /") else (frozenset(), False)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else (size if name in ("script", "style") else at)
            continue
        if hides:
            words |= {"hidden"}
        out.append(Token(f"<{name} {' '.join(sorted(words))}", name, words))
    return out


def _marks(attributes: str) -> tuple[frozenset, bool]:
    """Words of class, id, role and itemprop that are known marks; whether the element is hidden."""
    words: set[str] = set()
    hides = False
    for m in _ATTRIBUTE.finditer(attributes):
        if m.start() and not attributes[m.start() - 1].isspace():
            continue
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _HIDES.search(value)):
            hides = True
        elif name in ("class", "id", "role"):
            for one in value.split():
                parts = [p.lower() for p in _PARTS.split(one) if p]
                words.update(p for p in parts if name == "role" and p in ("main", "article"))
                # A name says what its last word says, or what stands before the word for a box:
                # reader-comments and comment-list, not social-history.
                while len(parts) > 1 and parts[-1] in BOXES:
                    parts.pop()
                words.update(p for p in parts[-1:] if p in MARKS)
        elif name == "itemprop" and value.lower() in ARTICLE_MARKS:
            words.add("articlebody")
    return frozenset(words), hides


# Wrapper items: ("tag", key), ("text", text or None for a slot), ("opt", items), ("plus", items).
@dataclass
class Item:
    kind: str
    key: str = ""
    text: str | None = None
    items: list[Item] = field(default_factory=list)


def as_items(page: list[Token]) -> list[Item]:
    return [Item("text", text=_plain(t.text)) if t.key == "#" else Item("tag", t.key) for t in page]


def _plain(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def consume(items: list[Item], page: list[Token], at: int, fixed: list[Item | None] | None = None, times_of: list[int] | None = None) -> int:
    """Where ``items`` end on the page from ``at`` on, -1 if they don't fit. Greedy.

    ``fixed``, if given, gets the wrapper's item at the places of texts that are fixed in it. In
    ``times_of`` each time of an outermost repeated group gets a number of its own, the place
    where it begins plus one.
    """
    for item in items:
        if item.kind == "tag":
            if at >= len(page) or page[at].key != item.key:
                return -1
            at += 1
        elif item.kind == "text":
            if at < len(page) and page[at].key == "#":
                if fixed is not None and item.text is not None and item.text == _plain(page[at].text):
                    fixed[at] = item
                at += 1
        else:
            times = 0
            inner = None if item.kind == "plus" else times_of
            while (end := consume(item.items, page, at, fixed, inner)) > at:
                if times_of is not None and item.kind == "plus":
                    times_of[at:end] = [at + 1] * (end - at)
                at, times = end, times + 1
                if item.kind == "opt":
                    break
            if item.kind == "plus" and not times:
                return -1
    return at


def _square(done: list[Item], rest: list[str]) -> int:
    """Length of a group at the start of ``rest`` (keys) that repeats the end of ``done``, or 0.

    The group ends with the tag that stands just before the mismatch.
    """
    if not done or done[-1].kind != "tag" or not done[-1].key.startswith("</"):
        return 0
    last = done[-1].key
    try:
        size = rest.index(last) + 1
    except ValueError:
        return 0
    back = [i.key if i.kind == "tag" else "#" if i.kind == "text" else "?" for i in done[-size:]]
    return size if back == rest[:size] else 0


# Keys that a mismatch looks ahead for a repeated group.
AHEAD = 64


def align(wrapper: list[Item], page: list[Token]) -> list[Item]:
    """The wrapper made general enough for one more page."""
    out: list[Item] = []
    places: dict[str, list[int]] = {}
    for j, t in enumerate(page):
        places.setdefault(t.key, []).append(j)
    own: dict[str, list[int]] = {}
    for i, w in enumerate(wrapper):
        own.setdefault(w.key if w.kind == "tag" else w.kind, []).append(i)

    def ahead(table: dict[str, list[int]], key: str, start: int) -> int:
        found = table.get(key, [])
        k = bisect.bisect_left(found, start)
        return found[k] if k < len(found) else -1

    i = j = 0
    while i < len(wrapper) and j < len(page):
        w, t = wrapper[i], page[j]
        if w.kind == "tag" and w.key == t.key:
            out.append(w)
            i, j = i + 1, j + 1
        elif w.kind == "text" and t.key == "#":
            out.append(w if w.text is None or w.text == _plain(t.text) else Item("text"))
            i, j = i + 1, j + 1
        elif w.kind in ("opt", "plus"):
            start = j
            while (end := consume(w.items, page, j)) > j:
                j = end
                if w.kind == "opt":
                    break
            if j == start:
                w = Item("opt", items=w.items if w.kind == "opt" else [w])
            else:
                # Texts of the group that differ here become slots.
                _loosen(w.items, page, start)
            out.append(w)
            i += 1
        elif w.kind == "text":
            out.append(Item("opt", items=[w]))
            i += 1
        elif t.key == "#":
            out.append(Item("opt", items=[Item("text", text=_plain(t.text))]))
            j += 1
        else:
            i, j = _resolve(wrapper, page, i, j, out, own, places, ahead)
    if i < len(wrapper):
        rest = wrapper[i:]
        out.extend(w if w.kind == "opt" else Item("opt", items=[w]) for w in rest)
    if j < len(page):
        out.append(Item("opt", items=as_items(page[j:])))
    return out


def _resolve(wrapper, page, i, j, out, own, places, ahead) -> tuple[int, int]:
    """A tag that differs: a repeated group on either side, else an optional group."""
    on_page = [t.key for t in page[j : j + AHEAD]]
    on_wrapper = [w.key if w.kind == "tag" else "#" if w.kind == "text" else "?" for w in wrapper[i : i + AHEAD]]
    size = _square(out, on_page)
    if size:
        group = Item("plus", items=_slots(out[-size:]))
        del out[-size:]
        while (end := consume(group.items, page, j)) > j:
            j = end
        _absorb(out, group)
        out.append(group)
        return i, j
    size = _square(out, on_wrapper)
    if size:
        group = Item("plus", items=_slots(out[-size:]))
        del out[-size:]
        while [w.key if w.kind == "tag" else "#" if w.kind == "text" else "?" for w in wrapper[i : i + size]] == on_wrapper[:size]:
            i += size
        _absorb(out, group)
        out.append(group)
        return i, j
    skip_page, skip_wrapper = ahead(places, wrapper[i].key, j), ahead(own, page[j].key, i)
    if skip_page >= 0 and (skip_wrapper < 0 or skip_page - j <= skip_wrapper - i):
        out.append(Item("opt", items=as_items(page[j:skip_page])))
        return i, skip_page
    if skip_wrapper >= 0:
        out.append(Item("opt", items=wrapper[i:skip_wrapper]))
        return skip_wrapper, j
    out.append(Item("opt", items=[wrapper[i]]))
    out.append(Item("opt", items=as_items(page[j : j + 1])))
    return i + 1, j + 1


def _slots(items: list[Item]) -> list[Item]:
    """A repeated group's texts vary from one time to the next."""
    return [Item("text") if w.kind == "text" else w for w in items]


def _absorb(out: list[Item], group: Item) -> None:
    """Earlier copies of the group just before it are further times of it, but not those with a
    text that has been the same on all pages so far."""
    size = len(group.items)
    shape = [(w.kind, w.key, w.text) for w in group.items]
    while len(out) >= size and [(w.kind, w.key, w.text) for w in out[-size:]] == shape:
        del out[-size:]


def _loosen(items: list[Item], page: list[Token], at: int) -> None:
    fixed: list[Item | None] = [None] * len(page)
    end = consume(items, page, at, fixed)
    for w in items:
        if w.kind == "text" and w.text is not None and not any(fixed[at:end]):
            w.text = None


def shared_items(wrapper: list[Item], pages: list[list[Token]]) -> set[int]:
    """Ids of the items whose fixed text stands on half the pages and on two at least. Texts of
    optional groups may come from one page alone, and are then no text of the host's."""
    seen: Counter[int] = Counter()
    for page in pages:
        seen.update({id(item) for item in read_by(wrapper, page)[0] if item is not None})
    return {item for item, n in seen.items() if n >= max(2, len(pages) / 2)}


def infer(pages: Iterator[list[Token]]) -> list[Item]:
    """Wrapper of pages of one host, one after the other; only the wrapper is held."""
    wrapper: list[Item] | None = None
    for page in pages:
        wrapper = as_items(page) if wrapper is None else align(wrapper, page)
    return wrapper or []


def read_by(wrapper: list[Item], page: list[Token]) -> tuple[list[Item | None], list[int]]:
    """For each token of the page the wrapper's item if that fixes its text, and the number of the
    time of a repeated group that it stands in, or 0."""
    fixed: list[Item | None] = [None] * len(page)
    times = [0] * len(page)
    at = 0
    for item in wrapper:
        end = consume([item], page, at, fixed, times)
        at = max(at, end)
    return fixed, times


@dataclass
class Block:
    """Text between block tags: its article on the page (0: none), whether the wrapper fixes all
    of it, characters in links and in all, the time of a repeated group, and whether a heading."""

    text: str
    article: int
    fixed: bool
    linked: int
    size: int
    time: int
    heading: bool


def blocks_of(page: list[Token], fixed: list[bool] | None = None, times: list[int] | None = None) -> list[Block]:
    """Blocks of a page without menus, headers, footers, sidebars, notices, adverts, forms and
    marked comments. A header inside an article keeps its headings."""
    blocks: list[Block] = []
    stack: list[tuple[str, bool, int, bool]] = []  # name, leaves out, article, header
    parts: list[str] = []
    state = {"fixed": True, "linked": 0, "all": 0, "article": 0, "time": 0, "heading": False}
    articles = 0

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                blocks.append(Block(text, state["article"], state["fixed"], state["linked"], state["all"], state["time"], state["heading"]))
            parts.clear()
        state.update(fixed=True, linked=0, all=0)

    for place, t in enumerate(page):
        if t.key == "#":
            out = any(s[1] for s in stack)
            header = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][3]), -1)
            if header >= 0 and not any(s[0] in HEADINGS for s in stack[header:]):
                out = True
            if not out:
                parts.append(t.text)
                if t.text.strip():
                    state["fixed"] &= bool(fixed and fixed[place])
                    state["all"] += len(t.text)
                    state["linked"] += len(t.text) * any(s[0] == "a" for s in stack)
                    state["article"] = next((s[2] for s in stack if s[2]), 0)
                    state["time"] = times[place] if times else 0
                    state["heading"] = any(s[0] in HEADINGS for s in stack)
            continue
        if t.name in BLOCK:
            flush()
        if t.name == "br":
            parts.append(" ")
        if t.key.startswith("</"):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == t.name:
                    del stack[k:]
                    break
                if stack[k][0] in ("article", "main", "body", "table", "td", "th") and t.name not in BLOCK:
                    break
        elif t.name not in VOID:
            for name in ("p",) if t.name in BLOCK else ():
                if stack and any(s[0] == name for s in stack[-4:]):
                    k = max(k for k in range(len(stack)) if stack[k][0] == name)
                    if not any(s[0] in ("article", "div", "td", "th", "li", "section", "blockquote", "button") for s in stack[k + 1 :]):
                        # Inline elements left open in a paragraph end with it.
                        del stack[k:]
            for name in CLOSES.get(t.name, ()):
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in (name, "ul", "ol", "dl", "table")), -1)
                if k >= 0 and stack[k][0] == name:
                    del stack[k:]
            article = 0
            if _is_article(t):
                articles += 1
                article = articles
            stack.append((t.name, t.name in NOT_MAIN or (bool(t.words & MARKS) and t.name not in ("html", "body")), article, t.name == "header"))
    flush()
    return blocks


def region_of(blocks: list[Block]) -> list[Block]:
    """The blocks of the page's article: those in its outermost <article>, <main> or like element,
    without teasers beside it; all blocks that are not mostly links where there is none."""
    sizes: dict[int, int] = {}
    for b in blocks:
        if b.article:
            sizes[b.article] = sizes.get(b.article, 0) + len(b.text)
    if not sizes:
        return [b for b in blocks if 2 * b.linked <= b.size]
    longest = max(sizes.values())
    return [b for b in blocks if b.article and sizes[b.article] >= BESIDE * longest]


def _comments(blocks: list[Block]) -> set[int]:
    """Times of repeated groups at the end of an article that are records with a short name first
    and no heading, and have several blocks."""
    found: set[int] = set()
    end = len(blocks)
    while end and blocks[end - 1].time:
        time, start = blocks[end - 1].time, end - 1
        while start and blocks[start - 1].time == time:
            start -= 1
        record = blocks[start:end]
        if len(record) < 2 or any(b.heading for b in record) or len(record[0].text.split()) > NAME_WORDS:
            break
        found.add(time)
        end = start
    return found if end else set()


def main_text(page: list[Token], wrapper: list[Item] | None = None, shared: set[int] = frozenset(), told: int = 0) -> tuple[str, int]:
    """Blocks of the article, joined by line breaks, and the number of the host's texts on the page.

    Of the article's blocks go those that the wrapper fixes on ``shared`` items, if it is from
    ``TOLD`` different articles at least and no more than ``STRUCK`` of the article is so (more is
    an article that the host has several times), and comments, which it knows as a repeated
    group. Of a page without a marked article all such blocks go.
    """
    if not wrapper:
        return "\n".join(b.text for b in region_of(blocks_of(page))), 0
    items, times = read_by(wrapper, page)
    fixed = [item is not None and id(item) in shared for item in items]
    blocks = blocks_of(page, fixed, times)
    region = region_of(blocks)
    inside = any(b.article for b in region)
    size, same = sum(len(b.text) for b in region), sum(len(b.text) for b in region if b.fixed)
    strikes = not inside or (told >= TOLD and same <= STRUCK * size)
    comments = _comments([b for b in region if not (strikes and b.fixed)])
    kept: list[str] = []
    follows = False
    for b in reversed(region):
        # A heading that all articles have stays with the text that it heads.
        gone = strikes and b.fixed and not (inside and b.heading and follows)
        follows = not gone and b.time not in comments
        if follows:
            kept.append(b.text)
    return "\n".join(reversed(kept)), sum(fixed)


def telling(pages: list[list[Token]]) -> list[list[Token]]:
    """Pages with different articles: copies, and pages of which half the blocks stood on earlier
    ones, say nothing about what is the host's."""
    seen: set[str] = set()
    chosen = []
    for page in pages:
        texts = {b.text for b in region_of(blocks_of(page))}
        if page and (not texts or 2 * len(texts & seen) < len(texts)):
            chosen.append(page)
            seen |= texts
    return chosen


def _is_article(t: Token) -> bool:
    return t.key.startswith("<") and not t.key.startswith("</") and (t.name in ("article", "main") or bool(t.words & {"main", "article", "articlebody"})) and not t.words & MARKS


EXTRACTED = "page_id long, url string, text string, n_chars long, n_fixed long, n_group long"


def extract(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html).

    Returns page_id, url, text, n_chars, n_fixed (texts fixed in the host's wrapper), n_group
    (different articles the wrapper is from). A null or empty html has an empty text. A null url is
    a host of its own; repeated rows are returned each; other columns are not read; an empty table
    gives no rows.

    Pages are dealt by a hash of (host, part) in one shuffle, sorted within tasks and read as a
    stream; a wrapper is made from up to ``group`` pages that follow each other, so a task holds
    no more of a host of any size. A host with more than one in ``LARGE`` of all pages has as many
    parts as groups; fewer than ``LARGE`` hosts can have that many, and their table, which is
    broadcast, is bounded by this.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"), F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).alias("salt")
    )
    sizes = pages.select(host.alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("c"))
    every = pages.agg(F.count(F.lit(1))).scalar()
    parts = F.least(F.lit(SALTS), F.pow(F.lit(2), F.ceil(F.log2(F.col("c") / group)))).cast("long")
    large = sizes.filter((F.col("c") > 2 * group) & (F.col("c") * LARGE > every)).select("host", parts.alias("parts"))
    part = F.coalesce(F.expr("salt % parts"), F.lit(0).cast("long"))
    keyed = rows.join(F.broadcast(large), "host", "left").withColumn("part", part)
    keyed = keyed.withColumn("key", F.xxhash64("host", "part"))

    def read(found: list[tuple]) -> pa.RecordBatch:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_fixed", pa.int64()), ("n_group", pa.int64())])
        read_pages = [tokens(html or "") for *_, html in found]
        told = telling(read_pages)
        wrapper = infer(iter(told)) if len(told) > 1 else []
        shared = shared_items(wrapper, told)
        rows = []
        for (number, url, _), page in zip(found, read_pages):
            text, same = main_text(page, wrapper, shared, len(told))
            rows.append((number, url, text, len(text), same, len(told)))
        return record_batch(schema, zip(*rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                name, number, page_id, url, html = (c[i].as_py() for c in columns)
                if held and ((name, number) != last or len(held) >= group):
                    yield read(held)
                    held = []
                last = (name, number)
                held.append((page_id, url, html))
        if held:
            yield read(held)

    return (
        keyed.repartition("key")
        .sortWithinPartitions("host", "part", "salt", "page_id")
        .select("host", "part", "page_id", "url", "html")
        .mapInArrow(run, EXTRACTED)
    )
