"""Main text of web pages by deducing each host's template from equivalence classes of tags and texts.

A token is a tag in its place (the chain of elements above it, with their classes) or a block of text in
its place. Over the distinct pages of a host, tokens that occur equally often on every page have the same
occurrence vector; a vector is compared by a hash that adds up over pages in any order, so no host is ever
gathered in one task. Pages are distinct by their running text: copies of an article are no evidence.
Texts in one place that have the same vector are a class. A class on nearly all pages that have the element
around it is template text (so each layout of a host has its own), if the element holds nothing else or the
class has words enough to be no accident. What is left varies: the slot of the article is the smallest
element, once on a page, that holds it on each page. The slot's text is extracted but for template
text and page furniture. What only a name calls furniture is left out where it lies outside the slot.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import lookup_join, written
from .common import arrow_map

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
# Fixed values of the HTML standard: elements by how they are read.
_RAW = frozenset("script style noscript template textarea iframe svg math title".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var".split()
)
# Elements that are no article text, and words of classes, ids and roles that may name such parts.
_FURNITURE = frozenset("nav header footer aside form button select option dialog menu head".split())
_FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements banner sponsored promo cookie cookies consent notice notices"
    " alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs header footer masthead"
    " comment comments disqus share sharing social related recommended newsletter subscribe signup login search"
    " contentinfo complementary toolbar pagination pager".split()
)
_CONTENT_TAGS = ("article", "main")
_NEVER_NAMED = frozenset(("html", "body", *_CONTENT_TAGS))
_CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section"
    " table ul li".split()
)


@dataclass
class Element:
    tag: str
    role: int
    furniture: bool
    parent: Element | None
    named: bool = False  # a name says that it is furniture, or what is around it
    chars: int = 0  # text outside furniture below it
    children: list = field(default_factory=list)  # elements, texts and None for a line break


def _named_furniture(attributes: str) -> bool:
    for found in _ATTRIBUTE.finditer(attributes):
        words = re.split(r"[^a-z]+", (found[2] or found[3] or found[4] or "").lower())
        if _FURNITURE_WORDS.intersection(words):
            return True
    return False


def _label(tag: str, attributes: str) -> str:
    found = [m for m in _ATTRIBUTE.finditer(attributes) if m[1].lower() == "class"] if attributes else []
    return f"{tag}.{' '.join((found[0][2] or found[0][3] or found[0][4] or '').split())}" if found else tag


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _role(parent: int, label: str) -> int:
    return _signed(xxhash.xxh64_intdigest(parent.to_bytes(8, "little", signed=True) + label.encode(errors="replace")))


def parse(text: str) -> tuple[Element, list[Element]]:
    """The page's tree of structural elements, and all of them in order. Inline tags only part no words."""
    root = Element("", 0, False, None)
    everything: list[Element] = []
    current, at = root, 0

    def add_text(piece: str) -> None:
        if piece:
            current.children.append(piece)

    end = len(text)
    while at < end:
        found = _TOKEN.search(text, at)
        if found is None:
            add_text(text[at:])
            break
        add_text(text[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag in _INLINE or tag in _VOID:
                if tag == "br":
                    current.children.append(None)
                continue
            above: Element | None = current
            while above is not None and above.tag != tag:
                above = above.parent
            if above is not None:
                current = above.parent or root
            continue
        if tag in _RAW and not found[3].endswith("/"):
            closing = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(text, at)
            at = closing.end() if closing else end
            continue
        if tag in _VOID or tag in _INLINE:
            if tag in ("br", "hr"):
                current.children.append(None)
            continue
        if tag in _CLOSES_P and current.tag == "p":
            current = current.parent or root
        elif tag == "li" and current.tag == "li":
            current = current.parent or root
        furniture = current.furniture or tag in _FURNITURE
        named = tag not in _NEVER_NAMED and _named_furniture(found[3])
        element = Element(tag, _role(current.role, _label(tag, found[3])), furniture, current, named)
        current.children.append(element)
        everything.append(element)
        current = element
    for element in reversed(everything):
        if not element.furniture:
            element.chars += sum(len(c.strip()) for c in element.children if isinstance(c, str))
            if element.parent is not None:
                element.parent.chars += element.chars
    root.chars += sum(len(c.strip()) for c in root.children if isinstance(c, str))
    for element in everything:
        # A name says nothing against an element that holds most of the page's text.
        element.named = (element.named and 2 * element.chars < root.chars) or element.parent.named
    return root, everything


def runs(element: Element) -> Iterator[tuple[Element, str]]:
    """Blocks outside furniture in page order with the element they stand in: references decoded, white space single."""
    pending: list[str] = []

    def closed() -> str:
        words = html.unescape("".join(pending)).split()
        pending.clear()
        return " ".join(words)

    stack: list[tuple[Element, Iterator]] = [(element, iter(element.children))]
    while stack:
        above, children = stack[-1]
        child = next(children, _DONE)
        if child is None:
            pending.append(" ")
        elif isinstance(child, str):
            pending.append(child)
        else:
            if pending and (text := closed()):
                yield above, text
            if child is _DONE:
                stack.pop()
            elif not child.furniture:
                stack.append((child, iter(child.children)))


_DONE = object()


_TOKENS = "host string, role long, parent long, page long, count int, words int"
_TOKEN_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
# Tokens that a task holds before it passes them on.
_HELD_TOKENS = 100_000


def _batch(rows: list, types: list, schema: str) -> pa.RecordBatch:
    columns = [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])


def _text_role(element: Element, text: str) -> int:
    return _role(element.role, f"\n{text}")


def tokens(pages: DataFrame) -> DataFrame:
    """Per host and token: distinct pages that have it, the hash of its occurrence vector, and counts.

    ``words`` is 0 for tags. Each token of a page travels once, so copies of a page count once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, int], tuple[int, int, int]] = {}

        def flushed() -> pa.RecordBatch:
            rows = [(host, role, parent, page, n, w) for (host, role, page), (parent, n, w) in held.items()]
            held.clear()
            return _batch(rows, _TOKEN_TYPES, _TOKENS)

        for batch in batches:
            for host, text in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                root, everything = parse(text or "")
                seen: dict[int, tuple[int, int, int]] = {0: (0, 1, 0)}
                for e in everything:
                    seen[e.role] = (e.parent.role, seen.get(e.role, (0, 0))[1] + 1, 0)
                running = xxhash.xxh64()
                for e, block in runs(root):
                    role = _text_role(e, block)
                    seen[role] = (e.role, seen.get(role, (0, 0))[1] + 1, len(block.split()))
                    if not e.named:
                        running.update(f"{block}\n".encode(errors="replace"))
                page = _signed(running.intdigest())
                for role, (parent, n, words) in seen.items():
                    known = held.get((host, role, page))
                    held[host, role, page] = (parent, max(n, known[1]) if known else n, words)
                if len(held) > _HELD_TOKENS:
                    yield flushed()
        if held:
            yield flushed()

    found = arrow_map(pages.select("_host", "html"), run, _TOKENS)
    by_page = found.groupBy("host", "role", "page").agg(
        F.max("count").alias("count"), F.max("parent").alias("parent"), F.max("words").alias("words")
    )
    # Two sums of 32-bit marks: they cannot overflow.
    mark = F.xxhash64("page", "count")
    return by_page.groupBy("host", "role").agg(
        F.max("parent").alias("parent"),
        F.max("words").alias("words"),
        F.count("*").alias("pages"),
        F.sum(F.shiftrightunsigned(mark, 32)).alias("vector"),
        F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))).alias("vector2"),
        F.sum(F.col("count").cast("long")).alias("total"),
    )


# A template shows on so many distinct pages, and its texts on this share of the pages that have their element.
MIN_PAGES = 3
MIN_SHARE = 0.9
# Words of a class that stands among varying texts of the same element; fewer recur by accident.
MIN_CLASS_WORDS = 3


def template_texts(found: DataFrame) -> DataFrame:
    """Per host the text tokens of its template."""
    here = ["host", "parent"]
    elements = found.filter("words = 0").select("host", F.col("role").alias("parent"), F.col("pages").alias("parent_pages"))
    texts = found.filter("words > 0")
    all_texts = texts.groupBy(*here).agg(F.sum("total").alias("all_texts"))
    common = texts.filter(F.col("pages") >= MIN_PAGES).join(elements, here)
    common = common.filter(F.col("pages") >= F.col("parent_pages") * MIN_SHARE)
    classes = common.groupBy(*here, "vector", "vector2").agg(F.sum("words").alias("class_words"))
    constant = common.groupBy(*here).agg(F.sum("total").alias("constant")).join(all_texts, here)
    chosen = common.join(classes, [*here, "vector", "vector2"]).join(constant, here)
    chosen = chosen.filter((F.col("class_words") >= MIN_CLASS_WORDS) | (F.col("constant") >= F.col("all_texts") * MIN_SHARE))
    return chosen.groupBy(F.col("host").alias("_host")).agg(F.collect_list("role").alias("_texts"))


_COVERS = "host string, role long, pages long, misses long"
_COVER_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64()]


def varying(root: Element, everything: list[Element], texts: frozenset[int]) -> tuple[int, dict[int, int]]:
    """Characters of the page's varying text, and those below each element (by ``id``).

    Elements that are furniture by name are left out, so that the slot may lie beside them; but only if
    the page has an article or main element, or they hold less than half of the text.
    """
    counts: dict[bool, dict[int, int]] = {False: {}, True: {}}
    for e, block in runs(root):
        if _text_role(e, block) not in texts:
            at = counts[e.named]
            at[id(e)] = at.get(id(e), 0) + len(block)
    plain, named = counts[False], counts[True]
    below = _added_up(plain, everything)
    if not any(e.tag in _CONTENT_TAGS and not e.furniture for e in everything) and sum(named.values()) >= sum(plain.values()):
        below = _added_up({k: plain.get(k, 0) + named.get(k, 0) for k in {*plain, *named}}, everything)
    return below.get(id(root), 0), below


def _added_up(own: dict[int, int], everything: list[Element]) -> dict[int, int]:
    below = dict(own)
    for e in reversed(everything):
        if n := below.get(id(e)):
            below[id(e.parent)] = below.get(id(e.parent), 0) + n
    return below


def slots(pages: DataFrame) -> DataFrame:
    """Per host the elements that stand once on a page and hold its varying text on each page that has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[int]] = {}

        def flushed() -> pa.RecordBatch:
            rows = [(*key, *value) for key, value in held.items()]
            held.clear()
            return _batch(rows, _COVER_TYPES, _COVERS)

        for batch in batches:
            for host, text, texts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                root, everything = parse(text or "")
                whole, below = varying(root, everything, frozenset(texts or ()))
                if not whole:
                    continue
                seen: dict[int, bool] = {}
                for e in everything:
                    seen[e.role] = e.role not in seen and below.get(id(e)) == whole
                for role, holds in seen.items():
                    row = held.setdefault((host, role), [0, 0])
                    row[0] += 1
                    row[1] += not holds
                if len(held) > _HELD_TOKENS:
                    yield flushed()
        if held:
            yield flushed()

    found = arrow_map(pages.select("_host", "html", "_texts"), run, _COVERS)
    summed = found.groupBy("host", "role").agg(F.sum("pages").alias("pages"), F.sum("misses").alias("misses"))
    chosen = summed.filter((F.col("pages") >= MIN_PAGES) & (F.col("misses") == 0))
    return chosen.groupBy(F.col("host").alias("_host")).agg(F.collect_list("role").alias("_slots"))


def main_text(text: str, slot_roles: Iterable[int] | None = None, template: Iterable[int] | None = None) -> str:
    """Text of the slot; without it, of the outermost article or main elements that hold most of the page's
    varying text, else of the smallest element that holds all of it."""
    root, everything = parse(text)
    roles, texts = frozenset(slot_roles or ()), frozenset(template or ())
    whole, below = varying(root, everything, texts)
    # All of these hold the page's varying text, as does an article that other pages break, so the last one is the smallest.
    holds = {id(e) for e in everything if e.tag in _CONTENT_TAGS and whole and below.get(id(e)) == whole}
    inside = [e for e in everything if (e.role in roles or id(e) in holds) and not e.furniture][-1:]
    if not inside:
        for tag in _CONTENT_TAGS:
            inside = [e for e in everything if e.tag == tag and not e.furniture and not _below(e, tag)]
            if 2 * sum(below.get(id(e), 0) for e in inside) > whole:
                break
            inside = []
        if not inside and whole:
            inside = [e for e in everything if below.get(id(e)) == whole][-1:]
    return "\n".join(block for e in inside or [root] for at, block in runs(e) if _text_role(at, block) not in texts)


def _below(element: Element, tag: str) -> bool:
    above = element.parent
    while above is not None:
        if above.tag == tag:
            return True
        above = above.parent
    return False


_EXTRACTED = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (``page_id``, ``url``, ``html``) its main text (empty if none) and its code points.

    Null pages are empty; pages without a host share one template. Repeated rows stay rows. The templates
    are one row per host; they are broadcast if they were measured small, else joined by host, where
    adaptive execution splits a host with very many pages.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#@]*)", 1))
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").withColumn("_host", host)
    texts = written(template_texts(written(tokens(plain), "tokens")), "template-texts")
    marked = lookup_join(plain, texts, ["_host"], "left")
    joined = lookup_join(marked, written(slots(marked), "slots"), ["_host"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(t or "", s, m) for t, s, m in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return arrow_map(joined.select("page_id", "url", "html", "_slots", "_texts"), run, _EXTRACTED)
