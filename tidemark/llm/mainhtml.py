"""Main text of web pages by tree scoring."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame

from tidemark.llm.shared import map_rows

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
GAP = re.compile(r"[\s/]*")
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(\s*=\s*)?")
BARE = re.compile(r"[^\s>]*")

# Fixed values of HTML: elements without content, with raw text, that make blocks, and that a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDERS = frozenset("ul ol dl table tbody thead tfoot div article section body".split())

#: Elements that are never part of an article, and those that are not unless they hold the page's text.
OUTSIDE = frozenset("nav footer script style noscript template textarea title iframe svg math button select menu head".split())
MARKED = frozenset("header aside form dialog".split())

#: Words of a class, id or role that mark what is not part of an article.
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert alertdialog banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies dialog discussion disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pagination "
    "paywall popup promo related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)

#: Words beside one of those that speak of a page's state, as in has-sidebar or comments-open.
STATES = frozenset("has no not with without is are open closed on off enabled disabled active visible layout".split())

#: A marked element that holds over this many characters outside of links is the article after all if the rest holds less than this
#: share of them; one that is marked by a part of a word only, if it holds more than this share of the page.
MARKED_CHARS, REST_SHARE, WEAK_SHARE = 140, 0.25, 0.25

#: Points that a container begins with.
FIRST_POINTS = {"article": 10.0, "main": 10.0, "section": 4.0, "div": 4.0, "td": 2.0, "blockquote": 2.0, "pre": 2.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "table": -3.0}

#: Elements that can be the article's container; list and table parts pass points on to these.
CONTAINERS = frozenset("html article main section div center".split())

#: A sibling is kept from this share of the best container's points, or as a paragraph of low link density from this length.
SIBLING_SHARE, SIBLING_CHARS, SIBLING_LINKS = 0.2, 80, 0.25

#: A parent whose text is at most so much longer takes the container's place: it adds a heading, say.
PARENT_SHARE = 1.25


#: Elements nested deeper than this are taken as part of the one around them, as browsers do; closing a tag looks no further up.
MOST_DEPTH = 512


class Node:
    __slots__ = ("tag", "parent", "parts", "outside", "mark", "depth", "points", "chars", "link_chars")

    def __init__(self, tag: str, parent: Node | None, outside: bool, mark: int = 0):
        self.tag, self.parent, self.outside, self.mark = tag, parent, outside, mark
        self.depth = parent.depth + 1 if parent else 0
        self.parts: list[Node | str] = []
        self.points = FIRST_POINTS.get(tag, 0.0)
        self.chars = self.link_chars = 0


def mark_of(tag: str, attributes: dict[str, str]) -> int:
    """How an element is marked as no part of an article: 2 by itself or a whole word of its class, id or role, 1 by a part of one, 0 not."""
    if tag in MARKED:
        return 2
    if not attributes or tag in ("html", "body", "article", "main"):
        return 0
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true" or re.search(r"(^|;)\s*display\s*:\s*none", attributes.get("style", ""), re.I):
        return 2
    mark = 0
    for name in ("class", "id", "role"):
        for word in attributes.get(name, "").split():
            if word.lower() in OUTSIDE_WORDS:
                return 2
            parts = re.findall(r"[A-Z]?[a-z]+|[A-Z]+", word)
            ends = {parts[0].lower(), parts[-1].lower()} if parts else set()
            if len(parts) > 1 and not OUTSIDE_WORDS.isdisjoint(ends) and STATES.isdisjoint(ends):
                mark = 1
    return mark


class Scanner:
    """Reads tags in one pass: each character is looked at a bounded number of times, whatever quotes or brackets are missing."""

    def __init__(self, html: str):
        self.html = html
        self.missing: set[str] = set()

    def find(self, what: str, at: int) -> int:
        """Where ``what`` comes next, or -1; once it is missing, it is not looked for again."""
        if what in self.missing:
            return -1
        found = self.html.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def raw_end(self, tag: str, at: int) -> tuple[int, int]:
        """Where the end tag of an element with raw text begins and ends; -1 if there is none."""
        found = None if tag in self.missing else re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(self.html, at)
        if found is None:
            self.missing.add(tag)
            return -1, -1
        return found.span()

    def attributes(self, at: int) -> tuple[dict[str, str], int]:
        """Attributes by name, the first of each, and the place behind the tag; -1 where the page ends within it.

        A quoted value whose quote never ends goes to the tag's next bracket.
        """
        html, out = self.html, {}
        while True:
            at = GAP.match(html, at).end()
            if at >= len(html):
                return out, -1
            if html[at] == ">":
                return out, at + 1
            name = ATTRIBUTE.match(html, at)
            at, value = name.end(), ""
            if name[2]:
                quote = html[at : at + 1]
                end = self.find(quote, at + 1) if quote in ("'", '"') and quote else -1
                if end >= 0:
                    value, at = html[at + 1 : end], end + 1
                elif quote in ("'", '"') and quote:
                    end = self.find(">", at)
                    if end < 0:
                        return out, -1
                    value, at = html[at + 1 : end], end
                else:
                    bare = BARE.match(html, at)
                    value, at = bare[0], bare.end()
            out.setdefault(name[1].lower(), unescape(value))


def parse(html: str) -> Node:
    """A tree of elements and decoded texts. Tags need not be closed or nested properly, and the page may end anywhere."""
    scanner, root = Scanner(html), Node("html", None, False)
    here, at, text_from = root, 0, 0

    def said(until: int) -> None:
        if until > text_from:
            here.parts.append(unescape(html[text_from:until]))

    while (at := scanner.find("<", at)) >= 0:
        following = html[at + 1 : at + 2]
        name = NAME.match(html, at + 2 if following == "/" else at + 1)
        if name is None and following not in ("!", "?", "/"):
            if not following:
                said(at)
                return root
            at += 1
            continue
        said(at)
        if name is None:
            comment = html.startswith("<!--", at)
            end = scanner.find("-->" if comment else ">", at + 2)
            at = text_from = len(html) if end < 0 else end + (3 if comment else 1)
            continue
        tag = name[0].lower()
        if following == "/":
            end = scanner.find(">", name.end())
            at = text_from = len(html) if end < 0 else end + 1
            node = here
            while node is not root and node.tag != tag:
                if node.tag in HOLDERS and tag not in BLOCK:
                    node = root
                    break
                node = node.parent
            if node is not root:
                here = node.parent
            continue
        attributes, end = scanner.attributes(name.end())
        if end < 0:  # the end of the page cuts the tag off
            return root
        at = text_from = end
        if tag in ("html", "body"):
            if tag == "body" and here.tag in ("html", "head"):
                here = root
            continue
        if tag == "br":
            here.parts.append(" ")
            continue
        if tag in BLOCK:
            node = here
            while node is not root and node.tag not in HOLDERS:
                if node.tag == "p":
                    here = node.parent
                    break
                node = node.parent
        if tag in CLOSES_ITSELF:
            node = here
            while node is not root and node.tag not in HOLDERS - {"tbody", "thead", "tfoot"} - ({"div"} if tag in ("li", "td", "th", "tr") else set()):
                if node.tag in CLOSES_ITSELF[tag]:
                    here = node.parent
                node = node.parent
        node = Node(tag, here, here.outside or tag in OUTSIDE, mark_of(tag, attributes))
        here.parts.append(node)
        if tag in VOID or (tag in ("svg", "math") and html[end - 2] == "/"):
            continue
        if tag in RAW:
            end = scanner.raw_end(tag, at)[1]
            # Without an end tag, what is code to the end of the page is left out; other elements are taken as empty.
            if end >= 0 or tag in ("script", "style"):
                at = text_from = end if end >= 0 else len(html)
            continue
        if node.depth < MOST_DEPTH:
            here = node
        elif tag in BLOCK:
            here.parts.append(" ")
    said(len(html))
    return root


def _count(root: Node) -> None:
    """Characters of every element's text, white space as one space, and those in links."""
    for node, done in _walk(root):
        if done:
            inner = [part for part in node.parts if isinstance(part, Node) and not part.outside]
            node.chars = len(" ".join("".join(part for part in node.parts if isinstance(part, str)).split())) + sum(part.chars for part in inner)
            node.link_chars = node.chars if node.tag == "a" else sum(part.link_chars for part in inner)


def _marked(top: Node) -> list[Node]:
    """The outermost marked elements below ``top``."""
    found, stack = [], [part for part in top.parts if isinstance(part, Node)]
    while stack:
        node = stack.pop()
        if node.outside:
            continue
        if node.mark:
            found.append(node)
        else:
            stack.extend(part for part in node.parts if isinstance(part, Node))
    return found


def settle_marks(root: Node) -> None:
    """Leave marked elements out, but for those that hold the page's text: there the mark speaks of the page, not of the element."""
    _count(root)
    plain = lambda node: node.chars - node.link_chars
    marked = _marked(root)
    rest = plain(root) - sum(map(plain, marked))
    heap = [(-plain(node), k, node) for k, node in enumerate(marked)]
    heapq.heapify(heap)
    number = len(heap)
    while heap:
        size, _, node = heap[0]
        weak = node.mark == 1 and -size > WEAK_SHARE * plain(root)
        if not weak and (-size < MARKED_CHARS or rest >= REST_SHARE * -size):
            break
        heapq.heappop(heap)
        inner = _marked(node)
        rest += -size - sum(map(plain, inner))
        for part in inner:
            number += 1
            heapq.heappush(heap, (-plain(part), number, part))
    for _, _, node in heap:
        node.outside = True


def _walk(node: Node) -> Iterator[tuple[Node, bool]]:
    """Nodes inside the article's reach in page order, each before and (True) after what it holds; without recursion."""
    stack: list[tuple[Node, bool]] = [(node, False)]
    while stack:
        node, done = stack.pop()
        yield node, done
        if not done:
            stack.append((node, True))
            stack.extend((part, False) for part in reversed(node.parts) if isinstance(part, Node) and not part.outside)


def blocks(nodes: list[Node]) -> list[str]:
    """The texts of blocks in page order, white space as one space, trimmed, without empty ones."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                out.append(text)

    for top in nodes:
        flush()
        stack: list[Node | str | None] = [top]
        while stack:
            part = stack.pop()
            if part is None:
                flush()
            elif isinstance(part, str):
                held.append(part)
            elif not part.outside:
                if part.tag in BLOCK:
                    flush()
                    stack.append(None)
                stack.extend(reversed(part.parts))
        flush()
    return out


def line_of(node: Node) -> str:
    """The element's own text with that of its inline parts; a block within it is a space."""
    held: list[str] = []
    stack: list[Node | str] = list(reversed(node.parts))
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            held.append(part)
        elif part.tag in BLOCK:
            held.append(" ")
        elif not part.outside:
            stack.extend(reversed(part.parts))
    return " ".join("".join(held).split())


def _score(root: Node) -> list[Node]:
    """Give points to the ancestors of paragraphs and return those that got any, in page order."""
    scored: dict[int, Node] = {}
    for node, done in _walk(root):
        if not done:
            continue
        own = [part for part in node.parts if isinstance(part, str)]
        inner = [part for part in node.parts if isinstance(part, Node) and not part.outside]
        text = " ".join("".join(own).split())
        node.chars = len(text) + sum(part.chars for part in inner)
        node.link_chars = node.chars if node.tag == "a" else sum(part.link_chars for part in inner)
        paragraph = node.tag in ("p", "pre", "td", "blockquote", "li") or (node.tag in CONTAINERS and text)
        if not paragraph:
            continue
        said = line_of(node)
        if not said:
            continue
        points = 1.0 + said.count(",") + min(len(said) / 100, 10.0)
        if node.tag == "li":
            points *= 0.25
        density = node.link_chars / node.chars if node.chars else 0.0
        points *= 1.0 - density
        holder = node if node.tag in CONTAINERS and text else node.parent
        for share in (1.0, 0.5, 0.25):
            while holder is not None and holder.tag not in CONTAINERS:
                holder = holder.parent
            if holder is None:
                break
            holder.points += points * share
            scored.setdefault(id(holder), holder)
            holder = holder.parent
    return list(scored.values())


def main_text(html: str | None) -> str:
    """The text of a page's article; empty where the page has none or is null.

    Paragraphs pass points for length and commas to their parent, half to its parent and a quarter beyond, discounted by the
    share of their text in links; the container of most points, again discounted, is kept with the siblings that look like it.
    Elements that a class, id or role marks as no part of an article are left out, but for those that hold the page's text.
    A page without paragraphs yields what it holds outside of menus and the like. The scan is linear in the page's length.
    """
    if not html:
        return ""
    root = parse(html)
    settle_marks(root)
    candidates = _score(root)
    if not candidates:
        return " ".join(blocks([root]))
    worth = {id(node): node.points * (1.0 - (node.link_chars / node.chars if node.chars else 0.0)) for node in candidates}
    best = max(candidates, key=lambda node: worth[id(node)])
    while best.parent is not None and best.chars and best.parent.chars <= PARENT_SHARE * best.chars:
        best = best.parent
    top = worth.get(id(best), 0.0) or max(worth.values())
    kept = []
    for part in best.parent.parts if best.parent is not None else [best]:
        if not isinstance(part, Node) or part.outside:
            continue
        links = part.link_chars / part.chars if part.chars else 0.0
        if part is best or worth.get(id(part), 0.0) >= SIBLING_SHARE * top or (part.tag == "p" and part.chars >= SIBLING_CHARS and links <= SIBLING_LINKS):
            kept.append(part)
    return " ".join(blocks(kept))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; one row each, whatever the html holds (null html: empty text)."""

    def extract(htmls: list[str | None]) -> list[tuple]:
        return [(text, len(text)) for text in map(main_text, htmls)]

    return map_rows(pages, ["page_id", "url"], ["html"], {"text": "string", "n_chars": "long"}, extract)
