"""A small tolerant HTML reader: element tree, blocks of text, subtree hashes.

Fixed values below are names from the HTML standard and common class names.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
from dataclasses import dataclass, field

# fixed values: element names
RAW_TEXT = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr", "img", "br", "button", "select", "option", "input", "svg", "canvas", "object", "audio",
    "video", "map", "area", "math", "embed", "link", "meta", "param", "source", "track",
} | RAW_TEXT  # neither ends a paragraph nor a block
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "blockquote", "pre", "td", "th", "tr"}
LANDMARKS = {"nav", "header", "footer", "aside", "form"}
NEVER_TEXT = RAW_TEXT | {
    "head", "nav", "footer", "aside", "form", "button", "select", "option", "input", "svg", "canvas", "object", "dialog",
    "menu", "audio", "video", "map", "math",
}
BARRIERS = {
    "html", "body", "article", "main", "section", "nav", "header", "footer", "aside", "form", "div", "table", "tr", "td",
    "th", "ul", "ol", "dl", "blockquote", "figure",
}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
# fixed values: words of class, id and role that mark what is not the article
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
    "banner", "cookie", "cookies", "consent", "notice", "notices", "notification", "alert", "newsletter", "subscribe",
    "subscription", "signup", "login", "popup", "modal", "dialog", "overlay", "sidebar", "nav", "navbar", "navigation",
    "menu", "breadcrumb", "breadcrumbs", "toolbar", "pagination", "pager", "share", "sharing", "social", "related",
    "recommended", "recommendations", "widget", "masthead", "header", "footer", "contentinfo", "complementary", "search",
    "form", "comment", "comments", "reply", "replies", "respond", "disqus", "discussion", "skip", "hidden",
}
# of these, the words that mark a name wherever they stand in it; the others only as its last word
ANYWHERE = {
    "sidebar", "nav", "navbar", "navigation", "footer", "masthead", "breadcrumb", "breadcrumbs", "cookie", "cookies", "advert", "adverts",
    "advertisement", "advertising", "sponsored", "newsletter", "pagination", "contentinfo", "comment", "comments", "disqus",
}
# words at the end of a name that say nothing of what it holds
GENERIC = {
    "area", "bar", "block", "body", "box", "button", "buttons", "container", "content", "group", "heading", "icon", "icons", "inner", "item", "items",
    "link", "links", "list", "outer", "panel", "post", "posts", "section", "text", "title", "wrap", "wrapper",
}
COMMENT_MARKS = {"comment", "comments", "reply", "replies"}
PARAGRAPHS = {"p", "pre", "blockquote"}

TOKEN = re.compile(
    r"<(?:!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*)(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'/=>][^\s/=>]*)(?:\s*=\s*(\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
SPACE = re.compile(r"\s+")


@functools.lru_cache(maxsize=1 << 14)
def marks_of(name: str) -> frozenset[str]:
    """What one class, id or role marks: ``cookie-notice`` and ``related-posts`` do, ``social-science`` does not."""
    words = [w.lower() for w in WORDS.findall(name)]
    while len(words) > 1 and words[-1] in GENERIC:
        words.pop()
    return frozenset(w for w in words if w in ANYWHERE) | (frozenset(words[-1:]) & MARKS)


@dataclass(eq=False, slots=True)
class Element:
    tag: str
    attributes: str
    parent: Element | None
    content: list = field(default_factory=list)  # strings and elements, in order

    protected: bool = False  # holds the article, whatever its class says
    known: tuple[bool, bool, set[str]] | None = None

    def marking(self) -> tuple[bool, bool, set[str]]:
        """Whether the element is hidden, whether its role is main, and the marks of its class, id and role."""
        if self.known is None:
            pairs: dict[str, str] = {}
            for name, value in ATTRIBUTE.findall(self.attributes):
                pairs.setdefault(name.lower(), value.strip("\"'"))  # the first of a name counts
            names = [x for name in ("class", "id", "role") for x in pairs.get(name, "").split()]
            self.known = ("hidden" in pairs or pairs.get("aria-hidden", "").strip().lower() == "true",
                          "main" in pairs.get("role", "").lower().split(), {w for x in names for w in marks_of(x)})
        return self.known

    def is_main(self) -> bool:
        return self.tag == "main" or bool(self.attributes) and self.marking()[1]

    def unread(self) -> bool:
        """Whether the element is never read, wherever it stands and whatever it holds."""
        return self.tag in NEVER_TEXT or bool(self.attributes) and self.tag not in ("html", "body", "main") and self.marking()[0]

    def dropped(self, in_article: bool) -> bool:
        """Whether the element and all it holds are not part of an article."""
        if self.unread():
            return True
        if self.tag == "header":
            return not in_article
        if not self.attributes or self.protected or self.tag in ("html", "body") or self.is_main():
            return False
        marks = self.marking()[2]
        if self.tag == "article":
            return bool(marks & COMMENT_MARKS)
        return bool(marks) and not (len(self.tag) == 2 and self.tag[0] == "h")


def parse(page: str) -> Element:
    """The element tree of a page. Never fails: stray ends are ignored, open elements end with
    their parents, an unfinished tag or comment at the end is dropped."""
    root = Element("html", "", None)
    open_ = [root]
    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            open_[-1].content.append(page[at:])
            break
        if m.start() > at:
            open_[-1].content.append(page[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            if m["data"]:
                open_[-1].content.append(html.escape(m["data"]))  # text as it is; references are decoded later
            continue
        tag = name.lower()
        if m["end"]:
            close(open_, tag)
            continue
        if tag in ("html", "body"):
            continue
        make_room(open_, tag)
        element = Element(tag, m["attributes"], open_[-1])
        open_[-1].content.append(element)
        if tag in RAW_TEXT:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            if tag == "title":
                element.content.append(page[at:end.start() if end else n])
            at = end.end() if end else n
        elif tag not in VOID and not m["attributes"].endswith("/"):
            open_.append(element)
        elif tag not in VOID and tag not in ("svg", "path"):
            open_.append(element)  # a slash does not close an ordinary element
    return root


def protect(tree: Element) -> None:
    """Marks the elements that are not dropped for their class: those that hold main, the longest article
    or most of the page's paragraph text (all text outside links, if it has no paragraphs).

    What is marked as comments is kept only if it holds main or all of that text.
    """
    order, places = [tree], [(False, False)]  # whether inside a paragraph, inside a link
    paragraphs: list[int] = []
    prose: list[int] = []
    for k, e in enumerate(order):
        here = places[k][0] or e.tag in PARAGRAPHS, places[k][1] or e.tag == "a"
        n = 0
        for x in e.content:
            if isinstance(x, str):
                n += len(x.strip())
            elif not x.unread():
                order.append(x)
                places.append(here)
        paragraphs.append(n if here[0] else 0)
        prose.append(0 if here[1] else n)
    held = dict(zip(order, paragraphs if any(paragraphs) else prose))
    for e in reversed(order[1:]):
        held[e.parent] += held[e]
    total = held[tree]
    longest = max((held[e] for e in order if e.tag == "article"), default=-1)
    mains: set[Element] = set()
    articles: set[Element] = set()
    for e in reversed(order[1:]):
        if e in mains or e.is_main():
            mains |= {e, e.parent}
        if e in articles or e.tag == "article" and held[e] == longest:
            articles |= {e, e.parent}
        if e.attributes:
            if e.marking()[2] & COMMENT_MARKS and e.tag != "article":
                e.protected = e in mains or 0 < total == held[e]
            else:
                e.protected = e in mains or e in articles or 2 * held[e] > total


def close(open_: list[Element], tag: str) -> None:
    """An end tag closes the nearest open element of its name; small ones not beyond their container."""
    if tag in ("html", "body"):
        return
    for k in range(len(open_) - 1, 0, -1):
        if open_[k].tag == tag:
            del open_[k:]
            return
        if tag not in BARRIERS and open_[k].tag in BARRIERS:
            return


def make_room(open_: list[Element], tag: str) -> None:
    """Ends that a start tag implies."""
    if tag in ("article", "main"):  # an article never stands in a menu, header, footer or form: those lack their end
        for k in range(1, len(open_)):
            if open_[k].tag in LANDMARKS:
                del open_[k:]
                break
    if open_[-1].tag == "head" and tag not in RAW_TEXT and tag not in VOID:
        open_.pop()
    if tag not in INLINE:
        for k in range(len(open_) - 1, 0, -1):
            if open_[k].tag == "p":
                del open_[k:]
                break
            if open_[k].tag in BARRIERS:
                break
    for k in range(len(open_) - 1, 0, -1):
        if open_[k].tag in CLOSES.get(tag, ()):
            del open_[k:]
            break
        if open_[k].tag in BARRIERS and open_[k].tag not in CLOSES.get(tag, ()):
            break


def roots(tree: Element) -> tuple[list[Element], bool]:
    """Where the article is: the outermost ``article`` elements if they hold most of the text that is
    not dropped (outside links), else the ``main`` ones, else the page."""
    articles: list[Element] = []
    mains: list[Element] = []
    total = inside = 0
    todo = [(tree, False, False, False)]  # whether in an article, in main, in a link
    while todo:
        e, in_article, in_main, in_link = todo.pop()
        if e is not tree and e.dropped(in_article):
            continue
        if e.tag == "article" and not in_article:
            articles.append(e)
            in_article = True
        if e.is_main() and not in_main:
            mains.append(e)
            in_main = True
        in_link = in_link or e.tag == "a"
        n = 0 if in_link else sum(len(x.strip()) for x in e.content if isinstance(x, str))
        total += n
        inside += n * in_article
        todo += [(x, in_article, in_main, in_link) for x in reversed(e.content) if isinstance(x, Element)]
    if articles and 2 * inside >= total:
        return articles, True
    return (mains, True) if mains else ([tree], False)


def blocks(tree: Element, templates: frozenset[int] = frozenset(), hashes: dict[Element, int] | None = None,
           entered: list[Element] | None = None) -> list[str]:
    """Blocks of the article in page order, without dropped elements and template subtrees.

    ``entered`` collects the elements that were read.
    """
    found: list[str] = []
    run: list[str] = []

    def end_block():
        if run:
            text = SPACE.sub(" ", "".join(run)).strip()
            if text:
                found.append(text)
            run.clear()

    protect(tree)
    starts, in_article = roots(tree)
    for start in starts:
        end_block()
        # entries: element with the next position in its content, and whether only headings count
        stack = [(start, iter(start.content), False)]
        while stack:
            element, rest, headings_only = stack[-1]
            for x in rest:
                if isinstance(x, str):
                    if not headings_only:
                        run.append(html.unescape(x))
                    continue
                if x.tag == "br":
                    run.append(" ")
                    continue
                if x.dropped(in_article) or templates and hashes.get(x) in templates:
                    if x.tag not in INLINE:
                        end_block()
                    continue
                if x.tag not in INLINE:
                    end_block()
                if entered is not None:
                    entered.append(x)
                only = (headings_only or x.tag == "header") and not (len(x.tag) == 2 and x.tag[0] == "h")
                stack.append((x, iter(x.content), only))
                break
            else:
                stack.pop()
                if element.tag not in INLINE:
                    end_block()
        end_block()
    return found


def subtree_hashes(tree: Element) -> dict[Element, int]:
    """64-bit hash of every container element that holds text: its tag, classes, text and child elements.

    Prose elements get none of their own: a paragraph that recurs is repeated text, not a
    template, and finding repeated text is the work of deduplication.
    """
    found: dict[Element, int] = {}
    order = [tree]
    for e in order:
        order += [x for x in e.content if isinstance(x, Element)]
    digest: dict[Element, bytes] = {}
    for e in reversed(order):
        h = hashlib.blake2b(f"{e.tag}\0{SPACE.sub(' ', e.attributes).strip()}\0".encode("utf-8", "replace"), digest_size=8)
        some = False
        for x in e.content:
            if isinstance(x, str):
                text = SPACE.sub(" ", x).strip()
                if text:
                    some = True
                    h.update(b"t" + text.encode("utf-8", "replace") + b"\0")
            elif x in digest:
                some = True
                h.update(b"e" + digest[x])
        if some:
            digest[e] = h.digest()
            if e is not tree and e.tag not in INLINE and e.tag not in PROSE and e.tag not in RAW_TEXT and e.tag != "head":
                found[e] = int.from_bytes(digest[e], "big", signed=True)
    return found
