"""Pages as trees of blocks: tolerant reading of HTML, and what an element's name and attributes say of its role."""

from __future__ import annotations

import html
import re
from functools import lru_cache

#: Fixed by the HTML standard: elements without content, elements that are part of a line, elements whose
#: content is no markup, and elements that end when one of a kind begins.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt rtc ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("iframe noembed noframes noscript script style svg template textarea title xmp".split())
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tfoot", "tr", "td", "th"},
}
PASSED = frozenset("address div p li dt dd tr td th tbody thead tfoot option".split())
CELLS = frozenset("table td th caption".split())
#: Elements that are only a frame around all others.
FRAME = frozenset(("html", "body", "head"))

#: Roles of elements. HARD ones never hold the main text; SOFT ones do only if an article is inside;
#: HEAD ones belong to the main text where they are inside it. 1 to 3 are main regions, the surest first.
HARD, SOFT, HEAD, PLAIN = "-", "~", "h", " "
HARD_TAGS = frozenset("nav footer aside menu select button option optgroup datalist object canvas audio video map".split())
SOFT_TAGS = frozenset("form fieldset dialog".split())
MENU = "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager skiplink"
FOOT = "footer foot copyright colophon"
SIDE = "sidebar aside widget widgets related recommended recommendations promo promos teaser teasers"
NOTICE = "cookie cookies consent notice notices gdpr newsletter subscribe subscription popup modal overlay alert paywall toast"
ADVERT = "ad ads advert adverts advertisement advertisements advertising sponsor sponsored adsense banner"
FORM = "form login signin signup search searchbox"
OTHER = "share sharing social disqus respond replies hidden"
SOFT_WORDS = frozenset(" ".join((MENU, FOOT, SIDE, NOTICE, ADVERT, FORM, OTHER)).split())
ASIDE_WORDS = frozenset(" ".join((SIDE, ADVERT)).split())  # an article with these is a teaser
HEAD_WORDS = frozenset("header masthead topbar".split())
MAIN_WORDS = frozenset("article articlebody content post entry story main".split())
SOFT_ROLES = frozenset("navigation contentinfo complementary search form alert alertdialog dialog menu menubar".split())
NEGATED = frozenset("has with without no not is show".split())

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
TELLING = re.compile(r"class|id|role|itemprop|hidden|style", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
DIGITS = re.compile(r"\d+")
#: Deeper elements count as children of the element at this depth, unless they are boilerplate.
DEPTH = 64


@lru_cache(maxsize=8192)
def label(tag: str, attributes: str) -> str:
    """An element's name in a wrapper: its role, tag and class tokens, digits left out of account."""
    given: dict[str, str] = {}
    if TELLING.search(attributes):
        for name, *values in ATTRIBUTE.findall(attributes):
            given.setdefault(name.lower(), "".join(values))
    tokens = f"{given.get('id', '')} {given.get('class', '')} {given.get('itemprop', '')}".split()
    key = " ".join(DIGITS.sub("#", t) for t in tokens)
    return f"{_role(tag, given, tokens)}{tag} {key}" if key else _role(tag, given, tokens) + tag


def _role(tag: str, given: dict[str, str], tokens: list[str]) -> str:
    parts = [[p.lower() for p in PART.findall(t)] for t in tokens]
    parts = [p for p in parts if p and p[0] not in NEGATED and p[-1] != "free"]
    words = {w for p in parts for w in p}
    role = given.get("role", "").strip().lower()
    comment = any(p[0] in ("comment", "comments") and p[-1] not in ("open", "closed") for p in parts)
    style = given.get("style", "").replace(" ", "").lower()
    if tag in HARD_TAGS or comment or "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style:
        return HARD
    if tag == "article" or role == "article" or "articlebody" in {t.lower() for t in tokens}:
        return SOFT if words & ASIDE_WORDS else "1"
    if tag == "main" or role == "main":
        return "2"
    if tag in SOFT_TAGS or role in SOFT_ROLES or words & SOFT_WORDS:
        return SOFT
    if tag == "header" or role == "banner" or words & HEAD_WORDS:
        return HEAD
    return "3" if words & MAIN_WORDS and tag not in INLINE else PLAIN


class Node:
    """An element: its label, its tag, and its children (elements, or blocks of text as (text, characters in links))."""

    __slots__ = ("label", "tag", "children", "inner")

    def __init__(self, name: str, tag: str):
        self.label, self.tag, self.children, self.inner = name, tag, [], 0


class Reader:
    """Reads one page. Elements that end implicitly are closed, stray end tags are ignored."""

    def __init__(self):
        self.root = Node(PLAIN, "")
        self.stack: list[tuple[str, Node]] = [("", self.root)]
        self.open: dict[str, int] = {}
        self.line: list[str] = []
        self.linked = self.link = 0

    def text(self, raw: str) -> None:
        self.line.append(html.unescape(raw) if "&" in raw else raw)
        if self.link:
            self.linked += len(raw)

    def flush(self) -> None:
        if self.line:
            block = " ".join("".join(self.line).split())
            if block:
                self.stack[-1][1].children.append((block, min(self.linked, len(block))))
            self.line.clear()
            self.linked = 0

    def push(self, tag: str, name: str) -> None:
        self.flush()
        parent = self.stack[-1][1]
        node = parent
        if len(self.stack) <= DEPTH or (name[0] in (HARD, SOFT) and parent.label[0] not in (HARD, SOFT)):
            node = Node(name, tag)
            parent.children.append(node)
        self.stack.append((tag, node))
        self.open[tag] = self.open.get(tag, 0) + 1

    def pop_to(self, at: int) -> None:
        self.flush()
        self.link = 0
        for tag, _ in self.stack[at:]:
            self.open[tag] -= 1
        del self.stack[at:]

    def start(self, tag: str, attributes: str) -> None:
        if tag in INLINE:
            if tag == "br":
                self.line.append(" ")
            elif tag == "a":
                self.link = 1
            if tag in VOID:
                return
            name = label(tag, attributes) if TELLING.search(attributes) else PLAIN
            if name[0] in (HARD, SOFT):
                self.push(tag, name)
            elif self.stack[-1][0] == tag:
                self.stack[-1][1].inner += 1
            return
        if self.stack[-1][0] == "p":
            self.pop_to(len(self.stack) - 1)
        ended = ENDS.get(tag)
        if ended and any(self.open.get(t) for t in ended):
            last = 0
            for at in range(len(self.stack) - 1, 0, -1):
                name = self.stack[at][0]
                if name in ended:
                    last = at
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
                elif name not in PASSED and name not in INLINE:
                    break
            if last:
                self.pop_to(last)
        if tag in FRAME or tag in VOID:
            self.flush()
        else:
            self.push(tag, label(tag, attributes))

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link = 0
        if tag in INLINE:
            top, node = self.stack[-1]
            if top == tag and node.inner:
                node.inner -= 1
            elif top == tag:
                self.pop_to(len(self.stack) - 1)
        elif self.open.get(tag):
            for at in range(len(self.stack) - 1, 0, -1):
                name = self.stack[at][0]
                if name == tag:
                    self.pop_to(at)
                    break
                if name in CELLS and tag not in CELLS and tag not in ("tr", "tbody", "thead", "tfoot"):
                    break
        else:
            self.flush()

    def read(self, page: str) -> Node:
        at, missing = 0, set()
        while (begin := page.find("<", at)) >= 0:
            if begin > at:
                self.text(page[at:begin])
            if found := TAG.match(page, begin):
                tag, at = found[2].lower(), found.end()
                if found[1]:
                    self.end(tag)
                elif tag in RAW and not (tag == "svg" and found[3].endswith("/")):
                    at = self.skip(page, at, tag, missing)
                else:
                    self.start(tag, found[3])
            elif page.startswith("<!--", begin):
                close = page.find("-->", begin + 2)
                at = close + 3 if close >= 0 else len(page)
            elif page[begin + 1 : begin + 2] in ("!", "?", "/"):
                close = page.find(">", begin)
                at = close + 1 if close >= 0 else len(page)
            elif page[begin + 1 : begin + 2].isalpha():
                at = len(page)  # a tag that never ends
            else:
                self.text("<")
                at = begin + 1
        if at < len(page):
            self.text(page[at:])
        self.flush()
        return self.root

    def skip(self, page: str, at: int, tag: str, missing: set[str]) -> int:
        """Past the element's end; without one, past the page for code, past the tag for others."""
        found = None if tag in missing else _end_of(tag).search(page, at)
        if found:
            return found.end()
        missing.add(tag)
        return len(page) if tag in ("script", "style") else at


@lru_cache(maxsize=32)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I)


def read(page: str) -> Node:
    return Reader().read(page)
