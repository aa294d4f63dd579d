"""A page as a tree of blocks, in flat lists, and what is measured on its nodes."""

from __future__ import annotations

import functools
import html
import re

import numpy as np

# Elements of HTML.
BLOCKS = set("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset
h1 h2 h3 h4 h5 h6 header hgroup hr label legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul""".split())
RAW = set("script style textarea template noscript iframe noembed noframes svg annotation object title head".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: An element that ends others of its kind, up to the ones that hold them.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
KINDS = [set(x.split()) for x in (
    "article main", "nav menu", "header hgroup", "footer address", "aside", "form fieldset search", "div center section", "p", "h1", "h2 h3 h4 h5 h6",
    "ul ol dl dir", "li dt dd", "table tbody thead tfoot tr", "td th caption", "blockquote pre", "button label legend select option optgroup",
    "figure figcaption", "body", "#text", "details summary dialog")]
#: Parts of class, id and role that tell what an element is for.
HINTS = [re.compile(x) for x in (
    r"article|content|main|post(?!er)|entry|story|body|text|prose", r"nav|menu|breadcrumb|pagination|pager|tabs?\b|toc", r"head|masthead|logo|brand|topbar|top-bar|hero|title",
    r"foot|copyright|legal|colophon|bottom", r"side|aside|widget|related|recommend|rail|more|trending|popular|teaser", r"\bads?\b|\bad[-_]|[-_]ads?\b|advert|sponsor|promo|banner|dfp|commercial",
    r"comment|repl(y|ies)|respon|discuss|disqus|feedback|review", r"cookie|consent|notice|alert|warning|gdpr|privacy|modal|popup|overlay|toast|announce|message",
    r"share|social|follow|like|tweet", r"form|search|login|signup|sign-up|subscribe|newsletter|register|input", r"meta|byline|author|date|tag|categor|caption|credit")]

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)/?>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?/][^>]*>", re.S)
#: What can stand in a head, up to its end; pages may leave out the tags that end it, and then it ends before anything else.
_HEAD = re.compile(r"(?:\s++|<!--.*?(?:-->|\Z)|<![^>]*+>|<(title|script|style|noscript|template|noframes|object)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
                   r"|<(?:base|basefont|bgsound|link|meta|head|html)\b[^>]*+>|</(?!head\b|body\b)[^>]*+>)*+(?:</head\s*>)?", re.S | re.I)
_ATTR = re.compile(r"\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_KIND = {tag: i for i, tags in enumerate(KINDS) for tag in tags}
_STOPS = re.compile(r"[.!?…]")


@functools.lru_cache(100_000)
def _hints(attributes: str) -> int:
    said = " ".join("".join(m) for m in _ATTR.findall(attributes)).lower()
    return sum(1 << i for i, h in enumerate(HINTS) if h.search(said)) if said else 0


class Pages:
    """Nodes of many pages, each page's in page order, parents before children; text nodes hold a block each."""

    def __init__(self):
        self.page, self.parent, self.kind, self.hints, self.texts = [], [], [], [], []
        self.chars, self.words, self.links, self.stops, self.tags, self.controls = [], [], [], [], [], []
        self.marks: list[str] = []  # of training pages
        self.count = 0

    def _node(self, parent: int, tag: str, attributes: str = "", text: str = "", words: int = 0, links: int = 0, mark: str = "") -> int:
        self.page.append(self.count)
        self.parent.append(parent)
        self.kind.append(_KIND.get(tag, 6))
        self.hints.append(_hints(attributes) if attributes else 0)
        self.texts.append(text)
        self.chars.append(len(text))
        self.words.append(words)
        self.links.append(links)
        self.stops.append(len(_STOPS.findall(text)) if text else 0)
        self.tags.append(0)
        self.controls.append(0)
        self.marks.append(mark)
        return len(self.page) - 1

    def add(self, source: str) -> None:
        """Read a page. Elements that the page leaves open end with those that hold them; stray ends are passed over."""
        top = self._node(-1, "body")
        stack, names = [top], ["body"]
        depths: dict[str, list[int]] = {"body": [0]}  # of the open elements of a name, outer ones first
        pieces: list[str] = []
        links, in_link, at = 0, False, 0

        def flush() -> None:
            nonlocal links
            if pieces:
                found = html.unescape("".join(pieces)).split()
                pieces.clear()
                if found:
                    text = " ".join(found)
                    self._node(stack[-1], "#text", text=text, words=len(found), links=min(links, len(text)))
            links = 0

        def close(depth: int) -> None:
            for name in names[depth:]:
                depths[name].pop()
            del stack[depth:], names[depth:]

        def innermost(tags: set[str]) -> int:
            """Depth of the innermost open element of some names; 0, the page's own, where there is none."""
            return max((depths[t][-1] for t in tags if depths.get(t)), default=0)

        for m in iter(lambda: _TAG.search(source, at), None):
            if m.start() > at:
                piece = source[at:m.start()]
                pieces.append(piece)
                if in_link:
                    links += len(piece)
            at = m.end()
            ends, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if tag is None:
                continue
            tag = tag.lower()
            if tag in RAW:
                if not ends and not attributes.endswith("/"):
                    after = _HEAD.match(source, at) if tag == "head" else _after(tag).search(source, at)
                    at = after.end() if after else len(source)
                    if tag == "textarea":
                        self.controls[stack[-1]] += 1
                continue
            if tag == "br":
                pieces.append(" ")
            elif tag == "a":
                in_link = not ends
            elif tag in ("input", "img"):
                self.controls[stack[-1]] += tag == "input"
                self.tags[stack[-1]] += 1
            elif tag in ("html", "body"):
                if not ends and attributes:
                    self.hints[top] |= _hints(attributes)
            elif tag not in BLOCKS:
                self.tags[stack[-1]] += 1
            elif ends:
                flush()
                if depth := innermost({tag}):
                    close(depth)
                in_link = False
            else:
                flush()
                if names[-1] == "p" and tag not in ("button", "label", "select", "option"):
                    close(len(names) - 1)
                if tag in ENDS:
                    same, holders = ENDS[tag]
                    if (depth := innermost(same)) > innermost(holders):
                        close(depth)
                if tag not in VOID:
                    mark = "1" if "x-keep" in attributes else "0" if "x-drop" in attributes else ""
                    stack.append(self._node(stack[-1], tag, attributes, mark=mark))
                    depths.setdefault(tag, []).append(len(names))
                    names.append(tag)
                in_link = False
        if at < len(source):
            pieces.append(source[at:])
        flush()
        self.count += 1

    def arrays(self) -> Nodes:
        return Nodes(self)


@functools.lru_cache(100)
def _after(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\s*>", re.I)


class Nodes:
    """The nodes as arrays, with sums over subtrees and siblings, and features."""

    def __init__(self, pages: Pages):
        whole = lambda x: np.array(x, np.int64)
        self.page, self.parent, self.kind, self.hints = map(whole, (pages.page, pages.parent, pages.kind, pages.hints))
        n = len(self.page)
        self.depth = np.zeros(n, np.int64)
        parents = self.parent.tolist()
        depths = [0] * n
        for i, p in enumerate(parents):
            if p >= 0:
                depths[i] = depths[p] + 1
        self.depth = whole(depths)
        self.levels = np.split(np.argsort(self.depth, kind="stable"), np.cumsum(np.bincount(self.depth))[:-1]) if n else []
        own = np.stack([np.ones(n), *[np.array(x, float) for x in (pages.chars, pages.words, pages.links, pages.stops, pages.tags, pages.controls)],
                        *[self.kind == k for k in (7, 9, 11, 18)]], axis=1) if n else np.zeros((0, 11))
        self.own, self.sums = own, own.copy()
        for at in self.levels[:0:-1]:
            np.add.at(self.sums, self.parent[at], self.sums[at])
        self.children = np.bincount(self.parent[self.parent >= 0], minlength=n)
        # Places among siblings, and the flags of all that hold a node.
        place = [0] * n
        seen = [0] * n
        for i, p in enumerate(parents):
            if p >= 0:
                place[i] = seen[p]
                seen[p] += 1
        self.place = whole(place)
        kinds = 1 << self.kind
        self.above_hints, self.above_kinds = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for at in self.levels[1:]:
            p = self.parent[at]
            self.above_hints[at] = self.above_hints[p] | self.hints[p]
            self.above_kinds[at] = self.above_kinds[p] | kinds[p]

    def features(self) -> np.ndarray:
        n = len(self.page)
        up = np.maximum(self.parent, 0)
        root = np.searchsorted(self.page, self.page)
        size, chars, words, links, stops, tags, controls, ps, heads, items, blocks = self.sums.T
        of = lambda a, b: a / np.maximum(b, 1)
        before = np.cumsum(self.own[:, 1])
        before = before - before[root]
        last = np.zeros(n, bool)
        last[:-1] = self.page[1:] == self.page[:-1]
        text = self.own[:, 1]
        same_kind = np.bincount(up * 32 + self.kind, minlength=n * 32)[up * 32 + self.kind]
        columns = [
            self.depth, self.children, self.place, of(self.place, self.children[up]), self.children[up], of(same_kind, self.children[up]),
            np.log1p(chars), np.log1p(words), of(chars, words), of(links, chars), of(stops, words), of(tags + size, chars), np.log1p(controls),
            np.log1p(ps), np.log1p(heads), np.log1p(items), np.log1p(blocks), of(chars, blocks), of(chars, size),
            of(before, chars[root]), of(chars, chars[root]), of(chars, chars[up]), of(links[up], chars[up]), of(chars[up], blocks[up]), of(stops[up], words[up]),
            np.where(np.roll(last, 1) & (np.arange(n) > 0), np.roll(text, 1), 0), np.where(last, np.roll(text, -1), 0),
            *[self.kind == k for k in range(len(KINDS))], *[self.kind[up] == k for k in (6, 7, 10, 11, 17)],
            *[(self.hints >> i) & 1 for i in range(len(HINTS))], *[(self.above_hints >> i) & 1 for i in range(len(HINTS))],
            *[(self.above_kinds >> k) & 1 for k in (0, 1, 2, 3, 4, 5, 10, 12, 14, 15)]]
        return np.stack([np.asarray(c, np.float32) for c in columns], axis=1) if n else np.zeros((0, len(columns)), np.float32)

    def decode(self, p: np.ndarray) -> np.ndarray:
        """The likeliest choice of nodes in which no node is chosen whose parent is not."""
        yes, no = np.log(np.clip(p, 1e-6, 1)), np.log(np.clip(1 - p, 1e-6, 1))
        for at in self.levels[:0:-1]:
            up = self.parent[at]
            np.add.at(yes, up, np.maximum(yes[at], no[at]))
            np.add.at(no, up, no[at])
        chosen = yes > no
        for at in self.levels[1:]:
            chosen[at] &= chosen[self.parent[at]]
        return chosen
