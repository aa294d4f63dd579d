"""The main text of a web page.

A page becomes a tree of its block elements, with a text node for each block of
text. Gradient-boosted trees give each node a probability that its subtree holds
main text, from its element, the words of its attributes, depth, place among its
siblings, density of text, links and tags below it, and what holds it. Decoding
picks the likeliest set of nodes in which a chosen node's parent is chosen too.

The trees are trained on made-up pages whose main text is known: articles in
many layouts, with menus, notices, adverts, forms and comments around and in them.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .html_tree import Pages
from .token_store import _batches

#: Pages made for training; the only bound on it.
TRAINING_PAGES = 700
SEED = 5


class _Maker:
    """Made-up pages; ``x-keep`` and ``x-drop`` mark what is main text and what is not."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)
        syllables = "an be ca do el fi go ha in jo ka li mo ne or pa re so ta un ver wi ze ing ment ción der é ö th ou st".split()
        self.words = ["".join(self.rng.choice(syllables, self.rng.integers(1, 4))) for _ in range(600)]

    def pick(self, *options: str) -> str:
        return options[self.rng.integers(len(options))]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def some(self, n: int) -> str:
        return " ".join(self.rng.choice(self.words, n))

    def sentence(self, low: int = 4, high: int = 18) -> str:
        return self.some(self.rng.integers(low, high)).capitalize() + self.pick(".", ".", ".", "?", "!", "")

    def prose(self, low: int = 1, high: int = 7) -> str:
        text = [self.sentence() for _ in range(self.rng.integers(low, high))]
        if self.chance(0.2):
            text.insert(0, f"<b>{self.some(2)}</b>")
        if self.chance(0.15):
            text.append(f'<a href="/x">{self.some(3)}</a> {self.sentence()}')
        if self.chance(0.1):
            text.append(f"<br>{self.sentence()}")
        return " ".join(text)

    def attr(self, *names: str) -> str:
        name = self.pick(*names)
        return self.pick(f' class="{name}"', f' id="{name}"', f' class="{self.some(1)} {name}"', f" class={name}", f' class="{name}-{self.some(1)}"')

    def links(self, low: int = 2, high: int = 9) -> str:
        items = [f'<a href="/{self.some(1)}">{self.some(self.rng.integers(1, 4))}</a>' for _ in range(self.rng.integers(low, high))]
        kind = self.rng.integers(3)
        if kind == 0:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return "".join(f"<div>{x}</div>" for x in items) if kind == 1 else self.pick(" | ", " ", " &middot; ").join(items)

    def menu(self) -> str:
        tag = self.pick("<nav{}>", "<nav>", "<nav>", "<div{}>")
        end = "</nav>" if "nav" in tag else "</div>"
        return tag.format(self.attr("nav", "menu", "navigation", "breadcrumb", "main-menu", "toc")).replace(">", " x-drop>", 1) + self.links() + end

    def header(self) -> str:
        inner = self.pick(f"<h1>{self.some(2)}</h1>", f"<div{self.attr('logo', 'brand')}>{self.some(1)}</div>", f"<p>{self.sentence(3, 8)}</p>", "")
        tag = self.pick("header", "div", "header")
        named = "" if tag == "header" and self.chance(0.6) else self.attr("header", "masthead", "top-bar", "site-header")
        return f"<{tag}{named} x-drop>{inner}{self.menu() if self.chance(0.6) else ''}</{tag}>"

    def footer(self) -> str:
        tag = self.pick("footer", "div", "footer")
        named = "" if tag == "footer" and self.chance(0.7) else self.attr("footer", "copyright", "legal", "site-footer")
        inner = self.pick(f"&copy; {self.some(1)}.example &middot; {self.prose(1, 4)}", f"<p>{self.prose(1, 3)}</p>", self.links(2, 6), f"{self.some(2)}\n{self.prose(1, 3)}<p>{self.prose(1, 2)}</p>")
        return f"<{tag}{named} x-drop>{inner}</{tag}>"

    def sidebar(self) -> str:
        tag = self.pick("aside", "div", "section", "aside")
        named = "" if tag == "aside" and self.chance(0.5) else self.attr("sidebar", "related", "widget", "right-rail", "recommended", "trending", "more-stories")
        inner = (f"<h3>{self.some(2)}</h3>" if self.chance(0.7) else "") + self.pick(self.links(), f"<p>{self.prose(1, 5)}</p>", f"{self.links()}<p>{self.prose(1, 3)}</p>")
        return f"<{tag}{named} x-drop>{inner}</{tag}>"

    def advert(self) -> str:
        tag = self.pick("div", "div", "section", "aside", "p")
        inner = self.pick(self.prose(1, 4), f"<p>{self.prose(1, 3)}</p>", f'<a href="/buy">{self.sentence(3, 9)}</a>', self.sentence()) if tag != "p" else self.prose(1, 3)
        return f"<{tag}{self.attr('ad', 'ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'ad-slot', 'banner-ad')} x-drop>{inner}</{tag}>"

    def notice(self) -> str:
        tag = self.pick("div", "div", "section", "dialog", "p")
        named = self.pick(self.attr("cookie-notice", "consent", "notice", "alert", "gdpr", "privacy-banner", "announcement", "modal", "popup"), ' role="alert"', ' role="dialog"')
        inner = self.prose(1, 4) if tag == "p" else self.pick(f"<p>{self.prose(1, 4)}</p><button>{self.some(1)}</button>", self.prose(1, 3))
        return f"<{tag}{named} x-drop>{inner}</{tag}>"

    def form(self) -> str:
        fields = "".join(f"<label>{self.some(2)}</label><input name=q>" for _ in range(self.rng.integers(1, 4)))
        intro = f"<p>{self.prose(1, 3)}</p>" if self.chance(0.5) else ""
        named = self.attr("newsletter", "search", "login", "subscribe", "signup") if self.chance(0.6) else ""
        body = f"<form{named} x-drop>{intro}{fields}<button>{self.some(1)}</button></form>"
        return body if self.chance(0.6) else f"<div{self.attr('newsletter', 'signup', 'subscribe-box')} x-drop>{intro}{body}</div>"

    def share(self) -> str:
        return f"<div{self.attr('share', 'social', 'follow-us')} x-drop>{self.links(2, 5)}</div>"

    def comments(self) -> str:
        item = lambda: self.pick(f"<p>{self.prose(1, 5)}</p>", f"<div{self.attr('comment', 'reply')}><b>{self.some(1)}</b><p>{self.prose(1, 6)}</p></div>",
                                 f"<li><p>{self.some(1)}</p><p>{self.prose(1, 5)}</p></li>", f"<article{self.attr('comment')}><p>{self.prose(1, 5)}</p></article>")
        inner = "".join(item() for _ in range(self.rng.integers(1, 7)))
        title = f"<h3>{self.some(2)}</h3>" if self.chance(0.6) else ""
        tag = self.pick("div", "section", "ol", "ul")
        return f"<{tag}{self.attr('comments', 'comment-list', 'replies', 'responses', 'discussion', 'reader-comments')} x-drop>{title}{inner}{self.form() if self.chance(0.3) else ''}</{tag}>"

    def part(self) -> str:
        kind = self.rng.random()
        if kind < 0.08:
            return f"<p>{self.some(self.rng.integers(1, 4))}{self.pick('.', '', '?')}</p>"
        if kind < 0.62:
            return f"<p>{self.prose()}" + ("</p>" if self.chance(0.8) else "")
        if kind < 0.72:
            return f"<h{self.rng.integers(2, 4)}>{self.sentence(2, 7)}</h2>"
        if kind < 0.80:
            tag = self.pick("ul", "ol")
            return f"<{tag}>" + "".join(f"<li>{self.sentence()}" for _ in range(self.rng.integers(2, 6))) + f"</{tag}>"
        if kind < 0.86:
            return f"<blockquote><p>{self.prose(1, 4)}</p></blockquote>"
        if kind < 0.90:
            return "<table>" + "".join(f"<tr><td>{self.some(2)}</td><td>{self.some(1)}</td></tr>" for _ in range(self.rng.integers(2, 5))) + "</table>"
        if kind < 0.94:
            return f"<pre>{self.some(8)}</pre>"
        return f"<div>{self.prose()}</div>" if kind < 0.97 else f"<p><b>{self.prose()}<br><p>{self.prose()}</p>"

    def article(self) -> str:
        tag = self.pick("article", "article", "article", "main", "div", "section", "div")
        named = self.attr("article", "content", "post", "entry", "story", "article-body", "main", "post-content", "text") if tag in ("div", "section") and self.chance(0.85) or self.chance(0.3) else ""
        title = f"<h1>{self.pick(self.sentence(2, 10), self.some(3))}</h1>" if self.chance(0.85) else ""
        n = self.pick("none", "short", "long", "long", "long")
        parts = [] if n == "none" else [self.part() for _ in range(self.rng.integers(1, 4) if n == "short" else self.rng.integers(3, 16))]
        if not parts:
            title = f"<h1>{self.sentence(2, 10)}</h1>" + self.pick("", f"<p><b>{self.sentence()}<br>")
        if parts and self.chance(0.35):
            parts.insert(self.rng.integers(len(parts) + 1), self.pick(self.advert(), self.sidebar(), self.share(), self.form(), self.notice()))
        inner = title + "".join(parts)
        if parts and self.chance(0.08):  # nothing holds the article but the page
            return "".join(x if "x-drop" in x else x.replace(">", " x-keep>", 1) for x in [title, *parts] if x)
        if self.chance(0.3):
            inner = f"<div>{inner}</div>"
        if self.chance(0.25):
            inner += self.pick(self.comments(), self.share(), self.sidebar())
        return f"<{tag}{named} x-keep>{inner}" + (f"</{tag}>" if self.chance(0.97) else "")

    def page(self) -> str:
        before = [x() for x, p in ((self.notice, 0.25), (self.header, 0.5), (self.menu, 0.6), (self.advert, 0.35), (self.form, 0.12), (self.sidebar, 0.15)) if self.chance(p)]
        after = [x() for x, p in ((self.share, 0.12), (self.comments, 0.35), (self.sidebar, 0.3), (self.advert, 0.2), (self.form, 0.15), (self.notice, 0.12), (self.footer, 0.75)) if self.chance(p)]
        self.rng.shuffle(before)
        main = self.article() if self.chance(0.97) else ""
        for _ in range(self.rng.integers(0, 3)):
            main = f"<div{self.attr('wrapper', 'container', 'page', 'row', 'layout') if self.chance(0.7) else ''}>{main}{after.pop(0) if after and self.chance(0.4) else ''}</div>"
        return f"<html><head><title>{self.some(3)}</title></head><body>{''.join(before)}{main}{''.join(after)}</body></html>"


@dataclass(frozen=True)
class Extractor:
    trees: boosting.Trees

    def texts(self, sources: list[str]) -> list[str]:
        """The main text of each page: its blocks, an empty line between two."""
        pages = Pages()
        for s in sources:
            pages.add(s)
        out: list[list[str]] = [[] for _ in sources]
        if sources:
            nodes = pages.arrays()
            for i in np.flatnonzero(nodes.decode(self.trees.probability(nodes.features()))).tolist():
                if pages.texts[i]:
                    out[pages.page[i]].append(pages.texts[i])
        return ["\n\n".join(x) for x in out]


@functools.lru_cache(4)
def train(n: int = TRAINING_PAGES, seed: int = SEED) -> Extractor:
    """Trees trained on made-up pages: a node counts as main text when a block below it is."""
    maker, pages = _Maker(seed), Pages()
    for _ in range(n):
        pages.add(maker.page())
    nodes = pages.arrays()
    keep = np.zeros(len(pages.marks), bool)
    for i, (mark, parent) in enumerate(zip(pages.marks, pages.parent)):
        keep[i] = mark == "1" or mark == "" and parent >= 0 and keep[parent]
    y = keep & (nodes.own[:, 1] > 0)
    for at in nodes.levels[:0:-1]:
        np.logical_or.at(y, nodes.parent[at], y[at])
    return Extractor(boosting.fit(nodes.features(), y.astype(float)))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per row of ``pages``: the key, the url, ``text`` and ``n_chars`` (its code points).

    Character references are decoded, white space inside a block is one space,
    blocks are joined by an empty line. Null and empty pages, and pages without
    main text, have an empty text. Other columns are ignored; repeated rows stay.
    """
    model = pages.sparkSession.sparkContext.broadcast(train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, "html"):
            texts = model.value.texts([s or "" for s in batch["html"].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    slim = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(source).alias("html"))
    found = slim.mapInArrow(run, "page_id long, url string, text string")
    return found.select(F.col("page_id").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
