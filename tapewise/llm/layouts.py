"""Labelled training pages: real texts set into page layouts whose blocks are labelled by construction.

Each layout writes the same kinds of parts (menu, banner, notice, advert,
article, comments, form, sidebar, footer) with its own tags and names, with or
without the landmark elements, and with the flaws of real pages: unclosed
paragraphs and inline tags, breaks, and a cut-off end.
"""

from __future__ import annotations

import html
import random

from tapewise.llm.common import by_value

#: Names that page authors give to parts, by role.
ARTICLE = ("content", "article", "post", "entry", "main", "story", "post content", "entry content", "article body", "text")
MENU = ("nav", "menu", "navbar", "navigation", "top menu", "breadcrumb", "breadcrumbs", "tabs", "pager", "pagination")
BANNER = ("header", "banner", "masthead", "top", "logo", "site header", "hero banner", "topbar")
NOTICE = ("cookie", "notice", "cookie notice", "consent", "alert", "popup", "modal", "newsletter", "subscribe", "gdpr", "privacy notice")
ADVERT = ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "sponsor", "ad box", "banner ad")
ASIDE = ("sidebar", "side", "related", "widget", "related posts", "recent", "popular", "share", "social", "tags", "author box")
COMMENT = ("comments", "comment", "comment list", "replies", "responses", "discussion", "reader comments", "comment body")
FOOTER = ("footer", "foot", "bottom", "copyright", "legal", "site footer")
FORM = ("form", "search", "login", "signup", "search form", "contact form")


class Page:
    def __init__(self, rng: random.Random):
        self.rng, self.out, self.labels = rng, [], []

    def raw(self, text: str) -> None:
        self.out.append(text)

    def block(self, tag: str, text: str, label: int, close: bool = True, inner: str = "{}") -> None:
        if text.split():
            self.out.append(f"<{tag}>{inner.format(html.escape(text))}" + (f"</{tag.split()[0]}>" if close else ""))
            self.labels.append(label)

    def named(self, names: tuple) -> str:
        words = self.rng.choice(names).split()
        joined = self.rng.choice((" ".join(words), "-".join(words), "_".join(words)))
        return f' {self.rng.choice(("class", "id"))}="{joined}"'


def _short(text: str, n: int) -> str:
    return " ".join(text.split()[:n]).replace("{", "(").replace("}", ")")


def _menu(p: Page, words: list[str], landmark: bool) -> None:
    tag = "nav" if landmark else "div"
    p.raw(f"<{tag}{'' if landmark and p.rng.random() < 0.5 else p.named(MENU)}>")
    style = p.rng.random()
    if style < 0.7:
        p.raw("<ul>")
        for w in words:
            p.block("li", w, 0, inner='<a href="/x">{}</a>')
        p.raw("</ul>")
    else:
        p.block("p", " ".join(words), 0, inner='<a href="/">{}</a>')
    p.raw(f"</{tag}>")


def _side(p: Page, names: tuple, texts: list[str], tag: str, linked: bool) -> None:
    p.raw(f"<{tag}{p.named(names) if tag == 'div' or p.rng.random() < 0.5 else ''}>")
    if len(texts) == 1 and p.rng.random() < 0.6:
        if texts[0].split():
            p.raw(html.escape(texts[0]))
            p.labels.append(0)
    else:
        for t in texts:
            p.block(p.rng.choice(("p", "div", "h3", "span" if len(texts) == 1 else "li")), t, 0, inner='<a href="/y">{}</a>' if linked else "{}")
    p.raw(f"</{tag}>")


def _article(p: Page, title: str, paragraphs: list[str], landmark: bool) -> None:
    tag = p.rng.choice(("article", "article", "main")) if landmark else p.rng.choice(("div", "div", "section", "td"))
    p.raw(("<table><tr>" if tag == "td" else "") + f"<{tag}{'' if landmark and p.rng.random() < 0.6 else p.named(ARTICLE)}>")
    if p.rng.random() < 0.8:
        p.block(p.rng.choice(("h1", "h1", "h2")), title, 1)
    for t in paragraphs:
        style = p.rng.random()
        if style < 0.08:
            p.block("p", t, 1, close=False, inner="<b>{}<br>")
        elif style < 0.13:
            p.block("h2", _short(t, 6), 1)
        elif style < 0.2:
            p.raw("<ul>")
            p.block("li", t, 1)
            p.raw("</ul>")
        elif style < 0.26:
            p.block("blockquote", t, 1)
        elif style < 0.34:
            p.block("p", t, 1, inner='{} <a href="/z">more</a>')
        elif style < 0.4:
            p.block("div", t, 1)
        else:
            p.block("p", t, 1)
        if p.rng.random() < 0.04:
            _side(p, ADVERT, [_short(title, 8)], "div", p.rng.random() < 0.5)
    p.raw(f"</{tag}>" + ("</tr></table>" if tag == "td" else ""))


def labelled_pages(texts: list[list[str]], seed: int) -> list[tuple[str, list[int]]]:
    """One page per list of texts: its html and the label (1: article) of each leaf block."""
    out = []
    for number, parts in enumerate(texts):
        rng = random.Random(seed * 1_000_003 + number)
        p, landmark = Page(rng), rng.random() < 0.5
        pool = [_short(t, 120) for t in parts if t.split()] or ["text"]
        some = lambda n, words: [_short(rng.choice(pool), rng.randint(1, words)) for _ in range(n)]
        p.raw("<!DOCTYPE html><html><head><title>x</title><script>var t='</p>';</script></head><body>")
        if rng.random() < 0.4:
            _side(p, BANNER, some(rng.randint(1, 2), 8), "header" if landmark else "div", rng.random() < 0.5)
        if rng.random() < 0.85:
            _menu(p, some(rng.randint(2, 8), 2), landmark)
        if rng.random() < 0.35:
            _side(p, NOTICE, some(1, 30), "div", rng.random() < 0.3)
        if rng.random() < 0.6:
            p.raw("<!-- ad -->")
            _side(p, ADVERT, some(1, 30), "div", rng.random() < 0.4)
        if rng.random() < 0.25:
            _side(p, ASIDE, some(rng.randint(1, 5), 12), "aside" if landmark else "div", rng.random() < 0.7)
        _article(p, _short(rng.choice(pool), 10), some(rng.randint(1, 12), 120), landmark)
        if rng.random() < 0.3:
            _side(p, FORM, some(rng.randint(1, 2), 6), "form", False)
        if rng.random() < 0.4:
            p.raw(f"<{'section' if landmark else 'div'}{p.named(COMMENT)}>")
            for t in some(rng.randint(1, 6), 80):
                p.block(rng.choice(("p", "div", "li")), t, 0)
            p.raw(f"</{'section' if landmark else 'div'}>")
        if rng.random() < 0.4:
            _side(p, ASIDE, some(rng.randint(1, 5), 25), "aside" if landmark else "div", rng.random() < 0.6)
        if rng.random() < 0.85:
            note = rng.choice(("© ", "Copyright ", "")) + some(1, 20)[0]
            _side(p, FOOTER, [note], "footer" if landmark or rng.random() < 0.3 else "div", rng.random() < 0.2)
        p.raw("</body></html>")
        out.append(("".join(p.out), p.labels))
    return out


by_value(__name__)
