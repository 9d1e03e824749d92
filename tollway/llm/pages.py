"""Labelled pages for training: layouts put together at random, with the label of every block known.

The text of an article and of its reader comments comes from one source, so that only place and form tell them
apart. On some pages (OPAQUE) names and elements say nothing, as build tools make them, or a table lays out the page.
Pages are a function of their seed."""

from __future__ import annotations

import random

# Names that templates of public web sites give to their parts.
MENU = ("nav", "navbar", "menu", "topbar", "breadcrumb", "site-nav", "pagination", "tabs", "toc")
AD = ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "adsense")
NOTICE = ("cookie", "notice", "cookie-banner", "gdpr", "alert", "consent", "announcement")
SIDE = ("sidebar", "widget", "related", "recommended", "popular", "trending", "rail")
SHARE = ("share", "social", "social-links", "newsletter", "subscribe", "signup")
COMMENT = ("comments", "comment-list", "commentlist", "discussion", "responses", "replies", "disqus")
FOOT = ("footer", "site-footer", "copyright", "legal", "bottom", "colophon")
HEAD = ("header", "site-header", "masthead", "logo", "branding")
BODY = ("content", "post", "entry", "entry-content", "article", "article-body", "story", "main", "post-body", "text")


META = ("byline", "meta", "post-meta", "author", "date", "dateline", "post-info")
#: Share of the pages whose names say nothing, and of those laid out by a table.
OPAQUE, TABLES = 0.35, 0.1


class Page:
    """One page: html, and the blocks (text, 1 for article) in page order."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.html: list[str] = []
        self.blocks: list[tuple[str, int]] = []
        r = self.r
        self.junk, self.opaque, table = r.random() < 0.15, r.random() < OPAQUE, r.random() < TABLES
        self.html.append("<!DOCTYPE html><html><head><title>" + self.words(4) + "</title><style>a>b{top:0}</style><script>if(a<b)c('<div>');</script></head><body>")
        cell, row, last = ("<table><tr><td>", "</td><td>", "</td></tr></table>") if table else ("<div>", "", "</div>") if r.random() < 0.4 else ("", "", "")
        self.html.append(cell)
        for part in r.sample([self.head, self.menu, self.ad, self.notice, self.side], r.randint(1, 4)):
            part()
        self.html.append(row)
        if r.random() < 0.95:
            self.article()
        self.html.append(row)
        for part in [x for x in (self.comments, self.side, self.ad, self.share, self.menu, self.form, self.notice) if r.random() < 0.35]:
            part()
        if r.random() < 0.8:
            self.foot()
        self.html.append(last + "</body></html>")

    def word(self) -> str:
        w = "".join(self.r.choice(("ba", "re", "th", "on", "ti", "é", "sch", "ung", "o", "la", "in", "er", "ñ")) for _ in range(self.r.randint(1, 4)))
        return w + self.r.choice(("###", "***", "$$$", "!!")) if self.junk else w

    def words(self, n: int) -> str:
        return " ".join(self.word() for _ in range(n)).capitalize()

    def prose(self) -> str:
        n = self.r.choice((1, 2, 3, 6, 10, 20, 40, 80))
        out = self.words(n)
        if self.r.random() < 0.03:  # not every line of this form is a byline
            return self.r.choice(("By ", "Von ", "Par ", "Updated on ")) + out
        return out + self.r.choice((".", ".", "?", "")) if n > 2 else out + "."

    def put(self, text: str, label: int, tag: str = "p", inner: str = "") -> None:
        self.blocks.append((text, label))
        close = "" if tag == "p" and self.r.random() < 0.1 else f"</{tag}>"
        self.html.append(f"<{tag}>{'<b>' if self.r.random() < 0.05 else ''}{inner or text}{close}")

    def open(self, tag: str, names: tuple[str, ...], bare: float = 0.0) -> str:
        if self.opaque:
            tag = "div" if tag not in ("ol", "ul", "form") and self.r.random() < 0.85 else tag
            name = "".join(self.r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(self.r.randint(2, 7)))
            self.html.append(f"<{tag}>" if self.r.random() < 0.3 else f'<{tag} class="{self.r.choice(("x", "css-", "c", "sc-"))}{name}">')
        elif self.r.random() < bare:
            self.html.append(f"<{tag}>")
        else:
            self.html.append(f'<{tag} {self.r.choice(("class", "class", "id"))}="{self.r.choice(names)}{self.r.choice(("", "", " col-2", " wide"))}">')
        return f"</{tag}>"

    def links(self, label: int = 0) -> None:
        self.html.append("<ul>")
        for _ in range(self.r.randint(2, 7)):
            t = self.words(self.r.randint(1, 3))
            self.put(t, label, "li", f'<a href="/x">{t}</a>')
        self.html.append("</ul>")

    def menu(self) -> None:
        close = self.open("nav", MENU, 0.7) if self.r.random() < 0.6 else self.open("div", MENU)
        self.links()
        self.html.append(close)

    def head(self) -> None:
        close = self.open("header", HEAD, 0.6) if self.r.random() < 0.6 else self.open("div", HEAD)
        self.put(self.words(self.r.randint(1, 3)), 0, self.r.choice(("h1", "h2", "p", "div")))
        if self.r.random() < 0.5:
            self.links()
        self.html.append(close)

    def ad(self) -> None:
        close = self.open(self.r.choice(("div", "div", "aside", "section")), AD)
        self.put(self.prose(), 0, self.r.choice(("p", "div")))
        self.html.append(close)

    def notice(self) -> None:
        close = self.open("div", NOTICE)
        self.put(self.prose(), 0, self.r.choice(("p", "div")))
        self.html.append(close)

    def side(self) -> None:
        close = self.open("aside", SIDE, 0.6) if self.r.random() < 0.6 else self.open("div", SIDE)
        self.put(self.words(2), 0, "h3")
        self.links() if self.r.random() < 0.7 else self.put(self.prose(), 0)
        self.html.append(close)

    def share(self) -> None:
        close = self.open("div", SHARE)
        self.put(self.words(3), 0)
        self.html.append(close)

    def form(self) -> None:
        close = self.open("form", SHARE, 0.7)
        self.put(self.words(3), 0, self.r.choice(("p", "div", "label")))
        self.html.append('<input name="q">' + close)

    def comments(self) -> None:
        close = self.open(self.r.choice(("section", "div", "ol", "ul")), COMMENT)
        said = self.r.choice(("Comments", "3 Comments", "Replies", "Responses (7)", "Leave a reply", "Kommentare", "Commentaires", "Comentarios"))
        self.put(said if self.opaque or self.r.random() < 0.6 else self.words(2), 0, "h3")
        for _ in range(self.r.randint(1, 5)):
            self.html.append(self.r.choice(("<li>", "<div>") if self.opaque else ('<div class="comment">', "<li>", "<div>", "<article>")))
            opened = self.html[-1][1:].split(">")[0].split()[0]
            for _ in range(self.r.randint(1, 2)):
                self.put(self.prose(), 0)
            self.html.append(f"</{opened}>")
        self.html.append(close)

    def meta(self) -> None:
        close = self.open(self.r.choice(("div", "p", "span")), META, 0.3)
        said = self.r.choice(("Posted by", "By", "Published on", "Updated on", "Von", "Par", "Por")) + " " + self.words(2) + self.r.choice(("", " on 3 May 2021", ", 12:30", " 2019-04-02"))
        self.html.append(said + close)
        self.blocks.append((said, 0))

    def foot(self) -> None:
        close = self.open("footer", FOOT, 0.7) if self.r.random() < 0.7 else self.open("div", FOOT)
        self.put("© " + self.prose(), 0, self.r.choice(("p", "div")))
        if self.r.random() < 0.3:
            self.links()
        self.html.append(close)

    def article(self) -> None:
        r = self.r
        kind = r.choice(("article", "article", "main", "div", "section", "div"))
        close = self.open(kind, BODY, 0.7 if kind in ("article", "main") else 0.1)
        if r.random() < 0.8:
            self.put(self.words(r.randint(2, 8)), 1, r.choice(("h1", "h1", "h2")))
        if r.random() < 0.25:
            self.meta()
        for _ in range(r.randint(1, 12)):
            x = r.random()
            if x < 0.72:
                self.put(self.prose(), 1)
            elif x < 0.78:
                self.put(self.words(3), 1, r.choice(("h2", "h3")))
            elif x < 0.84:
                self.html.append("<ul>")
                for _ in range(r.randint(2, 4)):
                    self.put(self.prose(), 1, "li")
                self.html.append("</ul>")
            elif x < 0.88:
                self.put(self.prose(), 1, r.choice(("blockquote", "pre")))
            elif x < 0.91:
                self.ad()
            elif x < 0.94:
                self.share()
            elif x < 0.97:
                self.side()
            else:
                self.form()
        if r.random() < 0.15:
            self.comments()
        self.html.append(close)
