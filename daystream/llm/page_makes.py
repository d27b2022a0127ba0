"""Made-up pages with known main text, to train the block labeller on.

Every page is put together at random from the layouts below: an article in
one of many kinds of container, and around or inside it the things that are
not the article. Texts come from a pool, so no word tells what a block is;
``MARK`` in front of a text says that it is main text.
"""

from __future__ import annotations

import html
import random

MARK = "\ue000"  # a private-use character

#: Containers of the article: tag and attributes, None for the page itself.
ARTICLE = [("article", ""), ("article", 'class="post"'), ("main", ""), ("main", 'id="main"'), ("main", 'role="main"'), ("div", 'class="article"'), ("div", 'class="content"'),
           ("div", 'id="content"'), ("div", 'class="entry-content"'), ("div", 'class="post-body"'), ("div", 'class="story"'), ("div", 'id="article-body"'),
           ("section", 'class="article-content"'), ("section", ""), ("div", 'class="main-content"'), ("div", 'class="text"'), ("div", 'class="body"'), ("td", 'class="main"'),
           ("div", 'itemprop="articleBody"'), ("div", 'class="page-content"'), ("div", ""), (None, "")]
#: What is not the article: a list of (tag, attributes), and what it holds.
AROUND = {
    "menu": [("nav", ""), ("nav", 'class="navbar"'), ("div", 'class="menu"'), ("div", 'id="nav"'), ("div", 'class="navigation"'), ("ul", 'class="nav"'), ("div", 'class="breadcrumbs"'),
             ("ol", 'class="breadcrumb"'), ("div", 'role="navigation"'), ("div", 'class="topbar"'), ("div", 'class="pagination"'), ("div", 'class="tags"'), ("div", 'class="links"')],
    "header": [("header", ""), ("header", 'class="site-header"'), ("div", 'class="header"'), ("div", 'id="header"'), ("div", 'id="masthead"'), ("div", 'role="banner"'), ("div", 'class="logo"')],
    "footer": [("footer", ""), ("footer", 'class="site-footer"'), ("div", 'class="footer"'), ("div", 'id="footer"'), ("div", 'class="copyright"'), ("div", 'role="contentinfo"'), ("div", 'class="bottom"')],
    "sidebar": [("aside", ""), ("aside", 'class="sidebar"'), ("div", 'class="sidebar"'), ("div", 'id="sidebar"'), ("div", 'class="widget"'), ("div", 'class="related"'), ("div", 'class="related-posts"'),
                ("section", 'class="recommended"'), ("div", 'class="side-column"'), ("div", 'role="complementary"'), ("div", 'class="more-stories"'), ("div", 'class="popular"'), ("div", 'class="rail"')],
    "notice": [("div", 'class="cookie-notice"'), ("div", 'id="cookie-banner"'), ("div", 'class="notice"'), ("div", 'class="alert"'), ("div", 'class="consent"'), ("div", 'class="gdpr"'), ("div", 'class="banner"'),
               ("div", 'class="modal"'), ("div", 'class="popup"'), ("dialog", ""), ("div", 'role="alert"'), ("div", 'class="paywall"'), ("section", 'class="subscribe"')],
    "advert": [("div", 'class="ad"'), ("div", 'class="ads"'), ("div", 'class="advert"'), ("div", 'class="advertisement"'), ("div", 'class="sponsored"'), ("div", 'class="promo"'), ("div", 'id="ad-1"'),
               ("aside", 'class="ad"'), ("ins", 'class="adsbygoogle"'), ("div", 'class="ad-slot"'), ("div", 'class="promotion"'), ("section", 'class="sponsor"')],
    "form": [("form", ""), ("form", 'class="search"'), ("form", 'id="signup"'), ("div", 'class="newsletter"'), ("div", 'class="login"'), ("form", 'class="comment-form"'), ("div", 'class="search-box"')],
    "share": [("div", 'class="share"'), ("ul", 'class="social"'), ("div", 'class="sharing-buttons"'), ("div", 'class="follow"')],
    "comments": [("section", 'class="comments"'), ("section", 'id="comments"'), ("div", 'class="comments"'), ("div", 'id="comments"'), ("div", 'class="comment-list"'), ("ol", 'class="commentlist"'),
                 ("div", 'id="disqus_thread"'), ("div", 'class="discussion"'), ("div", 'class="reader-comments"'), ("div", 'class="responses"'), ("div", 'class="replies"'), ("ul", 'class="comments"')],
}
NEUTRAL = ["", 'class="container"', 'class="wrapper"', 'id="page"', 'class="row"', 'class="col-8"', 'class="inner"', 'id="wrap"', 'class="layout"', 'class="site"', 'class="grid"', 'id="root"', 'class="box"']


class Maker:
    def __init__(self, pool: list[str], seed: int):
        self.r, self.pool = random.Random(seed), pool

    def some(self, least: int, most: int) -> str:
        """``least`` to ``most`` words of the pool's running text."""
        n, out = self.r.randint(least, most), []
        while len(out) < n:
            w = self.r.choice(self.pool).split()
            s = self.r.randrange(max(1, len(w) - 1))
            out += w[s:s + n - len(out)]
        return " ".join(out)

    def long(self) -> str:
        return self.r.choice(self.pool) if self.r.random() < 0.5 else self.some(*self.r.choice([(2, 12), (8, 40), (20, 90)]))

    def shown(self, text: str, main: bool = False) -> str:
        """The text as HTML, with inline markup now and then."""
        w = html.escape(text, quote=self.r.random() < 0.5).split()
        if w and self.r.random() < 0.35:
            i = self.r.randrange(len(w))
            tag = self.r.choice(["b", "i", "em", "strong", 'a href="/x"', "span", "code"])
            j = min(len(w), i + self.r.randint(1, 4))
            w[i] = f"<{tag}>{w[i]}"
            w[j - 1] += f"</{tag.split()[0]}>"
        if len(w) > 3 and self.r.random() < 0.1:
            w.insert(self.r.randrange(1, len(w)), "<br>")
        return (MARK if main and text.strip() else "") + (" " if self.r.random() < 0.8 else "\n").join(w)

    def wrap(self, tag, attrs, inner: str) -> str:
        return inner if tag is None else f"<{tag}{' ' + attrs if attrs else ''}>{inner}" + ("" if self.r.random() < 0.02 else f"</{tag}>")

    def links(self, n: int) -> str:
        style = self.r.randrange(3)
        a = [f'<a href="/{i}">{html.escape(self.some(1, self.r.choice([1, 2, 6])))}</a>' for i in range(n)]
        if style == 0:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in a) + "</ul>"
        return " | ".join(a) if style == 1 else "".join(f"<div>{x}</div>" for x in a)

    def around(self, kind: str) -> str:
        r = self.r
        tag, attrs = r.choice(AROUND[kind])
        p = lambda lo, hi: f"<p>{self.shown(self.some(lo, hi))}</p>"
        if kind == "menu":
            inner = "".join(f"<li><a href='#'>{html.escape(self.some(1, 3))}</a></li>" for _ in range(r.randint(2, 9))) if tag in ("ul", "ol") else self.links(r.randint(2, 9))
        elif kind == "header":
            inner = r.choice([f"<h1>{self.shown(self.some(1, 5))}</h1>", f"<div>{self.shown(self.some(1, 6))}</div>", self.shown(self.some(1, 6)), self.links(4)]) + (p(3, 10) if r.random() < .4 else "")
        elif kind == "footer":
            inner = r.choice(["&copy; ", "", "2020 &middot; "]) + self.shown(self.some(3, 25)) + (self.links(r.randint(2, 6)) if r.random() < .5 else "") + (p(5, 30) if r.random() < .3 else "")
        elif kind == "sidebar":
            inner = (f"<h3>{self.shown(self.some(1, 4))}</h3>" if r.random() < .7 else "") + r.choice([self.links(r.randint(2, 6)), p(5, 40) + p(5, 40), p(3, 20)])
        elif kind in ("notice", "advert"):
            inner = r.choice([self.shown(self.some(4, 25)), p(4, 25), p(8, 40) + "<button>" + self.some(1, 2) + "</button>"])
        elif kind == "form":
            inner = f"<label>{self.some(1, 4)}</label><input name=q><button>{self.some(1, 2)}</button>" + (p(4, 20) if r.random() < .5 else "") + (
                "<select><option>" + self.some(1, 2) + "<option>" + self.some(1, 2) + "</select>" if r.random() < .3 else "")
        elif kind == "share":
            inner = self.links(r.randint(2, 4))
        else:
            one = lambda: r.choice([f'<div class="{r.choice(["comment", "reply", "post", "item"])}"><b>{self.some(1, 2)}</b><p>{self.shown(self.some(3, 50))}</p></div>',
                                    f"<p>{self.shown(self.some(3, 50))}</p>", f"<div>{self.shown(self.some(3, 40))}</div>"])
            inner = ((f"<h{r.randint(2, 4)}>{self.shown(self.some(1, 4))}</h2>" if r.random() < .6 else "")
                     + "".join((f"<li>{one()}</li>" if tag in ("ol", "ul") else one()) for _ in range(r.randint(1, 6))))
        return self.wrap(tag, attrs, inner)

    def article(self) -> str:
        r = self.r
        out = []
        if r.random() < 0.85:
            t = self.shown(self.some(2, 14), True)
            out.append(r.choice([f"<h1>{t}</h1>", f"<h1>{t}</h1>", f"<h2>{t}</h2>", f"<header><h1>{t}</h1></header>"]))
        for _ in range(r.choice([1, 2, 3, 5, 8, 12, 20])):
            k = r.random()
            if k < 0.72:
                b = r.choice(["", "", "", "<b>"])
                out.append(f"<p>{b}{self.shown(self.long(), True)}" + r.choice(["</p>", "</p>", "</p>", "", "<br>"]))
            elif k < 0.80:
                out.append(f"<h{r.randint(2, 4)}>{self.shown(self.some(1, 8), True)}</h2>")
            elif k < 0.85:
                tag = r.choice(["ul", "ol"])
                out.append(f"<{tag}>" + "".join(f"<li>{self.shown(self.some(2, 20), True)}" + r.choice(["</li>", ""]) for _ in range(r.randint(2, 5))) + f"</{tag}>")
            elif k < 0.88:
                out.append(f"<blockquote>{self.shown(self.some(5, 40), True)}</blockquote>")
            elif k < 0.90:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.shown(self.some(1, 4), True)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif k < 0.92:
                out.append(f"<pre>{self.shown(self.some(4, 20), True)}</pre>")
            elif k < 0.95:
                out.append(f"<div>{self.shown(self.long(), True)}</div>")
            else:
                out.append(self.around(r.choice(["advert", "advert", "form", "share", "sidebar", "notice"])))
        return "".join(out)

    def page(self) -> str:
        r = self.r
        before = [self.around(k) for k, p in (("notice", .35), ("header", .55), ("menu", .85), ("form", .25), ("advert", .45), ("menu", .2), ("sidebar", .3)) if r.random() < p]
        after = [self.around(k) for k, p in (("share", .3), ("comments", .45), ("sidebar", .45), ("advert", .25), ("form", .2), ("menu", .2), ("notice", .15)) if r.random() < p]
        if r.random() < 0.5:
            r.shuffle(before)
            r.shuffle(after)
        if r.random() < 0.85:
            after.append(self.around("footer"))
        if r.random() < 0.15:
            before = []
        if r.random() < 0.1:
            after = []
        tag, attrs = r.choice(ARTICLE)
        body = self.wrap(tag, attrs, self.article())
        inside = r.random()
        if tag == "td":
            body = f"<table><tr><td>{self.links(3)}</td>{body}</tr></table>"
        elif inside < 0.25:
            body = self.wrap("main" if r.random() < .4 else "div", r.choice(NEUTRAL), body + (after.pop(0) if after and r.random() < .5 else ""))
        page = "".join(before) + body + "".join(after)
        for _ in range(r.choice([0, 0, 1, 2])):
            page = self.wrap("div", r.choice(NEUTRAL), page)
        page = (f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{self.some(2, 8)}</title><style>p{{}}</style></head><body>"
                f"<script>var t='</p>';</script><!-- x -->{page}</body></html>")
        return page[:r.randint(len(page) // 2, len(page))] if r.random() < 0.1 else page
