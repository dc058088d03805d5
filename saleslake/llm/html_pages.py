"""Labelled pages to train the page model on: `data-content` marks what is content.

Page layouts as they are commonly written, each with its parts marked; the words in them
are drawn at random, so that lengths say little and the structure has to be learned. The
number of pages is a parameter, and the same number always gives the same pages.
"""

from __future__ import annotations

import random

_SYLLABLES = "ka lo mi ner tas ve ruk os hin del par shu wen gor bal".split()


class _Writer:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.random
        out = []
        for k in range(r.randint(low, high)):
            word = "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 3)))
            out.append(word.capitalize() if k == 0 or r.random() < 0.05 else word)
            if r.random() < 0.12:
                out[-1] += r.choice(".,.")
        return " ".join(out) + r.choice([".", ".", ""])

    def links(self, low: int = 2, high: int = 9) -> str:
        count = self.random.randint(low, high)
        return "".join(f'<li><a href="#">{self.words(1, 4)}</a></li>' for _ in range(count))

    def pick(self, *options: str) -> str:
        return self.random.choice(options)

    def maybe(self, part: str, chance: float = 0.6) -> str:
        return part if self.random.random() < chance else ""

    def paragraphs(self) -> str:
        r = self.random
        out = []
        for _ in range(r.randint(1, 9)):
            kind = r.random()
            if kind < 0.7:
                out.append(f"<p>{self.words(1, r.choice([6, 20, 120]))}</p>")
            elif kind < 0.78:
                out.append(f"<h{r.randint(2, 4)}>{self.words(1, 8)}</h3>")
            elif kind < 0.84:
                items = "".join(f"<li>{self.words(2, 15)}</li>" for _ in range(r.randint(2, 5)))
                out.append(f"<ul>{items}</ul>")
            elif kind < 0.9:
                out.append(f"<blockquote>{self.words(4, 40)}</blockquote>")
            elif kind < 0.95:
                cells = "".join(f"<td>{self.words(1, 5)}</td>" for _ in range(3))
                out.append(f"<table><tr>{cells}</tr><tr>{cells}</tr></table>")
            else:
                out.append(f"<figure><img><figcaption>{self.words(3, 14)}</figcaption></figure>")
        return "".join(out)

    def content(self, tag: str, names: str) -> str:
        title = f"<h1>{self.words(2, 12)}</h1>"
        if self.random.random() < 0.3:
            title = f"<header>{title}</header>"
        return f'<{tag}{names} data-content="1">{title}{self.paragraphs()}</{tag}>'

    def menu(self) -> str:
        name = self.pick("menu", "main-menu", "navbar", "navigation", "breadcrumbs", "topnav")
        return self.pick(
            f'<nav data-content="0"><ul>{self.links()}</ul></nav>',
            f'<div class="{name}" data-content="0"><ul>{self.links()}</ul></div>',
            f'<ul id="{name}" data-content="0">{self.links()}</ul>',
            f'<div role="navigation" data-content="0">{self.links()}</div>',
            f'<nav data-content="0">{self.words(1, 3)} / {self.words(1, 8)}</nav>',
        )

    def header(self) -> str:
        inner = f"<p>{self.words(1, 10)}</p>" + self.maybe(f"<ul>{self.links(1, 4)}</ul>", 0.4)
        name = self.pick("header", "site-header", "masthead", "top-bar", "page-header")
        return self.pick(
            f'<header data-content="0">{inner}</header>',
            f'<div id="{name}" data-content="0">{inner}</div>',
            f'<header class="{name}" data-content="0"><div>{inner}</div></header>',
        )

    def footer(self) -> str:
        inner = f"&copy; {self.words(1, 25)}"
        name = self.pick("footer", "site-footer", "page-footer", "copyright", "bottom")
        return self.pick(
            f'<footer data-content="0">{inner}</footer>',
            f'<div class="{name}" data-content="0"><p>{inner}</p></div>',
            f'<footer data-content="0"><p>{inner}</p><ul>{self.links(1, 5)}</ul></footer>',
        )

    def aside(self) -> str:
        inner = self.pick(
            f"<ul>{self.links()}</ul>", f"<p>{self.words(2, 60)}</p>",
            f"<h3>{self.words(1, 4)}</h3><ul>{self.links()}</ul>", self.words(1, 6),
        )
        name = self.pick("sidebar", "side-bar", "widget", "related", "related-posts", "rail",
                         "share", "social", "tags")
        return self.pick(
            f'<aside data-content="0">{inner}</aside>',
            f'<div class="{name}" data-content="0">{inner}</div>',
            f'<section id="{name}" data-content="0">{inner}</section>',
        )

    def notice(self) -> str:
        name = self.pick("cookie-notice", "cookie-banner", "notice", "gdpr-consent", "modal",
                         "popup", "newsletter", "subscribe", "alert", "paywall", "disclaimer")
        tag = self.pick("div", "section", "p", "aside")
        return f'<{tag} class="{name}" data-content="0">{self.words(2, 60)}</{tag}>'

    def advert(self) -> str:
        name = self.pick("ad", "ads", "advert", "advertisement", "ad-slot", "sponsored", "promo",
                         "banner", "adsbox", "sponsor")
        tag = self.pick("div", "section", "p", "aside")
        return f'<{tag} {self.pick("class", "id")}="{name}" data-content="0">{self.words(1, 60)}</{tag}>'

    def form(self) -> str:
        name = self.pick("search", "login", "signup", "contact-form", "")
        return (
            f'<form class="{name}" data-content="0"><label>{self.words(1, 4)}</label>'
            f"<input><button>{self.words(1, 2)}</button>{self.maybe(f'<p>{self.words(2, 20)}</p>')}"
            "</form>"
        )

    def comments(self) -> str:
        each = self.pick("comment", "reply", "comment-body", "user-comment")
        items = "".join(
            f'<div class="{each}"><p>{self.words(2, 60)}</p></div>'
            for _ in range(self.random.randint(1, 5))
        )
        name = self.pick("comments", "comment-list", "disqus_thread", "responses", "discussion")
        tag = self.pick("div", "section", "ol")
        return (
            f'<{tag} {self.pick("id", "class")}="{name}" data-content="0">'
            f"<h2>{self.words(1, 3)}</h2>{items}</{tag}>"
        )

    def page(self) -> str:
        r = self.random
        names = self.pick("", ' class="content"', ' id="main-content"', ' class="post"',
                          ' class="entry-content"', ' class="article-body"', ' class="story"')
        body = self.content(self.pick("article", "article", "main", "div", "section"), names)
        inside = [f() for f in (self.advert, self.notice, self.aside, self.comments, self.form,
                                self.menu, self.footer)
                  if r.random() < 0.3]
        if inside:
            cut = body.rindex("</")
            place = body.find("</p>") + 4 if r.random() < 0.5 and "</p>" in body else cut
            body = body[:place] + "".join(inside) + body[place:]
        if r.random() < 0.4:
            body = f'<div{self.pick("", " class=wrapper", " id=page", " class=container")}>{body}</div>'
        if r.random() < 0.1:
            body = self.content("div", "").removeprefix('<div data-content="1">')
            body = f'<div data-content="1">{body}'
        before = [f() for f in (self.header, self.menu, self.notice, self.advert, self.form,
                                self.aside) if r.random() < 0.5]
        after = [f() for f in (self.comments, self.aside, self.advert, self.form, self.notice)
                 if r.random() < 0.35]
        r.shuffle(before)
        r.shuffle(after)
        inner = "".join([*before, body, *after, self.maybe(self.footer(), 0.85)])
        return (
            f"<html><head><title>{self.words(1, 9)}</title></head>"
            f"<body>{inner}</body></html>"
        )


    def unmarked(self) -> str:
        """A page without `h1`, `article` and `main`: its text lies in a block whose name may say
        anything, or in the body itself, or is all there is."""
        r = self.random
        text = "".join(
            f"<p>{self.words(3, r.choice([12, 40, 120]))}</p>" for _ in range(r.randint(1, 6))
        )
        if r.random() < 0.3:
            text = f"<h2>{self.words(1, 8)}</h2>{text}"
        bare = r.random()
        if bare < 0.2:
            text = "<br>".join(self.words(5, 60) for _ in range(r.randint(1, 4)))
        elif bare > 0.4:
            name = self.pick(
                "", "", "text", "content", "post", "entry", "box", "inner", "page", "col",
                self.words(1, 1).strip(".,").lower(), "discussion-paper", "social-house",
                "notice-period", "promotion-prize", "banner-day", "header-story", "footer-land",
                "menu-review", "search-report", "response-plan", "related-work", "reply-letter",
                "alert-level", "tags-essay", "copyright-law", "side-story",
            )
            tag = self.pick("div", "div", "section", "td")
            text = f'<{tag} class="{name}">{text}</{tag}>'
            if tag == "td":
                text = f"<table><tr>{text}</tr></table>"
            if r.random() < 0.3:
                text = f'<div{self.pick("", " class=wrapper", " id=page")}>{text}</div>'
        few = [f() for f in (self.header, self.menu, self.form) if r.random() < 0.4]
        last = [f() for f in (self.aside, self.notice, self.advert) if r.random() < 0.25]
        if r.random() < 0.3:
            few.append(self.advert() if r.random() < 0.5 else self.notice())
        inner = "".join([*few, text, *last, self.maybe(self.footer(), 0.6)])
        return f'<html><body data-content="1">{inner}</body></html>'


def labelled_pages(count: int) -> list[str]:
    """Every third page is an unmarked one."""
    return [
        _Writer(seed).unmarked() if seed % 3 == 2 else _Writer(seed).page() for seed in range(count)
    ]
