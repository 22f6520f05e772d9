"""Main-text extraction with a linear-chain conditional random field over DOM leaf blocks.

``blocks`` walks a page once and gives its leaf blocks: the text between two block-level
boundaries, with the tags and the class and id words of its ancestors. Every block gets
features of its ancestors (tag, words, cues inside words) and of its text (length, share of
link text, closing sign, position and so on). The field has two states, main and other,
weights per feature and state and per pair of neighbouring states; it is trained by the
likelihood of labelled pages and decoded by Viterbi. The main blocks' texts are joined in
page order.

The labelled pages are made by ``labelled_pages``: layouts drawn from a grammar of the usual
page parts under many names and nestings, filled with invented words, each block labelled.
The model has a few thousand numbers and is sent to the tasks; pages are not shuffled.

Defined cases: a null or empty page, and a page without main blocks, gives an empty text; pages cut off
anywhere are read as far as they go; very long pages are read whole; repeated rows are rows;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Container, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import slices

# HTML elements by how they are laid out.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre search section select summary table tbody td tfoot th thead tr ul caption".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("script style template noscript iframe object svg math head title canvas audio video textarea".split())
RAW_TAGS = frozenset("script style title textarea iframe noscript template svg math canvas audio video object".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
    "tfoot": {"tr", "td", "th", "tbody"}, "thead": {"tr", "td", "th"},
}
SCOPES = frozenset("table ul ol dl select body html div article section main aside nav header footer form".split())
CUES = (
    "nav menu foot head side ad advert banner promo sponsor comment reply respond disqus share social follow cookie "
    "consent notice alert popup modal overlay newsletter subscribe signup login search form related recommend "
    "popular trending breadcrumb crumb tag meta byline author date copyright legal widget pager pagination "
    "content article post entry story main body text page single blog hidden skip toolbar top bottom"
).split()

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>|<[!?/][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>\"']|$)", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@functools.lru_cache(maxsize=20_000)
def _ancestor_features(tag: str, attributes: str) -> tuple[bool, tuple[str, ...]]:
    """Whether the element is hidden, and its features as an ancestor."""
    hidden, words = tag in HIDDEN_TAGS, []
    for m in _NAMES.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = True
        elif name in ("class", "id", "role"):
            words += _WORD.findall(_CAMEL.sub(" ", value).lower())
    cues = {c for w in words for c in CUES if (w == c if len(c) < 4 else c in w)}
    return hidden, (f"in:{tag}", *(f"name:{w}" for w in sorted(set(words))), *(f"cue:{c}" for c in sorted(cues)))


@dataclass
class Block:
    text: str
    tag: str
    ancestors: tuple[str, ...]
    link_chars: int


def blocks(page: str, known: Container[str] | None = None) -> list[Block]:
    """Leaf blocks of a page in order, white space made single spaces, empty ones left out. Of the
    ancestors' features only those in ``known`` are kept, if given: a page may have any number."""
    out: list[Block] = []
    # tag, hidden, features with those above, nearest block tag
    stack: list[tuple[str, bool, tuple[str, ...], str]] = []
    opened: Counter[str] = Counter()
    unclosed: set[str] = set()  # raw tags that the rest of the page doesn't close
    text: list[str] = []
    links = 0
    in_link = 0

    def flush() -> None:
        nonlocal links
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                out.append(Block(joined, stack[-1][3] if stack else "", stack[-1][2] if stack else (), links))
            text.clear()
        links = 0

    def pop_to(index: int) -> None:
        nonlocal in_link
        for t, *_ in stack[index:]:
            in_link -= t == "a"
            opened[t] -= 1
        del stack[index:]

    def say(raw: str) -> None:
        nonlocal links
        if raw and not (stack and stack[-1][1]):
            seen = html.unescape(raw) if "&" in raw else raw
            text.append(seen)
            if in_link:
                links += len(seen)

    at = 0
    while True:
        m = _TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        tag, closing, attributes = name.lower(), m[1] or m[4], m[3] if m[2] else m[6]
        if closing:
            if tag in BLOCK_TAGS:
                flush()
            for i in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[i][0] == tag:
                    pop_to(i)
                    break
            continue
        if tag in RAW_TAGS and tag != "noscript" or tag == "noscript":
            end = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if not end:
                unclosed.add(tag)
            if tag in ("script", "style", "title", "textarea", "iframe") or end:
                at = end.end() if end else len(page)
                continue
        if tag == "br":
            say(" ")
        if tag in BLOCK_TAGS:
            flush()
            for i in range(len(stack) - 1, -1, -1) if opened["p"] else ():  # a new block closes an open paragraph
                if stack[i][0] == "p":
                    pop_to(i)
                    break
                if stack[i][0] in SCOPES:
                    break
            closes = CLOSES.get(tag, ())
            for i in range(len(stack) - 1, -1, -1) if any(opened[t] for t in closes) else ():
                if stack[i][0] in closes:
                    pop_to(i)
                    break
                if stack[i][0] in SCOPES:
                    break
            if tag == "body":  # whatever the head left open
                pop_to(next((i for i, s in enumerate(stack) if s[0] == "head"), len(stack)))
        if tag in VOID_TAGS or attributes.endswith("/") and tag not in BLOCK_TAGS:
            continue
        hidden, own = _ancestor_features(tag, attributes)
        above = stack[-1] if stack else ("", False, (), "")
        new = tuple(f for f in own if f not in above[2] and (known is None or f in known))
        stack.append((tag, hidden or above[1], above[2] + new, tag if tag in BLOCK_TAGS else above[3]))
        opened[tag] += 1
        in_link += tag == "a"
    flush()
    return out


def features(page: list[Block]) -> list[list[str]]:
    """Features of each block of a page."""
    out, many = [], len(page)
    for i, b in enumerate(page):
        words = b.text.split(" ")
        n, chars = len(words), len(b.text)
        density = b.link_chars / max(chars, 1)
        own = [
            "bias", f"tag:{b.tag}", f"words:{min(n, 200).bit_length()}", f"link:{0 if density == 0 else 1 if density < 0.5 else 2}",
            f"end:{'stop' if b.text[-1] in '.!?…。\"»”' else 'other'}", f"words:{min(n, 200).bit_length()}|tag:{b.tag}",
            f"link:{density > 0.5}|words:{min(n, 16).bit_length()}", f"place:{0 if i == 0 else 2 if i == many - 1 else 1}",
        ]
        if "©" in b.text or "&copy" in b.text:
            own.append("sign:copyright")
        if n <= 12:
            own += [f"word:{w}" for w in {w.strip(".,:;!?()").lower() for w in words}]
        out.append([*b.ancestors, *own])
    return out


@dataclass(frozen=True)
class Field:
    """Weights: per feature the score of ``main`` over ``other``; per pair of states."""

    weights: dict[str, float]
    step: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, page: list[Block]) -> list[bool]:
        """Viterbi: the likeliest states."""
        if not page:
            return []
        get, (s0, s1), back = self.weights.get, self.step, []
        other, main = 0.0, 0.0
        for i, fs in enumerate(features(page)):
            score = sum(get(f, 0.0) for f in fs)
            if i == 0:
                other, main = 0.0, score
                continue
            to_other, to_main = (other + s0[0], main + s1[0]), (other + s0[1], main + s1[1])
            back.append((to_other[1] > to_other[0], to_main[1] >= to_main[0]))
            other, main = max(to_other), max(to_main) + score
        state = main >= other
        states = [state]
        for was in reversed(back):
            state = was[state]
            states.append(state)
        return states[::-1]

    def main_text(self, page: str | None) -> str:
        found = blocks(page, self.weights) if page else []
        return "\n".join(b.text for b, keep in zip(found, self.decode(found)) if keep)


def fit(pages: list[tuple[list[Block], list[bool]]], rounds: int = 120, rate: float = 0.1, decay: float = 1e-3, least: int = 3) -> Field:
    """Maximum likelihood (with L2) by Adam; forward-backward runs over all pages at once."""
    fs = [[sorted(set(f)) for f in features(p)] for p, _ in pages]
    times: dict[str, int] = {}
    for page in fs:
        for block in page:
            for f in block:
                times[f] = times.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, n in times.items() if n >= least))}
    long = max(len(p) for p in fs)
    rows, cols = [], []
    there = np.zeros((len(fs), long), bool)
    gold = np.zeros((len(fs), long), np.int64)
    for i, (page, (_, labels)) in enumerate(zip(fs, pages)):
        there[i, : len(page)] = True
        gold[i, : len(page)] = labels
        for t, block in enumerate(page):
            known = [index[f] for f in block if f in index]
            rows += [i * long + t] * len(known)
            cols += known
    rows, cols = np.array(rows), np.array(cols)
    w, step = np.zeros(len(index)), np.zeros((2, 2))
    state = [np.zeros_like(x) for x in (w, w, step, step)]
    pair_there = there[:, 1:]
    gold_pairs = np.zeros((2, 2))
    np.add.at(gold_pairs, (gold[:, :-1][pair_there], gold[:, 1:][pair_there]), 1)
    blocks_total = there.sum()
    for k in range(1, rounds + 1):
        emit = np.zeros((len(fs), long, 2))
        emit[..., 1] = np.bincount(rows, weights=w[cols], minlength=len(fs) * long).reshape(len(fs), long)
        f, b = np.zeros_like(emit), np.zeros_like(emit)
        f[:, 0] = emit[:, 0]
        for t in range(1, long):
            new = emit[:, t] + np.logaddexp(f[:, t - 1, :1] + step[0], f[:, t - 1, 1:] + step[1])
            f[:, t] = np.where(there[:, t, None], new, f[:, t - 1])
        for t in range(long - 2, -1, -1):
            nxt = emit[:, t + 1] + b[:, t + 1]
            new = np.logaddexp(step[:, 0] + nxt[:, :1], step[:, 1] + nxt[:, 1:])
            b[:, t] = np.where(there[:, t + 1, None], new, 0.0)
        z = np.logaddexp(f[:, -1, 0], f[:, -1, 1])
        p_main = np.exp(f[..., 1] + b[..., 1] - z[:, None]) * there
        pairs = f[:, :-1, :, None] + step + (emit + b)[:, 1:, None, :] - z[:, None, None, None]
        expected = (np.exp(np.minimum(pairs, 0)) * pair_there[..., None, None]).sum((0, 1))
        g = np.bincount(cols, weights=(p_main - gold).reshape(-1)[rows], minlength=len(index)) / blocks_total + decay * w
        gs = (expected - gold_pairs) / blocks_total + decay * step
        for x, grad, m, v in ((w, g, 0, 1), (step, gs, 2, 3)):
            state[m] = 0.9 * state[m] + 0.1 * grad
            state[v] = 0.999 * state[v] + 0.001 * grad**2
            x -= rate * (state[m] / (1 - 0.9**k)) / (np.sqrt(state[v] / (1 - 0.999**k)) + 1e-8)
    return Field({f: float(w[i]) for f, i in index.items()}, tuple(map(tuple, step.tolist())))


# ---- labelled pages ---------------------------------------------------------------

_MAIN = "\ue000"  # begins the text of a block that belongs to the article

_SMALL = {
    "nav": "Home About Contact News Sports Archive Products Services Blog Help Shop Start Kontakt Accueil Inicio".split(),
    "footer": ["Copyright 2020", "© 2021 All rights reserved.", "Privacy Policy", "Terms of Use", "Impressum", "Powered by", "© example.org · Contact"],
    "notice": ["We use cookies to improve your experience.", "This site uses cookies.", "Accept", "Please enable JavaScript.", "Your browser is outdated."],
    "form": ["Search", "Subscribe to our newsletter", "Sign in", "Email address", "Submit", "Password", "Send", "Log in"],
    "share": ["Share on Facebook", "Tweet", "Print", "Email this", "Follow us", "Share"],
    "crumbs": ["Home", "»", "You are here:", "Category", "/"],
}


class _Writer:
    """Pages of a random layout; the same seed gives the same pages."""

    def __init__(self, seed: int):
        self.r = np.random.default_rng(seed)

    def pick(self, *items):
        return items[int(self.r.integers(len(items)))]

    def chance(self, p: float) -> bool:
        return bool(self.r.random() < p)

    def word(self) -> str:
        return "".join(self.pick("an", "er", "the", "in", "on", "re", "ti", "es", "or", "ea", "st", "qu", "lo", "mi", "ü", "é", "sch", "ción") for _ in range(int(self.r.integers(1, 4))))

    def sentence(self, lo: int = 3, hi: int = 22) -> str:
        words = [self.word() for _ in range(int(self.r.integers(lo, hi)))]
        if self.chance(0.08):
            words = [w + self.pick("%%%", "###", "***", "&amp;", " |") for w in words]
        return (" ".join(words)).capitalize() + self.pick(".", ".", ".", "!", "?", "")

    def prose(self, most: int = 7) -> str:
        return " ".join(self.sentence() for _ in range(int(self.r.integers(1, most))))

    def attr(self, *names: str) -> str:
        name = self.pick(*names)
        if self.chance(0.15):
            name = self.pick("site-", "page-", "js-", "c-", "wp-", "block-", "") + name + self.pick("", "-wrap", "-box", "-inner", "1")
        return self.pick(f' class="{name}"', f" id='{name}'", f' class="{name} {self.pick("clearfix", "row", "col-md-8", "x1")}"', f" class={name}")

    def wrap(self, tags: tuple[str, ...], names: tuple[str, ...], inner: str) -> str:
        tag = self.pick(*tags)
        attr = self.attr(*names) if names and (tag in ("div", "section", "ul", "td", "p", "span") or self.chance(0.4)) else ""
        return f"<{tag}{attr}>{inner}</{tag}>"

    def links(self, texts: list[str]) -> str:
        if self.chance(0.7):
            return "<ul>" + "".join(f'<li><a href="/{i}">{t}</a></li>' for i, t in enumerate(texts)) + "</ul>"
        return self.pick(" | ", " ", "<br>").join(f'<a href="/{i}">{t}</a>' for i, t in enumerate(texts))

    def some(self, kind: str) -> list[str]:
        n = int(self.r.integers(1, 7))
        return [self.pick(*_SMALL[kind]) if self.chance(0.5) else self.sentence(1, 4) for _ in range(n)]

    def para(self, tag: str, text: str) -> str:
        if self.chance(0.15):
            text = text.replace(" ", f" <{(t := self.pick('b', 'em', 'i', 'strong'))}>", 1) + (f"</{t}>" if self.chance(0.8) else "")
        if self.chance(0.1):
            text += f' <a href="/x">{self.sentence(1, 4)}</a>' + self.pick("", " " + self.sentence())
        if self.chance(0.05):
            return f"<{tag}><b>{_MAIN}{text}<br>"
        return f"<{tag}>{_MAIN}{text}" + ("" if tag in ("p", "li") and self.chance(0.08) else f"</{tag}>")

    def article(self) -> str:
        parts = [f"<h1>{_MAIN}{self.sentence(2, 10)}</h1>"] if self.chance(0.85) else []
        if parts and self.chance(0.2):
            parts = [f"<header>{parts[0]}</header>"]
        for _ in range(int(self.r.integers(1, 12))):
            kind = self.r.random()
            if kind < 0.66:
                parts.append(self.para("p", self.pick(self.prose(), self.prose(), self.sentence(1, 3))))
            elif kind < 0.76:
                parts.append(self.para(self.pick("h2", "h3", "h4"), self.sentence(1, 7)))
            elif kind < 0.83:
                tag = self.pick("ul", "ol")
                parts.append(f"<{tag}>" + "".join(self.para("li", self.sentence(1, 14)) for _ in range(int(self.r.integers(1, 6)))) + f"</{tag}>")
            elif kind < 0.87:
                parts.append(f"<blockquote>{self.para('p', self.prose(3))}</blockquote>" if self.chance(0.5) else self.para("blockquote", self.prose(3)))
            elif kind < 0.9:
                parts.append(self.para("pre", self.sentence()))
            elif kind < 0.93:
                parts.append("<table>" + "".join("<tr>" + "".join(self.para("td", self.sentence(1, 4)) for _ in range(3)) + "</tr>" for _ in range(3)) + "</table>")
            elif kind < 0.96:
                parts.append(f"<figure><img src='a.png'>{self.para('figcaption', self.sentence(2, 9))}</figure>")
            else:
                parts.append(self.inside())
        return "\n".join(parts) if self.chance(0.5) else "".join(parts)

    def inside(self) -> str:
        return self.pick(self.advert, self.share, self.form, self.related, self.notice)()

    def menu(self) -> str:
        return self.wrap(("nav", "nav", "div", "ul"), ("nav", "menu", "navbar", "main-menu", "navigation", "topnav"), self.links(self.some("nav")))

    def header(self) -> str:
        inner = self.wrap(("div", "p", "span", "a", "h2"), ("logo", "brand", "site-title", "tagline"), self.sentence(1, 5))
        return self.wrap(("header", "div"), ("header", "masthead", "top", "page-head", "banner"), inner + (self.menu() if self.chance(0.5) else "") + (self.form() if self.chance(0.2) else ""))

    def footer(self) -> str:
        inner = "".join(self.pick(f"<p>{t}</p>", t, f"<div>{t}</div>", f"&copy; {t} &middot; {self.sentence(2, 12)}") for t in self.some("footer"))
        return self.wrap(("footer", "footer", "div"), ("footer", "foot", "copyright", "colophon", "legal", "bottom"), inner + (self.links(self.some("nav")) if self.chance(0.3) else ""))

    def sidebar(self) -> str:
        inner = "".join(f"<h3>{self.sentence(1, 4)}</h3>" + self.pick(self.links([self.sentence(2, 8) for _ in range(4)]), f"<p>{self.prose(3)}</p>") for _ in range(int(self.r.integers(1, 4))))
        return self.wrap(("aside", "div"), ("sidebar", "side", "widget", "widget-area", "secondary", "rightcol"), inner)

    def advert(self) -> str:
        return self.wrap(("div", "aside", "section", "p"), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "adsbygoogle"), self.pick(self.sentence(), self.prose(3), f"<p>{self.sentence()}</p>", f'<a href="/buy">{self.sentence()}</a>'))

    def notice(self) -> str:
        text = self.pick(*_SMALL["notice"]) if self.chance(0.6) else self.sentence()
        return self.wrap(("div", "section", "p", "aside"), ("cookie", "cookie-notice", "notice", "alert", "consent", "gdpr", "popup", "modal", "overlay"), self.pick(text, f"<p>{text}</p><button>{self.pick('OK', 'Accept', self.sentence(1, 3))}</button>"))

    def form(self) -> str:
        t = self.some("form")
        inner = "".join(self.pick(f"<label>{x}</label><input name=a>", f"<button>{x}</button>", f"<p>{x}</p>", f"<select><option>{x}<option>{self.word()}</select>") for x in t)
        return f"<form{self.attr('search', 'newsletter', 'subscribe', 'login', 'contact') if self.chance(0.6) else ''}>{inner}</form>"

    def share(self) -> str:
        return self.wrap(("div", "ul"), ("share", "social", "share-buttons", "follow", "tools", "sharing"), self.links(self.some("share")))

    def related(self) -> str:
        return self.wrap(("aside", "section", "div"), ("related", "recommended", "more-stories", "popular", "trending", "read-next"), f"<h3>{self.sentence(1, 4)}</h3>" + self.links([self.sentence(3, 9) for _ in range(int(self.r.integers(2, 6)))]))

    def crumbs(self) -> str:
        return self.wrap(("div", "ol", "nav", "p"), ("breadcrumb", "breadcrumbs", "crumbs", "path"), self.pick(" &raquo; ", " / ", " &gt; ").join(f'<a href="/">{t}</a>' for t in self.some("crumbs")))

    def comments(self) -> str:
        one = lambda: self.wrap(("div", "li", "article", "section"), ("comment", "comment-body", "reply", "user-comment", "post-comment"), self.pick(f"<p>{self.prose(4)}</p>", self.prose(3), f"<b>{self.word()}</b> <span>{self.word()}</span><p>{self.prose(4)}</p><a href='#'>Reply</a>"))
        inner = f"<h3>{self.pick('Comments', 'Leave a reply', '3 comments', 'Kommentare', self.sentence(1, 3))}</h3>" * self.chance(0.6) + "".join(one() for _ in range(int(self.r.integers(1, 5))))
        return self.wrap(("section", "div", "ol"), ("comments", "comment-list", "disqus_thread", "responses", "reader-comments", "discussion"), inner + (self.form() if self.chance(0.4) else ""))

    def page(self) -> str:
        body = self.article()
        if self.chance(0.15):
            body += self.comments()
        kind = self.r.random()
        if kind < 0.5:
            core = f"<article{self.attr('post', 'article', 'entry', 'hentry', 'story') if self.chance(0.4) else ''}>{body}</article>"
        elif kind < 0.85:
            core = self.wrap(("div", "section"), ("content", "article-body", "entry-content", "post-content", "post", "story", "main-text", "body-copy", "article", "text", "page-content"), body)
        else:
            core = body
        if self.chance(0.35):
            core = self.pick(f"<main>{core}</main>", f'<div id="main">{core}</div>', f"<section>{core}</section>", f'<div class="container"><div class="row">{core}</div></div>', f"<table><tr><td>{core}</td></tr></table>")
        before = [p() for p in (self.notice, self.header, self.menu, self.crumbs, self.advert, self.form, self.sidebar) if self.chance(0.35)]
        after = [p() for p in (self.share, self.related, self.comments, self.sidebar, self.advert, self.form, self.footer, self.footer, self.notice) if self.chance(0.35)]
        title = self.sentence(2, 8)
        head = f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{title}</title><style>p{{}}</style><script>var a='<p>';</script></head>"
        end = "</body></html>" if self.chance(0.9) else ""
        return f"{head}<body{self.attr('home', 'single', 'page', 'post') if self.chance(0.3) else ''}>{''.join(before)}<!-- x -->{core}{''.join(after)}{end}"


def labelled_pages(many: int = 700, seed: int = 11) -> list[tuple[list[Block], list[bool]]]:
    """Blocks of generated pages with their labels (main or not)."""
    writer, out = _Writer(seed), []
    while len(out) < many:
        found = blocks(writer.page())
        labels = [_MAIN in b.text for b in found]
        for b in found:
            b.text = b.text.replace(_MAIN, "")
        kept = [(b, y) for b, y in zip(found, labels) if b.text]
        if kept:
            out.append(([b for b, _ in kept], [y for _, y in kept]))
    return out


@functools.lru_cache(maxsize=1)
def trained() -> Field:
    return fit(labelled_pages())


def extract(spark: SparkSession, pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text (main text; empty if none)."""
    sent = spark.sparkContext.broadcast(field or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for b in slices(batches, "html"):
            texts = [model.main_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return source.mapInArrow(run, "page_id long, url string, text string")
