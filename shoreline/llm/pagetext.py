"""Main text of web pages: a conditional random field over the leaf blocks of the page.

The page is walked once. Text between the borders of block-level elements is a leaf block; it
carries what its ancestors are (by tag, class, id and role) and what its text looks like. A linear
chain with two labels, trained on labelled pages, decodes a page's blocks with Viterbi, and the
blocks labelled as main text are joined.

The labelled pages are built here, by a seeded generator: pages of different make (semantic tags,
named containers, nameless ones) whose parts are known to be article, menu, header, footer,
sidebar, notice, advert, form, share links or reader comments. ``train`` takes any labelled pages.

Character references are decoded, white space inside a block becomes one blank, and blocks without
text vanish. Scripts, styles, comments, templates and the head hold no text. Broken markup is read
as browsers do, roughly: unclosed elements end with what contains them, stray end tags are skipped.
NULL and empty pages have empty text. Repeated rows and NULL ids are treated row by row; other
columns are ignored.
"""

from __future__ import annotations

import html as references
import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.llm import crf, text
from shoreline.llm.common import in_batches

# Elements by their part in a page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# MathML is text of its sentence.
INLINE |= frozenset(
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover "
    "munderover mmultiscripts mprescripts mtable mtr mtd menclose semantics none".split()
)
# Elements whose content is no markup: it ends at the first end tag.
RAW = frozenset("script style title textarea noembed noframes iframe".split())
# Elements left out with all that is in them, elements of their own kind included. Where the end tag is missing only
# the tag is left out, and what follows is read on.
SKIPPED = frozenset("template svg object video audio canvas annotation annotation-xml".split())
# Of both, those that stand in a line of text without ending it.
WITHIN = frozenset("script style template svg annotation annotation-xml".split())
FOREIGN = frozenset(("svg", "math"))  # may close themselves
ENDS_SAME = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table tbody body article section div form select menu td th blockquote".split())
# Kinds of ancestors, by tags and by words in class, id and role.
KINDS = {
    "menu": ("nav menu", r"nav\w*|menus?|breadcrumbs?|pagination|pager|toc|tabs?|toolbar|skip"),
    "header": ("header", r"header|masthead|topbar|logo|branding|site title|tagline"),
    "footer": ("footer address", r"footer|foot|bottom|copyright|colophon|legal|contentinfo"),
    "sidebar": ("aside", r"side|sidebar\w*|aside|rail|widgets?|complementary|archives?|tag ?cloud|blogroll"),
    "related": ("", r"related|recommend\w*|popular|trending|more ?stories|also|teasers?|outbrain|taboola|latest"),
    "advert": ("ins", r"ads?|advert\w*|adsbygoogle|sponsor\w*|promos?|promotion\w*|banner|dfp|affiliate|commercial"),
    "notice": ("noscript dialog", r"cookies?|consent|gdpr|notices?|notifications?|alerts?|popups?|modal|overlay|toast|newsletter|subscri\w*|paywall|disclaimer|warning|announcement|message"),
    "form": ("form fieldset select button label", r"forms?|search\w*|login|signin|signup|register|contact|poll|survey"),
    "comment": ("", r"comments?|comment\w*|disqus\w*|repl(?:y|ies)|respond|discussion|reviews?|feedback|readers?|guestbook|responses?"),
    "share": ("", r"shar(?:e|ing)\w*|social\w*|follow|tweet|facebook|like"),
    "meta": ("", r"meta|byline|author|dateline|timestamp|posted|credits?"),
    "hidden": ("", r"hidden|invisible|sr only|screen reader text"),
    "article": ("article", r"articles?|story|post|entry|h ?entry|hentry"),
    "main": ("main", r"main|content|body|text|prose|entry content|article body|page content"),
    "section": ("section", r"(?!)"),
    "table": ("table", r"(?!)"),
    "list": ("ul ol dl", r"(?!)"),
    "figure": ("figure", r"captions?|figure"),
    "quote": ("blockquote pre", r"(?!)"),
}
OWN = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "dt", "dd", "blockquote", "pre", "figcaption", "div", "section", "article", "body")
PHRASES = (
    r"©|copyright|all rights reserved",
    r"cookies?|consent",
    r"newsletter|subscribe|sign up|unsubscribe",
    r"log ?in|sign in|register|password",
    r"advertisement|sponsored|promoted|buy now|% off",
    r"repl(?:y|ies)|says:|wrote:|commented|leave a comment|posted by",
    r"share (?:this|on)|tweet|facebook|follow us",
    r"read more|continue reading|learn more|click here|see also|more from",
    r"privacy|terms of (?:use|service)|imprint|contact us",
)

PHRASE_EVERY = 400

_BY_TAG: dict[str, int] = {}
for _n, (_tags, _) in enumerate(KINDS.values()):
    for _tag in _tags.split():
        _BY_TAG[_tag] = _BY_TAG.get(_tag, 0) | 1 << _n
_WORDS = [re.compile(rf"\b(?:{words})\b") for _, words in KINDS.values()]
_PHRASES = [re.compile(p) for p in PHRASES]
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_REST = re.compile(r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_UNSEEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_JOINED = re.compile(r"[-_:./]+|(?<=[a-z])(?=[A-Z])")
_HIDDEN = 1 << list(KINDS).index("hidden")


@cache
def _kinds(tag: str, named: str) -> int:
    kinds = _BY_TAG.get(tag, 0)
    if named:
        words = _JOINED.sub(" ", named).lower()
        for n, pattern in enumerate(_WORDS):
            if pattern.search(words):
                kinds |= 1 << n
    return kinds


def _dense(phrase: re.Pattern, text: str) -> bool:
    """Whether a text holds the phrase, and a long one as often as once in so many characters."""
    if not phrase.search(text):
        return False
    return len(text) < PHRASE_EVERY or len(phrase.findall(text)) * PHRASE_EVERY >= len(text)


class Block:
    __slots__ = ("text", "kinds", "own", "linked", "container")

    def __init__(self, text: str, kinds: int, own: str, linked: int, container: int):
        self.text, self.kinds, self.own, self.linked, self.container = text, kinds, own, linked, container


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page that have text, in page order."""
    out: list[Block] = []
    # open elements as (tag, kinds of it and its ancestors, number of the nearest container)
    stack: list[tuple[str, int, int]] = [("body", 0, 0)]
    held: list[str] = []
    linked = links = containers = 0
    ends: dict[str, dict[int, int]] = {}
    at, size = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if held:
            raw = "".join(held)
            held.clear()
            whole = " ".join((references.unescape(raw) if "&" in raw else raw).split())
            if whole:
                _, kinds, container = stack[-1]
                own = next((tag for tag, _, _ in reversed(stack) if tag not in INLINE), "body")
                out.append(Block(whole, kinds, own, linked, container))
        linked = 0

    def close(place: int) -> None:
        nonlocal links
        for tag, _, _ in stack[place:]:
            links -= tag == "a"
        del stack[place:]

    while at < size:
        opened = page.find("<", at)
        if opened < 0:
            opened = size
        if opened > at:
            held.append(page[at:opened])
            if links:
                linked += opened - at
        if opened >= size:
            break
        after = page[opened + 1 : opened + 2]
        if after == "!" or after == "?":
            comment = page.startswith("!--", opened + 1)
            end = page.find("-->" if comment else ">", opened + (4 if comment else 1))
            at = size if end < 0 else end + (3 if comment else 1)
            continue
        ending = after == "/"
        name = _NAME.match(page, opened + 1 + ending)
        if not name:
            if ending:
                end = page.find(">", opened)
                at = size if end < 0 else end + 1
            else:
                held.append("<")
                at = opened + 1
            continue
        rest = _REST.match(page, name.end())
        if rest:
            at = rest.end()
        else:
            end = page.find(">", name.end())
            at = size if end < 0 else end + 1
        tag = name[0].lower()
        if ending:
            if tag not in INLINE:
                flush()
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if place:
                close(place)
            continue
        if tag in RAW or tag in SKIPPED:
            if tag not in WITHIN:
                flush()
            if tag in RAW:
                end = _end_of(tag).search(page, at)
                at = size if not end else end.end()
            elif not (tag in FOREIGN and page[at - 2 : at] == "/>"):
                if tag not in ends:
                    ends[tag] = _ends_of(page, tag)
                at = ends[tag].get(opened, at)
            continue
        if tag in FOREIGN and page[at - 2 : at] == "/>":
            continue
        if tag == "br" or tag == "hr":
            held.append(" ")
        if tag not in INLINE:
            flush()
            closes = ENDS_SAME.get(tag) or ("p",)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in closes:
                    close(i)
                    break
                if stack[i][0] in SCOPES:
                    break
        if tag in VOID:
            continue
        attributes = page[name.end() : at]
        named = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes)) if "=" in attributes else ""
        kinds = _kinds(tag, named) | stack[-1][1]
        if attributes.strip("/> ") and _UNSEEN.search(attributes):
            kinds |= _HIDDEN
        container = stack[-1][2]
        if tag not in INLINE and tag not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li"):
            containers += 1
            container = containers
        stack.append((tag, kinds, container))
        links += tag == "a"
    flush()
    return out


def _ends_of(page: str, tag: str) -> dict[int, int]:
    """Where the elements of a kind end, by where they start; those that do not end are not there."""
    opened: list[int] = []
    ends = {}
    for found in _tags_of(tag).finditer(page):
        if found[1]:
            if opened:
                ends[opened.pop()] = found.end()
        elif not (tag in FOREIGN and found[0].endswith("/>")):
            opened.append(found.start())
    return ends


@cache
def _tags_of(tag: str) -> re.Pattern:
    return re.compile(rf"<(/?){tag}(?![^\s/>])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>", re.I)


@cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\b[^>]*>", re.I)


def features(found: list[list[Block]]) -> np.ndarray:
    """One row of truth values for every block of every page."""
    flat = [b for page in found for b in page]
    lengths = np.array([len(p) for p in found], np.int64)
    n = len(flat)
    if not n:
        return np.zeros((0, 1))
    page = np.repeat(np.arange(len(found)), lengths)
    place = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    laid = text.Laid([b.text for b in flat])
    starts, _ = laid.words()
    words = np.bincount(laid.owner(starts), minlength=n)
    chars = laid.ends - laid.starts
    letters = np.maximum(laid.count(text.table("letter")[laid.codes], laid.starts, laid.ends), 1)
    upper = laid.count(text.table("upper")[laid.codes], laid.starts, laid.ends) / letters
    digits = laid.count(text.table("digit")[laid.codes], laid.starts, laid.ends) / chars
    kinds = np.array([b.kinds for b in flat], np.int64)
    linked = np.array([b.linked for b in flat]) / chars
    own = np.array([OWN.index(b.own) if b.own in OWN else -1 for b in flat])
    containers = np.array([b.container for b in flat], np.int64)
    key = page * (containers.max(initial=0) + 1) + containers
    _, box = np.unique(key, return_inverse=True)
    in_box = np.bincount(box, weights=words * (linked < 0.5))
    largest = np.zeros(len(found))
    np.maximum.at(largest, page, in_box[box])
    title = np.cumsum(own == OWN.index("h1"))
    before = np.where(np.cumsum(lengths) - lengths > 0, title[np.maximum(np.cumsum(lengths) - lengths - 1, 0)], 0)
    lowered = [b.text.lower() for b in flat]
    last = laid.codes[laid.ends - 1]
    relative = place / np.maximum(lengths[page], 1)
    columns = [
        np.ones(n, bool),
        *((kinds >> k) & 1 for k in range(len(KINDS))),
        *(own == k for k in range(-1, len(OWN))),
        *(words >= limit for limit in (2, 4, 8, 15, 30, 60)),
        *(linked >= limit for limit in (0.2, 0.5, 0.9)),
        *(upper >= limit for limit in (0.3, 0.8)),
        digits >= 0.2,
        np.isin(last, [ord(c) for c in ".!?…\"”»"]),
        laid.count(text.only(",;")[laid.codes], laid.starts, laid.ends) > 0,
        *(np.array([_dense(p, t) for t in lowered]) for p in _PHRASES),
        place == 0,
        relative < 0.2,
        relative > 0.8,
        title > before[page],
        in_box[box] >= largest[page],
    ]
    return np.stack(columns, 1).astype(np.float64)


def train(pages: list[tuple[str, list[int]]]) -> crf.Chain:
    """``pages`` are HTML with one label per block with text: 0 for main text, 1 for the rest."""
    found = [blocks(page) for page, _ in pages]
    lengths = np.array([len(b) for b in found], np.int64)
    labels = np.array([label for _, marked in pages for label in marked], np.int8)
    if len(labels) != lengths.sum():
        raise ValueError("every block needs a label")
    return crf.fit(features(found), labels, lengths, rounds=300, decay=3e-5)


def labelled_pages(many: int = 400, seed: int = 7) -> list[tuple[str, list[int]]]:
    """Pages whose every block's label is known."""
    rng = random.Random(seed)
    return [_Page(rng).built() for _ in range(many)]


class _Page:
    """One random page. ``add`` writes a piece of HTML and the label of the block in it."""

    PHRASED = ("All rights reserved.", "Copyright {}", "{}: all the cookies.", "Log in to {}.", "Contact us: {}", "Share this: {}", "Read more {}", "{} says: reply.", "Released under the MIT License.")
    SYLLABLES = "an ber cho de en fi gra hu in jo ka li mo nu or pe que ri sta tu un ve wo xa yo zi schen tion ment ado".split()

    def __init__(self, rng: random.Random):
        self.rng, self.parts, self.labels = rng, [], []

    def word(self) -> str:
        return "".join(self.rng.choice(self.SYLLABLES) for _ in range(self.rng.randint(1, 4)))

    def words(self, least: int, most: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(least, most))).capitalize()

    def prose(self, least: int = 1, most: int = 5) -> str:
        return " ".join(
            f"{self.words(2, 9)}, {self.words(1, 9).lower()}{self.rng.choice('...!?')}" if self.rng.random() < 0.5
            else f"{self.words(1, 16)}{self.rng.choice('...!?')}"
            for _ in range(self.rng.randint(least, most))
        )

    def add(self, opening: str, closing: str, body: str, label: int) -> None:
        self.parts.append(f"{opening}{body}{closing}")
        self.labels.append(label)

    def pair(self, *elements: str) -> tuple[str, str]:
        """Start and end tag of one of the elements; of none for the empty name."""
        element = self.rng.choice(elements)
        return (f"<{element}>", f"</{element.split()[0]}>") if element else ("", "")

    def box(self, tag: str, names: str, inner) -> None:
        """A container, by its own tag, by a telling name, or nameless."""
        how = self.rng.random()
        if tag and how < 0.4:
            opening, closing = f"<{tag}>", f"</{tag}>"
        elif how < 0.95:
            attribute = self.rng.choice(["class", "class", "id"])
            opening, closing = f'<div {attribute}="{self.rng.choice(names.split())}">', "</div>"
        else:
            opening, closing = f'<div class="{self.word()}">', "</div>"
        self.parts.append(opening)
        inner()
        self.parts.append(closing)

    def links(self, least: int = 3, most: int = 9) -> None:
        kind = self.rng.choice(["li", "li", "span", "div"])
        many = self.rng.randint(least, most)
        anchors = [f'<a href="/{self.word()}">{self.words(1, 4)}</a>' for _ in range(many)]
        if kind == "span":
            self.add("<p>", "</p>", " | ".join(anchors), 1)
            return
        self.parts.append("<ul>" if kind == "li" else "")
        for anchor in anchors:
            self.add(f"<{kind}>", f"</{kind}>", anchor, 1)
        self.parts.append("</ul>" if kind == "li" else "")

    def menu(self) -> None:
        self.box("nav", "menu navbar main-nav navigation breadcrumbs topnav", self.links)

    def header(self) -> None:
        def inner() -> None:
            self.add(*self.pair('div class="logo"', "p", "h2"), self.words(1, 4), 1)
            if self.rng.random() < 0.6:
                self.add("<p>", "</p>", self.prose(1, 1), 1)
            if self.rng.random() < 0.5:
                self.links(2, 5)

        self.box("header", "header masthead site-header topbar", inner)

    def sidebar(self) -> None:
        def inner() -> None:
            for _ in range(self.rng.randint(1, 2)):
                self.add("<h3>", "</h3>", self.words(1, 3), 1)
                if self.rng.random() < 0.6:
                    self.links()
                else:
                    self.add("<p>", "</p>", self.prose(1, 4), 1)

        self.box("aside", "sidebar widget side-column right-rail related recommended popular-posts", inner)

    def notice(self) -> None:
        says = [
            "We use cookies to improve this site. By going on you consent.",
            "Subscribe to our newsletter and never miss a story.",
            "You have 2 free articles left this month. Log in to read more.",
            self.prose(1, 3),
            self.prose(1, 2),
        ]
        self.box("", "cookie-notice notice alert consent-banner paywall newsletter popup modal site-message", lambda: self.add(*self.pair("p", ""), self.rng.choice(says), 1))

    def advert(self) -> None:
        def inner() -> None:
            if self.rng.random() < 0.3:
                self.add("<span>", "</span><p></p>", "Advertisement", 1)
            self.add(*self.pair("", "p", "div"), self.prose(1, 3), 1)

        opening = self.rng.choice(["ad", "ads", "advert", "advertisement", "ad-slot", "sponsored", "promo", "promotion", "banner-ad"])
        self.parts.append(f'<div class="{opening}">')
        inner()
        self.parts.append("</div>")

    def form(self) -> None:
        def inner() -> None:
            self.add("<p>", "</p>", self.rng.choice([self.prose(1, 1), "Sign up with your e-mail address", "Search this site"]), 1)
            self.add("<div>", "</div>", f"<label>{self.words(1, 2)}</label><input name=q>", 1)
            self.parts.append("<textarea>not text</textarea>")
            self.add("<div>", "</div>", f"<button>{self.rng.choice(['Send', 'Search', 'Sign up'])}</button>", 1)

        if self.rng.random() < 0.7:
            self.parts.append("<form action=/x>")
            inner()
            self.parts.append("</form>")
        else:
            self.box("", "search-form login signup contact-form", inner)

    def share(self) -> None:
        self.box("", "share social sharing share-buttons follow-us", lambda: self.add("<p>", "</p>", self.rng.choice(["Share this", "<a href=#>Tweet</a> <a href=#>Share</a>", "Follow us"]), 1))

    def comments(self) -> None:
        def inner() -> None:
            if self.rng.random() < 0.7:
                self.add("<h3>", "</h3>", self.rng.choice([f"{self.rng.randint(2, 90)} Comments", "Comments", "Discussion", self.words(1, 2)]), 1)
            for _ in range(self.rng.randint(1, 5)):
                opening = self.rng.choice(['<div class="comment">'] * 3 + ["<li>", "<article>", '<div class="comment-body">', "<div>"])
                self.parts.append(opening)
                if self.rng.random() < 0.7:
                    self.add("<p>", "</p>", self.rng.choice([f"{self.words(1, 2)} says:", f"{self.words(1, 2)}, {self.rng.randint(1, 28)} May", self.words(1, 2)]), 1)
                for _ in range(self.rng.randint(1, 2)):
                    self.add("<p>", "</p>", self.prose(1, 5), 1)
                if self.rng.random() < 0.4:
                    self.add("<div>", "</div>", "<a href=#>Reply</a>", 1)
                self.parts.append({"<li>": "</li>", "<article>": "</article>"}.get(opening, "</div>"))

        tag = self.rng.choice(["section", "div", "ol"])
        name = self.rng.choice(["comments", "comment-list", "comments-area", "reader-comments", "disqus_thread", "discussion", "responses"])
        self.parts.append(f'<{tag} {self.rng.choice(["id", "class"])}="{name}">')
        inner()
        self.parts.append(f"</{tag}>")

    def footer(self) -> None:
        def inner() -> None:
            self.add(*self.pair("p", "p", "", "small"), self.rng.choice([f"&copy; {self.word()}.example &middot; {self.prose(1, 1)}", "All rights reserved.", self.prose(1, 2)]), 1)
            if self.rng.random() < 0.5:
                self.links(2, 6)

        self.box("footer", "footer site-footer page-foot copyright bottom", inner)

    def content(self) -> None:
        """The article, at times with foreign parts between its blocks."""
        rng = self.rng
        if rng.random() < 0.8:
            self.add("<h1>", "</h1>", self.words(2, 12), 0)
        for _ in range(rng.choice([1, 1, 2, 3, rng.randint(1, 14), rng.randint(4, 14)])):
            kind = rng.random()
            if kind < 0.04:  # articles, too, use the words of notices
                self.add(*self.pair("p", "p", "div"), rng.choice(self.PHRASED).format(self.words(1, 5)), 0)
            elif kind < 0.68:
                opening, closing = self.pair("p", "p", "p", "div")
                if opening == "<p>" and rng.random() < 0.3:  # authors forget end tags
                    opening, closing = rng.choice([("<p>", ""), ("<p><b>", "<br>")])
                self.add(opening, closing, self.prose(), 0)
            elif kind < 0.75:
                self.add("<h2>", "</h2>", self.words(1, 7), 0)
            elif kind < 0.81:
                self.parts.append("<ul>")
                for _ in range(rng.randint(2, 4)):
                    self.add("<li>", "</li>", self.prose(1, 1) if rng.random() < 0.6 else self.words(1, 6), 0)
                self.parts.append("</ul>")
            elif kind < 0.84:
                self.add("<blockquote>", "</blockquote>", self.prose(1, 3), 0)
            elif kind < 0.87:
                self.add("<p>", "</p>", f"{self.prose(1, 2)} <a href=/x>{self.words(1, 3)}</a> {self.prose(1, 2)}", 0)
            elif kind < 0.89:
                self.parts.append("<table>")
                for _ in range(2):
                    self.parts.append("<tr>")
                    for _ in range(2):
                        self.add("<td>", "</td>", self.words(1, 4), 0)
                    self.parts.append("</tr>")
                self.parts.append("</table>")
            else:
                rng.choice([self.advert, self.advert, self.share, self.notice, self.form, self.sidebar])()

    def built(self) -> tuple[str, list[int]]:
        rng = self.rng
        head = '<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>var t="</p>";</script></head><body>'
        self.parts.append(head)
        for part, chance in ((self.notice, 0.25), (self.header, 0.5), (self.menu, 0.8), (self.advert, 0.4), (self.form, 0.2), (self.sidebar, 0.2)):
            if rng.random() < chance:
                part()
        opening, closing = rng.choice(
            [
                *[("<article>", "</article>")] * 5,
                *[("<main>", "</main>"), ("<main><article>", "</article></main>")] * 2,
                ('<div class="content">', "</div>"), ('<div id="main"><div class="post">', "</div></div>"),
                ('<div class="entry-content">', "</div>"), ('<div class="article-body">', "</div>"),
                (f'<div class="{self.word()}">', "</div>"), ("<div>", "</div>"), ("<section>", "</section>"), ("", ""),
            ]
        )
        self.parts.append(opening)
        self.content()
        inside = rng.random() < 0.3
        if inside and rng.random() < 0.5:
            self.comments()
        self.parts.append(closing)
        for part, chance in ((self.share, 0.3), (self.sidebar, 0.4), (self.advert, 0.3), (self.form, 0.2), (self.comments, 0.0 if inside else 0.5), (self.footer, 0.85), (self.notice, 0.15)):
            if rng.random() < chance:
                part()
        self.parts.append(rng.choice(["</body></html>", ""]))
        return "".join(self.parts), self.labels


@cache
def default_model() -> crf.Chain:
    return train(labelled_pages())


def main_texts(pages: list[str], model: crf.Chain) -> list[str]:
    found = [blocks(page) for page in pages]
    lengths = np.array([len(b) for b in found], np.int64)
    if not lengths.sum():
        return [""] * len(pages)
    kept = np.split(model.decode(features(found), lengths) == 0, np.cumsum(lengths)[:-1])
    return ["\n".join(b.text for b, k in zip(page, mine, strict=True) if k) for page, mine in zip(found, kept, strict=True)]


def extract(pages: DataFrame, model: crf.Chain | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    model = model or default_model()
    weights, steps = model.weights, model.steps

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = crf.Chain(weights, steps)
        for batch in batches:
            sources = [s or "" for s in batch.column("html").to_pylist()]
            texts: list[str] = []
            for start, stop in text.chunks(sources):
                texts += main_texts(sources[start:stop], chain)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    columns = [F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")]
    return in_batches(pages.select(*columns), work, "page_id long, url string, text string, n_chars long")
