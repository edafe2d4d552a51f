"""Reading HTML as a flat list of text blocks (one pass, no tree)."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# fixed values: HTML element names by role
DROPPED = "script|style|noscript|template|iframe|textarea|title|svg|select|object|canvas|audio|video|datalist"
INLINE = frozenset(
    {
        "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font",
        "i", "img", "ins", "kbd", "label", "map", "mark", "math", "meter", "output", "progress", "q", "rp",
        "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
        "wbr", "input",
    }
)
VOID = frozenset(
    {
        "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track",
        "wbr",
    }
)
BOILER_TAGS = frozenset(
    {
        "footer", "aside", "form", "dialog", "button", "fieldset",
    }
)
UNCLOSED = frozenset(
    {
        "p", "li", "tr", "td", "th", "dt", "dd", "option",
    }
)
HEADER_TAGS = frozenset(["header"])
CONTENT_TAGS = frozenset(["article", "main"])
HEADINGS = frozenset(
    {
        "h1", "h2", "h3", "h4", "h5", "h6",
    }
)

# fixed values: words of class, id and role names that mark what is not the
# article; the soft ones only until an article begins inside
HARD_CUES = frozenset(
    {
        "ad", "ads", "adv", "advert", "advertisement", "advertisements", "advertising", "adsense", "sponsor",
        "sponsored", "sponsors", "promo", "promotion", "promoted", "comment", "comments", "reply", "replies",
        "respond", "discussion", "disqus", "related", "recommended", "recommendations", "cookie", "cookies",
        "consent", "gdpr", "notice", "notices", "notification", "alert", "alertdialog", "popup", "modal",
        "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social",
        "paywall", "disclaimer", "copyright", "pagination", "pager", "tags", "breadcrumb", "breadcrumbs",
        "skip", "toc", "search",
    }
)
SOFT_CUES = frozenset(
    {
        "sidebar", "aside", "complementary", "footer", "contentinfo", "banner", "masthead", "topbar", "toolbar",
    }
)
HEADER_CUES = frozenset(["header"])
OPEN_CUES = frozenset(["comment", "comments", "reply", "replies", "related", "teaser", "promo", "sponsored", "ad", "advert"])
# words that may stand beside a cue in one name ("comment-list", "ad-slot-3");
# with any other word the name says something else ("no-comments", "ads-enabled")
BESIDE = frozenset(
    {
        "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "field",
        "form", "group", "heading", "inner", "item", "items", "js", "left", "link", "links", "list", "message",
        "module", "outer", "panel", "region", "right", "row", "section", "slot", "text", "thread", "title",
        "top", "unit", "widget", "widgets", "wp", "wrap", "wrapper", "zone",
    }
)
BESIDE_SOFT = frozenset(["global", "main", "page", "primary", "secondary", "site"])

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({DROPPED})(?![\w:-])(?:\"[^\"]*\"|'[^']*'|[^'\">])*(?<!/)>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([A-Za-z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
CUE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: int  # words inside links
    cue: bool  # inside a header, footer, advert, form, comments, ...
    inside: bool  # inside an article or main element


@dataclass
class Element:
    """An open element that says something about the text in it."""

    role: str  # content, hidden, hard, soft or header
    words: int = 0  # words inside, without links


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)}


def squeeze(text: str) -> str:
    """White space runs to one space, trimmed."""
    return " ".join(text.split())


def _cues(names: str) -> set[str]:
    """hard, soft, header: what whole names of a class, id or role attribute say."""
    out = set()
    for name in names.split():
        words = {w.lower() for w in CUE.findall(name)}
        said = words - BESIDE
        if said and said <= HARD_CUES:
            out.add("hard")
        elif (said := said - BESIDE_SOFT) and said <= SOFT_CUES:
            out.add("soft")
        elif said and said <= HEADER_CUES:
            out.add("header")
    return out


def _role(tag: str, source: str) -> str:
    """content, hidden, hard, soft, header or "" (nothing special)."""
    known = attributes(source) if source and not source.isspace() else {}
    if "hidden" in known or known.get("aria-hidden", "").lower() == "true" or HIDDEN.search(known.get("style", "")):
        return "hidden"
    names = " ".join(known.get(k, "") for k in ("class", "id", "role"))
    if tag in CONTENT_TAGS:
        opens = {w.lower() for name in names.split() for w in CUE.findall(name)} - BESIDE
        return "hard" if opens and opens <= OPEN_CUES else "content"
    if tag in BOILER_TAGS:
        return "hard"
    if tag in HEADER_TAGS:
        return "header"
    if tag in ("html", "body") or not names:
        return ""
    cues = _cues(names)
    return next((c for c in ("hard", "soft", "header") if c in cues), "")


def _judged(found: list[tuple[Block, list[Element], str]]) -> list[Block]:
    """Sets ``cue`` and ``inside`` of blocks from the elements around them.

    A cue is about the page, and does not count, on an element that holds all
    article elements of the page, or, on a page without one, its title (else
    its first longer text) and more than half of its unlinked words.
    """
    articles = len({id(e) for _, around, _ in found for e in around if e.role == "content"})
    words = sum(b.words - b.linked for b, _, _ in found)
    inner: dict[int, set[int]] = {}
    for b, around, _ in found:
        for k, e in enumerate(around):
            e.words += b.words - b.linked
            inner.setdefault(id(e), set()).update(id(x) for x in around[k + 1 :] if x.role == "content")
    begins = [around for b, around, heading in found if heading == "h1"]
    begins += [around for b, around, _ in found if b.words - b.linked >= 10]
    begin = {id(e) for e in begins[0]} if begins else set()
    for b, around, heading in found:
        cue = 0  # 2: hard, 1: soft
        for e in around:
            if e.role == "content":
                b.inside = True
                cue = 2 if cue == 2 else 0
            elif e.role == "hidden":
                cue = 2
            elif len(inner[id(e)]) == articles if articles else id(e) in begin and 2 * e.words > words:
                continue
            elif e.role == "hard":
                cue = 2
            elif e.role == "soft" or not heading or articles and not b.inside:
                cue = max(cue, 1)
        b.cue = bool(cue)
    return [b for b, _, _ in found]


def blocks(page: str) -> tuple[list[Block], list[tuple[str, str]]]:
    """The text blocks of a page in order, and its links (href, text)."""
    found: list[tuple[Block, list[Element], str]] = []
    links: list[tuple[str, str]] = []
    open_: list[tuple[str, Element | None]] = []  # the open block elements
    pieces: list[str] = []
    linked_pieces: list[str] = []
    href: str | None = None
    link_text: list[str] = []
    heading = ""  # the open heading element

    def close() -> None:
        nonlocal heading
        text = squeeze(html.unescape("".join(pieces)))
        if text:
            linked = len(html.unescape(" ".join(linked_pieces)).split())
            around = [e for _, e in open_ if e is not None]
            found.append((Block(text, len(text.split()), linked, False, False), around, heading))
        pieces.clear()
        linked_pieces.clear()

    def end_link() -> None:
        nonlocal href
        if href is not None:
            links.append((href, squeeze(html.unescape("".join(link_text)))))
            href = None
            link_text.clear()

    def add(text: str) -> None:
        pieces.append(text)
        if href is not None:
            linked_pieces.append(text)
            link_text.append(text)

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        ends = bool(m[2] or m[5])
        if tag == "br":
            add(" ")
        elif tag == "a":
            end_link()
            if not ends:
                href = attributes(m[4] or m[7] or "").get("href", "")
        elif tag not in INLINE:
            if ends:
                close()
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k][0] == tag:
                        del open_[k:]
                        break
                if tag in HEADINGS:
                    heading = ""
            else:
                close()
                if tag == "body":
                    open_.clear()
                heading = tag if tag in HEADINGS else ""
                source = m[4] or m[7] or ""
                if tag in UNCLOSED and open_ and open_[-1][0] == tag:
                    open_.pop()  # its end tag was left out
                if tag not in VOID and not source.rstrip().endswith("/"):
                    role = _role(tag, source)
                    open_.append((tag, Element(role) if role else None))
    if at < len(page):
        add(page[at:])
    close()
    end_link()
    return _judged(found), links
