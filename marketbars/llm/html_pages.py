"""Reading one HTML page: elements with their places, and the text runs in them.

A small forgiving reader, used inside tasks: it knows void and raw-text elements
and implied end tags, and drops a tag that the page's end cuts off.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import xxhash

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*'|["'])*)(?:>|\Z)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD_CHARS = re.compile(r"[^\W_]+")
NAME_PART = re.compile(r"[^a-z0-9]+")

# Element names of the HTML standard by kind.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
# An element of the key ends an open one of the values, up to the nearest of SCOPES.
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "option": ("option",),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tbody": ("thead", "tbody", "tr", "td", "th"),
    "tfoot": ("tbody", "tr", "td", "th"),
    "body": ("head",),
}
SCOPES = frozenset("ul ol dl table select article main section div body html".split())
# What surrounds the article rather than being part of it: elements, ARIA roles, name parts.
ASIDE_ELEMENTS = frozenset(
    "head nav header footer aside form button select menu dialog object svg canvas audio video "
    "input fieldset search".split()
)
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar status".split()
)
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo "
    "promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar "
    "aside related recommended widget widgets notice notices cookie cookies consent gdpr banner "
    "alert popup modal overlay newsletter subscribe subscription signup login social share "
    "sharing comment comments disqus respond reply replies pagination pager skip toolbar".split()
)
# A name with one of these says what a page has, not what the element is: with-sidebar.
LAYOUT_PARTS = frozenset(("has", "no", "with", "without"))
# Inside an article a name has to say nothing but these and ASIDE_NAMES: share-buttons, not header-lead.
CONTAINER_PARTS = frozenset(
    "area bar block body box button buttons container content form icons inner item items link "
    "links list panel posts section slot thread unit wrap wrapper".split()
)
HEADS = frozenset(("header", "masthead", "banner"))  # inside an article they hold its headline
MAIN_ELEMENTS = frozenset(("article", "main"))
NEVER_ASIDE = frozenset(("html", "body", "main"))
# Blocks of text, which are parts of an article and not what holds all of it.
TEXT_BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th blockquote pre "
    "figure figcaption address details summary".split()
)
HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)


@dataclass(slots=True)
class Element:
    tag: str
    label: str  # tag and class names
    role: int  # hash of the labels on the way here
    aside: bool  # it or what holds it surrounds the article
    main: bool  # the outermost element that is the article by name
    inside: bool  # it or what holds it is the article by name
    link: bool
    parents: tuple[int, ...] = field(default=())  # roles from the outermost to its own


@dataclass(slots=True)
class Run:
    """A text run between block boundaries."""

    text: str
    holder: Element
    plain_chars: int  # its length; of a run with links, only letters and digits outside them


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _says_aside(name: str, inside: bool, article: bool) -> bool:
    """Whether a class or id names something that surrounds the article.

    Outside of it one part of the name is enough, unless that describes the
    page's layout; inside, the whole name has to mean that; an article is only
    taken for a comment or the like if a name says just that.
    """
    parts = {part for part in NAME_PART.split(name) if part and not part.isdigit()}
    if inside or article:
        asides = parts & (ASIDE_NAMES - HEADS)
        return bool(asides) and parts <= asides | CONTAINER_PARTS
    return parts.isdisjoint(LAYOUT_PARTS) and not parts.isdisjoint(ASIDE_NAMES)


def _open(parent: Element, tag: str, raw: str) -> Element:
    given = _attributes(raw) if raw.strip() else {}
    names = (given.get("class", "") + " " + given.get("id", "")).lower().split()
    label = ".".join([tag, *sorted(given.get("class", "").lower().split())])
    role_name = given.get("role", "").lower()
    main = tag in MAIN_ELEMENTS or role_name in MAIN_ELEMENTS or (
        given.get("itemprop", "").lower() == "articlebody"
    )
    heads_article = parent.inside and (tag == "header" or role_name == "banner")
    aside = tag not in NEVER_ASIDE and (
        (not heads_article and (tag in ASIDE_ELEMENTS or role_name in ASIDE_ROLES))
        or any(_says_aside(name, parent.inside, tag == "article") for name in names)
        or "hidden" in given
        or given.get("aria-hidden", "").lower() == "true"
        or HIDDEN.search(given.get("style", "")) is not None
    )
    role = _signed(xxhash.xxh64_intdigest(f"{parent.role} {label}"))
    return Element(
        tag, label, role, parent.aside or aside, main and not parent.inside, parent.inside or main,
        parent.link or tag == "a",
        (*parent.parents, role) if tag not in INLINE else parent.parents,
    )


def read(page: str | None) -> Iterator[Element | Run]:
    """Elements as they open and text runs as they end, in page order."""
    page = page or ""
    root = Element("", "", 0, False, False, False, False)
    stack = [root]
    pending: list[str] = []
    unlinked: list[str] = []
    holder = root

    known: dict[tuple, Element] = {}  # of this page: rows of a table, items of a list

    def opened(tag: str, raw: str) -> Element:
        parent = stack[-1]
        key = (parent.role, parent.aside, parent.inside, parent.link, tag, raw)
        found = known.get(key)
        if found is None:
            found = known[key] = _open(parent, tag, raw)
        return found

    balances: dict[str, tuple[list[int], list[int]]] = {}  # of a tag: places, closed from there on

    def never_closed(tag: str, at: int) -> bool:
        """Fewer of the tag's open elements are closed from ``at`` on than there are."""
        if tag not in balances:
            places, closed, balance = [], [], 0
            pieces = re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])", page, re.I)
            for piece in reversed(list(pieces)):
                balance += 1 if piece.group(1) else -1
                places.append(-piece.start())
                closed.append(balance)
            balances[tag] = places, closed
        places, closed = balances[tag]
        later = bisect.bisect_right(places, -at)
        return (closed[later - 1] if later else 0) < sum(e.tag == tag for e in stack)

    def block() -> Element:
        return next(e for e in reversed(stack) if e.tag not in INLINE)

    def flush() -> Iterator[Run]:
        text = " ".join(html.unescape("".join(pending)).split())
        if text:
            plain = len(text)
            if len(unlinked) < len(pending):
                plain = sum(map(len, WORD_CHARS.findall(html.unescape(" ".join(unlinked)))))
            yield Run(text, holder, plain)
        pending.clear()
        unlinked.clear()

    def add(text: str) -> None:
        nonlocal holder
        if not text:
            return
        if not pending:
            holder = block()
        # Inline elements that surround the article, such as a hidden span, are left out.
        if stack[-1].aside and not holder.aside:
            return
        pending.append(text)
        if not stack[-1].link:
            unlinked.append(text)

    at = 0
    while True:
        match = PIECE.search(page, at)
        if match is None:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        tag = (match.group(2) or "").lower()
        if not tag:  # comments, declarations
            continue
        cut_off = not match.group().endswith(">")
        if cut_off:
            break
        if match.group(1):
            if tag == "br":
                add(" ")
            elif tag in INLINE:
                k = len(stack) - 1
                while stack[k].tag in INLINE and stack[k].tag != tag:
                    k -= 1
                if stack[k].tag == tag:
                    del stack[k:]
            elif any(e.tag == tag for e in stack):
                yield from flush()
                while stack.pop().tag != tag:
                    pass
            continue
        if tag == "br" or tag == "wbr":
            add(" " if tag == "br" else "")
            continue
        if tag not in INLINE:
            yield from flush()
            if tag in CLOSES_P:
                _close(stack, ("p",))
            _close(stack, ENDS.get(tag, ()))
            if tag in MAIN_ELEMENTS:  # an unclosed menu does not hold the article
                first = next((k for k, e in enumerate(stack) if e.aside), len(stack))
                outside = not any(e.inside for e in stack[:first])
                if outside and first < len(stack) and never_closed(stack[first].tag, at):
                    del stack[first:]
        element = opened(tag, match.group(3))
        if tag not in INLINE:
            yield element
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I)
            closing = end.search(page, at)
            at = closing.end() if closing else len(page)
        elif tag not in VOID:  # a slash does not close an element of HTML
            stack.append(element)
    yield from flush()


def _close(stack: list[Element], tags: tuple[str, ...]) -> None:
    """End open elements of the tags, not looking past the nearest scope."""
    k = len(stack) - 1
    found = None
    while k > 0 and (stack[k].tag not in SCOPES or stack[k].tag in tags):
        if stack[k].tag in tags:
            found = k
        k -= 1
    if found is not None:
        del stack[found:]
