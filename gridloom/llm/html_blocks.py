"""Text blocks of one HTML page, with what the rules of main-text extraction look at.

One pass over the tags; elements are tracked only as far as they say where a text stands: in the page's article, in
a part that is never article text (navigation, forms, adverts, reader comments ...), or in a link. Malformed markup
is read as browsers do where that matters: comments and tags that are not closed end with the page, a ``<`` before
no name is text, paragraphs and list items end where the next begins.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from dataclasses import dataclass, field

#: Comments, declarations, tags with their attributes. Every branch ends at the end of the page, so a match never backs up.
MARKUP = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z)) | [!?][^>]*+>? | /(?![A-Za-z])[^>]*+>?
    | (?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<attributes>(?:=\s*+(?:"[^"]*+"?+|'[^']*+'?+)?+|[^>=]++)*+)>?)""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]*)))?""")
DISPLAY_NONE = re.compile(r"display\s*:\s*none", re.I)

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that begin and end blocks.
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul search noscript template svg canvas select datalist button "
    "audio video object map".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content that is no markup, read up to the end tag and left out.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: What an opening tag closes: open elements of these names, unless one of the others stands between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select", "datalist"})}
#: Never article text, whatever is in it.
APART = frozenset("nav aside footer dialog menu noscript template svg canvas select datalist button audio video object map search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())

#: Words in class names and ids of parts that are no article text. An article within the first kind is one where the page has no other.
SOFT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "signup login menu navbar nav navigation breadcrumb breadcrumbs sidebar widget footer masthead copyright share sharing social pagination pager toolbar search".split()
)
HARD_WORDS = frozenset("comment comments commentlist respond reply replies disqus discussion related recommended recommendations teaser teasers".split())
AD_WORDS = frozenset("ad ads advert advertisement sponsored".split())
NEGATED = frozenset("no not has with without".split())
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Open elements that an end tag is held against; browsers bound nesting alike.
REACH = 512

CLEAN, SOFT, HARD = 0, 1, 2
OUTSIDE, MAIN, ARTICLE = 0, 1, 2


@dataclass
class Block:
    text: str
    link_chars: int
    heading: bool
    apart: bool
    region: int
    doubtful: bool


@dataclass
class Open:
    """An open element: whether its content stands apart, in which region, and whether that region is itself in a part that is none."""

    name: str
    apart: int = CLEAN
    region: int = OUTSIDE
    inline: bool = False
    doubtful: bool = False


@dataclass
class Page:
    found: list[Block] = field(default_factory=list)
    stack: list[Open] = field(default_factory=lambda: [Open("")])
    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    open: Counter = field(default_factory=Counter)
    link_depth: int = 0
    heading: bool = False
    breaks: int = 0

    def text(self, raw: str) -> None:
        if self.stack[-1].inline:
            return
        piece = references.unescape(raw) if "&" in raw else raw
        if self.breaks and not piece.isspace():
            self.breaks = 0
        self.pieces.append(piece)
        if self.link_depth:
            self.linked.append(piece)

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            at = self.stack[-1]
            self.found.append(Block(text, len(" ".join("".join(self.linked).split())), self.heading, at.apart != CLEAN, at.region, at.doubtful))
        self.pieces, self.linked, self.breaks = [], [], 0

    def close(self, names: set[str], beyond: set[str]) -> None:
        """End the innermost open element of these names, with all in it, if it is within reach."""
        if not any(self.open[n] for n in names):
            return
        for i in range(len(self.stack) - 1, max(len(self.stack) - 1 - REACH, 0), -1):
            if self.stack[i].name in names:
                self.open.subtract(o.name for o in self.stack[i:])
                del self.stack[i:]
                if self.link_depth > i:
                    self.link_depth = 0
                return
            if self.stack[i].name in beyond:
                return

    def start(self, name: str, attributes: str) -> None:
        if name == "a":
            self.link_depth = len(self.stack) if re.search(r"(?i)\bhref\b", attributes) else 0
        elif name == "br":
            self.pieces.append(" ")
            self.breaks += 1
            if self.breaks == 2:
                self.flush()
        if name in BLOCKS:
            self.flush()
            self.close({"p"}, {"button", "table", "td", "th", "caption", "object", "template"})
            if name in CLOSES:
                self.close(*CLOSES[name])
            self.heading = name in HEADINGS
        if name in VOID:
            return
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes.strip(" /") else {}
        outer = self.stack[-1]
        if name in BLOCKS:
            self.push(self.opened(name, given))
        elif outer.inline or hidden(given) or names_in(given) & AD_WORDS:
            self.push(Open(name, outer.apart, outer.region, True, outer.doubtful))

    def push(self, element: Open) -> None:
        self.stack.append(element)
        self.open[element.name] += 1

    def opened(self, name: str, given: dict[str, str]) -> Open:
        outer = self.stack[-1]
        apart, region, doubtful = outer.apart, outer.region, outer.doubtful
        words, role = names_in(given), given.get("role", "").strip().lower()
        if hidden(given) or name in APART or role in ROLES:
            apart = HARD
        elif name == "article":
            # an article within another is a comment on it
            own = {w.lower() for c in given.get("class", "").split() for w in NAME_PARTS.findall(c)[:1]}
            apart = HARD if apart == HARD or region == ARTICLE or own & HARD_WORDS else CLEAN
        elif name == "main" or role == "main":
            apart = HARD if apart == HARD else CLEAN
        elif name not in ("html", "body"):
            if words & HARD_WORDS:
                apart = HARD
            elif name == "form" or words & SOFT_WORDS or name == "header" and region == OUTSIDE:
                apart = max(apart, SOFT)
        if name == "article" or given.get("itemprop", "").lower() == "articlebody":
            region = ARTICLE
        elif name == "main" or role == "main":
            region = max(region, MAIN)
        if region > outer.region:
            doubtful |= outer.apart == SOFT
        return Open(name, apart, region, outer.inline, doubtful)

    def end(self, name: str) -> None:
        if name == "a":
            self.link_depth = 0
        if name in BLOCKS:
            self.flush()
            self.heading = False
        self.close({name}, set())


def names_in(given: dict[str, str]) -> set[str]:
    """The words of an element's class names and id, without those of names that deny something (``no-sidebar``)."""
    found = set()
    for name in f"{given.get('class', '')} {given.get('id', '')}".split():
        parts = {w.lower() for w in NAME_PARTS.findall(name)}
        if not parts & NEGATED:
            found |= parts
    return found


def hidden(given: dict[str, str]) -> bool:
    return "hidden" in given or bool(DISPLAY_NONE.search(given.get("style", "")))


def blocks(html: str) -> list[Block]:
    """The page's blocks of text, in order; white space in each is one space."""
    page, at = Page(), 0
    while tag := MARKUP.search(html, at):
        if tag.start() > at:
            page.text(html[at : tag.start()])
        at = tag.end()
        if not (name := tag["name"]):
            continue
        name = name.lower()
        if tag["end"]:
            page.end(name)
        elif name in RAW:
            closing = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            at = closing.start() if closing else len(html)
        else:
            page.start(name, tag["attributes"])
    page.text(html[at:])
    page.flush()
    return page.found
