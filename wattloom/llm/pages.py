"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page becomes a tree of block elements and text slots (formatting inside a block is part of its text). A
wrapper is such a tree with quantifiers: a child that comes several times in a row, or a run of children
that does, is a repeated group; a child that some page lacks is optional; text is a slot. Wrappers are
aligned child list by child list: what matches is merged, what doesn't becomes optional. The alignment
takes wrappers on both sides, so each task folds its own pages, and the tasks' wrappers of a host are folded
in turn, first in salted shares. What is gathered for a host is one small wrapper a task, never its pages.

A wrapper's own items are then judged. A slot whose text is the same on three or more different pages is
template; within an article element (or one named as the body) only if it is neither optional nor repeated
there and other text of the element differs between pages. Elements that are menus, headers, footers, asides,
forms, comments or hidden are apart; a name (sidebar, advert, share, ...) is a hint, and what it holds stays
if three or more pages show text that differs and isn't mostly links. The hint doesn't reach into an article
element below. Outside of bodies, slots that are mostly links go too.

Each page's tree is aligned with its host's judged wrapper, and takes what lies in its article elements; a page
without text there takes what lies in elements named as the body, and one without these all other text.

Null and empty pages, and pages without main text, give an empty text. A page whose URL has no host falls
under the host "". Broken nesting is closed as browsers do for the common cases. Repeated rows give the
same text. Without rows the result is empty. Very long pages and very deep nesting cost time in proportion to
their length; list lengths, names and levels of a wrapper are bounded, by becoming general, not by leaving
text out. Columns other than the three named are not read, whatever their names.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import whole_text, written

SHARES = 32
LONGEST_RUN = 6
TELLING_PAGES = 3
DEEPEST = 100
DEEPEST_MARKED = 120
LONGEST_LIST = 400
MOST_NAMED = 64

# Elements of the HTML standard by how they take part.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "head", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
    "i", "img", "ins", "kbd", "label", "mark", "nobr", "q", "s", "samp", "small", "span", "strike", "strong",
    "sub", "sup", "time", "tt", "u", "var", "wbr",
}
APART = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset"}
ARTICLE = {"article", "main"}
APART_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog"}
APART_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "cookie", "cookies", "consent", "disqus", "footer", "header", "login", "masthead",
    "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification",
    "pagination", "pager", "popup", "promo", "promotion", "related", "replies", "respond", "share", "sharing",
    "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget",
    "alert", "gdpr",
}
COMMENT_NAMES = {"comment", "comments", "disqus", "replies", "respond"}
# In a compound the first kind says what an element has or lacks, the second in which state it is: 'no-sidebar',
# 'content-with-header', 'comments-open' name no sidebar, header or comments.
MODIFIERS = {"no", "has", "with", "without", "hide", "show", "is", "not"}
STATES = {"open", "closed", "enabled", "disabled", "on", "off", "active", "visible", "left", "right"}
BODY_NAMES = {"article", "articlebody", "entry", "post", "story", "content", "main"}
# An opening tag of the key closes an open element of the set.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "p": {"p"},
}
# These hold what an omitted end tag can't reach over.
HOLDS = {"ul", "ol", "dl", "table", "div", "article", "section", "body", "td", "th", "li", "main", "aside", "nav", "form"}

SKIPPED = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)", re.S)
NAME = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*+)")
REST = re.compile(r"""(?:[^>"']|"[^"]*+"|'[^']*+')*+>""")
SPECIAL = re.compile(r"""[<>"']""")
RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I | re.A) for name in RAW}
ATTRIBUTE = re.compile(r"""(?<![-\w:.])([A-Za-z_:][-\w:.]*+)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++)""")
LONG_NUMBER = re.compile(r"\d{3,}$")
GENERATED = re.compile(r"[A-Za-z]*\d+[A-Za-z][A-Za-z0-9]*")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+\d*|[A-Z]+\d*(?![a-z])")
TEXT = "#"
MARKS = {"+", "~", "-", "?"}


@dataclass
class Node:
    """A block element of a page; children are nodes and texts in page order."""

    key: str
    children: list = field(default_factory=list)


@dataclass
class Slot:
    text: str
    linked: int


def naming(said: str) -> set[str]:
    """The words of classes and ids that name the element, without those that a modifier or state turns."""
    found = set()
    for compound in said.split():
        parts = [p.lower().rstrip("0123456789") for p in NAME_PARTS.findall(compound)]
        for i, part in enumerate(parts):
            if part in MODIFIERS or (i + 1 < len(parts) and parts[i + 1] in STATES):
                break
            found.add(part)
    return found


def key_of(tag: str, attributes: str) -> str:
    """The tag, with a mark for what its class, id and role say it is for: + main text, ~ named as main
    text, - apart from it, ? named as apart from it. Class words are part of the key, without long numbers;
    ids and words that look generated (letters behind digits) aren't, as pages of one template differ in them."""
    found = {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(attributes)} if attributes else {}
    said = f"{found.get('class', '')} {found.get('id', '')}"
    words = GENERATED.sub("", found.get("class", ""))
    names = {LONG_NUMBER.sub("", p.lower()) for p in NAME_PARTS.findall(words)}
    plain = naming(said)
    apart = tag in APART or found.get("role", "").lower() in APART_ROLES or bool(plain & COMMENT_NAMES)
    hinted = bool(plain & APART_NAMES)
    # The page's own containers may be named after a part of theirs.
    if tag in ("html", "body", "main") or (tag in ARTICLE and not plain & {"comment", "comments", "ad", "advert"}):
        apart = hinted = False
    elif tag in ARTICLE:
        apart = True
    if "hidden" in found or found.get("aria-hidden") == "true":
        apart = True
    mark = "-" if apart else "?" if hinted else ""
    if not apart and (tag in ARTICLE or found.get("itemprop", "").lower() == "articlebody" or found.get("role") == "main"):
        mark = "+"
    elif not mark and tag in ("div", "section") and plain & BODY_NAMES:
        mark = "~"
    return f"{tag}{mark}:{'.'.join(sorted(names))}"


def _closing(page: str, start: int) -> dict[int, int]:
    """For each < from `start` on: behind the > that ends a tag which opens there, or -1. One pass from the
    page's end, whatever is left open."""
    ends, plain, double, single = {}, -1, -1, -1
    for found in reversed(list(SPECIAL.finditer(page, start))):
        sign = found.group()
        if sign == ">":
            plain = found.end()
        elif sign == '"':
            plain, double = double, plain
        elif sign == "'":
            plain, single = single, plain
        else:
            ends[found.start()] = plain
    return ends


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): 'open', 'close' or 'text'; comments and raw elements are skipped. A < that opens
    no tag, or one that never ends, is text."""
    at, closing = 0, None
    while at < len(page):
        start = page.find("<", at)
        if start != at:
            start = len(page) if start < 0 else start
            yield "text", "", page[at:start]
            at = start
            continue
        found = NAME.match(page, at)
        if found is None:
            skipped = SKIPPED.match(page, at)
            if skipped is None:
                yield "text", "", "<"
            at = at + 1 if skipped is None else skipped.end()
            continue
        if closing is None:
            rest = REST.match(page, found.end())
            end = rest.end() if rest else -1
            if rest is None:
                closing = _closing(page, at)
        else:
            end = closing[at]
        if end < 0:
            yield "text", "", "<"
            at += 1
            continue
        name, rest, at = found.group(2).lower(), page[found.end() : end - 1], end
        if found.group(1):
            yield "close", name, ""
        elif name in RAW and name != "head" and not rest.endswith("/"):
            ended = RAW_ENDS[name].search(page, at)
            after = page.find(">", ended.end()) if ended else -1
            at = len(page) if after < 0 else after + 1
        else:
            yield "open", name, rest


def parse(page: str) -> Node:
    """The page's tree of blocks. Texts are decoded, with white space as single spaces.

    Below DEEPEST levels elements without a mark are part of the one that holds them, below DEEPEST_MARKED all
    but those apart. So is what lies within one apart there. Their texts stay in page order."""
    root = Node("root:")
    open_, tags, levels = [root], [""], [0]
    places: dict[str, list[int]] = {}
    run: list[str] = []
    linked = links = skip = 0

    def close(place: int) -> None:
        for tag in tags[place:]:
            places[tag].pop()
        del open_[place:], tags[place:], levels[place:]

    def last(names: set[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            open_[-1].children.append(Slot(text, min(linked, len(text))))
        run.clear()
        linked = 0

    for kind, name, rest in tokens(page):
        if kind == "text":
            if not skip:
                run.append(rest)
                linked += len(rest) if links else 0
            continue
        if name == "head":
            skip = 1 if kind == "open" else 0
            continue
        if name == "body":
            skip = 0
        if skip:
            continue
        # Marked-up phrases that stand apart (an advert in a span) are elements of their own.
        phrase = name in INLINE and name not in VOID
        if phrase and kind == "open":
            phrase = not rest or _mark(key_of(name, rest)) not in ("-", "?")
        elif phrase:
            phrase = tags[-1] != name
        if phrase or name == "br":
            if name == "a":
                links = 1 if kind == "open" else 0
            elif name == "br":
                run.append(" ")
            continue
        flush()
        if name in VOID:
            continue
        if kind == "open":
            links = 0
            if name in ("html", "body") and places.get(name):
                continue
            ends = CLOSES.get(name, set()) | (set() if name in INLINE else {"p"})
            place = last(ends)
            if place and place > last(HOLDS - ends):
                close(place)
            key, level = key_of(name, rest), levels[-1]
            own = _mark(key)
            marked = own in MARKS
            if level < DEEPEST or (_mark(open_[-1].key) != "-" and (own == "-" or (marked and level < DEEPEST_MARKED))):
                node, level = Node(key), level + 1
                open_[-1].children.append(node)
            else:
                node = open_[-1]
            if not rest.endswith("/"):
                places.setdefault(name, []).append(len(tags))
                open_.append(node)
                tags.append(name)
                levels.append(level)
        elif places.get(name):
            close(places[name][-1])
    flush()
    return root


# --- wrappers -----------------------------------------------------------------------------------
# A wrapper item is a list: [key, least, most, children, facts]. `least` 0: optional; `most` 2:
# repeated. TEXT items are slots; a GROUP item is a repeated run of several items. Facts of a slot are
# [characters, of these linked, hash of its text or None once texts differ, hashes of different pages that have
# it, about TELLING_PAGES of them]; those of a page that is matched have the numbers of its slots as a fifth.
GROUP = "()"
ANY = ":*"


def _slot_facts(slot: Slot, page: str) -> list:
    return [len(slot.text), slot.linked, xxhash.xxh64_hexdigest(slot.text.encode("utf-8", "surrogatepass")), [page]]


def _merge_facts(a: list, b: list) -> list:
    seen = a[3] if a[3] == b[3] or len(a[3]) >= TELLING_PAGES else sorted({*a[3], *b[3]})
    return [a[0] + b[0], a[1] + b[1], a[2] if a[2] == b[2] else None, seen, *([(a[4], b[4])] if len(a) > 4 else [])]


def merge_items(a: list, b: list) -> list:
    """Two items of one key (for groups: of one shape) as one."""
    facts = _merge_facts(a[4], b[4]) if a[0] == TEXT else []
    return [a[0], min(a[1], b[1]), max(a[2], b[2]), align(a[3], b[3]), facts]


def shape_of(item: list) -> str:
    return item[0] if item[0] != GROUP else GROUP + " ".join(shape_of(x) for x in item[3])


def collapse(items: list[list]) -> list[list]:
    """Runs of items that repeat next to each other as repeated groups; short runs first."""
    length = 1
    while length <= LONGEST_RUN:
        out: list[list] = []
        at = 0
        while at < len(items):
            run = items[at : at + length]
            shapes = [shape_of(x) for x in run]
            upto, times = at + length, 1
            while len(run) == length and [shape_of(x) for x in items[upto : upto + length]] == shapes:
                run = [merge_items(x, y) for x, y in zip(run, items[upto : upto + length], strict=True)]
                upto, times = upto + length, times + 1
            if times == 1:
                out.append(items[at])
                at += 1
                continue
            if length == 1:
                run[0][2] = 2
                out.append(run[0])
            else:
                out.append([GROUP, 1, 2, run, []])
            at = upto
        items = out
        length += 1
    return gathered(items) if len(items) > LONGEST_LIST else items


def _stem(item: list) -> str:
    return item[0].split(":", 1)[0]


def gathered(items: list[list]) -> list[list]:
    """A long list without order as a repeated group of optional items: each shape once."""
    found: dict[str, list] = {}
    for item in items:
        shape = shape_of(item)
        found[shape] = merge_items(found[shape], item) if shape in found else item
    return general([[x[0], 0, 2, *x[3:]] for x in found.values()])


def general(items: list[list]) -> list[list]:
    """Of optional elements of one tag and mark with more than MOST_NAMED different names the names are dropped:
    one optional, repeated item stands for all of them. Groups of so many shapes become one likewise."""
    shapes: dict[str, set[str]] = {}
    for item in items:
        if item[0] != TEXT and item[1] == 0:
            shapes.setdefault(_stem(item), set()).add(shape_of(item))
    many = {s for s, found in shapes.items() if len(found) > MOST_NAMED}
    return nameless(items, many, {shape_of(x) for x in items if x[1]}) if many else items


def nameless(items: list[list], stems: set[str], kept: set[str] = frozenset()) -> list[list]:
    """Items of these stems, but for shapes to be kept, merged into one each."""
    out: list[list] = []
    place: dict[str, int] = {}
    for item in items:
        stem = _stem(item)
        if item[0] == TEXT or stem not in stems or shape_of(item) in kept:
            out.append(item)
            continue
        own = [item[0] if item[0] == GROUP else stem + ANY, 0, 2, *item[3:]]
        if stem in place:
            out[place[stem]] = merge_items(out[place[stem]], own)
        else:
            place[stem] = len(out)
            out.append(own)
    return out


def _any_of(items: list[list]) -> set[str]:
    return {_stem(x) for x in items if x[0].endswith(ANY)}


def align(a: list[list], b: list[list]) -> list[list]:
    """The longest common run of items merged; the others optional, in order."""
    if not a or not b:
        out = [[x[0], 0, *x[2:]] for x in a or b]
        return out
    left, right = [shape_of(x) for x in a], [shape_of(x) for x in b]
    if left == right:
        return [merge_items(x, y) for x, y in zip(a, b, strict=True)]
    if any_a := _any_of(a):
        b = nameless(b, any_a, set(left))
    if any_b := _any_of(b) - any_a:
        a = nameless(a, any_b, set(right))
    if any_a or any_b:
        left, right = [shape_of(x) for x in a], [shape_of(x) for x in b]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if left[i] == right[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if left[i] == right[j]:
            out.append(merge_items(a[i], b[j]))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append([a[i][0], 0, *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], 0, *b[j][2:]])
            j += 1
    out += [[x[0], 0, *x[2:]] for x in a[i:] + b[j:]]
    return general(collapse(out))


def wrapper_of(node: Node, page: str = "", slots: list[Slot] | None = None) -> list[list]:
    """The wrapper of one page's (sub)tree: its child items. Slots are appended to `slots`, if given, and
    numbered in the facts."""
    items = []
    for child in node.children:
        if isinstance(child, Slot):
            facts = _slot_facts(child, page)
            if slots is not None:
                facts.append(len(slots))
                slots.append(child)
            items.append([TEXT, 1, 1, [], facts])
        else:
            items.append([child.key, 1, 1, wrapper_of(child, page, slots), []])
    return collapse(items)


def folded(a: dict | None, b: dict) -> dict:
    """Two wrappers of a host, each {'items', 'pages': hashes of different pages, at most
    TELLING_PAGES of them}, as one."""
    if a is None:
        return b
    pages = sorted({*a["pages"], *b["pages"]})[:TELLING_PAGES]
    return {"items": align(a["items"], b["items"]), "pages": pages}


def page_wrapper(page: str) -> dict:
    page_hash = xxhash.xxh64_hexdigest(page.encode("utf-8", "surrogatepass"))
    return {"items": wrapper_of(parse(page), page_hash), "pages": [page_hash]}


# --- slots --------------------------------------------------------------------------------------
# The class of a slot: 0 template or apart, 1 text outside of any body, 2 in an element named as the body, 3 in
# an article element.


def _mark(key: str) -> str:
    return key.split(":", 1)[0][-1:]


@dataclass(frozen=True)
class Place:
    """What is known of the place of an item from those above it."""

    apart: bool = False
    hinted: bool = False
    region: int = 1
    loose: bool = False  # optional or repeated within its region
    varied: bool = True  # some text of its region differs between pages


def _varies(items: list[list]) -> bool:
    return any(x[4][2] is None if x[0] == TEXT else _mark(x[0]) != "-" and _varies(x[3]) for x in items)


def inside(item: list, place: Place) -> Place:
    """The place of the item's children."""
    key, least, most, children, _ = item
    mark = _mark(key) if key != GROUP else ""
    if place.apart or mark == "-":
        return Place(apart=True)
    loose = place.loose or least == 0 or most > 1
    if mark == "+":
        # A name above an article element doesn't speak for the article.
        return Place(False, False, 3, False, _varies(children)) if place.region < 3 else Place(False, False, 3, loose, place.varied)
    if mark == "~" and place.region < 2:
        return Place(False, place.hinted, 2, False, _varies(children))
    return Place(False, place.hinted or mark == "?", place.region, loose, place.varied)


def class_of(item: list, place: Place) -> int:
    """The class of a slot of the wrapper."""
    _, least, most, _, (size, linked, text, seen, *_) = item
    if place.apart:
        return 0
    told = len(seen) >= TELLING_PAGES
    constant = told and text is not None and least > 0 and most == 1
    if place.hinted:
        return place.region if told and text is None and 2 * linked <= size else 0
    if place.region > 1:
        return 0 if constant and not place.loose and place.varied else place.region
    return 0 if constant or 2 * linked > size else 1


def judged(items: list[list], place: Place = Place()) -> list[list]:
    """[shape, class] of every item, or [shape, those of its children] where they differ."""
    out = []
    for item in items:
        if item[0] == TEXT:
            out.append([TEXT, class_of(item, place)])
            continue
        own = judged(item[3], inside(item, place))
        kinds = {x[1] if isinstance(x[1], int) else -1 for x in own}
        out.append([shape_of(item), own if len(kinds) > 1 or -1 in kinds else max(kinds, default=0)])
    return out


def _paths(items: list[list], place: Place = Place(), above: tuple[str, ...] = ()) -> Iterator[tuple[str, int]]:
    for item in items:
        if item[0] == TEXT:
            yield "/".join(above), class_of(item, place)
        else:
            yield from _paths(item[3], inside(item, place), above if item[0] == GROUP else (*above, item[0]))


def main_slots(wrapper: dict) -> list[str]:
    """The paths of the wrapper's main text."""
    found = list(_paths(wrapper["items"]))
    top = max((c for _, c in found), default=0)
    return sorted({p for p, c in found if c == top > 0})


def _pairs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common run of two lists."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    ends = 0
    while ends < min(len(a), len(b)) - start and a[-1 - ends] == b[-1 - ends]:
        ends += 1
    n, m = len(a) - ends, len(b) - ends
    best = [[0] * (m - start + 1) for _ in range(n - start + 1)]
    for i in range(n - start - 1, -1, -1):
        for j in range(m - start - 1, -1, -1):
            same = a[start + i] == b[start + j]
            best[i][j] = best[i + 1][j + 1] + 1 if same else max(best[i + 1][j], best[i][j + 1])
    found, i, j = [(k, k) for k in range(start)], start, start
    while i < n and j < m:
        if a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        elif best[i - start + 1][j - start] >= best[i - start][j - start + 1]:
            i += 1
        else:
            j += 1
    return found + [(len(a) - k, len(b) - k) for k in range(ends, 0, -1)]


def _numbers(items: list[list]) -> Iterator[int]:
    waiting: list = [items]
    while waiting:
        own = waiting.pop()
        if isinstance(own, int):
            yield own
        elif isinstance(own, tuple):
            waiting += own
        else:
            waiting += [x[4][4] if x[0] == TEXT else x[3] for x in own]


def match(items: list[list], verdicts: list[list], classes: list[int], place: Place = Place()) -> None:
    """Gives each slot of a page the class of the wrapper's item that it is aligned with."""
    of = dict(_pairs([shape_of(x) for x in items], [v[0] for v in verdicts]))
    shapes = {v[0]: v[1] for v in reversed(verdicts)}
    # One run of a group that comes several times elsewhere.
    loose = {w[0]: w[1] for v in verdicts if v[0].startswith(GROUP) and isinstance(v[1], list) for w in v[1]}
    for n, item in enumerate(items):
        shape = shape_of(item)
        found = verdicts[of[n]][1] if n in of else shapes.get(shape, loose.get(shape, shapes.get(_stem(item) + ANY)))
        if isinstance(found, int):
            for number in _numbers([item]):
                classes[number] = found
        elif item[0] != TEXT:
            match(item[3], found or [], classes, inside(item, place))
        else:
            for number in _numbers([item]):
                classes[number] = class_of(item, place)


def extract(page: str, verdicts: list[list]) -> str:
    """The page's main text, one block a line: its slots of the highest class that it has."""
    slots: list[Slot] = []
    items = wrapper_of(parse(page), "", slots)
    classes = [0] * len(slots)
    match(items, verdicts, classes)
    top = max(classes, default=0)
    return "\n".join(s.text for s, c in zip(slots, classes, strict=True) if c == top > 0)


# --- jobs ---------------------------------------------------------------------------------------


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[str, dict] = {}
        for host, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found[host] = folded(found.get(host), page_wrapper(page))
        texts = [json.dumps(w, separators=(",", ":")) for w in found.values()]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(texts, pa.string())], ["host", "wrapper"])


def _fold_wrappers(group: pd.DataFrame) -> pd.DataFrame:
    whole = None
    for text in sorted(group["wrapper"]):
        whole = folded(whole, json.loads(text))
    return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(whole, separators=(",", ":"))]})


def host_of(url) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """host and wrapper (JSON), one row a host."""
    kind = "host string, wrapper string"
    local = pages.select(host_of(F.col(url)).alias("host"), whole_text(page).alias("html")).mapInArrow(_fold_pages, kind)
    salted = local.withColumn("share", F.pmod(F.xxhash64("wrapper"), F.lit(SHARES)))
    shares = salted.groupBy("host", "share").applyInPandas(_fold_wrappers, kind)
    return shares.groupBy("host").applyInPandas(_fold_wrappers, kind)


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row."""

    @F.arrow_udf("string")
    def cut(html_: pa.Array, wrapper: pa.Array) -> pa.Array:
        verdicts: dict[str, list[list]] = {}
        out = []
        for content, text in zip(html_.to_pylist(), wrapper.to_pylist(), strict=True):
            if text not in verdicts:
                verdicts[text] = json.loads(text)
            out.append(extract(content, verdicts[text]))
        return pa.array(out, pa.string())

    @F.arrow_udf("string")
    def choose(wrapper: pa.Array) -> pa.Array:
        return pa.array([json.dumps(judged(json.loads(w)["items"]), separators=(",", ":")) for w in wrapper.to_pylist()], pa.string())

    verdicts = written(wrappers(pages, url, page).select("host", choose("wrapper").alias("verdicts")), "verdicts")
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), whole_text(page).alias("html")
    )
    found = rows.join(verdicts, "host").select("page_id", "url", cut("html", "verdicts").alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
