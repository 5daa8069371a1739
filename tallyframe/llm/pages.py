"""Main text of web pages by a template of equivalence classes.

Tokens of a page are its start tags and blocks of text, each with the path of block elements it stands in. Over the pages of
a host, frequent tokens whose occurrence vectors (how often in which page) are equal make a class. Tokens of a class that stand in
different elements of another class have different roles there, so the class is parted by them.

* Order: a class is ordered by the mean places of its tokens; every page tells which of them stand in that order. A class that
  repeats within a page has to repeat as a whole.
* Nesting: a class stands in a gap of the class around it: in one of its elements, behind one of its tokens. Every page tells which gap.
  A token that is not in its order and its gap in nearly all of its pages is not of the template, nor is what stands in it.
* Slots are the gaps that hold text. The main slot is what lies in the deepest element of the template in whose slots, those of
  nested classes included, most of the text outside links and page furniture is; its texts are the article.

Vectors are compared by fingerprint: the sum, over pages, of count times a hash of the page. Sums and votes are made per task before
they are shuffled, so a host with a third of all pages costs as many rows as others. Pages are parsed once for the template: orders
and gaps are read from lists of their tokens.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.base import settle

#: Share of a host's pages that a token of the template is in.
SUPPORT = 0.5
#: Share of a token's pages that have it in its class's order and in one gap of the class around, at least. Pages that have not are
#: read by a template of their own.
AGREE = 0.9
#: Share of the text that the main slot keeps, at least.
MAIN = 0.8
#: A text that is once in so many of a host's pages is the template's, if the host has so many pages at least.
FIXED = 0.9
LEAST_PAGES = 10

# Elements of HTML by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote body center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section summary table ul".split()
)
#: A start tag ends an open element of these, unless one of the others stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
# Elements, roles and words of class or id that mark page furniture.
FURNITURE = frozenset(
    "nav aside footer header form script style noscript template textarea select button iframe svg canvas object dialog menu title head "
    "xmp noembed noframes datalist".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "sidebar comment comments commentlist disqus reply replies respond share sharing social related recommended menu navbar nav navigation "
    "breadcrumb breadcrumbs pagination pager footer header popup modal overlay newsletter subscribe subscription signup login toolbar skip".split()
)
#: Elements that hold one block of text, so never the whole article.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote ul ol dl figure figcaption address hr".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>?|<(?P<start>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>]|\Z)""", re.IGNORECASE)


class Element:
    """An open element: its name, its path (names and classes of block elements), and whether it is furniture: for certain, or
    by a mark (a word of class or id, or a form) on it or around it, which counts unless the marked element holds most of the text."""

    __slots__ = ("name", "path", "furniture", "link", "marked", "above", "held")

    def __init__(self, name: str, path: str, furniture: bool, link: bool, marked: Element | None = None) -> None:
        self.name, self.path, self.furniture, self.link = name, path, furniture, link
        self.marked, self.above, self.held = marked, None, 0

    def marks(self) -> Iterator[Element]:
        """The marked elements around this one, itself included."""
        at = self.marked
        while at is not None:
            yield at
            at = at.above


def _described(name: str, rest: str) -> tuple[str, bool, bool]:
    """Classes of a start tag, whether it is page furniture by itself, and whether it is marked as such by a word or as a form."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)} if rest else {}
    classes = " ".join(sorted(found.get("class", "").split()))
    words = re.split(r"[^a-z]+", f"{classes} {found.get('id', '')}".lower()) if found else ()
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.IGNORECASE)
    role = found.get("role", "").lower() in ROLES
    own = name not in ("html", "body", "article", "main")
    return classes, name in FURNITURE and name != "form" or bool(hidden) or own and role, name == "form" or own and not WORDS.isdisjoint(words)


def events(page: str) -> Iterator[tuple[str, Element, str]]:
    """The page as (kind, element, text): "open" for a start tag with its element, "text" for characters within the
    innermost one, "break" where a block begins or ends. References are decoded, comments and raw text left out."""
    root = Element("", "", False, False)
    stack = [root]
    at, n = 0, len(page)

    def text(a: int, b: int):
        if b > a:
            yield "text", stack[-1], html.unescape(page[a:b])

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            yield from text(at, n)
            return
        yield from text(at, m.start())
        at = m.end()
        if m["end"]:
            name = m["end"].lower()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
                if name in INLINE and stack[k].name not in INLINE:
                    break  # an inline end tag does not close blocks
            if name not in INLINE:
                yield "break", stack[-1], ""
        elif m["start"]:
            name = m["start"].lower()
            if name in CLOSES_P:
                _close(stack, {"p"}, {"button", "table", "article", "section", "div", "td"})
            if name in ENDS:
                _close(stack, *ENDS[name])
            classes, furniture, mark = _described(name, m["rest"])
            top = stack[-1]
            block = name not in INLINE and name not in VOID
            path = f"{top.path}/{name}.{classes}" if block and classes else f"{top.path}/{name}" if block else top.path
            element = Element(name, path, furniture or top.furniture, top.link or name == "a", top.marked)
            if mark:
                element.marked, element.above = element, top.marked
            if name not in INLINE:
                yield "break", top, ""
            yield "open", element, f"{path}<{name}"
            if name in RAW:
                close = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
                at = close.end() if close else n
            elif name not in VOID and not m["rest"].endswith("/"):
                stack.append(element)


def _close(stack: list[Element], names: set[str], within: set[str]) -> None:
    """Close the innermost element of ``names`` unless one of ``within`` stands before it."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name in names:
            del stack[k:]
            return
        if stack[k].name in within:
            return


def parts(page: str) -> list[tuple[str, Element, str, int]]:
    """The page as ("open", element, tag token, 0) for start tags and ("block", element, text, characters in links) for blocks:
    text up to where a block begins or ends, white space collapsed, with the element it begins in. An element that holds more than half
    of the text outside links is no furniture by a mark."""
    found = list(_parts(page))
    blocks = [(e, len(words) - linked) for kind, e, words, linked in found if kind == "block" and not e.furniture]
    whole = sum(n for _, n in blocks)
    for e, n in blocks:
        for mark in e.marks():
            mark.held += n
    decided: set[int] = set()
    for e, _ in blocks:
        if id(e) not in decided:
            decided.add(id(e))
            e.furniture = any(2 * mark.held <= whole for mark in e.marks())
    return found


def _parts(page: str) -> Iterator[tuple[str, Element, str, int]]:
    held: list[str] = []
    first, linked = None, 0

    def block():
        words = " ".join("".join(held).split())
        if words:
            yield "block", first, words, min(linked, len(words))

    for kind, element, value in events(page):
        if kind == "text":
            first = element if first is None or not "".join(held).strip() else first
            held.append(value)
            linked += len(value) * element.link
            continue
        if kind == "break" or element.name == "br":
            yield from block()
            held, first, linked = [], None, 0
        if kind == "open":
            yield "open", element, value, 0
    yield from block()


def fixed_token(element: Element, words: str) -> str:
    return f"{element.path}#{xxhash.xxh64_hexdigest(words)}"


def measured(page: str, found: list | None = None) -> tuple[dict[str, list[int]], dict[str, int], dict[str, list[int]]]:
    """Tags: path and name -> [count, place of the first]. Blocks: path and fingerprint -> count. Slots: path -> [characters of
    text, of it in links] outside furniture."""
    tags: dict[str, list[int]] = {}
    texts: dict[str, int] = {}
    slots: dict[str, list[int]] = {}
    for place, (kind, element, value, linked) in enumerate(parts(page) if found is None else found):
        if kind == "open":
            tags.setdefault(value, [0, place])[0] += 1
            continue
        key = fixed_token(element, value)
        texts[key] = texts.get(key, 0) + 1
        if not element.furniture:
            slot = slots.setdefault(element.path, [0, 0])
            slot[0] += len(value)
            slot[1] += linked
    return tags, texts, slots


def _and_above(path: str) -> Iterator[str]:
    """A path and those of the elements around."""
    while path:
        yield path
        path = path.rpartition("/")[0]


def main_path(frame: list[str], slots: dict[str, list[int]]) -> str:
    """The deepest path of a frame (elements once a page) whose slots hold the share ``MAIN`` of all text outside links."""
    inside = dict.fromkeys(frame, 0)
    for path, (chars, linked) in slots.items():
        for around in _and_above(path):
            if around in inside:
                inside[around] += chars - linked
    whole = sum(s[0] - s[1] for s in slots.values())
    enough = [p for p, own in inside.items() if whole and own >= MAIN * whole]
    return max(enough, key=lambda p: (p.count("/"), p), default="")


def _frame(tokens) -> list[str]:
    """Paths of the elements among tag tokens that can hold several blocks."""
    parts = [(t.rpartition("<")[0], t.rpartition("<")[2]) for t in tokens]
    return [path for path, name in parts if name not in TEXT_BLOCKS and path.rpartition("/")[2].split(".")[0] == name]


def main_text(page: str | None, main: str | None, constants: frozenset[str] = frozenset(), order: list[str] | None = None) -> str:
    """The text of a page's main slot, widened until no text outside links, furniture and constants is left out: blocks in page
    order, white space collapsed, joined by line breaks.

    ``main`` and ``order`` are a host's main slot and frame. A page that has no such slot, or the frame's elements in another
    order, is read by a template of its own.
    """
    if not page:
        return ""
    found = parts(page)
    tags, _, slots = measured(page, found)
    places = [tags[t][1] for t in order or () if t in tags]
    if not main or not any(_within(p, main) for p in slots) or places != sorted(places):
        main, constants = main_path(_frame(t for t, (count, _) in tags.items() if count == 1), slots), frozenset()
    blocks = [
        (e, value, linked < len(value)) for kind, e, value, linked in found
        if kind == "block" and not (constants and fixed_token(e, value) in constants)
    ]
    # The slot is a host's; where this page has text of its own outside, the next element around that holds it too.
    slot = main
    for e, _, own in blocks:
        while own and not e.furniture and not _within(e.path, slot):
            slot = slot.rpartition("/")[0]
    out = [
        value for e, value, own in blocks
        if _within(e.path, slot) and (own or _within(e.path, main)) and (not e.furniture or _is_title(e.path[len(slot) :]))
    ]
    return "\n".join(out)


def _within(path: str, slot: str) -> bool:
    return not slot or path == slot or path.startswith(slot + "/")


def _is_title(path: str) -> bool:
    """A heading in a header within the main slot: the article's title."""
    names = {x.split(".")[0] for x in path.split("/")}
    return not HEADINGS.isdisjoint(names) and (names & FURNITURE) - {"form"} == {"header"}


# ---- the same over hosts ----

LISTS = "host string, page_id long, tokens array<string>, chars array<int>, linked array<int>"
SUMS = ("f1", "f2", "pages", "count", "place")
VOTES = ("pages", "chars", "linked")
#: The gap of a token that has several in a page, or is not in order.
ASTRAY = -2


def _list_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of each page in page order; with those of blocks the characters of their text outside furniture, and of it in links."""
    for batch in batches:
        rows = []
        for host, page_id, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if page:
                found = [
                    (value, 0, 0) if kind == "open" else (fixed_token(e, value), *((0, 0) if e.furniture else (len(value), linked)))
                    for kind, e, value, linked in parts(page)
                ]
                rows.append((host, page_id, *([x[i] for x in found] for i in range(3))))
        types = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["host", "page_id", "tokens", "chars", "linked"])


def _summed(sums: dict[tuple, list[int]], keys: list[tuple[str, pa.DataType]], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = [pa.array([k[i] for k in sums], t) for i, (_, t) in enumerate(keys)]
    columns += [pa.array([v[i] for v in sums.values()], pa.int64()) for i in range(len(names))]
    return pa.RecordBatch.from_arrays(columns, [*(k for k, _ in keys), *names])


def _stat_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each token of a host: of its occurrence vector's fingerprints, its pages, occurrences and first places."""
    for batch in batches:
        sums: dict[tuple, list[int]] = {}
        for host, page_id, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            hashed = xxhash.xxh64_intdigest(f"{page_id}")
            r1, r2 = hashed & 0x3FFFFFFF, hashed >> 34
            first: dict[str, int] = {"": 0}
            for place, token in enumerate(tokens):
                first.setdefault(token, place)
            counts = Counter(tokens)
            counts[""] = 1
            for token, place in first.items():
                known = sums.setdefault((host, token), [0] * len(SUMS))
                n = counts[token]
                known[0] += n * r1
                known[1] += n * r2
                known[2] += 1
                known[3] += n
                known[4] += place
        yield _summed(sums, [("host", pa.string()), ("token", pa.string())], SUMS)


def _around(token: str) -> str:
    """The path of the element a token stands in."""
    path, mark, name = token.rpartition("#" if "#" in token else "<")
    own = mark == "<" and path.rpartition("/")[2].split(".")[0] == name
    return path.rpartition("/")[0] if own else path


def _element(path: str) -> str:
    """The tag token of the element with a path."""
    return f"{path}<{path.rpartition('/')[2].split('.')[0]}"


def classes(frame: pd.DataFrame) -> pd.DataFrame:
    """Frequent tokens of one host (token and ``SUMS``) in the order of their mean places, with their class and what it stands in.

    A class has equal occurrence vectors and one token around (``up``, of another class; for a class that is once a page, of one that is
    so, too). ``rank`` is a token's place in its class; it ``bounds`` a gap unless it is once a page in an element that repeats.
    """
    tokens = frame[frame["token"] != ""]
    tokens = tokens.assign(at=tokens["place"] / tokens["pages"]).sort_values(["at", "token"]).reset_index(drop=True)
    tokens["vector"] = tokens.groupby(["f1", "f2", "pages", "count"]).ngroup()
    tokens["once"] = tokens["pages"] == tokens["count"]
    of = {token: (vector, once) for token, vector, once in tokens[["token", "vector", "once"]].itertuples(index=False)}
    ups, bounds = [], []
    for token in tokens["token"]:
        path, (vector, once) = _around(token), of[token]
        bounds.append(not once or all(of.get(_element(x), (0, True))[1] for x in _and_above(path)))
        while path and (found := of.get(_element(path), (vector, once))) and (found[0] == vector or once and not found[1]):
            path = path.rpartition("/")[0]
        ups.append(_element(path) if path else "")
    tokens["bounds"], tokens["up"] = bounds, ups
    tokens["group"] = tokens.groupby(["vector", "up"], sort=False).ngroup()
    tokens["rank"] = tokens.groupby("group").cumcount()
    return tokens[["token", "pages", "group", "rank", "once", "bounds", "up"]]


def _host_classes(frame: pd.DataFrame) -> pd.DataFrame:
    pages = frame.loc[frame["token"] == "", "pages"]
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "n_pages": [int(pages.iloc[0])], "classes": [json.dumps(classes(frame).values.tolist())]})


def in_order(ranks: list[int], once: bool) -> set[int]:
    """Which tokens of a class stand in its order, told by the ranks of its occurrences in a page.

    Of a class that is once a page: those of a longest increasing sequence. Of one that repeats: all, if it repeats as a whole, else none.
    """
    if not once:
        size = max(ranks) + 1
        return set(ranks) if ranks == list(range(size)) * (len(ranks) // size) else set()
    if all(a < b for a, b in zip(ranks, ranks[1:])):
        return set(ranks)
    ends: list[int] = []
    before: dict[int, int | None] = {}
    for r in ranks:
        k = bisect_left(ends, r)
        before[r] = ends[k - 1] if k else None
        ends[k : k + 1] = [r]
    out, r = set(), ends[-1]
    while r is not None:
        out.add(r)
        r = before[r]
    return out


class Places:
    """The classes of a host, as a page is held against them."""

    def __init__(self, rows: list[list]) -> None:
        group = {token: g for token, _, g, *_ in rows}
        self.known = {token: (g, rank, group.get(up, -1), bounds) for token, _, g, rank, _, bounds, up in rows}
        self.once = {g: once for _, _, g, _, once, *_ in rows}
        self.size = Counter(group.values())
        self.slot: dict[str, tuple[str, int]] = {}

    def slot_of(self, path: str) -> tuple[str, int]:
        """The innermost element of a class around a text, and its class."""
        if path not in self.slot:
            at = next((x for x in _and_above(path) if _element(x) in self.known), "")
            self.slot[path] = at, self.known[_element(at)][0] if at else -1
        return self.slot[path]

    def votes(self, tokens: list[str], chars: list[int], linked: list[int]) -> Iterator[tuple[str, int, int, int, int]]:
        """(token, its gap, 1, 0, 0) for tokens of classes, (path and "|", gap, 0, characters, those in links) for texts. A gap is
        the rank of the last token, so far, of the class around."""
        last: dict[int, int] = {}
        ranks: dict[int, list[int]] = {}
        gaps: dict[str, int] = {}
        for token, n, k in zip(tokens, chars, linked, strict=True):
            if n:
                path, group = self.slot_of(token.rpartition("#")[0])
                yield f"{path}|", last.get(group, -1), 0, n, k
            if token in self.known:
                group, rank, around, bounds = self.known[token]
                gap = last.get(around, -1)
                gaps[token] = gap if gaps.get(token, gap) == gap else ASTRAY
                if bounds:
                    last[group] = rank
                ranks.setdefault(group, []).append(rank)
        right = {g: in_order(x, self.once[g]) if self.once[g] or len(set(x)) == self.size[g] else set() for g, x in ranks.items()}
        for token, gap in gaps.items():
            group, rank, *_ = self.known[token]
            yield token, gap if rank in right[group] else ASTRAY, 1, 0, 0


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hosts: dict[str, Places] = {}
    for batch in batches:
        sums: dict[tuple, list[int]] = {}
        for host, tokens, chars, linked, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if host not in hosts:
                if len(hosts) >= 64:
                    hosts.clear()
                hosts[host] = Places(json.loads(packed))
            for token, gap, *add in hosts[host].votes(tokens, chars, linked):
                known = sums.setdefault((host, token, gap), [0] * len(VOTES))
                for i, x in enumerate(add):
                    known[i] += x
        yield _summed(sums, [("host", pa.string()), ("token", pa.string()), ("gap", pa.int32())], VOTES)


def valid_tokens(rows: list[list], votes: pd.DataFrame) -> dict[str, int]:
    """Tokens of the template with their gaps: those in order and in one gap in the share ``AGREE`` of their pages, and within others."""
    best: dict[str, tuple[int, int]] = {}
    for token, gap, pages in votes.loc[(votes["pages"] > 0) & (votes["gap"] != ASTRAY), ["token", "gap", "pages"]].itertuples(index=False):
        best[token] = max(best.get(token, (0, 0)), (int(pages), int(gap)))
    up = {token: around for token, *_, around in rows}
    agreed = {token for token, pages, *_ in rows if best.get(token, (0, 0))[0] >= AGREE * pages}
    out: dict[str, int] = {}
    for token in up:
        chain = [token]
        while chain[-1] in agreed and chain[-1] not in out and up[chain[-1]]:
            chain.append(up[chain[-1]])
        if chain[-1] in agreed:
            out.update((t, best[t][1]) for t in chain)
    return out


def _deduce(key: tuple, frame: pd.DataFrame, votes: pd.DataFrame) -> pd.DataFrame:
    """The template of one host from its classes, of which there are at most as many tokens as in two pages, and its pages' votes."""
    pages, rows = int(frame["n_pages"].iloc[0]), json.loads(frame["classes"].iloc[0])
    valid = valid_tokens(rows, votes)
    sizes = Counter(group for token, _, group, *_ in rows if token in valid)
    # Slots: gaps with text. What stands in an element that is not of the template is in the gap of the next one around.
    slots: dict[str, list[int]] = {}
    gaps = set()
    for token, gap, chars, linked in votes.loc[votes["chars"] > 0, ["token", "gap", "chars", "linked"]].itertuples(index=False):
        path = token[:-1]
        while path and _element(path) not in valid:
            path, gap = path.rpartition("/")[0], ASTRAY
        gaps.add((path, gap))
        slot = slots.setdefault(path, [0, 0])
        slot[0] += int(chars)
        slot[1] += int(linked)
    once = [(token, n) for token, n, _, _, alone, *_ in rows if alone and token in valid]
    order = [t for t, _ in once if "#" not in t]
    constants = [t for t, n in once if "#" in t and n >= FIXED * pages and pages >= LEAST_PAGES]
    return pd.DataFrame({
        "host": [key[0]], "n_pages": [pages], "n_classes": [sum(n > 1 for n in sizes.values())], "n_slots": [len(gaps)],
        "main": [main_path(_frame(order), slots)], "frame": [order], "constants": [constants],
    })


TEMPLATE = "host string, n_pages long, n_classes long, n_slots long, main string, frame array<string>, constants array<string>"


def templates(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One template per host of ``pages`` (page_id, host, html): its valid classes and slots, the frame's tokens (tags that are once a
    page) in page order, the main slot, fixed texts.

    Tokens in fewer than ``support`` of a host's pages are left out before a host's tokens meet, so what meets is bounded by
    the size of pages, not by their number. Text of rare elements counts with the nearest frequent element around them.
    """
    lists = settle(pages.select("host", "page_id", "html").mapInArrow(_list_batches, LISTS), "page_lists")
    types = ", ".join(["host string", "token string", *(f"{c} long" for c in SUMS)])
    stats = lists.select("host", "page_id", "tokens").mapInArrow(_stat_batches, types)
    stats = settle(stats.groupBy("host", "token").agg(*(F.sum(c).alias(c) for c in SUMS)), "page_tokens", narrow=True)
    sizes = stats.filter("token = ''").select("host", F.col("pages").alias("all_pages"))
    often = stats.join(sizes, "host").filter(F.col("pages") >= support * F.col("all_pages")).drop("all_pages")
    known = settle(often.groupBy("host").applyInPandas(_host_classes, "host string, n_pages long, classes string"), "page_classes")
    types = ", ".join(["host string", "token string", "gap int", *(f"{c} long" for c in VOTES)])
    votes = lists.join(known, "host").select("host", "tokens", "chars", "linked", "classes").mapInArrow(_vote_batches, types)
    votes = votes.groupBy("host", "token", "gap").agg(*(F.sum(c).alias(c) for c in VOTES))
    return settle(known.groupBy("host").cogroup(votes.groupBy("host")).applyInPandas(_deduce, TEMPLATE), "templates")


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, pages, mains, orders, constants = (c.to_pylist() for c in batch.columns)
        known: dict[tuple, frozenset] = {}
        texts = []
        for page, main, order, fixed in zip(pages, mains, orders, constants, strict=True):
            key = tuple(fixed or ())
            texts.append(main_text(page, main, known.setdefault(key, frozenset(key)), order))
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    A null or empty page has an empty text. A null url, or one without a host, is of the host "". Repeated rows are pages of their own;
    other columns are ignored. A host with a single page gives a template from that page.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), host.alias("host"))
    found = rows.join(templates(rows).select("host", "main", "frame", "constants"), "host", "left")
    return found.select("page_id", "url", "html", "main", "frame", "constants").mapInArrow(_text_batches, "page_id long, url string, text string, n_chars long")
