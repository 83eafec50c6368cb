"""Main text of pages by two passes over their blocks.

First pass: a block gathers points.  Length and density of stop words speak for it, a high
share of linked text and, in a language of the stop words, few of them against it; standing
in an article or main element is one more point of evidence among these.  Page furniture
(navigation, header, footer, aside, form, and elements whose class, id or role says so) is
no main text by definition, however well it reads.
Second pass: blocks that the first pass leaves open, mostly short ones, take the label of
the nearest decided block, the following one if both sides are as near and differ for a
heading.  A page without any decided block keeps its open ones.

Pages are read in one pass, in time linear in their length, whatever is left unclosed.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STOP_WORDS = frozenset(
    "the of and to in is that for it as was with be by on are this at from or "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un du une que est pour qui dans par sur au pas avec "
    "el los se del las por con no su para es al lo como más o pero sus y".split()
)
# what ends the block before it and begins a new one
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav noframes ol optgroup option p "
    "pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script|style|noscript|template|iframe|svg|math|object|canvas|audio|video|noembed|noframes|xmp"
_FURNITURE = frozenset("nav header footer aside form menu button select textarea dialog head title label fieldset".split())
_MAIN = frozenset(("article", "main"))
_HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_ITEMS = frozenset("p li dt dd option tr td th".split())
# end tags that don't reach out of these elements
_WEAK, _BARRIER = frozenset("p b i a span em strong li".split()), ("article", "main", "body", "table")
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split()
)
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav\w*|menu\w*|breadcrumbs?|header|footer|foot|masthead|side|sidebar\w*|aside|widgets?|ads?|adverts?|"
    r"advert\w*|sponsor\w*|promo\w*|banner\w*|cookies?|consent|gdpr|notices?|notifications?|alerts?|popups?|modals?|overlay|"
    r"newsletter|subscri\w+|signup|login|forms?|search|comments?|respond|replies|disqus|discussion|share|sharing|social|"
    r"related|recommend\w*|pagination|pager|copyright|legal|disclaimer|toolbar|skip)(?:$|[\s_-])",
    re.I,
)
_NAME = re.compile(r"[a-z][a-z0-9:-]*", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _RAW.split("|")}
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=\s|/|$)", re.I)
_SPACE = re.compile(r"\s+")


@dataclass
class Rules:
    """Limits of the first pass: counts of words and shares."""

    linked: float = 0.35  # more linked text is bad
    short: int = 8  # fewer words say nothing
    long: int = 25
    stop_low: float = 0.06
    stop_high: float = 0.15


def _furniture(tag: str, rest: str, in_main: bool) -> bool:
    if tag in _FURNITURE and not (in_main and tag == "header"):
        return True
    if not rest or "=" not in rest and "hidden" not in rest.lower():
        return False
    for name, *values in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in _ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", "article", "main") and _NAMES.search(value):
            return True
    return False


@dataclass
class Block:
    """Text of a block, its nearest block element, linked characters, and whether furniture or the main part holds it."""

    text: str
    tag: str
    linked: int
    furniture: bool
    main: bool


class _Reader:
    """Positions of tags in a page; every search goes forward and a failed one isn't repeated."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.missing: set[str] = set()  # not in the rest of the page
        self.quoted = True  # quotes of attributes are respected until a tag has no end that way

    def find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def tag_end(self, at: int) -> int:
        """Index of the ``>`` that ends the tag, or -1."""
        start = at
        while self.quoted:
            end = self.find(">", at)
            if end < 0:
                break
            first = min((q for q in (self.find_before(c, at, end) for c in "\"'") if q >= 0), default=-1)
            if first < 0:
                return end
            at = self.find(self.page[first], first + 1) + 1
            if not at:  # a lone quote
                at = first + 1
        self.quoted = False
        return self.find(">", start)

    def find_before(self, what: str, at: int, end: int) -> int:
        return -1 if what in self.missing else self.page.find(what, at, end)

    def tokens(self) -> Iterator[tuple[str, str, bool, str]]:
        """``(text before, tag, is an end tag, attributes)``; comments and raw elements have no tag."""
        page, at, text = self.page, 0, 0
        while (lt := self.find("<", at)) >= 0:
            nxt = page[lt + 1 : lt + 2]
            if nxt in ("!", "?"):
                close = "-->" if page.startswith("<!--", lt) else "]]>" if page.startswith("<![CDATA[", lt) else ">"
                end = self.find(close, lt + 2)
                yield page[text:lt], "", False, ""
                at = text = end + len(close) if end >= 0 else len(page)
                continue
            name = _NAME.match(page, lt + 1 + (nxt == "/"))
            end = self.tag_end(name.end()) if name else -1
            if name is None or end < 0:
                at = lt + 1
                continue
            tag, rest, closes = name[0].lower(), page[name.end() : end], nxt == "/"
            at = end + 1
            if tag in _RAW_END and not closes:
                if not rest.endswith("/"):
                    stop = _RAW_END[tag].search(page, at) if f"</{tag}" not in self.missing else None
                    if stop is None:
                        self.missing.add(f"</{tag}")
                    at = stop.end() if stop else len(page)
                tag, rest = "", ""
            yield page[text:lt], tag, closes, rest
            text = at
        yield page[text:], "", False, ""


class _Open:
    """Open elements; the innermost one of a kind is known without a search."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, bool]] = []  # tag, in furniture, in the main part
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.hard: list[int] = []  # blocks other than p

    def push(self, tag: str, furniture: bool, main: bool) -> None:
        k = len(self.stack)
        self.stack.append((tag, furniture, main))
        self.at.setdefault(tag, []).append(k)
        if tag in _BLOCK:
            self.blocks.append(k)
            if tag != "p":
                self.hard.append(k)

    def last(self, *tags: str) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def cut(self, k: int) -> None:
        while len(self.stack) > k:
            tag = self.stack.pop()[0]
            self.at[tag].pop()
            for held in (self.blocks, self.hard):
                if held and held[-1] >= len(self.stack):
                    held.pop()

    def top(self) -> tuple[str, bool, bool]:
        return self.stack[-1] if self.stack else ("", False, False)

    def block(self) -> str:
        return self.stack[self.blocks[-1]][0] if self.blocks else ""


def blocks(page: str) -> list[Block]:
    """The blocks of a page with text, in page order.

    End tags that match nothing open are skipped; what is left open inside them ends too.
    """
    out: list[Block] = []
    held: list[str] = []
    opened, linked, tag_now, bad, main = _Open(), 0, "", False, False

    def flush() -> None:
        nonlocal linked
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                out.append(Block(text, tag_now, linked, bad, main))
        linked = 0

    for text, tag, closes, rest in _Reader(page).tokens():
        if text:
            held.append(text)
            if opened.at.get("a"):
                linked += len(text.strip())
        if tag == "br":
            held.append(" ")
        if not tag or tag == "br":
            continue
        block = tag in _BLOCK
        if block:
            flush()
        if closes:
            k = opened.last(tag)
            if k >= 0 and not (tag in _WEAK and opened.last(*_BARRIER) > k):
                if not block and opened.blocks and opened.blocks[-1] >= k:
                    flush()
                opened.cut(k)
        elif tag not in _VOID and not rest.endswith("/"):
            if tag in _ITEMS:  # an open one ends where a new one begins, inline elements left open in it too
                k = opened.last(tag)
                if k >= 0 and (not opened.hard or opened.hard[-1] <= k):
                    opened.cut(k)
            _, inside, in_main = opened.top()
            opened.push(tag, inside or _furniture(tag, rest, in_main), in_main or tag in _MAIN)
        _, bad, main = opened.top()
        if block:
            tag_now = opened.block()
    flush()
    return out


def _words(text: str) -> int:
    """Number of words; a script without blanks counts six characters as one."""
    return max(text.count(" ") + 1, len(text) // 6 if " " not in text[:200] else 0)


def _stops(text: str) -> int:
    return sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in text.lower().split(" "))


def first_pass(found: list[Block], rules: Rules) -> list[bool | None]:
    """Good, bad or open for each block, by points: 2 and more are good, -1 and less are bad."""
    stops = [_stops(b.text) for b in found]
    words = [_words(b.text) for b in found]
    prose = [i for i, b in enumerate(found) if not b.furniture and b.linked <= rules.linked * len(b.text)]
    # few stop words only count in a language that has some on this page
    listed = sum(stops[i] for i in prose) >= rules.stop_low * max(1, sum(words[i] for i in prose))
    out: list[bool | None] = []
    for b, n, hits in zip(found, words, stops, strict=True):
        if b.furniture or b.linked > rules.linked * len(b.text):
            out.append(False)
            continue
        points = 2 * b.main
        if n >= rules.short and b.tag not in _HEADING:
            points += 1 + (n >= rules.long)
            if hits >= rules.stop_high * n:
                points += 2
            elif listed and hits < rules.stop_low * n:
                points -= 2
            out.append(True if points >= 2 else False if points < 0 else None)
        else:
            out.append(None)
    return out


def second_pass(first: list[bool | None], headings: list[bool]) -> list[bool]:
    """Open blocks take the label of the nearest decided one; without any, all of them are good."""
    n = len(first)
    back, ahead = [n] * n, [n] * n  # distances to the nearest decided block
    for i in range(n):
        back[i] = 0 if first[i] is not None else back[i - 1] + 1 if i else n
    for i in range(n - 1, -1, -1):
        ahead[i] = 0 if first[i] is not None else ahead[i + 1] + 1 if i < n - 1 else n
    out = []
    for i, own in enumerate(first):
        if own is None:
            before = first[i - back[i]] if back[i] <= i else None
            after = first[i + ahead[i]] if i + ahead[i] < n else None
            if before is None and after is None:
                own = True
            elif before is None or after is None:
                own = after if before is None else before
            elif back[i] == ahead[i]:
                own = after if headings[i] else before and after
            else:
                own = before if back[i] < ahead[i] else after
        out.append(bool(own))
    return out


def labels(found: list[Block], rules: Rules) -> list[bool]:
    """Good or bad for each block.

    Furniture says nothing about its neighbours, and in the main part an open block looks
    at the blocks of the main part only, if some are decided.
    """
    first = first_pass(found, rules)
    if not any(first):
        # nothing reads well: link lists and furniture stay out, the rest is all there is
        return [x is None for x in first]
    out = [False] * len(found)
    plain = [i for i, b in enumerate(found) if not b.furniture]
    for own in (plain, [i for i in plain if found[i].main]):
        if any(first[i] is not None for i in own):
            for i, good in zip(own, second_pass([first[i] for i in own], [found[i].tag in _HEADING for i in own]), strict=True):
                out[i] = good
    return out


def main_text(page: str, rules: Rules | None = None) -> str:
    """Good blocks joined by an empty line."""
    found = blocks(page)
    return "\n\n".join(b.text for b, good in zip(found, labels(found, rules or Rules()), strict=True) if good)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules: Rules | None = None
) -> DataFrame:
    """``id_col, url_col, text, n_chars``: one row for every row of ``pages``.

    A null page counts as empty; a page without good blocks has the empty text.  Ids and
    addresses may be null or repeat.
    """
    limits = astuple(rules or Rules())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Rules(*limits)
        for batch in batches:
            text = [main_text(page.as_py() or "", own) for page in batch.column("page")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                ["id", "url", "text", "n_chars"],
            )

    source = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("page"))
    out = source.mapInArrow(run, "id long, url string, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
