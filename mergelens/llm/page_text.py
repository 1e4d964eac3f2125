"""The main text of HTML pages by tag-path ratios."""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

#: The start of a comment, declaration or tag; anything else is text.
OPENING = re.compile(r"<(?:!--|[!?]|(/?)([A-Za-z][^\s/>]*))")
ATTRIBUTES = re.compile(r"""((?:[^'">]++|"[^"]*"|'[^']*')*+)>""")
#: The attributes of a tag in steps that end at each opening sign.
STEP = re.compile(r"""[^'"<>]+|"[^"]*"|'[^']*'|<""")
ATTRIBUTE = re.compile(r"""([\w:-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？]")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Fixed values of HTML: elements without an end, with raw content (shown for xmp, up to the end of the
#: page without an end tag for script and style), that are never shown, that break a line.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style title textarea xmp noembed noframes".split())
RAW_ENDS = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}
ENDLESS = frozenset("script style".split())
UNSHOWN = frozenset("svg template annotation annotation-xml datalist".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An element ends open ones of these names when it starts, up to the nearest of the scopes.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th"),
}
SCOPES = frozenset("ul ol dl table select article section div body html main".split())
#: Elements of another language, the places in them that hold HTML again, and HTML elements that end
#: them when they start.
FOREIGN = frozenset("svg math".split())
HTML_PLACES = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li "
    "listing main menu meta nobr ol p pre ruby s section article aside header footer nav figure form "
    "small span strong strike sub sup table tt u ul var".split()
)
#: Steps between two tag paths up to which they smooth each other.
NEAR = 4
#: Elements that hold whole texts, other than single paragraphs, lists or inline marks.
HOLDERS = frozenset("article body center div html main section td".split())
#: Elements that never hold the main text, and words in class, id or role that say so.
#: Replies can be longer than the text they are about. A token that starts with a word of MODIFIERS tells of another part, not of its own.
ASIDE = frozenset("nav aside footer button select menu dialog head label input".split())
REPLY_WORDS = frozenset("comment comments commentlist disqus replies respond".split())
MODIFIERS = frozenset("no not non with without has have had hide show wide full".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice alert sidebar aside menu nav navbar navigation breadcrumb "
    "breadcrumbs footer comment comments commentlist disqus replies respond share sharing social "
    "related recommended newsletter subscribe subscription signup login popup modal overlay widget "
    "pagination pager toolbar masthead search paywall contentinfo complementary".split()
)


@dataclass
class Path:
    """A tag path, told from others by its number: the one above, and what stands on it."""

    parent: int
    depth: int
    #: Whether an article stands above, an article or main element does, a link does or is its end.
    in_article: bool = False
    in_main: bool = False
    in_link: bool = False


@dataclass
class Element:
    name: str
    parent: int
    #: The number of its tag path.
    path: int
    aside: bool = False
    #: The words (or the form) for which an element is set aside unless it holds most of the text.
    named: frozenset[str] = frozenset()
    main: bool = False


@dataclass
class Page:
    """Elements in page order, texts as (element, block, text), and the tag paths."""

    elements: list[Element] = field(default_factory=list)
    texts: list[tuple[int, int, str]] = field(default_factory=list)
    paths: list[Path] = field(default_factory=lambda: [Path(-1, 0)])
    steps: dict[tuple[int, str], int] = field(default_factory=dict)

    def below(self, parent: int, name: str) -> int:
        """The number of the path that leads from an element to one of this name in it."""
        above = self.elements[parent]
        key = above.path, name
        if key not in self.steps:
            path = self.paths[above.path]
            self.steps[key] = len(self.paths)
            self.paths.append(
                Path(
                    above.path,
                    path.depth + 1,
                    path.in_article or above.name == "article",
                    path.in_main or above.name in ("article", "main"),
                    path.in_link or name == "a",
                )
            )
        return self.steps[key]


class Open:
    """The open elements, with the places of each name, so that no look at them walks over all."""

    def __init__(self) -> None:
        self.elements = [0]
        self.names = [""]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks = [0]

    def push(self, element: int, name: str) -> None:
        self.places[name].append(len(self.names))
        if name in BLOCK:
            self.blocks.append(len(self.names))
        self.elements.append(element)
        self.names.append(name)

    def cut(self, depth: int) -> None:
        """Ends all elements from ``depth`` on."""
        while len(self.names) > depth:
            name = self.names.pop()
            self.elements.pop()
            self.places[name].pop()
            if name in BLOCK:
                self.blocks.pop()

    def last(self, *names: str) -> int:
        """The innermost place of these names, 0 if none is open."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)


class Markup:
    """Finds comments, declarations and tags in a text, in time that grows with its length.

    A tag whose end is missing, or stands in quotes, is text. Every opening sign outside of its quotes
    would run into the same missing end, so it is remembered and not tried again.
    """

    def __init__(self, source: str):
        self.source = source
        self.last = source.rfind(">")
        self.endless: set[int] = set()

    def search(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """Start, end, name in lower case (empty for comments), whether it ends, and attributes."""
        source = self.source
        while found := OPENING.search(source, at):
            start, at = found.start(), found.end()
            if found[0] == "<!--":
                end = source.find("-->", at)
                return start, end + 3 if end >= 0 else len(source), "", False, ""
            if at <= self.last:
                if not found[2]:
                    return start, source.index(">", at) + 1, "", False, ""
                end = self._end(start, at)
                if end >= 0:
                    return start, end, found[2].lower(), bool(found[1]), source[at : end - 1]
            at = start + 1
        return None

    def _end(self, start: int, at: int) -> int:
        """Where the tag ends whose attributes begin at ``at``; -1 if nowhere."""
        if start in self.endless:
            return -1
        if not self.endless:
            found = ATTRIBUTES.match(self.source, at)
            if found:
                return found.end()
        passed = {start}
        while step := STEP.match(self.source, at):
            if self.source[at] == "<":
                if at in self.endless:
                    break
                passed.add(at)
            at = step.end()
        else:
            if self.source.startswith(">", at):
                return at + 1
        self.endless |= passed
        return -1


def parse(source: str) -> Page:
    """Reads any text as HTML: unknown, unclosed and misplaced tags are taken as they come."""
    page = Page([Element("", -1, 0)])
    stack, at, block, markup = Open(), 0, 0, Markup(source)
    end, any_foreign = len(source), False
    unended: set[str] = set()
    while at < end:
        found = markup.search(at)
        stop = found[0] if found else end
        if stop > at:
            page.texts.append((stack.elements[-1], block, source[at:stop]))
        if not found:
            break
        _, at, name, ends, attributes = found
        if not name:
            continue
        if name in BLOCK:
            block += 1
        if ends:
            depth = stack.last(name)
            if depth and (name in BLOCK or depth > stack.blocks[-1]):
                stack.cut(depth)
            continue
        closed = attributes.rstrip().endswith("/")
        any_foreign = any_foreign or name in FOREIGN
        foreign = any_foreign and _foreign(stack, name)
        if name in RAW:
            if foreign and closed:
                continue
            closing = None if name in unended else RAW_ENDS[name].search(source, at)
            if closing and name == "xmp":
                page.elements.append(_element(page, stack.elements[-1], name, attributes))
                shown = html.escape(source[at : closing.start()])
                page.texts.append((len(page.elements) - 1, block, shown))
            if closing:
                at = closing.end()
                continue
            unended.add(name)
            if name in ENDLESS and not foreign:
                at = end
            else:
                following = markup.search(at)
                at = following[0] if following else end
            continue
        if name in VOID and not foreign:
            continue
        _close_implied(stack, name)
        page.elements.append(_element(page, stack.elements[-1], name, attributes))
        if not closed or (name in BLOCK and not foreign):
            stack.push(len(page.elements) - 1, name)
    return page


def _foreign(stack: Open, name: str) -> bool:
    """Whether a starting element belongs to open svg or math; one of HTML ends them instead."""
    depth = stack.last(*FOREIGN)
    if depth <= max(stack.last(*HTML_PLACES), stack.blocks[-1]):
        return False
    if name in BREAKOUT:
        stack.cut(depth)
        return False
    return True


def _close_implied(stack: Open, name: str) -> None:
    if name in BLOCK and stack.names[stack.blocks[-1]] == "p":
        stack.cut(stack.blocks[-1])
    depth = stack.last(*CLOSES.get(name, ()))
    if depth and depth > stack.last(*SCOPES):
        stack.cut(depth)


def _element(page: Page, parent: int, name: str, attributes: str) -> Element:
    made = Element(name, parent, page.below(parent, name))
    values = {
        k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes) if v or k == "hidden"
    }
    words = {
        w.lower()
        for key in ("class", "id", "role")
        for token in values.get(key, "").split()
        for split in [NAME.findall(token)]
        if split and split[0].lower() not in MODIFIERS
        for w in split
    }
    made.main = name in ("article", "main") or values.get("role") == "main"
    inside = page.paths[made.path].in_main
    hidden = "hidden" in values or "display:none" in values.get("style", "").replace(" ", "")
    unshown = name in UNSHOWN and "shadowrootmode" not in values
    if name in ASIDE or unshown or hidden or values.get("aria-hidden") == "true":
        made.aside = True
    elif name == "header":
        made.aside = not inside
    elif name == "form":
        made.named = frozenset({"form"})
    elif name not in ("html", "body"):
        outer = frozenset() if inside else frozenset({"header", "topbar"})
        made.named = frozenset(words & (ASIDE_WORDS | outer))
    return made


def _settle(page: Page) -> list[bool]:
    """Whether each element is set aside.

    A name does so only to elements that, alone or as many of the same path and names, hold at most half
    of the running text (outside links, with punctuation; without any, all text) that no element
    like nav has. Replies, and what is not in an article, stay aside, however long, if articles or main
    elements have a fifth of it.
    One around a title stays, and one around an article if no other article has that fifth.
    """
    elements = page.elements
    sized, every = Counter(), Counter()
    for element, _, text in page.texts:
        every[element] += len(text.strip())
        if PUNCTUATION.search(text) and not page.paths[elements[element].path].in_link:
            sized[element] += len(text.strip())
    hard, named, in_main = [], [], []
    for element in elements:
        up = element.parent
        hard.append(element.aside or (up >= 0 and hard[up]))
        named.append(bool(element.named) or (up >= 0 and named[up]))
        in_main.append((element.main and not element.named) or (up >= 0 and in_main[up]))
    if not any(size for i, size in sized.items() if not hard[i]):
        sized = every
    held = [0 if hard[i] else sized[i] for i in range(len(elements))]
    in_articles = sum(h for h, m, n in zip(held, in_main, named, strict=True) if m and not n)
    titled, around = set(), set()
    for i in range(len(elements) - 1, 0, -1):
        up = elements[i].parent
        held[up] += held[i]
        if i in titled or elements[i].name == "h1":
            titled.add(up)
        if i in around or (elements[i].main and not elements[i].named):
            around.add(up)
    alike, largest = Counter(), Counter()
    for i, element in enumerate(elements):
        if element.named:
            alike[element.path, element.named] += held[i]
            largest[element.path, element.named] = max(largest[element.path, element.named], held[i])
    article = in_articles and 5 * in_articles >= held[0]
    aside = []
    for i, element in enumerate(elements):
        own = element.aside
        if element.named:
            key = element.path, element.named
            single = 2 * largest[key] > held[0]
            most = 2 * (held[i] if single else alike[key]) > held[0]
            kept = "form" not in element.named and (i in titled or i in around and not article)
            beside = article and (
                element.named & REPLY_WORDS or not page.paths[element.path].in_article
            )
            own = not kept and (bool(beside) or not most)
        aside.append(own or (element.parent >= 0 and aside[element.parent]))
    return aside


def path_scores(page: Page, texts: list[tuple[int, int, str]]) -> dict[int, float]:
    """Text length and punctuation per text node of each tag path, smoothed and multiplied.

    Both ratios of a path are averaged with those of near paths (weights fall with the number of
    steps from one path to the other, up to NEAR), so that a bold word in a paragraph counts with it.
    Every path adds its ratios to the NEAR paths above it, by the steps down to it, and reads from these
    the sums of the paths beside it, so the work grows with the number of paths.
    """
    nodes, length, marks = Counter(), Counter(), Counter()
    for element, _, text in texts:
        path = page.elements[element].path
        nodes[path] += 1
        length[path] += len(text)
        marks[path] += len(PUNCTUATION.findall(text))
    #: For each path and number of steps down: paths, their lengths and marks a node.
    beneath: dict[int, list[list[float]]] = {}
    for path in nodes:
        own = 1.0, length[path] / nodes[path], (1 + marks[path]) / nodes[path]
        above = path
        for steps in range(NEAR + 1):
            sums = beneath.setdefault(above, [[0.0, 0.0, 0.0] for _ in range(NEAR + 1)])
            sums[steps] = [s + o for s, o in zip(sums[steps], own, strict=True)]
            above = page.paths[above].parent
            if above < 0:
                break
    scores = {}
    for path in nodes:
        weights = texted = marked = 0.0
        came, above = -1, path
        for up in range(NEAR + 1):
            for down in range(NEAR + 1 - up):
                sums = beneath[above][down]
                # Those of the branch that leads to the path are nearer and were counted before.
                less = beneath[came][down - 1] if came >= 0 and down else (0.0, 0.0, 0.0)
                paths = sums[0] - less[0]
                if not paths:
                    continue
                weight = math.exp(-((up + down) ** 2) / 2)
                weights += weight * paths
                texted += weight * (sums[1] - less[1])
                marked += weight * (sums[2] - less[2])
            came, above = above, page.paths[above].parent
            if above < 0:
                break
        scores[path] = (texted / weights) * (marked / weights)
    return scores


def main_text(source: str | None) -> str:
    """The blocks of the main text, each with single spaces, joined by a space.

    Texts of the paths whose score reaches the deviation of all scores are content, and all of them
    stay. Lines of a lower score (headings, lists) stay if they are inside an article or main element,
    or inside the smallest holder (body, div, section, cell) around all content outside of those.
    What is set aside never counts. Null, empty and textless pages: empty.
    """
    page = parse(source or "")
    aside = _settle(page)
    texts = [
        (e, b, html.unescape(t)) for e, b, t in page.texts if not aside[e]
    ]
    visible = [(e, b, t) for e, b, t in texts if t.strip()]
    if not visible:
        return ""
    scores = path_scores(page, visible)
    mean = sum(scores.values()) / len(scores)
    deviation = math.sqrt(sum((s - mean) ** 2 for s in scores.values()) / len(scores))
    limit = min(deviation, max(scores.values()))
    content = {e for e, _, _ in visible if scores[page.elements[e].path] >= limit}
    inside = _containers(page, aside, content, {e for e, _, _ in visible})
    for i, element in enumerate(page.elements):
        if element.parent in inside:
            inside.add(i)
    blocks: dict[int, list[str]] = defaultdict(list)
    for element, block, text in texts:
        if element in inside:
            blocks[block].append(text)
    found = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return " ".join(block for block in found if block)


def _containers(page: Page, aside: list[bool], content: set[int], texted: set[int]) -> set[int]:
    """The elements that hold the main text: together they are around all of ``content``."""
    elements = page.elements
    found: set[int] = set()
    covered, has_main, has_text = set(), set(), set(texted)
    for i in range(len(elements) - 1, 0, -1):
        if i in has_text:
            has_text.add(elements[i].parent)
    for i, element in enumerate(elements):
        if element.parent in covered:
            covered.add(i)
        elif element.main and not aside[i] and i in has_text:
            found.add(i)
            covered.add(i)
            up = element.parent
            while up >= 0 and up not in has_main:
                has_main.add(up)
                up = elements[up].parent
    outside = content - covered
    if not outside:
        return found
    held = Counter(outside)
    for i in range(len(elements) - 1, 0, -1):
        held[elements[i].parent] += held[i]
    # Elements are in page order, so the last one around all of them is the innermost.
    cover = best = max(i for i in range(len(elements)) if held[i] == len(outside))
    while best and elements[best].name not in HOLDERS:
        best = elements[best].parent
    return found | {cover if best in has_main else best}


def extract_pages(pages: DataFrame, keep: list[str], source: str) -> DataFrame:
    """``keep`` columns, text (empty if none) and n_chars of every page, from its whole HTML.

    Pages are read one by one, so repeated rows and an empty table need no care; other columns are
    not read.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [main_text(h) for h in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in range(len(keep))),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=[*keep, "text", "n_chars"],
                )

    schema = pages.select(*keep).schema.add("text", "string").add("n_chars", "long")
    return pages.select(*keep, source).mapInArrow(extract, schema)
