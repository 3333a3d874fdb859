"""HTML extraction by composite text density.

The page becomes a list of elements in page order. Menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments are taken out by tag and role. The head of a class name or id,
and a form, is evidence only: the wrapper of the densest element stays whatever it is called, and so does a
long part without many links that does not name comments. For every
element left, characters per tag are weighed down by the part of characters and tags that are links; an
element's density sum is that of its children. The element of the largest sum is the article's body. The
least density on its path from the page's body is the threshold for what else belongs to the article (for
elements without links, so is the least number of characters per tag on it): siblings along the path, and
``article`` and ``main`` elements anywhere, that reach it, and headings along the path. Text that stands
directly in an element on the path is, with its inline elements, a sibling like others. A short block that is
not mostly links stays between two kept siblings, and a paragraph beside a kept one. The outermost
``article`` or ``main`` on the path is added whole, as what is weak in it is still no listed part.

Cases: a NULL or empty page gives an empty text, so does one without text outside what is taken out;
unclosed and misnested tags are closed as browsers do; an unclosed comment, script or tag takes the rest of
the page; a very long or broken page takes time in proportion to its length; repeated pages are treated one
by one; an empty table gives no rows. A page's other columns are kept and never used.
"""

from __future__ import annotations

import html
import math
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from gridsight.llm.common import utf8

_MARK = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_QUOTE_OR_END = re.compile("[\"'>]")
#: Numeric character references that no code point has, of any length, and leading zeros of others.
_BIG_REFERENCE, _ZEROS = re.compile(r"&#0*[1-9][0-9]{7,};?"), re.compile(r"&#0+(?=[0-9])")
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
_NAME = re.compile(r"[^\W_]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no page text.
_RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.I) for tag in _RAW}
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section summary table tbody td tfoot th thead tr ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_LANDMARKS = frozenset(("article", "main"))
#: Elements that are no part of an article.
_DROP_TAGS = frozenset(
    "nav footer aside menu button select input option datalist dialog fieldset canvas svg object "
    "embed audio video head map search".split())
_DROP_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar dialog alert alertdialog".split())
#: Words of class names and ids of the same.
_DROP_NAMES = re.compile(
    r"(?:ad|ads|adbox|adslot|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|gdpr|notice\w*|"
    r"notification\w*|disclaimer|alert\w*|popup\w*|modal|overlay|newsletter|subscribe\w*|signup|login|sidebar\w*|"
    r"rail|widget\w*|menu\w*|nav|navbar|navigation|breadcrumb\w*|masthead|topbar|footer\w*|colophon|copyright|"
    r"comment\w*|disqus|respond|replies|reply|share|sharing|social\w*|related\w*|recommend\w*|trending|pagination|"
    r"pager|toolbar|searchform|searchbox)")
_COMMENT_NAMES = re.compile(r"comment\w*|disqus|respond|replies|reply")
#: Words for boxes and places, behind the word that says what is in them.
_BOXES = frozenset(
    "area bar block body bottom box button buttons center class column container content group holder icon icons inner "
    "item items left link links list main outer panel post posts region right row section slot text thread top unit "
    "widget wrap wrapper zone".split())
#: Characters that make an element long enough to doubt its name.
_LITTLE = 1000
_HEADER_NAMES = frozenset(("header", "pageheader", "siteheader"))
#: What an opening tag closes, and the elements beyond which it does not look.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
}
_P_SCOPE = frozenset("td th table caption button object html body".split())
_STAY_OPEN = frozenset("html body".split())


class Page:
    """Elements in page order: tag, parent, names; and the text and block ends between them.

    Reading takes time in proportion to the page, however broken: a walk for the end of a tag never goes twice
    over what another walk found to have none, and open elements are looked up by name, not searched for.
    """

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.names, self.roles = ["html"], [-1], [()], [""]
        self.events: list[tuple[int, str | None]] = []
        self._stack, self._open_at, self._open_blocks = [0], {}, []
        self._source, self._endless = source, set()
        position = start = 0
        while found := _MARK.search(source, position):
            if found.start() > start:
                self._text(source[start:found.start()])
            comment, closing, tag = found.groups()
            start = position = self._end(found)
            if comment or not tag or position > len(source):
                continue
            tag = tag.lower()
            if closing:
                self._close(tag)
                continue
            self._open(tag, source[found.end():position])
            if tag in _RAW:
                end = _RAW_END[tag].search(source, position)
                start = position = end.start() if end else len(source)
        if start < len(source):
            self._text(source[start:])

    def _end(self, found: re.Match) -> int:
        """Where the markup ends: at the first ``>`` outside quotes or, if the quotes do not close, at the
        first one; beyond the page where there is none."""
        source, comment, tag = self._source, found.group(1), found.group(3)
        if comment:
            end = source.find("-->", found.end())
            return end + 3 if end >= 0 else len(source) + 1
        position, passed = found.end(), []
        while tag and (mark := _QUOTE_OR_END.search(source, position)) and mark.start() not in self._endless:
            if mark.group() == ">":
                return mark.end()
            passed.append(mark.start())
            position = source.find(mark.group(), mark.end()) + 1
            if not position:
                break
        self._endless.update(passed)
        end = source.find(">", found.end())
        return end + 1 if end >= 0 else len(source) + 1

    def _text(self, text: str) -> None:
        if "&#" in text:
            text = _ZEROS.sub("&#", _BIG_REFERENCE.sub("\ufffd", text))
        self.events.append((self._stack[-1], html.unescape(text)))

    def _depth(self, tags: frozenset | set | tuple) -> int:
        """The place on the stack of the innermost open element of these tags, or 0."""
        return max((self._open_at[t][-1] for t in tags if self._open_at.get(t)), default=0)

    def _pop_to(self, depth: int) -> None:
        while len(self._stack) > depth:
            node = self._stack.pop()
            self._open_at[self.tags[node]].pop()
            if self.tags[node] in _BLOCK:
                self._open_blocks.pop()
                self.events.append((node, None))

    def _close_open(self, tags: frozenset | set, limits: frozenset | set) -> None:
        depth = self._depth(tags)
        if depth > self._depth(limits):
            self._pop_to(depth)

    def _open(self, tag: str, rest: str) -> None:
        if tag in _BLOCK:
            self._close_open({"p"}, _P_SCOPE)
        if tag in _CLOSES:
            self._close_open(*_CLOSES[tag])
        if tag == "body":
            self._close_open({"head"}, set())
        names, role = (), ""
        if "=" in rest:
            values: list[str] = []
            for key, value in _ATTRIBUTE.findall(rest):
                value = value.strip("\"'").lower()
                if key.lower() == "role":
                    role = value.strip()
                else:
                    values += value.split()
            names = tuple(values)
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self._stack[-1])
        self.names.append(names)
        self.roles.append(role)
        if tag == "br":
            self.events.append((self._stack[-1], " "))
        elif tag in _BLOCK:
            self.events.append((node, None))
        if tag not in _VOID and not rest.endswith("/>") or tag in _BLOCK and tag != "hr":
            self._open_at.setdefault(tag, []).append(len(self._stack))
            if tag in _BLOCK:
                self._open_blocks.append(len(self._stack))
            self._stack.append(node)

    def _close(self, tag: str) -> None:
        if tag in _STAY_OPEN:
            return
        depth = self._depth((tag,))
        if depth and (tag in _BLOCK or not self._open_blocks or self._open_blocks[-1] <= depth):
            self._pop_to(depth)
        elif tag == "p":
            self.events.append((self._stack[-1], None))


def _named(names: tuple[str, ...], inside: bool) -> str:
    """What class names and ids say an element is: ``comments``, ``other`` parts outside an article, or nothing.
    Only the head of a name counts, its last word before words for boxes and places."""
    said = ""
    for name in names:
        words = _NAME.findall(name)
        if not words or words[0] in ("has", "with", "no", "is"):
            continue
        head = len(words)
        while head > 1 and (words[head - 1] in _BOXES or words[head - 1].isdigit()):
            head -= 1
        if _COMMENT_NAMES.fullmatch(words[head - 1]):
            return "comments"
        if _DROP_NAMES.fullmatch(words[head - 1]) or (
                not inside and ("".join(words) in _HEADER_NAMES or words[head - 1] == "header")):
            said = "other"
    return said


def _dropped(page: Page) -> list[bool]:
    """Whether each element, or one around it, is no part of an article.

    Tags and roles decide. A name, or a ``form``, is evidence only: around the densest element and with more
    text than there is outside such elements it stands for the article's own wrapper; elsewhere it counts if
    the element has little text or mostly links, or names comments.
    """
    tags, parents, size = page.tags, page.parents, len(page.tags)
    holds = [False] * size
    for node in range(size - 1, 0, -1):
        if holds[node] or tags[node] in _LANDMARKS or page.roles[node] == "main":
            holds[parents[node]] = True
    sure, inside, said = [False] * size, [False] * size, [""] * size
    for node in range(1, size):
        tag, up = tags[node], parents[node]
        inside[node] = inside[up] or tag in _LANDMARKS
        if sure[up] or tag in _RAW or tag in _DROP_TAGS and not holds[node]:
            sure[node] = True
        elif tag == "body" or holds[node]:
            pass
        elif not inside[node] and (page.roles[node] in _DROP_ROLES or tag == "header"):
            sure[node] = True
        else:
            said[node] = _named(page.names[node], inside[node])
            if tag in _LANDMARKS and said[node] != "comments":
                said[node] = ""
            elif tag == "form" and not said[node]:
                said[node] = "form"
    if not any(said):
        return sure
    # Of each element, the blocks with text.
    block, parts = list(range(size)), [0] * size
    for node in range(1, size):
        if tags[node] not in _BLOCK:
            block[node] = block[parents[node]]
    for node, text in page.events:
        if text and not sure[node] and not text.isspace():
            parts[block[node]] = 1
    for node in range(size - 1, 0, -1):
        parts[parents[node]] += parts[node]
    # No wrapper: comments, and what has one block. The densest element is sought elsewhere first.
    doubtful = sure[:]
    for node in range(1, size):
        doubtful[node] |= doubtful[parents[node]] or said[node] == "comments" or bool(said[node]) and parts[node] < 2
    counts, density, sums = _densities(page, doubtful)
    if not counts.chars[0]:
        counts, density, sums = _densities(page, sure)
    path, node = set(), _densest(page, density, sums)
    while node >= 0:
        path.add(node)
        node = parents[node]
    every = _densities(page, sure)[0]
    plain = [c - k for c, k in zip(every.chars, every.link_chars)]
    # Of each element its text without links outside any such element in it.
    own, lost = plain[:], [0] * size
    for node in range(size - 1, 0, -1):
        own[node] -= lost[node]
        lost[parents[node]] += plain[node] if said[node] else lost[node]
    outside = plain[0] - lost[0]
    out = sure[:]
    for node in range(1, size):
        if out[node] or out[parents[node]]:
            out[node] = True
        elif said[node]:
            wrapper = node in path and parts[node] > 1 and plain[node] > outside
            if wrapper and (said[node] != "form" or plain[node] >= _LITTLE) and (said[node] != "comments" or not outside):
                outside += own[node]
            elif said[node] != "other" or plain[node] < max(_LITTLE, outside / 4) or every.link_chars[node] >= plain[node]:
                out[node] = True
    return out


def _density(chars: int, tags: int, link_chars: int, link_tags: int, whole: float) -> float:
    if not chars:
        return 0.0
    t, lc, lt = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * lc + whole * chars + math.e)
    return chars / t * max(math.log(chars / lc * t / lt), 0.0) / math.log(base)


class _Counts(NamedTuple):
    """Of each element: characters and tags in it, and those of links."""

    chars: list[int]
    tags: list[int]
    link_chars: list[int]
    link_tags: list[int]
    linked: list[bool]

    @property
    def whole(self) -> float:
        return self.link_chars[0] / max(self.chars[0], 1)


def _densities(page: Page, out: list[bool]) -> tuple[_Counts, list[float], list[float]]:
    """Each element's counts, its composite text density and the sum over its children."""
    size = len(page.tags)
    chars, tags, link_chars, link_tags = [0] * size, [0] * size, [0] * size, [0] * size
    linked = [False] * size
    for node in range(1, size):
        linked[node] = page.tags[node] == "a" or linked[page.parents[node]]
    for node, text in page.events:
        if text and not out[node]:
            count = len(" ".join(text.split()))
            chars[node] += count
            if linked[node]:
                link_chars[node] += count
    for node in range(size - 1, 0, -1):
        if out[node]:
            continue
        up = page.parents[node]
        chars[up] += chars[node]
        link_chars[up] += link_chars[node]
        tags[up] += tags[node] + 1
        link_tags[up] += link_tags[node] + (page.tags[node] == "a")
    counts = _Counts(chars, tags, link_chars, link_tags, linked)
    density, sums = [0.0] * size, [0.0] * size
    for node in range(size):
        if not out[node]:
            density[node] = _density(chars[node], tags[node], link_chars[node], link_tags[node], counts.whole)
    for node in range(1, size):
        sums[page.parents[node]] += density[node]
    return counts, density, sums


def _densest(page: Page, density: list[float], sums: list[float]) -> int:
    leaf = [True] * len(page.tags)
    for up in page.parents[1:]:
        leaf[up] = False
    return max(range(len(page.tags)), key=lambda n: (density[n] if leaf[n] else sums[n], -n))


def _runs(page: Page, out: list[bool], above: set[int], target: int) -> list[tuple[list[int], set[int]]]:
    """The runs of text that stand directly in an element of the path, with the inline elements in between:
    places among the events, and those elements. A run ends where a block begins or ends."""
    tags, parents = page.tags, page.parents
    blocks = [tag in _BLOCK for tag in tags]
    for node in range(len(tags) - 1, 0, -1):
        blocks[parents[node]] |= blocks[node]
    top = [0] * len(tags)
    for node in range(1, len(tags)):
        top[node] = node if parents[node] in above else top[parents[node]]
    runs, places, inline, of = [], [], set(), -1
    for place, (node, text) in enumerate(page.events):
        child = -1 if node in above else top[node]
        if text is None or child >= 0 and blocks[child]:
            if places:
                runs.append((places, inline))
            places, inline = [], set()
        elif not out[node] and child != target:
            parent = node if child < 0 else parents[child]
            if places and parent != of:
                runs.append((places, inline))
                places, inline = [], set()
            of = parent
            places.append(place)
            if child >= 0:
                inline.add(child)
    if places:
        runs.append((places, inline))
    return runs


def _chosen(page: Page, out: list[bool]) -> tuple[list[bool], set[int]]:
    """Whether each element belongs to the article, and the places among the events of texts that stand
    directly in elements around it and do."""
    tags, parents = page.tags, page.parents
    counts, density, sums = _densities(page, out)
    target = _densest(page, density, sums)
    path = [target]
    while path[-1] > 0 and tags[path[-1]] != "body":
        path.append(parents[path[-1]])
    threshold = min(density[n] for n in path)
    least = min(counts.chars[n] / max(counts.tags[n], 1) for n in path)

    def reaches(chars: int, inside: int, link_chars: int, link_tags: int) -> bool:
        """A composite density grows with the tags inside, so a part without links, which has nothing to be
        weighed down by, is held against the path's characters per tag too."""
        return _density(chars, inside, link_chars, link_tags, counts.whole) >= threshold or (
            not link_chars and not link_tags and chars >= least * max(inside, 1) > 0)

    around = [n for n in path if tags[n] in _LANDMARKS]
    def of(node: int) -> tuple[int, int, int, int]:
        return counts.chars[node], counts.tags[node], counts.link_chars[node], counts.link_tags[node]

    chosen = [False] * len(tags)
    chosen[target] = True
    above = set(path[1:])
    for node in range(1, len(tags)):
        if out[node] or node in above:
            continue
        if parents[node] in above:
            chosen[node] |= reaches(*of(node)) or tags[node] in _HEADINGS
        if tags[node] in _LANDMARKS:
            chosen[node] |= density[node] > 0 and reaches(*of(node))
    if around:
        chosen[around[-1]] = True
    _add_weak_siblings(page, out, above, counts, chosen)
    bare: set[int] = set()
    for places, inline in _runs(page, out, above, target):
        chars = link_chars = 0
        for node, text in (page.events[p] for p in places):
            count = len(" ".join(text.split()))
            chars += count
            link_chars += count if counts.linked[node] else 0
        inside = sum(counts.tags[n] + 1 for n in inline)
        link_tags = sum(counts.link_tags[n] + (tags[n] == "a") for n in inline)
        if chars and reaches(chars, inside, link_chars, link_tags):
            bare.update(places)
    for node in range(1, len(tags)):
        chosen[node] |= chosen[parents[node]]
    return [c and not o for c, o in zip(chosen, out)], bare


def _add_weak_siblings(page: Page, out: list[bool], above: set[int], counts: _Counts, chosen: list[bool]) -> None:
    """Adds the short blocks of an article: children of the path's elements, not mostly links, that stand
    between two kept ones, and paragraphs beside a kept paragraph or one around the densest element."""
    children: dict[int, list[int]] = {}
    for node in range(1, len(page.tags)):
        if page.parents[node] in above and not out[node]:
            children.setdefault(page.parents[node], []).append(node)
    for nodes in children.values():
        kept = [i for i, n in enumerate(nodes) if chosen[n] or n in above]
        if not kept:
            continue
        paragraphs = any(page.tags[nodes[i]] == "p" for i in kept)
        for i, node in enumerate(nodes):
            if node not in above and 2 * counts.link_chars[node] <= counts.chars[node]:
                chosen[node] |= kept[0] < i < kept[-1] or paragraphs and page.tags[node] == "p"


def main_text(source: str) -> str:
    """The article of a page: its blocks in order, one a line, white space as one space."""
    page = Page(source)
    chosen, bare = _chosen(page, _dropped(page))
    lines, line = [], []
    for place, (node, text) in enumerate(page.events):
        if text is None:
            if line:
                lines.append(" ".join("".join(line).split()))
                line = []
        elif chosen[node] or place in bare:
            line.append(text)
    if line:
        lines.append(" ".join("".join(line).split()))
    return "\n".join(x for x in lines if x)


def extracted(source: str | Column = "html") -> Column:
    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.decode("utf-8", "replace")) for p in pages.to_pylist()], pa.string())

    return extract(utf8(source))
