"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text at block-level tags. A linear classifier over a
block's ancestors, links, length and punctuation gives it a cost for either label;
these are its capacities to the two terminals. Smoothness edges tie blocks that
follow each other and blocks with a common parent, the stronger the nearer they are
in the tree. The minimum cut, found by maximum flow after fixing all blocks whose
own cost outweighs their edges, separates content from boilerplate. Names of boilerplate,
article elements and links weigh more than edges; what short lines, cells and items are
is weak evidence, which their neighbours outweigh (``won_by_the_cut`` counts these).

A name of boilerplate counts for all an element holds, but not where the element holds
the page's main part, its longest article, or most of its text (``_excused``); inside an
article a name counts only if all its words tell of boilerplate or of nothing, so that
"related-work" is a section. Items of a list have the label of a paragraph beside their
list. A heading that counts comments opens them, to the end of its parent.

A page is one row and one unit of work; nothing is shuffled. Reading it takes time in
proportion to its length: elements are known by number, and unclosed tags and quotes
are looked for once.

Defined cases: a null or empty html has an empty text; broken markup is read as far
as it goes, an unclosed comment, script or style hides the rest of the page; a page
without any content block has an empty text. Repeated rows are read one by one;
extra columns are kept, those named text or n_chars are replaced.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from skylag.llm.common import table

# Element names and words of class, id and role attributes.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu"
    " nav noscript ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript svg math iframe object textarea select button title".split())
RAW = frozenset("script style template noscript svg math iframe object textarea select title".split())
CHROME = frozenset("nav footer aside form menu dialog fieldset".split())
MAIN = frozenset("article main".split())
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline-share comment comments"
    " consent cookie cookies disqus feedback footer form gdpr login masthead menu menubar modal nav navbar"
    " navigation newsletter notice notices overlay pagination paywall popup promo promoted promotion recommended"
    " related replies reply search share sharing sidebar signup social sponsor sponsored subscribe subscription"
    " toolbar widget contentinfo complementary alert alertdialog responses respond".split()
)
# Words that leave it to the others of a name what it tells.
PLAIN_WORDS = frozenset(
    "area article articles aside bar block blocks body bottom box btn button buttons card cards col column container"
    " content count div entry field fields foot form global group head heading header icon icons inline inner item items"
    " js label layout left link links list lists main mid module more news note outer panel post posts primary region"
    " right row secondary section site slot small stories story sub text title top unit view wrap wrapper zone".split()
)
# Parts of words that tell as much wherever they stand: "commentlist", "sitefooter".
BAD_PARTS = re.compile("advert|breadcrumb|comment|cookie|disqus|footer|navbar|navigation|newsletter|pagination|sidebar|sponsor|subscri")
# Names that tell what an element has beside or below it, not what it is.
STATE = re.compile(r"(?:has|no|not|with|without)[-_].*|.*[-_](?:open|closed|enabled|disabled)|(?=.*(?:content|main)).*[-_]wrap(?:per)?")
LISTS = frozenset("ul ol dl".split())
GOOD_WORDS = frozenset("article content entry main post story text".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile("[>\"']")
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_UNSEEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.I)
_WORD = re.compile(r"[a-z]+")
_ENDS = re.compile(r"[.!?…。](?:[\"'”’)\]]*)(?:\s|$)")

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Headings that open what readers say.
_SAYS = re.compile(r"(?:\d+|no|one|two|three) (?:comment|thought|response|reply|replies)s?\b.*|comments?(?: ?\(\d+\))?|(?:leave|post) a (?:comment|reply)", re.I)

# Costs in hundredths: positive for content.
BAD_CONTAINER, IN_MAIN, GOOD_NAME, HEADING, PARAGRAPH, IN_ITEM, BARE = -1500, 350, 150, 100, 60, -60, -80
PER_CHAR, MOST_CHARS, ENDED, LINKED, LINKED_IN_MAIN = 2, 150, 100, -500, -320
FOLLOWS, SIBLINGS = 120, 80


class _Block:
    __slots__ = ("article", "bad", "beside", "good", "linked", "name", "named", "near", "parent", "text")


class _Tags:
    """The tags of a page, one after another, in time proportional to its length."""

    def __init__(self, html: str):
        self.html, self.loose, self.raw_end = html, False, 0
        self.missing = {'"': False, "'": False, ">": False, "-->": False}

    def _find(self, what: str, at: int) -> int:
        """The next place of ``what``; once there is none, that is remembered."""
        if self.missing[what]:
            return -1
        place = self.html.find(what, at)
        self.missing[what] = place < 0
        return place

    def _end(self, at: int) -> int:
        """Behind the tag whose attributes start at ``at``: the first > outside quotes; -1
        if there is none at all. Once quotes leave none outside, they do not count."""
        first = self._find(">", at)
        place = at
        while first >= 0 and not self.loose:
            stop = _STOP.search(self.html, place)
            if stop and stop.group() == ">":
                return stop.end()
            close = self._find(stop.group(), stop.end()) if stop else -1
            self.loose = close < 0
            place = close + 1
        return first + 1 if first >= 0 else -1

    def __iter__(self) -> Iterator[tuple[int, int, str, str, bool]]:
        """(start, end, name, attributes, closing); a comment or other markup has no name."""
        html, at = self.html, 0
        while (start := html.find("<", at)) >= 0:
            if html.startswith("<!--", start):
                close = self._find("-->", start + 4)
                at = len(html) if close < 0 else close + 3
                yield start, at, "", "", False
            elif html[start + 1 : start + 2] in ("!", "?") and start + 1 < len(html):
                close = self._find(">", start)
                at = len(html) if close < 0 else close + 1
                yield start, at, "", "", False
            else:
                closing = html.startswith("/", start + 1)
                name = _NAME.match(html, start + 1 + closing)
                end = self._end(name.end()) if name else -1
                if end < 0:
                    at = start + 1
                    continue
                at, word, attributes = end, name.group().lower(), html[name.end() : end - 1]
                if word in RAW and not closing and not attributes.endswith("/"):
                    # What it holds is no markup.
                    close = re.compile(rf"</{re.escape(word)}\s*>", re.I).search(html, end)
                    self.raw_end = at = close.end() if close else len(html)
                yield start, end, word, attributes, closing


class _Element:
    """An open element: what its ancestors and its own names say of the text in it."""

    __slots__ = ("article", "bad", "barrier", "beside", "good", "link", "name", "named", "number", "owner")


class _Page:
    """Blocks of a page, its elements by number, and what ties names to them."""

    def __init__(self):
        self.blocks: list[_Block] = []
        self.up: list[int] = [0]  # of each element of a bad name, the one it lies in
        self.mains: list[int] = []
        self.articles: dict[int, tuple[int, int]] = {}  # article: the one around it, the bad name it lies in
        self.closed: dict[int, int] = {}  # elements: how many blocks there were when they ended


def _telling(attributes: str, name: str, in_main: bool) -> tuple[set[str], set[str]]:
    """All words of an element's names, and those that tell what it is."""
    words, telling = set(), set()
    for names in _NAMES.finditer(attributes):
        for one in (names.group(2) or names.group(3) or names.group(4) or "").lower().split():
            found = _WORD.findall(one)
            words.update(found)
            if STATE.fullmatch(one):
                continue
            if in_main or (name in HEADINGS and names.group(1).lower() == "id"):
                # A name of its own, not one of boilerplate: "related-work".
                if any(w not in BAD_WORDS and w not in PLAIN_WORDS and not BAD_PARTS.search(w) for w in found):
                    continue
            telling.update(found)
    return words, telling


def parsed(html: str) -> _Page:
    """Blocks of text in page order, with what their ancestors say of them."""
    page = _Page()
    root = _Element()
    root.name, root.number, root.bad, root.good, root.link, root.named = "", 0, False, 0, False, 0
    root.article, root.owner, root.beside, root.barrier = 0, 0, None, 0
    stack, places = [root], {}  # places: of each name, where it is open
    pieces: list[str] = []
    linked, elements, at, lowest = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked, lowest
        text = " ".join("".join(pieces).split()) if pieces else ""
        if text:
            top, block = stack[-1], _Block()
            owner = stack[top.owner]
            depth = top.owner
            block.text, block.linked, block.name = text, min(1.0, linked / len(text)), owner.name
            block.parent = stack[max(depth - 1, 0)].number if depth else -1
            block.bad, block.good, block.named, block.beside, block.article = top.bad, top.good, top.named, top.beside, top.article
            # Depth of this block and of the nearest element that also holds the one before.
            block.near = (depth, min(lowest, depth))
            page.blocks.append(block)
            lowest = depth
        pieces.clear()
        linked = 0

    def pop_to(size: int) -> None:
        nonlocal lowest
        while len(stack) > size:
            gone = stack.pop()
            places[gone.name].pop()
            page.closed[gone.number] = len(page.blocks)
        lowest = min(lowest, size)

    tags = _Tags(html)
    for start, end, name, attributes, closing in tags:
        text = html[at:start]
        at = end
        if text:
            text = unescape(text) if "&" in text else text
            pieces.append(text)
            if stack[-1].link:
                linked += len(text)
        if not name:
            continue
        if name == "br":
            pieces.append(" ")
        if name in BLOCK:
            flush()
        if closing:
            if places.get(name) and (name in BLOCK or places[name][-1] >= stack[-1].barrier):
                pop_to(places[name][-1])
            continue
        if name in RAW and not attributes.endswith("/"):
            at = tags.raw_end
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if name in BLOCK:
            while len(stack) > 1 and stack[-1].name not in BLOCK and any(e.name == "p" for e in stack[-8:]):
                pop_to(len(stack) - 1)  # inline elements left open in a paragraph end with it
            if stack[-1].name == "p":
                pop_to(len(stack) - 1)
            if stack[-1].name in CLOSES.get(name, ()):
                pop_to(len(stack) - 1)
        over, new = stack[-1], _Element()
        in_main = over.good & 1
        words, telling = _telling(attributes, name, bool(in_main))
        # A header inside the article holds its title; any other is the page's.
        bad = over.bad or name in CHROME or name in HIDDEN or bool(_UNSEEN.search(attributes)) or (not in_main and name == "header")
        ill = not in_main and name not in MAIN and "header" in telling
        if telling and name not in ("html", "body"):
            ill = ill or not BAD_WORDS.isdisjoint(telling) or any(map(BAD_PARTS.search, telling))
        elements += 1
        new.name, new.number, new.bad, new.link = name, elements, bad, over.link or name == "a"
        new.good = over.good | (1 if name in MAIN else 0) | (0 if GOOD_WORDS.isdisjoint(words) else 2)
        new.named, new.article = over.named, over.article
        if ill:
            page.up.append(over.named)
            new.named = len(page.up) - 1
        if name == "main" and not bad:
            page.mains.append(new.named)
        elif name == "article" and not bad and not ill:
            page.articles[elements] = (over.article, over.named)
            new.article = elements
        new.owner = len(stack) if name in BLOCK else over.owner
        new.barrier = len(stack) if name in ("td", "th", "table", "body") else over.barrier
        new.beside = over.number if over.beside is None and name in LISTS else over.beside
        places.setdefault(name, []).append(len(stack))
        stack.append(new)
    if at < len(html):
        text = html[at:]
        pieces.append(unescape(text) if "&" in text else text)
        linked += len(text) if stack[-1].link else 0
    flush()
    pop_to(1)
    return page


def blocks(html: str) -> list[_Block]:
    """Blocks of text in page order, each with whether it stands in boilerplate."""
    page = parsed(html)
    excused = _excused(page)
    clear = [True] * len(page.up)
    for e in range(1, len(page.up)):
        clear[e] = e in excused and clear[page.up[e]]
    said = 0  # blocks up to here are what readers say
    for i, block in enumerate(page.blocks):
        block.bad = block.bad or not clear[block.named] or i < said
        if block.name in HEADINGS and _SAYS.fullmatch(block.text):
            block.bad, said = True, max(said, page.closed.get(block.parent, len(page.blocks)))
    return page.blocks


def _excused(page: _Page) -> set[int]:
    """Elements of bad names that hold the content of the page all the same.

    They hold a main element or the article of most text; or half of all text, if they
    also hold the title or if no paragraph stands outside elements of bad names.
    """
    count = len(page.up)
    if count == 1:
        return set()

    def around(e: int) -> Iterator[int]:
        while e and e not in excused:
            yield e
            e = page.up[e]

    excused: set[int] = set()
    plain = [b for b in page.blocks if not b.bad and b.linked < 0.5]
    paragraphs = [b for b in plain if b.name not in HEADINGS and _ENDS.search(b.text)]
    # Sums of what lies in each element itself, then of all it holds: inner ones come later.
    size, held, title = [0] * count, [0] * count, [False] * count
    for block in plain:
        size[block.named] += len(block.text)
        title[block.named] |= block.name == "h1"
    for block in paragraphs:
        held[block.named] += 1
    for e in range(count - 1, 0, -1):
        size[page.up[e]] += size[e]
        held[page.up[e]] += held[e]
        title[page.up[e]] |= title[e]
    for e in page.mains:
        excused.update(list(around(e)))
    if page.articles:
        texts = Counter(dict.fromkeys(page.articles, 0))
        for block in plain:
            if block.article:
                texts[block.article] += len(block.text)
        for e in reversed(page.articles):
            if page.articles[e][0]:
                texts[page.articles[e][0]] += texts[e]
        longest = max(page.articles, key=lambda e: (texts[e], -e))
        excused.update(list(around(page.articles[longest][1])))
    inside, direct = [True] * count, [0] * count
    for block in paragraphs:
        direct[block.named] += 1
    for e in range(1, count):
        inside[e] = e in excused and inside[page.up[e]]
    outside = any(n and k for n, k in zip(direct, inside, strict=True))
    for e in range(1, count):  # the outer ones first
        if held[e] > 1 and 2 * size[e] >= size[0] and (title[e] or not outside):
            excused.add(e)
        inside[e] = e in excused and inside[page.up[e]]
        outside = outside or bool(direct[e] and inside[e])
    return excused


def cost(block: _Block) -> int:
    """What calling the block boilerplate costs more than calling it content."""
    in_main = bool(block.good & 1)
    score = BAD_CONTAINER if block.bad else 0
    score += (IN_MAIN if in_main else 0) + (GOOD_NAME if block.good & 2 else 0)
    score += HEADING if block.name in ("h1", "h2", "h3") else PARAGRAPH if block.name == "p" else IN_ITEM if block.name in ("li", "td", "dd") else 0
    score += min(MOST_CHARS, PER_CHAR * len(block.text)) + (ENDED if _ENDS.search(block.text) else BARE)
    return score + int((LINKED_IN_MAIN if in_main else LINKED) * block.linked)


def edges(found: list[_Block]) -> list[tuple[int, int, int]]:
    """Smoothness: (block, block, capacity) of followers and of the next one below the same parent."""
    out, last_of = [], {}
    for i, block in enumerate(found):
        if i:
            depth, common = block.near
            # Steps from one block's parent up to what holds both, and down to the other's.
            out.append((i - 1, i, FOLLOWS // (1 + found[i - 1].near[0] + depth - 2 * common)))
        if block.parent in last_of and last_of[block.parent] != i - 1:
            out.append((last_of[block.parent], i, SIBLINGS))
        last_of[block.parent] = i
    return [e for e in out if e[2]]


def minimum_cut(costs: list[int], ties: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay on the side of content in a cut of least capacity.

    A node whose own cost is no less than all its ties keeps its label in some
    minimum cut; fixing it moves its ties to its neighbours' costs. Flow is only
    needed for what cannot be fixed so.
    """
    costs, near = list(costs), [{} for _ in costs]
    for a, b, w in ties:
        near[a][b] = near[a].get(b, 0) + w
        near[b][a] = near[b].get(a, 0) + w
    label: list[bool | None] = [None] * len(costs)
    waiting = deque(range(len(costs)))
    while waiting:
        i = waiting.popleft()
        if label[i] is None and abs(costs[i]) >= sum(near[i].values()):
            label[i] = costs[i] > 0
            for j, w in near[i].items():
                costs[j] += w if label[i] else -w
                del near[j][i]
                waiting.append(j)
            near[i] = {}
    rest = [i for i, x in enumerate(label) if x is None]
    if rest:
        content = _flow(rest, costs, near)
        for i in rest:
            label[i] = i in content
    return label


def _flow(nodes: list[int], costs: list[int], near: list[dict[int, int]]) -> set[int]:
    """Nodes reached from the source once no more flow fits, by shortest augmenting paths."""
    source, sink = -1, -2
    room: dict[int, dict[int, int]] = {source: {}, sink: {}, **{i: dict(near[i]) for i in nodes}}
    for i in nodes:
        a, b = (source, i) if costs[i] > 0 else (i, sink)
        room[a][b] = abs(costs[i])
        room[b].setdefault(a, 0)
    while True:
        came, queue = {source: source}, deque([source])
        while queue and sink not in came:
            i = queue.popleft()
            for j, left in room[i].items():
                if left and j not in came:
                    came[j] = i
                    queue.append(j)
        if sink not in came:
            return set(came) - {source}
        path, j = [], sink
        while j != source:
            path.append((came[j], j))
            j = came[j]
        most = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= most
            room[b][a] = room[b].get(a, 0) + most


def leaders(found: list[_Block]) -> list[int]:
    """Of each block the one whose label it has: of an item of a list, the last paragraph
    before its list or else the first after it, with the same parent; of others itself."""
    lead = list(range(len(found)))
    for order in (lead[::-1], lead[:]):  # one before the list outdoes one after it
        last: dict[int, int] = {}
        for i in order:
            block = found[i]
            if block.bad or block.linked >= 0.5:
                continue
            if block.beside is None:
                if block.name == "p":
                    last[block.parent] = i
            elif block.beside in last:
                lead[i] = last[block.beside]
    return lead


def labelled(found: list[_Block]) -> tuple[list[bool], list[bool]]:
    """Of each block whether it is content, by its own cost alone and by the cut."""
    lead = leaders(found)
    costs = [cost(b) if lead[i] == i else 0 for i, b in enumerate(found)]
    ties = [(lead[a], lead[b], w) for a, b, w in edges(found) if lead[a] != lead[b]]
    labels = minimum_cut(costs, ties)
    return [costs[i] > 0 for i in lead], [labels[i] for i in lead]


def won_by_the_cut(html: str | None) -> tuple[int, int]:
    """How many blocks the cut made content, and how many boilerplate, against their own cost."""
    alone, cut = labelled(blocks(html or ""))
    return sum(c and not a for a, c in zip(alone, cut, strict=True)), sum(a and not c for a, c in zip(alone, cut, strict=True))


def main_text(html: str | None) -> str:
    """Text of the content blocks, two line feeds between them."""
    found = blocks(html or "")
    _, keep = labelled(found)
    return "\n\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


@F.pandas_udf(StringType())
def _main_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(main_text, na_action=None)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with text, the main text of html, and n_chars, its code points."""
    found = pages.withColumn("text", _main_text(F.col("html").cast("string")))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
