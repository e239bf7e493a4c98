"""Main text of HTML pages by minimum cut.

A page becomes a list of text blocks. A logistic classifier of block features, fitted on a small labelled
table, gives each block a cost for being content and one for being boilerplate: its capacities to the two terminals.
Blocks that follow each other, and blocks with the same parent element, are joined by edges of smoothness. The
maximum flow between the terminals separates content from boilerplate.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import small_batches

#: Elements by role. RAW have text that is no markup and not shown; HIDDEN have markup that is not shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title iframe noembed noframes".split())
HIDDEN = frozenset("svg template".split())
INLINE = frozenset("a abbr acronym audio b bdi bdo big br canvas cite code data del dfn em font i img input ins kbd label map mark math meter noscript object output picture progress q rp rt ruby s samp slot small span strike strong sub sup svg template time tt u var video wbr annotation menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("html body table ul ol dl div article section main aside nav footer header form".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog button select".split())
CONTENT = frozenset("article main".split())
SIGNS = re.compile(r"(?:^|[\s_-])(ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|newsletter|subscribe|share|social|related|sidebar|widget|menu|nav\w*|breadcrumbs?|footer|header|masthead|copyright|login|search|tags|toolbar|pagination)(?=$|[\s_-])", re.I)
#: Names of what readers write, and short lines that come with it again and again.
READERS = re.compile(r"(?:^|[\s_-])(comments?|commentlist|disqus|repl(?:y|ies)|respond|responses?|talkback|discussion|guestbook|reactions?)(?=$|[\s_-])", re.I)
REPLY = re.compile(r"^\W*(reply|reply to this|report|flag|like|upvote|permalink|quote)\W*$|\b(says|said|wrote|replied|commented|posted)\s*:?\s*$|\b(minutes?|hours?|days?|weeks?) ago\b", re.I)
LEGAL = re.compile(r"©|\(c\) ?\d{4}|\bcopyright\b|\ball rights reserved\b", re.I)

_HEAD = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
#: One attribute: its name, and the quote that begins its value or the value itself; or the end of the tag.
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:>|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:(["'])|([^\s>]*+)))?+)""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in (*RAW, "textarea")}


@dataclass(slots=True)
class Block:
    text: str
    tag: str
    parent: int
    links: int
    content: bool
    keep: bool
    element: int
    boilerplate: bool = False
    header: bool = False
    sign: bool = False
    outside: bool = False


class _Open:
    """An open element, with what it has from those around it; ``block`` is the nearest that is not inline."""

    __slots__ = ("tag", "number", "content", "keep", "link", "hidden", "block", "above")

    def __init__(self, tag: str, number: int, over: "_Open | None" = None, keep: bool = False):
        self.tag, self.number = tag, number
        if over is None:
            self.content = self.link = self.keep = self.hidden = False
            self.block, self.above = self, number
            return
        self.content = over.content or tag in CONTENT
        self.link = over.link or tag == "a"
        self.hidden = over.hidden or tag in HIDDEN
        self.keep = over.keep or keep
        self.block = over.block if tag in INLINE else self
        self.above = over.number


#: Marks of elements.
_BOILERPLATE, _HEADER, _SIGN, _READERS, _MAIN, _ARTICLE, _TITLE = (1 << k for k in range(7))


def _marks(tag: str, values: str, content: bool) -> int:
    """What an element's tag and its class, id and role say of it."""
    found = _BOILERPLATE if tag in BOILERPLATE else _HEADER if tag == "header" and not content else _MAIN if tag == "main" else _ARTICLE if tag == "article" else _TITLE if tag == "h1" else 0
    if values:
        found |= (_SIGN if SIGNS.search(values) else 0) | (_READERS if READERS.search(values) else 0)
    return found


def _judge(blocks: list[Block], above: list[int], marks: list[int]) -> None:
    """Hand the marks of elements down to their blocks, but not those of elements that hold the page's text.

    A word in the class of a wrapper says nothing of the article in it. An element holds the page's text if at least half of all
    text without links is in it, with the title, an article or the main element, or four fifths of it without one, and no more content
    elements are outside than inside. Where the class tells of readers, the title or main element must be inside. An element with two lines or more that come with
    readers' comments, and no title or content element, is one of these too.
    """
    n = len(above)
    text, content, replies, inside = [0] * n, [0] * n, [0] * n, [0] * n
    for b in blocks:
        size = len(b.text) - b.links
        text[b.element] += size
        content[b.element] += size if b.content else 0
        replies[b.element] += len(b.text) <= 80 and bool(REPLY.search(b.text))
        inside[b.element] |= marks[b.element] if b.text else 0
    for k in range(n - 1, 0, -1):
        text[above[k]] += text[k]
        content[above[k]] += content[k]
        replies[above[k]] += replies[k]
        inside[above[k]] |= inside[k] | (marks[k] if text[k] else 0)
    whole, marked = max(text[0], 1), content[0]
    down = [0] * n
    for k in range(1, n):
        own, within = marks[k] & (_BOILERPLATE | _HEADER | _SIGN | _READERS), inside[k]
        if own and 2 * content[k] >= marked:
            told = within & (_TITLE | _MAIN if own & _READERS else _TITLE | _MAIN | _ARTICLE)
            if (told and 2 * text[k] >= whole) or (not own & _READERS and 5 * text[k] >= 4 * whole):
                own = 0
        if not own and replies[k] >= 2 and 2 * content[k] <= marked and not within & (_TITLE | _MAIN) and not marks[k] & (_MAIN | _ARTICLE) and 10 * text[k] < 9 * whole:
            own = _READERS
        down[k] = down[above[k]] | own
    for b in blocks:
        d = down[b.element]
        b.boilerplate, b.header, b.sign = bool(d & _BOILERPLATE), bool(d & _HEADER), bool(d & (_SIGN | _READERS))
        b.outside = 4 * marked >= whole and not b.content


class _Stack:
    """The open elements, with the places of each tag and of those that bound an implied end."""

    def __init__(self):
        self.open = [_Open("html", 0)]
        self.places: dict[str, list[int]] = {}
        self.scopes = [0]

    def push(self, element: _Open) -> None:
        self.places.setdefault(element.tag, []).append(len(self.open))
        if element.tag in SCOPES:
            self.scopes.append(len(self.open))
        self.open.append(element)

    def last(self, tags) -> int:
        """The place of the innermost open element with one of the tags; 0 if there is none."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def cut(self, place: int) -> None:
        """End the element at a place and all inside it."""
        while len(self.open) > place:
            tag = self.open.pop().tag
            self.places[tag].pop()
            if tag in SCOPES:
                self.scopes.pop()


class _Tags:
    """Ends of the tags of a page, in time that grows with its length."""

    def __init__(self, page: str):
        self.page, self.last = page, {c: page.rfind(c) for c in ">\"'"}
        self.plain = False  # after a tag whose quotes leave it without an end, each tag ends at the first >

    def end(self, at: int) -> tuple[int, str, bool]:
        """Where the tag whose name ends at ``at`` ends, or -1; the values of class, id and role; and whether it has the mark ``keep``."""
        page = self.page
        gt = page.find(">", at) if at <= self.last[">"] else -1
        if gt < 0 or gt == at:
            return gt + 1 or -1, "", False
        if self.plain:
            return gt + 1, "", False
        values, keep = "", False
        while True:
            m = _ATTRIBUTE.match(page, at)
            if m is None:  # the page ends first
                self.plain = True
                return gt + 1, "", False
            name, quote, value = m.groups()
            at = m.end()
            if name is None:
                return at, values, keep
            if quote:
                close = page.find(quote, at) if at <= self.last[quote] else -1
                if close < 0:
                    self.plain = True
                    return gt + 1, "", False
                value, at = page[at:close], close + 1
            if len(name) < 6:
                name = name.lower()
                if value and name in ("class", "id", "role"):
                    values += " " + value
                keep = keep or name == "keep"


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order; scripts, styles and hidden elements give none.

    An element without end tag ends with the one around it, or where its kind implies an end. An attribute value
    whose quote is never closed does not count as quoted, nor do later ones. A comment, script or style that is never closed
    goes on to the end of the page; other elements of raw text count as empty then. Nesting has no limit.
    """
    found: list[Block] = []
    stack, tags = _Stack(), _Tags(page)
    top = stack.open[0]
    parts: list[str] = []
    links = 0
    above, marks = [0], [0]
    endless: set[str] = set()

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join((parts[0] if len(parts) == 1 else "".join(parts)).split())
            if text:
                at = top.block
                found.append(Block(text, at.tag, at.above, links, at.content, at.keep, at.number))
            parts.clear()
        links = 0

    def say(text: str) -> None:
        nonlocal links
        if not in_head and not top.hidden:
            parts.append(entities.unescape(text) if "&" in text else text)
            if top.link:
                links += len(text)

    at, end, in_head = 0, len(page), False
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        if lt > at:
            say(page[at:lt])
        at = lt
        m = _HEAD.match(page, at)
        if m is None:
            following = page[at + 1 : at + 2]
            if page.startswith("<!--", at):
                close = at + 4 if page.startswith(">", at + 4) else at + 5 if page.startswith("->", at + 4) else page.find("-->", at + 4) + 2
                at = end if close < 4 else close + 1
            elif following and following in "!?/" and at <= tags.last[">"]:
                at = page.find(">", at) + 1
            else:
                say("<")
                at += 1
            continue
        after, values, keep = tags.end(m.end())
        if after < 0:
            say("<")
            at += 1
            continue
        closing, at, tag = page[at + 1] == "/", after, m[1].lower()
        if closing:
            if tag == "head":
                in_head = False
            elif tag == "p" or tag not in INLINE:
                flush()
            if place := stack.last((tag,)):
                stack.cut(place)
                top = stack.open[-1]
            continue
        if tag in RAW or tag == "textarea":
            close = None if tag in endless else _RAW_END[tag].search(page, at)
            if close is None:
                endless.add(tag)
                if tag in ("script", "style"):
                    break
                continue
            if tag == "textarea":
                say(" " + page[at : close.start()] + " ")
            after = tags.end(close.end())[0]
            at = end if after < 0 else after
            continue
        if tag == "head":
            in_head = True
            continue
        if tag == "body" or (in_head and tag not in VOID):
            in_head = False
        if tag in ("html", "body"):
            flush()
            continue
        if top.hidden and (tag == "p" or tag in CLOSES_P) and (place := stack.last(("svg",))):
            stack.cut(place)  # a drawing holds no such elements, so it was not closed
            top = stack.open[-1]
        if tag == "br":
            say(" ")
        elif tag not in INLINE:
            flush()
        if tag in VOID or ((top.hidden or tag in ("svg", "math")) and page.startswith("/>", at - 2)):
            continue
        ended = ("p",) if tag in CLOSES_P else SIBLINGS.get(tag)
        if ended and (place := stack.last(ended)) > stack.scopes[-1]:
            stack.cut(place)
            top = stack.open[-1]
        above.append(top.number)
        top = _Open(tag, len(marks), top, keep)
        marks.append(_marks(tag, values, top.content))
        stack.push(top)
    flush()
    _judge(found, above, marks)
    return found


FEATURES = ("one", "in content element", "in boilerplate element", "in page header", "class says boilerplate", "paragraph", "heading", "list item", "share of links", "all links", "long", "sentences", "outside of the page's content elements", "legal line outside of content elements")


def features(b: Block) -> list[float]:
    n = len(b.text)
    share = min(1.0, b.links / max(n, 1))
    return [1.0, b.content, b.boilerplate, b.header, b.sign, b.tag in ("p", "blockquote", "pre", "td", "figcaption", "dd"), b.tag in ("h1", "h2", "h3", "h4", "h5", "h6"), b.tag in ("li", "dt"), share, share > 0.8, min(1.0, n / 120), any(x in b.text for x in ".!?"), b.outside, n < 200 and not b.content and bool(LEGAL.search(b.text))]


def labelled_pages() -> list[str]:
    """A small labelled table, built by rule: pages whose elements with the attribute ``keep`` are content."""
    menu = '<ul><li><a href="/a">News</a></li><li><a href="/b">Sports today</a></li><li><a href="/c">About us</a></li></ul>'
    long = "The council met on Tuesday and agreed to a plan for the river, which had been under discussion for years. Work starts in May."
    texts = [long, "Short.", "It rains!", "A note by the editor, in one line", long + " " + long, "See <a href=x>the plan</a> for more, said the mayor."]
    out = []
    for k in range(24):
        body = "".join(f"<p keep>{texts[(k + j) % len(texts)]}</p>" for j in range(1 + k % 5))
        if k % 3 == 0:
            body += "<ul keep><li>one thing that was said</li><li>two</li></ul>"
        if k % 4 == 1:
            body += '<aside><p>Read more about rivers here.</p></aside><div class="ad">Buy a boat now, it is cheap. Best price.</div><p keep>And so it goes on.</p>'
        if k % 5 == 2:
            body += '<section class="comments"><p>First! I do not agree with this at all.</p><p>Well said.</p></section>'
        title = f"<h1 keep>{'River plan agreed' if k % 2 else 'Council'}</h1>"
        inner = f"<article>{title}{body}</article>" if k % 3 else f"<main>{title}{body}</main>" if k % 2 else f'<div class="content">{title}{body}</div>'
        top = f"<nav>{menu}</nav>" if k % 2 else f'<header><div class="logo">The Daily</div>{menu}</header>'
        notice = '<div class="cookie-notice">We use cookies to make this site better. <a href=#>Accept</a></div>' if k % 4 == 0 else ""
        ad = '<div class="ad">Cheap flights to the sun, book now.</div>' if k % 3 == 1 else ""
        side = f'<div class="sidebar"><h3>Related</h3>{menu}</div>' if k % 5 == 0 else ""
        form = "<form><label>Your mail</label> Sign up for our letter <button>Go</button></form>" if k % 6 == 0 else ""
        foot = "<footer>&copy; 2020 The Daily. All rights reserved.</footer>" if k % 4 else '<div class="footer"><p>Copyright The Daily. Terms apply.</p></div>'
        out.append(f"<html><head><title>x</title></head><body>{top}{notice}{ad}{inner}{side}{form}{foot}</body></html>")
    # Real layouts: telling names on wrappers, a form around the page, tables, readers without telling names, a plain line of copyright.
    readers = "".join(f"<div class=b><b>{who}</b><p>{text}</p><a href=#>Reply</a></div>" for who, text in (("Ann", "I was there and saw nothing of the kind, to be honest."), ("Bob", "Great. When does it start?"), ("Cy", "They said the same last year.")))
    wrappers = ('<div class="page with-sidebar">', '<div class="header-fixed">', '<div id="social">', '<form id="aspnetForm" method="post">', '<div class="layout"><table><tr><td class="nav-col">', '<div class="content-wrapper widget">')
    for k in range(24):
        body = "".join(f"<p keep>{texts[(3 * k + j) % len(texts)]}</p>" for j in range(2 + k % 4))
        title = f"<h1 keep>{'River plan agreed' if k % 2 else 'Council'}</h1>"
        article = f"<article>{title}{body}</article>" if k % 2 else f"<div class=text>{title}{body}</div>"
        open_ = wrappers[k % len(wrappers)]
        close = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", open_)))
        talk = f"<div id={'talkback' if k % 3 else 'x1'}><h3>What readers say</h3>{readers}</div>" if k % 4 < 2 else ""
        legal = "<p>&copy; 2021 The Daily Ltd. All rights reserved.</p>" if k % 3 else "<div>Copyright 2020 The Daily</div>"
        out.append(f"<html><body>{open_}<div>{menu}</div>{article}{talk}{legal}{close}</body></html>")
    return out


def train(rounds: int = 400, rate: float = 0.5, decay: float = 0.01) -> list[float]:
    """Weights of the classifier, by AdaGrad on the labelled table."""
    found = [b for page in labelled_pages() for b in blocks_of(page)]
    x, y = np.array([features(b) for b in found], float), np.array([b.keep for b in found], float)
    w, seen = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-8)
    for _ in range(rounds):
        grad = x.T @ (1 / (1 + np.exp(-x @ w)) - y) + decay * w
        seen += grad**2
        w -= rate * grad / np.sqrt(seen)
    return w.tolist()


#: Capacities of edges between blocks that follow each other, and that have one parent; most that a terminal may hold.
NEIGHBOUR, KIN, TERMINAL = 0.3, 0.4, 12.0


def source_side(n: int, source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Of n nodes, which are on the source's side of a minimum cut. ``edges`` hold in both directions.

    Flow goes along shortest ways, level by level. What a node can pass from source to sink directly is passed at once.
    """
    s, t = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    head: list[int] = []
    room: list[float] = []

    def link(a: int, b: int, forth: float, back: float) -> None:
        graph[a].append(len(head))
        head.append(b)
        room.append(forth)
        graph[b].append(len(head))
        head.append(a)
        room.append(back)

    for k in range(n):
        direct = min(source[k], sink[k])
        if source[k] > direct:
            link(s, k, source[k] - direct, 0.0)
        elif sink[k] > direct:
            link(k, t, sink[k] - direct, 0.0)
    for a, b, c in edges:
        link(a, b, c, c)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if room[e] > tiny and level[head[e]] < 0:
                    level[head[e]] = level[a] + 1
                    queue.append(head[e])
        if level[t] < 0:
            return [level[k] >= 0 for k in range(n)]
        following = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if room[e] <= tiny)
                a = head[path[cut] ^ 1]
                del path[cut:]
                continue
            while following[a] < len(graph[a]):
                e = graph[a][following[a]]
                if room[e] > tiny and level[head[e]] == level[a] + 1:
                    break
                following[a] += 1
            if following[a] < len(graph[a]):
                path.append(e)
                a = head[e]
            elif a == s:
                break
            else:
                a = head[path.pop() ^ 1]
                following[a] += 1


def separate(n: int, source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """``source_side``, after blocks that no edges can outvote are settled and left out.

    A block whose preference for one terminal is at least the sum of its edges is on that side in a minimum cut; its
    neighbours then lean to that side by their edge. The flow runs over what is left, one connected part after the other; its
    rounds grow with the length of runs of blocks that are nearly undecided.
    """
    lean = [a - b for a, b in zip(source, sink, strict=True)]
    around: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, c in edges:
        around[a].append((b, c))
        around[b].append((a, c))
    loose = [sum(c for _, c in x) for x in around]
    side: list[bool | None] = [None] * n
    ready = list(range(n))
    while ready:
        k = ready.pop()
        if side[k] is not None or abs(lean[k]) < loose[k]:
            continue
        side[k] = lean[k] > 0
        for j, c in around[k]:
            if side[j] is None:
                lean[j] += c if side[k] else -c
                loose[j] -= c
                ready.append(j)
    for first in range(n):
        if side[first] is not None:
            continue
        part, number, waiting = [], {first: 0}, [first]
        while waiting:
            k = waiting.pop()
            number[k] = len(part)
            part.append(k)
            for j, _ in around[k]:
                if side[j] is None and j not in number:
                    number[j] = -1
                    waiting.append(j)
        if all(lean[k] > 0 for k in part) or all(lean[k] <= 0 for k in part):
            on = [lean[first] > 0] * len(part)
        else:
            inside = [(number[k], number[j], c) for k in part for j, c in around[k] if j in number and j > k]
            on = source_side(len(part), [max(lean[k], 0.0) for k in part], [max(-lean[k], 0.0) for k in part], inside)
        for k, x in zip(part, on, strict=True):
            side[k] = x
    return [bool(x) for x in side]


def main_text(page: str, weights: list[float]) -> str:
    """The content blocks of a page in order, joined by line feeds."""
    found = blocks_of(page)
    source, sink, edges = [], [], []
    last: dict[int, int] = {}
    for k, b in enumerate(found):
        z = sum(w * x for w, x in zip(weights, features(b), strict=True))
        cost = math.log1p(math.exp(-abs(z)))
        source.append(min(TERMINAL, cost + max(z, 0.0)))  # what it costs to call it boilerplate
        sink.append(min(TERMINAL, cost + max(-z, 0.0)))
        if k:
            edges.append((k - 1, k, NEIGHBOUR))
        if b.parent in last:
            edges.append((last[b.parent], k, KIN))
        last[b.parent] = k
    side = separate(len(found), source, sink, edges)
    return "\n".join(b.text for b, content in zip(found, side, strict=True) if content)


def extract_main_text(pages: DataFrame, weights: list[float] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row.

    Null or empty html, and pages without content, give an empty text. Rows of equal id stay apart; null ids and urls
    pass through; other columns are not looked at. Whole pages of any length and nesting are read (see ``blocks_of`` for elements
    that are not closed).
    """
    small_batches(pages)
    weights = weights or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, weights) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
