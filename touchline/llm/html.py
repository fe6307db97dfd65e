"""Operator 5: main text of web pages by minimum-cut labelling of blocks."""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, text_of

NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
STOP = re.compile(r"[\"'>]")
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")
# HTML's own element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
NEVER = frozenset("head title script style noscript template textarea svg iframe object math select option button input datalist".split())
CLOSED_BY = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"])}
CLOSES_P = frozenset("address article aside blockquote details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
# Elements whose content is no text of the page.
RAW = frozenset("script style noscript template textarea svg iframe object math".split())
#: Log-odds of elements by what HTML itself says of them.
TAG_ODDS = {"nav": -8.0, "footer": -8.0, "aside": -8.0, "form": -8.0, "menu": -8.0, "dialog": -8.0, "header": -6.0, "article": 4.0, "main": 3.0}
#: Elements that are text, whatever they are called: no name speaks against them.
TEXT = frozenset("article main p blockquote pre h1 h2 h3 h4 h5 h6 figure figcaption html body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names that say what an element is; the first kind is believed where it stands, the second inside of the article only
#: with links or little text, see ``speaks``.
PLAIN_HINT = re.compile(r"(?:^|[_-])(?:ads?|advert\w*|sponsor\w*|cookies?|consent|gdpr|popup|modal|newsletter|breadcrumbs?|pagination|pager|comments?|comment-?\w*|replies|reply|disqus|respond|taboola|outbrain)(?:$|[_-])", re.I)
VAGUE_HINT = re.compile(r"(?:^|[_-])(?:promo\w*|banner|notice|alert|subscribe|signup|login|nav\w*|menu|sidebar|side|widget|related|recommend\w*|share|sharing|social|footer|header|masthead|copyright|legal|toolbar|skip|search|tags?)(?:$|[_-])", re.I)
GOOD_HINT = re.compile(r"(?:^|[_-])(?:article|articlebody|post|entry|content|main|story|body|text)(?:$|[_-])", re.I)
#: The number of a reader's comment.
NUMBERED = re.compile(r"(?:c|comment|reply)[_-]?[0-9]+", re.I)
#: Words that tell a page's state or an article's subject, not what an element is.
STATE = re.compile(r"(?:has|is|no|with|without|hide|show)[_-].*|.*[_-](?:open|opened|closed|enabled|disabled|visible|collapsed|expanded|active|inactive|on|off)|(?:tags?|category|cat)[_-].+", re.I)
BAD_ODDS, GOOD_ODDS, LINK_ODDS, LENGTH_ODDS = -8.0, 1.5, -4.0, 0.02
#: Inside of the article: the share of linked text, or the characters of other text, from or up to which a vague name counts.
LINKED, LITTLE = 0.3, 100
#: What a block starts from: anywhere, and outside of <article> and <main> on a page that has one; on a page that has none,
#: a heading, which goes with what follows, and a few words without an end that stand in no paragraph.
BASE_ODDS, OUTSIDE_ODDS, HEADING_ODDS, LABEL_ODDS, LABEL = 0.3, -3.5, -0.2, -1.2, 40
#: Capacity of the edge between neighbours in page order, and between blocks of one parent.
NEXT_EDGE, SIBLING_EDGE = 0.6, 1.2


class Hint:
    """What the names of an element say, and how much text it holds, outside and inside of links."""

    __slots__ = ("above", "holds_article", "inside", "linked", "odds", "plain", "vague")

    def __init__(self, above: Hint | None, odds: float, vague: bool, inside: bool):
        self.above, self.odds, self.vague, self.inside, self.plain, self.linked, self.holds_article = above, odds, vague, inside, 0, 0, False


class Block:
    __slots__ = ("headed", "hint", "inside", "linked", "odds", "parent", "parts", "tag", "text")

    def __init__(self, element: Element, inside: bool):
        self.parent, self.tag, self.odds, self.hint, self.headed = element.block, element.block_tag, element.odds, element.hint, element.headed
        self.inside, self.parts, self.linked, self.text = inside, [], 0, ""


class Element:
    """An open element: what it and those around it say."""

    __slots__ = ("block", "block_tag", "headed", "hint", "odds", "quoted", "shown", "tag")

    def __init__(self, tag: str = "", above: Element | None = None, number: int = 0):
        self.tag, self.odds, self.hint, self.shown, self.quoted, self.headed, self.block, self.block_tag = tag, 0.0, None, True, False, 0.0, 0, ""
        if above:
            self.odds, self.hint, self.shown, self.quoted, self.headed, self.block, self.block_tag = above.odds, above.hint, above.shown, above.quoted, above.headed, above.block, above.block_tag
        if tag not in INLINE:
            self.block, self.block_tag = number, tag


def tags_of(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Start, end, whether it closes, name and attributes of every tag; comments,
    declarations and elements that hold no text have no name.

    A quote opens a value only after an equals sign.  Where one is never closed
    all tags from there on end at the next bracket, so the page is gone through
    twice at most.
    """
    at, last, broken = 0, page.rfind(">"), False
    while (start := page.find("<", at)) >= 0:
        at = start + 1
        after = page[at : at + 1]
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            yield start, at, False, "", ""
            continue
        if start > last:
            continue
        if after in ("!", "?"):
            at = page.find(">", start) + 1
            yield start, at, False, "", ""
            continue
        name = NAME.match(page, at + (after == "/"))
        if not name:
            continue
        i, end = name.end(), -1
        while not broken and end < 0:
            stop = STOP.search(page, i)
            if stop is None:
                broken = True
            elif stop[0] == ">":
                end = stop.end()
            elif page[max(name.end(), stop.start() - 64) : stop.start()].rstrip().endswith("="):
                close = page.find(stop[0], stop.end())
                broken, i = close < 0, close + 1
            else:
                i = stop.end()
        at = end if end >= 0 else page.find(">", name.end()) + 1
        tag = name[0].lower()
        attributes = page[name.end() : at - 1]
        if tag in RAW and after != "/":
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            tag = ""
        yield start, at, after == "/", tag, attributes


def read_attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), "".join(values))
    return out


def is_hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true" or "display:none" in SPACE.sub("", attributes.get("style", "")).lower()


def hint_of(tag: str, attributes: dict[str, str], began: bool) -> tuple[float, bool]:
    """Log-odds of an element's names, and whether they need support.  Only
    classes and roles are names; an id may tell a subject, and counts where it
    numbers a comment once the text has ``began``."""
    if began and tag in ("div", "li", "section") and NUMBERED.fullmatch(attributes.get("id", "").strip()):
        return BAD_ODDS, False
    words = [w for w in f"{attributes.get('class', '')} {attributes.get('role', '')}".split() if not STATE.fullmatch(w)]
    if tag in ("article", "main"):  # only a whole word speaks against them
        bad = any((m := p.match(w)) and m.end() == len(w) for w in words for p in (PLAIN_HINT, VAGUE_HINT))
        return (BAD_ODDS, False) if bad else (0.0, False)
    if tag not in TEXT:
        if any(PLAIN_HINT.search(w) for w in words):
            return BAD_ODDS, False
        if any(VAGUE_HINT.search(w) for w in words):
            return BAD_ODDS, True
    return (GOOD_ODDS if any(GOOD_HINT.search(w) for w in words) else 0.0), False


def speaks(hint: Hint) -> bool:
    """Whether a name counts: not where the element holds the article, and a
    vague one within the article only if links or little text support it."""
    if hint.odds >= 0:
        return True
    if hint.holds_article:
        return False
    return not (hint.vague and hint.inside) or hint.linked >= LINKED * (hint.plain + hint.linked) or hint.plain < LITTLE


def blocks_of(page: str) -> tuple[list[Block], bool]:
    """Blocks of visible text in page order, with what their ancestors say, and
    whether the page marks its article.

    A forgiving reader: an end tag closes up to its start tag if that is open
    and is ignored otherwise; what is open at the end of the page is closed.
    The first article or main without a name against it is the article; names of
    the elements around it are void, as are those of elements that hold the
    first h1 and half of the text outside of links.  Each tag costs a bounded
    time, but for the elements that it closes.
    """
    stack, counts = [Element()], Counter()
    marked = False
    headed: Hint | None = None
    hints: list[Hint] = []
    out: list[Block] = []
    current: Block | None = None
    seen = number = at = 0

    def add(raw: str) -> None:
        nonlocal current, seen
        if not raw or not stack[-1].shown:
            return
        if current is None:
            if raw.isspace():
                return
            current = Block(stack[-1], counts["article"] + counts["main"] > 0)
            out.append(current)
        current.parts.append(raw)
        seen += len(raw)
        if counts["a"]:
            current.linked += len(raw)

    def close(to: int) -> None:
        for element in stack[to:]:
            counts[element.tag] -= 1
        del stack[to:]

    for start, end, closes, tag, text in tags_of(page):
        add(page[at:start])
        at = end
        if not tag:
            if text:
                add(" ")
            continue
        if tag == "br":
            add(" ")
            continue
        if tag not in INLINE:
            current = None
        if closes:
            if counts[tag] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if tag in CLOSES_P or tag in CLOSED_BY:
            shut = CLOSED_BY.get(tag, CLOSED_BY["p"])
            if any(counts[t] > 0 for t in shut):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in shut:
                        close(i)
                        break
                    if stack[i].tag not in INLINE and stack[i].tag != "p":
                        break
        if tag in VOID or text.rstrip().endswith("/"):
            continue
        number += 1
        above = stack[-1]
        element = Element(tag, above, number)
        attributes = read_attributes(text) if text.strip() else {}
        odds, vague = hint_of(tag, attributes, seen > 200) if attributes and tag not in ("html", "body") else (0.0, False)
        element.shown = above.shown and tag not in NEVER and not is_hidden(attributes)
        inside = marked and counts["article"] + counts["main"] > 0
        element.quoted = above.quoted or tag in ("blockquote", "figure")
        own = 0.0 if element.quoted and tag in ("footer", "header") else TAG_ODDS.get(tag, 0.0)
        element.odds += own
        if tag == "header" and inside:
            element.headed += own  # its headings are the article's
        if element.shown and not marked and odds >= 0 and tag in ("article", "main"):
            marked, around = True, above.hint
            while around and not around.holds_article:
                around.holds_article, around = True, around.above
        if element.shown and tag == "h1" and headed is None:
            headed = above.hint
        if odds:
            element.hint = Hint(above.hint, odds, vague, inside)
            hints.append(element.hint)
        stack.append(element)
        counts[tag] += 1
    tail = page[at:]
    cut = re.search(r"<[/!?a-zA-Z]", tail)
    add(tail[: cut.start()] if cut else tail)
    kept = []
    for b in out:
        b.text = SPACE.sub(" ", html.unescape("".join(b.parts))).strip()
        if b.text:
            kept.append(b)
            if b.hint:
                b.hint.plain += max(0, len(b.text) - b.linked)
                b.hint.linked += min(len(b.text), b.linked)
    for h in reversed(hints):  # elements come after those around them
        if h.above:
            h.above.plain += h.plain
            h.above.linked += h.linked
    whole = sum(max(0, len(b.text) - b.linked) for b in kept)
    while headed:
        headed.holds_article = headed.holds_article or 2 * headed.plain >= whole
        headed = headed.above
    total: dict[int, float] = {}
    for h in hints:
        total[id(h)] = (total[id(h.above)] if h.above else 0.0) + (h.odds if speaks(h) else 0.0)
    for b in kept:
        b.odds += (total[id(b.hint)] if b.hint else 0.0) - (b.headed if b.tag in HEADINGS else 0.0)
    return kept, marked and any(b.inside for b in kept)


def min_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut.

    A positive ``gain`` is the capacity from the source, a negative one to the
    sink; ``edges`` are undirected.  Dinic's algorithm, without recursion: level
    graph by breadth-first search, then blocking flow by walking paths.
    """
    n = len(gain)
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to, room = [], []

    def link(a: int, b: int, forth: float, back: float) -> None:
        head[a].append(len(to))
        head[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((forth, back))

    for i, g in enumerate(gain):
        link(s, i, g, 0.0) if g > 0 else link(i, t, -g, 0.0)
    for a, b, c in edges:
        link(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        left, path, a = [0] * (n + 2), [], s
        while True:
            if a == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while left[a] < len(head[a]):
                e = head[a][left[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    break
                left[a] += 1
            if left[a] < len(head[a]):
                path.append(head[a][left[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                left[a] += 1
            else:
                break


def odds_of(b: Block, marked: bool) -> float:
    """The classifier: log-odds that a block is content."""
    base = OUTSIDE_ODDS if marked and not b.inside else BASE_ODDS
    if not marked and b.tag in HEADINGS and b.tag != "h1":
        base = HEADING_ODDS
    elif not marked and b.tag in ("div", "section") and len(b.text) < LABEL and b.text[-1] not in ".!?:;…”\"":
        base = LABEL_ODDS
    return base + max(-24.0, min(8.0, b.odds)) + min(2.0, LENGTH_ODDS * len(b.text)) + LINK_ODDS * min(1.0, b.linked / max(1, len(b.text)))


def main_text(page: str) -> str:
    blocks, marked = blocks_of(page)
    gain = [odds_of(b, marked) for b in blocks]
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i and (b.odds >= 0) == (blocks[i - 1].odds >= 0):
            edges.append((i - 1, i, NEXT_EDGE))
        if b.parent in last:
            edges.append((last[b.parent], i, SIBLING_EDGE))
        last[b.parent] = i
    keep = min_cut(gain, edges)
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``.

    Blocks of text are the nodes of a graph.  The classifier's log-odds of each
    become capacities from the source (content) or to the sink (boilerplate);
    neighbours in page order and blocks of one parent are tied by smoothness
    edges; a minimum cut labels all blocks of a page at once.  The costs come
    from HTML's own elements, links, lengths and places; names of elements count
    only as said at ``speaks``, and never against paragraphs, headings, quotes.  One narrow pass,
    a page at a time.  Null, empty and malformed pages give what text they
    have, very long ones all of theirs; repeated rows give repeated results, an
    empty table an empty one; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    bounded_batches(pages.sparkSession)
    own = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), text_of(html_col).alias("html"))
    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")
