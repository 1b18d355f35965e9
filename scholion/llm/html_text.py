"""Main text of web pages by consensus host paths.

Every page scores its containers and votes for the generalised tag and class path of the best
one; the votes are counted per host in Spark, and each page is extracted again from the
container that its host's winning path names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.llm.common import broadcast_if_small, slices, written

# HTML elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style textarea title xmp iframe noembed noframes noscript template svg math".split()
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul caption".split()
)
CONTAINERS = frozenset("html body main article section div td blockquote center".split())
#: Elements that never hold main text.
AWAY = frozenset("nav footer aside form menu dialog button select option datalist label head fieldset object canvas audio video map".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form status".split())
#: Words of classes and ids that name menus, adverts, notices, comments and the like.
AWAY_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner banners promo promos promoted promotion sponsor "
    "sponsored sponsors nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager sidebar sidebars "
    "aside rail widget widgets footer footers footnav masthead topbar toolbar header headers site-header cookie cookies consent "
    "gdpr notice notices alert alerts popup popups modal overlay dialog newsletter subscribe subscription signup login share sharing "
    "social related recommended recommendations teaser teasers comment comments commentlist respond reply replies "
    "discussion disqus reader-comments form search searchbox skip-link print-only hidden sr-only copyright legal disclaimer".split()
)
#: Of these words, those that name sections of an article as well, in classes and ids, or in ids only.
WEAK_WORDS = frozenset("discussion legal header headers search".split())
WEAK_IDS = WEAK_WORDS | frozenset("related recommended recommendations social alert alerts comment reply share promotion".split())
#: Words of layout that may stand beside one of AWAY_WORDS in a name without changing what it names.
LAYOUT_WORDS = frozenset(
    "area article articles bar block body bottom box button buttons card center col column component container content count "
    "desktop entries entry field first global group head holder icon icons info inner input item items js last latest left "
    "link links list main message messages meta mobile module more news outer page panel policy popular post posts primary "
    "reader readers region right row secondary section site slot small stories story strip text thread title top unit user "
    "users wrap wrapper zone".split()
)
TALK_WORDS = frozenset("comment comments commentlist disqus reader-comments respond reply replies".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names of page feet; outside the main container only, as a foot inside it may hold notes.
FOOT_NAMES = frozenset("foot page-foot site-foot".split())
CLOSES_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dt", "dd", "legend", "summary", "figcaption"}
#: An element that, when it opens, ends an open one of these, up to the named holder.
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table", "tbody", "thead", "tfoot"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tbody": (frozenset({"tbody", "thead", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
    "tfoot": (frozenset({"tbody", "thead", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}

#: A quoted value may hold ">"; if that leaves the tag without an end, the first ">" ends it.
#: Nothing here is tried twice, so broken markup takes no longer than whole markup.
IN_TAG = r"""(?:(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|["'=])*+(?=>)|[^>]*+)"""
#: The groups c1 to c3 say that a comment, a CDATA section or a raw element has no end.
MARKUP = re.compile(
    r"<!--.*?(?:-->|(?P<c1>\Z))|<!\[CDATA\[.*?(?:\]\]>|(?P<c2>\Z))|<[!?][^>]*+>"
    rf"|<(?P<raw>{'|'.join(RAW)})\b{IN_TAG}>.*?(?:</(?P=raw)\s*+[^>]*+>|(?P<c3>\Z))"
    r"|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*+>"
    rf"|<(?P<open>[a-zA-Z][^\s/>]*+)(?P<attrs>{IN_TAG})>",
    re.S | re.I,
)
#: What begins a comment or the like after the last ">" reaches to the end.
TAIL = re.compile(r"<[!?]")
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACES = re.compile(r"\s+")
DIGITS = re.compile(r"\d+")
NAME_WORDS = re.compile(r"[-_:\d]+")
#: The best container holds at least this share of a page's main text; what stands beside it is
#: looked at on its own.
ENOUGH = 0.7
#: Beside links, plain text shorter than this is a label; a copyright line is shorter than that.
LABEL = 40
COPYRIGHT = 200


class Link(str):
    """Text of a link."""

    __slots__ = ()


class Node:
    __slots__ = ("away", "depth", "foot", "kids", "mass", "maybe", "name", "parent", "step", "sure", "talk")

    def __init__(self, name: str, step: str, away: bool, parent: Node | None):
        self.name, self.step, self.away, self.parent = name, step, away, parent
        self.kids: list = []  # nodes and pieces of text, in page order
        self.mass = 0
        self.foot = self.maybe = self.sure = self.talk = False
        self.depth = parent.depth + 1 if parent else 0

    def path(self) -> str:
        steps, node = [], self
        while node.parent is not None:
            steps.append(node.step)
            node = node.parent
        return ">".join(reversed(steps))


def _away_name(name: str, weak: frozenset) -> bool | None:
    """Whether a class or id names what is no main text: True, False, or None if its text has to
    tell, as in "related-work", where a word of AWAY_WORDS stands beside one of content."""
    words = {w for w in NAME_WORDS.split(name) if len(w) > 1}
    hits = AWAY_WORDS & (words | {name})
    if not hits:
        return False
    if name in AWAY_WORDS and name not in weak:
        return True
    return None if hits <= weak or words - AWAY_WORDS - LAYOUT_WORDS else True


def _opened(name: str, attrs: str, parent: Node) -> Node:
    """The node of a start tag: its step of the path and whether it holds no main text."""
    values = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attrs)} if attrs.strip("/ \n") else {}
    classes = values.get("class", "").lower().split()
    step = name + "".join("." + DIGITS.sub("#", c) for c in sorted(set(classes)))
    node = Node(name, step, name in AWAY, parent)
    if values and not node.away and name not in ("html", "body"):
        own = values.get("id", "").lower()
        names = [*classes, own]
        words = {w for n in names for w in (n, *NAME_WORDS.split(n))}
        node.foot = not FOOT_NAMES.isdisjoint(names)
        style = values.get("style", "").replace(" ", "").lower()
        node.away = (
            values.get("role", "").lower() in AWAY_ROLES
            or "hidden" in values
            or values.get("aria-hidden") == "true"
            or "display:none" in style
            or "visibility:hidden" in style
        )
        article = name in ("article", "main") or words & {"article", "post", "entry", "story"} and "content" in words
        if not node.away and not article:
            told = [_away_name(c, WEAK_WORDS) for c in classes] + [_away_name(own, WEAK_IDS)]
            node.away = True in told
            node.maybe = None in told and name not in HEADINGS
        node.talk = not TALK_WORDS.isdisjoint(words)
    return node


def parse(html: str) -> Node:
    """Block elements as a tree with the text between them; inline markup is dropped, unclosed
    elements end with their parent. No tag begins after the last ">"; what stands there is text,
    or belongs to a comment, a CDATA section or a raw element without an end. A link ends at the
    latest where a block begins or ends."""
    top = here = Node("", "", False, None)
    at, last = 0, html.rfind(">") + 1
    cut = None
    link = False
    for m in MARKUP.finditer(html, 0, last):
        cut = m["c1"] is not None or m["c2"] is not None or m["c3"] is not None
        if m.start() > at:
            piece = html[at : m.start()]
            here.kids.append(Link(piece) if link else piece)
        at = m.end()
        name = (m["open"] or m["close"] or "").lower()
        if name == "a":
            link = m["open"] is not None and "href" in m["attrs"].lower()
        elif name in BLOCKS:
            link = False
        if m["close"] and name in BLOCKS or m["close"] and name in AWAY:
            node = here
            while node.parent is not None and node.name != name:
                if name not in ("body", "html", "article", "main", "div", "section") and node.name in ("td", "th", "table") and name not in ("tr", "table", "tbody", "thead", "tfoot"):
                    break
                node = node.parent
            if node.parent is not None and node.name == name:
                here = node.parent
        elif m["open"]:
            if name == "br":
                here.kids.append(" ")
                continue
            if name not in BLOCKS and name not in AWAY:
                if "=" in m["attrs"] or "hidden" in m["attrs"]:
                    node = _opened(name, m["attrs"], here)
                    if node.away and name not in VOID:  # an inline element that is hidden or an advert
                        here.kids.append(node)
                        here = node
                elif here.away and here.name == name:
                    here = _nested(here, name)
                continue
            if name in ("html", "body") and here.parent is not None and any(n == name for n in _names(here)):
                continue
            if name in CLOSES_P:
                here = _ended(here, frozenset({"p"}), CONTAINERS | {"li", "td", "th", "dd", "dt", "figure", "table"})
            if name in ENDS:
                here = _ended(here, *ENDS[name])
            if name == "body" or name in BLOCKS and here.name == "head":
                while here.name == "head":
                    here = here.parent
            node = _opened(name, m["attrs"], here)
            here.kids.append(node)
            if name not in VOID and name != "hr":
                here = node
        elif m["close"] and here.name == name and here.parent is not None:
            here = here.parent
        elif m.group().startswith("<![CDATA["):
            here.kids.append(m.group()[9:].removesuffix("]]>"))
    if not (cut and at == last):
        tail = html[at:]
        begun = TAIL.search(tail, last - at)
        here.kids.append(tail[: begun.start()] if begun else tail)
    elif m["c2"] is not None:
        here.kids.append(html[last:])
    return top


def _nested(here: Node, name: str) -> Node:
    node = Node(name, name, True, here)
    here.kids.append(node)
    return node


def _names(node: Node) -> Iterator[str]:
    while node.parent is not None:
        yield node.name
        node = node.parent


def _ended(here: Node, names: frozenset, holders: frozenset) -> Node:
    """Close the outermost open element of `names` that no holder encloses."""
    node, found = here, None
    while node.parent is not None and node.name not in holders - names:
        if node.name in names:
            found = node
        node = node.parent
    return found.parent if found else here


def weigh(node: Node) -> list[Node]:
    """Set each node's mass, the characters of main text below it, and list its containers. An
    element whose name leaves it open is put away if its text is boilerplate."""
    out: list[Node] = []
    stack: list[tuple[Node, bool]] = [(node, False)]
    while stack:
        n, done = stack.pop()
        if n.away:
            n.mass = 0
            continue
        if not done:
            stack.append((n, True))
            stack += [(k, False) for k in n.kids if isinstance(k, Node)]
            continue
        n.mass = sum(k.mass if isinstance(k, Node) else len(k.strip()) for k in n.kids)
        # readers' comments below, and nothing but labels beside them
        n.talk = any(isinstance(k, Node) and k.talk and not k.mass for k in n.kids)
        if n.maybe:
            n.sure = holds_text(n, sentences=n.talk)
            n.away = not n.sure
            n.mass = n.mass if n.sure else 0
        if n.mass and (n.name in CONTAINERS or n.parent is None):
            out.append(n)
    return out


def mark_page_headers(node: Node) -> None:
    """A header element is a page's own unless it lies in an article or main element."""
    stack = [(node, False)]
    while stack:
        n, inside = stack.pop()
        inside = inside or n.name in ("article", "main")
        for k in n.kids:
            if isinstance(k, Node):
                if k.name == "header" and not inside:
                    k.away = True
                stack.append((k, inside))


def best_container(containers: list[Node]) -> Node | None:
    """The deepest container that holds most of the page's main text; if an article or main
    element does, the largest such article, else such a main element."""
    if not containers:
        return None
    total = max(c.mass for c in containers)
    enough = [c for c in containers if c.mass >= ENOUGH * total]
    marked = [c for c in enough if c.name in ("article", "main") or c.step.startswith(("article", "main"))]
    articles = [c for c in marked if c.name == "article"] or marked
    if articles:
        return max(articles, key=lambda c: c.mass)
    return min(enough, key=lambda c: (c.mass, -c.depth))


def parts(node: Node) -> Iterator[Node | list[str]]:
    """The blocks right below a node and the runs of text between them, in page order."""
    run: list[str] = []
    for k in node.kids:
        if isinstance(k, str):
            run.append(k)
        elif k.name in BLOCKS or k.name in AWAY:
            if run:
                yield run
                run = []
            yield k
    if run:
        yield run


def holds_text(part: Node | list[str], sentences: bool = False) -> bool:
    """Whether a part is more than boilerplate: links with their labels, a page's foot or a
    copyright line. A linked headline is text. With sentences, labels alone are none."""
    total = links = 0
    stack: list = [part]
    while stack:
        p = stack.pop()
        if isinstance(p, list):
            text = SPACES.sub(" ", unescape("".join(p))).strip()
            if not text or text[0] == "©" and len(text) < COPYRIGHT:
                continue
            linked = sum(len(SPACES.sub(" ", unescape(k)).strip()) for k in p if isinstance(k, Link))
            if len(text) - linked >= LABEL:
                return True
            total += len(text)
            links += linked
        elif p.mass and not p.away and not p.foot:
            if p.sure or not sentences and p.name in ("h1", "h2") and text_of(p):
                return True
            stack += parts(p)
    return not sentences and 2 * links < total


def with_siblings(node: Node) -> Node:
    """The nearest ancestor that holds all text beside the container, too; the boilerplate on
    the way there is put away."""
    whole = node
    while node.parent is not None:
        above = node.parent
        kids: list = []
        for part in parts(above):
            if part is not node:
                if holds_text(part):
                    whole = above
                elif isinstance(part, Node):
                    part.away = True
                else:
                    continue
            kids += part if isinstance(part, list) else [part]
        above.kids = kids
        node = above
    return whole


def text_of(node: Node) -> str:
    """Blocks of the container in page order, one to a line."""
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = SPACES.sub(" ", unescape("".join(line))).strip()
        line.clear()
        if text:
            blocks.append(text)

    stack: list = [node]
    while stack:
        k = stack.pop()
        if k is None:
            end()
        elif isinstance(k, str):
            line.append(k)
        elif not k.away:
            block = k.name in BLOCKS
            if block:
                end()
                stack.append(None)
            stack += reversed(k.kids)
        elif k.name in BLOCKS or k.name in AWAY:
            end()
    end()
    return "\n".join(blocks)


def page_containers(html: str) -> tuple[Node | None, list[Node]]:
    top = parse(html)
    mark_page_headers(top)
    containers = weigh(top)
    return best_container(containers), containers


def main_text(html: str, path: str | None) -> tuple[str, str]:
    """The main text and the path it came from: the container that the path names, if the page
    has it, else the page's own best one, with the text blocks beside it."""
    best, containers = page_containers(html)
    if best is None:
        return "", ""
    steps = path.split(">") if path else []
    named = [c for c in containers if c.depth == len(steps) and c.step == steps[-1] and c.path() == path] if steps else []
    if named and best not in named:
        chosen = max(named, key=lambda c: c.mass)
        around = best
        while around is not None and around is not chosen:
            around = around.parent
        # a container around the best one adds what stands beside the latter
        best = best if around is chosen else chosen
    whole = with_siblings(best)
    return text_of(whole), whole.path()


def host_of(url: Column) -> Column:
    """Lower-case host without a port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def page_votes(pages: DataFrame) -> DataFrame:
    """(host, path, mass) of every page with text: the path of its best container."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            rows = []
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                best, _ = page_containers(html)
                if best is not None:
                    rows.append((host, best.path(), best.mass))
            made = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[0], pa.string()), pa.array(made[1], pa.string()), pa.array(made[2], pa.int64())], names=["host", "path", "mass"]
            )

    return pages.select(host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html")).mapInArrow(
        run, "host string, path string, mass long"
    )


def winning_paths(votes: DataFrame) -> DataFrame:
    """One path per host: most votes, then most text, then the first by name. Sums are made
    before the exchange, so a host of any size is a few rows by then."""
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("mass").alias("mass"))
    return counted.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), -F.col("mass"), F.col("path"))).alias("path"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, path.

    Null and empty pages, and pages of markup alone, have empty text. Pages without a host vote
    together. A page is extracted from the container that the winning path names, or from its own
    best one if it has none there, together with all text blocks beside it; only boilerplate is
    left out. Repeated rows are pages of their own; an empty table gives no rows; extra columns
    are ignored. Pages are read twice and never exchanged
    while the table of hosts is small; beyond that they are joined with it by host, where
    adaptive execution splits large hosts.
    """
    hosts = written(winning_paths(page_votes(pages)))
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    joined = keyed.join(broadcast_if_small(hosts), "host", "left").select("page_id", "url", "html", F.col("path").alias("won"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            found = [main_text(h, p) for h, p in zip(batch.column("html").to_pylist(), batch.column("won").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array([t for t, _ in found], pa.string()), pa.array([p for _, p in found], pa.string())],
                names=["page_id", "url", "text", "path"],
            )

    return joined.mapInArrow(run, "page_id long, url string, text string, path string")
