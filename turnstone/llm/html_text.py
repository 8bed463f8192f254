"""Main text of web pages by composite text density (operator 5).

Every DOM node's density is its characters per tag, adjusted for links: nodes
whose text is mostly links score low.  A node's sum adds its children's
densities; the subtree with the largest sum holds the article, and the lowest
density on its path to the body is the threshold that its siblings must reach
to belong to it.

Names and classes are evidence only.  They take menus, forms, notices and the
like out of the tree before densities are computed, but not a node that holds
the page's heading, its articles or most of its text; and an ``article`` or
``main`` around the densest subtree gives its edges.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

_TAG = re.compile(
    r"""<(?:!--.*?(?:--!?>|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"<]*"|'[^'<]*'|[^>"'])*(?:>|\Z)|[^>]*(?:>|\Z)))""", re.S
)
_ATTR = re.compile(r"""([a-zA-Z_:][\w:.-]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text of another kind, up to their end tag whatever it holds.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Of these, a missing end tag swallows the rest of the page.
SWALLOWING = frozenset(["script", "style"])
#: Elements that are never part of the article.
DROPPED = frozenset("head nav footer menu button label option datalist noscript template svg math canvas object audio video select dialog".split())
#: Without an end tag these are taken for empty, lest they hide the rest of the page.
CLOSING = DROPPED - {"head", "footer", "option"}
#: Elements that are not part of it unless they hold it.
WEAK = frozenset("aside form fieldset header".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure form h1 h2 h3 h4 h5 h6 header hgroup html li main ol p pre search section summary table tbody td tfoot th thead tr ul caption".split())
CELLS = frozenset("td th".split())
HOLDERS = frozenset(["article", "main"])
#: Blocks in which an open paragraph outside them doesn't count.
_SCOPE = frozenset("table td th body html article section div aside form fieldset main blockquote ul ol dl".split())
#: Start tags that end an open element: which one, and what hides it.
ENDS = {
    "li": (("li",), frozenset("ul ol menu table td th article section".split())),
    "dt": (("dt", "dd"), frozenset(["dl"])),
    "dd": (("dt", "dd"), frozenset(["dl"])),
    "tr": (("tr", "td", "th"), frozenset(["table"])),
    "td": (("td", "th"), frozenset(["tr", "table"])),
    "th": (("td", "th"), frozenset(["tr", "table"])),
    "option": (("option",), frozenset(["select"])),
    "p": (("p",), _SCOPE),
}
#: End tags that reach over table cells.
_OVER_CELLS = frozenset("table tr tbody thead tfoot body html article main section div".split())

_CHROME = r"nav|navbar|navigation|menu|menubar|breadcrumbs?|pagination|pager|toolbar|sidebar|footer|masthead|skip|skiplink|contentinfo|complementary|search|searchbox"
_ADVERT = r"ads?|advert|adverts|advertisement|advertising|adsense|adslot|sponsor|sponsored|promo|promos|promoted|promotion|banner|outbrain|taboola"
_NOTICE = r"cookies?|cookiebar|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|paywall|alert|toast"
_OTHERS = r"widget|widgets|related|recommended|recommendations|social|sharing|sharebar|sharedaddy|tags|byline-share"
_READERS = r"comments?|commentlist|comment-list|respond|replies|disqus|discussion"
_WORD = rf"(?:{_CHROME}|{_ADVERT}|{_NOTICE}|{_OTHERS}|{_READERS})"
#: A class, id or role that is such a word, or has one at an end: ``site-footer``,
#: ``cookie-banner``.  ``has-sidebar`` or ``comments-open`` say something else.
_MARK = re.compile(rf"(?:{_WORD}|(?:[a-z0-9]+[-_])*{_WORD}|{_WORD}(?:[-_][a-z0-9]+)*|(?:share|sharing|social)[-_](?:buttons?|bar|links|tools|icons|box))\Z", re.I)
_SAYS_ELSE = re.compile(r"(?:^|[-_])(?:has|with|without|no|hide|hidden|is|show|open|closed|enabled|disabled|content|wrapper|page|body|layout|price|main|article|story|status)(?:$|[-_])", re.I)
_READERS_MARK = re.compile(rf"(?:^|[-_])(?:{_READERS})(?:$|[-_])", re.I)
#: Headings over what readers say or what else there is to read.
_AFTERWORD = re.compile(
    r"(?:\d+\s+)?(?:reader |user )?(?:comments?|responses?|replies)(?:\s*\(?\d*\)?)?|leave a (?:comment|reply)|join the (?:conversation|discussion)|post a comment|"
    r"(?:related|recommended|more|similar) (?:articles|posts|stories|reading|news|content)|you (?:may|might) also (?:like|enjoy)|read (?:more|next)|share this(?: \w+)?|subscribe(?: to .*)?|sign up(?: .*)?",
    re.I,
)
PLAIN, MARKED, READERS, NEVER = 0, 1, 2, 3


class Node:
    __slots__ = ("name", "parent", "items", "mark", "dropped", "open", "inside", "chars", "links", "tags", "link_tags", "holders", "top", "density", "total")

    def __init__(self, name: str, parent: Node | None, mark: int):
        self.name, self.parent, self.items, self.mark, self.dropped = name, parent, [], mark, mark == NEVER
        self.open: dict[str, Node | None] = {}
        self.inside = parent is not None and (parent.inside or parent.name in HOLDERS)
        self.chars = self.links = self.tags = self.link_tags = self.holders = self.top = 0
        self.density = self.total = 0.0

    def prose(self) -> int:
        return self.chars - self.links


def _mark_of(name: str, attrs: str, inside: bool) -> int:
    """How strongly an element's name and attributes speak against its being article text."""
    if name in DROPPED:
        return NEVER
    out = MARKED if name in WEAK and not (name == "header" and inside) else PLAIN
    if len(attrs) < 4:
        return out
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), a or b or c
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return NEVER
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return NEVER
        if key in ("class", "id", "role"):
            for token in value.split():
                if _MARK.match(token) and not _SAYS_ELSE.search(token):
                    out = max(out, READERS if _READERS_MARK.search(token) else MARKED)
    return out


def parse(page: str) -> Node:
    """A tree of elements and texts; unclosed and stray tags are tolerated.

    Each node knows the open elements that a tag can end, so that the work is
    linear in the page however deep it is nested.
    """
    root = node = Node("html", None, PLAIN)
    at, end = 0, len(page)
    cells: list[dict[str, int]] = [{}]  # names open in each nested table cell
    over: dict[str, int] = {}  # names open at all

    def pop(upto: Node) -> None:
        """Close *upto* and what is open in it."""
        nonlocal node
        while node is not root:
            done, node = node, node.parent
            over[done.name] -= 1
            if done.name in CELLS:
                cells.pop()
            cells[-1][done.name] = cells[-1].get(done.name, 1) - 1
            if done is upto:
                return

    def raw_end(name: str, start: int) -> int:
        shut = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, start)
        return shut.end() if shut else -1

    ends_at: dict[str, int] = {}

    def last_end(name: str) -> int:
        if name not in ends_at:
            ends_at[name] = max((m.start() for m in re.finditer(f"</{name}", page, re.I)), default=-1)
        return ends_at[name]

    never_ends: set[str] = set()
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            node.items.append(page[at:])
            break
        if m.start() > at:
            node.items.append(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if m["close"]:
            known = over if name in _OVER_CELLS else cells[-1]
            if known.get(name, 0) > 0 or (name in CELLS and node is not root and over.get(name, 0) > 0):
                up = node
                while up is not root and up.name != name:
                    up = up.parent
                if up is not root:
                    pop(up)
            elif name == "p" and node is not root:
                node.items.append("\0")
            continue
        if name in RAW:
            if not m["attrs"].endswith("/>") and name not in never_ends:
                shut = raw_end(name, at)
                if shut >= 0:
                    at = shut
                elif name in SWALLOWING:
                    at = end
                else:
                    never_ends.add(name)
            node.items.append(" ")
            continue
        if name in VOID:
            node.items.append("\n" if name == "br" else "\0" if name == "hr" else " ")
            continue
        if name in ("html", "body"):
            continue
        if name in CLOSING and at > last_end(name):
            node.items.append(" ")
            continue
        for ended in ENDS[name][0] if name in ENDS else ("p",) if name in BLOCKS else ():
            if (up := node.open.get(ended)) is not None:
                pop(up)
        child = Node(name, node, _mark_of(name, m["attrs"], node.inside or node.name in HOLDERS))
        node.items.append(child)
        if m["attrs"].endswith("/>") and name in ("span", "i", "b", "a", "svg", "path"):
            continue
        here = node.open
        hidden = [ended for ended, (_, hides) in ENDS.items() if name in hides and here.get(ended) is not None]
        if hidden or name in ENDS:
            here = {k: v for k, v in here.items() if k not in hidden}
            if name in ENDS:
                here[name] = child
        child.open = here
        node = child
        over[name] = over.get(name, 0) + 1
        cells[-1][name] = cells[-1].get(name, 0) + 1
        if name in CELLS:
            cells.append({})
    return root


def _ordered(root: Node) -> list[Node]:
    """The nodes that aren't dropped, children first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [x for x in node.items if isinstance(x, Node) and not x.dropped]
    order.reverse()
    return order


def _count(root: Node) -> list[Node]:
    """Count characters, tags and links bottom-up; the nodes, children first."""
    order = _ordered(root)
    for node in order:
        node.chars = node.links = node.tags = node.link_tags = node.holders = node.top = 0
        for x in node.items:
            if isinstance(x, str):
                node.chars += len("".join(x.split()))
            elif not x.dropped:
                node.chars += x.chars
                node.links += x.links
                node.tags += x.tags + 1
                node.link_tags += x.link_tags + (x.name == "a")
                node.holders += x.holders + (x.name in HOLDERS and not x.mark)
                node.top += x.top + (x.name == "h1")
        if node.name == "a":
            node.links = node.chars
    return order


def _drop_marked(root: Node) -> None:
    """Drop marked nodes, outermost first, but for those that hold the article."""
    _count(root)
    stack = [root]
    prose = max(root.prose(), 1)
    while stack:
        node = stack.pop()
        for x in node.items:
            if not isinstance(x, Node) or x.dropped:
                continue
            if x.mark:
                most, much = 2 * x.prose() > prose and x.tags > 0, 4 * x.prose() > prose
                heading = root.top > 0 and x.top == root.top
                articles = root.holders > 0 and x.holders == root.holders and much
                if x.mark == READERS:
                    holds = (articles or most) and heading
                elif root.holders:
                    holds = articles or (heading and most)
                else:
                    holds = most or (heading and much)
                if not holds:
                    x.dropped = True
                    continue
            stack.append(x)


def _drop_afterwords(root: Node) -> None:
    """Drop what stands under a heading such as "Comments" up to the next heading of its rank."""
    stack = [root]
    while stack:
        node = stack.pop()
        rank = 9
        for x in node.items:
            if not isinstance(x, Node) or x.dropped:
                continue
            if x.name in HEADINGS:
                own = int(x.name[1])
                if own <= rank:
                    rank = 9
                words = " ".join("".join(_texts(x)).split()) if x.chars < 80 else ""
                if own > 1 and rank == 9 and words and _AFTERWORD.fullmatch(words.rstrip(":.… ")):
                    rank = own
                    first = next((y for y in node.items if not isinstance(y, str) or y.strip()), None)
                    if x is first and node.parent is not None and node.name in BLOCKS and node.name not in HOLDERS and node.top == 0:
                        node.dropped = True
                        break
            if rank < 9:
                x.dropped = True
            else:
                stack.append(x)


def _texts(node: Node) -> list[str]:
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(html_lib.unescape(x))
        elif not x.dropped:
            stack += reversed(x.items)
    return out


def _measure(root: Node) -> list[Node]:
    """Composite densities and their sums; the nodes, children first."""
    order = _count(root)
    whole, linked = max(root.chars, 1), root.links
    for node in order:
        tags = max(node.tags, 1)
        node.density = node.total = 0.0
        if node.chars:
            base = math.log(node.chars / max(node.chars - node.links, 1) * node.links + linked / whole * node.chars + math.e)
            ratio = max(node.chars, 1) / max(node.links, 1) * tags / max(node.link_tags, 1)
            node.density = node.chars / tags * math.log(max(ratio, 1.0 + 1e-9), max(base, 1.01))
        node.total = sum(x.density for x in node.items if isinstance(x, Node) and not x.dropped)
    return order


def main_node(root: Node) -> tuple[Node, float]:
    """The subtree that holds the article, by the largest density sum, and the threshold of its path.

    From the densest subtree up, a parent takes its place if it adds siblings
    that reach the threshold, or the heading, or up to the edges of an enclosing
    article.  Only the siblings between the outermost of them stay in it.
    """
    order = _measure(root)
    best = max(order, key=lambda n: (n.total, n.density))
    threshold, node = best.density, best
    while node is not None:
        threshold = min(threshold, node.density)
        node = node.parent
    around = [best]
    while around[-1].parent is not None:
        around.append(around[-1].parent)
    edge = next((n for n in around if n.name in HOLDERS and not n.mark), None)
    if edge is not None:
        return edge, threshold
    inner = [n for n in order if n.name in HOLDERS and 2 * n.prose() > best.prose() and best in _above(n)]
    if inner:
        return max(inner, key=lambda n: (n.prose(), n.tags)), threshold
    place, child, headed, between = best, best, best.top > 0, []
    for parent in around[1:]:
        at = next(i for i, x in enumerate(parent.items) if x is child)
        nodes = [(i, x) for i, x in enumerate(parent.items) if isinstance(x, Node) and not x.dropped]
        rich = [i for i, x in nodes if x is not child and x.name in BLOCKS and x.density >= threshold and 2 * x.links < x.chars and 10 * x.prose() >= best.prose()]
        heads = [] if headed else [i for i, x in nodes if i < at and x.name in HEADINGS][-1:]
        if rich or heads or child.name not in BLOCKS:
            for upper, only in between:
                upper.items = [only]
            between = []
            low, high = (0, len(parent.items)) if child.name not in BLOCKS else (min([at, *rich, *heads]), max([at, *rich]))
            parent.items = parent.items[low : high + 1]
            place, headed = parent, headed or bool(heads)
        else:
            between.append((parent, child))
        child = parent
    return place, threshold


def _above(node: Node) -> list[Node]:
    out = [node]
    while out[-1].parent is not None:
        out.append(out[-1].parent)
    return out


def blocks(node: Node, threshold: float) -> list[str]:
    """Text of the blocks below *node*, in order; link lists below the threshold are left out."""
    out: list[list[str]] = [[]]
    stack: list[object] = [node]
    while stack:
        x = stack.pop()
        if x is None:
            out.append([])
        elif isinstance(x, str):
            if x == "\0":
                out.append([])
            else:
                out[-1].append(x)
        elif x.dropped or (x is not node and x.name in BLOCKS and x.chars and x.links > 0.5 * x.chars and x.density < threshold):
            continue
        else:
            block = x.name in BLOCKS and x.name not in CELLS
            if block:
                out.append([])
                stack.append(None)
            elif x.name in CELLS:
                stack.append(" ")
            stack += reversed(x.items)
    texts = (" ".join(html_lib.unescape("".join(parts)).split()) for parts in out)
    return [t for t in texts if t]


def extract(page: str | None) -> str:
    """The article of a page: blocks joined by an empty line; "" for none."""
    if not page:
        return ""
    root = parse(page.replace("\0", " "))
    _drop_marked(root)
    _drop_afterwords(root)
    node, threshold = main_node(root)
    return "\n\n".join(blocks(node, threshold))


def _extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.num_rows, 256):
            piece = batch.slice(a, b - a)
            texts = [extract(x) for x in piece.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page", "url", "text", "n_chars"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: the id, ``url``, ``text`` and ``n_chars``, its code points.

    Null and empty pages have the empty text, as have pages of nothing but
    menus, scripts and the like.  Null ids and addresses stay null; repeated
    rows are extracted alike.  Pages of any length are read whole, one at a
    time.  An empty table gives an empty result; other columns are ignored.
    """
    source = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return source.mapInArrow(_extractor, "page bigint, url string, text string, n_chars bigint").withColumnRenamed("page", id_col)
