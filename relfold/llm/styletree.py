"""Main text of web pages by site style trees.

Pages of one host share a template. Their element trees are merged into one site tree, whose nodes are paths of tags with class and id. A node is important
if its presentation (the tags of its children) and its content (its text) differ from page to page, measured by entropy: text that many pages of the host
repeat word for word has entropy near zero. Branches of low importance are cut from each page.

Elements whose tag, role or class names them as menu, header, footer, sidebar, notice, advert, form or reader comments have importance zero on every host.
A class or id is judged as a whole: ``cookie-notice`` and ``site-header`` are noise, ``has-sidebar`` and ``comments-open`` are not.
An ``article`` or ``main`` element and its paragraphs are never cut, nor headings in it by their name, and where a page has one, the text is taken from it; if all lie in elements
that are noise by name, those names don't count. If cutting would leave nothing, names don't count and the tree decides; if that leaves nothing, the page keeps its text.

Character references are decoded, white space inside a block becomes one blank, blocks are trimmed and joined by one newline. NULL and empty pages, and
pages without text, give an empty text. Pages without host are one host. Every row gets its text, but pages of a host with equal main text (repeated pages, mirrors,
session urls) count once in the tree, and of a main element no branch that holds over half of its text is cut. An empty table gives an empty one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfold.llm.common import stored, values
from relfold.llm.urlfilter import host_of

# Importance below which a branch is cut, and pages of a host that must have it.
LOW, MIN_PAGES = 0.3, 8
# What is low on a host is sent to all tasks if it is this small in all, else joined.
SENT_BYTES = 8 << 20

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
BLANKS = re.compile(r"\s+")
RAW = frozenset("script style noscript template svg math iframe object textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
BLOCK_STARTS_PARAGRAPH_END = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
# What an opening tag closes if it is open in the same parent.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDS = frozenset("ul ol dl table body article section div".split())

NOISE_TAGS = frozenset("nav footer aside form button select dialog menu head".split()) | RAW
MAIN_TAGS = frozenset(("article", "main"))
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NOISE_WORD = re.compile(
    r"ad|ads|adv|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|header|masthead|topbar|footer|sidebar\w*|side|aside|widget\w*|related|recommend\w*|share|sharing|social"
    r"|cookies?|consent|notice|notification|alert|gdpr|popup|modal|overlay|newsletter|subscribe|signup|login|search|comments?|commentlist|replies|respond|disqus|pagination|pager|toolbar|skip",
    re.IGNORECASE,
)
HEADER_WORDS = frozenset(("header", "masthead"))
# Words that may stand beside a noise word in a class or id without changing what it names.
BESIDE = frozenset(
    "site page main primary secondary top bottom left right global mobile desktop fixed sticky list item items link links bar box block section area container wrapper wrap inner outer"
    " posts stories articles button buttons icon icons form field slot unit panel row col column group message msg text title this us bg large small".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KEPT_TAGS = frozenset("article main body html p h1 h2 h3 h4 h5 h6 blockquote pre".split())


class Node:
    """An element: what it is called, its path, and its children (elements and pieces of text)."""

    __slots__ = ("tag", "path", "noise", "named", "main", "children")

    def __init__(self, tag: str, path: str, noise: bool, named: bool, main: bool):
        self.tag, self.path, self.noise, self.named, self.main = tag, path, noise, named, main
        self.children: list[Node | str] = []


def attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(text)} if "=" in text else {}


@lru_cache(1 << 16)
def named_noise(names: str, inside_main: bool) -> bool:
    """Whether a whole class or id names noise: it has a noise word, and no word that is neither noise nor stands beside it; headers inside main are none."""
    for name in names.lower().split():
        parts = [x for x in re.split("[-_]+", name) if x]
        noisy = [x for x in parts if NOISE_WORD.fullmatch(x) and not (inside_main and x in HEADER_WORDS)]
        if noisy and all(x in noisy or x in BESIDE or x.isdigit() for x in parts):
            return True
    return False


def parse(page: str) -> Node:
    """The element tree of a page; unclosed and misnested elements are closed as browsers do."""
    root = Node("#", "", False, False, False)
    stack, at, n = [root], 0, len(page)
    while at < n:
        token = TOKEN.search(page, at)
        if token is None:
            stack[-1].children.append(page[at:])
            break
        if token.start() > at:
            stack[-1].children.append(page[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in BLOCK_STARTS_PARAGRAPH_END:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    del stack[depth:]
                    break
                if stack[depth].tag not in INLINE:
                    break
        elif tag in CLOSES:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in CLOSES[tag]:
                    del stack[depth:]
                    break
                if stack[depth].tag in BOUNDS:
                    break
        given = attributes(token[3])
        names = f"{given.get('class', '')} {given.get('id', '')}".strip()
        parent = stack[-1]
        inside_main = any(s.main for s in stack)
        role = given.get("role", "").lower()
        main = tag in MAIN_TAGS or role == "main"
        noise = tag in NOISE_TAGS or tag == "header" and not inside_main or role in NOISE_ROLES or "hidden" in given
        exempt = main or tag in ("html", "body") or inside_main and tag in HEADINGS
        named = bool(names) and not exempt and named_noise(names, inside_main)
        node = Node(tag, f"{parent.path}>{tag}" + (f".{names}" if names else ""), noise, named, main)
        parent.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and not token[3].endswith("/"):
            stack.append(node)
    if not main_elements(root):
        unnamed(root)
    return root


def unnamed(root: Node) -> None:
    """Where all main elements lie inside named noise, the names around them don't count."""
    stack: list[tuple[Node, tuple]] = [(root, ())]
    while stack:
        x, above = stack.pop()
        if x.main:
            while above:
                above[0].named = False
                above = above[1]
        else:
            within = (x, above) if x.named else above
            stack.extend((c, within) for c in x.children if not isinstance(c, str) and not c.noise)


def text_of(node: Node) -> str:
    """All text below a node in order, for comparing."""
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            stack.extend(reversed(x.children))
    return BLANKS.sub(" ", " ".join(out)).strip()


def branches(root: Node) -> Iterator[Node]:
    """The containers of a page that are merged into the site tree: all but paragraphs, inline elements and main elements; noise is merged as one node."""
    stack = [root]
    while stack:
        for child in stack.pop().children:
            if not isinstance(child, str) and child.tag not in RAW:
                if not child.noise and not child.named:
                    stack.append(child)
                if child.tag not in KEPT_TAGS and child.tag not in INLINE and child.tag not in VOID:
                    yield child


def bulk(top: Node) -> set[int]:
    """Nodes (by identity) of a main element that hold over half of its text outside noise."""
    order: list[Node] = []
    stack = [top]
    while stack:
        x = stack.pop()
        order.append(x)
        stack.extend(c for c in x.children if not isinstance(c, str) and not c.noise and not c.named)
    size: dict[int, int] = {}
    for x in reversed(order):
        size[id(x)] = sum(len(BLANKS.sub("", c)) if isinstance(c, str) else size.get(id(c), 0) for c in x.children)
    return {k for k, n in size.items() if 2 * n > size[id(top)]}


def blocks(root: Node, low: frozenset[str], names: bool = True) -> list[str]:
    """Text blocks in page order, without noise (with ``names`` also by name) and without branches whose path is low; of a main element the bulk is not cut."""
    kept = bulk(root) if root.main and low else ()
    out: list[str] = []
    pieces: list[str] = []

    def closed() -> None:
        block = BLANKS.sub(" ", html.unescape("".join(pieces))).strip()
        pieces.clear()
        if block:
            out.append(block)

    stack: list[Node | str | None] = [root]
    while stack:
        x = stack.pop()
        if x is None:
            closed()
        elif isinstance(x, str):
            pieces.append(x)
        elif x.tag == "br":
            pieces.append(" ")
        elif not x.noise and not (names and x.named) and (x.path not in low or id(x) in kept):
            own_block = x.tag not in INLINE
            if own_block:
                closed()
                stack.append(None)
            stack.extend(reversed(x.children))
    closed()
    return out


def main_elements(root: Node) -> list[Node]:
    """The outermost main elements outside the noise."""
    out, stack = [], [root]
    while stack:
        x = stack.pop()
        if x.main:
            out.append(x)
        else:
            stack.extend(c for c in reversed(x.children) if not isinstance(c, str) and not c.noise and not c.named)
    return out


def main_text(page: str | None, low: frozenset[str]) -> str:
    return main_of(parse(page or ""), low)


def main_of(root: Node, low: frozenset[str]) -> str:
    tops = main_elements(root) or [root]
    for skip, names in ((low, True), (frozenset(), True), (low, False), (frozenset(), False)):
        found = [b for top in tops for b in blocks(top, skip, names)]
        if found:
            return "\n".join(found)
    return ""


def digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def site_trees(pages: DataFrame) -> DataFrame:
    """(host, path, importance) of the merged nodes; ``pages`` has host and html. Each page sends one row for each of its nodes; pages of equal main text count once."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: set[tuple] = set()
            for host, page in zip(values(batch.column(0)), values(batch.column(1)), strict=True):
                root = parse(page or "")
                copy = digest(main_of(root, frozenset()))
                counts: dict[tuple[str, int, int], list[int]] = {}
                seen: set[str] = set()
                for node in branches(root):
                    row = counts.setdefault((node.path, digest(" ".join(c.tag for c in node.children if not isinstance(c, str))), digest(text_of(node))), [0, 0])
                    row[0] += 1
                    row[1] += node.path not in seen
                    seen.add(node.path)
                rows.update((host, *k, copy, *v) for k, v in counts.items())
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 5]
            columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "path", "shape", "content", "copy", "n", "pages"])

    sent = pages.select("host", "html").mapInArrow(merged, "host string, path string, shape long, content long, copy long, n long, pages long")
    node = ["host", "path", "shape", "content"]
    once = sent.groupBy(*node, "copy").agg(F.max("n").alias("n"), F.max("pages").alias("pages"))
    nodes = once.groupBy(*node).agg(F.sum("n").alias("n"), F.sum("pages").alias("pages"))
    # the entropy of content, base the number of nodes: 1 if all differ, 0 if all are equal; the same of the presentation counts where it is higher
    sums = lambda c: F.sum(F.col(c) * F.log(c))
    by_shape = nodes.groupBy("host", "path", "shape").agg(F.sum("n").alias("m"), sums("n").alias("content_sum"), F.sum("pages").alias("pages"))
    both = by_shape.groupBy("host", "path").agg(F.sum("m").alias("total"), F.sum("content_sum").alias("content_sum"), sums("m").alias("shape_sum"), F.sum("pages").alias("pages"))
    entropy = lambda c: (F.log("total") - F.col(c) / F.col("total")) / F.log("total")
    importance = F.when(F.col("total") > 1, F.greatest(entropy("content_sum"), entropy("shape_sum"))).otherwise(1.0)
    return both.select("host", "path", "pages", importance.alias("importance"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", low: float = LOW, min_pages: int = MIN_PAGES) -> DataFrame:
    """(id, url, text) of each row of ``pages``."""
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(page).alias("html"))
    cut = stored(site_trees(rows).where((F.col("importance") < low) & (F.col("pages") >= min_pages)).groupBy("host").agg(F.collect_set("path").alias("low")))
    size = cut.agg(F.sum(F.length("host") + F.length(F.array_join("low", ",")))).first()[0] or 0
    joined = rows.join(F.broadcast(cut) if size <= SENT_BYTES else cut, "host", "left")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, frozenset[str]] = {}
        for batch in batches:
            out = []
            for content, paths in zip(values(batch.column(2)), values(batch.column(3)), strict=True):
                key = tuple(paths or ())
                if key not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[key] = frozenset(key)
                out.append(main_text(content, known[key]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["id", "url", "text"])

    schema = f"id {pages.schema[page_id].dataType.simpleString()}, url string, text string"
    return joined.select("id", "url", "html", "low").mapInArrow(texts, schema)
