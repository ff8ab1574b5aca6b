"""HTML extraction by wrapper induction over the pages of a host.

1. Every page is parsed into a DOM tree and folded: neighbouring siblings with
   the same label (tag and class words) become one node, so a list or a run of
   paragraphs is one slot whatever its length (plain containers only with the
   same kinds of blocks in them). The folded shape and a hash of
   each node's text go to a narrow table.
2. The wrapper of a host starts from its most frequent shape. Each page's tree
   is aligned with it by simple tree matching (the largest order-preserving
   matching of equal labels), page by page in parallel, and texts are counted
   per (host, template node, text hash) with map-side combining: no task ever
   gathers the pages of a host. Pages with equal contents count once.
3. A template node is constant when at least ``MIN_PAGES`` different pages
   align with it and ``CONSTANT_SHARE`` of them have the same text there;
   other nodes are slots.
4. Extraction aligns each page with its wrapper again and leaves out chrome
   (menus, headers, footers, sidebars, notices, adverts, forms, comments, by
   tag, role or class) and the constant nodes that have the constant's text on
   this very page, inside an article or main region as outside. Of the rest the
   regions are the page's text; a page without a region gives all of its slots.
   A region that is constant throughout is the text where there is no other.
5. Whether a host's regions are only teasers is told by its pages together:
   where on most of them the slots outside say more, links aside, those slots
   join the regions on these pages. What stands beside one page's article, be
   it longer, changes nothing.

Blocks are joined by one space and white space is collapsed; character
references are decoded. A host with too few pages has no constant nodes.
Wrappers reach the pages by a broadcast join when their measured size is at
most ``BROADCAST_BYTES``, and by a join on the host otherwise.

Nulls: null html is an empty page with empty text; a null or hostless url
makes the host empty. Repeated rows are extracted each. Very long pages are
read whole. Ties: of equally frequent shapes the greatest is the template.
Unclosed and stray tags are repaired as they come. Extra columns are ignored. Empty tables give
an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import store

MIN_PAGES = 3
CONSTANT_SHARE = 0.9
BROADCAST_BYTES = 32 << 20

# HTML elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
# A start tag of the key closes an open element of the value.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
SCOPES = frozenset("table ul ol dl select article section div body main aside nav td th blockquote".split())
# Chrome by tag, by role, and by class or id (see _chrome_name).
CHROME_TAGS = frozenset("head nav header footer aside form button select menu dialog".split()) | RAW
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar"
    " widget nav navbar navigation menu breadcrumb breadcrumbs footer header masthead comment comments disqus reply"
    " replies respond notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe signup"
    " login share sharing social related recommended pagination pager toolbar skip legal copyright".split()
)
# Of these, words that name what they stand for whatever comes before them (article-comments).
CHROME_HEADS = frozenset(
    "ads advert adverts advertisement advertising adsense sponsor sponsored promo sidebar navbar breadcrumb breadcrumbs"
    " comment comments disqus replies cookie cookies gdpr popup newsletter pagination widget".split()
)
# Words that may stand beside a chrome word in a class or id: where it is, and what holds it.
PLACES = frozenset("site page main top bottom left right primary secondary global user users reader readers".split())
HOLDERS = frozenset(
    "area bar block body box button buttons container content form group holder icons inner item items link links list lists"
    " module panel placeholder post posts region row section slot strip text thread unit wrap wrapper zone".split()
)
# A class with one of these says that something else has, or has not, what it names.
DENIALS = frozenset("has have with without no not is in hide show".split())
REGION_TAGS = ("article", "main")
# Chrome that may hold teasers: kept as chrome while a page has a region elsewhere.
ASIDES = frozenset("head nav footer aside select menu dialog button".split()) | RAW

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*+|[^<>]*)>", re.S
)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORDS = re.compile(r"[a-z]+")
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Node:
    __slots__ = ("tag", "label", "chrome", "region", "hidden", "items")

    def __init__(self, tag: str, label: str, chrome: bool, region: bool, hidden: bool = False):
        self.tag, self.label, self.chrome, self.region, self.hidden = tag, label, chrome, region, hidden
        self.items: list = []  # texts and nodes in page order


def _chrome_name(token: str, heading: set[str]) -> bool:
    """Whether a whole class or id names chrome.

    Its head decides, the last word that is not just a holder: ``comment-list``,
    ``ad-slot``, ``article-comments`` and ``site-footer`` are chrome,
    ``share-price`` and ``legal-news`` are not, nor is ``has-sidebar``. Words
    with other meanings too (header, menu, share) are only chrome among words
    that are chrome, places or holders themselves.
    """
    words = _WORDS.findall(token)
    if not DENIALS.isdisjoint(words):
        return False
    known = CHROME_WORDS - heading
    named = [w for w in words if w not in HOLDERS]
    return bool(named) and (named[-1] in CHROME_HEADS or any(w in known for w in named) and all(w in known or w in PLACES for w in named))


@lru_cache(maxsize=20_000)
def _kind(tag: str, attrs: str, in_region: bool) -> tuple[str, bool, bool, bool]:
    """Label, chrome, region and hiddenness of an element. A region that is chrome too is so by its class or role."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".lower()
    words = _WORDS.findall(names)
    role = found.get("role", "").lower()
    # An article's own header holds its title.
    heading = {"header"} if in_region else set()
    hidden = bool(re.search(r"(?:^|\s)hidden(?:\s|=|$)", attrs)) or "display:none" in found.get("style", "").replace(" ", "").lower()
    chrome = (
        tag in CHROME_TAGS - heading
        or role in CHROME_ROLES
        or any(_chrome_name(x, heading) for x in names.split())
        or hidden
    )
    if tag in ("html", "body"):
        chrome = hidden = False
    region = tag in REGION_TAGS or role == "main" or found.get("itemprop") == "articleBody"
    return tag + "".join(f".{w}" for w in words[:3]), chrome, region and not hidden, hidden


def parse(page: str) -> Node:
    """A DOM tree of a page, repaired where tags are missing."""
    root = Node("", "", False, False)
    stack, at = [root], 0
    regions = 0
    held: list[tuple[Node, list[Node]]] = []  # regions and the chrome around them
    named: list[tuple[Node, list[Node]]] = []  # those that have a chrome class
    match = _TAG.search
    while m := match(page, at):
        if m.start() > at:
            stack[-1].items.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    regions -= sum(n.region for n in stack[i:])
                    del stack[i:]
                    break
            continue
        attrs = m[3]
        closes = CLOSES.get(tag) or (None if tag in INLINE or tag in VOID else {"p"})
        if closes:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    regions -= sum(n.region for n in stack[i:])
                    del stack[i:]
                    break
                if stack[i].tag in SCOPES and stack[i].tag not in closes:
                    break
        node = Node(tag, *_kind(tag, attrs, regions > 0))
        stack[-1].items.append(node)
        if node.region:
            around = [n for n in stack if n.chrome]
            if node.chrome:  # an article by its tag, chrome by its class
                named.append((node, around))
                node.region = False
            else:
                held.append((node, around))
        if tag in ("svg", "math") and attrs.endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}", re.I).search(page, at)
            at = end.start() if end else len(page)
            if end:
                stack.append(node)
                regions += node.region
        elif tag not in VOID and not attrs.endswith("/"):
            stack.append(node)
            regions += node.region
    if at < len(page):
        stack[-1].items.append(page[at:])
    if not held:  # the only articles of the page are its text whatever their class
        for node, _ in named:
            node.chrome, node.region = False, True
        held = named
    _open_chrome(held)
    return root


def _open_chrome(held: list[tuple[Node, list[Node]]]) -> None:
    """What holds an article or main is not chrome.

    An article in an aside, menu, footer or hidden element counts only where no
    region stands elsewhere: there it is a teaser.
    """
    teaser = lambda node, n: n.hidden or n.tag in ASIDES and node.tag != "main"
    shown = [x for x in held if not any(teaser(x[0], n) for n in x[1])]
    for _, around in shown or held:
        for n in around:
            n.chrome = False


def _text(items: list, out: list[str], chrome: bool, fixed: set[int], links: bool = True) -> None:
    """Texts in page order, with a space at block ends."""
    todo = [iter(items)]
    ends = [""]
    while todo:
        for x in todo[-1]:
            if isinstance(x, str):
                out.append(entities.unescape(x) if "&" in x else x)
            elif x.chrome and not chrome or id(x) in fixed or x.tag == "a" and not links:
                out.append(" ")
            else:
                edge = "" if x.tag in INLINE else " "
                out.append(edge)
                todo.append(iter(x.items))
                ends.append(edge)
                break
        else:
            todo.pop()
            out.append(ends.pop())


def text_of(nodes: list[Node], chrome: bool = False, fixed: set[int] = frozenset(), links: bool = True) -> str:
    """Text of subtrees, ``chrome``: with the chrome too, without the nodes in ``fixed``."""
    out: list[str] = []
    for n in nodes:
        _text(n.items, out, chrome, fixed, links)
        out.append(" ")
    return " ".join("".join(out).split())


class Folded:
    __slots__ = ("label", "members", "children", "kind")

    def __init__(self, label: str, members: list[Node], kind: frozenset = frozenset()):
        self.label, self.members, self.kind = label, members, kind
        self.children: list[Folded] = []


def _blocks(node: Node) -> frozenset:
    """Tags of the blocks in a plain container: a menu and a story may both be a ``div``."""
    if node.tag not in ("div", "section"):
        return frozenset()
    return frozenset(x.tag for x in node.items if not isinstance(x, str) and x.tag not in INLINE and x.tag not in VOID)


def fold(root: Node) -> Folded:
    """Merge runs of siblings with the same label (and, plain containers, the same kinds of blocks), level by level."""
    top = Folded(root.label, [root])
    todo = [top]
    while todo:
        f = todo.pop()
        for member in f.members:
            for x in member.items:
                # Inline mark-up belongs to the text of its block.
                if isinstance(x, str) or x.tag in INLINE or x.tag in VOID:
                    continue
                kind = _blocks(x)
                if f.children and f.children[-1].label == x.label and f.children[-1].kind == kind:
                    f.children[-1].members.append(x)
                else:
                    f.children.append(Folded(x.label, [x], kind))
        todo += f.children
    return top


def preorder(f: Folded) -> list[Folded]:
    out, todo = [], [f]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += reversed(n.children)
    return out


def shape_of(nodes: list[Folded]) -> str:
    """Labels in preorder with the number of children: enough to rebuild the tree."""
    return " ".join(f"{n.label}/{len(n.children)}" for n in nodes)


def _rebuild(shape: str) -> tuple[list[str], list[list[int]]]:
    labels, children, open_ = [], [], []
    for i, item in enumerate(shape.split(" ")):
        label, n = item.rsplit("/", 1)
        while open_ and not open_[-1][1]:
            open_.pop()
        if open_:
            children[open_[-1][0]].append(i)
            open_[-1][1] -= 1
        labels.append(label)
        children.append([])
        open_.append([i, int(n)])
    return labels, children


@lru_cache(maxsize=4_096)
def align(template: str, page: str) -> tuple[int, ...]:
    """Simple tree matching: for each node of the page, its template node or -1."""
    out = [-1] * len(page.split(" "))
    if template == page:
        return tuple(range(len(out)))
    la, ca = _rebuild(template)
    lb, cb = _rebuild(page)
    # Largest matching of two subtrees with equal root labels, and the children it matches.
    size: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
    todo = [(0, 0)] if la[0] == lb[0] else []
    while todo:
        a, b = todo[-1]
        xs, ys = ca[a], cb[b]
        below = [(x, y) for x in xs for y in ys if la[x] == lb[y] and (x, y) not in size]
        if below:
            todo += below
            continue
        todo.pop()
        w = [[size[x, y][0] if la[x] == lb[y] else 0 for y in ys] for x in xs]
        m = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i in range(len(xs)):
            for j in range(len(ys)):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + w[i][j])
        pairs, i, j = [], len(xs), len(ys)
        while i and j:
            if w[i - 1][j - 1] and m[i][j] == m[i - 1][j - 1] + w[i - 1][j - 1]:
                i, j = i - 1, j - 1
                pairs.append((xs[i], ys[j]))
            elif m[i][j] == m[i - 1][j]:
                i -= 1
            else:
                j -= 1
        size[a, b] = m[-1][-1] + 1, pairs
    todo = [(0, 0)] if size else []
    while todo:
        a, b = todo.pop()
        out[b] = a
        todo += size[a, b][1]
    return tuple(out)


def extract(page: str | None, template: str | None = None, constant: dict[int, int] | None = None) -> str:
    """Main text of a page under its host's wrapper; ``constant``: text hash by constant template node."""
    return extract_both(page, template, constant)[0]


def extract_both(page: str | None, template: str | None = None, constant: dict[int, int] | None = None) -> tuple[str, str | None]:
    """The text of a page's regions, and where the slots outside say more, of all its slots.

    A page without a region has only its slots: (text, None).
    """
    if not page:
        return "", None
    root = parse(page)
    folded = preorder(fold(root))
    at = align(template, shape_of(folded)) if template else (-1,) * len(folded)
    constant = constant or {}
    regions: list[Node] = []
    fixed: set[int] = set()  # nodes that are template
    skip: set[int] = set()  # folded nodes below a decision
    inside: set[int] = set()  # folded nodes within a region
    for i, f in enumerate(folded):
        own = [n for n in f.members if not n.chrome]
        if id(f) in skip or not own:
            skip.update(map(id, f.children))
            continue
        if id(f) in inside or own[0].region:
            if id(f) not in inside:
                regions += own
            inside.update(map(id, f.children))
        if at[i] in constant and f.label not in ("", "html", "body") and _hash(text_of(f.members, chrome=True)) == constant[at[i]]:
            fixed.update(map(id, f.members))
            skip.update(map(id, f.children))
    if not regions:
        return text_of([root], fixed=fixed), None
    # Regions that are template as a whole yield to the others, but a page keeps its only text.
    kept = [n for n in regions if id(n) not in fixed]
    told = text_of(kept, fixed=fixed) or text_of(regions)
    beside = text_of([root], fixed=fixed | set(map(id, regions)), links=False)
    return told, text_of([root], fixed=fixed) or told if len(beside) > len(told) else None


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        shapes, hashes = [], []
        for page in b.column(1).to_pylist():
            folded = preorder(fold(parse(page or "")))
            shapes.append(shape_of(folded))
            hashes.append([_hash(text_of(f.members, chrome=True)) for f in folded])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(shapes, pa.string()), pa.array(hashes, pa.list_(pa.int64()))],
            names=["host", "shape", "hashes"],
        )


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = [align(t, s) for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(at, pa.list_(pa.int32())), b.column(3)], names=["host", "nodes", "hashes"]
        )


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols = (b.column(i).to_pylist() for i in (3, 4, 5))
        texts = [extract_both(page, t, {x["node"]: x["hash"] for x in c or ()}) for page, t, c in zip(*cols)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2)] + [pa.array([t[i] for t in texts], pa.string()) for i in (0, 1)],
            names=["page_id", "url", "host", "text", "wide"],
        )


def _rows(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), _HOST, 1), F.lit("")))
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).alias("html")
    )


def induce(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, template, constant): one wrapper per host with its constant nodes and their texts' hashes, as a shared table."""
    store.python_ready(pages.sparkSession)
    seen = _rows(pages, id_col, url_col, html_col).select("host", "html")
    seen = seen.mapInArrow(_observe, "host string, shape string, hashes array<bigint>")
    seen = store.write_shared(seen.distinct(), "html-shapes")
    shapes = seen.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"))
    templates = shapes.groupBy("host").agg(F.max_by("shape", F.struct("n", "shape")).alias("template"))
    templates = store.write_shared(templates, "html-templates")
    # A hot host repeats on the page side only; AQE splits it.
    pairs = seen.join(templates, "host").select("host", "template", "shape", "hashes")
    pairs = pairs.mapInArrow(_aligned, "host string, nodes array<int>, hashes array<bigint>")
    counts = (
        pairs.select("host", F.explode(F.arrays_zip("nodes", "hashes")).alias("x"))
        .where("x.nodes >= 0")
        .groupBy("host", F.col("x.nodes").alias("node"), F.col("x.hashes").alias("hash"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    stats = counts.groupBy("host", "node").agg(
        F.sum("n").alias("pages"), F.max("n").alias("most"), F.max_by("hash", F.struct("n", "hash")).alias("hash")
    )
    fixed = stats.where((F.col("pages") >= MIN_PAGES) & (F.col("most") >= CONSTANT_SHARE * F.col("pages")))
    constant = fixed.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("node", "hash"))).alias("constant"))
    return store.write_shared(templates.join(constant, "host", "left"), "html-wrappers")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text."""
    wrappers = induce(pages, id_col, url_col, html_col)
    size = wrappers.agg(F.sum(F.octet_length("host") + F.octet_length("template") + 64 + 12 * F.coalesce(F.size("constant"), F.lit(0)))).first()[0]
    if (size or 0) <= BROADCAST_BYTES:
        wrappers = F.broadcast(wrappers)
    rows = _rows(pages, id_col, url_col, html_col).join(wrappers, "host", "left")
    rows = rows.select("page_id", "url", "host", "html", "template", "constant")
    told = rows.mapInArrow(_extracted, "page_id long, url string, host string, text string, wide string")
    told = store.write_shared(told, "html-texts")
    # Hosts whose regions are teasers: most of their pages say more outside of them.
    teasers = told.groupBy("host").agg(F.count("wide").alias("n"), F.count(F.lit(1)).alias("pages"))
    teasers = store.write_shared(teasers.where("n * 2 > pages and pages >= " + str(MIN_PAGES)).select("host"), "html-teasers")
    size = teasers.agg(F.sum(F.octet_length("host") + 16)).first()[0] or 0
    if not size:
        return told.select("page_id", "url", "text")
    if size <= BROADCAST_BYTES:
        teasers = F.broadcast(teasers)
    told = told.join(teasers.withColumn("teaser", F.lit(True)), "host", "left")
    return told.select("page_id", "url", F.when(F.col("teaser"), F.coalesce("wide", "text")).otherwise(F.col("text")).alias("text"))
