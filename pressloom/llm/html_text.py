"""Main text of web pages, with the templates of sites removed.

Every element's subtree is hashed. Spark counts, per host, in how many different pages a subtree
occurs; subtrees that recur across many pages of a host are its template and are deleted. Of what is
left, a page's articles (or its main part, or else its body) give the text, without elements that are
navigation, headers, footers, sidebars, notices, adverts, forms, scripts, styles or comments by their
tag, class, id or role. Containers (divisions, lists, tables) with all they hold are template from
``TEMPLATE_PAGES`` pages on, on a host of any size and within articles too. Other elements are so only
outside of articles: a lone paragraph that several articles quote is text. A container that holds most
of an article is never template.

Character references are decoded, white space becomes one space, blocks are joined by one space. Null
and empty pages have no text. Unclosed and misnested tags are closed as their parents close. Pages
without a host form one site. Equal pages count once for the templates; repeated rows are extracted
each. A page of any length is read whole. An element in as many pages as the least is template, so
nothing is tied. An empty table gives no rows; only id, url and html are read of a table, whatever other
columns it has.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.shared import map_arrow, stored

TEMPLATE_PAGES = 5
#: Up to so many templates of a host go along with each of its pages; of more, each page gets its own ones.
HOST_LIST = 512
BROADCAST_ROWS = 200_000
#: Templates in the lists of hosts that are broadcast at once; of more, each lot of hosts is read for itself.
LISTED = 1_000_000

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary"
    " table tbody td tfoot th thead title tr ul".split()
)
_CLOSES_P = _BLOCK - {"br", "body", "head", "html", "option", "optgroup", "title"}
_SAME = {
    "li": ("li", "ul ol menu dir"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table tbody thead tfoot"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "option": ("option", "select"),
}
_SAME = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in _SAME.items()}

_DROPPED = _RAW | frozenset(
    "head nav footer aside form template object svg canvas math button select option input dialog menu audio video map".split()
)
_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr"
    " notice notices newsletter subscribe signup sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments"
    " disqus footer related share sharing social popup modal overlay toolbar pager pagination complementary contentinfo"
    " search alert widget widgets topbar".split()
)
#: Text of these is never a page's while it has other text; ``with-sidebar`` is no sidebar.
_SECONDARY = frozenset("comment comments disqus related sidebar footer complementary contentinfo".split())
_WITH = frozenset("with has no without".split())
_OUTSIDE = frozenset("header masthead banner".split())  # these only outside of articles
_ROOTS = frozenset("html body main article".split())
_CONTAINERS = frozenset("div section ul ol dl figure table details header center fieldset".split())

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|</?[a-zA-Z][^<>]*\Z",
    re.S,
)
_NAMED = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("children", "digest", "names", "size", "tag")

    def __init__(self, tag: str, attributes: str):
        self.tag, self.children, self.digest, self.size = tag, [], 0, 0
        self.names: frozenset[str] = frozenset()
        if attributes:
            values = "".join(" " + "".join(m) for m in _NAMED.findall(attributes))
            self.names = frozenset(_PARTS.findall(values.lower())) if values else self.names

    def close(self) -> None:
        """Called once all children are known, those of children included."""
        own = xxhash.xxh64(self.tag + "".join(self.names and sorted(self.names) or ()))
        for child in self.children:
            if isinstance(child, str):
                text = " ".join(child.split())
                own.update(text)
                self.size += len(text)
            else:
                own.update(child.digest.to_bytes(8, "little"))
                self.size += child.size
            own.update("\0")
        if self.tag in _DROPPED:
            self.size = 0
        self.digest = own.intdigest()


def parse(page: str) -> Node:
    """A tree of elements and decoded texts; never fails."""
    root = Node("", "")
    stack = [root]

    def pop() -> None:
        stack.pop().close()

    def up_to(index: int) -> None:
        while len(stack) > index:
            pop()

    def find(tags: frozenset[str], stop: frozenset[str]) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in stop:
                return 0
        return 0

    at = 0
    while True:
        tag = _TAG.search(page, at)
        text = page[at : tag.start()] if tag else page[at:]
        if text:
            stack[-1].children.append(html.unescape(text))
        if not tag:
            break
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            i = find(frozenset((name,)), frozenset())
            # An inline end tag does not close the blocks that were opened after its start.
            if i and (name in _BLOCK or not any(n.tag in _BLOCK for n in stack[i + 1 :])):
                up_to(i)
            continue
        if stack[-1].tag == "head" and name in _BLOCK and name not in ("title", "head"):
            pop()
        if name in _CLOSES_P and (i := find(frozenset("p"), frozenset("article section div td th li blockquote table".split()))):
            up_to(i)
        if name in _SAME and (i := find(*_SAME[name])):
            up_to(i)
        node = Node(name, tag[3])
        stack[-1].children.append(node)
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            node.children.append(page[at : end.start()] if end else page[at:])
            at = end.end() if end else len(page)
            node.close()
        elif name in _VOID:
            node.close()
        else:
            stack.append(node)
    up_to(0)
    return root


def key(node: Node) -> int:
    """The hash of a subtree as a signed number, odd for containers."""
    digest = node.digest & ~1 | (node.tag in _CONTAINERS)
    return digest - (1 << 64) if digest >> 63 else digest


def subtrees(root: Node) -> set[int]:
    """Hashes of all elements that could be template, as signed numbers."""
    found, rest = set(), [root]
    while rest:
        for child in rest.pop().children:
            if isinstance(child, Node):
                rest.append(child)
                if child.children and child.tag not in _ROOTS and child.tag not in _RAW:
                    found.add(key(child))
    return found


def _boilerplate(node: Node, inside: bool) -> bool:
    """By tag and names; ``inside`` an article."""
    if node.tag in _DROPPED or (node.tag == "header" and not inside):
        return True
    if not node.names:
        return False
    if node.tag in _ROOTS:
        return node.tag == "article" and bool(node.names & {"comment", "comments", "ad", "ads", "sponsored", "related"})
    return bool(node.names & _WORDS) or (not inside and bool(node.names & _OUTSIDE))


def _entered(node: Node, total: int) -> bool:
    """Whether a wrapper that is boilerplate by its name holds the page's text all the same."""
    if node.tag in _DROPPED or 2 * node.size < total:
        return False
    return node.size == total or not node.names & _SECONDARY or bool(node.names & _WITH)


def _articles(root: Node) -> list[Node]:
    """The outermost articles that no boilerplate holds; else the main parts; else those in wrappers.

    A wrapper around everything may have a name such as ``with-sidebar``, hence the second look.
    """
    for wrapped, tag in ((False, "article"), (False, "main"), (True, "article"), (True, "main")):
        found, rest = [], [root]
        while rest:
            node = rest.pop()
            if node.tag == tag and not _boilerplate(node, True):
                found.append(node)
            elif node is root or not _boilerplate(node, False) or (wrapped and _entered(node, root.size)):
                rest += [c for c in reversed(node.children) if isinstance(c, Node)]
            if tag == "main" and not wrapped and "main" in node.names and node.tag in _CONTAINERS and not found:
                found.append(node)
        if found:
            return found
    return []


def _judged(node: Node, inside: bool, total: int) -> bool:
    """Whether a template may take it. What holds most of an article is its text, on however many pages."""
    return node.tag not in _ROOTS and (not inside or (node.tag in _CONTAINERS and 2 * node.size <= total))


def asked(root: Node) -> set[int]:
    """Hashes of the elements that ``text_of`` looks up among templates."""
    articles = _articles(root)
    inside, total = bool(articles), sum(a.size for a in articles)
    found: set[int] = set()
    rest = list(articles or [root])
    while rest:
        node = rest.pop()
        if node.tag and not any(node is a for a in articles):
            if _boilerplate(node, inside):
                continue
            if node.children and _judged(node, inside, total):
                found.add(key(node))
        rest += [c for c in node.children if isinstance(c, Node)]
    return found


def text_of(root: Node, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """The main text of a page without the subtrees in ``templates``."""
    articles = _articles(root)
    inside, total = bool(articles), sum(a.size for a in articles)
    out: list[str] = []
    rest: list[Node | str] = list(reversed(articles or [root]))
    while rest:
        node = rest.pop()
        if isinstance(node, str):
            out.append(node)
            continue
        if node.tag and not any(node is a for a in articles):
            if _boilerplate(node, inside):
                continue
            if templates and _judged(node, inside, total) and key(node) in templates:
                continue
        edge = [" "] if node.tag in _BLOCK or not node.tag else []
        rest += edge + node.children[::-1] + edge
    text = " ".join("".join(out).split())
    return text_of(root) if inside and templates and not text else text


def host(url: Column) -> Column:
    name = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.regexp_replace(name, r"^www\.", "")


def _subtrees(rows: DataFrame, only_asked: bool = False) -> DataFrame:
    """host, page, subtree and whether the page's text depends on it, for rows of host, page, html."""

    def own(page: str) -> list[tuple[int, bool]]:
        root = parse(page)
        needed = asked(root)
        return [(h, h in needed) for h in (needed if only_asked else subtrees(root))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 100):
                some = batch.slice(begin, 100)
                found = list(map(own, some.column(2).to_pylist()))
                take = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
                yield {
                    "host": some.column(0).take(take),
                    "page": some.column(1).take(take),
                    "subtree": [h for f in found for h, _ in f],
                    "asked": [a for f in found for _, a in f],
                }

    return map_arrow(rows.select("host", "page", "html"), run, "host string, page long, subtree long, asked boolean").distinct()


def templates(rows: DataFrame, least: int = TEMPLATE_PAGES) -> DataFrame:
    """host, subtree for the recurring subtrees among rows of host, page, html that some page's text depends on."""
    many = _subtrees(rows).groupBy("host", "subtree").agg(F.count("*").alias("n"), F.max("asked").alias("asked"))
    return many.filter((F.col("n") >= least) & F.col("asked")).select("host", "subtree")


def _small(df: DataFrame, size: int) -> DataFrame:
    return F.broadcast(df) if size <= BROADCAST_ROWS else df


def _listed(rows: DataFrame, short: DataFrame, total: int, listed: int) -> DataFrame:
    """``rows`` with the templates of their hosts; pages are never shuffled.

    Hosts go in lots by hash, each with lists of ``listed`` templates or so, which are broadcast.
    """
    lots = -(-total // listed) or 1
    lot = F.pmod(F.xxhash64("host"), F.lit(lots))
    parts = [rows.filter(lot == i).join(F.broadcast(short.filter(lot == i)), "host", "left") for i in range(lots)]
    return reduce(DataFrame.unionByName, parts)


def main_texts(pages: DataFrame, host_list: int = HOST_LIST, listed: int = LISTED) -> DataFrame:
    """page_id, url, text and n_chars for every row of ``pages``."""
    html_ = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), F.xxhash64("html").alias("page"), html_.alias("html"))
    known = stored(templates(rows.filter("html != ''")))
    sizes = stored(known.groupBy("host").agg(F.count("*").alias("size")))
    short = known.join(sizes.filter(F.col("size") <= host_list), "host")
    short = short.groupBy("host").agg(F.collect_list("subtree").alias("templates"))
    total = sizes.filter(F.col("size") <= host_list).agg(F.sum("size")).first()[0] or 0
    long = sizes.filter(F.col("size") > host_list).select("host")
    if long.isEmpty():
        source = _listed(rows, short, total, listed)
    else:
        long = _small(long, long.count())
        source = _listed(rows.join(long, "host", "left_anti"), short, total, listed)
        beside = rows.join(long, "host")
        own = _subtrees(beside, only_asked=True).join(_small(known, known.count()), ["host", "subtree"])
        own = stored(own.groupBy("host", "page").agg(F.collect_list("subtree").alias("templates")))
        source = source.unionByName(beside.join(own, ["host", "page"], "left"))
    source = source.select("page_id", "url", "html", "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 100):
                some = batch.slice(begin, 100)
                texts = [text_of(parse(p), set(t or ())) for p, t in zip(some.column(2).to_pylist(), some.column(3).to_pylist(), strict=True)]
                yield {"page_id": some.column(0), "url": some.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    return map_arrow(source, run, "page_id long, url string, text string, n_chars long")
