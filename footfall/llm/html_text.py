"""Operator 9: main text of pages by a site style tree.

Pages of a host are merged into one tree whose nodes are element paths (tag,
class and id names without digits); inline elements are no nodes, their text
belongs to the block around them. For every node Spark sums, over the pages
of the host, how its child sequences (presentation) and own texts (content)
are spread: a feature that all pages share has entropy 1, one that a single
page has 0. Pages of the same text count once, so copies do not make their
text look shared. A node's importance is 1 minus the mean entropy of its
features. A branch of a page goes when nothing in it is important.

Entropy cannot tell a menu whose words vary from content, nor a paragraph
that copies of a page share from boilerplate. So elements that are what they are
by their tag have a fixed importance: 0 for nav, header, footer, aside, script
and the like, 1 for headings and paragraphs; the tree decides on all others. A
class, id or role that names boilerplate, or a form, is only a suspicion: the
branch goes unless it holds ``MOST`` of what the part around it says and the
host's other pages do not, which a wrapper of the content does and a menu not.
Where a page marks an article or main part, only that part is read, and of an
unimportant branch in it only the texts go that repeat on pages of other text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import extended, runs, strings

IMPORTANCE = 0.3  # of a node below which it counts as boilerplate
MOST = 0.9  # of the text around it that a suspicious branch holds if it is content
MIN_PAGES = 2  # of different texts: one page alone has no entropy
HOT_SHARE = 1000  # hosts with more than 1 / this of all pages are spread: so many at most
SPREAD = 64  # tasks over which the pages of such a host are spread

# HTML's element kinds.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noscript", "noembed", "noframes", "plaintext"}
BLOCKS = set(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary
    table tbody td tfoot th thead tr ul""".split()
)
INLINE = set(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span
    strike strong sub sup time tt u var""".split()
)
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt", "html", "body", "legend"}
SIBLINGS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
NO_CONTENT = set("nav header footer aside script style template select button svg canvas object dialog menu head title noscript iframe textarea".split())
CONTENT = set("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
BOILERPLATE = set(
    """ad ads advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu menus
    breadcrumb breadcrumbs header footer masthead sidebar aside widget cookie cookies consent notice notices popup modal
    comment comments disqus reply replies social share sharing related recommended newsletter subscribe signup login
    pagination pager toolbar""".split()
)

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    path: int  # hash of the labels from the root
    parent: int
    role: int | None  # fixed importance, or None
    owner: int  # the node itself, or for an inline element the one its text belongs to
    suspect: bool  # named like boilerplate, or a form
    children: list[int] = field(default_factory=list)  # label hashes, in order


@dataclass
class Page:
    nodes: list[Node]
    texts: list[tuple[int, int, str]]  # node, block, text; in page order


def _hash(*parts: object) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "replace")) >> 1


def _label(tag: str, attrs: str) -> tuple[str, int | None, bool]:
    """A node's label, the importance its tag fixes, and whether it looks like boilerplate."""
    names: list[str] = []
    role = 0 if tag in NO_CONTENT else 1 if tag in CONTENT else None
    suspect = tag == "form"
    for key, *values in ATTR.findall(attrs) if "=" in attrs else ():
        value = "".join(values).lower()
        found = NAME.findall(value)
        if key.lower() == "role":
            suspect |= not ROLES.isdisjoint(found)
        elif tag not in ("html", "body", "article", "main") or key.lower() == "class" and tag == "article":
            suspect |= not BOILERPLATE.isdisjoint(found)
        names += sorted(set(found))
    return " ".join([tag, *names]), None if suspect and role else role, suspect and role != 0


def parse(source: str) -> Page:
    """Elements and texts of a page. Unclosed and stray tags are read as
    browsers do: a block ends an open paragraph, an item ends its sibling, an
    end tag ends all that is open within its element."""
    nodes = [Node("", 0, -1, None, 0, False)]
    opened: Counter[str] = Counter()  # elements by tag, so that no search is made in vain
    texts: list[tuple[int, int, str]] = []
    stack, block, at, end = [0], 0, 0, len(source)

    def close(upto: int) -> None:
        nonlocal block
        while len(stack) > upto:
            tag = nodes[stack.pop()].tag
            opened[tag] -= 1
            block += tag in BLOCKS

    def say(lo: int, hi: int) -> None:
        if lo < hi:
            texts.append((stack[-1], block, source[lo:hi]))

    while True:
        m = TAG.search(source, at)
        if m is None:
            tail = re.search(r"<[a-zA-Z/]", source[at:])  # a tag that the page's end cuts off
            say(at, at + tail.start() if tail else end)
            break
        say(at, m.start())
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1] and not opened[tag]:
            continue
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == tag:
                    close(depth)
                    break
            continue
        if opened["p"] and tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == "p":
                    close(depth)
                    break
        if tag in SIBLINGS and any(opened[t] for t in SIBLINGS[tag]):
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = nodes[stack[depth]].tag
                if open_tag in SCOPES[tag]:
                    break
                if open_tag in SIBLINGS[tag]:
                    close(depth)
                    break
        if tag == "br":
            texts.append((stack[-1], block, " "))
        if tag in BLOCKS:
            block += 1
        if tag in VOID:
            continue
        label, role, suspect = _label(tag, m[3])
        if tag == "header" and opened["article"]:
            role = None  # the title block of an article
        parent = stack[-1]
        inline = tag in INLINE and role is None and not suspect
        if not inline:
            nodes[parent].children.append(_hash(label))
        if m[3].rstrip().endswith("/") and tag not in BLOCKS and tag not in RAW:
            continue
        if inline:
            nodes.append(Node(tag, nodes[parent].path, parent, None, nodes[parent].owner, False, nodes[parent].children))
        else:
            nodes.append(Node(tag, _hash(nodes[parent].path, label), parent, role, len(nodes), suspect))
        if tag in RAW:
            done = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
            at = done.end() if done else end
            continue
        stack.append(len(nodes) - 1)
        opened[tag] += 1
    return Page(nodes, texts)


def _flat(text: str) -> str:
    return SPACE.sub(" ", html.unescape(text)).strip()


def _parts(page: Page) -> tuple[list[bool], list[bool], list[bool], bool]:
    """Of each node: whether it is in the part that is read, whether a tag
    removes it, whether it is in a suspicious branch; and whether the page marks
    an article or main part."""
    nodes = page.nodes
    marks = [n.tag in ("article", "main") and not n.suspect for n in nodes]
    marked = any(marks)
    inside, gone, suspect = [False] * len(nodes), [False] * len(nodes), [False] * len(nodes)
    for i, n in enumerate(nodes):
        up = n.parent
        inside[i] = not marked or marks[i] or up >= 0 and inside[up]
        gone[i] = n.role == 0 or up >= 0 and gone[up]
        suspect[i] = n.suspect or up >= 0 and suspect[up]
    return inside, gone, suspect, marked


def _scope(page: Page, repeated: set[int]) -> tuple[list[bool], list[bool], bool]:
    """Of each node: whether it is in the part that is read, whether it is
    removed by its tag or as boilerplate; and whether the page marks a part."""
    nodes = page.nodes
    inside, gone, suspect, marked = _parts(page)
    if not any(suspect):
        return inside, gone, marked
    says = [0] * len(nodes)  # text of the branch that pages of other text do not have
    for (node, _), text in _own_texts(page).items():
        if inside[node] and not gone[node] and _saying(nodes[node].path, text, True) not in repeated:
            says[node] += len(text)
    for i in range(len(nodes) - 1, 0, -1):
        says[nodes[i].parent] += says[i]
    around = [says[0]] * len(nodes)
    for i, n in enumerate(nodes[1:], 1):
        around[i] = around[n.parent]
        if n.suspect and not gone[n.parent] and not gone[i]:
            if says[i] and says[i] >= MOST * around[i]:
                around[i] = says[i]
            else:
                gone[i] = True
        gone[i] = gone[i] or gone[n.parent]
    return inside, gone, marked


def _own_texts(page: Page) -> dict[tuple[int, int], str]:
    """(node, block) -> text of the node in that block, with that of its inline elements."""
    parts: dict[tuple[int, int], list[str]] = {}
    for node, block, text in page.texts:
        parts.setdefault((page.nodes[node].owner, block), []).append(text)
    return {key: flat for key, texts in parts.items() if (flat := _flat("".join(texts)))}


def _saying(path: int, text: str, in_article: bool) -> int:
    """Feature of a text; odd if it stands in a marked article or main part or
    in a suspicious branch, where it matters whether pages repeat it."""
    return _hash(path, "text", text) & ~1 | in_article


HOST = -1  # path of a feature that every page has once


def features(page: Page) -> dict[tuple[int, int], int]:
    """(path, feature) -> times: child sequences and own texts of the page's
    nodes, but for those whose importance a role fixes."""
    out = {(HOST, 0): 1}
    inside, gone, suspect, marked = _parts(page)
    free = [n.role is None and n.owner == i and not gone[i] and not suspect[i] for i, n in enumerate(page.nodes)]
    for i, node in enumerate(page.nodes):
        if i and free[i]:
            key = (node.path, _hash("children", *node.children) & ~1)
            out[key] = out.get(key, 0) + 1
    for (node, _), text in _own_texts(page).items():
        if free[node] or suspect[node] and not gone[node]:
            path = page.nodes[node].path
            key = (path, _saying(path, text, suspect[node] or marked and inside[node]))
            out[key] = out.get(key, 0) + 1
    return out


def main_text(page: Page, low: set[int], repeated: set[int]) -> str:
    """Text of the branches that hold something important, one block a line. In
    a marked part the others lose the texts that ``repeated`` has."""
    nodes = page.nodes
    inside, gone, marked = _scope(page, repeated)
    alive = [n.role == 1 or n.role is None and n.path not in low for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        if alive[i] and not gone[i]:
            alive[nodes[i].parent] = True  # a branch stays for what it holds
    idle = [False] * len(nodes)
    for i, n in enumerate(nodes[1:], 1):
        idle[i] = idle[n.parent] or n.owner == i and n.role is None and not alive[i]
    own = _own_texts(page) if marked and any(idle) else {}
    blocks: list[str] = []
    current, parts = -1, []
    for node, block, text in page.texts:
        if gone[node] or not inside[node]:
            continue
        if idle[node]:
            path = nodes[node].path
            if not marked or _saying(path, own.get((nodes[node].owner, block), ""), True) in repeated:
                continue
        if block != current:
            blocks.append("".join(parts))
            current, parts = block, []
        parts.append(text)
    blocks.append("".join(parts))
    return "\n".join(b for b in map(_flat, blocks) if b)


def host_of(url: str) -> F.Column:
    """Host of an address in lower case; empty if it has none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


STYLES = "host string, text long, page long, uses array<struct<path:long,feature:long,times:long>>"
USE = pa.struct([("path", pa.int64()), ("feature", pa.int64()), ("times", pa.int64())])


def _styles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in runs(batches, "html"):
        text, key, uses = [], [], []
        for source in strings(run.column("html")):
            page = parse(source)
            text.append(_hash(main_text(page, set(), set())))
            key.append(_hash(source))
            uses.append([{"path": p, "feature": f, "times": n} for (p, f), n in features(page).items()])
        yield pa.RecordBatch.from_arrays(
            [run.column("host"), pa.array(text, pa.int64()), pa.array(key, pa.int64()), pa.array(uses, pa.list_(USE))],
            ["host", "text", "page", "uses"],
        )


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, pages and importance of the nodes of each host's tree that
    no tag decides, from ``host`` and ``html``, and ``repeated``: the node's
    texts in marked parts that ``MIN_PAGES`` pages or more have.

    Of pages with the same text one counts. With c uses of a feature, c_j of
    them on page j, its entropy is (log c - sum(c_j log c_j) / c) / log(pages
    of the host)."""
    rows = pages.select("host", "html").mapInArrow(_styles, STYLES)
    once = rows.groupBy("host", "text").agg(F.min_by("uses", "page").alias("uses")).select("host", F.inline("uses"))
    spread = once.groupBy("host", "path", "feature").agg(
        F.sum("times").alias("c"), F.sum(F.col("times") * F.log("times")).alias("s"), F.count(F.lit(1)).alias("pages")
    )
    # Summed by node before the pages of the host come in: one row a node, however large the host.
    again = (F.pmod("feature", F.lit(2)) == 1) & (F.col("pages") >= MIN_PAGES)
    nodes = spread.groupBy("host", "path").agg(
        F.sum(F.col("c") * F.log("c") - F.col("s")).alias("spread"), F.sum("c").alias("c"), F.max("pages").alias("pages"),
        F.collect_list(F.when(again, F.col("feature"))).alias("repeated"),
    )
    size = F.max(F.when(F.col("path") == HOST, F.col("c"))).over(Window.partitionBy("host"))
    return (
        nodes.withColumn("host_pages", size)
        .filter((F.col("host_pages") >= MIN_PAGES) & (F.col("path") != HOST))
        .select("host", "path", "pages", (F.lit(1.0) - F.col("spread") / F.col("c") / F.log("host_pages")).alias("importance"), "repeated")
    )


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, ``text`` (empty if none) and ``n_chars`` of every row of ``pages``.

    Null html is empty; a null address has the empty host, whose pages make one
    tree. Rows that repeat each have their text, but count once in the tree. A page without an article
    or main part is read whole but for its boilerplate. Other columns of
    ``pages`` are not used."""
    given = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of("url").alias("host"))
    low = (
        style_tree(given)
        .filter((F.col("importance") < IMPORTANCE) & (F.col("pages") >= MIN_PAGES))
        .groupBy("host")
        .agg(F.collect_list("path").alias("low"), F.flatten(F.collect_list("repeated")).alias("repeated"))  # of one site's template
    )

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "html"):
            out = [
                main_text(parse(source), set(paths or ()), set(texts or ()))
                for source, paths, texts in zip(strings(run.column("html")), run.column("low").to_pylist(), run.column("repeated").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [run.column("page_id"), run.column("url"), pa.array(out, pa.string()), pa.array(np.array([len(t) for t in out], np.int64))],
                ["page_id", "url", "text", "n_chars"],
            )

    schema = extended(given.select("page_id", "url"), text="string", n_chars="long")
    # A host may hold a third of all pages: the pages of such hosts, a bounded number, are spread.
    sizes = given.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    hot = sizes.filter(F.col("n") * HOT_SHARE > sizes.select(F.sum("n")).scalar()).select("host", F.lit(SPREAD).alias("spread"))
    spread = lambda df: df.join(F.broadcast(hot), "host", "left").withColumn("spread", F.coalesce("spread", F.lit(1)))
    pages_by = spread(given).withColumn("salt", F.pmod(F.xxhash64("html"), F.col("spread")).cast("int"))
    low_by = spread(low).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("spread") - 1))).drop("spread")
    known = pages_by.join(low_by, ["host", "salt"], "left")
    return known.select("page_id", "url", "html", "low", "repeated").mapInArrow(run_all, schema)
