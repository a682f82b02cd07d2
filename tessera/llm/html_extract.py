"""Main-text extraction with a site style tree.

1. Each page is read into blocks: the text of a block element, and its node,
   the path of (tag, classes, id, role) from the root.  Inline markup is part
   of its block; scripts, styles, forms and the like have no text.
2. Pages of one host merge into a style tree.  A node's presentation styles
   are the sequences of its children, its contents the texts of its blocks.
   Over the pages that hold the node (equal pages count once)

     node importance      the entropy of its presentation styles,
     content importance   the entropy of its contents,

   each divided by the logarithm of the number of pages: near 0 what is the
   same on each page, 1 what always differs.  A node's composite importance
   is (1 - G**n) * node importance + G**n * the mean of its children's and
   contents' importances, n being the number of its children.
3. A page loses its branches of low composite importance (the node, its
   contents and every node below), the blocks whose very text most pages of
   the host repeat, and the branches that name themselves: menus, headers,
   footers, sidebars, notices, adverts, forms and reader comments.  Where a page marks its article (``article``, ``main``)
   what lies outside is no main text, and its own headings, paragraphs, lists and
   tables stay however often the site repeats them.  A name in a class or id (``sidebar``,
   ``ads``) does not speak for the element where it says what a layout has
   (``has-sidebar``, ``no-ads``), where the element holds ``main`` or the
   page's only ``article`` while none is marked elsewhere, or where it holds
   most of the text that neither the style tree nor a tag calls noise; then
   the style tree decides, and the branches within are judged alike.  Reader
   comments and related links may outgrow an article: those hold the main text
   only where nothing else is left.

Nodes on fewer than ``MIN_PAGES`` different pages of a host are not judged,
and with text in them they keep the branches they are in from being low.
What is kept of a host is a row for each judged node, not for each page.

Defined results: a null html is an empty page, its text is empty; a null or
odd url belongs to the host '' ; equal rows are each extracted; a very long
page is read whole, in the task of its row; an empty table gives an empty one;
unclosed and stray tags are repaired as browsers do; extra columns ride along,
but for those named ``text`` or ``n_chars``, which are replaced.
"""

from __future__ import annotations

import html
import re

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import column, map_batches, map_columns, staged
from tessera.session import ship_package

MIN_PAGES = 8
LOW = 0.2
REPEATED = 0.5
GAMMA = 0.9

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][\w:.-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
_ATTR = re.compile(r"([\w:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_WORDS = re.compile(r"[a-z]+")

BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: blocks of running text
FLOW = frozenset("h1 h2 h3 h4 h5 h6 p ul ol li dl dt dd blockquote pre table tbody thead tr td th figure figcaption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object audio video canvas xmp".split())
NOISE_TAGS = frozenset("nav aside footer form button select option label input dialog menu head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo search complementary dialog alert form menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu menus nav navbar "
    "navigation breadcrumb breadcrumbs sidebar side rail footer foot header masthead topbar toolbar cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended trending comment comments reply replies respondent disqus widget pagination pager skip legal copyright".split()
)
#: what may be longer than the article it follows
FOLLOWERS = frozenset("related recommended trending comment comments reply replies respondent disqus".split())
#: a class that says what a layout has or lacks: has-sidebar, layout-right-rail
_LAYOUT = re.compile(r"(?:^|[^a-z])(?:has|have|with|without|no|not|hide|show|is|layout|columns?)[-_]|[-_](?:layout|open|enabled|disabled|active)$")
_NAMED, _FOLLOWER = 1, 2
#: elements that an opening tag of the key closes
_CLOSES = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody"}, "thead": {"tbody"}, "tfoot": {"tbody"},
}
_LISTS = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _hash(parent: int, sign: str) -> int:
    return xxhash.xxh64_intdigest(sign.encode(), seed=parent & 0xFFFFFFFFFFFFFFFF) - 2**63


class Page:
    """The blocks and nodes of a page.  blocks: (nodes from the root, noise by
    tag or role, self-named elements from the root, how many of them are
    around the marked article or None outside, text); children: node ->
    children's signatures; named: kind of each self-named element; marks:
    (tag, self-named elements around) of the marked articles; flow: the nodes
    of headings, paragraphs, list items and the like inside a marked article,
    which have no containers of the site between them and it."""

    def __init__(self, source: str | None):
        self.blocks: list[tuple[tuple[int, ...], bool, tuple[int, ...], int | None, str]] = []
        self.children: dict[int, list[int]] = {}
        self.named: list[int] = []
        self.marks: list[tuple[str, tuple[int, ...]]] = []
        self.flow: set[int] = set()
        if source:
            self._read(source)

    def _read(self, source: str) -> None:
        # open elements: tag, nodes from the root, noise, self-named, around the article
        stack: list[tuple[str, tuple[int, ...], bool, tuple[int, ...], int | None]] = [("#", (0,), False, (), None)]
        text: list[str] = []

        def flush(top):
            if text:
                found = " ".join(html.unescape("".join(text)).split())
                text.clear()
                if found:
                    self.blocks.append((*top[1:], found))

        def pop(at: int):
            while len(stack) > at:
                top = stack[-1]
                if top[0] in BLOCK or top[2:4] != stack[-2][2:4]:
                    flush(top)
                stack.pop()

        pos = 0
        while True:
            m = _TOKEN.search(source, pos)
            if m is None:
                text.append(source[pos:])
                break
            if m.start() > pos:
                text.append(source[pos : m.start()])
            pos = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        pop(k)
                        break
                continue
            if tag in RAW:
                if not m[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, pos)
                    pos = end.end() if end else len(source)
                continue
            if tag in VOID:
                if tag == "hr":
                    flush(stack[-1])
                text.append(" ")
                continue
            if tag in BLOCK:  # an open paragraph ends here
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        pop(k)
                        break
                    if stack[k][0] in BLOCK:
                        break
            if tag in _CLOSES:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in _CLOSES[tag]:
                        pop(k)
                        break
                    if stack[k][0] in _LISTS.get(tag, ()):
                        break
            above = stack[-1]
            noise, kind, sign = self._judge(tag, m[3], above)
            noise = noise or above[2]
            named = above[3]
            if kind and not noise:
                named = (*named, len(self.named))
                self.named.append(kind)
            if tag in BLOCK or (noise, named) != above[2:4]:
                flush(above)
            nodes = above[1]
            if tag in BLOCK:
                node = _hash(nodes[-1], sign)
                if tag in FLOW and (above[0] in ("article", "main") or nodes[-1] in self.flow):
                    self.flow.add(node)
                self.children.setdefault(nodes[-1], []).append(node)
                nodes = (*nodes, node)
            around = above[4]
            if around is None and tag in ("article", "main") and not noise:
                around = len(named)
                self.marks.append((tag, named))
            if not m[3].endswith("/"):
                stack.append((tag, nodes, noise, named, around))
        pop(1)
        flush(stack[0])

    @staticmethod
    def _judge(tag: str, attributes: str, above) -> tuple[bool, int, str]:
        """(noise by tag or role, kind of the name or 0, signature)."""
        header = tag == "header" and above[4] is None
        if not attributes:
            return tag in NOISE_TAGS or header, 0, tag
        found = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTR.findall(attributes)}
        kind = 0
        if tag not in ("html", "body", "article", "main"):
            for name in f"{found.get('class', '')} {found.get('id', '')}".lower().split():
                said = NOISE_WORDS.intersection(_WORDS.findall(name))
                if said and not _LAYOUT.search(name):
                    kind = _FOLLOWER if kind != _NAMED and said <= FOLLOWERS else _NAMED
        noise = (
            tag in NOISE_TAGS
            or header
            or found.get("role", "").lower() in NOISE_ROLES
            or "hidden" in found
            or found.get("aria-hidden", "").lower() == "true"
            or "display:none" in found.get("style", "").replace(" ", "").lower()
        )
        sign = tag + "".join(sorted("." + x for x in found.get("class", "").split()))
        return noise, kind, f"{sign}#{found.get('id', '')}@{found.get('role', '')}"

    def main_blocks(self, low: set[int], repeated: set[tuple[int, int]]) -> list[str]:
        """The texts of the blocks that are main text."""
        told = []  # what the style tree and the tags leave
        for nodes, noise, named, around, text in self.blocks:
            # what a marked article itself repeats on all pages is its own text
            if noise or not low.isdisjoint(n for n in nodes if n not in self.flow):
                continue
            if repeated and nodes[-1] not in self.flow and (nodes[-1], xxhash.xxh64_intdigest(text.encode()) - 2**63) in repeated:
                continue
            told.append((named, around, text))
        lifted: set[int] = set()  # self-named elements that are no noise
        while True:
            marked = any(lifted.issuperset(named) for _, named in self.marks)
            if not marked and self.marks:
                mains = [named for tag, named in self.marks if tag == "main"]
                only = [named for _, named in self.marks] if len(self.marks) == 1 else []
                only = [named for named in only if all(self.named[k] == _NAMED for k in named)]
                if mains or only:
                    lifted.update((mains or only)[0])
                    continue
            total, left, weights = 0, 0, {}
            kept = []
            for named, around, text in told:
                if marked and (around is None or not lifted.issuperset(named[:around])):
                    continue
                total += len(text)
                outer = next((k for k in named if k not in lifted), None)
                if outer is None:
                    left += len(text)
                    kept.append(text)
                else:
                    weights[outer] = weights.get(outer, 0) + len(text)
            most = max(weights, key=weights.get, default=None)
            if most is None or 2 * weights[most] <= total or self.named[most] == _FOLLOWER and left:
                return kept
            lifted.add(most)


# -- the style tree of each host -----------------------------------------------

_STYLE, _CONTENT = 0, 1


def _facts(pages: DataFrame) -> DataFrame:
    """(host, page digest, node, parent, n_children, kind, value)."""

    def run(batches):
        names = ["host", "page", "node", "parent", "n", "kind", "value"]
        for b in batches:
            out = set()
            for url, source in zip(column(b, "url").to_pylist(), column(b, "html").to_pylist()):
                page = Page(source)
                host = host_of(url)
                told = [main_text(page, set(), set()), *(x[4] for x in page.blocks if not x[1] and not x[2])]
                digest = xxhash.xxh64_intdigest("\n".join(told).encode()) - 2**63
                for node, children in page.children.items():
                    kinds = list(dict.fromkeys(children))  # repeated children are one style
                    style = xxhash.xxh64_intdigest(repr(kinds).encode()) - 2**63
                    out.add((host, digest, node, None, len(kinds), _STYLE, style))
                    out.update((host, digest, c, node, None, _STYLE, None) for c in kinds)
                for nodes, *_, text in page.blocks:
                    out.add((host, digest, nodes[-1], None, None, _CONTENT, xxhash.xxh64_intdigest(text.encode()) - 2**63))
            cols = list(zip(*out)) if out else [[]] * 7
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names)

    schema = "host string, page long, node long, parent long, n int, kind int, value long"
    return map_batches(pages.select("url", "html"), run, schema).distinct()


def _tree(facts: DataFrame) -> DataFrame:
    """(host, low, repeated): each host's nodes of low importance and (node,
    content) pairs that most of its pages repeat."""
    pages = facts.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    per = facts.filter("value is not null").groupBy("host", "node", "kind", "value").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"))
    entropy = per.groupBy("host", "node", "kind").agg(
        F.sum("c").alias("m"), F.sum(F.col("c") * F.log("c")).alias("s"), F.max("n").alias("n")
    ).filter(F.col("m") >= MIN_PAGES)
    importance = entropy.select(
        "host", "node", "kind", "n", ((F.log("m") - F.col("s") / F.col("m")) / F.log("m")).alias("h")
    )
    # each node's parent, the pages that hold it, and whether it holds anything
    places = facts.groupBy("host", "node").agg(
        F.min("parent").alias("parent"), F.count("parent").alias("held"), F.count("value").alias("filled")
    )
    rare = places.filter((F.col("held") < MIN_PAGES) & (F.col("filled") > 0) & F.col("parent").isNotNull())
    rare = rare.select("host", F.col("parent").alias("node"), F.lit(True).alias("open")).distinct()
    # pandas makes a long column with nulls a float one, which rounds: the root is its own parent
    nodes = (
        importance.join(places.select("host", "node", "parent"), ["host", "node"])
        .join(rare, ["host", "node"], "left")
        .withColumns({"parent": F.coalesce("parent", "node"), "open": F.coalesce("open", F.lit(False)), "n": F.coalesce("n", F.lit(0))})
    )
    common = per.filter(F.col("kind") == _CONTENT).join(pages, "host").filter(
        (F.col("pages") >= MIN_PAGES) & (F.col("c") > F.col("pages") * REPEATED)
    )
    repeated = common.groupBy("host").agg(F.collect_list(F.struct("node", "value")).alias("repeated"))  # few: each on most pages

    def composite(pdf: pd.DataFrame) -> pd.DataFrame:
        style, content, inner, width, opened = {}, {}, {}, {}, set()
        for r in pdf.itertuples():
            (style if r.kind == _STYLE else content)[r.node] = r.h
            if r.kind == _STYLE:
                width[r.node] = r.n
            if r.open:
                opened.add(r.node)
            if r.parent != r.node:
                inner.setdefault(r.parent, set()).add(r.node)
        known: dict[int, float] = {}
        low: set[int] = set()
        todo = [n for n in {*style, *content}]
        while todo:  # children first, without recursion
            node = todo[-1]
            below = inner.get(node, ())
            waiting = [c for c in below if c not in known]
            if waiting and node not in known:
                known.setdefault(node, -1.0)
                todo += waiting
                continue
            todo.pop()
            parts = [known[c] for c in below if known[c] >= 0]
            parts += [content[node]] if node in content else []
            mean = sum(parts) / len(parts) if parts else 1.0
            g = GAMMA ** width.get(node, 0)
            known[node] = (1 - g) * style.get(node, mean) + g * mean
            if known[node] < LOW and content.get(node, 0.0) < LOW and node not in opened and low.issuperset(below):
                low.add(node)
        low = sorted(int(n) for n in low)
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "low": [low]})

    ship_package(facts.sparkSession)
    low = nodes.groupBy("host").applyInPandas(composite, "host string, low array<long>")
    return low.join(repeated, "host", "full_outer")


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html, ...) with text and n_chars, without
    html."""
    facts = staged(_facts(pages), "page-nodes")
    tree = staged(_tree(facts), "style-tree").select(
        F.col("host").alias("__host"), F.col("low").alias("__low"), F.col("repeated").alias("__repeated")
    )

    def hosts(b: pa.RecordBatch):
        return [pa.array([host_of(u) for u in column(b, "url").to_pylist()], pa.string())]

    named = map_columns(pages, [T.StructField("__of", T.StringType())], hosts)
    joined = named.join(tree, F.col("__of") == F.col("__host"), "left")

    def run(b: pa.RecordBatch):
        texts = []
        for source, low, repeated in zip(column(b, "html").to_pylist(), column(b, "__low").to_pylist(), column(b, "__repeated").to_pylist()):
            texts.append(main_text(Page(source), set(low or ()), {(x["node"], x["value"]) for x in repeated or ()}))
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return map_columns(joined, fields, run, drop=("__of", "__host", "__low", "__repeated", "html"))


def main_text(page: Page, low: set[int], repeated: set[tuple[int, int]]) -> str:
    return "\n".join(page.main_blocks(low, repeated))
