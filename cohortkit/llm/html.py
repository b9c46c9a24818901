"""HTML extraction with a site style tree (operator 5).

Pages of a host share their frame. The DOMs of all pages of a host are merged
into one tree: an element node stands for the same place (tags, classes and ids
from the root) in every page that has it. Two things are counted at each node:
the different sequences of child elements (its presentation styles) and in how
many pages each word of its own text occurs. A node's own importance is the
entropy of its styles and 1 minus the mean entropy of its words over the pages
that have the node; text that every page repeats comes near 0, text that
differs near 1. Bottom up, a node's importance also takes in that of its
children. Branches whose nodes are all below ``LEAST`` are removed from each
page of the host, unless nothing else of a page would stay.

Markup that says what it is decides for itself, since one page or a set of
copies shows no entropy: navigation, headers, footers, asides, scripts and
elements whose role says so go. Forms, and elements of which a whole class or id
says advert, notice, comments and the like (each of its parts, as in
"cookie-notice" or "share-buttons", not "has-sidebar" or "related-work"), are
marked, and go unless text would be lost: html, body, main and article are never
marked, headings never by their ids; where no article or main element stands
outside of marked elements, those around one are not marked; and while marked
elements hold more than half of the text of these landmarks (of the page, where
there are none), the one that holds the most is not marked. Where a page has an article (or else a main element), the text is
what stands inside, and plain elements inside it stay; but articles beside a
main element that holds more text, or beside more text that the tree keeps (a
teaser), take nothing away. The tree decides on all other branches that at least
``LEAST_PAGES`` pages have; the fewer have it, the less may it repeat and go.

Pages become blocks: text between block elements, character references
decoded, white space as one space, joined by two line feeds.

How rows are dealt: workers count for a batch of pages and send sums per host,
node and word; a host is never gathered, only its nodes are. The sums name a
host's node by one hash and a style or word by ``FEATURE_BITS`` bits of its own,
since they are what is shuffled: of n different words of a node about n in
2^41 share their name with another. Pages meet the list of their host's removed
nodes by a join on the host.

Defined cases: a null or empty page has an empty text; a null or odd url is a
host of its own; pages without markup are one block; elements that are never
closed end with their parents, stray end tags are ignored; comments or scripts
without an end last to the page's end; repeated rows are extracted alike;
an empty table gives an empty result; extra columns are left behind.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import column_batches, cut, mixed, word_hashes

#: Branches of less importance go; of a node that n pages have, less than (1 - 1/n) times this.
LEAST = 0.5
#: Pages that must have a node: the entropy of one page says nothing.
LEAST_PAGES = 2
#: How fast the styles of a node count more than its children as they grow in number.
GAMMA = 0.9
#: Bits that name a style or a word among those of one node.
FEATURE_BITS = 40
ROWS = 2000

# HTML's elements by kind (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section
summary table tbody td tfoot th thead tr ul""".split())
RAW = frozenset("iframe noembed noframes script style template textarea title xmp".split())
GONE_TAGS = frozenset("""aside audio button canvas dialog footer head iframe input label menu nav noembed noframes
noscript object option script select style svg template textarea title video xmp""".split())
GONE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
GONE_NAMES = frozenset("""ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments
consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice
notices notification overlay pager pagination popup promo promotion related replies respond share sharing sidebar
signup social sponsor sponsored subscribe topbar widget""".split())
#: What may stand beside these in one class or id.
FILL_NAMES = frozenset("""area articles bar block body bottom box btn button buttons container content form global group
icon icons inner item items left link links list main outer panel posts primary right secondary section site title top
wrap wrapper""".split())
#: These elements are never marked by their names; of headings, only the class counts.
KEPT_TAGS = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the left closes an open element of the right.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
#: All other elements are inline: their text is part of the block they are in.
SEEN_TAGS = BLOCK | RAW | GONE_TAGS | {"br"}
#: These stop the search for an element to close.
FENCE = frozenset("article aside body div footer form header html main nav ol section table ul".split())

_OPEN = re.compile(r"<(?:[!?]|(/?)([a-zA-Z][^\s/>]*))")
#: What ends a tag, or begins a value in quotes: quotes count only after an equals sign.
_STOP = re.compile(r""">|=\s*(["'])""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[a-z]+")
_HOST = re.compile(r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _long(text: str, seed: int = 0) -> int:
    h = xxhash.xxh64_intdigest(text, seed)
    return h - (1 << 64) if h >> 63 else h


def _host_id(host: str) -> int:
    """What Spark's ``xxhash64`` makes of it."""
    return _long(host, 42)


_NODES: dict[tuple[int, str], int] = {}


def _node(parent: int, label: str) -> int:
    """The child's node, remembered."""
    node = _NODES.get((parent, label))
    if node is None:
        if len(_NODES) > 10_000:
            _NODES.clear()
        node = _NODES[parent, label] = _long(f"{parent}/{label}")
    return node


def _telling(marks: str, but: frozenset[str]) -> bool:
    """If a whole class or id of these is a name of ``GONE_NAMES``."""
    for token in marks.split():
        parts = set(_NAME.findall(token))
        if parts & GONE_NAMES - but and parts <= GONE_NAMES | FILL_NAMES:
            return True
    return False


class Element:
    """An element: its node in the site's tree and what becomes of its text.

    ``mark`` is the innermost marked element around it (0: none), ``outer`` that
    around the landmark that it is in. ``low`` says if the tree removes the
    branch; it is set by ``Page.text``."""

    __slots__ = ("tag", "node", "up", "styles", "gone", "inside", "named", "mark", "outer", "low")

    def __init__(self, tag: str, node: int, up: Element | None, gone: bool, inside: str, named: bool, mark: int = 0, outer: int = 0):
        self.tag, self.node, self.up, self.gone, self.inside, self.named = tag, node, up, gone, inside, named
        self.mark, self.outer, self.low = mark, outer, False
        self.styles: list[str] = []


class Page:
    """The blocks of a page: (text, the element it stands in). Work and memory are
    linear in the page, however deep, long or malformed it is."""

    def __init__(self, source: str | None):
        self.blocks: list[tuple[str, Element]] = []
        #: of each marked element the one around it; 0 stands for none
        self.marks: list[int] = [0]
        #: node -> (parent, its sequences of children, one for each time it occurs)
        self.nodes: dict[int, tuple[int, list[str]]] = {}
        self._parts: list[str] = []
        root = Element("", 0, None, False, "", False)
        #: all elements, parents first
        self.elements = [root]
        self._stack = [root]
        #: open elements by tag, outermost first: their places on the stack
        self._places: dict[str, list[int]] = defaultdict(list)
        self._read(source or "")
        self._flush()
        while len(self._stack) > 1:
            self._close()
        self._note(root)

    def _note(self, e: Element) -> None:
        self.nodes.setdefault(e.node, (e.up.node if e.up else 0, []))[1].append(" ".join(e.styles))

    def _close(self) -> None:
        e = self._stack.pop()
        self._places[e.tag].pop()
        self._note(e)

    def _flush(self) -> None:
        if self._parts:
            text = " ".join(html.unescape("".join(self._parts)).split())
            self._parts.clear()
            if text:
                self.blocks.append((text, self._stack[-1]))

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        unclosed: set[str] = set()  # quotes that don't occur any more
        torn = False  # a tag didn't end: from there on the next ">" ends a tag, in quotes or not
        while at < end:
            found = _OPEN.search(source, at)
            if not found:
                break
            if found.start() > at:
                self._parts.append(source[at:found.start()])
            at = found.start()
            if found[2] is None:
                if source.startswith("<!--", at):
                    stop = source.find("-->", at + 4)
                    at = end if stop < 0 else stop + 3
                    continue
                if source.startswith("<![CDATA[", at) and (stop := source.find("]]>", at + 9)) >= 0:
                    self._parts.append(html.escape(source[at + 9:stop]))
                    at = stop + 3
                    continue
                stop = source.find(">", at)
                if stop < 0:
                    break
                at = stop + 1
                continue
            place = found.end()
            while not torn:
                stop = _STOP.search(source, place)
                if not stop:
                    torn = True
                elif stop[1] is None:
                    break
                else:
                    close = -1 if stop[1] in unclosed else source.find(stop[1], stop.end())
                    if close < 0:
                        unclosed.add(stop[1])
                    place = stop.end() if close < 0 else close + 1
            last = source.find(">", found.end()) if torn else stop.start()
            if last < 0:
                break
            tag, rest = found[2].lower(), source[found.end():last]
            at = last + 1
            if tag not in SEEN_TAGS:
                continue
            if found[1]:
                self._end(tag)
            else:
                self._start(tag, rest)
                if tag in RAW and not rest.endswith("/"):
                    stop = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(source, at)
                    at = stop.start() if stop else end
        self._parts.append(source[at:])

    def _start(self, tag: str, rest: str) -> None:
        if tag == "br":
            self._parts.append("\n")
            return
        block = tag in BLOCK
        if block:
            self._flush()
        if block and tag not in ("html", "body"):
            self._close_open({"p"}, FENCE - {"div", "section"} if tag == "p" else FENCE)
        if tag in CLOSES:
            self._close_open(CLOSES[tag], FENCE)
        if tag in VOID:
            return
        marks = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTRIBUTE.findall(rest)} if rest else {}
        names = set(_NAME.findall(marks.get("class", "") + " " + marks.get("id", ""))) if marks else set()
        top = self._stack[-1]
        inside = top.inside
        gone = top.gone or tag in GONE_TAGS or marks.get("role") in GONE_ROLES or "hidden" in marks or marks.get("aria-hidden") == "true"
        gone = gone or tag == "header" and not inside  # inside an article it holds the title
        mark, outer = top.mark, top.outer
        landmark = tag in ("article", "main") or marks.get("role") in ("main", "article")
        if not landmark and tag not in KEPT_TAGS:
            said = marks.get("class", "") + " " + ("" if tag in HEADINGS else marks.get("id", ""))
            if tag == "form" or _telling(said, frozenset(("header", "banner")) if inside else frozenset()):
                self.marks.append(mark)
                mark = len(self.marks) - 1
        if not gone and landmark:
            kind = "article" if tag == "article" or marks.get("role") == "article" else "main"
            inside, outer = "article" if inside == "article" else kind, mark
        label = tag + "".join(f".{n}" for n in sorted(names))
        top.styles += [label] if not top.styles or top.styles[-1] != label else []
        e = Element(tag, _node(top.node, label), top, gone, inside, bool(names), mark, outer)
        self._places[tag].append(len(self._stack))
        self._stack.append(e)
        self.elements.append(e)

    def _innermost(self, tags) -> int:
        """The place of the innermost open element of these tags, or 0."""
        return max((self._places[t][-1] for t in tags if self._places.get(t)), default=0)

    def _close_open(self, tags: set[str], fence: frozenset[str]) -> None:
        place = self._innermost(tags)
        if place and place >= self._innermost(fence - tags):
            while len(self._stack) > place:
                self._close()

    def _end(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        place = self._innermost((tag,))
        if place:
            self._flush()
            while len(self._stack) > place:
                self._close()

    def _unmarked(self, rows: list[tuple[str, Element]]) -> list[bool]:
        """Which marks don't count, by the rules on lost text."""
        off = [True] + [False] * (len(self.marks) - 1)
        if any(e.inside for _, e in rows) and not any(e.inside and not e.mark for _, e in rows):
            for _, e in rows:
                m = e.outer if e.inside else 0
                while not off[m]:
                    off[m] = True
                    m = self.marks[m]
        # a landmark's text, or all text where there is none
        most = [r for r in rows if r[1].inside and off[r[1].outer]] or rows
        own = [0] * len(self.marks)
        for text, e in most:
            own[e.mark] += len(text)
        held = list(own)
        for m in range(len(self.marks) - 1, 0, -1):  # marks inside others come after them
            held[self.marks[m]] += held[m]
        seen = sum(n for n, yes in zip(own, off) if yes)
        # the one that holds the most first; what is around a mark holds as much and comes before it
        for m in sorted((m for m in range(1, len(off)) if not off[m]), key=lambda m: (-held[m], m)):
            if 2 * seen >= held[0]:
                break
            off[m] = True
            seen += own[m]
        return off

    def text(self, low: frozenset[int] = frozenset()) -> str:
        """The main text, without the branches of the nodes in ``low``."""
        for e in self.elements[1:]:
            e.low = e.up.low or e.node in low and (e.named or not e.inside)
        rows = [r for r in self.blocks if not r[1].gone]
        off = self._unmarked(rows)
        stay = [r for r in rows if off[r[1].mark]]
        size: Counter[str] = Counter()
        for text, e in stay:  # text beside a landmark counts if the tree keeps it
            size[e.inside] += len(text) if e.inside or not e.low else 0
        if size["article"] + size["main"] and size["article"] + size["main"] >= size[""]:
            # articles beside more text of a main element are a part of it
            kinds = ("article",) if size["article"] >= size["main"] else ("article", "main")
            stay = [r for r in stay if r[1].inside in kinds]
        high = [r for r in stay if not r[1].low]
        return "\n\n".join(text for text, _ in high or stay)


_SEEN = "cell long, kind int, feature long, host long, node long, parent long, pages long"


def counted(pages: DataFrame) -> DataFrame:
    """cell (a node of a host), kind (0 the node, 1 a style, 2 a word), feature,
    pages: in how many pages of a host each was seen, summed per batch of pages.
    Rows of kind 0 say which host, node and parent the cell is."""
    some = (1 << FEATURE_BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, ROWS):
            seen: Counter[tuple[int, int, int]] = Counter()
            places: dict[int, tuple[int, int, int]] = {}
            texts, of_cell, of_page = [], [], []
            for i, (url, source) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                host, page = _host_id(host_of(url)), Page(source)
                cells = {node: _long(f"{host} {node}") for node in page.nodes}
                for node, (parent, styles) in page.nodes.items():
                    places.setdefault(cells[node], (host, node, parent))
                    seen[cells[node], 0, 0] += 1
                    for style in set(styles):
                        seen[cells[node], 1, _long(style) & some] += 1
                for text, e in page.blocks:
                    texts.append(text)
                    of_cell.append(cells[e.node])
                    of_page.append(i)
            # a word counts once per page and node, then pages are counted
            words, counts = word_hashes(pa.array(texts, pa.string()))
            words = words & np.uint64(some)
            cell = np.repeat(np.array(of_cell, dtype=np.int64).view(np.uint64), counts)
            page_of = np.repeat(np.array(of_page, dtype=np.uint64), counts)
            _, once = np.unique(mixed(words + mixed(mixed(cell) + page_of)), return_index=True)
            _, first, n = np.unique(mixed(words[once] + mixed(cell[once])), return_index=True, return_counts=True)
            # rows of one node side by side: the shuffle compresses what neighbours share
            where = once[first]
            order = np.lexsort((n, cell[where]))
            where, n = where[order], n[order]
            rows = [(*k, *(places[k[0]] if k[1] == 0 else (None,) * 3), n) for k, n in seen.items()]
            rows += zip(cell[where].view(np.int64).tolist(), repeat(2), words[where].view(np.int64).tolist(),
                        repeat(None), repeat(None), repeat(None), n.tolist())
            columns = zip(*rows, strict=True) if rows else ((),) * 7
            kinds = (pa.int64(), pa.int32(), *(pa.int64(),) * 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["cell", "kind", "feature", "host", "node", "parent", "pages"])

    return pages.select("url", "html").mapInArrow(run, _SEEN)


def importance(seen: DataFrame) -> DataFrame:
    """host (its hash), node, pages, importance, most (of the branch), from what ``counted`` saw."""
    sums = seen.groupBy("cell", "kind", "feature", "host", "node", "parent").agg(F.sum("pages").alias("n"))
    log = F.log(F.col("n").cast("double"))
    of = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value))
    nodes = cut(sums.groupBy("cell").agg(
        F.max("host").alias("host"), F.max("node").alias("node"), F.max("parent").alias("parent"), of(0, F.col("n")).alias("pages"), of(1, F.col("n") * log).alias("style_log"), of(1, F.lit(1)).alias("styles"), of(1, F.col("n")).alias("styled"),
        of(2, log).alias("word_log"), of(2, F.lit(1)).alias("words")), "html-nodes")

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        children: dict[int, list[int]] = defaultdict(list)
        own = {r["node"]: r for r in rows}
        for r in rows:
            if r["node"] != r["parent"]:
                children[r["parent"]].append(r["node"])
        value: dict[int, float] = {}
        most: dict[int, float] = {}  # of the branch
        order, todo = [], [r["node"] for r in rows if r["node"] == r["parent"] or r["parent"] not in own]
        while todo:  # parents before children
            node = todo.pop()
            order.append(node)
            todo += children[node]
        for node in reversed(order):
            r = own[node]
            m = r["pages"] or 1
            log_m = math.log(m) if m > 1 else 0.0
            n = r["styled"] or 0  # a page counts once for each of its styles of the node
            styles = 1.0 if m == 1 or n < 2 else max(0.0, 1 - (r["style_log"] or 0.0) / (n * math.log(n)))
            parts = [(value[c], own[c]["pages"]) for c in children[node]]
            if r["words"]:
                parts.append((1.0 if m == 1 else 1 - r["word_log"] / (r["words"] * log_m), m))
            weight = sum(n for _, n in parts)
            below = sum(v * n for v, n in parts) / weight if weight else styles
            share = GAMMA ** (r["styles"] or 1)
            value[node] = (1 - share) * styles + share * below
            most[node] = max([value[node], *(most[c] for c in children[node])])
        return pa.table({"host": pa.array([rows[0]["host"]] * len(order), pa.int64()), "node": pa.array(order, pa.int64()),
                         "pages": pa.array([own[n]["pages"] for n in order], pa.int64()),
                         "importance": pa.array([value[n] for n in order], pa.float64()),
                         "most": pa.array([most[n] for n in order], pa.float64())})

    return nodes.groupBy("host").applyInArrow(merge, "host long, node long, pages long, importance double, most double")


def extract(pages: DataFrame, least: float = LEAST, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, text."""
    judged = importance(counted(pages))
    enough = F.lit(least) * (1 - 1 / F.col("pages"))
    low = judged.filter((F.col("most") < enough) & (F.col("pages") >= least_pages) & (F.col("node") != 0))
    low = cut(low.groupBy("host").agg(F.sort_array(F.collect_list("node")).alias("low")), "html-low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, ROWS):
            texts = [Page(source).text(frozenset(gone or ())) for source, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", "html", F.xxhash64(host).alias("host"))
    kind = dict(rows.dtypes)["page_id"]
    return rows.join(low, "host", "left").select("page_id", "url", "html", "low").mapInArrow(run, f"page_id {kind}, url string, text string")
