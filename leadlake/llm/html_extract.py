"""Main text of web pages with removal of site templates.

Every container element of a page is hashed with all it contains. Spark counts on how many pages of a host each hash
occurs, where pages with the same main text count once; subtrees on MIN_PAGES distinct pages of their host are its template
(menus, banners, notices) and are deleted. What is boilerplate by its element or class goes too, even if it occurs once.
Paragraphs and headings are never deleted as template, because an article may quote the same sentence as another. Nor are
single list items, rows and cells inside an article; elsewhere items and rows go only where most of their list or table
recurs, and cells only with several links, because short ones meet by chance on a large host. On a page without article or
main a subtree with most of the page's text goes by its recurrence too, unless nothing else would remain; elsewhere it stays.

A class or id marks boilerplate only as a whole token, never an element with most of the page's text or around the page's main
or only article, and inside the article no heading, no prose and nothing within prose.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import batch_map
from leadlake.session import cut_lineage

# A subtree is template if it is on at least MIN_PAGES distinct pages of its host, however many pages that has.
MIN_PAGES = 3

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset("html body main article".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre q figcaption".split())
DROPPED = frozenset("nav footer aside form script style noscript template iframe svg math button select textarea object "
                    "dialog menu canvas audio video head title datalist label fieldset map".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre "
                   "search section summary table tbody td tfoot th thead title tr ul".split())
CONTAINERS = BLOCKS - PROSE - MAIN
# Whole classes or ids, and roles, that mark boilerplate.
MARKS = frozenset("nav navbar navigation menu submenu sidebar footer masthead ad ads adv advert adverts advertisement "
                  "advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices notification "
                  "popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments "
                  "commentlist disqus respond reply replies related recommended breadcrumb breadcrumbs pagination pager widget "
                  "toolbar skip hidden".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Parts of lists and tables: too short to be template by themselves.
PARTS = frozenset("li dt dd tr td th thead tbody tfoot caption option optgroup".split())
WHOLES = frozenset("ul ol dl table".split())
# A start tag closes an open paragraph or list item of the same kind.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table select menu".split())
# Layout elements that a page may also put around its main part.
AROUND = frozenset("nav footer aside form header fieldset dialog menu label".split())


class Element:
    __slots__ = ("tag", "marked", "hidden", "parts", "digest", "weight", "mains", "articles")

    def __init__(self, tag: str, marked: bool, hidden: bool = False) -> None:
        self.tag, self.marked, self.hidden, self.parts, self.digest, self.weight = tag, marked, hidden, [], 0, 0
        self.mains = self.articles = 0  # main elements and outermost articles below


class PageTree(HTMLParser):
    """A forgiving tree: unclosed elements end with their parent, stray end tags are ignored."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("html", False)
        self.open = [self.root]
        self.depths: dict[str, list[int]] = {}  # of the open elements of a tag, without the root
        self.feed(html)
        self.close()
        while self.open:
            self._end()

    def _end(self) -> None:
        """Close the innermost element; its hash covers tag, texts and the hashes of its children."""
        element = self.open.pop()
        if self.open:
            self.depths[element.tag].pop()
        seen = xxhash.xxh64(element.tag.encode())
        for part in element.parts:
            if isinstance(part, str):
                words = " ".join(part.split())
                element.weight += len(words)
                seen.update(b"\x01" + words.encode("utf-8", "surrogatepass"))
            else:
                if part.tag not in DROPPED or part.tag in AROUND:  # scripts and the like are no text of the page
                    element.weight += part.weight
                element.mains += part.mains + (part.tag == "main")
                element.articles += 1 if part.tag == "article" else part.articles
                seen.update(b"\x02" + part.digest.to_bytes(8, "little"))
        element.digest = seen.intdigest()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            return
        if tag in BLOCKS and self._innermost({"p"}):
            self._close_to({"p"}, MAIN | {"td", "th", "button", "div"} | LISTS)
        if tag in SIBLINGS:
            self._close_to(SIBLINGS[tag], LISTS)
        marked = hidden = False
        for name, value in attrs:
            if name == "class":
                marked |= not MARKS.isdisjoint((value or "").lower().split())
            elif name == "id":
                marked |= (value or "").strip().lower() in MARKS
            elif name == "role":
                marked |= (value or "").strip().lower() in ROLES
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                hidden = True
        element = Element(tag, marked and tag != "body", hidden and tag != "body")
        self.open[-1].parts.append(element)
        self.depths.setdefault(tag, []).append(len(self.open))
        self.open.append(element)
        if tag in VOID:
            self._end()

    def _innermost(self, tags: set[str] | frozenset[str]) -> int:
        """Depth of the innermost open element with one of the tags, 0 if there is none; its cost is that of ``tags``, not of the nesting."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def _close_to(self, tags: set[str], barrier: frozenset[str]) -> None:
        """Close the innermost of ``tags`` and all within it, unless a ``barrier`` lies within it."""
        depth = self._innermost(tags)
        if depth and depth >= self._innermost(barrier):
            while len(self.open) > depth:
                self._end()

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag and tag in ("svg", "path", "use"):
            self._end()

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        self._close_to({tag}, frozenset())

    def handle_data(self, data: str) -> None:
        self.open[-1].parts.append(data)


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >= 1 << 63 else digest


def _candidates(tree: Element) -> tuple[set[int], set[int]]:
    """Signed hashes of the containers that may be template: those a template may delete here, and all others.

    What goes in any case needs no deletion here, but it counts, because another page may hold it without a telling name.
    """
    kept, others, stack = set(), set(), [(tree, True, False)]
    while stack:
        e, open_, prose = stack.pop()
        open_ = open_ and not (_boilerplate(e, tree, False) and _boilerplate(e, tree, True, prose))
        if e.tag in CONTAINERS and e.weight:
            (kept if open_ else others).add(_signed(e.digest))
        stack.extend((p, open_, prose or e.tag in PROSE) for p in e.parts if isinstance(p, Element))
    return kept, others - kept


def subtree_hashes(html: str) -> set[int]:
    """Signed hashes of the containers of a page that may be template."""
    return set.union(*_candidates(PageTree(html).root))


def _boilerplate(e: Element, tree: Element, inside: bool, prose: bool = False) -> bool:
    """Whether an element goes by its tag, class, id, role or hidden state; ``inside`` the article, ``prose``: within prose."""
    layout = e.tag in DROPPED or e.tag == "header" and not inside
    if layout and e.tag not in AROUND:
        return True
    if not (layout or e.marked or e.hidden):
        return False
    if not inside:
        plain = not layout or e.tag in ("form", "fieldset")
        if e.mains or e.tag == "main" or plain and (2 * e.weight > tree.weight or tree.articles == 1 == e.articles):
            return False
        if e.tag == "article" and tree.articles == 1:
            return False
    return layout or e.hidden or not (prose or e.tag in PROSE)


def main_text(html: str, template: set[int]) -> str:
    """Text of the blocks of the main part, without template subtrees (signed hashes) and boilerplate."""
    return _main_text(PageTree(html).root, template)


def _main_text(tree: Element, template: set[int]) -> str:
    template = {d & ((1 << 64) - 1) for d in template}
    inside = majority = False
    loose: set[int] = set()  # parts that go because most of their list or table does

    def recurs(e: Element) -> bool:
        if e.tag not in CONTAINERS or e.digest not in template or not majority and 2 * e.weight > tree.weight:
            return False
        return e.tag not in PARTS or not inside and (id(e) in loose or e.tag in ("td", "th") and _links(e) > 1)

    def dropped(e: Element, prose: bool = False) -> bool:
        if _boilerplate(e, tree, inside, prose):
            return True
        if e.tag in WHOLES and template:
            parts = _parts(e)
            if 2 * sum(p.weight for p in parts if p.digest in template) > e.weight:
                loose.update(map(id, parts))
        return recurs(e)

    def outermost(tag: str) -> list[Element]:
        found, stack = [], [tree]
        while stack:
            one = stack.pop()
            if one.tag == tag:
                if not _boilerplate(one, tree, False):
                    found.append(one)
            elif not dropped(one) and (one.mains or 2 * one.weight > tree.weight or not (one.marked or one.hidden)):
                stack.extend(p for p in reversed(one.parts) if isinstance(p, Element))
        return found

    # an article in a marked wrapper with little text may be a card or a comment: it stays, but as a part of the page
    tops = outermost("article") or outermost("main") or [tree]
    inside = tops[0] is not tree
    starts = {id(e) for e in tops}

    def text() -> str:
        blocks: list[list[str]] = [[]]
        stack: list = [(e, False) for e in reversed(tops)]
        while stack:
            one, prose = stack.pop()
            if one is None:
                blocks.append([])
            elif isinstance(one, str):
                blocks[-1].append(one)
            elif one.tag == "br":
                blocks[-1].append(" ")
            elif id(one) in starts or not dropped(one, prose):
                edge = one.tag in BLOCKS
                if edge:
                    blocks.append([])
                    stack.append((None, False))
                below = prose or one.tag in PROSE
                stack.extend((p, below) for p in reversed(one.parts))
        texts = (" ".join("".join(b).split()) for b in blocks)
        return " ".join(t for t in texts if t)

    majority = not inside and bool(template)
    found = text()
    if majority and not found:
        majority = False
        found = text()
    return found


def _parts(whole: Element) -> list[Element]:
    """Outermost items of a list or rows of a table."""
    found, stack = [], list(whole.parts)
    while stack:
        e = stack.pop()
        if isinstance(e, Element):
            if e.tag in PARTS and e.tag not in ("thead", "tbody", "tfoot"):
                found.append(e)
            else:
                stack.extend(e.parts)
    return found


def _links(e: Element) -> int:
    found, stack = 0, [e]
    while stack:
        one = stack.pop()
        found += one.tag == "a"
        stack.extend(p for p in one.parts if isinstance(p, Element))
    return found


def host_of(url: str = "url") -> Column:
    """Lower-case host of a URL; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def template_hits(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(k1, k2, template)``: for pages with template subtrees, the hashes of these.

    ``pages`` has ``k1, k2, host, html``; a page's list is bounded by its own elements. Pages of a host with the same main
    text are copies and count as one page, however their frames differ.
    """
    def described(html: str | None) -> tuple[int, list[int], list[int]]:
        if not html:
            return 0, [], []
        tree = PageTree(html).root
        kept, others = _candidates(tree)
        text = _main_text(tree, set()).encode("utf-8", "surrogatepass")
        return _signed(xxhash.xxh64_intdigest(text)), sorted(kept), sorted(others)

    def run(batch: pa.RecordBatch):
        texts = batch.column("html").to_pylist()
        for start in range(0, len(texts), 1000):
            page, kept, others = zip(*map(described, texts[start:start + 1000]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(start, 1000) for c in ("k1", "k2", "host")), pa.array(page, pa.int64()),
                 pa.array(kept, pa.list_(pa.int64())), pa.array(others, pa.list_(pa.int64()))],
                ["k1", "k2", "host", "page", "hashes", "others"])

    listed = cut_lineage(batch_map(pages.select("k1", "k2", "host", "html"), run,
                                   "k1 long, k2 long, host string, page long, hashes array<long>, others array<long>"))
    each = listed.select("k1", "k2", "host", F.explode("hashes").alias("hash"))
    distinct = listed.select("host", "page", F.explode(F.concat("hashes", "others")).alias("hash")).distinct()
    counts = distinct.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("on_pages"))
    template = counts.filter(F.col("on_pages") >= min_pages).select("host", "hash")
    return each.join(template, ["host", "hash"]).groupBy("k1", "k2").agg(F.collect_set("hash").alias("template"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per page (columns ``page_id``, ``url``, ``html``; others are ignored).

    Null or empty html gives an empty text. Pages without a host count as one host. Rows that repeat are all returned;
    for the template, pages of a host with equal main text count once. Blocks are joined by one space; white space inside a block becomes one space.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    keyed = rows.withColumn("k1", F.xxhash64("page_id", "url", "html")).withColumn(
        "k2", F.xxhash64(F.lit(1), "html", "page_id", "url")).withColumn("host", host_of())
    hits = template_hits(keyed, min_pages)

    def run(batch: pa.RecordBatch):
        texts = [main_text(h, set(t or ())) if h else "" for h, t in
                 zip(batch.column("html").to_pylist(), batch.column("template").to_pylist())]
        texts = [t.encode("utf-8", "replace").decode() for t in texts]  # a character reference may name half a pair
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    joined = keyed.join(hits, ["k1", "k2"], "left").select("page_id", "url", "html", "template")
    return batch_map(joined, run, "page_id long, url string, text string, n_chars long")
