"""Main text of web pages, by removal of what recurs across the pages of a host.

Each page is cut into blocks of text and the elements around them. Every element's subtree gets a hash of its
tag and contents; Spark counts, per host, the pages on which a hash occurs, and subtrees that recur on many
are deleted as site template. Pages with one main text count once, so that copies of a page are no template.
Marks in the page complete this where counts cannot tell (small hosts, texts that vary from page to page):
navigation, footers, forms, scripts and the like are deleted by tag, role or class. Nothing else goes: text
outside an article or main element stays if it does not recur on its host.

Article and main elements are hints. Inside them, headings, paragraphs, lists, quotations and tables are never
template: a paragraph may be shared by many pages (a licence, a quotation) and still be part of each. An
article that holds less than half of the text of its page's article and main elements is a card or a list
entry and, as a whole, template like any other subtree. Subtrees in these elements are counted by the
different texts of such elements, others by the different texts of whole pages.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm import urls
from orrery.llm.common import table

#: A subtree is template if it recurs on this many different pages of its host and on this share of them, or on
#: ``MANY_PAGES`` whatever the size of the host, so that the sections of a large host lose their templates.
MIN_PAGES = 5
MIN_SHARE = 0.05
MANY_PAGES = 20

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
_PROSE = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote ul ol dl table figure".split())
_NEVER = frozenset("nav aside footer form head noscript template svg math iframe object canvas audio video select button dialog menu applet".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_MARKED = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo comment comments disqus cookie cookies consent gdpr sidebar navbar nav menu breadcrumb breadcrumbs share sharing social newsletter subscribe popup modal related notice toolbar pagination".split())
_MARKED_OUTSIDE = _MARKED | frozenset("header masthead footer banner topbar widget".split())
#: An end tag closes open elements down to its own; these start tags close an open element of the same list.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}}
_SCOPE = frozenset("ul ol dl table tr article section div body td th li blockquote main".split())
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CUT_OFF = re.compile(r"<[a-zA-Z/!?][^<]*\Z", re.S)


class _Element:
    __slots__ = ("tag", "children", "drop", "inside", "up", "prose", "hash", "size")

    def __init__(self, tag: str, up: _Element | None, drop: bool, inside: str):
        self.tag, self.up, self.drop, self.inside = tag, up, drop, inside
        self.children: list[bytes] = []
        self.prose = tag in _PROSE
        self.hash = 0
        self.size = 0


def _marked(tag: str, attributes: str, inside: bool) -> bool:
    if tag in _NEVER or (tag == "header" and not inside):
        return True
    if "=" not in attributes:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            if value in _ROLES:
                return True
        elif not (_MARKED if inside else _MARKED_OUTSIDE).isdisjoint(re.split(r"[^a-z0-9]+", value)):
            return True
    return False


class Page:
    """whole: (text, hashes of the deletable subtrees around it) of all blocks that no mark deletes; blocks: those
    in article or main elements, or all if none is; found: hashes of all deletable subtrees; outer: those of
    them that stand outside article and main elements."""

    def __init__(self, source: str):
        self.open: list[_Element] = [_Element("", None, False, "")]
        self.all: list[tuple[str, _Element]] = []
        self.found: set[int] = set()
        self.outer: set[int] = set()
        self.articles: list[tuple[_Element, int]] = []
        self.parts: list[str] = []
        self.tags: Counter[str] = Counter()
        self._read(source)
        self._flush()
        while len(self.open) > 1:
            self._close()
        kept = [(t, e) for t, e in self.all if not e.drop]
        hinted = [(t, e) for t, e in kept if e.inside]
        size = sum(len(t) for t, _ in hinted)
        for e, digest in self.articles:
            if 2 * e.size < size:
                e.hash = digest
                self.found.add(digest)
        self.whole = [(t, self._around(e)) for t, e in kept]
        self.blocks = [(t, self._around(e)) for t, e in hinted] or self.whole

    def _deletable(self, e: _Element) -> bool:
        if e.tag in ("", "html", "body", "article", "main") or (e.drop and e.up.drop):
            return False
        return e.drop or not e.inside or not e.prose

    def _around(self, e: _Element) -> list[int]:
        out = []
        while e is not None:
            if e.hash:
                out.append(e.hash)
            e = e.up
        return out

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts.clear()
            if text:
                e = self.open[-1]
                e.children.append(xxhash.xxh64_digest(text))
                e.size += 0 if e.drop else len(text)
                self.all.append((text, e))

    def _start(self, tag: str, attributes: str) -> None:
        up = self.open[-1]
        inside = up.inside
        drop = up.drop or _marked(tag, attributes, bool(inside))
        if not drop and tag in ("article", "main") and inside != "article":
            inside = tag
        elif not drop and not inside and re.search(r"""\brole\s*=\s*["']?main\b""", attributes, re.I):
            inside = "main"
        self.open.append(_Element(tag, up, drop, inside))
        self.tags[tag] += 1

    def _close(self) -> None:
        e = self.open.pop()
        self.tags[e.tag] -= 1
        digest = xxhash.xxh64_digest(e.tag.encode() + b"".join(e.children))
        up = self.open[-1]
        up.children.append(digest)
        up.size += e.size
        if e.prose and e.inside == up.inside:
            up.prose = True
        if e.children and self._deletable(e):
            e.hash = int.from_bytes(digest, "big", signed=True)
            self.found.add(e.hash)
            if not e.inside:
                self.outer.add(e.hash)
        elif e.tag == "article" and not e.drop:
            self.articles.append((e, int.from_bytes(digest, "big", signed=True)))

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        add = self.parts.append
        match = _TAG.search
        while at < n:
            m = match(source, at)
            text = source[at : m.start()] if m else _CUT_OFF.sub("", source[at:])
            if text:
                add(html.unescape(text) if "&" in text else text)
            if not m:
                return
            at = m.end()
            tag = m[2]
            if not tag:
                continue
            tag = tag.lower()
            if m[1]:
                if tag in _INLINE:
                    continue
                self._flush()
                if self.tags[tag]:
                    while self.open[-1].tag != tag:
                        self._close()
                    self._close()
            elif tag in _RAW:
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else n
            elif tag == "br":
                add(" ")
            elif tag in _VOID:
                if tag == "hr":
                    self._flush()
            elif tag not in _INLINE:
                self._flush()
                closes = _CLOSES.get(tag) or ({"p"} if self.open[-1].tag == "p" else ())
                for k in range(len(self.open) - 1, 0, -1):
                    if self.open[k].tag in closes:
                        while len(self.open) > k:
                            self._close()
                        break
                    if self.open[k].tag in _SCOPE and self.open[k].tag not in closes:
                        break
                self._start(tag, m[3])


def _text_hash(blocks: list[tuple[str, list[int]]]) -> int:
    return xxhash.xxh64_intdigest("\n".join(t for t, _ in blocks)) - (1 << 63)


def templates(pages: DataFrame, html_col: str = "html", url_col: str = "url", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, hash): subtrees that recur on at least ``min_pages`` pages with different main texts and on ``min_share`` of a host's or on ``MANY_PAGES``."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, sites, bodies, hashes = b.column(0).to_pylist(), [], [], []
            for site, source in zip(hosts, b.column(1).to_pylist(), strict=True):
                page = Page(source)
                found = [0, *page.found]  # 0 stands for the page itself
                inner, outer = _text_hash(page.blocks), _text_hash(page.whole)
                sites += [site] * len(found)
                bodies += [outer if h == 0 or h in page.outer else inner for h in found]
                hashes += found
            yield pa.RecordBatch.from_arrays([pa.array(sites, pa.string()), pa.array(bodies, pa.int64()), pa.array(hashes, pa.int64())], ["host", "body", "hash"])

    source = pages.select(urls.host(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    each = source.mapInArrow(of_batches, "host string, body long, hash long").distinct()
    counts = each.groupBy("host", "hash").agg(F.count("*").alias("n"))
    total = counts.where("hash = 0").select(F.col("host").alias("site"), F.col("n").alias("pages"))
    return counts.where(f"hash <> 0 AND n >= {min_pages}").join(total, F.col("host") == F.col("site")).where((F.col("n") >= F.col("pages") * min_share) | (F.col("n") >= MANY_PAGES)).select("host", "hash")


def main_texts(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(id, url, text): the blocks of each page's main text joined by line ends; empty if there is none.

    Null or empty html gives an empty text, a null url the host ''. Rows with null or repeated ids stay, and
    pages that are cut off are read as far as they go. An empty table gives an empty result; other columns are left out.
    """
    schema = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).schema.add("host", "string").add("page", "long").add("blocks", T.ArrayType(T.StringType())).add("around", T.ArrayType(T.ArrayType(T.LongType())))
    names = schema.names

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [Page(x).whole for x in b.column(4).to_pylist()]
            texts = pa.array([[t for t, _ in x] for x in found], pa.list_(pa.string()))
            around = pa.array([[a for _, a in x] for x in found], pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], texts, around], names)

    source = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    read = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), urls.host(F.col(url_col)).alias("host"), F.xxhash64(source, F.col(url_col)).alias("page"), source.alias("html"))
    blocks = read.mapInArrow(of_batches, schema)
    asked = blocks.select("page", "host", F.explode(F.array_distinct(F.flatten("around"))).alias("hash")).distinct()
    gone = asked.join(templates(pages, html_col, url_col, min_pages, min_share), ["host", "hash"]).groupBy("page").agg(F.collect_set("hash").alias("gone"))
    joined = blocks.join(gone, "page", "left")
    none = F.array().cast("array<bigint>")
    keep = F.filter(F.arrays_zip("blocks", "around"), lambda x: ~F.arrays_overlap(x["around"], F.coalesce("gone", none)))
    return joined.select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.array_join(F.transform(keep, lambda x: x["blocks"]), "\n").alias("text"))


def op9(spark, sf_dir: str) -> DataFrame:
    found = main_texts(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
