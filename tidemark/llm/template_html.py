"""Main text of web pages: site templates are found by counting element subtrees per host, and deleted.

1. A page is read in one pass over its tags, into blocks of text. Each block-level element's subtree is hashed over the
   host, its tag, its class and id, and its text (addresses and other attributes vary from page to page and are left
   out). A block carries the hashes of the elements around it.
2. Spark counts, per host, on how many different pages each hash occurs (copies of one page count once, by a hash of its
   main text). Hashes on a tenth of a host's pages, whatever its size, and on `MIN_PAGES` at least, are template. A host
   with any share of all pages is only a longer column of partial sums.
3. Pages are read again, and the subtrees with template hashes are deleted: menus, banners, footers, sidebars, however
   marked up. A filter of fixed size, made of the template hashes, tells at once for most pages what is left; where text
   depends on what the filter lets through, an exact join decides. The elements that carry the article, and inside it all prose, are never
   deleted: text that an author repeats, or that copies share, is no template.
4. What a template cannot show, such as an advert that stands on one page only, goes by its mark-up: elements that are no
   text, landmarks other than the article, and blocks whose class, id or role names them so. If there is an article (or
   main) element, only its inside is kept; there ids do not count, since they name headings and sections.

White space in a block becomes one space, blocks are joined by an empty line, character references are decoded.

Defined results: a null or empty page, or one without text, has the empty text and n_chars 0. A null URL, or one without a
host, counts to the host "". Unclosed, stray and misnested tags are accepted, and a page cut off in a tag ends there.
Repeated rows count as one page and each comes out. An empty table gives no rows. Of the input, page_id, url and html
are read, so other columns cannot clash. Very long pages are parsed as a whole; one page is the unit of memory.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.counts import bit_filter, has_bit
from tidemark.llm.tables import table
from tidemark.llm.textbytes import pieces
from tidemark.llm.url_filter import url_parts
from tidemark.session import materialize

MIN_SHARE = 0.1  # of a host's pages, at every size
MIN_PAGES = 3
SALTS = 16
FILTER_BITS = 24  # 2 MB

# How HTML elements behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style textarea title xmp iframe noembed noframes"
NO_TEXT = frozenset(
    "script style head title noscript template iframe object embed svg math canvas audio video map select option "
    "optgroup datalist textarea button input form fieldset label dialog noembed noframes xmp".split()
)
LANDMARKS = frozenset("nav footer aside menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("caption dd dt li legend tbody td tfoot th thead tr body head html".split())
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
SCOPES = frozenset("html body article main section div table ul ol dl aside nav footer header form blockquote".split())
ARTICLE = frozenset(["article", "main"])
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
FLOW = PROSE | frozenset("li dd dt td th figcaption".split())
# Names in class, id or role that mark a block as no part of the article.
BOILERPLATE = re.compile(
    r"(?:^|(?<!has)(?<!with)(?<!no)[_-]|\s)(?:ads?|adverts?|advertisement|advertising|sponsored|sponsors?|promo|promotion|banner|"
    r"cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|"
    r"aside|widgets?|footer|foot|masthead|topbar|toolbar|comments?|replies|reply|disqus|respond|share|sharing|social|"
    r"subscribe|subscription|newsletter|signup|login|related|recommended|recommendations|search|pagination|pager|skip|"
    r"complementary|contentinfo|dialog|alertdialog)(?:$|[\s_-])",
    re.IGNORECASE,
)
ATTRIBUTES = r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)"""
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({'|'.join(RAW.split())})\b{ATTRIBUTES}>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*){ATTRIBUTES}>|"
    r"<[a-zA-Z/!?][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
CLASSED = re.compile(NAMED.pattern.replace("class|id|role", "class|role"), re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=\s|=|$)|display\s*:\s*none", re.IGNORECASE)
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


def code_of(parts: list[str]) -> int:
    digest = hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(digest.digest(), "little", signed=True)


class Element:
    """An element that is open while the page is read; block-level ones are hashed when they end."""

    __slots__ = ("tag", "parts", "noise", "within", "prose", "block", "code")

    def __init__(self, host: str, tag: str, names: str, noise: bool, within: bool):
        self.tag, self.noise, self.within = tag, noise, within
        self.block = tag in BLOCKS
        self.parts = [host, tag, names]
        self.prose = False
        self.code = 0

    def may_be_template(self) -> bool:
        if self.within and not self.noise:
            return not self.prose and self.tag not in FLOW and self.tag not in ARTICLE
        return self.tag not in ("#root", "html", "body", "head", "main", "article")


class Reader:
    """One pass over a page: its blocks (text, is it noise by mark-up, elements around it) and all block-level elements."""

    def __init__(self, page: str, host: str):
        self.host = host
        self.stack = [Element(host, "#root", "", False, False)]
        self.ended: list[Element] = []
        self.blocks: list[tuple[str, bool, bool, list[Element]]] = []
        self.pending: list[str] = []
        self.around: list[Element] = []
        self.has_article = False
        at = 0
        for found in TOKEN.finditer(page):
            if found.start() > at:
                self.text(page[at : found.start()])
            at = found.end()
            if found.group(4):
                tag = found.group(4).lower()
                self.end(tag) if found.group(3) else self.start(tag, found.group(5))
        if at < len(page):
            self.text(page[at:])
        self.close_to(1)
        self.end_block()

    def text(self, piece: str) -> None:
        top = self.stack[-1]
        if not self.pending:
            if piece.isspace():
                return
            self.around = [e for e in self.stack if e.block]
        self.pending.append(piece)
        top.parts.append(piece)

    def end_block(self) -> None:
        if self.pending:
            text = " ".join(html.unescape("".join(self.pending)).split())
            self.pending = []
            if text:
                top = self.around[-1] if self.around else self.stack[0]
                self.blocks.append((text, top.noise, top.within, self.around))

    def start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            self.close_nearest(("p",))
        if tag in CLOSED_BY:
            self.close_nearest(CLOSED_BY[tag])
        if tag in BLOCKS:
            self.end_block()
        if tag in VOID:
            if self.pending and tag in ("br", "hr", "wbr"):
                self.pending.append(" ")
            return
        names = ""
        if "=" in attributes:
            names = " ".join(a or b or c for a, b, c in NAMED.findall(attributes))
        parent = self.stack[-1]
        noise = parent.noise or tag in NO_TEXT or tag in LANDMARKS or (tag == "header" and not parent.within)
        if not noise and tag not in ("html", "body"):
            marks = names
            if parent.within and names:  # ids inside an article name its headings and sections, not boilerplate
                marks = " ".join(a or b or c for a, b, c in CLASSED.findall(attributes))
            noise = bool(marks and BOILERPLATE.search(HUMP.sub("-", marks))) or bool(attributes and HIDDEN.search(attributes))
        within = parent.within or (tag in ARTICLE and not noise)
        self.has_article = self.has_article or within
        element = Element(self.host, tag, names, noise, within)
        if noise and not parent.noise and not element.block:
            # An inline element that is noise stands apart from the block around it.
            self.end_block()
            element.block = True
        if tag in PROSE:
            for outer in self.stack:
                outer.prose = True
        if not attributes.endswith("/"):
            self.stack.append(element)

    def end(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                self.close_to(depth)
                return
            if tag not in BLOCKS and self.stack[depth].tag in BLOCKS:
                return  # an inline end tag does not reach out of its block
        if tag == "p":
            self.end_block()

    def close_nearest(self, tags) -> None:
        """Ends the nearest open element with one of the tags, unless a container stands in between."""
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in tags:
                self.close_to(depth)
                return
            if self.stack[depth].tag in SCOPES:
                return

    def close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            element = self.stack.pop()
            if element.block:
                self.end_block()
                element.code = code_of(element.parts)
                self.ended.append(element)
                self.stack[-1].parts.append(str(element.code))
            else:
                self.stack[-1].parts.extend(element.parts)


def read_page(page: str, host: str = "") -> tuple[list[dict], list[int], int]:
    """Blocks of a page, hashes of its subtrees that may be template, and the hash of its main text."""
    reader = Reader(page, host)
    blocks = []
    for text, noise, within, around in reader.blocks:
        lost = noise or (reader.has_article and not within)
        codes = [e.code for e in around if e.may_be_template()]
        blocks.append({"text": text, "noise": lost, "around": codes})
    main = code_of([b["text"] for b in blocks if not b["noise"]])
    return blocks, sorted({e.code for e in reader.ended if e.may_be_template() and len(e.parts) > 3}), main


SUBTREES = "host bigint, main bigint, code bigint"


def subtree_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page (host, hash of its main text) and subtree that may be template a row, and one without a subtree."""
    for batch in batches:
        for part in pieces(batch, "html"):
            hosts, mains, found = [], [], []
            for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                _, codes, main = read_page(page or "", host)
                hosts.extend([code_of([host])] * (len(codes) + 1))
                mains.extend([main] * (len(codes) + 1))
                found.extend([*codes, None])
            arrays = [pa.array(c, pa.int64()) for c in (hosts, mains, found)]
            yield pa.RecordBatch.from_arrays(arrays, ["host", "main", "code"])


def template_hashes(subtrees: DataFrame) -> DataFrame:
    """(code) of the subtrees on many different pages of their host, from rows (host, main, code)."""
    seen = materialize(subtrees.distinct())
    sizes = seen.groupBy("host").agg(F.approx_count_distinct("main", 0.02).alias("pages"))
    counts = seen.filter("code IS NOT NULL").groupBy("host", "code").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_PAGES)
    # A host may have very many subtrees: they are dealt over several copies of its row.
    counts = counts.withColumn("salt", F.pmod("code", F.lit(SALTS)).cast("int"))
    sizes = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    enough = F.greatest(F.lit(MIN_PAGES), F.ceil(F.col("pages") * MIN_SHARE))
    return counts.join(sizes, ["host", "salt"]).filter(F.col("n") >= enough).select("code")


READ = (
    "page_id bigint, url string, text string, blocks array<struct<text:string,noise:boolean,around:array<bigint>>>, "
    "subtrees array<bigint>"
)
BLOCK_TYPE = pa.list_(pa.struct([("text", pa.string()), ("noise", pa.bool_()), ("around", pa.list_(pa.int64()))]))


def read_batches(bits: Broadcast):
    """Per page its text, or its blocks and the subtrees that may be template where the text depends on those."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "html"):
                texts, blocks, subtrees = [], [], []
                for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    found, codes, _ = read_page(page or "", host)
                    own = np.array(codes, np.int64)
                    hits = set(own[has_bit(bits.value, own, FILTER_BITS)].tolist())
                    open_blocks = any(not b["noise"] and not hits.isdisjoint(b["around"]) for b in found) if hits else False
                    texts.append(None if open_blocks else "\n\n".join(b["text"] for b in found if not b["noise"]))
                    blocks.append(found if open_blocks else [])
                    subtrees.append(sorted(hits) if open_blocks else [])
                arrays = [pa.array(texts, pa.string()), pa.array(blocks, BLOCK_TYPE), pa.array(subtrees, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), *arrays], ["page_id", "url", "text", "blocks", "subtrees"]
                )

    return rows


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page (page_id, url, html): page_id, url, text, n_chars."""
    host = url_parts(F.col("url"))["host"].alias("host")
    source = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", host, "html")
    template = materialize(template_hashes(source.select("host", "html").mapInArrow(subtree_batches, SUBTREES)))
    bits = pages.sparkSession.sparkContext.broadcast(bit_filter(template, "code", FILTER_BITS))
    read = source.mapInArrow(read_batches(bits), READ)
    plain = read.filter("text IS NOT NULL").select("page_id", "url", "text")
    touched = materialize(read.filter("text IS NULL").drop("text").withColumn("row", F.monotonically_increasing_id()))
    # The template hashes of one page: at most as many as it has elements.
    own = touched.select("row", F.explode("subtrees").alias("code")).join(template, "code")
    own = own.groupBy("row").agg(F.collect_list("code").alias("template"))
    found = F.coalesce("template", F.array().cast("array<bigint>"))
    stays = F.filter("blocks", lambda b: ~b["noise"] & ~F.arrays_overlap(b["around"], found))
    text = F.array_join(F.transform(stays, lambda b: b["text"]), "\n\n")
    rest = touched.join(own, "row", "left").select("page_id", "url", text.alias("text"))
    both = plain.unionByName(rest)
    return both.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
