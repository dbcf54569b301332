"""Main text of web pages, by a style tree for each site.

Every page is read into its elements. Elements of the same host with the same way from the root
(tags and classes) are one node of the host's style tree. A node has presentation styles, the
sequences of tags that stand in it, and contents, the texts of its blocks. Over the ``m`` pages that
have the node, a style or content found in ``k`` of them has the entropy ``log_m k``: 1 where all pages
share it, 0 where one page has it. With ``l`` styles the importance of a node is

    (1 - 0.9^l) * presentation + 0.9^l * (1 - mean entropy of its contents)

where the presentation importance is the entropy of the distribution of its styles. Whole pages that
are copies of one another count as one, so a copied article is no template. Blocks of nodes below
``THRESHOLD`` are left out. What an element says of itself comes first: navigation, footers, asides,
forms, scripts and elements whose class, id or role names page furniture have no importance, and plain
elements of an article have full importance. Where a page has an article, or else a main element, the
rest of the page is left out.

Character references are decoded, white space in a block becomes one space, and blocks are joined by
line breaks in page order. An element that is not closed ends where HTML ends it: a paragraph before
the next block, a list item before the next one, everything at the end of the page.

Defined cases: a null or empty page has an empty text. Pages without a host, and nodes of fewer than
``LEAST_PAGES`` pages, are not judged by entropy. If nothing of a page were important, its
undecided blocks stay. Repeated rows are extracted one by one; null ids are kept. An empty table
gives no rows. Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gearwatch.llm.common import by_value, written
from gearwatch.operators.skew import broadcast_if_small

by_value(__name__)

THRESHOLD, LEAST_PAGES, GAMMA = 0.3, 3, 0.9

# How HTML treats its elements.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template", "svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
          "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol",
          "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
             "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
             "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
NO_PARAGRAPH_ABOVE = {"html", "body", "table", "td", "th", "caption", "button", "object", "article", "div"}
CELLS = {"td", "th", "caption", "table"}

# What names page furniture, as an element, a role, or a word of a class or id.
FURNITURE = {"nav", "footer", "aside", "button", "select", "dialog", "menu", "search", "audio", "video", "canvas", "object", "datalist", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies",
         "copyright", "disclaimer", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
         "notification", "overlay", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "respond", "search", "share", "sharing",
         "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget"}
WORDS_OUTSIDE = {"header"}

TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|</?[a-zA-Z][^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'=<>/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
CLASS_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: What a block keeps: nothing of furniture, undecided, or all of an article's plain elements.
GONE, OPEN, PLAIN = 0, 1, 2
#: Where a block stands.
OUTSIDE, IN_MAIN, IN_ARTICLE = 0, 1, 2
#: Rows of the style tree.
PAGE_HAS, STYLE, CONTENT, UNDECIDED = 0, 1, 2, 3


def short_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class Kind:
    """What a tag and its attributes say: label in the style tree, whether it names furniture, and the part of the page it opens."""

    __slots__ = ("label", "gone", "zone", "plain", "soft")

    def __init__(self, tag: str, attributes: str) -> None:
        known = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)} if TELLING.search(attributes) else {}
        classes, role = known.get("class", "").split(), known.get("role", "").strip().lower()
        words = set()
        for name in [*classes, known.get("id", "")]:
            parts = [w.lower() for w in CLASS_WORD.findall(name)]
            words.update(w for i, w in enumerate(parts) if not (i and parts[i - 1] in ("has", "with", "no")))
        self.label = ".".join([tag, *sorted({re.sub(r"\d+", "0", c) for c in classes})])
        self.plain = not classes and not known.get("id")
        self.zone = IN_ARTICLE if tag == "article" or role == "article" or known.get("itemprop", "").lower() == "articlebody" else IN_MAIN if tag == "main" or role == "main" else OUTSIDE
        hidden = "hidden" in known or "display:none" in re.sub(r"\s", "", known.get("style", "")).lower()
        self.gone = tag in FURNITURE or role in ROLES or hidden or (tag not in ("html", "body", "main") and not words.isdisjoint(WORDS))
        # A form around a whole page holds the article; a header inside the article holds its title.
        self.soft = tag in ("form", "header") or (tag not in ("html", "body", "main", "article") and not words.isdisjoint(WORDS_OUTSIDE))


class Open:
    """An open element."""

    __slots__ = ("tag", "path", "zone", "keep", "soft", "block", "linked", "inside", "label")

    def __init__(self, tag, path, zone, keep, soft, block, linked, label) -> None:
        self.tag, self.path, self.zone, self.keep, self.soft, self.block, self.linked, self.label = tag, path, zone, keep, soft, block, linked, label
        self.inside: list[str] = []


class Block:
    """A run of text between the borders of blocks."""

    __slots__ = ("path", "text", "zone", "keep", "linked")

    def __init__(self, path, text, zone, keep, linked) -> None:
        self.path, self.text, self.zone, self.keep, self.linked = path, text, zone, keep, linked


class Page:
    """The blocks of a page in order, and the elements that the style tree is made of."""

    def __init__(self, html: str | None, kinds: dict) -> None:
        self.blocks: list[Block] = []
        self.styles: set[tuple[int, int]] = set()
        self.labels: dict[int, str] = {}
        self.kinds = kinds
        self.stack = [Open("", 0, OUTSIDE, OPEN, False, True, False, "")]
        self.counts: dict[str, int] = {}
        self.pieces: list[str] = []
        self.linked = 0
        if html:
            self.read(html)
        while len(self.stack) > 1:
            self.close()
        self.flush()

    def read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            token = TOKEN.search(html, at)
            if token is None:
                self.text(html[at:])
                return
            start, end = token.span()
            if start > at:
                self.text(html[at:start])
            tag = token[2]
            if tag is None:
                if token[0].startswith("<![CDATA["):
                    self.text(token[0][9:].removesuffix("]]>"))
            elif token[1]:
                self.end(tag.lower())
            else:
                tag = tag.lower()
                if tag in RAW and not token[3].endswith("/"):
                    close = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)[^>]*+(?:>|\\Z)", re.I).search(html, end)
                    end = close.end() if close else size
                else:
                    self.start(tag, token[3])
            at = end

    def text(self, piece: str) -> None:
        top = self.stack[-1]
        piece = unescape(piece) if "&" in piece else piece
        self.pieces.append(piece)
        if top.linked:
            self.linked += len(piece)

    def flush(self) -> None:
        if self.pieces:
            whole = "".join(self.pieces)
            text = " ".join(whole.split())
            if text:
                top = next(e for e in reversed(self.stack) if e.block)
                self.blocks.append(Block(top.path, text, top.zone, GONE if top.soft else top.keep, 10 * self.linked >= 9 * len(whole)))
                self.seen(top, "#")
            self.pieces, self.linked = [], 0

    @staticmethod
    def seen(element: Open, name: str) -> None:
        if not element.inside or element.inside[-1] != name:
            element.inside.append(name)

    def close(self) -> None:
        element = self.stack[-1]
        if element.block:
            self.flush()
            if element.tag:
                self.styles.add((element.path, short_hash(",".join(element.inside))))
                self.labels[element.path] = element.label
        self.stack.pop()
        self.counts[element.tag] -= 1

    def close_until(self, wanted: set[str], barrier: set[str]) -> None:
        """Close the innermost open element of ``wanted`` and all in it, unless a barrier lies between."""
        if not any(self.counts.get(tag) for tag in wanted):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in wanted:
                while len(self.stack) > i:
                    self.close()
                return
            if tag in barrier:
                return

    def end(self, tag: str) -> None:
        if tag in ("html", "body") or not self.counts.get(tag):
            if tag in BLOCKS:
                self.flush()
            return
        if tag in BLOCKS:
            self.close_until({tag}, set() if tag in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "caption") else CELLS)
        else:
            self.close_until({tag}, BLOCKS)

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self.close_until({"p"}, NO_PARAGRAPH_ABOVE)
                self.flush()
            return
        block = tag in BLOCKS
        if block:
            if tag != "option" and self.counts.get("p"):
                self.close_until({"p"}, NO_PARAGRAPH_ABOVE)
            if tag in CLOSED_BY:
                wanted, barrier = CLOSED_BY[tag]
                for _ in wanted:  # a new row ends a cell and the row that holds it
                    self.close_until(wanted, barrier)
            elif tag in ("h1", "h2", "h3", "h4", "h5", "h6") and self.stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                self.close()
        kind = self.kinds.get((tag, attributes))
        if kind is None:
            kind = Kind(tag, attributes)
            if len(self.kinds) < 50_000:  # a memory of what was worked out; what is not in it is worked out again
                self.kinds[tag, attributes] = kind
        if not block and not kind.gone and tag != "a":
            above = self.stack[-1]
            self.stack.append(Open(tag, above.path, above.zone, above.keep, above.soft, False, above.linked, ""))
            self.counts[tag] = self.counts.get(tag, 0) + 1
            return
        block = block or kind.gone  # furniture inside a line of text is cut out of it as a block of its own
        if block:
            self.flush()
        above = self.stack[-1]
        if block:
            self.seen(next(e for e in reversed(self.stack) if e.block), tag)
        zone, keep, soft = above.zone, above.keep, above.soft
        if kind.zone:
            if kind.zone == IN_ARTICLE and zone == IN_ARTICLE and tag == "article":
                keep = GONE  # an article inside an article is a reader's comment
            elif keep != GONE:
                soft = False
                keep = PLAIN if kind.zone == IN_ARTICLE else keep
            zone = max(zone, kind.zone)
        elif kind.soft and (tag == "form" or zone == OUTSIDE):
            soft = True
        if kind.gone:
            keep = GONE
        elif keep == PLAIN and not kind.plain and not kind.zone:
            keep = OPEN
        path = short_hash(f"{above.path}/{kind.label}") if block else above.path
        self.stack.append(Open(tag, path, zone, keep, soft, block, above.linked or tag == "a", kind.label))
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def part(self) -> list[Block]:
        """The blocks that are no furniture, of the article, else of the main element, else of the page."""
        left = [b for b in self.blocks if b.keep != GONE]
        for zone in (IN_ARTICLE, IN_MAIN):
            inner = [b for b in left if b.zone >= zone]
            if inner:
                left = inner
                break
        links: dict[int, int] = {}
        for b in left:
            if b.linked and b.zone != IN_ARTICLE:
                links[b.path] = links.get(b.path, 0) + 1
        return [b for b in left if not (b.linked and links.get(b.path, 0) >= 3)]  # a menu outside of an article

    def extract(self, noise: set[int]) -> str:
        part = self.part()
        important = [b.text for b in part if b.keep == PLAIN or b.path not in noise]
        return "\n".join(important or [b.text for b in part])


def host_of(url: Column) -> Column:
    """Host of a url: behind the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key() -> Column:
    """What tells rows apart as far as their extraction goes."""
    return F.xxhash64(host_of(F.col("url")), "html")


def page_nodes(pages: DataFrame) -> DataFrame:
    """Rows of the style trees, written: (host, path, kind, value, page, label).

    ``page`` is a hash of all texts of the page, so copies of a page give the same rows.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict = {}
        for batch in batches:
            rows: list[tuple] = []
            for host, key, html in zip(batch["host"].to_pylist(), batch["key"].to_pylist(), batch["html"]):
                page = Page(html.as_py(), kinds)
                mark = short_hash("\n".join([b.text for b in page.blocks]))
                rows += [(host, path, PAGE_HAS, None, mark, label) for path, label in page.labels.items()]
                rows += [(host, path, STYLE, style, mark, None) for path, style in page.styles]
                rows += [(host, path, CONTENT, value, mark, None) for path, value in {(b.path, short_hash(b.text)) for b in page.blocks}]
                rows += [(host, path, UNDECIDED, key, mark, None) for path in {b.path for b in page.part() if b.keep == OPEN}]
                if len(rows) >= 200_000:
                    yield table(rows)
                    rows = []
            yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 6
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.string())], ["host", "path", "kind", "value", "page", "label"])

    hosted = pages.select(F.xxhash64(host_of(F.col("url"))).alias("host"), row_key().alias("key"), "html").filter((host_of(F.col("url")) != "") & F.col("html").isNotNull())
    return written(hosted.mapInArrow(parse, "host long, path long, kind long, value long, page long, label string"), "page-nodes")


def style_tree(nodes: DataFrame) -> DataFrame:
    """(host, path, label, pages, styles, presentation, content, importance) of every node of every host.

    Counts go by content first, so a host with a third of all pages is spread over its contents
    and is combined before each shuffle.
    """
    counted = nodes.filter(F.col("kind") != UNDECIDED).dropDuplicates(["host", "path", "kind", "value", "page"])
    values = counted.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("k"), F.min("label").alias("label"))

    def of(kind: int, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    k, logs = F.col("k").cast("double"), F.log(F.col("k").cast("double"))
    tree = values.groupBy("host", "path").agg(
        F.max(of(PAGE_HAS, F.col("k"))).alias("pages"), F.max("label").alias("label"), F.count(of(STYLE, F.col("k"))).alias("styles"),
        F.sum(of(STYLE, k)).alias("all_styles"), F.sum(of(STYLE, k * logs)).alias("style_logs"), F.avg(of(CONTENT, logs)).alias("content_logs"))
    base = F.log(F.col("pages").cast("double"))
    presentation = F.coalesce((F.log("all_styles") - F.col("style_logs") / F.col("all_styles")) / base, F.lit(0.0))
    content = F.coalesce(1 - F.col("content_logs") / base, F.lit(1.0))
    weight = F.pow(F.lit(GAMMA), F.col("styles"))
    several = F.col("pages") > 1
    return tree.select("host", "path", "label", "pages", "styles", F.when(several, F.least(F.lit(1.0), presentation)).otherwise(1.0).alias("presentation"),
                       F.when(several, content).otherwise(1.0).alias("content")).withColumn(
        "importance", (1 - weight) * F.col("presentation") + weight * F.col("content"))


def noise_of(nodes: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(key, paths): for each page with undecided blocks of low importance, their nodes."""
    low = style_tree(nodes).filter((F.col("pages") >= least_pages) & (F.col("importance") < threshold)).select("host", "path")
    undecided = nodes.filter(F.col("kind") == UNDECIDED).select("host", "path", F.col("value").alias("key")).distinct()
    return undecided.join(low, ["host", "path"], "left_semi").groupBy("key").agg(F.collect_set("path").alias("paths"))


def report(pages: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    table = pages.select("page_id", "url", "html")
    noise, _ = broadcast_if_small(written(noise_of(page_nodes(table), threshold, least_pages), "page-noise"))
    marked = table.withColumn("key", row_key()).join(noise, "key", "left").select("page_id", "url", "html", "paths")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict = {}
        for batch in batches:
            found = [Page(html.as_py(), kinds).extract(set(paths.as_py() or ())) for html, paths in zip(batch["html"], batch["paths"])]
            yield pa.record_batch([batch["page_id"], batch["url"], pa.array(found, pa.string())], ["page_id", "url", "text"])

    kind = table.schema["page_id"].dataType.simpleString()
    rows = marked.mapInArrow(texts, f"page_id {kind}, url string, text string")
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
