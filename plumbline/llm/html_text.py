"""Main text of web pages by consensus of the pages of a host.

Every page's containers are scored by the running text they hold. A container is
named by its generalised path: tags with their classes, numbers left out. The scores
vote per host in Spark. A second vote widens the winner to the containers around it
as long as what they add is no list of links; each page is then read at the path of
its host, so a page with an odd layout still follows its host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, join_with_heavy_keys, string
from plumbline.session import scratch_folder

# Elements whose content is no text of the page; elements without end; elements that part blocks.
SILENT = frozenset("script style template noscript iframe svg math canvas object audio video title textarea select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
#: Elements that hold a piece of running text, and those that are so when they stand in the body itself.
TEXT = frozenset("p pre blockquote li h1 h2 h3 h4 h5 h6 td".split())
BESIDE = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 figure".split())
# Elements and roles that are not the article's, and words of a class or id that say so.
APART = frozenset("nav header footer aside form menu dialog button label fieldset".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
APART_WORDS = frozenset("""ad ads advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos promotion
banner banners cookie cookies consent gdpr notice notices alert alerts popup modal newsletter subscribe subscription signup nav navbar
navigation menu menus breadcrumb breadcrumbs header masthead footer sidebar side widget widgets related recommended recommendations
share sharing social comment comments commentlist disqus reply replies respond pagination pager login search searchbox toolbar skip
skiplink""".split())
#: Words that say where or how large a part is, not what it is, and words for what holds the article.
NEUTRAL = frozenset("""site top bottom left right global primary secondary container wrapper wrap box area block list section item items link
links bar unit slot group inner outer panel thread buttons icons media mobile desktop sticky fixed to""".split())
HOLDERS = frozenset("post posts article entry page content main body story blog".split())
#: Elements that hold the page or the article, whatever their classes say.
WHOLE = frozenset("html body main article".split())
#: Share of linked text up to which what stands around the winner belongs to it.
LINKED = 0.3
#: An element that starts closes an open one of these before it.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}
#: Ends a path to which the running text beside it in the body belongs.
WITH_BESIDE = "/*"

_VALUE = r"\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*)"
_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]|[^\s/>=]++(?:{_VALUE})?|=)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s/>=]++)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_NAMED = re.compile(r"class|id|role", re.I)


@lru_cache(maxsize=20_000)
def says_apart(name: str) -> bool:
    """Whether a class or an id is that of a part set apart, all its words taken together.

    Its last word says so, after words for places or holders (``site-footer``, ``post-comments``),
    or its first, before words for places (``sidebar-left``); ``ad-free`` and ``has-sidebar`` do not.
    """
    words = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if w]
    if not words:
        return False
    rest = APART_WORDS | NEUTRAL
    if words[-1] in APART_WORDS and all(w in rest or (w in HOLDERS and words[-1] != "header") for w in words[:-1]):
        return True
    return words[0] in APART_WORDS and all(w in rest for w in words[1:])


def names_of(attributes: str) -> dict[str, str]:
    """Class, id and role of an element; the first of a name counts."""
    out: dict[str, str] = {}
    if _NAMED.search(attributes):
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            if name.lower() in ("class", "id", "role"):
                out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def _set_apart(tag: str, names: dict[str, str], inside_article: bool) -> bool:
    if tag in APART and not (tag == "header" and inside_article):
        return True
    if tag in WHOLE or not names:
        return False
    return names.get("role", "").lower() in APART_ROLES or any(says_apart(n) for k in ("class", "id") for n in names.get(k, "").split())


class Element:
    """An open or closed element. ``holder`` is the innermost element with a path, the element itself if it parts blocks."""

    __slots__ = ("apart", "article", "holder", "linked", "parent", "path", "tag")

    def __init__(self, tag: str, path: str, apart: bool, linked: bool, parent: Element | None):
        self.tag, self.path, self.apart, self.linked, self.parent = tag, path, apart, linked, parent
        self.article = tag in ("article", "main") or (parent is not None and parent.article)
        self.holder = self if path or parent is None else parent.holder


class Page:
    """A page read once: blocks in order, each with its container and the share of its text inside links."""

    def __init__(self, source: str):
        self.blocks: list[tuple[Element, str, float]] = []
        self.root = Element("", "", False, False, None)
        self._open, self._parts, self._linked = self.root, [], 0
        self._read(source)

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            mark = _MARK.search(source, at)
            if mark is None:
                self._text(source[at:])
                break
            if mark.start() > at:
                self._text(source[at:mark.start()])
            at = mark.end()
            if mark.group(2):
                tag = mark.group(2).lower()
                if mark.group(1):
                    self._close(tag)
                elif tag in SILENT:
                    if not mark.group(3).rstrip().endswith("/") or tag not in ("svg", "math", "canvas", "object"):
                        after = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
                        at = end if after is None else after.end()
                else:
                    self._start(tag, mark.group(3))
            elif mark.group().startswith("<![CDATA["):
                self._text(html.escape(mark.group()[9:].removesuffix("]]>"), quote=False))
        self._flush()

    def _text(self, text: str) -> None:
        if self._open.apart:
            return
        self._parts.append(text)
        if self._open.linked:
            self._linked += len(text.strip())

    def _flush(self) -> None:
        if self._parts:
            raw = "".join(self._parts)
            text = " ".join(html.unescape(raw).split())
            if text:
                self.blocks.append((self._open.holder, text, min(1.0, self._linked / max(1, len(raw.strip())))))
            self._parts, self._linked = [], 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._text(" ")
            return
        if tag not in BLOCKS:
            if tag in VOID:
                return
            node = self._open
            if tag == "a":  # a link ends an open one
                self._close("a")
                node = self._open
            apart = node.apart or _set_apart(tag, names_of(attributes), node.article)
            self._open = Element(tag, "", apart, node.linked or tag == "a", node)
            return
        self._flush()
        node, closes = self._open, CLOSED_BY.get(tag, ())
        while closes and node.holder.tag in closes:
            node = node.holder.parent
        if node.holder.tag == "p":  # a block ends an open paragraph
            node = node.holder.parent
        if tag in VOID:
            self._open = node
            return
        names = names_of(attributes)
        classes = sorted({re.sub(r"[\d/]+", "", x).strip("-_") for x in names.get("class", "").lower().split()} - {""})
        apart = node.apart or _set_apart(tag, names, node.article)
        self._open = Element(tag, f"{node.holder.path}/{'.'.join([tag, *classes])}", apart, node.linked, node)

    def _close(self, tag: str) -> None:
        """Ends the innermost open element of that name; the end of an inline element ends none that parts blocks."""
        node, block = self._open, tag in BLOCKS
        while node is not None and node.tag != tag and (block or node.holder is not node):
            node = node.parent
        if node is None or node is self.root or node.tag != tag:
            if block:
                self._flush()
            return
        if block:
            self._flush()
        self._open = node.parent

    # ------------------------------------------------------------ scoring

    def votes(self) -> dict[str, float]:
        """Score per generalised path: running text of a block counts for what holds it, half for what holds that.

        An element that says it is the article or the main part counts more; parts
        set apart count nothing.
        """
        scores: dict[str, float] = {}
        for container, text, linked in self.blocks:
            worth = len(text) * (1 - linked) + 20 * min(3, text.count(",") + text.count("."))
            holder = container.parent.holder if container.tag in TEXT else container
            share = 1.0
            while holder is not None:
                scores[holder.path] = scores.get(holder.path, 0.0) + share * worth * _role(holder)
                holder, share = holder.parent and holder.parent.holder, share / 2
        return scores

    def around(self, path: str) -> dict[int, tuple[float, float]]:
        """Per number of steps of ``path``: text, and linked text, in blocks that share just these with it.

        In the body only running text that stands there itself counts.
        """
        own, known, sums = path.split("/"), {}, {}
        for container, text, linked in self.blocks:
            level = known.get(container.path)
            if level is None:
                level = 0
                for a, b in zip(own, container.path.split("/"), strict=False):
                    if a != b:
                        break
                    level += 1
                if level < len(own) and own[level - 1].partition(".")[0] in ("", "html", "body") and not _beside(container, "/".join(own[:level])):
                    level = -1
                known[container.path] = level
            chars, links = sums.get(level, (0.0, 0.0))
            sums[level] = chars + len(text), links + len(text) * linked
        return sums

    def text(self, path: str | None) -> str:
        """Blocks inside the elements of ``path`` that are not set apart, joined by line feeds.

        With no such element the page's own best path is taken.
        """
        chosen = self._inside(path) if path else []
        if not chosen:
            votes = self.votes()
            if votes:
                best = max(sorted(votes), key=votes.__getitem__)
                chosen = self._inside(widened(best, self.around(best)))
        return "\n".join(chosen)

    def _inside(self, path: str) -> list[str]:
        inner = path.removesuffix(WITH_BESIDE)
        outer = inner.rpartition("/")[0] if inner != path else None
        out, found = [], False
        for container, text, _ in self.blocks:
            inside = container.path == inner or container.path.startswith(inner + "/")
            found |= inside
            if inside or (outer is not None and _beside(container, outer)):
                out.append(text)
        return out if found else []


def _beside(container: Element, outer: str) -> bool:
    """Running text that stands in the element of path ``outer`` itself."""
    return container.path == outer or (container.tag in BESIDE and container.path.rpartition("/")[0] == outer)


def widened(path: str, around: dict[int, tuple[float, float]]) -> str:
    """The outermost container, up to an article or main, that adds no list of links to ``path``.

    What the body (or a page without one) holds itself is added if it is running text, as ``WITH_BESIDE``.
    """
    own = path.split("/")
    best = len(own)
    for level in range(len(own), 0, -1):
        tag = own[level - 1].partition(".")[0]
        chars, linked = around.get(level, (0.0, 0.0)) if level < len(own) else (0.0, 0.0)
        if linked > LINKED * chars:
            break
        if tag in ("", "html", "body"):
            return "/".join(own[:level + 1]) + WITH_BESIDE if chars and level < len(own) else "/".join(own[:best])
        if chars:
            best = level
        if tag in ("article", "main"):
            break
    return "/".join(own[:best])


def _role(container: Element) -> float:
    name = container.path.rpartition("/")[2]
    return 4.0 if container.tag == "article" else 3.0 if container.tag == "main" or re.search(r"article|content|post|entry|story", name) else 1.0


HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes of the pages, added up per host within a task; every page has one vote in all."""
    held: dict[tuple[str, str], list] = {}

    def out():
        rows = [(host, path, *sums) for (host, path), sums in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
            (pa.string(), pa.string(), pa.float64(), pa.int64()))], ["host", "path", "share", "pages"])

    for batch in batches:
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            votes = Page(source).votes()
            total = sum(votes.values())
            for path, score in votes.items():
                sums = held.setdefault((host, path), [0.0, 0])
                sums[0] += score / total if total else 0.0
                sums[1] += 1
        if len(held) > 50_000:
            yield out()
    yield out()


def winning_paths(pages: DataFrame) -> DataFrame:
    """``(host, path)`` of the path with the largest sum of shares; ties go to the first path by name."""
    bounded_batches(pages.sparkSession)
    voted = pages.select(host_of("url").alias("host"), string("html").alias("html")).mapInArrow(
        _vote, "host string, path string, share double, pages bigint")
    sums = voted.groupBy("host", "path").agg(F.round(F.sum("share"), 6).alias("share"))
    best = sums.groupBy("host").agg(F.max(F.struct("share")).getField("share").alias("share"))
    return sums.join(best, ["host", "share"]).groupBy("host").agg(F.min("path").alias("path"))


def _vote_around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What stands around the host's winner, as shares of each page, added up within a task."""
    held: dict[tuple[str, int], list] = {}

    def out():
        rows = [(host, level, *sums) for (host, level), sums in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
            (pa.string(), pa.int32(), pa.float64(), pa.float64()))], ["host", "level", "chars", "linked"])

    for batch in batches:
        for host, path, source in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            around = Page(source).around(path)
            total = sum(chars for chars, _ in around.values())
            for level, (chars, linked) in around.items():
                sums = held.setdefault((host, level), [0.0, 0.0])
                sums[0] += chars / total
                sums[1] += linked / total
        if len(held) > 50_000:
            yield out()
    yield out()


def _widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = [path and widened(path, {a["level"]: (a["chars"], a["linked"]) for a in around or ()})
                 for path, around in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string()), batch.column(2)], ["host", "path", "n"])


def widened_paths(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """``(host, path, n)``: ``winners(host, path, n)`` widened by the votes of ``rows(host, html)``."""
    joined = join_with_heavy_keys(rows.select("host", "html"), winners, "host", "n").where("path is not null").select("host", "path", "html")
    sums = joined.mapInArrow(_vote_around, "host string, level int, chars double, linked double").groupBy("host", "level").agg(
        F.round(F.sum("chars"), 6).alias("chars"), F.round(F.sum("linked"), 6).alias("linked"))
    levels = sums.groupBy("host").agg(F.collect_list(F.struct("level", "chars", "linked")).alias("around"))
    return winners.join(levels, "host", "left").select("host", "path", "n", "around").mapInArrow(_widen, "host string, path string, n bigint")


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every page.

    A null or empty page has the empty text, as has one without any text outside
    parts set apart. Pages without a host in their url vote together. Repeated rows
    give repeated rows; only page_id, url and html are read. The winning paths are a
    table of one row per host: hosts with many pages are joined by a broadcast whose
    size their number proves, the others by an ordinary join.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = scratch_folder(spark, "host-paths")
    rows = pages.select("page_id", "url", host_of("url").alias("host"), string("html").alias("html"))
    sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    winning_paths(pages).join(sizes, "host", "full_outer").write.parquet(folder)
    wider = scratch_folder(spark, "host-paths")
    widened_paths(rows, spark.read.parquet(folder)).write.parquet(wider)
    joined = join_with_heavy_keys(rows, spark.read.parquet(wider), "host", "n").select("page_id", "url", "path", "html")
    id_type = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(source).text(path) for path, source in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars bigint")

