"""Main text of web pages by consensus of each host's pages.

1. Each page's containers are scored: a block of text counts, without its linked characters, for the container that
   holds it and half for the next one out; menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
   reader comments don't count.  They are known by their elements, or by names all of whose words say so; a name doesn't count where it would take the main heading with most of
   the page's text, or all text.  The best container is lifted to the outermost ancestor whose further text is main text too (see ``lifted``), so that a
   heading and lead beside sections stay with them, and votes for its path of tags and classes, numbers in classes generalised.
2. Votes are summed by host and path in Spark, combined before the shuffle; a host's paths of at least
   ``share`` of its votes win, up to ``paths`` of them (only a page in which none of them occurs falls back, see 3).
3. Each page is read again: of the host's winning paths that it has, the one with the highest product of other pages' votes and share of this page's
   text is extracted, so that a small box at a common path doesn't replace the article of a rarer layout; a page with none of them keeps its own best container.  Nothing else is dropped: every block of that container's text comes out, in page order.

Winning paths are broadcast up to a checked number of hosts, and joined by host beyond it.

Edge cases: null or empty html gives an empty text; a page without any container is read from its root; unclosed and stray
tags, comments and scripts are closed where their surroundings end; a page of any depth, or of any number of broken tags, is read in one pass; repeated rows give equal texts; ties in votes go to the
first path by name; a null url is a host of its own; an empty table gives no rows; further columns are neither read nor returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_dir, slices

SCHEMA = "page_id long, url string, text string, n_chars long"

_ATTRIBUTES = r"""(?:[^<>"']|"[^"]*"|'[^']*'|["'])*+"""
#: No alternative reads on past the next < but within quotes, a comment or an element whose content isn't markup, so reading is linear on broken pages too.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|noscript|template|iframe|svg|textarea|title)\b" + _ATTRIBUTES + r">.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)(" + _ATTRIBUTES + r")(?:>|(?=<)|\Z)|<[/!?][^<>]*+(?:>|(?=<)|\Z)",
    re.S | re.I,
)
CLASS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

# Kinds of HTML elements, and names that sites give to what isn't their main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div td th table tbody tr center figure details".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote nav header footer aside form fieldset address hr br figcaption thead tfoot caption summary head title".split())
EXCLUDED = frozenset("nav header footer aside form button select option dialog menu head object canvas".split())
CLOSES_P = BLOCKS - {"br", "td", "th", "html", "body"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer form gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification popup promo promoted promotion related respond replies search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)

#: Words that only say where such a part is or what kind of box it is.  A name is unwanted if all its words are of these two lists: cookie-banner and site-header, not with-sidebar, related-work or share-price.
PLACES = frozenset("site page main global primary secondary top bottom left right upper lower mobile desktop sticky fixed floating post article blog entry area block box bar list section container wrapper wrap inner outer panel item items links link icons buttons button col column row group holder js".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Characters from which a block outside articles is taken for prose.
PROSE = 80


#: Excluded by name alone.
DOUBTED = "by name"


class Node:
    """An element: ``path`` stands for its tags and classes from the root, ``holder`` is the container around it, ``inside`` says that it is or lies in an article or main element.

    ``barrier`` is the place in the stack of the innermost element that implied closing can't pass.  ``sums``: of the text held below it, see ``weighed``.

    ``doubt`` is the innermost element around it, or itself, that is excluded by its name alone; that one has a ``number``, the unlinked ``chars`` in it, and whether it is ``titled``, that is holds a main heading."""

    __slots__ = ("tag", "parent", "path", "excluded", "link", "holder", "inside", "barrier", "sums", "heading", "doubt", "number", "chars", "titled")

    def __init__(self, tag: str, parent: Node | None, name: str, excluded: bool, link: bool, place: int):
        self.tag, self.parent, self.excluded, self.link = tag, parent, excluded, link
        self.heading = tag in HEADINGS or parent is not None and parent.heading
        self.doubt = parent.doubt if parent is not None else None
        self.number, self.chars, self.titled = 0, 0, False
        self.holder = self if parent is None or tag in CONTAINERS else parent.holder
        self.path = "" if parent is None else xxhash.xxh3_128_hexdigest(f"{parent.path}/{name}".encode("utf-8", "surrogatepass"))
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        stops = tag in CONTAINERS and tag not in ("tr", "td", "th") or tag in ("ul", "ol", "dl", "table")
        self.barrier = place if stops or parent is None else parent.barrier
        self.sums = None


class Page:
    """``blocks``: text, container, linked characters, in page order.  ``nodes``: parents before children."""

    def __init__(self, html: str):
        self.blocks: list[tuple[str, Node, int]] = []
        wrong: frozenset[int] = frozenset()
        for again in (False, True):
            self.blocks, self.headings, self.doubts = [], [], []
            self.nodes = [Node("", None, "", False, False, 0)]
            self._read(html, wrong)
            wrong = self._wrongly_excluded()
            if again or not wrong:
                break
        self.short: dict[str, int] = {}
        self.sums = self._weighed()

    def _wrongly_excluded(self) -> frozenset[int]:
        """Elements whose name excludes them, but that hold a main heading and most of the page's text, so are around the article; or all, where nothing else has text."""
        for node in reversed(self.doubts):
            outer = node.parent.doubt
            if outer is not None:
                outer.chars += node.chars
                outer.titled |= node.titled
        total = sum(len(text) - linked for text, _, linked in self.blocks) + sum(d.chars for d in self.doubts if d.parent.doubt is None)
        return frozenset(d.number for d in self.doubts if not self.blocks or d.titled and 2 * d.chars > total)

    def _read(self, html: str, wrong: frozenset[int]) -> None:
        stack, out, parts = [self.nodes[0]], self.blocks, []
        places: dict[str, list[int]] = {}  # of each tag, where it is open in the stack
        linked, owner, heading, named_so = 0, stack[0], False, 0

        def flush() -> None:
            nonlocal linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    out.append((text, owner, min(linked, len(text))))
                    self.headings.append(heading)
                parts.clear()
            linked = 0

        def add(raw: str) -> None:
            nonlocal linked, owner, heading
            top = stack[-1]
            if top.doubt is not None and not top.link and top.doubt.excluded is DOUBTED:
                top.doubt.chars += len(" ".join(raw.split()))
            if not top.excluded:
                text = unescape(raw) if "&" in raw else raw
                if not parts:
                    if not text.strip():
                        return
                    owner, heading = top.holder, top.heading
                parts.append(text)
                if top.link:
                    linked += len(text)

        def close(place: int) -> None:
            for node in stack[place:]:
                places[node.tag].pop()
            del stack[place:]

        at = 0
        for m in TOKEN.finditer(html):
            if m.start() > at:
                add(html[at : m.start()])
            at = m.end()
            tag = (m[3] or "").lower()
            if not tag:
                if m[0].startswith("<![CDATA["):
                    add(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
                continue
            if tag in BLOCKS:
                flush()
            if m[2]:
                if places.get(tag):
                    close(places[tag][-1])
                continue
            if tag in VOID:
                continue
            # what the start of this tag implies closed: an open paragraph, or a sibling
            shut = SIBLINGS.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
            place = max((places[x][-1] for x in shut if places.get(x)), default=0)
            if place and place >= stack[-1].barrier:
                close(place)
            name, unwanted = named(tag, m[4])
            top = stack[-1]
            if not m[4].endswith("/") or tag in BLOCKS:
                places.setdefault(tag, []).append(len(stack))
                named_so += unwanted
                doubted = unwanted and tag not in EXCLUDED and top.excluded is not True and named_so not in wrong
                node = Node(tag, top, name, True if tag in EXCLUDED or top.excluded is True else DOUBTED if doubted else top.excluded, top.link or tag == "a", len(stack))
                if doubted:
                    node.doubt, node.number = node, named_so
                    self.doubts.append(node)
                elif node.excluded is True:
                    node.doubt = None
                elif tag in ("h1", "main") and node.doubt is not None:
                    node.doubt.titled = True
                stack.append(node)
                self.nodes.append(node)
        if at < len(html):
            add(html[at:])
        flush()

    def _weighed(self) -> dict[str, list[int]]:
        """By path, over its elements' blocks: characters; characters not linked; and the main text less the other text, as an article counts it and as the rest of a page does:
        in an article or main element every block counts as main text unless most of it is linked, elsewhere only a heading or one of at least ``PROSE`` characters does, or all where none is so
        long.  ``short``: by path, twice the characters of its own other blocks, which count as main text for the container they lie in directly, but not for those around it."""
        prose = any(len(text) >= PROSE and 2 * linked <= len(text) for text, _, linked in self.blocks)
        for (text, holder, linked), heading in zip(self.blocks, self.headings):
            n, mostly = len(text), 2 * linked <= len(text)
            long = n >= PROSE or heading or not prose
            if mostly and not long:
                self.short[holder.path] = self.short.get(holder.path, 0) + 2 * n - linked
            more = n, n - linked, n - linked if mostly else -n, n - linked if mostly and long else -n
            holder.sums = [a + b for a, b in zip(holder.sums or (0, 0, 0, 0), more)]
        out: dict[str, list[int]] = {}
        for node in reversed(self.nodes):
            if node.sums:
                if node.parent:
                    node.parent.sums = [a + b for a, b in zip(node.parent.sums or (0, 0, 0, 0), node.sums)]
                out[node.path] = [a + b for a, b in zip(out.get(node.path, (0, 0, 0, 0)), node.sums)]
        return out

    def under(self, path: str) -> list[str]:
        """The blocks in elements of ``path``."""
        inside: set[int] = set()
        for node in self.nodes:
            if node.path == path or node.parent is not None and id(node.parent) in inside:
                inside.add(id(node))
        return [text for text, holder, _ in self.blocks if id(holder) in inside]


def is_unwanted(name: str) -> bool:
    words = [w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if len(w) > 1]
    return any(w in UNWANTED for w in words) and all(w in UNWANTED or w in PLACES for w in words)


def named(tag: str, attributes: str) -> tuple[str, bool]:
    """A tag with its generalised classes, and whether its names say that it isn't main text."""
    classes, unwanted = "", False
    for m in CLASS.finditer(attributes) if attributes else ():
        value = unescape(m[2] or m[3] or m[4] or "")
        if tag not in ("html", "body", "article", "main"):
            unwanted |= any(map(is_unwanted, value.split())) or value.lower() in ("complementary", "contentinfo")
        value = value.lower()
        if m[1].lower() == "class":
            classes = "".join(sorted({"." + re.sub(r"\d+", "#", c) for c in value.split()}))
    return tag + classes, unwanted


def best_container(page: Page) -> tuple[str, float]:
    """The path of the page's best-scored container, and its share of the page's text."""
    score: dict[str, float] = {}
    for text, holder, linked in page.blocks:
        n = len(text) - linked
        score[holder.path] = score.get(holder.path, 0) + n
        outer = holder.parent.holder if holder.parent else None
        if outer is not None:
            score[outer.path] = score.get(outer.path, 0) + n / 2
    if not score:
        return "", 0.0
    path = lifted(page, max(score, key=score.__getitem__))
    return path, page.sums[path][0] / max(1, page.sums[""][0])


def lifted(page: Page, path: str) -> str:
    """The outermost path around ``path`` that adds more main text than other text."""
    node = next(n for n in page.nodes if n.path == path).parent
    while node is not None:
        kind = 2 if node.inside else 3
        if page.sums[node.path][kind] + (0 if node.inside else page.short.get(node.path, 0)) > page.sums[path][kind]:
            path = node.path
        node = node.parent
    return path


def text_at(page: Page, paths: list[str], votes: list[int] | None = None) -> str:
    """The text under that of ``paths`` which other pages' votes times the share of this page's text favour, or under its own best container.

    This page's own vote is no agreement and counts a tenth."""
    own = best_container(page)[0]
    weight = {path: (n - 0.9 * (path == own)) * page.sums.get(path, (0, 0))[1] for path, n in zip(paths, votes or [1] * len(paths))}
    for path in [*sorted(paths, key=lambda p: -weight[p]), own, ""]:
        if path in page.sums:
            return "\n".join(page.under(path))
    return ""


def vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, pages in slices(batches, "html"):
        path, share = zip(*[best_container(Page((p or b"").decode("utf-8", "replace"))) for p in pages])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(path, pa.string()), pa.array(share, pa.float64())], names=["host", "path", "share"])


def extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, pages in slices(batches, "html"):
        paths, votes = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("paths", "votes"))
        texts = [text_at(Page((p or b"").decode("utf-8", "replace")), w or [], v) for p, w, v in zip(pages, paths, votes)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])


@dataclass(frozen=True)
class Settings:
    """``broadcast_hosts``: up to so many hosts the winning paths are broadcast."""

    share: float = 0.05
    paths: int = 8
    broadcast_hosts: int = 100_000


def winning_paths(pages: DataFrame, s: Settings = Settings()) -> DataFrame:
    """host, paths, votes: of each host its winning paths, most votes first, and their votes.  ``pages`` has host and html."""
    votes = pages.select("host", "html").mapInArrow(vote_batches, "host string, path string, share double").where("path <> ''")
    votes = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("share").alias("share"))
    ranked = votes.withColumn("of", F.sum("votes").over(Window.partitionBy("host"))).withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path")))
    won = ranked.where((F.col("rank") == 1) | ((F.col("votes") >= s.share * F.col("of")) & (F.col("rank") <= s.paths)))
    listed = won.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "path", "votes"))).alias("won"))
    return listed.select("host", F.col("won.path").alias("paths"), F.col("won.votes").alias("votes"))


def extract(pages: DataFrame, settings: Settings = Settings(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows of SCHEMA, one a page."""
    shared_dir(pages.sparkSession)
    host = F.coalesce(F.regexp_extract(F.lower(url_col), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    won = winning_paths(rows, settings).checkpoint()
    if won.count() <= settings.broadcast_hosts:
        won = F.broadcast(won)
    return rows.join(won, "host", "left").select("page_id", "url", "html", "paths", "votes").mapInArrow(extract_batches, SCHEMA)
