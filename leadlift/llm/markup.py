"""Main text of web pages: elements that a site repeats are template and go.

Every element's subtree, its tags and text, has a hash. Spark counts for each host on how
many pages a subtree stands outside of marked articles, and in how many different articles
inside of them; an article under many addresses counts once there. Outside, a subtree on
``least_pages`` pages and ``least_share`` of the host's is template. Inside, a block in
``least_pages`` articles and ``least_share_inside`` of the host's is. Parts of sentences,
and inside articles titles, list items and table cells, go only with a whole that does. A
page's text is what is left without template, without elements whose kind or name says
menu, header, footer, sidebar, notice, advert, form or comment, and, if the page marks its
article, outside of it.

Counts are summed before each shuffle and no host's templates are gathered in one row. All
templates are broadcast while they number ``BROADCAST`` at most. Beyond, the subtrees of
each page are joined with them, and a page carries those that it holds.

Defined cases: NULL and empty html have the empty text; html that breaks off is read as
far as it goes; very long and very deep pages are read whole, without recursion; a NULL or
odd url is a host of its own name; repeated rows count as pages each; a subtree exactly at
a bound is template; without rows there are none; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.llm.common import fields, query, scratch, slices, table

BROADCAST = 300_000

#: Comments, declarations, elements with raw text, and tags, none of which is walked twice.
TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<[!?][^>]*+>?"
    r"|<(?P<raw>script|style|textarea|iframe|title)(?=[\s/>])[^>]*+>(?:.*?</(?P=raw)\s*+>|.*)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-z][^<>]*+>?",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([a-z][a-z0-9:_-]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without text of the page. One that is never closed ends where it starts.
EMPTY = frozenset("noscript template object svg math select button".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr noscript template object svg math select button".split()
)
#: What an opening tag ends if it is still open.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
        "th": {"td", "th", "p"}, "option": {"option"}}
ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
AWAY = frozenset("head nav footer aside form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar comment".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets cookie cookies consent gdpr notice notification "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "comment comments reply replies respond disqus form search skip pagination pager toolbar".split()
)
#: Of these an article's heading may be made.
HEADINGS = frozenset(("header", "masthead"))
#: Of these an article may speak; inside it they count only in a name like "search-form".
TOPICS = frozenset("social search form alert banner notice overlay reply respond share sponsor subscription related".split())
#: Names of an <article> that is not the page's own.
OTHER_ARTICLES = frozenset("comment comments reply related teaser ad advert promo sponsored card".split())
BODY_NAMES = frozenset(("article-body", "articlebody", "post-content", "entry-content", "article-content", "main-content", "story-body"))
#: Inside an article these are template only with what is around them.
PIECES = frozenset("h1 li dt dd tr td th tbody thead tfoot caption option".split())


@dataclass(slots=True)
class Element:
    name: str
    parent: int
    away: bool = False
    main: bool = False
    article: bool = False  # an article's part, or the article itself
    parts: list = field(default_factory=list)  # texts, and the places of elements


@dataclass
class Page:
    """A page's elements in order of their start, and its texts with the element each is in."""

    elements: list[Element]
    texts: list[tuple[int, str]]  # a blank text is also a block's edge

    def lost(self) -> list[int]:
        """For each element the nearest one, itself included, that is away; or -1."""
        out = [-1]
        for i, e in enumerate(self.elements[1:], 1):
            out.append(i if e.away else out[e.parent])
        return out

    def digests(self) -> list[int | None]:
        """The hash of each subtree, None where it has no text."""
        import xxhash

        out: list = [None] * len(self.elements)
        for i in range(len(self.elements) - 1, -1, -1):
            e = self.elements[i]
            inside = [out[p] if isinstance(p, int) else " ".join(p.split()) for p in e.parts]
            inside = [f"\2{x:x}" if isinstance(x, int) else x for x in inside if x]
            if inside:
                out[i] = xxhash.xxh3_64_intdigest(f"{e.name}\0" + "\1".join(inside)) - 2**63
        return out

    def articles(self, lost: list[int]) -> list[int]:
        """The page's articles; those of a <main> that has any stand for it.

        If there are none but in elements whose names say otherwise, these.
        """
        above = [-1] * len(self.elements)  # the nearest marked element around
        found = []
        for i, e in enumerate(self.elements[1:], 1):
            above[i] = e.parent if self.elements[e.parent].main else above[e.parent]
            if e.main:
                found.append(i)
        outer = [i for i in found if above[i] < 0]
        outer = [i for i in outer if lost[i] < 0] or outer
        within: dict[int, list[int]] = {}
        for i in found:
            if above[i] >= 0 and self.elements[i].name == "article" and lost[i] <= above[i]:
                within.setdefault(above[i], []).append(i)
        return [j for i in outer for j in (self.elements[i].name != "article" and within.get(i) or [i])]

    def regions(self, articles: list[int]) -> list[int]:
        """For each element the article it is in, or -1."""
        chosen = set(articles)
        out = [-1]
        for i, e in enumerate(self.elements[1:], 1):
            out.append(i if i in chosen else out[e.parent])
        return out

    def subtrees(self) -> Iterator[tuple[int, int | None, int]]:
        """(element, article's hash or None outside of articles, hash) of what may be template."""
        lost, digests = self.lost(), self.digests()
        articles = self.articles(lost)
        regions = self.regions(articles)
        for i, e in enumerate(self.elements):
            at = regions[i]
            if not i or digests[i] is None:
                continue
            if at < 0:
                # What stands in running text goes only with it.
                around = self.elements[e.parent].parts
                if e.name not in INLINE or not any(isinstance(p, str) and not p.isspace() for p in around):
                    yield i, None, digests[i]
            elif i != at and lost[i] <= at and e.name not in INLINE and e.name not in PIECES:
                yield i, digests[at], digests[i]

    def text(self, templates: frozenset = frozenset(), host: int = 0) -> str:
        lost = self.lost()
        articles = self.articles(lost)
        regions = self.regions(articles)
        gone = bytearray(len(self.elements))
        if templates:
            for i, article, digest in self.subtrees():
                gone[i] = key(host, article is not None, digest) in templates
        for i, e in enumerate(self.elements[1:], 1):
            gone[i] |= gone[e.parent] and regions[i] == regions[e.parent]
        out: list[str] = []
        last = -1
        for owner, part in self.texts:
            at = regions[owner]
            if (at < 0 and articles) or gone[owner] or lost[owner] > at:
                continue
            if at != last:
                out.append(" ")
                last = at
            out.append(entities.unescape(part) if "&" in part else part)
        return " ".join("".join(out).split())


def style_hides(key: str, value: str) -> bool:
    if key == "hidden":
        return value != "until-found"
    if key == "aria-hidden":
        return value.strip() == "true"
    return key == "style" and re.search(r"(?:^|;)\s*display\s*:\s*none", value) is not None


def named_away(value: str, inside: bool) -> bool:
    """Whether a class or id says that an element is not text."""
    for name in value.split():
        parts = re.split(r"[_-]+", name)
        hits = NAMES.intersection(parts)
        if inside:
            hits -= HEADINGS
            if hits <= TOPICS and (len(parts) == 1 or "results" in parts or "history" in parts):
                continue
        if hits:
            return True
    return False


def attributes(name: str, rest: str, inside: bool) -> tuple[bool, bool]:
    """Whether kind and names say that an element is not text, or that it is the main one.

    ``inside``: it stands in the main one.
    """
    away, main = name in AWAY or name in EMPTY or name == "header" and not inside, name in ("article", "main")
    hidden = False
    for key, a, b, c in ATTRIBUTE.findall(rest) if rest else ():
        key, value = key.lower(), (a or b or c).lower()
        hidden = hidden or style_hides(key, value)
        if name in ("main", "html", "body"):
            continue
        if name == "article":
            if key == "class" and not OTHER_ARTICLES.isdisjoint(value.split()):
                return True, False
        elif key == "role":
            away |= value in ROLES
            main |= value in ("main", "article")
        elif key in ("class", "id"):
            if not BODY_NAMES.isdisjoint(value.split()):
                main = True
            else:
                away |= named_away(value, inside)
        elif key == "itemprop":
            main |= value == "articlebody"
    if hidden:
        return name not in ("html", "body"), False
    return away and not main, main


def parse(page: str) -> Page:
    elements = [Element("#page", 0)]
    texts: list[tuple[int, str]] = []
    stack = [0]
    still: Counter = Counter()  # names of open elements
    closed: dict[str, int] = {}  # where the last end of an EMPTY element stands
    at = 0

    def add(text: str) -> None:
        elements[stack[-1]].parts.append(text)
        texts.append((stack[-1], text))

    def close(depth: int) -> None:
        while len(stack) > depth:
            element = elements[stack.pop()]
            still[element.name] -= 1
            if element.name not in INLINE:
                texts.append((element.parent, " "))

    for token in TOKEN.finditer(page):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        name = token["name"]
        if not name:
            continue
        name = name.lower()
        if token["close"]:
            if name == "br":
                texts.append((stack[-1], " "))
            if not still[name]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                around = elements[stack[depth]].name
                if around == name:
                    close(depth)
                    break
                # A stray end of an inline element does not end blocks around it.
                if name in INLINE and name not in EMPTY and around not in INLINE:
                    break
            continue
        if name in VOID:
            if name in ("br", "hr"):
                texts.append((stack[-1], " "))
            continue
        if name in EMPTY:
            if name not in closed:
                closed[name] = max((m.start() for m in re.finditer(f"</{name}", page, re.I)), default=-1)
            if closed[name] < at:
                continue
        ends = ENDS.get(name, frozenset())
        while len(stack) > 1:
            around = elements[stack[-1]].name
            if not (around in ends or name in ENDS_P and still["p"] and (around == "p" or p_around(elements, stack))):
                break
            close(len(stack) - 1)
        parent = elements[stack[-1]]
        away, main = attributes(name, token["rest"], parent.article)
        element = Element(name, stack[-1], away, main, main or parent.article)
        if name not in INLINE:
            texts.append((stack[-1], " "))
        parent.parts.append(len(elements))
        elements.append(element)
        if not token["rest"].endswith("/"):
            stack.append(len(elements) - 1)
            still[name] += 1
        elif name not in INLINE:
            texts.append((element.parent, " "))
    if at < len(page):
        add(re.sub(r"<[/!a-zA-Z][^<]*$", "", page[at:]))
    return Page(elements, texts)


def p_around(elements: list[Element], stack: list[int]) -> bool:
    """Whether only inline elements stand between here and an open paragraph."""
    for i in reversed(stack):
        if elements[i].name == "p":
            return True
        if elements[i].name not in INLINE or elements[i].name in EMPTY:
            return False
    return False


def key(host: int, inside: bool, digest: int) -> tuple[int, bool, int]:
    return host, inside, digest


def main_text(page: str | None, templates: frozenset = frozenset(), host: int = 0) -> str:
    """The page's main text, given the keys of template subtrees."""
    return parse(page).text(templates, host) if page else ""


def host_of(url: str | None) -> str:
    rest = re.sub(r"^[a-z][a-z0-9+.-]*:", "", url or "", flags=re.I).lstrip("/")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].rpartition("@")[2].partition(":")[0].lower()


def host_key(url: str | None) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(host_of(url)) - 2**63


def count_subtrees(pages: DataFrame, url: str, html: str, most: int = 200_000) -> DataFrame:
    """(host, inside, digest, n): how many of the host's pages, or inside articles how many
    different ones, hold a subtree; the number of all under a NULL digest."""
    out = fields(host="long", digest="long", article="long", n="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            hosts, digests, articles = zip(*counts) if counts else ((), (), ())
            columns = [pa.array(x, pa.int64()) for x in (hosts, digests, articles, list(counts.values()))]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, names=out.names)

        for batch in slices(batches, 1 << 22):
            for address, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                host = host_key(address)
                seen = {(digest, article) for _, article, digest in parse(page or "").subtrees()}
                seen |= {(None, article) for _, article in seen} | {(None, None)}
                counts.update((host, digest, article) for digest, article in seen)
                if len(counts) > most:
                    yield flush()
        yield flush()

    found = pages.select(url, html).mapInArrow(run, out).groupBy("host", "digest", "article").agg(F.sum("n").alias("n"))
    inside = F.col("article").isNotNull().alias("inside")
    return found.groupBy("host", inside, "digest").agg(F.sum(F.when(F.col("article").isNull(), F.col("n")).otherwise(1)).alias("n"))


def templates_of(
    pages: DataFrame, least_pages: int, least_share: float, least_share_inside: float, url: str, html: str
) -> DataFrame:
    """(host, inside, digest): subtrees that recur across many of the host's pages or articles."""
    counted = scratch(count_subtrees(pages, url, html).filter(F.col("digest").isNull() | (F.col("n") >= least_pages)), "subtrees")
    total = counted.filter(F.col("digest").isNull()).select("host", "inside", F.col("n").alias("total"))
    share = F.when(F.col("inside"), F.lit(least_share_inside)).otherwise(F.lit(least_share))
    often = counted.filter(F.col("digest").isNotNull()).join(total, ["host", "inside"]).filter(F.col("n") >= share * F.col("total"))
    return often.select("host", "inside", "digest")


def with_templates(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """``rows`` with the template subtrees that each holds, in ``digests``: those inside of articles, and outside.

    Rows are told apart by two hashes of url and html; rows alike hold the same.
    """
    out = fields(a="long", b="long", host="long", inside="boolean", digest="long")
    a, b = F.xxhash64("url", "html").alias("a"), F.xxhash64("html", F.lit(1), "url").alias("b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 22):
            found = []
            for x, y, address, page in zip(*(c.to_pylist() for c in batch.columns)):
                host = host_key(address)
                found += {(x, y, host, article is not None, digest) for _, article, digest in parse(page or "").subtrees()}
            columns = list(zip(*found)) if found else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=out.names)

    held = rows.select(a, b, "url", "html").mapInArrow(run, out).join(templates, ["host", "inside", "digest"], "left_semi")
    kept = lambda inside: F.collect_set(F.when(F.col("inside") == inside, F.col("digest")))
    held = scratch(held.groupBy("a", "b").agg(kept(True).alias("within"), kept(False).alias("outside")), "templates-held")
    return rows.select("*", a, b).join(held, ["a", "b"], "left").select("page_id", "url", "html", "within", "outside")


def extract(
    pages: DataFrame,
    least_pages: int = 5,
    least_share: float = 0.05,
    least_share_inside: float = 0.5,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """A row per row of ``pages``: page_id, url, text, n_chars."""
    templates = scratch(templates_of(pages, least_pages, least_share, least_share_inside, url, html), "templates")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    out = fields(page_id="long", url="string", text="string", n_chars="long")
    shared = None
    if templates.count() <= BROADCAST:
        shared = pages.sparkSession.sparkContext.broadcast(frozenset(map(tuple, templates.collect())))
        source = rows
    else:
        source = with_templates(rows, templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 22):
            texts = []
            for i, (address, page) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                host = host_key(address)
                if shared is not None:
                    known = shared.value
                else:
                    known = frozenset(key(host, w, d) for w, c in ((True, 3), (False, 4)) for d in batch.column(c)[i].as_py() or ())
                texts.append(main_text(page, known, host))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=out.names
            )

    return source.mapInArrow(run, out)


@query()
def op4_site_templates(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
