"""Main text of web pages by site template removal.

Every page is parsed once, in its task: into text blocks, the digests of the
container subtrees each block lies in (tag, class, id and text of everything
below), and marks for what the page's own markup says about a block. The
parsed pages are stored; Spark counts each digest per host over pages that
differ, and blocks inside subtrees found on ``MANY_SHARE`` of these, but at
least ``MANY_PAGES``, go, inside articles and main elements too. What markup names as menu, footer,
advert and so on goes as well, since a rare one need not recur; most such
classes inside articles, and classes that hold a word only in part, count where
the host repeats them as it repeats templates. Of what is
left, a page's text is its articles; where these have nothing left, its main
elements, then everything but comments, then articles that are comments.
Articles inside menus, asides and so on are not the page's.

Single paragraphs and headings are never removed because they recur: passages
that many pages quote are content. Inside an article or main element the same
holds for block quotes, preformatted text and a container without class and id
around one block, which is a paragraph by another tag. Pages of a host that are
equal but for what the markup rules out (menus, adverts) count as one page.

Null and empty pages give an empty text; a page without a host in its url
shares templates with other such pages. Broken markup is read as it comes: open
elements end with the page, stray end tags are ignored.
"""

from __future__ import annotations

import html
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.shared import FEW_IDS, few, stored

MANY_PAGES = 3
MANY_SHARE = 0.1

_MARKUP = regex.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", regex.DOTALL
)
_ATTRIBUTE = regex.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_PIECES = regex.compile(r"[a-z]+")
# Elements by what HTML makes of them.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img br".split()
)
UNSEEN = frozenset("script style noscript".split())  # no part of the text, and no end of a block
TEXT_LEVEL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption caption address summary hr".split())
WHOLE = frozenset("html body article main".split())
QUOTED = frozenset("blockquote pre".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
# What is not part of an article, by element, role and words of class or id.
OUTSIDE = frozenset("nav footer aside form script style noscript iframe svg canvas button select textarea template object head title dialog menu".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup comment "
    "comments commentlist disqus respond replies footer masthead related share sharing social".split()
)
# Beside such a word, these pieces of a class or id say nothing of their own.
NEUTRAL_WORDS = frozenset(
    "site page main top bottom left right header bar box button buttons link links item items container wrapper wrap inner outer "
    "section area block panel slot unit widget post posts count counter icon icons primary secondary global".split()
)
# Inside an article: these words rule text out at once, those of the second set never do, and the others where the host repeats the name.
NEVER_ARTICLE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored breadcrumb breadcrumbs cookie cookies consent gdpr "
    "newsletter subscribe signup comment comments commentlist disqus respond replies".split()
)
OFTEN_ARTICLE = frozenset("menu notice notices alert".split())
# Ids of these are made from titles: inside an article they say what the text is about.
TITLED = frozenset("section h1 h2 h3 h4 h5 h6".split())
# Articles of these classes are the page's only where it has nothing else.
COMMENTS = frozenset("comment comments reply replies".split())
ZONES = ("article", "main", "", "comment")


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@lru_cache(1 << 16)
def _words(token: str) -> tuple[frozenset[str], bool]:
    """The outside words that a class or id consists of, alone or joined by hyphens with neutral words; whether it has others in part."""
    pieces = _PIECES.findall(token)
    if "".join(pieces) in OUTSIDE_WORDS:
        return frozenset(["".join(pieces)]), False
    found = OUTSIDE_WORDS.intersection(pieces)
    if found and NEUTRAL_WORDS.issuperset(found.symmetric_difference(pieces)):
        return found, False
    return frozenset(), not found <= OFTEN_ARTICLE


class Element:
    __slots__ = ("tag", "key", "outside", "zone", "container", "below", "digest", "blocks", "named")

    def __init__(self, tag: str, attributes: str, above: "Element | None"):
        found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
        names = f"{found.get('class', '')} {found.get('id', '')}".strip()
        self.tag, self.key = tag, f"{tag} {names}"
        self.zone = above.zone if above else ""
        out = tag in OUTSIDE or found.get("role") in OUTSIDE_ROLES or tag == "header" and not self.zone or "hidden" in found
        self.named = 0  # digest of a name that rules the element out where the host repeats it
        # Words of whole-page elements and articles say what kind of page it is.
        if names and tag not in WHOLE:
            classes, titled = found.get("class", "").split(), tag in TITLED
            words = frozenset().union(*[_words(t)[0] for t in (classes if self.zone and titled else names.split())])
            if not self.zone or not words.isdisjoint(NEVER_ARTICLE):
                out = out or bool(words)
            repeated = sorted((words - OFTEN_ARTICLE).union([] if titled else [t for t in classes if _words(t)[1]]))
            if repeated:
                self.named = _digest(f"\x1d{tag} {' '.join(repeated)}")
        self.outside = bool(above and above.outside or out)
        if tag == "article" and not COMMENTS.isdisjoint(found.get("class", "").split()):
            self.zone = "comment"
        elif not self.outside and (tag == "article" and self.zone != "comment" or tag == "main" and not self.zone):
            self.zone = tag
        self.container = tag not in WHOLE and tag not in INLINE and tag not in TEXT_LEVEL
        self.below, self.digest = [], 0
        self.blocks = 0  # below it, without quoted ones

    def counted(self) -> bool:
        """Whether this subtree goes where it recurs on the host."""
        if not self.container or not self.digest:
            return False
        return not self.zone or self.blocks > 1 or self.blocks == 1 and self.key != f"{self.tag} "


def parse(page: str) -> tuple[list[tuple[str, bool, str, list[int]]], int]:
    """Blocks (text, outside, zone, digests of containers), the digest of the page's own content."""
    root = Element("", "", None)
    stack, blocks, parts = [root], [], []

    def end_block() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            blocks.append((text, stack[-1], list(stack)))
            stack[-1].below.append(text)
            if QUOTED.isdisjoint(e.tag for e in stack):
                for e in stack:
                    e.blocks += 1

    def close() -> None:
        if stack[-1].tag not in INLINE:
            end_block()
        element = stack.pop()
        if element.tag in INLINE:
            stack[-1].below += element.below
        elif element.below:
            element.digest = _digest("\x1f".join([element.key, *element.below]))
            stack[-1].below.append(f"\x1e{element.digest}")

    def close_to(tags, stop=()) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                while len(stack) > k:
                    close()
                return
            if stack[k].tag in stop:
                return

    at = 0
    while at < len(page):
        found = _MARKUP.search(page, at)
        piece = page[at : found.start() if found else len(page)]
        if piece:
            parts.append(html.unescape(piece))
        if not found:
            break
        at, tag = found.end(), (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if any(e.tag == tag for e in stack[1:]):
                close_to((tag,))
            elif tag not in INLINE and tag not in UNSEEN:
                end_block()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE and tag not in UNSEEN:
            end_block()
            close_to(("p",), ("table", "td", "th", "li", "blockquote", "div", "section", "article", "main", "body"))
            if tag in CLOSES:
                close_to(CLOSES[tag], ("ul", "ol", "dl", "table", "select"))
        if tag in VOID:
            continue
        if tag in RAW:
            end = regex.compile(rf"</{tag}\b[^>]*>", regex.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append(Element(tag, found[3], stack[-1]))
    end_block()
    while len(stack) > 1:
        close()
    out = []
    for text, last, above in blocks:
        chain = [e.digest for e in above if e.counted()] + [e.named for e in above if e.named]
        out.append((text, last.outside, last.zone, chain))
    # The page's own content: the first zone that has some, without what may go by a repeated name.
    own = [(ZONES.index(last.zone), text) for text, last, above in blocks if not last.outside and not any(e.named for e in above)]
    first = min((zone for zone, _ in own), default=None)
    content = [text for zone, text in own if zone == first] or map(str, root.below)
    return out, _digest("\x1f".join(content))


PARSED = "row long, host long, page long, blocks array<struct<text string, rank int, outside boolean, digests array<long>>>"


def _parse_batches(carried: list[str]):
    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        kind = pa.list_(pa.struct([("text", pa.string()), ("rank", pa.int32()), ("outside", pa.bool_()), ("digests", pa.list_(pa.int64()))]))
        for batch in batches:
            rows, pages, kept = [], [], []
            for page in batch.column("_html"):
                blocks, content = parse(page.as_py() or "")
                kept.append([
                    {"text": text, "rank": ZONES.index(zone), "outside": outside, "digests": digests} for text, outside, zone, digests in blocks
                ])
                rows.append((task << 36) + number)
                number += 1
                pages.append(content)
            columns = [batch.column(c) for c in carried]
            columns += [pa.array(rows, pa.int64()), batch.column("_host"), pa.array(pages, pa.int64()), pa.array(kept, kind)]
            yield pa.record_batch(columns, names=[*carried, "row", "host", "page", "blocks"])

    return run


def templates(parsed: DataFrame, many: int = MANY_PAGES, share: float = MANY_SHARE) -> DataFrame:
    """(host, digest) of container subtrees on ``share`` of a host's differing pages, ``many`` at least."""
    hosts = parsed.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    seen = parsed.select("host", "page", F.explode(F.array_distinct(F.flatten("blocks.digests"))).alias("digest")).distinct()
    often = seen.groupBy("host", "digest").count().where(F.col("count") >= many)
    return often.join(few(hosts, "hosts"), "host").where(F.col("count") >= share * F.col("pages")).select("host", "digest")


def parse_pages(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per page: key and url, row, host, page (digest of its content) and all its blocks, stored."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.xxhash64(host).alias("_host"), F.col(page).alias("_html"))
    kinds = dict(rows.dtypes)
    schema = f"_key {kinds['_key']}, _url {kinds['_url']}, {PARSED}"
    return stored(rows.mapInArrow(_parse_batches(["_key", "_url"]), schema), "pages")


def recurring(parsed: DataFrame, found: DataFrame) -> DataFrame:
    """row and the places of the blocks that stand in a template of the page's host, stored."""
    blocks = parsed.select("row", "host", F.posexplode("blocks.digests").alias("place", "digests"))
    inside = blocks.select("row", "place", "host", F.explode("digests").alias("digest"))
    gone = inside.join(found, ["host", "digest"])
    # Stored: pages are shuffled to it only where it is too large to be sent to them.
    return stored(gone.groupBy("row").agg(F.collect_set("place").alias("gone")), "gone-blocks")


def _marked(parsed: DataFrame, many: int) -> DataFrame:
    """``parsed`` with ``gone``, the places of the blocks that stand in a template of the page's host (null or empty: none).

    Up to ``FEW_IDS`` templates in all are sent to the pages, one array a host, and no page is shuffled. More of
    them meet single blocks, and pages are joined with the places by ``row``.
    """
    found = stored(templates(parsed, many), "templates")
    if found.count() > FEW_IDS:
        return parsed.join(recurring(parsed, found), "row", "left")
    sets = found.groupBy("host").agg(F.collect_list("digest").alias("templates"))
    # The page's own templates are taken once, bound to a name; blocks are held against those few.
    mine = F.array(F.array_intersect(F.flatten("blocks.digests"), "templates"))
    gone = F.transform(mine, lambda m: F.filter(_places(), lambda i: F.arrays_overlap(F.col("blocks")[i]["digests"], m)))[0]
    return parsed.join(F.broadcast(sets), "host", "left").withColumn("gone", F.when(F.col("templates").isNotNull(), gone))


def _places() -> Column:
    return F.transform("blocks", lambda b, i: i)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", many: int = MANY_PAGES) -> DataFrame:
    """Per page: key, url, text (blocks in page order, one newline between), n_chars (code points)."""
    joined = _marked(parse_pages(pages, key, url, page), many)
    places = _places()
    # What recurs on the host goes first; then, of the rest, what the markup rules out.
    left = F.array_except(places, F.coalesce(F.col("gone"), F.slice(places, 1, 0)))
    joined = joined.select("_key", "_url", "blocks", F.filter(left, lambda i: ~F.col("blocks")[i]["outside"]).alias("left"))
    zones = []
    for rank in map(F.lit, range(len(ZONES))):
        mine = F.filter("left", lambda i: F.col("blocks")[i]["rank"] == rank)  # noqa: B023 (called at once)
        zones.append(F.nullif(F.array_join(F.transform(mine, lambda i: F.col("blocks")[i]["text"]), "\n"), F.lit("")))
    text = F.coalesce(*zones, F.lit(""))
    out = joined.select(F.col("_key").alias(key), F.col("_url").alias(url), text.alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def removed(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", many: int = MANY_PAGES) -> DataFrame:
    """One row: blocks, those that went by count, and those of the rest that went by markup."""
    parsed = parse_pages(pages, key, url, page)
    blocks = parsed.select("row", F.posexplode("blocks.outside").alias("place", "outside"))
    gone = recurring(parsed, stored(templates(parsed, many), "templates")).select("row", F.explode("gone").alias("place"), F.lit(True).alias("recurs"))
    met = blocks.join(gone, ["row", "place"], "left")
    return met.agg(
        F.count(F.lit(1)).alias("blocks"), F.count_if("recurs").alias("by_count"), F.count_if(F.col("recurs").isNull() & F.col("outside")).alias("by_markup")
    )
