"""Posts and the next link of fetched HTML search pages, from one pass over a page's tags.

Spark has no HTML reader, so pages are read in Arrow batches by a small field
machine: tags open and close, and only the elements that carry a field are
remembered while they are open. No tree is built. Native expressions turn the
texts it finds into typed columns.

A stray end tag is ignored, and what is still open inside an element closes
with it. Of several elements of one kind in a post block the first counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from agora.functions.posts import count_from_text, time_from_title

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
FIELDS = ("link", "title", "fullname", "username", "text_content", "likes", "comments", "retweets", "quotes")
POST = pa.struct([(f, pa.string()) for f in FIELDS])
PARSED = T.StructType([
    T.StructField("posts", T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in FIELDS]))),
    T.StructField("next_link", T.StringType()),
])

# --- fixed values: class names of the page layout ----------------------------
ITEM, LINK, DATE = "timeline-item", "tweet-link", "tweet-date"
NAME, USER, BODY, STAT = "fullname", "username", "tweet-content", "tweet-stat"
ICONS = {"likes": "icon-heart", "comments": "icon-comment", "retweets": "icon-retweet", "quotes": "icon-quote"}
MORE = "show-more"

# One group, the whole token, so that splitting by it gives texts and tokens in turn. Scripts and styles are one token each.
_TOKEN = re.compile(
    r"(<(?:!--.*?-->|[sS][cC][rR][iI][pP][tT]\b.*?</[sS][cC][rR][iI][pP][tT]\s*>|[sS][tT][yY][lL][eE]\b.*?</[sS][tT][yY][lL][eE]\s*>"
    r"|[!?][^>]*>|/?[a-zA-Z][^\s/>]*(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>))",
    re.DOTALL,
)
_NAME = re.compile(r"[^\s/>]+")
_RAW = re.compile(r"<(?:script|style)\b.*</", re.IGNORECASE | re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

class _Tag:
    """What a token says: the tag it closes or opens, whether that stays open, and of links, blocks and spans the classes that matter."""

    __slots__ = ("closes", "tag", "stays", "matters", "values", "item", "more", "body", "link", "names", "date", "stat", "icons")

    def __init__(self, token: str):
        self.closes, self.stays, self.matters = None, False, False
        if token[1] in "!?" or _RAW.match(token):
            return
        if token[1] == "/":
            self.closes = _NAME.match(token, 2)[0].lower()
            return
        found = _NAME.match(token, 1)
        self.tag, attrs = found[0].lower(), token[found.end() : -1]
        self.stays = self.tag not in _VOID and not attrs.endswith("/")
        if self.tag in ("a", "div", "span"):
            self.values = {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attrs)} if attrs else {}
            classes = self.values.get("class", "")
            is_link, is_block, is_span = (self.tag == t for t in ("a", "div", "span"))
            self.item, self.more, self.body = (is_block and c in classes for c in (ITEM, MORE, BODY))
            self.link = is_link and LINK in classes
            self.names = [f for f, c in (("fullname", NAME), ("username", USER)) if is_link and c in classes]
            self.date, self.stat = (is_span and c in classes for c in (DATE, STAT))
            self.icons = [f for f, c in ICONS.items() if is_span and c in classes]
            self.matters = is_link or self.item or self.more or self.body or self.date or self.stat or bool(self.icons)


# Tokens recur from page to page; long ones, with addresses or times, hardly do and are not kept.
_TAGS: dict[str, _Tag] = {}
_KEPT, _LONGEST = 20_000, 40


def _tag(token: str) -> _Tag:
    tag = _Tag(token)
    if len(token) <= _LONGEST:
        if len(_TAGS) >= _KEPT:
            _TAGS.clear()
        _TAGS[token] = tag
    return tag


class _Item:
    """What has been seen of one post block."""

    __slots__ = ("link", "texts", "dates", "stats")

    def __init__(self):
        self.link: tuple[str | None] | None = None
        self.texts: dict[str, list[str]] = {}
        # In the order in which they opened: [title of the first link] of dates, (icons, text) of counts.
        self.dates: list[list[str | None]] = []
        self.stats: list[tuple[set[str], list[str]]] = []

    def record(self) -> tuple[str | None, ...]:
        texts = dict(self.texts)
        for icons, text in self.stats:
            for field in icons:
                texts.setdefault(field, text)
        title = next((d[0] for d in self.dates if d), None)
        found = ("".join(texts[f]).strip() if f in texts else None for f in FIELDS[2:])
        return (self.link[0] if self.link else None, title, *found)


class _Page:
    """The field machine. ``marks`` has, for each open element, what ends with it; most elements have None."""

    def __init__(self):
        self.tags: list[str] = []
        self.marks: list[tuple | None] = []
        self.texts: list[list[str]] = []  # texts being gathered
        self.open: list[_Item] = []
        self.stats: list[set[str]] = []  # icons of the open counts
        self.items: list[_Item] = []
        self.more: list[list[str | None]] = []

    def read(self, page: str) -> tuple[list[tuple], str | None]:
        tags, marks, texts, known = self.tags, self.marks, self.texts, _TAGS.get
        parts = _TOKEN.split(page)
        for text, token in zip(parts[0::2], parts[1::2]):
            if texts and text:
                self._add(text)
            tag = known(token) or _tag(token)
            closes = tag.closes
            if closes is not None:
                if tags and tags[-1] == closes:
                    tags.pop()
                    mark = marks.pop()
                    if mark is not None:
                        self._end(mark)
                elif closes in tags:
                    self._close(closes)
            elif not tag.matters:
                if tag.stays:
                    tags.append(tag.tag)
                    marks.append(None)
            else:
                mark = self._mark(tag)
                if tag.stays:
                    tags.append(tag.tag)
                    marks.append(mark)
                elif mark:
                    self._end(mark)
        if texts:
            self._add(parts[-1])
        links = [href for slot in self.more for href in slot]
        return [i.record() for i in self.items], links[min(1, len(links) - 1)] if links else None

    def _add(self, text: str) -> None:
        text = unescape(text) if "&" in text else text
        for gathered in self.texts:
            gathered.append(text)

    def _close(self, tag: str) -> None:
        """Close the innermost element of a kind, and with it all that is open inside."""
        depth = len(self.tags) - 1
        while self.tags[depth] != tag:
            depth -= 1
        outermost = next((m for m in self.marks[depth:] if m is not None), None)
        if outermost is not None:
            self._end(outermost)  # it undoes those inside it
        del self.tags[depth:], self.marks[depth:]

    def _end(self, mark: tuple) -> None:
        texts, items, stats, _, _ = mark
        del self.texts[texts:], self.open[items:], self.stats[stats:]

    def _mark(self, tag: _Tag) -> tuple | None:
        """Note what an opening element brings; returns how far to undo at its end, and its date or link slot."""
        mark = (len(self.texts), len(self.open), len(self.stats))
        date = more = None
        if tag.tag == "a":
            parent = self.marks[-1] if self.marks else None
            if parent is not None:
                if parent[3] is not None and not parent[3]:
                    parent[3].append(tag.values.get("title"))
                if parent[4] is not None:
                    parent[4].append(tag.values.get("href"))
            if not self.open or not (tag.link or tag.names):
                return None
            if tag.link:
                for item in self.open:
                    if item.link is None:
                        item.link = (tag.values.get("href"),)
            for field in tag.names:
                self._gather(field)
        elif tag.tag == "div":
            if tag.body and self.open:
                self._gather("text_content")
            if tag.more:
                more = []
                self.more.append(more)
            if tag.item:
                self.open.append(_Item())
                self.items.append(self.open[-1])
        elif not self.open:
            return None
        else:
            for seen in self.stats:
                seen.update(tag.icons)
            if tag.date:
                date = []
                for item in self.open:
                    item.dates.append(date)
            if tag.stat:
                seen, text = set(), []
                self.stats.append(seen)
                self.texts.append(text)
                for item in self.open:
                    item.stats.append((seen, text))
        return (*mark, date, more)

    def _gather(self, field: str) -> None:
        """Gather the text of the element just opened, for the open items that have no such field yet."""
        text: list[str] = []
        wanted = [item for item in self.open if field not in item.texts]
        for item in wanted:
            item.texts[field] = text
        if wanted:
            self.texts.append(text)


def read_page(page: str) -> tuple[list[tuple], str | None]:
    """The posts of a page, as tuples of ``FIELDS``, and the link to the next one."""
    return _Page().read(page)


@F.arrow_udf(PARSED)
def _parse(pages: pa.Array) -> pa.Array:
    rows, ends, links = [], [0], []
    for page in pages:
        posts, link = read_page(page.as_py() or "")
        rows += posts
        ends.append(len(rows))
        links.append(link)
    columns = list(zip(*rows)) or [()] * len(FIELDS)
    flat = pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], fields=list(POST))
    posts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
    return pa.StructArray.from_arrays([posts, pa.array(links, pa.string())], names=["posts", "next_link"])


def parse_pages(df: DataFrame, html_col: str, out_col: str = "parsed") -> DataFrame:
    """Add a struct of ``posts`` (raw texts) and ``next_link``; each page is read once for both. A null page has neither."""
    return df.withColumn(out_col, _parse(F.col(html_col)))


def typed_posts(df: DataFrame, posts_col: str) -> DataFrame:
    """One row per post of the arrays in ``posts_col``; blocks without an id or a readable date are dropped."""
    # Not ``inline``: the filter Spark derives from it would read every page a second time.
    raw = df.select(F.inline_outer(posts_col))
    id_ = F.substring_index(F.substring_index("link", "/", -1), "#", 1)
    posts = raw.select(
        F.nullif(F.trim(id_), F.lit("")).alias("id"),
        "fullname",
        "username",
        "text_content",
        time_from_title(F.col("title")).alias("posted_at"),
        count_from_text(F.col("likes")).alias("like_count"),
        count_from_text(F.col("comments")).alias("comment_count"),
        count_from_text(F.col("retweets")).alias("retweet_count"),
        count_from_text(F.col("quotes")).alias("quote_count"),
    )
    return posts.where(F.col("id").isNotNull() & F.col("posted_at").isNotNull())


def extract_html_records(df: DataFrame, html_col: str) -> DataFrame:
    """The posts of all pages, typed."""
    return typed_posts(parse_pages(df, html_col, "_parsed"), "_parsed.posts")


def next_page_link(df: DataFrame, html_col: str, out_col: str = "next_link") -> DataFrame:
    """Link to the next result page: the second "more" link, or the only one."""
    return parse_pages(df, html_col, "_parsed").withColumn(out_col, F.col("_parsed.next_link")).drop("_parsed")


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class SearchPages(DataSource):
    """``spark.read.format("search_pages").load(folder)``: path, posts and next_link of every ``.html`` file below a folder.

    Folders are opened by pyarrow's file systems (local, s3, gs, hdfs). Where
    only Spark reaches a store, ``read_search_pages`` gives the same rows.
    """

    @classmethod
    def name(cls) -> str:
        return "search_pages"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("path", T.StringType()), *PARSED.fields])

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.most = int(options.get("bytesPerPartition", 32 << 20))

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path.removeprefix("file:"))

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, path = self._system()
        out, size = [[]], 0
        for found in sorted(system.get_file_info(fs.FileSelector(path, recursive=True)), key=lambda f: f.path):
            if found.is_file and found.path.endswith((".html", ".htm")):
                if out[-1] and size + found.size > self.most:
                    out, size = [*out, []], 0
                out[-1].append(found.path)
                size += found.size
        return [_Files(paths) for paths in out]

    def read(self, partition: _Files) -> Iterator[tuple]:
        system, _ = self._system()
        for path in partition.paths:
            with system.open_input_stream(path) as file:
                posts, link = read_page(file.read().decode("utf-8", "replace"))
            yield path, posts, link


def read_search_pages(spark: SparkSession, path: str) -> DataFrame:
    """path, posts and next_link of every page file, through Spark's own reader."""
    pages = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    parsed = pages.select(F.col("_metadata.file_path").alias("path"), _parse("value").alias("_parsed"))
    return parsed.select("path", "_parsed.posts", "_parsed.next_link")
