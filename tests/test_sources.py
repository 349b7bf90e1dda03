import json
import random
import re
from collections.abc import Iterator
from html import unescape
from xml.etree.ElementTree import Element, SubElement

from pyspark.sql import functions as F

from agora.session import work_dir
from agora.sources import html_posts as H
from agora.sources.html_posts import extract_html_records, next_page_link
from agora.sources.json_posts import extract_json_records

ITEM = """<div class="timeline-item">
 <a class="tweet-link" href="/{user}/status/{id}#m"></a>
 <a class="fullname" title="x">Nama &amp; Kawan</a><a class="username">@{user}</a>
 <span class="tweet-date"><a href="#" title="{at}">5h</a></span>
 <div class="tweet-content media-body" dir="auto">Harga <b>naik</b> 5 &lt; 6<br>lagi</div>
 <span class="tweet-stat"><div class="icon-container"><span class="icon-comment"></span> 1,204</div></span>
 <span class="tweet-stat"><div><span class="icon-heart" title=""></span> 7</div></span>
</div>"""
DATE = "Jan 5, 2024 · 3:04 PM UTC"


def page(spark, *bodies):
    return spark.createDataFrame([(b,) for b in bodies], "html string")


def test_html_records(spark):
    body = "".join(
        [
            "<!DOCTYPE html><html><head><script>var a='<div class=\"timeline-item\">'</script><!-- <div> --></head><body><p>x<p>y",
            ITEM.format(user="ana", id="11", at=DATE),
            ITEM.format(user="bo", id="", at=DATE),
            ITEM.format(user="ci", id="12", at="yesterday"),
            ITEM.format(user="di", id="13", at=DATE).replace('class="fullname"', 'class="x"'),
            "</body></html>",
        ]
    )
    rows = {r.id: r for r in extract_html_records(page(spark, body, None, ""), "html").collect()}
    assert set(rows) == {"11", "13"}
    first = rows["11"]
    assert first.fullname == "Nama & Kawan" and first.username == "@ana"
    assert first.text_content == "Harga naik 5 < 6lagi"
    assert (first.like_count, first.comment_count, first.retweet_count, first.quote_count) == (7, 1204, 0, 0)
    assert rows["13"].fullname is None


def test_next_link(spark):
    one = '<div class="show-more"><a href="?c=1">more</a></div>'
    two = '<div class="timeline-item show-more"><a href="?top">new</a></div>' + one
    got = next_page_link(page(spark, one, two, "<p>none</p>", None), "html").collect()
    assert [r.next_link for r in got] == ["?c=1", "?c=1", None, None]


def test_json_records(spark):
    posts = [
        {"id": "a", "author": "ana", "selftext": "", "body": "isi", "subreddit": "economy", "created_utc": 1700000000, "score": 3, "ups": 4, "downs": 1, "permalink": "/r/economy/a"},
        {"id": "b", "selftext": "judul", "body": "isi", "subreddit": "", "created_utc": "1700000001"},
        {"id": "", "created_utc": 1700000000},
        {"id": "c"},
        {"id": "d", "created_utc": 0},
    ]
    df = spark.createDataFrame([(json.dumps({"data": posts}),), (json.dumps({"data": []}),), ("broken",)], "body string")
    rows = {r.id: r for r in extract_json_records(df, "body").withColumn("at", F.unix_seconds("posted_at")).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].text_content == "isi" and rows["a"].permalink == "https://www.reddit.com/r/economy/a"
    assert rows["a"].at == 1700000000 and rows["b"].at == 1700000001
    b = rows["b"]
    assert (b.username, b.text_content, b.subreddit, b.score, b.upvote_count, b.permalink) == ("", "judul", None, 0, 0, None)


# A reader that builds the whole element tree, to compare the field machine with.

# Groups: raw-text element, closing slash, tag name, attributes, text.
TOKEN = re.compile(
    r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[!?][^>]*>"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|([^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


def tree_of(page: str) -> Element:
    """The element tree of a page. Stray end tags are ignored, and what is still
    open inside an element closes with it."""
    root = Element("page")
    stack = [root]
    for _, closing, tag, attrs, text in TOKEN.findall(page):
        parent = stack[-1]
        if text:
            text = unescape(text) if "&" in text else text
            if len(parent):
                parent[-1].tail = (parent[-1].tail or "") + text
            else:
                parent.text = (parent.text or "") + text
        elif closing:
            tag = tag.lower()
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), None)
            if depth:
                del stack[depth:]
        elif tag:
            tag = tag.lower()
            values = {k.lower(): unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(attrs)} if attrs else {}
            node = SubElement(parent, tag, values)
            if tag not in H._VOID and not attrs.endswith("/"):
                stack.append(node)
    return root


def with_class(node: Element, tag: str, name: str) -> Iterator[Element]:
    return (n for n in node.iter(tag) if n is not node and name in n.get("class", ""))


def text_of(node: Element | None) -> str | None:
    return None if node is None else "".join(node.itertext()).strip()


def read_item(item: Element) -> dict[str, str | None]:
    """The first element of each kind below one post block, as text."""
    found: dict[str, Element] = {}
    for node in item.iter():
        classes = node.get("class")
        if not classes or node is item:
            continue
        if node.tag == "a":
            for field, name in (("link", H.LINK), ("fullname", H.NAME), ("username", H.USER)):
                if name in classes:
                    found.setdefault(field, node)
        elif node.tag == "div":
            if H.BODY in classes:
                found.setdefault("text_content", node)
        elif node.tag == "span":
            if H.DATE in classes and (dated := node.find("a")) is not None:
                found.setdefault("title", dated)
            if H.STAT in classes:
                for field, icon in H.ICONS.items():
                    if any(icon in inner.get("class", "") for inner in node.iter("span") if inner is not node):
                        found.setdefault(field, node)
    record = {field: text_of(node) for field, node in found.items()}
    for field, attribute in (("link", "href"), ("title", "title")):
        record[field] = found[field].get(attribute) if field in found else None
    return record



CLASSES = ["timeline-item", "tweet-link", "tweet-date", "fullname", "username", "tweet-content", "tweet-stat", "icon-heart",
           "icon-comment", "show-more", "x", "timeline&#45;item"]


def broken_page(draw):
    out = []
    for _ in range(draw.randrange(60)):
        kind, tag = draw.random(), draw.choice(["a", "div", "span", "b", "br", "P"])
        if kind < 0.45:
            attrs = f' class="{" ".join(draw.choices(CLASSES, k=2))}"' if draw.random() < 0.8 else ""
            attrs += f" href='/u/{draw.randrange(99)}'" if draw.random() < 0.5 else ""
            attrs += f" title=T{draw.randrange(99)}" if draw.random() < 0.5 else ""
            out.append(f"<{tag}{attrs}{'/' if draw.random() < 0.05 else ''}>")
        else:
            out.append(f"</{tag}>" if kind < 0.8 else draw.choice(["x", "a &amp; b", " < ", "<!-- c -->", "<script>'<div>'</script>", "&am", "p;"]))
    return "".join(out)


def test_field_machine_reads_what_a_tree_shows():
    draw, some = random.Random(1), 0
    for _ in range(8000):
        page_text = broken_page(draw)
        tree = tree_of(page_text)
        items = [read_item(i) for i in with_class(tree, "div", H.ITEM)]
        links = [a for more in with_class(tree, "div", H.MORE) for a in more.findall("a")]
        expected = links[min(1, len(links) - 1)].get("href") if links else None
        assert H.read_page(page_text) == ([tuple(i.get(f) for f in H.FIELDS) for i in items], expected)
        some += bool(items and links)
    assert some > 100


def test_pages_are_read_once_for_posts_and_link(spark):
    body = ITEM.format(user="ana", id="11", at=DATE) + '<div class="show-more"><a href="?c=1">more</a></div>'
    parsed = H.parse_pages(page(spark, body, None, ""), "html")
    rows = parsed.select(F.size("parsed.posts").alias("n"), "parsed.next_link").collect()
    assert [tuple(r) for r in rows] == [(1, "?c=1"), (0, None), (0, None)]
    both = H.typed_posts(parsed.withColumn("posts", F.col("parsed.posts")), "posts")
    assert both._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [r.id for r in both.collect()] == ["11"]


def test_page_files_by_the_data_source_and_by_sparks_reader(spark):
    folder = work_dir(spark, "pages")
    from pathlib import Path

    where = Path(folder.removeprefix("file:"))
    (where / "deep").mkdir(parents=True)
    for k in range(5):
        body = ITEM.format(user="ana", id=str(k), at=DATE) + f'<div class="show-more"><a href="?c={k}">more</a></div>'
        (where / ("deep" if k % 2 else ".") / f"{k}.html").write_text(body)
    spark.dataSource.register(H.SearchPages)
    for df in (spark.read.format("search_pages").option("bytesPerPartition", 2000).load(folder), H.read_search_pages(spark, folder)):
        assert sorted(r.next_link for r in df.collect()) == [f"?c={k}" for k in range(5)]
        posts = H.typed_posts(df, "posts")
        assert sorted((r.id, r.like_count) for r in posts.collect()) == [(str(k), 7) for k in range(5)]
    assert spark.read.format("search_pages").option("bytesPerPartition", 2000).load(folder).rdd.getNumPartitions() > 1
