"""The operators of the subpackage against brute force, the tokenizer libraries and held-out rows."""

import hashlib
import json
import random
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
import corpus_pipeline
from agora.llm import bpe, components, dac, html_text, language, near_dup, packing, quality, rules, token_counts, token_ids, topk
from agora.llm.queries import QUERIES, SQL
from agora.llm.shared import prepare, stored
from agora.llm.vocabularies import default_path

SF = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    return dict(rows)


@pytest.fixture(scope="module")
def result(spark):
    kept = {}

    def get(name):
        if name not in kept:
            kept[name] = QUERIES[name](spark, SF).toPandas()
        return kept[name]

    return get


def packed(ids):
    return np.asarray(ids, "<u4").tobytes()


def byte_library():
    import public_tokenizers
    import tiktoken

    ranks = bpe.rank_file(default_path(bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path(name))


# Odd tables: nulls in every column, empty and long texts, repeated rows, extra columns whose names operators use too.
LONG = "word " * 30_000 + "x" * 50_000
ODD = [
    (1, "one two three four five six seven", "en", "a", 1),
    (1, "one two three four five six seven", "en", "a", 1),
    (2, "ONE two three four five six seven", None, None, None),
    (3, "", "en", "a", 0),
    (4, None, "en", None, None),
    (None, "no id here at all", "en", "b", 5),
    (5, LONG, "fr", "b", 9),
    (6, LONG, None, "b", 9),
    (7, "...", "en", "b", 3),
    (8, " \n\t ", "en", "b", 3),
]
EXTRA = ["score", "text_", "component", "row", "host", "rank", "place", "length", "piece", "ids", "_html", "bucket", "label"]


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    df = spark.createDataFrame(ODD, DOCS)
    return df.select("*", *[F.lit("x").alias(c) for c in EXTRA])


def empty(spark, schema):
    return spark.createDataFrame([], schema)


# 1 quality

def test_quality_separates_held_out_rows(result):
    out = result("op1_quality_classifier")
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    assert len(out) == 1000 and out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.5)).all()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out.itertuples())
    test = out[out.held_out & out.doc_id.isin(labels)]
    assert (test.predicted == test.doc_id.map(labels)).mean() >= 0.97


def test_quality_scores_are_the_sparse_dot_products():
    text = "A b b, c! A b"
    hits, _ = quality.features(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    weights = np.zeros(1 << quality.BITS, np.float32)
    weights[hits[0]] = 2
    share = np.mean(hits == hits[0])
    margin = quality.SCALE * share * 2 - 1
    score = quality.Model(weights, -1.0).scores(pa.array(["", text, None]))
    assert np.allclose(score, 1 / (1 + np.exp(-np.array([-1, margin, -1]))))


def test_quality_takes_odd_tables(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in (1, 2, 3, 4, 5, 6, 7)] + [(None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(odd, quality.fit(odd, labels)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.text_ == "x" for r in rows)
    blank = quality.classify(odd, quality.fit(odd, labels.limit(0))).collect()
    assert {r.score for r in blank} == {0.5} and {r.predicted for r in blank} == {1}
    assert quality.classify(empty(spark, DOCS), quality.fit(empty(spark, DOCS), labels)).count() == 0


# 2 and 3 tokens

def test_ids_and_decoding_equal_the_library(result, documents):
    out, encode = result("op2_byte_bpe"), byte_library().encode_ordinary
    assert len(out) == len(documents)
    for r in out.itertuples():
        text = documents[r.doc_id] or ""
        ids = encode(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_counts_equal_the_library(result, documents):
    out, tokenizer = result("op3_token_counts"), library("byte_bpe_50k.json")
    for r in out.itertuples():
        text = documents[r.doc_id] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(text.encode()), n > 1024)


def test_every_piece_is_joined_from_single_bytes(documents):
    """Only tokens and single bytes come without a join; what is encoded again are whole neighbouring tokens."""
    ranks, library = bpe.rank_file(default_path(bpe.RANKS)), byte_library()
    pieces = {p for text in list(documents.values())[:40] for p in bpe.splitter().findall(text or "")}
    tree, joined, joins = bpe.TreeCoder(ranks), 0, []
    join = tree.join
    tree.join = lambda a, b: joins.append((a, b)) or join(a, b)
    for text in pieces | {"q" * 3000, "ab" * 999, "zxqjv" * 40}:
        piece = text.encode()
        tree.halves = dict(tree.letters)
        joins.clear()
        assert tree.encode(piece) == library.encode_ordinary(text)
        if piece in ranks:
            assert not joins
        else:
            joined += 1
            a, b = joins[-1]
            assert tree.decode(a) + tree.decode(b) == piece
    assert joined > 100


def test_counts_refuse_added_tokens_with_flags(tmp_path):
    content = json.loads(Path(default_path(token_counts.MERGES)).read_text())
    content["added_tokens"][0]["lstrip"] = True
    path = tmp_path / "flags.json"
    path.write_text(json.dumps(content))
    with pytest.raises(ValueError, match="added tokens"):
        token_counts.Counter(str(path))


ALPHABETS = ["ab", "a", "abcdefgh ", "a \n\t", "éèaß ", "tion the ing", "日本語あ ", "\x1c\x1f 　 ab", "'sdl re'", "՘࢏ a"]


@settings(max_examples=150, deadline=None)
@given(st.sampled_from(ALPHABETS).flatmap(lambda a: st.text(st.sampled_from(a), max_size=400)))
def test_tokens_of_any_text(text):
    tree, ids = bpe.coder(default_path(bpe.RANKS)), byte_library().encode_ordinary(text)
    assert tree.encode_text(text) == packed(ids) and tree.decode(ids) == text.encode()
    text += "<|endoftext|>" + text[:9]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        want = library(name).encode(text, add_special_tokens=False).ids
        assert token_ids.ids_of(default_path(name)).encode(text) == packed(want)
    want = library("byte_bpe_50k.json").encode(text, add_special_tokens=False).ids
    assert token_counts.counter(default_path(token_counts.MERGES)).count(text) == len(want)


@pytest.mark.parametrize("piece", ["a" * 5001, "ab" * 3000, "abc" * 999 + "!" * 700, "".join(random.Random(3).choices("abt", k=4000))])
def test_joins_of_long_pieces(piece):
    tree = bpe.coder(default_path(bpe.RANKS))
    whole = byte_library().encode_ordinary(piece)
    assert tree.encode_text(piece) == packed(whole)
    ids, cut = [], 0
    for cut in (1, 7, len(piece) // 3, len(piece) - 1):
        left, right = (tree.encode(p.encode()) for p in (piece[:cut], piece[cut:]))
        if piece.isalpha():
            assert tree.join(left, right) == whole
    assert not ids


def test_tokens_take_odd_tables(spark, odd):
    rows = odd.select("doc_id", bpe.encode(F.col("text")).alias("ids"), token_counts.count_tokens(F.col("text")).alias("n")).collect()
    assert [len(r.ids) // 4 for r in rows] == [r.n for r in rows] and [r.n for r in rows][3:5] == [0, 0]
    decoded = odd.select("text", bpe.decode(bpe.encode(F.col("text"))).alias("d")).collect()
    assert all(bytes(r.d).decode() == (r.text or "") for r in decoded)
    assert empty(spark, DOCS).select(bpe.encode(F.col("text")), token_counts.count_tokens(F.col("text"))).count() == 0


# 4 pages

def test_articles_are_whole_and_alone(result):
    import html

    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall())
    out = result("op4_main_text")
    assert len(out) == len(pages)
    for r in out.itertuples():
        article = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        article = re.sub(r"<[^>]*>", " ", re.sub(r"</?(p|h1)>", "\x00", article))
        blocks = [" ".join(html.unescape(b).split()) for b in article.split("\x00")]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


PAGES = "page_id long, url string, html string"


def page(spark, htmls, host="http://a.org/", many=3):
    rows = [(k, f"{host}{k}" if host else None, h) for k, h in enumerate(htmls)]
    out = html_text.extract(spark.createDataFrame(rows, PAGES).withColumn("row", F.lit("x")), many=many).collect()
    return [r.text for r in sorted(out, key=lambda r: r.page_id)]


def test_templates_go_and_quoted_passages_stay(spark):
    template = "<div class=x1><span>Our</span> house <p>style</p></div>"
    htmls = [f"{template}<div><h1>T{k}</h1><p>all quote this</p><p>own {k}</p></div>" for k in range(3)]
    assert page(spark, htmls) == [f"T{k}\nall quote this\nown {k}" for k in range(3)]
    assert page(spark, htmls[:2])[0].startswith("Our house\nstyle\nT0")  # too few pages
    assert page(spark, [htmls[0]] * 5) == ["Our house\nstyle\nT0\nall quote this\nown 0"] * 5  # copies are one page
    inside = [f"<article><div>same</div><p>{k}</p></article><div>other {k}</div>" for k in range(4)]
    assert page(spark, inside) == [f"same\n{k}" for k in range(4)]
    assert page(spark, htmls, host="") == [f"T{k}\nall quote this\nown {k}" for k in range(3)]


def test_markup_names_what_is_no_article(spark):
    htmls = [
        "<header>h</header><nav>n</nav><aside>s</aside><div id='cookie-notice'>c</div><form>f</form><p>a &amp; b&nbsp;c</p><footer>f</footer>",
        "<article><header><h1>T</h1></header>x<script>if (a < b) '</p>'</script><b>y</b><i> z </i><div class='comments'>r</div></article>out",
        "<p>a<p>b<li>c<li>d<table><tr><td>e<td>f</table>", "", None, "plain < text > &lt;x&gt;", "<div><p>open", "</p></div>stray<!-- no", "<p title='a>b'>q</p>",
        "<main><p>m</p><div role=navigation>n</div></main><div>side</div>", "<article>" + "long " * 50_000 + "</article>",
    ]
    out = page(spark, htmls)
    assert out[:2] == ["a & b c", "T\nxy z"] and out[2] == "a\nb\nc\nd\ne\nf" and out[3:5] == ["", ""]
    assert out[5] == "plain < text > <x>" and out[6:10] == ["open", "stray", "q", "m"] and len(out[10]) == 249_999
    assert html_text.extract(empty(spark, PAGES)).count() == 0
    twice = html_text.extract(spark.createDataFrame([(None, None, "<p>x")] * 2, PAGES)).collect()
    assert [r.text for r in twice] == ["x", "x"]


def test_templates_inside_articles_go(spark):
    box = "<div class=author><p>By Ann</p><p>Ann writes.</p></div>"
    quotes = "<p>quoted</p><figure><blockquote><p>q1</p><p>q2</p></blockquote></figure><div><p>also quoted</p></div>"
    for zone in ("article", "main"):
        htmls = [f"<{zone}><h1>T{k}</h1>{quotes}{box}<section>see<ul><li>too</ul></section><p>own {k}</p></{zone}>" for k in range(4)]
        assert page(spark, htmls) == [f"T{k}\nquoted\nq1\nq2\nalso quoted\nown {k}" for k in range(4)]
        assert page(spark, htmls[:2])[0] == "T0\nquoted\nq1\nq2\nalso quoted\nBy Ann\nAnn writes.\nsee\ntoo\nown 0"


def test_the_articles_of_asides_and_comments_are_not_the_pages(spark):
    comment = "<article class='comment depth-1'><p>c</p></article>"
    htmls = [
        "<main><div><p>Story</p></div></main><aside><article>teaser</article></aside>",
        f"<div><p>Story</p></div><section>{comment}</section>", f"<article><p>Story</p>{comment}</article>",
        f"<div><p>Story</p></div><div class=comments>{comment}</div><footer><article>f</article></footer>",
        "<main><p>Story</p></main><article><nav>n</nav></article>", "<p>Story</p><main><form>f</form></main><article></article>",
        comment, "<aside><article>teaser</article></aside>",
    ]
    assert page(spark, htmls) == ["Story"] * 6 + ["c", ""]
    box = "<div class=box><p>one</p><p>two</p></div>"  # an article with nothing but a template
    htmls = [f"<p>Story {k}</p><article>{box}{f'<p>own {k}</p>' * (k > 0)}</article>" for k in range(4)]
    assert page(spark, htmls) == ["Story 0", "own 1", "own 2", "own 3"]


def test_few_copies_of_a_story_are_no_template(spark):
    story = "<div class=story><h1>T</h1><p>one</p><p>two</p></div>"
    named = [f"<nav>menu {k}</nav>{story}<div class=ad>advert {k}</div>" for k in range(3)]
    for before, after in (("", ""), ("<article>", "</article>"), ("<main>", "</main>")):
        assert page(spark, [before + h + after for h in named]) == ["T\none\ntwo"] * 3
    # Three of 40 pages hold the story beside adverts without names; four pages of 40 have a template.
    box = "<div class=box><p>our</p><p>house</p></div>"
    htmls = [f"{story if k < 3 else ''}{box if k % 10 == 9 else ''}<p>own {k}</p>" for k in range(40)]
    assert page(spark, htmls) == ["T\none\ntwo\n" * (k < 3) + f"own {k}" for k in range(40)]


def test_words_in_names_are_whole_and_recur_inside_articles(spark):
    kept = "<section id='related-work'>a</section><section id=social-impact>b</section><h2 id=share-of-trade>c</h2><h2 id=comments>d</h2>"
    kept += "<div class='menu-list'>e</div><div class=menu>f</div><div class=share>g</div><header><h1>h</h1></header>"
    gone = "<div class='wide ad-slot'>x</div><div id=comments>y</div><section class=comment-list>z</section>"
    for zone in ("article", "main"):
        assert page(spark, [f"<{zone}>{kept}{gone}</{zone}>"]) == ["a\nb\nc\nd\ne\nf\ng\nh"]
    assert page(spark, ["<section id=related-work>a</section><div class=social-impact>b</div><header>x</header><div id=site-footer>y</div>"]) == ["a\nb"]
    htmls = [f"<article><p>own {k}</p><div class=related-posts>other {k}</div><div class=notice>take care {k}</div></article>" for k in range(3)]
    assert page(spark, htmls) == [f"own {k}\ntake care {k}" for k in range(3)]
    assert page(spark, htmls[:2])[0] == "own 0\nother 0\ntake care 0"


def test_templates_meet_pages_alike_in_both_ways(spark, monkeypatch):
    menu = "<div class=x><ul><li>Home<li>News<li>Shop</ul><div>Follow us</div></div>"
    rows = [(k, f"http://h{k % 2}.org/{k}", f"<body>{menu if k % 2 else ''}<div><p>Story {k}</p><p>More of {k}</p></div></body>") for k in range(12)]
    rows += [(None, None, None), (50, "http://h1.org/a", ""), (51, None, menu)]
    pages = spark.createDataFrame(rows, PAGES)
    sent = html_text.extract(pages)
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    sent = {tuple(r) for r in sent.collect()}
    assert all("Home" not in r[2] for r in sent if r[1] and r[1].startswith("http://h1")) and len(sent) == len(rows)
    monkeypatch.setattr(html_text, "FEW_IDS", 0)
    assert {tuple(r) for r in html_text.extract(pages).collect()} == sent


# 5 top-k

def brute_top(vectors, asked, k):
    width = max((len(v) for v in vectors.values()), default=0)
    ids = sorted(vectors)
    matrix = np.array([list(np.floor(64 * np.asarray(vectors[i], np.float64))) + [0] * (width - len(vectors[i])) for i in ids])
    out = []
    for q in asked:
        scores = matrix @ matrix[ids.index(q)]
        best = sorted((-int(s), i) for s, i in zip(scores, ids) if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_top_k_equals_brute_force(result):
    vectors = dict(duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall())
    out = result("op5_top_k")[["query_id", "rank", "vec_id", "score"]]
    got = sorted(tuple(map(int, r)) for r in out.itertuples(index=False))
    assert got == brute_top(vectors, [i for i in sorted(vectors) if i % 20 == 0], 20)


def test_top_k_with_pruning_ties_and_odd_vectors(spark):
    r = np.random.default_rng(5)
    centres = r.normal(size=(6, 12))
    good = {i: (centres[i % 6] + 0.05 * r.normal(size=12)) * (1 + 40 * (i % 17 == 0)) for i in range(600)}
    good |= {1000 + i: good[3] for i in range(60)} | {2000: np.zeros(12), 2001: np.ones(5)}
    rows = [(int(i), [float(x) for x in v], "x") for i, v in good.items()]
    odd = [(5000, None, "x"), (5001, [None, 1.0], "x"), (5002, [float("nan")], "x"), (5003, [float("inf")], "x"), (None, [1.0], "x"), rows[7]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, rank string")
    asked = [i for i in good if i % 3 == 0]
    for options in ({}, {"buckets": 3, "part": 40, "block": 50}):
        out = topk.top_k(df, df.where(F.col("vec_id") % 3 == 0), k=7, **options)
        assert sorted(tuple(r) for r in out.collect()) == brute_top(good, asked, 7)
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>, rank string")
    assert topk.top_k(few, few, k=7).count() == 6
    assert topk.top_k(few.limit(0), few.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [1e30]), (2, [1e30])], "vec_id long, embedding array<double>")
    assert {r.score for r in topk.top_k(huge, huge).collect()} == {2**63 - 1}


# 6 near-duplicates

def brute_sets(texts):
    sets = {}
    for i, text in texts.items():
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    return sets


def brute_components(sets):
    above = {i: i for i in sets}

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    holders = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    met = {(a, b) for h in holders.values() for k, a in enumerate(h) for b in h[:k]}
    for a, b in met:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = top(a), top(b)
            above[max(x, y)] = min(x, y)
    return {i: top(i) for i in sets}


def test_near_duplicates_equal_brute_force(result, documents):
    sets = brute_sets(documents)
    want, out = brute_components(sets), result("op6_near_duplicates")
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.itertuples()} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in documents
    }
    assert len(set(want.values())) < len(documents)


def test_no_link_between_members_of_a_large_bucket_is_lost(spark):
    """A shared passage puts texts that are not alike into one bucket; chains of alike texts lie inside it."""
    r = random.Random(11)
    word = lambda: "".join(r.choices("abcdefgh", k=5))
    passage, texts, base = [word() for _ in range(60)], {}, {}
    for i in range(240):
        if i % 6 == 0:
            base[i] = [word() for _ in range(40)]
        tail = base[i - i % 6][:]
        for k in range(i % 6):  # drifts away: neighbours are alike, ends are not
            tail[6 * k] = word()
        texts[1000 - i] = " ".join(passage + tail)
    df = prepare(spark).createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_components(brute_sets(texts))
    for block in (1024, 20):
        signed = near_dup.sign(df)
        links = near_dup.links(df.select(F.col("doc_id").alias("doc"), "text"), signed, block)
        found = {r.node: r.component for r in components.components(links).collect()}
        assert {i: found.get(i, i) for i in texts} == want
    assert len(set(want.values())) > 10


def test_near_duplicates_take_odd_tables(spark, odd):
    rows = near_dup.near_duplicates(odd).collect()
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_shingles, r.component_id, r.kept) for r in rows)
    assert [(k[1], n, c, kept) for k, n, c, kept in got] == [
        (1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 2, 5, True), (6, 2, 5, False),
        (7, 1, 7, True), (8, 0, 8, True), (0, 1, None, True),
    ]
    assert near_dup.near_duplicates(empty(spark, DOCS)).count() == 0


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 200)] + [(7, 7), (300, 299), (300, 299), (None, 3)]
    df = spark.createDataFrame(chain, "a long, b long")
    found = {r.node: r.component for r in components.components(df).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 200)} | {299: 299, 300: 299}
    assert components.components(df.limit(0)).count() == 0


# 7 packing

def check_packing(out, ids):
    pieces = {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == {i for i, v in ids.items() if v}
    for i, rows in pieces.items():
        rows.sort(key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(len(rows)))
        assert all(r.length == 1024 for r in rows[1:]) and 1 <= rows[0].length <= 1024
        assert [r.start for r in rows] == list(np.cumsum([0] + [r.length for r in rows[:-1]]))
        assert sum(r.length for r in rows) == len(ids[i])
        assert all(zlib.crc32(packed(ids[i][r.start : r.start + r.length])) == r.ids_crc32 for r in rows)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences)


def test_packing_is_gapless_and_near_the_bound(result, documents):
    tokenizer = library("byte_bpe_50k.json")
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in documents.items()}
    n = check_packing(list(result("op7_packing").itertuples()), ids)
    assert n <= 1.03 * sum(map(len, ids.values())) / 1024 + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 32), max_size=200), st.integers(1, 9))
def test_bins_hold_what_they_can(lengths, open_bins):
    bins, used, opened = packing.Bins(32, open_bins), {}, {}
    for n in lengths:
        best = min((free for free in opened.values() if free >= n), default=None)
        number, offset = bins.place(n)
        assert offset == used.get(number, 0) and offset + n <= 32
        if best is not None:  # the least free space that holds it
            assert 32 - offset == best
        used[number] = offset + n
        opened = {b: space for space, same in enumerate(bins.free) for b in same}
        assert len(opened) <= open_bins and all(32 - used[b] == free for b, free in opened.items())


def test_packing_takes_odd_tables(spark, odd):
    ids = token_ids.token_ids(F.col("text"), default_path("byte_bpe_50k.json"), 2)
    rows = packing.pack_ids(odd, ids).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 2 * sum(r.length for r in rows if r.doc_id == 2)
    assert [r.length for r in rows if r.doc_id in (3, 4)] == [1, 1] and sum(r.doc_id is None for r in rows) == 1
    assert packing.pack_ids(empty(spark, DOCS), ids).count() == 0
    none = packing.pack_ids(odd, F.lit(None).cast("binary"))
    assert none.count() == 0
    with pytest.raises(Exception, match="not between"):
        packing.pack(spark.createDataFrame([(1, 2000)], "doc_id long, length long"), ["doc_id"]).collect()


# 8 language

def test_languages_of_held_out_rows(result):
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    out = result("op8_language")
    assert len(out) == len(langs) and out.score.between(0, 1).all()
    test = out[out.held_out]
    assert (test.lang_pred == test.doc_id.map(langs)).mean() >= 0.97


def test_pair_tables_give_the_convolution():
    r = np.random.default_rng(2)
    network = language.Network(["a", "b"], [r.normal(size=(w, 256, language.FILTERS)).astype(np.float32) for w in language.WIDTHS], r.normal(size=(24, 2)), r.normal(size=2))
    x = r.integers(0, 256, (3, language.WINDOW), np.uint8)
    plain = [np.stack([sum(t[k][row[i + k]] for k in range(w)) for i in range(language.WINDOW - w + 1)]).max(0) for row in x for t, w in zip(network.tables, language.WIDTHS)]
    assert np.allclose(network.pooled(x), np.concatenate(plain).reshape(3, -1), atol=1e-4)


def test_language_takes_odd_tables(spark, odd):
    network = language.fit(odd)
    rows = odd.select("doc_id", "text", language.identify(spark, network, F.col("text")).alias("f")).collect()
    blank = [r.f.lang_pred == "und" for r in rows]
    assert blank == [r.text is None or not re.search(r"[^\W\d_]", r.text) for r in rows]
    none = language.fit(empty(spark, DOCS))
    assert {r.f for r in odd.select(language.identify(spark, none, F.col("text")).alias("f")).collect()} == {T.Row(lang_pred="und", score=0.0)}


# 9 files of ids

def test_files_give_all_ids_back(result, documents):
    tokenizer, at = library("word_bpe_49k.json"), 0
    out = result("op9_token_files").set_index("doc_id")
    assert len(out) == len(documents)
    for i, text in documents.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert tuple(map(int, out.loc[i, ["start", "n_tokens", "ids_crc32"]])) == (at, len(ids), zlib.crc32(packed(ids)))
        at += len(ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 255, 256, 65535, 65536, 2**24, 2**32 - 1]), max_size=1500), st.data())
def test_codes_are_directly_addressable(ids, data):
    codes = dac.Dac.from_bytes(dac.Dac.encode(np.array(ids, np.uint32)).to_bytes())
    assert len(codes) == len(ids) and codes.range(0, len(ids)).tolist() == ids
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert codes.range(a, b).tolist() == ids[a:b]
    for i in {0, a, b, len(ids) - 1} & set(range(len(ids))):
        assert codes[i] == ids[i]
    with pytest.raises(IndexError):
        codes[len(ids)]


def test_files_take_odd_tables_and_single_places(spark, odd):
    path = dac.new_path(spark)
    dac.write_ids(odd, path, default_path("word_bpe_49k.json"), 1, shard_ids=8)
    rows = dac.read_ids(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]] and [r.n_tokens for r in rows][4:6] == [1, 1]
    every = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in rows])
    asked = spark.createDataFrame([(0,), (5,), (len(every) - 1,), (len(every),), (5,)], "at long")
    found = sorted(dac.ids_at(spark, path, asked).collect(), key=lambda r: r["at"])
    assert [r["id"] for r in found] == [int(every[0]), int(every[5]), int(every[5]), int(every[-1]), None]
    nothing = dac.new_path(spark)
    dac.write_ids(empty(spark, DOCS), nothing, default_path("word_bpe_49k.json"), 1)
    assert dac.read_ids(spark, nothing).count() == 0


# 10 rules

def brute_rules(text):
    w = WORDS.findall(text or "")
    windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    covered = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_rules_equal_brute_force_and_sql(result, documents):
    out = result("op10_host_rules").set_index("doc_id")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for i, text in documents.items():
        if len(text or "") < 6000:
            assert tuple(out.loc[i, names]) == brute_rules(text), i
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = db.execute(SQL["op10_host_rules"]).df().set_index("doc_id")
    assert len(want) == len(out) and (want.sort_index()[[*names, "kept"]] == out.sort_index()[[*names, "kept"]]).all().all()


def test_bad_hosts_take_their_texts_along(spark):
    good, bad = " ".join(f"w{k}" for k in range(60)), "too short"
    hosts = [("bad", 90, 10), ("small", 2, 1)] + [(f"good{k}", 1, 99) for k in range(5)]
    rows = [(bad, h) for h, n, _ in hosts for _ in range(n)] + [(good, h) for h, _, n in hosts for _ in range(n)] + [(good, None), (None, None), ("", "small")]
    df = spark.createDataFrame([(k, t, "en", h, 0) for k, (t, h) in enumerate(rows)], DOCS).withColumn("rate", F.lit("x"))
    measured = rules.measure(df)
    verdict = {r.host: r.host_failed for r in rules.host_verdicts(measured).collect()}
    assert verdict["bad"] and not any(v for h, v in verdict.items() if h.startswith("good"))
    out = rules.host_quality(df).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.kept == (not r.base_failed and not verdict.get(r.host, False))
    assert rules.host_quality(empty(spark, DOCS)).count() == 0
    text = rules._repeated(df.limit(1).select(F.array(*map(F.lit, "a a a a b".split())).alias("_words")).withColumn("n_words", F.size("_words")))
    assert text.first().n_repeat_words == 4


def test_rules_are_native(spark):
    plan = rules.measure(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# pipeline

def test_pipeline_equals_its_stages_by_brute_force(spark, documents):
    schema, docs = spark.read.parquet(f"{SF}/documents.parquet").schema, spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "MinHash near-dedup", "best-fit packing"]
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    left, tokenizer = set(documents), library("byte_bpe_50k.json")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, SF), f"stage{k}")
        if k < 3:
            assert docs.schema.names == schema.names
            now = {r.doc_id for r in docs.select("doc_id").collect()}
            assert now <= left and docs.count() == len(now)
        if k == 0:
            known = [i for i in documents if i in labels]
            assert sum((i in now) == bool(labels[i]) for i in known) >= 0.98 * len(known)
        if k == 1:
            lost = left - now
            assert not [i for i in lost if re.search(r"[^\W\d_]", documents[i] or "") and labels.get(i) == 1]
        if k == 2:
            sets = brute_sets({i: documents[i] for i in left})
            assert now == {i for i, c in brute_components(sets).items() if i == c}
        left = now
    ids = {i: [*tokenizer.encode(documents[i], add_special_tokens=False).ids, 2] for i in left}
    check_packing(docs.collect(), ids)


def test_pipeline_takes_odd_and_empty_tables(spark, odd, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (plain, plain.limit(0)):
        where = f"{tmp_path}/{docs.count()}"
        docs.write.parquet(f"{where}/documents.parquet")
        spark.read.parquet(f"{tmp_path}/labels.parquet").write.parquet(f"{where}/labels.parquet")
        rows = corpus_pipeline.run(spark, where).collect()
        assert {r.doc_id for r in rows} <= {1, 5, 7, None} and bool(rows) == (docs is plain)


def test_training_rows_are_bounded_where_an_id_repeats(spark, monkeypatch):
    ids = [k for k in range(60) if zlib.crc32(str(k).encode()) % 3 != 1][:20]
    rows = [(i, f"text {i} {n}", lang, "a", 1) for i in ids for lang in ("en", "fr") for n in range(200 if i == ids[0] else 2)]
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    monkeypatch.setattr(quality, "train", lambda rows: rows)
    assert len(quality.fit(docs, labels)) == 20 and len(quality.fit(docs, labels, rows=7)) == 7
    monkeypatch.setattr(language, "train", lambda windows, labels, names: (windows, labels, names))
    for most, n in ((5, 5), (100, 20)):
        windows, labels, names = language.fit(docs, per_language=most)
        assert names == ["en", "fr"] and np.bincount(labels).tolist() == [n, n]


def test_texts_that_mix_languages_stay(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "mixed", "en", "a", 1), (2, "...", "en", "a", 1)], DOCS)
    found = F.struct(F.when(F.col("doc_id") == 1, "en").otherwise(language.UNKNOWN).alias("lang_pred"), F.lit(0.2).alias("score"))
    monkeypatch.setattr(language, "fit", lambda docs: None)
    monkeypatch.setattr(language, "identify", lambda spark, network, text: found)
    assert [r.doc_id for r in corpus_pipeline.known_language(spark, docs, SF).collect()] == [1]


def test_documents_that_share_an_id_are_told_apart(spark):
    first, second, third = (" ".join(f"{w}{k}" for k in range(40)) for w in "abc")
    rows = [(9, first + " end", "en", "a", 1), (1, first, "en", "a", 1), (1, second, "en", "a", 1), (2, second + " end", "en", "a", 1)]
    rows += [(None, first, "en", "a", 1), (None, third, "en", "a", 1), (None, third, "en", "b", 1), (3, "", "en", "a", 0), (3, "", "en", "a", 0)]
    rows += [(4, "", "en", "a", 0), (None, None, "en", "a", 0), (None, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    out = corpus_pipeline.without_near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    want = [(1, first), (1, second), (3, ""), (4, ""), (None, None), (None, None), (None, third)]
    assert sorted(map(str, [(r.doc_id, r.text) for r in out.collect()])) == sorted(map(str, want))


def test_queries_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
