"""Registered queries: text cleaning, scoring, topics and record extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from agora import fixed
from agora.catalog import sql as S
from agora.catalog.registry import query
from agora.functions import posts as P
from agora.functions import text as X
from agora.operators import sentiment, topics
from agora.operators.topics import label_rules
from agora.sources import sample_posts as sample
from agora.sources.html_posts import extract_html_records, next_page_link
from agora.sources.json_posts import extract_json_records

_SPACE, _NON_SPACE = f"[{fixed.SPACES}]", f"[^{fixed.SPACES}]"


def _documents(spark, sf):
    return sample.read(spark, sf, "documents").select("doc_id", "text")


def _sub(column: str, pattern: str, new: str = "") -> str:
    return f"regexp_replace({column}, {S.text(pattern)}, {S.text(new)}, 'g')"


# --- cleaning steps -----------------------------------------------------------


@query(
    "unescape_html",
    """SELECT page_id, replace(replace(replace(replace(replace(html, '&amp;', '&'), '&amp', '&'), '&quot;', '"'),
  '&copy;', '©'), '&middot;', '·') AS text FROM pages""",
)
def unescape_html(spark, sf):
    """Entities of whole pages resolved; the SQL spells out those the test pages hold ('&amp' also counts without ';')."""
    return sample.read(spark, sf, "pages").select("page_id", X.unescape_html(F.col("html")).alias("text"))


@query("strip_tags", f"SELECT page_id, {_sub('html', '<[^>]+>', ' ')} AS text FROM pages")
def strip_tags(spark, sf):
    return sample.read(spark, sf, "pages").select("page_id", X.strip_tags(F.col("html")).alias("text"))


@query("strip_symbols", f"SELECT doc_id, {_sub('text', '[' + chr(92) + 'p{S}<>' + chr(92) + '[' + chr(92) + ']]')} AS text FROM documents")
def strip_symbols(spark, sf):
    return _documents(spark, sf).select("doc_id", X.strip_symbols(F.col("text")).alias("text"))


# The test texts hold no character NFKC changes, so each text is given some: (written, normal).
_COMPATIBLE = [("\ufb01", "fi"), ("\u2163", "IV"), ("\uff12", "2"), ("e\u0301", "\u00e9"), ("\u00a0", " "), ("\u212b", "\u00c5")]


@query(
    "nfkc",
    "SELECT doc_id, '" + "".join(b for _, b in _COMPATIBLE) + "' || replace(text, 'fi', 'fi ') || '2' AS text FROM documents",
)
def nfkc(spark, sf):
    """Documents with ligatures and other compatible forms in them."""
    odd = F.concat(F.lit("".join(a for a, _ in _COMPATIBLE)), F.replace("text", F.lit("fi"), F.lit("\ufb01\u2003")), F.lit("\u00b2"))
    return _documents(spark, sf).select("doc_id", X.nfkc(odd).alias("text"))


_URL = (
    rf"https?://{_NON_SPACE}+|www\.{_NON_SPACE}+|[\p{{L}}\p{{N}}_.-]+\."
    rf"(?:{'|'.join(fixed.COMMON_TLDS)}){_NON_SPACE}*"
)


@query(
    "strip_urls",
    f"""SELECT page_id, {_sub('url', _URL)} AS url, {_sub('html', _URL)} AS text FROM pages""",
)
def strip_urls(spark, sf):
    return sample.read(spark, sf, "pages").select(
        "page_id", X.strip_urls(F.col("url"), fixed.COMMON_TLDS).alias("url"),
        X.strip_urls(F.col("html"), fixed.COMMON_TLDS).alias("text"),
    )


@query(
    "strip_emails",
    "SELECT doc_id, "
    + _sub("text", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b")
    + " AS text FROM documents",
)
def strip_emails(spark, sf):
    return _documents(spark, sf).select("doc_id", X.strip_emails(F.col("text")).alias("text"))


# Documents hold few hashtags, so turns of conversations and a tagged form of
# every document join them.
_TAGGED_SQL = """tagged AS (SELECT doc_id, '#' || lang || '_' || source || ' ' || replace(text, ' a', ' #Viral #viralvideo') AS text FROM documents)"""
_EXPAND_SQL = f"""list_reduce(list_prepend(text, regexp_extract_all(text, '#[\\p{{L}}\\p{{N}}_]+')), lambda acc, tag:
  replace(acc, tag, CASE WHEN lower(tag) IN ({", ".join(S.text(t) for t in fixed.DROPPED_HASHTAGS)}) THEN ''
    ELSE regexp_replace(replace(ltrim(tag, '#'), '_', ' '), '([A-Za-z])([0-9])', '\\1 \\2', 'g') END))"""


def _tagged(spark, sf):
    text = F.concat(
        F.lit("#"), "lang", F.lit("_"), "source", F.lit(" "),
        F.replace("text", F.lit(" a"), F.lit(" #Viral #viralvideo")),
    )
    return sample.read(spark, sf, "documents").select("doc_id", text.alias("text"))


@query("expand_hashtags", f"WITH {_TAGGED_SQL} SELECT doc_id, {_EXPAND_SQL} AS text FROM tagged")
def expand_hashtags(spark, sf):
    """Documents with a tag of their own and many listed tags."""
    return _tagged(spark, sf).select("doc_id", X.expand_hashtags(F.col("text")).alias("text"))


@query(
    "hashtag_counts",
    f"""WITH {_TAGGED_SQL}, tags AS (SELECT unnest(regexp_extract_all(text, '#[\\p{{L}}\\p{{N}}_]+')) AS tag FROM tagged)
SELECT lower(tag) AS tag, count(*) AS uses FROM tags GROUP BY ALL""",
)
def hashtag_counts(spark, sf):
    tags = _tagged(spark, sf).select(F.explode(X.hashtags(F.col("text"))).alias("tag"))
    return tags.groupBy(F.lower("tag").alias("tag")).agg(F.count(F.lit(1)).alias("uses"))


@query("strip_mentions", f"SELECT doc_id, {_sub('text', '@([' + chr(92) + 'p{L}' + chr(92) + 'p{N}_]+)', chr(92) + '1')} AS text FROM documents")
def strip_mentions(spark, sf):
    return _documents(spark, sf).select("doc_id", X.strip_mentions(F.col("text")).alias("text"))


_WORDS = {"the": "teh", "of": "o'", "le": "lé", "et": "and then", "der": "d", "and": "n", "la": "l", "a": "an"}
_TOKENS_SQL = f"list_filter(string_split_regex(text, '{_SPACE}+'), lambda w: w <> '')"


_SLANG = {**_WORDS, **fixed.SLANG}


def _slang_sql(words: dict) -> str:
    cases = " ".join(f"WHEN {S.text(k)} THEN {S.text(v)}" for k, v in words.items())
    return f"array_to_string(list_transform({_TOKENS_SQL}, lambda w: CASE w {cases} ELSE w END), ' ')"


@query(
    "normalize_slang",
    f"SELECT doc_id, {_slang_sql(_SLANG)} AS text FROM (SELECT doc_id, text || ' ' || {S.text(' '.join(fixed.SLANG))} AS text FROM documents)",
)
def normalize_slang(spark, sf):
    """Documents with every word of the shipped map after their own."""
    text = F.concat("text", F.lit(" " + " ".join(fixed.SLANG)))
    return _documents(spark, sf).select("doc_id", X.normalize_slang(text, _SLANG).alias("text"))


@query("strip_emoji", f"SELECT doc_id, {_sub('text', '[' + X.emoji_class() + ']+')} AS text FROM documents")
def strip_emoji(spark, sf):
    return _documents(spark, sf).select("doc_id", X.strip_emoji(F.col("text")).alias("text"))


@query("collapse_ws", f"SELECT doc_id, trim({_sub('text', _SPACE + '+', ' ')}, ' ') AS text FROM documents")
def collapse_ws(spark, sf):
    return _documents(spark, sf).select("doc_id", X.collapse_whitespace(F.col("text")).alias("text"))


def _chain(first: str, *steps: str) -> str:
    """SQL that applies ``steps``, expressions over ``text``, one after the other."""
    out = first
    for step in steps:
        out = f"SELECT id, {step} AS text FROM ({out})"
    return out


@query(
    "clean_text",
    "SELECT id, text AS processed_text FROM (" + _chain(
        """SELECT 'd' || CAST(doc_id AS VARCHAR) AS id, text FROM documents UNION ALL SELECT 'p' || CAST(page_id AS VARCHAR), html FROM pages
  UNION ALL SELECT 'c' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR), text FROM conversations""",
        """replace(replace(replace(replace(replace(text, '&amp;', '&'), '&amp', '&'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·')""",
        _sub("text", "<[^>]+>", " "),
        _sub("text", r"[\p{S}<>\[\]]"),
        _sub("text", _URL),
        _sub("text", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"),
        _EXPAND_SQL,
        _sub("text", r"@([\p{L}\p{N}_]+)", r"\1"),
        _slang_sql(fixed.SLANG),
        _sub("text", "[" + X.emoji_class() + "]+"),
        f"trim({_sub('text', _SPACE + '+', ' ')}, ' ')",
    ) + ")",
)
def clean_text(spark, sf):
    """The full cleaner over documents, pages and conversation turns."""
    docs = sample.read(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    pages = sample.read(spark, sf, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), F.col("html").alias("text"))
    turns = sample.read(spark, sf, "conversations").select(F.concat(F.lit("c"), "conv_id", F.lit("_"), "turn").alias("id"), "text")
    texts = docs.unionByName(pages).unionByName(turns)
    return X.clean_text(texts, "text", tlds=fixed.COMMON_TLDS).select("id", "processed_text")


@query(
    "tokenize",
    f"SELECT doc_id, len(t) AS n_tokens, array_to_string(t, '|') AS tokens FROM (SELECT doc_id, {_TOKENS_SQL} AS t FROM documents)",
)
def tokenize(spark, sf):
    tokens = X.tokenize(F.col("text"))
    return _documents(spark, sf).select(
        "doc_id", F.size(tokens).cast("long").alias("n_tokens"), F.array_join(tokens, "|").alias("tokens")
    )


_STOP = ["The", "of", "and", "to", "le", "la", "de", "et", "der", "die", "el", "los", " in "]


@query(
    "remove_stopwords",
    f"""SELECT doc_id, array_to_string(list_filter({_TOKENS_SQL},
  lambda w: NOT list_contains({S.words(sorted(w.strip().lower() for w in _STOP))}, lower(w))), ' ') AS text FROM documents""",
)
def remove_stopwords(spark, sf):
    kept = X.remove_stopwords(X.tokenize(F.col("text")), _STOP)
    return _documents(spark, sf).select("doc_id", F.array_join(kept, " ").alias("text"))


_LISTED_SQL = f"SELECT DISTINCT unnest(list_transform({_TOKENS_SQL}, lambda w: lower(w))) AS word FROM benchmark"


@query(
    "remove_listed",
    f"""WITH listed AS MATERIALIZED ({_LISTED_SQL}), l AS MATERIALIZED (SELECT list(word) AS words FROM listed),
t AS (SELECT doc_id, unnest({_TOKENS_SQL}) AS w, generate_subscripts({_TOKENS_SQL}, 1) AS i FROM documents),
k AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM t WHERE lower(w) NOT IN (SELECT word FROM listed) GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.text, '') AS text FROM documents d LEFT JOIN k USING (doc_id)""",
)
def remove_listed(spark, sf):
    """Words of a table of any length dropped from every document: here all words of the benchmark."""
    benchmark = sample.read(spark, sf, "benchmark")
    listed = benchmark.select(F.explode(X.tokenize(F.col("text"))).alias("w")).select(F.lower("w").alias("word"))
    tokens = _documents(spark, sf).withColumn("tokens", X.tokenize(F.col("text")))
    return X.remove_listed(tokens, "doc_id", "tokens", listed).select("doc_id", F.array_join("kept_tokens", " ").alias("text"))


# --- sentiment and topics -----------------------------------------------------

_POSITIVE, _NEGATIVE = ["the", "and", "le", "der", "el"], ["of", "to", "la", "die", "los", "de"]


@query(
    "lexicon_sentiment",
    f"""WITH t AS (SELECT doc_id, list_transform({_TOKENS_SQL}, lambda w: lower(w)) AS t FROM documents),
h AS (SELECT doc_id, len(list_filter(t, lambda w: list_contains({S.words(_POSITIVE)}, w))) AS positive_hits,
  len(list_filter(t, lambda w: list_contains({S.words(_NEGATIVE)}, w))) AS negative_hits FROM t)
SELECT doc_id, positive_hits, negative_hits, CASE WHEN positive_hits > negative_hits THEN 'positive'
  WHEN negative_hits > positive_hits THEN 'negative' ELSE 'neutral' END AS sentiment_label,
  CASE WHEN positive_hits + negative_hits = 0 THEN 0.0::DOUBLE ELSE round(CAST(greatest(positive_hits, negative_hits) AS DOUBLE)
    / (positive_hits + negative_hits), 4) END AS sentiment_score FROM h""",
)
def lexicon_sentiment(spark, sf):
    out = sentiment.lexicon_sentiment(_documents(spark, sf), "text", _POSITIVE, _NEGATIVE).drop("text")
    return out.withColumns({c: F.col(c).cast("long") for c in ("positive_hits", "negative_hits")})


@query(
    "weighted_lexicon",
    f"""WITH lexicon AS (SELECT word, (length(word) * 7 % 11 - 5) / 2.0 AS weight FROM ({_LISTED_SQL})),
t AS (SELECT doc_id, lower(unnest({_TOKENS_SQL})) AS word FROM documents),
n AS (SELECT doc_id, word, count(*) AS n FROM t GROUP BY ALL),
s AS (SELECT doc_id, CAST(sum(greatest(weight * n, 0)) AS DOUBLE) AS p, CAST(sum(greatest(-weight * n, 0)) AS DOUBLE) AS q FROM n JOIN lexicon USING (word) GROUP BY doc_id),
f AS (SELECT doc_id, coalesce(p, 0) AS p, coalesce(q, 0) AS q FROM documents LEFT JOIN s USING (doc_id))
SELECT doc_id, p AS positive_weight, q AS negative_weight,
  CASE WHEN p > q THEN 'positive' WHEN q > p THEN 'negative' ELSE 'neutral' END AS sentiment_label,
  CASE WHEN p + q = 0 THEN 0.0::DOUBLE ELSE round(greatest(p, q) / (p + q), 4) END AS sentiment_score FROM f""",
)
def weighted_lexicon(spark, sf):
    """Sums of weights from a lexicon table: the words of the benchmark, weighted by their length."""
    words = sample.read(spark, sf, "benchmark").select(F.explode(X.tokenize(F.col("text"))).alias("w")).select(F.lower("w").alias("word")).distinct()
    lexicon = words.withColumn("weight", (F.length("word") * 7 % 11 - 5) / 2)
    return sentiment.weighted_lexicon_sentiment(_documents(spark, sf), "doc_id", "text", lexicon).drop("text")


def _length_model():
    """A stand-in model: class and probability by the length of the text; the last class has no label."""

    def predict(texts):
        return [(f"LABEL_{len(t) % 4}", len(t) * 37 % 10007 / 10007) for t in texts]

    return predict


@query(
    "score_sentiment",
    """SELECT doc_id, CASE length(text) % 4 WHEN 0 THEN 'positive' WHEN 2 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
  CAST(round(length(text) * 37 % 10007 / 10007.0::DOUBLE * 10000) AS BIGINT) AS score_parts FROM documents""",
)
def score_sentiment(spark, sf):
    """Any model as scorer: its batches, the label table, scores of four digits."""
    out = sentiment.score_sentiment(_documents(spark, sf), "text", _length_model)
    return out.select("doc_id", "sentiment_label", (F.col("sentiment_score") * 10000).cast("long").alias("score_parts"))


@query("trained_sentiment")
def trained_sentiment(spark, sf):
    """The trainable default scorer: fitted on labelled documents, applied to every document."""
    scores = sample.document_scores(spark, sf, text=True)
    model = sentiment.train_sentiment(
        scores.where(F.col("sentiment_label").isNotNull()), "text_content", "sentiment_label"
    )
    return sentiment.score_with_model(scores.select("doc_id", "text_content"), "text_content", model).drop("text_content")


_N_TOPICS = 5


@query(
    "fit_topics",
    f"""SELECT CAST(t.i AS BIGINT) AS topic_no, 'Lainnya' AS topic_label, 'Umum' AS topic_category, 5 AS n_keywords, true AS words_occur
FROM range({_N_TOPICS}) t(i)""",
)
def fit_topics(spark, sf):
    """Topics of all documents: their number, labels (no rule's words occur in these texts) and that their words are the texts' own."""
    docs = _documents(spark, sf)
    model = topics.fit_topics(docs, "text", _N_TOPICS)
    table, top = topics.topic_table(spark, model), sorted({w for _, words in model.top for w in words})
    words = docs.select(F.explode(F.filter(X.tokenize(F.col("text")), lambda w: w.isin(top))).alias("word")).distinct()
    named = table.select("topic_no", "topic_label", "topic_category", F.explode("top_keywords").alias("word"))
    met = named.join(words.withColumn("_known", F.lit(True)), "word", "left")
    return met.groupBy(F.col("topic_no").cast("long").alias("topic_no"), "topic_label", "topic_category").agg(
        F.count_distinct("word").cast("int").alias("n_keywords"), F.every(F.coalesce("_known", F.lit(False))).alias("words_occur")
    )


@query(
    "assign_topic",
    f"""WITH t AS (SELECT doc_id, len({_TOKENS_SQL}) > 0 AS has_topic FROM documents)
SELECT doc_id, has_topic, CASE WHEN has_topic THEN 'Lainnya' ELSE 'Tidak Terklasifikasi' END AS topic_label, 'Umum' AS topic_category,
  CASE WHEN has_topic THEN 5 ELSE 0 END AS n_keywords FROM t""",
)
def assign_topic(spark, sf):
    """Every document once, with one of the topics if it has a word, else the default."""
    docs = _documents(spark, sf)
    out = topics.assign_topic(docs, "text", topics.fit_topics(docs, "text", _N_TOPICS))
    has = F.coalesce(F.col("topic_no").between(0, _N_TOPICS - 1), F.lit(False)).alias("has_topic")
    return out.select("doc_id", has, "topic_label", "topic_category", F.size("top_keywords").alias("n_keywords"))


# The rules' words, which the test texts lack, and one of no rule: two join the words of each document.
_RULE_WORDS = [w for words, _, _ in fixed.TOPIC_RULES for w in words] + ["lain"]
_N_WORDS = len(_RULE_WORDS)


@query(
    "label_rules",
    f"""WITH w AS (SELECT {S.words(_RULE_WORDS)} AS w), t AS (SELECT doc_id,
  list_concat({_TOKENS_SQL}, [w[doc_id % {_N_WORDS} + 1], w[doc_id // 7 * 11 % {_N_WORDS} + 1]]) AS t FROM documents, w)
SELECT doc_id, CASE {" ".join(f"WHEN list_has_any(t, {S.words(w)}) THEN {S.text(n)}" for w, n, _ in fixed.TOPIC_RULES)}
    ELSE 'Lainnya' END AS topic_label,
  CASE {" ".join(f"WHEN list_has_any(t, {S.words(w)}) THEN {S.text(c)}" for w, _, c in fixed.TOPIC_RULES)} ELSE 'Umum' END AS topic_category FROM t""",
)
def label_rules_(spark, sf):
    """First of the shipped rules sharing a word with the document."""
    listed = F.array(*[F.lit(w) for w in _RULE_WORDS])
    added = [F.element_at(listed, (n % _N_WORDS + 1).cast("int")) for n in (F.col("doc_id"), F.floor(F.col("doc_id") / 7) * 11)]
    words = F.concat(X.tokenize(F.col("text")), F.array(*added))
    return _documents(spark, sf).select("doc_id", label_rules(words).alias("l")).select("doc_id", "l.*")


@query(
    "topic_default",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'Tidak Terklasifikasi' ELSE lang END AS topic_label,
  CASE WHEN l.doc_id IS NULL THEN 'Umum' ELSE 'known' END AS topic_category, CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS n_keywords
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def topic_default(spark, sf):
    """Documents nobody has labelled are unclassified, the others keep their topic."""
    labels = sample.read(spark, sf, "labels").select("doc_id", F.lit(True).alias("some"))
    named = sample.read(spark, sf, "documents").join(labels, "doc_id", "left").select(
        "doc_id",
        F.when(F.col("some"), F.col("lang")).alias("topic_label"),
        F.when(F.col("some"), F.lit("known")).alias("topic_category"),
        F.when(F.col("some"), F.array("lang")).alias("top_keywords"),
    )
    out = topics.with_topic_default(named)
    return out.select("doc_id", "topic_label", "topic_category", F.size("top_keywords").alias("n_keywords"))


# --- extraction ---------------------------------------------------------------


def _search_pages(spark, sf):
    """Search result pages as a site would render them, one per order."""
    stat = lambda icon, n: F.concat(
        F.lit(f'<span class="tweet-stat"><div class="icon-container"><span class="{icon}"></span> '),
        n,
        F.lit("</div></span>"),
    )
    count = lambda c: F.when(c == 0, F.lit("")).otherwise(F.format_number(c, 0))
    p = sample.x_posts(spark, sf)
    when = F.date_format("posted_at", "MMM d, yyyy · h:mm a 'UTC'")
    page = F.concat(
        F.lit('<html><body><div class="timeline"><div class="timeline-item show-more"><a href="?f=tweets">Load newest</a></div>'),
        F.lit('<div class="timeline-item "><a class="tweet-link" href="/'), "username", F.lit("/status/"), "id",
        F.lit('#m"></a><div class="tweet-body"><a class="fullname" href="/x">User '), "username",
        F.lit(' &amp; Co</a><a class="username" href="/x">@'), "username",
        F.lit('</a><span class="tweet-date"><a title="'), when, F.lit('">now</a></span>'),
        F.lit('<div class="tweet-content media-body">Post <b>'), "id", F.lit("</b><br>by "), "username", F.lit("</div>"),
        stat("icon-comment", count(F.col("comment_count"))),
        stat("icon-retweet", count(F.col("retweet_count"))),
        stat("icon-quote", count(F.col("quote_count"))),
        stat("icon-heart", count(F.col("like_count"))),
        F.lit('</div></div><div class="timeline-item"><a class="tweet-link" href="/y/status/no-date"></a></div>'),
        F.lit('<div class="show-more"><a href="?cursor='), "id", F.lit('">Load more</a></div></div></body></html>'),
    )
    return p.select("id", page.alias("html"))


@query(
    "extract_html_records",
    f"""WITH {S.POSTS} SELECT id, 'User ' || username || ' & Co' AS fullname, '@' || username AS username,
  'Post ' || id || 'by ' || username AS text_content, epoch_us(posted_at) AS posted_at, CAST(like_count AS BIGINT) AS like_count,
  CAST(comment_count AS BIGINT) AS comment_count, CAST(retweet_count AS BIGINT) AS retweet_count,
  CAST(quote_count AS BIGINT) AS quote_count FROM x_posts""",
)
def extract_html_records_(spark, sf):
    """Pages rendered from the posts and read back: the posts again."""
    out = extract_html_records(_search_pages(spark, sf), "html")
    counts = [F.col(c).cast("long").alias(c) for c in ("like_count", "comment_count", "retweet_count", "quote_count")]
    return out.select("id", "fullname", "username", "text_content", F.unix_micros("posted_at").alias("posted_at"), *counts)


@query("next_page_link", "SELECT CAST(o_orderkey AS VARCHAR) AS id, '?cursor=' || CAST(o_orderkey AS VARCHAR) AS next_link FROM orders")
def next_page_link_(spark, sf):
    return next_page_link(_search_pages(spark, sf), "html").select("id", "next_link")


@query(
    "extract_json_records",
    f"""WITH {S.POSTS} SELECT id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE username END AS username,
  CASE WHEN doc_id % 3 = 0 THEN 'title ' || id WHEN doc_id % 3 = 1 THEN 'body ' || id ELSE '' END AS text_content, subreddit,
  CAST(floor(epoch(posted_at)) AS BIGINT) AS posted_at, score, upvote_count, downvote_count,
  'https://www.reddit.com' || permalink AS permalink FROM reddit_posts""",
)
def extract_json_records_(spark, sf):
    """Responses built from the posts, with a post lacking an id in each: the posts again."""
    p = sample.reddit_posts(spark, sf)
    third = F.col("doc_id") % 3
    post = F.struct(
        "id",
        F.when(F.col("doc_id") % 7 != 0, F.col("username")).alias("author"),
        F.when(third == 0, F.concat(F.lit("title "), "id")).otherwise("").alias("selftext"),
        F.when(third == 1, F.concat(F.lit("body "), "id")).alias("body"),
        "subreddit",
        F.unix_seconds("posted_at").cast("string").alias("created_utc"),
        "score",
        F.col("upvote_count").alias("ups"),
        F.col("downvote_count").alias("downs"),
        "permalink",
    )
    broken = post.withField("id", F.lit(None).cast("string"))
    responses = p.select(F.to_json(F.struct(F.array(post, broken).alias("data"))).alias("body"))
    # Half the providers send the time as a number, half as text.
    numeric = F.regexp_replace("body", r'"created_utc":"(\d+)"', r'"created_utc":$1')
    responses = responses.withColumn("body", F.when(F.length("body") % 2 == 0, numeric).otherwise(F.col("body")))
    out = extract_json_records(responses, "body")
    counts = [F.col(c).cast("long").alias(c) for c in ("score", "upvote_count", "downvote_count")]
    return out.select(
        "id", "username", "text_content", "subreddit", F.unix_seconds("posted_at").alias("posted_at"), *counts, "permalink"
    )


@query(
    "parse_times",
    f"""WITH {S.POSTS} SELECT id, epoch_us(posted_at) AS from_title, CAST(epoch(posted_at) AS BIGINT) AS from_epoch FROM x_posts""",
)
def parse_times(spark, sf):
    """Timestamps written as page titles and as epoch text, read back."""
    p = sample.x_posts(spark, sf).select(
        "id",
        F.date_format("posted_at", "MMM d, yyyy · h:mm a 'UTC'").alias("title"),
        F.unix_seconds("posted_at").cast("string").alias("epoch"),
    )
    return p.select(
        "id",
        F.unix_micros(P.time_from_title(F.col("title"))).alias("from_title"),
        F.unix_seconds(P.time_from_epoch(F.col("epoch"))).alias("from_epoch"),
    )
