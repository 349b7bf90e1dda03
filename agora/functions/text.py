"""Text cleaning as native column expressions.

Two steps have no Spark built-in (HTML unescape and NFKC); they are Arrow
batched (``agora.session`` bounds a batch's rows and bytes), and only texts that
can change are handed to Python.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from agora import fixed

# The characters of fixed.SPACES, in the form Java tests fastest.
_SPACE = r"(?U:[\s\x{1C}-\x{1F}])"
_NON_SPACE = r"(?U:[^\s\x{1C}-\x{1F}])"
# Python's \b, spelled out because Java's differs outside ASCII.
_EDGE = f"(?:(?<={fixed.WORD})(?!{fixed.WORD})|(?<!{fixed.WORD})(?={fixed.WORD}))"
# Letters that [a-z] matches when case is ignored.
_ANY_CASE_AZ = r"[A-Za-z\x{130}\x{131}\x{17F}\x{212A}]"



def _java(pattern: str) -> str:
    """A fixed pattern with Python's classes spelled out for Java."""
    return pattern.replace(r"\w", fixed.WORD).replace(r"\S", _NON_SPACE).replace(r"\b", _EDGE)


EMAIL, HASHTAG, MENTION = map(_java, (fixed.EMAIL, fixed.HASHTAG, fixed.MENTION))
# A whole run of word characters and '#' that holds a '#'; tried from the start of a run only.
_TAGGED_RUN = f"(?<![#{fixed.WORD}]){fixed.WORD}*+#[#{fixed.WORD}]*+"


def _unescape_all(text: str) -> str:
    # '&amp;amp;lt;' needs several rounds.
    while "&" in text and (once := html.unescape(text)) != text:
        text = once
    return text


def _mapped(texts: pa.Array, change: Callable[[str], str]) -> pa.Array:
    # One text at a time: only the batch and its result are held.
    return pa.array((change(t.as_py()) if t.is_valid else None for t in texts), pa.string())


@F.arrow_udf(StringType())
def _unescape(texts: pa.Array) -> pa.Array:
    return _mapped(texts, _unescape_all)


@F.arrow_udf(StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    return _mapped(texts, lambda t: unicodedata.normalize("NFKC", t))


def unescape_html(text: Column) -> Column:
    """Resolve HTML entities until the text no longer changes."""
    return F.coalesce(_unescape(F.when(text.contains("&"), text)), text)


def strip_tags(text: Column) -> Column:
    return F.when(text.contains("<"), F.regexp_replace(text, fixed.TAG, " ")).otherwise(text)


def strip_symbols(text: Column) -> Column:
    """Drop Unicode symbols (category S, which holds < and >) and square brackets."""
    return F.regexp_replace(text, r"[\p{S}\[\]]", "")


def nfkc(text: Column) -> Column:
    return F.coalesce(_nfkc(F.when(text.rlike(f"[{fixed.NFKC_CHANGES}]"), text)), text)


def _any_tld(tlds: Sequence[str]) -> str:
    """Alternatives for the given TLDs, short enough for a list of thousands.

    What follows a TLD is matched up to the next white space, so 'com' adds
    nothing to 'co'. The rest is grouped by first letter.
    """
    kept: list[str] = []
    for name in sorted(set(tlds)):
        if not kept or not name.startswith(kept[-1]):
            kept.append(name)
    if not kept or not kept[0]:
        raise ValueError("without a TLD every text holding a dot would match")
    by_letter: dict[str, list[str]] = {}
    for name in kept:
        by_letter.setdefault(name[0], []).append(re.escape(name[1:]))
    return "|".join(f"{re.escape(letter)}(?:{'|'.join(rest)})" for letter, rest in by_letter.items())


def url_pattern(tlds: Sequence[str]) -> str:
    """Regular expression for links and bare domains below the given TLDs."""
    names = _any_tld(tlds)
    run = r"[\p{L}\p{N}_.-]"
    # A bare domain is only tried from the start of its run of characters: a
    # later start can match nothing the first start did not, and trying each
    # one would cost quadratic time on long unbroken texts.
    return rf"{_java(fixed.LINK)}|(?<!{run}){run}+\.(?:{names}){_NON_SPACE}*"


def strip_urls(text: Column, tlds: Sequence[str]) -> Column:
    pattern = url_pattern(tlds)
    # Every match holds one of these; few texts do, and looking for them is cheap.
    suspect = text.rlike(rf"://|www\.|\.(?:{_any_tld(tlds)})")
    return F.when(suspect, F.regexp_replace(text, pattern, "")).otherwise(text)


def strip_emails(text: Column) -> Column:
    return F.when(text.contains("@"), F.regexp_replace(text, EMAIL, "")).otherwise(text)


def hashtags(text: Column) -> Column:
    """All hashtags of a text, in order, with repeats."""
    return F.regexp_extract_all(text, F.lit(HASHTAG), F.lit(0))


def expand_hashtags(text: Column, dropped: Sequence[str] = fixed.DROPPED_HASHTAGS) -> Column:
    """Remove listed hashtags and turn the others into words.

    Each tag is replaced wherever it occurs, in order of appearance, so
    dropping '#viral' also shortens a later '#viralvideo'.
    """

    def words(tag: Column) -> Column:
        name = F.translate(F.ltrim(tag, F.lit("#")), "_", " ")
        return F.regexp_replace(name, f"({_ANY_CASE_AZ})([0-9])", "$1 $2")

    def replace(acc: Column, tag: Column) -> Column:
        new = F.when(F.lower(tag).isin(list(dropped)), F.lit("")).otherwise(words(tag))
        return F.replace(acc, tag, new)

    # No replacement reaches beyond its run of word characters and '#', so tags meet the text's
    # distinct runs, one a line, and not the whole text once for each tag.
    def expanded(runs: Column) -> Column:
        written = F.array_distinct(runs)
        lines = F.aggregate(hashtags(text), F.array_join(written, "\n"), replace)
        return _let(F.map_from_arrays(written, F.split(lines, "\n", -1)), lambda table: joined(runs, table))

    def joined(runs: Column, table: Column) -> Column:
        # One piece more than runs: the last one has no run after it.
        pieces = F.zip_with(F.split(text, _TAGGED_RUN, -1), runs, lambda a, run: F.concat(a, F.coalesce(F.element_at(table, run), F.lit(""))))
        return F.array_join(pieces, "")

    runs = F.regexp_extract_all(text, F.lit(_TAGGED_RUN), F.lit(0))
    return F.when(text.contains("#"), _let(runs, lambda r: F.when(F.size(r) > 0, expanded(r)).otherwise(text))).otherwise(text)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: inside a lambda it would be computed for each element."""
    return F.transform(F.array(value), use)[0]


def strip_mentions(text: Column) -> Column:
    return F.when(text.contains("@"), F.regexp_replace(text, MENTION, "$1")).otherwise(text)


def _word_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def normalize_slang(text: Column, slang: Mapping[str, str] = fixed.SLANG) -> Column:
    """Replace whole tokens, case-sensitively, and join the tokens by one space."""
    tokens = tokenize(text)
    if not slang:
        return F.array_join(tokens, " ")
    table = _word_map(slang)
    # isin() probes a hash set; the map is only searched on a hit.
    return F.array_join(
        F.transform(tokens, lambda w: F.when(w.isin(list(slang)), F.element_at(table, w)).otherwise(w)),
        " ",
    )


def emoji_class() -> str:
    """The emoji ranges, merged, as the inside of a character class."""
    merged: list[list[int]] = []
    for first, last in sorted(fixed.EMOJI):
        if merged and first <= merged[-1][1] + 1:
            merged[-1][1] = max(last, merged[-1][1])
        else:
            merged.append([first, last])
    return "".join(f"\\x{{{first:X}}}-\\x{{{last:X}}}" for first, last in merged)


def strip_emoji(text: Column) -> Column:
    # Most characters lie below the lowest range: one comparison settles them.
    first, last = min(fixed.EMOJI)[0], max(fixed.EMOJI)[1]
    return F.regexp_replace(text, f"[\\x{{{first:X}}}-\\x{{{last:X}}}&&[{emoji_class()}]]+", "")


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"{_SPACE}+", " "))


def _squeeze(text: Column) -> Column:
    """``collapse_whitespace`` for texts whose only white space is the blank."""
    loose = text.contains("  ") | text.startswith(" ") | text.endswith(" ")
    return F.when(loose, F.trim(F.regexp_replace(text, " {2,}", " "))).otherwise(text)


def tokenize(text: Column) -> Column:
    """Whitespace tokens, case kept, nothing removed."""
    return F.filter(F.split(text, f"{_SPACE}+"), lambda w: w != "")


def remove_stopwords(tokens: Column, words: Sequence[str]) -> Column:
    """Drop tokens whose lower-case form is listed; keep repeats and order."""
    listed = sorted({w.strip().lower() for w in words if w.strip()})
    if not listed:
        return tokens
    return F.filter(tokens, lambda w: ~F.lower(w).isin(listed))


def remove_listed(df: DataFrame, key: str, tokens: str, words: DataFrame, out_col: str = "kept_tokens") -> DataFrame:
    """``remove_stopwords`` for lists of any length: ``words`` (column word, lower case) is a table.

    ``key`` must be unique in ``df``. Tokens meet the list in a join; each row
    then gets back what is left of its own tokens, in order.
    """
    listed = words.select(F.col("word").alias("_word")).distinct()
    each = df.select(key, F.posexplode(tokens).alias("_place", "_token")).withColumn("_word", F.lower("_token"))
    left = each.join(listed, "_word", "left_anti").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_place", "_token"))).alias("_left"))
    kept = F.coalesce(F.col("_left._token"), F.array().cast("array<string>"))
    return df.join(left, key, "left").withColumn(out_col, kept).drop("_left")


def read_word_list(spark: SparkSession, *paths: str, limit: int = 50_000) -> list[str]:
    """The union of word files, one word per line: trimmed, lower-cased, '#' lines skipped.

    Word lists become literals of the plan, so their size is checked first.
    """
    word = F.lower(F.trim(F.col("value")))
    rows = (
        spark.read.text(list(paths))
        .where(~F.col("value").startswith("#"))
        .select(word.alias("word"))
        .where("word <> ''")
        .distinct()
        .limit(limit + 1)
        .collect()
    )
    if len(rows) > limit:
        raise ValueError(f"word list holds more than {limit} words: use remove_listed")
    return sorted(r.word for r in rows)


def clean_text(
    df: DataFrame,
    text_col: str,
    out_col: str = "processed_text",
    *,
    tlds: Sequence[str],
    dropped_hashtags: Sequence[str] = fixed.DROPPED_HASHTAGS,
    slang: Mapping[str, str] = fixed.SLANG,
) -> DataFrame:
    """Run every cleaning step, in this fixed order, into ``out_col``.

    ``tlds`` are the top-level domains of bare links: the whole public registry
    list (``read_word_list`` of its file) for real texts.
    One projection per step keeps intermediate texts plain columns, so that
    native steps that look at a text twice do not repeat the steps before.
    """
    # Joining the tokens leaves blanks only, as long as the slang values hold no
    # other white space, so the last step rarely has to touch a text.
    slang = {word: " ".join(value.split()) for word, value in slang.items()}
    steps = [
        unescape_html,
        strip_tags,
        strip_symbols,
        nfkc,
        lambda t: strip_urls(t, tlds),
        strip_emails,
        lambda t: expand_hashtags(t, dropped_hashtags),
        strip_mentions,
        lambda t: normalize_slang(t, slang),
        strip_emoji,
        _squeeze,
    ]
    out = df.withColumn(out_col, F.col(text_col))
    for step in steps:
        out = out.withColumn(out_col, step(F.col(out_col)))
    return out


def trigrams(text: Column) -> Column:
    """Distinct three-letter pieces of the lower-cased words, each word padded by '  ' and ' '."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))

    def pieces(word: Column) -> Column:
        padded = F.concat(F.lit("  "), word, F.lit(" "))
        return F.transform(
            F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3))
        )

    # Pieces depend on the word alone, so repeated words are cut once.
    return F.array_distinct(F.flatten(F.transform(F.array_distinct(words), pieces)))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams of two texts, 0 to 1."""
    left, right = trigrams(a), trigrams(b)
    shared = F.size(F.array_intersect(left, right))
    total = F.size(left) + F.size(right) - shared
    return F.when(total == 0, F.lit(0.0)).otherwise(shared / total)
