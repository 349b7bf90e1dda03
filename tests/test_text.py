import re
import sys
import time
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from agora import fixed
from agora.functions import text as X


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def cleaned(spark, *values, **options):
    rows = X.clean_text(texts(spark, *values), "t", **{"tlds": fixed.COMMON_TLDS, **options}).orderBy("i").collect()
    return [r.processed_text for r in rows]


@pytest.fixture(scope="module")
def characters(spark):
    """Every character Python 3.2-era Unicode assigned, so that both Unicode tables know it."""
    known = [
        chr(c)
        for c in range(1, sys.maxunicode + 1)
        if not 0xD800 <= c <= 0xDFFF and unicodedata.ucd_3_2_0.category(chr(c)) not in ("Cn", "Co")
    ]
    return texts(spark, *known).repartition(8).persist()


def matching(characters, pattern):
    return {r.t for r in characters.where(F.col("t").rlike(pattern)).select("t").collect()}


def every(characters, test):
    return {r.t for r in characters.select("t").toLocalIterator() if test(r.t)}


def test_word_class_is_pythons(characters):
    assert matching(characters, fixed.WORD) == every(characters, lambda c: re.fullmatch(r"\w", c))


def test_space_class_is_pythons(characters):
    expected = every(characters, str.isspace)
    assert matching(characters, f"[{fixed.SPACES}]") == expected
    assert matching(characters, X._SPACE) == expected


def test_symbols_are_category_s(characters):
    left = {r.t for r in characters.where(X.strip_symbols(F.col("t")) == "").select("t").collect()}
    assert left == every(characters, lambda c: unicodedata.category(c)[0] == "S" or c in "[]")


def test_emoji_ranges(characters):
    inside = lambda c: any(first <= ord(c) <= last for first, last in fixed.EMOJI)
    gone = {r.t for r in characters.where(X.strip_emoji(F.col("t")) == "").select("t").collect()}
    assert gone == every(characters, inside)


def test_nfkc_skips_only_stable_text(characters):
    rows = characters.select("t", X.nfkc(F.col("t")).alias("n")).collect()
    assert all(r.n == unicodedata.normalize("NFKC", r.t) for r in rows)
    # No two characters below U+0300 compose, so stable characters stay stable side by side.
    stable = [chr(c) for c in range(1, 0x132) if not re.match(f"[{_python(fixed.NFKC_CHANGES)}]", chr(c))]
    joined = "".join(a + b for a in stable for b in stable)
    assert unicodedata.is_normalized("NFKC", joined)


def _python(java_class):
    return re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: re.escape(chr(int(m[1], 16))), java_class)


def test_unescape_repeats_until_stable(spark):
    got = texts(spark, "&amp;amp;lt;b&gt;", "a & b", None, "&copy; &notanentity;").select(
        X.unescape_html(F.col("t")).alias("t")
    )
    assert [r.t for r in got.collect()] == ["<b>", "a & b", None, "© ¬anentity;"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        (None, None),
        ("", ""),
        ("&amp;amp;lt;b&gt; hi", "hi"),
        ("#viral #viralvideo", "video"),
        ("#bbm_naik #umr2024", "bbm naik umr 2024"),
        ("#FYP tetap", "tetap"),
        ("a.b@c.com", "a.b@"),
        ("naik.ini", ""),
        ("yg kalo YG", "yang kalau YG"),
        ("remeh temeh", "remeh temeh"),
        ("中文 hello 한국", "hello"),
        ("a\x1cb\u00a0c\u3000d", "a b c d"),
        ("lihat https://x.y/z?q=1 dan www.situs ya", "lihat dan ya"),
        ("@warga_1 naik 5% + $3 [iklan]", "warga_1 naik 5% 3 iklan"),
        ("<p>satu</p><br>dua", "satu dua"),
        ("mudah \U0001f600 ok ❤️", "mudah ok"),
        ("\U0001d592\U0001d59a\U0001d589\U0001d586\U0001d58d ﬁ", "mudah fi"),
    ],
)
def test_clean_text_edges(spark, raw, expected):
    assert cleaned(spark, raw) == [expected]


def test_slang_values_are_squeezed(spark):
    assert cleaned(spark, "x y z", slang={"x": " a\tb ", "y": ""}) == ["a b z"]


def test_clean_text_keeps_other_columns_and_rows(spark):
    df = X.clean_text(texts(spark, "a", "b", None), "t", tlds=fixed.COMMON_TLDS)
    assert df.columns == ["i", "t", "processed_text"] and df.count() == 3


def test_empty_tld_list_is_refused():
    with pytest.raises(ValueError):
        X.url_pattern([])


def test_long_tld_lists_are_shortened_without_changing_matches():
    tlds = ["com", "co", "community", "c-x", "org", "o", "id", "x.y"]
    short = re.compile("(?:" + X._any_tld(tlds) + r")\S*")
    plain = re.compile("(?:" + "|".join(map(re.escape, tlds)) + r")\S*")
    words = [a + b for a in ["c", "co", "com", "comm", "c-", "c-x", "or", "o", "i", "id", "x.y", "xzy", ""] for b in ["", "z", "/q"]]
    assert all(bool(short.fullmatch(w)) == bool(plain.fullmatch(w)) for w in words)
    for bad in ([], [""], ["", "com"]):
        with pytest.raises(ValueError):
            X._any_tld(bad)


def test_guarded_url_pattern_matches_the_plain_one(spark):
    tlds = "|".join(fixed.COMMON_TLDS)
    plain = rf"https?://{X._NON_SPACE}+|www\.{X._NON_SPACE}+|[\p{{L}}\p{{N}}_.-]+\.(?:{tlds}){X._NON_SPACE}*"
    odd = texts(
        spark, ".com", "..com", "-.com", "a..com", "xhttp://a.b", "wwww.foo", "x.y.comz q", ".x.y", "http://", "www.",
        "é.id/x", "foo.", "...", "a.in.b", "a.co-b.com z", "x.com/a b.org,c d.e", "no links here", "://x",
    )
    rows = odd.select("t", X.strip_urls(F.col("t"), fixed.COMMON_TLDS).alias("a"), F.regexp_replace("t", plain, "").alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_tokenize_and_stopwords(spark):
    df = texts(spark, "  The cat\tand  THE dog ")
    row = df.select(
        X.tokenize(F.col("t")).alias("all"),
        X.remove_stopwords(X.tokenize(F.col("t")), ["the", " And "]).alias("kept"),
        X.remove_stopwords(X.tokenize(F.col("t")), []).alias("same"),
    ).first()
    assert row["all"] == row["same"] == ["The", "cat", "and", "THE", "dog"] and row["kept"] == ["cat", "dog"]


def test_read_word_list(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# comment\nCOM\norg\n\n")
    (tmp_path / "b.txt").write_text(" org\nNet \n")
    paths = [str(tmp_path / n) for n in ("a.txt", "b.txt")]
    assert X.read_word_list(spark, *paths) == ["com", "net", "org"]
    with pytest.raises(ValueError):
        X.read_word_list(spark, *paths, limit=2)


@pytest.mark.parametrize(
    "a, b, expected",
    [("word", "two words", 4 / 11), ("same Text", "same text", 1.0), ("", "abc", 0.0), ("", "", 0.0)],
)
def test_trigram_similarity(spark, a, b, expected):
    row = texts(spark, a).select(X.trigram_similarity(F.col("t"), F.lit(b)).alias("s")).first()
    assert row.s == pytest.approx(expected)


def test_nfkc_batches_are_bounded(spark):
    """A Python worker gets at most a thousand texts at once, whatever the session was set to before the query."""
    from agora.session import pin

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    pin(spark)
    sizes = F.arrow_udf(lambda texts: pa.array([len(texts)] * len(texts), pa.int32()), "int")
    rows = spark.range(0, 5000, 1, 1).select(X.nfkc(F.concat(F.lit("\ufb01"), F.col("id"))).alias("t"), sizes(F.col("id")).alias("n"))
    found = rows.agg(F.max("n"), F.count_if(F.col("t").startswith("fi"))).first()
    assert found[0] <= 1024 and found[1] == 5000


def test_expand_hashtags_costs_no_scan_of_the_text_per_tag(spark):
    """20,000 tags in a long text are replaced in their runs; before, each meant a pass over the whole text (minutes)."""
    text = "plain words and #Viral #viralvideo ##new_Tag1 " * 20_000
    df = spark.createDataFrame([(text,), ("#abcx #viral #abcx #abc#viralx ##abcx",)], "t string")
    started = time.monotonic()
    long, odd = [r.t for r in df.select(X.expand_hashtags(F.col("t")).alias("t")).collect()]
    assert time.monotonic() - started < 30
    assert long == "plain words and   #new Tag 1 " * 20_000
    assert odd == "abcx  abcx abcx abcx"
