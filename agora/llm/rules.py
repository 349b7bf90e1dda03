"""Quality rules per text, and host verdicts shrunk towards the corpus rate. DataFrame functions only.

Words are runs of characters other than blank and the ASCII controls 9 to 13.
Per text: the words and their characters, symbols, lines that repeat an earlier
line, and words inside three-word windows that occur twice or more.

A text fails the base rules with fewer than ``least_words`` words or with more
than half of its words in repeated windows. Failures are summed by host, and a
beta prior is fitted to the hosts' rates by their mean and variance (method of
moments). A host's rate is the mean of its posterior: few texts say little, so
small hosts stay near the corpus rate. Texts of hosts above ``host_rate`` go.

Null texts have no words and fail; a null host has no verdict, so only the
base rules count there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.shared import stored

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
REPEATED_PERCENT = 50
HOST_RATE = 0.5
# The prior weighs as much as this many texts when hosts hardly differ.
HEAVIEST_PRIOR = 1000.0


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def _repeated(df: DataFrame) -> DataFrame:
    """Add n_repeat_words: positions inside a window whose three words occur twice or more."""
    n = F.greatest(F.col("n_words") - 2, F.lit(0)).cast("int")
    windows = F.arrays_zip(F.slice("_words", F.lit(1), n), F.slice("_words", F.lit(2), n), F.slice("_words", F.lit(3), n))
    joined = F.transform(windows, lambda w, i: F.struct(F.concat_ws(" ", w["0"], w["1"], w["2"]).alias("w"), i.alias("i")))
    # Sorted, equal windows are neighbours; each such pair names the starts of both.
    df = df.withColumn("_sorted", F.array_sort(joined))
    left = F.slice("_sorted", F.lit(1), F.greatest(n - 1, F.lit(0)))
    right = F.slice("_sorted", F.lit(2), F.greatest(n - 1, F.lit(0)))
    pairs = F.zip_with(left, right, lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    starts = F.array_distinct(F.flatten(pairs))
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2))))
    return df.withColumn("n_repeat_words", F.size(covered).cast("long"))


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
            least_words: int = LEAST_WORDS, repeated_percent: int = REPEATED_PERCENT) -> DataFrame:
    """Per row: key, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(host).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD))
    rows = rows.withColumn("_words", _words(F.col("_text"))).withColumn("_lines", lines)
    rows = rows.select(
        "doc_id",
        "host",
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    few = F.col("n_words") < least_words
    much = F.col("n_repeat_words") * 100 > F.col("n_words") * repeated_percent
    return _repeated(rows).withColumn("base_failed", few | much).drop("_words", "_sorted")


def host_verdicts(measured: DataFrame, host_rate: float = HOST_RATE) -> DataFrame:
    """Per host: texts, failed, rate (posterior mean) and host_failed."""
    known = measured.where(F.col("host").isNotNull())
    hosts = known.groupBy("host").agg(F.count(F.lit(1)).alias("texts"), F.count_if("base_failed").alias("failed"))
    raw = F.col("failed") / F.col("texts")
    prior = hosts.agg(
        (F.sum("failed") / F.sum("texts")).alias("_mean"),
        F.var_pop(raw).alias("_var"),
        F.avg(1 / F.col("texts")).alias("_noise"),
    )
    # Spread of the hosts' true rates: what is left after the sampling noise of a rate.
    spread = F.col("_mean") * (1 - F.col("_mean"))
    between = F.col("_var") - spread * F.col("_noise")
    weight = F.when(between > 0, F.greatest(F.lit(0.0), F.least(F.lit(HEAVIEST_PRIOR), spread / between - 1)))
    prior = prior.select("_mean", F.coalesce(weight, F.lit(HEAVIEST_PRIOR)).alias("_weight"))
    # One row, so its values are scalars of the plan rather than a join.
    mean, strength = prior.select("_mean").scalar(), prior.select("_weight").scalar()
    rate = (F.col("failed") + mean * strength) / (F.col("texts") + strength)
    return hosts.withColumn("rate", rate).withColumn("host_failed", F.col("rate") > host_rate)


def judge(measured: DataFrame, host_rate: float = HOST_RATE) -> DataFrame:
    """``measured`` with ``kept``: base rules met, and the host not refused."""
    verdicts = host_verdicts(measured, host_rate).where("host_failed").select("host", F.lit(True).alias("_refused"))
    out = measured.join(verdicts, "host", "left")
    return out.withColumn("kept", ~F.col("base_failed") & F.col("_refused").isNull()).drop("_refused")


def host_quality(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """All measures, base_failed and kept of every row. Measured once: the table is stored before hosts are summed."""
    return judge(stored(measure(docs, key, text, host), "measured"))
