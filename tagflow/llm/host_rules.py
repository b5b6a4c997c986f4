"""Quality rules with host verdicts, in DataFrame functions alone.

Each document is measured and held against rules; failures are counted by host, the failure
rates are shrunk with a beta prior whose two parameters come from all hosts' rates, and
each host's verdict goes back to its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.llm.shared import written

BLANKS = " \t\n\u000b\f\r"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


def words(text: Column) -> Column:
    """Runs of characters other than space and \\t to \\r, in order."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+"))


def _let(value: Column, use) -> Column:
    """use(value) with value computed once a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(w: Column) -> Column:
    """Words that lie in a window of five words found twice or more in the text.

    Windows are compared by 64-bit hashes; only texts with some equal windows are sorted.
    """
    hashes = F.transform(
        F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
        lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(WINDOW)]))

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeats(s: Column) -> Column:
            twice = F.filter(
                s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
            places = F.sort_array(F.transform(twice, lambda x: x["i"]))
            start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("total"))
            return F.aggregate(
                places, start, lambda acc, i: F.struct(i.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("total")),
                lambda acc: acc["total"])

        return _let(placed, repeats)

    return F.when(
        F.size(w) > WINDOW, _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))
    ).otherwise(F.lit(0).cast("long"))


@dataclass(frozen=True)
class Rules:
    """A document fails if any of these holds; the first two are the base rules."""

    least_words: int = 10
    repeat_percent: int = 20  # repeated words of all words
    symbol_percent: int = 30  # symbols of words
    dup_line_percent: int = 30  # repeated lines of lines with a word
    word_chars: tuple[float, float] = (2.0, 15.0)  # mean length of words


def measure(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, host (source), the counts, base_failed and failed (any rule)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", F.col("source").alias("host"), text.alias("t"), words(text).alias("w"),
                        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias("lines"))
    counted = split.select(
        "doc_id", "host", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).cast("long").alias("n_repeat_words"))
    base = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    soft = (
        (100 * F.col("n_symbols") > rules.symbol_percent * F.col("n_words"))
        | (100 * F.col("n_dup_lines") > rules.dup_line_percent * F.col("n_lines"))
        | (F.col("word_chars") < rules.word_chars[0] * F.col("n_words"))
        | (F.col("word_chars") > rules.word_chars[1] * F.col("n_words")))
    return counted.withColumn("base_failed", base).withColumn("failed", base | soft)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Parameters (a, b) of the prior from hosts(n, failures), by moments of the failure rates.

    Mean: failures of all documents. Strength a + b: what makes the rates' variance, beyond
    the binomial part, agree; between 1 (rates spread over everything) and 1e6 (hosts
    that differ by chance alone, or one host). Without failures, or all failing: (0.5, 0.5).
    """
    n, failures, n_hosts, squares = hosts.agg(
        F.sum("n").cast("double"), F.sum("failures").cast("double"), F.count("*"), F.sum(F.col("n").cast("double") ** 2)).first()
    if not n or failures in (0.0, n):
        return 0.5, 0.5
    mean = failures / n
    spread = hosts.agg(F.sum(F.col("n") * (F.col("failures") / F.col("n") - mean) ** 2)).first()[0]
    free = n - squares / n
    between = (spread - (n_hosts - 1) * mean * (1 - mean)) / free if free > 0 else 0.0
    strength = min(1e6, max(1.0, mean * (1 - mean) / between - 1)) if between > 0 else 1e6
    return mean * strength, (1 - mean) * strength


def host_verdicts(measured: DataFrame, most_failing: float = 0.5) -> DataFrame:
    """host, n, failures, host_rate (posterior mean), host_kept (host_rate at most most_failing)."""
    hosts = written(measured.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("failures")), "hosts")
    a, b = beta_prior(hosts)
    rate = (F.col("failures") + F.lit(a)) / (F.col("n") + F.lit(a + b))
    return hosts.withColumn("host_rate", rate).withColumn("host_kept", rate <= most_failing)


def judge(docs: DataFrame, rules: Rules = Rules(), most_failing: float = 0.5) -> DataFrame:
    """One row per row of docs(doc_id, text, source) with counts, base_failed, host_rate and kept.

    kept: not base_failed, and the host's shrunk failure rate is at most most_failing. A null
    text has no words and fails; documents with a null source share one host. Repeated
    rows count as often as they occur. Other columns are ignored.
    """
    measured = written(measure(docs, rules), "measured")
    verdicts = host_verdicts(measured, most_failing).select(F.col("host").alias("host_of"), "host_rate", "host_kept")
    return measured.join(verdicts, F.col("host").eqNullSafe(F.col("host_of"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("host_kept")).alias("kept"), "failed", "host_rate")
