"""Quality rules judged by host: rule failures per domain, shrunk by an empirical beta prior."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.columns import compute_once
from tidewire.llm.common import WORD_CLASS, settle, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts"
)


@dataclass(frozen=True)
class Limits:
    """Documented limits; a rule counts once at its limit and twice at twice the limit.

    ``watched`` and ``rejected`` are failure rates of a host after shrinkage. A document of a
    trusted host goes at two points, of a watched host at one, of a rejected host always. The
    prior weighs as much as ``prior_docs`` documents at least, so that no host is judged by one.
    """

    min_words: int = 20
    repeat_percent: int = 30
    symbols_per_word: float = 0.1
    shouts_per_word: float = 0.2
    dup_line_share: float = 0.3
    soft_repeat_share: float = 0.2
    word_length: tuple[float, float] = (2.0, 12.0)
    watched: float = 0.5
    rejected: float = 0.8
    prior_docs: float = 10.0


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more, from the hashes of all windows in order.

    Only texts with a repeated window sort: by (hash, place), so that equal windows meet; the
    places are put in order again, and each adds the words up to the next one's start.
    """
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(sorted_pairs: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            before = F.get(sorted_pairs, i - 1)["h"] == x["h"]
            after = F.get(sorted_pairs, i + 1)["h"] == x["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.sort_array(F.transform(F.filter(sorted_pairs, twin), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        steps = F.transform(
            at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    # a one-element array binds the sorted pairs, then the places, to a name
    at = F.transform(F.array(pairs), places)
    return F.element_at(F.transform(at, covered), 1)


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of ``COUNTS`` as long columns. A null text has no words."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD_CLASS))
    rows = compute_once(docs, {"tw_words": words(F.col(text)), "tw_lines": lines})
    n = F.size("tw_words")
    windows = F.when(
        n > WINDOW,
        F.transform(F.sequence(F.lit(1), n - WINDOW + 1),
                    lambda i: F.xxhash64(F.slice("tw_words", i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = compute_once(rows, {"tw_windows": windows})
    repeated = F.size(F.array_distinct("tw_windows")) < F.size("tw_windows")
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join("tw_words", "")),
        "n_symbols": F.length(whole) - F.length(F.translate(whole, SYMBOLS, "")),
        "n_dup_lines": F.size("tw_lines") - F.size(F.array_distinct("tw_lines")),
        "n_repeat_words": F.when(repeated, _repeat_words(F.col("tw_windows"))).otherwise(0),
        "n_lines": F.size("tw_lines"),
        "n_shouts": F.regexp_count(whole, F.lit(r"\p{Lu}{2}")),
    }
    kept = [c for c in docs.columns if c not in COUNTS]
    return rows.select(*kept, *[c.cast("long").alias(name) for name, c in counts.items()])


def _points(limits: Limits) -> Column:
    n = F.greatest(F.col("n_words"), F.lit(1))
    low, high = limits.word_length
    length = F.col("word_chars") / n

    def rule(value: Column, limit: float) -> Column:
        return F.when(value > 2 * limit, 2).when(value > limit, 1).otherwise(0)

    return (
        rule(F.col("n_symbols") / n, limits.symbols_per_word)
        + rule(F.col("n_shouts") / n, limits.shouts_per_word)
        + rule(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), limits.dup_line_share)
        + rule(F.col("n_repeat_words") / n, limits.soft_repeat_share)
        + F.when((length < low) | (length > high), 1).otherwise(0)
    )


def host_verdicts(judged: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``host, host_docs, host_rate, host_verdict`` from rows of ``host, failed``.

    The prior of the failure rate is a beta distribution fitted by moments to all hosts, each
    weighted by its documents: mean m and precision k = m (1 - m) / v - 1 for the variance v
    between hosts beyond what drawing documents explains. A host's rate is
    (failures + k m) / (documents + k), so a small host stays near the mean.
    """
    hosts = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("failed").cast("long")).alias("fails")
    )
    rate = F.col("fails") / F.col("host_docs")
    m, square, docs, groups = hosts.agg(
        F.sum("fails") / F.sum("host_docs"),
        F.sum(F.col("host_docs") * rate * rate) / F.sum("host_docs"),
        F.sum("host_docs"), F.count(F.lit(1)),
    ).first()
    mean = m or 0.0
    drawn = mean * (1 - mean)
    between = max((square or 0.0) - mean * mean - drawn * groups / max(docs or 1, 1), 0.0)
    # no spread between hosts: a strong prior of as many documents as an average host has
    precision = drawn / between - 1 if between > 0 else (docs or 0) / max(groups, 1)
    precision = max(precision, limits.prior_docs)
    shrunk = (F.col("fails") + precision * mean) / (F.col("host_docs") + precision)
    verdict = (
        F.when(F.col("host_rate") > limits.rejected, "rejected")
        .when(F.col("host_rate") > limits.watched, "watched").otherwise("trusted")
    )
    return hosts.select("host", "host_docs", shrunk.alias("host_rate")).withColumn(
        "host_verdict", verdict
    )


def judge(
    docs: DataFrame, limits: Limits = Limits(), *, key: str = "doc_id", text: str = "text",
    host: str = "source",
) -> DataFrame:
    """One row per document: id, counts, ``base_failed``, ``points``, host verdict, ``kept``.

    Base rules: fewer words than ``min_words``, or more than ``repeat_percent`` of the words
    in repeated windows of eight. Further rules give points (see ``Limits``). A document is a
    failure of its host if it fails the base rules or has two points; the host's shrunk
    failure rate decides how many points its documents may have.

    Null and empty texts have zero counts and fail the base rules. A null host is a host of
    its own. Repeated rows are judged each; an empty table gives no row. Hosts are aggregated
    before the shuffle, and only counts, never texts, are joined to the verdicts.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(host).alias("host"),
                       F.col(text).alias("text"))
    n = F.col("n_words")
    base = (n < limits.min_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * n)
    counted = settle(
        text_counts(rows).drop("text")
        .withColumns({"base_failed": base, "points": _points(limits).cast("int")})
    )
    verdicts = host_verdicts(
        counted.select("host", (F.col("base_failed") | (F.col("points") >= 2)).alias("failed")),
        limits,
    ).withColumnRenamed("host", "v_host")
    allowed = (
        F.when(F.col("host_verdict") == "trusted", 1)
        .when(F.col("host_verdict") == "watched", 0).otherwise(-1)
    )
    return counted.join(verdicts, F.col("host").eqNullSafe(F.col("v_host"))).select(
        "doc_id", *COUNTS, "base_failed", "points", "host_rate", "host_verdict",
        (~F.col("base_failed") & (F.col("points") <= allowed)).alias("kept"),
    )
