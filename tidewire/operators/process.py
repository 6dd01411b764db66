"""Process stage: normalize, filter, deduplicate, and account for every row."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire import schemas as S
from tidewire.functions import text as X
from tidewire.functions.columns import compute_once
from tidewire.operators.contract import raw_error

OUTCOMES = ("emit", "duplicate", "filtered", "error")


@dataclass(frozen=True)
class Relevance:
    """Which normalized items are worth scoring; 0 and '' switch a check off."""

    min_body_length: int = 20
    language: str = "en"


def filter_reason(title: Column, body: Column, language: Column, rule: Relevance) -> Column:
    """Why an item is dropped, NULL when it is kept. An unset language is kept."""
    reason = F.when((title == "") & (body == ""), F.lit("empty"))
    if rule.min_body_length > 0:
        reason = reason.when(F.length(body) < rule.min_body_length, F.lit("too_short"))
    if rule.language:
        set_language = F.coalesce(language, F.lit(""))
        reason = reason.when(
            (set_language != "") & (set_language != rule.language), F.lit("language")
        )
    return reason


def evaluate(raw: DataFrame, rule: Relevance = Relevance()) -> DataFrame:
    """Raw rows plus ``error``, ``reason``, normalized ``title``/``body``, ``content_hash``.

    Row by row and free of shuffles, so it serves batch and stream alike. An ``error``
    column from decoding is kept; otherwise the contract is checked here.
    """
    error = F.col("error") if "error" in raw.columns else raw_error()
    checked = raw.withColumn("error", error)
    normalized = compute_once(
        checked,
        {
            "title": X.normalize_text(F.col("title")),
            "body": X.normalize_text(F.col("body")),
        },
    )
    return (
        normalized.withColumn(
            "reason",
            F.when(
                F.col("error").isNull(),
                filter_reason(F.col("title"), F.col("body"), F.col("language"), rule),
            ),
        )
        .withColumn(
            "content_hash",
            F.when(
                F.col("error").isNull() & F.col("reason").isNull(),
                X.content_hash(F.col("title"), F.col("body")),
            ),
        )
    )


def first_arrivals(rows: DataFrame, key: str, seq: str = "arrival_seq") -> DataFrame:
    """``seq`` of the first row of each key.

    A plain ``min`` per key: partial aggregation leaves one row per key and task before the
    shuffle, so a key that holds a third of all rows costs no more than any other.
    """
    return (
        rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(seq).alias(seq)).select(seq)
    )


def dedup_first(rows: DataFrame, key: str = "content_hash", seq: str = "arrival_seq") -> DataFrame:
    """Keep the first arrival of each key; rows without a key are left out.

    One pass: the earliest row travels through partial aggregation, so copies meet inside
    the map tasks and a hot key sends one row per task.
    """
    first = F.min_by(F.struct(*[F.col(c) for c in rows.columns]), F.col(seq))
    kept = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(first.alias("_first"))
    return kept.select("_first.*")


def decide(raw: DataFrame, rule: Relevance = Relevance(), seq: str = "arrival_seq") -> DataFrame:
    """Every row with its ``decision`` (emit, duplicate, filtered, error) and ``reason``."""
    rows = evaluate(raw, rule)
    winners = first_arrivals(rows, "content_hash", seq).withColumn("_first", F.lit(True))
    decision = (
        F.when(F.col("error").isNotNull(), F.lit("error"))
        .when(F.col("reason").isNotNull(), F.lit("filtered"))
        .when(F.col("_first"), F.lit("emit"))
        .otherwise(F.lit("duplicate"))
    )
    return rows.join(winners, seq, "left").withColumn("decision", decision).drop("_first")


def to_processed(rows: DataFrame, now: Column, *extra: str) -> DataFrame:
    """Evaluated survivors to processed rows; ``extra`` columns are carried along."""
    return rows.withColumn("schema_version", F.lit(S.SCHEMA_VERSION)).withColumn(
        "processed_at", now
    ).select(*[f.name for f in S.PROCESSED], *extra)


def relevant_language(language: Column, rule: Relevance) -> Column:
    """Whether the language alone lets an item through; simple enough to reach the scan."""
    if not rule.language:
        return F.lit(True)
    return language.isNull() | language.isin("", rule.language)


def process_news(
    raw: DataFrame, now: Column, rule: Relevance = Relevance(), seq: str = "arrival_seq"
) -> DataFrame:
    """Clean, relevant, first-seen items.

    Rows that cannot survive whatever their text says are dropped before it is normalized.
    """
    candidates = raw.filter(relevant_language(F.col("language"), rule))
    survivors = evaluate(candidates, rule).filter("error is null and reason is null")
    return to_processed(dedup_first(survivors, "content_hash", seq), now, seq)


def process_stats(raw: DataFrame, rule: Relevance = Relevance()) -> DataFrame:
    """One row: consumed, processed, duplicates, filtered, errors.

    Counting per content hash gives the duplicates without joining anything back.
    """
    outcome = (
        F.when(F.col("error").isNotNull(), F.lit("error"))
        .when(F.col("reason").isNotNull(), F.lit("filtered"))
        .otherwise(F.lit("kept"))
    )
    counts = (
        evaluate(raw, rule)
        .groupBy(outcome.alias("outcome"), "content_hash")
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def total(name: str, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("outcome") == name, value)), F.lit(0))

    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("consumed"),
        total("kept", F.lit(1)).alias("processed"),
        total("kept", F.col("n") - 1).alias("duplicates"),
        total("filtered", F.col("n")).alias("filtered"),
        total("error", F.col("n")).alias("errors"),
    )


def drops_by_reason(raw: DataFrame, rule: Relevance = Relevance()) -> DataFrame:
    return (
        evaluate(raw, rule)
        .filter("reason is not null")
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("dropped"))
    )


def drop_seen(
    poll: DataFrame, history: DataFrame, key: str, seq: str = "arrival_seq"
) -> DataFrame:
    """Items of a poll whose key appears neither in ``history`` nor earlier in the poll.

    Both sides are reduced to one row per key by partial aggregation before they meet.
    """
    fresh = dedup_first(poll, key, seq).join(history.select(key).distinct(), key, "left_anti")
    return fresh.select(*poll.columns)
