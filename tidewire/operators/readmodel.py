"""Read layer over the result and shock tables: recent rows, mixes, timeline, KPIs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECENT_RESULTS = [
    "item_id", "source", "sentiment_label", "sentiment_score", "prob_positive",
    "prob_negative", "prob_neutral", "model_name", "quantized", "published_at", "inferred_at",
]
RECENT_SHOCKS = [
    "entity", "item_id", "zscore", "velocity", "mean_velocity", "std_velocity",
    "sentiment_score", "window_seconds", "threshold", "triggered_at",
]
LABEL_ORDER = ("positive", "neutral", "negative")
TIMELINE_RULES = ("30 seconds", "1 minute", "5 minutes", "15 minutes")
_DAY = 86_400_000_000


def recent_results(results: DataFrame, limit: int = 2000) -> DataFrame:
    """Newest results first; the item id breaks ties."""
    return results.select(*RECENT_RESULTS).orderBy(F.desc("inferred_at"), "item_id").limit(limit)


def recent_shocks(shocks: DataFrame, limit: int = 200) -> DataFrame:
    return (
        shocks.select(*RECENT_SHOCKS)
        .orderBy(F.desc("triggered_at"), "entity", "item_id")
        .limit(limit)
    )


def display_items(recent: DataFrame, rows: int = 100) -> DataFrame:
    """The item list as shown."""
    return (
        recent.orderBy(F.desc("inferred_at"), "item_id")
        .limit(rows)
        .select("inferred_at", "source", "sentiment_label",
                F.round("sentiment_score", 3).alias("sentiment_score"), "item_id")
    )


def display_shocks(recent: DataFrame) -> DataFrame:
    """The shock list as shown."""
    return recent.select(
        "triggered_at", "entity", F.round("zscore", 2).alias("zscore"),
        F.round("velocity", 3).alias("velocity"),
        F.round("sentiment_score", 3).alias("sentiment_score"), "item_id",
    )


def _distribution(rows: DataFrame, column: str, name: str) -> DataFrame:
    return (
        rows.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(name))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def label_distribution(results: DataFrame) -> DataFrame:
    """Items per label: the known labels in fixed order, then others by count."""
    rank = F.array_position(F.array(*[F.lit(v) for v in LABEL_ORDER]), F.col("label"))
    known = F.when(rank > 0, rank).otherwise(len(LABEL_ORDER) + 1)
    counts = _distribution(results, "sentiment_label", "label")
    return counts.orderBy(known, F.desc("count"), "label")


def source_distribution(results: DataFrame) -> DataFrame:
    return _distribution(results, "source", "source").orderBy(F.desc("count"), "source")


def global_stats(results: DataFrame, shocks: DataFrame) -> DataFrame:
    """One row over the whole tables: total_scored, total_shocks, avg_sentiment."""
    rows = results.select(
        F.lit(1).alias("scored"), F.lit(0).alias("shock"), "sentiment_score"
    ).unionAll(
        shocks.select(F.lit(0), F.lit(1), F.lit(None).cast("double"))
    )
    return rows.agg(
        F.coalesce(F.sum("scored"), F.lit(0)).alias("total_scored"),
        F.coalesce(F.sum("shock"), F.lit(0)).alias("total_shocks"),
        F.coalesce(F.avg("sentiment_score"), F.lit(0.0)).alias("avg_sentiment"),
    )


def kpis(results: DataFrame, shocks: DataFrame, now: Column) -> DataFrame:
    """Headline numbers of the whole tables, one row, one scan of each.

    The model is that of the first row of ``recent_results``: the newest, of equal times the
    one with the smallest item id. Pass whole tables, not recent windows: a busy five minutes
    may hold more rows than a window.
    """
    fresh = F.col("inferred_at") >= now - F.expr("interval 5 minutes")
    newest_first = F.when(
        F.col("inferred_at").isNotNull(), F.struct(-F.unix_micros("inferred_at"), F.col("item_id"))
    )
    scored = results.agg(
        F.count(F.lit(1)).alias("total_scored"),
        F.coalesce(F.sum(F.when(fresh, 1)), F.lit(0)).alias("scored_last_5m"),
        F.coalesce(F.avg("sentiment_score"), F.lit(0.0)).alias("avg_sentiment"),
        F.min_by(F.struct("model_name", "quantized"), newest_first).alias("newest"),
    )
    flagged = shocks.agg(F.count(F.lit(1)).alias("shocks_flagged"))
    # Two one-row frames become one row.
    return scored.unionByName(flagged, allowMissingColumns=True).agg(
        F.max("total_scored").alias("total_scored"),
        F.max("scored_last_5m").alias("scored_last_5m"),
        F.max("shocks_flagged").alias("shocks_flagged"),
        F.max("avg_sentiment").alias("avg_sentiment"),
        F.coalesce(F.max("newest.model_name"), F.lit("-")).alias("model_name"),
        F.coalesce(F.max("newest.quantized"), F.lit(False)).alias("quantized"),
    )


def sentiment_timeline(results: DataFrame, rule: str = "1 minute") -> DataFrame:
    """Average score and volume per time bucket, empty buckets in between included.

    ``rule`` is a bucket width that divides a day.
    """
    buckets = (
        results.filter("inferred_at is not null")
        .groupBy(F.window("inferred_at", rule)["start"].alias("bucket"))
        .agg(F.avg("sentiment_score").alias("avg_sentiment"),
             F.count("sentiment_score").alias("volume"))
    )
    # from the aggregate, whose shuffle is reused: no second scan for the bounds
    bounds = buckets.agg(F.min("bucket").alias("_lo"), F.max("bucket").alias("_hi")).filter(
        "_lo is not null"
    )
    step = F.expr(f"interval {rule}")
    us = F.unix_micros(F.timestamp_seconds(F.lit(0)) + step)
    # Two levels, days then buckets, so that no array grows with the covered time span.
    days = bounds.select(
        "_lo", "_hi",
        F.explode(
            F.sequence(F.floor(F.unix_micros("_lo") / _DAY), F.floor(F.unix_micros("_hi") / _DAY))
        ).alias("_day"),
    )
    spine = (
        days.withColumn(
            "_us",
            F.explode(
                F.sequence(F.col("_day") * _DAY, (F.col("_day") + 1) * _DAY - us, us)
            ),
        )
        .filter(
            (F.col("_us") >= F.unix_micros("_lo")) & (F.col("_us") <= F.unix_micros("_hi"))
        )
        .select(F.timestamp_micros("_us").alias("bucket"))
    )
    return spine.join(buckets, "bucket", "left").select(
        "bucket",
        F.coalesce("avg_sentiment", F.lit(0.0)).alias("avg_sentiment"),
        F.coalesce("volume", F.lit(0)).alias("volume"),
    )
