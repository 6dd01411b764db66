"""The given tables seen as news, entity samples, results and metric samples."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewire.session import use_utc

# Fixed parameters of the bindings; the invented prose holds no finance words.
POSITIVE = ("the", "and", "is", "it", "for", "with", "be")
NEGATIVE = ("of", "to", "a", "in", "that", "was", "on")
GAZETTEER = {
    "THAT": "that it",
    "WAS": "for the",
    "VON": "und der",
    "EST": "de la",
    "POR": "en el",
    "AS": "erentis",
}
NOW = "2024-01-30 23:59:00"
WINDOW_SECONDS = 86_400
THRESHOLD = 2.5


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    reader = use_utc(spark).read
    if path not in _SCHEMAS:
        _SCHEMAS[path] = reader.parquet(path).schema
    return reader.schema(_SCHEMAS[path]).parquet(path)


# Session setting: number of partitions that texts are dealt to before costly work. Unset, the
# sizes of splits decide, which is right for tables of many files or row groups. Set it for a
# few files of one row group each, which one task each would read.
TEXT_PARTITIONS = "spark.tidewire.text.partitions"


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with costly text work ahead, as read or dealt out as ``TEXT_PARTITIONS`` says."""
    rows = table(spark, sf_dir, name)
    partitions = int(spark.conf.get(TEXT_PARTITIONS, "0"))
    return rows.repartition(partitions) if partitions else rows


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def _minutes_in(column: str) -> Column:
    return F.timestamp_seconds(F.lit(1704067200) + F.col(column) * 60)


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_news(texts(spark, sf_dir, "documents"))


def as_news(documents: DataFrame) -> DataFrame:
    """Documents as raw news; the first line is the title, the whole text the body."""
    return documents.select(
        F.lit("1.0.0").alias("schema_version"),
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("id"),
        F.lit("replay").alias("source"),
        F.col("source").alias("feed"),
        F.lit(None).cast("string").alias("url"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("body"),
        F.col("lang").alias("language"),
        _minutes_in("doc_id").alias("published_at"),
        (_minutes_in("doc_id") + F.expr("interval 1 second")).alias("ingested_at"),
        F.lit(None).cast("array<string>").alias("tickers"),
        F.col("doc_id").alias("arrival_seq"),
    )


def flawed_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News in which half of the rows break one contract rule or two."""
    case = F.col("arrival_seq") % 16

    def spoiled(column: str, cases: list[int], value: Column) -> Column:
        return F.when(case.isin(cases), value).otherwise(F.col(column))

    return news(spark, sf_dir).withColumns(
        {
            "schema_version": spoiled("schema_version", [1], F.lit("0.9.0")),
            "id": spoiled("id", [2], F.lit("")),
            "source": spoiled("source", [3, 8], F.lit("blog")),
            "title": spoiled("title", [4, 8], F.lit("")),
            "body": spoiled("body", [5], F.lit("")),
            "published_at": spoiled("published_at", [6], F.lit(None).cast("timestamp")),
            "ingested_at": spoiled(
                "ingested_at", [7], F.lit("0001-01-01 00:00:00").cast("timestamp")
            ),
        }
    )


def entity_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_entity_samples(table(spark, sf_dir, "events"))


def as_entity_samples(events: DataFrame) -> DataFrame:
    """Events as a sentiment series per event type."""
    return events.select(
        F.concat(F.lit("ev-"), F.col("event_id")).alias("item_id"),
        F.col("event_type").alias("entity"),
        F.col("value").alias("sentiment_score"),
        F.col("ts").cast("timestamp").alias("inferred_at"),
        F.col("event_id").alias("arrival_seq"),
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_results(table(spark, sf_dir, "events"))


def as_results(events: DataFrame) -> DataFrame:
    """Events as scored items."""
    kind = F.col("event_type")
    label = (
        F.when(kind == "signup", F.lit("positive"))
        .when(kind == "error", F.lit("negative"))
        .when(kind == "view", F.lit("neutral"))
        .when(kind == "click", F.lit(None))
        .otherwise(kind)
    )
    source = (
        F.when(F.col("user_id") % 3 == 0, F.lit("replay"))
        .when(F.col("user_id") % 3 == 1, F.lit("gdelt"))
        .when(F.col("event_id") % 2 == 0, F.lit("rss"))
    )
    ts = F.col("ts").cast("timestamp")
    even = F.col("event_id") % 2 == 0
    return events.select(
        F.concat(F.lit("ev-"), F.col("event_id")).alias("item_id"),
        F.concat(F.lit("sha256:"), F.sha2("props", 256)).alias("content_hash"),
        source.alias("source"),
        label.alias("sentiment_label"),
        F.col("value").alias("sentiment_score"),
        (F.col("value") / 1000).alias("prob_positive"),
        (F.col("value") / 2000).alias("prob_negative"),
        (1 - F.col("value") / 1000).alias("prob_neutral"),
        F.when(even, F.lit("lexicon")).otherwise(F.lit("onnx")).alias("model_name"),
        (~even).alias("quantized"),
        (ts - F.expr("interval 1 hour")).alias("published_at"),
        ts.alias("inferred_at"),
    )


def latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as timed model calls."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("variant"),
        F.col("value").alias("millis"),
        (F.col("value") / 100).alias("seconds"),
        (F.col("user_id") % 16 + 1).alias("items"),
    )


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as samples of one rising counter per type, reset every thousand."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("stage-"), F.col("user_id") % 3).alias("stage"),
        F.lit("processed").alias("metric"),
        # most counters have no label; here those of the views have none
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("label"),
        (F.col("event_id") % 1000).cast("double").alias("value"),
        F.col("event_id").alias("seq"),
    )
