"""Article-list responses (JSON documents) to raw rows."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire import schemas as S
from tidewire.functions import text as X
from tidewire.functions.columns import compute_once


def parse_gdelt(responses: DataFrame, now: Column, value: str = "value") -> DataFrame:
    """One raw row per usable article; the headline is the only text there is."""
    kept = [c for c in responses.columns if c != value]
    parsed = F.from_json(F.col(value).cast("string"), S.GDELT_RESPONSE)
    # The outer form keeps the optimizer from parsing the document again in a filter.
    articles = responses.select(*kept, F.explode_outer(parsed["articles"]).alias("a"))
    title = X.trim_space(F.coalesce(F.col("a.title"), F.lit("")))
    url = F.coalesce(F.col("a.url"), F.lit(""))
    return (
        articles.filter("a is not null")
        .withColumn("_title", title)
        .filter((F.col("_title") != "") & (X.trim_space(url) != ""))
        .select(
            *kept,
            F.lit(S.SCHEMA_VERSION).alias("schema_version"),
            X.hash_id("gdelt", url).alias("id"),
            F.lit("gdelt").alias("source"),
            F.col("a.domain").alias("feed"),
            url.alias("url"),
            F.col("_title").alias("title"),
            F.col("_title").alias("body"),
            X.normalize_lang(F.col("a.language")).alias("language"),
            F.coalesce(X.parse_compact_date(F.col("a.seendate")), now).alias("published_at"),
            now.alias("ingested_at"),
            F.lit(None).cast("array<string>").alias("tickers"),
        )
    )


def broken_gdelt(responses: DataFrame, value: str = "value") -> DataFrame:
    """The responses that are no JSON document of the expected shape, with ``error``."""
    shape = T.StructType([*S.GDELT_RESPONSE.fields, T.StructField("_corrupt", T.StringType())])
    read = F.from_json(
        F.col(value).cast("string"), shape, {"columnNameOfCorruptRecord": "_corrupt"}
    )
    broken = read.isNull() | read["_corrupt"].isNotNull()
    judged = compute_once(responses, {"error": F.when(broken, F.lit("decode error"))})
    return judged.filter("error is not null")


def read_gdelt(spark: SparkSession, path: str, now: Column) -> DataFrame:
    """Landed responses, one JSON document per file."""
    return parse_gdelt(spark.read.text(path, wholetext=True), now)


def stream_gdelt(
    spark: SparkSession, path: str, now: Column, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.format("text").option("wholetext", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_gdelt(reader.load(path), now)
