"""Topics as streaming or batch tables.

The connector comes from the cluster (``--packages``); format and options are parameters,
so the same stages run on file and memory streams where it is absent.
"""

from pyspark.sql import DataFrame, SparkSession

RAW_TOPIC = "news.raw"
PROCESSED_TOPIC = "news.processed"


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    *,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """Columns ``key, value, partition, offset, timestamp`` of a topic."""
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic,
           "startingOffsets": starting_offsets, **options}
    )
    if streaming and max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().selectExpr(
        "cast(key as string) key", "cast(value as string) value", "partition", "offset",
        "timestamp",
    )
