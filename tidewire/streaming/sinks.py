"""Where streams end: topics, tables, JSON lines, and idempotent multi-table batches.

Output is committed before offsets: file tables are exactly-once, topics at-least-once.
Batch writers replace the folder of their batch, or skip a batch that they have committed.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewire import schemas as S
from tidewire.operators import scoring
from tidewire.streaming.committed import CommittedTables, writer

BatchWriter = Callable[[DataFrame, int], None]


def _writer(
    stream: DataFrame, checkpoint: str, every: str | None, name: str | None = None
) -> DataStreamWriter:
    """``every`` is a trigger interval; None drains what is there and stops."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if name:
        writer = writer.queryName(name)
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def to_topic(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, every: str | None = "1 second"
) -> StreamingQuery:
    """Keyed messages to a topic; the key keeps an item on one partition."""
    writer = (
        _writer(messages, checkpoint, every).format("kafka")
        .option("kafka.bootstrap.servers", servers).option("kafka.acks", "all")
        .option("topic", topic)
    )
    return writer.start()


def to_table(
    rows: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds"
) -> StreamingQuery:
    writer = _writer(rows, checkpoint, every).format("parquet").option("path", path)
    return writer.start()


def to_json_lines(
    scored: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds"
) -> StreamingQuery:
    lines = scoring.result_json(scored)
    writer = _writer(lines, checkpoint, every).format("text").option("path", path)
    return writer.start()


def to_memory(rows: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """What is there now, collected into the in-memory table ``name``: for tests only."""
    return _writer(rows, checkpoint, None, name).format("memory").start()


def to_batches(
    rows: DataFrame, write: BatchWriter, checkpoint: str, every: str | None = "10 seconds"
) -> StreamingQuery:
    """Any callable of (batch frame, batch id) as a sink."""
    return _writer(rows, checkpoint, every).foreachBatch(write).start()


def write_batches(path: str, run: str, make: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    """Writer of ``make(batch)`` into ``path/run=<run>/batch_id=<id>``.

    A repeated batch replaces its own folder. ``run`` names one checkpoint: give a new
    checkpoint, whose batches count from 0 again, a new name, and no history is overwritten.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = make(batch) if make else batch
        rows.write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")

    return write


def scored_tables(base: str, run: str, *extra: T.StructField) -> CommittedTables:
    """Tables ``results`` and ``entities``, cut by the day of inference."""
    day = T.StructField("day", T.DateType())
    return CommittedTables(base, {
        "results": (T.StructType([*S.SCORED, *extra, day]), ("day",)),
        "entities": (T.StructType([*S.ENTITY, *extra, day]), ("day",)),
    }, run)


def write_scored(
    base: str, run: str, *extra: T.StructField, compact_every: int | None = 32
) -> BatchWriter:
    """Writer of scored items into the committed tables of ``scored_tables``.

    The batch is scored once for both tables, which come into force together; a repeated batch
    changes nothing. Every ``compact_every`` batches their small files become one per day.
    ``run`` names one checkpoint.
    """
    names = [f.name for f in extra]

    def make(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        tables = {
            "results": scoring.sentiment_results(batch, *names),
            "entities": scoring.entity_sentiments(batch, *names),
        }
        return {n: rows.withColumn("day", F.to_date("inferred_at")) for n, rows in tables.items()}

    return writer(scored_tables(base, run, *extra), make, compact_every)
