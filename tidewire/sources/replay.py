"""Replay: JSON lines to raw rows, as a table or as a rate-limited stream."""

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire import schemas as S
from tidewire.functions import text as X
from tidewire.operators.contract import parse_raw, raw_error

MODES = ("quarantine", "failfast")


def parse_replay(
    lines: DataFrame, now: Column, mode: str = "quarantine", value: str = "value"
) -> DataFrame:
    """Lines in ``value`` to raw rows stamped with ``now`` as their ingestion time.

    Blank lines vanish; an empty version or source gets its default. A malformed or
    invalid line carries ``error`` in quarantine mode and fails the job in failfast mode.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    trimmed = lines.withColumn(value, X.trim_space(F.col(value))).filter(F.col(value) != "")
    rows = (
        parse_raw(trimmed, value)
        .withColumn("schema_version", _default("schema_version", S.SCHEMA_VERSION))
        .withColumn("source", _default("source", "replay"))
        .withColumn("ingested_at", now)
        .withColumn("error", F.coalesce(F.col("decode_error"), raw_error()))
        .drop("decode_error")
    )
    if mode == "quarantine":
        return rows
    failure = F.raise_error(F.concat(F.lit("invalid replay line: "), F.col("error")))
    valid = F.when(F.col("error").isNull(), F.lit(True)).otherwise(failure.cast("boolean"))
    return rows.filter(valid).drop("error")


def _default(column: str, value: str) -> Column:
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(value))


def read_replay(
    spark: SparkSession, path: str, now: Column, mode: str = "quarantine"
) -> DataFrame:
    return parse_replay(spark.read.text(path), now, mode)


def stream_replay(
    spark: SparkSession,
    path: str,
    now: Column,
    files_per_trigger: int | None = None,
    mode: str = "quarantine",
) -> DataFrame:
    """Replay of a growing folder. The rate is files per trigger; None is unlimited.

    ``run_at_rate`` replays a fixed set of files at a rate by rows.
    """
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_replay(reader.load(path), now, mode)


#: Lines of a folder of numbered lines: a batch reads the folders that its numbers lie in.
CHUNK = 100_000


def number_lines(spark: SparkSession, path: str, into: str) -> int:
    """Write the lines of text files to ``into`` as ``n, value``, numbered from 0; their count.

    Lines are numbered by file, place of the block in it, and place in the block. Only the
    counts of blocks are ordered in one task; the lines stay where they are read.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value",
    )
    # the places are fixed by writing them down before they are counted
    lines.write.parquet(f"{into}/placed")
    lines = spark.read.schema(lines.schema).parquet(f"{into}/placed")
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        lines.groupBy("file", "block")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
        .withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))
    )
    numbered = lines.join(blocks, ["file", "block"]).select(
        (F.col("offset") + F.col("place") - F.col("first")).alias("n"), "value"
    )
    chunk = F.floor(F.col("n") / CHUNK)
    numbered.withColumn("chunk", chunk).write.partitionBy("chunk").parquet(f"{into}/lines")
    return blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]


def run_at_rate(
    spark: SparkSession,
    numbered: str,
    total: int,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    rows_per_batch: int,
    every: str = "1 second",
) -> None:
    """Hand ``write`` the numbered lines in order, ``rows_per_batch`` at a time, to their end.

    A source of ticks admits so many numbers per trigger and keeps the offset in the
    checkpoint; each batch reads the lines of its numbers. With a trigger of one second the
    rate is rows per second. A run that was broken off goes on where it stopped, and its last
    batch comes again, so ``write`` has to replace or skip a batch that it knows.
    """
    ticks = (
        spark.readStream.format("rate-micro-batch").option("rowsPerBatch", int(rows_per_batch))
        .option("numPartitions", 1).load()
    )
    lines = spark.read.schema("n long, value string, chunk long").parquet(f"{numbered}/lines")
    reached = [0]

    def some(batch: DataFrame, batch_id: int) -> None:
        first, last = batch.agg(F.min("value"), F.max("value")).first()
        if first is None:
            return
        if first < total:
            write(lines.filter(
                F.col("chunk").between(first // CHUNK, last // CHUNK)
                & F.col("n").between(first, last)
            ).select("n", "value"), batch_id)
        reached[0] = last + 1

    if not total:
        return
    query = (
        ticks.writeStream.foreachBatch(some).option("checkpointLocation", checkpoint)
        .trigger(processingTime=every).start()
    )
    try:
        while reached[0] < total and query.isActive:
            time.sleep(0.05)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
