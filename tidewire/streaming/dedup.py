"""Content dedup on a stream: one mark per content, kept for a time to live.

``first_seen`` keeps marks in the engine's state store and takes any copy of a batch.
``first_seen_writer`` keeps them in a table and takes the copy with the least ordinal.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.streaming.committed import CommittedTables

BatchWriter = Callable[[DataFrame, int], None]
_LAST = (1 << 63) - 1


def first_seen(rows: DataFrame, key: str, live_seconds: int | None = None) -> DataFrame:
    """One row of each key of a stream; rows without a key are left out.

    A row is dropped only if its key was seen, never for its own time: marks are stamped with
    the time of arrival, and the watermark runs on those stamps. A mark lives ``live_seconds``
    after it is set, at least, and at most twice as long while rows arrive; for ever if None.
    The state is a key and a time per content; the rows themselves are not stored, and within
    a batch any copy may pass.
    """
    keyed = rows.filter(F.col(key).isNotNull())
    if live_seconds is None:
        return keyed.dropDuplicates([key])
    return (
        keyed.withColumn("mark_time", F.current_timestamp())
        .withWatermark("mark_time", f"{int(live_seconds)} seconds")
        .dropDuplicatesWithinWatermark([key]).drop("mark_time")
    )


def first_of_batch(
    rows: DataFrame, key: str, order: str, marks: DataFrame | None = None
) -> DataFrame:
    """The row of each key with the least ``order``; nulls are last, ties give any of theirs.

    The least ordinals are found on two narrow columns, and only their rows are sorted, so a
    key of a third of all rows costs its copies one pass. Rows without a key are left out, and
    with ``marks`` (a column ``mark``) those whose key is not one of them: the ordinals are
    joined with the marks, not the rows, whose copies of a key would meet in one task.
    """
    place = F.coalesce(F.col(order).cast("long"), F.lit(_LAST))
    keyed = rows.filter(F.col(key).isNotNull())
    least = keyed.groupBy(F.col(key).alias("least_key")).agg(F.min(place).alias("least_place"))
    if marks is not None:
        least = least.join(marks, F.col("least_key") == F.col("mark"), "left_semi")
    return (
        keyed.join(least, (F.col(key) == F.col("least_key")) & (place == F.col("least_place")))
        .select(*rows.columns).dropDuplicates([key])
    )


def mark_tables(base: str, run: str = "a") -> CommittedTables:
    return CommittedTables(
        base, {"marks": ("mark string, marked_at timestamp, hour timestamp", ("hour",))}, run
    )


def first_seen_writer(
    write: BatchWriter, base: str, key: str, order: str, live_seconds: int | None = None,
    run: str = "a", compact_every: int | None = 32,
) -> BatchWriter:
    """Batch writer that hands ``write`` the first row of every key that has no mark yet.

    Within a batch the least ``order`` wins (nulls last), over batches the earlier one. Marks
    are a table of keys below ``base``, cut by the hour of arrival, so that a batch reads the
    hours in which marks can live, and small batches are compacted. A batch that is repeated
    finds the marks it has set before and hands on the same rows. ``write`` may be called
    again for a batch; it has to replace or skip what it wrote.
    """
    tables = mark_tables(base, run)

    def first(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            if not tables.is_committed(spark, batch_id):
                now = F.lit(spark.sql("SELECT current_timestamp()").first()[0])
                marks = tables.read(spark, "marks")
                if live_seconds is not None:
                    since = now - F.expr(f"interval {int(live_seconds)} seconds")
                    marks = marks.filter(
                        (F.col("hour") >= F.date_trunc("hour", since))
                        & (F.col("marked_at") >= since)
                    )
                fresh = (
                    batch.filter(F.col(key).isNotNull()).select(F.col(key).alias("mark")).distinct()
                    .join(marks.select("mark"), "mark", "left_anti")
                )
                tables.put("marks", batch_id, fresh.withColumns(
                    {"marked_at": now, "hour": F.date_trunc("hour", now)}
                ))
            own = _marks_of(tables, spark, batch_id)
            write(first_of_batch(batch, key, order, own), batch_id)
            tables.commit(spark, batch_id)
        finally:
            batch.unpersist()
        if compact_every:
            tables.compact(spark, compact_every)

    return first


def _marks_of(tables: CommittedTables, spark, batch_id: int) -> DataFrame:
    return tables.own(spark, "marks", batch_id).select("mark")
