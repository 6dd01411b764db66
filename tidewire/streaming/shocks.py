"""Shocks of a stream of samples that arrive in any order.

Time is cut into cells as long as the window, so a sample can change verdicts in its own cell
and the next one only, and a verdict needs the samples of its own cell and the one before. A
batch adds its samples to a table, judges the (entity, cell) pairs that they can change with
the batch operator, and its verdicts on a pair replace all earlier ones. The table of current
shocks therefore always equals the batch operator over all samples that have arrived, whatever
their order. Nothing is held back and no row is too late.

What a batch reads does not grow with the history: samples are cut by stretches of time, of
which it reads those that its cells lie in, and the small folders of many batches are compacted.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire import schemas as S
from tidewire.operators.signals import (
    MIN_SAMPLES,
    SLICES,
    THRESHOLD,
    WINDOW_SECONDS,
    detect_shocks,
)
from tidewire.streaming.committed import CommittedTables

_SAMPLE = ["entity", "item_id", "sentiment_score", "inferred_at", "arrival_seq"]
_PAIR = ["entity", "cell"]
#: Least length of the stretches that samples are cut by, and how many of them a batch may
#: name one by one; beyond, it reads all between the first and the last.
STRETCH_SECONDS = 3600
NAMED_STRETCHES = 256


def shock_tables(base: str, run: str = "a") -> CommittedTables:
    shock = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.SHOCK)
    return CommittedTables(base, {
        "samples": (
            "entity string, item_id string, sentiment_score double, inferred_at timestamp, "
            "arrival_seq long, cell long, stretch long", ("stretch",)),
        "shocks": (f"{shock}, cell long, batch_id long", ()),
        "judged": ("entity string, cell long, batch_id long", ()),
    }, run)


def _cell(window_seconds: int) -> Column:
    return F.floor(F.unix_micros("inferred_at") / F.lit(window_seconds * 1_000_000))


def _stretch(window_seconds: int) -> Column:
    """Stretch of a cell: a whole number of cells, ``STRETCH_SECONDS`` long at least."""
    return F.floor(F.col("cell") / F.lit(-(-STRETCH_SECONDS // window_seconds)))


def _inside(samples: DataFrame, stretches: DataFrame) -> DataFrame:
    """The samples of some stretches; only their folders are read."""
    bounds = stretches.agg(F.min("stretch"), F.max("stretch")).first()
    named = [r.stretch for r in stretches.distinct().limit(NAMED_STRETCHES + 1).collect()]
    if len(named) <= NAMED_STRETCHES:
        return samples.filter(F.col("stretch").isin(named))
    return samples.filter(F.col("stretch").between(*bounds))


def _once(samples: DataFrame) -> DataFrame:
    """A sample that was delivered again counts once, as it came first."""
    return samples.groupBy("entity", "item_id", "inferred_at").agg(
        F.min_by("sentiment_score", "arrival_seq").alias("sentiment_score"),
        F.min("arrival_seq").alias("arrival_seq"),
    )


def shock_writer(
    base: str,
    window_seconds: int = WINDOW_SECONDS,
    threshold: float = THRESHOLD,
    min_samples: int = MIN_SAMPLES,
    slices: int = SLICES,
    run: str = "a",
    compact_every: int | None = 32,
) -> Callable[[DataFrame, int], None]:
    """Batch writer that keeps the tables of ``shock_tables``.

    Samples without an entity or a time are left out. A repeated batch changes nothing once it
    is committed, and replaces its own folders before. ``base`` belongs to one query; ``run``
    names its checkpoint.
    """
    tables = shock_tables(base, run)
    cell, stretch = _cell(window_seconds), _stretch(window_seconds)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if tables.is_committed(spark, batch_id):
            return
        fresh = (
            batch.select(*_SAMPLE).filter("entity is not null and inferred_at is not null")
            .withColumn("cell", cell).withColumn("stretch", stretch)
        )
        tables.put("samples", batch_id, fresh)
        fresh = tables.own(spark, "samples", batch_id)
        judged = fresh.select(
            "entity", F.explode(F.array("cell", F.col("cell") + 1)).alias("cell")
        ).distinct()
        tables.put("judged", batch_id, judged.withColumn("batch_id", F.lit(batch_id).cast("long")))
        judged = tables.own(spark, "judged", batch_id).select(*_PAIR)
        needed = judged.select(
            "entity", F.explode(F.array(F.col("cell") - 1, "cell")).alias("cell")
        ).distinct()
        stored = tables.read(spark, "samples").unionByName(fresh)
        near = _inside(stored, needed.select(stretch.alias("stretch")))
        found = detect_shocks(
            _once(near.join(needed, _PAIR, "left_semi")), window_seconds, threshold, min_samples, slices
        )
        shock_cell = F.floor(F.unix_micros("triggered_at") / F.lit(window_seconds * 1_000_000))
        verdicts = found.withColumn("cell", shock_cell).join(judged, _PAIR, "left_semi")
        tables.put("shocks", batch_id, verdicts.withColumn("batch_id", F.lit(batch_id).cast("long")))
        tables.commit(spark, batch_id)
        if compact_every:
            tables.compact(spark, compact_every, {"judged": _latest})

    return write


def _latest(judged: DataFrame) -> DataFrame:
    return judged.groupBy(*_PAIR).agg(F.max("batch_id").alias("batch_id"))


def current_shocks(spark: SparkSession, base: str, run: str = "a") -> DataFrame:
    """Shocks of every (entity, cell) from the last batch that has judged it."""
    tables = shock_tables(base, run)
    last = _latest(tables.read(spark, "judged"))
    return (
        tables.read(spark, "shocks").join(last, [*_PAIR, "batch_id"], "left_semi")
        .select(*[f.name for f in S.SHOCK])
    )
