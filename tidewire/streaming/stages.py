"""The pipeline as streaming stages; every stage is a DataFrame in, a DataFrame out.

The row-wise operators are the batch ones. Deduplication keeps keyed state or a table of
marks; shocks and the timeline are tables that every batch extends and that tolerate rows in
any order. No stage drops a row for being late; ``committed.late_writer`` sets rows behind an
event-time watermark aside for those who want that.
"""

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire import schemas as S
from tidewire.operators import contract, process, scoring
from tidewire.session import use_rocksdb_state
from tidewire.sources.kafka import PROCESSED_TOPIC, RAW_TOPIC
from tidewire.sources.registry import fan_in
from tidewire.streaming.committed import CommittedTables
from tidewire.streaming.dedup import first_seen, first_seen_writer


def ingest_stage(sources: list[DataFrame]) -> DataFrame:
    """Sources to ``key``/``value`` messages of the raw topic; invalid rows are left out."""
    rows = fan_in(*[_without_error(s) for s in sources])
    return contract.to_wire(rows.filter(contract.raw_error().isNull()), RAW_TOPIC)


def _without_error(rows: DataFrame) -> DataFrame:
    return rows.filter("error is null").drop("error") if "error" in rows.columns else rows


def evaluate_stage(
    messages: DataFrame, rule: process.Relevance = process.Relevance(), observe: str | None = None
) -> DataFrame:
    """Raw messages decoded, validated, normalized and filtered, all rows kept.

    With ``observe`` the counts of consumed, filtered and failed rows are reported under
    that name in every batch's progress.
    """
    rows = process.evaluate(contract.decode_raw(messages), rule)
    if observe is None:
        return rows
    return rows.observe(
        observe,
        F.count(F.lit(1)).alias("consumed"),
        F.count("reason").alias("filtered"),
        F.count("error").alias("errors"),
    )


def process_stage(
    messages: DataFrame,
    now: Column,
    rule: process.Relevance = process.Relevance(),
    *,
    live_seconds: int | None = 3600,
    extra: tuple[str, ...] = (),
    observe: str | None = None,
) -> DataFrame:
    """Raw messages to processed rows, each content once.

    State is keyed by content hash and therefore global. It is bounded by time: a copy is
    recognized while it arrives within ``live_seconds`` of the first one's arrival; None keeps
    every hash. Rows are never dropped for being late. The copy of an earlier batch wins, and
    within a batch any; ``process_writer`` takes the first one. ``extra`` columns of the
    messages are carried along. With ``observe`` the rows passed on are reported under that
    name and ``_out``, beside the counts of ``evaluate_stage``. The query needs the RocksDB
    state store, which is set here.
    """
    use_rocksdb_state(messages.sparkSession)
    unique = first_seen(_survivors(evaluate_stage(messages, rule, observe), extra),
                        "content_hash", live_seconds)
    if observe:
        unique = unique.observe(f"{observe}_out", F.count(F.lit(1)).alias("processed"))
    return process.to_processed(unique, now, *extra)


def _survivors(rows: DataFrame, extra: tuple[str, ...]) -> DataFrame:
    return rows.filter("error is null and reason is null").select(
        *_columns_of(rows), "content_hash", *extra
    )


_COUNTS = "consumed long, processed long, duplicates long, filtered long, errors long"


def stats_tables(base: str, run: str = "a") -> CommittedTables:
    return CommittedTables(base, {"stats": (_COUNTS, ())}, run)


def process_writer(
    write: Callable[[DataFrame, int], None],
    base: str,
    now: Column,
    rule: process.Relevance = process.Relevance(),
    *,
    order: str,
    live_seconds: int | None = 3600,
    extra: tuple[str, ...] = (),
    run: str = "a",
    compact_every: int | None = 32,
) -> Callable[[DataFrame, int], None]:
    """Batch writer of raw messages that hands ``write`` the processed rows of each batch.

    As ``process_stage``, but of the copies of a batch the one with the least ``order``, a
    column of the messages such as their offset, is passed on. Every batch leaves its run
    summary in the committed table ``base/stats``, duplicates included (``run_summary``).
    """
    stats = stats_tables(f"{base}/summary", run)

    def process_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = evaluate_stage(batch, rule).persist()
        try:
            def passed(unique: DataFrame, number: int) -> None:
                write(process.to_processed(unique, now, *kept), number)
                if stats.is_committed(spark, number):
                    return
                counted = rows.agg(
                    F.count(F.lit(1)).alias("consumed"),
                    F.count("content_hash").alias("valid"),
                    F.count(F.when(F.col("error").isNull(), F.col("reason"))).alias("filtered"),
                    F.count("error").alias("errors"),
                ).crossJoin(unique.agg(F.count(F.lit(1)).alias("processed")))
                stats.put("stats", number, counted.withColumn(
                    "duplicates", F.col("valid") - F.col("processed")
                ))
                stats.commit(spark, number)

            kept = tuple(dict.fromkeys((order, *extra)))
            first_seen_writer(
                passed, f"{base}/seen", "content_hash", order, live_seconds, run, compact_every
            )(_survivors(rows, kept), batch_id)
        finally:
            rows.unpersist()
        if compact_every:
            stats.compact(spark, compact_every)

    return process_batch


def run_summary(spark: SparkSession, base: str, run: str = "a") -> DataFrame:
    """One row: what ``process_writer`` has consumed, passed on and left out so far."""
    rows = stats_tables(f"{base}/summary", run).read(spark, "stats")
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in rows.columns])


def _columns_of(rows: DataFrame) -> list[str]:
    made = ("content_hash", "processed_at", "schema_version")
    return [f.name for f in S.PROCESSED if f.name in rows.columns and f.name not in made]


def quarantine_stage(messages: DataFrame, topic: str = RAW_TOPIC) -> DataFrame:
    """The messages a stage skips, with the reason."""
    decode = contract.decode_processed if topic == PROCESSED_TOPIC else contract.decode_raw
    return contract.split_bad(decode(messages.withColumn("message", F.col("value"))))[1].select(
        "message", "error"
    )


def score_stage(
    messages: DataFrame,
    inferred_at: Column,
    model: scoring.Model | None = None,
    gazetteer: Mapping[str, str] | DataFrame | None = None,
) -> DataFrame:
    """Processed messages to scored items; undecodable ones are left to quarantine.

    Columns beside ``value``, such as an arrival ordinal, are carried along. A gazetteer table
    is read when the stage is built; one that is too large for the rows' own task is an error
    here and is joined in batch writers (``scoring.score`` on the batch).
    """
    good, _ = contract.split_bad(contract.decode_processed(messages))
    return scoring.score(good, inferred_at, model, gazetteer)


def partial_timeline(results: DataFrame, rule: str = "1 minute") -> DataFrame:
    """Sum and volume per bucket of one batch of results.

    Partial rows of all batches add up (``merge_timeline``), so late rows need no bucket that
    is still open: they are one more partial row of theirs.
    """
    return results.filter("inferred_at is not null").groupBy(
        F.window("inferred_at", rule)["start"].alias("bucket")
    ).agg(F.sum("sentiment_score").alias("total"), F.count("sentiment_score").alias("volume"))


def merge_timeline(partials: DataFrame) -> DataFrame:
    """Average and volume per bucket from the partial rows of all batches."""
    merged = partials.groupBy("bucket").agg(
        F.sum("total").alias("total"), F.sum("volume").alias("volume")
    )
    average = F.when(F.col("volume") > 0, F.col("total") / F.col("volume"))
    return merged.select("bucket", average.alias("avg_sentiment"), "volume")


def arrived(batch: DataFrame, batch_id: int) -> Column:
    """Ordinal of the rows of a batch: after all earlier batches, by task and row within.

    Room for 2 ** 13 tasks of 2 ** 26 rows in each of 2 ** 24 batches; more is an error, since
    ordinals would repeat.
    """
    if not 0 <= batch_id < 1 << 24:
        raise ValueError(f"no ordinals left for batch {batch_id}")
    row = F.monotonically_increasing_id()
    task, place = F.shiftright(row, 33), row.bitwiseAND(F.lit((1 << 33) - 1))
    ordinal = F.lit(batch_id << 39) + task * (1 << 26) + place
    fits = (task < 1 << 13) & (place < 1 << 26)
    return F.when(fits, ordinal).otherwise(
        F.raise_error(F.lit("a batch of too many tasks or rows a task")).cast("long")
    )
