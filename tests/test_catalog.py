"""Every catalog query equals its SQL twin on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.check_oracle import connect, difference
from tidewire.plans import catalog
from tidewire.plans.catalog import QUERIES
from tidewire.plans.oracle import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    ours = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(ours, db.execute(ORACLE_SQL[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_dealt_stream_spreads_one_share_and_keeps_it_in_a_batch(spark):
    """A text of most rows fills no file, and its copies and rows without a number share a batch."""
    rows = spark.range(20_000, numPartitions=4).select(
        F.when(F.col("id") % 5 > 0, F.lit(0)).otherwise(F.xxhash64("id")).alias("text"),
        F.when(F.col("id") % 100 != 0, F.col("id")).alias("seq"),
        F.concat(*[F.sha2(F.concat("id", F.lit(f"-{i}")), 512) for i in range(4)]).alias("body"),
    )
    for by, copies in (("text", 16_000), ("seq", 200)):
        stream, base = catalog._interleaved(rows, F.col(by), "test")
        seen = []

        def count(batch, batch_id):
            found = batch.groupBy(F.col(by) == F.lit(0) if by == "text" else F.col(by).isNull())
            seen.append(dict(found.count().collect()))

        query = stream.writeStream.foreachBatch(count).option(
            "checkpointLocation", f"{base}/checkpoint"
        ).trigger(availableNow=True).start()
        assert query.awaitTermination(120) and query.exception() is None
        assert sum(sum(s.values()) for s in seen) == 20_000 and len(seen) == 2
        assert [s[True] for s in seen if s.get(True)] == [copies]
        written = spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{base}/in")
        sizes = [r[1] for r in written.groupBy(F.input_file_name()).count().collect()]
        assert max(sizes) < 20_000 / 3


def test_dealt_stream_of_few_rows(spark):
    for numbers in ([], [None], [0], [5, 5, None]):
        rows = spark.createDataFrame([(n, "x") for n in numbers], "seq long, value string")
        stream, base = catalog._interleaved(rows, F.col("seq"), "few")
        assert catalog._drained(stream, base).count() == len(numbers)


class Dealt(Exception):
    """Where the rows of a stream lie; ends a query once they do."""


@pytest.mark.parametrize("name", [
    "stream_process_news",
    "stream_dedup",
    "stream_process_stats",
    "stream_ingest",
    "stream_timeline",
    "stream_scored_tables",
])
def test_stream_files_follow_the_size_of_tasks(spark, work_dir, monkeypatch, name):
    """No file holds a sixth of the rows, nor near it, if tasks are to be small."""
    ids = spark.range(3_000, numPartitions=6)
    text = F.concat_ws(" ", *[F.sha2(F.concat("id", F.lit(f"-{i}")), 256) for i in range(4)])
    ids.select(
        F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"),
        F.lit("web").alias("source"), F.length(text).cast("long").alias("n_chars"),
    ).write.parquet(f"{work_dir}/documents.parquet")
    ids.select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1_704_067_200 + F.col("id")).alias("ts"),
        F.col("id").alias("user_id"), F.lit("view").alias("event_type"),
        F.col("id").cast("double").alias("value"), text.alias("props"),
    ).write.parquet(f"{work_dir}/events.parquet")
    deal = catalog._interleaved

    def only_deal(*args):
        raise Dealt(deal(*args)[1])

    monkeypatch.setattr(catalog, "_interleaved", only_deal)
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
             "spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "0",
             "spark.sql.shuffle.partitions": "16"}
    was = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        with pytest.raises(Dealt) as dealt:
            QUERIES[name](spark, work_dir)
    finally:
        for key, value in was.items():
            spark.conf.set(key, value)
    files = spark.read.option("recursiveFileLookup", True).parquet(f"{dealt.value}/in")
    sizes = [r[1] for r in files.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 3_000 and max(sizes) < 3_000 / 12
