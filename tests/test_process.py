from pyspark.sql import functions as F

from tests.conftest import at
from tests.test_contract import GOOD, frame
from tidewire import schemas as S
from tidewire.operators import process

LONG = "an invented body that is comfortably longer than twenty characters"


def news(spark, rows):
    return frame(spark, [GOOD | r for r in rows]).withColumn("arrival_seq", F.monotonically_increasing_id())


def test_decisions_and_stats(spark):
    rows = news(spark, [
        {"id": "1", "title": "Title   ONE", "body": LONG, "language": "en"},
        {"id": "2", "title": "title one", "body": LONG.upper(), "language": "en"},
        {"id": "3", "body": "short", "language": "en"},
        {"id": "4", "body": LONG, "language": "fr"},
        {"id": "5", "title": "Delta", "body": LONG, "language": None},
        {"id": "", "body": LONG},
        {"id": "7", "title": "\x00", "body": LONG, "language": ""},
        {"id": "8", "title": " ", "body": "\t"},
    ]).coalesce(1)
    got = {r.id: (r.decision, r.reason) for r in process.decide(rows).collect()}
    assert got == {
        "1": ("emit", None), "2": ("duplicate", None), "3": ("filtered", "too_short"),
        "4": ("filtered", "language"), "5": ("emit", None), "": ("error", None),
        "7": ("emit", None), "8": ("filtered", "empty"),
    }
    assert tuple(process.process_stats(rows).first()) == (8, 3, 1, 3, 1)
    emitted = process.process_news(rows, F.lit(at(9)))
    assert {r.id: r.title for r in emitted.collect()} == {"1": "title one", "5": "delta", "7": ""}
    assert emitted.columns[:-1] == [f.name for f in S.PROCESSED]
    reasons = {r.reason: r.dropped for r in process.drops_by_reason(rows).collect()}
    assert reasons == {"too_short": 1, "language": 1, "empty": 1}


def test_stats_of_nothing(spark):
    assert tuple(process.process_stats(news(spark, [{}]).filter("false")).first()) == (0, 0, 0, 0, 0)


def test_filter_switches(spark):
    rows = news(spark, [{"id": "1", "body": "x", "language": "fr"}])
    off = process.Relevance(min_body_length=0, language="")
    assert process.process_news(rows, F.lit(at(0)), off).count() == 1


def test_filter_rule_order(spark):
    rows = spark.createDataFrame(
        [("long title here", LONG, "en"), ("", "", "fr"), ("t", "short", "fr"), ("t", LONG, "fr"),
         ("t", LONG, None), ("t", "é" * 20, "en"), ("t", "é" * 19, "en")],
        "t string, b string, l string")
    reason = process.filter_reason(F.col("t"), F.col("b"), F.col("l"), process.Relevance())
    assert [r.r for r in rows.select(reason.alias("r")).collect()] == [
        None, "empty", "too_short", "language", None, None, "too_short"]


def test_hot_content_keeps_the_first(spark):
    """A third of all rows are copies of one text; the first arrival survives."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("content_hash"),
        (30_000 - F.col("id")).alias("arrival_seq"),
    )
    kept = process.dedup_first(rows)
    assert kept.count() == 20_001
    assert kept.filter("content_hash = 'copy'").first().arrival_seq == 30_000 - 29_997
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_seen_across_polls(spark):
    poll = spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, "b"), (4, "c")], "arrival_seq long, id string")
    history = spark.createDataFrame([("a",), ("a",), ("z",)], "id string")
    got = sorted(tuple(r) for r in process.drop_seen(poll, history, "id").collect())
    assert got == [(2, "b"), (4, "c")]
