import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tidewire import schemas as S
from tidewire.operators import readmodel


def results(spark, rows):
    """Rows of (id, score, label, seconds, source)."""
    return spark.createDataFrame(
        [(i, "h", src, lab, score, 0.0, 0.0, 1.0, f"m-{i}", False, at(0), at(s))
         for i, score, lab, s, src in rows], S.SCORED)


def shocks(spark, n=1):
    return spark.createDataFrame(
        [("KELP", f"i{k}", -5.25, -.7, .05, .14, 600, 2.5, -.6, at(k)) for k in range(n)], S.SHOCK)


ROWS = [("1", .6, "positive", 5, "replay"), ("2", -.5, "negative", 50, "gdelt"),
        ("3", .1, "neutral", 65, "replay"), ("4", .1, None, 310, None), ("5", .3, "mixed", 310, "rss")]


def test_timeline(spark):
    rows = results(spark, ROWS)
    got = [(r.volume, round(r.avg_sentiment, 6)) for r in
           readmodel.sentiment_timeline(rows).orderBy("bucket").collect()]
    assert got == [(2, .05), (1, .1), (0, 0.0), (0, 0.0), (0, 0.0), (2, .2)]
    assert readmodel.sentiment_timeline(rows.filter("false")).count() == 0


def test_timeline_over_days(spark):
    rows = results(spark, [("1", 1.0, "x", 0, "s"), ("2", 1.0, "x", 3 * 86400, "s")])
    for rule, buckets in (("30 seconds", 2880), ("15 minutes", 96)):
        got = readmodel.sentiment_timeline(rows, rule)
        assert got.count() == 3 * buckets + 1 and got.agg(F.sum("volume")).first()[0] == 2


def test_distributions(spark):
    rows = results(spark, ROWS)
    assert [tuple(r) for r in readmodel.label_distribution(rows).collect()] == [
        ("positive", 1), ("neutral", 1), ("negative", 1), ("mixed", 1)]
    assert [tuple(r) for r in readmodel.source_distribution(rows).collect()] == [
        ("replay", 2), ("gdelt", 1), ("rss", 1)]


def test_kpis(spark):
    rows, flagged = results(spark, ROWS), shocks(spark, 3)
    got = readmodel.kpis(rows, flagged, F.lit(at(365))).first()
    assert (got.total_scored, got.scored_last_5m, got.shocks_flagged) == (5, 3, 3)
    assert got.avg_sentiment == pytest.approx(.12) and got.model_name == "m-4"
    assert readmodel.recent_results(rows, 1).first().model_name == "m-4"
    many = spark.range(2500).selectExpr("cast(id as string) item_id").crossJoin(
        rows.filter("item_id = '1'").drop("item_id"))
    assert readmodel.kpis(many, flagged, F.lit(at(20))).first().scored_last_5m == 2500
    stats = readmodel.global_stats(rows, flagged).first()
    assert (stats.total_scored, stats.total_shocks) == (5, 3)
    empty = readmodel.kpis(rows.filter("false"), flagged.filter("false"), F.lit(at(0))).first()
    assert tuple(empty) == (0, 0, 0, 0.0, "-", False)


def test_recent(spark):
    rows = results(spark, ROWS)
    assert [r.item_id for r in readmodel.recent_results(rows, 3).collect()] == ["4", "5", "3"]
    shown = readmodel.display_items(rows, 2)
    assert shown.columns[-1] == "item_id" and shown.count() == 2
    assert [r.item_id for r in readmodel.recent_shocks(shocks(spark, 3), 2).collect()] == ["i2", "i1"]
    assert readmodel.display_shocks(shocks(spark)).first().zscore == -5.25
    plan = readmodel.recent_results(rows, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
