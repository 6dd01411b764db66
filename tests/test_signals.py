import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tidewire.operators import signals


def samples(spark, rows):
    """Rows of (entity, seconds, score) in arrival order."""
    return spark.createDataFrame(
        [(f"i{n}", e, float(v), at(s), n) for n, (e, s, v) in enumerate(rows)],
        "item_id string, entity string, sentiment_score double, inferred_at timestamp, arrival_seq long")


def brute_force(rows, window, threshold, needed):
    """Every sample judged by scanning its window, in plain Python."""
    found = {}
    for n, (entity, t, score) in enumerate(rows):
        seen = sorted((s, m, v) for m, (e, s, v) in enumerate(rows)
                      if e == entity and t - window <= s and (s, m) <= (t, n))
        if len(seen) < max(4, needed):
            continue
        steps = [b[2] - a[2] for a, b in zip(seen, seen[1:])]
        std = statistics.pstdev(steps[:-1])
        if std == 0:
            continue
        z = (steps[-1] - statistics.fmean(steps[:-1])) / std
        if abs(z) >= threshold:
            found[f"i{n}"] = z
    return found


CALM = [-.30, -.27, -.31, -.28, -.30, -.26, -.29, -.31, -.28, -.30]


def series(scores):
    return [("CALM", 2 * i, s) for i, s in enumerate(scores)]


@pytest.mark.parametrize("scores, threshold, expected", [
    ([*CALM, .62], 3.0, 1),
    ([*CALM, -.28], 3.0, 0),
    ([-.4, .6, -.4], 3.0, 0),
    ([.25] * 12, 3.0, 0),
    ([*CALM, -.18], 2.0, 1),
    ([*CALM, -.18], 40.0, 0),
])
def test_named_series(spark, scores, threshold, expected):
    found = signals.detect_shocks(samples(spark, series(scores)), 300, threshold, 8).collect()
    assert len(found) == expected
    if expected:
        assert found[0].item_id == f"i{len(scores) - 1}" and found[0].velocity > 0
        assert (found[0].window_seconds, found[0].threshold) == (300, threshold)


@pytest.mark.parametrize("slices", [1, 2, 5, 16])
def test_randomized_against_brute_force(spark, slices):
    rng = random.Random(7)
    rows = []
    for entity, gap in (("dense", 3), ("sparse", 90), ("burst", 0), ("mixed", 20)):
        t = 0.0
        for _ in range(120):
            t += rng.choice([0, gap, gap * 2, gap * rng.random()])
            rows.append((entity, round(t, 3), round(rng.choice([0.1, 0.2, rng.random()]), 2)))
    # Exactly on both bounds of the window, and just outside.
    rows += [("edge", s, v) for s, v in
             [(0, .1), (0.001, .5), (10, .2), (100, .1), (200, .3), (300, .2), (300.001, .9), (600, .1), (600.001, .7)]]
    rng.shuffle(rows)
    expected = brute_force(rows, 300, 1.5, 5)
    got = {r.item_id: r.zscore for r in
           signals.detect_shocks(samples(spark, rows), 300, 1.5, 5, slices).collect()}
    assert set(got) == set(expected) and len(expected) > 30
    assert all(abs(got[k] - expected[k]) <= 1e-9 * abs(expected[k]) for k in expected)


def test_hot_entity_is_split_over_blocks(spark):
    """One entity holds most rows; blocks of the window's length are the unit of work."""
    rows = spark.range(60_000).select(
        F.concat(F.lit("i"), "id").alias("item_id"),
        F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.lit("cold")).alias("entity"),
        ((F.col("id") * 7919) % 101 / 100.0).alias("sentiment_score"),
        F.timestamp_seconds(F.col("id") * 5).alias("inferred_at"),
        F.col("id").alias("arrival_seq"),
    )
    stats = signals.rolling_velocity_stats(rows, 300, slices=1)
    assert stats.count() == 60_000
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert "hashpartitioning(entity" in plan and "_cell" in plan


def test_velocity_over_block_edges(spark):
    rows = [("a", 0, .1), ("a", 7200, .4), ("b", 1, 1.0), ("a", 90000, .2), ("a", 90000, .5)]
    got = {r.item_id: r.velocity for r in signals.sentiment_velocity(samples(spark, rows)).collect()}
    assert got["i0"] is None and got["i2"] is None
    assert got["i1"] == pytest.approx(.3) and got["i3"] == pytest.approx(-.2) and got["i4"] == pytest.approx(.3)


def test_velocity_of_a_series_without_a_name(spark):
    rows = samples(spark, [(None, 3599, .1), (None, 3601, .4), ("a", 3599, .1), ("a", 3601, .2)])
    got = {r.item_id: r.velocity for r in signals.sentiment_velocity(rows).collect()}
    assert got["i1"] == pytest.approx(.3) and got["i3"] == pytest.approx(.1)


def test_recent_samples(spark):
    rows = samples(spark, [("a", 0, .1), ("a", 100, .2), ("b", 100, .9), ("a", 101, .3)])
    as_of = F.lit(at(100))
    assert [r.sentiment_score for r in signals.recent_entity_samples(rows, "a", 60, as_of).collect()] == [.2]
    assert signals.recent_entity_samples(rows, "a", 100, as_of).count() == 2


@pytest.mark.parametrize("slices", [1, 3])
def test_recent_samples_of_many_asks(spark, slices):
    draw = random.Random(3)
    samples = [(draw.choice(["a", "a", "a", "b", None]), at(draw.randint(0, 4000)), k, draw.random())
               for k in range(400)] + [("a", None, 900, 0.5)]
    asks = [(draw.choice(["a", "b", "c", None]), at(draw.randint(-100, 4500)), k) for k in range(60)]
    asks += [asks[0], ("a", None, 99)]
    found = signals.recent_samples_bulk(
        spark.createDataFrame(samples, "entity string, inferred_at timestamp, arrival_seq long, sentiment_score double"),
        spark.createDataFrame(asks, "entity string, as_of timestamp, ask long"), 300, slices)
    expected = sorted(
        (k, n) for e, t, k in asks for s, u, n, _ in samples
        if e and t and u and s == e and 0 <= (t - u).total_seconds() <= 300
    )
    assert sorted((r.ask, r.arrival_seq) for r in found.collect()) == expected and expected
