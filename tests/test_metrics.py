import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tidewire.operators import metrics


def test_exact_percentiles(spark):
    rng = random.Random(3)
    groups = {
        "eleven": [float(3 * i) for i in range(11)], "one": [4.0], "same": [2.5] * 50,
        "wide": [rng.expovariate(1) * 10 ** rng.randint(-3, 3) for _ in range(500)],
        "signed": [rng.uniform(-5, 5) for _ in range(101)] + [0.0, 0.0],
    }
    rows = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "variant string, millis double")
    percents = (0, 1, 50, 95, 99.5, 100)
    got = {(r.variant, r.percent): r.result
           for r in metrics.exact_percentiles(rows, "variant", "millis", percents).collect()}
    for g, values in groups.items():
        for p in percents:
            assert got[g, float(p)] == pytest.approx(np.percentile(values, p), rel=1e-12, abs=1e-12), (g, p)
    assert got["eleven", 50.0] == 15.0


@pytest.mark.parametrize("cuts", [1, 7, 4096])
def test_percentiles_within_a_bin(spark, monkeypatch, cuts):
    """All values share a power-of-two bin; narrower bins and ties change nothing."""
    monkeypatch.setattr(metrics, "_CUTS", cuts)
    rng = random.Random(5)
    near = [1.0 + rng.randint(0, 5000) * 1e-7 for _ in range(3000)]
    below = [-v for v in near[:700]]
    ends = [1.0, 2.0, float("inf"), float("inf")]
    rows = [("near", v) for v in near] + [("below", v) for v in below] + [("ends", v) for v in ends]
    rows += [("near", None), ("near", float("nan")), ("none", None)]
    table = spark.createDataFrame(rows, "variant string, millis double")
    percents = (0, 12.5, 50, 99, 100)
    got = {(r.variant, r.percent): r.result
           for r in metrics.exact_percentiles(table, "variant", "millis", percents).collect()}
    for p in percents:
        assert got["near", p] == pytest.approx(np.percentile(near, p), rel=1e-15, abs=0)
        assert got["below", p] == pytest.approx(np.percentile(below, p), rel=1e-15, abs=0)
    assert got["ends", 0] == 1.0 and got["ends", 100] == float("inf")
    assert not any(variant == "none" for variant, _ in got)


def test_latency_summary(spark):
    rows = spark.createDataFrame(
        [("a", 10.0, 1), ("a", 20.0, 1), ("b", 5.0, 2), ("b", 10.0, 2)], "variant string, millis double, items int")
    summary = metrics.latency_summary(rows)
    got = {r.variant: r for r in summary.collect()}
    assert got["a"].p50_ms == 15 and got["a"].mean_ms == 15
    assert got["a"].items_per_s == pytest.approx(2 / .03)
    ratio = metrics.compare_variants(summary, "a", "b").first()
    assert ratio.p50_ratio == pytest.approx(2.0) and ratio.throughput_ratio == pytest.approx(4.0)


def test_histogram_and_quantile(spark):
    rows = spark.createDataFrame([(.005,), (.02,), (.03,), (.2,), (9.0,)], "seconds double")
    buckets = metrics.latency_histogram(rows)
    assert [r.cumulative for r in buckets.orderBy("le").collect()] == [1, 1, 2, 3, 3, 4, 4, 4, 4, 5]
    got = {r.quantile: r.value for r in metrics.histogram_quantile(buckets, quantiles=(.1, .2, .4, .99)).collect()}
    assert got[.1] == pytest.approx(.0025) and got[.2] == pytest.approx(.005)
    assert got[.4] == pytest.approx(.025) and got[.99] == 2.5
    empty = metrics.histogram_quantile(metrics.latency_histogram(rows.filter("false")))
    assert {r.value for r in empty.collect()} == {None}


def test_counter_rate(spark):
    rows = spark.createDataFrame(
        [(at(0), "s", "m", "x", 10.0, 1), (at(20), "s", "m", "x", 40.0, 2), (at(40), "s", "m", "x", 5.0, 3),
         (at(70), "s", "m", "x", 5.0, 4), (at(10), "s", "m", "y", 1.0, 5), (at(50), "s", "m", "y", 2.0, 6),
         (at(7300), "s", "m", "y", 8.0, 7)],
        "ts timestamp, stage string, metric string, label string, value double, seq long")
    got = [r.per_second for r in metrics.counter_rate(rows).orderBy("window_start").collect()]
    assert got == pytest.approx([36 / 60, 0.0, 6 / 60])


def test_counter_rate_without_label(spark):
    """Unlabelled and labelled counters over the edge of an hour rise alike."""
    rows = spark.createDataFrame(
        [(at(3590), "s", "m", label, 12.0, seq) for label, seq in ((None, 1), ("x", 2))]
        + [(at(3650), "s", "m", label, 42.0, seq) for label, seq in ((None, 3), ("x", 4))],
        "ts timestamp, stage string, metric string, label string, value double, seq long")
    got = metrics.counter_rate(rows, by=("label",)).collect()
    assert {r.label: r.per_second for r in got} == {None: .5, "x": .5}


def test_lag_and_error_rate(spark):
    rows = spark.createDataFrame(
        [(0, 5, 9), (1, 7, 7), (2, -1, 3), (3, None, 3), (4, 12, 10)], "partition int, position long, high_watermark long")
    assert metrics.consumer_lag(rows).first().lag == 4
    assert metrics.consumer_lag(rows.filter("false")).first().lag == 0
    outcomes = spark.createDataFrame(
        [(at(0), "p", True), (at(1), "p", False), (at(90), "p", False)], "ts timestamp, stage string, failed boolean")
    got = [(r.handled, r.errors, r.error_rate) for r in
           metrics.error_rate(outcomes).orderBy("window_start").collect()]
    assert got == [(2, 1, .5), (1, 0, 0.0)]
    scored = outcomes.select(F.col("ts").alias("inferred_at"), F.col("stage").alias("sentiment_label"))
    assert [r.scored for r in metrics.throughput_by_label(scored).orderBy("window_start").collect()] == [2, 1]
