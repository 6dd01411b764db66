"""Pipeline metrics over sample tables: histograms, quantiles, rates, lag, summaries."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.operators.signals import with_previous

# Latency bucket bounds in seconds; the last bucket is unbounded.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5)
QUANTILES = (0.50, 0.95, 0.99)

_BINS_PER_OCTAVE = 256
#: Narrower bins that a bin with a wanted rank is cut into.
_CUTS = 4096


def latency_histogram(
    samples: DataFrame,
    by: Sequence[str] = (),
    value: str = "seconds",
    bounds: Sequence[float] = LATENCY_BOUNDS,
) -> DataFrame:
    """Cumulative counts per bound (inclusive) in long form: ``by``, le, cumulative.

    The unbounded bucket has le = infinity.
    """
    every = [*bounds, float("inf")]
    counts = samples.groupBy(*by).agg(
        *[
            F.coalesce(F.sum(F.when(F.col(value) <= le, 1)), F.lit(0)).alias(f"_b{i}")
            for i, le in enumerate(every)
        ]
    )
    buckets = F.array(
        *[
            F.struct(F.lit(float(le)).alias("le"), F.col(f"_b{i}").alias("cumulative"))
            for i, le in enumerate(every)
        ]
    )
    return counts.select(*by, F.inline(buckets))


def histogram_quantile(
    buckets: DataFrame, by: Sequence[str] = (), quantiles: Sequence[float] = QUANTILES
) -> DataFrame:
    """Quantiles interpolated inside cumulative buckets: ``by``, quantile, value.

    The lowest bucket starts at 0; a quantile in the unbounded bucket is the highest finite
    bound; without observations the value is NULL. Bucket lists are short, so each histogram
    is folded into one array.
    """
    grouped = buckets.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("le", "cumulative"))).alias("_h")
    )
    rows = grouped.withColumn("_total", F.element_at("_h", -1)["cumulative"]).withColumn(
        "quantile", F.explode(F.array(*[F.lit(float(q)) for q in quantiles]))
    )
    rank = F.col("quantile") * F.col("_total")
    reached = F.filter("_h", lambda b: b["cumulative"] >= rank)
    below = F.filter("_h", lambda b: b["cumulative"] < rank)
    rows = rows.withColumn("_hit", F.get(reached, 0)).withColumn(
        "_low", F.when(F.size(below) > 0, F.element_at(below, -1))
    )
    start = F.coalesce(F.col("_low.le"), F.lit(0.0))
    passed = F.coalesce(F.col("_low.cumulative"), F.lit(0))
    inside = F.col("_hit.cumulative") - passed
    share = F.when(inside > 0, (rank - passed) / F.greatest(inside, F.lit(1))).otherwise(F.lit(0.0))
    highest = F.get("_h", F.size("_h") - 2)["le"]
    unbounded = F.col("_hit.le") == float("inf")
    value = F.when(unbounded, highest).otherwise(start + (F.col("_hit.le") - start) * share)
    return rows.select(
        *by, "quantile", F.when(F.col("_total") > 0, value).alias("value")
    )


def counter_rate(
    samples: DataFrame, by: Sequence[str] = ("stage",), window: str = "1 minute",
    block_seconds: int = 3600,
) -> DataFrame:
    """Increase per second of cumulative counters, summed over series per window.

    ``samples`` has ts, stage, metric, label, value and a unique ``seq`` that orders equal
    times. A drop is a reset, so the new value counts as the increase; a series' first
    sample has no increase. Plain delta over window length, without edge extrapolation.
    """
    series = ["stage", "metric", "label"]
    us = F.unix_micros("ts")
    timed = samples.withColumn("_us", us).withColumn(
        "_block", F.floor(us / F.lit(block_seconds * 1_000_000))
    )
    stepped = with_previous(timed, series, ["_us", "seq"], ["value"], "_block")
    change = F.col("value") - F.col("prev_value")
    increase = F.when(change < 0, F.col("value")).otherwise(change)
    seconds = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {window}")) / 1e6
    return (
        stepped.withColumn("_increase", increase)
        .filter("_increase is not null")
        .groupBy(*by, F.window("ts", window)["start"].alias("window_start"))
        .agg((F.sum("_increase") / seconds).alias("per_second"))
    )


def throughput_by_label(results: DataFrame, window: str = "1 minute") -> DataFrame:
    """Scored items per label and window."""
    return results.groupBy(
        F.window("inferred_at", window)["start"].alias("window_start"),
        F.col("sentiment_label").alias("label"),
    ).agg(F.count(F.lit(1)).alias("scored"))


def error_rate(
    outcomes: DataFrame, window: str = "1 minute", by: Sequence[str] = ("stage",)
) -> DataFrame:
    """Share of failed rows per stage and window, from ``ts``, ``stage``, ``failed``."""
    return outcomes.groupBy(*by, F.window("ts", window)["start"].alias("window_start")).agg(
        F.count(F.lit(1)).alias("handled"),
        F.coalesce(F.sum(F.when(F.col("failed"), 1)), F.lit(0)).alias("errors"),
        F.avg(F.when(F.col("failed"), 1.0).otherwise(0.0)).alias("error_rate"),
    )


def consumer_lag(positions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Messages between position and high watermark; unassigned partitions do not count."""
    behind = F.greatest(F.col("high_watermark") - F.col("position"), F.lit(0))
    assigned = F.col("position").isNotNull() & (F.col("position") >= 0)
    return positions.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(assigned, behind)), F.lit(0)).alias("lag")
    )


def _counted_upto(counts: DataFrame, within: list[str], order: str) -> DataFrame:
    """``_upto``: the values counted by ``_n`` up to and with each row, ``_n`` kept."""
    return counts.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*within).orderBy(order)))


def _reached(ranks: DataFrame) -> DataFrame:
    """The rows whose values hold rank ``_at``, which is counted from their first value on."""
    start = F.col("_upto") - F.col("_n")
    return ranks.filter((F.col("_at") >= start) & (F.col("_at") < F.col("_upto"))).withColumn(
        "_at", F.col("_at") - start
    )


def exact_percentiles(
    samples: DataFrame, by: str, value: str, percents: Sequence[float]
) -> DataFrame:
    """Exact linearly interpolated percentiles: ``by``, percent, result.

    The built-in exact percentile keeps all distinct values of a group in one buffer. Here a
    first pass counts values per bin (256 per power of two), which locates the bins holding
    the wanted ranks; a second pass cuts just those into narrower ones between their least and
    largest value, and a third counts the distinct values in the narrow bins that are left,
    about one in a million of a power of two. All are partial aggregations, so a group of any
    size is spread over all tasks. Null and NaN values are left out.
    """
    x = F.col(value).cast("double")
    size = F.least(F.greatest(F.abs(x), F.lit(1e-300)), F.lit(1e308))
    magnitude = F.floor(F.log2(size) * _BINS_PER_OCTAVE)
    shifted = magnitude + F.lit(_BINS_PER_OCTAVE * 1100)
    bin_of = F.when(x == 0, F.lit(0)).when(x > 0, shifted).otherwise(-shifted)
    binned = samples.filter(x.isNotNull() & ~F.isnan(x)).select(
        by, bin_of.cast("bigint").alias("_bin"), x.alias("_x")
    )
    counts = binned.groupBy(by, "_bin").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")
    )
    placed = _counted_upto(counts, [by], "_bin").withColumn(
        "_total", F.sum("_n").over(Window.partitionBy(by))
    )
    # Wanted ranks: the two neighbours of (total - 1) * p / 100, counted from 0.
    wanted = placed.withColumn(
        "percent", F.explode(F.array(*[F.lit(float(p)) for p in percents]))
    ).withColumn("_k", (F.col("_total") - 1) * (F.col("percent") / 100.0))
    low = F.floor("_k")
    high = F.least(low + 1, F.col("_total") - 1)
    ranks = _reached(
        wanted.withColumn("_fraction", F.col("_k") - low).withColumn(
            "_rank",
            F.explode(
                F.array(
                    F.struct(F.lit("lo").alias("end"), low.alias("at")),
                    F.struct(F.lit("hi").alias("end"), high.alias("at")),
                )
            ),
        ).withColumns({"_end": F.col("_rank.end"), "_at": F.col("_rank.at")})
    ).select(by, "_bin", "_lo", "_hi", "percent", "_fraction", "_end", "_at")

    # Rounding keeps the order of values, so narrower bins are in order too.
    width = F.col("_hi") - F.col("_lo")
    inner = F.when(
        (width > 0) & (width < float("inf")),
        F.least(F.floor((F.col("_x") - F.col("_lo")) / width * _CUTS), F.lit(_CUTS - 1)),
    ).otherwise(F.lit(0))
    chosen = ranks.select(by, "_bin", "_lo", "_hi").distinct()
    inside = binned.join(chosen, [by, "_bin"]).select(
        by, "_bin", inner.cast("bigint").alias("_cut"), "_x"
    )
    narrow = inside.groupBy(by, "_bin", "_cut").agg(F.count(F.lit(1)).alias("_n"))
    ranks = _reached(
        _counted_upto(narrow, [by, "_bin"], "_cut").join(ranks.drop("_lo", "_hi"), [by, "_bin"])
    ).select(by, "_bin", "_cut", "percent", "_fraction", "_end", "_at")

    bins = ranks.select(by, "_bin", "_cut").distinct()
    values = (
        inside.join(bins, [by, "_bin", "_cut"], "left_semi")
        .groupBy(by, "_bin", "_cut", "_x")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    hits = _reached(
        _counted_upto(values, [by, "_bin", "_cut"], "_x").join(ranks, [by, "_bin", "_cut"])
    )

    def end(name: str) -> Column:
        return F.max(F.when(F.col("_end") == name, F.col("_x")))

    fraction = F.max("_fraction")
    between = end("lo") * (1 - fraction) + end("hi") * fraction
    # at a rank, an infinite neighbour does not count
    return hits.groupBy(by, "percent").agg(
        F.when(fraction == 0, end("lo")).otherwise(between).alias("result")
    )


def latency_summary(
    timings: DataFrame, by: str = "variant", millis: str = "millis", items: str = "items"
) -> DataFrame:
    """Per variant: p50, p95 and mean latency in milliseconds, and items per second.

    ``timings`` has one row per call with its duration and the number of items it handled.
    """
    tails = (
        exact_percentiles(timings, by, millis, (50, 95))
        .groupBy(by)
        .agg(
            F.max(F.when(F.col("percent") == 50, F.col("result"))).alias("p50_ms"),
            F.max(F.when(F.col("percent") == 95, F.col("result"))).alias("p95_ms"),
        )
    )
    seconds = F.sum(millis) / 1000.0
    totals = timings.groupBy(by).agg(
        F.count(F.lit(1)).alias("calls"),
        F.avg(millis).alias("mean_ms"),
        F.when(seconds > 0, F.sum(items) / seconds).otherwise(F.lit(0.0)).alias("items_per_s"),
    )
    return totals.join(tails, by, "left").select(
        by, "calls", "p50_ms", "p95_ms", "mean_ms", "items_per_s"
    )


def compare_variants(summary: DataFrame, base: str, other: str, by: str = "variant") -> DataFrame:
    """One row: how many times lower the p50 and higher the throughput of ``other`` is."""

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col(by) == name, F.col(column)))

    return summary.agg(
        F.try_divide(of(base, "p50_ms"), of(other, "p50_ms")).alias("p50_ratio"),
        F.try_divide(of(other, "items_per_s"), of(base, "items_per_s")).alias("throughput_ratio"),
    )
