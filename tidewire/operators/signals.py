"""Per-entity sentiment series: velocity, rolling baseline, shocks, range lookup.

Samples are ordered by ``(inferred_at, arrival_seq)`` within an entity. One entity may hold
a large share of all rows, so nothing here puts a whole entity into one task: time is cut
into cells and ``(entity, cell)`` is the unit of work. With cells as long as the window, a
window that ends in a cell starts in the one before it, hence the baseline of a sample is

    tail of the earlier cell  +  step across the boundary  +  head of its own cell

and each part is a running aggregate over a sorted cell: work is linear in the rows, and no
pairs of samples are ever formed. When even one window of one entity is too much for a task,
it is cut into more cells, and the ones in between enter as summaries.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.columns import compute_once

# Detector defaults, and the least number of samples it accepts.
WINDOW_SECONDS = 300
THRESHOLD = 3.0
MIN_SAMPLES = 8
LEAST_SAMPLES = 4
# Cells that a window is cut into: the unit of work is one cell of one entity. One is the least
# work (shocks at sf0.1, warm: 1.4 s with one, 2.6 with four, 2.7 with eight); a series so dense
# that one window of one entity is too much for a task takes more, as a parameter.
SLICES = 1


def with_previous(
    rows: DataFrame,
    key: list[str],
    order: list[str],
    carry: list[str],
    block: str,
) -> DataFrame:
    """Each row plus ``prev_<c>`` of its predecessor within ``key``, for c in ``carry``.

    Rows look back inside their (key, block); only the first row of a block needs more, and
    gets it from a table with one row per block. ``block`` must not decrease along ``order``.
    """
    inside = Window.partitionBy(*key, block).orderBy(*order)
    state = F.struct(*carry)
    last = (
        rows.groupBy(*key, block)
        .agg(F.max(F.struct(*order, state.alias("_state"))).alias("_last"))
        .withColumn(
            "_before", F.lag("_last._state").over(Window.partitionBy(*key).orderBy(block))
        )
        .select(*[F.col(c).alias(f"_at_{c}") for c in (*key, block)], "_before")
    )
    looked_back = rows.withColumn("_inside", F.lag(state).over(inside))
    previous = F.coalesce(F.col("_inside"), F.col("_before"))
    # null-safe: a key column may be unset for a whole series
    same = [looked_back[c].eqNullSafe(F.col(f"_at_{c}")) for c in (*key, block)]
    return looked_back.join(last, reduce(and_, same), "left").select(
        *[looked_back[c] for c in rows.columns],
        *[previous[c].alias(f"prev_{c}") for c in carry],
    )


def _timed(rows: DataFrame, window_seconds: int) -> DataFrame:
    us = F.unix_micros("inferred_at")
    width = window_seconds * 1_000_000
    return rows.withColumn("_us", us).withColumn("_block", F.floor(us / F.lit(width)))


def sentiment_velocity(rows: DataFrame, block_seconds: int = 3600) -> DataFrame:
    """Change of score from one sample of an entity to its next, NULL for the first."""
    stepped = with_previous(
        _timed(rows, block_seconds), ["entity"], ["_us", "arrival_seq"],
        ["sentiment_score"], "_block",
    )
    velocity = F.col("sentiment_score") - F.col("prev_sentiment_score")
    return stepped.withColumn("velocity", velocity).select(*rows.columns, "velocity")


def _moments(value: Column, window) -> Column:
    n = F.count(value).over(window)
    return F.struct(
        n.alias("n"),
        F.avg(value).over(window).alias("mean"),
        (F.var_pop(value).over(window) * n).alias("m2"),
        F.min(value).over(window).alias("lo"),
        F.max(value).over(window).alias("hi"),
    )


def _merged(parts: list[Column]) -> dict[str, Column]:
    """Moments of the union of disjoint sets; an empty part has ``n`` 0 and NULLs."""
    n = sum((p["n"] for p in parts[1:]), parts[0]["n"])
    count = F.greatest(n, F.lit(1)).cast("double")
    mean = sum((_or_zero(p["mean"]) * p["n"] for p in parts), F.lit(0.0)) / count

    def spread(p: Column) -> Column:
        off = _or_zero(p["mean"]) - mean
        return _or_zero(p["m2"]) + off * off * p["n"]

    deviation = F.sqrt(sum((spread(p) for p in parts), F.lit(0.0)) / count)
    flat = F.least(*[p["lo"] for p in parts]) == F.greatest(*[p["hi"] for p in parts])
    return {
        "n": n,
        "mean": F.when(n > 0, mean),
        "std": F.when(n > 0, F.when(flat, F.lit(0.0)).otherwise(deviation)),
    }


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _moment_struct(n: Column, mean: Column, m2: Column, lo: Column, hi: Column) -> Column:
    return F.struct(
        n.cast("bigint").alias("n"), mean.alias("mean"), m2.alias("m2"),
        lo.alias("lo"), hi.alias("hi"),
    )


def _one_step(step: Column) -> Column:
    present = F.when(step.isNull(), F.lit(0)).otherwise(F.lit(1))
    return _moment_struct(present, step, F.lit(0.0), step, step)


def _spans(in_cell: DataFrame, slices: int) -> DataFrame:
    """What lies between a cell and the one a window length earlier, per (entity, cell).

    Every cell sends its summary to the cells of the next window length but one, at most
    ``slices - 1`` of them, where the summaries are merged: ``_middle`` has the moments of
    all steps, those between the cells included.
    """
    summary = F.struct(
        F.col("_cell").alias("cell"), F.col("_rank").alias("samples"),
        F.col("_first_score").alias("first"), F.col("sentiment_score").alias("last"),
        F.col("_whole").alias("steps"),
    )
    reach = F.sequence(F.col("_cell") + 1, F.col("_cell") + F.lit(slices - 1))
    received = (
        in_cell.filter("_is_last")
        .select("entity", F.explode(reach).alias("_cell"), summary.alias("_summary"))
        .groupBy("entity", "_cell")
        .agg(F.array_sort(F.collect_list("_summary")).alias("_span"))
    )
    span, parts, mean = F.col("_span"), F.col("_parts"), F.col("_mean")
    between = F.transform(
        span, lambda c, i: _one_step(c["first"] - F.when(i > 0, F.get(span, i - 1)["last"]))
    )

    def total(value) -> Column:
        return F.aggregate(F.transform(parts, value), F.lit(0.0), lambda acc, x: acc + x)

    def spread(p: Column) -> Column:
        off = _or_zero(p["mean"]) - mean
        return _or_zero(p["m2"]) + off * off * p["n"]

    # Level by level, each computed once: the formulas use the level before repeatedly.
    joined = compute_once(
        received, {"_parts": F.concat(F.transform(span, lambda c: c["steps"]), between)}
    )
    counted = compute_once(joined, {"_n": total(lambda p: p["n"].cast("double"))})
    centred = compute_once(
        counted,
        {"_mean": total(lambda p: _or_zero(p["mean"]) * p["n"]) / F.greatest("_n", F.lit(1.0))},
    )
    middle = _moment_struct(
        F.col("_n"), F.when(F.col("_n") > 0, mean), total(spread),
        F.array_min(F.transform(parts, lambda p: p["lo"])),
        F.array_max(F.transform(parts, lambda p: p["hi"])),
    )
    return compute_once(
        centred,
        {
            "_middle": middle,
            "_middle_first": F.get(span, 0)["first"],
            "_middle_last": F.element_at(span, -1)["last"],
            "_middle_samples": F.aggregate(span, F.lit(0), lambda acc, c: acc + c["samples"]),
        },
    ).drop("_span", "_parts", "_n", "_mean")


def rolling_velocity_stats(
    rows: DataFrame, window_seconds: int = WINDOW_SECONDS, slices: int = SLICES
) -> DataFrame:
    """Each sample plus ``velocity``, ``n_samples``, ``mean_velocity``, ``std_velocity``.

    ``n_samples`` counts the window of ``window_seconds`` that ends with the sample, both
    bounds included. The baseline is made of the steps between the earlier samples of that
    window, so the current step and the step into the window are left out. ``velocity`` is
    NULL when the predecessor lies outside the window; equal steps have deviation 0.

    ``slices`` cuts the window length into that many cells, which different tasks take. Raise
    it for series so dense that one cell holds more rows than a task should sort; one cell is
    the least work for sparse series. It is a parameter and never derived from the data.
    """
    width = window_seconds * 1_000_000
    if slices < 1 or width % slices:
        raise ValueError(f"the window length in microseconds must divide into {slices} slices")
    score = F.col("sentiment_score")
    us = F.unix_micros("inferred_at")
    head = Window.partitionBy("entity", "_cell").orderBy("_us", "arrival_seq")
    before = head.rowsBetween(Window.unboundedPreceding, -1)
    so_far = head.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_cell = (
        rows.withColumns({"_us": us, "_cell": F.floor(us / F.lit(width // slices))})
        .withColumns(
            {
                "_step": score - F.lag("sentiment_score").over(head),
                "_prev_us": F.lag("_us").over(head),
                "_is_last": F.lead("_us").over(head).isNull(),
                "_rank": F.row_number().over(head),
                "_first_score": F.first("sentiment_score").over(so_far),
            }
        )
        .withColumn("_head", _moments(F.col("_step"), before))
    )
    carried = [*rows.columns, "_step", "_rank", "_first_score", "_head"]
    if slices > 1:
        spans = _spans(in_cell.withColumn("_whole", _moments(F.col("_step"), so_far)), slices)
        in_cell = in_cell.join(spans, ["entity", "_cell"], "left")
        carried += ["_middle", "_middle_first", "_middle_last", "_middle_samples"]

    # Second pass over the cell one window length earlier, in descending time. Each row sends
    # a lookup there, placed at its window start, and stays behind in its own cell as a step
    # (at the time of its predecessor) and, for the last row, as the sample that later cells
    # are entered from. A lookup sees what lies at or after its place; it comes last among
    # equal times because the bound is inclusive.
    payload = F.struct(*carried)
    payload_type = in_cell.select(payload).schema[0].dataType
    nothing, no_row = F.lit(None).cast("double"), F.lit(None).cast(payload_type)

    def record(cell: Column, at: Column, kind: int, step: Column, last: Column, row: Column):
        return F.struct(
            cell.alias("_cell"), at.alias("_at"), F.lit(kind).alias("_kind"),
            step.alias("_tail_step"), last.alias("_tail_last"), row.alias("_row"),
        )

    records = F.array(
        record(F.col("_cell") - slices, F.col("_us") - F.lit(width), 1, nothing, nothing, payload),
        F.when(F.col("_step").isNotNull(),
               record(F.col("_cell"), F.col("_prev_us"), 0, F.col("_step"), nothing, no_row)),
        F.when(F.col("_is_last"),
               record(F.col("_cell"), F.col("_us"), 0, nothing, score, no_row)),
    )
    tail = (
        Window.partitionBy("_entity", "_cell")
        .orderBy(F.col("_at").desc(), "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        in_cell.select(F.col("entity").alias("_entity"), F.inline(records))
        .filter("_kind is not null")
        .withColumns(
            {
                "_tail": _moments(F.col("_tail_step"), tail),
                "_entered_from": F.max("_tail_last").over(tail),
            }
        )
        .filter("_kind = 1")
        .select("_row.*", "_tail", "_entered_from")
    )

    # The steps between the parts: into the span or else into the own cell, and from the span
    # into the own cell. A step that ends in the current sample is its velocity instead.
    entered, is_first = F.col("_entered_from").isNotNull(), F.col("_rank") == 1
    came_from, skipped, parts = F.col("_entered_from"), F.lit(0), ["_tail", "_head", "_into"]
    into = F.when(~is_first, F.col("_first_score") - F.col("_entered_from"))
    if slices > 1:
        last_seen, first_seen = F.col("_middle_last"), F.col("_middle_first")
        came_from = F.coalesce(last_seen, came_from)
        skipped = F.coalesce(F.col("_middle_samples"), F.lit(0))
        out_of = F.when(~is_first, F.col("_first_score") - last_seen)
        found = found.withColumn(
            "_middle", F.coalesce("_middle", _one_step(nothing))
        ).withColumn("_out_of", _one_step(out_of))
        into = F.when(first_seen.isNotNull(), first_seen - F.col("_entered_from")).otherwise(into)
        parts += ["_middle", "_out_of"]
    found = found.withColumn("_into", _one_step(into))
    # filters on the merged columns must not repeat the formula
    merged = _merged([F.col(p) for p in parts])
    found = compute_once(found, {f"_base_{n}": c for n, c in merged.items()})
    base = {n: F.col(f"_base_{n}") for n in merged}
    # All samples of the earlier cell but its last are predecessors of a tail step.
    earlier = F.when(entered, F.col("_tail.n") + 1).otherwise(F.lit(0))
    return found.select(
        *rows.columns,
        F.when(is_first, score - came_from).otherwise(F.col("_step")).alias("velocity"),
        (F.col("_rank") + skipped + earlier).alias("n_samples"),
        base["n"].alias("n_baseline"),
        base["mean"].alias("mean_velocity"),
        base["std"].alias("std_velocity"),
    )


def detect_shocks(
    rows: DataFrame,
    window_seconds: int = WINDOW_SECONDS,
    threshold: float = THRESHOLD,
    min_samples: int = MIN_SAMPLES,
    slices: int = SLICES,
) -> DataFrame:
    """Samples whose step is at least ``threshold`` deviations off the recent baseline.

    A heuristic, not a prediction. ``triggered_at`` is the arrival time of the sample.
    """
    needed = max(LEAST_SAMPLES, min_samples)
    zscore = (F.col("velocity") - F.col("mean_velocity")) / F.col("std_velocity")
    return (
        rolling_velocity_stats(rows, window_seconds, slices)
        .filter((F.col("n_samples") >= needed) & (F.col("std_velocity") > 0))
        .withColumn("zscore", zscore)
        .filter(F.abs("zscore") >= threshold)
        .select(
            "entity", "item_id", "zscore", "velocity", "mean_velocity", "std_velocity",
            F.lit(window_seconds).alias("window_seconds"),
            F.lit(float(threshold)).alias("threshold"),
            "sentiment_score",
            F.col("inferred_at").alias("triggered_at"),
        )
    )


def recent_entity_samples(
    rows: DataFrame, entity: str, window_seconds: int, as_of: Column
) -> DataFrame:
    """Samples of one entity in the window ending at ``as_of``, both bounds included."""
    since = as_of - F.expr(f"interval {int(window_seconds)} seconds")
    return (
        rows.filter((F.col("entity") == entity) & F.col("inferred_at").between(since, as_of))
        .select("inferred_at", "arrival_seq", "sentiment_score")
        .orderBy("inferred_at", "arrival_seq")
    )


def recent_samples_bulk(
    rows: DataFrame, asks: DataFrame, window_seconds: int, slices: int = 1
) -> DataFrame:
    """For every row of ``asks`` the samples of its entity in the window that ends at ``as_of``.

    One row per ask and sample: the columns of ``asks`` with ``inferred_at``, ``arrival_seq``
    and ``sentiment_score``; both bounds are included, and asks without samples have no row.
    Time is cut into cells, an ask looks into the ``slices + 1`` cells that its window
    touches, and the join is on (entity, cell), so an entity that holds most rows is spread
    over its cells. More ``slices`` make smaller cells for denser series. Null entities and
    null times meet nothing.
    """
    width = F.lit(window_seconds * 1_000_000 // slices)
    us, end = F.unix_micros("inferred_at"), F.unix_micros("as_of")
    begin = end - F.lit(window_seconds * 1_000_000)
    looking = asks.select("*", F.explode(
        F.sequence(F.floor(begin / width), F.floor(end / width))
    ).alias("ask_cell"))
    samples = rows.select(
        F.col("entity").alias("sample_entity"), "inferred_at", "arrival_seq", "sentiment_score",
        F.floor(us / width).alias("sample_cell"),
    )
    near = (F.col("entity") == F.col("sample_entity")) & (F.col("ask_cell") == F.col("sample_cell"))
    return (
        looking.join(samples, near & us.between(begin, end))
        .select(*asks.columns, "inferred_at", "arrival_seq", "sentiment_score")
    )
