"""Which filters of a chain do the work: every order of them, enumerated by a recursive query.

A document is a mask of the filters it fails, a part of the corpus is at most ``2 ** filters``
cells, and all that is asked about an order follows from the cells. A recursive common table
expression extends prefixes of filters by unused letters: a level joins the cells of the
filters applied so far, carries their bits and emits the figures of its step.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidewire.functions.columns import compute_once
from tidewire.llm.common import settle, words

MIN_WORDS = 50
DISTINCT_PERCENT = 65
UPPER_PERCENT = 5
SYMBOLS = "[#$%&*|]"

#: The filter that a text fails if a document with a smaller id has the same text.
COPIES = "E"

FIGURES = (
    "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
)
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def text_filters() -> dict[str, Column]:
    """Failure conditions by letter, over ``text`` (not null) and its ``own_words``."""
    text, own = F.col("text"), F.col("own_words")
    return {
        "A": F.size(own) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(own)) < DISTINCT_PERCENT * F.size(own),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > UPPER_PERCENT * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def _mask(filters: Mapping[str, Column]) -> Column:
    total = F.lit(0)
    for place, failed in enumerate(filters.values()):
        total = total + F.when(failed, 1 << place).otherwise(0)
    return total


def failure_cells(
    docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None, *,
    key: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """``part, mask, docs, good, toxic``: documents by the filters they fail.

    Bit k of the mask is the k-th filter, the last bit that of copies. A text is known by its
    256-bit digest, and only digests are shuffled. Equal texts of a task meet before the
    shuffle, so a text of a third of all rows sends a few rows per task; how many of its
    documents have the smallest id is carried along, and they alone are no copies.
    """
    filters = text_filters() if filters is None else filters
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
        body.alias("text"),
    )
    rows = compute_once(rows, {"own_words": words(F.col("text"))}).select(
        "id", "part", _mask(filters).alias("mask"),
        F.unhex(F.sha2(F.col("text"), 256)).alias("digest"),
    )
    ids = rows.groupBy("id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.groupBy(F.col(key).alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    ids = ids.join(marks, F.col("id") == F.col("label_id"), "left").select(
        "id", "part", "mask", "digest", "n", *[
            F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")
        ],
    )
    known = F.when(F.col("id").isNotNull(), F.struct("id", "n"))
    texts = ids.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(known).alias("least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unknown"),
    )
    first = texts.groupBy(F.col("digest").alias("f_digest")).agg(F.min("least.id").alias("first_id"))
    texts = texts.join(first, F.col("digest") == F.col("f_digest"))
    originals = F.col("unknown") + F.when(
        F.col("least.id") == F.col("first_id"), F.col("least.n")
    ).otherwise(0)
    copy_bit = 1 << len(filters)
    split = F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), originals.alias("docs")),
        F.struct((F.col("mask") + copy_bit).alias("mask"), (F.col("n") - originals).alias("docs")),
    ))
    return (
        texts.select("part", "good", "toxic", split).filter("docs > 0")
        .groupBy("part", "mask").agg(
            F.sum("docs").alias("docs"), F.sum(F.col("docs") * F.col("good")).alias("good"),
            F.sum(F.col("docs") * F.col("toxic")).alias("toxic"),
        )
    )


def step_figures(cells: DataFrame, letters: str) -> DataFrame:
    """``part, applied, letter, bit`` and figures: what a filter does after those applied.

    A part has ``letters * 2 ** (letters - 1)`` rows, made of its cells without a join. The
    Shapley figure of a filter weighs every set applied before it by the orders that start
    with the set and go on with the filter.
    """
    n = len(letters)
    steps = F.inline(F.array(*[
        F.struct(
            F.lit(applied).alias("applied"), F.lit(letter).alias("letter"),
            F.lit(1 << place).alias("bit"),
            F.lit(math.factorial(applied.bit_count()) * math.factorial(n - 1 - applied.bit_count()))
            .alias("orders"),
        )
        for applied in range(1 << n) for place, letter in enumerate(letters)
        if not applied >> place & 1
    ]))
    mask, applied, bit = F.col("mask"), F.col("applied"), F.col("bit")
    reaches = mask.bitwiseAND(applied) == 0
    fails = mask.bitwiseAND(bit) != 0

    def total(condition: Column, what: str = "docs") -> Column:
        return F.sum(F.when(condition, F.col(what)).otherwise(0))

    by_letter = Window.partitionBy("part", "letter")
    return (
        cells.select("*", steps)
        .groupBy("part", "applied", "letter", "bit", "orders").agg(
            total(reaches & ~fails).alias("kept"), total(reaches & fails).alias("removed"),
            total(~reaches & fails).alias("redundant"), total(mask == bit).alias("unique_fails"),
            total(reaches & fails, "good").alias("good_lost"),
            total(reaches & fails, "toxic").alias("toxic_lost"),
        )
        .withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(by_letter))
        .drop("orders")
    )


@contextmanager
def _all_rows(spark: SparkSession) -> Iterator[None]:
    """The walk has 326 rows a part; the guard against endless recursion counts rows."""
    before = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.set(_ROW_LIMIT, before)


def walk_orders(figures: DataFrame, n_filters: int) -> DataFrame:
    """``part, filter_order, step`` and figures, for every order of the filters.

    The recursion starts with an empty prefix per part; its depth is the number of filters.
    The cells of a set of filters are found by part and bits, so every level is one join of
    two tables that both have rows for every part. Complete orders unfold into their steps.
    """
    spark = figures.sparkSession
    emitted = ", ".join(f"'{c}', c.{c}" for c in FIGURES)
    kinds = ", ".join(f"{c}: bigint" for c in FIGURES)
    with _all_rows(spark):
        walk = settle(spark.sql(
            f"""
            WITH RECURSIVE walk AS (
              SELECT DISTINCT part, '' AS filter_order, 0 AS applied,
                CAST(array() AS array<struct<{kinds}>>) AS steps
              FROM {{figures}}
              UNION ALL
              SELECT w.part, concat(w.filter_order, c.letter), w.applied | c.bit,
                array_append(w.steps, named_struct({emitted}))
              FROM walk w JOIN {{figures}} c ON c.part = w.part AND c.applied = w.applied
            )
            SELECT part, filter_order, steps FROM walk WHERE length(filter_order) = {n_filters}
            """,
            figures=figures,
        ))
    return walk.select("part", "filter_order", F.posexplode("steps").alias("at", "x")).select(
        "part", "filter_order", (F.col("at") + 1).alias("step"), *[f"x.{c}" for c in FIGURES]
    )


def audit(
    docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None, *,
    key: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """One row per part, order of the filters and step, with document counts.

    Columns: ``part``, ``filter_order`` (letters, applied left to right), ``step`` (from 1; its
    filter is that letter), ``kept`` after the step, ``removed`` by it, ``redundant`` (failing,
    but removed before), ``unique_fails`` (failing this filter only), ``good_lost`` and
    ``toxic_lost`` (removed with label ``quality`` or ``toxic`` 1), ``shapley`` (removed by
    this filter, summed over all orders).

    ``filters`` maps letters to failure conditions (see ``text_filters``); the filter of copies
    is always added last. Null texts are empty texts, a null part is the empty one. Repeated
    rows count each; rows of one id are no copies of each other, nor does a null id make or
    have copies. Labels of one id are merged, a 1 wins; null labels count as 0. An empty table
    gives no row. Extra columns are ignored.
    """
    letters = "".join(text_filters() if filters is None else filters) + COPIES
    cells = failure_cells(docs, labels, filters, key=key, text=text, part=part)
    return walk_orders(settle(step_figures(cells, letters)), len(letters))
