"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import WORD_CLASS, settle

#: Weights of the sources in code-point order (null last), repeating.
WEIGHTS = (5, 2, 1)
#: The mix holds this share of all words; a source is repeated this often at most.
BUDGET = 1.5
PASSES = 2
#: Buckets of one source's queue. A bucket is what one task orders, so a source of any share
#: of the corpus spreads over all of them.
QUEUE_BUCKETS = 1024
SEED = "mix"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS + "+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    passes: int = PASSES,
) -> DataFrame:
    """``source, source_size, target`` for rows of ``source, size``.

    Sources share ``budget`` times all words by weight. No target is above ``passes`` times
    its source's size: the excess is shared again by weight among the others until none is
    above. Every round reads one row, so any number of sources works.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    totals = settle(totals.withColumn("weight", weight))
    limit = passes * F.col("source_size")
    everything = totals.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * level > limit
        full, still, n = totals.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(over, 1)),
        ).first()
        if n == capped or not still:
            break
        level, capped = (budget * everything - full) / still, n
    target = F.least(F.col("weight") * level, limit.cast("double"))
    return totals.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    passes: int = PASSES,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``.

    Every source is a queue of its documents in an order shuffled by a hash of the id, played
    ``passes`` times. A document's virtual finish time is the words of its queue up to and
    including it, divided by the source's target. All queue entries are range-sorted by that
    time and cut where their words reach the total budget; equal times stand or fall together.
    ``copies`` says how often a document is in the mix, ``taken`` is that times its size.

    Null and blank texts have size 0, are taken 0 words and have no copy. A null source is a
    source of its own. Repeated ids and repeated rows are separate documents; rows equal in
    id and size may swap places, which changes no result. Without words nothing is taken.
    The order within a source is computed bucket by bucket of the hash, with the buckets'
    totals as offsets, so no task holds a source.
    """
    rows = settle(
        docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"),
                    n_words(F.col(text)).alias("size"))
    )
    targets = source_targets(rows, weights, budget, passes)

    shuffled = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    queue = rows.filter("size > 0").select("*", shuffled.alias("place")).withColumn(
        "bucket", F.conv(F.substring("place", 1, 8), 16, 10).cast("long") % QUEUE_BUCKETS
    )
    within = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0
    )
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        queue.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        .select(F.col("source").alias("o_source"), F.col("bucket").alias("o_bucket"),
                F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    )
    target_of = targets.withColumnRenamed("source", "t_source")
    served = (
        queue.withColumn("words", F.sum("size").over(within))
        .join(offsets, F.col("source").eqNullSafe(F.col("o_source"))
              & (F.col("bucket") == F.col("o_bucket")))
        .join(target_of, F.col("source").eqNullSafe(F.col("t_source")))
    )
    played = F.col("before") + F.col("words")
    served = settle(
        served.select(
            "doc_id", "source", "size", "source_size", "target",
            *[((played + F.col("source_size") * p) / F.col("target")).alias(f"finish_{p}")
              for p in range(passes)],
        )
    )
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    last = _last_finish(served, budget * total, passes)
    copies = sum((F.col(f"finish_{p}") <= last).cast("long") for p in range(passes))
    taken = served.select("doc_id", "source", "size", "source_size", "target",
                          copies.alias("copies"), (copies * F.col("size")).alias("taken"))
    empty = (
        rows.filter("size = 0")
        .join(target_of, F.col("source").eqNullSafe(F.col("t_source")))
        .select("doc_id", "source", "size", "source_size", "target",
                F.lit(0).cast("long").alias("copies"), F.lit(0).cast("long").alias("taken"))
    )
    return taken.unionByName(empty)


def _last_finish(served: DataFrame, budget: float, passes: int) -> float:
    """The largest finish time at which all entries up to it fit the budget.

    The range-sorted entries are settled with the number of their partition; the partitions'
    totals say in which one the budget ends, and only that one is summed up row by row.
    """
    entries = served.select(
        F.explode(F.array(*[F.col(f"finish_{p}") for p in range(passes)])).alias("finish"), "size"
    )
    parts = int(served.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = settle(
        entries.repartitionByRange(parts, "finish").withColumn("part", F.spark_partition_id())
    )
    filled, last = 0, -1.0
    totals = ordered.groupBy("part").agg(F.sum("size").alias("words"), F.max("finish").alias("end"))
    for part, words, end in sorted(totals.collect()):
        if filled + words > budget:
            running = F.sum("size").over(Window.partitionBy("part").orderBy("finish"))
            inside = ordered.filter(F.col("part") == part).withColumn("running", running).filter(
                F.col("running") + filled <= budget
            ).agg(F.max("finish")).first()[0]
            return last if inside is None else inside
        filled, last = filled + words, end
    return last


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: dropped, once or repeated; same columns.

    Rows equal in id, source and size share their copies as evenly as whole numbers go, so the
    mix has as many words as ``mix`` takes, repeated rows or not; which of them has one copy
    more is not fixed.
    """
    key, text, source = (options.get(n, d) for n, d in
                         (("key", "doc_id"), ("text", "text"), ("source", "source")))
    n, copies = F.count(F.lit(1)), F.sum("copies")
    taken = settle(
        mix(docs, **options).groupBy("doc_id", "source", "size")
        .agg(F.floor(copies / n).alias("each"), (copies % n).alias("more")).filter("each + more > 0")
        .toDF("m_doc_id", "m_source", "m_size", "m_each", "m_more")
    )
    kept = docs.join(
        taken,
        docs[key].cast("long").eqNullSafe(F.col("m_doc_id"))
        & docs[source].eqNullSafe(F.col("m_source"))
        & (n_words(docs[text]) == F.col("m_size")),
    ).select(*[docs[c].alias(f"d_{c}") for c in docs.columns], *taken.columns)

    def repeated(rows: DataFrame, copies: Column) -> DataFrame:
        return rows.filter(copies > 0).select(
            *[F.col(f"d_{c}").alias(c) for c in docs.columns],
            F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("m_copy"),
        ).drop("m_copy")

    even = repeated(kept.filter("m_more = 0"), F.col("m_each"))
    if taken.filter("m_more > 0").isEmpty():
        return even
    group = Window.partitionBy("m_doc_id", "m_source", "m_size").orderBy(F.lit(0))
    uneven = kept.filter("m_more > 0").withColumn("m_place", F.row_number().over(group))
    more = F.when(F.col("m_place") <= F.col("m_more"), 1).otherwise(0)
    return even.unionByName(repeated(uneven, F.col("m_each") + more))
