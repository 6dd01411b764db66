"""Helpers of the corpus operators: words, folds, settled intermediates, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.session import shared_dir

#: White space between words: blank and the controls 9 to 13.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts give an empty one."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, SPACE_CLASS + "+")
    )


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def fold(key: Column, folds: int = 5) -> Column:
    """Fold of a row: the checksum of its id as text, so that it needs no seed."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


def settle(rows: DataFrame) -> DataFrame:
    """``rows`` computed once and kept in the shared checkpoint folder.

    Later steps read the files: a lost executor costs no recomputation, and two steps never
    see different results of an order-dependent step. The folder is ``spark.checkpoint.dir``;
    a local session without one gets its own.
    """
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(rows.sparkSession))
    return rows.checkpoint(eager=True)


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of the edges; the root is the smallest reachable node.

    Alternating large-star and small-star steps: every step is one minimum per node and one
    join, so a node with very many edges is split like any other join key, and the number of
    steps is logarithmic in the longest path. Null ends and loops are ignored.
    """
    pairs = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    pairs = settle(pairs)
    before = None
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(roots, "u").filter("v > m").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        pairs = settle(
            hooked.unionByName(roots.select("u", F.col("m").alias("v"))).distinct()
        )
        now = pairs.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if now == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
