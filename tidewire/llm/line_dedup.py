"""Line dedup by distinct-site spread: sketches per line, exact counts near the threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import SPACE, WORD_CLASS, settle

#: A line on this many sites is boilerplate.
MIN_SITES = 10
#: Sketch size (log2) and the relative band around the threshold that is counted exactly:
#: over six standard errors of a sketch of this size.
SKETCH_BITS = 12
BAND = 0.1


def _line_keys(text: Column) -> Column:
    """Two independent hashes (96 bits) of every line with a word, without outer blanks."""
    lines = F.transform(F.split(text, "\n"), lambda line: F.trim(line, F.lit(SPACE)))
    return F.transform(F.filter(lines, lambda line: line != ""), _line_key)


def _line_key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("line"), F.hash(line).alias("tag"))


def boilerplate(
    docs: DataFrame, min_sites: int = MIN_SITES, *, key: str = "doc_id", text: str = "text",
    site: str = "source",
) -> DataFrame:
    """``doc_id, line, tag`` of every occurrence of a boilerplate line beyond its first document.

    A line is boilerplate if ``min_sites`` distinct sites have it; its document with the
    smallest id keeps it. Lines with fewer occurrences than that are out after a count; the
    sites of the others are sketched in the map tasks and merged, and only lines whose
    estimate is near the threshold are counted exactly. Null sites count as no site.
    """
    lines = docs.select(
        F.col(key).alias("doc_id"), F.col(site).alias("site"),
        F.explode(_line_keys(F.col(text))).alias("at"),
    ).select("doc_id", "site", "at.line", "at.tag")
    by_line = ["line", "tag"]
    frequent = lines.groupBy(*by_line).agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= min_sites
    ).drop("n")
    seen = settle(lines.join(frequent, by_line, "left_semi"))
    spread = settle(
        seen.groupBy(*by_line).agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("sites"),
            F.min("doc_id").alias("first_doc"),
        )
    )
    near = F.coalesce(F.col("sites"), F.lit(0)).between(
        min_sites * (1 - BAND) - 1, min_sites * (1 + BAND) + 1
    )
    # a pair of line and site once per task before lines meet: a very common line is few rows
    pairs = seen.filter(F.col("site").isNotNull()).select(*by_line, "site").distinct()
    exact = (
        pairs.join(spread.filter(near).select(*by_line), by_line, "left_semi")
        .groupBy(*by_line).agg(F.count(F.lit(1)).alias("exact_sites"))
    )
    wide = (
        spread.join(exact, by_line, "left")
        .filter(F.coalesce("exact_sites", "sites", F.lit(0)) >= min_sites).select(*by_line, "first_doc")
    )
    return seen.join(wide, by_line).filter(
        F.col("first_doc").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first_doc"))
    ).select("doc_id", *by_line)


def dedup_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, *, key: str = "doc_id", text: str = "text",
    site: str = "source",
) -> DataFrame:
    """``docs`` without later copies of boilerplate lines, all rows and columns kept, with
    ``n_lines`` (lines with a word, before) and ``n_removed`` added or replaced.

    Lines without a word stay. A null text stays null with no lines; a text of boilerplate
    alone becomes what is left between, maybe empty. Rows with one id count as one document.
    Rows without an id are later than all others. Only texts that lose a line are rebuilt.
    """
    gone = (
        boilerplate(docs, min_sites, key=key, text=text, site=site)
        .groupBy("doc_id").agg(F.collect_set(F.struct("line", "tag")).alias("tw_gone"))
        .withColumnRenamed("doc_id", "tw_gone_id")
    )
    whole = F.col(text)

    def stays(line: Column) -> Column:
        bare = F.trim(line, F.lit(SPACE))
        return (bare == "") | ~F.array_contains("tw_gone", _line_key(bare))

    left = F.array_join(F.filter(F.split(whole, "\n"), stays), "\n")

    def count(of: Column) -> Column:
        lines = F.filter(F.split(F.coalesce(of, F.lit("")), "\n"), lambda x: x.rlike(WORD_CLASS))
        return F.size(lines).cast("long")

    rest = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = docs.join(gone, docs[key].eqNullSafe(F.col("tw_gone_id")), "left").select(
        *[docs[c] for c in rest if c != text], docs[text].alias("tw_before"), "tw_gone",
        F.when(F.col("tw_gone").isNull(), whole).otherwise(left).alias(text),
    )
    before = count(F.col("tw_before"))
    return rows.select(
        *rest, before.alias("n_lines"),
        F.when(F.col("tw_gone").isNull(), F.lit(0).cast("long"))
        .otherwise(before - count(F.col(text))).alias("n_removed"),
    )
