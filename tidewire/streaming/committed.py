"""Tables that a stream extends batch by batch, and that show whole batches only.

A batch writes its folder of every table and then commits all of them at once, by a marker
file. Readers take the folders that markers name, so they never see a table ahead of another
one or half a batch; a batch that is repeated after its commit changes nothing. Compaction
writes the folders of many batches as one and commits that in their place.
"""

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Reduce = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True, order=True)
class Commit:
    """Batches ``first`` to ``last`` of a run, in one folder of each table."""

    run: str
    first: int
    last: int

    @property
    def folder(self) -> str:
        return f"run={self.run}/batches={self.first}-{self.last}"

    def within(self, other: "Commit") -> bool:
        return self != other and (self.run, True, True) == (
            other.run, other.first <= self.first, self.last <= other.last
        )


class CommittedTables:
    """``tables`` maps names to schemas and the columns that their folders are cut by.

    ``run`` names one checkpoint; a new one, whose batches count from 0 again, is another run
    of the same tables. One query writes a run at a time.
    """

    def __init__(
        self, base: str, tables: Mapping[str, tuple[T.StructType | str, tuple[str, ...]]],
        run: str = "a",
    ):
        self.base, self.run = base.rstrip("/"), run
        self.tables = {
            name: (T._parse_datatype_string(kind) if isinstance(kind, str) else kind, cuts)
            for name, (kind, cuts) in tables.items()
        }

    # --- commits -------------------------------------------------------------------------

    def _path(self, spark: SparkSession, path: str):
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _every_commit(self, spark: SparkSession) -> list[Commit]:
        where, files = self._path(spark, f"{self.base}/commits/run=*/*")
        found = []
        for status in files.globStatus(where) or []:
            first, last = status.getPath().getName().split("-")
            run = status.getPath().getParent().getName().removeprefix("run=")
            found.append(Commit(run, int(first), int(last)))
        return sorted(found)

    def commits(self, spark: SparkSession) -> list[Commit]:
        """The commits in force: those that no compaction stands for."""
        every = self._every_commit(spark)
        return [c for c in every if not any(c.within(other) for other in every)]

    def is_committed(self, spark: SparkSession, batch_id: int) -> bool:
        return any(
            c.run == self.run and c.first <= batch_id <= c.last for c in self.commits(spark)
        )

    def _mark(self, spark: SparkSession, commit: Commit) -> None:
        where, files = self._path(
            spark, f"{self.base}/commits/run={commit.run}/{commit.first}-{commit.last}"
        )
        files.create(where, True).close()

    # --- reading -------------------------------------------------------------------------

    def _shape(self, name: str) -> T.StructType:
        kind, cuts = self.tables[name]
        return T.StructType([
            *kind, T.StructField("run", T.StringType()), T.StructField("batches", T.StringType()),
        ])

    def _folders(self, spark: SparkSession, name: str, commits: list[Commit]) -> DataFrame:
        shape = self._shape(name)
        if not commits:
            return spark.createDataFrame([], shape)
        where = f"{self.base}/{name}"
        return spark.read.schema(shape).option("basePath", where).parquet(
            *[f"{where}/{c.folder}" for c in commits]
        ).select(*shape.names)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """All committed rows of a table."""
        return self._folders(spark, name, self.commits(spark)).drop("run", "batches")

    def own(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        """What ``put`` wrote for a batch, committed or not."""
        commit = Commit(self.run, batch_id, batch_id)
        return self._folders(spark, name, [commit]).drop("run", "batches")

    # --- writing -------------------------------------------------------------------------

    def put(self, name: str, batch_id: int, rows: DataFrame) -> None:
        """Write the rows of a batch; they count once the batch is committed."""
        self._write(name, Commit(self.run, batch_id, batch_id), rows)

    def _write(self, name: str, commit: Commit, rows: DataFrame) -> None:
        kind, cuts = self.tables[name]
        # the rows of a cut meet, so that it gets a file and not one per task; large cuts are split
        rows = rows.select(*kind.names).hint("rebalance", *cuts) if cuts else rows.select(*kind.names)
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*cuts) if cuts else writer).parquet(f"{self.base}/{name}/{commit.folder}")

    def commit(self, spark: SparkSession, batch_id: int) -> None:
        """All tables of the batch come into force together."""
        self._mark(spark, Commit(self.run, batch_id, batch_id))

    def compact(
        self, spark: SparkSession, least: int = 32, reduce: Mapping[str, Reduce] | None = None
    ) -> Commit | None:
        """Batches committed one by one become one folder, if there are ``least`` of them.

        Each table is dealt to one task per value of its cuts, so that small files of many
        batches become one. ``reduce`` may leave out rows that others stand for. The folders
        that were replaced stay for readers that have begun, until ``clean``.
        """
        single = [c for c in self.commits(spark) if c.run == self.run and c.first == c.last]
        if len(single) < max(least, 2):
            return None
        whole = Commit(self.run, single[0].first, single[-1].last)
        for name, (_, cuts) in self.tables.items():
            rows = self._folders(spark, name, single).drop("run", "batches")
            rows = (reduce or {}).get(name, lambda x: x)(rows)
            self._write(name, whole, rows if cuts else rows.hint("rebalance"))
        self._mark(spark, whole)
        return whole

    def clean(self, spark: SparkSession) -> int:
        """Delete what compaction replaced; to be called when no reader is on it any more."""
        every = self._every_commit(spark)
        gone = [c for c in every if any(c.within(other) for other in every)]
        for commit in gone:
            for name in self.tables:
                where, files = self._path(spark, f"{self.base}/{name}/{commit.folder}")
                files.delete(where, True)
            where, files = self._path(
                spark, f"{self.base}/commits/run={commit.run}/{commit.first}-{commit.last}"
            )
            files.delete(where, False)
        return len(gone)


def writer(
    tables: CommittedTables, make: Callable[[DataFrame, int], Mapping[str, DataFrame]],
    compact_every: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """Batch writer of the tables that ``make`` derives from a batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if tables.is_committed(spark, batch_id):
            return
        batch.persist()
        try:
            for name, rows in make(batch, batch_id).items():
                tables.put(name, batch_id, rows)
        finally:
            batch.unpersist()
        tables.commit(spark, batch_id)
        if compact_every:
            tables.compact(spark, compact_every)

    return write


# --- Event time --------------------------------------------------------------------------

_MARK = "watermark timestamp"


def late_tables(base: str, rows: T.StructType, run: str = "a") -> CommittedTables:
    """Tables ``timely`` and ``late`` of ``rows``, and the watermark that every batch leaves."""
    return CommittedTables(
        base, {"timely": (rows, ()), "late": (rows, ()), "marks": (_MARK, ())}, run
    )


def late_writer(
    tables: CommittedTables, event_time: str, delay_seconds: int, compact_every: int | None = 32
) -> Callable[[DataFrame, int], None]:
    """Rows by event time: those behind the watermark go to a side table, none is lost.

    The watermark of a batch is the greatest event time of all earlier batches less the delay,
    as in windowed queries of the engine, which drop such rows; it never falls back. The first
    batch has none. Rows without an event time cannot be placed in time and count as late.
    """
    delay = F.expr(f"interval {int(delay_seconds)} seconds")

    def make(batch: DataFrame, batch_id: int) -> Mapping[str, DataFrame]:
        spark = batch.sparkSession
        mark = tables.read(spark, "marks").agg(F.max("watermark")).first()[0]
        is_late = F.col(event_time).isNull()
        if mark is not None:
            is_late = is_late | (F.col(event_time) < F.lit(mark))
        reached = batch.agg((F.max(event_time) - delay).alias("watermark"))
        return {
            "timely": batch.filter(~is_late), "late": batch.filter(is_late),
            "marks": reached.filter("watermark is not null"),
        }

    return writer(tables, make, compact_every)
