"""Quality classifier: random Fourier features, summed normal equations, isotonic scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm import hashing
from tidewire.llm.common import fold, settle

FEATURES = 128
RIDGE = 1.0
#: Standardized statistics are cut here, so that one odd text does not rule the kernel.
CUT = 4.0
BINS = 1000
THRESHOLD = 0.3
#: Features and statistics are multiples of 1 / GRID, scores of 1 / SCORE_GRID, so that their
#: sums are exact and do not depend on the order of rows, batches and partitions.
GRID, SCORE_GRID = 1 << 16, 1 << 30
#: Fold that calibrates; fold 0 is held out and the others fit the weights.
CALIBRATION_FOLD = 1

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "blank", "newline", "high",
    "stops", "marks", "symbols", "distinct_words", "repeated_next", "distinct_shingles",
    "log_line_words", "first_last",
)

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "blank": b" \t",
    "newline": b"\n", "stops": b".,;:", "marks": b"!?\"'()-", "symbols": b"#*$%&|<>@_/\\=+~^{}[]",
}


def _statistics(texts: pa.Array) -> np.ndarray:
    """A row of STATISTICS for every text."""
    rows = []
    for _, data, offsets in hashing.byte_chunks(texts):
        sizes = np.diff(offsets)
        running = {}
        for name, members in _CLASSES.items():
            wanted = np.zeros(256, bool)
            wanted[list(members)] = True
            running[name] = np.concatenate([[0], np.cumsum(wanted[data])])
        running["high"] = np.concatenate([[0], np.cumsum(data >= 128)])
        counts = {n: r[offsets[1:]] - r[offsets[:-1]] for n, r in running.items()}
        words, before = hashing.word_hashes(data, offsets)
        for i, size in enumerate(sizes):
            own = words[before[i]: before[i + 1]]
            n, size = max(len(own), 1), max(size, 1)
            c = {name: v[i] / size for name, v in counts.items()}
            kinds = len(np.unique(own))
            spread = max(len(own) - 4, 1)
            rows.append((
                np.log1p(size), np.log1p(len(own)), min((size - counts["blank"][i]) / n, 40.0),
                c["upper"], c["digit"], c["blank"], c["newline"], c["high"], c["stops"],
                c["marks"], c["symbols"], kinds / n,
                np.count_nonzero(own[1:] == own[:-1]) / n,
                len(hashing.shingles(own)) / spread if len(own) else 0.0,
                np.log1p(n / (counts["newline"][i] + 1)),
                kinds / np.sqrt(n),
            ))
    return np.array(rows, np.float64).reshape(-1, len(STATISTICS))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _statistics(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(found[:, i]) for i in range(len(STATISTICS))]],
            names=["doc_id", *STATISTICS],
        )


def _features(batch: pa.RecordBatch, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Cosines of random projections: inner products approximate a Gaussian kernel.

    The kernel's width is the square root of the number of statistics, the expected distance
    of standardized ones. The last feature is constant.
    """
    columns = [batch.column(batch.schema.get_field_index(n)).to_numpy() for n in STATISTICS]
    x = np.clip((np.column_stack(columns) - mean) / scale, -CUT, CUT)
    random = np.random.default_rng(3)
    directions = random.standard_normal((len(STATISTICS), FEATURES)) / len(STATISTICS) ** 0.5
    phase = random.uniform(0, 2 * np.pi, FEATURES)
    waves = np.cos(x @ directions + phase) * (2 / FEATURES) ** 0.5
    return np.column_stack([np.rint(waves * GRID) / GRID, np.ones(len(x))])


def _normal_sums(mean: np.ndarray, scale: np.ndarray) -> Callable:
    """Sums of a partition for the normal equations: rows ``i, j, value``, j = -1 for the target.

    Values are in units of GRID ** -2. Sums of a batch of up to 2 ** 21 rows are exact in double
    precision, those of a partition in 64 bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square = np.zeros((FEATURES + 1,) * 2, np.int64)
        aim = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            z = _features(batch, mean, scale)
            label = batch.column(batch.schema.get_field_index("label")).to_numpy()
            square += np.rint(z.T @ z * GRID**2).astype(np.int64)
            aim += np.rint(z.T @ label * GRID**2).astype(np.int64)
        i, j = np.triu_indices(FEATURES + 1)
        every = np.arange(FEATURES + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([i, every]).astype(np.int32)),
             pa.array(np.concatenate([j, np.full(FEATURES + 1, -1)]).astype(np.int32)),
             pa.array(np.concatenate([square[i, j], aim]))],
            names=["i", "j", "value"],
        )

    return run


def _scores(mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, curve: tuple | None = None):
    """``doc_id, label, raw`` of every row; with the calibration curve, scores of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.rint(_features(batch, mean, scale) @ weights * SCORE_GRID) / SCORE_GRID
            if curve is not None:
                raw = np.rint(np.interp(raw, *curve) * SCORE_GRID) / SCORE_GRID
            keep = [batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "label")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(raw)], names=["doc_id", "label", "raw"]
            )

    return run


def isotonic(value: np.ndarray, hits: np.ndarray, total: np.ndarray) -> tuple[list, list]:
    """Points of the non-decreasing curve nearest to ``hits / total`` at ascending ``value``.

    Pooled neighbours become one point at their mean value; between points the curve is linear.
    """
    blocks: list[list[float]] = []
    for v, h, n in zip(value, hits, total):
        blocks.append([v * n, h, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return [b[0] / b[2] for b in blocks], [b[1] / b[2] for b in blocks]


def _moments(measured: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every statistic, from exact sums."""
    cells = [(F.col(n) * GRID).cast("decimal(18,0)") for n in STATISTICS]
    n, *sums = measured.agg(
        F.count(F.lit(1)), *[F.sum(x) for x in cells], *[F.sum(x * x) for x in cells]
    ).first()
    if not n:
        return np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))
    first, second = (list(map(int, x)) for x in (sums[: len(cells)], sums[len(cells):]))
    mean = np.array([s / (n * GRID) for s in first])
    scale = np.sqrt([(q * n - s * s) / (n * GRID) ** 2 for s, q in zip(first, second)])
    return mean, np.where(scale > 1e-9, scale, 1.0)


def classify(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    The statistics of every whole text are settled once, a narrow row each. Fold 0 is held
    out, CALIBRATION_FOLD calibrates, the other labelled rows are summed into the normal
    equations where they lie; only those sums and a histogram of BINS scores reach the driver.
    A null text counts as empty; empty texts are scored like any other. Without labelled rows
    in a fold the scores are the share of label 1, or 0.5. Repeated rows are scored each; a
    document with several labels teaches each of them. Null labels and ids teach nothing. All
    sums over rows are exact, so reruns agree however rows are dealt.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kinds = ", ".join(f"{n} double" for n in STATISTICS)
    measured = settle(rows.mapInArrow(_measure, f"doc_id long, {kinds}"))
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("labelled"), F.col(label).cast("double").alias("label")
    )
    taught = measured.join(known, F.col("doc_id") == F.col("labelled")).drop("labelled").filter(
        fold(F.col("doc_id")) != 0
    )
    mean, scale = _moments(measured)

    fitting = taught.filter(fold(F.col("doc_id")) != CALIBRATION_FOLD)
    sums = fitting.mapInArrow(_normal_sums(mean, scale), "i int, j int, value long").groupBy(
        "i", "j"
    ).agg(F.sum(F.col("value").cast("decimal(19,0)")).alias("value")).toPandas()
    sums["value"] = sums["value"].astype(float) / GRID**2
    square, aim = np.zeros((FEATURES + 1,) * 2), np.zeros(FEATURES + 1)
    target = sums["j"].to_numpy() < 0
    aim[sums["i"][target]] = sums["value"][target]
    square[sums["i"][~target], sums["j"][~target]] = sums["value"][~target]
    square = np.triu(square) + np.triu(square, 1).T
    ridge = np.diag([RIDGE * 2 / FEATURES] * FEATURES + [1e-9])
    weights = np.linalg.solve(square + ridge, aim) if square[-1, -1] else np.zeros(FEATURES + 1)

    scored = taught.filter(fold(F.col("doc_id")) == CALIBRATION_FOLD).mapInArrow(
        _scores(mean, scale, weights), "doc_id long, label double, raw double"
    )
    place = F.least(F.greatest(F.floor((F.col("raw") + 0.5) * (BINS / 2)), F.lit(0)), F.lit(BINS - 1))
    whole = (F.col("raw") * SCORE_GRID).cast("decimal(20,0)")
    bins = sorted(
        (r.bin, int(r.raw) / r.n / SCORE_GRID, r.hits, r.n)
        for r in scored.groupBy(place.alias("bin")).agg(
            F.sum(whole).alias("raw"), F.sum("label").alias("hits"), F.count(F.lit(1)).alias("n")
        ).collect()
    )
    if bins and square[-1, -1]:
        curve = isotonic(*np.array([b[1:] for b in bins], np.float64).T)
    else:
        n = square[-1, -1] + sum(b[3] for b in bins)
        share = (aim[-1] + sum(b[2] for b in bins)) / n if n else 0.5
        curve = ([0.0], [share])
    every = measured.withColumn("label", F.lit(0.0)).mapInArrow(
        _scores(mean, scale, weights, curve), "doc_id long, label double, raw double"
    )
    return every.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), F.col("raw").alias("score"),
        (F.col("raw") >= THRESHOLD).cast("int").alias("predicted"),
    )
