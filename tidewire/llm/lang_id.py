"""Language identification: averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import fold
from tidewire.llm.hashing import STEP, byte_chunks

BUCKETS = 1 << 16
DIMENSIONS = 16
#: Labelled rows that are fitted, shared evenly by the languages.
SAMPLE_ROWS = 3000
#: Most frequent buckets of a text that is fitted, at most: 32 KB a row on the driver.
BAG = 4096
EPOCHS = 8
RATE = 0.5
#: Least share of right answers among accepted ones, on the calibration fold.
PRECISION = 0.99
UNKNOWN = "und"

_SHIFT = np.uint64(64 - 16)


def _folded_bytes() -> np.ndarray:
    """Bytes as they are compared: A-Z in lower case, other ASCII than letters as blanks."""
    out = np.full(256, 32, np.uint8)
    out[128:] = np.arange(128, 256)
    for first in (65, 97):
        out[first: first + 26] = np.arange(97, 123)
    return out


_FOLDED = _folded_bytes()


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of 3 and 4 bytes, and the number of places before each text.

    Texts are laid out between blanks, so that the starts and ends of words count. A place
    holds two buckets, of the 3 and of the 4 bytes that start there.
    """
    sizes = np.diff(offsets)
    at = offsets + 4 * np.arange(len(offsets))  # each text and four blanks
    laid = np.full(at[-1] + 1, 32, np.uint8)
    laid[np.arange(len(data)) + np.repeat(at[:-1] + 1 - offsets[:-1], sizes)] = _FOLDED[data]
    wide = laid.astype(np.uint64)
    n = max(len(wide) - 3, 0)
    three = wide[:n] | (wide[1: n + 1] << np.uint64(8)) | (wide[2: n + 2] << np.uint64(16))
    four = three | (wide[3: n + 3] << np.uint64(24)) | np.uint64(1 << 40)
    pair = np.empty((n, 2), np.int64)
    pair[:, 0] = (three * STEP) >> _SHIFT
    pair[:, 1] = (four * STEP) >> _SHIFT
    return pair, at[:-1]


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets of every text with their counts, the BAG most frequent at most."""
    for batch in batches:
        found, counts = [], []
        for _, data, offsets in byte_chunks(batch.column(2)):
            pair, starts = subwords(data, offsets)
            for start, end in zip(starts, [*starts[1:], len(pair)]):
                bucket, count = np.unique(pair[start:end], return_counts=True)
                if len(bucket) > BAG:
                    most = np.sort(np.argsort(-count, kind="stable")[:BAG])
                    bucket, count = bucket[most], count[most]
                found.append(bucket.astype("<i4").tobytes())
                counts.append(count.astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.binary()),
             pa.array(counts, pa.binary())],
            names=["lang", "calibrates", "buckets", "counts"],
        )


@dataclass(frozen=True)
class Model:
    """``table`` holds the logits that one subword adds; the rest makes a score of their mean."""

    languages: tuple[str, ...]
    table: np.ndarray
    temperature: float
    accept: float


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(docs: DataFrame, label: str, keep: Column, key: str, text: str) -> Model | None:
    """Model of the rows where ``keep``; one of four calibrates. None without labelled rows.

    About SAMPLE_ROWS rows, chosen by a hash of the id, reach the driver, as counts of BAG
    buckets at most. Where ids are repeated, so that more rows have a drawn id, the 2 *
    SAMPLE_ROWS that come first by a hash of their counts do, the same in every run.
    """
    labelled = docs.filter(keep & F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).alias("lang"), F.col(key).alias("id"), F.col(text).alias("text")
    )
    counts = labelled.groupBy(F.col("lang").alias("counted")).agg(F.count(F.lit(1)).alias("n"))
    languages = counts.count()
    if not languages:
        return None
    share = SAMPLE_ROWS / languages
    draw = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    calibrates = F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(4)) == 0
    # ids are drawn from narrow rows, so that no text is shuffled; there are 2 * SAMPLE_ROWS at most
    drawn = (
        labelled.select("lang", "id").join(counts, F.col("lang") == F.col("counted"))
        .filter(draw < share / F.col("n")).select(F.col("id").alias("drawn")).distinct()
        .orderBy(F.xxhash64("drawn"), "drawn").limit(2 * SAMPLE_ROWS)
    )
    rows = (
        labelled.join(F.broadcast(drawn), F.col("id").eqNullSafe(F.col("drawn")), "left_semi")
        .select("lang", calibrates.alias("calibrates"), "text")
        .mapInArrow(_bags, "lang string, calibrates boolean, buckets binary, counts binary")
        .orderBy(F.xxhash64("lang", "calibrates", "buckets", "counts"))
        .limit(2 * SAMPLE_ROWS).collect()
    )
    rows.sort(key=lambda r: (r.lang, bytes(r.buckets), bytes(r.counts), r.calibrates))
    names = tuple(sorted({r.lang for r in rows}))
    target = np.array([names.index(r.lang) for r in rows])
    bags = [(np.frombuffer(r.buckets, "<i4"), np.frombuffer(r.counts, "<i4")) for r in rows]
    bags = [(b, (c / max(c.sum(), 1)).astype(np.float32)) for b, c in bags]
    held = np.array([r.calibrates for r in rows])
    if held.all() or not held.any():
        held[:] = False
    table = _descend([bags[i] for i in np.flatnonzero(~held)], target[~held], len(names))

    judged = np.flatnonzero(held) if held.any() else np.arange(len(rows))
    logits = np.array([w @ table[b] for b, w in (bags[i] for i in judged)])
    truth = target[judged]
    heats = np.exp(np.linspace(-3, 3, 61))
    losses = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()
              for t in heats]
    temperature = float(heats[int(np.argmin(losses))])
    best = _softmax(logits / temperature)
    score, right = best.max(axis=1), best.argmax(axis=1) == truth
    order = np.argsort(-score)
    good = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= PRECISION)
    accept = float(score[order[good[-1]]]) if len(good) else 1.0
    return Model(names, table, temperature, accept)


def _descend(bags: list, target: np.ndarray, languages: int) -> np.ndarray:
    """Stochastic gradient descent on embeddings and weights; returns their product."""
    random = np.random.default_rng(7)
    embedding = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weights = np.zeros((DIMENSIONS, languages), np.float32)
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(bags)):
            bucket, share = bags[i]
            rate = RATE * (1 - done / steps)
            done += 1
            if not len(bucket):
                continue
            mean = share @ embedding[bucket]
            error = _softmax(mean @ weights)
            error[target[i]] -= 1
            back = weights @ error
            weights -= rate * np.outer(mean, error)
            # a share is about 1 / len(bucket): the step is scaled to a whole embedding
            embedding[bucket] -= rate * len(bucket) ** 0.5 * np.outer(share, back)
    return embedding @ weights


def _predict(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        names = np.array(model.languages, dtype=object)
        table = np.ascontiguousarray(model.table, np.float32)
        for batch in batches:
            best, score = [], []
            for _, data, offsets in byte_chunks(batch.column(2), 1 << 19):
                pair, starts = subwords(data, offsets)
                each = table[pair[:, 0]] + table[pair[:, 1]]
                places = np.diff([*starts, len(pair)])[:, None]
                mean = np.add.reduceat(each, starts, axis=0) / (2 * places)
                chance = _softmax(mean / model.temperature)
                best.append(chance.argmax(axis=1))
                score.append(chance.max(axis=1))
            pick = np.concatenate([np.zeros(0, int), *best])
            score = np.concatenate([np.zeros(0), *score]).astype(np.float64)
            letters = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array(np.where(letters, names[pick], UNKNOWN).tolist(), pa.string()),
                 pa.array(np.where(letters, score, 0.0)),
                 pa.array(letters & (score >= model.accept))],
                names=["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )

    return run


def identify(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang",
    reject: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, accepted``.

    The model learns from rows outside fold 0 with a label, and predicts every whole text
    from its bytes alone. ``score`` is the calibrated probability of ``lang_pred``;
    ``accepted`` is false below the score at which the calibration fold stops being right in
    PRECISION of the cases, and with ``reject`` such predictions become ``und``. A null text,
    one without a letter, and every text if nothing is labelled, is ``und`` with score 0. A
    null id counts as an empty one for the fold. Repeated rows are predicted each. Extra
    columns are ignored. A text takes about 50 times its size of a worker's memory.
    """
    out = "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean"
    held = fold(F.col(key)) == 0
    model = fit(docs, label, ~held, key, text)
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), held.alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    if model is None:
        return rows.select(
            "doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(False).alias("accepted"),
        )
    predicted = rows.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)), out)
    if reject:
        shown = F.when(F.col("accepted"), F.col("lang_pred")).otherwise(UNKNOWN)
        predicted = predicted.withColumn("lang_pred", shown)
    return predicted
