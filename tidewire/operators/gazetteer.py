"""Names of a gazetteer table in texts: one automaton of all names, or a join by seeds.

Up to ``MOST_NAMES`` names of ``MOST_CHARS`` characters in all (both are counted first) are
built into one automaton per Python worker, and matched in the row that holds the text: no
shuffle, and streams can do it. Beyond, the names stay a table. A pass over the texts passes
on the places where a name may begin, each with the characters a name can take, and they meet
the names by their first characters; whole texts are never moved for it.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_NAMES = 50_000
MOST_CHARS = 2_000_000
#: Lengths of the seeds that stand for names: a name's longest prefix of one of them.
SEED_LENGTHS = (1, 2, 4, 8)
#: Bits of the filter of seeds for each name, at least and at most.
BITS_PER_NAME, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28

WORD = r"[\p{L}\p{N}_]"
HITS = "array<struct<ord:bigint,type:string,text:string>>"

_TIMES = np.random.default_rng(5).integers(0, 2**63, max(SEED_LENGTHS), np.uint64) * np.uint64(2) + (
    np.uint64(1)
)


def names_of(gazetteer: DataFrame) -> DataFrame:
    """``ord, type, text, needle``: two rows a gazetteer row, null or empty names left out."""
    both = F.array(
        F.struct(F.lit("company").alias("type"), F.col("company").alias("text")),
        F.struct(F.lit("ticker").alias("type"), F.col("ticker").alias("text")),
    )
    return (
        gazetteer.select(F.col("ord").cast("bigint").alias("ord"), F.inline(both))
        .withColumn("needle", F.lower("text")).filter("needle <> ''")
    )


def with_hits(items: DataFrame, gazetteer: DataFrame, text: Column, into: str) -> DataFrame:
    """Items plus ``into``, the names found in ``text`` (lower case) by ``ord``, then type.

    Rows keep their number and need no key: equal ids may hold different texts. A null text
    holds no names.
    """
    names = names_of(gazetteer)
    size = names.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("needle")).alias("chars"),
        F.max(F.length("needle")).alias("longest"),
    ).first()
    if not size.n:
        return items.withColumn(into, F.array().cast(HITS))
    if size.n <= MOST_NAMES and size.chars <= MOST_CHARS:
        rows = [tuple(r) for r in names.select("ord", "type", "text", "needle").collect()]
        return items.withColumn(into, F.coalesce(_matcher(rows)(text), F.array().cast(HITS)))
    if items.isStreaming:
        raise ValueError(
            f"a gazetteer of {size.n} names is joined; on a stream do so batch by batch"
        )
    return _joined(items, names, text, into, size.n, size.longest)


# --- In the row --------------------------------------------------------------------------


def _is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def _alone(text: str, start: int, end: int) -> bool:
    """Whether a word begins or ends at both ends of ``text[start:end]``."""
    before, after = text[start - 1: start] if start else "", text[end: end + 1]
    return (
        _is_word(before) != _is_word(text[start]) and _is_word(text[end - 1]) != _is_word(after)
    )


def _matcher(names: list[tuple]) -> Callable[[Column], Column]:
    @F.pandas_udf(HITS)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        by_needle: dict[str, list[int]] = {}
        for k, (_, _, _, needle) in enumerate(names):
            by_needle.setdefault(needle, []).append(k)
        automaton = ahocorasick.Automaton()
        for needle, own in by_needle.items():
            # a name that is a word only is looked at until it stands alone once
            automaton.add_word(needle, (len(needle), own))
        automaton.make_automaton()

        def find(text: str) -> list[dict]:
            found: set[int] = set()
            for end, (length, own) in automaton.iter(text):
                for k in own:
                    if k not in found and (
                        names[k][1] == "company" or _alone(text, end + 1 - length, end + 1)
                    ):
                        found.add(k)
            ordered = sorted(names[k][:3] for k in found)
            return [{"ord": o, "type": t, "text": x} for o, t, x in ordered]

        for texts in batches:
            yield pd.Series([None if t is None else find(t) for t in texts], dtype=object)

    return hits


# --- By seeds ----------------------------------------------------------------------------


def _seed(needle: Column) -> Column:
    return F.coalesce(*[
        F.when(F.length(needle) >= n, F.substring(needle, 1, n)) for n in reversed(SEED_LENGTHS)
    ])


def _places(codes: np.ndarray, length: int, bits: int) -> np.ndarray:
    """A number below ``bits`` for every run of ``length`` characters."""
    n = len(codes) - length + 1
    total = np.zeros(max(n, 0), np.uint64)
    for k in range(length if n > 0 else 0):
        total += codes[k: k + n] * _TIMES[k]
    total ^= total >> np.uint64(29)
    return ((total * _TIMES[0]) >> np.uint64(32)) % np.uint64(bits)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _seed_filter(seeds: DataFrame, bits: int) -> np.ndarray:
    """Bits of all seeds, or-ed in the executors: ``bits`` / 64 rows at most."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.array(
                [int(_places(_codes(s), len(s), bits)[0]) for s in batch.column(0).to_pylist()],
                np.int64,
            )
            own = np.left_shift(np.ones(len(place), np.uint64), (place % 64).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place // 64), pa.array(own.view(np.int64))], names=["word", "bit"]
            )

    rows = seeds.mapInArrow(words, "word long, bit long").groupBy("word").agg(
        F.bit_or("bit").alias("bits")
    )
    out = np.zeros(bits // 64, np.int64)
    for word, value in rows.toLocalIterator():
        out[word] = value
    return out


def _begins(bits: np.ndarray, lengths: list[int], longest: int) -> Callable:
    """``digest, seed, around``: places where a name may begin, from one character before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes, padded = _codes(text), "\n" + text
                found = set()
                for length in lengths:
                    at = _places(codes, length, len(bits) * 64).astype(np.int64)
                    for i in np.flatnonzero((bits[at >> 6] >> (at & 63)) & 1):
                        found.add((text[i: i + length], padded[i: i + longest + 2]))
                out += [(digest, *x) for x in found]
                if len(out) > 50_000:
                    yield _as_batch(out)
                    out = []
            yield _as_batch(out)

    return run


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string()),
         pa.array(columns[2], pa.string())], names=["digest", "seed", "around"],
    )


def _joined(
    items: DataFrame, names: DataFrame, text: Column, into: str, count: int, longest: int
) -> DataFrame:
    bits = min(max(LEAST_BITS, 1 << (BITS_PER_NAME * count).bit_length()), MOST_BITS)
    names = names.withColumn("seed", _seed(F.col("needle")))
    lengths = sorted(
        r.n for r in names.select(F.length("seed").alias("n")).distinct().collect()
    )
    filled = _seed_filter(names.select("seed").distinct(), bits)
    digest = F.unhex(F.sha2(text, 256))
    begins = (
        items.select(digest.alias("digest"), text.alias("text")).filter("text is not null")
        .mapInArrow(_begins(filled, lengths, longest), "digest binary, seed string, around string")
    )
    needle, around, size = F.col("needle"), F.col("around"), F.length("needle")

    def is_word(char: Column) -> Column:
        return char.rlike(WORD)

    alone = (is_word(F.substring(around, 1, 1)) != is_word(F.substring(needle, 1, 1))) & (
        is_word(F.substring(around, size + F.lit(2), F.lit(1)))
        != is_word(F.substring(needle, size, F.lit(1)))
    )
    hits = (
        begins.join(names, "seed")
        .filter((F.substring(around, F.lit(2), size) == needle)
                & ((F.col("type") == "company") | alone))
        .groupBy(F.col("digest").alias("hit_digest"))
        .agg(F.array_sort(F.collect_set(F.struct("ord", "type", "text"))).alias(into))
    )
    return (
        items.withColumn("item_digest", digest)
        .join(hits, F.col("item_digest") == F.col("hit_digest"), "left")
        .withColumn(into, F.coalesce(F.col(into), F.array().cast(HITS)))
        .drop("item_digest", "hit_digest")
    )
