"""Packing tokenized documents into fixed-length sequences, best fit on a length histogram."""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import settle

CAPACITY = 2048
END_ID = 0
#: Pre-tokenization of the byte-level vocabularies (public, part of their definition).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def _encoder(path: str) -> Callable[[str], list[int]]:
    """The byte-level BPE of a tokenizers file; a token's id is also the rank of its merge.

    Texts are split at the added tokens of the file (the longest at a place), which give their
    own ids, as ``tokenizers`` does without ``add_special_tokens``.
    """
    import tiktoken

    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    to_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    if any(t.get(k) for t in model["added_tokens"] for k in ("lstrip", "rstrip", "single_word")):
        raise ValueError(f"added tokens that strip or stand as single words are not read: {path}")
    ranks = {
        bytes(to_byte[c] for c in token): rank
        for token, rank in model["model"]["vocab"].items() if token not in special
    }
    ordinary = tiktoken.Encoding(
        "file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary
    if not special:
        return ordinary
    added = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")

    def encode(text: str) -> list[int]:
        first, *rest = added.split(text)
        ids = ordinary(first)
        for token, between in zip(rest[::2], rest[1::2]):
            ids.append(special[token])
            ids += ordinary(between)
        return ids

    return encode


def _pieces(capacity: int, path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path or default_tokenizer())
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            out = [[] for _ in range(7)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), END_ID], dtype="<u4")
                first = len(ids) % capacity or capacity
                ends = range(first, len(ids) + 1, capacity)
                start = 0
                for piece, end in enumerate(ends):
                    length = end - start
                    crc = zlib.crc32(ids[start:end].tobytes())
                    for column, value in zip(
                        out, (doc_id, piece, start, length, crc, part, seen[length])
                    ):
                        column.append(value)
                    seen[length] += 1
                    start = end
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"],
            )

    return run


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing over counts; rows of ``length, rank, number, sequence, offset``.

    A row is a run of slots: the pieces of ``length`` with ranks ``rank .. rank + number - 1``
    go to ``sequence .. sequence + number - 1`` at ``offset``. Open sequences are kept as runs
    with equal free space, so the work depends on the number of lengths, not of documents.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = {}  # free space -> runs (first sequence, number)
    spaces: list[int] = []
    opened = 0

    def put(space: int, run: tuple[int, int]) -> None:
        if space:
            if space not in free:
                free[space] = []
                insort(spaces, space)
            free[space].append(run)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, number = free[space].pop()
                if not free[space]:
                    del free[space], spaces[at]
                used = min(left, number)
                if used < number:
                    put(space, (first + used, number - used))
            else:
                space, first = capacity, opened
                used = -(-left // (capacity // length))
                opened += used
            runs.append((length, rank, used, first, capacity - space))
            put(space - length, (first, used))
            rank, left = rank + used, left - used
    return np.array(runs, dtype=np.int64).reshape(-1, 5)


def _place(plan: np.ndarray):
    """Rows ``length, rank`` to their slots; the plan is sorted by length and rank."""
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # lengths are small and ranks below 2 ** 48: one sortable number for both
        starts = (plan[:, 0] << 48) | plan[:, 1]
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            length, rank = (columns[n].to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            slot = plan[np.searchsorted(starts, (length << 48) | rank, side="right") - 1]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*[columns[n] for n in names], pa.array(slot[:, 3] + rank - slot[:, 1]),
                 pa.array(slot[:, 4])],
                names=[*names, "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    *,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is the token ids of its whole text and an end id; only longer ones than
    ``capacity`` are cut, the remainder first. ``tokenizer`` is the path of a byte-level BPE
    file, by default the public one, which must exist on every executor. Best-fit-decreasing
    is planned on the histogram of lengths (``capacity`` rows at most reach the driver), and a
    piece takes the planned slot of its rank within its length. Ranks are counted per task
    while tokenizing, then shifted by the counts of earlier tasks, so a very frequent length
    is never sorted in one task; the plan's size depends on ``capacity`` alone.

    A null text is an empty one: the end id alone. Rows repeated, or equal in id, are packed
    each. An empty table gives no row. A null id stays null.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = settle(rows.mapInArrow(_pieces(capacity, tokenizer), _PIECE))
    per_task = settle(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("number")))
    counts = dict(per_task.groupBy("length").agg(F.sum("number")).collect())
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_task.select(
        F.col("length").alias("o_length"), F.col("part").alias("o_part"),
        F.coalesce(F.sum("number").over(earlier), F.lit(0)).alias("before"),
    )
    ranked = pieces.join(
        offsets, (F.col("length") == F.col("o_length")) & (F.col("part") == F.col("o_part"))
    ).select("doc_id", "piece", "start", "length", "ids_crc32",
             (F.col("before") + F.col("place")).alias("rank"))
    return ranked.mapInArrow(
        _place(plan_slots(counts, capacity)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
