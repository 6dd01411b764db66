"""Removal of 50-byte strings seen in earlier documents, by bucket-pointer refinement."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm import hashing
from tidewire.llm.common import settle

LENGTH = 50
#: Bytes of the initial buckets. Every string of LENGTH bytes holds an anchor: a place whose
#: q-gram has the smallest hash of the string's q-grams. Equal strings hold equal anchors.
GRAM = 16
SIDE = LENGTH - GRAM
#: Bytes of the buckets that a refinement starts from, and contexts refined together.
FIRST = 8
TOGETHER = 1 << 16
#: Bits of the filter of shared q-grams; its size does not depend on data. If it fills up,
#: more anchors are refined, with the same result. It is made of stretches that Spark's bitmap
#: aggregates merge (their size is Spark's).
FILTER_BITS, STRETCH_BITS = 1 << 28, 1 << 15
#: Parts that anchors are dealt to by their hash. A part's anchors are in memory together, so
#: the number follows the corpus: one for every so many bytes.
BYTES_PER_PART = 1 << 22
LEAST_PARTS = 1 << 6
#: Anchors a task gathers before it passes them on.
GATHER = 1 << 19
CHUNK = 1 << 18
#: A q-gram of so many documents is dealt string by string.
HOT = 1 << 17
#: Parts into which the documents of one text are dealt for the join with its first one.
SALTS = 16
#: Anchors whose surroundings are looked at together.
SLICE = 1 << 13

_ROW = hashing.multipliers(11, 31)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` values, by doubling."""
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (width - n)], x[width - n:]) if width > n else x


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes (a power of two) from every place."""
    h = data.astype(np.uint64) + np.uint64(1)
    n = 1
    while n < GRAM:
        h = h[:-n] * np.uint64(pow(int(hashing.STEP), n, 1 << 64)) + h[n:]
        n *= 2
    return hashing.mixed(h)


def _anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places and hashes of the anchors of the texts of a chunk, and the least hash of the
    string from every place (0 where none fits its text)."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = _gram_hashes(data)
    width = LENGTH - GRAM + 1
    least = _sliding_min(grams, width)
    # strings that cross the end of a text have no say
    inside = np.ones(len(least), bool)
    for end in offsets[1:-1]:
        inside[max(end - LENGTH + 1, 0): end] = False
    least = np.where(inside, least, np.uint64(0))
    edge = np.full(width - 1, _TOP)
    most = ~_sliding_min(np.concatenate([edge, ~least, edge]), width)
    at = np.flatnonzero((grams == most) & (grams != 0))
    return at, grams[at], least


def _spread(grams: np.ndarray) -> np.ndarray:
    """Hashes of anchors dealt out evenly: those of anchors are small, as the least of many."""
    return hashing.mixed(grams ^ hashing.STEP)


def _pack(values: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(values).tobytes()
    return pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def _unpack(packed: bytes, count: int, kind: str, width: int = 1) -> np.ndarray:
    size = count * np.dtype(kind).itemsize * width
    raw = pa.decompress(packed, size, codec="zstd", asbytes=True) if size else b""
    return np.frombuffer(raw, kind)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``ids, text keys, bytes, offsets, documents before, first place`` of chunks, without
    later copies that a task meets. A long text comes in slices that share no string."""
    number = 0
    met: dict[bytes, int] = {}
    for batch in batches:
        ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for row, data, offsets in hashing.byte_chunks(batch.column(2), CHUNK):
            stay = []
            for i in range(len(offsets) - 1):
                if offsets[i + 1] - offsets[i] < LENGTH:
                    continue
                digest = hashlib.blake2b(data[offsets[i]: offsets[i + 1]], digest_size=16).digest()
                first = met.get(digest)
                if first is None or ids[row + i] < first:
                    met[digest] = int(ids[row + i])
                    stay.append(i)
            if len(met) > 1 << 18:
                met.clear()
            if not stay:
                continue
            if len(stay) < len(offsets) - 1:
                data = np.concatenate([data[offsets[i]: offsets[i + 1]] for i in stay])
                offsets = np.concatenate([[0], np.cumsum([offsets[i + 1] - offsets[i] for i in stay])])
            at = row + np.array(stay)
            for first in range(0, len(data) - LENGTH + 1 if len(at) == 1 else 1, CHUNK):
                piece, inside = data, offsets
                if len(at) == 1:
                    piece = data[first: first + CHUNK + LENGTH - 1]
                    inside = np.array([0, len(piece)])
                yield ids[at], keys[at], piece, inside, number, first
            number += len(at)


def _spans(parts_of: np.ndarray) -> tuple[np.ndarray, list[slice]]:
    """The parts that occur, and where each of them is; ``parts_of`` is sorted."""
    heads = np.flatnonzero(np.concatenate([[True], parts_of[1:] != parts_of[:-1]]))
    ends = np.append(heads[1:], len(parts_of))
    return parts_of[heads].astype(np.int32), [slice(a, b) for a, b in zip(heads, ends)]


def _seen(parts: int) -> Callable:
    """Rows ``part, n, grams, several, docs`` of q-grams a task has met, each once.

    ``several`` marks those of more than one document, ``docs`` says of how many; a q-gram of
    two tasks, or of two rows of this output, has several documents anyway.
    """
    shift = np.uint64(64 - parts.bit_length() + 1)

    def rows(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        grams = np.concatenate([g for g, _ in found])
        docs = np.concatenate([d for _, d in found])
        order = np.argsort(grams, kind="stable")
        grams, docs = grams[order], docs[order]
        starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        fresh = np.concatenate([[True], (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])])
        n_docs = np.add.reduceat(fresh.astype("<u4"), starts)
        several = n_docs > 1
        grams = grams[starts]
        used, spans = _spans(grams >> shift)
        # the top 48 bits are kept: a false twin only adds an anchor to refine
        low = (grams >> np.uint64(16)).astype("<u8").view("<u2").reshape(-1, 4)[:, :3]
        return pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array([x.stop - x.start for x in spans], pa.int32()),
             pa.array([low[x].tobytes() for x in spans], pa.binary()),
             pa.array([np.packbits(several[x]).tobytes() for x in spans], pa.binary()),
             pa.array([n_docs[x][several[x]].astype("<u4").tobytes() for x in spans], pa.binary())],
            names=["part", "n", "grams", "several", "docs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for _, _, data, offsets, number, _ in _texts(batches):
            at, grams, _ = _anchors(data, offsets)
            owner = np.searchsorted(offsets, at, side="right") - 1 + number
            found.append((_spread(grams), owner))
            held += len(at)
            if held >= GATHER:
                yield rows(found)
                found, held = [], 0
        if held:
            yield rows(found)

    return run


def _parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each part in batches sorted by part."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["part"] != row["part"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _shared_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``stretch, bits, hot``: of every part a bit for each shared q-gram, in the stretches of
    the filter that it reaches, and the q-grams of HOT documents (their top 48 bits)."""
    for rows in _parts_of(batches):
        low = np.concatenate([np.frombuffer(r["grams"], "<u2").reshape(-1, 3) for r in rows])
        grams = np.zeros((len(low), 4), "<u2")
        grams[:, :3] = low
        grams = grams.view("<u8").ravel()
        docs = np.ones(len(grams), np.int64)
        several = np.concatenate(
            [np.unpackbits(np.frombuffer(r["several"], np.uint8), count=r["n"]) for r in rows]
        )
        docs[several.astype(bool)] = np.concatenate([np.frombuffer(r["docs"], "<u4") for r in rows])
        order = np.argsort(grams)
        grams = grams[order]
        starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        grams, docs = grams[starts], np.add.reduceat(docs[order], starts)
        grams, docs = grams[docs > 1], docs[docs > 1]
        if not len(grams):
            continue
        place = (grams >> np.uint64(48 - FILTER_BITS.bit_length() + 1)).astype(np.int64)
        used, spans = _spans(place // STRETCH_BITS)
        bits, often = [], []
        for x in spans:
            own = np.zeros(STRETCH_BITS, bool)
            own[place[x] % STRETCH_BITS] = True
            bits.append(np.packbits(own, bitorder="little").tobytes())
            often.append(grams[x][docs[x] >= HOT].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(bits, pa.binary()), pa.array(often, pa.binary())],
            names=["stretch", "bits", "hot"],
        )


def _collapsed(block: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every context, its row with the least id, and a hash of every context.

    Contexts of a class are equal byte by byte; equal ones are apart only if hashes clash.
    """
    words = block.view("<u8")
    hashes = hashing.mixed((words * _ROW).sum(axis=1, dtype=np.uint64))
    order = np.lexsort((ids, hashes))
    new = np.ones(len(ids), bool)
    new[1:] = (words[order[1:]] != words[order[:-1]]).any(axis=1)
    of = np.empty(len(ids), np.int64)
    of[order] = np.cumsum(new) - 1
    return of, order[new], hashes


def _blocks(around: np.ndarray, lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
    """Contexts as rows of 88 bytes; bytes outside of a context's own strings are zero."""
    window = np.arange(-SIDE, GRAM + SIDE)
    block = np.zeros((len(around), 88), np.uint8)
    own = (window >= -lefts[:, None].astype(int)) & (window < GRAM + rights[:, None].astype(int))
    block[:, : len(window)] = around * own
    block[:, -2], block[:, -1] = lefts, rights
    return block


def _merged(ids: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple:
    """Runs of the same text that overlap or touch as one."""
    if not len(ids):
        return ids, keys, starts, ends
    order = np.lexsort((starts, keys, ids))
    ids, keys, starts, ends = (x[order] for x in (ids, keys, starts, ends))
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
    text = np.cumsum(new) << 40
    reach = np.maximum.accumulate(text + ends)
    new[1:] |= (text + starts)[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return ids[heads], keys[heads], starts[heads], (reach - text)[np.append(heads[1:], len(ids)) - 1]


_CONTEXT = ("part int, n int, m int, ids binary, counts binary, bytes binary, "
            "text_keys binary, starts binary, ends binary")


def _contexts(parts: int, shared, hot) -> Callable:
    """Anchors with shared q-grams and the SIDE bytes on both sides, packed by part.

    Of equal contexts only those of the least id go on, as one context with its members: the
    others have lost all their strings, whatever other tasks have. What they lost is in rows
    with no context (``n`` = 0). A hot q-gram's contexts are first cut to single strings,
    which are dealt by all their bytes. So the rows of one context, or of one string of a hot
    q-gram, grow with the tasks that meet it, not with its documents.
    """
    shift = np.uint64(64 - parts.bit_length() + 1)

    def rows(at: list, n: list, m: list, columns: list[list[bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*[pa.array([int(x) for x in c], pa.int32()) for c in (at, n, m)],
             *[pa.array(c, pa.binary()) for c in columns]],
            names=[c.split()[0] for c in _CONTEXT.split(", ")],
        )

    def dealt(even, ids, keys, starts, block, single: bool) -> Iterator[pa.RecordBatch]:
        """Rows of contexts, and of runs that are lost."""
        of, heads, hashes = _collapsed(block, ids)
        gone = ids > ids[heads][of]
        lost = _merged(ids[gone], keys[gone].astype(np.int64),
                       starts[gone].astype(np.int64) - block[gone, -2],
                       starts[gone].astype(np.int64) - SIDE + block[gone, -1] + LENGTH)
        if len(lost[0]):
            some = int(hashing.mixed(hashes[:1])[0] >> shift)
            yield rows([some], [0], [len(lost[0])],
                       [[_pack(lost[0])], [b""], [b""], *[[_pack(x)] for x in lost[1:]]])
        stay = np.flatnonzero(~gone)
        if not single and len(hot.value):
            often = np.isin(even >> np.uint64(16), hot.value)
            yield from strings(*[x[stay[often[stay]]] for x in (ids, keys, starts, block)])
            stay = stay[~often[stay]]
        counts = np.bincount(of[stay], minlength=len(heads))
        heads, counts, number = heads[counts > 0], counts[counts > 0], np.cumsum(counts > 0) - 1
        if not len(heads):
            return
        deal = hashes if single else even
        order = np.argsort(deal[heads], kind="stable")
        rank = np.empty(len(heads), np.int64)
        rank[order] = np.arange(len(heads))
        stay = stay[np.argsort(rank[number[of[stay]]], kind="stable")]
        heads, counts = heads[order], counts[order].astype(np.uint32)
        ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        used, spans = _spans(deal[heads] >> shift)
        own = [slice(ends[x.start], ends[x.stop]) for x in spans]
        yield rows(used, [x.stop - x.start for x in spans], [x.stop - x.start for x in own],
                   [*[[_pack(c[x]) for x in spans] for c in (ids[heads], counts, block[heads])],
                    *[[_pack(c[x]) for x in own] for c in (keys[stay], starts[stay])],
                    [b""] * len(used)])

    def strings(ids, keys, starts, block) -> Iterator[pa.RecordBatch]:
        for first in range(0, len(ids), SLICE):
            some = block[first: first + SLICE]
            at, left = np.nonzero((some[:, -2, None] >= np.arange(SIDE + 1))
                                  & (some[:, -1, None] >= SIDE - np.arange(SIDE + 1)))
            left = left.astype(np.uint8)
            cut = _blocks(some[at, : LENGTH + SIDE], left, np.uint8(SIDE) - left)
            at += first
            yield from dealt(None, ids[at], keys[at], starts[at], cut, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        window = np.arange(-SIDE, GRAM + SIDE)
        found, held = [], 0
        for ids, keys, data, offsets, _, ahead in _texts(batches):
            every, all_grams, least = _anchors(data, offsets)
            all_even = _spread(all_grams)
            place = all_even >> np.uint64(64 - FILTER_BITS.bit_length() + 1)
            hit = (bits[(place >> np.uint64(3)).astype(np.int64)]
                   >> (place & np.uint64(7)).astype(np.uint8)) & 1
            every, all_grams, all_even = (x[hit.astype(bool)] for x in (every, all_grams, all_even))
            for first in range(0, len(every), SLICE):
                at, grams, even = (x[first: first + SLICE] for x in (every, all_grams, all_even))
                owner = np.searchsorted(offsets, at, side="right") - 1
                # only strings that have their least hash here: others are for their own anchors
                before = at[:, None] - np.arange(SIDE + 1)
                own = (before >= 0) & (before < len(least))
                own &= least[np.clip(before, 0, max(len(least) - 1, 0))] == grams[:, None]
                left = SIDE - own[:, ::-1].argmax(axis=1)
                right = SIDE - own.argmax(axis=1)
                around = data[np.clip(at[:, None] + window, 0, max(len(data) - 1, 0))]
                found.append((even, ids[owner], (keys[owner] & 0xFFFFFFFF).astype(np.uint32),
                              (at - offsets[owner] + ahead).astype(np.uint32),
                              _blocks(around, left.astype(np.uint8), right.astype(np.uint8))))
                held += len(at)
                if held >= GATHER // 2:
                    yield from dealt(*[np.concatenate(c) for c in zip(*found)], False)
                    found, held = [], 0
        if held:
            yield from dealt(*[np.concatenate(c) for c in zip(*found)], False)

    return run


def _numbered(keys: np.ndarray) -> np.ndarray:
    """Bucket identifiers of equal keys; -1 for a key that no other one equals."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = ordered[1:] != ordered[:-1]
    bucket = np.cumsum(new[:-1], dtype=np.int32) - 1
    bucket[new[:-1] & new[1:]] = -1
    out = np.empty(len(keys), np.int32)
    out[order] = bucket
    return out


def _refined(block: np.ndarray) -> list[np.ndarray]:
    """For every place of contexts the bucket identifiers of the LENGTH bytes from there.

    Bucket-pointer refinement: the first buckets are those of q-grams of FIRST bytes. Buckets
    of ``span`` bytes are refined by sorting them on the bucket identifiers ``span`` places
    further on, which makes buckets of twice the bytes; those are the sort keys of the next
    refinement. Equal strings are at equal places of their contexts, so every place is sorted
    for itself. A place whose bucket holds nothing else is settled (-1) and is sorted no more,
    nor are places that reach beyond a context's own strings.
    """
    lefts, rights = block[:, -2].astype(np.int64), block[:, -1].astype(np.int64)
    begin, end = SIDE - lefts, SIDE + GRAM + rights
    ids = []
    for place in range(LENGTH + SIDE - FIRST + 1):
        live = np.flatnonzero((begin <= place) & (place + FIRST <= end))
        own = np.full(len(block), -1, np.int32)
        grams = np.ascontiguousarray(block[live, place: place + FIRST]).view("<u8").ravel()
        own[live] = _numbered(grams)
        ids.append(own)
    span = FIRST
    while span < LENGTH:
        step = min(span, LENGTH - span)
        for place, (own, further) in enumerate(zip(ids, ids[step:])):
            live = np.flatnonzero((own >= 0) & (further >= 0))
            ids[place] = np.full(len(block), -1, np.int32)
            ids[place][live] = _numbered((own[live].astype(np.int64) << 32) | further[live])
        ids = ids[:-step]
        span += step
    return ids


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, text_key, start, end`` around every anchor that an earlier document has too.

    The strings around the anchors of a q-gram are refined to buckets of equal strings (see
    ``_refined``). Documents that are not the smallest of a bucket lose the string. All
    strings hold the anchor, so an anchor's lost bytes are one run.
    """
    names = ["m_id", "m_key", "start", "end"]
    for rows in _parts_of(batches):
        for r in rows:
            if not r["n"]:
                kinds = {"ids": "<i8", "text_keys": "<i8", "starts": "<i8", "ends": "<i8"}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_unpack(r[c], r["m"], k)) for c, k in kinds.items()], names=names
                )
        rows = [r for r in rows if r["n"]]
        if not rows:
            continue

        def column(name: str, of: str, kind: str, width: int = 1) -> np.ndarray:
            return np.concatenate([_unpack(r[name], r[of], kind, width) for r in rows])

        ids, counts = column("ids", "n", "<i8"), column("counts", "n", "<u4")
        block = column("bytes", "n", "u1", 88).reshape(-1, 88)
        of, heads, _ = _collapsed(block, ids)
        # contexts of a later id than an equal one lose all their strings
        later = ids > ids[heads][of]
        first, last = _judged(ids[heads], block[heads])
        first = np.where(later, block[:, -2], first[of])
        last = np.where(later, SIDE - block[:, -1].astype(np.int64), last[of])
        member = np.repeat(np.arange(len(ids)), counts)
        lost = np.flatnonzero(first[member] >= 0)
        keys = column("text_keys", "m", "<u4")[lost].astype(np.int64)
        starts, member = column("starts", "m", "<u4")[lost].astype(np.int64), member[lost]
        runs = _merged(ids[member], keys, starts - first[member], starts - last[member] + LENGTH)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in runs], names=names)


def _judged(ids: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Most and fewest bytes before the anchor of the strings that contexts lose; -1 for none.

    Contexts of one q-gram are refined together, with those of other q-grams up to TOGETHER.
    """
    # the whole q-gram, not its hash; contexts of a q-gram of one document lose nothing
    middle = np.ascontiguousarray(block[:, SIDE: SIDE + GRAM]).view("<u8")
    order = np.lexsort([middle[:, 0], middle[:, 1]])
    new = np.ones(len(ids), bool)
    new[1:] = (middle[order[1:]] != middle[order[:-1]]).any(axis=1)
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(ids)))
    several = np.minimum.reduceat(ids[order], heads) < np.maximum.reduceat(ids[order], heads)
    order, sizes = order[np.repeat(several, sizes)], sizes[several]
    first, last = np.full((2, len(ids)), -1, np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(order):
        fits = int(np.searchsorted(ends, start + TOGETHER, side="right")) - 1
        stop = int(ends[fits]) if fits >= 0 and ends[fits] > start else int(
            ends[np.searchsorted(ends, start, side="right")]
        )
        some = order[start:stop]
        start = stop
        own = ids[some]
        # from the anchor on to the places before it, so that the fewest bytes come first
        for place, bucket in reversed(list(enumerate(_refined(block[some])))):
            live = np.flatnonzero(bucket >= 0)
            if not len(live):
                continue
            least = np.full(int(bucket.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, bucket[live], own[live])
            later = some[live[own[live] > least[bucket[live]]]]
            first[later] = SIDE - place
            last[later[last[later] < 0]] = SIDE - place
    return first, last


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, spans, kept = [], [], []
        for text, runs in zip(batch.column(1), batch.column(2)):
            data = (text.as_py() or "").encode()
            parts, at, gone, count, open_end = [], 0, 0, 0, -1
            if runs.is_valid:
                pairs = runs.values
                start, end = (pairs.field(i).to_numpy() for i in range(2))
                for i in np.argsort(start, kind="stable"):
                    a, b = max(int(start[i]), at), min(int(end[i]), len(data))
                    if b <= a:
                        continue
                    parts.append(data[at:a])
                    count += a != open_end
                    gone += b - a
                    at = open_end = b
            parts.append(data[at:])
            removed.append(gone)
            spans.append(count)
            kept.append(b"".join(parts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(kept, pa.binary())],
            names=["doc_id", "n_removed", "n_spans", "kept"],
        )


def earlier_runs(docs: DataFrame) -> DataFrame:
    """``m_id, m_key, start, end``: runs of ``doc_id, text_key, text`` rows to be removed.

    Runs overlap. Two passes over the texts: the first finds the q-grams at anchors that more
    than one document has, as a filter of fixed size; the second moves the anchors that pass
    it, with their surroundings, to the part of their hash, where buckets are refined. The
    driver holds the filter (32 MB) and the hot q-grams, at most one for every HOT anchors
    of the corpus.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1 << max(int(size // BYTES_PER_PART).bit_length(), 1), LEAST_PARTS)
    rows = docs.select("doc_id", "text_key", "text")
    stretches = (
        rows.mapInArrow(_seen(parts), "part int, n int, grams binary, several binary, docs binary")
        .repartition("part").sortWithinPartitions("part")
        .mapInArrow(_shared_bits, "stretch int, bits binary, hot binary")
        .groupBy("stretch").agg(F.bitmap_or_agg("bits").alias("bits"),
                                F.collect_list("hot").alias("hot"))
    )
    bits = np.zeros((FILTER_BITS // STRETCH_BITS, STRETCH_BITS // 8), np.uint8)
    often = [np.zeros(0, "<u8")]
    for stretch, own, hot in stretches.collect():
        bits[stretch] = np.frombuffer(own, np.uint8)
        often += [np.frombuffer(h, "<u8") for h in hot]
    shared = spark.sparkContext.broadcast(bits.tobytes())
    hot = spark.sparkContext.broadcast(np.concatenate(often))
    return (
        rows.mapInArrow(_contexts(parts, shared, hot), _CONTEXT)
        .repartition("part").sortWithinPartitions("part")
        .mapInArrow(_matched, "m_id long, m_key long, start long, end long")
    )


def remove_earlier(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left).

    A byte goes if a string of LENGTH bytes covers it that also starts in a document with a
    smaller id; strings are judged on the input. Whole copies are settled first by a hash of
    the text: all but the smallest id lose everything. The others' strings are compared at
    anchors (see ``earlier_runs``), byte by byte in the end, so no hash decides.

    Null texts are empty; texts under LENGTH bytes lose nothing. Rows with a null id lose
    nothing and count as no earlier document. Rows that share an id are no earlier document
    to each other; each keeps its own result. An empty table gives no row.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(whole).bitwiseAND(F.lit(0xFFFFFFFF)).alias("text_key"),
        whole.alias("text"),
    )
    known = rows.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    digests = settle(known.select("doc_id", "text_key", F.sha2("text", 256).alias("digest")))
    firsts = digests.groupBy(F.col("digest").alias("f_digest")).agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1").withColumn("f_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = digests.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    same = (F.col("digest") == F.col("f_digest")) & (F.col("salt") == F.col("f_salt"))
    copies = (
        salted.join(firsts, same).filter("doc_id > first")
        .select(F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key"),
                F.lit(0).cast("long").alias("start"), F.lit(1 << 40).alias("end")).distinct()
    )
    runs = (
        earlier_runs(known).unionByName(copies).groupBy("m_id", "m_key")
        .agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    )
    return (
        rows.join(runs, (F.col("doc_id") == F.col("m_id")) & (F.col("text_key") == F.col("m_key")),
                  "left")
        .select("doc_id", "text", "runs")
        .mapInArrow(_cut, "doc_id long, n_removed long, n_spans long, kept binary")
        .select("doc_id", (F.octet_length("kept") + F.col("n_removed")).alias("n_bytes"),
                "n_removed", "n_spans", "kept")
    )
