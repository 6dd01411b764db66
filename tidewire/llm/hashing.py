"""Hashes of all words and shingles of a batch of texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Odd multipliers of 64 bits (fixed values; any would do).
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
#: Bytes of text worked on at once: temporaries take about 50 times this.
CHUNK = 1 << 20


def multipliers(count: int, seed: int) -> np.ndarray:
    """Random odd 64-bit numbers."""
    return np.random.default_rng(seed).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + (
        np.uint64(1)
    )


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def byte_chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``first row, bytes, offsets`` of runs of whole texts of about ``size`` bytes; null is empty."""
    if not len(texts):
        return
    whole = pa.array(texts.fill_null("")).cast(pa.large_string())
    _, where, data = whole.buffers()
    offsets = np.frombuffer(where, np.int64)[whole.offset: whole.offset + len(whole) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(whole):
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), len(whole))
        yield row, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out) if count else out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (bytes A-Z in lower case) and the words before each text.

    Words are runs without blank or controls 9 to 13. A word is a polynomial of its bytes,
    shifted to its own start with the inverse of the base, then mixed.
    """
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    inside = ~blank
    begins = inside.copy()
    begins[1:] &= blank[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    before = np.concatenate([[0], np.cumsum(begins)])[offsets]
    if not len(starts):
        return np.zeros(0, np.uint64), before
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64) + np.uint64(1)
    lower[blank] = 0
    terms = lower * _powers(STEP, len(data))
    inverse = np.uint64(pow(int(STEP), -1, 1 << 64))
    return mixed(np.add.reduceat(terms, starts) * _powers(inverse, len(data))[starts]), before


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text cut at blanks into pieces of about CHUNK bytes; words are never cut."""
    blanks = np.flatnonzero((data == 32) | ((data >= 9) & (data <= 13)))
    start = 0
    while len(data) - start > CHUNK:
        at = int(np.searchsorted(blanks, start + CHUNK))
        if at == len(blanks):
            break
        yield data[start: blanks[at]]
        start = int(blanks[at])
    yield data[start:]


def text_words(texts: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of every text. Texts over two chunks are hashed piece by piece, so that
    memory beyond the text and eight bytes a word depends on CHUNK (or the longest word)."""
    for _, data, offsets in byte_chunks(texts):
        if len(data) > 2 * CHUNK and len(offsets) == 2:
            yield np.concatenate([
                word_hashes(piece, np.array([0, len(piece)]))[0] for piece in _pieces(data)
            ])
            continue
        words, before = word_hashes(data, offsets)
        for start, end in zip(before[:-1], before[1:]):
            yield words[start:end]


SHINGLE = 5
_PLACES = multipliers(SHINGLE, 11)


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles of one text; of the whole if shorter."""
    n = min(len(words), SHINGLE)
    if not n:
        return words
    last = len(words) - n + 1
    total = np.zeros(last, np.uint64)
    for place in range(n):
        total += words[place: place + last] * _PLACES[place]
    return np.unique(mixed(total + np.uint64(n)))
