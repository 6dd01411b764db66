"""Secrets in texts: fixed patterns, and windows of high Shannon entropy in candidate strings."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds of the fixed patterns, in the order that ties take.
BASE_KINDS = ("assign", "access", "hex")
MIN_ASSIGNED = 8
ACCESS_LENGTH = 16
HEX_LENGTH = 32

_ASSIGN = re.compile(
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
# a greedy run is as long as it gets, so the least length can stand in the pattern
_ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{ACCESS_LENGTH - 4},}}")
_HEX = re.compile(rf"[0-9a-f]{{{HEX_LENGTH},}}")
_KEYWORD = "(?:" + "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
) + r")[\"']?\x20*[:=]"

#: Entropies are sums of c * log2(c) in units of 2 ** -32, so that they add up exactly.
UNIT = 1 << 32
#: Windows of a lane: longer candidates are cut into lanes that overlap by a window.
LANE = 1024
#: Lanes worked on in step.
LANES = 4096


@dataclass(frozen=True)
class CharClass:
    """Candidate strings of one class: runs of ``chars`` of ``window`` characters or more.

    A window is a secret's if its entropy has ``min_bits`` per character at least and it holds
    characters of all ``kinds`` (0 digits, 1 upper case, 2 lower case).
    """

    name: str
    chars: str
    window: int
    min_bits: float
    kinds: tuple[int, ...]

    @property
    def most(self) -> int:
        """The greatest sum of c * log2(c) over the counts of a window that is a secret's."""
        return math.floor(self.window * (math.log2(self.window) - self.min_bits) * UNIT)


CLASSES = (
    CharClass("entropy_base64", "A-Za-z0-9+/_=-", 24, 3.9, (0, 1, 2)),
    CharClass("entropy_upper", "A-Z0-9", 20, 3.5, (0, 1)),
    CharClass("entropy_hex", "0-9a-f", 20, 2.9, (0, 2)),
)
#: Candidates that match one of these, in either case, hold no secret (fixed values).
ALLOWED = (
    "example", "sample", "dummy", "placeholder", "changeme", "redacted", "lorem", "x{6}",
    "abcdefgh", "qwerty", "01234567", "12345678", "deadbeef", r"(.)\1{7}",
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` of the fixed patterns, leftmost and without overlaps per kind."""
    found = [
        ("assign", *m.span()) for m in _ASSIGN.finditer(text)
        if m.end(1) - m.start(1) >= MIN_ASSIGNED
    ]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def _code_kinds() -> np.ndarray:
    kinds = np.full(256, 3, np.int64)
    for kind, (low, high) in enumerate(("09", "AZ", "az")):
        kinds[ord(low): ord(high) + 1] = kind
    return kinds


_KIND = _code_kinds()


def _lane_hits(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, kind: CharClass) -> np.ndarray:
    """For every lane and place whether the window that starts there is a secret's.

    All lanes move on by one character a step: the counts of the character that enters and of
    the one that leaves change the sum of c * log2(c), nothing else is computed anew.
    """
    window = kind.window
    weigh = np.array(
        [0] + [round(c * math.log2(c) * UNIT) for c in range(1, window + 2)], np.int64
    )
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    counts = np.zeros((len(starts), 128), np.int32)
    kinds = np.zeros((len(starts), 4), np.int32)
    sums = np.zeros(len(starts), np.int64)
    hits = np.zeros((len(starts), int(lengths[0]) - window + 1), bool)
    active = np.arange(len(starts))
    for step in range(int(lengths[0])):
        active = active[: int(np.searchsorted(-lengths[: len(active)], -step))]
        own = sums[: len(active)]
        entering = data[starts[active] + step]
        before = counts[active, entering]
        own += weigh[before + 1] - weigh[before]
        counts[active, entering] = before + 1
        kinds[active, _KIND[entering]] += 1
        if step >= window:
            leaving = data[starts[active] + step - window]
            before = counts[active, leaving]
            own -= weigh[before] - weigh[before - 1]
            counts[active, leaving] = before - 1
            kinds[active, _KIND[leaving]] -= 1
        if step >= window - 1:
            found = own <= kind.most
            for wanted in kind.kinds:
                found &= kinds[active, wanted] > 0
            hits[active, step - window + 1] = found
    out = np.zeros_like(hits)
    out[order] = hits
    return out


def entropy_spans(runs: Sequence[str], kind: CharClass) -> list[list[tuple[int, int]]]:
    """For every candidate the unions of its windows of high entropy, as ``start, end``."""
    window, out = kind.window, [[] for _ in runs]
    lanes = [
        (k, at, min(LANE + window - 1, len(run) - at))
        for k, run in enumerate(runs) for at in range(0, len(run) - window + 1, LANE)
    ]
    offsets = np.cumsum([0] + [len(r) for r in runs])
    data = np.frombuffer("".join(runs).encode("ascii"), np.uint8)
    for begin in range(0, len(lanes), LANES):
        some = lanes[begin: begin + LANES]
        starts = np.array([offsets[k] + at for k, at, _ in some])
        hits = _lane_hits(data, starts, np.array([n for *_, n in some]), kind)
        for lane, place in zip(*np.nonzero(hits)):
            run, at, _ = some[lane]
            start, spans = at + int(place), out[run]
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], start + window)
            else:
                spans.append((start, start + window))
    return out


def _found(texts: pa.Array, classes: Sequence[CharClass], allowed: Sequence[str]) -> list[list]:
    """``kind, start, end`` of all spans of every text, in order."""
    rank = {k: n for n, k in enumerate((*BASE_KINDS, *(c.name for c in classes)))}
    # texts without the beginning of a match never become Python strings
    runs = "|".join(f"[{c.chars}]{{{c.window}}}" for c in classes)
    maybe = pc.match_substring_regex(texts, f"{_KEYWORD}|AKIA|[0-9a-f]{{{HEX_LENGTH}}}")
    if runs:
        maybe = pc.or_(maybe, pc.match_substring_regex(texts, runs))
    rows = np.flatnonzero(maybe.to_numpy(zero_copy_only=False))
    own = texts.take(pa.array(rows)).to_pylist()
    out: list[list] = [[] for _ in range(len(texts))]
    base: list[list] = [base_spans(text) for text in own]
    allow = re.compile("|".join(f"(?:{a})" for a in allowed), re.ASCII | re.IGNORECASE)
    for kind in classes:
        pattern = re.compile(f"[{kind.chars}]{{{kind.window},}}")
        runs = [(k, m) for k, text in enumerate(own) for m in pattern.finditer(text)]
        if allowed:
            runs = [(k, m) for k, m in runs if not allow.search(m.group())]
        for (k, m), spans in zip(runs, entropy_spans([m.group() for _, m in runs], kind)):
            out[rows[k]] += [(kind.name, m.start() + a, m.start() + b) for a, b in spans]
    for k, row in enumerate(rows):
        out[row] = base[k] + _outside(out[row], base[k])
        out[row].sort(key=lambda s: (s[1], rank[s[0]]))
    return out


def _outside(spans: list, base: list) -> list:
    """The spans that do not lie within one of ``base``."""
    starts, reach = sorted(base, key=lambda s: s[1]), []
    for _, _, end in starts:
        reach.append(max(end, reach[-1]) if reach else end)
    begins = [s[1] for s in starts]
    at = np.searchsorted(begins, [s[1] for s in spans], side="right")
    return [s for s, n in zip(spans, at) if not n or reach[n - 1] < s[2]]


def find_secrets(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text",
    classes: Sequence[CharClass] = CLASSES, allowed: Sequence[str] = ALLOWED,
) -> DataFrame:
    """``doc_id, spans`` of every document; a span is ``kind, start, end`` in code points.

    Base kinds are those of ``base_spans``: names of secrets with what is assigned to them,
    access keys, long hexadecimal runs. The others are the character classes: in every run of
    a class's characters a window slides over the text, and windows of high Shannon entropy
    that overlap or touch make a span, unless the run is allowed or the span lies within one
    of the base. Spans come by start, then by kind in this order.

    Null and empty texts have no spans. Texts are scanned whole; very long candidates are cut
    into lanes that overlap by a window, which changes no result. Repeated rows give a row
    each, an empty table gives none, extra columns are ignored. No row is shuffled.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    schema = T.StructType([
        rows.schema["doc_id"],
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]))),
    ])
    made = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _found(batch["text"], classes, allowed)
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in found]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(spans, made)], names=["doc_id", "spans"]
            )

    return rows.mapInArrow(scan, schema)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in BASE_KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
