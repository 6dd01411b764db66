"""Plain versions of the corpus operators, row by row, for comparison."""

import re
from collections import Counter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def documents(spark, rows):
    """Rows of (doc_id, text, source) as a documents table."""
    data = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    return spark.createDataFrame(data, SCHEMA)


def quality_counts(text):
    text = text or ""
    own = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(own[i: i + 8]) for i in range(len(own) - 7)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    return {
        "n_words": len(own),
        "word_chars": sum(map(len, own)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def shingle_set(text):
    own = words(lower(text))
    if not own:
        return set()
    return {tuple(own[i: i + 5]) for i in range(max(len(own) - 4, 1))}


def reach(nodes, pairs):
    """Smallest reachable node of every node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_components(rows):
    sets = {i: shingle_set(t) for i, t, *_ in rows}
    ids = sorted(sets)
    pairs = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return reach(ids, pairs)


def without_earlier(rows, length=50):
    """``doc_id -> (bytes, removed, spans, kept)`` by looking at every string."""
    data = {i: (t or "").encode() for i, t, *_ in rows}
    first = {}
    for i in sorted(data):
        for p in range(len(data[i]) - length + 1):
            first.setdefault(data[i][p: p + length], i)
    out = {}
    for i, raw in data.items():
        gone = [False] * len(raw)
        for p in range(len(raw) - length + 1):
            if first[raw[p: p + length]] < i:
                gone[p: p + length] = [True] * length
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g))
    return out
