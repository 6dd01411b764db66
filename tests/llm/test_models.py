"""Classifiers by held-out accuracy, vectors by recall, and odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import helpers as H
from tidewire.llm import embedding_dedup, lang_id, quality_model

SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["stra", "ung", "eck"], "cc": ["ção", "lhe", "ique"]}


def speech(draw, lang, k=40):
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 4))) for _ in range(k))


def test_languages(spark):
    draw = random.Random(2)
    rows = [(i, speech(draw, lang := draw.choice("abc") * 2), lang, "s", 0) for i in range(400)]
    rows += [(9001, None, "aa", "s", 0), (9002, "12 -- !", "aa", "s", 0), (9003, "", None, "s", 0),
             (9004, speech(draw, "bb", 30_000), None, "s", 0), (None, speech(draw, "cc"), "cc", "s", 0)]
    docs = spark.createDataFrame(rows, H.SCHEMA).selectExpr("*", "'x' held_out", "'x' letters")
    found = lang_id.identify(docs).collect()
    assert len(found) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 9000]
    assert len(held) > 40
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    at = {r.doc_id: r for r in found}
    assert all(at[i].lang_pred == "und" and at[i].score == 0 for i in (9001, 9002, 9003))
    assert at[9004].lang_pred == "bb" and at[None].lang_pred == "cc"
    assert all(0 <= r.score <= 1 for r in found)


def test_languages_without_labels(spark):
    docs = H.documents(spark, [(1, "some words", "s"), (2, None, "s")]).selectExpr(
        "doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in lang_id.identify(docs).collect()} == {"und"}
    assert lang_id.identify(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def judged(spark):
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        text = speech(draw, draw.choice("ab") * 2, draw.randint(20, 80))
        good = i % 4 != 0
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split()) if i % 8 else "spam " * 40
        rows.append((i, text, "s"))
        labels.append((i, int(good)))
    return rows, labels


def test_quality_model(spark, judged):
    rows, labels = judged
    odd = [(9001, None, "s"), (9002, "", "s"), (9003, "w " * 20_000, "s"), (None, "w", "s")]
    docs = H.documents(spark, rows + odd).selectExpr("*", "'x' label", "'x' raw", "'x' upper")
    table = spark.createDataFrame(labels + [(9001, None), (None, 1)], "doc_id long, quality int")
    found = quality_model.classify(docs, table).collect()
    assert len(found) == len(rows) + len(odd)
    truth = dict(labels)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 60
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)


def test_quality_model_is_the_same_however_rows_are_dealt(spark, judged):
    rows, labels = judged
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = H.documents(spark, rows)
    shuffled = random.Random(1).sample(rows, len(rows))
    other = H.documents(spark, shuffled).repartition(7)
    scores = [
        {r.doc_id: (r.score, r.predicted) for r in quality_model.classify(d, t).collect()}
        for d, t in ((docs, table), (other, table.repartition(3)))
    ]
    assert scores[0] == scores[1] and len(set(scores[0].values())) > 5


def test_quality_model_without_labels(spark, judged):
    docs = H.documents(spark, judged[0][:5])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_model.classify(docs, none).collect()} == {0.5}
    assert quality_model.classify(docs.limit(0), none).count() == 0


def test_isotonic_is_monotone_and_keeps_the_mean():
    draw = np.random.default_rng(0)
    x = np.sort(draw.random(50))
    total = draw.integers(1, 30, 50)
    hits = draw.binomial(total, x)
    at, level = quality_model.isotonic(x, hits, total)
    assert all(b > a for a, b in zip(level, level[1:])) and all(np.diff(at) > 0)


def vectors(seed=6):
    draw = np.random.default_rng(seed)
    rows = []
    for group in range(12):
        center = draw.standard_normal(32)
        for _ in range(group + 1):
            rows.append(center + draw.standard_normal(32) * 0.25 * draw.random())
    rows += list(draw.standard_normal((150, 32)))
    rows += [rows[3], rows[3] * 1.0, rows[40]]
    return [[float(np.float32(x)) for x in r] for r in rows]


def plain_links(rows):
    unit = np.array(rows)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    return near.sum(axis=1), H.reach(range(len(rows)), [tuple(map(int, p)) for p in np.argwhere(near)])


@pytest.mark.parametrize("block", [4, 1024])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors()
    table = spark.createDataFrame(
        [(i, r, 0) for i, r in enumerate(rows)], "vec_id long, embedding array<float>, label int"
    ).selectExpr("*", "'x' id", "'x' key", "'x' unit")
    found = {r.vec_id: r for r in embedding_dedup.near_vectors(table).collect()}
    links, roots = plain_links(rows)
    assert sum(r.n_links for r in found.values()) >= 0.9 * links.sum()
    assert all(found[i].n_links <= links[i] for i in found)
    right = sum(found[i].component_id == roots[i] for i in found)
    assert right >= 0.95 * len(rows)


@pytest.mark.parametrize("shared", [0.0, 0.5, 0.7])
def test_vectors_with_a_common_mean(spark, shared):
    draw = np.random.default_rng(8)

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    n, mean = 1000, unit(draw.standard_normal(64))
    x = unit(np.sqrt(shared) * mean + np.sqrt(1 - shared) * unit(draw.standard_normal((n, 64))))
    aside = draw.standard_normal((n, 64))
    aside = unit(aside - (aside * x).sum(axis=1)[:, None] * x)
    y = 0.9001 * x + np.sqrt(1 - 0.9001**2) * aside
    rows = np.concatenate([x, y])
    table = spark.createDataFrame(
        [(i, r) for i, r in enumerate(rows.tolist())], "vec_id long, embedding array<double>"
    )
    found = {r.vec_id: r for r in embedding_dedup.near_vectors(table).collect()}
    links, _ = plain_links(rows)
    assert links.sum() >= 2 * n and all(found[i].n_links <= links[i] for i in found)
    assert sum(r.n_links for r in found.values()) >= 0.9 * links.sum()


def test_vectors_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [3.0, 4.0]), (8, [3.0, 4.0]), (8, [3.0, 4.0]), (9, [6.0, 8.0]), (None, [3.0, 4.0]),
            (10, [3.0, 4.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", *[f"'clash' {c}" for c in ("id", "key", "part", "code", "kept", "n_links", "bucket")])
    found = embedding_dedup.near_vectors(table).collect()
    assert len(found) == len(rows)
    at = {r.vec_id: r for r in found}
    assert all(at[i].n_links == 0 and at[i].kept and at[i].component_id == i
               for i in (1, 2, 3, 4, 5, 6, 10))
    assert at[7].n_links == 3 and at[9].n_links == 3 and at[9].component_id == 7
    assert at[None].n_links == 0 and at[None].kept
    assert embedding_dedup.near_vectors(table.limit(0)).count() == 0


def test_only_near_codes_move_vectors():
    """Of entries that share buckets, those with a partner of a near code, once a pair."""
    draw = np.random.default_rng(4)
    size, n = 32, 300
    x = draw.standard_normal((n, size))
    x[200:] = x[100:200] + draw.standard_normal((100, size)) * 0.2
    x /= np.linalg.norm(x, axis=1)[:, None]
    center, planes = np.zeros(size), embedding_dedup.learn_rotations(x, 512)
    codes = embedding_dedup._codes(x, center, planes)
    bits, far = 6, 120
    keys = (codes & 63) | np.arange(32) << 16 | size << 32
    rows = sorted((int(keys[i, t]), i) for i in range(n) for t in range(32))
    batch = pa.table({
        "key": [k for k, _ in rows], "part": pa.array([0] * len(rows), pa.int64()),
        "side": pa.array([2] * len(rows), pa.int32()), "id": [i for _, i in rows],
        "code": [codes[i].astype("<u2").tobytes() for _, i in rows],
    }).combine_chunks().to_batches()
    found = embedding_dedup._candidates({size: (bits, far)})(iter(batch))
    got = sorted((r["key"], r["id"]) for b in found for r in b.to_pylist())
    apart = (codes[:, None, :] ^ codes[None, :, :]).astype(np.uint64)
    near = np.bitwise_count(apart).sum(axis=2) <= far
    want = set()
    for i, j in np.argwhere(near):
        shared = np.flatnonzero(keys[i] == keys[j])
        if i < j and len(shared):
            want |= {(int(keys[i, shared[0]]), int(i)), (int(keys[j, shared[0]]), int(j))}
    assert got == sorted(want) and 150 < len(got) < len(rows) / 8
