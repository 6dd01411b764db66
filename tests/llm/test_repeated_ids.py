"""Rows that share an id: texts and vectors link by what they hold, not by their id."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import helpers as H
from tests.llm.test_documents import clashing, sample_rows
from tests.llm.test_models import plain_links, vectors
from tidewire.llm import embedding_dedup, hashing, lang_id, mixing, near_dedup


def words(name, n=60, changed=0):
    own = [f"{name}{i}" for i in range(n)]
    own[:changed] = [f"{name}new{i}" for i in range(changed)]
    return " ".join(own)


def plain_rows(rows):
    """``(doc_id, text) -> component_id``, rows being documents of their own."""
    links = H.near_components([(k, t) for k, (_, t, _) in enumerate(rows)])
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[links[k]] = min(i, least.get(links[k], i))
    return {(i, t): least.get(links[k], i) for k, (i, t, _) in enumerate(rows)}


def shuffled_ids(seed=9):
    """Sample rows of which many share an id, have none, or are repeated."""
    draw = random.Random(seed)
    rows = [(draw.choice([None, i // 2, i // 2, i]), t, s) for i, t, s in sample_rows(seed, 60)]
    return rows + draw.sample(rows, 12)


LOST = [(1, words("a"), "s"), (1, words("b"), "s"), (2, words("a", changed=2), "s"),
        (3, words("b", changed=2), "s")]


def test_no_link_is_lost(spark):
    found = near_dedup.near_duplicates(H.documents(spark, LOST)).collect()
    assert {r.doc_id: (r.component_id, r.kept) for r in found if r.doc_id > 1} == {
        2: (1, False), 3: (1, False)}


@pytest.mark.parametrize("seed", [9, 10])
def test_components_of_rows(spark, seed):
    rows = shuffled_ids(seed)
    docs = H.documents(spark, rows)
    grouped = near_dedup._grouped(docs.select("doc_id", "text", F.sha2("text", 256).cast("binary").alias("tag")))
    texts = {digest(t): t for _, t, _ in rows}
    found = {
        (r.doc_id, texts[bytes(r.tag).decode()]):
        r.doc_id if r.component_id is None else r.component_id for r in grouped.collect()
    }
    assert found == plain_rows(rows)
    assert near_dedup.near_duplicates(docs).count() == len(rows)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("seed", [9, 11])
def test_one_row_of_each_group_stays(spark, seed):
    rows = shuffled_ids(seed) + [(None, "", "s"), (None, "", "s"), (7, None, None)]
    links = H.near_components([(k, t) for k, (_, t, _) in enumerate(rows)])
    docs = clashing(H.documents(spark, rows))
    for stage in (near_dedup.keep_one, lambda d: corpus_pipeline.near_dedup_documents(spark, d, "")):
        kept = stage(docs)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        left = [(r.doc_id, r.text) for r in kept.collect()]
        groups = {}
        for k, (i, t, _) in enumerate(rows):
            groups.setdefault(links[k], []).append((i, t))
        for group in groups.values():
            some = [x for x in left if x in group]
            if not H.words(group[0][1]):
                continue
            assert len(some) == 1
            ids = [i for i, _ in group if i is not None]
            assert some[0][0] == (min(ids) if ids else None)
        assert sum(not H.words(t) for _, t in left) == 3


def test_equal_rows_leave_one(spark):
    text = words("p")
    rows = [(1, text, "s"), (1, text, "s"), (2, text, "s"), (None, text, "s"), (None, text, "s")]
    assert [r.doc_id for r in near_dedup.keep_one(H.documents(spark, rows)).collect()] == [1]
    assert near_dedup.keep_one(H.documents(spark, [])).count() == 0


def test_the_mix_of_repeated_rows(spark):
    """Rows equal in id, source and size have as many copies together as the mix takes."""
    draw = random.Random(5)
    rows = [(i // 7 if i % 3 else None, "w " * (4 + i % 2), f"s{i % 5}") for i in range(700)]
    rows += [(9000 + i, "w " * draw.randint(1, 40), f"s{i % 9}") for i in range(400)]
    docs = H.documents(spark, rows)
    taken = {}
    for r in mixing.mix(docs).collect():
        taken[r.doc_id, r.source, r.size] = taken.get((r.doc_id, r.source, r.size), 0) + r.copies
    mixed = {}
    for r in mixing.mixed_documents(clashing(docs)).collect():
        key = r.doc_id, r.source, len(H.words(r.text))
        mixed[key] = mixed.get(key, 0) + 1
    assert mixed == {k: n for k, n in taken.items() if n}


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    draw = random.Random(1)
    texts = ["".join(draw.choices("aBé \n\tß", k=n)) for n in (0, 5, 90, 400, 3000)] + ["x" * 500, " " * 300]
    texts += [" ".join("w" * draw.randint(1, 90) for _ in range(60))]
    whole = [x.tolist() for x in hashing.text_words(pa.array(texts))]
    monkeypatch.setattr(hashing, "CHUNK", 32)
    monkeypatch.setattr(hashing.byte_chunks, "__defaults__", (32,))
    assert [x.tolist() for x in hashing.text_words(pa.array(texts))] == whole
    assert [len(x) for x in whole] == [len(H.words(t)) for t in texts]


def test_languages_of_repeated_ids(spark):
    """One id on very many rows: the fit is bounded and the same in every run."""
    words = {"en": "the of and to in".split(), "de": "der und die ist nicht".split()}
    draw = random.Random(3)
    rows = [(1 if i % 2 else i, " ".join(draw.choices(words[lang], k=12)), lang)
            for i in range(600) for lang in words] + [(7, " ".join(f"long{i}" for i in range(30_000)), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.selectExpr("*", "'x' held_out", "'x' letters", "'x' score", "'x' id", "'x' n")
    first, second = ([tuple(r) for r in lang_id.identify(d).orderBy("doc_id", "score", "lang_pred").collect()]
                     for d in (docs, docs.repartition(7)))
    assert first == second and len(first) == len(rows)
    right = lang_id.identify(docs).join(docs.select("doc_id", "lang").distinct(), "doc_id")
    assert right.filter("doc_id <> 1 and lang = lang_pred").count() > 0.45 * right.filter("doc_id <> 1").count()


def test_vectors_of_one_id(spark):
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    near_a, near_b = [0.95, 0.31, 0.0, 0.0], [0.0, 0.95, 0.31, 0.0]
    rows = [(5, a), (5, b), (2, near_a), (3, near_b), (5, a), (4, b)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(
        (r.vec_id, r.n_links, r.component_id, r.kept)
        for r in embedding_dedup.near_vectors(table).collect()
    )
    assert found == [(2, 2, 2, True), (3, 2, 3, True), (4, 2, 3, False), (5, 2, 2, False),
                     (5, 2, 2, False), (5, 2, 3, False)]


def test_vectors_of_many_lengths(spark):
    """Every length is learned; a partner at 0.95 is found in each."""
    draw = random.Random(2)
    rows = []
    for size in range(4, 16):
        for k in range(30):
            x = [draw.gauss(0, 1) for _ in range(size)]
            y = [v + draw.gauss(0, 0.03) for v in x]
            rows += [(len(rows), x), (len(rows) + 1, y)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in embedding_dedup.near_vectors(table).collect()}
    assert sum(n > 0 for n in found.values()) >= 0.97 * len(rows)


def test_no_bits_find_every_link(spark, monkeypatch):
    """Where no number of bits finds enough, all vectors share a bucket: slow, but exact."""
    monkeypatch.setattr(embedding_dedup, "table_bits", lambda *_: (0, 512))
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rows = vectors()[:80]
    table = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in embedding_dedup.near_vectors(table).collect()}
    links, roots = plain_links(rows)
    assert {i: r.n_links for i, r in found.items()} == dict(enumerate(links))
    assert {i: r.component_id for i, r in found.items()} == roots
