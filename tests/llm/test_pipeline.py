"""The pipeline stage by stage against plain versions, and its queries on the given tables."""

import pytest

import corpus_pipeline
from tests.check_oracle import connect, difference
from tests.llm import helpers as H
from tests.llm.test_documents import ODD, clashing, plain_lines, sample_rows
from tidewire.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def kept(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_in_order(spark):
    rows = [(i, t + " " + " ".join(f"p{i}x{k}" for k in range(25)), s)
            for i, t, s in sample_rows(8, 48)]
    rows += [(100 + i, "Shared foot line here\n" + " ".join(f"q{i}x{k}" for k in range(30)), f"s{i}")
             for i in range(12)]
    docs = H.documents(spark, rows)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    rules, lines, near, mix, pack = [f for _, f in corpus_pipeline.STAGES]

    first = rules(spark, docs, "")
    assert first.columns == docs.columns
    own = {i: H.quality_counts(t) for i, t, _ in rows}
    passed = kept(first)
    assert all(own[i]["n_words"] >= 20 for i in passed)
    clean = [i for i in own if i >= 100]
    assert set(clean) <= set(passed)

    second = lines(spark, first, "")
    some = [r for r in rows if r[0] in passed]
    assert kept(second) == plain_lines(some, 10)
    assert all(r.n_chars == len(r.text) for r in second.collect() if r.text != passed[r.doc_id])

    third = near(spark, second, "")
    roots = H.near_components([(i, t, None) for i, t in kept(second).items()])
    assert set(kept(third)) == {i for i, root in roots.items() if i == root}

    fourth = mix(spark, third, "")
    assert fourth.columns == docs.columns
    words = sum(len(H.words(t)) for t in kept(third).values())
    taken = [len(H.words(r.text)) for r in fourth.collect()]
    assert abs(sum(taken) - 1.5 * words) <= max(taken)

    fifth = pack(spark, fourth, "")
    assert {r.doc_id for r in fifth.collect()} == {r.doc_id for r in fourth.collect()}


def test_stages_on_odd_tables(spark):
    for docs in (clashing(H.documents(spark, ODD)), H.documents(spark, [])):
        rows = docs
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            rows = stage(spark, rows, "")
            if number < 4:
                assert rows.columns == docs.columns
        rows.count()


def test_run(spark):
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert found and max(r.offset + r.length for r in found) <= 2048


def test_queries_read_whole_tables(spark):
    n = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").count()
    for name, query in QUERIES.items():
        frame = query(spark, SF_DIR)
        if name.startswith(("op11_", "op12_")):  # a row per part or group; their SQL has the totals
            part = "part" if name.startswith("op11_") else "source"
            parts = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("source").distinct().count()
            assert frame.select(part).distinct().count() == parts
            continue
        key = "vec_id" if "vec_id" in frame.columns else "doc_id"
        assert frame.select(key).distinct().count() == (vectors if key == "vec_id" else n), name


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    ours = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(ours, connect(SF_DIR).execute(ORACLE_SQL[name]).df()) is None
