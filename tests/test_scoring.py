import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import at
from tidewire.functions import sentiment as M
from tidewire.operators import entities, scoring
from tidewire.operators import gazetteer as gazetteer_names


# (positive words, negative words): label, score. By hand: with t words in all, the share of a
# side counts t / (t + 2), and the rest is neutral; equal shares go to the first of the labels.
LABELS = {
    (0, 0): ("neutral", 0.0), (1, 0): ("neutral", 1 / 3), (0, 1): ("neutral", -1 / 3),
    (2, 0): ("positive", 1 / 2), (0, 2): ("negative", -1 / 2), (1, 1): ("neutral", 0.0),
    (2, 1): ("neutral", 1 / 5), (3, 1): ("positive", 1 / 3), (1, 3): ("negative", -1 / 3),
    (2, 2): ("positive", 0.0), (4, 3): ("positive", 1 / 9), (3, 4): ("negative", -1 / 9),
    (8, 0): ("positive", 4 / 5), (0, 8): ("negative", -4 / 5), (20, 10): ("positive", 5 / 16),
}


def test_lexicon_labels(spark):
    rows = spark.createDataFrame(list(LABELS), "p int, n int")
    s = M.lexicon_sentiment(F.col("p"), F.col("n"))
    got = {(r.p, r.n): r.s for r in rows.select("p", "n", s.alias("s")).collect()}
    for counts, (label, score) in LABELS.items():
        assert got[counts].score == pytest.approx(score, abs=1e-12), counts
        # near ties the order of the arithmetic decides; the catalog pins those
        if counts not in ((2, 0), (0, 2), (2, 1), (2, 2)):
            assert got[counts].label == label, counts


def items(spark, texts):
    return spark.createDataFrame(
        [(str(i), t, "", "h", "replay", None, at(0)) for i, t in enumerate(texts)],
        "id string, title string, body string, content_hash string, source string, "
        "tickers array<string>, published_at timestamp")


def test_finance_words(spark):
    rows = items(spark, [
        "A strong quarter: profits rose and margins gained",
        "A weak quarter: losses, a lawsuit, and guidance cut",
        "The annual meeting takes place in June",
    ])
    got = scoring.sentiment_results(scoring.score(rows, F.lit(at(1)))).orderBy("item_id").collect()
    assert [r.sentiment_label for r in got] == ["positive", "negative", "neutral"]
    assert got[0].sentiment_score > 0 > got[1].sentiment_score and got[2].sentiment_score == 0.0
    for r in got:
        assert abs(r.prob_positive + r.prob_negative + r.prob_neutral - 1) < 1e-9
        assert (r.model_name, r.quantized) == ("heuristic-lexicon-v1", False)


def test_batch_model_with_failures(spark):
    def load():
        def predict(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("cannot score")
            return [[0.1, 0.2, 0.7] if "up" in t else [0.6, 0.2, 0.2] for t in texts]
        return predict

    model = scoring.BatchModel("stub", load, True, ("negative", "neutral", "positive"))
    scored = scoring.score(items(spark, ["up", "down", "bad one"]), F.lit(at(1)), model)
    got = scoring.sentiment_results(scored).orderBy("item_id").collect()
    assert [(r.item_id, r.sentiment_label, round(r.sentiment_score, 6), r.quantized) for r in got] == [
        ("0", "positive", 0.6, True), ("1", "negative", -0.4, True)]
    assert scored.filter("sentiment is null").count() == 1


def test_model_fallback(spark, work_dir):
    missing = lambda: scoring.onnx_model(spark, work_dir, "classifier")
    assert isinstance(scoring.choose_model(missing), scoring.LexiconModel)
    assert isinstance(scoring.choose_model(missing, force_lexicon=True), scoring.LexiconModel)
    stub = scoring.BatchModel("stub", lambda: None)
    assert scoring.choose_model(lambda: stub) is stub


def test_shipped_model(spark, work_dir):
    import hashlib

    import numpy as np

    words = {"rise": 0, "fall": 1}
    n = 97
    weights = np.zeros((n, 2))
    for word, label in words.items():
        bucket = int(hashlib.md5(word.encode()).hexdigest()[:4], 16) % n
        weights[bucket, label] = 4.0
    path = f"{work_dir}/linear.npz"
    np.savez(path, weights=weights, bias=np.zeros(2), labels=np.array(["positive", "negative"]))
    model = scoring.linear_model(spark, path)
    got = scoring.sentiment_results(
        scoring.score(items(spark, ["RISE", "fall fall", "rise fall", " "]), F.lit(at(1)), model)
    ).orderBy("item_id").collect()
    high = 1 / (1 + np.exp(-4))
    assert [(r.sentiment_label, round(r.prob_positive, 9)) for r in got] == [
        ("positive", round(high, 9)), ("negative", round(1 - high, 9)), ("positive", 0.5), ("positive", 0.5)]
    assert got[0].model_name == "linear.npz" and got[0].prob_neutral == 0.0
    with pytest.raises(FileNotFoundError):
        scoring.ship(spark, f"{work_dir}/none")
    with pytest.raises(ValueError):
        scoring.ship(spark, path, f"{work_dir}/other/linear.npz")


def test_softmax_ties_and_missing_label(spark):
    rows = spark.createDataFrame([([1000.0, 1000.0],), ([0.0, 5.0],)], "l array<double>")
    s = M.label_from_probs(M.softmax(F.col("l")), ("negative", "positive"))
    got = [r.s for r in rows.select(s.alias("s")).collect()]
    assert got[0].label == "negative" and got[0].score == 0.0 and got[0].prob_neutral == 0.0
    assert got[1].label == "positive"


def with_text(spark, cases):
    return spark.createDataFrame(
        [(str(i), t, b, k) for i, (t, b, k) in enumerate(cases)],
        "id string, title string, body string, tickers array<string>")


CASES = [
    ("Notice", "nothing else", ["NMBS"]),
    ("", "today Helios Energy opened a plant", None),
    ("", "traders watched cblt closely", []),
    ("", "nmbs nmbs nmbs", ["nmbs", "NMBS"]),
    ("", "nobody known is mentioned here", None),
    ("", "xcblt cblty écblt cblt2", None),
    ("Nimbus", "robotics (NMBS), tranquill softwares", None),
    ("", "", None),
]
EXPECTED = [
    [("NMBS", "ticker")], [("Helios Energy", "company")], [("CBLT", "ticker")], [("NMBS", "ticker")],
    [], [], [("Nimbus Robotics", "company"), ("NMBS", "ticker"), ("Quill Software", "company")], [],
]


def test_entities(spark):
    got = entities.with_entities(with_text(spark, CASES)).orderBy("id").collect()
    assert [[tuple(e) for e in r.entities] for r in got] == EXPECTED


@pytest.mark.parametrize("most", [50_000, 0])
def test_entities_joined_equal_inline(spark, monkeypatch, most):
    """The automaton in the row, and the join by seeds of tables beyond its limit."""
    monkeypatch.setattr(gazetteer_names, "MOST_NAMES", most)
    rows = [(i, t, c) for i, (t, c) in enumerate(entities.DEFAULT_GAZETTEER.items())]
    rows += [(50, "B.C", "x"), (51, "é", "of")]
    gazetteer = spark.createDataFrame(rows, "ord int, ticker string, company string")
    cases = [*CASES, ("of b.c", "é éa B.CD", ["b.c"])]
    joined = entities.join_entities(with_text(spark, cases), gazetteer).orderBy("id").collect()
    inline = entities.with_entities(
        with_text(spark, cases), {t: c for _, t, c in rows}).orderBy("id").collect()
    assert [r.entities for r in joined] == [r.entities for r in inline]
    assert [tuple(e) for e in joined[-1].entities] == [
        ("B.C", "ticker"), ("of", "company"), ("é", "ticker")]


@pytest.mark.parametrize("most", [50_000, 0])
def test_names_in_rows_of_one_id(spark, monkeypatch, most):
    monkeypatch.setattr(gazetteer_names, "MOST_NAMES", most)
    rows = spark.createDataFrame(
        [("x", "Alpha Works today", "", None), ("x", "Beta Works today", "", ["zz"]), (None, None, "b", None)],
        "id string, title string, body string, tickers array<string>")
    table = spark.createDataFrame(
        [(1, "AW", "Alpha Works"), (2, "BW", "Beta Works"), (3, None, "today"), (4, "", "")],
        "ord int, ticker string, company string")
    got = {r.title: [e.text for e in r.entities] for r in entities.join_entities(rows, table).collect()}
    assert got == {"Alpha Works today": ["Alpha Works", "today"], None: [],
                   "Beta Works today": ["ZZ", "Beta Works", "today"]}
    nothing = entities.join_entities(rows, table.limit(0)).collect()
    assert [len(r.entities) for r in nothing] == [0, 1, 0]


@settings(max_examples=150, deadline=None)
@given(st.text("abAB_é .-1٣中", max_size=40), st.lists(st.text("abAB_é.-1中", min_size=1, max_size=9), min_size=1, max_size=6))
def test_automaton_equals_plain(text, names):
    """Against a regular expression per name, as the expressions of a mapping have it."""
    import regex

    text = text.lower()
    rows = [(k, kind, n, n.lower()) for k, n in enumerate(names) for kind in ("company", "ticker")]
    found = gazetteer_names._matcher(rows).func(iter([pd.Series([text, None], dtype=object)]))
    got = [(h["ord"], h["type"]) for h in list(found)[0][0]]

    def alone(needle):
        is_word = [bool(regex.match(r"[\p{L}\p{N}_]", c)) for c in (needle[0], needle[-1])]
        left, right = ("!" if w else "=" for w in is_word)
        word = r"[\p{L}\p{N}_]"
        return regex.search(f"(?<{left}{word}){regex.escape(needle)}(?{right}{word})", text)

    assert got == [(k, kind) for k, kind, _, n in rows if (n in text if kind == "company" else alone(n))]


def test_score_with_a_table_of_ten_thousand_names(spark):
    names = spark.range(10_000).selectExpr(
        "cast(id as int) ord", "concat('tk', id) ticker", "concat('company no ', id, ' of many') company")
    rows = with_text(spark, [("On TK4711 today", "and Company No 12 of many", None), ("none", "here", None)])
    scored = scoring.score(rows, F.lit(at(0)), gazetteer=names).orderBy("id").collect()
    assert [tuple(e) for e in scored[0].entities] == [
        ("company no 12 of many", "company"), ("tk4711", "ticker")]
    assert scored[1].entities == []


def test_entity_rows(spark):
    rows = with_text(spark, [("t", "apple", ["nmbs"])]).selectExpr(
        "*", "timestamp'2026-07-20' published_at", "'h' content_hash", "'rss' source")
    scored = scoring.score(rows, F.lit(at(0)), gazetteer={"APPLE": "APPLE", "X": "apple"})
    assert sorted((r.entity, r.entity_type) for r in scoring.entity_sentiments(scored).collect()) == [
        ("APPLE", "company"), ("APPLE", "ticker"), ("NMBS", "ticker"), ("apple", "company")]
    assert sorted(r.entity for r in scoring.entity_series(scored).collect()) == ["APPLE", "NMBS", "apple"]
