from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewire.functions import text as X


def values(spark, inputs, fn):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r.out for r in rows.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_normalize(spark):
    cases = {
        "\tTwo  Harbours\n \r in FOG ": "two harbours in fog",
        "Ore PRICES": "ore prices",
        "q\x07\x1fz": "qz",
        " \n\t ": "",
        "a \x00 b": "a b",
        "x \u0085\u000b　y": "x y",
        "Été": "été",
        "İSTANBUL": "istanbul",
        "ΟΣ": "οσ",
        "A\x01́": "á",
        "\x00": "",
    }
    assert values(spark, list(cases), X.normalize_text) == list(cases.values())


def test_clean_text(spark):
    cases = {
        "<div>Tin &amp;&nbsp;<i>copper</i></div>\t\n rise": "Tin & copper rise",
        "&lt;b&gt; stays": "<b> stays",
        "&amp;quot;": "&quot;",
        "caf&eacute; &#8364; &notin;": "café € ∉",
        "plain": "plain",
        "": "",
    }
    assert values(spark, list(cases), X.clean_text) == list(cases.values())


def test_normalize_lang(spark):
    cases = {
        " English ": "en", "EN-nz": "en", "pt_BR": "pt", "SV": "sv", " ": "", "UND": "",
        "unknown": "", "French": "french", "-en": "-en", " de-AT ": "de",
    }
    assert values(spark, list(cases), X.normalize_lang) == list(cases.values())
    assert values(spark, [None], X.normalize_lang) == [""]


@pytest.mark.parametrize("text, expected", [
    ("Mon, 20 Jul 2026 12:00:00 +0000", datetime(2026, 7, 20, 12)),
    ("2026-07-20T12:00:00Z", datetime(2026, 7, 20, 12)),
    ("Mon, 20 Jul 2026 12:00:00 EST", datetime(2026, 7, 20, 12)),
    ("Mon, 20 Jul 2026 12:00:00 GMT+2", datetime(2026, 7, 20, 10)),
    ("Mon, 2 Jul 2026 12:00:00 -0700", datetime(2026, 7, 2, 19)),
    ("Mon, 2 Jul 2026 12:00:00 GMT", None),
    ("20 Jul 26 12:00 GMT", datetime(2026, 7, 20, 12)),
    ("20 Jul 69 12:00 +0100", datetime(1969, 7, 20, 11)),
    ("2026-07-20T12:00:00.123456789+05:30", datetime(2026, 7, 20, 6, 30, 0, 123456)),
    ("2026-07-20 12:00:00", None),
    ("Mon, 31 Feb 2026 12:00:00 +0000", None),
    ("garbage", None), ("", None), (None, None),
])
def test_parse_feed_date(spark, text, expected):
    parsed = values(spark, [text], lambda c: F.date_format(
        X.parse_feed_date(c), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert parsed == [expected and expected.strftime("%Y-%m-%d %H:%M:%S.%f")]


def test_compact_date_and_rfc3339(spark):
    back = lambda c: X.format_rfc3339(X.parse_compact_date(c))
    assert values(spark, ["20260720T120000Z", " 20260720T000010Z ", "20261320T000000Z", "x"], back) == [
        "2026-07-20T12:00:00Z", "2026-07-20T00:00:10Z", None, None]
    iso = lambda c: X.format_rfc3339(X.parse_iso(c))
    assert values(spark, ["2026-07-20T12:00:00.500100Z", "2026-07-20T12:00:00", "2026-07-20T12:00:00-01:00"],
                  iso) == ["2026-07-20T12:00:00.5001Z", "2026-07-20T12:00:00Z", "2026-07-20T13:00:00Z"]


def test_first_non_empty_and_model_text(spark):
    rows = spark.createDataFrame(
        [(" a ", "b"), ("", "  b"), (None, None), (" ", "b. ")], "t string, b string")
    got = rows.select(
        X.first_non_empty(F.col("t"), F.col("b")).alias("first"),
        X.model_text(F.col("t"), F.col("b")).alias("text"),
    ).collect()
    assert [tuple(r) for r in got] == [("a", "a. b"), ("b", "b"), ("", ""), ("b.", "b.")]


def test_plain_text_skips_python(spark):
    """Rows that cannot change reach the UDFs as NULL."""
    plan = spark.range(1).select(X.normalize_text(F.col("id").cast("string")))._jdf.queryExecution().toString()
    assert "_compose(CASE WHEN RLIKE" in plan
