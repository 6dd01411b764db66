import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tidewire import schemas as S
from tidewire.operators import contract

GOOD = {
    "schema_version": "1.0.0", "id": "x", "source": "replay", "title": "t", "body": "b",
    "published_at": at(0), "ingested_at": at(1),
}


def frame(spark, rows, schema=S.RAW):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def test_each_raw_rule(spark):
    broken = [
        {"schema_version": "9.9.9"}, {"id": ""}, {"source": "twitter"}, {"title": ""}, {"body": ""},
        {"published_at": None}, {"ingested_at": None},
    ]
    rows = frame(spark, [GOOD, *[GOOD | b for b in broken], GOOD | {"title": " "},
                         GOOD | {"id": "", "body": ""}])
    errors = [r.error for r in contract.validate_raw(rows).collect()]
    assert errors == [
        None, "schema_version is not 1.0.0", "id is required", "invalid source",
        "title is required", "body is required", "published_at is required",
        "ingested_at is required", None, "id is required",
    ]


def test_processed_rules(spark):
    good = GOOD | {"content_hash": "sha256:" + "a" * 64, "processed_at": at(2)}
    rows = frame(spark, [good, good | {"content_hash": "sha256:XYZ"}, good | {"processed_at": None},
                         good | {"title": ""}], S.PROCESSED)
    errors = [r.error for r in contract.validate_processed(rows).collect()]
    assert errors == [None, "content_hash does not match sha256:<64 hex>",
                      "processed_at is required", "title is required"]


WIRE = {
    "schema_version": "1.0.0", "id": "x", "source": "rss", "title": "t", "body": "b",
    "published_at": "2026-07-20T12:00:00Z", "ingested_at": "2026-07-20T12:00:01Z",
}
HASH = {"content_hash": "sha256:" + "0" * 64, "processed_at": "2026-07-20T12:00:02Z"}


@pytest.mark.parametrize("topic, message, violation", [
    ("news.raw", WIRE | {"url": "u", "feed": "f", "language": "en", "tickers": ["A"]}, None),
    ("news.raw", WIRE | {"tickers": []}, None),
    ("news.raw", {k: v for k, v in WIRE.items() if k != "id"}, "missing property: id"),
    ("news.raw", WIRE | {"sentiment": 0.91}, "unknown property"),
    ("news.raw", WIRE | HASH, "unknown property"),
    ("news.raw", WIRE | {"id": 5}, "wrong type: id"),
    ("news.raw", WIRE | {"language": "eng"}, "malformed language"),
    ("news.raw", WIRE | {"language": None}, "wrong type: language"),
    ("news.raw", WIRE | {"tickers": [1]}, "wrong type: tickers"),
    ("news.processed", WIRE | HASH, None),
    ("news.processed", WIRE | HASH | {"sentiment": 1}, "unknown property"),
    ("news.processed", WIRE | HASH | {"content_hash": "md5:1"}, "malformed content_hash"),
    ("news.processed", WIRE, "missing property: content_hash"),
])
def test_strict(spark, topic, message, violation):
    rows = spark.createDataFrame([(json.dumps(message),)], "value string")
    assert contract.check_contract(rows, topic).first().violation == violation


def test_processed_is_superset():
    assert {f.name for f in S.RAW} < {f.name for f in S.PROCESSED}


def test_decode_processed(spark):
    cases = [
        WIRE | HASH | {"tickers": ["NMBS"]},
        WIRE | HASH | {"tickers": None, "extra": 1},
        WIRE | HASH | {"schema_version": "2.0.0"},
        {k: v for k, v in (WIRE | HASH).items() if k != "body"},
        WIRE | HASH | {"published_at": "2026-07-20T14:00:00+02:00", "ingested_at": "2026-07-20T12:00:00"},
    ]
    rows = spark.createDataFrame([(json.dumps(c),) for c in cases] + [("{",)], "value string")
    got = contract.decode_processed(rows).collect()
    assert [r.error for r in got] == [
        None, None, "unsupported schema_version", "missing required field: body", None, "decode error"]
    assert got[0].tickers == ["NMBS"] and got[1].tickers == []
    assert got[4].published_at == got[0].published_at


def test_wire_round_trip_leaves_out_empty_fields(spark):
    rows = frame(spark, [GOOD | {"feed": "", "tickers": []}, GOOD | {"feed": "f", "tickers": ["A"]}])
    wire = contract.to_wire(rows)
    values = [json.loads(r.value) for r in wire.collect()]
    assert set(values[0]) == set(S.RAW_REQUIRED)
    assert values[1]["feed"] == "f" and values[1]["tickers"] == ["A"]
    assert values[0]["published_at"] == "2026-07-20T12:00:00Z"
    back = contract.decode_raw(wire).filter("error is null")
    assert back.count() == 2 and back.first().key == "x"
    assert wire.select(contract.strict_error(F.col("value")).alias("v")).filter("v is null").count() == 2
