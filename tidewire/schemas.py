"""Declared row shapes and message-contract constants. Nothing is ever inferred."""

from pyspark.sql import types as T

# Fixed values of the message contract.
SCHEMA_VERSION = "1.0.0"
SOURCES = ("replay", "gdelt", "rss")
CONTENT_HASH_PATTERN = "^sha256:[0-9a-f]{64}$"
LANGUAGE_PATTERN = "^[a-z]{2}$"
RAW_REQUIRED = (
    "schema_version", "id", "source", "title", "body", "published_at", "ingested_at",
)
PROCESSED_REQUIRED = (
    "schema_version", "id", "content_hash", "source", "title", "body",
    "published_at", "ingested_at", "processed_at",
)


_TEXT, _DOUBLE, _TIME = T.StringType(), T.DoubleType(), T.TimestampType()
_TEXTS = T.ArrayType(_TEXT)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def _raw(time: T.DataType) -> list[tuple[str, T.DataType]]:
    return [
        ("schema_version", _TEXT), ("id", _TEXT), ("source", _TEXT), ("feed", _TEXT),
        ("url", _TEXT), ("title", _TEXT), ("body", _TEXT), ("language", _TEXT),
        ("published_at", time), ("ingested_at", time), ("tickers", _TEXTS),
    ]


def _processed(time: T.DataType) -> list[tuple[str, T.DataType]]:
    raw = _raw(time)
    return [*raw[:2], ("content_hash", _TEXT), *raw[2:-1], ("processed_at", time), raw[-1]]


RAW = _struct(*_raw(_TIME))
PROCESSED = _struct(*_processed(_TIME))
SCORED = _struct(
    ("item_id", _TEXT), ("content_hash", _TEXT), ("source", _TEXT), ("sentiment_label", _TEXT),
    ("sentiment_score", _DOUBLE), ("prob_positive", _DOUBLE), ("prob_negative", _DOUBLE),
    ("prob_neutral", _DOUBLE), ("model_name", _TEXT), ("quantized", T.BooleanType()),
    ("published_at", _TIME), ("inferred_at", _TIME),
)
ENTITY = _struct(
    ("item_id", _TEXT), ("entity", _TEXT), ("entity_type", _TEXT), ("sentiment_score", _DOUBLE),
    ("published_at", _TIME), ("inferred_at", _TIME),
)
SHOCK = _struct(
    ("entity", _TEXT), ("item_id", _TEXT), ("zscore", _DOUBLE), ("velocity", _DOUBLE),
    ("mean_velocity", _DOUBLE), ("std_velocity", _DOUBLE), ("window_seconds", T.IntegerType()),
    ("threshold", _DOUBLE), ("sentiment_score", _DOUBLE), ("triggered_at", _TIME),
)

# Wire shapes: times stay text so that the contract, not the parser, judges them.
RAW_WIRE = _struct(*_raw(_TEXT))
PROCESSED_WIRE = _struct(*_processed(_TEXT))
GDELT_RESPONSE = _struct(
    ("articles", T.ArrayType(_struct(
        ("url", _TEXT), ("title", _TEXT), ("seendate", _TEXT), ("domain", _TEXT),
        ("language", _TEXT),
    ))),
)
RSS_DOCUMENT = _struct(
    ("channel", _struct(
        ("language", _TEXT),
        ("item", T.ArrayType(_struct(
            ("title", _TEXT), ("link", _TEXT), ("description", _TEXT), ("pubDate", _TEXT),
            ("guid", _TEXT),
        ))),
    )),
)
ATOM_DOCUMENT = _struct(
    ("_xml:lang", _TEXT),
    ("_lang", _TEXT),
    ("entry", T.ArrayType(_struct(
        ("title", _TEXT), ("id", _TEXT), ("updated", _TEXT), ("summary", _TEXT),
        ("content", _TEXT),
        ("link", T.ArrayType(_struct(("_href", _TEXT), ("_rel", _TEXT)))),
    ))),
)
