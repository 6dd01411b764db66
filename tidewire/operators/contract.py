"""Message contract: decoding, validation, strict conformance and wire encoding."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire import schemas as S
from tidewire.functions import text as X
from tidewire.functions.columns import compute_once

_ZERO_TIME = "0001-01-01 00:00:00"
_RAW_COLUMNS = [f.name for f in S.RAW]
_PROCESSED_COLUMNS = [f.name for f in S.PROCESSED]


def _blank(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def _no_time(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == F.lit(_ZERO_TIME).cast("timestamp"))


def _contract_error(required: tuple[str, ...], times: tuple[str, ...]) -> Column:
    """First broken rule in contract order, NULL for a valid row."""
    broken: dict[str, tuple[Column, str]] = {}
    for name in required:
        if name == "schema_version":
            rule = (
                F.coalesce(F.col(name), F.lit("")) != S.SCHEMA_VERSION,
                f"schema_version is not {S.SCHEMA_VERSION}",
            )
        elif name == "source":
            valid = F.coalesce(F.col(name).isin(*S.SOURCES), F.lit(False))
            rule = (~valid, "invalid source")
        elif name == "content_hash":
            valid = F.coalesce(F.col(name).rlike(S.CONTENT_HASH_PATTERN), F.lit(False))
            rule = (~valid, "content_hash does not match sha256:<64 hex>")
        elif name in times:
            rule = (_no_time(name), f"{name} is required")
        else:
            rule = (_blank(name), f"{name} is required")
        broken[name] = rule
    chain = F.when(F.lit(False), F.lit(""))
    for condition, message in broken.values():
        chain = chain.when(condition, F.lit(message))
    return chain


def raw_error() -> Column:
    return _contract_error(S.RAW_REQUIRED, ("published_at", "ingested_at"))


def processed_error() -> Column:
    return _contract_error(
        S.PROCESSED_REQUIRED, ("published_at", "ingested_at", "processed_at")
    )


def validate_raw(rows: DataFrame) -> DataFrame:
    return rows.withColumn("error", raw_error())


def validate_processed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("error", processed_error())


def parse_raw(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON text in ``value`` to raw columns plus ``decode_error``, not yet validated."""
    times = ("published_at", "ingested_at")
    wire = _parse_wire(messages, value, S.RAW_WIRE)
    undecodable = F.col("_broken") | _bad_times(times, X.RFC3339_PATTERN)
    return wire.select(
        *[c for c in messages.columns if c != value],
        *_wire_columns(S.RAW_WIRE, times, X.RFC3339_PATTERN),
        F.when(undecodable, F.lit("decode error")).alias("decode_error"),
    )


def decode_raw(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON text in ``value`` to raw columns plus ``error``; other columns are kept.

    Undecodable text, a time that is not RFC 3339 and any contract breach set ``error``;
    the row stays, so the caller decides between quarantine and failure.
    """
    error = F.coalesce(F.col("decode_error"), raw_error())
    return parse_raw(messages, value).withColumn("error", error).drop("decode_error")


def decode_processed(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON text in ``value`` to processed columns plus ``error``.

    Checked as a consumer does: right version, every required key present, times that
    parse (no offset means UTC). NULL or absent tickers become an empty array.
    """
    times = ("published_at", "ingested_at", "processed_at")
    wire = _parse_wire(messages, value, S.PROCESSED_WIRE)
    kept = [c for c in messages.columns if c != value]
    version_off = F.coalesce(F.col("_w.schema_version"), F.lit("")) != S.SCHEMA_VERSION
    error = F.when(F.col("_broken"), F.lit("decode error")).when(
        version_off, F.lit("unsupported schema_version")
    )
    for name in S.PROCESSED_REQUIRED[1:]:
        error = error.when(
            F.col(f"_w.{name}").isNull(), F.lit(f"missing required field: {name}")
        )
    error = error.when(_bad_times(times, X.ISO_PATTERN), F.lit("decode error"))
    columns = _wire_columns(S.PROCESSED_WIRE, times, X.ISO_PATTERN)
    rows = wire.select(*kept, *columns, error.alias("error"))
    no_tickers = F.array().cast("array<string>")
    return rows.withColumn("tickers", F.coalesce("tickers", no_tickers))


def _parse_wire(messages: DataFrame, value: str, shape) -> DataFrame:
    with_corrupt = T.StructType([*shape.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(
        F.col(value).cast("string"), with_corrupt, {"columnNameOfCorruptRecord": "_corrupt"}
    )
    return compute_once(messages, {"_w": parsed}).withColumn(
        "_broken", F.col("_w").isNull() | F.col("_w._corrupt").isNotNull()
    )


def _bad_times(times: tuple[str, ...], pattern: str) -> Column:
    bad = F.lit(False)
    for name in times:
        raw = F.col(f"_w.{name}")
        bad = bad | (raw.isNotNull() & X.parse_iso(raw, pattern).isNull())
    return bad


def _wire_columns(shape, times: tuple[str, ...], pattern: str) -> list[Column]:
    return [
        (X.parse_iso(F.col(f"_w.{f.name}"), pattern) if f.name in times
         else F.col(f"_w.{f.name}")).alias(f.name)
        for f in shape
    ]


def strict_error(value: Column, topic: str = "news.raw") -> Column:
    """First way in which a JSON text breaks the declared message schema, else NULL.

    Stricter than validation: unknown keys, wrong JSON types and malformed optional
    fields are rejected as well.
    """
    processed = topic == "news.processed"
    required = S.PROCESSED_REQUIRED if processed else S.RAW_REQUIRED
    allowed = _PROCESSED_COLUMNS if processed else _RAW_COLUMNS
    fields = F.try_variant_get(F.try_parse_json(value), "$", "map<string, variant>")

    def type_of(name: str) -> Column:
        return F.schema_of_variant(F.try_element_at(fields, F.lit(name)))

    def text_field(name: str) -> Column:
        return F.try_variant_get(F.try_element_at(fields, F.lit(name)), "$", "string")

    def off(condition: Column) -> Column:
        return ~F.coalesce(condition, F.lit(True))

    chain = F.when(fields.isNull(), F.lit("not a JSON object"))
    for name in required:
        chain = chain.when(
            ~F.map_contains_key(fields, name), F.lit(f"missing property: {name}")
        )
    names = F.array(*[F.lit(n) for n in allowed])
    chain = chain.when(
        F.size(F.array_except(F.map_keys(fields), names)) > 0, F.lit("unknown property")
    )
    for name in allowed:
        if name == "tickers":
            # An empty array has element type VOID.
            chain = chain.when(
                off(type_of(name).isin("ARRAY<STRING>", "ARRAY<VOID>")),
                F.lit("wrong type: tickers"),
            )
        else:
            chain = chain.when(off(type_of(name) == "STRING"), F.lit(f"wrong type: {name}"))
    return (
        chain.when(off(text_field("schema_version") == S.SCHEMA_VERSION),
                   F.lit("wrong schema_version"))
        .when(off(F.length(text_field("id")) > 0), F.lit("empty id"))
        .when(off(text_field("source").isin(*S.SOURCES)), F.lit("unknown source"))
        .when(off(text_field("language").rlike(S.LANGUAGE_PATTERN)), F.lit("malformed language"))
        .when(off(text_field("content_hash").rlike(S.CONTENT_HASH_PATTERN))
              if processed else F.lit(False), F.lit("malformed content_hash"))
    )


def check_contract(messages: DataFrame, topic: str = "news.raw", value: str = "value") -> DataFrame:
    return messages.withColumn("violation", strict_error(F.col(value), topic))


def to_wire(rows: DataFrame, topic: str = "news.raw") -> DataFrame:
    """Rows to Kafka-shaped ``key`` and JSON ``value``; empty optional fields are left out."""
    shape = S.PROCESSED if topic == "news.processed" else S.RAW
    optional = ("feed", "url", "language")
    fields = []
    for field in shape:
        column = F.col(field.name)
        if field.name in optional:
            column = F.nullif(column, F.lit(""))
        elif field.name == "tickers":
            column = F.when(F.size(column) > 0, column)
        elif field.dataType.typeName() == "timestamp":
            column = X.format_rfc3339(column)
        fields.append(column.alias(field.name))
    return rows.select(F.col("id").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def split_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) by ``error``."""
    return rows.filter("error is null").drop("error"), rows.filter("error is not null")
