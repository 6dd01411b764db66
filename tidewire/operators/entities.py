"""Entities of an item: ticker hints, and gazetteer names found in its text.

A gazetteer has one row per (ord, ticker, company). A company matches as a substring of
the lowercased text, a ticker as a whole word.
"""

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.gazetteer import WORD, with_hits

# Default gazetteer.
DEFAULT_GAZETTEER = {
    "NMBS": "Nimbus Robotics",
    "HLES": "Helios Energy",
    "ASTB": "Aster Biosciences",
    "QUIL": "Quill Software",
    "MRDF": "Meridian Freight",
    "CBLT": "Cobalt Semiconductors",
    "VIRO": "Vireo Foods",
    "LKSP": "Larkspur Financial",
    "ONYX": "Onyx Motors",
    "PLLS": "Pallas Pharmaceuticals",
    "SABL": "Sable Retail",
    "TSSL": "Tessellate Cloud",
}
_ENTITY = "struct<text:string,type:string>"


def searched_text(title: Column, body: Column) -> Column:
    return F.lower(F.concat(title, F.lit(" "), body))


def _entity(text: Column, kind: str) -> Column:
    return F.struct(text.alias("text"), F.lit(kind).alias("type"))


def _word(ticker: str) -> str:
    """The ticker as a whole word; beside a non-word end a word character is required."""
    needle = ticker.lower()
    left = "!" if needle[:1].isalnum() or needle[:1] == "_" else "="
    right = "!" if needle[-1:].isalnum() or needle[-1:] == "_" else "="
    return f"(?<{left}{WORD}){re.escape(needle)}(?{right}{WORD})"


def _hints(tickers: Column) -> Column:
    hints = F.coalesce(tickers, F.array().cast("array<string>"))
    return F.transform(hints, lambda t: _entity(F.upper(t), "ticker"))


def _dedup_tickers(entities: Column) -> Column:
    """First-seen order; tickers count as equal regardless of case."""
    key = F.transform(
        entities,
        lambda e: F.struct(canonical_name(e["text"], e["type"]).alias("k"), e["type"].alias("t")),
    )
    return F.filter(
        entities,
        lambda e, i: F.array_position(
            key, F.struct(canonical_name(e["text"], e["type"]).alias("k"), e["type"].alias("t"))
        ) == i + 1,
    )


def canonical_name(text: Column, kind: Column) -> Column:
    return F.when(kind == "ticker", F.upper(text)).otherwise(text)


def with_entities(
    items: DataFrame, gazetteer: Mapping[str, str] | DataFrame | None = None
) -> DataFrame:
    """Items plus ``entities``, an array of (text, type) in first-seen order.

    A mapping is matched by expressions inside the scan stage, two per name: right for the
    names of a watch list. A table may have any size (see ``join_entities``).
    """
    if isinstance(gazetteer, DataFrame):
        return join_entities(items, gazetteer)
    names = DEFAULT_GAZETTEER if gazetteer is None else gazetteer
    text = F.col("_text")
    found = []
    for ticker, company in names.items():
        found.append(
            F.when(F.contains(text, F.lit(company.lower())), _entity(F.lit(company), "company"))
        )
        # The cheap substring test spares most texts the regular expression.
        is_word = F.contains(text, F.lit(ticker.lower())) & text.rlike(_word(ticker))
        found.append(F.when(is_word, _entity(F.lit(ticker), "ticker")))
    matched = F.array_compact(F.array(*found)) if found else F.array()
    entities = F.concat(_hints(F.col("tickers")), matched.cast(f"array<{_ENTITY}>"))
    return (
        items.withColumn("_text", searched_text(F.col("title"), F.col("body")))
        .withColumn("_found", entities)
        .withColumn("entities", _dedup_tickers(F.col("_found")))
        .drop("_text", "_found")
    )


def join_entities(items: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """As ``with_entities`` for a gazetteer table of any size (see ``gazetteer.with_hits``)."""
    text = searched_text(F.col("title"), F.col("body"))
    matched = F.transform(
        "_hits", lambda h: F.struct(h["text"].alias("text"), h["type"].alias("type"))
    )
    return (
        with_hits(items, gazetteer, text, "_hits")
        .withColumn("_found", F.concat(_hints(F.col("tickers")), matched))
        .withColumn("entities", _dedup_tickers(F.col("_found")))
        .drop("_hits", "_found")
    )
