"""RSS 2.0 and Atom documents to raw rows."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire import schemas as S
from tidewire.functions import text as X
from tidewire.functions.columns import compute_once
from tidewire.operators.contract import raw_error

# What may stand before the root element: declarations, comments, a document type.
_PROLOG = r"(?:\s+|\x{FEFF}|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(?:\[.*?\]\s*)?>)*+"
_ATOM_ROOT = rf"(?s)^{_PROLOG}<(?:[\w.-]+:)?feed[\s/>]"


def feed_kind(xml: Column) -> Column:
    """``atom`` if the root element is a feed, whatever precedes it, else ``rss``."""
    return F.when(xml.rlike(_ATOM_ROOT), F.lit("atom")).otherwise(F.lit("rss"))


def parse_rss(
    documents: DataFrame, now: Column, xml: str = "xml", feed_url: str = "feed_url"
) -> DataFrame:
    read = {"_rss": F.from_xml(F.col(xml), S.RSS_DOCUMENT)}
    return _to_raw(documents, read, _rss_items(F.col("_rss")), now, xml, feed_url)


def parse_atom(
    documents: DataFrame, now: Column, xml: str = "xml", feed_url: str = "feed_url"
) -> DataFrame:
    read = {"_atom": F.from_xml(F.col(xml), S.ATOM_DOCUMENT)}
    return _to_raw(documents, read, _atom_items(F.col("_atom")), now, xml, feed_url)


def parse_feed(
    documents: DataFrame, now: Column, xml: str = "xml", feed_url: str = "feed_url"
) -> DataFrame:
    """Documents of either format; a broken one yields no rows and is one of ``broken_feeds``.

    One pass: a document's kind is found once, it is parsed as what it is, and its items have
    one shape from there on.
    """
    told = compute_once(documents, {"_kind": feed_kind(F.col(xml))})
    is_atom = F.col("_kind") == "atom"
    read = {
        "_rss": F.when(~is_atom, F.from_xml(F.col(xml), S.RSS_DOCUMENT)),
        "_atom": F.when(is_atom, F.from_xml(F.col(xml), S.ATOM_DOCUMENT)),
    }
    items = F.when(is_atom, _atom_items(F.col("_atom"))).otherwise(_rss_items(F.col("_rss")))
    return _to_raw(told, read, items, now, xml, feed_url).drop("_kind")


def _item(language: Column, title: Column, own: Column, second: Column, url: Column,
          markup: Column, date: Column) -> Column:
    return F.struct(
        language.alias("lang"), title.alias("title"), own.alias("own_id"),
        second.alias("second_id"), url.alias("url"), markup.alias("markup"), date.alias("date"),
    )


def _rss_items(document: Column) -> Column:
    channel = document["channel"]
    return F.transform(channel["item"], lambda i: _item(
        channel["language"], i["title"], i["guid"], i["link"],
        X.trim_space(F.coalesce(i["link"], F.lit(""))), F.coalesce(i["description"], F.lit("")),
        i["pubDate"],
    ))


def _atom_items(document: Column) -> Column:
    language = F.coalesce(document["_xml:lang"], document["_lang"])
    return F.transform(document["entry"], lambda i: _item(
        language, i["title"], i["id"], atom_link(i["link"]), atom_link(i["link"]),
        X.first_non_empty(i["content"], i["summary"]), i["updated"],
    ))


def atom_link(links: Column) -> Column:
    """The alternate link, else the first one, else ''."""
    alternate = F.filter(
        links, lambda link: F.coalesce(link["_rel"], F.lit("")).isin("alternate", "")
    )
    chosen = F.when(F.size(alternate) > 0, F.get(alternate, 0)).otherwise(F.get(links, 0))
    return X.trim_space(F.coalesce(chosen["_href"], F.lit("")))


def broken_feeds(documents: DataFrame, xml: str = "xml") -> DataFrame:
    """The documents that are not well formed, with ``error``; ``parse_feed`` yields no row of them."""
    corrupt = T.StructField("_corrupt", T.StringType())
    options = {"columnNameOfCorruptRecord": "_corrupt"}

    def fails(shape: T.StructType) -> Column:
        read = F.from_xml(F.col(xml), T.StructType([*shape.fields, corrupt]), options)
        return read.isNull() | read["_corrupt"].isNotNull()

    kind = feed_kind(F.col(xml))
    broken = F.when(kind == "atom", fails(S.ATOM_DOCUMENT)).otherwise(fails(S.RSS_DOCUMENT))
    judged = compute_once(documents, {"error": F.when(broken, F.lit("decode error"))})
    return judged.filter("error is not null")


def read_feeds(spark: SparkSession, path: str, now: Column) -> DataFrame:
    """Landed feed documents, one per file; the file stands for the feed address."""
    return parse_feed(_with_address(spark.read.text(path, wholetext=True)), now)


def stream_feeds(
    spark: SparkSession, path: str, now: Column, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.format("text").option("wholetext", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_feed(_with_address(reader.load(path)), now)


def _with_address(files: DataFrame) -> DataFrame:
    return files.select(
        F.col("value").alias("xml"), F.col("_metadata.file_path").alias("feed_url")
    )


def _to_raw(
    documents: DataFrame, read: dict[str, Column], items: Column, now: Column, xml: str,
    feed_url: str,
) -> DataFrame:
    """Raw rows of the ``items`` of documents; ``read`` names the parsed documents."""
    kept = [c for c in documents.columns if c not in (xml, feed_url)]
    parsed = compute_once(documents, read).drop(xml)
    # an outer explode keeps the optimizer from parsing the document again in a filter;
    # documents without items leave a NULL behind
    each = parsed.select(*kept, feed_url, F.explode_outer(items).alias("i"))
    trimmed = X.trim_space(F.coalesce(F.col("i.title"), F.lit("")))
    by_title = F.concat(F.col(feed_url), F.lit("|"), F.col("_title"))
    named = each.withColumn("_title", trimmed).filter("_title != ''")
    cleaned = compute_once(named, {
        "_body": X.clean_text(F.col("i.markup")), "_date": X.parse_feed_date(F.col("i.date")),
    })
    return cleaned.select(
        *kept,
        F.lit(S.SCHEMA_VERSION).alias("schema_version"),
        X.hash_id(
            "rss", X.first_non_empty(F.col("i.own_id"), F.col("i.second_id"), by_title)
        ).alias("id"),
        F.lit("rss").alias("source"),
        F.col(feed_url).alias("feed"),
        F.col("i.url").alias("url"),
        F.col("_title").alias("title"),
        F.coalesce(F.nullif(F.col("_body"), F.lit("")), F.col("_title")).alias("body"),
        X.normalize_lang(F.col("i.lang")).alias("language"),
        F.coalesce(F.col("_date"), now).alias("published_at"),
        now.alias("ingested_at"),
        F.lit(None).cast("array<string>").alias("tickers"),
    ).filter(raw_error().isNull())
