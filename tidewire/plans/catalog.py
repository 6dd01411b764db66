"""Every operator as a query over the given tables. ``oracle.py`` has the SQL twins."""

import dataclasses
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire import schemas as S
from tidewire.functions import sentiment as M
from tidewire.functions import text as X
from tidewire.operators import contract, entities, metrics, process, readmodel, scoring, signals
from tidewire.plans import tables as B
from tidewire.session import shared_dir
from tidewire.sources import feeds, gdelt, registry, replay
from tidewire.streaming import shocks as stream_state
from tidewire.streaming import committed, sinks, stages
from tidewire.streaming.committed import CommittedTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


# Means of few two-digit values can end in a 5 at the seventh place, where rounding to six
# would depend on the last bit.
_PLACES = {"mean_velocity": 8, "avg_sentiment": 8}


def present(rows: DataFrame) -> DataFrame:
    """Result as plain values: times as UTC text, doubles to six places."""
    shown = []
    for field in rows.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, _PLACES.get(field.name, 6))
        elif isinstance(field.dataType, (T.IntegerType, T.LongType, T.DecimalType)):
            column = column.cast("bigint")
        shown.append(column.alias(field.name))
    return rows.select(*shown)


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(spark, sf_dir))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return run


# --- Sources -----------------------------------------------------------------------------


def _replay_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as replay lines, some blank, broken or incomplete."""
    case = F.col("arrival_seq") % 10
    rows = B.news(spark, sf_dir).withColumns(
        {
            "title": F.when(case != 5, F.col("title")),
            "schema_version": F.when(case != 6, F.col("schema_version")).otherwise(""),
            "source": F.when(case != 6, F.col("source")),
            "published_at": F.when(case == 7, F.lit("garbage")).otherwise(
                X.format_rfc3339(F.col("published_at"))
            ),
        }
    )
    fields = ["schema_version", "id", "source", "title", "body", "language", "published_at"]
    line = F.concat(F.lit("  "), F.to_json(F.struct(*fields)), F.lit("\t"))
    value = F.when(case == 3, F.lit(" \t ")).when(case == 4, F.lit("{not json")).otherwise(line)
    return rows.select("arrival_seq", value.alias("value"))


@query
def scan_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = replay.parse_replay(_replay_lines(spark, sf_dir), B.now())
    return rows.select(
        "arrival_seq", "schema_version", "id", "source", "title", "body", "language",
        "published_at", "ingested_at", "error",
    )


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = contract.split_bad(contract.decode_raw(_replay_lines(spark, sf_dir)))
    return bad.groupBy("error").agg(
        F.count(F.lit(1)).alias("rows"), F.min("arrival_seq").alias("first_seq")
    )


def _gdelt_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One two-article response per document; every third second article has no address."""
    seq = F.col("arrival_seq")
    language = (
        F.when(F.col("language") == "en", F.lit("English"))
        .when(F.col("language") == "de", F.lit("de-DE"))
        .otherwise(F.col("language"))
    )
    seen = F.when(seq % 7 == 0, F.lit("soon")).otherwise(
        F.date_format("published_at", "yyyyMMdd'T'HHmmss'Z'")
    )
    first = F.struct(
        F.concat(F.lit("https://news.example/"), "id").alias("url"),
        F.concat(F.lit("  "), "title", F.lit("\n")).alias("title"),
        seen.alias("seendate"), F.col("feed").alias("domain"), language.alias("language"),
    )
    second = F.struct(
        F.when(seq % 3 == 0, F.lit(" ")).otherwise(
            F.concat(F.lit("https://more.example/"), "id")
        ).alias("url"),
        F.when(seq % 5 == 0, F.lit("")).otherwise(F.col("title")).alias("title"),
        seen.alias("seendate"), F.col("feed").alias("domain"), F.lit("und").alias("language"),
    )
    response = F.to_json(F.struct(F.array(first, second).alias("articles")))
    return B.news(spark, sf_dir).select("arrival_seq", response.alias("value"))


@query
def gdelt_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gdelt.parse_gdelt(_gdelt_responses(spark, sf_dir), B.now())
    return rows.select(
        "arrival_seq", "id", "source", "feed", "url", "title", "body", "language",
        "published_at", "ingested_at",
    )


def _xml_text(text: Column) -> Column:
    escaped = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.replace(escaped, F.lit(">"), F.lit("&gt;"))


def _element(name: str, content: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), content, F.lit(f"</{name}>"))


def _rss_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One RSS document per document: an item with markup, one plain, one untitled."""
    seq = F.col("arrival_seq")
    title, body = _xml_text(F.col("title")), _xml_text(F.col("body"))
    date = F.date_format("published_at", "dd MMM yyyy HH:mm:ss")
    marked = _element(
        "item",
        F.concat(
            _element("title", title),
            _element("link", F.concat(F.lit("https://feed.example/"), "id")),
            _element("description",
                     F.concat(F.lit("&lt;p&gt;A&amp;amp;B &lt;b&gt;"), body, F.lit("&lt;/b&gt;"))),
            _element("pubDate", F.concat(F.lit("Mon, "), date, F.lit(" +0100"))),
            F.when(seq % 2 == 0, _element("guid", F.concat(F.lit("guid-"), "id"))).otherwise(""),
        ),
    )
    plain = _element(
        "item",
        F.concat(
            _element("title", F.concat(F.lit("Re: "), title)),
            _element("description", F.lit(" &lt;br/&gt; ")),
            _element("pubDate", F.lit("one day")),
        ),
    )
    untitled = _element("item", _element("title", F.lit("  ")))
    channel = F.concat(
        _element("title", F.col("feed")),
        _element("language", F.concat("language", F.lit("-XX"))), marked, plain, untitled,
    )
    xml = F.concat(
        F.lit('<?xml version="1.0"?>\n<rss version="2.0">'), _element("channel", channel),
        F.lit("</rss>"),
    )
    return B.news(spark, sf_dir).select(
        "arrival_seq", F.concat(F.lit("https://feed.example/rss/"), "feed").alias("feed_url"),
        xml.alias("xml"),
    )


def _atom_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Atom document per document, with two links and summary or content."""
    seq = F.col("arrival_seq")
    title, body = _xml_text(F.col("title")), _xml_text(F.col("body"))
    links = F.concat(
        F.lit('<link href="https://atom.example/self/'), "id", F.lit('" rel="self"/>'),
        F.when(
            seq % 3 != 0,
            F.concat(F.lit('<link href="https://atom.example/'), "id", F.lit('" rel="alternate"/>')),
        ).otherwise(F.lit("")),
    )
    entry = _element(
        "entry",
        F.concat(
            _element("title", title),
            F.when(seq % 2 == 0, _element("id", F.concat(F.lit("tag:"), "id"))).otherwise(""),
            links,
            _element("updated", X.format_rfc3339(F.col("published_at"))),
            _element("summary", F.concat(F.lit("About "), body)),
            F.when(seq % 4 == 0, _element("content", body)).otherwise(F.lit("")),
        ),
    )
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?>\n'),
        F.when(seq % 8 == 0, F.concat(F.lit("<!-- "), F.repeat(F.lit("<rss> "), 90), F.lit("-->\n")))
        .otherwise(F.lit("")),
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom" xml:lang="'),
        "language", F.lit('"><title>t</title>'), entry, F.lit("</feed>"),
    )
    return B.news(spark, sf_dir).select(
        "arrival_seq", F.concat(F.lit("https://atom.example/feed/"), "feed").alias("feed_url"),
        xml.alias("xml"),
    )


_FEED_COLUMNS = [
    "arrival_seq", "id", "source", "feed", "url", "title", "body", "language",
    "published_at", "ingested_at",
]


@query
def rss_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.parse_rss(_rss_documents(spark, sf_dir), B.now()).select(*_FEED_COLUMNS)


@query
def atom_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.parse_atom(_atom_documents(spark, sf_dir), B.now()).select(*_FEED_COLUMNS)


def _feed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.col("arrival_seq") % 2 == 1
    return _rss_documents(spark, sf_dir).filter(odd).unionByName(
        _atom_documents(spark, sf_dir).filter(~odd)
    )


@query
def feed_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = feeds.feed_kind(F.col("xml")).alias("kind")
    return _feed_documents(spark, sf_dir).select("arrival_seq", kind)


@query
def quarantine_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut off before their end, a fifth of all, next to whole ones."""
    cut = F.col("arrival_seq") % 5 == 0
    half = F.expr("substring(xml, 1, length(xml) - 9)")
    documents = _feed_documents(spark, sf_dir).withColumn(
        "xml", F.when(cut, half).otherwise(F.col("xml"))
    )
    return feeds.broken_feeds(documents).select("arrival_seq", "error")


@query
def quarantine_gdelt(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.col("arrival_seq") % 7 == 0
    value = F.to_json(F.struct(F.array(F.struct(
        "title", F.col("body").alias("url"), F.col("feed").alias("domain"), "language"
    )).alias("articles")))
    responses = B.news(spark, sf_dir).select("arrival_seq", F.when(
        cut, F.concat(F.lit("<html>"), "body")).otherwise(value).alias("value"))
    return gdelt.broken_gdelt(responses).select("arrival_seq", "error")


@query
def unscorable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batched model that fails on some texts: every item is a result or listed here."""

    def load():
        def predict(texts):
            if any(len(t) % 11 == 0 for t in texts):
                raise ValueError("text refused")
            return [[0.2, 0.3, 0.5]] * len(texts)

        return predict

    model = scoring.BatchModel("stub", load)
    scored = scoring.score(B.news(spark, sf_dir).withColumn("content_hash", F.lit("-")), B.now(), model)
    found = scoring.unscorable(scored).select("item_id", "error")
    results = scoring.sentiment_results(scored).select("item_id", F.lit("-").alias("error"))
    return found.unionByName(results)


@query
def fan_in_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources in one bag, counted per source."""
    frames = [
        replay.parse_replay(_replay_lines(spark, sf_dir), B.now()).filter("error is null"),
        gdelt.parse_gdelt(_gdelt_responses(spark, sf_dir), B.now()),
        feeds.parse_feed(_feed_documents(spark, sf_dir), B.now()),
    ]
    return registry.fan_in(*frames).groupBy("source", "language").agg(
        F.count(F.lit(1)).alias("items"), F.sum(F.length("body")).alias("body_chars")
    )


@query
def source_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed replay lines and a source that the library does not know, chosen by mode."""
    base = f"{shared_dir(spark)}/sources-{uuid.uuid4().hex}"
    _replay_lines(spark, sf_dir).select("value").write.text(f"{base}/replay")
    _gdelt_responses(spark, sf_dir).select("value").write.text(f"{base}/responses")
    registry.register_source("response_lines", lambda session, config, now: gdelt.parse_gdelt(
        session.read.text(config.gdelt_path), now
    ))
    config = registry.SourceConfig(replay_path=f"{base}/replay", gdelt_path=f"{base}/responses")
    frames = [
        frame.filter("error is null") if "error" in frame.columns else frame
        for mode in ("replay", "response_lines")
        for frame in registry.build_sources(spark, dataclasses.replace(config, mode=mode), B.now())
    ]
    return registry.fan_in(*frames).groupBy("source", "language").agg(
        F.count(F.lit(1)).alias("items"), F.sum(F.length("body")).alias("body_chars")
    )


# --- Contract ----------------------------------------------------------------------------


@query
def validate_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.validate_raw(B.flawed_news(spark, sf_dir)).select("arrival_seq", "error")


@query
def validate_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.flawed_news(spark, sf_dir).withColumns(
        {
            "content_hash": F.when(
                F.col("arrival_seq") % 5 == 0, F.concat(F.lit("sha256:"), F.sha1("body"))
            ).otherwise(X.content_hash(F.col("title"), F.col("body"))),
            "processed_at": F.when(F.col("arrival_seq") % 11 != 0, B.now()),
        }
    )
    return contract.validate_processed(rows).select("arrival_seq", "error")


@query
def contract_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    case = F.col("arrival_seq") % 9
    rows = B.news(spark, sf_dir).withColumns(
        {
            "published_at": X.format_rfc3339(F.col("published_at")),
            "ingested_at": X.format_rfc3339(F.col("ingested_at")),
            "title": F.when(case != 1, F.col("title")),
            "sentiment": F.when(case == 2, F.lit(0.91)),
            "language": F.when(case == 3, F.lit("English")).otherwise(F.col("language")),
            "source": F.when(case == 4, F.lit("blog")).otherwise(F.col("source")),
            "id": F.when(case == 6, F.lit("")).otherwise(F.col("id")),
            "schema_version": F.when(case == 8, F.lit("2.0.0")).otherwise(F.lit("1.0.0")),
            "tickers": F.array("feed"),
        }
    )
    fields = [c for c in rows.columns if c != "arrival_seq"]
    text = F.to_json(F.struct(*fields))
    numeric_id = F.regexp_replace(text, '"id":"doc-([0-9]+)"', '"id":$1')
    value = F.when(case == 5, numeric_id).when(case == 7, F.lit("[1, 2")).otherwise(text)
    messages = rows.select("arrival_seq", value.alias("value"))
    return contract.check_contract(messages).select("arrival_seq", "violation")


@query
def decode_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    case = F.col("arrival_seq") % 8
    local = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss")
    rows = B.news(spark, sf_dir).withColumns(
        {
            "content_hash": X.content_hash(F.col("title"), F.col("body")),
            "schema_version": F.when(case == 1, F.lit("0.9.0")).otherwise(F.lit("1.0.0")),
            "body": F.when(case != 2, F.col("body")),
            "published_at": F.when(case == 3, local)
            .when(case == 4, F.concat(local, F.lit(".25+02:00")))
            .when(case == 5, F.lit("yesterday"))
            .otherwise(X.format_rfc3339(F.col("published_at"))),
            "ingested_at": X.format_rfc3339(F.col("ingested_at")),
            "processed_at": X.format_rfc3339(B.now()),
            "tickers": F.when(case == 6, F.array("feed", "language")),
        }
    )
    fields = [c for c in rows.columns if c != "arrival_seq"]
    value = F.when(case == 7, F.lit("{")).otherwise(F.to_json(F.struct(*fields)))
    messages = rows.select("arrival_seq", value.alias("value"))
    return contract.decode_processed(messages).select(
        "arrival_seq", "id", "content_hash", "title", "published_at", "processed_at",
        F.array_join("tickers", ",").alias("tickers"), "error",
    )


@query
def to_wire_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.to_wire(B.news(spark, sf_dir))


# --- Processing --------------------------------------------------------------------------


@query
def process_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process.decide(B.flawed_news(spark, sf_dir)).select(
        "arrival_seq", "decision", "reason", "error"
    )


@query
def process_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process.process_news(B.news(spark, sf_dir), B.now()).drop("tickers", "url")


@query
def dedup_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.news(spark, sf_dir).withColumn(
        "content_hash", X.content_hash(F.col("title"), F.col("body"))
    )
    return process.dedup_first(rows).select("arrival_seq", "content_hash")


@query
def filter_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("arrival_seq")
    rows = B.news(spark, sf_dir).withColumns(
        {
            "title": F.when(seq % 13 == 0, F.lit(" ")).otherwise(F.col("title")),
            "body": F.when(seq % 13 == 0, F.lit("\t")).otherwise(F.col("body")),
            "language": F.when(seq % 7 != 0, F.col("language")),
        }
    )
    return process.evaluate(rows.withColumn("error", F.lit(None).cast("string"))).select(
        "arrival_seq", "reason"
    )


@query
def process_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process.process_stats(B.flawed_news(spark, sf_dir))


@query
def filtered_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process.drops_by_reason(B.flawed_news(spark, sf_dir))


@query
def seen_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A poll (odd documents) against what an earlier poll (even ones) has delivered."""
    keyed = B.news(spark, sf_dir).select(
        "arrival_seq", X.hash_id("rss", F.lower("body")).alias("id")
    )
    odd = F.col("arrival_seq") % 2 == 1
    return process.drop_seen(keyed.filter(odd), keyed.filter(~odd), "id")


# --- Scalar functions --------------------------------------------------------------------


@query
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    dressed = F.when(
        F.col("arrival_seq") % 4 == 0,
        F.concat(F.lit("  　A\u0001́"), "body", F.lit("\u0085\tİΣ \u0007 É ")),
    ).otherwise(F.col("body"))
    return B.news(spark, sf_dir).select(
        "arrival_seq", X.normalize_text(dressed).alias("normalized")
    )


@query
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.news(spark, sf_dir).select(
        "arrival_seq", X.content_hash(F.col("title"), F.col("body")).alias("content_hash")
    )


@query
def hash_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "pages").select(
        "page_id", X.hash_id("gdelt", F.col("url")).alias("id")
    )


@query
def normalize_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    case = F.col("arrival_seq") % 7
    lang = F.col("language")
    spelled = (
        F.when(case == 0, F.lit("English"))
        .when(case == 1, F.concat(F.upper(lang), F.lit("-US")))
        .when(case == 2, F.concat(F.lit(" "), lang, F.lit("_x_y ")))
        .when(case == 3, F.lit(" Und "))
        .when(case == 4, F.lit("-en"))
        .when(case == 5, F.lit("French"))
        .otherwise(lang)
    )
    return B.news(spark, sf_dir).select(
        "arrival_seq", X.normalize_lang(spelled).alias("language")
    )


@query
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.texts(spark, sf_dir, "pages").select(
        "page_id", X.clean_text(F.col("html")).alias("text")
    )


@query
def parse_feed_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    case = F.col("arrival_seq") % 8
    ts = F.col("published_at")
    long_form = F.date_format(ts, "dd MMM yyyy HH:mm:ss")
    short_form = F.date_format(ts, "dd MMM yy HH:mm")
    text = (
        F.when(case == 0, F.concat(F.lit("Mon, "), long_form, F.lit(" +0000")))
        .when(case == 1, F.concat(F.lit("Tue, "), long_form, F.lit(" EST")))
        .when(case == 2, F.concat(short_form, F.lit(" -0230")))
        .when(case == 3, F.concat(short_form, F.lit(" GMT")))
        .when(case == 4, F.concat(F.lit(" "), X.format_rfc3339(ts), F.lit("\n")))
        .when(case == 5, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'+05:30'"))
        .when(case == 6, F.concat(F.lit("sun, "), F.date_format(ts, "d MMM yyyy HH:mm:ss"),
                                  F.lit(" +0100")))
        .otherwise(F.lit("garbage"))
    )
    return B.news(spark, sf_dir).select(
        "arrival_seq", X.parse_feed_date(text).alias("parsed")
    )


@query
def model_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    case = F.col("arrival_seq") % 3
    title = F.when(case == 0, F.lit(" \n")).otherwise(F.concat(F.lit("\t"), "title"))
    body = F.when(case == 1, F.lit("")).otherwise(F.col("body"))
    return B.news(spark, sf_dir).select(
        "arrival_seq", X.model_text(title, body).alias("model_text")
    )


@query
def lexicon_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = M.lexicon_tokens(F.col("body"))
    return B.news(spark, sf_dir).select(
        "arrival_seq", F.size(tokens).alias("n_tokens"), F.array_join(tokens, " ").alias("tokens")
    )


def _lexicon() -> scoring.LexiconModel:
    return scoring.LexiconModel(B.POSITIVE, B.NEGATIVE)


@query
def lexicon_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = X.model_text(F.col("title"), F.col("body"))
    scored = scoring.add_sentiment(B.news(spark, sf_dir), _lexicon(), text)
    return scored.select("arrival_seq", "sentiment.*")


@query
def model_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A classifier whose files are missing gives way to the word lists."""
    missing = f"{shared_dir(spark)}/no-model-{uuid.uuid4().hex}"
    chosen = scoring.choose_model(lambda: scoring.onnx_model(spark, missing, "classifier"))
    model = dataclasses.replace(chosen, positive=B.POSITIVE, negative=B.NEGATIVE)
    scored = scoring.score(B.news(spark, sf_dir), B.now(), model, {})
    return scored.select("arrival_seq", "model_name", "sentiment.label", "sentiment.score")


@query
def model_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a model whose file is shipped to the executors and gives logits."""
    path = f"{tempfile.mkdtemp(prefix='tidewire-model-')}/linear-{uuid.uuid4().hex}.npz"
    bucket, label = np.mgrid[0:64, 0:3]
    np.savez(path, weights=((bucket * 37 + label * 11) % 23 - 11) / 2, bias=np.array([0.3141, 0.0, 0.1234]),
             labels=np.array(["negative", "neutral", "positive"]))
    text = X.model_text(F.col("title"), F.col("body"))
    model = scoring.linear_model(spark, path, "linear")
    scored = scoring.add_sentiment(B.news(spark, sf_dir), model, text)
    return scored.select("arrival_seq", "sentiment.*")


@query
def softmax_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three logits, each the sum of every third dimension of the vector."""

    def total(k: int) -> Column:
        own = F.filter("embedding", lambda x, i: i % 3 == k)
        return F.aggregate(own, F.lit(0.0), lambda acc, x: acc + x.cast("double"))

    logits = F.array(*[total(k) for k in range(3)])
    rows = B.table(spark, sf_dir, "embeddings").select("vec_id", logits.alias("logits"))
    probs = rows.withColumn("probs", M.softmax(F.col("logits")))
    value = M.label_from_probs(F.col("probs"), ("negative", "neutral", "positive"))
    return probs.select("vec_id", value.alias("s")).select("vec_id", "s.*")


@query
def label_sign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.results(spark, sf_dir).select(
        "item_id", M.label_sign(F.col("sentiment_label")).alias("sign")
    )


# --- Scoring -----------------------------------------------------------------------------


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = process.process_news(B.news(spark, sf_dir), B.now())
    return scoring.score(
        processed.withColumn("tickers", _hint()), _arrival(), _lexicon(), B.GAZETTEER
    )


def _hint() -> Column:
    return F.when(
        F.col("arrival_seq") % 10 == 0, F.array(F.lit("von"), F.upper("feed"), F.lit("Von"))
    )


def _arrival() -> Column:
    return F.col("published_at") + F.expr("interval 5 seconds")


@query
def sentiment_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.sentiment_results(_scored(spark, sf_dir))


@query
def entity_sentiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.entity_sentiments(_scored(spark, sf_dir))


@query
def result_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON lines, read back field by field."""
    shape = (
        "id string, sentiment_label string, sentiment_score double, "
        "sentiment_probs struct<positive: double, negative: double, neutral: double>, "
        "entities array<struct<text: string, type: string>>, quantized boolean, "
        "inferred_at string"
    )
    line = scoring.result_json(_scored(spark, sf_dir)).select(F.from_json("value", shape).alias("r"))
    return line.select(
        "r.id", "r.sentiment_label", "r.sentiment_score", "r.sentiment_probs.positive",
        "r.sentiment_probs.negative", "r.sentiment_probs.neutral",
        F.size("r.entities").alias("n_entities"), "r.quantized", "r.inferred_at",
    )


def _entity_text(rows: DataFrame) -> DataFrame:
    shown = F.transform("entities", lambda e: F.concat(e["type"], F.lit(":"), e["text"]))
    return rows.select("id", F.array_join(shown, "|").alias("entities"))


def _hinted_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.news(spark, sf_dir).withColumn(
        "tickers",
        F.when(F.col("arrival_seq") % 10 == 0, F.array(F.lit("von"), F.upper("feed"), F.lit("Von"))),
    )


@query
def extract_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entity_text(entities.with_entities(_hinted_news(spark, sf_dir), B.GAZETTEER))


@query
def extract_entities_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the gazetteer as a table to join."""
    return _entity_text(entities.join_entities(_hinted_news(spark, sf_dir), _gazetteer(spark)))


def _gazetteer(spark: SparkSession) -> DataFrame:
    rows = [(i, t, c) for i, (t, c) in enumerate(B.GAZETTEER.items())]
    return spark.createDataFrame(rows, "ord int, ticker string, company string")


# --- Signals -----------------------------------------------------------------------------


@query
def sentiment_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.sentiment_velocity(B.entity_samples(spark, sf_dir)).select(
        "item_id", "entity", "velocity"
    )


@query
def rolling_velocity_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals.rolling_velocity_stats(B.entity_samples(spark, sf_dir), B.WINDOW_SECONDS)
    return rows.select(
        "item_id", "n_samples", "n_baseline", "velocity", "mean_velocity", "std_velocity"
    )


def _shocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.detect_shocks(
        B.entity_samples(spark, sf_dir), B.WINDOW_SECONDS, B.THRESHOLD, signals.MIN_SAMPLES
    )


@query
def shocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shocks(spark, sf_dir)


@query
def shocks_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every window cut into eight cells, as for very dense series."""
    return signals.detect_shocks(
        B.entity_samples(spark, sf_dir), B.WINDOW_SECONDS, B.THRESHOLD, signals.MIN_SAMPLES, 8
    )


@query
def document_shocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw news to shocks: process, score, extract, detect."""
    series = scoring.entity_series(_scored(spark, sf_dir), "arrival_seq")
    return signals.detect_shocks(series, 6 * 3600, 2.0, 8)


@query
def recent_samples_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two hours before every full hour that an entity has samples in."""
    samples = B.entity_samples(spark, sf_dir)
    asks = samples.select("entity", F.date_trunc("hour", "inferred_at").alias("as_of")).distinct()
    return signals.recent_samples_bulk(samples, asks, 2 * 3600, slices=2)


@query
def recent_entity_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit("2024-01-20 12:00:00").cast("timestamp")
    return signals.recent_entity_samples(
        B.entity_samples(spark, sf_dir), "purchase", 3 * 86_400, as_of
    )


# --- Read layer --------------------------------------------------------------------------


@query
def recent_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readmodel.recent_results(B.results(spark, sf_dir), 500)


@query
def recent_shocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readmodel.recent_shocks(_shocks(spark, sf_dir), 100)


@query
def display_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readmodel.display_items(readmodel.recent_results(B.results(spark, sf_dir)))


@query
def display_shocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readmodel.display_shocks(readmodel.recent_shocks(_shocks(spark, sf_dir)))


@query
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readmodel.label_distribution(B.results(spark, sf_dir))


@query
def source_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readmodel.source_distribution(B.results(spark, sf_dir))


@query
def global_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readmodel.global_stats(B.results(spark, sf_dir), _shocks(spark, sf_dir))


@query
def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times are cut to hours, so that many results share the newest one."""
    hours = B.results(spark, sf_dir).withColumn("inferred_at", F.date_trunc("hour", "inferred_at"))
    return readmodel.kpis(hours, _shocks(spark, sf_dir), B.now())


@query
def sentiment_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readmodel.sentiment_timeline(B.results(spark, sf_dir), "15 minutes")


@query
def document_sentiment_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentiment labels of the unique, relevant documents."""
    return readmodel.label_distribution(scoring.sentiment_results(_scored(spark, sf_dir)))


# --- Streams: the tables dealt over files, drained batch by batch, and read back -----------

_SHARES = 6
_SHARES_A_BATCH = 3
_BATCHES = 8
_SEQ = T.StructField("arrival_seq", T.LongType())
_DRAIN_SECONDS = 1800


def _interleaved(rows: DataFrame, by: Column, name: str) -> tuple[DataFrame, str]:
    """``rows`` as a stream of batches that each hold three of the ``_SHARES`` shares ``by`` gives.

    Rows are dealt over tasks whatever their share, so that no task or file grows with a share.
    """
    spark = rows.sparkSession
    base = f"{shared_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"
    share = F.coalesce(F.pmod(by, F.lit(_SHARES)), F.lit(0))
    dealt = rows.withColumn("batch", F.floor(share / _SHARES_A_BATCH).cast("int"))
    dealt.hint("rebalance").write.partitionBy("batch").parquet(f"{base}/dealt")
    dealt = spark.read.schema(dealt.schema).parquet(f"{base}/dealt")
    batches = [
        dealt.filter(F.col("batch") == k).select(*rows.columns)
        for k in range(_SHARES // _SHARES_A_BATCH)
    ]
    # written one after the other, so that modification times tell the order; the larger first,
    # so that the files of one trigger hold each batch and none of the next
    batches.sort(key=lambda batch: batch.rdd.getNumPartitions(), reverse=True)
    files = None
    for k, batch in enumerate(batches):
        (batch.coalesce(files) if files else batch).write.parquet(f"{base}/in/{k}")
        files = files or len(spark.read.schema(rows.schema).parquet(f"{base}/in/{k}").inputFiles())
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/dealt")
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).option(
        "recursiveFileLookup", True
    ).parquet(f"{base}/in")
    return stream, base


def _finish(query) -> None:
    if not query.awaitTermination(_DRAIN_SECONDS):
        query.stop()
        raise TimeoutError(f"the stream was not drained in {_DRAIN_SECONDS} seconds")


def _drained(rows: DataFrame, base: str) -> DataFrame:
    _finish(sinks.to_table(rows, f"{base}/out", f"{base}/checkpoint", every=None))
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{base}/out")


def _in_order(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``rows`` as a stream of ``_BATCHES`` batches, in the order of ``arrival_seq``."""
    spark = rows.sparkSession
    base = f"{shared_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"
    size = (rows.agg(F.max("arrival_seq")).first()[0] or 0) + 1
    number = F.floor(F.col("arrival_seq") * _BATCHES / F.lit(size))
    # folders of their own, written one after the other, so that modification times tell the order
    for k in range(_BATCHES):
        rows.filter(number == k).coalesce(1).write.parquet(f"{base}/in/{k}")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", True
    ).parquet(f"{base}/in")
    return stream, base


def _messages(spark: SparkSession, sf_dir: str, source: Query = B.news) -> DataFrame:
    return source(spark, sf_dir).select("arrival_seq", _wire(S.RAW).alias("value"))


def _processed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = process.process_news(B.news(spark, sf_dir), B.now()).withColumn("tickers", _hint())
    return processed.select("arrival_seq", _wire(S.PROCESSED).alias("value"))


def _wire(shape: T.StructType) -> Column:
    return F.to_json(F.struct(*[
        X.format_rfc3339(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "timestamp"
        else F.col(f.name) for f in shape
    ]))


def _by_content() -> Column:
    """Copies of a text share a batch, so that the first of them does not depend on chance."""
    return F.xxhash64(F.get_json_object("value", "$.body"))


@query
def stream_process_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire messages through the process stage, first copies only, into a committed table."""
    stream, base = _interleaved(_messages(spark, sf_dir), _by_content(), "process")
    out = CommittedTables(f"{base}/out", {"items": (T.StructType([*S.PROCESSED, _SEQ]), ())})
    write = committed.writer(out, lambda batch, _: {"items": batch})
    process_batch = stages.process_writer(
        write, f"{base}/process", B.now(), live_seconds=None, order="arrival_seq"
    )
    _finish(sinks.to_batches(stream, process_batch, f"{base}/checkpoint", every=None))
    return out.read(spark, "items").select("content_hash", "title", "body", "language")


@query
def stream_process_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run summary of the same stage over flawed messages, duplicates included."""
    stream, base = _interleaved(
        _messages(spark, sf_dir, B.flawed_news), F.col("arrival_seq"), "stats"
    )
    process_batch = stages.process_writer(
        _ignored, f"{base}/process", B.now(), order="arrival_seq", live_seconds=86_400
    )
    _finish(sinks.to_batches(stream, process_batch, f"{base}/checkpoint", every=None))
    return stages.run_summary(spark, f"{base}/process")


def _ignored(batch: DataFrame, batch_id: int) -> None:
    """A sink of nothing."""


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks that live for a day in the state store; items come in no order of their times."""
    stream, base = _interleaved(_messages(spark, sf_dir), F.col("arrival_seq"), "dedup")
    rows = stages.process_stage(stream, B.now(), live_seconds=86_400)
    return _drained(rows, base).select("content_hash", F.length("body").alias("body_chars"))


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News by event time, an hour behind at most; what comes later goes to a side table."""
    minutes = F.when(F.col("arrival_seq") % 7 == 0, 4320).when(
        F.col("arrival_seq") % 5 == 0, 75
    ).otherwise(0)
    rows = B.news(spark, sf_dir).select(
        "id", "arrival_seq",
        F.timestamp_seconds(F.unix_seconds("published_at") - 60 * minutes).alias("published_at"),
    )
    stream, base = _in_order(rows, "late")
    tables = committed.late_tables(f"{base}/tables", rows.schema)
    write = committed.late_writer(tables, "published_at", 3600, compact_every=3)
    _finish(sinks.to_batches(stream, write, f"{base}/checkpoint", every=None))
    both = [
        tables.read(spark, name).withColumn("late", F.lit(name == "late"))
        for name in ("timely", "late")
    ]
    return both[0].unionByName(both[1]).select("id", "late")


@query
def stream_scored_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages scored into committed tables, one batch delivered twice, then compacted."""
    stream, base = _interleaved(_processed_messages(spark, sf_dir), F.col("arrival_seq"), "score")
    scored = stages.score_stage(stream, _arrival(), _lexicon(), _gazetteer(spark))
    write = sinks.write_scored(f"{base}/tables", "a", compact_every=None)

    def twice(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        write(batch, batch_id)

    _finish(sinks.to_batches(scored, twice, f"{base}/checkpoint", every=None))
    tables = sinks.scored_tables(f"{base}/tables", "a")
    tables.compact(spark, 2)
    tables.clean(spark)
    entity_count = tables.read(spark, "entities").groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n_entities")
    )
    return tables.read(spark, "results").join(entity_count, "item_id", "left").select(
        "item_id", "sentiment_label", "sentiment_score",
        F.coalesce("n_entities", F.lit(0)).alias("n_entities"),
    )


@query
def stream_replay_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay lines at a rate by rows: every line once, in order, so many a batch at most."""
    base = f"{shared_dir(spark)}/stream-rate-{uuid.uuid4().hex}"
    lines = _replay_lines(spark, sf_dir)
    lines.select(F.to_json(F.struct("arrival_seq", "value")).alias("value")).write.text(f"{base}/in")
    total = replay.number_lines(spark, f"{base}/in", f"{base}/numbered")
    most = -(-total // 5)
    out = CommittedTables(f"{base}/out", {"lines": ("n long, value string, batch_id long", ())})
    write = committed.writer(out, lambda batch, batch_id: {
        "lines": batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
    })
    replay.run_at_rate(spark, f"{base}/numbered", total, write, f"{base}/checkpoint", most, "0 seconds")
    shape = "arrival_seq long, value string"
    read = out.read(spark, "lines").withColumn("line", F.from_json("value", shape))
    parsed = replay.parse_replay(
        read.select(F.col("line.arrival_seq").alias("arrival_seq"), F.col("line.value").alias("value"),
                    (F.col("n") < (F.col("batch_id") + 1) * most).alias("in_rate")), B.now())
    return parsed.select("arrival_seq", "in_rate", "id", "error")


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay lines through the ingest stage: the keyed messages of the valid ones."""
    lines = _replay_lines(spark, sf_dir).withColumn("seq", F.monotonically_increasing_id())
    stream, base = _interleaved(lines, F.col("seq"), "ingest")
    wire = stages.ingest_stage([replay.parse_replay(stream.select("value"), B.now())])
    return _drained(wire, base).select(
        F.col("key").cast("string").alias("key"),
        F.get_json_object(F.col("value").cast("string"), "$.source").alias("source"),
    )


@query
def stream_shocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, base = _interleaved(B.entity_samples(spark, sf_dir), F.col("arrival_seq"), "shocks")
    write = stream_state.shock_writer(f"{base}/tables", B.WINDOW_SECONDS, B.THRESHOLD)
    _finish(sinks.to_batches(stream, write, f"{base}/checkpoint", every=None))
    return stream_state.current_shocks(spark, f"{base}/tables")


@query
def stream_news_shocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw messages to shocks: process, score, extract, detect, batch by batch."""
    stream, base = _interleaved(_messages(spark, sf_dir), _by_content(), "news")
    shocks_of = stream_state.shock_writer(f"{base}/tables", 6 * 3600, 2.0, 8)

    def series(processed: DataFrame, batch_id: int) -> None:
        hinted = processed.withColumn("tickers", _hint())
        scored = scoring.score(hinted, _arrival(), _lexicon(), B.GAZETTEER)
        shocks_of(scoring.entity_series(scored, "arrival_seq"), batch_id)

    write = stages.process_writer(
        series, f"{base}/process", B.now(), live_seconds=None, order="arrival_seq"
    )
    _finish(sinks.to_batches(stream, write, f"{base}/checkpoint", every=None))
    return stream_state.current_shocks(spark, f"{base}/tables")


@query
def stream_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All buckets; every batch adds partial rows, late ones too."""
    results = B.results(spark, sf_dir).withColumn("seq", F.substring("item_id", 4, 20).cast("long"))
    stream, base = _interleaved(results, F.col("seq"), "timeline")
    write = sinks.write_batches(
        f"{base}/timeline", "a", lambda batch: stages.partial_timeline(batch, "15 minutes")
    )
    _finish(sinks.to_batches(stream, write, f"{base}/checkpoint", every=None))
    return stages.merge_timeline(spark.read.parquet(f"{base}/timeline"))


# --- Metrics -----------------------------------------------------------------------------


def _shown_bounds(rows: DataFrame) -> DataFrame:
    le = F.when(F.col("le") == float("inf"), F.lit("+Inf")).otherwise(F.col("le").cast("string"))
    return rows.withColumn("le", le)


@query
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_bounds(metrics.latency_histogram(B.latencies(spark, sf_dir), ["variant"]))


@query
def histogram_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = metrics.latency_histogram(B.latencies(spark, sf_dir), ["variant"])
    return metrics.histogram_quantile(buckets, ["variant"])


@query
def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.counter_rate(B.counters(spark, sf_dir))


@query
def error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = B.counters(spark, sf_dir).select(
        "ts", "stage", (F.col("label") == "error").alias("failed")
    )
    return metrics.error_rate(outcomes, "15 minutes")


@query
def throughput_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.throughput_by_label(B.results(spark, sf_dir), "15 minutes")


@query
def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per topic: how far each user's last click lies behind the user's last event."""
    click = F.when(F.col("event_type") == "click", F.col("event_id"))
    positions = (
        B.table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("partition"))
        .agg(F.max("event_id").alias("high_watermark"),
             F.coalesce(F.max(click), F.lit(-1)).alias("position"))
        .withColumn("topic", F.concat(F.lit("topic-"), F.col("partition") % 3))
    )
    return metrics.consumer_lag(positions, ["topic"])


@query
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latency_summary(B.latencies(spark, sf_dir))


@query
def variant_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = metrics.latency_summary(B.latencies(spark, sf_dir))
    return metrics.compare_variants(summary, "click", "view")
