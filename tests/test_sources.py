import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import at
from tidewire.sources import feeds, gdelt, registry, replay
from tidewire.sources.registry import SourceConfig

RSS = """<?xml version="1.0"?>
<rss version="2.0"><channel>
  <language>en-US</language>
  <item>
    <guid>first</guid><pubDate>Tue, 05 Mar 2024 08:30:00 +0000</pubDate>
    <title>Harbour rail opens early</title><link>https://rail.example/a</link>
    <description>&lt;div&gt;Trains &lt;em&gt;run&lt;/em&gt; at dawn.&lt;/div&gt;</description>
  </item>
  <item><title>Bridge tolls fall</title><link>https://rail.example/b</link>
    <description><![CDATA[Cars <i>pay</i> less.]]></description>
    <pubDate>never</pubDate></item>
  <item><title> </title></item>
</channel></rss>"""
RSS_ONE = "<rss><channel><item><title>Only one</title></item></channel></rss>"
ATOM = """<?xml version="1.0" encoding="utf-8"?>
<feed xmlns="http://www.w3.org/2005/Atom" xml:lang="en">
  <entry>
    <id>urn:ferry:9</id><title>Ferry line extended</title>
    <updated>2024-03-05T08:30:00Z</updated>
    <link rel="self" href="https://ferry.example/self"/>
    <link rel="alternate" href="https://ferry.example/9"/>
    <summary>Two more piers from May.</summary>
  </entry>
</feed>"""


def test_feeds(spark):
    docs = spark.createDataFrame(
        [("https://f/rss", RSS), ("https://f/one", RSS_ONE), ("https://f/atom", ATOM),
         ("https://f/broken", "<rss><channel>"), ("https://f/empty", "<rss><channel/></rss>")],
        "feed_url string, xml string")
    rows = {r.title: r for r in feeds.parse_feed(docs, F.lit(at(99))).collect()}
    assert set(rows) == {"Harbour rail opens early", "Bridge tolls fall", "Only one",
                         "Ferry line extended"}
    rail, bridge = rows["Harbour rail opens early"], rows["Bridge tolls fall"]
    assert rail.body == "Trains run at dawn." and rail.language == "en"
    assert rail.source == "rss" and rail.feed == "https://f/rss"
    assert bridge.body == "Cars pay less." and bridge.published_at == rail.ingested_at
    one = rows["Only one"]
    assert one.body == "Only one" and one.url == "" and one.language == ""
    atom = rows["Ferry line extended"]
    assert atom.url == "https://ferry.example/9" and atom.language == "en"
    assert atom.body == "Two more piers from May."
    assert atom.published_at == rail.published_at
    ids = {r.id for r in rows.values()}
    assert len(ids) == 4 and all(len(i) == len("rss-") + 16 for i in ids)


def test_atom_link_fallback(spark):
    rows = spark.sql(
        "select array(named_struct('_href',' https://a ','_rel','self')) l "
        "union all select array() union all select array(named_struct('_href','x','_rel','self'),"
        "named_struct('_href','y','_rel',null))")
    assert sorted(r.u for r in rows.select(feeds.atom_link(F.col("l")).alias("u")).collect()) == [
        "", "https://a", "y"]


def test_gdelt(spark, work_dir):
    response = {"articles": [
        {"url": "https://e.com/1", "title": " Beta rises ", "seendate": "20260720T120000Z",
         "domain": "e.com", "language": "English"},
        {"url": "https://e.com/2", "title": "Two", "seendate": "?", "domain": "e.com", "language": "French"},
        {"url": "", "title": "No url"},
    ]}
    for name in ("a.json", "b.json"):
        with open(os.path.join(work_dir, name), "w") as handle:
            json.dump(response, handle, indent=1)
    rows = gdelt.read_gdelt(spark, work_dir, F.lit(at(5)))
    assert rows.count() == 4
    unique = {r.url: r for r in rows.collect()}
    one, two = unique["https://e.com/1"], unique["https://e.com/2"]
    assert one.title == one.body == "Beta rises" and one.language == "en" and one.feed == "e.com"
    assert one.id.startswith("gdelt-") and two.language == "french"
    assert two.published_at == two.ingested_at > one.published_at
    assert gdelt.parse_gdelt(
        spark.createDataFrame([('{"articles": []}',), ("{}",), ("oops",)], "value string"), F.lit(at(0))
    ).count() == 0


LINE = {"id": "1", "title": "t", "body": "b", "published_at": "2026-07-20T11:00:00Z",
        "ingested_at": "2020-01-01T00:00:00Z"}


def test_replay(spark, work_dir):
    path = os.path.join(work_dir, "in.jsonl")
    with open(path, "w") as handle:
        handle.write(json.dumps(LINE) + "\n  \n" + json.dumps(LINE | {"id": "2", "source": "rss"}) + "\n")
    rows = replay.read_replay(spark, path, F.lit(at(7)), "failfast").orderBy("id").collect()
    assert [(r.id, r.source, r.schema_version) for r in rows] == [("1", "replay", "1.0.0"), ("2", "rss", "1.0.0")]
    assert len({r.ingested_at for r in rows}) == 1 and rows[0].ingested_at > rows[0].published_at

    with open(path, "a") as handle:
        handle.write("{oops\n" + json.dumps(LINE | {"id": ""}) + "\n")
    with pytest.raises(PySparkException, match="invalid replay line"):
        replay.read_replay(spark, path, F.lit(at(7)), "failfast").collect()
    kept = replay.read_replay(spark, path, F.lit(at(7)))
    assert sorted(r.error or "" for r in kept.collect()) == ["", "", "decode error", "id is required"]


def test_modes(spark, work_dir):
    now = F.lit(at(0))
    for config in (SourceConfig("gdelt"), SourceConfig("rss"), SourceConfig("live"), SourceConfig("kafka")):
        with pytest.raises(ValueError):
            registry.build_sources(spark, config, now)
    for name, text in (("g", '{"articles":[{"url":"u","title":"T"}]}'), ("r", RSS_ONE), ("j", json.dumps(LINE))):
        os.makedirs(os.path.join(work_dir, name))
        with open(os.path.join(work_dir, name, "f"), "w") as handle:
            handle.write(text)
    live = registry.build_sources(
        spark, SourceConfig("live", gdelt_path=f"{work_dir}/g", rss_paths=(f"{work_dir}/r",)), now)
    assert len(live) == 2
    both = registry.fan_in(*live, *registry.build_sources(
        spark, SourceConfig(replay_path=f"{work_dir}/j"), now))
    assert sorted(r.source for r in both.collect()) == ["gdelt", "replay", "rss"]
