"""The same rows as a stream of several files must give what the batch operator gives."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tidewire.operators import process, readmodel, scoring, signals
from tidewire.sources import registry, replay
from tidewire.streaming import committed, dedup, lag, shocks, sinks, stages

LONG = "an invented body that is comfortably longer than twenty characters"


def raw_json(id_, title, body, lang="en", **changes):
    return json.dumps({
        "schema_version": "1.0.0", "id": id_, "source": "replay", "title": title, "body": body,
        "language": lang, "published_at": "2026-07-20T12:00:00Z",
        "ingested_at": "2026-07-20T12:00:01Z", **changes,
    })


MESSAGES = [
    raw_json("1", "Rail fares RISE", LONG),
    raw_json("2", "rail   fares   rise", LONG),
    raw_json("3", "Ferry note", "short"),
    raw_json("4", "Le pont", LONG, "fr"),
    raw_json("5", "Bridge closed", LONG + " indeed"),
    "{not json",
]


def write_files(folder, lines_per_file):
    for i, lines in enumerate(lines_per_file):
        with open(os.path.join(folder, f"part-{i:03d}.txt"), "w") as handle:
            handle.write("\n".join(lines) + "\n")
        os.utime(os.path.join(folder, f"part-{i:03d}.txt"), (1000 + i, 1000 + i))


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None


@pytest.mark.parametrize("live_seconds", [3600, None])
def test_process_stage(spark, work_dir, live_seconds):
    source = os.path.join(work_dir, "in")
    os.makedirs(source)
    write_files(source, [[m] for m in MESSAGES])
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(source)
    rows = stages.process_stage(stream, F.lit(at(60)), live_seconds=live_seconds, observe="process")
    query = sinks.to_table(rows, f"{work_dir}/out", f"{work_dir}/cp", every=None)
    drain(query)
    counted = [p["observedMetrics"]["process"] for p in map(json.loads, (x.json for x in query.recentProgress))
               if p["observedMetrics"]]
    assert sum(c["consumed"] for c in counted) == 6
    assert sum(c["filtered"] for c in counted) == 2 and sum(c["errors"] for c in counted) == 1
    out = {r.id: r for r in spark.read.parquet(f"{work_dir}/out").collect()}
    assert set(out) == {"1", "5"}
    assert out["1"].title == "rail fares rise"
    assert out["1"].content_hash.startswith("sha256:")

    bad = stages.quarantine_stage(stream)
    drain(sinks.to_table(bad, f"{work_dir}/bad", f"{work_dir}/cp-bad", every=None))
    assert [tuple(r) for r in spark.read.parquet(f"{work_dir}/bad").collect()] == [
        ("{not json", "decode error")
    ]


def test_ingest_to_score_end_to_end(spark, work_dir):
    """Replay files through all stages; the tables equal the batch pipeline's."""
    bodies = [
        "Sales fell and the loss grew; a recall may follow.",
        "Orders decline, demand is weak, and lenders warn of more.",
        "Orders jump, profit grew, and a strong rally followed.",
        "A record year: sales rose and the outlook was raised twice.",
    ]
    lines = [
        raw_json(f"n-{i}", f"Notice {i} on NMBS", bodies[i // 2 % 4], tickers=["NMBS"],
                 published_at=f"2026-07-20T12:00:{i * 5:02d}Z")
        for i in range(8)
    ]
    source = os.path.join(work_dir, "in")
    os.makedirs(source)
    write_files(source, [lines[:3], lines[3:6], lines[6:] + ["", "garbage"]])
    config = registry.SourceConfig(replay_path=source, streaming=True, files_per_trigger=1)
    frames = registry.build_sources(spark, config, F.lit(at(100)))

    wire = stages.ingest_stage(frames)
    drain(sinks.to_table(wire, f"{work_dir}/raw", f"{work_dir}/cp1", every=None))
    raw = spark.readStream.schema("key string, value string").parquet(f"{work_dir}/raw")
    processed = stages.process_stage(raw, F.lit(at(101)))
    from tidewire.operators.contract import to_wire
    out = to_wire(processed, "news.processed")
    drain(sinks.to_table(out, f"{work_dir}/processed", f"{work_dir}/cp2", every=None))

    messages = spark.readStream.schema("key string, value string").parquet(f"{work_dir}/processed")
    scored = stages.score_stage(messages, F.col("published_at"))
    write = sinks.write_scored(f"{work_dir}/tables", "a")
    drain(sinks.to_batches(scored, write, f"{work_dir}/cp3", every=None))
    drain(sinks.to_json_lines(scored, f"{work_dir}/log", f"{work_dir}/cp4", every=None))

    tables = sinks.scored_tables(f"{work_dir}/tables", "a")
    assert tables.read(spark, "results").count() == 8
    assert spark.read.text(f"{work_dir}/log").count() == 8
    # A replayed batch changes nothing.
    again = stages.score_stage(
        spark.read.schema("key string, value string").parquet(f"{work_dir}/processed"),
        F.col("published_at"),
    )
    write(again, 0)
    total = tables.read(spark, "results")
    assert total.count() == 8

    entities = tables.read(spark, "entities")
    assert {r.entity for r in entities.collect()} == {"NMBS"}
    series = entities.withColumn("arrival_seq", F.substring("item_id", 3, 5).cast("bigint"))
    found = signals.detect_shocks(series, 3600, 1.0, 3)
    assert found.count() >= 1
    assert readmodel.label_distribution(total).agg(F.sum("count")).first()[0] >= 8


def test_dedup_keeps_items_that_come_out_of_time_order(spark, work_dir):
    source = os.path.join(work_dir, "in")
    os.makedirs(source)
    hours = ["12:00", "20:00", "12:05", "20:01", "12:06"]
    write_files(source, [
        [raw_json(str(i), f"Notice {i}", f"{LONG} {i}", ingested_at=f"2026-07-20T{h}:00Z")]
        for i, h in enumerate(hours)
    ] + [[raw_json("9", "Notice 0", f"{LONG} 0", ingested_at="2026-07-21T09:00:00Z")]])
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(source)
    rows = stages.process_stage(stream, F.lit(at(60)))
    drain(sinks.to_table(rows, f"{work_dir}/out", f"{work_dir}/cp", every=None))
    assert {r.id for r in spark.read.parquet(f"{work_dir}/out").collect()} == set("01234")


def event_samples(spark):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("event_id").cast("string").alias("item_id"), F.col("event_type").alias("entity"),
        F.col("value").alias("sentiment_score"), F.col("ts").cast("timestamp").alias("inferred_at"),
        F.col("event_id").alias("arrival_seq"),
    )


def plain_shocks(frame):
    return sorted((r.item_id, r.entity, round(r.zscore, 8), round(r.std_velocity, 8))
                  for r in frame.collect())


@pytest.mark.parametrize("compact_every", [None, 2])
def test_shocks_of_interleaved_files_equal_batch(spark, work_dir, compact_every):
    """Files that overlap in time, a repeated batch, and samples that are delivered again."""
    samples = event_samples(spark)
    settings = (5 * 86_400, 2.0, 8)
    write = shocks.shock_writer(f"{work_dir}/tables", *settings, compact_every=compact_every)
    for i in range(5):
        write(samples.filter(F.col("arrival_seq") % 5 == i), i)
    write(samples.filter(F.col("arrival_seq") % 5 == 4), 4)
    write(samples.filter("false"), 5)
    redelivered = samples.filter("arrival_seq < 100").withColumn("arrival_seq", F.col("arrival_seq") + 10**6)
    write(redelivered.union(samples.limit(1).withColumn("entity", F.lit(None).cast("string"))), 6)

    streamed = plain_shocks(shocks.current_shocks(spark, f"{work_dir}/tables"))
    assert streamed == plain_shocks(signals.detect_shocks(samples, *settings))
    assert len(streamed) > 10
    assert shocks.current_shocks(spark, f"{work_dir}/none").count() == 0


def test_what_a_shock_batch_reads_does_not_grow(spark, work_dir, monkeypatch):
    """Samples in the order of time, batch by batch: each reads its own stretches."""
    read = []
    once = shocks._once

    def counting(near):
        read.append(near.count())
        return once(near)

    monkeypatch.setattr(shocks, "_once", counting)
    n = 12
    rows = spark.range(600 * n).select(
        F.col("id").cast("string").alias("item_id"), F.lit("one").alias("entity"),
        (F.hash("id") % 100 / 100.0).alias("sentiment_score"),
        F.timestamp_seconds(F.lit(1_784_548_800) + F.col("id") * 6).alias("inferred_at"),
        F.col("id").alias("arrival_seq"),
    )
    write = shocks.shock_writer(f"{work_dir}/tables", 300, 2.0, 8, compact_every=4)
    for i in range(n):
        write(rows.filter(F.floor(F.col("arrival_seq") / 600) == i), i)
    assert max(read[1:]) <= 600 + 2 * 50 and len(set(read[1:])) == 1
    found = plain_shocks(shocks.current_shocks(spark, f"{work_dir}/tables"))
    assert found == plain_shocks(signals.detect_shocks(rows, 300, 2.0, 8)) and found


# --- Committed tables --------------------------------------------------------------------


def number_tables(base, run="a"):
    return committed.CommittedTables(base, {"a": ("n long, k int", ("k",)), "b": ("n long", ())}, run)


def test_readers_see_whole_batches(spark, work_dir):
    tables = number_tables(f"{work_dir}/t")
    assert tables.read(spark, "a").count() == 0
    rows = spark.range(10).selectExpr("id n", "cast(id % 3 as int) k")
    tables.put("a", 0, rows)
    tables.put("b", 0, rows)
    assert tables.read(spark, "a").count() == 0 and tables.own(spark, "a", 0).count() == 10
    tables.commit(spark, 0)
    assert tables.read(spark, "a").count() == tables.read(spark, "b").count() == 10
    tables.put("a", 1, rows.limit(0))
    tables.put("b", 1, rows)
    assert tables.read(spark, "b").count() == 10
    tables.commit(spark, 1)
    assert sorted(r.n for r in tables.read(spark, "b").collect()) == sorted(2 * list(range(10)))


def test_a_batch_counts_once(spark, work_dir):
    tables = number_tables(f"{work_dir}/t")
    rows = spark.range(4).selectExpr("id n", "0 k")
    write = committed.writer(tables, lambda batch, _: {"a": batch, "b": batch})
    for batch_id in (0, 0, 1):
        write(rows, batch_id)
    assert tables.read(spark, "a").count() == 8
    # another checkpoint counts from 0 again
    committed.writer(number_tables(f"{work_dir}/t", "b"), lambda batch, _: {"a": batch, "b": batch})(rows, 0)
    assert tables.read(spark, "a").count() == 12


def test_compaction(spark, work_dir):
    tables = number_tables(f"{work_dir}/t")
    write = committed.writer(tables, lambda batch, _: {"a": batch, "b": batch}, compact_every=3)
    for i in range(7):
        write(spark.range(20).selectExpr(f"id + {100 * i} n", "cast(id % 2 as int) k"), i)
    assert [(c.first, c.last) for c in tables.commits(spark)] == [(0, 2), (3, 5), (6, 6)]
    before = sorted(r.n for r in tables.read(spark, "a").collect())
    files = os.listdir(f"{work_dir}/t/a/run=a/batches=0-2/k=0")
    assert len([f for f in files if f.endswith(".parquet")]) == 1
    write(spark.range(20).selectExpr("id n", "0 k"), 1)
    assert tables.clean(spark) == 6 and not os.path.exists(f"{work_dir}/t/a/run=a/batches=0-0")
    assert sorted(r.n for r in tables.read(spark, "a").collect()) == before and len(before) == 140
    assert tables.is_committed(spark, 4) and not tables.is_committed(spark, 7)
    kept = tables.compact(spark, 1, {"b": lambda rows: rows.filter("n > 605")})
    assert kept is None  # one batch is not compacted


def test_late_rows_go_aside(spark, work_dir):
    rows = spark.createDataFrame(
        [(0, at(0)), (0, at(500)), (1, at(300)), (1, at(390)), (1, at(400)), (1, None), (2, at(1000)),
         (2, at(399)), (3, at(899)), (3, at(900))], "batch int, ts timestamp")
    tables = committed.late_tables(f"{work_dir}/t", rows.schema)
    write = committed.late_writer(tables, "ts", 100, compact_every=2)
    for i in (0, 1, 1, 2, 3, 4):
        write(rows.filter(F.col("batch") == i), i)
    late = {(r.batch, r.ts and r.ts.timestamp() - at(0).timestamp())
            for r in tables.read(spark, "late").collect()}
    # marks: none, 400, 400, 900
    assert late == {(1, 300), (1, 390), (1, None), (2, 399), (3, 899)}
    assert tables.read(spark, "timely").count() == 5


# --- First copies ------------------------------------------------------------------------


def test_first_of_batch(spark):
    rows = spark.createDataFrame(
        [("a", 3, "x"), ("a", 1, "y"), ("a", None, "z"), ("b", None, "p"), ("b", None, "p"),
         (None, 0, "q"), ("c", 5, "r"), ("c", 5, "r")], "key string, place int, text string")
    found = sorted((r.key, r.text) for r in dedup.first_of_batch(rows, "key", "place").collect())
    assert found == [("a", "y"), ("b", "p"), ("c", "r")]
    assert dedup.first_of_batch(rows.limit(0), "key", "place").count() == 0


def test_first_of_batch_of_some_keys(spark):
    rows = spark.createDataFrame(
        [("a", 3, "x"), ("a", 1, "y"), ("b", None, "p"), (None, 0, "q"), ("c", 5, "r"), ("c", 5, "r")],
        "key string, place int, text string")
    for marks, texts in ([["a"], ["y"]], [["c", "b", "z"], ["p", "r"]], [[None], []], [[], []]):
        own = spark.createDataFrame([(m,) for m in marks], "mark string")
        found = sorted(r.text for r in dedup.first_of_batch(rows, "key", "place", own).collect())
        assert found == texts


def test_copies_do_not_meet_at_the_marks(spark, work_dir, capsys):
    """Keys and least ordinals are joined with the marks, not the rows, of which a key has most."""
    rows = spark.range(5_000, numPartitions=4).select(
        F.when(F.col("id") % 5 > 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.col("id").alias("place"), F.sha2(F.col("id").cast("string"), 512).alias("text"),
    )
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    passed = []

    def write(batch, _):
        batch.explain("extended")
        passed.extend(r.place for r in batch.collect())

    was = spark.conf.get(broadcast)
    spark.conf.set(broadcast, "-1")
    try:
        dedup.first_seen_writer(write, f"{work_dir}/m", "key", "place")(rows, 0)
    finally:
        spark.conf.set(broadcast, was)
    assert sorted(passed) == sorted([1, *range(0, 5_000, 5)])
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical")[0]
    assert plan.count("Join LeftSemi") == 1
    below = plan.split("Join LeftSemi")[1].splitlines()[1:]
    left = next(line for line in below if "- Filter" not in line and "- Project" not in line)
    assert "Aggregate [" in left


@pytest.mark.parametrize("live_seconds", [None, 3600])
def test_first_seen_writer(spark, work_dir, live_seconds):
    shape = "key string, place long, text string"
    batches = [[("a", 2, "late"), ("a", 1, "early"), ("b", None, "only")], [],
               [("a", 0, "again"), ("c", 9, "new")], [("b", 1, "again"), (None, 1, "no key")]]
    passed = {}

    def write(batch, batch_id):
        passed[batch_id] = sorted(r.text for r in batch.collect())

    first = dedup.first_seen_writer(write, f"{work_dir}/m", "key", "place", live_seconds, compact_every=2)
    for i, rows in enumerate(batches):
        for _ in range(2):  # a repeated batch passes on the same rows
            first(spark.createDataFrame(rows, shape), i)
    assert passed == {0: ["early", "only"], 1: [], 2: ["new"], 3: []}


def test_marks_expire(spark, work_dir):
    passed = []
    first = dedup.first_seen_writer(
        lambda batch, _: passed.append(batch.count()), f"{work_dir}/m", "key", "place", 0)
    rows = spark.createDataFrame([("a", 1)], "key string, place long")
    for i in range(2):
        first(rows, i)
    assert passed == [1, 1]


def test_process_writer_and_its_summary(spark, work_dir):
    source = os.path.join(work_dir, "in")
    os.makedirs(source)
    write_files(source, [MESSAGES[:4], MESSAGES[4:], [MESSAGES[0], MESSAGES[2]]])
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(source).withColumn(
        "place", -F.length("value"))
    seen = []

    def write(batch, batch_id):
        seen.extend((batch_id, r.id) for r in batch.collect())

    process_batch = stages.process_writer(write, f"{work_dir}/p", F.lit(at(60)), order="place")
    drain(sinks.to_batches(stream, process_batch, f"{work_dir}/cp", every=None))
    # the longer of two equal messages has the lesser ordinal
    assert sorted(seen) == [(0, "2"), (1, "5")]
    assert stages.run_summary(spark, f"{work_dir}/p").first().asDict() == {
        "consumed": 8, "processed": 2, "duplicates": 2, "filtered": 3, "errors": 1}


def test_no_python_in_the_state(spark, work_dir):
    source = os.path.join(work_dir, "in")
    os.makedirs(source)
    write_files(source, [[m] for m in MESSAGES])
    rows = dedup.first_seen(spark.readStream.text(source).withColumn("key", F.sha2("value", 256)), "key", 60)
    query = sinks.to_table(rows, f"{work_dir}/out", f"{work_dir}/cp", every=None)
    drain(query)
    plan = query._jsq.explainInternal(False)
    assert "DeduplicateWithinWatermark" in plan and "Python" not in plan and "Pandas" not in plan


def test_score_stage_takes_a_table(spark, work_dir):
    source = os.path.join(work_dir, "in")
    os.makedirs(source)
    body = json.dumps({**json.loads(raw_json("1", "On Zed Works", LONG)), "content_hash": "sha256:x",
                       "processed_at": "2026-07-20T12:00:02Z", "tickers": None})
    write_files(source, [[body]])
    table = spark.createDataFrame([(0, "ZW", "Zed Works")], "ord int, ticker string, company string")
    scored = stages.score_stage(spark.readStream.text(source), F.col("published_at"), None, table)
    found = []
    drain(sinks.to_batches(scored, lambda b, _: found.extend(b.collect()), f"{work_dir}/cp", every=None))
    assert [[tuple(e) for e in r.entities] for r in found] == [[("Zed Works", "company")]]


def test_timeline_counts_late_rows(spark, work_dir):
    rows = spark.createDataFrame(
        [(at(0), 1.0, 0), (at(1200), 0.1, 0), (at(10), 0.0, 1), (at(70), 0.5, 1), (at(5), None, 1)],
        "inferred_at timestamp, sentiment_score double, batch int",
    )
    write = sinks.write_batches(f"{work_dir}/t", "a", stages.partial_timeline)
    for i in (0, 1, 1):
        write(rows.filter(F.col("batch") == i), i)
    got = stages.merge_timeline(spark.read.parquet(f"{work_dir}/t")).orderBy("bucket").collect()
    assert [(r.volume, r.avg_sentiment) for r in got] == [(2, .5), (1, .5), (1, .1)]


def test_arrival_ordinals(spark):
    rows = spark.range(100).repartition(4)
    found = [r.n for i in (0, 7) for r in rows.select(stages.arrived(rows, i).alias("n")).collect()]
    assert len(set(found)) == 200 and max(found[:100]) < min(found[100:])


def test_no_ordinal_is_given_twice(spark):
    with pytest.raises(ValueError):
        stages.arrived(spark.range(1), 1 << 24)
    many = spark.range(20_000).repartition(1 << 14).select(stages.arrived(spark.range(1), 0).alias("n"))
    with pytest.raises(Exception, match="too many tasks"):
        many.agg(F.max("n")).collect()


def test_replay_stream_rate(spark, work_dir):
    source = os.path.join(work_dir, "in")
    os.makedirs(source)
    write_files(source, [[m] for m in MESSAGES])
    rows = replay.stream_replay(spark, source, F.lit(at(5)), files_per_trigger=2)
    query = sinks.to_memory(rows, "replayed", f"{work_dir}/cp")
    drain(query)
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [2, 2, 2]
    assert spark.table("replayed").count() == 6


def test_lag_positions():
    progress = {
        "timestamp": "2026-07-20T12:00:00.000Z", "name": "process",
        "sources": [
            {"endOffset": '{"news.raw":{"0":5,"1":7}}', "latestOffset": '{"news.raw":{"0":9,"1":7,"2":3}}'},
            {"endOffset": '{"logOffset":3}', "latestOffset": None},
        ],
    }
    rows = lag.progress_positions(progress)
    assert [r[2:] for r in rows] == [
        ("news.raw", 0, 5, 9), ("news.raw", 1, 7, 7), ("news.raw", 2, -1, 3)
    ]


def test_progress_is_buffered_and_flushed(spark, work_dir):
    source = os.path.join(work_dir, "in")
    os.makedirs(source)
    write_files(source, [[m] for m in MESSAGES])
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(source)
    reporter = lag.LagReporter()
    spark.streams.addListener(reporter)
    try:
        for name in ("one", "two"):
            rows = stages.evaluate_stage(stream, observe="counts").filter("error is null").select("id")
            query = sinks.to_memory(rows, name, f"{work_dir}/cp-{name}")
            drain(query)
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
            for _ in range(100):
                if len(reporter.held) >= 6:
                    break
                time.sleep(0.1)
            assert reporter.flush(spark, f"{work_dir}/log") >= 6
    finally:
        spark.streams.removeListener(reporter)
    assert reporter.flush(spark, f"{work_dir}/log") == 0
    files = [f for f in os.listdir(f"{work_dir}/log/progress") if f.endswith(".parquet")]
    assert len(files) == 2  # one a flush
    log = spark.read.parquet(f"{work_dir}/log/progress")
    sums = {r["query"]: r["n"] for r in log.groupBy("query").agg(F.sum("input_rows").alias("n")).collect()}
    assert sums == {"one": 6, "two": 6}
    consumed = log.selectExpr("cast(get_json_object(observed, '$.counts.consumed') as int) n")
    assert consumed.agg(F.sum("n")).first()[0] == 12
    assert spark.read.schema(lag.POSITIONS).parquet(f"{work_dir}/log/positions").count() == 0


def test_reporter_forgets_the_oldest():
    reporter = lag.LagReporter(every=2, most=3)

    class Event:
        def __init__(self, k):
            self.progress = type("P", (), {"json": json.dumps({
                "id": "q", "timestamp": "2026-07-20T12:00:00.000Z", "sources": [], "batchId": k})})

    for k in range(10):
        reporter.onQueryProgress(Event(k))
    assert [p["batchId"] for p in reporter.held] == [4, 6, 8] and reporter.dropped == 2


def test_replay_at_a_rate_goes_on_after_a_stop(spark, work_dir):
    source = os.path.join(work_dir, "in")
    os.makedirs(source)
    write_files(source, [[f"{i}-{k}" for k in range(7)] for i in range(3)])
    total = replay.number_lines(spark, source, f"{work_dir}/numbered")
    assert total == 21
    seen, fail = {}, [True]

    def write(batch, batch_id):
        if batch_id == 2 and fail:
            fail.pop()
            raise RuntimeError("lost")
        seen[batch_id] = [(r.n, r.value) for r in batch.orderBy("n").collect()]

    args = (spark, f"{work_dir}/numbered", total, write, f"{work_dir}/cp", 4, "0 seconds")
    with pytest.raises(Exception, match="lost"):
        replay.run_at_rate(*args)
    replay.run_at_rate(*args)
    lines = [x for k in sorted(seen) for x in seen[k]]
    assert [n for n, _ in lines] == list(range(21)) and max(map(len, seen.values())) == 4
    assert [v for _, v in lines] == [f"{i}-{k}" for i in range(3) for k in range(7)]
    replay.run_at_rate(spark, f"{work_dir}/numbered", 0, write, f"{work_dir}/cp-none", 4)
