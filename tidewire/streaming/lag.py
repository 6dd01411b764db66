"""Consumer lag and rates from streaming progress."""

import json
import threading
from collections import Counter, deque
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

POSITIONS = (
    "ts timestamp, query string, topic string, partition int, position bigint, "
    "high_watermark bigint"
)


def progress_positions(progress: dict) -> list[tuple]:
    """Rows of ``POSITIONS`` in one progress report; sources without partitions give none."""
    ts = datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00"))
    rows = []
    for source in progress["sources"]:
        position, high = (_offsets(source.get(k)) for k in ("endOffset", "latestOffset"))
        for topic, partitions in high.items():
            for partition, latest in partitions.items():
                reached = position.get(topic, {}).get(partition, -1)
                rows.append((ts, progress.get("name"), topic, int(partition), reached, latest))
    return rows


def _offsets(value) -> dict:
    parsed = json.loads(value) if isinstance(value, str) else value
    if not isinstance(parsed, dict) or not all(isinstance(v, dict) for v in parsed.values()):
        return {}
    return parsed


PROGRESS = (
    "ts timestamp, query string, batch_id bigint, input_rows bigint, rows_per_second double, "
    "batch_millis bigint, observed string"
)


def progress_row(progress: dict) -> tuple:
    """The row of ``PROGRESS`` of one report; ``observed`` has the observed counts as JSON."""
    ts = datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00"))
    return (
        ts, progress.get("name"), progress.get("batchId"), progress.get("numInputRows"),
        progress.get("processedRowsPerSecond"), progress.get("durationMs", {}).get("triggerExecution"),
        json.dumps(progress.get("observedMetrics") or {}, sort_keys=True),
    )


class LagReporter(StreamingQueryListener):
    """Holds every ``every``-th progress report of each query until ``flush`` writes them.

    The callback only appends to a buffer of ``most`` reports, the oldest of which go first;
    it starts no job and cannot hold up the query. ``flush`` is called from the outside, on a
    timer or after a run, and writes one file per table and call: ``path/positions`` for the
    lag of topic partitions, ``path/progress`` for rows, rates and observed counts.
    """

    def __init__(self, every: int = 1, most: int = 10_000):
        self.every, self.dropped = every, 0
        self.seen: Counter[str] = Counter()
        self.held: deque[dict] = deque(maxlen=most)
        self.lock = threading.Lock()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = json.loads(event.progress.json)
        with self.lock:
            self.seen[progress["id"]] += 1
            if (self.seen[progress["id"]] - 1) % self.every == 0:
                self.dropped += len(self.held) == self.held.maxlen
                self.held.append(progress)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.lock:
            self.seen.pop(str(event.id), None)

    def flush(self, spark: SparkSession, path: str) -> int:
        """Write what is held; the number of reports. Without reports nothing is written."""
        with self.lock:
            reports = list(self.held)
            self.held.clear()
        if reports:
            rows = [progress_row(p) for p in reports]
            positions = [r for p in reports for r in progress_positions(p)]
            for name, some, shape in (("progress", rows, PROGRESS), ("positions", positions, POSITIONS)):
                frame = spark.createDataFrame(some, shape).coalesce(1)
                frame.write.mode("append").parquet(f"{path}/{name}")
        return len(reports)
