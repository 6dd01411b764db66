"""Source modes resolved at plan time, and the fan-in of several sources."""

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession

from tidewire.sources import feeds, gdelt, replay

SourceFn = Callable[[SparkSession, "SourceConfig", Column], DataFrame]


@dataclass(frozen=True)
class SourceConfig:
    """Where each source lands its documents. Empty means not configured."""

    mode: str = "replay"
    replay_path: str = ""
    gdelt_path: str = ""
    rss_paths: tuple[str, ...] = field(default_factory=tuple)
    streaming: bool = False
    files_per_trigger: int | None = None


def _replay(spark: SparkSession, config: SourceConfig, now: Column) -> DataFrame:
    if config.streaming:
        return replay.stream_replay(spark, config.replay_path, now, config.files_per_trigger)
    return replay.read_replay(spark, config.replay_path, now)


def _gdelt(spark: SparkSession, config: SourceConfig, now: Column) -> DataFrame:
    if config.streaming:
        return gdelt.stream_gdelt(spark, config.gdelt_path, now, config.files_per_trigger)
    return gdelt.read_gdelt(spark, config.gdelt_path, now)


def _rss(spark: SparkSession, config: SourceConfig, now: Column) -> DataFrame:
    if config.streaming:
        return fan_in(*[
            feeds.stream_feeds(spark, path, now, config.files_per_trigger)
            for path in config.rss_paths
        ])
    return fan_in(*[feeds.read_feeds(spark, path, now) for path in config.rss_paths])


SOURCES: dict[str, SourceFn] = {"replay": _replay, "gdelt": _gdelt, "rss": _rss}


def register_source(name: str, build: SourceFn) -> None:
    """Add a source; ``mode=name`` then selects it."""
    SOURCES[name] = build


def build_sources(spark: SparkSession, config: SourceConfig, now: Column) -> list[DataFrame]:
    """The frames a mode stands for: one source, or with ``live`` all polled ones."""
    if config.mode == "live":
        names = [n for n, set_up in (("gdelt", config.gdelt_path), ("rss", config.rss_paths))
                 if set_up]
        if not names:
            raise ValueError("mode live needs gdelt_path and/or rss_paths")
    elif config.mode in SOURCES:
        names = [config.mode]
    else:
        raise ValueError(f"mode {config.mode!r} not supported: {sorted(SOURCES)} or live")
    if names == ["gdelt"] and not config.gdelt_path:
        raise ValueError("mode gdelt needs gdelt_path")
    if names == ["rss"] and not config.rss_paths:
        raise ValueError("mode rss needs rss_paths")
    return [SOURCES[name](spark, config, now) for name in names]


def fan_in(*frames: DataFrame) -> DataFrame:
    """Bag union of sources, batch or streaming; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
