"""Requests with the newest companion file as of their own time, kept in keyed state.

Companion arrivals and requests are two streams over the same prefixes. Per prefix
the state store keeps the companions that a request can still ask for: those newer
than the watermark and the newest one before it, so state stays bounded however
many companions land. A request gets the newest companion that landed at or before its
own time (equal times: the smallest path), whatever lands later, and a
restart goes on from the checkpoint with the companions of earlier runs.

Within a micro-batch rows count by event time, so the result does not depend on their
order in the files. A request that comes later than the watermark allows may find its
companion already dropped; it then goes out with the oldest one kept or none.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "times array<bigint>, paths array<string>"


class Companions:
    """Companions of one prefix by rising time, one path a time."""

    def __init__(self, times=(), paths=()):
        self.times, self.paths = list(times), list(paths)

    def land(self, time: int, path: str) -> None:
        at = bisect.bisect_left(self.times, time)
        if at < len(self.times) and self.times[at] == time:
            self.paths[at] = min(self.paths[at], path)
        else:
            self.times.insert(at, time)
            self.paths.insert(at, path)

    def as_of(self, time: int) -> str | None:
        at = bisect.bisect_right(self.times, time)
        return self.paths[at - 1] if at else None

    def forget_before(self, time: int) -> None:
        """Drop what no request from ``time`` on can ask for."""
        at = bisect.bisect_right(self.times, time) - 1
        if at > 0:
            del self.times[:at], self.paths[:at]


def _micros(c: Column) -> Column:
    return F.unix_micros(c)


def attach_companion_as_of(requests: DataFrame, companions: DataFrame, delay: str = "1 hour") -> DataFrame:
    """``requests`` (``prefix``, ``event_ts`` and any other columns) plus ``companion_path``.

    ``companions``: ``prefix, path, event_ts``. Both are streams; ``delay`` is how late a row may come.
    """
    others = [c for c in requests.columns if c not in ("prefix", "event_ts")]
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in others])) if others else F.lit("{}")
    asked = requests.select("prefix", "event_ts", F.lit(None).cast("string").alias("path"), body.alias("body"))
    landed = companions.select("prefix", "event_ts", "path", F.lit(None).cast("string").alias("body"))
    both = asked.unionByName(landed).withWatermark("event_ts", delay) \
        .withColumn("prefix", F.coalesce("prefix", F.lit(""))).withColumn("at", _micros(F.col("event_ts")))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, waiting = Companions(*state.get) if state.exists else Companions(), []
        for frame in frames:
            arrivals = frame[frame["path"].notna()]
            for time, path in zip(arrivals["at"].tolist(), arrivals["path"].tolist()):
                known.land(time, path)
            waiting.append(frame[frame["body"].notna()][["at", "body"]])
        out = pd.concat(waiting)
        if len(out):
            yield pd.DataFrame({"prefix": key[0], "at": out["at"].to_numpy(), "body": out["body"].to_numpy(),
                                "companion_path": [known.as_of(t) for t in out["at"].tolist()]})
        known.forget_before(state.getCurrentWatermarkMs() * 1000)
        state.update((known.times, known.paths))

    done = both.groupBy("prefix").applyInPandasWithState(
        step, "prefix string, at bigint, body string, companion_path string", STATE, "append", GroupStateTimeout.NoTimeout)
    schema = requests.select(*others).schema if others else None
    cols = [F.from_json("body", schema).alias("r")] if others else []
    out = done.select("prefix", F.timestamp_micros("at").alias("event_ts"), "companion_path", *cols)
    return out.select("prefix", "event_ts", *([f"r.`{c}`" for c in others]), "companion_path")


def deliver_once(records: DataFrame, delay: str = "1 hour", time_col: str = "event_time") -> DataFrame:
    """Each (bucket, key, event time) once, however often and in however many files it was delivered.

    The state store holds a record's key until the watermark, ``delay`` behind the newest
    event, has passed it; a record repeated later than that counts as new. A record without a
    readable time is dropped by the watermark's rule for nulls only if it repeats.
    """
    timed = records.withColumn("event_ts", F.try_to_timestamp(time_col)).withWatermark("event_ts", delay)
    return timed.dropDuplicatesWithinWatermark(["bucket", "key", time_col]).drop("event_ts")
