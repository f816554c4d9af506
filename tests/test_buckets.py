"""Processors work on buckets of keys: the trips to state don't grow with the keys, and no key sees another's rows."""

from __future__ import annotations

import random
from types import SimpleNamespace

import pandas as pd
import pytest

from tests.conftest import rows
from tidemark.sources.streams import file_stream
from tidemark.streaming import processors
from tidemark.streaming.runner import run_to_table, stream_session, with_end

SECOND = 1_000_000
BY = ["id", "no_0"]
CASES = {
    "stream_payment_timeouts": lambda: processors.FirstClosing("id", "bigint", 300 * SECOND),
    "stream_retract_counts": lambda: processors.Retractions("id bigint", ["n"]),
    "stream_silence_timer": lambda: processors.SilenceTimer(300),
    "stream_kind_profile": lambda: processors.KindProfile(),
    "stream_login_bursts": lambda: processors.FailBursts(300),
    "stream_rising_alerts": lambda: processors.RisingAlert(300 * SECOND),
    "stream_rolling_averages": lambda: processors.CountedAverage(10, 2),
    "stream_login_failures": lambda: processors.PatternMatches("id", "bigint", processors.times("match", 2), 300 * SECOND),
    "stream_running_count": lambda: processors.RunningCount(),
}


class State:
    """A value, list or map state in memory that counts the accesses."""

    def __init__(self, handle):
        self.handle, self.held = handle, None

    def _trip(self, held):
        self.handle.trips += 1
        self.held = held

    def exists(self):
        self._trip(self.held)
        return self.held is not None

    def get(self):
        self._trip(self.held)
        return self.held

    def update(self, value):
        self._trip(value)

    put = update

    def clear(self):
        self._trip(None)

    def appendList(self, values):  # noqa: N802
        self._trip([*(self.held or []), *values])

    def containsKey(self, key):  # noqa: N802
        self._trip(self.held)
        return key in (self.held or {})

    def getValue(self, key):  # noqa: N802
        self._trip(self.held)
        return self.held[key]

    def updateValue(self, key, value):  # noqa: N802
        self._trip({**(self.held or {}), key: value})


class Handle:
    def __init__(self):
        self.trips, self.timers = 0, []
        self.getValueState = self.getListState = self.getMapState = lambda name, *schema: State(self)

    def registerTimer(self, at):  # noqa: N802
        self.trips += 1
        self.timers.append(at)


def events(keys):
    """Four batches of rows of each key, with the watermark after each."""
    batches = [[] for _ in range(4)]
    for key in range(keys):
        draw = random.Random(key)
        at = 0
        for i in range(24):
            at += draw.choice([0, 1, 5, 400]) * SECOND + draw.randint(0, 3)
            kind = draw.choice(["fail", "success"])
            row = {"id": key, "no_0": False, "ts": pd.Timestamp(at, unit="us"), "event_id": key * 100 + i}
            row |= {"temperature": draw.randint(0, 9) / 2, "kind": draw.choice("ab"), "status": kind, "match": kind == "fail"}
            row |= {"opens": kind == "fail", "closes": kind == "success", "own": True, "n": draw.randint(0, 1), processors.BUCKET: 0}
            batches[i // 6].append(row)
    return [(pd.DataFrame(batch), watermark) for batch, watermark in zip(batches, (0, 1_000_000, 2_000_000, 9_000_000), strict=True)]


def run(processor, batches):
    """The results of a bucket, and its trips to state and timers."""
    handle, processor.by, out, shown = Handle(), BY, [], 0
    processor.init(handle)
    for frame, watermark in batches:
        timer = SimpleNamespace(getCurrentWatermarkInMs=lambda watermark=watermark: watermark)
        out += processor.handleInputRows((0,), iter([frame] if len(frame) else []), timer) if len(frame) else []
        while not isinstance(processor, processors.Retractions) and any(at <= watermark for at in handle.timers):
            handle.timers = [at for at in handle.timers if at > watermark]
            out += processor.handleExpiredTimer((0,), timer, None)
    end = SimpleNamespace(getCurrentWatermarkInMs=lambda: 10**12)
    if handle.timers:
        out += processor.handleExpiredTimer((0,), end, None)
    if not out:
        return [], handle.trips
    found = pd.concat(out).drop(columns="no_0")
    return sorted(map(repr, found[sorted(found)].astype(object).itertuples(index=False, name=None))), handle.trips


@pytest.mark.parametrize("name", CASES)
def test_trips_do_not_grow_with_keys(name):
    """A bucket of 60 keys takes no more trips than one of 20, and gives what its keys give alone."""
    few, many = events(20), events(60)
    found, trips = run(CASES[name](), many)
    alone = []
    for key in range(60):
        alone += run(CASES[name](), [(frame[frame["id"] == key], watermark) for frame, watermark in many])[0]
    assert found == sorted(alone) and len(found) > 30
    assert trips <= run(CASES[name](), few)[1] + 10 < 100


def test_null_keys_beside_others(spark, tmp_path):
    """Null keys are a key of their own and leave other keys' rows alone."""
    made = [(i, None if i % 3 == 0 else i % 3 + 2**60, i) for i in range(90)]
    df = spark.createDataFrame(made, "event_id bigint, id bigint, s bigint").selectExpr("event_id", "id", "timestamp_seconds(s + 1000) AS ts")
    path = str(tmp_path / "in")
    df.repartition(3).write.parquet(path)
    stream, end = with_end(file_stream(stream_session(spark), path, df.schema), "ts", event_id=-1, id=-1)
    numbered = processors.apply_processor(stream.withWatermark("ts", "2 minutes"), "id", processors.RunningCount())
    assert rows(run_to_table(numbered, spark, [end])) == sorted(((k, i, i // 3 + 1) for i, k, _ in made), key=repr)


def test_a_rise_from_a_null_time_is_kept_over_batches():
    row = {"id": 1, "no_0": False, processors.BUCKET: 0}
    batches = [
        (pd.DataFrame([row | {"ts": pd.Timestamp(at), "event_id": i, "temperature": float(i)}]), watermark)
        for i, (at, watermark) in enumerate([(pd.NaT, 1000), ("1970-01-02", 10**9)])
    ]
    found, _ = run(processors.RisingAlert(SECOND), batches)
    assert found == ["(1, NaT)"]
