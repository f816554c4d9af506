"""Keyed stateful processors: rows wait in state until the watermark has passed them, then step in event-time order.

So results depend neither on how rows are cut into batches nor on their order inside the watermark's
delay. Native operators are preferred; these serve what they cannot express on a stream.

Every call to a processor and every access to its state is a trip between Python and the JVM, so keys
are dealt to ``BUCKETS`` buckets and a call handles all keys of a bucket, as tables sorted by key. The
trips then grow with buckets and batches, not with keys. A bucket's rows of one batch and those that
wait are sorted in its task, so the trigger's batch size and the delay bound the memory. A batch writes
the state of the buckets it reaches anew, but rows that only wait are added to those that do already.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from copy import copy
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

BUCKETS = 512  # fixed for the life of a checkpoint
BUCKET = "bucket_of_key"
NEVER = np.iinfo(np.int64).max


def _epoch_micros(ts: pd.Series) -> pd.Series:
    return ts.astype("datetime64[us]").astype("int64")


def _packed(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _lots(rows: pd.DataFrame, size: int = 1 << 14) -> list[tuple[bytes]]:
    return [(_packed(rows.iloc[i : i + size]),) for i in range(0, len(rows), size)]


def _unpacked(lots) -> pd.DataFrame | None:
    parts = [pa.ipc.open_stream(lot[0]).read_pandas() for lot in lots]
    return pd.concat(parts, ignore_index=True) if parts else None


class _One:
    """Value state of every key of a bucket: a table with a row for each, none if there is no key."""

    def __init__(self, handle: StatefulProcessorHandle, name: str) -> None:
        self.state = handle.getValueState(name, "rows binary")

    def get(self) -> pd.DataFrame | None:
        held = self.state.get()
        return _unpacked([held]) if held else None

    def put(self, rows: pd.DataFrame) -> None:
        if len(rows):
            self.state.update((_packed(rows),))
        else:
            self.state.clear()


class _Many:
    """List state of every key of a bucket: a table with any number of rows for each."""

    def __init__(self, handle: StatefulProcessorHandle, name: str) -> None:
        self.state = handle.getListState(name, "rows binary")

    def get(self) -> pd.DataFrame | None:
        return _unpacked(self.state.get()) if self.state.exists() else None

    def put(self, rows: pd.DataFrame) -> None:
        if len(rows):
            self.state.put(_lots(rows))
        else:
            self.state.clear()

    def add(self, rows: pd.DataFrame) -> None:
        self.state.appendList(_lots(rows))


def _heads(rows: pd.DataFrame, by: Sequence[str]) -> np.ndarray:
    """Where each key begins in rows sorted by key."""
    new = np.ones(len(rows), bool)
    if len(rows):
        new[1:] = False
    for column in by:
        left, right = rows[column].to_numpy()[:-1], rows[column].to_numpy()[1:]
        new[1:] |= (left != right) & ~((left != left) & (right != right))
    return np.flatnonzero(new)


def _spans(rows: pd.DataFrame, by: Sequence[str]) -> tuple[np.ndarray, np.ndarray, pd.DataFrame]:
    """The keys of rows sorted by key: where each begins, how many rows it has, and a table of them."""
    heads = _heads(rows, by)
    return heads, np.diff(np.append(heads, len(rows))), rows[list(by)].iloc[heads].reset_index(drop=True)


def _places(keys: pd.DataFrame, held: pd.DataFrame | None, by: Sequence[str]) -> np.ndarray:
    """Each key's row in a table of one row a key, or -1."""
    if held is None:
        return np.full(len(keys), -1)
    numbered = held[list(by)].assign(_place=np.arange(len(held)))
    return keys.merge(numbered, on=list(by), how="left")["_place"].fillna(-1).to_numpy(np.int64)


def _values(held: pd.DataFrame | None, column: str, places: np.ndarray, default) -> np.ndarray:
    return np.full(len(places), default) if held is None else np.where(places >= 0, held[column].to_numpy()[places], default)


def _replaced(held: pd.DataFrame | None, fresh: pd.DataFrame, by: Sequence[str]) -> pd.DataFrame:
    """A table of one row a key with the fresh rows in place of those of the same keys."""
    return fresh if held is None else pd.concat([fresh, held], ignore_index=True).drop_duplicates(list(by))


def _nth(heads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each row's place in its key, from 1."""
    return np.arange(1, sizes.sum() + 1) - np.repeat(heads, sizes)


class _Ordered(StatefulProcessor):
    """Hands the rows of a bucket's keys to ``steps`` in order, once; ``schema`` describes what it returns.

    ``steps`` gets rows that nothing can come before any more, perhaps none, sorted by key and then in
    order, and the watermark in milliseconds, up to which time has passed. What it returns holds the
    columns ``by`` that tell the key. ``wake`` names the time at which something is due although no
    row comes.
    """

    schema: str
    order = ["ts", "event_id"]
    null_keys = True  # whether rows without a key are a key's rows, or nobody's
    by: list[str]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = _Many(handle, "waiting")
        self.due = handle.getValueState("due", "row bigint, wake bigint")
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Names the processor's own state."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._advance(list(rows), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance([], timerValues.getCurrentWatermarkInMs())

    def _advance(self, parts: list[pd.DataFrame], watermark: int) -> Iterator[pd.DataFrame]:
        row, wake = before = self.due.get() or (NEVER, NEVER)
        held = self.waiting.get() if row <= watermark else None
        together = [part for part in (held, *parts) if part is not None and len(part)]
        ready, later = None, ()
        if together:
            merged = pd.concat(together, ignore_index=True).drop(columns=BUCKET, errors="ignore")
            at = _epoch_micros(merged["ts"]).to_numpy()
            passed = at <= watermark * 1000
            ready, later = merged[passed].sort_values([*self.by, *self.order], ignore_index=True), merged[~passed]
        if held is not None:
            self.waiting.put(later)
            row = NEVER
        elif len(later):
            self.waiting.add(later)
        if len(later):
            row = min(row, -(-int(at[~passed].min()) // 1000))
        out = None
        if (ready is not None and len(ready)) or wake <= watermark:
            out = self.steps(ready, watermark)
            wake = self.wake()
            wake = NEVER if wake is None or wake <= watermark else wake
        if (row, wake) != before:
            self.due.update((row, wake))
            if min(row, wake) not in (min(before), NEVER):
                self.handle.registerTimer(min(row, wake))
        for part in (out,) if isinstance(out, pd.DataFrame) else out or ():
            if not part.empty:
                yield part

    def steps(self, rows: pd.DataFrame | None, watermark: int) -> pd.DataFrame | Iterator[pd.DataFrame] | None:
        """What the rows lead to, in parts if it may be long; state is up to date when it returns."""
        raise NotImplementedError

    def wake(self) -> int | None:
        return None

    def close(self) -> None:
        pass


class _OnRows(_Ordered):
    """Acts on rows only: ``keys`` names the keys that have some, row ``heads[i]`` and ``sizes[i] - 1`` more are of key i."""

    def steps(self, rows, watermark):
        return None if rows is None or rows.empty else self.each(rows, *_spans(rows, self.by))

    def each(self, rows: pd.DataFrame, heads: np.ndarray, sizes: np.ndarray, keys: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError


class RunningCount(_OnRows):
    """Numbers the rows of a key. Value state."""

    schema = "id bigint, event_id bigint, nth bigint"

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.count = _One(handle, "count")

    def each(self, rows, heads, sizes, keys):
        held = self.count.get()
        n = _values(held, "n", _places(keys, held, self.by), 0)
        self.count.put(_replaced(held, keys.assign(n=n + sizes), self.by))
        return rows[[*self.by, "event_id"]].assign(nth=_nth(heads, sizes) + np.repeat(n, sizes))


class Jumps(_OnRows):
    """Neighbouring values of a key at least ``threshold`` apart. Value state."""

    schema = "id bigint, before double, after double"

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.last = _One(handle, "last")

    def each(self, rows, heads, sizes, keys):
        held = self.last.get()
        values = rows["temperature"].to_numpy(np.float64)
        before = np.roll(values, 1)
        before[heads] = _values(held, "value", _places(keys, held, self.by), np.nan)
        self.last.put(_replaced(held, keys.assign(value=values[heads + sizes - 1]), self.by))
        jump = np.abs(values - before) >= self.threshold
        return rows.loc[jump, self.by].assign(before=before[jump], after=values[jump])


class CountedAverage(_OnRows):
    """Average of the last ``size`` values after every ``slide`` rows. List and value state."""

    schema = "id bigint, firing bigint, avg_temp double"

    def __init__(self, size: int, slide: int) -> None:
        self.size, self.slide = size, slide

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.recent, self.count = _Many(handle, "recent"), _One(handle, "count")

    def each(self, rows, heads, sizes, keys):
        counted, kept = self.count.get(), self.recent.get()
        n = _values(counted, "n", _places(keys, counted, self.by), 0)
        self.count.put(_replaced(counted, keys.assign(n=n + sizes), self.by))
        fresh = rows[self.by].assign(
            value=rows["temperature"].to_numpy(np.float64), nth=_nth(heads, sizes) + np.repeat(n, sizes)
        )
        both = [fresh] if kept is None else [kept.assign(nth=0), fresh]
        both = pd.concat(both, ignore_index=True).sort_values(self.by, kind="stable", ignore_index=True)
        starts, lengths, _ = _spans(both, self.by)
        first = np.repeat(starts, lengths)
        self.recent.put(both.loc[np.arange(len(both)) >= first + np.repeat(lengths, lengths) - self.size, [*self.by, "value"]])
        nth, values = both["nth"].to_numpy(), both["value"].to_numpy()
        fires = np.flatnonzero((nth > 0) & (nth % self.slide == 0))
        window = fires[:, None] - np.arange(self.size)
        inside = window >= first[fires, None]
        sums = np.where(inside, values[np.maximum(window, 0)], 0.0).sum(axis=1)
        return both.loc[fires, self.by].assign(firing=nth[fires] // self.slide, avg_temp=sums / inside.sum(axis=1))


class KindProfile(_OnRows):
    """Per row the count of its kind so far and the highest value so far. Map and reducing state."""

    schema = "id bigint, event_id bigint, kind string, nth_of_kind bigint, highest double"

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.kinds = handle.getMapState("kinds", "kind string", "counts binary")
        self.highest = _One(handle, "highest")

    def each(self, rows, heads, sizes, keys):
        held = self.highest.get()
        before = np.repeat(_values(held, "highest", _places(keys, held, self.by), np.nan), sizes)
        values = rows["temperature"].astype("float64")
        top = np.where(values.isna(), np.nan, np.fmax(values.groupby(np.repeat(heads, sizes)).cummax(), before))
        highest = np.fmax(np.fmax.reduceat(top, heads), before[heads])
        self.highest.put(_replaced(held, keys.assign(highest=highest), self.by))
        nth = np.full(len(rows), np.nan)
        for kind, places in rows.groupby("kind").indices.items():
            nth[places] = self._count(kind, rows.iloc[places])
        return rows[[*self.by, "event_id", "kind"]].assign(nth_of_kind=nth, highest=top)

    def _count(self, kind: str, rows: pd.DataFrame) -> np.ndarray:
        held = _unpacked([self.kinds.getValue((kind,))]) if self.kinds.containsKey((kind,)) else None
        heads, sizes, keys = _spans(rows, self.by)
        n = _values(held, "n", _places(keys, held, self.by), 0)
        self.kinds.updateValue((kind,), (_packed(_replaced(held, keys.assign(n=n + sizes), self.by)),))
        return _nth(heads, sizes) + np.repeat(n, sizes)


class RisingAlert(_OnRows):
    """One alert per run in which the value never falls, once it lasts long enough since its first rise."""

    schema = "id bigint, run_start timestamp"

    def __init__(self, at_least_micros: int) -> None:
        self.at_least = at_least_micros

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.run = _One(handle, "run")

    def each(self, rows, heads, sizes, keys):
        held = self.run.get()
        places = _places(keys, held, self.by)
        names = {"start": 0, "value": np.nan, "rising": False, "alerted": False}
        state = zip(places.tolist(), *(_values(held, c, places, empty).tolist() for c, empty in names.items()), strict=True)
        times, values = _epoch_micros(rows["ts"]).tolist(), rows["temperature"].astype("float64").tolist()
        runs, alerts, where = [], [], []
        spans = zip(heads.tolist(), sizes.tolist(), state, strict=True)
        for i, (head, size, (place, start, last, rising, alerted)) in enumerate(spans):
            start, last = start if rising else None, last if place >= 0 else None
            for at, value in zip(times[head : head + size], values[head : head + size], strict=True):
                if last is not None and value < last:
                    start = None
                elif start is None and (last is None or value > last):
                    start, alerted = at, False
                if start is not None and not alerted and at - start >= self.at_least:
                    alerted = True
                    alerts.append(start)
                    where.append(i)
                last = value
            runs.append((start or 0, last, start is not None, alerted))
        fresh = pd.DataFrame(runs, columns=list(names))
        self.run.put(_replaced(held, pd.concat([keys, fresh], axis=1), self.by))
        return keys.iloc[where].assign(run_start=pd.to_datetime(np.array(alerts, np.int64), unit="us"))


class SilenceTimer(_Ordered):
    """Restarts a timer on every row; reports each time it ran out."""

    schema = "id bigint, last_second bigint"

    def __init__(self, delay_seconds: int) -> None:
        self.delay = delay_seconds

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.pending = _One(handle, "pending")
        self.earliest = handle.getValueState("earliest", "second bigint")

    def steps(self, rows, watermark):
        parts = [part for part in (self.pending.get(), self._seconds(rows)) if part is not None]
        if not parts:
            return None
        chain = pd.concat(parts, ignore_index=True).sort_values(self.by, kind="stable", ignore_index=True)
        seconds = chain["second"].to_numpy()
        last = np.append(_heads(chain, self.by)[1:], len(chain)) - 1
        ran_out = np.append(np.diff(seconds) > self.delay, False)
        over = (seconds[last] + self.delay + 1) * 1000 <= watermark
        ran_out[last] = over
        pending = chain.iloc[last[~over]]
        self.pending.put(pending)
        if len(pending):
            self.earliest.update((int(pending["second"].min()),))
        else:
            self.earliest.clear()
        return chain.loc[ran_out, self.by].assign(last_second=seconds[ran_out])

    def _seconds(self, rows: pd.DataFrame | None) -> pd.DataFrame | None:
        return None if rows is None else rows[self.by].assign(second=_epoch_micros(rows["ts"]) // 1_000_000)

    def wake(self):
        earliest = self.earliest.get()
        return (earliest[0] + self.delay + 1) * 1000 if earliest else None


class FailBursts(_Ordered):
    """Failures counted in windows opened by a first failure and called off by a success. Null keys are nobody."""

    null_keys = False
    schema = "user_id bigint, first_second bigint, last_second bigint, n_fails bigint"

    def __init__(self, within: int, at_least: int = 2) -> None:
        self.within, self.at_least = within, at_least

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.window = _One(handle, "open")
        self.earliest = handle.getValueState("earliest", "second bigint")

    def _closes_at(self, first: int) -> int:
        return (first + self.within + 1) * 1000

    def steps(self, rows, watermark):
        held = self.window.get()
        names = ["first", "last", "n"]
        under_way = {} if held is None else {w[:-3]: w[-3:] for w in held[[*self.by, *names]].itertuples(index=False, name=None)}
        out = []
        if rows is not None and len(rows):
            heads, sizes, keys = _spans(rows, self.by)
            seconds, statuses = (_epoch_micros(rows["ts"]) // 1_000_000).tolist(), rows["status"].tolist()
            for head, size, key in zip(heads.tolist(), sizes.tolist(), keys.itertuples(index=False, name=None), strict=True):
                first, last, n = under_way.pop(key, (None, None, 0))
                for at, status in zip(seconds[head : head + size], statuses[head : head + size], strict=True):
                    if first is not None and at > first + self.within:
                        out.append((*key, first, last, n))
                        first, n = None, 0
                    if status == "fail":
                        first, last, n = at if first is None else first, at, n + 1
                    else:
                        first, n = None, 0
                if first is not None:
                    under_way[key] = first, last, n
        closed = {key for key, (first, _, _) in under_way.items() if self._closes_at(first) <= watermark}
        out += [(*key, *under_way.pop(key)) for key in closed]
        self.window.put(pd.DataFrame([(*key, *w) for key, w in under_way.items()], columns=[*self.by, *names]))
        if under_way:
            self.earliest.update((min(int(first) for first, _, _ in under_way.values()),))
        else:
            self.earliest.clear()
        found = [f for f in out if f[-1] >= self.at_least]
        return pd.DataFrame(found, columns=[*self.by, "first_second", "last_second", "n_fails"])

    def wake(self):
        earliest = self.earliest.get()
        return self._closes_at(earliest[0]) if earliest else None


@dataclass(frozen=True)
class Step:
    """A row of a pattern: the boolean column that tells it, and whether other rows may lie before it."""

    flag: str
    relaxed: bool = False


def times(flag: str, n: int) -> tuple[Step, ...]:
    """n rows of a kind directly after each other."""
    return (Step(flag),) * n


class PatternMatches(_OnRows):
    """Rows that follow each other as the steps say, the last at most ``within`` after the first. List state.

    Every row that fits the first step starts a match of its own, so matches may overlap. A match under way
    holds the step it waits for and its start; it ends when its time is over, or when the next row doesn't
    fit a step that must follow directly. A relaxed step takes the next row that fits.
    """

    def __init__(self, key: str, key_type: str, steps: Sequence[Step], within_micros: int, inclusive: bool = True) -> None:
        self.key, self.sequence = key, tuple(steps)
        self.longest = within_micros - (not inclusive)
        self.schema = f"{key} {key_type}, first_ts timestamp, last_ts timestamp"

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.partial = _Many(handle, "partial")

    def each(self, rows, heads, sizes, keys):
        held = self.partial.get()
        under_way: dict[tuple, list[tuple[int, int]]] = {}
        if held is not None:
            for *key, step, first in held[[*self.by, "step", "first"]].itertuples(index=False, name=None):
                under_way.setdefault(tuple(key), []).append((step, first))
        flags = [rows[step.flag].fillna(False).to_numpy(bool) for step in self.sequence]
        needed = np.logical_or.reduce(flags).tolist()
        flags = [flag.tolist() for flag in flags]
        times = _epoch_micros(rows["ts"]).tolist()
        found, where = [], []
        for k, (head, size, key) in enumerate(
            zip(heads.tolist(), sizes.tolist(), keys.itertuples(index=False, name=None), strict=True)
        ):
            going = under_way.pop(key, [])
            for i in range(head, head + size):
                going = self._go_on(going, times[i], needed[i], [flag[i] for flag in flags], found)
            where += [k] * (len(found) - len(where))
            if going:
                under_way[key] = going
        partial = [(*key, *match) for key, matches in under_way.items() for match in matches]
        self.partial.put(pd.DataFrame(partial, columns=[*self.by, "step", "first"]))
        spans = np.array(found, np.int64).reshape(-1, 2)
        first, last = (pd.to_datetime(spans[:, i], unit="us") for i in (0, 1))
        return keys.iloc[where].assign(first_ts=first, last_ts=last)

    def _go_on(self, under_way: list, at: int, needed: bool, fits: list[bool], found: list) -> list:
        """The matches under way after a row, and those it completes added to ``found``."""
        if not needed:  # fits no step
            return [p for p in under_way if self.sequence[p[0]].relaxed]
        going = []
        for step, first in [*under_way, (0, at)]:
            if at - first > self.longest:
                continue
            if not fits[step]:
                if step and self.sequence[step].relaxed:
                    going.append((step, first))
            elif step + 1 == len(self.sequence):
                found.append((first, at))
            else:
                going.append((step + 1, first))
        return going


class FirstClosing(_Ordered):
    """For each opening row the first closing time at its time or later, less than ``within`` later, or null. List state.

    Rows bear ``opens``, ``closes`` and ``own``; an opening row of another slice is not told again.
    """

    def __init__(self, key: str, key_type: str, within_micros: int) -> None:
        self.key, self.within = key, within_micros
        self.schema = f"{key} {key_type}, opened_ts timestamp, event_id bigint, closed_ts timestamp"

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.pending = _Many(handle, "pending")
        self.earliest = handle.getValueState("earliest", "opened bigint")

    def steps(self, rows, watermark):
        held, fresh = self.pending.get(), None
        closes = pd.DataFrame(columns=[*self.by, "at"])
        if rows is not None and len(rows):
            timed = rows[[*self.by, "event_id"]].assign(at=_epoch_micros(rows["ts"]))
            fresh = timed[(rows["opens"] & rows["own"]).to_numpy(bool)]
            closes = timed.loc[rows["closes"].to_numpy(bool), [*self.by, "at"]]
        waiting = [part for part in (held, fresh) if part is not None and len(part)]
        if not waiting:
            return None
        opened = pd.concat(waiting, ignore_index=True)
        at = opened["at"].to_numpy(np.int64)
        nearest = self._nearest(opened, closes)
        closed = nearest - self.within < at
        over = closed | (at + self.within <= watermark * 1000)
        self.pending.put(opened[~over])
        if over.all():
            self.earliest.clear()
        else:
            self.earliest.update((int(at[~over].min()),))
        times = pd.Series(nearest[over]).where(closed[over]).astype("Int64")
        out = opened.loc[over, [*self.by, "event_id"]].reset_index(drop=True)
        return out.assign(opened_ts=pd.to_datetime(at[over], unit="us"), closed_ts=pd.to_datetime(times, unit="us"))

    def _nearest(self, opened: pd.DataFrame, closes: pd.DataFrame) -> np.ndarray:
        """The first closing time of each opening's key at its time or later, or the end of all time."""
        if not len(closes):
            return np.full(len(opened), NEVER)
        both = pd.concat([opened[[*self.by, "at"]], closes], ignore_index=True)
        key = both.groupby(self.by, sort=False, dropna=False).ngroup().to_numpy(np.int64)
        times, rank = np.unique(both["at"].to_numpy(np.int64), return_inverse=True)
        place = key * len(times) + rank  # in order of key and time
        ends = np.sort(place[len(opened) :])
        after = np.append(ends, -1)[np.searchsorted(ends, place[: len(opened)])]
        return np.where(after // len(times) == key[: len(opened)], times[after % len(times)], NEVER)

    def wake(self):
        earliest = self.earliest.get()
        return -(-(earliest[0] + self.within) // 1000) if earliest else None


class PaneSums(_Ordered):
    """Sliding sums of a key from its panes: what came in less what dropped out. List state.

    Rows are finished panes of ``pane`` microseconds, one per time, ``ts`` inside the pane, with whole
    numbers to add up. A window comes out once the watermark has passed its end, also when no row comes
    then, and only while it holds a pane. State holds the panes of one window length at most. Windows
    are made in lots, and a silence is skipped, so the work is that of the panes and of the result.
    """

    order = ["ts"]
    LOT = 1 << 16

    def __init__(self, keys: str, measures: Sequence[str], size: int, slide: int, pane: int) -> None:
        self.measures, self.size, self.slide, self.pane = tuple(measures), size, slide, pane
        self.schema = ", ".join([keys, "window_end timestamp", *[f"{m} bigint" for m in measures]])

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.panes = _Many(handle, "panes")
        self.told = handle.getValueState("told", "start bigint, earliest bigint")

    def _first(self, pane):
        """Start of the first window that holds the pane."""
        return -((self.size - self.pane - pane) // self.slide) * self.slide

    def steps(self, rows, watermark):
        held = self.panes.get()
        parts = [] if held is None else [held.assign(held=True)]
        if rows is not None and len(rows):
            fresh = rows[[*self.by, *self.measures]].assign(held=False)
            parts.append(fresh.assign(start=_epoch_micros(rows["ts"]) // self.pane * self.pane))
        if not parts:
            return None
        panes = pd.concat(parts, ignore_index=True).sort_values([*self.by, "start"], ignore_index=True)
        heads, sizes, keys = _spans(panes, self.by)
        starts, sums = panes["start"].to_numpy(np.int64), panes[list(self.measures)].to_numpy(np.int64)
        last = (watermark * 1000 - self.size) // self.slide * self.slide  # start of the last window that has ended
        begins = self._first(starts[heads])
        told = self.told.get()
        if told is not None:
            known = np.logical_or.reduceat(panes["held"].to_numpy(bool), heads)
            begins = np.where(known, np.maximum(begins, told[0] + self.slide), begins)
        kept = starts >= last + self.slide  # in windows still to come
        self.panes.put(panes.loc[kept, [*self.by, "start", *self.measures]])
        if kept.any():
            self.told.update((last, int(starts[kept].min())))
        else:
            self.told.clear()
        return self._told_together(keys, heads.tolist(), sizes.tolist(), begins.tolist(), starts, sums, last)

    def _told_together(self, keys, heads, sizes, begins, starts, sums, last) -> Iterator[pd.DataFrame]:
        """The windows of all keys, in parts of about a lot."""
        parts, size = [], 0
        for key, head, n, begin in zip(keys.itertuples(index=False, name=None), heads, sizes, begins, strict=True):
            so_far = np.zeros((n + 1, sums.shape[1]), np.int64)
            np.cumsum(sums[head : head + n], axis=0, out=so_far[1:])
            for part in self._windows(key, starts[head : head + n], so_far, begin, last):
                parts.append(part)
                size += len(part)
                if size >= self.LOT:
                    yield pd.concat(parts, ignore_index=True)
                    parts, size = [], 0
        if parts:
            yield pd.concat(parts, ignore_index=True)

    def _windows(self, key, starts: np.ndarray, so_far: np.ndarray, begin: int, last: int) -> Iterator[pd.DataFrame]:
        while begin <= last:
            at = int(np.searchsorted(starts, begin))
            if at == len(starts):
                return
            begin = max(begin, self._first(int(starts[at])))
            windows = np.arange(begin, min(last, begin + (self.LOT - 1) * self.slide) + 1, self.slide)
            begin += self.LOT * self.slide
            low, high = np.searchsorted(starts, windows), np.searchsorted(starts, windows + self.size)
            full = high > low
            sums = so_far[high[full]] - so_far[low[full]]
            out = pd.DataFrame({name: [value] * len(sums) for name, value in zip(self.by, key, strict=True)})
            out["window_end"] = pd.to_datetime(windows[full] + self.size, unit="us")
            yield out.assign(**{name: sums[:, i] for i, name in enumerate(self.measures)})

    def wake(self):
        """When the next window ends that holds a pane."""
        told = self.told.get()
        if not told:
            return None
        return -(-(max(told[0] + self.slide, self._first(told[1])) + self.size) // 1000)


class Retractions(StatefulProcessor):
    """Change rows of a key's totals: each batch takes the old total back (-1) and tells the new one (+1). Value state.

    Rows hold amounts to add up. A batch that leaves the totals as they are tells nothing.
    """

    by: list[str]

    def __init__(self, keys: str, measures: Sequence[str]) -> None:
        self.measures = list(measures)
        self.schema = f"{keys}, change int, " + ", ".join(f"{m} bigint" for m in measures)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = _One(handle, "totals")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, together = self.totals.get(), pd.concat(list(rows), ignore_index=True)
        fresh = together.groupby(self.by, sort=False, dropna=False)[self.measures].sum().reset_index()
        places = _places(fresh[self.by], held, self.by)
        old = np.column_stack([_values(held, m, places, 0) for m in self.measures]).astype(np.int64)
        new = old + fresh[self.measures].to_numpy(np.int64)
        known = places >= 0
        changed = ~known | (new != old).any(axis=1)
        tables = [fresh[self.by].assign(change=c, **dict(zip(self.measures, t.T, strict=True))) for c, t in ((-1, old), (1, new))]
        if changed.any():
            self.totals.put(_replaced(held, tables[1].drop(columns="change"), self.by))
            yield pd.concat([tables[0][changed & known], tables[1][changed]], ignore_index=True)

    def close(self) -> None:
        pass


def flagged_keys(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """Rows with a flag beside each key that tells a null, and the flags by key.

    Workers see a null number as a float that equals nothing, so a null travels as a flag beside some
    value. For numbers, strings, booleans and times.
    """
    kinds = {k: rows.schema[k].dataType.simpleString() for k in keys}
    some = {k: F.lit(0).cast("timestamp" if kind == "date" else kind).cast(kind) for k, kind in kinds.items()}
    flags = {k: f"no_{i}" for i, k in enumerate(keys)}
    marked = rows.withColumns({flag: F.col(k).isNull() for k, flag in flags.items()})
    return marked.withColumns({k: F.coalesce(k, some[k]) for k in keys}), flags


def in_buckets(
    marked: DataFrame, flags: dict[str, str], processor: _Ordered | Retractions, time_mode: str = "eventTime"
) -> DataFrame:
    """Runs a processor over rows with flagged keys, a bucket of keys at a time; null keys are a key."""
    placed = copy(processor)
    placed.by = [*flags, *flags.values()]
    out = (
        marked.withColumn(BUCKET, F.pmod(F.xxhash64(*placed.by), F.lit(BUCKETS)).cast("int"))
        .groupBy(BUCKET)
        .transformWithStateInPandas(
            statefulProcessor=placed,
            outputStructType=", ".join([processor.schema, *(f"{flag} boolean" for flag in flags.values())]),
            outputMode="append",
            timeMode=time_mode,
        )
    )
    return out.withColumns({k: F.when(~F.col(f), F.col(k)) for k, f in flags.items() if k in out.columns}).drop(*flags.values())


def apply_processor(stream: DataFrame, key: str | Sequence[str], processor: _Ordered) -> DataFrame:
    """Runs a processor per key over a stream, which needs a watermark on its time. It tells what null keys are."""
    keys = [key] if isinstance(key, str) else list(key)
    return in_buckets(*flagged_keys(stream if processor.null_keys else stream.dropna(subset=keys), keys), processor)
