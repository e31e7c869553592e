"""Windows and triggers as keyed state machines on ``transformWithState``.

What Structured Streaming's own window aggregates cannot say: results that
are corrected by late rows (J20, J21), global windows with count triggers
(J10, J11), a result for every row (J22), windows closed by the wall clock
(J17), idle time-outs (K02), processing-time timers that re-arm (K08), and a
one-to-one join that gives up unmatched rows (C12).  ``state_rows`` reads the
state of a query as a table (K02).

Every function takes a stream and gives a stream whose first columns are the
key columns with their own types.  State is bounded per key as each says, and
lies in the query's checkpoint, so it survives restarts and lost executors.
"""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidemill.functions.time import epoch_seconds
from tidemill.streaming.stateful import apply


def micros(ts: dt.datetime) -> int:
    """Epoch microseconds of a UTC wall time."""
    return calendar.timegm(ts.utctimetuple()) * 1_000_000 + ts.microsecond


class Keyed(StatefulProcessor):
    """A processor whose rows begin with the key columns."""

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)

    def init(self, handle) -> None:
        self.handle = handle

    def row(self, key, **values) -> Row:
        key = key if isinstance(key, tuple) else (key,)
        return Row(**dict(zip(self.keys, key)), **values)

    def close(self) -> None:
        pass


def keyed(stream: DataFrame, keys: Sequence[str], processor: Keyed, columns: str, mode: str = "Append",
          time_mode: str = "None") -> DataFrame:
    """``processor`` on ``stream`` by ``keys``; the result has the key columns with their types, then ``columns``."""
    types = dict(stream.dtypes)
    return apply(stream, keys, processor, ", ".join([*[f"{k} {types[k]}" for k in keys], columns]), mode, time_mode)


# ---- J20, J21: late rows correct a window that has fired --------------------------------

class LatenessWindows(Keyed):
    """State: per open window of a key its start, count, sum and firings.

    Spark's watermark trails the nominal one (largest event time minus delay)
    by ``size + lateness``, so Spark itself drops only rows whose window is
    past its lateness whatever it is; the windows are judged by the nominal one.
    Each window has two event-time timers: its end, where it fires, and its end
    plus lateness, where its state goes.
    """

    def __init__(self, keys, ts: str, value: str, size_ms: int, lateness_ms: int):
        super().__init__(keys)
        self.ts, self.value, self.size, self.late = ts, value, size_ms, lateness_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.windows = handle.getMapState("windows", "start long", "cnt long, total double, firings int")

    def _out(self, key, start, kind, cnt, total, firing) -> Row:
        return self.row(key, window_start=start // 1000, window_end=(start + self.size) // 1000, kind=kind, cnt=cnt, total=total, firing=firing)

    def handleInputRows(self, key, rows, timerValues):
        nominal = timerValues.getCurrentWatermarkInMs() + self.size + self.late if timerValues.getCurrentWatermarkInMs() > 0 else None
        for r in sorted(rows, key=lambda r: r[self.ts]):
            t = micros(r[self.ts]) // 1000
            start = t - t % self.size
            end, value = start + self.size, float(r[self.value] or 0.0)
            if nominal is not None and end + self.late <= nominal:
                yield self._out(key, start, "dropped", 1, value, 0)
                continue
            known = self.windows.containsKey((start,))
            cnt, total, firings = self.windows.getValue((start,)) if known else (0, 0.0, 0)
            if nominal is not None and end <= nominal and known and firings == 0:  # rows come before timers in a batch
                firings = 1
                yield self._out(key, start, "fired", cnt, total, firings)
            cnt, total = cnt + 1, total + value
            if nominal is not None and end <= nominal:  # the window has ended: fire again at once
                firings += 1
                yield self._out(key, start, "fired", cnt, total, firings)
            elif not known:
                self.handle.registerTimer(end - self.size - self.late)
            if not known:
                self.handle.registerTimer(end - self.size)
            self.windows.updateValue((start,), (cnt, total, firings))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        at = expiredTimerInfo.getExpiryTimeInMs()
        start = at + self.late  # the window that ends now by the nominal watermark
        if self.windows.containsKey((start,)):
            cnt, total, firings = self.windows.getValue((start,))
            if firings == 0:
                self.windows.updateValue((start,), (cnt, total, 1))
                yield self._out(key, start, "fired", cnt, total, 1)
        if self.windows.containsKey((at,)):  # the window whose lateness is over
            self.windows.removeKey((at,))


def windows_with_lateness(stream: DataFrame, keys: Sequence[str], ts: str, value: str, size_s: int, delay_s: int, lateness_s: int) -> DataFrame:
    """Tumbling windows by key that late rows correct.

    A window fires once the largest event time minus ``delay_s`` reaches its
    end.  Until that passes its end by ``lateness_s`` each further row of the
    window gives a corrected row at once; later rows come out as ``dropped``
    (those older still are dropped by Spark and counted in the query's
    progress).  Result: keys, window_start, window_end (epoch seconds), kind
    (fired or dropped), cnt, total, firing (1, then 2, 3, ... for corrections).
    Rows with a null time take no part; a null value adds nothing to total.
    """
    marked = stream.where(F.col(ts).isNotNull()).withWatermark(ts, f"{delay_s + size_s + lateness_s} seconds")
    return keyed(marked.select(*keys, ts, value), keys, LatenessWindows(keys, ts, value, 1000 * size_s, 1000 * lateness_s),
                 "window_start long, window_end long, kind string, cnt long, total double, firing int", time_mode="EventTime")


# ---- J10, J11: global windows with count triggers ----------------------------------------

class AccumulatingTrigger(Keyed):
    """State: count and sum of a key's rows so far, never cleared; a row at every ``n``-th."""

    def __init__(self, keys, order: Sequence[str], value: str, n: int):
        super().__init__(keys)
        self.order, self.value, self.n = list(order), value, n

    def init(self, handle) -> None:
        super().init(handle)
        self.state = handle.getValueState("so_far", "cnt long, total double")

    def handleInputRows(self, key, rows, timerValues):
        cnt, total = self.state.get() if self.state.exists() else (0, 0.0)
        for r in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            cnt, total = cnt + 1, total + float(r[self.value] or 0.0)
            if cnt % self.n == 0:
                yield self.row(key, seq=cnt, total=total)
        self.state.update((cnt, total))


def accumulating_trigger_stream(stream: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, n: int) -> DataFrame:
    """At every ``n``-th row of a key the total of all its rows so far: keys, seq, total.

    Rows count in arrival order; inside one micro-batch in that of ``order``.
    """
    return keyed(stream.select(*dict.fromkeys([*keys, *order, value])), keys, AccumulatingTrigger(keys, order, value, n), "seq long, total double")


class LastRows(Keyed):
    """State: rows seen, and a ring of the last ``size`` values; older ones are evicted by overwriting their slot."""

    def __init__(self, keys, order: Sequence[str], value: str, size: int, slide: int):
        super().__init__(keys)
        self.order, self.value, self.size, self.slide = list(order), value, size, slide

    def init(self, handle) -> None:
        super().init(handle)
        self.seen = handle.getValueState("seen", "n long")
        self.ring = handle.getMapState("ring", "slot int", "value double")

    def handleInputRows(self, key, rows, timerValues):
        n = self.seen.get()[0] if self.seen.exists() else 0
        ring = {k[0]: v[0] for k, v in self.ring.iterator()} if n else {}
        touched = set()
        for r in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            slot = n % self.size
            ring[slot] = None if r[self.value] is None else float(r[self.value])
            touched.add(slot)
            n += 1
            if n % self.slide == 0:
                yield self.row(key, seq=n, total=float(sum(v for v in ring.values() if v is not None)), n_rows=len(ring))
        for slot in touched:
            self.ring.updateValue((slot,), (ring[slot],))
        self.seen.update((n,))


def sliding_count_window_stream(stream: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, size: int, slide: int) -> DataFrame:
    """Every ``slide`` rows of a key the sum of its last ``size``: keys, seq, total, n_rows; ``size`` values a key are kept."""
    return keyed(stream.select(*dict.fromkeys([*keys, *order, value])), keys, LastRows(keys, order, value, size, slide),
                 "seq long, total double, n_rows long")


# ---- J22: a result for every row ------------------------------------------------------------

class FirstSeen(Keyed):
    """State: whether the key (window, user) has been seen; it goes when the watermark passes the window."""

    def __init__(self, keys, order: Sequence[str], end_ms, carry: Sequence[str]):
        super().__init__(keys)
        self.order, self.end_ms, self.carry = list(order), end_ms, list(carry)

    def init(self, handle) -> None:
        super().init(handle)
        self.state = handle.getValueState("seen", "yes boolean")

    def handleInputRows(self, key, rows, timerValues):
        first = not self.state.exists()
        for r in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            if first:
                self.state.update((True,))
                self.handle.registerTimer(r[self.end_ms])
            yield self.row(key, **{c: r[c] for c in self.carry}, first_seen=first)
            first = False

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.clear()
        return iter([])


class RunningFirsts(Keyed):
    """State: distinct users of the window so far, one number; it goes when the watermark passes the window."""

    def __init__(self, keys, order: Sequence[str], end_ms, carry: Sequence[str]):
        super().__init__(keys)
        self.order, self.end_ms, self.carry = list(order), end_ms, list(carry)

    def init(self, handle) -> None:
        super().init(handle)
        self.state = handle.getValueState("users", "n long")

    def handleInputRows(self, key, rows, timerValues):
        known = self.state.exists()
        n = self.state.get()[0] if known else 0
        for r in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            if not known:
                self.handle.registerTimer(r[self.end_ms])
                known = True
            n += bool(r["first_seen"])
            yield self.row(key, **{c: r[c] for c in self.carry}, running=n)
        self.state.update((n,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.clear()
        return iter([])


def running_distinct_stream(stream: DataFrame, ts: str, row_id: str, user: str, size_s: int) -> DataFrame:
    """For every row the distinct users of its tumbling window so far: window_start, row_id, running.

    ``stream`` has a watermark on ``ts``.  Two steps, so that no state holds a
    window's users together: by (window, user) a row is its user's first or
    not, then by window the firsts are counted.  Rows count in arrival order,
    inside a micro-batch by (ts, row_id).  A null user is one user.
    """
    sec = epoch_seconds(ts)
    start = (sec - F.pmod(sec, F.lit(size_s))).cast("long")
    rows = stream.where(F.col(ts).isNotNull()).select(start.alias("window_start"), F.col(user), F.col(ts), F.col(row_id),
                                                      ((start + size_s) * 1000).alias("end_ms"))
    types = dict(rows.dtypes)
    own = [ts, row_id, "end_ms"]
    columns = ", ".join(f"{c} {types[c]}" for c in ["window_start", user, *own])
    step = FirstSeen(["window_start", user], [ts, row_id], "end_ms", own)
    flagged = rows.groupBy("window_start", user).transformWithState(
        step, columns + ", first_seen boolean", "Append", "EventTime", eventTimeColumnName=ts)
    return keyed(flagged, ["window_start"], RunningFirsts(["window_start"], [ts, row_id], "end_ms", [row_id]),
                 f"{row_id} {types[row_id]}, running long", time_mode="EventTime")


# ---- J17: windows closed by the wall clock ---------------------------------------------------

class WallClockWindows(Keyed):
    """State: count and sum of each open window; a processing-time timer at its end plus the delay."""

    def __init__(self, keys, ts: str, value: str, size_ms: int, delay_ms: int):
        super().__init__(keys)
        self.ts, self.value, self.size, self.delay = ts, value, size_ms, delay_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.windows = handle.getMapState("windows", "start long", "cnt long, total double")

    def _out(self, key, start, kind, cnt, total) -> Row:
        return self.row(key, window_start=start // 1000, window_end=(start + self.size) // 1000, kind=kind, cnt=cnt, total=total)

    def handleInputRows(self, key, rows, timerValues):
        mark = timerValues.getCurrentProcessingTimeInMs() - self.delay
        for r in rows:
            t = micros(r[self.ts]) // 1000
            start, value = t - t % self.size, float(r[self.value] or 0.0)
            if start + self.size <= mark:
                yield self._out(key, start, "late", 1, value)
                continue
            known = self.windows.containsKey((start,))
            cnt, total = self.windows.getValue((start,)) if known else (0, 0.0)
            self.windows.updateValue((start,), (cnt + 1, total + value))
            if not known:
                self.handle.registerTimer(start + self.size + self.delay)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        start = expiredTimerInfo.getExpiryTimeInMs() - self.delay - self.size
        if self.windows.containsKey((start,)):
            cnt, total = self.windows.getValue((start,))
            self.windows.removeKey((start,))
            yield self._out(key, start, "fired", cnt, total)


def wall_clock_windows(stream: DataFrame, keys: Sequence[str], ts: str, value: str, size_s: int, delay_s: int = 0) -> DataFrame:
    """Event-time windows under a watermark of now minus ``delay_s``.

    A window comes out once the clock passes its end by the delay, also when
    no further row arrives; rows whose window is past that come out as
    ``late``.  Result: keys, window_start, window_end, kind, cnt, total.
    """
    return keyed(stream.where(F.col(ts).isNotNull()).select(*keys, ts, value), keys,
                 WallClockWindows(keys, ts, value, 1000 * size_s, 1000 * delay_s),
                 "window_start long, window_end long, kind string, cnt long, total double", time_mode="ProcessingTime")


# ---- K02, K08: processing-time timers ----------------------------------------------------------

class IdleTimeout(Keyed):
    """State: running sum, rows and the time of the pending timer, which each batch of the key moves."""

    def __init__(self, keys, value: str, timeout_ms: int):
        super().__init__(keys)
        self.value, self.timeout = value, timeout_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.state = handle.getValueState("running", "total double, cnt long, timer long")

    def handleInputRows(self, key, rows, timerValues):
        total, cnt = 0.0, 0
        if self.state.exists():
            total, cnt, timer = self.state.get()
            self.handle.deleteTimer(timer)
        for r in rows:
            total, cnt = total + float(r[self.value] or 0.0), cnt + 1
            yield self.row(key, total=total, cnt=cnt, timed_out=False)
        timer = timerValues.getCurrentProcessingTimeInMs() + self.timeout
        self.handle.registerTimer(timer)
        self.state.update((total, cnt, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            total, cnt, timer = self.state.get()
            if timer <= expiredTimerInfo.getExpiryTimeInMs():
                self.state.clear()
                yield self.row(key, total=total, cnt=cnt, timed_out=True)


def map_with_timeout(stream: DataFrame, keys: Sequence[str], value: str, timeout_s: float = 30) -> DataFrame:
    """The running total of a key after every row; a key idle for ``timeout_s`` comes out once more with
    ``timed_out``, and its state goes.  Result: keys, total, cnt, timed_out."""
    return keyed(stream.select(*keys, value), keys, IdleTimeout(keys, value, int(1000 * timeout_s)),
                 "total double, cnt long, timed_out boolean", time_mode="ProcessingTime")


class Heartbeat(Keyed):
    """State: rows so far, firings, and firings since the last row; the timer's handler arms the next one."""

    def __init__(self, keys, every_ms: int, idle: int):
        super().__init__(keys)
        self.every, self.idle = every_ms, idle

    def init(self, handle) -> None:
        super().init(handle)
        self.state = handle.getValueState("beats", "cnt long, firing long, quiet long")

    def handleInputRows(self, key, rows, timerValues):
        n = sum(1 for _ in rows)
        if self.state.exists():
            cnt, firing, _ = self.state.get()
            self.state.update((cnt + n, firing, 0))
        else:
            self.state.update((n, 0, 0))
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        cnt, firing, quiet = self.state.get()
        yield self.row(key, firing=firing + 1, cnt=cnt)
        if quiet + 1 >= self.idle:
            self.state.clear()
        else:
            self.state.update((cnt, firing + 1, quiet + 1))
            self.handle.registerTimer(max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentProcessingTimeInMs()) + self.every)


def heartbeat(stream: DataFrame, keys: Sequence[str], every_s: float, idle: int = 10) -> DataFrame:
    """Every ``every_s`` seconds of the clock the rows of a key so far, whether or not rows arrive; after ``idle``
    firings without a row the key's state goes.  Result: keys, firing, cnt."""
    return keyed(stream.select(*keys), keys, Heartbeat(keys, int(1000 * every_s), idle), "firing long, cnt long", time_mode="ProcessingTime")


# ---- C12: one-to-one join -----------------------------------------------------------------------

class TypedOneToOne(Keyed):
    """State: for each side the row that waits, as a struct of its own types, with its event time.

    A row that no partner took goes out when the watermark passes its time
    plus ``wait_ms``, or when another row of its side takes its place.
    """

    def __init__(self, keys, ts: str, wait_ms: int, left: T.StructType, right: T.StructType):
        super().__init__(keys)
        self.ts, self.wait, self.types = ts, wait_ms, {"left": left, "right": right}

    def init(self, handle) -> None:
        super().init(handle)
        due = T.StructField("_due", T.LongType())
        self.waiting = {side: handle.getValueState(side, T.StructType([due, *self.types[side].fields])) for side in self.types}

    def _alone(self, key, side, values) -> Row:
        return self.row(key, kind=f"{side}_only", left=tuple(values) if side == "left" else None, right=tuple(values) if side == "right" else None)

    def handleInputRows(self, key, rows, timerValues):
        for r in sorted(rows, key=lambda r: (r[self.ts], r["side"])):
            side = r["side"]
            other = "right" if side == "left" else "left"
            own, partner = self.waiting[side], self.waiting[other]
            values = tuple(r[side][c] for c in self.types[side].names)
            if partner.exists():
                theirs = tuple(partner.get())[1:]
                partner.clear()
                yield self.row(key, kind="match", left=values if side == "left" else theirs, right=theirs if side == "left" else values)
                continue
            if own.exists():
                yield self._alone(key, side, tuple(own.get())[1:])
            due = micros(r[self.ts]) // 1000 + self.wait
            own.update((due, *values))
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        for side, state in self.waiting.items():
            if state.exists():
                due, *values = state.get()
                if due <= expiredTimerInfo.getExpiryTimeInMs():
                    state.clear()
                    yield self._alone(key, side, values)


def one_to_one_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, delay_s: int, wait_s: int) -> DataFrame:
    """Each row of ``left`` meets at most one of ``right`` with the same keys, in event-time order.

    Result: keys, kind (match, left_only or right_only), and ``left`` and
    ``right`` as structs of all other columns (the event time included) with
    their own types.  A row unmatched ``wait_s`` after its time comes out once,
    alone, as does one whose place another row of its side takes.  Rows with a
    null key or time take no part.
    """
    whole = F.lit(True)
    for c in [*keys, ts]:
        whole = whole & F.col(c).isNotNull()
    fields = {side: T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in keys])
              for side, df in (("left", left), ("right", right))}

    def tagged(df: DataFrame, side: str) -> DataFrame:
        cols = {s: F.struct(*[F.col(n) for n in fields[s].names]).cast(fields[s]) if s == side else F.lit(None).cast(fields[s]) for s in fields}
        return df.where(whole).select(*keys, ts, F.lit(side).alias("side"), *[cols[s].alias(s) for s in fields])
    both = tagged(left, "left").unionByName(tagged(right, "right")).withWatermark(ts, f"{delay_s} seconds")
    return keyed(both, keys, TypedOneToOne(keys, ts, 1000 * wait_s, fields["left"], fields["right"]),
                 f"kind string, left {fields['left'].simpleString()}, right {fields['right'].simpleString()}", time_mode="EventTime")


# ---- K02: the state of a query as a table ---------------------------------------------------------

def state_rows(spark: SparkSession, checkpoint: str, variable: str, operator: int = 0) -> DataFrame:
    """All keys' state of a ``transformWithState`` query as of its last committed batch, read from its checkpoint.

    ``variable`` names the state; value state gives (key, value), map state
    one row for each entry.  The query need not be running.
    """
    return (spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
            .option("stateVarName", variable).load())
