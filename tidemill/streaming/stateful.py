"""Keyed state machines on ``transformWithState`` (survey 2.11 and N04).

Each class is a ``StatefulProcessor`` for
``df.groupBy(key).transformWithState(proc, schema, mode, timeMode)``; the
helpers below wire the common cases.  State lives in the RocksDB state
store under the query's checkpoint, so it survives restarts and lost
executors.  Rows of one key inside a micro-batch are processed in event
time order; every state here is bounded per key.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemill.session import ship_package


def _ms(ts) -> int:
    """Epoch milliseconds of a Python datetime (UTC session) or a number."""
    if isinstance(ts, (int, float)):
        return int(ts)
    import calendar
    return calendar.timegm(ts.utctimetuple()) * 1000 + ts.microsecond // 1000


def _us(ts) -> int:
    """Epoch microseconds of a Python datetime (UTC session); a number is milliseconds."""
    if isinstance(ts, (int, float)):
        return int(ts * 1000)
    import calendar
    return calendar.timegm(ts.utctimetuple()) * 1_000_000 + ts.microsecond


class NextTimer:
    """One event-time timer a key, at the next time something is due."""

    def __init__(self, handle):
        self.handle, self.state = handle, handle.getValueState("next_timer", "at long")

    def arm(self, due_ms: int) -> None:
        """Fire at ``due_ms`` or earlier."""
        armed = self.state.get()[0] if self.state.exists() else None
        if armed is None or due_ms < armed:
            if armed is not None:
                self.handle.deleteTimer(armed)
            self.handle.registerTimer(due_ms)
            self.state.update((due_ms,))

    def fired(self) -> None:
        self.state.clear()


def _key(key):
    return key[0] if isinstance(key, tuple) and len(key) == 1 else key


class SessionByTimer(StatefulProcessor):
    """Sessions from state (count, first and last time) and an
    event-time timer at last seen + gap.  A gap inside one batch closes the
    session at once; otherwise the timer closes it.
    Output: key, session_start_ms, session_end_ms (last + gap), cnt."""

    def __init__(self, ts_col: str, gap_ms: int):
        self.ts_col, self.gap_ms = ts_col, gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("session", "cnt long, first_ms long, last_ms long")

    def _emit(self, key, s):
        return Row(key=_key(key), session_start_ms=s[1], session_end_ms=s[2] + self.gap_ms, cnt=s[0])

    def handleInputRows(self, key, rows, timerValues):
        times = sorted(_ms(r[self.ts_col]) for r in rows)
        s = self.state.get() if self.state.exists() else None
        if s is not None:
            self.handle.deleteTimer(s[2] + self.gap_ms)
        for t in times:
            if s is not None and t >= s[2] + self.gap_ms:
                yield self._emit(key, s)
                s = None
            if s is not None and t + self.gap_ms <= s[1]:  # late, and too early for the open session
                yield self._emit(key, (1, t, t))
                continue
            s = (1, t, t) if s is None else (s[0] + 1, min(s[1], t), max(s[2], t))
        self.state.update(s)
        self.handle.registerTimer(s[2] + self.gap_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            s = self.state.get()
            self.state.clear()
            yield self._emit(key, s)

    def close(self) -> None:
        pass


class CountWindow(StatefulProcessor):
    """Every ``n`` rows of a key fire (count, sum, mean) and the
    state resets; ``ttl_ms`` expires an idle partial group (K03's 10 s)."""

    def __init__(self, value_col: str, n: int, ts_col: str | None = None, ttl_ms: int | None = None):
        self.value_col, self.n, self.ts_col, self.ttl_ms = value_col, n, ts_col, ttl_ms

    def init(self, handle):
        self.state = handle.getValueState("acc", "cnt long, total double", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        rows = list(rows)
        if self.ts_col:
            rows.sort(key=lambda r: _ms(r[self.ts_col]))
        cnt, total = (self.state.get()[0], self.state.get()[1]) if self.state.exists() else (0, 0.0)
        for r in rows:
            cnt += 1
            total += float(r[self.value_col])
            if cnt == self.n:
                yield Row(key=_key(key), cnt=cnt, total=total, mean=total / cnt)
                cnt, total = 0, 0.0
        if cnt:
            self.state.update((cnt, total))
        else:
            self.state.clear()

    def close(self):
        pass


class RunningValue(StatefulProcessor):
    """A running value per key, one output per row.

    ``mode`` is ``sum`` (reducing state) or ``text`` (aggregating state:
    "content: a and b").  ``initialState`` rows (key, value) seed the state
    (K02's hadoop 100, flink 20); ``ttl_ms`` drops a key idle that long
    (K02's 30 s timeout)."""

    def __init__(self, value_col: str, mode: str = "sum", order_col: str | None = None, ttl_ms: int | None = None,
                 prefix: str = "content: ", sep: str = " and "):
        self.value_col, self.mode, self.order_col, self.ttl_ms = value_col, mode, order_col, ttl_ms
        self.prefix, self.sep = prefix, sep

    def init(self, handle):
        schema = "total double" if self.mode == "sum" else "text string"
        self.state = handle.getValueState("running", schema, self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues):
        v = initialState[self.value_col]
        self.state.update((float(v),) if self.mode == "sum" else (str(v),))

    def handleInputRows(self, key, rows, timerValues):
        rows = list(rows)
        if self.order_col:
            rows.sort(key=lambda r: r[self.order_col])
        cur = self.state.get()[0] if self.state.exists() else None
        for r in rows:
            v = r[self.value_col]
            if self.mode == "sum":
                cur = (cur or 0.0) + float(v)
                yield Row(key=_key(key), value=str(cur), order=r[self.order_col] if self.order_col else None)
            else:
                cur = str(v) if cur is None else cur + self.sep + str(v)
                yield Row(key=_key(key), value=self.prefix + cur, order=r[self.order_col] if self.order_col else None)
        if cur is not None:
            self.state.update((cur,))

    def close(self):
        pass


class TopNPerWindow(StatefulProcessor):
    """K06 with E01: keyed by window end, keeps the best ``n`` (count desc,
    item asc) in list state (so state stays bounded), and emits them
    when the event-time timer at the window end fires."""

    def __init__(self, n: int, window_end_col: str = "window_end", item_col: str = "item", cnt_col: str = "cnt"):
        self.n, self.window_end_col, self.item_col, self.cnt_col = n, window_end_col, item_col, cnt_col

    def init(self, handle):
        self.handle = handle
        self.best = handle.getListState("best", "item string, cnt long")

    def handleInputRows(self, key, rows, timerValues):
        cur = {r[0]: r[1] for r in self.best.get()} if self.best.exists() else {}
        end_ms = None
        for r in rows:
            cur[str(r[self.item_col])] = max(cur.get(str(r[self.item_col]), 0), int(r[self.cnt_col]))
            end_ms = int(r[self.window_end_col]) * 1000
        top = sorted(cur.items(), key=lambda kv: (-kv[1], kv[0]))[: self.n]
        self.best.put(top)
        if end_ms is not None:
            self.handle.registerTimer(end_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        rows = sorted(((r[0], r[1]) for r in self.best.get()), key=lambda kv: (-kv[1], kv[0])) if self.best.exists() else []
        self.best.clear()
        for i, (item, cnt) in enumerate(rows):
            yield Row(window_end=_key(key), item=item, cnt=cnt, rn=i + 1)

    def close(self):
        pass


class DailyCap(StatefulProcessor):
    """K10 with K09: per key, the first ``cap`` rows of each event-time day
    pass, the next raises one alert, the rest are dropped.  Each day has its
    own count and alert flag, so late rows count in their own day.  With
    ``expire`` (event-time mode and a watermark) a day's state goes once the
    watermark has passed it.  Output rows carry ``kind``."""

    def __init__(self, ts_col: str, id_col: str, cap: int = 100, day_ms: int = 86_400_000, expire: bool = False):
        self.ts_col, self.id_col, self.cap, self.day_ms, self.expire = ts_col, id_col, cap, day_ms, expire

    def init(self, handle):
        self.handle = handle
        self.days = handle.getMapState("cap", "day long", "cnt long, alerted boolean")

    def handleInputRows(self, key, rows, timerValues):
        rows = sorted(rows, key=lambda r: (_us(r[self.ts_col]), r[self.id_col]))
        seen: dict[int, tuple[int, bool]] = {}
        for r in rows:
            d = _ms(r[self.ts_col]) // self.day_ms * self.day_ms
            if d not in seen:
                seen[d] = tuple(self.days.getValue((d,))) if self.days.containsKey((d,)) else (0, False)
            cnt, alerted = seen[d][0] + 1, seen[d][1]
            if cnt <= self.cap:
                yield Row(id=r[self.id_col], kind="pass")
            elif not alerted:
                alerted = True
                yield Row(id=r[self.id_col], kind="alert")
            seen[d] = (cnt, alerted)
        for d, state in seen.items():
            self.days.updateValue((d,), state)
            if self.expire:
                self.handle.registerTimer(d + self.day_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        day = expiredTimerInfo.getExpiryTimeInMs() - self.day_ms
        if self.days.containsKey((day,)):
            self.days.removeKey((day,))
        return iter([])

    def close(self):
        pass


class StrictSequence(StatefulProcessor):
    """``length`` adjacent rows meeting the condition, the last less
    than ``within_ms`` after the first (compared in microseconds).  List
    state keeps at most ``length - 1`` pending rows per key.

    With ``wait`` (event-time mode and a watermark) rows are held until the
    watermark passes them and then taken in event-time order, so adjacency is
    right whatever batch a row comes in; a key's run goes ``within_ms`` after
    its last row.  Held rows are read once for each batch in which some are
    due, by the key's one timer.  Without it rows must arrive in order across
    batches."""

    def __init__(self, ts_col: str, id_col: str, flag_col: str, length: int = 3, within_ms: int = 5000, wait: bool = False):
        self.ts_col, self.id_col, self.flag_col = ts_col, id_col, flag_col
        self.length, self.within_ms, self.wait = length, within_ms, wait

    def init(self, handle):
        self.handle = handle
        self.pending = handle.getListState("pending", "ts_us long, id long")
        self.held = handle.getListState("held", "ts_us long, id long, hit boolean")
        self.timer = NextTimer(handle)

    def handleInputRows(self, key, rows, timerValues):
        new = [(_us(r[self.ts_col]), r[self.id_col], bool(r[self.flag_col])) for r in rows]
        if not self.wait:
            yield from self._advance(key, new)
            return
        self.held.appendList(new)
        self.timer.arm(min(t for t, _, _ in new) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.timer.fired()
        mark = timerValues.getCurrentWatermarkInMs()
        held = [tuple(r) for r in self.held.get()] if self.held.exists() else []
        later, ready = [r for r in held if r[0] // 1000 >= mark], [r for r in held if r[0] // 1000 < mark]
        if later:
            self.held.put(later)
        else:
            self.held.clear()
        if ready:
            yield from self._advance(key, ready)
        due = [r[0] // 1000 + 1 for r in later]
        if self.pending.exists():
            over = max(r[0] for r in self.pending.get()) // 1000 + self.within_ms + 1
            if over <= mark:
                self.pending.clear()
            else:
                due.append(over)
        if due:
            self.timer.arm(min(due))

    def _advance(self, key, rows):
        run = [tuple(r) for r in self.pending.get()] if self.pending.exists() else []
        for ts, rid, hit in sorted(rows):
            if not hit:
                run = []
                continue
            run.append((ts, rid))
            if len(run) >= self.length:
                first, last = run[-self.length], run[-1]
                if last[0] - first[0] < 1000 * self.within_ms:
                    yield Row(key=_key(key), first_ms=first[0] // 1000, first_id=first[1], last_ms=last[0] // 1000, last_id=last[1])
            run = run[-(self.length - 1):]
        if run:
            self.pending.put(run)
        else:
            self.pending.clear()

    def close(self):
        pass


class NewestContext(StatefulProcessor):
    """Server rows of a key are kept, by their time, for ``max_age_ms``
    behind the watermark, client rows until it passes them; a client row is
    then put out with the newest server row at or before it, in microseconds.
    Of server rows at one instant the one with the largest columns counts and
    is kept.  The key's one timer fires when the next row is due."""

    def __init__(self, ts_col: str, max_age_ms: int, payload: Sequence[str], carry: Sequence[str], own_type, ctx_type):
        self.ts_col, self.max_age_ms = ts_col, max_age_ms
        self.payload, self.carry, self.own_type, self.ctx_type = list(payload), list(carry), own_type, ctx_type

    def init(self, handle):
        self.handle = handle
        time = T.StructField("ts_us", T.LongType())
        self.servers = handle.getMapState("servers", T.StructType([time]), self.ctx_type)
        self.clients = handle.getListState("clients", T.StructType([time, *self.own_type.fields]))
        self.timer = NextTimer(handle)

    def handleInputRows(self, key, rows, timerValues):
        due, new = [], []
        for r in rows:
            t = _us(r[self.ts_col])
            if r["side"] == "server":
                ctx = tuple(r["ctx"][c] for c in self.carry)
                if self.servers.containsKey((t,)):
                    ctx = max(ctx, tuple(self.servers.getValue((t,))), key=_nulls_first)
                self.servers.updateValue((t,), ctx)
                due.append(t // 1000 + self.max_age_ms + 1)
            else:
                new.append((t, *[r["own"][c] for c in self.payload]))
                due.append(t // 1000 + 1)
        if new:
            self.clients.appendList(new)
        self.timer.arm(min(due))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.timer.fired()
        mark = timerValues.getCurrentWatermarkInMs()
        servers = {k[0]: tuple(v) for k, v in self.servers.iterator()}
        times, waiting = sorted(servers), []
        for c in (tuple(r) for r in self.clients.get()) if self.clients.exists() else []:
            if c[0] // 1000 >= mark:
                waiting.append(c)
                continue
            at = bisect_right(times, c[0]) - 1
            found = times[at] if at >= 0 and times[at] >= c[0] - 1000 * self.max_age_ms else None
            ctx = (None,) * len(self.carry) if found is None else servers[found]
            yield Row(**dict(zip(self.payload, c[1:])), ctx_ts=None if found is None else found // 1_000_000,
                      **{f"ctx_{n}": v for n, v in zip(self.carry, ctx)})
        if waiting:
            self.clients.put(waiting)
        else:
            self.clients.clear()
        due = [c[0] // 1000 + 1 for c in waiting]
        for t in times:
            if t // 1000 + self.max_age_ms < mark:
                self.servers.removeKey((t,))
            else:
                due.append(t // 1000 + self.max_age_ms + 1)
                break  # times ascend
        if due:
            self.timer.arm(min(due))

    def close(self):
        pass


def _nulls_first(row: tuple) -> tuple:
    return tuple((v is not None, v) for v in row)


class OneToOneJoin(StatefulProcessor):
    """Two tagged inputs on one key; each side waits in its own value
    state, a match is emitted and clears the partner, and a second
    unmatched row of a side replaces the first."""

    def __init__(self, side_col: str, left_cols: Sequence[str], right_cols: Sequence[str]):
        self.side_col, self.left_cols, self.right_cols = side_col, list(left_cols), list(right_cols)

    def init(self, handle):
        self.left = handle.getValueState("left", ", ".join(f"{c} string" for c in self.left_cols))
        self.right = handle.getValueState("right", ", ".join(f"{c} string" for c in self.right_cols))

    def handleInputRows(self, key, rows, timerValues):
        for r in rows:
            if r[self.side_col] == "left":
                lv = tuple(None if r[c] is None else str(r[c]) for c in self.left_cols)
                if self.right.exists():
                    rv = tuple(self.right.get())
                    self.right.clear()
                    yield Row(key=_key(key), left=",".join(map(str, lv)), right=",".join(map(str, rv)))
                else:
                    self.left.update(lv)
            else:
                rv = tuple(None if r[c] is None else str(r[c]) for c in self.right_cols)
                if self.left.exists():
                    lv = tuple(self.left.get())
                    self.left.clear()
                    yield Row(key=_key(key), left=",".join(map(str, lv)), right=",".join(map(str, rv)))
                else:
                    self.right.update(rv)

    def close(self):
        pass


def apply(stream: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema: str,
          mode: str = "Append", time_mode: str = "None", initial_state=None) -> DataFrame:
    """Group a stream by ``keys`` and run ``processor`` on it.  State with a
    TTL (K02, K03) needs ``time_mode="ProcessingTime"``; event-time timers
    (J08, K06) need ``"EventTime"`` and a watermark on the input."""
    ship_package(stream.sparkSession)
    return stream.groupBy(*keys).transformWithState(processor, schema, mode, time_mode, initialState=initial_state)
