"""Stateful processors (``transformWithState``) and reading of stored state.

Each processor is the streaming twin of a batch operator. Rows of a micro-batch
are taken in event-time order inside a key, state per key is the open part only,
and timers run on the watermark. Times travel as microseconds in ``us``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from heapq import nsmallest
from operator import itemgetter

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weirworks.functions.expr import floor_to, interval_us, micros


def read_state(spark: SparkSession, checkpoint: str, variable: str | None = None, operator: int = 0) -> DataFrame:
    """Keyed state of a finished or stopped query: columns ``key``, ``value`` and ``partition_id``."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if variable:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)


def list_state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    return spark.read.format("state-metadata").load(checkpoint)


def ceil_ms(us: int) -> int:
    """Timers have millisecond steps; rounding up never fires early."""
    return -(-us // 1000)


class KeyedProcessor(StatefulProcessor):
    """One value state per key. Subclasses give ``STATE`` and ``on_row``; ``on_timer`` where they set timers."""

    STATE = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.STATE)

    def current(self):
        return self.state.get()  # None where there is none

    def arm(self, old_us: int | None, new_us: int | None) -> None:
        """Replace a pending timer."""
        if old_us is not None:
            self.handle.deleteTimer(ceil_ms(old_us))
        if new_us is not None:
            self.handle.registerTimer(ceil_ms(new_us))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in sorted(rows, key=self.order):
            yield from self.on_row(key, row)

    def order(self, row):
        return row.us, row.tie

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.on_timer(key, expiredTimerInfo.getExpiryTimeInMs())

    def on_row(self, key, row) -> Iterator[Row]:
        raise NotImplementedError

    def on_timer(self, key, at_ms: int) -> Iterator[Row]:
        return iter(())

    def close(self) -> None:
        pass


def with_order(df: DataFrame, ts: str, tie: str) -> DataFrame:
    return df.withColumn("us", micros(ts)).withColumn("tie", F.col(tie).cast("bigint"))


def run_keyed(df: DataFrame, keys: Sequence[str], processor: StatefulProcessor, output: str, mode: str = "Append",
              timers: bool = False, seed: DataFrame | None = None) -> DataFrame:
    key_types = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=f"{key_types}, {output}", outputMode=mode,
        timeMode="EventTime" if timers else "None", initialState=seed.groupBy(*keys) if seed is not None else None)


class AccountTotals(KeyedProcessor):
    """Count and sum per account, continued from the seeded state."""

    STATE = "n BIGINT, total BIGINT"

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((initialState.n, initialState.total))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n, total = self.current() or (0, 0)
        for row in rows:
            n, total = n + 1, total + row.amount
        self.state.update((n, total))
        yield Row(account=key[0], n=n, total=total)


def account_totals(rows: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    return run_keyed(rows, ["account"], AccountTotals(), "n BIGINT, total BIGINT", "Update", seed=seed)


class PairMatcher(KeyedProcessor):
    """Emits when the key's previous and current action are the pair in force (column ``pair``)."""

    STATE = "action STRING"

    def on_row(self, key, row) -> Iterator[Row]:
        before = self.current()
        self.state.update((row.action,))
        if before and row.pair == f"{before[0]},{row.action}":
            yield Row(user_id=key[0], event_id=row.tie, first_action=before[0], second_action=row.action)


def pair_matches(df: DataFrame, ts: str, tie: str, action: str, pair) -> DataFrame:
    rows = with_order(df, ts, tie).select("user_id", "us", "tie", F.col(action).alias("action"), pair.alias("pair"))
    return run_keyed(rows, ["user_id"], PairMatcher(), "event_id BIGINT, first_action STRING, second_action STRING")


class PathCounter(KeyedProcessor):
    """Counts a user's events up to the closing one; emits paths longer than the limit in force (column ``max_length``)."""

    STATE = "length BIGINT"

    def __init__(self, end_kind: str):
        self.end_kind = end_kind

    def on_row(self, key, row) -> Iterator[Row]:
        length = (self.current() or (0,))[0] + 1
        if row.kind != self.end_kind:
            self.state.update((length,))
            return
        self.state.clear()
        if length > row.max_length:
            yield Row(user_id=key[0], end_us=row.us, path_length=length)


def long_paths(df: DataFrame, ts: str, tie: str, kind: str, end_kind: str, max_length) -> DataFrame:
    rows = with_order(df, ts, tie).select("user_id", "us", "tie", F.col(kind).alias("kind"), max_length.alias("max_length"))
    return run_keyed(rows, ["user_id"], PathCounter(end_kind), "end_us BIGINT, path_length BIGINT")


class OfflineAlarm(KeyedProcessor):
    """An offline message arms a repeating timer; the key's next message stops or re-arms it."""

    STATE = "due_us BIGINT"

    def __init__(self, period_us: int):
        self.period_us = period_us

    def _due_before(self, limit_us: int) -> Iterator[int]:
        """Alert times that passed before ``limit_us`` though the watermark has not reached them."""
        due = self.current()
        due_us = due[0] if due else None
        while due_us is not None and due_us < limit_us:
            yield due_us
            due_us += self.period_us

    def on_row(self, key, row) -> Iterator[Row]:
        for due_us in self._due_before(row.us):
            yield Row(user_id=key[0], alert_us=due_us)
        armed = self.current()
        due_us = row.us + self.period_us if row.offline else None
        self.arm(armed[0] if armed else None, due_us)
        if due_us is None:
            self.state.clear()
        else:
            self.state.update((due_us,))

    def on_timer(self, key, at_ms: int) -> Iterator[Row]:
        armed = self.current()
        if armed and ceil_ms(armed[0]) == at_ms:
            yield Row(user_id=key[0], alert_us=armed[0])
            self.state.update((armed[0] + self.period_us,))
            self.arm(None, armed[0] + self.period_us)


def offline_alerts(df: DataFrame, ts: str, tie: str, offline, period: str) -> DataFrame:
    rows = with_order(df, ts, tie).select("user_id", ts, "us", "tie", offline.alias("offline"))
    return run_keyed(rows, ["user_id"], OfflineAlarm(interval_us(period)), "alert_us BIGINT", timers=True)


class MatchOrTimeout(KeyedProcessor):
    """Left rows (``kind`` 0, with ``wait_us``) wait for the first right row (``kind`` 1) until their deadline.

    Several left rows of a key may wait at once; each has its own deadline.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "start_us BIGINT, deadline_us BIGINT")

    def order(self, row):
        return row.us, row.kind

    def _waiting(self) -> list[tuple[int, int]]:
        return [(w[0], w[1]) for w in self.waiting.get()] if self.waiting.exists() else []

    def _keep(self, left: list[tuple[int, int]]) -> None:
        if left:
            self.waiting.put(left)
        else:
            self.waiting.clear()

    def on_row(self, key, row) -> Iterator[Row]:
        if row.kind == 0:
            self.waiting.appendValue((row.us, row.us + row.wait_us))
            self.arm(None, row.us + row.wait_us)
            return
        waiting = self._waiting()
        left = [w for w in waiting if not w[0] <= row.us <= w[1]]
        if len(left) < len(waiting):
            self._keep(left)
            pending = {ceil_ms(d) for _, d in left}
            for due in {d for _, d in waiting if ceil_ms(d) not in pending}:
                self.arm(due, None)
        for _ in range(len(waiting) - len(left)):
            yield Row(order_key=key[0], status="on_time", event_us=row.us)

    def on_timer(self, key, at_ms: int) -> Iterator[Row]:
        waiting = self._waiting()
        over = [d for _, d in waiting if ceil_ms(d) == at_ms]
        if over:
            self._keep([w for w in waiting if ceil_ms(w[1]) != at_ms])
        for due in over:
            yield Row(order_key=key[0], status="timeout", event_us=due)


def match_or_timeout(df: DataFrame) -> DataFrame:
    """``df``: tagged union with order_key, a watermarked time, us, kind and wait_us."""
    return run_keyed(df, ["order_key"], MatchOrTimeout(), "status STRING, event_us BIGINT", timers=True)


class BoundedSession(KeyedProcessor):
    """Gap sessions that stay below a total length; emitted when closed."""

    STATE = "start_us BIGINT, last_us BIGINT, n BIGINT, top DOUBLE"

    def __init__(self, gap_us: int, bound_us: int):
        self.gap_us, self.bound_us = gap_us, bound_us

    def _closed(self, key, s) -> Row:
        return Row(user_id=key[0], start_us=s[0], end_us=s[1] + self.gap_us, n=s[2], top=s[3])

    def on_row(self, key, row) -> Iterator[Row]:
        s = self.current()
        if s and row.us - s[1] <= self.gap_us and row.us + self.gap_us - s[0] < self.bound_us:
            new = (s[0], row.us, s[2] + 1, max(s[3], row.value))
        else:
            if s:
                yield self._closed(key, s)
            new = (row.us, row.us, 1, row.value)
        self.arm(s[1] + self.gap_us + 1 if s else None, row.us + self.gap_us + 1)
        self.state.update(new)

    def on_timer(self, key, at_ms: int) -> Iterator[Row]:
        s = self.current()
        if s and ceil_ms(s[1] + self.gap_us + 1) == at_ms:
            self.state.clear()
            yield self._closed(key, s)


def bounded_sessions(df: DataFrame, ts: str, tie: str, value: str, gap: str, bound: str) -> DataFrame:
    rows = with_order(df, ts, tie).select("user_id", ts, "us", "tie", F.col(value).alias("value"))
    return run_keyed(rows, ["user_id"], BoundedSession(interval_us(gap), interval_us(bound)), "start_us BIGINT, end_us BIGINT, n BIGINT, top DOUBLE", timers=True)


class RunningTop(KeyedProcessor):
    """Current top N of an area after each micro-batch. Totals must not fall.

    Totals live in map state, one entry per item; the top list needs only the
    old list and the items of the batch.
    """

    STATE = "items ARRAY<BIGINT>, totals ARRAY<DOUBLE>"

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.totals = handle.getMapState("totals", "item BIGINT", "total DOUBLE")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        added: dict[int, float] = {}
        for row in rows:
            added[row.item] = added.get(row.item, 0.0) + row.amount
        top = self.current()
        best = dict(zip(top[0], top[1])) if top else {}
        for item, amount in added.items():
            total = amount + (self.totals.getValue((item,))[0] if self.totals.containsKey((item,)) else 0.0)
            self.totals.updateValue((item,), (total,))
            best[item] = total
        ranked = sorted(best.items(), key=lambda e: (-e[1], e[0]))[: self.n]
        self.state.update(([i for i, _ in ranked], [t for _, t in ranked]))
        for rank, (item, total) in enumerate(ranked, 1):
            yield Row(area=key[0], rank=rank, item=item, total=total)


def running_top(df: DataFrame, n: int) -> DataFrame:
    """``df``: area, item, amount. Amounts are summed per (area, item) where they arrive by the state itself."""
    return run_keyed(df, ["area"], RunningTop(n), "rank INT, item BIGINT, total DOUBLE", "Update")


class RateConverter(KeyedProcessor):
    """Rates (``kind`` 0) and payments (``kind`` 1) of a key: each payment takes the latest rate.

    With ``wait`` a payment before any rate is kept until the first one comes, else it is dropped.
    """

    STATE = "rate DOUBLE"

    def __init__(self, wait: bool):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getListState("waiting", "payment_id BIGINT, us BIGINT, amount DOUBLE")

    def order(self, row):
        return row.us, row.kind, row.tie

    def on_row(self, key, row) -> Iterator[Row]:
        rate = self.current()
        if row.kind == 0:
            self.state.update((row.value,))
            if rate is None and self.waiting.exists():
                for payment_id, _, amount in self.waiting.get():
                    yield Row(user_id=key[0], payment_id=payment_id, amount=amount, rate=row.value, emitted_us=row.us)
                self.waiting.clear()
        elif rate is not None:
            yield Row(user_id=key[0], payment_id=row.tie, amount=row.value, rate=rate[0], emitted_us=row.us)
        elif self.wait:
            self.waiting.appendValue((row.tie, row.us, row.value))


def converted(df: DataFrame, ts: str, tie: str, kind, value: str, wait: bool) -> DataFrame:
    rows = with_order(df, ts, tie).select("user_id", "us", "tie", kind.alias("kind"), F.col(value).alias("value"))
    return run_keyed(rows, ["user_id"], RateConverter(wait), "payment_id BIGINT, amount DOUBLE, rate DOUBLE, emitted_us BIGINT")


class LiveCount(KeyedProcessor):
    """Count of the key's rows of the last ``ttl``: emitted at each arrival and each expiry."""

    STATE = "n BIGINT"

    def __init__(self, ttl_us: int):
        self.ttl_us = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.expiries = handle.getMapState("expiries", "at_ms BIGINT", "us ARRAY<BIGINT>")

    def _expire(self, key, n: int, limit_us: int) -> tuple[list[Row], int]:
        """Expiries up to ``limit_us``, oldest first."""
        out = []
        due = sorted(k[0] for k in self.expiries.keys() if k[0] <= ceil_ms(limit_us))
        for at_ms in due:
            left = []
            for us in sorted(self.expiries.getValue((at_ms,))[0]):
                if us <= limit_us:
                    n -= 1
                    out.append(Row(user_id=key[0], at_us=us, kind="expire", live=n))
                else:
                    left.append(us)
            if left:
                self.expiries.updateValue((at_ms,), (left,))
            else:
                self.expiries.removeKey((at_ms,))
                self.handle.deleteTimer(at_ms)
        return out, n

    def on_row(self, key, row) -> Iterator[Row]:
        n = (self.current() or (0,))[0]
        expired, n = self._expire(key, n, row.us)
        yield from expired
        n += 1
        end_us = row.us + self.ttl_us
        at_ms = ceil_ms(end_us)
        same = list(self.expiries.getValue((at_ms,))[0]) if self.expiries.containsKey((at_ms,)) else []
        self.expiries.updateValue((at_ms,), (same + [end_us],))
        self.handle.registerTimer(at_ms)
        self.state.update((n,))
        yield Row(user_id=key[0], at_us=row.us, kind="arrive", live=n)

    def on_timer(self, key, at_ms: int) -> Iterator[Row]:
        expired, n = self._expire(key, (self.current() or (0,))[0], at_ms * 1000)
        self.state.update((n,))
        yield from expired


def live_counts(df: DataFrame, ts: str, tie: str, ttl: str) -> DataFrame:
    rows = with_order(df, ts, tie).select("user_id", ts, "us", "tie")
    return run_keyed(rows, ["user_id"], LiveCount(interval_us(ttl)), "at_us BIGINT, kind STRING, live BIGINT", timers=True)


class SilenceCount(KeyedProcessor):
    """Count per key, emitted after ``silence`` without a row; each row re-arms the timer."""

    STATE = "n BIGINT, due_us BIGINT"

    def __init__(self, silence_us: int):
        self.silence_us = silence_us

    def on_row(self, key, row) -> Iterator[Row]:
        n, due_us = self.current() or (0, None)
        if due_us is not None and row.us > due_us:  # the silence passed before the watermark did
            yield Row(user_id=key[0], n=n, emitted_us=due_us)
        self.arm(due_us, row.us + self.silence_us)
        self.state.update((n + 1, row.us + self.silence_us))

    def on_timer(self, key, at_ms: int) -> Iterator[Row]:
        n, due_us = self.current()
        if due_us is not None and ceil_ms(due_us) == at_ms:
            self.state.update((n, None))
            yield Row(user_id=key[0], n=n, emitted_us=due_us)


def counts_after_silence(df: DataFrame, ts: str, tie: str, silence: str) -> DataFrame:
    rows = with_order(df, ts, tie).select("user_id", ts, "us", "tie")
    return run_keyed(rows, ["user_id"], SilenceCount(interval_us(silence)), "n BIGINT, emitted_us BIGINT", timers=True)


class CountOrDelay(KeyedProcessor):
    """Batches of a key, closed at ``max_count`` rows or ``delay`` after the first."""

    STATE = "first_us BIGINT, n BIGINT, first_id BIGINT, last_id BIGINT"

    def __init__(self, max_count: int, delay_us: int):
        self.max_count, self.delay_us = max_count, delay_us

    def _close(self, key, s) -> Row:
        self.arm(s[0] + self.delay_us, None)
        self.state.clear()
        return Row(user_id=key[0], first_us=s[0], n=s[1], first_id=s[2], last_id=s[3])

    def on_row(self, key, row) -> Iterator[Row]:
        s = self.current()
        if s and row.us - s[0] >= self.delay_us:
            yield self._close(key, s)
            s = None
        if s is None:
            self.arm(None, row.us + self.delay_us)
        s = (s[0], s[1] + 1, s[2], row.tie) if s else (row.us, 1, row.tie, row.tie)
        self.state.update(s)
        if s[1] >= self.max_count:
            yield self._close(key, s)

    def on_timer(self, key, at_ms: int) -> Iterator[Row]:
        s = self.current()
        if s and ceil_ms(s[0] + self.delay_us) == at_ms:
            yield self._close(key, s)


def count_or_delay(df: DataFrame, ts: str, tie: str, max_count: int, delay: str) -> DataFrame:
    rows = with_order(df, ts, tie).select("user_id", ts, "us", "tie")
    return run_keyed(rows, ["user_id"], CountOrDelay(max_count, interval_us(delay)), "first_us BIGINT, n BIGINT, first_id BIGINT, last_id BIGINT", timers=True)


class KeepFirst(KeyedProcessor):
    """Passes a row if none of its key was passed within ``ttl`` before it; old state is dropped by a timer."""

    STATE = "kept_us BIGINT"

    def __init__(self, ttl_us: int, columns: list[str]):
        self.ttl_us, self.columns = ttl_us, columns

    def on_row(self, key, row) -> Iterator[Row]:
        kept = self.current()
        if kept is None or row.us - kept[0] >= self.ttl_us:
            self.arm(kept[0] + self.ttl_us if kept else None, row.us + self.ttl_us)
            self.state.update((row.us,))
            yield Row(**{c: row[c] for c in self.columns})

    def on_timer(self, key, at_ms: int) -> Iterator[Row]:
        kept = self.current()
        if kept and ceil_ms(kept[0] + self.ttl_us) == at_ms:
            self.state.clear()
        return iter(())


def first_per_ttl(df: DataFrame, keys: Sequence[str], ts: str, tie: str, ttl: str) -> DataFrame:
    """Whole rows, as the batch form keeps them; ``ts`` has a watermark."""
    rows = df.withColumn("us", micros(ts)).withColumn("tie", F.col(tie))
    return rows.groupBy(*keys).transformWithState(
        statefulProcessor=KeepFirst(interval_us(ttl), df.columns), outputStructType=df.schema, outputMode="Append", timeMode="EventTime")


class Changes(KeyedProcessor):
    """Emits a row when its value differs from the last emitted one; state expires after ``ttl_ms`` (0: never)."""

    STATE = "value STRING"

    def __init__(self, ttl_ms: int = 0):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.STATE, self.ttl_ms or None)

    def on_row(self, key, row) -> Iterator[Row]:
        last = self.current()
        if last is None or last[0] != row.value:
            self.state.update((row.value,))
            yield Row(user_id=key[0], event_id=row.tie, value=row.value)


def changes(df: DataFrame, ts: str, tie: str, value: str) -> DataFrame:
    rows = with_order(df, ts, tie).select("user_id", "us", "tie", F.col(value).cast("string").alias("value"))
    return run_keyed(rows, ["user_id"], Changes(), "event_id BIGINT, value STRING")


class JumpAlert(KeyedProcessor):
    """Emits rows that differ from the key's row before by more than a threshold, if that is recent enough."""

    STATE = "us BIGINT, value DOUBLE"

    def __init__(self, threshold: float, forget_us: int):
        self.threshold, self.forget_us = threshold, forget_us

    def on_row(self, key, row) -> Iterator[Row]:
        last = self.current()
        self.state.update((row.us, row.value))
        if last and row.us - last[0] <= self.forget_us and abs(row.value - last[1]) > self.threshold:
            yield Row(user_id=key[0], event_id=row.tie, value=row.value, previous_value=last[1])


def jump_alerts(df: DataFrame, ts: str, tie: str, value: str, threshold: float, forget: str) -> DataFrame:
    rows = with_order(df, ts, tie).select("user_id", "us", "tie", F.col(value).alias("value"))
    return run_keyed(rows, ["user_id"], JumpAlert(threshold, interval_us(forget)), "event_id BIGINT, value DOUBLE, previous_value DOUBLE")


class WindowTop(KeyedProcessor):
    """The top N of a window with their ranks. All counts of a window come in the micro-batch that closes it, so nothing is kept: the state is
    declared, but never called, and there are no timers."""

    STATE = "none BOOLEAN"

    def __init__(self, n: int):
        self.n = n

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = nsmallest(self.n, ((-row.view_count, row.item is None, row.item) for row in rows))  # an unknown item is one of its own
        for rank, (less, _, item) in enumerate(best, 1):
            yield Row(end_us=key[0], rank=rank, item=item, view_count=-less)


def hot_items(df: DataFrame, ts: str, item: str, size: str, slide: str, n: int) -> DataFrame:
    """Streaming twin of ``ranking.hot_items``: each window's top ``n`` once, when it closes. ``ts`` has a watermark.

    Two stateful steps: counts per window, and the window's best. A row enters all its windows, but it is added up before the shuffle, so state
    and shuffle hold one count per window, item and micro-batch; a late row still counts in those of its windows that are open.
    """
    windows = df.groupBy(F.window(ts, size, slide).alias("w"), item).agg(F.count(F.lit(1)).alias("view_count"))
    counts = windows.select(micros("w.end").alias("end_us"), F.col(item).cast("bigint").alias("item"), "view_count")
    top = run_keyed(counts, ["end_us"], WindowTop(n), "rank INT, item BIGINT, view_count BIGINT")
    return top.select(F.timestamp_micros("end_us").alias("window_end"), F.col("item").cast(df.schema[item].dataType).alias(item), "view_count", "rank")


class Panes(KeyedProcessor):
    """All results of the windows of a bucket: early ones at ticks of the watermark, one at a window's end, one per late row; then the
    window is purged.

    Windows of all keys are dealt over ``BUCKETS`` by a hash of key and start, so a key of many rows is dealt too. A bucket's open windows
    are one state value with one timer, for what is due first: calls to the state grow with buckets, not with windows or rows.

    Spark drops rows behind its watermark before they get here. So the stream's watermark runs ``slack_us`` (window size and
    lateness) behind the one meant here, and times are shifted by it: no accepted row is lost, and timers fire at the meant time.
    """

    VALUES = "counts ARRAY<BIGINT>, totals ARRAY<DOUBLE>, panes ARRAY<BIGINT>, ticks ARRAY<BIGINT>, due_ms BIGINT"
    BUCKETS = 4096
    FIRST_MARK_MS = 1  # a timer for the first watermark: ticks count from there
    UNMARKED, OVER = 0, -1  # instead of a window's next tick: opened before the first watermark; no result but late ones

    def __init__(self, size_us: int, early_us: int, late_us: int, names: Sequence[str], types: Sequence[str]):
        """``names`` and ``types`` tell a window: those of the keys, then of its start."""
        self.size_us, self.early_us, self.late_us, self.names = size_us, early_us, late_us, list(names)
        self.slack_us = size_us + late_us
        self.STATE = ", ".join(f"of_{i} ARRAY<{t}>" for i, t in enumerate(types)) + ", " + self.VALUES

    def now(self, timers) -> int:
        mark = timers.getCurrentWatermarkInMs()
        return mark * 1000 + self.slack_us if mark else 0

    def tick(self, now: int) -> int:
        return (now // self.early_us + 1) * self.early_us if now else self.UNMARKED

    def result(self, bucket, of: tuple, kind: str, at: int, window: list) -> Row:
        n, total, pane, _ = window
        return Row(bucket=bucket[0], **dict(zip(self.names, of)), fired_us=at, kind=kind, pane=pane, n=n, total=total)

    def windows(self) -> tuple[dict[tuple, list], int | None]:
        """Open windows by key and start (count, total, panes, next tick) and the pending timer."""
        held, told = self.current(), len(self.names)
        return ({w[:told]: list(w[told:]) for w in zip(*held[:-1])}, held[-1]) if held else ({}, None)

    def due_ms(self, start: int, tick: int) -> int:
        """A timer that fires when the meant watermark reaches what the window waits for: timers fire once the watermark is past them."""
        if tick == self.UNMARKED:
            return self.FIRST_MARK_MS
        end = start + self.size_us
        at = end + self.late_us if tick == self.OVER else min(tick, end)
        return (at - self.slack_us) // 1000 - 1

    def keep(self, windows: dict[tuple, list], armed: int | None, fired: int | None = None) -> None:
        due = min((self.due_ms(of[-1], w[3]) for of, w in windows.items()), default=None)
        if armed is not None and armed not in (due, fired):
            self.handle.deleteTimer(armed)
        if due is None:
            self.state.clear()
            return
        if due != armed or armed == fired:
            self.handle.registerTimer(due)
        self.state.update((*map(list, zip(*windows)), *map(list, zip(*windows.values())), due))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = self.now(timerValues)
        windows, armed = self.windows()
        for _, amount, *of in sorted((tuple(row[c] for c in ("tie", "amount", *self.names)) for row in rows), key=itemgetter(0)):
            of = tuple(of)
            end = of[-1] + self.size_us
            if now >= end + self.late_us:
                continue
            window = windows.get(of)
            if window is None:
                window = windows[of] = [0, 0.0, 0, self.OVER]
            if window[3] == self.OVER and now < end:
                window[3] = self.tick(now)
            window[0], window[1] = window[0] + 1, window[1] + amount
            if now >= end:
                window[2] += 1
                yield self.result(key, of, "late", now, window)
        if windows:
            self.keep(windows, armed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        windows, armed = self.windows()
        fired = expiredTimerInfo.getExpiryTimeInMs()
        if armed != fired:
            return
        now = self.now(timerValues)
        for of, window in list(windows.items()):
            end, tick = of[-1] + self.size_us, window[3]
            if tick != self.OVER:
                if tick != self.UNMARKED and tick < end and tick <= now:
                    window[2] += 1
                    yield self.result(key, of, "early", tick, window)
                if tick <= now:
                    window[3] = self.tick(now)
                if end <= now:
                    window[2], window[3] = window[2] + 1, self.OVER
                    yield self.result(key, of, "on_time", end, window)
            if end + self.late_us <= now:
                del windows[of]
        self.keep(windows, armed, fired)


def fired_panes(df: DataFrame, keys: Sequence[str], event_ts: str, tie: str, value: str, size: str, delay: str, early: str, lateness: str) -> DataFrame:
    """Streaming twin of ``triggers.fired_panes``: ``tie`` orders the rows of a micro-batch. Window sizes are whole milliseconds."""
    size_us, late_us, delay_us = (interval_us(x) for x in (size, lateness, delay))
    behind = df.filter(F.col(event_ts).isNotNull()).withWatermark(event_ts, f"{(delay_us + size_us + late_us) // 1000} milliseconds")
    start = floor_to(micros(event_ts), size_us)
    names = [*keys, "start_us"]
    rows = behind.select(*keys, start.alias("start_us"), event_ts, F.col(tie).alias("tie"), F.col(value).cast("double").alias("amount"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*names), F.lit(Panes.BUCKETS)).cast("int"))
    types = [rows.schema[c].dataType.simpleString() for c in names]
    panes = Panes(size_us, interval_us(early), late_us, names, types)
    shown = ", ".join(f"{c} {t}" for c, t in zip(names, types))
    out = run_keyed(rows, ["bucket"], panes, f"{shown}, fired_us BIGINT, kind STRING, pane BIGINT, n BIGINT, total DOUBLE", timers=True)
    return out.select(*keys, F.timestamp_micros("start_us").alias("window_start"), F.timestamp_micros("fired_us").alias("fired_at"), "kind", "pane", "n", "total")


class BatchOrInterval(KeyedProcessor):
    """A sink's buffer per shard: flushed at ``size`` rows, or ``interval`` after its first row by the clock. The buffer is list state, so
    a restart goes on with it; flushed rows carry their chunk's number and the reason."""

    STATE = "chunk BIGINT, n BIGINT, due_ms BIGINT"

    def __init__(self, size: int, interval_ms: int, columns: Sequence[str], buffered: str):
        self.size, self.interval_ms, self.columns, self.buffered = size, interval_ms, list(columns), buffered

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.rows = handle.getListState("rows", self.buffered)

    def _flush(self, key, chunk: int, reason: str) -> Iterator[Row]:
        for held in self.rows.get():
            yield Row(shard=key[0], chunk=chunk, reason=reason, **dict(zip(self.columns, held)))
        self.rows.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        chunk, n, due = self.current() or (0, 0, None)
        new = []
        for row in rows:
            new.append(tuple(row[c] for c in self.columns))
            n += 1
            if n == self.size:
                self.rows.appendList(new)
                yield from self._flush(key, chunk, "count")
                new, chunk, n = [], chunk + 1, 0
                if due is not None:
                    self.handle.deleteTimer(due)
                    due = None
        if new:
            self.rows.appendList(new)
            if due is None:
                due = timerValues.getCurrentProcessingTimeInMs() + self.interval_ms
                self.handle.registerTimer(due)
        self.state.update((chunk, n, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        chunk, n, due = self.current()
        if due == expiredTimerInfo.getExpiryTimeInMs() and n:
            yield from self._flush(key, chunk, "interval")
            self.state.update((chunk + 1, 0, None))


def batch_or_interval(df: DataFrame, shards: int, size: int, interval: str) -> DataFrame:
    """Rows in the chunks that a buffering sink of ``shards`` writers flushes: ``shard``, ``chunk``, ``reason`` and the row's columns.

    Runs on the clock: use a trigger that goes on (``processingTime``), and a ``foreachBatch`` or file sink behind it.
    """
    spread = df.select(F.pmod(F.xxhash64(*df.columns), F.lit(shards)).cast("int").alias("shard"), *df.columns)
    buffered = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in df.columns)
    sink = BatchOrInterval(size, interval_us(interval) // 1000, df.columns, buffered)
    return spread.groupBy("shard").transformWithState(
        statefulProcessor=sink, outputStructType=f"shard INT, chunk BIGINT, reason STRING, {buffered}", outputMode="Append", timeMode="ProcessingTime")


class IdleCount(KeyedProcessor):
    """Running count per key whose state is gone once the key was idle for longer than ``idle``."""

    STATE = "n BIGINT, us BIGINT"

    def __init__(self, idle_us: int):
        self.idle_us = idle_us

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """State and timer are touched once per key and micro-batch: only the last row's are left in the end."""
        n, us = self.current() or (0, None)
        old_us = us
        for row in sorted(rows, key=self.order):
            n = n + 1 if us is not None and row.us - us <= self.idle_us else 1
            us = row.us
            yield Row(user_id=key[0], event_id=row.tie, n=n)
        if us != old_us:
            self.arm(old_us + self.idle_us if old_us is not None else None, us + self.idle_us)
        self.state.update((n, us))

    def on_timer(self, key, at_ms: int) -> Iterator[Row]:
        held = self.current()
        if held and ceil_ms(held[1] + self.idle_us) == at_ms:
            self.state.clear()
        return iter(())


def counts_with_idle_reset(df: DataFrame, ts: str, tie: str, idle: str) -> DataFrame:
    """Streaming twin of ``timers.counts_with_idle_reset``: timers on the watermark drop the state of idle keys."""
    rows = with_order(df, ts, tie).select("user_id", ts, "us", "tie")
    return run_keyed(rows, ["user_id"], IdleCount(interval_us(idle)), "event_id BIGINT, n BIGINT", timers=True)
