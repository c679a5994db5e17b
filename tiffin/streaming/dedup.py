"""Event time, late rows and repeated requests."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tiffin.schemas import LATE_LIMIT

EVENT_TIME = "order_date_and_time"
HOLD_SECONDS = 3600  # as long as rows may be late
MARK_BUCKETS = 1 << 13


def with_late_limit(df: DataFrame, event_time: str = EVENT_TIME, limit: str = LATE_LIMIT) -> DataFrame:
    """Rows that are older than the newest seen time by more than the limit count as late."""
    return df.withWatermark(event_time, limit)


def _salted(df: DataFrame, spread: int) -> DataFrame:
    return df.withColumn("_salt", F.floor(F.rand() * spread).cast("int"))


def dedup_uuid(df: DataFrame, key: str = "UUID", spread: int = 1) -> DataFrame:
    """First arrival per id for ever. The state keeps every id that was ever seen.

    With `spread` above 1, copies of one id are first reduced in that many tasks, so an id
    that fills a large part of the stream does not fill a single task.
    """
    if spread > 1:
        df = _salted(df, spread).dropDuplicates([key, "_salt"]).drop("_salt")
    return df.dropDuplicates([key])


def dedup_uuid_bounded(df: DataFrame, key: str = "UUID", spread: int = 1) -> DataFrame:
    """First arrival per id within the late limit; older ids leave the state.

    A copy that arrives later than the limit after the first one passes again, so the limit
    must cover the time span over which a producer retries.
    """
    if spread > 1:
        df = _salted(df, spread).dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return df.dropDuplicatesWithinWatermark([key])


class FirstArrival(StatefulProcessor):
    """Lets one row of an id pass; a timer takes its mark away when the stream's time has moved
    on far enough since.

    A state holds the marks of all ids that share a bucket, since a call per id costs far more than
    the id itself.
    """

    def __init__(self, hold_ms: int, ids: list[str], marks: str):
        self.hold_ms, self.ids, self.marks = hold_ms, ids, marks

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", self.marks)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        marks = self._get()
        before = len(marks)
        now = max(0, timerValues.getCurrentWatermarkInMs())
        for row in rows:
            own = tuple(row[name] for name in self.ids)
            if own not in marks:
                marks[own] = now
                yield row
        if len(marks) > before:
            self._put(marks)
            if before == 0:  # else there is a timer, which sets the next one
                self.handle.registerTimer(now + self.hold_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(0, timerValues.getCurrentWatermarkInMs())
        # A mark set before the stream had a time counts from the first one.
        marks = {own: since or now for own, since in self._get().items()}
        marks = {own: since for own, since in marks.items() if since + self.hold_ms > now}
        self._put(marks)
        if marks:
            self.handle.registerTimer(min(marks.values()) + self.hold_ms)
        yield from ()

    def _get(self) -> dict[tuple, int]:
        if not self.seen.exists():
            return {}
        ids, salts, since = self.seen.get()
        own = zip(ids, salts, strict=True) if len(self.ids) > 1 else zip(ids, strict=True)
        return dict(zip(own, since, strict=True))

    def _put(self, marks: dict[tuple, int]) -> None:
        if not marks:
            self.seen.clear()
            return
        salts = [own[1] if len(own) > 1 else 0 for own in marks]
        self.seen.update(([own[0] for own in marks], salts, list(marks.values())))

    def close(self) -> None:
        pass


def dedup_by_arrival(
    df: DataFrame, key: str = "UUID", hold_seconds: int = HOLD_SECONDS, spread: int = 1
) -> DataFrame:
    """First arrival per key; copies are dropped until the watermark has moved `hold_seconds` on.

    For rows without an event time of their own, which the built-in operator forgets at once. Here
    the mark of a key lives by the time that the other rows of the stream tell, so a replay gives
    what the first run gave; `df` has a watermark. With `spread`, copies of one key are first
    reduced in that many tasks.
    """
    keys = [[key]]
    if spread > 1:
        df = _salted(df, spread)
        keys.insert(0, [key, "_salt"])
    for columns in keys:
        df = df.withColumn("_bucket", F.pmod(F.xxhash64(*columns), F.lit(MARK_BUCKETS)))
        marks = f"ids array<{df.schema[key].dataType.simpleString()}>, salts array<int>, since array<long>"
        df = df.groupBy("_bucket").transformWithState(
            FirstArrival(hold_seconds * 1000, columns, marks), df.schema, "append", "eventTime"
        )
    return df.drop("_salt", "_bucket")


def dedup_requests(
    df: DataFrame, key: str = "UUID", event_time: str = EVENT_TIME,
    hold_seconds: int = HOLD_SECONDS, spread: int = 1,
) -> DataFrame:
    """First arrival per key, for rows with an event time and for rows without.

    `df` has its late limit. Each kind reads the source, and a key that comes with and without a
    time passes once as each."""
    timed = dedup_uuid_bounded(df.where(F.col(event_time).isNotNull()), key, spread)
    untimed = dedup_by_arrival(df.where(F.col(event_time).isNull()), key, hold_seconds, spread)
    return timed.unionByName(untimed)


def guarded_event_time(df: DataFrame, event_time: str = EVENT_TIME, ahead: str = "1 day") -> DataFrame:
    """Add `event_ts` for the watermark: no time for rows stamped in the far future.

    One such row would otherwise move the watermark on and turn all others into late rows.
    A row without an event time is never late.
    """
    limit = F.current_timestamp() + F.expr(f"interval {ahead}")
    return df.withColumn("event_ts", F.when(F.col(event_time) <= limit, F.col(event_time)))
