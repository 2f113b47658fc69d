"""Closing of inbox groups as a stateful stream: markers as events, quiescence as timers.

The state of a submitter is its open objects and its markers, in the state store. A look at the inbox touches only
what it reports: an object that is new or has changed sets a timer for the end of its quiet time, a marker claims what is
open below its folder and what comes there later, the deepest marker first. What is closed leaves the state.

Time is that of the looks (`seen_at`), whose watermark fires the timers; a source that gives a row for each look, even an
empty one, lets it go on. Runs over the same looks give the same groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quarry.operators.intake import MARKER, QUIET_MINUTES

CLOSED = "object_key string, submitter_id string, inbox_prefix string, grouping_method string, bytes long, etag string, closed_at timestamp"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ms(t: datetime) -> int:
    return round(t.timestamp() * 1000)


class Closing(StatefulProcessor):
    def __init__(self, quiet_minutes: float):
        self.quiet = round(quiet_minutes * 60_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.objects = handle.getMapState("objects", "object_key string", "bytes long, etag string, changed_ms long")
        self.markers = handle.getMapState("markers", "prefix string", "seen_ms long")

    def _row(self, key: str, submitter: str, prefix: str, method: str, state: tuple, ms: int) -> Row:
        at = datetime.fromtimestamp(ms / 1000, timezone.utc).replace(tzinfo=None)
        return Row(object_key=key, submitter_id=submitter, inbox_prefix=prefix, grouping_method=method, bytes=state[0], etag=state[1], closed_at=at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        touched, fresh = {}, []
        for r in sorted((r for r in rows if r["object_key"] is not None), key=lambda r: r["seen_at"]):
            ms = _ms(r["seen_at"])
            folder, _, name = r["object_key"].rpartition("/")
            if name == MARKER:
                if not self.markers.containsKey((f"{folder}/",)):
                    fresh.append(f"{folder}/")
                self.markers.updateValue((f"{folder}/",), (ms,))
            else:
                state = touched[r["object_key"]] = (r["bytes"], r["etag"], ms)
                self.objects.updateValue((r["object_key"],), state)
                self.handle.registerTimer(ms + self.quiet)
        if not touched and not fresh:
            return
        prefixes = sorted((p for (p,) in self.markers.keys()), key=len, reverse=True)
        below = tuple(fresh)
        open_ = {k: s for (k,), s in self.objects.iterator() if k in touched or k.startswith(below)} if fresh else touched
        now = max(s[2] for s in [*touched.values(), *((self.markers.getValue((p,))[0],) * 3 for p in fresh)])
        for k, s in sorted(open_.items()):
            claim = next((p for p in prefixes if k.startswith(p)), None)
            if claim is not None:
                self.objects.removeKey((k,))
                yield self._row(k, claim.split("/")[1], claim.rstrip("/"), "MARKER", tuple(s), now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        ms = expiredTimerInfo.getExpiryTimeInMs()
        for k, s in sorted((k, tuple(s)) for (k,), s in self.objects.iterator() if s[2] + self.quiet <= ms):
            self.objects.removeKey((k,))
            yield self._row(k, key[0], f"inbox/{key[0]}", "QUIESCENCE", s, ms)

    def close(self) -> None:
        pass


def closed_stream(looks: DataFrame, quiet_minutes: float = QUIET_MINUTES) -> DataFrame:
    """(object_key, submitter_id, inbox_prefix, grouping_method, bytes, etag, closed_at) of each object once its group is closed.

    `looks` is a stream of changes with a row for each look, as `inbox.changes(..., looks="true")` gives. The session needs
    the RocksDB state store, which `use_state_store` sets. An object that changes after it was closed is open again.
    """
    timed = looks.withWatermark("seen_at", "0 seconds").where("submitter_id IS NOT NULL")
    return timed.groupBy("submitter_id").transformWithState(Closing(quiet_minutes), CLOSED, "Append", "EventTime")


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
