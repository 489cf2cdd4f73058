"""The status machine of files on a stream: keyed state and timers in place of a table that is rewritten.

Each file has one state, kept by Spark's state store with the query's checkpoint. A change (a row of PARSE_STATE: a
request taken up, a result, a failure) replaces it if it comes later by the rule of `operators.files.upsert` with
`keep_finished`: a success is never opened again, otherwise the newest update_time wins, and of equal ones the
greater row. That rule is a maximum, so what is replayed, late or out of order leaves the same state as the batch
query; nothing is dropped for being late, as no watermark is needed. What changes a state goes out once.

A file in processing has a timer. If nothing has replaced that state when it runs out, the file fails, with the
time that its patience ended: later changes and a success still come through, and a request may take it again."""

from __future__ import annotations

import datetime
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from inkspan.operators.files import FAILED, PROCESSING, SUCCESS
from inkspan.schemas import PARSE_STATE, checked

#: The state store that keyed state and timers need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
REST = [c for c in PARSE_STATE.names if c != "file_id"]
#: States as the processor sees them: times as microseconds, which no session's time zone touches.
INNER = T.StructType([T.StructField(f.name, T.LongType() if f.name == "update_time" else f.dataType) for f in PARSE_STATE.fields])


def rank(values: tuple) -> tuple:
    """Sort key of a state (PARSE_STATE without file_id): finished ones above all, then the newest, then by the whole row; a
    null is less than any value."""
    d = dict(zip(REST, values, strict=True))
    order = lambda v: (v is not None, v if v is not None else 0)
    return d["parse_status"] == SUCCESS, order(d["update_time"]), *(order(v) for v in values)


class FileStatus(StatefulProcessor):
    """One file's state; patience is how long it may be in processing."""

    def __init__(self, patience: datetime.timedelta):
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", T.StructType([f for f in INNER.fields if f.name != "file_id"]))

    def _put(self, key: tuple, values: tuple) -> Row:
        self.state.update(values)
        return Row(file_id=key[0], **dict(zip(REST, values, strict=True)))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old = tuple(self.state.get()) if self.state.exists() else None
        best = old
        for r in rows:
            new = tuple(r[c] for c in REST)
            if best is None or rank(new) > rank(best):
                best = new
        if best == old or best is None:
            return
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if best[REST.index("parse_status")] == PROCESSING:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(self.patience.total_seconds() * 1000))
        yield self._put(key, best)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.state.exists():
            return
        state = dict(zip(REST, self.state.get(), strict=True))
        if state["parse_status"] != PROCESSING:
            return
        since = state["update_time"]
        waited = int(self.patience.total_seconds() * 1_000_000)
        state |= {"parse_status": FAILED, "update_time": since + waited if since is not None else None}
        yield self._put(key, tuple(state[c] for c in REST))

    def close(self) -> None:
        pass


def file_states(changes: DataFrame, patience: datetime.timedelta = datetime.timedelta(hours=1)) -> DataFrame:
    """A stream of changes (PARSE_STATE) as a stream of the states that they leave, each as it is replaced. Rows without a
    file_id are left out. The session's state store must be RocksDB (PROVIDER). Timers run out in micro-batches, so
    a stream under an availableNow trigger needs spark.sql.streaming.noDataMicroBatches.enabled=false to end."""
    rows = checked(changes, PARSE_STATE).filter(F.col("file_id").isNotNull()).withColumn("update_time", F.unix_micros("update_time"))
    states = rows.groupBy("file_id").transformWithState(FileStatus(patience), INNER, "Update", "ProcessingTime")
    return states.withColumn("update_time", F.timestamp_micros("update_time"))
