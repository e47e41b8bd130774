"""State with timers over streams of events: batches by size or time, and types that stall.

Both run as ``transformWithState`` with processing-time timers, so a timer fires in the next trigger although no record
comes. State lies in RocksDB below the query's checkpoint and survives lost executors. Such a stream always has a next
trigger: with ``availableNow`` it does not end, with ``once`` it ends after one, and what waits then stays in the state.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from threading import Lock
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from dumpmill.operators.state import Marker
from dumpmill.operators.status import snapshot
from dumpmill.sinks.broker import TIMEOUT, Desk, Send, Sender, _Caller

LOG = logging.getLogger("dumpmill")
BATCHES = "data_type string, lane long, number long, cause string, frames array<string>"
STALLS = "data_type string, state string, records long, last timestamp"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Timer:
    """The one timer of a key, kept by its time of expiry (0: none)."""

    def __init__(self, handle: StatefulProcessorHandle, expiry: int):
        self.handle, self.expiry = handle, expiry

    def set(self, expiry: int) -> None:
        if expiry == self.expiry:
            return
        if self.expiry:
            self.handle.deleteTimer(self.expiry)
        if expiry:
            self.handle.registerTimer(expiry)
        self.expiry = expiry


class _Batches(StatefulProcessor):
    def __init__(self, size: int, wait: float):
        self.size, self.wait = size, int(wait * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "seq long, value string")
        self.own = handle.getValueState("own", "held long, number long, timer long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, number, expiry = self.own.get() or (0, 0, 0)
        held = [tuple(x) for x in self.held.get()] if n else []
        timer, cut = _Timer(self.handle, expiry), False
        for frame in rows:
            for row in zip(frame["seq"].tolist(), frame["value"].tolist(), strict=True):
                held.append(row)
                if len(held) >= self.size:
                    yield self._batch(key, number, "size", held)
                    number, held, cut = number + 1, [], True
        if held:
            self.held.put(held)
            if cut or not timer.expiry:  # what is oldest now has just come
                timer.set(timerValues.getCurrentProcessingTimeInMs() + self.wait)
        else:
            self.held.clear()
            timer.set(0)
        self.own.update((len(held), number, timer.expiry))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, number, _ = self.own.get() or (0, 0, 0)
        if n:
            yield self._batch(key, number, "time", [tuple(x) for x in self.held.get()])
            self.held.clear()
            number += 1
        self.own.update((0, number, 0))

    def close(self) -> None:
        pass

    @staticmethod
    def _batch(key: Any, number: int, cause: str, held: list[tuple]) -> pd.DataFrame:
        values = [v for _, v in sorted(held, key=lambda x: x[0])]
        return pd.DataFrame({"data_type": [key[0]], "lane": [key[1]], "number": [number], "cause": [cause], "frames": [values]})


def with_rocks(spark: SparkSession) -> None:
    """State with timers needs the RocksDB store; a provider that was chosen by hand stays."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in spark.conf.get(key):
        spark.conf.set(key, _ROCKS)


def timed_batches(events: DataFrame, size: int = 100, wait: float = 1.0, lane: Column | None = None) -> DataFrame:
    """(data_type, lane, number, cause, frames): the stream ``events`` (data_type, seq, value) in batches of ``size`` frames,
    or of fewer once the oldest frame has waited ``wait`` seconds and the next trigger comes. ``cause`` is size or time.

    Each lane of a type holds under ``size`` frames as state and is filled in one task, so a type that has most of
    the stream needs lanes: by default 64 by the hash of blocks of 1,000 places. Frames lie in a batch by ``seq``, nulls as
    0; batches of a lane are numbered from 0. A null value is an empty frame.
    """
    with_rocks(events.sparkSession)
    own = lane if lane is not None else F.pmod(F.xxhash64(F.floor(F.col("seq") / 1000)), F.lit(64))
    rows = events.select("data_type", F.coalesce(own.cast("long"), F.lit(0)).alias("lane"), F.coalesce(F.col("seq").cast("long"), F.lit(0)).alias("seq"),
                         F.coalesce("value", F.lit("")).alias("value"))
    return rows.groupBy("data_type", "lane").transformWithStateInPandas(_Batches(size, wait), BATCHES, "append", "processingTime")


class _Outbox:
    """Sends each batch of a partition as it is; opened anew for every partition and trigger."""

    def __init__(self, send: Send, prefix: str, timeout: float, desk: tuple | None):
        self.send, self.prefix, self.timeout, self.desk = send, prefix, timeout, desk

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.sender, self.ask = Sender(self.send, self.timeout), _Caller(self.desk) if self.desk else None
        return True

    def process(self, row: Any) -> None:
        if self.ask:
            import time

            time.sleep(self.ask("lease", len(row.frames)))
        self.sender(f"{self.prefix}-{row.data_type}", list(row.frames))

    def close(self, error: Exception | None) -> None:
        self.sender.close()


def publish_stream(
    events: DataFrame, send: Send, checkpoint: str, size: int = 100, wait: float = 1.0, prefix: str = "catalog", timeout: float = TIMEOUT, desk: Desk | None = None,
    lane: Column | None = None, every: str = "500 milliseconds",
) -> StreamingQuery:
    """The batches of ``timed_batches`` handed to an adapter from the executors, under the rate of ``desk`` if there is one.

    At least once: a trigger that fails half-way is tried again whole, and consumers tell repeats by (id, sha256)."""
    own = timed_batches(events, size, wait, lane).writeStream.foreach(_Outbox(send, prefix, timeout, desk.address if desk else None))
    return own.outputMode("append").option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


class _Stalls(StatefulProcessor):
    def __init__(self, seconds: float):
        self.wait = int(seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.own = handle.getValueState("own", "records long, last long, timer long, stalled boolean")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        records, _, expiry, stalled = self.own.get() or (0, 0, 0, False)
        now, timer, completed = timerValues.getCurrentProcessingTimeInMs(), _Timer(self.handle, expiry), False
        for frame in rows:
            records += int(frame["records"].sum())
            completed |= bool(frame["completed"].any())
        if stalled:
            yield self._row(key, "recovered", records, now)
        timer.set(0 if completed else now + self.wait)
        self.own.update((records, now, timer.expiry, False))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        records, last, _, _ = self.own.get()
        yield self._row(key, "stalled", records, last)
        self.own.update((records, last, 0, True))

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key: Any, state: str, records: int, last: int) -> pd.DataFrame:
        return pd.DataFrame({"data_type": [key[0]], "state": [state], "records": [records], "last": [pd.Timestamp(last, unit="ms")]})


def _added_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield b.groupby("data_type", as_index=False, dropna=False).agg({"records": "sum", "completed": "any"})


def live_stalls(progress: DataFrame, seconds: float = 120) -> DataFrame:
    """(data_type, state, records, last): a row ``stalled`` once a type of the stream ``progress`` (data_type, completed) had no row
    for ``seconds``, and ``recovered`` with its next one. A type with a row ``completed`` no longer stalls until another comes.
    Rows are added up before they are shuffled, so a type with most of them is no burden."""
    with_rocks(progress.sparkSession)
    own = progress.select("data_type", F.lit(1).cast("long").alias("records"), F.coalesce("completed", F.lit(False)).alias("completed"))
    own = own.mapInPandas(_added_up, "data_type string, records long, completed boolean")
    return own.groupBy("data_type").transformWithStateInPandas(_Stalls(seconds), STALLS, "append", "processingTime")


class LiveStatus(StreamingQueryListener):
    """What runs now, for monitoring: rows and state of streams from their progress, and types that have stalled.

    Register it with ``spark.streams.addListener``; ``watch_stalls`` tells it of stalls."""

    def __init__(self) -> None:
        self._lock, self._names, self._streams, self._stalled = Lock(), {}, {}, {}

    def onQueryStarted(self, event: Any) -> None:  # noqa: N802
        with self._lock:
            self._names[str(event.id)] = event.name or str(event.id)
            self._streams[self._names[str(event.id)]] = {"status": "in_progress", "rows": 0, "rows_per_second": 0.0, "last": None, "error": None}

    def onQueryProgress(self, event: Any) -> None:  # noqa: N802
        p = event.progress
        with self._lock:
            own = self._streams[self._names[str(p.id)]]
            own["rows"] += p.numInputRows
            own["rows_per_second"] = p.inputRowsPerSecond
            if p.numInputRows:
                own["last"] = p.timestamp

    def onQueryIdle(self, event: Any) -> None:  # noqa: N802
        with self._lock:
            self._streams[self._names[str(event.id)]]["rows_per_second"] = 0.0

    def onQueryTerminated(self, event: Any) -> None:  # noqa: N802
        with self._lock:
            own = self._streams[self._names[str(event.id)]]
            own["status"], own["error"] = ("failed", event.exception) if event.exception else ("completed", None)

    def told(self, data_type: str, state: str, last: Any) -> None:
        with self._lock:
            if state == "stalled":
                self._stalled[data_type] = last
            else:
                self._stalled.pop(data_type, None)

    def view(self, marker: Marker | None = None) -> dict[str, Any]:
        """The snapshot of a marker with ``streams`` by name and ``stalled`` by type."""
        with self._lock:
            errors = [f"{k}: {v['error']}" for k, v in self._streams.items() if v["error"]]
            return snapshot(marker, "; ".join(errors) or None) | {"streams": {k: dict(v) for k, v in self._streams.items()}, "stalled": dict(self._stalled)}


def watch_stalls(progress: DataFrame, checkpoint: str, status: LiveStatus | None = None, seconds: float = 120, every: str = "10 seconds") -> StreamingQuery:
    """Log a warning for each type that stalls and a note when it recovers, and tell ``status``."""
    def tell(rows: DataFrame, epoch: int) -> None:
        for r in rows.collect():  # a row a type at most
            LOG.log(logging.WARNING if r.state == "stalled" else logging.INFO, "%s %s after %d records, last at %s", r.data_type, r.state, r.records, r.last)
            if status:
                status.told(r.data_type, r.state, r.last)

    own = live_stalls(progress, seconds).writeStream.foreachBatch(tell).outputMode("append")
    return own.queryName("stalls").option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
