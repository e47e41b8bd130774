"""Frames to a broker adapter from many tasks: a data source writer, one rate for all, and no batch sent twice by a retry.

A ``Desk`` in the driver is asked by tasks over an authenticated connection. It holds a token bucket, so that all tasks of all
files of a run share one rate and what an idle one leaves goes to the others, and a mark for each range of a job: the
place of the last confirmed frame. A task that is tried again claims its range, skips what was confirmed and sends the
rest; the attempt before it can no longer confirm. Only the batch whose confirmation was lost can arrive twice.

Tasks note each confirmed batch on their line to the desk before they send the next, and wait for no answer: at the rate of
all tasks together, an answer for each batch would be what the run waits for. A range is handed on once the line of the attempt before
is read to its end. Tasks ask for leases only where there is a rate.
"""

from __future__ import annotations

import base64
import secrets
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from multiprocessing.connection import Client, Connection, Listener
from typing import Any

from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Takes an exchange and frames, sends them all, then waits for their confirmations; returns how many were
#: confirmed, and raises (or returns fewer) if one was returned, refused or late. An adapter with a method ``cancel``
#: is told when its time is over, to close its connection, so that a late batch does not arrive beside its repetition.
Send = Callable[[str, list[str]], int]
#: Seconds that an adapter has for a batch.
TIMEOUT = 30.0
#: Seconds of the rate that may go at once after a pause.
BURST = 0.1
FORMAT = "catalogframes"


class TokenBucket:
    """``rate`` tokens a second, BURST seconds of them in stock at most; tokens are reserved and then waited for."""

    def __init__(self, rate: float, now: float | None = None):
        self.rate, self.most = rate, max(1.0, rate * BURST)
        self.stock, self.last = self.most, time.monotonic() if now is None else now

    def take(self, n: int, now: float | None = None) -> float:
        """Seconds to wait before ``n`` frames may go."""
        now = time.monotonic() if now is None else now
        self.stock = min(self.most, self.stock + (now - self.last) * self.rate) - n
        self.last = now
        return max(0.0, -self.stock / self.rate)


@dataclass
class _Range:
    owner: int = -1
    mark: tuple | None = None
    sent: int = 0
    #: The line of its attempt, set once it is read to its end.
    line: threading.Event | None = None


class SupersededError(RuntimeError):
    """Another attempt has taken the range over."""


class Ledger:
    """Rate and marks of a run, and what is said of them on a line. ``rate`` is frames a second of all tasks together, None or 0
    for no bound."""

    def __init__(self, rate: float | None = None):
        self._bucket = TokenBucket(rate) if rate else None
        self._ranges: dict[tuple[str, int], _Range] = {}
        self._lock = threading.Lock()

    def answer(self, caller: Connection) -> None:
        """What one line says, to its end. Notes are answered only if they are refused."""
        ended = threading.Event()
        calls = {"lease": self.lease, "claim": self.claim, "confirm": self.confirm, "note": self.confirm, "settle": self.settle,
                 "open": lambda *args: self.open(ended, *args)}
        try:
            with caller:
                while True:
                    try:
                        name, args = caller.recv()
                    except (EOFError, OSError):
                        return
                    try:
                        out = (True, calls[name](*args))
                    except Exception as e:  # noqa: BLE001  raised in the task
                        out = (False, e)
                    if name != "note" or not out[0]:
                        try:
                            caller.send(out)
                        except OSError:  # its task is gone; what it noted before is still read
                            pass
        finally:
            ended.set()

    def lease(self, n: int) -> float:
        with self._lock:
            return self._bucket.take(n) if self._bucket else 0.0

    def claim(self, job: str, part: int, attempt: int) -> tuple | None:
        """The place of the last confirmed frame of a range, which is this attempt's from now on."""
        with self._lock:
            own = self._ranges.setdefault((job, part), _Range())
            if attempt < own.owner:
                raise SupersededError(f"attempt {attempt} of range {part} came after {own.owner}")
            own.owner = attempt
            return own.mark

    def open(self, line: threading.Event, job: str, part: int, attempt: int, wait: float = TIMEOUT) -> tuple[tuple | None, bool]:
        """``claim`` for an attempt that notes its marks, and whether it needs leases. The attempt before is refused from
        now on; what it noted until then is read first, for ``wait`` seconds at most if it does not end."""
        self.claim(job, part, attempt)
        with self._lock:
            own = self._ranges[(job, part)]
            before, own.line = own.line, line
        if before is not None and before is not line:
            before.wait(wait)
        return self.claim(job, part, attempt), self._bucket is not None

    def settle(self, job: str, part: int, attempt: int) -> None:
        """Answered when all notes before it on its line are read."""
        self.claim(job, part, attempt)

    def confirm(self, job: str, part: int, attempt: int, mark: tuple, n: int) -> None:
        with self._lock:
            own = self._ranges[(job, part)]
            own.mark, own.sent = max(own.mark or mark, mark), own.sent + n
            if attempt != own.owner:
                raise SupersededError(f"range {part} belongs to attempt {own.owner} now")

    def sent(self, job: str) -> int:
        """Frames of a job that were confirmed so far."""
        with self._lock:
            return sum(r.sent for (j, _), r in self._ranges.items() if j == job)

    def forget(self, job: str) -> None:
        with self._lock:
            for key in [k for k in self._ranges if k[0] == job]:
                del self._ranges[key]


class Desk(Ledger):
    """A ledger for tasks on any machine that reaches the driver. Use it in a ``with`` block."""

    def __init__(self, host: str, rate: float | None = None):
        super().__init__(rate)
        self._key = secrets.token_bytes(32)
        self._listener = Listener((host, 0), authkey=self._key)
        self._open = True
        threading.Thread(target=self._serve, daemon=True).start()

    @classmethod
    def of(cls, spark: SparkSession, rate: float | None = None) -> Desk:
        return cls(spark.conf.get("spark.driver.bindAddress", None) or spark.conf.get("spark.driver.host"), rate)

    @property
    def address(self) -> tuple:
        return self._listener.address, self._key

    def __enter__(self) -> Desk:
        return self

    def __exit__(self, *_) -> None:
        self._open = False
        try:  # wakes the thread that waits for a caller
            Client(self._listener.address, authkey=self._key).close()
        except OSError:
            pass
        self._listener.close()

    def _serve(self) -> None:
        while self._open:
            try:
                caller = self._listener.accept()
            except Exception:  # noqa: BLE001  a caller without the key, or the end
                continue
            threading.Thread(target=self.answer, args=(caller,), daemon=True).start()


class _Caller:
    """A task's connection to the desk."""

    def __init__(self, address: tuple | None, line: Connection | None = None):
        self._line = Client(address[0], authkey=address[1]) if line is None else line

    def __call__(self, name: str, *args) -> Any:
        self._line.send((name, args))
        return self._heard()

    def note(self, *args) -> None:
        """Noted without an answer; raises if an earlier note was refused."""
        self._line.send(("note", args))
        if self._line.poll():
            self._heard()

    def _heard(self) -> Any:
        good, out = self._line.recv()
        if not good:
            raise out
        return out

    def close(self) -> None:
        self._line.close()


@dataclass(frozen=True)
class Spec:
    """What tasks need: the adapter, the desk's address, the name of the job and how batches are cut."""

    send: Send
    desk: tuple
    job: str
    size: int = 100
    prefix: str = "catalog"
    wait: float = 1.0
    timeout: float = TIMEOUT


class Sender:
    """Batches of one task, one after the other through one thread."""

    def __init__(self, send: Send, timeout: float = TIMEOUT):
        self.send, self.timeout, self.pool = send, timeout, ThreadPoolExecutor(1)

    def __call__(self, name: str, frames: list[str]) -> int:
        try:
            n = self.pool.submit(self.send, name, frames).result(self.timeout)
        except TimeoutError as e:
            if (cancel := getattr(self.send, "cancel", None)) is not None:
                cancel()
            raise RuntimeError(f"no confirmation from {name} in {self.timeout:g} seconds") from e
        if n != len(frames):
            raise RuntimeError(f"{len(frames) - n} of {len(frames)} messages were not confirmed")
        return n

    def close(self) -> None:
        self.pool.shutdown(wait=False, cancel_futures=True)


@dataclass
class Sent(WriterCommitMessage):
    part: int
    frames: int


@dataclass
class FrameWriter(DataSourceArrowWriter):
    """Sends the frames of a partition in their order, as batches of one exchange."""

    spec: Spec

    def write(self, iterator: Iterator) -> Sent:
        task = TaskContext.get()
        return send_range(self.spec, _Caller(self.spec.desk), task.partitionId(), task.taskAttemptId(), iterator)


def send_range(own: Spec, ask: _Caller, part: int, attempt: int, iterator: Iterator) -> Sent:
    """Sends what a range has beyond its mark. Each batch is noted before the next is sent."""
    send = Sender(own.send, own.timeout)
    kind, held, last, done, at = None, [], time.monotonic(), 0, None

    def flush() -> None:
        nonlocal held, last, done
        if held:
            if rated:
                time.sleep(ask("lease", len(held)))
            n = send(f"{own.prefix}-{kind}", held)
            ask.note(own.job, part, attempt, at, n)
            done += n
        held, last = [], time.monotonic()

    try:
        mark, rated = ask("open", own.job, part, attempt, own.timeout)
        for batch in iterator:
            for entity, file, seq, frame in zip(*(batch.column(c).to_pylist() for c in ("data_type", "file", "seq", "value")), strict=True):
                if mark is not None and (file, seq) <= mark:
                    continue
                if entity != kind:
                    flush()
                    kind = entity
                held.append(frame)
                at = (file, seq)
                if len(held) >= own.size:
                    flush()
            if time.monotonic() - last > own.wait:
                flush()
        flush()
        ask("settle", own.job, part, attempt)
    finally:
        send.close()
        ask.close()
    return Sent(part, done)


class FrameSource(DataSource):
    """``df.write.format("catalogframes")`` over (data_type, file, seq, value), sorted by file and seq in partitions."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "data_type string, file string, seq long, value string"

    def writer(self, schema, overwrite: bool) -> FrameWriter:
        return FrameWriter(cloudpickle.loads(base64.b64decode(self.options["spec"])))


_registering = threading.Lock()


def send_frames(frames: DataFrame, spec: Spec) -> None:
    """The frames as they lie in partitions, through the data source."""
    spark = frames.sparkSession
    spark.createDataFrame([], "x int")  # makes the session that of this thread, where data sources are looked up
    with _registering:
        spark.dataSource.register(FrameSource)
    text = base64.b64encode(cloudpickle.dumps(spec)).decode()
    frames.select("data_type", "file", "seq", "value").write.format(FORMAT).mode("append").option("spec", text).save()


def publish(events: DataFrame, send: Send, size: int = 100, rate: float | None = None, prefix: str = "catalog", tasks: int | None = None,
            wait: float = 1.0, timeout: float = TIMEOUT, desk: Desk | None = None, job: str | None = None) -> int:
    """Hand the frames of ``events`` (data_type, file, seq, value) to an adapter from the executors; returns their number.

    Each file is cut into ranges by place, ``tasks`` of them in all, so a file of any size is sent by many tasks;
    within a range frames keep their order. A batch has ``size`` frames of one exchange, or fewer once ``wait``
    seconds have passed. A batch that is not confirmed within ``timeout`` seconds fails its task, and Spark tries it again.
    ``events`` should be a written table, so that ranges are the same when they are tried again. Several calls share
    the rate of one ``desk``; else each has its own with ``rate``.
    """
    if desk is None:
        with Desk.of(events.sparkSession, rate) as own:
            return publish(events, send, size, None, prefix, tasks, wait, timeout, own, job)
    tasks = tasks or events.sparkSession.sparkContext.defaultParallelism
    spec = Spec(send, desk.address, job or uuid.uuid4().hex, size, prefix, wait, timeout)
    ranges = events.repartitionByRange(tasks, "file", "seq") if tasks > 1 else events.coalesce(1)
    try:
        send_frames(ranges.sortWithinPartitions("file", "seq"), spec)
        return desk.sent(spec.job)
    finally:
        if job is None:
            desk.forget(spec.job)


__all__ = ["Desk", "FrameSource", "Send", "Sender", "Spec", "SupersededError", "TokenBucket", "publish", "send_frames"]
