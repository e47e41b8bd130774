"""What tasks say to the desk, over pairs of connections without a listener."""
import threading
from multiprocessing import Pipe

import pyarrow as pa
import pytest

from dumpmill.sinks import broker as B


def line(ledger):
    ours, theirs = Pipe()
    threading.Thread(target=ledger.answer, args=(theirs,), daemon=True).start()
    return B._Caller(None, ours)


class Counted(B._Caller):
    """Calls that waited for an answer."""

    asked = 0

    def __call__(self, name, *args):
        self.asked += 1
        return super().__call__(name, *args)


def batches(n, size=1000):
    rows = [{"data_type": "t", "file": "f", "seq": i, "value": str(i)} for i in range(n)]
    return iter([pa.RecordBatch.from_pylist(rows[at : at + size]) for at in range(0, n, size)])


def spec(send, size=10):
    return B.Spec(send, (), "j", size)


def test_answers_do_not_grow_with_batches():
    asked = []
    for n in (100, 5000):
        ledger = B.Ledger()
        own = Counted(None, line(ledger)._line)
        assert B.send_range(spec(lambda exchange, frames: len(frames)), own, 0, 1, batches(n)).frames == n
        assert ledger.sent("j") == n  # all notes are read when the task ends
        asked.append(own.asked)
    assert asked == [2, 2]


def test_a_range_is_handed_on_with_all_that_was_noted():
    """The attempt before ended with notes that nobody has read: the next one waits for them."""
    ledger, got = B.Ledger(), []

    def send(exchange, frames):
        if "457" in frames and fails:
            raise OSError("connection lost")
        got.extend(frames)
        return len(frames)

    fails, confirm = [1], ledger.confirm
    gate = threading.Event()

    def late(*args):
        gate.wait(5)
        return confirm(*args)

    ledger.confirm = late
    with pytest.raises(OSError):
        B.send_range(spec(send), line(ledger), 0, 1, batches(600))
    fails.clear()
    threading.Timer(0.3, gate.set).start()
    assert B.send_range(spec(send), line(ledger), 0, 2, batches(600)).frames == 150
    assert got == [str(i) for i in range(600)] and ledger.sent("j") == 600


def test_the_attempt_before_is_refused():
    ledger = B.Ledger()
    old, new = line(ledger), line(ledger)
    assert old("open", "j", 0, 1) == (None, False)
    old.note("j", 0, 1, ("f", 9), 10)
    assert new("open", "j", 0, 2, 0.2) == (("f", 9), False)  # it has not ended, so the wait is bounded
    old._line.send(("note", ("j", 0, 1, ("f", 19), 10)))
    with pytest.raises(B.SupersededError):
        old("settle", "j", 0, 1)
    with pytest.raises(B.SupersededError):
        line(ledger)("open", "j", 0, 1)
    assert ledger.sent("j") == 20


def test_leases_where_there_is_a_rate():
    ledger = B.Ledger(100000)
    own = Counted(None, line(ledger)._line)
    B.send_range(spec(lambda exchange, frames: len(frames)), own, 0, 1, batches(100))
    assert own.asked == 12
