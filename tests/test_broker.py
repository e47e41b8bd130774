"""Frames through the data source writer: marks of retried tasks, one rate for all, attempts that are over."""
import os
import threading
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dumpmill.sinks import broker as B


def frames(spark, n, parts=4):
    return spark.range(0, n, 1, parts).select(F.lit("t").alias("data_type"), F.lit("f").alias("file"), F.col("id").alias("seq"), F.col("id").cast("string").alias("value"))


class Box:
    """An adapter that keeps each batch as a file; the first batches of a range can fail after they are kept or before."""

    def __init__(self, folder, fail_at=None, times=1):
        self.folder, self.fail_at, self.times = folder, fail_at, times

    def __call__(self, exchange, own):
        import uuid

        if self.fail_at in own:
            tries = os.path.join(self.folder, "tries")
            with open(tries, "a") as f:
                f.write("x")
            if os.path.getsize(tries) <= self.times:
                raise OSError("connection lost")
        with open(os.path.join(self.folder, f"{exchange}-{uuid.uuid4().hex}"), "w") as f:
            f.write("\n".join(own))
        return len(own)

    def got(self):
        out = Counter()
        for name in os.listdir(self.folder):
            if name != "tries":
                with open(os.path.join(self.folder, name)) as f:
                    out.update(f.read().split("\n"))
        return out


def test_bucket():
    own = B.TokenBucket(100, 0.0)
    assert own.take(10, 0.0) == 0 and own.take(5, 0.0) == pytest.approx(0.05) and own.take(5, 0.0) == pytest.approx(0.1)
    assert own.take(1, 10.0) == 0 and own.stock == 9  # a pause fills up a tenth of a second, no more
    assert B.TokenBucket(3, 0.0).most == 1


def test_claims(spark):
    with B.Desk.of(spark) as desk:
        ask = B._Caller(desk.address)
        assert ask("lease", 1000) == 0 and ask("claim", "j", 0, 7) is None
        ask("confirm", "j", 0, 7, ("f", 9), 10)
        assert B._Caller(desk.address)("claim", "j", 0, 8) == ("f", 9) and desk.sent("j") == 10
        with pytest.raises(B.SupersededError):
            ask("confirm", "j", 0, 7, ("f", 19), 10)
        with pytest.raises(B.SupersededError):
            ask("claim", "j", 0, 7)
        assert ask("claim", "j", 0, 9) == ("f", 19)  # what an attempt sent before it heard counts as sent
        desk.forget("j")
        assert desk.sent("j") == 0
    with pytest.raises(Exception):  # noqa: B017  closed
        B._Caller(desk.address)("lease", 1)


def test_strangers_are_refused(spark):
    with B.Desk.of(spark) as desk:
        with pytest.raises(Exception):  # noqa: B017
            B.Client(desk.address[0], authkey=b"other")
        assert B._Caller(desk.address)("lease", 1) == 0


def test_all_frames_once(spark, tmp_path):
    box = Box(str(tmp_path))
    assert B.publish(frames(spark, 1000), box, 7, tasks=3) == 1000
    assert box.got() == Counter(map(str, range(1000)))
    assert B.publish(frames(spark, 0), box) == 0


def test_a_retried_task_sends_confirmed_batches_once(tmp_path):
    """Local mode with retries, in a session of its own: a batch in the middle of a range fails twice."""
    code = f"""
import sys; sys.path.insert(0, {os.getcwd()!r})
from pyspark.sql import SparkSession
from tests.test_broker import Box, frames
from dumpmill.sinks import broker as B
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", {str(tmp_path / 'w')!r}).getOrCreate()
box = Box({str(tmp_path / 'box')!r}, "457", 2)
assert B.publish(frames(spark, 600), box, 10, tasks=2) == 600
assert box.got() == {{str(i): 1 for i in range(600)}}, box.got().most_common(3)
print("retried well")
"""
    import subprocess
    import sys

    (tmp_path / "box").mkdir()
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "retried well" in out.stdout, out.stderr[-2000:]
    assert os.path.getsize(tmp_path / "box" / "tries") == 3


def test_one_rate_for_skewed_ranges(spark):
    """Ranges of 10 : 1 : 1 : 1 rows: idle ones leave their share, so the whole takes what its rows take at the rate."""
    rows = frames(spark, 3900).withColumn("p", F.when(F.col("seq") < 3000, 0).otherwise(1 + F.col("seq") % 3))
    parts = [rows.where(f"p = {i}").coalesce(1) for i in range(4)]
    skewed = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    times = []

    def count(exchange, own):
        return len(own)

    B.publish(frames(spark, 10), count)  # workers are up
    with B.Desk.of(spark, 1500) as desk:
        start = time.monotonic()
        B.send_frames(skewed, B.Spec(count, desk.address, "j", 50))
        times.append(time.monotonic() - start)
        assert desk.sent("j") == 3900
    least = (3900 - 150) / 1500
    assert least * 0.99 <= times[0] <= least * 1.05 + 1.5  # and what the job itself takes to start
    with B.Desk.of(spark, 0) as desk:
        start = time.monotonic()
        B.send_frames(skewed, B.Spec(count, desk.address, "j", 50))
        assert time.monotonic() - start < least


def test_jobs_share_a_desk(spark):
    count = lambda exchange, own: len(own)
    with B.Desk.of(spark, 400) as desk:
        start = time.monotonic()
        threads = [threading.Thread(target=B.publish, args=(frames(spark, 400, 2), count, 20), kwargs={"desk": desk, "job": f"j{i}", "tasks": 2}) for i in range(2)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert time.monotonic() - start >= 0.99 * (800 - 40) / 400 and desk.sent("j0") == desk.sent("j1") == 400


def test_a_late_adapter_is_cancelled():
    told = []

    class Slow:
        def __call__(self, exchange, own):
            time.sleep(0.6)
            return len(own)

        def cancel(self):
            told.append(1)

    own = B.Sender(Slow(), 0.1)
    with pytest.raises(RuntimeError, match="no confirmation from x in 0.1 seconds"):
        own("x", ["a"])
    assert told == [1]
    own.close()
