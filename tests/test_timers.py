import json
import logging
import time

import pytest
from pyspark.sql import functions as F

from dumpmill.streaming.timers import LiveStatus, live_stalls, publish_stream, timed_batches, watch_stalls


def land(folder, name, rows):
    """A file that appears whole."""
    (folder.parent / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    (folder.parent / name).rename(folder / name)


def until(check, seconds=60):
    end = time.monotonic() + seconds
    while not (out := check()):
        assert time.monotonic() < end
        time.sleep(0.2)
    return out


@pytest.fixture
def landing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in"


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).json(str(folder))


def test_batches_by_size_and_time(spark, landing, tmp_path):
    rows = [{"data_type": k, "seq": i, "value": f"{k}{i}"} for k, n in (("a", 7), ("b", 1)) for i in reversed(range(n))]
    land(landing, "1.json", [*rows, {"data_type": "b", "seq": None, "value": None}])
    own = timed_batches(stream(spark, landing, "data_type string, seq long, value string"), 3, 1.0, F.lit(0))
    query = own.writeStream.format("memory").queryName("timed").outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").trigger(processingTime="200 milliseconds").start()
    try:
        got = lambda: {(r.data_type, r.number): r for r in spark.table("timed").collect()}
        out = until(lambda: len(got()) == 4 and got())
        assert [out[k].cause for k in (("a", 0), ("a", 1), ("a", 2), ("b", 0))] == ["size", "size", "time", "time"]
        assert sorted(x for k, r in out.items() if k[0] == "a" for x in r.frames) == [f"a{i}" for i in range(7)]
        assert [len(out["a", i].frames) for i in range(3)] == [3, 3, 1] and out["b", 0].frames in (["", "b0"], ["b0", ""])
        land(landing, "2.json", [{"data_type": "a", "seq": 9, "value": "late"}])  # a trickle is flushed too, and numbers go on
        assert until(lambda: got().get(("a", 3))).frames == ["late"]
        assert len(got()) == 5
    finally:
        query.stop()


def test_frames_of_a_stream_reach_the_adapter(spark, landing, tmp_path):
    sent = tmp_path / "sent"
    sent.mkdir()

    def send(name, frames):
        import uuid

        (sent / uuid.uuid4().hex).write_text(json.dumps([name, list(frames)]))
        return len(frames)

    land(landing, "1.json", [{"data_type": "a", "seq": i, "value": str(i)} for i in range(5)])
    query = publish_stream(stream(spark, landing, "data_type string, seq long, value string"), send, f"{tmp_path}/ck", 2, 0.5, "p", lane=F.lit(1), every="200 milliseconds")
    try:
        got = until(lambda: [json.loads(x) for f in sent.iterdir() if (x := f.read_text())] if len(list(sent.iterdir())) >= 3 else None)
    finally:
        query.stop()
    assert {name for name, _ in got} == {"p-a"} and sorted(len(x) for _, x in got) == [1, 2, 2]
    assert sorted(x for _, own in got for x in own) == list("01234")


def test_a_pause_is_one_stall_and_the_next_record_ends_it(spark, landing, tmp_path, caplog):
    land(landing, "1.json", [{"data_type": k, "completed": k == "done"} for k in ("a", "done") for _ in range(3)])
    status = LiveStatus()
    spark.streams.addListener(status)
    with caplog.at_level(logging.INFO, logger="dumpmill"):
        query = watch_stalls(stream(spark, landing, "data_type string, completed boolean"), f"{tmp_path}/ck", status, 2.0, "200 milliseconds")
        try:
            until(lambda: "a" in status.view()["stalled"])
            time.sleep(3)
            assert set(status.view()["stalled"]) == {"a"} and status.view()["streams"]["stalls"]["rows"] == 6
            land(landing, "2.json", [{"data_type": "a", "completed": True}])
            until(lambda: not status.view()["stalled"])
            time.sleep(3)
            assert not status.view()["stalled"]
        finally:
            query.stop()
            spark.streams.removeListener(status)
    told = [r.getMessage().split(",")[0] for r in caplog.records if "records" in r.getMessage()]
    assert told == ["a stalled after 3 records", "a recovered after 4 records"]


def test_an_empty_stream_gives_nothing(spark, landing, tmp_path):
    own = live_stalls(stream(spark, landing, "data_type string, completed boolean"), 0.1)
    query = own.writeStream.format("memory").queryName("empty_stalls").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.table("empty_stalls").count() == 0
