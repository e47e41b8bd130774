"""Files of a version side by side: failures stay with their file, a stop leaves the version open, jobs overlap."""
import json
import threading
import time

import pytest

from dumpmill import run
from dumpmill.operators import state
from dumpmill.operators.status import Config
from tests.test_run import dump, events

ENTITIES = ("artists", "labels", "masters", "releases")


def dumps(folder, records=2):
    return [str(dump(folder, e, f"<{e}>" + "".join(f'<{e[:-1]} id="{i}"><x>y</x></{e[:-1]}>' for i in range(records)) + f"</{e}>")) for e in ENTITIES]


def test_one_broken_file_of_four(spark, tmp_path):
    paths = dumps(tmp_path)
    good = (tmp_path / "cat_20240101_masters.xml.gz").read_bytes()
    (tmp_path / "cat_20240101_masters.xml.gz").write_bytes(b"no gzip at all")
    go = lambda **own: run.run_version(spark, paths, "20240101", f"{tmp_path}/out", f"{tmp_path}/state", **own)
    with pytest.raises(run.FilesFailed) as e:
        go()
    assert set(e.value.errors) == {"cat_20240101_masters.xml.gz"} and len(e.value.done) == 3
    own = state.load_marker(spark, f"{tmp_path}/state", "20240101")
    assert {n: f.status for n, f in own.files.items()} == {f"cat_20240101_{x}.xml.gz": state.FAILED if x == "masters" else state.DONE for x in ENTITIES}
    assert own.files["cat_20240101_masters.xml.gz"].error and own.phases["processing"].status == state.FAILED and own.status != state.DONE
    assert own.decide() == state.CONTINUE and "masters" in own.phases["processing"].errors[0]
    assert not [x for x in events(spark, f"{tmp_path}/out", "artists") if x["type"] == "extraction_complete"]
    (tmp_path / "cat_20240101_masters.xml.gz").write_bytes(good)
    assert go() == {"cat_20240101_masters.xml.gz": 2}  # only what failed
    own = state.load_marker(spark, f"{tmp_path}/state", "20240101")
    assert own.status == state.DONE and own.files["cat_20240101_masters.xml.gz"].error is None
    assert [x["record_counts"] for x in events(spark, f"{tmp_path}/out", "labels") if x["type"] == "extraction_complete"] == [dict.fromkeys(ENTITIES, 2)]
    assert not list((tmp_path / "out/_work").iterdir())


def test_a_stop_leaves_the_version_open(spark, tmp_path):
    paths, asked, lock = dumps(tmp_path), [], threading.Lock()

    def stop():
        with lock:
            asked.append(1)
            return len(asked) > 2

    done = run.run_version(spark, paths, "20240101", f"{tmp_path}/out", f"{tmp_path}/state", stop=stop, config=Config(workers=2))
    own = state.load_marker(spark, f"{tmp_path}/state", "20240101")
    assert len(done) == 2 and own.status != state.DONE and sorted(n for n, f in own.files.items() if f.status == state.DONE) == sorted(done)
    assert {f.status for n, f in own.files.items() if n not in done} == {state.PENDING}
    assert not [x for e in ENTITIES for x in events(spark, f"{tmp_path}/out", e) if x["type"] == "extraction_complete"]
    rest = run.run_version(spark, paths, "20240101", f"{tmp_path}/out", f"{tmp_path}/state")
    assert set(rest) | set(done) == {p.rsplit("/", 1)[-1] for p in paths} and not set(rest) & set(done)


@pytest.mark.parametrize("workers", [1, 3])
def test_jobs_overlap_and_keep_their_tags(spark, workers):
    now, most, tags, lock = set(), [], {}, threading.Lock()

    def job(name):
        with lock:
            now.add(name)
            most.append(len(now))
            tags[name] = (set(spark.sparkContext.getJobTags()), spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        time.sleep(0.2)
        with lock:
            now.discard(name)
        if name == "c":
            raise ValueError("x")
        return 1

    done, errors = run._side_by_side(spark, {n: lambda n=n: job(n) for n in "abcde"}, workers)
    assert done == dict.fromkeys("abde", 1) and set(errors) == {"c"} and max(most) == workers
    assert tags == {n: ({f"dumpmill:{n}"}, n) for n in "abcde"}


def test_the_marker_is_whole_at_any_time(spark, tmp_path):
    held = run._Held(spark, str(tmp_path), state.Marker("v"))
    threads = [threading.Thread(target=lambda i=i: [held(lambda m, k=k: m.complete_file(f"{i}-{k}", k, k)) for k in range(8)]) for i in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(state.load_marker(spark, str(tmp_path), "v").files) == 40


def test_a_download_that_fails_names_its_file(spark, tmp_path):
    paths = [*dumps(tmp_path), f"{tmp_path}/cat_20240101_gone.xml.gz"]
    with pytest.raises(run.FilesFailed, match="cat_20240101_gone"):
        run.run_version(spark, paths, "20240101", f"{tmp_path}/out", f"{tmp_path}/state")
    assert json.loads((tmp_path / "state/state_20240101.json").read_text())["phases"]["download"]["status"] == state.FAILED


def test_writers_of_one_folder_do_not_disturb_each_other(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.sql import functions as F

    from dumpmill.sinks.events import write_events

    def one(i):
        rows = spark.range(i * 100, i * 100 + 100, 1, 3).select(F.lit("labels" if i % 2 else "artists").alias("data_type"), F.col("id").cast("string").alias("value"))
        write_events(rows, f"{tmp_path}/out")

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(one, range(12)))
    own = spark.read.text(f"{tmp_path}/out")
    assert sorted(int(r.value) for r in own.collect()) == list(range(1200)) and {r.exchange for r in own.collect()} == {"catalog-labels", "catalog-artists"}
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("_")]
