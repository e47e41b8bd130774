import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from dumpmill.operators import report, state
from dumpmill.operators.status import Config
from dumpmill.plans.policy import parse_policy
from dumpmill.run import process_file, run_manifest, run_version
from dumpmill.sinks import events as E
from dumpmill.sources import files
from dumpmill.sources.manifest import ManifestError, parse_manifest
from dumpmill.streaming.ingest import ingest_stream

RELEASES = """<releases><release id="r1" status="Accepted"><title>One</title><released>0400-01-01</released>
<genres><genre>Rock</genre><genre>12</genre></genres><labels><label id="5" name="L" catno="PB 1"/></labels>
<formats><format name="Vinyl" qty="1" text=""><descriptions><description>LP</description></descriptions></format></formats>
<identifiers><identifier type="Barcode" value="1-2"/></identifiers></release>
<release id="r2"><title/><genres><genre>Odd</genre></genres><notes>keep me</notes></release>
<release id="r3"><title>do not use this</title></release></releases>"""
POLICY = parse_policy({
    "skip_records": {"releases": [{"field": "title", "contains": "DO NOT USE", "reason": "junk"}]},
    "filters": {"releases": [{"field": "genres.genre", "remove_matching": r"^\d+$", "reason": "numeric"},
                             {"field": "released", "nullify_when": {"type": "range", "below": 1860}, "reason": "date"}]},
    "rules": {"releases": [{"name": "missing-title", "field": "title", "severity": "error", "condition": {"type": "required"}},
                           {"name": "genre", "field": "genres.genre", "severity": "warning", "condition": {"type": "enum", "values": ["Rock"]}}]}})


def dump(folder, entity="releases", text=RELEASES, version="20240101"):
    path = folder / f"cat_{version}_{entity}.xml.gz"
    path.write_bytes(gzip.compress(text.encode(), mtime=0))
    return path


def events(spark, out, entity="releases"):
    return [json.loads(r.value) for r in spark.read.text(f"{out}/events").where(f"exchange = 'catalog-{entity}'").select("value").collect()]


def test_one_file(spark, tmp_path):
    path = dump(tmp_path)
    assert process_file(spark, str(path), f"{tmp_path}/out", POLICY) == ("releases", 3, 2)
    own = {e.get("id", e["type"]): e for e in events(spark, f"{tmp_path}/out")}
    assert set(own) == {"r1", "r2", "file_complete"}
    r1 = own["r1"]
    assert r1["released"] is None and r1["genres"] == ["Rock"] and r1["labels"] == [{"id": "5", "name": "L", "catno": "PB 1"}]
    assert r1["media"]["items"][0]["medium"] == "vinyl_12" and r1["identifiers"]["aliases"] == [
        {"provider": "barcode", "external_id": "12"}, {"provider": "catalog_number", "external_id": "PB 1"}]
    body = {k: v for k, v in r1.items() if k not in ("type", "sha256")}
    assert r1["sha256"] == hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":")).encode()).hexdigest() and r1["type"] == "data"
    assert own["r2"]["notes"] == "keep me" and own["r2"]["title"] is None
    assert own["file_complete"]["total_processed"] == 3 and own["file_complete"]["file"] == path.name
    flagged = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out/flagged/violations").collect()]
    assert {(f["record_id"], f["rule"], f["field_value"]) for f in flagged} == {("r2", "missing-title", ""), ("r2", "genre", "Odd")}
    skipped = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out/flagged/skipped").collect()]
    assert [(s["record_id"], s["reason"]) for s in skipped] == [("r3", "junk")]
    assert {r.name for r in spark.read.json(f"{tmp_path}/out/flagged/captures").collect()} == {"r2", "r3"}
    text = (tmp_path / "out/flagged/report_releases.txt").read_text()
    assert "releases: 3 records" in text and "releases: 3 records, 1 errors, 1 warnings" in text and "missing-title: 1 errors" in text and "skipped: 1 junk (r3)" in text and "repaired: 1 values in 1 records of released" in text


def test_manifest(spark, tmp_path):
    path = dump(tmp_path)
    own = {"contract": "catalog-dump/v1", "version": "20240101", "data_type": "releases", "scope": "single-file", "file": path.name, "media_type": "application/gzip",
           "sha256": hashlib.sha256(path.read_bytes()).hexdigest()}
    (tmp_path / "m.json").write_text(json.dumps(own))
    assert run_manifest(spark, f"{tmp_path}/m.json", f"{tmp_path}/out") == ("releases", 3, 3)
    done = [e for e in events(spark, f"{tmp_path}/out", "artists") if e["type"] == "extraction_complete"]
    assert len(done) == 1 and done[0]["record_counts"] == {"releases": 3} and done[0]["version"] == "20240101"
    for change in ({"file": "../x"}, {"file": "cat_20240102_releases.xml.gz"}, {"contract": "v2"}, {"sha256": "x"}, {"scope": "all"}, {"extra": "1"}, {"media_type": 5}):
        with pytest.raises(ManifestError):
            parse_manifest(json.dumps(own | change), ".")
    (tmp_path / "m.json").write_text(json.dumps(own | {"sha256": "0" * 64}))
    with pytest.raises(ManifestError):
        run_manifest(spark, f"{tmp_path}/m.json", f"{tmp_path}/out2")


def test_versions_resume(spark, tmp_path):
    paths = [str(dump(tmp_path)), str(dump(tmp_path, "artists", "<artists><artist><id>a</id></artist></artists>"))]
    state_dir = f"{tmp_path}/state"
    marker = state.Marker("20240101")
    marker.start_file("cat_20240101_releases.xml.gz")
    marker.complete_file("cat_20240101_releases.xml.gz", 3, 3)
    marker.phases["download"].start()  # cut off while files were checked: completed files stay
    state.save_marker(spark, state_dir, marker)
    run = lambda **own: run_version(spark, paths, "20240101", f"{tmp_path}/out", state_dir, **own)
    assert run(stop=lambda: True) == {} and state.load_marker(spark, state_dir, "20240101").status == state.PENDING
    assert run() == {"cat_20240101_artists.xml.gz": 1}
    assert run() == {}
    got = [e for e in events(spark, f"{tmp_path}/out", "masters")]
    assert len(got) == 1 and got[0]["record_counts"] == {"artists": 1, "releases": 3} and got[0]["started_at"] == marker.started_at
    assert not (tmp_path / "out/_work").exists() or not list((tmp_path / "out/_work").iterdir())
    dump(tmp_path, "artists", "<artists><artist><id>b</id></artist><artist><id>c</id></artist></artists>")  # other bytes of a complete version
    assert run() == {"cat_20240101_artists.xml.gz": 2}
    assert sorted(e["id"] for e in events(spark, f"{tmp_path}/out", "artists") if e["type"] == "data") == ["a", "b", "c"]
    (tmp_path / "cat_20240101_artists.xml.gz").unlink()
    with pytest.raises(Exception):  # noqa: B017
        run(force=True)
    failed = state.load_marker(spark, state_dir, "20240101")
    assert failed.phases["download"].status == state.FAILED and failed.decide() == state.REPROCESS


def test_marker():
    m = state.Marker("v")
    assert m.decide() == state.CONTINUE
    m.start_file("a")
    assert m.decide() == state.CONTINUE and m.pending(["a", "b"]) == ["a", "b"]
    m.file_verified("a", "h1")
    m.complete_file("a", 5, 4)
    assert m.pending(["a", "b"]) == ["b"] and m.totals() == (5, 4)
    for status in (state.FAILED, state.RUNNING):
        m.phases["download"].status = status
        assert m.decide() == state.CONTINUE and state.Marker("v", phases={**m.phases}).decide() == state.REPROCESS
    m.phases["download"].finish()
    m.complete()
    assert m.decide() == state.SKIP and m.decide(force=True) == state.REPROCESS
    assert state.Marker.from_json(m.to_json(), "v").to_json() == m.to_json()
    for broken in (None, "", "{", "[]", "{\"version\": \"v\"}", m.to_json()[:40]):
        assert state.Marker.from_json(broken, "v").files == {}
    assert state.Marker.from_json(m.to_json(), "w").status == state.PENDING
    assert not m.file_verified("a", "h1") and m.file_verified("a", "h2") and m.pending(["a"]) == ["a"]
    assert m.totals() == (0, 0) and m.decide() == state.CONTINUE and m.phases["processing"].status == state.RUNNING
    m.complete_file("b", 1, 1)  # completed before hashes were noted
    assert not m.file_verified("b", "h3") and m.pending(["b"]) == []


def test_text_survives_a_crash_between_its_two_steps(spark, tmp_path):
    E.write_text(spark, f"{tmp_path}/m.json", "one")
    E.write_text(spark, f"{tmp_path}/m.json", "two")
    assert E.read_text(spark, f"{tmp_path}/m.json") == "two" and not (tmp_path / "m.json.part").exists()
    (tmp_path / "m.json").rename(tmp_path / "m.json.part")
    assert E.read_text(spark, f"{tmp_path}/m.json") == "two" and E.read_text(spark, f"{tmp_path}/other") is None


def test_run_through_an_adapter(spark, tmp_path):
    """Every frame reaches its exchange, in order within a batch, at the size of the settings; completions follow the data."""
    path, box = dump(tmp_path), tmp_path / "box"
    box.mkdir()
    folder = str(box)

    def send(exchange, frames):
        import os
        import uuid

        with open(os.path.join(folder, f"{exchange}-{uuid.uuid4().hex}"), "w") as f:
            f.write("\n".join(frames))
        return len(frames)

    config = Config(batch_size=1, rate=1000, checkpoint_every=1, prefix="p", provider="q")
    done = run_version(spark, [str(path)], "20240101", f"{tmp_path}/out", f"{tmp_path}/state", config=config, publish=send)
    assert done == {path.name: 3}
    got = [(f.name.rsplit("-", 1)[0], [json.loads(x) for x in f.read_text().split("\n")]) for f in box.iterdir()]
    assert all(len(frames) == 1 for _, frames in got)
    kinds = sorted((name, frames[0]["type"]) for name, frames in got)
    assert kinds == sorted([("p-releases", "data")] * 3 + [("p-releases", "file_complete")] + [(f"p-{e}", "extraction_complete") for e in ("artists", "labels", "masters", "releases")])
    assert {f[0]["media"]["items"][0]["source"]["provider"] for _, f in got if f[0].get("id") == "r1"} == {"q"}


def test_newest_version_of_a_folder(spark, tmp_path):
    from dumpmill.run import run_latest
    from dumpmill.sources import FolderSource

    for entity in ("artists", "labels", "masters", "releases"):
        one = entity[:-1]
        path = dump(tmp_path, entity, f"<{entity}><{one} id=\"1\"><x>y</x></{one}></{entity}>")
    assert FolderSource(spark, str(tmp_path)).latest() is None
    assert run_latest(spark, FolderSource(spark, str(tmp_path)), f"{tmp_path}-out", f"{tmp_path}-state") == {}
    (tmp_path / "cat_20240101_CHECKSUM.txt").write_text(f"{hashlib.sha256(path.read_bytes()).hexdigest()} *{path.name}\n")
    source = FolderSource(spark, str(tmp_path))
    assert source.latest() == "20240101" and len(source.paths("20240101")) == 4
    assert files.verified(spark, str(path), source.checksums("20240101")).head().ok
    done = run_latest(spark, source, f"{tmp_path}-out", f"{tmp_path}-state")
    assert len(done) == 4 and set(done.values()) == {1}


def test_files(spark, tmp_path):
    names = [(f"cat_{v}_{k}", v) for v, n in (("20240101", 5), ("20240201", 4), ("20240301", 6)) for k in ["artists.xml.gz", "labels.xml.gz", "masters.xml.gz", "releases.xml.gz", "CHECKSUM.txt", "x.txt"][:n]]
    df = spark.createDataFrame(names, "file string, version string")
    assert {r.version for r in files.latest_complete(df).collect()} == {"20240101"}
    assert {r.checksum_file for r in files.checksum_file(df.where("version = '20240101'")).collect()} == {"cat_20240101_CHECKSUM.txt"}
    page = spark.createDataFrame([('<a href="2023/">2023/</a><a href="2024/">x</a><a href="2022/">y</a><a href="?f=data%2Fcat_20240101_artists.xml.gz">z</a>',)], "html string")
    assert [tuple(r) for r in files.listing(page).collect()] == [("cat_20240101_artists.xml.gz", "20240101")]
    assert {r.year for r in files.newest_years(page).collect()} == {"2023", "2024"}
    h = "AB" * 32
    lines = spark.createDataFrame([(f"{h}  a/b.gz",), (f"{h} *c.gz",), ("zz  d.gz",), ("",)], "value string")
    assert {tuple(r) for r in files.checksum_lines(lines).collect()} == {("b.gz", h.lower()), ("c.gz", h.lower())}
    path = dump(tmp_path)
    own = spark.createDataFrame([(path.name, hashlib.sha256(path.read_bytes()).hexdigest())], "file string, sha256 string")
    assert files.verified(spark, str(path), own).head().ok
    (tmp_path / "sums.txt").write_text("nothing\n")
    with pytest.raises(ValueError):
        files.read_checksums(spark, f"{tmp_path}/sums.txt")
    want = spark.createDataFrame([("a", "1", True), ("b", "1", False), ("c", "1", True), ("d", "1", True)], "file string, sha256 string, landed boolean")
    known = spark.createDataFrame([("a", "1"), ("c", "2")], "file string, checksum string")
    assert {tuple(r) for r in files.to_fetch(want, known).collect()} == {("b", "missing"), ("c", "changed"), ("d", "unknown")}
    done = spark.createDataFrame([("a", "0"), ("c", "1")], "file string, sha256 string")
    assert {r.file for r in state.pending_files(want, done).collect()} == {"b", "d"} and [r.file for r in state.changed_files(want.select("file", "sha256"), done).collect()] == ["a"]
    rows = spark.createDataFrame([("a", 1, "x")], "file string, ts int, s string")
    assert {tuple(r) for r in state.upserted(rows, spark.createDataFrame([("a", 2, "y"), ("b", 1, "z")], rows.schema)).collect()} == {("a", 2, "y"), ("b", 1, "z")}


def test_publish_fails_on_unconfirmed(spark):
    df = spark.createDataFrame([("t", "f", i, str(i)) for i in range(25)], "data_type string, file string, seq long, value string")
    count = lambda exchange, frames: len(frames)
    assert E.publish(df, count, 10) == 25 and E.publish(df, count, 10, tasks=4) == 25
    with pytest.raises(Exception, match="not confirmed"):
        E.publish(df, lambda exchange, frames: len(frames) - 1, 10)
    import time

    with pytest.raises(RuntimeError, match="no confirmation from x in 0.2 seconds"):
        E.confirmed(lambda exchange, frames: time.sleep(1), "x", ["a"], 0.2)
    for tasks in (1, 4):  # the rate is that of all tasks together
        start = time.time()
        assert E.publish(df, count, 5 if tasks == 1 else 2, rate=25, tasks=tasks) == 25 and time.time() - start > 0.7
    assert E.exchange("p", "artists") == "p-artists" and E.queue("p", "artists", "c") == "p-artists-c"


def test_completion_goes_to_all_before_errors_are_raised(spark):
    df = spark.createDataFrame([(e, "x") for e in ("artists", "labels", "masters", "releases")], "data_type string, value string")
    heard = []

    def send(exchange, frames):
        heard.append(exchange)
        if exchange.endswith(("artists", "masters")):
            raise OSError("closed")
        return 1

    with pytest.raises(RuntimeError, match="2 exchange.*artists: closed; masters: closed"):
        E.publish_completion(df, send, "p")
    assert heard == ["p-artists", "p-labels", "p-masters", "p-releases"]


def test_report_parts(spark):
    a = spark.createDataFrame([("t", "r", 1, 0, 0)], "data_type string, rule string, errors long, warnings long, infos long")
    both = report.merged([a, a], ["data_type", "rule"])
    assert both.head().errors == 2
    none = spark.createDataFrame([], "data_type string, reason string, skipped long, ids string")
    repairs = spark.createDataFrame([("t", "f", "r", 1, 2)], "data_type string, field string, reason string, records long, values long")
    assert tuple(report.flags(both, none, repairs).head()) == (True, False, True)
    progress = spark.sql("select 'a' as data_type, timestamp'2024-01-01 00:00:00' as ts, false as completed union all select 'b', timestamp'2024-01-01 00:00:00', true")
    assert [r.data_type for r in report.stalled(progress, F.lit("2024-01-01 00:02:01").cast("timestamp")).collect()] == ["a"]
    assert report.stalled(progress, F.lit("2024-01-01 00:02:00").cast("timestamp")).count() == 0


def test_stream_takes_files_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    dump(tmp_path / "in", "artists", "<artists><artist><id>a</id></artist></artists>")
    seen = []
    go = lambda: ingest_stream(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", lambda p, n: seen.append(n)).awaitTermination(120)
    assert go() and seen == [1]
    dump(tmp_path / "in", "artists", "<artists><artist><id>b</id></artist><artist><id>c</id></artist></artists>", "20240201")
    assert go() and seen == [1, 2]
    assert sorted(e["id"] for e in events(spark, f"{tmp_path}/out", "artists") if e["type"] == "data") == ["a", "b", "c"]


def test_shipped_policy(spark):
    from dumpmill.plans.policy import lint_policy
    from dumpmill.plans.shipped import shipped_policy
    from dumpmill.run import prepare

    policy = shipped_policy()
    sizes = {k: sum(len(getattr(e, k)) for e in policy.entities.values()) for k in ("skips", "filters", "rules")}
    assert sizes == {"skips": 2, "filters": 5, "rules": 7} and lint_policy(policy) == []
    raw = {
        "releases": {"@id": "1", "genres": {"genre": ["Skiffle", "7"]}, "released": "1700-01-01", "year": "3000", "formats": {"format": {"@name": "Wax"}},
                     "identifiers": {"identifier": [{"@type": "Odd", "@value": "1"}]}, "companies": {"company": {"name": "n", "entity_type_name": "Blessed By"}}},
        "artists": {"id": "2", "name": None}, "labels": {"id": "3"}, "masters": {"@id": "4", "year": "1200", "genres": {"genre": "12"}}}
    fired = {}
    for entity, tree in raw.items():
        df = spark.createDataFrame([("f", entity, 0, "x", json.dumps(tree))], "file string, data_type string, seq long, id string, j string")
        df = df.select("file", "data_type", "seq", "id", F.parse_json("j").cast("map<string,variant>").alias("data"), F.lit(None).cast("string").alias("error"))
        row = prepare(df, entity, policy).checked.head()
        fired[entity] = ([v.rule for v in row.violations], [a.field for a in row.actions])
    assert fired == {
        "releases": (["missing-title", "genre-not-recognized", "format-not-recognized", "identifier-type-not-recognized", "company-role-not-recognized"], ["genres.genre", "released", "year"]),
        "artists": (["empty-artist-name"], []), "labels": (["empty-label-name"], []), "masters": ([], ["genres.genre", "year"])}


def test_settings_and_snapshots(tmp_path):
    from dumpmill.operators.status import snapshot

    (tmp_path / "name").write_text("secret\n")
    assert Config.from_env({"DUMPMILL_PREFIX_FILE": f"{tmp_path}/name"}) == Config(prefix="secret")
    assert Config.from_env({"DUMPMILL_RATE": "0", "DUMPMILL_BATCH_SIZE": "x", "DUMPMILL_PREFIX": "p"}) == Config(rate=0, prefix="p")
    assert Config.from_env({"DUMPMILL_RATE": "-5", "DUMPMILL_WORKERS": "0"}) == Config(workers=1) and Config.from_env({"DUMPMILL_RATE": "inf"}) == Config.from_env({"DUMPMILL_RATE": "x"}) == Config()
    assert Config.from_env({"DUMPMILL_RATE": "2.5", "DUMPMILL_WORKERS": "7"}) == Config(rate=2.5, workers=7)
    assert snapshot(None)["status"] == "idle" and snapshot(None, "broken")["status"] == "failed"
    m = state.Marker("v")
    assert snapshot(m)["status"] == "waiting"
    m.start_file("c_20240101_artists.xml.gz")
    assert snapshot(m)["status"] == "in_progress"
    m.complete_file("c_20240101_artists.xml.gz", 5, 5)
    m.complete()
    assert snapshot(m)["status"] == "completed" and snapshot(m)["progress"] == {"artists": 5, "total": 5}


def test_runs_are_due():
    from datetime import datetime, timedelta

    from dumpmill.streaming.ingest import due

    now = datetime(2024, 3, 1)
    assert due(None, now) and due(now, now, asked=True) and due(now - timedelta(days=15), now) and not due(now - timedelta(days=14), now)


def test_vocabularies_are_unchanged():
    from dumpmill.operators.blocks import changed_vocabularies

    assert changed_vocabularies() == []


def test_vocabularies_are_closed():
    from dumpmill.operators.blocks import vocabulary

    ids, media = vocabulary("identifier_types"), vocabulary("media_taxonomy")
    types = {t["id"] for t in ids["types"]}
    assert set(ids["raw"].values()) | {ids["unmapped"]} <= types and all(n["type"] in types for n in ids["namespaces"])
    assert len(media["formats"]) == 51 and all(f["provenance"] in ("fixture", "authored") for f in media["formats"].values())
    assert {f["medium"] for f in media["formats"].values() if f.get("medium")} <= set(media["media"])
