import gzip
import json

import pytest
from pyspark.sql import functions as F

from dumpmill.sources import catalog as C
from dumpmill.sources.xml import parse_record, read_dump


def dump(folder, name, body, members=1):
    data, step = body.encode() if isinstance(body, str) else body, 0
    step = -(-len(data) // members)
    (folder / name).write_bytes(b"".join(gzip.compress(data[i : i + step]) for i in range(0, len(data), step)))


ARTISTS = "".join(f"<artist><id>{i}</id><name>N{i} é</name><urls><url>u{i}</url><url>v</url></urls><profile/></artist>" for i in range(3000))
ODD = ("<artist id='a&amp;b'><name>x</name></artist><artist><id><![CDATA[7]]></id><name i='1'>y</name></artist><artist><id>&#56;</id></artist>"
       "<artist><name>lost</artist><artist>only text</artist><artist><other><name>deep</name></other></artist><artist/>")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    own = tmp_path_factory.mktemp("dumps")
    dump(own, "cat_20240101_artists.xml.gz", f"<artists>{ARTISTS}{ODD}</artists>", members=3)
    dump(own, "cat_20240201_artists.xml.gz", b"<artists><artist><id>z</id><name>bad \xff byte</name></artist></artists>")
    dump(own, "cat_20240101_labels.xml.gz", '<labels><label id="1"><name>L</name><sublabels><label id="2">S</label></sublabels></label></labels>')
    (own / "readme.txt").write_text("no dump")
    C.register(spark)
    return own


def load(spark, path, schema=C.SCHEMA, **options):
    reader = spark.read.format("catalogxml").schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(str(path))


@pytest.mark.parametrize("splits", [1, 3])
def test_the_same_records_as_the_text_reader(spark, folder, splits):
    got = load(spark, folder, splits=splits).where("version = '20240101' and data_type = 'artists'")
    want = read_dump(spark, f"{folder}/cat_20240101_artists.xml.gz", "artists")
    want = want.select("seq", "id", F.to_json(F.to_variant_object("data")).alias("json"), F.col("error").isNotNull().alias("bad"))
    norm = lambda rows: sorted((r.seq, r.id, r.json and json.dumps(json.loads(r.json), sort_keys=True), r.bad) for r in rows)
    got = norm(got.select("seq", "id", "json", F.col("error").isNotNull().alias("bad")).collect())
    assert got == norm(want.collect()) and len(got) > 3000 and sum(g[3] for g in got) == 1


def test_fields_that_are_not_named_are_not_built(spark, folder):
    xml = "<a i='1'><id>5</id><big><id>6</id><x>t</x>u</big>p<name>n</name><big/>q</a>"
    assert parse_record(xml, frozenset(["id", "name"])) == {"@i": "1", "id": "5", "name": "n", "#text": "pq"}
    df = load(spark, folder, "id string, name string, urls string, profile string, `@id` string, missing string").where("name is not null")
    rows = {r.id: r for r in df.collect()}
    assert rows["17"].name == "N17 é" and json.loads(rows["17"].urls) == {"url": ["u17", "v"]} and rows["17"].profile is rows["17"].missing is None
    assert rows["a&b"]["@id"] == "a&b" and json.loads(rows["7"].name) == {"@i": "1", "#text": "y"} and rows["z"].name == "bad � byte"
    assert load(spark, folder, "id string").where("id = 'unknown'").count() == 1  # a record of fields that are not named stays one


def test_conditions_reach_the_source(spark, folder):
    reader = C.CatalogReader(load(spark, folder).schema, {"path": str(folder)})
    attr = lambda cls, name, value: cls((name,), value)
    kept = list(reader.pushFilters([attr(C.EqualTo, "version", "20240101"), attr(C.In, "data_type", ("artists", "masters")), attr(C.EqualTo, "id", "17"), attr(C.EqualTo, "error", "x")]))
    assert [f.attribute[0] for f in kept] == ["id", "error"]
    assert [(p.path.rsplit("/", 1)[-1], p.ids) for p in reader.partitions()] == [("cat_20240101_artists.xml.gz", ("17",))]
    seen = []
    for xml in ("<a><id>17</id></a>", "<a><id>18</id></a>", "<a><id>&#49;7</id></a>", "<a><id>1<!-- -->7</id></a>"):
        seen.append(C._may_have(xml, ("17",)))
    assert seen == [True, False, True, True]
    df = load(spark, folder)
    assert [r.id for r in df.where("id in ('17', '7', 'a&b', '8', 'nobody')").orderBy("id").collect()] == ["17", "7", "7", "8", "8", "a&b"]
    assert df.where("id = 'unknown'").count() == 1 and df.where("version = '1999'").count() == 0
    assert df.where("data_type in ('labels', 'masters')").select("id").collect()[0][0] == "1"


def test_modes_and_refusals(spark, folder):
    assert load(spark, folder).where("error is not null").count() == 1
    assert load(spark, folder, mode="dropmalformed").where("error is not null").count() == 0
    with pytest.raises(Exception, match="MalformedRecordError"):
        load(spark, folder, mode="FAILFAST").collect()
    for options, schema, text in (({"mode": "x"}, C.SCHEMA, "mode is one of"), ({"splits": 0}, C.SCHEMA, "splits"), ({}, "id int", "columns are strings")):
        with pytest.raises(Exception, match=text):
            load(spark, folder, schema, **options).collect()
    with pytest.raises(Exception, match="FileNotFoundError"):
        load(spark, f"{folder}/none").collect()


def test_records_go_on_into_the_policy_and_events(spark, folder):
    from dumpmill.run import prepare

    own = C.with_data(load(spark, folder).where("data_type = 'labels'")).withColumn("raw_xml", F.lit(None).cast("string"))
    assert [(r.id, r.data_type) for r in prepare(own, "labels").records.collect()] == [("1", "labels")]


def test_pieces_across_chunks(folder, monkeypatch):
    whole = list(C.records(C.list_dumps(f"file://{folder}/cat_20240101_labels.xml.gz")[0]))
    monkeypatch.setattr(C, "CHUNK", 3)
    assert list(C.records(C.list_dumps(str(folder))[1])) == whole and whole[0][2] is None and len(whole) == 1


def test_a_stream_takes_each_dump_once_also_one_that_lands_late(spark, folder, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    got = []

    def run():
        stream = spark.readStream.format("catalogxml").schema("file string, id string, name string").load(str(landing))
        query = stream.writeStream.foreachBatch(lambda df, n: got.extend(r.id for r in df.collect())).option("checkpointLocation", str(tmp_path / "c"))
        query.trigger(availableNow=True).start().awaitTermination()

    body = lambda i: f"<artists><artist><id>{i}</id><name>n</name></artist></artists>"
    dump(landing, "cat_20240301_artists.xml.gz", body("b"))
    run()
    assert got == ["b"]
    run()
    dump(landing, "cat_20240101_artists.xml.gz", body("a"))
    dump(landing, "cat_20240401_artists.xml.gz", body("c"))
    run()
    assert sorted(got) == ["a", "b", "c"]


def test_faults_of_manifests_are_those_that_reading_one_refuses(spark):
    from dumpmill.sources import manifest as M

    good = {"contract": M.CONTRACT, "version": "20240101", "data_type": "labels", "scope": M.SCOPE, "file": "a/cat_20240101_labels.xml.gz", "media_type": M.MEDIA, "sha256": "a" * 64}
    cases = [(good, None), (good | {"contract": "x"}, "contract"), (good | {"scope": ""}, "scope"), (good | {"media_type": "x"}, "media_type"), (good | {"more": "1"}, "fields"),
             (good | {"version": 20240101}, "fields"), ({k: v for k, v in good.items() if k != "scope"}, "fields"), (good | {"version": "20240102"}, "name"),
             (good | {"file": "cat_20240101_labels.xml.gz\n"}, "name"), (good | {"sha256": "A" * 64}, "sha256"), (good | {"sha256": "a" * 64 + "\n"}, "sha256")]
    cases += [(good | {"file": f}, "path") for f in ("/a", "../cat_20240101_labels.xml.gz", "a//b", "a\\b", "s3://x", "", "./a")]
    rows = [(json.dumps(c), want) for c, want in cases] + [(f" {json.dumps(good, indent=1)}\n", None), (json.dumps(good) + "}", "json"), (json.dumps(good | {"contract": 'a"\\}'}), "contract"), ("{", "json"), ("", "json"), (None, "json"), ("[]", "fields"), ("null", "fields"), ('"x"', "fields")]
    got = [r.fault for r in spark.createDataFrame(rows, "t string, want string").coalesce(1).select(M.manifest_fault(F.col("t")).alias("fault")).collect()]
    assert got == [w for _, w in rows]
    for text, want in rows:
        if want is None:
            assert M.parse_manifest(text, ".").data_type == "labels"
        else:
            with pytest.raises(M.ManifestError):
                M.parse_manifest(text or "", ".")
