import gzip
import json

import pytest
from pyspark.sql import functions as F

from dumpmill.sources.xml import Assembler, TooManyFaults, check_faults, parse_record, read_dump, rejects, to_xml


def tree(body):
    return parse_record(f"<r>{body}</r>")


@pytest.mark.parametrize(("xml", "want"), [
    ("<a>x</a>", {"a": "x"}), ("<a> x </a>", {"a": " x "}), ("<a>  </a>", {"a": None}), ("<a/>", {"a": None}), ("<a>1</a><a>2</a>", {"a": ["1", "2"]}),
    ("<a i='1'>t</a>", {"a": {"@i": "1", "#text": "t"}}), ("<a i='1'/>", {"a": {"@i": "1"}}), ("p<a>x</a>q", {"a": "x", "#text": "pq"}),
    ("<a>Tom & Jerry</a>", {"a": "Tom & Jerry"}), ("<a>&lt;&#65;&#x42;&odd;&amp;</a>", {"a": "<AB&odd;&"}), ("<a>&#0;&#xZZ;</a>", {"a": "��"}),
    ("<a><![CDATA[x & <y>]]>z</a>", {"a": "x & <y>z"}), ("<a i='&quot;&#65; & b'/>", {"a": {"@i": "\"A & b"}}), ("<a><b><c/><c>1</c></b></a>", {"a": {"b": {"c": [None, "1"]}}}),
    ("<!-- & --><a>x</a>", {"a": "x"}),
])
def test_trees(xml, want):
    assert tree(xml) == want


def test_written_xml_parses_to_the_same_tree():
    own = tree("<a i='1'>t &amp; u</a><b><c>1</c><c>2</c></b><d/>")
    assert parse_record(to_xml("r", own)) == own


def feed(name, text):
    own, out = Assembler(name), []
    pieces = text.split(f"</{name}>")
    for i, p in enumerate(pieces):
        out += own.feed(p, i == len(pieces) - 1)
    return out


def test_assembler():
    nested = "<labels><label><id>1</id><sublabels><label id=\"2\">S</label><label id=\"3\"/></sublabels></label><label id=\"4\"/><label><id>5</id></label></labels>"
    assert [x for x, e in feed("label", nested) if not e] == [
        "<label><id>1</id><sublabels><label id=\"2\">S</label><label id=\"3\"/></sublabels></label>", "<label id=\"4\"/>", "<label><id>5</id></label>"]
    got = feed("release", "<releases><release id='1'><title>a</title><release id='2'><t>b</t></release><releaseX/><release id='3'>")
    assert [e for _, e in got] == ["no end tag", None, "no end tag"] and got[1][0] == "<release id='2'><t>b</t></release>"


def dump(folder, name, text):
    path = folder / name
    path.write_bytes(gzip.compress(text if isinstance(text, bytes) else text.encode()))
    return str(path)


def test_read_dump(spark, tmp_path):
    body = "".join(f"<artist><id>{i}</id><name>N{i}</name></artist>\n" for i in range(3000))
    odd = b"<artist><id>b1</id><name>x</nome></artist><artist><id>b2</id><name>\xe9 \xff</name></artist><artist>text</artist><artist/><artist id=\"c\"><id>9</id></artist>"
    dump(tmp_path, "cat_20240101_artists.xml.gz", b"<artists>" + body.encode() + odd + b"</artists>")
    dump(tmp_path, "cat_20240201_artists.xml.gz", "<artists><artist><id>z</id></artist></artists>")
    df = read_dump(spark, str(tmp_path), "artists", capture_raw=True).cache()
    good = df.where("error is null")
    assert good.count() == 3003 and df.where("error is not null").count() == 1
    assert good.where("version = '20240101'").agg(F.max("seq")).head()[0] == 3004
    rows = {r.id: r for r in good.select("id", F.to_json(F.to_variant_object("data")).alias("j"), "raw_xml", "version", "data_type").collect()}
    assert json.loads(rows["17"].j) == {"id": "17", "name": "N17"} and rows["17"].raw_xml == "<artist><id>17</id><name>N17</name></artist>"
    assert json.loads(rows["b2"].j)["name"] == "� �" and json.loads(rows["c"].j) == {"@id": "c"}
    assert (rows["z"].version, rows["z"].data_type) == ("20240201", "artists")
    assert list(check_faults(df).values()) == [1]
    with pytest.raises(TooManyFaults):
        check_faults(df, 0)
    df.unpersist()


def test_a_file_over_its_budget_is_given_up_early_and_its_neighbour_is_whole(spark, tmp_path):
    broken = "".join(f"<artist><id>{i}</id><name>x</nome></artist>" for i in range(20000))
    torn = "".join(f"<artist><id>{i}</id>" for i in range(20000))
    good = "".join(f"<artist><id>{i}</id><name>n</name></artist>" for i in range(5000)) + "<artist><id>b</id><name></artist>" * 3
    for name, body in (("a_20240101_artists", broken), ("b_20240101_artists", torn), ("c_20240101_artists", good)):
        dump(tmp_path, f"{name}.xml.gz", f"<artists>{body}</artists>")
    df = read_dump(spark, str(tmp_path), "artists", partitions=4, budget=100).cache()
    faults = {f.rsplit("/", 1)[-1][0]: n for f, n in check_faults(df, None).items()}
    assert 100 < faults["a"] <= 4 * 101 and faults["b"] == 101 and faults["c"] == 3
    assert df.where("error is null and file like '%/c_%'").count() == 5000
    own = rejects(df).where("file like '%/c_%'").collect()
    assert sorted(r.seq for r in own) == [5000, 5001, 5002] and all("mismatched tag" in r.cause and r.raw_xml.startswith("<artist>") for r in own)
    assert check_faults(read_dump(spark, f"{tmp_path}/a_*", "artists"), None).popitem()[1] == 20000
    with pytest.raises(TooManyFaults):
        check_faults(df, 100)
    df.unpersist()


def test_rejects_are_written_also_for_a_file_that_is_refused(spark, tmp_path):
    from dumpmill.operators.status import Config
    from dumpmill.run import process_file

    path = dump(tmp_path, "cat_20240101_labels.xml.gz", "<labels>" + "<label><id>1</id><name></label>" * 3 + "<label><id>2</id></label></labels>")
    with pytest.raises(TooManyFaults):
        process_file(spark, path, f"{tmp_path}/out", config=Config(fault_budget=2))
    rows = spark.read.json(f"{tmp_path}/out/rejected")
    assert sorted(r.seq for r in rows.collect()) == [0, 1, 2] and {r.data_type for r in rows.collect()} == {"labels"}
    assert process_file(spark, path, f"{tmp_path}/out2", config=Config(fault_budget=3)) == ("labels", 1, 1)
