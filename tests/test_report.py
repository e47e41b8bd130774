from dumpmill.queries import QUERIES


def test_skip_ids_are_whole(spark):
    sf_dir = "/root/testdata/sf0.01"
    want = {r.reason: r.skipped for r in QUERIES["skip_reason_summary"](spark, sf_dir).collect()}
    got: dict[str, set[str]] = {}
    for r in QUERIES["skip_reason_ids"](spark, sf_dir).collect():
        ids = r.ids.split(", ")
        assert len(ids) == r.skipped <= 1000
        got.setdefault(r.reason, set()).update(ids)
    assert {k: len(v) for k, v in got.items()} == want and max(want.values()) > 20
