"""Queries that make much of each row of a small table do so on all cores."""
import pytest

import dumpmill.queries_ingest  # noqa: F401
from dumpmill.registry import QUERIES


@pytest.mark.parametrize("name", ["normalize_artists", "normalize_labels", "normalize_masters", "normalize_releases", "unwrap_and_strip"])
def test_a_table_of_one_file_is_dealt_out(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
