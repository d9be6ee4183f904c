"""Queries that compare what an operator makes row by row."""

import datetime
from pathlib import Path

import pytest

from workload import postings
from workload.postings import raw_postings
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not there")


def test_keys_of_whole_postings(spark):
    keys = [r.job_id for r in QUERIES["job_key_rows"](spark, SF_DIR).collect()]
    assert len(keys) == len(set(keys)) == raw_postings(spark, SF_DIR).drop("job_id").distinct().count()


def test_readers_are_registered():
    assert {"read_blocks", "read_ungrouped", "broken_blocks"} <= set(QUERIES)


@pytest.fixture(scope="module")
def order_tables(spark, tmp_path_factory):
    """600 orders of one year, two of them with one key and one without key."""
    root = str(tmp_path_factory.mktemp("orders"))
    day = datetime.datetime(1995, 3, 1)
    orders = [(None if k == 7 else 8 if k == 9 else k, k % 4, "O", "1-URGENT", day + datetime.timedelta(k % 90)) for k in range(600)]
    frames = {
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"),
        "customer": spark.createDataFrame([(k, 0, f"S{k}") for k in range(4)], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "nation": spark.createDataFrame([(0, "PERU")], "n_nationkey int, n_name string"),
    }
    for name, df in frames.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return root


def test_arrays_of_a_large_source_are_several_files(spark, order_tables, monkeypatch):
    """One array per date and source grew with the table and was built and read in one piece."""
    monkeypatch.setattr(postings, "FILE_POSTINGS", 20, raising=False)
    found = QUERIES["read_blocks"](spark, order_tables)
    assert len(found.inputFiles()) > 4
    columns = ["group", "source", "title", "link", "salary", "deadline"]
    expected = raw_postings(spark, order_tables).select(columns)
    assert found.select(columns).exceptAll(expected).count() == 0 and found.count() == expected.count() == 600


def test_one_row_for_a_folder_of_broken_files(spark, order_tables, monkeypatch):
    monkeypatch.setattr(postings, "FILE_POSTINGS", 20, raising=False)
    found = QUERIES["broken_blocks"](spark, order_tables)
    assert len(found.inputFiles()) > 4
    assert [tuple(r) for r in found.collect()] == [("1995-01-01", "board_b", True)]
