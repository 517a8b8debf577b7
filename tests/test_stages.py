"""What loads leave on disk, and how much one task of them holds."""

import gzip
import io
import re
from datetime import datetime, timezone
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from pacegrid import session
from pacegrid.plans import bronze
from pacegrid.plans.standins import order_documents, start_of_order
from pacegrid.sinks import landing as sink
from pacegrid.sources import files
from pacegrid.sources import landing as sources_landing
from pacegrid.sources import tables as sources
from pacegrid.sources.tables import Tables

AT = datetime(2024, 2, 1, tzinfo=timezone.utc)
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables"), buckets=2)


def watts(spark, n, column="document", body='{"data":[%d],"original_size":1,"series_type":"time"}'):
    made = [("a", "watts", str(i), body % i if "%" in body else body) for i in range(n)]
    return spark.createDataFrame(made, f"athlete_id string, channel string, activity_id string, {column} string")


def test_landed_lines_are_compressed_and_bounded_by_file(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "FILE_LINES", 3)
    root = tmp_path / "packed"
    sink.land_raw(watts(spark, 40), str(root), AT)
    parts = list((root / "channel=watts").rglob("part-*"))
    lines = [len(gzip.open(path).readlines()) for path in parts]
    assert sum(lines) == 40 and max(lines) <= 3
    bronze.bronze_load(tables, str(root), AT, layout="packed")
    assert rows(tables.samples(), "data") == rows(spark.range(40).select(F.col("id").cast("double")))


def test_keys_of_a_large_file_are_asked_in_parts(spark, tmp_path, monkeypatch):
    root = tmp_path / "packed"
    sink.land_raw(watts(spark, 40).coalesce(1), str(root), AT)
    listed = spark.read.parquet(f"{root}/_index")
    monkeypatch.setattr(files, "TASK_KEYS", 4)
    found = files.read_lines(listed.select("athlete_id", "activity_id", "file_path"), ["athlete_id", "activity_id"], "document")
    assert found.count() == found.select("activity_id").distinct().count() == 40
    assert "_part" in found._jdf.queryExecution().toString()


def test_a_load_leaves_no_parsed_documents_behind(spark, tables, tmp_path):
    root = str(tmp_path / "packed")
    sink.land_raw(watts(spark, 5), root, AT)
    entries = bronze.bronze_load(tables, root, AT, layout="packed")
    left = {path.name.split("-")[0] for path in Path(session.scratch_root(spark).removeprefix("file:")).iterdir()}
    assert not left & {"load", "bronze", "objects"}
    assert entries.filter("status = 'SUCCESS'").count() == 5


def test_opened_files_are_those_with_new_documents(spark, tables, tmp_path):
    root = tmp_path / "packed"
    good = watts(spark, 3).withColumn("channel", F.lit("time"))
    sink.land_raw(good.unionByName(watts(spark, 1, body="{bad")), str(root), AT)
    bronze.bronze_load(tables, str(root), AT, layout="packed")
    spoiled = list((root / "channel=time").rglob("part-*"))
    for path in spoiled:
        path.write_text("not to be opened")
    assert spoiled and rows(bronze.bronze_load(tables, str(root), layout="packed"), "data_stream", "status") == [("watts", "FAILURE")]


def test_quarantined_texts_are_sorted_in_bounded_parts(spark, tables, monkeypatch):
    bronze.load_documents(watts(spark, 9, "value", "{bad"), tables, AT)
    monkeypatch.setattr(sources, "TASK_ROWS", 2)
    held = tables.quarantine()
    assert rows(held, "activity_id", "value", "attempts") == [(str(i), "{bad", 1) for i in range(9)]
    assert ", 5), REPARTITION_BY_NUM" in held._jdf.queryExecution().toString()


def test_writes_are_cut_in_small_tasks(spark):
    before, seen = spark.conf.get(ADVISORY), []
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    with session.small_tasks(spark):
        assert size(spark.conf.get(ADVISORY)) <= 16 << 20 < size(before)
        assert spark.conf.get(session.SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(ADVISORY) == before
    spark.conf.set(ADVISORY, "1m")
    try:
        with session.small_tasks(spark):
            seen.append(spark.conf.get(ADVISORY))
    finally:
        spark.conf.set(ADVISORY, before)
    assert seen == ["1m"]


def test_orders_of_a_part_give_the_same_documents(spark, tmp_path):
    orders = spark.createDataFrame(
        [(1, 7, "O", 2.5, "1994-12-31", "1-URGENT"), (2, 7, "F", 1.0, "1995-01-01", "5-LOW"), (3, 8, "F", 4.0, None, "5-LOW")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string",
    )
    orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date")).write.parquet(str(tmp_path / "orders.parquet"))
    of_text = F.get_json_object("document", "$.start_date") < "1995"
    for whole, part in ((of_text, start_of_order() < "1995"), (~of_text, ~(start_of_order() < "1995"))):
        expected = rows(order_documents(spark, str(tmp_path)).filter(whole))
        assert len(expected) == 1 and rows(order_documents(spark, str(tmp_path), part)) == expected


def test_lines_are_read_by_arrow_and_odd_ones_by_themselves():
    known = files._marks([pa.array(["1", None, "é"]), pa.array(["2", "b", ""])])
    plain = '{"a":"1","b":"2","d":"x \\"é\\"","z":[1]}\n\n{"a":null,"b":"b"}\n{"b":"","a":"é","d":null}\n{"a":"1","b":"3","d":"no"}\n'.encode()
    odd = b'{"a":1,"b":"2","d":"a number is no key"}\n{"a":"1","b":"3","d":{}}\n{"a":"0","a":"1","b":"2","d":"twice"}\n'
    expected = [("1", "2", 'x "é"'), (None, "b", None), ("é", "", None)]
    for block, more in ((plain, []), (plain + odd, [("1", "2", "twice")])):
        found = files._wanted(block, ["a", "b"], "d", known)
        assert [tuple(row.values()) for row in found.to_pylist()] == expected + more
    with pytest.raises(ValueError):
        files._wanted(plain + b'{"a":"1","b', ["a", "b"], "d", known)


def test_lines_are_cut_into_whole_blocks(monkeypatch):
    monkeypatch.setattr(files, "BATCH_BYTES", 4)
    assert list(files._blocks(io.BytesIO(b"a\nbb\n\nccccccccc\nd"))) == [b"a", b"bb\n", b"ccccccccc", b"d"]


def test_of_two_landings_the_last_is_chosen_by_a_number_of_its_file(spark):
    listed = spark.createDataFrame(
        [("a", "t", "1", "L1", "f1"), ("a", "t", "1", "L2", "f0"), ("a", "t", "2", "L1", "f1"), ("a", "t", "2", "L1", "f2"), (None, "t", "3", None, "f3"), (None, "t", "3", "L1", "f1")],
        "athlete_id string, channel string, activity_id string, landed string, file_path string",
    )
    last = sources_landing.last_landed(listed)
    assert rows(last) == sorted([("a", "t", "1", "L2", "f0"), ("a", "t", "2", "L1", "f2"), (None, "t", "3", "L1", "f1")], key=repr)
    assert "SortAggregate" not in last._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_batch_are_not_gathered_by_its_name(spark, tables):
    bronze.load_documents(watts(spark, 3, "value"), tables, AT)
    plan = tables.samples()._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"(\w+) \[batch#\d+\], \[batch#\d+\], LeftSemi", plan)
    assert joins and set(joins) == {"BroadcastHashJoin"}


def test_objects_are_written_in_one_pass_and_faulty_ones_stay_unseen(spark, tables):
    bodies = ['{"id":1,"athlete":{"id":7},"start_date":"2024-01-01"}', '{"id":2,"athlete":{"id":7},"distance":"far"}', "{bad"]
    documents = spark.createDataFrame([("7", "activity", str(i), body) for i, body in enumerate(bodies)], "athlete_id string, channel string, activity_id string, value string")
    assert not hasattr(bronze, "write_stage")
    entries = bronze.load_documents(documents, tables, AT)
    assert rows(entries, "activity_id", "status", "reason") == [("0", "SUCCESS", None), ("1", "FAILURE", "distance"), ("2", "FAILURE", "malformed_json")]
    assert rows(tables.bronze("activity"), "activity_id") == [("1",)] and rows(tables.marks()) == [("7", "2024-01-01")]
    assert rows(tables.quarantine(), "activity_id", "value") == [("1", bodies[1]), ("2", bodies[2])]
    assert not list(Path(tables.bronze_path("activity")).glob("batch=*-faulty")) and len(list(Path(tables.bronze_path("activity")).glob("batch=*"))) == 1
