"""What moves in the plans of loads and refreshes, with broadcasts off."""

import json
import re
from datetime import datetime, timezone

import pytest

from pacegrid.plans import bronze
from pacegrid.plans.silver import aggregate_stream
from pacegrid.sinks.landing import land_raw
from pacegrid.sinks.tables import stage_bucketed
from pacegrid.sources import landing
from pacegrid.sources.tables import Tables
from tests.conftest import landing_tree, rows, samples

AT = datetime(2024, 5, 1, tzinfo=timezone.utc)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def moved(frame, column, kinds="Exchange|Window|Sort"):
    """Operators of these kinds that a column passes through."""
    text = frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    found = re.findall(rf"\(\d+\) ({kinds})[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", text)
    return [kind for kind, columns in found if re.search(rf"\b{column}#", columns)]


def packed(spark, tmp_path):
    documents = landing.scan_files(spark, landing_tree(tmp_path / "raw")).withColumnRenamed("value", "document")
    root = str(tmp_path / "packed")
    land_raw(documents, root, AT)
    return root


def test_wide_rows_are_not_exchanged(spark, tmp_path, no_broadcast):
    tables = Tables(spark, str(tmp_path / "tables"), buckets=4)
    bronze.bronze_load(tables, landing_tree(tmp_path / "raw"))
    wide = aggregate_stream(tables, None, AT)
    assert moved(wide, "velocity_smooth", "Exchange") == []
    # The one exchange they make is that to their buckets.
    assert len(moved(wide.hint("rebalance", "athlete_id"), "velocity_smooth", "Exchange")) == 1
    assert stage_bucketed(wide, 4).count() == 4


def test_texts_of_packed_documents_are_not_moved(spark, tmp_path, no_broadcast):
    root, tables = packed(spark, tmp_path), Tables(spark, str(tmp_path / "tables"), buckets=4)
    for options in ({}, {"sample": 1}, {"refresh_profiles": True}):
        fresh = bronze.fresh_documents(tables, root, layout="packed", **options)
        assert moved(fresh, "value") == moved(fresh, "document") == []
        assert "document" not in landing.list_packed(spark, root).columns


def test_only_files_with_new_documents_are_opened(spark, tmp_path):
    root, tables = packed(spark, tmp_path), Tables(spark, str(tmp_path / "tables"), buckets=4)
    assert bronze.bronze_load(tables, root, layout="packed").count() == 9
    for path in (tmp_path / "packed").rglob("part-*.json"):
        if "channel=watts" not in str(path):
            path.write_text("not to be opened")
    again = bronze.bronze_load(tables, root, layout="packed")
    assert rows(again, "data_stream", "status") == [("watts", "FAILURE")]


def test_landings_without_an_index_are_listed(spark, tmp_path):
    root = packed(spark, tmp_path)
    body = json.dumps({"athlete_id": "7", "activity_id": "1", "document": json.dumps(samples([4]))})
    folder = tmp_path / "packed" / "channel=time" / "landed=20240601T000000000000"
    folder.mkdir()
    (folder / "part.json").write_text(body + "\n")
    listed = landing.list_packed(spark, root)
    assert listed.count() == 10
    assert rows(listed.filter("athlete_id = '7'"), "channel", "landed") == [("time", "20240601T000000000000")]
    tables = Tables(spark, str(tmp_path / "tables"), buckets=4)
    bronze.bronze_load(tables, root, layout="packed")
    assert rows(tables.samples().filter("athlete_id = '7'"), "data") == [(4.0,)]


def test_marks_need_no_activity_table(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "tables"), buckets=4)
    bronze.bronze_load(tables, landing_tree(tmp_path / "raw"))
    assert rows(tables.marks()) == [("0017", "2024-01-01T00:00:00Z")]
    assert "/activity" not in tables.marks()._jdf.queryExecution().executedPlan().toString()


def test_a_named_batch_replaces_itself(spark, tmp_path, monkeypatch):
    tables, root = Tables(spark, str(tmp_path / "tables"), buckets=4), landing_tree(tmp_path / "raw")
    documents = landing.scan_files(spark, root)
    with monkeypatch.context() as broken:
        broken.setattr(bronze, "append_ledger", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            bronze.load_documents(documents, tables, AT, batch="b1")
    bronze.load_documents(documents, tables, AT, batch="b1")
    assert tables.samples().count() == 12 and tables.has_batch("b1") and not tables.has_batch("b2")


def test_quarantine_holds_what_never_loaded(spark, tmp_path):
    tables, root = Tables(spark, str(tmp_path / "tables"), buckets=4), landing_tree(tmp_path / "raw")
    bronze.bronze_load(tables, root)
    assert rows(tables.quarantine()) == [("0017", "watts", "4", "{bad", "malformed_json", 1)]
    bronze.reload_failed(tables)
    assert rows(tables.quarantine(), "attempts") == [(2,)]
    mended = json.dumps(samples([250]))
    done = bronze.reload_failed(tables, lambda held: held.replace("{bad", mended, "value"))
    assert rows(done, "status", "record_count") == [("SUCCESS", 1)] and tables.quarantine().isEmpty()
