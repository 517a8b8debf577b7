from datetime import datetime, timezone
from pathlib import Path

import pytest

from pacegrid.plans.bronze import bronze_load, parse_documents
from pacegrid.plans.silver import silver_refresh
from pacegrid.sources import landing
from pacegrid.sources.landing import UnknownChannel
from pacegrid.sources.tables import Tables
from tests.conftest import landing_tree, put, rows, samples


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables"), buckets=4)


@pytest.fixture
def root(tmp_path):
    return landing_tree(tmp_path / "raw")


def ledger_of(tables):
    return rows(tables.ledger(), "athlete_id", "data_stream", "activity_id", "record_count", "status")


def test_load_gives_rows_and_ledger(tables, root):
    bronze_load(tables, root)
    assert ledger_of(tables) == [
        ("0017", "activity", "1", 1, "SUCCESS"),
        ("0017", "athlete_summary", "0", 1, "SUCCESS"),
        ("0017", "heartrate", "1", 3, "SUCCESS"),
        ("0017", "heartrate", "2", 0, "SUCCESS"),
        ("0017", "latlng", "1", 3, "SUCCESS"),
        ("0017", "moving", "1", 2, "SUCCESS"),
        ("0017", "time", "1", 3, "SUCCESS"),
        ("0017", "watts", "4", 0, "FAILURE"),
        ("9", "time", "7", 1, "SUCCESS"),
    ]
    assert rows(tables.bronze("heartrate"), "index", "data") == [(1, 100.0), (2, 101.0), (3, None)]
    assert rows(tables.bronze("moving"), "index", "data") == [(1, 1.0), (2, 0.0)]
    assert rows(tables.bronze("latlng"), "index", "latitude", "longitude") == [
        (1, 1.5, 2.5),
        (2, None, None),
        (3, 3.5, None),
    ]
    (activity,) = tables.bronze("activity").collect()
    assert (activity.activity_id, activity.athlete_id, activity.map_id) == ("1", "0017", "m1")
    assert (activity.distance, activity.kudos_count, activity.commute) == (12.5, 3, True)
    assert activity.start_latitude is None and activity._extra == {"device_name": "Watch"}
    (profile,) = tables.bronze("athlete_summary").collect()
    assert (profile.athlete_id, profile.city, profile.bikes) == ("17", "X", '[{"a":1}]')


def test_second_run_adds_nothing_but_retries_failures(tables, root):
    bronze_load(tables, root)
    first = rows(tables.samples().drop("metadata_insert_timestamp"))
    again = bronze_load(tables, root)
    assert rows(again, "data_stream", "status") == [("watts", "FAILURE")]
    assert rows(tables.samples().drop("metadata_insert_timestamp")) == first
    put(root, "0017", "watts", 4, samples([250]))
    put(root, "9", "watts", 7, samples([300]))
    added = bronze_load(tables, root)
    assert rows(added, "activity_id", "record_count", "status") == [("4", 1, "SUCCESS"), ("7", 1, "SUCCESS")]


def test_selected_channels_and_sample(tables, root):
    assert rows(bronze_load(tables, root, channels=["moving", "cadence"]), "data_stream") == [("moving",)]
    # The sample takes the first file of each channel, then drops the loaded ones.
    sampled = bronze_load(tables, root, channels=["moving", "heartrate"], sample=1)
    assert rows(sampled, "data_stream", "activity_id") == [("heartrate", "1")]


def test_unknown_channel_stops_the_run(tables, root):
    put(root, "9", "gyroscope", 7, samples([1]))
    with pytest.raises(UnknownChannel, match="gyroscope"):
        bronze_load(tables, root)
    assert tables.ledger().isEmpty()


def test_path_without_activity_is_reported(spark, root):
    (landing_path := __import__("pathlib").Path(root) / "athlete_id=9" / "time" / "notes.json").write_text("{}")
    assert landing_path.exists()
    listed = landing.list_files(spark, root)
    assert rows(landing.rejected_paths(listed), "reason") == [("no_activity_in_path",)]
    assert landing.named_files(listed).count() == 9


def test_rejected_paths_are_in_the_report(tables, root):
    (Path(root) / "athlete_id=9" / "time" / "notes.json").write_text("{}")
    report = bronze_load(tables, root).filter("athlete_id IS NULL")
    assert [(r.status, r.reason.split(":")[0]) for r in report.collect()] == [("FAILURE", "no_activity_in_path")]
    assert tables.ledger().filter("athlete_id IS NULL").isEmpty()


def test_only_listed_files_are_opened(spark, root):
    wanted = landing.list_files(spark, root).filter("channel = 'heartrate'").cache()
    assert wanted.count() == 2
    for path in Path(root).rglob("*.json"):
        if path.parent.name != "heartrate":
            path.unlink()
    assert {r.channel for r in landing.read_files(wanted).collect()} == {"heartrate"}


def test_missing_root_is_an_error_and_an_empty_one_is_not(spark, tables, tmp_path):
    with pytest.raises(FileNotFoundError):
        bronze_load(tables, str(tmp_path / "nowhere"))
    (tmp_path / "empty").mkdir()
    assert bronze_load(tables, str(tmp_path / "empty")).isEmpty()


def test_loads_with_the_same_time_keep_each_other(tables, tmp_path):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    root = tmp_path / "raw"
    put(root, "1", "time", 1, samples([1, 2]))
    put(root, "1", "heartrate", 1, samples([90]))
    bronze_load(tables, str(root), at=at)
    put(root, "1", "time", 2, samples([3]))
    bronze_load(tables, str(root), at=at)
    bronze_load(tables, str(root), at=at)
    assert rows(tables.samples(), "channel", "activity_id", "index") == [
        ("heartrate", "1", 1), ("time", "1", 1), ("time", "1", 2), ("time", "2", 1)
    ]
    assert len(ledger_of(tables)) == 3


def test_ordinary_bodies_get_their_status(tables, tmp_path):
    root = tmp_path / "raw"
    put(root, "1", "watts", 1, {"message": "Rate Limit Exceeded"})
    put(root, "1", "latlng", 2, {})
    put(root, "1", "watts", 3, {"data": None})
    put(root, "1", "watts", 4, {"data": [7], "original_size": 1.0, "series_type": "time"})
    put(root, "1", "activity", 5, '{"id": 5, "athlete": {"id": "1"}, "max_heartrate": 178.0, "upload_id": 1.2e10, "suffer_score": 82.0}')
    put(root, "1", "activity", 6, '{"id": 6, "athlete": {"id": "1"}, "max_heartrate": 1.5}')
    entries = bronze_load(tables, str(root))
    assert rows(entries, "activity_id", "status", "reason") == [
        ("1", "FAILURE", "required:data"), ("2", "FAILURE", "required:data"), ("3", "SUCCESS", None),
        ("4", "SUCCESS", None), ("5", "SUCCESS", None), ("6", "FAILURE", "max_heartrate"),
    ]
    assert rows(tables.bronze("activity"), "max_heartrate", "upload_id", "suffer_score") == [(178, 12_000_000_000, 82)]


def test_reference_mode_logs_no_empty_batch(tables, tmp_path):
    root = tmp_path / "raw"
    put(root, "1", "watts", 1, samples(None, None))
    put(root, "1", "time", 1, samples([1]))
    put(root, "1", "time", 2, samples(None, None))
    bronze_load(tables, str(root), ledger_empty=False)
    assert ledger_of(tables) == [("1", "time", "1", 1, "SUCCESS"), ("1", "time", "2", 0, "SUCCESS")]


def test_faults_fail_one_document(tables, tmp_path):
    root = tmp_path / "raw"
    put(root, "1", "watts", 1, samples([1, "abc"]))
    put(root, "1", "watts", 2, samples([1], None))
    put(root, "1", "watts", 3, {"data": [1], "original_size": "x", "series_type": "time"})
    put(root, "1", "watts", 4, samples([7]))
    put(root, "1", "latlng", 1, samples([[1, "abc"]]))
    put(root, "1", "latlng", 2, samples([[1, 2]], None))
    put(root, "1", "activity", 1, {"id": 1, "athlete": {}})
    put(root, "1", "activity", 2, {"id": 2, "athlete": {"id": 1}, "kudos_count": "many"})
    put(root, "1", "activity", 3, {"id": 3, "athlete": {"id": 1}})
    put(root, "1", "activity", 4, " ")
    entries = bronze_load(tables, str(root))
    assert rows(entries.filter("status = 'FAILURE'"), "data_stream", "activity_id", "reason") == [
        ("activity", "1", "athlete_id"),
        ("activity", "2", "kudos_count"),
        ("activity", "4", "malformed_json"),
        ("latlng", "1", "malformed_json"),
        ("watts", "1", "bad_value:data"),
        ("watts", "2", "required:series_type"),
        ("watts", "3", "bad_value:original_size"),
    ]
    assert rows(tables.bronze("watts"), "activity_id") == [("4",)]
    assert rows(tables.bronze("activity"), "activity_id") == [("3",)]


def test_unpublished_batch_is_invisible(tables, root, monkeypatch):
    import pacegrid.plans.bronze as bronze

    with monkeypatch.context() as broken:
        broken.setattr(bronze, "append_ledger", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            bronze_load(tables, root)
    assert tables.samples().isEmpty()
    bronze_load(tables, root)
    assert tables.bronze("heartrate").count() == 3


def test_profile_refresh(tables, root):
    bronze_load(tables, root)
    assert tables.bronze("athlete_summary").count() == 1
    bronze_load(tables, root, refresh_profiles=True)
    assert tables.bronze("athlete_summary").count() == 2


def test_registered_transform_applies_to_its_channel_only(tables, root):
    from pyspark.sql import functions as F

    from pacegrid.operators.reshape import TRANSFORMS

    extended = {**TRANSFORMS, "heartrate": [lambda df: df.withColumn("data", F.col("data") + 1000)]}
    bronze_load(tables, root, transforms=extended)
    assert rows(tables.bronze("heartrate"), "data") == [(1100.0,), (1101.0,), (None,)]
    assert rows(tables.bronze("moving"), "data") == [(0.0,), (1.0,)]


def test_silver_run_twice_gives_the_same_table(tables, root):
    bronze_load(tables, root)
    assert rows(silver_refresh(tables)) == [("aggregate_stream", 0, 4, 0)]
    columns = ["index", "time", "heartrate", "latitude", "moving", "watts", "name", "athlete_id", "activity_id"]
    expected = [
        (1, 0.0, 100.0, 1.5, 1.0, None, "Ride", "0017", "1"),
        (1, 5.0, None, None, None, None, None, "9", "7"),
        (2, 1.0, 101.0, None, 0.0, None, "Ride", "0017", "1"),
        (3, 2.0, None, 3.5, None, None, "Ride", "0017", "1"),
    ]
    assert rows(tables.silver(), *columns) == expected
    assert rows(silver_refresh(tables)) == [("aggregate_stream", 4, 4, 0)]
    assert rows(tables.silver(), *columns) == expected


def test_silver_replaces_only_what_it_rebuilds(spark, tables, root):
    bronze_load(tables, root)
    silver_refresh(tables)
    put(root, "0017", "time", 8, samples([3]))
    bronze_load(tables, root)
    athletes = spark.createDataFrame([("0017",), ("404",)], "athlete_id string")
    assert rows(silver_refresh(tables, athletes, activity_id="8")) == [("aggregate_stream", 0, 1, 0)]
    assert tables.silver().count() == 5
    assert rows(silver_refresh(tables, athletes)) == [("aggregate_stream", 4, 4, 0)]
    assert tables.silver().count() == 5


def test_silver_keeps_an_athlete_whose_rows_break_a_requirement(spark, tables, root):
    bronze_load(tables, root)
    silver_refresh(tables)
    put(root, "9", "time", 8, samples([None]))
    bronze_load(tables, root)
    assert rows(silver_refresh(tables)) == [("aggregate_stream", 3, 3, 1)]
    assert tables.silver().filter("athlete_id = '9'").count() == 1


def test_parse_has_no_python_and_reads_once(spark, root):
    plan = parse_documents(landing.scan_files(spark, root))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("FileScan") == 1


def test_catalog_views_follow_loads(spark, tables, root):
    bronze_load(tables, root)
    silver_refresh(tables)
    names = tables.create_views()
    assert "dev_bronze_strava.heartrate" in names and "dev_silver_strava.aggregate_stream" in names
    count = "SELECT count(*) FROM dev_bronze_strava.heartrate"
    assert spark.sql(count).first()[0] == 3
    put(root, "9", "heartrate", 7, samples([60]))
    bronze_load(tables, root)
    spark.catalog.refreshTable("dev_bronze_strava.heartrate")
    assert spark.sql(count).first()[0] == 4
    assert spark.sql("SELECT max(heartrate) FROM dev_silver_strava.aggregate_stream").first()[0] == 101.0


def test_batches_outside_the_scope_are_not_read(spark, tables, root):
    bronze_load(tables, root)
    put(root, "9", "time", 8, samples([6, 7]))
    bronze_load(tables, root)
    scope = spark.createDataFrame([("9", "8")], "athlete_id string, activity_id string")
    scoped = tables.samples(scope)
    assert rows(scoped, "activity_id", "data") == [("8", 6.0), ("8", 7.0)]
    plan = scoped._jdf.queryExecution().executedPlan().toString()
    assert "batch" in plan.split("PartitionFilters:")[1].split("]")[0]
