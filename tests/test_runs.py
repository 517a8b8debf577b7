import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid.plans.bronze import bronze_load
from pacegrid.plans.runs import full_run, run_all
from pacegrid.plans.silver import builds_of, silver_refresh
from pacegrid.session import scratch_cleared, scratch_root
from pacegrid.sinks.landing import as_document, land_files, land_raw
from pacegrid.sinks.tables import compact, replace_by_key, vacuum
from pacegrid.sources import landing
from pacegrid.sources.tables import Tables, current_versions, read_bucketed
from pacegrid.streaming.ingest import ingest_available, query_id
from tests.conftest import landing_tree, put, rows, samples

AT = datetime(2024, 5, 1, tzinfo=timezone.utc)


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables"), buckets=4)


def test_replace_by_key(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "athlete_id string, activity_id string, v int"
    first = spark.createDataFrame([(f"a{i}", "1", i) for i in range(12)], schema)
    assert rows(replace_by_key(path, first, first, 4)) == [(0, 12)]
    keys = spark.createDataFrame([("a1",), ("a2",), ("new",), ("none",)], "athlete_id string")
    new = spark.createDataFrame([("a1", "1", 100), ("a1", "2", 101), ("new", "1", 5)], schema)
    assert rows(replace_by_key(path, new, keys, 4)) == [(2, 3)]
    expected = {(f"a{i}", "1", i) for i in range(12) if i not in (1, 2)} | {tuple(r) for r in new.collect()}
    state = read_bucketed(spark, path, first.schema)
    assert {(r.athlete_id, r.activity_id, r.v) for r in state.collect()} == expected and state.count() == len(expected)
    one = spark.createDataFrame([("a1", "2")], "athlete_id string, activity_id string")
    assert rows(replace_by_key(path, new.limit(0), one, 4, on=("athlete_id", "activity_id"))) == [(1, 0)]
    assert rows(replace_by_key(path, new.limit(0), one, 4, on=("athlete_id", "activity_id"))) == [(0, 0)]
    everything = read_bucketed(spark, path, first.schema).select("athlete_id").distinct()
    assert rows(replace_by_key(path, new.limit(0), everything, 4)) == [(12, 0)]
    assert read_bucketed(spark, path, first.schema).isEmpty()
    # Versions that no kept switch names are gone.
    assert len(list((tmp_path / "t" / "switch").iterdir())) == 2 and len(list((tmp_path / "t" / "rows").iterdir())) <= 3


def test_readers_see_a_table_before_or_after_a_change(spark, tmp_path, monkeypatch):
    import pacegrid.sinks.tables as sink

    path = str(tmp_path / "t")
    first = spark.createDataFrame([(f"a{i}", i) for i in range(40)], "athlete_id string, v int")
    replace_by_key(path, first, first, 4)
    seen, switch = [], sink._switch

    def watched(*args):
        seen.append(rows(read_bucketed(spark, path, first.schema), "athlete_id", "v"))
        switch(*args)

    monkeypatch.setattr(sink, "_switch", watched)
    new = first.withColumn("v", F.col("v") + 100)
    replace_by_key(path, new, new, 4)
    assert seen == [rows(first)] and rows(read_bucketed(spark, path, first.schema), "athlete_id", "v") == rows(new)
    monkeypatch.setattr(sink, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        replace_by_key(path, first, first, 4)
    assert rows(read_bucketed(spark, path, first.schema), "athlete_id", "v") == rows(new)


def test_compaction_leaves_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(6):
        part = spark.createDataFrame([(f"a{n}_{i}", i) for i in range(20)], "athlete_id string, v int")
        replace_by_key(path, part, part, 2)
    before = rows(read_bucketed(spark, path, part.schema))

    def files():
        named = current_versions(spark, path).filter("version <> ''").collect()
        return sum(len(list((tmp_path / "t" / "rows" / f"version={v}" / f"athlete_bucket={b}").glob("*.parquet"))) for v, b in named)

    assert files() >= 12
    assert compact(spark, path, part.schema) == 2 and compact(spark, path, part.schema) == 0
    assert rows(read_bucketed(spark, path, part.schema)) == before
    vacuum(spark, path, 1)
    assert files() == 2 and len(list((tmp_path / "t" / "rows").iterdir())) == 1


def test_packed_landing_equals_files(spark, tables, tmp_path):
    root = landing_tree(tmp_path / "raw")
    bronze_load(tables, root)
    documents = landing.scan_files(spark, root).withColumnRenamed("value", "document")
    land_raw(documents, str(tmp_path / "packed"), AT)
    packed = Tables(spark, str(tmp_path / "other"), buckets=4)
    entries = bronze_load(packed, str(tmp_path / "packed"), layout="packed")
    assert entries.count() == 9
    columns = [c for c in tables.samples().columns if c != "metadata_insert_timestamp"]
    assert rows(packed.samples(), *columns) == rows(tables.samples(), *columns)
    assert rows(packed.ledger().drop("bq_insert_timestamp")) == rows(tables.ledger().drop("bq_insert_timestamp"))
    assert bronze_load(packed, str(tmp_path / "packed"), layout="packed", channels=["time"]).isEmpty()


def test_document_landed_twice_counts_once(spark, tables, tmp_path):
    root = str(tmp_path / "packed")
    for hours, value in ((0, 1), (1, 2)):
        body = spark.createDataFrame([("a", "time", "1", json.dumps(samples([value])))], "athlete_id string, channel string, activity_id string, document string")
        land_raw(body.unionByName(body), root, AT + timedelta(hours=hours))
    bronze_load(tables, root, layout="packed")
    assert rows(tables.bronze("time"), "data") == [(2.0,)]
    assert tables.ledger().count() == 1
    scan = landing.scan_packed(spark, root, ["time"], AT + timedelta(hours=1))
    assert scan.count() == 2 and landing.scan_packed(spark, root).count() == 4


def test_stream_takes_each_document_once(spark, tables, tmp_path):
    root, log = tmp_path / "raw", str(tmp_path / "log")
    landing_tree(root)
    counts = []
    for step in range(3):
        if step == 1:
            put(root, "9", "watts", 7, samples([1, 2]))
        ingest_available(tables, str(root), log, max_files=4).awaitTermination()
        counts.append((tables.samples().count(), tables.ledger().count()))
    assert counts == [(12, 9), (14, 10), (14, 10)]
    # A lost checkpoint reads every file again; the ledger keeps loaded ones out.
    ingest_available(tables, str(root), str(tmp_path / "log2")).awaitTermination()
    assert tables.samples().count() == 14
    assert tables.ledger().filter("status = 'SUCCESS'").count() == 9
    names = {r.batch for r in tables._ledger_batches().select("batch").distinct().collect()}
    assert {n.rsplit("-", 1)[0] for n in names} == {f"stream-{query_id(spark, c)}" for c in (log, str(tmp_path / "log2"))}
    batch = Tables(spark, str(tmp_path / "batch"), buckets=4)
    bronze_load(batch, str(root))
    keys = ["athlete_id", "activity_id", "channel", "index", "data", "latitude"]
    assert rows(batch.samples(), *keys) == rows(tables.samples(), *keys)
    put(root, "9", "gyroscope", 7, samples([1]))
    with pytest.raises(StreamingQueryException, match="gyroscope"):
        ingest_available(tables, str(root), log).awaitTermination()
    assert tables.samples().count() == 14


def activity_frame(spark, data):
    framed = spark.createDataFrame(data, "athlete_id string, activity_id string, start_date string").withColumns(
        {"channel": F.lit("activity"), "id": F.col("activity_id"), "name": F.concat(F.lit("n"), F.col("activity_id"))}
    ).withColumn("athlete", F.struct(F.col("athlete_id").alias("id")))
    documents = as_document(framed, "id", "name", "athlete", "start_date")
    return framed.select("athlete_id", "activity_id", "start_date").join(documents.drop("channel"), ["athlete_id", "activity_id"])


def test_full_run_lands_only_newer_activities(spark, tables, tmp_path):
    root = str(tmp_path / "landing")
    body = lambda a, x, c, d: (a, c, x, json.dumps(samples(d)))
    bodies = spark.createDataFrame(
        [body("a", "1", "time", [0, 1]), body("a", "1", "watts", [5, 6]), body("b", "2", "time", [3])],
        "athlete_id string, channel string, activity_id string, document string",
    )
    first = activity_frame(spark, [("a", "1", "2024-01-01T00:00:00Z"), ("b", "2", "2024-01-01T00:00:00Z")])
    entries = full_run(tables, root, first, bodies, at=AT)
    # Two activity documents and eleven channels each, delivered or not.
    assert entries.count() == 24 and tables.ledger().filter("record_count = 0").count() == 19
    wide = rows(tables.silver(), "athlete_id", "index", "time", "watts", "name")
    assert wide == [("a", 1, 0.0, 5.0, "n1"), ("a", 2, 1.0, 6.0, "n1"), ("b", 1, 3.0, None, "n2")]
    later = activity_frame(
        spark, [("a", "0", "2023-01-01T00:00:00Z"), ("a", "1", "2024-01-01T00:00:00Z"), ("a", "3", "2024-02-01T00:00:00Z")]
    )
    again = full_run(tables, root, later, bodies, at=AT + timedelta(days=1))
    assert set(r[0] for r in again.select("activity_id").collect()) == {"3"}
    assert rows(tables.silver(), "athlete_id", "index", "time", "watts", "name") == wide


def test_all_users_and_one_broken_document(spark, tables, tmp_path):
    root = landing_tree(tmp_path / "raw")
    put(root, "55", "time", 1, samples([1]))
    users = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("",), ("u4",)], "uid string")
    connections = spark.createDataFrame(
        [("u1", "strava", ("0017",)), ("u2", "strava", ("9",)), ("u3", "strava", (None,))],
        "uid string, source string, athlete struct<id string>",
    )
    report = run_all(tables, root, users, connections)
    assert rows(report) == sorted(
        [
            ("u1", "0017", 7, 1, "FAILURE", None),
            ("u2", "9", 1, 0, "SUCCESS", None),
            ("u3", None, 0, 0, "FAILURE", "missing_athlete_id"),
            ("u4", None, 0, 0, "FAILURE", "no_connection"),
        ],
        key=repr,
    )
    assert rows(tables.silver().groupBy("athlete_id").count()) == [("0017", 3), ("9", 1)]
    assert tables.ledger().filter("athlete_id = '55'").isEmpty()


def test_scratch_is_empty_after_a_run(spark, tables, tmp_path):
    root = landing_tree(tmp_path / "raw")
    users = spark.createDataFrame([("u1",)], "uid string")
    linked = "uid string, source string, athlete struct<id string>"
    connections = spark.createDataFrame([("u1", "strava", ("0017",))], linked)
    with scratch_cleared(spark):
        assert run_all(tables, root, users, connections).count() == 1
        assert Path(scratch_root(spark)).exists()
    assert not Path(scratch_root(spark)).exists()
    with pytest.raises(FileNotFoundError), scratch_cleared(spark):
        run_all(tables, str(tmp_path / "nowhere"), users, connections)
    assert not Path(scratch_root(spark)).exists()
    assert tables.silver().count() == 3


def test_single_files_equal_packed(spark, tables, tmp_path):
    documents = spark.createDataFrame(
        [("a", "time", "1", json.dumps(samples([1, 2]))), ("a", "time", "1", json.dumps(samples([1, 2]))), ("b", "moving", "0", None)],
        "athlete_id string, channel string, activity_id string, document string",
    )
    root = tmp_path / "files"
    assert land_files(documents.limit(0), str(root)) == 0 and land_files(documents, str(root)) == 3
    assert sorted(str(p.relative_to(root)) for p in root.rglob("*.json")) == [
        "athlete_id=a/time/activity_id=1.json",
        "athlete_id=b/moving/activity_id=0.json",
    ]
    bronze_load(tables, str(root))
    assert rows(tables.bronze("time"), "athlete_id", "data") == [("a", 1.0), ("a", 2.0)]


def test_profiles_are_landed_with_each_run(spark, tables, tmp_path):
    root = str(tmp_path / "landing")
    bodies = spark.createDataFrame([], "athlete_id string, channel string, activity_id string, document string")
    activities = activity_frame(spark, [("a", "1", "2024-01-01T00:00:00Z")])
    for day, city in enumerate("XY"):
        profiles = spark.createDataFrame([("a", json.dumps({"id": "a", "city": city}))], "athlete_id string, document string")
        entries = full_run(tables, root, activities, bodies, at=AT + timedelta(days=day), profiles=profiles)
        assert entries.filter("data_stream = 'athlete_summary' AND status = 'SUCCESS'").count() == 1
        assert entries.count() == (13 if day == 0 else 1)
    assert rows(tables.bronze("athlete_summary"), "city") == [("X",), ("Y",)]


def test_silver_from_sql_files(spark, tables, tmp_path):
    bronze_load(tables, landing_tree(tmp_path / "raw"))
    folder = tmp_path / "sql"
    folder.mkdir()
    (folder / "daily_peak.sql").write_text(
        """
        SELECT athlete_id, activity_id, max(data) AS peak, CAST(:at AS TIMESTAMP) AS at
        FROM IDENTIFIER(:schema || 'heartrate')
        GROUP BY athlete_id, activity_id;
        """
    )
    builds = builds_of(str(folder))
    for _ in range(2):
        report = silver_refresh(tables, builds=builds, at=AT)
    assert rows(report) == [("daily_peak", 1, 1, 0)]
    schema = T.StructType.fromDDL("athlete_id string, activity_id string, peak double, at timestamp")
    assert rows(tables.silver("daily_peak", schema), "athlete_id", "peak") == [("0017", 101.0)]


def test_shipped_sql_equals_the_dataframe_form(spark, tables, tmp_path):
    root = tmp_path / "raw"
    bronze_load(tables, landing_tree(root))
    put(root, "0017", "time", 8, samples([3]))
    bronze_load(tables, str(root))
    silver_refresh(tables, at=AT)
    expected = rows(tables.silver().drop("athlete_bucket"))
    other = Tables(spark, tables.root, env="dev", buckets=4)
    scope = spark.createDataFrame([("0017",)], "athlete_id string")
    for options in ({}, {"athletes": scope}, {"athletes": scope, "activity_id": "8"}):
        report = silver_refresh(other, builds=builds_of(), at=AT, **options)
        assert [r[2] for r in rows(report)] == [{0: 5, 1: 4, 2: 1}[len(options)]]
        assert rows(tables.silver().drop("athlete_bucket")) == expected
