import random
from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pacegrid.functions import columns as C
from pacegrid.operators import alignment, incremental, keyed, quality, reshape
from pacegrid.operators.indexing import positional_index
from pacegrid.operators.sql import sql_directory, sql_transform
from pacegrid.functions.schemas import struct_from_fields
from pacegrid.sources import landing
from pacegrid.sources.tables import connection_scan
from tests.conftest import rows

MEASURES = {"heartrate": ("heartrate", "data"), "latitude": ("latlng", "latitude"), "power": ("power", "data")}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# reshape


def test_decode_twice_encoded(spark):
    df = spark.createDataFrame([('{"a":1}',), ('"{\\"a\\": \\"q\\\\\\"x\\"}"',), (' "{}"',), (None,)], "value string")
    assert [r[0] for r in reshape.decode_document(df).collect()] == ['{"a":1}', '{"a": "q\\"x"}', "{}", None]


def test_flatten_and_clean(spark):
    df = spark.createDataFrame([((1, (2, [3])), 4)], "a struct<id int, b struct<`x y!` int, z array<int>>>, id int")
    flat = reshape.flatten(df)
    assert flat.columns == ["a.id", "a.b.x y!", "a.b.z", "id"]
    clean = reshape.clean_column_names(flat)
    assert clean.columns == ["a_id", "a_b_xy", "a_b_z", "id"]
    assert rows(reshape.ids_to_string(reshape.rename_id(clean, "activity_id"), "activity_id")) == [(1, 2, [3], "4")]


def test_clean_collision_raises(spark):
    with pytest.raises(ValueError, match="a_b"):
        reshape.clean_column_names(spark.createDataFrame([(1, 2)], "`a.b` int, a_b int"))


def test_explode_counts_and_indexes(spark):
    df = spark.createDataFrame([("x", [1.0, None]), ("y", None), ("z", [])], "k string, data array<double>")
    counted = reshape.with_record_count(df)
    assert rows(counted, "k", "record_count") == [("x", 2), ("y", 0), ("z", 0)]
    assert rows(reshape.explode_samples(df), "k", "index", "data") == [("x", 1, 1.0), ("x", 2, None)]


def test_pairs(spark):
    df = spark.createDataFrame([([1.0, 2.0],), (None,), ([3.0],), ([],)], "data array<double>")
    assert [tuple(r) for r in reshape.split_latlng(df).collect()] == [(1.0, 2.0), (None, None), (3.0, None), (None, None)]
    both = spark.createDataFrame([([1.0, 2.0], None), ([], [3.0, 4.0])], "start_latlng array<double>, end_latlng array<double>")
    split = reshape.split_optional_pairs(both)
    assert split.columns == ["start_latitude", "start_longitude", "end_latitude", "end_longitude"]
    assert [tuple(r) for r in split.collect()] == [(1.0, 2.0, None, None), (None, None, 3.0, 4.0)]


def test_bool_samples(spark):
    df = spark.createDataFrame([(["true", "false", None, "2.5", "x"],)], "data array<string>")
    assert reshape.bool_samples_to_double(df).first()[0] == [1.0, 0.0, None, 2.5, None]


def test_conform(spark):
    schema = struct_from_fields(
        [
            {"name": "id", "type": "STRING", "mode": "REQUIRED"},
            {"name": "n", "type": "INTEGER"},
            {"name": "gone", "type": "BOOLEAN"},
        ]
    )
    df = spark.createDataFrame([("a", "7", "k1"), (None, "x", "k2")], "id string, n string, other string")
    done = reshape.conform(df, schema)
    assert done.columns == ["id", "n", "gone", "_violations", "_extra"]
    assert [tuple(r) for r in done.collect()] == [
        ("a", 7, None, "", {"other": "k1"}),
        (None, None, None, "id,n", {"other": "k2"}),
    ]


def test_dispatch_in_order_and_identity(spark):
    df = spark.createDataFrame([(2.0,)], "data double")
    registry = {"watts": [lambda d: d.withColumn("data", F.col("data") + 1), lambda d: d.withColumn("data", F.col("data") * 10)]}
    assert reshape.dispatch("watts", df, registry).first()[0] == 30.0
    assert reshape.dispatch("time", df, registry) is df


def test_stamp_and_union(spark):
    at = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
    a = reshape.stamp(spark.createDataFrame([(1,)], "x int"), at)
    b = spark.createDataFrame([(2, "q")], "x int, y string")
    both = reshape.union_batches(a, b)
    text = F.date_format("metadata_insert_timestamp", "yyyy-MM-dd HH")
    assert rows(both.select("x", text.alias("t"), "y")) == [(1, "2024-01-01 12", None), (2, None, "q")]


def test_path_parts_and_bucket(spark):
    path = "file:/root/athlete_id=0017/heartrate/activity_id=9.json"
    df = spark.createDataFrame([(path,), ("file:/x/notes.json",)], "p string")
    parts = df.select(C.path_athlete(F.col("p")), C.path_channel(F.col("p")), C.path_activity(F.col("p")))
    assert [tuple(r) for r in parts.collect()] == [("0017", "heartrate", "9"), (None, None, None)]
    buckets = spark.range(100).select(C.bucket_of(F.col("id"), 4).alias("b")).distinct()
    assert rows(buckets) == [(0,), (1,), (2,), (3,)]


# incremental


def test_skip_processed_keeps_failures_and_other_sources(spark):
    files = spark.createDataFrame([("a", "time", str(i)) for i in range(4)], "athlete_id string, channel string, activity_id string")
    ledger = spark.createDataFrame(
        [("a", "0", "STRAVA", "time", "SUCCESS"), ("a", "1", "STRAVA", "time", "FAILURE"),
         ("a", "2", "OTHER", "time", "SUCCESS"), ("a", "3", "STRAVA", "watts", "SUCCESS")],
        "athlete_id string, activity_id string, data_source string, data_stream string, status string",
    )
    assert rows(incremental.skip_processed(files, ledger, "STRAVA"), "activity_id") == [("1",), ("2",), ("3",)]
    assert rows(incremental.processed_ids(ledger, "strava"), "channel", "activity_id") == [("time", "0"), ("watts", "3")]


def test_high_water(spark):
    old = spark.createDataFrame([("a", "2024-01-02T00:00:00Z"), ("a", "2024-01-01T00:00:00Z")], "athlete_id string, start_date string")
    new = spark.createDataFrame(
        [("a", "2024-01-02T00:00:00Z"), ("a", "2024-01-03T00:00:00Z"), ("b", "2020-01-01T00:00:00Z")],
        "athlete_id string, start_date string",
    )
    assert rows(incremental.newer_than(new, incremental.high_water_mark(old))) == [
        ("a", "2024-01-03T00:00:00Z"), ("b", "2020-01-01T00:00:00Z")]


def test_densify(spark):
    acts = spark.createDataFrame([("a", "1")], "athlete_id string, activity_id string")
    docs = spark.createDataFrame([("a", "time", "1", "{}")], "athlete_id string, channel string, activity_id string, document string")
    assert rows(incremental.densify_channels(acts, docs, ["time", "watts"]), "channel", "document") == [("time", "{}"), ("watts", None)]


def test_positional_index_equals_brute_force(spark):
    rng = random.Random(5)
    data = [(rng.choice(["hot"] * 6 + ["a", None]), rng.randrange(300), i) for i in range(800)]
    df = spark.createDataFrame(data, "k string, t int, id int")
    got = rows(positional_index(df, ["k"], ["t", "id"], F.floor(F.col("t") / 10)), "k", "t", "id", "index")
    expected, seen = [], {}
    for k, t, i in sorted(data, key=lambda r: (r[1], r[2])):
        seen[k] = seen.get(k, 0) + 1
        expected.append((k, t, i, seen[k]))
    assert got == sorted(expected, key=repr)


# alignment


def sample_frame(spark, data):
    return spark.createDataFrame(
        data, "athlete_id string, activity_id string, channel string, index long, data double, latitude double, longitude double"
    )


@pytest.mark.parametrize("how", ["agg", "join"])
def test_alignment(spark, how):
    frame = sample_frame(
        spark,
        [
            ("a", "1", "time", 1, 0.0, None, None),
            ("a", "1", "time", 2, None, None, None),
            ("a", "1", "heartrate", 1, 90.0, None, None),
            ("a", "1", "heartrate", 3, 91.0, None, None),
            ("a", "1", "latlng", 2, None, 5.0, 6.0),
            ("b", "1", "heartrate", 1, 70.0, None, None),
            ("a", "1", "noise", 1, 1.0, None, None),
        ],
    )
    assert rows(alignment.align_channels(frame, how, measures=MEASURES)) == [
        ("a", "1", 1, 0.0, 90.0, None, None),
        ("a", "1", 2, None, None, 5.0, None),
    ]


def test_both_forms_agree_on_random_samples(spark):
    rng = random.Random(3)
    keys = {(f"a{rng.randrange(3)}", str(rng.randrange(3)), c, rng.randrange(40)) for c in ("time", "heartrate", "latlng") for _ in range(300)}
    frame = sample_frame(spark, [(*k, rng.random(), rng.random(), rng.random()) for k in sorted(keys)])
    agg, join = (alignment.align_channels(frame, how) for how in ("agg", "join"))
    assert agg.count() > 0
    assert agg.exceptAll(join).isEmpty() and join.exceptAll(agg).isEmpty()


def test_repeated_sample_has_no_index_in_agg_and_multiplies_in_join(spark):
    frame = sample_frame(
        spark,
        [("a", "1", "time", 1, 0.0, None, None), ("a", "1", "heartrate", 1, 90.0, None, None), ("a", "1", "heartrate", 1, 91.0, None, None)],
    )
    assert rows(alignment.align_channels(frame, measures=MEASURES), "athlete_id", "index") == [("a", None)]
    assert alignment.align_channels(frame, "join", measures=MEASURES).count() == 2
    assert rows(alignment.repeated_samples(frame), "channel", "copies") == [("heartrate", 2)]


def test_alignment_plans(spark):
    frame = sample_frame(spark, [("a", "1", "time", 1, 0.0, None, None)])
    agg = plan_of(alignment.align_channels(frame))
    assert agg.count("Exchange hashpartitioning") == 1 and "Python" not in agg


def test_activity_dimension(spark):
    aligned = spark.createDataFrame([("a", "1", 1), ("a", "2", 1)], "athlete_id string, activity_id string, index long")
    dim = spark.createDataFrame([("a", "1", "Ride", "Bike"), ("a", "1", "Ride", "Bike")], "athlete_id string, activity_id string, name string, sport_type string")
    assert rows(alignment.add_activity(aligned, dim), "activity_id", "name", "sport_type") == [("1", "Ride", "Bike"), ("2", None, None)]


def test_athlete_slice(spark):
    many = spark.range(50).select(F.col("id").cast("string").alias("athlete_id"))
    frame = spark.createDataFrame([("1", "x"), ("99", "x"), ("2", "y")], "athlete_id string, activity_id string")
    assert rows(alignment.athlete_slice(frame, many)) == [("1", "x"), ("2", "y")]
    assert rows(alignment.athlete_slice(frame, many, "y")) == [("2", "y")]
    assert rows(alignment.athlete_slice(frame, None)) == rows(frame)


# quality and keyed updates


def test_connections(spark):
    users = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u4",), ("",), (None,)], "uid string")
    connections = spark.createDataFrame(
        [("u1", "strava", (1,)), ("u2", "strava", (None,)), ("u3", "strava", None), ("u4", "other", (4,))],
        "uid string, source string, athlete struct<id bigint>",
    )
    assert quality.keyless_users(users).count() == 2
    scanned = connection_scan(quality.drop_keyless_users(users), connections, "STRAVA")
    valid, rejected = quality.check_connections(scanned)
    assert rows(valid, "uid") == [("u1",)]
    assert rows(rejected, "uid", "reason") == [("u2", "missing_athlete_id"), ("u3", "missing_athlete_id"), ("u4", "no_connection")]


def test_ledger_states(spark):
    ledger = spark.createDataFrame(
        [("a", "time", 0, "SUCCESS"), ("a", "time", 2, "SUCCESS"), ("a", "watts", 0, "SUCCESS"), ("b", "time", 1, "FAILURE")],
        "athlete_id string, data_stream string, record_count long, status string",
    )
    assert rows(quality.without_empty_batches(ledger), "athlete_id", "data_stream", "record_count") == [
        ("a", "time", 0), ("a", "time", 2), ("b", "time", 1)]
    assert rows(quality.batch_status(ledger)) == [("a", 3, 0, "SUCCESS"), ("b", 0, 1, "FAILURE")]


def test_partial_update(spark):
    base = spark.createDataFrame([("u1", 1, "read", "Ann"), ("u2", 2, "read", "Bob")], "uid string, expires int, scope string, name string")
    changes = spark.createDataFrame(
        [("u1", 1, 10, "write", "Zed"), ("u1", 2, None, None, None), ("u3", 1, 30, "read", "Cy"), ("u3", 2, 31, "write", "Di")],
        "uid string, at int, expires int, scope string, name string",
    )
    assert rows(keyed.upsert(base, changes, ["uid"], "at", update=["expires"])) == [
        ("u1", 10, "read", "Ann"), ("u2", 2, "read", "Bob"), ("u3", 31, "read", "Cy")]
    assert rows(keyed.upsert(base, changes, ["uid"], "at")) == [
        ("u1", 10, "write", "Zed"), ("u2", 2, "read", "Bob"), ("u3", 31, "write", "Di")]


# landing helpers and SQL


def test_channel_lists():
    assert landing.filter_channels(include=["LATLNG", "TIME"], exclude=["TIME"]) == ["time", "latlng"]
    assert len(landing.filter_channels(exclude=["ACTIVITY", "ATHLETE_SUMMARY", "LATLNG"])) == 10
    assert landing.filter_channels(include=["time"]) == [] and landing.filter_channels() == []


def test_sample_is_per_athlete_and_channel(spark):
    files = spark.createDataFrame([(a, c, f"{i:03d}") for a in "ab" for c in ("time", "watts") for i in range(500)], "athlete_id string, channel string, file_path string")
    assert rows(landing.sample_files(files, 2).groupBy("athlete_id", "channel").agg(F.max("file_path"), F.count("*"))) == [
        (a, c, "001", 2) for a in "ab" for c in ("time", "watts")]


@pytest.mark.parametrize("text", ["DELETE FROM t", "DROP TABLE t", "INSERT INTO t SELECT 1", "SELECT 1) UNION (SELECT 2); DROP TABLE t"])
def test_only_select(spark, text):
    with pytest.raises(ValueError, match="Only SELECT"):
        sql_transform(spark, text)


def test_sql_parameters_and_directory(spark, tmp_path):
    (tmp_path / "per_channel.sql").write_text("WITH x AS (SELECT :a AS a) SELECT a + 1 AS b FROM x -- end\n;\n")
    (tmp_path / "notes.txt").write_text("no")
    texts = sql_directory(str(tmp_path))
    assert list(texts) == ["per_channel"]
    assert sql_transform(spark, texts["per_channel"], {"a": 4}).first()[0] == 5


def test_counters(spark):
    frame, counter = quality.observed(spark.range(7), "seven")
    assert frame.filter("id > 4").count() == 2 and counter.get == {"rows": 7}
    assert rows(quality.row_counters(a=spark.range(2), b=spark.range(0))) == [("a", 2), ("b", 0)]


def test_skip_processed_with_few_files(spark):
    files = spark.createDataFrame([("a", "time", "1"), ("a", "time", "2")], "athlete_id string, channel string, activity_id string")
    ledger = spark.createDataFrame([("a", "1", "STRAVA", "time", "SUCCESS")] * 50, "athlete_id string, activity_id string, data_source string, data_stream string, status string")
    for few in (True, False):
        assert rows(incremental.skip_processed(files, ledger, "STRAVA", few)) == [("a", "time", "2")]
