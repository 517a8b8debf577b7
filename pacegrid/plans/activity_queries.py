"""Queries for what is new, channel alignment, ledger and keyed updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid.functions.schemas import required_columns, schema_for_channel, struct_from_fields
from pacegrid.model import CHANNELS, SILVER_MEASURES
from pacegrid.operators import alignment, incremental, keyed, quality, reshape
from pacegrid.operators.sql import sql_transform
from pacegrid.plans.registry import query
from pacegrid.plans.reshape_queries import EVENT_CHANNEL_SQL, SAMPLES_SQL
from pacegrid.plans.standins import (
    EVENT_CHANNELS,
    LOADED_AT,
    event_keys,
    event_samples,
    line_ledger,
    order_activities,
    table,
    user_connections,
    vector_documents,
)
from pacegrid.sources import landing
from pacegrid.sources.tables import connection_scan


def _measure_sql(name: str) -> str:
    channel, column = SILVER_MEASURES[name]
    if channel in EVENT_CHANNELS.values():
        return f'{channel}.{column} AS {name}'
    return f"CAST(NULL AS DOUBLE) AS {name}"


def _aligned_sql(extra: str = "") -> str:
    joined = [c for c in EVENT_CHANNELS.values() if c != "time"]
    joins = "\n".join(
        f"LEFT JOIN (SELECT * FROM samples WHERE channel = '{c}') {c}"
        f' ON (t.athlete_id, t.activity_id, t."index") = ({c}.athlete_id, {c}.activity_id, {c}."index")'
        for c in joined
    )
    measures = ", ".join(_measure_sql(name) for name in SILVER_MEASURES)
    return (
        f'SELECT t.athlete_id, t.activity_id, t."index", t.data AS time, {measures}{extra}\n'
        f"FROM (SELECT * FROM samples WHERE channel = 'time') t\n{joins}"
    )


ALIGNED = f"WITH {SAMPLES_SQL}\n{_aligned_sql()}"

SILVER_WIDE = f"""WITH {SAMPLES_SQL}, aligned AS ({_aligned_sql()})
SELECT "index", time, {", ".join(SILVER_MEASURES)}, c_name AS name, c_mktsegment AS sport_type,
  athlete_id, activity_id, '2024-02-01' AS loaded_on
FROM aligned LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = athlete_id
"""

ORDER_ACTIVITY_SQL = """activity AS (
  SELECT CAST(o_custkey AS VARCHAR) AS athlete_id, CAST(o_orderkey AS VARCHAR) AS activity_id,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS start_date, o_orderstatus FROM orders
)"""


@query(ALIGNED)
def silver_align_agg(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align_channels(event_samples(spark, sf), "agg")


@query(ALIGNED)
def silver_align_join(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align_channels(event_samples(spark, sf), "join")


@query(SILVER_WIDE)
def silver_wide(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: every channel of a user's day side by side, with the customer."""
    athletes = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("athlete_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("sport_type"),
    )
    aligned = alignment.align_channels(event_samples(spark, sf))
    wide = alignment.silver_projection(
        alignment.add_activity(aligned, athletes, on=("athlete_id",)), LOADED_AT
    )
    loaded_on = F.date_format(F.to_utc_timestamp("metadata_insert_timestamp", F.current_timezone()), "yyyy-MM-dd")
    return wide.withColumn("loaded_on", loaded_on).drop("metadata_insert_timestamp")


@query(f"""WITH {SAMPLES_SQL}
SELECT athlete_id, activity_id, channel, "index", data FROM samples
WHERE athlete_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'MACHINERY')
  AND activity_id = '2024-01-05'
""")
def athlete_slice(spark: SparkSession, sf: str) -> DataFrame:
    athletes = table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'")
    athletes = athletes.select(F.col("c_custkey").cast("string").alias("athlete_id"))
    samples = event_samples(spark, sf).select("athlete_id", "activity_id", "channel", "index", "data")
    return alignment.athlete_slice(samples, athletes, activity_id="2024-01-05")


@query(
    """
SELECT DISTINCT '0' AS athlete_id, 'activity' AS channel, CAST(l_orderkey AS VARCHAR) AS activity_id
FROM lineitem WHERE l_returnflag = 'R'
"""
)
def processed_ids(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.processed_ids(line_ledger(spark, sf), "STRAVA")


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS activity_id, o_totalprice FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
"""
)
def skip_processed(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "orders").select(
        F.lit("0").alias("athlete_id"),
        F.lit("activity").alias("channel"),
        F.col("o_orderkey").cast("string").alias("activity_id"),
        "o_totalprice",
    )
    fresh = incremental.skip_processed(files, line_ledger(spark, sf), "STRAVA")
    return fresh.select("activity_id", "o_totalprice")


@query(
    f"""
WITH files AS (
  SELECT event_id, value, CAST(user_id AS VARCHAR) AS athlete_id, {EVENT_CHANNEL_SQL} AS channel,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY lpad(CAST(event_id AS VARCHAR), 12, '0')) AS rank
  FROM events)
SELECT athlete_id, channel, CAST(event_id AS VARCHAR) AS activity_id FROM files
WHERE rank <= 3 AND value <= 20
"""
)
def sampled_docs(spark: SparkSession, sf: str) -> DataFrame:
    keys = event_keys(spark, sf)
    files = keys.select(
        "athlete_id",
        "channel",
        F.col("event_id").cast("string").alias("activity_id"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("file_path"),
    )
    ledger = keys.select(
        "athlete_id",
        F.col("channel").alias("data_stream"),
        F.col("event_id").cast("string").alias("activity_id"),
        F.lit("STRAVA").alias("data_source"),
        F.when(F.col("value") > 20, F.lit("SUCCESS")).otherwise(F.lit("FAILURE")).alias("status"),
    )
    return incremental.skip_processed(landing.sample_files(files, 3), ledger, "STRAVA").drop("file_path")


@query(f"WITH {ORDER_ACTIVITY_SQL} SELECT athlete_id, max(start_date) AS high_water FROM activity GROUP BY athlete_id")
def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.high_water_mark(order_activities(spark, sf))


@query(
    f"""
WITH {ORDER_ACTIVITY_SQL}, marks AS (
  SELECT athlete_id, max(start_date) AS high_water FROM activity WHERE o_orderstatus = 'F' GROUP BY athlete_id)
SELECT athlete_id, activity_id, start_date FROM activity LEFT JOIN marks USING (athlete_id)
WHERE high_water IS NULL OR start_date > high_water
"""
)
def newer_than_high_water(spark: SparkSession, sf: str) -> DataFrame:
    activity = order_activities(spark, sf)
    marks = incremental.high_water_mark(activity.filter("o_orderstatus = 'F'"))
    return incremental.newer_than(activity.drop("o_orderstatus"), marks)


_DAYS_SQL = f"""days AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS athlete_id, strftime(ts, '%Y-%m-%d') AS activity_id FROM events
), delivered AS (
  SELECT CAST(user_id AS VARCHAR) AS athlete_id, strftime(ts, '%Y-%m-%d') AS activity_id,
    {EVENT_CHANNEL_SQL} AS channel, count(*) AS n FROM events GROUP BY ALL
), wanted AS (
  SELECT athlete_id, activity_id, channel FROM days,
    (VALUES ('time'), ('heartrate'), ('watts'), ('altitude'), ('latlng')) AS c(channel)
)"""


def _dense_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = event_keys(spark, sf).groupBy("athlete_id", "activity_id", "channel").agg(
        F.count(F.lit(1)).alias("record_count")
    )
    days = counts.select("athlete_id", "activity_id").distinct()
    return incremental.densify_channels(days, counts, list(EVENT_CHANNELS.values()))


@query(
    f"""
WITH {_DAYS_SQL}
SELECT athlete_id, activity_id, channel, n IS NOT NULL AS delivered
FROM wanted LEFT JOIN delivered USING (athlete_id, activity_id, channel)
"""
)
def densify_channels(spark: SparkSession, sf: str) -> DataFrame:
    dense = _dense_counts(spark, sf)
    return dense.withColumn("delivered", F.col("record_count").isNotNull()).drop("record_count")


_LEDGER_SQL = f"""{_DAYS_SQL}, ledger AS (
  SELECT athlete_id, activity_id, channel AS data_stream, coalesce(n, 0) AS record_count,
    CASE WHEN n >= 2 THEN 'FAILURE' ELSE 'SUCCESS' END AS status
  FROM wanted LEFT JOIN delivered USING (athlete_id, activity_id, channel))"""


def _dense_ledger(spark: SparkSession, sf: str) -> DataFrame:
    counted = _dense_counts(spark, sf).withColumn("record_count", F.coalesce("record_count", F.lit(0)))
    fault = F.when(F.col("record_count") >= 2, F.lit("too_many"))
    stated = quality.load_status(counted.withColumn("reason", fault)).drop("reason")
    return stated.withColumnRenamed("channel", "data_stream")


@query(f"WITH {_LEDGER_SQL} SELECT * FROM ledger")
def record_count_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return _dense_ledger(spark, sf)


@query(
    f"""
WITH {_LEDGER_SQL}
SELECT * FROM ledger WHERE (athlete_id, data_stream) IN (
  SELECT (athlete_id, data_stream) FROM ledger GROUP BY athlete_id, data_stream HAVING sum(record_count) > 0)
"""
)
def filled_batches(spark: SparkSession, sf: str) -> DataFrame:
    return quality.without_empty_batches(_dense_ledger(spark, sf))


@query(
    f"""
WITH {_LEDGER_SQL}
SELECT athlete_id, count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded,
  count(*) FILTER (WHERE status = 'FAILURE') AS failed,
  CASE WHEN count(*) FILTER (WHERE status = 'FAILURE') > 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS status
FROM ledger GROUP BY athlete_id
"""
)
def batch_status(spark: SparkSession, sf: str) -> DataFrame:
    return quality.batch_status(_dense_ledger(spark, sf))


_CONNECTED_SQL = """checked AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uid, CASE WHEN c_acctbal < 0 THEN 'no_connection'
      WHEN c_mktsegment = 'BUILDING' OR c_nationkey = 0 THEN 'missing_athlete_id' END AS reason
  FROM customer WHERE c_mktsegment <> 'FURNITURE'
)"""


@query(f"WITH {_CONNECTED_SQL} SELECT uid, reason FROM checked")
def check_connections(spark: SparkSession, sf: str) -> DataFrame:
    users, connections = user_connections(spark, sf)
    scanned = connection_scan(quality.drop_keyless_users(users), connections, "STRAVA")
    valid, rejected = quality.check_connections(scanned)
    return valid.select("uid", F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("uid", "reason")
    )


@query(
    """
WITH old AS (
  SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY'
), changes AS (
  SELECT o_custkey AS c_custkey, arg_min(CAST(o_orderdate AS DATE)::VARCHAR, o_orderkey) AS first_name,
    arg_max(o_totalprice, o_orderkey) AS last_balance,
    arg_max(o_orderstatus, o_orderkey) FILTER (WHERE o_orderstatus <> 'P') AS last_segment
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey
)
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
  CASE WHEN o.c_custkey IS NULL THEN n.first_name ELSE o.c_name END AS c_name,
  coalesce(n.last_balance, o.c_acctbal) AS c_acctbal,
  coalesce(n.last_segment, o.c_mktsegment) AS c_mktsegment
FROM old o FULL JOIN changes n ON o.c_custkey = n.c_custkey
"""
)
def upsert_partial(spark: SparkSession, sf: str) -> DataFrame:
    """Customers updated by their urgent orders, in order of order key, but for the name.

    Machinery customers are not known before, so they take the whole first record.
    """
    base = table(spark, sf, "customer").filter("c_mktsegment <> 'MACHINERY'").drop("c_nationkey")
    status = F.col("o_orderstatus")
    changes = (
        table(spark, sf, "orders")
        .filter("o_orderpriority = '1-URGENT'")
        .select(
            F.col("o_custkey").alias("c_custkey"),
            F.col("o_orderkey").alias("at"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("c_name"),
            F.col("o_totalprice").alias("c_acctbal"),
            F.when(status != "P", status).alias("c_mktsegment"),
        )
    )
    return keyed.upsert(base, changes, ["c_custkey"], "at", update=["c_acctbal", "c_mktsegment"])


@query(
    """
WITH old AS (
  SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'MACHINERY'
), changes AS (
  SELECT o_custkey AS c_custkey, arg_max(o_orderpriority, o_orderkey) AS c_name,
    arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS c_acctbal
  FROM orders GROUP BY o_custkey
)
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, coalesce(n.c_name, o.c_name) AS c_name,
  coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal
FROM old o FULL JOIN changes n ON o.c_custkey = n.c_custkey
"""
)
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-record merge: what a change leaves out keeps its value."""
    base = table(spark, sf, "customer").filter("c_mktsegment <> 'MACHINERY'")
    changes = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderkey").alias("at"),
        F.col("o_orderpriority").alias("c_name"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("c_acctbal"),
    )
    return keyed.upsert(base.select("c_custkey", "c_name", "c_acctbal"), changes, ["c_custkey"], "at")


@query(
    """
SELECT 'processed' AS counter, count(DISTINCT l_orderkey) AS rows FROM lineitem WHERE l_returnflag = 'R'
UNION ALL
SELECT 'users', count(*) FROM customer WHERE c_mktsegment <> 'FURNITURE'
UNION ALL
SELECT 'users_without_uid', count(*) FROM customer WHERE c_mktsegment = 'FURNITURE'
"""
)
def row_counters(spark: SparkSession, sf: str) -> DataFrame:
    users, _ = user_connections(spark, sf)
    return quality.row_counters(
        processed=incremental.processed_ids(line_ledger(spark, sf), "STRAVA"),
        users=quality.drop_keyless_users(users),
        users_without_uid=quality.keyless_users(users),
    )


_PER_DAY = """
SELECT athlete_id, activity_id, count(*) AS samples, max(data) AS greatest
FROM IDENTIFIER(:samples)
WHERE channel = :channel AND (:activity_id IS NULL OR activity_id = :activity_id)
GROUP BY athlete_id, activity_id;
"""


@query(
    """
SELECT CAST(user_id AS VARCHAR) AS athlete_id, strftime(ts, '%Y-%m-%d') AS activity_id,
  count(*) AS samples, max(value) AS greatest
FROM events WHERE event_type = 'purchase' GROUP BY ALL
"""
)
def sql_transform_days(spark: SparkSession, sf: str) -> DataFrame:
    keys = event_keys(spark, sf).select("athlete_id", "activity_id", "channel", F.col("value").alias("data"))
    keys.createOrReplaceTempView("pacegrid_event_samples")
    args = {"samples": "pacegrid_event_samples", "channel": "watts", "activity_id": None}
    return sql_transform(spark, _PER_DAY, args)


@query(
    """
SELECT CAST(user_id AS VARCHAR) AS athlete_id, strftime(ts, '%Y-%m-%d') AS activity_id,
  count(*) AS samples, max(value) AS greatest
FROM events WHERE event_type = 'click' AND strftime(ts, '%Y-%m-%d') = '2024-01-09' GROUP BY ALL
"""
)
def sql_transform_one_activity(spark: SparkSession, sf: str) -> DataFrame:
    keys = event_keys(spark, sf).select("athlete_id", "activity_id", "channel", F.col("value").alias("data"))
    keys.createOrReplaceTempView("pacegrid_event_samples")
    args = {"samples": "pacegrid_event_samples", "channel": "heartrate", "activity_id": "2024-01-09"}
    return sql_transform(spark, _PER_DAY, args)


@query(
    """
SELECT kind, kind <> 'F' AS refused, CASE WHEN kind = 'F' THEN n ELSE 0 END AS orders
FROM (SELECT o_orderstatus AS kind, count(*) AS n FROM orders GROUP BY o_orderstatus)
"""
)
def guarded_sql(spark: SparkSession, sf: str) -> DataFrame:
    """A text per order state: the SELECT runs, statements that change something are refused before they do."""
    table(spark, sf, "orders").createOrReplaceTempView("pacegrid_orders")
    counted = "SELECT o_orderstatus AS kind, count(*) AS orders FROM pacegrid_orders GROUP BY o_orderstatus"
    texts = {"F": counted, "O": f"INSERT INTO pacegrid_orders {counted}", "P": "DROP VIEW pacegrid_orders"}
    found = spark.sql(counted)
    states = found.select("kind", F.lit(True).alias("refused"), F.lit(0).cast("long").alias("orders"))
    parts = []
    for kind, text in texts.items():
        own = F.col("kind") == kind
        try:
            parts.append(sql_transform(spark, text).filter(own).select("kind", F.lit(False).alias("refused"), "orders"))
        except ValueError:
            parts.append(states.filter(own))
    return reshape.union_batches(*parts)


@query(
    """
WITH docs AS (
  SELECT ['activity', 'athlete_summary', 'time', 'distance', 'latlng', 'altitude', 'velocity_smooth', 'heartrate', 'cadence',
    'watts', 'temp', 'moving', 'grade_smooth'][vec_id % 13 + 1] AS channel FROM embeddings
)
SELECT channel, count(*) AS documents,
  CASE channel WHEN 'activity' THEN 60 WHEN 'athlete_summary' THEN 59 WHEN 'latlng' THEN 8 ELSE 7 END AS n_columns,
  CASE channel WHEN 'activity' THEN 'activity_id,athlete_id,metadata_insert_timestamp'
    WHEN 'athlete_summary' THEN 'athlete_id,metadata_insert_timestamp'
    WHEN 'latlng' THEN 'athlete_id,activity_id,metadata_insert_timestamp'
    ELSE 'series_type,athlete_id,activity_id,metadata_insert_timestamp' END AS required
FROM docs GROUP BY channel
"""
)
def declared_channels(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of each channel beside the schema declared for it."""
    schemas = {channel: schema_for_channel("strava", channel) for channel in CHANNELS}

    def told(value) -> Column:
        return F.create_map(*[F.lit(x) for channel, schema in schemas.items() for x in (channel, value(schema))])[F.col("channel")]

    counted = vector_documents(spark, sf).groupBy("channel").agg(F.count(F.lit(1)).alias("documents"))
    return counted.select(
        "channel", "documents", told(lambda s: len(s)).alias("n_columns"), told(lambda s: ",".join(required_columns(s))).alias("required")
    )


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS held,
  TRY_CAST(o_orderpriority[1:1] AS BIGINT) AS rank, CAST(NULL AS DOUBLE) AS weight,
  CASE WHEN o_orderstatus = 'F' THEN CASE WHEN TRY_CAST(o_orderpriority[1:1] AS BIGINT) IS NULL THEN 'rank' ELSE '' END
    WHEN TRY_CAST(o_orderpriority[1:1] AS BIGINT) IS NULL THEN 'held,rank' ELSE 'held' END AS _violations
FROM orders
"""
)
def field_list_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in the shape of a field list as it stands in a JSON file: types, modes, an absent column."""
    fields = [
        {"name": "o_orderkey", "type": "STRING", "mode": "REQUIRED"},
        {"name": "held", "type": "INTEGER", "mode": "REQUIRED", "description": "customer of a finished order"},
        {"name": "rank", "type": "INTEGER"},
        {"name": "weight", "type": "FLOAT"},
    ]
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("held"), F.left("o_orderpriority", F.lit(1)).alias("rank")
    )
    return reshape.conform(orders, struct_from_fields(fields), extra=None)


@query(
    f"""WITH {SAMPLES_SQL}
SELECT athlete_id, activity_id, "index", true AS stamped_now FROM samples WHERE channel = 'time'
"""
)
def silver_stamped_now(spark: SparkSession, sf: str) -> DataFrame:
    """Without a load time the wide rows carry the time of the query."""
    wide = alignment.silver_projection(alignment.align_channels(event_samples(spark, sf)).withColumns(dict.fromkeys(("name", "sport_type"), F.lit(None).cast("string"))))
    stamped = F.col("metadata_insert_timestamp") == F.current_timestamp()
    return wide.select("athlete_id", "activity_id", "index", stamped.alias("stamped_now"))
