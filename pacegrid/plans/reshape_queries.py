"""Queries for projections, checks and sources that need no stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid.functions.columns import in_zone, iso_micros
from pacegrid.functions.schemas import struct_from_fields
from pacegrid.operators import quality, reshape
from pacegrid.operators.alignment import repeated_samples
from pacegrid.plans.registry import query
from pacegrid.plans.standins import channel_of, event_keys, event_samples, quoted_json, table
from pacegrid.sources import landing

EVENT_CHANNEL_SQL = """CASE event_type WHEN 'view' THEN 'time' WHEN 'click' THEN 'heartrate'
    WHEN 'purchase' THEN 'watts' WHEN 'signup' THEN 'altitude' WHEN 'error' THEN 'latlng' END"""

SAMPLES_SQL = f"""
samples AS (
  SELECT CAST(user_id AS VARCHAR) AS athlete_id, strftime(ts, '%Y-%m-%d') AS activity_id,
    {EVENT_CHANNEL_SQL} AS channel,
    row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY ts, event_id) AS "index",
    CASE WHEN event_type <> 'error' THEN value END AS data,
    CASE WHEN event_type = 'error' THEN value END AS latitude,
    CASE WHEN event_type = 'error' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS longitude
  FROM events
)"""


@query(
    """
SELECT CAST(vec_id AS VARCHAR) AS activity_id, unnest(range(1, len(embedding) + 1)) AS "index",
  CAST(unnest(embedding) AS DOUBLE) AS data, CAST(len(embedding) AS BIGINT) AS original_size
FROM embeddings
"""
)
def channel_explode(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("activity_id"),
        F.col("embedding").cast("array<double>").alias("data"),
    )
    counted = reshape.with_record_count(documents).withColumnRenamed("record_count", "original_size")
    return reshape.explode_samples(counted)


@query(
    """
SELECT vec_id, CAST(i // 2 AS INTEGER) AS pair, CAST(embedding[i] AS DOUBLE) AS latitude,
  CAST(embedding[i + 1] AS DOUBLE) AS longitude
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1, 2)) AS i FROM embeddings)
"""
)
def latlng_split(spark: SparkSession, sf: str) -> DataFrame:
    """Each vector as pairs of neighbours, all of them."""
    values = F.col("embedding").cast("array<double>")
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(2)), lambda i: i <= F.size(values))
    pairs = F.transform(starts, lambda i: F.slice(values, i, F.lit(2)))
    return reshape.split_latlng(table(spark, sf, "embeddings").select("vec_id", F.posexplode(pairs).alias("pair", "data")))


@query(
    """
SELECT event_id,
  CASE WHEN event_type = 'view' THEN value END AS start_latitude,
  CASE WHEN event_type = 'view' THEN CAST(user_id AS DOUBLE) END AS start_longitude,
  CASE WHEN event_type = 'purchase' THEN value END AS end_latitude,
  CAST(NULL AS DOUBLE) AS end_longitude
FROM events
"""
)
def optional_pair_split(spark: SparkSession, sf: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    nothing = F.array().cast("array<double>")
    return reshape.split_optional_pairs(
        table(spark, sf, "events").select(
            "event_id",
            F.when(kind == "view", F.array(value, F.col("user_id").cast("double")))
            .when(kind == "click", nothing)
            .alias("start_latlng"),
            F.when(kind == "purchase", F.array(value)).when(kind == "error", nothing).alias("end_latlng"),
        )
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k FROM events")
def props_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = F.from_json("props", "k bigint").alias("props")
    flat = reshape.flatten(table(spark, sf, "events").select("event_id", parsed))
    return reshape.clean_column_names(flat)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def double_encoded_decode(spark: SparkSession, sf: str) -> DataFrame:
    twice = F.when(F.col("event_id") % 2 == 0, quoted_json(F.col("props"))).otherwise(F.col("props"))
    landed = table(spark, sf, "events").select("event_id", twice.alias("value"))
    decoded = reshape.decode_document(landed)
    return decoded.select("event_id", F.from_json("value", "k bigint")["k"].alias("k"))


@query(
    """
SELECT CAST(c_custkey AS VARCHAR) AS athlete_id, c_name AS name, CAST(n_nationkey AS BIGINT) AS nation_id,
  n_name AS nation_name, r_name AS nation_region_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
)
def flatten_nested(spark: SparkSession, sf: str) -> DataFrame:
    nested = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.to_json(
                F.struct(
                    F.col("c_custkey").alias("id"),
                    F.col("c_name").alias("name"),
                    F.struct(
                        F.col("n_nationkey").alias("id"),
                        F.col("n_name").alias("name"),
                        F.struct(F.col("r_name").alias("name")).alias("region"),
                    ).alias("nation"),
                )
            ).alias("value")
        )
    )
    shape = "id bigint, name string, nation struct<id bigint, name string, region struct<name string>>"
    flat = reshape.flatten(nested.select(F.from_json("value", shape).alias("d")).select("d.*"))
    named = reshape.rename_id(reshape.clean_column_names(flat), "athlete_id")
    return reshape.ids_to_string(named, "athlete_id")


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS activity_id, i AS "index",
  CASE i WHEN 1 THEN CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END
         WHEN 2 THEN CASE WHEN o_totalprice > 200000 THEN 1.0 ELSE 0.0 END
         WHEN 3 THEN CAST(o_orderkey AS DOUBLE) END::DOUBLE AS data
FROM orders, range(1, 5) AS r(i)
"""
)
def bool_channel(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(
        F.lit('{"data":['),
        (F.col("o_orderstatus") == "F").cast("string"),
        F.lit(","),
        (F.col("o_totalprice") > 200000).cast("string"),
        F.lit(","),
        F.col("o_orderkey").cast("string"),
        F.lit(",null]}"),
    )
    documents = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("activity_id"),
        F.from_json(text, "data array<string>")["data"].alias("data"),
    )
    return reshape.explode_samples(reshape.bool_samples_to_double(documents))


@query(
    """
SELECT o_orderkey, 'latlng' AS channel, CAST(NULL AS DOUBLE) AS data,
  o_totalprice AS latitude, CAST(o_custkey AS DOUBLE) AS longitude
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, 'watts', o_totalprice, NULL, NULL FROM orders WHERE o_orderstatus <> 'F'
"""
)
def channel_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    shapes = {
        "latlng": (F.col("o_orderstatus") == "F", F.array("o_totalprice", F.col("o_custkey").cast("double"))),
        "watts": (F.col("o_orderstatus") != "F", F.col("o_totalprice")),
    }
    parts = [
        reshape.dispatch(
            channel,
            orders.filter(rule).select("o_orderkey", F.lit(channel).alias("channel"), data.alias("data")),
        )
        for channel, (rule, data) in shapes.items()
    ]
    return reshape.union_batches(*parts)


@query(f"""WITH {SAMPLES_SQL}
SELECT athlete_id, activity_id, channel, "index", data, latitude, longitude FROM samples
""")
def bronze_samples(spark: SparkSession, sf: str) -> DataFrame:
    return event_samples(spark, sf)


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS activity_id,
  CASE WHEN o_orderstatus = 'F' THEN FALSE END AS commute,
  TRY_CAST(substr(o_orderpriority, 1, CAST(1 + o_orderkey % 2 AS INTEGER)) AS BIGINT) AS kudos_count,
  CAST(NULL AS DOUBLE) AS distance,
  CASE WHEN o_orderstatus <> 'P' THEN 'S' || o_orderstatus END AS series_type,
  concat_ws(',', CASE WHEN o_orderstatus <> 'F' THEN 'commute' END,
    CASE WHEN o_orderkey % 2 = 1 THEN 'kudos_count' END,
    CASE WHEN o_orderstatus = 'P' THEN 'series_type' END) AS violations,
  o_orderpriority AS device_name
FROM orders
"""
)
def conform_columns(spark: SparkSession, sf: str) -> DataFrame:
    schema = struct_from_fields(
        [
            {"name": "activity_id", "type": "STRING", "mode": "REQUIRED"},
            {"name": "commute", "type": "BOOLEAN"},
            {"name": "kudos_count", "type": "INTEGER"},
            {"name": "distance", "type": "FLOAT"},
            {"name": "series_type", "type": "STRING", "mode": "REQUIRED"},
        ]
    )
    status = F.col("o_orderstatus")
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("activity_id"),
        status.alias("commute"),
        F.substr(F.col("o_orderpriority"), F.lit(1), (1 + F.col("o_orderkey") % 2).cast("int")).alias(
            "kudos_count"
        ),
        F.when(status != "P", F.concat(F.lit("S"), status)).alias("series_type"),
        F.col("o_orderpriority").alias("device_name"),
    )
    done = reshape.conform(raw, schema)
    return done.select(
        *schema.names,
        F.col("_violations").alias("violations"),
        F.col("_extra")["device_name"].alias("device_name"),
    )


@query(
    """
SELECT event_id, 'INCLUDED' AS picked FROM events WHERE event_type IN ('view', 'click')
UNION ALL
SELECT event_id, 'NOT_EXCLUDED' FROM events WHERE event_type NOT IN ('view', 'error')
"""
)
def select_channels(spark: SparkSession, sf: str) -> DataFrame:
    keys = event_keys(spark, sf).select("event_id", "channel")
    included = landing.select_channels(keys, include=["time", "heartrate"], exclude=["time"])
    others = landing.select_channels(keys, exclude=["time", "latlng"])
    return included.select("event_id", F.lit("INCLUDED").alias("picked")).unionByName(
        others.select("event_id", F.lit("NOT_EXCLUDED").alias("picked"))
    )


@query(
    """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'STRAVA' WHEN 'O' THEN 'strava' ELSE 'OTHER' END AS source,
  CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'unsupported_source' END AS reason
FROM orders
"""
)
def supported_source(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    source = F.when(status == "F", "STRAVA").when(status == "O", "strava").otherwise("OTHER")
    frame = table(spark, sf, "orders").select("o_orderkey", source.alias("source"))
    good, rejected = quality.supported_source(frame)
    return reshape.union_batches(good, rejected)


@query(
    """
SELECT CASE WHEN event_type = 'signup' THEN 'gyroscope' ELSE
  CASE event_type WHEN 'view' THEN 'time' WHEN 'click' THEN 'heartrate' WHEN 'purchase' THEN 'watts'
    ELSE 'latlng' END END AS channel,
  count(*) AS documents, event_type <> 'signup' AS known
FROM events GROUP BY event_type
"""
)
def discover_channels(spark: SparkSession, sf: str) -> DataFrame:
    channel = F.when(F.col("event_type") == "signup", "gyroscope").otherwise(channel_of("event_type"))
    return landing.discover_channels(table(spark, sf, "events").select(channel.alias("channel")))


@query(
    """
SELECT event_id, lpad(CAST(user_id AS VARCHAR), 4, '0') AS athlete_id, event_type AS channel,
  CASE WHEN event_id % 3 <> 0 THEN CAST(event_id AS VARCHAR) END AS activity_id,
  CASE WHEN event_id % 3 = 0 THEN 'no_activity_in_path' END AS reason
FROM events
"""
)
def file_identity(spark: SparkSession, sf: str) -> DataFrame:
    stem = F.when(F.col("event_id") % 3 == 0, F.lit("notes")).otherwise(
        F.concat(F.lit("activity_id="), F.col("event_id"))
    )
    path = F.concat(
        F.lit("file:/landing/athlete_id="),
        F.lpad(F.col("user_id").cast("string"), 4, "0"),
        F.lit("/"),
        F.col("event_type"),
        F.lit("/"),
        stem,
        F.lit(".json"),
    )
    files = table(spark, sf, "events").select("event_id", path.alias("path"))
    identified = landing.with_identity(files)
    return identified.select(
        "event_id",
        "athlete_id",
        "channel",
        "activity_id",
        landing.path_fault().alias("reason"),
    )


@query(
    """
WITH v(series_type, athlete_id, activity_id) AS (
  SELECT CASE WHEN event_type <> 'error' THEN event_type END,
    CASE WHEN user_id % 5 <> 0 THEN CAST(user_id AS VARCHAR) END, CAST(event_id AS VARCHAR) FROM events)
SELECT activity_id, 'series_type' AS "column" FROM v WHERE series_type IS NULL
UNION ALL
SELECT activity_id, 'athlete_id' FROM v WHERE athlete_id IS NULL
"""
)
def check_required(spark: SparkSession, sf: str) -> DataFrame:
    schema = struct_from_fields(
        [
            {"name": "data", "type": "FLOAT"},
            {"name": "series_type", "type": "STRING", "mode": "REQUIRED"},
            {"name": "athlete_id", "type": "STRING", "mode": "REQUIRED"},
        ]
    )
    kind, user = F.col("event_type"), F.col("user_id")
    frame = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("activity_id"),
        F.col("value").alias("data"),
        F.when(kind != "error", kind).alias("series_type"),
        F.when(user % 5 != 0, user.cast("string")).alias("athlete_id"),
    )
    return quality.check_required(frame, schema, ["activity_id"])


@query(
    """
SELECT 'time' AS channel, CAST(l_orderkey AS VARCHAR) AS athlete_id, CAST(l_orderkey AS VARCHAR) AS activity_id,
  CAST(l_linenumber AS BIGINT) AS "index", count(*) AS copies
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""
)
def sample_repeats(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("l_orderkey").cast("string")
    return repeated_samples(
        table(spark, sf, "lineitem").select(
            F.lit("time").alias("channel"),
            key.alias("athlete_id"),
            key.alias("activity_id"),
            F.col("l_linenumber").cast("long").alias("index"),
        )
    )


@query(
    """
SELECT event_id, strftime(timezone('America/Los_Angeles', timezone('UTC', ts)), '%Y-%m-%dT%H:%M:%S.%f') AS local_time
FROM events
"""
)
def local_refresh_time(spark: SparkSession, sf: str) -> DataFrame:
    local = iso_micros(in_zone(F.col("ts"), "America/Los_Angeles"))
    return table(spark, sf, "events").select("event_id", local.alias("local_time"))


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS price, CAST(NULL AS VARCHAR) AS flag
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), NULL, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
"""
)
def union_batches(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("id", F.col("o_orderkey").cast("string"))
    first = orders.filter("o_orderstatus = 'F'").select("id", F.col("o_totalprice").alias("price"))
    second = orders.filter("o_orderstatus <> 'F'").select(F.col("o_orderpriority").alias("flag"), "id")
    return reshape.union_batches(first, second)
