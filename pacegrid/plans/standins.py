"""The supplied tables in the shapes of the activity model.

Users of `events` are athletes, days are activities and event types are channels; vectors
of `embeddings` are sample documents; rows of `orders` are activity documents.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid.functions.schemas import ACTIVITY_SCHEMA
from pacegrid.model import CHANNELS
from pacegrid.operators.indexing import positional_index
from pacegrid.sinks.landing import as_document

EVENT_CHANNELS = {
    "view": "time",
    "click": "heartrate",
    "purchase": "watts",
    "signup": "altitude",
    "error": "latlng",
}
LOADED_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def channel_of(event_type: str) -> Column:
    pairs = [F.lit(x) for pair in EVENT_CHANNELS.items() for x in pair]
    return F.create_map(*pairs)[F.col(event_type)]


def day_of(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def event_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Identity of every document: one per user, day and event type."""
    keys = event_keys(spark, sf).select("athlete_id", "channel", "activity_id")
    return keys.distinct()


def event_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("athlete_id"),
        channel_of("event_type").alias("channel"),
        day_of("ts").alias("activity_id"),
        "event_id",
        "ts",
        "value",
        "props",
    )


def event_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Long sample rows; the index is the position in the user's day."""
    pair = F.col("channel") == "latlng"
    narrow = event_keys(spark, sf).select(
        "athlete_id",
        "channel",
        "activity_id",
        "event_id",
        "ts",
        F.when(~pair, F.col("value")).alias("data"),
        F.when(pair, F.col("value")).alias("latitude"),
        F.when(pair, F.get_json_object("props", "$.k").cast("double")).alias("longitude"),
    )
    keys = ["athlete_id", "activity_id", "channel"]
    indexed = positional_index(narrow, keys, ["ts", "event_id"], F.date_trunc("minute", "ts"))
    return indexed.drop("ts", "event_id")


def quoted_json(text: Column) -> Column:
    """JSON text encoded once more, as a JSON string."""
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def vector_documents(spark: SparkSession, sf: str) -> DataFrame:
    """A landed document per vector, which holds all of it; thirteen in a row are the channels of one activity."""
    order = F.col("vec_id") % len(CHANNELS)
    activity = F.floor(F.col("vec_id") / len(CHANNELS))
    values = F.col("embedding").cast("array<double>")
    framed = table(spark, sf, "embeddings").select(
        F.element_at(F.array(*map(F.lit, CHANNELS)), (order + 1).cast("int")).alias("channel"),
        F.format_string("%04d", activity % 7).alias("athlete_id"),
        activity.cast("string").alias("activity_id"),
        values.alias("v"),
        F.col("label").cast("string").alias("label"),
    )
    channel, v = F.col("channel"), F.col("v")
    texts = F.when(
        channel == "moving", F.transform(v, lambda x: (x > 0).cast("string"))
    ).otherwise(F.transform(v, lambda x: x.cast("string")))
    plain = F.concat(F.lit('{"data":['), F.array_join(texts, ","), F.lit('],"original_size":64,"series_type":"distance"}'))
    half = F.sequence(F.lit(1), F.lit(63), F.lit(2))
    pairs = F.to_json(
        F.struct(
            F.transform(half, lambda i: F.slice(v, i, F.lit(2))).alias("data"),
            F.lit(32).alias("original_size"),
            F.lit("distance").alias("series_type"),
        )
    )
    summary = F.to_json(
        F.struct(
            F.col("activity_id").cast("long").alias("id"),
            F.struct(F.col("athlete_id").alias("id")).alias("athlete"),
            F.concat(F.lit("Activity "), F.col("activity_id")).alias("name"),
            F.concat(F.lit("sport "), F.col("label")).alias("sport_type"),
            F.slice(v, 1, 2).alias("start_latlng"),
            v.alias("trace"),
        )
    )
    profile = quoted_json(F.to_json(F.struct(F.col("athlete_id").alias("id"), F.col("label").alias("city"), v.alias("trace"))))
    document = (
        F.when(channel == "latlng", pairs)
        .when(channel == "activity", summary)
        .when(channel == "athlete_summary", profile)
        .otherwise(plain)
    )
    return framed.select("athlete_id", "channel", "activity_id", document.alias("document"))


# Declared columns that an order's activity gets from parts of their own.
_OWN_PARTS = {
    "activity_id", "athlete_id", "athlete_resource_state", "map_id", "map_polyline", "map_summary_polyline", "name",
    "sport_type", "start_date", "distance", "kudos_count", "commute", "start_latitude", "start_longitude",
    "end_latitude", "end_longitude", "metadata_insert_timestamp",
}


def order_fillers() -> dict[str, str]:
    """A value for every other declared activity column, as SQL over an order that all dialects share."""
    made = {"bigint": "o_orderkey % {n}", "double": "o_totalprice * {n}", "boolean": "o_orderkey % {n} = 0", "string": "'{name} ' || o_orderkey"}
    return {
        field.name: made[field.dataType.simpleString()].format(n=n + 3, name=field.name)
        for n, field in enumerate(ACTIVITY_SCHEMA)
        if field.name not in _OWN_PARTS
    }


def start_of_order() -> Column:
    return F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def order_documents(spark: SparkSession, sf: str, part: Column | None = None) -> DataFrame:
    """An activity document per order, with every declared field and undeclared ones at both levels.

    `part` is a condition on the orders; documents of others aren't made.
    """
    orders = table(spark, sf, "orders")
    framed = (orders if part is None else orders.filter(part)).select(
        F.col("o_custkey").cast("string").alias("athlete_id"),
        F.lit("activity").alias("channel"),
        F.col("o_orderkey").cast("string").alias("activity_id"),
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_custkey").alias("id"), F.lit(2).alias("resource_state"), F.col("o_orderpriority").alias("nick")).alias("athlete"),
        F.struct(
            F.concat(F.lit("m"), F.col("o_orderkey")).alias("id"),
            F.concat(F.lit("p"), F.col("o_orderkey")).alias("polyline"),
            F.array("o_orderkey", "o_custkey").alias("bounds"),
        ).alias("map"),
        *[F.expr(text).alias(name) for name, text in order_fillers().items()],
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("sport_type"),
        start_of_order().alias("start_date"),
        F.col("o_totalprice").alias("distance"),
        (F.col("o_orderkey") % 7).alias("kudos_count"),
        (F.col("o_orderstatus") == "F").alias("commute"),
        F.when(F.col("o_orderstatus") == "F", F.array("o_totalprice", F.lit(1.5)))
        .when(F.col("o_orderstatus") == "O", F.array().cast("array<double>"))
        .alias("start_latlng"),
        F.lit(None).cast("array<double>").alias("end_latlng"),
        F.col("o_orderpriority").alias("device_name"),
    )
    body = [c for c in framed.columns if c not in ("athlete_id", "channel", "activity_id")]
    return as_document(framed, *body)


def line_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """A ledger: an order is loaded when one of its lines was returned."""
    lines = table(spark, sf, "lineitem")
    state = F.when(F.col("l_returnflag") == "R", F.lit("SUCCESS")).otherwise(F.lit("FAILURE"))
    return lines.select(
        F.lit("0").alias("athlete_id"),
        F.col("l_orderkey").cast("string").alias("activity_id"),
        F.lit("STRAVA").alias("data_source"),
        F.lit("activity").alias("data_stream"),
        F.lit(1).cast("long").alias("record_count"),
        state.alias("status"),
    )


def order_activities(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("athlete_id"),
        F.col("o_orderkey").cast("string").alias("activity_id"),
        start_of_order().alias("start_date"),
        "o_orderstatus",
    )


def user_connections(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers as users and as connection records.

    Furniture customers have no uid, those in debt no connection, building customers no
    athlete, and those of nation 0 an athlete without id.
    """
    customers = table(spark, sf, "customer")
    segment, uid = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    users = customers.select(F.when(segment != "FURNITURE", uid).alias("uid"))
    connections = customers.filter("c_acctbal >= 0").select(
        uid.alias("uid"),
        F.lit("strava").alias("source"),
        F.when(
            segment != "BUILDING",
            F.struct(F.when(F.col("c_nationkey") != 0, F.col("c_custkey")).alias("id"), F.col("c_name").alias("firstname")),
        ).alias("athlete"),
    )
    return users, connections
