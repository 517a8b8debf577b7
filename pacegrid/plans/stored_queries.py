"""Queries that land, load, refresh or replace stored tables and read the result."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid.functions.columns import iso_micros
from pacegrid.functions.schemas import ACTIVITY_SCHEMA
from pacegrid.model import CHANNELS, SILVER_MEASURES
from pacegrid.operators.reshape import decode_document
from pacegrid.plans import bronze
from pacegrid.plans.bronze import load_documents
from pacegrid.plans.registry import query
from pacegrid.plans.runs import full_run as run_full
from pacegrid.plans.runs import run_all
from pacegrid.plans.silver import builds_of, silver_refresh
from pacegrid.plans.standins import (
    LOADED_AT,
    order_activities,
    order_documents,
    order_fillers,
    start_of_order,
    table,
    vector_documents,
)
from pacegrid.session import scratch_path
from pacegrid.sinks.landing import as_document, land_files, land_raw
from pacegrid.sinks.tables import compact, compact_bronze, replace_by_key, stage_bucketed, upsert_by_key
from pacegrid.sources import landing
from pacegrid.sources.tables import Tables, current_versions, read_bucketed
from pacegrid.streaming.ingest import ingest_available

_CHANNEL_LIST = "[" + ", ".join(f"'{c}'" for c in CHANNELS) + "]"

VECTORS_SQL = f"""docs AS (
  SELECT {_CHANNEL_LIST}[vec_id % {len(CHANNELS)} + 1] AS channel,
    lpad(CAST((vec_id // {len(CHANNELS)}) % 7 AS VARCHAR), 4, '0') AS athlete_id,
    CAST(vec_id // {len(CHANNELS)} AS VARCHAR) AS activity_id,
    CAST(embedding AS DOUBLE[]) AS v, CAST(label AS VARCHAR) AS label
  FROM embeddings
), samples AS (
  SELECT athlete_id, channel, activity_id, i AS "index",
    CASE WHEN channel = 'latlng' THEN NULL WHEN channel = 'moving' THEN CASE WHEN v[i] > 0 THEN 1.0 ELSE 0.0 END
      ELSE v[i] END::DOUBLE AS data,
    CASE WHEN channel = 'latlng' THEN v[2 * i - 1] END AS latitude,
    CASE WHEN channel = 'latlng' THEN v[2 * i] END AS longitude,
    CASE WHEN channel = 'latlng' THEN 32 ELSE 64 END::BIGINT AS original_size, 'distance' AS series_type
  FROM docs, range(1, 65) AS r(i)
  WHERE channel NOT IN ('activity', 'athlete_summary') AND (channel <> 'latlng' OR i <= 32)
)"""


def _tables(spark: SparkSession) -> Tables:
    return Tables(spark, scratch_path(spark, "tables"), buckets=16)


def _landed(spark: SparkSession, documents: DataFrame) -> str:
    root = scratch_path(spark, "landing")
    land_raw(documents, root, LOADED_AT)
    return root


@query(
    f"""WITH {VECTORS_SQL}
SELECT athlete_id, channel, activity_id, '20240201T000000000000' AS landed,
  CASE WHEN channel = 'athlete_summary' THEN label END AS city, i AS place,
  CASE WHEN channel <> 'moving' THEN v[i] WHEN v[i] > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS number
FROM docs, range(1, 65) AS r(i)
"""
)
def raw_document_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Every number of every body, of all channels."""
    root = _landed(spark, vector_documents(spark, sf))
    scanned = decode_document(landing.scan_packed(spark, root, list(CHANNELS)))
    body, channel = F.coalesce(*(F.get_json_object("value", f"$.{name}") for name in ("data", "trace"))), F.col("channel")
    numbers = (
        F.when(channel == "latlng", F.flatten(F.from_json(body, "array<array<double>>")))
        .when(channel == "moving", F.from_json(body, "array<boolean>").cast("array<double>"))
        .otherwise(F.from_json(body, "array<double>"))
    )
    city = F.when(channel == "athlete_summary", F.get_json_object("value", "$.city")).alias("city")
    rows = scanned.select("athlete_id", "channel", "activity_id", "landed", city, F.posexplode(numbers).alias("place", "number"))
    return rows.withColumn("place", F.col("place").cast("long") + 1)


@query(f"WITH {VECTORS_SQL} SELECT * FROM samples")
def bronze_load(spark: SparkSession, sf: str) -> DataFrame:
    tables = _tables(spark)
    bronze.bronze_load(tables, _landed(spark, vector_documents(spark, sf)), LOADED_AT, layout="packed")
    return tables.samples().drop("metadata_insert_timestamp")


@query(
    f"""WITH {VECTORS_SQL}
SELECT athlete_id, activity_id, 'STRAVA' AS data_source, channel AS data_stream,
  CASE WHEN channel IN ('activity', 'athlete_summary') THEN 1 WHEN channel = 'latlng' THEN 32 ELSE 64 END::BIGINT
    AS record_count, 'SUCCESS' AS status
FROM docs WHERE NOT (channel = 'watts' AND label <> '0')
UNION ALL
SELECT athlete_id, activity_id, 'STRAVA', channel, 0, 'FAILURE' FROM docs WHERE channel = 'watts' AND label <> '0'
"""
)
def load_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Some documents cut short: they alone are logged as failed."""
    tables = _tables(spark)
    broken = F.col("channel") == "watts"
    label = table(spark, sf, "embeddings").select(
        F.floor(F.col("vec_id") / len(CHANNELS)).cast("string").alias("activity_id"),
        F.element_at(
            F.array(*map(F.lit, CHANNELS)), (F.col("vec_id") % len(CHANNELS) + 1).cast("int")
        ).alias("channel"),
        "label",
    )
    documents = vector_documents(spark, sf).join(label, ["activity_id", "channel"])
    cut = F.when(broken & (F.col("label") != 0), F.left("document", F.lit(20))).otherwise(F.col("document"))
    root = _landed(spark, documents.withColumn("document", cut).drop("label"))
    load_documents(landing.scan_packed(spark, root), tables, LOADED_AT)
    return tables.ledger().drop("bq_insert_timestamp")


_ORDER_COLUMNS = ", ".join(f"{text} AS {name}" for name, text in order_fillers().items())


@query(
    f"""
SELECT CAST(o_orderkey AS VARCHAR) AS activity_id, CAST(o_custkey AS VARCHAR) AS athlete_id,
  CAST(2 AS BIGINT) AS athlete_resource_state, 'm' || o_orderkey AS map_id, 'p' || o_orderkey AS map_polyline,
  CAST(NULL AS VARCHAR) AS map_summary_polyline, o_orderpriority AS name,
  o_orderstatus AS sport_type, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS start_date,
  o_totalprice AS distance, o_orderkey % 7 AS kudos_count, o_orderstatus = 'F' AS commute,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS start_latitude,
  CASE WHEN o_orderstatus = 'F' THEN 1.5 END::DOUBLE AS start_longitude,
  CAST(NULL AS DOUBLE) AS end_latitude, CAST(NULL AS DOUBLE) AS end_longitude, {_ORDER_COLUMNS},
  '2024-02-01T00:00:00.000000' AS stamped, o_orderpriority AS device_name, o_orderpriority AS nick,
  '[' || o_orderkey || ',' || o_custkey || ']' AS bounds, 3 AS n_undeclared
FROM orders
"""
)
def bronze_activity(spark: SparkSession, sf: str) -> DataFrame:
    """All declared columns, and what the documents hold beyond them, also inside `athlete` and `map`."""
    tables = _tables(spark)
    root = _landed(spark, order_documents(spark, sf))
    bronze.bronze_load(tables, root, LOADED_AT, layout="packed")
    extra = F.col("_extra")
    return tables.bronze("activity").select(
        *[c for c in ACTIVITY_SCHEMA.names if c != "metadata_insert_timestamp"],
        iso_micros(F.col("metadata_insert_timestamp")).alias("stamped"),
        extra["device_name"].alias("device_name"),
        extra["athlete.nick"].alias("nick"),
        extra["map.bounds"].alias("bounds"),
        F.size(extra).alias("n_undeclared"),
    )


@query(
    f"""WITH {VECTORS_SQL}
SELECT athlete_id, activity_id, channel, channel NOT IN ('activity', 'athlete_summary') AS sampled,
  strftime(TIMESTAMP '2024-02-01' + INTERVAL (CASE WHEN channel = 'time' THEN 1 ELSE 0 END) HOUR, '%Y-%m-%dT%H:%M:%S.000000') AS logged,
  CASE WHEN channel IN ('activity', 'athlete_summary') THEN NULL
    ELSE strftime(TIMESTAMP '2024-02-01' + INTERVAL (CASE WHEN channel = 'time' THEN 1 ELSE 0 END) HOUR, '%Y-%m-%dT%H:%M:%S.000000') END AS stamped,
  CASE WHEN channel IN ('activity', 'athlete_summary') THEN 0 ELSE 1 END AS n_stamps
FROM docs
"""
)
def stamp_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches: every document's ledger row beside the one stamp that all its samples carry."""
    tables, documents = _tables(spark), vector_documents(spark, sf).withColumnRenamed("document", "value")
    for n, part in enumerate(("channel <> 'time'", "channel = 'time'")):
        load_documents(documents.filter(part), tables, LOADED_AT + timedelta(hours=n))
    key = ["athlete_id", "activity_id", "channel"]
    stamps = tables.samples().groupBy(*key).agg(
        F.max("metadata_insert_timestamp").alias("at"), F.count_distinct("metadata_insert_timestamp").cast("int").alias("n_stamps")
    )
    logged = tables.ledger().withColumnRenamed("data_stream", "channel")
    return logged.join(stamps, key, "left").select(
        *key,
        F.col("at").isNotNull().alias("sampled"),
        iso_micros(F.col("bq_insert_timestamp")).alias("logged"),
        iso_micros(F.col("at")).alias("stamped"),
        F.coalesce("n_stamps", F.lit(0)).alias("n_stamps"),
    )


def _silver_sql() -> str:
    fields = ", ".join(
        f"max(s.{column}) FILTER (WHERE s.channel = '{channel}') AS {name}"
        for name, (channel, column) in SILVER_MEASURES.items()
    )
    return f"""WITH {VECTORS_SQL}, wide AS (
  SELECT s.athlete_id, s.activity_id, s."index", max(s.data) FILTER (WHERE s.channel = 'time') AS time, {fields}
  FROM samples s GROUP BY s.athlete_id, s.activity_id, s."index"
)
SELECT wide.*, 'Activity ' || d.activity_id AS name, 'sport ' || d.label AS sport_type
FROM wide LEFT JOIN docs d ON d.channel = 'activity' AND d.athlete_id = wide.athlete_id AND d.activity_id = wide.activity_id
WHERE time IS NOT NULL"""


SILVER_SQL = _silver_sql()


@query(SILVER_SQL)
def silver_table(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded in two batches and refreshed after each; the second replaces the first."""
    tables = _tables(spark)
    documents = vector_documents(spark, sf)
    first = F.col("activity_id").cast("long") % 2 == 0
    root = scratch_path(spark, "landing")
    for n, part in enumerate((first, ~first)):
        at = LOADED_AT + timedelta(hours=n)
        land_raw(documents.filter(part), root, at)
        load_documents(landing.scan_packed(spark, root, landed_since=at), tables, at)
        silver_refresh(tables, at=at)
    return tables.silver().drop("athlete_bucket", "metadata_insert_timestamp")


@query(SILVER_SQL)
def silver_shipped_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The wide table by the SELECT that is shipped as a file."""
    tables = _tables(spark)
    bronze.bronze_load(tables, _landed(spark, vector_documents(spark, sf)), LOADED_AT, layout="packed")
    silver_refresh(tables, at=LOADED_AT, builds=builds_of())
    return tables.silver().drop("athlete_bucket", "metadata_insert_timestamp")


@query(f"WITH {VECTORS_SQL} SELECT * FROM samples")
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings, three stream runs; the last finds nothing."""
    tables, root, log = _tables(spark), scratch_path(spark, "landing"), scratch_path(spark, "stream")
    documents = vector_documents(spark, sf)
    late = F.col("activity_id").cast("long") % 3 == 0
    for n, part in enumerate((~late, late, None)):
        if part is not None:
            land_raw(documents.filter(part), root, LOADED_AT + timedelta(hours=n))
        ingest_available(tables, root, log, layout="packed").awaitTermination()
    return tables.samples().drop("metadata_insert_timestamp")


@query(SILVER_SQL)
def incremental_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings, three stream runs that go on to silver; the last has a lost checkpoint and changes nothing."""
    tables, root, log = _tables(spark), scratch_path(spark, "landing"), scratch_path(spark, "stream")
    documents = vector_documents(spark, sf)
    late = F.col("activity_id").cast("long") % 3 == 0
    for n, part in enumerate((~late, late, None)):
        if part is not None:
            land_raw(documents.filter(part), root, LOADED_AT + timedelta(hours=n))
        run = log if part is not None else f"{log}-lost"
        ingest_available(tables, root, run, layout="packed", silver=True).awaitTermination()
    return tables.silver().drop("athlete_bucket", "metadata_insert_timestamp")


@query("SELECT CAST(o_custkey AS VARCHAR) AS athlete_id, max(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')) AS high_water FROM orders GROUP BY ALL")
def kept_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Orders before 1995, then the others, loaded as activities; marks come from what each load keeps."""
    tables, early = _tables(spark), start_of_order() < "1995"
    for n, part in enumerate((early, ~early)):
        documents = order_documents(spark, sf, part).withColumnRenamed("document", "value")
        load_documents(documents, tables, LOADED_AT + timedelta(hours=n))
    return tables.marks()


@query(
    """
SELECT CAST(o_custkey AS VARCHAR) AS athlete_id, CAST(o_orderkey AS VARCHAR) AS activity_id,
  CASE WHEN o_orderkey % 3 <> 2 THEN o_totalprice END AS data,
  CASE WHEN o_orderkey % 3 = 2 THEN 'malformed_json' END AS reason, CASE WHEN o_orderkey % 3 = 2 THEN 3 END::BIGINT AS attempts
FROM orders
"""
)
def quarantine_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Two of three bodies are cut short and fail; half of those are mended and loaded, the rest is tried again.

    What the bronze table holds, beside the documents that are still in quarantine.
    """
    tables, kind = _tables(spark), F.col("activity_id").cast("long") % 3
    price = F.col("o_totalprice").cast("string")
    whole = F.concat(F.lit('{"data":['), price, F.lit('],"original_size":1,"series_type":"time"}'))
    documents = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("athlete_id"),
        F.lit("watts").alias("channel"),
        F.col("o_orderkey").cast("string").alias("activity_id"),
        F.when(F.col("o_orderkey") % 3 == 0, whole).otherwise(F.regexp_replace(whole, "}$", "")).alias("value"),
    )
    load_documents(documents, tables, LOADED_AT)
    closed = F.when(kind == 1, F.concat("value", F.lit("}"))).otherwise(F.col("value"))
    bronze.reload_failed(tables, lambda held: held.withColumn("value", closed), LOADED_AT + timedelta(hours=1))
    bronze.reload_failed(tables, at=LOADED_AT + timedelta(hours=2))
    held = tables.quarantine().select("athlete_id", "activity_id", F.lit(None).cast("double").alias("data"), "reason", "attempts")
    loaded = tables.samples().select("athlete_id", "activity_id", "data", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("long").alias("attempts"))
    return loaded.unionByName(held)


@query(
    f"""WITH {VECTORS_SQL}
SELECT * FROM samples WHERE channel <> 'cadence'
UNION ALL
SELECT athlete_id, channel, activity_id, 1, 2.0, NULL, NULL, 1, 'time' FROM docs WHERE channel = 'cadence'
"""
)
def landed_again(spark: SparkSession, sf: str) -> DataFrame:
    """Every document is landed short, then all but cadence whole; the later one counts."""
    tables, root, documents = _tables(spark), scratch_path(spark, "landing"), vector_documents(spark, sf)
    short = F.lit('{"data":[2.0],"original_size":1,"series_type":"time"}')
    land_raw(documents.withColumn("document", short), root, LOADED_AT)
    land_raw(documents.filter("channel <> 'cadence'"), root, LOADED_AT + timedelta(hours=1))
    bronze.bronze_load(tables, root, LOADED_AT, layout="packed")
    return tables.samples().drop("metadata_insert_timestamp")


_REPLACED_SQL = """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
UNION ALL
SELECT o_custkey, o_orderkey, 2 * o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') AND o_orderpriority = '1-URGENT'
"""


def _replaced(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    columns = ["o_custkey", "o_orderkey", "o_totalprice"]
    path, buckets = scratch_path(spark, "orders"), 16
    replace_by_key(path, orders.select(columns), None, buckets, on=("o_custkey",))
    keys = table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'")
    keys = keys.select(F.col("c_custkey").alias("o_custkey"))
    urgent = orders.filter("o_orderpriority = '1-URGENT'").join(keys, "o_custkey", "left_semi")
    new = urgent.withColumn("o_totalprice", 2 * F.col("o_totalprice")).select(columns)
    return path, replace_by_key(path, new, keys, buckets, on=("o_custkey",))


@query(_REPLACED_SQL)
def replace_by_key_state(spark: SparkSession, sf: str) -> DataFrame:
    """Machinery customers replaced by their urgent orders; those without any end up gone."""
    path, _ = _replaced(spark, sf)
    return _orders_at(spark, sf, path)


def _orders_at(spark: SparkSession, sf: str, path: str) -> DataFrame:
    schema = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice").schema
    return read_bucketed(spark, path, schema).drop("athlete_bucket")


@query(_REPLACED_SQL)
def replace_by_key_unswitched(spark: SparkSession, sf: str) -> DataFrame:
    """The same, then all orders are replaced by none in a run that dies before its switch: nothing has changed."""
    path, _ = _replaced(spark, sf)
    rows = _orders_at(spark, sf, path)
    stage_bucketed(rows.limit(0), 16, "o_custkey").write.partitionBy("athlete_bucket").parquet(f"{path}/rows/version=lost")
    return _orders_at(spark, sf, path)


@query("SELECT o_custkey, o_orderkey, o_totalprice, CAST(1 AS INTEGER) AS versions FROM orders")
def compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Orders added in five rounds of new customers, then compacted: the same rows, one version a bucket."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    path = scratch_path(spark, "orders")
    for n in range(5):
        part = orders.filter(F.col("o_custkey") % 5 == n)
        replace_by_key(path, part, part.select("o_custkey"), 4, on=("o_custkey",))
    compact(spark, path, orders.schema)
    versions = current_versions(spark, path).filter("athlete_bucket >= 0").groupBy("athlete_bucket").agg(F.count(F.lit(1)).cast("int").alias("versions"))
    return read_bucketed(spark, path, orders.schema).join(versions, "athlete_bucket").drop("athlete_bucket")


@query(
    """
SELECT count(*) AS deleted, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS inserted
FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'MACHINERY'
"""
)
def replace_by_key_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _replaced(spark, sf)[1]


@query(
    f"""
WITH {VECTORS_SQL}, people AS (
  SELECT c_mktsegment <> 'BUILDING' AS linked, CAST(c_custkey AS VARCHAR) AS uid,
    CASE WHEN c_custkey < 1000 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0') ELSE CAST(c_custkey AS VARCHAR) END
      AS athlete_id
  FROM customer
), per_athlete AS (SELECT athlete_id, count(*) AS n FROM docs GROUP BY athlete_id)
SELECT uid, CASE WHEN linked THEN athlete_id END AS athlete_id,
  CASE WHEN linked THEN coalesce(n, 0) ELSE 0 END AS succeeded, CAST(0 AS BIGINT) AS failed,
  CASE WHEN linked THEN 'SUCCESS' ELSE 'FAILURE' END AS status,
  CASE WHEN NOT linked THEN 'missing_athlete_id' END AS reason
FROM people LEFT JOIN per_athlete USING (athlete_id)
"""
)
def all_athletes(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer as a user; those with documents are loaded and refreshed together."""
    root = _landed(spark, vector_documents(spark, sf))
    uid = F.col("c_custkey").cast("string").alias("uid")
    customers = table(spark, sf, "customer")
    padded = F.when(F.col("c_custkey") < 1000, F.format_string("%04d", "c_custkey")).otherwise(
        F.col("c_custkey").cast("string")
    )
    connections = customers.select(
        uid,
        F.lit("strava").alias("source"),
        F.struct(F.when(F.col("c_mktsegment") != "BUILDING", padded).alias("id")).alias("athlete"),
    )
    return run_all(_tables(spark), root, customers.select(uid), connections, LOADED_AT, layout="packed")


@query(f"WITH {VECTORS_SQL} SELECT * FROM samples")
def load_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads with the same time, the second over everything: nothing is lost, nothing doubled."""
    tables, documents = _tables(spark), vector_documents(spark, sf)
    for part in (documents.filter("channel <> 'time'"), documents):
        bronze.bronze_load(tables, _landed(spark, part), LOADED_AT, layout="packed")
    return tables.samples().drop("metadata_insert_timestamp")


@query(
    """
SELECT CAST(o_custkey AS VARCHAR) AS athlete_id, CAST(o_orderkey AS VARCHAR) AS activity_id, 'watts' AS data_stream,
  CASE WHEN o_orderkey % 6 IN (0, 5) THEN 1 ELSE 0 END::BIGINT AS record_count,
  CASE WHEN o_orderkey % 6 IN (0, 2) THEN 'SUCCESS' ELSE 'FAILURE' END AS status,
  CASE o_orderkey % 6 WHEN 1 THEN 'required:data' WHEN 3 THEN 'required:data' WHEN 4 THEN 'malformed_json'
    WHEN 5 THEN 'bad_value:original_size' END AS reason
FROM orders
"""
)
def load_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Ordinary and odd bodies, a kind per order: whole floats, no data, null data, empty, broken, a broken size.

    The count is that of the samples the document holds, also where it fails.
    """
    kind, price = F.col("o_orderkey") % 6, F.col("o_totalprice").cast("string")
    sized = lambda size: F.concat(F.lit('{"data":['), price, F.lit(f'],"original_size":{size},"series_type":"time"}}'))
    body = (
        F.when(kind == 0, sized("1.0"))
        .when(kind == 1, F.lit('{"message":"Rate Limit Exceeded"}'))
        .when(kind == 2, F.lit('{"data":null}'))
        .when(kind == 3, F.lit("{}"))
        .when(kind == 4, F.concat(F.lit('{"data":['), price))
        .otherwise(sized("1.5"))
    )
    documents = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("athlete_id"),
        F.lit("watts").alias("channel"),
        F.col("o_orderkey").cast("string").alias("activity_id"),
        body.alias("document"),
    )
    entries = bronze.bronze_load(_tables(spark), _landed(spark, documents), LOADED_AT, layout="packed")
    return entries.select("athlete_id", "activity_id", "data_stream", "record_count", "status", "reason")


@query(f"WITH {VECTORS_SQL} SELECT * FROM samples")
def files_load(spark: SparkSession, sf: str) -> DataFrame:
    """One file per document, landed and loaded in two rounds; the second opens only what is new."""
    tables, root = _tables(spark), scratch_path(spark, "landing")
    documents = vector_documents(spark, sf)
    for part in (documents.filter("channel <> 'time'"), documents):
        land_files(part, root)
        bronze.bronze_load(tables, root, LOADED_AT)
    return tables.samples().drop("metadata_insert_timestamp")


@query(
    f"""WITH {VECTORS_SQL}
SELECT athlete_id, activity_id, channel AS data_stream,
  CASE WHEN channel = 'watts' THEN 0 WHEN channel IN ('activity', 'athlete_summary') THEN 1 WHEN channel = 'latlng' THEN 32 ELSE 64 END::BIGINT AS record_count,
  CASE WHEN channel = 'watts' THEN 'FAILURE' ELSE 'SUCCESS' END AS status, CASE WHEN channel = 'watts' THEN 'malformed_json' END AS reason
FROM docs
UNION ALL SELECT NULL, NULL, NULL, 0, 'FAILURE', 'no_athlete_in_path'
"""
)
def files_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Single files, the bodies of watts null, and one file whose path names nobody: each has its row, from one listing."""
    tables, root = _tables(spark), scratch_path(spark, "landing")
    documents = vector_documents(spark, sf)
    null_watts = F.when(F.col("channel") != "watts", F.col("document"))
    land_files(documents.withColumn("document", null_watts), root)
    documents.limit(1).coalesce(1).write.json(f"{root}/notes")
    report = bronze.bronze_load(tables, root, LOADED_AT)
    reason = F.split("reason", ":")[0].alias("reason")
    return report.select("athlete_id", "activity_id", "data_stream", "record_count", "status", reason)


@query(f"WITH {VECTORS_SQL} SELECT * FROM samples WHERE athlete_id IN ('0001', '0002')")
def load_scoped(spark: SparkSession, sf: str) -> DataFrame:
    """Two athletes are loaded; a stranger's unknown channel doesn't stop them."""
    tables, documents = _tables(spark), vector_documents(spark, sf)
    stray = documents.filter("athlete_id = '0006' AND channel = 'time'").withColumn("channel", F.lit("gyroscope"))
    athletes = documents.filter("athlete_id IN ('0001', '0002')").select("athlete_id").distinct()
    bronze.bronze_load(tables, _landed(spark, documents.unionByName(stray)), LOADED_AT, layout="packed", athletes=athletes)
    return tables.samples().drop("metadata_insert_timestamp")


_STRONG = "channel = 'watts' AND index = 1 AND data > 0"


@query(
    f"""WITH strong AS (
  WITH {VECTORS_SQL} SELECT athlete_id, activity_id FROM samples WHERE channel = 'watts' AND "index" = 1 AND data > 0
)
SELECT s.* REPLACE (CASE WHEN k.activity_id IS NOT NULL THEN s.watts END AS watts)
FROM ({SILVER_SQL}) s LEFT JOIN strong k ON k.athlete_id = s.athlete_id AND k.activity_id = s.activity_id
"""
)
def silver_refresh_activities(spark: SparkSession, sf: str) -> DataFrame:
    """Watts arrive after the first refresh; only activities that start with some are refreshed by key."""
    tables, documents = _tables(spark), vector_documents(spark, sf)
    for n, part in enumerate(("channel <> 'watts'", "channel = 'watts'")):
        at = LOADED_AT + timedelta(hours=n)
        bronze.bronze_load(tables, _landed(spark, documents.filter(part)), at, layout="packed")
        silver_refresh(tables, activities=tables.samples().filter(_STRONG) if n else None, at=at)
    return tables.silver().drop("athlete_bucket", "metadata_insert_timestamp")


@query(
    """
SELECT CAST(o_custkey AS VARCHAR) AS athlete_id, CAST(o_orderkey AS VARCHAR) AS activity_id, CAST(1 AS BIGINT) AS "index",
  CAST(0 AS DOUBLE) AS time, CASE WHEN o_orderdate < DATE '1995-01-01' THEN 1 ELSE 2 END * o_totalprice AS watts,
  o_orderpriority AS name, o_orderstatus AS sport_type, CAST(12 AS BIGINT) AS documents, CAST(9 AS BIGINT) AS empty,
  CASE WHEN o_orderdate < DATE '1995-01-01' THEN '2024-02-01' ELSE '2024-02-02' END AS loaded,
  CAST(2 AS BIGINT) AS profiles, c_mktsegment AS city
FROM orders JOIN customer ON c_custkey = o_custkey
"""
)
def full_run(spark: SparkSession, sf: str) -> DataFrame:
    """Orders before 1995, then all of them with doubled watts: only those newer than the mark are taken.

    Silver rows beside what the ledger and the profile table hold of their activity and athlete.
    """
    tables, root = _tables(spark), scratch_path(spark, "landing")
    orders = table(spark, sf, "orders")
    keys = [F.col("o_custkey").cast("string").alias("athlete_id"), F.col("o_orderkey").cast("string").alias("activity_id")]
    texts = order_documents(spark, sf).drop("channel")
    activities = order_activities(spark, sf).drop("o_orderstatus").join(texts, ["athlete_id", "activity_id"])
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("athlete_id"),
        F.lit("athlete_summary").alias("channel"),
        F.lit("0").alias("activity_id"),
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("city"),
    )
    profiles = as_document(customers, "id", "city").select("athlete_id", "document")

    def bodies(factor: int) -> DataFrame:
        body = lambda value: F.concat(F.lit('{"data":['), value.cast("string"), F.lit('],"original_size":1,"series_type":"time"}'))
        time = orders.select(*keys, F.lit("time").alias("channel"), body(F.lit(0.0)).alias("document"))
        watts = orders.select(*keys, F.lit("watts").alias("channel"), body(factor * F.col("o_totalprice")).alias("document"))
        return time.unionByName(watts)

    first = activities.filter("start_date < '1995'")
    for n, offered in enumerate((first, activities)):
        run_full(tables, root, offered, bodies(n + 1), at=LOADED_AT + timedelta(days=n), profiles=profiles)
    # A profile's path names activity 0, which is an order too.
    logged = tables.ledger().filter("data_stream <> 'athlete_summary'").groupBy("athlete_id", "activity_id").agg(
        F.count_if(F.col("status") == "SUCCESS").alias("documents"),
        F.count_if(F.col("record_count") == 0).alias("empty"),
        F.date_format(F.max("bq_insert_timestamp"), "yyyy-MM-dd").alias("loaded"),
    )
    known = tables.bronze("athlete_summary").groupBy("athlete_id").agg(F.count(F.lit(1)).alias("profiles"), F.max("city").alias("city"))
    silver = tables.silver().select("athlete_id", "activity_id", "index", "time", "watts", "name", "sport_type")
    return silver.join(logged, ["athlete_id", "activity_id"], "left").join(known, "athlete_id", "left")


@query(
    f"""WITH silver AS ({SILVER_SQL}), found AS (
  WITH {VECTORS_SQL} SELECT athlete_id, channel, activity_id FROM docs
), states AS (
  SELECT athlete_id, count(*) - CASE WHEN athlete_id = '0005' THEN count(*) FILTER (WHERE channel = 'heartrate') ELSE 0 END
      AS succeeded,
    CASE athlete_id WHEN '0003' THEN count(*) FILTER (WHERE channel = 'time')
      WHEN '0005' THEN count(*) FILTER (WHERE channel = 'heartrate') ELSE 0 END AS failed,
    CASE athlete_id WHEN '0003' THEN 'unknown_channel' WHEN '0005' THEN 'silver:aggregate_stream:index' END AS reason
  FROM found WHERE athlete_id <> '0006' GROUP BY athlete_id
)
SELECT t.athlete_id, t.succeeded, t.failed, CASE WHEN t.failed > 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS status, t.reason,
  s.activity_id, s."index", s.time, s.heartrate, s.watts, s.latitude, s.name
FROM states t LEFT JOIN (
  SELECT * FROM silver WHERE athlete_id <> '0005'
    OR activity_id NOT IN (SELECT activity_id FROM found WHERE athlete_id = '0005' AND channel = 'heartrate')
) s ON s.athlete_id = t.athlete_id
"""
)
def all_athletes_faults(spark: SparkSession, sf: str) -> DataFrame:
    """One athlete has documents of an unknown channel, one has some twice in a single load.

    Both fail with a reason, the others are refreshed; an athlete outside the set, with an
    unknown channel of its own, plays no part.
    """
    tables, documents = _tables(spark), vector_documents(spark, sf)
    twice = documents.filter("athlete_id = '0005' AND channel = 'heartrate'").withColumnRenamed("document", "value")
    load_documents(twice.unionByName(twice), tables, LOADED_AT)
    strays = documents.filter("athlete_id IN ('0003', '0006') AND channel = 'time'").withColumn("channel", F.lit("gyroscope"))
    root = _landed(spark, documents.unionByName(strays))
    users = documents.filter("athlete_id <> '0006'").select(F.col("athlete_id").alias("uid")).distinct()
    connections = users.select("uid", F.lit("strava").alias("source"), F.struct(F.col("uid").alias("id")).alias("athlete"))
    report = run_all(tables, root, users, connections, LOADED_AT + timedelta(hours=1), layout="packed").drop("uid")
    silver = tables.silver().select("athlete_id", "activity_id", "index", "time", "heartrate", "watts", "latitude", "name")
    return report.join(silver, "athlete_id", "left")


@query(SILVER_SQL)
def load_overlapped(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads that know nothing of each other take the same documents, the later ones changed.

    The first is seen: neither samples nor activities are doubled, and all athletes refresh.
    """
    tables, documents = _tables(spark), vector_documents(spark, sf).withColumnRenamed("document", "value")
    other = F.replace("value", F.lit('"data":['), F.lit('"data":[9.5,')).alias("value")
    renamed = F.replace("value", F.lit("Activity "), F.lit("Other ")).alias("value")
    for n, changed in enumerate((F.col("value"), other, renamed)):
        load_documents(documents.select("athlete_id", "channel", "activity_id", changed), tables, LOADED_AT + timedelta(hours=n))
    silver_refresh(tables, at=LOADED_AT)
    return tables.silver().drop("athlete_bucket", "metadata_insert_timestamp")


@query(
    f"""WITH {VECTORS_SQL}
SELECT *, CAST(1 AS INTEGER) AS batches FROM samples
"""
)
def bronze_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Five loads, the last over documents that others have, compacted twice: the same rows, in one batch."""
    tables, documents = _tables(spark), vector_documents(spark, sf).withColumnRenamed("document", "value")
    part = F.col("activity_id").cast("long") % 4
    for n in range(4):
        load_documents(documents.filter(part == n), tables, LOADED_AT + timedelta(hours=n))
        if n == 2:
            compact_bronze(tables)
    changed = F.replace("value", F.lit('"data":['), F.lit('"data":[9.5,'))
    load_documents(documents.withColumn("value", changed), tables, LOADED_AT + timedelta(hours=9))
    compact_bronze(tables)
    rows = tables.stored_samples()
    batches = rows.agg(F.count_distinct("batch").cast("int").alias("batches"))
    return rows.drop("batch", "metadata_insert_timestamp").join(F.broadcast(batches))


_CONNECTED = "uid string, source string, athlete_id string, balance double, note string"


@query(
    """
WITH late AS (
  SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS balance,
    arg_max(o_orderpriority, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS last_note
  FROM orders GROUP BY o_custkey
)
SELECT CAST(c_custkey AS VARCHAR) AS uid, 'strava' AS source, 'a' || c_custkey AS athlete_id,
  CASE WHEN l.o_custkey IS NULL THEN c_acctbal ELSE l.balance END AS balance,
  coalesce(l.last_note, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END) AS note
FROM customer LEFT JOIN late l ON o_custkey = c_custkey
WHERE c_mktsegment <> 'BUILDING' OR l.o_custkey IS NOT NULL
"""
)
def upsert_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Connections of customers stored, but for those in building; then changed by all orders, and read again."""
    path, schema = scratch_path(spark, "connections"), T.StructType.fromDDL(_CONNECTED)
    customers, orders = table(spark, sf, "customer"), table(spark, sf, "orders")

    def records(frame: DataFrame, key: str, at: str, balance: str, note: Column) -> DataFrame:
        uid = F.col(key).cast("string")
        return frame.select(
            uid.alias("uid"),
            F.lit("strava").alias("source"),
            F.concat(F.lit("a"), uid).alias("athlete_id"),
            F.col(balance).alias("balance"),
            note.alias("note"),
            F.col(at).cast("long").alias("at"),
        )

    first = records(customers.filter("c_mktsegment <> 'BUILDING'"), "c_custkey", "c_custkey", "c_acctbal", F.col("c_mktsegment"))
    filled = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    for changes in (first, records(orders, "o_custkey", "o_orderkey", "o_totalprice", filled)):
        upsert_by_key(path, schema, changes, ["uid", "source"], "at", 16, ["balance", "note"])
    return read_bucketed(spark, path, schema).drop("athlete_bucket")
