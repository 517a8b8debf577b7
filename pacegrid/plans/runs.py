"""Land, bronze and silver in order, for one set of athletes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.model import FAILURE, SAMPLE_CHANNELS, SUCCESS
from pacegrid.operators.incremental import densify_channels, newer_than
from pacegrid.operators.quality import batch_status, check_connections, drop_keyless_users
from pacegrid.plans.bronze import bronze_load, utc_now
from pacegrid.plans.silver import silver_run
from pacegrid.session import scratch_path
from pacegrid.sinks.landing import land_raw
from pacegrid.sources.tables import Tables, connection_scan

# A profile belongs to no activity; its path names this one.
PROFILE_ID = "0"
# The body of a channel the source did not deliver.
EMPTY_BODY = '{"data":null,"original_size":null,"series_type":null}'


def land_new(
    tables: Tables,
    activities: DataFrame,
    bodies: DataFrame,
    root: str,
    at: datetime,
    profiles: DataFrame | None = None,
) -> None:
    """Land activities newer than their athlete's mark, each with all sample channels, and profiles.

    `activities` has athlete_id, activity_id, start_date and document; `bodies` has the
    document of each channel delivered; `profiles` has athlete_id and document, and is landed
    whole, since a profile has no mark.
    """
    new = newer_than(activities, tables.marks())
    keys = new.select("athlete_id", "activity_id")
    every = densify_channels(keys, bodies, list(SAMPLE_CHANNELS))
    every = every.withColumn("document", F.coalesce("document", F.lit(EMPTY_BODY)))
    every = every.unionByName(new.select(*keys.columns, F.lit("activity").alias("channel"), "document"))
    if profiles is not None:
        ids = F.lit(PROFILE_ID).alias("activity_id"), F.lit("athlete_summary").alias("channel")
        every = every.unionByName(profiles.select("athlete_id", *ids, "document"))
    land_raw(every, root, at)


def _kept(frame: DataFrame) -> DataFrame:
    # Read several times in a run; must not change in between.
    path = scratch_path(frame.sparkSession, "users")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def full_run(
    tables: Tables,
    root: str,
    activities: DataFrame | None = None,
    bodies: DataFrame | None = None,
    athletes: DataFrame | None = None,
    at: datetime | None = None,
    profiles: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Land (when given), load bronze, rebuild silver for the activities of the batch.

    Only activities with a document in this batch can differ in silver, so only they are
    rebuilt. All that was ever landed and isn't loaded is tried, also what failed before: the
    index of the landing tells, so only files with such documents are opened. `landed_since`
    leaves older landings out. Stops at the first error. Returns the ledger rows of the batch, and a FAILURE for each activity
    whose silver rows break a requirement; those rows aren't in the stored ledger.
    """
    at = at or utc_now()
    if activities is not None and bodies is not None:
        land_new(tables, activities, bodies, root, at, profiles)
        options = {"layout": "packed", "refresh_profiles": profiles is not None} | options
    entries = bronze_load(tables, root, at, athletes=athletes, **options)
    _, broken = silver_run(tables, activities=entries.filter(F.col("status") == SUCCESS), at=at)
    faults = broken.select(
        "athlete_id",
        "activity_id",
        F.lit("silver").alias("data_stream"),
        F.lit(0).cast("long").alias("record_count"),
        F.concat_ws(":", F.lit("silver"), "reason").alias("reason"),
        F.lit(FAILURE).alias("status"),
        F.lit(tables.source).alias("data_source"),
    )
    return entries.unionByName(faults, allowMissingColumns=True)


def run_all(
    tables: Tables,
    root: str,
    users: DataFrame,
    connections: DataFrame,
    at: datetime | None = None,
    **options,
) -> DataFrame:
    """Run every user with a usable connection in one job; report each user's outcome.

    Users without uid are left out. A rejected user or a faulty document fails alone. A
    user's reason names what is wrong beyond single bodies: no usable connection, a channel
    nobody knows, or silver rows that break a requirement.
    """
    scanned = connection_scan(drop_keyless_users(users), connections, tables.source)
    valid, rejected = check_connections(scanned)
    linked = _kept(valid.select("uid", F.col("athlete.id").cast("string").alias("athlete_id")))
    entries = full_run(tables, root, athletes=linked, at=at, isolate=True, **options)
    wider = F.when(F.col("reason").rlike("^(unknown_channel|silver:)"), F.col("reason"))
    states = linked.join(batch_status(entries, wider), "athlete_id", "left").select(
        "uid",
        "athlete_id",
        F.coalesce("succeeded", F.lit(0)).cast("long").alias("succeeded"),
        F.coalesce("failed", F.lit(0)).cast("long").alias("failed"),
        F.coalesce("status", F.lit(SUCCESS)).alias("status"),
        "reason",
    )
    refused = rejected.select(
        "uid",
        F.lit(None).cast("string").alias("athlete_id"),
        F.lit(0).cast("long").alias("succeeded"),
        F.lit(0).cast("long").alias("failed"),
        F.lit(FAILURE).alias("status"),
        "reason",
    )
    return states.unionByName(refused)
