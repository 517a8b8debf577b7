"""Declared table schemas, and schemas read from JSON field lists."""

from __future__ import annotations

import json

from pyspark.sql import types as T

from pacegrid.model import CHANNELS, PAIR_CHANNEL, source_name

TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
}

# Declared columns in table order, one `name type [required]` per line.
GENERIC_SAMPLE = """
data FLOAT
index INTEGER
original_size INTEGER
series_type STRING REQUIRED
athlete_id STRING REQUIRED
activity_id STRING REQUIRED
metadata_insert_timestamp TIMESTAMP REQUIRED
"""

PAIR_SAMPLE = """
latitude FLOAT
longitude FLOAT
index INTEGER
original_size INTEGER
series_type STRING
athlete_id STRING REQUIRED
activity_id STRING REQUIRED
metadata_insert_timestamp TIMESTAMP REQUIRED
"""

ACTIVITY = """
activity_id STRING REQUIRED
achievement_count INTEGER
athlete_count INTEGER
average_speed FLOAT
average_watts FLOAT
comment_count INTEGER
commute BOOLEAN
device_watts BOOLEAN
distance FLOAT
elapsed_time INTEGER
elev_high FLOAT
elev_low FLOAT
external_id STRING
flagged BOOLEAN
gear_id STRING
has_kudoed BOOLEAN
hide_from_home STRING
kilojoules FLOAT
kudos_count INTEGER
manual BOOLEAN
max_speed FLOAT
max_watts INTEGER
moving_time INTEGER
name STRING
photo_count INTEGER
private BOOLEAN
sport_type STRING
start_date STRING
start_date_local STRING
start_latitude FLOAT
start_longitude FLOAT
end_latitude FLOAT
end_longitude FLOAT
timezone STRING
total_elevation_gain FLOAT
total_photo_count INTEGER
trainer BOOLEAN
type STRING
upload_id INTEGER
upload_id_str STRING
weighted_average_watts INTEGER
workout_type INTEGER
utc_offset FLOAT
location_city STRING
location_state STRING
location_country STRING
pr_count INTEGER
suffer_score INTEGER
has_heartrate BOOLEAN
average_heartrate FLOAT
max_heartrate INTEGER
average_cadence FLOAT
from_accepted_tag BOOLEAN
visibility STRING
athlete_id STRING REQUIRED
athlete_resource_state INTEGER
map_id STRING
map_polyline STRING
map_summary_polyline STRING
metadata_insert_timestamp TIMESTAMP REQUIRED
"""

ATHLETE_SUMMARY = """
athlete_id STRING REQUIRED
city STRING
country STRING
created_at STRING
firstname STRING
lastname STRING
premium BOOLEAN
profile STRING
profile_medium STRING
resource_state INTEGER
sex STRING
state STRING
summit BOOLEAN
updated_at STRING
bikes STRING
clubs STRING
follower_count STRING
friend_count STRING
ftp STRING
measurement_preference STRING
shoes STRING
weight STRING
athlete_type STRING
friend STRING
follower STRING
approve_followers STRING
badge_type_id INTEGER
mutual_friend_count STRING
date_preference STRING
email STRING
super_user STRING
email_language STRING
max_heartrate STRING
username STRING
description STRING
instagram_username STRING
offer_in_app_payment STRING
global_privacy STRING
receive_newsletter STRING
email_kom_lost STRING
dateofbirth STRING
facebook_sharing_enabled STRING
profile_original STRING
premium_expiration_date STRING
email_send_follower_notices STRING
plan STRING
agreed_to_terms STRING
follower_request_count STRING
email_facebook_twitter_friend_joins STRING
receive_kudos_emails STRING
receive_follower_feed_emails STRING
receive_comment_emails STRING
sample_race_distance STRING
sample_race_time STRING
membership STRING
admin STRING
owner STRING
subscription_permissions STRING
metadata_insert_timestamp TIMESTAMP REQUIRED
"""

LEDGER = """
athlete_id STRING REQUIRED
activity_id STRING REQUIRED
data_source STRING REQUIRED
data_stream STRING REQUIRED
record_count INTEGER REQUIRED
status STRING REQUIRED
bq_insert_timestamp TIMESTAMP REQUIRED
"""

SILVER = """
index INTEGER REQUIRED
time FLOAT REQUIRED
altitude FLOAT
cadence FLOAT
distance FLOAT
grade_smooth FLOAT
heartrate FLOAT
latitude FLOAT
longitude FLOAT
power FLOAT
moving FLOAT
temperature FLOAT
velocity_smooth FLOAT
watts FLOAT
name STRING
sport_type STRING
athlete_id STRING REQUIRED
activity_id STRING REQUIRED
metadata_insert_timestamp TIMESTAMP REQUIRED
"""


def struct_from_fields(fields: list) -> T.StructType:
    """Field entries (`name`, `type`, optional `mode`, `description`) to a StructType."""
    columns = []
    for entry in fields:
        if not isinstance(entry, dict):
            raise ValueError(f"Schema entry is not an object: {entry!r}")
        absent = sorted({"name", "type"} - entry.keys())
        if absent:
            raise ValueError(f"Schema entry lacks {', '.join(absent)}: {entry!r}")
        if entry["type"] not in TYPES:
            raise ValueError(f"Unknown type {entry['type']!r} for {entry['name']!r}")
        columns.append(
            T.StructField(
                entry["name"],
                TYPES[entry["type"]],
                entry.get("mode", "NULLABLE") != "REQUIRED",
                {"comment": entry.get("description", "")},
            )
        )
    return T.StructType(columns)


def schema_from_json(path: str) -> T.StructType:
    """Read a JSON field list. A missing file or broken JSON raises as it is."""
    with open(path, encoding="utf-8") as handle:
        return struct_from_fields(json.load(handle))


def _declared(text: str) -> T.StructType:
    keys = ("name", "type", "mode")
    return struct_from_fields([dict(zip(keys, line.split())) for line in text.split("\n") if line])


GENERIC_SCHEMA = _declared(GENERIC_SAMPLE)
PAIR_SCHEMA = _declared(PAIR_SAMPLE)
ACTIVITY_SCHEMA = _declared(ACTIVITY)
ATHLETE_SCHEMA = _declared(ATHLETE_SUMMARY)
LEDGER_SCHEMA = _declared(LEDGER)
SILVER_SCHEMA = _declared(SILVER)

_OWN = {PAIR_CHANNEL: PAIR_SCHEMA, "activity": ACTIVITY_SCHEMA, "athlete_summary": ATHLETE_SCHEMA}


def schema_for_channel(source: str | None = None, channel: str | None = None) -> T.StructType:
    """Bronze schema of a channel; without source and channel, the ledger's."""
    if not (source and channel):
        return LEDGER_SCHEMA
    source_name(source)
    if channel not in CHANNELS:
        raise ValueError(f"Unknown channel: {channel}")
    return _OWN.get(channel, GENERIC_SCHEMA)


def required_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema if not field.nullable]


def _raw_activity() -> T.StructType:
    """Shape of an activity document: every scalar read as text, cast later."""
    derived = {"activity_id", "athlete_id", "metadata_insert_timestamp"}
    nested = {
        "athlete": [("id", T.StringType()), ("resource_state", T.StringType())],
        "map": [(n, T.StringType()) for n in ("id", "polyline", "summary_polyline")],
    }
    for name, parts in nested.items():
        derived.update(f"{name}_{part}" for part, _ in parts)
    for end in ("start", "end"):
        derived.update((f"{end}_latitude", f"{end}_longitude"))
    raw = T.StructType([T.StructField("id", T.StringType())])
    for field in ACTIVITY_SCHEMA:
        if field.name not in derived:
            raw.add(field.name, T.StringType())
    for name, parts in nested.items():
        raw.add(name, T.StructType([T.StructField(part, kind) for part, kind in parts]))
    for end in ("start", "end"):
        raw.add(f"{end}_latlng", T.ArrayType(T.StringType()))
    return raw


def _raw_athlete() -> T.StructType:
    raw = T.StructType([T.StructField("id", T.StringType())])
    for field in ATHLETE_SCHEMA:
        if field.name not in ("athlete_id", "metadata_insert_timestamp"):
            raw.add(field.name, T.StringType())
    return raw


RAW_ACTIVITY = _raw_activity()
RAW_ATHLETE = _raw_athlete()
