"""Small column expressions; all built-in, so they stay inside code generation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_part(path: Column, pattern: str) -> Column:
    """First group of `pattern` in a path, null when it does not match."""
    found = F.regexp_extract(path, pattern, 1)
    return F.when(found != "", found)


def path_athlete(path: Column) -> Column:
    return path_part(path, r"/athlete_id=([^/]+)/")


def path_channel(path: Column) -> Column:
    return path_part(path, r"/athlete_id=[^/]+/([^/]+)/[^/]+$")


def path_activity(path: Column) -> Column:
    return path_part(path, r"/activity_id=([^/]+)\.json$")


def decoded(value: Column) -> Column:
    """JSON text; a document that is itself a JSON string is unwrapped once."""
    wrapped = F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")
    return F.when(F.ltrim(value).startswith('"'), wrapped).otherwise(value)


def number_of(text: Column) -> Column:
    """Sample text as double; booleans become 1.0 and 0.0, other text null."""
    return (
        F.when(text == "true", F.lit(1.0))
        .when(text == "false", F.lit(0.0))
        .otherwise(text.try_cast("double"))
    )


def whole_number(text: Column) -> Column:
    """Number text as a long, also where it is written `178.0` or `1e3`; null for `1.5`."""
    exact = text.try_cast("decimal(38,9)")
    return F.coalesce(text.try_cast("long"), F.when(exact == F.floor(exact), exact.try_cast("long")))


def first_of(pair: Column) -> Column:
    return F.get(pair, F.lit(0))


def second_of(pair: Column) -> Column:
    return F.get(pair, F.lit(1))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text to the second, `Z` suffix; sorts as the instant does."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_micros(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def in_zone(utc: Column, zone: str) -> Column:
    """Wall-clock time of a UTC instant in a named zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz"))


def bucket_of(key: Column, buckets: int) -> Column:
    """Stable storage bucket of a high-cardinality key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def clean_name(name: str) -> str:
    """Column label with dots as underscores and other special characters dropped."""
    return re.sub(r"\W", "", name.replace(".", "_"), flags=re.ASCII)
