import json

import pytest
from pyspark.sql import types as T

from pacegrid.functions import schemas as S
from pacegrid.model import CHANNELS, SAMPLE_CHANNELS


def write(tmp_path, content):
    path = tmp_path / "fields.json"
    path.write_text(content if isinstance(content, str) else json.dumps(content))
    return str(path)


def test_ledger_schema_in_order():
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in S.schema_for_channel()] == [
        ("athlete_id", "string", False),
        ("activity_id", "string", False),
        ("data_source", "string", False),
        ("data_stream", "string", False),
        ("record_count", "bigint", False),
        ("status", "string", False),
        ("bq_insert_timestamp", "timestamp", False),
    ]


@pytest.mark.parametrize(
    "schema, kinds",
    [
        (S.ACTIVITY_SCHEMA, {"string": 19, "bigint": 16, "double": 15, "boolean": 9, "timestamp": 1}),
        (S.ATHLETE_SCHEMA, {"string": 54, "bigint": 2, "boolean": 2, "timestamp": 1}),
        (S.GENERIC_SCHEMA, {"double": 1, "bigint": 2, "string": 3, "timestamp": 1}),
        (S.PAIR_SCHEMA, {"double": 2, "bigint": 2, "string": 3, "timestamp": 1}),
        (S.SILVER_SCHEMA, {"bigint": 1, "double": 13, "string": 4, "timestamp": 1}),
    ],
)
def test_column_counts_by_type(schema, kinds):
    found = [f.dataType.simpleString() for f in schema]
    assert {k: found.count(k) for k in set(found)} == kinds


def test_required_columns():
    assert S.required_columns(S.ACTIVITY_SCHEMA) == ["activity_id", "athlete_id", "metadata_insert_timestamp"]
    assert "series_type" in S.required_columns(S.GENERIC_SCHEMA)
    assert "series_type" not in S.required_columns(S.PAIR_SCHEMA)
    assert S.required_columns(S.SILVER_SCHEMA)[:2] == ["index", "time"]


@pytest.mark.parametrize("channel", CHANNELS)
def test_schema_of_each_channel(channel):
    own = {"latlng": S.PAIR_SCHEMA, "activity": S.ACTIVITY_SCHEMA, "athlete_summary": S.ATHLETE_SCHEMA}
    assert S.schema_for_channel("STRAVA", channel) == own.get(channel, S.GENERIC_SCHEMA)
    assert len(SAMPLE_CHANNELS) == 11 and len(CHANNELS) == 13


def test_unknown_channel_or_source():
    with pytest.raises(ValueError, match="gyroscope"):
        S.schema_for_channel("STRAVA", "gyroscope")
    with pytest.raises(ValueError, match="Unsupported"):
        S.schema_for_channel("OTHER", "time")


def test_field_list_defaults(tmp_path):
    fields = [
        {"name": "a", "type": "FLOAT", "description": "value"},
        {"name": "b", "type": "STRING", "mode": "REQUIRED"},
    ]
    schema = S.schema_from_json(write(tmp_path, fields))
    assert schema["a"].nullable and schema["a"].metadata == {"comment": "value"}
    assert schema["a"].dataType == T.DoubleType()
    assert not schema["b"].nullable and schema["b"].metadata == {"comment": ""}


def test_field_list_errors(tmp_path):
    with pytest.raises(FileNotFoundError):
        S.schema_from_json(str(tmp_path / "absent.json"))
    with pytest.raises(json.JSONDecodeError):
        S.schema_from_json(write(tmp_path, "[{"))
    with pytest.raises(ValueError, match="not an object"):
        S.schema_from_json(write(tmp_path, ["bad_field"]))
    with pytest.raises(ValueError, match="lacks type"):
        S.schema_from_json(write(tmp_path, [{"name": "index", "mode": "NULLABLE"}]))
    with pytest.raises(ValueError, match="lacks name"):
        S.schema_from_json(write(tmp_path, [{"type": "FLOAT"}]))
    with pytest.raises(ValueError, match="Unknown type"):
        S.schema_from_json(write(tmp_path, [{"name": "x", "type": "GEOGRAPHY"}]))
