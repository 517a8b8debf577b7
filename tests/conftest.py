import json
from pathlib import Path

import pytest

from pacegrid.session import build_session

PAIRS = ("latlng",)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "3",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def put(root, athlete, channel, activity, body):
    """Write one landed document; a str is written as it is."""
    folder = Path(root) / f"athlete_id={athlete}" / channel
    folder.mkdir(parents=True, exist_ok=True)
    text = body if isinstance(body, str) else json.dumps(body)
    (folder / f"activity_id={activity}.json").write_text(text)


def samples(data, series_type="time"):
    return {"data": data, "original_size": None if data is None else len(data), "series_type": series_type}


def landing_tree(root):
    """The literal cases: nulls, booleans, pairs, double encoding, a broken document."""
    put(root, "0017", "time", 1, samples([0, 1, 2], "distance"))
    put(root, "0017", "heartrate", 1, samples([100, 101, None], "distance"))
    put(root, "0017", "heartrate", 2, samples(None, None))
    put(root, "0017", "moving", 1, samples([True, False]))
    put(root, "0017", "latlng", 1, samples([[1.5, 2.5], None, [3.5]]))
    put(root, "0017", "athlete_summary", 0, json.dumps(json.dumps({"id": 17, "city": "X", "bikes": [{"a": 1}]})))
    put(
        root,
        "0017",
        "activity",
        1,
        {
            "id": 1,
            "athlete": {"id": "0017", "resource_state": 1},
            "map": {"id": "m1", "polyline": None},
            "name": "Ride",
            "sport_type": "Ride",
            "start_latlng": [],
            "end_latlng": None,
            "start_date": "2024-01-01T00:00:00Z",
            "distance": 12.5,
            "kudos_count": 3,
            "commute": True,
            "device_name": "Watch",
        },
    )
    put(root, "0017", "watts", 4, "{bad")
    put(root, "9", "time", 7, samples([5]))
    return str(root)


def rows(frame, *columns):
    return sorted((tuple(r) for r in (frame.select(*columns) if columns else frame).collect()), key=repr)
