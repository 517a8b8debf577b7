"""Fixed names of the data model."""

from __future__ import annotations

# Channel names as they stand in landing paths and table names.
DOCUMENT_CHANNELS = ("activity", "athlete_summary")
SAMPLE_CHANNELS = (
    "time",
    "distance",
    "latlng",
    "altitude",
    "velocity_smooth",
    "heartrate",
    "cadence",
    "watts",
    "temp",
    "moving",
    "grade_smooth",
)
CHANNELS = DOCUMENT_CHANNELS + SAMPLE_CHANNELS
PAIR_CHANNEL = "latlng"
FLAG_CHANNEL = "moving"

# Ledger states and supported sources.
SUCCESS = "SUCCESS"
FAILURE = "FAILURE"
SOURCES = ("STRAVA",)

# Silver column -> (channel, bronze column). `power` has no landing
# channel of its own, so its column stays null until one exists.
SILVER_MEASURES = {
    "altitude": ("altitude", "data"),
    "cadence": ("cadence", "data"),
    "distance": ("distance", "data"),
    "grade_smooth": ("grade_smooth", "data"),
    "heartrate": ("heartrate", "data"),
    "latitude": ("latlng", "latitude"),
    "longitude": ("latlng", "longitude"),
    "power": ("power", "data"),
    "moving": ("moving", "data"),
    "temperature": ("temp", "data"),
    "velocity_smooth": ("velocity_smooth", "data"),
    "watts": ("watts", "data"),
}

# Slices a channel's documents are gathered in, so that no channel is one task.
SLICES = 16

DOCUMENT_KEY = ("athlete_id", "channel", "activity_id")
SAMPLE_KEY = ("athlete_id", "activity_id", "index")


def source_name(source: str) -> str:
    """Upper-cased source, or ValueError when it is not supported."""
    name = source.upper()
    if name not in SOURCES:
        raise ValueError(f"Unsupported data source: {source}")
    return name
