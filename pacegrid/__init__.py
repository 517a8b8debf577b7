"""pacegrid: activity telemetry as set-based Spark jobs."""

from pacegrid.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
