"""Rows of a scope."""

from __future__ import annotations

from pyspark.sql import DataFrame


def in_scope(frame: DataFrame, scope: DataFrame | None) -> DataFrame:
    """Rows whose athlete, or athlete and activity, is in `scope`; None keeps all.

    A plain join: Catalyst broadcasts the scope if its real size allows it.
    """
    if scope is None:
        return frame
    return frame.join(scope.distinct(), scope.columns, "left_semi")
