"""Checks that route rows instead of stopping the job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid.functions.schemas import required_columns
from pacegrid.model import FAILURE, SOURCES, SUCCESS


def drop_keyless_users(users: DataFrame) -> DataFrame:
    return users.filter(F.coalesce(F.col("uid"), F.lit("")) != "")


def keyless_users(users: DataFrame) -> DataFrame:
    """The users `drop_keyless_users` leaves out."""
    return users.filter(F.coalesce(F.col("uid"), F.lit("")) == "")


def supported_source(frame: DataFrame, column: str = "source") -> tuple[DataFrame, DataFrame]:
    """Rows with a supported source, and the others with a reason."""
    known = F.coalesce(F.upper(column).isin(list(SOURCES)), F.lit(False))
    rejected = frame.filter(~known).withColumn("reason", F.lit("unsupported_source"))
    return frame.filter(known), rejected


def connection_reason(scanned: DataFrame) -> DataFrame:
    """Add `reason`: null for a usable connection, else what it lacks.

    Expects `has_connection` and an `athlete` struct with an `id`.
    """
    reason = F.when(~F.col("has_connection"), F.lit("no_connection")).when(
        F.col("athlete").isNull() | F.col("athlete.id").isNull(), F.lit("missing_athlete_id")
    )
    return scanned.withColumn("reason", reason)


def check_connections(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable and rejected connections of `connection_scan`."""
    checked = connection_reason(scanned)
    valid = checked.filter(F.col("reason").isNull()).drop("reason")
    return valid, checked.filter(F.col("reason").isNotNull())


def check_required(df: DataFrame, schema: T.StructType, key: list[str]) -> DataFrame:
    """One row per key and required column that is null, in one pass."""
    names = [F.when(F.col(c).isNull(), F.lit(c)) for c in required_columns(schema)]
    broken = F.explode(F.array_compact(F.array(*names)))
    return df.select(*key, broken.alias("column"))


def load_status(df: DataFrame, broken: str = "reason") -> DataFrame:
    """SUCCESS for a document without a fault, else FAILURE."""
    state = F.when(F.col(broken).isNull(), F.lit(SUCCESS)).otherwise(F.lit(FAILURE))
    return df.withColumn("status", state)


def batch_status(ledger: DataFrame, reason: Column | None = None) -> DataFrame:
    """Per athlete: documents loaded, documents failed, the overall state, and the first `reason` if given."""
    good, bad = F.col("status") == SUCCESS, F.col("status") == FAILURE
    named = [] if reason is None else [F.min(reason).alias("reason")]
    counts = ledger.groupBy("athlete_id").agg(
        F.count_if(good).alias("succeeded"), F.count_if(bad).alias("failed"), *named
    )
    return counts.withColumn(
        "status", F.when(F.col("failed") > 0, F.lit(FAILURE)).otherwise(F.lit(SUCCESS))
    )


def observed(frame: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count a frame's rows while another action runs it; no action of its own."""
    counter = Observation(name)
    return frame.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def row_counters(**frames: DataFrame) -> DataFrame:
    """One row per named frame with its number of rows."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("counter"), "rows")
        for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def without_empty_batches(ledger: DataFrame) -> DataFrame:
    """Ledger rows of (athlete, channel) batches that hold at least one record."""
    batch = ["athlete_id", "data_stream"]
    filled = (
        ledger.groupBy(*batch).agg(F.sum("record_count").alias("_n")).filter(F.col("_n") > 0).drop("_n")
    )
    return ledger.join(filled, batch, "left_semi")
