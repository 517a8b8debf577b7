"""What is new: ledger anti-join and high-water marks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.model import DOCUMENT_KEY, SUCCESS
from pacegrid.session import stored


def succeeded(ledger: DataFrame, source: str) -> DataFrame:
    """Ledger rows of documents already loaded; failed ones are tried again."""
    return ledger.filter(
        (F.col("data_source") == source.upper()) & (F.col("status") == SUCCESS)
    ).select("athlete_id", F.col("data_stream").alias("channel"), "activity_id")


def processed_ids(ledger: DataFrame, source: str) -> DataFrame:
    """Distinct documents already loaded."""
    return succeeded(ledger, source).distinct()


def skip_processed(files: DataFrame, ledger: DataFrame, source: str, few: bool = False) -> DataFrame:
    """Documents without a SUCCESS row. Run it on paths, before contents are read.

    `few` says that the files are few beside the ledger, as in a stream's batch: the ledger
    is then cut to their keys first and stored, so that contents need not move.
    """
    key, known = list(DOCUMENT_KEY), succeeded(ledger, source)
    if few:
        known = stored(known.join(files.select(*key), key, "left_semi").distinct(), "known")
    # Distinct before the join: a document logged very often shrinks to one row on the map
    # side, and the join reuses the same partitioning.
    return files.join(known.distinct(), key, "left_anti")


def high_water_mark(activity: DataFrame) -> DataFrame:
    """Latest start per athlete; ISO text, so the greatest string is the latest."""
    return activity.groupBy("athlete_id").agg(F.max("start_date").alias("high_water"))


def newer_than(activity: DataFrame, marks: DataFrame) -> DataFrame:
    """Activities after their athlete's mark; an athlete without a mark keeps all."""
    joined = activity.join(marks, "athlete_id", "left")
    fresh = F.col("high_water").isNull() | (F.col("start_date") > F.col("high_water"))
    return joined.filter(fresh).drop("high_water")


def densify_channels(activities: DataFrame, documents: DataFrame, channels: list[str]) -> DataFrame:
    """One document per activity and channel; a channel not delivered gets an empty one."""
    wanted = activities.withColumn("channel", F.explode(F.array(*map(F.lit, channels))))
    return wanted.join(documents, list(DOCUMENT_KEY), "left")
