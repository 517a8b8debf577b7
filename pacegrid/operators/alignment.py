"""Align all channels of an activity on the sample index."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacegrid.functions.schemas import SILVER_SCHEMA
from pacegrid.model import SAMPLE_KEY, SILVER_MEASURES
from pacegrid.operators.bounds import in_scope

DRIVER = "time"
#: Samples of an activity that lie in one task; a longer activity is dealt out by slices of its index.
SLICE = 65_536
PLACE = ("athlete_id", "activity_id", "_slice")


def _sliced(samples: DataFrame) -> DataFrame:
    return samples.withColumn("_slice", F.floor(F.col("index") / SLICE))


def _aggregated(samples: DataFrame, measures: dict[str, tuple[str, str]], driver: str) -> DataFrame:
    channels = list(dict.fromkeys([driver, *(channel for channel, _ in measures.values())]))
    values = list(dict.fromkeys(["data", *(column for _, column in measures.values())]))
    numbering = F.create_map(*[F.lit(part) for i, c in enumerate(channels) for part in (c, i)])
    # Narrow rows with a numbered channel are shuffled before the wide ones exist: a
    # partial aggregate would send every column of the result for each single sample.
    placed = (
        _sliced(samples.filter(F.col("channel").isin(channels)))
        .select(*SAMPLE_KEY, "_slice", numbering[F.col("channel")].alias("_channel"), *values)
        .repartition(*PLACE)
    )

    def pick(channel: str, column: str) -> Column:
        return F.max(F.when(F.col("_channel") == channels.index(channel), F.col(column)))

    wide = placed.groupBy(*PLACE, "index").agg(
        pick(driver, "data").alias(driver),
        *[pick(*spec).alias(name) for name, spec in measures.items()],
        F.bit_or(F.expr("shiftleft(1L, _channel)")).alias("_seen"),
        F.count(F.lit(1)).alias("_rows"),
    )
    # A repeated (athlete, activity, index) in one channel has no single answer: its index is
    # null, which the check of required columns reports for that athlete alone.
    once = F.bit_count("_seen") == F.col("_rows")
    checked = F.when(once, F.col("index"))
    has_driver = F.col("_seen").bitwiseAND(F.lit(1)) != 0
    return wide.filter(has_driver).withColumn("index", checked).select(*SAMPLE_KEY, "_slice", driver, *measures)


def _joined(samples: DataFrame, measures: dict[str, tuple[str, str]], driver: str) -> DataFrame:
    columns: dict[str, list[tuple[str, str]]] = {}
    for name, (channel, column) in measures.items():
        columns.setdefault(channel, []).append((name, column))

    def rows(channel: str, parts: list[tuple[str, str]]) -> DataFrame:
        named = [F.col(column).alias(name) for name, column in parts]
        return samples.filter(F.col("channel") == channel).select(*SAMPLE_KEY, *named)

    wide = rows(driver, [(driver, "data")])
    for channel, parts in columns.items():
        wide = wide.join(rows(channel, parts), list(SAMPLE_KEY), "left")
    return wide.select(*SAMPLE_KEY, driver, *measures)


def align_channels(
    samples: DataFrame,
    how: str = "agg",
    driver: str = DRIVER,
    measures: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per driver sample with every measure at the same athlete, activity, index.

    `agg` costs one shuffle of the long table and gives a repeated key no index. `join` is
    the chain of left joins; repeated keys multiply rows there.
    """
    measures = SILVER_MEASURES if measures is None else measures
    if how == "join":
        return _joined(samples, measures, driver)
    return _aggregated(samples, measures, driver).drop("_slice")


def align_with_activity(samples: DataFrame, activity: DataFrame) -> DataFrame:
    """`align_channels` and `add_activity` in one: the wide rows stay where they are made.

    Narrow samples are dealt by activity and slice of the index, which serves the aggregate
    and the join alike; the facts go to each slice that has samples. Slices keep an activity
    with very many samples from filling one task.
    """
    wide = _aggregated(samples, SILVER_MEASURES, DRIVER)
    slices = _sliced(samples.filter(F.col("channel") == DRIVER)).select(*PLACE).distinct()
    facts = _facts(activity, PLACE[:2])
    return _with_facts(wide, slices.join(facts, list(PLACE[:2])), PLACE).drop("_slice")


def repeated_samples(samples: DataFrame) -> DataFrame:
    """Keys that occur more than once in a channel, with their count."""
    counted = samples.groupBy("channel", *SAMPLE_KEY).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1)


def add_activity(
    aligned: DataFrame, activity: DataFrame, on: tuple[str, ...] = ("athlete_id", "activity_id")
) -> DataFrame:
    """Name and sport of the activity; samples of an unknown activity keep nulls.

    One row of the dimension per key; of copies the greatest is taken.
    """
    return _with_facts(aligned, _facts(activity, on), on)


def _facts(activity: DataFrame, on: tuple[str, ...]) -> DataFrame:
    return activity.groupBy(*on).agg(F.max(F.struct("name", "sport_type")).alias("_fact"))


def _with_facts(aligned: DataFrame, facts: DataFrame, on: tuple[str, ...]) -> DataFrame:
    return aligned.join(facts, list(on), "left").withColumns(
        {"name": F.col("_fact.name"), "sport_type": F.col("_fact.sport_type")}
    ).drop("_fact")


def silver_projection(aligned: DataFrame, at: datetime | None = None) -> DataFrame:
    """The declared silver columns in order, stamped."""
    stamped = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    frame = aligned.withColumn("metadata_insert_timestamp", stamped)
    return frame.selectExpr(
        *[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in SILVER_SCHEMA]
    )


def athlete_slice(
    frame: DataFrame, athletes: DataFrame | None = None, activity_id: str | None = None
) -> DataFrame:
    """Rows of a set of athletes, and of one activity when given."""
    if activity_id is not None:
        frame = frame.filter(F.col("activity_id") == activity_id)
    return in_scope(frame, None if athletes is None else athletes.select("athlete_id"))
