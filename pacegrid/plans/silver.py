"""Bronze samples to the wide silver table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid.functions.schemas import SILVER_SCHEMA, schema_from_json
from pacegrid.operators.alignment import add_activity, align_channels, align_with_activity, silver_projection
from pacegrid.operators.bounds import in_scope
from pacegrid.operators.quality import check_required
from pacegrid.operators.sql import sql_directory, sql_transform
from pacegrid.plans.bronze import utc_now
from pacegrid.session import scratch_path, stored
from pacegrid.sinks.tables import replace_by_key, stage_bucketed
from pacegrid.sources.tables import Tables

SQL_FOLDER = str(Path(__file__).parent / "sql")

Build = Callable[[Tables, "DataFrame | None", datetime], DataFrame]


def aggregate_stream(tables: Tables, scope: DataFrame | None, at: datetime, how: str = "agg") -> DataFrame:
    """The wide per-sample rows of a scope."""
    samples = in_scope(tables.samples(scope), scope)
    activity = in_scope(tables.bronze("activity", scope), scope)
    if how == "join":
        return silver_projection(add_activity(align_channels(samples, how), activity), at)
    return silver_projection(align_with_activity(samples, activity), at)


def from_sql(text: str) -> Build:
    """A silver table from a SELECT over the registered bronze views.

    The views hold the rows to rebuild, so the text needs no predicate. Its parameters are
    `:schema` (prefix of the views) and `:at` (load time).
    """

    def build(tables: Tables, scope: DataFrame | None, at: datetime) -> DataFrame:
        tables.register(scope)
        return sql_transform(tables.spark, text, {"schema": f"{tables.bronze_schema}__", "at": at})

    return build


def builds_of(folder: str = SQL_FOLDER) -> dict[str, Build]:
    """One silver table per `*.sql` file; by default the one shipped here."""
    return {table: from_sql(text) for table, text in sql_directory(folder).items()}


def schemas_of(folder: str = SQL_FOLDER) -> dict[str, T.StructType]:
    """Declared columns of the silver tables of a folder: the JSON field list beside a `*.sql` file."""
    described = {f.stem: schema_from_json(str(f)) for f in sorted(Path(folder).glob("*.json"))}
    return {"aggregate_stream": SILVER_SCHEMA} | described


def refresh_scope(
    athletes: DataFrame | None = None,
    activity_id: str | None = None,
    activities: DataFrame | None = None,
) -> DataFrame | None:
    """What to rebuild, as a stored frame of distinct keys; None is everything."""
    if activities is not None:
        keys = activities.select("athlete_id", "activity_id")
    elif athletes is not None:
        keys = athletes.select("athlete_id")
        if activity_id is not None:
            keys = keys.withColumn("activity_id", F.lit(activity_id))
    elif activity_id is not None:
        raise ValueError("an activity needs its athlete")
    else:
        return None
    path = scratch_path(keys.sparkSession, "scope")
    keys.distinct().write.parquet(path)
    return keys.sparkSession.read.schema(keys.schema).parquet(path)


def silver_run(
    tables: Tables,
    athletes: DataFrame | None = None,
    activity_id: str | None = None,
    activities: DataFrame | None = None,
    at: datetime | None = None,
    builds: dict[str, Build] | None = None,
    schemas: dict[str, T.StructType] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """`silver_refresh`, with the keys that failed and their reason beside the report.

    Every table with a declared schema is checked, that of `schemas_of` by default. A reason
    names the table and the required column that is null. The failed keys are stored once; the count, what is left out of the new rows and what stays replaced all read them.
    """
    at = at or utc_now()
    builds, schemas = builds or {"aggregate_stream": aggregate_stream}, schemas or schemas_of()
    scope = refresh_scope(athletes, activity_id, activities)
    on = ("athlete_id",) if scope is None else tuple(scope.columns)
    reports, faults = [], []
    for table, build in builds.items():
        rows, keys, failed = stage_bucketed(build(tables, scope, at), tables.buckets), scope, 0
        if table in schemas:
            nulls = check_required(rows, schemas[table], list(on))
            if nulls.count():
                reason = F.concat_ws(":", F.lit(table), F.min("column")).alias("reason")
                broken = stored(nulls.groupBy(*on).agg(reason), "broken")
                faults.append(broken)
                failed = broken.count()
                # A full refresh also drops athletes that are stored and have no samples any more.
                stored_keys = tables.silver(table, schemas[table]).select(*on)
                keys = rows.select(*on).unionByName(stored_keys).distinct() if scope is None else scope
                rows, keys = (f.join(broken, list(on), "left_anti") for f in (rows, keys))
        done = replace_by_key(tables.silver_path(table), rows, keys, tables.buckets, on, staged=True)
        reports.append(done.select(F.lit(table).alias("table"), "*", F.lit(failed).cast("long").alias("failed")))
    none = tables.spark.createDataFrame([], ", ".join(f"{c} string" for c in (*on, "reason")))
    return reduce(DataFrame.unionByName, reports), reduce(DataFrame.unionByName, faults, none)


def silver_refresh(tables: Tables, *what, **how) -> DataFrame:
    """Rebuild silver rows of athletes, of one activity of theirs, or of given activities.

    Takes what `silver_run` takes. What is replaced is exactly what is rebuilt: keys without
    samples end up without rows. A key with a null in a required column, which a repeated
    sample gives too, keeps the rows stored before and is counted as failed. Returns rows
    deleted and inserted and keys failed per table.
    """
    return silver_run(tables, *what, **how)[0]
