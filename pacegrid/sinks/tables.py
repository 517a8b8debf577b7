"""Write stored tables."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid.functions.columns import bucket_of
from pacegrid.functions.schemas import LEDGER_SCHEMA
from pacegrid.model import DOCUMENT_CHANNELS
from pacegrid.operators.incremental import high_water_mark
from pacegrid.operators.keyed import upsert
from pacegrid.session import delete_folder, scratch_path, small_tasks, together
from pacegrid.sources.landing import batch_name
from pacegrid.sources.tables import (
    BATCH,
    BUCKET,
    MARKS_SCHEMA,
    NO_BUCKET,
    QUARANTINE_SCHEMA,
    SWITCH_SCHEMA,
    Tables,
    current_versions,
    read_bucketed,
    read_or_empty,
)

#: Versions of one bucket after which it is written anew with the next change.
MOST_VERSIONS = 8
#: Switches whose versions stay for readers that have begun.
KEPT_SWITCHES = 2


def new_batch(at: datetime) -> str:
    """Name of one load: sortable by its time, and never that of another load."""
    return f"{batch_name(at)}-{uuid.uuid4().hex}"


def _write_batch(rows: DataFrame, path: str, batch: str | Column, *partitions: str) -> None:
    # A batch that died and is written again under its name replaces what it had written.
    named = rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with small_tasks(rows.sparkSession):
        named.option("compression", "zstd").partitionBy(*partitions, "batch").parquet(path)


def append_bronze(rows: DataFrame, tables: Tables, table: str, batch: str) -> None:
    """Append a batch to a bronze table; no other load's partitions are touched."""
    _write_batch(rows, tables.bronze_path(table), batch, *(["channel"] if table == "samples" else []))


def _faulty(batch: str) -> str:
    # No ledger names it, so no reader sees its rows.
    return f"{batch}-faulty"


def append_objects(rows: DataFrame, tables: Tables, table: str, batch: str) -> tuple[DataFrame, DataFrame]:
    """Append the rows without a `_reason` as a batch of a bronze table; those rows, and the others, as written.

    The others are written beside them by the same pass, until `delete_faulty`.
    """
    name = F.when(F.col("_reason").isNull(), F.lit(batch)).otherwise(F.lit(_faulty(batch)))
    path = tables.bronze_path(table)
    with together(rows.sparkSession, 2):
        _write_batch(rows, path, name)
    written = read_or_empty(tables.spark, path, T.StructType([*rows.schema, BATCH]))
    return written.filter(F.col("batch") == batch).drop("batch"), written.filter(F.col("batch") == _faulty(batch)).drop("batch")


def delete_faulty(tables: Tables, table: str, batch: str) -> None:
    for folder in _paths(tables.spark, f"{tables.bronze_path(table)}/batch={_faulty(batch)}"):
        delete_folder(tables.spark, folder)


def append_marks(activity: DataFrame, tables: Tables, batch: str) -> None:
    """Keep the latest start per athlete of a batch's activities, so that marks need no activity table."""
    _write_batch(high_water_mark(activity), tables.marks_path, batch)


def append_quarantine(failed: DataFrame, tables: Tables, batch: str) -> None:
    """Keep the bodies of a batch's failed documents with the reason."""
    rows = failed.withColumn("origin", F.lit(batch)).select(*[f.name for f in QUARANTINE_SCHEMA])
    _write_batch(rows, tables.quarantine_path, batch)


def append_ledger(entries: DataFrame, tables: Tables, at: datetime, batch: str) -> None:
    """Append a batch's ledger rows; this is what makes its bronze rows visible."""
    stamped = entries.withColumn("bq_insert_timestamp", F.lit(at).cast("timestamp"))
    rows = stamped.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA],
        F.lit(batch).alias("batch"),
    )
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(tables.ledger_path)


def compact_bronze(tables: Tables, before: datetime | None = None) -> int:
    """Rewrite the bronze rows of loads up to a time into one batch; how many batches that were.

    The new batch is written beside the old ones; a map from old names to it, switched last by
    one file, makes readers look there, so a run that dies changes nothing they see. Rows that
    an earlier batch supersedes are left behind. The ledger stays as it is. Folders replaced
    here are deleted by the next compaction, so that readers that have begun find them. Loads
    with a time up to `before` must be over.
    """
    spark = tables.spark
    last = "~" if before is None else batch_name(before)
    known = {r.batch: r.target for r in tables.batch_map().collect()}
    logged = [r.batch for r in tables._ledger_batches().select("batch").distinct().collect()]  # as many as loads
    chosen = {known.get(b, b) for b in logged if b <= f"{last}~" or b in known}
    if len(chosen) < 2:
        return 0
    target = f"compact-{uuid.uuid4().hex}"
    among = F.col("batch").isin(sorted(chosen))
    samples = tables.stored_samples().filter(among).drop("batch").hint("rebalance", "channel")
    append_bronze(samples, tables, "samples", target)
    for table in DOCUMENT_CHANNELS:
        append_bronze(tables.stored_objects(table).filter(among).drop("batch", "data_stream").hint("rebalance"), tables, table, target)
    marks = read_or_empty(spark, tables.marks_path, T.StructType([*MARKS_SCHEMA, BATCH])).filter(among)
    _write_batch(marks.groupBy("athlete_id").agg(F.max("high_water").alias("high_water")), tables.marks_path, target)
    held = read_or_empty(spark, tables.quarantine_path, T.StructType([*QUARANTINE_SCHEMA, BATCH])).filter(among).drop("batch")
    _write_batch(held, tables.quarantine_path, target)
    moved = {**known, **{b: target for b in logged if known.get(b, b) in chosen}}
    seq = 1 + max((int(name.split("=")[1]) for name in _folders(spark, f"{tables.batch_map_path}/seq=*")), default=0)
    rows = spark.createDataFrame(sorted(moved.items()), "batch string, target string").coalesce(1)
    rows.write.mode("errorifexists").parquet(f"{tables.batch_map_path}/seq={seq}")
    # What an earlier map had replaced, and every target of it that isn't one now.
    gone = {*known, *known.values()} - set(moved.values()) - chosen
    roots = [tables.bronze_path("samples") + "/channel=*", *map(tables.bronze_path, DOCUMENT_CHANNELS), tables.marks_path, tables.quarantine_path]
    for batch in gone:
        for root in roots:
            for folder in _paths(spark, f"{root}/batch={batch}"):
                delete_folder(spark, folder)
    return len(chosen)


def _paths(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def _buckets(frame: DataFrame) -> list[int]:
    # At most the table's bucket count, whatever the data's size.
    return sorted(r[0] for r in frame.select(BUCKET).distinct().collect())


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    """Names of existing folders; patterns end in versions, buckets or switches, which are few."""
    return [path.rsplit("/", 1)[1] for path in _paths(spark, pattern)]


def _switch(spark: SparkSession, path: str, versions: list[tuple[str, int]]) -> None:
    """Make these folders the table, by one new file; a switch that another writer has made meanwhile fails it."""
    seq = 1 + max((int(name.split("=")[1]) for name in _folders(spark, f"{path}/switch/seq=*")), default=0)
    rows = spark.createDataFrame([NO_BUCKET, *versions], SWITCH_SCHEMA.rsplit(",", 1)[0])
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/switch/seq={seq}")


def _published_versions(spark: SparkSession, path: str, seq: str | None = None) -> list[tuple[str, int]]:
    frame = current_versions(spark, path) if seq is None else spark.read.parquet(f"{path}/switch/{seq}")
    return [(r.version, r[BUCKET]) for r in frame.collect() if r.version]


def vacuum(spark: SparkSession, path: str, kept: int = KEPT_SWITCHES) -> None:
    """Delete switches but the last `kept`, and versions that only deleted ones name.

    Versions no switch has named yet, of writers still at work, stay.
    """
    seqs = sorted(_folders(spark, f"{path}/switch/seq=*"), key=lambda name: int(name.split("=")[1]))
    old, last = seqs[:-kept], seqs[-kept:]
    if not old:
        return
    needed = {v for seq in last for v, _ in _published_versions(spark, path, seq)}
    gone = {v for seq in old for v, _ in _published_versions(spark, path, seq)} - needed
    for folder in [*(f"{path}/rows/version={v}" for v in gone), *(f"{path}/switch/{seq}" for seq in old)]:
        delete_folder(spark, folder)


def stage_bucketed(rows: DataFrame, buckets: int, anchor: str = "athlete_id") -> DataFrame:
    """Write rows to the shared folder by storage bucket and read them back.

    The rebalance gathers each bucket's rows and splits a bucket that is too large.
    """
    path = scratch_path(rows.sparkSession, "staged")
    placed = rows.drop(BUCKET).withColumn(BUCKET, bucket_of(F.col(anchor), buckets))
    with small_tasks(rows.sparkSession):
        placed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(placed.schema).parquet(path)


def replace_by_key(
    path: str,
    new_rows: DataFrame,
    keys: DataFrame | None,
    buckets: int,
    on: tuple[str, ...] = ("athlete_id",),
    staged: bool = False,
) -> DataFrame:
    """Replace the rows of `keys` in a bucketed parquet table by `new_rows`.

    `keys` names what is replaced (None: everything), `on` its columns, the first of which
    picks the bucket. A key without new rows ends up deleted. Key columns of the buckets
    concerned are read to find which of them hold rows to delete: those alone are rewritten,
    in the others the new rows are appended, so adding new keys costs no rewrite.

    What is written is a new version beside those that readers see; one switch at the end makes
    it count, so a run that dies leaves the table as it was, and so does one that another
    writer overtakes. A bucket in very many versions is rewritten as well. `staged` says that
    `new_rows` already come from `stage_bucketed`. Returns rows deleted and inserted.
    """
    spark, version = new_rows.sparkSession, f"v{uuid.uuid4().hex}"
    fresh = new_rows if staged else stage_bucketed(new_rows, buckets, on[0])
    stored, before = read_bucketed(spark, path, fresh.schema), _published_versions(spark, path)
    inserted, target = fresh.count(), f"{path}/rows/version={version}"
    if keys is None:
        deleted, rewritten = stored.count(), {bucket for _, bucket in before}
        fresh.write.partitionBy(BUCKET).parquet(target)
    else:
        wanted, pairing = stage_bucketed(keys.select(*on).distinct(), buckets, on[0]), [*on, BUCKET]
        concerned = stored.filter(F.col(BUCKET).isin(_buckets(wanted)))
        hits = {
            r[0]: r[1]
            for r in concerned.select(*pairing)
            .join(wanted, pairing, "left_semi")
            .groupBy(BUCKET)
            .agg(F.count(F.lit(1)))
            .collect()
        }
        versions = [bucket for _, bucket in before]
        deleted, rewritten = sum(hits.values()), {*hits, *(b for b in versions if versions.count(b) >= MOST_VERSIONS)}
        again = F.col(BUCKET).isin(sorted(rewritten))
        if rewritten:
            kept = stored.filter(again).join(wanted, pairing, "left_anti").select(*fresh.columns)
            kept.unionByName(fresh.filter(again)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(target)
        fresh.filter(~again).write.mode("append").partitionBy(BUCKET).parquet(target)
    _publish(spark, path, version, [(v, b) for v, b in before if b not in rewritten])
    return spark.createDataFrame([(deleted, inserted)], "deleted long, inserted long")


def _publish(spark: SparkSession, path: str, version: str, others: list[tuple[str, int]]) -> None:
    written = [int(name.split("=")[1]) for name in _folders(spark, f"{path}/rows/version={version}/{BUCKET}=*")]
    _switch(spark, path, [*others, *((version, bucket) for bucket in written)])
    if not written:
        delete_folder(spark, f"{path}/rows/version={version}")
    vacuum(spark, path)


def compact(spark: SparkSession, path: str, schema: T.StructType, most: int = 1) -> int:
    """Rewrite buckets that lie in more than `most` versions into one each; their number.

    Rows stay as they are, and readers see them throughout. The rebalance writes a bucket in
    files of ordinary size.
    """
    before = _published_versions(spark, path)
    versions = [bucket for _, bucket in before]
    scattered = sorted({b for b in versions if versions.count(b) > most})
    if scattered:
        version = f"v{uuid.uuid4().hex}"
        rows = read_bucketed(spark, path, schema).filter(F.col(BUCKET).isin(scattered))
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/rows/version={version}")
        _publish(spark, path, version, [(v, b) for v, b in before if b not in scattered])
    return len(scattered)


def upsert_by_key(
    path: str,
    schema: T.StructType,
    changes: DataFrame,
    keys: list[str],
    order: str,
    buckets: int,
    update: list[str] | None = None,
) -> DataFrame:
    """Apply `changes` to the stored rows of their keys; see `keyed.upsert` for the rules.

    The table is bucketed by the first key and created when it isn't there. Rows of other keys
    are read only where they share a bucket with one that is replaced. Returns rows deleted
    and inserted.
    """
    spark = changes.sparkSession
    touched = changes.select(*keys).distinct()
    stored = read_bucketed(spark, path, schema).drop(BUCKET)
    following = upsert(stored.join(touched, keys, "left_semi"), changes, keys, order, update)
    return replace_by_key(path, following, touched, buckets, tuple(keys))
