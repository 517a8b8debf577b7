"""Documents to bronze rows and ledger."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid.functions.columns import decoded, number_of, whole_number
from pacegrid.functions.schemas import ACTIVITY_SCHEMA, ATHLETE_SCHEMA, RAW_ACTIVITY, RAW_ATHLETE
from pacegrid.model import (
    CHANNELS,
    DOCUMENT_CHANNELS,
    DOCUMENT_KEY,
    FAILURE,
    FLAG_CHANNEL,
    PAIR_CHANNEL,
    SAMPLE_CHANNELS,
    SLICES,
)
from pacegrid.operators import reshape
from pacegrid.operators.alignment import athlete_slice
from pacegrid.operators.incremental import skip_processed
from pacegrid.operators.quality import load_status, without_empty_batches
from pacegrid.session import delete_folder, scratch_path, small_tasks, stored
from pacegrid.sinks.tables import append_bronze, append_ledger, append_marks, append_objects, append_quarantine, delete_faulty, new_batch
from pacegrid.sources import landing
from pacegrid.sources.files import SCHEMES, scheme_of
from pacegrid.sources.tables import SAMPLES_SCHEMA, Tables

_CORRUPT = "_corrupt"
_OBJECTS = {
    "activity": (RAW_ACTIVITY, ACTIVITY_SCHEMA, "activity_id"),
    "athlete_summary": (RAW_ATHLETE, ATHLETE_SCHEMA, "athlete_id"),
}


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def _parsed(json: Column, schema: str) -> Column:
    return F.from_json(json, f"{schema}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT})


def parse_documents(documents: DataFrame) -> DataFrame:
    """Every document parsed once, in the shape of its channel, with its fault if any.

    Samples become arrays of doubles (`data`) or of pairs (`pairs`); activity and profile
    documents stay as JSON text. `reason` is null for a document that can be loaded.

    Arrays are read as numbers (or booleans) straight away, which is several times faster
    than as text; only a document that is not so uniform is read again element by element.
    """
    channel, value = F.col("channel"), F.col("value")
    shape = "original_size string, series_type string"
    is_object = channel.isin(list(DOCUMENT_CHANNELS))
    is_pair, is_flag = channel == PAIR_CHANNEL, channel == FLAG_CHANNEL
    is_plain = ~is_object & ~is_pair

    def clean(column: str) -> Column:
        return F.col(column).isNotNull() & F.col(f"{column}.{_CORRUPT}").isNull()

    uniform = documents.withColumn("value", decoded(value)).withColumns(
        {
            "_numbers": F.when(is_plain & ~is_flag, _parsed(value, f"data array<double>, {shape}")),
            "_flags": F.when(is_flag, _parsed(value, f"data array<boolean>, {shape}")),
            "_pairs": F.when(is_pair, _parsed(value, f"data array<array<double>>, {shape}")),
        }
    )
    mixed = is_plain & ~clean("_numbers") & ~clean("_flags")
    parsed = uniform.withColumn("_texts", F.when(mixed, _parsed(value, f"data array<string>, {shape}")))

    def read(field: str) -> Column:
        return (
            F.when(is_pair, F.col(f"_pairs.{field}"))
            .when(mixed, F.col(f"_texts.{field}"))
            .when(is_flag, F.col(f"_flags.{field}"))
            .otherwise(F.col(f"_numbers.{field}"))
        )

    data = (
        F.when(mixed, F.transform("_texts.data", number_of))
        .when(is_flag, F.col("_flags.data").cast("array<double>"))
        .otherwise(F.col("_numbers.data"))
    )
    count = F.coalesce(F.array_size(data), F.array_size("_pairs.data"), F.lit(0)).cast("long")
    size = whole_number(read("original_size"))
    keys = F.json_object_keys(value)
    lacks_data = ~is_object & data.isNull() & F.col("_pairs.data").isNull() & ~F.coalesce(F.array_contains(keys, "data"), F.lit(False))
    bad_sample = F.exists("_texts.data", lambda x: x.isNotNull() & number_of(x).isNull())
    malformed = (is_pair & ~clean("_pairs")) | (mixed & ~clean("_texts"))
    reason = (
        F.when(~channel.isin(list(CHANNELS)), F.lit("unknown_channel"))
        .when(malformed, F.lit("malformed_json"))
        .when(lacks_data, F.lit("required:data"))
        .when(F.coalesce(bad_sample, F.lit(False)), F.lit("bad_value:data"))
        .when(read("original_size").isNotNull() & size.isNull(), F.lit("bad_value:original_size"))
        .when(is_plain & (count > 0) & read("series_type").isNull(), F.lit("required:series_type"))
    )
    return parsed.select(
        *DOCUMENT_KEY,
        F.col("landed") if "landed" in documents.columns else F.lit(None).cast("string").alias("landed"),
        F.monotonically_increasing_id().alias("doc_no"),
        F.when(is_object | reason.isNotNull(), value).alias("document"),
        data.alias("data"),
        F.col("_pairs.data").alias("pairs"),
        size.alias("original_size"),
        read("series_type").alias("series_type"),
        F.when(is_object, F.lit(1)).otherwise(count).cast("long").alias("record_count"),
        reason.alias("reason"),
    )


def stage_documents(documents: DataFrame, path: str) -> DataFrame:
    """Parse documents into a frame stored at `path`, one directory per channel.

    The text is read and parsed once although several writes follow, and those all see
    the same documents. Documents are gathered by channel while samples are still arrays,
    in a few slices each; a slice that holds much of the data is split by the rebalance.
    """
    parsed = parse_documents(documents)
    sliced = parsed.withColumn("_slice", F.pmod(F.xxhash64("athlete_id", "activity_id"), F.lit(SLICES)))
    with small_tasks(documents.sparkSession):
        (
            sliced.hint("rebalance", "channel", "_slice")
            .drop("_slice")
            .sortWithinPartitions("channel", "athlete_id", "activity_id")
            .write.partitionBy("channel")
            .option("compression", "zstd")
            .parquet(path)
        )
    return documents.sparkSession.read.schema(parsed.schema).parquet(path)


def sample_rows(staged: DataFrame, at: datetime, transforms: dict | None = None) -> DataFrame:
    """Bronze sample rows of the loadable documents, all channels in one long frame.

    Channels without a registered transform share a branch; each other has its own. The
    filters are on the directory column, so no branch reads another's files.
    """
    registry = reshape.TRANSFORMS if transforms is None else transforms
    good = staged.filter(F.col("reason").isNull())
    plain = [c for c in SAMPLE_CHANNELS if c != PAIR_CHANNEL and c not in registry]
    own = [c for c in SAMPLE_CHANNELS if c == PAIR_CHANNEL or c in registry]
    fields = ("original_size", "series_type")

    def exploded(channels: list[str], column: str) -> DataFrame:
        rows = good.filter(F.col("channel").isin(channels))
        return reshape.explode_samples(rows.select(*DOCUMENT_KEY, *fields, F.col(column).alias("data")))

    branches = [exploded(plain, "data")] + [
        reshape.dispatch(c, exploded([c], "pairs" if c == PAIR_CHANNEL else "data"), registry) for c in own
    ]
    rows = reshape.stamp(reshape.union_batches(*branches), at)
    return rows.select(*[F.col(c) for c in SAMPLES_SCHEMA.names if c != "batch"])


def _unnamed(entries: Column, names: list[str]) -> Column:
    return F.map_filter(entries, lambda k, _: ~k.isin(names))


def _undeclared(entries: Column, raw: T.StructType) -> Column:
    """Entries of a JSON object that the shape does not name, those of nested objects as `outer.inner`."""

    def within(field: T.StructField) -> Column:
        inner = F.from_json(F.try_element_at(entries, F.lit(field.name)), "map<string,string>")
        rest = F.transform_keys(_unnamed(inner, field.dataType.names), lambda k, _: F.concat(F.lit(f"{field.name}."), k))
        return F.coalesce(F.map_filter(rest, lambda k, _: ~F.map_contains_key(entries, k)), F.create_map().cast("map<string,string>"))

    nested = [field for field in raw if isinstance(field.dataType, T.StructType)]
    return F.map_concat(_unnamed(entries, raw.names), *map(within, nested)) if nested else _unnamed(entries, raw.names)


def object_rows(staged: DataFrame, channel: str, at: datetime, transforms: dict | None = None) -> DataFrame:
    """Bronze rows of activity or profile documents, with `_violations` and `_extra`.

    `_athlete` and `_activity` are the ids of the document's path.
    """
    raw, schema, id_column = _OBJECTS[channel]
    kept = ("_athlete", "_activity", "_extra")
    documents = staged.filter((F.col("channel") == channel) & F.col("reason").isNull()).select(
        F.col("athlete_id").alias("_athlete"),
        F.col("activity_id").alias("_activity"),
        F.from_json("document", "map<string,string>").alias("_entries"),
        F.from_json("document", raw).alias("_doc"),
    )
    documents = documents.withColumn("_extra", _undeclared(F.col("_entries"), raw))
    leaves = reshape.flatten(documents.select(*kept, "_doc.*"))
    named = reshape.rename_id(reshape.clean_column_names(leaves), id_column)
    rows = reshape.stamp(reshape.dispatch(channel, named, transforms), at)
    return reshape.conform(rows, schema, keep=kept, extra=None)


def object_reason() -> Column:
    """Fault of an object row; a document that is no JSON object has no entries at all."""
    return F.when(F.col("_extra").isNull(), F.lit("malformed_json")).when(
        F.col("_violations") != "", F.col("_violations")
    )


def ledger_entries(staged: DataFrame, objects: dict[str, DataFrame], source: str) -> DataFrame:
    """One row per document attempted, also for empty and for failed ones."""
    columns = ("athlete_id", "activity_id", "channel", "record_count", "reason")
    settled = staged.filter(~F.col("channel").isin(list(objects)) | F.col("reason").isNotNull())
    parts = [settled.select(*columns)]
    for channel, rows in objects.items():
        parts.append(
            rows.select(
                F.col("_athlete").alias("athlete_id"),
                F.col("_activity").alias("activity_id"),
                F.lit(channel).alias("channel"),
                F.lit(1).cast("long").alias("record_count"),
                "reason",
            )
        )
    entries = load_status(reshape.union_batches(*parts))
    return entries.withColumnRenamed("channel", "data_stream").withColumn("data_source", F.lit(source))


def failed_bodies(staged: DataFrame, objects: dict[str, DataFrame]) -> DataFrame:
    """Keys, body and reason of documents that can't be loaded."""
    key = list(DOCUMENT_KEY)
    parts = [staged.filter(F.col("reason").isNotNull()).select(*key, F.col("document").alias("value"), "reason")]
    for channel, rows in objects.items():
        broken = rows.filter(F.col("reason").isNotNull()).select(
            F.col("_athlete").alias("athlete_id"), F.col("_activity").alias("activity_id"), F.col("reason").alias("_reason")
        )
        if broken.isEmpty():
            continue
        bodies = staged.filter((F.col("channel") == channel) & F.col("reason").isNull())
        found = bodies.join(broken, ["athlete_id", "activity_id"])
        parts.append(found.select(*key, F.col("document").alias("value"), F.col("_reason").alias("reason")))
    return reshape.union_batches(*parts)


def load_documents(
    documents: DataFrame,
    tables: Tables,
    at: datetime | None = None,
    ledger_empty: bool = True,
    transforms: dict | None = None,
    skip_known: bool = False,
    isolate: bool = False,
    batch: str | None = None,
) -> DataFrame:
    """Write documents to bronze, failed ones to quarantine, then ledger rows, as one batch of its own name.

    Two loads never share a batch, also not with the same `at`. A caller that can repeat the
    same documents, as a stream does, names the `batch`: written again it replaces itself. With `isolate` a document of
    an unknown channel is a FAILURE of its own; otherwise it ends the load.

    Returns the batch's ledger rows with `reason`, stored by themselves: the parsed documents
    are deleted when all tables are written.
    `ledger_empty=False` logs nothing for an athlete's channel whose documents are all
    empty, so they are looked at again by the next run. `skip_known` leaves out documents
    the ledger holds, for callers that have not done so and expect hardly any.
    """
    at = at or utc_now()
    batch = batch or new_batch(at)
    stage = scratch_path(documents.sparkSession, "load")
    staged = stage_documents(documents, f"{stage}/documents")
    if not isolate:
        landing.assert_known_channels(staged)
    if "landed" in documents.columns:
        staged = landing.latest_documents(staged)
    if skip_known:
        staged = skip_processed(staged, tables.ledger(), tables.source, few=True)
    append_bronze(sample_rows(staged, at, transforms), tables, "samples", batch)
    objects = {}
    for channel in DOCUMENT_CHANNELS:
        rows = object_rows(staged, channel, at, transforms)
        paths = {"_athlete": "path_athlete", "_activity": "path_activity"}
        rows = rows.withColumn("_reason", object_reason()).drop("_violations").withColumnsRenamed(paths)
        # One pass over the parsed documents: what else is asked of them is read from the narrow columns written.
        good, faulty = append_objects(rows, tables, channel, batch)
        if channel == "activity":
            append_marks(good, tables, batch)
        keys = [F.col(own).alias(name) for name, own in paths.items()]
        objects[channel] = good.select(*keys, F.lit(None).cast("string").alias("reason")).unionByName(faulty.select(*keys, F.col("_reason").alias("reason")))
    entries = ledger_entries(staged, objects, tables.source)
    append_quarantine(failed_bodies(staged, objects), tables, batch)
    if not ledger_empty:
        entries = without_empty_batches(entries)
    entries = stored(entries, "entries")
    append_ledger(entries, tables, at, batch)
    for channel in objects:
        delete_faulty(tables, channel, batch)
    delete_folder(documents.sparkSession, stage)
    return entries


def listing(tables: Tables, root: str, layout: str = "files", landed_since: datetime | None = None) -> DataFrame:
    """Keys and place of every landed document, stored once for all that asks for them."""
    if layout not in ("files", "packed"):
        raise ValueError(f"Unknown layout: {layout}")
    if layout == "files":
        return stored(landing.list_files(tables.spark, root), "listing")
    return stored(landing.list_packed(tables.spark, root, landed_since=landed_since), "listing")


def fresh_documents(
    tables: Tables,
    root: str,
    layout: str = "files",
    channels: list[str] | None = None,
    sample: int | None = None,
    athletes: DataFrame | None = None,
    refresh_profiles: bool = False,
    landed_since: datetime | None = None,
    isolate: bool = False,
    listed: DataFrame | None = None,
) -> DataFrame:
    """Landed documents the ledger does not hold as loaded.

    All is decided on the listing's narrow keys: the ledger, the sample, which landing of a
    document is the last. Only then the files that hold a remaining document are opened.
    Athletes outside the set play no part. An unknown channel of the others fails the run,
    also when channels are selected, unless `isolate` leaves that to single documents. A
    sample is taken before the ledger is applied and may leave nothing new. `landed_since`
    leaves out directories of packed documents landed earlier, unlisted. `listed` is a
    `listing` made before.
    """
    as_files = layout == "files"
    found = athlete_slice(listing(tables, root, layout, landed_since) if listed is None else listed, athletes)
    if not isolate:
        landing.assert_known_channels(found)
    found = landing.select_channels(landing.named_files(found) if as_files else landing.last_landed(found), channels)
    if sample is not None:
        found = landing.sample_files(found, sample, order="file_path" if as_files else "activity_id")
    fresh = skip_processed(found, tables.ledger(), tables.source)
    if refresh_profiles:
        profiles = found.filter(F.col("channel") == "athlete_summary")
        fresh = fresh.filter(F.col("channel") != "athlete_summary").unionByName(profiles)
    fresh = stored(fresh, "fresh")
    if as_files:
        return landing.read_files(fresh)
    if scheme_of(root) in SCHEMES:
        return landing.read_packed(fresh)
    keys = [*DOCUMENT_KEY, "landed"]
    return landing.scan_packed(tables.spark, root, channels, landed_since).join(fresh.select(*keys), keys, "left_semi")


def bronze_load(tables: Tables, root: str, at: datetime | None = None, **options) -> DataFrame:
    """Load what is new below a landing root; see `fresh_documents` and `load_documents`.

    Returns the batch's ledger rows, and a FAILURE for every file whose path names no
    athlete, activity or channel; those have no ids and aren't in the stored ledger. Both come
    from one listing.
    """
    writing = {k: options.pop(k) for k in ("ledger_empty", "transforms") if k in options}
    writing["isolate"] = options.get("isolate", False)
    layout = options.get("layout", "files")
    listed = listing(tables, root, layout, options.get("landed_since"))
    entries = load_documents(fresh_documents(tables, root, listed=listed, **options), tables, at, **writing)
    if layout != "files":
        return entries
    rejected = landing.rejected_paths(listed).select(
        F.concat_ws(":", "reason", "file_path").alias("reason"),
        F.lit(FAILURE).alias("status"),
        F.lit(0).cast("long").alias("record_count"),
        F.lit(tables.source).alias("data_source"),
    )
    return entries.unionByName(rejected, allowMissingColumns=True)


def reload_failed(
    tables: Tables, repair: Callable[[DataFrame], DataFrame] | None = None, at: datetime | None = None, **options
) -> DataFrame:
    """Load quarantined documents again, and no others; the landing isn't looked at.

    `repair` takes the rows of `Tables.quarantine` and gives those to try with their `value`
    mended. Returns the batch's ledger rows; what fails again has one attempt more.
    """
    held = stored(tables.quarantine(), "quarantine")
    tried = held if repair is None else repair(held)
    return load_documents(tried.select(*DOCUMENT_KEY, "value"), tables, at, **options)
