"""Stored tables: names, paths and reads.

Bronze tables are partitioned by load batch, and the ledger row of a document is
written after its data. A batch counts only once the ledger names it, so a load that
died half-way leaves nothing a reader can see and the next run loads it again. Loads that
overlap may both load a document; readers see it in the first batch that has it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid.functions.schemas import LEDGER_SCHEMA, SILVER_SCHEMA
from pacegrid.functions.schemas import schema_for_channel
from pacegrid.model import DOCUMENT_CHANNELS, SAMPLE_CHANNELS, SUCCESS, source_name
from pacegrid.operators.bounds import in_scope
from pacegrid.operators.incremental import succeeded
from pacegrid.session import stored

EXTRA = T.StructField("_extra", T.MapType(T.StringType(), T.StringType()))
BATCH = T.StructField("batch", T.StringType())
# Ids of the document's path, which the ledger goes by; those in its body may differ.
PATH_IDS = [T.StructField("path_athlete", T.StringType()), T.StructField("path_activity", T.StringType())]
#: Loaded again on purpose: every load of a profile stays visible.
SNAPSHOTS = "athlete_summary"

SAMPLES_SCHEMA = T.StructType(
    [
        T.StructField("athlete_id", T.StringType()),
        T.StructField("activity_id", T.StringType()),
        T.StructField("index", T.LongType()),
        T.StructField("data", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("original_size", T.LongType()),
        T.StructField("series_type", T.StringType()),
        T.StructField("metadata_insert_timestamp", T.TimestampType()),
        T.StructField("channel", T.StringType()),
        BATCH,
    ]
)

QUARANTINE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("athlete_id", "channel", "activity_id", "value", "reason", "origin")]
)
MARKS_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ("athlete_id", "high_water")])


#: Rows and bytes of text that one task sorts.
TASK_ROWS = 250_000
TASK_BYTES = 64_000_000


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table with its declared schema; a table never written has no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


BUCKET = "athlete_bucket"
# A row of every switch, so that one without buckets is one too.
NO_BUCKET = ("", -1)
SWITCH_SCHEMA = f"version string, {BUCKET} int, seq int"


def current_versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, bucket) of the folders that make up a bucketed table now: those of its last switch."""
    switches = read_or_empty(spark, f"{path}/switch", T.StructType.fromDDL(SWITCH_SCHEMA))
    return switches.join(F.broadcast(switches.agg(F.max("seq").alias("seq"))), "seq", "left_semi").drop("seq")


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written by `replace_by_key`, as its last switch says; one never written has no rows.

    Rows lie in `rows/version=V/athlete_bucket=B`, and which versions count for a bucket in
    `switch/seq=N`. So a reader sees the table before a replacement or after it, never between.
    The switch has a row for each bucket and version, which bounds what is broadcast.
    """
    bucket = [] if BUCKET in schema.names else [T.StructField(BUCKET, T.IntegerType())]
    rows = read_or_empty(spark, f"{path}/rows", T.StructType([*schema, *bucket, T.StructField("version", T.StringType())]))
    return rows.join(F.broadcast(current_versions(spark, path)), ["version", BUCKET], "left_semi").select(*schema.names, *(f.name for f in bucket))


@dataclass(frozen=True)
class Tables:
    """The tables of one environment and source below a root folder."""

    spark: SparkSession
    root: str
    env: str = "dev"
    source: str = "STRAVA"
    buckets: int = 64

    def __post_init__(self) -> None:
        object.__setattr__(self, "source", source_name(self.source))
        object.__setattr__(self, "root", self.root.rstrip("/"))

    @property
    def bronze_schema(self) -> str:
        return f"{self.env}_bronze_{self.source.lower()}"

    @property
    def silver_schema(self) -> str:
        return f"{self.env}_silver_{self.source.lower()}"

    def bronze_path(self, table: str) -> str:
        return f"{self.root}/{self.bronze_schema}/{table}"

    def silver_path(self, table: str = "aggregate_stream") -> str:
        return f"{self.root}/{self.silver_schema}/{table}"

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/{self.env}_metrics/metrics"

    @property
    def marks_path(self) -> str:
        return f"{self.root}/{self.env}_metrics/marks_{self.source.lower()}"

    @property
    def quarantine_path(self) -> str:
        return f"{self.root}/{self.env}_metrics/quarantine_{self.source.lower()}"

    def marks(self) -> DataFrame:
        """Latest start per athlete, from the marks that each load keeps: a row per athlete and batch."""
        kept = self._of_batches(read_or_empty(self.spark, self.marks_path, T.StructType([*MARKS_SCHEMA, BATCH])))
        return kept.groupBy("athlete_id").agg(F.max("high_water").alias("high_water"))

    def quarantine(self) -> DataFrame:
        """Documents that never loaded: the last body and reason, and how many loads have failed on it."""
        key = ["athlete_id", "channel", "activity_id"]
        failed = self._of_batches(read_or_empty(self.spark, self.quarantine_path, T.StructType([*QUARANTINE_SCHEMA, BATCH])))
        # Texts in an aggregate are sorted, so each task gets a bounded part of them.
        size = failed.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes")).first()
        dealt = failed.repartition(1 + size.n // TASK_ROWS + size.bytes // TASK_BYTES, *key)
        last = dealt.groupBy(*key).agg(
            F.max(F.struct("origin", "value", "reason")).alias("_last"), F.count_distinct("origin").alias("attempts")
        )
        loaded = succeeded(self.ledger(), self.source).distinct()
        return last.select(*key, "_last.value", "_last.reason", "attempts").join(loaded, key, "left_anti")

    def _of_batches(self, frame: DataFrame) -> DataFrame:
        return frame.join(F.broadcast(self._places(self._ledger_batches())), "batch", "left_semi")

    def has_batch(self, batch: str) -> bool:
        return not self._ledger_batches().filter(F.col("batch") == batch).isEmpty()

    def batch_entries(self, batch: str) -> DataFrame:
        return self._ledger_batches().filter(F.col("batch") == batch).drop("batch")

    def ledger(self) -> DataFrame:
        return self._ledger_batches().drop("batch")

    def _ledger_batches(self) -> DataFrame:
        return read_or_empty(self.spark, self.ledger_path, T.StructType([*LEDGER_SCHEMA, BATCH]))

    @property
    def batch_map_path(self) -> str:
        return f"{self.root}/{self.env}_metrics/batch_map_{self.source.lower()}"

    def batch_map(self) -> DataFrame:
        """(batch, target): where the rows of compacted batches lie now, by the last compaction's map."""
        maps = read_or_empty(self.spark, self.batch_map_path, T.StructType.fromDDL("batch string, target string, seq int"))
        return maps.join(maps.agg(F.max("seq").alias("seq")), "seq", "left_semi").select("batch", "target")

    def _places(self, batches: DataFrame) -> DataFrame:
        """Distinct names of the batches in which the rows of these ledger batches lie."""
        placed = batches.select("batch").distinct().join(self.batch_map(), "batch", "left")
        return placed.select(F.coalesce("target", "batch").alias("batch")).distinct()

    def _superseded(self, scope: DataFrame | None, streams: Column) -> DataFrame | None:
        """(athlete_id, data_stream, activity_id, batch) of documents that an earlier batch has too.

        There are none but for loads that overlapped, and then None saves readers a join. Hashes
        of the keys tell whether there can be any, and the keys themselves which.
        """
        key = ["athlete_id", "data_stream", "activity_id"]
        loaded = self._ledger_batches().filter(
            (F.col("status") == SUCCESS) & (F.col("data_source") == self.source) & (F.col("data_stream") != SNAPSHOTS) & streams
        )
        hashes = loaded
        if scope is not None:
            within = F.xxhash64(*scope.columns).alias("_scope")
            hashes = loaded.withColumn("_scope", within).join(scope.select(within), "_scope", "left_semi")
        if hashes.groupBy(F.xxhash64(*key)).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").isEmpty():
            return None
        if scope is not None:
            loaded = loaded.join(scope, scope.columns, "left_semi")
        repeated = loaded.groupBy(*key).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").select(*key)
        copies = loaded.select(*key, "batch").distinct().join(repeated, key, "left_semi")
        first = copies.groupBy(*key).agg(F.min("batch").alias("_first"))
        later = copies.join(first, key).filter("batch <> _first").drop("_first")
        # A compaction leaves superseded rows behind.
        return stored(later.join(self.batch_map(), "batch", "left_anti"), "superseded")

    def _published(self, frame: DataFrame, scope: DataFrame | None, ids: dict[str, str], streams: Column) -> DataFrame:
        """Rows of batches the ledger names; `ids` says which columns hold a row's document key, `streams` whose entries matter."""
        entries = self._ledger_batches()
        if scope is not None:
            entries = entries.join(scope, scope.columns, "left_semi")
        # By the partition column: dynamic pruning opens the batches it names. There are as many
        # names as loads, and rows of a batch must not gather in the task of its name.
        named = frame.join(F.broadcast(self._places(entries)), "batch", "left_semi")
        later = self._superseded(scope, streams)
        if later is None:
            return named
        later = later.select("batch", *[F.col(c).alias(own) for c, own in ids.items()])
        return named.join(later, later.columns, "left_anti")

    def samples(self, scope: DataFrame | None = None) -> DataFrame:
        """All sample channels as one long table.

        With a `scope` (distinct athletes, or athletes and activities) only batches that
        loaded any of its documents are read, as the ledger tells; rows of others that
        share those batches are still there.
        """
        return self.stored_samples(scope).drop("batch")

    def stored_samples(self, scope: DataFrame | None = None) -> DataFrame:
        """The same with the batch each row lies in."""
        rows = read_or_empty(self.spark, self.bronze_path("samples"), SAMPLES_SCHEMA)
        ids = {"athlete_id": "athlete_id", "data_stream": "channel", "activity_id": "activity_id"}
        return self._published(rows, scope, ids, F.col("data_stream").isin(list(SAMPLE_CHANNELS)))

    def stored_objects(self, table: str, scope: DataFrame | None = None) -> DataFrame:
        """Activity or profile rows with path ids and the batch each lies in."""
        declared = schema_for_channel(self.source, table)
        rows = read_or_empty(self.spark, self.bronze_path(table), T.StructType([*declared, EXTRA, *PATH_IDS, BATCH]))
        ids = {"athlete_id": "path_athlete", "data_stream": "data_stream", "activity_id": "path_activity"}
        return self._published(rows.withColumn("data_stream", F.lit(table)), scope, ids, F.col("data_stream") == table)

    def bronze(self, table: str, scope: DataFrame | None = None) -> DataFrame:
        """A bronze table under its channel name, with its declared columns."""
        if table in SAMPLE_CHANNELS:
            columns = schema_for_channel(self.source, table).names
            return self.samples(scope).filter(F.col("channel") == table).select(*columns)
        return self.stored_objects(table, scope).select(*schema_for_channel(self.source, table).names, "_extra")

    def silver(self, table: str = "aggregate_stream", schema: T.StructType = SILVER_SCHEMA) -> DataFrame:
        return read_bucketed(self.spark, self.silver_path(table), schema)

    def register(self, scope: DataFrame | None = None) -> None:
        """Name every bronze table as a temporary view `{bronze schema}__{table}`.

        With a `scope` the views hold its rows only; profiles go by athlete.
        """
        prefix = f"{self.bronze_schema}__"
        samples = in_scope(self.samples(scope), scope)
        samples.createOrReplaceTempView(f"{prefix}samples")
        for table in SAMPLE_CHANNELS:
            columns = schema_for_channel(self.source, table).names
            rows = samples.filter(F.col("channel") == table).select(*columns)
            rows.createOrReplaceTempView(f"{prefix}{table}")
        athletes = None if scope is None else scope.select("athlete_id").distinct()
        for table, part in (("activity", scope), ("athlete_summary", athletes)):
            in_scope(self.bronze(table, part), part).createOrReplaceTempView(f"{prefix}{table}")

    def create_views(self) -> list[str]:
        """Name the stored bronze and silver tables in the catalog as `{schema}.{table}`.

        Views over the files, so they follow later loads; name them again after the first compaction.
        A table not yet written has none.
        """
        ledger = f"parquet.`{self.ledger_path}`"
        first = (
            f"SELECT athlete_id, data_stream, activity_id, min(batch) AS batch FROM {ledger} "
            f"WHERE status = '{SUCCESS}' AND data_source = '{self.source}' AND data_stream <> '{SNAPSHOTS}' "
            "GROUP BY athlete_id, data_stream, activity_id HAVING count(*) > 1"
        )
        moved = f"parquet.`{self.batch_map_path}`"
        places = f"SELECT batch FROM {ledger}"
        if not self.batch_map().isEmpty():
            last = f"SELECT batch, target FROM {moved} WHERE seq = (SELECT max(seq) FROM {moved})"
            places = f"SELECT coalesce(m.target, l.batch) FROM {ledger} l LEFT JOIN ({last}) m ON m.batch = l.batch"
        named = []

        def published(athlete: str, stream: str, activity: str) -> str:
            return (
                f"t.batch IN ({places}) AND NOT EXISTS (SELECT 1 FROM ({first}) f WHERE f.batch <> t.batch "
                f"AND f.athlete_id = t.{athlete} AND f.data_stream = {stream} AND f.activity_id = t.{activity})"
            )

        def view(name: str, columns: list[str], path: str, where: str) -> None:
            listed = ", ".join(f"`{c}`" for c in columns)
            text = f"SELECT {listed} FROM parquet.`{path}` t WHERE {where}"
            try:
                self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
            except AnalysisException as error:
                if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
                return
            named.append(name)

        for schema in (self.bronze_schema, self.silver_schema):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        for table in SAMPLE_CHANNELS:
            columns = schema_for_channel(self.source, table).names
            where = f"channel = '{table}' AND {published('athlete_id', f"'{table}'", 'activity_id')}"
            view(f"{self.bronze_schema}.{table}", columns, self.bronze_path("samples"), where)
        for table in DOCUMENT_CHANNELS:
            columns = schema_for_channel(self.source, table).names
            where = published("path_athlete", f"'{table}'", "path_activity")
            view(f"{self.bronze_schema}.{table}", columns, self.bronze_path(table), where)
        switch = f"parquet.`{self.silver_path()}/switch`"
        now = f"SELECT version, {BUCKET} FROM {switch} WHERE seq = (SELECT max(seq) FROM {switch})"
        where = f"(t.version, t.{BUCKET}) IN ({now})"
        view(f"{self.silver_schema}.aggregate_stream", SILVER_SCHEMA.names, f"{self.silver_path()}/rows", where)
        return named


def connection_scan(users: DataFrame, connections: DataFrame, source: str) -> DataFrame:
    """Every user beside the connection record of one source; none gives nulls."""
    wanted = connections.filter(F.lower("source") == source.lower()).drop("source")
    found = wanted.withColumn("_found", F.lit(True))
    joined = users.join(found, "uid", "left")
    return joined.withColumn("has_connection", F.col("_found").isNotNull()).drop("_found")
