"""Landed JSON documents.

Two layouts are read. `files`: one document per file, identity in the path
`athlete_id=A/{channel}/activity_id=X.json`. `packed`: many documents per file, one
JSON line each with the identity inside, in directories `channel=C/landed=T/`.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pacegrid.functions.columns import path_activity, path_athlete, path_channel, path_part
from pacegrid.model import CHANNELS, DOCUMENT_KEY
from pacegrid.session import stored
from pacegrid.sources import files as tasks

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
PACKED_SCHEMA = "athlete_id string, activity_id string, document string, channel string, landed string"
DOCUMENT_SCHEMA = "athlete_id string, channel string, activity_id string, file_path string, value string"
PACKED_KEYS = "athlete_id string, activity_id string, channel string, landed string"
# Beside the channels; Spark's file sources pass over names with an underscore.
PACKED_INDEX = "_index"


class UnknownChannel(ValueError):
    pass


def with_identity(files: DataFrame) -> DataFrame:
    path = F.col("path")
    return files.select(
        path_athlete(path).alias("athlete_id"),
        path_channel(path).alias("channel"),
        path_activity(path).alias("activity_id"),
        path.alias("file_path"),
        *[c for c in files.columns if c != "path"],
    )


def _binary_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    # Recursive lookup keeps partition discovery off, which would read `0017` as 17.
    return (
        spark.read.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .load(paths)
    )


def _tree(root: str, channels: list[str] | None) -> str:
    if not channels:
        return root
    return f"{root}/athlete_id=*/{{{','.join(sorted(channels))}}}"


def assert_root(spark: SparkSession, root: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raise FileNotFoundError(f"No landing root: {root}")


def list_files(spark: SparkSession, root: str, channels: list[str] | None = None) -> DataFrame:
    """Identity, path and length of every document file, empty ones too; contents are not read.

    Folders are listed in tasks, and no path passes through the driver. A channel list narrows
    the listing itself. Channels without a directory are absent; a root that doesn't exist is
    an error. Where only Spark can open the store, its own listing on the driver serves.
    """
    assert_root(spark, root)
    if tasks.scheme_of(root) in tasks.SCHEMES:
        return with_identity(tasks.list_tree(spark, root, channels))
    try:
        return with_identity(_binary_files(spark, _tree(root, channels)).select("path", "length"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DOCUMENT_SCHEMA.replace("value string", "length long"))


def read_files(files: DataFrame) -> DataFrame:
    """Contents of the listed files, and of no others, however many there are, opened in tasks."""
    spark = files.sparkSession
    first = files.select("file_path").first()
    if first is None:
        return spark.createDataFrame([], DOCUMENT_SCHEMA)
    if tasks.scheme_of(first[0]) in tasks.SCHEMES:
        return tasks.read_texts(files, "file_path", "length").select(*DOCUMENT_KEY, "file_path", "value")
    root = first[0].split("/athlete_id=")[0]
    return scan_files(spark, root).join(files.select("file_path"), "file_path", "left_semi").select(*DOCUMENT_KEY, "file_path", "value")


def scan_files(spark: SparkSession, root: str, channels: list[str] | None = None) -> DataFrame:
    """Every document with its text, as one lazy scan."""
    assert_root(spark, root)
    try:
        files = _binary_files(spark, _tree(root, channels))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DOCUMENT_SCHEMA)
    return with_identity(files.select("path", F.col("content").cast("string").alias("value")))


def batch_name(at: datetime) -> str:
    """Sortable name of a load or landing time."""
    return at.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%S%f")


def scan_packed(
    spark: SparkSession,
    root: str,
    channels: list[str] | None = None,
    landed_since: datetime | None = None,
) -> DataFrame:
    """Every packed document with its landing time. Both filters prune directories.

    A document may have been landed more than once; see `latest_documents`.
    """
    lines = spark.read.schema(PACKED_SCHEMA).json(root)
    if channels:
        lines = lines.filter(F.col("channel").isin(list(channels)))
    if landed_since is not None:
        lines = lines.filter(F.col("landed") >= batch_name(landed_since))
    return lines.select(*DOCUMENT_KEY, F.col("document").alias("value"), "landed")


def index_packed(spark: SparkSession, root: str, landed: str) -> None:
    """Write keys and file of every document landed at one time, below `_index/landed=T/`.

    The lines are read for their keys only, so the index names what is there, also after a
    landing that was done twice.
    """
    lines = _keys_of(spark, root, [f"{root}/channel=*/landed={landed}"])
    if lines is not None:
        lines.drop("landed").write.mode("overwrite").parquet(f"{root}/{PACKED_INDEX}/landed={landed}")


def _keys_of(spark: SparkSession, root: str, folders: list[str]) -> DataFrame | None:
    try:
        lines = spark.read.schema(PACKED_KEYS).option("basePath", root).json(folders)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return lines.select(*DOCUMENT_KEY, "landed", F.col("_metadata.file_path").alias("file_path"))


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    """Existing folders of a pattern; there are as many as channels and landings, not documents."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [str(status.getPath().toString()) for status in found or []]


def list_packed(
    spark: SparkSession, root: str, channels: list[str] | None = None, landed_since: datetime | None = None
) -> DataFrame:
    """Keys, landing time and file of every packed document; no document's text is read.

    Landings with an index are listed from it. Others, written by other tools or cut off
    before their index, are scanned for their keys. Both filters prune directories.
    """
    assert_root(spark, root)
    since = "" if landed_since is None else batch_name(landed_since)

    def landed(folder: str) -> str:
        return folder.rsplit("/landed=", 1)[1]

    indexed = [f for f in _folders(spark, f"{root}/{PACKED_INDEX}/landed=*") if landed(f) >= since]
    known = {landed(f) for f in indexed}
    folders = [f for f in _folders(spark, f"{root}/channel=*/landed=*") if landed(f) >= since and landed(f) not in known]
    schema = "athlete_id string, channel string, activity_id string, file_path string, landed string"
    parts = [spark.createDataFrame([], schema).select(*DOCUMENT_KEY, "landed", "file_path")]
    if indexed:
        rows = spark.read.schema(schema).option("basePath", f"{root}/{PACKED_INDEX}").parquet(*indexed)
        parts.append(rows.select(*DOCUMENT_KEY, "landed", "file_path"))
    if folders:
        parts.append(_keys_of(spark, root, folders))
    listed = reduce(DataFrame.unionByName, parts)
    return listed.filter(F.col("channel").isin(list(channels))) if channels else listed


def read_packed(wanted: DataFrame) -> DataFrame:
    """Texts of listed packed documents. Files without any are not opened, and no text is shuffled."""
    keys = ["athlete_id", "activity_id"]
    return tasks.read_lines(wanted.select(*DOCUMENT_KEY, "landed", "file_path"), keys, "document").select(*DOCUMENT_KEY, "value", "landed")


def last_landed(listed: DataFrame) -> DataFrame:
    """Of listed documents landed more than once, the last; of one landing, those of one file.

    Files are numbered in the order of their landing, so that keys are aggregated with a number
    beside them, by hash and without their long paths.
    """
    key, place = list(DOCUMENT_KEY), ["landed", "file_path"]
    numbered = F.row_number().over(Window.orderBy(*place)).alias("_file")
    files = stored(listed.select(*place).distinct().select(*place, numbered), "files")
    same = reduce(and_, [F.col(f"l.{c}").eqNullSafe(F.col(f"f.{c}")) for c in place])
    last = listed.alias("l").join(files.alias("f"), same).groupBy(*[f"l.{c}" for c in key]).agg(F.max("_file").alias("_file"))
    return last.join(files, "_file").select(*key, *place)


def latest_documents(staged: DataFrame) -> DataFrame:
    """Of documents landed more than once, only the last.

    Works on narrow keys; what it leaves out is stored, so document contents move only if
    that is much.
    Needs a stored frame: `doc_no` breaks ties and must not change between reads.
    """
    key = list(DOCUMENT_KEY)
    counted = staged.groupBy(*key).agg(F.count(F.lit(1)).alias("_times"))
    repeated = counted.filter(F.col("_times") > 1).select(*key)
    copies = staged.select(*key, "landed", "doc_no").join(repeated, key, "left_semi")
    last = copies.groupBy(*key).agg(F.max(F.struct("landed", "doc_no"))["doc_no"].alias("_last"))
    older = copies.join(last, key).filter(F.col("doc_no") != F.col("_last")).select("doc_no")
    return staged.join(stored(older, "older"), "doc_no", "left_anti").select(*staged.columns)


def discover_channels(files: DataFrame) -> DataFrame:
    """Distinct channel directories and whether each is a known one."""
    known = F.coalesce(F.col("channel").isin(list(CHANNELS)), F.lit(False))
    return files.groupBy("channel").agg(F.count(F.lit(1)).alias("documents")).withColumn("known", known)


def assert_known_channels(files: DataFrame) -> None:
    """Fail the run on a channel directory outside the fixed list."""
    found = discover_channels(files.filter(F.col("channel").isNotNull())).filter(~F.col("known"))
    names = [r[0] for r in found.select("channel").collect()]
    if names:
        raise UnknownChannel(f"Unknown channels: {', '.join(sorted(names))}")


def select_channels(
    files: DataFrame,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    column: str = "channel",
) -> DataFrame:
    """Keep included channels, else drop excluded ones; neither given keeps all."""
    if include:
        return files.filter(F.col(column).isin(list(include)))
    if exclude:
        return files.filter(~F.col(column).isin(list(exclude)))
    return files


def filter_channels(include: list[str] | None = None, exclude: list[str] | None = None) -> list[str]:
    """Channel names picked by upper-case member name; include wins, neither gives none."""
    if include:
        return [c for c in CHANNELS if c.upper() in include]
    if exclude:
        return [c for c in CHANNELS if c.upper() not in exclude]
    return []


def sample_files(
    files: DataFrame,
    n: int,
    within: tuple[str, ...] = ("athlete_id", "channel"),
    order: str = "file_path",
) -> DataFrame:
    """First `n` files of each athlete and channel, before any ledger filter.

    Each slice of a group is cut to `n` before the groups are ranked whole, so a
    channel with most of the files never sorts in one task.
    """
    slices = F.pmod(F.xxhash64(F.col(order)), F.lit(256))

    def first(frame: DataFrame, *extra: str) -> DataFrame:
        window = Window.partitionBy(*within, *extra).orderBy(order)
        return frame.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")

    return first(first(files.withColumn("_slice", slices), "_slice").drop("_slice"))


def path_fault() -> Column:
    """What a path lacks of athlete, channel and activity; null when complete."""
    return (
        F.when(F.col("athlete_id").isNull(), F.lit("no_athlete_in_path"))
        .when(F.col("activity_id").isNull(), F.lit("no_activity_in_path"))
        .when(F.col("channel").isNull(), F.lit("no_channel_in_path"))
    )


def rejected_paths(files: DataFrame) -> DataFrame:
    """Files whose path does not carry a complete identity, with the reason."""
    return files.select("file_path", path_fault().alias("reason")).filter(F.col("reason").isNotNull())


def named_files(files: DataFrame) -> DataFrame:
    """Files whose path carries a complete identity."""
    return files.dropna(subset=list(DOCUMENT_KEY))
