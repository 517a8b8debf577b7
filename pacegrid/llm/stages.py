"""Tables staged in the shared folder, batches of sorted groups, and tiles of large cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid.session import scratch_path

ROWS_A_FILE = 500_000
SCAN_BYTES = 16_000_000


def staged(frame: DataFrame, label: str, files: int | None = None) -> tuple[DataFrame, str]:
    """`frame` written to the shared folder and read back, with its path.

    The written table cuts the lineage: a lost executor costs the tasks it ran, not the
    steps before. Catalyst also learns its real size, which decides later joins. `files`
    bounds the number of files, so that small tables aren't scattered over tiny ones.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    (frame if files is None else frame.coalesce(files)).write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


def kept(frame: DataFrame) -> DataFrame:
    """`frame` held on the executors' disks for its few next readers, with its lineage.

    What is lost with an executor is computed again from the staged table it comes from.
    """
    return frame.persist(StorageLevel.DISK_ONLY)


def files_for(frame: DataFrame, rows: int) -> int:
    """Files for so many narrow rows: one for each ROWS_A_FILE, and one at least for each core."""
    return max(frame.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_FILE))


def scan_parts(frame: DataFrame) -> int:
    """Partitions for a scan of `frame`: one for each SCAN_BYTES of files, two at least for each core.

    Only ever used to coalesce; a frame of unknown size keeps its partitions.
    """
    size = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(1 << 30, max(2 * frame.sparkSession.sparkContext.defaultParallelism, -(-size // SCAN_BYTES)))


def heavy_join(many: DataFrame, one: DataFrame, key: str | list[str], weight: str) -> DataFrame:
    """`many` joined with the row of `one` that has its key; `weight` says how many rows of `many` have it.

    Keys of more than a thousandth of all rows, so fewer than 1,000, are broadcast, and their
    rows stay where they are. No other key can fill a task. Both frames are read twice.
    """
    total = one.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    heavy, keys = one.where(F.col(weight) * 1000 > total), [key] if isinstance(key, str) else key
    light = many.join(F.broadcast(heavy.select(keys)), keys, "left_anti").join(one.where(F.col(weight) * 1000 <= total), keys)
    return many.join(F.broadcast(heavy), keys).unionByName(light)


def put_file(spark: SparkSession, name: str, block: bytes) -> str:
    """`block` as one file in the shared folder; its path, which executors reach."""
    path = f"{scratch_path(spark, 'file')}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        stream.write(bytearray(block))
    finally:
        stream.close()
    return path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete staged tables whose last reader is done."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def text_slices(batch: pa.RecordBatch, column: str, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with about `chars` bytes of text each, at least one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys out of batches that are sorted by them; keys hold no null."""
    pending: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, dtype=bool)
        for key in keys:
            values = table.column(key).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(change)

    for batch in batches:
        if not batch.num_rows:
            continue
        pending.append(batch)
        table = pa.Table.from_batches(pending).combine_chunks()
        edges = cut(table)
        if not len(edges):
            continue
        start = 0
        for edge in edges:
            yield table.slice(start, edge - start)
            start = edge
        pending = table.slice(start).to_batches()
    if pending:
        yield pa.Table.from_batches(pending).combine_chunks()


def tile_count(rows: Column, size: int) -> Column:
    """Chunks that a cell of so many rows is cut into."""
    return F.ceil(rows / F.lit(size)).cast("int")


def with_tiles(rows: DataFrame, chunks: Column, key: Column) -> DataFrame:
    """Each row once for every tile (tile_lo, tile_hi) of its cell that its chunk meets.

    A cell of c chunks has c * (c + 1) / 2 tiles; a pair of rows of one cell meets in
    exactly one of them. A tile holds two chunks at most, however large the cell.
    """
    dealt = rows.withColumn("chunks", F.greatest(chunks, F.lit(1)))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64(key), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return (
        dealt.withColumn("tile_lo", F.least("chunk", "met"))
        .withColumn("tile_hi", F.greatest("chunk", "met"))
        .drop("met", "chunks")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b): the smallest node it reaches.

    Alternating large and small stars: every round writes its edges to the shared folder, so
    a lost executor costs one round. The number of rounds grows with the logarithm of the
    longest chain. Loops and repeated edges are harmless; no edges give no rows.
    """
    spark, path = edges.sparkSession, None
    current = edges.select("a", "b").where("a <> b").distinct()
    files = max(1, -(-current.count() // ROWS_A_FILE))
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest, low_path = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "lowest", files)
        larger = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large, large_path = staged(larger, "large", files)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        following, new = staged(small, "links", files)
        remove(spark, low_path, large_path, *([path] if path else []))
        current, path = following, new
        centres = current.select(F.col("b").alias("a")).distinct()
        done = current.join(centres, "a", "left_semi").isEmpty() and current.groupBy("a").count().where("count > 1").isEmpty()
        if done:
            break
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def linked_classes(members: DataFrame, reps: DataFrame, linked: DataFrame) -> tuple[DataFrame, list[str]]:
    """(member, n_links, component) of every member, and the staged tables behind it.

    `members` (member, rep) says whose copy a member is, `reps` (rep, weight) how many copies
    there are, `linked` (rep, links, reached) what single tiles have found: the copies that a
    representative is linked with, and the smallest representative it reaches.
    """
    joined = components(linked.select(F.col("rep").alias("a"), F.col("reached").alias("b")))
    links = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    told = reps.select("rep", "weight").join(links, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    told = told.select(
        "rep", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )
    told, path = staged(told, "classes", files_for(reps, reps.count()))
    return members.join(told, "rep").select("member", "n_links", "component"), [path]
