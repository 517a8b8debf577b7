"""Listing and reading of single files in tasks; no path passes through the driver."""

from __future__ import annotations

import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import json as pa_json
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid.session import stored

READERS = 8
BATCH_BYTES = 16_000_000
#: Bytes and files that one task reads.
TASK_BYTES = 64_000_000
TASK_FILES = 4_096
#: Wanted keys of one file that a task holds at once.
TASK_KEYS = 250_000
#: Schemes that tasks open by themselves; others are left to Spark's own sources.
SCHEMES = ("file", "s3", "s3a", "gs", "hdfs", "abfss")

_ENTRY = "path string, folder boolean, length long"


def scheme_of(uri: str) -> str:
    return uri.split(":", 1)[0] if ":" in uri.split("/", 1)[0] else "file"


def opened(uri: str) -> tuple[FileSystem, str, str]:
    """File system, path in it, and what its paths need in front to be URIs again."""
    scheme = scheme_of(uri)
    if scheme == "file":
        path = "/" + uri.removeprefix("file:").lstrip("/")
        return FileSystem.from_uri(path)[0], path, "file://"
    system, path = FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    prefix = f"{scheme}://" + (uri.split("/", 3)[2] if scheme in ("hdfs", "abfss") else "")
    return system, path, prefix


def _hidden(path: str) -> bool:
    return path.rsplit("/", 1)[-1].startswith(("_", "."))


def _listed(entries: DataFrame, deep: bool, wanted: list[str] | None = None) -> DataFrame:
    """Files as they are, folders replaced by what they hold, with `deep` at any depth.

    Of the folders found, only those with a `wanted` name are kept.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, bool, int]] = []

            def look(path: str) -> None:
                system, inside, prefix = opened(path)
                for entry in system.get_file_info(FileSelector(inside)):
                    if _hidden(entry.path):
                        continue
                    folder = entry.type == FileType.Directory
                    if folder and deep:
                        look(prefix + entry.path)
                    elif not folder or not wanted or entry.base_name in wanted:
                        found.append((prefix + entry.path, folder, entry.size or 0))

            for path, folder, length in zip(*(c.to_pylist() for c in batch.columns)):
                if folder:
                    look(path)
                else:
                    found.append((path, False, length))
            for at in range(0, len(found), 10_000):
                part = list(zip(*found[at : at + 10_000]))
                columns = [pa.array(c, k) for c, k in zip(part, (pa.string(), pa.bool_(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "folder", "length"])

    return entries.mapInArrow(rows, _ENTRY)


def list_tree(spark: SparkSession, root: str, folders: list[str] | None = None) -> DataFrame:
    """(path, length) of every JSON file below a root, listed in tasks, hidden ones left out.

    Level by level: the root's folders are dealt to tasks, then theirs, so neither a large
    root nor a large folder is walked by one. `folders` limits those of the second level.
    """
    tasks = spark.sparkContext.defaultParallelism
    entries = spark.range(1).select(F.lit(root).alias("path"), F.lit(True).alias("folder"), F.lit(0).cast("long").alias("length"))
    for deep, wanted in ((False, None), (False, folders), (True, None)):
        entries = _listed(entries, deep, wanted)
        if not deep:
            entries = entries.repartition(tasks, "path")
    return entries.filter(F.col("path").endswith(".json")).select("path", "length")


def _content(path: str) -> bytes:
    system, inside, _ = opened(path)
    with system.open_input_stream(inside) as stream:
        return stream.read()


def read_texts(files: DataFrame, path_column: str, length_column: str) -> DataFrame:
    """`files` with `value`, the text of each, opened in tasks; files are dealt by number and size."""
    size = files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(length_column), F.lit(0)).alias("bytes")).first()
    tasks = max(1, min(size.n, max(files.sparkSession.sparkContext.defaultParallelism, size.n // TASK_FILES + size.bytes // TASK_BYTES)))
    columns = files.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(READERS) as readers:
            for batch in batches:
                at = 0
                sizes = batch.column(length_column).to_pylist()
                while at < batch.num_rows:
                    end, held = at + 1, sizes[at]
                    while end < batch.num_rows and held + sizes[end] <= BATCH_BYTES:
                        held += sizes[end]
                        end += 1
                    part = batch.slice(at, end - at)
                    texts = [raw.decode(errors="replace") for raw in readers.map(_content, part.column(path_column).to_pylist())]
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*columns, "value"])
                    at = end

    schema = ", ".join(f"`{name}` {kind}" for name, kind in files.dtypes) + ", value string"
    return files.repartition(tasks, path_column).mapInArrow(rows, schema)


def read_lines(wanted: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Lines of JSON-lines files whose `keys` are wanted, with the field `text` as `value`.

    `wanted` has `file_path`, the keys (strings) and more columns that are the same for all
    rows of a file. Each file is opened by the task that has its wanted keys, or by a task for
    each part of them where they are more than TASK_KEYS; no other file is opened and no text
    is shuffled. Lines that repeat a key are all there.
    """
    more = [c for c in wanted.columns if c not in (*keys, "file_path")]
    files = wanted.groupBy("file_path").agg(F.ceil(F.count(F.lit(1)) / TASK_KEYS).alias("_parts"))
    size = files.agg(F.coalesce(F.sum("_parts"), F.lit(0)).alias("tasks"), F.max("_parts").alias("most")).first()
    tasks, parts = max(1, size.tasks), F.lit(1)
    if size.tasks and size.most > 1:
        wanted, parts = wanted.join(stored(files.filter("_parts > 1"), "files"), "file_path", "left"), F.coalesce("_parts", F.lit(1))
    dealt = wanted.withColumn("_part", F.pmod(F.xxhash64(*keys), parts))
    asked = F.collect_set(_mark(keys)).alias("asked")
    by_file = dealt.repartition(tasks, "file_path", "_part").groupBy("file_path", "_part", *more).agg(asked)
    names = [*keys, *more, "value"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                path, *rest = (batch.column(c)[at].as_py() for c in ("file_path", *more))
                known = batch.column("asked")[at].values
                system, inside, _ = opened(unquote(path))  # Spark tells URIs
                with system.open_input_stream(inside) as stream:
                    for block in _blocks(stream):
                        found = _wanted(block, keys, text, known)
                        if found.num_rows:
                            same = [pa.repeat(pa.scalar(value, pa.string()), found.num_rows) for value in rest]
                            yield pa.RecordBatch.from_arrays([*found.columns[:-1], *same, found.columns[-1]], names=names)

    return by_file.mapInArrow(rows, ", ".join(f"`{c}` string" for c in names))


def _mark(keys: list[str]) -> Column:
    """Several strings or nulls as one string, which no others give; `_marks` is the same in a task."""
    return F.concat(*[F.coalesce(F.concat(F.octet_length(k).cast("string"), F.lit(":"), F.col(k)), F.lit("-")) for k in keys])


def _marks(columns: list[pa.Array]) -> pa.Array:
    def one(column: pa.Array) -> pa.Array:
        return pc.coalesce(pc.binary_join_element_wise(pc.binary_length(column).cast(pa.string()), column, ":"), "-")

    return pc.binary_join_element_wise(*map(one, columns), "")


def _wanted(block: bytes, keys: list[str], text: str, known: pa.Array) -> pa.RecordBatch:
    """Keys and text of the JSON lines with a known key; a block that Arrow's reader refuses is read line by line."""
    schema = pa.schema([(name, pa.string()) for name in (*keys, text)])

    def asked(columns: list[pa.Array]) -> pa.Array:
        return pc.is_in(_marks(columns), value_set=known)

    try:
        table = pa_json.read_json(
            pa.BufferReader(block),
            pa_json.ReadOptions(use_threads=False, block_size=len(block) + 1),
            pa_json.ParseOptions(explicit_schema=schema, unexpected_field_behavior="ignore"),
        )
        table.validate(full=True)
    except pa.ArrowInvalid:
        lines = [json.loads(line) for line in block.split(b"\n") if line.strip()]
        lines = [line for line in lines if all(isinstance(line.get(k), str | None) for k in keys)]
        mask = asked([pa.array([line.get(k) for line in lines], pa.string()) for k in keys]).to_pylist()
        lines = [line for line, is_asked in zip(lines, mask) if is_asked]
        return pa.RecordBatch.from_arrays([pa.array([line.get(name) for line in lines], pa.string()) for name in schema.names], schema.names)
    fields = table.combine_chunks().to_batches()[0]
    return fields.filter(asked(fields.columns[:-1]))


def _blocks(stream: pa.NativeFile) -> Iterator[bytes]:
    """Whole lines of a stream, by line feed alone, some megabytes at once."""
    rest = []
    while piece := stream.read(BATCH_BYTES):
        whole, feed, last = piece.rpartition(b"\n")
        if not feed:
            rest.append(piece)
            continue
        block = b"".join((*rest, whole))
        rest = [last]
        if block.strip():
            yield block
    block = b"".join(rest)
    if block.strip():
        yield block
