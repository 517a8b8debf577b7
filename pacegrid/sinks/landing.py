"""Land documents, packed or one file each."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime

from pyarrow import RecordBatch
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.model import DOCUMENT_KEY, SLICES
from pacegrid.session import small_tasks
from pacegrid.sources.files import opened
from pacegrid.sources.landing import batch_name, index_packed


#: Lines of a packed file, so that a task which reads one holds few keys.
FILE_LINES = 200_000


def as_document(df: DataFrame, *columns: str) -> DataFrame:
    """Document identity and its body as JSON text; null fields are written out."""
    body = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(*DOCUMENT_KEY, body.alias("document"))


def land_raw(documents: DataFrame, root: str, at: datetime) -> None:
    """Write documents as compressed JSON lines below `channel=C/landed=T/`.

    Many documents share a file: one file each would mean billions of tiny files. The
    rebalance gathers a channel's lines in a few slices and splits a slice that is large.
    An index of keys and files follows, by which loads open only files with new documents.
    """
    with small_tasks(documents.sparkSession):
        (
            documents.select(*DOCUMENT_KEY, "document")
            .withColumn("landed", F.lit(batch_name(at)))
            .withColumn("_slice", F.pmod(F.xxhash64("athlete_id", "activity_id"), F.lit(SLICES)))
            .hint("rebalance", "channel", "_slice")
            .drop("_slice")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "gzip")
            .option("zlib.compress.level", "BEST_SPEED")
            .option("maxRecordsPerFile", FILE_LINES)
            .partitionBy("channel", "landed")
            .json(root)
        )
    index_packed(documents.sparkSession, root, batch_name(at))


def land_files(documents: DataFrame, root: str) -> int:
    """Write each document to `athlete_id=A/{channel}/activity_id=X.json`; the number written.

    The layout other tools land in. Executors write their own rows beside their place and
    move them there whole, so nobody sees half a document; a task that runs again writes the
    same files again. A null document is written as JSON's `null`. `root` is a path or URI
    that executors reach. Use `land_raw` where nothing asks for single files.
    """

    def write(batches: Iterator[RecordBatch]) -> Iterator[RecordBatch]:
        files, base, _ = opened(root)
        for batch in batches:
            for athlete, channel, activity, text in zip(*(column.to_pylist() for column in batch.columns)):
                folder = f"{base}/athlete_id={athlete}/{channel}"
                files.create_dir(folder, recursive=True)
                name = f"activity_id={activity}.json"
                beside = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with files.open_output_stream(beside) as out:
                    out.write(("null" if text is None else text).encode())
                files.move(beside, f"{folder}/{name}")
            yield batch.select(["activity_id"])

    return documents.select(*DOCUMENT_KEY, "document").mapInArrow(write, "activity_id string").count()
