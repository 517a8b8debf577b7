"""Landed documents as an incremental file source."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pacegrid.model import DOCUMENT_KEY, SUCCESS
from pacegrid.plans.bronze import load_documents
from pacegrid.plans.silver import silver_run
from pacegrid.sources import landing
from pacegrid.sources.tables import Tables


def stream_documents(
    spark: SparkSession, root: str, layout: str = "files", max_files: int | None = None
) -> DataFrame:
    """Documents as they land; the source's own log remembers which files were taken."""
    if layout == "packed":
        reader = spark.readStream.schema(landing.PACKED_SCHEMA)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.json(root).select(*DOCUMENT_KEY, F.col("document").alias("value"), "landed")
    reader = (
        spark.readStream.format("binaryFile")
        .schema(landing.FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.load(root).select("path", F.col("content").cast("string").alias("value"))
    return landing.named_files(landing.with_identity(files))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query that a checkpoint belongs to; Spark writes it when the query starts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def ingest_available(
    tables: Tables,
    root: str,
    checkpoint: str,
    layout: str = "files",
    max_files: int | None = None,
    silver: bool = False,
) -> StreamingQuery:
    """Load all documents not taken before, then stop; with `silver` the activities they touch are rebuilt.

    A micro-batch is a load batch named by the query's id, which its checkpoint keeps, and its
    number. Run again after a failure it replaces what it had written, or, if the ledger has
    it, only its activities are rebuilt. A checkpoint made anew has another id. The ledger anti-join still runs in each, so a lost checkpoint cannot load a
    document twice. Only new files are opened, which a batch run over a large landing tree
    cannot promise.
    """

    def load(batch: DataFrame, number: int) -> None:
        name = f"stream-{query_id(tables.spark, checkpoint)}-{number:012d}"
        if not tables.has_batch(name):
            load_documents(batch, tables, skip_known=True, batch=name)
        if silver:
            done = tables.batch_entries(name).filter(F.col("status") == SUCCESS)
            silver_run(tables, activities=done.filter(F.col("data_stream") != "athlete_summary"))

    stream = stream_documents(tables.spark, root, layout, max_files)
    return (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(load)
        .start()
    )
