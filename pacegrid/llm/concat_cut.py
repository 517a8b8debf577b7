"""Concatenate and cut: global token offsets by two prefix sums, then fixed windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacegrid.llm.stages import scan_parts, staged
from pacegrid.llm.token_ids import each_document, encoding

WINDOW = 2048
END_ID = 1
ROWS_OUT = 2_000

_LOCAL = "part long, local_start long, doc_id long, n_tokens long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "padded_length long, ids binary"
)


def localized(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Pass one: each document's ids and its place among the tokens of its own partition.

    Ids take two bytes each where the vocabulary allows it. The partition number and the place come from one task attempt and are written together,
    so a repeated task replaces both.
    """

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = "<u2" if encoding(tokenizer).max_token_value < 1 << 16 else "<u4"
        part, place, rows = TaskContext.get().partitionId(), 0, []
        schema = pa.schema(
            [("part", pa.int64()), ("local_start", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
        )
        held = 0
        for doc_id, ids in each_document(batches, tokenizer, end_id):
            rows.append((part, place, doc_id, len(ids), ids.astype(kind).tobytes()))
            place, held = place + len(ids), held + ids.nbytes
            if len(rows) >= ROWS_OUT or held > 8_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.mapInArrow(tokens, _LOCAL)


def part_offsets(local: DataFrame) -> DataFrame:
    """Pass two: the tokens before each partition. One row per partition of the first pass."""
    totals = local.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))


def cut(local: DataFrame, window: int) -> DataFrame:
    """Pieces of the documents at the borders of fixed windows of the whole token stream."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _PIECES.split(", ")]
        kinds = [pa.int64()] * 8 + [pa.binary()]
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("doc_id", "n_tokens", "first", "stream"))
            out: list[tuple] = []
            for doc_id, size, first, stream, raw in zip(*columns, batch.column("ids")):
                stored = raw.as_py()
                view, start = np.frombuffer(stored, f"<u{len(stored) // size}").astype("<u4"), 0
                while start < size:
                    sequence, offset = divmod(first + start, window)
                    length = min(size - start, window - offset)
                    part = view[start : start + length].tobytes()
                    filled = window if (sequence + 1) * window <= stream else stream - sequence * window
                    padded = filled if filled & (filled - 1) == 0 else window
                    out.append((doc_id, start, length, zlib.crc32(part), size, sequence, offset, padded, part))
                    start += length
                    if len(out) >= ROWS_OUT:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return local.mapInArrow(pieces, _PIECES)


def pack_pieces(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Boundary records: one row per stretch of a document within one sequence.

    `doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length`, with
    `ids` (little-endian unsigned 32-bit) if asked for. All sequences but the last are full;
    the last is padded to `window` unless its length is a power of two.

    A null text is empty and has the end id alone; a null id stays null; each repeated row is
    packed by itself; an empty table has no pieces; other columns are not read. Token ids are
    written once to the shared folder; the offsets, one row per partition, are written too, so
    that Catalyst joins them by their real size and the ids need not move when they are few.
    """
    narrow = docs.selectExpr(f"cast(`{id_column}` as long) AS doc_id", f"`{text_column}` AS text")
    local, _ = staged(localized(narrow.coalesce(scan_parts(narrow)), tokenizer, end_id), "token-ids")
    offsets, _ = staged(part_offsets(local.select("part", "n_tokens")), "part-offsets")
    whole = local.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    placed = local.join(offsets, "part").select(
        "doc_id", "n_tokens", (F.col("part_start") + F.col("local_start")).alias("first"), F.lit(whole).cast("long").alias("stream"), "ids"
    )
    pieces = cut(placed, window)
    return pieces if with_ids else pieces.drop("ids")


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, input_ids, segment_starts) out of pieces with ids; at most `window` ids each."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    rows = pieces.groupBy("sequence_id").agg(ordered.alias("parts"), F.max("padded_length").alias("padded"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts = [], []
            for parts, padded in zip(batch.column("parts").to_pylist(), batch.column("padded").to_pylist()):
                row = np.full(padded, pad_id, np.uint32)
                for part in parts:
                    row[part["offset"] : part["offset"] + part["length"]] = np.frombuffer(part["ids"], "<u4")
                ids.append(row.astype(np.int32))
                starts.append([part["offset"] for part in parts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int32()))],
                names=["sequence_id", "input_ids", "segment_starts"],
            )

    return rows.mapInArrow(lines, "sequence_id long, input_ids array<int>, segment_starts array<int>")
