"""Best-fit-decreasing packing with a segment tree over bin capacities; packed id matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.token_ids import each_document

WIDTH = 2048
END_ID = 1
PAD_ID = 0
SHARD_TOKENS = 4_000_000

_ROWS = (
    "sequence_id long, n_tokens int, input_ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, starts array<long>"
)


class CapacityTree:
    """Counts of open bins by free capacity; finds the smallest capacity that is large enough."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, capacity: int, number: int) -> None:
        self.bins[capacity].append(number)
        self._change(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, bin) of the tightest bin with room for `need`, taken out of the tree."""
        node = self.leaves + need
        if not self.counts[node]:
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._change(capacity, -1)
        return capacity, self.bins[capacity].pop()

    def _change(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.counts[node] += by
            node >>= 1


def best_fit_decreasing(lengths: np.ndarray, width: int) -> list[list[int]]:
    """Bins of piece numbers; pieces by length falling, each into the tightest bin that holds it."""
    tree, bins = CapacityTree(width), []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[piece])
        found = tree.take(size)
        if found is None:
            bins.append([piece])
            room, number = width - size, len(bins) - 1
        else:
            room, number = found[0] - size, found[1]
            bins[number].append(piece)
        if room:
            tree.add(room, number)
    return bins


def pack(
    docs: DataFrame,
    tokenizer: str,
    width: int = WIDTH,
    end_id: int = END_ID,
    pad_id: int = PAD_ID,
    shard_tokens: int = SHARD_TOKENS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows of packed id matrices, one per sequence.

    `input_ids` holds `width` little-endian unsigned 32-bit ids, `pad_id` after the last;
    `cu_seqlens` the cumulative lengths of the segments from 0; `position_resets` where
    positions begin again at 0, the padding included; `doc_ids` and `starts` whose ids, and
    from where in the document, each segment holds. A document of more than `width` ids is
    split into full rows and a rest, without loss.

    Shards of about `shard_tokens` ids are packed inside the partitions that read them, so
    nothing is shuffled and memory is bounded. A null text is empty and has the end id alone;
    a null id stays null; repeated rows are packed each; an empty table has no rows; other
    columns are not read.
    """
    narrow = docs.selectExpr(f"cast(`{id_column}` as long) AS doc_id", f"`{text_column}` AS text")
    schema = pa.schema(
        [("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("input_ids", pa.binary())]
        + [(n, pa.list_(pa.int32())) for n in ("cu_seqlens", "position_resets")]
        + [(n, pa.list_(pa.int64())) for n in ("doc_ids", "starts")]
    )

    def packed(pieces: list[tuple[int | None, int, np.ndarray]], first: int) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(ids) for _, _, ids in pieces], np.int64)
        rows = []
        for number, members in enumerate(best_fit_decreasing(lengths, width)):
            edges = np.concatenate(([0], np.cumsum(lengths[members]))).astype(np.int32)
            line = np.full(width, pad_id, "<u4")
            line[: edges[-1]] = np.concatenate([pieces[m][2] for m in members])
            resets = edges if edges[-1] < width else edges[:-1]
            rows.append((first + number, int(edges[-1]), line.tobytes(), edges, resets, [pieces[m][0] for m in members], [pieces[m][1] for m in members]))
        for i in range(0, len(rows), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 1000]), schema)], schema=schema)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, pieces, held = TaskContext.get().partitionId() << 33, [], 0
        for doc_id, ids in each_document(batches, tokenizer, end_id):
            pieces += [(doc_id, start, ids[start : start + width]) for start in range(0, len(ids), width)]
            held += len(ids)
            if held >= shard_tokens:
                for batch in packed(pieces, number):
                    number += batch.num_rows
                    yield batch
                pieces, held = [], 0
        if pieces:
            yield from packed(pieces, number)

    return narrow.mapInArrow(shards, _ROWS)


def write_matrices(rows: DataFrame, path: str) -> None:
    """Packed rows as Parquet files, one matrix row of ids per record, in sequence order within files."""
    rows.sortWithinPartitions("sequence_id").write.mode("errorifexists").parquet(path)


def positions(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """(sequence_id, position_ids): positions counted from the last reset."""
    place = F.sequence(F.lit(0), F.lit(width - 1))
    from_last = F.transform(place, lambda p: p - F.array_max(F.filter("position_resets", lambda r: r <= p)))
    return rows.select("sequence_id", from_last.alias("position_ids"))
