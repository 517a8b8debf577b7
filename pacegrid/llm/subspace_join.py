"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine c have squared distance 2 - 2c. After a fixed rotation the
components are split into blocks; where the whole squared distance is within the budget, at
least one block's is within that block's share, in proportion to its components. Each block
is range-joined: a grid over its first two components with cells as wide as the block's
radius, every vector at home in its own cell and a visitor in the later cells it may reach.
A pair is verified once, in its first block within the share, by its exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.pivot_search import finite
from pacegrid.llm.stages import files_for, kept, linked_classes, remove, sorted_groups, staged, tile_count, with_tiles

COSINE = 0.93
BLOCKS = 4
CHUNK_ROWS = 2_048
SLACK = 1e-9

_CELLS = "cell long, block int, visitor boolean, rep long"


def rotation(width: int) -> np.ndarray:
    """The same random rotation everywhere for vectors of one length."""
    q, r = np.linalg.qr(np.random.default_rng(width).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def blocks_of(width: int, blocks: int) -> list[slice]:
    edges = np.linspace(0, width, min(blocks, width) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows**2).sum(1))[:, None]


def mixed(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit key of several integer columns."""
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out = (out ^ part.astype(np.int64).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.astype(np.int64)


def cells_of(rows: np.ndarray, labels: np.ndarray, places: np.ndarray, budget: float, blocks: int) -> list[tuple]:
    """(block, cells, visitor flags, row places) of unit rows of one length: homes and visits in every block."""
    width = rows.shape[1]
    turned, found = rows @ rotation(width), []
    for number, block in enumerate(blocks_of(width, blocks)):
        radius = np.sqrt(budget * (block.stop - block.start) / width) + SLACK
        axes = turned[:, block][:, :2]
        at = np.floor(axes / radius).astype(np.int64)
        if at.shape[1] == 1:
            at, axes = np.column_stack([at, np.zeros(len(at), np.int64)]), np.column_stack([axes, np.zeros(len(at))])
        marks = (labels, np.full(len(rows), width), np.full(len(rows), number))
        found.append((number, mixed(*marks, at[:, 0], at[:, 1]), np.zeros(len(rows), bool), places))
        for dx, dy in ((0, 1), (1, -1), (1, 0), (1, 1)):
            gap = np.zeros(len(rows))
            for axis, step in enumerate((dx, dy)):
                edge = (at[:, axis] + (step > 0)) * radius
                gap += (axes[:, axis] - edge) ** 2 if step else 0.0
            near = gap <= (radius + SLACK) ** 2
            cell = mixed(*marks, at[:, 0] + dx, at[:, 1] + dy)
            found.append((number, cell[near], np.ones(int(near.sum()), bool), places[near]))
    return found


def linked_in_tile(rows: np.ndarray, number: int, visitor: np.ndarray, chunk: np.ndarray, one_chunk: bool, cosine: float, blocks: int):
    """(first, second) places of the pairs of a tile that are linked and belong to block `number`."""
    budget, width = 2 - 2 * cosine, rows.shape[1]
    turned = rows @ rotation(width)
    parts = blocks_of(width, blocks)
    shares = [budget * (b.stop - b.start) / width + SLACK for b in parts]
    own = turned[:, parts[number]]
    squares = (own**2).sum(1)
    firsts, seconds = [], []
    for start in range(0, len(rows), 256):
        stop = min(start + 256, len(rows))
        apart = squares[start:stop, None] + squares[None, start:] - 2 * own[start:stop] @ own[start:].T
        near = apart <= shares[number] + 1e-7
        near &= np.arange(start, len(rows))[None, :] > np.arange(start, stop)[:, None]
        near &= ~(visitor[start:stop, None] & visitor[None, start:])
        if not one_chunk:
            near &= chunk[start:stop, None] != chunk[None, start:]
        i, j = np.nonzero(near)
        i, j = i + start, j + start
        for low in range(0, len(i), 100_000):
            a, b = i[low : low + 100_000], j[low : low + 100_000]
            gaps = np.stack([((turned[a, p] - turned[b, p]) ** 2).sum(1) for p in parts], 1) <= shares
            kept = gaps[:, number] & ~gaps[:, :number].any(1)
            a, b = a[kept], b[kept]
            kept = (rows[a] * rows[b]).sum(1) >= cosine
            firsts.append(a[kept])
            seconds.append(b[kept])
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *firsts]), np.concatenate([empty, *seconds])


def smallest_reached(first: np.ndarray, second: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each id the smallest one that the pairs of places (first, second) connect it with."""
    lowest = ids.copy()
    while True:
        before = lowest.copy()
        np.minimum.at(lowest, first, lowest[second])
        np.minimum.at(lowest, second, lowest[first])
        if (before == lowest).all():
            return lowest


def near_duplicates(
    vectors: DataFrame,
    cosine: float = COSINE,
    blocks: int = BLOCKS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Vectors of equal non-null label and equal length are linked when their cosine in double
    precision reaches `cosine`. Null vectors and labels, zero vectors, and vectors that hold
    null or non-finite components link with nothing. Rows with a null id stay and have no links.
    Rows of one id are one vector, the smallest of them, and give one row. Other columns are not
    read, and an empty table gives no rows.

    Copies are one vector with a weight. Cells are cut into chunks of about CHUNK_ROWS rows and
    joined tile by tile; a tile gives one row per linked vector, never its pairs: how many it is
    linked with, and the smallest vector reached in the tile.
    """
    spark = vectors.sparkSession
    vector = F.col(vector_column)
    kind = "double" if vectors.schema[vector_column].dataType.elementType.typeName() == "double" else "float"
    plain = F.transform(vector, lambda x: x.cast(kind) + F.lit(0.0).cast(kind))
    length = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    usable = F.col(label_column).isNotNull() & finite(vector) & (length > 0) & (length < float("inf"))
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.when(F.coalesce(usable, F.lit(False)), F.struct(F.xxhash64(F.col(label_column)).alias("label"), plain.alias("vector"))).alias("held"),
    )
    named = rows.where("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("held").alias("held"))
    files = files_for(vectors, 20 * vectors.count())  # a vector weighs as much as many narrow rows
    rows, rows_path = staged(named.select("vec_id", "held.label", "held.vector"), "vectors", files)
    usable_rows = rows.where("vector IS NOT NULL")
    reps, reps_path = staged(usable_rows.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight")), "distinct", files)
    members = usable_rows.join(reps, ["label", "vector"]).select("vec_id", "rep")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, ids, labels = batch.column("vector"), batch.column("rep").to_numpy(), batch.column("label").to_numpy()
            sizes, values = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy().astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            for width in np.unique(sizes):
                places = np.flatnonzero(sizes == width)
                held = values[starts[places][:, None] + np.arange(width)[None, :]]
                for block, cell, visitor, at in cells_of(unit(held), labels[places], places, 2 - 2 * cosine, blocks):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell), pa.array(np.full(len(cell), block, np.int32)), pa.array(visitor), pa.array(ids[at])],
                        names=["cell", "block", "visitor", "rep"],
                    )

    placed = kept(reps.select("rep", "label", "vector").mapInArrow(spread, _CELLS))
    count_of = lambda visiting: F.count(F.when(F.col("visitor") == visiting, 1))
    sizes = placed.groupBy("cell", "block").agg(count_of(False).alias("homes"), count_of(True).alias("visitors"))
    chunks = tile_count(F.greatest("homes", "visitors"), CHUNK_ROWS).alias("chunks")
    directory, directory_path = staged(sizes.where("homes > 0 AND homes + visitors > 1").select("cell", "block", chunks), "cell-sizes", files)
    tiled = with_tiles(placed.join(directory, ["cell", "block"]), F.col("chunks"), F.col("rep"))
    keys = ["cell", "block", "tile_lo", "tile_hi"]
    dealt = tiled.join(reps.select("rep", "weight", "vector"), "rep").repartition(*keys).sortWithinPartitions(*keys)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in sorted_groups(batches, keys):
            if tile.num_rows < 2:
                continue
            ids, weights, visitor, chunk = (tile.column(c).to_numpy() for c in ("rep", "weight", "visitor", "chunk"))
            values = tile.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64)
            one_chunk = tile.column("tile_lo")[0] == tile.column("tile_hi")[0]
            held = unit(values.reshape(tile.num_rows, -1))
            first, second = linked_in_tile(held, tile.column("block")[0].as_py(), visitor, chunk, one_chunk, cosine, blocks)
            if not len(first):
                continue
            links = np.bincount(first, weights[second], len(ids)) + np.bincount(second, weights[first], len(ids))
            reached = smallest_reached(first, second, ids)
            some = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(reached[some])], names=["rep", "links", "reached"]
            )

    linked, linked_path = staged(dealt.mapInArrow(verify, "rep long, links long, reached long"), "linked", files)
    each, classes_paths = linked_classes(members.withColumnRenamed("vec_id", "member"), reps, linked)
    each = each.select(F.col("member").alias("vec_id"), "n_links", F.col("component").alias("component_id"))
    alone = rows.where("vector IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    unnamed = vectors.where(F.col(id_column).isNull()).select(*[F.lit(None).cast("long").alias(c) for c in ("vec_id", "n_links", "component_id")])
    every = each.unionByName(alone).unionByName(unnamed.withColumn("n_links", F.lit(0).cast("long")))
    result, _ = staged(every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))), "near", files)
    placed.unpersist()
    remove(spark, rows_path, reps_path, directory_path, linked_path, *classes_paths)
    return result
