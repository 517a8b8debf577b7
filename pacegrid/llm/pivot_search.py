"""Exact top-k inner products by a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it; a pivot's vectors are cut
into annuli by distance. For a query q and an annulus of pivot p with distances [lo, hi] and
norms up to N, every member x has |q - x| >= d = max(0, |q - p| - hi, lo - |q - p|), and
q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2 <= (|q|^2 + N^2 - d^2) / 2, also <= |q| N. A query first
visits the annulus with the highest bound, whose k-th score is its threshold, and then all
annuli, best bound first, whose bound reaches it. No other annulus can hold a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacegrid.llm.stages import files_for, remove, staged

GRID = 1024
PIVOTS, RINGS = 32, 8
SAMPLE_ROWS = 4_096
CHUNK_ROWS = 4_096
BLOCK_QUERIES = 1_024


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds neither null nor non-finite components."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, odd), F.lit(False))


def gridded(vectors: DataFrame, grid: int, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector): components floor(grid * x) of the rows that take part."""
    vector = F.col(vector_column)
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * grid).cast("long"))
    return vectors.where(finite(vector) & F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("vec_id"), whole.alias("vector"))


def stacked(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as float64, shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def packed(rows: np.ndarray, kind: str) -> pa.Array:
    return pa.array([r.tobytes() for r in rows.astype(kind)], pa.binary())


def unpacked(column: pa.ChunkedArray, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width).astype(np.int64)


def lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows**2).sum(1))


def far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots: each next the sample row farthest from those taken."""
    if not len(sample):
        return sample
    taken, distance = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(taken) < min(count, len(sample)) and distance.max() > 0:
        taken.append(int(distance.argmax()))
        distance = np.minimum(distance, ((sample - sample[taken[-1]]) ** 2).sum(1))
    return sample[taken]


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (rows**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


@dataclass
class Directory:
    """The annuli, at most pivots times rings: their bounds, whatever the number of rows."""

    pivots: np.ndarray
    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    norm: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the score of each query in each annulus, with room for rounding."""
        norms = lengths(queries)[:, None]
        gap = distances(queries, self.pivots)[:, self.pivot]
        least = np.maximum(0, np.maximum(gap - self.high, self.low - gap) - 1e-6 * (1 + gap))
        by_distance = (norms**2 + self.norm**2 - least**2) / 2
        return np.minimum(by_distance, norms * self.norm) * (1 + 1e-9) + 1.0


def best_k(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, floors: np.ndarray):
    """(query place, id, score): for each query its k best rows at or above its floor, itself left out."""
    # Python's integers: a product of large components must not wrap before it is compared.
    big = max(int(max(part.max(initial=0), -int(part.min(initial=0)))) for part in (queries, rows))
    exact = big * big * max(1, queries.shape[1]) < 2**52
    kind = np.float64 if exact else np.int64
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order].astype(kind), ids[order]
    out = []
    for start in range(0, len(queries), 256):
        part = queries[start : start + 256].astype(kind)
        scores = part @ rows.T
        for i, line in enumerate(scores):
            query = start + i
            allowed = (line >= floors[query]) & (ids != query_ids[query])
            places = np.flatnonzero(allowed)
            if len(places) > k:
                values = line[places]
                edge = np.partition(values, len(values) - k)[len(values) - k]
                above, ties = places[values > edge], places[values == edge]
                places = np.concatenate([above, ties[: k - len(above)]])
            out += [(query, int(ids[p]), int(line[p])) for p in places]
    return out


def top_k(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 10,
    grid: int = GRID,
    pivots: int = PIVOTS,
    rings: int = RINGS,
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query, exact.

    `is_query` says by the id which rows are queries too; a row is no candidate of its own id.
    Ties go to the smaller id; a query with fewer candidates than k gets them all. Vectors that
    are null or hold null or non-finite components, and rows without id, take no part; shorter
    vectors count as filled with zeros; other columns are not read. An id that is repeated is a
    candidate each time, and asks with its smallest vector. Empty tables give no rows.

    Pivots and ring borders come from a sample of `sample_rows` rows drawn by a hash; every
    row is indexed. The directory of at most pivots * rings annuli is all that tasks share.
    Work is dealt in tiles of about CHUNK_ROWS rows of one annulus and BLOCK_QUERIES queries,
    so that an annulus or a vector that is common spreads over many tasks.
    """
    spark = vectors.sparkSession
    files = files_for(vectors, 20 * vectors.count())  # a vector weighs as much as many narrow rows
    rows, rows_path = staged(gridded(vectors, grid, id_column, vector_column), "vectors", files)
    sizes = rows.agg(F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs)))).first()
    if sizes[0] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width, kind = max(1, sizes[0]), "<i4" if (sizes[1] or 0) < 2**31 else "<i8"
    drawn = rows.orderBy(F.xxhash64("vec_id", F.lit(6)), "vec_id").limit(sample_rows).select("vector").toArrow()
    sample = stacked(drawn.column(0).combine_chunks(), width)
    centres = far_apart(sample, pivots)
    near = distances(sample, centres)
    owner, gap = near.argmin(1), near.min(1)
    steps = np.linspace(0, 1, rings + 1)[1:-1]
    borders = [np.unique(np.quantile(gap[owner == p], steps)) if (owner == p).any() else np.zeros(0) for p in range(len(centres))]

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = stacked(batch.column("vector"), width)
            away = distances(held, centres)
            pivot, least = away.argmin(1), away.min(1)
            ring = np.fromiter((np.searchsorted(borders[p], d, side="right") for p, d in zip(pivot, least)), np.int32, len(held))
            columns = [batch.column("vec_id"), batch.column("place"), packed(held, kind), pa.array(pivot * rings + ring, pa.int32()), pa.array(least), pa.array(lengths(held))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "place", "vector", "annulus", "distance", "norm"])

    keyed, keyed_path = staged(rows.withColumn("place", F.monotonically_increasing_id()).mapInArrow(key, "vec_id long, place long, vector binary, annulus int, distance double, norm double"), "annuli", files)
    bounds = (F.count(F.lit(1)).alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high"), F.max("norm").alias("norm"))
    listed = keyed.groupBy("annulus").agg(*bounds).orderBy("annulus").collect()  # at most pivots * rings rows
    numbers = np.array([r.annulus for r in listed], np.int64)
    chunks = np.ones(int(numbers.max()) + 1, np.int64)
    chunks[numbers] = [-(-r.n // CHUNK_ROWS) for r in listed]
    directory = Directory(centres, numbers // rings, *(np.array([r[name] for r in listed], float) for name in ("low", "high", "norm")))
    shared = spark.sparkContext.broadcast((directory, numbers, chunks))
    asked = rows.where(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))

    def visits(first: bool):
        def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, names, cut = shared.value
            for batch in batches:
                held = stacked(batch.column("vector"), width)
                limits = known.bounds(held)
                order = np.argsort(-limits, axis=1, kind="stable")
                floors = batch.column("floor").to_numpy(zero_copy_only=False).astype(float)
                floors[np.isnan(floors)] = -np.inf
                stops = np.ones(len(held), int) if first else (limits >= floors[:, None]).sum(1)
                raw = packed(held, kind)
                out = [(i, names[a], c) for i, stop in enumerate(stops) for a in order[i, :stop] for c in range(cut[names[a]])]
                for start in range(0, len(out), 5_000):
                    place, annulus, chunk = zip(*out[start : start + 5_000])
                    take = pa.array(place, pa.int64())
                    columns = [batch.column("vec_id").take(take), raw.take(take), batch.column("floor").take(take)]
                    columns += [pa.array(annulus, pa.int32()), pa.array(chunk, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vector", "floor", "annulus", "chunk"])

        return plan

    def tile(_, left: pa.Table, right: pa.Table) -> pa.Table:
        ids, query_ids = (t.column("vec_id").to_numpy() for t in (left, right))
        floors = right.column("floor").to_numpy(zero_copy_only=False).astype(float)
        floors[np.isnan(floors)] = -np.inf
        found = best_k(unpacked(right.column("vector"), width, kind), query_ids, unpacked(left.column("vector"), width, kind), ids, k, floors)
        place, best, scores = zip(*found) if found else ((), (), ())
        asking = query_ids[np.array(place, np.int64)]
        return pa.table({"query_id": pa.array(asking, pa.int64()), "vec_id": pa.array(best, pa.int64()), "score": pa.array(scores, pa.int64())})

    cuts = F.element_at(F.lit([int(c) for c in chunks]), F.col("annulus") + 1)
    # By the stored row's number too, so that a row that is there very often fills no chunk.
    dealt = keyed.select("vec_id", "vector", "annulus", F.pmod(F.xxhash64("vec_id", "place"), cuts).cast("int").alias("chunk"))
    keys = ("annulus", "chunk", "block")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(asking: DataFrame, first: bool) -> DataFrame:
        wanted = asking.mapInArrow(visits(first), "vec_id long, vector binary, floor long, annulus int, chunk int")
        wanted = wanted.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
        # A vector goes to the blocks that visit its chunk, and to no other.
        visited = wanted.select("annulus", "chunk", (F.col("block") + 0).alias("block")).distinct()  # a column of its own
        needed = dealt.join(visited, ["annulus", "chunk"])
        found = needed.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(tile, "query_id long, vec_id long, score long")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    home = ranked(asked.withColumn("floor", F.lit(None).cast("long")), True)
    floors, floors_path = staged(home.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor")), "floors", files)
    best = ranked(asked.join(floors, "vec_id", "left").select("vec_id", "vector", "floor"), False)
    result, _ = staged(best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "top", files)
    remove(spark, rows_path, keyed_path, floors_path)
    return result
