"""N-gram Jaccard join by chosen paths.

A text is the set of its word shingles. Each set is embedded as the minima of `COORDINATES`
hash functions, so that two sets agree in a coordinate with the probability of their Jaccard
similarity. A run splits all sets on `BRANCHES` sampled coordinates: sets that share the
token (coordinate, minimum) meet in a bucket; buckets too large for brute force are split
again on coordinates sampled by the bucket's own path. Runs are repeated until the expected
share of found pairs at the threshold reaches the target. What meets in a final bucket is
compared: first minima, then the sets themselves, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.stages import components, kept, linked_classes, remove, scan_parts, sorted_groups, staged, text_slices, tile_count, with_tiles
from pacegrid.llm.subspace_join import mixed, smallest_reached

WORDS = 5
JACCARD = 0.8
TARGET_RECALL = 0.9999
COORDINATES = 64
BRANCHES = 2
BUCKET_ROWS = 256
DEPTH = 5
CHUNK_ROWS = 512
#: Pairs whose share of equal minima is this much below the threshold are not compared; of
#: pairs at the threshold that is one in fifty million.
MARGIN = 0.3

_SETS = "doc_id long, print binary, items binary"


def missed(runs: int, jaccard: float, branches: int = BRANCHES, depth: int = DEPTH) -> float:
    """Share of the pairs at the threshold, of those `MARGIN` lets pass, that never meet in `runs` runs.

    All runs sample from the same minima, of which a pair has k equal ones, binomially
    distributed. Given k, a pair lives on below a bucket if it does at one of the sampled
    coordinates that agree: the chance p of that, from 1 at a final bucket, is averaged over
    how many of the distinct coordinates sampled are among the k.
    """
    share = 0.0
    for k in range(max(1, ceil(COORDINATES * (jaccard - MARGIN) - 1e-9)), COORDINATES + 1):
        p = 1.0
        for _ in range(depth):
            drawn = ((comb(k, h) * comb(COORDINATES - k, branches - h), h) for h in range(branches + 1))
            p = sum(ways * (1 - (1 - p) ** h) for ways, h in drawn) / comb(COORDINATES, branches)
        share += comb(COORDINATES, k) * jaccard**k * (1 - jaccard) ** (COORDINATES - k) * (1 - p) ** runs
    return share


def runs_for(recall: float, jaccard: float, branches: int = BRANCHES, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with probability `recall`, at any depth."""
    runs = 1
    while missed(runs, jaccard, branches, depth) > 1 - recall:
        runs += 1
    return runs


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text.

    Words are what white space separates, lowered. A text of fewer words than a shingle is one
    shingle; a text without words is the empty set.
    """
    split = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string())))
    offsets, values = split.offsets.to_numpy(), split.values
    coded = values.dictionary_encode()
    known = coded.dictionary.to_numpy(zero_copy_only=False).astype(object)
    hashes = pd.util.hash_array(known, categorize=False) if len(known) else np.empty(0, np.uint64)
    blank = np.array([not w for w in known], bool)
    codes = coded.indices.to_numpy()
    for start, stop in zip(offsets, offsets[1:]):
        part = codes[start:stop]
        if len(part) and (blank[part[0]] or blank[part[-1]]):
            part = part[~blank[part]]
        own = hashes[part]
        n = len(own) - words + 1
        if n < 1:
            own, n = own, 1 if len(own) else 0
            width = len(own)
        else:
            width = words
        mixed_up = np.zeros(max(n, 0), np.uint64)
        for i in range(width if n else 0):
            mixed_up = (mixed_up ^ own[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed_up ^= mixed_up >> np.uint64(32)
        yield np.unique(mixed_up)


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(9).integers(0, 1 << 32, size=(2, COORDINATES), dtype=np.uint64).astype(np.uint32)
    return drawn[0] | np.uint32(1), drawn[1]


def minima(items: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over a set, in slices so that long texts need little memory."""
    factors, shifts = multipliers()
    low = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    folded = (items >> np.uint64(32)).astype(np.uint32) ^ items.astype(np.uint32)
    for start in range(0, len(folded), 4096):
        hashed = folded[None, start : start + 4096] * factors[:, None] + shifts[:, None]
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(0x2C1B3C6D)
        low = np.minimum(low, hashed.min(1))
    return low


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """The rows of `docs` with (print, size, minima) for the text; the empty set has an empty print."""
    others = [c for c in docs.columns if c != "text"]
    schema = ", ".join([*(f"{c} long" for c in others), "print binary, size int, minima binary"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in text_slices(whole, "text")):
            out = [(print_of(items), len(items), minima(items).tobytes()) for items in shingle_sets(batch.column("text"), words)]
            kinds = (pa.binary(), pa.int32(), pa.binary())
            columns = zip(*out) if out else ((), (), ())
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), *made], names=[*others, "print", "size", "minima"])

    return docs.mapInArrow(rows, schema)


def item_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, print, items) of the rows of (doc_id, text): the sets themselves, repeated ones once a task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bytes]] = set()
        for batch in (part for whole in batches for part in text_slices(whole, "text")):
            fresh: list[tuple[int, bytes, bytes]] = []
            for doc_id, items in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), words)):
                mark = print_of(items)
                if (doc_id, mark) not in seen:
                    seen.add((doc_id, mark))
                    fresh.append((doc_id, mark, items.tobytes()))
            columns = zip(*fresh) if fresh else ((), (), ())
            kinds = (pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "print", "items"])

    return docs.select("doc_id", "text").mapInArrow(rows, _SETS)


def print_of(items: np.ndarray) -> bytes:
    """Two 64-bit sums of differently mixed items: equal for equal sets only, but for 2 ** -128."""
    return b"".join(int(mix_items(items, seed).sum(dtype=np.uint64)).to_bytes(8, "little") for seed in (1, 2)) if len(items) else b""


def mix_items(items: np.ndarray, seed: int) -> np.ndarray:
    out = (items ^ np.uint64(seed * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xD6E8FEB86659FD93)


def sampled(path: np.ndarray, count: int) -> np.ndarray:
    """(rows, count) distinct coordinates that each path samples."""
    drawn = np.stack([mixed(path, np.full(len(path), c + 1)) for c in range(COORDINATES)], 1)
    return np.argsort(drawn, axis=1, kind="stable")[:, :count]


def branch(rows: DataFrame, branches: int) -> DataFrame:
    """(path, rep, above) of the buckets below: rows are (path, above, rep, minima)."""

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            low = np.frombuffer(b"".join(batch.column("minima").to_pylist()), "<u4").reshape(-1, COORDINATES)
            path = batch.column("path").to_numpy()
            for column in sampled(path, branches).T:
                below = mixed(path, column, low[np.arange(len(path)), column])
                yield pa.RecordBatch.from_arrays([pa.array(below), batch.column("rep"), batch.column("above")], names=["path", "rep", "above"])

    return rows.select("path", "rep", "above", "minima").mapInArrow(paths, "path long, rep long, above long")


def final_buckets(reps: DataFrame, runs: int, branches: int, files: int) -> tuple[DataFrame, str]:
    """(path, rep, n) of all final buckets with two sets or more, staged, and where.

    A bucket is final when it is small, at the last depth, or holds more than half of the
    bucket it comes from: splitting on sampled tokens then doesn't thin it out.
    """
    roots = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(runs).cast("long")))
    rows = reps.select("rep", "minima").withColumn("path", roots).withColumn("above", F.lit((1 << 62)).cast("long"))
    found: DataFrame | None = None
    held: list[DataFrame] = []
    for depth in range(1, DEPTH + 1):
        split = kept(branch(rows, branches))
        sizes = split.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        last = F.lit(depth == DEPTH)
        final = last | (F.col("n") <= BUCKET_ROWS) | (2 * F.col("n") > F.col("above"))
        level = kept(split.join(sizes, "path").withColumn("final", final))
        held += [split, level]
        done = level.where("final").select("path", "rep", "n")
        found = done if found is None else found.unionByName(done)
        large = level.where("NOT final")
        if not large.count():
            break
        rows = large.select("path", "rep", F.col("n").alias("above")).join(reps.select("rep", "minima"), "rep")
    buckets, path = staged(found.distinct(), "buckets", files)
    for frame in held:
        frame.unpersist()
    return buckets, path


def agreeing(low: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Shares of equal minima of rows start..stop with all rows."""
    if len(low) <= 48:
        return (low[start:stop, None, :] == low[None, :, :]).mean(2)
    equal = np.zeros((stop - start, len(low)), np.int16)
    for c in range(low.shape[1]):
        equal += low[start:stop, c, None] == low[None, :, c]
    return equal / low.shape[1]


def pairs_of_tile(tile: pa.Table, jaccard: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a tile that may be linked and whose first common bucket this is."""
    low = np.frombuffer(b"".join(tile.column("minima").to_pylist()), "<u4").reshape(tile.num_rows, -1)
    chunk = tile.column("chunk").to_numpy()
    one_chunk = tile.column("tile_lo")[0] == tile.column("tile_hi")[0]
    sizes = tile.column("size").to_numpy()
    here = tile.column("path")[0].as_py()
    earlier = [set(paths[: paths.index(here)]) for paths in tile.column("paths").to_pylist()]
    firsts, seconds = [], []
    for start in range(0, tile.num_rows, 256):
        stop = min(start + 256, tile.num_rows)
        near = agreeing(low, start, stop) >= jaccard - MARGIN
        near &= np.arange(tile.num_rows)[None, :] > np.arange(start, stop)[:, None]
        near &= np.minimum(sizes[start:stop, None], sizes[None, :]) >= (jaccard - 1e-9) * np.maximum(sizes[start:stop, None], sizes[None, :])
        if not one_chunk:
            near &= chunk[start:stop, None] != chunk[None, :]
        i, j = np.nonzero(near)
        fresh = np.fromiter((earlier[a].isdisjoint(earlier[b]) for a, b in zip(i + start, j)), bool, len(i))
        firsts.append(i[fresh] + start)
        seconds.append(j[fresh])
    return np.concatenate(firsts), np.concatenate(seconds)


def linked_sets(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, jaccard: float) -> np.ndarray:
    """Which of the pairs of places reach the similarity, by exact counts of shared items."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    tokens, codes = np.unique(flat, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    marked = np.zeros(len(tokens), np.int32)
    shared = np.zeros(len(first), np.int64)
    order = np.argsort(first, kind="stable")
    edges = np.flatnonzero(np.diff(first[order], prepend=-1))
    for low, high in zip(edges, [*edges[1:], len(order)]):
        at = order[low:high]
        place = first[at[0]]
        own = codes[starts[place] : starts[place] + sizes[place]]
        marked[own] = 1
        if 4 * len(at) > len(sets):
            shared[at] = np.add.reduceat(marked[codes], starts)[second[at]]
        else:
            shared[at] = [marked[codes[starts[o] : starts[o] + sizes[o]]].sum() for o in second[at]]
        marked[own] = 0
    return shared >= jaccard * (sizes[first] + sizes[second] - shared) - 1e-9


def linked_reps(named: DataFrame, reps: DataFrame, jaccard: float, words: int, recall: float, files: int) -> tuple[DataFrame, str]:
    """(rep, links, reached) of what tiles link, staged, and where.

    `reps` (rep, doc_id, print, weight, size, minima) are distinct sets, each with a document of
    `named` (doc_id, text) that has it; a document may have several.
    """
    buckets, buckets_path = final_buckets(reps, runs_for(recall, jaccard), BRANCHES, files)
    paths = buckets.groupBy("rep").agg(F.sort_array(F.collect_set("path")).alias("paths"))
    known = kept(reps.join(paths, "rep"))
    keys = ["path", "tile_lo", "tile_hi"]
    placed = with_tiles(buckets, tile_count(F.col("n"), CHUNK_ROWS), F.col("rep")).select(*keys, "chunk", "rep")
    dealt = placed.join(known.select("rep", "size", "minima", "paths"), "rep").repartition(*keys).sortWithinPartitions(*keys, "rep")

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in sorted_groups(batches, keys):
            first, second = pairs_of_tile(tile, jaccard)
            if len(first):
                some = np.union1d(first, second)
                yield tile.select([*keys, "chunk", "rep"]).take(some).combine_chunks().to_batches()[0]

    likely, likely_path = staged(dealt.mapInArrow(screen, placed.schema), "candidates", files)
    likely = likely.join(known, "rep")
    wanted, wanted_path = staged(likely.select("doc_id").distinct(), "wanted", files)
    texts = named.select("doc_id", "text").join(wanted.hint("shuffle_hash"), "doc_id", "left_semi")
    sets = item_sets(texts, words)
    full_rows = likely.join(sets, ["doc_id", "print"]).drop("doc_id", "print").repartition(*keys).sortWithinPartitions(*keys, "rep")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in sorted_groups(batches, keys):
            ids = tile.column("rep").to_numpy()
            if len(np.unique(ids)) < len(ids):  # a row that was there twice
                tile = tile.take(np.unique(ids, return_index=True)[1])
                ids = tile.column("rep").to_numpy()
            first, second = pairs_of_tile(tile, jaccard)
            if not len(first):
                continue
            items = [np.frombuffer(i, "<u8") for i in tile.column("items").to_pylist()]
            kept = linked_sets(items, first, second, jaccard)
            first, second, weights = first[kept], second[kept], tile.column("weight").to_numpy()
            links = np.bincount(first, weights[second], len(ids)) + np.bincount(second, weights[first], len(ids))
            reached, some = smallest_reached(first, second, ids), np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(reached[some])], names=["rep", "links", "reached"]
            )

    linked, linked_path = staged(full_rows.mapInArrow(verify, "rep long, links long, reached long"), "linked", files)
    known.unpersist()
    remove(named.sparkSession, buckets_path, likely_path, wanted_path)
    return linked, linked_path


def jaccard_join(
    docs: DataFrame,
    jaccard: float = JACCARD,
    words: int = WORDS,
    recall: float = TARGET_RECALL,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_links, component_id, kept) of every document.

    Documents are linked when the Jaccard similarity of their sets of `words`-word shingles
    reaches `jaccard`; equal sets are linked too. Null, empty and blank texts have the empty
    set and link with nothing. Rows with a null id stay and have no links. Rows of one id are
    one document, the text with the greatest print, and give one row. Other columns are not read; an empty
    table gives no rows.

    Texts are joined with ids by hashed shuffles at every size; they are neither sorted nor met by
    a broadcast. Documents of one set are one representative with a weight, so copies cost nothing. Large
    final buckets are compared tile by tile; a tile gives one row per linked representative,
    never its pairs: the documents it is linked with, and the smallest one reached.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    named = narrow.where("doc_id IS NOT NULL")
    one = sketches(named, words).groupBy("doc_id").agg(F.max(F.struct("print", "size", "minima")).alias("s"))
    files = scan_parts(narrow)
    prints, prints_path = staged(one.select("doc_id", "s.*"), "sketches", files)
    full = prints.where("size > 0").groupBy("print")
    reps = full.agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.min("size").alias("size"), F.min("minima").alias("minima"))
    reps, reps_path = staged(reps.withColumn("doc_id", F.col("rep")), "sets", files)
    members = prints.where("size > 0").join(reps.select("print", "rep"), "print").select(F.col("doc_id").alias("member"), "rep")
    linked, linked_path = linked_reps(named, reps, jaccard, words, recall, files)
    each, classes_paths = linked_classes(members, reps, linked)
    each = each.select(F.col("member").alias("doc_id"), "n_links", F.col("component").alias("component_id"))
    alone = prints.where("size = 0").select("doc_id", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"))
    unnamed = narrow.where("doc_id IS NULL").select("doc_id", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"))
    every = each.unionByName(alone).unionByName(unnamed)
    result, _ = staged(every.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "near", files)
    remove(spark, prints_path, reps_path, linked_path, *classes_paths)
    return result


def first_of_each(
    docs: DataFrame,
    jaccard: float = JACCARD,
    words: int = WORDS,
    recall: float = TARGET_RECALL,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row of each class of near-duplicates, that with the smallest id; all columns kept.

    Rows are decided by their own text, not by their id: each distinct (id, text) is a document,
    and a class of them is what `jaccard_join` links. Of several texts under its smallest id a
    class keeps one, by their hashes. Rows equal in id and text are one document also where the
    text is null, empty or blank: the row with the smallest other columns stays, so these must be
    orderable where there are such rows. Rows with a null id all stay.
    """
    spark, keys = docs.sparkSession, ["doc_id", "mark", "check"]
    text = docs[f"`{text_column}`"]
    own = [docs[f"`{id_column}`"].cast("long"), F.xxhash64(text), F.xxhash64(F.lit(1), text)]
    narrow = docs.select(text.alias("text"), *(value.alias(key) for value, key in zip(own, keys)))
    named = narrow.where("doc_id IS NOT NULL")
    files = scan_parts(narrow)
    one = sketches(named, words).groupBy(keys).agg(F.max(F.struct("print", "size", "minima")).alias("s"), F.count(F.lit(1)).alias("rows"))
    prints, prints_path = staged(one.select(*keys, "rows", "s.*"), "sketches", files)
    full = prints.where("size > 0").groupBy("print")
    reps = full.agg(F.min(F.struct(*keys)).alias("first"), F.count(F.lit(1)).alias("weight"), F.min("size").alias("size"), F.min("minima").alias("minima"))
    reps = reps.withColumn("rep", F.monotonically_increasing_id()).withColumn("doc_id", F.col("first.doc_id"))
    reps, reps_path = staged(reps, "sets", files)  # written, so that the numbers stay
    linked, linked_path = linked_reps(named, reps.drop("first"), jaccard, words, recall, files)
    joined = components(linked.select(F.col("rep").alias("a"), F.col("reached").alias("b"))).withColumnRenamed("node", "rep")
    classes = reps.select("rep", "first").join(joined, "rep", "left").groupBy(F.coalesce("component", "rep"))
    firsts = classes.agg(F.min("first").alias("first")).select("first.*", F.lit(True).alias("kept"))
    told = prints.select(*keys, "rows", "size").join(firsts, keys, "left")
    told = told.select(*keys, "rows", (F.col("kept").isNotNull() | (F.col("size") == 0)).alias("kept"))
    told, _ = staged(told.where("NOT kept OR rows > 1").select(*keys, "kept"), "near", files)
    remove(spark, prints_path, reps_path, linked_path)

    def met(others: DataFrame, how: str) -> DataFrame:
        same = own[0] == others["doc_id"]
        return docs.join(others, same & (own[1] == others["mark"]) & (own[2] == others["check"]), how)

    alone = met(told.hint("shuffle_hash"), "left_anti")
    again = told.where("kept")
    if again.isEmpty():
        return alone
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return alone.union(met(again, "left_semi").groupBy(*own).agg(F.min(whole).alias("row")).select("row.*"))
