"""Exact dedup by an index of cuckoo filters over buckets of digests, with verified content."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid.llm.stages import heavy_join, remove, staged, text_slices

# Fixed value: what the comparison of texts leaves out.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
SLOTS = 4
KICKS = 500
BUCKET_KEYS = 1_000
#: Content that a task holds at most before it hands its digests on.
HELD_BYTES = 32_000_000
KEY_BYTES = 32
#: Parts in which a digest that arrives from very many tasks is verified first.
SALTS = 32

_PRINTS = "kind string, doc_id long, sha binary, n_chars long, change long, content binary"
_MERGED = "kind string, bucket long, key binary, live long, conflict boolean, blob binary"


class CuckooFilter:
    """16-bit fingerprints in buckets of four; each may lie in one of two. Counts nothing twice."""

    def __init__(self, buckets: int = 64, cells: bytes | None = None):
        self.cells = array("H", bytes(2 * SLOTS * buckets) if cells is None else cells)
        self.mask = len(self.cells) // SLOTS - 1
        self.turn = 0

    def places(self, key: bytes) -> tuple[int, int, int]:
        hashed = int.from_bytes(hashlib.blake2b(key, digest_size=8).digest())
        print_ = hashed % 65_535 + 1
        first = hashed >> 17 & self.mask
        return print_, first, self.other(first, print_)

    def other(self, bucket: int, print_: int) -> int:
        return bucket ^ (print_ * 0x5BD1E995 >> 7 & self.mask)

    def put(self, bucket: int, held: int, now: int) -> bool:
        for cell in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
            if self.cells[cell] == held:
                self.cells[cell] = now
                return True
        return False

    def holds(self, key: bytes) -> bool:
        print_, first, second = self.places(key)
        return any(print_ in self.cells[SLOTS * b : SLOTS * b + SLOTS] for b in (first, second))

    def insert(self, key: bytes) -> bool:
        """False if there's no room: the filter is as it was, and must be made anew from its keys."""
        print_, first, second = self.places(key)
        if self.put(first, 0, print_) or self.put(second, 0, print_):
            return True
        before, bucket = self.cells[:], second
        for _ in range(KICKS):
            self.turn = (self.turn + 1) % SLOTS
            cell = SLOTS * bucket + self.turn
            print_, self.cells[cell] = self.cells[cell], print_
            bucket = self.other(bucket, print_)
            if self.put(bucket, 0, print_):
                return True
        self.cells = before
        return False

    def delete(self, key: bytes) -> bool:
        """Take out a key that was inserted; another of the same fingerprint and buckets stays."""
        print_, first, second = self.places(key)
        return self.put(first, print_, 0) or self.put(second, print_, 0)

    def resized(self, keys: Iterable[bytes]) -> CuckooFilter:
        """A filter of twice the size, or as often as it takes, over the stored keys."""
        keys, buckets = list(keys), 2 * (self.mask + 1)
        while True:
            larger = CuckooFilter(buckets)
            if all(larger.insert(key) for key in keys):
                return larger
            buckets *= 2

    def blob(self) -> bytes:
        return self.cells.tobytes()


def same(left: bytes, right: bytes) -> bool:
    """Whether two compressed contents are of the same text."""
    if left == right:
        return True
    inflate = zstandard.ZstdDecompressor()
    return inflate.decompress(left) == inflate.decompress(right)


def prints(docs: DataFrame, change: int) -> DataFrame:
    """A row for each document ('row'), and one for each digest of a task ('key') with its content.

    Copies that a task meets while it holds their content are compared and counted at once;
    it holds HELD_BYTES at most, then hands its digests on and begins again.
    """
    names = [field.split()[0] for field in _PRINTS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def batch_of(columns: Iterable) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        def handed_on() -> pa.RecordBatch:
            deflate = zstandard.ZstdCompressor(level=1)
            out = [("key", None, sha, None, count, deflate.compress(content)) for sha, (count, content) in held.items()]
            held.clear()
            return batch_of(zip(*out))

        for batch in (part for whole in batches for part in text_slices(whole, "text")):
            shas, sizes = [], []
            for text in batch.column("text").to_pylist():
                content = (text or "").encode().translate(None, BLANKS)
                sha = hashlib.sha256(content).digest()
                known = held.get(sha)
                if known is None:
                    held[sha] = [change, content]
                    size += len(content) + 200
                elif known[1] == content:
                    known[0] += change
                else:
                    raise ValueError("two texts with one SHA-256 digest")
                shas.append(sha)
                sizes.append(len(text or ""))
            n = batch.num_rows
            yield batch_of((["row"] * n, batch.column("doc_id").to_pylist(), shas, sizes, [change] * n, [None] * n))
            if size > HELD_BYTES:
                yield handed_on()
                size = 0
        if held:
            yield handed_on()

    return docs.mapInArrow(rows, _PRINTS)


def merged(rows: DataFrame, by: list[str]) -> DataFrame:
    """Buckets after their changes: a row for each live key, one for the filter of each bucket.

    `rows` (bucket, key, rank, change, content) are a bucket's filter (rank -1, no key), its
    stored keys (0) and new ones (1). The filter is asked about every new key: what it
    doesn't hold is inserted without a look at any content, what it holds is compared with
    the content under its key, and inserted if there's none. Keys come in order, so only the
    content of one is held. A filter without room keeps the keys aside, and is made anew from
    the live keys at the bucket's end. `conflict` marks a key under which two contents differ.
    """
    names = [field.split()[0] for field in _MERGED.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.binary()]

    def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bucket, known, aside, alive, out = None, None, CuckooFilter(), set(), [], []
        key, live, content, conflict = None, 0, None, False

        def key_done() -> None:
            nonlocal key
            if key is not None and live > 0:
                alive.append(key)
                out.append(("key", bucket, key, live, conflict, content))
            elif key in aside:
                aside.discard(key)
            elif key is not None:
                known.delete(key)
            key = None

        def bucket_done() -> None:
            if group is not None:
                filter_ = known.resized(alive) if aside else known
                out.append(("filter", bucket, None, len(alive), False, filter_.blob()))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "key", "rank", "change", "content", *by)]
            for number, this, rank, change, block, *of in zip(*columns):
                if of != group:
                    key_done()
                    bucket_done()
                    group, bucket, known, aside, alive = of, number, CuckooFilter(), set(), []
                if rank < 0:
                    known = CuckooFilter(cells=block)
                    continue
                hit = rank == 0 or known.holds(this) or this in aside
                if hit and this == key:
                    if block is not None and content is not None and not same(content, block):
                        conflict = True
                    content = block if content is None else content
                    live += change
                    continue
                key_done()
                if rank > 0 and change < 0:
                    continue  # nothing of it is in the index
                if rank > 0 and not known.insert(this):  # a miss, or a hit by chance
                    aside.add(this)
                key, live, content, conflict = this, change, block, False
            if len(out) > 5_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out = []
        key_done()
        bucket_done()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows.repartition(*by).sortWithinPartitions(*by, F.col("key").asc_nulls_first(), "rank", F.desc("change")).mapInArrow(changed, _MERGED)


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(buckets))


def without_hot(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of new keys, those of a key that very many tasks hand on brought together in parts first."""
    counted, path = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key-counts")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = counted.where(F.col("n") > max(2 * SALTS, total / 1000)).select("key")  # fewer than 1,000
    if hot.isEmpty():
        remove(rows.sparkSession, path)
        return rows
    many = rows.join(F.broadcast(hot), "key").withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    parts = merged(many.withColumn("bucket", F.lit(0).cast("long")), ["key", "salt"]).where("kind = 'key'")
    joined = parts.select("key", F.lit(1).alias("rank"), F.col("live").alias("change"), F.col("blob").alias("content"))
    return rows.join(F.broadcast(hot), "key", "left_anti").unionByName(joined)


@dataclass(frozen=True)
class Index:
    """A version of the index in the shared folder. Changes give a new version and leave this one as it is.

    `members` and `contents` are folders of what was inserted and deleted so far, `state` holds
    the live keys and the filter of each bucket.
    """

    spark: SparkSession
    key_bytes: int
    buckets: int = 0
    stages: tuple[str, ...] = ()
    state: str | None = None

    def _read(self, path: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)

    def _key(self) -> Column:
        return F.expr(f"substring(sha, 1, {self.key_bytes})")

    def _stages(self) -> DataFrame:
        frames = (self._read(path, _PRINTS) for path in self.stages)
        return reduce(DataFrame.unionByName, frames).withColumn("key", self._key())

    def members(self) -> DataFrame:
        """(sha, key, doc_id, n_chars, copies) of what is in the index."""
        rows = self._stages().where("kind = 'row'").groupBy("sha", "key", "doc_id", "n_chars")
        return rows.agg(F.sum("change").alias("copies")).where("copies > 0")

    def keys(self) -> DataFrame:
        """(key, live): live digests and how many rows have them."""
        return self._read(self.state, _MERGED).where("kind = 'key'").select("bucket", "key", "live")

    def filters(self) -> DataFrame:
        return self._read(self.state, _MERGED).where("kind = 'filter'").select("bucket", F.col("live").alias("keys"), "blob")

    def probe(self, keys: DataFrame) -> DataFrame:
        """Those of `keys` that the filter of their bucket holds; a few of them may not be stored."""
        asked = keys.select(bucket_of(self.buckets).alias("bucket"), "key").distinct()
        both = asked.withColumn("blob", F.lit(None).cast("binary")).unionByName(
            self.filters().select("bucket", F.lit(None).cast("binary").alias("key"), "blob")
        )

        def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bucket, known = None, CuckooFilter()
            for batch in batches:
                found = []
                for number, key, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "key", "blob"))):
                    if number != bucket:
                        bucket, known = number, CuckooFilter()
                    if key is None:
                        known = CuckooFilter(cells=blob)
                    elif known.holds(key):
                        found.append(key)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["key"])

        return both.repartition("bucket").sortWithinPartitions("bucket", F.col("key").asc_nulls_first()).mapInArrow(told, "key binary")

    def insert(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Index:
        """The index with the rows of `docs` as well; repeated rows count as often as they occur."""
        return self._changed(prints(_narrow(docs, id_column, text_column), 1))

    def delete(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Index:
        """The index without rows equal to those of `docs` in id and text; rows it doesn't hold are ignored.

        Digests whose last row goes leave their filter.
        """
        if self.state is None:
            return self
        wanted = prints(_narrow(docs, id_column, text_column), 1).where("kind = 'row'").withColumn("key", self._key())
        wanted, path = staged(wanted.groupBy("sha", "key", "doc_id", "n_chars").agg(F.count(F.lit(1)).alias("asked")), "asked")
        wanted = wanted.join(self.probe(wanted), "key", "left_semi").alias("w")
        known = self.members().alias("m")
        alike = (F.col("m.sha") == F.col("w.sha")) & (F.col("m.n_chars") == F.col("w.n_chars")) & F.col("m.doc_id").eqNullSafe(F.col("w.doc_id"))
        gone = known.join(wanted, alike).select("m.doc_id", "m.sha", "m.n_chars", F.least("asked", "copies").alias("n"))
        gone, gone_path = staged(gone, "gone")
        rows = gone.select(F.lit("row").alias("kind"), "doc_id", "sha", "n_chars", (-F.col("n")).alias("change"))
        keys = gone.groupBy("sha").agg((-F.sum("n")).alias("change")).withColumn("kind", F.lit("key"))
        after = self._changed(rows.unionByName(keys, allowMissingColumns=True).withColumn("content", F.lit(None).cast("binary")))
        remove(self.spark, path, gone_path)
        return after

    def _changed(self, stage: DataFrame) -> Index:
        _, path = staged(stage.select([field.split()[0] for field in _PRINTS.split(", ")]), "prints")
        return replace(self, stages=(*self.stages, path))._merged()

    def _merged(self) -> Index:
        """The next state: the last stage is merged into the buckets, or all of them where buckets or keys change."""
        last = self._read(self.stages[-1], _PRINTS).where("kind = 'key'").withColumn("key", self._key())
        live = 0 if self.state is None else self.keys().count()
        buckets = max(1, -(-(live + last.where("change > 0").count()) // BUCKET_KEYS))
        grown = self.state is None or buckets > 2 * self.buckets
        old = self if not grown else replace(self, buckets=buckets)
        new = without_hot(last.select("key", F.lit(1).alias("rank"), "change", "content"), old.buckets)
        rows = new.withColumn("bucket", bucket_of(old.buckets))
        if self.state is not None:
            hits, _ = staged(self.probe(last.where("change > 0")), "hits")
            stored = self.keys().select("key", F.lit(0).alias("rank"), F.col("live").alias("change"), F.lit(None).cast("binary").alias("content"))
            content = reduce(DataFrame.unionByName, (self._read(path, _PRINTS) for path in self.stages[:-1]))
            content = content.where("content IS NOT NULL").withColumn("key", self._key()).join(hits, "key", "left_semi").select("key", "content")
            verified = stored.select("key").join(content, "key").select("key", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("change"), "content")
            rows = rows.unionByName(stored.unionByName(verified).withColumn("bucket", bucket_of(old.buckets)))
            if grown:  # other buckets: their filters are made from the stored keys
                rows = rows.withColumn("rank", F.lit(1))
            else:
                blank = self.filters().select(F.lit(None).cast("binary").alias("key"), F.lit(-1).alias("rank"), F.lit(0).cast("long").alias("change"), F.col("blob").alias("content"), "bucket")
                rows = rows.unionByName(blank)
        state, path = staged(merged(rows, ["bucket"]).withColumn("blob", F.expr("if(kind = 'filter', blob, null)")), "index")
        if not state.where("conflict").isEmpty():
            if self.key_bytes >= KEY_BYTES:
                raise ValueError("two texts with one SHA-256 digest")
            return self._lengthened()
        return replace(old, state=path)

    def _lengthened(self) -> Index:
        """The index under keys of twice the length, where two contents had met under one key."""
        after = replace(self, key_bytes=min(KEY_BYTES, 2 * self.key_bytes), stages=(), state=None)
        for path in self.stages:
            after = replace(after, stages=(*after.stages, path))._merged()
        return after


def _narrow(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.selectExpr(f"cast(`{id_column}` as long) AS doc_id", f"`{text_column}` AS text")


def build(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", key_bytes: int = KEY_BYTES) -> Index:
    """An index of all rows of `docs`. Keys are the first bytes of SHA-256; they grow if contents conflict."""
    return Index(docs.sparkSession, key_bytes).insert(docs, id_column, text_column)


def groups(index: Index) -> DataFrame:
    """One row per row of the index: `doc_id, keep_id, group_size, kept, text_sha256`.

    Texts are equal if they are without blanks; nulls are empty. Of a group the row with the
    most code points stays, then the smallest id, ids before null; of rows equal in both,
    one. An empty index has no rows.
    """
    members, _ = staged(index.members(), "members")
    best = members.groupBy("key", "n_chars").agg(F.min("doc_id").alias("least"))
    best = best.groupBy("key").agg(F.max("n_chars").alias("most"), F.max_by(F.col("least"), F.col("n_chars")).alias("keep_id"))
    told, _ = staged(best.join(index.keys(), "key").select("key", "most", "keep_id", F.col("live").alias("group_size")), "groups")
    joined = heavy_join(members, told, "key", "group_size")
    one = joined.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    kept = (F.col("n_chars") == F.col("most")) & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("number") == 1)
    return one.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", key_bytes: int = KEY_BYTES) -> DataFrame:
    """Groups of equal texts in `docs`, through an index of them; see `groups`.

    Null texts are empty, null ids stay and are kept last, repeated rows are rows of their own,
    an empty table gives no rows, other columns are not read.
    """
    return groups(build(docs, id_column, text_column, key_bytes))
