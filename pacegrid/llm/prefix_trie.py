"""Prefix trie of rebuilt conversations by fingerprints that compose, without rebuilt texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacegrid.llm.stages import heavy_join, remove, staged

#: Rebuilt conversations share at most one turn less than this with the head of their base.
HEADS = 6
FAMILY = 100
REF_BYTES = 32
MODULUS = (1 << 127) - 1
#: Turns of one conversation that meet in one task at most; longer ones are dealt out by segments.
SEGMENT = 50_000
IDS_A_PIECE = 4_096

Map = tuple[int, int]
_PLACED = "part int, conv_id long, place long, ref binary, chars long, a binary, b binary, before binary, last boolean"
_HEAD = "array<struct<place: long, ref: binary, chars: long, a: binary, b: binary, before: binary>>"
_CONVS = "conv_id long, skipped long, n_turns long, left_a binary, left_b binary, head array<struct<place: long, ref: binary, chars: long, key: binary, parent: binary>>"
_MEMBERS = "conv_id long, depth long, key binary, parent binary, ref binary, chars long, ends boolean"


class Monoid:
    """Maps x -> a * x + b modulo a prime. A turn is such a map, a sequence their product.

    Products of parts compose to that of the whole, and every map has an inverse, so that of
    a suffix follows from those of two prefixes. A sequence's key is its b.
    """

    def __init__(self, modulus: int = MODULUS, seed: int = 0):
        self.modulus, self.seed = modulus, seed

    def turn(self, ref: bytes) -> Map:
        digest = hashlib.blake2b(ref, digest_size=32, salt=self.seed.to_bytes(8, "little")).digest()
        return int.from_bytes(digest[:16]) % (self.modulus - 1) + 1, int.from_bytes(digest[16:]) % self.modulus

    def times(self, left: Map, right: Map) -> Map:
        return left[0] * right[0] % self.modulus, (left[0] * right[1] + left[1]) % self.modulus

    def inverse(self, of: Map) -> Map:
        a = pow(of[0], -1, self.modulus)
        return a, -a * of[1] % self.modulus

    def key(self, left: Map, b: int) -> bytes:
        """Key of `left` times a sequence of key b."""
        return packed((left[0] * b + left[1]) % self.modulus)


ONE: Map = (1, 0)


def packed(number: int) -> bytes:
    return number.to_bytes(16)


def number(block: bytes) -> int:
    return int.from_bytes(block)


ROOT = packed(0)


def turns_of(convs: DataFrame, ref_bytes: int = REF_BYTES) -> DataFrame:
    """(conv_id, turn, sha, ref, chars) of each row; nulls are empty, rows without conversation go."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = convs.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), sha.alias("sha"), F.length(text).cast("long").alias("chars"))
    return rows.withColumn("ref", F.expr(f"substring(sha, 1, {ref_bytes})"))


def turn_store(convs: DataFrame, ref_bytes: int = REF_BYTES) -> DataFrame:
    """(ref, role, text): what each turn reference stands for, once."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = convs.where("conv_id IS NOT NULL").select(sha.alias("sha"), role.alias("role"), text.alias("text"))
    return rows.select(F.expr(f"substring(sha, 1, {ref_bytes})").alias("ref"), "role", "text").distinct()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}
    names, types = zip(*(field.split() for field in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=list(names))


def placed(turns: DataFrame, monoid: Monoid) -> DataFrame:
    """Turns in order with their place and product among those of their conversation in their task.

    Rows are dealt by ranges, so a long conversation lies over many tasks, one after the other.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, waiting = TaskContext.get().partitionId(), [], None
        product, place = ONE, 0
        for batch in batches:
            for conv, ref, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "ref", "chars"))):
                if waiting is not None:
                    out.append((*waiting, conv != waiting[1]))
                if waiting is None or conv != waiting[1]:
                    product, place = ONE, 0
                before, product, place = product, monoid.times(product, monoid.turn(ref)), place + 1
                waiting = (part, conv, place, ref, chars, packed(product[0]), packed(product[1]), packed(before[1]))
            yield _batch(out, _PLACED)
            out = []
        if waiting is not None:
            yield _batch([(*waiting, True)], _PLACED)

    # Equal rows are told apart by a number, so that they don't fill one task.
    numbered = turns.withColumn("number", F.monotonically_increasing_id())
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("sha"), F.col("number")]
    return numbered.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "ref", "chars").mapInArrow(rows, _PLACED)


def positioned(parts: DataFrame, monoid: Monoid) -> DataFrame:
    """The same with places and products in the whole conversation: those of earlier tasks come first.

    A task shares at most its first and its last conversation with others, so what is
    broadcast has two rows a task at most.
    """
    runs = parts.where("last").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "place", "a", "b"))).alias("runs"))
    schema = "part int, conv_id long, earlier long, earlier_a binary, earlier_b binary"

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, pieces in zip(batch.column("conv_id").to_pylist(), batch.column("runs").to_pylist()):
                product, count = ONE, 0
                for piece in pieces:
                    out.append((piece["part"], conv, count, packed(product[0]), packed(product[1])))
                    product, count = monoid.times(product, (number(piece["a"]), number(piece["b"]))), count + piece["place"]
            yield _batch(out, schema)

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["earlier"] is not None:
                    first = number(row["earlier_a"]), number(row["earlier_b"])
                    a, b = monoid.times(first, (number(row["a"]), number(row["b"])))
                    row |= {"a": packed(a), "b": packed(b), "before": monoid.key(first, number(row["before"])), "place": row["earlier"] + row["place"]}
                out.append(tuple(row[c] for c in ("part", "conv_id", "place", "ref", "chars", "a", "b", "before", "last")))
            yield _batch(out, _PLACED)

    spans = runs.where(F.size("runs") > 1).mapInArrow(offsets, schema)
    return parts.join(F.broadcast(spans), ["conv_id", "part"], "left").mapInArrow(moved, _PLACED)


def rebuilt(turns: DataFrame, monoid: Monoid) -> DataFrame:
    """How each conversation is put together: what it skips, the factor of its own turns, its base's head.

    The factor is the base head's product times the inverse of that of the skipped turns: times
    a product of the first turns of the conversation it gives that of the rebuilt ones.
    """
    counts = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    head = F.sort_array(F.collect_list(F.struct("place", "ref", "chars", "a", "b", "before"))).alias("first")
    firsts = turns.where(F.col("place") < HEADS).groupBy("conv_id").agg(head).join(counts, "conv_id")
    firsts, _ = staged(firsts, "first-turns")
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS))
    own = firsts.withColumn("base", F.expr(f"conv_id - conv_id % {FAMILY}")).withColumn("shared", shared)
    bases = firsts.select(F.col("conv_id").alias("base"), F.col("first").alias("base_first"))
    both = own.join(bases, "base", "left")
    part = pa.struct([("place", pa.int64()), ("ref", pa.binary()), ("chars", pa.int64()), ("key", pa.binary()), ("parent", pa.binary())])

    def product(turn: dict) -> Map:
        return number(turn["a"]), number(turn["b"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "skipped", "n_turns", "left_a", "left_b", "head"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(part)]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] == row["base"]:
                    out.append((row["conv_id"], 0, row["n"], packed(1), packed(0), []))
                    continue
                taken, skipped = (row["base_first"] or [])[: row["shared"]], min(row["shared"], row["n"])
                left = product(taken[-1]) if taken else ONE
                if skipped:
                    left = monoid.times(left, monoid.inverse(product(row["first"][skipped - 1])))
                held = [{"place": t["place"], "ref": t["ref"], "chars": t["chars"], "key": t["b"], "parent": t["before"]} for t in taken]
                out.append((row["conv_id"], skipped, len(taken) + row["n"] - skipped, packed(left[0]), packed(left[1]), held))
            columns = zip(*out) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return both.mapInArrow(joined, _CONVS)


def by_segment(convs: DataFrame, length: str) -> DataFrame:
    """Each conversation once for every segment of its length."""
    last = F.expr(f"{length} div {SEGMENT}")
    return convs.withColumn("segment", F.explode(F.sequence(F.lit(0).cast("long"), last)))


def members_of(turns: DataFrame, convs: DataFrame, monoid: Monoid) -> DataFrame:
    """(conv_id, depth, key, parent, ref, chars, ends) of each prefix of each rebuilt conversation."""
    wide = by_segment(convs.select("conv_id", "skipped", "n_turns", "left_a", "left_b", F.size("head").alias("n_head"), (F.col("n_turns") + F.col("skipped")).alias("reach")), "reach")
    own = turns.withColumn("segment", F.expr(f"place div {SEGMENT}")).join(wide, ["conv_id", "segment"]).where("place > skipped")
    own = own.select("conv_id", (F.col("n_head") + F.col("place") - F.col("skipped")).alias("depth"), "b", "before", "ref", "chars", "left_a", "left_b", "n_turns")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, depth, b, before, ref, chars, left_a, left_b, n in zip(*(c.to_pylist() for c in batch.columns)):
                left = number(left_a), number(left_b)
                out.append((conv, depth, monoid.key(left, number(b)), monoid.key(left, number(before)), ref, chars, depth == n))
            yield _batch(out, _MEMBERS)

    heads = convs.select("conv_id", "n_turns", F.explode("head").alias("h"))
    heads = heads.select("conv_id", F.col("h.place").alias("depth"), "h.key", "h.parent", "h.ref", "h.chars", (F.col("h.place") == F.col("n_turns")).alias("ends"))
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(b"").alias("ref"), F.lit(0).cast("long").alias("chars"), (F.col("n_turns") == 0).alias("ends"))
    return own.mapInArrow(keyed, _MEMBERS).unionByName(heads).unionByName(roots)


def end_digests(members: DataFrame) -> DataFrame:
    """(depth, key, ends_sha256) of nodes where conversations end, over their sorted ids.

    Ids are sorted by ranges over all tasks and joined to pieces there, so a node of very many
    sends few rows to the task that hashes its pieces one after the other.
    """
    order = ["depth", "key", "conv_id"]
    schema, told = "depth long, key binary, first long, ids string", "depth long, key binary, ends_sha256 string"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []
        for batch in batches:
            for depth, key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (node != (depth, key) or len(ids) == IDS_A_PIECE):
                    out.append((*node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = depth, key
                ids.append(conv)
            yield _batch(out, schema)
            out = []
        if ids:
            yield _batch([(*node, ids[0], ",".join(map(str, ids)))], schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, out = None, None, []
        for batch in batches:
            for depth, key, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node == (depth, key):
                    digest.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (depth, key), hashlib.sha256(ids.encode())
            yield _batch(out, told)
            out = []
        if node is not None:
            yield _batch([(*node, digest.hexdigest())], told)

    ends = members.where("ends").select(order)
    joined = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, schema)
    return joined.repartition("depth", "key").sortWithinPartitions("depth", "key", "first").mapInArrow(hashed, told)


def counted(members: DataFrame, nodes: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie's rows out of members and nodes.

    A node's smallest member has all nodes below it that no smaller one has, so the nodes of a
    conversation are the tail of its prefixes. Sums over a subtree are thus sums over members:
    for the smallest one over its nodes from this depth on, for others over all their nodes.
    """
    rated = nodes.withColumn("worth", (F.col("n_convs") - 1) * F.col("chars")).withColumn("segment", F.expr(f"depth div {SEGMENT}"))
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    rated = rated.join(kids, ["depth", "key"], "left").fillna(0, ["n_children"])
    below = Window.partitionBy("conv_id", "segment").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    rated, _ = staged(rated.withColumn("below", F.sum("worth").over(below)), "rated-nodes")
    later = Window.partitionBy("conv_id").orderBy(F.desc("segment"))
    segments = rated.groupBy("conv_id", "segment").agg(F.sum("worth").alias("worth"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    segments = segments.select(
        "conv_id", "segment",
        F.coalesce(F.sum("worth").over(later.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("later"),
        F.sum("worth").over(Window.partitionBy("conv_id")).alias("total"),
        F.max("leaf").over(Window.partitionBy("conv_id")).alias("leaf"),
    )
    segments, _ = staged(segments, "segments")
    totals = segments.groupBy("conv_id").agg(F.max("total").alias("total"), F.max("leaf").alias("leaf")).where("total > 0 OR leaf > 0")
    spread = by_segment(totals.join(convs.select("conv_id", "n_turns"), "conv_id"), "n_turns").drop("n_turns")
    placed_members = members.select("conv_id", "depth", "key").withColumn("segment", F.expr(f"depth div {SEGMENT}"))
    sums = placed_members.join(spread, ["conv_id", "segment"]).groupBy("depth", "key").agg(F.sum("total").alias("all_totals"), F.sum("leaf").alias("n_leaves"))
    tops = rated.where("n_children > 0").select(F.col("depth").alias("above"), F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    lower = rated.where("depth > 0").select("depth", "key", "parent", (F.col("depth") - 1).alias("above"))
    parents = heavy_join(lower, tops, ["above", "parent"], "n_children").select("depth", "key", "parent_conv_id")
    whole = rated.join(segments.drop("leaf"), ["conv_id", "segment"]).join(sums, ["depth", "key"], "left")
    whole = whole.join(parents, ["depth", "key"], "left").join(end_digests(members), ["depth", "key"], "left")
    saved = F.col("below") + F.col("later") + F.coalesce("all_totals", F.lit(0)) - F.col("total")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
        saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), F.col("ref").alias("last_ref"),
    )


def trie(convs: DataFrame, ref_bytes: int = REF_BYTES, modulus: int = MODULUS) -> DataFrame:
    """A row for each distinct prefix of the rebuilt conversations of (conv_id, turn, role, text).

    `conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`
    and `last_ref`, the reference of the node's last turn in `turn_store`. Null role and text
    are empty; turns go by number, null first, rows of one number by the SHA-256 of role and
    text; repeated rows are turns of their own. Rows without conv_id belong to no conversation
    and are left out. An empty table has no rows, not even a root. Other columns are not read.

    Prefixes are grouped by depth, fingerprint, parent's fingerprint and last turn. That each
    depth and fingerprint then has one node, and each turn reference one role and text, is
    verified over all; by depth, members of a node are equal sequences. If not, all is done
    again with longer references and another fingerprint.
    """
    spark, seed = convs.sparkSession, 0
    while True:
        store, store_path = staged(turn_store(convs, ref_bytes), "turn-store")
        if store.groupBy("ref").count().where("count > 1").isEmpty():
            monoid = Monoid(modulus, seed)
            turns, narrow_path = staged(turns_of(convs, ref_bytes), "turns")
            parts, parts_path = staged(placed(turns, monoid), "placed-turns")
            whole, _ = staged(positioned(parts, monoid), "positions")
            built, _ = staged(rebuilt(whole, monoid), "rebuilt")
            members, _ = staged(members_of(whole, built, monoid), "members")
            nodes = members.groupBy("depth", "key", "parent", "ref").agg(
                F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars")
            )
            nodes, _ = staged(nodes, "nodes")
            remove(spark, narrow_path, parts_path)
            if nodes.groupBy("depth", "key").count().where("count > 1").isEmpty():
                return counted(members, nodes, built)
        elif ref_bytes >= REF_BYTES:
            raise ValueError("two turns with one SHA-256 digest")
        remove(spark, store_path)
        ref_bytes, modulus, seed = min(REF_BYTES, 2 * ref_bytes), MODULUS, seed + 1
