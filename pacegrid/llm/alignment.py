"""Alignment of the tokens of two tokenizers over the same bytes, by diagonal run skipping."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.stages import remove, scan_parts, staged, text_slices
from pacegrid.llm.token_ids import encoded, encoding

FIRST_PROBE = 8
#: Words from one start of alignment to the next; words of both tokenizers begin there.
STRETCH = 100
#: With fewer starts left the rest is aligned one by one.
FEW = 24
MEMO_WORDS = 250_000
LEARNED_AT_ONCE = 2_000
LONG_WORD = 64
#: Pairs that every worker holds by count, 12 bytes each; the rest are joined.
COMMON_PAIRS = 1_000_000
HELD_PAIRS = 2_000_000
SPACE = "▁"
#: A space between two other characters: a word of both tokenizers begins there.
WORD_START = re.compile(r"(?<=\S) (?=\S)")

_STORED = (
    "part int, place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
)


class Pair:
    """Both tokenizers: ids of a text, bytes of each token, and whether they spell the text."""

    def __init__(self, byte_file: str, piece_file: str):
        self.bytes_of = encoding(byte_file)
        self.pieces_of = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.a_bytes = [b""] * (self.bytes_of.max_token_value + 1)
        for raw, number in self.bytes_of._mergeable_ranks.items():
            self.a_bytes[number] = raw
        self.b_bytes = [self.piece(i) for i in range(self.pieces_of.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(t) for t in tokens], np.int64) for tokens in (self.a_bytes, self.b_bytes))
        # Texts of one token in a digest: within a group, at the end of its A part, at its end.
        self.marks = [f"{i}{mark}" for mark in ",|" for i in range(len(self.a_bytes))]
        self.b_marks = len(self.marks)
        self.marks += [f"{i}{mark}" for mark in ",;" for i in range(len(self.b_bytes))]
        # Words apart: no piece goes on over a space that follows another character.
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", self.pieces_of.id_to_piece(i)) for i in range(len(self.b_bytes)))
        self.memo: dict[str, tuple[bytes, bytes] | None] = {}

    def piece(self, number: int) -> bytes:
        piece = self.pieces_of.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.pieces_of.is_byte(number) else piece.replace(SPACE, " ").encode()

    def whole(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a space and `text`; None unless the tokens of both spell it byte by byte."""
        spelled = b" " + text.encode()
        a = encoded(" " + text, self.bytes_of, special=False).astype(np.int64)
        b = np.array(self.pieces_of.encode(text, num_threads=1), np.int64)
        # Byte-level merges always spell the text; pieces don't where the model changes characters.
        same = self.a_size[a].sum() == len(spelled) and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == spelled
        return (a, b) if same else None

    def learn(self, words: list[str]) -> None:
        """Remember the ids of words, all encoded as one text that is cut at the words again.

        Where the tokens don't spell that text, halves are tried, down to the words at fault.
        """
        found = self.whole(" ".join(words))
        if found is None:
            if len(words) == 1:
                self.memo[words[0]] = None
                return
            half = len(words) // 2
            self.learn(words[:half])
            self.learn(words[half:])
            return
        ends = np.cumsum([len(word.encode()) + 1 for word in words])
        cuts = [(ids.astype("<u4").tobytes(), (4 * np.searchsorted(np.cumsum(sizes[ids]), ends) + 4).tolist()) for ids, sizes in zip(found, (self.a_size, self.b_size))]
        start_a = start_b = 0
        for word, end_a, end_b in zip(words, cuts[0][1], cuts[1][1]):
            self.memo[word] = cuts[0][0][start_a:end_a], cuts[1][0][start_b:end_b]
            start_a, start_b = end_a, end_b

    def words(self, texts: list[str]) -> list[list[tuple[bytes, bytes]]]:
        """Each text's words as ids of both, 4 bytes each, repeated words looked up; [] unless all spell the text.

        Both tokenizers treat words apart; for a piece model that doesn't, a text is one word.
        """
        memo = self.memo
        cut = WORD_START.split if self.by_word else lambda text: [text]
        split = [cut(text) if text else [] for text in texts]
        new = set(chain.from_iterable(split)).difference(memo)
        plain = [word for word in new if word == word.strip() and self.by_word]  # others hold the white space at an end of a text
        for at in range(0, len(plain), LEARNED_AT_ONCE):
            self.learn(plain[at : at + LEARNED_AT_ONCE])
        for word in new.difference(plain):
            self.learn([word])
        found = [[memo[word] for word in words] for words in split]
        full = len(memo) > MEMO_WORDS  # the words of the first texts stay; frequent ones are among them
        for word in new:
            if full or len(word) > LONG_WORD:
                del memo[word]
        return [[] if None in words else words for words in found]


@lru_cache(maxsize=2)
def tokenizers(byte_file: str, piece_file: str) -> Pair:
    return Pair(byte_file, piece_file)


def irregular_groups(ends_a: list[int], ends_b: list[int]) -> tuple[list[tuple[int, int, int, int]], list[int], list[int]]:
    """Groups that are not one token each, (i, i end, j, j end), and the links (i, j) within them.

    At the index shift j - i of the moment, stretches of both end arrays are compared, each
    twice as long as the one before while they are equal: one-to-one groups are jumped. Where
    a stretch differs it's halved down to the first difference. There one group is resolved
    token by token, the side that ends first going on, until both end together; that is the
    new shift. Both arrays rise and end with the same number.
    """
    groups, link_a, link_b = [], [], []
    i = j = 0
    size_a, size_b = len(ends_a), len(ends_b)
    while i < size_a:
        width = FIRST_PROBE
        while i + width <= size_a and ends_a[i : i + width] == ends_b[j : j + width]:
            i += width
            j += width
            width *= 2
        while width > 1:
            width >>= 1
            if i + width <= size_a and ends_a[i : i + width] == ends_b[j : j + width]:
                i += width
                j += width
        if i == size_a:
            break
        from_a, from_b, a, b = i, j, ends_a[i], ends_b[j]
        if a == b:  # the tail is shorter than the halved stretch
            i += 1
            j += 1
            continue
        while a != b:
            link_a.append(i)
            link_b.append(j)
            if a < b:
                i += 1
                a = ends_a[i]
            else:
                j += 1
                b = ends_b[j]
        link_a.append(i)
        link_b.append(j)
        i += 1
        j += 1
        groups.append((from_a, i, from_b, j))
    return groups, link_a, link_b


def irregular_from(ends_a: np.ndarray, ends_b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `irregular_groups`, from many starts at once: groups as rows, and both sides of their links.

    Token starts_a[k] begins at the same byte as starts_b[k]. All starts take each step
    together, every one at its own shift, up to where the next began.
    """
    long_a, long_b = np.append(ends_a, np.full(1, -1)), np.append(ends_b, np.full(1, -2))  # never equal beyond the end
    last_a, last_b = len(ends_a), len(ends_b)
    i, j, stop = starts_a.copy(), starts_b.copy(), np.append(starts_a[1:], last_a)
    groups, link_a, link_b = [], [], []
    while True:
        probing, width = np.arange(len(i)), FIRST_PROBE
        while len(probing):
            steps = np.arange(width)
            same = long_a[np.minimum(i[probing, None] + steps, last_a)] == long_b[np.minimum(j[probing, None] + steps, last_b)]
            through = same.all(axis=1)
            jumped = np.where(through, width, same.argmin(axis=1))
            i[probing] += jumped
            j[probing] += jumped
            probing = probing[through]
            probing = probing[i[probing] < stop[probing]]
            width = min(2 * width, 4_096)
        going = i < stop
        i, j, stop = i[going], j[going], stop[going]
        if len(i) < FEW:
            break
        from_a, from_b = i.copy(), j.copy()
        open_ones = np.arange(len(i))
        while len(open_ones):
            link_a.append(i[open_ones])
            link_b.append(j[open_ones])
            a, b = ends_a[link_a[-1]], ends_b[link_b[-1]]
            i[open_ones] += a <= b
            j[open_ones] += b <= a
            open_ones = open_ones[a != b]
        groups.append(np.stack((from_a, i, from_b, j), axis=1))
    for a, b, end in zip(i.tolist(), j.tolist(), stop.tolist()):
        other = int(np.searchsorted(ends_b, ends_a[end - 1])) + 1
        found, left, right = irregular_groups(ends_a[a:end].tolist(), ends_b[b:other].tolist())
        groups.append(np.array(found, np.int64).reshape(-1, 4) + [a, a, b, b])
        link_a.append(np.array(left, np.int64) + a)
        link_b.append(np.array(right, np.int64) + b)
    none = np.empty(0, np.int64)
    return np.concatenate([none.reshape(0, 4), *groups]), np.concatenate([none, *link_a]), np.concatenate([none, *link_b])


def closing(size: int, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens close their group, and which are the group's only one, among `size` tokens.

    All do and are, but for those of irregular groups [start, end), of which the last closes.
    """
    change = np.zeros(size + 1, np.int64)
    change[starts] += 1  # groups share no token, so starts differ, and ends too
    change[ends] -= 1
    single = np.cumsum(change[:-1]) == 0
    closes = single.copy()
    closes[ends - 1] = True
    return closes, single


class Aligned:
    """Groups and links of the texts of one batch, one after the other.

    `doc_a`, `doc_b`: tokens of each text; `closes_a`, `closes_b`: which tokens close a group;
    `link_a`, `link_b`: the tokens of each link.
    """

    def __init__(self, texts: list[list[tuple[bytes, bytes]]], pair: Pair):
        parts = [words[at : at + STRETCH] for words in texts for at in range(0, len(words), STRETCH)]
        before = np.cumsum([0, *(-(-len(words) // STRETCH) for words in texts)])
        sides = [[b"".join([word[side] for word in part]) for part in parts] for side in (0, 1)]
        self.a, self.b = (np.frombuffer(b"".join(side), "<u4").astype(np.int64) for side in sides)
        starts_a, starts_b = (np.cumsum([0, *map(len, side)]) // 4 for side in sides)
        self.doc_a, self.doc_b = np.diff(starts_a[before]), np.diff(starts_b[before])
        groups, link_a, link_b = irregular_from(np.cumsum(pair.a_size[self.a]), np.cumsum(pair.b_size[self.b]), starts_a[:-1], starts_b[:-1])
        self.closes_a, single_a = closing(len(self.a), groups[:, 0], groups[:, 1])
        self.closes_b, single_b = closing(len(self.b), groups[:, 2], groups[:, 3])
        self.link_a = np.concatenate((np.flatnonzero(single_a), link_a))
        self.link_b = np.concatenate((np.flatnonzero(single_b), link_b))
        self.text_of_a = np.repeat(np.arange(len(texts)), self.doc_a)

    def groups_texts(self, pair: Pair) -> Iterator[str]:
        """For each text `a1,a2|b1;a3|b2,b3`: ids of A and B of each group in order."""
        before_b = np.concatenate(([0], np.flatnonzero(self.closes_b) + 1))  # B tokens before each group
        through_a = np.flatnonzero(self.closes_a) + 1  # A tokens up to the end of each group
        group_a, group_b = (np.cumsum(closes) - closes for closes in (self.closes_a, self.closes_b))
        marks = np.empty(len(self.a) + len(self.b), np.int64)
        marks[np.arange(len(self.a)) + before_b[group_a]] = self.a + len(pair.a_bytes) * self.closes_a
        marks[np.arange(len(self.b)) + through_a[group_b]] = self.b + pair.b_marks + len(pair.b_bytes) * self.closes_b
        ends = np.cumsum(self.doc_a + self.doc_b).tolist()
        for start, end in zip([0, *ends], ends):
            yield "".join(map(pair.marks.__getitem__, marks[start:end].tolist()))[:-1]

    def codes(self, pair: Pair) -> tuple[list[int], list[tuple[np.ndarray, np.ndarray]]]:
        """Each text's number of links, and its linked id pairs as distinct numbers with their counts."""
        code = self.a[self.link_a] * len(pair.b_bytes) + self.b[self.link_b]
        text = self.text_of_a[self.link_a]
        both, counts = np.unique(text << 32 | code, return_counts=True)
        cuts = np.searchsorted(both, np.arange(1, len(self.doc_a)) << 32)
        links = np.bincount(text, minlength=len(self.doc_a)).tolist()
        return links, list(zip(np.split(both & 0xFFFFFFFF, cuts), np.split(counts, cuts)))


def packed(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Distinct sorted codes and how often each occurs, byte planes of steps, compressed."""
    planes = np.stack((np.diff(codes, prepend=0), counts)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    steps, counts = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").reshape(2, -1).astype(np.int64)
    return np.cumsum(steps), counts


def aligned_rows(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """Per document its counts, the digest of its groups, and its linked id pairs, packed.

    (part, place) numbers the rows; both come from one task attempt and are written together.
    """
    names = [field.split()[0] for field in _STORED.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.int64()] * 4, pa.string(), pa.binary()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, part, place = tokenizers(byte_file, piece_file), TaskContext.get().partitionId(), 0
        for batch in (piece for whole in batches for piece in text_slices(whole, "text")):
            found = Aligned(pair.words([t.as_py() or "" for t in batch.column("text")]), pair)
            groups = np.bincount(found.text_of_a[found.closes_a], minlength=batch.num_rows)
            links, codes = found.codes(pair)
            digests = [hashlib.sha256(text.encode()).hexdigest() if text else "" for text in found.groups_texts(pair)]
            places = np.arange(place, place + batch.num_rows)
            place += batch.num_rows
            out = (np.full(batch.num_rows, part), places, None, found.doc_a, found.doc_b, groups, links, digests, [packed(*c) if len(c[0]) else None for c in codes])
            columns = [batch.column("doc_id") if c is None else pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(rows, _STORED)


def summed(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted codes of several counts, and their sums."""
    codes, counts = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.add.reduceat(counts, first)


def pair_counts(stored: DataFrame) -> DataFrame:
    """(code, n): how many links of all documents hold each id pair. Counted per partition first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, held = (np.empty(0, np.int64),) * 2, [], 0

        def batch_of(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])

        for block in chain.from_iterable(batch.column(0) for batch in batches):
            waiting.append(unpacked(block.as_py()))
            held += len(waiting[-1][0])
            if held > HELD_PAIRS:
                total, waiting, held = summed([total, *waiting]), [], 0
                if len(total[0]) > HELD_PAIRS:
                    yield batch_of(*total)
                    total = (np.empty(0, np.int64),) * 2
        if waiting or len(total[0]):
            yield batch_of(*summed([total, *waiting]))

    partial = stored.where("pairs IS NOT NULL").select("pairs").mapInArrow(counted, "code long, n long")
    return partial.groupBy("code").agg(F.sum("n").alias("n"))


def best_counts(counts: DataFrame, vocabulary: int) -> np.ndarray:
    """The highest count of each B id: one number for each id of the vocabulary, so of bounded size."""
    best = np.zeros(vocabulary, np.int64)
    for row in counts.groupBy((F.col("code") % vocabulary).cast("int").alias("b")).agg(F.max("n").alias("n")).toLocalIterator():
        best[row.b] = row.n
    return best


def common_pairs(counts: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The least count that at most `most` pairs reach, and those pairs, sorted, with their counts."""
    held, least = 0, 1 << 62
    for row in counts.groupBy("n").agg(F.count(F.lit(1)).alias("pairs")).orderBy(F.desc("n")).toLocalIterator():
        held += row.pairs
        if held > most:
            break
        least = row.n
    common = counts.where(F.col("n") >= least).toArrow()
    codes, n = (common.column(c).to_numpy().astype(np.int64) for c in ("code", "n"))
    order = np.argsort(codes)
    return least, codes[order].astype(np.uint32), n[order]


def align(
    docs: DataFrame,
    byte_file: str,
    piece_file: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    common: int = COMMON_PAIRS,
) -> DataFrame:
    """Per document how its tokens under a byte-level file (A) and a piece model (B) lie together.

    `doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`. A encodes a space
    and the text, B the text, to which it adds the space; strings of special tokens are plain
    text. Bytes at which tokens of both end cut them into groups; a link is an A and a B token
    whose bytes overlap; an id pair's count is the number of links that hold it in the whole
    table. `n_best` counts links whose pair is the most frequent of its B id, ties included.

    A text that is null, empty, or not spelled by the tokens of both has no tokens: zeros and
    an empty digest. A null id stays null, each repeated row is counted and stays, an empty
    table gives no rows, other columns are not read.

    Pairs are counted over all rows. The `common` most frequent go to the workers as two
    arrays of that size at most; links of other pairs are joined with their counts, and none
    of those keys is frequent.
    """
    spark = docs.sparkSession
    narrow = docs.selectExpr(f"cast(`{id_column}` as long) AS doc_id", f"`{text_column}` AS text")
    stored, _ = staged(aligned_rows(narrow.coalesce(scan_parts(narrow)), byte_file, piece_file), "aligned")
    counts, _ = staged(pair_counts(stored), "pair-counts", spark.sparkContext.defaultParallelism)
    vocabulary = len(tokenizers(byte_file, piece_file).b_bytes)
    best = best_counts(counts, vocabulary)
    least, codes, n = common_pairs(counts, common)
    told = spark.sparkContext.broadcast((codes, n, best))

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = told.value
        for batch in batches:
            sums, bests, rare, often = [], [], [], []
            for block in batch.column("pairs").to_pylist():
                if block is None:
                    sums.append(0), bests.append(0), rare.append(None), often.append(None)
                    continue
                mine, times = unpacked(block)
                at = np.minimum(np.searchsorted(codes, mine.astype(np.uint32)), max(len(codes) - 1, 0))
                known = codes[at] == mine if len(codes) else np.zeros(len(mine), bool)
                count = n[at[known]]
                sums.append(int((count * times[known]).sum()))
                bests.append(int(times[known][count == best[mine[known] % vocabulary]].sum()))
                rare.append(mine[~known] if not known.all() else None)
                often.append(times[~known] if not known.all() else None)
            lists = [pa.array(c, pa.list_(pa.int64())) for c in (rare, often)]
            kept = [batch.column(c) for c in batch.schema.names if c != "pairs"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), *lists], names=names)

    names = [*(c for c in stored.columns if c != "pairs"), "n_best", "count_sum", "rare", "often"]
    schema = _STORED.replace(", pairs binary", "") + ", n_best long, count_sum long, rare array<long>, often array<long>"
    rows = stored.mapInArrow(looked_up, schema)
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rest = counts.where(F.col("n") < least)
    if rest.isEmpty():
        return rows.select(out)
    rows, _ = staged(rows, "looked-up")
    highest = spark.createDataFrame(list(enumerate(best.tolist())), "b int, best long")
    rest = rest.withColumn("b", (F.col("code") % vocabulary).cast("int")).join(F.broadcast(highest), "b")
    links = rows.where("rare IS NOT NULL").select("part", "place", F.explode(F.arrays_zip("rare", "often")).alias("l"))
    links = links.select("part", "place", F.col("l.rare").alias("code"), F.col("l.often").alias("times")).join(rest, "code")
    more = links.groupBy("part", "place").agg(
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
    )
    whole = rows.drop("rare", "often").join(more, ["part", "place"], "left")
    for column in ("n_best", "count_sum"):
        whole = whole.withColumn(column, F.col(column) + F.coalesce({"n_best": "more_best", "count_sum": "more_sum"}[column], F.lit(0)))
    return whole.select(out)
