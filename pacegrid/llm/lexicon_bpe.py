"""Word-level BPE by a minimal acyclic transducer of frequent words; unseen words are merged."""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pacegrid.llm.stages import put_file, remove, staged, text_slices
from pacegrid.llm.token_ids import byte_of_symbol

# Fixed value: the word pattern of the lower-cased vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
LEXICON_WORDS = 250_000
COUNT_WORDS = 300_000
MEMO_WORDS = 400_000
SHORT_WORD = 48
NO_JOIN = (1 << 62, -1)
#: Blocks whose letters, digits, spaces and cases are the same in every Unicode version in use;
#: a text with any other character is split by the tokenizers library itself.
STEADY = "\u0000-ԯ‐-⁞ぁ-ゖァ-ヺ一-龥가-힣"

_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@lru_cache(maxsize=1)
def steady_words() -> tuple[re.Pattern, re.Pattern]:
    """What is not steady, and the word pattern for what is, its classes spelled out.

    Spelled out, the standard library matches them about three times as fast as by property.
    """
    spans = [STEADY[i : i + 3] for i in range(0, len(STEADY), 3)]
    steady = "".join(chr(c) for span in spans for c in range(ord(span[0]), ord(span[2]) + 1))
    spelled = WORDS
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        runs = regex.findall(f"{name}+", steady)
        inside = "".join(f"{re.escape(r[0])}-{re.escape(r[-1])}" for run in runs for r in unbroken(run))
        spelled = spelled.replace(name, inside)
    return re.compile(f"[^{STEADY}]"), re.compile(spelled)


def unbroken(run: str) -> list[str]:
    """The stretches of a string in which each character follows the one before in number."""
    cuts = [0, *(i for i in range(1, len(run)) if ord(run[i]) != ord(run[i - 1]) + 1), len(run)]
    return [run[a:b] for a, b in zip(cuts, cuts[1:])]


class Merges:
    """The vocabulary and merge ranks of a tokenizers file, and exact merging of one word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.vocabulary: dict[str, int] = described["model"]["vocab"]
        self.tokens = {number: token for token, number in self.vocabulary.items()}
        self.joins: dict[tuple[int, int], tuple[int, int]] = {}  # pair of ids -> rank and id of both joined
        for rank, pair in enumerate(described["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.joins[self.vocabulary[left], self.vocabulary[right]] = (rank, self.vocabulary[left + right])
        self.added = {token["content"]: token["id"] for token in described["added_tokens"]}
        self.tokens |= {number: token for token, number in self.added.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, self.added)) + ")")
        symbol = {byte: char for char, byte in byte_of_symbol().items()}
        self.inner = [self.vocabulary[symbol[b]] for b in range(256)]
        self.last = [self.vocabulary[symbol[b] + END] for b in range(256)]
        self.library = Tokenizer.from_file(path)
        self.unsure, self.split = steady_words()

    def merge(self, word: str) -> list[int]:
        """Ids of a word: again and again the pair of lowest rank is joined, the leftmost of equals."""
        raw = word.encode()
        parts = [self.inner[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        return self.merge_short(parts) if len(parts) <= SHORT_WORD else self.merge_long(parts)

    def merge_short(self, parts: list[int]) -> list[int]:
        find = self.joins.get
        found = [find(pair, NO_JOIN) for pair in zip(parts, parts[1:])]
        while found:
            best = min(found)
            if best is NO_JOIN:
                break
            at = found.index(best)
            parts[at : at + 2] = [best[1]]
            del found[at]
            if at:
                found[at - 1] = find((parts[at - 1], best[1]), NO_JOIN)
            if at < len(found):
                found[at] = find((best[1], parts[at + 1]), NO_JOIN)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same by a queue over a linked list, for words of any length."""
        size = len(parts)
        after, before, gone = list(range(1, size + 1)), list(range(-1, size - 1)), [False] * size
        queue = [(join[0], i, pair) for i, pair in enumerate(zip(parts, parts[1:])) if (join := self.joins.get(pair))]
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = size if gone[i] else after[i]
            if j >= size or (parts[i], parts[j]) != pair:
                continue
            parts[i], gone[j], after[i] = self.joins[pair][1], True, after[j]
            if after[i] < size:
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else size
                if right < size and (join := self.joins.get((parts[left], parts[right]))):
                    heapq.heappush(queue, (join[0], left, (parts[left], parts[right])))
        return [part for part, out in zip(parts, gone) if not out]

    def words(self, text: str) -> list[str]:
        """Words of a whole text in order; added tokens stand as they are."""
        found: list[str] = []
        for piece in self.special.split(text):
            if piece in self.added:
                found.append(piece)
            elif piece and self.unsure.search(piece):
                normal = self.library.normalizer.normalize_str(piece)
                for _, (start, end) in self.library.pre_tokenizer.pre_tokenize_str(normal):
                    found.append(normal[start:end])
            elif piece:
                found += self.split.findall(unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower())
        return found


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def minimal_automaton(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, targets, outputs) of the minimal acyclic transducer of sorted distinct words.

    A key is state * 256 + byte, sorted. The outputs along an accepted path add up to the
    word's number among the sorted words; a path that ends at a final state without having
    been told so by byte 0 is no word: the end of a word is the byte 0. Equal suffixes share
    their states. Built word by word: the states that no later word can change are looked up
    in a register of finished states.
    """
    register: dict[tuple, int] = {}
    sizes: list[int] = []
    edges: list[tuple[tuple[int, int], ...]] = []

    def finish(children: list[tuple[int, int]]) -> int:
        state = tuple(children)
        known = register.get(state)
        if known is None:
            known = register[state] = len(edges)
            edges.append(state)
            sizes.append(sum(sizes[target] for _, target in state) if state else 1)
        return known

    path: list[list[tuple[int, int]]] = [[]]
    spelled = b""
    for word in (w + b"\0" for w in words):
        shared = 0
        while shared < len(spelled) and shared < len(word) and spelled[shared] == word[shared]:
            shared += 1
        for depth in range(len(spelled), shared, -1):
            path[depth - 1].append((spelled[depth - 1], finish(path.pop())))
        path += [[] for _ in range(len(word) - shared)]
        spelled = word
    for depth in range(len(spelled), 0, -1):
        path[depth - 1].append((spelled[depth - 1], finish(path.pop())))
    root = finish(path[0])
    keys, targets, outputs = [], [], []
    renumbered = {root: 0} | {s: s + 1 for s in range(root)}
    for state, children in enumerate(edges):
        before = 0
        for byte, target in children:
            keys.append(renumbered[state] << 8 | byte)
            targets.append(renumbered[target])
            outputs.append(before)
            before += sizes[target]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return tuple(np.array(c, np.int64)[order] for c in (keys, targets, outputs))


def lexicon_bytes(words: Iterable[str], path: str) -> bytes:
    """The transducer and the ids of its words as one block that can be mapped into memory."""
    known = merges(path)
    ordered = sorted({w.encode(): w for w in words if w and "\0" not in w}.items())
    keys, targets, outputs = minimal_automaton([raw for raw, _ in ordered])
    ids = [known.merge(word) for _, word in ordered]
    starts = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int64)
    flat = np.array([i for each in ids for i in each], np.int64)
    arrays = (keys, targets, outputs, starts, flat)
    return struct.pack("<5q", *map(len, arrays)) + b"".join(a.astype("<i8").tobytes() for a in arrays)


class Lexicon:
    """A mapped transducer; looks many words up at once, byte by byte."""

    def __init__(self, file: str):
        with open(file, "rb") as opened:
            self.mapped = mmap.mmap(opened.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = struct.unpack_from("<5q", self.mapped)
        place, arrays = 40, []
        for size in sizes:
            arrays.append(np.frombuffer(self.mapped, "<i8", size, place))
            place += 8 * size
        self.keys, self.targets, self.outputs, self.starts, self.ids = arrays

    def numbers(self, words: list[str]) -> np.ndarray:
        """Each word's number, -1 for words the transducer doesn't hold."""
        raw = [w.encode() + b"\0" for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        letters = np.frombuffer(b"".join(raw), np.uint8)
        firsts = np.cumsum(lengths) - lengths
        state, total = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
        alive = np.arange(len(raw) if len(self.keys) else 0)
        found = np.full(len(raw), -1, np.int64)
        step = 0
        while len(alive):
            wanted = state[alive] << 8 | letters[firsts[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            held = self.keys[at] == wanted
            alive, at = alive[held], at[held]
            state[alive] = self.targets[at]
            total[alive] += self.outputs[at]
            step += 1
            ended = lengths[alive] == step
            found[alive[ended]] = total[alive[ended]]
            alive = alive[~ended]
        return found

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.starts[number] : self.starts[number + 1]].tolist()


@lru_cache(maxsize=2)
def mapped_lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


def word_counts(docs: DataFrame, tokenizer: str, text_column: str = "text") -> DataFrame:
    """(word, n) over all whole texts. Counted per partition first, in tables of bounded size."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = merges(tokenizer), Counter()

        def emptied() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                held.update(known.words(text.as_py() or ""))
                if len(held) > COUNT_WORDS:
                    yield emptied()
        if held:
            yield emptied()

    partial = docs.select(F.col(text_column).alias("text")).mapInArrow(counted, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def publish_lexicon(docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS, text_column: str = "text") -> str:
    """Compile the most frequent words of all texts, `words` at most; the name executors find the file by.

    Words that occur equally often are all in or all out, and those that occur once are out.

    The file is bounded by `words`, whatever the corpus. It lies in the shared folder; every
    executor fetches it once and its workers map it into memory. Added tokens are no words.
    """
    spark = docs.sparkSession
    counts, path = staged(word_counts(docs, tokenizer, text_column).where((F.col("n") > 1) & (F.length("word") <= 64)), "words")
    held, least = 0, None
    for row in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toLocalIterator():
        held += row.words
        if held > words:
            break
        least = row.n
    most = [] if least is None else counts.where(F.col("n") >= least).select("word").collect()
    remove(spark, path)
    added = merges(tokenizer).added
    block = lexicon_bytes([row.word for row in most if row.word not in added], tokenizer)
    name = f"lexicon-{uuid.uuid4().hex}.fst"
    spark.sparkContext.addFile(put_file(spark, name, block))
    return name


class Encoder:
    """Ids and tokens of words: transducer first, exact merges for what it doesn't hold."""

    def __init__(self, tokenizer: str, lexicon: str):
        self.known, self.lexicon = merges(tokenizer), mapped_lexicon(lexicon)
        self.memo: dict[str, tuple[int, str, str]] = {}

    def learn(self, words: set[str]) -> dict[str, tuple[int, str, str]]:
        """Count, ids and tokens of at least every word of a batch.

        They're remembered for the next batches, also those of other tasks, while there's room;
        frequent words are among the first. Afterwards new ones are told for this batch alone.
        """
        new = list(words.difference(self.memo))
        told = self.memo if len(self.memo) < MEMO_WORDS else {w: self.memo[w] for w in words.intersection(self.memo)}
        for word, number in zip(new, self.lexicon.numbers(new).tolist()):
            if word in self.known.added:
                ids = [self.known.added[word]]
            else:
                ids = self.lexicon.ids_of(number) if number >= 0 else self.known.merge(word)
            told[word] = (len(ids), " ".join(map(str, ids)), " ".join([self.known.tokens[i] for i in ids]))
        return told


@lru_cache(maxsize=1)
def encoder(tokenizer: str, lexicon: str) -> Encoder:
    """One for all tasks of a worker process."""
    return Encoder(tokenizer, lexicon)


def encoded(docs: DataFrame, tokenizer: str, lexicon: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every whole text, for use on the ids themselves.

    A null text is empty: no ids, an empty decoded text. A null id stays null, repeated rows
    stay repeated, an empty table gives no rows, and other columns are not read.
    """
    return _each(docs, tokenizer, lexicon, id_column, text_column, "doc_id long, ids array<int>, decoded string", lambda n, ids, text: ([int(i) for i in ids.split()], text), [pa.list_(pa.int32()), pa.string()])


def digests(docs: DataFrame, tokenizer: str, lexicon: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    A null text is empty: no ids, an empty decoded text. A null id stays null, repeated rows
    stay repeated, an empty table gives no rows, and other columns are not read.
    """

    def digest(n: int, ids: str, text: str) -> tuple[int, str, str]:
        return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    return _each(docs, tokenizer, lexicon, id_column, text_column, _DIGESTS, digest, [pa.int64(), pa.string(), pa.string()])


def _each(docs, tokenizer, lexicon, id_column, text_column, schema, made, kinds) -> DataFrame:
    names = [field.split()[0] for field in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, lexicon)
        for batch in (part for whole in batches for part in text_slices(whole, "text")):
            texts = [coder.known.words(t.as_py() or "") for t in batch.column("text")]
            told = coder.learn(set().union(*texts))
            out = []
            for words in texts:
                parts = [told[w] for w in words]
                counts, ids, tokens = zip(*parts) if parts else ((), (), ())
                out.append(made(sum(counts), " ".join(ids), " ".join(tokens)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names=names)

    narrow = docs.selectExpr(f"cast(`{id_column}` as long) AS doc_id", f"`{text_column}` AS text")
    return narrow.mapInArrow(rows, schema)


def decode(ids: list[int], tokenizer: str) -> str:
    """Tokens of ids joined by spaces: the file names no decoder, so token texts stand as they are."""
    known = merges(tokenizer)
    return " ".join(known.tokens[i] for i in ids if i in known.tokens)
